"""Reading one raw line as a record of texts, strictly.

A line is parsed once: as ``[<line>,{"__end":"1"}]``. The result has exactly two elements,
the second being the end mark, only if the line was one complete JSON value: truncated
objects, trailing text, several objects and stray brackets all fail this test.

Fields are read as variants, which keep their JSON type: objects and arrays become NULL, and
strings that look like one do not. A number that was written with a fraction keeps one (``1.0``
is no whole number). Objects may name a key twice, the last one counts: this needs the session
setting ``spark.sql.variant.allowDuplicateKeys``, which ``session.configure`` makes.

Most lines are plain: one flat object of texts, whole numbers of up to 17 digits, ``true``, ``false``
and ``null``. In those a field read as text is what its variant gives, so they are read as texts, which
takes a fraction of the time. Whatever a pattern does not prove to be plain is read as variants.

The expressions work on a column named ``data``. They are written as one SQL text each, since
building them piece by piece takes hundreds of calls to Spark.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logledger.schemas import RAW_KEYS


def _whole(kind: str) -> str:
    """The line's fields, all of one type, if it is one complete value."""
    shape = "array<struct<%s, __end string>>" % ", ".join(f"`{k}` {kind}" for k in RAW_KEYS)
    array = f"""from_json(concat('[', data, ',{{"__end":"1"}}]'), '{shape}',
      map('allowSingleQuotes', 'false'))"""
    # The lambda binds the parsed array: it is computed once and tested three times.
    return f"transform(array({array}), a -> IF(size(a) = 2 AND a[1].__end = '1', a[0], NULL))"


def _text(key: str) -> str:
    """A field's text. Whole numbers that fit 18 digits have the type BIGINT, so a decimal of
    that size without places had some that were zero."""
    text, kind = f"try_variant_get(r.{key}, '$', 'string')", f"schema_of_variant(r.{key})"
    zeros = f"{kind} LIKE 'DECIMAL(%,0)' AND length({text}) < 19"
    return f"""'{key}', CASE substr({kind}, 1, 3) WHEN 'OBJ' THEN NULL WHEN 'ARR' THEN NULL
      WHEN 'DEC' THEN IF({zeros}, concat({text}, '.0'), {text}) ELSE {text} END"""


# Brackets, a brace after the first character, or a value (what follows a quote and a colon) that
# neither begins a text nor is a plain number or word. A text that holds such things counts as well.
# The first three tests look at bytes; in one pattern with the last they take ten times as long.
_VALUE = r""""\s*+:\s*+(?!"|(?:0|-?[1-9][0-9]{0,16}|true|false|null)\s*+[,}])"""
_NOT_PLAIN = f"""(octet_length(data) > 10000000 OR contains(data, '[') OR contains(data, ']') OR contains(substr(data, 2), '{{')
  OR data RLIKE r'{_VALUE}')"""
_VARIANTS = f"""transform({_whole("variant")}, r -> IF(r IS NULL, NULL,
  named_struct({", ".join(_text(k) for k in RAW_KEYS)}, '__end', CAST(NULL AS STRING))))"""
# Plain lines without the marks of a whole value are read by one cast, not field by field.
_PLAIN_SHAPE = "array<struct<%s, __end string>>" % ", ".join(f"{k} string" for k in RAW_KEYS)
_PLAIN = f"""transform(array(try_variant_get(try_parse_json(concat('[', data, ',{{"__end":"1"}}]')), '$',
  '{_PLAIN_SHAPE}')), a -> IF(size(a) = 2 AND a[1].__end = '1', a[0], NULL))"""
_RECORD = f"IF({_NOT_PLAIN}, {_VARIANTS}, {_PLAIN})"
_OBJECT_START = r"data RLIKE '^\\s*\\{'"


def record_or_null() -> Column:
    """The record of a valid object line, else NULL."""
    return F.expr(f"({_RECORD})[0]")


def each_record() -> Column:
    """Generator: one row per valid object line, none for any other line. A generator keeps
    the optimizer from repeating the parse in a filter below the projection."""
    return F.expr(f"explode(filter({_RECORD}, r -> r IS NOT NULL))")


def each_record_lenient() -> Column:
    """Generator: one row per line that starts an object; unreadable ones give a NULL record."""
    return F.expr(f"explode(filter({_RECORD}, r -> {_OBJECT_START}))")


def is_json(text: Column) -> Column:
    """Whether a text is one complete JSON value of any kind. It is read as the first of two
    elements; only if it is a whole value is the second one the end mark. The mark contains a
    digest of the text, so no text can hold its own mark."""
    mark = F.concat(F.lit("end:"), F.md5(text))
    both = F.from_json(
        F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')),
        "array<string>",
        {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"},
    )
    return F.coalesce((F.size(both) == 2) & (F.get(both, 1) == mark), F.lit(False))
