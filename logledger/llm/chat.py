"""Chat formatting of typed content parts.

A visitor flattens the parts of a turn in order: text is escaped, and an image, an audio clip
or a document becomes a placeholder with its place among the parts. What it refers to and how
many tokens it expands to are recorded beside the text. A turn is one row of output:

    <|start|>role<|text|>body<|end|>

so a conversation of any length is a run of bounded rows, and the loss mask is a span in each
assistant row. Control strings inside roles and texts get a backslash behind their first
character, and backslashes are doubled: the original comes back exactly.

Null roles and texts are empty. Turns that share a number are ordered by role and text, rows
without a turn number come first, rows without a conversation id form one conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, TEXT, END = "<|start|>", "<|text|>", "<|end|>"
#: Beginnings of control strings of this and other usual templates.
CONTROL = r"<(\||/?s>|</?SYS)"
CONTROL_BRACKET = r"\[(/?INST\])"
PART = "type string, text string, ref string, width int, height int, seconds double, pages int"
IMAGE_PATCH = 28
AUDIO_TOKENS_PER_SECOND = 25
TOKENS_PER_PAGE = 600


def escaped(text: Column) -> Column:
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    text = F.regexp_replace(text, CONTROL, r"<\\$1")
    return F.regexp_replace(text, CONTROL_BRACKET, r"[\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


class PartVisitor:
    """One method per type of part; each gives what stands in the text, the reference and the
    number of tokens it expands to (0 for text, which is counted as text)."""

    def visit(self, part: Column, place: Column) -> Column:
        kind = F.coalesce(part["type"], F.lit("text"))
        case = F.when(kind == "text", self.text(part))
        for name in ("image", "audio", "document"):
            case = case.when(kind == name, getattr(self, name)(part, place))
        return case.otherwise(self.other(part, place))

    def made(self, body: Column, kind: str | None, ref: Column | None, tokens: Column) -> Column:
        return F.struct(
            body.alias("body"),
            F.lit(kind).cast("string").alias("type"),
            (F.lit(None) if ref is None else ref).cast("string").alias("ref"),
            F.coalesce(tokens, F.lit(1)).cast("bigint").alias("n_tokens"),
        )

    def placeholder(self, kind: str, place: Column) -> Column:
        return F.concat(F.lit(f"<|{kind}:"), (place + 1).cast("string"), F.lit("|>"))

    def text(self, part: Column) -> Column:
        return self.made(escaped(part["text"]), None, None, F.lit(0))

    def image(self, part: Column, place: Column) -> Column:
        tokens = F.ceil(part["width"] / IMAGE_PATCH) * F.ceil(part["height"] / IMAGE_PATCH)
        return self.made(self.placeholder("image", place), "image", part["ref"], tokens)

    def audio(self, part: Column, place: Column) -> Column:
        tokens = F.ceil(part["seconds"] * AUDIO_TOKENS_PER_SECOND)
        return self.made(self.placeholder("audio", place), "audio", part["ref"], tokens)

    def document(self, part: Column, place: Column) -> Column:
        tokens = part["pages"] * TOKENS_PER_PAGE
        return self.made(self.placeholder("document", place), "document", part["ref"], tokens)

    def other(self, part: Column, place: Column) -> Column:
        """Unknown types keep their place and reference."""
        return self.made(self.placeholder("other", place), "other", part["ref"], F.lit(1))


def text_part(text: Column) -> Column:
    """A list with one text part."""
    names = [c.split() for c in PART.split(", ")]
    values = {"type": F.lit("text"), "text": text}
    return F.array(
        F.struct(*[values.get(n, F.lit(None)).cast(kind).alias(n) for n, kind in names])
    )


def format_turns(turns: DataFrame, visitor: PartVisitor = PartVisitor()) -> DataFrame:
    """(conv_id, turn, role, parts) -> (conv_id, turn, formatted, loss_start, loss_length,
    attachments, n_expanded). The loss span counts code points of ``formatted``."""
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.transform(F.coalesce("parts", text_part(F.lit(""))), visitor.visit).alias("flat"),
    )
    rows = rows.withColumn("body", F.array_join(F.transform("flat", lambda p: p["body"]), ""))
    head = F.concat(F.lit(START), escaped(F.col("role")), F.lit(TEXT))
    assistant = F.col("role") == "assistant"
    attachment = F.transform(
        "flat",
        lambda p, i: F.struct(
            (i + 1).alias("place"), p["type"].alias("type"), p["ref"].alias("ref"), p["n_tokens"].alias("n_tokens")
        ),
    )
    return rows.select(
        "conv_id",
        "turn",
        F.concat(head, "body", F.lit(END)).alias("formatted"),
        F.when(assistant, F.length(head)).cast("bigint").alias("loss_start"),
        F.when(assistant, F.length("body")).cast("bigint").alias("loss_length"),
        F.filter(attachment, lambda a: a["type"].isNotNull()).alias("attachments"),
        F.aggregate("flat", F.lit(0).cast("bigint"), lambda a, p: a + p["n_tokens"]).alias(
            "n_expanded"
        ),
    )


def read_turns(formatted: DataFrame) -> DataFrame:
    """Back from the output: (conv_id, turn, role, text, loss_text, n_chars). ``text`` holds
    the text parts; placeholders are dropped from it."""
    whole = F.col("formatted")
    cut = F.locate(TEXT, whole)
    role = F.substring(whole, F.lit(len(START) + 1), cut - len(START) - 1)
    first = cut + len(TEXT)
    body = F.substring(whole, first, F.length(whole) - len(END) - first + 1)
    spoken = F.substring(whole, (F.col("loss_start") + 1).cast("int"), F.col("loss_length").cast("int"))
    plain = lambda x: unescaped(F.regexp_replace(x, r"<\|[a-z]+:\d+\|>", ""))
    return formatted.select(
        "conv_id",
        "turn",
        unescaped(role).alias("role"),
        plain(body).alias("text"),
        plain(spoken).alias("loss_text"),
        F.length(whole).cast("bigint").alias("n_chars"),
    )


_DIGEST = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
    "loss_sha256 string, formatted_chars bigint"
)


def _digest_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation: only the running digests of one are held."""
    names = [c.split()[0] for c in _DIGEST.split(", ")]
    done: list[tuple] = []
    now = state = None

    def finish() -> tuple:
        n, turns, loss_chars, loss, chars = state
        return now[0], n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

    def flush() -> pa.RecordBatch:
        kinds = [pa.string() if "sha" in n else pa.int64() for n in names]
        columns = zip(*done, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )

    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("conv_id", "role", "text", "loss_text", "n_chars"))
        for conv, role, text, loss, chars in zip(*columns, strict=True):
            if now != (conv,):
                if now:
                    done.append(finish())
                now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode())
            if loss is not None:
                state[2] += len(loss)
                state[3].update(loss.encode())
            state[4] += chars
        if len(done) >= 1000:
            yield flush()
            done = []
    if now:
        done.append(finish())
    if done:
        yield flush()


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the formatted rows: number of turns, digest of roles and texts,
    length and digest of the text under the loss mask, formatted length. A digest needs its
    conversation in order: it streams through one task, a few turns in memory at a time."""
    rows = read_turns(formatted).repartition("conv_id")
    rows = rows.sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(_digest_task, _DIGEST)


def chat_digest(conversations: DataFrame) -> DataFrame:
    turns = conversations.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text"
    )
    probe = [(-1, k, role, "</s>[INST] ok [/INST]") for k, role in enumerate(("user", "assistant"))]
    extra = turns.sparkSession.createDataFrame(probe, "conv_id bigint, turn bigint, role string, text string")
    parts = turns.unionByName(extra).withColumn("parts", text_part(F.col("text")))
    return conversation_digests(format_turns(parts))


SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
shown AS (
  SELECT *, len(regexp_replace(regexp_replace(replace(role || chr(0) || text, '\', '\\'),
      '<(\||/?s>|</?SYS)', '<\\\1', 'g'), '\[(/?INST\])', '[\\\1', 'g')) - 1 AS own
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(own + 24) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id
"""
