import base64
import hashlib
import random
import re

from logledger.llm import secrets as S

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.I | re.A,
)


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def shown(spans):
    return ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in spans)


EDGES = [
    None, "", "token=", "token=short", "secret: token: abcdefghijklmnop", "PassWd = 'aaaaaaaaaaaa'",
    "é token=\"aaaaaaaaaaaa\" AKIA" + "A" * 14 + " AKIA" + "B" * 13, "toKen=aaaaaaaaaaaa",
    "0123456789abcdef" * 3 + "g" + "f" * 15, "AKIAAKIA" + "0" * 14, "x" * 50_000 + " api_key:" + "q" * 12,
    "😀api-key=aaaaaaaaaaaa apikey=bbbbbbbbbbbb", " ".join(["token=abcdefghijkl"] * 300),
]


def frame(spark, texts):
    rows = [(i if i else None, t, 7, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint, base string")


def test_base_spans(spark):
    got = {r.doc_id: r for r in S.find_secrets(frame(spark, EDGES)).collect()}
    assert len(got) == len(EDGES)
    for i, text in enumerate(EDGES):
        expected, row = base_spans(text), got[i if i else None]
        assert row.spans == shown(expected), text
        assert row.base_sha256 == hashlib.sha256(shown(expected).encode()).hexdigest()
        assert [row.n_assign, row.n_access, row.n_hex] == [
            sum(k == n for _, k, _ in expected) for n in range(3)
        ]
    assert S.find_secrets(frame(spark, EDGES[:1]).limit(0)).count() == 0


def corpus():
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice(["th", "er", "on", "an", "re", "ti", "es"]) for _ in range(n))
    texts = [" ".join(word(rng.randint(1, 14)) for _ in range(60)) for _ in range(150)]
    keys = [base64.b64encode(rng.randbytes(n)).decode().rstrip("=") for n in (30, 36, 48, 60, 90)]
    return [f"{t} {keys[i]} end" if i < len(keys) else t for i, t in enumerate(texts)], keys


def test_random_strings_are_found_and_plain_words_are_not(spark):
    texts, keys = corpus()
    rows = {r.doc_id: r for r in S.find_secrets(frame(spark, texts)).collect()}
    for i, text in enumerate(texts):
        own = [text[s.start : s.end] for s in rows[i if i else None].span_list if s.kind == "random"]
        if i < len(keys):
            assert own == re.findall(S.CANDIDATE, keys[i]), i
        else:
            assert own == []


def test_redaction(spark):
    texts, keys = corpus()
    texts = texts[: len(keys) + 20] + EDGES
    docs = frame(spark, texts)
    spans = {r.doc_id: [(s.start, s.end) for s in r.span_list] for r in S.find_secrets(docs).collect()}
    out = S.redacted(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    for i, text in enumerate(texts):
        doc_id, expected, at = (i if i else None), "", 0
        for start, end in spans[doc_id]:
            if start >= at:
                expected += text[at:start] + "[SECRET]"
            at = max(at, end)
        if spans[doc_id]:
            assert got[doc_id].text == expected + text[at:]
            assert got[doc_id].n_chars == len(got[doc_id].text)
        else:
            assert got[doc_id].text == text and got[doc_id].n_chars == 7
