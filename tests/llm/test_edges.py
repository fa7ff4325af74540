"""Nulls, empty and very long texts, ties, repeated rows, clashing columns, empty tables."""

import base64
import hashlib
import io
import random
import re

import pytest
from pyspark.sql import functions as F

from logledger.llm import chat, decontaminate, hosts, quality_rules, warc

LONG = " ".join(f"w{i % 700}" for i in range(20_000))
TEXTS = [None, "", " \n\t", "one", LONG, "The cat\nThe cat\n\n#a $b <c>", "a b c d e f g h " * 4, "É é"]


def docs_frame(spark, texts=TEXTS):
    rows = [(i if i else None, t, "x", 1) for i, t in enumerate(texts)] + [(3, "one", "x", 1)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, stats string, n_words int")


# -- quality rules


def brute_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


def test_quality_counts(spark):
    labels = spark.createDataFrame([(1, 0), (None, 1), (2, None)], "doc_id bigint, quality int")
    got = quality_rules.quality_verdicts(docs_frame(spark), labels).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        n, *rest = brute_stats(TEXTS[r.doc_id or 0])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *rest)
        assert r.base_failed == (n < 20 or 100 * rest[-1] > 30 * n)
        assert r.kept == (not r.base_failed)  # two labels teach no rule
    empty = docs_frame(spark).limit(0)
    assert quality_rules.quality_verdicts(empty, labels.limit(0)).count() == 0


def test_rules_are_learned_and_keep_good_rows(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    rows, labels = [], []
    for i in range(900):
        words = [word() for _ in range(rng.randint(25, 60))]
        bad = i % 3 == 0
        if bad and i % 2:
            words = [w + "$#" for w in words]
        elif bad:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words), "k"))
        labels.append((i, 0 if bad else 1))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _stats string")
    known = spark.createDataFrame(labels[:600], "doc_id bigint, quality int")
    got = {r.doc_id: r.kept for r in quality_rules.quality_verdicts(docs, known).collect()}
    held_out = [(got[i], q) for i, q in labels[600:]]
    assert all(kept for kept, q in held_out if q) and not any(kept for kept, q in held_out if not q)
    kept = quality_rules.keep_good(docs, known)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, k in got.items() if k}


# -- decontamination


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_hits(text, items):
    words, hit, found = words_of(text), set(), set()
    for item_id, item in items:
        own = words_of(item)
        n = min(10, len(own))
        wins = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in wins:
                hit.update(range(i, i + n))
                found.add(item_id)
    return len(words), len(hit), found - {None}


ITEMS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "É b"), (3, "solo"),
    (4, None), (5, " ,. "), (6, "the the the the the the the the the the the"), (7, "É b"),
    (None, "nobody here"), (12, "x y z"),
]


@pytest.mark.parametrize("rows", [200_000, 0])
def test_contamination(spark, monkeypatch, rows):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", rows)
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", rows)
    texts = [
        None, "", "nothing", "solo, SOLO", "é b É b", "the " * 30, "nobody-here x y", "x y z x y z w",
        "alpha BETA gamma delta epsilon zeta eta theta iota kappa", "alpha beta gamma delta " * 9,
        "q " * 4000 + ITEMS[0][1] + " q" * 4000, ITEMS[0][1] + " " + ITEMS[0][1],
    ]
    docs = spark.createDataFrame(
        [(i if i else None, t, 5, "s") for i, t in enumerate(texts)] + [(3, texts[3], 5, "s")],
        "doc_id bigint, text string, h3 int, digest string",
    )
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = decontaminate.contamination(docs, items).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        n, hit, found = brute_hits(texts[r.doc_id or 0], ITEMS)
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (
            n, hit, len(found), digest, hit > 0
        ), texts[r.doc_id or 0]
    clean = decontaminate.clean_documents(docs, items)
    assert clean.columns == docs.columns
    assert sorted(r.text or "" for r in clean.collect()) == sorted(
        t or "" for t in texts if not brute_hits(t, ITEMS)[1]
    )
    nothing = decontaminate.contamination(docs, items.limit(0)).collect()
    assert not any(r.contaminated for r in nothing) and len(nothing) == len(texts) + 1
    assert decontaminate.contamination(docs.limit(0), items).count() == 0


# -- chat

TURNS = [
    (1, 0, "system", None), (1, 1, "user", r"<|end|> \<|start|> \\"), (1, 2, "assistant", "[INST] <s> </s> <<SYS>>"),
    (1, 2, "assistant", "a tie"), (2, 5, None, "x"), (2, None, "assistant", ""), (None, 1, "assistant", "é\n" * 5),
    (3, 1, "<|text|>", "role"), (4, 1, "assistant", LONG), (4, 1, "assistant", LONG),
]


def test_chat_round_trip(spark):
    rows = spark.createDataFrame([(*t, "k") for t in TURNS], "conv_id bigint, turn bigint, role string, text string, parts string")
    got = {r.conv_id: r for r in chat.chat_digest(rows).collect()}
    probe = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    turns = [(c, t, r or "", x or "") for c, t, r, x in TURNS + probe]
    assert set(got) == {t[0] for t in turns}
    for conv, r in got.items():
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2:]))
        text = "".join(f"{role}\n{x}\n" for *_, role, x in own)
        loss = "".join(x for *_, role, x in own if role == "assistant")
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert [r.conv_id for r in chat.chat_digest(rows.limit(0)).collect()] == [-1]


def test_parts_become_placeholders(spark):
    parts = [
        ("text", "see <|x", None, None, None, None, None), ("image", None, "s3://i", 56, 57, None, None),
        ("audio", None, "a", None, None, 2.5, None), ("document", None, "d", None, None, None, 3),
        ("odd", None, "o", None, None, None, None), (None, "end", None, None, None, None, None),
        ("image", None, None, None, None, None, None),
    ]
    rows = spark.createDataFrame([(1, 1, "assistant", parts), (1, 2, "user", None)], f"conv_id bigint, turn bigint, role string, parts array<struct<{chat.PART.replace(' ', ':').replace(',:', ',')}>>")
    out = chat.format_turns(rows).orderBy("turn").collect()
    body = r"see <\|x<|image:2|><|audio:3|><|document:4|><|other:5|>end<|image:7|>"
    assert out[0].formatted == f"<|start|>assistant<|text|>{body}<|end|>"
    at, n = out[0].loss_start, out[0].loss_length
    assert out[0].formatted[at : at + n] == body
    assert [tuple(a) for a in out[0].attachments] == [
        (2, "image", "s3://i", 6), (3, "audio", "a", 63), (4, "document", "d", 1800), (5, "other", "o", 1),
        (7, "image", None, 1),
    ]
    assert out[0].n_expanded == 1871 and out[1].formatted == "<|start|>user<|text|><|end|>"
    back = chat.read_turns(chat.format_turns(rows)).orderBy("turn").first()
    assert back.text == "see <|xend" == back.loss_text


# -- WARC


def test_seek_table_finds_each_frame(monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 300)
    out = io.BytesIO()
    out.close = lambda: None
    bundle = warc.Bundle(out)
    payloads = [bytes([65 + i]) * (i * 37) for i in range(30)]
    places = [bundle.add(warc.record(i, "http://x/\r\n" * (i % 2), p, None)) for i, p in enumerate(payloads)]
    bundle.close()
    reader = warc.BundleReader(out)
    assert len(reader.places) > 5
    for i in random.Random(1).sample(range(30), 30):
        frame, at, n = places[i]
        head, http, payload = warc.parse(reader.frame(frame)[at : at + n])
        assert payload == payloads[i] and head["warc-record-id"] == f"<urn:page:{i}>"


def test_warc(spark):
    html = [None, "", "a", "a", "b" * 700_000, "a", "é\r\n\r\nx", "c", "c"]
    rows = [(i, "http://h/é\n", h, "k") for i, h in enumerate(html)]
    rows += [(2, None, "a", "k"), (None, "u", "b" * 700_000, "k"), (None, "u", "only", "k"), (None, "u", "only", "k")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, sha string")
    got = warc.warc_digest(pages.repartition(2)).collect()
    expected = []
    for page_id, _, h, _ in rows:
        data = (h or "").encode()
        ids = [p for p, _, x, _ in rows if (x or "") == (h or "") and p is not None]
        first = min(ids, default=None)
        own = first is None or page_id == first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected.append((page_id, len(data), digest, "response" if own else "revisit", None if own else first))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    assert warc.warc_digest(pages.limit(0)).count() == 0


# -- URL filters


def test_rules_and_propagation(spark):
    link = '<a href="https://{}/x">'.format
    rows = [
        (0, "http://good.org/a", link("Friend.net")), (1, "http://friend.net/", link("second.net") + " spam.net"),
        (2, "http://second.net", None), (3, "http://x.com/de/1", ""), (4, "http://spam.net/1", link("x.com")),
        (5, None, None), (6, "no scheme", ""), (7, "http://a.example.org/es/1?q", ""), (8, "http://A.EXAMPLE.org/en/12#x", ""),
        (9, "http://example.org", ""), (9, "ftp://lone.net?x://y", ""), (None, "http://good.org/b", "friend.net"),
        (10, "http://example.organic/", ""), (11, "http://a..com/fr/", None),
    ]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id bigint, url string, html string, host string")
    got = hosts.judge_urls(pages.select("page_id", "url", "html"), hosts.rule_table(spark)).collect()
    assert len(got) == len(rows)
    found = {(r.page_id, r.host): (r.path, r.rule, r.verdict) for r in got}
    assert found[0, "good.org"] == ("/a", "org/", "allow")
    assert found[1, "friend.net"] == ("/", None, "allow")
    assert found[4, "spam.net"] == ("/1", None, "block")
    assert found[3, "x.com"] == ("/de/1", "com/de/", "block")
    assert found[5, ""] == found[6, ""] == ("", None, "allow")
    assert found[7, "a.example.org"] == ("/es/1", "example.org/es/", "block")
    assert found[8, "a.example.org"] == ("/en/12", "example.org/en/1", "block")
    # No path, so no rule fits; a host that is mostly unknown goes by its links.
    assert found[9, "example.org"][:2] == ("", None) and found[9, "lone.net"] == ("", None, "allow")
    assert found[10, "example.organic"] == ("/", None, "allow")
    assert found[11, "a..com"] == ("/fr/", "com/fr/", "allow")
    empty = hosts.judge_urls(pages.limit(0), hosts.rule_table(spark))
    assert empty.count() == 0


def test_scores_against_a_plain_account(spark):
    rng = random.Random(4)
    edges = {(f"h{rng.randrange(12)}", f"h{rng.randrange(12)}") for _ in range(40)}
    edges = {(a, b) for a, b in edges if a != b}
    seeds = {f"h{i}": (rng.random(), rng.random() * (i % 2)) for i in range(0, 12, 3)}

    def flow(ways, start):
        now = {k: 0.15 * v for k, v in start.items()}
        for _ in range(10):
            new = {k: 0.15 * v for k, v in start.items()}
            for a, b in ways:
                new[b] = new.get(b, 0) + 0.85 * now.get(a, 0) / sum(x == a for x, _ in ways)
            now = new
        return now

    trust = flow(edges, {k: v[0] for k, v in seeds.items()})
    distrust = flow({(b, a) for a, b in edges}, {k: v[1] for k, v in seeds.items()})
    frame = spark.createDataFrame(list(edges), "src string, dst string")
    start = spark.createDataFrame([(k, *v) for k, v in seeds.items()], "host string, trust double, distrust double")
    for r in hosts.propagate(frame, start, hosts.Flow(rounds=10)).collect():
        assert r.trust == pytest.approx(trust.get(r.host, 0), abs=1e-9)
        assert r.distrust == pytest.approx(distrust.get(r.host, 0), abs=1e-9)


def test_filters_on_computed_columns_are_computed_once(spark):
    frame = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    plan = quality_rules.keep_good(frame, spark.createDataFrame([], "doc_id bigint, quality int"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("xxhash64") <= 3 and F is not None
