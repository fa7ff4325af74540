"""Trust and distrust that travel further than ten links."""

import random

import duckdb
import pytest

from logledger.llm import hosts


def test_a_long_chain_to_a_blocked_host_is_blocked(spark):
    rows = [(i, f"http://h{i}.net/", f'<a href="http://h{i + 1}.net/">') for i in range(25)]
    rows += [(25, "http://h25.net/", '<a href="http://bad.com/">'), (26, "http://bad.com/de/1", "")]
    pages = spark.createDataFrame([*rows, (27, "http://lone.net/", "")], "page_id bigint, url string, html string")
    got = {r.page_id: r.verdict for r in hosts.judge_urls(pages, hosts.rule_table(spark)).collect()}
    assert got == {i: "allow" if i == 27 else "block" for i in range(28)}


def linked_pages():
    """Chains of 25 hosts to a blocked and to an allowed host, a ring between them, hosts at
    which trust and distrust meet, and one with neither."""
    pages = [(f"http://b{i}.net/", f'<a href="http://b{i + 1}.net/">') for i in range(25)]
    pages += [("http://b25.net/", '<a href="http://bad.com/x">'), ("http://bad.com/de/1", "")]
    pages += [("http://good.org/", '<a href="http://g0.net/">')]
    pages += [(f"http://g{i}.net/", f"see g{i + 1}.net and http://g{(i * 7) % 25}.net") for i in range(25)]
    pages += [("http://g25.net/", '<a href="http://b3.net/">'), ("http://b9.net/", '<a href="http://g2.net/">')]
    # Equal trust and distrust allow: the host is both linked from and links to its own kind.
    pages += [("http://both.net/", ""), (None, None), ("http://lone.net/", ""), ("no address", "x")]
    pages += [("http://long.net/", "word " * 200_000 + '<a href="http://bad.com/">')]
    return [(i, *p) for i, p in enumerate(pages)]


@pytest.mark.parametrize("flow", [hosts.Flow(), hosts.Flow(rounds=10)])
def test_query_and_sql_agree_on_a_linked_graph(spark, flow):
    frame = spark.createDataFrame(linked_pages(), "page_id bigint, url string, html string")
    names = ["page_id", "host", "path", "rule", "verdict"]
    got = hosts.judge_urls(frame, hosts.rule_table(spark), flow).select(names)
    got = {tuple(r) for r in got.collect()}
    db = duckdb.connect()
    db.sql("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    db.executemany("INSERT INTO pages VALUES (?, ?, ?)", linked_pages())
    rows = db.sql(f"SELECT {', '.join(names)} FROM ({hosts.sql(flow=flow)})").fetchall()
    assert len(rows) == len(linked_pages()) and set(rows) == got
    verdict = {r[1]: r[4] for r in rows}
    assert verdict["long.net"] == "block" and verdict["lone.net"] == "allow"
    # The far end of the chain is further than ten links from the blocked host.
    assert verdict["b24.net"] == "block"
    assert verdict["b0.net"] == ("block" if flow.rounds is None else "allow")


def test_equal_trust_and_distrust_allow(spark):
    pages = [(0, "http://good.org/", "http://mid.net"), (1, "http://mid.net/", "http://bad.com/")]
    pages += [(2, "http://bad.com/de/", "")]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    row = hosts.judge_urls(frame, hosts.rule_table(spark)).filter("page_id = 1").first()
    assert row.trust == row.distrust > 0 and row.verdict == "allow"


def test_converged_scores_solve_the_equations(spark):
    rng = random.Random(4)
    edges = {(f"h{rng.randrange(12)}", f"h{rng.randrange(12)}") for _ in range(40)}
    edges = sorted((a, b) for a, b in edges if a != b)
    seeds = {f"h{i}": rng.random() for i in range(0, 12, 3)}
    frame = spark.createDataFrame(edges, "src string, dst string")
    start = spark.createDataFrame([(k, v, 0.0) for k, v in seeds.items()], "host string, trust double, distrust double")
    got = {r.host: r.trust for r in hosts.propagate(frame, start, hosts.CONVERGED).collect()}
    for host, score in got.items():
        into = sum(0.85 * got.get(a, 0) / sum(x == a for x, _ in edges) for a, b in edges if b == host)
        assert score == pytest.approx(0.15 * seeds.get(host, 0) + into, abs=2e-9)
