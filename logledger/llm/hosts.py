"""URL filters: rules for hosts and paths, and link-graph propagation where no rule fits.

A rule is a host and the beginning of a path; it fits its host and all subdomains, and the
longest one wins. Hosts that rules allow or block are seeds, weighted by the share of their
pages. Over edges between hosts trust flows along links (personalised PageRank from allowed
seeds) and distrust against them, from blocked seeds to those who link to them. A host whose
distrust exceeds its trust is blocked; one that nothing is known of is allowed.

Edges are links with a full address, and host names of other pages in the html. They are
counted once per pair of hosts before anything is joined, each round is one join with a unique
side and one partially aggregated sum, so a host that very many pages share or name is no hot
key. A null url, or one without ``://``, has an empty host and path; such pages take no part in
the graph and are allowed unless a rule says otherwise. Null html names nobody. Rows are judged
one by one: page ids may be null or repeated. Equal trust and distrust allow. No pages give no
rows. The whole html is searched, however long. Columns beyond page_id, url and html are not
looked at, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logledger.llm.staging import stored

ALLOW, BLOCK = "allow", "block"
#: The rules of the query.
RULES = (
    ("org/", ALLOW),
    ("example.org/es/", BLOCK),
    ("example.org/en/1", BLOCK),
    ("com/fr/", ALLOW),
    ("com/de/", BLOCK),
)
BROADCAST_ROWS = 200_000
LINK = r"://([^/?#\s\"'<>]+)"
NAME = r"(?<![A-Za-z0-9-])((?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Flow:
    """
    damping   share of a host's score that flows on
    rounds    what is left after so many is below damping ** rounds of the seeds; None goes on
              until a round adds at most ``tolerance`` to the sum of all scores
    decimals  scores are compared after rounding, so that the order of sums does not matter
    """

    damping: float = 0.85
    rounds: int | None = None
    decimals: int = 10
    tolerance: float = 1e-10


#: Scores that more rounds do not change: what a round adds shrinks by the damping each time.
CONVERGED = Flow()
#: Rounds between tables.
_BLOCK = 5


def _lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def with_host(pages: DataFrame) -> DataFrame:
    """(page_id, html, host, path)."""
    pattern = r"(?s)://([^/?#]*)([^?#]*)"
    url = F.coalesce("url", F.lit(""))
    return pages.select(
        "page_id",
        "html",
        _lowered(F.regexp_extract(url, pattern, 1)).alias("host"),
        F.regexp_extract(url, pattern, 2).alias("path"),
    )


def rule_table(spark, rules=RULES) -> DataFrame:
    rows = [(r, r.split("/", 1)[0], "/" + r.split("/", 1)[1], v) for r, v in rules]
    return spark.createDataFrame(rows, "rule string, rule_host string, rule_path string, ruled string")


def _small(frame: DataFrame) -> DataFrame:
    return F.broadcast(frame) if frame.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else frame


def fitting_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct (host, path) -> the longest rule that fits and what it says. Hosts are joined
    by each of their parents, an equi-join however many rules there are."""
    parents = F.expr(
        "transform(sequence(1, size(split(host, '[.]'))), i -> substring_index(host, '.', -i))"
    )
    found = places.select("host", "path", F.explode(parents).alias("rule_host")).join(
        _small(rules), "rule_host"
    )
    return (
        found.filter(F.col("path").startswith(F.col("rule_path")))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule"), "ruled", "rule")).alias("best"))
        .select("host", "path", "best.rule", "best.ruled")
    )


def _hosts(html: Column, pattern: str) -> Column:
    found = F.array_distinct(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)))
    return F.transform(found, _lowered)


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst), each pair once, no host to itself."""
    html = F.coalesce("html", F.lit(""))
    named = pages.filter("host <> ''").select(
        F.col("host").alias("src"),
        _hosts(html, LINK).alias("links"),
        _hosts(html, NAME).alias("names"),
    )
    links = named.select("src", F.explode("links").alias("dst")).distinct()
    names = named.select("src", F.explode("names").alias("dst")).distinct()
    hosts = pages.filter("host <> ''").select(F.col("host").alias("dst")).distinct()
    return links.union(names.join(hosts, "dst", "left_semi").select("src", "dst")).distinct().filter(
        "src <> dst"
    )


def propagate(edges: DataFrame, seeds: DataFrame, flow: Flow = Flow()) -> DataFrame:
    """``seeds`` (host, trust, distrust) -> (host, trust, distrust) for every host reached.
    Both flows run in one table, distrust over the edges turned around."""
    both = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b")).union(
        edges.select(F.lit("distrust"), "dst", "src")
    )
    fan = both.groupBy("kind", "a").agg((flow.damping / F.count("*")).alias("share"))
    ways = stored(both.join(fan, ["kind", "a"]), "ways")
    start = seeds.select(
        "host",
        F.explode(
            F.array(
                F.struct(F.lit("trust").alias("kind"), F.col("trust").alias("score")),
                F.struct(F.lit("distrust").alias("kind"), F.col("distrust").alias("score")),
            )
        ).alias("s"),
    ).select("s.kind", F.col("host").alias("a"), "s.score")
    start = stored(start.filter("score > 0"), "seeds")
    kept = start.select("kind", "a", ((1 - flow.damping) * F.col("score")).alias("score"))
    now = kept.withColumn("added", F.col("score"))
    step, going = 0, True
    while going:
        step += 1
        moved = now.join(ways, ["kind", "a"]).select(
            "kind",
            F.col("b").alias("a"),
            (F.col("score") * F.col("share")).alias("score"),
            (F.col("added") * F.col("share")).alias("added"),
        )
        # ``added`` is what this round adds: summed on its own, so no rounding hides the end.
        now = (
            moved.unionByName(kept.withColumn("added", F.lit(0.0)))
            .groupBy("kind", "a")
            .agg(F.sum("score").alias("score"), F.sum("added").alias("added"))
        )
        if step % _BLOCK == 0:
            now = stored(now, "scores")
        if flow.rounds is not None:
            going = step < flow.rounds
        elif step % _BLOCK == 0:
            going = (now.agg(F.sum("added")).first()[0] or 0.0) > flow.tolerance
    score = lambda kind: F.round(
        F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0)), flow.decimals
    ).alias(kind)
    return now.groupBy(F.col("a").alias("host")).agg(score("trust"), score("distrust"))


def judge_urls(pages: DataFrame, rules: DataFrame, flow: Flow = CONVERGED) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and the host's trust and
    distrust."""
    rows = with_host(pages)
    places = stored(rows.groupBy("host", "path").agg(F.count("*").alias("n")), "places")
    ruled = stored(places.join(fitting_rules(places, rules), ["host", "path"], "left"), "ruled")
    share = lambda v: (F.sum(F.when(F.col("ruled") == v, F.col("n")).otherwise(0)) / F.sum("n"))
    seeds = ruled.filter("host <> ''").groupBy("host").agg(
        share(ALLOW).alias("trust"), share(BLOCK).alias("distrust")
    )
    scores = propagate(host_edges(rows), seeds, flow)
    # One row per (host, path), then per host, on the right: hot hosts are split freely.
    judged = ruled.select("host", "path", "rule", "ruled").join(scores, "host", "left")
    judged = judged.select(
        "host",
        "path",
        "rule",
        F.coalesce(
            "ruled",
            F.when(F.coalesce("distrust", F.lit(0.0)) > F.coalesce("trust", F.lit(0.0)), BLOCK).otherwise(ALLOW),
        ).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
    return rows.select("page_id", "host", "path").join(stored(judged, "judged"), ["host", "path"]).select(
        "page_id", "host", "path", "rule", "verdict", "trust", "distrust"
    )


def sql(rules=RULES, flow: Flow = Flow()) -> str:
    """The same in SQL. Scores are summed over what each round adds, so the end is the same:
    rounds go on while the last one added more than the tolerance."""
    values = ", ".join(
        f"('{r}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}', '{v}')" for r, v in rules
    )
    going = f"s.total > {flow.tolerance}" if flow.rounds is None else f"s.step < {flow.rounds}"
    return rf"""
WITH RECURSIVE p AS (
  SELECT page_id, coalesce(html, '') AS html,
    translate(regexp_extract(coalesce(url, ''), '(?s)://([^/?#]*)([^?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
rules(rule, rule_host, rule_path, ruled) AS (VALUES {values}),
fit AS (
  SELECT host, path, max({{'n': len(rule), 'ruled': ruled, 'rule': rule}}) AS best
  FROM (SELECT DISTINCT host, path FROM p) JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path),
r AS (SELECT p.*, best.rule AS rule, best.ruled AS ruled FROM p LEFT JOIN fit USING (host, path)),
seeds AS (
  SELECT host, count(*) FILTER (ruled = 'allow') / count(*) AS trust,
    count(*) FILTER (ruled = 'block') / count(*) AS distrust
  FROM r WHERE host <> '' GROUP BY host),
named AS (
  SELECT host AS src, translate(unnest(regexp_extract_all(html, '://([^/?#\s"''<>]+)', 1)), '{_UPPER}', '{_LOWER}') AS dst
  FROM p WHERE host <> ''
  UNION SELECT * FROM (
    SELECT host AS src, translate(unnest(regexp_extract_all(html, '(?:[A-Za-z0-9-]+\.)+[A-Za-z]{{2,}}')), '{_UPPER}', '{_LOWER}') AS dst
    FROM p WHERE host <> '') WHERE dst IN (SELECT host FROM p)),
edges AS (SELECT DISTINCT src, dst FROM named WHERE src <> dst),
turned AS (
  SELECT 'trust' AS kind, src AS a, dst AS b FROM edges
  UNION ALL SELECT 'distrust', dst, src FROM edges),
ways AS (SELECT *, {flow.damping} / count(*) OVER (PARTITION BY kind, a) AS share FROM turned),
s0 AS (
  SELECT 'trust' AS kind, host AS a, {1 - flow.damping} * trust AS score FROM seeds WHERE trust > 0
  UNION ALL SELECT 'distrust', host, {1 - flow.damping} * distrust FROM seeds WHERE distrust > 0),
flow AS (
  SELECT kind, a, score, sum(score) OVER () AS total, 0 AS step FROM s0
  UNION ALL
  SELECT kind, a, score, sum(score) OVER () AS total, step FROM (
    SELECT w.kind, w.b AS a, sum(s.score * w.share) AS score, s.step + 1 AS step
    FROM flow s JOIN ways w ON s.kind = w.kind AND s.a = w.a WHERE {going}
    GROUP BY w.kind, w.b, s.step)),
scores AS (
  SELECT a AS host, round(sum(score) FILTER (kind = 'trust'), {flow.decimals}) AS trust,
    round(sum(score) FILTER (kind = 'distrust'), {flow.decimals}) AS distrust
  FROM flow GROUP BY a)
SELECT page_id, host, path, rule, coalesce(ruled,
  CASE WHEN coalesce(distrust, 0) > coalesce(trust, 0) THEN 'block' ELSE 'allow' END) AS verdict
FROM r LEFT JOIN scores USING (host)
"""
