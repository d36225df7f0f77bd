"""URL filters: rules first, then link-graph propagation per host.

Rules name a host and a path; a rule fits the host and its subdomains when
the url's path starts with the rule's, and the longest fitting rule decides.

Urls without a rule take the verdict of their host.  The share of a host's
pages that rules allow is its trust seed, the share they block its distrust
seed.  Trust follows links (personalised PageRank: a linked host takes its
part of the linking host's trust), distrust runs against them (a host that
links to distrusted hosts takes its part of theirs).  After a fixed number of
rounds a host is blocked when its distrust is above its trust and at least
`threshold` times what a wholly blocked host holds by its own seed.

Scores are integers in units of 1 / SCALE and every term is rounded down
before it is summed, so the result does not depend on the order of a sum.

Links are reduced to counted host pairs in each task before they are
shuffled; one round is one join and one aggregate over host pairs, written to
the shared folder.  Join inputs are plain files, so adaptive execution can
split a host that holds a third of the pages or links.

Defined results
---------------
* A null url, or one without `://`, has empty host and path, no rule, and the
  verdict allow.
* Null html has no links; links of a host to itself and relative links are
  no edges.
* A repeated page row is judged each time and counts each time.
* An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut, drop_cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)href\s*=\s*["']?(?:https?:)?//([^/?#"'\s<>]+)"""
SCALE = 1_000_000_000


def after_scheme(url: Column) -> Column:
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.char_length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def match_rules(urls: DataFrame, rules: DataFrame, broadcast_rows: int = 100_000) -> DataFrame:
    """`url, host, path` and `rules (host, path, verdict)` -> `url, rule,
    rule_verdict` for the urls that a rule fits.

    Each url looks its host and parent domains up in the rules.  The rules
    are broadcast up to `broadcast_rows` rows, shuffled beyond that.
    """
    r = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    if rules.count() <= broadcast_rows:
        r = F.broadcast(r)
    labels = F.split("host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    candidates = urls.select("url", "path", F.explode(F.array_distinct(domains)).alias("rule_host"))
    fitting = (candidates.join(r, "rule_host").where(F.expr("startswith(path, rule_path)"))
               .select("url", F.concat("rule_host", "rule_path").alias("rule"), "verdict"))
    best = F.max(F.struct(F.char_length("rule").alias("n"), "rule", "verdict")).alias("best")
    return fitting.groupBy("url").agg(best).select("url", "best.rule", F.col("best.verdict").alias("rule_verdict"))


def host_edges(pages: DataFrame) -> DataFrame:
    """Counted links between different hosts: `src, dst, links`."""
    links = pages.select(host_of(F.col("url")).alias("src"),
                         F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("dst"))
    return (links.select("src", F.translate("dst", UPPER, LOWER).alias("dst"))
            .where("src <> '' AND src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links")))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int = 10) -> DataFrame:
    """`edges (src, dst, links)`, `seeds (host, trust, distrust)` with shares
    from 0 to 1 -> `host, trust, distrust` as integers in 1 / SCALE."""
    edges = cut(edges, "host-edges")
    outgoing = cut(edges.groupBy("src").agg(F.sum("links").alias("total")), "host-out")
    incoming = cut(edges.groupBy("dst").agg(F.sum("links").alias("total")), "host-in")
    part = F.col("links").cast("double") / F.col("total") * F.lit(damping)
    flow = cut(
        edges.join(outgoing, "src").select(F.col("src").alias("host"), F.lit(0).alias("kind"), F.col("dst").alias("to"), part.alias("part"))
        .union(edges.join(incoming, "dst").select(F.col("dst").alias("host"), F.lit(1).alias("kind"), F.col("src").alias("to"), part.alias("part"))),
        "host-flow")
    own = F.floor(F.col("share") * F.lit((1 - damping) * SCALE)).cast("bigint")
    start = cut(seeds.select("host", F.expr("stack(2, 0, trust, 1, distrust) AS (kind, share)"))
                .select("host", "kind", own.alias("score")).where("score > 0"), "host-seeds")
    scores = start
    for _ in range(rounds if edges.limit(1).count() else 0):
        moved = flow.join(scores, ["host", "kind"]).select(
            F.col("to").alias("host"), "kind", F.floor(F.col("score").cast("double") * F.col("part")).cast("bigint").alias("score"))
        now = cut(moved.union(start).groupBy("host", "kind").agg(F.sum("score").alias("score")).where("score > 0"),
                  "host-scores")
        if scores is not start:
            drop_cut(scores)
        scores = now
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(F.lit(0)))
    return scores.groupBy("host").agg(of(0).alias("trust"), of(1).alias("distrust"))


def judge(pages: DataFrame, rules: DataFrame, damping: float = 0.85, rounds: int = 10,
          threshold: float = 0.5) -> DataFrame:
    """`page_id, host, path, rule, verdict, trust, distrust` of every page."""
    split = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    split = cut(split, "page-urls")
    ruled = cut(match_rules(split.where("host <> ''").select("url", "host", "path").distinct(), rules), "page-rules")
    judged = cut(split.join(ruled, "url", "left"), "page-ruled")
    seeds = (judged.where("host <> ''").groupBy("host")
             .agg(F.sum(F.col("rule_verdict").eqNullSafe("allow").cast("long")).alias("allowed"),
                  F.sum(F.col("rule_verdict").eqNullSafe("block").cast("long")).alias("blocked"),
                  F.count(F.lit(1)).alias("n"))
             .select("host", (F.col("allowed").cast("double") / F.col("n")).alias("trust"),
                     (F.col("blocked").cast("double") / F.col("n")).alias("distrust")))
    least = int(threshold * (1 - damping) * SCALE)
    hosts = cut(propagate(host_edges(pages), seeds, damping, rounds), "host-trust")
    distrusted = (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= least)
    method = F.when(distrusted, F.lit("block")).otherwise(F.lit("allow"))
    return judged.join(hosts, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", method).alias("verdict"),
        F.coalesce("trust", F.lit(0)).alias("trust"), F.coalesce("distrust", F.lit(0)).alias("distrust"))


def oracle(rules: list[tuple[str, str, str]], damping: float = 0.85, rounds: int = 10, threshold: float = 0.5) -> str:
    """The same in DuckDB: matching by a plain join, the rounds written out."""
    table = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    rest = "CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END"
    steps = "".join(f""", s{k + 1} AS (
  SELECT host, kind, sum(score)::BIGINT AS score FROM (
    SELECT f."to" AS host, f.kind, floor(s.score::DOUBLE * f.part)::BIGINT AS score
    FROM flow f JOIN s{k} s ON s.host = f.host AND s.kind = f.kind
    UNION ALL SELECT * FROM s0) x GROUP BY ALL HAVING sum(score) > 0)""" for k in range(rounds))
    link = LINK.replace("'", "''")
    return f"""
WITH rules(rh, rp, rv) AS (VALUES {table}),
split AS (
  SELECT page_id, url, html, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, url, html, coalesce({rest}, '') AS rest FROM pages) p),
best AS (
  SELECT host, path, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS rv
  FROM (SELECT DISTINCT host, path FROM split WHERE host <> '') u
  JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
  GROUP BY ALL),
judged AS (SELECT s.page_id, s.host, s.path, b.rule, b.rv FROM split s LEFT JOIN best b ON s.host = b.host AND s.path = b.path),
edges AS (
  SELECT src, dst, count(*) AS links
  FROM (SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)), '{UPPER}', '{LOWER}') AS dst FROM split) x
  WHERE src <> '' AND src <> dst GROUP BY ALL),
flow AS (
  SELECT src AS host, 0 AS kind, dst AS "to", links::DOUBLE / sum(links) OVER (PARTITION BY src) * {damping} AS part FROM edges
  UNION ALL
  SELECT dst, 1, src, links::DOUBLE / sum(links) OVER (PARTITION BY dst) * {damping} FROM edges),
seeds AS (
  SELECT host, count(*) FILTER (rv = 'allow')::DOUBLE / count(*) AS trust, count(*) FILTER (rv = 'block')::DOUBLE / count(*) AS distrust
  FROM judged WHERE host <> '' GROUP BY host),
s0 AS (
  SELECT * FROM (
    SELECT host, 0 AS kind, floor(trust * {(1 - damping) * SCALE}::DOUBLE)::BIGINT AS score FROM seeds
    UNION ALL SELECT host, 1, floor(distrust * {(1 - damping) * SCALE}::DOUBLE)::BIGINT FROM seeds) x
  WHERE score > 0){steps},
hosts AS (
  SELECT host, coalesce(sum(score) FILTER (kind = 0), 0) AS trust, coalesce(sum(score) FILTER (kind = 1), 0) AS distrust
  FROM s{rounds} GROUP BY host)
SELECT page_id, j.host, path, rule,
       coalesce(rv, CASE WHEN distrust > trust AND distrust >= {int(threshold * (1 - damping) * SCALE)} THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(trust, 0)::BIGINT AS trust, coalesce(distrust, 0)::BIGINT AS distrust
FROM judged j LEFT JOIN hosts h ON j.host = h.host
"""
