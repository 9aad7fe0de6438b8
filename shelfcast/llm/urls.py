"""Operator 4: URL filters by link-graph propagation.

Pages that a path rule decides keep the rule's verdict.  Every host gets a
seed: the share of its pages that rules allow minus the share that they block.
Positive seeds feed a personalised PageRank along host links (trust), negative
ones a PageRank along the reversed links (distrust: who links to blocked hosts
inherits it).  A page without a rule is blocked if its host's distrust exceeds
its trust by ``threshold`` or more.

Scores are not normalised to one: a host that no link touches keeps its seed,
so a host blocked on all its pages scores 1 in distrust.  Links are the
addresses of anchors outside comments, scripts and styles, summed per host
pair before any join.  Each step is one join and one partial sum, lineage is cut every few
steps with ``checkpoint()``, and steps go on until none changes a score by more
than ``residual``.  A step's total change is at most ``damping`` times the one
before, so that point is always reached; no number of steps is set.

Edge cases: a null url or one without ``://`` has empty host and path and no
rule; such pages share the empty host, which carries no links; null html has
no links; links of a host to itself are ignored; repeated pages count each
time and are each returned; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.common import written

#: (host, path, verdict)
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
RESIDUAL = 1e-6  # largest change of a score in the last step
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Comments, scripts and styles hold no links.
NO_LINKS = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
#: Host of the address of an anchor.
LINK = r"""(?i)<a\s(?:[^<>]*\s)?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s<>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1))
    rest = F.when(rest.isNotNull(), F.substr(url, F.length(rest) + 4))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rules_by_host(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """Per host, the rules of the host and its parent domains, longest first."""
    parts = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(parts)),
                         lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    out = hosts.select("host", F.explode(suffix).alias("rule_host"))
    out = out.join(rules, "rule_host")
    entry = F.struct(F.length(F.concat("rule_host", "rule_path")).alias("n"),
                     F.concat("rule_host", "rule_path").alias("rule"), "rule_path", "verdict")
    return out.groupBy("host").agg(F.sort_array(F.collect_set(entry), asc=False).alias("rules"))


def propagate(seeds: DataFrame, links: DataFrame, damping: float = 0.85,
              residual: float = RESIDUAL, cut_every: int = 5) -> DataFrame:
    """(host, seed) and (src, dst, n) -> (host, trust, distrust)."""
    out_n = links.groupBy("src").agg(F.sum("n").alias("w"))
    in_n = links.groupBy("dst").agg(F.sum("n").alias("w"))
    arcs = links.join(out_n, "src").select(
        F.lit("trust").alias("kind"), F.col("src").alias("from"), F.col("dst").alias("host"),
        (F.col("n") / F.col("w")).alias("p"))
    arcs = written(arcs.unionByName(links.join(in_n, "dst").select(
        F.lit("distrust").alias("kind"), F.col("dst").alias("from"), F.col("src").alias("host"),
        (F.col("n") / F.col("w")).alias("p"))), "host-arcs")
    nodes = seeds.unionByName(arcs.select("host", F.lit(0.0).alias("seed")))
    nodes = nodes.groupBy("host").agg(F.sum("seed").alias("seed"))
    pos, neg = F.greatest("seed", F.lit(0.0)), F.greatest(-F.col("seed"), F.lit(0.0))
    kinds = F.explode(F.array(F.struct(F.lit("trust").alias("kind"), pos.alias("seed")),
                              F.struct(F.lit("distrust").alias("kind"), neg.alias("seed"))))
    base = written(nodes.select("host", kinds.alias("x")).select("host", "x.kind", "x.seed"), "host-seeds")
    state = base.withColumn("score", F.col("seed")).withColumn("moved", F.lit(0.0))
    step, settled = 0, False
    while not settled:
        step += 1
        flow = (arcs.join(state.select(F.col("host").alias("from"), "kind", "score"), ["from", "kind"])
                .groupBy("host", "kind").agg(F.sum(F.col("score") * F.col("p")).alias("flow")))
        new = F.col("seed") + F.lit(damping) * F.coalesce("flow", F.lit(0.0))
        state = (state.drop("moved").join(flow, ["host", "kind"], "left")
                 .select("host", "kind", "seed", new.alias("score"),
                         F.abs(new - F.col("score")).alias("moved")))
        if step == 1 or step % cut_every == 0:
            state = state.checkpoint()
            settled = (state.agg(F.max("moved")).first()[0] or 0.0) <= residual
    return state.groupBy("host").agg(
        F.max(F.when(F.col("kind") == "trust", F.col("score"))).alias("trust"),
        F.max(F.when(F.col("kind") == "distrust", F.col("score"))).alias("distrust"))


def judge(pages: DataFrame, rules=None, threshold: float = 0.5, damping: float = 0.85,
          residual: float = RESIDUAL) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust per page."""
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(RULES if rules is None else rules,
                                      "rule_host string, rule_path string, verdict string")
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    lists = written(rules_by_host(parsed.select("host").distinct(), rules), "host-rules")
    lean = parsed.drop("html").join(lists, "host", "left")
    hit = F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"])), 0)
    lean = lean.withColumn("hit", hit).drop("rules")
    share = (F.sum(F.when(F.col("hit.verdict") == "allow", 1).when(F.col("hit.verdict") == "block", -1)
                   .otherwise(0)) / F.count("*"))
    seeds = lean.groupBy("host").agg(share.cast("double").alias("seed"))
    shown = F.regexp_replace(F.coalesce("html", F.lit("")), NO_LINKS, " ")
    target = F.explode(F.regexp_extract_all(shown, F.lit(LINK), F.lit(1)))
    links = (parsed.filter("host <> ''").select(F.col("host").alias("src"), target.alias("to"))
             .select("src", F.translate("to", UPPER, LOWER).alias("dst")).filter("src <> dst")
             .groupBy("src", "dst").agg(F.count("*").alias("n")))
    links = written(links, "host-links")
    scores = written(propagate(seeds, links, damping, residual), "host-scores")
    found = F.when(F.col("distrust") - F.col("trust") >= threshold, "block").otherwise("allow")
    return lean.join(scores, "host", "left").select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce(F.col("hit.verdict"), found).alias("verdict"), "trust", "distrust")


def _oracle() -> str:
    fits = lambda h, p: f"((host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}'))"
    longest = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    rule = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for h, p, _ in longest) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for h, p, v in longest) + " END"
    return rf"""
WITH RECURSIVE u AS (SELECT page_id, html, CASE WHEN strpos(url, '://') > 0
             THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*', 0), '{UPPER}', '{LOWER}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
v AS (SELECT page_id, host, path, {rule} AS rule, {verdict} AS ruled FROM p),
e AS (SELECT host AS src, translate(unnest(regexp_extract_all(
        regexp_replace(coalesce(html, ''), '{NO_LINKS}', ' ', 'g'),
        '{LINK.replace("'", "''")}', 1)), '{UPPER}', '{LOWER}') AS dst
      FROM p WHERE host <> ''),
l AS (SELECT src, dst, count(*) AS n FROM e WHERE src <> dst GROUP BY src, dst),
arcs AS MATERIALIZED (SELECT 'trust' AS kind, src AS frm, dst AS host, n / sum(n) OVER (PARTITION BY src) AS p FROM l
         UNION ALL SELECT 'distrust', dst, src, n / sum(n) OVER (PARTITION BY dst) FROM l),
h AS (SELECT host, sum(seed) AS seed FROM (
        SELECT host, sum(CASE ruled WHEN 'allow' THEN 1 WHEN 'block' THEN -1 ELSE 0 END)::DOUBLE / count(*) AS seed
        FROM v GROUP BY host UNION ALL SELECT host, 0 FROM arcs) GROUP BY host),
s0 AS (SELECT host, 'trust' AS kind, greatest(seed, 0) AS seed FROM h
       UNION ALL SELECT host, 'distrust', greatest(-seed, 0) FROM h),
s(k, host, kind, seed, score, moved) AS (
  SELECT 0, host, kind, seed, seed, 1.0::DOUBLE FROM s0 UNION ALL
  SELECT k + 1, host, kind, seed, seed + 0.85::DOUBLE * flow, seed + 0.85::DOUBLE * flow - score FROM (
    SELECT b.k, b.host, b.kind, b.seed, b.score, coalesce(sum(f.score * a.p), 0) AS flow
    FROM s b LEFT JOIN arcs a ON a.host = b.host AND a.kind = b.kind
      LEFT JOIN s f ON f.host = a.frm AND f.kind = a.kind
    GROUP BY b.k, b.host, b.kind, b.seed, b.score)
  WHERE (SELECT max(moved) FROM s) > {RESIDUAL}),
z AS (SELECT host, max(score) FILTER (kind = 'trust') AS trust,
        max(score) FILTER (kind = 'distrust') AS distrust FROM s WHERE k = (SELECT max(k) FROM s) GROUP BY host)
SELECT page_id, v.host, path, rule,
       coalesce(ruled, CASE WHEN distrust - trust >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
       trust, distrust FROM v JOIN z ON z.host = v.host"""


ORACLE = _oracle()
