"""Operator 9: rule bitmask ledger.

``ledger`` evaluates every rule once per document and stores one failure bit
per rule plus the measurements behind them.  Policies are named sets of rules;
applying one is a bitwise AND with its mask, so a new policy needs no second
look at the text.  ``ablation`` counts, per policy and rule, how many documents
fail and how many fail by that rule alone, from counts per distinct bit
pattern.  All of it is DataFrame expressions, without a shuffle in ``ledger``.

Edge cases: null or blank text has no words and fails the length rule;
one- and two-word texts have no 3-word windows; equal rows give equal ledger
rows; extra input columns pass through unless a ledger column has that name,
which then is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.common import blank_words

SYMBOLS = r"[#*$%&|<>]"

#: Rule name -> failure condition over the measurement columns; the position
#: is the rule's bit.  Append only: stored ledgers keep their meaning.
RULES: list[tuple[str, str]] = [
    ("min_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbol_ratio", "10 * n_symbols > n_words"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
    ("word_length_low", "word_chars < 2 * n_words"),
    ("word_length_high", "word_chars > 25 * n_words"),
]

#: Policy version -> the rules that it applies.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("min_words", "repeated_windows"),
    "v1": ("min_words", "repeated_windows", "symbol_ratio", "repeated_lines"),
    "v2": tuple(name for name, _ in RULES),
}


def mask_of(rules) -> int:
    bits = {name: i for i, (name, _) in enumerate(RULES)}
    return sum(1 << bits[r] for r in set(rules))


def _repeat_positions(words: str) -> Column:
    """Sorted start positions of the 3-word windows found twice or more."""
    starts = F.sequence(F.lit(0), F.size(words) - 3)
    hashed = F.transform(starts, lambda i: F.struct(
        F.xxhash64(F.get(F.col(words), i), F.get(F.col(words), i + 1),
                   F.get(F.col(words), i + 2)).alias("h"), i.alias("p")))
    return F.when(F.size(words) >= 3, F.sort_array(hashed))


def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus measurements and ``fail_bits`` (bit i: rule i failed)."""
    keep = [c for c in df.columns if c not in (
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        "n_repeat_words", "fail_bits")]
    src = F.coalesce(F.col(text), F.lit(""))
    out = df.select(
        *keep, blank_words(F.col(text)).alias("_words"),
        F.filter(F.split(src, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        F.regexp_count(src, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    out = out.select(
        *keep, "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_positions("_words").alias("_s"))
    out = out.withColumn("_p", F.sort_array(F.transform(
        F.filter("_s", lambda x, i: (x["h"] == F.get(F.col("_s"), i + 1)["h"])
                 | (x["h"] == F.get(F.col("_s"), i - 1)["h"])), lambda x: x["p"])))
    # A window covers three words; neighbouring windows share some of them.
    out = out.withColumn("n_repeat_words", F.coalesce(F.aggregate(
        F.transform("_p", lambda p, i: F.least(
            F.lit(3), F.coalesce(F.get(F.col("_p"), i + 1) - p, F.lit(3)))),
        F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")).drop("_s", "_p")
    bits = sum((F.when(F.expr(cond), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
                for i, (_, cond) in enumerate(RULES)), F.lit(0).cast("long"))
    return out.withColumn("fail_bits", bits)


def apply_policy(led: DataFrame, version: str, out: str = "kept") -> DataFrame:
    mask = mask_of(POLICIES[version])
    return led.withColumn(out, F.col("fail_bits").bitwiseAND(F.lit(mask)) == 0)


def ablation(led: DataFrame) -> DataFrame:
    """Per policy and rule: documents failed, and failed by that rule alone."""
    counts = led.groupBy("fail_bits").agg(F.count("*").alias("n"))
    rows = [F.struct(F.lit(v).alias("policy"), F.lit(r).alias("rule"),
                     F.lit(mask_of(POLICIES[v])).cast("long").alias("mask"),
                     F.lit(mask_of([r])).cast("long").alias("bit"))
            for v in POLICIES for r in POLICIES[v]]
    hit = F.col("fail_bits").bitwiseAND(F.col("x.mask"))
    return (counts.withColumn("x", F.explode(F.array(*rows)))
            .groupBy(F.col("x.policy").alias("policy"), F.col("x.rule").alias("rule"))
            .agg(F.sum(F.when(hit.bitwiseAND(F.col("x.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(hit == F.col("x.bit"), F.col("n")).otherwise(0)).alias("n_only")))


def quality_query(documents: DataFrame, version: str = "v2") -> DataFrame:
    led = apply_policy(ledger(documents.select("doc_id", "text")).drop("text"), version)
    base = F.col("fail_bits").bitwiseAND(F.lit(mask_of(POLICIES["base"]))) != 0
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", base.alias("base_failed"), "kept", "fail_bits")


ORACLE = r"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
g AS (SELECT rid, unnest(list_transform(generate_series(1, len(ws) - 2),
                       lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS win,
             unnest(generate_series(1, len(ws) - 2)) AS p
      FROM w WHERE len(ws) >= 3),
r AS (SELECT rid, p FROM (SELECT *, count(*) OVER (PARTITION BY rid, win) AS c FROM g) WHERE c > 1),
c AS (SELECT rid, count(DISTINCT p + o) AS n FROM r, (VALUES (0), (1), (2)) v(o) GROUP BY rid),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(list_aggregate(list_concat([''], ws), 'string_agg', '')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ls) AS BIGINT) AS n_lines,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        coalesce(c.n, 0) AS n_repeat_words
      FROM w LEFT JOIN c USING (rid)),
f AS (SELECT *, CAST((CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
        + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
        + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END)
        + (CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
        + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END)
        + (CASE WHEN word_chars > 25 * n_words THEN 32 ELSE 0 END) AS BIGINT) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM f
"""
