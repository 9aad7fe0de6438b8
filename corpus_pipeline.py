"""Corpus pipeline over ``documents``: language, near duplicates, repeated
passages, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last
return the columns of ``docs``, unchanged but for ``text`` and ``n_chars`` of
documents that lose a passage.  ``run`` writes every stage's result below
``spark.checkpoint.dir`` and reads it back, so a lost executor costs at most
one stage.

Edge cases, the same in every stage: columns of any other name, also of a name
that an operator uses, are carried under a name of their own and come back as
they were; documents without letters (null, empty and blank texts too) end in
the language stage; in the near-duplicate stage rows that repeat an id are one
document, of which one row stays, and rows with a null id all stay; the later
stages keep null and empty texts and cut or drop each repeated row alike; an
empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm import decontaminate, language, neardup, packing, substrings
from shelfcast.llm.common import bounded_batches, table, written


#: Columns that the operators read by name.
READ = ("doc_id", "text", "lang")


def _carried(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with all columns but ``READ`` renamed, so that no operator's own
    names meet them, and the new names in order."""
    names = [c if c in READ else f"_carried_{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), names


def _restored(df: DataFrame, names: list[str], docs: DataFrame) -> DataFrame:
    return df.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])


def language_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or with a narrow language margin go."""
    bounded_batches(spark)
    src, names = _carried(docs)
    found = language.identify(src, language.fit(src))
    return _restored(found.filter(~F.col("rejected")), names, docs)


def near_duplicate_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) the smallest id stays,
    of the rows that repeat an id one."""
    bounded_batches(spark)
    gone = written(neardup.near_duplicates(docs).filter(~F.col("kept"))
                   .select(F.col("doc_id").alias("_gone")).distinct(), "near-gone")
    few = gone.count() <= neardup.BROADCAST_IDS
    left = docs.join(F.broadcast(gone) if few else gone, docs["doc_id"] == gone["_gone"], "left_anti")
    again = written(left.filter("doc_id is not null").groupBy(F.col("doc_id").alias("_again"))
                    .agg(F.count("*").alias("_n")).filter("_n > 1"), "near-again")
    if again.isEmpty():
        return left
    few = again.count() <= neardup.BROADCAST_IDS
    ids = F.broadcast(again.select("_again")) if few else again.select("_again")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    # One row per repeated id, chosen before the shuffle within each task.
    one = (left.join(ids, F.col("doc_id") == F.col("_again"), "left_semi").groupBy("doc_id")
           .agg(F.min_by(whole, F.xxhash64(whole)).alias("_row")).select("_row.*"))
    return left.join(ids, F.col("doc_id") == F.col("_again"), "left_anti").unionByName(one)


def substring_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of 50-word windows that an earlier document holds are cut."""
    bounded_batches(spark)
    src, names = _carried(docs)
    out = substrings.dedup_substrings(src, keep=names)
    new = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    changed = F.col("n_removed") > 0
    return out.select(*[(F.when(changed, new[c]).otherwise(F.col(n)) if c in new else F.col(n)).alias(c)
                        for n, c in zip(names, docs.columns)])


def decontamination_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover a twentieth or more go."""
    bounded_batches(spark)
    src, names = _carried(docs)
    found = decontaminate.decontaminate(src, table(spark, sf_dir, "benchmark"))
    return _restored(found.filter(~F.col("contaminated")), names, docs)


def packing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language", language_stage), ("near_duplicates", near_duplicate_stage),
          ("substrings", substring_stage), ("decontamination", decontamination_stage),
          ("packing", packing_stage)]

#: Compression, tokenisation and packing have no SQL form.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
