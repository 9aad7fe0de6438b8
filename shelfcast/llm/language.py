"""Operator 3: language identification by compression.

Per language, a raw-content zstandard dictionary is built from a bounded
sample of labelled rows (the ``per_language`` distinct samples with the
smallest hash of the id, each of at most ``text_chars`` characters,
``dictionary_bytes`` in all, for the ``max_languages`` commonest labels; the
sample does not depend on partitioning).  A text is lower-cased, everything
that is no letter in ASCII becomes a blank, and the whole of it is compressed
block by block with every dictionary; the smallest total wins, ties go to the
language with more training rows.  ``rejected`` marks texts whose relative
margin over the runner-up is below ``min_margin`` although they are long
enough (``min_evidence`` bytes) for a margin to mean something, and texts
without letters.

Edge cases: null text and text without letters are ``und`` with score 0 and
rejected; null languages and null ids are not learned from; a null id is not
held out; with no training rows every text is ``und``; very long texts are cut
into blocks and never shortened; repeated rows get equal answers; input columns
named like an output column are replaced by it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

OUT = "held_out boolean, lang_pred string, score double, margin double, rejected boolean"
BLOCK = 16384
_NO_LETTER = re.compile(rb"[\x00-\x60\x7b-\x7f]+")
_LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]      # most training rows first
    dictionaries: tuple[bytes, ...]


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def normalised(text: str) -> bytes:
    return _NO_LETTER.sub(b" ", text.lower().encode("utf-8", "replace"))


def fit(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        per_language: int = 400, text_chars: int = 1000, dictionary_bytes: int = 65536,
        max_languages: int = 400) -> Model:
    """Two passes: the commonest labels, then the bounded sample of each."""
    train = df.filter(F.col(key).isNotNull() & F.col(lang).isNotNull() & ~held_out(key))
    common = train.groupBy(lang).count().orderBy(F.desc("count"), lang).limit(max_languages).collect()
    counts = {r[0]: r[1] for r in common}
    if not counts:
        return Model((), ())
    draw = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(17)), F.lit(1 << 30))
    # Twice the wanted share is drawn before the shuffle; rows repeated under
    # one id or text count once, so no id can crowd out a label.
    share = F.create_map(*[F.lit(x) for k, n in counts.items()
                           for x in (k, min(1 << 30, int((1 << 30) * 2 * per_language / n) + 1))])
    drawn = (train.filter(draw < share[F.col(lang)])
             .select(F.col(lang).alias("_l"), draw.alias("_d"), F.substring(text, 1, text_chars).alias("_t"))
             .filter(F.col("_t").isNotNull()).groupBy("_l", "_t").agg(F.min("_d").alias("_d")))
    first = Window.partitionBy("_l").orderBy("_d", "_t")
    rows = (drawn.withColumn("_k", F.row_number().over(first)).filter(F.col("_k") <= per_language)
            .select("_l", "_d", "_t").collect())  # per_language * max_languages at most
    parts: dict[str, dict[bytes, None]] = {k: {} for k in counts}
    for label, _, sample in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        parts[label].setdefault(normalised(sample))
    order = sorted(counts, key=lambda k: (-counts[k], k))
    return Model(tuple(order), tuple(_dictionary(parts[k], dictionary_bytes) for k in order))


def _dictionary(samples, size: int) -> bytes:
    """Samples on lines of their own, cut to ``size`` bytes at a character."""
    return b"\n".join(samples)[:size].decode("utf-8", "ignore").encode("utf-8")


def compressors(model: Model, level: int = 6):
    import zstandard as zstd

    out = []
    for data in model.dictionaries:
        params = zstd.ZstdCompressionParameters.from_level(
            level, dict_size=len(data), source_size=BLOCK, write_content_size=False,
            write_checksum=False, write_dict_id=False)
        if not data:
            out.append(zstd.ZstdCompressor(compression_params=params))
            continue
        held = zstd.ZstdCompressionDict(data, dict_type=zstd.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=params)
        out.append(zstd.ZstdCompressor(dict_data=held, compression_params=params))
    return out


def classify(text: str | None, model: Model, engines, min_margin: float, min_evidence: int):
    """(lang_pred, score, margin, rejected) of one text."""
    if not engines or text is None or not _LETTER.search(text):
        return "und", 0.0, 0.0, True
    body = normalised(text)
    sizes = [sum(len(c.compress(body[k:k + BLOCK])) for k in range(0, len(body), BLOCK)) for c in engines]
    best = min(range(len(sizes)), key=sizes.__getitem__)
    second = min((s for k, s in enumerate(sizes) if k != best), default=sizes[best] + 64)
    margin = (second - sizes[best]) / max(1, second)
    score = 1.0 / sum(2.0 ** -min(60, s - sizes[best]) for s in sizes)
    return model.languages[best], score, margin, margin < min_margin and len(body) >= min_evidence


def identify(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text",
             keep: list[str] | None = None, min_margin: float = 0.005,
             min_evidence: int = 200) -> DataFrame:
    """``keep`` columns of ``df`` plus held_out, lang_pred, score, margin, rejected."""
    made = [f.split()[0] for f in OUT.split(", ")]
    keep = [c for c in (df.columns if keep is None else keep) if c not in made]
    src = df.select(*keep, held_out(key).alias("held_out"),
                    *([] if text in keep else [F.col(text).alias("_text")]))
    at = keep.index(text) if text in keep else len(keep) + 1
    schema = StructType(src.select(*keep).schema.fields + StructType.fromDDL(OUT).fields)
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by fit's parameters
    n = len(keep)

    def run(batches):
        import pyarrow as pa

        engines = compressors(shared.value)
        for batch in batches:
            found = [classify(t.as_py(), shared.value, engines, min_margin, min_evidence)
                     for t in batch.column(at)]
            cols = list(zip(*found)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(n + 1)]
                + [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.float64(), pa.float64(), pa.bool_()))],
                names=keep + made)

    return src.mapInArrow(run, schema)


def language_query(documents: DataFrame) -> DataFrame:
    model = fit(documents)
    return identify(documents, model, keep=["doc_id"])
