"""Every query against its SQL, or a brute-force version, on the small tables."""

import zlib
from collections import Counter

import numpy as np
import pytest

from shelfcast.llm import queries as Q
from llm_support import SF, duck, rows_of  # noqa: F401


@pytest.mark.parametrize("key", sorted(Q.ORACLES))
def test_query_equals_sql(spark, duck, key):
    got = Q.QUERIES[key](spark, SF).toPandas()
    assert rows_of(got) == rows_of(duck.sql(Q.ORACLES[key]).to_arrow_table().to_pandas())


def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    ids = {r.doc_id: np.asarray(tok.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
           for r in docs.itertuples()}
    got = Q.QUERIES["op1_sum_of_squares_packing"](spark, SF).toPandas()
    for r in got.itertuples():
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(ids[r.doc_id])
    for doc, own in got.sort_values("start").groupby("doc_id"):
        assert (own.start.values == np.r_[0, own.length.cumsum().values[:-1]]).all()
        assert own.length.sum() == len(ids[doc])
    fill = got.groupby("sequence_id").length.sum()
    assert ((fill == 2048) | (fill & (fill - 1) == 0)).all()
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert (own.offset.values == np.r_[0, own.length.cumsum().values[:-1]]).all()


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = Q.QUERIES["op3_compression_language"](spark, sf).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas().set_index("doc_id")
    assert len(got) == len(docs)
    held = [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.index]
    assert (got.held_out.values == held).all()
    assert set(got.lang_pred) <= set(docs.lang) | {"und"}
    assert got.score.between(0, 1).all()
    right = (got.lang_pred == docs.lang.reindex(got.index))[got.held_out]
    assert right.mean() > 0.98


def test_language_against_plain_loop(spark):
    """Predictions from the same dictionaries by the one-shot zstd API, text by text."""
    import math
    import unicodedata

    import zstandard as zstd
    from shelfcast.llm import language

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    rows += [(90001, None, "en"), (90002, "123 ...", None), (90003, "x", "en"), (90004, rows[0][1] * 40, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df)
    train = Counter(l for i, _, l in rows if l is not None and zlib.crc32(str(i).encode()) % 4 != 2)
    assert list(model.languages) == sorted(train, key=lambda k: (-train[k], k))
    tools = []
    for data in model.dictionaries:
        params = zstd.ZstdCompressionParameters.from_level(6, dict_size=len(data), source_size=16384, write_content_size=False,
                                                           write_checksum=False, write_dict_id=False)
        tools.append(zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(data, dict_type=zstd.DICT_TYPE_RAWCONTENT),
                                         compression_params=params))
    got = {r.doc_id: r for r in language.identify(df, model).collect()}
    assert len(got) == len(rows)
    for i, text, _ in rows:
        r = got[i]
        if text is None or not any(unicodedata.category(c).startswith("L") for c in text):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        low, body = text.lower().encode(), bytearray()
        for b in low:
            if b >= 128 or 97 <= b <= 122:
                body.append(b)
            elif not body or body[-1] != 32:
                body.append(32)
        sizes = [sum(len(t.compress(bytes(body[k:k + 16384]))) for k in range(0, len(body), 16384)) for t in tools]
        best = sizes.index(min(sizes))
        assert r.lang_pred == model.languages[best]
        assert math.isclose(r.score, 1 / sum(2.0 ** -min(60, s - sizes[best]) for s in sizes))
        margin = (sorted(sizes)[1] - sizes[best]) / sorted(sizes)[1]
        assert math.isclose(r.margin, margin) and r.rejected == (margin < 0.005 and len(body) >= 200)


def test_language_sample_of_many_labels(spark):
    """Labels above the bound are not learned; one id or text that repeats crowds out nobody."""
    from shelfcast.llm import language

    rows = [(k, f"wort{k % 30} text {k}", f"l{k % 30:02d}") for k in range(900)]
    seen = next(k for k in range(5, 900, 30) if zlib.crc32(str(k).encode()) % 4 != 2)  # learned from
    rows += [(seen, "the same row again", "l05")] * 3000
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df, max_languages=20)
    assert len(model.languages) == 20 and model.languages[0] == "l05"
    assert all(data for data in model.dictionaries)
    assert model == language.fit(df.repartition(7), max_languages=20)
    cut = language._dictionary(["h\u00e9".encode()] * 9, 10)
    assert cut.decode("utf-8") and len(cut) <= 10


def test_pipeline_stages(spark):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["language", "near_duplicates", "substrings", "decontamination", "packing"]
    kept = docs.count()
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = spark.createDataFrame(out.collect(), docs.schema)
        assert 0.7 * kept < docs.count() <= kept
    pieces = C.STAGES[-1][1](spark, docs, SF).toPandas()
    assert set(pieces.doc_id) == {r.doc_id for r in docs.select("doc_id").collect()}
    assert Counter(C.run(spark, SF).columns) == Counter(pieces.columns)


def test_pipeline_stages_carry_clashing_columns_and_edge_rows(spark):
    import corpus_pipeline as C
    from pyspark.sql import functions as F

    base = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    odd = spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "", None, None, 0), (None, "plain words of a text without id", "en", "s", 33)],
                                "doc_id long, text string, lang string, source string, n_chars long").select(*base.columns)
    clash = ["score", "held_out", "rejected", "n_words", "n_removed", "contaminated", "_key", "_ranges", "_hit", "_carried_3", "id", "n"]
    docs = base.unionByName(odd)
    for c in clash:
        docs = docs.withColumn(c, F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    twice = docs.unionAll(docs)
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, twice, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        rows = out.collect()
        assert rows
        for r in rows:
            assert all(r[c] == f"{c} of {'none' if r.doc_id is None else r.doc_id}" for c in clash), name
        ids = Counter(r.doc_id for r in rows)
        if name == "near_duplicates":
            assert all(n == 1 for i, n in ids.items() if i is not None) and ids[None] == 2
        else:
            assert all(n == 2 for n in ids.values())
        assert stage(spark, docs.limit(0), SF).collect() == []
        if name == "language":
            assert not {9001, 9002} & set(ids)
        else:
            assert {9001, 9002} <= set(ids)
    assert C.STAGES[-1][1](spark, twice, SF).count() > 0
