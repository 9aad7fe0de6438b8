"""Helpers and fixtures of the operator tests."""

import os
import random

import duckdb
import pytest


def rows_of(pdf):
    cols = sorted(pdf.columns)
    clean = [tuple(None if x is None or x != x else x for x in r)
             for r in pdf[cols].astype(object).itertuples(index=False)]
    return cols, sorted(clean, key=repr)


def words(seed, n, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


SF = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels conversations embeddings".split()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return con


@pytest.fixture(scope="session")
def docs(spark):
    """Awkward documents: nulls, empties, ties, copies, a long text, clashing extra columns."""
    base = words(1, 300, 4000)
    long = words(2, 30_000, 50_000)
    near = list(base)
    near[150] = "changed"
    texts = [
        (0, " ".join(base)), (1, " ".join(base)), (2, " ".join(near)), (3, None), (4, ""), (5, " \n\t "),
        (6, "one"), (7, "one two"), (8, "\n".join(long)), (9, " ".join(words(3, 80, 900) + base[40:140])),
        (10, "word " * 200), (11, " ".join(words(4, 400, 5000))), (12, "Ünï çödé 漢字 " * 30),
        (13, "a line here\na line here\n\n a line here"), (14, "### $$$ %%% &&& ||| <b> " * 20),
        (None, " ".join(base)), (16, " ".join(base[:60])),
    ]
    return spark.createDataFrame(
        [(i, t, "en" if i and i % 2 else None, "s", "extra") for i, t in texts],
        "doc_id long, text string, lang string, source string, kept string")
