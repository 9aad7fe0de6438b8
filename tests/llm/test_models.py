"""Operators 11 to 13: brute force, exact distributions and edge cases."""

import math
import re
import time
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import negatives, pitmanyor, queries as Q, spelling
from llm_support import SF, docs, rows_of  # noqa: F401


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# --- 11 -------------------------------------------------------------------

def check_scores(rows, texts):
    """Every column of the contract but the model's own score, by plain counting."""
    tokens = [(i, re.findall(r"[^\x20\x09-\x0D]+", lower(t or "")) + [""]) for i, t in texts]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = [(i, held(i), len(ws), sum(c[w] > 0 for w in ws), n,
             round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 4)) for i, ws in tokens]
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert all(r.score <= 1e-9 and math.isfinite(r.score) for r in rows)


def test_pitman_yor_query(spark):
    rows = Q.QUERIES["op11_pitman_yor_lm"](spark, SF).collect()
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    check_scores(rows, [(r.doc_id, r.text) for r in texts])
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_pitman_yor_edges(spark, docs, monkeypatch):
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check_scores(pitmanyor.pitman_yor(docs.withColumn("score", F.lit("x")).withColumn("word", F.lit(1))).collect(), texts)
    # Several buckets and blocks; repeated rows are documents of their own.
    monkeypatch.setattr(pitmanyor, "BUCKET", 3000)
    again = docs.unionAll(docs)
    rows = pitmanyor.pitman_yor(again).collect()
    check_scores(rows, texts * 2)
    both = defaultdict(list)
    for r in rows:
        both[r.doc_id, r.n_tokens].append(r.score)
    assert all(max(x) - min(x) < 1e-6 for x in both.values())
    assert not pitmanyor.pitman_yor(docs.limit(0)).collect()
    only = spark.createDataFrame([(i, "a b") for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2], "doc_id long, text string")
    assert {(r.train_tokens, r.base_score, r.score) for r in pitmanyor.pitman_yor(only).collect()} == {(0, 0.0, 0.0)}


def read_blocks(rows):
    import pyarrow as pa
    batch = pa.record_batch([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.string())],
                            names=["doc_id", "text"])
    return list(pitmanyor._read([batch.slice(0, 0), batch]))


@pytest.mark.parametrize("tokens, docs, piece", [(1 << 20, 1 << 15, 1 << 22), (40, 7, 60), (1, 1 << 15, 9)])
def test_blocks_hold_every_word(monkeypatch, tokens, docs, piece):
    """Whole documents in blocks closed at ``TOKENS`` or ``DOCS``, whatever the white space and the pieces."""
    monkeypatch.setattr(pitmanyor, "TOKENS", tokens)
    monkeypatch.setattr(pitmanyor, "DOCS", docs)
    monkeypatch.setattr(pitmanyor, "PIECE", piece)
    rng = np.random.default_rng(2)
    marks = list(" \t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u2003 AZÉéİaz\u4e2d0")
    rows = [(None if i % 11 == 0 else i // 2, None if i % 13 == 0 else "".join(rng.choice(marks, rng.integers(0, 90))))
            for i in range(200)] + [(1, ""), (2, " \t "), (3, "x " * 500 + "\n")]
    got = []
    for b in read_blocks(rows):
        word, ctx, pos, held, words, _ = b.arrays()
        sizes = b.lengths()
        assert len(b.keys) <= docs and (len(b.keys) == 1 or sizes[:-1].sum() < tokens)
        assert len(set(words)) == len(words) and words[0] == b"" and len(word) == len(held) == b.tokens == sizes.sum()
        each = [words[i] for i in word]
        for k, key in enumerate(b.keys):
            own = np.flatnonzero(pos == k)
            got.append((key, [each[i] for i in own]))
            assert [ctx[i] for i in own] == [zlib.crc32(w) % pitmanyor.CONTEXTS for w in [b"", *got[-1][1][:-1]]]
            assert set(held[own]) == {key is not None and zlib.crc32(str(key).encode()) % 7 == 2}
    assert got == [(i, [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", lower(t or ""))] + [b""]) for i, t in rows]


def test_blocks_are_read_faster_than_word_by_word():
    """Reading is repeated for each pass over the texts: numbering words one by one took most of the query."""
    rng = np.random.default_rng(4)
    vocabulary = [f"Word{i:x}" for i in range(60_000)]
    rows = [(i, " ".join([vocabulary[j] for j in (60_000 * rng.random(400) ** 4).astype(int)])) for i in range(2_000)]

    def plain():
        seen, at = {}, []
        for _, t in rows:
            at.append(np.array([seen.setdefault(w, len(seen)) for w in t.encode().lower().split()]))
        return np.concatenate(at)

    def seconds(run):
        took = []
        for _ in range(4):
            began = time.process_time()
            run()
            took.append(time.process_time() - began)
        return min(took)

    assert sum(b.tokens for b in read_blocks(rows)) == 2_000 * 401
    assert seconds(lambda: [b.arrays() for b in read_blocks(rows)]) < 0.65 * seconds(plain)


def partitions(n):
    """Seatings of n customers: every restricted growth string."""
    for s in product(range(n), repeat=n):
        if all(x <= max(s[:i], default=-1) + 1 for i, x in enumerate(s)):
            yield s


@pytest.mark.parametrize("n, weight, discount", [(3, 0.7, 0.5), (5, 2.0, 0.3), (4, 0.2, 0.8)])
def test_reseat_keeps_the_exact_distribution(n, weight, discount):
    want = Counter()
    for s in partitions(n):
        sizes = Counter(s).values()
        want[len(sizes)] += weight ** len(sizes) * math.prod(math.prod(j - discount for j in range(1, k)) for k in sizes)
    copies, rng = 20_000, np.random.default_rng(5)
    seated, group = np.full(copies, n), np.arange(copies)
    for _ in range(6):
        seated, group = pitmanyor.reseat(seated, group, np.full(copies, weight), discount, rng)
        assert (np.bincount(group, weights=seated) == n).all() and (np.diff(group) >= 0).all()
    got = Counter(np.bincount(group).tolist())
    for k, x in want.items():
        assert abs(got[k] / copies - x / sum(want.values())) < 0.015


def test_large_groups_near_the_sequential_seating():
    """1/64 of a group at a time: the mean of tables is that of one customer at a time."""
    runs = []
    for parts in (64, 600):
        rng, seated, group = np.random.default_rng(3), np.full(300, 600), np.arange(300)
        for _ in range(30):
            seated, group = pitmanyor.reseat(seated, group, np.full(300, 5.0), 0.4, rng, parts)
        runs.append(len(seated) / 300)
    assert abs(runs[0] / runs[1] - 1) < 0.05


def test_predictions_sum_to_one(spark):
    src = spark.createDataFrame([(i, f"a b{i % 5} c a b{i % 3} d{i}") for i in range(40)], "doc_id long, text string")
    model = pitmanyor.fit(src)
    seen = sorted({w for i in range(40) if zlib.crc32(str(i).encode()) % 7 != 2
                   for w in f"a b{i % 5} c a b{i % 3} d{i}".encode().split()} | {b"", b"never"})
    import pyarrow as pa
    tables = model.state.toArrow().combine_chunks()
    assert tables.num_rows == 1
    seats = pitmanyor.Seats({k: tables.column(k)[0] for k in pitmanyor.STATE_NAMES})
    seats.keep(model.samples[-1])
    scorer = pitmanyor.Scorer(model.samples, pitmanyor.hot_pairs(model), pa.array(seen, pa.binary()), seats)
    for before in (b"a", b"c", b"", b"not seen"):
        ctx = np.full(len(seen), zlib.crc32(before) % pitmanyor.CONTEXTS)
        _, p = scorer.entries(np.arange(len(seen)), ctx)
        assert abs(p.sum() - 1) < 1e-9 and (p > 0).all()


# --- 12 -------------------------------------------------------------------

def spelling_brute(texts, least=6, many=5, every=199, ratio=5):
    c = Counter()
    for i, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            c[run] += 1
    n = {w: k for w, k in c.items() if len(w) >= least and k >= many}
    shared = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            shared[w[:i] + w[i + 1:]].add(w)
            shared[w[:i] + "\0" + w[i + 1:]].add(w)
        shared[w].add(w)
    near = defaultdict(set)
    for s in shared.values():
        for a in s:
            near[a] |= {b for b in s if b != a and levenshtein_one(a, b)}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def levenshtein_one(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1] == 1


def variants(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_spelling_query(spark):
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert variants(Q.QUERIES["op12_spelling_variants"](spark, SF)) == spelling_brute([(r.doc_id, r.text) for r in texts])


def test_spelling_edges(spark, monkeypatch):
    texts = [(1, "Station STATION station " * 60), (2, "statian statian statiom " * 5), (3, None), (4, ""),
             (5, "stations " * 40 + "sttaion " * 9), (None, "écoleé Écoleé ecoleé " * 7), (6, "stati" * 2000),
             (6, "x" * 5000 + " " + "x" * 5001), (6, "tation " * 30 + "stationss " * 6)]
    texts += [(7, "x" * 5000 + " " + "x" * 5001)] * 5 + [(8, None)]
    df = spark.createDataFrame([(i, t, "w", 1) for i, t in texts], "doc_id long, text string, word string, n int")
    want = spelling_brute(texts)
    assert any(f for _, f, *_ in want) and {len(w) for w, *_ in want} >= {5000, 5001}
    assert variants(spelling.spelling_variants(df, noise_every=199)) == want
    assert variants(spelling.spelling_variants(df)) == spelling_brute(texts, every=0)
    # Tiny blocks: every split part still meets all others.
    monkeypatch.setattr(spelling, "BLOCK", 2)
    assert variants(spelling.spelling_variants(df, noise_every=199)) == want
    assert not variants(spelling.spelling_variants(df.limit(0)))


# --- 13 -------------------------------------------------------------------

def negatives_brute(rows, every=50):
    out = []
    for i, v, y in rows:
        if i % every:
            continue
        score = sorted(((-int(np.dot(v, w)), j, z) for j, w, z in rows if j != i))
        for p, j, _ in [s for s in score if s[2] == y][:5]:
            fits = [s for s in score if s[2] != y and 50 * -p <= 100 * -s[0] <= 95 * -p][:3]
            out += [(i, j, k + 1, s[1], -p, -s[0]) for k, s in enumerate(fits)]
    return sorted(out)


def found(df):
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score)
                  for r in df.collect())


def test_negatives_clusters_and_copies(spark, monkeypatch):
    """Clusters, one vector that a third of the rows share, many labels, several shards."""
    r = np.random.default_rng(8)
    centre = r.normal(0, 60, (6, 12))
    v = np.floor(centre[r.integers(0, 6, 900)] + r.normal(0, 6, (900, 12))).astype(int)
    v[300:600] = v[0]
    rows = [(i, x.tolist(), int(y)) for i, (x, y) in enumerate(zip(v, r.integers(0, 7, 900)))]
    df = spark.createDataFrame(rows, "id long, v array<long>, label int")
    want = negatives_brute(rows)
    assert len(want) > 100
    assert found(negatives.hard_negatives(df, F.col("id") % 50 == 0)) == want
    monkeypatch.setattr(negatives, "SHARD", 64)
    assert found(negatives.hard_negatives(df.unionAll(df), F.col("id") % 50 == 0)) == want


def test_negatives_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [0.9, 0.1], 2), (3, None, 1), (4, [1.0, None], 2), (5, [nan, 1.0], 2),
            (6, [inf, 1.0], 2), (7, [0.8, 0.1], 3), (8, [0.7, 0.2], None), (None, [0.7, 0.2], 3), (50, [], 1), (100, [1.0], 2),
            (150, [-1.0, -0.5], 1), (9, [0.0, 0.0], 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("rank", F.lit("x"))
    clean = [(i, [math.floor(256 * x) for x in v] + [0] * (2 - len(v)), (y + 1) % 10 if i % 7 == 0 else y)
             for i, v, y in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    assert found(negatives.negatives_query(df)) == negatives_brute(clean)
    assert not found(negatives.negatives_query(df.limit(0)))
    assert not found(negatives.negatives_query(df.filter("vec_id = 1")))


def test_cover_tree_bounds_hold():
    r = np.random.default_rng(4)
    points = np.floor(r.normal(0, 50, (700, 8)) * (1 + 9 * (r.random((700, 1)) < 0.1)))
    points[100:200] = points[0]
    tree = negatives.CoverTree(points)

    def below(n):
        return tree.below[n] if tree.leaf[n] else np.concatenate([below(c) for c in tree.below[n]])

    assert sorted(below(tree.root)) == list(range(700))
    q = r.normal(0, 30, (20, 8))
    least, most = tree.reach(q)
    for n in range(len(tree.centre)):
        inside = q @ points[below(n)].T
        assert (inside >= least[:, [n]]).all() and (inside <= most[:, [n]]).all()
        assert np.linalg.norm(tree.body[below(n)] - tree.body[tree.centre[n]], axis=1).max() <= tree.radius[n]
