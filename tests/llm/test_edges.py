"""Awkward rows against brute force: nulls, empties, ties, copies, long texts, extra columns."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_support import docs, words  # noqa: F401
from shelfcast.llm import (chat, components, decontaminate, htmltext, language, licenses, neardup,
                           packing, quality, substrings, urls)

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def as_dict(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_quality_brute_force(docs):
    got = as_dict(quality.quality_query(docs))
    for r in docs.collect():
        t = r.text or ""
        ws = BLANK.findall(t)
        wins = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
        rep = {i + k for i, x in enumerate(wins) for k in range(3) if wins.count(x) > 1} if len(ws) < 2000 else None
        lines = [x for x in t.split("\n") if BLANK.search(x)]
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars) == (len(ws), sum(map(len, ws)))
        assert g.n_symbols == len(re.findall(r"[#*$%&|<>]", t))
        assert g.n_dup_lines == len(lines) - len(set(lines))
        if rep is not None:
            assert g.n_repeat_words == len(rep)
            assert g.base_failed == (len(ws) < 50 or 100 * len(rep) > 50 * len(ws))
        assert not (g.kept and g.base_failed)


def test_quality_policies_and_ablation(docs):
    led = quality.ledger(docs)
    assert "kept" in led.columns  # an input column of another name's clash is carried
    bits = [r.fail_bits for r in led.collect()]
    for r in quality.ablation(led).collect():
        mask, bit = quality.mask_of(quality.POLICIES[r.policy]), quality.mask_of([r.rule])
        assert r.n_failed == sum(bool(b & bit) for b in bits)
        assert r.n_only == sum(b & mask == bit for b in bits)
    assert quality.ledger(docs.limit(0)).count() == 0


def test_neardup_brute_force(spark, docs):
    def sets(t, k):
        ws = BLANK.findall((t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        if 0 < len(ws) < k:
            return {tuple(ws)}
        return {tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)}

    base = words(9, 120, 3000)
    r = np.random.RandomState(5)
    rows = [(100 + i, " ".join(f"z{r.randint(10**6)}" if r.rand() < 0.01 * (i % 9) else w for w in base))
            for i in range(60)]
    more = docs.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    for k, pct in ((3, 85), (5, 80)):
        s = {x.doc_id: sets(x.text, k) for x in more.collect() if x.doc_id is not None}
        comp = {i: i for i in s}

        def root(i):
            while comp[i] != i:
                i = comp[i]
            return i

        for a in s:
            for b in s:
                if a < b and s[a] and s[b] and 100 * len(s[a] & s[b]) >= pct * len(s[a] | s[b]):
                    x, y = sorted((root(a), root(b)))
                    comp[y] = x
        rows_out = neardup.near_duplicates(more, shingle=k, percent=pct).collect()
        got = {x.doc_id: x for x in rows_out}
        assert len(rows_out) == more.count()
        for i in s:
            assert (got[i].n_shingles, got[i].component_id) == (len(s[i]), root(i))
            assert got[i].kept == (root(i) == i)
        assert got[None].component_id is None and got[None].kept
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_components_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components.connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def substring_brute(rows, window):
    first = {}
    ws = {i: BLANK.findall(t or "") for i, t in rows}
    for i in sorted(k for k in ws if k is not None):
        for s in range(len(ws[i]) - window + 1):
            first.setdefault(tuple(ws[i][s:s + window]), i)
    out = {}
    for i, w in ws.items():
        gone = set()
        if i is not None:
            for s in range(len(w) - window + 1):
                if first[tuple(w[s:s + window])] < i:
                    gone.update(range(s, s + window))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


@pytest.mark.parametrize("shard_words, hot", [(400_000, 2000), (300, 2000), (3000, 1)])
def test_substrings_brute_force(spark, docs, shard_words, hot):
    base = words(21, 90, 40)
    more = [(200 + i, " ".join(words(30 + i, 20 + i, 30) + base[i % 7:60 + i % 25] + words(60 + i, 15, 30)))
            for i in range(25)] + [(300, " ".join(base * 3)), (301, " ".join(base * 2))]
    every = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    out = substrings.dedup_substrings(every, shard_words=shard_words, hot_fragments=hot)
    want = substring_brute([(r.doc_id, r.text) for r in every.collect()], 50)
    got = as_dict(out)
    assert len(got) == len(want)
    for i, w in want.items():
        g = got[i]
        assert (g.n_words, g.n_removed, g.kept_sha256) == w, i
        assert g.kept_text == g.text if not g.n_removed else len(g.kept_text.split()) == w[0] - w[1]
    assert substrings.dedup_substrings(docs.limit(0)).count() == 0


def test_fm_index_early_distinct():
    """All suffixes differ below the window length; equal windows are still whole windows."""
    from shelfcast.llm.fmindex import FMIndex

    for same in (2, 5, 9, 20, 49):  # words that the two texts share at their start
        a = [f"s{k}" for k in range(same)] + [f"a{k}" for k in range(50 - same)]
        b = [f"s{k}" for k in range(same)] + [f"b{k}" for k in range(50 - same)]
        number = {w: k for k, w in enumerate(sorted({*a, *b}))}
        frags = [np.array([number[w] for w in t], np.uint64) for t in (a, b)]
        got = FMIndex(frags, np.array([1, 3]), 50).smallest_owner()
        assert [g.tolist() for g in got] == [[1], [3]], same


def test_substrings_copies_sharing_a_bigram(spark):
    a = ["same", "start"] + [f"a{k}" for k in range(48)]
    b = ["same", "start"] + [f"b{k}" for k in range(48)]
    rows = [(1, " ".join(a)), (2, " ".join(a)), (3, " ".join(b)), (4, " ".join(b))]
    got = as_dict(substrings.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")))
    want = substring_brute(rows, 50)
    assert {i: (g.n_words, g.n_removed, g.kept_sha256) for i, g in got.items()} == want
    assert [got[i].n_removed for i in (1, 2, 3, 4)] == [0, 50, 0, 50]


def test_decontaminate_brute_force(spark, docs):
    text = {r.doc_id: r.text for r in docs.collect()}
    items = [("b", " ".join(text[0].split()[20:50])), ("a", " ".join(text[0].split()[20:50]).upper()),
             ("c", "ONE, two"), ("d", None), ("e", "..."), ("f", "word " * 13), (None, text[0]),
             ("g", " ".join(words(77, 40))), ("h", "çödé 漢字")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    rx = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    cut = lambda t: rx.findall((t or "").translate(low))
    for block in (200_000, 7):  # one block and several
        got = as_dict(decontaminate.decontaminate(docs, bench, block_windows=block))
        for i, t in text.items():
            ws, hit, its = cut(t), set(), set()
            for item, bt in items:
                b = cut(bt)
                k = min(13, len(b))
                wins = {tuple(b[j:j + k]) for j in range(len(b) - k + 1)} if k and item else set()
                for s in range(len(ws) - k + 1):
                    if tuple(ws[s:s + k]) in wins:
                        hit.update(range(s, s + k))
                        its.add(item)
            g = got[i]
            assert (g.n_words, g.n_hit, g.n_items) == (len(ws), len(hit), len(its)), (block, i)
            assert g.items_sha256 == hashlib.sha256(",".join(sorted(its)).encode()).hexdigest()
            assert g.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(ws))
    assert decontaminate.decontaminate(docs.limit(0), bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.decontaminate(docs, bench.limit(0)).collect())


def test_packing_edges(docs):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.pack(docs, path).collect()
    assert {r.doc_id for r in got} == {r.doc_id for r in docs.collect()}
    end = zlib.crc32(np.asarray([1], "<u4").tobytes())
    for i in (3, 4):
        assert [(r.length, r.ids_crc32) for r in got if r.doc_id == i] == [(1, end)]
    assert packing.pack(docs.limit(0), path).count() == 0


def test_encoder_equals_library():
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    enc, tok, r = packing.Encoder(path), Tokenizer.from_file(path), random.Random(3)
    alphabet = ["a", "B", "é", " ", "  ", "\n", " \n", "\t", ".", ",", "'s", "'", "12", " ", "<|endoftext|>",
                "漢字", "🙂", "\x1c", " ", "...", "the", "word", "\r\n", "_"]
    for _ in range(3000):
        t = "".join(r.choice(alphabet) for _ in range(r.randint(0, 30)))
        assert enc(t) == np.asarray(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("text", [
    " " * 1_200_000 + "a", "b\n" + "\n" * 1_200_000, "the word" + " \n\u3000" * 400_001 + " c",
    " " * 100_000 + "a", " " * 100_001 + "a", "x " * 60_000 + " " * 99_999])
def test_encoder_equals_library_long_blanks(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert packing.Encoder(path)(text) == np.asarray(want, "<u4").tobytes()


def test_sum_of_squares_choice():
    sos, size = packing.SumOfSquares(16), 16
    count = [0] * 17
    r = np.random.RandomState(1)
    for n in r.randint(1, 16, 500):
        n = int(n)
        options = []  # (sum of squares after, -level)
        for h in range(0, 17 - n):
            if h == 0 or count[h]:
                after = list(count)
                if h:
                    after[h] -= 1
                if h + n < size:
                    after[h + n] += 1
                options.append((sum(x * x for x in after), -h))
        h = -min(options)[1]
        if h:
            count[h] -= 1
        if h + n < size:
            count[h + n] += 1
        sos.place(("d", 0, b"", 0), n)
        assert sos.count.tolist() == count


def test_language_edges(spark, docs):
    train = spark.createDataFrame(
        [(1000 + i, "the house and the garden are green today " * 6, "en") for i in range(12)]
        + [(2000 + i, "das haus und der garten sind heute sehr schön " * 6, "de") for i in range(12)]
        + [(3000, None, "fr")], "doc_id long, text string, lang string")
    model = language.fit(train)
    assert set(model.languages) == {"en", "de", "fr"} or set(model.languages) == {"en", "de"}
    probe = spark.createDataFrame([(1, "the garden and the house"), (2, "der garten und das haus"), (3, None),
                                   (4, "123 ..."), (5, ""), (None, "the house " * 9)], "doc_id long, text string")
    got = {r.doc_id: r for r in language.identify(probe, model, min_evidence=5).collect()}
    assert got[1].lang_pred == "en" and got[2].lang_pred == "de"
    for i in (3, 4, 5):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[None].held_out is False
    assert all(r.lang_pred == "und" for r in language.identify(probe, language.Model((), ())).collect())
    assert language.identify(docs.limit(0), model).count() == 0
    clash = docs.withColumn("score", F.lit("x"))
    assert dict(language.identify(clash, model).dtypes)["score"] == "double"


def test_urls_link_graph(spark):
    pages = [(1, "http://good.example.net/en/a", '<a href="http://friend.test/x">x</a>'),
             (2, "HTTP://BAD.net/p?q", "<a href='//ring.test/'>r</a>"),
             (3, "https://ring.test/1", '<a href="https://bad.net/z">b</a>'),
             (4, "https://friend.test/2", None), (5, None, None), (6, "no scheme", ""),
             (7, "http://example.com/de/x", ""), (8, "http://sub.org/fr/", ""), (9, "http://net", ""),
             (9, "http://net", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {r.page_id: r for r in urls.judge(df).collect()}
    assert (got[1].rule, got[1].verdict) == ("example.net/en/", "allow")
    assert (got[2].host, got[2].path, got[2].rule, got[2].verdict) == ("bad.net", "/p", "net/", "block")
    # ring.test links to nothing but a blocked host, which links back: distrust reaches it.
    assert got[3].rule is None and got[3].verdict == "block" and got[3].distrust > 0.85
    assert got[4].verdict == "allow" and got[4].trust > 0.8
    assert (got[5].host, got[5].path, got[5].verdict) == ("", "", "allow")
    assert (got[7].verdict, got[8].verdict) == ("block", "allow")
    assert (got[9].host, got[9].path, got[9].rule) == ("net", "", None)
    assert urls.judge(df).count() == len(pages) and urls.judge(df.limit(0)).count() == 0


def test_page_rank_brute_force(spark):
    r = np.random.RandomState(2)
    links = [(f"h{a}", f"h{b}", int(n)) for a, b, n in zip(r.randint(0, 12, 50), r.randint(0, 12, 50), r.randint(1, 5, 50))
             if a != b]
    table = {}
    for a, b, n in links:
        table[a, b] = table.get((a, b), 0) + n
    seeds = {f"h{i}": float(x) for i, x in enumerate([1, -1, 0.5, -0.2, 0, 0, 0, 0, 0, 0, 0, 0])}
    got = {x.host: x for x in urls.propagate(
        spark.createDataFrame(list(seeds.items()), "host string, seed double"),
        spark.createDataFrame([(a, b, n) for (a, b), n in table.items()], "src string, dst string, n long")).collect()}
    for name, sign, arcs in (("trust", 1, table), ("distrust", -1, {(b, a): n for (a, b), n in table.items()})):
        out = {h: sum(n for (a, _), n in arcs.items() if a == h) for h in seeds}
        base = {h: max(0.0, sign * s) for h, s in seeds.items()}
        score = dict(base)
        for _ in range(400):  # the fixed point
            score = {h: base[h] + 0.85 * sum(score[a] * n / out[a] for (a, b), n in arcs.items() if b == h)
                     for h in seeds}
        assert all(abs(score[h] - got[h][name]) < 2e-5 for h in seeds)


def test_linked_pages_against_sql(spark):
    """Hosts on a ring and a chord, scores that need many steps, links that do not count."""
    import duckdb

    def page(i, host, path, links, extra=""):
        body = "".join(f'<p><a class="x" href="http://{h}/y">to</a> <A HREF=//{h.upper()}?q>to</A>' for h in links)
        return i, f"http://{host}{path}", f"<html><head><link href='http://cdn.test/a.css'>{extra}</head>{body}</html>"

    ring = [f"h{k}.test" for k in range(7)]
    rows = [page(k, h, "/", [ring[(k + 1) % 7], ring[(k + 3) % 7]] if k % 3 else [ring[(k + 1) % 7]]) for k, h in enumerate(ring)]
    rows += [page(20, "h0.test", "/z", ["ads.net", "h0.test"]), page(21, "ads.net", "/", ["h4.test"]),
             page(22, "good.org", "/fr/", ["h5.test"]), page(23, "alone.test", "/", []),
             page(24, "h1.test", "/s", [], '<!-- <a href="http://ads.net/"> --><script>"<a href=http://ads.net/>"</script>'),
             (25, None, "<a href='http://ads.net/'>x</a>"), (26, "http://h2.test/n", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(urls.judge(pages).collect(), key=lambda r: r.page_id)
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    want = con.sql(f"SELECT page_id, host, path, rule, verdict, trust, distrust FROM ({urls.ORACLE}) ORDER BY page_id").fetchall()
    assert len(got) == len(want) == len(rows)
    for g, w in zip(got, want):
        assert tuple(g[c] for c in ("page_id", "host", "path", "rule", "verdict")) == w[:5]
        assert abs(g.trust - w[5]) < 2e-5 and abs(g.distrust - w[6]) < 2e-5
    by = {r.page_id: r for r in got}
    assert by[21].rule == "net/" and by[20].rule is None and by[20].distrust > 0.85  # links to a blocked host
    assert by[23].trust == by[23].distrust == 0 and by[1].distrust > 0 and by[5].trust > 0


def test_html_extraction(spark):
    def page(i, body):
        return (f'<html><head><title>t{i}</title><script>var a="<p>no</p>";</script></head><body><header>Site</header>'
                f'<nav><ul><li><a href="/{i}">menu {i}</a></li></ul></nav><div class="content"><h2>Head {i}</h2>'
                f'{body}<div class="comments"><p>reader comment number {i} says much more than the article does</p></div>'
                f'<form><p>sign up</p></form></div><aside><p>side</p></aside><footer>foot {i}</footer></body></html>')

    rows = [(i, f"http://a.test/{i}", page(i, f"<p>first&nbsp;part &amp; text {i}\n of <b>it</b></p><p>second {i} part"))
            for i in range(6)]
    rows += [(10, "http://b.test/", "plain text only"), (11, None, None), (12, "http://b.test/2", ""),
             (13, "http://c.test/", "<article><p>alone &lt;here&gt;</p><!-- no --></article>"), (13, "x", "<p>open <i>tags")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {(r.page_id, r.url): r for r in htmltext.extract_pages(df).collect()}
    for i in range(6):
        r = got[i, f"http://a.test/{i}"]
        assert r.text == f"Head {i}\nfirst part & text {i} of it\nsecond {i} part" and r.n_chars == len(r.text)
    assert got[10, "http://b.test/"].text == "plain text only"
    assert got[11, None].text == "" and got[12, "http://b.test/2"].n_chars == 0
    assert got[13, "http://c.test/"].text == "alone <here>" and got[13, "x"].text == "open tags"
    assert htmltext.extract_pages(df.limit(0)).count() == 0


def test_html_without_article_element(spark):
    chrome = "<header>Site</header><nav><a href='/'>menu</a></nav>{}<footer>foot</footer>"
    bodies = {
        "quote": "<div id=content><h1>Head</h1><p>one {0}</p><blockquote>a much longer quote {0} than all else</blockquote><p>end {0}</p></div>",
        "table": "<div id=content><h1>Head</h1><p>one {0}</p><table><tr><td>cell {0} a b c</td><td>d e f g</td></tr></table></div>",
        "list": "<div id=content><p>one {0}</p><ul><li>first point {0} of it</li><li>second point</li></ul><p>end {0}</p></div>",
        "parts": "<div id=content><section class=a><p>one {0}</p></section><section class=b><p>two {0} is longer</p></section>"
                 "<div class=c><p>three {0}</p></div></div>",
        "links": "<div id=content><p><a href='/x'>one {0}</a></p><p><a href='/y'>two {0}</a></p></div>",
        "bare": "<p>one {0}</p><ul><li>two {0} is longer than one</li></ul>",
    }
    want = {"quote": "Head\none {0}\na much longer quote {0} than all else\nend {0}",
            "table": "Head\none {0}\ncell {0} a b c\nd e f g",
            "list": "one {0}\nfirst point {0} of it\nsecond point\nend {0}",
            "parts": "one {0}\ntwo {0} is longer\nthree {0}", "links": "one {0}\ntwo {0}",
            "bare": "one {0}\ntwo {0} is longer than one"}
    rows = []
    for name, body in bodies.items():
        rows += [(f"{name}1", f"http://{name}1.test/", f"<html><body>{chrome.format(body.format('x1'))}</body></html>")]
        rows += [(f"{name}{i}", f"http://{name}.test/{i}", f"<html><body>{chrome.format(body.format(f'x{i}'))}</body></html>")
                 for i in range(10, 16)]
    rows.append(("none", "http://none.test/", bodies["bare"].format("x")))
    copied = f"<html><body>{chrome.format(bodies['quote'].format('x'))}</body></html>"
    rows += [(f"copy{i}", "http://copy.test/", copied) for i in range(4)]
    got = {r.page_id: r.text for r in htmltext.extract_pages(spark.createDataFrame(
        rows, "page_id string, url string, html string")).collect()}
    for name, text in want.items():
        for i in (1, *range(10, 16)):
            assert got[f"{name}{i}"] == text.format(f"x{i}"), (name, i)
    assert got["none"] == want["bare"].format("x")
    assert all(got[f"copy{i}"] == want["quote"].format("x") for i in range(4))


@pytest.mark.parametrize("body, want", [
    ("<h2 id='related-work'>Related</h2><p>text</p><h2 id=social-policy>Policy</h2>", "Related\ntext\nPolicy"),
    ("<section id='menu-costs'><p id='share-prices'>costs</p></section>", "costs"),
    ("<section id='comments'><p>reader</p></section><section class='share box'>x</section><p>text</p>", "text"),
    ("<div id='share-box'>x</div><p>text</p>", "text"),
    ("<p class='notice'>x<p>text<p>text", "text\ntext"),
    ("<p class='notice'>x <b>y<div>text</div>", "text"),
    ("<ul><li class='share'>x<li>text</ul><p>end", "text\nend"),
    ("<ul><li class='share'>x<p>y<ul><li>z</ul>u<li>text</ul>", "text"),
    ("<ul><li><p class=notice>x</li> tail<li>text</ul>", "tail\ntext"),
    ("<dl><dt class=ad>x<dd>text<dd class=ad>y<dt>more</dl>", "text\nmore"),
    ("<table><tr class=promo><td>x<tr><td>text<td class=ad>y<td>cell</table>", "text\ncell"),
    ("<table><tr><td class=ad>x</tr><tr><td>text</table>", "text"),
])
def test_html_noise_blocks(body, want):
    assert htmltext.extract(f"<html><body><article>{body}</article></body></html>") == want


def test_chat_offsets_and_masks(spark):
    turns = [(1, 0, "system", "be kind"), (1, 1, "ann", "hello"), (1, 2, "bob", None), (1, 2, "bob", None),
             (1, 3, None, "hm"), (2, 0, "system", "alone"), (None, None, "ann", "x")]
    turns += [(3, i, "ann" if i % 2 else "bob", f"t{i}") for i in range(2500)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("trained", F.lit(1))
    got = chat.rotate(df).collect()
    by = {}
    for r in got:
        by.setdefault((r.conv_id, r.perspective), []).append(r)
    assert set(by) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann"), (3, "ann"), (3, "bob")}
    for (conv, who), own in by.items():
        own.sort(key=lambda r: r.seq)
        whole = "".join(r.segment for r in own)
        assert [r.seq for r in own] == list(range(len(own)))
        for r in own:
            assert whole[r.start_char:r.start_char + r.n_chars] == r.segment
            assert r.trained == (r.speaker == who)
            if r.trained:
                assert r.segment.startswith("<|im_start|>assistant\n")
                assert whole[r.mask_start:r.mask_end].endswith("<|im_end|>\n")
                assert whole[r.start_char:r.mask_start] == "<|im_start|>assistant\n"
    assert chat.rotate(df.limit(0)).count() == 0


def test_license_sequences(spark):
    s = licenses.SENTENCES
    text = "Intro. The MIT License\n" + s["mit.grant"] + ".\nnoise\n" + s["mit.notice"].upper() + "!\n" + s["mit.warranty"]
    far = s["gpl.free"] + "\n" + "filler\n" * 5 + s["gpl.warranty"]
    rows = [(1, text), (2, "x\nReleased under the MIT License.\ny\nreleased under the mit license"), (3, None), (4, ""),
            (5, far), (6, s["gpl.free"] + ". " + s["gpl.warranty"]), (2, "other text")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("pos", F.lit(1))
    got = {(r.doc_id, r.rule): r for r in licenses.scan(df).collect()}
    assert set(got) == {(1, "mit_full"), (1, "mit_titled"), (2, "mit_reference"), (6, "gpl3_notice")}
    assert got[2, "mit_reference"].n_matches == 2 and got[2, "mit_reference"].first_sentence == 1
    assert licenses.scan(df.limit(0)).count() == 0


NOTICES = {
    "gpl3_notice": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.""",
    "gpl2_notice": """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.""",
    "mpl2_notice": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "apache2_notice": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "mit_full": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL""",
    "bsd3_full": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.""",
}


def test_license_original_notices(spark):
    rows, rules = [], list(NOTICES)
    for k, rule in enumerate(rules):
        lines = NOTICES[rule].split("\n")
        for form, text in enumerate(["\n".join(lines), "\r\n".join(lines), " ".join(lines),
                                     "\n".join(f"# {x}" for x in lines), "/*\n" + "\n".join(f" * {x}" for x in lines)]):
            rows.append((10 * k + form, text))
    rows += [(900, "released under\nthe house.\nthe MIT. License"), (901, "licensed under CC. BY 4.0"),
             (902, "Licensed under\nCC BY 4.0.")]
    got = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, set()).add(r.rule)
    for k, rule in enumerate(rules):
        for form in range(5):
            if (rule, form) == ("apache2_notice", 2):
                continue  # its "copy at" sentence goes on with the address on one line
            want = {rule} | ({"bsd2_full"} if rule == "bsd3_full" else set())
            assert got.get(10 * k + form) == want, (rule, form)
    assert 900 not in got and 901 not in got and got[902] == {"ccby4_reference"}


def test_words_of_equal_polynomial_value_stay_apart(spark):
    """The Thue-Morse word and its complement: equal for every odd base modulo 2**64."""
    swap = str.maketrans("ab", "ba")
    s = "a"
    for _ in range(10):
        s += s.translate(swap)
    t = s.translate(swap)
    from shelfcast.llm import decontaminate, neardup, substrings
    df = spark.createDataFrame([(0, s), (1, t)], "doc_id long, text string")
    assert all(r.kept for r in neardup.near_duplicates(df, shingle=3, percent=85).collect())
    item = spark.createDataFrame([("i", s)], "item_id string, text string")
    assert {r.doc_id: r.n_hit for r in decontaminate.decontaminate(df, item).collect()} == {0: 1, 1: 0}
    rest = " ".join(f"x{i}" for i in range(49))
    long = spark.createDataFrame([(0, f"{s} {rest}"), (1, f"{t} {rest}")], "doc_id long, text string")
    assert {r.n_removed for r in substrings.dedup_substrings(long, keep=["doc_id"]).collect()} == {0}
    # The same structure over words, in one long run of shared surroundings.
    words = [f"w{i}" for i in range(60)] + list(s) + [f"v{i}" for i in range(60)]
    other = [f"w{i}" for i in range(60)] + list(t) + [f"v{i}" for i in range(60)]
    runs = spark.createDataFrame([(0, " ".join(words)), (1, " ".join(other))], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in substrings.dedup_substrings(runs, keep=["doc_id"]).collect()}
    first = {tuple(words[i:i + 50]) for i in range(len(words) - 49)}
    gone = set()
    for i in range(len(other) - 49):
        if tuple(other[i:i + 50]) in first:
            gone |= set(range(i, i + 50))
    assert got == {0: 0, 1: len(gone)}


@pytest.mark.parametrize("shingle, percent", [(3, 85), (5, 80), (3, 70)])
def test_near_duplicate_families_equal_brute_force(spark, shingle, percent):
    """Chains of mutated copies round a few centres: many members share residual shingles."""
    import random

    from shelfcast.llm import neardup

    r, texts = random.Random(4), []
    for g in range(8):
        family = [[f"g{g}w{r.randrange(400)}" for _ in range(r.choice([30, 80, 150]))]]
        for _ in range(35):
            copy = list(r.choice(family))
            for _ in range(r.randrange(0, max(2, len(copy) // 14))):
                copy[r.randrange(len(copy))] = f"g{g}m{r.randrange(60)}"
            if r.random() < 0.2:
                copy = copy[:max(10, len(copy) - r.randrange(8))]
            family.append(copy)
        texts += family
    sets = [set(zip(*[t[k:] for k in range(shingle)])) for t in texts]
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a & b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in neardup.near_duplicates(df, shingle=shingle, percent=percent).collect()}
    assert got == {i: root(i) for i in range(len(sets))}
