"""Operator 5: HTML extraction by equivalence-class template deduction.

Tokens of a page are its tags (with class and id, under the path of structural
elements around them) and its text pieces.  Over the pages of one host, tokens
with equal occurrence vectors form an equivalence class; the vector is held as
an order-free signature (xor of hashed page and count), so classes come from
one partial aggregation and no host is gathered in one task.  Classes of two
tokens or more, once per page, on enough pages, form the skeleton.  A class is
valid if its tokens stand in one order on all pages; the tokens of valid
classes cut a page into slots.  Classes are not nested, and classes on under
``MIN_SHARE`` of a host's pages are left out.  The slot that holds most text on
average over the host's pages points to the article; tag and class rules
decide: the <article> or <main> around its richest element, or else the
smallest element around all text that is not the template's, is extracted block
by block.  Menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles and reader comments inside it are skipped by element and by class or id.

Hosts with fewer than ``MIN_PAGES`` pages have no classes to speak of; there
the whole page is one slot.  Where all words stand in links, links count.

Edge cases: null and empty html give empty text; null urls share one host;
markup that never closes ends with its parent; html without tags is one block;
repeated pages count as pages; huge pages are parsed whole; an empty table
gives no rows; extra columns are not carried.
"""

from __future__ import annotations

import html as _html
import re
from collections import defaultdict

from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.common import written
from shelfcast.llm.urls import host_and_path

MIN_PAGES = 3
MIN_SHARE = 0.05  # of a host's pages that a class must be on

STRUCTURE = frozenset("html head body div section article main nav header footer aside ul ol dl table "
                      "form figure blockquote details fieldset".split())
BLOCKS = STRUCTURE | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption pre hr "
                               "address figcaption legend option summary center".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("head title nav footer aside form noscript template iframe svg button select textarea "
                    "object audio video canvas".split())
RAW = frozenset(("script", "style"))
NOISE = re.compile(r"(?:^|[\s_-])(ads?|advert\w*|sponsor\w*|promo\w*|banner\w*|cookies?|consent|notices?|"
                   r"comments?|disqus|sidebar|menu|nav\w*|breadcrumbs?|share|sharing|social|related|"
                   r"newsletter|subscribe|footer|popup|modal|masthead|toolbar)(?:$|[\s_-])", re.I)
# Ids of these are anchors made from titles; of a section the whole id can tell.
ANCHORED = frozenset("h1 h2 h3 h4 h5 h6 p".split())
# Elements that an opening tag ends if they are still open, up to the next structural one.
_ROWS = frozenset("tr td th p".split())
IMPLIED = {
    "li": frozenset(("li", "p")), "dt": frozenset(("dt", "dd", "p")), "dd": frozenset(("dt", "dd", "p")),
    "td": frozenset(("td", "th", "p")), "th": frozenset(("td", "th", "p")), "tr": _ROWS,
    "thead": _ROWS, "tbody": _ROWS | {"thead", "tbody", "tfoot"}, "tfoot": _ROWS | {"thead", "tbody", "tfoot"},
    "option": frozenset(("option",)), "optgroup": frozenset(("option", "optgroup")),
    **{t: frozenset(("p",)) for t in "address article aside blockquote center details div dl fieldset figcaption "
       "figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section summary table ul".split()}}
PARENTS = {t: frozenset(("p",)) for t in "li dt dd td th caption figcaption summary".split()} | {
    "tr": frozenset(("td", "th", "p")), **{t: _ROWS for t in ("thead", "tbody", "tfoot")}}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>", re.S)
_ATTR = re.compile(r"""\b(class|id)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_END = {t: re.compile(rf"</{t}\b[^>]*>|\Z", re.I) for t in RAW}

OPEN, CLOSE, TEXT = 0, 1, 2


def _noise_label(name: str, attrs: list[tuple]) -> bool:
    for key, a, b, c in attrs:
        value = a or b or c
        if key.lower() == "class" or name not in ANCHORED and name != "section":
            if NOISE.search(value):
                return True
        elif name == "section" and (m := NOISE.match(value)) and m.end() == len(value):
            return True
    return False


def parse(page: str) -> list[tuple]:
    """(kind, name or text, label, path, skipped, in link) in page order."""
    out, stack, at, link = [], [], 0, False  # stack: (name, path, skipped)
    path, skip = "", False
    pos, size = 0, len(page)
    while pos < size:
        m = _TOKEN.search(page, pos)
        end = m.start() if m else size
        if end > pos:
            out.append((TEXT, page[pos:end], "", path, skip, link))
        if not m:
            break
        pos = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if name == "a":
                link = False
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    path, skip = (stack[-1][1], stack[-1][2]) if stack else ("", False)
                    break
                if name not in STRUCTURE and stack[i][0] in STRUCTURE:
                    break  # an inline end tag does not close an element around it
                if name in PARENTS and stack[i][0] in PARENTS[name]:
                    del stack[i:]  # its parent ends, which itself is not on the stack
                    path, skip = (stack[-1][1], stack[-1][2]) if stack else ("", False)
                    break
            out.append((CLOSE, name, "", path, skip, link))
            continue
        ends = IMPLIED.get(name)
        if ends:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    del stack[i:]
                    path, skip = (stack[-1][1], stack[-1][2]) if stack else ("", False)
                    break
                if stack[i][0] in STRUCTURE:
                    break
        attrs = _ATTR.findall(m[3])
        marks = " ".join(a or b or c for _, a, b, c in attrs)
        label = f"{name}.{marks}" if marks else name
        out.append((OPEN, name, label, path, skip, link))
        if name in RAW:
            pos = _END[name].search(page, pos).end()
        elif name not in VOID and not m[3].endswith("/"):
            noisy = (name in SKIPPED or (name == "header" and "article" not in path)
                     or bool(marks and name not in ("html", "body") and _noise_label(name, attrs)))
            if name == "a":
                link = True
            if name in STRUCTURE or noisy:
                path = f"{path}>{label}"
                skip = skip or noisy
                stack.append((name, path, skip))
    return out


def _hash(text: str) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def tokens(items: list[tuple]) -> list[int | None]:
    """One token hash per item; blank text has none."""
    out = []
    for kind, name, label, path, _, _ in items:
        if kind == TEXT:
            text = " ".join(name.split())
            out.append(_hash(f"{path}|{text}") if text else None)
        else:
            out.append(_hash(f"{path}<{label}" if kind == OPEN else f"{path}/{name}"))
    return out


def _vectors(pages: DataFrame) -> DataFrame:
    """host, token, signature, pages, most: occurrence vectors."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        for batch in batches:
            sums: dict[tuple, list] = {}
            for host, key, page in zip(*(batch.column(i).to_pylist() for i in range(3))):
                count: dict[int, int] = defaultdict(int)
                for t in tokens(parse(page or "")):
                    if t is not None:
                        count[t] += 1
                for t, c in count.items():
                    mark = xxhash.xxh64_intdigest(f"{key}|{c}") - (1 << 63)
                    s = sums.get((host, t))
                    if s is None:
                        sums[host, t] = [mark, 1, c]
                    else:
                        s[0] ^= mark
                        s[1] += 1
                        s[2] = max(s[2], c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in sums], pa.string()), pa.array([k[1] for k in sums], pa.int64())]
                + [pa.array([v[i] for v in sums.values()], pa.int64()) for i in range(3)],
                names=["host", "token", "sig", "pages", "most"])

    made = pages.select("host", "key", "html").mapInArrow(
        run, "host string, token long, sig long, pages long, most long")
    return made.groupBy("host", "token").agg(
        F.bit_xor("sig").alias("sig"), F.sum("pages").alias("pages"), F.max("most").alias("most"))


def skeleton(pages: DataFrame) -> DataFrame:
    """host, classes: array of (token, class) of unique-role equivalence classes."""
    total = pages.groupBy("host").agg(F.count("*").alias("total")).filter(F.col("total") >= MIN_PAGES)
    unique = _vectors(pages).filter((F.col("most") == 1) & (F.col("pages") >= MIN_PAGES))
    unique = unique.join(total, "host").filter(F.col("pages") >= MIN_SHARE * F.col("total"))
    unique = written(unique.select("host", "token", "sig", "pages"), "html-unique")
    large = unique.groupBy("host", "sig").agg(F.count("*").alias("size")).filter("size > 1")
    return (unique.join(large, ["host", "sig"]).groupBy("host")
            .agg(F.sort_array(F.collect_list(F.struct("token", "sig"))).alias("classes")))


def _gaps(items, toks, known, links=False):
    """Raw slots: (previous token, next token, words, words by path), words in links if asked."""
    prev, words, by_path = 0, 0, defaultdict(int)
    for (kind, name, _, path, skip, link), t in zip(items, toks):
        if t in known:
            yield prev, t, words, by_path
            prev, words, by_path = t, 0, defaultdict(int)
        if kind == TEXT and not skip and (links or not link) and t is not None:
            n = len(name.split())
            words += n
            by_path[path] += n
    yield prev, 1, words, by_path


def _observe(pages: DataFrame) -> DataFrame:
    """host, kind, x, y, n, lo, hi: ranks of class tokens (0), words of slots (1)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sums: dict[tuple, list] = {}
            maps: dict[str, dict] = {}
            for host, page, classes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if host not in maps:
                    maps[host] = {c["token"]: c["sig"] for c in classes.as_py()}
                known = maps[host]
                items = parse(page or "")
                toks = tokens(items)
                rank: dict[int, int] = defaultdict(int)
                for prev, nxt, words, _ in _gaps(items, toks, known):
                    s = sums.setdefault((host, 1, prev, nxt), [0, 0, 0])
                    s[0] += 1
                    s[1] += words
                    if nxt in known:
                        c = known[nxt]
                        r = sums.setdefault((host, 0, c, nxt), [0, rank[c], rank[c]])
                        r[0], r[1], r[2] = r[0] + 1, min(r[1], rank[c]), max(r[2], rank[c])
                        rank[c] += 1
            cols = list(zip(*(k + tuple(v) for k, v in sums.items()))) or [[]] * 7
            types = [pa.string(), pa.int32()] + [pa.int64()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=["host", "kind", "x", "y", "n", "lo", "hi"])

    return pages.select("host", "html", "classes").mapInArrow(
        run, "host string, kind int, x long, y long, n long, lo long, hi long")


def templates(pages: DataFrame) -> DataFrame:
    """host, valid (skeleton tokens of valid classes), known, slots (x, y, mean words)."""
    classes = written(skeleton(pages), "html-classes")
    seen = _observe(pages.join(classes, "host"))
    ranks = (seen.filter("kind = 0").groupBy("host", "x", "y")
             .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    slots = (seen.filter("kind = 1").groupBy("host", "x", "y")
             .agg((F.sum("lo") / F.sum("n")).alias("words")))
    both = written(ranks.select("host", F.lit(0).alias("kind"), "x", "y",
                                (F.col("lo") == F.col("hi")).cast("double").alias("v"))
                   .unionByName(slots.select("host", F.lit(1).alias("kind"), "x", "y", F.col("words").alias("v"))),
                   "html-seen")
    # A class is valid if every token keeps its rank within the class on all pages.
    valid = (both.filter("kind = 0").groupBy("host", "x").agg(F.min("v").alias("ok"), F.collect_list("y").alias("t"))
             .filter("ok = 1").groupBy("host").agg(F.flatten(F.collect_list("t")).alias("valid")))
    gaps = both.filter("kind = 1").groupBy("host").agg(F.collect_list(F.struct("x", "y", "v")).alias("slots"))
    known = classes.select("host", F.transform("classes", lambda c: c["token"]).alias("known"))
    return gaps.join(known, "host").join(valid, "host", "left")


def main_path(items, toks, known, valid, slots, links=False) -> str | None:
    """Path of the element that holds the article, found from the best slot's richest one."""
    best, where = 0.0, None
    score, paths = 0.0, defaultdict(int)
    for prev, nxt, words, by_path in _gaps(items, toks, known, links):
        score += slots.get((prev, nxt), float(words))
        for p, n in by_path.items():
            paths[p] += n
        if nxt in valid or nxt == 1:  # an invalid class does not cut a slot
            if paths and score > best:
                best, where = score, max(paths, key=lambda p: (paths[p], p))
            score, paths = 0.0, defaultdict(int)
    if where is None:
        return None
    parts = where.split(">")
    for name in ("article", "main"):
        for i in range(len(parts) - 1, -1, -1):
            if parts[i] == name or parts[i].startswith(name + "."):
                return ">".join(parts[:i + 1])
    # Lists, tables, quotes and sections have paths of their own: take the element around all
    # text that is not the template's; a page mostly of repeated text is a copy, all of it counts.
    own, every = {where: 0}, {where: 0}
    for (kind, name, _, path, skip, link), t in zip(items, toks):
        if kind == TEXT and t is not None and not skip and (links or not link):
            n = len(name.split())
            every[path] = every.get(path, 0) + n
            if t not in known:
                own[path] = own.get(path, 0) + n
    for path in own if 2 * sum(own.values()) >= sum(every.values()) else every:
        other, same = path.split(">"), 0
        while same < min(len(parts), len(other)) and parts[same] == other[same]:
            same += 1
        parts = parts[:same]
    return ">".join(parts)


def extract(page: str, known=frozenset(), valid=frozenset(), slots=None) -> str:
    items = parse(page)
    toks = tokens(items)
    where = main_path(items, toks, known, valid, slots or {})
    if where is None:  # no words but in links
        where = main_path(items, toks, known, valid, {}, links=True)
    if where is None:
        return ""
    blocks, words = [], []
    for kind, name, _, path, skip, _ in items:
        if kind == TEXT:
            if not skip and (not where or path == where or path.startswith(where + ">")):
                words.append(_html.unescape(name))
        elif name in BLOCKS:
            blocks.append(words)
            words = []
        elif name == "br":
            words.append(" ")
    blocks.append(words)
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    host = host_and_path(F.col("url"))[0]
    src = pages.select("page_id", "url", "html", host.alias("host"),
                       F.xxhash64("page_id", "url").alias("key"))
    made = written(templates(src), "html-templates")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            maps: dict[str, tuple] = {}
            texts = []
            for i, (host, page) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3))):
                if host not in maps:
                    known, valid, slots = (batch.column(k)[i].as_py() or [] for k in (4, 5, 6))
                    maps[host] = (frozenset(known), frozenset(valid), {(s["x"], s["y"]): s["v"] for s in slots})
                texts.append(extract(page.as_py() or "", *maps[host]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    joined = src.join(made, "host", "left").select("page_id", "url", "host", "html", "known", "valid", "slots")
    kind = dict(pages.dtypes)["page_id"]
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


# The test pages hold their article in <article>; block ends as above.
ORACLE = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*)</article>', 1) AS body FROM pages),
b AS (SELECT page_id, url, string_split(regexp_replace(regexp_replace(body,
        '(?i)</?(p|h1|h2|h3|h4|li|ul|ol|div|section|blockquote)(\s[^>]*)?>', chr(1), 'g'),
        '<[^>]*>', ' ', 'g'), chr(1)) AS parts FROM a),
c AS (SELECT page_id, url, list_filter(list_transform(parts, lambda p: trim(regexp_replace(
        replace(replace(replace(replace(replace(replace(p, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'),
          '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '\s+', ' ', 'g'))), lambda p: p <> '') AS parts FROM b),
d AS (SELECT page_id, url, array_to_string(parts, chr(10)) AS text FROM c)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM d
"""
