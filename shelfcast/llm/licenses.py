"""Operator 10: licence scans by sentence rules.

A text is cut into numbered pieces (line ends, and any of .!?:; before white
space), each piece is normalised (lower case, everything but letters and
digits becomes one blank, so comment marks vanish).  A known licence sentence
is one piece or a run of pieces that follow each other: wrapped lines, parts
around ':' or ';' and around the full stop of 'v.' are joined, other sentence
ends are not crossed.  A rule is an ordered list of identifiers; it matches
where its identifiers follow each other in the text with at most ``gap`` other
pieces, blank ones counted, between the end of one and the start of the next.
The lookup walks the beginnings of the fixed sentences below in the scan task
(bounded: it is source code); only known sentences reach the shuffle by
document.  A document whose known sentences are many is bounded by its own
length.

Edge cases: null, empty and unlicensed texts give no row; repeated rows of one
``doc_id`` with equal texts give one set of findings, with different texts
each text is scanned by itself; ``n_matches`` counts the start sentences from
which a rule matches; a rule may match beside another; extra columns are not
carried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

# Sentences of public licence notices, normalised, by identifier.
SENTENCES: dict[str, str] = {
    "mit.release": "released under the mit license",
    "mit.name": "the mit license",
    "mit.name_short": "mit license",
    "mit.grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit.notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit.warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "apache.release": "licensed under the apache license version 2 0",
    "apache.release_the": "licensed under the apache license version 2 0 the license",
    "apache.use": "you may not use this file except in compliance with the license",
    "apache.copy": "you may obtain a copy of the license at",
    "apache.asis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "gpl3.release": "this work is licensed under the gnu general public license version 3",
    "gpl.free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2.free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl.warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "bsd.grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd.source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd.binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd.names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "mpl.notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "ccbync.release": "licensed under cc by nc 4 0",
    "ccby.release": "licensed under cc by 4 0",
    "ccbysa.release": "licensed under cc by sa 4 0",
}

#: (rule, licence, identifiers in order, sentences allowed between two of them)
RULES: list[tuple[str, str, tuple[str, ...], int]] = [
    ("mit_reference", "MIT", ("mit.release",), 0),
    ("mit_full", "MIT", ("mit.grant", "mit.notice", "mit.warranty"), 3),
    ("mit_titled", "MIT", ("mit.name", "mit.grant"), 3),
    ("mit_titled_short", "MIT", ("mit.name_short", "mit.grant"), 3),
    ("apache2_reference", "Apache-2.0", ("apache.release",), 0),
    ("apache2_notice", "Apache-2.0", ("apache.release_the", "apache.use", "apache.copy", "apache.asis"), 3),
    ("gpl3_reference", "GPL-3.0", ("gpl3.release",), 0),
    ("gpl3_notice", "GPL-3.0-or-later", ("gpl.free", "gpl.warranty"), 2),
    ("gpl2_notice", "GPL-2.0-or-later", ("gpl2.free", "gpl.warranty"), 2),
    ("bsd2_full", "BSD-2-Clause", ("bsd.grant", "bsd.source", "bsd.binary"), 3),
    ("bsd3_full", "BSD-3-Clause", ("bsd.grant", "bsd.source", "bsd.binary", "bsd.names"), 3),
    ("mpl2_notice", "MPL-2.0", ("mpl.notice",), 0),
    ("ccbync4_reference", "CC-BY-NC-4.0", ("ccbync.release",), 0),
    ("ccby4_reference", "CC-BY-4.0", ("ccby.release",), 0),
    ("ccbysa4_reference", "CC-BY-SA-4.0", ("ccbysa.release",), 0),
]

CUT = r"[.!?:;]*\n|[.!?:;]+[ \t\r]+"
_CUT, _STOP, _OTHER = re.compile(CUT), re.compile(r"[.!?]"), re.compile(r"[^a-z0-9]+")


def _rule_table(spark) -> DataFrame:
    return spark.createDataFrame(
        [(r, lic, list(ids), ids[0], gap) for r, lic, ids, gap in RULES],
        "rule string, licence string, ids array<string>, first_id string, gap int")


def _links() -> dict[str, tuple[str | None, bool]]:
    """Every word-wise beginning of a known sentence: (identifier if whole, whether one goes on)."""
    out: dict[str, tuple[str | None, bool]] = {}
    for sentence, sid in ((s, i) for i, s in SENTENCES.items()):
        words = sentence.split(" ")
        for k in range(1, len(words)):
            start = " ".join(words[:k])
            out[start] = (out.get(start, (None, False))[0], True)
        out[sentence] = (sid, out.get(sentence, (None, False))[1])
    return out


def find_sentences(text: str, links: dict) -> Iterator[tuple[int, int, str]]:
    """(first piece, last piece, identifier) of the known sentences of a text.

    A sentence may run over pieces whose cut is a line end, ':' or ';', or a
    full stop after 'v'; pieces without a letter or digit are passed over.
    """
    pieces, at = [], 0  # pieces with words: (number, normalised, ends a sentence)
    for n, cut in enumerate(_CUT.finditer(text)):
        pieces.append((n, text[at:cut.start()], cut[0]))
        at = cut.end()
    pieces.append((len(pieces), text[at:], ""))
    words, hard = [], []
    for n, raw, cut in pieces:
        piece = _OTHER.sub(" ", raw.lower()).strip()
        stop = bool(_STOP.search(cut)) and not (cut[0] == "." and (piece == "v" or piece.endswith(" v")))
        if piece:
            words.append((n, piece))
            hard.append(stop)
        elif stop and hard:
            hard[-1] = True
    for i, (n, piece) in enumerate(words):
        joined, j = piece, i
        while joined in links:
            sid, more = links[joined]
            if sid:
                yield n, words[j][0], sid
            if not more or hard[j] or j + 1 == len(words):
                break
            j += 1
            joined = f"{joined} {words[j][1]}"


def known_sentences(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Known licence sentences: key, row hash, first and last piece, identifier."""
    kind = dict(df.select(F.col(key).alias("_key")).dtypes)["_key"]

    def run(batches):
        import pyarrow as pa

        links = _links()
        for batch in batches:
            rows = []
            for i, body in enumerate(batch.column(2)):
                rows += [(i, *x) for x in find_sentences(body.as_py(), links)]
            cols = list(zip(*rows)) or [[]] * 4
            at = pa.array(cols[0], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(cols[1], pa.int32()),
                 pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.string())],
                names=["_key", "_row", "pos", "last", "sid"])

    src = df.select(F.col(key).alias("_key"), F.xxhash64(F.col(text)).alias("_row"), F.col(text).alias("_text"))
    return src.filter("_text IS NOT NULL").mapInArrow(run, f"_key {kind}, _row long, pos int, last int, sid string")


def scan(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and matched rule: first sentence, number of matches."""
    spark = df.sparkSession
    found = (known_sentences(df, key, text)
             .groupBy("_key", "_row")
             .agg(F.sort_array(F.collect_set(F.struct("pos", "last", "sid"))).alias("seq")))
    starts = found.select("*", F.explode("seq").alias("at"))
    hits = starts.join(F.broadcast(_rule_table(spark)), F.col("at.sid") == F.col("first_id"))
    # Walk the rule's identifiers; the state holds the last pieces reached.
    walk = F.aggregate(
        F.slice("ids", F.lit(2), F.size("ids")), F.array(F.col("at.last")),
        lambda ends, want: F.array_distinct(F.transform(
            F.filter("seq", lambda s: (s["sid"] == want) & F.exists(
                ends, lambda e: (s["pos"] > e) & (s["pos"] <= e + 1 + F.col("gap")))), lambda s: s["last"])))
    hits = hits.filter(F.size(walk) > 0)
    return (hits.groupBy(F.col("_key").alias(key), "rule", "licence")
            .agg(F.min("at.pos").cast("long").alias("first_sentence"),
                 F.countDistinct("at.pos").alias("n_matches")))


def _values(rows) -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(str(x) if isinstance(x, int) else q(x) for x in r) + ")" for r in rows)


# The SQL numbers each rule's identifiers and checks them step by step.
ORACLE = f"""
WITH RECURSIVE k(sentence, sid) AS (VALUES {_values([(s, i) for i, s in SENTENCES.items()])}),
r(rule, licence, step, sid, gap, n) AS (VALUES {_values(
    [(r, lic, n, sid, gap, len(ids)) for r, lic, ids, gap in RULES for n, sid in enumerate(ids)])}),
c AS (SELECT doc_id, string_split_regex(text, '[.!?:;]*\\n|[.!?:;]+[ \\t\\r]+') AS parts
      FROM documents WHERE text IS NOT NULL),
x AS (SELECT doc_id, unnest(parts) AS raw, unnest(generate_series(0, len(parts) - 1)) AS pos FROM c),
s AS (SELECT DISTINCT doc_id, pos, sid
      FROM (SELECT doc_id, pos, trim(regexp_replace(lower(raw), '[^a-z0-9]+', ' ', 'g')) AS sentence FROM x)
      JOIN k USING (sentence)),
m AS (SELECT doc_id, rule, licence, step, n, pos AS first_pos, pos AS last_pos
      FROM s JOIN r USING (sid) WHERE step = 0
      UNION ALL
      SELECT m.doc_id, m.rule, m.licence, r.step, m.n, m.first_pos, s.pos
      FROM m JOIN r ON r.rule = m.rule AND r.step = m.step + 1
      JOIN s ON s.doc_id = m.doc_id AND s.sid = r.sid AND s.pos > m.last_pos AND s.pos <= m.last_pos + 1 + r.gap)
SELECT doc_id, rule, licence, CAST(min(first_pos) AS BIGINT) AS first_sentence,
       count(DISTINCT first_pos) AS n_matches
FROM m WHERE step = n - 1 GROUP BY doc_id, rule, licence
"""
