"""License scans: an exact set-similarity join of text blocks with license templates.

A template is a notice or a paragraph of a license text.  A block is a line, or
a run of as many words as a template has, across line ends and paragraphs too; a
token is a word.  Template tokens are ordered by their
frequency in the whole corpus, the rarest first.  A block that holds the
threshold's share of a template holds one of the template's prefix tokens; the
length and positional filters thin the candidates, and an exact count decides.
All of it is DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.llm.store import materialise

#: The phrases whose places count, and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
#: Templates (label, words) of common notices and of the paragraphs of license texts; a parameter of the scan.
#: The words of public license texts.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0-1.0", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd", "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
)
THRESHOLD = 0.9
#: What parts words, before and after A-Z is lower-cased.
_PARTING = "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum())  # listed singly: the JVM matches them by one table
_GAP, _IN = f"[{_PARTING}]", f"[^{_PARTING}]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text as an array, A-Z lower-cased."""
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(f"({_IN}+)"), 1)


def _any_of(phrases: list[str]) -> str:
    """A pattern that matches where one of the phrases' words stand."""
    return rf"(?i)(?<!{_IN})(?:{'|'.join(f'{_GAP}+'.join(p.split()) for p in phrases)})(?!{_IN})"


def _maybe(low: Column, phrases: list[str]) -> Column:
    """Has the lower-cased text all words of some phrase, wherever; spares most texts the pattern."""
    out = F.lit(False)
    for phrase in phrases:
        every = F.lit(True)
        for word in sorted(set(phrase.split()), key=len, reverse=True):
            every = every & low.contains(word)
        out = out | every
    return out


def _starts(words: Column, phrase: str) -> Column:
    parts = phrase.split()
    here = [F.lit(True)]

    def stands(i: Column) -> Column:
        out = here[0]
        for k, part in enumerate(parts):
            out = out & (F.get(words, i + k) == part)
        return F.coalesce(out, F.lit(False))

    return F.filter(F.sequence(F.lit(0), F.greatest(F.size(words), F.lit(1)) - 1), stands)


def frequencies(docs: DataFrame, text: Column, vocabulary: list[str]) -> dict[str, int]:
    """How often the whole corpus has each word of ``vocabulary``; other words are dropped where
    they are read, and only these few counts are shuffled."""
    words = docs.select(F.explode(F.split(F.lower(text), f"{_GAP}+", -1)).alias("known")).where(F.col("known").isin(*vocabulary))
    return {r["known"]: r["n"] for r in words.groupBy("known").agg(F.count("*").alias("n")).collect()}


def matches(docs: DataFrame, key: list[Column], text: Column, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(k0, k1, ..., label, score): templates of which a line of the text, or a run of as many
    words as the template has, holds ``threshold`` or more of the words.

    ``score`` is the largest share.  Every such line and run is found; lines of any
    length are compared whole, and runs cross line ends, as wrapped texts do.
    """
    spark = docs.sparkSession
    sets = [(label, sorted(set(words.split()))) for label, words in templates]
    vocabulary = sorted({w for _, words in sets for w in words})
    counts = frequencies(docs, text, vocabulary)
    place = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    index, heads = [], set()
    for n, (label, words) in enumerate(sets):
        by_rank = sorted(words, key=place.__getitem__)
        ranks = [place[w] for w in by_rank]
        need = math.ceil(threshold * len(ranks) - 1e-9)
        for at, word in enumerate(by_rank[: len(ranks) - need + 1]):
            if counts.get(word):  # a word that no text holds proposes nothing
                index.append((ranks[at], n, label, at, need, ranks, len(templates[n][1].split())))
                heads.add(word)
    names = [f"k{i}" for i in range(len(key))]
    head = _any_of(sorted(heads)) if heads else "(?!)"
    index = F.broadcast(spark.createDataFrame(index, "rank int, template int, label string, at int, need int, ranks array<int>, length int"))  # the templates' prefixes
    some = docs.where(text.rlike(head)).select(*(k.alias(n) for k, n in zip(key, names)), text.alias("body"))
    some = materialise(some, "licence-texts")  # few texts hold one of the templates' rarest words
    lines = some.select(*names, F.explode(F.split("body", "\n", -1)).alias("line")).where(F.col("line").rlike(head))
    ranked = F.create_map(*(F.lit(x) for w, i in place.items() for x in (w, i)))
    own = F.array_sort(F.filter(F.transform(F.array_distinct(words_of(F.col("line"))), lambda w: F.try_element_at(ranked, w)), lambda r: r.isNotNull()))
    pairs = lines.select(*names, own.alias("own")).select(*names, "own", F.posexplode("own").alias("here", "rank")).join(index, "rank")
    pairs = pairs.where(F.size("own") >= F.col("need"))  # length
    pairs = pairs.where(1 + F.least(F.size("ranks") - F.col("at") - 1, F.size("own") - F.col("here") - 1) >= F.col("need"))  # position
    held = F.size(F.array_intersect("own", "ranks"))
    exact = pairs.where(held >= F.col("need")).select(*names, "label", (held / F.size("ranks")).alias("score"))

    # runs: the words around each of a template's prefix tokens, and every run among them that holds it
    most = max(len(words.split()) for _, words in templates)
    heads_at = sorted(place[w] for w in heads) or [-1]
    keyed = some.select(*names, F.transform(words_of(F.col("body")), lambda w: F.try_element_at(ranked, w)).alias("all"))
    hits = F.filter(F.transform("all", lambda r, i: F.when(r.isin(heads_at), i)), lambda i: i.isNotNull())
    hits = F.transform(hits, lambda i: F.struct(F.get("all", i).alias("rank"), F.least(i, F.lit(most - 1)).alias("here"), F.slice("all", F.greatest(i - most + 2, F.lit(1)), F.lit(2 * most - 1)).alias("near")))
    around = keyed.select(*names, F.explode(hits).alias("hit")).select(*names, "hit.*").join(index, "rank")
    around = around.where(F.size(F.array_intersect("near", "ranks")) >= F.col("need"))  # no run has more of them than all that is near
    starts = F.sequence(F.greatest(F.col("here") - F.col("length") + 1, F.lit(0)), F.col("here"))
    run = F.array_max(F.transform(starts, lambda o: F.size(F.array_intersect(F.slice("near", o + 1, F.col("length")), "ranks"))))
    around = around.withColumn("held", run).where(F.col("held") >= F.col("need"))
    exact = exact.unionByName(around.select(*names, "label", (F.col("held") / F.size("ranks")).alias("score")))
    return exact.groupBy(*names, "label").agg(F.max("score").alias("score"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score), a row for each row of ``docs``.

    Null and empty texts have no word and no label: empty strings, score 0.
    Repeated rows get equal results, an empty table gives an empty table, other
    columns are ignored, whatever their names.  The score is 1 with a base
    phrase, else the largest share of a template that a line or run holds, if it
    is at the threshold, else 0.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    key = [F.col("id"), F.md5(F.col("text").cast("binary"))]
    found = matches(rows, [key[0], key[1].alias("k1")], F.col("text"), templates, threshold)
    found = found.groupBy("k0", "k1").agg(F.collect_set("label").alias("more"), F.max("score").alias("share"))
    found = materialise(found, "licences")

    hit = _maybe(F.col("low"), [p for p, _ in PHRASES]) & F.col("text").rlike(_any_of([p for p, _ in PHRASES]))
    places = F.array(*(_starts(F.col("words"), p) for p, _ in PHRASES))
    base = rows.withColumn("low", F.lower("text")).withColumn("hit", hit).withColumn("words", F.when(F.col("hit"), words_of(F.col("text")))).withColumn("places", F.when(F.col("hit"), places))
    flat = F.flatten("places")
    labels = F.filter(F.array(*(F.when(F.size(F.get("places", F.lit(i))) > 0, F.lit(label)) for i, (_, label) in enumerate(PHRASES))), lambda x: x.isNotNull())
    slim = base.select(
        "id",
        key[1].alias("digest"),
        (F.size(F.split("text", f"{_IN}+", -1)) - 1).cast("long").alias("n_words"),  # gaps around the words, less one
        F.coalesce(F.size(flat), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(flat).cast("long").alias("first_word"),
        F.array_max(flat).cast("long").alias("last_word"),
        F.array_sort(labels).alias("base"),
    ).withColumn("n_base", F.greatest("n_base", F.lit(0)))
    out = slim.join(found, slim["id"].eqNullSafe(found["k0"]) & (slim["digest"] == found["k1"]), "left")
    every = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0)))
    return out.select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"), score.alias("score"))


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql_places() -> str:
    out = []
    for phrase, label in PHRASES:
        parts = phrase.split()
        test = " AND ".join(f"w[i + {k}] = '{p}'" for k, p in enumerate(parts, 1))
        out.append(f"list_filter(range(0, len(w)), lambda i: coalesce({test}, false)) AS \"{label}\"")
    return ", ".join(out)


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ALL = " || ".join(f'"{label}"' for _, label in PHRASES)
_BASE = ", ".join(f"CASE WHEN len(\"{label}\") > 0 THEN '{label}' END" for _, label in PHRASES)
_SETS = ", ".join(f"({i}, '{label}', {sorted(set(words.split()))}, {len(words.split())})" for i, (label, words) in enumerate(TEMPLATES))
_NEED = f"ceil({THRESHOLD} * len(t.ws) - 1e-9)"
OP8_SQL = rf"""
WITH t(tid, label, ws, n) AS (VALUES {_SETS}),
d AS (SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text FROM documents),
w AS (SELECT rid, doc_id, regexp_extract_all(text, '{_WORD}') AS w FROM d),
p AS (SELECT rid, doc_id, len(w) AS n, {_sql_places()} FROM w),
b AS (SELECT rid, doc_id, n, {_ALL} AS places, list_filter([{_BASE}], lambda x: x IS NOT NULL) AS base FROM p),
l AS (SELECT rid, list_distinct(regexp_extract_all(unnest(string_split(text, chr(10))), '{_WORD}')) AS ws FROM d),
c AS (SELECT rid, tid, w FROM (SELECT rid, w, list_distinct(w) AS ws FROM w) u JOIN t ON len(list_intersect(u.ws, t.ws)) >= {_NEED}),
r AS (SELECT rid, label, list_max(list_transform(range(1, len(w) + 1), lambda i: len(list_intersect(list_distinct(w[i:i + t.n - 1]), t.ws)))) AS held, len(t.ws) AS size, {_NEED} AS need FROM c JOIN t USING (tid)),
m AS (SELECT rid, label, len(list_intersect(l.ws, t.ws)) / len(t.ws) AS share FROM l JOIN t ON len(list_intersect(l.ws, t.ws)) >= {_NEED} UNION ALL SELECT rid, label, held / size FROM r WHERE held >= need),
g AS (SELECT rid, list(DISTINCT label) AS more, max(share) AS share FROM m GROUP BY rid)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base, CAST(list_min(places) AS BIGINT) AS first_word, CAST(list_max(places) AS BIGINT) AS last_word,
  array_to_string(list_sort(base), ',') AS base_labels, array_to_string(list_sort(list_distinct(base || coalesce(more, []))), ',') AS labels,
  CASE WHEN len(places) > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM b LEFT JOIN g USING (rid)
"""
