"""License scans by diagonal voting.

The texts' rolling 3-gram hashes are joined to the 3-grams of license templates
(a broadcast table while they are ``MAX_BROADCAST_GRAMS`` at most, the query's few hundred among them; else both
sides are shuffled).  A hit at text word ``p`` and template gram ``t`` votes for the
diagonal ``p - t``.  Per (document, template, diagonal) the matched grams are
bit masks, one word for 64 grams, so a template may be a whole license;
neighbouring diagonals are merged (words were inserted or
dropped), and a merged span is verified by the share of the template's grams
it holds.  The words of every gram are compared at the join, so a hash
collision cannot vote.

A base phrase stands at a place exactly if all of its grams lie on one
diagonal: these are the ``base`` places.  The method adds labels for spans
that hold at least ``min_share`` of a longer template: ``TEMPLATES`` (one-line notices) and ``NOTICES`` (standard paragraphs),
or a caller's ``templates`` (phrase to label).  ``score`` is the
largest share of a template found (1 where a base phrase stands, 0 without a
verified span).

Only DataFrame functions run.  Texts are scanned twice (grams; word counts);
what is shuffled is hits.

Defined cases: a null text is empty; a document without words has 0 words and
no labels (empty strings, null positions, score 0); repeated rows each get the
full result (masks are idempotent); rows sharing an id but not the text are
told apart by the text's hash; an empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinrisk.llm.common import LOWER, UPPER, ascii_lower, bit, table

K = 3
MERGE_GAP = 4
MIN_SHARE = 0.6
MASK_BITS = 64
MAX_BROADCAST_GRAMS = 10_000

#: FIXED VALUES: phrases and labels of the base count.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Further notices, by label.
TEMPLATES = {
    "released under the mit license": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "you may not use this file except in compliance with the license": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "creative commons attribution noncommercial": "cc-by-nc",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
    "all rights reserved": "all-rights-reserved",
}

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software."""
_MIT_WARRANTY = """The software is provided "as is", without warranty of any kind, express or implied, including but not limited
to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or
copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise,
arising from, out of or in connection with the software or the use or other dealings in the software."""
_BSD_WARRANTY = """This software is provided by the copyright holders and contributors "as is" and any express or implied
warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose
are disclaimed."""
_GNU = "of the GNU {0} Public License"       # longer ones would hold most of each other's grams

#: Standard notices and paragraphs of the licenses themselves, by label.
NOTICES = {
    _MIT: "mit",
    _MIT_WARRANTY: "mit",
    _BSD_WARRANTY: "bsd",
    _GNU.format("General"): "gpl",
    _GNU.format("Lesser General"): "lgpl",
    _GNU.format("Affero General"): "agpl",
    "Creative Commons Attribution-ShareAlike": "cc-by-sa",
}

ALL_TEMPLATES = TEMPLATES | NOTICES

_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = str.maketrans(UPPER, LOWER)


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _NOT_WORD), "")


def template_grams(spark: SparkSession, base: dict[str, str] = BASE_PHRASES,
                   more: dict[str, str] | None = None) -> DataFrame:
    """One row per template gram: template, label, is_base, n_grams, t, w0..w2, gram."""
    more = ALL_TEMPLATES if more is None else more
    rows = []
    for i, (phrase, label) in enumerate([*base.items(), *more.items()]):
        w = [x for x in re.split(_NOT_WORD, phrase.translate(_LOWER)) if x]
        n = len(w) - K + 1
        if n < 1:
            raise ValueError(f"a template has {K} words or more: {phrase!r}")
        rows += [(i, label, i < len(base), n, t, *w[t:t + K]) for t in range(n)]
    names = ("template", "label", "is_base", "n_grams", "t", "w0", "w1", "w2")
    if len(rows) > MAX_BROADCAST_GRAMS:
        frame = spark.createDataFrame(rows, "template int, label string, is_base boolean, n_grams int, t int, w0 string, w1 string, w2 string")
        return frame.withColumn("gram", F.xxhash64("w0", "w1", "w2"))
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    frame = spark.range(1).select(F.inline(F.array(*structs)))
    return F.broadcast(frame.withColumn("gram", F.xxhash64("w0", "w1", "w2")))


def gram_hits(docs: DataFrame, grams: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, template, label, is_base, n_grams, diagonal, t) of every gram of a text that is a template's."""
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), words(F.col(text_col)).alias("ws"))
    # No filter on the word count: it would be pushed below and split every text a second time.
    places = F.when(F.size("ws") >= K, F.sequence(F.lit(0), F.size("ws") - K))
    at = texts.select("id", "th", "ws", F.explode(places).alias("p"))
    w = [F.get("ws", F.col("p") + i) for i in range(K)]
    rolled = at.select("id", "th", "p", *[w[i].alias(f"v{i}") for i in range(K)]).withColumn("gram", F.xxhash64("v0", "v1", "v2"))
    same = (F.col("v0") == F.col("w0")) & (F.col("v1") == F.col("w1")) & (F.col("v2") == F.col("w2"))
    return (rolled.join(grams, "gram").where(same)
            .select("id", "th", "template", "label", "is_base", "n_grams", (F.col("p") - F.col("t")).alias("diagonal"), "t"))


def license_spans(docs: DataFrame, templates: dict[str, str] | None = None, min_share: float = MIN_SHARE, merge_gap: int = MERGE_GAP,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified spans: id, th, template, label, is_base, start (word), share.
    Base phrases give one row per place, whole phrases only."""
    hits = gram_hits(docs, template_grams(docs.sparkSession, more=templates), id_col, text_col)
    what = ["id", "th", "template", "label", "is_base", "n_grams"]
    # Rows of one diagonal and several mask words are peers of the window: they get the same band.
    votes = (hits.groupBy(*what, "diagonal", F.floor(F.col("t") / MASK_BITS).alias("part"))
             .agg(F.bit_or(bit(F.col("t") % MASK_BITS)).alias("mask")))
    one = Window.partitionBy("id", "th", "template").orderBy("diagonal")
    step = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(one), F.lit(merge_gap + 1))
    # Base phrases never merge: each of their diagonals is a place of its own.
    opens = (step > F.when(F.col("is_base"), 0).otherwise(merge_gap)).cast("int")
    bands = votes.withColumn("opens", opens).withColumn("band", F.sum("opens").over(one))
    masks = bands.groupBy(*what, "band", "part").agg(F.min("diagonal").alias("start"), F.bit_or("mask").alias("mask"))
    spans = masks.groupBy(*what, "band").agg(F.min("start").alias("start"), F.sum(F.bit_count("mask")).alias("held"))
    spans = spans.withColumn("share", F.col("held") / F.col("n_grams"))
    good = F.when(F.col("is_base"), F.col("share") == 1.0).otherwise(F.col("share") >= min_share)
    return spans.where(good).select("id", "th", "template", "label", "is_base", "start", "share")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spans = license_spans(docs, id_col=id_col, text_col=text_col, **params)
    base = F.col("is_base")
    found = spans.groupBy("id", "th").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("bigint").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("share").alias("score"))
    rows = docs.select(F.col(id_col).alias("rid"), F.xxhash64(text_col).alias("rth"),
                       F.size(words(F.col(text_col))).cast("bigint").alias("n_words"))
    out = rows.join(found, F.col("rid").eqNullSafe(F.col("id")) & (F.col("rth") == F.col("th")), "left")
    return out.select(F.col("rid").alias("id"), "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
                      "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
                      F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def _oracle() -> str:
    phrases = [*BASE_PHRASES.items(), *ALL_TEMPLATES.items()]
    words_of = [" ".join(x for x in re.split(_NOT_WORD, p.translate(_LOWER)) if x) for p, _ in phrases]
    values = ", ".join(f"({i}, '{w}', '{l}', {str(i < len(BASE_PHRASES)).lower()})" for i, (w, (_, l)) in enumerate(zip(words_of, phrases)))
    return rf"""
WITH t AS (SELECT id AS template, string_split(phrase, ' ') AS tw, label, is_base
           FROM (VALUES {values}) v(id, phrase, label, is_base)),
g AS (SELECT template, label, is_base, len(tw) - 2 AS n_grams, j - 1 AS t, tw[j] AS w0, tw[j + 1] AS w1, tw[j + 2] AS w2
      FROM t, unnest(range(1, len(tw) - 1)) u(j)),
d AS (SELECT row_number() OVER () AS rid, doc_id,
             list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                         'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT rid, unnest(ws) AS v0, generate_subscripts(ws, 1) - 1 AS p FROM d),
r AS (SELECT rid, p, v0, lead(v0) OVER o AS v1, lead(v0, 2) OVER o AS v2 FROM w WINDOW o AS (PARTITION BY rid ORDER BY p)),
v AS (SELECT DISTINCT rid, template, label, is_base, n_grams, p - t AS diagonal, t FROM r JOIN g ON v0 = w0 AND v1 = w1 AND v2 = w2),
q AS (SELECT rid, template, diagonal, is_base, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY rid, template ORDER BY diagonal), {MERGE_GAP + 1}) AS gap
      FROM (SELECT DISTINCT rid, template, diagonal, is_base FROM v)),
b AS (SELECT rid, template, diagonal, sum(CASE WHEN is_base OR gap > {MERGE_GAP} THEN 1 ELSE 0 END) OVER (PARTITION BY rid, template ORDER BY diagonal) AS band FROM q),
s AS (SELECT rid, template, label, is_base, band, min(diagonal) AS start, count(DISTINCT t) / n_grams::DOUBLE AS share
      FROM v JOIN b USING (rid, template, diagonal) GROUP BY rid, template, label, is_base, n_grams, band),
f AS (SELECT * FROM s WHERE share >= CASE WHEN is_base THEN 1.0 ELSE {MIN_SHARE} END)
SELECT doc_id, len(ws)::BIGINT AS n_words, count(*) FILTER (is_base) AS n_base,
       min(start) FILTER (is_base) AS first_word, max(start) FILTER (is_base) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(share), 0.0) AS score
FROM d LEFT JOIN f USING (rid) GROUP BY rid, doc_id, ws
"""


ORACLE = _oracle()
