"""Quality rules: base statistics of a text, and cross-document line frequency.

The base statistics come from the text alone.  The method then looks across
documents: every line is normalised (stripped, A-Z lower-cased, runs of white
space made one blank, digits made 0) and hashed; per host (``source``) the
distinct documents that hold a hash are counted, copies of one text counting
once; a line that is in more than ``min_docs`` documents of a host is removed,
however large the host; and a document that has less than ``min_left`` of its
words left is depleted and rejected.

A task turns the texts into statistics and line hashes (a few per cent of the
text), which are stored; counting shuffles (host, hash, text hash) without
repeats, so one line on every page of a host that holds a third of the corpus
is counted in parts first.  One join by document then brings each text its
frequent lines, and they are cut (``cut_lines``); ``n_removed`` and ``kept``
are read off the cut text.  ``drop_frequent_lines`` and ``clean`` return texts.

Defined cases: a null or empty text has no words and fails the base; a null
host is a host; repeated rows are judged alike and count as one text; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinrisk.llm.bytewords import SPACE, windows, word_hashes
from clinrisk.llm.common import map_arrow, n_words, ship, stored, table

MIN_DOCS = 10
MIN_LEFT = 0.3
MIN_WORDS = 20
WINDOW = 8
SYMBOLS = b"#*$%&|<>"

_NORMAL = bytes(ord("0") if 48 <= b <= 57 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_IN_WORD = np.array([0 if SPACE[b] or 0x80 <= b < 0xC0 else 1 for b in range(256)], np.uint8)  # one per code point
_SYMBOL = np.array([b in SYMBOLS for b in range(256)], np.uint8)
_SIGNED = 1 << 63


def repeated_words(counts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Per text: words covered by WINDOW-word windows found twice or more in it."""
    out = np.zeros(len(counts), np.int64)
    if len(hashes) < WINDOW:
        return out
    owner = np.repeat(np.arange(len(counts)), counts)
    whole = np.flatnonzero(owner[:len(owner) - WINDOW + 1] == owner[WINDOW - 1:])
    keys = windows(hashes, WINDOW)[whole] ^ (owner[whole].astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, whole[twice], 1)
    np.add.at(cover, whole[twice] + WINDOW, -1)
    return np.bincount(owner[np.cumsum(cover[:-1]) > 0], minlength=len(counts))


def line_hash(words: list[bytes]) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(words).translate(_NORMAL)) - _SIGNED


def without_lines(text: bytes, gone: set[int]) -> bytes:
    """The text without the lines whose hash is in ``gone``."""
    return b"\n".join(line for line in text.split(b"\n") if not (words := line.split()) or line_hash(words) not in gone)


def line_statistics(text: bytes) -> tuple[int, list[int]]:
    """Lines with a word equal to an earlier line; the distinct normalised
    lines' hashes."""
    seen, repeats, found = set(), 0, {}
    for line in text.split(b"\n"):
        words = line.split()
        if not words:
            continue
        if line in seen:
            repeats += 1
        seen.add(line)
        found.setdefault(line_hash(words))
    return repeats, list(found)


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Per row: uid, id, host, th, the base statistics, the text's hash, and its distinct lines."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))
    schema = (f"uid bigint, id {rows.schema['id'].dataType.simpleString()}, host {rows.schema['host'].dataType.simpleString()}, "
              "th bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
              "content bigint, lines array<bigint>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = [(t.as_py() or "").encode() for t in batch.column(2)]
            n_words, repeats = [], []
            for _, counts, hashes in word_hashes(texts):
                n_words.append(counts)
                repeats.append(repeated_words(counts, hashes))
            raw = [np.frombuffer(t, np.uint8) for t in texts]
            lines = [line_statistics(t) for t in texts]
            yield pa.RecordBatch.from_arrays([
                pa.array(range(uid, uid + len(texts)), pa.int64()), batch.column(0), batch.column(1), batch.column(3),
                pa.array(np.concatenate([*n_words, np.zeros(0, np.int64)])),
                pa.array([int(_IN_WORD[b].sum(dtype=np.int64)) for b in raw], pa.int64()),
                pa.array([int(_SYMBOL[b].sum(dtype=np.int64)) for b in raw], pa.int64()),
                pa.array([x[0] for x in lines], pa.int64()),
                pa.array(np.concatenate([*repeats, np.zeros(0, np.int64)])),
                pa.array([xxhash.xxh3_64_intdigest(t) - _SIGNED for t in texts], pa.int64()),
                pa.array([x[1] for x in lines], pa.list_(pa.int64())),
            ], names=[c.split()[0] for c in schema.split(", ")])
            uid += len(texts)
    return map_arrow(rows, run, schema)


def frequent_lines(stats: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(host, line) in more than ``min_docs`` documents of the host."""
    held = stats.select("host", "content", F.explode("lines").alias("line")).distinct()
    n_docs = held.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") > min_docs)
    return n_docs.select(F.col("host").alias("h"), F.col("line").alias("l"))


_STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def cut_lines(docs: DataFrame, min_left: float = MIN_LEFT, min_docs: int = MIN_DOCS,
              id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Per row: the row as a struct, the statistics, ``cut_text`` (null where no
    line goes), ``n_removed`` words that went, base_failed, kept."""
    ship(docs.sparkSession)
    stats = stored(text_statistics(docs, id_col, text_col, host_col), "line-statistics")
    frequent = stored(frequent_lines(stats, min_docs), "frequent-lines")
    # Rows of one (id, host, text) are alike: one stands for all.  Its uid must be the same in both reads.
    least = stats.groupBy("id", "host", "th").agg(F.min("uid").alias("uid")).select("uid")
    one = stats.join(stored(least, "line-rows"), "uid", "left_semi")
    lines = one.select("uid", "host", F.explode("lines").alias("line"))
    gone = (lines.join(frequent, F.col("host").eqNullSafe(F.col("h")) & (F.col("line") == F.col("l")))
            .groupBy("uid").agg(F.collect_list("line").alias("gone")))
    found = one.select("uid", "id", "host", "th", *_STATISTICS).join(gone, "uid", "left").drop("uid")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("rid"), F.col(host_col).alias("rhost"), F.xxhash64(text_col).alias("rth"))
    out = rows.join(found.hint("shuffle_hash"), F.col("rid").eqNullSafe(F.col("id")) & F.col("rhost").eqNullSafe(F.col("host"))
                    & (F.col("rth") == F.col("th")))

    @F.arrow_udf("string")
    def cut(texts: pa.Array, gone: pa.Array) -> pa.Array:
        return pa.array([None if t is None else without_lines(t.encode(), set(g)).decode()
                         for t, g in zip(texts.to_pylist(), gone.to_pylist())], pa.string())
    # Only texts that lose a line go to a worker.
    text = F.when(F.col("gone").isNotNull(), F.col("row")[text_col])
    out = out.withColumn("cut_text", cut(text, F.col("gone")))
    removed = F.when(F.col("cut_text").isNull(), 0).otherwise(F.col("n_words") - n_words(F.col("cut_text"))).cast("bigint")
    out = out.select("row", "id", "host", *_STATISTICS, "cut_text", removed.alias("n_removed"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    depleted = F.col("n_words") - F.col("n_removed") < min_left * F.col("n_words")
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


def judge(docs: DataFrame, **params) -> DataFrame:
    """Per row: id, host, the statistics, n_removed, base_failed, kept."""
    return cut_lines(docs, **params).drop("row", "cut_text")


def _texts(cut: DataFrame, columns: list[str], text_col: str) -> DataFrame:
    changed = F.col("cut_text").isNotNull()
    fresh = {text_col: F.col("cut_text"), "n_chars": F.char_length("cut_text").cast("bigint")}
    return cut.select(*[(F.when(changed, fresh[c]).otherwise(F.col("row")[c]) if c in fresh else F.col("row")[c]).alias(c) for c in columns])


def drop_frequent_lines(docs: DataFrame, text_col: str = "text", **params) -> DataFrame:
    """All documents with the frequent lines cut from the text and ``n_chars``
    renewed, in the input's columns."""
    return _texts(cut_lines(docs, text_col=text_col, **params), docs.columns, text_col)


def clean(docs: DataFrame, text_col: str = "text", **params) -> DataFrame:
    """The kept documents, with the frequent lines cut, in the input's columns."""
    return _texts(cut_lines(docs, text_col=text_col, **params).where("kept"), docs.columns, text_col)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
p AS (SELECT rid, unnest(range(1, len(ws) - 6)) AS i, ws FROM w WHERE len(ws) >= 8),
g AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS gram FROM p),
r AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT rid, count(DISTINCT i + j) AS n_repeat_words FROM r, unnest(range(0, 8)) u(j) GROUP BY rid),
l AS (SELECT rid, source, text, unnest(string_split(text, chr(10))) AS line FROM d),
n AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
             translate(array_to_string(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), ' '),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000') AS key FROM l),
u AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM n WHERE words > 0 GROUP BY rid),
f AS (SELECT source, key FROM n WHERE words > 0 GROUP BY source, key HAVING count(DISTINCT text) > {MIN_DOCS}),
x AS (SELECT rid, sum(words) AS removed FROM n JOIN f ON n.source IS NOT DISTINCT FROM f.source AND n.key = f.key
      WHERE words > 0 GROUP BY rid),
s AS (SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(length(array_to_string(ws, '')), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(removed, 0) AS removed
      FROM w LEFT JOIN c USING (rid) LEFT JOIN u USING (rid) LEFT JOIN x USING (rid)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT n_words - removed < {MIN_LEFT} * n_words AS kept FROM b
"""
