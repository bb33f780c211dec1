"""Spelling variant grouping: Bloom-guided edit neighbourhoods of a vocabulary.

Two words are near if they differ by one inserted, deleted or replaced code
point.  A word's form is its near word with the largest count, if that is at
least ``RATIO`` times its own; following forms leads to the group's root.

1. ``vocabulary``: runs of letters are counted over all texts (one shuffle of
   partial counts by word); words of ``MIN_CHARS`` code points and
   ``MIN_COUNT`` occurrences stay.
2. ``bloom``: every word sets bits of one 512-bit block in the filter of its length.  All
   filters of a round together take at most ``FILTER_BYTES``: a larger vocabulary takes
   further rounds, by length and then by slices of the hash range, so what is
   broadcast never grows beyond that.
3. ``near_pairs``: each word's edits are hashed without being spelled (a rolling
   polynomial in numpy) and probed.  A pair is found from one side only: the
   deletions of the longer word, and the replacements by a greater code
   point.  Only edits that a filter holds are spelled and shuffled, to an exact join with the
   vocabulary that removes false positives.
4. ``forms``: one aggregation per word; ``roots``: pointer jumping over the words with a form.

Defined cases: null and empty texts have no runs; a null id counts as empty
text in the seeded damage; ties between near words go to the smallest in code
point order; repeated rows count each; an empty table or vocabulary gives no
rows; other columns are not read; a text of any length is cut between runs
before its runs are listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinrisk.llm.bytewords import mix
from clinrisk.llm.common import ascii_lower, map_arrow, stored, table
from clinrisk.llm.crc_sql import CRC, crc32

LETTERS = r"A-Za-zÀ-ÿ"
MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5
DAMAGE = 199                    # one run in so many loses a code point (of the query only)
FILTER_BYTES = 32 << 20
BITS, HASHES = 16, 6            # filter bits a word; bits that it sets in its block
PIECE = 1 << 20                 # code points of a text whose runs are listed at once
TILE, TILE_CODES = 4096, 1 << 20    # words, and their code points, whose edits are probed at once

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = _U(pow(_BASE, -1, 1 << 64))
_VALUES = np.random.default_rng(11).integers(1, 1 << 63, 256).astype(_U)
_BLOCK = [f"w{i}" for i in range(8)]


# --- Vocabulary -----------------------------------------------------------------

def runs(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, run) of every maximal run of letters with ``min_chars`` code points or more, A-Z lower-cased."""
    text = F.col(text_col)
    # A piece ends where no run goes on.
    pieces = F.when(F.char_length(text) > PIECE, F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}[{LETTERS}]*+"), F.lit(0))).otherwise(F.array(text))
    rows = docs.where(text.isNotNull()).select(F.col(id_col).alias("id"), F.explode(pieces).alias("piece"))
    found = rows.select("id", F.explode(F.regexp_extract_all("piece", F.lit(rf"[{LETTERS}]{{{min_chars},}}"), F.lit(0))).alias("run"))
    return found.select("id", ascii_lower(F.col("run")).alias("run"))


def damaged(found: DataFrame, one_in: int = DAMAGE) -> DataFrame:
    """(word) of every run; a seeded share of them without one code point."""
    h = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    rows = found.withColumn("h", h).withColumn("at", (F.col("h") % F.char_length("run")).cast("int"))
    cut = F.concat(F.substring("run", F.lit(1), F.col("at")), F.substring("run", F.col("at") + 2, F.char_length("run")))
    return rows.select(F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    counts = words.where(F.char_length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= min_count)


# --- Hashes of words and of their edits --------------------------------------------

def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, _U), np.full(max(0, n - 1), _BASE, _U)]))[:n]


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, code points) of the words, a tile at a time.  All code points are under 256."""
    lengths = np.array([len(w) for w in words], np.int64)
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        step = max(1, min(TILE, TILE_CODES // n))
        for at in range(0, len(rows), step):
            some = rows[at:at + step]
            text = "".join([words[i] for i in some.tolist()])
            yield n, some, np.frombuffer(text.encode("latin-1"), np.uint8).reshape(-1, n)


def hashes(codes: np.ndarray) -> np.ndarray:
    return (_VALUES[codes] * _powers(codes.shape[1])).sum(axis=1, dtype=_U)


def edits(codes: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """(length, place, code or -1, rows, hashes) of the deletions at a place,
    and of the replacements there by a greater code point."""
    n = codes.shape[1]
    power = _powers(n)
    terms = _VALUES[codes] * power
    put = _VALUES[alphabet][:, None] * power
    whole = terms.sum(axis=1, dtype=_U)
    before = np.zeros(len(codes), _U)
    for i in range(n):
        after = whole - before - terms[:, i]
        # Of a run of equal code points only the last is deleted: the others give the same word.
        last = np.flatnonzero(codes[:, i] != codes[:, i + 1]) if i + 1 < n else np.arange(len(codes))
        yield n - 1, i, -1, last, (before + after * _INVERSE)[last]
        rest = before + after
        for k, code in enumerate(alphabet.tolist()):
            lower = np.flatnonzero(codes[:, i] < code)
            if len(lower):
                yield n, i, code, lower, rest[lower] + put[k, i]
        before = before + terms[:, i]


def _spots(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each hash, and a word whose 9-bit groups are the bits in it."""
    x = mix(h ^ _U(0xA5A5A5A5A5A5A5A5))
    block = ((x >> _U(32)) * _U(blocks)) >> _U(32)
    return block.astype(np.int64), mix(x * _U(_BASE) + _U(1))


def _slice(h: np.ndarray, slices: int) -> np.ndarray:
    return (mix(h * _U(0xD6E8FEB86659FD93) + _U(7)) >> _U(32)) * _U(slices) >> _U(32)


# --- Filters ----------------------------------------------------------------------

class Shard:
    """The filter of the words of one length (and one slice of their hashes)."""

    def __init__(self, length: int, number: int, slices: int, blocks: int):
        self.length, self.number, self.slices, self.blocks, self.at = length, number, slices, blocks, 0


def rounds(sizes: dict[int, int], filter_bytes: int = FILTER_BYTES) -> list[list[Shard]]:
    """Shards for the vocabulary's words by length, in rounds of at most ``filter_bytes``."""
    out: list[list[Shard]] = []
    room = 0
    for length, n in sorted(sizes.items()):
        slices = max(1, -(-n * BITS // (8 * filter_bytes)))
        for number in range(slices):
            blocks = max(1, min(filter_bytes // 64, -(-n * BITS // (512 * slices))))
            if not out or blocks * 64 > room:
                out.append([])
                room = filter_bytes
            shard = Shard(length, number, slices, blocks)
            shard.at = filter_bytes - room
            room -= blocks * 64
            out[-1].append(shard)
    return out


def bloom(words: DataFrame, shards: list[Shard]) -> np.ndarray:
    """The filters of a round, one after another as rows of eight 64-bit words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(0).to_pylist()
            for n, _, codes in by_length(held):
                h = hashes(codes)
                for s in (s for s in shards if s.length == n):
                    mine = h[_slice(h, s.slices) == _U(s.number)]
                    block, bits = _spots(mine, s.blocks)
                    row = np.zeros((len(mine), 8), _U)
                    for j in range(HASHES):
                        spot = (bits >> _U(9 * j)) & _U(511)
                        row[np.arange(len(mine)), (spot >> _U(6)).astype(np.int64)] |= _U(1) << (spot & _U(63))
                    yield pa.RecordBatch.from_arrays([pa.array(s.at // 64 + block), *[pa.array(c) for c in row.view(np.int64).T.copy()]], names=["block", *_BLOCK])
    some = words.where(F.char_length("word").isin([s.length for s in shards])).select("word")
    rows = map_arrow(some, run, "block bigint, " + ", ".join(f"{w} bigint" for w in _BLOCK))
    found = rows.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in _BLOCK]).toArrow()
    out = np.zeros((sum(s.blocks for s in shards), 8), np.int64)
    for i, w in enumerate(_BLOCK):
        out[found.column("block").to_numpy(), i] = found.column(w).to_numpy()
    return out.view(_U)


def held_by(filters: np.ndarray, shard: Shard, h: np.ndarray) -> np.ndarray:
    """Which of the hashes the shard's filter holds (false ones among them)."""
    block, bits = _spots(h, shard.blocks)
    block = block + shard.at // 64
    left = np.flatnonzero(_slice(h, shard.slices) == _U(shard.number)) if shard.slices > 1 else np.arange(len(h))
    for j in range(HASHES):
        spot = (bits[left] >> _U(9 * j)) & _U(511)
        word = filters[block[left], (spot >> _U(6)).astype(np.int64)]
        left = left[((word >> (spot & _U(63))) & _U(1)).astype(bool)]
        if not len(left):
            break
    return left


# --- Near words ---------------------------------------------------------------------

def near_pairs(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(a, na, b, nb): every pair of near words once, of a stored vocabulary (word, n)."""
    spark = words.sparkSession
    by_size = words.groupBy(F.char_length("word").alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()      # a row a length
    # At most the letters of the runs, 90 of them.
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct().collect()
    alphabet = np.array(sorted(ord(r.c) for r in letters), np.uint8)
    found = []
    for shards in rounds({r.length: r.n for r in by_size}, filter_bytes):
        sent = spark.sparkContext.broadcast(bloom(words, shards))
        lengths = {s.length for s in shards}

        def probe(batches: Iterator[pa.RecordBatch], sent=sent, shards=shards) -> Iterator[pa.RecordBatch]:
            filters = sent.value
            of = {}
            for s in shards:
                of.setdefault(s.length, []).append(s)
            for batch in batches:
                held, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
                for _, rows, codes in by_length(held):
                    who, near = [], []
                    for length, place, code, some, h in edits(codes, alphabet):
                        for s in of.get(length, ()):
                            for k in rows[some[held_by(filters, s, h)]].tolist():
                                w = held[k]
                                who.append(k)
                                near.append(w[:place] + (chr(code) if code >= 0 else "") + w[place + 1:])
                    if who:
                        yield pa.RecordBatch.from_arrays([pa.array([held[k] for k in who]), pa.array(n[who]), pa.array(near)], names=["a", "na", "b"])
        mine = words.where(F.char_length("word").isin([*lengths, *(n + 1 for n in lengths)])).select("word", "n")
        edited = map_arrow(mine, probe, "a string, na bigint, b string")
        known = words.select(F.col("word").alias("b"), F.col("n").alias("nb"))
        found.append(stored(edited.join(known, "b").select("a", "na", "b", "nb"), "near-pairs"))
    if not found:
        return spark.createDataFrame([], "a string, na bigint, b string, nb bigint")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def forms(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n) of every word of the vocabulary."""
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("near_n")).union(pairs.select("b", "a", "na"))
    # The smallest of equal counts: minus the count, then the word.
    best = both.groupBy(F.col("word").alias("w")).agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    out = words.join(best, F.col("word") == F.col("w"), "left")
    enough = -F.col("best.less") >= ratio * F.col("n")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(enough, F.col("best.near")).alias("form"),
                      F.when(enough, -F.col("best.less")).alias("form_n"))


def roots(found: DataFrame) -> DataFrame:
    """(word, root) of the words with a form.  A form's count is at least ``ratio`` times the word's, so chains are short and have no cycle."""
    to = stored(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        step = to.join(to.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
        new = stored(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        to = new.select("word", "root")
        if new.where("moved").isEmpty():
            return to


def group_variants(words: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO,
                   filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the vocabulary of ``words`` (one row an occurrence)."""
    known = stored(vocabulary(words, min_chars, min_count), "vocabulary")
    found = stored(forms(known, near_pairs(known, filter_bytes), ratio), "forms")
    root = roots(found).select(F.col("word").alias("w"), "root")
    out = found.join(root, F.col("word") == F.col("w"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def with_roots(docs: DataFrame, groups: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents' runs and what they are spelled as: (id, run, root) of every run whose root is another word."""
    other = groups.where(F.col("root") != F.col("word")).select(F.col("word").alias("run"), "root")
    return runs(docs, text_col=text_col).join(other, "run").select("id", "run", "root")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(damaged(runs(table(spark, sf_dir, "documents"))))


#: Near words by shared slots (a word with one place blanked) and by cuts (with one place gone).
ORACLE = f"""
WITH RECURSIVE {CRC},
r AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(text, '[{LETTERS}]+')) AS run FROM documents),
l AS (SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM r),
g AS (SELECT id, run, count(*) AS n FROM l WHERE length(run) >= {MIN_CHARS} GROUP BY id, run),
h AS (SELECT run, n, {crc32("id || ':' || run")} AS h FROM g, crc),
w AS (SELECT CASE WHEN h % {DAMAGE} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n FROM w WHERE length(word) >= {MIN_CHARS} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
s AS (SELECT DISTINCT word, n, unnest(list_transform(range(length(word)), lambda i: substr(word, 1, i::INT) || '*' || substr(word, i::INT + 2))) AS slot FROM v),
d AS (SELECT DISTINCT word, n, unnest(list_transform(range(length(word)), lambda i: substr(word, 1, i::INT) || substr(word, i::INT + 2))) AS cut FROM v),
p AS (SELECT a.word, b.word AS near, b.n AS near_n FROM s a JOIN s b ON a.slot = b.slot AND a.word <> b.word
      UNION SELECT d.word, v.word, v.n FROM d JOIN v ON d.cut = v.word
      UNION SELECT v.word, d.word, d.n FROM d JOIN v ON d.cut = v.word),
b AS (SELECT word, count(*) AS n_near, first({{w: near, n: near_n}} ORDER BY near_n DESC, near) AS best FROM p GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= {RATIO} * v.n THEN best.w END AS form,
             CASE WHEN best.n >= {RATIO} * v.n THEN best.n END AS form_n FROM v LEFT JOIN b USING (word)),
e AS (SELECT word, form, word AS root, 0 AS steps FROM f
      UNION ALL SELECT e.word, f.form, f.word, steps + 1 FROM e JOIN f ON e.form = f.word)
SELECT word, f.form, arg_max(e.root, e.steps) AS root, f.n, f.n_near, f.form_n FROM f JOIN e USING (word)
GROUP BY word, f.form, f.n, f.n_near, f.form_n
"""
