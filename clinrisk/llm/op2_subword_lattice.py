"""Language-model scoring by a subword lattice likelihood.

The pieces of an existing vocabulary (and one piece for each byte) span a
lattice over every word: each path from its start to its end is a
segmentation, weighted by the product of its pieces' probabilities.  A word's
probability is the sum over all segmentations, by a forward recursion in log
space; a document's is the product over its words and one end piece.

The vocabulary's own scores (merge ranks) give the first weights,
``1 / (1 + rank)``; ``ROUNDS`` rounds of expectation maximisation on the training documents
renew them: forward and backward recursions over every distinct training word
give the expected count of each piece, weighted by the word's count.  Only these sums, one
per piece of the fixed vocabulary, reach the driver.

Words are counted once over the corpus (partial counts per task, then one
shuffle by word), and each distinct word is scored once.  Documents get their
words' values in two ways: the ``HOT_WORDS`` most frequent words, which are
most of all tokens, come from a table of bounded size that every task holds;
all others go through a join on the word, so the vocabulary may be of any size
and no word is a hot key.

Defined cases: a null or empty text is the end token alone; held out are the
ids whose crc32 mod 7 is 2 (a null id counts as empty text); without any
training document N = V = 0, nothing is known, and the vocabulary's own
weights score; repeated rows are scored alike and count as often as they
stand; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinrisk.llm.common import id_crc, map_arrow, stored, table

VOCABULARY = "piece_bpe_32k.model"
FOLDS, HELD_OUT = 7, 2
ROUNDS = 2
PRIOR_MASS = 1000.0             # pseudo-count of the first weights in each round
HOT_WORDS = 1 << 16
FLUSH = 400_000                 # distinct words that a task counts at once
BLOCK_WORDS = 50_000            # words whose lattices are run together
LONG = 40                       # longer words run alone

_LOG10 = math.log(10.0)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(22).integers(1, 2**63, 256).astype(np.uint64)


@lru_cache(maxsize=2)
def pieces(vocabulary: str = VOCABULARY) -> tuple[tuple[bytes, ...], np.ndarray]:
    """Pieces as bytes, a word start being a leading blank, and their first
    weights.  The first 256 are the single bytes; the end piece comes last."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
    names, weights = [bytes([b]) for b in range(256)], [0.0] * 256
    for i in range(model.get_piece_size()):
        if model.is_byte(i) or model.is_control(i) or model.is_unknown(i):
            continue
        piece = model.id_to_piece(i).replace("▁", " ").encode()
        if b" " not in piece[1:]:
            names.append(piece)
            weights.append(1.0 / (1.0 - min(0.0, model.get_score(i))))
    weights[:256] = [min(weights[256:], default=1.0)] * 256
    w = np.array([*weights, weights[0]])
    return tuple(names), w / w.sum()


class Lattice:
    """Forward and backward recursions over the lattices of words."""

    def __init__(self, log_p: np.ndarray, vocabulary: str = VOCABULARY):
        self.names, _ = pieces(vocabulary)
        self.log_p = log_p
        self.of = {}
        by_length: dict[int, list[int]] = {}
        for i, name in enumerate(self.names[256:], 256):
            self.of[name] = i
            by_length.setdefault(len(name), []).append(i)
        self.longest = max(by_length, default=1)
        self.keys = {}
        for n, held in by_length.items():
            x = np.frombuffer(b"".join(self.names[i] for i in held), np.uint8).reshape(-1, n)
            h = self._prefix(x)[:, -1]
            order = np.argsort(h)
            self.keys[n] = (h[order], np.array(held)[order])

    @staticmethod
    def _prefix(x: np.ndarray) -> np.ndarray:
        """Polynomial hashes of the prefixes of each row."""
        h = np.zeros((len(x), x.shape[1] + 1), np.uint64)
        for j in range(x.shape[1]):
            h[:, j + 1] = h[:, j] * _BASE + _BYTE[x[:, j]]
        return h

    def _edges(self, x: np.ndarray) -> list[tuple[int, int, np.ndarray | None, np.ndarray]]:
        """(start, end, rows or None for all, piece numbers) by end."""
        h, out = self._prefix(x), []
        powers = {n: np.uint64(pow(int(_BASE), n, 2**64)) for n in self.keys}
        for end in range(1, x.shape[1] + 1):
            out.append((end - 1, end, None, x[:, end - 1].astype(np.int64)))
            for n, (keys, numbers) in self.keys.items():
                if n <= end:
                    sub = h[:, end] - h[:, end - n] * powers[n]
                    at = np.minimum(np.searchsorted(keys, sub), len(keys) - 1)
                    rows = np.flatnonzero(keys[at] == sub)
                    if len(rows):
                        out.append((end - n, end, rows, numbers[at[rows]]))
        return out

    def _forward(self, n: int, length: int, edges: list) -> np.ndarray:
        a = np.full((length + 1, n), -np.inf)
        a[0] = 0.0
        for start, end, rows, p in edges:
            if rows is None:
                a[end] = np.logaddexp(a[end], a[start] + self.log_p[p])
            else:
                a[end, rows] = np.logaddexp(a[end, rows], a[start, rows] + self.log_p[p])
        return a

    def same_length(self, x: np.ndarray, weight: np.ndarray | None = None, counts: np.ndarray | None = None) -> np.ndarray:
        """Log probabilities of the rows of ``x``; with ``weight`` the expected
        piece counts are added to ``counts``."""
        edges = self._edges(x)
        n, length = x.shape
        a = self._forward(n, length, edges)
        if counts is not None:
            b = np.full((length + 1, n), -np.inf)
            b[length] = 0.0
            for start, end, rows, p in reversed(edges):
                at = slice(None) if rows is None else rows
                through = b[end, at] + self.log_p[p]
                share = np.exp(a[start, at] + through - a[length, at]) * weight[at]
                counts += np.bincount(p, share, minlength=len(counts))
                b[start, at] = np.logaddexp(b[start, at], through)
        return a[length]

    def alone(self, word: bytes, weight: float = 0.0, counts: np.ndarray | None = None) -> float:
        """The same for one long word, whose lattice is walked once."""
        a, edges = np.full(len(word) + 1, -np.inf), []
        a[0] = 0.0
        for end in range(1, len(word) + 1):
            held = [(end - 1, word[end - 1])]
            held += [(s, i) for s in range(max(0, end - self.longest), end) if (i := self.of.get(word[s:end])) is not None]
            a[end] = np.logaddexp.reduce([a[s] + self.log_p[i] for s, i in held])
            edges.append(held)
        if counts is not None:
            b = np.full(len(word) + 1, -np.inf)
            b[-1] = 0.0
            for end in range(len(word), 0, -1):
                for s, i in edges[end - 1]:
                    through = b[end] + self.log_p[i]
                    counts[i] += weight * math.exp(a[s] + through - a[-1])
                    b[s] = np.logaddexp(b[s], through)
        return float(a[-1])

    def words(self, words: list[bytes], weight: np.ndarray | None = None, counts: np.ndarray | None = None) -> np.ndarray:
        """Log probability of each word (a blank is put before it)."""
        out = np.zeros(len(words))
        lengths = np.array([len(w) + 1 for w in words])
        for n in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == n)
            if n > LONG:
                for r in rows.tolist():
                    out[r] = self.alone(b" " + words[r], 0.0 if weight is None else float(weight[r]), counts)
                continue
            x = np.frombuffer(b"".join(b" " + words[r] for r in rows.tolist()), np.uint8).reshape(-1, n)
            out[rows] = self.same_length(x, None if weight is None else weight[rows], counts)
        return out


def _tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()       # bytes: ASCII white space, A-Z only


def word_counts(docs: DataFrame, learn: Column, text_col: str = "text") -> DataFrame:
    """(word, c): every distinct word and its count in the training rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train, other = Counter(), Counter()

        def emit() -> pa.RecordBatch:
            words = [*train, *(w for w in other if w not in train)]
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([train.get(w, 0) for w in words], pa.int64())],
                                             names=["word", "c"])
            train.clear()
            other.clear()
            return out
        for batch in batches:
            for text, mine in zip(batch.column(0), batch.column(1).to_pylist()):
                (train if mine else other).update(_tokens(text.as_py()))
                if len(train) + len(other) >= FLUSH:
                    yield emit()
        yield emit()
    rows = docs.select(F.col(text_col).alias("text"), learn.alias("learn"))
    return map_arrow(rows, run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= BLOCK_WORDS:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def fit(counted: DataFrame, ends: int, rounds: int = ROUNDS, vocabulary: str = VOCABULARY) -> np.ndarray:
    """Log probabilities of the pieces and of the end piece (last)."""
    _, first = pieces(vocabulary)
    p = first
    for _ in range(rounds if ends else 0):
        log_p = np.log(p)

        def expect(batches: Iterator[pa.RecordBatch], log_p: np.ndarray = log_p) -> Iterator[pa.RecordBatch]:
            lattice, counts = Lattice(log_p, vocabulary), np.zeros(len(log_p))
            for t in _blocks(batches):
                lattice.words(t.column("word").to_pylist(), t.column("c").to_numpy().astype(float), counts)
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["piece", "n"])
        got = map_arrow(counted.where("c > 0").select("word", "c"), expect, "piece bigint, n double")
        counts = np.zeros(len(p))
        for r in got.groupBy("piece").agg(F.sum("n").alias("n")).collect():     # at most one row per piece of the vocabulary
            counts[r.piece] = r.n
        counts[-1] = ends
        p = (counts + PRIOR_MASS * first) / (counts.sum() + PRIOR_MASS)
    return np.log(p)


def scored_words(counted: DataFrame, log_p: np.ndarray, vocabulary: str = VOCABULARY) -> DataFrame:
    """(word, c, lp): with the log10 lattice probability of every distinct word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(log_p, vocabulary)
        for t in _blocks(batches):
            lp = lattice.words(t.column("word").to_pylist()) / _LOG10
            yield from t.append_column("lp", pa.array(lp)).to_batches()
    return map_arrow(counted.select("word", "c"), run, "word binary, c bigint, lp double")


def document_sums(docs: DataFrame, hot: dict[bytes, tuple[int, float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its number of words, the sums over hot words, and its other words with their counts."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = (f"uid bigint, id {rows.schema['id'].dataType.simpleString()}, n_words bigint, known bigint, base double, lp double, "
              "words array<binary>, counts array<bigint>")
    shared = docs.sparkSession.sparkContext.broadcast({w: (math.log10(c + 1), lp) for w, (c, lp) in hot.items()})  # HOT_WORDS at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid, known_words = TaskContext.get().partitionId() << 33, shared.value
        for batch in batches:
            out: list[tuple] = []
            for text in batch.column(1):
                held = Counter(_tokens(text.as_py()))
                known, base, lp, words, counts = 0, 0.0, 0.0, [], []
                for w, n in held.items():
                    got = known_words.get(w)
                    if got is None:
                        words.append(w)
                        counts.append(n)
                    else:
                        known += n
                        base += n * got[0]
                        lp += n * got[1]
                out.append((uid, held.total(), known, base, lp, words, counts))
                uid += 1
            cols = list(zip(*out)) or [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64()))
            arrays = [pa.array(c, t) for c, t in zip(cols, kinds)]
            yield pa.RecordBatch.from_arrays([arrays[0], batch.column(0), *arrays[1:]], names=[c.split()[0] for c in schema.split(", ")])
    return map_arrow(rows, run, schema)


def hot_words(words: DataFrame, most: int | None = None) -> dict[bytes, tuple[int, float]]:
    """(c, lp) of the most frequent words, ``most`` (HOT_WORDS) at most: a histogram of counts gives the count
    from which on they are so few, and only those words reach the driver."""
    most = HOT_WORDS if most is None else most
    some = words.where("c > 0 AND length(word) <= 64").withColumn("step", F.floor(F.log2("c") * 16))
    least, total = None, 0
    for r in sorted(some.groupBy("step").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r.step):     # some 1,000 steps at most
        total += r.n
        if total > most:
            break
        least = r.step
    return {} if least is None else {bytes(r.word): (r.c, r.lp) for r in some.where(F.col("step") >= least).select("word", "c", "lp").collect()}


def lattice_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    held_out = id_crc(F.col(id_col)) % FOLDS == HELD_OUT
    counted = stored(word_counts(docs, ~held_out, text_col), "word-counts")
    ends = docs.where(~held_out).count()
    log_p = fit(counted, ends, vocabulary=vocabulary)
    words = stored(scored_words(counted, log_p, vocabulary), "word-scores")
    total = words.agg(F.sum("c").alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    n, v = (total.n or 0) + ends, total.v + (ends > 0)
    hot = hot_words(words)
    sums = stored(document_sums(docs, hot, id_col, text_col), "document-sums")
    cold = sums.select("uid", F.explode(F.arrays_zip("words", "counts")).alias("x")).select("uid", F.col("x.words").alias("word"), F.col("x.counts").alias("k"))
    cold = cold.join(words, "word").groupBy("uid").agg(
        F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("known2"),
        F.sum(F.col("k") * F.log10(F.col("c") + 1)).alias("base2"), F.sum(F.col("k") * F.col("lp")).alias("lp2"))
    out = sums.drop("words", "counts").join(cold, "uid", "left").na.fill(0, ["known2", "base2", "lp2"])
    tokens = F.col("n_words") + 1
    base = F.col("base") + F.col("base2") + math.log10(ends + 1) - tokens * math.log10(n + v + 1) if n + v else F.lit(0.0)
    return out.select("id", (id_crc(F.col("id")) % FOLDS == HELD_OUT).alias("held_out"), tokens.alias("n_tokens"),
                      (F.col("known") + F.col("known2") + int(ends > 0)).alias("n_known"), F.lit(n).cast("bigint").alias("train_tokens"),
                      base.alias("base_score"), (F.col("lp") + F.col("lp2") + float(log_p[-1] / _LOG10)).alias("score"))


def op2_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_scores(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
