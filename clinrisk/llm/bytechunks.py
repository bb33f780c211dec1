"""Whole texts as overlapping byte chunks, for the byte-level networks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import as_strided
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinrisk.llm.common import map_arrow

BLOCK = 2048            # chunks that a network sees at once
BROADCAST_VALUES = 10_000   # rows of a table of class sizes


def chunk_view(data: bytes, length: int, stride: int) -> np.ndarray:
    """All chunks of ``data`` as rows of a view, the last one padded with 0.
    An empty text is one chunk of padding."""
    n = max(1, -(-max(0, len(data) - length) // stride) + 1)
    padded = np.zeros((n - 1) * stride + length, np.uint8)
    padded[:len(data)] = np.frombuffer(data, np.uint8)
    return as_strided(padded, (n, length), (stride, 1))


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    for text in column:
        yield (text.as_py() or "").encode()


def pooled(texts: Iterator[bytes], n: int, width: int, length: int, stride: int,
           network: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sums over each text's chunks of ``network`` (chunks -> rows of ``width``
    numbers) and the number of chunks.  At most BLOCK chunks are held."""
    total, count = np.zeros((n, width)), np.zeros(n, np.int64)
    held: list[np.ndarray] = []
    owner: list[np.ndarray] = []
    size = 0

    def run() -> None:
        nonlocal held, owner, size
        if held:
            np.add.at(total, np.concatenate(owner), network(np.concatenate(held)))
        held, owner, size = [], [], 0
    for i, data in enumerate(texts):
        view = chunk_view(data, length, stride)
        count[i] = len(view)
        for at in range(0, len(view), BLOCK):
            part = view[at:at + BLOCK]
            if size + len(part) > BLOCK:
                run()
            held.append(part)
            owner.append(np.full(len(part), i))
            size += len(part)
    run()
    return total, count


def training_chunks(docs: DataFrame, chosen: DataFrame, target: str, length: int, per_doc: int, seed: int,
                    id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, list]:
    """Seeded chunks of the ``chosen`` ids' texts and their targets.

    ``chosen`` (id, target) is a bounded sample, each id once, so it is
    broadcast.  Of rows that share an id the text of the smallest hash stands
    for it, so at most ``per_doc`` chunks an id, from anywhere in the text, reach the driver."""
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list] = ([], [])
            for key, label, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2))):
                rng = np.random.default_rng([seed, abs(hash(key))])
                for _ in range(min(per_doc, 1 + len(data) // length)):
                    at = int(rng.integers(0, max(1, len(data) - length + 1)))
                    out[0].append(data[at:at + length])
                    out[1].append(label)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], batch.schema.field(1).type)],
                                             names=["chunk", "target"])
    one = F.min(F.struct(F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text")))
    picked = (docs.select(F.col(id_col).alias("id"), text_col).join(F.broadcast(chosen), "id").groupBy("id", target).agg(one.alias("one"))
              .select("id", target, "one.text"))
    kind = dict(chosen.dtypes)[target]
    rows = sorted((bytes(r[0]), r[1]) for r in map_arrow(picked, sample, f"chunk binary, target {kind}").collect())
    x = np.zeros((len(rows), length), np.uint8)
    for i, (data, _) in enumerate(rows):
        x[i, :len(data)] = np.frombuffer(data, np.uint8)
    return x, [r[1] for r in rows]


def smallest_by_hash(rows: DataFrame, id_col: str, by: str, most: int) -> DataFrame:
    """At most ``most`` rows of each value of ``by``, those with the smallest
    id hash.  An id stands once in ``rows``.  Rows far beyond that are dropped before the shuffle: their hash
    is past the part of the range that holds four times as many."""
    u = F.pmod(F.xxhash64(id_col), F.lit(1 << 32)) / F.lit(float(1 << 32))
    sizes = rows.groupBy(F.col(by).alias("value")).agg(F.count(F.lit(1)).alias("size"))
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_VALUES else sizes
    near = rows.withColumn("u", u).join(sizes, F.col(by) == F.col("value")).where(F.col("u") * F.col("size") < 4 * most)
    rank = F.row_number().over(Window.partitionBy(by).orderBy("u", id_col))
    return near.withColumn("rank", rank).where(F.col("rank") <= most).drop("rank", "u", "value", "size")


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            m, v = self.m[k] / (1 - 0.9 ** self.t), self.v[k] / (1 - 0.999 ** self.t)
            self.params[k] -= (self.rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
