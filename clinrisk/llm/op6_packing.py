"""Harmonic packing of tokenised documents into fixed-length sequences.

A document's ids are those of a byte-level BPE vocabulary plus one end id 0.
With capacity C, a piece of length n belongs to the reciprocal class
k = C // n (lengths in (C/(k+1), C/k]), and a bin of class k takes exactly k
pieces.  A document is cut into whole sequences (class 1) and a remainder.  A
remainder that would fill its class's bins badly first gives up a piece of
the next class's full length C // (k+1); what is left is classed anew.

Every worker (scan partition) fills the bins of its own documents: nothing is
shuffled, a worker holds fewer than k open pieces of each class, and a task
that runs again gives the same rows.  Bins still open at the end are laid out
back to back, cut at the capacity, and the last stretch is cut at powers of
two, which need no padding.

Ids are those of ``tokenizers`` (``bpe``: each distinct run of a worker's texts
is encoded once), for texts of any length and any run of blanks.

Defined cases: a null or empty text has the single id 0; a null ``doc_id`` is
carried; repeated rows are packed each on its own; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from clinrisk.llm.bpe import encoder
from clinrisk.llm.common import map_arrow, table

CAPACITY = 1024
END_ID = 0
MIN_FILL = 0.98       # a remainder whose class fills its bins worse is cut once more
SMALL = 48            # shorter remainders stay whole
OUT = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
       "sequence_id bigint, offset bigint")

def cut(n: int, capacity: int = CAPACITY, min_fill: float = MIN_FILL, small: int = SMALL) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids."""
    pieces = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        if rest < small or k * rest >= min_fill * capacity:
            pieces.append(rest)
            break
        pieces.append(capacity // (k + 1))
        rest -= capacity // (k + 1)
    return pieces


class Bins:
    """One worker's open bins.  A piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, worker: int, capacity: int = CAPACITY):
        self.capacity, self.next_id = capacity, worker << 32
        self.open: dict[int, list] = {}
        self.rows: list[tuple] = []

    def _close(self, pieces: list) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), doc_tokens, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        start = 0
        for n in cut(len(ids), self.capacity):
            k = self.capacity // n
            held = self.open.setdefault(k, [])
            held.append((doc_id, start, ids[start:start + n], len(ids)))
            if len(held) == k:
                self._close(self.open.pop(k))
            start += n

    def finish(self) -> None:
        rest = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        left = sum(len(p[2]) for p in rest)
        while left:
            room = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
            left -= room
            taken = []
            while room:
                doc_id, start, ids, doc_tokens = rest.pop(0)
                taken.append((doc_id, start, ids[:room], doc_tokens))
                if len(ids) > room:
                    rest.insert(0, (doc_id, start + room, ids[room:], doc_tokens))
                room -= len(taken[-1][2])
            self._close(taken)

    def flush(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * 7
        self.rows = []
        names = [c.split()[0] for c in OUT.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = "byte_bpe_50k",
         id_col: str = "doc_id", text_col: str = "text", cached: int | None = None) -> DataFrame:
    """One row per piece: which ids of which document lie where in which sequence.
    ``cached``: runs that a worker remembers (it changes time and memory only)."""
    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary, cached)
        end = np.array([END_ID], f"<u{bpe.width}").tobytes()
        bins = Bins(TaskContext.get().partitionId(), capacity)
        for batch in batches:
            texts = (t.as_py() or "" for t in batch.column(1))
            for doc_id, ids in zip(batch.column(0).to_pylist(), bpe.encode(texts)):
                bins.add(doc_id, np.frombuffer(ids + end, f"<u{bpe.width}").astype("<u4"))
                if len(bins.rows) >= 20_000:
                    yield bins.flush()
        bins.finish()
        yield bins.flush()
    return map_arrow(docs.select(id_col, text_col), worker, OUT, keep=True)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
