"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks that cover all of it.  Each chunk's
bytes are embedded, ``FILTERS`` learned filters slide over every window of
``WIDTH`` bytes, and each filter's largest response in the chunk is kept
(max-pooling).  A linear layer turns the pooled responses into a chunk logit; the
document's probability is the sigmoid of the mean logit.

The filters are fitted by back-propagation with Adam on a bounded, seeded
sample of labelled documents (``per_class`` documents of each class, ``per_doc``
chunks of each) outside the held-out fold.  Scoring covers every byte of every
document, in tasks of their scan partitions; only the fitted arrays (about
6 kB) are sent out.  ``labels``, ``lang``, ``source`` and ``doc_id`` are never
inputs of a score.

Defined cases: a null or empty text is one chunk of padding and gets that
score; without labelled rows, or with one class only, every score is the share
of label 1 (0.5 without any); labels without a document and null labels are
skipped; of labels of one id the largest counts, of texts of one id one is learned from; repeated rows are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from clinrisk.llm.bytechunks import Adam, pooled, smallest_by_hash, text_bytes, training_chunks
from clinrisk.llm.common import id_crc, map_arrow, table

EMBED, WIDTH, FILTERS = 4, 5, 16
LENGTH = 515            # bytes of a chunk, a multiple of WIDTH
STRIDE = 455            # chunks overlap by 60 bytes
PER_CLASS = 1500        # labelled documents of a class in the fit
PER_DOC = 2
EPOCHS = 8
SEED = 4
THRESHOLD = 0.3
FOLDS = 5

Params = dict[str, np.ndarray]


def _responses(p: Params, x: np.ndarray) -> Iterator[np.ndarray]:
    """Filter responses of the windows starting at phase, phase + WIDTH, ...:
    (chunks, windows, FILTERS).  Each phase's windows lie side by side in memory."""
    e = np.take(p["embed"], x, axis=0, mode="clip").reshape(len(x), -1)
    for phase in range(WIDTH):
        m = (x.shape[1] - phase) // WIDTH
        part = e[:, EMBED * phase:EMBED * (phase + m * WIDTH)].reshape(len(x), m, WIDTH * EMBED)
        yield part @ p["filters"]


def chunk_logits(p: Params, x: np.ndarray) -> np.ndarray:
    best = None
    for r in _responses(p, x):
        top = r.max(axis=1)
        best = top if best is None else np.maximum(best, top)
    return np.maximum(best + p["bias"], 0) @ p["out"] + p["shift"]


def fit(x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED, rate: float = 0.01) -> Params:
    """Fit on chunks ``x`` with targets ``y`` (0/1); both classes weigh the same."""
    rng = np.random.default_rng(seed)
    p = {"embed": rng.normal(0, 0.5, (256, EMBED)), "filters": rng.normal(0, 0.3, (WIDTH * EMBED, FILTERS)),
         "bias": np.zeros(FILTERS), "out": rng.normal(0, 0.3, (FILTERS, 1)), "shift": np.zeros(1)}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    adam = Adam(p, rate)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 64):
            rows = order[at:at + 64]
            adam.step(_gradients(p, x[rows], y[rows], weight[rows]))
    return p


def _gradients(p: Params, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Params:
    n = len(x)
    best, where = np.full((n, FILTERS), -np.inf, np.float32), np.zeros((n, FILTERS), np.int64)
    for phase, r in enumerate(_responses(p, x)):
        at, top = r.argmax(axis=1), r.max(axis=1)
        better = top > best
        best, where = np.where(better, top, best), np.where(better, at * WIDTH + phase, where)
    hidden = np.maximum(best + p["bias"], 0)
    prob = 1 / (1 + np.exp(-(hidden @ p["out"] + p["shift"])[:, 0]))
    d_logit = ((prob - y) * weight / n).astype(np.float32)[:, None]
    d_best = (d_logit @ p["out"].T) * (hidden > 0)
    # Only the window that won a filter in a chunk carries its gradient.
    codes = x[np.arange(n)[:, None, None], where[:, :, None] + np.arange(WIDTH)]
    window = p["embed"][codes].reshape(n, FILTERS, -1)
    d_window = d_best[:, :, None] * p["filters"].T[None]
    d_embed = np.zeros_like(p["embed"])
    np.add.at(d_embed, codes.reshape(-1), d_window.reshape(-1, EMBED))
    return {"embed": d_embed, "filters": np.einsum("nfw,nf->wf", window, d_best), "bias": d_best.sum(0),
            "out": hidden.T @ d_logit, "shift": d_logit.sum(0)}


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", per_class: int = PER_CLASS,
          per_doc: int = PER_DOC, id_col: str = "doc_id", text_col: str = "text") -> Params | float:
    """The fitted arrays, or a constant score if there are not two classes."""
    known = (labels.where(F.col(target).isin(0, 1) & F.col(id_col).isNotNull() & (id_crc(F.col(id_col)) % FOLDS != 0))
             .groupBy(F.col(id_col).alias("id")).agg(F.max(target).cast("int").alias("y")))
    chosen = smallest_by_hash(known, "id", "y", per_class)
    x, y = training_chunks(docs, chosen, "y", LENGTH, per_doc, SEED, id_col, text_col)
    y = np.array(y, np.int64)
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    return fit(x, y)


def score(docs: DataFrame, model: Params | float, id_col: str = "doc_id", text_col: str = "text",
          carry: bool = False) -> DataFrame:
    """(id, score) of every row; with ``carry`` the row itself as a struct too."""
    rows = docs.select(F.col(id_col).alias("id"), F.struct("*").alias("row") if carry else F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            texts = batch.column(1).field(text_col) if carry else batch.column(1)
            if isinstance(model, float):
                prob = np.full(n, model)
            else:
                total, count = pooled(text_bytes(texts), n, 1, LENGTH, STRIDE, lambda x: chunk_logits(model, x))
                prob = 1 / (1 + np.exp(-total[:, 0] / count))
            columns = [batch.column(0), pa.array(prob), *([batch.column(1)] if carry else [])]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "score", "row"][:len(columns)])
    fields = [rows.schema["id"], StructField("score", DoubleType()), *([rows.schema["row"]] if carry else [])]
    return map_arrow(rows, run, StructType(fields))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier accepts, in the input's columns."""
    out = score(docs, train(docs, labels), carry=True)
    return out.where(F.col("score") >= threshold).select(*[F.col("row")[c].alias(c) for c in docs.columns])


def op4_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select(F.col("id").alias("doc_id"), (id_crc(F.col("id")) % FOLDS == 0).alias("held_out"), "score",
                      F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
