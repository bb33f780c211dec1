"""Language identification: a bidirectional gated recurrent network over bytes.

A text is cut into overlapping chunks that cover all of it.  In every chunk one
recurrent unit reads the bytes forwards and one backwards; at every byte
position both states give a probability of each language.  A document's
probabilities are the mean over all its positions.

The network is trained in numpy by back-propagation through time with Adam on
a bounded, seeded sample (``per_lang`` documents of each language, ``per_doc``
chunks of each) outside the held-out fold.  Scoring covers every byte of every
document in the tasks of their scan partitions; only the fitted arrays (about
50 kB) are sent out.  ``lang``, ``source`` and ``doc_id`` are never inputs of a
prediction.

Defined cases: a text that is null or has no letter is ``und`` with score 0; a
null ``lang`` or id is not learned from; of rows sharing an id one text and its first language
are; without any training row every prediction is ``und``; repeated rows are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from clinrisk.llm.bytechunks import Adam, pooled, smallest_by_hash, training_chunks
from clinrisk.llm.common import id_crc, map_arrow, table

HIDDEN = 8
LENGTH, STRIDE = 128, 112
TRAIN_LENGTH = 48
PER_LANG = 400          # documents of a language in the fit
PER_DOC = 3
EPOCHS = 6
SEED = 10
FOLDS = 5

Params = dict[str, np.ndarray]


def _run(p: Params, side: str, codes: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """States of one unit over ``codes`` (time, batch): (time, batch, HIDDEN)."""
    steps, n = codes.shape
    h = np.zeros((n, HIDDEN), np.float32)
    out = np.empty((steps, n, HIDDEN), np.float32)
    table_, u = p[f"in_{side}"], p[f"rec_{side}"]
    for t in range(steps):
        x = np.take(table_, codes[t], axis=0, mode="clip")
        r = h @ u
        # sigmoid(v) = (tanh(v / 2) + 1) / 2 for both gates at once
        gates = np.tanh((x[:, :2 * HIDDEN] + r[:, :2 * HIDDEN]) * np.float32(0.5))
        gates *= np.float32(0.5)
        gates += np.float32(0.5)
        z, g = gates[:, :HIDDEN], gates[:, HIDDEN:]
        c = np.tanh(x[:, 2 * HIDDEN:] + g * r[:, 2 * HIDDEN:])
        if keep is not None:
            keep.setdefault(side, []).append((h, r[:, 2 * HIDDEN:], z, g, c))
        h = c + z * (h - c)
        out[t] = h
    return out


def _softmax(v: np.ndarray) -> np.ndarray:
    e = np.exp(v - v.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def position_probs(p: Params, chunks: np.ndarray) -> np.ndarray:
    """(time, batch, languages)."""
    codes = np.ascontiguousarray(chunks.T)
    forward, backward = _run(p, "f", codes), _run(p, "b", codes[::-1])[::-1]
    return _softmax(forward @ p["out_f"] + backward @ p["out_b"] + p["shift"])


def chunk_sums(p: Params, chunks: np.ndarray) -> np.ndarray:
    """Per chunk: the sums of the positions' probabilities, and the number of
    positions.  Padding (byte 0) holds no position."""
    probs = position_probs(p, chunks)
    real = (chunks.T != 0).astype(np.float32)
    return np.hstack([np.einsum("tbc,tb->bc", probs, real), real.sum(0)[:, None]])


def _back(p: Params, side: str, codes: np.ndarray, kept: list, d_out: np.ndarray, grads: Params) -> None:
    """Back-propagation through time of one unit."""
    d_in, d_rec = np.zeros_like(p[f"in_{side}"]), np.zeros_like(p[f"rec_{side}"])
    d_h = np.zeros_like(d_out[0])
    for t in range(len(codes) - 1, -1, -1):
        h, rc, z, g, c = kept[t]
        d_h = d_h + d_out[t]
        d_c = d_h * (1 - z) * (1 - c * c)
        d_z = d_h * (h - c) * z * (1 - z)
        d_g = d_c * rc * g * (1 - g)
        np.add.at(d_in, codes[t], np.hstack([d_z, d_g, d_c]))
        d_r = np.hstack([d_z, d_g, d_c * g])
        d_rec += h.T @ d_r
        d_h = d_h * z + d_r @ p[f"rec_{side}"].T
    grads[f"in_{side}"], grads[f"rec_{side}"] = d_in, d_rec


def gradients(p: Params, chunks: np.ndarray, y: np.ndarray) -> tuple[Params, float]:
    """Gradients of the mean cross-entropy over all real positions, and that loss."""
    codes = np.ascontiguousarray(chunks.T)
    keep: dict = {}
    forward, backward = _run(p, "f", codes, keep), _run(p, "b", codes[::-1], keep)[::-1]
    probs = _softmax(forward @ p["out_f"] + backward @ p["out_b"] + p["shift"])
    real = (codes != 0).astype(np.float32)
    n = max(1.0, float(real.sum()))
    truth = np.eye(probs.shape[-1], dtype=np.float32)[y][None]
    loss = -float((np.log((probs * truth).sum(-1) + 1e-9) * real).sum() / n)
    d = (probs - truth) * real[:, :, None] / np.float32(n)
    grads = {"out_f": np.einsum("tbh,tbc->hc", forward, d), "out_b": np.einsum("tbh,tbc->hc", backward, d),
             "shift": d.sum((0, 1))}
    _back(p, "f", codes, keep["f"], d @ p["out_f"].T, grads)
    _back(p, "b", codes[::-1], keep["b"], (d @ p["out_b"].T)[::-1], grads)
    return grads, loss


def initial(n_langs: int, seed: int = SEED) -> Params:
    rng = np.random.default_rng(seed)
    p = {"shift": np.zeros(n_langs)}
    for side in "fb":
        p |= {f"in_{side}": rng.normal(0, 0.3, (256, 3 * HIDDEN)), f"rec_{side}": rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN)),
              f"out_{side}": rng.normal(0, 0.3, (HIDDEN, n_langs))}
    return {k: v.astype(np.float32) for k, v in p.items()}


def fit(x: np.ndarray, y: np.ndarray, n_langs: int, epochs: int = EPOCHS, rate: float = 0.02) -> Params:
    rng = np.random.default_rng(SEED)
    p = initial(n_langs)
    adam = Adam(p, rate)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 128):
            adam.step(gradients(p, x[order[at:at + 128]], y[order[at:at + 128]])[0])
    return p


def train(docs: DataFrame, per_lang: int = PER_LANG, per_doc: int = PER_DOC, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> tuple[Params | None, list[str]]:
    """The fitted arrays and the languages in the order of the outputs."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & (id_crc(F.col(id_col)) % FOLDS != 0))
    # Each id once, with its first language in code point order: copies must not crowd a language's sample.
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.min(lang_col).alias("y"))
    chosen = smallest_by_hash(known, "id", "y", per_lang)
    x, y = training_chunks(docs.select(id_col, text_col), chosen, "y", TRAIN_LENGTH, per_doc, SEED, id_col, text_col)
    langs = sorted(set(y))
    if not langs:
        return None, []
    return fit(x, np.array([langs.index(v) for v in y]), len(langs)), langs


def identify(docs: DataFrame, model: Params | None, langs: list[str], id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            letters = np.array([next(filter(str.isalpha, t), None) is not None for t in texts], bool)
            best, prob = np.zeros(len(texts), np.int64), np.zeros(len(texts))
            if model is not None and letters.any():
                # Byte 0 is padding; in a text it is read as a blank.
                data = (t.replace("\0", " ").encode() if ok else b"" for t, ok in zip(texts, letters))
                total, _ = pooled(data, len(texts), len(langs) + 1, LENGTH, STRIDE, lambda x: chunk_sums(model, x))
                mean = total[:, :-1] / np.maximum(total[:, -1:], 1)
                best, prob = mean.argmax(axis=1), np.clip(mean.max(axis=1), 0.0, 1.0)
            known = letters & (model is not None)
            names = [langs[b] if ok else "und" for b, ok in zip(best, known)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(np.where(known, prob, 0.0))],
                                             names=["id", "lang_pred", "score"])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_arrow(rows, run, StructType([rows.schema["id"], StructField("lang_pred", StringType()),
                                            StructField("score", DoubleType())]))


def op10_language_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = identify(docs, *train(docs))
    return out.select(F.col("id").alias("doc_id"), (id_crc(F.col("id")) % FOLDS == 0).alias("held_out"), "lang_pred", "score")
