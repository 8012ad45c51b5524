"""Quality classifier (operator 5): naive Bayes support vectors.

A document is the set of its n-grams (an indicator each): lower-cased words, and 1- to
3-grams of word *shapes* (runs of letter case, digits and each punctuation mark, with a
mark on a word that repeats the one before). N-grams are hashed into ``FEATURES`` columns.
Every column is scaled by its log-count ratio between the classes; a linear hinge-loss
model is fitted on the scaled, length-normalised rows by dual coordinate descent and its
margin is turned into a probability on training rows the model was not fitted on.

The fit uses at most ``FIT_ROWS`` labelled rows of at most ``FIT_CHARS`` characters, chosen
by a hash of id and text (equal rows of one id count once). A text has at most two
indicators a character, so at most ``8 * FIT_ROWS * FIT_CHARS`` bytes reach the driver
(512 MB; 32 MB at 3,300 characters a text). Scoring is one pass over all whole texts with
a broadcast of ``16 * FEATURES`` bytes.

Defined results: a null or empty text has no indicator and gets the model's bias; a label
row with a null id or label, and a second label of one id, is not used; without any label
of one class every score is the share of label 1 (0.5 without labels). Repeated documents
repeat their score. Long texts are scored whole; an empty table gives an empty result;
further columns are kept, but one named score is replaced. Labels, language, source and id
never enter a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm import textkit as K

FEATURES = 1 << 18
FIT_ROWS = 8_000
FIT_CHARS = 8_000              # characters of a text that may be fitted; all are scored, whole
THRESHOLD = 0.3

SHAPE = np.arange(256, dtype=np.uint8)          # punctuation stands for itself
SHAPE[97:123] = SHAPE[128:] = ord("a")
SHAPE[65:91] = ord("A")
SHAPE[48:58] = ord("0")
_U = np.uint64


def features(col) -> list[np.ndarray]:
    """Per text the sorted distinct columns of its n-grams."""
    raw, offs = K.text_buffers(col)
    s, e, first = K.word_spans(raw, offs)
    words = K.span_hash(K.prefix_hash(K.LOWER[raw]), s, e)
    shape = SHAPE[raw]
    if len(raw):
        kept = np.ones(len(raw), bool)
        kept[1:] = shape[1:] != shape[:-1]
        kept[s] = True                           # a run ends with its word
        at = np.r_[0, np.cumsum(kept)]
        shapes = K.span_hash(K.prefix_hash(shape[kept]), at[s], at[e])
    else:
        shapes = words
    again = np.zeros(len(words), bool)
    again[1:] = words[1:] == words[:-1]
    again[first[:-1][first[:-1] < len(words)]] = False
    shapes = K.mix(shapes + again.astype(np.uint64) * K.MULT[40])
    cols = [K.mix(words ^ K.MULT[41])] + [K.gram_hashes(shapes, n) for n in (1, 2, 3)]
    cols = [(c % _U(FEATURES)).astype(np.int32) for c in cols]
    out = []
    for a, z in zip(first[:-1].tolist(), first[1:].tolist()):
        out.append(np.unique(np.concatenate([cols[0][a:z]] + [cols[n][a:max(a, z - n + 1)] for n in (1, 2, 3)])))
    return out


def feature_batches(batches):
    """Worker: (label, columns) of labelled rows."""
    for b in batches:
        texts = b.column("text")
        for lo, hi in K.slices(texts):
            rows = features(texts.slice(lo, hi - lo))
            offs = np.r_[0, np.cumsum([len(r) for r in rows])].astype(np.int32)
            flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
            yield pa.record_batch([b.column("doc_id").slice(lo, hi - lo), b.column("label").slice(lo, hi - lo),
                                   pa.ListArray.from_arrays(pa.array(offs), pa.array(flat))],
                                  names=["doc_id", "label", "columns"])


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """log((p/|p|) / (q/|q|)) of the smoothed indicator counts p, q of the two classes."""
    p, q = np.ones(FEATURES), np.ones(FEATURES)
    for r, label in zip(rows, y):
        (p if label > 0 else q)[r] += 1
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_descent(rows, values, y, c=1.0, epochs=30, seed=7, tol=1e-3):
    """L2-regularised hinge loss by dual coordinate descent (box 0..c on each dual
    variable, w kept beside them); the last column is the bias."""
    w, alpha = np.zeros(FEATURES + 1), np.zeros(len(rows))
    square = np.array([v @ v for v in values]) + 1.0
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            g = y[i] * (w[rows[i]] @ values[i] + w[-1]) - 1
            new = min(max(alpha[i] - g / square[i], 0.0), c)
            step = new - alpha[i]
            if step:
                w[rows[i]] += step * y[i] * values[i]
                w[-1] += step * y[i]
                alpha[i] = new
                worst = max(worst, abs(step))
        if worst < tol * c:
            break
    return w


def scaled(row: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    v = ratio[row]
    n = np.sqrt(v @ v)
    return v / n if n else v


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve over margins (Newton steps with smoothed
    targets, a small ridge keeps separable data finite)."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.c_[margin, np.ones(len(margin))]
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        g = x.T @ (p - t) + 1e-3 * beta
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        beta -= step
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(beta[1])


def fit(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float, float]:
    """(ratio, scaled weights, bias, slope, offset). One row in five is left out of the
    model and used to calibrate it."""
    y = np.where(labels > 0, 1.0, -1.0)
    if len(y) == 0 or (y > 0).all() or (y < 0).all():
        share = (y > 0).mean() if len(y) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return np.zeros(FEATURES), np.zeros(FEATURES), 0.0, 0.0, float(np.log(share / (1 - share)))
    hold = np.arange(len(y)) % 5 == 4
    if len(set(y[hold])) < 2 or len(set(y[~hold])) < 2:
        hold[:] = False
    use = np.flatnonzero(~hold)
    ratio = log_count_ratio([rows[i] for i in use], y[use])
    values = [scaled(r, ratio) for r in rows]
    w = dual_descent([rows[i] for i in use], [values[i] for i in use], y[use])
    margin = np.array([w[r] @ v + w[-1] for r, v in zip(rows, values)])
    at = hold if hold.any() else ~hold
    slope, offset = calibrate(margin[at], y[at])
    return ratio, w[:-1] * ratio, float(w[-1]), slope, offset


def score_texts(col, model) -> np.ndarray:
    ratio, weight, bias, slope, offset = model
    square = ratio * ratio
    margin = np.empty(len(col))
    for i, r in enumerate(features(col)):
        n = np.sqrt(square[r].sum())
        margin[i] = (weight[r].sum() / n if n else 0.0) + bias
    return 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))


def score_batches(batches, model):
    """Worker: every column of the rows, with ``score`` at the end."""
    m = model.value
    for b in batches:
        texts = b.column("text")
        parts = [score_texts(texts.slice(lo, hi - lo), m) for lo, hi in K.slices(texts)]
        keep = [n for n in b.schema.names if n != "score"]
        yield pa.record_batch([b.column(n) for n in keep] + [pa.array(np.concatenate(parts) if parts else np.zeros(0))],
                              names=keep + ["score"])


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS):
    """Fit on labelled rows whose crc32(doc_id) mod 5 is not 0, at most ``fit_rows`` of
    them: those with the smallest hash of id and text."""
    usable = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (K.crc_mod(F.col("doc_id"), 5) != 0))
              .groupBy("doc_id").agg(F.min("quality").alias("label")))
    text = F.col("text").cast("string")
    rows = (docs.select("doc_id", text.alias("text"), F.xxhash64(F.col("doc_id").cast("string"), text).alias("h"))
            .where(F.length(F.coalesce("text", F.lit(""))) <= FIT_CHARS))
    # the keys with their labels first, without texts; then the texts of the chosen ones, each once
    chosen = rows.select("doc_id", "h").join(usable, "doc_id").distinct().orderBy("h", "doc_id").limit(fit_rows)
    rows = rows.join(F.broadcast(chosen), ["doc_id", "h"]).groupBy("doc_id", "h").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    t = K.arrow_map(rows.select("doc_id", "text", F.col("label").cast("int").alias("label")),
                    "starmart.llm.nbsvm:feature_batches", "doc_id long, label int, columns array<int>").toArrow()
    order = sorted(range(len(t)), key=lambda i: (t.column("doc_id")[i].as_py(), len(t.column("columns")[i]), t.column("columns")[i].as_py()[:8]))
    t = t.take(order) if len(t) else t
    cols = [np.asarray(r.values, np.int32) for r in t.column("columns")] if len(t) else []
    order = np.random.default_rng(3).permutation(len(cols))
    y = t.column("label").to_numpy() if len(t) else np.zeros(0, int)
    return fit([cols[i] for i in order], y[order])


def score(docs: DataFrame, model) -> DataFrame:
    """The documents, all columns, with ``score`` in 0..1 (a column of that name that was
    there is replaced). One pass, no exchange."""
    src = docs.drop("score")
    from pyspark.sql import types as T
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return K.arrow_map(src, "starmart.llm.nbsvm:score_batches",
                       T.StructType([*src.schema.fields, T.StructField("score", T.DoubleType())]), shared)
