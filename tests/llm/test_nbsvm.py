import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from starmart.llm import nbsvm as Q
from starmart.llm.queries import op5_quality
from tests.llm.conftest import CLASH_NAMES, SF


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = op5_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert len(out) > 50 and out.score.between(0, 1).all()
    assert (out.predicted == out.quality).mean() >= 0.97
    assert out[out.quality == 1].predicted.mean() >= 0.98
    assert set(out.predicted) <= {0, 1} and (out.predicted == (out.score >= 0.3)).all()


def test_dual_descent_minimises_the_hinge_objective():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 40, 8)).astype(np.int32) for _ in range(120)]
    y = np.array([1.0 if 3 in r or 5 in r else -1.0 for r in rows])
    y[:6] *= -1
    values = [np.ones(len(r)) / np.sqrt(len(r)) for r in rows]
    w = Q.dual_descent(rows, values, y, c=1.0, epochs=500, tol=1e-9)

    def objective(w):
        return 0.5 * w @ w + sum(max(0.0, 1 - t * (w[r] @ v + w[-1])) for r, v, t in zip(rows, values, y))
    best = objective(w)
    for _ in range(200):
        step = np.zeros_like(w)
        step[rng.integers(0, 40, 5)] = rng.normal(0, 0.05, 5)
        step[-1] = rng.normal(0, 0.02)
        assert objective(w + step) >= best - 1e-6


def test_log_count_ratios():
    rows = [np.array([1, 2], np.int32), np.array([1], np.int32), np.array([2], np.int32)]
    r = Q.log_count_ratio(rows, np.array([1.0, 1.0, -1.0]))
    p, q = np.ones(Q.FEATURES), np.ones(Q.FEATURES)
    p[1] += 2
    p[2] += 1
    q[2] += 1
    assert np.allclose(r, np.log(p / p.sum()) - np.log(q / q.sum()))


def test_features_are_sets_and_depend_on_the_text_alone():
    col = pa.array(["a a a b", "", None, "The!! END** 12", "a a a b"], pa.string())
    f = Q.features(col)
    assert all((np.diff(x) > 0).all() for x in f) and len(f[1]) == len(f[2]) == 0
    assert f[0].tolist() == f[4].tolist() == Q.features(col.slice(4, 1))[0].tolist()


def test_edges(spark, clashing, empty):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (5, 0, 0), (9, 1, 0), (None, 1, 0), (10, None, 0), (777, 1, 0)], "doc_id long, quality int, toxic int")
    model = Q.train(clashing, labels)
    out = Q.score(clashing, model)
    assert out.columns == [c for c in clashing.columns if c != "score"] + ["score"]
    rows = out.collect()
    assert len(rows) == clashing.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    assert len({r.score for r in rows if r.doc_id == 1}) == 1 and all(r[c] is not None for r in rows for c in CLASH_NAMES)
    assert Q.score(empty, model).count() == 0
    for none in (labels.limit(0), labels.where("quality = 1")):
        m = Q.train(clashing, none)
        assert len({round(r.score, 6) for r in Q.score(clashing, m).collect()}) == 1


def test_fit_is_bounded(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    m = Q.train(docs, labels, fit_rows=20)
    assert m[0].shape == m[1].shape == (Q.FEATURES,)


def test_rows_of_one_id_stay_within_the_bound(spark, monkeypatch):
    """Copies and rows that share a labelled id: at most fit_rows reach the driver."""
    rows = [(1, f"text {i % 7} of one id") for i in range(3000)] + [(i, f"other text {i}") for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(Q, "fit", lambda cols, y: seen.append(len(cols)))
    Q.train(docs, labels, fit_rows=2)
    Q.train(docs, labels)
    assert seen[0] == 2 and 7 < seen[1] <= 7 + 39


def test_scores_against_plain_sums(small_docs, spark):
    """A score is the logistic curve over the length-normalised sum of the weights."""
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = Q.train(small_docs, labels)
    ratio, weight, bias, slope, offset = model
    import math
    import pyarrow as pa
    for r in Q.score(small_docs, model).limit(60).collect():
        cols = Q.features(pa.array([r.text]))[0].tolist()
        n = math.sqrt(sum(float(ratio[c])**2 for c in cols))
        margin = (sum(float(weight[c]) for c in cols) / n if n else 0.0) + bias
        assert abs(r.score - 1 / (1 + math.exp(-(slope * margin + offset)))) < 1e-9
