import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from starmart.llm import resample as R

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(rows, target, low=1, high=1, buckets=10_000, percent=10, seed=2024, least=20):
    def features(text):
        w = plain_words(text)
        return [" ".join(w[i:i + n]) for n in range(low, high + 1) for i in range(len(w) - n + 1)]

    at = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(at(f) for _, t in rows for f in features(t))
    g = Counter(at(f) for t in target for f in features(t))
    ns, nt = sum(s.values()), sum(g.values())
    gain = lambda b: math.floor(1000 * math.log((g[b] + 1) * (ns + buckets) / ((s[b] + 1) * (nt + buckets))))
    out = []
    for k, (i, t) in enumerate(rows):
        f = features(t)
        weight = sum(gain(at(x)) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(plain_words(t)), k])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[6]))
    for k, r in enumerate(able[:len(able) * percent // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"high": 3, "buckets": 500, "percent": 37, "seed": 7}, {"low": 2, "high": 2, "least_words": 1}, {"buckets": 100_000}])
def test_against_brute_force(spark, small_docs, options):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    ref = brute(rows, [r.text for r in target.collect()], **{{"least_words": "least"}.get(k, k): v for k, v in options.items()})
    assert got(R.resample(small_docs, target, **options)) == ref
    assert sum(r[4] is not None for r in ref) > 10


def test_edges(spark, edge, clashing, empty):
    target = spark.createDataFrame([("quick brown fox",), (None,), ("",)], "text string")
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    for docs in (edge, clashing):
        out = R.resample(docs, target, percent=100)
        assert {r[:4] for r in got(out)} == {r[:4] for r in brute(rows, ["quick brown fox"], percent=100)}
        ranks = sorted(r["rank"] for r in out.collect() if r["rank"])
        assert ranks == list(range(1, len(ranks) + 1))
    assert R.resample(empty, target).count() == 0
    assert got(R.resample(edge, empty.select("text"))) == brute(rows, [])
    drawn = R.draw(clashing, target, percent=50)
    assert drawn.columns == clashing.columns and drawn.count() == R.resample(clashing, target, percent=50).where("rank is not null").count() > 0


def test_a_hot_id_and_ties(spark):
    """One id holds most rows: ranks still run 1, 2, 3 over all of them, from many partitions."""
    rows = [(None if i % 10 else i, "alpha beta gamma delta " * 6) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    out = R.resample(docs, spark.createDataFrame([("alpha",)], "text string"), percent=90).toPandas()
    assert sorted(out["rank"].dropna().astype(int)) == list(range(1, 1801))
    ids = out[out["rank"].notna()].sort_values("rank")
    assert ids.score.is_monotonic_decreasing


def test_windows_cross_the_parts_of_a_long_text(monkeypatch):
    from starmart.llm import textkit as K
    text = "One two, three-four! fünf " * 300
    whole = R.text_buckets(text, R.pretokenizer(), 1, 3, R.Buckets(997))
    monkeypatch.setattr(K.pieces, "__defaults__", (40,))
    parts = R.text_buckets(text, R.pretokenizer(), 1, 3, R.Buckets(997))
    assert parts[0] == whole[0] == len(plain_words(text))
    assert Counter(parts[1].tolist()) == Counter(whole[1].tolist()) and len(whole[1]) == 3 * whole[0] - 3


def test_drawn_documents_resemble_the_target(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    target = docs.where("lang = 'de'").limit(40).select("text")
    drawn = R.draw(docs, target)
    share = lambda df: df.where("lang = 'de'").count() / df.count()
    assert share(drawn) > 1.3 * share(docs)
