import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starmart.llm import bloomlm as B
from starmart.llm import textkit as K
from tests.llm.test_helpers import plain_words

END = b"<end>"


def counted(rows):
    """(held, tokens, unigram counts, bigram counts) by plain Python."""
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    tokens = [plain_words(t) + [END] for _, t in rows]
    one = Counter(w for h, t in zip(held, tokens) if not h for w in t)
    two = Counter(p for h, t in zip(held, tokens) if not h for p in zip([END, *t], t))
    return held, tokens, one, two


def level(c):
    return 1 + math.floor(math.log(c) / math.log(B.STEP) + 1e-9) if c else 0


def brute(rows):
    held, tokens, one, two = counted(rows)
    n, v = sum(one.values()), len(one)
    p = lambda w: (one[w] + 0.1) / (n + 0.1 * (v + 1))
    by_level = {}
    for c in two.values():
        by_level.setdefault(level(c), []).append(c)
    mean = {q: sum(cs) / len(cs) for q, cs in by_level.items()} | {0: 0.0}

    def after(u, w):
        return B.L * min(mean[level(two[u, w])], one[u], one[w]) / one[u] + (1 - B.L) * p(w) if one[u] else p(w)

    return sorted(((i, h, len(t), sum(one[w] > 0 for w in t), n, sum(math.log10(p(w)) for w in t),
                    sum(math.log10(after(u, w)) for u, w in zip([END, *t], t))) for (i, _), h, t in zip(rows, held, tokens)), key=repr)


def same(got, ref, what):
    got = sorted((tuple(r) for r in got), key=repr)
    assert [g[:5] for g in got] == [r[:5] for r in ref]
    for g, r in zip(got, ref):
        assert all(abs(g[k] - r[k]) < 1e-6 * max(1, abs(r[k])) for k in what), (g, r)


@pytest.mark.parametrize("shards,slice_bytes", [(1, 1 << 24), (7, 5000)])
def test_every_bigram_counts(small_docs, edge, clashing, shards, slice_bytes):
    """Base and model score, from one shard and slice or from many, next to no false positives."""
    for docs in (small_docs, edge, clashing):
        same(B.score(docs, shards=shards, slice_bytes=slice_bytes, bits_per_key=200).collect(), brute([(r.doc_id, r.text) for r in docs.collect()]), (5, 6))


def test_production_filter_over_several_shards(small_docs):
    """The base is exact; the filter of 12 bits a key is never under a stored level, and over
    it for few probes, which moves the score of a text by little."""
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    got, ref = sorted((tuple(r) for r in B.score(small_docs, shards=5).collect()), key=repr), brute(rows)
    same(got, ref, (5,))
    assert B.BITS_PER_KEY == 12
    more = [(g[6] - r[6]) / r[2] for g, r in zip(got, ref)]
    assert min(more) > -0.003 and np.mean(np.abs(more)) < 0.01


def test_filter_reads_back_levels():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(1, 2**48, 20_000, dtype=np.uint64))
    counts = rng.integers(1, 50_000, len(keys))
    bloom = B.LogFrequencyBloom(keys, counts)
    got = bloom.levels(keys)
    assert (got >= B.levels_of(counts)).all() and (got == B.levels_of(counts)).mean() > 0.98
    other = rng.integers(1, 2**48, 50_000, dtype=np.uint64)
    assert (bloom.levels(other) > 0).mean() < 0.02
    assert B.LogFrequencyBloom(keys[:0], counts[:0]).levels(keys[:5]).tolist() == [0] * 5
    assert B.levels_of(np.array([0, 1, 2, 3, 4, 5, 6, 10**12])).tolist() == [level(c) for c in (0, 1, 2, 3, 4, 5, 6)] + [B.MAX_LEVELS]


def test_a_score_does_not_depend_on_the_size_of_the_corpus_rule(spark):
    """A bigram seen once counts the same in a small corpus and beside a large one."""
    rare = [(i, f"a{i} b{i}") for i in range(1, 60)]
    large = rare + [(10_000 + i, " ".join(f"w{(i * 7 + k) % 50}" for k in range(400))) for i in range(600)]
    for rows in (rare, large):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        same(B.score(docs, bits_per_key=200).collect(), brute(rows), (5, 6))


def test_probabilities_after_a_context_sum_to_one(spark):
    """On average over contexts of the given documents; before, rounding down gave 0.97."""
    rows = [(r.doc_id, r.text) for r in K.documents(spark, "/root/testdata/sf0.001", "doc_id", "text").collect()]
    _, _, one, two = counted(rows)
    by_level = {}
    for c in two.values():
        by_level.setdefault(level(c), []).append(c)
    mean = {q: sum(cs) / len(cs) for q, cs in by_level.items()}
    n, v = sum(one.values()), len(one)
    seen = {}
    for (u, w), c in two.items():
        seen[u] = seen.get(u, 0.0) + min(mean[level(c)], one[u], one[w])
    rest = (1 - B.L) * sum((c + 0.1) / (n + 0.1 * (v + 1)) for c in one.values())
    sums = [B.L * s / one[u] + rest for u, s in seen.items()]
    assert abs(np.mean(sums) - 1) < 0.01 and 0.9 < min(sums) and max(sums) < 1.1


def test_packing():
    counts = np.array([0, 1, 254, 255, 256, 10**12])
    assert B.unpacked(*B.packed(counts)).tolist() == counts.tolist()
    keys = np.array([0, 1, 2**48 - 1], np.uint64)
    raw = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    assert B.keys_of(raw, 6).tolist() == keys.tolist()
    assert B.shard_of(keys, 48, 7).tolist() == [0, 0, 6]


def test_slices_depend_on_rows_and_not_on_batches():
    table = pa.table({"text": [("x" * (i % 70)) or None for i in range(500)]})
    cut = lambda size: [(k, t.column("text").to_pylist()) for k, t in B.slices_of(table.to_batches(size), 100)]
    assert cut(500) == cut(7) == cut(1)
    assert [x for _, t in cut(13) for x in t] == table.column("text").to_pylist()


def test_rows_that_change_between_the_passes_fail(small_docs):
    with pytest.raises(Exception, match="store the documents"):
        B.score(small_docs.withColumn("text", F.concat("text", F.lit(" "), F.current_timestamp().cast("string")))).collect()


def test_hot_words_and_ids(spark):
    """Every text holds one bigram, and most ids are null: shards and slices stay even."""
    rows = [(None if i % 3 else i, f"hot pair {i % 11} hot pair") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = B.score(docs, shards=3).collect()
    assert len(got) == 3000 and all(math.isfinite(r.score) and r.score <= 0 for r in got)


def test_model_predicts_held_out_text_better(spark, empty):
    docs = K.documents(spark, "/root/testdata/sf0.01", "doc_id", "text")
    held = B.score(docs).where("held_out").toPandas()
    assert held.score.sum() > 0.9 * held.base_score.sum()
    assert B.score(empty).count() == 0
    nothing = B.score(docs.where("doc_id < 20"), held_out=F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in nothing)
