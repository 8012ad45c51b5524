import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starmart.llm import imatch as I


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    texts = [t or "" for _, t in order]
    out = []
    for i, (doc, _) in enumerate(order):
        t, n = texts[i], texts[(i + 1) % len(texts)]
        q = len(t) // 4
        e = t[:len(t) - q] + n[:q]
        out.append((doc, len(t), hashlib.sha256(e.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts", [1, 5])
def test_edited_texts_follow_the_next_document(spark, small_docs, edge, clashing, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        for docs in (small_docs, edge, clashing, edge.limit(1)):
            rows = [(r.doc_id, r.text) for r in docs.collect()]
            out = I.fingerprint_documents(docs).collect()
            assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in out), key=repr) == brute(rows)
            assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and len(r.fingerprint) == 4 * I.LEXICONS for r in out)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_likeness_tells_edits_from_neighbours(small_docs):
    out = I.fingerprint_documents(small_docs).toPandas()
    assert out.near_edited.mean() > 0.4 and out.near_next.mean() < 0.1
    text = {r.doc_id: r.text for r in small_docs.collect()}
    prints = {}
    for r in out.itertuples():
        assert prints.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint


def test_band_bounds_the_lexicon(spark, monkeypatch, small_docs, empty):
    full = I.band(small_docs)
    monkeypatch.setattr(I, "MAX_LEXICON", 5000)
    assert 0 < len(I.band(small_docs)) <= min(5000, len(full))
    assert I.fingerprint_documents(empty).count() == 0 and len(I.band(empty)) == 0


def test_fingerprint_is_a_set_function_and_equal_texts_agree():
    lexicon = np.unique(I.K.word_hashes(pa.array(["alpha beta gamma delta " + " ".join(f"w{i}" for i in range(60))]))[0])
    words = [f"w{i}" for i in range(60)]
    col = pa.array([" ".join(words), " ".join(words[::-1]), "", None, " ", "one two", "one two"], pa.string())
    f = I.fingerprints(col, lexicon)
    assert (f[0] == f[1]).all() and (f[2] == f[3]).all() and (f[5] == f[6]).all() and not (f[4] == f[2]).all()
    assert I.likeness(f[[0, 2, 5]], f[[1, 3, 6]]).tolist() == [1, 1, 1]
    assert I.likeness(f[[0]], f[[5]])[0] == 0


def test_ids_beyond_doubles_lose_no_row(spark):
    rows = [(s * (2**62 + 12_345_677 * i), f"text {i} of words " * 8) for i in range(1, 120) for s in (1, -1)] + [(2**63 - 1, "last"), (-2**63, "first")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = I.fingerprint_documents(docs).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in out), key=repr) == brute(rows)


def test_null_ids_come_first_and_are_cut(spark):
    """Ids below any stand-in for a null, and a null id on 90 % of the rows: the ranges of
    texts stay even, also where the texts are copies."""
    rows = [(-2**60, "low " * 9), (None, "none " * 9), (5, "five " * 9)]
    out = I.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in out), key=repr) == brute(rows)
    many = [(None if i % 10 else i, f"text {i} " * 12 if i % 3 else "copy of one text " * 6) for i in range(2000)]
    docs = spark.createDataFrame(many, "doc_id long, text string")
    seen = []
    real = I.K.arrow_map

    def watch(df, target, *rest):
        if target.endswith("edit_batches"):
            seen.extend(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        return real(df, target, *rest)
    I.K.arrow_map = watch
    try:
        out = I.fingerprint_documents(docs).collect()
    finally:
        I.K.arrow_map = real
    assert len(out) == 2000 and sorted((r.doc_id or -1, r.n_chars) for r in out) == sorted((i or -1, len(t)) for i, t in many)
    assert sum(seen) == 2000 and max(seen) <= 3 * sorted(seen)[len(seen) // 2]


def plain_fingerprint(text, lexicon):
    """The fingerprint by plain Python sets."""
    words = {int(h) for h in I.K.word_hashes(pa.array([text]))[0]}
    return words & set(lexicon.tolist())


def test_likeness_against_brute_force(small_docs):
    """Likeness from fingerprints is that of the terms inside each subset, compared as sets."""
    lexicon = I.band(small_docs)
    texts = [r.text for r in small_docs.limit(40).collect()]
    f = I.fingerprints(pa.array(texts), lexicon)
    same = [(i, j) for i in range(40) for j in range(40) if plain_fingerprint(texts[i], lexicon) == plain_fingerprint(texts[j], lexicon)
            and len(plain_fingerprint(texts[i], lexicon)) >= I.SHORT]
    assert all((f[i] == f[j]).all() and I.likeness(f[[i]], f[[j]])[0] == 1 for i, j in same)
    for i in range(40):
        for j in range(i):
            a, b = plain_fingerprint(texts[i], lexicon), plain_fingerprint(texts[j], lexicon)
            if not a & b and min(len(a), len(b)) >= I.SHORT:
                assert I.likeness(f[[i]], f[[j]])[0] < 0.1
