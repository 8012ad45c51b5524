import corpus_pipeline as P
from starmart.llm import forced_bpe, nbsvm, pii, raking
from pyspark.sql import functions as F

from tests.llm.conftest import DOC, SF
from tests.llm.test_tgm import brute, null_id_rows

NAMES = ["quality", "near_duplicates", "pii", "mixing", "bpe"]


def test_stages_one_by_one_against_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in P.STAGES] == NAMES
    kept = {}
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert sorted(docs.columns) == sorted(columns)
        kept[name] = (before, docs)

    before, after = kept["quality"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    gone = before.join(after, "doc_id", "left_anti").join(labels, "doc_id").where("quality = 1").count()
    assert gone == 0 and after.join(labels, "doc_id").where("quality = 0").count() <= 2
    score = {r.doc_id: r.score for r in nbsvm.score(before, nbsvm.train(before, labels)).collect()}
    assert {r.doc_id for r in after.collect()} == {d for d, s in score.items() if s >= nbsvm.THRESHOLD}

    before, after = kept["near_duplicates"]
    ref = {d for d, _, c in brute([(r.doc_id, r.text) for r in before.collect()]) if d == c}
    assert sorted(r.doc_id for r in after.collect()) == sorted(ref)

    before, after = kept["pii"]
    ref = {r.doc_id: pii.redact(r.text, pii.find_spans(r.text)[1]) for r in before.collect()}
    assert {r.doc_id: (r.text, r.n_chars) for r in after.collect()} == {d: (t, len(t)) for d, t in ref.items()}
    assert not any(pii.base_spans(r.text) for r in after.collect())

    before, after = kept["mixing"]
    drawn = {r.doc_id for r in raking.mix(before).where("sampled").collect()}
    assert {r.doc_id for r in after.collect()} == drawn and 0 < len(drawn) < before.count()
    assert sorted(map(tuple, after.collect())) == sorted(tuple(r) for r in before.collect() if r.doc_id in drawn)

    before, after = kept["bpe"]
    codec = forced_bpe.codec(forced_bpe.default_path())
    assert after.count() == before.count()
    for r in after.collect():
        assert codec.decode(__import__("numpy").array(r.token_ids, "<u4").tobytes()) == r.text and r.n_tokens == len(r.token_ids)

    assert sorted(r.doc_id for r in P.run(spark, SF).select("doc_id").collect()) == sorted(drawn)


def test_edges(spark, edge, clashing, empty):
    for name, stage in P.STAGES:
        for docs in (clashing, empty):
            out = stage(spark, docs, SF)
            assert out.columns[:len(docs.columns)] == docs.columns, name
            n = out.count()
            assert n == 0 if docs is empty else n <= docs.count(), name
    once = [r.doc_id for r in P.near_duplicate_stage(spark, edge, SF).collect()]
    assert once.count(1) == 1 and 5 in once and 2 in once


def test_near_copies_with_a_null_id_go(spark):
    rows = null_id_rows()
    kept = P.near_duplicate_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [1, 5, 7]
    texts = [r.text for r in kept if r.doc_id is None]
    assert len(texts) == 2 and rows[8][1] in texts and (rows[5][1] in texts) != (rows[6][1] in texts)


def test_near_copies_and_repeated_rows_of_one_id(spark):
    """One row a group: near copies that share an id, copies with other columns, null ids."""
    words = " ".join(f"w{i}" for i in range(200))
    near, spaced = words + " tail", words.replace("w5 ", "w5  ")
    rows = [(1, words, "en", "b", 1), (1, near, "en", "a", 2), (1, spaced, "en", "a", 3), (2, words, "en", "a", 4),
            (3, "quite another text of its own " * 3, "de", "y", 5), (3, "quite another text of its own " * 3, "de", "x", 6),
            (3, "quite another text of its own " * 3, "de", "x", 6), (None, words, "en", "n", 7),
            (None, "a null id alone with some words of its own", "fr", "n", 8), (None, "a null id alone with some words of its own", "fr", "m", 9),
            (5, "", None, None, 0), (5, None, None, None, None), (5, "", None, None, 0)]
    docs = spark.createDataFrame(rows, DOC)
    for df in (docs, docs.repartition(5), docs.orderBy(F.desc("n_chars"))):
        out = sorted(map(tuple, P.near_duplicate_stage(spark, df, SF).collect()), key=repr)
        one = [r for r in out if r[0] in (1, 2) or r[0] is None and r[1] != rows[8][1]]
        assert len(one) == 1 and one[0][0] == 1 and one[0] in rows
        assert [r for r in out if r[0] == 3] == [(3, rows[4][1], "de", "x", 6)]
        assert [r[3:] for r in out if r[0] is None] == [("m", 9)]
        assert sorted(repr(r[1]) for r in out if r[0] == 5) == ["''", "None"]
    first = {tuple(r) for r in P.near_duplicate_stage(spark, docs, SF).collect()}
    assert first == {tuple(r) for r in P.near_duplicate_stage(spark, docs.repartition(3), SF).collect()}
