import random
import zlib

import numpy as np
import pytest

from starmart.llm import crossparse as X
from starmart.llm.queries import op10_language


def phrases(text, source):
    n = i = 0
    while i < len(text):
        size = 0
        while i + size < len(text) and text[i:i + size + 1] in source:
            size += 1
        i += max(size, 1)
        n += 1
    return n


def test_phrases_are_greedy_longest_matches(monkeypatch):
    rng = random.Random(1)
    train = {"a": ["".join(rng.choice("abc ") for _ in range(400))], "b": ["".join(rng.choice("bcd ") for _ in range(300))]}
    m = X.Model(train)
    source = {k: " ".join(map(X.normalise, v)) for k, v in train.items()}
    texts = ["".join(rng.choice("abcdxé ") for _ in range(rng.randint(0, 120))) for _ in range(80)] + ["", "x"]
    assert m.phrases(texts).tolist() == [[phrases(t, source[k]) for k in m.langs] for t in texts]
    monkeypatch.setattr(X, "WINDOW", 16)
    got = m.phrases(texts)
    for t, row in zip(texts, got.tolist()):
        assert row == [sum(phrases(t[i:i + 16], source[k]) for i in range(0, len(t), 16)) for k in m.langs]


def test_automaton_accepts_exactly_the_substrings():
    rng = random.Random(9)
    for _ in range(20):
        s = [rng.randrange(3) for _ in range(rng.randint(1, 25))]
        table = X.suffix_automaton(np.array(s))
        assert len(table) <= 2 * len(s) + 1
        subs = {tuple(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        for _ in range(300):
            q = tuple(rng.randrange(3) for _ in range(rng.randint(1, 6)))
            state = 0
            for c in q:
                state = table[state, c] if state >= 0 else -1
            assert (state >= 0) == (q in subs)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = op10_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = out[out.held_out]
    assert [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id] == out.held_out.tolist()
    assert (held.lang_pred == held.lang).mean() >= 0.98 and out.score.between(0, 1).all()


def test_edges(clashing, empty):
    m = X.train(clashing)
    assert set(m.langs) <= {"en", "de", "fr", "es"}
    rows = X.predict(clashing, m).collect()
    assert len(rows) == clashing.count()
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (2, 3, 4, 7))
    assert all(r.lang_pred in m.langs for r in rows if r.doc_id in (1, 5, 6, 8, 9, 10))
    assert len({(r.lang_pred, r.score) for r in rows if r.doc_id == 1}) == 1
    assert X.predict(empty, X.train(empty)).count() == 0
    assert {r.lang_pred for r in X.predict(clashing, X.train(empty)).collect()} == {"und"}


@pytest.mark.parametrize("text,known", [("123 !!", False), ("Ünï", True), ("日本", True), (None, False), ("", False)])
def test_letters_of_any_script_count(text, known):
    m = X.Model({"en": ["hello world"], "de": ["hallo welt"]})
    assert (m.predict([text])[0][0] != "und") == known


def test_ties_go_to_the_first_name_and_tables_are_bounded():
    m = X.Model({"b": ["same text"], "a": ["same text"]})
    assert m.predict(["same"])[0] == ["a"]
    many = X.Model({f"l{i}": ["abc defg " * 20_000] for i in range(2)})
    assert many.table.nbytes <= X.TABLE_MB * 2**20


def test_letters_beyond_the_dense_classes_keep_their_identity():
    """Latin beside two large scripts whose letters are too many for the dense classes."""
    rng = random.Random(5)
    latin = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzäöüßéèêñáíóúàçğışćčđš ") for _ in range(3000)) * 2
    script = lambda lo: [chr(lo + k) for k in range(300)]
    word = lambda letters: "".join(rng.choice(letters) for _ in range(4))
    words = {k: [word(script(lo)) for _ in range(150)] for k, lo in (("ja", 0x4E00), ("zh", 0x6000))}
    text = lambda k, n: " ".join(rng.choice(words[k]) for _ in range(n))
    train = {"en": [latin], **{k: [text(k, 400)] for k in words}}
    m = X.Model(train)
    tests = [(k, text(k, 30)) for k in words for _ in range(10)]
    assert m.predict([t for _, t in tests])[0] == [k for k, _ in tests]
    source = {k: " ".join(map(X.normalise, v)) for k, v in train.items()}
    texts = [t for _, t in tests] + [latin[:90] + text("zh", 3) + "Жж" + text("ja", 2)]
    texts = [X.normalise(t) for t in texts]
    assert m.phrases(texts).tolist() == [[phrases(t, source[k]) for k in m.langs] for t in texts]


def test_the_sample_is_bounded_by_whole_rows(spark):
    """Rows that share an id, copies, long texts: whole texts, a bound a language."""
    rng = random.Random(2)
    text = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    rows = [(None, text(100), "en") for _ in range(3000)] + [(7, "copy " * 200, "de")] * 2000 + [(i, text(2000), "fr") for i in range(50)] + [(i, text(20), "es") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {}
    for r in X.sample_rows(docs).collect():
        got.setdefault(r.lang, []).append(r.text)
    assert set(got) <= {"en", "de", "es"} and all(t in {x for _, x, _ in rows} for ts in got.values() for t in ts)
    assert X.TRAIN_CHARS <= sum(map(len, got["en"])) < X.TRAIN_CHARS + X.LONGEST


def test_predictions_against_plain_parsing(spark):
    """lang_pred and score from phrases found by plain string search."""
    import math
    rng = random.Random(3)
    train = {k: ["".join(rng.choice(letters) for _ in range(300)) for _ in range(3)] for k, letters in {"x": "abcd ", "y": "bcde ", "z": "cdea "}.items()}
    m = X.Model(train)
    texts = ["".join(rng.choice("abcde ") for _ in range(rng.randint(1, 150))) for _ in range(60)] + ["", None, "12"]
    lang, score = m.predict(texts)
    source = {k: " ".join(filter(None, map(X.normalise, v))) for k, v in train.items()}
    for t, got, s in zip(texts, lang, score):
        n = X.normalise(t) if t else ""
        if not n:
            assert (got, s) == ("und", 0)
            continue
        cost = sorted((phrases(n, source[k]) * math.log2(len(source[k])), k) for k in m.langs)
        assert abs(s - (0.5 + 0.5 * (cost[1][0] - cost[0][0]) / cost[1][0])) < 1e-9
        assert phrases(n, source[got]) * math.log2(len(source[got])) == cost[0][0]


def test_many_languages_share_the_dense_table():
    rng = random.Random(6)
    train = {f"l{i:02d}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz"[i % 20:i % 20 + 6] + " ") for _ in range(400))] for i in range(40)}
    m = X.Model(train)
    assert m.dense < X.ALPHABET and m.table.nbytes <= X.TABLE_MB * 2**20
    texts = [v[0][30:90] for v in train.values()]
    source = {k: " ".join(map(X.normalise, v)) for k, v in train.items()}
    assert m.phrases([X.normalise(t) for t in texts]).tolist() == [[phrases(X.normalise(t), source[k]) for k in m.langs] for t in texts]
