import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from starmart.llm import textkit as K
from starmart.llm import variants as V


def one_edit(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_vocabulary(rows, least=7, count=2):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= least and c >= count}


def brute(n):
    by_len = {}
    for w in n:
        by_len.setdefault(len(w), []).append(w)
    near = {w: [u for k in (-1, 0, 1) for u in by_len.get(len(w) + k, []) if one_edit(w, u)] for w in n}
    form = {}
    for w, us in near.items():
        best = min(us, key=lambda u: (-n[u], u), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def rows_of(df):
    return {r.word: (r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def family(rng, word, letters):
    """Words at one or two edits of a word."""
    for _ in range(rng.randint(1, 3)):
        k = rng.randrange(len(word))
        word = rng.choice([word[:k] + word[k + 1:], word[:k] + rng.choice(letters) + word[k:], word[:k] + rng.choice(letters) + word[k + 1:]])
    return word


@pytest.fixture(scope="module")
def spelled(spark):
    """Families of variants with counts from 2 to 3000, with shared heads and tails."""
    rng = random.Random(5)
    letters = "abcdeéßxyzÿ"
    seeds = ["strasse" + "".join(rng.choices(letters, k=rng.randint(0, 6))) for _ in range(30)]
    seeds += ["".join(rng.choices(letters, k=rng.randint(6, 14))) + rng.choice(["", "ation"]) for _ in range(60)]
    words = []
    for w in seeds:
        words += [w] * rng.choice([2, 30, 400])
        for _ in range(rng.randint(1, 12)):
            words += [family(rng, w, letters)] * rng.choice([1, 2, 3, 40])
    rng.shuffle(words)
    rows = [(i, " ".join(words[k:k + 50])) for i, k in enumerate(range(0, len(words), 50))]
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


@pytest.mark.parametrize("block", [3, 40, V.BLOCK])
def test_against_brute_force(spelled, block):
    """Few words a block: all the block pairs of a hot head are met."""
    docs, rows = spelled
    ref = brute(plain_vocabulary(rows))
    assert rows_of(V.group_variants(docs, block=block)) == ref
    assert sum(r[1] is not None for r in ref.values()) > 100 and any(r[2] not in (r[0], r[1]) for r in ref.values())


def test_given_documents_and_edges(spark, small_docs, edge, clashing, empty):
    for docs in (small_docs, edge, clashing):
        assert rows_of(V.group_variants(docs)) == brute(plain_vocabulary([(r.doc_id, r.text) for r in docs.collect()]))
    assert V.group_variants(empty).count() == 0
    assert [f.name for f in V.group_variants(empty).schema] == ["word", "form", "root", "n", "n_near", "form_n"]


def test_short_words_and_long_runs(spark):
    rows = [(1, "ab ac abc b b ab ac abc " * 3), (2, "x" * 9000 + " " + "x" * 8999), (3, "x" * 9000 + " " + "x" * 8999), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(V.group_variants(docs, least_chars=1, block=2)) == brute(plain_vocabulary(rows, least=1))
    assert {r.n_near for r in V.group_variants(docs, every=10**12).collect()} == {1}


def test_equal_counts_go_to_the_first_word(spark):
    text = " ".join(["abcdefgz"] * 40 + ["abcdefga"] * 40 + ["abcdefg"] * 2)
    got = rows_of(V.group_variants(spark.createDataFrame([(1, text)], "doc_id long, text string"), every=10**12))
    assert got["abcdefg"] == ("abcdefg", "abcdefga", "abcdefga", 2, 2, 40)


def test_prefixes_within_one_edit():
    """A pair of blocks is left out only where no continuation can be within one edit."""
    rng = random.Random(1)
    prefixes = ["".join(rng.choices("ab", k=rng.randint(0, 4))) for _ in range(60)]
    tails = ["".join(t) for k in range(4) for t in __import__("itertools").product("ab", repeat=k)]
    m = V.codes(prefixes)
    for i, p in enumerate(prefixes):
        got = V.within_one(m[i], m)
        for q, ok in zip(prefixes, got):
            possible = any(p + s == q + t or one_edit(p + s, q + t) for s in tails for t in tails)
            assert ok or not possible, (p, q)
    far = V.codes(["abcdefgh", "xyzdefgh", "abcdxxgh"])
    assert V.within_one(far[0], far).tolist() == [True, False, False]


def test_matrix_rows_are_shared_by_prefix():
    """Rows are made for distinct prefixes near a query, not for every word."""
    words = sorted({f"zusammen{i:05d}" for i in range(4000)})
    w = V.Words(words)
    a, b = V.scan(w, [(0, 1, 0, len(words))])
    assert sorted(words[i] for i in b) == sorted(x for x in words if one_edit(words[0], x))


def test_pieces_of_long_texts():
    text = "aé " * 1000 + "b" * 5000 + " c"
    parts = list(K.pieces(text, V.NOT_RUN, 100))
    assert "".join(parts) == text and len(parts) > 20 and max(map(len, parts)) < 5200
    assert all(V.NOT_RUN.match(p[-1]) for p in parts[:-1])
    assert V.words_of(1, text, 10**12) == Counter({"aé": 1000, "b" * 5000: 1, "c": 1})
    assert np.array_equal(V.Words(["abc", "abd", "b"]).lcp(), [0, 2, 0])
