import random
import re

import numpy as np
import pyarrow as pa

from starmart.llm import textkit as K
from starmart.llm.components import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain_words(text):
    return WORD.findall((text or "").encode().translate(bytes(K.LOWER)))


def test_words_hash_equal_exactly_when_equal(small_docs):
    texts = [r.text for r in small_docs.select("text").collect()] + [None, "", "  ", "a", "\x1c a\x85b \xa0", "É e É"]
    for part in (texts, texts[::-1]):
        col = pa.array(part, pa.string())
        h, first = K.word_hashes(col)
        words = [plain_words(t) for t in part]
        assert np.diff(first).tolist() == [len(w) for w in words]
        seen = {}
        for w, x in zip((w for ws in words for w in ws), h.tolist()):
            assert seen.setdefault(w, x) == x
        assert len(set(seen.values())) == len(seen)
    assert K.word_hashes(col.slice(3, 4))[0].tolist() == h[first[3]:first[7]].tolist()


def test_shingle_sets_against_tuples():
    random.seed(2)
    texts = [" ".join(random.choice("abc") for _ in range(random.randint(0, 14))) for _ in range(200)] + [None, "", " "]
    got = K.shingle_sets(pa.array(texts, pa.string()))
    seen = {}
    for t, s in zip(texts, got):
        w = (t or "").split()
        ref = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        assert len(s) == len(ref)
        key = frozenset(ref)
        assert seen.setdefault(key, tuple(s)) == tuple(s)


def test_slices_cover_long_and_empty_texts():
    col = pa.array(["x" * 50, None, "", "y" * 500, "z"], pa.string())
    parts = list(K.slices(col, 60))
    assert parts[0][0] == 0 and parts[-1][1] == 5 and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
    assert list(K.slices(pa.array([], pa.string()))) == []


def test_counter_flushes_without_loss():
    acc, got = K.Counter64(limit=50), {}
    rng = np.random.default_rng(0)
    data = rng.integers(0, 400, 5000, dtype=np.uint64)
    for part in np.array_split(data, 37):
        for k, c in acc.add(part):
            for x, n in zip(k.tolist(), c.tolist()):
                got[x] = got.get(x, 0) + n
    for k, c in acc.flush():
        for x, n in zip(k.tolist(), c.tolist()):
            got[x] = got.get(x, 0) + n
    assert got == dict(zip(*(v.tolist() for v in np.unique(data, return_counts=True))))


def test_components_against_union_find(spark):
    random.seed(4)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    some = [(random.randint(0, 90), random.randint(0, 90)) for _ in range(45)] + [(7, 7)]
    edges = chain + star + some
    random.shuffle(edges)
    par = {}

    def find(x):
        par.setdefault(x, x)
        while par[x] != x:
            x = par[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        par[max(x, y)] = min(x, y)
    out = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    loose = {a for a, b in edges} | {b for a, b in edges}
    assert {x: find(x) for x in loose if find(x) != x or any(find(y) == x and y != x for y in loose)} == out
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
