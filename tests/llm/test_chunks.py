import random
from collections import Counter

import numpy as np

from starmart.llm import chunkdedup as C


def chunks(text):
    b = (text or "").encode()
    a = np.frombuffer(b, np.uint8)
    ends = C.chunk_ends(a, 0, len(b), C.gear_cuts(a).tolist()) if b else []
    return [b[x:y] for x, y in zip([0, *ends[:-1]], ends)]


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_chunks_cover_the_text_within_their_sizes():
    rng = random.Random(3)
    for text in [words(rng, 300), "a" * 2000, "é日🙂" * 400, "x", "ab\n" * 500]:
        got = chunks(text)
        assert b"".join(got) == text.encode()
        assert all(C.LEAST <= len(c) <= C.MOST + 3 for c in got[:-1]) and all(c.decode() for c in got)


def test_rolling_hash_forgets_after_sixteen_bytes():
    rng = np.random.default_rng(0)
    buf = rng.integers(97, 120, 4000).astype(np.uint8)
    h, cuts = 0, []
    for i, b in enumerate(buf.tolist()):
        h = ((h << 1) + int(C.GEAR[b])) & 0xFFFF
        if h < 1 << (16 - C.CUT_BITS) and i + 1 < len(buf):
            cuts.append(i + 1)
    assert [c for c in C.gear_cuts(buf).tolist() if c >= 16] == [c for c in cuts if c >= 16]


def test_cuts_resist_an_insertion():
    rng = random.Random(5)
    text = words(rng, 400)
    a, b = Counter(chunks(text)), Counter(chunks(text[:700] + "INSERTED" + text[700:]))
    assert sum((a - b).values()) <= 6


def test_planted_passages_are_found_and_clean_texts_left(spark):
    rng = random.Random(8)
    passage = [words(rng, 55) for _ in range(4)]
    rows = [(i, words(rng, 120)) for i in range(40)]
    planted = {}
    for i in range(40, 80):
        k = i % 4
        rows.append((i, words(rng, rng.randint(5, 60)) + " " + passage[k] + " " + words(rng, rng.randint(5, 60))))
        planted[i] = k
    out = {r.doc_id: r for r in C.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[i].n_repeats == 0 and out[i].repeats == "" for i in range(40))
    texts = dict(rows)
    for i, k in planted.items():
        assert out[i].n_repeats >= 1 and out[i].repeat_chars >= 100
        for s in out[i].repeats.split(","):
            a, z = map(int, s.split(":"))
            assert texts[i][a:z] in " " + passage[k] + " "
        first = min(d for d in planted if planted[d] == k)
        assert (out[i].removable_chars == 0) == (i == first) and (i == first or first in out[i].first_docs)


def test_shared_chunks_against_brute_force(spark, small_docs, clashing, empty):
    for docs in (small_docs, clashing):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        seen = Counter(c for _, t in rows for c in chunks(t))
        ref = sorted(((i, len(t or ""), len(chunks(t)), sum(seen[c] > 1 for c in chunks(t))) for i, t in rows), key=repr)
        out = C.repeats(docs).collect()
        assert sorted(((r.doc_id, r.n_chars, r.n_chunks, r.n_shared) for r in out), key=repr) == ref
    assert C.repeats(empty).count() == 0


def test_removal_keeps_the_first_copy_only(spark):
    rng = random.Random(2)
    text = words(rng, 200)
    docs = spark.createDataFrame([(2, text, 1), (1, text, 2), (3, words(rng, 30), 3), (4, None, 4)], "doc_id long, text string, removable int")
    out = {r.doc_id: r for r in C.without_repeats(docs).collect()}
    assert out[1].text == text and out[2].text == "" and out[4].text is None and len(out[3].text) > 30


def test_passages_of_short_words_are_met(spark):
    """52 words of two letters on average, once in each of two texts: recall 0.9 or more
    (0.57 where a run needed 100 characters)."""
    rng = random.Random(4)
    short = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, 3))) for _ in range(n))
    rows = []
    for i in range(200):
        p = short(52)
        rows += [(2 * i + k, words(rng, rng.randint(5, 60)) + " " + p + " " + words(rng, rng.randint(5, 60))) for k in range(2)]
    out = C.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(r.n_repeats > 0 for r in out) >= 0.9 * len(rows)


def plain_repeats(rows):
    """Repeats by plain Python: runs of chunks that the corpus holds twice."""
    seen = Counter(c for _, t in rows for c in chunks(t))
    out = {}
    for i, t in rows:
        at, runs = 0, []
        for c in chunks(t) + [None]:
            if c is not None and seen[c] > 1:
                if not runs or runs[-1][2]:
                    runs.append([at, at, False])
                runs[-1][1] = at + len(c)
            elif runs:
                runs[-1][2] = True
            at += len(c or b"")
        raw, found = (t or "").encode(), []
        for a, z, _ in runs:
            begun = sum(raw[k:k + 1].strip() != b"" and (k == 0 or raw[k - 1:k].strip() == b"") for k in range(a, z))
            if begun >= C.RUN_WORDS or len(raw[a:z].decode()) >= C.RUN:
                found.append(f"{len(raw[:a].decode())}:{len(raw[:z].decode())}")
        out[i] = ",".join(found)
    return out


def test_repeats_against_brute_force(spark, small_docs):
    rng = random.Random(12)
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    rows += [(10_000 + i, words(rng, 30) + " " + (passage := words(random.Random(i // 3), 60)) + " é日 " + passage) for i in range(9)] + [(20_000, None), (20_001, "日本" * 400), (20_002, "x" + "日本" * 400)]
    out = {r.doc_id: r.repeats for r in C.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == plain_repeats(rows) and sum(map(bool, out.values())) > 9
