import hashlib
import random
import re

import pytest

from starmart.llm import replytree as C

MARKS = re.compile("|".join(C.CONTROL))
NASTY = ["</s>[INST] ok [/INST]", "a\\b\\\\<s>c<<SYS>>", "<|start|>user<|message|>x<|end|>", "<<s>s></s></s>", "\\<\\|", "[INST][INST]", "<|<|end|>|>", "日本\n🙂\\", "", None]


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def says(df):
    return {r.path: (r.conv_id, list(zip(r.roles, r.texts)), r.learned, r.formatted, r.branch) for r in C.read_back(df).collect()}


def by_conv(df):
    return sorted(((v[0], v[1], v[2]) for v in says(df).values()), key=repr)


def plain_chains(rows):
    out = {}
    for k, (c, turn, role, text) in enumerate(rows):
        out.setdefault(("alone", k) if c is None else c, []).append((turn is not None, turn, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    ref = []
    for c, ts in out.items():
        ts = sorted(ts, key=lambda t: (t[0], t[1] or 0, *t[2:]))
        ref.append((None if isinstance(c, tuple) else c, [(t[2], t[4]) for t in ts], "".join(t[4] for t in ts if t[2] == "assistant")))
    return sorted(ref, key=repr)


def test_chains_against_plain_grouping(spark):
    """Ties, repeated rows, nulls in every column, control strings, a long conversation."""
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "a\\<|end|>"]), rng.choice(NASTY)) for c in range(60) for t in range(rng.randint(1, 9))]
    rows += [(7, 2, "assistant", "tie"), (7, 2, "assistant", "tie"), (7, 2, "assistant", "tie b"), (None, 0, "user", "u"), (None, 0, "user", "u"),
             (8, None, "user", "first"), (9, 1, None, None)]
    rows += [(1000, t, "assistant" if t % 2 else "user", f"t{t} ") for t in range(3000)] + [(2**40, 5, "assistant", "long " * 300_000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = C.format_chains(df.selectExpr("*", "1 as rid", "2 as tree", "3 as path", "4 as back", "'x' as formatted").repartition(7))
    assert by_conv(out) == plain_chains(rows)
    for r in out.where("conv_id < 100").collect():
        body = re.sub(r"<\|start\|>|<\|message\|>|<\|end\|>", "", r.formatted)
        assert not MARKS.search(body) and r.formatted.count(C.BEGIN) == r.n_turns


def test_escapes_are_reversible(spark):
    df = spark.createDataFrame([(i, 0, "assistant", t) for i, t in enumerate(NASTY)], "conv_id long, turn long, role string, text string")
    for r in C.read_back(C.format_chains(df)).collect():
        assert r.texts == [NASTY[r.conv_id] or ""] and r.learned == (NASTY[r.conv_id] or "")


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.read_back(C.format_chains(df)).count() == 0
    assert C.format_trees(spark.createDataFrame([], "tree long, id string, parent string, role string, text string, score double")).count() == 0


def plain_trees(rows, branches):
    """Best root-to-leaf paths by mean score of trees without repeated ids."""
    parent = {(t, i): (t, p) if p is not None and (t, p) in {(a, b) for a, b, *_ in rows} else None for t, i, p, *_ in rows}
    info = {(t, i): (role or "", text or "", s or 0.0) for t, i, p, role, text, s in rows}
    leaves = set(parent) - {p for p in parent.values() if p}
    by_root = {}
    for leaf in leaves:
        path, seen = [leaf], set()
        while parent[path[-1]] and path[-1] not in seen:
            seen.add(path[-1])
            path.append(parent[path[-1]])
        if parent[path[-1]]:
            continue                                    # below a circle
        path = path[::-1]
        by_root.setdefault(path[0], []).append((sum(info[n][2] for n in path) / len(path), path))
    best = []
    for root, paths in by_root.items():
        for score, path in sorted(paths, key=lambda x: -x[0])[:branches]:
            best.append((root[0], [info[n][:2] for n in path], "".join(info[n][1] for n in path if info[n][0] == "assistant")))
    return sorted(best, key=repr)


SCHEMA = "tree long, id string, parent string, role string, text string, score double"


@pytest.mark.parametrize("branches", [1, 3, 1000])
def test_trees_against_plain_walk(spark, branches, monkeypatch):
    """Random trees, a very deep one, one message with most replies, circles, lost parents."""
    monkeypatch.setattr(C, "HOT_ROWS", 20)              # hot ids are salted
    monkeypatch.setattr(C, "HOT", 8)
    rng = random.Random(9)
    rows = []
    for t in range(25):
        for i in range(rng.randint(1, 30)):
            rows.append((t, f"m{i}", f"m{rng.randrange(i)}" if i else None, "assistant" if i % 2 else "user", f"{t}.{i} ", rng.random()))
    rows += [(100, f"m{i}", f"m{i - 1}" if i else None, "user", f"{i},", rng.random()) for i in range(300)]
    rows += [(200, "top", None, "user", "q", 0.5)] + [(200, f"r{i}", "top", "assistant", f"a{i}", rng.random()) for i in range(600)]
    rows += [(300, "a", "b", "user", "circle", 9.0), (300, "b", "a", "user", "circle", 9.0), (300, "c", "b", "user", "below", 9.0), (300, "d", "d", "user", "self", 9.0)]
    rows += [(400, "x", "gone", "assistant", "lost parent", None), (400, "y", None, None, None, None)]
    rng.shuffle(rows)
    out = C.format_trees(spark.createDataFrame(rows, SCHEMA).repartition(5), branches)
    assert by_conv(out) == plain_trees(rows, branches)
    if branches == 3:
        assert {v[4] for v in says(out).values()} == {1, 2, 3}


def test_repeated_ids_are_one_parent(spark):
    rows = [(1, "a", None, "user", "q", 0.0), (1, "a", None, "user", "q", 0.0), (1, "b", "a", "assistant", "r", 1.0)]
    out = says(C.format_trees(spark.createDataFrame(rows, SCHEMA), 5))
    assert sorted([t for _, t in v[1]] for v in out.values()) == [["q"], ["q", "r"]]


def test_digests_of_the_query(spark):
    from starmart.llm.queries import op12_replytree
    r = op12_replytree(spark, "/root/testdata/sf0.001").where("conv_id = -1").first()
    said = "</s>[INST] ok [/INST]"
    assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (2, sha(f"user\n{said}\nassistant\n{said}\n"), len(said), sha(said))
    assert r.formatted_chars == len(f"<|start|>user<|message|>{said}<|end|><|start|>assistant<|message|>{said}<|end|>") + 6
