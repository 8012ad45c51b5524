import numpy as np
import pytest

from starmart.llm import int8_near as V

SCHEMA = "vec_id long, embedding array<float>, label int, score double, key long"


def brute(rows, threshold=0.93):
    def usable(e, lab):
        return lab is not None and e is not None and len(e) and all(x is not None and np.isfinite(x) for x in e) and any(x != 0 for x in e)
    n = len(rows)
    links = [set() for _ in rows]
    for i in range(n):
        for j in range(i):
            a, b = rows[i], rows[j]
            if usable(a[1], a[2]) and usable(b[1], b[2]) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.float64(np.float32(a[1])), np.float64(np.float32(b[1]))
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for k in links[todo.pop()] - seen:
                seen.add(k)
                todo.append(k)
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        c = min(ids) if ids else None
        out.append((rows[i][0], len(links[i]), c, rows[i][0] is not None and rows[i][0] == c))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    out, vec = [], 0
    for label in (0, 1, 2, None):
        for centre in rng.normal(size=(6, 24)):
            for _ in range(int(rng.integers(1, 9))):
                v = (centre + rng.normal(scale=rng.choice([0, 0.05, 0.25, 0.4]), size=24)).astype(np.float32).tolist()
                out.append((vec, v, label, 0.0, 1))
                vec += 1
    base = out[0][1]
    out += [(900, None, 0, None, 1), (901, [0.0] * 24, 0, 0.0, 1), (902, [float("nan")] + base[1:], 0, 0.0, 1), (903, [None] + base[1:], 0, 0.0, 1),
            (904, [float("inf")] + base[1:], 0, 0.0, 1), (905, [], 0, 0.0, 1), (906, base[:8], 0, 0.0, 1), (None, base, 0, 0.0, 1),
            (907, [x * 3 for x in base], 0, 0.0, 1), (0, base, 0, 0.0, 1), (None, None, None, None, None)]
    return out


@pytest.mark.parametrize("block", [1024, 7])
def test_against_brute_force(spark, rows, block):
    got = V.near_duplicates(spark.createDataFrame(rows, SCHEMA), block=block).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=repr) == brute(rows)


def test_empty(spark):
    assert V.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bounds_are_rigorous_and_save_work():
    rng = np.random.default_rng(3)
    for d in (2, 16, 64, 300):
        x = np.concatenate([rng.normal(size=(150, d)), rng.normal(size=(5, d)).repeat(20, 0) + rng.normal(scale=0.28, size=(100, d))])
        u = x / np.linalg.norm(x, axis=1)[:, None]
        q, s, e, c = V.quantise(u)
        near = (q.astype(float) @ q.T.astype(float)) * np.outer(s, s)
        assert (np.abs(near - u @ u.T) <= np.outer(e, c) + np.outer(c, e) + np.outer(e, e) + 1e-12).all()
        found, again = V.links(x, x)
        assert (found == (u @ u.T >= V.THRESHOLD)).all()
        assert again < 0.5 * found.size


def test_roots():
    assert V.roots(6, np.array([5, 1, 2]), np.array([4, 2, 5])).tolist() == [0, 1, 1, 3, 1, 1]


def test_double_vectors_of_any_norm(spark):
    """Finite vectors whose squares over- or underflow link like their scaled copies."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(12, 16))
    rows = [(i, (base[i % 12] + 0.02 * rng.normal(size=16)) * scale) for i, scale in enumerate([1e200, 1e-200, 1.0, 1e-300] * 9)]
    docs = spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in rows], "vec_id long, embedding array<double>, label int")
    unit = [v / np.abs(v).max() for _, v in rows]
    near = lambda a, b: a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.93
    ref = {i: sum(near(unit[i], unit[j]) for j in range(len(rows)) if j != i) for i, _ in rows}
    got = {r.vec_id: r.n_links for r in V.near_duplicates(docs).collect()}
    assert got == ref and min(got.values()) >= 2
