"""Embedding near-duplicates from int8 tile products (operator 7).

Vectors are compared only inside one label. Equal vectors become one class first. The
classes of a label are dealt to blocks of about ``BLOCK`` by hash, and every pair of
blocks is a tile, one task's matrix product. In a tile each vector x is quantised to
int8, x = s*q + e; the integer product of two codes gives the cosine up to the rigorous
bound |e_x||s_y q_y| + |e_y||s_x q_x| + |e_x||e_y|. Pairs whose upper bound stays below
the threshold are done, pairs whose lower bound reaches it are links, and only the rest
is recomputed in double precision. A tile returns a row per linked vector, its link
count and the tile's component root, never its pairs; so a group of thousands of near
copies costs rows in proportion to its members and tiles.

Work is quadratic in a label's distinct vectors by nature, split evenly over tiles; a hot
label only has more tiles.

Defined results: vectors that are null, zero, of no component, or hold a null or
non-finite component, and rows with a null label, link with nothing; vectors of unequal
lengths do not link. Repeated rows are vectors of their own and link with each other. A
row with a null id is kept; it counts as a link and never names a component. An empty
table gives an empty result; further columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm import textkit as K
from starmart.llm.components import components, stored

THRESHOLD = 0.93
BLOCK = 1024
SLACK = 1e-9                   # over the rounding of the double-precision bound itself


def quantise(x: np.ndarray):
    """Unit vectors to (codes, scales, error norms, code norms)."""
    s = np.abs(x).max(1) / 127
    q = np.rint(x / s[:, None])
    near = q * s[:, None]
    return q.astype(np.int8), s, np.linalg.norm(x - near, axis=1), np.linalg.norm(near, axis=1)


def links(x: np.ndarray, y: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, int]:
    """Boolean matrix of cosine >= threshold, and how many pairs were recomputed. Vectors
    are scaled by their largest component first, so that no square over- or underflows."""
    x, y = (v / np.abs(v).max(axis=1, keepdims=True) for v in (x, y))
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    qx, sx, ex, cx = quantise(x / nx[:, None])
    qy, sy, ey, cy = quantise(y / ny[:, None])
    kind = np.float32 if 127 * 127 * x.shape[1] < 2**24 else np.float64   # integers stay exact
    near = (qx.astype(kind) @ qy.astype(kind).T).astype(np.float64) * sx[:, None] * sy
    bound = np.outer(ex, cy) + np.outer(cx, ey) + np.outer(ex, ey) + SLACK
    found = near - bound >= threshold
    i, j = np.nonzero((near + bound >= threshold) & ~found)
    for lo in range(0, len(i), 65_536):
        a, b = i[lo:lo + 65_536], j[lo:lo + 65_536]
        found[a, b] = np.einsum("ij,ij->i", x[a], y[b]) / (nx[a] * ny[b]) >= threshold
    return found, len(i)


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes over the pairs (i, j)."""
    label = np.arange(n)
    while len(i):
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def tile_groups(table: pa.Table, threshold: float) -> pa.Table:
    """Worker: one tile's rows to (key, links, root) of its linked vectors."""
    key = table.column("key").to_numpy()
    copies = table.column("copies").to_numpy()
    side = table.column("block").to_numpy() != table.column("lo").to_numpy()
    flat = table.column("embedding").combine_chunks()
    x = np.asarray(flat.flatten(), np.float64).reshape(len(key), -1)
    order = np.argsort(key, kind="stable")
    key, copies, side, x = key[order], copies[order], side[order], x[order]
    a, b = np.flatnonzero(~side), np.flatnonzero(side)
    if len(b):
        found, _ = links(x[a], x[b], threshold)
    elif table.column("lo")[0].as_py() == table.column("hi")[0].as_py():
        b = a
        found, _ = links(x[a], x[a], threshold)
        np.fill_diagonal(found, False)
    else:
        found = np.zeros((len(a), 0), bool)
    count = np.zeros(len(key), np.int64)
    count[a] = found @ copies[b]
    if b is not a:
        count[b] += found.T @ copies[a]
    i, j = np.nonzero(found)
    root = roots(len(key), a[i], b[j])
    some = count > 0
    return pa.table({"key": key[some], "links": count[some], "root": key[root[some]]})


def classes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): every row with the key of its class (null where it can link with
    nothing), and one row per class of equal vectors of a label."""
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    zero = ~F.exists("embedding", lambda v: v != 0)
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(True)) & ~F.coalesce(zero, F.lit(True))
    rows = vectors.select("vec_id", "label", "embedding").withColumn(
        "key", F.when(usable, F.xxhash64("label", "embedding")))
    classes = (rows.where("key is not null").groupBy("key", "label", "embedding")
               .agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies")))
    return rows.select("vec_id", "key"), classes


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``."""
    rows, classes = classes_of(vectors)
    classes = stored(classes.withColumn("dim", F.size("embedding")), "vector-classes")
    sizes = (classes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")))
    # labels of one block need no entry: at most (number of vectors / block) rows remain
    large = sizes.where("blocks > 1")
    tiles = (classes.join(large, ["label", "dim"], "left")
             .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
             .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", "label", "dim", "embedding", "copies", "block",
                     F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")))
    root = K.ROOT

    def run(table):
        import sys
        if root not in sys.path:
            sys.path.insert(0, root)
        from starmart.llm.int8_near import tile_groups
        return tile_groups(table, threshold)

    found = stored(tiles.groupBy("label", "dim", "lo", "hi").applyInArrow(run, "key long, links long, root long"), "vector-links")
    count = found.groupBy("key").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    named = (classes.select("key", "low", "copies").join(comp, F.col("key") == F.col("node"), "left")
             .select("key", "low", "copies", F.coalesce("component", "key").alias("component")))
    least = named.groupBy("component").agg(F.min("low").alias("component_id"))
    result = (named.join(least, "component").join(count, "key", "left")
              .select("key", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    return (rows.join(result, "key", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").cast("long").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
