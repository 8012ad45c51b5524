"""Key resolution and referential joins.

Skew: a sentinel member (``UNKNOWN`` customer) can hold a third of all fact rows. The
lookup join salts only the hot keys, declared or measured: fact rows of a hot key get a salt spread
over ``buckets`` values from a hash of their own columns (deterministic, so a recomputed
task routes rows identically), and only the hot dimension rows are replicated
``buckets`` times. Every other row joins with salt 0. One scan, one shuffle, no cross
product, and the hot key is split over ``buckets`` tasks.

Keys nobody declared are found by a frequent-items sketch of the fact's key columns
(:func:`heavy_keys`): one narrow pass with a state of fixed size a task. Each heavy key
gets salts in proportion to its share, so the replicated dimension rows are bounded by the
number of partitions, not by the data. AQE's skew-join split stays behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SALT = "_salt"


def _is_hot(col: Column, hot_values) -> Column:
    return F.coalesce(col.isin(*hot_values), F.lit(False))


SALTS_A_PARTITION = 8          # salts of a key that held all rows, per shuffle partition
MOST_HEAVY = 1000              # a key is heavy from this share of the rows on (1/1000)


def heavy_candidates(df: DataFrame, columns: list[str], share: float) -> tuple[int, dict[str, dict]]:
    """(rows, column -> {value: estimated rows}): values that may hold ``share`` of the rows,
    by a frequent-items sketch of ten times as many counters as there can be such values.
    No value of that share is missed; counts are estimates."""
    k = min(1024, int(1 / share) + 1)
    row = df.agg(F.count(F.lit(1)).alias("n"), *[F.expr(f"approx_top_k(`{c}`, {k}, {min(1_000_000, 10 * k)})").alias(c) for c in columns]).first()
    return row["n"], {c: {x["item"]: x["count"] for x in row[c] or []} for c in columns}


def heavy_keys(facts: DataFrame, columns: list[str], partitions: int | None = None) -> dict[str, dict]:
    """Per key column the heavy values and the salts of each: those with half a partition's
    rows or more (and at least 1/``MOST_HEAVY`` of all). One pass over these columns."""
    n = partitions or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(1 / MOST_HEAVY, 1 / (2 * n))
    rows, found = heavy_candidates(facts, columns, share)
    return {c: {v: max(2, -(-SALTS_A_PARTITION * n * k // rows)) for v, k in items.items() if v is not None and k >= share * rows}
            for c, items in found.items()}


def heavy_report(df: DataFrame, columns: list[str], share: float = 1 / MOST_HEAVY) -> DataFrame:
    """(key_column, value, row_count) of every value that holds ``share`` of the rows: the
    sketch proposes, an exact count of the proposed values (at most 1/share a column)
    confirms."""
    rows, found = heavy_candidates(df, columns, share)
    parts = []
    for c in columns:
        values = df.sparkSession.createDataFrame([(v,) for v in found[c] if v is not None], df.select(F.col(c).alias("value")).schema)
        parts.append(df.select(F.col(c).alias("value")).join(F.broadcast(values), "value").groupBy("value")
                     .agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") >= share * rows)
                     .select(F.lit(c).alias("key_column"), F.col("value").cast("string").alias("value"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def lookup_heavy(facts: DataFrame, dim: DataFrame, on: str, columns: list[str], salts: dict, how: str = "left",
                 salt_columns: list[str] | None = None) -> DataFrame:
    """:func:`lookup` with a number of salts for each heavy value (:func:`heavy_keys`)."""
    d = dim.select(on, *[c for c in columns if c != on])
    if not salts:
        return facts.join(d, on, how)
    # at most MOST_HEAVY rows, joined map-side
    kind = facts.schema[on].dataType.simpleString()
    table = F.broadcast(facts.sparkSession.createDataFrame(list(salts.items()), f"`{on}` {kind}, _salts int"))
    many = F.coalesce("_salts", F.lit(1))
    cols = salt_columns or [c for c in facts.columns if c != on]
    f = facts.join(table, on, "left").withColumn(_SALT, F.pmod(F.xxhash64(*cols), many).cast("int")).drop("_salts")
    dd = d.join(table, on, "left").withColumn(_SALT, F.explode(F.sequence(F.lit(0), many - 1))).drop("_salts")
    return f.join(dd, [on, _SALT], how).drop(_SALT)


def lookup(facts: DataFrame, dim: DataFrame, on: str, columns: list[str], how: str = "left",
           hot_values: list | tuple = (), buckets: int | None = None,
           salt_columns: list[str] | None = None) -> DataFrame:
    """Many-to-one join of ``facts`` to a dimension unique on ``on``.

    ``hot_values`` lists natural keys known to be heavy (sentinels); they are salted as
    described in the module notes. Unmatched fact rows are kept for ``how='left'``.
    """
    d = dim.select(on, *[c for c in columns if c != on])
    if not hot_values:
        return facts.join(d, on, how)
    spark = facts.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = _is_hot(F.col(on), hot_values)
    cols = salt_columns or [c for c in facts.columns if c != on]
    f = facts.withColumn(_SALT, F.when(hot, F.pmod(F.xxhash64(*cols), F.lit(n))).otherwise(F.lit(0)).cast("int"))
    # only the (few) hot dimension rows are replicated, once per salt value
    dd = d.withColumn(_SALT, F.explode(
        F.when(hot, F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0)))))
    return f.join(dd, [on, _SALT], how).drop(_SALT)


def resolve_keys(facts: DataFrame, dim: DataFrame, natural: str, key: str,
                 fact_natural: str | None = None, hot_values: list | tuple = (),
                 buckets: int | None = None, salts: dict | None = None) -> DataFrame:
    """Left join facts to a dimension to replace a natural key by the surrogate key.

    Misses stay as rows with a null key (reported by :func:`unresolved_keys`). Hot keys are
    given by ``hot_values``, or by ``salts`` as measured (:func:`heavy_keys`)."""
    fn = fact_natural or natural
    d = dim.select(F.col(natural).alias(fn), F.col(key))
    if salts is not None:
        return lookup_heavy(facts, d, fn, [key], salts)
    return lookup(facts, d, fn, [key], "left", hot_values, buckets)


def unresolved_keys(resolved: DataFrame, checks: dict[str, tuple[str, str]]) -> DataFrame:
    """Per dimension, fact rows whose key stayed null and how many natural keys miss.

    ``checks`` maps a dimension name to ``(surrogate_key_column, natural_key_column)``.
    One scan: only missing rows become (dimension, natural key) pairs, which are counted
    by key with a partial step, then by dimension.
    """
    miss = F.array_compact(F.array(*[
        F.when(F.col(key).isNull(), F.struct(F.lit(name).alias("dimension"), F.col(nat).cast("string").alias("nk")))
        for name, (key, nat) in checks.items()]))
    keys = (resolved.select(F.explode(miss).alias("m")).groupBy("m.dimension", "m.nk")
            .agg(F.count(F.lit(1)).alias("n")))
    found = keys.groupBy("dimension").agg(F.sum("n").alias("unresolved_rows"), F.count("nk").alias("unresolved_keys"))
    names = resolved.sparkSession.createDataFrame([(n,) for n in checks], "dimension string")
    return (names.join(F.broadcast(found), "dimension", "left")
            .select("dimension", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("unresolved_rows", "unresolved_keys")]))


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-null foreign key has no parent row."""
    p = parent.select(F.col(pk).alias("_pk"))
    return child.filter(F.col(fk).isNotNull()).join(p, F.col(fk) == F.col("_pk"), "left_anti")


def _repeated(parents: list[tuple[DataFrame, str]]) -> list[int]:
    """Positions of the parents that hold a key value more than once; one job."""
    found = None
    for i, (parent, pk) in enumerate(parents):
        again = (parent.groupBy(F.col(pk).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
                 .agg(F.count_if((F.col("_n") > 1) & F.col("_v").isNotNull()).alias("_again")).select(F.lit(i).alias("_k"), "_again"))
        found = again if found is None else found.unionByName(again)
    return [r["_k"] for r in found.collect() if r["_again"]]


def fk_report(checks: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """One row per foreign key with the number of orphan child rows.

    The keys of one child frame are checked in a single pass over it, by their values: each
    task counts its rows by (key, value), and the counts meet the parents' values in one
    aggregate. Child rows cross no exchange, and a value that a third of them hold is a
    count a task. A child row counts once for every combination of parent rows it meets (a
    primary key has one): the values that repeat in a parent weigh the rows they match.
    Keys that are no whole numbers are checked by a left join to each parent."""
    children: dict[int, list] = {}
    for check in checks:
        children.setdefault(id(check[1]), []).append(check)
    parts = [_fk_by_value(g) if all(_is_whole(df, c) for _, child, fk, parent, pk in g for df, c in ((child, fk), (parent, pk)))
             else _fk_by_join(g) for g in children.values()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _is_whole(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def _fk_rows(wide: DataFrame, group: list) -> DataFrame:
    pairs = ", ".join(f"'{name}', _n{i}" for i, (name, *_) in enumerate(group))
    return wide.selectExpr(f"stack({len(group)}, {pairs}) as (foreign_key, orphan_rows)")


def _fk_by_value(group: list) -> DataFrame:
    child = group[0][1].select(*dict.fromkeys(fk for _, _, fk, _, _ in group))
    weight = F.lit(1).cast("long")
    for i in _repeated([(parent, pk) for *_, parent, pk in group]):
        _, _, fk, parent, pk = group[i]
        times = (parent.groupBy(F.col(pk).alias(f"_pk{i}")).agg(F.count(F.lit(1)).alias(f"_w{i}")).where(f"_w{i} > 1"))
        child = child.join(times, F.col(fk) == F.col(f"_pk{i}"), "left")
        weight = weight * F.coalesce(f"_w{i}", F.lit(1))
    values = F.array(*[F.struct(F.lit(i).alias("k"), F.col(fk).cast("long").alias("v")) for i, (_, _, fk, _, _) in enumerate(group)])
    seen = (child.select(F.explode(values).alias("_"), weight.alias("n")).select("_.k", "_.v", "n", F.lit(False).alias("known"))
            .where("v is not null"))
    for i, (_, _, _, parent, pk) in enumerate(group):
        seen = seen.unionByName(parent.select(F.lit(i).alias("k"), F.col(pk).cast("long").alias("v"), F.lit(0).cast("long").alias("n"), F.lit(True).alias("known")))
    values = seen.groupBy("k", "v").agg(F.sum("n").alias("n"), F.max("known").alias("known")).where("not known")
    return _fk_rows(values.agg(*[F.coalesce(F.sum(F.when(F.col("k") == i, F.col("n"))), F.lit(0)).alias(f"_n{i}") for i in range(len(group))]), group)


def _fk_by_join(group: list) -> DataFrame:
    j = group[0][1].select(*dict.fromkeys(fk for _, _, fk, _, _ in group))
    flags = []
    for i, (_, _, fk, parent, pk) in enumerate(group):
        p = parent.select(F.col(pk).alias(f"_pk{i}"))
        j = j.join(p, F.col(fk) == F.col(f"_pk{i}"), "left")
        flags.append(F.coalesce(F.sum((F.col(fk).isNotNull() & F.col(f"_pk{i}").isNull()).cast("long")), F.lit(0)).alias(f"_n{i}"))
    return _fk_rows(j.agg(*flags), group)


def value_mismatch(fact: DataFrame, dim_products: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Shipments whose value differs from ``round(quantity * unit_price, 2)``."""
    p = dim_products.select("product_id", "unit_price")
    j = fact.join(p, "product_id")
    expected = F.round(F.col("quantity") * F.col("unit_price"), 2)
    return (j.withColumn("expected_value", expected.cast("decimal(12,2)"))
            .filter(F.abs(F.col("shipment_value") - F.col("expected_value")) >= F.lit(tolerance)))
