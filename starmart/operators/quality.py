"""Constraints, quality checks and monitoring.

Every check is one aggregate pass (partial aggregation per task, a tiny final merge),
then reshaped with ``stack``; nothing is pulled to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import schemas

# The monitor's thresholds.
EXPECTED_MIN_BRONZE_ROWS = 500_000
MAX_SILVER_TO_GOLD_LOSS = 1_000


def _lit_name(s: str) -> str:
    return s.replace("'", "''")


def not_null_rules(columns: list[str]) -> dict[str, Column]:
    return {f"{c} not null": F.col(c).isNotNull() for c in columns}


def length_rules(limits: dict[str, int]) -> dict[str, Column]:
    return {f"{c} length <= {n}": F.col(c).isNull() | (F.length(c) <= n) for c, n in limits.items()}


def check_rules(checks: dict[str, str]) -> dict[str, Column]:
    return {name: F.coalesce(F.expr(expr), F.lit(True)) for name, expr in checks.items()}


def check_rows(df: DataFrame, rules: dict[str, Column], table: str = "table") -> DataFrame:
    """Q1: number of rows breaking each rule (a rule is a Column that is true for a good
    row), as (table_name, rule, violations); all rules in one aggregate."""
    names = list(rules)
    wide = df.agg(*[F.coalesce(F.sum(F.when(~rules[n], 1).otherwise(0)), F.lit(0)).cast("long").alias(f"_r{i}")
                    for i, n in enumerate(names)])
    pairs = ", ".join(f"'{_lit_name(n)}', _r{i}" for i, n in enumerate(names))
    return wide.selectExpr(f"stack({len(names)}, {pairs}) as (rule, violations)") \
               .select(F.lit(table).alias("table_name"), "rule", "violations")


def check_unique(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Q2/K2: key values held by more than one row, with their row count."""
    keys = [key] if isinstance(key, str) else key
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Attach a row count (and any extra aggregate ``metrics``) to ``df``; the values
    are filled in by whichever action runs the plan, with no extra pass. Read them with
    ``observation.get`` after that action."""
    obs = Observation(name)
    extra = [c.alias(k) for k, c in metrics.items()]
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *extra), obs


def layer_counts(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Row count of each layer in one job: three global counts (each a partial count
    per task and a one-row merge) unioned. An empty layer reports 0."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
             for name, df in (("bronze", bronze), ("silver", silver), ("gold", gold))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def audit_layers(counts: DataFrame, min_bronze: int = EXPECTED_MIN_BRONZE_ROWS,
                 max_loss: int = MAX_SILVER_TO_GOLD_LOSS) -> DataFrame:
    """Q5/Q6: one (check, value, status) row per monitor check plus an overall row with
    the worst status. Statuses: Bronze below the floor = ERROR; Gold empty = ERROR;
    Silver above Bronze = ERROR; Silver->Gold loss above the limit = WARNING, negative =
    ERROR; else OK."""
    w = counts.groupBy().pivot("layer", ["bronze", "silver", "gold"]).agg(F.first("row_count"))
    b, s, g = F.col("bronze"), F.col("silver"), F.col("gold")
    checks = w.select(
        b.alias("bronze_rows"),
        F.when(b < min_bronze, "ERROR").otherwise("OK").alias("s1"),
        g.alias("gold_rows"),
        F.when(g == 0, "ERROR").otherwise("OK").alias("s2"),
        (b - s).alias("bronze_to_silver_loss"),
        F.when(b - s < 0, "ERROR").otherwise("OK").alias("s3"),
        (s - g).alias("silver_to_gold_loss"),
        F.when(s - g > max_loss, "WARNING").when(s - g < 0, "ERROR").otherwise("OK").alias("s4"),
    )
    rows = checks.selectExpr(
        "stack(4, 'bronze_rows', bronze_rows, s1, 'gold_rows', gold_rows, s2, "
        "'bronze_to_silver_loss', bronze_to_silver_loss, s3, "
        "'silver_to_gold_loss', silver_to_gold_loss, s4) as (check_name, value, status)")
    rank = F.when(F.col("status") == "ERROR", 2).when(F.col("status") == "WARNING", 1).otherwise(0)
    overall = rows.agg(F.max(rank).alias("_r")).select(
        F.lit("overall").alias("check_name"), F.lit(None).cast("long").alias("value"),
        F.when(F.col("_r") == 2, "ERROR").when(F.col("_r") == 1, "WARNING").otherwise("OK").alias("status"))
    return rows.select("check_name", F.col("value").cast("long"), "status").unionByName(overall)


def profile(df: DataFrame, columns: list[str] | None = None, exact: bool = True,
            rsd: float = 0.01) -> DataFrame:
    """Q7: per column the row count, null count and distinct non-null values.

    ``exact``: one group-by per column, each reading its column alone, so no row is
    expanded; give it a stored table, as every column is a scan of its own.
    ``exact=False``: one pass with HyperLogLog++ sketches, a fixed-size state per column,
    for very large tables or computed frames."""
    cols = columns or df.columns
    if exact:
        parts = []
        for c in cols:
            by = df.groupBy(F.col(c).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
            parts.append(by.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
                                F.coalesce(F.sum(F.when(F.col("_v").isNull(), F.col("_n"))), F.lit(0)).alias("null_count"),
                                F.count("_v").alias("distinct_count"))
                         .select(F.lit(c).alias("column_name"), "row_count", "null_count", "distinct_count"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        aggs.append(F.sum(F.col(c).isNull().cast("long")).alias(f"_n{i}"))
        aggs.append(F.approx_count_distinct(c, rsd).alias(f"_d{i}"))
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{_lit_name(c)}', _rows, _n{i}, _d{i}" for i, c in enumerate(cols))
    return wide.selectExpr(
        f"stack({len(cols)}, {pairs}) as (column_name, row_count, null_count, distinct_count)")


#: Sketch sizes. 2^14 registers: a relative standard error of 0.8 % of the
#: distinct count; 400 items a level: ranks within about 1 %.
HLL_LG, KLL_K = 14, 400


def profile_sketch(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Q7 in mergeable form: one row a column (column_name, row_count, null_count, distinct
    and, for numbers, quantile sketches) from one pass over ``df``. Stored beside each
    day or partition, so that a new day costs a pass over that day (:func:`merged_profile`)."""
    cols = columns or df.columns
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    aggs, fields = [F.count(F.lit(1)).alias("_rows")], []
    for i, c in enumerate(cols):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"_n{i}"), F.hll_sketch_agg(F.col(c).cast("string"), HLL_LG).alias(f"_d{i}")]
        if c in numeric:
            aggs.append(F.expr(f"kll_sketch_agg_double(cast(`{c}` as double), {KLL_K})").alias(f"_q{i}"))
        q = f"_q{i}" if c in numeric else "cast(null as binary)"
        fields.append(f"'{_lit_name(c)}', _rows, _n{i}, _d{i}, {q}")
    return df.agg(*aggs).selectExpr(f"stack({len(cols)}, {', '.join(fields)}) as (column_name, row_count, null_count, distinct_sketch, quantile_sketch)")


def merged_profile(sketches: DataFrame, quantiles: tuple = (0.25, 0.5, 0.75)) -> DataFrame:
    """The profile of all sketched parts together: row_count and null_count exact,
    distinct_count and the quantiles by the merged sketches."""
    w = sketches.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_count"),
        F.count("quantile_sketch").alias("_sketches"), F.expr("kll_merge_agg_double(quantile_sketch)").alias("_q"))
    at = ", ".join(f"{q}D" for q in quantiles)
    got = F.when((F.col("row_count") > F.col("null_count")) & (F.col("_sketches") > 0), F.expr(f"kll_sketch_get_quantile_double(_q, array({at}))"))
    return w.withColumn("_v", got).select("column_name", "row_count", "null_count", "distinct_count",
                                          *[F.col("_v")[i].alias(f"p{int(100 * q)}") for i, q in enumerate(quantiles)])


def table_rules(name: str, columns: list[str] | None = None) -> dict[str, Column]:
    """Every declared row rule of a table: NOT NULL, VARCHAR lengths, CHECKs; ``columns``
    leaves out the NOT NULL of columns not built yet (a key assigned by the write)."""
    rules = not_null_rules([f.name for f in schemas.SCHEMAS[name].fields
                            if not f.nullable and (columns is None or f.name in columns)])
    rules.update(length_rules(schemas.VARCHAR_LIMITS.get(name, {})))
    rules.update(check_rules(schemas.CHECKS.get(name, {})))
    return rules


def declared_keys(df: DataFrame, name: str) -> DataFrame:
    """Q2 on a table's declared keys: (table_name, key, duplicated values, rows holding
    them). Nulls repeat freely in a UNIQUE column, as in SQL; a PRIMARY KEY holds none."""
    parts = []
    for key in schemas.KEYS.get(name, []):
        cols = list(key)
        # nulls are looked at after the grouping: a filter would compute a derived key twice
        dup = F.expr(" and ".join(["n > 1", *[f"{c} is not null" for c in cols]]))
        parts.append(df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
                     .agg(F.count_if(dup).alias("duplicated_keys"), F.coalesce(F.sum(F.when(dup, F.col("n"))), F.lit(0)).alias("rows_involved"))
                     .select(F.lit(name).alias("table_name"), F.lit(", ".join(cols)).alias("key_columns"), "duplicated_keys", "rows_involved"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class ConstraintError(ValueError):
    """A table breaks its declared rules."""


class ObservedRules:
    """Q1 on rows while they are written: the job that writes ``rows`` counts the rows that
    break each rule of the table, so nothing is read again. :meth:`check`, after the write,
    raises when there are any (before the version is committed) or returns the row count.
    The observation stands right under the write, in its own stage.

    ``columns`` as in :func:`table_rules`. :meth:`report` gives the counts as
    :func:`check_rows` does, with no pass of its own over a costly frame."""

    def __init__(self, df: DataFrame, name: str, columns: list[str] | None = None):
        self.name, self.rules, self.seen = name, table_rules(name, columns), []
        self.rows = self.over(df)

    def over(self, df: DataFrame) -> DataFrame:
        """Further rows of the table, written by a job of their own; the counts add up."""
        self.seen.append(Observation(f"rules of {self.name}"))
        counts = [F.count_if(~rule).alias(f"r{i}") for i, rule in enumerate(self.rules.values())]
        return df.observe(self.seen[-1], F.count(F.lit(1)).alias("rows"), *counts)

    def _counts(self) -> dict:
        seen = [o.get for o in self.seen]
        return {k: sum(s[k] for s in seen) for k in seen[0]}

    def check(self) -> dict:
        got = self._counts()
        if found := [f"{rule} ({got[f'r{i}']} rows)" for i, rule in enumerate(self.rules) if got[f"r{i}"]]:
            raise ConstraintError(f"{self.name}: " + "; ".join(found))
        return {"rows": got["rows"]}

    def report(self, spark: SparkSession) -> DataFrame:
        got = self._counts()
        return spark.createDataFrame([(self.name, rule, got[f"r{i}"]) for i, rule in enumerate(self.rules)],
                                     "table_name string, rule string, violations long")


def require_unique(df: DataFrame, name: str) -> None:
    """Raise when a declared key of the table repeats: one group-by of the key's columns
    alone per key."""
    found = [f"unique ({r['key_columns']}) ({r['duplicated_keys']} values)"
             for r in declared_keys(df, name).collect() if r["duplicated_keys"]]
    if found:
        raise ConstraintError(f"{name}: " + "; ".join(found))


def require_constraints(df: DataFrame, name: str, keys: bool = True) -> None:
    """Raise when written rows break a declared rule or key of their table: one aggregate
    over the rows, and one group-by per key. Two small results reach the driver."""
    rules = table_rules(name)
    bad = [r for r in check_rows(df, rules, name).collect() if r["violations"]] if rules else []
    found = [f"{r['rule']} ({r['violations']} rows)" for r in bad]
    if keys and schemas.KEYS.get(name):
        found += [f"unique ({r['key_columns']}) ({r['duplicated_keys']} values)"
                  for r in declared_keys(df, name).collect() if r["duplicated_keys"]]
    if found:
        raise ConstraintError(f"{name}: " + "; ".join(found))
