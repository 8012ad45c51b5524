"""Mixing sources to target weights (operator 1): iterative proportional fitting.

Documents fall into cells of source, language and topic. Token weights of the cells are
raked: factor by factor they are scaled to each marginal's targets, round after round.
Documents are then drawn independently with probability min(1, c * weight of their cell),
c chosen so that the expected sample holds ``budget`` of all tokens; a document that hits
probability 1 carries the rest of its weight in ``sample_weight``.

Targets are shares by value, or an exponent: targets proportional to the observed share
to that power. Every value takes part, however small and however many there are. One
aggregate over the documents gives the cells, one pass draws. Rounds go on until every
marginal is within ``TOLERANCE`` of its target, or the largest error has not fallen by a
hundredth for ``STALL`` rounds (further rounds would only drive weights to 0), ``ROUNDS``
at most. Targets that cells cannot meet together (opposed, or of sources that are each one
language) so leave an error, which is returned with every row (marginal_error, the largest
relative one) and can be made to raise (``strict``). Up to ``MAX_VALUES`` ** 2
cells are raked on the driver and broadcast; more stay a table that is raked by grouped
sums and joins: the weight of a cell is the product of a factor for each of its values,
and a step computes one marginal's factors anew.

Everything is DataFrame functions. Defined results: a null source, language or text is
the value ``(none)`` or the empty text; an empty text weighs 0 tokens and is drawn like
its cell; a value without a target gets none of the weight (probability 0); a target of a
value that no document has is dropped and the others fill it; equal ids draw alike, and a
null id draws by its text. Long texts are counted whole. An empty table gives an empty
result. Clashing extra columns
are kept as they are: the operator's own live under the names it returns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.components import stored

MAX_VALUES = 200               # the driver rakes at most the square of it in cells
ROUNDS, STALL = 200, 12
TOLERANCE = 1e-14              # of every marginal, relative; nearly all that doubles allow
TABLE_TOLERANCE = 1e-9         # where cells are raked in Spark, by three jobs a round
BUDGET = 0.5
#: Production targets: tempered sources and languages, topics as they are.
TARGETS = {"source": 0.5, "lang": 0.7, "topic": 1.0}
MARGINS = ("source", "lang", "topic")


def tokens_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))


def topic_of(text: Column, tokens: Column) -> Column:
    """A register as topic: tables, texts with figures, short notes, prose."""
    t = F.coalesce(text, F.lit(""))
    return (F.when(F.instr(t, " | ") > 0, "table").when(t.rlike("[0-9]"), "figures")
            .when(tokens < 100, "note").otherwise("prose"))


def with_cells(docs: DataFrame) -> DataFrame:
    """The documents with mix_source, mix_lang, mix_topic and mix_tokens."""
    none = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("(none)"))
    d = docs.withColumn("mix_tokens", tokens_of(F.col("text")).cast("long"))
    return d.withColumns({"mix_source": none("source"), "mix_lang": none("lang"), "mix_topic": topic_of(F.col("text"), F.col("mix_tokens"))})


def goals(table: dict, target, axis: int) -> dict:
    """Target tokens of each value of one marginal; they sum to the observed total."""
    seen: dict = {}
    for cell, t in sorted(table.items()):
        seen[cell[axis]] = seen.get(cell[axis], 0) + t
    total = sum(seen.values())
    if isinstance(target, dict):
        raw = {v: float(target.get(v, 0.0)) if t else 0.0 for v, t in seen.items()}
    else:
        raw = {v: (t / total) ** target if t else 0.0 for v, t in seen.items()}
    scale = sum(raw.values())
    return {v: total * r / scale if scale else 0.0 for v, r in raw.items()}


class RakingError(ValueError):
    """The targets cannot be met together."""


def marginal_error(now: dict, want: dict) -> float:
    """The largest relative error of a marginal's values."""
    return max((abs(now.get(v, 0.0) - goal) / goal if goal else now.get(v, 0.0) for v, goal in want.items()), default=0.0)


def stalled(errors: list[float]) -> bool:
    """Whether the rounds' errors have stopped falling."""
    return len(errors) > STALL and min(errors[-STALL:]) > 0.99 * min(errors[:-STALL])


def rake(table: dict, targets: dict, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> tuple[dict, float]:
    """(weight of each cell, largest relative error of a marginal after the last round)."""
    weight = dict.fromkeys(table, 1.0)
    want = [goals(table, targets[m], i) for i, m in enumerate(MARGINS)]
    cells = sorted(table)

    def sums(axis):
        now = dict.fromkeys(want[axis], 0.0)
        for cell in cells:
            now[cell[axis]] += table[cell] * weight[cell]
        return now

    errors = [float("inf")]
    for _ in range(rounds):
        for axis in range(len(MARGINS)):
            now = sums(axis)
            for cell in table:
                n = now[cell[axis]]
                weight[cell] = weight[cell] * want[axis][cell[axis]] / n if n else 0.0
        errors.append(max(marginal_error(sums(axis), want[axis]) for axis in range(len(MARGINS))))
        if errors[-1] <= tolerance or stalled(errors):
            break
    return weight, errors[-1]


def draw_rate(table: dict, weight: dict, budget: float) -> float:
    """c with sum(tokens * min(1, c * weight)) = budget * tokens: cells are capped from the
    heaviest on until the next one stays at or under 1. Infinite if all must be taken."""
    order = sorted((c for c in table if weight[c] > 0), key=lambda c: (-weight[c], c))
    left, rest = budget * sum(table.values()), sum(table[c] * weight[c] for c in order)
    for c in order:
        if rest <= 0 or left <= 0:
            break
        if left / rest * weight[c] <= 1:
            return left / rest
        left -= table[c]
        rest -= table[c] * weight[c]
    return float("inf") if left > 0 else 0.0


def rake_cells(cells: DataFrame, targets: dict, rounds: int = ROUNDS, tolerance: float = TABLE_TOLERANCE) -> tuple[DataFrame, float]:
    """(the stored cells with their weight, the error): ``rake`` for any number of cells.
    The error of a round is that of the marginals before they are scaled in it; the last
    one scaled is met, so the error is known without a pass of its own."""
    total = cells.agg(F.sum("mix_tokens")).first()[0]
    want, factor = [], []
    for m in MARGINS:
        v, t = f"mix_{m}", F.col("t")
        seen = cells.groupBy(v).agg(F.sum("mix_tokens").alias("t"))
        if isinstance(targets[m], dict):
            given = cells.sparkSession.createDataFrame([(k, float(x)) for k, x in targets[m].items()], f"{v} string, raw double")
            seen = seen.join(given, v, "left").withColumn("raw", F.when(t > 0, F.coalesce("raw", F.lit(0.0))).otherwise(0.0))
        else:
            seen = seen.withColumn("raw", F.when(t > 0, F.pow(t / F.lit(float(total)), F.lit(float(targets[m])))).otherwise(0.0))
        seen = stored(seen, "mix-goals")
        scale = seen.agg(F.sum("raw")).first()[0]
        want.append(seen.select(v, (F.col("raw") * F.lit(total / scale if scale else 0.0)).alias("goal")))
        factor.append(seen.select(v, F.lit(1.0).alias(f"f_{m}")))
    errors = [float("inf")]
    for k in range(rounds + 1):
        off = []
        for axis, m in enumerate(MARGINS):
            now, n = cells, F.col("mix_tokens")
            for i, o in enumerate(MARGINS):
                if i != axis:
                    now, n = now.join(factor[i], f"mix_{o}"), n * F.col(f"f_{o}")
            now = want[axis].join(now.groupBy(f"mix_{m}").agg(F.sum(n).alias("n")), f"mix_{m}").join(factor[axis], f"mix_{m}")
            got, new = F.col("n") * F.col(f"f_{m}"), F.when(F.col("n") > 0, F.col("goal") / F.col("n")).otherwise(0.0)
            now = stored(now.select(f"mix_{m}", new.alias("new"), F.when(F.col("goal") > 0, F.abs(got - F.col("goal")) / F.col("goal"))
                                    .otherwise(got).alias("off")), "mix-factors")
            off.append(now.agg(F.coalesce(F.max("off"), F.lit(0.0))).first()[0])
            if k < rounds:
                factor[axis] = now.select(f"mix_{m}", F.col("new").alias(f"f_{m}"))
        errors.append(max(off))
        if errors[-1] <= tolerance or stalled(errors):
            break
    for m, f in zip(MARGINS, factor):
        cells = cells.join(f, f"mix_{m}")
    weight = F.col("f_source") * F.col("f_lang") * F.col("f_topic")
    return stored(cells.select(*[f"mix_{m}" for m in MARGINS], "mix_tokens", weight.alias("w")), "mix-weights"), errors[-1]


def draw_rate_cells(weights: DataFrame, budget: float) -> float:
    """``draw_rate`` of a table of weights: cells whose probability passes 1 are capped and
    what they leave is dealt to the others, until no further cell is capped."""
    t, w = F.col("mix_tokens"), F.col("w")
    total, capped, c = weights.agg(F.sum("mix_tokens")).first()[0], -1, 0.0
    while True:
        over = w * F.lit(c) > 1
        n, full, rest = weights.where("w > 0").agg(
            F.count_if(over), F.coalesce(F.sum(F.when(over, t)), F.lit(0)), F.coalesce(F.sum(F.when(~over, t * w)), F.lit(0.0))).first()
        left = budget * total - full
        if n == capped:
            return c
        if budget <= 0 or rest <= 0:
            return float("inf") if budget > 0 else 0.0
        capped, c = n, max(c, left / rest)


def shares_of(cells: DataFrame, targets: dict, budget: float, rounds: int, most: int, strict: bool = False) -> DataFrame:
    """Weight, probability, sample weight and marginal_error of every cell (p0, p1, p2)."""
    spark = cells.sparkSession

    def checked(error: float) -> float:
        if strict and error > 1e-6:
            raise RakingError(f"after {rounds} rounds a marginal is off by {error:.2%}: the targets cannot be met together")
        return error

    if cells.count() <= most:
        table = {(r[0], r[1], r[2]): int(r[3]) for r in cells.collect()}
        weight, error = rake(table, targets, rounds)
        checked(error)
        c = draw_rate(table, weight, budget)
        rows = [(*cell, w, p := (min(1.0, c * w) if w else 0.0), (c * w / p if 0 < p < 1 or p == 1 and c < float("inf") else float(p > 0)), float(error))
                for cell, w in sorted(weight.items())]
        return F.broadcast(spark.createDataFrame(rows, "p0 string, p1 string, p2 string, token_weight double, probability double, sample_weight double, marginal_error double"))
    weights, error = rake_cells(cells, targets, rounds)
    checked(error)
    c = draw_rate_cells(weights, budget)
    w, p = F.col("token_weight"), F.col("probability")
    rate = F.when(p == 0, 0.0).otherwise(F.lit(1.0) if c == float("inf") else F.lit(c) * w / p)
    return (weights.select(*[F.col(f"mix_{m}").alias(f"p{i}") for i, m in enumerate(MARGINS)], F.col("w").alias("token_weight"))
            .withColumn("probability", F.when(w > 0, F.least(F.lit(1.0), F.lit(c) * w)).otherwise(0.0)).withColumn("sample_weight", rate)
            .withColumn("marginal_error", F.lit(float(error))))


def uniform(doc_id: Column, text: Column) -> Column:
    """A number in 0..1 fixed by the id (by the text where the id is null)."""
    key = F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), key).cast("binary")), 1, 12), 16, 10).cast("double") / float(16**12)


def mix(docs: DataFrame, targets: dict | None = None, budget: float = BUDGET, rounds: int = ROUNDS,
        max_values: int = MAX_VALUES, strict: bool = False) -> DataFrame:
    """The documents with mix_source, mix_lang, mix_topic, mix_tokens, token_weight,
    probability, sample_weight, marginal_error and sampled (columns of these names are
    replaced)."""
    targets = targets or TARGETS
    named = with_cells(docs)
    cells = stored(named.groupBy(*[f"mix_{m}" for m in MARGINS]).agg(F.sum("mix_tokens").alias("mix_tokens")), "mix-cells")
    shares = shares_of(cells, targets, budget, rounds, max_values**2, strict)
    d = named.drop("token_weight", "probability", "sample_weight", "marginal_error", "sampled")
    on = [d[f"mix_{m}"] == shares[f"p{i}"] for i, m in enumerate(MARGINS)]
    own = [d[c] for c in d.columns]
    return (d.join(shares, on, "left")
            .select(*own, *[shares[c] for c in ("token_weight", "probability", "sample_weight", "marginal_error")])
            .withColumn("sampled", uniform(F.col("doc_id"), F.col("text")) < F.col("probability")))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The drawn documents with their own columns only, whatever their names."""
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), "doc_id", "text", "lang", "source")
    return mix(row, **options).where("sampled").select("row.*")
