"""A large frame worked through in slices, one after the other.

What an exchange writes stays on disk until its query has ended, and rows cost several
times more there than in a stored table (in columns, compressed). A step whose rows do not
depend on each other beyond a slice runs once a slice instead: every row is in one slice,
equal rows are in the same one, and only one slice's exchanges are on disk at a time. Each
slice scans the stored table again, so a step has a few slices only, and a table below
``SLICE_BYTES`` has one: the step then runs as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 32 * 1024 * 1024      # stored bytes that are worth a slice


def stored_bytes(df: DataFrame) -> int:
    """The size Spark's planner gives a scan: its files', by the columns read."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def number(df: DataFrame, most: int) -> int:
    """How many slices a stored table is worth."""
    return max(1, min(most, stored_bytes(df) // SLICE_BYTES))


def split(df: DataFrame, n: int, columns: list[str] | None = None) -> list[DataFrame]:
    """The slices of ``df`` that hold rows, by a hash of ``columns`` (all): ``n`` at most.
    Without any rows the one slice is the frame itself."""
    if n <= 1:
        return [df]
    of = F.pmod(F.xxhash64(*(columns or df.columns)), F.lit(n))
    # an empty one would leave its observed counts without an answer
    return [s for s in (df.where(of == i) for i in range(n)) if not s.isEmpty()] or [df]
