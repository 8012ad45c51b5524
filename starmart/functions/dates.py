"""Date and timestamp expressions (P6, P7, the date-dimension attributes)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted invoice date layouts tried after the ISO cast (the US layout of
# the retail CSV, then ISO without seconds).
DEFAULT_FORMATS = [
    "M/d/yyyy H:mm",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy",
    "M/d/yy H:mm",
    "yyyy-MM-dd HH:mm",
]

_EPOCH = "1970-01-01 00:00:00"


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def parse_timestamp(col: Column | str, formats: list[str] | None = None,
                    strict: bool = True, label: str = "invoice_date") -> Column:
    """Parse a string into ``timestamp_ntz`` (P6): ISO text through a plain cast, anything
    else through each layout in turn (``coalesce`` stops at the first hit).

    With ``strict`` a value that is null or matches no layout fails the job from inside
    the expression (``raise_error``), as the reference aborts on an unparsable date; no
    extra job is needed for the check. The trailing epoch literal can never be reached;
    it marks the column as never null, so the optimizer infers no ``isnotnull`` filters
    that would be pushed below the dedup and copy this expression into the scan.
    """
    c = _c(col)
    fmts = DEFAULT_FORMATS if formats is None else formats
    tries = [c.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in fmts]
    parsed = F.coalesce(*tries)
    if not strict:
        return parsed
    msg = F.concat(F.lit(f"unparsable {label}: "), F.coalesce(c, F.lit("NULL")))
    checked = F.coalesce(parsed, F.raise_error(msg).cast("timestamp_ntz"))
    return F.coalesce(checked, F.expr(f"TIMESTAMP_NTZ '{_EPOCH}'"))


def date_id(col: Column | str) -> Column:
    """``YYYYMMDD`` integer key of a date or timestamp."""
    c = _c(col)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def date_from_id(col: Column | str) -> Column:
    """Inverse of :func:`date_id`."""
    c = _c(col)
    return F.make_date((c / 10000).cast("int"), ((c / 100).cast("int") % 100), c % 100)


def date_attributes(d: Column | str) -> dict[str, Column]:
    """The ten date-dimension columns for a ``date`` column, in table order.

    Week is the ISO week (1 Jan can fall in week 52/53 of the previous ISO year while
    ``year`` stays the calendar year); day_of_week is Monday = 1.
    """
    c = _c(d)
    return {
        "date_id": date_id(c),
        "full_date": c,
        "year": F.year(c),
        "quarter": F.quarter(c),
        "month": F.month(c),
        "month_name": F.date_format(c, "MMMM"),
        "week": F.weekofyear(c),
        "day_of_week": (F.weekday(c) + 1).cast("int"),
        "day_name": F.date_format(c, "EEEE"),
        "is_weekend": F.weekday(c) >= 5,
    }
