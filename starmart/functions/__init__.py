"""Column expressions built only from Spark SQL built-ins (JVM-side, codegen'd)."""

from starmart.functions.dates import (date_attributes, date_id, parse_timestamp,
                                      date_from_id)
from starmart.functions.money import line_value, shipment_value
from starmart.functions.text import PANDAS_NA_TOKENS, na_to_null, strip_unicode

__all__ = [
    "date_attributes", "date_id", "date_from_id", "parse_timestamp", "line_value",
    "shipment_value", "PANDAS_NA_TOKENS", "na_to_null", "strip_unicode",
]
