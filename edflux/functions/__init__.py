"""Column expressions (all JVM-side, no Python UDF)."""

from edflux.functions.casts import lenient_int, lenient_long, strict_long
from edflux.functions.dates import (
    as_timestamp_ntz,
    day_text,
    minus_days,
    parse_purchase_time,
    parse_strict_timestamp,
)
from edflux.functions.labels import canibalization_class, edition_tag, item_completo, sorteo_id
from edflux.functions.tickets import ticket_count

__all__ = [
    "as_timestamp_ntz",
    "canibalization_class",
    "day_text",
    "edition_tag",
    "item_completo",
    "lenient_int",
    "lenient_long",
    "minus_days",
    "parse_purchase_time",
    "parse_strict_timestamp",
    "sorteo_id",
    "strict_long",
    "ticket_count",
]
