"""Ticket counting rule, expressed on pre-aggregated counts.

For any subset of purchase rows: the number of distinct non-null ticket numbers if
there is at least one, else the number of rows; an empty subset counts 0. The rule is
decided per subset, so callers pass the distinct count and the row count *of the same
subset*.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ticket_count(distinct_tickets: Column, rows: Column) -> Column:
    d = F.coalesce(distinct_tickets, F.lit(0).cast("bigint"))
    return F.when(d > 0, d).otherwise(F.coalesce(rows, F.lit(0).cast("bigint"))).cast("bigint")
