"""Casts of columns that may arrive as text, and what text stands for a missing value."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Text that readers of extracts take for a missing value, besides blank text.
NULL_TOKENS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def token_to_null(c: Column) -> Column:
    """Text as it is, but null for the empty text and for :data:`NULL_TOKENS`."""
    return F.when(~c.isin("", *NULL_TOKENS), c)


def blank_to_null(c: Column) -> Column:
    """Text without spaces around it; null if nothing is left or it is one of :data:`NULL_TOKENS`."""
    return token_to_null(F.trim(c.cast("string")))


def strict_long(c: Column) -> Column:
    """Integer text to bigint; under ANSI any other text (``"1.0"``, ``"x"``) fails the job."""
    return blank_to_null(c).cast("bigint")


SHORT = 20  # fewer characters than this hold no 19 digits behind a point, which a decimal would round


def _short_number(c: Column, kind: str) -> Column:
    """Short plain numbers (``"123"``, ``"-1.7"``), truncated toward zero; else null. Makes no decimal and raises nothing."""
    text = c.cast("string")
    return F.when((F.length(text) < SHORT) & text.rlike(r"\A[+-]?[0-9]+([.][0-9]*)?\z"), F.substring_index(text, ".", 1).try_cast(kind))


def lenient_int(c: Column) -> Column:
    """Text or number to int, truncating toward zero; blank or null stays null.

    ``"123.0"`` gives 123, ``"-1.7"`` gives -1. Unparseable text still fails (ANSI). Other than short plain
    numbers go through a decimal, so every integer of 64 bits keeps its digits.
    """
    return F.coalesce(_short_number(c, "int"), blank_to_null(c).cast("decimal(38,18)").cast("int"))


def lenient_long(c: Column) -> Column:
    """As :func:`lenient_int` with a bigint result (keys and ticket numbers)."""
    return F.coalesce(_short_number(c, "bigint"), blank_to_null(c).cast("decimal(38,18)").cast("bigint"))


_BOUND = {"int": Decimal(2**31), "bigint": Decimal(2**63)}


def number_problem(c: Column, kind: str, whole: bool = False) -> Column:
    """Why text can't be read as ``kind`` (int or bigint), or null; ``whole``: no fraction is allowed.

    A cast that fails raises and catches an error for each row, so bounds are compared and words
    without a digit are never cast.
    """
    text = blank_to_null(c)
    number = text.try_cast("decimal(38,18)")
    digits = text.rlike(r"^[+-]?[0-9]+([.][0-9]*)?$")
    plain = _short_number(c, kind).isNotNull()
    within = (number < F.lit(_BOUND[kind])) & (number > F.lit(-_BOUND[kind] - 1))
    why = F.when(text.isNull(), F.lit(None)).when(~text.rlike("[0-9]") | (number.isNull() & ~digits), "not a number")
    if whole:
        plain = plain & ~c.contains(".")
        why = why.when(text.try_cast("decimal(38,0)").isNotNull() & text.contains("."), "not a whole number")
    return F.when(plain, F.lit(None)).otherwise(why.when(~F.coalesce(within, F.lit(False)), "out of range"))
