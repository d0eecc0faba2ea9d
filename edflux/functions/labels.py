"""Text labels and the five-way class."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from edflux.constants import (
    CLASS_CHURN,
    CLASS_LOST_CLOSING,
    CLASS_LOST_OUTSIDE,
    CLASS_RETAINED,
    CLASS_RETAINED_OTHERS,
)


def item_completo(desc: Column, numero: Column) -> Column:
    """``"<desc> <number>"``; null if either part is null (``concat``, not ``concat_ws``)."""
    return F.concat(desc, F.lit(" "), numero.cast("string"))


def edition_tag(desc_corta: Column, numero: Column) -> Column:
    """Flow tag ``"<short desc> <number as integer>"``, null if either part is null."""
    return F.concat(desc_corta, F.lit(" "), numero.cast("bigint").cast("string"))


def sorteo_id(tipo: Column, numero: Column) -> Column:
    """``"<type>-<number>"``."""
    return F.concat(tipo.cast("string"), F.lit("-"), numero.cast("string"))


def canibalization_class(bought_last: Column, others_closing: Column, others_outside: Column) -> Column:
    others = others_closing + others_outside
    return (
        F.when(~bought_last & (others > 0) & (others_closing > 0), F.lit(CLASS_LOST_CLOSING))
        .when(~bought_last & (others > 0), F.lit(CLASS_LOST_OUTSIDE))
        .when(~bought_last, F.lit(CLASS_CHURN))
        .when(others > 0, F.lit(CLASS_RETAINED_OTHERS))
        .otherwise(F.lit(CLASS_RETAINED))
    )
