"""Data-quality counters: as a long (metric, value) table, or observed during the main job."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from edflux.constants import CLOSING_DAYS
from edflux.functions.dates import minus_days
from edflux.plans.broadcast import bounded_broadcast


def _metrics(df: DataFrame, **named: Column) -> DataFrame:
    """One aggregate pass over ``df`` returning (metric, value) rows."""
    row = df.agg(*[c.cast("bigint").alias(k) for k, c in named.items()])
    stack = ", ".join(f"'{k}', `{k}`" for k in named)
    return row.selectExpr(f"stack({len(named)}, {stack}) AS (metric, value)")


def quality_counters(
    purchases: DataFrame,
    editions: DataFrame,
    recent: DataFrame,
    windows: DataFrame,
    closing_days: int = CLOSING_DAYS,
) -> DataFrame:
    """Counters the pipeline logs: rows per stage, null dates, duplicates, flag totals, groups.

    One pass over the purchases (left join to the broadcast recent editions, every
    counter -- including the distinct (customer, type) groups -- in one aggregate), one
    over the edition table; the one-row results are stacked with ``unionByName``.
    ``recent`` must hold one row per key (as ``editions_recent`` returns it).
    """
    dim = bounded_broadcast(
        recent.select(
            "clave_edicion_producto", "tipo_producto", "numero_sorteo", "fecha_inicio", "fecha_fin",
            F.lit(True).alias("_recent"),
        )
    )
    j = purchases.join(dim, "clave_edicion_producto", "left")
    t = F.col("fecha_rotulacion_finalizacion")
    matched = F.col("_recent").isNotNull()
    valid = matched & t.isNotNull() & F.col("tipo_producto").isNotNull() & F.col("numero_sorteo").isNotNull()
    sci = minus_days(F.col("fecha_fin"), closing_days)
    closing = valid & (t >= sci) & (t <= F.col("fecha_fin"))
    pre = valid & (t >= F.col("fecha_inicio")) & (t < sci)
    person = F.col("clave_persona").isNotNull()
    facts = _metrics(
        j,
        compras=F.count(F.lit(1)),
        compras_sin_fecha=F.count_if(t.isNull()),
        compras_sin_persona=F.count_if(~person),
        compras_recientes=F.count_if(matched),
        compras_validas=F.count_if(valid),
        en_semana_cierre=F.count_if(F.coalesce(closing, F.lit(False))),
        en_pre_cierre=F.count_if(F.coalesce(pre, F.lit(False))),
        grupos_persona_producto=F.count_distinct(
            F.when(valid & person, F.struct("clave_persona", "tipo_producto"))
        ),
    )
    return _stack([facts, *_edition_counters(editions, recent, windows)])


def _edition_counters(editions: DataFrame, recent: DataFrame, windows: DataFrame) -> list[DataFrame]:
    dims = _metrics(
        editions,
        sorteos=F.count(F.lit(1)),
        sorteos_sin_fecha_fin=F.count_if(F.col("fecha_fin").isNull()),
        sorteos_sin_fecha_inicio=F.count_if(F.col("fecha_inicio").isNull()),
        sorteos_sin_fecha_celebracion=F.count_if(F.col("fecha_celebracion").isNull()),
        sorteos_clave_duplicada=F.count(F.lit(1)) - F.count_distinct("clave_edicion_producto"),
    )
    return [dims, _metrics(recent, sorteos_recientes=F.count(F.lit(1))), _metrics(windows, ventanas=F.count(F.lit(1)))]


def _stack(parts: list[DataFrame]) -> DataFrame:
    out = reduce(DataFrame.unionByName, parts)
    return out.select("metric", F.coalesce(F.col("value"), F.lit(0).cast("bigint")).alias("value"))


ROLLUP_DATES = ["ultima_fecha_inicio", "ultima_fecha_fin", "ultima_semana_cierre_ini", "ultima_semana_cierre_fin"]


def rollup_date_nulls(rollup: DataFrame) -> DataFrame:
    """Rows of the rollup and, per date column, how many are null (one aggregate pass)."""
    return _metrics(
        rollup,
        filas=F.count(F.lit(1)),
        **{f"nulos_{c}": F.count_if(F.col(c).isNull()) for c in ROLLUP_DATES},
    )


def observe_flags(flagged: DataFrame, name: str = "flags") -> tuple[DataFrame, Observation]:
    """Attach flag totals to ``flagged``; they are filled by whichever action runs the plan,
    without an extra pass over the data."""
    obs = Observation(name)
    observed = flagged.observe(
        obs,
        F.count(F.lit(1)).alias("compras_validas"),
        F.count_if(F.col("en_semana_cierre")).alias("en_semana_cierre"),
        F.count_if(F.col("en_pre_cierre")).alias("en_pre_cierre"),
    )
    return observed, obs


class JobCounters:
    """The purchase counters of :func:`quality_counters`, gathered while the rollup's own job runs.

    Give one to :class:`edflux.plans.rollup.SwitchingAnalysis`, run its rollup once, then ask for
    :meth:`table`: no further pass over the purchases is made. Counting all purchases means
    reading all of them, so the run-time pruning of the fact scan is off. Tasks that are run
    again because an executor was lost count their rows again; ``quality_counters`` is exact then too.
    """

    def __init__(self) -> None:
        self._seen: list[Observation] = []

    def _watch(self, df: DataFrame, **named: Column) -> DataFrame:
        self._seen.append(Observation())
        return df.observe(self._seen[-1], *(c.alias(k) for k, c in named.items()))

    def purchases(self, df: DataFrame) -> DataFrame:
        rows, without = F.count(F.lit(1)), {"fecha": "fecha_rotulacion_finalizacion", "persona": "clave_persona"}
        return self._watch(df, compras=rows, **{f"compras_sin_{k}": F.count_if(F.col(c).isNull()) for k, c in without.items()})

    def matched(self, df: DataFrame) -> DataFrame:
        return self._watch(df, compras_recientes=F.count(F.lit(1)))

    def flagged(self, df: DataFrame) -> DataFrame:
        flags = {c: F.count_if(F.col(c)) for c in ("en_semana_cierre", "en_pre_cierre")}
        return self._watch(df, compras_validas=F.count(F.lit(1)), **flags)

    def pairs(self, df: DataFrame) -> DataFrame:
        return self._watch(df, grupos_persona_producto=F.count_if(F.col("clave_persona").isNotNull()))

    def table(self, purchases: DataFrame, editions: DataFrame, recent: DataFrame, windows: DataFrame) -> DataFrame:
        """(metric, value) rows, as :func:`quality_counters`, after the job has run.

        Where the optimiser left out a counted step (no recent edition: no purchase is read), the
        counters come from their own pass.
        """
        try:
            got = [o.get for o in self._seen]
        except Py4JJavaError:  # pyspark cannot turn the metrics of a step that was left out into a row
            got = []
        if len(got) < 4 or not all(got):
            return quality_counters(purchases, editions, recent, windows)
        rows = [(k, int(v)) for part in got for k, v in part.items()]
        facts = purchases.sparkSession.createDataFrame(rows, "metric string, value bigint")
        return _stack([facts, *_edition_counters(editions, recent, windows)])
