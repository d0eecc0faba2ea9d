"""The rollup pipelines: many windows per type, the recurrent filter, one window per type.

Plan shape (one lazy plan; the only actions are a checkpoint of the recent editions
and size checks on edition-sized tables):

    purchases --(broadcast recent editions)--> flagged purchases               (one scan)
      --(broadcast (bucket, window) rows + per-bucket own sentinel)--> one row per role
      --> runs of each ticket (window) --> edition level --(broadcast ends of editions)
      --> pair level: own prefix arrays and ``od`` (others) per (customer, type)
    rows = pairs JOIN broadcast(windows) on type     # narrow; output-sized data never shuffles
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edflux.constants import CLOSING_DAYS, LOOKBACK_DAYS, MIN_EDITIONS, WINDOW_DAYS
from edflux.functions.dates import minus_days, normalize_as_of
from edflux.functions.labels import canibalization_class
from edflux.operators import history, others, switching
from edflux.operators.prepare import (
    dedup_editions,
    editions_recent,
    purchases_enriched,
    purchases_flagged,
)
from edflux.operators.quality import JobCounters
from edflux.operators.windows import edition_windows, last_edition, window_spine
from edflux.plans.broadcast import DEFAULT_MAX_BROADCAST_ROWS
from edflux.plans.lineage import materialize_small, reliable_checkpoint
from edflux.schemas import ROLLUP_COLUMNS


@dataclass
class SwitchingCore:
    """Per-window own and other-product measures for flagged purchases and a windows table.

    ``windows`` has ``tipo_producto, ventana_numero, numero_sorteo_ultima,
    clave_edicion_producto_ultima, ultima_fecha_inicio, ultima_fecha_fin`` and must be
    edition-sized: it is broadcast after :attr:`span` checks its row count. ``roles``
    restricts the chain to the own measures (``"own"``) when the others are not needed.
    ``ends`` has ``clave_edicion_producto, fecha_fin`` of every edition, one row per key.
    """

    flagged: DataFrame
    windows: DataFrame
    ends: DataFrame
    closing_days: int = CLOSING_DAYS
    checkpoint: bool = False
    max_windows: int = DEFAULT_MAX_BROADCAST_ROWS
    roles: str = switching.BOTH
    max_bucket_rows: int = others.MAX_BUCKET_ROWS
    counters: JobCounters | None = None
    _span: others.WindowSpan | None = field(default=None, repr=False)

    @property
    def span(self) -> others.WindowSpan:
        if self._span is None:
            self._span = others.window_span(self.windows, self.max_bucket_rows)
        return self._span

    def with_windows(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` joined with the windows of their type.

        A broadcast join when the windows are within their row bound (always, in
        practice); beyond it a salted shuffle join, since a join on the product type alone
        would send every pair of a type to one task.
        """
        return window_spine(pairs, self.windows, small=self.span.n_windows <= self.max_windows)

    @cached_property
    def lookup(self) -> DataFrame:
        """(bucket, window) rows plus own sentinels, bounded by ``max_bucket_rows`` window-buckets."""
        bucketed = others.bucketed_windows(self.windows, self.span.width_days, self.closing_days)
        return switching.window_lookup(bucketed)

    @cached_property
    def role_rows(self) -> DataFrame:
        if self.roles == switching.OWN_ONLY:
            return switching.role_rows(self.flagged, None, None, self.roles)
        return switching.role_rows(self.flagged, self.lookup, self.span, self.roles)

    @cached_property
    def tickets(self) -> DataFrame:
        return switching.ticket_level(self.role_rows)

    @cached_property
    def editions(self) -> DataFrame:
        return switching.with_end(switching.edition_level(switching.ticket_runs(self.role_rows)), self.ends)

    @cached_property
    def own_tickets(self) -> DataFrame:
        """Ticket level of the own role: (customer, type, number, flag, ticket)."""
        return self.tickets.where(F.col("objetivo_ventana").isNull()).select(
            "clave_persona",
            "tipo_producto",
            "numero_sorteo",
            F.col("code").alias("flag"),
            "numero_boleto",
            "n_rows",
        )

    @cached_property
    def own_edition_stats(self) -> DataFrame:
        return switching.own_editions(self.editions)

    @cached_property
    def other_edition_stats(self) -> DataFrame:
        return switching.other_editions(self.editions)

    # ---- assembly
    @cached_property
    def pairs(self) -> DataFrame:
        """Per (customer, type) with purchases: own prefix arrays and others array ``od``."""
        pairs = switching.pair_level(self.editions)
        return reliable_checkpoint(self.counters.pairs(pairs) if self.counters else pairs, self.checkpoint)

    @cached_property
    def located(self) -> DataFrame:
        """Pairs with windows, and where each window stands in the pair's arrays (found once a row)."""
        places = history.own_positions(F.col("numero_sorteo_ultima")) | others.window_run(F.col("ventana_numero"))
        return self.with_windows(self.pairs).withColumns(places)

    @cached_property
    def rows(self) -> DataFrame:
        """One row per (pair, window of the pair's type) with typed measures and detail arrays."""
        spine = self.located
        own = history.own_columns()
        oth = others.other_columns(F.col("mine"), F.col("mine_json"))
        fin = F.col("ultima_fecha_fin")
        measures = spine.select(
            "ventana_numero",
            "clave_persona",
            "tipo_producto",
            "numero_sorteo_ultima",
            "clave_edicion_producto_ultima",
            F.col("ultima_fecha_inicio").cast("date").alias("ultima_fecha_inicio"),
            fin.cast("date").alias("ultima_fecha_fin"),
            minus_days(fin, self.closing_days).cast("date").alias("ultima_semana_cierre_ini"),
            fin.cast("date").alias("ultima_semana_cierre_fin"),
            *[c.alias(name) for name, c in own.items()],
            *[c.alias(name) for name, c in oth.items()],
        )
        return measures.withColumn(
            "canibalizacion_clase",
            canibalization_class(
                F.col("compro_ultima_edicion"),
                F.col("otros_boletos_en_semana_cierre_del_producto"),
                F.col("otros_boletos_fuera_semana_cierre_del_producto"),
            ),
        )

    @cached_property
    def rollup(self) -> DataFrame:
        """The 21 output columns, detail lists as JSON text."""
        return self.rows.select(*ROLLUP_COLUMNS)


@dataclass
class SwitchingAnalysis:
    """Multi-window rollup over typed purchases and editions at a fixed reference instant.

    ``counters`` collects the quality counters within the job that runs the rollup.
    """

    purchases: DataFrame
    editions: DataFrame
    as_of: datetime | str
    lookback_days: int = LOOKBACK_DAYS
    window_days: int = WINDOW_DAYS
    closing_days: int = CLOSING_DAYS
    strict: bool = False
    checkpoint: bool = False
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS
    prune_scan: bool = True
    max_bucket_rows: int = others.MAX_BUCKET_ROWS
    counters: JobCounters | None = None

    def __post_init__(self) -> None:
        self.as_of = normalize_as_of(self.as_of)

    @cached_property
    def recent(self) -> DataFrame:
        # Edition-sized and used by the enrichment, the windows and the size checks:
        # materialised once rather than recomputed per use.
        return materialize_small(editions_recent(self.editions, self.as_of, self.lookback_days))

    @cached_property
    def enriched(self) -> DataFrame:
        if self.counters:
            return purchases_enriched(self.counters.purchases(self.purchases), self.recent, watch=self.counters.matched)
        return purchases_enriched(self.purchases, self.recent, prune_scan=self.prune_scan)

    @cached_property
    def flagged(self) -> DataFrame:
        flagged = purchases_flagged(self.enriched, self.closing_days)
        return self.counters.flagged(flagged) if self.counters else flagged

    @cached_property
    def windows(self) -> DataFrame:
        # Edition-sized; its row bound is checked by SwitchingCore.span before any broadcast.
        # Derived from the materialised recent editions: recomputing it is a few tiny stages.
        return edition_windows(self.recent, self.as_of, self.window_days, self.strict)

    @cached_property
    def core(self) -> SwitchingCore:
        return SwitchingCore(
            self.flagged,
            self.windows,
            self.recent,
            self.closing_days,
            self.checkpoint,
            self.max_broadcast_rows,
            max_bucket_rows=self.max_bucket_rows,
            counters=self.counters,
        )

    @property
    def rollup(self) -> DataFrame:
        return self.core.rollup


def rollup(
    purchases: DataFrame,
    editions: DataFrame,
    as_of: datetime | str,
    lookback_days: int = LOOKBACK_DAYS,
    window_days: int = WINDOW_DAYS,
    closing_days: int = CLOSING_DAYS,
    strict: bool = False,
    checkpoint: bool = False,
) -> DataFrame:
    """One row per (customer, product type, window) with the switching measures and class."""
    return SwitchingAnalysis(
        purchases, editions, as_of, lookback_days, window_days, closing_days, strict, checkpoint
    ).rollup


def recurrent(rollup_df: DataFrame, min_editions: int = MIN_EDITIONS) -> DataFrame:
    """Keep rows whose customer bought at least ``min_editions`` earlier editions of the type."""
    return rollup_df.where(F.col("hist_ediciones_distintas") >= F.lit(min_editions))


@dataclass
class SingleWindowAnalysis:
    """One row per (customer, type) against the type's latest edition (no date limits)."""

    purchases: DataFrame
    editions: DataFrame
    closing_days: int = CLOSING_DAYS
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS

    @cached_property
    def last(self) -> DataFrame:
        return materialize_small(last_edition(self.editions))

    @cached_property
    def windows(self) -> DataFrame:
        return self.last.select(
            "tipo_producto",
            F.lit(0).alias("ventana_numero"),
            "numero_sorteo_ultima",
            "clave_edicion_producto_ultima",
            "ultima_fecha_inicio",
            "ultima_fecha_fin",
        )

    @cached_property
    def known(self) -> DataFrame:
        return dedup_editions(self.editions)

    @cached_property
    def flagged(self) -> DataFrame:
        return purchases_flagged(purchases_enriched(self.purchases, self.known), self.closing_days)

    @cached_property
    def core(self) -> SwitchingCore:
        return SwitchingCore(
            self.flagged, self.windows, self.known, self.closing_days, max_windows=self.max_broadcast_rows
        )

    @property
    def rollup(self) -> DataFrame:
        cols = [c for c in self.core.rollup.columns if c != "ventana_numero"]
        return self.core.rollup.select(
            *[F.col(c).cast("double").alias(c) if c == "tipo_producto" else F.col(c) for c in cols]
        )


def rollup_single_window(
    purchases: DataFrame, editions: DataFrame, closing_days: int = CLOSING_DAYS
) -> DataFrame:
    """Single-window variant: history is every edition below the type's latest number.

    The type column is a double, as in the variant's output.
    """
    return SingleWindowAnalysis(purchases, editions, closing_days).rollup
