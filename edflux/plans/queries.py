"""Named queries over the driver's tables (fixture mapping), one per inventory operator.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame whose column names
and types match the DuckDB oracle in ``duck_oracle/duckdb_sql.py``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edflux.functions.dates import parse_day, parse_purchase_time
from edflux.operators import history, others
from edflux.operators.switching import OWN_ONLY
from edflux.operators.flow import migration_flow
from edflux.operators.prepare import clean_editions, clean_purchases, dedup_editions, edition_labels, purchases_recent
from edflux.operators.quality import quality_counters, rollup_date_nulls
from edflux.operators.rejects import tolerant_purchases
from edflux.operators.windows import last_edition
from edflux.plans.rollup import SingleWindowAnalysis, SwitchingAnalysis, SwitchingCore, recurrent
from edflux.functions.tickets import ticket_count
from edflux.constants import FLAG_CLOSING, FLAG_PRE
from edflux.sources.fixtures import (
    FIXTURE_AS_OF,
    fixture_day_text,
    fixture_editions,
    fixture_editions_text,
    fixture_purchase_time_text,
    fixture_purchases,
    fixture_purchases_dirty,
    fixture_purchases_text,
    irregular_editions,
    irregular_purchases,
)

from edflux.session import ensure_checkpoint_dir
from edflux.sources.io import read_editions, read_purchases, read_rollup, read_snapshot, write
from edflux.sources.publish import stored_for_now, write_snapshot

SPINE_KEYS = ["clave_persona", "tipo_producto", "ventana_numero"]


def _analysis(spark: SparkSession, sf_dir: str) -> SwitchingAnalysis:
    return SwitchingAnalysis(fixture_purchases(spark, sf_dir), fixture_editions(spark, sf_dir), FIXTURE_AS_OF)


def q_editions_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _analysis(spark, sf_dir).recent


def q_purchases_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _analysis(spark, sf_dir)
    return purchases_recent(a.purchases, a.recent)


def q_purchases_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _analysis(spark, sf_dir).enriched.select(
        "clave_detalle_compra",
        "clave_persona",
        "clave_edicion_producto",
        "fecha_rotulacion_finalizacion",
        "numero_boleto",
        "tipo_producto",
        "numero_sorteo",
        "desc_sorteo",
        "fecha_inicio",
        "fecha_fin",
    )


def q_purchases_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _analysis(spark, sf_dir).flagged.select(
        "clave_detalle_compra",
        "clave_persona",
        "clave_edicion_producto",
        "tipo_producto",
        "numero_sorteo",
        "fecha_rotulacion_finalizacion",
        "semana_cierre_ini",
        "en_semana_cierre",
        "en_pre_cierre",
    )


def q_purchase_dates_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixture_purchase_time_text(spark, sf_dir)
    return raw.select("event_id", "t", parse_purchase_time(F.col("t")).alias("fecha_rotulacion_finalizacion"))


def q_edition_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edition_labels(_analysis(spark, sf_dir).recent)


def q_ticket_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _analysis(spark, sf_dir)
    tickets = SwitchingCore(a.flagged, a.windows, a.recent, a.closing_days, roles=OWN_ONLY).own_tickets
    flag = F.col("flag")
    return (
        tickets.groupBy("clave_persona", "tipo_producto", "numero_sorteo", "flag")
        .agg(F.count("numero_boleto").alias("d"), F.sum("n_rows").alias("r"))
        .select(
            "clave_persona",
            "tipo_producto",
            "numero_sorteo",
            F.when(flag == FLAG_CLOSING, F.lit("semana_cierre"))
            .when(flag == FLAG_PRE, F.lit("pre_cierre"))
            .otherwise(F.lit("fuera"))
            .alias("flag"),
            ticket_count(F.col("d"), F.col("r")).alias("boletos"),
        )
    )


def q_edition_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _analysis(spark, sf_dir).windows


def _pairs(a: SwitchingAnalysis) -> DataFrame:
    return (
        a.flagged.where(F.col("clave_persona").isNotNull())
        .select("clave_persona", "tipo_producto")
        .distinct()
    )


def q_window_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _analysis(spark, sf_dir)
    return a.core.with_windows(_pairs(a)).select(
        *SPINE_KEYS, "numero_sorteo_ultima", "clave_edicion_producto_ultima"
    )


def _own_rows(a: SwitchingAnalysis) -> DataFrame:
    """Own measures through the chain restricted to the own role (no lookup join)."""
    core = SwitchingCore(a.flagged, a.windows, a.recent, a.closing_days, roles=OWN_ONLY)
    own = history.own_columns()
    return core.located.select(*SPINE_KEYS, *[c.alias(k) for k, c in own.items()])


def q_own_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own-history measures only (no other-product branch)."""
    return _own_rows(_analysis(spark, sf_dir)).drop("hist_detalle_por_edicion_json")


def q_history_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _own_rows(_analysis(spark, sf_dir))
    return rows.select(*SPINE_KEYS, "hist_detalle_por_edicion_json")


def q_other_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other-product measures only, for every spine row (zero when nothing was bought)."""
    core = _analysis(spark, sf_dir).core
    oth = others.other_columns(F.col("mine"), F.col("mine_json"))
    oth.pop("otros_detail")
    oth.pop("otros_detalle_en_ventana_ultima_json")
    return core.located.select(*SPINE_KEYS, *[c.alias(k) for k, c in oth.items()])


def q_other_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (spine row, other type, other number): tickets in and outside the closing week."""
    a = _analysis(spark, sf_dir)
    stats = a.core.other_edition_stats
    own = a.core.own_edition_stats  # of the same scan
    pairs = own.select("clave_persona", F.col("tipo_producto").alias("objetivo_tipo")).distinct()
    return stats.join(pairs, ["clave_persona", "objetivo_tipo"], "left_semi").select(
        "clave_persona",
        F.col("objetivo_tipo").alias("tipo_producto"),
        F.col("objetivo_ventana").alias("ventana_numero"),
        F.col("tp2").alias("tipo_producto_otro"),
        F.col("ns2").alias("numero_sorteo_otro"),
        F.col("cep2").alias("clave_edicion_producto_otro"),
        F.col("en_cierre").alias("boletos_en_semana_cierre_objetivo"),
        F.col("fuera_cierre").alias("boletos_fuera_semana_cierre_objetivo"),
    )


def q_rollup_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _analysis(spark, sf_dir).rollup


def q_rollup_recurrent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent(_analysis(spark, sf_dir).rollup, 2)


def q_rollup_recurrent_min1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent(_analysis(spark, sf_dir).rollup, 1)


def q_class_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _analysis(spark, sf_dir).rollup
    return r.groupBy("tipo_producto", "canibalizacion_clase").agg(
        F.count(F.lit(1)).alias("filas"), F.count_distinct("clave_persona").alias("clientes")
    )


def q_migration_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _analysis(spark, sf_dir)
    return migration_flow(a.core.rows, a.editions)


def q_last_edition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_edition(fixture_editions(spark, sf_dir))


def q_rollup_single_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single-window variant over the two-year extracts (recent purchases and editions)."""
    a = _analysis(spark, sf_dir)
    return SingleWindowAnalysis(purchases_recent(a.purchases, a.recent), a.recent).rollup


def q_quality_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _analysis(spark, sf_dir)
    return quality_counters(a.purchases, a.editions, a.recent, a.windows)


def q_rollup_date_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup_date_nulls(_analysis(spark, sf_dir).rollup)


def q_migration_flow_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flow of the rollup's 21 output columns, the details read from their JSON text."""
    a = _analysis(spark, sf_dir)
    return migration_flow(a.rollup, a.editions)


def _shared(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_rollup_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dated snapshots of the rollup are stored, a year apart; the later one is read by its day."""
    place = _shared(spark, "snapshots")
    with stored_for_now(fixture_purchases(spark, sf_dir), _shared(spark, "detalle")) as purchases:
        for as_of in (FIXTURE_AS_OF - timedelta(days=365), FIXTURE_AS_OF):
            a = SwitchingAnalysis(purchases, fixture_editions(spark, sf_dir), as_of)
            write_snapshot(a.rollup, place, as_of.date())
    return read_snapshot(spark, place, FIXTURE_AS_OF.date())


def q_rollup_recurrent_reloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup as a CSV file is read again, filtered, and replaces a Parquet result that is read in turn."""
    file, place = _shared(spark, "rollup-csv"), _shared(spark, "rollup")
    # The records' text repeats its names in each row: compressed, it takes a fraction of the space.
    write(_analysis(spark, sf_dir).rollup, file, "csv", compression="gzip", **{"zlib.compress.level": "BEST_SPEED"})
    stored = read_rollup(spark, file, "csv")
    for least in (1, 2):
        write(recurrent(stored, least), place)
    return read_rollup(spark, place)


def q_purchases_reloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both raw extracts are written as CSV and read again, then cut to the recent editions."""
    bought, offered = _shared(spark, "detalle-csv"), _shared(spark, "sorteo-csv")
    write(fixture_purchases(spark, sf_dir), bought, "csv")
    write(fixture_editions(spark, sf_dir), offered, "csv")
    a = SwitchingAnalysis(read_purchases(spark, bought, "csv"), read_editions(spark, offered, "csv"), FIXTURE_AS_OF)
    return purchases_recent(a.purchases, a.recent)


def q_purchases_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tolerant_purchases(fixture_purchases_dirty(spark, sf_dir))[0]


def q_purchases_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tolerant_purchases(fixture_purchases_dirty(spark, sf_dir))[1].drop("fila")


def q_purchases_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_purchases(fixture_purchases_text(spark, sf_dir))


def q_editions_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_editions(fixture_editions_text(spark, sf_dir))


def q_rollup_dates_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_day_text(spark, sf_dir).select("event_id", "t", parse_day(F.col("t"), lenient=True).alias("fecha"))


def _irregular(spark: SparkSession, sf_dir: str) -> SwitchingAnalysis:
    return SwitchingAnalysis(irregular_purchases(spark, sf_dir), irregular_editions(spark, sf_dir), FIXTURE_AS_OF)


def q_edition_windows_irregular(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _irregular(spark, sf_dir).windows


def q_last_edition_irregular(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_edition(dedup_editions(irregular_editions(spark, sf_dir)))


def q_rollup_full_irregular(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _irregular(spark, sf_dir).rollup


def q_quality_counters_irregular(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _irregular(spark, sf_dir)
    return quality_counters(a.purchases, a.editions, a.recent, a.windows)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "editions_recent": q_editions_recent,
    "purchases_recent": q_purchases_recent,
    "purchases_enriched": q_purchases_enriched,
    "purchases_flagged": q_purchases_flagged,
    "purchase_dates_parsed": q_purchase_dates_parsed,
    "edition_labels": q_edition_labels,
    "ticket_count": q_ticket_count,
    "edition_windows": q_edition_windows,
    "window_spine": q_window_spine,
    "own_history": q_own_history,
    "history_detail": q_history_detail,
    "other_purchases": q_other_purchases,
    "other_detail": q_other_detail,
    "rollup_full": q_rollup_full,
    "rollup_recurrent": q_rollup_recurrent,
    "rollup_recurrent_min1": q_rollup_recurrent_min1,
    "class_summary": q_class_summary,
    "migration_flow": q_migration_flow,
    "last_edition": q_last_edition,
    "rollup_single_window": q_rollup_single_window,
    "quality_counters": q_quality_counters,
    "rollup_date_nulls": q_rollup_date_nulls,
    "migration_flow_stored": q_migration_flow_stored,
    "rollup_snapshot": q_rollup_snapshot,
    "rollup_recurrent_reloaded": q_rollup_recurrent_reloaded,
    "purchases_reloaded": q_purchases_reloaded,
    "purchases_tolerant": q_purchases_tolerant,
    "purchases_rejected": q_purchases_rejected,
    "purchases_from_text": q_purchases_from_text,
    "editions_from_text": q_editions_from_text,
    "rollup_dates_from_text": q_rollup_dates_from_text,
    "edition_windows_irregular": q_edition_windows_irregular,
    "last_edition_irregular": q_last_edition_irregular,
    "rollup_full_irregular": q_rollup_full_irregular,
    "quality_counters_irregular": q_quality_counters_irregular,
}
