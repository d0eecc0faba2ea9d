"""Cutting lineage through the shared checkpoint folder (never executor-local storage)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from edflux.session import checkpoint_folder, ensure_checkpoint_dir


def reliable_checkpoint(df: DataFrame, enabled: bool = True) -> DataFrame:
    """Materialise ``df`` in ``spark.checkpoint.dir`` so lost executors do not replay its lineage."""
    if not enabled:
        return df
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize_small(df: DataFrame) -> DataFrame:
    """Freeze an edition-sized table that several stages and size checks reuse.

    A reliable checkpoint rather than ``cache()``: the cache matches on the logical plan,
    so a long-lived session would keep serving old rows after the source files change;
    a checkpoint is taken fresh for every analysis and cuts the lineage. Where no shared
    checkpoint folder is configured (a cluster without ``spark.checkpoint.dir``) the table
    is simply recomputed where used -- same result, a few more tiny stages.
    """
    return reliable_checkpoint(df, checkpoint_folder(df.sparkSession) is not None)
