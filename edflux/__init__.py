"""edflux: product-switching analytics over numbered, time-boxed editions, on Spark.

Public entry points take and return DataFrames. Building them runs small jobs on tables of the
size of the editions (a row count, the windows' span); the purchases are read on execution only.
"""

from edflux.operators.flow import migration_flow
from edflux.plans.rollup import (
    SingleWindowAnalysis,
    SwitchingAnalysis,
    recurrent,
    rollup,
    rollup_single_window,
)
from edflux.session import build_session

__all__ = [
    "SingleWindowAnalysis",
    "SwitchingAnalysis",
    "build_session",
    "migration_flow",
    "recurrent",
    "rollup",
    "rollup_single_window",
]
