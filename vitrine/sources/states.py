"""State-centre dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitrine.functions.fixed_values import STATE_CENTRES


def state_centres(spark: SparkSession) -> DataFrame:
    """27 fixed rows: state, lat, lon. A literal relation, so its size is known to the planner."""
    rows = ", ".join(f"('{s}', double({lat}), double({lon}))" for s, lat, lon in STATE_CENTRES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS centres(state, lat, lon)")
