"""Reports on the target."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cost_by_agent(executions: DataFrame, now: datetime, days: int = 30) -> DataFrame:
    """Runs, cost and tokens by agent of the successful executions of the last days, dearest first."""
    recent = executions.where((F.col("status") == "success") & (F.col("created_at") >= F.lit(now - timedelta(days=days))))
    out = recent.groupBy("agent_id").agg(F.count("*").alias("runs"), F.round(F.sum("cost_usd"), 2).alias("cost"), F.sum("total_tokens").alias("tokens"))
    return out.orderBy(F.col("cost").desc())


def by_step(steps: DataFrame) -> DataFrame:
    """Runs, average tokens and average seconds by step of the passed ones, most runs first."""
    took = (F.unix_micros("finished_at") - F.unix_micros("started_at")) / 1000
    out = steps.where(F.col("state") == "passed").groupBy("step_id").agg(F.count("*").alias("runs"), F.round(F.avg("total_tokens")).alias("avg_tokens"), F.round(F.avg(took) / 1000.0, 1).alias("avg_seconds"))
    return out.orderBy(F.col("runs").desc())


def quarantine(rows: DataFrame) -> DataFrame:
    """What was set aside, newest first."""
    return rows.select("table_name", "row_key", "error_message", "quarantined_at").orderBy(F.col("quarantined_at").desc())
