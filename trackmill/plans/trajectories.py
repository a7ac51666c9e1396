"""The whole trajectory job: points in, and points, stops, intervals and runs out."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmill.operators import trajectory as tr
from trackmill.operators.ordered import MAX_ROWS_PER_TASK, plain
from trackmill.sinks.writers import write_csv, write_intervals
from trackmill.sources.files import read_plt


def interval_rows(members: DataFrame) -> DataFrame:
    """Run members with ``direction`` and ``interval_id`` for the interval files."""
    direction = F.when(F.col("run_value") == tr.UP, "up").otherwise("down")
    return members.withColumns({"direction": direction, "interval_id": F.col("run_no")})


def analyse_files(
    spark: SparkSession,
    source,
    target: str,
    stop_limit: float = tr.STOP_SPEED,
    min_len: int = 2,
    max_rows: int | None = MAX_ROWS_PER_TASK,
) -> None:
    """Write ``points``, ``stops``, ``intervals``, ``runs`` and ``run_members`` below ``target``."""
    df = tr.analyse(read_plt(spark, source), stop_limit, max_rows=max_rows)
    # Five outputs share the analysed points; those that do not fit stay on disk.
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    members = tr.runs(df, min_len=min_len)
    write_csv(plain(df), f"{target}/points")
    write_csv(tr.stop_list(df), f"{target}/stops")
    write_csv(tr.interval_list(tr.intervals(df)), f"{target}/intervals")
    write_csv(tr.run_summary(members), f"{target}/runs")
    write_intervals(interval_rows(members), f"{target}/run_members", tr.KEY)
    df.unpersist()
