"""Batch writers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopbank.sinks.commits import CommittedTable


def append_table(df: DataFrame, target: str, file_format: str = "parquet") -> None:
    """Append to a path, or to a catalog table when the target has no slash; made if absent."""
    writer = df.write.format(file_format).mode("append")
    writer.save(target) if "/" in target else writer.saveAsTable(target)


def append_once(df: DataFrame, target: str, run: str) -> bool:
    """Append the rows of a named run, once: a run that is repeated, after a failure or by mistake, adds nothing.

    ``CommittedTable(spark, target).read()`` reads the table.
    """
    return CommittedTable(df.sparkSession, target).add("runs", run, df)


def overwrite_parquet(df: DataFrame, path: str, *partition_by: str) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


#: Text bytes of a file, about; smaller weeks and days have one file each.
FILE_BYTES = 256 << 20
#: Text bytes that one task writes, in files of one or several weeks.
TASK_BYTES = 128 << 20
#: Beginning a file takes as long as writing so many bytes.
FILE_COST = 4 << 20


def file_plan(df: DataFrame, keys: list[str], file_bytes: int, task_bytes: int) -> DataFrame:
    """Rows (keys, tasks): for each group of rows the tasks that write its files, one for each file.

    The bytes of the groups are measured first. A group gets as many files as bring it nearest to ``file_bytes`` each. Weeks (the first
    key) are taken together until their files make about ``task_bytes`` a task; files of one week are always those of different tasks, since a task
    writes one file to a folder. The plan follows the calendar, not the rows: a row for each week or day.
    """
    size = F.octet_length(F.to_csv(F.struct(*df.columns))) + 1
    groups = df.groupBy(*keys).agg(F.sum(size).alias("bytes"))
    groups = groups.withColumn("files", F.greatest(F.lit(1), F.round(F.col("bytes") / file_bytes)).cast("int"))
    cost = F.sum(F.col("bytes") + F.col("files") * FILE_COST)
    weeks = groups.groupBy(keys[0]).agg(cost.alias("week_cost"), F.sum("files").alias("week_files"))
    everything = Window.partitionBy(F.lit(0))
    before = everything.orderBy(keys[0]).rowsBetween(Window.unboundedPreceding, -1)
    share = F.sum("week_files").over(everything) / F.count("*").over(everything)
    turn = F.floor(F.coalesce(F.sum("week_cost").over(before), F.lit(0)) / (task_bytes * share)).alias("turn")
    weeks = weeks.select(F.col(keys[0]).alias("_week"), turn)
    units = groups.select(*keys, F.explode(F.sequence(F.lit(0), F.col("files") - 1)).alias("file"))
    nth = F.row_number().over(Window.partitionBy(keys[0]).orderBy(*keys[1:], "file"))
    units = units.withColumn("nth", nth).join(weeks, F.col(keys[0]).eqNullSafe(F.col("_week")))
    task = (F.dense_rank().over(everything.orderBy("turn", "nth")) - 1).alias("task")
    units = units.select(*keys, "file", task)
    return units.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("file", "task"))).alias("tasks"))


def write_weekly_parquet(df: DataFrame, path: str, file_bytes: int = FILE_BYTES, task_bytes: int = TASK_BYTES) -> None:
    """One file per business week, more for a week of over one and a half times ``file_bytes``."""
    _planned(df, ["week_start"], file_bytes, task_bytes).write.mode("overwrite").partitionBy("week_start").parquet(path)


def write_weekly_csv(df: DataFrame, path: str, file_bytes: int = FILE_BYTES, task_bytes: int = TASK_BYTES) -> None:
    """Seven files per business week, one for each of its days that has rows; more for a day of over one and a half times ``file_bytes``."""
    rows = _planned(df, ["week_start", "day_in_week"], file_bytes, task_bytes)
    rows.write.mode("overwrite").option("header", True).partitionBy("week_start").csv(path)


def _planned(df: DataFrame, keys: list[str], file_bytes: int, task_bytes: int) -> DataFrame:
    """The rows in as many partitions as the plan has tasks; rows of a group are spread over its files by hash."""
    plan = file_plan(df, keys, file_bytes, task_bytes).persist()
    n = 1 + (plan.agg(F.max(F.array_max(F.transform("tasks", lambda x: x.task)))).first()[0] or 0)
    renamed = plan.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    own = F.get("tasks", F.pmod(F.xxhash64(*df.columns), F.size("tasks")).cast("int"))
    placed = df.join(renamed, same).select(*df.columns, own.task.alias("_task"))
    return placed.repartitionById(n, "_task").drop("_task")


def write_ordered(df: DataFrame, path: str, *order: str | Column) -> None:
    """A report in a total order over its files, in the order of their names: ranges of the order are found by sampling, and each is sorted
    by a task of its own."""
    df.orderBy(*order).write.mode("overwrite").parquet(path)


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """A report as ``write_ordered`` stored it, with the ``position`` of each row, from 1."""
    rows = spark.read.parquet(path)
    rows = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    before = Window.partitionBy(F.lit(0)).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("_file").agg(F.count("*").alias("_n"))
    files = files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    position = (F.col("_before") + F.col("_row") + 1).alias("position")
    return rows.join(files, "_file").select(*[c for c in rows.columns if c not in ("_file", "_row")], position)


def write_text(lines: DataFrame, path: str) -> None:
    """A single text file, for short reports such as a top-100 list."""
    lines.coalesce(1).write.mode("overwrite").text(path)


def stored_rows(spark: SparkSession, path: str) -> int:
    """Rows stored below a path, from the footers of its Parquet files: no column is read. 0 where there is no file."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    try:
        return own.read.parquet(path).count()
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return 0


def require_stored(spark: SparkSession, path: str) -> DataFrame:
    """What is stored below a path, or an error if that is no row."""
    if not stored_rows(spark, path):
        raise ValueError(f"{path} has no rows")
    return spark.read.parquet(path)
