"""Readers of dirty files that keep what does not fit: the accepted rows, and the others with reason and source file.

A record is refused if a cell does not fit its column's type or the number of cells is wrong. Files are read as lines and parsed by
``from_csv`` or ``from_json``, in batches and streams alike: so every column is parsed whatever a query needs, which a pruned scan
would not do, and both outputs agree on each record. A record may not span lines. Empty cells are null and fit every type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt"
#: The reason of a record that has too few or too many cells, or is none at all.
SHAPE = "shape"


def _schema(columns: str | StructType) -> StructType:
    return columns if isinstance(columns, StructType) else StructType.fromDDL(columns)


def _lines(spark: SparkSession, path: str, stream: bool, files: str, files_per_batch: int | None) -> DataFrame:
    reader = (spark.readStream if stream else spark.read).option("pathGlobFilter", files)
    if stream and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path).select("*", F.col("_metadata.file_path").alias("source_file"))


def _checked(lines: DataFrame, schema: StructType, parsed: Column, texts: Column) -> DataFrame:
    rows = lines.withColumns({"parsed": parsed, "texts": texts})
    unfit = [
        F.when(F.col(f"texts.`{f.name}`").isNotNull() & F.col(f"parsed.`{f.name}`").isNull(), F.lit(f.name))
        for f in schema.fields if not isinstance(f.dataType, StringType)
    ]
    named = F.concat_ws(",", *unfit) if unfit else F.lit("")
    reason = F.when(F.col(f"parsed.{CORRUPT}").isNotNull(), F.when(named == "", F.lit(SHAPE)).otherwise(named))
    return rows.withColumn("reason", reason).select("parsed", "value", "source_file", "reason")


def read_checked_csv(
    spark: SparkSession, path: str, columns: str | StructType, stream: bool = False, files: str = "*.csv", files_per_batch: int | None = None
) -> DataFrame:
    """Records of CSV files with a header; ``accepted`` and ``quarantined`` take them apart."""
    schema = _schema(columns)
    header = ",".join(schema.names)
    lines = _lines(spark, path, stream, files, files_per_batch)
    lines = lines.where((F.trim("value") != "") & (F.translate("value", '" ', "") != header.replace(" ", "")))
    typed = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    strings = StructType([StructField(f.name, StringType()) for f in schema.fields])
    parsed = F.from_csv("value", typed.simpleString()[7:-1].replace(":", " "), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    texts = F.from_csv("value", strings.simpleString()[7:-1].replace(":", " "), {"mode": "PERMISSIVE"})
    return _checked(lines, schema, parsed, texts)


def read_checked_json(
    spark: SparkSession, path: str, columns: str | StructType, stream: bool = False, files: str = "*.json", files_per_batch: int | None = None
) -> DataFrame:
    """Records of files with a JSON object on each line."""
    schema = _schema(columns)
    lines = _lines(spark, path, stream, files, files_per_batch).where(F.trim("value") != "")
    typed = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    strings = StructType([StructField(f.name, StringType()) for f in schema.fields])
    parsed = F.from_json("value", typed, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    texts = F.from_json("value", strings, {"mode": "PERMISSIVE"})
    return _checked(lines, schema, parsed, texts)


def accepted(records: DataFrame) -> DataFrame:
    """The rows that fit, with their columns."""
    columns = [c for c in records.schema["parsed"].dataType.names if c != CORRUPT]
    return records.where("reason is null").select(*[F.col(f"parsed.`{c}`").alias(c) for c in columns])


def quarantined(records: DataFrame) -> DataFrame:
    """Rows (source_file, reason, record): the columns that do not fit, and the line as it stands in the file."""
    return records.where("reason is not null").select("source_file", "reason", F.col("value").alias("record"))
