"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.session import scratch_path


def stored(frame: DataFrame, label: str, *partitions: str) -> DataFrame:
    """Write a frame once to the shared folder and read it from there.

    What was drawn or numbered in it stays the same when an executor is lost later, and its lineage
    ends here.
    """
    path = scratch_path(frame.sparkSession, label)
    writer = frame.write.option("compression", "zstd")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def steady(frame: DataFrame) -> DataFrame:
    """A frame whose rows come in the same partitions and order each time it is read.

    Reading files, choosing columns and filtering is repeatable; anything else is stored first.
    """
    return frame if _repeatable(frame) else stored(frame, "steady")


def _repeatable(frame: DataFrame) -> bool:
    plan = frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "simple")
    return "FileScan" in plan and not re.search(r"Exchange|Existing|LocalTable|Python|Arrow|Pandas|Aggregate|Join|Limit|Sample|Sort|Union|Range|InMemory|rand", plan)


#: Bits of a row's number that are its place in its file; the others tell files apart.
PLACE_BITS = 23


def numbered(frame: DataFrame, name: str) -> DataFrame:
    """The frame with a bigint column `name` that numbers its rows, the same at every read, however the files are split.

    Rows of Parquet files are numbered by their file and their place in it, once it is seen that no two files
    share a number; any other frame, or one with larger files, is numbered while it is stored.
    """
    if "_metadata" not in frame.columns and _repeatable(frame):
        path, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
        file = F.conv(F.substring(F.md5(path), 1, 10), 16, 10).cast("long")
        try:
            files = frame.select(path.alias("path"), file.alias("file"), place.alias("place")).groupBy("path").agg(F.first("file").alias("file"), F.max("place").alias("last"))
            seen = files.agg(F.count("*").alias("n"), F.countDistinct("file").alias("numbers"), F.max("last").alias("last")).first()
            if seen.n == seen.numbers and (seen.last or 0) < 1 << PLACE_BITS:
                return frame.select("*", (F.shiftleft(file, PLACE_BITS) + place).alias(name))
        except AnalysisException:
            pass  # no such file source, or not directly above it
    return stored(frame.withColumn(name, F.monotonically_increasing_id()), "numbered")


def fresh_name(columns: list[str], wanted: str) -> str:
    """A column name that does not clash with the given ones (case is ignored, as Spark does)."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted
