"""What the footers of Parquet files say, without reading their data."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from estate.sources.listings import is_local, path_opener

FOOTER = (
    "path string, problem string, row_count long, row_groups int, schema_text string, "
    "columns array<struct<name:string,nulls:long,low:long,high:long,low_text:string,high_text:string>>"
)
#: Files of one task, and how many of them it opens at a time, as it waits for the storage.
FILES_PER_TASK, FILES_AT_ONCE = 500, 8


def parquet_files(listed: DataFrame) -> DataFrame:
    """The data files of a listing (`relpath`, `path`): names that end in .parquet, none hidden."""
    hidden = F.col("relpath").rlike("(^|/)[_.][^/=]*(/|$)")
    return listed.filter(F.col("relpath").endswith(".parquet") & ~hidden)


def parquet_footers(files: DataFrame) -> DataFrame:
    """One row per `path` of `files`: row count, schema and the ranges of its columns, from the footer alone.

    `schema_text` has a line of name and type for each column in order, as Spark reads them; partition
    columns are in no footer. `columns` has each leaf column with its nulls and, if the writer kept
    them, least and greatest values: integers as they are and dates as days in `low` and `high`, texts
    in `low_text` and `high_text`, where a writer may have shortened long ones; other types have none.
    What is null there is not known. A file that is no Parquet has a `problem` and no other values; a
    file that cannot be reached is an error. A null path is left out.
    """
    spark = files.sparkSession
    open_path = path_opener(is_local(spark))
    at_once = FILES_AT_ONCE

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import datetime
        import json
        from concurrent.futures import ThreadPoolExecutor

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema
        from pyspark.sql.types import StructType

        epoch = datetime.date(1970, 1, 1)

        def number(value):
            if type(value) is datetime.date:
                return (value - epoch).days
            return value if type(value) is int else None

        def column_ranges(footer):
            found = []
            for c in range(footer.num_columns):
                parts = [footer.row_group(g).column(c) for g in range(footer.num_row_groups)]
                kept = [p.statistics for p in parts if p.num_values]
                nulls = sum(s.null_count for s in kept) if all(s is not None and s.has_null_count for s in kept) else None
                # A row group of nulls alone has no ends and moves none.
                ended = [s for s, p in ((p.statistics, p) for p in parts) if p.num_values and not (s is not None and s.has_null_count and s.null_count == p.num_values)]
                ends = [(s.min, s.max) for s in ended] if all(s is not None and s.has_min_max for s in ended) else []
                low, high = (min(e[0] for e in ends), max(e[1] for e in ends)) if ends else (None, None)
                text = isinstance(low, str)
                found.append((footer.schema.column(c).path, nulls, number(low), number(high), low if text else None, high if text else None))
            return found

        def footer_of(path: str) -> tuple:
            filesystem, inner = open_path(path)
            try:
                with filesystem.open_input_file(inner) as source:
                    footer = pq.read_metadata(source)
            except pa.ArrowInvalid as problem:
                return path, str(problem), None, None, None, None
            stored = (footer.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
            schema = StructType.fromJson(json.loads(stored)) if stored else from_arrow_schema(footer.schema.to_arrow_schema(), prefer_timestamp_ntz=True)
            text = "\n".join(f"{f.name}\t{f.dataType.simpleString()}" for f in schema.fields)
            return path, None, footer.num_rows, footer.num_row_groups, text, column_ranges(footer)

        names = ["path", "problem", "row_count", "row_groups", "schema_text", "columns"]
        with ThreadPoolExecutor(at_once) as pool:
            for batch in batches:
                rows = pd.DataFrame(list(pool.map(footer_of, batch["path"])), columns=names)
                for name, kind in (("row_count", "Int64"), ("row_groups", "Int32")):
                    rows[name] = rows[name].astype(kind)
                fields = ("name", "nulls", "low", "high", "low_text", "high_text")
                rows["columns"] = [None if c is None else [dict(zip(fields, one, strict=True)) for one in c] for c in rows["columns"]]
                yield rows

    paths = files.filter(F.col("path").isNotNull()).select("path")
    tasks = max(1, -(-paths.count() // FILES_PER_TASK))
    return paths.repartition(tasks).mapInPandas(read, FOOTER)


def footer_signature(footers: DataFrame) -> DataFrame:
    """One row: row count and schema hash of the table that the files make, and how many of them are no Parquet.

    The hash is that of `table_signature` for a table without partition columns, whose files have one schema;
    files of several schemas have the hash of all of these in order. No files have 0 rows and no hash.
    """
    shapes = footers.groupBy("schema_text").agg(F.sum("row_count").alias("row_count"), F.count_if(F.col("problem").isNotNull()).alias("unreadable"))
    texts = F.array_sort(F.collect_set("schema_text"))
    return shapes.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        F.when(F.size(texts) > 0, F.sha2(F.array_join(texts, "\n\n"), 256)).alias("schema_hash"),
        F.coalesce(F.sum("unreadable"), F.lit(0)).alias("unreadable"),
    )


def column_ranges(footers: DataFrame) -> DataFrame:
    """(name, files, nulls, low, high, low_text, high_text): each column over all files; unknown where one file does not know it.

    Ends are null, too, where a column holds nulls alone.
    """
    rows = footers.select("row_count", F.inline("columns"))
    # A file that is empty or has nulls alone moves no end.
    empty = (F.col("row_count") == 0) | F.coalesce(F.col("nulls") == F.col("row_count"), F.lit(False))
    ends = {"low": F.min, "high": F.max, "low_text": F.min, "high_text": F.max}
    # An end is known if every file that has values has it.
    known = lambda c: F.count_if(~empty & F.col(c).isNull()) == 0
    return rows.groupBy("name").agg(
        F.count(F.lit(1)).alias("files"),
        F.when(F.count_if(F.col("nulls").isNull()) == 0, F.sum("nulls")).alias("nulls"),
        *[F.when(known(c), f(c)).alias(c) for c, f in ends.items()],
    )
