"""Reading and writing tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, *paths: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(*paths)


def read_matching(spark: SparkSession, folder: str, pattern: str, merge_schema: bool = True) -> DataFrame:
    """All Parquet files whose name matches a glob."""
    reader = spark.read.option("mergeSchema", merge_schema).option("pathGlobFilter", pattern)
    return reader.option("recursiveFileLookup", True).parquet(folder)


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    return spark.read.schema(schema).option("header", header).csv(path)


def with_file_year(df: DataFrame, start: int, name: str = "year") -> DataFrame:
    """Tag rows with the four digits at a (0-based) place of their file's name."""
    year = F.substring(F.col("_metadata.file_name"), start + 1, 4).cast("int")
    return df.select("*", year.alias(name))


def with_path_year(df: DataFrame, after: str, name: str = "year") -> DataFrame:
    """Tag rows with the four digits that follow a text in their file's path."""
    tail = F.substring_index(F.col("_metadata.file_path"), after, -1)
    return df.select("*", F.substring(tail, 1, 4).cast("int").alias(name))


def read_table(
    spark: SparkSession, name: str, where: str | Column | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """Catalog table; filter and columns reach the scan."""
    df = spark.table(name)
    df = df if where is None else df.where(where)
    return df if columns is None else df.select(*columns)


def read_jdbc(spark: SparkSession, url: str, table: str, partition: dict | None = None, **options: str) -> DataFrame:
    """Table of a database; the caller supplies the connection. ``partition`` (column, lowerBound,
    upperBound, numPartitions) reads it in parallel. Filters on the result are pushed to the database."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    return (reader.options(**partition) if partition else reader).load()


def quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def create_table(df: DataFrame, name: str) -> None:
    """Empty table with the frame's columns, replacing what was there."""
    df.limit(0).write.mode("overwrite").saveAsTable(name)


def overwrite_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> int:
    """Replace a table's content; returns the rows written.

    The new content is written beside the old and counted. Only then does the catalog change, so a job that fails leaves
    the table as it was, and readers that have begun go on with the old files until these are deleted at the end. A table
    with the same columns gets the new place in one catalog step; otherwise the new table takes the name, and the old one takes
    it back if that fails. A table that isn't there is created.
    """
    spark = df.sparkSession
    staged = f"{name}_staged_{uuid.uuid4().hex}"
    try:
        df.write.partitionBy(*partition_by).saveAsTable(staged)
        rows = spark.table(staged).count()
    except Exception:
        drop_table(spark, staged)
        raise
    if not spark.catalog.tableExists(name):
        _take_name(spark, staged, name, partition_by)
        return rows
    old, new = (_place(spark, n) for n in (name, staged))
    if not partition_by and not old.partitions and old.columns == new.columns and old.provider == new.provider and old.managed:
        spare = f"{old.location}_{uuid.uuid4().hex}"
        files = _files(spark, spare)
        files.rename(_path(spark, new.location), _path(spark, spare))  # out of the staged table's folder, which goes with it
        drop_table(spark, staged)
        spark.sql(f"ALTER TABLE {quoted(name)} SET LOCATION '{spare}'")
        spark.catalog.refreshTable(name)
        files.delete(_path(spark, old.location), True)
        return rows
    kept = f"{name}_kept_{uuid.uuid4().hex}"
    rename_table(spark, name, kept)
    try:
        _take_name(spark, staged, name, partition_by)
    except Exception:
        drop_table(spark, name)
        rename_table(spark, kept, name)
        drop_table(spark, staged)
        raise
    drop_table(spark, kept)
    return rows


def _take_name(spark: SparkSession, staged: str, name: str, partition_by: Sequence[str]) -> None:
    """Give a staged table its name. Partitions don't move with a table in every catalog; those of a new table are written again."""
    if partition_by:
        spark.table(staged).write.partitionBy(*partition_by).saveAsTable(name)
        drop_table(spark, staged)
    else:
        rename_table(spark, staged, name)


@dataclass(frozen=True)
class Place:
    """Where and how the catalog keeps a table."""

    location: str
    provider: str
    managed: bool
    columns: tuple[tuple[str, str], ...]
    partitions: tuple[str, ...]


def _place(spark: SparkSession, name: str) -> Place:
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").collect()}
    columns = spark.catalog.listColumns(name)
    return Place(
        told["Location"], told.get("Provider", ""), told.get("Type") == "MANAGED",
        tuple((c.name, c.dataType) for c in columns), tuple(c.name for c in columns if c.isPartition),
    )


def _path(spark: SparkSession, place: str):
    return spark._jvm.org.apache.hadoop.fs.Path(place)


def _files(spark: SparkSession, place: str):
    return _path(spark, place).getFileSystem(spark._jsc.hadoopConfiguration())


def rename_table(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {quoted(old)} RENAME TO {quoted(new)}")


def append_table(df: DataFrame | None, name: str | None, rows_per_file: int = 50_000) -> None:
    """Append in files of at most ``rows_per_file`` rows, written in parallel by the tasks."""
    if df is None or name is None:
        raise ValueError("a frame and a table name are needed")
    df.write.mode("append").option("maxRecordsPerFile", rows_per_file).saveAsTable(name)


CHUNK = "chunk"


def load_chunks(df: DataFrame, name: str, chunk: Column, check: Callable[[DataFrame], None] | None = None) -> dict[int, str]:
    """Load a frame into a table chunk by chunk and go on past chunks that fail; returns these with their errors.

    ``chunk`` numbers the rows' chunks and becomes the table's partition column. A chunk is written and read back (``check``
    may raise on it) beside the table, and joins it in one catalog step. The table's partitions are the record of what has been
    loaded, so another call with the same chunks adds those that are missing and no others. The column must give a row
    the same number every time. Rows whose chunk is null are an error.
    """
    spark = df.sparkSession
    rows = df.withColumn(CHUNK, chunk.cast("long"))
    if not spark.catalog.tableExists(name):
        rows.limit(0).write.partitionBy(CHUNK).saveAsTable(name)
    place = _place(spark, name).location
    loaded = loaded_chunks(spark, name)
    failed = {}
    numbers = [r[0] for r in rows.select(CHUNK).distinct().collect()]  # a number per chunk
    if None in numbers:
        raise ValueError("rows without a chunk")
    for number in sorted(set(numbers) - loaded):
        spare = f"{place}/{CHUNK}={number}-{uuid.uuid4().hex}"
        try:
            own = rows.filter(F.col(CHUNK) == number).drop(CHUNK)
            own.write.parquet(spare)
            if check is not None:
                check(spark.read.schema(own.schema).parquet(spare))
            spark.sql(f"ALTER TABLE {quoted(name)} ADD PARTITION ({CHUNK} = {number}) LOCATION '{spare}'")
        except Exception as error:  # noqa: BLE001  whatever stops a chunk must not stop the others
            failed[number] = str(error).splitlines()[0]
            _files(spark, spare).delete(_path(spark, spare), True)
    spark.catalog.refreshTable(name)
    return failed


def loaded_chunks(spark: SparkSession, name: str) -> set[int]:
    """Chunks that ``load_chunks`` has brought into a table."""
    return {int(r[0].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {quoted(name)}").collect()}


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def profile(df: DataFrame) -> DataFrame:
    """Shape, null counts and bytes of the values: one row per column, from one pass over the data."""
    names = df.columns

    def size(name: str, kind: T.DataType) -> Column:
        width = FIXED_BYTES.get(kind.typeName())
        value = F.col(f"`{name}`")
        each = F.when(value.isNotNull(), F.lit(width)) if width else F.octet_length(value.cast("string"))
        return F.coalesce(F.sum(each.cast("long")), F.lit(0).cast("long"))

    row = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{n}`")).alias(f"_c{i}") for i, n in enumerate(names)],
        *[size(f.name, f.dataType).alias(f"_b{i}") for i, f in enumerate(df.schema.fields)],
    )
    entries = [
        F.struct(
            F.lit(n).alias("column"), F.col("_rows").alias("n_rows"), (F.col("_rows") - F.col(f"_c{i}")).alias("n_null"),
            F.col(f"_b{i}").alias("n_bytes"),
        )
        for i, n in enumerate(names)
    ]
    return row.select(F.inline(F.array(*entries))).withColumn("n_columns", F.lit(len(names)).cast("long"))


# Bytes of a value by type; values of other types count as text.
FIXED_BYTES = {"byte": 1, "boolean": 1, "short": 2, "integer": 4, "float": 4, "date": 4, "long": 8, "double": 8, "timestamp": 8}
