"""Source and sink queries. Written tables go to a fresh folder under the session's warehouse."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import functions as F

from yardline.session import at_end, scratch_path
from yardline.sources import tables as T
from yardline.queries.registry import Tables, query

c = F.col
EVENT_SCHEMA = "event_id LONG, user_id LONG, event_type STRING, value DOUBLE"
EVENTS = "SELECT event_id, user_id, event_type, value FROM events"


def events(t: Tables):
    return t.events.select("event_id", "user_id", "event_type", "value")


@query("scan_parquet", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer", "c_acctbal")
def scan_parquet(t: Tables):
    return T.read_parquet(t.spark, f"{t.folder}/customer.parquet")


@query("scan_parquet_glob", """
SELECT n_nationkey AS key, n_name AS name FROM nation UNION ALL SELECT r_regionkey, r_name FROM region""")
def scan_parquet_glob(t: Tables):
    """Files chosen by name and appended."""
    nations = T.read_matching(t.spark, t.folder, "nation*.parquet").select(c("n_nationkey").alias("key"), c("n_name").alias("name"))
    regions = T.read_matching(t.spark, t.folder, "reg*.parquet").select(c("r_regionkey").alias("key"), c("r_name").alias("name"))
    return nations.unionByName(regions)


@query("filtered_scan", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice >= 200000 AND o_orderstatus = 'F'
ORDER BY o_custkey, o_orderkey""", "o_totalprice")
def filtered_scan(t: Tables):
    rows = t.orders.where("o_totalprice >= 200000 AND o_orderstatus = 'F'")
    return rows.select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_custkey", "o_orderkey")


@query("scan_csv_roundtrip", EVENTS, "value")
def scan_csv_roundtrip(t: Tables):
    path = scratch_path(t.spark, "csv")
    T.write_csv(events(t), path)
    return T.read_csv(t.spark, path, EVENT_SCHEMA)


@query("scan_with_filename_year", """
SELECT CAST(year(o_orderdate) AS INT) AS year, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY ALL""", "total")
def scan_with_filename_year(t: Tables):
    """One folder per year, the year read back from the file's path."""
    path = scratch_path(t.spark, "years")
    rows = t.orders.select(F.concat(F.lit("season-"), F.year("o_orderdate").cast("string")).alias("part"), "o_totalprice")
    rows.write.partitionBy("part").csv(path)
    files = t.spark.read.schema("o_totalprice DOUBLE").option("recursiveFileLookup", True).csv(path)
    rows = T.with_path_year(files, "season-")
    return rows.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))


@query("scan_year_of_file", """
SELECT CAST(year(o_orderdate) AS INT) AS year, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL""")
def scan_year_of_file(t: Tables):
    """Files named after their year (``odds-1995-...``) in one folder, the year cut from the name."""
    path = scratch_path(t.spark, "odds")
    rows = t.orders.select(F.year("o_orderdate").alias("part"), "o_orderpriority")
    rows.repartition("part").write.partitionBy("part").parquet(path)
    fs_path = t.spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(t.spark._jsc.hadoopConfiguration())
    for folder in fs.listStatus(fs_path(path)):  # a folder per year
        label = folder.getPath().getName()
        if not label.startswith("part="):
            continue
        for i, file in enumerate(fs.listStatus(folder.getPath())):
            if file.getPath().getName().endswith(".parquet"):
                fs.rename(file.getPath(), fs_path(f"{path}/odds-{label[5:]}-{i}.parquet"))
        fs.delete(folder.getPath(), True)
    files = T.read_matching(t.spark, path, "odds-*.parquet")
    return T.with_file_year(files, 5).groupBy("year", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


def _name(t: Tables, label: str) -> str:
    """A new table, dropped when Python ends."""
    name = f"yardline_{label}_{uuid.uuid4().hex}"
    at_end(lambda: T.drop_table(t.spark, name))
    return name


@query("sink_create", f"{EVENTS} WHERE 1 = 0")
def sink_create(t: Tables):
    name = _name(t, "create")
    T.create_table(events(t), name)
    return T.read_table(t.spark, name)


@query("sink_overwrite", EVENTS, "value")
def sink_overwrite(t: Tables):
    name = _name(t, "overwrite")
    T.create_table(events(t), name)
    T.overwrite_table(events(t), name)
    return T.read_table(t.spark, name)


@query("sink_overwrite_columns", "SELECT event_id, value * 2 AS twice FROM events", "twice")
def sink_overwrite_columns(t: Tables):
    """Content with other columns takes the place of the old; a job that fails half-way changes nothing."""
    name = _name(t, "columns")
    T.overwrite_table(events(t), name)
    T.overwrite_table(t.events.select("event_id", (c("value") * 2).alias("twice")), name)
    broken = t.events.select(F.when(c("event_id") % 3 == 0, F.raise_error("a broken row")).otherwise(c("event_id")).cast("long").alias("event_id"), c("value").alias("twice"))
    with contextlib.suppress(Exception):
        T.overwrite_table(broken, name)
    return T.read_table(t.spark, name)


@query("sink_chunks", f"""
SELECT event_id, user_id, event_type, value, CAST(event_id % 5 AS BIGINT) AS chunk, CAST(1 AS BIGINT) AS failed_first, CAST(0 AS BIGINT) AS failed_then
FROM events""", "value")
def sink_chunks(t: Tables):
    """A load in five chunks, one of which can't be read at first: the others stay, and a second call adds that one."""
    name = _name(t, "chunks")
    rows, chunk = t.events.select("event_id", "user_id", "event_type", "value"), c("event_id") % 5
    poisoned = rows.withColumn("value", F.when(chunk == 3, F.raise_error("a poisoned row").cast("double")).otherwise(c("value")))
    first, then = T.load_chunks(poisoned, name, chunk), T.load_chunks(rows, name, chunk)
    out = T.read_table(t.spark, name)
    return out.select("*", F.lit(len(first)).cast("long").alias("failed_first"), F.lit(len(then)).cast("long").alias("failed_then"))


@query("sink_append", f"{EVENTS} UNION ALL {EVENTS}", "value")
def sink_append(t: Tables):
    """Two appends to an existing table."""
    name = _name(t, "append")
    T.create_table(events(t), name)
    T.append_table(events(t), name)
    T.append_table(events(t), name, rows_per_file=10_000)
    return T.read_table(t.spark, name)


@query("sink_drop", "SELECT CAST(0 AS BIGINT) AS remaining, count(*) AS written FROM events")
def sink_drop(t: Tables):
    name = _name(t, "drop")
    T.overwrite_table(events(t), name)
    written = T.read_table(t.spark, name).count()
    T.drop_table(t.spark, name)
    left = F.lit(int(t.spark.catalog.tableExists(name))).cast("long")
    return t.events.agg(left.alias("remaining"), F.lit(written).cast("long").alias("written"))


@query("profile_table", """
WITH x AS (SELECT event_id, user_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value FROM events)
SELECT 'event_id' AS "column", count(*) AS n_rows, count(*) - count(event_id) AS n_null, 8 * count(event_id) AS n_bytes,
       CAST(4 AS BIGINT) AS n_columns FROM x
UNION ALL SELECT 'user_id', count(*), count(*) - count(user_id), 8 * count(user_id), 4 FROM x
UNION ALL SELECT 'event_type', count(*), count(*) - count(event_type), CAST(sum(strlen(event_type)) AS BIGINT), 4 FROM x
UNION ALL SELECT 'value', count(*), count(*) - count(value), 8 * count(value), 4 FROM x""")
def profile_table(t: Tables):
    return T.profile(t.events.select("event_id", "user_id", "event_type", F.when(c("event_type") != "error", c("value")).alias("value")))
