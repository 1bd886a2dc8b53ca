"""Loads that fail half-way."""

import uuid

import pytest
from pyspark.sql import functions as F

from yardline.sources import tables as T


@pytest.fixture
def name(spark):
    name = f"yardline_test_{uuid.uuid4().hex}"
    yield name
    T.drop_table(spark, name)


def broken(spark, schema="long"):
    return spark.range(100, numPartitions=4).select(F.when(F.col("id") == 77, F.raise_error("row 77")).otherwise(F.col("id")).cast(schema).alias("id"))


@pytest.mark.parametrize("schema", ["long", "int"])
def test_failed_overwrite_leaves_the_old_rows(spark, name, schema):
    tables = {t.name for t in spark.catalog.listTables()}
    assert T.overwrite_table(spark.range(10), name) == 10
    with pytest.raises(Exception, match="row 77"):
        T.overwrite_table(broken(spark, schema), name)
    assert sorted(r.id for r in T.read_table(spark, name).collect()) == list(range(10))
    assert {t.name for t in spark.catalog.listTables()} == tables | {name}


def test_overwrite(spark, name):
    T.create_table(spark.range(1), name)
    for rows in (spark.range(5), spark.range(7), spark.range(3).selectExpr("id AS other"), spark.range(4).selectExpr("id", "id % 2 AS k")):
        assert T.overwrite_table(rows, name) == rows.count()
        assert T.read_table(spark, name).columns == rows.columns
        assert T.read_table(spark, name).count() == rows.count()
    T.overwrite_table(spark.range(6).selectExpr("id", "id % 2 AS k"), name, ["k"])
    assert {(r.id, r.k) for r in T.read_table(spark, name).collect()} == {(i, i % 2) for i in range(6)}
    T.overwrite_table(T.read_table(spark, name).filter("id < 2"), name)  # from the table itself
    assert T.read_table(spark, name).count() == 2


def test_rename_that_fails_gives_the_name_back(spark, name, monkeypatch):
    T.overwrite_table(spark.range(3), name)
    real = T.rename_table

    def rename(session, old, new):
        if "_staged_" in old:
            raise RuntimeError("catalog is away")
        real(session, old, new)

    monkeypatch.setattr(T, "rename_table", rename)
    with pytest.raises(RuntimeError, match="away"):
        T.overwrite_table(spark.range(4).selectExpr("id AS other"), name)
    assert T.read_table(spark, name).columns == ["id"] and T.read_table(spark, name).count() == 3


def test_chunks(spark, name):
    chunk = (F.col("id") / 25).cast("long")
    good = lambda n: spark.range(n).select("id", (F.col("id") * 2).alias("v"))
    poisoned = spark.range(100).select("id", F.when(F.col("id") == 77, F.raise_error("row 77")).otherwise(F.col("id") * 2).cast("long").alias("v"))
    failed = T.load_chunks(poisoned, name, chunk)
    assert list(failed) == [3] and "row 77" in failed[3]
    assert T.loaded_chunks(spark, name) == {0, 1, 2}
    assert sorted(r.id for r in T.read_table(spark, name).collect()) == list(range(75))
    assert T.load_chunks(poisoned, name, chunk).keys() == {3}

    def check(rows):
        if rows.count() != 25:
            raise ValueError("short")

    assert T.load_chunks(good(110), name, chunk, check) == {4: "short"}
    assert T.load_chunks(good(110), name, chunk) == {} == T.load_chunks(good(110), name, chunk)
    assert sorted((r.id, r.v, r.chunk) for r in T.read_table(spark, name).collect()) == [(i, 2 * i, i // 25) for i in range(110)]
    with pytest.raises(ValueError, match="without"):
        T.load_chunks(good(3), name, F.lit(None))
