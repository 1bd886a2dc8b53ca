"""Query registry and the tables a query may read."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yardline.queries import adapters, views
from yardline.session import settle, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables and the play-by-play views derived from them, read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        tune(spark)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    lineitem = cached_property(lambda self: self.read("lineitem"))
    orders = cached_property(lambda self: self.read("orders"))
    customer = cached_property(lambda self: self.read("customer"))
    events = cached_property(lambda self: self.read("events"))
    nation = cached_property(lambda self: self.read("nation"))
    region = cached_property(lambda self: self.read("region"))
    supplier = cached_property(lambda self: self.read("supplier"))

    @cached_property
    def plays(self) -> DataFrame:
        plays = self.spark.sql(adapters.PLAYS, lineitem=self.lineitem)
        # (play_seq, play_tie) as one number: a decimal fits the fixed-width buffers of hash aggregation
        scale = F.lit(Decimal(10) ** 19).cast("decimal(20,0)")
        seq, tie = (F.col(n).cast("decimal(18,0)") for n in ("play_seq", "play_tie"))
        return plays.withColumn("play_id", (seq * scale + tie).cast("decimal(38,0)"))

    @cached_property
    def games(self) -> DataFrame:
        # read several times by the starter and model queries; one row per game
        return settle(self.spark.sql(adapters.GAMES, plays=self.plays))

    @cached_property
    def draws(self) -> DataFrame:
        return self.spark.sql(adapters.DRAWS, events=self.events)

    @cached_property
    def snaps(self) -> DataFrame:
        # read three times by the receiver queries; one row per game and player
        return settle(self.spark.sql(adapters.SNAPS, plays=self.plays))

    @cached_property
    def depth(self) -> DataFrame:
        return self.spark.sql(adapters.DEPTH, snaps=self.snaps)

    @cached_property
    def passers(self) -> DataFrame:
        return self.spark.sql(adapters.PASSERS, plays=self.plays)

    @cached_property
    def play_rows(self) -> int:
        """Rows of the table all play views derive from: a bound on every view aggregated from plays.

        The count comes from the Parquet footers."""
        return self.lineitem.count()

    @cached_property
    def event_rows(self) -> int:
        return self.events.count()


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, so that the order of a float sum does not show; + 0.0 drops a negative zero."""
    return df.select(
        *[
            (F.round(F.col(f"`{f.name}`"), 6) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def query(name: str, sql: str | None = None, doubles: str = ""):
    """Register a function of ``Tables``; ``sql`` is the same result for the checking engine, with its
    double columns listed in ``doubles``."""

    def add(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: _rounded(fn(Tables(spark, folder)))
        if sql is not None:
            text = views.with_views(sql)
            if doubles:
                cols = ", ".join(f'round("{d}", 6) + 0.0 AS "{d}"' for d in doubles.split())
                text = f"SELECT * REPLACE ({cols}) FROM (\n{text}\n)"
            ORACLES[name] = text
        return fn

    return add
