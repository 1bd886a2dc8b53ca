"""Fixed expected values of scalar functions, checks and sinks."""

import uuid

import pytest
from pyspark.sql import functions as F

from yardline.functions import scalars as S
from yardline.operators import columns, joins, sets
from yardline.plans import builders, evaluate, ratings, schedule
from yardline.plans.features import shrink, zscore_filter
from yardline.sources import schemas, tables


def one(spark, **cols):
    return spark.range(1).select(*[v.alias(k) for k, v in cols.items()]).first()


def test_scalars(spark):
    lit = F.lit
    r = one(
        spark,
        a=S.half_even(lit(0.125), 2), b=S.moneyline_probability(lit(-150)), c=S.moneyline_probability(lit(130)),
        d=S.without_margin(S.moneyline_probability(lit(-150)), S.moneyline_probability(lit(130))),
        e=S.haversine(lit(25.95796), lit(-80.239311), lit(51.556), lit(-0.2796)),
        f=S.zfill(lit(7), 2), g=S.zfill(lit(123), 2), h=S.normalise_name(lit("T. Taylor")), i=S.normalise_name(lit("Cher")),
        j=S.game_date(lit(2010), lit(1107)), k=S.game_date(lit(2010), lit(103)), l=S.franchise(lit("OAK"), lit(2019)),
        m=S.franchise(lit("OAK"), lit(2020)), n=S.band_score(lit(35)), o=S.band_score(lit(6)), p=S.band_score(lit(21)),
        q=S.build_game_id(lit(2016), lit(3), lit("A"), lit("B")), r=S.flag(lit(None).cast("boolean")),
        s=S.map_value(lit("x"), {"a": 1}), t=shrink(lit(10.0), lit(4.0), lit(3), 3),
        u=S.interval_residual(lit(1.0), lit(3.0), lit(5.0)), v=S.season_of(S.game_date(lit(2010), lit(103))),
    )
    assert r.a == 0.12 and r.b == pytest.approx(0.6) and r.c == pytest.approx(0.43478260869565217)
    assert r.d == pytest.approx(0.5798319327731092) and r.e == pytest.approx(7102.912955, abs=1e-6)
    assert (r.f, r.g, r.h, r.i) == ("07", "123", "T.Taylor", "Cher")
    assert (str(r.j), str(r.k)) == ("2010-11-07", "2011-01-03")
    assert (r.l, r.m, r.n, r.o, r.p) == ("LV", "OAK", -4, 7, 0)
    assert r.q == "2016_03_A_B" and r.r == 0 and r.s is None and r.t == 7 and r.u == 2 and r.v == 2010


def test_quantile_bins(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 2, 2, 3, 4, 5, 6])], "i int, x double")
    rows = evaluate.quantile_bins(df, "x", 4).orderBy("i").collect()
    assert [r.bin - 1 for r in rows] == [0, 0, 0, 0, 2, 2, 3, 3]


def test_conformal_rank(spark):
    resid = [0.0] * 8 + [1.0, 4.0]
    df = spark.createDataFrame([(0.0, 0.0, r) for r in resid], "lo double, hi double, y double")
    assert evaluate.conformal_adjustment(df, "y", "lo", "hi").first().adjustment == 4
    assert evaluate.conformal_adjustment(df.limit(8), "y", "lo", "hi").first().adjustment is None


def test_james_stein_factor(spark):
    df = spark.createDataFrame([(v,) for v in (4.0, -2.0, 1.0, -3.0)], "theta double")
    rows = ratings.james_stein(df, "theta", 2.0).collect()
    assert all(r.js == pytest.approx(0.8666666666666667 * r.theta) for r in rows)


def test_sum_of_nulls_is_zero(spark):
    from yardline.operators.aggregates import total

    df = spark.createDataFrame([("a", None), ("a", None)], "k string, x int")
    assert df.groupBy("k").agg(total("x").alias("s")).first().s == 0


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError, match="missing columns: z"):
        schemas.require_columns(df, ["k", "z"])
    with pytest.raises(ValueError, match="not unique"):
        joins.validated_join(df, df.withColumnRenamed("v", "w"), ["k"])
    with pytest.raises(ValueError):
        builders.game_stats(df, min_season=1999)
    with pytest.raises(ValueError):
        builders.adjusted_epa(df)
    with pytest.raises(ValueError):
        tables.append_table(None, "t")
    with pytest.raises(ValueError):
        sets.chrono_split(df, ["k"])


def test_stadiums_keep_first_after_trimming(spark):
    df = spark.createDataFrame([(0, "Dome ", 1.0), (1, "Dome", 2.0), (2, "Park", 3.0)], "row int, stadium string, lat double")
    got = {r.stadium: r.lat for r in schedule.clean_stadiums(df, ["row"]).collect()}
    assert got == {"Dome": 1.0, "Park": 3.0}


def test_zscore_drops_single_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 2.0)], "k string, x double")
    assert {r.k for r in zscore_filter(df, ["k"], "x").collect()} == {"b"}


def test_fill_ramp(spark):
    df = spark.createDataFrame([(i, None if i < 18 else 1.0) for i in range(20)], "t int, x double")
    rows = columns.fill_ramp(df, "x", ["t"], 250.0, 215.0, 18).orderBy("t").collect()
    assert rows[0].x == 250 and rows[17].x == pytest.approx(215) and rows[19].x == 1


def test_table_lifecycle(spark):
    name = f"t_{uuid.uuid4().hex}"
    df = spark.range(10)
    tables.create_table(df, name)
    assert tables.read_table(spark, name).count() == 0
    tables.append_table(df, name)
    tables.append_table(df, name)
    assert tables.read_table(spark, name).count() == 20
    assert tables.read_table(spark, name, "id > 8", ["id"]).count() == 2
    tables.overwrite_table(df, name)
    assert tables.read_table(spark, name).count() == 10
    tables.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_file_name_year(spark, tmp_path):
    for year in (2007, 2008):
        spark.range(3).coalesce(1).write.csv(str(tmp_path / f"nfl odds {year}.csv"))
    df = spark.read.schema("id long").option("recursiveFileLookup", True).csv(str(tmp_path))
    got = tables.with_path_year(df, "odds%20").groupBy("year").count().collect()
    assert sorted((r.year, r["count"]) for r in got) == [(2007, 3), (2008, 3)]


def test_two_game_weekend_dates(spark):
    days = ["2010-09-09", "2010-09-12", "2010-09-13", "2010-09-16", "2010-09-18", "2010-09-19"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("date_dt"))
    got = {str(r.date_dt): r.week for r in schedule.week_numbers(df).collect()}
    assert got == {"2010-09-09": 1, "2010-09-12": 1, "2010-09-13": 1, "2010-09-16": 1, "2010-09-18": 2, "2010-09-19": 2}
