from helpers import rows, utc
from pyspark.sql import functions as F

from gridlake.functions import keys, measures, taxonomy, timeslots


def _times(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast("timestamp").alias("ts"))


def test_half_hour_markers(spark):
    df = _times(spark, *[f"2024-03-01 10:{m:02d}:00" for m in (0, 14, 15, 29, 30, 59)])
    for mode, expected in {"floor": [0, 0, 0, 0, 30, 30], "legacy15": [0, 0, 30, 30, 30, 30]}.items():
        got = df.select("ts", timeslots.half_hour_marker(F.col("ts"), mode).alias("m"), timeslots.half_hour_slot(F.col("ts"), mode).alias("s")).orderBy("ts").collect()
        assert [r.m for r in got] == expected
        assert [r.s.minute for r in got] == expected and all(r.s.hour == 10 for r in got)


def test_slot_before_1970(spark):
    got = _times(spark, "1969-12-31 23:50:00").select(timeslots.half_hour_slot(F.col("ts")).cast("string")).first()[0]
    assert got == "1969-12-31 23:30:00"


def test_slot_contains_time(spark):
    df = spark.range(-100_000, 100_000, 37).select(F.timestamp_seconds(F.col("id") * 60).alias("ts"))
    slot = timeslots.half_hour_slot(F.col("ts"))
    assert df.filter((slot > F.col("ts")) | (F.col("ts") >= slot + F.expr("interval 30 minutes"))).isEmpty()


def test_periods(spark):
    df = spark.createDataFrame([("01.2002",), ("1.2002",), ("13.2002",), ("x",), (None,)], "p string")
    got = rows(df, "p", timeslots.period_start(F.col("p")).cast("string"), timeslots.period_well_formed(F.col("p")))
    assert got == [
        (None, None, None),
        ("01.2002", "2002-01-01 00:00:00", True),
        ("1.2002", "2002-01-01 00:00:00", False),
        ("13.2002", None, True),
        ("x", None, False),
    ]


def test_seasons(spark):
    got = spark.range(1, 13).select(timeslots.season(F.col("id"))).collect()
    names = [r[0] for r in got]
    assert names == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"]


def test_types(spark):
    names = ["Wind offshore", " wind ONSHORE ", "Hydro pumped storage", "Fossil coal-derived gas", "Geothermal ", "pv roof", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    fine = [r[0] for r in df.select(taxonomy.standardize_type(F.col("n"))).collect()]
    coarse = [r[0] for r in df.select(taxonomy.standardize_type(F.col("n"), "coarse")).collect()]
    # The last word rule also finds "other" inside "geothermal", as in the original rules.
    assert fine == ["Wind offshore", "Wind onshore", "Hydro", "Coal", "Other", "pv roof", None]
    assert coarse == ["Wind", "Wind", "Hydro", "Fossil", "Geothermal", "Solar PV", None]


def test_attributes(spark):
    names = ["Hydro Run-of-River", "Cross border trading", "Battery storage (capacity)", "Fossil hard coal", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(taxonomy.production_attributes(F.col("n"))).collect()]
    assert [r and tuple(r)[:3] for r in got] == [
        ("Hydro", "Renewable", "Controllable"),
        ("Cross Border Trading", "Mixed", "Mixed"),
        ("Battery Storage", "Renewable", "Mixed"),
        ("Coal", "Non-Renewable", "Controllable"),
        None,
    ]


def test_title_case_equals_python(spark):
    names = ["Hydro Run-of-River", "Battery storage (capacity)", "load", "a1b c'd", "OTHERS/misc", ""]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(taxonomy.title_case(F.col("n"))).collect()] == [n.lower().title() for n in names]


def test_keys_keep_null_parts_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), (None, "a", "b")], "x string, y string, z string")
    columns = [F.col(c) for c in "xyz"]
    assert df.select(keys.hashed_key(*columns)).distinct().count() == 3
    shape = df.select(keys.uuid_shaped(F.col("y")).alias("u")).filter("u is not null").first().u
    assert len(shape) == 36 and shape[14] == "4" and shape[19] == "a"


def test_measures(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (-1.0,), (1.005,), (2.346,)], "x double")
    got = [r[0] for r in df.select(measures.cleansed(F.col("x"))).collect()]
    assert got[:3] == [0.0, 0.0, 0.0] and got[4] == 2.35
    zero = spark.range(1).select(measures.deviation_pct(F.lit(1.0), F.lit(0.0))).first()[0]
    assert zero is None


def test_as_of_is_an_instant(spark):
    assert spark.range(1).select(F.lit(utc(2024, 1, 31)).cast("string")).first()[0] == "2024-01-31 00:00:00"
