"""Rules over sets of rows: NULLs, empty tables, hot keys and what is read."""

from datetime import timedelta

import pytest
from helpers import rows, utc
from pyspark.sql import functions as F

from gridlake.operators import setrules

SCHEMA = "id long, kind string, seen timestamp, value double"


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def all_rules(spark):
    kinds = spark.createDataFrame([("a",), ("a",), (None,)], "kind string")
    return [
        setrules.Row("positive", F.col("value") > 0),
        setrules.Unique("one_id", ("id",)),
        setrules.Unique("one_pair", ("id", "kind")),
        setrules.Reference("known_kind", ("kind",), kinds),
        setrules.Fresh("recent_kind", ("kind",), "seen", utc(2024, 1, 3), timedelta(days=1)),
    ]


def test_nulls_and_repeats(spark):
    df = table(
        spark,
        [
            (1, "a", utc(2024, 1, 1), 1.0),
            (1, "a", utc(2024, 1, 2), -1.0),
            (1, None, None, None),
            (None, "b", utc(2024, 1, 1), 2.0),
            (None, "b", utc(2024, 1, 1), float("nan")),
        ],
    )
    found = setrules.check(df, all_rules(spark))
    assert rows(found.report) == sorted(
        [
            ("positive", "row", 5, 2, False),  # the negative and the missing value; NaN is larger than any number
            ("one_id", "unique", 5, 3, False),
            ("one_pair", "unique", 5, 2, False),
            ("known_kind", "reference", 4, 2, False),
            ("recent_kind", "fresh", 3, 2, False),
        ]
    )
    assert rows(found.offenders.drop("latest")) == sorted(
        [
            ("one_id", '{"id":1}', 3),
            ("one_id", '{"id":null}', 2),
            ("one_pair", '{"id":1,"kind":"a"}', 2),
            ("one_pair", '{"id":null,"kind":"b"}', 2),
            ("known_kind", '{"kind":"b"}', 2),
            ("recent_kind", '{"kind":"b"}', 2),
            ("recent_kind", '{"kind":null}', 1),
        ]
    )


def test_empty_table_passes(spark):
    found = setrules.check(table(spark, []), all_rules(spark))
    assert {(r.checked, r.failed, r.passed) for r in found.report.collect()} == {(0, 0, True)}
    assert found.offenders.count() == 0


def test_row_rules_alone_and_bad_names(spark):
    df = table(spark, [(1, "a", None, 1.0)])
    assert rows(setrules.check(df, [setrules.Row("positive", F.col("value") > 0)]).report) == [("positive", "row", 1, 0, True)]
    with pytest.raises(ValueError):
        setrules.check(df, [setrules.Unique("x", ("id",)), setrules.Unique("x", ("kind",))])
    with pytest.raises(ValueError):
        setrules.check(df, [])


def test_rows_are_read_once_and_hot_keys_are_added_up_before_the_shuffle(spark):
    df = spark.range(0, 200_000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("kind"))
    df = df.withColumns({"seen": F.lit(utc(2024, 1, 3)), "value": F.lit(1.0)})
    rules = all_rules(spark)
    cells = setrules._cells(df, rules[:1], rules[1:])
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert plan.index("partial_count") > plan.index("Exchange")  # printed from the result down: below the exchange
    assert setrules.check(df, rules).report.filter("rule = 'one_id'").first()["failed"] == 0
