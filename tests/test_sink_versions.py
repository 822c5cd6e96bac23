"""Loads switch in one step, and later ones must fit what the first one stored."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderweave.sinks import Target, replace, replace_period, replace_periods
from orderweave.sinks.versions import KEPT, Versions

NOV, DEC = date(2024, 11, 1), date(2024, 12, 1)


@pytest.fixture(params=["path", "table", "bucketed"])
def target(request, spark, tmp_path):
    if request.param == "path":
        yield Target(path=str(tmp_path / "it's a target"))
        return
    name = f"versioned_{request.param}"
    yield Target(table=name, **({"buckets": 3, "bucket_column": "id"} if request.param == "bucketed" else {}))
    spark.sql(f"drop table if exists {name}")


def rows(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}") for i in ids], "id int, name string")


def stored(spark, target, *columns):
    return sorted(tuple(r) for r in target.read(spark).select(*(columns or ("id", "name"))).collect())


def failing(spark):
    broken = F.when(F.col("id") == 7, F.raise_error(F.lit("halfway"))).otherwise(F.col("name"))
    return rows(spark, 5, 6, 7).repartition(3).withColumn("name", broken.cast("string"))


def test_a_load_that_fails_leaves_the_old_rows(spark, target):
    replace(rows(spark, 1, 2), target)
    replace(rows(spark, 3, 4), target)
    with pytest.raises(PySparkException):
        replace(failing(spark), target)
    assert stored(spark, target) == [(3, "n3"), (4, "n4")]
    replace(rows(spark), target)
    assert stored(spark, target) == []
    replace(rows(spark, 9), target)
    assert stored(spark, target) == [(9, "n9")]


def test_a_reader_that_began_before_the_switch_ends(spark, tmp_path):
    target = Target(path=str(tmp_path / "t"))
    replace(rows(spark, 1, 2), target)
    before = target.read(spark)
    replace(rows(spark, 3), target)
    assert before.count() == 2 and target.read(spark).count() == 1
    for i in range(6):
        replace(rows(spark, i), target)
    folders = list((tmp_path / "t" / "_data").iterdir())
    assert len(folders) == KEPT and len(list((tmp_path / "t" / "_log").glob("*.json"))) == KEPT


def test_a_load_overtaken_by_another_is_refused(spark, tmp_path):
    target = Target(path=str(tmp_path / "t"))
    replace(rows(spark, 1), target)
    versions = Versions(spark, target.path)
    before = versions.last()
    replace(rows(spark, 2), target)
    with pytest.raises(RuntimeError, match="another load"):
        versions.commit(before, before.schema, before.parts)
    assert stored(spark, target) == [(2, "n2")]


@pytest.mark.parametrize("load", [lambda df, t: replace(df, t), lambda df, t: replace_period(df, t, NOV)], ids=["whole", "period"])
def test_columns_go_where_their_names_say(spark, target, load):
    load(rows(spark, 1), target)
    load(rows(spark, 2).select("name", F.col("id").cast("short").alias("ID")), target)
    assert stored(spark, target) == [(2, "n2")]
    assert [c for c in target.read(spark).columns if c != "period"] == ["id", "name"]
    for refused, message in (
        (rows(spark, 3).drop("name"), "missing \\['name'\\]"),
        (rows(spark, 3).withColumn("more", F.lit(1)), "not stored there \\['more'\\]"),
        (rows(spark, 3).withColumn("id", F.col("id").cast("long")), "id is bigint, stored as int"),
        (rows(spark, 3).withColumn("id", F.col("name")), "id is string"),
    ):
        with pytest.raises(ValueError, match=message):
            load(refused, target)
    assert stored(spark, target) == [(2, "n2")]


def test_a_new_schema_has_to_be_said(spark, target):
    replace(rows(spark, 1), target)
    with pytest.raises(ValueError, match="differ"):
        replace(rows(spark, 2).withColumn("more", F.lit(1)), target)
    replace(rows(spark, 2).withColumn("more", F.lit(1)), target, new_schema=True)
    assert stored(spark, target, "id", "more") == [(2, 1)]


@pytest.mark.parametrize("kind", ["path", "table"])
def test_periods_switch_one_by_one(spark, tmp_path, kind):
    target = Target(path=str(tmp_path / "t")) if kind == "path" else Target(table="versioned_periods")
    try:
        for month, ids in ((NOV, (1, 2)), (DEC, (3,)), (NOV, (4,))):
            replace_period(rows(spark, *ids), target, month)
        with pytest.raises(PySparkException):
            replace_period(failing(spark), target, DEC)
        assert stored(spark, target, "id", "period") == [(3, "2024-12"), (4, "2024-11")]
        assert [r.id for r in target.read(spark, ["2024-12"]).collect()] == [3]
        replace_period(rows(spark), target, DEC)
        assert stored(spark, target, "id", "period") == [(4, "2024-11")]
    finally:
        spark.sql("drop table if exists versioned_periods")


@pytest.mark.parametrize("kind", ["path", "table"])
def test_many_periods_in_one_load(spark, tmp_path, kind):
    target = Target(path=str(tmp_path / "t")) if kind == "path" else Target(table="versioned_many")
    dated = lambda v, *days: spark.createDataFrame([(d, v) for d in days], "d string, v int").selectExpr("cast(d as date) as d", "v")
    try:
        replace_periods(dated(1, "2024-10-03", "2024-11-01", "2024-11-30", "2024-12-01"), target, "d")
        replace_periods(dated(2, "2024-11-05", "2025-01-01"), target, "d")
        replace_period(dated(3, "2024-12-09"), target, DEC)
        assert sorted((str(r.d), r.v, r.period) for r in target.read(spark).collect()) == [
            ("2024-10-03", 1, "2024-10"), ("2024-11-05", 2, "2024-11"), ("2024-12-09", 3, "2024-12"), ("2025-01-01", 2, "2025-01")]
        with pytest.raises(PySparkException):
            replace_periods(dated(4, "2024-10-03", None), target, "d")
        assert target.read(spark).count() == 4
    finally:
        spark.sql("drop table if exists versioned_many")
