from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderweave import jobs
from orderweave.functions.windows import DateWindow, month_to_date
from orderweave.operators.rollups import bonus_rollup
from orderweave.plans import po_tracking_month, so_tracking_inquiry
from orderweave.session import scratch_folder
from orderweave.sinks import Target, replace, replace_period, with_text_dates
from orderweave.sources import JdbcSource, Tables
from orderweave.sources.jdbc import LARGE_TABLES
from orderweave.sources.schema import COLUMNS, SOURCE_TABLES, STORED_MONTH, table_schema
from orderweave.sources.tables import collated, conform

from .random_tables import write_tables


def test_every_table_has_a_schema():
    assert set(COLUMNS) == set(SOURCE_TABLES) and len(COLUMNS) == 26
    money = {f.dataType for f in table_schema("sales_order_item").fields if f.name.startswith("decQ")}
    assert money == {T.DecimalType(18, 4)}


def test_parquet_tables_are_read_with_their_schema(spark, tmp_path):
    write_tables(tmp_path, seed=1)
    tables = Tables.parquet(spark, str(tmp_path), money=T.DoubleType())
    assert tables["sales_order"].schema.fieldNames()[:2] == ["szFSoId", "szCustPoId"]
    assert tables["sales_order"] is tables["sales_order"]


def test_conform_casts_to_the_declared_types(spark):
    df = spark.createDataFrame([("I", "P", "J", 1.5, "extra")], "szfinvoiceid string, szProductId string, szOrderItemTypeId string, decQty double, more string")
    out = conform(df, "invoice_item")
    assert out.schema == table_schema("invoice_item")


def test_padded_keys(spark):
    df = spark.createDataFrame([("ab  ", 1), ("AB", 2), ("ab", 3)], "k string, v int")
    assert collated(df).where("k = 'ab'").count() == 2
    assert collated(df, ignore_case=True).where("k = 'Ab '").count() == 3
    assert collated(df, ignore_case=True).select("k").distinct().count() == 1
    tables = Tables.from_frames(spark, {"t": df}).with_padded_keys()
    assert sorted(r["k"] for r in tables["t"].collect()) == ["AB", "ab", "ab  "]  # shown as they are


@pytest.mark.parametrize("dataset", ["month", "inquiry"])
def test_untidy_texts_give_the_tidy_dataset(spark, tmp_path, dataset):
    write_tables(tmp_path, seed=3, rows=24, ids=20)
    tidy = Tables.parquet(spark, str(tmp_path), money=T.DoubleType())

    def untidy(name):
        texts = [f.name for f in tidy[name].schema.fields if isinstance(f.dataType, T.StringType)]
        other = {c: F.concat(F.lower(c), F.lit(" ")) for c in texts}
        chosen = lambda c: F.pmod(F.xxhash64(F.lit(name), c), F.lit(2)) == 0
        return tidy[name].withColumns({c: F.when(chosen(c), other[c]).otherwise(F.col(c)) for c in texts})

    def shown(tables):
        month = DateWindow("2024-12-01", "2025-01-01")
        df = (po_tracking_month if dataset == "month" else so_tracking_inquiry)(tables.with_padded_keys(True), month)
        return sorted(tuple(v.upper().rstrip() if isinstance(v, str) else str(v) for v in r) for r in df.collect())

    rows = shown(tidy)
    assert rows == shown(Tables(spark, untidy)) and rows


def test_inquiry_window_holds_the_last_day():
    window = month_to_date(date(2024, 12, 31)).up_to_last_instant()
    assert (window.start, window.end, window.closed) == ("2024-12-01", "2024-12-31 23:59:59.999999", True)


def test_the_inquiry_job_keeps_an_order_of_the_last_noon(spark, tmp_path):
    write_tables(tmp_path, seed=7, rows=30, ids=24, blank=0.0)
    tables = Tables.parquet(spark, str(tmp_path), money=T.DoubleType())
    frames = {name: tables[name] for name in COLUMNS}
    noon = F.lit("2024-12-31 12:00:00").cast("timestamp_ntz")
    frames["sales_order"] = frames["sales_order"].withColumn("dtmOrder", noon)
    frames["sales_inquiry"] = frames["sales_inquiry"].withColumn("szFPoId", F.lit(""))
    built = jobs.build(Tables.from_frames(spark, frames), "inquiry", date(2024, 12, 31))
    assert not built.isEmpty()


def test_jdbc_options():
    bounds = {"column": "dtmOrder", "lower": "2024-01-01", "upper": "2025-01-01", "partitions": 12}
    settings = {"url": "jdbc:example://host/db", "options": {"user": "reader"}}
    with pytest.raises(ValueError, match="partition bounds"):
        JdbcSource.from_settings(settings)
    source = JdbcSource.from_settings({**settings, "partitioned": dict.fromkeys(LARGE_TABLES, bounds)})
    options = source.read_options("sales_order", SOURCE_TABLES["sales_order"])
    assert options["dbtable"] == SOURCE_TABLES["sales_order"] and options["user"] == "reader"
    assert (options["partitionColumn"], options["numPartitions"]) == ("dtmOrder", "12")
    assert options["preferTimestampNTZ"] == "true"
    assert "partitionColumn" not in source.read_options("product", SOURCE_TABLES["product"])


def test_text_dates_only_where_present(spark):
    df = spark.createDataFrame([(datetime(2024, 12, 1, 5),)], "date_created timestamp_ntz")
    assert with_text_dates(df).first()["date_created"] == "2024-12-01 05:00:00"
    other = df.withColumnRenamed("date_created", "made")
    assert with_text_dates(other).dtypes == [("made", "timestamp_ntz")]


def test_replace(spark, tmp_path):
    target = Target(path=str(tmp_path / "t"))
    replace(spark.range(5), target)
    replace(spark.range(3), target, expected=["id"])
    assert target.read(spark).count() == 3
    with pytest.raises(ValueError, match="differ"):
        replace(spark.range(3), target, expected=["other"])
    with pytest.raises(ValueError, match="repeated"):
        replace(spark.range(3).selectExpr("id", "id as ID"), target)
    with pytest.raises(ValueError):
        Target()


@pytest.mark.parametrize("kind", ["path", "table"])
def test_replace_period(spark, tmp_path, kind):
    """A re-run replaces its own rows only, whatever months they are of; without rows it empties its period."""
    target = Target(path=str(tmp_path / "t")) if kind == "path" else Target(table="period_target")

    def rows(version, *days):
        data = [(datetime(2024, m, d), version) for m, d in days]
        return spark.createDataFrame(data, "d timestamp_ntz, v int")

    def stored():
        return sorted((r.d.month, r.d.day, r.v) for r in target.read(spark).collect())

    try:
        replace_period(rows(1, (11, 3), (12, 1)), target, date(2024, 11, 1))
        replace_period(rows(1, (12, 1), (12, 9)), target, date(2024, 12, 1))
        replace_period(rows(2, (11, 3), (12, 1)), target, date(2024, 11, 30))
        assert stored() == [(11, 3, 2), (12, 1, 1), (12, 1, 2), (12, 9, 1)]
        if kind == "table":
            spark.catalog.refreshTable("period_target")
        replace_period(rows(3), target, date(2024, 11, 1))
        assert stored() == [(12, 1, 1), (12, 9, 1)]
    finally:
        spark.sql("drop table if exists period_target")


def test_scratch_folder_is_below_the_shared_folder(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    folder = scratch_folder(spark)
    assert folder != scratch_folder(spark)
    assert shared is None or folder.startswith(shared.removeprefix("file:"))


def test_job_loads_a_dataset(spark, tmp_path):
    source, warehouse = tmp_path / "source", tmp_path / "warehouse"
    source.mkdir()
    write_tables(source, seed=7, rows=30, ids=24, blank=0.0)
    arguments = ["--source", str(source), "--target", str(warehouse), "--day", "2024-12-31"]
    _write_as_decimal(spark, source)
    jobs.main(["month", *arguments])
    loaded = Target(path=f"{warehouse}/po_tracking_mtd").read(spark)
    assert dict(loaded.dtypes)["date_created"] == "string" and len(loaded.columns) == 22
    jobs.main(["quarter", *arguments, "--by-period"])
    loaded = Target(path=f"{warehouse}/po_tracking_3m").read(spark)
    assert len(loaded.columns) == 25 and "period" in loaded.columns


def test_job_options(spark, tmp_path):
    source, warehouse = tmp_path / "source", tmp_path / "warehouse"
    source.mkdir()
    write_tables(source, seed=7, rows=30, ids=24, blank=0.0)
    _write_as_decimal(spark, source)
    common = ["--source", str(source), "--target", str(warehouse)]
    jobs.main(["copy", *common, "--name", "customer"])
    copied = Target(path=f"{warehouse}/customer").read(spark)
    assert copied.columns == table_schema("customer").fieldNames() and not copied.isEmpty()
    distributors = copied.select(F.col("szCustId").alias("id"), F.lit("north").alias("region"))
    distributors.distinct().write.parquet(str(tmp_path / "distributors"))
    extra = ["--distributors", str(tmp_path / "distributors"), "--distributor-key", "szCustId", "id"]
    jobs.main(["no-inquiry", *common, "--day", "2024-12-31", "--ignore-case", *extra])
    loaded = Target(path=f"{warehouse}/so_tracking_no_inquiry").read(spark)
    assert {"id", "region", "szFSoId"} <= set(loaded.columns) and loaded.count() >= 0


def _write_as_decimal(spark, source):
    doubles = Tables.parquet(spark, str(source), money=T.DoubleType())
    for name in COLUMNS:
        frame = conform(spark.createDataFrame(doubles[name].collect(), doubles[name].schema), name)
        frame.coalesce(1).write.mode("overwrite").parquet(f"{source}/{name}")


def test_staged_tables_are_joined_in_place(spark, tmp_path):
    write_tables(tmp_path, seed=7, rows=30, ids=24, blank=0.0)
    parquet = Tables.parquet(spark, str(tmp_path), money=T.DoubleType())
    spark.sql(f"create database staged location '{tmp_path / 'staged'}'")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        jobs.stage(parquet, "staged", buckets=8)
        staged = Tables.catalog(spark, "staged", money=T.DoubleType(), bucketed=True, by_month=True)

        def rollup(tables):
            return bonus_rollup(tables["sales_order_item"], tables["bonus_source"])

        assert "Exchange" not in rollup(staged)._jdf.queryExecution().executedPlan().toString()
        key = list(rollup(staged).columns)
        assert rollup(staged).select(key).exceptAll(rollup(parquet).select(key)).isEmpty()
        assert rollup(staged).count() == rollup(parquet).count() > 0
        month = DateWindow("2024-12-01", "2025-01-01")
        for dataset in (po_tracking_month, so_tracking_inquiry):
            plan = dataset(staged, month)._jdf.queryExecution().executedPlan().toString()
            headers = [line for line in plan.splitlines() if "FileScan" in line and STORED_MONTH in line]
            assert any("PartitionFilters" in h and f"({STORED_MONTH}#" in h and ">= 2024-12" in h for h in headers)
        built = [po_tracking_month(t, month) for t in (staged, parquet)]
        assert built[0].exceptAll(built[1]).isEmpty() and built[0].count() == built[1].count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop database staged cascade")
