"""Stages, one run for four datasets, refreshed roll-ups, generated database partitions, dates as the source writes them."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderweave import jobs
from orderweave.functions.windows import DateWindow, last_months
from orderweave.operators.state import RollupState
from orderweave.plans import Stages, po_tracking_by_delivery, po_tracking_month, so_tracking_inquiry
from orderweave.plans.chain import Chain
from orderweave.plans.stages import _BLOOM
from orderweave.sinks import Target, with_source_text_dates
from orderweave.sources import JdbcSource, Tables
from orderweave.sources.predicates import hash_predicates, month_predicates, month_starts, read_predicates

from .random_tables import write_tables

DAY = date(2024, 12, 31)


@pytest.fixture
def tables(spark, tmp_path):
    write_tables(tmp_path, seed=7, rows=30, ids=24, blank=0.0)
    return Tables.parquet(spark, str(tmp_path), money=T.DoubleType())


def test_one_run_loads_what_four_runs_do(spark, tables, tmp_path):
    targets = {name: Target(path=str(tmp_path / "all" / name)) for name in jobs.TARGETS}
    stages = Stages(spark, window=last_months(DAY, 3))
    jobs.run_all(tables, DAY, targets, stages=stages)
    for name, target in targets.items():
        alone = Target(path=str(tmp_path / "alone" / name))
        jobs.load(jobs.build(tables, name, DAY), alone)
        together, alone = target.read(spark), alone.read(spark)
        assert together.schema == alone.schema and together.count() == alone.count()
        assert together.exceptAll(alone).isEmpty()
    kinds = {name.split("-")[0] for name in stages._frames}
    assert {"linked", "unlinked", "bonuses", "delivered", "unnamed"} <= kinds
    assert sum(name.startswith("linked") for name in stages._frames) == 1  # one set of headers for three datasets


def test_one_run_reads_each_side_table_once(spark, tables, tmp_path, monkeypatch):
    """Also where the ids are too many to be broadcast, and where they compare without case and trailing blanks."""
    monkeypatch.setattr("orderweave.plans.stages._BLOOM", {**_BLOOM, next(iter(_BLOOM)): "0"})
    read, filtered = Counter(), []

    class Seen(Stages):
        def stored(self, name, build):
            def seen():
                df = build()
                if name.startswith("run-"):
                    filtered.append("might_contain" in df._jdf.queryExecution().optimizedPlan().toString())
                return df

            return super().stored(name, seen)

    def picked(chain, table, pick=Chain.pick, **names):
        read[table] += 1
        return pick(chain, table, **names)

    untidy = lambda df: df.withColumns({c: F.when(F.length(c) % 2 == 0, F.concat(F.lower(c), F.lit(" "))).otherwise(F.col(c)) for c, kind in df.dtypes if kind == "string" and c.startswith("sz") and c.endswith("oId")})
    padded = Tables(spark, lambda name: untidy(tables[name])).with_padded_keys(ignore_case=True)
    targets = {name: Target(path=str(tmp_path / "all" / name)) for name in jobs.TARGETS}
    stages = Seen(spark, window=last_months(DAY, 3))
    before = [spark.conf.get(key) for key in _BLOOM]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with monkeypatch.context() as counted:
            counted.setattr(Chain, "pick", picked)
            jobs.run_all(padded, DAY, targets, stages=stages)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name in "sales_order_item bonus_source delivery_confirmation delivery_confirmation_item delivery_note delivery_note_item transfer_log cancel_log approval approval_item".split():
        assert read[name] == 1, (name, read)
    assert any(filtered) and [spark.conf.get(key) for key in _BLOOM] == before
    for name, target in targets.items():
        alone = Target(path=str(tmp_path / "alone" / name))
        jobs.load(jobs.build(padded, name, DAY), alone)
        together, alone = target.read(spark), alone.read(spark)
        assert together.count() == alone.count() and together.exceptAll(alone).isEmpty()


def test_ids_of_a_wide_window_cut_nothing(spark, tables):
    """Its ids are nearly all there are: no side table is shuffled to be cut by them. Those of a week cut."""
    semi = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi")
    for start, end, wide in (("1990-01-01", "2040-01-01", True), ("2024-12-01", "2024-12-08", False)):
        window = DateWindow(start, end)
        staged, plain = po_tracking_month(tables, window, stages=Stages(spark)), po_tracking_month(tables, window)
        assert (semi(staged) == 0) == wide
        assert staged.count() == plain.count() and staged.exceptAll(plain).isEmpty()


def test_item_rows_of_stored_headers_are_dealt_by_order_once(spark, tables, tmp_path):
    """What notes and invoices have for them comes to their order; the wide rows, and their DISTINCT, are not shuffled again."""
    window = DateWindow("1990-01-01", "2040-01-01")

    def dealt(df, *keys):
        """How often rows are dealt by each of the keys, and by more than ten columns."""
        exchanges = [line.split("Exchange hashpartitioning(")[1] for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning(" in line]
        return [sum(by.startswith(key) for by in exchanges) for key in keys]

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        inquiry = so_tracking_inquiry(tables, window, stages=Stages(spark, folder=str(tmp_path / "stages")))
        stored = {path.name.split("-")[0] for path in (tmp_path / "stages").iterdir()}
        assert {"documents", "lines", "noted"} <= stored and "approved" not in stored  # the headers half looked up are gone
        # one each for inquiries without an order, which are not dealt by it
        assert dealt(inquiry, "si_dn#", "coalesce(invoice_id#") == [1, 1]
        quarter = po_tracking_by_delivery(tables, window, window, stages=Stages(spark))
        assert dealt(quarter, "si_dn#", "soi_product#") == [0, 1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for staged, plain in (
        (inquiry, so_tracking_inquiry(tables, window)),
        (quarter, po_tracking_by_delivery(tables, window, window)),
    ):
        assert staged.count() == plain.count() > 0
        assert staged.exceptAll(plain).isEmpty()


def test_orders_that_no_kept_header_names_are_cut_before_the_shuffle(spark, tables):
    """Of a wide window too: items and discounts of customers in no channel are not stored."""
    window = DateWindow("1990-01-01", "2040-01-01")
    built = {}

    class Seen(Stages):
        def within(self, *arguments):
            built["inner"] = super().within(*arguments)
            return built["inner"]

    po_tracking_by_delivery(tables, window, window, stages=Seen(spark))
    frames = built["inner"]._frames
    kept = {r[0] for r in built["inner"].run_orders.collect()}
    whole = Chain(tables)
    for name, key in (("order_lines", "soi_so"), ("bonus_source", "szFSoId"), ("delivered_items", "custOrderNo")):
        found = sorted(r[0] for r in frames[f"run-{name}"].select(key).collect())
        assert found == sorted(r[0] for r in getattr(whole, name)().select(key).collect() if r[0] in kept)
        assert len(found) < getattr(whole, name)().count()


def test_a_stored_stage_leaves_no_shuffle_files(spark):
    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = files(), spark.conf.get(setting)
    stages = Stages(spark)
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    twice = stages.together(*[lambda name=name: stages.stored(name, lambda: counted.repartition(3, "k")) for name in ("one", "two")])
    assert [df.count() for df in twice] == [7, 7]
    assert spark.conf.get(setting) == before[1]
    stages.stored("three", lambda: counted)
    found = {f.split("_")[1] for f in files() - before[0]}
    assert len(found) <= 2  # of the two counts


def test_a_clean_month_has_no_salts_and_filtered_sides(spark, tables):
    window = DateWindow("2024-12-01", "2025-01-01", closed=True)
    physical = lambda df: df._jdf.queryExecution().executedPlan().toString()
    plans: list[str] = []

    class Seen(Stages):
        def stored(self, name, build):
            def seen():
                df = build()
                plans.append(physical(df))
                return df

            return super().stored(name, seen)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plans.append(physical(so_tracking_inquiry(tables, window, stages=Seen(spark))))
        lazy = physical(so_tracking_inquiry(tables, window))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "Generate" in lazy and not any("Generate" in plan for plan in plans)
    sides = "approval_item delivery_order invoice delivery_note note_closing_item delivery_note_item transfer_log cancel_log delivery_confirmation invoice_item goods_receipt"
    for table in sides.split():
        found = 0
        for lines in (plan.splitlines() for plan in plans):
            for at in (i for i, line in enumerate(lines) if "FileScan" in line and f"/{table}]" in line):
                # a node is printed before its inputs: the nearest join above a side's scan is the one that cuts it
                joins = [line for line in lines[:at] if "Join" in line or "HashAggregate" in line]
                # the latest replacement of all history, one row, brings its own delivery and invoice
                assert "LeftSemi" in joins[-1] or table in ("delivery_order", "invoice", "invoice_item"), (table, joins[-1])
                found += "LeftSemi" in joins[-1]
        assert found, table


def test_heavy_ids_are_found_and_salted(spark, tables):
    stages = Stages(spark, heavy_rows=10)
    df = spark.createDataFrame([("hot",)] * 50 + [(None,)] * 20 + [(f"k{i}",) for i in range(300)] + [("",)] * 11, "k string")
    stages.watch("frame", df, ("k",))
    assert set(stages.heavy("k")) == {"hot", "", None} and stages.heavy("other") == ()
    assert not stages.is_empty("frame", df)


@pytest.mark.parametrize("kind", ["path", "table"])
def test_refreshed_rollups_equal_a_full_one(spark, tmp_path, kind):
    target = Target(path=str(tmp_path / "state")) if kind == "path" else Target(table="state_of_sums")
    items: list[tuple[str, int]] = []

    def rollup(ids):
        known = spark.createDataFrame(items, "doc string, v int")
        return known.join(ids, "doc", "left_semi").groupBy("doc").agg(F.sum("v").alias("total"))

    state = RollupState(target, "doc", rollup)
    dates = lambda *rows: spark.createDataFrame(rows, "doc string, d string").withColumn("d", F.to_date("d"))
    found = lambda: sorted((r.doc, r.total, r.period) for r in target.read(spark).collect())
    try:
        items += [("a", 1), ("a", 2), ("b", 5), ("c", 7), ("null", 1)]
        assert state.refresh(dates(("a", "2024-10-01"), ("b", "2024-11-30"), ("c", "2024-11-02"), ("null", None), (None, "2024-10-01")), "d") == ["2024-10", "2024-11"]
        assert found() == [("a", 3, "2024-10"), ("b", 5, "2024-11"), ("c", 7, "2024-11")]
        items += [("a", 10), ("d", 4), ("d", 4)]
        assert state.refresh(dates(("a", "2024-10-01"), ("d", "2024-12-01"), ("d", "2024-12-03")), "d") == ["2024-10", "2024-12"]
        assert found() == [("a", 13, "2024-10"), ("b", 5, "2024-11"), ("c", 7, "2024-11"), ("d", 8, "2024-12")]
        # moved to another month, without rows, without a date
        items[:] = [i for i in items if i[0] != "c"]
        state.refresh(dates(("b", "2024-12-30"), ("c", "2024-11-02"), ("d", None)), "d")
        assert found() == [("a", 13, "2024-10"), ("b", 5, "2024-12")]
    finally:
        spark.sql("drop table if exists state_of_sums")


def test_predicates_part_a_table():
    window = DateWindow("2024-11-15", "2025-02-01")
    assert month_starts(window) == ["2024-11-15", "2024-12-01", "2025-01-01", "2025-02-01"]
    con = duckdb.connect()
    con.execute("""create table t as select i, case when i % 13 = 0 then null else timestamp '2024-09-01' + to_hours(i * 7) end as d,
        case when i % 11 = 0 then null when i % 5 = 0 then '' else 'k' || (i % 40) end as k from range(1000) r(i)""")
    whole = con.execute("select count(*) from t").fetchone()[0]
    for predicates in (
        hash_predicates("k", 7, "hash({key})"),
        hash_predicates("k", 1),
        month_predicates("d", window),
        read_predicates("k", "d", window, 4, "hash({key})"),
        read_predicates(None, "d", window, 4),
        read_predicates("k", None, window, 3, "hash({key})"),
    ):
        counts = [con.execute(f"select count(*) from t where {p}").fetchone()[0] for p in predicates]
        together = con.execute(f"select count(*) from t where {' or '.join(f'({p})' for p in predicates)}").fetchone()[0]
        assert sum(counts) == together == whole
    months = [p for p in month_predicates("d", window)]
    assert con.execute(f"select min(d) >= timestamp '2024-12-01' and max(d) < timestamp '2025-01-01' from t where {months[2]}").fetchone()[0]


def test_reads_without_bounds_are_split_by_month_and_key(monkeypatch):
    source = JdbcSource("jdbc:example://host/db", {"user": "reader"}, buckets=4)
    window = last_months(DAY, 3)
    headers = source.predicates("sales_order", window)
    assert len(headers) == (1 + 3 + 1) * 4 + 1 and "dtmOrder >= '2024-11-01' AND dtmOrder < '2024-12-01'" in headers[8]
    assert len(source.predicates("sales_order_item", window)) == 4 and source.predicates("product", window) == []
    seen = {}

    class Reader:
        def jdbc(self, url, table, predicates, properties):
            seen.update(url=url, table=table, predicates=predicates, properties=properties)

    class Session:
        read = Reader()

    source.read(Session(), "sales_order", "orders", window)
    assert (seen["url"], seen["table"], seen["predicates"]) == ("jdbc:example://host/db", "orders", headers)
    assert seen["properties"]["user"] == "reader" and "dbtable" not in seen["properties"]


@pytest.mark.parametrize("times", [
    ["2024-12-01", "2024-12-31"],
    ["2024-12-01", "2024-12-31 00:00:01"],
    ["2024-12-01", "2024-12-31 00:00:01.250"],
    ["2024-12-01 10:00:00.25", "2024-12-31 00:00:01.000007", "2024-12-02"],
    ["2024-12-01", None, "2024-12-31"],
    ["2024-12-01 05:00:00", None],
    [None, None],
])
def test_dates_take_the_form_of_their_column(spark, times):
    parsed = [None if t is None else datetime.fromisoformat(t) for t in times]
    expected = pd.Series(pd.to_datetime(pd.Series(parsed))).astype("datetime64[ns]").astype(str).tolist()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(parsed)], "i int, date_created timestamp_ntz")
    made = [r["date_created"] for r in with_source_text_dates(df).orderBy("i").collect()]
    assert made == [e if e != "nan" else "NaT" for e in expected]
