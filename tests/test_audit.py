"""Audited writes, the quarantine, latest records and maintained Gold."""

import os
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tierstone.errors import GateError, LoadError
from tierstone.functions.records import payloads_from_list
from tierstone.operators import publish
from tierstone.operators.bronze import Run, to_bronze
from tierstone.operators.gates import Gate, rate_report
from tierstone.operators.maintained import run_bronze, run_counts
from tierstone.operators.publish import Audit, audited_write
from tierstone.operators.silver import latest_by_id, to_checked_silver, to_silver
from tierstone.operators.sinks import (
    bronze_run_is_done,
    bronze_run_path,
    write_bronze,
    write_bronze_run,
    write_checked_silver,
    write_gold,
    write_silver,
)
from tierstone.plans.runs import LayerPaths, build_bronze, run_batch, run_gated
from tierstone.schemas import GOLD_KEYS
from tierstone.sources.layers import (
    scan_bronze,
    scan_checked_silver,
    scan_gold,
    scan_quarantine,
    scan_silver,
)
from tierstone.streaming.latest import follow_latest, scan_latest


def run_at(hour):
    return Run(datetime(2025, 1, 1, hour, tzinfo=timezone.utc), "test")


def plain(df, staged):
    df.write.mode("overwrite").parquet(staged)


def audit(run_id="r", **rates):
    return Audit(run_id, (Gate("layer", (), null_rate=rates),))


def records(n, country="X", broken=0):
    return [{"id": str(i) if i >= broken else None, "name": f"n{i}", "country": country} for i in range(n)]


def values(spark, path):
    return sorted(r.a for r in spark.read.parquet(path).collect())


# --- audit before publish -------------------------------------------------------


def test_a_refused_write_leaves_the_old_rows_readable(spark, path):
    old = spark.range(5).select(F.col("id").alias("a"))
    audited_write(old, path, audit("one", a=0.0), plain)
    bad = spark.range(10).select(F.when(F.col("id") > 1, F.col("id")).alias("a"))
    for replace in (False, True):
        with pytest.raises(GateError, match="2 nulls in a of 10 rows, more than 10.00%"):
            audited_write(bad, path, audit("two", a=0.1), plain, replace=replace)
        assert values(spark, path) == [0, 1, 2, 3, 4]
    # A try that holds takes the place of the one put aside, which shows nowhere.
    audited_write(old, path, audit("two", a=0.1), plain)
    assert values(spark, path) == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4]
    audited_write(bad, path, audit("three", a=0.2), plain, replace=True, done_mark=True)  # the limit itself holds
    assert spark.read.parquet(path).count() == 10 and os.path.exists(f"{path}/_SUCCESS")


def test_too_few_rows_are_refused(spark, path):
    audited_write(spark.range(1).toDF("a"), path, audit(a=0.0), plain)
    with pytest.raises(GateError, match="fewer than 1 rows"):
        audited_write(spark.range(0).toDF("a"), path, audit(a=0.0), plain, replace=True)
    assert values(spark, path) == [0]


@pytest.mark.parametrize("replace", [False, True])
@pytest.mark.parametrize("fails_at", [0, 1, 2])
def test_a_publish_that_broke_off_is_finished(spark, path, monkeypatch, replace, fails_at):
    audited_write(spark.range(2).toDF("a").coalesce(1), path, audit("one", a=0.0), plain)
    rename, done = publish._Files.rename, []

    def breaks(self, source, target):
        if len(done) == fails_at:
            raise OSError("the driver was lost")
        done.append(target)
        rename(self, source, target)

    monkeypatch.setattr(publish._Files, "rename", breaks)
    new = spark.range(10, 16, 1, 3).toDF("a")
    with pytest.raises(LoadError, match="could not be published"):
        audited_write(new, path, audit("two", a=0.0), plain, replace=replace)
    monkeypatch.setattr(publish._Files, "rename", rename)
    audited_write(spark.range(90, 91).toDF("a"), path, audit("three", a=0.0), plain)
    assert values(spark, path) == [*([] if replace else [0, 1]), *range(10, 16), 90]


def test_each_layer_is_audited(spark, path):
    paths, run = LayerPaths(path), run_at(0)
    good = to_bronze(payloads_from_list(spark, records(20)), run)
    bad = to_bronze(spark.createDataFrame([(None,), ("{}",)], "payload STRING"), run)
    no_nulls = audit("a", payload=0.0)
    write_bronze(good, paths.bronze, no_nulls)
    with pytest.raises(GateError):
        write_bronze(bad, paths.bronze, no_nulls)
    assert scan_bronze(spark, paths.bronze).count() == 20

    folder = f"{path}/runs"
    with pytest.raises(GateError):
        write_bronze_run(bad, folder, run, no_nulls)
    assert not bronze_run_is_done(spark, folder, run)
    write_bronze_run(good, folder, run, no_nulls)
    write_bronze_run(good, folder, run, no_nulls)  # a repeat replaces
    assert bronze_run_is_done(spark, folder, run) and scan_bronze(spark, folder).count() == 20

    write_silver(to_silver(good), paths.silver, audit=audit("a", id=0.0))
    with pytest.raises(GateError):
        write_silver(to_silver(bad), paths.silver, audit=audit("b", id=0.5))
    assert {r.country for r in scan_silver(spark, paths.silver).collect()} == {"X"}

    gold = spark.createDataFrame([("a", "b", "c", None, 1)], "brewery_type string, country string, state_province string, city string, num_breweries bigint")
    write_gold(gold, paths.gold, audit("a", city=1.0))
    with pytest.raises(GateError):
        write_gold(gold.union(gold), paths.gold, audit("b", city=0.9))
    write_gold(gold, paths.gold)  # plain writes and audited ones go together
    assert scan_gold(spark, paths.gold).count() == 1


@pytest.mark.parametrize("mode", ["append_all", "incremental"])
def test_a_refused_run_does_not_reach_silver_later(spark, path, mode):
    paths, limits = LayerPaths(path), {"silver": {"id": 0.3}}
    good = payloads_from_list(spark, records(10))
    bad = payloads_from_list(spark, records(10, "Y", broken=9))
    run_gated(spark, good, paths, run_at(0), mode=mode, limits=limits)
    with pytest.raises(GateError, match="nulls in id"):
        run_gated(spark, bad, paths, run_at(1), mode=mode, limits=limits)
    assert {r.country for r in scan_silver(spark, paths.silver).collect()} == {"X"}
    assert [r.num_breweries for r in scan_gold(spark, paths.gold).collect()] == [10]
    if mode == "incremental":
        run_gated(spark, good, paths, run_at(2), mode=mode, limits=limits)
        assert [r.num_breweries for r in scan_gold(spark, paths.gold).collect()] == [20]


def test_no_limits_no_staging(spark, path):
    paths = LayerPaths(path)
    run_gated(spark, payloads_from_list(spark, records(3)), paths, run_at(0))
    assert not any(os.path.basename(folder) == publish.STAGING for folder, _, _ in os.walk(path))


def test_rate_report_counts_in_one_scan(spark):
    rows = spark.createDataFrame([(None, 1), ("a", None), ("b", 3), (None, 4)], "x string, `y.z` int")
    got = rate_report(rows, Gate("g", (), null_rate={"x": 0.5, "y.z": 0.2}))
    assert [tuple(r) for r in got.collect()] == [("g", "x", 4, 2, 0.5, True), ("g", "y.z", 4, 1, 0.2, False)]
    nothing = rate_report(rows.limit(0), Gate("g", (), null_rate={"x": 0.0}))
    assert [tuple(r) for r in nothing.collect()] == [("g", "x", 0, 0, 0.0, True)]


# --- quarantine -----------------------------------------------------------------


def test_quarantine_by_hand(spark, path):
    texts = {
        '{"id": "1", "longitude": 2}': "read",
        "{}": "read",
        '{"id": "2", "longitude": "east"}': "mistyped",
        '{"id": "3"': "malformed",
        "null": "malformed",
        "[1]": "malformed",
        "": "missing",
        None: "missing",
    }
    bronze = to_bronze(spark.createDataFrame([(t,) for t in texts], "payload STRING"), run_at(0))
    checked = to_checked_silver(bronze)
    assert Counter(r.status for r in checked.collect()) == Counter(texts.values())
    write_checked_silver(checked, path)
    kept = {r.payload: r.status for r in scan_quarantine(spark, path).collect()}
    assert kept == {text: status for text, status in texts.items() if status != "read"}
    silver = scan_checked_silver(spark, path)
    assert silver.columns == to_silver(bronze).columns
    assert sorted((r.id, r.longitude) for r in silver.collect() if r.id) == [("1", 2.0)]
    # The default Silver keeps every row, and the fields that could be read.
    assert to_silver(bronze).count() == len(texts)
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_quarantine_of_nothing(spark, path):
    bronze = to_bronze(spark.createDataFrame([], "payload STRING"), run_at(0))
    write_checked_silver(to_checked_silver(bronze), path)
    assert scan_quarantine(spark, path).count() == 0


# --- latest record --------------------------------------------------------------


def versions(spark, *runs):
    frames = [
        to_silver(to_bronze(payloads_from_list(spark, rows), run_at(hour))) for hour, rows in enumerate(runs)
    ]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def test_latest_record_of_each_id(spark):
    first = [{"id": "a", "name": "old"}, {"id": "b", "name": "kept"}, {"id": None, "name": "x"}, {"name": "x"}]
    second = [{"id": "a", "name": "new", "city": "C"}, {"id": "c", "name": "tie 1"}, {"id": "c", "name": "tie 2"}]
    got = latest_by_id(versions(spark, first, second))
    assert sorted((r.id or "", r.name, r.city) for r in got.collect()) == [
        ("", "x", None), ("", "x", None), ("a", "new", "C"), ("b", "kept", None), ("c", "tie 2", None),
    ]
    assert got.columns == versions(spark, first).columns
    assert latest_by_id(got.limit(0)).count() == 0


def test_a_hot_id_is_one_row_a_task(spark):
    rows = spark.range(0, 9000, 1, 6).select(
        F.lit(run_at(0).ts).alias("ingestion_timestamp"),
        F.to_json(F.struct(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"), F.col("id").cast("string").alias("name"))).alias("payload"),
    )
    got = latest_by_id(to_silver(rows))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning")  # printed top down
    assert got.count() == 6001
    assert [r.name for r in got.where("id = 'hot'").collect()] == ["999"]


def test_latest_by_keyed_state_writes_what_changed(spark, path):
    paths, table = LayerPaths(path), f"{path}/latest"
    runs = [
        [{"id": "a", "name": "old"}, {"id": "b", "name": "kept"}, {"name": "x"}],
        [{"id": "a", "name": "new"}, {"id": "c", "name": "tie 1"}, {"id": "c", "name": "tie 2"}, {"name": "x"}],
    ]
    for hour, rows in enumerate(runs):
        payloads = payloads_from_list(spark, rows)
        build_bronze(spark, payloads, paths.bronze, run_at(hour), mode="incremental")
        for _ in range(2):  # nothing new, nothing written
            follow_latest(spark, paths.bronze, table, f"{path}/state")
    assert sorted(os.listdir(table)) == ["batch=0", "batch=1"]
    assert sorted(r.id for r in spark.read.parquet(f"{table}/batch=1").collect()) == ["a", "c"]
    silver = to_silver(scan_bronze(spark, paths.bronze))
    got = scan_latest(spark, table, silver)
    assert sorted((r.id or "", r.name) for r in got.collect()) == [("", "x"), ("", "x"), ("a", "new"), ("b", "kept"), ("c", "tie 2")]
    same = latest_by_id(silver)
    assert sorted(map(str, got.collect())) == sorted(map(str, same.collect()))
    assert scan_latest(spark, f"{path}/nowhere").count() == 0


# --- maintained Gold -------------------------------------------------------------


def test_maintained_gold_equals_a_recount_and_reads_one_run(spark, path):
    paths = LayerPaths(path)
    runs = [records(5), records(4, "Y") + [{"id": "z", "country": "", "state_province": ""}], records(3, "X")]
    for hour, rows in enumerate(runs):
        for _ in range(2):  # a repeat adds nothing
            run_batch(spark, payloads_from_list(spark, rows), paths, run_at(hour), mode="incremental", maintained=True)
    gold = sorted((r.country or "", r.num_breweries) for r in scan_gold(spark, paths.gold).collect())
    assert gold == [("", 1), ("X", 8), ("Y", 4)]
    recount = scan_silver(spark, paths.silver).groupBy(*GOLD_KEYS).count()
    assert sorted((r.country or "", r["count"]) for r in recount.collect()) == gold
    read = run_counts(run_bronze(spark, paths.bronze, run_at(1)))
    folder = bronze_run_path(paths.bronze, run_at(1))
    assert read.inputFiles() and all(folder in name for name in read.inputFiles())
    assert {r.country for r in read.collect()} == {"Y", None}


def test_maintained_gold_needs_incremental_runs(spark, path):
    with pytest.raises(LoadError, match="incremental"):
        run_batch(spark, payloads_from_list(spark, records(1)), LayerPaths(path), run_at(0), maintained=True)


def test_a_clock_with_microseconds_is_one_run(spark, path):
    paths, run = LayerPaths(path), Run(run_at(0).ts + timedelta(microseconds=5), "a b/c")
    run_batch(spark, payloads_from_list(spark, records(2)), paths, run, mode="incremental", maintained=True)
    assert scan_gold(spark, paths.gold).collect()[0].num_breweries == 2
