"""Gates, runs, re-runs and run history."""

import json
import os
from datetime import datetime, timedelta, timezone

import pytest

from tierstone.errors import ApiResponseError, EtlError, ExtractionError, GateError, LoadError
from tierstone.functions.records import payloads_from_list
from tierstone.operators import gates
from tierstone.operators.bronze import Run, to_bronze
from tierstone.operators.history import scan_history
from tierstone.operators.sinks import write_bronze_run
from tierstone.plans.runs import (
    LayerPaths,
    PagedInput,
    build_bronze,
    build_gold,
    build_silver,
    run_batch,
    run_gated,
)
from tierstone.sources.layers import scan_bronze, scan_gold, scan_silver
from tierstone.sources.paged import StoredPages
from tierstone.sources.raw import read_raw_arrays, read_raw_lines
from tierstone.streaming.incremental import follow_bronze


def run_at(hour, day=1):
    return Run(datetime(2025, 1, day, hour, tzinfo=timezone.utc), "test")


@pytest.fixture()
def paths(path):
    return LayerPaths(path)


@pytest.fixture()
def payloads(spark, records):
    return payloads_from_list(spark, records)


def counts(spark, paths):
    gold = [r.num_breweries for r in scan_gold(spark, paths.gold).collect()]
    return scan_bronze(spark, paths.bronze).count(), scan_silver(spark, paths.silver).count(), gold


def store_pages(path, *pages):
    for number, page in enumerate(pages, 1):
        os.makedirs(f"{path}/page_number={number}")
        with open(f"{path}/page_number={number}/p.txt", "w", encoding="utf-8") as out:
            out.write(page if isinstance(page, str) else json.dumps(page))
    return StoredPages(path, per_page=50)


# --- gates --------------------------------------------------------------------


def test_gate_columns_and_rows(spark, payloads):
    bronze = to_bronze(payloads, run_at(0))
    assert gates.enforce(bronze, gates.BRONZE_GATE) is bronze
    with pytest.raises(GateError, match="payload"):
        gates.enforce(bronze.drop("payload"), gates.BRONZE_GATE)
    with pytest.raises(GateError, match="fewer than 1"):
        gates.enforce(bronze.limit(0), gates.BRONZE_GATE)
    with pytest.raises(GateError, match="fewer than 3"):
        gates.enforce(bronze, gates.Gate("bronze", (), min_rows=3))
    with pytest.raises(GateError, match="fewer"):
        gates.enforce(bronze, gates.BRONZE_GATE, bronze.limit(0))


def test_silver_gate_asks_for_fourteen_columns():
    assert len(gates.SILVER_GATE.columns) == 14
    assert not {"address_2", "address_3", "ingestion_timestamp"} & set(gates.SILVER_GATE.columns)


def test_gate_report(spark, payloads):
    rows = gates.report(to_bronze(payloads, run_at(0)).drop("payload"), gates.BRONZE_GATE).collect()
    assert [tuple(r) for r in rows] == [
        ("bronze", "row_count", 2, True),
        ("bronze", "column ingestion_timestamp", 1, True),
        ("bronze", "column ingestion_date", 1, True),
        ("bronze", "column source_system", 1, True),
        ("bronze", "column payload", 0, False),
    ]


def test_probe_of_a_table(spark, payloads):
    assert gates.probe(payloads) is payloads
    with pytest.raises(ExtractionError):
        gates.probe(payloads.limit(0))


# --- re-runs ------------------------------------------------------------------


def test_append_all_multiplies(spark, payloads, paths):
    for n in (1, 2, 3):
        assert run_batch(spark, payloads, paths, run_at(n)).completed
        silver = n * (n + 1) // 2
        assert counts(spark, paths) == (2 * n, 2 * silver, [silver, silver])


def test_incremental_repeats_nothing(spark, payloads, paths):
    for _ in range(3):
        report = run_batch(spark, payloads, paths, run_at(1), mode="incremental")
        assert report.completed
        assert counts(spark, paths) == (2, 2, [1, 1])
    assert [s.status for s in report.steps if s.layer == "bronze"] == ["already done"]
    # Another run of the same day and one of the next day each add once.
    run_batch(spark, payloads, paths, run_at(2), mode="incremental")
    assert counts(spark, paths) == (4, 4, [2, 2])
    report = run_batch(spark, payloads, paths, run_at(1, day=2), mode="incremental")
    assert counts(spark, paths) == (6, 6, [3, 3])
    silver = next(s for s in report.steps if s.layer == "silver")
    assert (silver.rows_in, silver.rows_out, silver.null_rows) == (2, 2, 0)


def test_incremental_catches_up_on_runs_it_missed(spark, payloads, paths):
    for hour in range(4):
        build_bronze(spark, payloads, paths.bronze, run_at(hour), mode="incremental")
    followed = follow_bronze(spark, paths.bronze, paths.silver, paths.checkpoint, max_files=1)
    assert (followed.rows, followed.null_rows) == (8, 0)
    assert scan_silver(spark, paths.silver).count() == 8
    assert follow_bronze(spark, paths.bronze, paths.silver, paths.checkpoint).rows == 0


def test_incremental_splits_a_hot_place(spark, paths):
    from pyspark.sql import functions as F

    rows = spark.range(0, 100_000, 1, 8).select(
        F.to_json(
            F.struct(
                F.sha2(F.col("id").cast("string"), 256).alias("id"),
                F.when(F.col("id") % 3 > 0, "hot")
                .otherwise(F.concat(F.lit("c"), F.col("id") % 9))
                .alias("country"),
            )
        ).alias("payload")
    )
    build_bronze(spark, rows, paths.bronze, run_at(1), mode="incremental")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        followed = follow_bronze(spark, paths.bronze, paths.silver, paths.checkpoint)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert (followed.rows, followed.null_rows) == (100_000, 0)
    hot = scan_silver(spark, paths.silver).where("country = 'hot'")
    assert hot.count() == 66_666
    assert hot.select(F.input_file_name()).distinct().count() > 2


def test_bronze_run_folder_is_replaced_alone(spark, payloads, paths):
    for run in (run_at(1), run_at(2), run_at(1)):
        write_bronze_run(to_bronze(payloads, run), paths.bronze, run)
    assert scan_bronze(spark, paths.bronze).count() == 4


def test_modes_do_not_mix_on_one_table(spark, payloads, path):
    plain, kept = LayerPaths(f"{path}/plain"), LayerPaths(f"{path}/kept")
    run_batch(spark, payloads, plain, run_at(1))
    run_batch(spark, payloads, kept, run_at(1), mode="incremental")
    with pytest.raises(LoadError, match="plain runs"):
        follow_bronze(spark, kept.bronze, plain.silver, f"{path}/checkpoint")
    with pytest.raises(LoadError, match="incremental"):
        build_silver(spark, LayerPaths(path, bronze=plain.bronze, silver=kept.silver))
    assert scan_silver(spark, plain.silver).count() == scan_silver(spark, kept.silver).count() == 2


@pytest.mark.parametrize("first, second", [("append_all", "incremental"), ("incremental", "append_all")])
@pytest.mark.parametrize("run_it", [run_batch, run_gated])
def test_a_refused_mode_changes_nothing(spark, payloads, paths, first, second, run_it):
    run_it(spark, payloads, paths, run_at(1), mode=first, history=False)
    before = counts(spark, paths)
    with pytest.raises(LoadError, match="kept by"):
        run_it(spark, payloads, paths, run_at(2), mode=second, history=False)
    assert counts(spark, paths) == before
    run_it(spark, payloads, paths, run_at(3), mode=first, history=False)
    assert counts(spark, paths)[0] == 4


def test_a_broken_commit_is_written_again(spark, paths):
    rows = spark.range(0, 1000, 1, 4).selectExpr("concat('{\"id\": \"', id, '\"}') AS payload")
    build_bronze(spark, rows, paths.bronze, run_at(1), mode="incremental")
    folder = f"{paths.bronze}/ingestion_date=2025-01-01/run_id={run_at(1).run_id}"
    parts = sorted(name for name in os.listdir(folder) if name.startswith("part-"))
    for name in [*parts[:3], "_SUCCESS"]:
        os.remove(f"{folder}/{name}")
    assert scan_bronze(spark, paths.bronze).count() < 1000
    step = build_bronze(spark, rows, paths.bronze, run_at(1), mode="incremental")
    assert step.status != "already done" and scan_bronze(spark, paths.bronze).count() == 1000


@pytest.mark.parametrize("mode", ["append_all", "incremental"])
def test_sources_of_one_clock_are_runs_of_their_own(spark, payloads, paths, mode):
    for source in ("a/b", "a b"):
        run = Run(datetime(2025, 1, 1, tzinfo=timezone.utc), source)
        assert run_gated(spark, payloads, paths, run, mode=mode, history=False).completed
    bronze = scan_bronze(spark, paths.bronze)
    assert sorted(r.source_system for r in bronze.collect()) == ["a b", "a b", "a/b", "a/b"]
    assert len(os.listdir(paths.raw)) == 2


def test_a_done_run_does_not_ask_again(spark, payloads, paths):
    run_gated(spark, payloads, paths, run_at(1), mode="incremental", history=False)
    gone = PagedInput(StoredPages(f"{paths.root}/nowhere", per_page=50))
    report = run_gated(spark, gone, paths, run_at(1), mode="incremental", history=False)
    assert report.completed and counts(spark, paths)[:2] == (2, 2)


def test_history_never_hides_a_failure(spark, payloads, paths):
    with open(paths.history, "w", encoding="utf-8") as out:
        out.write("a file where the folder should be")
    with pytest.raises(ExtractionError):
        run_gated(spark, payloads.limit(0), paths, run_at(1))


# --- runs ---------------------------------------------------------------------


def test_batch_without_records_writes_nothing(spark, payloads, paths):
    report = run_batch(spark, payloads.limit(0), paths, run_at(1))
    assert not report.completed and [s.status for s in report.steps] == ["empty"]
    assert os.listdir(paths.root) == []


def test_gated_run_without_records_fails_at_the_probe(spark, payloads, paths):
    with pytest.raises(ExtractionError):
        run_gated(spark, payloads.limit(0), paths, run_at(1), history=False)
    assert os.listdir(paths.root) == []


@pytest.mark.parametrize("mode", ["append_all", "incremental"])
def test_gated_run_of_a_paged_source(spark, records, paths, mode):
    fetch = store_pages(f"{paths.root}/api", records, records[:1], [], records)
    source = PagedInput(fetch, max_pages=None)
    report = run_gated(spark, source, paths, run_at(1), mode=mode)
    assert report.completed
    assert [s.layer for s in report.steps] == [
        "probe", "extract", "bronze gate", "bronze", "silver gate", "silver", "gold gate", "gold",
    ]
    assert counts(spark, paths) == (3, 3, [2, 1])
    raw = read_raw_lines(spark, f"{paths.raw}/run_id=20250101T010000-test")
    assert sorted(json.loads(r.payload)["id"] for r in raw.collect()) == ["k-7", "k-7", "k-8"]
    history = {
        r.layer: (r.run_id, r.rows_in, r.rows_out, r.null_rows, r.status)
        for r in scan_history(spark, paths.history).collect()
    }
    run_id = "20250101T010000-test"
    assert history["extract"] == (run_id, 3, 3, None, "ok")
    assert history["bronze"] == (run_id, 3, 3, 0, "ok")
    assert history["silver"] == (run_id, 3, 3, 0, "ok")
    assert history["gold"] == (run_id, 3, 2, None, "ok")


def test_no_page_allowed_fails_at_the_bronze_gate(spark, records, paths):
    fetch = store_pages(f"{paths.root}/api", records)
    with pytest.raises(GateError, match="bronze"):
        run_gated(spark, PagedInput(fetch, max_pages=0), paths, run_at(1))
    assert not os.path.exists(paths.bronze)


def test_batch_of_a_paged_source(spark, records, paths):
    fetch = store_pages(f"{paths.root}/api", *[records] * 7)
    report = run_batch(spark, PagedInput(fetch), paths, run_at(1), history=True)
    assert report.completed
    assert counts(spark, paths) == (14, 14, [7, 7])  # all pages unless told otherwise
    layers = {r.layer: r.rows_out for r in scan_history(spark, paths.history).collect()}
    assert layers == {"extract": None, "bronze": 14, "silver": 14, "gold": 2}


def test_failed_page_stops_the_run(spark, records, paths):
    fetch = store_pages(f"{paths.root}/api", records, '{"message": "busy"}')
    with pytest.raises(ApiResponseError):
        run_gated(spark, PagedInput(fetch), paths, run_at(1))
    assert not os.path.exists(paths.bronze)
    status = {r.layer: r.status for r in scan_history(spark, paths.history).collect()}
    assert status == {"probe": "ok", "extract": "failed: ApiResponseError"}


def test_failed_gate_stops_the_run(spark, payloads, paths, monkeypatch):
    monkeypatch.setattr(gates, "SILVER_GATE", gates.Gate("silver", ("no_such_column",)))
    with pytest.raises(GateError, match="no_such_column"):
        run_gated(spark, payloads, paths, run_at(1))
    assert os.path.exists(paths.bronze) and not os.path.exists(paths.silver)
    rows = scan_history(spark, paths.history).orderBy("started").collect()
    assert (rows[-1].layer, rows[-1].status) == ("silver gate", "failed: GateError")
    assert all(r.ended - r.started >= timedelta(0) for r in rows)


def test_malformed_records_pass_every_gate_and_show_in_the_history(spark, paths):
    bad = spark.createDataFrame([("hello",), ('{"id":',)], "payload STRING")
    assert run_gated(spark, bad, paths, run_at(1)).completed
    assert [tuple(r) for r in scan_gold(spark, paths.gold).collect()] == [(None,) * 4 + (2,)]
    silver = scan_history(spark, paths.history).where("layer = 'silver'").first()
    assert (silver.rows_out, silver.null_rows) == (2, 2)


def test_steps_one_at_a_time(spark, records, paths):
    os.makedirs(paths.raw)
    with open(f"{paths.raw}/dump.json", "w", encoding="utf-8") as out:
        json.dump(records, out, ensure_ascii=False)
    build_bronze(spark, read_raw_arrays(spark, paths.raw), paths.bronze, run_at(1))
    build_silver(spark, paths)
    build_gold(spark, paths.silver, paths.gold)
    assert counts(spark, paths) == (2, 2, [1, 1])
    # Gold alone can be built again.
    assert build_gold(spark, paths.silver, paths.gold).rows_out == 2
    assert counts(spark, paths) == (2, 2, [1, 1])


def test_every_failure_is_an_etl_error():
    assert issubclass(GateError, EtlError)
