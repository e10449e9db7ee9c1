"""Schema drift, step sketches and compaction of places."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tierstone.errors import GateError, LoadError
from tierstone.operators.bottlenecks import append_sketches, scan_sketches, slow_steps, step_sketches
from tierstone.operators.bronze import Run, to_bronze
from tierstone.operators.compaction import compact_silver, place_files
from tierstone.operators.drift import drift, scan_drift
from tierstone.operators.history import scan_history
from tierstone.operators.silver import to_silver
from tierstone.operators.sinks import write_silver
from tierstone.plans.runs import LayerPaths, run_batch, run_gated
from tierstone.sources.layers import scan_silver

RUN = Run(datetime(2025, 3, 1, tzinfo=timezone.utc), "upkeep")


def payloads(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "payload string")


def found(df):
    return sorted(tuple(r) for r in df.select("change", "key", "found", "records").collect() if r.change != "absent")


def absent(df):
    return {r.key for r in df.collect() if r.change == "absent"}


def test_no_drift(spark, records):
    assert drift(payloads(spark, *map(json.dumps, records))).collect() == []


def test_drift(spark, records):
    renamed = {("town" if k == "city" else k): v for k, v in records[0].items()}
    odd = {**renamed, "id": 7, "longitude": "9.9", "latitude": None, 'a"b': [1], "deep": {"x": {"y": 1}}}
    df = drift(payloads(spark, *map(json.dumps, (renamed, odd, {**odd, "deep": True, "id": 1e300}))))
    assert found(df) == [
        ("extra", 'a"b', "array", 2), ("extra", "deep", "boolean", 1), ("extra", "deep", "object", 1),
        ("extra", "town", "string", 3), ("retyped", "id", "number", 2), ("retyped", "longitude", "string", 2),
    ]
    assert absent(df) == {"city"}


def test_drift_of_what_is_no_object(spark):
    df = drift(payloads(spark, None, "", " ", "[1, 2]", '[{"a": 1}]', "3", "null", '"x"', '{"a', '{"b": 1, "b": 2}'))
    assert found(df) == [] and len(absent(df)) == 16
    assert len(absent(drift(payloads(spark).limit(0)))) == 16


def test_drift_reads_its_input_once(spark, records):
    plan = drift(payloads(spark, *map(json.dumps, records)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1 and "Join" not in plan


@pytest.mark.parametrize("mode", ["append_all", "incremental"])
def test_drift_is_in_the_history(spark, path, records, mode):
    texts = payloads(spark, *(json.dumps({**r, "new": 1}) for r in records))
    paths = LayerPaths(path)
    run_gated(spark, texts, paths, RUN, mode=mode, drift=True, sketches=True)
    assert [tuple(r) for r in scan_drift(spark, paths.history).collect()] == [
        (RUN.run_id, "extra", "new", None, "number", 2)
    ]
    steps = scan_history(spark, paths.history).where("layer <> 'drift'")
    assert "drift scan" in {r.layer for r in steps.collect()}
    slow = slow_steps(scan_sketches(spark, paths.sketches)).collect()
    assert {r.layer for r in slow} == {r.layer for r in steps.collect()}
    assert all(r.runs == r.steps == 1 and r.median_ms == r.tail_ms >= 0 for r in slow)


def test_drift_and_sketches_are_off_by_default(spark, path, records):
    paths = LayerPaths(path)
    run_batch(spark, payloads(spark, json.dumps({**records[0], "new": 1})), paths, RUN, history=True)
    assert scan_drift(spark, paths.history).isEmpty()
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        scan_sketches(spark, paths.sketches).collect()


def test_a_failed_run_keeps_its_drift(spark, path, records):
    paths = LayerPaths(path)
    spoilt = payloads(spark, *(json.dumps({**r, "id": None, "new": "x"}) for r in records))
    with pytest.raises(GateError):
        run_gated(spark, spoilt, paths, RUN, drift=True, sketches=True, limits={"silver": {"id": 0.1}})
    assert found(scan_drift(spark, paths.history)) == [("extra", "new", "string", 2)]
    assert scan_sketches(spark, paths.sketches).where("layer = 'silver'").count() == 1


def steps_of(spark, rows):
    start = datetime(2025, 1, 1, tzinfo=timezone.utc)
    return spark.createDataFrame(
        [(run, layer, n, None, None, start, None if ms is None else start + timedelta(milliseconds=ms), "ok")
         for run, layer, n, ms in rows],
        "run_id string, layer string, rows_in bigint, rows_out bigint, null_rows bigint, started timestamp, "
        "ended timestamp, status string",
    )


def test_sketches_of_runs_merge(spark, path):
    for run in range(5):
        rows = [(f"r{run}", "silver", 1000, 100 * (run + 1)), (f"r{run}", "gold", 10, 5), (f"r{run}", "probe", None, 0)]
        append_sketches(steps_of(spark, [*rows, (f"r{run}", "bronze", 5, None), (f"r{run}", "drift", 9, 9)]), path)
    slow = [tuple(r) for r in slow_steps(scan_sketches(spark, path), tail=1.0).collect()]
    assert slow == [("silver", 5, 5, 300, 500, 3333), ("gold", 5, 5, 5, 5, 2000), ("probe", 5, 5, 0, 0, None)]


def test_sketches_of_nothing(spark):
    assert slow_steps(step_sketches(steps_of(spark, [("a", "b", 1, 1)]).limit(0))).collect() == []


def silver_of(spark, records):
    return to_silver(to_bronze(payloads(spark, *map(json.dumps, records)), RUN))


def files_of(spark, path):
    return {(r.country, r.state_province): r.files for r in place_files(spark, path).collect()}


def test_compaction(spark, path, records):
    table = f"{path}/silver"
    for _ in range(3):
        write_silver(silver_of(spark, records), table)
    alone = [{**records[0], "country": "Italy", "state_province": "a/b=c %"}]
    write_silver(silver_of(spark, alone), table)
    before = sorted(map(str, scan_silver(spark, table).collect()))
    italian = {r.f for r in scan_silver_files(spark, table).where("country = 'Italy'").collect()}
    done = compact_silver(spark, table)
    assert (done.places, done.files) == (2, 6)  # one of them with a null key
    assert set(files_of(spark, table).values()) == {1} and len(files_of(spark, table)) == 3
    assert sorted(map(str, scan_silver(spark, table).collect())) == before
    # A place not worth it keeps its very files.
    assert {r.f for r in scan_silver_files(spark, table).where("country = 'Italy'").collect()} == italian
    assert compact_silver(spark, table).places == 0
    write_silver(silver_of(spark, records), table)
    assert scan_silver(spark, table).count() == 9


def scan_silver_files(spark, table):
    return spark.read.parquet(table).select("country", F.col("_metadata.file_path").alias("f")).distinct()


def test_compaction_of_large_and_missing_places(spark, path, records):
    assert compact_silver(spark, f"{path}/none").places == 0
    for _ in range(3):
        write_silver(silver_of(spark, records), f"{path}/s")
    assert compact_silver(spark, f"{path}/s", target_bytes=1).places == 0
    assert set(files_of(spark, f"{path}/s").values()) == {3}


def test_a_followed_table_is_not_compacted(spark, path, records):
    paths = LayerPaths(path)
    run_batch(spark, payloads(spark, *map(json.dumps, records)), paths, RUN, mode="incremental")
    with pytest.raises(LoadError, match="incremental"):
        compact_silver(spark, paths.silver)
