"""Values of each layer, in memory and through storage."""

import json
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql.types import StructField, StructType

from tierstone.errors import (
    ApiResponseError,
    EtlError,
    ExtractionError,
    LoadError,
    TransformError,
)
from tierstone.functions.records import (
    conform,
    parse_payload,
    payload_rows,
    payloads_from_list,
    typed_records,
)
from tierstone.operators.bronze import Run, to_bronze
from tierstone.operators.gold import to_gold
from tierstone.operators.silver import all_null, to_silver
from tierstone.operators.sinks import (
    balance_silver,
    write_bronze,
    write_gold,
    write_raw,
    write_silver,
)
from tierstone.schemas import BRONZE, GOLD_KEYS, RECORD, SILVER, SILVER_FIELDS
from tierstone.sources.layers import scan_bronze, scan_gold, scan_silver
from tierstone.sources.raw import read_raw_lines

# Parquet reads every column back as nullable.
SILVER_READ = StructType([StructField(f.name, f.dataType) for f in SILVER])
RUN = Run(datetime(2025, 1, 2, 3, 4, 5, 678901, tzinfo=timezone.utc), "test")


def bronze_of(spark, payloads):
    return to_bronze(spark.createDataFrame([(p,) for p in payloads], "payload STRING"), RUN)


def test_bronze_values(spark, records):
    bronze = to_bronze(payloads_from_list(spark, records), RUN)
    assert bronze.columns == BRONZE.names
    assert [f.dataType for f in bronze.schema] == [f.dataType for f in BRONZE]
    rows = bronze.selectExpr("cast(ingestion_timestamp as string) ts", "*").collect()
    assert {r.ts for r in rows} == {"2025-01-02 03:04:05.678901"}
    assert {r.ingestion_date for r in rows} == {date(2025, 1, 2)}
    assert {r.source_system for r in rows} == {"test"}
    assert [json.loads(r.payload) for r in rows] == records


def test_payload_keeps_unicode_and_nulls(spark):
    record = {"id": "é", "name": None, "city": "São Paulo 🍺"}
    (row,) = payloads_from_list(spark, [record]).collect()
    assert row.payload == '{"id": "é", "name": null, "city": "São Paulo 🍺"}'
    table = spark.createDataFrame([record], "id STRING, name STRING, city STRING")
    (row,) = payload_rows(table).collect()
    assert json.loads(row.payload) == record


def test_run_clock_is_utc_whatever_zone_it_comes_in():
    late = datetime(2025, 1, 1, 23, 30, tzinfo=timezone(timedelta(hours=-3)))
    assert Run(late, "s").date == date(2025, 1, 2)
    assert Run(late, "s").run_id == "20250102T023000-s"
    assert Run(datetime(2025, 1, 1, 12), "s").ts == datetime(2025, 1, 1, 12, tzinfo=timezone.utc)


def test_silver_values_and_order(spark, records):
    silver = to_silver(to_bronze(payloads_from_list(spark, records), RUN))
    assert silver.columns == SILVER.names
    assert [f.dataType for f in silver.schema] == [f.dataType for f in SILVER]
    rows = [r.asDict() for r in silver.drop("ingestion_timestamp").orderBy("id").collect()]
    assert rows == records


def test_gold_values(spark, records):
    silver = to_silver(to_bronze(payloads_from_list(spark, records + records[:1]), RUN))
    rows = [tuple(r) for r in to_gold(silver).collect()]
    assert rows == [("brewpub", "Germany", None, "Ulm", 2), ("large", "Ireland", "Munster", "Cork", 1)]
    count = to_gold(silver).schema["num_breweries"]
    assert (count.dataType.simpleString(), count.nullable) == ("bigint", False)


def test_gold_of_nothing_is_nothing(spark):
    assert to_gold(to_silver(bronze_of(spark, []))).count() == 0


def test_null_keys_are_groups(spark):
    silver = to_silver(bronze_of(spark, ["broken", "{", None, '{"id":"1"}']))
    assert [tuple(r) for r in to_gold(silver).collect()] == [(None, None, None, None, 4)]
    assert silver.where(all_null()).count() == 3


def test_gold_does_not_depend_on_layout(spark):
    payloads = [json.dumps({"brewery_type": f"t{i % 3}", "city": f"c{i % 7}"}) for i in range(500)]
    one = to_gold(to_silver(bronze_of(spark, payloads).coalesce(1))).collect()
    many = to_gold(to_silver(bronze_of(spark, payloads[::-1]).repartition(13))).collect()
    assert one == many


@pytest.mark.parametrize(
    "payload, expected",
    [
        ('{"id":"1","name":"a","longitude":1.5,"latitude":2.5}', ("1", "a", 1.5, 2.5)),
        ('{"id":"1","name":"a","longitude":"-97.0","latitude":30.5}', ("1", "a", None, 30.5)),
        ('{"id":"1","longitude":"","latitude":true}', ("1", None, None, None)),
        ('{"id":"1","longitude":7,"latitude":"Infinity"}', ("1", None, 7.0, float("inf"))),
        ('{"id":"1","name":', (None,) * 4),
        ("hello", (None,) * 4),
        ("null", (None,) * 4),
        ("5", (None,) * 4),
        ('[{"id":"1"}]', (None,) * 4),
        ('[{"id":"1"},{"id":"2"}]', (None,) * 4),
        ("", (None,) * 4),
        ("   ", (None,) * 4),
        (None, (None,) * 4),
        ('{"id":12,"name":true}', ("12", "true", None, None)),
        ('{"id":1.50}', ("1.5", None, None, None)),
        ('{"id":{"a": 1},"name":[1, 2]}', ('{"a":1}', "[1,2]", None, None)),
        ('{"ID":"1"}', (None,) * 4),
        ('{"id":"1","other":2}', ("1", None, None, None)),
        ('{"id":"1","id":"2"}', ("2", None, None, None)),
        ("{'id':'1'}", ("1", None, None, None)),
        ('{"id":"1"} tail', ("1", None, None, None)),
    ],
)
def test_parse_never_fails(spark, payload, expected):
    fields = ["id", "name", "longitude", "latitude"]
    bronze = bronze_of(spark, [payload])
    assert tuple(to_silver(bronze).select(*fields).first()) == expected
    # A narrower schema reads the same values.
    assert tuple(to_silver(bronze, fields).select(*fields).first()) == expected


def test_blank_payload_gives_no_struct_and_malformed_an_empty_one(spark):
    rows = bronze_of(spark, ["", None, "hello"]).select(parse_payload("payload").isNull()).collect()
    assert [r[0] for r in rows] == [True, True, False]


def test_typed_records_and_conform(spark, records):
    payloads = payloads_from_list(spark, [{"latitude": 3, "id": "7", "extra": 1}])
    typed = typed_records(payloads)
    assert typed.columns == RECORD.names
    assert (typed.first().id, typed.first().latitude, typed.first().name) == ("7", 3.0, None)
    table = spark.createDataFrame([(3, "7", 1)], "latitude INT, id STRING, extra INT")
    assert conform(table).schema.names == RECORD.names
    assert conform(table).collect() == typed.collect()


def test_layers_through_storage(spark, records, path):
    write_bronze(to_bronze(payloads_from_list(spark, records), RUN), f"{path}/b")
    bronze = scan_bronze(spark, f"{path}/b")
    assert bronze.columns == BRONZE.names
    assert bronze.schema["ingestion_date"].dataType == BRONZE["ingestion_date"].dataType
    write_silver(to_silver(bronze), f"{path}/s")
    silver = scan_silver(spark, f"{path}/s")
    assert silver.columns == SILVER.names
    back = silver.drop("ingestion_timestamp").orderBy("id").collect()
    assert [r.asDict() for r in back] == records
    for _ in range(2):
        write_gold(to_gold(silver), f"{path}/g")
    assert sorted(tuple(r) for r in scan_gold(spark, f"{path}/g").collect()) == [
        ("brewpub", "Germany", None, "Ulm", 1),
        ("large", "Ireland", "Munster", "Cork", 1),
    ]


def test_partition_values_round_trip(spark, path):
    kept = ["a/b=c", "null", "US ", "01", "007", "München", "100%", "x:y"]
    lost = [None, ""]
    payloads = [json.dumps({"id": str(i), "country": c}) for i, c in enumerate(kept + lost)]
    write_silver(to_silver(bronze_of(spark, payloads)), path)
    assert scan_silver(spark, path).schema == SILVER_READ
    back = {r.id: (r.country, r.state_province) for r in scan_silver(spark, path).collect()}
    expected = [(c, None) for c in kept] + [(None, None)] * len(lost)
    assert back == {str(i): pair for i, pair in enumerate(expected)}


def test_hot_place_is_split_over_files(spark, path):
    """Half of the rows in one place: neither one task nor one file writes it."""
    from pyspark.sql import functions as F

    rows = spark.range(0, 200_000, 1, 8).select(
        F.to_json(
            F.struct(
                F.sha2(F.col("id").cast("string"), 256).alias("id"),
                F.when(F.col("id") % 2 == 0, "hot")
                .otherwise(F.concat(F.lit("c"), F.col("id") % 9))
                .alias("country"),
            )
        ).alias("payload")
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_silver(balance_silver(to_silver(to_bronze(rows, RUN)), 4), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    silver = scan_silver(spark, path)
    assert silver.where("country = 'hot'").select(F.input_file_name()).distinct().count() > 2
    assert silver.count() == 200_000
    assert silver.where("country = 'hot'").count() == 100_000


def test_plans(spark, records, path):
    """No shuffle for Bronze, one parse, pruned scans, counting before the shuffle."""
    write_bronze(to_bronze(payloads_from_list(spark, records), RUN), f"{path}/b")
    bronze = scan_bronze(spark, f"{path}/b")
    write_silver(to_silver(bronze), f"{path}/s")

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    write_raw(payloads_from_list(spark, records), f"{path}/raw", RUN.run_id)
    assert "Exchange" not in plan(to_bronze(read_raw_lines(spark, f"{path}/raw"), RUN))
    silver_plan = plan(to_silver(bronze))
    assert "Exchange" not in silver_plan
    balanced = plan(balance_silver(to_silver(bronze), 9))
    assert "hashpartitioning(country" in balanced and "REBALANCE_PARTITIONS_BY_COL" in balanced
    assert balanced.count("Exchange") == 1
    assert silver_plan.count("from_json") == 1
    assert "ReadSchema: struct<ingestion_timestamp:timestamp,payload:string>" in silver_plan
    gold_plan = plan(to_gold(scan_silver(spark, f"{path}/s")))
    assert "ReadSchema: struct<brewery_type:string,city:string>" in gold_plan
    assert gold_plan.index("rangepartitioning") < gold_plan.index("hashpartitioning")
    assert gold_plan.index("hashpartitioning") < gold_plan.index("partial_count")
    assert gold_plan.count("Exchange") == 2
    pruned = plan(bronze.where("ingestion_date = date'2025-01-02'"))
    assert "PartitionFilters: [isnotnull(ingestion_date" in pruned


def test_guards_and_error_tree(spark, path):
    for call in (to_bronze, lambda _, __=None: to_silver(None), lambda _, __=None: to_gold(None)):
        with pytest.raises(TransformError):
            call(None, RUN)
    with pytest.raises(TransformError, match="list"):
        payloads_from_list(spark, None)
    with pytest.raises(TransformError, match="JSON"):
        payloads_from_list(spark, [{"id": object()}])
    with pytest.raises(TransformError, match="payload"):
        to_bronze(spark.range(1), RUN)
    silver = to_silver(bronze_of(spark, ['{"id":"1"}']))
    with pytest.raises(TransformError, match=r"\['city'\]"):
        to_gold(silver.drop("city"))
    with pytest.raises(TransformError, match="city"):
        to_gold(silver.withColumnRenamed("city", "City"))
    bad = f"{path}/file"
    open(bad, "w").close()
    with pytest.raises(LoadError):
        write_gold(to_gold(silver), f"{bad}/below")
    assert issubclass(ApiResponseError, ExtractionError)
    for kind in (ExtractionError, TransformError, LoadError):
        assert issubclass(kind, EtlError)


def test_narrow_silver_is_a_projection_of_the_wide(spark, records):
    bronze = to_bronze(payloads_from_list(spark, records), RUN)
    narrow = to_silver(bronze, GOLD_KEYS)
    assert set(narrow.columns) == {"ingestion_timestamp", *GOLD_KEYS}
    wide = to_silver(bronze).select(*narrow.columns)
    assert narrow.collect() == wide.collect()
    assert set(SILVER_FIELDS) == set(RECORD.names)
