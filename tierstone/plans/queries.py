"""Every operator as a query over the benchmark tables; ``oracles`` has the same in SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import suppress
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import ExtractionError, GateError
from ..functions.records import conform, parse_payload, payload_rows, to_payload, typed_records
from ..operators import gates
from ..operators.bottlenecks import RANK_ERROR, append_sketches, scan_sketches, slow_steps
from ..operators.bronze import Run, to_bronze
from ..operators.compaction import compact_silver, place_files
from ..operators.drift import scan_drift
from ..operators.gates import Gate
from ..operators.gold import count_by_place, to_gold
from ..operators.history import scan_history
from ..operators.paging import explode_pages, page_prefix
from ..operators.silver import all_null, latest_by_id, to_checked_silver, to_silver
from ..operators.sinks import (
    write_bronze,
    write_checked_silver,
    write_gold,
    write_raw,
    write_silver,
)
from ..schemas import GOLD_COUNT, GOLD_KEYS, RECORD, SILVER_FIELDS, SILVER_PARTITIONS
from ..session import path_exists, shared_scratch
from ..sources.layers import (
    scan_bronze,
    scan_checked_silver,
    scan_gold,
    scan_quarantine,
    scan_silver,
    stored,
)
from ..sources.paged import StoredPages, fetch_all
from ..sources.raw import read_raw_arrays, read_raw_lines
from ..streaming.latest import follow_latest, scan_latest
from .runs import LayerPaths, Mode, build_bronze, build_gold, build_silver, run_batch, run_gated
from .samples import (
    clean_payloads,
    customer_records,
    dirty_payloads,
    lineitem_records,
    load,
    order_records,
    spread,
)

RUN = Run(datetime(2025, 1, 1, 12, tzinfo=timezone.utc), "sample")
PAGE_SIZE = 100
API_PAGE_SIZE = 200
ARRAY_SIZE = 500
LARGE_ARRAY_SIZE = 20_000


def _stamped(silver: DataFrame) -> DataFrame:
    """Silver with its timestamp as a number, the same in every session time zone."""
    return silver.select(F.unix_micros("ingestion_timestamp").alias("ingested"), *SILVER_FIELDS)


def _customer_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(dirty_payloads(customer_records(spark, sf_dir)), RUN)


def _narrow_gold(payloads: DataFrame) -> DataFrame:
    """Bronze to Gold in memory; only the four keys are parsed."""
    return to_gold(to_silver(to_bronze(payloads, RUN), GOLD_KEYS))


# --- layers in memory -------------------------------------------------------


def gold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _narrow_gold(dirty_payloads(customer_records(spark, sf_dir)))


def gold_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _narrow_gold(clean_payloads(order_records(spark, sf_dir)))


def gold_lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _narrow_gold(clean_payloads(lineitem_records(spark, sf_dir)))


def gold_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prose where JSON is expected: every record survives, in the all-null group."""
    documents = spread(load(spark, sf_dir, "documents"), "doc_id")
    return _narrow_gold(documents.select(F.col("text").alias("payload")))


def silver_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(to_silver(_customer_bronze(spark, sf_dir)))


def silver_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts through JSON and back, shown by length and digest."""
    documents = spread(load(spark, sf_dir, "documents"), "doc_id").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("name"),
        F.col("lang").alias("country"),
        F.col("source").alias("brewery_type"),
    )
    return to_silver(to_bronze(payload_rows(conform(documents)), RUN)).select(
        "id",
        "country",
        "brewery_type",
        F.length("name").alias("n_chars"),
        F.md5("name").alias("digest"),
    )


def typed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_records(clean_payloads(customer_records(spark, sf_dir)))


def conformed_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with other columns brought to the record: some missing, some extra."""
    return conform(
        load(spark, sf_dir, "supplier").select(
            F.col("s_nationkey").alias("longitude"),
            F.col("s_name").alias("name"),
            F.col("s_suppkey").alias("id"),
            "s_acctbal",
        )
    )


def events_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parse with another declared schema."""
    events = load(spark, sf_dir, "events")
    return events.select("event_id", parse_payload("props", "k BIGINT").alias("p")).select(
        "event_id", "p.k"
    )


# --- layers through storage -------------------------------------------------


def bronze_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_scratch(spark, "bronze_fields")
    write_bronze(to_bronze(clean_payloads(customer_records(spark, sf_dir)), RUN), path)
    return scan_bronze(spark, path).select(
        F.unix_micros("ingestion_timestamp").alias("ingested"),
        F.col("ingestion_date").cast("string").alias("ingested_on"),
        "source_system",
        parse_payload("payload", "id STRING")["id"].alias("id"),
    )


def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_scratch(spark, "silver_roundtrip")
    write_silver(to_silver(_customer_bronze(spark, sf_dir)), path)
    return _stamped(scan_silver(spark, path))


def gold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each step on its own, from stored layer to stored layer."""
    paths = LayerPaths(shared_scratch(spark, "gold_roundtrip"))
    build_bronze(spark, dirty_payloads(customer_records(spark, sf_dir)), paths.bronze, RUN)
    build_silver(spark, paths)
    build_gold(spark, paths.silver, paths.gold)
    return scan_gold(spark, paths.gold)


def gold_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of the orders, written over the Gold of the customers."""
    path = shared_scratch(spark, "gold_overwrite")
    for payloads in (
        dirty_payloads(customer_records(spark, sf_dir)),
        clean_payloads(order_records(spark, sf_dir)),
    ):
        write_gold(_narrow_gold(payloads), path)
    return scan_gold(spark, path)


# --- sources ----------------------------------------------------------------


def _order_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """Pages of a hundred order keys, written once; also the number of the last page.

    A page gathers the rows of its own key range, so its size is bounded. The
    page three quarters of the way through is emptied.
    """
    orders = load(spark, sf_dir, "orders").select(
        (F.floor(F.col("o_orderkey") / PAGE_SIZE) + 1).alias("page_number"),
        to_payload(
            F.col("o_orderkey").cast("string").alias("id"),
            F.col("o_orderstatus").alias("brewery_type"),
        ).alias("payload"),
    )
    last = orders.agg(F.max("page_number")).first()[0] or 0
    emptied = F.col("page_number") == last * 3 // 4
    pages = (
        orders.groupBy("page_number")
        .agg(F.collect_list("payload").alias("records"))
        .withColumn("records", F.when(~emptied, F.col("records")).otherwise(F.array()))
        .withColumn("n_records", F.size("records"))
    )
    path = shared_scratch(spark, "order_pages")
    pages.write.parquet(path)
    return stored(spark, path, pages.schema), last


def page_prefix_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No cap: the emptied page ends the source."""
    pages, _ = _order_pages(spark, sf_dir)
    return typed_records(explode_pages(page_prefix(pages))).select("id", "brewery_type")


def page_cap_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cap of half the pages ends it before the emptied one does."""
    pages, last = _order_pages(spark, sf_dir)
    return typed_records(explode_pages(page_prefix(pages, last // 2))).select("id", "brewery_type")


def paged_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paged source, reading pages that Spark wrote, to the end of them."""
    pages = (
        customer_records(spark, sf_dir)
        .select(
            (F.floor(F.col("id").cast("bigint") / API_PAGE_SIZE) + 1).alias("page_number"),
            to_payload("id", "name", "country").alias("payload"),
        )
        .groupBy("page_number")
        .agg(F.concat_ws(", ", F.collect_list("payload")).alias("body"))
        .select("page_number", F.concat(F.lit("["), "body", F.lit("]")).alias("value"))
    )
    path = shared_scratch(spark, "paged_customers")
    pages.write.partitionBy("page_number").text(f"{path}/api")
    payloads = fetch_all(
        spark,
        StoredPages(f"{path}/api", API_PAGE_SIZE),
        f"{path}/landing",
        per_page=API_PAGE_SIZE,
        max_pages=None,
    )
    return typed_records(payloads).select("id", "name", "country")


def _array_files(
    spark: SparkSession, sf_dir: str, label: str, *extra: Column, size: int = ARRAY_SIZE
) -> str:
    """Customers packed into files of one JSON array each, of a bounded number of rows."""
    records = customer_records(spark, sf_dir)
    arrays = (
        records.select(
            F.floor(F.col("id").cast("bigint") / size).alias("file"),
            to_payload(*records.columns, *extra).alias("payload"),
        )
        .groupBy("file")
        .agg(F.concat_ws(", ", F.collect_list("payload")).alias("body"))
        .select(F.concat(F.lit("["), "body", F.lit("]")).alias("value"))
    )
    path = shared_scratch(spark, label)
    arrays.write.option("maxRecordsPerFile", 1).text(path)
    return path


def raw_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_records(read_raw_arrays(spark, _array_files(spark, sf_dir, "raw_array")))


def raw_array_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large files read in splits of 256 KB, of records that hold lists of objects and breaks in strings.

    The session of the read has the split size; nothing else is set in it.
    """
    inner = [F.struct(F.col("id").alias("a")), F.struct(F.lit("}, {").alias("a"))]
    nested = F.array(*inner).alias("parts"), F.array(F.lit('}, {"x": "\\'), "name").alias("notes")
    path = _array_files(spark, sf_dir, "raw_array_split", *nested, size=LARGE_ARRAY_SIZE)
    reading = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        reading.conf.set(name, spark.conf.get(name))
    reading.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    return typed_records(read_raw_arrays(reading, path))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW landing written, replaced by a retry, and read back."""
    root = shared_scratch(spark, "raw_lines")
    payloads = clean_payloads(customer_records(spark, sf_dir))
    for _ in range(2):
        path = write_raw(payloads, root, RUN.run_id)
    return typed_records(read_raw_lines(spark, path))


def raw_lossless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads that lines do not hold by themselves, through RAW and back."""
    key = F.col("c_custkey")
    text = key.cast("string")
    payload = (
        F.when(key % 8 == 1, "")
        .when(key % 8 == 2, F.repeat(F.lit(" \t"), (key % 5).cast("int")))
        .when(key % 8 == 3, F.concat(F.lit("line\n"), text, F.lit("\r\n")))
        .when(key % 8 == 4, F.concat(F.lit('"quoted '), text))
        .when(key % 8 == 5, "null")
        .when(key % 8 == 6, F.concat(F.lit('{"id": "'), text, F.lit('"}')))
        .when(key % 8 == 7, F.concat(F.lit("\n"), F.col("c_name"), F.lit("\\")))
    )
    payloads = load(spark, sf_dir, "customer").select(payload.alias("payload"))
    raw = write_raw(payloads, shared_scratch(spark, "raw_lossless"), RUN.run_id)
    return read_raw_lines(spark, raw)


# --- gates, runs, history ---------------------------------------------------


def gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check of every gate, with what it saw, in one pass over the records."""
    payloads = dirty_payloads(customer_records(spark, sf_dir))
    bronze = to_bronze(gates.probe(payloads), RUN)
    silver = to_silver(bronze)
    gold = count_by_place(to_silver(bronze, GOLD_KEYS))
    counts = gold.agg(
        F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum(GOLD_COUNT), F.lit(0)).alias("rows")
    )
    rows, without = F.col("rows"), silver.drop("phone").columns
    return gates.report_counts(
        counts,
        (gates.BRONZE_GATE, bronze.columns, rows),
        (gates.SILVER_GATE, silver.columns, rows),
        (gates.Gate("silver without phone", ("id", "phone")), without, rows),
        (gates.GOLD_GATE, gold.columns, F.col("groups")),
    )


#: Limits of the queries below: what the spoiling rule of ``samples`` keeps, and what it breaks.
RATES = {"id": 0.05, "name": 0.1, "state_province": 0.5, "phone": 1.0, "longitude": 0.2}


def null_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls of the limited columns of Silver and Gold, and which limits hold."""
    silver = to_silver(_customer_bronze(spark, sf_dir), list(RATES))
    gold = _narrow_gold(dirty_payloads(customer_records(spark, sf_dir)))
    in_gold = Gate("gold", (), null_rate={"city": 0.02, "state_province": 0.5})
    return gates.rate_report(silver, Gate("silver", (), null_rate=RATES)).union(
        gates.rate_report(gold, in_gold)
    )


def _audited(spark: SparkSession, sf_dir: str, label: str, mode: Mode) -> LayerPaths:
    """Three gated runs, of which the second is refused for its nulls."""
    paths = LayerPaths(shared_scratch(spark, label))
    records = customer_records(spark, sf_dir)
    for hour, payloads in enumerate((clean_payloads(records), dirty_payloads(records), clean_payloads(records))):
        limits = {"silver": {"id": 0.05}} if mode == "incremental" else {"bronze": {"payload": 0.0}, "silver": {"id": 0.02}}
        with suppress(GateError):
            run_gated(spark, payloads, paths, _at(hour), mode=mode, limits=limits)
    return paths


def audited_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of three audited plain runs: Bronze keeps the refused run's rows, Silver never shows them.

    The third run finds them in Bronze again, one broken id in 39, and is refused as well.
    """
    return scan_gold(spark, _audited(spark, sf_dir, "audited_append", "append_all").gold)


def audited_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each step of three audited incremental runs ended: a refused run leaves no trace."""
    paths = _audited(spark, sf_dir, "audited_incremental", "incremental")
    history = scan_history(spark, paths.history)
    counts = [F.coalesce(F.col(n), F.lit(-1)).cast("bigint").alias(n) for n in ("rows_out", "null_rows")]
    steps = history.where(F.col("layer").isin("bronze", "silver", "gold"))
    return steps.select("run_id", "layer", *counts, "status").unionByName(
        scan_gold(spark, paths.gold).agg(
            F.lit("all").alias("run_id"),
            F.lit("records in gold").alias("layer"),
            F.sum(GOLD_COUNT).alias("rows_out"),
            F.lit(-1).cast("bigint").alias("null_rows"),
            F.lit("ok").alias("status"),
        )
    )


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and quarantine of one write: rows by status, their ids and payloads."""
    path = shared_scratch(spark, "quarantine")
    write_checked_silver(to_checked_silver(_customer_bronze(spark, sf_dir)), path)
    read = scan_checked_silver(spark, path).select(
        F.lit("read").alias("status"), "id", "longitude", F.lit(None).cast("string").alias("payload")
    )
    kept = scan_quarantine(spark, path).select(
        "status", F.lit(None).cast("string").alias("id"), F.lit(None).cast("double").alias("longitude"),
        F.substring("payload", 1, 20).alias("payload"),
    )
    return read.unionByName(kept)


def _three_versions(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """Payloads of three runs: all customers, those moved since (key % 3 = 0), all but key % 5 = 0 renamed."""
    records, key = customer_records(spark, sf_dir), F.col("id").cast("bigint")
    yield clean_payloads(records)
    yield clean_payloads(records.where(key % 3 == 0).withColumn("city", F.lit("Moved")))
    renamed = records.where(key % 5 != 0).withColumn("name", F.concat("name", F.lit(" & Co")))
    # A third of these rows have no id, another tenth one and the same.
    anonymous = F.when(key % 3 == 1, None).when(key % 10 == 2, "hot").otherwise(F.col("id"))
    yield clean_payloads(renamed.withColumn("id", anonymous))


def latest_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of the latest record of each id after three incremental runs, of which one came twice."""
    paths = LayerPaths(shared_scratch(spark, "latest_records"))
    for hour, payloads in enumerate(_three_versions(spark, sf_dir)):
        for _ in range(2 if hour == 1 else 1):
            build_bronze(spark, payloads, paths.bronze, _at(hour), mode="incremental")
            build_silver(spark, paths, mode="incremental")
    return to_gold(latest_by_id(scan_silver(spark, paths.silver)))


def latest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same Gold from keyed state: each run reads the Bronze it has not seen."""
    root = shared_scratch(spark, "latest_incremental")
    paths = LayerPaths(root)
    for hour, payloads in enumerate(_three_versions(spark, sf_dir)):
        build_bronze(spark, payloads, paths.bronze, _at(hour), mode="incremental")
        for _ in range(2 if hour == 1 else 1):
            follow_latest(spark, paths.bronze, f"{root}/latest", f"{root}/latest_state")
    silver = to_silver(scan_bronze(spark, paths.bronze))
    return to_gold(scan_latest(spark, f"{root}/latest", silver))


def gold_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold kept by the counts of three incremental runs, of which one came twice."""
    paths = LayerPaths(shared_scratch(spark, "gold_maintained"))
    for hour, payloads in enumerate(_three_versions(spark, sf_dir)):
        for _ in range(2 if hour == 1 else 1):
            run_batch(spark, payloads, paths, _at(hour), mode="incremental", maintained=True)
    return scan_gold(spark, paths.gold)


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each layer, and Silver rows of which nothing could be read, in one pass."""
    silver = to_silver(_customer_bronze(spark, sf_dir))
    groups = silver.groupBy(*GOLD_KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(all_null()).alias("nulls")
    )
    total = groups.agg(
        F.count(F.lit(1)).alias("groups"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("nulls"),
    )
    none = F.lit(0).cast("bigint")
    layers = (("bronze", F.col("n"), none), ("silver", F.col("n"), F.col("nulls")), ("gold", F.col("groups"), none))
    rows = [F.struct(F.lit(name).alias("layer"), n.alias("n_rows"), nulls.alias("null_rows")) for name, n, nulls in layers]
    return total.select(F.inline(F.array(*rows)))


def _at(hour: int) -> Run:
    return Run(RUN.ts + timedelta(hours=hour), RUN.source_system)


def rerun_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after three plain runs: 3 copies in Bronze, 1 + 2 + 3 in Silver."""
    paths = LayerPaths(shared_scratch(spark, "rerun_append"))
    payloads = clean_payloads(customer_records(spark, sf_dir))
    for hour in range(3):
        run_batch(spark, payloads, paths, _at(hour))
    return scan_gold(spark, paths.gold)


def rerun_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after two incremental runs, the first of them repeated."""
    paths = LayerPaths(shared_scratch(spark, "rerun_incremental"))
    payloads = clean_payloads(customer_records(spark, sf_dir))
    for hour in (0, 0, 1):
        run_batch(spark, payloads, paths, _at(hour), mode="incremental")
    return scan_gold(spark, paths.gold)


def rerun_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after runs of two sources at one clock, the first of them repeated."""
    paths = LayerPaths(shared_scratch(spark, "rerun_sources"))
    payloads = clean_payloads(customer_records(spark, sf_dir))
    for source in ("sample", "other", "sample"):
        run_gated(spark, payloads, paths, Run(RUN.ts, source), mode="incremental", history=False)
    return scan_gold(spark, paths.gold)


def gold_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many neighbours in stored Gold are out of order, within and between its files."""
    path = shared_scratch(spark, "gold_order")
    write_gold(_narrow_gold(clean_payloads(customer_records(spark, sf_dir))), path)
    # Rows of Gold are few: its groups. Files are numbered in the order they were sorted.
    place = (F.col("_metadata.file_name"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    before = F.lag("num_breweries").over(Window.orderBy("file", "block", "row"))
    rows = spark.read.parquet(path).select(
        "num_breweries", *(c.alias(n) for c, n in zip(place, ("file", "block", "row"), strict=True))
    )
    wrong = F.count_if(F.col("before") < F.col("num_breweries"))
    return rows.withColumn("before", before).agg(wrong.alias("out_of_order"))


def empty_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What runs without gates and with them leave behind when the source has no record."""
    payloads = clean_payloads(customer_records(spark, sf_dir)).where("payload IS NULL")
    paths = LayerPaths(shared_scratch(spark, "empty_run"))
    run_batch(spark, payloads, paths, RUN, history=True)
    with suppress(ExtractionError):
        run_gated(spark, payloads, paths, RUN)
    return scan_history(spark, paths.history).select(
        "layer", "status", F.lit(path_exists(spark, paths.bronze)).alias("wrote_bronze")
    )


def _gated(spark: SparkSession, payloads: DataFrame, label: str) -> LayerPaths:
    paths = LayerPaths(shared_scratch(spark, label))
    run_gated(spark, payloads, paths, RUN)
    return paths


def gated_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = dirty_payloads(customer_records(spark, sf_dir))
    return scan_gold(spark, _gated(spark, payloads, "gated_run").gold)


def gated_lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole gated run over the largest table."""
    payloads = clean_payloads(lineitem_records(spark, sf_dir))
    return scan_gold(spark, _gated(spark, payloads, "gated_lineitems").gold)


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every step of a gated run; -1 stands for a count the step does not take."""
    payloads = dirty_payloads(customer_records(spark, sf_dir))
    history = scan_history(spark, _gated(spark, payloads, "run_history").history)
    counts = ("rows_in", "rows_out", "null_rows")
    return history.select(
        "run_id",
        "layer",
        *(F.coalesce(F.col(name), F.lit(-1)).cast("bigint").alias(name) for name in counts),
        "status",
    )


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run notes of a source that adds, renames and retypes keys; a cut text has no keys."""
    records = customer_records(spark, sf_dir)
    key = F.col("id").cast("bigint")
    rating = F.when(key % 5 == 0, F.to_variant_object(F.array(key))).when(key % 5 == 1, key.cast("variant"))
    longitude = F.when(key % 11 == 0, F.col("longitude").cast("string").cast("variant"))
    fields = [
        F.coalesce(longitude, F.col("longitude").cast("variant")).alias(n) if n == "longitude"
        else F.col(n).alias("town") if n == "city"
        else F.col(n)
        for n in RECORD.names
    ]
    text = to_payload(*fields, rating.alias("rating"))
    payloads = records.select(
        F.when(key % 13 == 0, F.substring(text, 1, 20)).otherwise(text).alias("payload")
    )
    paths = LayerPaths(shared_scratch(spark, "schema_drift"))
    run_batch(spark, payloads, paths, RUN, mode="incremental", drift=True)
    return scan_drift(spark, paths.history)


def slow_event_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as steps of 24 runs: whether merged sketches give quantiles within their stated error."""
    events = load(spark, sf_dir, "events")
    millis = F.floor(F.abs(F.col("value")) * 100).cast("bigint")
    started = F.timestamp_millis(F.col("event_id"))
    history = events.select(
        (F.col("event_id") % 24).cast("string").alias("run_id"),
        F.col("event_type").alias("layer"),
        F.col("user_id").cast("bigint").alias("rows_in"),
        F.lit(None).cast("bigint").alias("rows_out"),
        started.alias("started"),
        F.timestamp_millis(F.col("event_id") + millis).alias("ended"),
        millis.alias("millis"),
    )
    path = shared_scratch(spark, "slow_steps")
    append_sketches(history, path)
    found = slow_steps(scan_sketches(spark, path))

    def within(quantile: str, rank: float) -> Column:
        below = F.avg((F.col("millis") < F.col(quantile)).cast("int"))
        up_to = F.avg((F.col("millis") <= F.col(quantile)).cast("int"))
        return (below - RANK_ERROR <= rank) & (up_to + RANK_ERROR >= rank)

    return (
        history.select("layer", "millis").join(found, "layer")
        .groupBy("layer", "runs", "steps")
        .agg(within("median_ms", 0.5).alias("median_within"), within("tail_ms", 0.95).alias("tail_within"))
    )


def compacted_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of four appends, compacted: rows and files of each place before and after."""
    path = shared_scratch(spark, "compacted_silver")
    silver = to_silver(_customer_bronze(spark, sf_dir))
    for _ in range(4):
        write_silver(silver, path)

    def state() -> DataFrame:
        rows = scan_silver(spark, path).groupBy(*SILVER_PARTITIONS).agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids")
        )
        return rows.join(_none_safe(place_files(spark, path).drop("bytes")), _same_place()).drop(*_PLACE)

    before = f"{path}-before"
    state().write.parquet(before)
    compact_silver(spark, path)
    first = _none_safe(spark.read.parquet(before).withColumnsRenamed({"rows": "rows_before", "files": "files_before"}).drop("ids"))
    return state().join(first, _same_place()).select(
        *SILVER_PARTITIONS, "rows_before", "rows", "ids",
        (F.col("files_before") >= 4).alias("had_many"), F.col("files"),
    )


_PLACE = [f"_{name}" for name in SILVER_PARTITIONS]


def _none_safe(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed(dict(zip(SILVER_PARTITIONS, _PLACE, strict=True)))


def _same_place() -> Column:
    country, state = (F.col(a).eqNullSafe(F.col(b)) for a, b in zip(SILVER_PARTITIONS, _PLACE, strict=True))
    return country & state


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "gold_counts": gold_counts,
    "gold_orders": gold_orders,
    "gold_lineitems": gold_lineitems,
    "gold_malformed": gold_malformed,
    "silver_parse": silver_parse,
    "silver_documents": silver_documents,
    "typed_records": typed_customers,
    "conformed_records": conformed_suppliers,
    "events_props": events_props,
    "bronze_fields": bronze_fields,
    "silver_roundtrip": silver_roundtrip,
    "gold_roundtrip": gold_roundtrip,
    "gold_overwrite": gold_overwrite,
    "page_prefix": page_prefix_orders,
    "page_cap": page_cap_orders,
    "paged_source": paged_customers,
    "raw_array": raw_array,
    "raw_array_split": raw_array_split,
    "raw_lines": raw_lines,
    "raw_lossless": raw_lossless,
    "gate_report": gate_report,
    "layer_counts": layer_counts,
    "null_rates": null_rates,
    "audited_append": audited_append,
    "audited_incremental": audited_incremental,
    "quarantine": quarantine,
    "latest_records": latest_records,
    "latest_incremental": latest_incremental,
    "gold_maintained": gold_maintained,
    "rerun_append": rerun_append,
    "rerun_incremental": rerun_incremental,
    "rerun_sources": rerun_sources,
    "gold_order": gold_order,
    "empty_run": empty_run,
    "gated_run": gated_run,
    "gated_lineitems": gated_lineitems,
    "run_history": run_history,
    "schema_drift": schema_drift,
    "slow_steps": slow_event_steps,
    "compacted_silver": compacted_silver,
}
