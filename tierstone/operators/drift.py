"""Schema drift: how the keys of the records differ from the declared ones.

A parse with a declared schema never fails, so a source that renames a key or changes its
type shows as nulls only. Here each record is read as a variant, its keys are counted by
the kind of their values (``string number boolean object array null``), and what differs
becomes rows of the run history:

``extra``    a key that is not declared, by kind
``retyped``  a declared key with another kind; a null is of every kind
``absent``   a declared key that no record has

Keys are compared as they are written. Text that is no JSON object (malformed, missing, a
key twice in a record) has no keys and counts nothing; a table without any object has all
declared keys absent. Counts are taken before the shuffle, one row a key and kind of a task,
so a key that all records share is no hot one, and no list of keys is held anywhere, also
where keys are data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

from ..errors import LoadError
from ..schemas import RECORD
from .history import HISTORY, scan_history

DRIFT_LAYER = "drift"


#: How Spark names the types of a variant, by the JSON kind of the value; all others are numbers.
_KINDS = {"VOID": "null", "STRING": "string", "BOOLEAN": "boolean", "OBJECT": "object", "ARRAY": "array"}


def _mapped(pairs: dict[str, str], key: str) -> Column:
    return F.create_map(*(F.lit(part) for pair in pairs.items() for part in pair))[F.col(key)]


def declared_kinds(schema: StructType) -> dict[str, str]:
    return {
        f.name: "number" if isinstance(f.dataType, NumericType) else "string" for f in schema.fields
    }


def key_counts(payloads: DataFrame) -> DataFrame:
    """``key, found, records``: in how many records a key has a value of a kind."""
    spark = payloads.sparkSession
    records = payloads.select(F.try_parse_json("payload").alias("v"))
    # Elements of a list have no key, and what is neither list nor object has no row.
    fields = records.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    return (
        fields.where("key IS NOT NULL")
        .groupBy("key", kind.alias("kind"))
        .agg(F.count(F.lit(1)).alias("records"))
        .select("key", F.coalesce(_mapped(_KINDS, "kind"), F.lit("number")).alias("found"), "records")
        .groupBy("key", "found")
        .agg(F.sum("records").alias("records"))
    )


def drift(payloads: DataFrame, schema: StructType = RECORD) -> DataFrame:
    """``change, key, declared, found, records`` of all that differs, from one scan; see the module."""
    kinds = declared_kinds(schema)
    declared = payloads.sparkSession.createDataFrame([(key,) for key in kinds], "key string").select(
        "key", F.lit(None).cast("string").alias("found"), F.lit(0).cast("bigint").alias("records")
    )
    # A key has at most six kinds and its declared row.
    keys = (
        key_counts(payloads)
        .unionByName(declared)
        .groupBy("key")
        .agg(F.sum("records").alias("all"), F.collect_list(F.struct("found", "records")).alias("kinds"))
        .select("key", _mapped(kinds, "key").alias("declared"), "all", F.explode("kinds").alias("kind"))
        .select("key", "declared", "all", "kind.*")
    )
    change = (
        F.when(F.col("declared").isNull(), "extra")
        .when(F.col("all") == 0, "absent")
        .when((F.col("found") != "null") & (F.col("found") != F.col("declared")), "retyped")
    )
    names = ("change", "key", "declared", "found", "records")
    return keys.withColumn("change", change).where("change IS NOT NULL").select(*names)


def append_drift(payloads: DataFrame, path: str, run_id: str, schema: StructType = RECORD) -> None:
    """Add what differs to the run history at ``path``: a row each, the records in ``rows_in``.

    The status is a JSON object of the change, so that any key can be read back from it.
    """
    status = F.to_json(F.struct("change", "key", "declared", "found"))
    now = F.current_timestamp()
    rows = drift(payloads, schema).select(
        F.lit(run_id).alias("run_id"), F.lit(DRIFT_LAYER).alias("layer"),
        F.col("records").alias("rows_in"), F.lit(None).cast("bigint").alias("rows_out"),
        F.lit(None).cast("bigint").alias("null_rows"), now.alias("started"), now.alias("ended"),
        status.alias("status"),
    )
    try:
        rows.select(*HISTORY.names).write.mode("append").parquet(path)
    except Exception as exc:
        raise LoadError(f"schema drift could not be written to {path}: {exc}") from exc


def scan_drift(spark: SparkSession, path: str) -> DataFrame:
    """``run_id, change, key, declared, found, records`` of all runs of a history."""
    rows = scan_history(spark, path).where(F.col("layer") == DRIFT_LAYER)
    change = F.from_json("status", "change string, key string, declared string, found string")
    return rows.select("run_id", "rows_in", change.alias("c")).select(
        "run_id", "c.*", F.col("rows_in").alias("records")
    )
