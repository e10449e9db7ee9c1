"""Records made from the benchmark tables: the only joins of the package.

The tables carry no JSON, so each query first shapes their rows into records of
the declared schema and writes those as JSON text. Joined sides are left to the
optimizer, which broadcasts by measured size and sorts beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.records import conform, to_payload
from ..schemas import RECORD


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame, key: str) -> DataFrame:
    """A scan in fewer splits than there are slots, shuffled once over all of them.

    JSON work is paid per row, and one small file of one row group would leave it
    to one task. A scan that fills the slots by itself is returned as it is.
    """
    slots = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= slots else scan.repartition(slots, key)


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.col("n_name").alias("state_province"), F.col("r_name").alias("country")
    )


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per customer, placed in their nation."""
    customer, places = spread(load(spark, sf_dir, "customer"), "c_custkey"), _places(spark, sf_dir)
    joined = customer.join(places, customer.c_nationkey == places.n_nationkey)
    return conform(
        joined.select(
            F.col("c_custkey").cast("string").alias("id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("brewery_type"),
            F.concat(F.lit("City_"), F.col("c_custkey") % 7).alias("city"),
            "state_province",
            "country",
            F.lpad(F.col("c_custkey").cast("string"), 12, "0").alias("postal_code"),
            F.col("c_acctbal").alias("longitude"),
            F.col("state_province").alias("state"),
        )
    )


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per order, placed where its customer is."""
    orders = spread(load(spark, sf_dir, "orders"), "o_orderkey")
    customer = load(spark, sf_dir, "customer")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        _places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return conform(
        joined.select(
            F.col("o_orderkey").cast("string").alias("id"),
            F.col("c_name").alias("name"),
            F.col("o_orderstatus").alias("brewery_type"),
            F.col("o_orderpriority").alias("city"),
            "state_province",
            "country",
            F.col("o_totalprice").alias("latitude"),
        )
    )


def lineitem_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per order line, placed where its supplier is."""
    lineitem = spread(load(spark, sf_dir, "lineitem"), "l_orderkey")
    supplier = load(spark, sf_dir, "supplier")
    joined = lineitem.join(supplier, lineitem.l_suppkey == supplier.s_suppkey).join(
        _places(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return conform(
        joined.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
            F.col("s_name").alias("name"),
            F.col("l_returnflag").alias("brewery_type"),
            F.col("l_linestatus").alias("city"),
            "state_province",
            "country",
            F.col("l_extendedprice").alias("longitude"),
            F.col("l_discount").alias("latitude"),
        )
    )


def clean_payloads(records: DataFrame) -> DataFrame:
    return records.select(to_payload(*RECORD.names).alias("payload"))


def dirty_payloads(records: DataFrame) -> DataFrame:
    """The same records, some spoilt by a rule on their key; none is left out.

    key % 19 = 0: state missing, else key % 17 = 0: state empty;
    key % 13 = 0: text cut to 20 characters, else key % 11 = 0: longitude in quotes.
    """
    key = F.col("id").cast("bigint")
    spoilt = records.withColumn(
        "state_province",
        F.when(key % 19 == 0, None).when(key % 17 == 0, "").otherwise(F.col("state_province")),
    )

    def text(longitude: Column) -> Column:
        return to_payload(
            *(longitude.alias(n) if n == "longitude" else F.col(n) for n in RECORD.names)
        )

    plain = text(F.col("longitude"))
    return spoilt.select(
        F.when(key % 13 == 0, F.substring(plain, 1, 20))
        .when(key % 11 == 0, text(F.col("longitude").cast("string")))
        .otherwise(plain)
        .alias("payload")
    )
