"""Mixing sources to target weights with whole documents, repeated in epochs where needed.

Each document has a hash of its id as random key. The key range of a source with n
documents is cut into about sqrt(n) equal buckets; prefix sums of the token counts run
over the buckets of a source and over the rows of a bucket, so no task sees more than
about sqrt(n) rows of one group, however large its source. Whole epochs take every
document; the last one takes, in key order, the documents that lie before the budget
that is left, the one on the edge if most of it does. Sums per source are small tables.

Cases: a null source is a source of its own, after all others; a null or empty text
has size 0, as have all texts of separators only, and is taken in whole epochs and
never in the last one. Rows that are repeated count each; a null id has a key like
any other. A source whose texts are all empty has target 0. An empty table gives an
empty result. ``mix`` carries other columns along whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import shared_scratch

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2


def size_of(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def _random_key(doc_id: Column) -> Column:
    """A number from 0 to 1 (excluded) of 52 random bits, the same in each run."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    digits = F.substring(F.md5(F.concat(text, F.lit(":mix"))), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(1 << 52))


def targets(
    sources: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
) -> DataFrame:
    """``source, source_size, n_docs, target`` from ``source, source_size, n_docs``.

    Shares by weight that stop at a cap fill up like linked vessels: sources whose cap
    is smallest for their weight are full first, and the level of the others is what is
    left over their weights. One row a source, so the windows over them are small.
    """
    order = W.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    rows = sources.withColumn("weight", weight).withColumn(
        "cap", F.lit(float(max_epochs)) * F.col("source_size")
    )
    fullest = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before, after = fullest.rowsBetween(W.unboundedPreceding, -1), fullest.rowsBetween(0, W.unboundedFollowing)
    total = F.sum("source_size").over(W.partitionBy()) * F.lit(float(share))
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    rows = rows.withColumn("level", level)
    # The level at the first source that it does not fill holds for all after it.
    open_level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(W.partitionBy())
    target = F.least(F.col("cap"), F.coalesce(open_level, F.lit(float("inf"))) * F.col("weight"))
    return rows.withColumn("target", target).select("source", "source_size", "n_docs", "target")


def plan_mix(docs: DataFrame, key: Sequence[str] = ("doc_id",), **parameters) -> DataFrame:
    """``key..., size, source_size, target, epochs, taken`` for every document.

    ``epochs`` is how often the mix holds the document, ``taken`` its words in the mix.
    The texts are read once, for their sizes.
    """
    spark = docs.sparkSession
    path = shared_scratch(spark, "mix_sizes")
    names = list(dict.fromkeys(["doc_id", *key]))
    docs.select(*names, "source", size_of(F.col("text")).alias("size")).write.parquet(path)
    rows = spark.read.parquet(path)
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    goal = targets(sums, **parameters).select(
        F.col("source").alias("_source"), "source_size", "n_docs", "target"
    )
    random = _random_key(F.col("doc_id"))
    keyed = (
        rows.join(goal, rows["source"].eqNullSafe(goal["_source"]))
        .withColumn("random", random)
        .withColumn("bucket", F.floor(F.col("random") * F.ceil(F.sqrt("n_docs"))).cast("bigint"))
    )
    # Hashing the bucket along with its source spreads a large source over all tasks.
    in_bucket = W.partitionBy("source", "bucket").orderBy("random", *names, "size")
    buckets = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    over_buckets = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = buckets.select(
        F.col("source").alias("_source"),
        F.col("bucket").alias("_bucket"),
        F.coalesce(F.sum("bucket_size").over(over_buckets), F.lit(0)).alias("bucket_start"),
    )
    before = F.col("bucket_start") + F.col("rows_before")
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    left = F.col("target") - F.col("full") * F.col("source_size")
    in_last = (F.col("size") > 0) & (F.col("before") + F.col("size") / 2 <= F.col("left"))
    return (
        keyed.withColumn(
            "rows_before",
            F.coalesce(F.sum("size").over(in_bucket.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
        )
        .drop("_source")
        .join(starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket")))
        .withColumn("before", before)
        .withColumn("full", full.cast("int"))
        .withColumn("left", left)
        .withColumn("epochs", F.col("full") + in_last.cast("int"))
        .withColumn("taken", F.col("epochs") * F.col("size"))
        .select(*names, "size", "source_size", F.col("target"), "epochs", F.col("taken").cast("bigint"))
    )


def mix(docs: DataFrame, **parameters) -> DataFrame:
    """The mixture: each document as often as the plan takes it, with all its columns."""
    # A hash of the whole row tells rows apart where an id is repeated.
    rows = docs.select(F.struct("*").alias("doc"), F.xxhash64(*docs.columns).alias("row"))
    flat = rows.select("row", "doc.doc_id", "doc.source", "doc.text")
    plan = plan_mix(flat, ["row"], **parameters).where("epochs > 0")
    plan = plan.groupBy(F.col("row").alias("_row"), F.col("doc_id").alias("_id")).agg(
        F.sum("epochs").cast("int").alias("epochs")
    )
    found = rows.join(plan, (F.col("row") == F.col("_row")) & F.col("doc.doc_id").eqNullSafe(F.col("_id")))
    # Equal rows are one group of this aggregate, which needs no shuffle after the join.
    return (
        found.groupBy("row", "_id")
        .agg(F.any_value("doc").alias("doc"), F.any_value("epochs").alias("epochs"))
        .select("doc", F.explode(F.array_repeat(F.lit(1), F.col("epochs"))))
        .select("doc.*")
    )
