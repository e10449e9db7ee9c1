"""Which steps of the runs are slow: mergeable quantile sketches of their history.

Each run adds one row a layer, with sketches (KLL) of the milliseconds its steps took and of
the rows they read a second. Rows of any number of runs merge to quantiles without reading
the history again. A quantile is that of a rank which is at most ``RANK_ERROR`` from the one
asked for, with 99% certainty; a sketch of up to ``K`` values is exact. A row holds a few
kilobytes, however many steps it stands for.

Steps that have not ended are left out. A step that counts no rows, or that took less than a
millisecond, has no rate; a layer without rates has null there. Steps of schema drift are no
work and are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import LoadError
from ..schemas import table
from .drift import DRIFT_LAYER

K = 800
RANK_ERROR = 0.01

SKETCHES = table(
    "run_id string, layer string, steps bigint, millis_sketch binary, rated bigint, rate_sketch binary"
)


def step_sketches(history: DataFrame) -> DataFrame:
    """One row a run and layer of a history, see ``SKETCHES``."""
    millis = F.unix_millis("ended") - F.unix_millis("started")
    rows = F.coalesce("rows_in", "rows_out")
    steps = (
        history.where((F.col("layer") != DRIFT_LAYER) & F.col("ended").isNotNull())
        .select("run_id", "layer", millis.alias("millis"), rows.alias("rows"))
        .withColumn("rate", F.when(F.col("millis") > 0, F.floor(F.col("rows") * 1000 / F.col("millis"))))
    )
    return steps.groupBy("run_id", "layer").agg(
        F.count("millis").alias("steps"),
        F.kll_sketch_agg_bigint("millis", K).alias("millis_sketch"),
        F.count("rate").alias("rated"),
        F.kll_sketch_agg_bigint("rate", K).alias("rate_sketch"),
    )


def append_sketches(history: DataFrame, path: str) -> None:
    """Add the sketches of a history, usually of the one run that has just ended."""
    try:
        step_sketches(history).coalesce(1).write.mode("append").parquet(path)
    except Exception as exc:
        raise LoadError(f"step sketches could not be written to {path}: {exc}") from exc


def scan_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SKETCHES).parquet(path)


def slow_steps(sketches: DataFrame, tail: float = 0.95) -> DataFrame:
    """``layer, runs, steps, median_ms, tail_ms, median_rows_a_second``, the slowest layer first.

    ``tail_ms`` is the duration that a share of ``tail`` of the steps does not exceed.
    """
    merged = sketches.where("steps > 0").groupBy("layer").agg(
        F.count_distinct("run_id").alias("runs"),
        F.sum("steps").alias("steps"),
        F.kll_merge_agg_bigint("millis_sketch").alias("millis"),
        F.sum("rated").alias("rated"),
        F.kll_merge_agg_bigint("rate_sketch").alias("rate"),
    )

    def quantile(sketch: str, rank: float):
        return F.kll_sketch_get_quantile_bigint(sketch, F.lit(rank))

    return merged.select(
        "layer", "runs", "steps",
        quantile("millis", 0.5).alias("median_ms"),
        quantile("millis", tail).alias("tail_ms"),
        F.when(F.col("rated") > 0, quantile("rate", 0.5)).alias("median_rows_a_second"),
    ).orderBy(F.desc("median_ms"), "layer")
