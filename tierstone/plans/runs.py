"""Whole runs and single steps, each from stored input to stored output.

Two ways of re-running:

``append_all``
    Bronze is appended, and Silver appends all of Bronze again. After n equal
    runs Bronze holds n copies of each record and Silver n(n+1)/2.
``incremental``
    A run has its own Bronze folder, written once, and Silver takes only Bronze
    files it has not seen. Repeating a run changes nothing, and repeating one that failed
    asks a paged source only for the pages that were not landed.

The two lay out Bronze and Silver differently, so each needs paths of its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager, suppress
from dataclasses import dataclass, field, replace
from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gates
from ..operators.bottlenecks import append_sketches
from ..operators.bronze import Run, to_bronze
from ..operators.drift import append_drift
from ..operators.gold import to_gold
from ..operators.history import Step, append_history, counting, recorded, step_rows
from ..operators.maintained import merge_counts, run_bronze, run_counts, scan_counts, write_run_counts
from ..operators.publish import Audit
from ..operators.silver import all_null, to_silver
from ..operators.sinks import (
    bronze_mode,
    bronze_run_is_done,
    has_sink_log,
    write_bronze,
    write_bronze_run,
    write_gold,
    write_raw,
    write_silver,
)
from ..errors import LoadError
from ..functions.records import parse_payload, record_schema
from ..schemas import GOLD_COUNT, RECORD, SILVER
from ..sources.layers import scan_bronze, scan_silver, stored
from ..sources.paged import DEFAULT_PER_PAGE, Fetcher, fetch_all, probe_pages
from ..sources.raw import read_raw_lines
from ..streaming.incremental import follow_bronze

Mode = Literal["append_all", "incremental"]
#: Largest share of nulls by layer and column, as ``{"silver": {"id": 0.05}}``.
Limits = Mapping[str, Mapping[str, float]]


@dataclass(frozen=True)
class LayerPaths:
    """Where a run reads and writes; all below one root by default."""

    root: str
    bronze: str = ""
    silver: str = ""
    gold: str = ""
    raw: str = ""
    pages: str = ""
    history: str = ""
    checkpoint: str = ""
    counts: str = ""
    sketches: str = ""

    def __post_init__(self) -> None:
        for name in (
            "bronze", "silver", "gold", "raw", "pages", "history", "checkpoint", "counts", "sketches",
        ):
            if not getattr(self, name):
                object.__setattr__(self, name, f"{self.root.rstrip('/')}/{name}")


@dataclass(frozen=True)
class PagedInput:
    """A paged source as input of a run."""

    fetch: Fetcher
    per_page: int = DEFAULT_PER_PAGE
    max_pages: int | None = None


@dataclass
class RunReport:
    """How a run went; ``completed`` is false when it stopped for want of records."""

    run_id: str
    steps: list[Step] = field(default_factory=list)
    completed: bool = False


# --- single steps -----------------------------------------------------------


def limited(limits: Limits | None, run_id: str, layer: str) -> Audit | None:
    """The audit of a layer's write, or None where nothing limits it."""
    gate = {"bronze": gates.BRONZE_GATE, "silver": gates.SILVER_GATE, "gold": gates.GOLD_GATE}[layer]
    rates = (limits or {}).get(layer)
    return Audit(run_id, (replace(gate, null_rate=rates),)) if rates else None


def _limited_run(limits: Limits | None, run: Run) -> Audit | None:
    """The audit of an incremental run: its Silver limits hold before it enters Bronze.

    What is in Bronze reaches Silver sooner or later. So the limited fields are parsed
    in the write of Bronze, and a refused run is in neither.
    """
    found = [a for layer in ("bronze", "silver") if (a := limited(limits, run.run_id, layer))]
    fields = [name for name in (limits or {}).get("silver", {}) if name in RECORD.names]
    parsed = parse_payload("payload", record_schema(fields)) if fields else None
    columns = {name: parsed[name] for name in fields}
    return Audit(run.run_id, tuple(g for a in found for g in a.gates), columns) if found else None


def extract(
    spark: SparkSession,
    source: DataFrame | PagedInput,
    paths: LayerPaths,
    run: Run,
    *,
    resume: bool = False,
) -> DataFrame:
    """The ``payload`` rows of a source. Pages are fetched once, into tables of the run.

    ``resume`` keeps the pages that a failed attempt of the same run has landed.
    """
    if isinstance(source, DataFrame):
        return source
    landing = f"{paths.pages}/run_id={run.run_id}"
    return fetch_all(
        spark, source.fetch, landing,
        per_page=source.per_page, max_pages=source.max_pages, resume=resume,
    )


def build_bronze(
    spark: SparkSession,
    payloads: DataFrame | None,
    path: str,
    run: Run,
    *,
    mode: Mode = "append_all",
    step: Step | None = None,
    limits: Limits | None = None,
) -> Step:
    """``payload`` rows -> Bronze on disk; none are needed for a run that it holds."""
    step = step or Step(run.run_id, "bronze")
    if mode == "incremental":
        if bronze_run_is_done(spark, path, run):
            step.status = "already done"
            return step
    bronze = to_bronze(payloads, run)
    counted, fill = counting(bronze, step, null_rows=F.count_if(F.col("payload").isNull()))
    if mode == "incremental":
        write_bronze_run(counted, path, run, _limited_run(limits, run))
    else:
        write_bronze(counted, path, limited(limits, run.run_id, "bronze"))
    fill()
    return step


def build_silver(
    spark: SparkSession,
    paths: LayerPaths,
    *,
    run_id: str = "",
    mode: Mode = "append_all",
    partitions: int | None = None,
    step: Step | None = None,
    bronze: DataFrame | None = None,
    limits: Limits | None = None,
) -> Step:
    """Bronze on disk -> Silver on disk: all of it, or the files not yet seen.

    ``bronze`` is the scan of stored Bronze where the caller has one: its files
    are then not listed again.
    """
    step = step or Step(run_id, "silver")
    if mode == "incremental":
        followed = follow_bronze(
            spark, paths.bronze, paths.silver, paths.checkpoint, partitions=partitions
        )
        step.rows_in = step.rows_out = followed.rows
        step.null_rows = followed.null_rows
        return step
    if bronze is None:
        bronze = scan_bronze(spark, paths.bronze)
    counted, fill = counting(to_silver(bronze), step, null_rows=F.count_if(all_null()))
    write_silver(counted, paths.silver, partitions, limited(limits, step.run_id, "silver"))
    fill()
    return step


def build_gold(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    *,
    run_id: str = "",
    step: Step | None = None,
    silver: DataFrame | None = None,
    limits: Limits | None = None,
) -> Step:
    """Silver on disk -> Gold on disk; ``silver`` as ``bronze`` above."""
    step = step or Step(run_id, "gold")
    if silver is None:
        silver = scan_silver(spark, silver_path)
    counted, fill = counting(to_gold(silver), step, rows_in=F.sum(GOLD_COUNT))
    write_gold(counted, gold_path, limited(limits, step.run_id, "gold"))
    fill()
    return step


def build_maintained_gold(
    spark: SparkSession,
    paths: LayerPaths,
    run: Run,
    *,
    step: Step | None = None,
    limits: Limits | None = None,
) -> Step:
    """Gold after an incremental run, from the run's own rows and the counts of earlier runs.

    A run reads its Bronze folder and one row a group and run, whatever Silver has grown to.
    """
    step = step or Step(run.run_id, "gold")
    counted, fill = counting(
        run_counts(run_bronze(spark, paths.bronze, run)), step, rows_in=F.sum(GOLD_COUNT)
    )
    write_run_counts(counted, paths.counts, run)
    fill()
    whole = Step(run.run_id, "gold")
    counted, fill = counting(merge_counts(scan_counts(spark, paths.counts)), whole)
    write_gold(counted, paths.gold, limited(limits, run.run_id, "gold"))
    fill()
    step.rows_out = whole.rows_out
    return step


# --- whole runs -------------------------------------------------------------


@contextmanager
def _history(
    spark: SparkSession, report: RunReport, paths: LayerPaths, keep: bool, sketches: bool = False
) -> Iterator[None]:
    """Write the history at the end; a fault there never hides the run's own."""

    def write() -> None:
        if keep:
            append_history(spark, report.steps, paths.history)
        if sketches:
            append_sketches(step_rows(spark, report.steps), paths.sketches)

    try:
        yield
    except BaseException:
        with suppress(LoadError):
            write()
        raise
    write()


def _refuse_mixed(spark: SparkSession, paths: LayerPaths, mode: Mode) -> None:
    """Fail before the first write where stored layers are kept by the other mode."""
    other = "plain" if mode == "incremental" else "incremental"
    kept = bronze_mode(spark, paths.bronze)
    if kept is not None and kept != mode:
        raise LoadError(f"Bronze in {paths.bronze} is kept by {other} runs")
    followed = has_sink_log(spark, paths.silver)
    if followed if mode == "append_all" else (
        not followed and not stored(spark, paths.silver, SILVER).isEmpty()
    ):
        raise LoadError(f"Silver in {paths.silver} is kept by {other} runs")


def run_batch(
    spark: SparkSession,
    source: DataFrame | PagedInput,
    paths: LayerPaths,
    run: Run,
    *,
    mode: Mode = "append_all",
    partitions: int | None = None,
    history: bool = False,
    maintained: bool = False,
    drift: bool = False,
    sketches: bool = False,
) -> RunReport:
    """Source -> Bronze -> Silver -> Gold without gates.

    ``maintained`` keeps Gold by the counts of incremental runs, see ``build_maintained_gold``.
    ``drift`` adds keys that are not as declared to the run history, before Bronze is written;
    ``sketches`` adds the durations of the steps to the sketches of all runs.

    A source without records ends the run early: nothing is written and nothing fails.
    """
    report = RunReport(run.run_id)
    if maintained and mode != "incremental":
        raise LoadError("Gold is maintained by incremental runs only")
    _refuse_mixed(spark, paths, mode)
    resume = mode == "incremental"
    done = resume and bronze_run_is_done(spark, paths.bronze, run)
    with _history(spark, report, paths, history, sketches):
        with recorded(report.steps, run.run_id, "extract") as step:
            # A run that Bronze holds is not asked for again.
            payloads = None if done else extract(spark, source, paths, run, resume=resume)
            step.status = "already done" if done else step.status
            if payloads is not None and payloads.isEmpty():
                step.status = "empty"
                return report
        if drift and payloads is not None:
            with recorded(report.steps, run.run_id, "drift scan"):
                append_drift(payloads, paths.history, run.run_id)
        with recorded(report.steps, run.run_id, "bronze") as step:
            build_bronze(spark, payloads, paths.bronze, run, mode=mode, step=step)
        with recorded(report.steps, run.run_id, "silver") as step:
            build_silver(spark, paths, mode=mode, partitions=partitions, step=step)
        with recorded(report.steps, run.run_id, "gold") as step:
            if maintained:
                build_maintained_gold(spark, paths, run, step=step)
            else:
                build_gold(spark, paths.silver, paths.gold, step=step)
    report.completed = True
    return report


def run_gated(
    spark: SparkSession,
    source: DataFrame | PagedInput,
    paths: LayerPaths,
    run: Run,
    *,
    mode: Mode = "append_all",
    partitions: int | None = None,
    history: bool = True,
    limits: Limits | None = None,
    drift: bool = False,
    sketches: bool = False,
) -> RunReport:
    """Probe, extract to RAW, then each layer behind its gate.

    The first failure ends the run; a source without records fails at the probe.
    A gate looks at a layer about to be written: its columns by schema, its rows
    by fetching one. So no layer is built twice. ``limits`` on shares of nulls are
    observed in the write itself, which shows only if they hold (``publish``). ``drift``
    and ``sketches`` as in ``run_batch``; what differs is kept also where a gate then fails.
    """
    report = RunReport(run.run_id)
    _refuse_mixed(spark, paths, mode)
    resume = mode == "incremental"
    done = resume and bronze_run_is_done(spark, paths.bronze, run)
    with _history(spark, report, paths, history, sketches):
        payloads = None
        if not done:  # a run that Bronze holds is not asked for again
            with recorded(report.steps, run.run_id, "probe"):
                if isinstance(source, PagedInput):
                    probe_pages(spark, source.fetch)
                else:
                    gates.probe(source)
            with recorded(report.steps, run.run_id, "extract") as step:
                counted, fill = counting(extract(spark, source, paths, run, resume=resume), step)
                raw = write_raw(counted, paths.raw, run.run_id)
                fill()
            payloads = read_raw_lines(spark, raw)
            if drift:
                with recorded(report.steps, run.run_id, "drift scan"):
                    append_drift(payloads, paths.history, run.run_id)
            with recorded(report.steps, run.run_id, "bronze gate"):
                gates.enforce(to_bronze(payloads, run), gates.BRONZE_GATE)
        with recorded(report.steps, run.run_id, "bronze") as step:
            build_bronze(spark, payloads, paths.bronze, run, mode=mode, step=step, limits=limits)
        with recorded(report.steps, run.run_id, "silver gate"):
            bronze = scan_bronze(spark, paths.bronze)
            gates.enforce(to_silver(bronze), gates.SILVER_GATE)
        with recorded(report.steps, run.run_id, "silver") as step:
            build_silver(
                spark, paths, mode=mode, partitions=partitions, step=step, bronze=bronze, limits=limits
            )
        with recorded(report.steps, run.run_id, "gold gate"):
            silver = scan_silver(spark, paths.silver)
            gates.enforce(to_gold(silver), gates.GOLD_GATE, silver)
        with recorded(report.steps, run.run_id, "gold") as step:
            build_gold(spark, paths.silver, paths.gold, step=step, silver=silver, limits=limits)
    report.completed = True
    return report
