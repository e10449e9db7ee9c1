"""Audit before publish: a layer is written aside, looked at, and only then shown.

The files go to a folder of the run below ``_staging`` in the table, which readers pass
over. What the gates ask is observed in that same write. If they hold, the folder is
marked and its files are renamed into the table, as a committer does; if not, nothing of
the table has changed, and the files stay aside until the run is tried again. A publish
that broke off is finished before the next write, since the mark says it had passed.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..errors import GateError, LoadError
from .gates import Gate

STAGING = "_staging"
MARK = "_passed"


@dataclass(frozen=True)
class Audit:
    """Gates for one write. ``columns`` names what a gate sees where that is no column of its own."""

    run_id: str
    gates: tuple[Gate, ...]
    columns: Mapping[str, Column] = field(default_factory=dict)

    def metrics(self) -> dict[str, Column]:
        """Aggregates by name, whatever the columns are called."""
        found = {"audited_rows": F.count(F.lit(1))}
        for g, gate in enumerate(self.gates):
            for c, name in enumerate(gate.null_rate):
                column = self.columns.get(name, F.col(f"`{name}`"))
                found[f"audited_nulls_{g}_{c}"] = F.count_if(column.isNull())
        return found

    def check(self, seen: Mapping[str, int]) -> None:
        rows = seen["audited_rows"] or 0
        for g, gate in enumerate(self.gates):
            if rows < gate.min_rows:
                raise GateError(f"{gate.name} has fewer than {gate.min_rows} rows")
            for c, (name, limit) in enumerate(gate.null_rate.items()):
                nulls = seen[f"audited_nulls_{g}_{c}"] or 0
                if nulls > limit * rows:
                    raise GateError(
                        f"{gate.name} has {nulls} nulls in {name} of {rows} rows, more than {limit:.2%}"
                    )


def audited_write(
    df: DataFrame,
    path: str,
    audit: Audit,
    write: Callable[[DataFrame, str], None],
    *,
    replace: bool = False,
    done_mark: bool = False,
) -> None:
    """Let ``write`` put ``df`` aside, check the counts it made, then show it or fail.

    ``replace`` takes the files away that are in the table now; ``done_mark`` leaves a
    ``_SUCCESS`` once all new ones are there.
    """
    spark = df.sparkSession
    finish_publishing(spark, path)
    staged = f"{path.rstrip('/')}/{STAGING}/{audit.run_id}"
    seen = Observation()
    write(df.observe(seen, *(c.alias(name) for name, c in audit.metrics().items())), staged)
    audit.check(seen.get)
    files = _Files(spark, path)
    old = [name for name in files.names(path) if name == "_SUCCESS" or name[0] not in "._"] if replace else []
    try:
        files.put(f"{staged}/{MARK}", json.dumps({"replaces": old, "done_mark": done_mark}))
        _publish(files, path, staged)
    except Exception as exc:
        raise LoadError(f"what passed in {staged} could not be published: {exc}") from exc


def finish_publishing(spark: SparkSession, path: str) -> None:
    """Show what had passed when an earlier publish broke off. What had not stays aside."""
    files = _Files(spark, path)
    aside = f"{path.rstrip('/')}/{STAGING}"
    for name in files.names(aside):
        if files.exists(f"{aside}/{name}/{MARK}"):
            _publish(files, path, f"{aside}/{name}")


def _publish(files: _Files, path: str, staged: str) -> None:
    """Every step can be repeated: files keep their own names, and the mark goes last."""
    path = path.rstrip("/")
    order = json.loads(files.read(f"{staged}/{MARK}"))
    for name in order["replaces"]:
        files.delete(f"{path}/{name}")
    for part in files.below(staged):
        files.rename(f"{staged}/{part}", f"{path}/{part}")
    if order["done_mark"]:
        files.put(f"{path}/_SUCCESS", "")
    files.delete(staged)


class _Files:
    """The few file operations of a publish, on whatever file system a path names."""

    def __init__(self, spark: SparkSession, path: str):
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._system = self._hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils

    def exists(self, path: str) -> bool:
        return self._system.exists(self._hadoop.Path(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [s.getPath().getName() for s in self._system.listStatus(self._hadoop.Path(path))]

    def below(self, folder: str, inside: str = "") -> Iterator[str]:
        """Files of a table, named from the folder on; marks and logs are none."""
        here = self._hadoop.Path(f"{folder}/{inside}" if inside else folder)
        for status in self._system.listStatus(here):
            name = status.getPath().getName()
            place = f"{inside}/{name}" if inside else name
            if status.isDirectory():
                yield from self.below(folder, place)
            elif name[0] not in "._":
                yield place

    def rename(self, source: str, target: str) -> None:
        source, target = self._hadoop.Path(source), self._hadoop.Path(target)
        self._system.mkdirs(target.getParent())
        if not self._system.rename(source, target) and not self._system.exists(target):
            raise OSError(f"{source} could not be renamed to {target}")

    def delete(self, path: str) -> None:
        self._system.delete(self._hadoop.Path(path), True)

    def put(self, path: str, text: str) -> None:
        stream = self._system.create(self._hadoop.Path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def read(self, path: str) -> str:
        stream = self._system.open(self._hadoop.Path(path))
        try:
            return self._text.toString(stream, "UTF-8")
        finally:
            stream.close()
