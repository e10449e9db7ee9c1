"""Java classes of this package, compiled where the session starts and shipped to its executors.

Spark compiles its own plans with Janino, so that compiler is wherever Spark is. Loops over
single letters take some thirty times as long in Python, whole arrays at a time or not.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession


def map_partitions(rows: DataFrame, source: Path, name: str, schema: str, *args: object) -> DataFrame:
    """The rows of each partition through a ``MapPartitionsFunction`` of rows, made from ``args``."""
    spark = rows.sparkSession
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    given = gateway.new_array(jvm.java.lang.Object, len(args))
    for i, arg in enumerate(args):
        given[i] = arg
    function = java_class(spark, source, name).getConstructors()[0].newInstance(given)
    found = jvm.org.apache.spark.sql.Encoders.row(jvm.org.apache.spark.sql.types.StructType.fromDDL(schema))
    return DataFrame(rows._jdf.mapPartitions(function, found), spark)


def java_class(spark: SparkSession, source: Path, name: str) -> JavaObject:
    """The class of that name in a source file, compiled and shipped once for each application."""
    key = spark.sparkContext.applicationId, name
    if key not in _COMPILED:  # all sessions of an application share its files
        _COMPILED[key] = _compile(spark, source).loadClass(name)
    return _COMPILED[key]


_COMPILED: dict[tuple[str, str], JavaObject] = {}


def _compile(spark: SparkSession, source: Path) -> JavaObject:
    jvm = spark.sparkContext._jvm
    compiler = jvm.org.codehaus.janino.SimpleCompiler()
    compiler.setParentClassLoader(jvm.java.lang.Thread.currentThread().getContextClassLoader())
    compiler.cook(source.read_text())
    target = Path(tempfile.mkdtemp(prefix="tierstone-java-")) / f"{source.stem}-{spark.sparkContext.applicationId}.jar"
    with zipfile.ZipFile(target, "w") as archive:
        for entry in compiler.getBytecodes().entrySet():
            archive.writestr(entry.getKey().replace(".", "/") + ".class", bytes(entry.getValue()))
    spark.sparkContext._jsc.addJar(str(target))
    return compiler.getClassLoader()
