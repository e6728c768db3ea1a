"""Registry, tables and shared storage for the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.queries.base import table
from tidemark.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Rows of an Arrow batch: bounds what a Python worker holds of long texts.
BATCH_ROWS = "1000"


def settings(spark: SparkSession) -> None:
    """What the operators count on: UTC, ANSI, small Arrow batches."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL where there is one."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            settings(spark)
            return function(spark, sf_dir)

        run.__name__, run.__doc__ = function.__name__, function.__doc__
        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = sql
        return run

    return register


_KINDS = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(), "boolean": T.BooleanType()}


def fields(**kinds: str | T.DataType) -> T.StructType:
    """A schema from names and types; DDL text would need a running session when it is parsed."""
    return T.StructType([T.StructField(name, _KINDS[kind] if isinstance(kind, str) else kind) for name, kind in kinds.items()])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: later steps start from files that
    outlive lost executors, and nothing above the write runs twice."""
    path = scratch(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def renamed(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under fixed names, so that no other column can clash."""
    return docs.select(*(docs[f"`{column}`"].alias(name) for name, column in columns.items()))


def labels_of(labels: DataFrame, column: str, id_column: str = "doc_id") -> DataFrame:
    """One row ``(id, mark)`` per labelled id; repeated labels count by their mean (0.5 and more
    is 1), rows without id or label are no labels."""
    marks = renamed(labels, id=id_column, mark=column).where("id is not null and mark is not null")
    return marks.groupBy("id").agg((F.avg("mark") >= 0.5).cast("int").alias("mark"))
