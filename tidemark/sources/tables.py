"""Tables: scans, and versioned writes that never show a half-written state.

Plain parquet has no MERGE and cannot be overwritten while it is being read. A
:class:`Table` therefore writes each new state to its own folder and then adds one row to a
small commit log; readers follow the newest row. A run that dies before the commit leaves the
old state in place, and the next run overwrites the left-over folder.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import col, quoted
from tidemark.functions.typing import as_columns
from tidemark.session import shared_dir

# Files of different partitions that a task writes at a time. The engine sorts a task's rows by partition only where
# they fall in more; rows are gathered by partition before, so a task mostly has one.
OPEN_FILES = "16"
# Codec of the states and copies that this library writes: smaller files than the engine's own choice.
CODEC = "zstd"

_COMMIT_SCHEMA = "version long, folder string, rows long, committed timestamp"


class PartialLoadError(RuntimeError):
    """Fewer or more rows landed than were prepared."""


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, asked of the file system it is on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library has made, with all that is in it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def listed(spark: SparkSession, path: str) -> frozenset[str]:
    """Names of the data files in a folder, asked of its file system without a Spark job; none without it."""
    if not path_exists(spark, path):
        return frozenset()
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = (status.getPath().getName() for status in target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target))
    return frozenset(name for name in names if not name.startswith(("_", ".")))


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table or view by name, or a parquet path; only ``columns`` are read."""
    frame = spark.read.parquet(name) if "/" in name else spark.table(name)
    return frame.select(*as_columns(columns)) if columns else frame


def read_view(spark: SparkSession, name: str, required: Sequence[str]) -> DataFrame:
    """As :func:`read_table`, failing when a required column is absent."""
    frame = read_table(spark, name)
    missing = [column for column in required if column not in frame.columns]
    if missing:
        raise ValueError(f"{name} lacks column(s) {missing}; it has {frame.columns}.")
    return frame


def jdbc_options(
    url: str,
    table: str,
    *,
    fetch_size: int = 500_000,
    batch_size: int = 50_000,
    split: tuple[str, object, object, int] | None = None,
) -> dict[str, str]:
    """Options for ``format("jdbc")``: chunked reads, batched inserts, and, with ``split``
    (column, lower, upper, partitions), a scan by many tasks at once."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), "batchsize": str(batch_size)}
    if split:
        column, lower, upper, partitions = split
        options.update(
            partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions)
        )
    return options


def table_columns(frame: DataFrame, identity: Sequence[str] = ()) -> DataFrame:
    """Column metadata of a table as a frame."""
    spark = frame.sparkSession
    rows = [
        (field.name, field.dataType.simpleString(), field.nullable, field.name in set(identity), index + 1)
        for index, field in enumerate(frame.schema)
    ]
    return spark.createDataFrame(
        rows, "name string, data_type string, is_nullable boolean, is_identity boolean, ordinal_position int"
    )


def insert_columns(frame: DataFrame, identity: Sequence[str] = ()) -> list[str]:
    """Column names in table order without the generated ones."""
    return [name for name in frame.columns if name not in set(identity)]


def append_rows(frame: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a parquet folder (used for the health log)."""
    writer = frame.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def kept(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame once to a new folder under the shared one and read it from there: what follows, however
    often, neither computes it again nor loses it with an executor."""
    path = f"{shared_dir(frame.sparkSession)}/kept/{name}-{uuid.uuid4().hex}"
    frame.write.option("compression", CODEC).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    """A session setting for one write."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_counted(frame: DataFrame, path: str) -> int:
    """Overwrite ``path`` and return the number of rows the write tasks saw."""
    seen = Observation()
    frame.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", CODEC).parquet(path)
    return int(seen.get["rows"])


@dataclass(frozen=True)
class Staged:
    """A written, not yet visible state of a table; ``parts`` are the commit rows of a partitioned one."""

    version: int
    folder: str
    rows: int
    parts: tuple = ()


class Table:
    """A parquet table at ``path`` with one writer at a time."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self._seen, self._known = frozenset(), None

    def _last_commit(self):
        """The newest commit row. The log is read again only when it has grown."""
        seen = listed(self.spark, f"{self.path}/commits")
        if seen != self._seen:
            log = self.spark.read.schema(_COMMIT_SCHEMA).parquet(f"{self.path}/commits")
            rows = log.orderBy(F.col("version").desc()).limit(1).collect()
            self._known, self._seen = rows[0] if rows else None, seen
        return self._known

    def exists(self) -> bool:
        return self._last_commit() is not None

    def read(self, columns: Sequence[str] | None = None) -> DataFrame | None:
        """The committed state, or None before the first commit."""
        last = self._last_commit()
        if last is None:
            return None
        frame = self.spark.read.parquet(f"{self.path}/{last.folder}")
        return frame.select(*as_columns(columns)) if columns else frame

    def count(self) -> int:
        """Rows of the committed state, as counted when it was written."""
        last = self._last_commit()
        return 0 if last is None else last.rows

    def staged_frame(self, staged: Staged) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{staged.folder}")

    def stage(self, frame: DataFrame) -> Staged:
        """Write the next state and check that what landed is what was prepared."""
        last = self._last_commit()
        version = 1 if last is None else last.version + 1
        folder = f"v{version:08d}"
        target = f"{self.path}/{folder}"
        prepared = write_counted(frame, target)
        landed = self.spark.read.parquet(target).count()
        if landed != prepared:
            raise PartialLoadError(
                f"PARTIAL STAGING LOAD: {landed} rows landed in {self.path}, {prepared} were prepared; the table "
                f"keeps its last complete state."
            )
        return Staged(version, folder, landed)

    def commit(self, staged: Staged) -> int:
        """Make a staged state the visible one."""
        row = self.spark.range(1).select(
            F.lit(staged.version).cast("long").alias("version"),
            F.lit(staged.folder).alias("folder"),
            F.lit(staged.rows).cast("long").alias("rows"),
            F.current_timestamp().alias("committed"),
        )
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        return staged.rows

    def overwrite(self, frame: DataFrame) -> int:
        """Replace the table and return its row count."""
        return self.commit(self.stage(frame))


class BucketedTable(Table):
    """A table whose states are kept in buckets of a key, so that matching it on that key moves none of its
    rows.

    Each state is an external table of the session catalog over its own folder; a session that did not write it
    declares it again when it reads. A folder that a dead run has left is never written to again.
    """

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str], buckets: int) -> None:
        super().__init__(spark, path)
        self.by, self.buckets = tuple(by), buckets

    def _name(self, folder: str) -> str:
        return f"tidemark_{hashlib.md5(f'{self.path}/{folder}'.encode()).hexdigest()}"

    def _state(self, folder: str) -> DataFrame:
        name = self._name(folder)
        if not self.spark.catalog.tableExists(name):
            location = f"{self.path}/{folder}"
            columns = ", ".join(f"{quoted(field.name)} {field.dataType.simpleString()}" for field in self.spark.read.parquet(location).schema)
            by = ", ".join(map(quoted, self.by))
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
                f"INTO {self.buckets} BUCKETS LOCATION '{location}'"
            )
        return self.spark.table(name)

    def read(self, columns: Sequence[str] | None = None) -> DataFrame | None:
        last = self._last_commit()
        if last is None:
            return None
        frame = self._state(last.folder)
        return frame.select(*as_columns(columns)) if columns else frame

    def staged_frame(self, staged: Staged) -> DataFrame:
        return self._state(staged.folder)

    def stage(self, frame: DataFrame) -> Staged:
        """Write the next state in buckets, each sorted by the key, and check what landed."""
        last = self._last_commit()
        version = 1 if last is None else last.version + 1
        folder, seen = f"v{version:08d}-{uuid.uuid4().hex[:8]}", Observation()
        writer = frame.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("parquet").option("compression", CODEC)
        writer.bucketBy(self.buckets, *self.by).sortBy(*self.by).option("path", f"{self.path}/{folder}").saveAsTable(self._name(folder))
        prepared, landed = int(seen.get["rows"]), self._state(folder).count()
        if landed != prepared:
            raise PartialLoadError(f"PARTIAL STAGING LOAD: {landed} rows landed in {self.path}, {prepared} were prepared.")
        return Staged(version, folder, landed)


PART, _COMMITTED_PARTS = "_part", "version long, part string, folder string, rows long, columns string"


class PartitionedTable:
    """A parquet table kept by the values of some columns, so that a promotion rewrites few of its rows.

    A partition's name is a hash of its values as they are, with their types: a missing value, an empty
    text, ``01`` and ``1`` are four partitions. The columns stay in the files; nothing is read back from a
    folder name. A write puts the new states of its partitions into a folder of its own, and one commit
    makes all of them visible; until then readers see the old states.
    """

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str]) -> None:
        self.spark, self.path, self.by = spark, path.rstrip("/"), tuple(by)
        self._seen, self._known = frozenset(), []

    def parts_of(self, frame: DataFrame) -> DataFrame:
        """The frame with the name of each row's partition."""
        return frame.withColumn(PART, F.sha2(F.to_json(F.struct(*as_columns(self.by)), {"ignoreNullFields": "false"}), 256))

    def named(self, frame: DataFrame) -> list[str]:
        """Names of the partitions that a frame falls in: no more than the table has, or will have."""
        return sorted(row[0] for row in self.parts_of(frame.select(*as_columns(self.by))).select(PART).distinct().collect())

    def count_parts(self, frame: DataFrame) -> dict[str, int]:
        """Rows of a frame by the partition they fall in."""
        return dict(self.parts_of(frame.select(*as_columns(self.by))).groupBy(PART).count().collect())

    def _states(self) -> list:
        """The last commit row of every partition; none before the first commit. The log is read again only
        when it has grown."""
        seen = listed(self.spark, f"{self.path}/commits")
        if seen != self._seen:
            log = self.spark.read.schema(_COMMITTED_PARTS).parquet(f"{self.path}/commits")
            last = log.groupBy("part").agg(F.max_by(F.struct("version", "folder", "rows", "columns"), "version").alias("last"))
            self._known, self._seen = last.select("part", "last.*").collect(), seen
        return self._known

    def exists(self) -> bool:
        return bool(self._states())

    def count(self) -> int:
        return sum(state.rows for state in self._states())

    def part_rows(self) -> dict[str, int]:
        """Rows of each partition by its name."""
        return {state.part: state.rows for state in self._states()}

    def schema(self) -> T.StructType:
        """Columns of the last state that was written."""
        return T.StructType.fromJson(json.loads(max(self._states(), key=lambda state: state.version).columns))

    def read(self, parts: Sequence[str] | None = None) -> DataFrame | None:
        """All rows, or those of the named partitions, whose folders alone are listed; None before the
        first commit."""
        states = self._states()
        if not states:
            return None
        schema = self.schema()
        wanted = None if parts is None else set(parts)
        folders = [f"{self.path}/{s.folder}" for s in states if s.rows and (wanted is None or s.part in wanted)]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def stage(self, frame: DataFrame, parts: Sequence[str] | None = None) -> Staged:
        """Write ``frame`` as the next state of the named partitions (or of all there are); a partition
        without rows becomes empty. Every row must fall in one of them. Nothing is visible yet."""
        states = self._states()
        version = 1 + max((state.version for state in states), default=0)
        target = f"{self.path}/v{version:08d}"
        seen = Observation()
        named = self.parts_of(frame).observe(seen, F.count(F.lit(1)).alias("rows"))
        with _setting(self.spark, "spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES):
            named.hint("rebalance", PART).write.mode("overwrite").option("compression", CODEC).partitionBy(PART).parquet(target)
        prepared, landed = int(seen.get["rows"]), {}
        if prepared:
            # Names are hex digests, which inference could take for numbers.
            schema = T.StructType([*frame.schema, T.StructField(PART, T.StringType())])
            landed = {row[0]: row[1] for row in self.spark.read.schema(schema).parquet(target).groupBy(PART).count().collect()}
        if sum(landed.values()) != prepared:
            raise PartialLoadError(f"PARTIAL STAGING LOAD: {sum(landed.values())} rows landed in {self.path}, {prepared} were prepared.")
        replaced = {state.part for state in states} if parts is None else set(parts)
        stray = set(landed) - replaced if parts is not None else set()
        if stray:
            raise ValueError(f"{len(stray)} partition(s) of the new rows are not among those to be replaced")
        columns = frame.schema.json()
        rows = [(version, part, f"v{version:08d}/{PART}={part}", landed.get(part, 0), columns) for part in sorted(replaced | set(landed))]
        # An empty first state is a commit too.
        return Staged(version, f"v{version:08d}", prepared, tuple(rows or [(version, "", "", 0, columns)]))

    def commit(self, staged: Staged) -> int:
        """Make all staged partitions visible together."""
        rows = self.spark.createDataFrame(list(staged.parts), _COMMITTED_PARTS)
        rows.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        return staged.rows

    def overwrite(self, frame: DataFrame, parts: Sequence[str] | None = None) -> int:
        """Make ``frame`` the state of the named partitions, or of the table."""
        return self.commit(self.stage(frame, parts))


def open_table(
    spark: SparkSession, path: str, partition_by: Sequence[str] = (), bucket_by: Sequence[str] = (), buckets: int = 0
) -> Table | PartitionedTable:
    """A table where it is kept, in the layout it is kept in."""
    if bucket_by:
        return BucketedTable(spark, path, bucket_by, buckets)
    return PartitionedTable(spark, path, partition_by) if partition_by else Table(spark, path)


def rows_of(frame: DataFrame, name: str = "row_count") -> DataFrame:
    """Row count as a one-row frame."""
    return frame.agg(F.count(F.lit(1)).alias(name))


def total_rows(results: DataFrame, column: str = "RowCount") -> DataFrame:
    """Rows over all destinations; a destination without a count adds nothing."""
    return results.agg(F.sum(F.coalesce(col(column), F.lit(0))).alias("total_rows"))
