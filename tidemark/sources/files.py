"""Text exports and file listings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.typing import blank_to_null
from tidemark.sources.tables import path_exists

# Column that keeps the order of rows in their file, where a tie-break needs it.
FILE_ORDER = "_file_order"

# Column that catches what a row holds beyond its header. A reader would drop it without a word,
# and a row that is too long is mostly a quoting fault in which every later field is shifted.
_BEYOND = "_beyond_header"

# Low bits of monotonically_increasing_id(): the row's place in its partition.
_ROW_IN_PARTITION = (1 << 33) - 1


def _file_order() -> Column:
    """File, then block, then place in the block.

    A block is read by one task from front to back, so the running id orders its rows, and
    block offsets order the blocks. Unlike a global row number this needs no extra job.
    """
    return F.struct(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names])


def _is_lead(count: int) -> Column:
    """True for the first ``count`` rows of the one file a frame is read from."""
    in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_IN_PARTITION))
    return (F.col("_metadata.file_block_start") == 0) & (F.spark_partition_id() == 0) & (in_partition < count)


def _reader(spark: SparkSession, options: Mapping[str, str]):
    # RFC 4180 quoting: a quote inside a quoted field is doubled.
    settings = {"escape": '"', "mode": "PERMISSIVE", **options}
    return spark.read.options(**settings)


def read_text_export(
    spark: SparkSession,
    path: str,
    *,
    skip_rows: int = 0,
    with_order: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A CSV export with every column as text; missing-value texts become NULL. A row with more
    values than the header stops the job, a shorter one ends in NULLs.

    The header is read first (a one-line job), so nothing is inferred and no column changes
    type between runs. ``skip_rows`` drops banner lines above the header; such a ``path`` must
    name one file. ``with_order`` adds :data:`FILE_ORDER`.
    """
    options = dict(options or {})
    if skip_rows:
        raw = _reader(spark, options).text(path)
        lead = [row.value for row in raw.where(_is_lead(skip_rows + 1)).collect()]
        if len(lead) <= skip_rows:
            raise ValueError(f"{path} has no header line below its {skip_rows} banner line(s).")
        names = _header_names(spark, lead[-1], options)
        # The CSV reader leaves out blank lines and takes the first line as the header; what is left
        # of banner and header are the rows it would give first.
        extra = sum(1 for line in lead if line.strip()) - 1
        widest = max(line.count(options.get("sep", ",")) + 1 for line in lead)
    else:
        extra = widest = 0
        names = _reader(spark, options).option("header", True).csv(path).columns
    # One value more is looked at below (a row may end in a separator); the parser itself stops at further ones.
    options.setdefault("maxColumns", str(max(len(names) + 1, widest)))
    frame = _reader(spark, options).schema(text_schema([*names, _BEYOND])).option("header", True).csv(path)
    fits = F.when(F.col(_BEYOND).isNull(), True).otherwise(
        F.raise_error(F.concat(F.lit(f"row has more than {len(names)} values, from: "), F.col(_BEYOND)))
    )
    frame = frame.where(F.when(_is_lead(extra), False).otherwise(fits) if extra else fits)
    columns = [blank_to_null(name) for name in names]
    if with_order:
        columns.append(_file_order().alias(FILE_ORDER))
    return frame.select(*columns)


def _header_names(spark: SparkSession, line: str, options: Mapping[str, str]) -> list[str]:
    width = line.count(options.get("sep", ",")) + 1
    cells = ", ".join(f"c{index} string" for index in range(width))
    parsed = spark.range(1).select(F.from_csv(F.lit(line), cells, {"escape": '"', **options}).alias("cells"))
    names = list(parsed.first().cells)
    while names and names[-1] is None:
        names.pop()
    return [name if name is not None else f"_c{index}" for index, name in enumerate(names)]


def source_headers(
    spark: SparkSession,
    path: str,
    *,
    skip_rows: int = 0,
    rename: Mapping[str, str] | None = None,
    drop: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> list[str]:
    """Header names after renames and drops; only the header line is read."""
    names = read_text_export(spark, path, skip_rows=skip_rows, options=options).limit(0).columns
    renamed = [(rename or {}).get(name, name) for name in names]
    return [name for name in renamed if name not in set(drop)]


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Path, change time and length of matching files. File contents are not read."""
    if path_exists(spark, folder):
        found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    else:
        found = spark.createDataFrame([], "path string, modificationTime timestamp, length long")
    return found.select("path", F.col("modificationTime").alias("modified"), "length")


def pick_file(spark: SparkSession, folder: str, pattern: str, pick_latest: bool = True) -> str:
    """The newest match, or the oldest when ``pick_latest`` is off; paths break ties."""
    by_time = F.struct("modified", "path")
    chosen = F.max_by("path", by_time) if pick_latest else F.min_by("path", by_time)
    path = list_files(spark, folder, pattern).agg(chosen.alias("path")).first().path
    if path is None:
        raise FileNotFoundError(f"FileNotFoundError: No files matched {folder}/{pattern}")
    return path


def missing_inputs(
    spark: SparkSession, inputs: Sequence[tuple[str, str, str]], since: dt.datetime | None = None
) -> list[str]:
    """Names of the ``(name, folder, pattern)`` inputs without a file (newer than ``since``)."""
    present = None
    for name, folder, pattern in inputs:
        files = list_files(spark, folder, pattern)
        if since is not None:
            files = files.where(F.col("modified") > F.lit(since))
        names = files.limit(1).select(F.lit(name).alias("name"))
        present = names if present is None else present.unionByName(names)
    found = {row.name for row in present.collect()} if present is not None else set()
    return [name for name, _, _ in inputs if name not in found]
