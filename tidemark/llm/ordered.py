"""A global order with running totals, without a single task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ranged(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows range-partitioned and sorted by the keys (missing values first)."""
    return frame.repartitionByRange(*keys).sortWithinPartitions(*keys)


def running(frame: DataFrame, totals: dict[str, str]) -> DataFrame:
    """Add ``part`` (the partition) and, for each ``new: column`` of ``totals``, the sum of the column
    over the partition's rows before this one. The frame comes from :func:`ranged`."""
    schema = T.StructType(
        [*frame.schema, T.StructField("part", T.IntegerType()), *(T.StructField(name, T.LongType()) for name in totals)]
    )

    def add(batches):
        part, before = TaskContext.get().partitionId(), dict.fromkeys(totals, 0)
        for batch in batches:
            columns = [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32))]
            for name, column in totals.items():
                values = batch.column(batch.schema.get_field_index(column)).to_numpy(zero_copy_only=False).astype(np.int64)
                ends = np.cumsum(values) + before[name]
                columns.append(pa.array(ends - values))
                before[name] = int(ends[-1]) if len(ends) else before[name]
            yield pa.RecordBatch.from_arrays(columns, names=[field.name for field in schema])

    return frame.mapInArrow(add, schema)


def global_starts(stored: DataFrame, totals: dict[str, str]) -> DataFrame:
    """Turn the sums of :func:`running`, read back from storage, into sums over all rows before.

    One row per partition is summed up and broadcast: as many rows as the table has partitions.
    """
    parts = stored.groupBy("part").agg(
        *(F.max(F.col(name) + F.col(column)).alias(f"_{name}") for name, column in totals.items())
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select(
        F.col("part"), *(F.coalesce(F.sum(f"_{name}").over(before), F.lit(0)).alias(f"_{name}") for name in totals)
    )
    joined = stored.join(F.broadcast(bases), "part")
    return joined.select(
        *(
            (F.col(name) + F.col(f"_{name}")).alias(name) if name in totals else F.col(name)
            for name in stored.columns
        )
    )
