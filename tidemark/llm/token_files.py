"""Token-id files: Parquet with one list of ids per document.

Documents are range-partitioned by id, so file after file the ids ascend, and row-group and page
statistics of ``doc_id`` let a reader skip to a range of documents; metadata columns can be read
without the tokens. Token lists are dictionary-encoded (ids repeat; the dictionary of a whole
vocabulary stays small), the ascending metadata columns are delta-encoded by the second version of
the page format. Row groups and pages are kept small enough for selective reads. Files go through
Spark's writer, so a lost executor or a failed attempt leaves nothing half-written.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from tidemark.llm.base import documents, fields, query, renamed, scratch
from tidemark.llm.encode import batches_of, encoder
from tidemark.llm.ordered import global_starts, ranged

END = 2
# Parts of texts a worker remembers: rare ones are encoded less often than with the usual number.
REMEMBERED = 800_000
SCHEMA = fields(doc_id="long", n_tokens="long", tokens=T.ArrayType(T.IntegerType()), part="int", start="long")

# Settings of the files. Row groups of 32 MB bound what a reader holds; 20,000 rows or 256 KB a page
# bound what it reads beside what it wants.
OPTIONS = {
    "compression": "zstd",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "20000",
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str, *, kind: str = "byte", end: int = END, id_column: str = "doc_id", text_column: str = "text"
) -> None:
    """Encode every whole text and write the files in ascending order of ids.

    A missing text is an empty one (just the end id); rows without an id come first, rows with equal
    ids stand in the order of their texts' hashes; an empty table writes no rows.
    """
    rows = renamed(docs, doc_id=id_column, text=text_column)
    # The row's number parts rows alike in both, which would else all go to one task.
    rows = rows.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    rows = ranged(rows, ["doc_id", "tie", "row"]).drop("tie", "row")

    def tokens(batches):
        part, start = TaskContext.get().partitionId(), 0
        encode = encoder(vocabulary, kind, end, REMEMBERED).encode
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for low, high in batches_of(texts):
                ids, offsets = encode(texts[low:high])
                lengths = np.diff(offsets)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[low:high],
                        pa.array(lengths),
                        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)),
                        pa.array(np.full(high - low, part, np.int32)),
                        pa.array(start + offsets[:-1]),
                    ],
                    names=SCHEMA.names,
                )
                start += int(offsets[-1])

    rows.select(F.col("doc_id").cast("long"), "text").mapInArrow(tokens, SCHEMA).write.options(**OPTIONS).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The files with ``start`` as the ids of all documents before; a selection of columns reads no more."""
    return global_starts(spark.read.schema(SCHEMA).parquet(path), {"start": "n_tokens"})


@arrow_udf(T.LongType())
def ids_crc32(tokens: pa.Array) -> pa.Array:
    """Unsigned CRC-32 of each list's ids as little-endian unsigned 32-bit integers."""
    offsets, values = tokens.offsets.to_numpy(), tokens.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
    return pa.array([zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])], pa.int64())


@query()
def op2_token_files(spark, sf_dir):
    """All documents' tokens, written as files and read back."""
    import public_tokenizers

    path = scratch(spark, "tokens")
    write_token_files(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", ids_crc32("tokens").alias("ids_crc32"))
