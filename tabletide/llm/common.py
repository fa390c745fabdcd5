"""What the text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import importable, shared_folder

#: UTF-8 bytes of text that an operator works on at a time in Python.
SLICE_BYTES = 1 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ids_and_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """The two columns an operator reads, under fixed names, whatever else the table holds."""
    importable(docs.sparkSession)
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"), *more)


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Runs of rows with about `limit` bytes of text, and their texts as UTF-8 (none for null).  A longer text comes alone."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
        texts = [x or b"" for x in texts]
        a, size = 0, 0
        for i, x in enumerate(texts):
            if i > a and size + len(x) > limit:
                yield batch.slice(a, i - a), texts[a:i]
                a, size = i, 0
            size += len(x)
        if a < len(texts):
            yield batch.slice(a), texts[a:]


def checkpoint(df: DataFrame) -> DataFrame:
    """`df` as files in the shared folder of spark.checkpoint.dir; where that is unset in a local session, in one of this machine."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


#: Bytes that a part of blocks should have, and how many times as many it may have where the input is very large.
PART_BYTES, LARGER_PARTS = 24 << 20, 10
#: What Spark expects of a table it knows nothing of is more than this.
NO_SIZE = 1 << 60


def partitions(df: DataFrame, share: float = 1.0) -> int:
    """Into how many parts to deal records that take `share` times the bytes Spark expects of `df`.

    Parts of PART_BYTES, beyond 100 GB of input growing with its square root, since ever more parts would leave a task only a few
    records for each; never fewer than the session's shuffle partitions.  Where Spark knows no size, they are as many as those.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    target = PART_BYTES * min(LARGER_PARTS, max(1.0, (size / 1e11) ** 0.5))
    return max(least, int(size * share / target) + 1) if size < NO_SIZE else least


def table(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)


def held_out(doc_id: str | Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id's text has this remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % modulus == remainder, F.lit(False))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as one value, each column on its own so that it compresses."""
    return b"".join(np.ascontiguousarray(x).tobytes() for x in arrays)


def unpack(blob: bytes, n: int, *types) -> list[np.ndarray]:
    out, at = [], 0
    for t in types:
        t = np.dtype(t)
        out.append(np.frombuffer(blob, t, n, at))
        at += n * t.itemsize
    return out
