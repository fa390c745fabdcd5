"""Files that keep arriving, copied into a table as they do."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import decode
from ..operators import rows
from ..schema import Schema
from ..sources.arguments import DestinationArguments, IfExists
from ..sources.files import text_schema
from ..sources.locators import TableLocator
from ..sources.storage import Files


def arriving(spark: SparkSession, path: str, schema: Schema, kind: str = "csv") -> DataFrame:
    """Typed rows of the files that appear in a folder."""
    if kind == "csv":
        names = [c.name for c in schema.table.columns]
        reader = spark.readStream.options(header=True, quote='"', escape='"', multiLine=True, mode="FAILFAST", enforceSchema=False)
        return rows.decoded(reader.schema(text_schema(names)).csv(path), schema)
    lines = spark.readStream.text(path).where(F.length(F.trim("value")) > 0)
    return rows.decoded(lines.select(*decode.from_json_text(schema, F.col("value"))), schema)


def append_once(spark: SparkSession, data: DataFrame, table: str, name: str) -> None:
    """Appends to a table of files, as files whose names begin with `name`; those that an earlier run wrote are replaced."""
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    location, kind = about["Location"], about.get("Provider", "parquet")
    folder, staging = Files(spark, location), f"{location.rstrip('/')}/_{name}"
    Files(spark, staging).delete()
    data.write.format(kind).save(staging)
    for path, _ in list(folder.listed()):
        if path.rsplit("/", 1)[-1].startswith(f"{name}-"):
            Files(spark, path).delete()
    for i, (path, _) in enumerate(sorted(Files(spark, staging).listed())):
        folder.rename(path, f"{location.rstrip('/')}/{name}-{i:05d}.{path.rsplit('/', 1)[-1].split('.', 1)[-1]}")
    Files(spark, staging).delete()
    spark.catalog.refreshTable(table)


def keep_copied(df: DataFrame, schema: Schema, table: str, if_exists: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Appends or upserts each batch; a batch that is run again after a failure changes nothing.

    An upsert of the same rows gives the same table.  An appended batch's files have its number and the stream's in their names, and
    files with these names are taken away before they are written.
    """
    target, policy = TableLocator(f"table:{table}"), DestinationArguments(IfExists.parse(if_exists))
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def batch(rows_now: DataFrame, number: int) -> None:
        if rows_now.isEmpty():
            return
        spark = rows_now.sparkSession
        if policy.if_exists.mode != "append":
            target.write(rows_now, schema, policy)
            return
        if not spark.catalog.tableExists(table):
            target.write(rows_now.limit(0), schema, policy)
        append_once(spark, rows.project(rows.not_null(schema, rows_now), spark.table(table).columns), table, f"stream-{stream}-{number:09d}")

    writer = df.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
