"""The queries of the table operators, and SQL that gives the same rows.

Each takes (spark, sf_dir) and works on whole tables.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema as S
from .dialects import bigquery, postgres, trino
from .dialects.trino import parse_type
from .errors import TideError
from .functions import decode, encode, literals
from .functions.geo import is_geometry
from .operators import merge, rows, shape
from .plans import storage
from .plans.copy import prepare
from .session import checkpointed, shared_folder
from .schema import Array, Column, GeoJson, OneOf, Schema, Struct, StructField, Table
from .sources import arguments, files, locators
from .sources.arguments import DestinationArguments, IfExists, SourceArguments

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def table(*columns: Column, named=None) -> Schema:
    return Schema(Table("data", columns), named or {})


def scratch(spark: SparkSession) -> str:
    """A new place in the folder that all executors share."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


ORDERS = table(Column("o_orderkey", S.INT64, False), Column("o_custkey", S.INT64), Column("o_orderstatus", S.TEXT), Column("o_orderdate", S.TIMESTAMP), Column("o_orderpriority", S.TEXT))
ONE = lambda t, nullable=True: table(Column("value", t, nullable))


def copy_orders(spark, d):
    """Scan, filter, projection and encoding: what a copy to CSV does before it writes."""
    found = rows.where(read(spark, d, "orders"), "o_totalprice > 100000")
    return rows.encoded(rows.project(found, [c.name for c in ORDERS.table.columns]), ORDERS)


def where_filter(spark, d):
    found = rows.where(read(spark, d, "lineitem"), "l_quantity >= 25 and l_returnflag in ('A', 'R')")
    return rows.project(found, ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity"])


def count_where(spark, d):
    return rows.counted(read(spark, d, "lineitem"), "l_discount > 0.05 and l_shipdate < timestamp'1998-01-01'")


def count_all_tables(spark, d):
    out = None
    for t in TABLES:
        one = rows.counted(read(spark, d, t)).select(F.lit(t).alias("name"), "count")
        out = one if out is None else out.union(one)
    return out


def encode_timestamp(spark, d):
    return read(spark, d, "events").select("event_id", encode.cell(ONE(S.TIMESTAMP), S.TIMESTAMP, F.col("ts")).alias("ts_text"))


def encode_timestamp_utc(spark, d):
    value = F.col("ts").cast("timestamp")
    return read(spark, d, "events").select("event_id", encode.cell(ONE(S.TIMESTAMPTZ), S.TIMESTAMPTZ, value).alias("ts_text"))


def encode_bool(spark, d):
    value = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag") == "R")
    return read(spark, d, "lineitem").groupBy(encode.cell(ONE(S.BOOL), S.BOOL, value).alias("flag")).agg(F.count("*").alias("n"))


TOKENS = ("on", "OFF", "Yes", "n", "1", "0", "T", "false")


def decode_bool_tokens(spark, d):
    token = F.element_at(F.array(*map(F.lit, TOKENS)), (F.col("event_id") % len(TOKENS) + 1).cast("int"))
    return read(spark, d, "events").select("event_id", decode.scalar(ONE(S.BOOL), S.BOOL, token, "value").alias("flag"))


def decode_scalars(spark, d):
    """Numbers, dates and timestamps from text, and back to text."""
    cells = read(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("k"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSS").alias("at"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(".2500")).alias("amount"), F.concat(F.lit("+"), (F.col("o_orderkey") % 30000).cast("string")).alias("small"),
    )
    schema = table(Column("k", S.INT64, False), Column("day", S.DATE), Column("at", S.TIMESTAMP), Column("amount", S.DECIMAL), Column("small", S.INT16))
    typed = rows.decoded(cells, schema)
    return typed.select("k", F.col("day").cast("string").alias("day"), encode.scalar(schema, S.TIMESTAMP, F.col("at")).alias("at"), encode.scalar(schema, S.DECIMAL, F.col("amount")).alias("amount"), F.col("small").cast("int").alias("small"))


def decode_timestamp_offsets(spark, d):
    """A time with an offset, in each way to write one, is that time at UTC."""
    zone = F.element_at(F.array(*map(F.lit, ("Z", "+00", "-0100", "+01:00"))), (F.col("event_id") % 4 + 1).cast("int"))
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), zone)
    value = decode.scalar(ONE(S.TIMESTAMPTZ), S.TIMESTAMPTZ, text, "value")
    return read(spark, d, "events").select("event_id", encode.timestamp_utc(value).alias("at"))


def decode_uuid(spark, d):
    """UUIDs without dashes, in capitals, in braces, as URNs and as they should be."""
    plain = F.md5(F.col("o_orderkey").cast("string"))
    dashed = F.regexp_replace(plain, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    text = F.element_at(F.array(plain, F.upper(dashed), F.concat(F.lit("{"), dashed, F.lit("}")), F.concat(F.lit("urn:uuid:"), dashed), dashed), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return read(spark, d, "orders").select("o_orderkey", decode.scalar(ONE(S.UUID), S.UUID, text, "value").alias("id"))


def encode_int_array(spark, d):
    t = Array(S.INT64)
    return read(spark, d, "orders").select("o_orderkey", encode.cell(ONE(t), t, F.array("o_orderkey", "o_custkey")).alias("pair"))


CUSTOMER = Struct((StructField("c_custkey", S.INT64, False), StructField("c_name", S.TEXT), StructField("segment", S.TEXT), StructField("nation", S.INT32)))


def _customers(spark, d):
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    return read(spark, d, "customer").select("c_custkey", F.struct("c_custkey", "c_name", segment.alias("segment"), F.col("c_nationkey").alias("nation")).alias("value"))


def struct_encode(spark, d):
    return _customers(spark, d).select("c_custkey", encode.cell(ONE(CUSTOMER), CUSTOMER, F.col("value")).alias("value"))


def struct_roundtrip(spark, d):
    """Structs and arrays of them, to JSON text and back."""
    t = Array(CUSTOMER)
    text = encode.cell(ONE(t), t, F.array("value"))
    back = F.col("back")[0]
    return _customers(spark, d).select("c_custkey", decode.cell(ONE(t), t, text, "value").alias("back")).select("c_custkey", back["c_name"].alias("c_name"), back["segment"].alias("segment"), back["nation"].alias("nation"))


def json_field(spark, d):
    t = Struct((StructField("k", S.INT64),))
    return read(spark, d, "events").select("event_id", decode.cell(ONE(t), t, F.col("props"), "props")["k"].alias("k"))


def json_lines_encode(spark, d):
    schema = table(Column("n_nationkey", S.INT32, False), Column("n_name", S.TEXT), Column("big", S.INT64), Column("flag", S.BOOL))
    df = read(spark, d, "nation").select("n_nationkey", "n_name", (F.col("n_nationkey").cast("long") * (1 << 50)).alias("big"), (F.col("n_regionkey") > 2).alias("flag"))
    return df.select(encode.json_line(schema).alias("line"))


def json_lines_decode(spark, d):
    """Lines with strings for large numbers, keys left out, and keys that no column has."""
    schema = table(Column("id", S.INT64, False), Column("kind", S.TEXT), Column("missing", S.DATE), Column("ok", S.BOOL))
    line = F.concat(F.lit('{"id": "'), F.col("event_id").cast("string"), F.lit('", "more": [1], "ok": true, "kind": "'), F.col("event_type"), F.lit('"}'))
    lines = read(spark, d, "events").select(line.alias("line"))
    return rows.decoded(lines.select(*decode.from_json_text(schema, F.col("line"))), schema)


def upsert_orders(spark, d):
    """Every fifth order changed, and as many new ones."""
    there = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    changed = there.where("o_orderkey % 5 = 0")
    new = changed.select((-F.col("o_orderkey") - 1).alias("o_orderkey"), "o_custkey", F.lit("N").alias("o_orderstatus"))
    return merge.upsert(there, changed.withColumn("o_orderstatus", F.lit("X")).union(new), ["o_orderkey"])


def upsert_by_file(spark, d):
    """Orders in files by ranges of keys; some of one range changed, and as many new ones.  Whether files were left alone, and all rows."""
    name, there = f"orders_{uuid.uuid4().hex[:8]}", read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    there.repartitionByRange(8, "o_orderkey").write.saveAsTable(name)
    try:
        before = {*spark.table(name).inputFiles()}
        changed = there.where(F.col("o_orderkey") % 2 == 0).where(F.col("o_orderkey") <= there.agg(F.max("o_orderkey")).first()[0] // 20).withColumn("o_orderstatus", F.lit("X"))
        new = changed.select((-F.col("o_orderkey") - 1).alias("o_orderkey"), "o_custkey", F.lit("N").alias("o_orderstatus"))
        locators.parse(f"table:{name}").write(changed.union(new), S.from_spark(name, there.schema), DestinationArguments(IfExists("upsert", ("o_orderkey",))))
        alone = len(before & {*spark.table(name).inputFiles()})
        return checkpointed(spark.table(name).withColumn("some_alone", F.lit(0 < alone < len(before))))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def upsert_composite_key(spark, d):
    there = read(spark, d, "conversations").select("conv_id", "turn", "role", F.length("text").alias("n"))
    changed = there.where("turn = 1").withColumn("n", F.lit(-1)).union(there.where("turn = 0").withColumn("turn", F.lit(1000).cast("long")))
    return merge.upsert(there, changed, ["conv_id", "turn"])


def upsert_all_keys(spark, d):
    """Without other columns, rows that are there stay as they are."""
    there = read(spark, d, "nation").select("n_nationkey", "n_regionkey")
    return merge.upsert(there, there.where("n_regionkey = 1").union(there.where("n_nationkey = 0").select(F.lit(99), F.lit(9))), ["n_nationkey", "n_regionkey"])


def append_rows(spark, d):
    there = read(spark, d, "supplier")
    return there.unionByName(rows.project(there.select("s_acctbal", "s_name", "s_nationkey", (F.col("s_suppkey") + 1_000_000).alias("s_suppkey")), there.columns))


def concat_streams(spark, d):
    part = read(spark, d, "part").select("p_partkey", "p_name", "p_size")
    return shape.concatenate(part.where("p_size < 20"), part.where("p_size between 20 and 39"), part.where("p_size >= 40"))


def align_columns(spark, d):
    """The destination's types in the source's order."""
    there = table(Column("p_name", S.TEXT), Column("p_size", S.INT64), Column("p_partkey", S.INT64, False))
    arriving = table(Column("p_partkey", S.INT64, False), Column("p_name", S.TEXT), Column("p_size", S.INT64))
    names = [c.name for c in rows.align_schema(there, arriving).table.columns]
    return rows.project(read(spark, d, "part").withColumn("p_size", F.col("p_size").cast("long")), names)


def rename_header(spark, d):
    return rows.rename_header(read(spark, d, "region"), ["Key", "Name"])


def null_empty_semantics(spark, d):
    """An empty cell is null where null may be, and empty text where it may not."""
    schema = table(Column("id", S.INT64, False), Column("may", S.TEXT), Column("must", S.TEXT, False))
    cell = F.when(F.col("event_type") == "click", "").otherwise(F.col("event_type"))
    cells = read(spark, d, "events").select(F.col("event_id").cast("string").alias("id"), cell.alias("may"), cell.alias("must"))
    return rows.decoded(cells, schema)


def one_of_validate(spark, d):
    schema = table(Column("id", S.INT64, False), Column("status", S.Named("status")), named={"status": OneOf(("F", "O", "P"))})
    cells = read(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("status"))
    return rows.decoded(cells, schema)


def _as_text(texts, value):
    """Of rows with a `text`, whether it is a geometry, a value of it as a storage without geometries has it, and that loaded: each in a step, computed once."""
    t = parse_type("SphericalGeography")
    # a file of small rows may have a single row group, which one task reads, and a row takes long
    texts = texts.repartition("c_custkey")
    stored = texts.select("c_custkey", is_geometry(F.col("text")).alias("good"), storage.store("hive", t, value).alias("stored"))
    return stored.select("*", storage.load("hive", t, F.col("stored")).alias("loaded"))


def geo_points(spark, d):
    """GeoJSON points, checked, stored as well-known text and loaded again."""
    text = F.concat(F.lit('{"type":"Point","coordinates":['), F.col("c_custkey"), F.lit(",-"), F.col("c_custkey"), F.lit(".5]}"))
    return _as_text(read(spark, d, "customer").select("c_custkey", text.alias("text")), decode.scalar(ONE(GeoJson()), GeoJson(), F.col("text"), "value"))


def storage_hive_timestamp(spark, d):
    stored = storage.store("hive", parse_type("timestamp(6)"), F.col("ts"))
    return read(spark, d, "events").select("event_id", encode.timestamp(stored).alias("stored"))


def storage_iceberg_rows(spark, d):
    """Small integers in arrays and rows, stored as larger ones and loaded again."""
    t = parse_type('ARRAY(ROW("size" SMALLINT, "name" VARCHAR))')
    value = F.array(F.struct(F.col("p_size").cast("smallint").alias("size"), F.col("p_name").alias("name")))
    stored = storage.store("iceberg", t, value)
    loaded = storage.load("iceberg", t, stored)
    return read(spark, d, "part").select("p_partkey", stored[0]["size"].alias("stored_size"), loaded[0]["size"].cast("int").alias("size"), loaded[0]["name"].alias("name"))


EVENTS = table(Column("event_id", S.INT64, False), Column("ts", S.TIMESTAMP), Column("user_id", S.INT64), Column("event_type", S.TEXT), Column("value", S.FLOAT64), Column("props", S.JSON))
TURNS = table(Column("conv_id", S.INT64, False), Column("turn", S.INT64, False), Column("role", S.TEXT), Column("text", S.TEXT))


def _written(spark, df, schema, kind):
    path = scratch(spark) + "/"
    files.write_folder(df, schema, path, kind, IfExists(), "data")
    return files.scan(spark, path, schema, kind).drop("__stream")


#: Geometries of each kind around a number K, and the well-known text of each.
SHAPES = (
    ('{"type":"Point","coordinates":[K,-K.5]}', "POINT (K -K.5)"), ('{"type":"MultiPoint","coordinates":[[K,1],[2,K]]}', "MULTIPOINT ((K 1), (2 K))"), ('{"type":"LineString","coordinates":[[K,1,2],[2,3,K]]}', "LINESTRING Z (K 1 2, 2 3 K)"),
    ('{"type":"Polygon","coordinates":[[[0,0],[K,0],[K,K],[0,0]]]}', "POLYGON ((0 0, K 0, K K, 0 0))"), ('{"type":"MultiLineString","coordinates":[[[K,1],[2,3]],[[4,5],[6,K]]]}', "MULTILINESTRING ((K 1, 2 3), (4 5, 6 K))"),
    ('{"type":"MultiPolygon","coordinates":[[[[0,0],[K,0],[K,K],[0,0]]],[[[9,9],[K,9],[K,K],[9,9]]]]}', "MULTIPOLYGON (((0 0, K 0, K K, 0 0)), ((9 9, K 9, K K, 9 9)))"),
    ('{"type":"GeometryCollection","geometries":[{"type":"Point","coordinates":[K,1]},{"type":"LineString","coordinates":[[K,1],[2,K]]}]}', "GEOMETRYCOLLECTION (POINT (K 1), LINESTRING (K 1, 2 K))"),
)


def geo_kinds(spark, d):
    """Geometries of all kinds, one for each customer, as a storage without them has them, and back."""
    shape = F.element_at(F.array(*[F.lit(g) for g, _ in SHAPES]), (F.col("c_custkey") % len(SHAPES) + 1).cast("int"))
    text = F.replace(shape, F.lit("K"), F.col("c_custkey").cast("string"))
    return _as_text(read(spark, d, "customer").select("c_custkey", text.alias("text")), F.col("text"))


def csv_roundtrip(spark, d):
    return _written(spark, read(spark, d, "events"), EVENTS, "csv").withColumn("ts", encode.timestamp(F.col("ts")))


def csv_roundtrip_text(spark, d):
    """Texts with line breaks, quotes and commas."""
    return _written(spark, read(spark, d, "conversations"), TURNS, "csv")


def csv_in_ranges(spark, d):
    """One file whose cells hold line breaks, read by 32 tasks or so."""
    from .sources.storage import Files

    at = locators.parse(f"file:{scratch(spark)}.csv")
    at.write(read(spark, d, "conversations").select([c.name for c in TURNS.table.columns]), TURNS, DestinationArguments(IfExists("error")))
    own = type(spark)(spark.sparkContext, spark._jsparkSession.cloneSession())
    own.conf.set("spark.sql.files.maxPartitionBytes", max(1, sum(n for _, n in Files(spark, at.path).listed()) // 32))
    own.conf.set("spark.sql.files.openCostInBytes", 0)
    return at.read(own, TURNS, SourceArguments()).drop("__stream")


def jsonl_roundtrip(spark, d):
    return _written(spark, read(spark, d, "events"), EVENTS, "jsonl").withColumn("ts", encode.timestamp(F.col("ts")))


def rechunk_sizes(spark, d):
    """What chunks hold together: all rows, all bytes, and none much more than was asked for."""
    size = 100_000
    text = rows.encoded(read(spark, d, "orders").select([c.name for c in ORDERS.table.columns]), ORDERS)
    chunks = shape.rechunk(text, size).withColumn("b", shape.row_bytes(text)).groupBy("__chunk").agg(F.count("*").alias("n"), F.sum("b").alias("b"), F.max("b").alias("most"))
    return chunks.agg(F.sum("n").alias("n_rows"), F.sum("b").alias("n_bytes"), F.max(F.when(F.col("b") > size + shape.BUFFER + F.col("most"), 1).otherwise(0)).alias("too_large"))


def stream_names(spark, d):
    df = shape.with_stream(read(spark, d, "nation"), f"{d}/nation.parquet", False)
    return df.groupBy(F.col("__stream").alias("stream")).agg(F.count("*").alias("n"))


def inline_relation(spark, d):
    schema = table(Column("r_regionkey", S.INT32), Column("r_name", S.TEXT))
    at = locators.parse(f"inline:region_{uuid.uuid4().hex[:8]}")
    at.write(read(spark, d, "region"), schema, DestinationArguments(IfExists("overwrite")))
    return at.read(spark, schema, SourceArguments())


def _types(schema: Schema) -> list[str]:
    return [json.dumps(S.type_to_json(c.data_type)) for c in schema.table.columns]


def schema_of_tables(spark, d):
    """Each table's columns, read from Spark, with their types in every dialect; what a dialect's parser reads back is compared with it."""
    found = []
    for t in TABLES:
        own = S.from_spark(t, read(spark, d, t).schema)
        made = trino.create_table(own)
        back = {"postgres": _types(postgres.parse(postgres.render(own))), "portable": _types(S.schema_from_json(S.schema_to_json(own))), "bigquery": _types(bigquery.parse(bigquery.render(own))), "trino": _types(trino.parse(trino.render(own)))}
        for i, c in enumerate(own.table.columns):
            names = postgres.type_name(own, c.data_type), bigquery.type_name(own, c.data_type), str(made.columns[i][1])
            found.append((t, i + 1, c.name, _types(own)[i], c.is_nullable, *names, *(back[k][i] for k in ("portable", "postgres", "bigquery", "trino"))))
    return spark.createDataFrame(found, "table_name string, position int, column_name string, portable string, nullable boolean, postgres string, bigquery string, trino string, from_portable string, from_postgres string, from_bigquery string, from_trino string")


def schema_conversion(spark, d):
    """From Spark's catalog through PostgreSQL's DDL, BigQuery's JSON and Trino's DDL in files, one after another."""
    from .plans.copy import convert_schema

    at, name = scratch(spark), f"conversion_{uuid.uuid4().hex[:8]}"
    read(spark, d, "orders").limit(0).createOrReplaceTempView(name)
    places = [f"table:{name}", f"postgres-sql:{at}/a.sql", f"portable-schema:{at}/b.json", f"trino-sql:{at}/c.sql", f"bigquery-schema:{at}/d.json"]
    for a, b in zip(places, places[1:]):
        convert_schema(spark, a, b)
    last = locators.parse(places[-1]).schema(spark, SourceArguments())
    spark.catalog.dropTempView(name)
    return spark.createDataFrame([(i, c.name, t) for i, (c, t) in enumerate(zip(last.table.columns, _types(last)), 1)], "position int, column_name string, portable string")


def csv_header_schema(spark, d):
    """The columns that a CSV file's header tells."""
    path = f"{scratch(spark)}.csv"
    schema = S.from_spark("part", read(spark, d, "part").schema)
    files.write_file(read(spark, d, "part").limit(3), schema, path, "csv", IfExists())
    found = locators.parse(f"csv:{path}").schema(spark, SourceArguments())
    return spark.createDataFrame([(i, c.name, t) for i, (c, t) in enumerate(zip(found.table.columns, _types(found)), 1)], "position int, column_name string, portable string")


NATIONS = table(Column("n_nationkey", S.INT64, False), Column("n_name", S.TEXT), Column("n_regionkey", S.INT64))


def _nations(spark, d, where="true"):
    return read(spark, d, "nation").where(where).select(F.col("n_nationkey").cast("long"), "n_name", F.col("n_regionkey").cast("long"))


def _policy(spark, d, *steps):
    """Writes to a new table, with a policy and rows for each step; what is there then, and how many steps were refused."""
    at, refused = locators.parse(f"table:policy_{uuid.uuid4().hex[:10]}"), 0
    for policy, df in steps:
        try:
            at.write(df, NATIONS, DestinationArguments(IfExists.parse(policy)))
        except TideError:
            refused += 1
    return spark.table(at.body).withColumn("refused", F.lit(refused))


def if_exists_error(spark, d):
    return _policy(spark, d, ("error", _nations(spark, d, "n_regionkey = 1")), ("error", _nations(spark, d)))


def if_exists_append(spark, d):
    return _policy(spark, d, ("append", _nations(spark, d, "n_regionkey < 3")), ("append", _nations(spark, d, "n_regionkey > 1")))


def if_exists_overwrite(spark, d):
    return _policy(spark, d, ("overwrite", _nations(spark, d)), ("overwrite", _nations(spark, d, "n_regionkey = 2")))


def if_exists_upsert(spark, d):
    changed = _nations(spark, d, "n_regionkey in (2, 4)").withColumn("n_name", F.lower("n_name"))
    return _policy(spark, d, ("error", _nations(spark, d, "n_regionkey < 3")), ("upsert-on:n_nationkey", changed))


def single_file(spark, d):
    """One CSV file, overwritten, and read as an older locator names it."""
    path = f"{scratch(spark)}.csv"
    at = locators.parse(f"file:{path}")
    for policy, df in (("error", _nations(spark, d)), ("overwrite", _nations(spark, d, "n_regionkey <> 3"))):
        at.write(df, NATIONS, DestinationArguments(IfExists.parse(policy)))
    return locators.parse(f"csv:{path}").read(spark, NATIONS, SourceArguments(where="n_nationkey > 4")).drop("__stream")


def copied_folder(spark, d):
    """A copy of a folder of files keeps their streams, through JSON Lines."""
    from .plans.copy import copy

    at, name = scratch(spark), f"regions_{uuid.uuid4().hex[:8]}"
    schema = f"portable-schema:{at}/schema.json"
    locators.parse(schema).write_schema(spark, NATIONS, IfExists())
    for k in range(5):
        files.write_file(_nations(spark, d, f"n_regionkey = {k}"), NATIONS, f"{at}/in/{'deep/' if k % 2 else ''}r{k}.v1.csv", "csv", IfExists())
    copy(spark, f"file:{at}/in/", f"file:{at}/out/", schema=schema, to_format="jsonl")
    copy(spark, f"file:{at}/out/", f"table:{name}", schema=schema, where="n_nationkey % 2 = 0")
    back = files.scan(spark, f"{at}/out/", NATIONS).groupBy(F.col("__stream").alias("stream")).agg(F.count("*").alias("n"))
    return back.join(spark.table(name).groupBy(F.concat(F.when(F.col("n_regionkey") % 2 == 1, "deep/").otherwise(""), F.lit("r"), F.col("n_regionkey")).alias("stream")).agg(F.count("*").alias("even")), "stream", "left")


def arriving_files(spark, d):
    """Files of a folder, appended to a table as a stream, twice over with the same checkpoints: each once."""
    from .streaming.tables import arriving, keep_copied

    at, name = scratch(spark), f"arriving_{uuid.uuid4().hex[:8]}"
    for k in range(5):
        files.write_file(_nations(spark, d, f"n_regionkey = {k}"), NATIONS, f"{at}/in/r{k}.csv", "csv", IfExists())
        if k in (2, 4):
            keep_copied(arriving(spark, f"{at}/in", NATIONS), NATIONS, name, "append", f"{at}/checkpoints", once=True).awaitTermination()
    return spark.table(name)


def align_types(spark, d):
    """A table's text column takes JSON as it is written; its number column takes no text."""
    name, events = f"aligned_{uuid.uuid4().hex[:8]}", read(spark, d, "events").select("event_id", "event_type", "props")
    at, refused = locators.parse(f"table:{name}"), 0
    columns = lambda *types: table(*[Column(c, t) for c, t in zip(events.columns, types)])
    try:
        at.write(events.where("event_id % 2 = 0"), columns(S.INT64, S.TEXT, S.TEXT), DestinationArguments())
        at.write(events.where("event_id % 2 = 1").select("props", "event_id", "event_type"), columns(S.INT64, OneOf(("click", "view")), S.JSON).select(["props", "event_id", "event_type"]), DestinationArguments(IfExists("append")))
        try:
            at.write(events.withColumn("event_id", F.col("event_id").cast("string")), columns(S.TEXT, S.TEXT, S.TEXT), DestinationArguments(IfExists("append")))
        except TideError:
            refused = 1
        return checkpointed(spark.table(name).withColumn("refused", F.lit(refused)))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def json_lines_not_null(spark, d):
    """Keys that have to be there, with values that are not null."""
    schema = table(Column("k", S.INT64, False), Column("name", S.TEXT, False), Column("note", S.TEXT))
    line = F.concat(F.lit('{"k": '), F.col("c_custkey"), F.lit(', "name": "'), F.col("c_name"), F.when(F.col("c_custkey") % 2 == 0, '", "note": null}').otherwise('", "note": "odd"}'))
    return rows.decoded(read(spark, d, "customer").select(*decode.from_json_text(schema, line)), schema)


MIXED = Struct((StructField("price", S.DECIMAL), StructField("times", Array(S.TIMESTAMP)), StructField("big", S.INT64), StructField("flags", Array(S.BOOL)), StructField("at", GeoJson())))


def _mixed(spark, d):
    point = F.concat(F.lit('{"type":"Point","coordinates":['), F.col("o_custkey"), F.lit(",0]}"))
    value = F.struct((F.col("o_custkey") + F.lit("0.25").cast("decimal(3,2)")).cast("decimal(38,9)").alias("price"), F.array(F.col("o_orderdate").cast("timestamp_ntz"), F.lit(None)).alias("times"),
        F.col("o_orderkey").alias("big"), F.array(F.col("o_custkey") % 2 == 0).alias("flags"), point.alias("at"))
    return read(spark, d, "orders").select("o_orderkey", value.alias("value"))


def nested_encode(spark, d):
    """Decimals, times, large numbers, truth values and geometries inside a struct."""
    return _mixed(spark, d).select("o_orderkey", encode.cell(ONE(MIXED), MIXED, F.col("value")).alias("cell"))


def nested_decode(spark, d):
    text = encode.cell(ONE(MIXED), MIXED, F.col("value"))
    back = F.col("back")
    typed = _mixed(spark, d).select("o_orderkey", decode.cell(ONE(MIXED), MIXED, text, "value").alias("back"))
    return typed.select("o_orderkey", encode.scalar(ONE(S.DECIMAL), S.DECIMAL, back["price"]).alias("price"), encode.timestamp(back["times"][0]).alias("first"), back["times"][1].isNull().alias("missing"), back["big"].alias("big"), back["flags"][0].alias("flag"))


def json_kinds(spark, d):
    """Numbers from JSON numbers and from strings, text from strings, truth from true and false."""
    t = Struct((StructField("n", S.INT64), StructField("s", S.TEXT), StructField("b", S.BOOL), StructField("xs", Array(S.FLOAT64))))
    key = F.col("event_id").cast("string")
    text = F.concat(F.lit('{"n": '), F.when(F.col("event_id") % 2 == 0, key).otherwise(F.concat(F.lit('"'), key, F.lit('"'))), F.lit(', "s": "'), key, F.lit('", "b": '), (F.col("event_id") % 3 == 0).cast("string"), F.lit(', "xs": ["1.5", 2, null], "more": {}}'))
    value = F.col("value")
    return read(spark, d, "events").select("event_id", decode.cell(ONE(t), t, text, "value").alias("value")).select("event_id", value["n"].alias("n"), value["s"].alias("s"), value["b"].alias("b"), value["xs"][0].alias("x0"), value["xs"][1].alias("x1"), value["xs"][2].isNull().alias("x2_null"))


def _own_schemas(spark, d) -> list[tuple[str, Schema]]:
    """The given tables' schemas, as Spark reads them."""
    return [(t, S.from_spark(t, read(spark, d, t).schema)) for t in TABLES]


def storage_types(spark, d):
    """What each profile stores the types of all tables' columns as, alone, in arrays and in rows, and whether an expression changes."""
    found = []
    for t, own in _own_schemas(spark, d):
        for c in own.table.columns:
            plain = trino.from_portable(own, c.data_type)
            for kind, of in (("alone", plain), ("array", parse_type(f"array({plain})")), ("row", parse_type(f'row("a" {plain}, "b" varchar)'))):
                for profile in storage.CAPABILITIES:
                    found.append((t, c.name, kind, profile, str(storage.transform(profile, of).stored), storage.transform(profile, of).is_identity, storage.stored_sql(profile, of, "x") == "x"))
    return spark.createDataFrame(found, "table_name string, column_name string, kind string, profile string, stored string, same boolean, plain boolean")


def storage_tables(spark, d):
    """CREATE TABLE for all tables as each profile can have them: NOT NULL where a name ends in key or id, OR REPLACE, and what merging needs."""
    found = []
    for t, own in _own_schemas(spark, d):
        own = Schema(Table(t, tuple(Column(c.name, c.data_type, not c.name.endswith(("key", "_id"))) for c in own.table.columns)))
        for profile, can in storage.CAPABILITIES.items():
            first, made = storage.storage_table(profile, trino.create_table(own, or_replace=True), merge=can["merge"])
            for i, (name, kind, nullable, _) in enumerate(made.columns, 1):
                found.append((t, profile, i, name, str(kind), nullable, len(first), made.or_replace, ",".join(sorted(k for k, _ in made.options))))
    return spark.createDataFrame(found, "table_name string, profile string, position int, column_name string, type string, nullable boolean, drops int, or_replace boolean, options string")


def storage_times(spark, d):
    """Times at UTC in a storage that has none, and with fewer digits."""
    zoned, short = parse_type("timestamp(3) with time zone"), parse_type("timestamp(1)")
    at = F.col("ts").cast("timestamp")
    back = storage.load("hive", zoned, storage.store("hive", zoned, at))
    cut = storage.load("iceberg", short, storage.store("iceberg", short, F.col("ts").cast("timestamp_ntz")))
    return read(spark, d, "events").select("event_id", encode.timestamp_utc(back).alias("hive"), encode.timestamp(cut).alias("iceberg"))


def rechunk_chunks(spark, d):
    """Each chunk's rows and bytes, of rows in the order of their keys, as one count after another has them."""
    ordered = read(spark, d, "orders").select([c.name for c in ORDERS.table.columns]).orderBy("o_orderkey")
    text = rows.encoded(ordered, ORDERS)
    return shape.rechunk(text, 50_000).withColumn("b", shape.row_bytes(text)).groupBy(F.col("__chunk").alias("chunk")).agg(F.count("*").alias("n_rows"), F.sum("b").alias("n_bytes"), F.min(F.col("o_orderkey").cast("long")).alias("first_key"))


def rechunk_long_rows(spark, d):
    """Texts longer than a chunk are chunks of their own, and no number is left out."""
    text = read(spark, d, "conversations").select("text").where("text is not null").repartition(3)
    chunks = shape.rechunk(text, 200).groupBy("__chunk").agg(F.count("*").alias("n"))
    return chunks.agg(F.sum("n").alias("n_rows"), F.min("__chunk").alias("first"), (F.max("__chunk") == F.count("*")).alias("gapless"))


def literals_of_rows(spark, d):
    """Values of all customers and turns as BigQuery and Trino write them."""
    customers = read(spark, d, "customer").select(F.lit("customer").alias("source"), F.col("c_custkey").alias("id"), F.lit(0).cast("long").alias("part"), F.col("c_name").alias("text"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_custkey")).alias("number"))
    turns = read(spark, d, "conversations").select(F.lit("conversations"), F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("text"), F.length("text").cast("long"))
    texts, numbers = F.col("text"), F.col("number")
    return customers.union(turns).select(
        "source", "id", "part", literals.bigquery_column(S.TEXT, texts).alias("bq_text"), literals.bigquery_column(S.INT64, numbers).alias("bq_number"), literals.bigquery_column(Array(S.INT64), F.array(numbers, F.lit(None), F.lit(-1))).alias("bq_array"),
        literals.trino_column(parse_type("varchar"), texts).alias("trino_text"), literals.trino_column(parse_type("bigint"), numbers).alias("trino_number"), literals.trino_column(parse_type("array(bigint)"), F.array(numbers, F.lit(7))).alias("trino_array"),
    )


def driver_arguments(spark, d):
    """The columns of all tables as arguments of a driver: objects in objects, and lists."""
    own = _own_schemas(spark, d)
    given = [x for t, schema in own for c in schema.table.columns for x in (f"tables[{t}].{c.name}={json.dumps(S.type_to_json(c.data_type))}", f"names.{t}[]={c.name}")]
    found = arguments.parse(given)
    return spark.createDataFrame([(t, i, name, found["tables"][t][name]) for t, names in found["names"].items() for i, name in enumerate(names, 1)], "table_name string, position int, column_name string, portable string")


_DONE = (
    copy_orders, where_filter, count_where, count_all_tables, encode_timestamp, encode_timestamp_utc, encode_bool, decode_bool_tokens, decode_scalars, decode_timestamp_offsets, decode_uuid, encode_int_array,
    struct_encode, struct_roundtrip, json_field, json_lines_encode, json_lines_decode, upsert_orders, upsert_by_file, upsert_composite_key, upsert_all_keys, append_rows, concat_streams, align_columns, rename_header,
    null_empty_semantics, one_of_validate, geo_points, geo_kinds, storage_hive_timestamp, storage_iceberg_rows, csv_roundtrip, csv_roundtrip_text, csv_in_ranges, jsonl_roundtrip, rechunk_sizes, stream_names, inline_relation,
    schema_of_tables, schema_conversion, csv_header_schema, if_exists_error, if_exists_append, if_exists_overwrite, if_exists_upsert, single_file, copied_folder, arriving_files, align_types, json_lines_not_null,
    nested_encode, nested_decode, json_kinds, storage_types, storage_tables, storage_times, rechunk_chunks, rechunk_long_rows, literals_of_rows, driver_arguments,
)
QUERIES = {f.__name__: f for f in _DONE}

_STAMP = "regexp_replace(strftime({}, '%Y-%m-%dT%H:%M:%S.%f'), '\\.?0+$', '')"
_UUID = "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12)"
#: Types by DuckDB's names: portable, PostgreSQL's, BigQuery's and Trino's, and what is read back from the last two.
_TYPES = {
    "BIGINT": ('"int64"', "bigint", "INT64", "BIGINT", '"int64"', '"int64"'), "INTEGER": ('"int32"', "int", "INT64", "INT", '"int64"', '"int32"'), "VARCHAR": ('"text"', "text", "STRING", "VARCHAR", '"text"', '"text"'),
    "DOUBLE": ('"float64"', "double precision", "FLOAT64", "DOUBLE", '"float64"', '"float64"'), "FLOAT": ('"float32"', "real", "FLOAT64", "REAL", '"float64"', '"float32"'), "BOOLEAN": ('"bool"', "boolean", "BOOL", "BOOLEAN", '"bool"', '"bool"'),
    "TIMESTAMP": ('"timestamp_without_time_zone"', "timestamp without time zone", "DATETIME", "TIMESTAMP(3)", '"timestamp_without_time_zone"', '"timestamp_without_time_zone"'),
    "FLOAT[]": ('{"array": "float32"}', "real[]", "ARRAY<FLOAT64>", "ARRAY(REAL)", '{"array": "float64"}', '{"array": "float32"}'),
}
_TYPE_ROWS = ", ".join("(" + ", ".join(f"'{x}'" for x in (k, *v)) + ")" for k, v in _TYPES.items())
_LISTED = f"(select * from information_schema.columns where table_name in ({', '.join(map(repr, TABLES))}))"
_NATION = "select cast(n_nationkey as bigint) as n_nationkey, n_name, cast(n_regionkey as bigint) as n_regionkey"
_ORDER_CELLS = f"cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey, o_orderstatus, {_STAMP.format('o_orderdate')} as o_orderdate, o_orderpriority"

SQL = {
    "copy_orders": f"select {_ORDER_CELLS} from orders where o_totalprice > 100000",
    "where_filter": "select l_orderkey, l_partkey, l_linenumber, l_quantity from lineitem where l_quantity >= 25 and l_returnflag in ('A', 'R')",
    "count_where": "select count(*) as count from lineitem where l_discount > 0.05 and l_shipdate < timestamp '1998-01-01'",
    "count_all_tables": " union all ".join(f"select '{t}' as name, count(*) as count from {t}" for t in TABLES),
    "encode_timestamp": f"select event_id, {_STAMP.format('ts')} as ts_text from events",
    "encode_timestamp_utc": f"select event_id, {_STAMP.format('ts')} || 'Z' as ts_text from events",
    "encode_bool": "select case l_returnflag when 'R' then 't' when 'N' then null else 'f' end as flag, count(*) as n from lineitem group by 1",
    "decode_bool_tokens": "select event_id, event_id % 8 in (0, 2, 4, 6) as flag from events",
    "decode_scalars": f"select o_orderkey as k, strftime(o_orderdate, '%Y-%m-%d') as day, {_STAMP.format("date_trunc('milliseconds', o_orderdate)")} as at, o_custkey || '.25' as amount, cast(o_orderkey % 30000 as integer) as small from orders",
    "decode_timestamp_offsets": f"select event_id, {_STAMP.format('ts + (case event_id % 4 when 2 then 1 when 3 then -1 else 0 end) * interval 1 hour')} || 'Z' as at from events",
    "decode_uuid": f"select o_orderkey, {_UUID} as id from (select o_orderkey, md5(cast(o_orderkey as varchar)) as h from orders)",
    "encode_int_array": "select o_orderkey, '[\"' || o_orderkey || '\",\"' || o_custkey || '\"]' as pair from orders",
    "struct_encode": "select c_custkey, '{\"c_custkey\":\"' || c_custkey || '\",\"c_name\":\"' || c_name || '\",\"segment\":' || coalesce('\"' || nullif(c_mktsegment, 'BUILDING') || '\"', 'null') || ',\"nation\":' || c_nationkey || '}' as value from customer",
    "struct_roundtrip": "select c_custkey, c_name, nullif(c_mktsegment, 'BUILDING') as segment, c_nationkey as nation from customer",
    "json_field": "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events",
    "json_lines_encode": """select '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","big":' || case when n_nationkey > 7 then '"' || b || '"' else cast(b as varchar) end || ',"flag":' || case when n_regionkey > 2 then 'true' else 'false' end || '}' as line
        from (select *, cast(n_nationkey as bigint) * 1125899906842624 as b from nation)""",
    "json_lines_decode": "select event_id as id, event_type as kind, cast(null as date) as missing, true as ok from events",
    "upsert_orders": "select o_orderkey, o_custkey, case when o_orderkey % 5 = 0 then 'X' else o_orderstatus end as o_orderstatus from orders union all select -o_orderkey - 1, o_custkey, 'N' from orders where o_orderkey % 5 = 0",
    "upsert_by_file": """with c as (select *, o_orderkey % 2 = 0 and o_orderkey <= (select max(o_orderkey) // 20 from orders) as chosen from orders)
        select o_orderkey, o_custkey, case when chosen then 'X' else o_orderstatus end as o_orderstatus, true as some_alone from c union all select -o_orderkey - 1, o_custkey, 'N', true from c where chosen""",
    "upsert_composite_key": "select conv_id, turn, role, case when turn = 1 then -1 else cast(length(text) as integer) end as n from conversations union all select conv_id, 1000, role, cast(length(text) as integer) from conversations where turn = 0",
    "upsert_all_keys": "select n_nationkey, n_regionkey from nation union all select 99, 9",
    "append_rows": "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier union all select s_suppkey + 1000000, s_name, s_nationkey, s_acctbal from supplier",
    "concat_streams": "select p_partkey, p_name, p_size from part",
    "align_columns": "select p_partkey, p_name, cast(p_size as bigint) as p_size from part",
    "rename_header": 'select r_regionkey as "Key", r_name as "Name" from region',
    "null_empty_semantics": "select event_id as id, nullif(event_type, 'click') as may, case when event_type = 'click' then '' else event_type end as must from events",
    "one_of_validate": "select o_orderkey as id, o_orderstatus as status from orders where o_orderstatus in ('F', 'O', 'P')",
    "geo_points": """select c_custkey, true as good, 'POINT (' || c_custkey || ' -' || c_custkey || '.5)' as stored, '{"type":"Point","coordinates":[' || c_custkey || ',-' || c_custkey || '.5]}' as loaded from customer""",
    "storage_hive_timestamp": f"select event_id, {_STAMP.format("date_trunc('milliseconds', ts)")} as stored from events",
    "storage_iceberg_rows": "select p_partkey, p_size as stored_size, p_size as size, p_name as name from part",
    "geo_kinds": f"""select c_custkey, true as good, replace(wkt, 'K', cast(c_custkey as varchar)) as stored, replace(geo, 'K', cast(c_custkey as varchar)) as loaded from customer join (values {", ".join(f"({i}, '{g}', '{w}')" for i, (g, w) in enumerate(SHAPES))}) t(i, geo, wkt) on c_custkey % {len(SHAPES)} = i""",
    "csv_roundtrip": f"select event_id, {_STAMP.format('ts')} as ts, user_id, event_type, value, props from events",
    "csv_roundtrip_text": "select conv_id, turn, role, text from conversations",
    "csv_in_ranges": "select conv_id, turn, role, text from conversations",
    "jsonl_roundtrip": f"select event_id, {_STAMP.format('ts')} as ts, user_id, event_type, value, replace(props, ' ', '') as props from events",
    "rechunk_sizes": f"select count(*) as n_rows, cast(sum(strlen(o_orderkey) + strlen(o_custkey) + strlen(o_orderstatus) + strlen(o_orderdate) + strlen(o_orderpriority) + 5) as bigint) as n_bytes, 0 as too_large from (select {_ORDER_CELLS} from orders)",
    "stream_names": "select 'nation' as stream, count(*) as n from nation",
    "inline_relation": "select r_regionkey, r_name from region",
    "schema_of_tables": f"""select c.table_name, cast(c.ordinal_position as integer) as position, c.column_name, t.portable, true as nullable, t.postgres, t.bigquery, t.trino,
        t.portable as from_portable, t.portable as from_postgres, t.from_bigquery, t.from_trino
        from {_LISTED} c join (values {_TYPE_ROWS}) t(name, portable, postgres, bigquery, trino, from_bigquery, from_trino) on c.data_type = t.name""",
    "schema_conversion": f"select cast(ordinal_position as integer) as position, column_name, t.from_bigquery as portable from {_LISTED} c join (values {_TYPE_ROWS}) t(name, portable, postgres, bigquery, trino, from_bigquery, from_trino) on c.data_type = t.name where table_name = 'orders'",
    "csv_header_schema": f"select cast(ordinal_position as integer) as position, column_name, '\"text\"' as portable from {_LISTED} where table_name = 'part'",
    "if_exists_error": f"{_NATION}, 1 as refused from nation where n_regionkey = 1",
    "if_exists_append": f"{_NATION}, 0 as refused from nation where n_regionkey < 3 union all {_NATION}, 0 from nation where n_regionkey > 1",
    "if_exists_overwrite": f"{_NATION}, 0 as refused from nation where n_regionkey = 2",
    "if_exists_upsert": "select cast(n_nationkey as bigint) as n_nationkey, case when n_regionkey in (2, 4) then lower(n_name) else n_name end as n_name, cast(n_regionkey as bigint) as n_regionkey, 0 as refused from nation where n_regionkey <> 3",
    "single_file": f"{_NATION} from nation where n_regionkey <> 3 and n_nationkey > 4",
    "copied_folder": "select case when n_regionkey % 2 = 1 then 'deep/' else '' end || 'r' || n_regionkey as stream, count(*) as n, nullif(sum(case when n_nationkey % 2 = 0 then 1 else 0 end), 0)::bigint as even from nation group by 1",
    "arriving_files": f"{_NATION} from nation",
    "align_types": "select event_id, event_type, props, 1 as refused from events",
    "json_lines_not_null": "select c_custkey as k, c_name as name, case when c_custkey % 2 = 1 then 'odd' end as note from customer",
    "nested_encode": f"""select o_orderkey, '{{"price":"' || o_custkey || '.25","times":["' || {_STAMP.format('o_orderdate')} || '",null],"big":"' || o_orderkey || '","flags":[' || case when o_custkey % 2 = 0 then 'true' else 'false' end || '],"at":{{"type":"Point","coordinates":[' || o_custkey || ',0]}}}}' as cell from orders""",
    "nested_decode": f"select o_orderkey, o_custkey || '.25' as price, {_STAMP.format('o_orderdate')} as first, true as missing, o_orderkey as big, o_custkey % 2 = 0 as flag from orders",
    "json_kinds": "select event_id, event_id as n, cast(event_id as varchar) as s, event_id % 3 = 0 as b, 1.5::double as x0, 2::double as x1, true as x2_null from events",
    "storage_types": f"""with c as (select c.table_name, c.column_name, t.trino from {_LISTED} c join (values {_TYPE_ROWS}) t(name, portable, postgres, bigquery, trino, from_bigquery, from_trino) on c.data_type = t.name),
        k as (select *, 'alone' as kind, trino as of from c union all select *, 'array', 'ARRAY(' || trino || ')' from c union all select *, 'row', 'ROW("a" ' || trino || ', "b" VARCHAR)' from c)
        select table_name, column_name, kind, profile, case when profile = 'iceberg' then replace(of, 'TIMESTAMP(3)', 'TIMESTAMP(6)') else of end as stored, profile <> 'iceberg' or not contains(of, 'TIMESTAMP(3)') as same,
               profile <> 'iceberg' or not contains(of, 'TIMESTAMP(3)') as plain from k, (values ('hive'), ('iceberg'), ('memory')) p(profile)""",
    "storage_tables": f"""select c.table_name, profile, cast(c.ordinal_position as integer) as position, c.column_name, case when profile = 'iceberg' then replace(t.trino, 'TIMESTAMP(3)', 'TIMESTAMP(6)') else t.trino end as type,
        profile <> 'iceberg' or not regexp_matches(c.column_name, '(key|_id)$') as nullable, drops, or_replace, options
        from {_LISTED} c join (values {_TYPE_ROWS}) t(name, portable, postgres, bigquery, trino, from_bigquery, from_trino) on c.data_type = t.name,
        (values ('hive', 1::integer, false, 'format,transactional'), ('iceberg', 0, true, ''), ('memory', 1, false, '')) p(profile, drops, or_replace, options)""",
    "storage_times": f"select event_id, {_STAMP.format("date_trunc('milliseconds', ts)")} || 'Z' as hive, {_STAMP.format("time_bucket(interval '100 milliseconds', ts)")} as iceberg from events",
    "rechunk_chunks": f"""with recursive o as (select cast(o_orderkey as bigint) as k, strlen(o_orderkey) + strlen(o_custkey) + strlen(o_orderstatus) + strlen(o_orderdate) + strlen(o_orderpriority) + 5 as b from (select {_ORDER_CELLS} from orders)),
        s as materialized (select k, b, sum(b) over (order by k) as upto from o),
        c(chunk, begin) as (select 1, cast(0 as hugeint) union all select chunk + 1, min(upto) from c join s on upto > begin + 57344 - {sum(len(c.name) + 1 for c in ORDERS.table.columns)} group by chunk having min(upto) < (select max(upto) from s))
        select chunk, count(*) as n_rows, cast(sum(b) as bigint) as n_bytes, min(k) as first_key from s asof join c on s.upto > c.begin group by chunk""",
    "rechunk_long_rows": "select count(*) as n_rows, 1 as first, true as gapless from conversations where text is not null",
    "literals_of_rows": r"""with v as (select 'customer' as source, c_custkey as id, 0 as part, c_name as text, case when c_custkey % 3 > 0 then c_custkey end as number from customer union all select 'conversations', conv_id, turn, text, length(text) from conversations),
        b as (select *, '"' || array_to_string(list_transform(regexp_extract_all(text, '(?s).'), lambda c: case when c in ('"', '\') then '\' || c when c between ' ' and '~' and ascii(c) < 127 then c else '\U' || lpad(lower(to_hex(unicode(c))), 8, '0') end), '') || '"' as escaped from v)
        select source, cast(id as bigint) as id, cast(part as bigint) as part, coalesce(escaped, 'NULL') as bq_text, coalesce(cast(number as varchar), 'NULL') as bq_number, 'ARRAY[' || coalesce(cast(number as varchar), 'NULL') || ',NULL,-1]' as bq_array,
               coalesce('''' || replace(text, '''', '''''') || '''', 'CAST(NULL AS VARCHAR)') as trino_text, coalesce('BIGINT ''' || number || '''', 'CAST(NULL AS BIGINT)') as trino_number,
               'ARRAY[' || coalesce('BIGINT ''' || number || '''', 'CAST(NULL AS BIGINT)') || ', BIGINT ''7'']' as trino_array from b""",
    "driver_arguments": f"select c.table_name, cast(c.ordinal_position as integer) as position, c.column_name, t.portable from {_LISTED} c join (values {_TYPE_ROWS}) t(name, portable, postgres, bigquery, trino, from_bigquery, from_trino) on c.data_type = t.name",
}
