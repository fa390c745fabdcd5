"""Locators: strings that name data or schemas, and the drivers behind them."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from typing import ClassVar
from urllib.parse import quote, unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..dialects import bigquery, postgres, redshift, trino, typescript
from ..errors import TideError
from ..operators import merge, rows
from ..schema import Schema
from . import files, rewrite
from ..session import shared_folder
from .arguments import DestinationArguments, Features, IfExists, SourceArguments
from .storage import Files

_ALL = frozenset(("error", "append", "overwrite", "upsert"))
_SCHEMA_MODES = frozenset(("error", "overwrite"))


def hidden_password(url: str) -> str:
    """A URL for display."""
    return re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*://[^:/?#@]*):[^/?#@]*@", r"\1:XXXXXX@", url)


@dataclass(frozen=True)
class Locator:
    """What a driver's locators can do; what one can't is an error."""

    text: str
    scheme: ClassVar[str] = ""
    features: ClassVar[Features] = Features()

    def __str__(self) -> str:
        return hidden_password(self.text)

    @property
    def body(self) -> str:
        return self.text[len(self.scheme) :]

    def _no(self, what: str) -> TideError:
        return TideError(f"cannot {what} {self}")

    def schema(self, spark: SparkSession, a: SourceArguments) -> Schema | None:
        return None

    def write_schema(self, spark: SparkSession, schema: Schema, if_exists: IfExists) -> None:
        raise self._no("write a schema to")

    def read(self, spark: SparkSession, schema: Schema, a: SourceArguments) -> DataFrame:
        """Typed rows."""
        raise self._no("read")

    def count(self, spark: SparkSession, schema: Schema, a: SourceArguments) -> int:
        return rows.counted(self.read(spark, schema, a).select(*[rows.named(c.name) for c in schema.table.columns])).first()[0]

    def write(self, df: DataFrame, schema: Schema, a: DestinationArguments, stream_size: int | None = None) -> list[str]:
        """Writes typed rows; the locators of what was written."""
        raise self._no("write")

    def table_name(self) -> str:
        return "data"


# Files


@dataclass(frozen=True)
class FileLocator(Locator):
    scheme = "file:"
    features = Features(schema=True, read=True, write=True, count=True, source=frozenset(("--from-format", "--from-arg", "--where")), destination=frozenset(("--to-format",)), if_exists=_SCHEMA_MODES)

    @property
    def path(self) -> str:
        return self.body

    def table_name(self) -> str:
        return self.path.rstrip("/").rsplit("/", 1)[-1].split(".", 1)[0] or "data"

    def _check_input(self, a: SourceArguments) -> str | None:
        return a.format

    def schema(self, spark, a):
        if self.path == "-":
            raise TideError("standard input tells no schema")
        return files.header_schema(spark, self.path)

    def read(self, spark, schema, a):
        path = self.path
        if path == "-":
            path = spool(spark, a.format)
        kind = self._check_input(a)
        one_line = a.arguments.get("one_line") == "true"
        return rows.where(files.scan(spark, path, schema, kind, one_line), a.where)

    def write(self, df, schema, a, stream_size=None):
        if self.path == "-":
            files.print_rows(df, schema, files.format_of("", a.format))
            return []
        if self.path.endswith("/") or Files(df.sparkSession, self.path).is_folder():
            out = files.write_folder(df, schema, self.path, files.format_of("", a.format), a.if_exists, self.table_name(), stream_size)
            return [f"{self.scheme}{p}" for p in out]
        kind = files.format_of(files.extension(self.path), a.format)
        return [f"{self.scheme}{p}" for p in files.write_file(df, schema, self.path, kind, a.if_exists)]


def spool(spark: SparkSession, kind: str | None) -> str:
    """Standard input as a file in the shared checkpoint folder, for executors to read; a megabyte is held at a time."""
    import sys

    path = f"{shared_folder(spark)}/{uuid.uuid4().hex[:10]}/data.{files.format_of('', kind)}"
    blocks = iter(lambda: sys.stdin.read(1 << 20).encode("utf-8"), b"")
    Files(spark, path).write_blocks(blocks, False)
    return path


@dataclass(frozen=True)
class CsvLocator(FileLocator):
    """The older name of files that are CSV."""

    scheme = "csv:"
    features = Features(schema=True, read=True, write=True, count=True, source=frozenset(("--from-arg", "--where")), if_exists=_SCHEMA_MODES)

    def _check_input(self, a):
        return "csv"

    def schema(self, spark, a):
        if self.path == "-" or files.extension(self.path) != "csv":
            raise TideError(f"{self} needs the extension .csv to tell its schema")
        return super().schema(spark, a)


@dataclass(frozen=True)
class BucketLocator(FileLocator):
    """A folder in an object store, or one CSV object."""

    features = Features(read=True, write=True, count=True, source=frozenset(("--where", "--from-format")), if_exists=frozenset(("overwrite",)))
    spark_scheme: ClassVar[str] = ""
    single_files: ClassVar[bool] = False

    @property
    def path(self) -> str:
        return self.spark_scheme + self.body

    def schema(self, spark, a):
        return None

    def write(self, df, schema, a, stream_size=None):
        if not self.path.endswith("/") and not (self.single_files and files.extension(self.path) == "csv"):
            raise TideError(f"{self} has to end in / to be written to")
        out = super().write(df, schema, a, stream_size)
        return [self.scheme + x[len(self.scheme) + len(self.spark_scheme) :] if x.startswith(self.scheme + self.spark_scheme) else x for x in out]


@dataclass(frozen=True)
class S3Locator(BucketLocator):
    scheme = "s3:"
    spark_scheme = "s3a:"


@dataclass(frozen=True)
class GsLocator(BucketLocator):
    scheme = "gs:"
    spark_scheme = "gs:"
    single_files = True

    def read(self, spark, schema, a):
        """The object itself, or all *.csv below the folder; other objects in it are no part of the table."""
        if not self.path.endswith("/"):
            return super().read(spark, schema, a)
        kind = a.format or "csv"
        return rows.where(files.scan(spark, self.path, schema, kind, pattern=f"*.{kind}"), a.where)


# Schemas


@dataclass(frozen=True)
class SchemaFile(Locator):
    """A schema in a file, in some dialect."""

    def _parse(self, text: str) -> Schema:
        raise NotImplementedError

    def _render(self, schema: Schema) -> str:
        raise self._no("write a schema to")

    def _path(self) -> str:
        return self.body

    def schema(self, spark, a):
        if self._path() == "-":
            import sys

            return self._parse(sys.stdin.read())
        return self._parse(Files(spark, self._path()).read())

    def write_schema(self, spark, schema, if_exists):
        text = self._render(schema)
        if self._path() == "-":
            print(text, end="")
        elif if_exists.mode not in _SCHEMA_MODES:
            raise TideError(f"{self.scheme} does not support --if-exists={if_exists}")
        else:
            Files(spark, self._path()).write(text, if_exists.mode == "overwrite")


@dataclass(frozen=True)
class PortableSchema(SchemaFile):
    scheme = "portable-schema:"
    features = Features(schema=True, write_schema=_SCHEMA_MODES)

    def _parse(self, text):
        return S.schema_from_json(text)

    def _render(self, schema):
        return S.schema_to_json(schema)


@dataclass(frozen=True)
class PostgresSql(SchemaFile):
    scheme = "postgres-sql:"
    features = Features(schema=True, write_schema=_SCHEMA_MODES)

    def _parse(self, text):
        return postgres.parse(text, self.body)

    def _render(self, schema):
        return postgres.render(schema, postgres.table_name_for(schema.table.name))


@dataclass(frozen=True)
class BigQuerySchema(SchemaFile):
    scheme = "bigquery-schema:"
    features = Features(schema=True, write_schema=_SCHEMA_MODES)

    def _parse(self, text):
        return bigquery.parse(text)

    def _render(self, schema):
        return bigquery.render(schema)


@dataclass(frozen=True)
class TrinoSql(SchemaFile):
    scheme = "trino-sql:"
    features = Features(schema=True, write_schema=_SCHEMA_MODES, unstable=True)

    def _parse(self, text):
        return trino.parse(text, self.body)

    def _render(self, schema):
        return trino.render(schema)


@dataclass(frozen=True)
class PortableTs(SchemaFile):
    """`path#Interface`; % and # in either are written %25 and %23."""

    scheme = "portable-ts:"
    features = Features(schema=True, unstable=True)

    def __post_init__(self) -> None:
        if "#" not in self.body:
            raise TideError(f"expected '#' in {self.text!r}")

    def _path(self):
        return unquote(self.body.split("#", 1)[0])

    def _parse(self, text):
        return typescript.parse(text, unquote(self.body.split("#", 1)[1]), self._path())

    @classmethod
    def of(cls, path: str, interface: str) -> PortableTs:
        return cls(f"{cls.scheme}{quote(path, safe='/ ')}#{quote(interface)}")


# Tables


@dataclass(frozen=True)
class TableLocator(Locator):
    """A table of Spark's catalog, or its files, which any other engine on the same store can read."""

    scheme = "table:"
    features = Features(schema=True, count=True, read=True, write=True, source=frozenset(("--where",)), if_exists=_ALL)

    def table_name(self):
        return self.body.rsplit(".", 1)[-1]

    def schema(self, spark, a):
        return S.from_spark(self.table_name(), spark.table(self.body).schema)

    def read(self, spark, schema, a):
        return rows.project(rows.where(spark.table(self.body), a.where), [c.name for c in schema.table.columns])

    def write(self, df, schema, a, stream_size=None):
        spark, mode = df.sparkSession, a.if_exists.mode
        data = rows.not_null(schema, df.drop("__stream"))
        if not spark.catalog.tableExists(self.body) or mode == "overwrite":
            if mode == "upsert":
                for k in a.if_exists.keys:
                    if schema.table.column(k).is_nullable:
                        raise TideError(f"the upsert key {k!r} has to be NOT NULL")
            data.write.mode("overwrite" if mode == "overwrite" else "errorifexists").saveAsTable(self.body)
            return [self.text]
        if mode == "error":
            raise TideError(f"{self} exists")
        there = S.from_spark(self.table_name(), spark.table(self.body).schema)
        aligned = rows.align_schema(there, schema)
        for c, own in zip(aligned.table.columns, schema.table.columns):
            rows.align_type(aligned, c.data_type, schema, own.data_type, f"column {c.name!r}")
        if {c.name for c in there.table.columns} != {c.name for c in schema.table.columns}:
            raise TideError(f"{self} has the columns {[c.name for c in there.table.columns]}, not {[c.name for c in schema.table.columns]}")
        data = rows.project(data, [c.name for c in there.table.columns])
        if mode == "append":
            data.write.mode("append").insertInto(self.body)
            return [self.text]
        self._upsert(spark, data, list(a.if_exists.keys))
        return [self.text]

    def _upsert(self, spark: SparkSession, data: DataFrame, keys: list[str]) -> None:
        """Rewrites the files that hold a key, where the table's files can be replaced one by one, see rewrite.

        Of other tables the merged rows become a new table, which gets the old one's name once it is whole: a plan cannot overwrite
        what it reads.  If it cannot get the name, the old one gets it back.
        """
        there = spark.table(self.body)
        for k in keys:
            if k not in there.columns:
                raise TideError(f"the upsert key {k!r} is no column of {self}")
        if (place := rewrite.place_of(spark, self.body)) is not None:
            rewrite.upsert(place, data, keys)
            return
        tag = uuid.uuid4().hex[:10]
        merge.upsert(there, data, keys).write.saveAsTable(f"{self.body}_{tag}")
        spark.sql(f"ALTER TABLE {self.body} RENAME TO {self.body}_{tag}_old")
        try:
            spark.sql(f"ALTER TABLE {self.body}_{tag} RENAME TO {self.body}")
        except Exception:
            spark.sql(f"ALTER TABLE {self.body}_{tag}_old RENAME TO {self.body}")
            raise
        spark.sql(f"DROP TABLE {self.body}_{tag}_old")


@dataclass(frozen=True)
class InlineLocator(TableLocator):
    """A small relation held as values behind a temporary view; one of over 128 KiB becomes a table."""

    scheme = "inline:"
    features = Features(schema=True, count=True, read=True, write=True, source=frozenset(("--where",)), if_exists=_SCHEMA_MODES)
    #: Fixed value: bytes of CSV.
    LIMIT: ClassVar[int] = 128 << 10

    def write(self, df, schema, a, stream_size=None):
        spark, name = df.sparkSession, self.body.replace(".", "_").replace(":", "_")
        if spark.catalog.tableExists(name) and a.if_exists.mode == "error":
            raise TideError(f"{self} exists")
        data = rows.not_null(schema, df.drop("__stream"))
        text = rows.encoded(data, schema)
        from ..operators.shape import row_bytes

        size = text.agg(F.coalesce(F.sum(row_bytes(text)), F.lit(0))).first()[0]
        if size > self.LIMIT:
            return TableLocator(f"table:{name}").write(df, schema, a)
        spark.catalog.dropTempView(name)
        spark.createDataFrame(data.collect(), S.spark_schema(schema)).createOrReplaceTempView(name)
        return [self.text]

    def schema(self, spark, a):
        return S.from_spark(self.table_name(), spark.table(self.body.replace(".", "_").replace(":", "_")).schema)

    def read(self, spark, schema, a):
        return rows.project(rows.where(spark.table(self.body.replace(".", "_").replace(":", "_")), a.where), [c.name for c in schema.table.columns])


# Databases.  They need servers and their connectors; what is here builds the options and the statements.


@dataclass(frozen=True)
class Database(Locator):
    """scheme://user@host/database#table"""

    driver: ClassVar[str] = ""
    jdbc: ClassVar[str] = ""

    def __post_init__(self) -> None:
        if "#" not in self.text:
            raise TideError(f"{self} needs a table after '#'")

    def table_name(self):
        return self.text.split("#", 1)[1]

    def options(self) -> dict[str, str]:
        url = urlsplit(self.text.split("#", 1)[0])
        port = f":{url.port}" if url.port else ""
        out = {"url": f"jdbc:{self.jdbc}://{url.hostname or 'localhost'}{port}{url.path}", "driver": self.driver}
        if url.username:
            out["user"] = unquote(url.username)
        if url.password:
            out["password"] = unquote(url.password)
        return out

    def _catalog(self, spark: SparkSession, query: str) -> list:
        return [tuple(r) for r in spark.read.format("jdbc").options(**self.options(), query=query).load().collect()]

    def schema(self, spark, a):
        return postgres.from_catalog(self.table_name(), self._catalog(spark, postgres.catalog_query(self.table_name())))

    def select(self, schema: Schema, a: SourceArguments, *more: str) -> str:
        return postgres.export_select(schema, self.table_name(), a.where, *more)

    def read_options(self, schema: Schema, a: SourceArguments) -> dict[str, str]:
        return self.options() | {"query": self.select(schema, a), "fetchsize": "10000"}

    def part_key(self, a: SourceArguments) -> str:
        """What the conditions of partitions() are on."""
        return postgres.quote(a.arguments["partition"]["column"])

    def partitions(self, spark: SparkSession, a: SourceArguments) -> list[str]:
        """Conditions that cut the table in parts, for a task each.

        Arguments partition.column, partition.lower, partition.upper and partition.count cut by ranges of a whole-number column; its nulls
        go with the first part.
        """
        given = a.arguments.get("partition")
        if not given:
            return []
        low, high, n = int(given["lower"]), int(given["upper"]), int(given["count"])
        name, step = postgres.quote(given["column"]), max(1, -(-(high - low + 1) // n))
        cuts = list(range(low + step, high + 1, step))
        if not cuts:
            return []
        inner = [f"{name} >= {x} AND {name} < {y}" for x, y in zip(cuts, cuts[1:])]
        return [f"{name} < {cuts[0]} OR {name} IS NULL", *inner, f"{name} >= {cuts[-1]}"]

    def read(self, spark, schema, a):
        cells = self.cells(spark, schema, a, self.partitions(spark, a))
        texts = rows.rename_header(cells, [c.name for c in schema.table.columns])
        return rows.decoded(texts.select([rows.named(c).cast("string").alias(c) for c in texts.columns]), schema)

    def cells(self, spark: SparkSession, schema: Schema, a: SourceArguments, parts: list[str]) -> DataFrame:
        """One relation, read by a task for each of the parts; each sees the table at its own time, if that changes meanwhile."""
        options = self.read_options(schema, a)
        if len(parts) < 2:
            return spark.read.format("jdbc").options(**options).load()
        key, name = self.part_key(a), postgres.quote("tide_part")
        inner = self.select(schema, a, f"{key} AS {name}")
        properties = {k: v for k, v in options.items() if k not in ("url", "query")}
        return spark.read.jdbc(options["url"], f"({inner}) AS parts", predicates=[p.replace(key, name) for p in parts], properties=properties).drop("tide_part")

    def count_statement(self, a: SourceArguments) -> str:
        return postgres.count_select(self.table_name(), a.where)

    def count(self, spark, schema, a):
        return spark.read.format("jdbc").options(**self.options(), query=self.count_statement(a)).load().first()[0]

    def write_options(self, a: DestinationArguments) -> dict[str, str]:
        return self.options() | {"dbtable": self.table_name(), "batchsize": "10000"} | ({"truncate": "true"} if a.if_exists.mode == "overwrite" else {})

    def upsert(self, schema: Schema, source: str, keys: list[str]) -> list[str]:
        return [postgres.upsert_statement(schema, source, self.table_name(), keys)]

    def write(self, df, schema, a, stream_size=None):
        mode = a.if_exists.mode
        writer = rows.not_null(schema, df.drop("__stream")).write.format("jdbc")
        if mode != "upsert":
            writer.options(**self.write_options(a)).mode({"error": "errorifexists"}.get(mode, mode)).save()
            return [self.text]
        staged = f"{self.table_name()}_{uuid.uuid4().hex[:10]}"
        writer.options(**self.write_options(a) | {"dbtable": staged}).mode("errorifexists").save()
        self.execute(df.sparkSession, [*self.upsert(schema, staged, list(a.if_exists.keys)), f"DROP TABLE IF EXISTS {staged}"])
        return [self.text]

    def connect(self, spark: SparkSession):
        options, manager = self.options(), spark._jvm.java.sql.DriverManager
        return manager.getConnection(options["url"], options.get("user"), options.get("password"))

    def execute(self, spark: SparkSession, statements: list[str]) -> None:
        """Runs statements in one transaction; none has an effect if one fails."""
        connection = self.connect(spark)
        try:
            connection.setAutoCommit(False)
            try:
                for s in statements:
                    connection.createStatement().execute(s)
            except BaseException:
                connection.rollback()
                raise
            connection.commit()
        finally:
            connection.close()


@dataclass(frozen=True)
class PostgresLocator(Database):
    scheme = "postgres:"
    driver, jdbc = "org.postgresql.Driver", "postgresql"
    features = Features(schema=True, count=True, read=True, write=True, source=frozenset(("--where", "--from-arg")), if_exists=_ALL)
    #: Pages of the table for a task, and tasks at most.
    PAGES: ClassVar[int] = 32_768
    PARTS: ClassVar[int] = 512

    def pages(self, spark: SparkSession) -> int:
        schema, _, name = self.table_name().rpartition(".")
        found = self._catalog(spark, f"SELECT c.relpages FROM pg_class c JOIN pg_namespace n ON n.oid = c.relnamespace WHERE c.relname = {postgres.quote_text(name)} AND n.nspname = {postgres.quote_text(schema or 'public')} AND c.relkind = 'r'")
        return int(found[0][0]) if found else 0

    def partitions(self, spark, a):
        """Ranges of pages by ctid, which need no key; a table that has grown since has the rest in the last part."""
        if a.arguments.get("partition"):
            return super().partitions(spark, a)
        return self.page_ranges(self.pages(spark))

    def part_key(self, a):
        return super().part_key(a) if a.arguments.get("partition") else "ctid"

    @classmethod
    def page_ranges(cls, pages: int) -> list[str]:
        step = max(cls.PAGES, -(-pages // cls.PARTS))
        cuts = [f"'({x},0)'::tid" for x in range(step, pages, step)]
        if not cuts:
            return []
        return [f"ctid < {cuts[0]}", *(f"ctid >= {x} AND ctid < {y}" for x, y in zip(cuts, cuts[1:])), f"ctid >= {cuts[-1]}"]


@dataclass(frozen=True)
class RedshiftLocator(Database):
    scheme = "redshift:"
    driver, jdbc = "com.amazon.redshift.Driver", "redshift"
    features = Features(schema=True, read=True, write=True, source=frozenset(("--where", "--from-arg")), destination=frozenset(("--to-arg",)), if_exists=_ALL)

    def upsert(self, schema, source, keys):
        redshift.check_loadable(schema)
        return redshift.upsert_statements(schema, source, self.table_name(), keys)[:-1]


@dataclass(frozen=True)
class TrinoLocator(Database):
    scheme = "trino:"
    driver, jdbc = "io.trino.jdbc.TrinoDriver", "trino"
    features = Features(schema=True, write_schema=_SCHEMA_MODES, count=True, read=True, write=True, source=frozenset(("--where", "--from-arg")), destination=frozenset(("--to-arg",)), if_exists=_ALL, unstable=True)

    def schema(self, spark, a):
        return trino.from_catalog(self.table_name(), self._catalog(spark, trino.catalog_query(self.table_name())))

    def execute(self, spark, statements):
        """Runs statements one by one, as its connectors write in no transaction; if one fails, tables that later ones would drop are dropped."""
        connection, done = self.connect(spark), 0
        try:
            for s in statements:
                connection.createStatement().execute(s)
                done += 1
        except BaseException:
            for s in statements[done + 1 :]:
                if s.startswith("DROP TABLE "):
                    try:
                        connection.createStatement().execute(s.replace("DROP TABLE ", "DROP TABLE IF EXISTS ", 1))
                    except Exception:  # what failed first is told
                        pass
            raise
        finally:
            connection.close()

    def profile(self, arguments: dict) -> str:
        """How the catalog stores tables: hive, unless an argument connector=... says another."""
        return arguments.get("connector", "hive")

    def select(self, schema, a, *more):
        from ..plans.storage import loaded_sql

        columns = [(trino.quote(trino.identifier(c.name)), trino.from_portable(schema, c.data_type)) for c in schema.table.columns]
        cells = [x if (e := trino.export_expression(t, loaded_sql(self.profile(a.arguments), t, x))) == x else f"{e} AS {x}" for x, t in columns]
        return f"SELECT {', '.join([*cells, *more])} FROM {trino.quote_table(self.table_name())}" + (f" WHERE ({a.where})" if a.where else "")

    def write(self, df, schema, a, stream_size=None):
        """Creates the table as its storage can have it, and appends stored values; an upsert merges a table of the new rows."""
        from ..plans import storage
        from ..plans.remote import key_loader

        mode, profile, name = a.if_exists.mode, self.profile(a.arguments), self.table_name()
        made = trino.create_table(schema, name, or_replace=mode == "overwrite", if_not_exists=mode in ("append", "upsert"))
        first, made = storage.storage_table(profile, made, merge=mode == "upsert")
        staged, last = name, []
        if mode == "upsert":
            staged = f"{name}_{uuid.uuid4().hex[:10]}"
            _, beside = storage.storage_table(profile, trino.create_table(schema, staged))
            first = [*first, str(made), str(beside)]
            last = [trino.merge_statement(schema, staged, name, list(a.if_exists.keys), key_loader(schema, profile)), f"DROP TABLE {trino.quote_table(staged)}"]
        else:
            first = [*first, str(made)]
        self.execute(df.sparkSession, first)
        data = rows.not_null(schema, df.drop("__stream"))
        data = data.select([storage.store(profile, trino.from_portable(schema, c.data_type), rows.named(c.name)).alias(trino.identifier(c.name)) for c in schema.table.columns])
        try:
            data.write.format("jdbc").options(**self.write_options(a) | {"dbtable": staged}).mode("append").save()
        except BaseException:
            if last:
                self.execute(df.sparkSession, last[-1:])
            raise
        if last:
            self.execute(df.sparkSession, last)
        return [self.text]

    def count_statement(self, a):
        return f'SELECT COUNT(*) AS "count" FROM {trino.quote_table(self.table_name())}' + (f" WHERE ({a.where})" if a.where else "")

    def write_schema(self, spark, schema, if_exists):
        from ..plans.storage import storage_table

        first, table = storage_table(self.profile({}), trino.create_table(schema, self.table_name(), or_replace=if_exists.mode == "overwrite"))
        self.execute(spark, [*first, str(table)])


@dataclass(frozen=True)
class BigQueryLocator(Locator):
    """project:dataset.table"""

    scheme = "bigquery:"
    #: What the connector calls a load job's dispositions.
    MODES: ClassVar[dict[str, str]] = {"WRITE_EMPTY": "errorifexists", "WRITE_APPEND": "append", "WRITE_TRUNCATE": "overwrite"}
    features = Features(schema=True, count=True, read=True, write=True, source=frozenset(("--where", "--from-arg")), destination=frozenset(("--to-arg",)), if_exists=_ALL)

    def __post_init__(self) -> None:
        if not re.fullmatch(r"[^:.`]+:[^:.`]+\.[^:.`]+", self.body):
            raise TideError(f"{self.text!r} has to be {self.scheme}project:dataset.table")

    def table_name(self):
        return self.body.rsplit(".", 1)[-1]

    def options(self, a: SourceArguments | None = None) -> dict[str, str]:
        return {"table": self.body} | ({"filter": a.where} if a and a.where else {})

    def schema(self, spark, a):
        return S.from_spark(self.table_name(), spark.read.format("bigquery").options(**self.options()).load().schema)

    def read(self, spark, schema, a):
        df = spark.read.format("bigquery").options(**self.options(a)).load()
        return rows.project(df, [c.name for c in schema.table.columns])

    def write(self, df, schema, a, stream_size=None):
        """Rows by the connector's load jobs; an upsert loads a table beside, which the server merges, and which goes in the end, well or not."""
        bigquery.check_names([c.name for c in schema.table.columns])
        data = rows.not_null(schema, df.drop("__stream"))
        if a.if_exists.mode != "upsert":
            data.write.format("bigquery").options(**self.options()).mode(self.MODES[a.if_exists.write_disposition]).save()
            return [self.text]
        staged = f"{self.body}_{uuid.uuid4().hex[:10]}"
        merge_rows = bigquery.merge_statement(schema, staged, self.body, list(a.if_exists.keys))
        try:
            data.write.format("bigquery").options(table=staged).mode("errorifexists").save()
            self.execute(df.sparkSession, [merge_rows])
        finally:
            self.execute(df.sparkSession, [f"DROP TABLE IF EXISTS {bigquery.quote_table(staged)}"])
        return [self.text]

    def connect(self, spark: SparkSession):
        """By BigQuery's JDBC driver, with the credentials of the environment."""
        project = self.body.split(":", 1)[0]
        return spark._jvm.java.sql.DriverManager.getConnection(f"jdbc:bigquery://https://www.googleapis.com/bigquery/v2:443;ProjectId={project};OAuthType=3")

    def execute(self, spark: SparkSession, statements: list[str]) -> None:
        connection = self.connect(spark)
        try:
            for s in statements:
                connection.createStatement().execute(s)
        finally:
            connection.close()


@dataclass(frozen=True)
class ShopifyLocator(Locator):
    """A REST address whose answers come in pages."""

    scheme = "shopify:"
    features = Features(read=True, source=frozenset(("--from-arg",)), unstable=True)

    def read(self, spark, schema, a):
        from .rest import read_pages

        return read_pages(spark, "https:" + self.body, schema, a.arguments)


DRIVERS: dict[str, type[Locator]] = {
    d.scheme: d
    for d in (
        BigQueryLocator, BigQuerySchema, CsvLocator, FileLocator, GsLocator, InlineLocator, PortableSchema, PortableTs, PostgresLocator, PostgresSql, RedshiftLocator, S3Locator, ShopifyLocator, TableLocator,
        TrinoLocator, TrinoSql,
    )
}
#: Fixed value: the older name of inline relations.
DRIVERS["bigquery-test-fixture:"] = type("FixtureLocator", (InlineLocator,), {"scheme": "bigquery-test-fixture:", "__doc__": InlineLocator.__doc__})


def parse(text: str, unstable: bool = True) -> Locator:
    m = re.match(r"[A-Za-z][-A-Za-z0-9+.]*:", text)
    if m is None:
        raise TideError(f"{text!r} has no scheme")
    if "\n" in text:
        raise TideError("a locator cannot hold a line break")
    driver = DRIVERS.get(m[0])
    if driver is None:
        raise TideError(f"there is no driver for {m[0]}")
    if driver.features.unstable and not unstable:
        raise TideError(f"the driver for {m[0]} is unstable; allow it with --enable-unstable")
    return driver(text)


def describe(scheme: str | None = None) -> str:
    """What a driver can do, or which there are."""
    if scheme is None:
        return "".join(f"- {s.rstrip(':')}{' (UNSTABLE)' if d.features.unstable else ''}\n" for s, d in sorted(DRIVERS.items()))
    driver = DRIVERS.get(scheme.rstrip(":") + ":")
    if driver is None:
        raise TideError(f"there is no driver {scheme!r}")
    return f"{scheme.rstrip(':')} features:\n{driver.features.describe()}"
