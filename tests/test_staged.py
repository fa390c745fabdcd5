"""Copies by way of a store, with servers that only write down what they are told to run."""

import os
import re
from types import SimpleNamespace

import pytest

from tabletide import schema as S
from tabletide.errors import TideError
from tabletide.plans import copy, remote, staged
from tabletide.schema import Column, Schema, Table
from tabletide.sources import locators
from tabletide.sources.arguments import DestinationArguments, IfExists, SourceArguments

SCHEMA = Schema(Table("t", (Column("k", S.INT64, False), Column("v", S.TEXT))))


class Server:
    """A connection that refuses transactions or not, fails at a statement, and does something at others."""

    def __init__(self, transactions=True, fails=None, does=lambda s: None):
        self.ran, self.log, self.transactions, self.fails, self.does = [], [], transactions, fails, does

    def setAutoCommit(self, on):
        if not self.transactions:
            raise RuntimeError("catalog only supports writes using autocommit")

    def createStatement(self):
        return SimpleNamespace(execute=self.execute)

    def execute(self, s):
        self.ran.append(s)
        if self.fails and self.fails in s:
            raise RuntimeError("server says no")
        self.does(s)

    def __getattr__(self, name):
        return lambda: self.log.append(name)


@pytest.fixture
def lake(monkeypatch, tmp_path):
    """s3:// is a local folder."""
    monkeypatch.setattr(locators.S3Locator, "path", property(lambda self: f"{tmp_path}/{self.text[len('s3://') :]}"))
    return tmp_path


def connect(monkeypatch, driver, server):
    monkeypatch.setattr(driver, "connect", lambda self, spark: server)
    return server


def files_below(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, names in os.walk(folder) for f in names if not f.startswith("."))


def unloaded(lake, rows):
    """A server that writes what an UNLOAD or a wrapper table asks for."""

    def does(s):
        if s.startswith("UNLOAD") or "external_location" in s:
            place = re.search(r"s3://([^']+)'", s)[1]
            for i, part in enumerate(rows):
                os.makedirs(f"{lake}/{place}", exist_ok=True)
                with open(f"{lake}/{place}part_{i:02d}", "w") as f:
                    f.write("k,v\n" + part)

    return does


SQL = "CREATE TABLE t (k bigint NOT NULL, v text)"


@pytest.fixture
def put(tmp_path):
    def write(name, text):
        (tmp_path / name).write_text(text)
        return f"{tmp_path}/{name}"

    return write


def test_files_go_to_redshift_through_the_store(spark, lake, put, monkeypatch):
    seen = []

    def does(s):
        if s.startswith("COPY"):
            place = s.split("FROM 's3://", 1)[1].split("'", 1)[0]
            seen.extend(sorted(open(f"{lake}/{place}{f}").read() for f in files_below(f"{lake}/{place}")))

    server = connect(monkeypatch, locators.RedshiftLocator, Server(does=does))
    found = {}
    out = copy.copy(
        spark, f"file:{put('t.csv', 'k,v\n1,a\n2,\"b\nc\"\n')}", "redshift://h/db#s.t", schema=f"postgres-sql:{put('t.sql', SQL)}", if_exists="overwrite",
        to_args=["credentials.iam_role=arn:x"], temporary=["gs://other/", "s3://tmp/in"], metrics=found,
    )
    assert out == ["redshift://h/db#s.t"] and found == {"from": "file:", "to": "redshift:", "streams": 1}
    assert [s.split()[0] for s in server.ran] == ["DROP", "CREATE", "COPY"] and server.log == ["commit", "close"]
    assert seen == ['k,v\n1,a\n2,"b\nc"\n'] and files_below(f"{lake}/tmp") == []


def test_a_load_that_fails_leaves_no_files(spark, lake, put, monkeypatch):
    server = connect(monkeypatch, locators.RedshiftLocator, Server(fails="COPY"))
    with pytest.raises(RuntimeError, match="says no"):
        copy.copy(spark, f"file:{put('t.csv', 'k,v\n1,a\n')}", "redshift://h/db#s.t", schema=f"postgres-sql:{put('t.sql', SQL)}", if_exists="append", to_args=["credentials.iam_role=arn:x"], temporary=["s3://tmp/"])
    assert server.log == ["rollback", "close"] and files_below(f"{lake}/tmp") == []


@pytest.mark.parametrize("source, driver, kinds", [("redshift://h/db#s.t", locators.RedshiftLocator, ["UNLOAD"]), ("trino://h/c/s#t", locators.TrinoLocator, ["CREATE", "INSERT", "DROP"])])
def test_warehouses_are_read_by_many_tasks(spark, lake, put, monkeypatch, source, driver, kinds):
    server = connect(monkeypatch, driver, Server(transactions=driver is locators.RedshiftLocator, does=unloaded(lake, ["1,a\n2,\n", '3,"x\ny"\n', "4,d\n"])))
    copy.copy(spark, source, f"file:{lake}/out.csv", schema=f"postgres-sql:{put('t.sql', SQL)}", where="k > 0", from_args=["credentials.iam_role=arn:x"] if driver is locators.RedshiftLocator else [], temporary=["s3://tmp/"])
    assert [s.split()[0] for s in server.ran] == kinds and any("(k > 0)" in s for s in server.ran)
    assert sorted(open(f"{lake}/out.csv").read().split("\n")) == sorted(["k,v", "1,a", "2,", '3,"x', 'y"', "4,d", ""]) and files_below(f"{lake}/tmp") == []


def test_from_one_warehouse_to_another(spark, lake, put, monkeypatch):
    """Both servers work on the same folder, and no row goes through Spark."""
    redshift = connect(monkeypatch, locators.RedshiftLocator, Server(does=unloaded(lake, ["1,a\n"])))
    trino = connect(monkeypatch, locators.TrinoLocator, Server(transactions=False))
    copy.copy(spark, "redshift://h/db#t", "trino://h/c/s#t", schema=f"postgres-sql:{put('t.sql', SQL)}", from_args=["credentials.iam_role=arn:x"], temporary=["s3://tmp/"])
    place = redshift.ran[0].split("TO '", 1)[1].split("'", 1)[0]
    assert any(place in s for s in trino.ran) and [s.split()[0] for s in trino.ran] == ["CREATE", "CREATE", "INSERT", "DROP"]
    assert files_below(f"{lake}/tmp") == []


def test_plans():
    def plan(source, target, a={}, b={}, schema=SCHEMA, temporary=("s3://tmp/",)):
        found = staged.plan(locators.parse(source), locators.parse(target), schema, SourceArguments(arguments=a), DestinationArguments(arguments=b), temporary)
        return found and (found.unload, found.load)

    keys = {"credentials": {"iam_role": "x"}}
    assert plan("redshift://h/d#t", "file:x.csv", keys) == (True, False) and plan("redshift://h/d#t", "file:x.csv") is None
    assert plan("file:x.csv", "trino://h/c/s#t") == (False, True) and plan("file:x.csv", "trino://h/c/s#t", temporary=["gs://x/"]) is None
    assert plan("trino://h/c/s#t", "redshift://h/d#t", {}, keys) == (True, True) and plan("file:x.csv", "table:t") is None
    odd = Schema(Table("t", (Column("k", S.UUID),)))  # COPY loads no such column from CSV; JDBC does
    assert plan("file:x.csv", "redshift://h/d#t", {}, keys, odd) is None and plan("trino://h/c/s#t", "redshift://h/d#t", {}, keys, odd) == (True, False)


def test_trino_writes_in_no_transaction(spark, lake, monkeypatch):
    """Statements run one by one; if one fails, tables made on the way are dropped, and the error is the first one."""
    server = connect(monkeypatch, locators.TrinoLocator, Server(transactions=False, fails="INSERT"))
    with pytest.raises(RuntimeError, match="says no"):
        remote.transfer(spark, locators.parse("s3://lake/in/"), locators.parse("trino://h/c/s#t"), SCHEMA, SourceArguments(), DestinationArguments(IfExists.parse("upsert-on:k")))
    assert [s.split()[0] for s in server.ran] == ["CREATE", "CREATE", "CREATE", "INSERT", "DROP", "DROP"] and all("IF EXISTS" in s for s in server.ran[-2:]) and server.log == ["close"]


@pytest.mark.parametrize("fails", [None, "UNLOAD"])
def test_an_overwritten_folder_stays_until_the_new_one_is_whole(spark, lake, monkeypatch, fails):
    connect(monkeypatch, locators.RedshiftLocator, Server(fails=fails, does=unloaded(lake, ["9,z\n"])))
    os.makedirs(f"{lake}/lake/out/deep")
    for name in ("a.csv", "deep/b.csv"):
        (lake / "lake/out" / name).write_text("k,v\n1,old\n")
    run = lambda: remote.transfer(spark, locators.parse("redshift://h/d#t"), locators.parse("s3://lake/out/"), SCHEMA, SourceArguments(arguments={"credentials": {"iam_role": "x"}}), DestinationArguments(IfExists("overwrite")))
    if fails:
        with pytest.raises(RuntimeError):
            run()
        assert files_below(f"{lake}/lake/out") == ["a.csv", "deep/b.csv"]
    else:
        assert run() == ["s3://lake/out/"]
        [name] = files_below(f"{lake}/lake/out")
        assert (lake / "lake/out" / name).read_text() == "k,v\n9,z\n"


def test_one_relation_for_all_parts():
    """PostgreSQL's parts are conditions of one relation, on the table's own column."""
    seen = {}

    class Reader:
        def jdbc(self, url, table, predicates, properties):
            seen.update(url=url, table=table, predicates=predicates, properties=properties)
            return SimpleNamespace(drop=lambda name: name)

    at = locators.parse("postgres://me:pw@h/d#s.t")
    assert at.cells(SimpleNamespace(read=Reader()), SCHEMA, SourceArguments("v <> ''"), at.page_ranges(70_000)) == "tide_part"
    assert seen["table"] == """(SELECT "k", "v", ctid AS "tide_part" FROM "s"."t" WHERE (v <> '')) AS parts"""
    assert seen["predicates"][0] == "\"tide_part\" < '(32768,0)'::tid" and len(seen["predicates"]) == 3 and seen["properties"]["user"] == "me"
    a = SourceArguments(arguments={"partition": {"column": "k", "lower": "0", "upper": "9", "count": "2"}})
    at.cells(SimpleNamespace(read=Reader()), SCHEMA, a, at.partitions(None, a))
    assert seen["predicates"] == ['"tide_part" < 5 OR "tide_part" IS NULL', '"tide_part" >= 5']
    with pytest.raises(TideError):
        locators.parse("postgres://h/d")


def test_bigquery_merges_a_table_beside(spark, monkeypatch):
    """New rows are loaded, merged by the server, and their table goes, also if the merge fails."""
    at, wrote = locators.parse("bigquery:p:d.t"), []

    class Writer:
        def format(self, kind):
            return self

        def options(self, **options):
            self.table = options["table"]
            return self

        def mode(self, mode):
            self.how = mode
            return self

        def save(self):
            wrote.append((self.table, self.how))

    frame = type(spark.createDataFrame([(1, "a")], "k long, v string"))
    monkeypatch.setattr(frame, "write", property(lambda self: Writer()))
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    for fails in (None, "MERGE"):
        server = connect(monkeypatch, locators.BigQueryLocator, Server(fails=fails))
        if fails:
            with pytest.raises(RuntimeError):
                at.write(df, SCHEMA, DestinationArguments(IfExists("upsert", ("k",))))
        else:
            assert at.write(df, SCHEMA, DestinationArguments(IfExists("upsert", ("k",)))) == ["bigquery:p:d.t"]
        table, how = wrote.pop()
        beside = table.replace(":", ".")
        assert how == "errorifexists" and server.ran == [
            f"MERGE INTO `p.d.t` AS old USING `{beside}` AS new ON old.`k` = new.`k` WHEN MATCHED THEN UPDATE SET `v` = new.`v` WHEN NOT MATCHED THEN INSERT (`k`, `v`) VALUES (new.`k`, new.`v`)", f"DROP TABLE IF EXISTS `{beside}`"
        ]
    for mode, how in (("error", "errorifexists"), ("append", "append"), ("overwrite", "overwrite")):
        at.write(df, SCHEMA, DestinationArguments(IfExists(mode)))
        assert wrote.pop() == ("p:d.t", how)
    with pytest.raises(TideError, match="REQUIRED"):
        at.write(df, Schema(Table("t", (Column("k", S.INT64), Column("v", S.TEXT)))), DestinationArguments(IfExists("upsert", ("k",))))


def test_the_session_keeps_its_settings(spark, put, tmp_path):
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    session.conf.set("spark.sql.ansi.enabled", "false")
    copy.copy(session, f"file:{put('t.csv', 'k,v')}", f"file:{tmp_path}/o.csv", schema=f"postgres-sql:{put('t.sql', SQL)}")
    with pytest.raises(TideError):
        copy.copy(session, f"file:{tmp_path}/none.csv", f"file:{tmp_path}/o2.csv", schema=f"postgres-sql:{put('t.sql', SQL)}")
    assert copy.count(session, f"file:{put('u.csv', 'k,v')}", schema=f"postgres-sql:{put('t.sql', SQL)}") == 0
    assert session.conf.get("spark.sql.session.timeZone") == "Europe/Berlin" and session.conf.get("spark.sql.ansi.enabled") == "false"
