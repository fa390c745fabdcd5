"""Transfers between servers, by the statements that they would run."""

import pytest

from tabletide import schema as S
from tabletide.errors import TideError
from tabletide.plans import remote
from tabletide.schema import Column, Schema, Table
from tabletide.sources import files, locators
from tabletide.sources.arguments import DestinationArguments, IfExists, SourceArguments
from tabletide.sources.storage import Files
from tabletide.streaming.tables import append_once

SCHEMA = Schema(Table("t", (Column("k", S.INT64, False), Column("at", S.TIMESTAMP), Column("ok", S.BOOL))))
NESTED = Schema(Table("t", (Column("k", S.UUID, False), Column("j", S.JSON), Column("xs", S.Array(S.INT16)))))
KEYS = {"credentials": {"iam_role": "arn:x"}}


@pytest.fixture
def ran(monkeypatch):
    """What databases were told to run."""
    out = []
    for driver in (locators.RedshiftLocator, locators.TrinoLocator):
        monkeypatch.setattr(driver, "execute", lambda self, spark, statements: out.append(statements))
    return out


def run(source, target, schema=SCHEMA, a=SourceArguments(arguments=KEYS), b=DestinationArguments(IfExists("append"), None, KEYS)):
    return remote.transfer(None, locators.parse(source), locators.parse(target), schema, a, b)


def test_redshift_unloads(ran):
    assert run("redshift://h/db#s.t", "s3://lake/out/", a=SourceArguments("k > 1", None, KEYS)) == ["s3://lake/out/"]
    [[statement]] = ran
    assert statement.startswith("UNLOAD ('SELECT \"k\"") and "WHERE (k > 1)" in statement and "TO 's3://lake/out/'" in statement and "iam_role 'arn:x'" in statement
    with pytest.raises(TideError, match="credentials"):
        run("redshift://h/db#t", "s3://lake/out/", a=SourceArguments())
    with pytest.raises(TideError, match="has to end in /"):
        run("redshift://h/db#t", "s3://lake/out")


@pytest.mark.parametrize("policy, kinds", [("append", ["CREATE TABLE IF", "COPY"]), ("error", ["CREATE TABLE \"", "COPY"]), ("overwrite", ["DROP TABLE", "CREATE TABLE \"", "COPY"]), ("upsert-on:k", ["CREATE TABLE IF", "CREATE TEMP", "COPY", "UPDATE", "DELETE", "INSERT", "DROP"])])
def test_redshift_loads(ran, policy, kinds):
    run("s3://lake/in/", "redshift://h/db#s.t", b=DestinationArguments(IfExists.parse(policy), None, KEYS))
    [statements] = ran
    assert len(statements) == len(kinds) and all(s.startswith(k) for s, k in zip(statements, kinds))


def test_trino_reads_and_writes_through_a_table_of_texts(ran):
    run("trino://h/c/s#t", "s3://lake/out/", NESTED, a=SourceArguments("k is not null"))
    run("s3://lake/in/", "trino://h/c/s#t", NESTED, b=DestinationArguments(IfExists.parse("upsert-on:k")))
    out, back = ran
    assert [x.split()[0] for x in out] == ["CREATE", "INSERT", "DROP"] and "skip_header_line_count" in out[0] and "WHERE (k is not null)" in out[1]
    assert 'JSON_FORMAT(JSON_PARSE("j"))' in out[1] and 'CAST(CAST("k" AS UUID) AS VARCHAR)' in out[1]
    assert [x.split()[0] for x in back] == ["CREATE", "CREATE", "CREATE", "INSERT", "MERGE", "DROP", "DROP"]
    assert 'JSON_FORMAT(JSON_PARSE(NULLIF("j", \'\')))' in back[3] and 'ON CAST(dest."k" AS UUID) = CAST(src."k" AS UUID)' in back[4]
    assert run("s3://lake/in/", "trino://h/c/s#t", a=SourceArguments("k = 1")) is None and run("s3://a/", "gs://b/") is None
    with pytest.raises(TideError, match="merged"):
        run("s3://lake/in/", "trino://h/c/s#t", NESTED, b=DestinationArguments(IfExists.parse("upsert-on:k"), None, {"connector": "memory"}))


def test_parts_of_a_table():
    """Every row is in one part."""
    ranges = locators.PostgresLocator.page_ranges
    assert ranges(0) == ranges(32_768) == []
    assert ranges(70_000) == ["ctid < '(32768,0)'::tid", "ctid >= '(32768,0)'::tid AND ctid < '(65536,0)'::tid", "ctid >= '(65536,0)'::tid"]
    assert len(ranges(10**9)) <= 512
    parts = locators.parse("redshift://h/d#t").partitions(None, SourceArguments(arguments={"partition": {"column": "k", "lower": "0", "upper": "9", "count": "3"}}))
    assert parts == ['"k" < 4 OR "k" IS NULL', '"k" >= 4 AND "k" < 8', '"k" >= 8']


def test_a_failed_overwrite_leaves_what_was_there(spark, tmp_path):
    at = tmp_path / "out"
    at.mkdir()
    (at / "a.csv").write_text("old")
    with pytest.raises(Exception):
        Files(spark, str(at)).replace([(str(tmp_path / "none"), str(at / "b.csv"))])
    assert (at / "a.csv").read_text() == "old" and [x.name for x in tmp_path.iterdir()] == ["out"]


def test_a_batch_that_comes_again(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS again_test")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    df.limit(0).write.saveAsTable("again_test")
    for _ in range(2):
        append_once(spark, df, "again_test", "stream-x-000000001")
    append_once(spark, df, "again_test", "stream-x-000000002")
    assert sorted(r.k for r in spark.table("again_test").collect()) == [1, 1, 2, 2]


def test_other_objects_in_a_folder(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k\n1\n")
    (tmp_path / "README.txt").write_text("no table")
    schema = Schema(Table("t", (Column("k", S.INT64),)))
    assert [r.k for r in files.scan(spark, f"{tmp_path}/", schema, "csv", pattern="*.csv").collect()] == [1]
    with pytest.raises(TideError, match="several extensions"):
        files.scan(spark, f"{tmp_path}/", schema)


def test_a_header_of_many_lines(spark, tmp_path):
    name = "a\n" * 200
    (tmp_path / "h.csv").write_text(f'"{name}",b\n1,2\n')
    assert files.header(spark, f"{tmp_path}/h.csv") == [name, "b"]
