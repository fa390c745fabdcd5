"""Copies between files and tables, policies, counting, schema conversion, the command line, streams."""

import json
import os

import pytest

from tabletide import cli, schema as S
from tabletide.config import Config, find_temporary
from tabletide.errors import TideError
from tabletide.operators import merge, rows, shape
from tabletide.plans import copy
from tabletide.schema import Column, Schema, Table
from tabletide.sources import arguments, files, locators, rest
from tabletide.sources.arguments import IfExists
from tabletide.sources.storage import Files
from tabletide.streaming.tables import arriving, keep_copied


@pytest.fixture
def put(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
        return str(path)

    return write


@pytest.fixture
def sql(spark):
    copy.prepare(spark)
    return spark


def got(path):
    """A file's header and its other lines in order."""
    with open(path) as f:
        head, *lines = f.read().splitlines()
    return [head, *sorted(lines)]


POSTS = "author_id,title\n1,Hello\n2,World\n"
POSTS_SQL = "CREATE TABLE posts (author_id int, title text);"


def test_csv_to_jsonl_and_back(sql, put, tmp_path):
    a, schema = put("posts.csv", POSTS), "postgres-sql:" + put("posts.sql", POSTS_SQL)
    out = copy.copy(sql, f"file:{a}", f"file:{tmp_path}/out.jsonl", schema=schema)
    assert out == [f"file:{tmp_path}/out.jsonl"]
    assert sorted(map(json.loads, open(f"{tmp_path}/out.jsonl")), key=str) == [{"author_id": 1, "title": "Hello"}, {"author_id": 2, "title": "World"}]
    copy.copy(sql, f"file:{tmp_path}/out.jsonl", f"csv:{tmp_path}/back.csv", schema=schema)
    assert got(f"{tmp_path}/back.csv") == ["author_id,title", "1,Hello", "2,World"]
    with pytest.raises(TideError, match="exists"):
        copy.copy(sql, f"file:{a}", f"file:{tmp_path}/back.csv", schema=schema)
    copy.copy(sql, f"file:{a}", f"file:{tmp_path}/back.csv", schema=schema, where="author_id = 1", if_exists="overwrite")
    assert got(f"{tmp_path}/back.csv") == ["author_id,title", "1,Hello"]
    assert copy.count(sql, f"file:{a}", schema=schema) == 2 and copy.count(sql, f"file:{a}", schema=schema, where="title > 'I'") == 1


def test_metrics(sql, put, tmp_path):
    found = {}
    copy.copy(sql, f"file:{put('posts.csv', POSTS)}", f"file:{tmp_path}/o.csv", metrics=found)
    assert found == {"from": "file:", "to": "file:", "rows": 2, "streams": 1, "bytes": len(POSTS), "by_stream": {"posts": 2}}
    # by stream, and bytes where no file is written
    put("in/01.csv", "a,b\n1,x\n2,\"y\n\"\n"), put("in/deep/02.csv", "a,b\n3,z\n")
    schema, found = "postgres-sql:" + put("t.sql", "CREATE TABLE t (a text, b text)"), {}
    sql.sql("DROP TABLE IF EXISTS metrics_test")
    copy.copy(sql, f"file:{tmp_path}/in/", "table:metrics_test", schema=schema, metrics=found)
    assert found == {"from": "file:", "to": "table:", "rows": 3, "streams": 1, "bytes": len('1,x\n2,"y\n"\n3,z\n'), "by_stream": {"01": 2, "deep/02": 1}}
    found = {}
    copy.copy(sql, "table:metrics_test", f"file:{tmp_path}/o2.csv", metrics=found)
    assert found == {"from": "table:", "to": "file:", "rows": 3, "streams": 1, "bytes": os.path.getsize(f"{tmp_path}/o2.csv")}


def test_folders_keep_streams(sql, put, tmp_path):
    put("in/01.csv", "a,b\n1,x\n"), put("in/02_nested/01.v2.csv", "a,b\n2,y\n")
    schema = "postgres-sql:" + put("t.sql", "CREATE TABLE t (a text, b text)")
    out = copy.copy(sql, f"file:{tmp_path}/in/", f"file:{tmp_path}/out/", schema=schema)
    assert sorted(out) == [f"file:{tmp_path}/out/01.csv", f"file:{tmp_path}/out/02_nested/01.csv"]
    assert got(f"{tmp_path}/out/02_nested/01.csv") == ["a,b", "2,y"]
    copy.copy(sql, f"file:{tmp_path}/in/", f"file:{tmp_path}/one.csv", schema=schema)
    assert got(f"{tmp_path}/one.csv") == ["a,b", "1,x", "2,y"]
    put("in/odd.jsonl", "{}")
    with pytest.raises(TideError, match="several extensions"):
        copy.copy(sql, f"file:{tmp_path}/in/", f"file:{tmp_path}/out2/", schema=schema)
    with pytest.raises(TideError, match="no file"):
        os.mkdir(tmp_path / "none")
        copy.copy(sql, f"file:{tmp_path}/none/", f"file:{tmp_path}/out2/", schema=schema)


def test_headers_have_to_be_the_schemas(sql, put, tmp_path):
    schema = "postgres-sql:" + put("t.sql", "CREATE TABLE t (a text, b text)")
    put("in/1.csv", "a,b\n1,x\n"), put("in/2.csv", "b,a\n1,x\n")
    with pytest.raises(Exception, match="columns are|CSV header"):
        copy.copy(sql, f"file:{tmp_path}/in/", f"file:{tmp_path}/x.csv", schema=schema)
    one = put("one.csv", "a,B\n1,x\n")
    with pytest.raises(TideError, match="columns are"):
        copy.copy(sql, f"file:{one}", f"file:{tmp_path}/x.csv", schema=schema)
    assert not os.path.exists(tmp_path / "x.csv")


def test_names_that_differ_in_case_only(sql, put, tmp_path):
    text = '"Zone 4.14","$Region - 8/1",name,Name\na,b,c,d\n'
    a = put("t.csv", text)
    copy.copy(sql, f"csv:{a}", f"csv:{tmp_path}/out.csv")
    assert open(f"{tmp_path}/out.csv").read().splitlines() == ["Zone 4.14,$Region - 8/1,name,Name", "a,b,c,d"]
    with pytest.raises(TideError, match="cannot have a column"):
        copy.convert_schema(sql, f"csv:{a}", f"bigquery-schema:{tmp_path}/x.json")


def test_bad_cells_stop_a_copy(sql, put, tmp_path):
    a, schema = put("d.csv", "id,day\n1,2001-02-30\n"), "postgres-sql:" + put("d.sql", "CREATE TABLE d (id int, day date)")
    with pytest.raises(Exception, match="column 'day'"):
        copy.copy(sql, f"file:{a}", f"file:{tmp_path}/x.csv", schema=schema)
    assert not os.path.exists(tmp_path / "x.csv")
    short = put("s.csv", "id,day\n1\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        copy.copy(sql, f"file:{short}", f"file:{tmp_path}/x.csv", schema=schema)


def test_empty_inputs(sql, put, tmp_path):
    a, schema = put("e.csv", "author_id,title\n"), "postgres-sql:" + put("posts.sql", POSTS_SQL)
    copy.copy(sql, f"file:{a}", f"file:{tmp_path}/out.csv", schema=schema)
    assert open(tmp_path / "out.csv").read() == "author_id,title\n"
    assert copy.count(sql, f"file:{a}", schema=schema) == 0


def test_chunks(sql, put, tmp_path):
    lines = [f"{i},title number {i}" for i in range(500)]
    a, schema = put("posts.csv", "author_id,title\n" + "\n".join(lines) + "\n"), "postgres-sql:" + put("posts.sql", POSTS_SQL)
    out = copy.copy(sql, f"file:{a}", f"file:{tmp_path}/out/", schema=schema, stream_size=2000)
    assert sorted(os.path.basename(x) for x in out) == [f"chunk_{i:04d}.csv" for i in range(1, len(out) + 1)]
    found = [got(x[5:]) for x in out]
    assert sorted(y for x in found for y in x[1:]) == sorted(lines) and all(x[0] == "author_id,title" for x in found)
    assert all(len("\n".join(x)) < 2200 for x in found) and len(out) == -(-sum(len(x) + 1 for x in lines) // 2000)


def test_tables_and_policies(sql, put, tmp_path):
    schema = "postgres-sql:" + put("u.sql", 'CREATE TABLE u (key1 int NOT NULL, key2 int NOT NULL, value text, more text[], "select" text)')
    head = "key1,key2,value,more,select\n"
    one = put("1.csv", head + '1,1,a,"[""x""]",\n1,2,b,,s\n')
    two = put("2.csv", head + "1,2,c,[],\n2,1,d,,t\n")
    to = "table:upsert_test"
    sql.sql("DROP TABLE IF EXISTS upsert_test")
    copy.copy(sql, f"file:{one}", to, schema=schema, if_exists="upsert-on:key1,key2")
    copy.copy(sql, f"file:{two}", to, schema=schema, if_exists="upsert-on:key1,key2")
    want = [(1, 1, "a", ["x"], None), (1, 2, "c", [], None), (2, 1, "d", None, "t")]
    assert sorted(map(tuple, sql.table("upsert_test").collect())) == want
    with pytest.raises(TideError, match="exists"):
        copy.copy(sql, f"file:{two}", to, schema=schema)
    copy.copy(sql, f"file:{two}", to, schema=schema, if_exists="append")
    assert copy.count(sql, to) == 5 and copy.count(sql, to, where="key1 = 2") == 2
    with pytest.raises(Exception, match="several rows"):
        copy.copy(sql, f"file:{put('3.csv', head + '9,9,a,,' + chr(10) + '9,9,b,,' + chr(10))}", to, schema=schema, if_exists="upsert-on:key1,key2")
    with pytest.raises(TideError, match="no column"):
        copy.copy(sql, f"file:{two}", to, schema=schema, if_exists="upsert-on:nope")
    copy.copy(sql, f"file:{one}", to, schema=schema, if_exists="overwrite")
    copy.copy(sql, to, f"file:{tmp_path}/back.csv")
    assert got(f"{tmp_path}/back.csv") == [head.strip(), '1,1,a,"[""x""]",', "1,2,b,,s"]
    other = "postgres-sql:" + put("v.sql", "CREATE TABLE v (key1 int NOT NULL)")
    with pytest.raises(TideError):
        copy.copy(sql, f"file:{put('v.csv', 'key1' + chr(10) + '1' + chr(10))}", to, schema=other, if_exists="append")


def test_upsert_plan_and_errors(sql):
    there = sql.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = sql.createDataFrame([("B", 2), ("c", 3)], "v string, k int")
    assert sorted(map(tuple, merge.upsert(there, new, ["k"]).collect())) == [(1, "a"), (2, "B"), (3, "c")]
    with pytest.raises(Exception, match="key is null"):
        merge.upsert(there, sql.createDataFrame([(None, "x")], "k int, v string"), ["k"]).collect()
    for keys in ([], ["x"], ["k", "k"]):
        with pytest.raises(TideError):
            merge.upsert(there, new, keys)


def test_inline(sql, put):
    schema = "postgres-sql:" + put("posts.sql", POSTS_SQL)
    to = "bigquery-test-fixture:p:d.posts"
    copy.copy(sql, f"file:{put('posts.csv', POSTS)}", to, schema=schema, if_exists="overwrite")
    assert copy.count(sql, to, where="author_id = 1") == 1
    with pytest.raises(TideError):
        copy.copy(sql, f"file:{put('posts.csv', POSTS)}", to, schema=schema, if_exists="append")


def test_schema_conversion(sql, put, tmp_path):
    source = "postgres-sql:" + put("t.sql", "CREATE TYPE c AS ENUM ('a'); CREATE TABLE t (id uuid NOT NULL, xs int[], k c, at timestamp with time zone, g public.geometry(Geometry, 4326))")
    copy.convert_schema(sql, source, f"portable-schema:{tmp_path}/t.json")
    copy.convert_schema(sql, f"portable-schema:{tmp_path}/t.json", f"postgres-sql:{tmp_path}/back.sql")
    assert open(tmp_path / "back.sql").read().startswith("CREATE TYPE \"c\" AS ENUM ('a');")
    copy.convert_schema(sql, source, f"trino-sql:{tmp_path}/t.trino.sql")
    assert '"at" TIMESTAMP(3) WITH TIME ZONE' in open(tmp_path / "t.trino.sql").read()
    copy.convert_schema(sql, source, f"bigquery-schema:{tmp_path}/bq.json")
    assert [c["mode"] for c in json.load(open(tmp_path / "bq.json"))] == ["REQUIRED", "REPEATED", "NULLABLE", "NULLABLE", "NULLABLE"]
    with pytest.raises(TideError, match="exists"):
        copy.convert_schema(sql, source, f"bigquery-schema:{tmp_path}/bq.json")
    copy.convert_schema(sql, source, f"bigquery-schema:{tmp_path}/bq.json", if_exists="overwrite")
    ts = put("a #1 20%.ts", "interface T { a: string }")
    copy.convert_schema(sql, str(locators.PortableTs.of(ts, "T").text), f"portable-schema:{tmp_path}/ts.json")
    with pytest.raises(TideError, match="cannot write"):
        copy.convert_schema(sql, source, "csv:x.csv")


#: An example of each scheme, made from its grammar.
ROUND = (
    "file:-", "file:/var/data/orders.csv", "csv:orders/2024.csv", "table:sales.daily", "inline:lookup_7", "s3://lake/raw/clicks/", "gs://lake/one.csv", "postgres://ann@pg.internal/shop#public.orders",
    "redshift://etl@cluster:5439/dw#fact_sales", "trino://coordinator/hive/web#hits", "bigquery:acme-eu:mart.users", "shopify://toys.example/api/orders.json", "postgres-sql:ddl/orders.sql", "bigquery-schema:users.json",
    "trino-sql:hits.ddl", "portable-schema:-", "portable-ts:types/shop%23v2.ts#Order",
)


@pytest.mark.parametrize("text", ROUND)
def test_locators_print_as_they_are(text):
    assert str(locators.parse(text)) == text
    assert locators.describe(text.split(":")[0]).startswith(text.split(":")[0])


def test_locator_errors():
    assert str(locators.parse("postgres://me:secret@h/db#t")) == "postgres://me:XXXXXX@h/db#t"
    for text in ("x", "nope:x", "bigquery:a.b", "postgres://h/db", "portable-ts:x", "file:a\nb"):
        with pytest.raises(TideError):
            locators.parse(text)
    with pytest.raises(TideError, match="unstable"):
        locators.parse("trino://h/c/s#t", unstable=False)


def test_database_options():
    at = locators.parse("postgres://me:p%20w@host:99/db#s.t")
    schema = Schema(Table("t", (Column("a", S.INT64),)))
    options = at.read_options(schema, arguments.SourceArguments(where="a > 1"))
    assert options["url"] == "jdbc:postgresql://host:99/db" and options["user"] == "me" and options["password"] == "p w" and options["query"] == 'SELECT "a" FROM "s"."t" WHERE (a > 1)'
    assert at.count_statement(arguments.SourceArguments()) == 'SELECT COUNT(*) AS "count" FROM "s"."t"'
    assert locators.parse("trino://h:8080/c/s#t").select(schema, arguments.SourceArguments()) == 'SELECT CAST("a" AS VARCHAR) AS "a" FROM "t"'
    assert locators.parse("bigquery:p:d.t").options(arguments.SourceArguments(where="x")) == {"table": "p:d.t", "filter": "x"}
    assert locators.parse("s3://b/dir/").path == "s3a://b/dir/" and locators.parse("gs://b/x.csv").path == "gs://b/x.csv"


def test_features_are_checked(sql, put, tmp_path):
    a = put("posts.csv", POSTS)
    for change, what in (({"from_format": "csv"}, "--from-format"), ({"to_args": ["a=b"]}, "--to-arg"), ({"if_exists": "append"}, "if-exists"), ({"if_exists": "upsert-on:"}, "keys"), ({"if_exists": "x"}, "if-exists")):
        with pytest.raises(TideError, match=what):
            copy.copy(sql, f"csv:{a}", f"csv:{tmp_path}/x.csv", **change)
    with pytest.raises(TideError, match="has to end in /"):
        locators.parse("s3://b/x.csv").write(None, None, None)
    assert IfExists("append").write_disposition == "WRITE_APPEND"


def test_driver_arguments():
    assert arguments.parse(["a=b", "c.d=x", "c.e[]=y", "c[e][]=z"]) == {"a": "b", "c": {"d": "x", "e": ["y", "z"]}}
    for bad in (["a=x", "a=y"], ["a=x", "a.b=y"], ["a=x", "a[]=y"], ["=x"], ["a"], ["a[]b=x"], ["1=x"]):
        with pytest.raises(TideError):
            arguments.parse(bad)


def test_stream_names():
    for base, path, want in (("dir/file1.csv", "dir/file1.csv", "file1"), ("dir", "dir/file1.csv", "file1"), ("dir/", "dir/file1.csv", "file1"), ("dir/", "dir/subdir/file2.v1.csv", "subdir/file2"), ("s3://b/dir/", "s3://b/dir/f.csv", "f")):
        assert shape.stream_name(base, path) == want
    assert files.extension("a/b.CSV") == "csv" and files.extension("a.b/c") == ""


def test_alignment(sql):
    df = sql.createDataFrame([(1, "x", 2)], "a int, b string, A int")
    assert rows.project(df, ["A", "b"]).collect() == [(2, "x")]
    with pytest.raises(TideError, match="no column 'z'; there are 'a', 'b', 'A'"):
        rows.project(df, ["z"])
    with pytest.raises(TideError):
        rows.rename_header(df, ["x"])
    with pytest.raises(TideError, match="streams"):
        shape.concatenate(df, df.select("b", "a", "A"))
    have, want = Schema(Table("t", ())), Schema(Table("t", ()))
    assert rows.align_type(have, S.TEXT, want, S.UUID, "c") == S.UUID and rows.align_type(have, S.Array(S.TEXT), want, S.Array(S.JSON), "c") == S.Array(S.JSON)
    with pytest.raises(TideError):
        rows.align_type(have, S.INT16, want, S.INT32, "c")
    schema = Schema(Table("t", (Column("a", S.INT32, False),)))
    with pytest.raises(Exception, match="unexpected NULL"):
        rows.not_null(schema, sql.createDataFrame([(None,)], "a int")).collect()


def test_command_line(sql, put, tmp_path, capsys, monkeypatch):
    a, schema = put("posts.csv", POSTS), "postgres-sql:" + put("posts.sql", POSTS_SQL)
    assert cli.main(["cp", "--schema", schema, "--display-output-locators", f"file:{a}", f"file:{tmp_path}/o.csv"], sql) == 0
    assert capsys.readouterr().out == f"file:{tmp_path}/o.csv\n"
    assert cli.main(["count", "--where", "author_id = '1'", f"csv:{a}"], sql) == 0 and capsys.readouterr().out == "1\n"
    assert cli.main(["cp", f"file:{a}", "file:-", "-F", "jsonl"], sql) == 0
    assert sorted(capsys.readouterr().out.splitlines()) == ['{"author_id":"1","title":"Hello"}', '{"author_id":"2","title":"World"}']
    assert cli.main(["schema", "conv", f"csv:{a}", "postgres-sql:-"], sql) == 0 and '"title" text' in capsys.readouterr().out
    assert cli.main(["cp", f"file:{a}", f"file:{tmp_path}/o.csv"], sql) == 1 and "exists" in capsys.readouterr().err
    assert cli.main(["features"]) == 0 and "- trino (UNSTABLE)" in capsys.readouterr().out
    assert cli.main(["features", "postgres"]) == 0 and "upsert-on:COL" in capsys.readouterr().out
    assert cli.main(["license", str(tmp_path / "l.txt")]) == 0 and os.path.getsize(tmp_path / "l.txt")
    monkeypatch.setenv("TABLETIDE_CONFIG_DIR", str(tmp_path / "conf"))
    os.mkdir(tmp_path / "conf")
    (tmp_path / "conf/tabletide.toml").write_text("# mine\nother = 1\n")
    for args in (["add", "temporary", "s3://x/"], ["add", "temporary", "gs://y/"], ["rm", "temporary", "s3://x/"]):
        assert cli.main(["config", *args]) == 0
    assert Config().temporary == ["gs://y/"] and "# mine\nother = 1" in Config().text
    assert find_temporary("gs://", [], ["gs://y/"]) == "gs://y/"
    with pytest.raises(TideError, match="need --temporary"):
        find_temporary("s3://", ["gs://y/"])


def test_standard_input(sql, monkeypatch, tmp_path, put):
    import io

    monkeypatch.setattr("sys.stdin", io.StringIO(POSTS))
    copy.copy(sql, "file:-", f"file:{tmp_path}/o.csv", schema="postgres-sql:" + put("posts.sql", POSTS_SQL))
    assert got(f"{tmp_path}/o.csv") == ["author_id,title", "1,Hello", "2,World"]


def test_paged_rest(sql):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    failures = [1]

    class Stub(BaseHTTPRequestHandler):
        def do_GET(self):
            if failures and "page=2" in self.path:
                failures.pop()
                self.send_response(503)
                self.end_headers()
                return
            self.send_response(200)
            if "page=2" not in self.path:
                assert "limit=250" in self.path
                self.send_header("Link", f'<http://x/prev>; rel="previous", <http://127.0.0.1:{self.server.server_port}/o.json?limit=250&page=2>; rel="next"')
            self.end_headers()
            first = 3 if "page=2" in self.path else 1
            self.wfile.write(json.dumps({"orders": [{"id": i, "note": None, "lines": [{"q": i}]} for i in (first, first + 1)]}).encode())

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Stub)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    schema = Schema(Table("o", (Column("id", S.INT64, False), Column("note", S.TEXT), Column("lines", S.Array(S.Struct((S.StructField("q", S.INT32),)))))))
    found = rest.read_pages(sql, f"http://127.0.0.1:{server.server_port}/o.json", schema, {"wait": "0.01", "header": {"X-Token": "t"}}).collect()
    server.shutdown()
    assert [(r.id, r.note, r.lines[0].q) for r in found] == [(i, None, i) for i in (1, 2, 3, 4)]
    assert rest.next_link('<http://a/?x=1,2>; rel="next"') == "http://a/?x=1,2" and rest.next_link(None) is None
    assert (rest.throttle("20/40"), rest.throttle("19/40"), rest.throttle(None)) == (1.0, 0.0, 0.0)


def test_arriving_files(sql, put, tmp_path):
    schema = Schema(Table("t", (Column("k", S.INT32, False), Column("v", S.TEXT))))
    sql.sql("DROP TABLE IF EXISTS arriving_test")
    os.mkdir(tmp_path / "in")
    for i, text in enumerate(("k,v\n1,a\n2,b\n", "k,v\n2,B\n3,c\n")):
        put(f"in/{i}.csv", text)
        keep_copied(arriving(sql, f"{tmp_path}/in", schema), schema, "arriving_test", "upsert-on:k", f"{tmp_path}/ck", once=True).awaitTermination(60)
    assert sorted(map(tuple, sql.table("arriving_test").collect())) == [(1, "a"), (2, "B"), (3, "c")]


def test_filters_and_columns_reach_the_scan(sql, small):
    found = rows.project(rows.where(sql.read.parquet(f"{small}/lineitem.parquet"), "l_quantity > 40"), ["l_orderkey"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,40.0)]" in plan and "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_files_listing(sql, put, tmp_path):
    put("d/a.csv", "x"), put("d/.hidden.csv", "x"), put("d/_tmp/b.csv", "x")
    assert [p.rsplit("/", 1)[1] for p, _ in Files(sql, f"{tmp_path}/d").listed()] == ["a.csv"]
