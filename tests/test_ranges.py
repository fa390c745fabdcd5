"""CSV read in ranges against one reader, at every cut."""

import csv
import io
import os
import random
import re

import numpy as np
import pytest

from tabletide.errors import TideError
from tabletide.plans import copy
from tabletide.schema import TEXT, Column, Schema, Table
from tabletide.sources import files, ranges


def table(*names):
    return Schema(Table("t", tuple(Column(n, TEXT) for n in names)))


def read(spark, path, schema, share):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", share)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        df = files.scan(spark, path, schema)
        return sorted(map(tuple, df.collect()), key=str), df
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


CELLS = ["", "a", "two\nlines", "\n", 'quo"te', '"', '""\n"', ",", "x,\ny", "é\n中", " pad ", "a\r\nb", "long " * 30, "\n\n\n"]


def test_every_cut(spark, tmp_path):
    """Ranges of any size, from a few bytes on, give the rows of one reader; line ends of either kind."""
    r = random.Random(1)
    rows = [tuple(r.choice(CELLS) for _ in range(3)) for _ in range(60)]
    for end in ("\n", "\r\n"):
        text = io.StringIO(newline="")
        writer = csv.writer(text, lineterminator=end)
        writer.writerows([("a", "b", "c"), *rows])
        path = tmp_path / f"t{len(end)}.csv"
        path.write_text(text.getvalue(), newline="")
        one = sorted(((*(None if c == "" else c for c in row), f"t{len(end)}") for row in rows), key=str)
        for share in (7, 501, 2000, 1 << 20):
            many, df = read(spark, str(path), table("a", "b", "c"), share)
            assert many == one
            assert df.rdd.getNumPartitions() > 1 or share > 2000


def test_stray_quotes_and_ends(spark, tmp_path):
    """A quote inside an unquoted cell begins nothing; the last line may have no end; empty lines are no records."""
    text = 'a,b\n1,x"y\n2,"in ""side""\nnext"\n\n3,5" by 6"\n4,"\n"\n5,last'
    path = tmp_path / "t.csv"
    path.write_text(text)
    want = sorted([("1", 'x"y', "t"), ("2", 'in "side"\nnext', "t"), ("3", '5" by 6"', "t"), ("4", "\n", "t"), ("5", "last", "t")])
    for share in (5, 12, 1 << 20):
        assert read(spark, str(path), table("a", "b"), share)[0] == want, share


def test_folders_and_headers(spark, tmp_path):
    for i in range(4):
        (tmp_path / f"{i}.csv").write_text("a,b\n" + "".join(f'{i}{k},"x\n{k}"\n' for k in range(20)))
    want = sorted((f"{i}{k}", f"x\n{k}", str(i)) for i in range(4) for k in range(20))
    assert read(spark, f"{tmp_path}/", table("a", "b"), 40)[0] == want
    (tmp_path / "9.csv").write_text("b,a\n1,2\n" * 30)
    with pytest.raises(Exception, match="columns (of .* )?are"):
        read(spark, f"{tmp_path}/", table("a", "b"), 40)
    with pytest.raises(TideError, match="columns are"):
        read(spark, f"{tmp_path}/0.csv", table("a", "c"), 40)
    (tmp_path / "9.csv").write_text("a,b\n" + "1,2,3\n" * 30)
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read(spark, f"{tmp_path}/", table("a", "b"), 40)


def test_an_open_quote_at_the_end(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b\n1,x\n2,"no end\n3,y\n')
    for share in (4, 1 << 20):
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", share)
        found = sorted(bytes(r.record) for r in ranges.records(spark, str(path)).collect())
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert found == [b"1,x", b'2,"no end\n3,y', b"a,b"]


def test_states():
    """Functions of two states, one line after another."""
    r = random.Random(5)
    for _ in range(500):
        n = r.randint(0, 12)
        opens, stays = (np.array([r.random() < 0.5 for _ in range(n)], bool) for _ in "ab")
        for begin in (False, True):
            want, state = [begin], begin
            for a, b in zip(opens, stays):
                state = bool(b if state else a)
                want.append(state)
            assert ranges.states(opens, stays, begin).tolist() == want


def test_lines():
    """What a line leaves open, against reading it a byte at a time."""

    def after(line, quoted):
        at = 0 if quoted else None  # where the cell that is open began
        state = "quoted" if quoted else "begin"
        for c in line:
            if state == "begin":
                state = "quoted" if c == '"' else "begin" if c == "," else "plain"
            elif state == "plain":
                state = "begin" if c == "," else "plain"
            elif state == "quoted":
                state = "closing" if c == '"' else "quoted"
            elif state == "closing":  # a second quote is one of the cell
                state = "quoted" if c == '"' else "begin" if c == "," else "after"
            elif state == "after":
                state = "begin" if c == "," else "after"
        return state == "quoted"

    r = random.Random(8)
    for _ in range(30_000):
        line = "".join(r.choice('"",ab') for _ in range(r.randint(0, 9)))
        assert bool(re.search(ranges.OPENS.replace(r"\z", r"\Z"), line)) == after(line, False), line
        assert bool(re.search(ranges.STAYS_OPEN.replace(r"\z", r"\Z"), line)) == after(line, True), line


def test_copies(spark, tmp_path):
    """A copy of a file that several tasks read."""
    rows = [(str(i), f'line {i}\nand "more",\n') for i in range(400)]
    text = io.StringIO(newline="")
    csv.writer(text, lineterminator="\n").writerows([("id", "text"), *rows])
    (tmp_path / "in.csv").write_text(text.getvalue(), newline="")
    (tmp_path / "s.sql").write_text("CREATE TABLE t (id int NOT NULL, text text)")
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", 1000)
    copy.copy(session, f"file:{tmp_path}/in.csv", f"file:{tmp_path}/out.csv", schema=f"postgres-sql:{tmp_path}/s.sql")
    with open(tmp_path / "out.csv", newline="") as f:
        got = list(csv.reader(f))
    assert got[0] == ["id", "text"] and sorted(map(tuple, got[1:])) == sorted(rows)


@pytest.mark.parametrize("bad", ["x7", ""])
def test_errors_say_where(spark, tmp_path, bad):
    """File, line and record of the first cell that cannot be read, also where lines and records differ and many tasks read a file."""
    os.makedirs(tmp_path / "in")
    for name, wrong in (("a", None), ("b", 150)):
        text = io.StringIO(newline="")
        csv.writer(text, lineterminator="\n").writerows([("n", "t"), *((bad if i == wrong else i, "two\nlines" if i % 3 else "one") for i in range(200))])
        (tmp_path / f"in/{name}.csv").write_text(text.getvalue(), newline="")
    (tmp_path / "s.sql").write_text("CREATE TABLE t (n int NOT NULL, t text)")
    lines = (tmp_path / "in/b.csv").read_text().split("\n")
    line = next(i for i, x in enumerate(lines, 1) if x == f"{bad},one")
    for share in (500, 1 << 27):
        session = spark.newSession()
        session.conf.set("spark.sql.files.maxPartitionBytes", share)
        with pytest.raises(TideError) as e:
            copy.copy(session, f"file:{tmp_path}/in/", f"file:{tmp_path}/out{share}/", schema=f"postgres-sql:{tmp_path}/s.sql", from_format="csv")
        assert f"in/b.csv, line {line}, record 151: column 'n': cannot read \"{bad}\" as int32" in str(e.value)
