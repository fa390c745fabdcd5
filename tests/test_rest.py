"""Pages of windows, against a local server that has rows by number and by time."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlsplit

import pytest

from tabletide import schema as S
from tabletide.errors import TideError
from tabletide.schema import Column, Schema, Table
from tabletide.sources import rest
from tabletide.sources.arguments import parse

SCHEMA = Schema(Table("o", (Column("id", S.INT64, False), Column("at", S.TEXT))))
ROWS = [{"id": i, "at": f"2024-01-01T{i % 24:02d}:30:00Z"} for i in range(-3, 60)]


@pytest.fixture
def server():
    asked = []

    class Stub(BaseHTTPRequestHandler):
        def do_GET(self):
            q = {k: v[0] for k, v in parse_qs(urlsplit(self.path).query).items()}
            asked.append(q)
            key = "at" if "after" in q or "before" in q else "id"
            kind = str if key == "at" else int
            low, high = (q.get("after"), q.get("before")) if key == "at" else (q.get("min"), q.get("max"))
            found = [r for r in ROWS if (low is None or r[key] >= kind(low)) and (high is None or r[key] < kind(high))]
            at, size = int(q.get("page", 0)), 4
            self.send_response(200)
            if (at + 1) * size < len(found):
                more = "&".join(f"{k}={v}" for k, v in (q | {"page": at + 1}).items())
                self.send_header("Link", f'<http://127.0.0.1:{self.server.server_port}/o.json?{more}>; rel="next"')
            self.end_headers()
            self.wfile.write(json.dumps({"orders": found[at * size : (at + 1) * size]}).encode())

        def log_message(self, *args):
            pass

    found = HTTPServer(("127.0.0.1", 0), Stub)
    threading.Thread(target=found.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{found.server_port}/o.json", asked
    found.shutdown()


def test_windows_of_numbers(spark, server):
    """The rows of page after page, by as many tasks as windows; those outside the windows too."""
    url, asked = server
    one = sorted(map(tuple, rest.read_pages(spark, url, SCHEMA).collect()))
    assert [r[0] for r in one] == [r["id"] for r in ROWS]
    df = rest.read_pages(spark, url, SCHEMA, parse(["window.low=min", "window.high=max", "window.from=0", "window.to=50", "window.step=7"]))
    assert sorted(map(tuple, df.collect())) == one and df.rdd.getNumPartitions() == 2 + 8
    assert {"min": "49", "max": "50", "limit": "250"} in asked and {"max": "0", "limit": "250"} in asked and {"min": "50", "limit": "250"} in asked


def test_windows_of_times(spark, server):
    url, _ = server
    options = parse(["window.low=after", "window.high=before", "window.from=2024-01-01T00:00:00Z", "window.to=2024-01-01T23:00:00Z", "window.step=10800"])
    found = rest.read_pages(spark, url, SCHEMA, options)
    assert sorted(r.id for r in found.collect()) == [r["id"] for r in ROWS] and found.rdd.getNumPartitions() == 2 + 8


def test_a_stream_goes_on_where_it_ended(spark, server, tmp_path):
    """A restart repeats nothing: the next batch begins at the last one's offset."""
    url, asked = server

    def run(to):
        options = parse(["window.low=min", "window.high=max", "window.from=0", f"window.to={to}", "window.step=8"])
        df = rest.read_pages(spark, url, SCHEMA, options, stream=True)
        df.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination(120)
        return sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect())

    assert run(20) == list(range(20))
    del asked[:]
    assert run(45) == list(range(45)) and all(int(q["min"]) >= 20 for q in asked)
    assert run(45) == list(range(45))


def test_windows_that_cannot_be():
    with pytest.raises(TideError, match="window.high, window.step"):
        rest.Windows({"window.low": "a", "window.from": "1"})
    with pytest.raises(TideError, match="positive"):
        rest.Windows({"window.low": "a", "window.high": "b", "window.from": "1", "window.step": "0"})
    with pytest.raises(TideError, match="stream of pages"):
        rest._StreamReader({"path": "x", "window.low": "a", "window.high": "b", "window.from": "1", "window.step": "5"})
    reader = rest._StreamReader({"path": "x", "window.low": "a", "window.high": "b", "window.from": "2024-01-01", "window.step": "3600"})
    assert (reader.latestOffset()["at"] - reader.initialOffset()["at"]) % 3600 == 0
    covered = rest.Windows({"window.low": "a", "window.high": "b", "window.from": "0", "window.to": "10", "window.step": "4"}).all()
    assert [(w.low, w.high) for w in covered] == [(None, "0"), ("0", "4"), ("4", "8"), ("8", "10"), ("10", None)]
