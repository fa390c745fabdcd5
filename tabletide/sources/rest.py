"""Rows from a REST address whose answers come in pages, as a Spark data source, for tables and for streams.

Pages follow from each other, so one task reads them, unless the address can be asked for windows of a number or of a time: then each
window is a task's, with pages of its own.  As a stream, a window begins where the last one ended.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from urllib.error import HTTPError, URLError
from urllib.parse import urlencode
from urllib.request import Request, urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..errors import TideError
from ..functions import decode
from ..operators.rows import decoded
from ..schema import Schema
from ..session import importable

#: Rows in a page, retries, and seconds before the first retry, doubled for each further one.
PAGE, RETRIES, WAIT = 250, 3, 5.0


def next_link(header: str | None) -> str | None:
    """The address of the next page in a Link header."""
    for part in re.split(r",(?=\s*<)", header or ""):
        m = re.match(r"\s*<([^>]*)>(.*)", part)
        if m and re.search(r";\s*rel\s*=\s*\"?next\"?", m[2]):
            return m[1]
    return None


def throttle(header: str | None) -> float:
    """Seconds to wait, given how much of the allowed calls is used up, as `used/limit`."""
    m = re.fullmatch(r"\s*(\d+)\s*/\s*(\d+)\s*", header or "")
    return 1.0 if m and int(m[1]) * 2 >= int(m[2]) else 0.0


def retried(call, retries: int = RETRIES, wait: float = WAIT, sleep=time.sleep):
    """The result of a call; errors that may pass are waited out, longer each time."""
    for left in range(retries, -1, -1):
        try:
            return call()
        except HTTPError as e:
            if not left or e.code not in (403, 429, 500, 502, 503, 504):
                raise
        except (URLError, TimeoutError):
            if not left:
                raise
        sleep(wait)
        wait *= 2
    raise AssertionError


def pages(url: str, headers: dict[str, str], wait: float = WAIT, sleep=time.sleep) -> Iterator[list]:
    """The rows of each page; an answer has one key, whose value is the rows."""
    following: str | None = url if "limit=" in url else f"{url}{'&' if '?' in url else '?'}limit={PAGE}"
    while following:
        address = following

        def call():
            with urlopen(Request(address, headers=headers), timeout=60) as answer:  # noqa: S310
                return json.load(answer), answer.headers

        body, found = retried(call, wait=wait, sleep=sleep)
        if not isinstance(body, dict) or len(body) != 1:
            raise TideError(f"expected one key in the answer from {address}")
        yield next(iter(body.values()))
        following = next_link(found.get("Link"))
        sleep(throttle(found.get("X-Shopify-Shop-Api-Call-Limit")))


@dataclass(frozen=True)
class Window(InputPartition):
    """Rows whose value is at least `low` and less than `high`; None for no bound."""

    low: str | None
    high: str | None

    def __init__(self, low: str | None = None, high: str | None = None):
        object.__setattr__(self, "low", low)
        object.__setattr__(self, "high", high)


class Windows:
    """Options window.low and window.high are the parameters that bound a window, the first one included, the second one not; window.from, window.to and window.step are whole numbers, or times as ISO 8601 writes them with a step in seconds."""

    def __init__(self, options: dict[str, str]):
        given = {k[7:]: v for k, v in options.items() if k.startswith("window.")}
        if missing := {"low", "high", "from", "step"} - given.keys():
            raise TideError(f"windows need {', '.join(f'window.{x}' for x in sorted(missing))}")
        self.low_name, self.high_name = given["low"], given["high"]
        self.timed = not re.fullmatch(r"-?\d+", given["from"])
        self.begin, self.step = self.number(given["from"]), int(given["step"])
        self.end = self.number(given["to"]) if given.get("to") else None
        if self.step < 1:
            raise TideError("window.step has to be positive")

    def number(self, text: str) -> int:
        if not self.timed:
            return int(text)
        at = datetime.fromisoformat(text)
        return int((at if at.tzinfo else at.replace(tzinfo=UTC)).timestamp())

    def text(self, number: int) -> str:
        return datetime.fromtimestamp(number, UTC).strftime("%Y-%m-%dT%H:%M:%SZ") if self.timed else str(number)

    def between(self, low: int, high: int) -> list[Window]:
        return [Window(self.text(x), self.text(min(x + self.step, high))) for x in range(low, high, self.step)]

    def all(self) -> list[Window]:
        """All windows, and one for what comes before the first and one for what comes after the last: no row is in none, and none in two."""
        end = self.begin + self.step if self.end is None else self.end
        return [Window(None, self.text(self.begin)), *self.between(self.begin, end), Window(self.text(max(self.begin, end)), None)]

    def address(self, url: str, window: Window) -> str:
        bounds = [(self.low_name, window.low), (self.high_name, window.high)]
        asked = urlencode([(k, v) for k, v in bounds if v is not None])
        return f"{url}{'&' if '?' in url else '?'}{asked}"


class PagedSource(DataSource):
    """format("paged_rest"): a row of JSON text for each row of the pages."""

    @classmethod
    def name(cls) -> str:
        return "paged_rest"

    def schema(self) -> StructType:
        return StructType([StructField("value", StringType())])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(dict(self.options))


def _rows(options: dict[str, str], url: str) -> Iterator[tuple]:
    headers = {k[7:]: v for k, v in options.items() if k.startswith("header.")}
    for rows in pages(url, headers, float(options.get("wait", WAIT))):
        for row in rows:
            yield (json.dumps(row),)


def _windows(options: dict[str, str]) -> Windows | None:
    return Windows(options) if any(k.startswith("window.") for k in options) else None


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options, self.windows = options, _windows(options)

    def partitions(self) -> list[InputPartition]:
        return self.windows.all() if self.windows else [Window()]

    def read(self, partition: Window) -> Iterator[tuple]:
        url = self.options["path"]
        return _rows(self.options, self.windows.address(url, partition) if self.windows else url)


class _StreamReader(DataSourceStreamReader):
    """A batch is the windows from the last offset to the present one: to window.to, or else to now, as far as whole steps go."""

    def __init__(self, options: dict[str, str]):
        self.options, self.windows = options, _windows(options)
        if self.windows is None or self.windows.end is None and not self.windows.timed:
            raise TideError("a stream of pages needs windows of times, or window.to")

    def initialOffset(self) -> dict:
        return {"at": self.windows.begin}

    def latestOffset(self) -> dict:
        w = self.windows
        end = w.end if w.end is not None else int(time.time())
        return {"at": end if w.end is not None else max(w.begin, w.begin + (end - w.begin) // w.step * w.step)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return self.windows.between(start["at"], end["at"])

    def read(self, partition: Window) -> Iterator[tuple]:
        return _rows(self.options, self.windows.address(self.options["path"], partition))


def _options(options: dict | None) -> dict[str, str]:
    """Driver arguments as options: header.X and window.X from the objects of these names."""
    given = {k: str(v) for k, v in (options or {}).items() if not isinstance(v, (dict, list))}
    for group in ("header", "window"):
        given |= {f"{group}.{k}": str(v) for k, v in ((options or {}).get(group) or {}).items()}
    return given


def read_pages(spark: SparkSession, url: str, schema: Schema, options: dict | None = None, stream: bool = False) -> DataFrame:
    """Typed rows of the pages at an address; with `stream`, as they come, window after window."""
    importable(spark)
    spark.dataSource.register(PagedSource)
    reader = spark.readStream if stream else spark.read
    lines = reader.format("paged_rest").options(**_options(options)).load(url)
    cells = lines.select(*decode.from_json_text(schema, F.col("value")))
    return decoded(cells, schema)
