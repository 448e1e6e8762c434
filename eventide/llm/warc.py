"""Web archives and their capture index.

Pages become WARC records (a response, or a revisit of the smallest page_id
with the same payload), written by Spark's text writer: a record's end mark is
the line separator, so each output file is a WARC file. The archives are read
back by length, every file's captures are sorted into a run on disk, and the
runs are merged k ways by a loser tree in each range of (URL key, timestamp),
which gives globally ordered capture histories.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import table, written

LEAST_PAYLOAD = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
#: Captures without a crawl time get one from their page_id: a second apart from
#: this one on, modulo some thirty years, so ids may be hashes of any size.
FIRST_CAPTURE, CAPTURE_SPAN = 1_704_067_200, 1_000_000_000
#: Records of one archive file, which bounds what a reader takes in as one value.
FILE_RECORDS = 5_000

ENTRY = ("urlkey string, captured string, page_id long, payload_bytes long, payload_digest string, "
         "record_type string, refers_to long, archive string, offset long")


def resolve(pages: DataFrame, least_payload: int = LEAST_PAYLOAD) -> DataFrame:
    """page_id, digest, bytes, and the page it revisits (null: response)."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.sha2(html, 256).alias("digest"), F.octet_length(html).cast("long").alias("bytes"))
    first = rows.filter(F.col("bytes") >= least_payload).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    out = rows.join(first, "digest", "left")
    return out.select("page_id", "digest", F.when(
        F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("first"))


def records(pages: DataFrame, kinds: DataFrame) -> DataFrame:
    """One WARC record (without its end mark) per page, in column ``value``."""
    # a page_id given several times keeps its rows: kinds is joined by page and payload
    kinds = kinds.distinct().withColumnsRenamed({"page_id": "__page", "digest": "__digest"})
    html = F.coalesce(F.col("html"), F.lit(""))
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
                        F.sha2(html.cast("binary"), 256).alias("digest"))
    both = page.join(kinds, F.col("page_id").eqNullSafe(F.col("__page")) & (F.col("digest") == F.col("__digest")))
    revisit = F.col("first").isNotNull()
    size = F.octet_length("html")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    size.cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    uri = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\x00-\x20\x7F]", "%20")
    second = F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(CAPTURE_SPAN))
    days = (F.timestamp_seconds(F.lit(FIRST_CAPTURE) + second))
    when = F.date_format(F.to_utc_timestamp(days, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    head = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    value = F.concat(
        F.lit("WARC/1.1\r\n"),
        head("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        head("WARC-Record-ID", name(F.col("page_id"))),
        head("WARC-Target-URI", uri),
        head("WARC-Date", when),
        head("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(head("WARC-Profile", F.lit(PROFILE)), head("WARC-Refers-To", name(F.col("first")))))
        .otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        head("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"), block)
    return both.select(value.alias("value"))


def write_archives(pages: DataFrame, path: str, least_payload: int = LEAST_PAYLOAD) -> None:
    """Gzipped WARC files under ``path`` (one gzip stream a file)."""
    kinds = written(resolve(pages, least_payload), "warc-kinds")
    records(pages, kinds).write.option("lineSep", END).option("compression", "gzip").option(
        "maxRecordsPerFile", FILE_RECORDS).text(path)


class BadArchive(ValueError):
    """A file that is not a sequence of WARC records."""


def read_records(stream: io.BufferedIOBase) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, headers and block of each record, by Content-Length."""
    offset = 0
    while first := stream.readline():
        if first != b"WARC/1.1\r\n":
            raise BadArchive(f"no record at {offset}: {first[:40]!r}")
        size, headers = len(first), {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            size += len(line)
            key, _, value = line.decode().rstrip("\r\n").partition(": ")
            headers[key] = value
        length = int(headers["Content-Length"])
        block = stream.read(length)
        if len(block) != length or stream.read(4) != END.encode():
            raise BadArchive(f"record at {offset} is cut")
        yield offset, headers, block
        offset += size + 2 + length + 4


def url_key(url: str) -> str:
    """Sort key of a URL: host parts reversed, then path and query; a text
    that is no URL is its own key."""
    try:
        parts = urlsplit(url)
        host, port = parts.hostname, parts.port
    except ValueError:
        host = port = None
    if not host:
        return url.lower()
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return f"{','.join(reversed(host.split('.')))}{f':{port}' if port else ''}){tail.lower()}"


def _page(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def capture(archive: str, offset: int, headers: dict[str, str], block: bytes) -> tuple:
    """Index entry of a record; a response's payload must have its digest."""
    http, _, payload = block.partition(END.encode())
    size = int(http.rsplit(b"Content-Length: ", 1)[1])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if headers["WARC-Type"] == "response":
        size, found = len(payload), hashlib.sha256(payload).hexdigest()
        if found != digest:
            raise BadArchive(f"payload of {headers['WARC-Record-ID']} does not have its digest")
    refers = headers.get("WARC-Refers-To")
    return (url_key(headers["WARC-Target-URI"]), headers["WARC-Date"], _page(headers["WARC-Record-ID"]), size, digest,
            headers["WARC-Type"], _page(refers) if refers else None, archive, offset)


def order_of(entry: tuple) -> tuple:
    return entry[0], entry[1], entry[2] is None, entry[2] or 0, entry[7], entry[8]


_NAMES = [f.split(" ")[0] for f in ENTRY.split(", ")]
_TYPES = [pa.int64() if f.endswith("long") else pa.string() for f in ENTRY.split(", ")]
_SCHEMA = pa.schema(list(zip(_NAMES, _TYPES, strict=True)))


def _batch(entries: list[tuple], schema: pa.Schema = _SCHEMA) -> pa.RecordBatch:
    columns = zip(*entries, strict=True) if entries else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted run of captures for each archive."""
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            name = path.as_py().rsplit("/", 1)[-1]
            raw = io.BytesIO(content.as_buffer())
            with gzip.GzipFile(fileobj=raw) as f, io.BufferedReader(f, 1 << 20) as stream:
                entries = [capture(name, *r) for r in read_records(stream)]
            yield _batch(sorted(entries, key=order_of))


def index_runs(spark: SparkSession, path: str) -> DataFrame:
    """The locally sorted runs of all archives, written to disk."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return written(files.mapInArrow(_runs, ENTRY), "warc-runs")


class LoserTree:
    """k-way merge: inner nodes keep the loser of their match, so replacing
    the winner replays one path of log2(k) matches."""

    def __init__(self, runs: list[Iterator[tuple]]) -> None:
        self.runs = runs
        self.k = max(1, len(runs))
        self.heads = [self._next(i) for i in range(len(runs))] or [None]
        self.losers = [-1] * self.k
        for i in range(self.k):
            self._play(i, building=True)

    def _next(self, i: int):
        entry = next(self.runs[i], None)
        return None if entry is None else (order_of(entry), entry)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x[0], a) < (y[0], b)

    def _play(self, i: int, building: bool = False) -> None:
        winner, node = i, (i + self.k) // 2
        while node > 0:
            if self.losers[node] == -1 and building:
                self.losers[node] = winner
                return  # the match waits for its other side
            if self._beats(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while (head := self.heads[self.losers[0]]) is not None:
            winner = self.losers[0]
            yield head[1]
            self.heads[winner] = self._next(winner)
            self._play(winner)


OUT_ROWS = 20_000


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the pieces of runs that fell into this range. A piece arrives in
    its run's order; ``nth`` is a capture's place in the range ``part``."""
    pieces: dict[str, list[tuple]] = {}
    for batch in batches:
        for entry in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            pieces.setdefault(entry[7], []).append(entry)
    # blocks of one map task can arrive in any order; restore each run's order where that happened
    for run in pieces.values():
        if any(order_of(a) > order_of(b) for a, b in zip(run, run[1:], strict=False)):
            run.sort(key=order_of)
    schema = _SCHEMA.append(pa.field("part", pa.int64())).append(pa.field("nth", pa.int64()))
    place = TaskContext.get().partitionId() if TaskContext.get() else 0
    out = []
    for n, entry in enumerate(LoserTree([iter(r) for r in pieces.values()])):
        out.append((*entry, place, n))
        if len(out) == OUT_ROWS:
            yield _batch(out, schema)
            out = []
    yield _batch(out, schema)


def capture_index(runs: DataFrame) -> DataFrame:
    """All captures with ``capture_order``, their place in the global order by
    URL key, time and page (0, 1 ...). The ranges cut through a URL with many
    captures, so no key has to fit in one task; a range begins behind as many
    captures as the ranges before it hold (a number for each)."""
    order = ["urlkey", "captured", F.col("page_id").asc_nulls_last(), "archive", "offset"]
    merged = written(runs.repartitionByRange(*order).mapInArrow(_merge, f"{ENTRY}, part long, nth long"), "warc-merged")
    sizes = merged.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    return merged.join(F.broadcast(begins), "part").withColumn("capture_order", F.col("begin") + F.col("nth")).drop(
        "part", "nth", "begin")


def archive_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives under ``path`` (default:
    a new scratch folder), read them back and return the merged index.

    A null html is an empty payload; a null url an empty URI; a null page_id
    stays null, sorts last and is the response only of payloads without any
    page_id. Rows repeated with one page_id are records each, all responses
    where that page is the smallest. Blanks and control characters of a URL
    are written as %20. No pages give an empty index. Other columns are not
    read."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "llm", "warc")
    write_archives(pages, path)
    return capture_index(index_runs(spark, path))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "captured", "capture_order")


SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p),
u AS (
  SELECT page_id, regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#:@]+)(:[0-9]+)?([/?][^#]*)?', ['host', 'port', 'tail']) AS x,
         strftime(make_timestamp((1704067200 + page_id % 1000000000) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS captured
  FROM pages),
k AS (
  SELECT page_id, captured, array_to_string(list_reverse(string_split(x.host, '.')), ',') || x.port || ')' ||
         CASE WHEN x.tail LIKE '/%' THEN x.tail ELSE '/' || x.tail END AS urlkey FROM u)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to, urlkey, captured,
       CAST(row_number() OVER (ORDER BY encode(urlkey), captured, page_id) - 1 AS BIGINT) AS capture_order
FROM f JOIN k USING (page_id)
"""
