"""WARC archives of pages: writing, reading back, and the merged capture index."""

from __future__ import annotations

import hashlib
import io
import zlib
from collections.abc import Iterator
from math import ceil
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from halfstar.session import materialise, scratch_path

#: Smaller payloads are stored each time.
MIN_REVISIT = 100
#: Records per archive file, and index entries one merging task holds.
FILE_RECORDS, RANGE_ENTRIES = 50_000, 50_000
END = "\r\n\r\n"
#: Profile of a revisit record; capture times where pages have none count seconds from here.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIRST_CAPTURE = 1577836800


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _identity(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def capture_time() -> Column:
    """``yyyyMMddHHmmss`` of a page: the id in seconds after a fixed moment."""
    seconds = F.lit(FIRST_CAPTURE) + F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(10 * 365 * 86400))
    return F.date_format(F.to_utc_timestamp(F.timestamp_seconds(seconds), F.current_timezone()), "yyyyMMddHHmmss")


def _key(page: Column, digest: Column) -> Column:
    return F.concat_ws(":", F.coalesce(page.cast("string"), F.lit("none")), digest)


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """``(page_id, url, time, payload, bytes, digest, refers_to)`` per row of ``pages``.

    Equal payloads are found on digests alone, with map-side minima; the pages
    themselves move once, by page, so a payload that a third of the pages share
    meets in no task.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select(
        "page_id",
        "url",
        capture_time().alias("time"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("bytes"),
        F.sha2(payload, 256).alias("digest"),
    )
    slim = materialise(base.filter(F.col("bytes") >= min_bytes).select("page_id", "digest"), "warc-digests")
    firsts = slim.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    firsts = firsts.filter((F.col("n") > 1) & F.col("first").isNotNull()).drop("n")
    again = slim.join(firsts, "digest").filter(~F.col("page_id").eqNullSafe(F.col("first")))
    again = again.select(_key(F.col("page_id"), F.col("digest")).alias("key"), F.col("first").alias("refers_to")).distinct()
    return (
        base.withColumn("key", _key(F.col("page_id"), F.col("digest"))).join(again, "key", "left").drop("key")
    )


def record(row_bytes: Column) -> Column:
    """The text of a record up to, not including, the two line ends that close it."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        row_bytes.cast("string"),
        F.lit(END),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    time = F.col("time")
    date = F.concat(
        *(x for a, b, c in ((1, 4, "-"), (5, 2, "-"), (7, 2, "T"), (9, 2, ":"), (11, 2, ":"), (13, 2, "Z")) for x in (F.substring(time, a, b), F.lit(c)))
    )
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _identity(F.col("page_id"))),
        _line("WARC-Date", date),
        _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("WARC-Profile", F.when(revisit, PROFILE)),
        _line("WARC-Refers-To", F.when(revisit, _identity(F.col("refers_to")))),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )


def write_archives(
    pages: DataFrame, path: str, *, compression: str = "gzip", file_records: int = FILE_RECORDS, min_bytes: int = MIN_REVISIT
) -> None:
    """Write one WARC/1.1 record per row of ``pages(page_id, url, html)`` below ``path``.

    Of records with equal payloads of ``min_bytes`` or more, that with the
    smallest page_id is a response, the others revisit it without the payload;
    rows that share this page_id are responses alike, and where all ids are
    null every record is a response. Null html is an empty payload; a null url
    leaves the target out; line ends in a url are percent-encoded.

    A record is a line of Spark's text writer whose line end is the two CRLF
    that close a record, so files go through Spark's committer to any store
    and a lost executor costs a rewritten file. Content-Length rules on
    reading, so payloads may hold such line ends themselves.
    """
    records = with_revisits(pages, min_bytes).select(record(F.col("bytes")).alias("value"))
    writer = records.write.option("lineSep", END).option("compression", compression)
    writer.option("maxRecordsPerFile", file_records).text(path)


# --- reading ---------------------------------------------------------------------------


def parse(stream) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of every record of a binary stream."""
    while True:
        offset = stream.tell()
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record at {offset}: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError(f"record at {offset} is cut off")
        yield offset, headers, block


def url_key(url: str) -> str:
    """Host labels reversed, without scheme, leading ``www`` and fragment, in lower case; path and query."""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").lower().removeprefix("www.")
        port = f":{parts.port}" if parts.port not in (None, 80, 443) else ""
    except ValueError:  # not a URL: sorts by its own text
        return url.strip().lower()
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{port}){(parts.path or '/').lower()}{query.lower()}"


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return None if number in ("", "none") else int(number)


_ENTRY = (
    "url_key string, time string, page_id long, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, file string, offset long, length long"
)
_NAMES = [c.split()[0] for c in _ENTRY.split(", ")]
_TYPES = {"string": pa.string(), "long": pa.int64()}
_ARROW = pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in _ENTRY.split(", ")])


def _entry(file: str, offset: int, headers: dict[str, str], block: bytes) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha256:")
    if kind == "response":
        size = len(payload)
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"payload at {offset} of {file} does not match its digest")
    else:  # the length of the payload it refers to
        size = int(head.lower().rpartition(b"content-length:")[2])
    time = "".join(c for c in headers["warc-date"] if c.isdigit())
    return (
        url_key(headers.get("warc-target-uri", "")), time, _page(headers["warc-record-id"]), kind, size, digest,
        _page(headers.get("warc-refers-to")), file, offset, len(block),
    )


def _order(entry: tuple) -> tuple:
    """URL key, time, page (null last), then place."""
    return entry[0], entry[1], entry[2] is None, entry[2] or 0, entry[7], entry[8]


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """The index entries of every archive file, each file a locally sorted run.

    ``run`` names the file, ``place`` numbers its entries in sorted order.
    ``offset`` counts bytes of the uncompressed stream.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name, content = batch.column("path")[i].as_py(), batch.column("content")[i].as_py()
                stream = io.BufferedReader(_Gunzip(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
                short = name.rsplit("/", 1)[-1]
                entries = sorted((_entry(short, *found) for found in parse(stream)), key=_order)
                for at in range(0, len(entries), 10_000):
                    part = entries[at : at + 10_000]
                    columns = [pa.array(c, f.type) for c, f in zip(zip(*part), _ARROW)]
                    place = pa.array(range(at, at + len(part)), pa.int64())
                    yield pa.RecordBatch.from_arrays([*columns, place], [*_NAMES, "place"])

    return files.mapInArrow(run, f"{_ENTRY}, place long")


class _Gunzip(io.RawIOBase):
    """A gzip stream read forwards, however many members it has, holding little."""

    def __init__(self, content: bytes):
        self.data, self.at, self.out, self.done = memoryview(content), 0, b"", 0
        self.inflate = zlib.decompressobj(31)

    def readable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.done

    def readinto(self, buffer) -> int:
        while not self.out and (self.at < len(self.data) or self.inflate.unconsumed_tail):
            tail = self.inflate.unconsumed_tail
            if not tail:
                tail = self.data[self.at : self.at + (1 << 18)]
                self.at += len(tail)
            self.out = self.inflate.decompress(tail, 1 << 20)
            if self.inflate.eof:
                self.at -= len(self.inflate.unused_data)
                self.inflate = zlib.decompressobj(31)
        n = min(len(buffer), len(self.out))
        buffer[:n], self.out = self.out[:n], self.out[n:]
        self.done += n
        return n


# --- merging -----------------------------------------------------------------------------


def loser_tree_merge(runs: list[list], key) -> Iterator:
    """Merge sorted runs: inner nodes keep losers, so each entry replays one path to the root."""
    k = len(runs)
    heads = [key(r[0]) if r else None for r in runs]
    places = [0] * k
    losers = [-1] * max(k, 1)

    def beats(a: int, b: int) -> bool:
        """Ended runs lose; ties go to the earlier run."""
        if heads[a] is None or heads[b] is None:
            return heads[b] is None and (heads[a] is not None or a < b)
        return heads[a] < heads[b] or (heads[a] == heads[b] and a < b)

    def play(node: int) -> int:
        if node >= k:
            return node - k
        left, right = play(2 * node), play(2 * node + 1)
        winner, losers[node] = (left, right) if beats(left, right) else (right, left)
        return winner

    winner = play(1) if k > 1 else 0
    while k and heads[winner] is not None:
        run, at = runs[winner], places[winner]
        yield run[at]
        places[winner] = at + 1
        heads[winner] = key(run[at + 1]) if at + 1 < len(run) else None
        node = (winner + k) // 2
        while node:
            if beats(losers[node], winner):
                winner, losers[node] = losers[node], winner
            node //= 2


def merge_runs(runs: DataFrame, entries: int = RANGE_ENTRIES) -> DataFrame:
    """The index in global order: partitions are ranges of it, each in order.

    Ranges are cut on URL key, time, page and place in the archives, so a URL
    that holds a third of all captures spreads over ranges. A task holds about
    ``entries`` entries: the segments of all runs in its range, which a loser
    tree merges.
    """
    written = materialise(runs, "warc-runs")
    ranges = max(1, ceil(written.count() / entries))
    dealt = written.repartitionByRange(
        ranges, "url_key", "time", F.col("page_id").asc_nulls_last(), "file", "offset"
    ).sortWithinPartitions("file", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments: dict[str, list[tuple]] = {}
        for batch in batches:
            for entry in zip(*(batch.column(c).to_pylist() for c in _NAMES)):
                segments.setdefault(entry[7], []).append(entry)
        held = []
        for entry in loser_tree_merge(list(segments.values()), _order):
            held.append(entry)
            if len(held) == 10_000:
                yield _batch(held)
                held = []
        if held:
            yield _batch(held)

    return dealt.mapInArrow(run, _ENTRY)


def _batch(entries: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*entries), _ARROW)], _NAMES)


def capture_index(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``pages`` as WARC below ``path`` (a new folder of the shared one, if not given), read
    the archives back, and return their merged index: capture histories by URL key, then time.

    One row per page. An empty table gives an empty index. Repeated pages are
    records of their own. Other columns are not read.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, **options)
    return merge_runs(capture_runs(spark, path))


ORACLE_SQL = """
select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest,
       case when octet_length(encode(coalesce(html, ''))) >= 100
             and page_id <> min(page_id) over (partition by coalesce(html, '')) then 'revisit' else 'response' end as record_type,
       case when octet_length(encode(coalesce(html, ''))) >= 100
             and page_id <> min(page_id) over (partition by coalesce(html, ''))
            then min(page_id) over (partition by coalesce(html, '')) end as refers_to
from pages
"""
