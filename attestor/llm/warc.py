"""Web archives: WARC 1.1 files with revisit records, read back, and one globally ordered index over them.

An archive is written by Spark's text writer, one record a row: records are UTF-8 text that ends in two CRLF, which is
the writer's line separator, so the files are plain WARC and any file system Spark knows will do.
"""

from __future__ import annotations

import base64
import hashlib
import os
import tempfile
from collections.abc import Iterable, Iterator
from datetime import UTC, datetime, timedelta
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, new_path, ship, spread_join

END = "\r\n\r\n"
#: Date of capture 0; capture n is n seconds later.
EPOCH = datetime(2024, 1, 1, tzinfo=UTC)
#: Payloads shorter than this are always stored.
MIN_REVISIT = 0
#: Bytes of records a file holds at most, or else one record.
FILE_BYTES = 16 << 20
#: Bytes of index rows a merging task gets, about; at least so many rows, where the session shuffles to more tasks.
RANGE_BYTES, RANGE_ROWS = 128 << 20, 20_000
#: Index rows that a merging task sorts in memory at a time, rows of a batch it spills, and runs it merges at once.
BLOCK_ROWS, BATCH_ROWS, FAN_IN = 16_384, 512, 64


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """Sort-friendly key: host labels reversed, without www and port 80 or 443, then path and query; lower case."""
    try:
        parts = urlsplit((url or "").strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return (url or "").strip().lower()
    host = host.removeprefix("www.")
    port_text = f":{port}" if port and port not in (80, 443) else ""
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{port_text}){parts.path or '/'}{query}".lower()


def _id(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def record(page: int | None, url: str | None, html: str, original: int | None) -> str:
    """One record without its closing END; a revisit, with the original's id and no payload, where original is given."""
    payload = html.encode("utf-8", "surrogatepass")
    at = (EPOCH + timedelta(seconds=(page or 0) % 2**31)).strftime("%Y-%m-%dT%H:%M:%SZ")
    revisit = original is not None
    head = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    http = "\r\n".join(head) + END + ("" if revisit else html)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_id(page)}",
        f"WARC-Date: {at}",
        *([f"WARC-Target-URI: {' '.join(url.split())}"] if url else []),
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        *([f"WARC-Refers-To: {_id(original)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http.encode('utf-8', 'surrogatepass'))}",
    ]
    return "\r\n".join(lines) + END + http


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and the file of the task that each belongs to: a new file begins where a record would pass FILE_BYTES."""
    file, filled = 0, 0
    for batch in batches:
        out, files = [], []
        for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "original")), strict=True):
            out.append(record(*row))
            size = len(out[-1].encode("utf-8", "surrogatepass")) + len(END)
            if filled and filled + size > FILE_BYTES:
                file, filled = file + 1, 0
            filled += size
            files.append(file)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(files, pa.int32())], ["value", "file"])


def write_archives(pages: DataFrame, path: str) -> None:
    """A record per row of pages(page_id, url, html) under path. Null html is an empty payload, null url no target.

    Of rows with equal payloads the one with the largest page_id is the response, the others refer to it. Rows without a
    page_id are responses; so is each row of a largest page_id that comes twice.
    """
    spark = pages.sparkSession
    ship(spark)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    pages = pages.withColumn("hash", F.sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html"))
    newest = pages.where(f"size >= {MIN_REVISIT}").groupBy("hash").agg(F.max("page_id").alias("newest"), F.count("page_id").alias("n")).where("n > 1")
    newest = materialize(newest.select("hash", "newest"), "newest")
    rows = spread_join(pages, newest, "hash", F.col("page_id"), "left")
    rows = rows.withColumn("original", F.expr("if(page_id < newest, newest, null)")).select("page_id", "url", "html", "original")
    # a folder for the first file of every task, one for the second, and so on: files are filled by bytes, whatever the pages' sizes
    rows.mapInArrow(_records, "value string, file int").write.partitionBy("file").option("lineSep", END).text(path)


def parse(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of each record, by its Content-Length, so payloads may hold anything."""
    at = 0
    while at < len(data):
        end = data.index(END.encode(), at)
        lines = data[at:end].decode("utf-8", "surrogatepass").split("\r\n")
        head = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start = end + len(END)
        stop = start + int(head["content-length"])
        yield at, head, data[start:stop]
        at = stop + len(END)


_INDEX = pa.schema([("run", pa.string()), ("i", pa.int64()), ("url_key", pa.string()), ("timestamp", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("offset", pa.int64())])


def _number(urn: str | None) -> int | None:
    text = (urn or "")[len("<urn:page:") : -1]
    return int(text) if text else None


def _order(row: tuple) -> tuple:
    return row[2], row[3], row[4] is not None, row[4] or 0


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * len(_INDEX)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _INDEX, strict=True)], schema=_INDEX)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted run of index rows for each archive file."""
    for batch in batches:
        for path, data in zip(batch.column("path"), batch.column("content"), strict=True):
            name, rows = path.as_py(), []
            for at, head, block in parse(data.as_buffer().to_pybytes()):
                http, _, body = block.partition(END.encode())
                revisit = head["warc-type"] == "revisit"
                size = int(http.rpartition(b"Content-Length: ")[2].split(b"\r\n")[0]) if revisit else len(body)
                said = head["warc-payload-digest"].partition(":")[2]
                if not revisit and digest(body) != said:
                    raise ValueError(f"{name}, {at}: the payload doesn't have its digest")
                rows.append((name, 0, url_key(head.get("warc-target-uri")), head["warc-date"], _number(head["warc-record-id"]), head.get("warc-target-uri"), head["warc-type"], _number(head.get("warc-refers-to")), size, said, at))
            rows.sort(key=_order)
            yield _rows([(r[0], i, *r[2:]) for i, r in enumerate(rows)])


class LoserTree:
    """k-way merge of sorted runs, each read as it is used up: inner nodes keep the loser of their match, the overall winner
    stands at the root.
    """

    def __init__(self, runs: Iterable[Iterable[tuple]]):
        self.runs = [iter(r) for r in runs]
        self.head = [next(r, None) for r in self.runs]
        self.order = [h and _order(h) for h in self.head]
        self.node = [-1] * max(1, len(self.runs))  # node 0: winner
        for leaf in range(len(self.runs)):
            self._play(leaf, building=True)

    def _less(self, a: int, b: int) -> bool:
        if self.head[a] is None or self.head[b] is None:
            return self.head[a] is not None
        return (self.order[a], a) < (self.order[b], b)

    def _play(self, leaf: int, building: bool = False) -> None:
        winner, at = leaf, (leaf + len(self.runs)) // 2
        while at > 0:
            if building and self.node[at] < 0:
                self.node[at] = winner
                return
            if self._less(self.node[at], winner):
                self.node[at], winner = winner, self.node[at]
            at //= 2
        self.node[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.runs:
            run = self.node[0]
            row = self.head[run]
            if row is None:
                return
            yield row
            self.head[run] = row = next(self.runs[run], None)
            self.order[run] = row and _order(row)
            self._play(run)


def _sliced(rows: Iterable[tuple], size: int) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) >= size:
            yield _rows(out)
            out = []
    if out:
        yield _rows(out)


def _tuples(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


class Spill:
    """Sorted runs in a file of the task's own, that goes with the task; a lost task makes it anew."""

    def __init__(self) -> None:
        # where Spark itself spills on this executor
        self.file = tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)
        self.runs: list[list[tuple[int, int]]] = []

    def write(self, rows: Iterable[tuple]) -> None:
        places = []
        for batch in _sliced(rows, BATCH_ROWS):
            data = batch.serialize()
            self.file.seek(0, 2)
            places.append((self.file.tell(), data.size))
            self.file.write(data)
        self.runs.append(places)

    def read(self, places: list[tuple[int, int]]) -> Iterator[tuple]:
        for at, size in places:
            self.file.seek(at)
            yield from _tuples([pa.ipc.read_record_batch(self.file.read(size), _INDEX)])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index rows of one key range, in order of (run, i), into one ordered run: an external merge.

    The parts of runs that stand in a block are merged in memory and spilled as one run; then as many runs at a time as a
    tree may have are merged into longer ones, until one tree takes all. In memory are a block, or a batch of each run of a tree.
    """
    spill, block, last = Spill(), [], None

    def flush() -> None:
        nonlocal block, last
        spill.write(LoserTree(block))
        block, last = [], None

    n = 0
    for row in _tuples(batches):
        if row[0] != last:
            last = row[0]
            block.append([])
        block[-1].append(row)
        n += 1
        if n % BLOCK_ROWS == 0:
            flush()
    if block:
        flush()
    while len(spill.runs) > FAN_IN:
        runs, spill.runs = spill.runs, []
        for k in range(0, len(runs), FAN_IN):
            spill.write(LoserTree(map(spill.read, runs[k : k + FAN_IN])))
    yield from _sliced(LoserTree(map(spill.read, spill.runs)), 10_000)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Capture index of the archives under path, in global order of url_key, timestamp and page_id.

    Each file gives a locally sorted run; the runs are dealt to key ranges, which split hot keys by time and id, and each
    range merges its parts of the runs with loser trees, from and to a file of the task beyond what memory holds. The ranges
    follow each other. Payload digests are verified.
    """
    ship(spark)
    kinds = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'string'}" for f in _INDEX)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    runs = materialize(files.mapInArrow(_runs, kinds), "runs")
    told = F.coalesce(F.octet_length("url"), F.lit(0)) + F.octet_length("url_key") + F.octet_length("run") + 120
    n, size = runs.agg(F.count("*"), F.coalesce(F.sum(told), F.lit(0))).first()
    parts = max(1, -(-size // RANGE_BYTES), min(-(-n // RANGE_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    ranges = runs.repartitionByRange(parts, "url_key", "timestamp", "page_id")
    return ranges.sortWithinPartitions("run", "i").mapInArrow(_merge, kinds)


def archive(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the archives of pages, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to, url_key, timestamp."""
    path = path or new_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_index(pages.sparkSession, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "timestamp")
