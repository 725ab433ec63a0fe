"""WARC archives with revisit records, and a globally ordered capture index by external merge.

Every task writes its rows as gzip members into archive files in the shared folder, one WARC record each, and gives the
index entries of what it wrote as runs that are sorted by (URL key, timestamp, page). Runs are dealt by ranges of that
key and of the record's place, so that even captures of one URL spread over tasks, and there are as many ranges as keep each
within `run` entries or so; for each range a loser tree merges the pieces of all runs, which arrive in order. The ranges follow
each other, so the capture histories are ordered over all partitions. A task that is run again writes to new files, and
only files named in the committed index are ever read.

Payloads stay where they are: what decides between response and revisit is a table of the digests that occur twice or more,
which is broadcast up to `broadcast` rows of some 40 bytes; beyond that it is joined, and then payloads are shuffled once.

Of captures with equal payloads (`least` bytes or more) the one with the largest page_id is the response; the others
are revisits that name it and hold only headers. Nulls: a null html is an empty payload; a null url has the empty URL
key; control characters in a URL are percent-encoded, so that none can end a header line; a capture without a page_id is a revisit where another one has an id, else a response. Repeated rows of one
page_id are repeated records. Further columns are ignored; an empty table gives no rows."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import Workspace


@dataclass(frozen=True)
class Warc:
    """least: bytes from which equal payloads are revisits. roll: bytes after which a new archive file begins.
    run: index entries that a task sorts at once, and about as many that it merges. broadcast: see above."""

    least: int = 0
    roll: int = 64 << 20
    run: int = 200_000
    broadcast: int = 500_000


#: Captures without a time of their own follow each other by a second per page_id from this day on, for SPAN seconds.
EPOCH, SPAN = "2024-01-01", 10**9


def _stamp(page: Column) -> Column:
    """A UTC time from integers and a date alone: neither the session's zone nor the size of an id matters."""
    second = F.pmod(F.coalesce(page, F.lit(0)), F.lit(SPAN))
    two = lambda x: F.lpad(x.cast("int").cast("string"), 2, "0")
    day = F.date_add(F.lit(EPOCH).cast("date"), F.floor(second / 86400).cast("int")).cast("string")
    return F.concat(day, F.lit("T"), two(F.floor(second / 3600) % 24), F.lit(":"), two(F.floor(second / 60) % 60), F.lit(":"), two(second % 60), F.lit("Z"))


def url_key(url: Column | str) -> Column:
    """The host's labels reversed, then the path and query in lower case; scheme, port and fragment don't count."""
    url = F.lower(F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit("")))
    bare = F.regexp_replace(url, r"^[a-z][a-z0-9+.-]*://|#.*$", "")
    host = F.regexp_extract(bare, r"^([^/?:]*)", 1)
    rest = F.regexp_replace(bare, r"^[^/?:]*(:[0-9]+)?", "")
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(F.startswith(rest, F.lit("/")), rest).otherwise(F.concat(F.lit("/"), rest)))
    return F.when(url == "", F.lit("")).otherwise(key)


#: What may stand in no header value.
_CONTROL = {c: f"%{c:02X}" for c in (*range(32), 127)}


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str, stamp: str, kind: str, original: int | None, payload: bytes) -> bytes:
    """One WARC/1.1 record. A revisit's block is the response's HTTP header alone, which still tells the length."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>", f"WARC-Date: {stamp}",
        f"WARC-Target-URI: {url.translate(_CONTROL)}", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}", "Content-Type: application/http;msgtype=response",
    ]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{original}>"]
    block = http if kind == "revisit" else http + payload
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record; a response's payload is checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    length = int(next(x for x in http.decode().split("\r\n") if x.lower().startswith("content-length:")).split(":")[1])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and (len(body) != length or base32_sha1(body) != digest):
        raise ValueError("a payload that differs from its digest")
    number = lambda x: int(x) if (x := x.removeprefix("<urn:page:").removesuffix(">")) else None
    return {
        "page_id": number(fields["warc-record-id"]), "payload_bytes": length, "payload_digest": digest, "record_type": fields["warc-type"],
        "refers_to": number(fields["warc-refers-to"]) if "warc-refers-to" in fields else None, "url": fields["warc-target-uri"], "payload": body,
    }


_INDEX = "url_key string, stamp string, page_id long, run string, archive string, at long, size long"
_NAMES = [c.split()[0] for c in _INDEX.split(", ")]
_TYPES = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]


def _order(entry: tuple) -> tuple:
    return entry[0], entry[1], entry[2] is not None, entry[2] or 0


def _entries(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(_TYPES)], _NAMES)


def _writer(folder: str, conf: Warc):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        task = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
        out, name, at, files, entries, runs = None, "", 0, 0, [], 0
        for row in (row for batch in batches for a in range(0, batch.num_rows, 64) for row in batch.slice(a, 64).to_pylist()):
            if out is None:
                store.create_dir(root, recursive=True)
                name, at, files = f"{task}-{files:04d}.warc.gz", 0, files + 1
                out = store.open_output_stream(f"{root}/{name}", compression=None)
            data = gzip.compress(record(row["page_id"], row["url"] or "", row["stamp"], row["kind"], row["original"], (row["html"] or "").encode()), 1, mtime=0)
            out.write(data)
            entries.append((row["url_key"], row["stamp"], row["page_id"], f"{task}-{runs}", name, at, len(data)))
            at += len(data)
            if at >= conf.roll:
                out.close()
                out = None
            if len(entries) >= conf.run:
                yield _entries(sorted(entries, key=_order))
                entries, runs = [], runs + 1
        if out is not None:
            out.close()
        if entries:
            yield _entries(sorted(entries, key=_order))

    return run


class LoserTree:
    """k sorted lists as one: inner nodes keep the loser of their match, so each step replays one path to the root."""

    def __init__(self, runs: list[list[tuple]], key=_order):
        self.runs, self.key = runs, key
        self.at = [0] * len(runs)
        self.width = 1 << max(0, len(runs) - 1).bit_length()
        self.head = [self._head(i) for i in range(self.width)]
        self.loser = [0] * self.width
        self.winner = self._play(1)

    def _head(self, i: int) -> tuple:
        if i < len(self.runs) and self.at[i] < len(self.runs[i]):
            return (0, self.key(self.runs[i][self.at[i]]), i)
        return (1, (), i)  # a run that has ended loses to all others

    def _play(self, node: int) -> int:
        if node >= self.width:
            return node - self.width
        a, b = self._play(2 * node), self._play(2 * node + 1)
        if self.head[b] < self.head[a]:
            a, b = b, a
        self.loser[node] = b
        return a

    def __iter__(self) -> Iterator[tuple]:
        while not self.head[self.winner][0]:
            i = self.winner
            yield self.runs[i][self.at[i]]
            self.at[i] += 1
            self.head[i] = self._head(i)
            node = (i + self.width) // 2
            while node:
                other = self.loser[node]
                if self.head[other] < self.head[i]:
                    self.loser[node], i = i, other
                node //= 2
            self.winner = i


_MERGED = f"{_INDEX}, part int, place long"


def _merger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, place = TaskContext.get().partitionId(), 0
    pieces: list[list[tuple]] = []
    open_: dict[str, int] = {}
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in _NAMES), strict=True):
            at = open_.get(row[3])
            if at is None or _order(row) < _order(pieces[at][-1]):  # blocks of a run that arrive in another order are pieces
                open_[row[3]] = at = len(pieces)
                pieces.append([])
            pieces[at].append(row)

    def placed(rows: list[tuple]) -> pa.RecordBatch:
        batch = _entries(rows)
        where = [pa.array([part] * len(rows), pa.int32()), pa.array(range(place, place + len(rows)), pa.int64())]
        return pa.RecordBatch.from_arrays([*batch.columns, *where], [*_NAMES, "part", "place"])

    out = []
    for entry in LoserTree(pieces) if pieces else ():
        out.append(entry)
        if len(out) >= 20_000:
            yield placed(out)
            out, place = [], place + len(out)
    if out:
        yield placed(out)


def write(pages: DataFrame, folder: str, conf: Warc = Warc(), work: Workspace | None = None) -> DataFrame:
    """Write `pages(page_id, url, html[, stamp])` below `folder`; the index entries, in runs. Each run's order is that
    of its rows in the DataFrame."""
    work = work or Workspace(pages.sparkSession, "warc")
    html = F.coalesce("html", F.lit(""))
    page = F.col("page_id").cast("long")
    rows = pages.select(page.alias("page_id"), "url", html.alias("html"), (F.col("stamp") if "stamp" in pages.columns else _stamp(page)).alias("stamp"), url_key("url").alias("url_key"), F.sha1(html).alias("digest"))
    same = rows.filter(F.octet_length("html") >= conf.least).groupBy(F.col("digest").alias("same")).agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
    same = work.keep(same.filter("n > 1 and largest is not null").drop("n"), "same", pages.count())
    same = F.broadcast(same) if same.count() <= conf.broadcast else same.hint("merge")
    both = rows.join(same, F.col("digest") == F.col("same"), "left")
    own = (F.octet_length("html") < conf.least) | F.col("largest").isNull() | F.coalesce(F.col("page_id") == F.col("largest"), F.lit(False))
    kind = F.when(own, "response").otherwise("revisit")
    both = both.select("page_id", "url", "html", "stamp", "url_key", kind.alias("kind"), F.when(kind == "revisit", F.col("largest")).alias("original"))
    return both.mapInArrow(_writer(folder, conf), _INDEX)


def merge(index: DataFrame, conf: Warc = Warc()) -> DataFrame:
    """The runs, a written table, as one index, ordered by URL key, timestamp and page: `part` numbers the ranges, `place` the
    entries of one."""
    rows = index.count()
    # as many ranges as bound a task's entries, and up to the session's number of partitions where each still has some thousands
    n = max(1, -(-rows // conf.run), min(rows // 10_000, int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    own = index.withColumn("run", F.concat_ws("-", "run", F.spark_partition_id()))  # a run may be read in several tasks
    return own.repartitionByRange(n, "url_key", "stamp", F.col("page_id").asc_nulls_first(), "archive", "at").mapInArrow(_merger, _MERGED)


def read(index: DataFrame, folder: str) -> DataFrame:
    """The records that the index names, each archive from front to back: `(page_id, payload_bytes, payload_digest,
    record_type, refers_to, url_key, stamp)`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        name, source = "", None
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            rows = []
            for archive, at, size in zip(*(batch.column(c).to_pylist() for c in ("archive", "at", "size")), strict=True):
                if archive != name:
                    if source is not None:
                        source.close()
                    name, source = archive, store.open_input_file(f"{root}/{archive}")
                source.seek(at)
                rows.append(parse(zlib.decompress(source.read(size), 31)))
            yield pa.RecordBatch.from_arrays([*(pa.array([r[c] for r in rows], t) for c, t in zip(names, kinds, strict=True)), batch.column("url_key"), batch.column("stamp")], [*names, "url_key", "stamp"])
        if source is not None:
            source.close()

    near = index.repartition("archive").sortWithinPartitions("archive", "at")
    return near.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url_key string, stamp string")


def archive(pages: DataFrame, conf: Warc = Warc()) -> tuple[DataFrame, DataFrame, str]:
    """Archives of all pages, as (records read back, merged index, folder)."""
    work = Workspace(pages.sparkSession, "warc")
    folder = f"{work.path}/archives"
    runs = work.keep(write(pages, folder, conf, work), "runs")
    index = work.keep(merge(runs, conf), "index")
    return read(index, folder), index, folder


#: Base32 of the 20 digest bytes, five bits at a time: 40 hexadecimal digits are eight groups of five digits, each of
#: 20 bits and so of four letters.
_HEX = "(strpos('0123456789abcdef', substr(h, {i}, 1)) - 1)"
_GROUP = " + ".join(f"{_HEX.format(i=f'g * 5 + {k + 1}')} * {16 ** (4 - k)}" for k in range(5))
_LETTERS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v // {32 ** (3 - k)}) % 32) + 1, 1)" for k in range(4))
SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT DISTINCT h FROM p), n AS (SELECT h, unnest(range(8)) AS g FROM g), v AS (SELECT h, g, {_GROUP} AS v FROM n),
b AS (SELECT h, string_agg({_LETTERS}, '' ORDER BY g) AS payload_digest FROM v GROUP BY h),
m AS (SELECT h, max(page_id) AS largest FROM p GROUP BY h)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM p JOIN b USING (h) JOIN m USING (h)
"""
