"""Files fetched from addresses by tasks: a row an address, written whole or not at all.

Addresses are rows and not options of a reader, so no list of them passes through the driver. They are dealt out by host, and a host's are fetched by
one task after the other's, `at_once` tasks in all. An answer goes to its place in pieces of `piece` bytes, so no file is ever held."""

from __future__ import annotations

import hashlib
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from http.client import HTTPException

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Fetch:
    """attempts: of an address. wait: seconds after the first failure, doubled after each. tail: bytes in which a PDF must end."""

    attempts: int = 4
    timeout: float = 120.0
    wait: float = 1.0
    piece: int = 1 << 20
    tail: int = 4096
    agent: str = "sylvan/1"


def _once(store: fs.FileSystem, to: str, url: str, conf: Fetch) -> tuple[int, str]:
    """Bytes and digest of what was written beside `to`; raises where the answer isn't whole."""
    size, digest, head, tail = 0, hashlib.sha256(), b"", b""
    request = urllib.request.Request(url, headers={"User-Agent": conf.agent})
    with urllib.request.urlopen(request, timeout=conf.timeout) as answer, store.open_output_stream(to) as out:
        expected = answer.headers.get("Content-Length") or ""
        while piece := answer.read(conf.piece):
            out.write(piece)
            digest.update(piece)
            size, head, tail = size + len(piece), (head + piece)[:4], (tail + piece)[-conf.tail :]
    if expected.isdigit() and size != int(expected):
        raise OSError(f"answer is cut off: {size} of {expected} bytes")
    if to.rpartition(".part-")[0].lower().endswith(".pdf") and (head != b"%PDF" or b"%%EOF" not in tail):
        raise OSError("no whole PDF")
    return size, digest.hexdigest()


def fetched(addresses: DataFrame, folder: str, conf: Fetch = Fetch(), at_once: int | None = None) -> DataFrame:
    """`addresses(url, path)` to `(url, path, bytes, sha256, attempts, problem)`, paths relative to `folder`. An address without a good answer has a problem and no
    file. Nothing is fetched until the rows are read, so keep them as a table; a task that runs again replaces whole files by whole files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            rows = []
            for url, path in zip(batch.column("url").to_pylist(), batch.column("path").to_pylist(), strict=True):
                to, found, problem, attempt = f"{root}/{path}", (None, None), "no address", 0
                while url and attempt < conf.attempts:
                    beside = f"{to}.part-{uuid.uuid4().hex[:12]}"
                    attempt += 1
                    try:
                        store.create_dir(to.rpartition("/")[0], recursive=True)
                        found, problem = _once(store, beside, url, conf), None
                        store.move(beside, to)
                        break
                    except (OSError, HTTPException, ValueError) as error:  # URLError and time-outs are OSErrors
                        problem = f"{type(error).__name__}: {error}"[:1000]
                        if store.get_file_info(beside).type == fs.FileType.File:
                            store.delete_file(beside)
                        if attempt < conf.attempts:
                            time.sleep(conf.wait * 2 ** (attempt - 1))
                rows.append((url, path, *found, attempt, problem))
            kinds = {"url": pa.string(), "path": pa.string(), "bytes": pa.int64(), "sha256": pa.string(), "attempts": pa.int32(), "problem": pa.string()}
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds.values())], list(kinds))

    host = F.regexp_extract("url", r"^[a-zA-Z]+://([^/?#]*)", 1)
    rows = addresses.select("url", "path").withColumn("host", host)
    rows = rows.repartition(at_once, "host") if at_once else rows.repartition("host")
    return rows.select("url", "path").mapInArrow(run, "url string, path string, bytes long, sha256 string, attempts int, problem string")
