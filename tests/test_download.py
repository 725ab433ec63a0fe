"""Downloads from a server that cuts, delays and fails."""

import hashlib
import threading
import time
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from sylvan.sources.download import Fetch, fetched

PDF = b"%PDF-1.4\n" + b"x" * 3_000_000 + b"\n%%EOF\n"


@pytest.fixture(scope="module")
def server():
    seen = Counter()

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            seen[self.path] += 1
            n = seen[self.path]
            if self.path == "/late.txt" and n == 1:
                time.sleep(3)
            if self.path == "/gone.txt" or self.path == "/second.txt" and n == 1:
                return self.send_error(503 if self.path == "/second.txt" else 404)
            body = {"/cut.pdf": PDF, "/good.pdf": PDF, "/notail.pdf": PDF[:-8]}.get(self.path, b"text of " + self.path.encode())
            self.send_response(200)
            if self.path != "/long.txt":
                self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body[:1000] if self.path == "/cut.pdf" and n < 3 else body)

        def log_message(self, *_):
            pass

    http = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=http.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{http.server_port}", seen
    http.shutdown()


def test_addresses_are_fetched_whole_or_not_at_all(spark, server, tmp_path):
    at, seen = server
    names = ["good.pdf", "cut.pdf", "notail.pdf", "gone.txt", "second.txt", "late.txt", "long.txt"]
    rows = [(f"{at}/{n}", f"p-{i}/{n}") for i, n in enumerate(names)] + [(None, "none"), ("nonsense", "x/y"), ("http://127.0.0.1:1/closed", "z")]
    frame = spark.createDataFrame(rows, "url string, path string")
    got = {r.path.rpartition("/")[2]: r for r in fetched(frame, f"file://{tmp_path}", Fetch(attempts=3, timeout=1.0, wait=0.05), at_once=2).collect()}
    assert len(got) == len(rows)
    assert {k: r.attempts for k, r in got.items()} == {"good.pdf": 1, "cut.pdf": 3, "notail.pdf": 3, "gone.txt": 3, "second.txt": 2, "late.txt": 2, "long.txt": 1, "none": 0, "y": 3, "closed" if "closed" in got else "z": 3}
    assert {k for k, r in got.items() if r.problem is None} == {"good.pdf", "cut.pdf", "second.txt", "late.txt", "long.txt"}
    assert got["cut.pdf"].bytes == len(PDF) and got["cut.pdf"].sha256 == hashlib.sha256(PDF).hexdigest() == got["good.pdf"].sha256
    assert "no whole PDF" in got["notail.pdf"].problem and "404" in got["gone.txt"].problem and got["none"].problem == "no address"
    left = {str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*") if p.is_file()}
    assert left == {"p-0/good.pdf", "p-1/cut.pdf", "p-4/second.txt", "p-5/late.txt", "p-6/long.txt"}
    assert (tmp_path / "p-1/cut.pdf").read_bytes() == PDF and (tmp_path / "p-6/long.txt").read_bytes() == b"text of /long.txt"
