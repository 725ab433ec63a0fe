"""Files written by tasks: texts, JSON and copies, each whole or not at all, with what was written as a table."""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pretty_json(value: Column, sort: bool = False) -> Column:
    """A struct's or variant's JSON with two blanks a level and a line break at the end; `sort` puts a struct's fields in order."""
    text = F.to_json(value, {"pretty": "true"})
    return F.concat(F.regexp_replace(text, r'(?m)^(\s*"(?:[^"\\]|\\.)*") : ', r"$1: "), F.lit("\n"))


def write_files(rows: DataFrame, folder: str, overwrite: bool = False) -> DataFrame:
    """`rows(path, content)`, paths relative to `folder`, as files, with an octal `mode` if rows have one and the store knows modes: each is written beside its place and renamed, so a task that is lost or
    run twice leaves whole files only. A path that ends in a slash is a folder; folders above files with a mode are 755. Gives `(path, bytes, sha256)`; nothing is written until that is read, so keep it as a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            out = []
            for path, content, mode in zip(*(batch.column(c).to_pylist() for c in ("path", "content", "mode")), strict=True):
                content = content or b""
                to = f"{root}/{path}"
                above = to.rpartition("/")[0]
                if path.endswith("/"):
                    store.create_dir(above, recursive=True)
                elif not overwrite and store.get_file_info(to).type != fs.FileType.NotFound:
                    with store.open_input_stream(to) as f:
                        if f.read() != content:
                            raise FileExistsError(path)
                else:
                    store.create_dir(above, recursive=True)
                    beside = f"{to}.{uuid.uuid4().hex[:12]}"
                    with store.open_output_stream(beside) as f:
                        f.write(content)
                    if mode and isinstance(store, fs.LocalFileSystem):
                        os.chmod(beside, int(mode, 8))
                    store.move(beside, to)
                while mode and isinstance(store, fs.LocalFileSystem) and len(above) > len(root):
                    os.chmod(above, 0o755)
                    above = above.rpartition("/")[0]
                out.append((path, len(content), hashlib.sha256(content).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string()))], ["path", "bytes", "sha256"])

    mode = F.col("mode") if "mode" in rows.columns else F.lit(None).cast("string")
    return rows.select("path", F.col("content").cast("binary").alias("content"), mode.alias("mode")).mapInArrow(run, "path string, bytes long, sha256 string")


def write_stages(rows: DataFrame, folder: str) -> None:
    """`rows(paper_id, stage, call, answer)` as JSON lines, a folder for each paper and stage."""
    rows.select("paper_id", "stage", "call", "answer").write.mode("overwrite").partitionBy("paper_id", "stage").json(folder)


def reward_files(records: DataFrame) -> DataFrame:
    """`records(submission_id, score, ...)` to `(path, content)` for `write_files`: a record's JSON with its keys in order, and its score alone."""
    named = sorted(c for c in records.columns if c != "submission_id")
    files = F.array(
        F.struct(F.lit("reward.json").alias("name"), pretty_json(F.struct(*named)).alias("text")), F.struct(F.lit("reward.txt").alias("name"), F.concat(F.col("score").cast("string"), F.lit("\n")).alias("text"))
    )
    return records.select("submission_id", F.explode(files).alias("f")).select(F.concat_ws("/", "submission_id", "f.name").alias("path"), F.encode("f.text", "utf-8").alias("content"))
