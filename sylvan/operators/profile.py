"""Profiles of file sets: kinds, scopes, sizes, digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .evidence import suffix

#: Kinds by suffix, in order of report, and scopes by top folder.
KINDS = {
    "json": ("json",), "image": ("png", "jpg", "jpeg", "gif", "webp", "svg"), "pdf": ("pdf",), "text": ("md", "txt", "yaml", "yml", "toml", "csv", "tsv", "rst", "log", "html", "tex"),
    "code": ("py",), "shell": ("sh",), "archive": ("zip", "gz", "tgz", "tar", "bz2", "xz"), "binary": (),
}
SCOPES = {"environment": "visible", "tests": "hidden_or_solution", "solution": "hidden_or_solution"}


def kind(path: Column) -> Column:
    out = F.lit("binary")
    for name, suffixes in KINDS.items():
        if suffixes:
            out = F.when(suffix(path).isin(*suffixes), name).otherwise(out)
    return out


def scope(path: Column) -> Column:
    top = F.element_at(F.split(path, "/"), 1)
    out = F.lit("package")
    for folder, name in SCOPES.items():
        out = F.when(top == folder, name).otherwise(out)
    return out


def data_profile(files: DataFrame) -> DataFrame:
    """`files(set_id, path, bytes)` to one row a set: totals, and files and bytes by kind and by scope as maps. One
    pass over the files; only sums a set, kind and scope are shuffled."""
    cells = files.withColumns({"kind": kind(F.col("path")), "scope": scope(F.col("path"))}).groupBy("set_id", "kind", "scope").agg(F.count("*").alias("n"), F.sum("bytes").alias("b"))
    pick = lambda column, name, value: F.coalesce(F.sum(F.when(F.col(column) == name, F.col(value))), F.lit(0))
    table = lambda column, names, value: F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*(pick(column, n, value) for n in names)))
    scopes = ("visible", "hidden_or_solution", "package")
    return cells.groupBy("set_id").agg(
        F.sum("n").alias("files"), F.sum("b").alias("bytes"), table("kind", KINDS, "n").alias("kind_counts"), table("kind", KINDS, "b").alias("kind_bytes"),
        table("scope", scopes, "n").alias("scope_counts"), table("scope", scopes, "b").alias("scope_bytes"),
    )


def largest(files: DataFrame, n: int = 10) -> DataFrame:
    return files.orderBy(F.col("bytes").desc(), "path").limit(n)


def digests(files: DataFrame) -> DataFrame:
    return files.withColumn("sha256", F.sha2(F.col("content"), 256))


def fingerprint(files: DataFrame, digits: int = 40) -> DataFrame:
    """`files(set_id, label, content)` to a digest over the labelled contents in order of label, of equal labels by content. A set's rows pass one after
    the other through the digest, so no more than a batch of contents is held, however large a set is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, ids, done = None, None, [], []
        for batch in batches:
            for set_id, label, content in zip(*(batch.column(c) for c in ("set_id", "label", "content")), strict=True):
                set_id = set_id.as_py()
                if state is None or set_id != now:
                    if state is not None:
                        ids.append(now)
                        done.append(state.hexdigest()[:digits])
                    now, state = set_id, hashlib.sha256()
                state.update((label.as_py() or "").encode() + b"\0")
                state.update(memoryview(content.as_buffer()) if content.is_valid else b"")
                state.update(b"\0")
        if state is not None:
            ids.append(now)
            done.append(state.hexdigest()[:digits])
        yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(done, pa.string())], ["set_id", "fingerprint"])

    rows = files.select("set_id", "label", F.col("content").cast("binary").alias("content"))
    kind = to_arrow_type(rows.schema["set_id"].dataType)
    return rows.repartition("set_id").sortWithinPartitions("set_id", "label", F.sha2("content", 256)).mapInArrow(run, f"set_id {rows.schema['set_id'].dataType.simpleString()}, fingerprint string")


def resource_class(accelerator: Column, notes: Column) -> Column:
    """What a described machine suits."""
    gpu = r"gpu|h200|a100|h100"
    a, both = F.lower(F.coalesce(accelerator, F.lit(""))), F.lower(F.concat_ws(" ", F.coalesce(accelerator, F.lit("")), F.coalesce(notes, F.lit(""))))
    return F.when(F.contains(a, F.lit("cpu")) & ~a.rlike(gpu), "cpu_sufficient").when(both.rlike(gpu), "gpu_relevant").otherwise("gpu_required_likely")


#: Fields of a stored profile, as maps of counts or single numbers.
PROFILE_MAPS = {"kind_counts": "kind_counts", "kind_bytes": "kind_bytes", "scope_file_counts": "scope_counts", "scope_bytes": "scope_bytes"}
PROFILE_TOTALS = {"file_count": "files", "total_bytes": "bytes"}


def profile_json(files: DataFrame) -> DataFrame:
    """`files(set_id, path, bytes)` to `(set_id, json)`: the profile as it is stored."""
    named = [F.col(c).alias(n) for n, c in sorted({**PROFILE_MAPS, **PROFILE_TOTALS}.items())]
    return data_profile(files).select("set_id", F.to_json(F.struct(*named)).alias("json"))


def largest_by_set(files: DataFrame, n: int = 10) -> DataFrame:
    """`files(set_id, path, bytes)` to `(set_id, place, path, bytes)`: the `n` largest of each set, equal ones by path. Spark keeps
    `n` rows a set and task before it shuffles."""
    place = F.row_number().over(Window.partitionBy("set_id").orderBy(F.col("bytes").desc(), "path"))
    return files.select("set_id", place.alias("place"), "path", "bytes").filter(F.col("place") <= n)


def whole_profile_json(files: DataFrame) -> DataFrame:
    """`files(set_id, path, bytes)` to `(set_id, json, bytes, files, kinds)`: the stored profile with the kinds that occur, in order of report, and the ten
    largest files by kind, scope and size."""
    top = largest_by_set(files).withColumn("row", F.struct("place", kind(F.col("path")).alias("kind"), scope(F.col("path")).alias("scope"), "bytes"))
    largest_files = F.transform(F.array_sort(F.collect_list("row")), lambda r: F.struct(r["kind"].alias("kind"), r["scope"].alias("scope"), r["bytes"].alias("bytes")))
    rows = data_profile(files).join(top.groupBy("set_id").agg(largest_files.alias("largest_files")), "set_id")
    kinds = F.filter(F.array(*map(F.lit, KINDS)), lambda k: F.element_at("kind_counts", k) > 0)
    present = lambda c: F.map_filter(c, lambda k, _: F.array_contains("kinds", k))
    rows = rows.withColumn("kinds", kinds).withColumns({"kind_counts": present("kind_counts"), "kind_bytes": present("kind_bytes")})
    named = {n: F.col(c) for n, c in {**PROFILE_MAPS, **PROFILE_TOTALS}.items()} | {"data_kinds": F.col("kinds"), "table_shapes": F.array().cast("array<string>"), "largest_files": F.col("largest_files")}
    return rows.select("set_id", F.to_json(F.struct(*(c.alias(n) for n, c in sorted(named.items())))).alias("json"), "bytes", "files", "kinds")


def comparable(stored: Column) -> Column:
    """A stored profile's totals and maps, without zeros and in order, so that equal ones are equal; null where it isn't one."""
    get = lambda path, kind: F.try_variant_get(stored, path, kind)
    maps = (F.array_sort(F.map_entries(F.map_filter(get(f"$.{n}", "map<string,bigint>"), lambda k, v: v != 0))).alias(n) for n in PROFILE_MAPS)
    return F.struct(*maps, *(get(f"$.{n}", "bigint").alias(n) for n in PROFILE_TOTALS))
