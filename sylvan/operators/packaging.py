"""Batches of tasks: selection, ids, manifests, audits and staged publication."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed value: fields of a manifest row, in order.
MANIFEST_KEYS = (
    "artifact_paths", "benchmark", "competition_id", "metric", "paper_id", "promoted_public_data_paths", "removed_paths", "source_format", "source_seed_task_id",
    "source_task_dir", "source_task_key", "source_task_name", "task_id",
)


def task_id(batch: Column, paper: Column, label: str) -> Column:
    """`<batch>-<label>-<six digits of a digest of both>`."""
    return F.concat(batch, F.lit(f"-{label}-"), F.substring(F.sha2(F.concat_ws(":", batch, paper), 256), 1, 6))


def manifest(papers: DataFrame, batch: str, label: str, folder: str) -> DataFrame:
    """`papers(paper_id, source_index)` to manifest rows; a row's JSON has sorted keys and no blanks."""
    name = F.format_string(f"{label}-%04d", F.col("source_index").cast("int"))
    row = {
        "artifact_paths": F.array(F.lit("/submission")), "benchmark": F.lit(label), "competition_id": F.lit(""), "metric": F.lit("weighted_tree_score"), "paper_id": F.col("paper_id"),
        "promoted_public_data_paths": F.array().cast("array<string>"), "removed_paths": F.array(F.lit("environment/Dockerfile"), F.lit("tests/Dockerfile")),
        "source_format": F.lit(f"{label}_tree"), "source_seed_task_id": F.lit(""), "source_task_dir": F.concat(F.lit(f"{folder}/{batch}/"), name), "source_task_key": F.col("paper_id"),
        "source_task_name": F.concat(F.lit(f"{label}/"), name), "task_id": task_id(F.lit(batch), F.col("paper_id"), label),
    }
    return papers.select(*(row[k].alias(k) for k in MANIFEST_KEYS))


def as_json_lines(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(F.struct(*sorted(rows.columns))).alias("value"))


def manifest_problems(rows: DataFrame, batch: str, label: str) -> DataFrame:
    """(problem, key, folder) over manifest rows in JSON, `rows(task_id, value)`: an id that isn't the one its row's key gives, and a folder that two papers have. A paper's folder tells
    it from all others; its id has six digits of a digest, so that papers of a large manifest may share one, which only a batch of folders named by ids refuses."""
    own = rows.select("task_id", F.get_json_object("value", "$.source_task_key").alias("key"), F.get_json_object("value", "$.source_task_dir").alias("folder"))
    strange = own.filter(~F.col("task_id").eqNullSafe(task_id(F.lit(batch), F.col("key"), label)) | F.col("key").isNull() | F.col("folder").isNull())
    shared = own.groupBy("folder").agg(F.min("key").alias("key"), F.max("key").alias("other")).filter("key <> other")
    return strange.select(F.lit("task id is not its key's").alias("problem"), "key", "folder").union(shared.select(F.lit("folder is another paper's").alias("problem"), "key", "folder"))


def select_in_order(papers: DataFrame, wanted: DataFrame) -> DataFrame:
    """Entries of `wanted(paper_id)`, in the list's own order `ord`."""
    return papers.join(wanted.select("paper_id").distinct(), "paper_id", "left_semi").orderBy("ord")


def unknown(papers: DataFrame, wanted: DataFrame) -> DataFrame:
    return wanted.select("paper_id").distinct().join(papers, "paper_id", "left_anti")


def choose_bundle(candidates: DataFrame, modes: tuple[str, ...], approved_only: bool = False) -> DataFrame:
    """`candidates(paper_id, state, mode)`: a published bundle of a fitting mode, else a draft unless approval is asked."""
    fitting = candidates.filter(F.col("mode").isin(*modes))
    if approved_only:
        fitting = fitting.filter("state = 'published'")
    place = F.row_number().over(Window.partitionBy("paper_id").orderBy(F.when(F.col("state") == "published", 0).otherwise(1), "mode"))
    return fitting.withColumn("place", place).filter("place = 1").drop("place")


def set_audit(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of one side alone, with the side."""
    a, b = left.select(key).distinct().withColumn("l", F.lit(True)), right.select(key).distinct().withColumn("r", F.lit(True))
    both = a.join(b, key, "full_outer")
    return both.filter("l is null or r is null").select(key, F.when(F.col("l").isNull(), "right").otherwise("left").alias("only_in"))


def digest_audit(approved: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Keys whose approved digest is missing or differs."""
    both = approved.select(key, F.col("sha256").alias("approved")).join(actual.select(key, F.col("sha256").alias("actual")), key, "left")
    return both.filter(~F.col("approved").eqNullSafe(F.col("actual")))


def pending(entries: DataFrame, done: DataFrame, key: str, artefacts: int) -> DataFrame:
    """Entries without a complete set of `artefacts` in `done(key, artefact)`."""
    complete = done.groupBy(key).agg(F.count_distinct("artefact").alias("n")).filter(F.col("n") >= artefacts)
    return entries.join(complete, key, "left_anti")


def first_occurrences(rows: DataFrame, value: str, order: str) -> DataFrame:
    """One row for each value, the first in order."""
    place = F.row_number().over(Window.partitionBy(value).orderBy(order))
    return rows.withColumn("place", place).filter("place = 1").drop("place")


def safe_name(name: Column) -> Column:
    return F.btrim(F.regexp_replace(name, r"[^a-zA-Z0-9._-]+", "-"), F.lit("-"))


def publish(spark: SparkSession, rows: DataFrame, target: str, check: Callable[[DataFrame], DataFrame], overwrite: bool = False) -> DataFrame:
    """Write beside the target, check what was written, then rename; with violations nothing is published."""
    jvm = spark.sparkContext._jvm
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    store = path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if store.exists(path(target)) and not overwrite:
        raise FileExistsError(target)
    staged, old = (f"{target}.{kind}-{uuid.uuid4().hex[:12]}" for kind in ("staging", "old"))
    rows.write.parquet(staged)
    broken = check(spark.read.parquet(staged)).take(20)
    if broken:
        store.delete(path(staged), True)
        raise ValueError(f"not published: {broken}")
    # the old one stands aside until the new one is there, and comes back if it can't be
    aside = store.exists(path(target)) and store.rename(path(target), path(old))
    if not store.rename(path(staged), path(target)):
        if aside:
            store.rename(path(old), path(target))
        raise OSError(f"cannot rename {staged}")
    store.delete(path(old), True)
    return spark.read.parquet(target)
