"""Evidence of a submission: which files count, in which order, and how much of their text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Path parts that hide a file, suffixes of text and of source, names and markers that come first.
IGNORED = (".git", "__pycache__", ".pytest_cache", ".mypy_cache", ".ruff_cache")
TEXT = ("py", "sh", "md", "txt", "json", "yaml", "yml", "toml", "csv", "tsv", "rst", "log", "out", "err", "html", "tex")
SOURCE = ("py", "sh", "ipynb", "toml", "yaml", "yml")
FIRST = ("readme.md", "reproduce.sh")
SECOND = ("requirements.txt", "pyproject.toml", "environment.yml", "environment.yaml", "results.json", "metrics.json", "results.csv", "metrics.csv")
MARKERS = ("result", "metric", "score", "summary", "evaluation", "report")


@dataclass(frozen=True)
class Budget:
    """Files, characters of a file, characters in all, and bytes of a file that is read."""

    files: int = 200
    per_file: int = 3500
    total: int = 60_000
    size: int = 2_000_000


def suffix(path: Column) -> Column:
    """Lower case, without the dot; a name that begins with its only dot has none."""
    return F.lower(F.regexp_extract(path, r"[^/.][^/]*\.([^./]+)$", 1))


def rank(path: Column) -> Column:
    name = F.lower(F.element_at(F.split(path, "/"), -1))
    marked = F.lit(False)
    for m in MARKERS:
        marked = marked | F.contains(F.lower(path), F.lit(m))
    return (
        F.when(name.isin(*FIRST), 0).when(name.isin(*SECOND), 1).when(marked, 2).when(suffix(path).isin(*SOURCE), 3).when(suffix(path).isin(*TEXT), 4).otherwise(5)
    )


def visible(files: DataFrame) -> DataFrame:
    return files.filter(~F.arrays_overlap(F.split("path", "/"), F.array(*map(F.lit, IGNORED))))


def ranked(files: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """`files(submission_id, path, ...)` to the first of each submission by rank, depth and path, with `place` from 1."""
    order = [rank(F.col("path")), F.size(F.split("path", "/")), F.lower("path"), F.col("path")]
    place = F.row_number().over(Window.partitionBy("submission_id").orderBy(*order))
    return visible(files).withColumn("priority", rank(F.col("path"))).withColumn("place", place).filter(F.col("place") <= budget.files)


def snippets(files: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """`files(submission_id, path, bytes, text)`, ranked, with `snippet` while the characters before it stay below the budget."""
    readable = suffix(F.col("path")).isin(*TEXT) & (F.col("bytes") <= budget.size)
    cut = F.when(readable, F.substring(F.coalesce("text", F.lit("")), 1, budget.per_file))
    before = Window.partitionBy("submission_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum(F.coalesce(F.length("cut"), F.lit(0))).over(before), F.lit(0))
    # what would be cut after the budget is used up adds to the sum, but nothing after it counts either way
    # what is cut off goes before anything is sorted or moved
    return ranked(files.withColumn("cut", cut).drop("text"), budget).withColumn("used", used).withColumn("snippet", F.when(F.col("used") < budget.total, F.col("cut"))).drop("cut")


def evidence_text(files: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """`(submission_id, files, text)`: the snippets under their paths, in order, cut to the budget."""
    shown = F.when(F.length(F.regexp_replace("snippet", r"(?U)\s", "")) > 0, F.concat(F.lit("### "), "path", F.lit("\n"), "snippet"))
    parts = F.transform(F.array_sort(F.collect_list(F.when(shown.isNotNull(), F.struct("place", shown.alias("part"))))), lambda x: x["part"])
    return snippets(files, budget).groupBy("submission_id").agg(F.count("*").alias("files"), F.substring(F.array_join(parts, "\n\n"), 1, budget.total).alias("text"))
