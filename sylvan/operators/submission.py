"""Preflight of a submission: facts of its folder and repository, whether it is valid, and whether it can be graded."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.render import tracked_clean, tree_listing
from .rules import Rule

#: Fixed value: bytes that may be committed.
COMMITTED_CAP = 1_000_000_000
CHECKS = ("exists", "has_readme", "git_available", "is_repository", "root_is_directory", "has_head", "readme_tracked", "tree_clean", "size_ok")
SCRIPT_CHECKS = ("has_script", "script_tracked")
READY = ("has_paper_folder", "has_paper_pdf", "has_paper_text", "has_addendum", "has_judge_key", "has_judge_url")


def committed(submissions: DataFrame) -> DataFrame:
    """`listing`, a NUL-separated long listing, and `status`, a porcelain status, as `committed_files, committed_bytes, size_ok,
    tree_clean`. Without a listing nothing is committed and the size isn't known to be in order."""
    sizes = F.filter(F.transform(tree_listing(F.coalesce("listing", F.lit(""))), lambda e: e["bytes"]), lambda b: b.isNotNull())
    total = F.aggregate(sizes, F.lit(0).cast("long"), lambda s, b: s + b)
    out = submissions.withColumns({"committed_files": F.size(sizes).cast("long"), "committed_bytes": total, "tree_clean": F.coalesce(tracked_clean(F.col("status")), F.lit(False))})
    return out.withColumn("size_ok", F.col("listing").isNotNull() & (F.col("committed_bytes") <= COMMITTED_CAP))


def _all(names: tuple[str, ...]) -> Column:
    return reduce(Column.__and__, (F.coalesce(F.col(n), F.lit(False)) for n in names))


def preflight(submissions: DataFrame, code_only: bool = False) -> DataFrame:
    """`valid`: every check holds, and cleaning the copy (`clean_status`, null where it wasn't tried) ended with 0; `ready`: what the
    judge needs is there as well. `submissions` holds the boolean facts of CHECKS but for those that `committed` adds."""
    names = CHECKS if code_only else CHECKS + SCRIPT_CHECKS
    out = committed(submissions).withColumn("valid", _all(names) & (F.coalesce("clean_status", F.lit(0)) == 0))
    failed = F.filter(F.array(*(F.when(~F.coalesce(F.col(n), F.lit(False)), F.lit(n)) for n in names)), lambda x: x.isNotNull())
    return out.withColumns({"ready": F.col("valid") & _all(READY), "failed": F.array_join(failed, ",")})


def rules(code_only: bool = False) -> list[Rule]:
    """The checks of a row of `preflight` as rules."""
    names = CHECKS if code_only else CHECKS + SCRIPT_CHECKS
    return [*(Rule(f"not {n}", ~F.coalesce(F.col(n), F.lit(False))) for n in names), Rule("copy was not cleaned", F.coalesce("clean_status", F.lit(0)) != 0)]
