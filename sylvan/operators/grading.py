"""Grading of submissions leaf by leaf: what a judge is shown, what its answers are worth, and the record of each submission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import truncated
from . import score, tree

#: Characters of each part that a judge is shown.
PAPER_PARTS = {"paper_md": 24_000, "addendum": 8_000, "blacklist": 4_000}
RUN_PARTS = {"exit_code": 200, "stdout": 6_000, "stderr": 6_000, "file_manifest": 12_000}
JUDGE_ADDENDUM = 8_000
EVIDENCE_PARTS = {"raw_files": 12_000, "raw_text": 25_000, "executed_files": 16_000, "executed_text": 45_000, "run": 16_000}


def excerpts(rows: DataFrame, parts: dict[str, int]) -> DataFrame:
    """Each named text cut to its budget with a note on what is missing; null is empty."""
    return rows.withColumns({name: truncated(F.col(name), most) for name, most in parts.items()})


def compact_leaves(nodes: DataFrame, code_only: bool = False) -> DataFrame:
    """`(tree_id, leaf_id, requirements, weight, task_category)` of the leaves that are asked."""
    found = tree.leaves(nodes)
    found = found.filter(F.col("task_category") == tree.CATEGORIES[0]) if code_only else found
    return found.select("tree_id", F.coalesce("node_id", F.lit("")).alias("leaf_id"), F.coalesce("requirements", F.lit("")).alias("requirements"), tree.sound_weight(F.col("weight")).alias("weight"), "task_category")


def mode_guidance(code_only: Column) -> Column:
    """What a judge is told of the mode."""
    return F.when(code_only, "Judge the committed source code alone; nothing was run.").otherwise("Judge code, runs, results and analysis, with the run's logs and what it made.")


def prompts(rows: DataFrame) -> DataFrame:
    """`rows(leaf_id, context, requirements, paper_id, title, code_only, judge_addendum, raw_files, raw_text, executed_files, executed_text, run,
    paper_md, addendum, blacklist)` with `prompt`: the parts in order, each within its budget; what was run is left out where only
    code counts."""
    cut = lambda name, most: F.substring(F.coalesce(F.col(name), F.lit("")), 1, most)
    rows = excerpts(rows, PAPER_PARTS)
    part = lambda name, text: F.concat(F.lit(f"{name}:\n"), text, F.lit("\n\n"))
    seen = [part(n.replace("_", " ").upper(), cut(n, EVIDENCE_PARTS[n])) for n in ("raw_files", "raw_text")]
    ran = [part(n.replace("_", " ").upper(), cut(n, EVIDENCE_PARTS[n])) for n in ("executed_files", "executed_text", "run")]
    text = F.concat(
        F.lit("Grade one leaf with 0 or 1 and answer in JSON.\n"), mode_guidance(F.col("code_only")), F.lit("\n\n"), part("PAPER", F.concat_ws(" ", "paper_id", "title")), part("ADDENDUM", F.col("addendum")),
        part("BLACKLIST", F.col("blacklist")), part("JUDGE ADDENDUM", cut("judge_addendum", JUDGE_ADDENDUM)), part("LEAF", F.col("leaf_id")), part("CONTEXT", F.coalesce("context", F.lit(""))), part("CRITERION", F.col("requirements")),
        part("PAPER TEXT", F.col("paper_md")), *seen, F.when(F.col("code_only"), "").otherwise(F.concat(*ran)),
    )
    return rows.withColumn("prompt", text)


def graded(submissions: DataFrame, nodes: DataFrame, answers: DataFrame, code_only: bool = False) -> tuple[DataFrame, DataFrame]:
    """Leaves and records of submissions: `submissions(submission_id, tree_id, valid, has_readme, has_script, failed, reproduction_ran,
    reproduction_success)`, `nodes` as in `tree`, `answers(submission_id, leaf_id, response, error)`.

    An invalid submission is asked nothing; an answer that failed, holds no JSON object or neither a list nor its leaf is none; one without its leaf's
    score counts 0, and none reaches another leaf: entries of others are passed over; `failed` tells that grading as a whole broke off, then the score is 0 and all leaves are invalid."""
    nodes = tree.prune_to(nodes) if code_only else nodes
    leaves = compact_leaves(nodes, code_only)
    sizes = leaves.groupBy("tree_id").agg(F.count("*").alias("leaves"), F.sum("weight").alias("weight_total"))
    whole = F.coalesce("valid", F.lit(False)) & ~F.coalesce("failed", F.lit(False))
    asked = submissions.filter(whole).select("submission_id", "tree_id").join(leaves, "tree_id").join(answers, ["submission_id", "leaf_id"], "left")
    key = F.concat_ws("\x1f", "submission_id", "leaf_id")
    asked = asked.withColumn("told", F.col("error").isNull() & F.coalesce(score.readable(F.col("response"), F.col("leaf_id")), F.lit(False)))
    told = asked.filter("told")
    parsed = score.response_rows(told.select("leaf_id", F.col("submission_id").alias("ord"), "response")).filter("found_id = leaf_id")
    # one answer a leaf and submission: the submission stands in for the order, and the pair for the leaf
    parsed = parsed.select(F.concat_ws("\x1f", "ord", "leaf_id").alias("leaf_id"), F.lit(0).alias("ord"), "pos", F.concat_ws("\x1f", "ord", "found_id").alias("found_id"), "score")
    values = score.leaf_scores(parsed).select(F.col("leaf_id").alias("key"), "score", "invalid")
    rows = asked.withColumn("key", key).join(values, "key", "left")
    available = F.col("told")
    rows = rows.select("submission_id", "tree_id", "leaf_id", F.coalesce("score", F.lit(0.0)).alias("score"), available.alias("judge_available"), (available & F.coalesce(F.col("invalid") == 0, F.lit(False))).alias("llm_parse_ok"))
    own = submissions.filter(whole).select("submission_id", "tree_id").join(nodes, "tree_id").drop("tree_id").withColumnRenamed("submission_id", "tree_id")
    total = tree.tree_scores(own, rows.select(F.col("submission_id").alias("tree_id"), F.col("leaf_id").alias("node_id"), "score")).filter("depth = 0")
    counted = rows.groupBy("submission_id").agg(F.count("*").alias("requests"), F.count_if("judge_available").alias("answered"), F.count_if("llm_parse_ok").alias("parsed"))
    full = submissions.join(sizes, "tree_id", "left").join(counted, "submission_id", "left").join(total.select(F.col("tree_id").alias("submission_id"), "score"), "submission_id", "left")
    full = full.na.fill(0, ["leaves", "requests", "answered", "parsed"]).na.fill(0.0, ["weight_total", "score"])
    record = score.reward_record(full.withColumn("requests", F.when(F.coalesce("failed", F.lit(False)), F.col("leaves")).otherwise(F.col("requests"))), code_only)
    return rows, record
