"""Drafts of a project folder that a person has approved become published trees and addenda: what holds a draft back is read from its own files, whatever wrote them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .conversion import project_files
from .functions.text import strict_json
from .operators import contracts, rules, tree
from .sources import sinks
from .sources.files import flatten_trees, normal_tree
from .sources.tables import kept

FOLDER = "rubric_authoring/"
#: Files that a draft needs, and those that it may have, by what they are called here.
NEEDED = {
    "rubric": "rubric.draft.json", "addendum": "addendum.draft.md", "review": "quality_review.json", "unresolved": "unresolved_questions.json", "application": "rubric_weight_application.json",
    "provenance": "authoring_provenance.json",
}
OPTIONAL = {"full": "rubric.full.draft.json", "judge_addendum": "judge.addendum.draft.md"}
TARGETS = {"rubric": "rubric.json", "addendum": "addendum.md", "judge_addendum": "judge.addendum.md"}


def drafts(files: DataFrame) -> DataFrame:
    """`files` as of `conversion.project_files` to a row a paper: each file's `content`, null where it isn't there, `artefacts`, the names of those that are needed and there, and `targets`, how many published files
    are there already."""
    draft = lambda name: (F.col("place") == "design") & (F.col("name") == FOLDER + name)
    pick = lambda name: F.max(F.when(draft(name), F.col("content")))
    published = (F.col("place") == "paper_sources") & F.col("name").isin(TARGETS["rubric"], TARGETS["addendum"])
    named = files.filter(published | ((F.col("place") == "design") & F.col("name").isin(*(FOLDER + n for n in (*NEEDED.values(), *OPTIONAL.values())))))
    rows = named.groupBy("paper_id").agg(*(pick(n).alias(c) for c, n in (NEEDED | OPTIONAL).items()), F.count_if(published).alias("targets"))
    there = F.array(*(F.when(F.col(c).isNotNull(), F.lit(n)) for c, n in NEEDED.items()))
    return rows.withColumn("artefacts", F.array_compact(there))


def _text(name: str) -> Column:
    return F.make_valid_utf8(F.col(name).cast("string"))


def _errors(flat: DataFrame, code: DataFrame) -> DataFrame:
    """(paper_id, node_id, severity, rule) of trees, those of `code(tree_id)` held to code alone."""
    whole = flat.join(code, "tree_id", "left_anti")
    found = rules.json_tree_violations(whole).unionByName(rules.json_tree_violations(flat.join(code, "tree_id", "left_semi"), True))
    return found.withColumnRenamed("tree_id", "paper_id")


def judged(spark: SparkSession, rows: DataFrame, tag: str | None, replace: bool) -> tuple[DataFrame, DataFrame]:
    """(facts, what holds drafts back as `(paper_id, rule, detail)`) of `drafts`. A draft of code alone has to be what cutting its complete tree down gives, by the derivation `tag`."""
    get = lambda name, path, kind="string": F.try_variant_get(strict_json(_text(name)), path, kind)
    is_kind = lambda name, kind: F.coalesce(F.startswith(F.schema_of_variant(strict_json(_text(name))), F.lit(kind)), F.lit(False))
    rows = rows.withColumns({
        "mode": F.coalesce(get("provenance", "$.rubric_mode"), F.lit("regular")), "authoring_mode": get("provenance", "$.authoring_mode"), "tag": get("provenance", "$.code_dev_derivation"), "recorded_hash": get("provenance", "$.full_rubric_sha256"),
        "actual_hash": F.sha2("full", 256), "addendum_text": _text("addendum"), "replace": F.lit(replace), "targets": F.col("targets").cast("long"),
    })
    # what isn't of its form counts as a finding
    blocking = get("review", "$.blocking_issues", "array<variant>")
    listed = F.try_variant_get(strict_json(_text("unresolved")), "$", "array<variant>")
    odd = F.coalesce(F.to_json(get("review", "$.blocking_issues", "variant")).isin('""', "{}", "null", "false", "0"), F.lit(True))
    rows = rows.withColumns({
        "blocking_issues": F.when(F.col("review").isNotNull(), F.when(~is_kind("review", "OBJECT"), 1).otherwise(F.coalesce(F.size(blocking), F.when(odd, 0).otherwise(1)))),
        "unresolved_count": F.when(F.col("unresolved").isNotNull(), F.coalesce(F.size(listed), F.lit(1))),
        # a list of problems, or an object that says so
        "weights_valid": F.coalesce(get("application", "$.valid", "boolean"), F.size(F.try_variant_get(strict_json(_text("application")), "$", "array<variant>")) == 0, F.lit(False)),
    })
    rows = kept(spark, rows, "drafts")
    code = rows.filter("mode = 'code-dev'").select(F.col("paper_id").alias("tree_id"))
    flat = kept(spark, flatten_trees(rows.filter("rubric IS NOT NULL").select(F.col("paper_id").alias("tree_id"), _text("rubric").alias("json"))), "flat")
    full = kept(spark, flatten_trees(rows.filter("full IS NOT NULL AND mode = 'code-dev'").select(F.col("paper_id").alias("tree_id"), _text("full").alias("json"))), "full")
    own = kept(spark, _errors(flat, code), "tree-violations")
    complete = rules.json_tree_violations(full).withColumnRenamed("tree_id", "paper_id").filter("severity = 'error'").withColumn("rule", F.concat(F.lit("complete tree: "), "rule"))
    broken = own.filter("severity = 'error'").unionByName(complete).select("paper_id", "rule", F.coalesce("node_id", F.lit("")).alias("detail"))
    in_addendum = rules.violations(rows.filter("addendum IS NOT NULL"), rules.addendum_rules(F.col("addendum_text")), ["paper_id"])
    hashes = contracts.tree_hash(normal_tree(flat)).select(F.col("tree_id").alias("paper_id"), F.col("sha256").alias("draft_hash"))
    pruned = contracts.tree_hash(tree.prune_to(normal_tree(full)).drop("path")).select(F.col("tree_id").alias("paper_id"), F.col("sha256").alias("pruned_hash"))
    count = lambda found, name: found.groupBy("paper_id").agg(F.count("*").alias(name))
    warned = own.select("paper_id", "severity", "rule").union(in_addendum.select("paper_id", "severity", "rule")).filter("severity = 'warning'").groupBy("paper_id").agg(F.array_sort(F.collect_set("rule")).alias("warnings"))
    sizes = rules.tree_report(flat).select(F.col("tree_id").alias("paper_id"), "nodes", "leaves", "max_depth")
    facts = rows
    for part in (hashes, pruned, count(broken, "tree_errors"), count(in_addendum.filter("severity = 'error'"), "addendum_errors"), warned, sizes):
        facts = facts.join(part, "paper_id", "left")
    facts = kept(spark, facts, "facts")
    gate = facts.withColumn("unresolved", F.col("unresolved_count"))
    held = [rules.violations(gate.filter("mode <> 'code-dev'"), contracts.gate_rules(NEEDED.values()), ["paper_id"]), rules.violations(gate.filter("mode = 'code-dev'"), contracts.gate_rules(NEEDED.values(), tag or ""), ["paper_id"])]
    details = broken.unionByName(in_addendum.filter("severity = 'error'").select("paper_id", "rule", F.lit("addendum").alias("detail")))
    return facts, kept(spark, reduce(DataFrame.unionByName, [*(h.select("paper_id", "rule", F.lit("").alias("detail")) for h in held), details]), "held")


def release(spark: SparkSession, root: str, ids: list[str], reviewer: str, notes: str = "", tag: str | None = None, replace: bool = False) -> tuple[DataFrame, DataFrame]:
    """Publishes the drafts of `ids` in the project at `root` that nothing holds back: tree, addendum and judge's addendum beside the paper, then the approval beside the draft, with digests of what was
    published and the warnings that the reviewer has seen. Gives (what was written, what held others back). If it breaks off before the approvals are there, `replace` makes it good."""
    if not reviewer.strip():
        raise ValueError("a reviewer is needed")
    papers = spark.createDataFrame([(i,) for i in dict.fromkeys(ids)], "paper_id string")
    found = drafts(project_files(spark, root, papers, {*NEEDED.values(), *OPTIONAL.values(), *TARGETS.values()}))
    facts, held = judged(spark, found, tag, replace)
    absent = papers.join(facts, "paper_id", "left_anti").select("paper_id", F.lit("no draft").alias("rule"), F.lit("").alias("detail"))
    held = held.unionByName(absent)
    ready = facts.join(held.select("paper_id").distinct(), "paper_id", "left_anti")
    each = F.array(*(F.struct(F.lit(n).alias("name"), F.col(c).alias("content")) for c, n in TARGETS.items()))
    files = ready.select("paper_id", F.explode(each).alias("f")).filter("f.content IS NOT NULL").select(F.concat(F.lit("paper_sources/"), "paper_id", F.lit("/"), "f.name").alias("path"), "f.content")
    written = kept(spark, sinks.write_files(files, root, overwrite=replace), "published")
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    record = {
        "addendum_sha256": F.sha2("addendum", 256), "approved_at": now, "approved_by": F.lit(reviewer), "authoring_mode": F.coalesce("authoring_mode", "mode"), "code_dev_derivation": F.col("tag"), "full_rubric_sha256": F.col("recorded_hash"),
        "judge_addendum_sha256": F.sha2("judge_addendum", 256), "notes": F.lit(notes), "paper_id": F.col("paper_id"), "rubric_mode": F.col("mode"), "rubric_sha256": F.sha2("rubric", 256), "rubric_stats": F.struct("nodes", "leaves", "max_depth"),
        "warnings_reviewed": F.coalesce("warnings", F.array().cast("array<string>")),
    }
    text = F.encode(sinks.pretty_json(F.struct(*(c.alias(n) for n, c in record.items()))), "utf-8")
    approvals = ready.select(F.concat(F.lit("design/"), "paper_id", F.lit(f"/{FOLDER}human_approval.json")).alias("path"), text.alias("content"))
    return written.union(kept(spark, sinks.write_files(approvals, root, overwrite=True), "approvals")), held
