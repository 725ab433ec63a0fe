"""Contracts between stages: plans, assembly, gates, conversions and packaged batches, each as a table of violations."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .profile import comparable, profile_json
from .rules import KEBAB, Rule


def _blank(name: str) -> Column:
    return F.coalesce(F.trim(F.col(name)), F.lit("")) == ""


def branches(plans: DataFrame) -> DataFrame:
    """`plans(plan_id, plan)` variants to `(plan_id, root_id, root_requirements, pos, branch_id, requirements, weight, weight_kind, is_object, copies)`.
    A plan without branches has one row without a position. `copies` counts the id among the plan's ids, the root's included."""
    get = lambda v, path, kind: F.try_variant_get(v, path, kind)
    rows = plans.select("plan_id", get("plan", "$.root.id", "string").alias("root_id"), get("plan", "$.root.requirements", "string").alias("root_requirements"), F.posexplode_outer(get("plan", "$.root.branches", "array<variant>")).alias("pos", "b"))
    rows = rows.select(
        "plan_id", "root_id", "root_requirements", "pos", get("b", "$.id", "string").alias("branch_id"), get("b", "$.requirements", "string").alias("requirements"),
        get("b", "$.weight", "double").alias("weight"), F.schema_of_variant(get("b", "$.weight", "variant")).alias("weight_kind"), F.coalesce(F.startswith(F.schema_of_variant("b"), F.lit("OBJECT")), F.lit(False)).alias("is_object"),
    )
    counts = rows.filter("branch_id is not null").groupBy("plan_id", "branch_id").agg(F.count("*").alias("same"))
    out = rows.join(counts, ["plan_id", "branch_id"], "left")
    return out.withColumn("copies", F.coalesce("same", F.lit(0)) + F.coalesce((F.col("branch_id") == F.col("root_id")).cast("long"), F.lit(0))).drop("same")


def plan_rules() -> list[Rule]:
    """Rules of a row of `branches`."""
    there = F.col("pos").isNotNull()
    number = F.coalesce(F.col("weight_kind").rlike("^(BIGINT|DOUBLE|DECIMAL)"), F.lit(False))
    return [
        Rule("root has no id", _blank("root_id")), Rule("root has no requirements", _blank("root_requirements")), Rule("no branches", ~there), Rule("branch is no object", there & ~F.col("is_object")),
        Rule("branch id is not kebab-case", F.col("is_object") & ~F.coalesce(F.col("branch_id").rlike(KEBAB), F.lit(False))), Rule("branch id is not unique", F.col("copies") > 1),
        Rule("branch has no requirements", F.col("is_object") & _blank("requirements")), Rule("branch weight is no number from 0 on", F.col("is_object") & ~(number & F.coalesce(F.col("weight") >= 0, F.lit(False)))),
    ]


def subtree_answers(answers: DataFrame) -> DataFrame:
    """`answers(plan_id, pos, answer)` variants to `(plan_id, pos, is_object, id, requirements)`, for `assemble`."""
    get = lambda path: F.try_variant_get("answer", path, "string")
    is_object = F.coalesce(F.startswith(F.schema_of_variant("answer"), F.lit("OBJECT")), F.lit(False))
    return answers.select("plan_id", "pos", is_object.alias("is_object"), F.when(is_object, get("$.id")).alias("id"), F.when(is_object, get("$.requirements")).alias("requirements"))


def assemble(plan: DataFrame, subtrees: DataFrame) -> DataFrame:
    """`plan(plan_id, pos, id, requirements, weight)` with `subtrees(plan_id, pos, id, requirements)`, one to one by place; the
    plan's weight counts. `problem` tells what doesn't fit."""
    a, b = plan.alias("a"), subtrees.alias("b")
    both = a.join(b, (F.col("a.plan_id") == F.col("b.plan_id")) & (F.col("a.pos") == F.col("b.pos")), "full_outer")
    problem = (
        F.when(F.col("b.plan_id").isNull(), "no subtree").when(F.col("a.plan_id").isNull(), "no branch").when(~F.col("b.is_object") if "is_object" in subtrees.columns else F.lit(False), "subtree is no object")
        .when(~F.col("a.id").eqNullSafe(F.col("b.id")), "other id")
        .when(~F.col("a.requirements").eqNullSafe(F.col("b.requirements")), "other requirements")
    )
    return both.select(F.coalesce("a.plan_id", "b.plan_id").alias("plan_id"), F.coalesce("a.pos", "b.pos").alias("pos"), F.col("a.id").alias("id"), F.col("a.weight").alias("weight"), problem.alias("problem"))


def gate_rules(artefacts: Iterable[str], tag: str | None = None) -> list[Rule]:
    """Rules of a draft before it is published: a row with `artefacts` (array), `tag`, `tree_errors`, `addendum_errors`,
    `blocking_issues`, `unresolved`, `weights_valid`, `recorded_hash`, `actual_hash`, `targets`, `replace`, and with a tag the `draft_hash`
    and the `pruned_hash` that pruning the complete tree again gives (see `tree_hash`)."""
    wanted = F.array(*map(F.lit, artefacts))
    some = lambda name: F.coalesce(F.col(name), F.lit(0)) > 0
    rules = [
        Rule("artefact is missing", F.size(F.array_except(wanted, F.coalesce("artefacts", F.array().cast("array<string>")))) > 0), Rule("tree has errors", some("tree_errors")), Rule("addendum has errors", some("addendum_errors")),
        Rule("review blocks", some("blocking_issues")), Rule("questions are open", some("unresolved")), Rule("weights were not applied", ~F.coalesce("weights_valid", F.lit(False))),
        Rule("target is there", some("targets") & ~F.coalesce("replace", F.lit(False))),
    ]
    if tag is not None:
        rules += [
            Rule("derivation is another one", ~F.col("tag").eqNullSafe(F.lit(tag))), Rule("no complete tree", F.col("actual_hash").isNull()),
            Rule("complete tree has changed", F.col("actual_hash").isNotNull() & ~F.col("recorded_hash").eqNullSafe(F.col("actual_hash"))),
            Rule("draft is not the complete tree's part", ~F.col("draft_hash").eqNullSafe(F.col("pruned_hash"))),
        ]
    return rules


def conversion_rules(tag: str | None = None, approved: bool = False) -> list[Rule]:
    """Rules of a bundle before it becomes a task: a row with `tag`, `tree_errors`, `addendum_errors`, `approved_hashes` and
    `actual_hashes` (maps), `leaves`, `fits` (see `score.timeout_plan`)."""
    rules = [
        Rule("tree has errors", F.coalesce("tree_errors", F.lit(0)) > 0), Rule("addendum has errors", F.coalesce("addendum_errors", F.lit(0)) > 0), Rule("no leaf", F.coalesce("leaves", F.lit(0)) < 1),
        Rule("time does not suffice", ~F.coalesce("fits", F.lit(False))),
    ]
    if tag is not None:
        rules.append(Rule("derivation is another one", ~F.col("tag").eqNullSafe(F.lit(tag))))
    if approved:
        entries = lambda m: F.array_sort(F.map_entries(m))
        rules.append(Rule("approval does not match", ~entries("approved_hashes").eqNullSafe(entries("actual_hashes"))))
    return rules


def tree_hash(nodes: DataFrame) -> DataFrame:
    """(tree_id, sha256) of a tree's nodes in order of their ids: equal for equal trees, whatever the order of rows. Each node is
    hashed for itself, so that what is gathered for a tree is 32 bytes a node."""
    columns = [c for c in ("node_id", "parent_id", "ord", "requirements", "weight", "task_category", "fine_category") if c in nodes.columns]
    own = F.sha2(F.to_json(F.struct(*(F.col(c).cast("string").alias(c) for c in columns))), 256)
    rows = nodes.groupBy("tree_id").agg(F.array_sort(F.collect_list(F.struct("node_id", own.alias("own")))).alias("rows"))
    return rows.select("tree_id", F.sha2(F.array_join(F.transform("rows", lambda r: r["own"]), ","), 256).alias("sha256"))


def missing_outputs(entries: DataFrame, present: DataFrame, names: Iterable[str]) -> DataFrame:
    """(paper_id, name) of every output that a stage should have left for `entries(paper_id)` and that `present(paper_id, name)` lacks."""
    wanted = entries.select("paper_id").distinct().withColumn("name", F.explode(F.array(*map(F.lit, names))))
    return wanted.join(present.select("paper_id", "name"), ["paper_id", "name"], "left_anti")


def code_only_of(mode: str) -> bool:
    """Whether only code counts; another mode than the two is refused."""
    if mode not in ("regular", "code-dev"):
        raise ValueError(f"no such mode: {mode!r}")
    return mode == "code-dev"


def option_rules() -> list[Rule]:
    """Rules of a row of options `chunk_chars, workers, paper_workers, overwrite, resume, switch_model, switch_after, papers, batch_id,
    timeouts` (array) and `total_timeout, needed`."""
    least = lambda name, n: ~F.coalesce(F.col(name) >= n, F.lit(False))
    switch = F.col("switch_model").isNotNull()
    return [
        Rule("chunk is too small", least("chunk_chars", 10_000)), Rule("no worker", least("workers", 1)), Rule("no worker for papers", least("paper_workers", 1)),
        Rule("overwrite and resume exclude each other", F.col("overwrite") & F.col("resume")), Rule("half of a model switch", switch != F.col("switch_after").isNotNull()),
        Rule("switch does not split the list", switch & ~F.coalesce((F.col("switch_after") > 0) & (F.col("switch_after") < F.col("papers")), F.lit(True))),
        Rule("batch id is not of its form", ~F.coalesce(F.col("batch_id").rlike(r"^[0-9]{8}-[0-9]{6}$"), F.lit(False))),
        Rule("timeout is not positive", F.exists("timeouts", lambda t: ~F.coalesce(t > 0, F.lit(False)))), Rule("total timeout does not suffice", F.col("total_timeout") < F.col("needed")),
    ]


def resume_rules(tag: str) -> list[Rule]:
    """Rules of a paper that is taken up again: `recorded_mode, mode, tag, has_complete_tree`."""
    code = F.col("mode") == "code-dev"
    return [
        Rule("mode has changed", F.col("recorded_mode").isNotNull() & (F.col("recorded_mode") != F.col("mode"))), Rule("derivation is stale", code & F.col("tag").isNotNull() & (F.col("tag") != tag)),
        Rule("complete tree is missing", code & ~F.coalesce("has_complete_tree", F.lit(False))),
    ]


def weight_entries(plans: DataFrame) -> DataFrame:
    """`plans(tree_id, plan)` variants to `(tree_id, ord, node_id, weight, problem)`: a list under `weights`. A plan without a list is
    one row; `weight` is null unless it is a whole number. Problems of an entry's place in the tree are `tree.audit_weights`'s."""
    get = lambda v, path, kind: F.try_variant_get(v, path, kind)
    rows = plans.select("tree_id", F.posexplode_outer(get("plan", "$.weights", "array<variant>")).alias("ord", "e"))
    is_object = F.coalesce(F.startswith(F.schema_of_variant("e"), F.lit("OBJECT")), F.lit(False))
    kind = F.schema_of_variant(get("e", "$.weight", "variant"))
    node = F.when(is_object & (F.schema_of_variant(get("e", "$.node_id", "variant")) == "STRING"), F.nullif(F.trim(get("e", "$.node_id", "string")), F.lit("")))
    problem = F.when(F.col("ord").isNull(), "plan has no list").when(~is_object, "entry is no object").when(node.isNull(), "entry has no node")
    return rows.select("tree_id", F.col("ord").cast("long").alias("ord"), node.alias("node_id"), F.when(kind == "BIGINT", get("e", "$.weight", "double")).alias("weight"), problem.alias("problem"))


def folder_audit(entries: DataFrame, expected: dict[str, Iterable[str]]) -> DataFrame:
    """(task_id, folder, name, problem): names that each task's folders miss or have too many of. `entries(task_id, path)`.
    The expected names are a few per folder and travel with the plan."""
    folder = F.regexp_replace("path", r"/?[^/]*$", "")
    names = F.create_map(*(x for f, ns in expected.items() for x in (F.lit(f), F.array(*map(F.lit, sorted(ns))))))
    files = entries.select("task_id", folder.alias("folder"), F.element_at(F.split("path", "/"), -1).alias("name"))
    found = files.filter(F.col("folder").isin(*expected)).groupBy("task_id", "folder").agg(F.collect_set("name").alias("found"))
    every = entries.select("task_id").distinct().withColumn("folder", F.explode(F.array(*map(F.lit, expected))))
    both = every.join(found, ["task_id", "folder"], "left").withColumn("found", F.coalesce("found", F.array().cast("array<string>"))).withColumn("wanted", F.try_element_at(names, F.col("folder")))
    named = lambda a, b, p: F.transform(F.array_except(a, b), lambda n: F.struct(n.alias("name"), F.lit(p).alias("problem")))
    return both.select("task_id", "folder", F.explode(F.concat(named("wanted", "found", "missing"), named("found", "wanted", "extra"))).alias("x")).select("task_id", "folder", "x.*")


def forbidden(entries: DataFrame, names: Iterable[str]) -> DataFrame:
    return entries.filter(F.element_at(F.split("path", "/"), -1).isin(*names)).select("task_id", "path")


def mode_audit(entries: DataFrame, executables: Iterable[str]) -> DataFrame:
    """`entries(task_id, path, is_folder, mode)` whose mode isn't 755 (folders, executables) or 644 (all else)."""
    wanted = F.when(F.col("is_folder") | F.col("path").isin(*executables), "755").otherwise("644")
    return entries.filter(F.col("mode") != wanted).select("task_id", "path", "mode", wanted.alias("wanted"))


def template_audit(entries: DataFrame, templates: DataFrame) -> DataFrame:
    """(task_id, path) of copies that differ from `templates(path, sha256)`, or are missing."""
    every = entries.select("task_id").distinct().crossJoin(F.broadcast(templates.select("path", F.col("sha256").alias("wanted"))))  # a few template files
    both = every.join(entries.select("task_id", "path", "sha256"), ["task_id", "path"], "left")
    return both.filter(~F.col("sha256").eqNullSafe(F.col("wanted"))).select("task_id", "path")


def profile_audit(stored: DataFrame, files: DataFrame) -> DataFrame:
    """Sets whose stored `(set_id, profile)`, a variant, differs from what their files give now, by totals, kinds and scopes."""
    now = profile_json(files).select("set_id", comparable(F.parse_json("json")).alias("now"))
    held = stored.select("set_id", comparable(F.col("profile")).alias("held"))
    return held.join(now, "set_id", "full_outer").filter(~F.col("held").eqNullSafe(F.col("now"))).select("set_id")


def open_questions(*answers: DataFrame) -> DataFrame:
    """Questions of several `(ord, question)` tables in order, each once by its canonical JSON."""
    every = reduce(DataFrame.union, (a.select(F.lit(i).alias("source"), "ord", F.to_json("question").alias("question")) for i, a in enumerate(answers)))
    return every.groupBy("question").agg(F.min(F.struct("source", "ord")).alias("at")).orderBy("at").select("question")
