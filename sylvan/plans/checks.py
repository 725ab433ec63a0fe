"""Queries that validate: trees in JSON, packages, paper lists, submissions, plans, gates and options. What they check is made of the
test tables' rows, with faults by remainders of their keys, so that SQL can say what must be found."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import strict_json
from ..operators import contracts, rules, submission
from ..sources import files
from ..sources.tables import kept, table


def _cases(rows: str, cases: dict[str, str]) -> str:
    """SQL: `cases` are conditions by what is selected where they hold."""
    return " UNION ALL ".join(f"SELECT {what} FROM {rows} WHERE {where}" for what, where in cases.items())


_LEAF = '{{"id": "{id}", "requirements": "r", "weight": 1, "sub_tasks": [], "task_category": "{cat}", "finegrained_task_category": "Method Implementation"}}'


def json_trees(spark, sf):
    """A tree for each customer: a root and two leaves, with a fault by custkey % 12."""
    leaf = lambda n: _LEAF.format(id=f"leaf-' || c_custkey || '-{n}", cat="Code Development")
    first = leaf(1)
    variants = {2: '"x"', 4: first.replace('"weight": 1, ', ""), 5: first.replace(f"leaf-' || c_custkey || '-{1}", ""), 6: first.replace('"sub_tasks": []', '"sub_tasks": {}')}
    child = "CASE c_custkey % 12 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in variants.items()) + f" ELSE '{first}' END"
    root = f"""'{{"id": "tree-' || c_custkey || '", "requirements": "r", "weight": 1, "sub_tasks": [' || {child} || ', {leaf(2)}], "task_category": null, "finegrained_task_category": null' || CASE c_custkey % 12 WHEN 3 THEN ', "note": 1' ELSE '' END || '}}'"""
    return table(spark, sf, "customer").selectExpr("concat('c', c_custkey) AS tree_id", f"CASE c_custkey % 12 WHEN 1 THEN '[]' WHEN 7 THEN '{{broken' ELSE {root} END AS json")


def json_tree_nodes(spark, sf):
    return files.normal_tree(files.flatten_trees(json_trees(spark, sf))).select("tree_id", "node_id", "parent_id", "ord", "depth", "weight", "task_category")


def structure_violations(spark, sf):
    flat = files.flatten_trees(json_trees(spark, sf))
    return rules.violations(flat, rules.structure_rules(), ["tree_id", "path"])


def json_tree_report(spark, sf):
    return rules.tree_report(kept(spark, files.flatten_trees(json_trees(spark, sf)), "flat"))


_ADDENDUM = "Scope. Approved adaptation: none. Required comparison: all. Clarification: none. Out of scope: all else. "


def package_files(spark, sf):
    """Six files for each supplier, one of them missing or faulty by suppkey % 10."""
    cats = ("Code Development", "Code Execution", "Result Analysis")
    leaves = ", ".join(_LEAF.format(id=f"leaf-{n}", cat=c) for n, c in enumerate(cats))
    tree = f'{{"id": "root", "requirements": "r", "weight": 1, "sub_tasks": [{leaves}], "task_category": null, "finegrained_task_category": null}}'
    k = F.col("s_suppkey") % 10
    text = F.when(F.col("name") == "rubric.json", F.when(k == 6, "{broken").when(k == 9, tree.replace('"weight": 1, "sub_tasks": [], "task_category": "Result', '"weight": -1, "sub_tasks": [], "task_category": "Result')).otherwise(tree))
    text = text.when(F.col("name") == "addendum.md", F.when(k == 7, " ").otherwise(_ADDENDUM + "x" * 300)).otherwise("text")
    rows = table(spark, sf, "supplier").select("s_suppkey", F.posexplode(F.array(*map(F.lit, rules.PACKAGE_FILES))).alias("i", "name")).filter(F.col("i") != k)
    return rows.select(F.concat(F.lit("s"), "s_suppkey").alias("paper_id"), "name", text.alias("text"))


def package_violations(spark, sf):
    return rules.package_violations(package_files(spark, sf), files.flatten_trees)


def package_report(spark, sf):
    found = package_files(spark, sf)
    return rules.report(found, rules.package_violations(found, files.flatten_trees), "paper_id").select("paper_id", "valid", "errors", "warnings")


_PACKAGE_SQL = "WITH s AS (SELECT 's' || s_suppkey AS paper_id, s_suppkey % 10 AS k FROM supplier), v AS (" + _cases(
    "s",
    {f"paper_id, 'error' AS severity, 'missing {n}' AS rule": f"k = {i}" for i, n in enumerate(rules.PACKAGE_FILES)}
    | {"paper_id, 'error', 'rubric: tree is no JSON'": "k = 6", "paper_id, 'error', 'addendum: addendum is empty'": "k = 7", "paper_id, 'warning', 'addendum: addendum is short'": "k = 7"}
    | {f"paper_id, 'warning', 'addendum: no section on {t}'": "k = 7" for t in rules.TOPICS}
    | {"paper_id, 'error', 'rubric: weight is negative or not finite'": "k = 9", "paper_id, 'warning', 'rubric: weight is no whole number from 0 to 3'": "k = 9", "paper_id, 'error', 'rubric: effective weights do not sum to 1'": "k = 9"},
) + ")"


def paper_list_violations(spark, sf):
    """Parts as entries of a paper list, with a fault by partkey % 9; every ninth stands there twice."""
    k = F.col("p_partkey") % 9
    quoted = lambda name, value: F.concat(F.lit(f'"{name}": '), value)
    own = F.when(k == 1, F.concat(F.lit('"Part_'), "p_partkey", F.lit('"'))).when(k == 7, F.lit("5")).otherwise(F.concat(F.lit('"part-'), "p_partkey", F.lit('"')))
    fields = [
        quoted("id", own), quoted("title", F.when(k == 2, F.lit('" "')).otherwise(F.to_json(F.array("p_name")).substr(F.lit(2), F.length(F.to_json(F.array("p_name"))) - 2))),
        quoted("pdf_url", F.when(k == 3, F.lit("null")).otherwise(F.lit('"https://h.example/p.pdf"'))), quoted("blacklist", F.when(k == 4, F.lit("5")).when(k == 6, F.lit("[]")).when(k == 8, F.lit("null")).otherwise(F.lit('"x"'))),
    ]
    rows = table(spark, sf, "part").select((2 * F.col("p_partkey")).alias("ord"), F.parse_json(F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))).alias("paper"), k.alias("k"))
    rows = rows.select("ord", "paper").union(rows.filter("k = 5").select(F.col("ord") + 1, "paper"))
    return rules.violations(rules.paper_entries(rows), rules.paper_rules(), ["ord", "label"])


def submissions(spark, sf):
    """A submission for each customer; its committed files are the customer's orders."""
    size = F.col("o_orderkey") % 1000 * 1_000_000
    line = F.concat(F.lit("100644 blob 0123abcd "), size.cast("string"), F.lit("\tf"), F.col("o_orderkey").cast("string"))
    own = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_sort(F.collect_list(line)).alias("lines"))
    k = F.col("c_custkey")
    facts = {n: k % (11 + i) != 1 for i, n in enumerate(("exists", "has_readme", "git_available", "is_repository", "root_is_directory", "has_head", "readme_tracked", "has_script", "script_tracked"))}
    facts |= {n: k % 7 != i for i, n in enumerate(submission.READY)}
    status = F.when(k % 23 == 1, F.lit(" M README.md\n")).when(k % 23 == 2, F.lit("?? new.txt\n")).otherwise("")
    listing = F.when(k % 29 != 1, F.concat(F.array_join(F.coalesce("lines", F.array().cast("array<string>")), "\x00"), F.lit("\x00160000 commit 0123abcd       -\tsub\x00")))
    return table(spark, sf, "customer").join(own, "c_custkey", "left").select("c_custkey", *(c.alias(n) for n, c in facts.items()), status.alias("status"), listing.alias("listing"), F.when(k % 31 == 1, 1).alias("clean_status"))


def submission_preflight(spark, sf):
    return submission.preflight(submissions(spark, sf)).select("c_custkey", "committed_files", "committed_bytes", "valid", "ready", "failed")


def submission_preflight_code_only(spark, sf):
    return submission.preflight(submissions(spark, sf), code_only=True).select("c_custkey", "valid", "ready")


def submission_violations(spark, sf):
    found = rules.violations(submission.preflight(submissions(spark, sf)), submission.rules(), ["c_custkey"])
    return found.groupBy("rule").agg(F.count("*").alias("n"), F.min("c_custkey").alias("first"))


_FACTS = ("exists", "has_readme", "git_available", "is_repository", "root_is_directory", "has_head", "readme_tracked", "has_script", "script_tracked")
_PREFLIGHT = f"""o AS (SELECT o_custkey, count(*) AS n, sum(o_orderkey % 1000 * 1000000) AS b FROM orders GROUP BY 1),
f AS (
  SELECT c_custkey, c_custkey % 31 <> 1 AS cleaned, {", ".join(f"c_custkey % {11 + i} <> 1 AS {n}" for i, n in enumerate(_FACTS))}, c_custkey % 23 <> 1 AS tree_clean,
    CAST(CASE WHEN c_custkey % 29 = 1 THEN 0 ELSE coalesce(n, 0) END AS BIGINT) AS committed_files, CAST(CASE WHEN c_custkey % 29 = 1 THEN 0 ELSE coalesce(b, 0) END AS BIGINT) AS committed_bytes,
    c_custkey % 29 <> 1 AND coalesce(b, 0) <= 1000000000 AS size_ok FROM customer LEFT JOIN o ON o_custkey = c_custkey
)"""
_VALID = " AND ".join((*submission.CHECKS, "cleaned"))
_SCRIPT = " AND ".join(submission.SCRIPT_CHECKS)
_READY = "c_custkey % 7 = 6"


def plans(spark, sf):
    """A plan for each nation with its customers' segments as branches, with a fault by nationkey % 13."""
    n = "n_nationkey"
    branch = lambda i, extra="": f'{{"id": "b-{i}", "requirements": "x", "weight": {i}{extra}}}'
    good = f"{branch(1)}, {branch(2)}"
    lists = {
        3: "[]", 4: "7", 5: f'[{branch(1)}, "text"]', 6: f"[{branch(1)}, {branch(2).replace('b-2', 'B 2')}]", 7: f"[{branch(1)}, {branch(1)}]", 8: f"[{branch(1)}, {branch(2).replace(chr(34) + 'x' + chr(34), 'null')}]",
        9: f"[{branch(1)}, {branch(2).replace(': 2', ': true')}]", 10: f"[{branch(1)}, {branch(-2).replace('b--2', 'b-2')}]", 11: f"[{branch(1).replace('b-1', 'root')}, {branch(2)}]",
    }
    listed = f"CASE {n} % 13 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in lists.items()) + f" ELSE '[{good}]' END"
    root = f"""'{{"root": {{' || CASE {n} % 13 WHEN 1 THEN '' ELSE '"id": "root", ' END || '"requirements": ' || CASE {n} % 13 WHEN 2 THEN '" "' ELSE '"r"' END || ', "branches": ' || {listed} || '}}}}'"""
    return table(spark, sf, "nation").selectExpr(f"{n} AS plan_id", f"parse_json(CASE {n} % 13 WHEN 12 THEN '{{}}' ELSE {root} END) AS plan")


def plan_violations(spark, sf):
    return rules.violations(contracts.branches(plans(spark, sf)), contracts.plan_rules(), ["plan_id", "pos"]).select("plan_id", F.col("pos").cast("long").alias("pos"), "rule")


def assembly_problems(spark, sf):
    """Customers of a nation as planned branches and their answers, which differ by custkey % 10."""
    k = F.col("c_custkey") % 10
    rows = table(spark, sf, "customer").select(F.col("c_nationkey").alias("plan_id"), F.col("c_custkey").alias("pos"), F.concat(F.lit("c"), "c_custkey").alias("id"), F.col("c_mktsegment").alias("requirements"), (1 + k).alias("weight"), k.alias("k"))
    text = F.when(F.col("k") == 3, F.lit("[1]")).otherwise(F.to_json(F.struct(F.when(F.col("k") == 4, "other").otherwise(F.col("id")).alias("id"), F.when(F.col("k") == 5, "other").otherwise(F.col("requirements")).alias("requirements"))))
    answers = rows.filter("k <> 1").select("plan_id", "pos", F.parse_json(text).alias("answer"))
    made = contracts.assemble(rows.filter("k <> 2"), contracts.subtree_answers(answers))
    return made.filter("problem is not null").select("plan_id", "pos", "problem")


def weight_plan_entries(spark, sf):
    """A weight plan for each supplier, by suppkey % 6."""
    k = "s_suppkey % 6"
    lists = {1: '"no list"', 2: '[5, {"node_id": "a", "weight": 2}]', 3: '[{"node_id": " ", "weight": 2}]', 4: '[{"node_id": "a", "weight": true}, {"node_id": "b", "weight": 1.5}, {"node_id": "c", "weight": 9}]'}
    listed = f"CASE {k} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in lists.items()) + """ ELSE '[{"node_id": "a", "weight": 3}]' END"""
    found = table(spark, sf, "supplier").selectExpr("concat('s', s_suppkey) AS tree_id", f"parse_json('{{\"weights\": ' || {listed} || '}}') AS plan")
    return contracts.weight_entries(found)


GATE_FILES = ("addendum", "plan", "review", "rubric", "unresolved", "weights")


def drafts(spark, sf):
    """Facts of a draft for each part, with a fault by partkey's remainders."""
    k = F.col("p_partkey")
    names = F.filter(F.array(*(F.when(k % 17 != i, F.lit(n)) for i, n in enumerate(GATE_FILES))), lambda x: x.isNotNull())
    when = lambda n, r, a, b: F.when(k % n == r, a).otherwise(b)
    return table(spark, sf, "part").select(
        k.alias("paper_id"), names.alias("artefacts"), when(7, 1, "old", "v1").alias("tag"), when(7, 2, 3, 0).alias("tree_errors"), when(7, 3, 1, 0).alias("addendum_errors"), when(11, 1, 2, 0).alias("blocking_issues"),
        when(11, 2, 1, 0).alias("unresolved"), (k % 11 != 3).alias("weights_valid"), F.lit("h").alias("recorded_hash"), F.when(k % 13 != 1, when(13, 2, "g", "h")).alias("actual_hash"), when(13, 3, "d", "p").alias("draft_hash"),
        F.lit("p").alias("pruned_hash"), when(5, 1, 1, 0).alias("targets"), (k % 10 == 1).alias("replace"), (k % 19 + 1).alias("leaves"),
    )


def publish_gate(spark, sf):
    return rules.violations(drafts(spark, sf), contracts.gate_rules(GATE_FILES, "v1"), ["paper_id"]).select("paper_id", "rule")


def publishable(spark, sf):
    """Drafts that no rule holds back."""
    found = drafts(spark, sf)
    return found.join(rules.violations(found, contracts.gate_rules(GATE_FILES, "v1"), ["paper_id"]), "paper_id", "left_anti").select("paper_id")


def conversion_gate(spark, sf):
    k = F.col("paper_id")
    hashes = lambda n: F.when(k % n != 0, F.create_map(F.lit("addendum"), F.when(k % n == 1, "x").otherwise("a"), F.lit("rubric"), F.lit("r")))
    found = drafts(spark, sf).withColumns({"approved_hashes": hashes(23), "actual_hashes": F.create_map(F.lit("rubric"), F.lit("r"), F.lit("addendum"), F.lit("a")), "leaves": F.when(k % 29 != 1, F.col("leaves")).otherwise(0), "fits": k % 31 != 1})
    return rules.violations(found, contracts.conversion_rules("v1", approved=True), ["paper_id"]).select("paper_id", "rule")


def option_checks(spark, sf):
    k = F.col("p_partkey")
    rows = table(spark, sf, "part").select(
        k, F.when(k % 11 == 1, 9999).otherwise(10_000).alias("chunk_chars"), F.when(k % 11 == 2, 0).otherwise(1).alias("workers"), F.when(k % 11 != 3, F.lit(2)).alias("paper_workers"), (k % 11 == 4).alias("overwrite"),
        (k % 22 == 4).alias("resume"), F.when(k % 11 > 4, F.lit("m")).alias("switch_model"), F.when((k % 11 > 5), k % 11 - 6).cast("long").alias("switch_after"), F.lit(4).alias("papers"),
        F.when(k % 13 == 1, F.lit("a b")).otherwise("20260101-120000").alias("batch_id"), F.array(F.lit(5), k % 13 - 2).alias("timeouts"), F.lit(100).alias("total_timeout"), (k % 17 + 90).alias("needed"),
    )
    return rules.violations(rows, contracts.option_rules(), ["p_partkey"]).select("p_partkey", "rule")


def resume_checks(spark, sf):
    k = F.col("p_partkey")
    rows = table(spark, sf, "part").select(
        k, F.when(k % 7 != 1, F.when(k % 7 == 2, "regular").otherwise("code-dev")).alias("recorded_mode"), F.when(k % 5 == 1, "regular").otherwise("code-dev").alias("mode"), F.when(k % 3 == 1, "old").when(k % 3 == 2, "v1").alias("tag"), (k % 4 != 1).alias("has_complete_tree")
    )
    return rules.violations(rows, contracts.resume_rules("v1"), ["p_partkey"]).select("p_partkey", "rule")


def pruned_tree_hashes(spark, sf):
    """Whether a draft is what pruning its complete tree gives: nations' trees, some of which have changed since."""
    from ..operators import tree
    from .trees import nation_trees

    nodes = nation_trees(spark, sf).withColumn("task_category", F.when(F.substring("node_id", 1, 1) == "o", F.element_at(F.array(*map(F.lit, tree.CATEGORIES)), (F.substring("node_id", 2, 20).cast("long") % 3 + 1).cast("int"))))
    pruned = tree.prune_to(nodes).drop("path")
    draft = pruned.filter((F.col("tree_id") % 4 != 1) | (F.col("depth") < 2))
    draft = draft.withColumn("task_category", F.when((F.col("tree_id") % 4 != 2) | (F.col("depth") < 1), F.col("task_category")))
    both = contracts.tree_hash(pruned).withColumnRenamed("sha256", "p").join(contracts.tree_hash(draft).withColumnRenamed("sha256", "d"), "tree_id")
    return both.select("tree_id", (F.col("p") == F.col("d")).alias("same"))


def whole_json(spark, sf):
    """Orders as JSON texts by o_orderkey % 8: only those that are one object from end to end have a key."""
    key = F.col("o_orderkey")
    body = F.concat(F.lit('{"k": '), key, F.lit(', "s": "}{ \\\\\\" ]", "n": [{"k": 0}]}'))
    k = key % 8
    told = F.when(k == 1, F.concat(body, F.lit(" and "), body)).when(k == 2, F.concat(body, F.lit(" x"))).when(k == 3, F.concat(F.lit("["), body, F.lit("]"))).when(k == 4, F.concat(F.lit(" "), body, F.lit("\n")))
    told = told.when(k == 5, F.concat(body, body)).when(k == 6, F.concat(body, F.lit("}"))).when(k == 7, F.replace(body, F.lit('"n": [{'), F.lit('"n": [NaN, {'))).otherwise(body)
    return table(spark, sf, "orders").select("o_orderkey", F.try_variant_get(strict_json(told), "$.k", "bigint").alias("k"))


QUERIES = (
    whole_json,     json_tree_nodes, structure_violations, json_tree_report, package_violations, package_report, paper_list_violations, submission_preflight, submission_preflight_code_only, submission_violations,
    plan_violations, assembly_problems, weight_plan_entries, publish_gate, publishable, conversion_gate, option_checks, resume_checks, pruned_tree_hashes,
)
_T = "t AS (SELECT 'c' || c_custkey AS tree_id, c_custkey, c_custkey % 12 AS k FROM customer)"
_GATE = _cases("p", {
    **{f"paper_id, 'artefact is missing'{' AS rule' if not i else ''}": f"k % 17 = {i}" for i in (0,)}, "paper_id , 'artefact is missing'": "k % 17 BETWEEN 1 AND 5", "paper_id, 'tree has errors'": "k % 7 = 2", "paper_id, 'addendum has errors'": "k % 7 = 3",
    "paper_id, 'review blocks'": "k % 11 = 1", "paper_id, 'questions are open'": "k % 11 = 2", "paper_id, 'weights were not applied'": "k % 11 = 3", "paper_id, 'target is there'": "k % 5 = 1 AND k % 10 <> 1",
    "paper_id, 'derivation is another one'": "k % 7 = 1", "paper_id, 'no complete tree'": "k % 13 = 1", "paper_id, 'complete tree has changed'": "k % 13 = 2", "paper_id, 'draft is not the complete tree''s part'": "k % 13 = 3",
})
_P = "p AS (SELECT p_partkey AS paper_id, p_partkey AS k FROM part)"
SQL = {
    "whole_json": "SELECT o_orderkey, CASE WHEN o_orderkey % 8 IN (0, 4, 7) THEN o_orderkey END AS k FROM orders",
    "json_tree_nodes": f"""WITH {_T} SELECT tree_id, 'tree-' || c_custkey AS node_id, CAST(NULL AS VARCHAR) AS parent_id, CAST(0 AS BIGINT) AS ord, 0 AS depth, CAST(1 AS DOUBLE) AS weight, CAST(NULL AS VARCHAR) AS task_category FROM t WHERE k NOT IN (1, 7)
      UNION ALL SELECT tree_id, CASE WHEN k = 5 THEN 'root.sub_tasks[0]' ELSE 'leaf-' || c_custkey || '-1' END, 'tree-' || c_custkey, 0, 1, CASE WHEN k <> 4 THEN 1 END, 'Code Development' FROM t WHERE k NOT IN (1, 2, 7)
      UNION ALL SELECT tree_id, 'leaf-' || c_custkey || '-2', 'tree-' || c_custkey, 1, 1, 1, 'Code Development' FROM t WHERE k NOT IN (1, 7)""",
    "structure_violations": f"WITH {_T} " + _cases("t", {
        "tree_id, 'root' AS path, 'error' AS severity, 'root is no object' AS rule": "k = 1", "tree_id, 'root', 'error', 'tree is no JSON'": "k = 7", "tree_id, 'root.sub_tasks[0]', 'error', 'node is no object'": "k = 2",
        "tree_id, 'root', 'error', 'fields are unknown'": "k = 3", "tree_id, 'root.sub_tasks[0]', 'error', 'fields are missing'": "k = 4", "tree_id, 'root.sub_tasks[0]', 'error', 'id is empty'": "k = 5",
        "tree_id, 'root.sub_tasks[0]', 'error', 'sub_tasks is no list'": "k = 6",
    }),
    "json_tree_report": f"""WITH {_T}, e AS (SELECT *, CAST(CASE WHEN k IN (1, 2, 3, 5, 6, 7) THEN 1 WHEN k = 4 THEN 2 ELSE 0 END AS BIGINT) AS errors FROM t)
      SELECT tree_id, errors = 0 AS valid, errors, CAST(CASE WHEN k IN (1, 7) THEN 0 ELSE 2 END AS BIGINT) AS warnings, CAST(CASE WHEN k IN (1, 7) THEN 1 ELSE 3 END AS BIGINT) AS nodes,
        CAST(CASE WHEN k IN (1, 7) THEN 0 WHEN k = 2 THEN 1 ELSE 2 END AS BIGINT) AS leaves, CAST(CASE WHEN k IN (1, 7) THEN 0 ELSE 1 END AS BIGINT) AS max_depth FROM e""",
    "package_violations": f"{_PACKAGE_SQL} SELECT * FROM v",
    "package_report": f"""{_PACKAGE_SQL} SELECT paper_id, coalesce(e, 0) = 0 AS valid, coalesce(e, 0) AS errors, coalesce(w, 0) AS warnings
      FROM s LEFT JOIN (SELECT paper_id, count(*) FILTER (severity = 'error') AS e, count(*) FILTER (severity = 'warning') AS w FROM v GROUP BY 1) USING (paper_id)""",
    "paper_list_violations": """WITH e AS (SELECT 2 * p_partkey AS ord, p_partkey, p_partkey % 9 AS k FROM part UNION ALL SELECT 2 * p_partkey + 1, p_partkey, 5 FROM part WHERE p_partkey % 9 = 5),
      l AS (SELECT *, CASE WHEN k = 1 THEN 'Part_' || p_partkey WHEN k = 7 THEN 'entry ' || ord ELSE 'part-' || p_partkey END AS label FROM e)
      """ + _cases("l", {
        "ord, label, 'error' AS severity, 'id is not kebab-case' AS rule": "k IN (1, 7)", "ord, label, 'error', 'title is empty'": "k = 2", "ord, label, 'error', 'no PDF source'": "k = 3",
        "ord, label, 'error', 'blacklist is neither text nor list'": "k = 4", "ord, label, 'error', 'id is not unique'": "k = 5",
    }),
    "submission_preflight": f"""WITH {_PREFLIGHT} SELECT c_custkey, committed_files, committed_bytes, {_VALID} AND {_SCRIPT} AS valid, {_VALID} AND {_SCRIPT} AND {_READY} AS ready,
      concat_ws(',', {", ".join(f"CASE WHEN NOT {n} THEN '{n}' END" for n in submission.CHECKS + submission.SCRIPT_CHECKS)}) AS failed FROM f""",
    "submission_preflight_code_only": f"WITH {_PREFLIGHT} SELECT c_custkey, {_VALID} AS valid, {_VALID} AND {_READY} AS ready FROM f",
    "submission_violations": f"WITH {_PREFLIGHT}, v AS (" + _cases("f", {f"c_custkey, 'not {n}' AS rule": f"NOT {n}" for n in submission.CHECKS + submission.SCRIPT_CHECKS} | {"c_custkey, 'copy was not cleaned'": "NOT cleaned"})
      + ") SELECT rule, count(*) AS n, min(c_custkey) AS first FROM v GROUP BY rule",
    "plan_violations": "WITH p AS (SELECT n_nationkey AS plan_id, n_nationkey % 13 AS k FROM nation) " + _cases("p", {
        "plan_id, CAST(0 AS BIGINT) AS pos, 'root has no id' AS rule": "k = 1", "plan_id, 1, 'root has no id'": "k = 1", "plan_id, NULL, 'root has no id'": "k = 12", "plan_id, 0, 'root has no requirements'": "k = 2",
        "plan_id, 1, 'root has no requirements'": "k = 2", "plan_id, NULL, 'root has no requirements'": "k = 12", "plan_id, NULL, 'no branches'": "k IN (3, 4, 12)", "plan_id, 1, 'branch is no object'": "k = 5",
        "plan_id, 1, 'branch id is not kebab-case'": "k = 6", "plan_id, 0, 'branch id is not unique'": "k IN (7, 11)", "plan_id, 1, 'branch id is not unique'": "k = 7", "plan_id, 1, 'branch has no requirements'": "k = 8",
        "plan_id, 1, 'branch weight is no number from 0 on'": "k IN (9, 10)",
    }),
    "assembly_problems": "WITH c AS (SELECT c_nationkey AS plan_id, c_custkey AS pos, c_custkey % 10 AS k FROM customer) " + _cases("c", {
        "plan_id, pos, 'no subtree' AS problem": "k = 1", "plan_id, pos, 'no branch'": "k = 2", "plan_id, pos, 'subtree is no object'": "k = 3", "plan_id, pos, 'other id'": "k = 4", "plan_id, pos, 'other requirements'": "k = 5",
    }),
    "weight_plan_entries": "WITH s AS (SELECT 's' || s_suppkey AS tree_id, s_suppkey % 6 AS k FROM supplier) " + _cases("s", {
        "tree_id, CAST(NULL AS BIGINT) AS ord, CAST(NULL AS VARCHAR) AS node_id, CAST(NULL AS DOUBLE) AS weight, 'plan has no list' AS problem": "k = 1", "tree_id, 0, NULL, NULL, 'entry is no object'": "k = 2",
        "tree_id, 1, 'a', 2, NULL": "k = 2", "tree_id, 0, NULL, 2, 'entry has no node'": "k = 3", "tree_id, 0, 'a', NULL, NULL": "k = 4", "tree_id, 1, 'b', NULL, NULL": "k = 4", "tree_id, 2, 'c', 9, NULL": "k = 4",
        "tree_id, 0, 'a', 3, NULL": "k IN (0, 5)",
    }),
    "publish_gate": f"WITH {_P} {_GATE}",
    "publishable": f"WITH {_P}, v AS ({_GATE}) SELECT paper_id FROM p WHERE paper_id NOT IN (SELECT paper_id FROM v)",
    "conversion_gate": f"WITH {_P} " + _cases("p", {
        "paper_id, 'tree has errors' AS rule": "k % 7 = 2", "paper_id, 'addendum has errors'": "k % 7 = 3", "paper_id, 'no leaf'": "k % 29 = 1", "paper_id, 'time does not suffice'": "k % 31 = 1",
        "paper_id, 'derivation is another one'": "k % 7 = 1", "paper_id, 'approval does not match'": "k % 23 IN (0, 1)",
    }),
    "option_checks": "WITH p AS (SELECT p_partkey, p_partkey AS k FROM part) " + _cases("p", {
        "p_partkey, 'chunk is too small' AS rule": "k % 11 = 1", "p_partkey, 'no worker'": "k % 11 = 2", "p_partkey, 'no worker for papers'": "k % 11 = 3", "p_partkey, 'overwrite and resume exclude each other'": "k % 22 = 4",
        "p_partkey, 'half of a model switch'": "k % 11 = 5", "p_partkey, 'switch does not split the list'": "k % 11 IN (6, 10)", "p_partkey, 'batch id is not of its form'": "k % 13 = 1",
        "p_partkey, 'timeout is not positive'": "k % 13 <= 2", "p_partkey, 'total timeout does not suffice'": "k % 17 > 10",
    }),
    "resume_checks": "WITH p AS (SELECT p_partkey, p_partkey AS k FROM part) " + _cases("p", {
        "p_partkey, 'mode has changed' AS rule": "k % 7 <> 1 AND (k % 7 = 2) <> (k % 5 = 1)", "p_partkey, 'derivation is stale'": "k % 5 <> 1 AND k % 3 = 1", "p_partkey, 'complete tree is missing'": "k % 5 <> 1 AND k % 4 = 1",
    }),
    "pruned_tree_hashes": """WITH o AS (SELECT c_nationkey, count(*) FILTER (o_orderkey % 3 = 0) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
      SELECT CAST(n_nationkey AS VARCHAR) AS tree_id, NOT (n_nationkey % 4 IN (1, 2) AND coalesce(n, 0) > 0) AS same FROM nation LEFT JOIN o ON c_nationkey = n_nationkey""",
}
