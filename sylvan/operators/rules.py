"""Constraint rules as data: each rule is a severity, a name and a condition on a row; a check gives one row a violation.

Conditions of one row are evaluated together in one pass over the table and exploded, so a catalogue costs one scan
however many rules it has. Rules over a whole tree are aggregates of their own."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import kept
from . import tree

#: Identifiers; terms that join conditions, that claim a match, that say by how much; placeholders; topics.
KEBAB = r"^[a-z0-9]+(?:-[a-z0-9]+)*$"
CONJUNCTIONS = r"(?i)\b(?:and|plus)\b|以及|并且|同时|且"
VAGUE = r"(?i)\b(?:match(?:es|ed)?|same as|consistent with)\b|一致|匹配"
MEASURED = r"(?i)within|tolerance|higher|lower|improv|decreas|increas|ranking|trend|at least|at most|no more than|no less than|[<>]=?|≈|~|±|优于|低于|高于|趋势|容差|至少|至多"
PLACEHOLDERS = r"(?i)\b(?:todo|tbd|fixme)\b|待定|待补充|未知"
TOPICS = {
    "scope": ("scope", "范围"),
    "approved adaptations": ("approved adaptation", "允许的调整", "批准的调整"),
    "required comparisons and evidence": ("required comparison", "required evidence", "必要比较", "所需证据"),
    "clarifications": ("clarification", "澄清"),
    "out of scope": ("out of scope", "范围外", "不在范围"),
}
ADDENDUM_LEAST = 300


@dataclass(frozen=True)
class Rule:
    name: str
    broken: Column
    severity: str = "error"


def violations(rows: DataFrame, rules: Sequence[Rule], keys: Sequence[str]) -> DataFrame:
    """(keys, severity, rule) of every rule that a row breaks; an unknown condition counts as kept."""
    marks = F.array(*(F.when(r.broken, F.struct(F.lit(r.severity).alias("severity"), F.lit(r.name).alias("rule"))) for r in rules))
    return rows.select(*keys, F.explode(F.filter(marks, lambda m: m.isNotNull())).alias("v")).select(*keys, "v.*")


def compound(text: Column) -> Column:
    return F.regexp_count(text, F.lit(CONJUNCTIONS)) >= 2


def unmeasured(text: Column) -> Column:
    return text.rlike(VAGUE) & ~text.rlike(MEASURED)


def node_rules(code_only: bool = False) -> list[Rule]:
    """Rules of a single node; `children`, `copies` and `group_weight` come from `tree_violations`."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    leaf, weight = F.col("children") == 0, F.col("weight").cast("double")
    category, fine = F.col("task_category"), F.col("fine_category")
    rules = [
        Rule("id is empty", blank("node_id")),
        Rule("id is not unique", F.col("has_id") & (F.col("copies") > 1)),
        Rule("id is not kebab-case", F.col("has_id") & ~blank("node_id") & ~F.col("node_id").rlike(KEBAB)),
        Rule("requirements are empty", blank("requirements")),
        Rule("weight is no number", weight.isNull()),
        Rule("weight is negative or not finite", F.isnan(weight) | (weight < 0) | (weight == float("inf"))),
        Rule("weight is no whole number from 0 to 3", ~weight.isin(0.0, 1.0, 2.0, 3.0), "warning"),
        Rule("leaf category is unknown", leaf & ~F.coalesce(category.isin(*tree.CATEGORIES), F.lit(False))),
        Rule("leaf fine category is unknown", leaf & ~F.coalesce(fine.isin(*tree.FINE_CATEGORIES), F.lit(False))),
        Rule("leaf may be compound", leaf & compound(F.col("requirements")), "warning"),
        Rule("match without a measure", leaf & (category == tree.CATEGORIES[2]) & unmeasured(F.col("requirements")), "warning"),
        Rule("inner category is set", ~leaf & category.isNotNull()),
        Rule("inner fine category is set", ~leaf & fine.isNotNull()),
        Rule("inner node has one child", F.col("children") == 1, "warning"),
        Rule("child weights sum to 0", ~leaf & ~F.coalesce(F.col("group_weight") > 0, F.lit(False))),
        Rule("depth is above the limit", F.col("depth") > tree.DEPTH_WARNING, "warning"),
        Rule("root weight is not 1", (F.col("depth") == 0) & (weight != 1), "warning"),
    ]
    return [*rules, Rule("leaf is of another category", leaf & (category != tree.CATEGORIES[0]))] if code_only else rules


def effective_violations(nodes: DataFrame) -> DataFrame:
    """(tree_id, severity, rule) of the rules on effective weights."""
    effective = tree.leaves(tree.effective_weights(nodes, sound_sums=True)).groupBy("tree_id").agg(F.sum("effective").alias("total"), F.count_if((F.col("effective") > 0) & (F.col("effective") < 0.001)).alias("tiny"))
    return violations(
        effective, [Rule("effective weights do not sum to 1", F.abs(F.col("total") - 1) > 1e-8 * F.greatest(F.lit(1.0), F.abs("total"))), Rule("leaf weighs below a thousandth", F.col("tiny") > 0, "warning")], ["tree_id"]
    )


def tree_violations(nodes: DataFrame, code_only: bool = False) -> DataFrame:
    """(tree_id, node_id, severity, rule) over `nodes(tree_id, node_id, parent_id, depth, requirements, weight,
    task_category, fine_category)`, or those of `flatten_trees`: rows with a fault count as children of their parent and are
    no nodes. Rules of the whole tree have no node_id."""
    weight = F.col("weight").cast("double")
    sound = F.when(~F.isnan(weight) & (weight >= 0) & (weight < float("inf")), weight)
    children = nodes.filter("parent_id is not null").groupBy("tree_id", F.col("parent_id").alias("node_id")).agg(F.count("*").alias("children"), F.sum(sound).alias("group_weight"))
    copies = nodes.groupBy("tree_id", "node_id").agg(F.count("*").alias("copies"))
    own = {"has_id": F.lit(True), "fault": F.lit(None).cast("string")}
    nodes = nodes.withColumns({c: x for c, x in own.items() if c not in nodes.columns}).filter("fault is null")
    full = nodes.join(children, tree.KEY, "left").join(copies, tree.KEY, "left").withColumn("children", F.coalesce("children", F.lit(0)))
    single = violations(full, node_rules(code_only), tree.KEY)
    counted = full.groupBy("tree_id").agg(*(F.count_if((F.col("children") == 0) & (F.col("task_category") == c)).alias(f"c{i}") for i, c in enumerate(tree.CATEGORIES)))
    absent = violations(counted, [Rule(f"no leaf of category {c}", F.col(f"c{i}") == 0, "warning") for i, c in enumerate(tree.CATEGORIES)], ["tree_id"])
    whole = absent.union(effective_violations(nodes)).select("tree_id", F.lit(None).cast("string").alias("node_id"), "severity", "rule")
    return single.unionByName(whole)


def structure_rules() -> list[Rule]:
    """Rules of a row of `flatten_trees` on what JSON it comes from."""
    node, some = F.col("fault").isNull(), lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    return [
        *(Rule(f, F.col("fault").eqNullSafe(F.lit(f))) for f in ("tree is no JSON", "root is no object", "node is no object")), Rule("fields are missing", node & some("missing")),
        Rule("fields are unknown", node & some("extra")), Rule("id is empty", node & ~F.col("has_id")), Rule("sub_tasks is no list", node & ~F.col("listed")),
    ]


def json_tree_violations(flat: DataFrame, code_only: bool = False) -> DataFrame:
    """(tree_id, node_id, severity, rule) over the rows of `flatten_trees`: structure, nodes and whole trees."""
    structure = violations(flat, structure_rules(), tree.KEY)
    return structure.unionByName(tree_violations(flat, code_only).filter("rule <> 'id is empty'"))


def tree_report(flat: DataFrame, code_only: bool = False) -> DataFrame:
    """(tree_id, valid, errors, warnings, nodes, leaves, max_depth) of every tree. Leaves are sound nodes without children."""
    found = json_tree_violations(flat, code_only).groupBy("tree_id").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    parents = flat.filter("parent_id is not null").select("tree_id", F.col("parent_id").alias("node_id"), F.lit(True).alias("inner")).distinct()
    sizes = flat.join(parents, tree.KEY, "left").groupBy("tree_id").agg(
        F.count("*").alias("nodes"), F.count_if(F.col("inner").isNull() & F.col("fault").isNull()).alias("leaves"), F.max("depth").cast("long").alias("max_depth")
    )
    out = sizes.join(found, "tree_id", "left").na.fill(0, ["errors", "warnings"])
    return out.withColumn("valid", F.col("errors") == 0).select("tree_id", "valid", "errors", "warnings", "nodes", "leaves", "max_depth")


def first_names(found: DataFrame, rule: str, most: int = 20) -> DataFrame:
    """(tree_id, names): the first nodes that break a rule, by id, as one text."""
    place = F.row_number().over(Window.partitionBy("tree_id").orderBy("node_id"))
    some = found.filter(F.col("rule") == rule).withColumn("place", place).filter(F.col("place") <= most)
    return some.groupBy("tree_id").agg(F.array_join(F.array_sort(F.collect_list("node_id")), ", ").alias("names"))


def addendum_rules(text: Column) -> list[Rule]:
    text = F.coalesce(text, F.lit(""))
    lower = F.lower(text)
    topics = [Rule(f"no section on {t}", ~reduce(Column.__or__, (F.contains(lower, F.lit(w)) for w in words)), "warning") for t, words in TOPICS.items()]
    return [Rule("addendum is empty", ~text.rlike(r"(?U)\S")), *topics, Rule("placeholder is left", text.rlike(PLACEHOLDERS)), Rule("addendum is short", F.length(text) < ADDENDUM_LEAST, "warning")]


def _filled(v: Column) -> Column:
    """Whether a variant holds something: no null, false, zero, empty text, list or object."""
    kind = F.schema_of_variant(v)
    empty = F.trim(F.to_json(v)).isin('""', "0", "0.0", "false", "null", "[]", "{}")
    return F.coalesce(v.isNotNull() & (kind != "VOID") & ~empty, F.lit(False))


def paper_entries(papers: DataFrame) -> DataFrame:
    """`papers(ord, paper)` variants to `(ord, label, id, title, sourced, blacklist_kind, copies)`, ord from 1."""
    get = lambda path, kind: F.try_variant_get("paper", path, kind)
    kind = lambda path: F.coalesce(F.schema_of_variant(get(path, "variant")), F.lit("VOID"))
    text = lambda path: F.when(kind(path) == "STRING", get(path, "string"))
    sourced = reduce(Column.__or__, (_filled(get(f"$.{k}", "variant")) for k in ("pdf_path", "paper_pdf", "pdf_url")))
    rows = papers.select("ord", text("$.id").alias("id"), text("$.title").alias("title"), sourced.alias("sourced"), kind("$.blacklist").alias("blacklist_kind"))
    counts = rows.filter("id is not null").groupBy("id").agg(F.count("*").alias("copies"))
    label = F.coalesce(F.nullif(F.col("id"), F.lit("")), F.concat(F.lit("entry "), F.col("ord").cast("string")))
    return rows.join(counts, "id", "left").withColumn("label", label)


def paper_rules() -> list[Rule]:
    """Rules of a row of `paper_entries`."""
    kebab = F.coalesce(F.col("id").rlike(KEBAB), F.lit(False))
    return [
        Rule("id is not kebab-case", ~kebab), Rule("title is empty", ~F.coalesce(F.col("title").rlike(r"(?U)\S"), F.lit(False))), Rule("no PDF source", ~F.col("sourced")),
        Rule("blacklist is neither text nor list", ~((F.col("blacklist_kind") == "STRING") | (F.col("blacklist_kind") == "VOID") | F.startswith("blacklist_kind", F.lit("ARRAY")))),
        Rule("id is not unique", kebab & (F.col("copies") > 1)),
    ]


#: Fixed value: files of a package.
PACKAGE_FILES = ("addendum.md", "blacklist.txt", "config.yaml", "paper.md", "paper.pdf", "rubric.json")


def package_violations(files: DataFrame, flatten, code_only: bool = False) -> DataFrame:
    """(paper_id, severity, rule) over `files(paper_id, name, text)`: files that are missing, and what the tree and the addendum break,
    under their names. `flatten` makes nodes of `(tree_id, json)`, see `flatten_trees`."""
    names = files.groupBy("paper_id").agg(F.collect_set("name").alias("names"))
    absent = names.select("paper_id", F.explode(F.array_except(F.array(*map(F.lit, PACKAGE_FILES)), "names")).alias("name"))
    absent = absent.select("paper_id", F.lit("error").alias("severity"), F.concat(F.lit("missing "), "name").alias("rule"))
    trees = kept(files.sparkSession, flatten(files.filter("name = 'rubric.json'").select(F.col("paper_id").alias("tree_id"), F.col("text").alias("json"))), "flat")
    in_tree = json_tree_violations(trees, code_only).select(F.col("tree_id").alias("paper_id"), "severity", F.concat(F.lit("rubric: "), "rule").alias("rule"))
    addenda = files.filter("name = 'addendum.md'")
    in_addendum = violations(addenda, addendum_rules(F.col("text")), ["paper_id"]).select("paper_id", "severity", F.concat(F.lit("addendum: "), "rule").alias("rule"))
    return absent.union(in_tree).union(in_addendum)


def report(subjects: DataFrame, found: DataFrame, key: str, fail_on_warning: bool = False) -> DataFrame:
    """(key, valid, errors, warnings) of every subject; `valid` asks for no warning either, if they are to fail."""
    counted = found.groupBy(key).agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    out = subjects.select(key).distinct().join(counted, key, "left").na.fill(0, ["errors", "warnings"])
    return out.withColumn("valid", (F.col("errors") == 0) & (F.lit(not fail_on_warning) | (F.col("warnings") == 0)))


def text_rules(texts: DataFrame, rules: DataFrame, keys: Sequence[str], needle: Column | None = None) -> DataFrame:
    """`rules(file, needle, wanted)` against `texts(file, ..., text)`: needles that are wanted and missing or unwanted and there. Rules
    are a catalogue of some hundred rows. `needle`: the needle as each row of `texts` fills it in."""
    both = texts.join(F.broadcast(rules), "file").withColumn("needle", F.col("needle") if needle is None else needle)
    return both.filter(F.contains("text", F.col("needle")) != F.col("wanted")).select(*keys, "file", "needle", "wanted")
