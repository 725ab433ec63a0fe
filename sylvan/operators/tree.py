"""Criteria trees as adjacency tables.

A node is `(tree_id, node_id, parent_id, ord, depth, weight, task_category, ...)`; a root has no parent and depth 0, a leaf no
children. Weights count among siblings only. All passes go level by level over the known, small depth; within a level
siblings are combined by aggregation before the shuffle, so a parent with very many children is no hot spot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import numbered

#: Fixed values of the data model.
CATEGORIES = ("Code Development", "Code Execution", "Result Analysis")
FINE_CATEGORIES = (
    "Environment & Infrastructure Setup", "Dataset and Model Acquisition", "Data Processing & Preparation", "Method Implementation", "Experimental Setup",
    "Evaluation, Metrics & Benchmarking", "Logging, Analysis & Presentation",
)
#: Deeper trees are only warned about; passes go as far as the nodes do.
DEPTH_WARNING = 9

KEY = ["tree_id", "node_id"]


def depth_of(nodes: DataFrame) -> int:
    """The greatest depth, or -1 without nodes. One number reaches the driver."""
    return -1 if (found := nodes.agg(F.max("depth")).first()[0]) is None else int(found)


def leaves(nodes: DataFrame) -> DataFrame:
    parents = nodes.filter("parent_id is not null").select("tree_id", F.col("parent_id").alias("node_id")).distinct()
    return nodes.join(parents, KEY, "left_anti")


def _has_paths(nodes: DataFrame) -> bool:
    return dict(nodes.dtypes).get("path") == "array<string>"


def sound_weight(weight: Column) -> Column:
    """A weight as a judge counts it: what is no number or negative is 0."""
    number = F.coalesce(weight.try_cast("double"), F.lit(0.0))
    return F.when(F.isnan(number) | (number < 0), 0.0).otherwise(number)


def _group_weights(nodes: DataFrame, sound_sums: bool) -> DataFrame:
    """`(tree_id, parent_id, group_weight)`, combined before the shuffle."""
    counted = F.col("weight") if not sound_sums else F.when(~F.isnan(F.col("weight").cast("double")) & (F.col("weight") >= 0) & (F.col("weight") < float("inf")), F.col("weight"))
    return nodes.filter("parent_id is not null").groupBy("tree_id", "parent_id").agg(F.sum(counted).alias("group_weight"))


def sibling_shares(nodes: DataFrame, sound_sums: bool = False) -> DataFrame:
    """`share`: the weight over its siblings' sum; 1 for a root, 0 in a group without weight. With `sound_sums` only weights that are
    finite and not negative are summed."""
    share = F.when(F.col("parent_id").isNull(), 1.0).when(F.col("group_weight") > 0, F.col("weight") / F.col("group_weight")).otherwise(0.0)
    return nodes.join(_group_weights(nodes, sound_sums), ["tree_id", "parent_id"], "left").withColumn("share", share)


def descended(inner: DataFrame, depth: int, first: dict[str, Column], then: dict[str, Column]) -> DataFrame:
    """Values that inner nodes take from above, level by level: `first` at the roots, `then` below, whose columns can name a parent's value as `above_<name>`.
    Only inner nodes are joined, each with its own parent, so no ancestor is a key of all that is below it. Gives KEY and the values."""
    level = inner.filter("depth = 0").select(*KEY, *(c.alias(n) for n, c in first.items()))
    levels = [level]
    for d in range(1, depth):
        above = level.select("tree_id", F.col("node_id").alias("parent_id"), *(F.col(n).alias(f"above_{n}") for n in first))
        level = inner.filter(F.col("depth") == d).join(above, ["tree_id", "parent_id"]).select(*KEY, *(c.alias(n) for n, c in then.items()))
        levels.append(level)
    return reduce(DataFrame.unionByName, levels)


def _parents(nodes: DataFrame) -> DataFrame:
    return nodes.filter("parent_id is not null").select("tree_id", F.col("parent_id").alias("node_id")).distinct()


def effective_weights(nodes: DataFrame, depth: int | None = None, sound_sums: bool = False) -> DataFrame:
    """`effective`: the product of the shares from the root down; see `sibling_shares`. The products of inner nodes come down level by level, and every node
    is joined once, with its parent's."""
    depth = depth_of(nodes) if depth is None else depth
    sums = _group_weights(nodes, sound_sums).withColumnRenamed("parent_id", "node_id")
    inner = nodes.select(*KEY, "parent_id", "depth", "weight").join(sums, KEY)
    share = lambda group: F.when(F.col(group) > 0, F.col("weight") / F.col(group)).otherwise(0.0)
    known = {"group_weight": F.col("group_weight"), "effective": F.lit(1.0)}
    above = descended(inner, depth, known, known | {"effective": F.col("above_effective") * share("above_group_weight")})
    both = nodes.join(above.select("tree_id", F.col("node_id").alias("parent_id"), "group_weight", F.col("effective").alias("above")), ["tree_id", "parent_id"], "left")
    both = both.withColumn("share", F.when(F.col("parent_id").isNull(), 1.0).otherwise(share("group_weight")))
    return both.withColumn("effective", F.col("share") * F.coalesce("above", F.lit(1.0))).drop("above")


def tree_scores(nodes: DataFrame, scores: DataFrame, depth: int | None = None) -> DataFrame:
    """Weighted means from the leaves up: `(tree_id, node_id, depth, score)` of every node.

    `scores(tree_id, node_id, score)`; a leaf without a score has 0. Weights count as in `sound_weight`. A group without weight scores 0 but keeps its own
    weight in its parent."""
    depth = depth_of(nodes) if depth is None else depth
    own = nodes.join(scores.select(*KEY, F.col("score").alias("own")), KEY, "left")
    counted, below, levels = sound_weight(F.col("weight")), None, []
    for d in range(depth, -1, -1):
        level = own.filter(F.col("depth") == d)
        if below is None:
            scored = level.withColumn("score", F.coalesce("own", F.lit(0.0)))
        else:
            means = below.groupBy("tree_id", F.col("parent_id").alias("node_id")).agg(
                F.coalesce(F.try_divide(F.sum(counted * F.col("score")), F.sum(counted)), F.lit(0.0)).alias("mean")
            )
            scored = level.join(means, KEY, "left").withColumn("score", F.coalesce("mean", "own", F.lit(0.0))).drop("mean")
        below = scored
        levels.append(scored.select(*KEY, "depth", "score"))
    return reduce(DataFrame.unionByName, levels)


def with_paths(nodes: DataFrame, depth: int | None = None) -> DataFrame:
    """`path`: a node's ancestors from the root down; nodes that have it already keep it. Inner nodes hand theirs down, and every node is joined once."""
    if _has_paths(nodes):
        return nodes
    inner = nodes.select(*KEY, "parent_id", "depth").join(_parents(nodes), KEY, "left_semi")
    none = F.array().cast("array<string>")
    known = descended(inner, depth_of(nodes) if depth is None else depth, {"path": none}, {"path": F.concat("above_path", F.array("parent_id"))})
    above = known.select("tree_id", F.col("node_id").alias("parent_id"), F.concat("path", F.array("node_id")).alias("path"))
    return nodes.drop("path").join(above, ["tree_id", "parent_id"], "left").withColumn("path", F.coalesce("path", none))


def prune_to(nodes: DataFrame, category: str = CATEGORIES[0], depth: int | None = None) -> DataFrame:
    """The leaves of a category and exactly their ancestors; weights stay, internal categories go. A tree of which
    nothing is left keeps its root as a leaf of that category, without a fine category.

    Leaves name their ancestors by path, so one explode, combined before the shuffle, finds all that stays."""
    nodes = with_paths(nodes, depth)
    wanted = leaves(nodes).filter(F.col("task_category") == category)
    named = wanted.select("tree_id", F.explode(F.concat(F.transform("path", lambda p: F.struct(p.alias("node_id"), F.lit(False).alias("is_leaf"))), F.array(F.struct("node_id", F.lit(True).alias("is_leaf"))))).alias("x"))
    kept = named.select("tree_id", "x.*").groupBy(*KEY).agg(F.max("is_leaf").alias("is_leaf"))
    out = nodes.join(kept, KEY, "left")
    emptied = F.col("is_leaf").isNull() & (F.col("depth") == 0)  # whatever is kept of a tree keeps its root
    out = out.filter(F.col("is_leaf").isNotNull() | emptied)
    cleared = {"task_category": F.when(F.col("is_leaf") | emptied, F.lit(category))}
    if "fine_category" in nodes.columns:
        cleared["fine_category"] = F.when(F.col("is_leaf") & ~emptied, F.col("fine_category"))
    return out.withColumn("emptied", emptied).withColumns(cleared).drop("is_leaf", "emptied")


def leaf_contexts(nodes: DataFrame, separator: str = " > ", depth: int | None = None) -> DataFrame:
    """Each leaf with its ancestors' requirements from the root down, blank ones left out."""
    inner = nodes.select(*KEY, "parent_id", "depth", "requirements").join(_parents(nodes), KEY, "left_semi")
    own = F.when(F.trim("requirements") != "", F.col("requirements"))
    known = descended(inner, depth_of(nodes) if depth is None else depth, {"context": own}, {"context": F.nullif(F.concat_ws(separator, "above_context", own), F.lit(""))})
    above = known.select("tree_id", F.col("node_id").alias("parent_id"), "context")
    return leaves(nodes).join(above, ["tree_id", "parent_id"], "left").withColumn("context", F.coalesce("context", F.lit("")))


def as_json(nodes: DataFrame, depth: int | None = None) -> DataFrame:
    """`(tree_id, json)`: each tree as nested JSON, put together level by level from the deepest; children in order of `ord`."""
    depth = depth_of(nodes) if depth is None else depth
    quoted = lambda c: F.regexp_replace(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", "$1")
    number = F.col("weight").cast("double")
    weight = F.when(number == F.floor(number), F.floor(number).cast("string")).otherwise(number.cast("string"))
    below, roots = None, None
    for d in range(depth, -1, -1):
        level = nodes.filter(F.col("depth") == d)
        level = level.withColumn("kids", F.lit("")) if below is None else level.join(below, KEY, "left")
        text = F.concat(
            F.lit('{"id": '), quoted(F.col("node_id")), F.lit(', "requirements": '), quoted(F.col("requirements")), F.lit(', "weight": '), F.coalesce(weight, F.lit("null")), F.lit(', "sub_tasks": ['), F.coalesce("kids", F.lit("")),
            F.lit('], "task_category": '), quoted(F.col("task_category")), F.lit(', "finegrained_task_category": '), quoted(F.col("fine_category")), F.lit("}"),
        )
        own = level.withColumn("json", text)
        below = own.filter("parent_id IS NOT NULL").groupBy("tree_id", F.col("parent_id").alias("node_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "json"))), lambda x: x["json"]), ", ").alias("kids"))
        roots = own.filter("parent_id IS NULL").select("tree_id", "json")
    return roots


def tree_stats(nodes: DataFrame) -> DataFrame:
    """Counts of one tree each: nodes, leaves, greatest depth, top branches and single-child parents."""
    children = nodes.filter("parent_id is not null").groupBy("tree_id", F.col("parent_id").alias("node_id")).agg(F.count("*").alias("children"))
    return (
        nodes.join(children, KEY, "left")
        .groupBy("tree_id")
        .agg(
            F.count("*").alias("nodes"), F.count_if(F.col("children").isNull()).alias("leaves"), F.max("depth").cast("long").alias("max_depth"),
            F.count_if(F.col("depth") == 1).alias("branches"), F.count_if(F.col("children") == 1).alias("single_child"),
        )
    )


def category_histogram(nodes: DataFrame) -> DataFrame:
    """Leaves of each category in all trees, with 0 for a category without leaves, and its percentage."""
    spark = nodes.sparkSession
    names = spark.createDataFrame([(c,) for c in CATEGORIES], "task_category string")
    counted = leaves(nodes).groupBy("task_category").agg(F.count("*").alias("n"))
    out = names.join(counted, "task_category", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    total = counted.agg(F.sum("n").alias("total"))
    return out.crossJoin(total).select("task_category", "n", F.round(100 * F.try_divide("n", "total"), 6).alias("percent"))


def apply_weights(nodes: DataFrame, plan: DataFrame) -> DataFrame:
    """`plan(tree_id, node_id, weight, ord)` onto the nodes: the first entry of a node counts, only whole weights from 1 to 3 do, a
    root stays 1, a node without an entry keeps its weight."""
    good = plan.filter(F.col("weight").between(1, 3) & (F.col("weight") == F.floor("weight")))
    first = plan.groupBy(*KEY).agg(F.min("ord").alias("ord"))
    chosen = good.join(first, [*KEY, "ord"], "left_semi").dropDuplicates(KEY).select(*KEY, F.col("weight").cast("long").alias("planned"))
    weight = F.when(F.col("depth") == 0, F.lit(1)).otherwise(F.coalesce("planned", "weight")).cast("long")
    return nodes.join(chosen, KEY, "left").withColumn("weight", weight).drop("planned")


def audit_weights(nodes: DataFrame, plan: DataFrame) -> DataFrame:
    """(tree_id, node_id, problem) of a plan: unknown, missing, repeated, invalid, root."""
    own, asked = nodes.select(*KEY, "depth"), plan.select(*KEY).distinct()
    found = [
        asked.join(own, KEY, "left_anti").select(*KEY, F.lit("unknown").alias("problem")),
        own.join(asked, KEY, "left_anti").select(*KEY, F.lit("missing").alias("problem")),
        plan.groupBy(*KEY).count().filter("count > 1").select(*KEY, F.lit("repeated").alias("problem")),
        plan.filter(~F.coalesce(F.col("weight").between(1, 3) & (F.col("weight") == F.floor("weight")), F.lit(False))).select(*KEY, F.lit("invalid").alias("problem")).distinct(),
        plan.filter("weight <> 1").join(own.filter("depth = 0"), KEY, "left_semi").select(*KEY, F.lit("root").alias("problem")).distinct(),
    ]
    return reduce(DataFrame.union, found)


def batch_statistics(nodes: DataFrame) -> DataFrame:
    """Mean, median and range over the trees of nodes, leaves, depth and branches: one row a measure."""
    per_tree = tree_stats(nodes)
    measures = ("nodes", "leaves", "max_depth", "branches")
    long = per_tree.select(F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).alias("v")) for m in measures))).alias("x")).select("x.*")
    return long.groupBy("measure").agg(
        F.sum("v").alias("total"), F.round(F.avg("v"), 6).alias("mean"), F.round(F.median("v"), 6).alias("median"), F.min("v").alias("least"), F.max("v").alias("most")
    )


def ranked_weights(nodes: DataFrame, depth: int | None = None) -> DataFrame:
    """Leaves by falling effective weight, equal ones in order of their ids: `(tree_id, place, node_id, effective)`."""
    found = leaves(effective_weights(nodes, depth)).select("tree_id", "node_id", "effective")
    placed = numbered(found, "tree_id", [F.round("effective", 12).desc(), F.col("node_id").asc()], "place")
    return placed.select("tree_id", F.col("place").cast("int").alias("place"), "node_id", "effective")


def fine_histogram(nodes: DataFrame) -> DataFrame:
    """Leaves of each fine category, 0 for one without leaves, with its percentage."""
    names = nodes.sparkSession.createDataFrame([(c,) for c in FINE_CATEGORIES], "fine_category string")
    counted = leaves(nodes).groupBy("fine_category").agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n").alias("total"))
    out = names.join(counted, "fine_category", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.crossJoin(total).select("fine_category", "n", F.round(100 * F.try_divide("n", "total"), 6).alias("percent"))


def scale_table(nodes: DataFrame) -> DataFrame:
    """One row a tree: nodes, inner nodes, leaves, branches, depth, children of an inner node, single-child ones."""
    stats = tree_stats(nodes)
    inner = F.col("nodes") - F.col("leaves")
    return stats.select("tree_id", "nodes", inner.alias("inner"), "leaves", "branches", "max_depth", F.round(F.try_divide(F.col("nodes") - 1, inner), 6).alias("children"), "single_child")


def flat_weight_sum(nodes: DataFrame) -> DataFrame:
    """The leaves' own weights added up, negative and missing ones as 0: a diagnosis, no score."""
    weight = F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0))
    return leaves(nodes).groupBy("tree_id").agg(F.sum(weight).alias("weight_total"), F.array_sort(F.collect_set("task_category")).alias("categories"))
