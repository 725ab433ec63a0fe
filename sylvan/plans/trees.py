"""Queries over the criteria tree region > nation > customer > orders, and over lang > source > document."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rules, score, tree
from ..sources.tables import table

CATEGORY = "CASE {k} % 3 WHEN 0 THEN 'Code Development' WHEN 1 THEN 'Code Execution' ELSE 'Result Analysis' END"


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def order_tree(spark: SparkSession, sf: str, weight: str = "1 + o_orderkey % 3", paths: bool = False) -> DataFrame:
    """With `paths`, each node also names its ancestors, which takes a join by customer."""
    nation, customer, orders = (table(spark, sf, n) for n in ("nation", "customer", "orders"))
    if paths:
        customer = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        orders = orders.join(customer.select("c_custkey", "c_nationkey", "n_regionkey"), F.col("o_custkey") == F.col("c_custkey"))

    def level(rows, path, key, depth, w, category, text):
        """path: SQL for the ids from the root to the node itself."""
        return rows.selectExpr(
            "'T' AS tree_id", f"{path[-1]} AS node_id", f"{path[-2] if path[1:] else 'CAST(NULL AS STRING)'} AS parent_id", f"CAST({key} AS BIGINT) AS ord", f"{depth} AS depth",
            f"CAST({w} AS BIGINT) AS weight", f"CAST({category} AS STRING) AS task_category", f"{text} AS requirements",
            *([f"CAST(array({', '.join(path[:-1])}) AS ARRAY<STRING>) AS path"] if paths else []),
        )

    root, region = "'root'", "concat('r', {})".format
    return _union([
        level(spark.range(1), [root], "0", 0, "1", "NULL", "'all orders'"),
        level(table(spark, sf, "region"), [root, region("r_regionkey")], "r_regionkey", 1, "1 + r_regionkey % 3", "NULL", "r_name"),
        level(nation, [root, region("n_regionkey"), "concat('n', n_nationkey)"], "n_nationkey", 2, "1 + n_nationkey % 3", "NULL", "n_name"),
        level(customer, [root, region("n_regionkey"), "concat('n', c_nationkey)", "concat('c', c_custkey)"], "c_custkey", 3, "1 + c_custkey % 3", "NULL", "c_mktsegment"),
        level(orders, [root, region("n_regionkey"), "concat('n', c_nationkey)", "concat('c', o_custkey)", "concat('o', o_orderkey)"], "o_orderkey", 4, weight, CATEGORY.format(k="o_orderkey"), "o_orderpriority"),
    ])


def tree_sql(weight: str = "1 + o_orderkey % 3") -> str:
    return f"""tree AS (
  SELECT 'T' AS tree_id, 'root' AS node_id, CAST(NULL AS VARCHAR) AS parent_id, CAST(0 AS BIGINT) AS ord, 0 AS depth, CAST(1 AS BIGINT) AS weight, CAST(NULL AS VARCHAR) AS task_category, 'all orders' AS requirements
  UNION ALL SELECT 'T', 'r' || r_regionkey, 'root', r_regionkey, 1, 1 + r_regionkey % 3, NULL, r_name FROM region
  UNION ALL SELECT 'T', 'n' || n_nationkey, 'r' || n_regionkey, n_nationkey, 2, 1 + n_nationkey % 3, NULL, n_name FROM nation
  UNION ALL SELECT 'T', 'c' || c_custkey, 'n' || c_nationkey, c_custkey, 3, 1 + c_custkey % 3, NULL, c_mktsegment FROM customer
  UNION ALL SELECT 'T', 'o' || o_orderkey, 'c' || o_custkey, o_orderkey, 4, {weight}, {CATEGORY.format(k="o_orderkey")}, o_orderpriority FROM orders
)"""


SHARES = """shares AS (
  SELECT *, CASE WHEN parent_id IS NULL THEN 1.0 WHEN g > 0 THEN CAST(weight AS DOUBLE) / g ELSE 0.0 END AS share
  FROM (SELECT *, CAST(sum(weight) OVER (PARTITION BY tree_id, parent_id) AS DOUBLE) AS g FROM {t})
)"""
LEAVES = "leaves AS (SELECT * FROM {t} WHERE node_id NOT IN (SELECT parent_id FROM {t} WHERE parent_id IS NOT NULL))"


def effective_sql(depth: int, t: str = "tree") -> str:
    levels = ["e0 AS (SELECT *, CAST(1 AS DOUBLE) AS effective FROM shares WHERE depth = 0)"]
    levels += [f"e{d} AS (SELECT s.*, p.effective * s.share AS effective FROM shares s JOIN e{d - 1} p ON s.tree_id = p.tree_id AND s.parent_id = p.node_id)" for d in range(1, depth + 1)]
    union = " UNION ALL ".join(f"SELECT * FROM e{d}" for d in range(depth + 1))
    return f"{SHARES.format(t=t)}, {', '.join(levels)}, eff AS ({union})"


def score_sql(depth: int, scores: str, t: str = "tree") -> str:
    """`scores` selects tree_id, node_id, score."""
    levels = [f"own AS (SELECT n.*, q.score AS own FROM {t} n LEFT JOIN ({scores}) q USING (tree_id, node_id))"]
    levels.append(f"s{depth} AS (SELECT tree_id, node_id, parent_id, depth, weight, coalesce(own, 0.0) AS score FROM own WHERE depth = {depth})")
    for d in range(depth - 1, -1, -1):
        levels.append(
            f"s{d} AS (SELECT n.tree_id, n.node_id, n.parent_id, n.depth, n.weight, coalesce(m.mean, n.own, 0.0) AS score FROM own n LEFT JOIN ("
            f"SELECT tree_id, parent_id, CASE WHEN sum(weight) > 0 THEN sum(weight * score) / sum(weight) ELSE 0.0 END AS mean FROM s{d + 1} GROUP BY ALL) m "
            f"ON n.tree_id = m.tree_id AND n.node_id = m.parent_id WHERE n.depth = {d})"
        )
    return ", ".join(levels) + ", scored AS (" + " UNION ALL ".join(f"SELECT * FROM s{d}" for d in range(depth + 1)) + ")"


def order_scores(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr("'T' AS tree_id", "concat('o', o_orderkey) AS node_id", "IF(o_orderstatus = 'F', 1.0D, 0.0D) AS score")


ORDER_SCORES = "SELECT 'T' AS tree_id, 'o' || o_orderkey AS node_id, CASE WHEN o_orderstatus = 'F' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS score FROM orders"


def tree_adjacency(spark, sf):
    return order_tree(spark, sf).select("tree_id", "node_id", "parent_id", "ord", "depth", "weight", "task_category")


def sibling_share(spark, sf):
    return tree.sibling_shares(order_tree(spark, sf)).select("node_id", "parent_id", "weight", F.round("share", 9).alias("share"))


def effective_leaf_weight(spark, sf):
    return tree.leaves(tree.effective_weights(order_tree(spark, sf), 4)).select("node_id", F.round("effective", 12).alias("effective"))


def effective_weight_sum_check(spark, sf):
    total = tree.leaves(tree.effective_weights(order_tree(spark, sf), 4)).groupBy("tree_id").agg(F.sum("effective").alias("total"))
    return total.select("tree_id", F.round("total", 6).alias("total"), (F.abs(F.col("total") - 1) <= 1e-8).alias("valid"))


def _rounded(scored, depth):
    return scored.filter(F.col("depth") <= depth).select("node_id", "depth", F.round("score", 6).alias("score"))


def tree_score(spark, sf):
    return _rounded(tree.tree_scores(order_tree(spark, sf), order_scores(spark, sf), 4), 2)


ZERO = "CASE WHEN o_custkey % 5 = 0 THEN 0 ELSE 1 + o_orderkey % 3 END"


def tree_score_zero_weight_group(spark, sf):
    return _rounded(tree.tree_scores(order_tree(spark, sf, ZERO), order_scores(spark, sf), 4), 2)


def tree_score_odd_weights(spark, sf):
    """A quarter of the nodes of every level has a negative weight, a quarter none; both count as 0."""
    odd = F.when((F.col("depth") > 0) & (F.col("ord") % 4 == 1), -F.col("weight")).when((F.col("depth") == 0) | (F.col("ord") % 4 != 2), F.col("weight"))
    return _rounded(tree.tree_scores(order_tree(spark, sf).withColumn("weight", odd), order_scores(spark, sf), 4), 3)


def document_tree(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    row = lambda node, parent, depth, w: (F.lit("D").alias("tree_id"), node.alias("node_id"), parent.alias("parent_id"), F.lit(depth).alias("depth"), w.cast("long").alias("weight"))
    inner = F.concat_ws("/", "lang", "source")
    return _union([
        spark.range(1).select(*row(F.lit("root"), F.lit(None).cast("string"), 0, F.lit(1))),
        docs.select("lang").distinct().select(*row(F.col("lang"), F.lit("root"), 1, F.lit(1))),
        docs.select("lang", "source").distinct().select(*row(inner, F.col("lang"), 2, F.lit(1))),
        docs.select(*row(F.col("doc_id").cast("string"), inner, 3, 1 + F.col("doc_id") % 3)),
    ])


def doc_tree_score_missing_zero(spark, sf):
    scores = table(spark, sf, "labels").select(F.lit("D").alias("tree_id"), F.col("doc_id").cast("string").alias("node_id"), F.col("quality").cast("double").alias("score"))
    return _rounded(tree.tree_scores(document_tree(spark, sf), scores, 3), 2)


DOC_TREE = """tree AS (
  SELECT 'D' AS tree_id, 'root' AS node_id, CAST(NULL AS VARCHAR) AS parent_id, 0 AS depth, CAST(1 AS BIGINT) AS weight
  UNION ALL SELECT DISTINCT 'D', lang, 'root', 1, 1 FROM documents UNION ALL SELECT DISTINCT 'D', lang || '/' || source, lang, 2, 1 FROM documents
  UNION ALL SELECT 'D', CAST(doc_id AS VARCHAR), lang || '/' || source, 3, 1 + doc_id % 3 FROM documents
)"""


def code_only_prune(spark, sf):
    return tree.prune_to(order_tree(spark, sf, paths=True)).select("node_id", "parent_id", "depth", "weight", "task_category")


PRUNED = f"""{LEAVES.format(t="tree")}, k4 AS (SELECT node_id, parent_id FROM leaves WHERE task_category = 'Code Development'),
{", ".join(f"k{d} AS (SELECT DISTINCT t.node_id, t.parent_id FROM tree t JOIN k{d + 1} k ON t.node_id = k.parent_id)" for d in range(3, -1, -1))},
pruned AS (SELECT t.* REPLACE (CASE WHEN t.depth = 4 THEN t.task_category END AS task_category) FROM tree t WHERE node_id IN ({" UNION ALL ".join(f"SELECT node_id FROM k{d}" for d in range(5))}))"""


def code_only_score(spark, sf):
    return _rounded(tree.tree_scores(tree.prune_to(order_tree(spark, sf, paths=True)), order_scores(spark, sf), 4), 2)


def leaf_contexts(spark, sf):
    return tree.leaf_contexts(order_tree(spark, sf), depth=4).select("node_id", "context")


def tree_stats(spark, sf):
    return tree.tree_stats(order_tree(spark, sf))


def category_histogram(spark, sf):
    return tree.category_histogram(order_tree(spark, sf))


def depth_histogram(spark, sf):
    counted = order_tree(spark, sf).groupBy("depth").agg(F.count("*").alias("n"), F.count_if(F.col("weight") == 1).alias("weight_1"), F.count_if(F.col("weight") == 2).alias("weight_2"), F.count_if(F.col("weight") == 3).alias("weight_3"))
    total = counted.agg(F.sum("n").alias("total"))
    return counted.crossJoin(total).select("depth", "n", "weight_1", "weight_2", "weight_3", F.round(100 * F.col("n") / F.col("total"), 6).alias("percent"))


def nation_trees(spark, sf):
    """A tree for each nation: its customers and their orders."""
    row = lambda tid, node, parent, depth: (tid.cast("string").alias("tree_id"), node.alias("node_id"), parent.alias("parent_id"), F.lit(depth).alias("depth"))
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    name = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    return _union([
        table(spark, sf, "nation").select(*row(F.col("n_nationkey"), name("n", "n_nationkey"), F.lit(None).cast("string"), 0)),
        customer.select(*row(F.col("c_nationkey"), name("c", "c_custkey"), name("n", "c_nationkey"), 1)),
        orders.select(*row(F.col("c_nationkey"), name("o", "o_orderkey"), name("c", "o_custkey"), 2)),
    ])


def batch_scale_stats(spark, sf):
    return tree.batch_statistics(nation_trees(spark, sf))


NATION_TREES = """trees AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS tree_id, 'n' || n_nationkey AS node_id, CAST(NULL AS VARCHAR) AS parent_id, 0 AS depth FROM nation
  UNION ALL SELECT CAST(c_nationkey AS VARCHAR), 'c' || c_custkey, 'n' || c_nationkey, 1 FROM customer
  UNION ALL SELECT CAST(c_nationkey AS VARCHAR), 'o' || o_orderkey, 'c' || o_custkey, 2 FROM orders JOIN customer ON o_custkey = c_custkey
), kids AS (SELECT tree_id, parent_id AS node_id, count(*) AS children FROM trees WHERE parent_id IS NOT NULL GROUP BY ALL),
stats AS (
  SELECT tree_id, count(*) AS nodes, count(*) FILTER (children IS NULL) AS leaves, CAST(max(depth) AS BIGINT) AS max_depth, count(*) FILTER (depth = 1) AS branches,
    count(*) FILTER (children = 1) AS single_child FROM trees LEFT JOIN kids USING (tree_id, node_id) GROUP BY tree_id
)"""


def judge_waves(spark, sf):
    return score.timeout_plan(tree.tree_stats(nation_trees(spark, sf)))


def faulty_nodes(spark, sf):
    """The order tree with faults by rule: see `rule_violations`'s SQL for the same ones."""
    t = order_tree(spark, sf).withColumn("fine_category", F.when(F.col("depth") == 4, F.lit("Method Implementation")))
    o = F.when(F.col("depth") == 4, F.col("ord"))
    c = F.when(F.col("depth") == 3, F.col("ord"))
    hit = lambda k, n, r: F.coalesce(k % n == r, F.lit(False))
    t = t.withColumns({
        "weight": F.when(hit(o, 101, 1), F.lit(-1)).when(hit(o, 101, 2), F.lit(5)).when(hit(o, 101, 3), F.lit(None)).otherwise(F.col("weight")).cast("double"),
        "requirements": F.when(hit(o, 103, 1), F.lit(" ")).when(hit(o, 103, 2), F.lit("a and b plus c")).when(hit(o, 103, 3), F.lit("the curve matches")).when(hit(o, 103, 4), F.lit("matches within 2")).otherwise(F.col("requirements")),
        "task_category": F.when(hit(o, 107, 1), F.lit("Other")).when(hit(c, 109, 1), F.lit("Code Execution")).otherwise(F.col("task_category")),
        "node_id": F.when(hit(o, 113, 1), F.concat(F.lit("O_"), F.col("ord").cast("string"))).otherwise(F.col("node_id")),
    })
    return t.union(t.filter(hit(F.when(F.col("depth") == 4, F.col("ord")), 127, 1)))


def rule_violations(spark, sf):
    return rules.tree_violations(faulty_nodes(spark, sf)).groupBy("severity", "rule").agg(F.count("*").alias("n"), F.min("node_id").alias("first_node"))


_HIT = "(depth = {d} AND ord % {n} = {r})"
_O = lambda n, r: _HIT.format(d=4, n=n, r=r)
RULE_SQL = f"""WITH {tree_sql()}, f0 AS (
  SELECT tree_id, CASE WHEN {_O(113, 1)} THEN 'O_' || ord ELSE node_id END AS node_id, parent_id, ord, depth,
    CAST(CASE WHEN {_O(101, 1)} THEN -1 WHEN {_O(101, 2)} THEN 5 WHEN {_O(101, 3)} THEN NULL ELSE weight END AS DOUBLE) AS weight,
    CASE WHEN {_O(107, 1)} THEN 'Other' WHEN {_HIT.format(d=3, n=109, r=1)} THEN 'Code Execution' ELSE task_category END AS task_category,
    CASE WHEN {_O(103, 1)} THEN ' ' WHEN {_O(103, 2)} THEN 'a and b plus c' WHEN {_O(103, 3)} THEN 'the curve matches' WHEN {_O(103, 4)} THEN 'matches within 2' ELSE requirements END AS requirements,
    CASE WHEN depth = 4 THEN 'Method Implementation' END AS fine_category FROM tree
), f AS (SELECT * FROM f0 UNION ALL SELECT * FROM f0 WHERE {_O(127, 1)}),
kids AS (SELECT parent_id AS node_id, count(*) AS children, sum(CASE WHEN weight >= 0 THEN weight END) AS g FROM f WHERE parent_id IS NOT NULL GROUP BY 1),
copies AS (SELECT node_id, count(*) AS copies FROM f GROUP BY 1),
x AS (SELECT f.*, coalesce(children, 0) AS children, g, copies FROM f LEFT JOIN kids USING (node_id) LEFT JOIN copies USING (node_id)),
h AS (SELECT *, CASE WHEN parent_id IS NULL THEN 1.0 WHEN sum(CASE WHEN weight >= 0 THEN weight END) OVER (PARTITION BY parent_id) > 0 THEN weight / sum(CASE WHEN weight >= 0 THEN weight END) OVER (PARTITION BY parent_id) ELSE 0.0 END AS share FROM f),
e0 AS (SELECT node_id, 1.0 AS e FROM h WHERE depth = 0), {", ".join(f"e{d} AS (SELECT h.node_id, h.share * p.e AS e FROM h JOIN e{d - 1} p ON h.parent_id = p.node_id WHERE depth = {d})" for d in range(1, 5))},
total AS (SELECT sum(e) AS total, count(*) FILTER (e > 0 AND e < 0.001) AS tiny FROM ({" UNION ALL ".join(f"SELECT * FROM e{d}" for d in range(5))}) WHERE node_id NOT IN (SELECT parent_id FROM f WHERE parent_id IS NOT NULL)),
v AS (
  SELECT 'error' AS severity, 'id is not unique' AS rule, node_id FROM x WHERE copies > 1
  UNION ALL SELECT 'error', 'id is not kebab-case', node_id FROM x WHERE NOT regexp_full_match(node_id, '[a-z0-9]+(-[a-z0-9]+)*')
  UNION ALL SELECT 'error', 'requirements are empty', node_id FROM x WHERE trim(requirements) = ''
  UNION ALL SELECT 'error', 'weight is no number', node_id FROM x WHERE weight IS NULL
  UNION ALL SELECT 'error', 'weight is negative or not finite', node_id FROM x WHERE weight < 0
  UNION ALL SELECT 'warning', 'weight is no whole number from 0 to 3', node_id FROM x WHERE weight NOT IN (0, 1, 2, 3)
  UNION ALL SELECT 'error', 'leaf category is unknown', node_id FROM x WHERE children = 0 AND coalesce(task_category, '') NOT IN ('Code Development', 'Code Execution', 'Result Analysis')
  UNION ALL SELECT 'error', 'leaf fine category is unknown', node_id FROM x WHERE children = 0 AND fine_category IS NULL
  UNION ALL SELECT 'warning', 'leaf may be compound', node_id FROM x WHERE children = 0 AND len(regexp_extract_all(requirements, '(?i)\\b(?:and|plus)\\b')) >= 2
  UNION ALL SELECT 'warning', 'match without a measure', node_id FROM x WHERE children = 0 AND task_category = 'Result Analysis' AND requirements = 'the curve matches'
  UNION ALL SELECT 'error', 'inner category is set', node_id FROM x WHERE children > 0 AND task_category IS NOT NULL
  UNION ALL SELECT 'error', 'inner fine category is set', node_id FROM x WHERE children > 0 AND fine_category IS NOT NULL
  UNION ALL SELECT 'warning', 'inner node has one child', node_id FROM x WHERE children = 1
  UNION ALL SELECT 'error', 'child weights sum to 0', node_id FROM x WHERE children > 0 AND NOT coalesce(g > 0, false)
)
SELECT severity, rule, count(*) AS n, min(node_id) AS first_node FROM v GROUP BY ALL UNION ALL
SELECT 'error', 'effective weights do not sum to 1', 1, NULL FROM total WHERE abs(total - 1) > 1e-8 * greatest(1, abs(total)) UNION ALL SELECT 'warning', 'leaf weighs below a thousandth', 1, NULL FROM total WHERE tiny > 0"""


def weight_plan(spark, sf):
    """Weights for the customers with a positive balance, with unknown ids, a repeat and an invalid one."""
    c = table(spark, sf, "customer")
    pick = lambda cond, node, w, o: c.filter(cond).selectExpr("'T' AS tree_id", f"{node} AS node_id", f"{w} AS weight", f"c_custkey * 10 + {o} AS ord")
    own = "concat('c', c_custkey)"
    return _union([
        pick("c_acctbal > 0", own, "CAST(1 + c_custkey * 7 % 3 AS DOUBLE)", 1), pick("c_custkey % 97 = 1", "concat('x', c_custkey)", "2D", 2),
        pick("c_acctbal > 0 AND c_custkey % 89 = 1", own, "3D", 3), pick("c_acctbal <= 0 AND c_custkey % 83 = 1", own, "4D", 4),
        spark.range(1).selectExpr("'T' AS tree_id", "'root' AS node_id", "2D AS weight", "5L AS ord"), table(spark, sf, "orders").filter("o_orderkey % 7 = 1").selectExpr("'T' AS tree_id", "concat('o', o_orderkey) AS node_id", "2D AS weight", "o_orderkey * 10 + 6 AS ord"),
    ])


PLAN = """plan AS (
  SELECT 'c' || c_custkey AS node_id, CAST(1 + c_custkey * 7 % 3 AS DOUBLE) AS weight, c_custkey * 10 + 1 AS ord FROM customer WHERE c_acctbal > 0
  UNION ALL SELECT 'x' || c_custkey, 2, c_custkey * 10 + 2 FROM customer WHERE c_custkey % 97 = 1
  UNION ALL SELECT 'c' || c_custkey, 3, c_custkey * 10 + 3 FROM customer WHERE c_acctbal > 0 AND c_custkey % 89 = 1
  UNION ALL SELECT 'c' || c_custkey, 4, c_custkey * 10 + 4 FROM customer WHERE c_acctbal <= 0 AND c_custkey % 83 = 1
  UNION ALL SELECT 'root', 2, 5 UNION ALL SELECT 'o' || o_orderkey, 2, o_orderkey * 10 + 6 FROM orders WHERE o_orderkey % 7 = 1
)"""


def weight_plan_apply(spark, sf):
    return tree.apply_weights(order_tree(spark, sf), weight_plan(spark, sf)).select("node_id", "weight")


def weight_plan_audit(spark, sf):
    return tree.audit_weights(order_tree(spark, sf), weight_plan(spark, sf)).select("node_id", "problem")


def branch_subtree_zip(spark, sf):
    """Planned branches (regions in order) with generated subtrees (each region's first nation), one to one by place."""
    plan = table(spark, sf, "region").agg(F.array_sort(F.collect_list(F.struct("r_regionkey", "r_name"))).alias("a")).select(F.posexplode("a").alias("pos", "p"))
    made = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.min(F.struct("n_nationkey", "n_name")).alias("n"))
    made = made.agg(F.array_sort(F.collect_list(F.struct("n_regionkey", "n"))).alias("a")).select(F.posexplode("a").alias("pos", "m"))
    both = plan.join(made, "pos", "full_outer")
    return both.select(F.col("pos").cast("long").alias("pos"), F.col("p.r_name").alias("branch"), F.col("m.n.n_name").alias("subtree"), (F.col("p.r_regionkey") == F.col("m.n_regionkey")).alias("same_id"))


QUERIES = (
    tree_adjacency, sibling_share, effective_leaf_weight, effective_weight_sum_check, tree_score, tree_score_zero_weight_group, tree_score_odd_weights, doc_tree_score_missing_zero, code_only_prune, code_only_score,
    leaf_contexts, tree_stats, category_histogram, depth_histogram, batch_scale_stats, judge_waves, rule_violations, weight_plan_apply, weight_plan_audit, branch_subtree_zip,
)
_SCORED = "SELECT node_id, depth, round(score, 6) AS score FROM scored WHERE depth <= 2"
_KIDS = "kids AS (SELECT tree_id, parent_id AS node_id, count(*) AS children FROM tree WHERE parent_id IS NOT NULL GROUP BY ALL)"
SQL = {
    "tree_adjacency": f"WITH {tree_sql()} SELECT tree_id, node_id, parent_id, ord, depth, weight, task_category FROM tree",
    "sibling_share": f"WITH {tree_sql()}, {SHARES.format(t='tree')} SELECT node_id, parent_id, weight, round(share, 9) AS share FROM shares",
    "effective_leaf_weight": f"WITH {tree_sql()}, {effective_sql(4)}, {LEAVES.format(t='eff')} SELECT node_id, round(effective, 12) AS effective FROM leaves",
    "effective_weight_sum_check": f"WITH {tree_sql()}, {effective_sql(4)}, {LEAVES.format(t='eff')} SELECT tree_id, round(sum(effective), 6) AS total, abs(sum(effective) - 1) <= 1e-8 AS valid FROM leaves GROUP BY tree_id",
    "tree_score": f"WITH {tree_sql()}, {score_sql(4, ORDER_SCORES)} {_SCORED}",
    "tree_score_odd_weights": f"""WITH {tree_sql()}, odd AS (SELECT * REPLACE (CASE WHEN depth > 0 AND ord % 4 IN (1, 2) THEN 0 ELSE weight END AS weight) FROM tree), {score_sql(4, ORDER_SCORES, "odd")}
      SELECT node_id, depth, round(score, 6) AS score FROM scored WHERE depth <= 3""",
    "tree_score_zero_weight_group": f"WITH {tree_sql(ZERO)}, {score_sql(4, ORDER_SCORES)} {_SCORED}",
    "doc_tree_score_missing_zero": f"WITH {DOC_TREE}, {score_sql(3, 'SELECT DISTINCT ' + repr('D') + ' AS tree_id, CAST(doc_id AS VARCHAR) AS node_id, CAST(quality AS DOUBLE) AS score FROM labels')} {_SCORED}",
    "code_only_prune": f"WITH {tree_sql()}, {PRUNED} SELECT node_id, parent_id, depth, weight, task_category FROM pruned",
    "code_only_score": f"WITH {tree_sql()}, {PRUNED}, {score_sql(4, ORDER_SCORES, 'pruned')} {_SCORED}",
    "leaf_contexts": f"""WITH RECURSIVE {tree_sql()}, walk AS (
      SELECT node_id, requirements, CAST('' AS VARCHAR) AS context, 0 AS d FROM tree WHERE parent_id IS NULL
      UNION ALL SELECT t.node_id, t.requirements, CASE WHEN w.d = 0 THEN w.requirements ELSE w.context || ' > ' || w.requirements END, w.d + 1 FROM tree t JOIN walk w ON t.parent_id = w.node_id
    ) SELECT node_id, context FROM walk WHERE node_id NOT IN (SELECT parent_id FROM tree WHERE parent_id IS NOT NULL)""",
    "tree_stats": f"""WITH {tree_sql()}, {_KIDS} SELECT tree_id, count(*) AS nodes, count(*) FILTER (children IS NULL) AS leaves, CAST(max(depth) AS BIGINT) AS max_depth,
      count(*) FILTER (depth = 1) AS branches, count(*) FILTER (children = 1) AS single_child FROM tree LEFT JOIN kids USING (tree_id, node_id) GROUP BY tree_id""",
    "category_histogram": f"""WITH {tree_sql()}, {LEAVES.format(t='tree')}, n AS (SELECT unnest(['Code Development', 'Code Execution', 'Result Analysis']) AS task_category),
      c AS (SELECT task_category, count(*) AS n FROM leaves GROUP BY 1) SELECT task_category, coalesce(c.n, 0) AS n, round(100.0 * coalesce(c.n, 0) / (SELECT sum(n) FROM c), 6) AS percent FROM n LEFT JOIN c USING (task_category)""",
    "depth_histogram": f"""WITH {tree_sql()} SELECT depth, count(*) AS n, count(*) FILTER (weight = 1) AS weight_1, count(*) FILTER (weight = 2) AS weight_2, count(*) FILTER (weight = 3) AS weight_3,
      round(100.0 * count(*) / (SELECT count(*) FROM tree), 6) AS percent FROM tree GROUP BY depth""",
    "batch_scale_stats": f"""WITH {NATION_TREES}, l AS (UNPIVOT (SELECT nodes, leaves, max_depth, branches FROM stats) ON nodes, leaves, max_depth, branches INTO NAME measure VALUE v)
      SELECT measure, CAST(sum(v) AS BIGINT) AS total, round(avg(v), 6) AS mean, round(median(v), 6) AS median, min(v) AS least, max(v) AS most FROM l GROUP BY measure""",
    "judge_waves": f"WITH {NATION_TREES} SELECT tree_id, leaves, CAST(ceil(leaves / 100.0) AS BIGINT) AS waves, CAST(ceil(leaves / 100.0) AS BIGINT) * 600 + 604860 AS needed, CAST(ceil(leaves / 100.0) AS BIGINT) * 600 + 604860 <= 606100 AS fits FROM stats",
    "rule_violations": RULE_SQL,
    "weight_plan_apply": f"""WITH {tree_sql()}, {PLAN}, one AS (SELECT node_id, arg_min(weight, ord) AS w FROM plan GROUP BY 1)
      SELECT node_id, CAST(CASE WHEN depth = 0 THEN 1 WHEN w IN (1, 2, 3) THEN w ELSE weight END AS BIGINT) AS weight FROM tree LEFT JOIN one USING (node_id)""",
    "weight_plan_audit": f"""WITH {PLAN}, {tree_sql()}, own AS (SELECT node_id FROM tree)
      SELECT DISTINCT node_id, 'unknown' AS problem FROM plan WHERE node_id NOT IN (SELECT node_id FROM own)
      UNION ALL SELECT node_id, 'missing' FROM own WHERE node_id NOT IN (SELECT node_id FROM plan)
      UNION ALL SELECT node_id, 'repeated' FROM plan GROUP BY node_id HAVING count(*) > 1
      UNION ALL SELECT DISTINCT node_id, 'invalid' FROM plan WHERE weight NOT IN (1, 2, 3)
      UNION ALL SELECT 'root', 'root'""",
    "branch_subtree_zip": """WITH p AS (SELECT row_number() OVER (ORDER BY r_regionkey) - 1 AS pos, r_regionkey, r_name FROM region),
      m AS (SELECT row_number() OVER (ORDER BY n_regionkey) - 1 AS pos, n_regionkey, arg_min(n_name, n_nationkey) AS n_name FROM nation GROUP BY n_regionkey)
      SELECT pos, r_name AS branch, n_name AS subtree, r_regionkey = n_regionkey AS same_id FROM p FULL JOIN m USING (pos)""",
}
