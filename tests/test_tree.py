from fractions import Fraction

import pytest

from sylvan.operators import rules, score, tree

NODES = "tree_id string, node_id string, parent_id string, ord long, depth int, weight double, task_category string, fine_category string, requirements string"
DEV, RUN, ANALYSIS = tree.CATEGORIES
FINE = "Method Implementation"
VALID = [
    ("t", "root", None, 0, 0, 1.0, None, None, "reproduce the paper"),
    ("t", "method", "root", 0, 1, 3.0, None, None, "the method"),
    ("t", "method-implementation", "method", 0, 2, 3.0, DEV, FINE, "the method is there"),
    ("t", "main-execution", "method", 1, 2, 2.0, RUN, FINE, "the method runs"),
    ("t", "main-trend", "method", 2, 2, 3.0, ANALYSIS, FINE, "the trend is shown"),
    ("t", "interface", "root", 1, 1, 1.0, None, None, " "),
    ("t", "entrypoint", "interface", 0, 2, 1.0, RUN, FINE, "there is an entry"),
    ("t", "machine-readable-results", "interface", 1, 2, 1.0, DEV, FINE, "results are files"),
]


@pytest.fixture
def nodes(spark):
    return spark.createDataFrame(VALID, NODES)


def test_effective_weights_are_products_of_shares(nodes):
    got = {r.node_id: r.effective for r in tree.leaves(tree.effective_weights(nodes)).collect()}
    want = {"method-implementation": Fraction(9, 32), "main-execution": Fraction(6, 32), "main-trend": Fraction(9, 32), "entrypoint": Fraction(1, 8), "machine-readable-results": Fraction(1, 8)}
    assert got == pytest.approx({k: float(v) for k, v in want.items()}) and sum(got.values()) == pytest.approx(1)


def test_score_is_recursive_and_missing_leaves_are_zero(spark, nodes):
    scores = spark.createDataFrame([("t", "method-implementation", 1.0)], "tree_id string, node_id string, score double")
    got = {r.node_id: r.score for r in tree.tree_scores(nodes, scores).collect()}
    assert got["root"] == pytest.approx(9 / 32) and got["method"] == pytest.approx(3 / 8)


def test_score_equals_the_sum_over_effective_weights(spark, nodes):
    scores = spark.createDataFrame([("t", n, s) for n, s in (("main-trend", 1.0), ("entrypoint", 1.0), ("main-execution", 0.0))], "tree_id string, node_id string, score double")
    root = tree.tree_scores(nodes, scores).filter("depth = 0").first().score
    flat = tree.leaves(tree.effective_weights(nodes)).join(scores, tree.KEY).selectExpr("sum(effective * score) AS s").first().s
    assert root == pytest.approx(flat)


def test_group_without_weight_scores_zero_but_keeps_its_own(spark):
    rows = [r if r[2] != "interface" else (*r[:5], 0.0, *r[6:]) for r in VALID]
    nodes = spark.createDataFrame(rows, NODES)
    scores = spark.createDataFrame([("t", r[1], 1.0) for r in VALID], "tree_id string, node_id string, score double")
    assert tree.tree_scores(nodes, scores).filter("depth = 0").first().score == pytest.approx(0.75)


def test_pruning_keeps_leaves_of_the_category_and_their_ancestors(nodes):
    pruned = tree.prune_to(nodes)
    assert {r.node_id for r in pruned.collect()} == {"root", "method", "method-implementation", "interface", "machine-readable-results"}
    got = {r.node_id: r.effective for r in tree.leaves(tree.effective_weights(pruned)).collect()}
    assert got == pytest.approx({"method-implementation": 0.75, "machine-readable-results": 0.25})
    again = tree.prune_to(pruned)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, pruned.collect()), key=str)


def test_tree_without_such_a_leaf_becomes_its_root(spark):
    nodes = spark.createDataFrame([r for r in VALID if r[6] != DEV], NODES)
    only = tree.prune_to(nodes).collect()
    assert [(r.node_id, r.task_category, r.fine_category) for r in only] == [("root", DEV, None)]


def test_contexts_leave_out_blank_requirements(nodes):
    got = {r.node_id: r.context for r in tree.leaf_contexts(nodes, "|").collect()}
    assert got["entrypoint"] == "reproduce the paper" and got["main-trend"] == "reproduce the paper|the method"


def test_valid_tree_breaks_no_rule_but_a_blank_requirement(nodes):
    got = {(r.node_id, r.rule) for r in rules.tree_violations(nodes).collect()}
    assert got == {("interface", "requirements are empty")}


def test_faults_are_found(spark):
    rows = [*VALID, VALID[2], ("t", "Bad_Id", "interface", 2, 2, float("nan"), "Other", None, "a and b and c")]
    got = {(r.node_id, r.rule) for r in rules.tree_violations(spark.createDataFrame(rows, NODES), code_only=True).collect()}
    assert {("method-implementation", "id is not unique"), ("Bad_Id", "id is not kebab-case"), ("Bad_Id", "weight is negative or not finite"), ("Bad_Id", "leaf category is unknown"), ("Bad_Id", "leaf may be compound"), ("main-trend", "leaf is of another category")} <= got


def test_leaf_scores_are_binary(spark):
    answers = [
        ("a", 1, '{"leaves":[{"leaf_id":"a","score":1,"rationale":"x"}]}'), ("b", 1, '{"leaf_id":"b","score":0.5}'), ("c", 1, 'so ```json\n{"c":{"score":1.0}}\n```'),
        ("d", 1, '{"items":[{"id":"d","score":true},{"id":"d","score":1}]}'), ("e", 1, '{"leaves":[{"leaf_id":"x","score":1}]}'),
    ]
    rows = score.response_rows(spark.createDataFrame(answers, "leaf_id string, ord long, response string"))
    got = {r.leaf_id: (r.score, r.invalid) for r in score.leaf_scores(rows).collect()}
    assert got == {"a": (1.0, 0), "b": (0.0, 1), "c": (1.0, 0), "d": (0.0, 2), "e": (0.0, 1)}


def test_rules_on_effective_weights(spark, monkeypatch):
    from sylvan.plans import trees

    row = lambda t, n, parent, k, depth, w: (t, n, parent, k, depth, w, None if n in ("root", "a") else DEV, FINE, "it is there")
    fixture = [row(t, "root", None, 0, 0, 1.0) for t in ("even", "least", "tiny", "nought")]
    fixture += [row("even", "x", "root", 0, 1, 1.0), row("even", "y", "root", 1, 1, 1.0)]
    fixture += [row("least", "x", "root", 0, 1, 1.0), row("least", "y", "root", 1, 1, 998.0)]
    fixture += [row("tiny", "x", "root", 0, 1, 1.0), row("tiny", "y", "root", 1, 1, 1001.0)]
    fixture += [row("nought", "a", "root", 0, 1, 1.0), row("nought", "y", "root", 1, 1, 3.0), row("nought", "x", "a", 0, 2, 0.0)]
    monkeypatch.setattr(trees, "faulty_nodes", lambda *_: spark.createDataFrame(fixture, NODES))
    found = trees.rules.effective_violations(trees.faulty_nodes(spark, ""))
    got = {tuple(r) for r in found.select("tree_id", "severity", "rule").collect()}
    names = trees.rules.first_names(trees.rules.tree_violations(trees.faulty_nodes(spark, ""), code_only=True), "inner node has one child")
    assert {tuple(r) for r in names.collect()} == {("nought", "a")}
    assert got == {("tiny", "warning", "leaf weighs below a thousandth"), ("nought", "error", "effective weights do not sum to 1")}


def test_places_of_one_large_tree_are_given_by_many_tasks(spark):
    count = 3_000
    rows = spark.range(count).selectExpr("'t' AS tree_id", "concat('n', id) AS node_id", "'root' AS parent_id", "id AS ord", "1 AS depth", "1.0D + id % 7 AS weight")
    other = spark.createDataFrame([("t", "root", None, 0, 0, 1.0), ("u", "only", None, 0, 0, 1.0), (None, "lost", None, 0, 0, 1.0)], "tree_id string, node_id string, parent_id string, ord long, depth int, weight double")
    got = tree.ranked_weights(rows.unionByName(other), 1)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan
    found = {(r.tree_id, r.node_id): r.place for r in got.collect()}
    want = sorted(range(count), key=lambda i: (-(1 + i % 7), f"n{i}"))
    assert [found["t", f"n{i}"] for i in want] == list(range(1, count + 1)) and found["u", "only"] == 1 and found[None, "lost"] == 1 and len(found) == count + 2


def test_numbers_go_on_from_range_to_range(spark):
    from pyspark.sql import functions as F

    from sylvan.sources.tables import numbered

    rows = spark.range(2_000).selectExpr("id", "CASE WHEN id % 10 < 7 THEN 'large' WHEN id % 10 < 9 THEN 'small' END AS g", "id % 5 AS v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that there are four ranges
    try:
        got = numbered(rows, "g", [F.col("v").desc(), F.col("id").asc()], "n").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for g in ("large", "small", None):
        own = sorted((r for r in got if r.g == g), key=lambda r: (-r.v, r.id))
        assert [r.n for r in own] == list(range(1, len(own) + 1)) and own
    assert len(got) == 2_000
