import json
import tomllib

from pyspark.sql import functions as F

from sylvan.functions import render
from sylvan.operators import contracts, models, rules


def plans(spark, *roots):
    rows = [(str(i), json.dumps({"root": r})) for i, r in enumerate(roots)]
    return spark.createDataFrame(rows, "plan_id string, j string").select("plan_id", F.parse_json("j").alias("plan"))


def test_plans(spark):
    good = {"id": "root", "requirements": "r", "branches": [{"id": "a", "requirements": "x", "weight": 2}]}
    bad = {"id": "root", "requirements": " ", "branches": [{"id": "root", "requirements": "", "weight": True}, 5, {"id": "B_", "requirements": "x", "weight": -1}]}
    found = rules.violations(contracts.branches(plans(spark, good, bad, {"id": "r", "requirements": "r", "branches": []})), contracts.plan_rules(), ["plan_id"])
    got = {(r.plan_id, r.rule) for r in found.collect()}
    assert got == {
        ("1", "root has no requirements"), ("1", "branch id is not unique"), ("1", "branch has no requirements"), ("1", "branch weight is no number from 0 on"), ("1", "branch is no object"),
        ("1", "branch id is not kebab-case"), ("2", "no branches"),
    }


def test_assembly(spark):
    plan = spark.createDataFrame([("p", 0, "a", "x", 2), ("p", 1, "b", "y", 1), ("p", 2, "c", "z", 1)], "plan_id string, pos int, id string, requirements string, weight int")
    made = spark.createDataFrame([("p", 0, "a", "x"), ("p", 1, "q", "y"), ("p", 3, "d", "w")], "plan_id string, pos int, id string, requirements string")
    assert {r.pos: r.problem for r in contracts.assemble(plan, made).collect()} == {0: None, 1: "other id", 2: "no subtree", 3: "no branch"}


def test_gates(spark):
    schema = "k int, artefacts array<string>, tag string, tree_errors int, addendum_errors int, blocking_issues int, unresolved int, weights_valid boolean, recorded_hash string, actual_hash string, targets int, replace boolean, draft_hash string, pruned_hash string"
    rows = [(1, ["a", "b"], "t", 0, 0, 0, 0, True, "h", "h", 1, True, "p", "p"), (2, ["a"], None, 1, 0, 2, 1, None, "h", "g", 1, False, "p", "p")]
    got = {(r.k, r.rule) for r in rules.violations(spark.createDataFrame(rows, schema), contracts.gate_rules(["a", "b"], "t"), ["k"]).collect()}
    assert {k for k, _ in got} == {2} and len(got) == 8


def test_folders_and_modes(spark):
    entries = spark.createDataFrame([("t", "tests/run.sh", False, "755"), ("t", "tests/x.py", False, "755"), ("t", "tests", True, "644"), ("u", "tests/run.sh", False, "644")], "task_id string, path string, is_folder boolean, mode string")
    got = {tuple(r) for r in contracts.folder_audit(entries.filter("not is_folder"), {"tests": ["run.sh"], "solution": ["README.md"]}).collect()}
    assert got == {("t", "tests", "x.py", "extra"), ("t", "solution", "README.md", "missing"), ("u", "solution", "README.md", "missing")}
    assert {(r.task_id, r.path) for r in contracts.mode_audit(entries, ["tests/run.sh"]).collect()} == {("t", "tests/x.py"), ("t", "tests"), ("u", "tests/run.sh")}
    files = spark.createDataFrame([("t", "a", "1"), ("t", "b", "2"), ("u", "a", "9")], "task_id string, path string, sha256 string")
    templates = spark.createDataFrame([("a", "1"), ("b", "2")], "path string, sha256 string")
    assert {tuple(r) for r in contracts.template_audit(files, templates).collect()} == {("u", "a"), ("u", "b")}


def test_clients_fail_alone(spark):
    calls = spark.createDataFrame([(str(i), "leaf", f"p{i}") for i in range(6)], "call_id string, call string, prompt string")

    def client():
        def send(call, prompt):
            if prompt == "p3":
                raise TimeoutError("late")
            return f"{call}:{prompt}"

        return send

    got = {r.call_id: (r.answer, r.error) for r in models.ask(calls, client, 2).collect()}
    assert got["3"] == (None, "TimeoutError: late") and got["4"] == ("leaf:p4", None) and len(got) == 6
    answers = spark.createDataFrame([("x", "leaf", "own"), (None, "leaf", "common")], "paper_id string, call string, answer string")
    asked = spark.createDataFrame([("x", "leaf"), ("y", "leaf"), ("y", "other")], "paper_id string, call string")
    assert {(r.paper_id, r.call): r.answer for r in models.canned(asked, answers).collect()} == {("x", "leaf"): "own", ("y", "leaf"): "common", ("y", "other"): None}


def test_rendered_texts_parse(spark):
    text = spark.createDataFrame([('a "b" \\ é',)], "t string").select(render.toml({"": {"name": F.col("t")}, "run.limits": {"seconds": 600, "gpu": True, "kind": "x"}}).alias("x")).first().x
    assert tomllib.loads(text) == {"name": 'a "b" \\ é', "run": {"limits": {"seconds": 600, "gpu": True, "kind": "x"}}}
    listing = "100644 blob abc     12\tREADME.md\x00160000 commit def       -\tsub\x00"
    row = spark.createDataFrame([(listing, "?? new\n", " M old")], "l string, s string, d string").select(render.tree_listing(F.col("l")).alias("x"), render.tracked_clean(F.col("s")).alias("a"), render.tracked_clean(F.col("d")).alias("b")).first()
    assert [tuple(e) for e in row.x] == [("README.md", 12), ("sub", None)] and row.a and not row.b
