import json

from pyspark.sql import functions as F

from sylvan.sources import files

ROOT = {"id": "root", "requirements": "r", "weight": 1, "task_category": None, "finegrained_task_category": None, "sub_tasks": [
    {"id": "a", "requirements": "x", "weight": True, "sub_tasks": [], "task_category": "Code Development", "finegrained_task_category": "Method Implementation", "note": 1}, "no node", {"id": "b"}]}


def test_trees_become_rows(spark):
    flat = files.flatten_trees(spark.createDataFrame([("t", json.dumps(ROOT)), ("u", "[1]"), ("v", "{"), ("w", None)], "tree_id string, json string"))
    assert {(r.tree_id, r.path, r.fault) for r in flat.filter("fault is not null").collect()} == {("t", "root.sub_tasks[1]", "node is no object"), ("u", "root", "root is no object"), ("v", "root", "tree is no JSON"), ("w", "root", "tree is no JSON")}
    got = {r.node_id: r for r in files.sound_nodes(flat).collect()}
    assert files.normal_tree(flat).count() == 3
    assert set(got) == {"root", "a", "b"} and got["a"].weight is None and got["a"].extra == "note" and got["b"].ord == 2 and got["b"].depth == 1
    assert got["b"].missing == "finegrained_task_category,requirements,sub_tasks,task_category,weight" and got["root"].parent_id is None


def test_lines_and_lists(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"a":1,"b":2}\n\n{"a":1}\n[1]\nnot json\n')
    got = [r.error for r in files.json_lines(spark, f"file://{tmp_path}/m.jsonl", ("a", "b")).collect()]
    assert got == [None, "other keys", "no object", "no object"]
    for name, value in (("one.json", [{"id": "x"}, {"id": "y"}]), ("two.json", {"collection_id": "c", "papers": [{"id": "x"}, {"id": "y"}]})):
        (tmp_path / name).write_text(json.dumps(value))
        header, rows = files.paper_list(spark, f"file://{tmp_path}/{name}")
        assert [r.id for r in rows.orderBy("ord").select(F.variant_get("paper", "$.id", "string").alias("id")).collect()] == ["x", "y"]
        assert list(header.select(F.map_keys("header").alias("k")).first().k) == ([] if name == "one.json" else ["collection_id"])


def test_file_trees_and_bytes(spark, tmp_path):
    (tmp_path / "d" / "e").mkdir(parents=True)
    (tmp_path / "d" / "a.txt").write_bytes(b"ok \xff tail")
    (tmp_path / "d" / "e" / "p.pdf").write_bytes(b"%PDF-1.4" + b"x" * 9000 + b"%%EOF\n")
    (tmp_path / "d" / "e" / "no thing%.txt").write_bytes(b"")
    assert {r.path: (r.bytes, bytes(r.content)) for r in files.file_tree(spark, f"file://{tmp_path}/d").filter("bytes = 0").collect()} == {"e/no thing%.txt": (0, b"")}
    got = {r.path: r for r in files.file_tree(spark, f"file://{tmp_path}/d").filter("bytes > 0").select("path", "bytes", files.capped_text(F.col("content"), 4).alias("t"), files.is_pdf(F.col("content")).alias("pdf")).collect()}
    assert set(got) == {"a.txt", "e/p.pdf"} and got["a.txt"].t.startswith("ok �\n[truncated 5") and not got["a.txt"].pdf and got["e/p.pdf"].pdf


def test_first_filled(spark):
    got = spark.createDataFrame([(" ", "${X}", "c"), ("a", "b", None)], "p string, q string, r string").select(files.first_filled("p", "q", "r").alias("v")).collect()
    assert [r.v for r in got] == ["c", "a"]


def test_facts_of_tools(spark):
    from sylvan.operators import contracts

    got = spark.createDataFrame([("Title: x\nPages:   12\nEnd",), ("no Pages: 3",), (None,)], "t string").select(files.page_count(F.col("t")).alias("n")).collect()
    assert [r.n for r in got] == [12, None, None]
    assert contracts.code_only_of("code-dev") and not contracts.code_only_of("regular")
    try:
        contracts.code_only_of("other")
    except ValueError:
        return
    raise AssertionError("another mode was taken")
