import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sylvan.functions import text
from sylvan.operators import evidence, packaging

LONG = "word " * 300


def chunks_of(spark, texts, size):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.c for r in frame.select("i", text.heading_chunks(F.col("t"), size).alias("c")).orderBy("i").collect()]


@settings(max_examples=5, deadline=None)
@given(texts=st.lists(st.text(alphabet="ab #\n😀", max_size=80), min_size=1, max_size=20))
def test_chunks_join_to_the_text_and_are_short(spark, texts):
    for t, c in zip(texts, chunks_of(spark, texts, 12), strict=True):
        assert "".join(c) == t and all(len(x) <= 12 for x in c)


def test_sections_are_packed_in_order(spark):
    assert chunks_of(spark, ["x\n# a\nb\n## c\nd", "abcdefghijklmnop"], 10) == [["x\n# a\nb\n", "## c\nd"], ["abcdefghij", "klmnop"]]


def test_markdown_of_an_article():
    html = f"<nav>no</nav><article><h2>Title</h2><script>x()</script><p>one&amp;two<br>three</p><ul><li>item</li></ul><math alttext='x^2'></math><img alt='pic'>{LONG}</article><p>outside</p>"
    got = text.markdown(html)
    assert got.startswith("## Title\n\none&two\nthree\n\n- item\n\n$x^2 [pic] word") and "outside" not in got and "x()" not in got


def test_short_article_falls_back_to_the_document():
    assert text.markdown(f"<article>tiny</article><p>{LONG}</p>").startswith("tiny")
    assert text.markdown(None) == ""


def test_truncation_counts_what_is_missing(spark):
    rows = spark.createDataFrame([("abc",), ("abcdef",), (None,)], "t string").select(text.truncated(F.col("t"), 4).alias("x")).collect()
    assert [r.x for r in rows] == ["abc", "abcd\n[truncated 2 chars]\n", ""]


def test_json_objects_only(spark):
    rows = [('{"a":1}',), ("[1]",), ("```\n{\"a\":2}\n```",), ("so {\"a\":3} it is",), ("none",), (None,)]
    got = spark.createDataFrame(rows, "t string").select(F.try_variant_get(text.json_object(F.col("t")), "$.a", "int").alias("a")).collect()
    assert [r.a for r in got] == [1, None, 2, 3, None, None]
    rows = [("```json\n{broken}\n``` {\"a\":4}",), (" ```JSON\n{\"a\":5}\n``` ",), ("[1] {\"a\":6}",), ("[{\"a\":7}]",)]
    frame = spark.createDataFrame(rows, "t string")
    own = [[F.try_variant_get(f(F.col("t")), "$.a", "int").alias(n)] for n, f in (("judge", text.json_object), ("author", text.authored_object))]
    got = frame.select(*own[0], *own[1]).collect()
    assert [tuple(r) for r in got] == [(None, None), (5, 5), (6, 6), (7, None)]
    assert [r.t for r in spark.createDataFrame([("ﬁ²",), (None,)], "t string").select(text.nfkc("t").alias("t")).collect()] == ["fi2", None]


def test_evidence_order_and_limit(spark):
    names = [f"artifact-{i:03}.bin" for i in range(220)] + [".git/config", "README.md", "reproduce.sh", "src/method.py", "notebook.ipynb"]
    files = spark.createDataFrame([("s", n, 1, "x") for n in names], "submission_id string, path string, bytes long, text string")
    got = [r.path for r in evidence.ranked(files).orderBy("place").collect()]
    assert got[:4] == ["README.md", "reproduce.sh", "notebook.ipynb", "src/method.py"] and len(got) == 200 and ".git/config" not in got


def test_evidence_budget_may_be_exceeded_by_one_snippet(spark):
    files = spark.createDataFrame([("s", f"f{i}.md", 10, "x" * 10) for i in range(5)], "submission_id string, path string, bytes long, text string")
    got = [r.snippet for r in evidence.snippets(files, evidence.Budget(total=15)).orderBy("place").collect()]
    assert [bool(s) for s in got] == [True, True, False, False, False]


def test_publish_is_all_or_nothing(spark, tmp_path):
    rows = spark.range(5).selectExpr("id")
    target = f"file://{tmp_path}/out"
    assert packaging.publish(spark, rows, target, lambda d: d.filter("id > 9")).count() == 5
    with pytest.raises(FileExistsError):
        packaging.publish(spark, rows, target, lambda d: d.filter("id > 9"))
    with pytest.raises(ValueError):
        packaging.publish(spark, spark.range(20).selectExpr("id"), target, lambda d: d.filter("id > 9"), overwrite=True)
    assert spark.read.parquet(target).count() == 5


def test_safe_name(spark):
    got = spark.range(1).select(packaging.safe_name(F.lit("--a b/c..d--")).alias("n")).first().n
    assert got == re.sub(r"[^a-zA-Z0-9._-]+", "-", "--a b/c..d--").strip("-")


def test_strict_json_is_the_whole_text(spark):
    import json

    from sylvan.functions.text import strict_json

    good = ['{"a": 1}', ' {"a": "}{]["} \n', '[1, {"b": "\\"}"}]', '{"a": {"b": [1, [2]]}}', '"x y"', "12.5", "true", "null", '{"k": "\\\\"}', "[]", "{}", '{"s": NaN, "t": [-Infinity, 1]}']
    bad = ['{"a":1} and {"b":2}', '{"a":1} junk', '{"a":1}{"b":2}', '{"a":1}"', '{"a":1}"}', "[1] [2]", "1 2", '{"a":1}]', "{", "", "x", '{"task_id":"x"}, 1', '{"a":1}\\"']
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "i int, t string").select("i", "t", F.to_json(strict_json(F.col("t"))).alias("v"), strict_json(F.col("t")).isNull().alias("none"))
    for r in rows.collect():
        if r.i < len(good):
            want = json.loads(r.t.replace("NaN", "null").replace("-Infinity", "null"))
            assert not r.none and json.loads(r.v) == want, r.t
        else:
            assert r.none, r.t
            with pytest.raises(ValueError):
                json.loads(r.t)


def test_toml_is_whole_json(spark):
    from sylvan.functions.text import toml_as_json

    texts = ["a = 1", 'a = nan\n[b]\nc = [inf, 1.5, "NaN"]', "a = 2020-01-02", "a = ", None, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", toml_as_json("t").alias("j")).select("i", F.to_json(F.try_parse_json("j")).alias("v"))
    assert [r.v for r in rows.orderBy("i").collect()] == ['{"a":1}', '{"a":null,"b":{"c":[null,1.5,"NaN"]}}', '{"a":"2020-01-02"}', None, None, "{}"]
