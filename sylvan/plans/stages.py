"""Queries of intake, authoring, grading and statistics, over the test tables' rows as papers, attempts, answers and trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import authoring, grading, intake, models, tree
from ..sources.tables import table
from .trees import LEAVES, NATION_TREES, effective_sql, nation_trees, order_tree, tree_sql


def source_resolution(spark, sf):
    k = F.col("page_id")
    rows = table(spark, sf, "pages").select(
        k, F.when(k % 3 == 0, F.concat(F.lit(" local/"), k.cast("string"))).when(k % 3 == 1, " ").alias("local"), F.when(k % 5 != 0, F.col("url")).alias("url"), (k % 7 != 0).alias("local_exists"), (k % 4 == 0).alias("offline")
    )
    return intake.resolved(rows).select("page_id", "origin", "place", "problem")


def download_outcomes(spark, sf):
    """Six attempts for each page; each goes wrong in one way or another by page_id and attempt."""
    k, a = F.col("page_id"), F.col("attempt")
    bad = (k + a) % 5
    pdf = k % 2 == 0
    body = F.when(pdf, F.when((bad == 2), F.lit(b"%PDF-1.4 cut")).otherwise(F.lit(b"%PDF-1.4 whole %%EOF"))).otherwise(F.lit(b"some page"))
    rows = table(spark, sf, "pages").select(k, F.explode(F.sequence(F.lit(0), F.lit(5))).alias("attempt"))
    rows = rows.select(
        F.concat(F.lit("https://h.example/"), k.cast("string"), F.when(pdf, ".PDF").otherwise(".html")).alias("url"), "attempt", (bad == 0).alias("failed"),
        F.when(bad == 1, F.octet_length(body) + 1).when(bad == 3, F.octet_length(body)).alias("expected"), body.alias("content"),
    )
    return intake.downloads(rows)


def text_extraction(spark, sf):
    """Documents as the three extractions of a PDF: some tools are missing, some texts short."""
    k = F.col("doc_id")
    spaced = F.concat(F.lit(" \n"), "text", F.lit("\n\n"))
    rows = table(spark, sf, "documents").select(k, F.when(k % 3 == 0, spaced).alias("tool"), F.when(k % 3 == 1, spaced).when(k % 6 == 2, "short").alias("first"), F.when(k % 6 != 5, F.col("text")).alias("second"))
    found = intake.extracted(rows)
    return found.select("doc_id", "conversion", F.md5(intake.fenced(F.col("text"), F.concat(F.lit("doc-"), k.cast("string")))).alias("digest"), "problem")


def paper_metadata(spark, sf):
    """Events' properties as entries of a paper list: paths go, constants come."""
    entry = F.concat(F.lit('{"pdf_path": "x", "blacklist": [1], "title": "t", "agent_visible": true, "props": '), "props", F.lit("}"))
    rows = intake.metadata(table(spark, sf, "events").select(F.col("event_id").alias("paper_id"), F.parse_json(entry).alias("paper")))
    get = lambda name: F.to_json(F.element_at("metadata", name))
    return rows.select("paper_id", F.array_join(F.array_sort(F.map_keys("metadata")), ",").alias("keys"), get("agent_visible").alias("visible"), F.variant_get(F.element_at("metadata", "props"), "$.k", "bigint").alias("k"))


def metadata_fallback(spark, sf):
    docs = table(spark, sf, "documents")
    return intake.metadata_or_entry(docs.select(F.col("doc_id").alias("paper_id"), F.col("source").alias("entry")), table(spark, sf, "labels").filter("quality = 1").select(F.col("doc_id").alias("paper_id"), F.lit("stored").alias("metadata")).distinct())


def built_packages(spark, sf):
    docs = table(spark, sf, "documents")
    lines = F.filter(F.split("source", "[0-9]"), lambda x: x != "")
    rows = docs.select(F.col("doc_id").cast("string").alias("paper_id"), F.col("lang").alias("title"), F.col("text").alias("markdown"), F.lit(b"%PDF-1.4 %%EOF").alias("pdf"), F.when(F.col("doc_id") % 2 == 0, lines).alias("blacklist"))
    return intake.packages(rows).select("paper_id", "name", F.sha2("content", 256).alias("sha256"))


_HEX_PDF = "from_hex('255044462d312e3420252545 4f46')".replace(" ", "")


def call_retries(spark, sf):
    """Attempts of calls, six for each event: the status follows from both numbers."""
    k = F.col("event_id") + 3 * F.col("attempt")
    rows = table(spark, sf, "events").select("event_id", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("attempt"))
    status = F.when(k % 7 == 0, 200).when(k % 7 == 1, 429).when(k % 7 == 2, 500).when(k % 35 == 3, 404).when(k % 7 == 4, 503)
    return models.retried(rows.select(F.col("event_id").alias("call_id"), "attempt", status.alias("status"), F.concat(F.lit("a"), "attempt").alias("answer")))


def _authored(spark, sf):
    """Nations as papers; their customers are branches, the region tells the rest."""
    branches = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.array_sort(F.collect_list(F.format_string("%06d", "c_custkey"))).alias("branches"))
    n = table(spark, sf, "nation").join(branches, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return n.select(F.concat(F.lit("n"), "n_nationkey").alias("paper_id"), (F.col("n_nationkey") % 4).alias("chunks"), F.coalesce("branches", F.array().cast("array<string>")).alias("branches"), (F.col("n_regionkey") % 2 == 1).alias("asks_addendum"), (F.col("n_regionkey") % 3).alias("repairs"))


def authoring_calls(spark, sf):
    return authoring.call_plan(_authored(spark, sf))


def _answers(spark, sf):
    """Answers to nations' calls: matrix and review have a common one, every subtree an own one."""
    own = table(spark, sf, "customer").select(F.concat(F.lit("n"), "c_nationkey").alias("paper_id"), F.concat(F.lit("subtree-"), F.format_string("%06d", "c_custkey")).alias("call"), F.concat(F.lit('{"open": ["q'), "c_custkey", F.lit('"]}')).alias("answer"))
    common = spark.createDataFrame([(None, "matrix", '{"open": ["m", "n"]}'), (None, "review", "{}")], "paper_id string, call string, answer string")
    return authoring.answered(authoring.call_plan(_authored(spark, sf)), own.union(common)).filter("answer is not null")


def authoring_results(spark, sf):
    found = authoring.in_order(_answers(spark, sf))
    return found.select("paper_id", "stage", F.size("answers").cast("long").alias("n"), F.md5(F.array_join("answers", ";")).alias("digest"))


def open_findings(spark, sf):
    found = authoring.joined_lists(_answers(spark, sf), "open")
    return found.select("paper_id", F.size("open").cast("long").alias("n"), F.md5(F.array_join("open", ";")).alias("digest"))


def repair_rounds(spark, sf):
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("paper_id"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("round"))
    return authoring.repair_rounds(rows.withColumn("valid", (F.col("paper_id") + F.col("round")) % 4 == 0), 2)


def approval_records(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("paper_id"), F.lit("r").alias("reviewer"), F.col("o_orderdate").alias("approved_at"), F.col("o_orderpriority").alias("rubric"), F.col("o_orderstatus").alias("addendum"))
    return authoring.approvals(rows)


def judge_prompts(spark, sf):
    """Documents as leaves, with texts of their own as evidence."""
    d = table(spark, sf, "documents").filter("doc_id is not null")
    rows = d.select(
        F.col("doc_id").cast("string").alias("leaf_id"), F.lit("c").alias("context"), F.lit("r").alias("requirements"), F.col("source").alias("paper_id"), F.lit("t").alias("title"), (F.col("doc_id") % 2 == 0).alias("code_only"),
        *(F.col("text").alias(c) for c in ("judge_addendum", "raw_files", "raw_text", "executed_files", "executed_text", "run", "paper_md", "addendum", "blacklist")),
    )
    return grading.prompts(rows).select("leaf_id", F.length("prompt").cast("long").alias("chars"))


def run_excerpts(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", *(F.col("text").alias(c) for c in grading.RUN_PARTS))
    cut = grading.excerpts(rows, grading.RUN_PARTS)
    return cut.select("doc_id", *(F.md5(c).alias(c) for c in grading.RUN_PARTS))


def _grading(spark, sf):
    """A submission for each nation on the tree of its customers."""
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    own = lambda x: F.col(x).cast("string")
    root = n.select(own("n_nationkey").alias("tree_id"), F.lit("root").alias("node_id"), F.lit(None).cast("string").alias("parent_id"), F.lit(0).alias("depth"), F.lit(1).cast("long").alias("weight"), F.lit("all").alias("requirements"), F.lit(None).cast("string").alias("task_category"))
    category = F.element_at(F.array(*map(F.lit, tree.CATEGORIES)), (F.col("c_custkey") % 3 + 1).cast("int"))
    leaves = c.select(own("c_nationkey"), F.concat(F.lit("c"), "c_custkey"), F.lit("root"), F.lit(1), (1 + F.col("c_custkey") % 3).cast("long"), F.col("c_mktsegment"), category)
    k = F.col("n_nationkey")
    submissions = n.select(F.concat(F.lit("s"), k).alias("submission_id"), own("n_nationkey").alias("tree_id"), (k % 4 != 1).alias("valid"), (k % 5 != 1).alias("has_readme"), (k % 3 != 1).alias("has_script"), (k % 7 == 5).alias("failed"), (k % 2 == 0).alias("reproduction_ran"), (k % 4 == 0).alias("reproduction_success"))
    j, leaf = F.col("c_custkey") % 10, F.concat(F.lit("c"), "c_custkey")
    say = lambda name, value: F.concat(F.lit('{"leaf_id": "'), name, F.lit(f'", "score": {value}}}'))
    response = F.when(j == 0, say(leaf, "1")).when(j == 1, say(leaf, "0")).when(j == 2, say(leaf, "0.5")).when(j == 3, say(F.lit("x"), "1")).when(j == 4, F.lit("no JSON"))
    both = lambda *entries: F.concat(F.lit('{"leaves": ['), F.concat_ws(", ", *entries), F.lit("]}"))
    response = response.when(j == 6, both(say(F.lit("x"), "0"), say(leaf, "1"))).when(j == 7, both(say(F.lit("x"), "1"))).when(j == 8, F.concat(say(leaf, "1"), F.lit(" and "), say(leaf, "0"))).when(j == 9, both(say(leaf, "1"), say(leaf, "0")))
    answers = c.filter(F.col("c_custkey") % 12 != 11).select(F.concat(F.lit("s"), "c_nationkey").alias("submission_id"), leaf.alias("leaf_id"), response.alias("response"), F.when(j == 5, "late").alias("error"))
    return submissions, root.union(leaves), answers


def graded_leaves(spark, sf):
    return grading.graded(*_grading(spark, sf))[0].select("submission_id", "leaf_id", "score", "judge_available", "llm_parse_ok")


def graded_submissions(spark, sf):
    record = grading.graded(*_grading(spark, sf))[1]
    return record.select("submission_id", *(F.round(c, 6).alias(c) for c in _RECORD))


def graded_code_only(spark, sf):
    record = grading.graded(*_grading(spark, sf), code_only=True)[1]
    return record.select("submission_id", F.round("score", 6).alias("score"), "format", "leaf_count", F.round("rubric_weight_total", 6).alias("rubric_weight_total"))


def compact_leaves(spark, sf):
    nodes = order_tree(spark, sf).withColumn("weight", F.when(F.col("ord") % 5 == 1, -2.0).when(F.col("ord") % 5 == 2, None).otherwise(F.col("weight").cast("double")))
    return grading.compact_leaves(nodes, code_only=True).select("leaf_id", "requirements", "weight")


def ranked_weights(spark, sf):
    return tree.ranked_weights(order_tree(spark, sf), 4).select("place", "node_id", F.round("effective", 12).alias("effective"))


def fine_category_histogram(spark, sf):
    fine = F.element_at(F.array(*map(F.lit, tree.FINE_CATEGORIES[:6])), (F.col("ord") % 6 + 1).cast("int"))
    return tree.fine_histogram(order_tree(spark, sf).withColumn("fine_category", F.when(F.col("depth") == 4, fine)))


def scale_table(spark, sf):
    return tree.scale_table(nation_trees(spark, sf))


def flat_weight_sum(spark, sf):
    found = tree.flat_weight_sum(order_tree(spark, sf).withColumn("weight", F.when(F.col("ord") % 5 == 1, -2).otherwise(F.col("weight"))))
    return found.select("tree_id", "weight_total", F.array_join("categories", ",").alias("categories"))


QUERIES = (
    source_resolution, download_outcomes, text_extraction, paper_metadata, metadata_fallback, built_packages, call_retries, authoring_calls, authoring_results, open_findings, repair_rounds, approval_records,
    judge_prompts, run_excerpts, graded_leaves, graded_submissions, graded_code_only, compact_leaves, ranked_weights, fine_category_histogram, scale_table, flat_weight_sum,
)
_RECORD = ("score", "format", "submission_present", "judge_available", "llm_parse_ok", "leaf_count", "invalid_leaf_count", "rubric_weight_total", "reproduction_ran", "reproduction_success")
_CUT = "CASE WHEN length(text) > {n} THEN substr(text, 1, {n}) || chr(10) || '[truncated ' || (length(text) - {n}) || ' chars]' || chr(10) ELSE text END"
_GUIDES = {True: "Judge the committed source code alone; nothing was run.", False: "Judge code, runs, results and analysis, with the run's logs and what it made."}
_PART = lambda name, size: f"{len(name) + 4} + {size}"  # noqa: E731  the name, a colon and three line breaks
_CAPPED = lambda n: f"length({_CUT.format(n=n)})"
_LEAST = lambda n: f"least(length(text), {n})"
_PROMPT = " + ".join([
    str(len("Grade one leaf with 0 or 1 and answer in JSON.\n") + 2), f"CASE WHEN doc_id % 2 = 0 THEN {len(_GUIDES[True])} ELSE {len(_GUIDES[False])} END", _PART("PAPER", "length(source) + 2"), _PART("ADDENDUM", _CAPPED(8000)), _PART("BLACKLIST", _CAPPED(4000)),
    _PART("JUDGE ADDENDUM", _LEAST(8000)), _PART("LEAF", "length(CAST(doc_id AS VARCHAR))"), _PART("CONTEXT", "1"), _PART("CRITERION", "1"), _PART("PAPER TEXT", _CAPPED(24000)), _PART("RAW FILES", _LEAST(12000)), _PART("RAW TEXT", _LEAST(25000)),
    "CASE WHEN doc_id % 2 = 0 THEN 0 ELSE " + " + ".join([_PART("EXECUTED FILES", _LEAST(16000)), _PART("EXECUTED TEXT", _LEAST(45000)), _PART("RUN", _LEAST(16000))]) + " END",
])
_ATTEMPTS = """a AS (
  SELECT page_id, attempt, (page_id + attempt) % 5 AS bad, 'https://h.example/' || page_id || CASE WHEN page_id % 2 = 0 THEN '.PDF' ELSE '.html' END AS url FROM pages, (SELECT unnest(range(4)) AS attempt)
), p AS (SELECT *, CASE WHEN bad = 0 THEN 'no answer' WHEN bad = 1 THEN 'answer is cut off' WHEN bad = 2 AND page_id % 2 = 0 THEN 'no whole PDF' END AS problem FROM a),
g AS (SELECT url, min(attempt) FILTER (problem IS NULL) AS good FROM p GROUP BY 1), c AS (SELECT p.* FROM p JOIN g USING (url) WHERE good IS NULL OR attempt <= good)"""
_CALLS = """n AS (SELECT n_nationkey AS k, 'n' || n_nationkey AS paper_id, n_regionkey AS r FROM nation),
calls AS (
  SELECT paper_id, 0 AS stage, CAST(i - 1 AS INTEGER) AS ord, 'elements-' || lpad(CAST(i AS VARCHAR), 3, '0') AS call FROM n, (SELECT unnest(range(1, 4)) AS i) WHERE i <= k % 4
  UNION ALL SELECT paper_id, s, 0, c FROM n, (VALUES (1, 'matrix'), (2, 'addendum'), (3, 'tree-plan'), (5, 'weighting'), (6, 'review')) AS t(s, c)
  UNION ALL SELECT 'n' || c_nationkey, 4, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS INTEGER), 'subtree-' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') FROM customer
  UNION ALL SELECT paper_id, 7, 0, 'judge-addendum' FROM n WHERE r % 2 = 1
  UNION ALL SELECT paper_id, 8, CAST(i - 1 AS INTEGER), 'repair-' || lpad(CAST(i AS VARCHAR), 2, '0') FROM n, (SELECT unnest(range(1, 3)) AS i) WHERE i <= r % 3
)"""
_ANSWERED = _CALLS + """, got AS (
  SELECT *, CASE WHEN call = 'matrix' THEN '{"open": ["m", "n"]}' WHEN call = 'review' THEN '{}' ELSE '{"open": ["q' || CAST(substr(call, 9) AS BIGINT) || '"]}' END AS answer,
    CASE WHEN call = 'matrix' THEN ['m', 'n'] WHEN call = 'review' THEN [] ELSE ['q' || CAST(substr(call, 9) AS BIGINT)] END AS found FROM calls WHERE call IN ('matrix', 'review') OR stage = 4
)"""
_GRADED = """l AS (
  SELECT 's' || c_nationkey AS submission_id, c_nationkey AS k, 'c' || c_custkey AS leaf_id, c_custkey % 10 AS j, c_custkey % 12 <> 11 AS there, CAST(1 + c_custkey % 3 AS DOUBLE) AS w, c_custkey % 3 = 0 AS code FROM customer
), q AS (SELECT *, CASE WHEN j IN (0, 6, 9) AND there THEN 1.0 ELSE 0.0 END AS score, there AND j IN (0, 1, 2, 6, 7, 9) AS ok, there AND j IN (0, 1, 6) AS parsed FROM l)"""
SQL = {
    "source_resolution": """WITH p AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'local/' || page_id END AS l, CASE WHEN page_id % 5 <> 0 THEN trim(url) END AS u FROM pages),
      r AS (SELECT *, CASE WHEN l IS NOT NULL THEN CASE WHEN page_id % 7 = 0 THEN 'local source is missing' END WHEN u IS NULL THEN 'no source' WHEN page_id % 4 = 0 THEN 'offline forbids a download' END AS problem FROM p)
      SELECT page_id, CASE WHEN problem IS NULL THEN CASE WHEN l IS NOT NULL THEN 'local' ELSE 'download' END END AS origin, CASE WHEN problem IS NULL THEN coalesce(l, u) END AS place, problem FROM r""",
    "download_outcomes": f"""WITH {_ATTEMPTS} SELECT url, count(*) AS attempts, CAST(coalesce(sum(CAST(power(2, attempt) AS BIGINT)) FILTER (problem IS NOT NULL), 0) AS BIGINT) AS waited,
      CAST(arg_max(CASE WHEN problem IS NOT NULL THEN -1 WHEN page_id % 2 = 1 THEN 9 WHEN bad = 2 THEN 12 ELSE 20 END, attempt) AS BIGINT) AS b, arg_max(coalesce(problem, ''), attempt) AS q FROM c GROUP BY url""",
    "text_extraction": r"""WITH t AS (SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS s, doc_id % 3 AS r, doc_id % 6 AS x FROM documents),
      e AS (SELECT *, CASE WHEN r = 0 THEN 'tool' WHEN r = 1 AND length(s) >= 1000 THEN 'first' WHEN x <> 5 THEN 'second' ELSE 'first' END AS c, CASE WHEN x = 5 THEN NULL ELSE s END AS own FROM t)
      SELECT doc_id, CASE WHEN length(own) >= 1000 THEN c END AS conversion,
        CASE WHEN length(own) >= 1000 THEN md5('<!-- Text of the paper''s PDF; authoritative source: doc-' || doc_id || ' -->' || chr(10) || chr(10) || '```text' || chr(10) || own || chr(10) || '```' || chr(10)) END AS digest,
        CASE WHEN own IS NULL THEN 'no extractor' WHEN length(own) < 1000 THEN 'text is implausibly short' END AS problem FROM e""",
    "paper_metadata": "SELECT event_id AS paper_id, 'agent_visible,authoring_status,props,purpose,title' AS keys, 'false' AS visible, CAST(props::JSON->>'$.k' AS BIGINT) AS k FROM events",
    "metadata_fallback": """SELECT doc_id AS paper_id, CASE WHEN q.doc_id IS NOT NULL THEN 'stored' ELSE source END AS metadata, q.doc_id IS NULL AS fell_back
      FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE quality = 1) q USING (doc_id)""",
    "built_packages": f"""WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS paper_id, text, lang, CASE WHEN doc_id % 2 = 0 THEN list_filter(string_split_regex(source, '[0-9]'), lambda x: x <> '') ELSE [] END AS l, sha256({_HEX_PDF}) AS pdf FROM documents),
      ok AS (SELECT * FROM d WHERE length(text) >= 1000)
      SELECT paper_id, 'blacklist.txt' AS name, sha256(CASE WHEN len(l) > 0 THEN array_to_string(l, chr(10)) || chr(10) ELSE '' END) AS sha256 FROM ok
      UNION ALL SELECT paper_id, 'config.yaml', sha256('id: "' || paper_id || '"' || chr(10) || 'title: "' || lang || '"' || chr(10)) FROM ok UNION ALL SELECT paper_id, 'paper.md', sha256(text) FROM ok UNION ALL SELECT paper_id, 'paper.pdf', pdf FROM ok
      UNION ALL SELECT paper_id, 'source_provenance.json', sha256('{{"blacklist_lines":' || len(l) || ',"paper_id":"' || paper_id || '","paper_md_sha256":"' || sha256(text) || '","paper_pdf_sha256":"' || pdf || '"}}' || chr(10)) FROM ok
      UNION ALL SELECT paper_id, 'problem.txt', sha256('text is implausibly short') FROM d WHERE length(text) < 1000""",
    "call_retries": """WITH a AS (SELECT event_id AS call_id, attempt, event_id + 3 * attempt AS k FROM events, (SELECT unnest(range(4)) AS attempt)),
      s AS (SELECT *, k % 7 = 0 AS good, k % 35 = 3 AS final FROM a), f AS (SELECT call_id, min(attempt) FILTER (good OR final) AS first FROM s GROUP BY 1),
      m AS (SELECT s.* FROM s JOIN f USING (call_id) WHERE first IS NULL OR attempt <= first)
      SELECT call_id, count(*) AS attempts, CAST(sum(CAST(power(2, attempt) AS BIGINT)) - max(CAST(power(2, attempt) AS BIGINT)) AS BIGINT) AS waited, max(CASE WHEN good THEN 'a' || attempt END) AS answer,
        CASE WHEN bool_or(good) THEN NULL WHEN bool_or(final) THEN 'refused' ELSE 'no answer' END AS problem FROM m GROUP BY call_id""",
    "authoring_calls": f"WITH {_CALLS} SELECT * FROM calls",
    "authoring_results": f"WITH {_ANSWERED} SELECT paper_id, stage, count(*) AS n, md5(string_agg(answer, ';' ORDER BY ord)) AS digest FROM got GROUP BY ALL",
    "open_findings": f"WITH {_ANSWERED}, u AS (SELECT paper_id, flatten(list(found ORDER BY stage, ord)) AS f FROM got GROUP BY 1) SELECT paper_id, len(f) AS n, md5(array_to_string(f, ';')) AS digest FROM u",
    "repair_rounds": "SELECT p_partkey AS paper_id, CAST(least(2, (4 - p_partkey % 4) % 4) AS BIGINT) AS rounds, (4 - p_partkey % 4) % 4 <= 2 AS valid FROM part",
    "approval_records": """SELECT o_orderkey AS paper_id, '{"addendum_sha256":"' || sha256(o_orderstatus) || '","approved_at":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') || '","paper_id":' || o_orderkey || ',"reviewer":"r","rubric_sha256":"' || sha256(o_orderpriority) || '"}' AS record FROM orders""",
    "judge_prompts": f"SELECT CAST(doc_id AS VARCHAR) AS leaf_id, CAST({_PROMPT} AS BIGINT) AS chars FROM documents WHERE doc_id IS NOT NULL",
    "run_excerpts": f"SELECT doc_id, {', '.join(f'md5({_CUT.format(n=n)}) AS {c}' for c, n in grading.RUN_PARTS.items())} FROM documents",
    "graded_leaves": f"WITH {_GRADED} SELECT submission_id, leaf_id, CAST(score AS DOUBLE) AS score, ok AS judge_available, parsed AS llm_parse_ok FROM q WHERE k % 4 <> 1 AND k % 7 <> 5",
    "graded_submissions": f"""WITH {_GRADED}, s AS (SELECT n_nationkey AS k, n_nationkey % 4 <> 1 AS valid, n_nationkey % 7 = 5 AS failed FROM nation),
      g AS (SELECT k, count(*) AS leaves, sum(w) AS total, sum(w * score) AS good, count(*) FILTER (ok) AS answered, count(*) FILTER (parsed) AS parsed FROM q GROUP BY 1), x AS (SELECT s.*, g.* EXCLUDE (k) FROM s LEFT JOIN g USING (k))
      SELECT 's' || k AS submission_id, round(CAST(CASE WHEN valid AND NOT failed THEN coalesce(good / total, 0) ELSE 0 END AS DOUBLE), 6) AS score, CAST(CASE WHEN NOT valid THEN 0 WHEN k % 5 <> 1 AND k % 3 <> 1 THEN 1 ELSE 0.25 END AS DOUBLE) AS format,
        CAST(valid AS DOUBLE) AS submission_present, round(CAST(CASE WHEN valid AND NOT failed AND leaves > 0 THEN answered / leaves ELSE 0 END AS DOUBLE), 6) AS judge_available,
        round(CAST(CASE WHEN valid AND NOT failed AND leaves > 0 THEN parsed / leaves ELSE 0 END AS DOUBLE), 6) AS llm_parse_ok, CAST(coalesce(leaves, 0) AS DOUBLE) AS leaf_count,
        CAST(CASE WHEN valid AND NOT failed THEN coalesce(leaves - parsed, 0) ELSE coalesce(leaves, 0) END AS DOUBLE) AS invalid_leaf_count, CAST(coalesce(total, 0) AS DOUBLE) AS rubric_weight_total,
        CAST(valid AND k % 2 = 0 AS DOUBLE) AS reproduction_ran, CAST(valid AND k % 4 = 0 AS DOUBLE) AS reproduction_success FROM x""",
    "graded_code_only": f"""WITH {_GRADED}, g AS (SELECT k, count(*) AS leaves, sum(w) AS total, sum(w * score) AS good FROM q WHERE code GROUP BY 1), x AS (SELECT n_nationkey AS k, g.* EXCLUDE (k) FROM nation LEFT JOIN g ON g.k = n_nationkey)
      SELECT 's' || k AS submission_id, round(CAST(CASE WHEN k % 4 <> 1 AND k % 7 <> 5 THEN coalesce(good / total, 0) ELSE 0 END AS DOUBLE), 6) AS score, CAST(CASE WHEN k % 4 = 1 THEN 0 WHEN k % 5 <> 1 THEN 1 ELSE 0.25 END AS DOUBLE) AS format,
        CAST(coalesce(leaves, 1) AS DOUBLE) AS leaf_count, CAST(coalesce(total, 1) AS DOUBLE) AS rubric_weight_total FROM x""",
    "compact_leaves": f"""WITH {tree_sql()} SELECT node_id AS leaf_id, requirements, CAST(CASE WHEN ord % 5 IN (1, 2) THEN 0 ELSE weight END AS DOUBLE) AS weight FROM tree WHERE depth = 4 AND task_category = 'Code Development'""",
    "ranked_weights": f"""WITH {tree_sql()}, {effective_sql(4)}, {LEAVES.format(t='eff')}, r AS (SELECT CAST(row_number() OVER (ORDER BY round(effective, 12) DESC, node_id) AS INTEGER) AS place, node_id, round(effective, 12) AS effective FROM leaves) SELECT * FROM r""",
    "fine_category_histogram": f"""WITH f AS (SELECT unnest(range(7)) AS i, unnest([{', '.join(f"'{c}'" for c in tree.FINE_CATEGORIES)}]) AS fine_category), c AS (SELECT o_orderkey % 6 AS i, count(*) AS n FROM orders GROUP BY 1)
      SELECT fine_category, coalesce(n, 0) AS n, round(100.0 * coalesce(n, 0) / (SELECT count(*) FROM orders), 6) AS percent FROM f LEFT JOIN c USING (i)""",
    "scale_table": f"WITH {NATION_TREES} SELECT tree_id, nodes, nodes - leaves AS inner, leaves, branches, max_depth, round(CASE WHEN nodes > leaves THEN (nodes - 1) / (nodes - leaves) END, 6) AS children, single_child FROM stats",
    "flat_weight_sum": f"""WITH {tree_sql()}, {LEAVES.format(t='tree')} SELECT tree_id, CAST(sum(CASE WHEN ord % 5 = 1 THEN 0 ELSE weight END) AS DOUBLE) AS weight_total,
      array_to_string(list_sort(list(DISTINCT task_category)), ',') AS categories FROM leaves GROUP BY 1""",
}
SQL["download_outcomes"] = f"SELECT url, attempts, waited, nullif(b, -1) AS bytes, nullif(q, '') AS problem FROM ({SQL['download_outcomes']})"
