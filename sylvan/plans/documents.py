"""Queries over documents, pages, events and labels: text, evidence, profiles, packaging."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators import evidence, models, packaging, profile, rules, score
from ..sources.tables import scratch, table


def _files(spark, sf):
    """Documents as the files of a submission for each language; the name's suffix follows from doc_id."""
    suffix = F.element_at(F.array(*map(F.lit, ("py", "md", "json", "bin", "csv", "ipynb", "png", "gz"))), (F.col("doc_id") % 8 + 1).cast("int"))
    name = F.when(F.col("doc_id") % 50 == 7, F.lit("README.md")).when(F.col("doc_id") % 50 == 9, F.lit("results.json")).when(F.col("doc_id") % 31 == 3, F.concat(F.lit(".git/f"), "doc_id")).otherwise(F.concat(F.lit("file-"), "doc_id", F.lit("."), suffix))
    top = F.element_at(F.array(*map(F.lit, ("environment", "tests", "solution", "notes"))), (F.col("doc_id") % 4 + 1).cast("int"))
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return docs.select(F.col("lang").alias("submission_id"), F.concat_ws("/", top, "source", F.concat(F.lit("d"), "doc_id"), name).alias("path"), F.octet_length("text").cast("long").alias("bytes"), "text")


FILES = """files AS (
  SELECT lang AS submission_id, (['environment', 'tests', 'solution', 'notes'])[doc_id % 4 + 1] || '/' || source || '/d' || doc_id || '/' ||
    CASE WHEN doc_id % 50 = 7 THEN 'README.md' WHEN doc_id % 50 = 9 THEN 'results.json' WHEN doc_id % 31 = 3 THEN '.git/f' || doc_id
      ELSE 'file-' || doc_id || '.' || (['py', 'md', 'json', 'bin', 'csv', 'ipynb', 'png', 'gz'])[doc_id % 8 + 1] END AS path,
    CAST(strlen(text) AS BIGINT) AS bytes, text FROM documents
), named AS (SELECT *, lower(string_split(path, '/')[-1]) AS name, CASE WHEN string_split(path, '/')[-1] LIKE '.git%' OR path LIKE '%.git/%' THEN '' ELSE lower(string_split(path, '.')[-1]) END AS suffix FROM files),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY submission_id ORDER BY priority, len(string_split(path, '/')), lower(path), path) AS place FROM (
    SELECT *, CASE WHEN name IN ('readme.md', 'reproduce.sh') THEN 0 WHEN name IN ('requirements.txt', 'pyproject.toml', 'environment.yml', 'environment.yaml', 'results.json', 'metrics.json', 'results.csv', 'metrics.csv') THEN 1
      WHEN regexp_matches(lower(path), 'result|metric|score|summary|evaluation|report') THEN 2 WHEN suffix IN ('py', 'sh', 'ipynb', 'toml', 'yaml', 'yml') THEN 3
      WHEN suffix IN ('py', 'sh', 'md', 'txt', 'json', 'yaml', 'yml', 'toml', 'csv', 'tsv', 'rst', 'log', 'out', 'err', 'html', 'tex') THEN 4 ELSE 5 END AS priority
    FROM named WHERE path NOT LIKE '%/.git/%')
  QUALIFY place <= 200
), cut AS (
  SELECT *, CASE WHEN bytes <= 2000000 AND suffix IN ('py', 'sh', 'md', 'txt', 'json', 'yaml', 'yml', 'toml', 'csv', 'tsv', 'rst', 'log', 'out', 'err', 'html', 'tex') THEN substr(text, 1, 3500) END AS c FROM ranked
), used AS (
  SELECT *, coalesce(sum(coalesce(length(c), 0)) OVER (PARTITION BY submission_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM cut
), snip AS (SELECT *, CASE WHEN used < 60000 THEN c END AS snippet FROM used)"""
_SUFFIX_KIND = "CASE WHEN suffix = 'json' THEN 'json' WHEN suffix IN ('png') THEN 'image' WHEN suffix IN ('md', 'csv') THEN 'text' WHEN suffix = 'py' THEN 'code' WHEN suffix = 'gz' THEN 'archive' ELSE 'binary' END"


def evidence_ranking(spark, sf):
    return evidence.ranked(_files(spark, sf)).select("submission_id", "path", F.col("priority").cast("int").alias("priority"), F.col("place").cast("long").alias("place"))


def evidence_budget(spark, sf):
    return evidence.snippets(_files(spark, sf)).select("submission_id", "place", "used", F.length("snippet").cast("long").alias("snippet_chars")).withColumn("place", F.col("place").cast("long"))


def evidence_text(spark, sf):
    return evidence.evidence_text(_files(spark, sf)).select("submission_id", "files", F.length("text").cast("long").alias("chars"), F.md5("text").alias("digest"))


def truncate_with_marker(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.truncated(F.col("text"), 1000).alias("text"))


def chunk_fixed(spark, sf):
    chunks = table(spark, sf, "documents").select("doc_id", F.posexplode(text.fixed_windows(F.col("text"), 900)).alias("i", "chunk"))
    return chunks.select("doc_id", F.col("i").cast("long").alias("chunk_no"), F.length("chunk").cast("long").alias("chars"), F.md5("chunk").alias("digest"))


def chunk_by_heading(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", text.html_to_markdown("html").alias("md"))
    chunks = pages.select("page_id", F.posexplode(text.heading_chunks(F.col("md"), 900)).alias("i", "chunk"))
    return chunks.select("page_id", F.col("i").cast("long").alias("chunk_no"), F.length("chunk").cast("long").alias("chars"), F.md5("chunk").alias("digest"))


def html_to_markdown(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.html_to_markdown("html").alias("markdown"))


def whitespace_normalise(spark, sf):
    spaced = F.regexp_replace("text", r"([.,])", "$1 \n \t ")
    return table(spark, sf, "documents").select("doc_id", text.tidy(spaced).alias("text"))


def json_extract(spark, sf):
    forms = F.when(F.col("event_id") % 4 == 0, F.col("props")).when(F.col("event_id") % 4 == 1, F.concat(F.lit("Sure:\n```json\n"), "props", F.lit("\n```"))).when(F.col("event_id") % 4 == 2, F.concat(F.lit("the answer is "), "props", F.lit("."))).otherwise(F.lit("none"))
    found = table(spark, sf, "events").select("event_id", text.json_object(forms).alias("v"))
    return found.select("event_id", F.try_variant_get("v", "$.k", "bigint").alias("k"))


def url_rewrite(spark, sf):
    number = F.format_string("24%02d.%05d", F.col("page_id") % 12 + 1, F.col("page_id"))
    kind = F.col("page_id") % 5
    url = F.when(kind == 0, F.concat(F.lit("https://arxiv.org/abs/"), number)).when(kind == 1, F.concat(F.lit("https://www.arxiv.org/pdf/"), number, F.lit(".pdf"))).when(kind == 2, F.lit(" ")).otherwise(F.col("url"))
    explicit = F.when(F.col("page_id") % 11 == 0, F.col("url"))
    return table(spark, sf, "pages").select("page_id", text.rendering_url(explicit, url, base="https://render.example.org/html/").alias("html_url"))


def file_kind_profile(spark, sf):
    files = _files(spark, sf).select(F.col("submission_id").alias("set_id"), "path", "bytes")
    cells = lambda part: F.transform(F.map_entries(f"{part}_counts"), lambda e: F.struct(F.concat(F.lit(f"{part}:"), e["key"]).alias("name"), e["value"].alias("files"), F.element_at(f"{part}_bytes", e["key"]).alias("bytes")))
    return profile.data_profile(files).select("set_id", F.explode(F.concat(cells("kind"), cells("scope"))).alias("c")).select("set_id", "c.*")


def largest_files(spark, sf):
    return profile.largest(_files(spark, sf)).select("path", "bytes")


def content_digest(spark, sf):
    files = table(spark, sf, "documents").select("doc_id", F.col("text").cast("binary").alias("content"))
    return profile.digests(files).select("doc_id", "sha256")


def fingerprint(spark, sf):
    files = table(spark, sf, "pages").select((F.col("page_id") % 10).alias("set_id"), F.format_string("%06d", "page_id").alias("label"), F.md5("html").alias("content"))
    return profile.fingerprint(files)


def duplicate_ids(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).filter("n > 1")


def compound_requirement_warning(spark, sf):
    return table(spark, sf, "documents").filter(rules.compound(F.col("text"))).select("doc_id")


def unquantified_match_warning(spark, sf):
    words = F.concat("text", F.when(F.col("doc_id") % 3 == 0, F.lit(" it matches")).otherwise(""), F.when(F.col("doc_id") % 6 == 0, F.lit(" within 5")).otherwise(""))
    return table(spark, sf, "documents").filter(rules.unmeasured(words)).select("doc_id")


def addendum_checks(spark, sf):
    note = F.concat("text", F.when(F.col("doc_id") % 2 == 0, F.lit("\nScope\nclarifications")).otherwise(""), F.when(F.col("doc_id") % 7 == 0, F.lit(" TODO")).otherwise(""))
    return rules.violations(table(spark, sf, "documents").withColumn("note", note), rules.addendum_rules(F.col("note")), ["doc_id"])


def _responses(spark, sf):
    """Four leaves' answers for each user, in five shapes, some with scores that aren't valid."""
    e = table(spark, sf, "events").select("event_id", "user_id")
    leaf = F.concat(F.lit("leaf-"), F.col("user_id").cast("string"))
    score_text = F.element_at(F.array(*map(F.lit, ("1", "0", "0.5", "true", "1.0", "\"1\""))), (F.col("event_id") % 6 + 1).cast("int"))
    one = F.concat(F.lit('{"leaf_id":"'), F.when(F.col("event_id") % 7 == 0, F.lit("other")).otherwise(leaf), F.lit('","score":'), score_text, F.lit("}"))
    shape = F.col("event_id") % 4
    full = F.when(shape == 0, F.concat(F.lit('{"leaves":['), one, F.lit("]}"))).when(shape == 1, F.concat(F.lit("Here:\n```json\n"), one, F.lit("\n```"))).when(shape == 2, F.concat(F.lit('{"items":['), one, F.lit("]}"))).otherwise(
        F.concat(F.lit('{"'), leaf, F.lit('":{"score":'), score_text, F.lit("}}"))
    )
    return e.select(leaf.alias("leaf_id"), F.col("event_id").alias("ord"), full.alias("response"))


RESPONSES = """r AS (
  SELECT 'leaf-' || user_id AS leaf_id, event_id AS ord, CASE WHEN event_id % 7 = 0 AND event_id % 4 <> 3 THEN 'other' ELSE 'leaf-' || user_id END AS found_id,
    CASE event_id % 6 WHEN 0 THEN 1.0 WHEN 1 THEN 0.0 WHEN 2 THEN 0.5 WHEN 4 THEN 1.0 END AS score FROM events
), p AS (SELECT *, found_id = leaf_id AND row_number() OVER (PARTITION BY leaf_id, found_id ORDER BY ord) = 1 AS first, coalesce(score IN (0.0, 1.0), false) AS valid FROM r),
s AS (SELECT leaf_id, CAST(coalesce(max(score) FILTER (first AND valid), 0.0) AS DOUBLE) AS score, count(*) FILTER (NOT (first AND valid)) AS invalid, count(*) AS requests, count(*) FILTER (valid) AS parsed FROM p GROUP BY leaf_id)"""


def parse_leaf_scores(spark, sf):
    return score.leaf_scores(score.response_rows(_responses(spark, sf)))


def reward_record(spark, sf):
    rows = score.response_rows(_responses(spark, sf))
    scores = score.leaf_scores(rows).join(rows.groupBy("leaf_id").agg(F.count("*").alias("requests"), F.count_if(F.col("score").isin(0.0, 1.0)).alias("parsed")), "leaf_id")
    group = F.substring("leaf_id", -1, 1)
    per = scores.groupBy(group.alias("submission_id")).agg(F.avg("score").alias("score"), F.count("*").alias("leaves"), F.sum("requests").alias("requests"), F.sum("parsed").alias("parsed"))
    digit = F.col("submission_id").cast("int")
    full = per.withColumns({
        "valid": digit != 3, "has_readme": digit != 4, "has_script": F.lit(True), "answered": F.col("requests"), "weight_total": F.col("leaves") * 2, "reproduction_ran": F.lit(True), "reproduction_success": digit % 2 == 0,
    })
    out = score.reward_record(full)
    return out.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes))


def ordered_distinct(spark, sf):
    canon = table(spark, sf, "events").select("event_id", "props")
    return packaging.first_occurrences(canon, "props", "event_id").select("event_id", "props")


def blacklist_lines(spark, sf):
    lines = F.split("text", "\n")
    out = F.array_distinct(F.filter(F.transform(lines, lambda x: F.btrim(x, F.lit(" \t\r"))), lambda x: x != ""))
    return table(spark, sf, "documents").select("doc_id", F.size(out).cast("long").alias("n"), F.md5(F.array_join(out, "\n")).alias("digest"))


def task_ids(spark, sf):
    paper = F.concat(F.lit("paper-"), F.col("doc_id").cast("string"))
    return table(spark, sf, "documents").select("doc_id", packaging.task_id(F.lit("20240101-000000"), paper, "research-task").alias("task_id"))


#: Batch and label of the manifest's tasks.
_BATCH = ("20240101-000000", "research-task")


def manifest_rows(spark, sf):
    papers = table(spark, sf, "documents").select(F.concat(F.lit("paper-"), F.col("doc_id").cast("string")).alias("paper_id"), (F.col("doc_id") + 1).alias("source_index"))
    return packaging.as_json_lines(packaging.manifest(papers, *_BATCH, "tasks"))


def _papers(spark, sf):
    return table(spark, sf, "documents").select(F.col("doc_id").alias("paper_id"), F.col("doc_id").alias("ord"), "lang")


def _wanted(spark, sf):
    return table(spark, sf, "labels").select(F.when(F.col("doc_id") % 9 == 0, -F.col("doc_id") - 1).otherwise(F.col("doc_id")).alias("paper_id"))


def select_papers(spark, sf):
    return packaging.select_in_order(_papers(spark, sf), _wanted(spark, sf)).select("paper_id", "lang")


def unknown_ids(spark, sf):
    return packaging.unknown(_papers(spark, sf), _wanted(spark, sf))


def bundle_priority(spark, sf):
    published = table(spark, sf, "labels").select(F.col("doc_id").alias("paper_id"), F.lit("published").alias("state"), F.when(F.col("toxic") == 1, "code-dev").otherwise("regular").alias("mode"))
    drafts = table(spark, sf, "documents").select(F.col("doc_id").alias("paper_id"), F.lit("draft").alias("state"), F.when(F.col("doc_id") % 2 == 0, "code-dev").otherwise("regular").alias("mode"))
    return packaging.choose_bundle(published.union(drafts), ("regular",))


def set_equality_audit(spark, sf):
    left = table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    return packaging.set_audit(left, _wanted(spark, sf).withColumnRenamed("paper_id", "id"), "id")


def hash_approval_audit(spark, sf):
    docs = table(spark, sf, "documents")
    approved = docs.select("doc_id", F.sha2(F.when(F.col("doc_id") % 10 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")), 256).alias("sha256"))
    actual = docs.filter("doc_id % 13 <> 5").select("doc_id", F.sha2("text", 256).alias("sha256"))
    return packaging.digest_audit(approved, actual, "doc_id").select("doc_id", "approved", "actual")


def contract_text_rules(spark, sf):
    rows = spark.createDataFrame([("page", "<article", True), ("page", "page=2", False), ("page", "<nav>", True), ("page", "track(1)", False)], "file string, needle string, wanted boolean")
    pages = table(spark, sf, "pages").select(F.lit("page").alias("file"), "page_id", F.col("html").alias("text"))
    return rules.text_rules(pages, rows, ["page_id"])


def resource_classify(spark, sf):
    machine = F.when(F.col("p_size") % 4 == 0, F.lit("CPU only")).when(F.col("p_size") % 4 == 1, F.lit("cpu + A100")).when(F.col("p_size") % 4 == 2, F.col("p_type")).otherwise("")
    notes = F.when(F.col("p_size") % 8 == 3, "one H100")
    return table(spark, sf, "part").select("p_partkey", profile.resource_class(machine, notes).alias("resource_class"))


def model_switch_split(spark, sf):
    """The first three documents of each source by one model, all others by another. A rank below four is found where the rows are, so
    a source of any size sends three of a task."""
    docs = table(spark, sf, "documents").select("doc_id", "source")
    place = F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))
    last = docs.withColumn("place", place).filter("place <= 3").groupBy("source").agg(F.max("doc_id").alias("last"))
    return docs.join(last, "source").select("doc_id", "source", F.when(F.col("doc_id") <= F.col("last"), "first").otherwise("second").alias("model"))


def incremental_skip(spark, sf):
    done = table(spark, sf, "labels").select("doc_id", F.explode(F.when(F.col("quality") == 1, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a")))).alias("artefact"))
    return packaging.pending(table(spark, sf, "documents").select("doc_id"), done, "doc_id", 2)


def staged_publish(spark, sf):
    """Publish the manifest into a folder of its own and read it back."""
    target = f"{scratch(spark)}/manifest-{uuid.uuid4().hex[:12]}"
    rows = manifest_rows(spark, sf).select(F.get_json_object("value", "$.task_id").alias("task_id"), "value")
    return packaging.publish(spark, rows, target, lambda d: packaging.manifest_problems(d, *_BATCH), overwrite=True)


def mock_model_pipeline(spark, sf):
    """Canned answers joined to calls: the paper's own answer, or else the one for all papers."""
    talk = table(spark, sf, "conversations")
    answers = talk.filter("role <> 'user'").select("conv_id", (F.col("turn") - 1).alias("call"), F.col("text").alias("answer"))
    own = answers.filter("conv_id % 2 = 0").select(F.col("conv_id").alias("paper_id"), "call", "answer")
    common = answers.groupBy("call").agg(F.min("answer").alias("answer")).select(F.lit(None).cast("long").alias("paper_id"), "call", "answer")
    out = models.canned(talk.filter("role = 'user'").select(F.col("conv_id").alias("paper_id"), F.col("turn").alias("call")), own.unionByName(common))
    return out.select(F.col("paper_id").alias("conv_id"), F.col("call").alias("turn"), F.md5("answer").alias("answer"))


def author_json_extract(spark, sf):
    """Events' properties in the forms that an author's answer may have."""
    k = F.col("event_id") % 5
    forms = F.when(k == 0, F.concat(F.lit(" \n"), "props")).when(k == 1, F.concat(F.lit("```JSON\n"), "props", F.lit("\n```\n"))).when(k == 2, F.concat(F.lit("it is "), "props", F.lit(" so"))).when(k == 3, F.concat(F.lit("["), "props", F.lit("]"))).otherwise("none")
    found = table(spark, sf, "events").select("event_id", text.authored_object(forms).alias("v"))
    return found.select("event_id", F.try_variant_get("v", "$.k", "bigint").alias("k"))


QUERIES = (
    evidence_ranking, evidence_budget, evidence_text, truncate_with_marker, chunk_fixed, chunk_by_heading, html_to_markdown, whitespace_normalise, json_extract, url_rewrite, file_kind_profile,
    largest_files, content_digest, fingerprint, duplicate_ids, compound_requirement_warning, unquantified_match_warning, addendum_checks, parse_leaf_scores, reward_record, ordered_distinct,
    blacklist_lines, task_ids, manifest_rows, select_papers, unknown_ids, bundle_priority, set_equality_audit, hash_approval_audit, contract_text_rules, resource_classify, model_switch_split,
    incremental_skip, staged_publish, mock_model_pipeline, author_json_extract,
)
_WANTED = "wanted AS (SELECT DISTINCT CASE WHEN doc_id % 9 = 0 THEN -doc_id - 1 ELSE doc_id END AS paper_id FROM labels)"
_TASK = "'20240101-000000-research-task-' || substr(sha256('20240101-000000:paper-' || doc_id), 1, 6)"
_MANIFEST = f"""'{{"artifact_paths":["/submission"],"benchmark":"research-task","competition_id":"","metric":"weighted_tree_score","paper_id":"paper-' || doc_id || '","promoted_public_data_paths":[],"removed_paths":["environment/Dockerfile","tests/Dockerfile"],"source_format":"research-task_tree","source_seed_task_id":"","source_task_dir":"tasks/20240101-000000/research-task-' || printf('%04d', doc_id + 1) || '","source_task_key":"paper-' || doc_id || '","source_task_name":"research-task/research-task-' || printf('%04d', doc_id + 1) || '","task_id":"' || {_TASK} || '"}}'"""
SQL = {
    "evidence_ranking": f"WITH {FILES} SELECT submission_id, path, priority, place FROM ranked",
    "evidence_budget": f"WITH {FILES} SELECT submission_id, place, CAST(used AS BIGINT) AS used, length(snippet) AS snippet_chars FROM snip",
    "evidence_text": f"""WITH {FILES}, t AS (SELECT submission_id, count(*) AS files, substr(coalesce(string_agg('### ' || path || chr(10) || snippet, chr(10) || chr(10) ORDER BY place) FILTER (snippet IS NOT NULL AND regexp_matches(snippet, '\\S')), ''), 1, 60000) AS t FROM snip GROUP BY 1)
      SELECT submission_id, files, length(t) AS chars, md5(t) AS digest FROM t""",
    "truncate_with_marker": "SELECT doc_id, CASE WHEN length(text) > 1000 THEN substr(text, 1, 1000) || chr(10) || '[truncated ' || (length(text) - 1000) || ' chars]' || chr(10) ELSE text END AS text FROM documents",
    "chunk_fixed": """WITH c AS (SELECT doc_id, text, unnest(range(CAST(greatest(1, ceil(length(text) / 900.0)) AS BIGINT))) AS chunk_no FROM documents)
      SELECT doc_id, chunk_no, length(substr(text, chunk_no * 900 + 1, 900)) AS chars, md5(substr(text, chunk_no * 900 + 1, 900)) AS digest FROM c""",
    "whitespace_normalise": """SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '([.,])', '\\1 ' || chr(10) || ' ' || chr(9) || ' ', 'g'), '[ \\t\\r\\f\\v]+', ' ', 'g'), ' *\\n *', chr(10), 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), '^[ \\n]+|[ \\n]+$', '', 'g') AS text FROM documents""",
    "author_json_extract": "SELECT event_id, CASE WHEN event_id % 5 < 3 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events",
    "json_extract": "SELECT event_id, CASE WHEN event_id % 4 <> 3 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events",
    "url_rewrite": """WITH n AS (SELECT *, '24' || printf('%02d', page_id % 12 + 1) || '.' || printf('%05d', page_id) AS id FROM pages)
      SELECT page_id, CASE WHEN page_id % 11 = 0 THEN url WHEN page_id % 5 IN (0, 1) THEN 'https://render.example.org/html/' || id END AS html_url FROM n""",
    "file_kind_profile": f"""WITH {FILES}, k AS (SELECT submission_id AS set_id, {_SUFFIX_KIND} AS kind, CASE split_part(path, '/', 1) WHEN 'environment' THEN 'visible' WHEN 'notes' THEN 'package' ELSE 'hidden_or_solution' END AS scope, bytes FROM named),
      names AS (SELECT DISTINCT set_id, unnest(['kind:json', 'kind:image', 'kind:pdf', 'kind:text', 'kind:code', 'kind:shell', 'kind:archive', 'kind:binary', 'scope:visible', 'scope:hidden_or_solution', 'scope:package']) AS name FROM k),
      l AS (SELECT set_id, 'kind:' || kind AS name, bytes FROM k UNION ALL SELECT set_id, 'scope:' || scope, bytes FROM k)
      SELECT set_id, name, count(bytes) AS files, CAST(coalesce(sum(bytes), 0) AS BIGINT) AS bytes FROM names LEFT JOIN l USING (set_id, name) GROUP BY ALL""",
    "largest_files": f"WITH {FILES} SELECT path, bytes FROM files ORDER BY bytes DESC, path LIMIT 10",
    "content_digest": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
    "fingerprint": "SELECT page_id % 10 AS set_id, substr(sha256(CAST(string_agg(printf('%06d', page_id) || chr(0) || md5(html) || chr(0), '' ORDER BY page_id) AS VARCHAR)), 1, 40) AS fingerprint FROM pages GROUP BY 1",
    "duplicate_ids": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "compound_requirement_warning": "SELECT doc_id FROM documents WHERE len(regexp_extract_all(text, '(?i)\\b(?:and|plus)\\b|以及|并且|同时|且')) >= 2",
    "unquantified_match_warning": f"""WITH w AS (SELECT doc_id, text || CASE WHEN doc_id % 3 = 0 THEN ' it matches' ELSE '' END || CASE WHEN doc_id % 6 = 0 THEN ' within 5' ELSE '' END AS t FROM documents)
      SELECT doc_id FROM w WHERE regexp_matches(t, '{rules.VAGUE}') AND NOT regexp_matches(t, '{rules.MEASURED}')""",
    "addendum_checks": """WITH n AS (SELECT doc_id, text || CASE WHEN doc_id % 2 = 0 THEN chr(10) || 'Scope' || chr(10) || 'clarifications' ELSE '' END || CASE WHEN doc_id % 7 = 0 THEN ' TODO' ELSE '' END AS t FROM documents)
      SELECT doc_id, 'error' AS severity, 'addendum is empty' AS rule FROM n WHERE NOT regexp_matches(t, '\\S')
      UNION ALL SELECT doc_id, 'warning', 'no section on scope' FROM n WHERE NOT regexp_matches(lower(t), 'scope|范围')
      UNION ALL SELECT doc_id, 'warning', 'no section on approved adaptations' FROM n WHERE NOT regexp_matches(lower(t), 'approved adaptation|允许的调整|批准的调整')
      UNION ALL SELECT doc_id, 'warning', 'no section on required comparisons and evidence' FROM n WHERE NOT regexp_matches(lower(t), 'required comparison|required evidence|必要比较|所需证据')
      UNION ALL SELECT doc_id, 'warning', 'no section on clarifications' FROM n WHERE NOT regexp_matches(lower(t), 'clarification|澄清')
      UNION ALL SELECT doc_id, 'warning', 'no section on out of scope' FROM n WHERE NOT regexp_matches(lower(t), 'out of scope|范围外|不在范围')
      UNION ALL SELECT doc_id, 'error', 'placeholder is left' FROM n WHERE regexp_matches(t, '(?i)\\b(?:todo|tbd|fixme)\\b|待定|待补充|未知')
      UNION ALL SELECT doc_id, 'warning', 'addendum is short' FROM n WHERE length(t) < 300""",
    "parse_leaf_scores": f"WITH {RESPONSES} SELECT leaf_id, score, invalid FROM s",
    "reward_record": f"""WITH {RESPONSES}, g AS (SELECT right(leaf_id, 1) AS submission_id, avg(score) AS score, count(*) AS leaves, sum(requests) AS requests, sum(parsed) AS parsed FROM s GROUP BY 1),
      v AS (SELECT *, CAST(submission_id AS INTEGER) AS d FROM g), x AS (SELECT *, d <> 3 AS valid, CASE WHEN d <> 3 THEN round(score, 6) ELSE 0.0 END AS sc FROM v)
      SELECT submission_id, sc AS score, sc AS weighted_score, sc AS reward, CAST(CASE WHEN NOT valid THEN 0 WHEN d <> 4 THEN 1 ELSE 0.25 END AS DOUBLE) AS format, CAST(valid AS DOUBLE) AS submission_present,
        CAST(valid AS DOUBLE) AS judge_available, CASE WHEN valid THEN round(parsed / requests, 6) ELSE 0.0 END AS llm_parse_ok, CAST(leaves AS DOUBLE) AS leaf_count,
        CAST(CASE WHEN valid THEN requests - parsed ELSE leaves END AS DOUBLE) AS invalid_leaf_count, CAST(leaves * 2 AS DOUBLE) AS rubric_weight_total, CAST(valid AS DOUBLE) AS reproduction_ran,
        CAST(valid AND d % 2 = 0 AS DOUBLE) AS reproduction_success, CAST(0 AS DOUBLE) AS code_only FROM x""",
    "ordered_distinct": "SELECT min(event_id) AS event_id, props FROM events GROUP BY props",
    "blacklist_lines": """WITH l AS (SELECT doc_id, unnest(range(len(ls))) AS i, trim(unnest(ls), ' ' || chr(9) || chr(13)) AS s FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
      f AS (SELECT doc_id, s, min(i) AS i FROM l WHERE s <> '' GROUP BY ALL)
      SELECT d.doc_id, count(s) AS n, md5(coalesce(string_agg(s, chr(10) ORDER BY i), '')) AS digest FROM documents d LEFT JOIN f USING (doc_id) GROUP BY d.doc_id""",
    "task_ids": f"SELECT doc_id, {_TASK} AS task_id FROM documents",
    "manifest_rows": f"SELECT {_MANIFEST} AS value FROM documents",
    "select_papers": f"WITH {_WANTED} SELECT doc_id AS paper_id, lang FROM documents WHERE doc_id IN (SELECT paper_id FROM wanted)",
    "unknown_ids": f"WITH {_WANTED} SELECT paper_id FROM wanted WHERE paper_id NOT IN (SELECT doc_id FROM documents)",
    "bundle_priority": """SELECT doc_id AS paper_id, CASE WHEN p THEN 'published' ELSE 'draft' END AS state, 'regular' AS mode FROM (
      SELECT d.doc_id, coalesce(max(l.toxic) = 0, false) AS p FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY d.doc_id) WHERE p OR doc_id % 2 = 1""",
    "set_equality_audit": f"WITH {_WANTED} SELECT coalesce(d.doc_id, w.paper_id) AS id, CASE WHEN d.doc_id IS NULL THEN 'right' ELSE 'left' END AS only_in FROM documents d FULL JOIN wanted w ON d.doc_id = w.paper_id WHERE d.doc_id IS NULL OR w.paper_id IS NULL",
    "hash_approval_audit": "SELECT doc_id, sha256(CASE WHEN doc_id % 10 = 0 THEN text || '!' ELSE text END) AS approved, CASE WHEN doc_id % 13 <> 5 THEN sha256(text) END AS actual FROM documents WHERE doc_id % 10 = 0 OR doc_id % 13 = 5",
    "contract_text_rules": """SELECT page_id, 'page' AS file, needle, wanted FROM pages, (VALUES ('<article', true), ('page=2', false), ('<nav>', true), ('track(1)', false)) r(needle, wanted) WHERE contains(html, needle) <> wanted""",
    "resource_classify": """WITH m AS (SELECT p_partkey, lower(CASE p_size % 4 WHEN 0 THEN 'CPU only' WHEN 1 THEN 'cpu + A100' WHEN 2 THEN p_type ELSE '' END) AS a, CASE WHEN p_size % 8 = 3 THEN 'one h100' ELSE '' END AS n FROM part)
      SELECT p_partkey, CASE WHEN contains(a, 'cpu') AND NOT regexp_matches(a, 'gpu|h200|a100|h100') THEN 'cpu_sufficient' WHEN regexp_matches(a || ' ' || n, 'gpu|h200|a100|h100') THEN 'gpu_relevant' ELSE 'gpu_required_likely' END AS resource_class FROM m""",
    "model_switch_split": "SELECT doc_id, source, CASE WHEN row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 3 THEN 'first' ELSE 'second' END AS model FROM documents",
    "incremental_skip": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 1)",
    "staged_publish": f"SELECT {_TASK} AS task_id, {_MANIFEST} AS value FROM documents",
    "mock_model_pipeline": """WITH c AS (SELECT turn - 1 AS turn, min(text) AS common FROM conversations WHERE role <> 'user' GROUP BY 1),
      o AS (SELECT conv_id, turn - 1 AS turn, text AS own FROM conversations WHERE role <> 'user' AND conv_id % 2 = 0)
      SELECT u.conv_id, u.turn, md5(coalesce(own, common)) AS answer FROM conversations u LEFT JOIN o USING (conv_id, turn) LEFT JOIN c USING (turn) WHERE role = 'user'""",
}
