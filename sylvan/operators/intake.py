"""Paper packages: where sources come from, whether what was fetched is whole, which extraction counts, and a package's files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.render import yaml
from ..functions.text import LEAST_TEXT
from ..sources.files import is_pdf

#: Fields of an entry that name local files or what must not be seen, and attempts of a download.
DROPPED_KEYS = ("assets_path", "blacklist", "markdown_path", "paper_assets", "paper_md", "paper_pdf", "pdf_path")
ATTEMPTS = 4


def resolved(entries: DataFrame) -> DataFrame:
    """`entries(local, url, local_exists, offline)` with `origin` (local or download), `place` and `problem`: a local path wins over an
    address, and offline nothing is fetched."""
    filled = lambda c: F.nullif(F.trim(c), F.lit(""))
    local, url = filled("local"), filled("url")
    problem = F.when(local.isNotNull(), F.when(~F.coalesce("local_exists", F.lit(False)), "local source is missing")).when(url.isNull(), "no source").when(F.coalesce("offline", F.lit(False)), "offline forbids a download")
    origin = F.when(local.isNotNull(), "local").when(url.isNotNull(), "download")
    return entries.withColumns({"problem": problem, "origin": F.when(problem.isNull(), origin), "place": F.when(problem.isNull(), F.coalesce(local, url))})


def attempt_problem(wants_pdf: Column) -> Column:
    """What is wrong with an attempt `(failed, expected, content)`, or null."""
    return (
        F.when(F.coalesce("failed", F.lit(False)) | F.col("content").isNull(), "no answer")
        .when(F.col("expected").isNotNull() & (F.octet_length("content") != F.col("expected")), "answer is cut off")
        .when(wants_pdf & ~is_pdf(F.col("content")), "no whole PDF")
    )


def downloads(attempts: DataFrame, most: int = ATTEMPTS) -> DataFrame:
    """`attempts(url, attempt, failed, expected, content)`, attempt from 0, to one row an address: `attempts` up to the first good
    one, seconds `waited` between them (1, 2, 4, ... after each failure), `bytes` of what counts, and the last `problem`."""
    tried = attempts.filter(F.col("attempt") < most).withColumn("problem", attempt_problem(F.endswith(F.lower("url"), F.lit(".pdf"))))
    good = F.min(F.when(F.col("problem").isNull(), F.col("attempt"))).over(Window.partitionBy("url"))
    counted = tried.withColumn("good", good).filter(F.col("good").isNull() | (F.col("attempt") <= F.col("good")))
    waited = F.sum(F.when(F.col("problem").isNotNull(), F.pow(F.lit(2.0), "attempt")))
    last = F.max(F.struct("attempt", F.when(F.col("problem").isNull(), F.octet_length("content")).alias("bytes"), "problem"))
    rows = counted.groupBy("url").agg(F.count("*").alias("attempts"), F.coalesce(waited, F.lit(0.0)).cast("long").alias("waited"), last.alias("last"))
    return rows.select("url", "attempts", "waited", F.col("last.bytes").cast("long").alias("bytes"), F.col("last.problem").alias("problem"))


def extracted(texts: DataFrame, least: int = LEAST_TEXT) -> DataFrame:
    """`texts(tool, first, second)`, the texts of a PDF by the tool that keeps the layout, by the first library and by the second, as
    `conversion`, `text` and `problem`: the tool's counts where the tool is there, else the first library's unless it is short."""
    own = {c: F.regexp_replace(F.col(c), r"(?U)^\s+|\s+$", "") for c in ("tool", "first", "second")}
    enough = F.length(own["first"]) >= least
    name = F.when(own["tool"].isNotNull(), "tool").when(F.coalesce(enough, F.lit(False)), "first").when(own["second"].isNotNull(), "second").otherwise("first")
    text = F.when(name == "tool", own["tool"]).when(name == "second", own["second"]).otherwise(own["first"])
    short = F.coalesce(F.length(text), F.lit(0)) < least
    return texts.withColumns({"conversion": F.when(~short, name), "text": F.when(~short, text), "problem": F.when(text.isNull(), "no extractor").when(short, "text is implausibly short")})


def fenced(text: Column, source: Column) -> Column:
    """An extraction as Markdown that tells where it comes from."""
    return F.concat(F.lit("<!-- Text of the paper's PDF; authoritative source: "), source, F.lit(" -->\n\n```text\n"), text, F.lit("\n```\n"))


def plausible(text: Column, least: int = LEAST_TEXT) -> Column:
    """The problem of a text that is too short to be a paper, or null."""
    return F.when(F.coalesce(F.length(text), F.lit(0)) < least, "text is implausibly short")


def metadata(papers: DataFrame) -> DataFrame:
    """`papers(paper_id, paper)` variants to `(paper_id, metadata)`: the entry without paths and blacklist, with the constant fields
    of a package that was built."""
    own = F.map_filter(F.try_variant_get("paper", "$", "map<string,variant>"), lambda k, v: ~k.isin(*DROPPED_KEYS))
    constant = {"agent_visible": F.lit(False), "authoring_status": F.lit("paper-package-built"), "purpose": F.lit("For authors only.")}
    added = F.create_map(*(x for k, v in constant.items() for x in (F.lit(k), F.to_variant_object(F.struct(v.alias("v"))))))
    added = F.transform_values(added, lambda k, v: F.variant_get(v, "$.v", "variant"))
    mine = F.map_filter(own, lambda k, v: ~k.isin(*constant))
    return papers.select("paper_id", F.map_concat(mine, added).alias("metadata"))


def metadata_or_entry(papers: DataFrame, stored: DataFrame) -> DataFrame:
    """`papers(paper_id, entry)` with the metadata of `stored(paper_id, metadata)`, or the entry where none is stored."""
    out = papers.join(stored.select("paper_id", F.col("metadata").alias("stored")), "paper_id", "left")
    return out.select("paper_id", F.coalesce("stored", "entry").alias("metadata"), F.col("stored").isNull().alias("fell_back"))


def packages(papers: DataFrame) -> DataFrame:
    """`papers(paper_id, title, markdown, pdf, blacklist)`, blacklist an array of lines, to `(paper_id, name, content)`: the files of each
    package, with a record of where they come from. Papers whose text is too short give `problem.txt` alone."""
    text = lambda c: F.encode(c, "utf-8")
    lines = F.coalesce("blacklist", F.array().cast("array<string>"))
    record = F.to_json(F.struct(
        F.size(lines).alias("blacklist_lines"), "paper_id", F.sha2("markdown", 256).alias("paper_md_sha256"), F.sha2("pdf", 256).alias("paper_pdf_sha256"),
    ))
    held = {
        "blacklist.txt": text(F.when(F.size(lines) > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")), "config.yaml": text(yaml({"id": F.col("paper_id"), "title": F.col("title")})),
        "paper.md": text(F.col("markdown")), "paper.pdf": F.col("pdf"), "source_provenance.json": text(F.concat(record, F.lit("\n"))),
    }
    problem = plausible(F.col("markdown"))
    file = lambda n, c: F.struct(F.lit(n).alias("name"), c.alias("content"))
    files = F.when(problem.isNull(), F.array(*(file(n, c) for n, c in held.items()))).otherwise(F.array(file("problem.txt", text(problem))))
    return papers.select("paper_id", F.explode(files).alias("f")).select("paper_id", "f.*")
