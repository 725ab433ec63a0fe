"""Secret scan with multipart credential linking, in DataFrame expressions only.

Three base kinds are reported wherever they match. Weak parts (an identifier field, a random-looking token, an endpoint)
are reported only if the parts that complete them lie in their scope, `scope` code points before or after their start.
That interval join runs as range frames over one document's parts in order of their start, so its cost is linear in the
parts; a weak part that overlaps a base span is that secret already and takes no part.

Offsets count code points, ends are exclusive. Nulls: a null text is empty and has no spans; a null doc_id stays a row of
its own. Repeated rows give repeated rows. Further columns are ignored. An empty table gives no rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Kinds in their order of report, with their patterns. The first three are the base kinds.
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{12,}",
    "hex": r"[0-9a-f]{32,}",
    "weak_id": r"""((?i:client|account|access|tenant|app|key|user)_?(?i:id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]+)""",
    "weak_key": r"[A-Za-z0-9+/_=-]{24,}",
    "endpoint": r"https?://[A-Za-z0-9.-]+(:[0-9]+)?(/[A-Za-z0-9._~/%-]*)?",
}
BASE = ("assign", "access", "hex")


@dataclass(frozen=True)
class Secrets:
    """scope: code points between the starts of parts that belong together. assigned: least length of an assigned value."""

    scope: int = 300
    assigned: int = 8


def _accepted(kind: str, conf: Secrets) -> Column:
    """Whether a match counts: an assigned value must be long enough, a weak token must mix digits and both cases."""
    match = F.col("match")
    if kind == "assign":
        return F.length(F.regexp_extract(match, "^" + PATTERNS["assign"], 2)) >= conf.assigned
    if kind == "weak_id":
        return F.length(F.regexp_extract(match, "^" + PATTERNS["weak_id"], 2)) >= 4
    if kind == "weak_key":
        return match.rlike("[0-9]") & match.rlike("[A-Z]") & match.rlike("[a-z]")
    return F.lit(True)


def parts(docs: DataFrame, conf: Secrets) -> DataFrame:
    """(doc_id, h, rank, kind, start, end) of every accepted match of every kind; h tells texts of one doc_id apart."""
    text = F.coalesce("text", F.lit(""))
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        # the text between matches and the matches alternate, so their lengths give the offsets
        found.append(
            F.struct(
                F.lit(rank).alias("rank"),
                F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"),
                F.split(text, pattern, -1).alias("between"),
            )
        )
    kinds = docs.select("doc_id", F.xxhash64(text).alias("h"), F.explode(F.array(*found)).alias("k")).filter(F.size("k.matches") > 0)
    rows = kinds.select("doc_id", "h", F.col("k.rank").alias("rank"), F.posexplode(F.arrays_zip("k.matches", F.slice("k.between", 1, F.size("k.matches")).alias("between"))).alias("i", "m"))
    rows = rows.select("doc_id", "h", "rank", "i", F.col("m.matches").alias("match"), F.length("m.between").cast("long").alias("gap"))
    rows = rows.repartition("doc_id", "h").dropDuplicates(["doc_id", "h", "rank", "i"])
    length = F.length("match").cast("long")
    end = F.sum(F.col("gap") + length).over(Window.partitionBy("doc_id", "h", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    accepted, name = F.lit(False), F.lit(None)
    for rank, kind in enumerate(PATTERNS):
        accepted = F.when(F.col("rank") == rank, _accepted(kind, conf)).otherwise(accepted)
        name = F.when(F.col("rank") == rank, F.lit(kind)).otherwise(name)
    return rows.withColumn("end", end).filter(accepted).select("doc_id", "h", "rank", name.alias("kind"), (F.col("end") - length).alias("start"), "end")


def link(found: DataFrame, conf: Secrets) -> DataFrame:
    """Base parts, and the weak parts whose complements are in scope."""
    base = F.col("rank") < len(BASE)
    doc = Window.partitionBy("doc_id", "h").orderBy("start")
    reach = F.max(F.when(base, F.col("end"))).over(doc.rangeBetween(Window.unboundedPreceding, 0))
    ahead = F.min(F.when(base, F.col("start"))).over(doc.rangeBetween(0, Window.unboundedFollowing))
    free = found.withColumns({"reach": reach, "ahead": ahead}).filter(
        base | ~(F.coalesce(F.col("reach") > F.col("start"), F.lit(False)) | F.coalesce(F.col("ahead") < F.col("end"), F.lit(False)))
    )
    near = doc.rangeBetween(-conf.scope, conf.scope)
    has = lambda *kinds: F.max(F.col("kind").isin(*kinds).cast("int")).over(near)
    seen = free.withColumns({"identifier": has("access", "weak_id"), "secret": has("assign", "hex", "weak_key")})
    linked = (
        base
        | ((F.col("kind") == "weak_id") & (F.col("secret") == 1))
        | ((F.col("kind") == "weak_key") & (F.col("identifier") == 1))
        | ((F.col("kind") == "endpoint") & (F.col("identifier") == 1) & (F.col("secret") == 1))
    )
    return seen.filter(linked).select("doc_id", "h", "rank", "kind", "start", "end")


def scan(docs: DataFrame, conf: Secrets = Secrets(), carry: tuple[str, ...] = ()) -> DataFrame:
    """`docs(doc_id, text, *carry)` to one row a document with `spans`, an array of (start, rank, kind, end) in order."""
    text = F.coalesce("text", F.lit(""))
    own = link(parts(docs.select("doc_id", "text"), conf), conf)
    own = own.groupBy("doc_id", "h").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias("found"))
    left = docs.select(F.col("doc_id").alias("id"), F.xxhash64(text).alias("hash"), *carry)
    out = left.join(own, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("h")), "left")
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return out.select(F.col("id").alias("doc_id"), *carry, F.coalesce("found", none).alias("spans"))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(scanned: DataFrame) -> DataFrame:
    """The contract's columns of `scan`'s rows."""
    spans = F.col("spans")
    count = lambda rank: F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")
    return scanned.select(
        "doc_id", *(count(r).alias(f"n_{k}") for r, k in enumerate(BASE)),
        F.sha2(listed(F.filter(spans, lambda s: s["rank"] < len(BASE))), 256).alias("base_sha256"), listed(spans).alias("spans"),
    )


def redact(scanned: DataFrame, mark: str = "[secret]") -> DataFrame:
    """`scan`'s rows with a carried text: each maximal run of overlapping spans gives way to `mark`; `spans` goes."""
    text = F.coalesce("text", F.lit(""))
    spans = F.col("spans")
    # spans are in order of start; one begins a run if it starts at or after every earlier end
    state = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("done")),
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(x["start"] >= s["at"], F.concat(s["done"], F.array(F.substring(text, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")), F.lit(mark))))
            .otherwise(s["done"])
            .alias("done"),
        ),
        lambda s: F.concat(F.array_join(s["done"], ""), F.substring(text, (s["at"] + 1).cast("int"), F.length(text))),
    )
    return scanned.withColumn("text", F.when(F.size(spans) > 0, state).otherwise(F.col("text"))).drop("spans")


_SQL_PATTERNS = [(rank, kind, pattern.replace("'", "''")) for rank, (kind, pattern) in enumerate(PATTERNS.items())]
#: The same in SQL, over DuckDB's own regular expressions; the scope is the default.
SQL = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
kinds AS (
  {" UNION ALL ".join(f"SELECT doc_id, {r} AS rank, '{k}' AS kind, regexp_extract_all(text, '{p}') AS ms, string_split_regex(text, '{p}') AS bs FROM docs" for r, k, p in _SQL_PATTERNS)}
), rows AS (
  SELECT doc_id, rank, kind, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS match, unnest(bs[1:len(ms)]) AS between_ FROM kinds WHERE len(ms) > 0
), placed AS (
  SELECT *, sum(length(between_) + length(match)) OVER (PARTITION BY doc_id, rank ORDER BY i) AS finish FROM rows
), parts AS (
  SELECT doc_id, rank, kind, CAST(finish - length(match) AS BIGINT) AS s, CAST(finish AS BIGINT) AS e FROM placed
  WHERE CASE kind WHEN 'assign' THEN length(regexp_extract(match, '^{_SQL_PATTERNS[0][2]}', 2)) >= 8
    WHEN 'weak_id' THEN length(regexp_extract(match, '^{_SQL_PATTERNS[3][2]}', 2)) >= 4
    WHEN 'weak_key' THEN regexp_matches(match, '[0-9]') AND regexp_matches(match, '[A-Z]') AND regexp_matches(match, '[a-z]')
    ELSE true END
), free AS (
  SELECT * FROM parts p WHERE rank < 3 OR NOT EXISTS (SELECT 1 FROM parts b WHERE b.doc_id = p.doc_id AND b.rank < 3 AND b.s < p.e AND b.e > p.s)
), linked AS (
  SELECT * FROM free p WHERE rank < 3
    OR (kind IN ('weak_key', 'endpoint') AND EXISTS (SELECT 1 FROM free q WHERE q.doc_id = p.doc_id AND abs(q.s - p.s) <= 300 AND q.kind IN ('access', 'weak_id'))
        AND (kind = 'weak_key' OR EXISTS (SELECT 1 FROM free q WHERE q.doc_id = p.doc_id AND abs(q.s - p.s) <= 300 AND q.kind IN ('assign', 'hex', 'weak_key'))))
    OR (kind = 'weak_id' AND EXISTS (SELECT 1 FROM free q WHERE q.doc_id = p.doc_id AND abs(q.s - p.s) <= 300 AND q.kind IN ('assign', 'hex', 'weak_key')))
), listed AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 3), '') AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
  FROM linked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN listed USING (doc_id)
"""
