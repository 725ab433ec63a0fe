"""MinHash near-duplicates: one-permutation hashing with optimal densification, banded buckets and star-shaped
candidate edges, each confirmed on the full shingle sets.

Documents with equal shingle sets are one vertex from the start, so copies never form pairs. A bucket of m vertices
gives m - 1 candidate edges to its hub, the member with the most company in all its buckets. A vertex is compared with its
heaviest hub first, and with others only where it is still apart from them.

Where that leaves a hub's members in several components, links between two of them are still open. Each member is then
held as what it differs in from its hub: for sets x, y and a hub h, x and y differ in as many shingles as their differences
from h do, so a link needs a known number of common shingles of those differences. In order of their rarity among the hub's
members a link's first common shingle stands early in both (prefix and position bounds of exact set joins); only pairs that
share such a shingle are compared. Nothing is lost by it, no bucket is capped, and independent edits of one text share no
rare shingle, so that the pairs follow the links and not the square of the group.

Nulls: a null text is empty; empty documents have no shingles and no links. A row with a null doc_id keeps its
n_shingles, has a null component_id and is not kept. Repeated rows give repeated rows. Rows that share a doc_id but not
a text each report the component of their own text. Further columns are ignored. An empty table gives no rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import components
from .textkit import LOWER, U64, keys, mix, pieces, releasing, text_bytes, word_hashes, words
from .work import Workspace


@dataclass(frozen=True)
class NearDup:
    """words: words in a shingle. percent: least Jaccard similarity in hundredths. bands x rows: one-permutation bins.
    At similarity 0.8 a pair shares no band with probability (1 - 0.8**rows)**bands, 3e-6 by default."""

    words: int = 5
    percent: int = 80
    bands: int = 42
    rows: int = 6


#: Rows with texts or sets that one task at most takes at once where it could take more.
WIDE = 10_000


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row. A row with fewer words has its whole sequence as one shingle."""
    data = LOWER[data]
    starts, ends, count = words(data, offsets)
    each = word_hashes(data, starts, ends)
    multiplier = keys(size, 31) | U64(1)
    with np.errstate(over="ignore"):
        n = max(0, len(each) - size + 1)
        rolling = np.zeros(n, U64)
        for k in range(size):
            rolling += each[k : k + n] * multiplier[k]
        rolling = mix(rolling)
    out, at = [], 0
    for c in count.tolist():
        if c >= size:
            out.append(np.unique(rolling[at : at + c - size + 1]))
        elif c:
            with np.errstate(over="ignore"):
                out.append(mix((each[at : at + c] * multiplier[:c]).sum(dtype=U64, keepdims=True) + U64(c)))
        else:
            out.append(np.zeros(0, U64))
        at += c
    return out


def one_permutation(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """A row of `bins` minima for each set; an empty bin takes the value of the first non-empty bin of its own
    probe sequence, the same for all sets (optimal densification). Empty sets give zeros."""
    count = np.fromiter(map(len, sets), np.int64, len(sets))
    out = np.zeros((len(sets), bins), U64)
    if not count.sum():
        return out
    flat = np.concatenate(sets)
    cell = np.repeat(np.arange(len(sets)) * bins, count) + ((flat >> U64(32)) * U64(bins) >> U64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(cell, prepend=-1))  # sorted within a set, so the first of a cell is its least
    out.reshape(-1)[cell[first]] = mix(flat[first])
    filled = np.zeros(len(sets) * bins, bool)
    filled[cell[first]] = True
    filled = filled.reshape(len(sets), bins)
    row, empty = np.nonzero(~filled & (count > 0)[:, None])
    attempt = 0
    while len(row):
        attempt += 1
        with np.errstate(over="ignore"):
            probe = (mix(empty.astype(U64) * U64(0x9E3779B97F4A7C15) + U64(attempt)) >> U64(33)).astype(np.int64) % bins
        hit = filled[row, probe]
        out[row[hit], empty[hit]] = out[row[hit], probe[hit]]
        row, empty = row[~hit], empty[~hit]
    return out


def band_keys(minima: np.ndarray, bands: int, rows: int) -> np.ndarray:
    multiplier = keys(rows, 97) | U64(1)
    with np.errstate(over="ignore"):
        cells = minima.reshape(len(minima), bands, rows)
        return mix((cells * multiplier).sum(axis=2, dtype=U64) + keys(bands, 5)).view(np.int64)


def _sketcher(conf: NearDup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in pieces(offsets):
                sets = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], conf.words)
                minima = one_permutation(sets, conf.bands * conf.rows)
                bands = band_keys(minima, conf.bands, conf.rows)
                count = np.fromiter(map(len, sets), np.int64, len(sets))
                digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                listed = pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, conf.bands, dtype=np.int32)), pa.array(bands.reshape(-1)))
                own = [batch.column(c)[i:j] for c in ("doc_id", "h")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(count), pa.array(digest, pa.binary()), listed], ["doc_id", "h", "n_shingles", "digest", "bands"])

    return run


def _setter(conf: NearDup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in pieces(offsets):
                sets = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], conf.words)
                digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
                listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), listed], ["digest", "shingles"])

    return run


def near_duplicates(docs: DataFrame, conf: NearDup = NearDup()) -> DataFrame:
    """`docs(doc_id, text)` to `(doc_id, n_shingles, component_id, kept, n_links)`; n_links counts the confirmed
    candidate edges of the document's class."""
    work = Workspace(docs.sparkSession, "neardup")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    sketch = work.keep(docs.mapInArrow(releasing(_sketcher(conf)), "doc_id long, h long, n_shingles long, digest binary, bands array<long>"), "sketch")
    n = sketch.count()

    some = sketch.filter("n_shingles > 0 and doc_id is not null")
    least = F.min(F.struct("doc_id", "h")).alias("least")
    classes = work.keep(some.groupBy("digest").agg(least).select("digest", F.col("least.doc_id").alias("rep"), F.col("least.h").alias("h")), "classes", n)
    # the vertices: one row a class
    same = (some["digest"] == classes["digest"]) & (some["doc_id"] == classes["rep"]) & (some["h"] == classes["h"])
    vertex = some.join(classes, same).select("rep", some["h"], some["digest"], F.col("n_shingles").alias("n"), "bands")
    rows = vertex.select("rep", "h", "digest", "n", F.posexplode("bands").alias("band", "bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    rows = work.keep(rows.join(shared, "bucket").distinct(), "shared", n * conf.bands)
    m = rows.count()
    weight = rows.groupBy("rep").agg(F.sum("members").alias("weight"))
    rows, bare = work.keep(rows.join(weight, "rep").drop("members", "band"), "buckets", m), rows
    work.drop(bare)

    # texts of vertices in shared buckets only, one row each; never a broadcast, as these grow with the input
    involved = rows.select(F.col("rep").alias("doc_id"), "h").distinct().hint("merge")
    texts = docs.join(involved, ["doc_id", "h"], "left_semi").dropDuplicates(["doc_id", "h"])
    sets = work.keep(texts.mapInArrow(releasing(_setter(conf)), "digest binary, shingles array<long>"), "sets", min(n, m), WIDE)

    # every bucket is a star around its heaviest member
    hub = F.min(F.struct((-F.col("weight")).alias("light"), "rep", "n", "digest")).alias("h")
    hubs = rows.groupBy("bucket").agg(hub).select("bucket", F.col("h.rep").alias("hub"), F.col("h.digest").alias("hub_digest"), F.col("h.n").alias("hub_n"), F.col("h.light").alias("light"))
    members = rows.join(hubs, "bucket").filter("hub <> rep").select("hub", "hub_digest", "hub_n", "light", "rep", "digest", "n")
    members = work.keep(members.distinct(), "members", m)
    stars = members.filter(_sized("hub_n", "n", conf))

    # a member tries its heaviest hub first
    first = stars.groupBy("rep", "digest").agg(F.min(F.struct("light", "hub", "hub_digest")).alias("h"))
    first = work.keep(first.select(F.col("h.hub").alias("a"), F.col("h.hub_digest").alias("da"), F.col("rep").alias("b"), F.col("digest").alias("db")), "first", n)
    links = work.keep(_confirmed(first, sets, conf), "links", n, WIDE)
    label = components(links, work, n)

    # then the other hubs of members that are still apart from them
    others = stars.select(F.col("hub").alias("a"), F.col("hub_digest").alias("da"), F.col("rep").alias("b"), F.col("digest").alias("db")).join(first, ["a", "b"], "left_anti")
    apart = work.keep(_labelled(_labelled(others, label, "a", "ca"), label, "b", "cb").filter("ca <> cb").drop("ca", "cb"), "apart", m)
    links, label = _more(links, label, apart, sets, conf, work, m)

    # and last, pairs of members of one hub that are still apart
    now = _labelled(members, label, "rep", "component")
    by_part = now.groupBy("hub", "component").agg(F.count("*").alias("m"))
    parts = by_part.groupBy("hub").agg(F.max(F.struct("m", "component")).alias("top"), F.count("*").alias("parts")).filter("parts > 1")
    parts = work.keep(parts.select("hub", F.col("top.component").alias("main")), "parts", n)
    mixed = work.keep(now.join(parts, "hub").withColumn("few", F.col("component") != F.col("main")).drop("main", "light"), "mixed", m)
    if not mixed.isEmpty():
        rest = work.keep(_pairs_of_differences(mixed, sets, conf, work), "rest", m)
        links, label = _more(links, label, rest, sets, conf, work, m)

    degree = links.select(F.col("a").alias("rep")).union(links.select(F.col("b").alias("rep"))).groupBy("rep").agg(F.count("*").alias("n_links"))
    known = _labelled(classes, label, "rep", "component_id").join(degree, "rep", "left")
    known = work.keep(known.select("digest", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links")), "known", n)
    for done in (sets, rows, members, mixed, first, apart, classes, links, label):
        work.drop(done)
    own = sketch.select("doc_id", "n_shingles", "digest").join(known, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return own.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def representatives(docs: DataFrame, conf: NearDup = NearDup()) -> DataFrame:
    """The rows of `docs` of which one stays of each group of near duplicates: the one with the smallest doc_id, and of several
    texts or rows of one doc_id the one that a hash of the row puts first. Rows without a doc_id come last and stay
    where no other row is near them; equal rows are one. Numbers that follow this order stand for the rows."""
    work = Workspace(docs.sparkSession, "representatives")
    columns = docs.columns
    h = F.xxhash64(*columns, *(F.col(c).isNull() for c in columns))
    rows = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text", h.alias("h"))
    order = [F.col("doc_id").asc_nulls_last(), "h"]
    ids = rows.select("doc_id", "h").distinct().repartitionByRange(*order).sortWithinPartitions(*order)
    n = docs.count()
    ids = work.keep(ids.select(F.col("doc_id").alias("doc_id_"), F.col("h").alias("h_"), F.monotonically_increasing_id().alias("id")), "ids")
    named = rows.join(ids.hint("merge"), F.col("doc_id").eqNullSafe(F.col("doc_id_")) & (F.col("h") == F.col("h_")))
    named = work.keep(named.dropDuplicates(["id"]).select("id", "row"), "named", n, WIDE)
    found = near_duplicates(named.select(F.col("id").alias("doc_id"), F.col("row.text").alias("text")), conf)
    return named.join(found.filter("kept").select(F.col("doc_id").alias("id")).hint("merge"), "id", "left_semi").select("row.*")


def _sized(one: str, two: str, conf: NearDup) -> Column:
    """Whether sets of these sizes can be near enough."""
    return F.expr(f"100 * least({one}, {two}) >= {conf.percent} * greatest({one}, {two})")


def _confirmed(pairs: DataFrame, sets: DataFrame, conf: NearDup) -> DataFrame:
    """(a, b) of `pairs(a, da, b, db)` whose full sets are near enough: a row at a time in the JVM, however long."""
    one = sets.select(F.col("digest").alias("db"), F.col("shingles").alias("right")).hint("merge")
    two = sets.select(F.col("digest").alias("da"), F.col("shingles").alias("left")).hint("merge")
    near = F.expr(f"{100 + conf.percent}L * size(array_intersect(left, right)) >= {conf.percent}L * (size(left) + size(right))")
    return pairs.join(one, "db").join(two, "da").filter(near).select("a", "b")


def _more(links: DataFrame, label: DataFrame, pairs: DataFrame, sets: DataFrame, conf: NearDup, work: Workspace, rows: int) -> tuple[DataFrame, DataFrame]:
    """The links with those among `pairs`, a written table, and their components; `rows`: links, about."""
    if pairs.isEmpty():
        return links, label
    found = work.keep(_confirmed(pairs, sets, conf), "found", rows, WIDE)
    if found.isEmpty():
        return links, label
    after = work.keep(links.union(found).distinct(), "links", rows)
    for done in (links, found, label):
        work.drop(done)
    return after, components(after, work, rows)


def _pairs_of_differences(mixed: DataFrame, sets: DataFrame, conf: NearDup, work: Workspace) -> DataFrame:
    """Pairs (a, da, b, db) of members of one hub in different components that the differences from the hub don't rule out.
    `mixed(hub, hub_digest, hub_n, rep, digest, n, component, few)`; a pair has a member that is one of the few.

    With I the least common shingles of sizes x and y and d, e their differences from the hub, the differences of a link have
    at least I - (x + y - d - e) / 2 shingles in common, and no partner needs more than the first n * (100 - percent) /
    percent + 1 of them. Shingles that only one member differs in come first in its order and are never written."""
    own = sets.select(F.col("digest"), F.col("shingles").alias("own")).hint("merge")
    its = sets.select(F.col("digest").alias("hub_digest"), F.col("shingles").alias("its")).hint("merge")
    differs = F.concat(F.array_except("own", "its"), F.array_except("its", "own"))
    wide = mixed.join(own, "digest").join(its, "hub_digest").select("hub", "rep", "digest", "n", "component", "few", differs.alias("differs"))
    each = work.keep(wide.select("hub", "rep", "digest", "n", "component", "few", F.size("differs").alias("d"), F.explode("differs").alias("x")), "differences", 100 * mixed.count())
    common = each.groupBy("hub", "x").agg(F.count("*").alias("n_members"), F.count_if("few").alias("n_few")).filter("n_members > 1 and n_few > 0")
    by_member = Window.partitionBy("hub", "digest")
    shared = each.join(common.drop("n_few"), ["hub", "x"])
    place = F.col("d") - F.count("*").over(by_member) + F.row_number().over(by_member.orderBy("n_members", "x"))
    early = work.keep(shared.withColumn("place", place).filter(f"place <= n * {100 - conf.percent} div {conf.percent} + 1").drop("n_members"), "early", each.count(), 50_000)
    work.drop(each)
    one, two = early.filter("few").alias("f"), early.alias("o")
    least = F.expr(f"ceil({conf.percent} * (f.n + o.n) / {100 + conf.percent}) - (f.n + o.n - f.d - o.d) div 2")
    left = F.expr("least(f.d - f.place, o.d - o.place) + 1")
    once = F.expr("f.component <> o.component and (not o.few or f.rep < o.rep)")
    on = F.expr("f.hub = o.hub and f.x = o.x") & once & _sized("f.n", "o.n", conf) & (left >= least)
    pairs = one.join(two.hint("merge"), on)
    return pairs.select(F.col("f.rep").alias("a"), F.col("f.digest").alias("da"), F.col("o.rep").alias("b"), F.col("o.digest").alias("db")).distinct()


def _labelled(rows: DataFrame, label: DataFrame, node: str, name: str) -> DataFrame:
    """`name`: the component of `node`, itself where it has no link."""
    known = label.select(F.col("node").alias(node), F.col("component").alias(name))
    return rows.join(known, node, "left").withColumn(name, F.coalesce(name, node))


#: The default links at four words in SQL, by counting the shingles that two documents share.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w
), n AS (SELECT doc_id, len(s) AS n FROM s), e AS (SELECT doc_id, unnest(s) AS x FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
both_ AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS t FROM documents UNION SELECT r.doc_id, b FROM r JOIN both_ ON both_.a = r.t)
SELECT doc_id, n AS n_shingles, min(t) AS component_id, doc_id = min(t) AS kept FROM n JOIN r USING (doc_id) GROUP BY doc_id, n
"""
