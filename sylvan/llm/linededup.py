"""Substring dedup by hashing units: units are normalised, their digests grouped over all documents, the earliest
occurrence is kept and all others are given with their original offsets.

Units are lines, and for passages that don't fill a line also seeds: of all rows of `run` words in each `passage` words of a
document, the one with the least digest. Two equal rows of `passage` words share a seed wherever they stand. Repeated seeds
that meet or overlap are one chain, so each word of a chain stands in a row of `run` words that occurs earlier; its two ends
are extended word by word as far as the text agrees with the earliest occurrence of the first and of the last seed. A chain of
`passage` words or more is removed. A repeated line of `least` words or more is removed by itself; shorter ones, such as menus and
licence lines, are given apart as `lines`, so that a caller who wants every line once removes those too.

Earliest is by doc_id, then by a hash of the text (for texts that share a doc_id), then by place. A unit's earliest
occurrence is a minimum that is combined before the shuffle, and only units that occur twice are looked at again; they are
joined to a written table of minima, so the rows of a common unit can be split over tasks. Texts are tokenized twice and
shuffled once, to the places where chains begin and end; those are at most a document's own words.

A to Z are lower-cased, white space within a unit doesn't count. Offsets count code points, ends are exclusive; spans of
`removed` are disjoint. Nulls: a null text is empty and has no units; a document without a doc_id is one of its own, told by
its text, and comes last in rank. Repeated rows of one doc_id and text are one document and report the same spans; texts that share a
doc_id are documents each. Further columns are ignored. An empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .textkit import LOWER, U64, keys, mix, pieces, releasing, text_bytes, word_hashes, words
from .work import Workspace


@dataclass(frozen=True)
class LineDedup:
    """least: words of a repeated line that is removed by itself. run: words of a seed. passage: words of a repeat that is
    removed, `run` at least and less than twice `run`, so that the seeds of a passage meet."""

    least: int = 40
    run: int = 21
    passage: int = 40

    @property
    def reach(self) -> int:
        """Words that a repeat can go on beyond its last seed."""
        return self.passage - self.run


def seeds(hashed: np.ndarray, row: np.ndarray, conf: LineDedup) -> tuple[np.ndarray, np.ndarray]:
    """First words and digests of the seeds. A seed that overlaps the first equal one of its text is none."""
    n, apart = len(hashed) - conf.run + 1, conf.reach + 1
    m = n - apart + 1
    if m < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gram = np.zeros(n, U64)
    with np.errstate(over="ignore"):
        for j, weight in enumerate(keys(conf.run, 97) | U64(1)):
            gram += hashed[j : j + n] * weight
    gram = mix(gram + U64(conf.run))
    least, at = gram[:m].copy(), np.zeros(m, np.int64)
    for j in range(1, apart):
        less = gram[j : j + m] < least
        least[less] = gram[j : j + m][less]
        at[less] = j
    at = np.unique((np.arange(m) + at)[row[:m] == row[conf.passage - 1 :]])
    order = np.lexsort((at, gram[at], row[at]))
    at = at[order]
    if not len(at):
        return at, at
    fresh = np.concatenate([[True], (np.diff(row[at]) != 0) | (np.diff(gram[at].view(np.int64)) != 0)])
    since = at - at[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
    at = np.sort(at[fresh | (since >= conf.run)])
    return at, gram[at].view(np.int64)


def lines(hashed: np.ndarray, row: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words, numbers of words and digests of the lines; `line` counts the line breaks before each word."""
    n = len(hashed)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    at = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(line, prepend=-1) > 0))
    length = np.diff(np.append(at, n))
    within = np.arange(n) - np.repeat(at, length)
    with np.errstate(over="ignore"):
        weight = keys(int(length.max()), 53) | U64(1)
        return at, length, mix(np.add.reduceat(hashed * weight[within], at) + length.astype(U64) * U64(2)).view(np.int64)


def _hashed(data: np.ndarray, offsets: np.ndarray):
    """Words of the texts: first and end bytes, hashes, the text of each and the first word of each text."""
    plain = LOWER[data]
    first, stop, count = words(plain, offsets)
    return first, stop, word_hashes(plain, first, stop), np.repeat(np.arange(len(count)), count), np.cumsum(count) - count


#: at: number of the first word. size: words of a line, 0 for a seed. span: start << 32 | end in code points.
_UNIT = "doc_id long, h long, at long, size int, span long, digest long"


def _units(conf: LineDedup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in pieces(offsets):
                part = data[offsets[i] : offsets[j]]
                first, stop, hashed, row, base = _hashed(part, offsets[i : j + 1] - offsets[i])
                at, size, digest = lines(hashed, row, np.concatenate([[0], np.cumsum(part == 10)])[first])
                seed, seed_digest = seeds(hashed, row, conf)
                at, size, digest = np.concatenate([at, seed]), np.concatenate([size, np.zeros_like(seed)]), np.concatenate([digest, seed_digest])
                code = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
                origin = code[offsets[row[at] + i] - offsets[i]]
                span = (code[first[at]] - origin) << 32 | (code[stop[at + np.where(size > 0, size, conf.run) - 1]] - origin)
                own = pa.array(row[at] + i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(own), batch.column("h").take(own), pa.array(at - base[row[at]]), pa.array(size, pa.int32()), pa.array(span), pa.array(digest, pa.int64())],
                    [c.split()[0] for c in _UNIT.split(", ")],
                )

    return run


_POINT = "doc_id long, h long, w long, ahead boolean, near binary, places binary"


def _points(conf: LineDedup):
    """For each wanted end of a chain (w * 2, or w * 2 + 1 where words from w on are wanted): hashes of the `reach` words before w,
    from the last, or of those from w on, 0 where no word is; and where those words begin or end, after where a chain begins
    or ends that none of them joins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            wanted = batch.column("wanted")
            for i, j in pieces(offsets):
                part = data[offsets[i] : offsets[j]]
                first, stop, hashed, row, base = _hashed(part, offsets[i : j + 1] - offsets[i])
                code = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
                count = np.bincount(row, minlength=j - i)
                some = wanted[i:j]
                owner, ends = np.repeat(np.arange(j - i), np.asarray(some.value_lengths())), np.asarray(some.flatten())
                for a in range(0, len(ends), 20_000):
                    text, w, ahead = owner[a : a + 20_000], ends[a : a + 20_000] >> 1, (ends[a : a + 20_000] & 1).astype(bool)
                    # the chain's own word beside the end, and then the words beyond it
                    number = np.where(ahead[:, None], w[:, None] - 1 + np.arange(conf.reach + 1), w[:, None] - np.arange(conf.reach + 1))
                    inside = (number >= 0) & (number < count[text][:, None])
                    word = np.clip(base[text][:, None] + number, 0, max(len(hashed) - 1, 0))
                    place = np.where(ahead[:, None], code[stop[word]], code[first[word]]) - code[offsets[i + text] - offsets[i]][:, None]
                    near = np.where(inside, hashed[word] >> U64(32) | U64(1), U64(0))[:, 1:].astype("<u4")
                    raw = [pa.array([r.tobytes() for r in x], pa.binary()) for x in (near, place.astype("<i4"))]
                    rows = pa.array(text + i)
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(rows), batch.column("h").take(rows), pa.array(w), pa.array(ahead), *raw], [c.split()[0] for c in _POINT.split(", ")])

    return run


def _extended(conf: LineDedup):
    """Spans of chains in code points, and their words, after both ends went on as far as the texts agree."""
    table = lambda x, kind, width: np.frombuffer(b"".join(x.to_pylist()), kind).reshape(len(x), width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, spans = np.asarray(batch.column("size")).copy(), []
            for end in ("start", "stop"):
                own, its = (table(batch.column(f"{end}_{c}"), "<u4", conf.reach) for c in ("near", "its"))
                more = np.cumprod((own == its) & (own != 0), axis=1, dtype=np.int64).sum(1)
                size += more
                spans.append(table(batch.column(f"{end}_places"), "<i4", conf.reach + 1)[np.arange(len(more)), more].astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), *map(pa.array, (*spans, size))], ["doc_id", "h", "starts", "ends", "size"])

    return run


def _rank() -> Column:
    """An occurrence's rank: null ids last, then by text, then by place."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("h").alias("h"), F.col("at").alias("at"))


def _ends(chains: DataFrame, of: str, columns: tuple[str, str]) -> DataFrame:
    """Both ends of the chains, as (doc_id, h, w): the words of their own text or of the earlier one."""
    sides = [F.struct(*(F.col(f"{side}.{c}").alias(n) for c, n in zip((*columns, of), ("doc_id", "h", "w"), strict=True)), F.lit(k).alias("k")) for k, side in enumerate(("start", "stop"))]
    return chains.select(F.explode(F.array(*sides)).alias("e")).select("e.doc_id", "e.h", (F.col("e.w") * 2 + F.col("e.k")).alias("w"))


def _with_point(chains: DataFrame, points: DataFrame, side: str, key: tuple[str, str, str], *names: str) -> DataFrame:
    """`chains` with near and places of the point that `key` names in the struct `side`, under the given names."""
    ahead = points.filter("ahead" if side == "stop" else "not ahead")
    own = ahead.select(F.col("doc_id").alias("p_id"), F.col("h").alias("p_h"), F.col("w").alias("p_w"), *(F.col(c).alias(n) for c, n in zip(("near", "places"), names, strict=False)))
    doc_id, h, w = (F.col(f"{side}.{c}") for c in key)
    return chains.join(own.hint("merge"), doc_id.eqNullSafe(F.col("p_id")) & (h == F.col("p_h")) & (w == F.col("p_w"))).drop("p_id", "p_h", "p_w")


def repeats(docs: DataFrame, conf: LineDedup = LineDedup()) -> DataFrame:
    """`docs(doc_id, text)` to `(doc_id, h, n_repeats, removed, lines)`; `removed` and `lines` are sorted arrays of (starts, ends),
    `lines` those repeated lines that don't lie within a span of `removed`; h is a hash of the text."""
    work = Workspace(docs.sparkSession, "linededup")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    every = work.keep(docs.mapInArrow(releasing(_units(conf)), _UNIT), "units")
    n = every.count()
    twice = work.keep(every.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest"), "twice", n)
    again = work.keep(every.join(twice.hint("merge"), "digest"), "again", n)
    n = again.count()
    work.drop(every)
    first = work.keep(again.groupBy("digest").agg(F.min(_rank()).alias("first")), "first", n)
    later = again.join(first.hint("merge"), "digest").filter(_rank() != F.col("first"))
    later = work.keep(later.select("doc_id", "h", "at", "size", "span", F.col("first.doc_id").alias("from_id"), F.col("first.h").alias("from_h"), F.col("first.at").alias("from_at")).distinct(), "later", n)
    n = later.count()
    for done in (twice, again, first):
        work.drop(done)

    # seeds that meet are one chain
    in_doc = Window.partitionBy("doc_id", "h").orderBy("at")
    parts = later.filter("size = 0").withColumn("fresh", F.coalesce(F.col("at") - F.lag("at").over(in_doc) > conf.run, F.lit(True)).cast("long"))
    parts = parts.withColumn("chain", F.sum("fresh").over(in_doc.rowsBetween(Window.unboundedPreceding, 0)))
    side = lambda *more: F.struct("at", "doc_id", "h", "from_id", "from_h", *more)
    chains = parts.groupBy(F.col("doc_id").alias("id"), F.col("h").alias("text_h"), "chain").agg(F.min(side("from_at")).alias("start"), F.max(side("from_at")).alias("last"))
    # a chain's stop is the word after its last seed, here and there
    stop = F.struct((F.col("last.at") + conf.run).alias("at"), *(f"last.{c}" for c in ("doc_id", "h", "from_id", "from_h")), (F.col("last.from_at") + conf.run).alias("from_at"))
    chains = work.keep(chains.select("start", stop.alias("stop")), "chains", n)
    n = chains.count()
    wanted = _ends(chains, "at", ("doc_id", "h")).union(_ends(chains, "from_at", ("from_id", "from_h"))).distinct()
    wanted = wanted.groupBy(F.col("doc_id").alias("id"), F.col("h").alias("text_h")).agg(F.collect_list("w").alias("wanted"))
    texts = docs.join(wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("text_h"))).select("doc_id", "h", "text", "wanted")
    points = work.keep(texts.mapInArrow(releasing(_points(conf)), _POINT).dropDuplicates(["doc_id", "h", "w", "ahead"]), "points", 4 * n, 50_000)
    found = chains
    for end in ("start", "stop"):
        found = _with_point(found, points, end, ("doc_id", "h", "at"), f"{end}_near", f"{end}_places")
        found = _with_point(found, points, end, ("from_id", "from_h", "from_at"), f"{end}_its")
    found = found.select("start.doc_id", "start.h", (F.col("stop.at") - F.col("start.at")).alias("size"), *(f"{end}_{c}" for end in ("start", "stop") for c in ("near", "its", "places")))
    passages = found.mapInArrow(_extended(conf), "doc_id long, h long, starts long, ends long, size long")
    of_lines = later.filter("size > 0").select(
        "doc_id", "h", F.shiftright("span", 32).alias("starts"), F.col("span").bitwiseAND((1 << 32) - 1).alias("ends"), (F.col("size") >= conf.least).alias("counts")
    )
    spans = passages.filter(F.col("size") >= conf.passage).select("doc_id", "h", "starts", "ends", F.lit(True).alias("counts")).union(of_lines)
    # spans to remove that overlap become one; short lines within them are nothing of their own
    by_doc = Window.partitionBy("doc_id", "h").orderBy("starts", F.col("ends").desc())
    till = F.max(F.when(F.col("counts"), F.col("ends"))).over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("till", till).filter(F.col("counts") | F.coalesce(F.col("ends") > F.col("till"), F.lit(True)))
    fresh = F.coalesce(F.col("starts") > F.col("till"), F.lit(True)) | ~F.col("counts")
    group = F.when(F.col("counts"), F.sum(F.when(F.col("counts") & fresh, 1).otherwise(0)).over(by_doc.rowsBetween(Window.unboundedPreceding, 0)))
    merged = spans.withColumn("group", group).groupBy("doc_id", "h", "counts", F.coalesce("group", -F.col("starts") - 1).alias("group")).agg(F.min("starts").alias("starts"), F.max("ends").alias("ends"))
    collect = lambda which: F.array_sort(F.collect_list(F.when(which, F.struct("starts", "ends"))))
    merged = merged.groupBy(F.col("doc_id").alias("id"), F.col("h").alias("text_h")).agg(collect(F.col("counts")).alias("removed"), collect(~F.col("counts")).alias("lines"))
    none = F.array().cast("array<struct<starts:bigint,ends:bigint>>")
    out = docs.select("doc_id", "h").join(merged, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("text_h")), "left")
    removed = F.coalesce("removed", none)
    return out.select("doc_id", "h", F.size(removed).cast("long").alias("n_repeats"), removed.alias("removed"), F.coalesce("lines", none).alias("lines"))


def digest(found: DataFrame) -> DataFrame:
    """`repeats`' rows with spans as text."""
    listed = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["starts"], x["ends"])), ",")
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + x["ends"] - x["starts"])
    return found.select("doc_id", "n_repeats", length.alias("removed_chars"), listed("removed").alias("removed"), F.size("lines").cast("long").alias("n_lines"), listed("lines").alias("lines"))
