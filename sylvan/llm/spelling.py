"""Spelling variants: words of a corpus grouped with the words that differ from them by one code point, without a pair being made.

A word stands in a wildcard group for each of its places: (place, what is before, what is after). Words of one group differ in that
place alone, so a group's size and its first two words tell each member how many near words it has there and which is the
best. For insertions and deletions each word's distinct deletions meet the vocabulary under the digest of what is left: the word
that is left and the words that it is left of see each other. A group has at most as many members as the alphabet has letters, for
insertions times the places, so no key is hot; rows are a word's code points, doubled.

Groups are keyed by two 64-bit sums of a number for each (place, letter); a wildcard takes one summand out and a deletion moves the
summands behind it, so a key costs a few operations however long the word is, and a word travels as its rank. Ranks are in order of
frequency, then of code points, so the best of some words is the least rank. A word's form is its best near word if that occurs at least
twice as often; along forms counts double, so chains are short, and roots are found by pointer jumping.

Words are runs of ASCII and Latin-1 letters, A to Z lower-cased; one run in `noise` (by a checksum of doc_id and run) loses a code
point first. Counts cover all rows: they are combined in each piece of a batch, in each task and then by word.

Nulls: a null text has no words; a null doc_id is written as nothing in the checksum. Repeated rows count each. Runs of any
length are words. An empty table gives no rows. Further columns are ignored."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .textkit import LOWER, U64, mix, pieces, releasing, text_bytes, words
from .work import Workspace

#: Bytes of letters that are one byte: A-Z and a-z. U+00C0 to U+00FF are 0xC3 and one byte more.
ASCII = np.zeros(256, bool)
ASCII[[*range(65, 91), *range(97, 123)]] = True
LATIN = 0xC3
_APART = np.array([True, False])
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, _CRC >> 1 ^ 0xEDB88320, _CRC >> 1).astype(np.uint32)

#: Roles of a key's rows.
WILDCARD, SHORTER, ITSELF = 0, 1, 2


@dataclass(frozen=True)
class Spelling:
    """least: code points of a word. often: occurrences of a word. noise: one run in so many loses a code point. twice: a form occurs so many times as often."""

    least: int = 5
    often: int = 3
    noise: int = 97
    twice: int = 2


def checksums(data: np.ndarray, starts: np.ndarray, length: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """crc32 of each run after a message whose crc32 is `begun`, all runs in step; long runs by themselves."""
    out = begun.copy()
    for i in np.flatnonzero(length > 64):
        out[i] = zlib.crc32(data[starts[i] : starts[i] + length[i]].tobytes(), int(begun[i]))
    order = np.argsort(-np.where(length > 64, 0, length).astype(np.int16), kind="stable")
    short = length[order]
    short[short > 64] = 0
    at, state = starts[order], ~begun[order]
    for t in range(int(short[0]) if len(short) else 0):
        live = int(np.searchsorted(-short, -t, "left"))  # runs longer than t come first
        now = state[:live]
        state[:live] = _CRC[(now ^ data[at[:live] + t]) & 0xFF] ^ now >> 8
    done = length[order] <= 64
    out[order[done]] = ~state[done]
    return out


def counted(data: np.ndarray, offsets: np.ndarray, ids: list[str], conf: Spelling) -> pa.StructArray:
    """(values, counts) of the words of some texts."""
    latin = data == LATIN
    letter = ASCII[data] | latin
    letter[1:] |= latin[:-1]
    starts, ends, count = words(letter.view(np.uint8), offsets, _APART)
    low, length = LOWER[data], ends - starts
    begun = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
    h = checksums(low, starts, length, np.repeat(begun, count))
    hit = h % conf.noise == 0
    first = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(length, out=first[1:])
    runs = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(first), pa.py_buffer(low[letter]))
    less = []
    for i in np.flatnonzero(hit):
        run = low[starts[i] : ends[i]].tobytes().decode()
        at = int(h[i]) % len(run)
        less.append(run[:at] + run[at + 1 :])
    long = ~hit & (length >= conf.least)
    runs = pa.chunked_array([runs.filter(pa.array(long)), pa.array(less, pa.large_string())])
    return runs.filter(pc.greater_equal(pc.utf8_length(runs), conf.least)).value_counts()


def vocabulary(docs: DataFrame, conf: Spelling, work: Workspace) -> DataFrame:
    """(rank, word, n) of every word that occurs often enough, written; ranks grow with falling n and then with the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            ids = batch.column("id").to_pylist()
            for i, j in pieces(offsets):
                found = counted(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], ids[i:j], conf)
                if len(found):
                    yield pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts")], ["word", "n"])

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    n = rows.mapInArrow(releasing(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= conf.often)
    # partitions of an ordered table are numbered in their order, so these numbers are in order too
    ranked = n.orderBy(F.desc("n"), "word").withColumn("rank", F.monotonically_increasing_id())
    return work.keep(ranked.select("rank", "word", "n"), "words")


def _number(place: np.ndarray, letter: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit number for each place and letter; letter 256 is the wildcard."""
    with np.errstate(over="ignore"):
        return mix((place.astype(U64) * U64(257) + letter.astype(U64) + U64(seed << 40)) * U64(0x9E3779B97F4A7C15) + U64(1))


def keys(letters: np.ndarray, length: np.ndarray, rank: np.ndarray, conf: Spelling) -> list[np.ndarray]:
    """Two digests, rank and role of every wildcard, every distinct deletion and every word; `letters` are the words side by side, a byte a code point."""
    first = np.cumsum(length) - length
    word = np.repeat(np.arange(len(length)), length)
    place = np.arange(len(letters)) - first[word]
    fresh = np.ones(len(letters), bool)  # of letters alike side by side one deletion counts
    fresh[1:] = (letters[1:] != letters[:-1]) | (place[1:] == 0)
    shorter = fresh & (length[word] > conf.least)
    sums = []
    with np.errstate(over="ignore"):
        for seed in (1, 2):
            own, moved = _number(place, letters, seed), _number(place - (place > 0), letters, seed)
            up = np.concatenate([np.zeros(1, U64), np.cumsum(own)])
            up_moved = np.concatenate([np.zeros(1, U64), np.cumsum(moved)])
            whole = up[first + length] - up[first]
            wild = whole[word] - own + _number(place, np.full(len(place), 256), seed)
            at = np.flatnonzero(shorter)
            cut = up[at] - up[first[word[at]]] + up_moved[(first + length)[word[at]]] - up_moved[at + 1]
            sums.append(np.concatenate([wild, cut, whole]).view(np.int64))
    which = np.concatenate([word, word[shorter], np.arange(len(length))])
    role = np.repeat(np.array([WILDCARD, SHORTER, ITSELF], np.int32), [len(word), int(shorter.sum()), len(length)])
    return [*sums, rank[which], role]


def _keyed(vocab: DataFrame, conf: Spelling) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("word"))
            rank = batch.column("rank").to_numpy()
            for i, j in pieces(offsets, 1 << 18):
                letters = np.frombuffer(data[offsets[i] : offsets[j]].tobytes().decode().encode("latin-1"), np.uint8)
                length = pc.utf8_length(batch.column("word").slice(i, j - i)).to_numpy().astype(np.int64)
                made = keys(letters, length, rank[i:j], conf)
                for a in range(0, len(made[0]), 1 << 20):
                    yield pa.RecordBatch.from_arrays([pa.array(x[a : a + (1 << 20)]) for x in made], ["k1", "k2", "rank", "role"])

    return vocab.select("rank", "word").mapInArrow(releasing(run), "k1 long, k2 long, rank long, role int")


def near(vocab: DataFrame, conf: Spelling) -> DataFrame:
    """(rank, n_near, best): near words of each word that has some, and the least of their ranks."""
    group = Window.partitionBy("k1", "k2").orderBy("role", "rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    role, itself = F.col("role"), F.max(F.when(F.col("role") == ITSELF, F.col("rank"))).over(group)
    rows = _keyed(vocab, conf).select(
        "rank", "role", F.count(F.lit(1)).over(group).alias("size"), F.first("rank").over(group).alias("one"), F.nth_value("rank", 2).over(group).alias("two"), itself.alias("itself")
    )
    # a wildcard's others; the word that a deletion leaves; the words that a word is left of
    others = F.when(role == SHORTER, F.col("itself").isNotNull().cast("long")).otherwise(F.col("size") - 1)
    best = F.when(role == WILDCARD, F.when(F.col("rank") == F.col("one"), F.col("two")).otherwise(F.col("one"))).when(role == SHORTER, F.col("itself")).otherwise(F.col("one"))
    return rows.select("rank", others.alias("others"), best.alias("best")).filter("others > 0").groupBy("rank").agg(F.sum("others").alias("n_near"), F.min("best").alias("best"))


def roots(links: DataFrame, work: Workspace) -> DataFrame:
    """`links(rank, up)` to (rank, root): a link goes to its link's link until that has none. Links that end at a root leave the loop, so
    the words of a large family never meet at its root."""
    inner = links.select(F.col("rank").alias("up"), F.lit(False).alias("ends"))
    state = work.keep(links.join(inner, "up", "left").select("rank", "up", F.coalesce("ends", F.lit(True)).alias("ends")), "links")
    while not state.filter("NOT ends").isEmpty():
        ahead = state.select(F.col("rank").alias("up"), F.col("up").alias("further"), F.col("ends").alias("last"))
        gone = state.filter("NOT ends").join(ahead, "up").select("rank", F.col("further").alias("up"), F.col("last").alias("ends"))
        state = work.keep(state.filter("ends").unionByName(gone), "links")
    return state.select("rank", F.col("up").alias("root"))


def variants(docs: DataFrame, conf: Spelling = Spelling()) -> DataFrame:
    """`docs(doc_id, text)` to a row a word: word, form, root, n, n_near, form_n."""
    work = Workspace(docs.sparkSession, "spelling")
    vocab = vocabulary(docs, conf, work)
    best = vocab.select(F.col("rank").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    found = vocab.join(near(vocab, conf), "rank", "left").join(best, "best", "left")
    fits = F.col("form_n") >= conf.twice * F.col("n")
    found = work.keep(
        found.select("rank", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), *(F.when(fits, F.col(c)).alias(a) for c, a in (("best", "up"), ("form", "form"), ("form_n", "form_n")))), "forms"
    )
    last = roots(found.filter("up IS NOT NULL").select("rank", "up"), work)
    named = last.join(vocab.select(F.col("rank").alias("root"), F.col("word").alias("last")), "root").select("rank", "last")
    return found.join(named, "rank", "left").select("word", "form", F.coalesce("last", "word").alias("root"), "n", "n_near", "form_n")


#: The same with every pair, for tables of a size that SQL can pair; crc32 is worked out byte by byte.
SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i, list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) t(i)
), steps AS (SELECT list(c ORDER BY i) AS t FROM bits),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
), counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
summed AS (
  SELECT run, n, xor(list_reduce(
      list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
        lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195::BIGINT, CAST(unicode(c) - 64 AS BIGINT)] END))),
      lambda s, b: xor(t[xor(s, b) % 256 + 1], s // 256)), 4294967295) AS h FROM counted, steps
), cut AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, n FROM summed
), vocab AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab),
variants AS (SELECT DISTINCT word, n, i, left(word, i - 1) AS p, substr(word, i + 1) AS s FROM places),
gone AS (SELECT DISTINCT word, n, p || s AS less FROM variants),
pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS m FROM variants a JOIN variants b ON a.i = b.i AND a.p = b.p AND a.s = b.s AND a.word <> b.word
  UNION ALL SELECT g.word, g.n, v.word, v.n FROM gone g JOIN vocab v ON v.word = g.less
  UNION ALL SELECT v.word, v.n, g.word, g.n FROM gone g JOIN vocab v ON v.word = g.less
), best AS (
  SELECT word, any_value(n) AS n, count(*) AS n_near, first(other ORDER BY m DESC, encode(other)) AS other, max(m) AS m FROM pairs GROUP BY word
), forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * v.n THEN other END AS form, CASE WHEN m >= 2 * v.n THEN m END AS form_n FROM vocab v LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS root, form AS up FROM forms
  UNION ALL SELECT w.word, f.word, f.form FROM walk w JOIN forms f ON f.word = w.up
)
SELECT f.word, f.form, w.root, f.n, f.n_near, f.form_n FROM forms f JOIN walk w ON w.word = f.word AND w.up IS NULL
"""
