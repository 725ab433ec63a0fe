"""Concatenate and cut: documents become token ids once, prefix sums over the partitions' totals give every document its
place in one long row of tokens, and windows of fixed length are cut from it.

The ids are written in a first pass with their offset inside the partition, so the second pass needs one number a
partition and neither moves nor tokenizes a text again. Pieces record whether they begin or end their document.

Nulls: a null text is empty and still gives the closing id; a null doc_id keeps its pieces. Repeated rows are packed as
often as they occur. Further columns are ignored. An empty table gives no rows."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .textkit import releasing
from .work import Workspace


def _default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@dataclass(frozen=True)
class Packing:
    """window: tokens in a sequence. closing: the id after each document. vocabulary: a tokenizers file, by default the
    installed byte-level one. broadcast: partitions at most whose totals
    are broadcast (16 bytes each); beyond that they are joined."""

    window: int = 2048
    closing: int = 1
    vocabulary: str | None = None
    broadcast: int = 1_000_000


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable bytes stand for themselves, the
    others for the code points from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


#: Fixed value: how a byte-level vocabulary splits a text before its merges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Ids of whole texts as `tokenizers` gives them by default: a special token's string in a text is that token.

    A plain byte-level vocabulary whose merges stand in order of their ids is also one of ranked byte pairs; those are
    merged by `tiktoken`, which gives the same ids for a quarter of the time. Texts with the string of an added token, and all
    texts of vocabularies of another kind, go to `tokenizers` itself."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids need more than 16 bits")
        with open(vocabulary, encoding="utf-8") as f:
            known = json.load(f)
        self.added = [t["content"] for t in known.get("added_tokens", [])]
        self.ranked = self._ranked(known)

    def _ranked(self, known: dict):
        """The vocabulary as ranked byte pairs, or None where it is more than that."""
        model, byte = known["model"], _byte_of()
        split = known.get("pre_tokenizer") or {}
        plain = known.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)
        odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
        if not plain or model.get("type") != "BPE" or any(model.get(k) for k in odd):
            return None
        own = {t: i for t, i in model["vocab"].items() if t not in self.added}
        pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        made = [own.get(a + b, -1) for a, b in pairs]
        single = len(own) - len(made) == 256 and all(c in own for c in byte)
        if not single or any(a >= b for a, b in zip(made, made[1:], strict=False)) or max(own[c] for c in byte) > made[0]:
            return None
        import tiktoken

        return tiktoken.Encoding("ranked", pat_str=SPLIT, mergeable_ranks={bytes(byte[c] for c in t): i for t, i in own.items()}, special_tokens={})

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def __call__(self, text: str) -> bytes:
        if self.ranked is None or any(t in text for t in self.added):
            return self.whole(text)
        return np.asarray(self.ranked.encode_ordinary(text), "<u2").tobytes()


def _tokenize(conf: Packing):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(conf.vocabulary or _default_vocabulary())
        closing = np.asarray([conf.closing], "<u2").tobytes()
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column("text")
            for i in range(0, batch.num_rows, 512):
                ids = [encoder(t or "") + closing for t in texts[i : i + 512].to_pylist()]
                count = np.fromiter(map(len, ids), np.int64, len(ids)) // 2
                starts = before + np.cumsum(count) - count
                before += int(count.sum())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[i : i + 512], pa.array(np.full(len(ids), part)), pa.array(starts), pa.array(count), pa.array(ids, pa.binary())],
                    ["doc_id", "part", "before", "n", "ids"],
                )

    return run


_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, begins boolean, ends boolean"


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, count = (np.asarray(batch.column(c)) for c in ("place", "n"))
            ids, crc = batch.column("ids"), []
            pieces = (place + count - 1) // window - place // window + 1
            row = np.repeat(np.arange(len(place)), pieces)
            k = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first = np.maximum(place[row], (place[row] // window + k) * window)
            stop = np.minimum(place[row] + count[row], (place[row] // window + k + 1) * window)
            start, length = first - place[row], stop - first
            at = -1
            for r, s, n in zip(row.tolist(), start.tolist(), length.tolist(), strict=True):
                if r != at:
                    at, wide = r, np.frombuffer(ids[r].as_buffer(), "<u2").astype("<u4")
                crc.append(zlib.crc32(wide[s : s + n]))
            doc = batch.column("doc_id").take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [doc, *map(pa.array, (start, length, np.asarray(crc, np.int64), count[row], first // window, first % window, start == 0, start + length == count[row]))],
                [c.split()[0] for c in _PIECE.split(", ")],
            )

    return run


def packed(docs: DataFrame, conf: Packing = Packing()) -> DataFrame:
    """`docs(doc_id, text)` to one row a piece."""
    work = Workspace(docs.sparkSession, "packing")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ids = work.keep(docs.mapInArrow(releasing(_tokenize(conf)), "doc_id long, part long, before long, n long, ids binary"), "ids")
    totals = work.keep(ids.groupBy("part").agg(F.sum("n").alias("total")), "totals", 1)
    earlier = F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = totals.select("part", earlier.alias("base"))
    if totals.count() <= conf.broadcast:
        bases = F.broadcast(bases)
    placed = ids.join(bases, "part").select("doc_id", (F.col("base") + F.col("before")).alias("place"), "n", "ids")
    return placed.mapInArrow(_cut(conf.window), _PIECE)
