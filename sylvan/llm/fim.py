"""Fill-in-middle: a text is cut between units into prefix, middle and suffix, and put together in another order.

One table-driven automaton reads the bytes of all texts of a batch, each ended by a byte that UTF-8 doesn't have. Its states say what
the next byte can be: the rest of a code point, the rest of a sentinel, white space that begins a unit or goes on with one. Each
transition emits what it counts: a code point, a unit, a sentinel. Its state depends on a few bytes before it alone (`Scanner.reach`), so a batch is cut
into as many lanes as they have steps, and every lane starts from the state that the bytes before it lead to. The counts of a
text decide its form, and the second pass finds the two cuts among the emitted units.

A unit is white space and the word that follows it, or the white space at the end. Offsets count code points. `restored` rebuilds a text from output and form
alone, in the JVM, and shares nothing with the automaton.

Nulls: a null text is empty; a null doc_id is drawn as if it were written as nothing. An empty text is plain and has no unit. A text that holds a sentinel is plain, so
no output can be misread. Repeated rows give the same output each. An empty table gives no rows. Further columns are ignored but for `carry`."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textkit import SPACE, pieces, releasing, text_bytes
from .work import bounded_batches

#: Ends a text; no byte of UTF-8.
END = 0xFF
#: What a transition emits, in the low byte of a table's entry; the next state is above it.
CHAR, UNIT, SENTINEL = 1, 2, 4


@dataclass(frozen=True)
class Fim:
    """plain: texts in a hundred that stay as they are. spm: of the others, those in a hundred that begin with their suffix. sentinels: before prefix, suffix and middle."""

    seed: int = 42
    plain: int = 50
    spm: int = 80
    sentinels: tuple[str, str, str] = ("<P>", "<S>", "<M>")


class Scanner:
    """The automaton. States: begin of a text, in white space, in a word, in a code point with one to three bytes to come, and one for each true prefix of a sentinel."""

    BEGIN, BLANK, WORD, REST = 0, 1, 2, 3

    def __init__(self, sentinels: tuple[str, ...]):
        marks = [s.encode() for s in sentinels]
        if any(not m or SPACE[list(m)].any() or max(m) > 127 for m in marks):
            raise ValueError("a sentinel must be ASCII without white space")
        begun = sorted({m[:n] for m in marks for n in range(1, len(m))})
        state_of = {p: 6 + i for i, p in enumerate(begun)}
        prefix_of = {v: k for k, v in state_of.items()}
        #: bytes that fix the state: the rest of a code point, or of a sentinel
        self.reach = max(3, *(len(m) - 1 for m in marks))
        self.table = np.zeros((6 + len(begun), 256), np.int64)
        for state in range(len(self.table)):
            for byte in range(256):
                emits, after = CHAR, self.WORD
                if byte == END:
                    self.table[state, byte] = self.BEGIN << 8
                    continue
                if 0x80 <= byte < 0xC0:
                    emits = 0
                    if self.REST < state < self.REST + 3:
                        after = state - 1
                elif byte >= 0xC0:
                    after = self.REST + (byte >= 0xE0) + (byte >= 0xF0)
                elif SPACE[byte]:
                    after = self.BLANK
                else:
                    read = prefix_of.get(state, b"") + bytes([byte])
                    emits |= SENTINEL * any(read.endswith(m) for m in marks)
                    after = next((state_of[read[i:]] for i in range(len(read)) if read[i:] in state_of), self.WORD)
                if state == self.BEGIN or after == self.BLANK and state != self.BLANK:
                    emits |= UNIT
                self.table[state, byte] = after << 8 | emits

    def scan(self, data: np.ndarray) -> np.ndarray:
        """What each byte emits. Lanes run side by side, a table look-up a step."""
        n, flat = len(data), self.table.ravel()
        steps = max(4 * self.reach, int(n**0.5) + 1)
        lanes = -(-n // steps)
        padded = np.full(lanes * steps, END, np.uint8)
        padded[:n] = data
        by_step = np.ascontiguousarray(padded.reshape(lanes, steps).T)
        at = np.zeros(lanes, np.int64)  # all lanes at the begin of a text
        for t in range(steps - self.reach, steps):
            at = flat[at << 8 | by_step[t]] >> 8
        at[1:], at[0] = at[:-1].copy(), self.BEGIN
        at <<= 8
        out, entry = np.empty((steps, lanes), np.uint8), np.empty(lanes, np.int64)
        for t in range(steps):
            np.bitwise_or(at, by_step[t], out=at)
            np.take(flat, at, out=entry)
            out[t] = entry
            np.bitwise_and(entry, ~0xFF, out=at)
        return out.T.ravel()[:n]


def ended(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with an end byte each, and where they begin."""
    rows = np.arange(len(offsets) - 1)
    out = np.empty(len(data) + len(rows), np.uint8)
    text = np.ones(len(out), bool)
    text[offsets[1:] + rows] = False
    out[text], out[~text] = data, END
    return out, offsets + np.arange(len(offsets))


def cuts(scanner: Scanner, data: np.ndarray, offsets: np.ndarray, draws: np.ndarray, conf: Fim):
    """Units a text, form (0 plain, 1 psm, 2 spm), first byte of middle and suffix, code points of prefix and middle."""
    whole, begin = ended(data, offsets)
    emitted, first = scanner.scan(whole), begin[:-1]
    count = lambda what: np.add.reduceat((emitted & what) > 0, first, dtype=np.int64)
    n, marked = count(UNIT), count(SENTINEL)
    low, high = np.sort(draws[:2] % (n + 1), axis=0)
    form = np.where((n == 0) | (marked > 0) | (draws[2] % 100 >= conf.plain), 0, np.where(draws[3] % 100 < conf.spm, 2, 1))
    # second pass: the unit after a cut begins it, and the end of the text comes after the last unit
    units, before = np.flatnonzero(emitted & UNIT), np.cumsum(n) - n
    place = lambda cut: np.where(cut < n, units[np.minimum(before + cut, len(units) - 1)], begin[1:] - 1) if len(units) else first
    middle, suffix = place(low), place(high)
    chars = np.concatenate([[0], np.cumsum(emitted & CHAR, dtype=np.int64)])
    return n, form, middle - first, suffix - first, chars[middle] - chars[first], chars[suffix] - chars[middle]


def transformed(docs: DataFrame, conf: Fim = Fim(), carry: tuple[str, ...] = ()) -> DataFrame:
    """`docs(doc_id, text, *carry)` to `(doc_id, *carry, n, form, prefix_chars, middle_chars, output)`."""
    bounded_batches(docs.sparkSession)
    p, s, m = (x.encode() for x in conf.sentinels)
    names = ["doc_id", *carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(conf.sentinels)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text_"))
            draws = np.stack([batch.column(f"draw{i}_").to_numpy() for i in range(4)])
            for i, j in pieces(offsets):
                own, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                n, form, middle, suffix, before, inside = cuts(scanner, own, at, draws[:, i:j], conf)
                raw, out = own.tobytes(), []
                for a, b, x, y, kind in zip(at[:-1].tolist(), at[1:].tolist(), middle.tolist(), suffix.tolist(), form.tolist(), strict=True):
                    x, y = a + x, a + y
                    if kind == 0:
                        out.append(raw[a:b])
                    elif kind == 1:
                        out.append(b"".join((p, raw[a:x], s, raw[y:b], m, raw[x:y])))
                    else:
                        out.append(b"".join((s, raw[y:b], p, raw[a:x], m, raw[x:y])))
                part, plain = batch.slice(i, j - i), form == 0
                made = [pa.array(n), pa.array(np.array(["plain", "psm", "spm"], object)[form]), pa.array(before, mask=plain), pa.array(inside, mask=plain), pa.array(out, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), *made], [*names, "n", "form", "prefix_chars", "middle_chars", "output"])

    key = F.sha2(F.concat(F.lit(f"{conf.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    draws = [F.conv(F.substring(key, 8 * i + 1, 8), 16, 10).cast("long").alias(f"draw{i}_") for i in range(4)]
    rows = docs.select(*names, F.col("text").alias("text_"), *draws)
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)
    return rows.mapInArrow(releasing(run), f"{kinds}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, conf: Fim = Fim()) -> Column:
    """The text that `output` was made of. Outside plain texts each sentinel occurs once, so what stands between them is exact."""
    p, s, m = conf.sentinels
    between = lambda a, b: F.substring_index(F.substring_index(output, a, -1), b, 1)
    last = F.substring_index(output, m, -1)
    psm = F.concat(between(p, s), last, between(s, m))
    spm = F.concat(between(p, m), last, between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digest(rows: DataFrame, conf: Fim = Fim()) -> DataFrame:
    """The contract's columns of `transformed`'s rows."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    output = F.col("output")
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(output).alias("output_sha256"), sha(restored(output, F.col("form"), conf)).alias("restored_sha256"))


#: The same over DuckDB's own regular expressions, with the default configuration.
SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents
), drawn AS (
  SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
    CAST('0x' || substr(k, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(k, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(k, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(k, 25, 8) AS BIGINT) AS h4 FROM docs
), cut AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn
), parts AS (
  SELECT doc_id, n, form, text, coalesce(array_to_string(units[1:a], ''), '') AS p, coalesce(array_to_string(units[a+1:b], ''), '') AS m, coalesce(array_to_string(units[b+1:], ''), '') AS s FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts
"""
