"""Media columns as baseline JPEG: bytes are stored losslessly as quantised coefficients of a grey image, read back by
parsing markers and Huffman-decoding the scans, and summed up as dimensions and a hash of the DC-only luminance thumbnail.

Writing: byte b of a block becomes coefficient b in zigzag order (the first one as the DC difference); every quantiser
is 1. Frequent bytes of text get small magnitudes, so the entropy coding shrinks text. A restart marker ends every three
blocks (192 bytes), which also makes each such segment independent: the reader decodes the segments of all images of a
batch in step, one symbol of each at a time, for any Huffman tables, components and restart interval; progressive and
arithmetic coding are refused. The byte count is in a comment segment.

Nulls: a null text is empty; an empty text is one unit of blanks. Equal texts have equal values, whatever the row: a null doc_id keeps its row, repeated rows give repeated rows.
Further columns are ignored. An empty table gives no rows."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import U64, pieces, text_bytes
from .work import Workspace

UNIT = 192
BLOCKS = 3
#: Bytes in falling order of use; the others follow in order of value.
FREQUENT = b" enraitshoudlcm.gpb,vfzqk\nEDLSTAIUPMWOHCNRVjwxy\xc3\xa9\xa8\xa0\xbc\xb3"
#: Code lengths for the magnitude categories 1 to 8, in both tables.
LENGTHS = (2, 2, 2, 3, 4, 5, 6, 7)
ROWS_MAX = 65535 // 8


def canonical(symbols: list[tuple[int, int]]) -> dict[int, tuple[int, int]]:
    """symbol -> (code, length) for (symbol, length) in order of length."""
    code, last, out = 0, 0, {}
    for symbol, length in symbols:
        code <<= length - last
        out[symbol] = (code, length)
        code, last = code + 1, length
    return out


def _writer_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each byte: its bits, their number, and its coefficient."""
    order = FREQUENT + bytes(b for b in range(256) if b not in FREQUENT)
    codes = canonical([(k + 1, n) for k, n in enumerate(LENGTHS)])
    bits, length, value = (np.zeros(256, np.int64) for _ in range(3))
    at = 0
    for size in range(1, 9):
        for extra in range(1 << size):
            if at < 256:
                code, n = codes[size]
                b = order[at]
                bits[b], length[b] = code << size | extra, n + size
                value[b] = extra if extra >> (size - 1) else extra - (1 << size) + 1
                at += 1
    return bits, length, value


_BITS, _LENGTH, _VALUE = _writer_tables()
_BYTE = np.full(512, -1, np.int64)
_BYTE[_VALUE + 255] = np.arange(256)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def shape(blocks: int) -> tuple[int, int]:
    """Columns and rows of blocks for an image of at least so many."""
    columns = BLOCKS * max(1, -(-blocks // (BLOCKS * ROWS_MAX)))
    return columns, -(-blocks // columns)


def _header(n: int, blocks: int) -> bytes:
    columns, rows = shape(blocks)
    table = bytes(LENGTHS.count(n) for n in range(1, 17)) + bytes(range(1, len(LENGTHS) + 1))
    return b"".join([
        b"\xff\xd8", _segment(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0"), _segment(0xFE, b"bytes=%d" % n), _segment(0xDB, b"\0" + b"\1" * 64),
        _segment(0xC0, struct.pack(">BHHB", 8, rows * 8, columns * 8, 1) + b"\1\x11\0"), _segment(0xC4, b"\0" + table), _segment(0xC4, b"\x10" + table),
        _segment(0xDD, struct.pack(">H", BLOCKS)), _segment(0xDA, b"\1\1\0\0\x3f\0"),
    ])


def encode(texts: list[bytes]) -> list[bytes]:
    """A JPEG file for each byte string."""
    padded, real = [], []
    for t in texts:
        units = max(1, -(-len(t) // UNIT))
        columns, rows = shape(units * BLOCKS)
        real.append(units)
        padded.append(t.ljust(columns // BLOCKS * rows * UNIT, b" "))
    data = np.frombuffer(b"".join(padded), np.uint8).reshape(-1, UNIT)
    length = _LENGTH[data]
    stop = np.cumsum(length, axis=1)
    width = int(-(-int(stop[:, -1].max()) // 8)) + 4
    out = np.zeros((len(data), width), np.uint8)
    flat, base = out.reshape(-1), np.arange(len(data)) * width
    for k in range(UNIT):
        at = stop[:, k] - length[:, k]
        word = _BITS[data[:, k]] << (32 - length[:, k] - (at & 7))
        byte = base + (at >> 3)
        flat[byte] |= (word >> 24).astype(np.uint8)
        flat[byte + 1] |= (word >> 16 & 255).astype(np.uint8)
        flat[byte + 2] |= (word >> 8 & 255).astype(np.uint8)
    bits = stop[:, -1]
    pad = (-bits) & 7
    flat[base + (bits - 1 >> 3)] |= ((1 << pad) - 1).astype(np.uint8)
    used = np.arange(width) < ((bits + 7) >> 3)[:, None]
    stream = flat[used.reshape(-1)]
    again = 1 + (stream == 255)
    place = np.cumsum(again) - again
    size = np.add.reduceat(again, np.cumsum(used.sum(1)) - used.sum(1)) + 2  # with the restart marker
    begin = np.cumsum(size) - size
    row = np.repeat(np.arange(len(data)), used.sum(1))
    coded = np.zeros(int(size.sum()), np.uint8)
    coded[place + 2 * row] = stream
    marker = begin + size - 2
    coded[marker] = 0xFF
    files, first = [], 0
    for t, p, units in zip(texts, padded, real, strict=True):
        count = len(p) // UNIT
        coded[marker[first : first + count] + 1] = 0xD0 + np.arange(count) % 8
        body = coded[begin[first] : marker[first + count - 1]].tobytes()
        files.append(_header(len(t), units * BLOCKS) + body + b"\xff\xd9")
        first += count
    return files


@dataclass
class Image:
    """What the markers say. components: (id, h, v, quantiser, dc table, ac table)."""

    width: int = 0
    height: int = 0
    comment: bytes = b""
    interval: int = 0
    quantisers: dict[int, np.ndarray] = field(default_factory=dict)
    tables: dict[int, tuple[bytes, bytes]] = field(default_factory=dict)
    components: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    scan: tuple[int, int] = (0, 0)

    def mcus(self) -> tuple[int, int]:
        h, v = max(c[1] for c in self.components), max(c[2] for c in self.components)
        return -(-self.width // (8 * h)), -(-self.height // (8 * v))

    def pattern(self) -> list[int]:
        """The component of each block of an MCU; a scan of one component has one block."""
        return [0] if len(self.components) == 1 else [i for i, c in enumerate(self.components) for _ in range(c[1] * c[2])]


def parse(data: bytes) -> Image:
    if data[:2] != b"\xff\xd8":
        raise ValueError("no JPEG")
    image, at, frame = Image(), 2, []
    while at < len(data):
        marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        body, at = data[at + 4 : at + 2 + size], at + 2 + size
        if marker == 0xC0:
            image.height, image.width, n = struct.unpack(">xHHB", body[:6])
            frame = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
        elif 0xC1 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            raise ValueError("not baseline")
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                image.tables[body[0]] = (body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xDB:
            while body:
                wide = body[0] >> 4
                image.quantisers[body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else "u1").astype(np.int64)
                body = body[65 + 64 * wide :]
        elif marker == 0xDD:
            image.interval = int.from_bytes(body, "big")
        elif marker == 0xFE:
            image.comment = body
        elif marker == 0xDA:
            chosen = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])}
            if len(chosen) != len(frame):
                raise ValueError("one scan with all components is expected")
            image.components = [(*c, chosen[c[0]] >> 4, 16 | chosen[c[0]] & 15) for c in frame]
            end = data.rfind(b"\xff\xd9")
            image.scan = (at, end if end >= 0 else len(data))
            return image
    raise ValueError("no scan")


def lookup(counts: bytes, symbols: bytes) -> np.ndarray:
    """length << 8 | symbol for each 16 bits that begin with a code; length 0 where none does."""
    lengths = [n + 1 for n, c in enumerate(counts) for _ in range(c)]
    out = np.zeros(1 << 16, np.int64)
    for symbol, (code, n) in canonical(list(zip(symbols, lengths, strict=True))).items():
        out[code << (16 - n) : (code + 1) << (16 - n)] = n << 8 | symbol
    return out


def coefficients(files: list[bytes]) -> list[tuple[Image, np.ndarray]]:
    """Each image's parsed markers and its coefficients, a row of 64 in zigzag order for each block of the scan."""
    images = [parse(f) for f in files]
    groups: dict[tuple, list[int]] = {}
    for i, m in enumerate(images):
        groups.setdefault((tuple(sorted(m.tables.items())), tuple(m.components)), []).append(i)
    out: list = [None] * len(files)
    for same in groups.values():
        for i, c in zip(same, _decode([files[i] for i in same], [images[i] for i in same]), strict=True):
            out[i] = (images[i], c)
    return out


def _decode(files: list[bytes], images: list[Image]) -> list[np.ndarray]:
    scans = [np.frombuffer(f, np.uint8)[m.scan[0] : m.scan[1]] for f, m in zip(files, images, strict=True)]
    size = np.fromiter(map(len, scans), np.int64, len(scans))
    data = np.concatenate(scans)
    begin = np.cumsum(size) - size
    after = np.append(data[1:], 0)
    mark = data == 255
    restart = np.flatnonzero(mark & (after >= 0xD0) & (after <= 0xD7))
    keep = np.ones(len(data), bool)
    keep[restart] = keep[restart + 1] = False
    keep[np.flatnonzero(mark[:-1] & (after[:-1] == 0)) + 1] = False
    starts = np.sort(np.concatenate([begin, restart + 2]))
    clean = np.concatenate([data[keep], np.full(16, 255, np.uint8)])
    before = np.cumsum(keep) - keep
    position = before[np.minimum(starts, len(data) - 1)] * 8
    # 64 bits from every byte on
    ahead = np.zeros(len(clean) - 8, U64)
    for k in range(8):
        ahead |= clean[k : len(clean) - 8 + k].astype(U64) << U64(56 - 8 * k)

    pattern = np.asarray(images[0].pattern())
    tables = np.stack([lookup(*images[0].tables[c[k]]) for c in images[0].components for k in (4, 5)])
    owner = np.searchsorted(begin, starts, "right") - 1
    nth = np.arange(len(starts)) - np.searchsorted(starts, begin)[owner]
    total = np.asarray([int(np.prod(m.mcus())) for m in images]) * len(pattern)
    every = np.asarray([m.interval or int(np.prod(m.mcus())) for m in images]) * len(pattern)
    blocks = np.clip(total[owner] - nth * every[owner], 0, every[owner])
    base = (np.cumsum(blocks) - blocks) * 64
    found = np.zeros(int(blocks.sum()) * 64, np.int16)
    seg = np.flatnonzero(blocks > 0)
    position, base, blocks = position[seg], base[seg], blocks[seg]
    k = np.zeros(len(seg), np.int64)
    block = np.zeros(len(seg), np.int64)
    dc = np.zeros((len(seg), len(images[0].components)), np.int64)
    while len(position):
        component = pattern[block % len(pattern)] if len(pattern) > 1 else np.zeros(len(block), np.int64)
        first = k == 0
        bits = ahead[position >> 3] << (position & 7).astype(U64)
        entry = tables[2 * component + ~first, (bits >> U64(48)).astype(np.int64)]
        length, symbol = entry >> 8, entry & 255
        if not length.all():
            raise ValueError("a code that is in no table")
        count = symbol & 15
        extra = ((bits << length.astype(U64)) >> U64(1) >> (63 - count).astype(U64)).astype(np.int64)
        value = np.where(extra >> np.maximum(count - 1, 0), extra, extra - (1 << count) + 1)
        value[count == 0] = 0
        position = position + length + count
        if first.any():
            at = np.flatnonzero(first)
            dc[at, component[at]] += value[at]
            value[at] = dc[at, component[at]]
        end = ~first & (symbol == 0)
        k = k + np.where(first, 0, symbol >> 4)
        put = ~end & (k < 64)
        found[(base + block * 64 + k)[put]] = value[put]
        k = np.where(end, 64, k + 1)
        over = k >= 64
        if over.any():
            block, k = block + over, np.where(over, 0, k)
            going = block < blocks
            if not going.all():
                position, base, blocks, k, block, dc = (x[going] for x in (position, base, blocks, k, block, dc))
    found = found.reshape(-1, 64)
    cut = np.cumsum(total) - total
    return [found[c : c + t] for c, t in zip(cut, total, strict=True)]


def thumbnail(image: Image, found: np.ndarray) -> np.ndarray:
    """Luminance from the first component's DC coefficients, a pixel a block."""
    columns, rows = image.mcus()
    c = image.components[0]
    h, v = (1, 1) if len(image.components) == 1 else c[1:3]
    per = len(image.pattern())
    dc = found[:, 0].astype(np.int64).reshape(rows * columns, per)[:, : h * v].reshape(rows, columns, v, h).swapaxes(1, 2).reshape(rows * v, columns * h)
    return np.clip(dc * int(image.quantisers[c[3]][0]) // 8 + 128, 0, 255).astype(np.uint8)


def thumbnail_hash(pixels: np.ndarray) -> int:
    """64 bits: whether each cell of an 8 x 8 grid over the thumbnail is above the mean of the cells."""
    rows, columns = (np.arange(8) * n // 8 for n in pixels.shape)
    rows_to, columns_to = (np.maximum(np.arange(1, 9) * n // 8, a + 1) for n, a in zip(pixels.shape, (rows, columns), strict=True))
    total = np.zeros((pixels.shape[0] + 1, pixels.shape[1] + 1), np.int64)
    total[1:, 1:] = pixels.astype(np.int64).cumsum(0).cumsum(1)
    area = (rows_to - rows)[:, None] * (columns_to - columns)
    cell = (total[rows_to][:, columns_to] - total[rows][:, columns_to] - total[rows_to][:, columns] + total[rows][:, columns]) / area
    return int.from_bytes(np.packbits(cell > cell.mean()).tobytes(), "big")


def payload(image: Image, found: np.ndarray) -> tuple[int, bytes]:
    """The byte count that was stored, and the padded bytes."""
    n = int(image.comment.removeprefix(b"bytes="))
    value = found.astype(np.int64)
    first = value[:, 0].copy()
    follows = np.arange(len(first)) % BLOCKS > 0
    first[follows] -= value[:-1, 0][follows[1:]]
    value[:, 0] = first
    raw = _BYTE[value + 255].astype(np.uint8).tobytes()
    return n, raw[: max(1, -(-n // UNIT)) * UNIT]


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for i, j in pieces(offsets, 2 << 20):
            files = encode([data[offsets[r] : offsets[r + 1]].tobytes() for r in range(i, j)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id")[i:j], pa.array(files, pa.binary())], ["doc_id", "media"])


_FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, width long, height long, thumbnail binary, feature string"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        media = batch.column("media").cast(pa.large_binary())
        offsets = np.concatenate([[0], np.cumsum(np.asarray(pa.compute.binary_length(media)))])
        for i, j in pieces(offsets, 1 << 20):
            files, rows = media[i:j].to_pylist(), []
            for f, (image, found) in zip(files, coefficients(files), strict=True):
                n, raw = payload(image, found)
                pixels = thumbnail(image, found)
                rows.append((
                    n, len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-16:]), len(f), hashlib.sha256(f).hexdigest(), image.width, image.height, pixels.tobytes(),
                    f"{image.width}x{image.height}:{thumbnail_hash(pixels):016x}",
                ))
            names = [c.split()[0] for c in _FEATURES.split(", ")]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id")[i:j], *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True))], names)


def media(docs: DataFrame) -> DataFrame:
    """`docs(doc_id, text)` to `(doc_id, media)`, written to the shared folder and read again."""
    work = Workspace(docs.sparkSession, "jpeg")
    return work.keep(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_store, "doc_id long, media binary"), "media")


def features(stored: DataFrame) -> DataFrame:
    """`stored(doc_id, media)` to dimensions, payload digests, thumbnails and their hashes."""
    return stored.select("doc_id", "media").mapInArrow(_read, _FEATURES)
