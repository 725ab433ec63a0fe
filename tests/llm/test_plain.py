"""Operators against plain programs that share nothing with them: a bit-by-bit JPEG decoder, rounding by its definition, and the
pipeline as a whole."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF
from sylvan.llm import jpeg, mixing, queries, toxicity
from test_methods import brute_components, plain_ids


def decode(data):
    """(width, height, DC values in order) of a grey baseline JPEG, one bit at a time."""
    at, tables, interval = 2, {}, 0
    while True:
        marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xC0:
            height, width = (int.from_bytes(body[k : k + 2], "big") for k in (1, 3))
        elif marker == 0xC4:
            codes, code, symbols = {}, 0, iter(body[17:])
            for length in range(1, 17):
                for _ in range(body[length]):
                    codes[length, code] = next(symbols)
                    code += 1
                code <<= 1
            tables[body[0]] = codes
        elif marker == 0xDD:
            interval = int.from_bytes(body, "big")
        elif marker == 0xDA:
            break
    segments, part = [], bytearray()
    while True:
        byte, after = data[at], data[at + 1]
        if byte == 0xFF and after == 0:
            part.append(0xFF)
            at += 2
        elif byte == 0xFF and (0xD0 <= after <= 0xD7 or after == 0xD9):
            segments.append(bytes(part))
            part, at = bytearray(), at + 2
            if after == 0xD9:
                break
        else:
            part.append(byte)
            at += 1
    dc, left = [], width // 8 * (height // 8)
    for segment in segments:
        bits = iter("".join(f"{b:08b}" for b in segment))

        def symbol(codes, bits=bits):
            length = code = 0
            while (length, code) not in codes or not length:
                length, code = length + 1, code << 1 | int(next(bits))
            return codes[length, code]

        def number(size, bits=bits):
            value = int("0" + "".join(next(bits) for _ in range(size)), 2)
            return value if not size or value >> (size - 1) else value - (1 << size) + 1

        last = 0
        for _ in range(min(interval or left, left)):
            last += number(symbol(tables[0]))
            dc.append(last)
            k = 1
            while k < 64:
                both = symbol(tables[16])
                if not both:
                    break
                k += (both >> 4) + 1
                number(both & 15)
        left -= min(interval or left, left)
    assert not left
    return width, height, dc


def test_features_equal_a_plain_decoder(spark):
    texts = [None, "", "a", "words and words " * 40, "ÿé😀\x00\x7f" * 60, "Zz" * 700, "\n".join(f"line {i}" for i in range(300))]
    stored = jpeg.media(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    files = {r.doc_id: bytes(r.media) for r in stored.collect()}
    for r in jpeg.features(stored).collect():
        data = files[r.doc_id]
        width, height, dc = decode(data)
        columns, rows = width // 8, height // 8
        pixels = [[min(255, max(0, math.floor(dc[y * columns + x] / 8) + 128)) for x in range(columns)] for y in range(rows)]
        spans = lambda n: [(i * n // 8, max((i + 1) * n // 8, i * n // 8 + 1)) for i in range(8)]
        cells = [[p for row in pixels[a:b] for p in row[c:d]] for a, b in spans(rows) for c, d in spans(columns)]
        means = [sum(c) / len(c) for c in cells]
        bits = "".join("1" if m > sum(means) / 64 else "0" for m in means)
        raw = (texts[r.doc_id] or "").encode()
        padded = raw.ljust(max(1, -(-len(raw) // 192)) * 192)
        assert (r.width, r.height, bytes(r.thumbnail)) == (width, height, bytes(p for row in pixels for p in row))
        assert r.feature == f"{width}x{height}:{int(bits, 2):016x}" and r.tail_crc32 == zlib.crc32(padded[-16:])
        assert (r.media_bytes, r.media_sha256) == (len(data), hashlib.sha256(data).hexdigest()) and r.payload_sha256 == hashlib.sha256(padded).hexdigest()


def test_copies_are_a_rounding_of_what_is_due(spark):
    texts = [(i, " ".join(["w"] * (1 + i * 7 % 40)), "abc"[min(i % 5, 2)]) for i in range(120)]
    frame = spark.createDataFrame(texts, "doc_id long, text string, source string")
    sums, runs = Counter(), 12
    for seed in range(runs):
        got = mixing.mixed(frame, mixing.Mixing(block=16, fan=4, seed=seed)).collect()
        for r in got:
            due = r.target / r.source_size
            assert r.copies in (math.floor(due + 1e-9), math.ceil(due - 1e-9)) and r.taken == r.copies * r["size"]
            sums[r.doc_id] += r.copies - due
        for source in "abc":
            own = [r for r in got if r.source == source]
            assert abs(sum(r.taken for r in own) - own[0].target) < 40
    # what the rounding adds or takes evens out over seeds
    assert abs(sum(sums.values())) < 0.1 * runs * len(texts) and max(map(abs, sums.values())) <= 0.95 * runs


def test_pipeline_from_end_to_end(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rejected = {r.doc_id for r in toxicity.scored(docs, model).filter("predicted = 1").collect()}
    texts = {i: t for i, t in texts.items() if i not in rejected}
    kept = {i for i, (_, c) in brute_components(texts, 5).items() if i == c}
    plain = re.compile("AKIA[A-Z0-9]{12,}|[0-9a-f]{32,}")
    got = corpus_pipeline.run(spark, SF).collect()
    pieces, begun = Counter(), Counter()
    for r in got:
        assert r.doc_id in kept
        pieces[r.doc_id] += r.length
        begun[r.doc_id] += r.begins
    assert all(pieces[i] == begun[i] * {r.doc_id: r.doc_tokens for r in got}[i] and begun[i] <= 3 for i in pieces)
    tokens = {r.doc_id: r.doc_tokens for r in got}
    clean = [i for i in tokens if not plain.search(texts[i]) and not re.search("(?i)password|passwd|secret|token|api_?key|id", texts[i])]
    assert len(clean) > 20 and all(tokens[i] == len(plain_ids(texts[i])) + 1 for i in clean)
    ends = Counter()
    for r in got:
        ends[r.sequence_id] = max(ends[r.sequence_id], r.offset + r.length)
    assert all(n == 2048 for s, n in ends.items() if s != max(ends))


@pytest.mark.parametrize("name", ["op6_mixing", "op9_jpeg"])
def test_part_of_a_query_equals_sql(spark, duck, name):
    """The columns that SQL can express."""
    sql = {
        "op6_mixing": "SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size, sum(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))) OVER (PARTITION BY source) AS source_size FROM documents",
        "op9_jpeg": "SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes, greatest(1, ceil(strlen(coalesce(text, '')) / 192)) * 192 AS payload_bytes, sha256(coalesce(text, '') || repeat(' ', CAST(greatest(1, ceil(strlen(coalesce(text, '')) / 192)) * 192 - strlen(coalesce(text, '')) AS BIGINT))) AS payload_sha256 FROM documents",
    }[name]
    found = duck.execute(sql)
    columns = [c[0] for c in found.description]
    want = sorted(tuple(int(v) if isinstance(v, float) else v for v in row) for row in found.fetchall())
    assert sorted(tuple(r) for r in queries.queries()[name](spark, SF).select(*map(F.col, columns)).collect()) == want


def test_toxicity_scores_are_those_of_a_plain_forward_pass():
    """Word by word and window by window, in plain loops: the network's log-odds, the highest window and the calibration."""
    from sylvan.llm import toxicity
    from sylvan.llm.textkit import text_bytes

    rng = np.random.default_rng(3)
    names = [f"word{i}" for i in range(60)]
    texts = [" ".join(rng.choice(names, n)) for n in rng.integers(0, 90, 40)] + ["", "vile"]
    labels = np.array([float("word7 " in t + " ") for t in texts])
    conf = toxicity.Toxicity(rounds=1, passes=1)
    net = toxicity.fit(texts, labels, conf)
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def direction(rows, way):
        p, h, state, out = net.weights, conf.hidden, np.zeros(conf.hidden), []
        for x in rows:
            lifted, back = x @ p["W" + way] + p["b" + way], state @ p["U" + way]
            z, r = sigmoid(lifted[:h] + back[:h]), sigmoid(lifted[h : 2 * h] + back[h : 2 * h])
            state = z * state + (1 - z) * np.tanh(lifted[2 * h :] + r * back[2 * h :])
            out.append(state)
        return out

    def plain(text):
        data, offsets = text_bytes(pa.array([text], pa.large_string()))
        bucket, grams, per, place, count = toxicity.vocabulary(data, offsets, conf)
        cut, rows = np.cumsum(per) - per, []
        for i, b in enumerate(bucket):
            own = grams[cut[i] : cut[i] + per[i]]
            rows.append(np.concatenate([[net.word_evidence[b], net.gram_evidence[own].max()], net.words[b], net.grams[own].mean(0)]).astype(np.float64))
        words, best = [rows[i] for i in place], -np.inf
        for at in range(0, max(1, len(words) - conf.window + conf.step), conf.step):
            some = words[at : at + conf.window]
            if not some:
                best = max(best, float(net.weights["c"][0]))
                continue
            states = [np.concatenate(pair) for pair in zip(direction(some, "f"), direction(some[::-1], "b")[::-1], strict=True)]
            score = np.array([np.tanh(s @ net.weights["A"]) @ net.weights["v"] for s in states])
            share = np.exp(score - score.max())
            best = max(best, float((share / share.sum()) @ np.array(states) @ net.weights["w"] + net.weights["c"][0]))
        return sigmoid(net.scale[0] * best + net.scale[1])

    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    assert net.score(data, offsets) == pytest.approx([plain(t) for t in texts], abs=1e-4)
