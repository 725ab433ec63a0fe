"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs, in numpy.

A text is scored as a whole: every window of `window` words, overlapping by half, goes through the network, and the
highest window decides. A word's input is its hashed embedding and its evidence, and the mean of the embeddings and the
greatest evidence of its character n-grams; so an unknown form of a known stem is recognised. Evidence is the smoothed
log-odds of a label's documents, counted in the training sample; in training, a document's own count is left out.
Training takes each document's highest window in turn (a label holds for the document, not for all its windows), and
ends with a logistic calibration of the documents' highest windows.

The model is fitted by one task on at most `sample` labelled documents of `sample_bytes` in all, chosen by a hash of doc_id; a
document that doesn't fit into what is left of the bytes is passed over, and of several texts of a doc_id one counts. All else
covers every row.
Nulls: a null text is empty; an empty text has one window without words and a score of its own. A null label counts as
no label; of several labels of a doc_id the greatest counts. A null doc_id is never held out. Without a label of each kind all
scores are the share of label 1, or 0 without labels. Repeated rows are scored alike. Further columns are ignored. An empty table gives no rows."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import LOWER, U64, mix, pieces, releasing, text_bytes, word_hashes, words

#: ASCII other than letters and digits separates words here; other bytes belong to letters.
BREAK = np.ones(256, bool)
BREAK[128:] = False
for _first, _last in ((48, 57), (65, 90), (97, 122)):
    BREAK[_first : _last + 1] = False


@dataclass(frozen=True)
class Toxicity:
    """sample, sample_bytes: labelled documents that are fitted, at most, and bytes of their texts. step: words between windows. grams: n-gram lengths in bytes. rounds:
    choices of the highest windows, each followed by `passes` over them."""

    sample: int = 2500
    sample_bytes: int = 32 << 20
    window: int = 32
    step: int = 16
    hidden: int = 8
    width: int = 4
    grams: tuple[int, ...] = (3, 4, 5)
    word_bits: int = 16
    gram_bits: int = 17
    rounds: int = 4
    passes: int = 3
    batch: int = 64
    rate: float = 0.02
    folds: int = 5
    seed: int = 5


def vocabulary(data: np.ndarray, offsets: np.ndarray, conf: Toxicity):
    """The distinct words of the texts as (bucket, n-gram buckets, grams a word), each place's word, and words a text."""
    data = LOWER[data]
    starts, ends, count = words(data, offsets, BREAK)
    hashes = word_hashes(data, starts, ends)
    distinct, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    bucket = (distinct >> U64(64 - conf.word_bits)).astype(np.int64)
    length = (ends - starts)[first] + 2
    begin = np.cumsum(length) - length
    marked = np.zeros(int(length.sum()), np.uint8)  # words side by side, each between two zero bytes
    inner = np.arange(len(marked)) - np.repeat(begin, length)
    body = (inner > 0) & (inner < np.repeat(length, length) - 1)
    marked[body] = data[(np.repeat(starts[first], length) + inner - 1)[body]]
    # n-grams of growing length from every byte on; in rows by byte they come out in order of the word
    left = np.repeat(length, length) - inner
    tail = np.concatenate([marked, np.zeros(max(conf.grams), np.uint8)])
    found, inside = np.empty((len(marked), len(conf.grams)), np.int32), left[:, None] >= np.asarray(conf.grams)
    h, n = np.zeros(len(marked), U64), 0
    with np.errstate(over="ignore"):
        for column, size in enumerate(conf.grams):
            for n in range(n, size):
                h = h * U64(0x100000001B3) + tail[n : n + len(marked)] + U64(1)
            n = size
            found[:, column] = mix(h + U64(size)) >> U64(64 - conf.gram_bits)
    per = np.add.reduceat(inside.sum(1), begin) if len(begin) else np.zeros(0, np.int64)
    return bucket, found[inside], per, place, count


def windows(place: np.ndarray, count: np.ndarray, conf: Toxicity) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all windows, -1 past a text's end, and the text of each window."""
    number = np.maximum(1, -(-(count - conf.window) // conf.step) + 1)
    text = np.repeat(np.arange(len(count)), number)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    offset = np.cumsum(count) - count
    inside = nth[:, None] * conf.step + np.arange(conf.window)
    out = np.full(inside.shape, -1, np.int64)
    real = inside < count[text][:, None]
    out[real] = place[(offset[text][:, None] + inside)[real]]
    return out, text


def evidence(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Log-odds of the documents with a feature, drawn to 0 where few have it."""
    toxic, clean = np.maximum(toxic, 0), np.maximum(clean, 0)
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    return (odds * (toxic + clean) / (toxic + clean + 4) / 2).astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def alone(table: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of `table` that `index` names, and its last one, with the index into them: a step costs what it holds."""
    used, local = np.unique(index, return_inverse=True)
    return np.concatenate([table[used[used >= 0]], table[-1:]]), local.reshape(index.shape) - (used[0] < 0)


@dataclass
class Network:
    conf: Toxicity
    words: np.ndarray
    grams: np.ndarray
    word_evidence: np.ndarray
    gram_evidence: np.ndarray
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    scale: tuple[float, float] = (1.0, 0.0)

    @classmethod
    def fresh(cls, conf: Toxicity) -> Network:
        rng = np.random.default_rng(conf.seed)
        draw = lambda *shape, s=0.3: (rng.standard_normal(shape) * s).astype(np.float32)
        h, d = conf.hidden, 2 * conf.width + 2
        weights = {f"{k}{way}": draw(*shape) for way in "fb" for k, shape in (("W", (d, 3 * h)), ("U", (h, 3 * h)))}
        weights |= {f"b{way}": np.zeros(3 * h, np.float32) for way in "fb"}
        weights |= {"A": draw(2 * h, h), "v": draw(h), "w": draw(2 * h), "c": np.full(1, -1, np.float32)}
        zero = lambda bits: np.zeros(1 << bits, np.float32)
        return cls(conf, draw(1 << conf.word_bits, conf.width, s=0.1), draw(1 << conf.gram_bits, conf.width, s=0.1), zero(conf.word_bits), zero(conf.gram_bits), weights)

    def inputs(self, bucket, grams, per, tables=None) -> np.ndarray:
        """A row for each distinct word, and one of zeros."""
        by_word, by_gram = tables or (self.word_evidence, self.gram_evidence)
        out = np.zeros((len(bucket) + 1, 2 * self.conf.width + 2), np.float32)
        out[:-1, 0], out[:-1, 2 : 2 + self.conf.width] = by_word[bucket], self.words[bucket]
        begin = np.cumsum(per) - per
        for a in range(0, len(per), 1 << 15):
            some = a + np.flatnonzero(per[a : a + (1 << 15)])
            if len(some):
                own = grams[begin[some[0]] : begin[some[-1]] + per[some[-1]]]
                cut = begin[some] - begin[some[0]]
                out[some, 1] = np.maximum.reduceat(by_gram[own], cut)
                out[some, 2 + self.conf.width :] = np.add.reduceat(self.grams[own], cut) / per[some][:, None]
        return out

    def forward(self, table: np.ndarray, index: np.ndarray, trace: bool = False):
        """Logits of windows of rows of `table`; with `trace` all that `backward` needs."""
        p, h = self.weights, self.conf.hidden
        n, steps = index.shape
        real = index >= 0
        states = np.zeros((n, steps, 2 * h), np.float32)
        kept = {}
        for way, part, order in (("f", slice(0, h), range(steps)), ("b", slice(h, 2 * h), range(steps - 1, -1, -1))):
            lifted = table @ p["W" + way] + p["b" + way]
            state = np.zeros((n, h), np.float32)
            for t in order:
                x, from_state = lifted[index[:, t]], state @ p["U" + way]
                gates = sigmoid(x[:, : 2 * h] + from_state[:, : 2 * h])
                z, r = gates[:, :h], gates[:, h:]
                new = np.tanh(x[:, 2 * h :] + r * from_state[:, 2 * h :])
                after = np.where(real[:, t : t + 1], new + z * (state - new), state)
                if trace:
                    kept[way, t] = (state, z, r, new, from_state[:, 2 * h :])
                states[:, t, part] = state = after
        deep = np.tanh(states @ p["A"])
        score = np.where(real, deep @ p["v"], -np.float32(1e9))
        share = np.exp(score - score.max(1, keepdims=True)) * real
        share /= np.maximum(share.sum(1, keepdims=True), np.float32(1e-9))
        pooled = np.einsum("nt,nth->nh", share, states)
        logit = pooled @ p["w"] + p["c"][0]
        return (logit, (index, real, states, deep, share, pooled, kept)) if trace else logit

    def backward(self, table: np.ndarray, traced, d_logit: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the weights and of the rows of `table`."""
        p, h = self.weights, self.conf.hidden
        index, real, states, deep, share, pooled, kept = traced
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["w"], g["c"][0] = pooled.T @ d_logit, d_logit.sum()
        d_pooled = d_logit[:, None] * p["w"]
        d_states = share[:, :, None] * d_pooled[:, None, :]
        d_share = np.einsum("nh,nth->nt", d_pooled, states)
        d_score = share * (d_share - (share * d_share).sum(1, keepdims=True))
        g["v"] = np.einsum("nt,nth->h", d_score, deep)
        d_deep = d_score[:, :, None] * p["v"] * (1 - deep**2)
        g["A"] = np.einsum("nth,ntk->hk", states, d_deep)
        d_states += d_deep @ p["A"].T
        d_table = np.zeros_like(table)
        for way, part, order in (("f", slice(0, h), range(index.shape[1] - 1, -1, -1)), ("b", slice(h, 2 * h), range(index.shape[1]))):
            carried = np.zeros((len(index), h), np.float32)
            for t in order:
                state, z, r, new, inner = kept[way, t]
                d = d_states[:, t, part] + carried
                live = real[:, t : t + 1]
                held, d = np.where(live, 0, d), np.where(live, d, 0)
                d_new = d * (1 - z) * (1 - new**2)
                d_gate = np.concatenate([d * (state - new) * z * (1 - z), d_new * inner * r * (1 - r)], axis=1)
                d_x = np.concatenate([d_gate, d_new], axis=1)
                d_u = np.concatenate([d_gate, d_new * r], axis=1)
                g["U" + way] += state.T @ d_u
                g["b" + way] += d_x.sum(0)
                g["W" + way] += table[index[:, t]].T @ d_x
                np.add.at(d_table, index[:, t], d_x @ p["W" + way].T)
                carried = held + d * z + d_u @ p["U" + way].T
        return g, d_table

    def highest(self, table: np.ndarray, index: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Each text's highest logit and the window that has it."""
        logit = np.concatenate([self.forward(*alone(table, index[k : k + 4096])) for k in range(0, len(index), 4096)])
        order = np.lexsort((logit, text))
        last = order[np.searchsorted(text[order], np.arange(n), "right") - 1]
        return logit[last], last

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        bucket, grams, per, place, count = vocabulary(data, offsets, self.conf)
        index, text = windows(place, count, self.conf)
        high, _ = self.highest(self.inputs(bucket, grams, per), index, text, len(count))
        return sigmoid(self.scale[0] * high.astype(np.float64) + self.scale[1])


def fit(texts: list[str], labels: np.ndarray, conf: Toxicity) -> Network | float:
    """A network, or the share of label 1 where only one kind of label is there."""
    labels = np.asarray(labels, np.float32)
    if len(set(labels.tolist())) < 2:
        return float(labels.mean()) if len(labels) else 0.0
    rng = np.random.default_rng(conf.seed)
    net = Network.fresh(conf)
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    bucket, grams, per, place, count = vocabulary(data, offsets, conf)
    index, text = windows(place, count, conf)
    # documents of each label that have a word or an n-gram
    gram_begin = np.cumsum(per) - per
    by_word, by_gram = np.zeros((2, 1 << conf.word_bits)), np.zeros((2, 1 << conf.gram_bits))
    for d, (a, n) in enumerate(zip(np.cumsum(count) - count, count, strict=True)):
        own = np.unique(place[a : a + n])
        by_word[int(labels[d]), np.unique(bucket[own])] += 1
        if len(own):
            by_gram[int(labels[d]), np.unique(np.concatenate([grams[gram_begin[u] : gram_begin[u] + per[u]] for u in own]))] += 1
    n1, n0 = int(labels.sum()), int((1 - labels).sum())
    net.word_evidence, net.gram_evidence = evidence(by_word[1], by_word[0], n1, n0), evidence(by_gram[1], by_gram[0], n1, n0)
    less = lambda y: tuple(evidence(x[1] - y, x[0] - (1 - y), n1 - y, n0 - (1 - y)) for x in (by_word, by_gram))
    without = {y: less(y) for y in (0, 1)}

    size = len(bucket) + 1
    # one table of inputs for documents of either label, each without the document's own count
    table_of = lambda: np.concatenate([net.inputs(bucket, grams, per, without[y]) for y in (0, 1)])
    shifted = np.where(index >= 0, index + (labels[text][:, None] == 1) * size, -1)
    weight = np.where(labels == 1, np.float32(min(4.0, n0 / n1)), np.float32(1))
    mean, square = ({k: np.zeros_like(v) for k, v in net.weights.items()} for _ in range(2))
    turn = 0
    adapt_word, adapt_gram = np.full(net.words.shape, 1e-3, np.float32), np.full(net.grams.shape, 1e-3, np.float32)

    def adjust(rows: np.ndarray, seen: np.ndarray, at: np.ndarray, d: np.ndarray) -> None:
        """An Adagrad step for the rows that occur."""
        which, place = np.unique(at, return_inverse=True)
        total = np.zeros((len(which), rows.shape[1]), np.float32)
        np.add.at(total, place, d)
        seen[which] += total**2
        rows[which] -= conf.rate * total / np.sqrt(seen[which])

    for _ in range(conf.rounds):
        table = table_of()  # inputs follow the embeddings once a round
        _, top = net.highest(table, shifted, text, len(labels))
        order = np.concatenate([rng.permutation(len(labels)) for _ in range(conf.passes)])
        for some in np.array_split(order, max(1, len(order) // conf.batch)):
            used = np.unique(shifted[top[some]])
            near, local = alone(table, shifted[top[some]])
            logit, traced = net.forward(near, local, True)
            d_logit = ((sigmoid(logit) - labels[some]) * weight[some] / len(some)).astype(np.float32)
            g, d_near = net.backward(near, traced, d_logit)
            turn += 1
            for k, v in net.weights.items():
                mean[k] = 0.9 * mean[k] + 0.1 * g[k]
                square[k] = 0.99 * square[k] + 0.01 * g[k] ** 2
                v -= conf.rate * (mean[k] / (1 - 0.9**turn)) / (np.sqrt(square[k] / (1 - 0.99**turn)) + 1e-6) + conf.rate * 1e-3 * v
            hit, d_in = used[used >= 0] % size, d_near[:-1]
            adjust(net.words, adapt_word, bucket[hit], d_in[:, 2 : 2 + conf.width])
            n = per[hit]
            within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            adjust(net.grams, adapt_gram, grams[np.repeat(gram_begin[hit], n) + within], np.repeat(d_in[:, 2 + conf.width :] / np.maximum(n, 1)[:, None], n, axis=0))
    high, _ = net.highest(table_of(), shifted, text, len(labels))
    net.scale = calibrate(high.astype(np.float64), labels)
    return net


def calibrate(logit: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic regression, by Newton steps with a slight pull to slope 1."""
    a, b = 1.0, 0.0
    for _ in range(50):
        q = sigmoid(a * logit + b)
        s = q * (1 - q) + 1e-6
        grad = np.array([((q - labels) * logit).sum() + (a - 1), (q - labels).sum() + 0.01 * b])
        hess = np.array([[(s * logit * logit).sum() + 1, (s * logit).sum()], [(s * logit).sum(), s.sum() + 0.01]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return float(max(a, 0.05)), float(b)


def held_out(conf: Toxicity):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % conf.folds == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, conf: Toxicity = Toxicity()) -> Network | float:
    """Fit on labelled rows outside the held-out fold."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(conf))
    rows = rows.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = rows.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    chosen = chosen.orderBy(F.xxhash64("doc_id", F.lit(conf.seed)), "doc_id").limit(conf.sample)
    # at most `sample` rows of 12 bytes, and then of 28
    ids = docs.sparkSession.createDataFrame(chosen.toPandas(), "doc_id long, toxic int")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    sizes = own.select("doc_id", F.struct("h", F.octet_length("text").alias("size")).alias("s")).join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(F.min("s").alias("s"))
    left, taken = conf.sample_bytes, []
    for r in sizes.select("doc_id", "toxic", "s.*").orderBy(F.xxhash64("doc_id", F.lit(conf.seed)), "doc_id").collect():
        if r["size"] <= left:
            left -= r["size"]
            taken.append((r["doc_id"], r["h"], r["toxic"]))
    taken = docs.sparkSession.createDataFrame(taken, "doc_id long, h long, toxic int")
    picked = own.join(F.broadcast(taken), ["doc_id", "h"]).dropDuplicates(["doc_id"]).select("doc_id", "text", "toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((row for batch in batches for row in batch.to_pylist()), key=lambda r: r["doc_id"])
        model = fit([r["text"] for r in rows], np.asarray([r["toxic"] for r in rows]), conf)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    # the sample is bounded, so one task fits it; the driver holds the model alone
    model = picked.repartition(1).mapInArrow(releasing(run), "model binary").first()
    return fit([], np.zeros(0), conf) if model is None else pickle.loads(model[0])


def scored(docs: DataFrame, model: Network | float, conf: Toxicity = Toxicity(), carry: tuple[str, ...] = ()) -> DataFrame:
    """`docs(doc_id, text, *carry)` to `(doc_id, *carry, score, predicted)`; a carried text must be among `carry`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text_"))
            for i, j in pieces(offsets, 2 << 20):
                net = shared.value
                score = net.score(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) if isinstance(net, Network) else np.full(j - i, net)
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], [*names, "score", "predicted"])

    names = ["doc_id", *carry]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *carry, F.col("text").alias("text_"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text_")
    return rows.mapInArrow(releasing(run), f"{kinds}, score double, predicted int")
