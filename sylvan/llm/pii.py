"""Personal data: generators propose spans, boosted trees judge them, calibrated thresholds choose those that count.

Base kinds (email, ip, card, phone) are what their strict patterns accept; they always count. Generators of higher recall propose further spans, which may overlap:
addresses written out, addresses of version 6, numbers of seven digits and more in groups of any kind, national identity numbers and bank accounts. Each
candidate has features of its format (lengths, digits, groups, separators, check sums) and of its context (hashed words before and after it, marks
beside it). Gradient boosting over binned features, one forest for all kinds, gives a log-odds; a logistic calibration on documents apart turns it into a
probability, and each kind's threshold is the least at which `precision` of the calibration's candidates are right. Of overlapping candidates the
likeliest is taken; one that overlaps a base span is that one already.

There are no labels of personal data, so the forest learns from planted ones: in a bounded sample of the documents (`sample` texts of `sample_bytes` in all, chosen by a hash),
values that are made up by format are put between words, half of them after a word that announces them. Candidates that meet a planted value are right, those that stay inside the text as it was
are wrong, and so are planted numbers of the same form that are none (order numbers, versions, sizes, dates). One task fits the forest; scoring covers all rows and whole texts.

Offsets count code points, ends are exclusive. Nulls: a null text is empty and has no spans; a null doc_id stays a row. Without a text to plant in, no added span counts. Runs of characters of any length are
matched once, never from each of their places. Repeated rows give the same spans each. An empty table gives no rows. Further columns are ignored but for `carry`."""

from __future__ import annotations

import pickle
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textkit import pieces, releasing, text_bytes
from .work import bounded_batches

BASE = ("email", "ip", "card", "phone")
#: Kinds that generators add, in their order of report after the base kinds.
ADDED = ("written_email", "ip6", "number", "identity", "account")
KINDS = (*BASE, *ADDED)

# the base patterns, with possessive repeats where giving back can't lead to a match
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# what generators propose; each begins where a run begins
_WRITTEN = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\s?(?:\[at\]|\(at\)|\x20at\x20|\x20@\x20)\s?[A-Za-z0-9-]{1,64}+(?:(?:\s?(?:\[dot\]|\(dot\))\s?|\x20dot\x20|\.)[A-Za-z0-9-]{1,24}+){1,4}")
_AT = re.compile(r"\[at\]|\(at\)|\x20at\x20|\x20@\x20")
_IP6 = re.compile(r"(?<![0-9A-Za-z:])(?=[0-9A-Fa-f]{0,4}:)[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:])")
_NUMBER = re.compile(r"(?<![0-9])\(?[0-9]++(?:[\x20()./-]{1,3}[0-9]++)*+")
_IDENTITY = re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}[\x20-][0-9]{2}[\x20-][0-9]{4}(?![0-9A-Za-z-])")
_ACCOUNT = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,4})?(?![0-9A-Za-z])")
_GROUPS = re.compile(r"[0-9]+")
_WORD = re.compile(r"[^\W\d_]{2,24}")


@dataclass(frozen=True)
class Pii:
    """sample, sample_bytes, longest: texts that values are planted in, their bytes and the bytes of one, at most. planted: values a text. trees, depth, rate, bins, leaf: of the boosting. context: code points beside a candidate. precision: of the
    candidates above a kind's threshold, on the calibration's documents."""

    sample: int = 1500
    sample_bytes: int = 12 << 20
    longest: int = 1 << 16
    planted: int = 6
    trees: int = 40
    depth: int = 4
    rate: float = 0.2
    bins: int = 32
    leaf: int = 20
    context: int = 48
    words: int = 64
    precision: float = 0.98
    seed: int = 11


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        total += x if i % 2 == 0 else x * 2 - 9 * (x > 4)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(_GROUPS.findall(text))


def base(text: str) -> list[tuple[int, int, int]]:
    """(kind's number, start, end) of the base kinds, by kind and place."""
    found, last = [], 0
    at = text.find("@")
    while at >= 0:
        first = at
        while first > last and text[first - 1] in _LOCAL:
            first -= 1
        host = _HOST.match(text, at + 1) if first < at else None
        if host:
            last = host.end()
            found.append((0, first, last))
        at = text.find("@", max(at + 1, last))
    for m in _IP.finditer(text):
        if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split(".")):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            found.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(digits_of(m[0])) <= 15:
                found.append((3, *m.span()))
    return found


def proposed(text: str) -> list[tuple[int, int, int]]:
    """(kind's number, start, end) of the candidates; they may overlap each other and base spans."""
    found = []
    if _AT.search(text):
        found += [(4, *m.span()) for m in _WRITTEN.finditer(text)]
    if text.count(":") >= 2:
        found += [(5, *m.span()) for m in _IP6.finditer(text) if re.search("[0-9a-fA-F]", m[0])]
    for m in _NUMBER.finditer(text):
        if m.end() - m.start() < 7:
            continue
        groups = [(m.start() + g.start(), m.start() + g.end()) for g in _GROUPS.finditer(m[0])]
        n = sum(b - a for a, b in groups)
        if 7 <= n <= 19:
            found.append((6, *m.span()))
        # the same place without its first or last group: a number beside another one
        for part in (groups[1:], groups[:-1]) if len(groups) > 2 else ():
            if 7 <= sum(b - a for a, b in part) <= 19:
                found.append((6, part[0][0], part[-1][1]))
    found += [(7, *m.span()) for m in _IDENTITY.finditer(text)]
    found += [(8, *m.span()) for m in _ACCOUNT.finditer(text)]
    return found


def _mod97(text: str) -> int:
    moved, out = text[4:] + text[:4], 0
    for c in moved:
        out = (out * (10 if c.isdigit() else 100) + int(c, 36)) % 97
    return out


#: Features of a candidate, apart from its context's words.
FORMAT = ("kind", "length", "digits", "letters", "groups", "longest", "shortest", "spaces", "dashes", "dots", "slashes", "brackets", "colons", "distinct", "luhn", "mod97", "first", "zero", "small", "ends_ok", "before", "after", "joined", "around", "host", "vowels", "upper", "dates")


def features(text: str, span: tuple[int, int, int], conf: Pii) -> list[float]:
    """Numbers about format and context, then 1 for each bucket that a word near the candidate falls in."""
    kind, a, b = span
    own = text[a:b]
    groups = _GROUPS.findall(own)
    digits, sizes = "".join(groups), [len(g) for g in groups] or [0]
    left, right = text[max(0, a - conf.context) : a], text[b : b + conf.context]
    side = lambda c: 0 if not c else 1 if c.isspace() else 2 if c.isdigit() else 3 if c.isalpha() else 4 if c in ".,;:)" else 5
    compact = own.replace(" ", "")
    row = [
        kind, len(own), len(digits), sum(c.isalpha() for c in own), len(groups), max(sizes), min(sizes), own.count(" "), own.count("-"), own.count("."), own.count("/"), own.count("(") - own.count(")") + 2 * own.count("("), own.count(":"),
        len(set(digits)), luhn(digits) if len(digits) > 11 else -1, _mod97(compact) == 1 if kind == 8 else -1, int(digits[0]) if digits else -1, digits[:1] == "0", all(len(g) < 4 and int(g) < 256 for g in groups),
        len(own) - len(own.rstrip(".,-( ")), side(left[-1:]), side(right[:1]), bool(left) and bool(re.search(r"[0-9][\x20.,/-]$", left)), sum(c.isdigit() for c in left[-20:]) + sum(c.isdigit() for c in right[:20]), own.rfind(".") - len(own), sum(c in "aeiou" for c in own.lower()) / len(own), sum(c.isupper() for c in own),
        len(groups) == 3 and (len(groups[0]) == 4 or len(groups[2]) == 4) and len(digits) == 8,
    ]
    near = [0.0] * (2 * conf.words)
    for w in _WORD.findall(left)[-3:]:
        near[zlib.crc32(w.lower().encode()) % conf.words] = 1.0
    for w in _WORD.findall(right)[:2]:
        near[conf.words + zlib.crc32(w.lower().encode()) % conf.words] = 1.0
    return [float(x) for x in row] + near


@dataclass
class Forest:
    """Trees over binned features; node k of a tree has the children 2k+1 and 2k+2."""

    edges: list[np.ndarray]
    feature: np.ndarray  # trees x inner nodes
    limit: np.ndarray
    value: np.ndarray  # trees x leaves
    bias: float = 0.0
    slope: tuple[float, float] = (1.0, 0.0)
    threshold: dict[int, float] = field(default_factory=dict)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], axis=1).astype(np.uint8) if len(x) else np.zeros((0, len(self.edges)), np.uint8)

    def raw(self, binned: np.ndarray) -> np.ndarray:
        rows, out = np.arange(len(binned)), np.full(len(binned), self.bias)
        for feature, limit, value in zip(self.feature, self.limit, self.value, strict=True):
            node = np.zeros(len(binned), np.int64)
            for _ in range(int(np.log2(len(value)))):
                node = 2 * node + 1 + (binned[rows, feature[node]] > limit[node])
            out += value[node - len(feature)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = self.slope[0] * self.raw(self.binned(x)) + self.slope[1]
        return 0.5 * np.tanh(0.5 * z) + 0.5


def grow(binned: np.ndarray, grad: np.ndarray, hess: np.ndarray, conf: Pii) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One tree, level by level: each node splits where the gain of the second-order loss is greatest, ties to the first feature and the lowest limit."""
    inner, (n, d) = (1 << conf.depth) - 1, binned.shape
    feature, limit = np.zeros(inner, np.int64), np.full(inner, 255, np.int64)
    node = np.zeros(n, np.int64)
    for level in range(conf.depth):
        first, many = (1 << level) - 1, 1 << level
        at = node - first
        sums = np.zeros((3, many, d, conf.bins))
        for j in range(d):
            cell = at * conf.bins + binned[:, j]
            for k, w in enumerate((grad, hess, None)):
                sums[k, :, j] = np.bincount(cell, w, many * conf.bins).reshape(many, conf.bins)
        left = np.cumsum(sums, axis=3)
        whole = left[..., -1:]
        right = whole - left
        gain = left[0] ** 2 / (left[1] + 1) + right[0] ** 2 / (right[1] + 1) - whole[0] ** 2 / (whole[1] + 1)
        gain[(left[2] < conf.leaf) | (right[2] < conf.leaf)] = 0
        flat = gain.reshape(many, -1)
        best = flat.argmax(1)
        good = flat[np.arange(many), best] > 1e-9
        feature[first : first + many] = np.where(good, best // conf.bins, 0)
        limit[first : first + many] = np.where(good, best % conf.bins, 255)
        node = 2 * node + 1 + (binned[np.arange(n), feature[node]] > limit[node])
    leaf, leaves = node - inner, inner + 1
    value = -np.bincount(leaf, grad, leaves) / (np.bincount(leaf, hess, leaves) + 1) * conf.rate
    return feature, limit, value


def boost(x: np.ndarray, y: np.ndarray, conf: Pii) -> Forest:
    """Logistic gradient boosting on all rows."""
    edges = []
    for j in range(x.shape[1]):
        seen = np.unique(x[:, j])
        edges.append((seen[:-1] + seen[1:]) / 2 if len(seen) <= conf.bins else np.unique(np.quantile(x[:, j], np.arange(1, conf.bins) / conf.bins)))
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    forest = Forest(edges, np.zeros((0, 0)), np.zeros((0, 0)), np.zeros((0, 0)), float(np.log(share / (1 - share))))
    binned, z, grown = forest.binned(x), np.full(len(x), forest.bias), []
    for _ in range(conf.trees):
        p = 0.5 * np.tanh(0.5 * z) + 0.5
        grown.append(grow(binned, p - y, p * (1 - p), conf))
        forest.feature, forest.limit, forest.value = (part[None] for part in grown[-1])
        z += forest.raw(binned) - forest.bias
    forest.feature, forest.limit, forest.value = (np.stack([t[k] for t in grown]) for k in range(3))
    return forest


def calibrate(forest: Forest, x: np.ndarray, y: np.ndarray, conf: Pii) -> None:
    """Slope and offset of the log-odds by Newton steps, and each kind's threshold."""
    z, a, b = forest.raw(forest.binned(x)), 1.0, 0.0
    for _ in range(50):
        p = 0.5 * np.tanh(0.5 * (a * z + b)) + 0.5
        s = p * (1 - p) + 1e-6
        step = np.linalg.solve([[(s * z * z).sum() + 1, (s * z).sum()], [(s * z).sum(), s.sum() + 0.01]], [((p - y) * z).sum() + a - 1, (p - y).sum() + 0.01 * b])
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    forest.slope = (float(max(a, 0.05)), float(b))
    p = forest.probability(x)
    for kind in range(len(BASE), len(KINDS)):
        own = x[:, 0] == kind
        order = np.argsort(-p[own], kind="stable")
        q, right = p[own][order], np.cumsum(y[own][order])
        good = np.flatnonzero((right >= conf.precision * np.arange(1, len(q) + 1)) & (q >= 0.5))
        # the likeliest are right down to here; the threshold lies halfway to the next one, and a kind that is never right has none
        below = q[good[-1] + 1] if len(good) and good[-1] + 1 < len(q) else 0
        forest.threshold[kind] = float(max(0.5, (q[good[-1]] + below) / 2)) if len(good) else 2.0


#: Words that announce a planted value of a kind, and words that announce a number that is none.
ANNOUNCED = {
    "written_email": ("email", "mail", "contact", "write to", "reach me at", "courriel", "correo"),
    "ip6": ("address", "host", "from", "server", "client"),
    "number": ("phone", "tel", "call", "mobile", "fax", "card", "telefon", "téléphone", "teléfono"),
    "identity": ("ssn", "social security", "identity", "id no"),
    "account": ("iban", "account", "konto", "compte", "cuenta"),
}
NONE = ("order", "invoice", "isbn", "part", "version", "page", "size", "total", "ref", "on", "since")


def made_up(kind: str, rng: random.Random) -> str:
    """A value of a kind that no base pattern takes, by its format."""
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    name = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9)))
    if kind == "written_email":
        at, dot = rng.choice([(" at ", " dot "), ("[at]", "[dot]"), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", " (dot) "), (" @ ", ".")])
        return f"{name()}{rng.choice(['.', '_', ''])}{name()}{at}{name()}{dot}{rng.choice(['com', 'org', 'net', 'de', 'fr', 'es'])}"
    if kind == "ip6":
        parts = [f"{rng.randrange(1 << 16):x}" for _ in range(8)]
        return ":".join(parts) if rng.random() < 0.5 else ":".join(parts[: rng.randint(2, 4)]) + "::" + ":".join(parts[: rng.randint(1, 2)])
    if kind == "number":
        return rng.choice([
            f"({rng.randint(201, 989)}) {rng.randint(200, 999)}-{number(4)}", f"{rng.randint(201, 989)}-{rng.randint(200, 999)}-{number(4)}", f"{rng.randint(201, 989)}.{rng.randint(200, 999)}.{number(4)}",
            f"0{rng.randint(1, 9)} {number(2)} {number(2)} {number(2)} {number(2)}", f"0{rng.randint(20, 99)} {number(4)} {number(4)}", f"0{rng.randint(150, 179)}/{number(7)}",
            f"3{rng.choice('47')}{number(2)} {number(6)} {number(5)}",
        ])
    if kind == "identity":
        return f"{rng.randint(1, 899):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}"
    body = rng.choice(["DE", "FR", "ES", "GB", "NL"]) + "00" + (number(18) if rng.random() < 0.7 else "".join(rng.choice("ABCDEFGHKL") for _ in range(4)) + number(14))
    body = f"{body[:2]}{98 - _mod97(body):02d}{body[4:]}"
    return body if rng.random() < 0.5 else " ".join(body[i : i + 4] for i in range(0, len(body), 4))


def no_value(rng: random.Random) -> str:
    """A number that is none of anybody's."""
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    return rng.choice([
        number(rng.randint(7, 19)), f"{number(3)}.{number(3)}.{number(3)}", f"20{number(2)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", f"{rng.randint(1, 28):02d}/{rng.randint(1, 12):02d}/19{number(2)}",
        f"978-{number(1)}-{number(4)}-{number(4)}-{number(1)}", f"{number(4)} {number(4)}", f"{number(2)}:{number(2)}:{number(2)}", "".join(rng.choice("0123456789abcdef") for _ in range(32)),
        f"{''.join(rng.choice('ABCDEFGHKL') for _ in range(2))}{number(2)} {number(4)} {number(4)} {number(4)}", f"look at {rng.choice(['that', 'this', 'home'])}.{rng.choice(['then', 'we', 'and'])}",
    ])


def planted(text: str, seed: int, conf: Pii) -> tuple[str, list[tuple[int, int]]]:
    """The text with values between its words, and where the values of a person are."""
    rng, gaps = random.Random(seed), [m.start() for m in re.finditer(r"\s", text)] or [len(text)]
    out, last, right, size = [], 0, [], 0
    for at in sorted(rng.sample(gaps, min(conf.planted, len(gaps)))):
        kind = rng.choice((*ADDED, "number", None, None, None))
        value = no_value(rng) if kind is None else made_up(kind, rng)
        words = NONE if kind is None else ANNOUNCED[kind]
        lead = " " + (rng.choice(words) + rng.choice([" ", ": ", " no. "]) if rng.random() < (0.5 if kind else 0.7) else "")
        out += [text[last:at], lead]
        size += at - last + len(lead)
        if kind is not None:
            right.append((size, size + len(value)))
        out.append(value)
        size, last = size + len(value), at
    return "".join([*out, text[last:]]), right


def examples(texts: list[str], conf: Pii) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, label and text of each candidate of the planted texts that no base span meets."""
    x, y, which = [], [], []
    for i, text in enumerate(texts):
        mixed, right = planted(text, conf.seed * 1_000_003 + i, conf)
        taken = [s[1:] for s in base(mixed)]
        for span in proposed(mixed):
            if any(a < span[2] and span[1] < b for a, b in taken):
                continue
            x.append(features(mixed, span, conf))
            y.append(float((span[1], span[2]) in right))
            which.append(i)
    return np.asarray(x, np.float64).reshape(len(x), -1), np.asarray(y), np.asarray(which, np.int64)


def fit(texts: list[str], conf: Pii) -> Forest | None:
    """A forest from four fifths of the texts, calibrated on the others; none where one kind of label is missing."""
    x, y, which = examples(texts, conf)
    apart = which % 5 == 0
    if any(len(set(part.tolist())) < 2 for part in (y[apart], y[~apart])):
        return None
    forest = boost(x[~apart], y[~apart], conf)
    calibrate(forest, x[apart], y[apart], conf)
    return forest


def found(text: str, forest: Forest | None, conf: Pii) -> list[tuple[int, int, int]]:
    """All spans of a text as (kind's number, start, end), by kind and place."""
    own = base(text)
    spans = [s for s in proposed(text)] if forest else []
    if not spans:
        return own
    taken = sorted(s[1:] for s in own)
    starts, ends = np.array([a for a, _ in taken], np.int64), np.maximum.accumulate(np.array([b for _, b in taken], np.int64)) if taken else np.zeros(0, np.int64)
    free = []
    for s in spans:
        before = int(np.searchsorted(starts, s[2], "left"))  # base spans that begin before its end
        if not before or ends[before - 1] <= s[1]:
            free.append(s)
    chosen: list[tuple[int, int, int]] = []
    p = np.concatenate([forest.probability(np.asarray([features(text, s, conf) for s in free[k : k + 4096]])) for k in range(0, len(free), 4096)]) if free else []
    good = sorted((-q, s) for q, s in zip(p, free, strict=True) if q >= forest.threshold[s[0]])
    held = np.zeros(len(text) + 1, bool) if good else None
    for _, s in good:
        if not held[s[1] : s[2]].any():
            held[s[1] : s[2]] = True
            chosen.append(s)
    return sorted(own + chosen)


def train(docs: DataFrame, conf: Pii = Pii()) -> Forest | None:
    """Fit on a bounded sample: texts in order of a hash, as far as their bytes go."""
    text = F.coalesce("text", F.lit(""))
    own = docs.select(F.xxhash64(text, F.lit(conf.seed)).alias("h"), text.alias("text")).filter(F.octet_length("text") <= conf.longest)
    # one text of those with a hash; rows are counted by hash before a text moves
    picked = own.select("h").distinct().orderBy("h").limit(conf.sample)
    chosen = own.join(F.broadcast(picked), "h").dropDuplicates(["h"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, left = [], conf.sample_bytes
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if (size := len(text.encode())) <= left:
                    left -= size
                    texts.append(text)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(texts, conf))], pa.binary())], ["model"])

    bounded_batches(docs.sparkSession)
    model = chosen.repartition(1).sortWithinPartitions("h").mapInArrow(releasing(run), "model binary").first()
    return pickle.loads(model[0]) if model else None


def scan(docs: DataFrame, forest: Forest | None, conf: Pii = Pii(), carry: tuple[str, ...] = ()) -> DataFrame:
    """`docs(doc_id, text, *carry)` to one row a document with `spans`, an array of (kind, start, end) by kind as listed and place."""
    bounded_batches(docs.sparkSession)
    shared, names = docs.sparkSession.sparkContext.broadcast(forest), ["doc_id", *carry]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = text_bytes(batch.column("text_"))
            for i, j in pieces(offsets):
                part = batch.slice(i, j - i)
                spans = [[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in found(t or "", shared.value, conf)] for t in part.column("text_").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(spans, kind)], [*names, "spans"])

    rows = docs.select(*names, F.col("text").alias("text_"))
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)
    return rows.mapInArrow(releasing(run), f"{kinds}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(scanned: DataFrame) -> DataFrame:
    """The contract's columns of `scan`'s rows."""
    spans = F.col("spans")
    of = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    strict = F.filter(spans, lambda s: s["kind"].isin(*BASE))
    return scanned.select("doc_id", *(of(k).alias(f"n_{k}") for k in BASE), F.sha2(listed(strict).cast("binary"), 256).alias("base_sha256"), listed(spans).alias("spans"))


def redact(scanned: DataFrame, text: str = "text") -> DataFrame:
    """`scan`'s rows with a carried text: each maximal run of overlapping spans gives way to the kind of its first, in brackets; `spans` goes."""
    whole = F.coalesce(text, F.lit(""))
    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("done"))
    by_place = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    put = F.aggregate(
        by_place,
        none,
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(x["start"] >= s["at"], F.concat(s["done"], F.array(F.substring(whole, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")), F.concat(F.lit("["), x["kind"], F.lit("]")))))
            .otherwise(s["done"])
            .alias("done"),
        ),
        lambda s: F.concat(F.array_join(s["done"], ""), F.substring(whole, (s["at"] + 1).cast("int"), F.length(whole))),
    )
    return scanned.withColumn(text, F.when(F.size("spans") > 0, put).otherwise(F.col(text))).drop("spans")
