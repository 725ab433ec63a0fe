"""Personal data, fill-in-middle and spelling variants against plain programs, and on odd rows."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import SF
from sylvan.llm import fim, pii, spelling
from sylvan.llm.queries import op11_pii, op12_fim
from test_edge_cases import LONG, TEXTS, docs, rows

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    out = []
    for i, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            sums = sum(sum(divmod(d * (1 + j % 2), 10)) for j, d in enumerate(reversed(digits)))
            fits = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")), "card": 16 <= len(digits) <= 19 and sums % 10 == 0, "phone": 8 <= len(digits) <= 15}
            if fits[kind]:
                out.append((i, *m.span()))
    return out


def plain_found(text, forest, conf):
    """Each candidate by itself: trees walked node by node, overlaps looked for one by one."""
    own = plain_base(text)
    meets = lambda s, t: s[1] < t[2] and t[1] < s[2]
    scored = []
    for s in pii.proposed(text):
        if any(meets(s, t) for t in own):
            continue
        x, z = pii.features(text, s, conf), forest.bias
        for feature, limit, value in zip(forest.feature, forest.limit, forest.value, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + (sum(x[feature[node]] > e for e in forest.edges[feature[node]]) > limit[node])
            z += value[node - len(feature)]
        p = 1 / (1 + np.exp(-(forest.slope[0] * z + forest.slope[1])))
        if p >= forest.threshold[s[0]]:
            scored.append((-round(float(p), 12), s))
    out = list(own)
    for _, s in sorted(scored):
        if not any(meets(s, t) for t in out[len(own) :]):
            out.append(s)
    return sorted(out)


@pytest.fixture(scope="module")
def forest(spark):
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    return pii.fit(texts, pii.Pii(trees=20))


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(3)
    for letters in ("ab@@..-_+ 0123456(", "0123456789-. +()", "aA@.1"):
        for _ in range(4000):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
            assert pii.base(text) == plain_base(text), text


def test_a_split_has_the_greatest_gain():
    rng = np.random.default_rng(1)
    conf = pii.Pii(depth=1, bins=8, leaf=5, rate=1.0)
    binned, grad, hess = rng.integers(0, 8, (200, 3)).astype(np.uint8), rng.standard_normal(200), rng.random(200) + 0.1
    feature, limit, value = pii.grow(binned, grad, hess, conf)
    score = lambda rows: grad[rows].sum() ** 2 / (hess[rows].sum() + 1)
    gains = {}
    for j in range(3):
        for cut in range(8):
            low = binned[:, j] <= cut
            if min(low.sum(), (~low).sum()) >= 5:
                gains[j, cut] = score(low) + score(~low) - score(np.ones(200, bool))
    best = max(gains, key=gains.get)
    low = binned[:, best[0]] <= best[1]
    assert (feature[0], limit[0]) == best
    assert value == pytest.approx([-grad[s].sum() / (hess[s].sum() + 1) for s in (low, ~low)])


def test_planted_values_of_other_texts_are_found(spark, forest):
    conf = pii.Pii()
    right, got, hit = 0, 0, 0
    others = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").filter("doc_id >= 500").orderBy("doc_id").limit(300).collect()
    for i, r in enumerate(others):
        text, true = pii.planted(r.text or "", 10_000 + i, conf)
        spans = [s[1:] for s in pii.found(text, forest, conf) if s[0] >= len(pii.BASE)]
        right, got, hit = right + len(true), got + len(spans), hit + len(set(spans) & set(true))
    assert hit >= 0.9 * right and hit >= 0.9 * got, (right, got, hit)


def test_added_spans_leave_ordinary_numbers_alone(forest):
    text = "page 12 of 400, 3.14159, 20 years, 1999, since 2001-02-03 at 10:20:30"
    assert pii.found(text, forest, pii.Pii()) == []


def test_op11_equals_the_plain_program(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    model, conf = pii.train(table), pii.Pii()
    want = {}
    for r in table.collect():
        spans = plain_found(r.text or "", model, conf)
        name = lambda some: ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in some)
        kinds = Counter(pii.KINDS[s[0]] for s in spans)
        strict = name(s for s in spans if s[0] < len(pii.BASE))
        want[r.doc_id] = (*(kinds[k] for k in pii.BASE), hashlib.sha256(strict.encode()).hexdigest(), name(spans))
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in op11_pii(spark, SF).collect()}
    assert got == want and sum(sum(v[:4]) for v in want.values()) > 0


def test_op11_odd_rows(spark, forest):
    text = "x😀 a.b@c.example 10.0.0.1, 4111 1111 1111 1111 call +1 (212) 555-0100"
    some = docs(spark, [*TEXTS, (20, text), (20, text), (21, "300.1.1.1 4111111111111112")])
    got = pii.digest(pii.scan(some, None))
    assert got.count() == len(TEXTS) + 3
    base = "email:3:16,ip:17:25,card:27:46,phone:52:69"
    assert rows(got.filter("doc_id = 20"), "spans", "n_email", "n_ip", "n_card", "n_phone") == [(base, 1, 1, 1, 1)] * 2
    assert got.filter(f"base_sha256 = '{hashlib.sha256(base.encode()).hexdigest()}'").count() == 2
    assert got.filter("doc_id <> 20 or doc_id is null").filter("spans <> ''").count() == 0
    put = pii.redact(pii.scan(some, None, carry=("text",))).filter("doc_id = 20").first().text
    assert put == "x😀 [email] [ip], [card] call [phone]"
    assert pii.redact(pii.scan(some, None, carry=("text",))).filter("doc_id = 7").first().text == LONG
    empty = docs(spark, [])
    assert pii.train(empty) is None and pii.digest(pii.scan(empty, forest)).count() == 0
    assert pii.digest(pii.scan(some, pii.train(docs(spark, [(1, None), (2, "")])))).count() == len(TEXTS) + 3


@pytest.mark.parametrize("text", ["1 " * 200_000, "a@" * 200_000, "7" * 400_000, "a" * 400_000 + "@", "1.1" * 100_000, "+1(" * 100_000, ":" * 300_000, "DE12 " * 80_000, "+1 212 555 0100 x " * 20_000])
def test_op11_takes_time_in_proportion(forest, text):
    began = time.time()
    pii.found(text, forest, pii.Pii())
    assert time.time() - began < 20


# ------------------------------------------------------------------------------------------------ fill in the middle


def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    key = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(key[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_op12_equals_the_plain_program(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab \t\nä€😀<PSM>") for _ in range(rng.randint(0, 60))) for _ in range(3000)] + ["<<M>", "<P", "a <P b", "< P>", "x<S>", "   ", "\x1c \x1f"]
    some = [*TEXTS, *((100 + i, t) for i, t in enumerate(texts)), (9999, "w " * 300_000), (-5, "minus"), (2**62, "long id")]
    made = fim.transformed(docs(spark, some), carry=("label",))
    assert made.columns == ["doc_id", "label", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made.collect())
    assert got == Counter((i, *plain_fim(i, t)) for i, t in some)
    shas = Counter((r.doc_id, r.restored_sha256) for r in fim.digest(fim.transformed(docs(spark, some))).collect())
    assert shas == Counter((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in some)
    assert fim.digest(fim.transformed(docs(spark, []))).count() == 0
    assert {r.form for r in op12_fim(spark, SF).collect()} == {"plain", "psm", "spm"}


def test_lanes_go_on_where_the_bytes_before_them_lead():
    for marks in (("<P>", "<S>", "<M>"), ("<fim_prefix>", "<fim_suffix>", "<fim>"), ("aab", "ab", "b")):
        scanner = fim.Scanner(marks)
        states = frozenset(range(len(scanner.table)))
        now = {states}
        for _ in range(scanner.reach):  # whatever the bytes are, one state is left
            now = {frozenset(int(scanner.table[s, b]) >> 8 for s in some) for some in now for b in range(256)}
        assert all(len(some) == 1 for some in now)
        rng = random.Random(1)
        data = np.frombuffer("".join(rng.choice("<PSM>ab é😀\n") for _ in range(5000)).encode(), np.uint8)
        state, want = scanner.BEGIN, []
        for byte in data:
            entry = int(scanner.table[state, byte])
            state = entry >> 8
            want.append(entry & 0xFF)
        assert scanner.scan(data).tolist() == want
    with pytest.raises(ValueError):
        fim.Scanner(("<a b>", "x", "y"))


# ------------------------------------------------------------------------------------------------ spelling variants


def plain_words(some):
    n = Counter()
    for i, text in some:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(some):
    n, out, form = plain_words(some), {}, {}
    for w in n:
        around = sorted((-n[x], x) for x in n if x != w and near(w, x))
        form[w] = around[0][1] if around and n[around[0][1]] >= 2 * n[w] else None
        out[w] = len(around)
    result = set()
    for w in n:
        last = w
        while form[last] is not None:
            last = form[last]
        result.add((w, form[w], last, n[w], out[w], n.get(form[w])))
    return result


def test_op13_equals_the_plain_program(spark):
    rng = random.Random(8)
    some = [(i, " ".join("".join(rng.choice("aÿ×") for _ in range(rng.randint(4, 7))) * rng.choice([1, 1, 2]) for _ in range(200))) for i in range(60)]
    chain = [(1000 + k, " ".join(["q" * (5 + k)] * (3 * 2**k))) for k in range(8)] + [(2000 + k, " ".join(["wwwww" + "v" * k + "xxxxx"[k:]] * (3 * 2**k))) for k in range(6)]
    some += chain + [(None, "Nowhere NOWHERE nowhere nowherre nowherre nowherre")] + [(3000 + i, "z" * 3000 + " " + "z" * 3001) for i in range(4)] + TEXTS
    want = plain_variants(some)
    got = spelling.variants(docs(spark, some).repartition(5)).collect()
    assert len(got) == len(want) and {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in got} == want
    assert max(r[4] for r in want) > 10 and any(w == "qqqqq" and root == "q" * 12 for w, _, root, *_ in want)


def test_op13_odd_rows(spark):
    assert spelling.variants(docs(spark, [])).count() == 0
    assert spelling.variants(docs(spark, [(1, None), (2, ""), (3, "1234 56 ab")])).count() == 0
    got = {r.word: r for r in spelling.variants(docs(spark, [(7, "apple applé grape")] * 3 + [(8, "apple apple apple")])).collect()}
    assert got["apple"].n == 6 and got["applé"].form == "apple" and got["grape"].n_near == 0 and got["grape"].root == "grape"


def test_checksums_equal_zlib():
    rng = random.Random(2)
    runs = [bytes(rng.randrange(97, 123) for _ in range(rng.choice([1, 2, 5, 9, 64, 65, 300]))) for _ in range(500)]
    data, length = np.frombuffer(b"".join(runs), np.uint8), np.array([len(r) for r in runs])
    begun = np.array([zlib.crc32(f"{i}:".encode()) for i in range(500)], np.uint32)
    got = spelling.checksums(data, np.cumsum(length) - length, length, begun)
    assert got.tolist() == [zlib.crc32(f"{i}:".encode() + r) for i, r in enumerate(runs)]
