"""Every occurrence of a licence, against a plain program that tries all windows of all templates."""

import random
import time

from sylvan.llm import licences


def plain(text, percent=80):
    words = licences._words(text)
    pairs = [" ".join(p) for p in zip(words, words[1:], strict=False)]
    found = []
    for place, (name, m, own) in enumerate(licences.TEMPLATES):
        near = []
        for i, p in enumerate(pairs):
            if p in own:
                window = pairs[i : i + m]
                common, total = len(set(window) & set(own)), len(set(window)) + len(own)
                if 200 * common >= total * percent:
                    near.append((common / total, i, i + len(window) + 1, common, total))
        for x in near:
            if not any(abs(y[1] - x[1]) * 2 < m and (y[0] > x[0] or y[0] == x[0] and y[1] < x[1]) for y in near):
                found.append((x[1], x[2], name, 3 * x[3] - x[4], x[0], -place))
    kept = [x for x in found if not any(y[3:] > x[3:] and y[0] < x[1] and x[0] < y[1] for y in found)]
    return sorted(x[:3] for x in kept)


def test_all_occurrences_are_those_of_the_plain_program(spark):
    rng = random.Random(4)
    short = [text for _, text in licences.NOTICES if len(text) < 400]
    texts = []
    for _ in range(25):
        parts = []
        for _ in range(rng.randint(1, 12)):
            words = rng.choice(short).split()
            if rng.random() < 0.4:
                words[rng.randrange(len(words))] = "otherwise"
            parts.append(" ".join(words) + " " + "lorem ipsum dolor " * rng.choice([0, 0, 1, 5]))
        texts.append("\n".join(parts))
    texts += [licences.NOTICES[-1][1] * 3, licences.NOTICES[27][1] * 4, "Released under the MIT License. " * 200]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got = {r.doc_id: sorted((x.start, x.stop, x.licence) for x in r.found) for r in licences.scan(frame).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}
    assert len(got[len(texts) - 1]) == 200 and len(got[len(texts) - 2]) == 4


def test_a_long_text_of_notices_takes_time_in_proportion(spark):
    once = spark.createDataFrame([(1, "Released under the MIT License. ")], "doc_id long, text string")
    licences.scan(once).collect()
    began = time.time()
    many = spark.createDataFrame([(1, "Released under the MIT License. " * 20_000)], "doc_id long, text string")
    assert len(licences.scan(many).first().found) == 20_000
    assert time.time() - began < 60
