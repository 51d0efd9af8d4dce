"""Resampling against plain Python, and its segments."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from pixeltally.llm import resampling

WORDS = [f"{a}{b}" for a in "ka lo mi nu".split() for b in "ba de fo gu".split()] + ["é", "日本", "Äb"]


def features(text, buckets):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    every = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [zlib.crc32(f.encode()) % buckets for f in every]


def brute(docs, target, percent=25, seed=7, buckets=10_000, least_words=20):
    cut = [features(t, buckets) for _, t in docs]
    s, t = Counter(b for _, f in cut for b in f), Counter(b for x in target for b in features(x, buckets)[1])
    all_s, all_t = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (all_s + buckets) / ((s[b] + 1.0) * (all_t + buckets)))) for b in s}
    rows = []
    for (doc_id, _), (words, found) in zip(docs, cut):
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    order = sorted((r for r in rows if r[1] >= least_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    quota = percent * len(order) // 100
    rank = {id(r): k for k, r in enumerate(order, 1) if k <= quota}
    return sorted((tuple(r) + (rank.get(id(r)),) for r in rows), key=str)


def drawn(spark, docs, target, **more):
    documents = spark.createDataFrame([(*d, "x", "y", "z") for d in docs], "doc_id long, text string, place string, rank string, h1 string")
    wanted = spark.createDataFrame([(t, 1) for t in target], "text string, n int")
    return sorted((tuple(r) for r in resampling.resample(documents.repartition(3), wanted, **more).collect()), key=str)


def texts(n, seed):
    dice = random.Random(seed)
    line = lambda: "".join(f"{w}{dice.choice([' ', ', ', '-', ' !? '])}" for w in dice.choices(WORDS, k=dice.randint(0, 25)))
    common = [line() for _ in range(5)]
    return ["\n".join(dice.choice([line(), dice.choice(common), "", " . "]) for _ in range(dice.randint(0, 9))) for _ in range(n)]


TARGET = [*texts(12, 2), None, "", "日本 ka"]


def test_against_brute_force(spark):
    docs = list(enumerate(texts(150, 1)))
    expected = brute(docs, TARGET)
    assert drawn(spark, docs, TARGET) == expected
    assert 10 < sum(r[5] is not None for r in expected) < 60


def test_other_parameters(spark):
    docs = list(enumerate(texts(60, 3)))
    more = {"percent": 60, "seed": 11, "buckets": 50, "least_words": 5}
    assert drawn(spark, docs, TARGET, **more) == brute(docs, TARGET, **more)


def test_odd_rows(spark):
    long = " ".join(random.Random(4).choices(WORDS, k=30_000))
    docs = [(1, None), (2, ""), (3, "\n\n .\n"), (4, "one"), (5, long), (6, long + "\nend"), (-3, "a\r\nb\rc\n\nd"), (7, "w" * 300_000),
            (8, "\n".join(["same line again"] * 5000)), *[(20 + i, "ka lo " * 15) for i in range(9)]]
    assert drawn(spark, docs, TARGET) == brute(docs, TARGET)
    assert drawn(spark, docs, []) == brute(docs, [])
    assert drawn(spark, [], TARGET) == []


def test_rows_that_repeat_or_lack_an_id(spark):
    """Rows of their own; equal scores and ids share out the ranks in any order."""
    docs = [(1, "ka ba " * 12)] * 3 + [(None, "lo de " * 12)] * 2 + [(None, None), (2, "mi fo " * 14), (2, "nu gu " * 13)]
    assert drawn(spark, docs, TARGET, percent=60) == brute(docs, TARGET, percent=60)


def test_segments_are_counted_once(spark):
    docs = spark.createDataFrame([(i, "A b!\nc  d\n\n- a B -") for i in range(5)], "doc_id long, text string")
    counted = resampling._Counted(docs, 10_000)
    assert sorted(tuple(r) for r in counted.distinct.select("occurrences", "n_words").collect()) == [(5, 2), (10, 2)]
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    expected = {bucket(f): n for f, n in {"a": 10, "b": 10, "a b": 10, "c": 5, "d": 5, "c d": 5, "b c": 5, "d a": 5}.items()}
    assert {r["bucket"]: r["n"] for r in counted.counts().collect()} == expected


@pytest.mark.parametrize("drawn_of", [0, 100])
def test_none_and_all_drawn(spark, drawn_of):
    docs = [(i, "ka ba lo " * 10) for i in range(6)]
    ranks = [r[5] for r in drawn(spark, docs, TARGET, percent=drawn_of)]
    assert sorted(r for r in ranks if r) == ([] if not drawn_of else [1, 2, 3, 4, 5, 6])
