"""Work that stays in proportion: buckets with strays, notices in a row, copies on a host, words of a tokenizer."""

import math
import random
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings as limits, strategies as st
from pyspark.sql import functions as F

from pixeltally.llm import language_id, license_scan, line_dedup, minhash, packing, registry


def bucket(spark, strays, members=20_000, shingles=100):
    """Linked sets of one bucket, and some of other components."""
    return spark.range(members).select(
        F.lit(7).cast("long").alias("band"), F.col("id").alias("node"), F.lit(shingles).cast("long").alias("n_shingles"),
        F.when(F.col("id") < strays, F.col("id")).otherwise(F.lit(members)).alias("label"))


@pytest.mark.parametrize("strays", [0, 1, 300])
def test_a_bucket_with_strays_makes_rows_in_proportion(spark, strays):
    rows = minhash._blocks(bucket(spark, strays)).cache()
    others, rest = math.ceil(strays / minhash.BLOCK), math.ceil((20_000 - strays) / minhash.BLOCK)
    assert rows.count() == (20_000 - strays) * others + strays * (others + rest) * (strays > 0)
    # Each pair of labels meets, in a group of a bounded size.
    groups = rows.groupBy("low", "high").agg(F.count("*").alias("n"), F.countDistinct("label").alias("labels")).collect()
    assert all(g.n <= 2.6 * minhash.BLOCK for g in groups)
    met = {(g.low, g.high) for g in groups}
    assert met == {(a, b) for a in range(others) for b in range(a, others + rest)} if strays else met == set()


def test_blocks_of_long_sets_hold_fewer(spark):
    rows = minhash._blocks(bucket(spark, 5, 2000, 50_000))
    per = rows.groupBy("low", "high", "block").agg(F.sum("n_shingles").alias("s")).agg(F.max("s")).first()[0]
    assert per <= 2 * minhash.BLOCK_SHINGLES


def test_signatures_rule_out_almost_nothing():
    for percent, n in ((85, 120), (80, 175), (50, 40)):
        p, least = percent / 100, minhash.least_alike(percent, n)
        tail = sum(math.comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(least))
        assert tail <= minhash.UNLIKELY < tail + math.comb(n, least) * p ** least * (1 - p) ** (n - least)


# ---- license notices --------------------------------------------------------


def least_edits(notice, text):
    """The fewest edits between the notice and any part of the text, by the plain table."""
    row = list(range(len(notice) + 1))
    best = row[-1]
    for c in text:
        last, row = row, [0]
        for k, d in enumerate(notice, 1):
            row.append(min(last[k - 1] + (c != d), last[k] + 1, row[-1] + 1))
        best = min(best, row[-1])
    return best


def harmed(dice, text, edits):
    for _ in range(edits):
        at = dice.randrange(len(text) + 1)
        text = dice.choice([text[:at] + text[at + 1:], text[:at] + dice.choice("abxyz ") + text[at:], text[:at] + dice.choice("abxyz") + text[at + 1:]])
    return text


def test_notices_against_the_plain_table():
    dice = random.Random(6)
    notices = {"mozilla public license": ("mpl", 2), "all rights reserved": ("arr", 1), "permission is hereby granted free of charge": ("mit", 4)}
    search = license_scan.scanner(tuple(notices.items()))
    seen = set()
    for _ in range(250):
        parts = []
        for _ in range(dice.randint(1, 4)):
            notice = dice.choice(list(notices))
            parts.append(harmed(dice, notice, dice.randint(0, notices[notice][1] + 2)))
            parts.append(" ".join(dice.choices("lorem ipsum all public granted x".split(), k=dice.randint(0, 3))))
        text = license_scan.words(" ".join(parts)).decode()
        found = search.search(text)
        for notice, (label, edits) in notices.items():
            spans = [s for s in found if s[0] == label]
            least = least_edits(notice, text)
            assert bool(spans) == (least <= edits)
            if spans:
                assert min(s[3] for s in spans) == least
                seen.add((label, least))
            for _, start, end, harm, likeness in spans:
                assert least_edits(notice, text[start:end]) <= harm <= edits and likeness == 1 - harm / len(notice)
            ordered = sorted(s[1:3] for s in spans)
            assert all(a[1] <= b[0] for a, b in zip(ordered, ordered[1:]))
    assert len(seen) >= 8


def test_each_of_many_notices_is_found():
    search = license_scan.scanner(tuple(license_scan.NOTICES.items()))
    text = license_scan.words("gnu generel public license and gnu general public license " * 50).decode()
    spans = [s for s in search.search(text) if s[0] == "gpl"]
    assert [s[3] for s in spans] == [1, 0] * 50


@pytest.mark.parametrize("part", ["gnu general publik licenze ", "all right reservd ", "gnu gnu general public licenses lesser "])
def test_notices_in_a_row_take_time_in_proportion(part):
    search = license_scan.scanner(tuple(license_scan.NOTICES.items()))
    took = []
    for times in (2_000, 20_000):
        start = time.perf_counter()
        search.search(license_scan.words(part * times).decode())
        took.append(time.perf_counter() - start)
    assert took[1] < 25 * took[0] + 1 and took[1] < 40


# ---- lines ------------------------------------------------------------------


def test_copies_of_a_page_are_one_page(spark):
    """Three copies of an article on a host of 40 pages keep their lines; a menu on three pages goes."""
    article = "\n".join(f"Line {k} of the article, long enough." for k in range(8))
    rows = [(i, article, "host") for i in range(3)]
    rows += [(i, f"Page {i}.\nHome | About\nIts own text {i}." if i < 6 else f"Page {i}.\nIts own text {i}.", "host") for i in range(3, 41)]
    found = {r.doc_id: r for r in line_dedup.drop_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(found[i].text == article and found[i].n_removed == 0 for i in range(3))
    assert all(found[i].text == f"Page {i}.\nIts own text {i}." and found[i].n_removed == 1 for i in range(3, 6))


# ---- words of the tokenizer -------------------------------------------------


@pytest.fixture(scope="module")
def words():
    return packing.WordTokenizer(registry.tokenizer_path())


ODD = st.text(alphabet=st.one_of(st.sampled_from("aAbBzZ .,;:!?'\n\t-_1<|>ßÄéÉİΣςσ日本́  \x85\U0001f600"), st.characters(codec="utf-8")), max_size=60)


@given(st.lists(ODD, max_size=6))
@limits(max_examples=300, deadline=None)
def test_ids_are_the_tokenizers(words, texts):
    expected = [np.asarray(e.ids, "<u4").tobytes() for e in words.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert words(texts) == expected


def test_ids_when_the_cache_is_small(words, monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 60)
    dice = random.Random(1)
    texts = [" ".join("".join(dice.choices("abcdeäÖ", k=dice.randint(1, 4))) + dice.choice(["", ",", ".", "?!"]) for _ in range(80)) for _ in range(30)]
    small = packing.WordTokenizer(registry.tokenizer_path())
    for text in texts:
        assert small([text]) == [np.asarray(words.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]


# ---- languages --------------------------------------------------------------


def plain_losses(model, x):
    """How much each codeword loses, bit by bit: the logistic loss of the bit's classifier times its weight."""
    losses = []
    for code in model.codes:
        total = 0.0
        for bit in range(len(code)):
            margin = sum(float(a) * float(b) for a, b in zip(x, model.weights[:, bit])) + float(model.intercepts[bit])
            z = -float(code[bit]) * margin
            total += float(model.reliability[bit]) * (max(z, 0.0) + math.log1p(math.exp(-abs(z))))
        losses.append(total)
    return losses


def test_decoding_against_the_plain_form():
    dice = np.random.default_rng(4)
    for languages in (2, 3, 7):
        y = dice.integers(0, languages, 200)
        x = (dice.normal(size=(200, 10)) + 1.5 * dice.normal(size=(languages, 10))[y]).astype(np.float32)
        model = language_id.fit_codes(x, y, [f"l{n}" for n in range(languages)])
        # Codewords differ in at least two bits where there are three languages or more, so one wrong bit can be outvoted.
        apart = min((model.codes[a] != model.codes[b]).sum() for a in range(languages) for b in range(a))
        assert apart >= (1 if languages == 2 else 2)
        best, score, ambiguous = model.decode(x[:60])
        for row, b, s, unsure in zip(x[:60], best, score, ambiguous):
            losses = plain_losses(model, row)
            likely = [math.exp(min(losses) - loss) for loss in losses]
            likely = sorted((v / sum(likely) for v in likely), reverse=True)
            assert b == losses.index(min(losses)) and abs(s - likely[0]) < 1e-6
            assert unsure == (likely[0] - likely[1] < model.ambiguous)
        assert (best == y[:60]).mean() > 0.8


def test_many_languages_share_the_budget(spark, monkeypatch):
    monkeypatch.setattr(language_id, "FIT_BYTES", 2 * language_id.FEATURES * 60)
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 12)
    dice = random.Random(8)
    rows = [(n * 100 + i, " ".join(f"{chr(97 + n)}{dice.choice('xyz')}{chr(98 + n)}" for _ in range(12)), f"l{n:02}") for n in range(14) for i in range(30 + n)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    # The twelve with most rows.
    assert model.languages == [f"l{n:02}" for n in range(2, 14)]


# ---- sequences --------------------------------------------------------------


def replayed(bins, capacity):
    """Holds each bin, in order, against the method: the fullest greedy start, its smallest given for the best two."""
    pool = Counter(length for held in bins for length in held)
    for held in bins:
        greedy, room = [], capacity
        left = pool.copy()
        while fits := [length for length in left if left[length] and length <= room]:
            greedy.append(max(fits))
            left[greedy[-1]] -= 1
            room -= greedy[-1]
        sums = []
        if room and len(greedy) > 1:
            rest = sorted(left.elements())
            sums = [a + b for k, a in enumerate(rest) for b in rest[k + 1:] if greedy[-1] < a + b <= greedy[-1] + room]
        if sums:
            assert held[:-2] == greedy[:-1] and sum(held[-2:]) == max(sums)
        else:
            assert held == greedy
        pool -= Counter(held)
    assert not +pool


@limits(max_examples=150, deadline=None)
@given(lengths=st.lists(st.integers(1, 30), max_size=40), capacity=st.integers(30, 60))
def test_bins_against_the_plain_method(lengths, capacity):
    bins, offsets = packing.pack(lengths, capacity)
    held = {}
    for number, offset, length in sorted(zip(bins.tolist(), offsets.tolist(), lengths)):
        held.setdefault(number, []).append((offset, length))
    for parts in held.values():
        assert [o for o, _ in parts] == [sum(l for _, l in parts[:k]) for k in range(len(parts))]
    replayed([[l for _, l in held[number]] for number in sorted(held)], capacity)


def test_sequences_of_each_group(spark):
    """The operator's own sequences, over several groups, against the plain method."""
    def letters(texts):  # here, since workers don't import the tests
        return [np.frombuffer(t.encode(), np.uint8).astype("<u4").tobytes() for t in texts]

    dice = random.Random(8)
    texts = [(i, "a" * dice.choice((0, 3, 7, 12, 19, 31, 32, 70))) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    rows = packing.packed(docs, letters, capacity=32, group_pieces=90).collect()
    ends = {}
    for row in rows:
        ends.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    short = [r for r in rows if r["length"] < 32]
    groups = -(-len(short) // 90)
    assert groups > 3 and sum(r["length"] for r in rows) == sum(len(t) + 1 for _, t in texts)
    assert all(parts == [(0, 32)] for number, parts in ends.items() if number < 0)
    for group in range(groups):
        replayed([[l for _, l in sorted(ends[n])] for n in sorted(ends) if n >= 0 and n % groups == group], 32)
