"""Fingerprints against a plain version that looks at each window and each bit by itself."""

import base64
import hashlib
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from pixeltally.llm import fingerprint
from pixeltally.llm.fingerprint import (
    FILTER_BITS, FILTER_FEATURES, HASHES, LONG_TEXT, MOST_PAIRS, POPULAR, SHORT_TEXT, SHORT_WINDOW, STRETCH, WINDOW)

MASK = 2 ** 64 - 1


def prose(seed, size):
    dice = random.Random(seed)
    words = ["".join(dice.choices("etaoinshrdlucm", k=dice.randint(2, 9))) for _ in range(size)]
    return " ".join(words).encode()[:size]


TEXTS = [
    b"", b"x", b"short text", prose(1, 15), prose(1, 16), prose(2, 63), prose(2, 64), prose(2, 65), prose(3, 126), prose(3, 127),
    prose(3, 128), prose(4, 255), prose(4, 256), prose(4, 600), prose(5, 1023), prose(5, 1024), b"a" * 300, b"ab" * 700,
    prose(6, 900) * 3, prose(7, 12_000), "日本語のテキスト、".encode() * 40 + prose(8, 500), bytes(range(256)) * 6]


def plain_pairs(window):
    return sum(n * (n - 1) // 2 for n in Counter(window).values())


def plain_rank(texts):
    """Rank of each number of equal pairs, the rarest over all windows first."""
    seen = Counter(plain_pairs(t[k:k + WINDOW]) for t in texts for k in range(len(t) - WINDOW + 1))
    return {p: r for r, p in enumerate(sorted(range(fingerprint.PAIRS + 1), key=lambda p: (seen[p], p)))}


def mixed(x):
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ x >> shift) * factor & MASK
    return x ^ x >> 33


def plain_hash(window, salt=0):
    total = 0
    for k in range(len(window) // 8):
        total += mixed(int.from_bytes(window[8 * k:8 * k + 8], "little")) * (mixed(k + 1) | 1)
    return mixed(total & MASK ^ salt)


def plain_features(text, rank):
    """Hashes of a text's features, each once, in the order in which they are inserted."""
    windows = [text[k:k + WINDOW] for k in range(len(text) - WINDOW + 1)]
    pairs = [plain_pairs(w) for w in windows]
    worth = [(fingerprint.NEVER if p > MOST_PAIRS else rank[p], k) for k, p in enumerate(pairs)]
    if len(windows) >= STRETCH:
        wins = Counter(min(worth[k:k + STRETCH]) for k in range(len(windows) - STRETCH + 1))
        places = sorted(k for (r, k), n in wins.items() if n >= POPULAR and r < fingerprint.NEVER)
    else:
        places = [k for r, k in [min(worth)] if r < fingerprint.NEVER] if worth else []
    found = [plain_hash(windows[k]) for k in places]
    if SHORT_WINDOW <= len(text) < LONG_TEXT:
        share = min(1, (LONG_TEXT - len(text)) / (LONG_TEXT - SHORT_TEXT))
        small = [plain_hash(text[k:k + SHORT_WINDOW], SHORT_WINDOW) for k in range(len(text) - SHORT_WINDOW + 1)]
        found += [h for h in small if h / MASK <= share]
    if text and not found:
        found = [int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little")]
    return list(dict.fromkeys(found))


def plain_filters(text, rank):
    """The places of the bits that are set, a set for each filter."""
    features = plain_features(text, rank)
    return [
        {h >> 11 * k & FILTER_BITS - 1 for h in features[at:at + FILTER_FEATURES] for k in range(HASHES)}
        for at in range(0, len(features), FILTER_FEATURES)]


def plain_likeness(a, b):
    if not a or not b:
        return float(not a and not b)
    if len(a) > len(b):
        a, b = b, a
    total = 0.0
    for x in a:
        shares = []
        for y in b:
            chance = len(x) * len(y) / FILTER_BITS
            shares.append((len(x & y) - chance) / max(min(len(x), len(y)) - chance, 1e-9))
        total += len(x) * min(max(max(shares), 0), 1)
    return total / sum(map(len, a))


def places(row):
    return {8 * k + bit for k, byte in enumerate(row) for bit in range(8) if byte >> 7 - bit & 1}


def test_pairs_of_each_window():
    for text in TEXTS:
        found = fingerprint.equal_pairs(np.frombuffer(text, np.uint8)).tolist()
        assert found == [plain_pairs(text[k:k + WINDOW]) for k in range(len(text) - WINDOW + 1)]


def test_ranks():
    rank = fingerprint.ranks(fingerprint.entropy_counts(TEXTS))
    plain = plain_rank(TEXTS)
    assert all(rank[p] == (plain[p] if p <= MOST_PAIRS else fingerprint.NEVER) for p in plain)


def test_features_and_bits():
    rank, plain = fingerprint.ranks(fingerprint.entropy_counts(TEXTS)), plain_rank(TEXTS)
    for found, text in zip(fingerprint.filters(TEXTS, rank), TEXTS):
        assert [places(row) for row in found] == plain_filters(text, plain)
        # By itself a text has the filters that it has among others.
        assert fingerprint.encoded(fingerprint.filters([text], rank)[0]) == fingerprint.encoded(found)


def test_likeness():
    rank, plain = fingerprint.ranks(fingerprint.entropy_counts(TEXTS)), plain_rank(TEXTS)
    chains = fingerprint.filters(TEXTS, rank)
    sets = [plain_filters(t, plain) for t in TEXTS]
    for i, k in combinations(range(len(TEXTS)), 2):
        assert fingerprint.likeness(chains[i], chains[k]) == pytest.approx(plain_likeness(sets[i], sets[k]))
    assert all(fingerprint.likeness(c, c) == 1 for c in chains)


def test_the_query_columns(spark):
    """All columns of the operator, from a plain version of the whole."""
    rows = [(3 * k + 1, text.decode()) for k, text in enumerate(TEXTS[:-1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    plain = plain_rank([t.encode() for _, t in rows])
    expected = {}
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        own, changed, other = (plain_filters(t.encode(), plain) for t in (text, edited, following))
        expected[i] = (own, changed, plain_likeness(own, changed), plain_likeness(own, other))
    found = fingerprint.fingerprints(docs).collect()
    assert len(found) == len(rows)
    for row in found:
        own, changed, near_edited, near_next = expected[row["doc_id"]]
        for column, sets in (("fingerprint", own), ("edited_fingerprint", changed)):
            chain = [places(base64.b64decode(part)) for part in row[column].split(".") if part]
            assert chain == sets
        assert (row["near_edited"], row["near_next"]) == (pytest.approx(near_edited), pytest.approx(near_next))


@pytest.mark.parametrize("sizes", [(250, 260), (255, 256), (400, 420), (1015, 1030)])
def test_lengths_on_both_sides_of_a_limit(sizes):
    """A text and the same one with a few bytes more are alike, whichever windows their lengths choose."""
    text = prose(11, 1100)
    rank = fingerprint.ranks(fingerprint.entropy_counts(TEXTS))
    short, long, other = fingerprint.filters([text[:sizes[0]], text[:sizes[1]], prose(12, sizes[1])], rank)
    assert fingerprint.likeness(short, long) > 0.8 and fingerprint.likeness(long, other) < 0.2
