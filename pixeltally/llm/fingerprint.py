"""Document fingerprints: improbable features in chained Bloom filters.

A feature is a window of bytes. Its entropy says how improbable it is: entropies that are
rare over all documents come first. In each stretch of neighbouring windows the rarest one
is counted, and windows counted often enough are the features; short texts, which have few,
add smaller windows, the fewer the longer they are, chosen by hash alone so that texts of
different lengths choose alike. They go into Bloom filters of a fixed size, a new one as soon
as one is full; two fingerprints are compared by the bits that their filters share beyond chance.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixeltally.llm.common import stored
from pixeltally.llm.words import chunks, mix64

WINDOW = 64          # bytes of a feature
STRETCH = 64         # neighbouring windows of which the rarest is counted
POPULAR = 16         # times a window must be the rarest
FILTER_BITS = 2048
FILTER_FEATURES = 160
HASHES = 5
PAIRS = WINDOW * (WINDOW - 1) // 2
# Windows with more equal pairs have under two bits of entropy: runs of one or few characters.
MOST_PAIRS = (WINDOW * WINDOW // 4 - WINDOW) // 2
NEVER = PAIRS + 1
BUCKET_ROWS = 4096
MOST_BUCKETS = 20_000
SHORT_TEXT = 256     # bytes; of shorter texts every SHORT_WINDOW bytes are features too
LONG_TEXT = 1024     # bytes; from here on none are, and between the two a share that falls evenly
SHORT_WINDOW = 16
NO_ID = -(2 ** 63)


def equal_pairs(buffer: np.ndarray) -> np.ndarray:
    """For each window of the buffer the number of pairs of equal bytes in it, from 0 to ``PAIRS``.

    That is the window's collision entropy: -log2((WINDOW + 2 * pairs) / WINDOW ** 2) bits.
    """
    n = len(buffer)
    if n < WINDOW:
        return np.zeros(0, np.int32)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for lag in range(1, WINDOW):
        equal = (buffer[lag:] == buffer[:-lag]).view(np.uint8)
        before[lag:] += equal
        after[:-lag] += equal
    found = np.empty(n - WINDOW + 1, np.int32)
    found[0] = before[:WINDOW].sum(dtype=np.int64)
    change = before[WINDOW:].astype(np.int32) - after[:n - WINDOW]
    np.cumsum(change, out=found[1:])
    found[1:] += found[0]
    return found


def _windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each text starts in the joined texts, and how many windows it has."""
    return np.cumsum(sizes) - sizes, np.maximum(sizes - WINDOW + 1, 0)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its count, all in a row."""
    total = np.cumsum(counts)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(starts - total + counts, counts)


def entropy_counts(texts: Sequence[bytes]) -> np.ndarray:
    """How many windows have each number of equal pairs."""
    found = np.zeros(PAIRS + 1, np.int64)
    for low, high in chunks(texts):
        part = texts[low:high]
        starts, counts = _windows(np.array([len(t) for t in part], np.int64))
        pairs = equal_pairs(np.frombuffer(b"".join(part), np.uint8))
        found += np.bincount(pairs[_ranges(starts, counts)], minlength=PAIRS + 1)
    return found


def ranks(counts: np.ndarray) -> np.ndarray:
    """The rank of each number of pairs, the rarest first; windows of little entropy never count."""
    found = np.empty(PAIRS + 1, np.int64)
    found[np.lexsort((np.arange(PAIRS + 1), counts))] = np.arange(PAIRS + 1)
    found[MOST_PAIRS + 1:] = NEVER
    return found


def _select(rank: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places of the features in the joined texts, in order."""
    if not len(rank):
        return np.zeros(0, np.int64)
    lowest = (rank << 40) | np.arange(len(rank))
    span = 1
    while span < STRETCH:  # the least of 2, 4, 8 ... neighbours; the leftmost of equal ones
        step = min(span, STRETCH - span)
        if step < len(lowest):
            lowest[:-step] = np.minimum(lowest[:-step], lowest[step:])
        span += step
    long = counts >= STRETCH
    at = lowest[_ranges(starts[long], counts[long] - STRETCH + 1)]
    edges = np.flatnonzero(np.diff(at, prepend=-1))
    popular = np.diff(np.append(edges, len(at))) >= POPULAR
    chosen = at[edges[popular]]
    # A text with fewer windows than a stretch has the rarest of them.
    few = [lo + int(np.argmin(rank[lo:lo + n])) for lo, n in zip(starts[~long].tolist(), counts[~long].tolist()) if n]
    few = np.array(few, np.int64)
    places = np.sort(np.concatenate([chosen & ((1 << 40) - 1), few]))
    return places[rank[places] < NEVER]


def small_share(size: int) -> int:
    """The greatest hash of a small window that is a feature of a text of ``size`` bytes."""
    return (2 ** 64 - 1) * min(max(LONG_TEXT - size, 0), LONG_TEXT - SHORT_TEXT) // (LONG_TEXT - SHORT_TEXT)


def filters(texts: Sequence[bytes], rank: np.ndarray) -> list[np.ndarray]:
    """For each text its chained Bloom filters, a row of bytes each; none for an empty text."""
    found: list[np.ndarray] = []
    multipliers = mix64(np.arange(1, WINDOW // 8 + 1, dtype=np.uint64)) | np.uint64(1)
    for low, high in chunks(texts):
        part = texts[low:high]
        sizes = np.array([len(t) for t in part], np.int64)
        starts, counts = _windows(sizes)
        buffer = np.frombuffer(b"".join(part), np.uint8)
        places = _select(rank[equal_pairs(buffer)], starts, counts)
        text = np.searchsorted(starts, places, side="right") - 1
        # Empty texts share the start of the next one; the last with that start is it.
        rows = np.lib.stride_tricks.sliding_window_view(buffer, WINDOW)[places] if len(places) else np.zeros((0, WINDOW), np.uint8)
        hashes = mix64((mix64(np.ascontiguousarray(rows).view(np.uint64)) * multipliers).sum(axis=1, dtype=np.uint64))
        owner, small = [text], [hashes]
        for i in np.flatnonzero((sizes >= SHORT_WINDOW) & (sizes < LONG_TEXT)).tolist():
            rows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(part[i], np.uint8), SHORT_WINDOW)
            rows = mix64(np.ascontiguousarray(rows).view(np.uint64)) * multipliers[:SHORT_WINDOW // 8]
            chosen = mix64(rows.sum(axis=1, dtype=np.uint64) ^ np.uint64(SHORT_WINDOW))
            chosen = chosen[chosen <= np.uint64(small_share(int(sizes[i])))]
            owner.append(np.full(len(chosen), i))
            small.append(chosen)
        text, hashes = np.concatenate(owner), np.concatenate(small)
        # A text of a few bytes or only dull windows has itself as its feature.
        whole = np.setdiff1d(np.flatnonzero(sizes > 0), text)
        own = np.array([int.from_bytes(hashlib.blake2b(part[i], digest_size=8).digest(), "little") for i in whole.tolist()], np.uint64)
        text, hashes = np.concatenate([text, whole]), np.concatenate([hashes, own])
        # A feature that a text has again is inserted once.
        order = np.sort(np.unique(hashes ^ mix64(text.astype(np.uint64) + np.uint64(1)), return_index=True)[1])
        order = order[np.argsort(text[order], kind="stable")]
        text, hashes = text[order], hashes[order]
        first = np.searchsorted(text, np.arange(len(part) + 1))
        number = (np.arange(len(text)) - first[text]) // FILTER_FEATURES
        chains = -(-np.diff(first) // FILTER_FEATURES)
        base = np.cumsum(chains) - chains
        bits = np.zeros(int(chains.sum()) * FILTER_BITS, bool)
        row = (base[text] + number) * FILTER_BITS if len(text) else np.zeros(0, np.int64)
        for k in range(HASHES):
            bits[row + ((hashes >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
        packed = np.packbits(bits.reshape(-1, FILTER_BITS), axis=1)
        found += [packed[b:b + n] for b, n in zip(base.tolist(), chains.tolist())]
    return found


def encoded(chain: np.ndarray) -> str:
    """The filters in base64, with a dot between them; empty for no filter."""
    return ".".join(base64.b64encode(row.tobytes()).decode() for row in chain)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """From 0 to 1: shared bits beyond chance, as a share of the most there can be.

    Each filter of the shorter chain is held against its best match in the other, weighted by
    its bits. Two empty chains are alike, an empty one and another are not.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    size_a, size_b = np.bitwise_count(a).sum(axis=1, dtype=np.int64), np.bitwise_count(b).sum(axis=1, dtype=np.int64)
    total = 0.0
    for row, size in zip(a, size_a):
        shared = np.bitwise_count(b & row).sum(axis=1, dtype=np.int64)
        chance, most = size * size_b / FILTER_BITS, np.minimum(size, size_b)
        total += size * float(np.clip((shared - chance) / np.maximum(most - chance, 1e-9), 0, 1).max())
    return total / float(size_a.sum())


def corpus_ranks(docs: DataFrame, text: str) -> np.ndarray:
    """Ranks of the windows' entropies, from counts over all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(PAIRS + 1, np.int64)
        for batch in batches:
            total += entropy_counts([t or b"" for t in batch.column(0).to_pylist()])
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["pairs", "n"])

    # One row per number of pairs, so a fixed number of rows reaches the driver.
    rows = docs.select(F.col(text).cast("binary")).mapInArrow(count, "pairs long, n long").groupBy("pairs").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(PAIRS + 1, np.int64)
    for row in rows:
        counts[row["pairs"]] = row["n"]
    return ranks(counts)


def _ordered(docs: DataFrame) -> DataFrame:
    """Rows dealt out by ranges of ``place`` and sorted there, the first of the next range as a guest.

    The driver holds a place per range, ``MOST_BUCKETS`` at most.
    """
    count = docs.count()
    ranges = min(MOST_BUCKETS, max(1, count // BUCKET_ROWS))

    def dealt(rows: DataFrame, firsts: Sequence[float]) -> DataFrame:
        if len(firsts) < 2:
            return rows.withColumn("bucket", F.lit(0))
        inner = sorted({float(f) for f in firsts[1:]})
        keyed = rows.withColumn("at", F.col("place").cast("double"))
        keyed = Bucketizer(splits=[-float("inf"), *inner, float("inf")], inputCol="at", outputCol="b").transform(keyed)
        return keyed.withColumn("bucket", F.col("b").cast("int")).drop("at", "b")

    places = docs.select("place")
    wanted = [k / ranges for k in range(ranges)]
    quantiles = places.agg(F.percentile_approx("place", wanted, 100 * ranges + 10_000)).first()[0] if count else None
    found = dealt(places, quantiles or []).groupBy("bucket").agg(F.min("place").alias("first")).collect()
    firsts = sorted(row["first"] for row in found)  # each range begins with a document: none is empty
    rows = dealt(docs, firsts)
    guests = rows.filter(F.col("place").isin(firsts)).withColumn(
        "bucket", F.pmod(F.col("bucket") - 1, F.lit(max(1, len(firsts)))).cast("int")) if firsts else rows.filter("false")
    return (
        rows.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))
        .repartition("bucket").sortWithinPartitions("bucket", "guest", "place", "text"))


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document, with its fingerprint, that of its edited text, and their likeness.

    The edited text has the last half of the code points (rounded down) replaced by the first as
    many, or all, of the next document by ascending id; the first follows the last. A null text
    counts as empty; its fingerprint is empty. Null ids come first; rows that repeat an id follow
    each other by text. A single document is its own next. Other columns are ignored. An empty
    table gives an empty result. Equal texts have equal fingerprints.

    Entropies are ranked by their counts over all documents. Documents meet their next one by
    ranges of the id, each sorted and streamed in a task of its own.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("place"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))
    rank = corpus_ranks(rows, "text")

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the row whose next one is still to come
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(4)]
            encoded_texts = [t.encode("utf-8", "surrogatepass") for t in columns[3]]
            rows = held + list(zip(*columns, filters(encoded_texts, rank)))
            pairs = [(a, b) for a, b in zip(rows, rows[1:]) if not a[2] and a[1] == b[1]]
            held = rows[-1:]
            if pairs:
                yield _result(pairs, rank)

    return _ordered(rows).select("doc_id", "bucket", "guest", "text").mapInArrow(paired, RESULT)


def _result(pairs: list[tuple], rank: np.ndarray) -> pa.RecordBatch:
    edited = []
    for a, b in pairs:
        half = len(a[3]) // 2
        edited.append((a[3][:len(a[3]) - half] + b[3][:half]).encode("utf-8", "surrogatepass"))
    chains = filters(edited, rank)
    return pa.RecordBatch.from_arrays([
        pa.array([a[0] for a, _ in pairs], pa.int64()),
        pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
        pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
        pa.array([encoded(a[4]) for a, _ in pairs], pa.string()),
        pa.array([encoded(c) for c in chains], pa.string()),
        pa.array([likeness(a[4], c) for (a, _), c in zip(pairs, chains)], pa.float64()),
        pa.array([likeness(a[4], b[4]) for a, b in pairs], pa.float64()),
    ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
