"""Near-duplicate documents by circulant MinHash, banding and exact verification.

A document is its set of word shingles. One permutation scatters the shingles; a second one,
shifted by one place for each coordinate, orders them, and the least is the coordinate. Bands
of coordinates put likely pairs in a bucket. Links are confirmed on the full sets. Of a bucket
only pairs with its first member are tried at first, so a group of copies costs a pair for each
member. Members that are then still unconnected meet those of other components in blocks of a bounded
size, where their pairs are tried on the full sets and only links come out, so none is lost.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixeltally.llm.common import freed, stored
from pixeltally.llm.components import components
from pixeltally.llm.words import LOWER, Words, chunks, mix64

SHINGLE = 5
PERCENT = 80
BAND_ROWS = 5
# A pair at the threshold is missed in all bands with less than this probability.
MISS = 1e-6
BLOCK = 256  # members of a bucket that meet as many others in one group, if their sets are no longer than
BLOCK_SHINGLES = 1 << 21  # so many shingles on the whole
UNLIKELY = 1e-9  # with this probability a pair at the threshold is ruled out by its signatures
_ELEMENTS = 1 << 16


def bands_for(percent: int, rows: int = BAND_ROWS, miss: float = MISS) -> int:
    """Bands needed so that a pair at the threshold shares one but for a chance of ``miss``."""
    return int(np.ceil(np.log(miss) / np.log1p(-(percent / 100) ** rows)))


def shingle_sets(texts: Sequence[bytes], size: int) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles of lower-cased words.

    A text with fewer words than ``size`` has all of them as one shingle, one without words none.
    """
    found: list[np.ndarray] = []
    for low, high in chunks(texts):
        words = Words([t.translate(LOWER) for t in texts[low:high]])
        hashes = words.hashes()
        runs = words.runs(hashes, size)
        first = words.first.tolist()
        for a, b in zip(first, first[1:]):
            if b - a >= size:
                found.append(np.unique(runs[a:b - size + 1]))
            elif b > a:
                short = np.uint64(b - a)
                for h in hashes[a:b]:
                    short = mix64(np.array([short]))[0] ^ h
                found.append(mix64(np.array([short], np.uint64)))
            else:
                found.append(np.zeros(0, np.uint64))
    return found


def _permuted(x: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """A permutation of 32-bit numbers, in place."""
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B), (16, None)):
        np.right_shift(x, np.uint32(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        if factor:
            np.multiply(x, np.uint32(factor), out=x)
    return x


def signatures(sets: Sequence[np.ndarray], coordinates: int) -> np.ndarray:
    """A row of 32-bit coordinates for each set; sets must not be empty.

    Coordinate k is the least of pi(sigma(element) - k) modulo 2**32.
    """
    found = np.empty((len(sets), coordinates), np.uint32)
    start = 0
    while start < len(sets):
        end, total = start + 1, len(sets[start])
        while end < len(sets) and total + len(sets[end]) <= _ELEMENTS:
            total += len(sets[end])
            end += 1
        elements = np.concatenate(sets[start:end])
        firsts = np.cumsum([0] + [len(s) for s in sets[start:end - 1]])
        scattered = (mix64(elements ^ np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
        shifted, spare = np.empty_like(scattered), np.empty_like(scattered)
        for k in range(coordinates):
            np.subtract(scattered, np.uint32(k), out=shifted)
            found[start:end, k] = np.minimum.reduceat(_permuted(shifted, spare), firsts)
        start = end
    return found


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each band of ``rows`` coordinates; bands never share keys by design."""
    bands = signature.shape[1] // rows
    found = np.tile(mix64(np.arange(1, bands + 1, dtype=np.uint64)), (len(signature), 1))
    for k in range(rows):
        found = mix64(found ^ signature[:, k:bands * rows:rows].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return found


def _fixed(data: list[bytes]) -> pa.Array:
    return pa.array(data, pa.binary())


def _sketches(shingle: int, bands: int, rows: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for low, high in chunks(texts, 4 << 20):
                sets = shingle_sets(texts[low:high], shingle)
                there = [i for i, s in enumerate(sets) if len(s)]
                digests: list = [None] * len(sets)
                marks: list = [None] * len(sets)
                keys: list = [None] * len(sets)
                if there:
                    signature = signatures([sets[i] for i in there], bands * rows)
                    by_band = band_keys(signature, rows).view(np.int64)
                    small = signature.astype(np.uint8)
                    for at, i in enumerate(there):
                        digests[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                        marks[i], keys[i] = small[at].tobytes(), by_band[at]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, high - low), pa.array([len(s) for s in sets], pa.int64()), _fixed(digests),
                    _fixed(marks), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "digest", "marks", "bands"])
    return sketch


def _sets(shingle: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for low, high in chunks(texts, 4 << 20):
                sets = [s.tobytes() for s in shingle_sets(texts[low:high], shingle)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), _fixed(sets)], names=["doc_id", "shingles"])
    return make


def _linked(percent: int):
    """Pairs whose sets have 100 * intersection >= percent * union."""
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
                if len(a) > len(b):
                    a, b = b, a
                at = np.searchsorted(b, a)
                common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))
    return confirm


@lru_cache
def least_alike(percent: int, coordinates: int, unlikely: float = UNLIKELY) -> int:
    """The most coordinates that a pair at the threshold shares, but for a chance of ``unlikely``: the exact binomial tail."""
    p, tail = percent / 100, 0.0
    for equal in range(coordinates + 1):
        tail += math.comb(coordinates, equal) * p ** equal * (1 - p) ** (coordinates - equal)
        if tail > unlikely:
            return equal
    return coordinates


def _alike(marks_a: np.ndarray, marks_b: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs the signatures don't rule out. Marks are bytes of coordinates, so they agree at least as often."""
    return (marks_a == marks_b).sum(axis=-1) >= least_alike(percent, marks_a.shape[-1])


def _likely(percent: int):
    """Pairs that sizes and signatures don't rule out."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes_a, sizes_b = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            marks = [np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for k in (4, 5)]
            keep = _sizes_fit(sizes_a, sizes_b, percent) & _alike(*marks, percent)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(keep))
    return check


def _sizes_fit(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


_BLOCKED = "band long, number int, low int, high int, block int, node long, label long, n_shingles long, marks binary, keys array<long>"


def _candidates(group: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of two blocks of a bucket, for each member of one those of the other that are in
    another component and that sizes and signatures don't rule out. A pair that shares
    several bands is a candidate in the first of them only, by the keys that make the buckets."""
    low, high, number = (group[name][0].as_py() for name in ("low", "high", "number"))
    block, node, label, size = (group[name].to_numpy() for name in ("block", "node", "label", "n_shingles"))
    marks = np.frombuffer(b"".join(group["marks"].to_pylist()), np.uint8).reshape(len(node), -1)
    keys = group["keys"].combine_chunks().flatten().to_numpy().reshape(len(node), -1)
    a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
    for i in a.tolist():
        other = b[(label[b] != label[i]) & _sizes_fit(size[b], size[i], percent)]
        if low == high:
            other = other[node[other] > node[i]]
        if len(other):
            other = other[_alike(marks[other], marks[i], percent)]
            other = other[(keys[other] == keys[i]).argmax(axis=1) == number]
        if len(other):
            yield i, other


def _with_partner(percent: int):
    """The members that are in any candidate pair; the pairs themselves go nowhere."""
    def keep(group: pa.Table) -> pa.Table:
        wanted = np.zeros(group.num_rows, bool)
        for i, other in _candidates(group, percent):
            wanted[i] = True
            wanted[other] = True
        return group.filter(pa.array(wanted))
    return keep


def _links_between(percent: int):
    """Links between components, confirmed on the full sets where they meet; one that connects
    nothing new is left out."""
    def confirm(group: pa.Table) -> pa.Table:
        node, label = group["node"].to_pylist(), group["label"].to_pylist()
        sets = [np.frombuffer(s, np.uint64) for s in group["shingles"].to_pylist()]
        bounds = np.cumsum([0] + [len(s) for s in sets]).tolist()
        elements, flat = np.unique(np.concatenate(sets), return_inverse=True)
        held = np.zeros(len(elements), bool)
        root = {x: x for x in label}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        found = []
        for i, others in _candidates(group, percent):
            own = flat[bounds[i]:bounds[i + 1]]
            held[own] = True
            for j in others.tolist():
                if (mine := find(label[i])) != (theirs := find(label[j])):
                    common = int(held[flat[bounds[j]:bounds[j + 1]]].sum())
                    if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                        found.append((node[i], node[j]))
                        root[max(mine, theirs)] = min(mine, theirs)
            held[own] = False
        return pa.table({"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())})
    return confirm


def _blocks(labelled: DataFrame) -> DataFrame:
    """Members of buckets that are not connected yet, a row for each pair of blocks that they meet in: ``low, high, block`` beside their columns.

    ``labelled`` has ``band, label, n_shingles`` and more. Pairs within a label need no comparison, so the members of a bucket's
    most frequent label meet the others only, and these meet all: with m others, a bucket of n
    members makes rows in proportion to n and to m / ``BLOCK``, one for each member if a single one is unconnected.
    """
    labels = labelled.groupBy("band", "label").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    most = F.max_by(F.struct("label", "n", "s"), F.struct("n", "label"))
    mixed = stored(
        labels.groupBy("band").agg(most.alias("most"), F.sum("n").alias("n"), F.sum("s").alias("s")).filter("n > most.n")
        .select("band", F.col("most")["label"].alias("most"),
                _number(F.col("n") - F.col("most")["n"], F.col("s") - F.col("most")["s"]).alias("others"),
                _number(F.col("most")["n"], F.col("most")["s"]).alias("rest")), "mixed")
    rows = labelled.join(mixed, "band")
    # Blocks of the others come first, then those of the most frequent label.
    place, is_most = F.xxhash64("node"), F.col("label") == F.col("most")
    block = F.when(is_most, F.col("others") + F.pmod(place, F.col("rest"))).otherwise(F.pmod(place, F.col("others")))
    last = F.when(is_most, F.col("others")).otherwise(F.col("others") + F.col("rest")) - 1
    rows = rows.withColumn("block", block.cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    return rows.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other", "most", "others", "rest")


def _number(members: Column, shingles: Column) -> Column:
    """How many blocks members with so many shingles are dealt to."""
    return F.greatest(F.ceil(members / BLOCK), F.ceil(shingles / BLOCK_SHINGLES))


def near_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, percent: int = PERCENT,
                rows: int = BAND_ROWS, miss: float = MISS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked if 100 * intersection >= ``percent`` * union of their shingle sets;
    ``component_id`` is the smallest id that a document reaches over links, and its row is kept.
    A document without words, or with a null text, is linked with nothing. Rows that repeat an id
    are one document. Rows without an id are linked with nothing, have no component and are kept.
    Other columns are ignored. An empty table gives an empty result.

    Documents with equal sets are one node from the start, whatever their number. Shingles are
    compared by 64-bit hashes. A pair at the threshold is found but for a chance of ``miss`` and of ``UNLIKELY``.
    """
    bands = bands_for(percent, rows, miss)
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    sketch = stored(named.mapInArrow(
        freed(_sketches(shingle, bands, rows)), "doc_id long, n_shingles long, digest binary, marks binary, bands array<long>"), "sketches")
    # One node for equal sets. What any of them has beside its id is the same.
    nodes = stored(
        sketch.filter("doc_id IS NOT NULL AND digest IS NOT NULL").groupBy("digest").agg(
            F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("marks").alias("marks"),
            F.first("bands").alias("bands")), "nodes")
    keyed = nodes.select("node", F.posexplode("bands").alias("number", "band"))
    buckets = stored(
        keyed.groupBy("band").agg(F.min("node").alias("first"), F.count("*").alias("members")).filter("members > 1"), "buckets")
    members = stored(keyed.join(buckets, "band"), "members")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        return _confirmed(named, pairs, name, shingle, percent)

    stars = members.filter("node <> first").select(F.col("first").alias("u"), F.col("node").alias("v")).distinct()
    about = nodes.select("node", "n_shingles", "marks")
    with_u = stars.join(about.toDF("u", "n_u", "m_u"), "u")
    likely = with_u.join(about.toDF("v", "n_v", "m_v"), "v").select("u", "v", "n_u", "n_v", "m_u", "m_v").mapInArrow(
        freed(_likely(percent)), "u long, v long")
    links = confirmed(stored(likely, "stars"), "stars")
    labels = stored(components(links), "labels")

    # Buckets whose members aren't all connected by now: their other pairs, block by block.
    labelled = members.join(labels, "node", "left").select(
        "band", "number", "node", F.coalesce("component", "node").alias("label")).join(nodes.select("node", "n_shingles"), "node")
    split = _blocks(labelled).join(nodes.select("node", "marks", F.col("bands").alias("keys")), "node").select(
        "band", "number", "low", "high", "block", "node", "label", "n_shingles", "marks", "keys")
    pair = ["band", "low", "high"]
    rest = stored(split.groupBy(*pair).applyInArrow(_with_partner(percent), _BLOCKED), "rest")
    if not rest.isEmpty():
        sets = _sets_of(named, rest.select("node"), "rest", shingle).withColumnRenamed("doc_id", "node")
        more = rest.join(sets, "node").groupBy(*pair).applyInArrow(_links_between(percent), "u long, v long")
        links = links.unionByName(stored(more, "rest-links"))
        labels = stored(components(links), "labels")

    grouped = stored(
        nodes.select("digest", "node").join(labels, "node", "left")
        .select("digest", F.coalesce("component", "node").alias("component_id")), "groups")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        sketch.select("doc_id", "n_shingles", "digest").join(grouped, "digest", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), component))
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def _sets_of(named: DataFrame, ids: DataFrame, name: str, shingle: int) -> DataFrame:
    """``doc_id, shingles`` of the documents in ``ids``."""
    wanted = stored(ids.toDF("doc_id").distinct(), f"{name}-wanted")
    return stored(
        named.join(wanted, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(freed(_sets(shingle)), "doc_id long, shingles binary")
        .filter("octet_length(shingles) > 0"), f"{name}-sets")


def _confirmed(named: DataFrame, pairs: DataFrame, name: str, shingle: int, percent: int) -> DataFrame:
    """The links among ``pairs``, by the full sets of the documents in them."""
    sets = _sets_of(named, pairs.select(F.explode(F.array("u", "v"))), name, shingle)
    with_v = pairs.join(sets.toDF("v", "shingles_v"), "v")
    both = with_v.join(sets.toDF("u", "shingles_u"), "u").select("u", "v", "shingles_u", "shingles_v")
    return stored(both.mapInArrow(freed(_linked(percent)), "u long, v long").distinct(), f"{name}-links")
