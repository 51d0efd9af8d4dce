"""Substring de-duplication with fixed-block anchors.

Each document is a reference: its non-overlapping blocks of seven words are indexed. Every
rolling run of seven words of every document probes the index. Any thirteen words in a row
that two documents share hold a whole block of either, so a repeat has an anchor in both.
Around anchors the hits are extended: the thirteen-word windows that contain one are compared
exactly, and neighbouring repeated windows join to maximal exact repeats.

Hashes travel in blocks of bytes, a row per task's share of a bucket, and their answers a row per
bucket's share of a group of documents, so neither a word nor a hash is a row. A hash that several documents of one task share is sent once for all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixeltally.llm.common import stored
from pixeltally.llm.words import Words, chunks, mix64

WINDOW = 13
UNIT_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20
MOST_TASKS = 50_000     # of a shuffle; where there are more buckets, a task has several, one after another
GROUPS_OF_A_TASK = 16   # answers are a fraction of what was sent

_SHIPPED = "bucket int, known boolean, ids binary, keys binary, doc binary, pos binary, low binary, high binary, flags binary"
_FOUND = "grp int, ids binary, keys binary, doc binary, pos binary"
_PLACES = "doc_id long, key long, places binary"
_ALIGNED, _SHARED = 1, 2


def _planes(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of each value, all first bytes before all second ones: they compress well."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T[:width].tobytes()


def _values(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    found = np.zeros((planes.shape[1], 8), np.uint8)
    found[:, :width] = planes.T
    return found.view("<u8").ravel()


class Unit:
    """Documents that one task handles together."""

    def __init__(self, ids: list[int], keys: list[int], texts: list[bytes], seeds: tuple[int, ...]):
        self.ids, self.keys = np.array(ids, np.int64), np.array(keys, np.int64)
        hashes: list[list[np.ndarray]] = [[] for _ in seeds]
        counts = []
        for low, high in chunks(texts):
            words = Words(texts[low:high])
            counts.append(words.counts)
            for found, seed in zip(hashes, seeds):
                found.append(words.hashes(seed))
        self.hashes = [np.concatenate(h) for h in hashes]
        self.words = Words.__new__(Words)  # only what runs need: counts and first
        self.words.counts = np.concatenate(counts)
        self.words.first = np.concatenate([[0], np.cumsum(self.words.counts)])
        self.words.starts = self.hashes[0]

    def places(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each run within one document: the document's number and the first word's place in it, and their numbers."""
        whole = np.flatnonzero(self.words.whole(length))
        doc = self.words.text_of()[whole]
        return whole, doc


def units(batches: Iterator[pa.RecordBatch], seeds: tuple[int, ...]) -> Iterator[tuple[Unit, list[list]]]:
    """Units of about ``UNIT_BYTES`` of text; the columns after id, key and text come beside."""
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for low, high in chunks(columns[2], UNIT_BYTES):
            part = [c[low:high] for c in columns]
            yield Unit(part[0], part[1], part[2], seeds), part[3:]


def _shipped_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.bool_()] + [pa.binary()] * 7
    names = ["bucket", "known", "ids", "keys", "doc", "pos", "low", "high", "flags"]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)


def _row(unit: Unit, bucket: int, known: bool, doc, pos, low=None, high=None, flags=None) -> tuple:
    there, number = np.unique(doc, return_inverse=True)
    return (bucket, known, unit.ids[there].tobytes(), unit.keys[there].tobytes(), _planes(number, 4), _planes(pos, 4),
            b"" if low is None else _planes(low, 5), b"" if high is None else _planes(high, 8), b"" if flags is None else flags.tobytes())


def _rows(unit: Unit, buckets: int, doc, pos, low, high, flags, known) -> list[tuple]:
    """Rows to send: hashes in ``low`` order to their buckets, ``known`` hits to any."""
    bucket = ((low >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)
    edges = np.flatnonzero(np.diff(bucket, prepend=-1))
    rows = [
        _row(unit, int(bucket[a]), False, doc[a:b], pos[a:b], low[a:b], None if high is None else high[a:b], flags[a:b])
        for a, b in zip(edges, np.append(edges[1:], len(bucket)))]
    if len(known[0]):
        # Repeats are spread over the buckets by document, whatever their hash.
        spread = (unit.ids[known[0]] % buckets).astype(np.int64)
        for number in np.unique(spread).tolist():
            at = spread == number
            rows.append(_row(unit, number, True, known[0][at], known[1][at]))
    return rows


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def _probes(block: int, buckets: int) -> Callable:
    """Sends the hash of every run of ``block`` words, with whether it is an indexed block."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, _ in units(batches, (0,)):
            at, doc = unit.places(block)
            if not len(at):
                continue
            pos = at - unit.words.first[doc]
            hashes = unit.words.runs(unit.hashes[0], block)[at]
            order = np.argsort(hashes, kind="stable")
            hashes, doc, pos = hashes[order], doc[order], pos[order]
            starts = _runs(hashes)
            sizes = np.diff(np.append(starts, len(hashes)))
            aligned = np.maximum.reduceat(pos % block == 0, starts)
            shared = doc[starts] != doc[starts + sizes - 1]
            flags = (aligned * _ALIGNED + shared * _SHARED).astype(np.uint8)
            in_shared = np.repeat(shared, sizes)
            sent = ~in_shared
            sent[starts] = True
            yield _shipped_batch(_rows(
                unit, buckets, doc[sent], pos[sent], hashes[sent], None, np.repeat(flags, sizes)[sent], (doc[in_shared], pos[in_shared])))
    return send


def _windows(block: int, window: int, buckets: int) -> Callable:
    """Sends the hashes of the windows around anchors; of a window that several documents have, the smallest id's."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, (anchors,) in units(batches, (0, 1)):
            whole, doc = unit.places(window)
            if not len(whole):
                continue
            near = np.zeros(len(unit.hashes[0]) + 1, np.int32)
            for number, blob in enumerate(anchors):
                first, last = unit.words.first[number], unit.words.first[number + 1]
                # A window holds an anchor at `p` if it starts from p - (window - block) to p.
                p = np.frombuffer(blob, "<u4").astype(np.int64)
                np.add.at(near, first + np.maximum(p - (window - block), 0), 1)
                np.add.at(near, np.minimum(first + p + 1, last), -1)
            chosen = np.cumsum(near)[whole] > 0
            at, doc = whole[chosen], doc[chosen]
            if not len(at):
                continue
            pos = at - unit.words.first[doc]
            low, high = (unit.words.runs(h, window)[at] for h in unit.hashes)
            order = np.lexsort((unit.ids[doc], high, low))
            low, high, doc, pos = low[order], high[order], doc[order], pos[order]
            starts = _runs(low, high)
            least = np.repeat(unit.ids[doc[starts]], np.diff(np.append(starts, len(low))))
            repeats = unit.ids[doc] > least
            sent = ~repeats
            yield _shipped_batch(_rows(
                unit, buckets, doc[sent], pos[sent], low[sent], high[sent], np.zeros(int(sent.sum()), np.uint8), (doc[repeats], pos[repeats])))
    return send


def _anchors(low, high, ids, doc, flags) -> np.ndarray:
    """Of a bucket's probes those whose hash two documents have, as an indexed block in one of them."""
    order = np.argsort(low, kind="stable")
    starts = _runs(low[order])
    sizes = np.diff(np.append(starts, len(low)))
    marks = np.bitwise_or.reduceat(flags[order], starts)
    several = np.minimum.reduceat(doc[order], starts) != np.maximum.reduceat(doc[order], starts)
    hit = (marks & _ALIGNED > 0) & (several | (marks & _SHARED > 0))
    return order[np.repeat(hit, sizes)]


def _repeats(low, high, ids, doc, flags) -> np.ndarray:
    """Of a bucket's windows those that also start in a document with a smaller id."""
    order = np.lexsort((ids, high, low))
    starts = _runs(low[order], high[order])
    least = np.repeat(ids[order][starts], np.diff(np.append(starts, len(low))))
    return order[ids[order] > least]


def _resolved(decide: Callable, groups: int) -> Callable:
    """For a bucket: the places of its hits, a row per group of documents."""
    def resolve(group: pa.Table) -> pa.Table:
        parts: dict[str, list[np.ndarray]] = {name: [] for name in ("low", "high", "doc", "pos", "flags", "ids", "keys")}
        known: list[tuple] = []
        base = 0
        for row in group.to_pylist():
            ids, keys = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["keys"], np.int64)
            doc, pos = _values(row["doc"], 4).astype(np.int64) + base, _values(row["pos"], 4)
            parts["ids"].append(ids)
            parts["keys"].append(keys)
            base += len(ids)
            if row["known"]:
                known.append((doc, pos))
                continue
            parts["doc"].append(doc)
            parts["pos"].append(pos)
            parts["low"].append(_values(row["low"], 5))
            parts["high"].append(_values(row["high"], 8) if row["high"] else np.zeros(0, "<u8"))
            parts["flags"].append(np.frombuffer(row["flags"], np.uint8))
        joined = {name: np.concatenate(p) if p else np.zeros(0, np.int64) for name, p in parts.items()}
        doc, pos = joined["doc"], joined["pos"]
        if len(doc):
            hits = decide(joined["low"], joined["high"], joined["ids"][doc], doc, joined["flags"])
            doc, pos = doc[hits], pos[hits]
        doc, pos = np.concatenate([doc, *[k[0] for k in known]]), np.concatenate([pos, *[k[1] for k in known]])
        rows = []
        if len(doc):
            ids, keys = joined["ids"], joined["keys"]
            group_of = (mix64(ids.view(np.uint64)) % np.uint64(groups)).astype(np.int32)[doc]
            order = np.lexsort((pos, doc, group_of))
            doc, pos, group_of = doc[order], pos[order], group_of[order]
            starts = _runs(group_of)
            for a, b in zip(starts, np.append(starts[1:], len(doc))):
                there, number = np.unique(doc[a:b], return_inverse=True)
                rows.append((int(group_of[a]), ids[there].tobytes(), keys[there].tobytes(), _planes(number, 4), _planes(pos[a:b], 4)))
        types = [pa.int32()] + [pa.binary()] * 4
        return pa.table({name: pa.array([r[k] for r in rows], types[k]) for k, name in enumerate(("grp", "ids", "keys", "doc", "pos"))})
    return resolve


def _merged(group: pa.Table) -> pa.Table:
    """For a group of documents a row each, with all its places in order."""
    ids, keys, docs, places, base = [], [], [], [], 0
    for row in group.to_pylist():
        ids.append(np.frombuffer(row["ids"], np.int64))
        keys.append(np.frombuffer(row["keys"], np.int64))
        docs.append(_values(row["doc"], 4).astype(np.int64) + base)
        places.append(_values(row["pos"], 4))
        base += len(ids[-1])
    ids, keys, doc, pos = (np.concatenate(x) for x in (ids, keys, docs, places))
    order = np.lexsort((keys, ids))
    starts = _runs(ids[order], keys[order])
    number = np.empty(len(ids), np.int64)
    number[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(ids))))
    ids, keys = ids[order[starts]], keys[order[starts]]
    doc = number[doc]
    order = np.lexsort((pos, doc))
    pos = pos[order].astype("<u4")
    offsets = np.searchsorted(doc[order], np.arange(len(ids) + 1)).astype(np.int32) * 4
    blobs = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(pos.tobytes())])
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "key": pa.array(keys, pa.int64()), "places": blobs})


def _per_document(sent: DataFrame, decide: Callable, groups: int, name: str) -> DataFrame:
    """The places that ``decide`` finds, a row per document. There are as many tasks as buckets, so a task's
    share does not grow with the texts, whatever number of shuffle partitions the session has."""
    found = sent.repartition(min(groups, MOST_TASKS), "bucket").groupBy("bucket").applyInArrow(_resolved(decide, groups), _FOUND)
    dealt = found.repartition(min(-(-groups // GROUPS_OF_A_TASK), MOST_TASKS), "grp")
    return stored(dealt.groupBy("grp").applyInArrow(_merged, _PLACES), name)


def _kept(window: int) -> Callable:
    """Cuts the repeated windows out of each document."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, removed, texts, spans = [], [], [], []
            for text, places in zip(batch.column(1), batch.column(2)):
                words = (text.as_py() or b"").split()
                blob = places.as_py()
                if blob:
                    at = np.frombuffer(blob, "<u4").astype(np.int64)
                    cover = np.zeros(len(words) + 1, np.int64)
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + window, -1)
                    covered = np.cumsum(cover)[:-1] > 0
                    edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
                    spans.append([{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()])
                    removed.append(int(covered.sum()))
                    texts.append(b" ".join([w for w, c in zip(words, covered.tolist()) if not c]).decode("utf-8", "replace"))
                else:
                    spans.append([])
                    removed.append(0)
                    texts.append(b" ".join(words).decode("utf-8", "replace"))
                totals.append(len(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["doc_id", "n_words", "n_removed", "text", "removed"])
    return cut


def drop_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, text, removed``.

    A word goes if a window of ``window`` words covers it whose words also stand in a row in a
    document with a smaller id. ``text`` holds the words that stay, joined by one space;
    ``removed`` the maximal repeats, as ranges of word numbers: repeated windows that overlap or
    touch are one range, and the words beside a range are in no repeated window. Windows are judged on the input.
    A null or empty text has no words. Rows that repeat an id don't count as smaller for each
    other. Rows without an id lose nothing and take nothing from others. Other columns are
    ignored. An empty table gives an empty result.

    Candidates are found by 64-bit hashes, which may give a few too many; windows are compared by
    104 bits or more of two hashes. The index and the probes are split into buckets by hash, as many as
    the size of the texts asks for; a very common passage reaches its bucket once per unit of
    ``UNIT_BYTES``, and answers go back by group of documents.
    """
    block = (window + 1) // 2
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("key"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    named = rows.filter("doc_id IS NOT NULL AND octet_length(text) > 0")
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))

    probes = named.mapInArrow(_probes(block, buckets), _SHIPPED)
    anchors = _per_document(probes, _anchors, buckets, "anchors")
    windows = named.join(anchors, ["doc_id", "key"]).select("doc_id", "key", "text", "places").mapInArrow(
        _windows(block, window, buckets), _SHIPPED)
    repeats = _per_document(windows, _repeats, buckets, "repeats")
    return rows.join(repeats, ["doc_id", "key"], "left").select("doc_id", "text", "places").mapInArrow(
        _kept(window), "doc_id long, n_words long, n_removed long, text string, removed array<struct<start: long, end: long>>")
