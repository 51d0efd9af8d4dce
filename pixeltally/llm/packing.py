"""Best-fit packing of token sequences, with the best-two-fit improvement.

Documents are tokenized, ended by a separator id, and cut only where they are longer than a
sequence. Pieces are dealt to packing groups of a bounded size, and each group packs its
pieces greedily, longest first into the fullest bin with room. A bin that is then left with
a gap gives up its smallest document for two unpacked ones that fill the larger gap better.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixeltally.llm.common import freed, stored
from pixeltally.llm.words import chunks

CAPACITY = 2048
SEPARATOR = 0
GROUP_PIECES = 200_000
CACHED_WORDS = 600_000
BATCH_BYTES = 2 << 20

# From texts to their ids, as bytes of little-endian unsigned 32-bit numbers.
Tokenize = Callable[[list[str]], list[bytes]]
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
# The pattern that the word tokenizer splits at, and what its special tokens begin with.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPECIAL = "<|"
WORD_END = "</w>"
# Marks that words often end in; each is a word of its own after a letter.
MARKS = tuple(".,;:!?")


class WordTokenizer:
    """The ids of texts as bytes (little-endian unsigned 32-bit), each word looked up once.

    The tokenizer's splitting pattern takes no white space, and its normalizer changes nothing
    across a space, so the ids of a text are those of its parts between spaces and line breaks. It
    lower-cases too, so texts of Latin-1 characters are lower-cased at once, and a word with a mark at its end
    has the ids of the word and those of the mark; only the word is cached. Parts that are not in the bounded cache are
    encoded together, as one text, and told apart by the ids that end a word. A text with the beginning of a special
    token goes to the tokenizer whole.
    """

    def __init__(self, path: str, cached: int | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pattern = regex.compile(SPLIT)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[number for token, number in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.cached = cached
        self.marks = {mark: self._ids(mark).tobytes() for mark in MARKS}
        self.known: dict[str, bytes] = {}
        self.former: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _words(self, part: str) -> int:
        """How many words the tokenizer splits a part into; one where all are letters."""
        if part.isalpha():
            return 1
        return len(self.pattern.findall(part.lower() if part.isascii() else self.tokenizer.normalizer.normalize_str(part)))

    def _encode(self, parts: list[str]) -> None:
        """Add parts to the cache."""
        counts = [self._words(part) for part in parts]
        ids = self._ids(" ".join(parts))
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) == sum(counts) and (not len(ids) or ends[-1] == len(ids)):
            bounds = (4 * np.append(0, ends)[np.cumsum([0, *counts])]).tolist()
            data = ids.tobytes()
            self.known.update(zip(parts, [data[a:b] for a, b in zip(bounds, bounds[1:])]))
        else:  # a part that the pattern and the tokenizer don't split alike
            self.known.update((p, self._ids(p).tobytes()) for p in parts)

    def _learn(self, parts: set[str]) -> None:
        new = sorted(parts)
        for at in range(0, len(new), 5000):
            self._encode(new[at:at + 5000])

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Texts are split, numbered by their different parts and joined again as arrays, all at once."""
        plain = [i for i, text in enumerate(texts) if SPECIAL not in text]
        spaced = pa.array([_lower(texts[i]).replace("\n", " ") for i in plain], pa.large_string())
        split = pc.split_pattern(spaced, " ")
        numbered = split.flatten().dictionary_encode()
        parts = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > (self.cached or CACHED_WORDS) // 2:  # what is met again comes back from the former half
            self.former, self.known = self.known, {}
        marked = [i for i, p in enumerate(parts) if p.endswith(MARKS) and p[:-1].isalpha()]
        marks = [self.marks[parts[i][-1]] for i in marked]
        for i in marked:
            parts[i] = parts[i][:-1]
        missing = {p for p in parts if p not in self.known}
        self.known.update([(p, self.former[p]) for p in missing if p in self.former])
        self._learn({p for p in missing if p not in self.known})
        found = list(map(self.known.__getitem__, parts))
        for i, mark in zip(marked, marks):
            found[i] += mark
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        of = numbered.indices.to_numpy()
        flat = np.frombuffer(b"".join(found), "<u4")
        each, starts = lengths[of], (np.cumsum(lengths) - lengths)[of]
        before = np.cumsum(each) - each
        ids = flat[np.repeat(starts - before, each) + np.arange(int(each.sum()))]
        bounds = np.append(0, np.cumsum(each))[split.offsets.to_numpy()] * 4
        data, result = ids.tobytes(), [b""] * len(texts)
        for i, low, high in zip(plain, bounds.tolist(), bounds[1:].tolist()):
            result[i] = data[low:high]
        for i in set(range(len(texts))).difference(plain):
            result[i] = self._ids(texts[i]).tobytes()
        return result


def _lower(text: str) -> str:
    """Lower case where that can't depend on a version of Unicode or on neighbours: Latin-1 alone."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


@lru_cache(maxsize=2)
def word_tokenizer(path: str, cached: int | None = None) -> WordTokenizer:
    """One for each Python worker; its path is read on the worker."""
    return WordTokenizer(path, cached)


def pieces(docs: DataFrame, tokenize: Tokenize, capacity: int = CAPACITY, separator: int = SEPARATOR,
           text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``."""
    end = np.array([separator], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            names, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for low, high in chunks(texts, BATCH_BYTES):
                for name, ids in zip(names[low:high], tokenize(texts[low:high])):
                    ids += end
                    for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[at:at + 4 * capacity]
                        rows.append((name, number, at // 4, len(piece) // 4, zlib.crc32(piece)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate([pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()])],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(freed(cut), PIECES)


class _Pool:
    """Pieces not packed yet, by length."""

    def __init__(self, lengths: np.ndarray):
        order = np.argsort(lengths, kind="stable")
        self.rows: dict[int, list[int]] = {}
        for row, length in zip(order.tolist(), lengths[order].tolist()):
            self.rows.setdefault(length, []).append(row)
        self.lengths = sorted(self.rows)

    def __bool__(self) -> bool:
        return bool(self.lengths)

    def fitting(self, room: int) -> int:
        """The greatest length of at most ``room``; 0 if there is none."""
        at = bisect_right(self.lengths, room)
        return self.lengths[at - 1] if at else 0

    def count(self, length: int) -> int:
        return len(self.rows.get(length, ()))

    def take(self, length: int) -> int:
        rows = self.rows[length]
        row = rows.pop()
        if not rows:
            del self.rows[length]
            del self.lengths[bisect_left(self.lengths, length)]
        return row

    def put(self, length: int, row: int) -> None:
        if length not in self.rows:
            self.rows[length] = []
            insort(self.lengths, length)
        self.rows[length].append(row)


def best_pair(pool: _Pool, room: int, above: int) -> tuple[int, int] | None:
    """Two unpacked lengths with the greatest sum of at most ``room`` and over ``above``, if any."""
    best, found = above, None
    lengths = pool.lengths
    low, high = 0, bisect_right(lengths, room) - 1
    while low <= high:
        short, long = lengths[low], lengths[high]
        total = short + long
        if total > room or low == high and pool.count(short) < 2:
            high -= 1
            continue
        if total > best:
            best, found = total, (short, long)
            if total == room:
                break
        low += 1
    return found


def pack(lengths: Sequence[int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset for each length, none above ``capacity``.

    Bins are filled one after another: the longest piece that still fits, again and again,
    which gives each the fullest start that single pieces allow. If a gap is left, the smallest
    document of the bin is taken out for the two unpacked ones that fill its place and the gap
    best. The result depends on the lengths and their order only.
    """
    lengths = np.asarray(lengths, np.int64)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    pool, number = _Pool(lengths), 0
    while pool:
        room, held = capacity, []
        while (fit := pool.fitting(room)):
            held.append((fit, pool.take(fit)))
            room -= fit
        if room and len(held) > 1 and pool:
            smallest, row = held[-1]
            pair = best_pair(pool, smallest + room, smallest)
            if pair:
                held.pop()
                held += [(length, pool.take(length)) for length in pair]
                pool.put(smallest, row)
        offset = 0
        for length, row in held:
            bins[row], offsets[row] = number, offset
            offset += length
        number += 1
    return bins, offsets


def packed(docs: DataFrame, tokenize: Tokenize, capacity: int = CAPACITY, separator: int = SEPARATOR,
           text: str = "text", doc_id: str = "doc_id", group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A null or empty text has the separator alone. Rows that repeat an id are documents of their
    own, each with pieces from 0. A very long text is one row to its task, like any text. Null
    ids stay null. Other columns are ignored. An empty table gives an empty result.

    Groups are dealt out by hash of id and piece; each holds about ``group_pieces`` narrow rows
    and wastes one sequence at most beside the gaps that no piece fits. Full pieces are
    sequences of their own and need no group's decision.
    """
    cut = stored(pieces(docs, tokenize, capacity, separator, text, doc_id), "pieces")
    groups = max(1, -(-cut.filter(F.col("length") < capacity).count() // group_pieces))
    dealt = cut.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))

    def pack_group(rows: pd.DataFrame) -> pd.DataFrame:
        # Sorted, so that a repeated task packs alike.
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], kind="stable").reset_index(drop=True)
        bins, offsets = pack(rows["length"].to_numpy(), capacity)
        return rows.assign(sequence_id=bins * groups + int(rows["grp"].iloc[0]), offset=offsets).drop(columns="grp")

    short = dealt.filter(F.col("length") < capacity).groupBy("grp").applyInPandas(
        pack_group, f"{PIECES}, sequence_id long, offset long")
    # Full pieces: negative numbers, by place in the stored table.
    full = cut.filter(F.col("length") == capacity).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return short.unionByName(full)
