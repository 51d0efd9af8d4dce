"""Language identification with error-correcting output codes.

Each language has a codeword of bits. For each bit a binary classifier over hashed n-grams
tells languages with a one from those with a zero. A text's bits are decoded to the codeword
with the least loss, each bit's loss weighted by how well its classifier does on what it was
fitted on; if the second best is nearly as near, the answer is flagged as ambiguous.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixeltally.llm.common import Batches, collected, freed
from pixeltally.llm.words import chunks

UNKNOWN = "und"
FEATURES = 4096
ROWS_PER_LANGUAGE = 1500
MOST_LANGUAGES = 500
FIT_BYTES = 128 << 20
MOST_BITS = 63
STEPS = 200
AMBIGUOUS = 0.05
AT_ONCE = 512
FEATURE_BYTES = 256 << 10

_LETTER = regex.compile(r"\p{L}")
_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}']+")
_ASCII_WORD = bytes(c if chr(c).isalpha() or c == 39 or c >= 128 else 32 for c in range(256))


def codewords(languages: int, seed: int = 0, most_bits: int = MOST_BITS) -> np.ndarray:
    """A row of +1 and -1 for each language.

    Up to seven languages get the exhaustive code: every way to part them in two, once. For
    more, bits are seeded halvings, as many as ten times the logarithm of the languages.
    """
    if languages < 2:
        return np.ones((languages, 1))
    if languages <= 7:
        bits = [b for b in itertools.product((1, -1), repeat=languages) if b[0] == 1 and -1 in b]
        return np.array(bits, float).T
    random = np.random.default_rng(seed)
    half = np.where(np.arange(languages) % 2, 1.0, -1.0)
    count = min(most_bits, int(np.ceil(10 * np.log2(languages))))
    return np.stack([random.permutation(half) for _ in range(count)], axis=1)


def normalized(text: str) -> bytes:
    """Lower-cased letters, other characters as one space between words."""
    text = text.lower()
    if text.isascii():
        return b" " + b" ".join(text.encode().translate(_ASCII_WORD).split()) + b" "
    return (" " + _NOT_LETTERS.sub(" ", text).strip() + " ").encode()


def features(texts: Sequence[bytes], size: int = FEATURES) -> np.ndarray:
    """For each normalized text its hashed counts of runs of one to four bytes, damped and of length 1."""
    found = np.zeros((len(texts), size), np.float32)
    for low, high in chunks(texts, FEATURE_BYTES):
        buffer = np.frombuffer(b"".join(texts[low:high]) + b"   ", np.uint8).astype(np.uint32)
        at = np.cumsum([0] + [len(t) for t in texts[low:high]])
        grams = np.zeros(len(buffer) - 3, np.uint32)
        counts = []
        for n in range(1, 5):
            grams = grams * np.uint32(257) + buffer[n - 1:n - 1 + len(grams)] + np.uint32(1)
            mixed = grams * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x2C1B3C6D)
            counts.append((mixed >> np.uint32(20)) % np.uint32(size) if size <= 4096 else (mixed >> np.uint32(8)) % np.uint32(size))
        for i in range(high - low):
            row = np.zeros(size)
            for n, gram in enumerate(counts):
                # A run that reaches beyond its text isn't counted.
                row += np.bincount(gram[at[i]:max(at[i], at[i + 1] - n)], minlength=size)
            np.sqrt(row, out=row)
            found[low + i] = row / (np.sqrt((row * row).sum()) or 1)
    return found


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray      # languages x bits
    weights: np.ndarray    # features x bits
    intercepts: np.ndarray
    reliability: np.ndarray  # weight of each bit's loss
    ambiguous: float = AMBIGUOUS

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each row the number of the nearest codeword, its score from 0 to 1, and whether it is ambiguous."""
        margins = x @ self.weights + self.intercepts
        # Logistic loss of each bit under each codeword, weighted.
        losses = np.logaddexp(0, -margins[:, None, :] * self.codes[None]) @ self.reliability
        likely = np.exp(losses.min(axis=1, keepdims=True) - losses)
        likely /= likely.sum(axis=1, keepdims=True)
        best = losses.argmin(axis=1)
        score = likely[np.arange(len(x)), best]
        second = np.sort(likely, axis=1)[:, -2] if len(self.languages) > 1 else np.zeros(len(x))
        return best, score, score - second < self.ambiguous


def fit_codes(x: np.ndarray, y: np.ndarray, languages: list[str], steps: int = STEPS) -> Model:
    """Logistic regression for each bit, by accelerated gradient descent over all bits at once."""
    codes = codewords(len(languages))
    goal = codes[y]
    share = np.bincount(y, minlength=len(languages)).astype(float)
    rows = (1 / np.maximum(share, 1))[y]  # each language counts alike
    rows = (rows / rows.sum())[:, None].astype(np.float32)
    weights = np.zeros((x.shape[1], codes.shape[1]), np.float32)
    intercepts = np.zeros(codes.shape[1], np.float32)
    ahead_w, ahead_b, rate, ridge = weights, intercepts, 8.0, 1e-5
    for step in range(steps):
        margins = x @ ahead_w + ahead_b
        slope = (-goal / (1 + np.exp(np.clip(goal * margins, -30, 30)))).astype(np.float32) * rows
        new_w = ahead_w - rate * (x.T @ slope + ridge * ahead_w)
        new_b = ahead_b - rate * slope.sum(axis=0)
        push = step / (step + 3)
        ahead_w, ahead_b = new_w + push * (new_w - weights), new_b + push * (new_b - intercepts)
        weights, intercepts = new_w, new_b
    right = ((x @ weights + intercepts) * goal > 0).T @ rows[:, 0]
    error = np.clip(1 - right, 1e-3, 0.499)
    reliability = np.log((1 - error) / error)
    return Model(languages, codes, weights.astype(np.float64), intercepts.astype(np.float64), reliability / reliability.mean())


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text, modulo 3, is 1: rows that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", rows_per_language: int = ROWS_PER_LANGUAGE, doc_id: str = "doc_id") -> Model:
    """Learn from labelled rows of ``docs`` with text, about ``rows_per_language`` of each language.

    Where a language has more, they are sampled evenly by a hash of id and text, so the same rows
    are taken again. The driver gets their features, never texts, of ``FIT_BYTES`` at most: many
    languages share it and have fewer rows each. Of more than ``MOST_LANGUAGES`` the most frequent are learned.
    """
    labelled = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    by_count = labelled.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang")
    counts = {r["lang"]: r["n"] for r in by_count.limit(MOST_LANGUAGES).collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.ones((0, 1)), np.zeros((FEATURES, 1)), np.zeros(1), np.ones(1))
    rows_per_language = min(rows_per_language, max(1, FIT_BYTES // (2 * FEATURES * len(languages))))
    rates = F.create_map(*[F.lit(v) for name in languages for v in (name, min(1.0, rows_per_language / counts[name]))])
    draw = F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(1 << 20)) / F.lit(float(1 << 20))

    def describe(batches: Batches) -> Batches:
        for batch in batches:
            for part in _slices(batch):
                x = features([normalized(t) for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([row.astype(np.float16).tobytes() for row in x], pa.binary())], names=["lang", "x"])

    sample = labelled.filter(draw < rates[F.col(lang)]).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = collected(sample.mapInArrow(freed(describe), "lang string, x binary"))
    x = np.stack([np.frombuffer(b, np.float16) for b in rows["x"].to_pylist()]).astype(np.float32) if rows.num_rows else np.zeros((0, FEATURES), np.float32)
    names = np.array(rows["lang"].to_pylist())
    order = np.lexsort((x[:, :8].sum(axis=1), names)) if len(names) else np.zeros(0, int)
    y = np.searchsorted(languages, names[order])
    return fit_codes(x[order], y, languages)


PREDICTED = "lang_pred string, score double, ambiguous boolean"


def _slices(batch: pa.RecordBatch) -> Batches:
    return (batch.slice(at, AT_ONCE) for at in range(0, batch.num_rows, AT_ONCE))


def _answers(known: Callable[[], Model], place: int | None) -> Callable[[Batches], Batches]:
    """Batches of ``carry`` and, where ``place`` does not tell which of its fields it is, the text.

    What a worker holds beside a batch is in proportion to ``AT_ONCE`` of its texts, and so are the batches that it returns.
    """
    def answer(batches: Batches) -> Batches:
        model = known()
        for part in (part for batch in batches for part in _slices(batch)):
            texts = (part.column(1) if place is None else part.column(0).field(place)).to_pylist()
            names, scores, flags = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
            told = [i for i, t in enumerate(texts) if t and model.languages and _LETTER.search(t)]
            if told:
                best, score, flag = model.decode(features([normalized(texts[i]) for i in told]))
                for i, b, s, f in zip(told, best.tolist(), score.tolist(), flag.tolist()):
                    names[i], scores[i], flags[i] = model.languages[b], s, f
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(flags, pa.bool_())],
                names=["carry", "lang_pred", "score", "ambiguous"])
    return answer


def predict(docs: DataFrame, model: Model, text: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """``lang_pred, score, ambiguous`` and the columns in ``carry``, one row per row of ``docs``.

    The text alone decides, the whole of it. ``und`` with score 0, not ambiguous, if the text is
    null or has no letter, or if no language was learned. Repeated rows get equal answers. Other
    columns are ignored. An empty table gives an empty result. A text that is carried goes to the workers once.
    """
    place = 1 + list(carry).index(text) if text in carry else None
    rows = docs.select(
        F.struct(F.lit(0).alias("no_column"), *carry).alias("carry"), *([F.col(text).alias("text")] if place is None else []))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # features x bits numbers
    kind = rows.schema["carry"].dataType.simpleString()
    found = rows.mapInArrow(freed(_answers(lambda: shared.value, place)), f"carry {kind}, {PREDICTED}")
    return found.select(*[F.col("carry")[name].alias(name) for name in carry], "lang_pred", "score", "ambiguous")
