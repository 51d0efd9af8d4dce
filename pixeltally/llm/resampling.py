"""Importance resampling of documents towards a target distribution, over hashed word n-grams.

Features of a text are its words and its pairs of neighbouring words, hashed to buckets. A bucket
gains weight by how much more frequent it is in the target than in the documents; a document's
weight is its mean gain, and the documents drawn are those with the greatest sums of weight and
seeded Gumbel noise.

Corpora repeat lines, so features are counted by segment de-duplication: line breaks cut a text into
segments, equal segments of all documents become one row with its occurrences, the buckets of a
segment are computed once, and counts and gains are multiplied by occurrences. Pairs of the last word
of a line and the first of the next one are in no segment and are added document by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixeltally.llm.common import lower_ascii, stored
from pixeltally.operators.ranking import number_in_order

BUCKETS = 10_000
PERCENT = 25
SEED = 7
LEAST_WORDS = 20

# What separates words, but for the line break: ASCII other than digits and lower-case letters.
SEPARATORS = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"


def segments(text: Column) -> Column:
    """The lines of a text that have words, each as its words joined by one space; empty for null."""
    spaced = F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS, " ")
    return F.filter(F.transform(F.split(spaced, "\n"), lambda line: F.trim(line)), lambda line: line != "")


def _bucket(feature: Column, buckets: int) -> Column:
    return (F.crc32(feature.cast("binary")) % buckets).cast("int")


def _pairs(firsts: Column, seconds: Column, buckets: int) -> Column:
    return F.zip_with(firsts, seconds, lambda a, b: _bucket(F.concat_ws(" ", a, b), buckets))


def _neighbours(items: Column, left, right, buckets: int) -> Column:
    """Buckets of the pairs that each two neighbouring items make: ``left`` of one, ``right`` of the next."""
    rest = F.greatest(F.size(items) - 1, F.lit(0))
    return _pairs(F.transform(F.slice(items, 1, rest), left), F.transform(F.slice(items, 2, rest), right), buckets)


def _key(segment: Column) -> list[Column]:
    """128 bits that tell segments apart."""
    return [F.xxhash64(segment).alias("h1"), F.xxhash64(F.lit(1), segment).alias("h2")]


class _Counted:
    """The segments and features of a table of texts.

    ``rows``: a row per document with the keys of its segments and the buckets of the pairs across
    lines. ``distinct``: a row per different segment with its buckets and occurrences.
    """

    def __init__(self, texts: DataFrame, buckets: int):
        cut = texts.select("*", segments(F.col("text")).alias("segments")).drop("text")
        # The place tells rows apart that repeat an id.
        self.rows = stored(cut.select(
            F.monotonically_increasing_id().alias("place"), *[c for c in cut.columns if c != "segments"],
            F.transform("segments", lambda s: F.struct(*_key(s))).alias("keys"),
            _neighbours(F.col("segments"), lambda s: F.substring_index(s, " ", -1), lambda s: F.substring_index(s, " ", 1), buckets)
            .alias("across")), "documents")
        counted = cut.select(F.explode("segments").alias("segment")).groupBy("segment").agg(F.count("*").alias("occurrences"))
        words = counted.select("*", F.split("segment", " ").alias("words"))
        same = lambda word: word
        self.distinct = stored(words.select(
            *_key(F.col("segment")), "occurrences", F.size("words").alias("n_words"),
            F.concat(F.transform("words", lambda w: _bucket(w, buckets)), _neighbours(F.col("words"), same, same, buckets))
            .alias("features")), "segments")

    def counts(self) -> DataFrame:
        """How often each bucket occurs: ``bucket, n``."""
        inside = self.distinct.select(F.explode("features").alias("bucket"), F.col("occurrences").alias("n"))
        across = self.rows.select(F.explode("across").alias("bucket"), F.lit(1).cast("long").alias("n"))
        return inside.unionByName(across).groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """For each bucket, a thousand times the logarithm of its smoothed share in the target over that
    in the source, floored. The list has one number per bucket, whatever the corpus is."""
    source, target = source.withColumnRenamed("n", "s"), target.withColumnRenamed("n", "t")
    every = source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(source, "bucket", "left").join(target, "bucket", "left").fillna(0, ["s", "t"])
    totals = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t")).first()
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    ratio = ((t + 1) * (totals["all_s"] + float(buckets))) / ((s + 1) * (totals["all_t"] + float(buckets)))
    gains = both.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain")).orderBy("bucket").collect()
    return [row["gain"] for row in gains]


def _looked_up(gains: list[int]) -> Column:
    """The gains as one constant array; as text, it is a single literal in the plan."""
    return F.split(F.lit(",".join(map(str, gains))), ",").cast("array<bigint>")


def _gain_of(features: Column, gains: Column) -> Column:
    return F.aggregate(features, F.lit(0).cast("long"), lambda total, b: total + F.element_at(gains, b + 1))


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, floored, from the seed and the id alone; a null id counts as empty."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    even = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(even)))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED, buckets: int = BUCKETS,
             least_words: int = LEAST_WORDS, text: str = "text", doc_id: str = "doc_id", target_text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_features, weight, score, rank``.

    Words are runs of digits, letters a-z after lower-casing A-Z, and characters beyond ASCII. Of the
    documents with ``least_words`` or more, ``percent`` in a hundred (floored) with the highest scores
    are drawn and ranked from 1, ties by the smaller id; ``rank`` is null for all others.

    Null and empty texts have no features, weight 0 and a score of noise alone. Rows that repeat an id are
    documents of their own with the same noise; where score and id are equal the order is arbitrary,
    and the ranks go to equal rows. A null id has the noise of an empty id and comes before others at a tie.
    Other columns of either table are ignored. Empty tables give no rows; an empty target gains nothing
    over smoothing. A very long text without line breaks is one segment.

    A line that a large share of the documents has is one row of the segments; on the side of the documents
    Spark's skew-join handling can split it. Ranks come from sampled ranges of the scores.
    """
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    own = _Counted(texts, buckets)
    wanted = _Counted(target.select(F.col(target_text).alias("text")), buckets)
    gains = _looked_up(bucket_gains(own.counts(), wanted.counts(), buckets))

    inside = own.distinct.select("h1", "h2", "n_words", F.size("features").alias("n"), _gain_of(F.col("features"), gains).alias("gain"))
    used = own.rows.select("place", "doc_id", F.explode("keys").alias("key")).select("place", "doc_id", "key.h1", "key.h2")
    parts = used.join(inside, ["h1", "h2"]).select("place", "doc_id", "n_words", "n", "gain").unionByName(
        own.rows.select("place", "doc_id", F.lit(0).alias("n_words"), F.size("across").alias("n"), _gain_of(F.col("across"), gains).alias("gain")))
    totals = parts.groupBy("place", "doc_id").agg(
        F.sum("n_words").alias("n_words"), F.sum("n").alias("n_features"), F.sum("gain").alias("gain"))
    # Whole numbers: what is left of the division goes first, so that the quotient is floored and exact.
    floored = F.when(F.col("n_features") == 0, F.lit(0)).otherwise(
        F.expr("(gain - pmod(gain, n_features)) div n_features")).cast("long")
    scored = stored(totals.select("place", "doc_id", "n_words", "n_features", floored.alias("weight"))
                    .withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scores")

    eligible = scored.filter(F.col("n_words") >= least_words)
    quota = percent * eligible.count() // 100
    ranked = number_in_order(eligible, [F.desc("score"), F.asc("doc_id"), F.asc("place")], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= quota, F.col("rank")))
    others = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(others).drop("place")
