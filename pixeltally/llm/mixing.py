"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Targets come from the weights, capped at a number of passes over a source. The mix is a
number of blocks of equal size; sources get them by highest quotients, and each source's
blocks go to its shards in the same way, so every shard has an integer quota. Within a
shard documents lie in a seeded order, cut into equal blocks; a seeded start and the quota
say which blocks, one after another and round the end, are taken.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pixeltally.llm.common import small_table, stored, word_count

CYCLE = (3, 1, 2)
SHARE = 1.5
PASSES = 2
BLOCK_WORDS = 16
SHARD_WORDS = 250_000
MOST_SHARDS = 100_000


def targets(sizes: Mapping[str | None, int], cycle: Sequence[float] = CYCLE, share: float = SHARE, passes: int = PASSES) -> dict:
    """Words for each source: ``share`` of all words dealt by weight, none above ``passes`` times its size.

    Weights repeat ``cycle`` over the sources by code point, null last. What a capped source
    leaves goes to the others by weight until none is above its cap.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(order)}
    left, weights = share * sum(sizes.values()), sum(weight.values())
    found = {}
    for source in sorted(order, key=lambda s: passes * sizes[s] / weight[s]):
        cap = float(passes * sizes[source])
        found[source] = min(cap, left * weight[source] / weights)
        left -= found[source]
        weights -= weight[source]
    return found


def sainte_lague(votes: Sequence[float], seats: int, caps: Sequence[int]) -> list[int]:
    """Seats by highest quotients votes/(2k+1), none above its cap.

    A divisor is searched that deals out as many seats as possible at once, without a step
    for each seat; the few left over go one by one.
    """
    def dealt(divisor: float) -> list[int]:
        return [min(cap, int(v / divisor + 0.5)) for v, cap in zip(votes, caps)]

    seats = min(seats, sum(cap for v, cap in zip(votes, caps) if v > 0))
    if seats <= 0:
        return [0] * len(votes)
    low, high = min(v for v in votes if v > 0) / (4 * max(caps) + 4), 4 * max(votes)
    for _ in range(100):
        middle = (low * high) ** 0.5
        low, high = (middle, high) if sum(dealt(middle)) > seats else (low, middle)
    found = dealt(high * (1 + 1e-9))  # seats at the very edge go by their quotients
    quotients = [(-v / (2 * k + 1), i) for i, (v, k, cap) in enumerate(zip(votes, found, caps)) if v > 0 and k < cap]
    heapq.heapify(quotients)
    for _ in range(seats - sum(found)):
        _, i = heapq.heappop(quotients)
        found[i] += 1
        if found[i] < caps[i]:
            heapq.heappush(quotients, (-votes[i] / (2 * found[i] + 1), i))
    return found


def mix(
    docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", seed: int = 0,
    block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, cycle: Sequence[float] = CYCLE,
    share: float = SHARE, passes: int = PASSES, carry: Sequence[str] = (),
) -> DataFrame:
    """One row per document with what the mix takes of it, and the columns in ``carry``.

    ``doc_id, source, size, source_size, target, taken`` and ``first, last, rounds``: the mix
    takes the whole document ``rounds`` times and its words from ``first`` to before ``last``
    once more; where the taken blocks wrap round a shard's end, ``first2, last2`` are a second
    such stretch. ``taken`` counts all of them.

    A null text has size 0 and nothing is taken of it; null sources are one source. Rows that
    repeat an id are mixed each for itself. An empty table gives an empty result. The result
    depends on ids, sizes, sources and the seed only, so reruns agree.

    The driver holds one number per source and per shard: shards grow with the data, so that
    there are at most ``MOST_SHARDS`` and one for each source more; it raises if there are more
    sources than that. A source with a third of all words has as many more shards.
    """
    sized = stored(
        docs.select(
            F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
            F.struct(F.lit(0).alias("no_column"), *carry).alias("carry")),
        "mix-sizes")
    spark = docs.sparkSession
    per_source = sized.groupBy("source").agg(F.sum("size").alias("size"))
    rows = per_source.limit(MOST_SHARDS + 1).collect()
    if len(rows) > MOST_SHARDS:
        raise ValueError(f"more than {MOST_SHARDS} sources")
    sizes = {row["source"]: row["size"] for row in rows}
    goal = targets(sizes, cycle, share, passes)
    shard_words = max(shard_words, -(-sum(sizes.values()) // MOST_SHARDS))
    plan = small_table(
        spark, [(s, n, float(goal[s]), max(1, -(-n // shard_words))) for s, n in sizes.items()],
        "source string, source_size long, target double, shards int")

    # Seeded place of a document: by hash, so that a shard is a mixture of its source.
    place = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"))
    placed = (
        sized.withColumnRenamed("source", "s").join(F.broadcast(plan), F.col("s").eqNullSafe(F.col("source")))
        .drop("s").withColumns({"place": place, "shard": F.pmod(F.xxhash64(place), F.col("shards")).cast("int")}))
    lengths = defaultdict(list)
    for row in placed.groupBy("source", "shard").agg(F.sum("size").alias("size")).collect():
        lengths[row["source"]].append((row["shard"], row["size"]))
    quotas = _quotas(lengths, goal, block_words, passes)
    quota = small_table(spark, quotas, "quota_source string, quota_shard int, length long, blocks long, quota long")

    before = Window.partitionBy("source", "shard").orderBy("place", "doc_id", "size")
    rows = (
        placed.join(F.broadcast(quota), F.col("source").eqNullSafe(F.col("quota_source")) & (F.col("shard") == F.col("quota_shard")))
        .withColumn("start", F.sum("size").over(before.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("start", F.coalesce("start", F.lit(0).cast("long"))))
    # The quota is `rounds` times the whole shard and `extra` blocks from a seeded one on.
    first_block = F.pmod(F.xxhash64(F.lit(seed), F.lit("first block"), F.col("source"), F.col("shard")), F.col("blocks"))
    rows = rows.withColumns({
        "rounds": F.expr("quota div blocks"), "extra": F.expr("quota % blocks"), "first_block": first_block})

    def edge(block: str) -> str:
        return f"(({block}) * length) div blocks"

    def within(position: str) -> str:
        return f"greatest(0L, least(size, ({position}) - start))"

    rows = rows.withColumns({
        "first": F.expr(within(edge("first_block"))),
        "last": F.expr(within(edge("least(first_block + extra, blocks)"))),
        "first2": F.lit(0).cast("long"),
        "last2": F.expr(within(edge("greatest(first_block + extra - blocks, 0L)")))})
    return rows.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("rounds") * F.col("size") + F.col("last") - F.col("first") + F.col("last2") - F.col("first2")).alias("taken"),
        "rounds", "first", "last", "first2", "last2", *[F.col("carry")[name].alias(name) for name in carry])


def _quotas(lengths: Mapping, goal: Mapping, block_words: int, passes: int) -> list[tuple]:
    """Rows of source, shard, its words, its blocks and how many of them the mix takes."""
    blocks = {s: [max(1, round(n / block_words)) if n else 0 for _, n in shards] for s, shards in lengths.items()}
    sources = [s for s in lengths if sum(blocks[s])]
    seats = sainte_lague(
        [goal[s] for s in sources], round(sum(goal.values()) / block_words), [passes * sum(blocks[s]) for s in sources])
    per_source = dict(zip(sources, seats))
    found = []
    for source, shards in lengths.items():
        shards, counts = zip(*sorted(zip(shards, blocks[source])))
        dealt = sainte_lague([n for _, n in shards], per_source.get(source, 0), [passes * b for b in counts])
        found += [(source, shard, n, max(b, 1), q) for (shard, n), b, q in zip(shards, counts, dealt)]
    return found
