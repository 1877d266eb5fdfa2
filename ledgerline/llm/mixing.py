"""Mixing sources to target weights, in DataFrame functions only.

The words of each source are laid end to end and cut into blocks of a fixed length. Every source gets
as many draws as its target asks for; each draw falls into an output shard by its hash, so the counts
of a source over the shards are a multinomial draw with the target as its exact total. Within a
shard the slots of a source are numbered, and a slot's number goes through a pseudorandom
permutation of the source's block indices, a new one each time round. Documents and draws are joined by block
index. No order or group holds more than a bounded portion of a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.llm.quality_rules import SPACE
from ledgerline.llm.workspace import keep, partitions

#: Documents of a source that are numbered together, draws that one row expands into, and draws of a shard.
PORTION = 4096
SHARD_BLOCKS = 8192
ROUNDS = 24


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; 0 for null."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE)
    edge = (F.get(parts, F.lit(0)) == "").cast("int") + ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")
    return (F.size(parts) - edge).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """`sources` (source, source_size) with rank, weight and target.

    Sources by code point, null last, take the weights in turn. Targets add up to `share` of all
    words; a target stops at `most` times its source, and what is over goes to the others by weight
    until none is above. With sources ordered by capacity per weight, the level of the first one that
    is not full is the level of all later ones. One row per source is ordered in one task.
    """
    order = W.orderBy(F.col("source").isNull(), "source")
    ranked = sources.withColumn("rank", F.row_number().over(order) - 1)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("rank") % len(weights))
    full = ranked.select("*", weight.alias("weight"), (most * F.col("source_size")).alias("room"))
    by_room = W.orderBy(F.col("room") / F.col("weight"), "rank")
    before = F.coalesce(F.sum("room").over(by_room.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(by_room.rowsBetween(0, W.unboundedFollowing))
    total = F.sum("source_size").over(W.partitionBy()) * share
    level = full.withColumn("level", (total - before) / after)
    level = level.withColumn("open", F.col("level") * F.col("weight") <= F.col("room"))
    first = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(by_room.rowsBetween(W.unboundedPreceding, 0))
    return level.withColumn("target", F.least(F.col("room"), F.coalesce(first * F.col("weight"), F.col("room")))).drop("room", "level", "open")


def permuted(index: Column, n: Column, key: Column) -> Column:
    """Swap-or-not shuffle: a pseudorandom permutation of 0 .. n - 1 for every key, for any n."""

    def one(x: Column, k: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(key, k), n) - x, n)
        return F.when(F.xxhash64(key, k + ROUNDS, F.greatest(x, other)) % 2 == 0, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index, one)


def draws(sources: DataFrame, block_words: int, seed: int) -> DataFrame:
    """(rank, shard, slot, time, block): the mix; `time` tells how often the source has been gone through."""
    blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    wanted = F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long")
    sized = sources.where("source_size > 0").withColumn("blocks", blocks).withColumn("draws", F.least(wanted, 2 * F.col("blocks")))
    shards = F.greatest(F.ceil(F.sum("draws").over(W.partitionBy()) / SHARD_BLOCKS), F.lit(1)).cast("long")
    sized = sized.withColumn("shards", shards).select("rank", "blocks", "draws", "shards")
    portions = sized.where("draws > 0").withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("draws") - 1, F.lit(PORTION).cast("long"))))
    portions = portions.repartition("rank", "first")
    each = F.transform(F.sequence(F.col("first"), F.least(F.col("first") + PORTION, F.col("draws")) - 1), lambda d: F.pmod(F.xxhash64(F.lit(seed), "rank", d), F.col("shards")))
    counts = portions.select("rank", "blocks", F.explode(each).alias("shard")).groupBy("rank", "blocks", "shard").agg(F.count("*").alias("count"))
    # One row per source and shard; its slots follow those of the source's earlier shards.
    before = W.partitionBy("rank").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("first", F.coalesce(F.sum("count").over(before), F.lit(0).cast("long")))
    # The numbering may leave a few rows in one task; each of them stands for thousands of slots.
    counts = counts.repartition(partitions(sources.sparkSession), "rank", "shard")
    slots = counts.select("rank", "blocks", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("count") - 1)).alias("slot"))
    time = F.expr("slot div blocks").alias("time")
    block = permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), F.xxhash64(F.lit(seed), "rank", F.expr("slot div blocks")))
    return slots.select("rank", "shard", "slot", time, block.alias("block"))


def placed(rows: DataFrame) -> DataFrame:
    """rows (source, size, order_key, ...) with `start`: the words of the source before the row.

    Rows of a source are dealt by order_key into portions; a row's start is the sum of earlier portions and of
    earlier rows of its own. Equal rows take their places in any order.
    """
    counted = rows.groupBy("source").agg(F.count("*").alias("n")).select(F.col("source").alias("s"), F.ceil(F.col("n") / PORTION).cast("long").alias("portions"))
    dealt = rows.join(counted, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("portion", F.pmod("order_key", "portions")).drop("portions")
    sums = dealt.groupBy("source", "portion").agg(F.sum("size").alias("sum"))
    sums = sums.withColumn("offset", F.sum("sum").over(W.partitionBy("source").orderBy("portion")) - F.col("sum"))
    sums = sums.select(F.col("source").alias("s"), F.col("portion").alias("p"), "offset")
    inner = W.partitionBy("source", "portion").orderBy("order_key", "size").rowsBetween(W.unboundedPreceding, -1)
    dealt = dealt.withColumn("within", F.coalesce(F.sum("size").over(inner), F.lit(0).cast("long")))
    joined = dealt.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("portion") == F.col("p")))
    return joined.withColumn("start", F.col("offset") + F.col("within")).drop("s", "p", "portion", "offset", "within")


def row_key(doc_id: Column, source: Column) -> Column:
    return F.xxhash64(doc_id.isNull(), doc_id, source.isNull(), source)


def mix_sources(documents: DataFrame, block_words: int = 128, seed: int = 1, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """(documents, mix): each row's place and what the mix takes of it; and the mix itself.

    documents: doc_id, text_key, source, rank, size, start, source_size, target, taken and pieces, the
    (block, times) that overlap the row. A null text has size 0, a null source comes last, equal rows
    take places one after the other; sources without words have target 0. Reruns agree.
    """
    id_, from_ = F.col(doc_id), F.col(source)
    rows = documents.select(id_.alias("doc_id"), from_.alias("source"), row_key(id_, from_).alias("row_key"), F.xxhash64(text).alias("text_key"), word_count(F.col(text)).alias("size"))
    rows = keep(rows.withColumn("order_key", F.xxhash64("row_key", "text_key")))
    sources = keep(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share))
    mix = keep(draws(sources, block_words, seed))
    times = mix.groupBy("rank", "block").agg(F.count("*").alias("times"))
    told = sources.select(F.col("source").alias("s"), "rank", "source_size", "target")
    rows = keep(placed(rows).join(told, F.col("source").eqNullSafe(F.col("s"))).drop("s", "order_key"))
    # A row's place in its source is its own, so it serves as the key of the row.
    spread = rows.where("size > 0").select("rank", "start", "size", F.explode(F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))).alias("block"))
    met = spread.join(times, ["rank", "block"])
    words = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words) - F.greatest(F.col("start"), F.col("block") * block_words)
    taken = met.groupBy("rank", "start").agg(F.sum(words * F.col("times")).alias("taken"), F.sort_array(F.collect_list(F.struct("block", "times"))).alias("pieces"))
    result = rows.join(taken.withColumn("some", F.lit(True)), ["rank", "start"], "left")
    # A row without words may share its place with the next one.
    empty = F.col("size") == 0
    result = result.withColumn("taken", F.when(empty, 0).otherwise(F.coalesce("taken", F.lit(0))).cast("long")).withColumn("pieces", F.when(~empty, F.col("pieces")))
    return result.drop("some"), mix


def mixed_documents(documents: DataFrame, block_words: int = 128, seed: int = 1, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The mix as documents: for every time round, each row with the words that the mix takes of it, in order.

    Rows of which nothing is taken go; a row that is taken from twice comes twice. All columns stay.
    """
    placed_rows, _ = mix_sources(documents, block_words, seed, text=text, doc_id=doc_id, source=source)
    # Equal rows have equal keys; each takes one of their places, by number.
    alike = W.partitionBy("row_key", "text_key")
    places = placed_rows.select("row_key", "text_key", F.struct("start", "size", "pieces").alias("place"), F.row_number().over(alike.orderBy("start", "size")).alias("number"))
    rows = documents.select(F.struct("*").alias("row"), row_key(F.col(doc_id), F.col(source)).alias("row_key"), F.xxhash64(text).alias("text_key"))
    rows = rows.withColumn("number", F.row_number().over(alike.orderBy(F.lit(1))))
    rows = rows.join(places.where("place.pieces is not null"), ["row_key", "text_key", "number"])
    # Each part is a word with the white space before it.
    rows = rows.withColumn("parts", F.split(F.col(f"row.{text}"), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")).withColumn("time", F.explode(F.array(F.lit(1), F.lit(2))))
    low = lambda p: F.greatest(p["block"] * block_words - F.col("place.start"), F.lit(0).cast("long"))
    high = lambda p: F.least((p["block"] + 1) * block_words - F.col("place.start"), F.col("place.size"))
    taken = F.filter("place.pieces", lambda p: p["times"] >= F.col("time"))
    words = F.flatten(F.transform(taken, lambda p: F.slice("parts", (low(p) + 1).cast("int"), (high(p) - low(p)).cast("int"))))
    rows = rows.withColumn("mixed", F.regexp_replace(F.array_join(words, ""), r"^[\x20\x09-\x0D]+", "")).where("mixed <> ''")
    return rows.select(*[F.col("mixed").alias(c) if c == text else F.length("mixed").cast(kind).alias(c) if c == "n_chars" else F.col("row")[c].alias(c) for c, kind in documents.dtypes])
