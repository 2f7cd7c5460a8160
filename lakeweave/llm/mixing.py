"""Mixing sources to target weights by Sainte-Lague apportionment.

The words of a source, its documents in seeded order, form one stream that is
cut into blocks of ``block_words``. Blocks are the seats: the sources get them
by highest quotients of their targets, the shards of a source (runs of
``shard_blocks`` blocks) by highest quotients of their sizes. In a shard a
seeded permutation of the blocks says which of them fill its quota; a quota
above the number of blocks takes them a second time. A document's share is the
part of it that lies in chosen blocks, so no word is taken more than
``most_repeats`` times.

Null texts and texts without words have size 0 and are never taken. A null
source is a source of its own, the last in order. Equal rows are counted each.
A table without words gives targets of 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweave.llm.common import WORD, named, running_totals, stored

#: Primes above any number of blocks in a shard, hence without a common factor with it.
STRIDES = (1031, 1499, 2053, 3079, 4099, 6151, 8209, 12289)


def quota_table(seats: DataFrame, group: Sequence[str], item: Sequence[str]) -> DataFrame:
    """Add ``quota``: whole seats for the rows of each group by highest quotients weight / (2k + 1).

    ``seats`` has ``weight`` (double, not negative), ``most`` (a bound for the
    quota) and, the same in a whole group, ``n`` (seats to give). Every row gets
    the seats that any divisor leaves it; only the two or so quotients a row
    that are still open are ranked, by ranges and not in one task. Ties go to
    the smaller item.
    """
    totals = seats.groupBy(*group).agg(F.sum("weight").alias("all_weight"), F.count("*").alias("rivals"))
    known = seats.join(totals, [*group])
    known = known.withColumn("pace", F.when(F.col("all_weight") > 0, F.col("weight") / F.col("all_weight")).otherwise(0.0))
    sure = F.greatest(F.lit(0), F.ceil(F.col("pace") * (F.col("n") - F.col("rivals") / 2) - 0.5) - 1)
    edge = F.floor(F.col("pace") * (F.col("n") + F.col("rivals") / 2) + 0.5) + 1
    known = known.withColumns({"sure": F.least(sure.cast("long"), F.col("most"))})
    known = known.withColumn("edge", F.least(F.greatest(edge.cast("long"), F.col("sure")), F.col("most")))
    known = stored(known, "quotas")
    open_ = known.filter((F.col("edge") > F.col("sure")) & (F.col("weight") > 0)).select(
        *group, *item, F.explode(F.sequence("sure", F.col("edge") - 1)).alias("seat"), "weight").withColumn(
        "falling", -F.col("weight") / (2 * F.col("seat") + 1)).withColumn("one_seat", F.lit(1).cast("long"))
    ranked = running_totals(open_, [*group, "falling", *item, "seat"], {"rank": "one_seat"}, "quotients")
    left = known.groupBy(*group).agg((F.first("n") - F.sum("sure")).alias("left_over"))
    first = ranked.groupBy(*group).agg(F.min("rank").alias("first_rank"))
    won = ranked.join(left, [*group]).join(first, [*group]).filter(F.col("rank") - F.col("first_rank") < F.col("left_over"))
    extra = won.groupBy(*group, *item).agg(F.count("*").alias("extra"))
    return known.join(extra, [*group, *item], "left").withColumn(
        "quota", F.col("sure") + F.coalesce("extra", F.lit(0))).select(*seats.columns, "quota")


def level_targets(sources: DataFrame, share: float, most_repeats: int) -> DataFrame:
    """Add ``target``: ``share`` of all sizes dealt out by ``weight``, no source above its bound.

    What a bounded source cannot take is dealt to the others by weight, round by
    round, until a round bounds no further source.
    """
    bound = most_repeats * F.col("source_size")
    state = sources.withColumn("full", F.col("source_size") == 0)
    while True:
        state = stored(state, "targets")
        sums = state.agg(
            F.sum("source_size").alias("size"), F.sum(F.when(F.col("full"), bound)).alias("held"),
            F.sum(F.when(~F.col("full"), F.col("weight"))).alias("weights"), F.count_if("full").alias("full")).first()
        rest = share * (sums["size"] or 0) - (sums["held"] or 0)
        pace = max(0.0, rest) / sums["weights"] if sums["weights"] else 0.0
        over = F.col("full") | (F.col("weight") * F.lit(pace) > bound)
        state = state.withColumn("over", over)
        if state.agg(F.count_if("over")).first()[0] == sums["full"]:
            return state.withColumn("target", F.when(F.col("full"), bound.cast("double")).otherwise(
                F.col("weight") * F.lit(pace))).drop("full", "over")
        state = state.drop("full").withColumnRenamed("over", "full")


def copies_of(block: Column, quota: Column, blocks: Column, stride: Column, shift: Column) -> Column:
    """How often a block is taken: its place in the seeded permutation against the quota."""
    place = (block * stride + shift) % blocks
    return F.when(place < quota, F.floor((quota - 1 - place) / blocks) + 1).otherwise(0)


def mix(docs: DataFrame, weights: Sequence[float], share: float = 1.5, most_repeats: int = 2, seed: int = 17,
        block_words: int = 16, shard_blocks: int = 1024, doc_id: str = "doc_id", text: str = "text",
        source: str = "source") -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` for every row.

    ``weights`` repeat over the sources in code-point order. Reruns agree: the
    order and the choice depend on ids, texts and the seed only.
    """
    if shard_blocks >= STRIDES[0]:
        raise ValueError(f"a shard has fewer than {STRIDES[0]} blocks")
    # A null source sorts first in Spark; the flag puts it last.
    rows = stored(docs.select(
        named(doc_id).alias("id"), named(source).isNull().cast("int").alias("no_source"),
        F.coalesce(named(source), F.lit("")).alias("source"),
        F.coalesce(F.regexp_count(named(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), named(doc_id), named(text)).alias("draw")), "mix")
    own = ["no_source", "source"]
    sources = rows.groupBy(*own).agg(F.sum("size").alias("source_size"), F.lit(1).cast("long").alias("one"))
    sources = running_totals(sources, own, {"place": "one", "words_before": "source_size"}, "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("place") % len(weights) + 1).cast("int"))
    blocks = F.ceil(F.col("source_size") / block_words)
    sources = level_targets(sources.withColumn("weight", weight), share, most_repeats).withColumn("blocks", blocks)

    # Seats of the sources, in blocks of the source's own average size.
    seats = sources.filter("blocks > 0").select(
        *own, "source_size", "blocks", (F.col("target") * F.col("blocks") / F.col("source_size")).alias("weight"),
        (most_repeats * F.col("blocks")).alias("most"))
    n = seats.agg(F.round(F.sum("weight")).cast("long")).first()[0] or 0
    by_source = quota_table(seats.withColumns({"all": F.col("no_source") * 0, "n": F.lit(n).cast("long")}), ["all"], own)

    shards = by_source.select(*own, "source_size", "blocks", F.col("quota").alias("n"), F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("blocks") - 1) / shard_blocks))).alias("shard"))
    first = F.col("shard") * shard_blocks
    shards = shards.withColumn("blocks_here", F.least(F.lit(shard_blocks).cast("long"), F.col("blocks") - first))
    words_here = F.least(F.col("blocks_here") * block_words, F.col("source_size") - first * block_words)
    by_shard = quota_table(shards.select(*own, "shard", "blocks_here", "n", words_here.cast("double").alias("weight"),
                                         (most_repeats * F.col("blocks_here")).alias("most")), own, ["shard"])
    lot = F.xxhash64(F.lit(seed), "no_source", "source", "shard")
    by_shard = by_shard.select(
        *own, "shard", "blocks_here", "quota",
        F.element_at(F.array(*[F.lit(p).cast("long") for p in STRIDES]), (F.pmod(lot, F.lit(len(STRIDES))) + 1).cast("int")).alias("stride"),
        F.pmod(F.shiftright(lot, 8), F.col("blocks_here")).alias("shift"))

    placed = running_totals(rows, [*own, "draw", "id"], {"position": "size"}, "mix_order")
    facts = sources.select(*own, "source_size", "target", "words_before")
    placed = placed.join(facts, own).withColumns({
        "start": F.col("position") - F.col("words_before")}).withColumn("end", F.col("start") + F.col("size"))
    shard_words = block_words * shard_blocks
    parts = placed.select("*", F.explode(F.when(F.col("size") > 0, F.sequence(
        F.floor(F.col("start") / shard_words), F.floor((F.col("end") - 1) / shard_words))).otherwise(
        F.array(F.lit(-1).cast("long")))).alias("shard"))
    parts = parts.join(by_shard, [*own, "shard"], "left")
    # Inside the shard: the words [lo, hi) of the document and the blocks they touch.
    lo = F.greatest(F.col("start") - F.col("shard") * shard_words, F.lit(0))
    hi = F.least(F.col("end") - F.col("shard") * shard_words, F.lit(shard_words))
    parts = parts.withColumns({"lo": lo, "hi": hi})

    def words_in(total: Column, block: Column) -> Column:
        inside = F.least(F.col("hi"), (block + 1) * block_words) - F.greatest(F.col("lo"), block * block_words)
        return total + inside * copies_of(block, F.col("quota"), F.col("blocks_here"), F.col("stride"), F.col("shift"))

    touched = F.sequence(F.floor(F.col("lo") / block_words), F.floor((F.col("hi") - 1) / block_words))
    taken = F.when(F.col("shard") < 0, F.lit(0).cast("long")).otherwise(
        F.aggregate(touched, F.lit(0).cast("long"), words_in))
    parts = parts.withColumn("part_taken", taken)
    whole = parts.filter(F.col("size") <= 0).select("id", "size", "source_size", "target", F.col("part_taken").alias("taken"))
    summed = parts.filter(F.col("size") > 0).groupBy("no_source", "source", "start", "id", "size", "source_size", "target").agg(
        F.sum("part_taken").alias("taken")).select("id", "size", "source_size", "target", "taken")
    return whole.unionByName(summed).withColumnRenamed("id", doc_id)
