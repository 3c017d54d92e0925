"""Mixing sources to target weights, block by block (DataFrame functions only).

The documents of a source form one stream of words, which is cut into blocks of
a fixed number of words; the last block holds what remains.  A source whose
target is ``t`` words gets the slots that hold ``t`` words: whole passes over its
blocks, then a part of one.  Within a pass the slots are mapped to blocks by a
pseudorandom permutation of the block numbers, the incomplete block coming last,
and the last slot of all is cut so that the words come out exactly.

Every slot then draws its place in the output by a pseudorandom permutation of
all slots; ``shard_blocks`` neighbouring places are an output shard.  A shard's
source counts are thereby a multinomial draw given the sources' totals
(independent draws would miss the targets by their sampling error, and would use
a source with a target of twice its size more than twice).

The permutations are swap-or-not shuffles (Hoang, Morris and Rogaway, 2012),
which need neither a sort nor a table and work for any number of items.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from occulink.llm.common import ceil_div, lookup_join, stage

WORD = r"[^\x20\x09-\x0D]+"
#: Rows that one numbering window holds on average.
WINDOW_ROWS = 20_000
#: Slots that are written out together, and slots of a task.
RUN, TASK = 1024, 32_768
ROUNDS = 24


@dataclass(frozen=True)
class Mixture:
    """Weights (repeated over the sources in order), the mix's size and a
    source's most as parts of all words and of its own; block and shard sizes."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    most: int = 2
    block_words: int = 128
    shard_blocks: int = 4096
    seed: int = 2024


def shuffled(item: Column, n: Column, *key: Column) -> Column:
    """The place of ``item`` in a pseudorandom permutation of 0 to ``n - 1``.
    Each round pairs the items ``x`` and ``k - x`` and swaps a pair or not."""

    def swap(x: Column, turn: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, turn), n) - x, n)
        keep = F.xxhash64(*key, turn, F.greatest(x, other)).bitwiseAND(F.lit(1)) == 0
        return F.when(keep, x).otherwise(other)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), item, swap)


def source_targets(sizes: DataFrame, m: Mixture) -> DataFrame:
    """``sizes(source, source_size)``, one row a source, with its number ``s`` (in
    code point order, null last) and ``target`` in words.

    With the sources ordered by the level at which weight times level meets
    their most, those up to some place stand at their most and the rest share
    what is left by weight; the place is the first whose own level is not below
    that of the rest.
    """
    number = Window.orderBy(F.asc_nulls_last("source"))
    s = sizes.withColumn("s", F.row_number().over(number) - 1)
    weight = F.element_at(F.array(*(F.lit(w) for w in m.weights)), F.col("s") % len(m.weights) + 1).cast("double")
    s = s.withColumn("weight", weight).withColumn("cap", F.col("source_size").cast("double") * m.most)
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "s")
    before, rest = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    left = F.sum(F.col("source_size").cast("double")).over(every) * m.share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    s = s.withColumn("level", left / F.sum("weight").over(rest))
    s = s.withColumn("place", F.row_number().over(by_level))
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    first = F.min(F.when(fits, F.struct("place", "level"))).over(every)["level"]
    return s.withColumn("first", first).select("s", "source", "source_size", F.least("cap", F.coalesce(F.col("first") * F.col("weight"), F.col("cap"))).alias("target"))


def _numbered(rows: DataFrame, n: int) -> DataFrame:
    """``rows(row, s, size, key)`` with ``at``, the words of the source's earlier
    rows in the order of ``key``."""
    bits = max(1, ceil_div(n * 4, WINDOW_ROWS).bit_length())
    rows = rows.withColumn("part", F.shiftrightunsigned("key", 64 - min(30, bits)))
    part = ["s", "part"]
    sums = rows.groupBy(*part).agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("s").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(*part, F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy(*part).orderBy("key", "size", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum("size").over(inside), F.lit(0))
    return rows.withColumn("at", at).join(bases, part).select("row", "s", "size", (F.col("at") + F.col("base")).alias("at"))


def _slots(sources: DataFrame, m: Mixture) -> DataFrame:
    """``s, block, words, shard, slot`` for every slot of the mix; ``sources`` has
    ``s, source_size, take`` and its ``first`` slot."""
    size, per, seed = F.col("source_size"), F.lit(m.block_words), F.lit(m.seed)
    total = sources.agg(F.sum("slots")).first()[0] or 0
    runs = sources.where("slots > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(slots - 1) div {RUN}"))).alias("run"))
    runs = runs.repartition(max(1, ceil_div(total, TASK)), "s", "run")
    last = F.least(F.col("slots"), (F.col("run") + 1) * RUN) - 1
    slots = runs.select("*", F.explode(F.sequence(F.col("run") * RUN, last)).alias("j"))
    turn, of = F.call_function("div", F.col("j"), F.col("blocks")), F.col("j") % F.col("blocks")
    full = F.call_function("div", size, per)
    slots = slots.withColumn("turn", turn).withColumn("of", of).withColumn("full", full)
    block = F.when(F.col("of") < F.col("full"), shuffled(F.col("of"), F.greatest("full", F.lit(1)), seed, F.col("s"), F.col("turn"))).otherwise(F.col("of"))
    before = F.col("turn") * size + F.col("of") * per
    words = F.least(per, size - F.col("of") * per, F.col("take") - before)
    place = shuffled(F.col("first") + F.col("j"), F.lit(total).cast("long"), seed, F.lit(-1).cast("long"))
    shards = F.lit(m.shard_blocks)
    return slots.select("s", block.alias("block"), words.alias("words"), place.alias("place")).select(
        "s", "block", "words", F.call_function("div", F.col("place"), shards).alias("shard"), (F.col("place") % shards).cast("int").alias("slot")
    )


@dataclass(frozen=True)
class Mix:
    """The result: ``docs(row, doc_id, size, s)``, ``sources(s, source, source_size,
    target)`` and ``spans(shard, slot, at, row, start, length)``: the words that
    document ``row`` gives, from its word ``start`` on, to place ``at`` of a slot."""

    docs: DataFrame
    sources: DataFrame
    spans: DataFrame


def mix(docs: DataFrame, m: Mixture = Mixture()) -> Mix:
    """Mix all rows of ``docs(doc_id, text, source)``.

    A size is the number of words (runs without white space) of the text; null
    and empty texts have none and give no span.  A null source is a source of its
    own.  The words taken from a source are its target, rounded; nothing is taken
    more than ``most`` times.  The result depends on ids, texts and sources only,
    not on the order or partitioning of the rows; rows that agree in all of them
    may change places.  Null ids are ordered by their texts.  An empty table gives
    empty results, and other columns are ignored.
    """
    return _mix(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", "source"), m)


def _mix(docs: DataFrame, m: Mixture) -> Mix:
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("source_key")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("row", "doc_id", key, "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64("doc_id", text).alias("key"))
    rows = stage(rows, "mix-rows")
    sizes = rows.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    targets = source_targets(sizes, m).withColumn("take", F.round("target").cast("long"))
    targets = targets.withColumn("blocks", F.expr(f"(source_size + {m.block_words - 1}) div {m.block_words}"))
    passes = F.expr("CASE WHEN source_size > 0 THEN take div source_size ELSE 0 END")
    over = F.expr(f"CASE WHEN source_size > 0 THEN (take % source_size + {m.block_words - 1}) div {m.block_words} ELSE 0 END")
    targets = targets.withColumn("slots", passes * F.col("blocks") + over)
    earlier = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    targets = stage(targets.withColumn("first", F.coalesce(F.sum("slots").over(earlier), F.lit(0).cast("long"))), "mix-sources")

    names = targets.select(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("source_key"), "s")
    known = lookup_join(rows, names, ["source_key"], F.col("key")).drop("source_key", "source")
    known = stage(known, "mix-docs")
    at = _numbered(known.where("size > 0"), known.count())
    first, last = F.expr(f"at div {m.block_words}"), F.expr(f"(at + size - 1) div {m.block_words}")
    pieces = at.select("*", F.explode(F.sequence(first, last)).alias("block"))
    begin = F.greatest(F.col("at"), F.col("block") * m.block_words)
    end = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * m.block_words)
    pieces = pieces.select("s", "block", "row", (begin - F.col("at")).alias("start"), (begin - F.col("block") * m.block_words).alias("in_block"), (end - begin).alias("length"))
    # Spark takes exploded slots for few: without the hint it would broadcast them
    met = _slots(targets, m).hint("merge").join(pieces.hint("merge"), ["s", "block"]).where(F.col("in_block") < F.col("words"))
    spans = met.select("shard", "slot", F.col("in_block").alias("at"), "row", "start", F.least(F.col("length"), F.col("words") - F.col("in_block")).alias("length"))
    return Mix(known.select("row", "doc_id", "size", "s"), targets.select("s", "source", "source_size", "target"), spans)


def taken_words(mixed: Mix) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every document: the words
    that the mix takes of it, repeats counted."""
    taken = mixed.spans.groupBy("row").agg(F.sum("length").alias("taken"))
    docs = mixed.docs.join(taken.hint("merge"), "row", "left")
    return lookup_join(docs, mixed.sources, ["s"], F.xxhash64("row")).select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def mixed_texts(docs: DataFrame, m: Mixture = Mixture()) -> DataFrame:
    """``shard, slot, text``: the mix itself, each slot's words joined by blanks."""
    rows = stage(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", "source"), "mix-texts")
    words = rows.select("row", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"))
    piece = F.array_join(F.slice("words", (F.col("start") + 1).cast("int"), F.col("length").cast("int")), " ")
    parts = _mix(rows, m).spans.join(words, "row").select("shard", "slot", F.struct("at", piece.alias("piece")).alias("part"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["piece"]), " ")
    return parts.groupBy("shard", "slot").agg(joined.alias("text"))
