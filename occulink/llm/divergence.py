"""Term statistics by length-bucketed packing, and the divergence of sources.

Terms are counted in numpy, a chunk of texts at a time.  A term of at most 8
bytes becomes one big-endian 64-bit number, one of at most 16 bytes two (terms
hold no zero byte, so padding keeps them apart and in byte order).  These numbers
are radix-sorted by 16-bit digits.  Longer terms go to buckets of their own, of 32, 64,
128, ... bytes, and are sorted as bytes.  The chunk's documents lie in the order
of their groups and every sort is stable, so one pass over the runs of equal
terms gives the occurrences and the documents by group and term.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from occulink.llm.common import ceil_div, lookup_join, stage

#: Text bytes that are counted at once (a longer text is a chunk of its own).
CHUNK = 8 << 20
#: Bytes that a text counts besides its own.
ROW = 64
#: Source-term cells of a block, and sources of a tile, of the pairwise sums.
CELLS, TILE = 100_000, 512

#: Terms are runs of these bytes: letters A-Z, a-z and whatever is not ASCII.
LETTER = np.zeros(256, bool)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = LETTER[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
#: The first ``n`` bytes of a big-endian word.
FIRST = np.array([0] + [(1 << 64) - (1 << 8 * (8 - n)) for n in range(1, 9)], np.uint64)

COUNTS = "lang string, source string, term string, n long, docs long"


def find_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and document of each term in the joined bytes of texts."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    letter = LETTER[data]
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    at = offsets[:-1][np.diff(offsets) > 0]  # a text's first byte goes on no term
    first[at] = letter[at]
    goes_on = np.append(letter[1:] & ~first[1:], False)
    starts, ends = np.flatnonzero(first), np.flatnonzero(letter & ~goes_on) + 1
    per_doc = np.diff(np.searchsorted(starts, offsets))
    return starts, ends - starts, np.repeat(np.arange(len(offsets) - 1), per_doc)


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """Stable order of numbers of one or more 64-bit words, the highest first."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in range(0, 64, 16):
            digit = (word >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of the given pieces, one after the other."""
    ends = np.cumsum(lengths)
    return data[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


def sorted_buckets(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length bucket: the terms in it in sorted order (as indices), and
    where a term differs from the one before."""
    wide = np.ndarray((len(data) + 1,), ">u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    for low, high in ((0, 8), (8, 16)):
        mine = np.flatnonzero((lengths > low) & (lengths <= high))
        if not len(mine):
            continue
        s, n = starts[mine], lengths[mine]
        words = [wide[s + at].astype(np.uint64) & FIRST[np.minimum(n - at, 8)] for at in range(0, high, 8)]
        order = radix_order(words)
        new = np.ones(len(order), bool)
        new[1:] = np.logical_or.reduce([w[order][1:] != w[order][:-1] for w in words])
        yield mine[order], new
    width = 16
    while (lengths > width).any():
        mine = np.flatnonzero((lengths > width) & (lengths <= 2 * width))
        width *= 2
        if not len(mine):
            continue
        n = lengths[mine]
        rows = np.zeros(len(mine) * width, np.uint8)
        ends = np.cumsum(n)
        rows[np.repeat(np.arange(len(mine)) * width - (ends - n), n) + np.arange(ends[-1])] = gather(data, starts[mine], n)
        terms = rows.view(f"S{width}")
        order = np.argsort(terms, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = terms[order][1:] != terms[order][:-1]
        yield mine[order], new


def count_chunk(chunk: pa.Table) -> Iterator[pa.RecordBatch]:
    """``COUNTS`` of the rows of ``chunk(lang, source, text)``."""
    lang, source = (chunk.column(c).combine_chunks().dictionary_encode() for c in ("lang", "source"))
    codes = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
    by_group = np.argsort(codes, kind="stable")
    codes = codes[by_group]
    texts = chunk.column("text").cast(pa.large_binary()).take(pa.array(by_group)).combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    data, offsets = LOWER[data], offsets - offsets[0]
    starts, lengths, docs = find_terms(data, offsets)
    for terms, new in sorted_buckets(data, starts, lengths):
        doc = docs[terms]
        group = codes[doc]
        new_doc, new_group = new.copy(), new
        new_doc[1:] |= doc[1:] != doc[:-1]
        new_group[1:] |= group[1:] != group[:-1]
        at = np.flatnonzero(new_group)
        one = terms[at]
        size = np.concatenate([[0], np.cumsum(lengths[one])]).astype(np.int32)
        term = pa.StringArray.from_buffers(len(one), pa.py_buffer(size), pa.py_buffer(gather(data, starts[one], lengths[one])))
        of_lang, of_source = np.divmod(group[at], len(source.dictionary))
        yield pa.RecordBatch.from_arrays(
            [
                lang.dictionary.take(pa.array(of_lang)),
                source.dictionary.take(pa.array(of_source)),
                term,
                pa.array(np.diff(np.append(at, len(terms)))),
                pa.array(np.add.reduceat(new_doc.astype(np.int64), at)),
            ],
            names=["lang", "source", "term", "n", "docs"],
        )


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        t = pa.Table.from_batches([batch])
        lengths = pa.compute.fill_null(pa.compute.binary_length(t.column("text")), 0).to_numpy().astype(np.int64) + ROW
        at = 0
        while at < len(lengths):
            ends = np.cumsum(lengths[at:])
            take = max(int(np.searchsorted(ends, CHUNK - size, side="right")), 0 if held else 1)
            if take:
                held.append(t.slice(at, take))
                size += int(ends[take - 1])
                at += take
            if at < len(lengths):
                yield from count_chunk(pa.concat_tables(held))
                held, size = [], 0
    if held:
        yield from count_chunk(pa.concat_tables(held))


def share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(1000000000 * (count + 5) / (total + 5 * terms))``, by long
    division in two steps (1000000000 = 31250 * 32000), so that nothing
    overflows below totals of 2.8e14."""
    whole = total.cast("long") + terms.cast("long") * 5
    high = (count.cast("long") + 5) * 31250
    return F.lit(1).cast("long") + _div(high, whole) * 32000 + _div((high % whole) * 32000, whole)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _pair_sums(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums of |p - q| over the block's terms, less those of the shares of absent
    terms, for the pairs of sources of two tiles."""
    lang, a, b = rows["lang"].iloc[0], rows["a"].iloc[0], rows["b"].iloc[0]
    is_base = rows["term"].isna().to_numpy()
    entries = rows[~is_base]
    term, terms = pd.factorize(entries["term"])

    def matrix(tile: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        base = rows[is_base & (rows["tile"] == tile).to_numpy()].sort_values("source")
        names, level = base["source"].to_numpy(), base["p"].to_numpy(np.int64)
        m = np.repeat(level[:, None], len(terms), axis=1)
        mine = (entries["tile"] == tile).to_numpy()
        m[pd.Index(names).get_indexer(entries["source"][mine]), term[mine]] = entries["p"].to_numpy(np.int64)[mine]
        return names, level, m

    left, right = matrix(a), matrix(b) if b != a else None
    names, level, m = right or left
    out = []
    for i, (name, of, row) in enumerate(zip(*left, strict=True)):
        some = slice(i + 1, None) if right is None else slice(None)
        gap = np.abs(level[some] - of)
        out.append(pd.DataFrame({"lang": lang, "source": name, "item": names[some], "apart": np.abs(m[some] - row).sum(axis=1) - gap * len(terms), "gap": gap}))
    return pd.concat(out) if out else pd.DataFrame(columns=["lang", "source", "item", "apart", "gap"])


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for all ordered pairs of a language's
    sources.  A block holds the shares of some terms; terms that neither source
    of a pair has are added without being listed."""
    most = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("s"), F.max("terms").alias("v")).agg(F.max("s"), F.max(F.col("s") * F.col("v"))).first()
    tiles, blocks = ceil_div(most[0] or 1, TILE), max(1, ceil_div(most[1] or 1, CELLS))
    tile = F.pmod(F.xxhash64("source"), F.lit(tiles)).cast("int").alias("tile")
    entries = shares.select("lang", "source", tile, F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int").alias("block"), "term", "p")
    bases = groups.select("lang", "source", tile, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(None).cast("string").alias("term"), F.col("base").alias("p"))
    other = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("other")
    rows = entries.unionByName(bases).select("*", other).withColumn("a", F.least("tile", "other")).withColumn("b", F.greatest("tile", "other"))
    sums = rows.drop("other").groupBy("lang", "block", "a", "b").applyInPandas(_pair_sums, "lang string, source string, item string, apart long, gap long")
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("apart").alias("apart"), F.max("gap").alias("gap"))
    terms = groups.groupBy("lang").agg(F.max("terms").alias("terms"))
    one_way = stage(lookup_join(sums, terms, ["lang"], F.xxhash64("source", "item")).select("lang", "source", "item", (F.col("apart") + F.col("gap") * F.col("terms")).alias("value")), "source-pairs")
    return one_way.unionByName(one_way.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))


def divergence_audit(docs: DataFrame, min_docs: int = 30, top: int = 50) -> DataFrame:
    """``lang, source, part, item, value, rank``: how a language's sources differ
    in the shares of their terms.

    Terms are runs of letters, A-Z lower-cased; a language keeps those in at
    least ``min_docs`` of its rows.  A group (lang, source), and each language,
    gives a kept term the share ``share(count, counts of all kept terms, number
    of kept terms)``.  Part ``pair`` holds, for each group, every other source of
    the language with the sum of the shares' differences; part ``term`` the
    ``top`` kept terms of the group whose share exceeds the language's, by the
    excess.  Ranks run from 1 by value, descending, then by item in byte order.

    Null texts, languages and sources count as empty ones.  Every row is a
    document, also if it repeats another.  A group without terms has its pairs
    (with value 0 where a language keeps no term), a language with one source has
    none, an empty table gives no rows, and other columns are ignored.  A chunk
    of texts has to fit into a task's memory, so one text does.
    """
    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    docs = docs.select(blank("lang"), blank("source"), blank("text"))
    group = ["lang", "source"]
    counts = stage(docs.mapInArrow(count_terms, COUNTS).groupBy(*group, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")
    kept = stage(counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).drop("docs"), "kept-terms")
    own = stage(counts.drop("docs").join(kept, ["lang", "term"]), "kept-counts")

    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_total"))
    sizes = own.groupBy(*group).agg(F.sum("n").alias("group_total"))
    groups = docs.select(*group).distinct().join(langs, "lang", "left").join(sizes, group, "left").na.fill(0, ["terms", "lang_total", "group_total"])
    none = F.lit(0).cast("long")
    base = F.when(F.col("terms") > 0, share(none, F.col("group_total"), F.col("terms"))).otherwise(none)
    groups = stage(groups.withColumn("base", base), "groups")

    of = lambda n, total: share(F.col(n), F.col(total), F.col("terms"))
    shares = stage(lookup_join(own, groups, group, F.xxhash64("term")).select(*group, "term", of("n", "group_total").alias("p"), of("total", "lang_total").alias("q")), "shares")
    terms = shares.where(F.col("p") > F.col("q")).select(*group, F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    pairs = _pairs(shares, groups).select(*group, F.lit("pair").alias("part"), "item", "value")
    order = Window.partitionBy(*group).orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    return ranked(terms).where(F.col("rank") <= top).unionByName(ranked(pairs)).withColumn("rank", F.col("rank").cast("int"))
