"""Stupid-backoff language-model scores from n-gram count tables.

Texts become blocks of words; a text's first words are padded in front.  A block
holds the distinct n-grams of every length that occur in it, pre-counted, and sends
them to the count table, which is dealt by ranges of the n-gram's hash: one row for
each block and range, whose keys and counts are packed arrays, as a row for every
n-gram takes several times the disk.  Each range sums its counts over all blocks,
and a join by block brings them back to the n-grams that asked.  A context's count is
that of its n-gram less the texts that end with it, so contexts need no rows of their
own.  Blocks are scored by their counts and summed for each document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from occulink.llm.common import ceil_div, stage, stage_by_key
from occulink.llm.jaccard import MIX, _scramble
from occulink.llm.words import split_words, text_column, word_hashes

#: Bytes of text of a block (more only by its last text) and words of the whole
#: table for each range of the count tables.
BLOCK_BYTES, RANGE_WORDS = 8_000_000, 1_500_000


@dataclass(frozen=True)
class Settings:
    order: int = 3
    alpha: float = 0.4


def _packed(x: np.ndarray) -> bytes:
    """The number of integers and their compressed bytes, those of equal weight
    together."""
    raw = np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(-1, 8).T)
    return len(x).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def _unpacked(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    planes = pa.Codec("zstd").decompress(raw[8:], decompressed_size=8 * n, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, n).T).view(np.uint64).ravel()


def word_blocks(docs: DataFrame) -> DataFrame:
    """The words of ``docs(doc_id, text)``, one row (``block``) for every
    ``BLOCK_BYTES`` or so: ``n`` words, the texts' ids and numbers of words, the
    gaps between the ascending hashes of the distinct words and each word's place
    among those."""
    ids = docs.schema["doc_id"].dataType

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = pc.fill_null(pc.binary_length(text_column(b)), 0).to_numpy(zero_copy_only=False)
            number = (np.cumsum(size, dtype=np.int64) - size) // BLOCK_BYTES
            starts = np.flatnonzero(np.diff(number, prepend=-1))
            for a, z in zip(starts, [*starts[1:], b.num_rows], strict=True):
                part = b.slice(a, z - a)
                w = split_words(text_column(part))
                hashes, place = np.unique(word_hashes(w.distinct), return_inverse=True)
                blobs = [w.lengths, np.diff(hashes, prepend=np.uint64(0)), place[w.codes]]
                listed = pa.ListArray.from_arrays(pa.array([0, z - a], pa.int32()), part.column("doc_id"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("block").slice(0, 1), pa.array([len(w.codes)], pa.int64()), listed, *(pa.array([_packed(x)], pa.binary()) for x in blobs)],
                    names=["block", "n", "ids", "lengths", "words", "codes"],
                )

    kinds = [T.StructField("block", T.LongType()), T.StructField("n", T.LongType()), T.StructField("ids", T.ArrayType(ids))]
    blobs = [T.StructField(k, T.BinaryType()) for k in ("lengths", "words", "codes")]
    return docs.select("doc_id", "text", F.monotonically_increasing_id().alias("block")).mapInArrow(read, T.StructType([*kinds, *blobs]))


@dataclass
class Grams:
    """The n-grams of a block.  ``keys``: hashes of the distinct ones, ascending;
    ``times``: how often each occurs; ``ends``: how often at the end of a text.
    ``at[k]``: the place in ``keys`` of the n-gram of ``k`` words that ends with each
    word, ``before[k]`` of the one that ends with the word before."""

    lengths: np.ndarray
    keys: np.ndarray
    times: np.ndarray
    ends: np.ndarray
    at: dict[int, np.ndarray]
    before: dict[int, np.ndarray]


def block_grams(lengths: np.ndarray, hashes: np.ndarray, order: int) -> Grams:
    """``hashes`` of the words of texts with ``lengths`` words each.  Before a
    text stand words of hash 0; an n-gram of them alone occurs once a text."""
    n, pad = len(hashes), order - 1
    first = np.cumsum(lengths) - lengths
    starts, lasts = first[lengths > 0], (first + lengths - 1)[lengths > 0]
    place = np.arange(n) + pad * np.repeat(np.cumsum(lengths > 0), lengths)
    padded = np.zeros(n + pad * len(starts), np.uint64)
    padded[place] = hashes
    parts = []
    for k in range(1, order + 1):
        h, blank = np.full(n, k, np.uint64), np.full(1, k, np.uint64)
        for back in range(k - 1, -1, -1):
            h = _scramble(h * MIX + padded[place - back])
            blank = _scramble(blank * MIX)
        parts += [h, blank]
    keys, inverse = np.unique(np.concatenate(parts), return_inverse=True)
    inverse = inverse.astype(np.int32)
    times, ends = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    at, before = {}, {}
    for k in range(1, order + 1):
        a = (k - 1) * (n + 1)
        at[k] = inverse[a : a + n]
        times += np.bincount(at[k], minlength=len(keys))
        if k < order:
            blank = inverse[a + n]
            times[blank] += len(starts)
            ends += np.bincount(at[k][lasts], minlength=len(keys))
            before[k] = np.roll(at[k], 1)
            before[k][starts] = blank
    return Grams(lengths, keys, times, ends, at, before)


def _grams(row: dict, order: int) -> Grams:
    words = np.cumsum(_unpacked(row["words"]), dtype=np.uint64)
    return block_grams(_unpacked(row["lengths"]).view(np.int64), words[_unpacked(row["codes"]).view(np.int64)], order)


def _ranges(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of the ``ranges`` of hashes begins in ascending ``keys``, and the end."""
    bounds = np.array([(r << 64) // ranges for r in range(ranges)], np.uint64)
    return np.append(np.searchsorted(keys, bounds), len(keys))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for x in range(b.num_rows):
            yield b.slice(x, 1).to_pylist()[0]


def sent_grams(blocks: DataFrame, order: int, ranges: int, known: bool, asks: bool) -> DataFrame:
    """``range, block, asks, keys, times, ends``: the distinct n-grams of each
    block by range of their hash.  ``known``: their counts belong to the corpus;
    ``asks``: the block waits for the corpus's counts."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            g = _grams(row, order)
            starts = _ranges(g.keys, ranges)
            for r in np.flatnonzero(np.diff(starts)):
                part = slice(starts[r], starts[r + 1])
                gaps = np.diff(g.keys[part], prepend=np.uint64(0))
                counts = [_packed(x[part] if known else np.zeros(len(gaps))) for x in (g.times, g.ends)]
                cells = [int(r), row["block"], asks, _packed(gaps), *counts]
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, cells, strict=True))], schema)

    schema = pa.schema([("range", pa.int32()), ("block", pa.int64()), ("asks", pa.bool_()), ("keys", pa.binary()), ("times", pa.binary()), ("ends", pa.binary())])
    return blocks.select("block", "lengths", "words", "codes").mapInArrow(send, "range int, block long, asks boolean, keys binary, times binary, ends binary")


def counted(sent: DataFrame) -> DataFrame:
    """``block, counts``: for each range that a block has n-grams in, how often
    they occur in the corpus and how often at the end of a text, in the order of
    the block's keys."""

    def count(group: pa.Table) -> pa.Table:
        rows = group.select(["asks", "keys", "times", "ends"]).to_pylist()
        keys = [np.cumsum(_unpacked(r["keys"]), dtype=np.uint64) for r in rows]
        last = np.cumsum([len(x) for x in keys])
        spans = [slice(z - len(x), z) for x, z in zip(keys, last, strict=True)]
        once, code = np.unique(np.concatenate(keys), return_inverse=True)
        sums = []
        for kind in ("times", "ends"):
            total = np.zeros(len(once), np.uint64)
            for r, span in zip(rows, spans, strict=True):  # a block's keys are distinct
                total[code[span]] += _unpacked(r[kind])
            sums.append(total)
        out = [pa.array([_packed(total[code[span]]) for r, span in zip(rows, spans, strict=True) if r["asks"]], pa.binary()) for total in sums]
        some = group.filter(group.column("asks"))
        return pa.table([some.column("block"), some.column("range"), *out], ["block", "range", "times", "ends"])

    replies = sent.groupBy("range").applyInArrow(count, "block long, range int, times binary, ends binary")
    return replies.groupBy("block").agg(F.collect_list(F.struct("range", "times", "ends")).alias("counts"))


def word_scores(g: Grams, times: np.ndarray, ends: np.ndarray, total: int, s: Settings, inside: bool) -> np.ndarray:
    """The score of each word of a block by the corpus's counts of its n-grams.
    ``inside``: the words come from the corpus, and one occurrence, the scored
    one, is taken off every count."""
    less, longest = int(inside), s.order
    score = np.zeros(len(g.at[1]))
    left = np.ones(len(score), bool)
    for k in range(longest, 1, -1):
        seen = times[g.at[k]] - less
        hit = left & (seen > 0)
        context = g.before[k - 1][hit]
        score[hit] = s.alpha ** (longest - k) * seen[hit] / (times[context] - ends[context] - less)
        left &= ~hit
    # a word seen nowhere else counts once
    score[left] = s.alpha ** (longest - 1) * np.maximum(times[g.at[1][left]] - less, 1) / max(total, 1)
    return score


def backoff_scores(docs: DataFrame, corpus: DataFrame | None = None, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_words, log_score, mean_log`` of every document: the sum and
    the mean (6 decimals) of the natural logarithms of its words' scores.

    Without ``corpus`` the documents are their own corpus, and a word's own
    occurrence is taken off the counts, so that it is scored by all others.
    Words are lower-case and end at white space.  Null, empty and blank texts
    have no words, a sum of 0 and no mean; repeated rows are documents of their
    own; an empty table gives no rows; further columns are not read.
    """
    s, inside = settings, corpus is None
    blocks = stage_by_key(word_blocks(docs.select("doc_id", "text")), "lm_blocks", "block")
    others = blocks if inside else stage(word_blocks(corpus.select(F.lit(None).cast("long").alias("doc_id"), "text")), "lm-corpus")
    total = others.agg(F.sum("n")).first()[0] or 0
    words = total if inside else total + (blocks.agg(F.sum("n")).first()[0] or 0)
    ranges = max(1, ceil_div(words, RANGE_WORDS))
    sent = sent_grams(blocks, s.order, ranges, known=inside, asks=True)
    if not inside:
        sent = sent.unionAll(sent_grams(others, s.order, ranges, known=True, asks=False))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x, row in enumerate(_rows([b.drop_columns(["ids"])])):
                g = _grams(row, s.order)
                starts = _ranges(g.keys, ranges)
                times, ends = np.zeros((2, len(g.keys)), np.int64)
                for c in row["counts"]:
                    a, z = starts[c["range"]], starts[c["range"] + 1]
                    times[a:z] = _unpacked(c["times"]).view(np.int64)
                    ends[a:z] = _unpacked(c["ends"]).view(np.int64)
                logs = np.log(word_scores(g, times, ends, total, s, inside))
                sums = np.bincount(np.repeat(np.arange(len(g.lengths)), g.lengths), weights=logs, minlength=len(g.lengths))
                yield pa.RecordBatch.from_arrays([b.column("ids")[x].values, pa.array(g.lengths), pa.array(sums)], names=["doc_id", "n_words", "log_sum"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("log_sum", T.DoubleType())])
    got = blocks.select("block", "ids", "lengths", "words", "codes").join(counted(sent).hint("merge"), "block").mapInArrow(read, schema)
    mean = F.when(F.col("n_words") > 0, F.round(F.col("log_sum") / F.col("n_words"), 6))
    return got.select("doc_id", "n_words", F.round("log_sum", 6).alias("log_score"), mean.alias("mean_log"))
