"""Packing documents into fixed windows by non-negative least squares.

A document of ``n`` ids fills ``n // window`` windows alone; its tail of
``n mod window`` ids is packed with other tails.  The histogram of tail lengths
(at most ``window - 1`` counts) is all that the driver sees.  It enumerates the
pairs and triples of lengths that fill a window exactly, solves for how often to
repeat each so that the histogram is met in the least-squares sense with no
negative count, rounds by largest remainders, and uses up what exact combinations
the rounding left.  The residual tails are packed greedily, longest first: they are laid end
to end and cut where a window ends, so that only the last window has padding.

Which tail of a length goes where follows from its number among the tails of
that length; numbers are counted in hashed buckets and added up over them.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from string import punctuation as PUNCTUATION

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from occulink.llm.chunks import ChunkEncoder
from occulink.llm.common import ceil_div, stage
from occulink.llm.words import text_column

WINDOW, END_ID = 2048, 1
#: Rows that one numbering bucket holds on average.
BUCKET_ROWS = 20_000
#: Chunks that the tokenizer gets as one text.
TOGETHER = 2_000
#: Words whose ids a worker keeps before it forgets them all.
KNOWN_WORDS = 600_000
#: Below it (Latin, Greek, Cyrillic) Python and the tokenizer agree on what a letter is.
BEYOND = "\u0530"


def _byte_characters() -> dict[int, int]:
    """The characters by which ByteLevel vocabularies write bytes: printable ones
    stand for themselves, the others follow from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


BYTE_CHARACTERS = _byte_characters()


def _written(word: str) -> str:
    return word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_CHARACTERS)


#: Bytes of text whose words are told apart together: of larger parts fewer words
#: are distinct, but a worker's arrays grow with them.
PART_BYTES = 12_000_000


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # their strings in a text are ordinary text

    # ByteLevel writes a byte as one character, so a token's length is its bytes
    size = np.zeros(t.get_vocab_size(), np.int64)
    for token, i in t.get_vocab(with_added_tokens=False).items():
        size[i] = len(token)

    tokenize, known = t.model.tokenize, {}

    def match(written: str) -> bytes:
        """Ids of one match of the word pattern, its bytes written as characters."""
        found = [x.id for x in tokenize(written)]
        return struct.pack(f"<{len(found)}I", *found)

    def alone(chunk: str) -> bytes:
        return np.array(t.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(chunks: list[str]) -> list[bytes]:
        """A space, letters and then ASCII punctuation are two matches, whose ids
        the model gives.  Other chunks led by one space stay apart when they
        follow one another, so many are encoded as one text and cut where their
        bytes end."""
        out = [b""] * len(chunks)
        run = []
        if len(known) > KNOWN_WORDS:
            known.clear()
        for i, c in enumerate(chunks):
            core = c[1:].rstrip(PUNCTUATION)
            if c[:1] == " " and ((ids := known.get(core)) or (core.isalpha() and (core.isascii() or max(core) < BEYOND))):
                if not ids:
                    ids = known[core] = match("Ġ" + _written(core))
                if len(core) + 1 < len(c):
                    end = c[len(core) + 1 :]  # never a core: those end otherwise
                    if (more := known.get(end)) is None:
                        more = known[end] = match(end)
                    ids += more
                out[i] = ids
            elif len(c) > 1 and c[0] == " " and not c[1].isspace() and not c[-1].isspace():
                run.append(i)
            else:
                out[i] = alone(c)
        for at in range(0, len(run), TOGETHER):
            some = run[at : at + TOGETHER]
            ids = np.array(t.encode_batch_fast(["".join([chunks[i] for i in some])], add_special_tokens=False)[0].ids, "<u4")
            bytes_to = np.cumsum([len(chunks[i].encode()) for i in some])
            reached = np.cumsum(size[ids])
            ends = np.searchsorted(reached, bytes_to) + 1
            if not np.array_equal(reached[ends - 1], bytes_to):
                raise AssertionError("a token crosses two chunks")
            raw, begin = ids.tobytes(), 0
            for i, end in zip(some, (4 * ends).tolist(), strict=True):
                out[i] = raw[begin:end]
                begin = end
        return out

    return ChunkEncoder(encode, PART_BYTES, cached=False)


def tokenised(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """``row, doc_id, n, ids``: the ids of each whole text and then ``end_id``,
    as little-endian unsigned 32-bit numbers.  A null text counts as empty."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, starts = encoder(path)(text_column(b))
            raw = [ids[a:z].tobytes() + np.uint32(end_id).tobytes() for a, z in zip(starts, starts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), pa.array(np.diff(starts) + 1), pa.array(raw, pa.binary())], names=["row", "doc_id", "n", "ids"])

    schema = T.StructType([T.StructField("row", T.LongType()), docs.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType())])
    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(encode, schema)


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Pairs (third length 0) and triples of the given lengths, descending, that
    add up to the window."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    a = lengths[(lengths * 2 >= window) & there[window - lengths]]
    out = [np.column_stack([a, window - a, np.zeros_like(a)])]
    for x in lengths[lengths * 3 >= window]:
        rest = window - x
        y = lengths[(lengths <= x) & (lengths * 2 >= rest) & (lengths < rest)]
        y = y[there[rest - y]]
        out.append(np.column_stack([np.full_like(y, x), y, rest - y]))
    return np.concatenate(out)


def solve(combos: np.ndarray, histogram: np.ndarray, rounds: int = 150) -> np.ndarray:
    """Non-negative repeat counts ``x`` that lessen ``|A x - histogram|**2`` each
    round; ``A`` counts a combination's lengths.  (Multiplicative updates keep
    every count non-negative.)"""
    h = histogram.astype(float).copy()
    h[0] = 0
    real = (combos > 0).astype(float)
    pull = (h[combos] * real).sum(axis=1)
    x = np.full(len(combos), h.sum() / max(len(combos), 1) / 3)
    for _ in range(rounds):
        met = np.bincount(combos.ravel(), weights=np.repeat(x, 3), minlength=len(h))
        met[0] = 0
        x *= pull / np.maximum((met[combos] * real).sum(axis=1), 1e-12)
    return x


@dataclass
class Plan:
    """``tails[i] = (length, first number, sequence, offset)``, ordered: the tail
    of that length with number ``first + j`` goes to ``sequence + j``.  From
    ``rest_from[length]`` on, tails lie end to end from ``rest_at[length]``.  The
    first ``solved`` of the ``sequences`` come from the least-squares solution."""

    window: int
    tails: np.ndarray
    sequences: int
    rest_from: np.ndarray
    rest_at: np.ndarray
    solved: int = 0


def plan(histogram: np.ndarray, window: int = WINDOW) -> Plan:
    """Where the tails counted by ``histogram[length]`` go."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    used = np.zeros_like(left)
    tails, sequences, solved = [], 0, 0

    def place(combo: np.ndarray, times: int) -> None:
        nonlocal sequences
        offset = 0
        for length in combo:
            if length:
                tails.append((length, used[length], sequences, offset))
                used[length] += times
                left[length] -= times
                offset += length
        sequences += times

    def most(combo: np.ndarray) -> int:
        a, b, c = (int(x) for x in combo)
        kinds = [x for x in (a, b, c) if x]
        return int(min(left[x] // kinds.count(x) for x in kinds))

    lengths = np.nonzero(left)[0]
    combos = combinations(lengths, window) if len(lengths) else np.zeros((0, 3), np.int64)
    if len(combos):
        exact = solve(combos, histogram)
        x = np.floor(exact).astype(np.int64)
        order = np.argsort(-x, kind="stable")
        for i in order[x[order] > 0]:
            if times := min(int(x[i]), most(combos[i])):
                place(combos[i], times)
        wanted = round(exact.sum())
        for i in np.argsort(x - exact, kind="stable"):  # largest remainder first
            if sequences >= wanted:
                break
            if exact[i] > x[i] and most(combos[i]):
                place(combos[i], 1)
        solved = sequences
        for i in np.nonzero((left[combos[:, 0]] > 0) & (left[combos[:, 1]] > 0))[0]:
            if times := most(combos[i]):
                place(combos[i], times)
    at = np.zeros_like(left)
    down = np.arange(len(left))[::-1]
    at[down] = np.cumsum((left * np.arange(len(left)))[down]) - (left * np.arange(len(left)))[down]
    table = np.array(sorted(tails), np.int64).reshape(-1, 4)
    return Plan(window, table, sequences, used, at, solved)


def cut(p: Plan, n: np.ndarray, full_before: np.ndarray, number: np.ndarray, fulls: int) -> list[list[tuple[int, int, int, int]]]:
    """Pieces ``(start, length, sequence, offset)`` of documents of ``n`` ids."""
    w, keys = p.window, p.tails[:, 0] * (1 << 40) + p.tails[:, 1]
    tail = n % w
    at = np.searchsorted(keys, tail * (1 << 40) + number, side="right") - 1
    out = []
    for i, size in enumerate(n.tolist()):
        full, length = divmod(size, w)
        first = int(full_before[i])
        pieces = [(j * w, w, first + j, 0) for j in range(full)]
        if length:
            k, start = int(number[i]), full * w
            if k < p.rest_from[length]:
                _, begin, sequence, offset = p.tails[at[i]].tolist()
                pieces.append((start, length, fulls + sequence + k - begin, offset))
            else:
                position = int(p.rest_at[length]) + (k - int(p.rest_from[length])) * length
                while length:
                    sequence, offset = divmod(position, w)
                    part = min(length, w - offset)
                    pieces.append((start, part, fulls + p.sequences + sequence, offset))
                    start, position, length = start + part, position + part, length - part
        out.append(pieces)
    return out


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, ids`` (little-endian
    unsigned 32-bit), ``doc_tokens, sequence_id, offset``.

    Each id of each row lies in exactly one piece.  Null and empty texts are the
    end id alone; repeated rows and rows without an id are documents of their
    own; texts longer than the window are cut; an empty table gives no rows.
    """
    tokens = stage(tokenised(docs, path, end_id), "tokens")
    rows = tokens.select("row", "n", (F.col("n") % window).cast("int").alias("tail"), F.floor(F.col("n") / window).cast("long").alias("full"))
    counts = rows.groupBy("tail").agg(F.count(F.lit(1)).alias("rows"), F.sum("full").alias("full")).collect()  # window rows at most
    histogram = np.zeros(window + 1, np.int64)
    for r in counts:
        histogram[r["tail"]] = r["rows"]
    fulls, total = sum(r["full"] for r in counts), sum(r["rows"] for r in counts)
    p = plan(histogram, window)

    buckets = ceil_div(max(total, 1), BUCKET_ROWS)
    spread = rows.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int"))
    sums = stage(spread.groupBy("bucket", "tail").agg(F.count(F.lit(1)).alias("rows"), F.sum("full").alias("full")), "tail-counts")
    before = Window.partitionBy("tail").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    tail_base = sums.select("bucket", "tail", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("tail_base"))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # a row for each bucket
    full_base = sums.groupBy("bucket").agg(F.sum("full").alias("full")).select("bucket", F.coalesce(F.sum("full").over(earlier), F.lit(0)).alias("full_base"))
    inside = Window.partitionBy("bucket").orderBy("row")
    numbered = (
        spread.withColumn("number", F.row_number().over(Window.partitionBy("bucket", "tail").orderBy("row")) - 1)
        .withColumn("full_before", F.coalesce(F.sum("full").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .join(tail_base, ["bucket", "tail"])
        .join(full_base, "bucket")
        .select("row", (F.col("number") + F.col("tail_base")).alias("number"), (F.col("full_before") + F.col("full_base")).alias("full_before"))
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = lambda k: b.column(k).to_numpy(zero_copy_only=False)  # noqa: B023, E731
            n = col("n")
            pieces = cut(p, n, col("full_before"), col("number"), fulls)
            raw, of, parts = b.column("ids"), [], []
            ids = [raw[i].as_py() for i in range(len(n))]
            flat = [(i, *x) for i, row in enumerate(pieces) for x in row]
            of = np.array([x[0] for x in flat], np.int64)
            parts = [ids[i][4 * s : 4 * (s + k)] for i, s, k, _, _ in flat]
            col2 = [pa.array(np.array([x[j] for x in flat], np.int64)) for j in (1, 2, 3, 4)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(of)), col2[0], col2[1], pa.array(parts, pa.binary()), pa.array(n[of].astype(np.int64)), col2[2], col2[3]],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    long = lambda k: T.StructField(k, T.LongType())
    schema = T.StructType([docs.schema["doc_id"], long("start"), long("length"), T.StructField("ids", T.BinaryType()), long("doc_tokens"), long("sequence_id"), long("offset")])
    return tokens.join(numbered, "row").select("doc_id", "n", "ids", "number", "full_before").mapInArrow(split, schema)
