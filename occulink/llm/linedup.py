"""Removal of repeated passages by content-defined chunks of lines.

A text is read as lines; a sentence end inside a line also ends one, so that a
passage pasted into a paragraph falls into the same lines as anywhere else.  A
rolling hash over the last ``window`` line hashes ends a chunk where it divides
by ``divisor``: boundaries follow from nearby lines only and move along with
them.  Chunk hashes are counted over all documents; a chunk that occurs again is
compared with its first occurrence, line by line.  Neighbouring chunks that are
equal to first ones make up a run, and runs of enough words are removed: a short
line that is common by itself stays, the same line inside a passage goes.  Where
a passage begins or ends inside a chunk, its lines there are compared one by one.

A short passage need not hold a whole chunk.  So (``EVERY``) the shortest runs of lines with
enough words, from each line on and up to each line, are counted and compared in
the same way.  Any passage of whole lines with enough words holds the run from
its first line on and the one up to its last, and such runs make it up: it is
found whatever stands around it.

Texts stay where they are: neighbouring ones make up a block, stored once, and
what travels are arrays of its lines and spans.  Lines are counted first: a chunk or
run can only occur again if each of its lines does.  Blocks send their distinct lines,
hash and content, to buckets, which compare the contents byte by byte and return one
bit a line.  From then on equal hashes of lines are equal lines; blocks send the line
hashes of chunks and runs of repeated lines to buckets, which compare them one by one
with those of the first occurrence.  (``lines`` to ``holes`` are the plain forms of the
steps on arrays, on one text.)
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from occulink.llm.chunks import parts
from occulink.llm.common import ceil_div, stage_by_key
from occulink.llm.jaccard import MIX, _scramble

LINE_END = re.compile(r"[.!?…\n](?:(?<=\n)\n*|(?<!\n)[ \t]+)")  # only the ends of matches count
BASE, MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
#: Bytes of a block of texts (more only by one longer text); lines of a bucket.
BLOCK_BYTES, BUCKET_LINES = 4_000_000, 250_000
_BLOBS = ("rows", "counts", "lengths", "begins", "finishes", "words", "hashes")
SHORT = 1 << 30  # added to a shortest run's first line, which sets ``at`` apart from that of chunks


@dataclass(frozen=True)
class Rules:
    """``least_words``: words of a run of repeated chunks or lines that is removed;
    ``short_runs``: besides chunks, compare the shortest runs of lines."""

    window: int = 2
    divisor: int = 2
    least_words: int = 16
    short_runs: bool = False


#: As the queries use them: every repeated passage of whole lines is found.
EVERY = Rules(short_runs=True)


def lines(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the lines; together they are the whole text."""
    at = 0
    for m in LINE_END.finditer(text):
        yield at, m.end()
        at = m.end()
    if at < len(text):
        yield at, len(text)


def chunks(text: str, rules: Rules = Rules()) -> Iterator[tuple[int, int, str]]:
    """``(start, end, content)`` of each chunk; blank lines go with the chunk that
    they follow or begin."""
    start = end = 0
    recent: list[int] = []
    bodies: list[str] = []
    for s, e in lines(text):
        end = e
        if not (body := text[s:e].strip()):
            continue
        bodies.append(body)
        recent = [*recent, xxhash.xxh64_intdigest(body)][-rules.window :]
        roll = 0
        for h in recent:
            roll = (roll * BASE + h) & MASK
        if (roll >> 32) % rules.divisor == 0:
            yield start, end, "\n".join(bodies)
            start, bodies = end, []
    if end > start:
        yield start, end, "\n".join(bodies)


def shortest_runs(text: str, rules: Rules = Rules()) -> list[tuple[int, int, int, str]]:
    """``(first line, start, end, content)`` of the shortest runs of lines, blank
    ones not counted, that have enough words: from each line on, and up to each."""
    spans = [(s, e, body) for s, e in lines(text) if (body := text[s:e].strip())]
    counts = [len(body.split()) for _, _, body in spans]
    found, first, last, words = set(), 0, 0, 0
    for first in range(len(counts)):
        while words < rules.least_words and last < len(counts):
            words, last = words + counts[last], last + 1
        if words < rules.least_words:
            break
        found.add((first, last))
        words -= counts[first]
    first = words = 0
    for last, n in enumerate(counts, 1):
        words += n
        while words - counts[first] >= rules.least_words:
            words, first = words - counts[first], first + 1
        if words >= rules.least_words:
            found.add((first, last))
    return [(a, spans[a][0], spans[b - 1][1], "\n".join(x[2] for x in spans[a:b])) for a, b in sorted(found)]


def cover(spans: list[dict]) -> list[dict]:
    """Few of the spans (``begin``, ``finish``) that cover what all of them do."""
    out, best, end = [], None, -1
    for x in sorted(spans, key=lambda x: (x["begin"], -x["finish"])):
        if best and x["begin"] > end:
            out.append(best)
            best, end = None, best["finish"]
        if x["begin"] > end:
            out.append(x)
            end = x["finish"]
        elif x["finish"] > (best or {"finish": end})["finish"]:
            best = x
    return [*out, best] if best else out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans, with those that meet made one."""
    out: list[tuple[int, int]] = []
    for begin, finish in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(finish, out[-1][1]))
        else:
            out.append((begin, finish))
    return out


def holes(repeats: list[tuple[int, int, int, int]], rules: Rules = Rules()) -> list[tuple[int, int]]:
    """Spans to remove from a text with the repeated chunks ``(at, begin, finish,
    words)``, ascending: each run of neighbours that has enough words."""
    out, run, words, last = [], [0, 0], 0, None
    for at, begin, finish, n in [*repeats, (-1, 0, 0, 0)]:
        if last is None or at != last + 1:
            if words >= rules.least_words:
                out.append((run[0], run[1]))
            run, words = [begin, finish], 0
        run[1], words, last = finish, words + n, at
    return out


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of texts without nulls, and where each text begins."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], (at - at[0]).astype(np.int64)


def _strings(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    kind, width = kind or pa.string(), np.int64 if kind == pa.large_binary() else np.int32
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(offsets.astype(width).tobytes()), pa.py_buffer(np.ascontiguousarray(data))])


def _line_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where lines end, ascending, in the bytes of texts that begin at ``offsets``:
    the ends of ``lines``."""
    bounds = np.unique(offsets)
    first, last = bounds[:-1], bounds[1:] - 1  # bytes of texts that are not empty

    def runs(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        before, after = np.roll(of, 1), np.roll(of, -1)
        before[first] = after[last] = False
        return np.flatnonzero(of & ~before), np.flatnonzero(of & ~after) + 1

    if not len(data):
        return bounds[:0]
    _, broken = runs(data == 10)
    begin, end = runs((data == 32) | (data == 9))
    inside = np.ones(len(data) + 1, bool)
    inside[first] = False
    begin, end = begin[inside[begin]], end[inside[begin]]
    sign, one, two = data[begin - 1], data[np.maximum(begin - 2, 0)], data[np.maximum(begin - 3, 0)]
    closed = (sign == 0x2E) | (sign == 0x21) | (sign == 0x3F) | ((sign == 0xA6) & (one == 0x80) & (two == 0xE2))
    return np.unique(np.concatenate([broken, end[closed], bounds[1:]]))


def _line_hashes(distinct: list[str]) -> np.ndarray:
    """A hash of each line; no two that differ share one without its lowest bit."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))
    seed = 0
    while True:
        _, one = np.unique(hashes >> np.uint64(1), return_index=True)
        if len(one) == len(distinct):
            return hashes
        seed += 1
        for i in np.setdiff1d(np.arange(len(distinct)), one).tolist():
            hashes[i] = xxhash.xxh64_intdigest(distinct[i], seed)


def _lines(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Of texts without nulls: lines and bytes of each text, and of each line that is
    not blank its begin and finish in the text's bytes, words and hash."""
    data, offsets = _buffer(texts)
    ends = _line_ends(data, offsets)
    begins = np.concatenate([np.zeros(1, np.int64), ends])[:-1]
    bodies = pc.utf8_trim_whitespace(_strings(data, np.concatenate([np.zeros(1, np.int64), ends])))
    some = np.flatnonzero(pc.binary_length(bodies).to_numpy(zero_copy_only=False) > 0)
    begins, ends = begins[some], ends[some]
    d = bodies.take(pa.array(some)).dictionary_encode()
    codes = d.indices.to_numpy(zero_copy_only=False)
    words = pc.list_value_length(pc.utf8_split_whitespace(d.dictionary)).to_numpy(zero_copy_only=False)
    text = np.searchsorted(offsets, begins, "right") - 1
    counts = np.bincount(text, minlength=len(texts))
    return counts, np.diff(offsets), begins - offsets[text], ends - offsets[text], words[codes], _line_hashes(d.dictionary.to_pylist())[codes]


def line_blocks(numbered: DataFrame) -> DataFrame:
    """Blocks of neighbouring texts: one row (``block``) for every ``BLOCK_BYTES`` or so.
    ``docs`` holds the rows as an Arrow stream; per text its ``__row``, number of
    lines and bytes, per line that is not blank its hash, span and words."""
    names = [f.name for f in numbered.schema.fields if f.name != "__row"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, at = pc.fill_null(b.column(b.schema.names.index("text")).cast(pa.string()), ""), 0
            docs = b.select(names)
            for part in parts(texts, BLOCK_BYTES):
                kept = docs.slice(at, len(part))
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, kept.schema) as out:
                    out.write_batch(kept)
                rows = b.column(b.schema.names.index("__row")).slice(at, len(part)).to_numpy()
                at += len(part)
                *ints, hashes = _lines(part)
                ids = kept.column(names.index("doc_id"))
                listed = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.concat_arrays([ids]))
                blobs = [pa.array([x.tobytes()], pa.binary()) for x in (rows, *(x.astype(np.int32) for x in ints), hashes)]
                yield pa.RecordBatch.from_arrays([pa.array(rows[:1]), pa.array([len(hashes)], pa.int64()), listed, pa.array([sink.getvalue().to_pybytes()], pa.binary()), *blobs], names=["block", "n", "ids", "docs", *_BLOBS])

    ids = T.ArrayType(numbered.schema["doc_id"].dataType)
    kinds = [T.StructField("block", T.LongType()), T.StructField("n", T.LongType()), T.StructField("ids", ids), T.StructField("docs", T.BinaryType())]
    return numbered.mapInArrow(read, T.StructType([*kinds, *(T.StructField(k, T.BinaryType()) for k in _BLOBS)]))


def _docs(raw: pa.Scalar) -> pa.RecordBatch:
    return pa.ipc.open_stream(raw.as_buffer()).read_next_batch()


def _arrays(b: pa.RecordBatch, x: int) -> dict[str, np.ndarray]:
    """The arrays of block ``x`` of a batch."""
    raw = {k: b.column(b.schema.names.index(k))[x].as_buffer() for k in _BLOBS}
    kinds = {"rows": np.int64, "hashes": np.uint64}
    return {k: np.frombuffer(v, kinds[k]) if k in kinds else np.frombuffer(v, np.int32).astype(np.int64) for k, v in raw.items()}


def _dealt(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, ...]:
    """A block's distinct keys (hashes without their lowest bit) by bucket, how
    often each occurs, a line of each, and where the buckets begin."""
    keys, one, times = np.unique(hashes & ~np.uint64(1), return_index=True, return_counts=True)
    bucket = (keys >> np.uint64(40)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    return keys[order], times[order], one[order], np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))


def _bodies(texts: pa.Array, counts: np.ndarray, begins: np.ndarray, finishes: np.ndarray, which: np.ndarray) -> pa.Array:
    """The contents of some lines."""
    data, offsets = _buffer(texts)
    first = np.repeat(offsets[:-1], counts)
    begins, finishes = begins + first, finishes + first
    bounds = np.unique(np.concatenate([[0], begins, finishes, [len(data)]]))
    pieces = _strings(data, bounds)
    return pc.utf8_trim_whitespace(pieces.take(pa.array(np.searchsorted(bounds, begins[which]))))


def _heads(keys: np.ndarray) -> np.ndarray:
    """For sorted keys: where the equal ones of each begin."""
    new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
    return np.flatnonzero(new)[np.cumsum(new) - 1] if len(keys) else np.zeros(0, np.int64)


def _occur_again(keys: np.ndarray, bodies: pa.Array) -> np.ndarray:
    """Which lines occur again: more than one of the key (or one that is marked by
    its lowest bit) has the content of the key's first."""
    order = np.argsort(keys >> np.uint64(1), kind="stable")
    head = order[_heads((keys >> np.uint64(1))[order])]
    again, other = np.zeros(len(keys), bool), np.flatnonzero(head != order)
    alike = np.ones(len(keys), bool)  # in the order of ``order``
    alike[other] = pc.equal(bodies.take(pa.array(order[other])), bodies.take(pa.array(head[other]))).to_numpy(zero_copy_only=False)
    times = np.bincount(head, np.where(alike, 1 + (keys[order] & np.uint64(1)).astype(np.int64), 0), len(keys))
    again[order] = alike & (times[head] > 1)
    return again


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(x.as_buffer(), kind) for x in column)])


def repeated_lines(blocks: DataFrame, buckets: int) -> DataFrame:
    """``block, flags``: for each bucket a block has keys in, one bit a key, in the
    order of ``_dealt``: set where the line occurs again anywhere.

    A block sends each of its distinct lines once, whatever its frequency, and gets
    a bit back; a bucket compares the lines as arrays."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in range(b.num_rows):
                a = _arrays(b, x)
                keys, times, one, starts = _dealt(a["hashes"], buckets)
                docs = _docs(b.column(b.schema.names.index("docs"))[x])
                texts = pc.fill_null(docs.column(docs.schema.names.index("text")).cast(pa.string()), "")
                data, at = _buffer(_bodies(texts, a["counts"], a["begins"], a["finishes"], one))
                marked, size = keys | (times > 1).astype(np.uint64), np.diff(at).astype(np.int32)
                some = np.flatnonzero(np.diff(starts))
                ranges = [(starts[k], starts[k + 1]) for k in some.tolist()]
                sent = [[v[i:j].tobytes() for i, j in ranges] for v in (marked, size)] + [[data[at[i] : at[j]].tobytes() for i, j in ranges]]
                block = b.column(b.schema.names.index("block"))[x].as_py()
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([block] * len(some), pa.int64()), *(pa.array(v, pa.binary()) for v in sent)], names=["bucket", "block", "keys", "sizes", "bodies"])

    def count(group: pa.Table) -> pa.Table:
        sizes = _joined(group.column("sizes"), np.int32)
        bodies = _strings(_joined(group.column("bodies"), np.uint8), np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes, dtype=np.int64)]), pa.large_binary())
        again = _occur_again(_joined(group.column("keys"), np.uint64), bodies)
        ends = np.cumsum(pc.binary_length(group.column("keys")).to_numpy() // 8)
        flags = [np.packbits(x).tobytes() for x in np.split(again, ends[:-1])]
        return pa.table({"block": group.column("block"), "bucket": group.column("bucket"), "flags": pa.array(flags, pa.binary())})

    sent = blocks.select("block", "docs", *_BLOBS).mapInArrow(send, "bucket int, block long, keys binary, sizes binary, bodies binary")
    replies = sent.groupBy("bucket").applyInArrow(count, "block long, bucket int, flags binary")
    return replies.groupBy("block").agg(F.collect_list(F.struct("bucket", "flags")).alias("flags"))


def _again(hashes: np.ndarray, flags: list[dict], buckets: int) -> np.ndarray:
    """Which of a block's lines occur again, by the buckets' replies."""
    keys, _, _, starts = _dealt(hashes, buckets)
    known = np.zeros(len(keys), bool)
    for f in flags:
        a, z = starts[f["bucket"]], starts[f["bucket"] + 1]
        known[a:z] = np.unpackbits(np.frombuffer(f["flags"], np.uint8), count=z - a)
    order = np.argsort(keys)
    return known[order][np.searchsorted(keys[order], hashes & ~np.uint64(1))] if len(keys) else np.zeros(0, bool)


def _span_hashes(hashes: np.ndarray, first: np.ndarray, last: np.ndarray, seed: int) -> np.ndarray:
    """A hash of lines ``first`` to before ``last`` each, from sums of the line
    hashes times powers of an odd number (modulo 2**64)."""
    powers = np.full((2, len(hashes) + 1), [[BASE], [pow(BASE, -1, 1 << 64)]], np.uint64)
    powers[:, 0] = 1
    power, back = np.cumprod(powers, axis=1, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_scramble(hashes) * power[:-1], dtype=np.uint64)])
    h = (sums[last] - sums[first]) * back[first]
    return _scramble(_scramble(h * MIX + (last - first).astype(np.uint64)) + np.uint64(seed))


def _candidates(hashes: np.ndarray, begins: np.ndarray, finishes: np.ndarray, words: np.ndarray, counts: np.ndarray, lengths: np.ndarray, again: np.ndarray, rules: Rules) -> tuple[np.ndarray, ...]:
    """``text, at, begin, finish, hash`` of a block's chunks and shortest runs (as
    ``chunks`` and ``shortest_runs`` give them) of which each line occurs again."""
    return _spans(hashes, begins, finishes, words, counts, lengths, again, rules)[:5]


def _spans(hashes: np.ndarray, begins: np.ndarray, finishes: np.ndarray, words: np.ndarray, counts: np.ndarray, lengths: np.ndarray, again: np.ndarray, rules: Rules) -> tuple[np.ndarray, ...]:
    """The ``_candidates``, and the lines each begins with and ends before: with the
    neighbouring chunks' lines, and by itself (``back, first, last, ahead``)."""
    n, text = len(hashes), np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    first, last = (ends - counts)[text], ends[text]  # of each line's text
    line = np.arange(n)
    roll = np.zeros(n, np.uint64)
    for k in range(rules.window - 1, -1, -1):
        inside = line - k >= first
        roll[inside] = roll[inside] * np.uint64(BASE) + hashes[line[inside] - k]
    cut = ((roll >> np.uint64(32)) % np.uint64(rules.divisor) == 0) | (line + 1 == last)
    to = np.flatnonzero(cut) + 1
    of = np.concatenate([[0], to[:-1]])
    whose = text[of]
    begin = np.where(of == first[of], 0, finishes[of - 1])
    # lines after the last boundary: the chunk goes on to the end of the text
    bounded = (roll[to - 1] >> np.uint64(32)) % np.uint64(rules.divisor) == 0
    finish = np.where(bounded, finishes[to - 1], lengths[whose])
    number = np.arange(len(of)) - np.searchsorted(of, first[of])
    fresh = np.concatenate([[0], np.cumsum(~again)])
    keep = fresh[to] == fresh[of]
    back = np.where(of == first[of], of, np.concatenate([of[:1], of[:-1]]))
    ahead = np.where(to == last[of], to, np.concatenate([to[1:], to[-1:]]))
    found = [(whose[keep], number[keep], begin[keep], finish[keep], _span_hashes(hashes, of[keep], to[keep], 1), back[keep], of[keep], to[keep], ahead[keep])]
    if rules.short_runs:
        total = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
        on = np.searchsorted(total, total[:-1] + rules.least_words)  # from each line on
        up = np.searchsorted(total, total[1:] - rules.least_words, "right") - 1  # up to each line
        a = np.concatenate([line[on <= last], up[up >= first]])
        b = np.concatenate([on[on <= last], line[up >= first] + 1])
        keep = fresh[b] == fresh[a]
        a, b = np.divmod(np.unique(a[keep] * (n + 1) + b[keep]), n + 1)
        found.append((text[a], SHORT + a - first[a], begins[a], finishes[b - 1], _span_hashes(hashes, a, b, 2), a, a, b, b))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _block_spans(b: pa.RecordBatch, x: int, buckets: int, rules: Rules) -> tuple[dict, np.ndarray, tuple[np.ndarray, ...], np.ndarray]:
    """Of block ``x`` of a batch: its arrays, which lines occur again, its ``_spans``
    dealt to twice as many buckets as lines are, and where the buckets begin."""
    a = _arrays(b, x)
    again = _again(a["hashes"], b.column(b.schema.names.index("flags"))[x].as_py() or [], buckets)
    if not len(again):
        return a, again, (np.zeros(0, np.int64),) * 9, np.zeros(2 * buckets + 1, np.int64)
    spans = _spans(a["hashes"], a["begins"], a["finishes"], a["words"], a["counts"], a["lengths"], again, rules)
    bucket = (spans[4] >> np.uint64(40)) % np.uint64(2 * buckets)
    order = np.argsort(bucket, kind="stable")
    return a, again, tuple(v[order] for v in spans), np.searchsorted(bucket[order], np.arange(2 * buckets + 1, dtype=np.uint64))


def _line_counts(blocks: DataFrame) -> int:
    return ceil_div(blocks.agg(F.sum("n")).first()[0] or 1, BUCKET_LINES)


def chunk_rows(numbered: DataFrame, rules: Rules) -> DataFrame:
    """``doc_id, row, at, begin, finish, hash`` of the chunks and shortest runs of all
    texts (blank ones have none) that may occur again: each line does.  Spans count
    bytes.  A view for inspection: ``remove_repeats`` moves them as arrays."""
    blocks = stage_by_key(line_blocks(numbered), "line_blocks", "block")
    buckets = _line_counts(blocks)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in range(b.num_rows):
                a, _, spans, _ = _block_spans(b, x, buckets, rules)
                text, at, begin, finish = (v.astype(np.int64) for v in spans[:4])
                made = [pa.array(v.astype(np.int32)) for v in (at, begin, finish)]
                ids = b.column(b.schema.names.index("ids"))[x].values.take(pa.array(text))
                yield pa.RecordBatch.from_arrays([ids, pa.array(a["rows"][text]), *made, pa.array(spans[4].astype(np.uint64).view(np.int64))], names=["doc_id", "row", "at", "begin", "finish", "hash"])

    kinds = T._parse_datatype_string("row long, at int, begin int, finish int, hash long")
    return blocks.drop("n", "docs").join(repeated_lines(blocks, buckets).hint("shuffle_hash"), "block", "left").mapInArrow(cut, T.StructType([numbered.schema["doc_id"], *kinds.fields]))


def _matching(lines: np.ndarray, mine: np.ndarray, theirs: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """How many lines from ``mine`` and ``theirs`` on, ``most`` at most, are equal;
    a line that does not occur again (0) equals none."""
    out, some = np.zeros(len(mine), np.int64), np.flatnonzero(most > 0)
    if len(some):
        n = most[some]
        begin = np.cumsum(n) - n
        i = np.arange(n.sum()) - np.repeat(begin, n)
        one, two = (lines[np.repeat(v[some], n) + step * i] for v in (mine, theirs))
        out[some] = np.minimum.reduceat(np.where((one == two) & (one != 0), np.repeat(n, n), i), begin)
    return out


_SENT = ("hash", "row", "at", "begin", "finish", "before", "size", "after", "lines")
_KINDS = (np.uint64, np.int64, np.int32, np.int32, np.int32, np.int32, np.int32, np.int32, np.uint64)


def _judge(ids: pa.Array, sent: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each span: 1 if it is the first of those with its lines, 2 if it repeats
    the first (0 if it is alone or overlaps it); and, of those, how many lines before
    and after it are equal too."""
    n = len(sent["hash"])
    code, back, ahead = np.zeros(n, np.uint8), np.zeros(n, np.int32), np.zeros(n, np.int32)
    _, of, times = np.unique(sent["hash"], return_inverse=True, return_counts=True)
    some = np.flatnonzero(times[of] > 1)
    if not len(some):
        return code, back, ahead
    rank = pc.rank(ids.take(pa.array(some)), sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy()
    order = some[np.lexsort((sent["at"][some], sent["row"][some], rank, of[some]))]
    one = order[_heads(of[order])]
    code[one] = 1
    mine, one = order[one != order], one[one != order]
    before, size, after = (sent[k].astype(np.int64) for k in ("before", "size", "after"))
    start = np.cumsum(before + size + after) - (size + after)  # of the span's own lines
    apart = (sent["row"][mine] != sent["row"][one]) | (sent["begin"][mine] >= sent["finish"][one])
    apart &= size[mine] == size[one]
    mine, one = mine[apart], one[apart]
    equal = _matching(sent["lines"], start[mine], start[one], size[mine], 1) == size[mine]
    mine, one = mine[equal], one[equal]
    code[mine] = 2
    back[mine] = _matching(sent["lines"], start[mine] - 1, start[one] - 1, np.minimum(before[mine], before[one]), -1)
    ahead[mine] = _matching(sent["lines"], start[mine] + size[mine], start[one] + size[one], np.minimum(after[mine], after[one]), 1)
    return code, back, ahead


def repeated_spans(flagged: DataFrame, buckets: int, rules: Rules) -> DataFrame:
    """``block, spans``: for each bucket a block has chunks and runs in, what
    ``_judge`` says of them, in the order of ``_block_spans``."""
    id_type = flagged.schema["ids"].dataType

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in range(b.num_rows):
                a, again, spans, starts = _block_spans(b, x, buckets, rules)
                text, at, begin, finish, hashes, back, first, last, ahead = spans
                text, size = text.astype(np.int64), ahead - back
                ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
                flat = np.where(again, a["hashes"], np.uint64(0))[np.repeat(back, size) + np.arange(ends[-1]) - np.repeat(ends[:-1], size)]
                cols = [v.astype(k) for v, k in zip((hashes, a["rows"][text], at, begin, finish, first - back, last - first, ahead - last), _KINDS, strict=False)]
                some = np.flatnonzero(np.diff(starts))
                ranges = [(starts[k], starts[k + 1]) for k in some.tolist()]
                blobs = [[v[i:j].tobytes() for i, j in ranges] for v in cols] + [[flat[ends[i] : ends[j]].tobytes() for i, j in ranges]]
                ids = b.column(b.schema.names.index("ids"))[x].values.take(pa.array(text))
                listed = pa.ListArray.from_arrays(pa.array([0, *(j for _, j in ranges)], pa.int32()), ids)
                block = b.column(b.schema.names.index("block"))[x].as_py()
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([block] * len(some), pa.int64()), listed, *(pa.array(v, pa.binary()) for v in blobs)], names=["bucket", "block", "ids", *_SENT])

    def judge(group: pa.Table) -> pa.Table:
        ids = group.column("ids").combine_chunks().flatten()
        made = _judge(ids, {k: _joined(group.column(k), kind) for k, kind in zip(_SENT, _KINDS, strict=True)})
        ends = np.cumsum(pc.binary_length(group.column("hash")).to_numpy() // 8)[:-1]
        code, back, ahead = (pa.array([v.tobytes() for v in np.split(m, ends)], pa.binary()) for m in made)
        return pa.table({"block": group.column("block"), "bucket": group.column("bucket"), "code": code, "back": back, "ahead": ahead})

    kinds = [T.StructField("bucket", T.IntegerType()), T.StructField("block", T.LongType()), T.StructField("ids", id_type)]
    sent = flagged.mapInArrow(send, T.StructType([*kinds, *(T.StructField(k, T.BinaryType()) for k in _SENT)]))
    replies = sent.groupBy("bucket").applyInArrow(judge, "block long, bucket int, code binary, back binary, ahead binary")
    return replies.groupBy("block").agg(F.collect_list(F.struct("bucket", "code", "back", "ahead")).alias("spans"))


def _cuts(a: dict[str, np.ndarray], spans: tuple[np.ndarray, ...], code: np.ndarray, back: np.ndarray, ahead: np.ndarray, rules: Rules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``text, begin, finish`` of what goes from a block's texts, ascending: runs of
    repeated chunks with enough words (as ``holes`` gives them) and repeated
    shortest runs, ``merged``."""
    text, at, begin, finish, _, _, first, last, _ = (v.astype(np.int64) for v in spans)
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(a["words"])])
    key = text * (2 * SHORT) + at
    found = np.sort(key[(code > 0) & (at < SHORT)])
    some = np.flatnonzero((code == 2) & (at < SHORT))
    some = some[np.argsort(key[some])]
    parts = [(text[x], begin[x], finish[x]) for x in [np.flatnonzero((code == 2) & (at >= SHORT))]]
    if len(some):
        key = key[some]
        # a neighbour that is repeated or a first itself is not compared line by line
        before = np.where(np.isin(key - 1, found), 0, back[some]).astype(np.int64)
        after = np.where(np.isin(key + 1, found), 0, ahead[some]).astype(np.int64)
        a_line, z_line = first[some] - before, last[some] + after
        begin = np.where(before > 0, a["begins"][a_line], begin[some])
        finish = np.where(after > 0, a["finishes"][z_line - 1], finish[some])
        run = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1] + 1]))
        end = np.concatenate([run[1:], [len(key)]]) - 1
        enough = np.add.reduceat(total[z_line] - total[a_line], run) >= rules.least_words
        parts.append((text[some][run][enough], begin[run][enough], finish[end][enough]))
    text, begin, finish = (np.concatenate(v) for v in zip(*parts, strict=True))
    order = np.lexsort((begin, text))
    text, begin, finish = text[order], begin[order], finish[order]
    if not len(text):
        return text, begin, finish
    offset = (np.cumsum(a["lengths"] + 1) - (a["lengths"] + 1))[text]
    reach = np.maximum.accumulate(offset + finish)
    new = np.flatnonzero(np.concatenate([[True], (offset + begin)[1:] > reach[:-1]]))
    end = np.concatenate([new[1:], [len(text)]]) - 1
    return text[new], begin[new], reach[end] - offset[new]


def _without(texts: pa.Array, text: np.ndarray, begin: np.ndarray, finish: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The texts without those spans, and how many spans and characters each lost; a
    text of which only white space is left becomes empty."""
    data, offsets = _buffer(pc.fill_null(texts, ""))
    edge = np.zeros(len(data) + 1, np.int8)
    edge[offsets[text] + begin] += 1
    edge[offsets[text] + finish] -= 1
    keep = np.cumsum(edge[:-1], dtype=np.int8) == 0
    sums = lambda v: np.concatenate([np.zeros(1, np.int64), np.cumsum(v, dtype=np.int64)])[offsets]
    lost = np.diff(sums(~keep & ((data & 0xC0) != 0x80)))
    counts = np.bincount(text, minlength=len(texts))
    left = _strings(data[keep], sums(keep))
    blank = pc.equal(pc.binary_length(pc.utf8_trim_whitespace(left)), 0)
    left = pc.if_else(pc.and_(blank, pa.array(counts > 0)), "", left)
    return pc.if_else(pc.is_null(texts), pa.scalar(None, pa.string()), left), counts, lost


def remove_repeats(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``docs`` with shortened ``text`` and, after its columns,
    ``removed_chunks int`` (passages taken out) and ``removed_chars long``.

    Of equal chunks the one of the least ``doc_id`` stays (then of the earlier
    row, then the earlier place; a null id comes first), also among repeats
    inside a document (a shortest run that overlaps its first occurrence is no
    repeat).  Every row is returned: null texts stay null, empty ones
    empty, and a text of which all is repeated becomes empty.  Repeated rows are
    documents of their own, and any further columns are passed on.
    """
    docs = docs.drop("__row", "removed_chunks", "removed_chars")
    blocks = stage_by_key(line_blocks(docs.withColumn("__row", F.monotonically_increasing_id())), "line_blocks", "block")
    buckets = _line_counts(blocks)
    flags = stage_by_key(repeated_lines(blocks, buckets), "line_flags", "block")
    flagged = blocks.drop("n").join(flags.hint("shuffle_hash"), "block", "left")
    spans = repeated_spans(flagged.drop("docs"), buckets, rules)
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("removed_chunks", T.IntegerType()), T.StructField("removed_chars", T.LongType())])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in range(b.num_rows):
                a, _, found, starts = _block_spans(b, x, buckets, rules)
                made = [np.zeros(len(found[0]), k) for k in (np.uint8, np.int32, np.int32)]
                for r in b.column(b.schema.names.index("spans"))[x].as_py() or []:
                    for v, k in zip(made, ("code", "back", "ahead"), strict=True):
                        v[starts[r["bucket"]] : starts[r["bucket"] + 1]] = np.frombuffer(r[k], v.dtype)
                kept = _docs(b.column(b.schema.names.index("docs"))[x])
                texts, counts, chars = _without(kept.column(names.index("text")).cast(pa.string()), *_cuts(a, found, *made, rules))
                cols = [texts if k == "text" else kept.column(i) for i, k in enumerate(names)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(counts, pa.int32()), pa.array(chars, pa.int64())], names=[*names, "removed_chunks", "removed_chars"])

    return flagged.join(spans.hint("shuffle_hash"), "block", "left").mapInArrow(fill, schema)
