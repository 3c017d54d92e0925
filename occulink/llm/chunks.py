"""Tokenising by distinct chunks.

The word pattern of byte-level tokenizers lets at most one space lead a word, so
a text falls into chunks at its single spaces, and a chunk's ids do not depend
on its neighbours.  Only where white space meets a space may a match cross a
space; such texts are one chunk each.  Equal chunks of a batch are encoded once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks that a worker's cache holds before it is emptied.
CACHE_CHUNKS = 250_000


#: Bytes of text that are split at a time, so that a worker's arrays stay small
#: whatever the batch; a longer text is a part of its own.
PART_BYTES = 4_000_000


def parts(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """Neighbouring texts of some ``size`` bytes together."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + size, side="right")))
        yield texts.slice(at, to - at)
        at = to


def _crossing(pieces: pa.Array) -> np.ndarray:
    """Which pieces are empty or have white space at an end."""
    bare = pc.utf8_trim_whitespace(pieces)
    return pc.or_(pc.not_equal(bare, pieces), pc.equal(pieces, "")).to_numpy(zero_copy_only=False)


def split_chunks(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct chunks, the chunk number of each occurrence, and where each
    text's occurrences start.  The chunks of a text concatenate to it."""
    n = len(texts)
    lists = pc.split_pattern(texts, " ")
    d = lists.flatten().dictionary_encode()
    codes = d.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    rows = np.repeat(np.arange(n), lengths)
    pieces = d.dictionary.to_pylist()
    odd = _crossing(d.dictionary)[codes]
    first = starts[:-1]
    lead = np.array([not pieces[c] for c in codes[first]], bool) if n else np.zeros(0, bool)
    odd[first[lead]] = False  # a leading space belongs to the second piece
    whole = np.unique(rows[odd])
    firsts = [pieces[c] for c in codes[first]]
    chunks = [" " + p for p in pieces] + firsts + [texts[int(i)].as_py() for i in whole]
    codes[first] = len(pieces) + np.arange(n)
    keep = np.ones(len(codes), bool)
    keep[first[lead]] = False
    if len(whole):
        is_whole = np.zeros(n, bool)
        is_whole[whole] = True
        keep &= ~is_whole[rows]
    codes, rows = codes[keep], rows[keep]
    if len(whole):
        codes = np.concatenate([codes, len(pieces) + n + np.arange(len(whole))])
        rows = np.concatenate([rows, whole])
        order = np.argsort(rows, kind="stable")
        codes, rows = codes[order], rows[order]
    return chunks, codes, np.searchsorted(rows, np.arange(n + 1))


class ChunkEncoder:
    """Ids of whole texts by ``encode``, which maps chunks to their ids as
    little-endian unsigned 32-bit numbers."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], part_bytes: int = PART_BYTES, cached: bool = True) -> None:
        """Not ``cached``: ``encode`` itself remembers what it has met."""
        self.encode, self.part_bytes, self.cached, self.cache = encode, part_bytes, cached, {}

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the batch and where each text's ids start."""
        made = [self._part(p) for p in parts(pc.fill_null(texts, ""), self.part_bytes)]
        ends = np.cumsum([0, *(len(ids) for ids, _ in made)])
        starts = [end + s[:-1] for end, (_, s) in zip(ends, made, strict=False)]
        return np.concatenate([np.zeros(0, "<u4"), *(ids for ids, _ in made)]), np.concatenate([*starts, ends[-1:]])

    def _part(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        chunks, codes, starts = split_chunks(texts)
        used = np.flatnonzero(np.bincount(codes, minlength=len(chunks)))
        if len(self.cache) > CACHE_CHUNKS:
            self.cache.clear()
        wanted = [chunks[c] for c in used.tolist()]
        if self.cached:
            ids = list(map(self.cache.get, wanted))
            unknown = [i for i, b in enumerate(ids) if b is None]
            new = list(dict.fromkeys([wanted[i] for i in unknown]))
            fresh = dict(zip(new, self.encode(new), strict=True)) if new else {}
            for i in unknown:
                ids[i] = fresh[wanted[i]]
            self.cache.update({c: b for c, b in fresh.items() if len(c) <= 64})
        else:
            fresh = dict.fromkeys(wanted)
            fresh = dict(zip(fresh, self.encode(list(fresh)), strict=True))
            ids = [fresh[c] for c in wanted]
        flat = np.frombuffer(b"".join(ids), "<u4")
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        begin = np.concatenate([[0], np.cumsum(size)])
        place = np.zeros(len(chunks), np.int64)
        place[used] = np.arange(len(used))
        at = place[codes]
        lengths = size[at]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        take = np.arange(ends[-1]) + np.repeat(begin[at] - ends[:-1], lengths)
        return flat[take], ends[starts]
