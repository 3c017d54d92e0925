"""Byte-level BPE by recursive DuckDB queries inside each partition.

A batch's distinct words become rows, each word's tokens a string of one character
a token.  One recursive query joins the words' pairs of neighbours with the merge
table and contracts each word's leftmost pair of least rank, round by round, until
no pair of any word is in the table.  Decoding looks all ids up in the vocabulary at
once; a text's bytes then follow each other in the order of its ids.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from occulink.llm.chunks import PART_BYTES, ChunkEncoder, parts
from occulink.llm.words import text_column

#: Tokens that the rounds of one recursive query may keep, a word counting its
#: length squared; bytes of the cache of words, both halves together.
QUERY_ROWS, CACHE_BYTES = 4_000_000, 240_000_000
#: A round keeps all tokens of its words, so the tokens of a recursion grow with
#: the square of a word's length; longer words are contracted one by one.
LONGEST = 256

#: ``best``: the new token's character in the upper bits, the pair's place in the lower 16.
CONTRACT = """
    WITH RECURSIVE part(word, toks) AS (
        SELECT word, toks FROM start
        UNION ALL
        SELECT word, left(toks, CAST(best & 65535 AS INTEGER) - 1) || chr(CAST(best >> 16 AS INTEGER)) || substring(toks, CAST(best & 65535 AS INTEGER) + 2)
        FROM (
            SELECT word, any_value(toks) AS toks, min((m.made << 16) | p.place) AS best
            FROM (SELECT word, toks, unnest(range(1, length(toks))) AS place FROM part) p
            JOIN merges m ON m.pair = substring(p.toks, p.place, 2)
            GROUP BY word))
    SELECT arg_min(toks, length(toks)) AS toks FROM part GROUP BY word ORDER BY word"""

#: Tokens' characters leave out 0 and the range of surrogates, which strings cannot hold.
LOW, GAP = 0xD800, 0x800


def _characters(ids: np.ndarray) -> np.ndarray:
    """The code point of each id's character; it grows with the id."""
    points = ids.astype(np.uint32) + np.uint32(1)
    return np.where(points < LOW, points, points + np.uint32(GAP)).astype("<u4")


def _ids(points: np.ndarray) -> np.ndarray:
    return (np.where(points < LOW, points, points - np.uint32(GAP)) - np.uint32(1)).astype("<u4")


class Coder:
    """Encoder and decoder of one vocabulary file in the tiktoken format."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.vocabulary: pa.Array | None = None
        # spilling is off: a query's rows are bounded, and executors' folders stay clean
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        self.tables: set[str] = set()
        #: Ids of words that the pattern gives as they are, met of late and before:
        #: as a chunk of its own such a word has the same ids.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.known_bytes = 0
        self.encode = ChunkEncoder(self._chunks, cached=False)

    def _table(self, name: str, columns: dict) -> None:
        self.db.register("incoming", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")
        self.tables.add(name)

    def _merges(self) -> None:
        merges = [(self.ranks[t[:k]], self.ranks[t[k:]], r) for t, r in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        chars = _characters(np.array(merges))
        pairs = chars[:, :2].tobytes().decode("utf-32-le")
        self._table("merges", {"pair": [pairs[i : i + 2] for i in range(0, len(pairs), 2)], "made": chars[:, 2].astype(np.int64)})

    def _contract(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as little-endian unsigned 32-bit numbers."""
        if "merges" not in self.tables:
            self._merges()
        ends = np.cumsum([len(w) for w in words]).tolist()
        chars = _characters(self.single)[np.frombuffer(b"".join(words), np.uint8)].tobytes().decode("utf-32-le")
        self._table("start", {"word": np.arange(len(words), dtype=np.int32), "toks": pa.array([chars[a:z] for a, z in zip([0, *ends], ends, strict=False)], pa.string())})
        got = [toks for (toks,) in self.db.execute(CONTRACT).fetchall()]
        at = (4 * np.cumsum([0, *map(len, got)])).tolist()
        ids = _ids(np.frombuffer("".join(got).encode("utf-32-le"), "<u4")).tobytes()
        return [ids[a:z] for a, z in zip(at, at[1:], strict=False)]

    def _long(self, word: bytes) -> list[int]:
        """The same contraction of one long word, pairs kept in a heap."""
        tok = [int(self.single[b]) for b in word]
        part = [bytes([b]) for b in word]
        after, before = [*range(1, len(word)), -1], [*range(-1, len(word) - 1)]
        heap = [(r, i, part[i], part[i + 1]) for i in range(len(word) - 1) if (r := self.ranks.get(part[i] + part[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, one, two = heapq.heappop(heap)
            j = after[i] if tok[i] >= 0 else -1
            if j < 0 or part[i] != one or part[j] != two:
                continue  # a neighbour was contracted in the meantime
            tok[i], part[i], after[i], tok[j] = r, one + two, after[j], -1
            if after[j] >= 0:
                before[after[j]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] >= 0 and (rank := self.ranks.get(part[a] + part[after[a]])) is not None:
                    heapq.heappush(heap, (rank, a, part[a], part[after[a]]))
        return [t for t in tok if t >= 0]

    def _recall(self, words: list[str]) -> list[bytes | None]:
        """The ids of the words that are known; those that only the older half of
        the cache holds are taken over into the newer."""
        known, older = self.known, self.older
        ids = list(map(known.get, words))
        for i, b in enumerate(ids):
            if b is None and (b := older.get(w := words[i])) is not None:
                ids[i] = known[w] = b
                self.known_bytes += 200 + 5 * len(w)  # a word, its ids and its entry, at most
        return ids

    def _encoded(self, words: list[str]) -> dict[str, bytes]:
        """The ids of distinct words that are not known."""
        made, new = {}, []
        for w in words:
            raw = w.encode()
            if (r := self.ranks.get(raw)) is not None:
                made[w] = r.to_bytes(4, "little")
            elif len(raw) > LONGEST:
                made[w] = np.array(self._long(raw), "<u4").tobytes()
            else:
                new.append((w, raw))
        new.sort(key=lambda x: len(x[1]))  # words of a length need about the same rounds
        batch, load = [], 0
        for x in [*new, None]:
            if batch and (x is None or load >= QUERY_ROWS):
                made.update(zip([w for w, _ in batch], self._contract([raw for _, raw in batch]), strict=True))
                batch, load = [], 0
            if x is not None:
                batch.append(x)
                load += len(x[1]) ** 2
        return made

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        if self.known_bytes > CACHE_BYTES // 2:
            self.older, self.known, self.known_bytes = self.known, {}, 0
        ids, findall = self._recall(chunks), self.pattern.findall
        left = [i for i, b in enumerate(ids) if b is None]
        split = [findall(chunks[i]) for i in left]
        single = [words[0] for words in split if len(words) == 1]
        met = list(dict.fromkeys(chain.from_iterable(words for words in split if len(words) != 1)))
        of = dict(zip(met, self._recall(met), strict=True))
        of = {w: b for w, b in of.items() if b is not None}
        fresh = self._encoded(list(dict.fromkeys(w for w in chain(single, met) if w not in of)))
        plain = {words[0] for i, words in zip(left, split, strict=True) if words == [chunks[i]]}
        for w, b in fresh.items():
            if w in plain or findall(w) == [w]:
                self.known[w] = b
                self.known_bytes += 200 + 5 * len(w)
        of.update(fresh)
        for i, words in zip(left, split, strict=True):
            ids[i] = of[words[0]] if len(words) == 1 else b"".join([of[w] for w in words])
        return ids

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> list[bytes]:
        """The bytes of each text; its ids are ``ids[starts[i]:starts[i + 1]]``."""
        if self.vocabulary is None:
            of = {r: t for t, r in self.ranks.items()}
            self.vocabulary = pa.array([of.get(i) for i in range(max(of) + 1)], pa.large_binary())
        if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < len(self.vocabulary):
            raise ValueError("ids outside the vocabulary")
        found = self.vocabulary.take(pa.array(ids))
        if found.null_count:
            raise ValueError("ids outside the vocabulary")
        _, offsets, data = found.buffers()
        at = np.frombuffer(offsets, np.int64)[np.asarray(starts)].tolist() if len(ids) else [0] * len(starts)
        raw = memoryview(data) if data else b""
        return [bytes(raw[a:z]) for a, z in zip(at, at[1:], strict=False)]


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> Coder:
    return Coder(path, pattern)


def small_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of some ``PART_BYTES`` of text."""
    for b in batches:
        at = 0
        for part in parts(pc.fill_null(text_column(b), ""), PART_BYTES):
            yield b.slice(at, len(part))
            at += len(part)


def _listed(flat: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat.astype(np.int32)))


def encode(docs: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text in ``ids`` (array of int; replaced
    if it is there).  Null and empty texts have none; equal rows are encoded
    alike; an empty table gives no rows; strings of special tokens are ordinary
    text and other columns are passed on."""
    docs = docs.drop(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            yield pa.RecordBatch.from_arrays([*b.columns, _listed(*coder(path, pattern).encode(text_column(b)))], names=[*b.schema.names, ids])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of each row's ids in ``column`` (replaced if it
    is there).  Null or no ids give no bytes; an unknown or null id is an error."""
    encoded = encoded.drop(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(b.schema.names.index(ids))
            size = lists.value_lengths().fill_null(0).to_numpy()
            flat = lists.flatten()
            if flat.null_count:
                raise ValueError("ids outside the vocabulary")
            made = coder(path, pattern).decode(flat.to_numpy(), np.concatenate([[0], np.cumsum(size)]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.binary())], names=[*b.schema.names, column])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(column, T.BinaryType())]))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of an encoding and its
    decoding, both in one pass over small parts.  Null and empty texts have no
    ids and no bytes; repeated rows give repeated rows; an empty table none;
    further columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            ids, starts = coder(path, pattern).encode(text_column(b))
            text = coder(path, pattern).decode(ids, starts)
            yield pa.RecordBatch.from_arrays([b.column(0), _listed(ids, starts), pa.array(text, pa.binary())], names=["doc_id", "ids", "decoded"])

    kinds = T._parse_datatype_string("ids array<int>, decoded binary")
    both = docs.select("doc_id", "text").mapInArrow(run, T.StructType([docs.schema["doc_id"], *kinds.fields]))
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
