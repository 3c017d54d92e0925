"""Words of a batch of texts as arrays: every distinct word is handled once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash


@dataclass
class Words:
    """``codes[starts[i]:starts[i+1]]`` are the words of text ``i``, as numbers
    in ``distinct``."""

    codes: np.ndarray
    starts: np.ndarray
    distinct: pa.Array

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.starts)

    def rows(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.starts) - 1), self.lengths)


def split_words(texts: pa.Array, lower: bool = True) -> Words:
    """White-space separated words of each text; a null text has none."""
    texts = pc.fill_null(texts, "")
    lists = pc.utf8_split_whitespace(pc.utf8_lower(texts) if lower else texts)
    d = lists.flatten().dictionary_encode()
    codes = d.indices.to_numpy(zero_copy_only=False)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    blank = pc.index(d.dictionary, pa.scalar("", d.dictionary.type)).as_py()
    if blank >= 0:  # before leading and after trailing white space
        some = codes != blank
        rows = np.repeat(np.arange(len(lengths)), lengths)[some]
        codes, lengths = codes[some], np.bincount(rows, minlength=len(lengths))
    return Words(codes, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), d.dictionary)


def word_hashes(words: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word."""
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(w, seed) for w in words.to_pylist()), dtype=np.uint64, count=len(words))


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    return batch.column(batch.schema.names.index(name)).cast(pa.string())
