"""Factorisation machine over hashed words and structure statistics.

A document becomes a sparse vector: a value for each selected hashed term that
occurs in it, and a one for the bin of each structure statistic.  With weights
``w`` and low-rank factors ``V`` its score is the logistic function of
``w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)**2 - sum v_if**2 x_i**2)``, the
last term being all pairwise interactions in time linear in the vector's length.

Only the fit looks at labels, over a bounded sample of labelled rows; scoring is
a map over whole texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from occulink.llm.words import Words, split_words, text_column, word_hashes

#: Characters dropped at both ends of a word before it is hashed.
EDGES = ".,;:!?\"'()[]{}<>*#$%&|-_/\\"
HASH_BITS = 32

STATS = (
    "log_chars", "log_words", "log_lines", "words_a_line", "word_length", "upper", "letters", "digits", "symbols",
    "symbol_ends", "bare_symbols", "distinct", "repeated_next", "commonest",
)


@dataclass(frozen=True)
class Settings:
    """``sample_rows``: the most labelled rows a fit looks at (those with the
    least hash of their id); ``terms``: the most hashed terms it selects for
    separating the labels alone.  Of the ``pair_candidates`` most frequent other
    terms it adds at most ``pair_terms`` that do so in pairs, each pair in
    ``least_pair_docs`` documents or more."""

    statistics: bool = True
    sample_rows: int = 30_000
    terms: int = 1_024
    least_docs: int = 4
    least_z: float = 4.0
    pair_candidates: int = 2_048
    pair_terms: int = 256
    least_pair_docs: int = 16
    least_pair_z: float = 6.0
    bins: int = 12
    rank: int = 8
    epochs: int = 25
    rate: float = 0.15
    decay: float = 1e-4
    seed: int = 7


@dataclass
class Model:
    settings: Settings
    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # selected terms, ascending
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    edges: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # a row for each statistic
    bias: float = 0.0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    factors: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))
    rows: int = 0  # labelled documents that it learned from


def term_hashes(w: Words) -> np.ndarray:
    """Hash of the bare lower-case term of each distinct word."""
    bare = pc.utf8_trim(pc.utf8_lower(w.distinct), characters=EDGES)
    return word_hashes(bare) & np.uint64((1 << HASH_BITS) - 1)


def statistics(texts: pa.Array, w: Words) -> np.ndarray:
    """``STATS`` of each text; all 0 for a null or empty one."""
    n, rows, lengths = len(texts), w.rows(), w.lengths
    count = lambda pattern: pc.count_substring_regex(w.distinct, pattern=pattern).to_numpy(zero_copy_only=False)
    total = lambda per_word: np.bincount(rows, weights=per_word[w.codes], minlength=n)
    size = pc.utf8_length(w.distinct).to_numpy(zero_copy_only=False).astype(float)
    upper, letters, digits = count(r"\p{Lu}"), count(r"\p{L}"), count(r"\p{N}")
    symbols = size - letters - digits
    ends = count(r"[^\p{L}\p{N}]{2,}$") > 0
    words, inked = np.maximum(lengths, 1), np.maximum(total(size), 1)
    lines = np.where(lengths > 0, pc.count_substring(texts, pattern="\n").to_numpy(zero_copy_only=False) + 1, 0)
    pairs, times = np.unique(rows.astype(np.int64) * max(len(w.distinct), 1) + w.codes, return_counts=True)
    of = pairs // max(len(w.distinct), 1)
    most = np.zeros(n)
    np.maximum.at(most, of, times)
    same = np.zeros(len(rows))
    if len(rows):
        same[1:] = (w.codes[1:] == w.codes[:-1]) & (rows[1:] == rows[:-1])
    out = [
        np.log1p(pc.utf8_length(texts).to_numpy(zero_copy_only=False)), np.log1p(lengths), np.log1p(lines), lengths / np.maximum(lines, 1),
        total(size) / words, total(upper) / np.maximum(total(letters), 1), total(letters) / inked, total(digits) / inked, total(symbols) / inked,
        total(ends) / words, total(symbols == size) / words, np.bincount(of, minlength=n) / words, np.bincount(rows, weights=same, minlength=n) / words, most / words,
    ]
    return np.column_stack(out).astype(float)


def _raw(texts: pa.Array, with_statistics: bool) -> tuple[Words, np.ndarray, np.ndarray]:
    texts = pc.fill_null(texts, "")
    w = split_words(texts, lower=False)
    return w, term_hashes(w), statistics(texts, w) if with_statistics else np.zeros((len(texts), 0))


@dataclass
class Sample:
    """Labelled documents: ``terms`` holds the hashed terms of document ``i`` at
    the places where ``of`` is ``i``."""

    terms: np.ndarray
    of: np.ndarray
    stats: np.ndarray
    y: np.ndarray


def _sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, s: Settings) -> Sample:
    """At most ``sample_rows`` documents."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learn)
    rows = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("__y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.sample_rows)
    picked = docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id")  # sample_rows ids at most

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w, h, stats = _raw(text_column(b), s.statistics)
            h32 = h.astype(np.uint32)
            terms = [np.unique(h32[w.codes[a:z]]).tobytes() for a, z in zip(w.starts, w.starts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("__y"), pa.array(terms, pa.binary()), pa.array([x.tobytes() for x in stats], pa.binary())], names=["doc_id", "y", "terms", "stats"])

    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string("y int, terms binary, stats binary").fields])
    got = picked.mapInArrow(read, schema).dropDuplicates(["doc_id"]).orderBy("doc_id").toArrow()
    raw, y = got["terms"].to_pylist(), got["y"].to_numpy().astype(float)
    stats = np.frombuffer(b"".join(got["stats"].to_pylist()), np.float64).reshape(len(raw), -1) if raw else np.zeros((0, 0))
    return Sample(np.frombuffer(b"".join(raw), np.uint32), np.repeat(np.arange(len(raw)), [len(x) // 4 for x in raw]), stats, y)


def _difference(pos: np.ndarray, both: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """Standardised difference of the document shares ``pos / n1`` and
    ``(both - pos) / n0`` between the labels."""
    pool = both / (n1 + n0)
    return (pos / n1 - (both - pos) / n0) / np.sqrt(np.maximum(pool * (1 - pool), 1e-9) * (1 / n1 + 1 / n0))


def _paired(sample: Sample, code: np.ndarray, some: np.ndarray, n1: float, n0: float, s: Settings) -> np.ndarray:
    """Those of the terms ``some`` that are in the pairs whose document share
    differs most between the labels."""
    slot = np.full(code.max() + 1, -1)
    slot[some] = np.arange(len(some))
    found = slot[code]
    of, at = sample.of[found >= 0], found[found >= 0]
    both, pos = np.zeros((2, len(some), len(some)), np.float32)
    for first in range(0, len(sample.y), 4096):
        a, z = np.searchsorted(of, [first, first + 4096])
        y = sample.y[first : first + 4096]
        x = np.zeros((len(y), len(some)), np.float32)
        x[of[a:z] - first, at[a:z]] = 1
        both += x.T @ x
        x = x[y > 0]
        pos += x.T @ x
    i, j = np.nonzero(np.triu(both >= s.least_pair_docs, 1))
    z = np.abs(_difference(pos[i, j].astype(float), both[i, j].astype(float), n1, n0))
    order = np.argsort(-z, kind="stable")
    order = order[z[order] >= s.least_pair_z]
    terms = np.column_stack([i[order], j[order]]).ravel()
    once, at = np.unique(terms, return_index=True)
    return some[once[np.argsort(at)][: s.pair_terms]]


def _select(sample: Sample, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Terms whose document share differs most between the labels, ascending, and
    the log ratio of those shares; with them terms that differ in pairs only,
    whose value is 1."""
    y = sample.y
    h, code, df = np.unique(sample.terms, return_inverse=True, return_counts=True)
    if not len(h):
        return h.astype(np.uint64), np.zeros(0)
    pos = np.bincount(code, weights=y[sample.of], minlength=len(h))
    n1 = max(y.sum(), 1e-9)
    n0 = max(len(y) - y.sum(), 1e-9)
    z = _difference(pos, df, n1, n0)
    keep = np.nonzero((df >= s.least_docs) & (np.abs(z) >= s.least_z))[0]
    keep = np.sort(keep[np.argsort(-np.abs(z[keep]), kind="stable")[: s.terms]])
    ratio = np.log((pos + 1) / (n1 + 2)) - np.log((df - pos + 1) / (n0 + 2))
    plain = np.nonzero((df >= s.least_pair_docs) & (np.abs(z) < s.least_z))[0]
    plain = np.sort(plain[np.argsort(-df[plain], kind="stable")[: s.pair_candidates]])
    extra = _paired(sample, code, plain, n1, n0, s)
    ratio[extra] = 1
    keep = np.sort(np.concatenate([keep, extra]))
    return h[keep].astype(np.uint64), ratio[keep]


def _bins(edges: np.ndarray, stats: np.ndarray) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, x, side="left") for e, x in zip(edges, stats.T, strict=True)]) if len(edges) else np.zeros((len(stats), 0), int)


def _learn(m: Model, x: np.ndarray, y: np.ndarray) -> None:
    """Adaptive gradient descent on the logistic loss, in small dense batches."""
    s, rng = m.settings, np.random.default_rng(m.settings.seed)
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    m.bias = float(np.log(share / (1 - share)))
    w, v = np.zeros(x.shape[1]), rng.normal(0, 0.02, (x.shape[1], s.rank))
    gb, gw, gv = 1.0, np.full_like(w, 1e-2), np.full_like(v, 1e-2)
    for _ in range(s.epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), 128):
            rows = order[at : at + 128]
            a = x[rows]
            a2, av = a * a, a @ v
            z = m.bias + a @ w + 0.5 * (av * av - a2 @ (v * v)).sum(axis=1)
            e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / len(rows)
            dw = a.T @ e + s.decay * w
            dv = a.T @ (e[:, None] * av) - v * (a2.T @ e)[:, None] + s.decay * v
            gb, gw, gv = gb + e.sum() ** 2, gw + dw * dw, gv + dv * dv
            m.bias -= s.rate * e.sum() / np.sqrt(gb)
            w -= s.rate * dw / np.sqrt(gw)
            v -= s.rate * dv / np.sqrt(gv)
    m.weights, m.factors = w, v


def fit(docs: DataFrame, labels: DataFrame, label: str, learn: Column, settings: Settings) -> Model:
    """Fit on documents whose ``labels`` row has a label and satisfies
    ``learn``.  A document's text is all that the model sees.  Without a labelled
    document the model gives every text 0.5; with one label only, a constant."""
    sample = _sample(docs, labels, label, learn, settings)
    m, stats, y = Model(settings), sample.stats, sample.y
    m.rows = len(y)
    if not m.rows:
        return m
    m.hashes, m.scale = _select(sample, settings)
    if settings.statistics:
        grid = np.arange(1, settings.bins) / settings.bins
        m.edges = np.quantile(stats, grid, axis=0).T
    slots = len(m.hashes) + settings.bins * len(m.edges)
    x = np.zeros((len(y), slots), np.float32)
    if len(m.hashes):
        at = np.minimum(np.searchsorted(m.hashes, sample.terms), len(m.hashes) - 1)
        hit = m.hashes[at] == sample.terms
        x[sample.of[hit], at[hit]] = m.scale[at[hit]]
    b = _bins(m.edges, stats) + len(m.hashes) + settings.bins * np.arange(len(m.edges))
    if b.shape[1]:
        np.put_along_axis(x, b, 1, axis=1)
    _learn(m, x, y)
    return m


def score(m: Model, texts: pa.Array) -> np.ndarray:
    """Scores of a batch of whole texts, each in (0, 1)."""
    n = len(texts)
    w, h, stats = _raw(texts, m.settings.statistics)
    z, rank = np.full(n, m.bias), m.factors.shape[1]
    linear, square = np.zeros((n, rank)), np.zeros((n, rank))
    if len(m.hashes):
        at = np.minimum(np.searchsorted(m.hashes, h), len(m.hashes) - 1)
        slot = np.where(m.hashes[at] == h, at, -1)
        found = slot[w.codes]
        hit = found >= 0
        once = np.unique(w.rows()[hit].astype(np.int64) * len(m.hashes) + found[hit])
        of, i = once // len(m.hashes), once % len(m.hashes)
        z += np.bincount(of, weights=m.weights[i] * m.scale[i], minlength=n)
        for f in range(rank):
            vx = m.factors[i, f] * m.scale[i]
            linear[:, f] += np.bincount(of, weights=vx, minlength=n)
            square[:, f] += np.bincount(of, weights=vx * vx, minlength=n)
    if len(m.edges):
        b = _bins(m.edges, stats) + len(m.hashes) + m.settings.bins * np.arange(len(m.edges))
        z += m.weights[b].sum(axis=1)
        linear += m.factors[b].sum(axis=1)
        square += (m.factors[b] ** 2).sum(axis=1)
    z += 0.5 * (linear**2 - square).sum(axis=1)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def with_score(docs: DataFrame, m: Model, column: str) -> DataFrame:
    """``docs`` with the score of each whole text in ``column`` (replaced if it
    is there).  Null and empty texts get a score too."""
    docs = docs.drop(column)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = score(m, text_column(b))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s)], schema=b.schema.append(pa.field(column, pa.float64())))

    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def id_remainder(modulus: int) -> Column:
    """``crc32(doc_id as text) mod modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus
