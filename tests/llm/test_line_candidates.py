"""Chunks and runs cut from arrays of line hashes against the plain functions."""

from __future__ import annotations

import random

import numpy as np
import xxhash

from occulink.llm import linedup

R = random.Random(3)


def _text() -> str:
    part = lambda: R.choice(["", "  "]) + " ".join(R.choice("abcdefgh") for _ in range(R.randrange(25))) + R.choice([".", "", "!", ". "])
    return "".join(part() + R.choice(["\n", "\n\n", " ", "\n \n", ". "]) for _ in range(R.randrange(12)))


def _plain(texts: list[str], again: set[str]) -> list[tuple]:
    out = []
    for i, t in enumerate(texts):
        spans = [(at, s, e, body) for at, (s, e, body) in enumerate(linedup.chunks(t, linedup.EVERY)) if body]
        spans += [(linedup.SHORT + at, s, e, body) for at, s, e, body in linedup.shortest_runs(t, linedup.EVERY)]
        out += [(i, at, s, e, (at >= linedup.SHORT, body)) for at, s, e, body in spans if set(body.split("\n")) <= again]
    return sorted(out)


def test_candidates_equal_the_plain_functions():
    hash_of: dict[tuple, int] = {}
    for _ in range(300):
        texts = [_text() for _ in range(R.randrange(1, 8))]
        every = [(i, s, e, t[s:e].strip()) for i, t in enumerate(texts) for s, e in linedup.lines(t) if t[s:e].strip()]
        if not every:
            continue
        again = {body for *_, body in every if R.random() < 0.8}
        text, begins, finishes = (np.array([x[k] for x in every]) for k in range(3))
        hashes = np.array([xxhash.xxh64_intdigest(x[3]) for x in every], np.uint64)
        words = np.array([len(x[3].split()) for x in every])
        flags = np.array([x[3] in again for x in every])
        lengths = np.array([len(t) for t in texts])
        got = linedup._candidates(hashes, begins, finishes, words, np.bincount(text, minlength=len(texts)), lengths, flags, linedup.EVERY)
        got = sorted(zip(*(x.tolist() for x in got), strict=True))
        want = _plain(texts, again)
        assert [x[:4] for x in got] == [x[:4] for x in want]
        for x, y in zip(got, want, strict=True):
            assert hash_of.setdefault(y[4], x[4]) == x[4]  # equal contents, equal hashes
    assert len(set(hash_of.values())) == len(hash_of)  # and differing ones differ


def test_only_repeated_lines_are_rows(spark):
    texts = ["x1 y1.\nsame a.\nsame b.\n", "x2 y2.\nsame a.\nsame b.\n", "x3 y3.\n\n", None, "", "twice z.\ntwice z.\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumnRenamed("doc_id", "__row").selectExpr("__row", "__row as doc_id", "text")
    rows = linedup.chunk_rows(docs, linedup.Rules(window=1, divisor=1)).collect()
    found = sorted((r.row, texts[r.row][r.begin : r.finish].strip()) for r in rows)
    assert found == [(0, "same a."), (0, "same b."), (1, "same a."), (1, "same b."), (5, "twice z."), (5, "twice z.")]
