"""Lines, spans and cuts of blocks of texts, as arrays, against the plain functions."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from occulink.llm import linedup

R = random.Random(23)
PARTS = ["a", "bc d", "é", "語", "…", ".", "!", "?", " ", "\t", "\n", "　", "\xa0", " ", "\x1c", "\r", "\x85", "x y z w"]


def _texts(n: int) -> list[str]:
    return ["".join(R.choices(PARTS, k=R.randrange(30))) for _ in range(n)]


def test_lines_equal_the_plain_ones():
    for _ in range(200):
        texts = _texts(R.randrange(1, 8))
        array = pa.array(["cut off", *texts]).slice(1)  # its buffers hold more than the texts
        counts, lengths, begins, finishes, words, hashes = linedup._lines(array)
        plain = [(i, s, e, t[s:e].strip()) for i, t in enumerate(texts) for s, e in linedup.lines(t) if t[s:e].strip()]
        raw = [t.encode() for t in texts]
        assert lengths.tolist() == [len(t) for t in raw]
        assert np.repeat(np.arange(len(texts)), counts).tolist() == [x[0] for x in plain]
        assert [raw[x[0]][b:f].decode() for x, b, f in zip(plain, begins, finishes, strict=True)] == [texts[i][s:e] for i, s, e, _ in plain]
        assert words.tolist() == [len(x[3].split()) for x in plain]
        assert len(set(hashes.tolist())) == len({x[3] for x in plain}) == len(set(zip(hashes.tolist(), (x[3] for x in plain), strict=True)))
        which = np.arange(len(plain))
        assert linedup._bodies(array, counts, begins, finishes, which).to_pylist() == [x[3] for x in plain]


def test_lines_that_share_a_hash_do_not_share_a_key(monkeypatch):
    monkeypatch.setattr(linedup.xxhash, "xxh64_intdigest", lambda body, seed=0: len(body) + 10 * seed)
    hashes = linedup._line_hashes(["aa", "bb", "c", "dd"])
    assert len(set((hashes >> np.uint64(1)).tolist())) == 4


def test_only_equal_contents_occur_again():
    keys = np.array([8, 8, 8, 8, 20, 20, 31, 40, 51, 50], np.uint64)  # odd: occurs twice in its block
    bodies = pa.array(["one", "other", "one", "other", "x", "y", "twice", "alone", "m", "n"], pa.large_binary())
    assert linedup._occur_again(keys, bodies).tolist() == [True, False, True, False, False, False, True, False, True, False]


def _sent(spans: list[tuple]) -> dict[str, np.ndarray]:
    cols = list(zip(*spans, strict=True))
    flat = [x for before, size, after in zip(*cols[5:8], strict=True) for x in (*before, *size, *after)]
    made = [*cols[:5], *([len(x) for x in c] for c in cols[5:8]), flat]
    return {k: np.array(v, kind) for k, v, kind in zip(linedup._SENT, made, linedup._KINDS, strict=True)}


def test_spans_are_compared_line_by_line():
    sent = _sent(
        [
            # hash, row, at, begin, finish, lines before, of its own, after
            (5, 3, 1, 10, 20, [7, 8], [1, 2], [9, 4]),
            (5, 1, 2, 10, 20, [6, 8], [1, 2], [9, 5]),
            (5, 2, 0, 0, 9, [], [1, 3], []),  # another content under that hash
            (6, 2, 1, 9, 20, [0], [4], []),
            (6, 3, 3, 30, 40, [0], [4], []),  # lines that do not occur again equal none
            (7, 4, 0, 0, 5, [], [1], []),
            (8, 5, 0, 0, 9, [], [2, 2], []),
            (8, 5, 1, 4, 12, [], [2, 2], []),  # overlaps its first
            (8, 5, 2, 9, 15, [], [2, 2], []),
        ]
    )
    code, back, ahead = linedup._judge(pa.array([1, 2, 3, 3, None, 4, 5, 5, 5], pa.int64()), sent)
    assert code.tolist() == [1, 2, 0, 2, 1, 0, 1, 0, 2]
    assert back.tolist() == [0, 1, 0, 0, 0, 0, 0, 0, 0] and ahead.tolist() == [0, 1, 0, 0, 0, 0, 0, 0, 0]


def test_cuts_take_bytes_and_count_characters():
    texts = ["é. 語\nb", None, "", "語 \n", "äb"]
    left, counts, lost = linedup._without(pa.array(texts), np.array([0, 3, 4]), np.array([0, 0, 0]), np.array([4, 3, 2]))
    assert left.to_pylist() == ["語\nb", None, "", "", "b"]
    assert counts.tolist() == [1, 0, 0, 1, 1] and lost.tolist() == [3, 0, 0, 1, 1]


def test_repeats_go_across_blocks_and_columns_pass(spark, monkeypatch):
    line = lambda n: " ".join(f"wört{R.randrange(10**6)}" for _ in range(n)) + "…"
    passage = " ".join(line(9) for _ in range(4))
    rows = [(f"d{i:02}", f"{line(5)} {passage} {line(4)}", {"n": i}, [i]) for i in range(12)] + [("d03", None, {}, None), (None, "", None, [])]
    docs = spark.createDataFrame(rows, "doc_id string, text string, block map<string, int>, flags array<int>").repartition(5)
    got = linedup.remove_repeats(docs, linedup.EVERY)
    assert got.columns == [*docs.columns, "removed_chunks", "removed_chars"]
    kept = {(r.doc_id, r.text is None): r for r in got.collect()}
    assert len(kept) == len(rows) and got.where(F.col("removed_chunks") == 1).count() == 11
    for i, (d, text, block, flags) in enumerate(rows):
        r = kept[d, text is None]
        assert (r.block, r.flags) == (block, flags)
        assert r.text == (text if i in (0, 12, 13) else text.replace(passage + " ", ""))
        assert r.removed_chars == len(text or "") - len(r.text or "")
