"""Short repeated passages in differing surroundings."""

from __future__ import annotations

import random

from occulink.llm import linedup

R = random.Random(11)


def _line(n: int) -> str:
    return " ".join(f"w{R.randrange(10**6)}" for _ in range(n)) + "."


def test_passages_of_few_lines_go(spark):
    rows, planted = [], {}
    for k in range(60):
        n = 1 + k % 6
        passage = [_line(-(-R.randrange(16, 70) // n)) for _ in range(n)]
        for copy in range(3):
            around = [_line(R.randrange(3, 30)) for _ in range(R.randrange(2, 9))]
            at = R.randrange(len(around) + 1)
            joint = " " if k % 2 else "\n"
            rows.append((len(rows), joint.join([*around[:at], *passage, *around[at:]])))
            planted[len(rows) - 1] = (copy, joint.join(passage), joint.join(around))
    got = {r.doc_id: r for r in linedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), linedup.EVERY).collect()}
    for i, text in rows:
        copy, passage, around = planted[i]
        assert got[i].text.split() == (text if copy == 0 else around).split(), (i, passage)
        assert got[i].removed_chunks == (copy > 0)


def test_passage_of_common_lines_and_first_occurrence(spark):
    a, b, c = _line(9), _line(9), _line(40)
    short = "one two three four."
    texts = [a + "\n" + _line(20), b + "\n" + _line(20), f"{_line(5)}\n{a}\n{b}\n{_line(8)}", f"{_line(6)}\n{a}\n{b}\n{_line(7)}", "\n".join([short] * 10), f"{c}\n{c}"]
    got = [r.text for r in linedup.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), linedup.EVERY).orderBy("doc_id").collect()]
    assert got[:3] == texts[:3]  # each line occurs before, the passage does not
    assert got[3].split("\n") == [texts[3].split("\n")[0], texts[3].split("\n")[-1]]
    assert got[4].startswith(short) and got[5].strip() == c


def test_shortest_runs_make_up_every_passage():
    for _ in range(200):
        of = [_line(R.randrange(1, 25)) for _ in range(R.randrange(1, 12))]
        runs = linedup.shortest_runs("\n".join(of))
        assert all(len(body.split()) >= 16 for *_, body in runs)
        for first in range(len(of)):
            for last in range(first + 1, len(of) + 1):
                inside = [(a, a + body.count("\n") + 1) for a, _, _, body in runs if a >= first and a + body.count("\n") + 1 <= last]
                whole = sum(len(x.split()) for x in of[first:last]) >= 16
                assert {k for a, b in inside for k in range(a, b)} == (set(range(first, last)) if whole else set())


def test_cover_keeps_the_union():
    for _ in range(300):
        spans = [{"begin": b, "finish": b + R.randrange(1, 9)} for b in (R.randrange(40) for _ in range(R.randrange(12)))]
        points = lambda xs: {p for x in xs for p in range(x["begin"], x["finish"])}
        assert points(linedup.cover(spans)) == points(spans)
