"""Document operators against brute force, with odd rows."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from occulink.llm import backoff, bpe, classifiers, jaccard, linedup, packing, queries, sharding  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, row long, ids string, score double, key string, n int, shard int"
R = random.Random(5)
WORDS = ["la", "mer", "über", "the", "house", "42", "blue", "<|endoftext|>", "x.", "né", "don't", "\t", "🙂"]


def _sentence(n: int) -> str:
    return " ".join(R.choice(WORDS) + str(R.randrange(50)) for _ in range(n)) + "."


def _rows() -> list[tuple]:
    base = [_sentence(R.randrange(1, 80)) for _ in range(30)]
    long = " ".join(_sentence(12) for _ in range(900))
    near = [long.replace("house", "home", k) for k in range(4)]
    words = base[3].split()
    texts = [*base, None, None, "", "", " \n ", "one two", "One  two", long, long, *near, " ".join(words[:-1]), " ".join([*words, "more"]), "z" * 3000, base[0], base[0]]
    rows = [(i, t, None, 1, "x", 0.5, None, 3, 9) for i, t in enumerate(texts)]
    return [*rows, rows[5], rows[5], (None, "no id", "en", None, None, None, "k", None, None), (None, None, None, None, None, None, None, None, None)]


ROWS = _rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _links(texts: list[str]) -> list[int]:
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    out = [0] * len(texts)
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if texts[a] == texts[b] or (both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) - 1e-9):
                out[a] += 1
                out[b] += 1
    return out


@pytest.mark.parametrize("block", [256, 2])
def test_join_equals_brute_force(docs, block):
    got = jaccard.jaccard_join(docs, jaccard.Settings(block=block)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.links) for r in got) == sorted((r[0] is None, r[0] or 0, n) for r, n in zip(ROWS, _links([r[1] or "" for r in ROWS]), strict=True))
    groups = {}
    for r in got:
        groups.setdefault(r.group_id, []).append(r.kept)
    assert all(sum(k) == 1 for g, k in groups.items() if g is not None)


def test_one_of_each_group_keeps_columns(docs, none):
    kept = jaccard.one_of_each_group(docs)
    assert kept.columns == docs.columns
    texts = [r.text or "" for r in kept.collect()]
    assert len(texts) == len(set(texts)) and set(_links(texts)) == {0}
    assert jaccard.jaccard_join(none).count() == 0


def test_pruning_keeps_pairs_at_the_threshold():
    need = jaccard.least_matches(jaccard.Settings())
    assert all(need[n] <= 0.8 * n for n in range(20, 121, 20)) and need[120] > 60


def test_repeated_passage_goes(spark, none):
    passage = " ".join(_sentence(9) for _ in range(14))
    texts = [f"{_sentence(6)} {passage} {_sentence(7)}\n{_sentence(5)}" for _ in range(6)]
    clean = [_sentence(30) + "\n" + _sentence(30) for _ in range(5)]
    rows = [(i, t) for i, t in enumerate([*texts, *clean, None, "", clean[0]])]
    got = {r.doc_id: r for r in linedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].text == texts[0] and got[0].removed_chunks == 0
    for i in range(1, 6):
        assert got[i].removed_chars > 0.9 * len(passage)
        assert got[i].text.split()[:5] == texts[i].split()[:5] and got[i].text.endswith(texts[i].split("\n")[1])
    assert all(got[6 + k].text == t for k, t in enumerate(clean))
    assert got[11].text is None and got[12].text == "" and len(got[13].text) < len(clean[0])
    assert linedup.remove_repeats(none).count() == 0


def test_removed_runs_equal_brute_force(docs):
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    every = [list(linedup.chunks(r[1] or "")) for r in order]
    one: dict[str, tuple[int, int]] = {}
    expected = 0
    for d, chunks in enumerate(every):
        text, again, repeats = order[d][1] or "", set(), []
        for at, (_, _, body) in enumerate(chunks):
            if body and one.setdefault(body, (d, at)) != (d, at):
                again.add(at)
        for at in sorted(again):
            begin, finish, body = chunks[at]
            words, (od, oat) = len(body.split()), one[body]
            for step in (-1, 1):
                a, o = at + step, oat + step
                # a chunk that occurs again anywhere is compared as a whole
                shared = 0 <= a < len(chunks) and sum(c[2] == chunks[a][2] for cs in every for c in cs) > 1
                if 0 <= a < len(chunks) and 0 <= o < len(every[od]) and not shared:
                    at_lines = [(chunks[a][0] + s, chunks[a][0] + e) for s, e in linedup.lines(text[chunks[a][0] : chunks[a][1]])]
                    mine = [(s, e) for s, e in at_lines if text[s:e].strip()][::step]
                    theirs = every[od][o][2].split("\n")[::step]
                    for (s, e), their in zip(mine, theirs, strict=False):
                        if text[s:e].strip() != their or not their:
                            break
                        begin, finish, words = min(begin, s), max(finish, e), words + len(their.split())
            repeats.append((at, begin, finish, words))
        holes = linedup.holes(repeats)
        left, last = "", 0
        for begin, finish in holes:
            left, last = left + text[last:begin], finish
        expected += len(text) - len(left + text[last:])
    got = linedup.remove_repeats(docs)
    assert got.columns == [*docs.columns, "removed_chunks", "removed_chars"]
    assert got.agg(F.sum("removed_chars")).first()[0] == expected > 0


def test_chunks_cover_the_text():
    for r in ROWS:
        spans = list(linedup.chunks(r[1] or ""))
        assert "".join((r[1] or "")[s:e] for s, e, _ in spans) == (r[1] or "")
        assert [x for _, _, body in spans for x in body.split()] == (r[1] or "").split()


def test_bpe_equals_tiktoken(docs, none):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted(str(((r[0]), len(i := e.encode_ordinary(r[1] or "")), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest())) for r in ROWS)
    assert sorted(str(tuple(r)) for r in bpe.digests(docs, path, public_tokenizers.PATTERN).collect()) == want
    assert bpe.digests(none, path, public_tokenizers.PATTERN).count() == 0
    coder = bpe.coder(path, public_tokenizers.PATTERN)
    for n in (1, 7, 200, 700):
        word = "".join(R.choices("etaoinshrdlüé", k=n))
        assert coder._long(word.encode()) == e.encode_ordinary(word)


def test_backoff_equals_sql(docs, none, tmp_path):
    docs.select("doc_id", "text").toPandas().to_parquet(tmp_path / "d.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d.parquet'")
    key = lambda r: (r[0] is None or r[0] != r[0], r[0] or 0, str(r[1:]))
    want = sorted(con.execute(queries.oracle_sql()["op9_stupid_backoff"]).fetchall(), key=key)
    got = sorted((tuple(r) for r in backoff.backoff_scores(docs).collect()), key=key)
    assert [r[1:] for r in got] == [r[1:] for r in want]
    assert backoff.backoff_scores(none).count() == 0


def test_backoff_against_another_corpus(spark, docs):
    got = {r.doc_id: r for r in backoff.backoff_scores(spark.createDataFrame([(1, "a b c"), (2, "q")], "doc_id long, text string"), spark.createDataFrame([("a b c",), ("a b d",)], "text string")).collect()}
    # a: 2 of 2 starts; b after it: 2 of 2; c: 1 of 2.  q: floor of one in six words
    assert got[1].log_score == pytest.approx(-0.693147) and got[2].log_score == pytest.approx(-3.624341, abs=1e-5)


def test_packing_places_every_id_once(docs, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    pieces = packing.pack(docs, path).collect()
    sequences: dict[int, list] = {}
    for p in pieces:
        assert len(p.ids) == 4 * p.length and p.length > 0
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for spans in sequences.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False)) and sum(n for _, n in spans) <= 2048
    total = sum(len(t.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in ROWS)
    assert sum(p.length for p in pieces) == total and len(sequences) <= total // 2048 + 2
    of = {i: [p for p in pieces if p.doc_id == i] for i in range(len(ROWS) - 4) if i != 5}
    for r in ROWS[:-4]:
        if r[0] != 5:
            ids = b"".join(p.ids for p in sorted(of[r[0]], key=lambda p: p.start))
            assert ids == b"".join(x.to_bytes(4, "little") for x in [*t.encode(r[1] or "", add_special_tokens=False).ids, 1])
    assert packing.pack(none, path).count() == 0


def test_shards(docs, none):
    got = sharding.histogram_sort_shards(docs, shards=4).collect()
    assert len(got) == len(ROWS)
    sizes: dict[int, int] = {}
    slots: dict[int, list] = {}
    for r in got:
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and sum(sizes.values()) == sum(len((r[1] or "").encode()) + 16 for r in ROWS)
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in ROWS)
    largest = max(len((r[1] or "").encode()) + 16 for r in ROWS)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest
    assert sharding.histogram_sort_shards(none, shards=4).count() == 0


def test_classifiers_learn_and_take_odd_rows(spark, docs, none):
    good = [(100 + i, "river stone light " * R.randrange(3, 9)) for i in range(150)]
    bad = [(300 + i, "junk click buy " * R.randrange(3, 9)) for i in range(150)]
    rows = [(i, t, *ROWS[0][2:]) for i, t in good + bad]
    labels = spark.createDataFrame([*((i, 1, 0) for i, _ in good), *((i, 0, 1) for i, _ in bad), (None, 1, 1), (100, None, None)], "doc_id long, quality int, toxic int")
    every = docs.unionByName(spark.createDataFrame(rows, SCHEMA))
    for scored, sign in ((classifiers.quality_scores(every, labels), 1), (classifiers.toxicity_scores(every, labels), 0)):
        got = scored.collect()
        assert len(got) == len(ROWS) + 300 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
        fresh = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id >= 100]
        assert fresh and all(r.predicted == (sign if r.doc_id < 300 else 1 - sign) for r in fresh)
    assert classifiers.keep_good(every, labels).columns == [c for c in every.columns]
    assert classifiers.quality_scores(none, labels).count() == 0
    assert {r.score for r in classifiers.quality_scores(docs, labels.where(F.lit(False))).collect()} == {0.5}
