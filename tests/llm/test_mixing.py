"""The mix against a plain calculation: targets, blocks, permutations, places."""

from __future__ import annotations

import random
import re
import struct
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from occulink.llm.mixing import ROUNDS, Mixture, mix, mixed_texts, shuffled, source_targets, taken_words

SCHEMA = "doc_id long, text string, source string, size long, target double, s int, row long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _hash(*values: tuple[str, int]) -> int:
    """Spark's xxhash64 of longs and ints."""
    h = 42
    for kind, v in values:
        h = xxhash.xxh64_intdigest(struct.pack("<q", v), h) if kind == "q" else _hash_int(v, h)
    return h


def _hash_int(v: int, seed: int) -> int:
    return xxhash.xxh64_intdigest(struct.pack("<i", v), seed)


def _signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def swap_or_not(x: int, n: int, *key: tuple[str, int]) -> int:
    for turn in range(ROUNDS):
        other = (_signed(_hash(*key, ("i", turn))) % n - x) % n
        if _hash(*key, ("i", turn), ("q", max(x, other))) & 1:
            x = other
    return x


def water_fill(sizes: list[int], m: Mixture) -> list[float]:
    """Targets by resharing the excess again and again."""
    weights = [m.weights[i % len(m.weights)] for i in range(len(sizes))]
    target, at_most, left = [0.0] * len(sizes), set(), m.share * sum(sizes)
    while True:
        rest = [i for i in range(len(sizes)) if i not in at_most]
        share = left / sum(weights[i] for i in rest) if rest else 0
        over = [i for i in rest if share * weights[i] > m.most * sizes[i]]
        if not over:
            for i in rest:
                target[i] = share * weights[i]
            return target
        for i in over:
            target[i] = m.most * sizes[i]
            left -= target[i]
            at_most.add(i)


def ordered(rows, text_hash):
    by = defaultdict(list)
    for i, r in enumerate(rows):
        by[r[2]].append((text_hash[i] % (1 << 64), len(WORD.findall(r[1] or "")), i))
    names = sorted((s for s in by if s is not None), key=lambda s: s.encode()) + ([None] if None in by else [])
    return names, {s: sorted(by[s]) for s in names}


def brute_force(rows, text_hash, m):
    """Words of every slot, and the words taken of every row."""
    names, by = ordered(rows, text_hash)
    streams = {s: [(i, k) for _, n, i in by[s] for k in range(n)] for s in names}
    targets = dict(zip(names, water_fill([len(streams[s]) for s in names], m), strict=True))
    slots = []
    for number, s in enumerate(names):
        words, size = streams[s], len(streams[s])
        take, full, blocks = int(targets[s] + 0.5), size // m.block_words, -(-size // m.block_words)
        done = j = 0
        while done < take:
            turn, of = divmod(j, blocks)
            block = swap_or_not(of, full, ("i", m.seed), ("i", number), ("q", turn)) if of < full else of
            got = words[block * m.block_words : (block + 1) * m.block_words][: take - done]
            slots.append(got)
            done, j = done + len(got), j + 1
    taken = Counter(i for got in slots for i, _ in got)
    places = {}
    for j, got in enumerate(slots):
        places[divmod(swap_or_not(j, len(slots), ("i", m.seed), ("q", -1)), m.shard_blocks)] = got
    return targets, taken, places


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    rows = []
    for i in range(150):
        n = rng.choice([0, 1, 5, 40, 300])
        text = "".join(f"w{i}x{k}" + rng.choice([" ", "\t", "\r\n", "  "]) for k in range(n))
        rows.append((i, text, rng.choice(["a", "a", "a", "b", "Z", "é", None, "", "ﬀ", "𝔘"]), 1, 1.0, 1, 5))
    rows += [(200, None, "a", None, None, None, None), (201, "", "empty", 0, 0.0, 0, 0), (None, "one null id", "b", 0, 0.0, 0, 0), (202, "solo", "tiny", 0, 0.0, 0, 0)]
    rows += [(300, "same row twice", "b", 0, 0.0, 0, 0)] * 2 + [(301, "word " * 5000, "Z", 0, 0.0, 0, 0)]
    return rows


def hashes(spark, rows):
    df = spark.createDataFrame([(i, r[0], r[1]) for i, r in enumerate(rows)], "i long, doc_id long, text string")
    return {r.i: r.h for r in df.select("i", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("h")).collect()}


def test_mix_equals_brute_force(spark, rows):
    for m in (Mixture(block_words=8, shard_blocks=16), Mixture(weights=(1, 5), share=0.7, block_words=32, seed=9)):
        targets, taken, places = brute_force(rows, hashes(spark, rows), m)
        df = spark.createDataFrame(rows, SCHEMA)
        got = taken_words(mix(df.repartition(7), m)).collect()
        assert len(got) == len(rows)
        want = Counter((r[0], len(WORD.findall(r[1] or "")), round(targets[r[2]], 6), taken[i]) for i, r in enumerate(rows))
        assert Counter((r.doc_id, r["size"], round(r.target, 6), r.taken) for r in got) == want
        texts = {(r.shard, r.slot): r.text for r in mixed_texts(df, m).collect()}
        word = [WORD.findall(r[1] or "") for r in rows]
        assert texts == {k: " ".join(word[i][n] for i, n in got) for k, got in places.items()}


def test_production_mix_meets_its_targets(spark):
    from tests.conftest import SF_SMALL

    from occulink.llm.queries import op12_multinomial_block_mixing

    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = op12_multinomial_block_mixing(spark, SF_SMALL).collect()
    assert Counter(r.doc_id for r in got) == Counter(list(docs))
    by = defaultdict(lambda: [0, 0, 0.0, 0])
    for r in got:
        assert r["size"] == len(WORD.findall(docs[r.doc_id].text or "")) and r.taken <= 2 * r["size"]
        s = by[docs[r.doc_id].source]
        by[docs[r.doc_id].source] = [s[0] + r["size"], s[1] + r.taken, r.target, r.source_size]
    assert all(size == of and abs(taken - target) <= 0.5 for size, taken, target, of in by.values())
    names = sorted(by)
    assert [by[n][2] for n in names] == pytest.approx(water_fill([by[n][0] for n in names], Mixture()))
    again = op12_multinomial_block_mixing(spark, SF_SMALL).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_shards_hold_the_sources_like_a_draw(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 50).alias("text"), F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("source"))
    mixed = mix(docs, Mixture(block_words=10, shard_blocks=1000))
    counts = {(r.shard, r.s): r.n for r in mixed.spans.join(mixed.docs, "row").groupBy("shard", "s").agg(F.countDistinct("slot").alias("n")).collect()}
    share = {r.s: r.target / 225_000 for r in mixed.sources.collect()}
    for shard in range(22):
        for s, p in share.items():
            assert abs(counts[shard, s] - 1000 * p) < 5 * (1000 * p * (1 - p)) ** 0.5


def test_permutation_and_targets(spark):
    for n in (1, 2, 3, 10, 257, 1000):
        got = [r[0] for r in spark.range(n).select(shuffled(F.col("id"), F.lit(n).cast("long"), F.lit(5))).collect()]
        assert sorted(got) == list(range(n)) and got == [swap_or_not(i, n, ("i", 5)) for i in range(n)]
        assert n < 100 or sum(a == b for a, b in enumerate(got)) < n / 10
    rng = random.Random(2)
    for _ in range(5):
        sizes = [rng.choice([0, 1, 10, 1000, 100_000]) for _ in range(rng.randrange(1, 12))]
        df = spark.createDataFrame([(f"s{i:03}", n) for i, n in enumerate(sizes)], "source string, source_size long")
        m = Mixture()
        assert [r.target for r in source_targets(df, m).orderBy("s").collect()] == pytest.approx(water_fill(sizes, m))


def test_empty_and_wordless_tables(spark):
    assert taken_words(mix(spark.createDataFrame([], SCHEMA))).count() == 0
    got = taken_words(mix(spark.createDataFrame([(1, None, None, 0, 0.0, 0, 0), (2, " \n", "a", 0, 0.0, 0, 0)], SCHEMA))).collect()
    assert sorted((r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in got) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
