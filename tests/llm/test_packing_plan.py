"""The packing plan follows the least-squares solution also when its counts are small."""

from __future__ import annotations

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from occulink.llm import packing  # noqa: E402


def test_most_sequences_come_from_the_solution():
    tails = np.random.default_rng(4).integers(1, 256, 300)
    histogram = np.bincount(tails, minlength=257)
    p = packing.plan(histogram, 256)
    combos = packing.combinations(np.nonzero(histogram)[0], 256)
    solution = packing.solve(combos, histogram)
    assert np.floor(solution).sum() < 0.5 * solution.sum()  # rounding down alone would lose it
    assert p.solved >= 0.8 * solution.sum() and p.solved <= p.sequences
    filled = np.zeros(p.sequences, int)
    numbers: dict[int, int] = {}
    for length, first, sequence, _ in p.tails.tolist():
        assert first == numbers.get(length, 0)
        following = [t for t in p.tails.tolist() if t[0] == length and t[1] > first]
        times = (min(t[1] for t in following) if following else int(p.rest_from[length])) - first
        filled[sequence : sequence + times] += length
        numbers[length] = first + times
    assert (filled == 256).all() and all(p.rest_from[length] <= histogram[length] for length in numbers)
