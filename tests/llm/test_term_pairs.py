"""Words that are neutral apart and toxic together."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from occulink.llm import classifiers, fm


def test_planted_pair_is_learned(spark):
    r = random.Random(3)
    rows, labels = [], []
    for i in range(2400):
        words = [f"w{r.randrange(60)}" for _ in range(r.randrange(8, 25))]
        kind = i % 4  # each planted word is in half of the toxic and half of the clean documents
        words += [["amber", "falcon"], [], ["amber"], ["falcon"]][kind]
        r.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(kind < 2)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scored = classifiers.toxicity_scores(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).where("held_out").collect()
    right = [r.predicted == int(r.doc_id % 4 < 2) for r in scored]
    assert len(right) > 300 and np.mean(right) > 0.95


def test_pairs_are_selected_only_where_they_differ():
    r = np.random.default_rng(1)
    y = (np.arange(3000) % 2).astype(float)
    x = r.random((3000, 40)) < 0.3
    x[:, 0] = r.random(3000) < 0.5
    x[:, 1] = x[:, 0] == (y > 0)
    of, terms = np.nonzero(x)
    sample = fm.Sample(terms.astype(np.uint32), of, np.zeros((3000, 0)), y)
    chosen, scale = fm._select(sample, fm.Settings())
    assert {0, 1} <= set(chosen.tolist()) and len(chosen) <= 4 and len(scale) == len(chosen)
