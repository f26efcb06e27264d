"""Texts that recombine a pool of phrases: their strings hold several anchors, and stand at several of them."""

import random

import pytest
from test_graphs import plain_removed

from driftlens.llm import suffixes


@pytest.mark.parametrize("slab", [1 << 20, 20])
def test_recombined_phrases_equal_brute_force(spark, monkeypatch, slab):
    monkeypatch.setattr(suffixes, "SLAB", slab)
    rnd = random.Random(11)
    pool = ["".join(rnd.choice("abcdefghijklmnop ") for _ in range(rnd.randint(40, 130))) for _ in range(60)]
    rows = [(i, "".join(rnd.choice(pool) for _ in range(rnd.randint(4, 14)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r) for r in suffixes.report(docs).collect()), key=str)
    assert got == plain_removed(rows, 100)
