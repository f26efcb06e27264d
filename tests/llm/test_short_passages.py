"""Repeated passages of a few lines: what is removed, against a rule that knows neither hashes nor chunks."""

import random

import pytest

from driftlens.llm import lines


def plain_repeats(rows):
    """For each text the lines with words that stand, with a neighbour of theirs, earlier in the corpus too."""
    seen, out = set(), {}
    for key, text in sorted(rows):
        all_, gone = text.split("\n"), set()
        full = [i for i, line in enumerate(all_) if line.strip(" \t\n\x0b\f\r")]
        for a, b in zip(full, full[1:], strict=False):
            run = tuple(all_[a:b + 1])
            if run in seen:
                gone |= {a, b}
            seen.add(run)
        out[key] = gone
    return out


def lost_lines(spark, rows, **settings):
    """Numbers of the lines with words that each text lost, by aligning what is left."""
    left = {r.doc_id: r.text for r in lines.remove(spark.createDataFrame(rows, "doc_id long, text string"), **settings).collect()}
    out = {}
    for key, text in rows:
        kept, gone = left.get(key, "").split("\n"), set()
        at = 0
        for i, line in enumerate(text.split("\n")):
            if at < len(kept) and kept[at] == line:
                at += 1
            elif line.strip():
                gone.add(i)
        out[key] = gone
    return out


@pytest.mark.parametrize("size", [2, 3, 5, 9])
def test_short_repeated_passages_go(spark, size):
    rnd = random.Random(size)
    own = lambda n: [f"own line {rnd.random()}" for _ in range(n)]
    passages = [[f"shared line {p} {i}" if rnd.random() > 0.2 or i in (0, size - 1) else "" for i in range(size)] for p in range(200)]
    rows = [(i, "\n".join(own(rnd.randint(0, 4)) + passages[i % 200] + own(rnd.randint(0, 4)))) for i in range(600)]
    want, got = plain_repeats(rows), lost_lines(spark, rows)
    assert all(got[k] <= want[k] for k in want)
    assert sum(map(len, got.values())) >= 0.9 * sum(map(len, want.values()))


def test_recall_on_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = plain_repeats(rows)
    lost = {r.doc_id: r.n_removed for r in lines.report(docs).collect()}
    assert sum(map(len, want.values())) > 500
    assert sum(lost.values()) >= 0.95 * sum(map(len, want.values()))
    assert all(want[k] or not n for k, n in lost.items())


def test_the_boundaries_decide(spark):
    """Other boundaries, other chunks: with no place marked nothing goes, with each place marked every repeated pair does."""
    rows = [(i, "\n".join(f"line {k}" for k in range(i % 3, 9))) for i in range(6)]
    none, every = lost_lines(spark, rows, share=(0, 1)), lost_lines(spark, rows, share=(1, 1))
    assert not any(none.values()) and every == plain_repeats(rows)
