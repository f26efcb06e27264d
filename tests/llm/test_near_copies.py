"""The pipeline's near-duplicate stage against exact 5-word Jaccard similarity of all pairs."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from driftlens.llm import nearcopies, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_sets(texts):
    out = []
    for text in texts:
        words = text.lower().split()
        k = min(5, len(words))
        out.append({tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set())
    return out


def plain_kept(rows):
    """Ids that are the smallest of their component."""
    sets, parent = plain_sets([r[1] for r in rows]), list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both >= 0.8 * (len(x) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {rows[k][0] for k in range(len(rows)) if find(k) == k}


def near_copies():
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(30):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(80, 300))]
        for _ in range(6):
            copy = list(base)
            for _ in range(rnd.randint(0, len(copy) // 30)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            texts.append(" ".join(copy))
    base = [rnd.choice(vocabulary) for _ in range(150)]
    for k in range(120):  # one large group; each differs from most others
        copy = list(base)
        for _ in range(rnd.choice([1, 2, 3])):
            copy[rnd.randrange(len(copy))] = f"x{k}"
        texts.append(" ".join(copy))
    texts += [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 200))) for _ in range(100)]
    return [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]


def test_near_copies_go(spark):
    rows = near_copies()
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert kept == plain_kept(rows)
    assert len(kept) < 250


def test_rows_that_share_an_id_go_by_their_text(spark):
    one = " ".join(f"a{i}" for i in range(100))
    rows = [(1, one), (5, one + " more"), (5, "quite another text"), (7, "quite another text too"), (None, one), (None, "no id at all here")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()), key=str)
    assert got == sorted([rows[0], rows[2], rows[3], rows[5]], key=str)


def test_odd_rows_and_clashing_names(spark):
    long = " ".join(f"z{i % 7919}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (4, "one"), (5, "ONE"), (None, "no id"), (6, long), (7, long + " more"), (8, "two three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("_gone", "_gone_th", "_id", "_th", "node", "key", "n", "th", "row", "fp", "root", "head")})
    kept = nearcopies.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([rows[0], rows[3], rows[4], rows[6], rows[7], rows[9]], key=str)
    assert nearcopies.keep_first(docs.where("doc_id > 99")).count() == 0


def family(seed, n, words, changed, copies=1):
    """Copies of one text that each differ from it in some words, and from each other in twice as many."""
    rnd = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    texts = [" ".join(base)]
    for k in range(n):
        copy = list(base)
        for at in rnd.sample(range(words), rnd.choice(changed)):
            copy[at] = rnd.choice([f"x{k}", f"x{rnd.randint(0, 9)}", ""])
        texts += [" ".join(copy)] * copies
    return texts


@pytest.mark.parametrize(("changed", "with_base", "few"), [((1, 2, 3, 4, 5, 6), True, 4), ((2, 3), False, 3)])
def test_large_families_equal_all_pairs(spark, monkeypatch, changed, with_base, few):
    texts = family(sum(changed), 120, 90, changed)[0 if with_base else 1:]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    monkeypatch.setattr(nearcopies, "FEW", few)
    kept = {r.doc_id for r in nearcopies.keep_first(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert kept == plain_kept(rows)


def test_few_pairs_are_compared_in_a_family(spark, monkeypatch):
    """Altered copies, most of them similar to the text they come from, few to each other: of 80,000 pairs a tenth at most."""
    seen = []
    was = nearcopies._verified
    monkeypatch.setattr(nearcopies, "_verified", lambda pairs, sets, parts: (seen.append(pairs.distinct().count()), was(pairs, sets, parts))[1])
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(family(1, 400, 150, (1, 2, 3, 4, 5, 6, 7)))]
    kept = {r.doc_id for r in nearcopies.keep_first(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert kept == plain_kept(rows) and sum(seen) < 6_000


def test_distances_that_halves_cannot_find_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.range(3).select(F.col("id").alias("fp")), 4)
