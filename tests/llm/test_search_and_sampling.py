"""Importance resampling, language identification and ranked search against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from driftlens.llm import languages, ranking, resampling

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b"), (6, "Ünï ▁▁ code<|endoftext|>\U0001f600 x'll don't  \n\n \x00"), (7, "word " * 3000), (4, "one"), (None, "no id"),
       (8, "　\x85\x1c end"), (9, "x" * 5000), (10, "A-a_A0 İ ß É"), (11, "1 2 3")]


def odd(spark):
    made = spark.createDataFrame(ODD, "doc_id long, text string")
    return made.withColumns({c: F.lit(1) for c in ("uid", "id", "n", "term", "tf", "m", "block", "weight", "rank", "features", "_open", "_at", "h", "nth", "bucket")})


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# ---- importance resampling --------------------------------------------------------------------------

def plain_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [zlib.crc32(" ".join(words[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def plain_ranks(docs, target, share=(5, 100)):
    made = [(key, *plain_features(t)) for key, t in docs]
    s, t = Counter(b for _, _, f in made for b in f), Counter(b for x in target for b in plain_features(x)[1])
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000)))) for b in s}
    rows = []
    for key, n, found in made:
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append((key, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    open_ = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    drawn = {id(r): k + 1 for k, r in enumerate(open_[:share[0] * len(open_) // share[1]])}
    return [(r[0], r[2], r[3], r[4], drawn.get(id(r))) for r in rows]


@pytest.mark.parametrize("share", [(5, 100), (1, 2), (1, 1)])
def test_resampling_equals_plain_version(spark, share):
    docs = odd(spark).select("doc_id", "text").union(documents(spark).select("doc_id", "text"))
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = Counter(tuple(r) for r in resampling.ranked(docs, target, share).collect())
    assert got == Counter(plain_ranks(pairs(docs), [r.text for r in target.collect()], share))


def test_random_texts_have_the_features_of_the_pattern():
    rnd = random.Random(11)
    parts = [" ", "  ", "-", "a", "B", "Zz9", "é", "　", "梦", "\U0001f600", "\x00", "\x7f", "{", "`", "@", "İ", "\n"]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12)))
        n, found = resampling.buckets_of(text)
        want_n, want = plain_features(text)
        assert n == want_n and Counter(found.tolist()) == Counter(want), ascii(text)
    for longest in (1, 2, 5):
        assert len(resampling.buckets_of("a b c d", longest)[1]) == sum(max(0, 4 - k) for k in range(longest))


def test_resampling_of_odd_and_of_nothing(spark):
    target = spark.createDataFrame([(1, None), (2, "")], "item_id long, text string")
    got = {r.doc_id: (r.n_features, r.weight) for r in resampling.ranked(odd(spark), target).collect()}
    assert got[1] == got[2] == got[3] == (0, 0) and got[7][0] == 3000 + 2999 + 2998 and None in got
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.ranked(none, target).count() == 0 and resampling.draw(none, target).count() == 0
    drawn = resampling.draw(odd(spark), target, share=(1, 1))
    assert drawn.columns == odd(spark).columns and [r.doc_id for r in drawn.collect()] == [7]


# ---- languages --------------------------------------------------------------------------------------

def plain_phrases(known, data):
    """Greedy parse by searching the labelled text itself."""
    n = at = 0
    while at < len(data):
        size = 1
        while at + size <= len(data) and data[at:at + size] in known:
            size += 1
        at += max(size - 1, 1)
        n += 1
    return n


def test_phrases_equal_a_search_in_the_text():
    rnd = random.Random(12)
    for alphabet in (b"ab", b"abc ", bytes(range(1, 40))):
        for _ in range(60):
            known = bytes(rnd.choice(alphabet) for _ in range(rnd.randint(0, 120)))
            data = bytes(rnd.choice(alphabet + b"z") for _ in range(rnd.randint(0, 60)))
            model = languages.Languages({"x": known})
            assert model.all[0].phrases(data.translate(model.fold)) == plain_phrases(known, data)


def test_held_out_languages_are_known(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in languages.identify(docs, languages.fit(docs)).collect()}
    held = [(got[r.doc_id], r.lang) for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(got) == docs.count() and all(r.held_out for r, _ in held) and sum(r.held_out for r in got.values()) == len(held)
    assert sum(r.lang_pred == lang for r, lang in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_only_learning_rows_are_learnt_from(spark):
    rows = [(i, f"text{i} abc", "aa" if i % 2 else "bb") for i in range(200)] + [(None, "nobody", "aa"), (500, None, "aa"), (501, "unlabelled", None)]
    learnt = languages.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(learnt) == {"aa", "bb"} and b"nobody" not in learnt["aa"] and b"unlabelled" not in b"".join(learnt.values())
    assert len(learnt["aa"]) == sum(len(languages.letters(t)) for i, t, lang in rows if lang == "aa" and i is not None and t and zlib.crc32(str(i).encode()) % 4 != 2)
    small = languages.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_bytes=400)
    assert 0 < len(small["aa"]) <= 250


def test_languages_of_odd_texts(spark):
    model = {"en": b" the cat and the dog are here ", "fr": " le chat est là et le chien ".encode()}
    got = {r.doc_id: r for r in languages.identify(odd(spark), model).collect()}
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (1, 2, 3, 11)) and got[None].held_out is False
    assert {r.lang_pred for r in languages.identify(odd(spark), {}).collect()} == {"und"}
    told = spark.createDataFrame([(1, "The DOG and the cat"), (2, "le chien et le chat"), (3, "x" * 200_000)], "doc_id long, text string")
    assert [r.lang_pred for r in languages.identify(told, model).orderBy("doc_id").collect()] == ["en", "fr", "fr"]  # nothing known: the shorter labelled text is the cheaper one
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert languages.fit(none) == {} and languages.identify(none, {}).count() == 0


# ---- ranked search ----------------------------------------------------------------------------------

def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, k):
    made = [(key, Counter(plain_terms(t))) for key, t in docs]
    made = [(key, c, c.total()) for key, c in made if c]
    n_docs, words, df = len(made), sum(n for _, _, n in made), Counter(t for _, c, _ in made for t in c)
    out = []
    for item, text in set(items):
        found = []
        for key, c, n in made:
            m = 50 + 50 * n * n_docs // words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(plain_terms(text)) if c[t])
            if score > 0:
                found.append((-score, key is None, key))
        out += [(item, rank + 1, key, -s) for rank, (s, _, key) in enumerate(sorted(found)[:k])]
    return Counter(out)


def many(seed, n):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    docs = [(i, " ".join(rnd.choices(words, weights, k=rnd.choice([1, 5, 5, 5, 20, 80])))) for i in range(n)]
    docs += [(n + i, docs[0][1]) for i in range(150)] + [(3, "w1 w1 w2"), (3, "w1 w1 w2"), (None, "w1 w1 w2")]
    items = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 6)))) for i in range(30)] + [(1, "w1 w59"), (2, "no such word"), (3, None), (None, "w1 w2"), (40, "w1 w2"), (40, "w1 w2")]
    return docs, items


@pytest.mark.parametrize(("k", "pair_limit", "block", "held", "cells"), [(50, 500_000, 200_000, 1_000_000, 4_000_000), (3, 10, 40, 200, 100), (1, 500_000, 5, 20, 1)])
def test_search_equals_plain_version(spark, monkeypatch, k, pair_limit, block, held, cells):
    monkeypatch.setattr(ranking, "HELD", held)
    monkeypatch.setattr(ranking, "CELLS", cells)
    docs, items = many(5, 700)
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = Counter(tuple(r) for r in ranking.search(*frames, k=k, pairs=pair_limit, block=block).collect())
    assert got == plain_search(docs, items, k)


def test_bounds_hold_and_leave_blocks_out():
    import numpy as np

    queries = ranking.Queries([(7, 0, 100), (7, 1, 10), (9, 1, 10)])
    columns = [np.array(c, np.int64) for c in ([0, 0, 1, 1, 5], [1, 3, 1, 2, 9], [4, 5, 4, 6, 6], [40, 50, 40, 60, 60])]
    block = ranking.Block(100, columns, queries)
    assert block.bounds.tolist() == [100 * ranking.impact(3, 100) + 10 * ranking.impact(2, 100), 10 * ranking.impact(2, 100)]
    best = ranking.Best(2, 1)
    block.visit(best)
    assert best.id.tolist() == [50, 60]
    best.least[:] = block.bounds + 1
    before = best.query.copy()
    block.visit(best)
    assert best.query.tolist() == before.tolist()


def test_search_of_odd_and_of_nothing(spark):
    items = spark.createDataFrame([(1, "one word é x1"), (2, "x" * 5000)], "item_id long, text string").withColumns({"doc_id": F.lit(3), "n": F.lit(2)})
    got = Counter(tuple(r) for r in ranking.search(odd(spark), items).collect())
    assert got == plain_search(ODD, [(r.item_id, r.text) for r in items.collect()], 50)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert ranking.search(none, items).count() == 0
    assert ranking.search(odd(spark), spark.createDataFrame([], "item_id long, text string")).count() == 0
