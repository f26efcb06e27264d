"""Suffixes, vectors, conversations, components and the pipeline against plain versions."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from driftlens.llm import chat, lattice, suffixes
from driftlens.llm import queries as llm
from driftlens.llm.components import components

SF = "/root/testdata/sf0.001"


def plain_removed(rows, length):
    """(id, bytes, removed, spans, digest) by looking up every string, rows in order of id (null last)."""
    seen, out = {}, []
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    for k in order:
        text = (rows[k][1] or "").encode()
        cover = bytearray(len(text))
        for p in range(len(text) - length + 1):
            first = seen.setdefault(text[p:p + length], (rows[k], p))
            if first != (rows[k], p):
                cover[p:p + length] = b"\1" * length
        kept = bytes(b for b, c in zip(text, cover, strict=True) if not c)
        out.append((rows[k][0], len(text), sum(cover), len([s for s in bytes(cover).split(b"\0") if s]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts():
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdeö ") for _ in range(rnd.randint(2, 9))) for _ in range(300)]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passage, base = prose(40), prose(300)
    rows = [(i, prose(30) + passage[rnd.randint(0, 30):] + prose(25)) for i in range(40)]
    rows += [(100 + i, base[:500 * i + 100] + prose(2) + base[500 * i + 100:]) for i in range(4)] + [(200, base), (201, base), (None, base)]
    return rows + [(300, None), (301, ""), (302, "short"), (303, "z" * 700), (304, "ab" * 400), (305, passage * 3), (200, base), (306, "é" * 60), (307, prose(2) + "é" * 60)]


@pytest.mark.parametrize("most", [suffixes.FREQUENT, 3])
def test_removed_bytes_equal_brute_force(spark, most):
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumns({c: F.lit(1) for c in ("doc", "th", "at", "lead", "ranges")})
    got = sorted((tuple(r) for r in suffixes.report(docs, most=most).collect()), key=str)
    assert got == plain_removed(rows, 100)


def test_removed_bytes_with_small_chunks_and_heads(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 512)
    rows = texts()
    wanted = [t.encode() for _, t in rows if t]
    whole = {(k, int(p)) for text, place, *_ in suffixes._found(wanted, 100, 24) for k, p in zip(text, place, strict=True)}
    monkeypatch.setattr(suffixes, "CHUNK", 1 << 20)
    assert whole == {(k, int(p)) for text, place, *_ in suffixes._found(wanted, 100, 24) for k, p in zip(text, place, strict=True)}


def test_no_texts(spark):
    assert suffixes.report(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    got = suffixes.report(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()
    assert [tuple(r)[:4] for r in got] == [(1, 0, 0, 0)]


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    rnd = random.Random(9)
    base, other = ("".join(rnd.choice("abcdefghij klmnop") for _ in range(n)) for n in (400, 300))
    got = suffixes.report(spark.createDataFrame([(1, base + other), (1, base)], "doc_id long, text string")).collect()
    assert sorted(r.n_removed for r in got) in ([0, 400], [0, 400])


def test_multikey_order_is_sorted():
    rows = np.random.default_rng(1).integers(97, 99, (2000, 21)).astype(np.uint8)
    order = suffixes.multikey_order(rows)
    listed = [bytes(rows[k]) for k in order]
    assert listed == sorted(bytes(r) for r in rows) and sorted(order) == list(range(2000))


# ---- vectors ----------------------------------------------------------------------------------------

def plain_links(rows, least=0.98):
    usable = [r for r in rows if r[0] is not None and r[1] is not None and r[2] and all(x is not None and np.isfinite(x) for x in r[2]) and any(r[2])]
    links = {r[0]: set() for r in rows if r[0] is not None}
    for i, (a, la, x) in enumerate(usable):
        for b, lb, y in usable[i + 1:]:
            if la == lb and len(x) == len(y) and np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                links[a].add(b)
                links[b].add(a)
    root = {}
    for a in sorted(links):
        stack = [a] if a not in root else []
        while stack:
            b = stack.pop()
            if b not in root:
                root[b] = a
                stack += links[b]
    return links, root


def test_links_equal_brute_force_in_small_blocks(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(6, 64))
    rows = [(i, int(i % 3), [float(np.float32(v)) for v in centre[i % 6] + rng.normal(size=64) * rng.choice([0.02, 0.1, 0.14])]) for i in range(400)]
    rows += [(1000 + i, 1, [float(np.float32(v)) for v in rng.normal(size=64)]) for i in range(200)]
    rows += [(2000, 1, rows[1][2]), (2001, 1, [2 * x for x in rows[1][2]]), (2002, None, rows[1][2]), (2003, 1, None), (2004, 1, [0.0] * 64), (2005, 1, [float("nan")] + rows[1][2][1:]),
             (2006, 1, [None] + rows[1][2][1:]), (2007, 1, []), (2008, 1, rows[1][2][:32]), (2009, 1, rows[1][2][:32]), (2010, 1, [1.0]), (2011, 1, [3.0])]
    links, root = plain_links(rows)
    docs = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumns({c: F.lit(1) for c in ("cid", "own", "kept")})
    got = {r.vec_id: r for r in lattice.near_duplicates(docs, block=16).collect()}
    found, all_ = sum(r.n_links for r in got.values()), sum(map(len, links.values()))
    assert 0.99 * all_ <= found <= all_ and all(got[k].n_links <= len(v) for k, v in links.items())
    assert sum(got[k].component_id == root[k] for k in root) >= 0.99 * len(root)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values()) and len(got) == len(rows)


def test_recall_on_given_vectors(spark):
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    links, _ = plain_links(rows)
    got = lattice.near_duplicates(spark.read.parquet(f"{SF}/embeddings.parquet")).collect()
    found, all_ = sum(r.n_links for r in got), sum(map(len, links.values()))
    assert 0.99 * all_ <= found <= all_
    assert lattice.near_duplicates(spark.createDataFrame([], "vec_id long, label int, embedding array<float>")).count() == 0


def test_decoded_points_are_nearest():
    x = np.random.default_rng(2).normal(size=(300, 8)) * 2
    p = lattice.decode(x)
    twice = np.rint(2 * p)
    assert np.allclose(twice, 2 * p) and (np.ptp(twice % 2, axis=1) == 0).all() and (p.sum(axis=1) % 2 == 0).all()
    own = ((x - p) ** 2).sum(axis=1)
    assert all((((x - p - step) ** 2).sum(axis=1) >= own - 1e-9).all() for step in lattice.shortest())


# ---- components, conversations ----------------------------------------------------------------------

def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 150)] + [(7, i) for i in range(1000, 1100)] + [(5, 5), (1000, 3), (3, 1000)]
    random.Random(1).shuffle(links)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 151)} == {100} and {got[i] for i in (3, 7, *range(1000, 1100))} == {3}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


TURN = "conv_id long, turn long, role string, text string, good boolean"


def test_preferences(spark):
    turns = [(0, 0, "system", "s"), (0, 1, "user", "q"), (0, 2, "assistant", "good"), (0, 3, "user", "more"), (0, 4, "assistant", None), (1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "bad"),
             (2, 0, "user", "same"), (3, 0, "user", "same"), (4, 0, "user", "alone"), (None, 0, "user", "x"), (6, 0, None, None), (7, 0, None, None), (7, 0, None, None)]
    frame = spark.createDataFrame([(*t, True) for t in turns], TURN)
    got = {r.pair_id: r for r in chat.preferences(frame, chat.neighbour_pairs(frame)).collect()}
    first = got[0]
    assert first.n_prompt_turns == 2 and first.prompt == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nq<|im_end|>\n"
    assert first.rejected == "<|im_start|>assistant\nbad<|im_end|>\n" and [first.chosen[m.begin:m.end] for m in first.chosen_mask] == ["good", ""]
    assert [first.rejected[m.begin:m.end] for m in first.rejected_mask] == ["bad"]
    assert (got[1].n_prompt_turns, got[1].chosen, got[1].rejected, got[1].chosen_mask) == (1, "", "", [])
    assert (got[2].n_prompt_turns, got[2].n_chosen_turns, got[2].n_rejected_turns) == (0, 1, 0)
    assert (got[3].n_prompt_turns, got[3].n_rejected_turns) == (1, 1) and set(got) == {0, 1, 2, 3}
    nothing = spark.createDataFrame([], TURN)
    assert chat.preferences(nothing, chat.neighbour_pairs(nothing)).count() == 0


def test_twins_share_all_but_the_last_answer(spark):
    turns = [(0, 0, "user", "q"), (0, 1, "assistant", "one"), (0, 2, "user", "more"), (0, 3, "assistant", "two"), (1, 0, "user", "x"), (1, 1, "assistant", "other"), (1, 2, "user", "bye"),
             (2, 0, "user", "no answer"), (3, 0, "assistant", "lonely"), (5, 0, "assistant", "no neighbour"), (None, 0, "assistant", "x"), (6, 0, "assistant", "a"), (6, 0, "assistant", "a"), (7, 0, "assistant", None)]
    twins = chat.swapped_answers(spark.createDataFrame([(*t, True) for t in turns], TURN))
    got = {r.pair_id: r for r in chat.preferences(twins, chat.twin_pairs(twins)).collect()}
    shown = {k: (r.n_prompt_turns, [r.chosen[m.begin:m.end] for m in r.chosen_mask], [r.rejected[m.begin:m.end] for m in r.rejected_mask]) for k, r in got.items()}
    assert shown == {0: (3, ["two"], ["other"]), 1: (1, ["other"], ["two"]), 6: (0, ["a", "a"], ["", ""]), 7: (0, [""], ["a"])}
    assert got[1].chosen.endswith("bye<|im_end|>\n") and "bye" in got[1].rejected


def test_registered_pairs_have_prompts(spark):
    folder = "/root/testdata/sf0.01"
    turns = spark.read.parquet(f"{folder}/conversations.parquet")
    before = {r.conv_id: r.n for r in turns.join(turns.where("role = 'assistant'").groupBy("conv_id").agg(F.max("turn").alias("last")), "conv_id").where("turn < last").groupBy("conv_id").agg(F.count("*").alias("n")).collect()}
    got = llm.QUERIES["op3_preference_format"](spark, folder).collect()
    assert len(got) > 50 and all(r.n_prompt_turns >= before.get(r.pair_id, 0) and (r.prompt != "" or not r.n_prompt_turns) for r in got)
    assert sum(r.n_prompt_turns > 0 for r in got) > 0.9 * len(got)


# ---- pipeline ---------------------------------------------------------------------------------------

def test_pipeline_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == columns, name
        assert {r.doc_id for r in docs.select("doc_id").collect()} <= ids
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count()
    run = corpus_pipeline.run(spark, SF)
    key = lambda rows: sorted(map(tuple, rows), key=str)
    assert key(run.collect()) == key(last.collect())


def test_pipeline_of_nothing_and_of_odd_rows(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    odd = [(1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "src0", 0), (None, "a text\nof two lines", "en", None, 5)]
    for rows, kept in (([], set()), (odd, {(None, "a text\nof two lines"), (1, None)})):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES[:3]:
            docs = stage(spark, docs, SF)
        # texts without words are copies of each other, the row with a text of its own stays
        assert {(r.doc_id, r.text) for r in docs.collect()} == kept
        mixed = corpus_pipeline.STAGES[3][1](spark, docs, SF)
        assert {r.doc_id for r in mixed.collect()} <= {i for i, _ in kept}
        assert corpus_pipeline.STAGES[4][1](spark, mixed, SF).count() == mixed.count()
