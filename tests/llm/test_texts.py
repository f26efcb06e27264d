"""Operators on texts against plain versions: tokens, pieces, fingerprints, quality, lines, toxicity, mixing."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from driftlens.llm import lines, mixing, pieces, quality, simhash, tokens, toxicity
from driftlens.llm import queries as llm

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b"), (6, "Ünï ▁▁ code<|endoftext|>\U0001f600 x'll don't  \n\n \x00"), (7, "word " * 3000), (4, "one"), (None, "no id"),
       (8, "　\x85\x1c end"), (9, "x" * 5000), (10, "</s> <s> <unk> <0x41>")]


def odd(spark, columns="doc_id long, text string"):
    """Odd rows with extra columns whose names the operators use themselves."""
    made = spark.createDataFrame(ODD, columns)
    return made.withColumns({c: F.lit(1) for c in ("row", "fp", "id", "th", "copy", "_of", "h1", "n_tokens", "score", "lang_", "_gone", "kept")})


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


# ---- tokens and pieces ------------------------------------------------------------------------------

def test_token_counts_equal_the_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = odd(spark).select("doc_id", "text").union(documents(spark).select("doc_id", "text"))
    got = Counter(tuple(r) for r in tokens.count_tokens(rows, path).collect())
    n = lambda t: len(library.encode(t or "", add_special_tokens=False).ids)
    assert got == Counter((r.doc_id, len((r.text or "").encode()), n(r.text), n(r.text) > 512) for r in rows.collect())
    assert tokens.count_tokens(odd(spark), path).count() == len(ODD) and tokens.count_tokens(empty(spark), path).count() == 0


def random_texts(seed, n):
    rnd = random.Random(seed)
    parts = [" ", "  ", "\n", "\t", "a", "the", "ing", "ö", "▁", "　", "梦", "\U0001f600", "\x00", "x1", "--", "'s", "'re", "<|endoftext|>", "<|", "²", "\x85", "http://", "ЖЖ"]
    return ["".join(rnd.choice(parts) if rnd.random() < 0.7 else chr(rnd.choice([rnd.randint(0, 0xD7FF), rnd.randint(0xE000, 0x2FFFF)])) for _ in range(rnd.randint(0, 14))) for _ in range(n)]


def test_random_texts_count_alike():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, counter = Tokenizer.from_file(path), tokens._Counter(path, tokens.frequent_lengths(path), *tokens.pre_token_patterns(path))
    for text in random_texts(1, 3000):
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), ascii(text)


def test_full_caches_change_nothing(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 3)
    counter = tokens._Counter(path, {}, *tokens.pre_token_patterns(path))
    texts = random_texts(2, 200)
    library = Tokenizer.from_file(path)
    assert [counter.count(t) for t in texts] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    monkeypatch.setattr(pieces, "CACHE_ENTRIES", 2)
    monkeypatch.setattr(pieces, "PAIR_ENTRIES", 2)
    own, model = pieces.PieceCodec(public_tokenizers.path("piece_bpe_32k.model")), sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert [own.convert(t)[1] for t in texts] == [",".join(map(str, model.encode(t))) for t in texts]


def test_pieces_equal_the_library(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model, own = sentencepiece.SentencePieceProcessor(model_file=path), pieces.codec(path)
    for text in random_texts(3, 3000):
        ids = model.encode(text)
        assert own.convert(text) == (len(ids), ",".join(map(str, ids)), model.decode(ids)), ascii(text)
    rows = odd(spark).select("doc_id", "text").union(documents(spark).select("doc_id", "text")).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in rows:
        ids = model.encode(r.text or "")
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids))))
    got = [tuple(r) for r in pieces.digest(odd(spark).select("doc_id", "text").union(documents(spark).select("doc_id", "text")), path).collect()]
    assert Counter(got) == Counter(want)
    whole = pieces.encode(odd(spark), path).collect()
    assert {(r.doc_id, tuple(r.ids)) for r in whole} == {(i, tuple(model.encode(t or ""))) for i, t in ODD}
    assert pieces.digest(empty(spark), path).count() == 0


# ---- SimHash ----------------------------------------------------------------------------------------

def plain_fingerprint(text):
    words = (text or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))).split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) > len(shingles))


def plain_components(prints, distance=3):
    """id -> smallest id by links, over pairs of all."""
    values = sorted(set(prints.values()))
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    array = np.array(values, np.uint64)
    for i, v in enumerate(values):
        for w in array[i + 1:][np.bitwise_count(array[i + 1:] ^ np.uint64(v)) <= distance]:
            parent[find(int(w))] = find(v)
    least = defaultdict(lambda: 1 << 62)
    for key, v in prints.items():
        least[find(v)] = min(least[find(v)], key)
    return {key: least[find(v)] for key, v in prints.items()}


def test_groups_equal_brute_force(spark):
    rows = {r.doc_id: r.text for r in documents(spark).collect()} | {10_000 + i: t for i, t in ODD if i is not None}
    prints = {k: plain_fingerprint(t) for k, t in rows.items()}
    want = plain_components(prints)
    got = simhash.groups(spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {k: (f"{prints[k]:016x}", want[k]) for k in rows}
    assert simhash.groups(empty(spark)).count() == 0
    assert simhash.groups(odd(spark)).count() == len(ODD)


@pytest.mark.parametrize("free", [8, 14, 30])
def test_links_of_a_dense_cluster_are_whole(spark, monkeypatch, free):
    monkeypatch.setattr(simhash, "DENSE", 16)
    rng = np.random.default_rng(free)
    places = rng.choice(64, free, replace=False)
    base = int(rng.integers(0, 1 << 63))
    values = {base ^ sum(1 << int(p) for p in rng.choice(places, rng.integers(0, 5), replace=False)) for _ in range(300)}
    values |= {int(v) for v in rng.integers(0, 1 << 63, 200)}
    array = np.array(sorted(values), np.uint64)
    near = np.bitwise_count(array[:, None] ^ array[None, :]) <= 3
    want = {(min(a, b), max(a, b)) for i, j in zip(*np.nonzero(near), strict=True) if i < j for a, b in [(array[i].astype(np.int64).item(), array[j].astype(np.int64).item())]}
    got = simhash.links(spark.createDataFrame([(int(v),) for v in array.astype(np.int64)], "fp long")).collect()
    assert sorted((r.a, r.b) for r in got) == sorted(want)


def test_groups_are_named_by_their_smallest_id(spark):
    docs = spark.createDataFrame([(3, "a b c d e f", 1), (1, "A B c d e f", 2), (2, "quite another text here", 3), (None, None, 4), (1, "A B c d e f", 5)], "doc_id long, text string, fp int")
    assert sorted(((r.doc_id, r.component_id) for r in simhash.groups(docs).collect()), key=str) == [(1, 1), (1, 1), (2, 2), (3, 1), (None, None)]


# ---- quality ----------------------------------------------------------------------------------------

def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if seen[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    full = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(full) - len(set(full)), len(covered)


def test_measures_and_base_rule(spark):
    extra = [(20, "a b c d e f g h " * 5), (21, "x " * 30), (22, "q\nq\n q\nq\n\n")]
    docs = documents(spark).select("doc_id", "text", "lang", "source").union(spark.createDataFrame([(i or 99, t, None, None) for i, t in ODD + extra], "doc_id long, text string, lang string, source string"))
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.judge(docs).collect())
    want = Counter()
    for r in docs.collect():
        m = plain_measures(r.text)
        want[(r.doc_id, *m, m[0] < 20 or 100 * m[4] > 30 * m[0])] += 1
    assert got == want


def test_fences_follow_their_group(spark):
    clean, noisy = "word another thing here and so on until there are enough of them to pass the rule of twenty words today", "word ### and $$$ then %%% more &&& of *** these ||| so <<< that >>> it # has $ twenty words and then some more"
    rows = [(i, f"{clean} {i}", "en", "a") for i in range(300)] + [(300, noisy, "en", "a")] + [(1000 + i, f"{noisy} {i}", "en", "b") for i in range(300)] + [(2000, noisy, None, None), (2001, f"{clean} x", None, "c")]
    kept = {r.doc_id for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).where("kept").collect()}
    assert set(range(300)) <= kept and 300 not in kept and set(range(1000, 1300)) <= kept and 2001 in kept


def test_quality_of_nothing(spark):
    assert quality.judge(empty(spark)).count() == 0
    docs = spark.createDataFrame([(1, None, None, None, 5)], "doc_id long, text string, lang string, source string, kept int")
    assert quality.keep_good(docs).count() == 0


def test_a_bucket_keeps_its_order_and_is_near(spark):
    got = spark.range(0, 5000).select("id", quality.bucket(F.col("id")).alias("b")).collect()
    assert all(0 <= r.id - r.b <= max(0, r.id / 32) for r in got) and all(a.b <= b.b for a, b in zip(got, got[1:], strict=False))


# ---- lines ------------------------------------------------------------------------------------------

def plain_chunk(chunk):
    return *chunk[:2], tuple(chunk[2])


def plain_lines(rows):
    """Lines kept of each (id, text): later occurrences of repeated chunks go."""
    order = sorted(rows, key=lambda r: lines.NO_ID if r[0] is None else r[0])
    times, least = Counter(), {}
    for key, text in order:
        for _, _, part in map(plain_chunk, lines.chunked(text)):
            times[part] += 1
            least.setdefault(part, lines.NO_ID if key is None else key)
    out = []
    for key, text in rows:
        if text is None:
            out.append((key, 0, 0, None))
            continue
        all_lines, gone, seen = text.split("\n"), set(), set()
        for first, n, part in map(plain_chunk, lines.chunked(text)):
            if times[part] > 1 and ((lines.NO_ID if key is None else key) > least[part] or part in seen):
                gone |= set(range(first, first + n))
            seen.add(part)
        kept = "\n".join(line for i, line in enumerate(all_lines) if i not in gone)
        out.append((key, len(all_lines), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_line_report_equals_plain_version(spark):
    passage = "\n".join(f"line {i} of a passage that many share" for i in range(9))
    more = [(50_000 + i, f"start {i}\n{passage}\nend {i}") for i in range(20)] + [(60_000, f"{passage}\n{passage}"), (60_001, "\n\n\n"), (None, passage), (None, "x\ny")] + [(k, t) for k, t in ODD if k]
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()] + more
    got = [tuple(r) for r in lines.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert Counter(got) == Counter(plain_lines(rows))
    assert sum(r[2] for r in got) > 100
    assert lines.report(empty(spark)).count() == 0


def test_an_inserted_line_moves_only_chunks_over_it():
    text = [f"line number {i}" for i in range(200)]
    before = {tuple(key) for _, _, key in lines.chunked("\n".join(text))}
    after = {tuple(key) for _, _, key in lines.chunked("\n".join(text[:90] + ["something new"] + text[90:]))}
    over = {tuple(key) for a, n, key in lines.chunked("\n".join(text)) if a < 90 < a + n}
    assert before - after == over and len(before) > 200


def test_line_hashes_are_those_of_sql(spark):
    texts = [t for _, t in ODD if t]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t").alias("h")).collect()
    assert [r.h for r in got] == [lines.line_hash(t) for t in texts]


def test_lines_that_share_a_hash_stay(spark, monkeypatch):
    monkeypatch.setattr(lines, "_shared_hashes", lambda placed: placed.sparkSession.createDataFrame([(lines.line_hash("b"),)], "h long") if not calls else placed.sparkSession.createDataFrame([], "h long"))
    calls = []
    was = lines.durable
    monkeypatch.setattr(lines, "durable", lambda df, label: (calls.append(1) if label == "line-collisions" else None, was(df, label))[1])
    text = "\n".join(f"{c} line" if c != "b" else "b" for c in "abcdefgh")
    got = {r.doc_id: r.text for r in lines.remove(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string"), seeds=20).collect()}
    assert got[1] == text and "b" in got[2].split("\n") and "d line" not in got[2]


def test_remove_keeps_columns_and_drops_emptied_rows(spark):
    text = "\n".join(f"one line {i}" for i in range(12))
    docs = spark.createDataFrame([(1, text, 7, "a"), (2, text, 8, "b"), (3, None, 9, "c"), (4, "", 1, "d")], "doc_id long, text string, row int, id string")
    assert sorted(tuple(r) for r in lines.remove(docs).collect()) == sorted([(1, text, 7, "a"), (3, None, 9, "c"), (4, "", 1, "d")], key=lambda r: r[0])


# ---- toxicity ---------------------------------------------------------------------------------------

def test_held_out_accuracy_and_planted_sentences(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [(got[r.doc_id].score, r.toxic) for r in labels.collect() if got[r.doc_id].held_out]
    right = np.mean([(s >= 0.5) == y for s, y in held])
    assert right > 0.93 and len(got) == docs.count()
    planted = spark.createDataFrame([(1, "A fine day. You stupid worthless idiot moron. Good night."), (2, "A fine day. Good night."), (3, None), (4, "")], "doc_id long, text string")
    told = {r.doc_id: r for r in toxicity.score(planted, model).collect()}
    assert [told[i].predicted for i in (1, 2, 3, 4)] == [1, 0, 0, 0] and told[3].score == 0 and told[3].worst_begin is None
    assert "idiot" in "A fine day. You stupid worthless idiot moron. Good night."[told[1].worst_begin:told[1].worst_end]
    assert {r.doc_id: len(r.sentences) for r in toxicity.offending(planted, model).collect()}[1] == 1
    assert sorted(r.doc_id for r in toxicity.keep_clean(planted, model).collect()) == [2, 3, 4]


def test_the_sample_is_bounded_in_rows_and_bytes(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, labels: seen.append(list(zip(texts, labels, strict=True))) or (0.0, {}))
    docs = spark.createDataFrame([(i, f"{i:03d}" + "x" * 97) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    toxicity.fit(docs, labels)
    toxicity.fit(docs, labels, sample=20)
    toxicity.fit(docs, labels, sample_bytes=1050)
    toxicity.fit(docs, labels, sample_bytes=1)
    sizes = [Counter(y for _, y in rows) for rows in seen]
    assert sum(sizes[0].values()) > 140 and sizes[1] == {0: 20, 1: 20} and sizes[2] == {0: 10, 1: 10} and sizes[3] == {0: 1, 1: 1}
    assert set(seen[3]) <= set(seen[2]) <= set(seen[1]) <= set(seen[0])


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(odd(spark), none)
    assert {r.score for r in toxicity.score(odd(spark), model).collect()} == {0.0}
    assert toxicity.score(empty(spark), model).count() == 0


# ---- mixing -----------------------------------------------------------------------------------------

def plain_targets(sizes):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode("utf-32-be")) + [None] * (None in sizes)
    weight = {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}
    budget, full = 1.5 * sum(sizes.values()), set()
    while True:
        open_ = sum(weight[n] for n in names if n not in full)
        level = (budget - sum(2 * sizes[n] for n in full)) / open_ if open_ else 0
        new = {n for n in names if n not in full and weight[n] * level >= 2 * sizes[n]}
        if not new:
            return {n: 2 * sizes[n] if n in full else weight[n] * level for n in names}
        full |= new


def test_targets_equal_plain_version(spark):
    rnd = random.Random(4)
    for n in (1, 2, 7, 40):
        sizes = {f"s{i}": rnd.choice([0, 1, 10, 1000, 50_000]) for i in range(n)} | {None: 77}
        got = {r["_source"]: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "_source string, size long")).collect()}
        assert got == pytest.approx(plain_targets(sizes))


def test_mix_emits_what_the_plan_takes(spark):
    docs = documents(spark).withColumns({"copy": F.lit(1), "_of": F.lit("x"), "row": F.lit(2)})
    planned = {r.doc_id: r.copies for r in mixing.plan(docs).collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    counted = Counter(r.doc_id for r in mixed.collect())
    assert {k: counted.get(k, 0) for k in planned} == planned
    assert mixing.plan(empty(spark)).count() == 0 and mixing.mix(empty(spark)).count() == 0
    assert all(0 <= v <= 2 for v in planned.values())


def test_taken_words_come_near_their_targets(spark):
    rows = mixing.plan(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert all(abs(r.taken / r.target - 1) < 0.01 for r in rows)


def test_sources_with_few_unequal_documents_come_as_near_as_a_turn_allows(spark):
    rnd = random.Random(6)
    rows = [(i, rnd.choice([f"s{i % 7}", "s0", None]), "w " * int(rnd.paretovariate(1.1) * 10)) for i in range(900)] + [(None, "s1", "w"), (5000, "none", None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    planned = mixing.plan(docs).collect()
    source_of = {r[0]: r[1] for r in rows}
    taken, target = Counter(), {}
    for r in planned:
        assert r.copies in (int(r.target / max(r.source_size, 1)), int(r.target / max(r.source_size, 1)) + 1) and r.taken <= 2 * r.size
        taken[source_of[r.doc_id]] += r.taken
        target[source_of[r.doc_id]] = r.target
    for name, goal in target.items():
        of = [r for r in planned if source_of[r.doc_id] == name]
        rate = goal / max(of[0].source_size, 1)
        draws = [int(hashlib.md5(f"42:{r.doc_id if r.doc_id is not None else 'null'}".encode()).hexdigest()[:12], 16) for r in of]
        sums = [sum(r.size * (int(rate) + ((u + (k << 42)) % (1 << 48) < (rate % 1) * 2**48)) for r, u in zip(of, draws, strict=True)) for k in range(64)]
        assert abs(taken[name] - goal) == pytest.approx(min(abs(s - goal) for s in sums))
    assert mixing.plan(docs).exceptAll(mixing.plan(docs.repartition(5))).isEmpty()


@pytest.mark.parametrize("name", ["op3_preference_format", "op9_source_mixing"])
def test_queries_equal_their_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "conversations"):
        duck.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    got = llm.QUERIES[name](spark, SF).toPandas()
    want = duck.execute(llm.ORACLES[name]).df()[list(got.columns)]
    key = list(got.columns)[:1]
    got, want = (x.sort_values(key).reset_index(drop=True) for x in (got, want))
    assert got.astype(object).values.tolist() == want.astype(object).values.tolist()
