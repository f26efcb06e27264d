"""Hashing, dictionary encoding, verification and merges."""

import base64
import hashlib

from frames import rows
from pyspark.sql import functions as F
from test_diff import CONSTANT, MEMBER, m
from test_ordering import BUILD, build

from driftlens.functions.bitmap import BUCKET_BITS
from driftlens.operators import coverage, dictionary, hashing, merging, reconcile, resolve, verify

TYPE = "layout string, type_name string, type_size bigint"


def lines(spark):
    members = spark.createDataFrame([m("A", "b", 8), m("A", "a", 0, 4, (1, 2), "void *"), m("A", "z", 0, type_name="_S")], MEMBER)
    types = spark.createDataFrame([("A", "_T", 16), ("A", "_S", 8), ("A", "_EMPTY", 4)], TYPE)
    constants = spark.createDataFrame([("A", "E", "One", 1, 4), ("A", "E", "Minus", -1, 4)], CONSTANT)
    return hashing.type_lines(members, types).unionByName(hashing.enum_lines(constants))


TEXTS = {"_T": "T _T 16\nM 0 a 4 1 2 void *\nM 8 b 8 0 0 ", "_S": "T _S 8\nM 0 z 8 0 0 ", "_EMPTY": "T _EMPTY 4", "E": "E E 4\nC -1 Minus\nC 1 One"}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_canonical_hashes(spark):
    want = sorted((name, sha(text)[:12]) for name, text in TEXTS.items())
    assert rows(hashing.manifest(lines(spark)), "name", "blob") == want
    whole = "\n".join([TEXTS["_EMPTY"], TEXTS["_S"], TEXTS["_T"], TEXTS["E"]]) + "\n"
    assert rows(hashing.layout_hash(lines(spark)), "hash") == [(f"v2:sha256:{sha(whole)}",)]


def test_a_group_longer_than_a_batch_is_hashed_whole(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        lines_ = spark.range(50).select(F.when(F.col("id") < 45, "a").alias("key"), "id", F.concat(F.lit("line "), F.col("id")).alias("line"))
        got = {r.key: r.digest for r in hashing.digest_lines(lines_, ["key"], ["id"], True).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    text = lambda a, b: "".join(f"line {i}\n" for i in range(a, b))
    assert got == {"a": sha(text(0, 45)), None: sha(text(45, 50))}


def symbols(spark, pairs):
    return spark.createDataFrame([("k", name, rva) for name, rva in pairs], "build string, name string, rva bigint")


def test_bitmap_literal(spark):
    universe = spark.createDataFrame([(i, f"n{i}") for i in range(20)], "pos bigint, name string")
    placed = dictionary.placed(symbols(spark, [("n17", 4), ("n0", 1), ("n9", 3), ("n3", 2)]), universe)
    doc = dictionary.document(dictionary.bitmaps(placed), dictionary.ranked(placed), 20).head()
    assert (doc.symbols, doc.rva, doc.symbol_count, doc.universe_size) == ("CQIC", [1, 2, 3, 4], 4, 20)


def test_bitmap_over_several_buckets(spark):
    places = [0, 7, BUCKET_BITS - 1, 2 * BUCKET_BITS + 5, 2 * BUCKET_BITS + 6]
    universe = spark.createDataFrame([(p, f"n{p}") for p in places], "pos bigint, name string")
    given = [(f"n{p}", 100 + i) for i, p in enumerate(places)]
    placed = dictionary.placed(symbols(spark, given), universe)
    docs = dictionary.document(dictionary.bitmaps(placed), dictionary.ranked(placed), 1)
    want = bytearray(places[-1] // 8 + 1)
    for p in places:
        want[p // 8] |= 1 << (p % 8)
    assert base64.b64decode(docs.head().symbols) == bytes(want)
    back = dictionary.decode(dictionary.document_buckets(docs), dictionary.document_addresses(docs), universe)
    assert rows(back, "name", "rva") == sorted(given)


def test_name_unknown_to_an_older_dictionary_uses_up_its_address(spark):
    full = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "pos bigint, name string")
    placed = dictionary.placed(symbols(spark, [("a", 1), ("b", 2), ("c", 3)]), full)
    got = dictionary.decode(dictionary.bitmaps(placed), dictionary.ranked(placed), full.filter("name <> 'b'"))
    assert rows(got, "name", "rva") == [("a", 1), ("c", 3)]


def test_only_filled_chunks_move(spark):
    """One bit at the end of a bucket: neither the directory nor the document's exchange holds the empty chunks before it."""
    universe = spark.createDataFrame([(BUCKET_BITS - 1, "z")], "pos bigint, name string")
    placed = dictionary.placed(symbols(spark, [("z", 1)]), universe)
    buckets = dictionary.bitmaps(placed)
    directory = dictionary.directory(buckets)
    assert rows(directory, "chunk", "before") == [(63, 0)]
    plan = dictionary.document(buckets, dictionary.ranked(placed), 1)._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex(" in plan.split("Join Inner")[0] and "unhex(" not in plan.split("Join Inner", 1)[1]


def test_positions_move_and_bitmaps_do_not(spark):
    universe = spark.createDataFrame([(0, "z")], "pos bigint, name string")
    plan = dictionary.bitmaps(dictionary.placed(symbols(spark, [("z", 1)]), universe))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("bitmap_construct_agg") > 1 and "Exchange" not in plan[:plan.rindex("bitmap_construct_agg")]


def test_text_of_bits_at_all_distances(spark):
    """Chunks alone, side by side and far apart, at the edges of what base64 encodes together and of buckets."""
    groups = [[p] for p in (0, 1535, 1536, BUCKET_BITS - 1, BUCKET_BITS)]
    groups += [list(range(0, 5000, 3)), [511, 512, 1023, 1024, 1536, 9000], [1400, 3 * BUCKET_BITS + 700], list(range(BUCKET_BITS - 2000, BUCKET_BITS + 3000, 7))]
    given = [(f"b{at}", f"n{p}", p) for at, places in enumerate(groups) for p in places]
    universe = spark.createDataFrame(sorted({(p, name) for _, name, p in given}), "pos bigint, name string")
    placed = dictionary.placed(spark.createDataFrame(given, "build string, name string, rva bigint"), universe)
    docs = dictionary.document(dictionary.bitmaps(placed), dictionary.ranked(placed), 1)
    want = []
    for at, places in enumerate(groups):
        number = sum(1 << p for p in places)
        want.append((f"b{at}", base64.b64encode(number.to_bytes(places[-1] // 8 + 1, "little")).decode()))
    assert rows(docs, "build", "symbols") == sorted(want)
    back = dictionary.decode(dictionary.bitmaps(placed), dictionary.ranked(placed).select("build", "nth", "rva"), universe)
    assert rows(back, "build", "name", "rva") == sorted(given, key=str)


def test_dictionary_only_grows(spark):
    first = dictionary.extend(None, symbols(spark, [("x", 1), ("m", 1)]))
    grown = dictionary.extend(first, symbols(spark, [("a", 1), ("x", 1)]))
    assert rows(grown, "name", "pos") == [("a", 2), ("m", 0), ("x", 1)]


def verify_inputs(spark):
    row = "symbol_key string, kind string, name string, blob string, body string"
    published = spark.createDataFrame([("k", "type", "_T", "h1", "b1"), ("k", "type", "_S", "h2", "b2")], row)
    return published, spark.createDataFrame([("k", "type", "_T", "h1", "b1"), ("k", "type", "_S", "h2", "b2")], row)


def test_verify_clean_and_tampered(spark):
    published, ours = verify_inputs(spark)
    assert verify.name_problems(published, ours, "type").count() == 0
    entry = published.withColumn("blob", F.when(F.col("name") == "_S", "other").otherwise(F.col("blob")))
    assert rows(verify.name_problems(entry, ours, "type"), "problem") == [("_S: content hash h2 != manifest other",)]
    body = published.withColumn("body", F.when(F.col("name") == "_T", "moved").otherwise(F.col("body")))
    assert rows(verify.name_problems(body, ours, "type"), "problem") == [("_T: published body differs from its own hash",)]
    assert verify.name_problems(body, ours, "type", sample=0).count() == 0
    gone = published.filter("name = '_T'")
    assert rows(verify.name_problems(gone, ours, "type"), "problem") == [("_S: extracted but not published",)]


def test_verify_symbols_tampered(spark):
    ours = symbols(spark, [("a", 1), ("b", 2)])
    universe = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "pos bigint, name string")
    placed = dictionary.placed(ours, universe)
    buckets, addresses = dictionary.bitmaps(placed), dictionary.ranked(placed)

    def problems(b, a):
        return [r.problem for r in verify.symbol_problems(verify.symbol_sides(dictionary.decode(b, a, universe), ours)).collect()]

    assert problems(buckets, addresses) == []
    assert problems(buckets, addresses.withColumn("rva", F.when(F.col("name") == "a", 9).otherwise(F.col("rva")))) == ["a: RVA 0x9 published, 0x1 extracted"]
    # One bit moved from b to c.
    shifted = dictionary.bitmaps(dictionary.placed(symbols(spark, [("a", 1), ("c", 2)]), universe))
    assert sorted(problems(shifted, addresses)) == ["1 symbol(s) extracted but not published, e.g. ['b']", "1 symbol(s) published but not extracted, e.g. ['c']"]


def test_layout_gate_ends_the_check(spark):
    hashes = spark.createDataFrame([("k1", "h"), ("k2", "h")], "symbol_key string, hash string")
    gate = verify.layout_gate(hashes, spark.createDataFrame([("k1", "h"), ("k2", "x")], "symbol_key string, hash string"))
    assert rows(verify.gate_problems(gate), "symbol_key") == [("k2",)]
    assert rows(verify.only_passing(hashes, gate), "symbol_key") == [("k1",)]


def test_merge_keeps_what_the_new_run_lacks(spark):
    schema = "symbol_key string, sha256 array<string>, channel array<string>, kb array<string>, file_version string, release_date string, layout string"
    old = spark.createDataFrame([("k", ["s1"], ["b"], ["KB2"], None, "2024-01-01", "L1"), ("only", ["s9"], [], [], "1", "", "L9")], schema)
    new = spark.createDataFrame([("k", ["s2"], ["a"], ["KB1"], "10.0", "", "L2")], schema)
    got = {r.symbol_key: r for r in merging.upsert_builds(old, new).collect()}
    k = got["k"]
    assert (k.sha256, k.channel, k.kb, k.file_version, k.release_date, k.layout) == (["s1", "s2"], ["a", "b"], ["KB1", "KB2"], "10.0", "2024-01-01", "L2")
    assert got["only"].layout == "L9"


def test_ledger_last_reason_and_clearing(spark):
    old = spark.createDataFrame([("s1", "fetch_error"), ("s2", "pdb_404")], "sha256 string, reason string")
    run = spark.createDataFrame([("s1", "inconsistent", 1), ("s1", "binary_404", 2), ("s3", "pdb_404", 1)], "sha256 string, reason string, ord int")
    stored = spark.createDataFrame([("s2",)], "sha256 string")
    assert rows(merging.upsert_ledger(old, run, stored), "sha256", "reason") == [("s1", "binary_404"), ("s3", "pdb_404")]


def test_coverage_duplicates_are_neither_missing_nor_resolved(spark):
    builds = spark.createDataFrame([build("a", None, "")], BUILD)
    ledger = spark.createDataFrame([("s", "duplicate_key", ["c"]), ("t", "parse_failed", ["c"])], "sha256 string, reason string, channel array<string>")
    known = spark.createDataFrame([(2,)], "known bigint")
    got = coverage.totals(known, builds, ledger).head()
    assert (got.resolved, got.accounted_missing, got.duplicate_entries, got.unattempted, got.defects, got.no_version_metadata) == (1, 1, 1, 0, 1, 1)
    table = spark.createDataFrame([("c", 1), ("never", 7)], "channel string, known bigint")
    assert rows(coverage.by_channel(table, builds, ledger), "channel", "known", "resolved", "missing", "unattempted") == [("c", 1, 1, 1, 0), ("never", 7, 0, 0, 7)]


def test_first_terminal_outcome(spark):
    entries = spark.createDataFrame([("a", [1, 2]), ("b", [1, 2]), ("c", [1, 2])], "sha256 string, sizes array<bigint>")
    outcomes = spark.createDataFrame([("a", 1, "binary_404"), ("a", 2, "ok"), ("b", 1, "pe_parse_failed"), ("b", 2, "ok"), ("c", 1, "binary_404"), ("c", 2, "binary_404")],
                                     "sha256 string, size bigint, outcome string")
    assert rows(resolve.first_terminal(entries, outcomes), "sha256", "outcome", "size_of_image") == [("a", "ok", 2), ("b", "pe_parse_failed", None), ("c", "binary_404", None)]


def test_address_in_wide_and_overlapping_sections(spark):
    sections = spark.createDataFrame([("i", 0, 0, 100000, 10, 1000), ("i", 1, 50, 10, 10, 5000), ("i", 2, 200000, 0, 0, 0)],
                                     "image string, ord int, va bigint, vsize bigint, rawsize bigint, rawptr bigint")
    points = spark.createDataFrame([("i", 55), ("i", 99999), ("i", 100000), ("i", 200000)], "image string, rva bigint")
    assert rows(resolve.address_offsets(points, sections, 64), "rva", "offset") == [(55, 1055), (99999, 100999)]


def test_member_size_alone_is_a_warning(spark):
    a = spark.createDataFrame([m("A", "x", 0, 8), m("A", "y", 8)], MEMBER)
    b = spark.createDataFrame([m("A", "x", 0, 4), m("A", "z", 8)], MEMBER)
    found = reconcile.member_findings(a, b)
    assert rows(found, "severity", "rule") == [("fatal", "invented"), ("fatal", "missing"), ("warning", "size")]
