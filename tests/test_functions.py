"""Literal cases of the column helpers."""

import gzip
import json
import random

import pytest
from frames import rows
from pyspark.sql import functions as F

from driftlens.functions import names, primitives, text, version
from driftlens.sources import index


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).head()[0]


def test_version_key(spark):
    cases = {"10.0.26100.4652": [10, 0, 26100, 4652], "10.0": [10, 0, 0, 0], "10.0.x.5": [10, 0, 5, 0], "1.2.3.4.5": [1, 2, 3, 4], None: [0, 0, 0, 0], "": [0, 0, 0, 0],
             "1." + "0" * 60 + "7": [1, 7, 0, 0], "1." + "8" * 60: [1, 10**38 - 1, 0, 0]}
    df = spark.createDataFrame([(k,) for k in cases], "v string").select("v", version.version_key(F.col("v")).alias("k"))
    assert {row.v: row.k for row in df.collect()} == cases


def test_family(spark):
    cases = {"10.0.26100.1": "26100", "10.0": None, "10.0.x": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "v string").select("v", version.family(F.col("v")).alias("f"))
    assert {row.v: row.f for row in df.collect()} == cases


def test_filler_names(spark):
    filler = ["PrcbPad12", "PrcbPad12c", "SpareByte0", "MmReserved2", "Flags2Available1", "ReservedFlags"]
    fields = ["AvailableTime", "PadNumber"]
    df = spark.createDataFrame([(n,) for n in filler + fields], "n string").filter(names.is_filler(F.col("n")))
    assert sorted(r.n for r in df.collect()) == sorted(filler)


def test_rename_kind(spark):
    cases = {("BpbStateReserved", "BpbDivideOnReturn"): "repurposed", ("PrcbPad12", "PrcbPad12c"): "padding_shuffle", ("MitigationFlags", "MitigationFlags2"): "rename"}
    df = spark.createDataFrame(list(cases), "a string, b string").select("a", "b", names.rename_kind(F.col("a"), F.col("b")).alias("k"))
    assert {(r.a, r.b): r.k for r in df.collect()} == cases


def test_keys_show_age_in_hex_and_decimal(spark):
    guid = "0123abcd-4567-89ab-cdef-0123456789ab"
    assert one(spark, text.symbol_key(F.col("g"), F.col("a")), g=guid, a=10).endswith("ABA")
    assert one(spark, text.readable_key(F.col("g"), F.col("a")), g=guid, a=10).endswith("AB-10")
    assert bytes(one(spark, text.guid_bytes(F.col("g")), g=guid)).hex() == "cdab23016745ab89cdef0123456789ab"


def test_labels_and_summary(spark):
    assert one(spark, text.build_label(F.col("v"), F.array(F.lit("KB1"), F.lit("KB2")), F.col("k")), v="", k="abc") == "KB1/KB2"
    assert one(spark, text.build_label(F.lit(None), F.array().cast("array<string>"), F.lit(None))) == "unknown"
    five = F.array(*[F.lit(c) for c in "abcde"])
    assert one(spark, text.summarise(five, F.lit(6))) == "a, b, c, d, and 2 more"
    assert one(spark, text.summarise(F.array().cast("array<string>"), F.lit(0))) == text.NO_VISIBLE_DIFFERENCE
    assert one(spark, text.xml_escape(F.lit("a<b>&amp;"))) == "a&lt;b&gt;&amp;amp;"
    assert one(spark, text.machine_name(F.lit(0x1C2))) == "0x01C2"


def test_primitives(spark):
    assert one(spark, primitives.primitive_size(F.lit("Void"), F.lit("Near64"))) == 8
    assert one(spark, primitives.primitive_size(F.lit("nonsense"), F.lit(None).cast("string"))) == 0
    assert one(spark, primitives.primitive_name(F.lit("ULong"), F.lit("Near32"))) == "unsigned long *"
    assert one(spark, primitives.basic_name(F.lit("int"), F.lit(8))) == "__int64"
    assert one(spark, primitives.basic_name(F.lit("int"), F.lit(3))) == ""
    leaf = lambda kind, raw: one(spark, primitives.constant_value(F.lit(kind), F.lit(raw).cast("decimal(20,0)")))
    assert leaf("U8", "255") == -1
    assert leaf("U16", "255") == 255
    assert leaf("U64", "18446744073709551615") == -1


def test_size_candidates(spark):
    text_rows = [('{"a":{"fileInfo":{"timestamp":1,"size":21504,"lastSectionVirtualAddress":4096,"lastSectionPointerToRawData":1024}},'
                  '"b":{"fileInfo":{"timestamp":1,"virtualSize":7}},"c":{"fileInfo":{"timestamp":1}},"d":{"fileInfo":{"virtualSize":7}}}',)]
    entries = index.parse_index(spark.createDataFrame(text_rows, "value string"))
    got = {r.sha256: r.s for r in entries.select("sha256", index.size_candidates().alias("s")).collect()}
    assert got == {"a": [0x4000, 0x3000], "b": [7], "c": [], "d": [7]}
    assert rows(index.downloadable(entries), "sha256") == [("a",), ("b",)]
    assert rows(index.undownloadable(entries), "sha256") == [("c",), ("d",)]


def test_read_gzipped_index(spark, tmp_path):
    import gzip
    import json

    entry = {"fileInfo": {"timestamp": 5, "virtualSize": 9, "machineType": 0x8664, "version": "10.0.1.2 (x)"},
             "windowsVersions": {"11-24H2": {"KB2": {"updateInfo": {"releaseDate": "2024-02-02"}}, "KB1": {"updateInfo": {"releaseDate": ""}}, "BASE": {"updateInfo": {"releaseDate": "2000-01-01"}}}}}
    (tmp_path / "i.json.gz").write_bytes(gzip.compress(json.dumps({"s1": entry}, indent=1).encode()))
    got = index.with_derived(index.candidates(index.read_index(spark, str(tmp_path)))).head()
    assert (got.sha256, got.version, got.machine, got.kb, got.release_date) == ("s1", "10.0.1.2", "amd64", ["KB1", "KB2"], "2024-02-02")


def cut(text):
    """Entries of a text as the reader meets it: at its closing braces."""
    reader, found = index.Entries("t"), []
    *pieces, rest = text.split("}")
    for piece in pieces + ([rest] if rest else []):
        got = reader.feed(piece)
        if got:
            found.append((got[0], json.loads(got[1])))
    reader.end()
    return found


def test_entries_are_cut_at_braces_outside_of_strings():
    rnd = random.Random(8)
    texts = ["", "}", "{", '"', "\\", '\\"', "a}b", "{}", ",", "\\}", "ö\n"]
    value = lambda depth: {rnd.choice(texts) + str(i): rnd.choice([1, None, rnd.choice(texts), [rnd.choice(texts), {}]]) if depth == 0 else value(depth - 1) for i in range(rnd.randint(0, 3))}
    for _ in range(500):
        objects = [{rnd.choice(texts) + str(i): value(rnd.randint(0, 2)) for i in range(rnd.randint(0, 4))} for _ in range(rnd.randint(0, 3))]
        text = rnd.choice(["", "\n", " "]).join(json.dumps(o, ensure_ascii=rnd.random() < 0.5, indent=rnd.choice([None, 1])) for o in objects) + rnd.choice(["", "\n"])
        assert cut(text) == [entry for o in objects for entry in o.items()]


@pytest.mark.parametrize("text", ['{"a": {"x": 1}', '{"a": {"x": 1', '{"a": {"x": 1},', '{"a": {"x": 1}, }', '[{"a": 1}]', '{"a": {}; "b": {}}', '{"a" {}}', '{"a": {"x": "}', '{, "a": {}}', '{"a": {}, "b": 1}'])
def test_what_is_no_object_of_objects_is_refused(text):
    with pytest.raises(ValueError):
        cut(text)


def test_an_index_is_read_entry_by_entry(spark, tmp_path):
    name = '1 }{ \\" '
    entry = {"fileInfo": {"timestamp": 5, "version": name}, "windowsVersions": {"c": {"KB1": {"updateInfo": {"releaseDate": "2024"}}}}}
    for n in range(3):
        with gzip.open(f"{tmp_path}/{n}.json.gz", "wt") as out:
            json.dump({f"{n}-{i}": entry for i in range(3000)}, out)
    read = index.read_index(spark, str(tmp_path))
    assert read.count() == 9000 and read.select("sha256").distinct().count() == 9000
    assert read.filter((F.col("entry.fileInfo.version") == name) & (F.map_keys("entry.windowsVersions")[0] == "c")).count() == 9000
    with gzip.open(f"{tmp_path}/cut.json.gz", "wt") as out:
        out.write(json.dumps({f"x{i}": entry for i in range(5)})[:-40])
    with pytest.raises(Exception, match="ends within an object"):
        index.read_index(spark, str(tmp_path)).count()
