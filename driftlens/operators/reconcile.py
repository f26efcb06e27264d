"""Two independent readings of the same data: every disagreement becomes a finding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlens.functions.text import hex_lower
from driftlens.operators.compare import both_set_and_differ, differs, two_sided
from driftlens.operators.diffing import MEMBER, bits, last_of_name
from driftlens.operators.ordering import top_per_group

SIDES = ("_want", "_got")
TYPE = ["layout", "type_name"]


def _finding(when: Column, severity: str, rule: str, message: Column) -> Column:
    return F.when(when, F.struct(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), message.alias("message")))


def _emit(df: DataFrame, entity: str, findings: list[Column]) -> DataFrame:
    return df.select("layout", F.col(entity).alias("entity"), F.explode(F.array_compact(F.array(*findings))).alias("_f")).select(
        "layout", "entity", "_f.severity", "_f.rule", "_f.message")


def _text(*parts) -> Column:
    return F.concat(*[F.lit(part) if isinstance(part, str) else part.cast("string") for part in parts])


def sizes(members: DataFrame) -> DataFrame:
    """(layout, type_name, type_size, n_members) where sizes are not declared."""
    return members.groupBy(*TYPE).agg(F.max(F.col("off") + F.col("sz")).alias("type_size"), F.count("*").alias("n_members"))


def declared_sizes(types: DataFrame, members: DataFrame) -> DataFrame:
    """(layout, type_name, type_size, n_members) of declared types, those without members too."""
    counts = members.groupBy(*TYPE).agg(F.count("*").alias("n_members"))
    return types.select(*TYPE, "type_size").join(counts, TYPE, "left").fillna(0, ["n_members"])


def _shared(oracle: DataFrame, subject: DataFrame, key: list[str]) -> DataFrame:
    return oracle.select(*key).distinct().join(subject.select(*key).distinct(), key)


def compared_names(oracle: DataFrame, subject: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """(layout, type_name) to examine: the union of both readings, or only requested names."""
    names = oracle.select(*TYPE).unionByName(subject.select(*TYPE)).distinct()
    if requested is None:
        return names
    return names.join(requested.select(F.col("name").alias("type_name")).distinct(), "type_name", "left_semi")


def type_sides(oracle: DataFrame, subject: DataFrame) -> DataFrame:
    return two_sided(oracle, subject, TYPE, ["type_size", "n_members"], SIDES)


def type_findings(sides: DataFrame) -> DataFrame:
    both = F.col("in_left") & F.col("in_right")
    return _emit(sides, "type_name", [
        _finding(~F.col("in_left"), "fatal", "invented", _text("type absent from oracle (subject has ", F.col("n_members_got"), " members)")),
        _finding(~F.col("in_right"), "fatal", "absent", F.lit("absent from subject output")),
        _finding(both & differs("type_size", SIDES), "fatal", "size",
                 _text("size ", hex_lower(F.col("type_size_got")), " != oracle ", hex_lower(F.col("type_size_want"))))])


def member_sides(oracle: DataFrame, subject: DataFrame, oracle_types: DataFrame | None = None, subject_types: DataFrame | None = None) -> DataFrame:
    """Members of types that both readings declare, so a type that lost all its members on one side counts.

    Where a reading states no types, those of its members stand for them.
    """
    shared = _shared(oracle if oracle_types is None else oracle_types, subject if subject_types is None else subject_types, TYPE)
    keys = [*TYPE, "member"]
    want = last_of_name(oracle.join(shared, TYPE, "left_semi"), keys, MEMBER)
    return two_sided(want, last_of_name(subject.join(shared, TYPE, "left_semi"), keys, MEMBER), keys, MEMBER, SIDES)


def member_findings(oracle: DataFrame, subject: DataFrame, oracle_types: DataFrame | None = None, subject_types: DataFrame | None = None) -> DataFrame:
    return classify_members(member_sides(oracle, subject, oracle_types, subject_types))


def classify_members(sides: DataFrame) -> DataFrame:
    """One row can yield several findings. A differing size alone is a warning."""
    both, m = F.col("in_left") & F.col("in_right"), F.col("member")
    pair = differs("bit_position", SIDES) | differs("bit_count", SIDES)
    return _emit(sides, "type_name", [
        _finding(~F.col("in_right"), "fatal", "missing", _text("member '", m, "' missing (oracle: offset ", hex_lower(F.col("off_want")), ")")),
        _finding(~F.col("in_left"), "fatal", "invented", _text("member '", m, "' invented (offset ", hex_lower(F.col("off_got")), ")")),
        _finding(both & differs("off", SIDES), "fatal", "offset",
                 _text(m, ": offset ", hex_lower(F.col("off_got")), " != oracle ", hex_lower(F.col("off_want")))),
        _finding(both & both_set_and_differ("mtype", SIDES), "fatal", "type", _text(m, ": type '", F.col("mtype_got"), "' != oracle '", F.col("mtype_want"), "'")),
        _finding(both & pair, "fatal", "bits", _text(m, ": bits ", bits("_got"), " != oracle ", bits("_want"))),
        _finding(both & differs("sz", SIDES), "warning", "size", _text(m, ": size ", F.col("sz_got"), " != oracle ", F.col("sz_want")))])


ENUM = ["layout", "enum_name"]


def enums_of(constants: DataFrame) -> DataFrame:
    """(layout, enum_name, enum_size) where enums are not declared."""
    return constants.groupBy(*ENUM).agg(F.max("enum_size").alias("enum_size"))


def enum_sides(oracle_enums: DataFrame, subject_enums: DataFrame) -> DataFrame:
    return two_sided(oracle_enums, subject_enums, ENUM, ["enum_size"], SIDES)


def constant_sides(oracle: DataFrame, subject: DataFrame, oracle_enums: DataFrame | None = None, subject_enums: DataFrame | None = None) -> DataFrame:
    key = ENUM
    shared = _shared(oracle if oracle_enums is None else oracle_enums, subject if subject_enums is None else subject_enums, key)
    keys = [*key, "name"]
    want = last_of_name(oracle.join(shared, key, "left_semi"), keys, ["value"])
    return two_sided(want, last_of_name(subject.join(shared, key, "left_semi"), keys, ["value"]), keys, ["value"], SIDES)


def enum_findings(oracle: DataFrame, subject: DataFrame, oracle_enums: DataFrame | None = None, subject_enums: DataFrame | None = None) -> DataFrame:
    """Enums by the union of names, then the constants of enums that both readings declare."""
    want, got = (enums_of(rows) if enums is None else enums for rows, enums in ((oracle, oracle_enums), (subject, subject_enums)))
    both = F.col("in_left") & F.col("in_right")
    enums = _emit(enum_sides(want, got), "enum_name", [
        _finding(~F.col("in_left"), "fatal", "invented", F.lit("enum invented by subject")),
        _finding(~F.col("in_right"), "fatal", "absent", F.lit("enum absent from subject output")),
        _finding(both & differs("enum_size", SIDES), "fatal", "size", _text("enum size ", F.col("enum_size_got"), " != oracle ", F.col("enum_size_want")))])
    name = F.col("name")
    constants = _emit(constant_sides(oracle, subject, want, got), "enum_name", [
        _finding(~F.col("in_right"), "fatal", "constant_missing", _text("constant '", name, "' missing")),
        _finding(~F.col("in_left"), "fatal", "constant_invented", _text("constant '", name, "' invented")),
        _finding(both & differs("value", SIDES), "fatal", "value", _text(name, " = ", F.col("value_got"), " != oracle ", F.col("value_want")))])
    return enums.unionByName(constants)


def symbol_sides(oracle: DataFrame, subject: DataFrame) -> DataFrame:
    """Driven by the oracle's names; what only the subject found is not examined."""
    got = subject.select("build", "name", F.col("rva").alias("rva_got"))
    return oracle.select("build", "name", F.col("rva").alias("rva_want")).join(got, ["build", "name"], "left")


def symbol_findings(oracle: DataFrame, subject: DataFrame) -> DataFrame:
    gone = F.col("rva_got").isNull()
    return _emit(symbol_sides(oracle, subject).withColumnRenamed("build", "layout"), "name", [
        _finding(gone, "fatal", "symbol_missing", F.lit("symbol missing from subject output")),
        _finding(~gone & (F.col("rva_got") != F.col("rva_want")), "fatal", "rva",
                 _text("rva ", hex_lower(F.col("rva_got")), " != oracle ", hex_lower(F.col("rva_want"))))])


def counters(oracle: DataFrame, subject: DataFrame, oracle_constants: DataFrame, subject_constants: DataFrame,
             oracle_symbols: DataFrame, oracle_types: DataFrame | None = None, subject_types: DataFrame | None = None,
             oracle_enums: DataFrame | None = None, subject_enums: DataFrame | None = None) -> DataFrame:
    """How much was compared, one row per counter."""
    shared = F.col("in_left") & F.col("in_right")
    want, got = (sizes(rows) if types is None else declared_sizes(types, rows) for rows, types in ((oracle, oracle_types), (subject, subject_types)))
    types = type_sides(want, got).agg(F.count_if(shared).alias("n"))
    members = member_sides(oracle, subject, want, got).agg(
        F.count_if(shared).alias("members"),
        F.count_if(shared & ((F.col("bit_count_want") != 0) | (F.col("bit_count_got") != 0))).alias("bitfields"))
    want, got = (enums_of(rows) if enums is None else enums for rows, enums in ((oracle_constants, oracle_enums), (subject_constants, subject_enums)))
    enums = enum_sides(want, got).agg(F.count_if(shared).alias("n"))
    constants = constant_sides(oracle_constants, subject_constants, want, got).agg(F.count_if(shared).alias("n"))
    symbols = oracle_symbols.agg(F.count("*").alias("n"))

    def named(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("counter"), F.col("n").alias("checked"))

    unpivoted = members.unpivot([], ["members", "bitfields"], "counter", "checked")
    return (named(types, "types").unionByName(unpivoted).unionByName(named(enums, "enums"))
            .unionByName(named(constants, "constants")).unionByName(named(symbols, "symbols")))


def gate(findings: DataFrame, layouts: DataFrame) -> DataFrame:
    """PASS or FAIL with the number of fatal findings, for every layout examined."""
    fatal = findings.filter(F.col("severity") == "fatal").groupBy("layout").agg(F.count("*").alias("fatal"))
    return (layouts.select("layout").distinct().join(fatal, "layout", "left").fillna(0, ["fatal"])
            .withColumn("verdict", F.when(F.col("fatal") == 0, "PASS").otherwise("FAIL")))


def gate_report(findings: DataFrame, per_layout: int = 4, overall: int = 30) -> DataFrame:
    """The first few fatal findings of each layout, cut to an overall number for reading."""
    fatal = findings.filter(F.col("severity") == "fatal")
    return top_per_group(fatal, ["layout"], ["entity", "message", "rule"], per_layout).orderBy("layout", "nth").limit(overall)
