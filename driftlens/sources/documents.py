"""Extraction documents and store tables: nested JSON in, flat tables out, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXTRACTION = (
    "extractor string, pdb_key string, "
    "types map<string,struct<size:bigint,members:array<struct<offset:bigint,name:string,size:bigint,bit_position:int,bit_count:int,type:string,union_group:int>>>>, "
    "enums map<string,struct<size:bigint,constants:array<struct<name:string,value:bigint>>>>, rvas map<string,bigint>, "
    "missing_types array<string>, missing_symbols array<string>, missing_enums array<string>")


def read_extractions(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One document per file, or per line; absent parts stay null and flatten to nothing. Malformed ones fail the job."""
    return spark.read.schema(EXTRACTION).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)


def parse_extractions(texts: DataFrame, column: str = "value") -> DataFrame:
    """Documents held as text; one that is malformed fails the job instead of reading as an empty one."""
    return texts.select(F.from_json(column, EXTRACTION, {"mode": "FAILFAST"}).alias("_d")).select("_d.*")


def types_of(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("pdb_key").alias("layout"), F.explode("types").alias("type_name", "_t")).select(
        "layout", "type_name", F.col("_t.size").alias("type_size"))


def members_of(documents: DataFrame) -> DataFrame:
    return (documents.select(F.col("pdb_key").alias("layout"), F.explode("types").alias("type_name", "_t"))
            .select("layout", "type_name", F.explode("_t.members").alias("_m"))
            .select("layout", "type_name", F.col("_m.name").alias("member"), F.col("_m.offset").alias("off"), F.col("_m.size").alias("sz"),
                    F.coalesce("_m.bit_position", F.lit(0)).alias("bit_position"), F.coalesce("_m.bit_count", F.lit(0)).alias("bit_count"),
                    F.coalesce("_m.type", F.lit("")).alias("mtype"), F.coalesce("_m.union_group", F.lit(0)).alias("union_group")))


def constants_of(documents: DataFrame) -> DataFrame:
    return (documents.select(F.col("pdb_key").alias("layout"), F.explode("enums").alias("enum_name", "_e"))
            .select("layout", "enum_name", F.col("_e.size").alias("enum_size"), F.explode("_e.constants").alias("_c"))
            .select("layout", "enum_name", "enum_size", F.col("_c.name").alias("name"), F.col("_c.value").alias("value")))


def symbols_of(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("pdb_key").alias("build"), F.explode("rvas").alias("name", "rva"))


def missing_of(documents: DataFrame) -> DataFrame:
    """(layout, kind, name) of everything asked for and not found."""
    parts = [documents.select(F.col("pdb_key").alias("layout"), F.lit(kind).alias("kind"), F.explode(f"missing_{kind}s").alias("name"))
             for kind in ("type", "symbol", "enum")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def to_extractions(members: DataFrame, types: DataFrame, extractor: str, constants: DataFrame | None = None, symbols: DataFrame | None = None,
                   missing: DataFrame | None = None) -> DataFrame:
    """Documents in canonical order, one per layout: types, enums and addresses by name, members and constants sorted.

    ``symbols`` is (layout, name, rva) and ``missing`` (layout, kind, name). A document holds its whole layout, as the
    format demands; analysis reads the flat tables instead.
    """
    group = F.col("union_group") if "union_group" in members.columns else F.lit(0)
    ordered = F.sort_array(F.collect_list(F.struct(
        F.col("off").cast("bigint").alias("offset"), F.col("member").alias("name"), F.col("sz").cast("bigint").alias("size"),
        F.col("bit_position").cast("int").alias("bit_position"), F.col("bit_count").cast("int").alias("bit_count"), F.col("mtype").alias("type"),
        group.cast("int").alias("union_group"))))
    bodies = members.groupBy("layout", "type_name").agg(ordered.alias("members"))
    full = types.join(bodies, ["layout", "type_name"], "left")
    per_layout = full.groupBy("layout").agg(F.sort_array(F.collect_list(F.struct(
        F.col("type_name").alias("key"), F.struct(F.col("type_size").cast("bigint").alias("size"), F.coalesce("members", F.array()).alias("members")).alias("value")))).alias("_t"))
    columns = [F.lit(extractor).alias("extractor"), F.col("layout").cast("string").alias("pdb_key"), F.map_from_entries("_t").alias("types")]

    def with_map(rows: DataFrame, key: str, value, name: str, kind: str):
        entries = rows.groupBy("layout").agg(F.sort_array(F.collect_list(F.struct(F.col(key).alias("key"), value.alias("value")))).alias(f"_{name}"))
        columns.append(F.map_from_entries(F.coalesce(f"_{name}", F.array().cast(f"array<struct<key:string,value:{kind}>>"))).alias(name))
        return per_layout.join(entries, "layout", "left")

    if constants is not None:
        listed = constants.groupBy("layout", "enum_name").agg(F.max("enum_size").cast("bigint").alias("_s"), F.sort_array(F.collect_list(
            F.struct(F.col("value").cast("bigint").alias("value"), "name"))).alias("_c"))
        shaped = F.transform("_c", lambda c: F.struct(c["name"].alias("name"), c["value"].alias("value")))
        per_layout = with_map(listed, "enum_name", F.struct(F.col("_s").alias("size"), shaped.alias("constants")), "enums",
                              "struct<size:bigint,constants:array<struct<name:string,value:bigint>>>")
    if symbols is not None:
        per_layout = with_map(symbols, "name", F.col("rva").cast("bigint"), "rvas", "bigint")
    if missing is not None:
        for kind in ("type", "symbol", "enum"):
            names = missing.filter(F.col("kind") == kind).groupBy("layout").agg(F.sort_array(F.collect_set("name")).alias(f"missing_{kind}s"))
            per_layout = per_layout.join(names, "layout", "left")
            columns.append(F.coalesce(f"missing_{kind}s", F.array().cast("array<string>")).alias(f"missing_{kind}s"))
    return per_layout.select(*columns)


def write_extractions(documents: DataFrame, path: str) -> None:
    documents.write.mode("overwrite").json(path)


# ---- store tables -------------------------------------------------------------------------------------

ADDRESSED = ("build", "layout", "type", "symbols")


def read_table(spark: SparkSession, base: str, name: str, data_base: str = "") -> DataFrame:
    """A published table: addressed data may live below another root than the indexes."""
    root = data_base if data_base and name in ADDRESSED else base
    return spark.read.parquet(f"{root.rstrip('/')}/{name}")


def read_layout(manifest: DataFrame, blobs: DataFrame, types_only: bool = False) -> DataFrame:
    """Reassemble layouts from manifest rows and bodies; ``types_only`` prunes enums before the join."""
    rows = manifest.filter(F.col("kind") == "type") if types_only else manifest
    return rows.select("layout", "kind", "name", "blob").join(blobs.drop("kind", "name"), "blob")


def with_list(builds: DataFrame, column: str) -> DataFrame:
    """Older rows hold one string where a list is meant."""
    if builds.schema[column].dataType.typeName() == "array":
        return builds
    return builds.withColumn(column, F.array_compact(F.array(column)))
