"""Record tables with references: canonical records, flattening, sizes, declared types, continuations.

References are followed level by level with joins. Each level is written once, so the plan stays short and
a lost executor costs one level; the loops end when no row is left. Every row carries what it has passed, so a cycle is
recognised where it closes, at any depth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlens.functions.names import is_transparent_member
from driftlens.functions.primitives import primitive_name, primitive_size
from driftlens.operators.ordering import positions_within
from driftlens.runtime import durable


def canonical_records(records: DataFrame, group: tuple[str, ...] = ("kind_group", "name"), index: str = "idx") -> DataFrame:
    """One record per name: the last definition, or the first forward reference if there is no definition."""
    return records.groupBy(*group).agg(F.coalesce(F.max(F.when(~F.col("is_forward"), F.col(index))), F.min(index)).alias(index))


def largest_records(records: DataFrame, group: tuple[str, ...] = ("name",), index: str = "idx") -> DataFrame:
    """The alternative choice: the largest size, the first on ties."""
    return records.groupBy(*group).agg(F.min_by(index, F.struct(-F.col("size"), F.col(index))).alias(index))


def resolve_lists(records: DataFrame) -> DataFrame:
    """Field list of each record, taken from its definition where the record is only a forward reference."""
    chosen = canonical_records(records).select("kind_group", "name", F.col("idx").alias("_definition"))
    lists = records.select(F.col("idx").alias("_definition"), F.col("list_id").alias("_list"))
    return (records.join(chosen, ["kind_group", "name"], "left").join(lists, "_definition", "left")
            .withColumn("list_id", F.when(F.col("is_forward"), F.col("_list")).otherwise(F.col("list_id"))).drop("_definition", "_list"))


def _is_empty(df: DataFrame) -> bool:
    return not df.limit(1).head(1)


def flatten(roots: DataFrame, fields: DataFrame) -> DataFrame:
    """Members of each root with anonymous classes and unions expanded in place.

    ``roots`` is (root, list_id); ``fields`` is (list_id, ord, member, off, kind, child_list). A member is
    expanded by its own name, not the name of its type. ``union_group`` numbers the outermost anonymous
    unions of a root in walk order; their members, however deep, may share bytes. Equal members count once. A list
    that contains itself has no members to write out: the job fails and names it.
    """
    path, opened = F.col("_path"), F.col("_union")
    level = durable(roots.select("root", "list_id", F.lit(0).cast("bigint").alias("_base"), F.array().cast("array<int>").alias("_path"),
                                 F.lit(None).cast("array<int>").alias("_union"), F.array("list_id").alias("_passed")), "flatten")
    members, unions = None, None
    while True:
        met = level.join(fields, "list_id").withColumn("_path", F.concat(path, F.array(F.col("ord").cast("int"))))
        expands = is_transparent_member(F.col("member")) & F.col("kind").isin("class", "union")
        plain = met.filter(~expands).select("root", "member", (F.col("_base") + F.col("off")).alias("off"), "_path", "_union",
                                            *[c for c in fields.columns if c not in ("list_id", "ord", "member", "off", "child_list")])
        members = plain if members is None else members.unionByName(plain)
        closes = F.raise_error(F.concat(F.lit("field list contains itself: "), F.col("child_list").cast("string")))
        child = F.when(F.array_contains("_passed", F.col("child_list")), closes.cast(fields.schema["child_list"].dataType)).otherwise(F.col("child_list"))
        level = durable(met.filter(expands & F.col("child_list").isNotNull()).select(
            "root", child.alias("list_id"), (F.col("_base") + F.col("off")).alias("_base"), "_path",
            F.coalesce(opened, F.when(F.col("kind") == "union", path)).alias("_union"),
            F.concat("_passed", F.array("child_list")).alias("_passed")), "flatten")
        begun = level.filter(opened == path).select("root", "_union")
        unions = begun if unions is None else unions.unionByName(begun)
        if _is_empty(level):
            break
    numbers = positions_within(unions, ["root"], ["_union"], "_nth").select("root", "_union", (F.col("_nth") + 1).alias("union_group"))
    return (members.join(numbers, ["root", "_union"], "left")
            .withColumn("union_group", F.coalesce("union_group", F.lit(0).cast("bigint"))).drop("_union", "_path").dropDuplicates())


def resolve_sizes(records: DataFrame) -> DataFrame:
    """(idx, bytes) of what each record denotes.

    Every record either states its size or refers to one other record; references are followed by
    doubling, so a chain of n hops takes log n joins. What still refers after as many rounds as all records
    together could need is part of a cycle and denotes nothing: 0.
    """
    # A forward reference takes the size of its definition, found by name.
    chosen = canonical_records(records).select("kind_group", "name", F.col("idx").alias("_definition"))
    kind = F.col("kind")
    aggregate = kind.isin("class", "union")
    refers = (F.when(kind.isin("enum", "modifier", "bitfield"), F.col("underlying"))
              .when(aggregate & F.col("is_forward") & (F.col("_definition") != F.col("idx")), F.col("_definition")))
    stated = (F.when(kind == "primitive", primitive_size(F.col("primitive"), F.col("indirection")))
              .when(aggregate | kind.isin("array", "pointer"), F.coalesce(F.col("size"), F.lit(0)).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    state = durable(records.join(chosen, ["kind_group", "name"], "left").select("idx", refers.alias("_to"), stated.alias("bytes")), "sizes")
    for _ in range(state.count().bit_length() + 1):
        if _is_empty(state.filter(F.col("_to").isNotNull())):
            break
        target = state.select(F.col("idx").alias("_to"), F.col("_to").alias("_next"), F.col("bytes").alias("_bytes"))
        state = durable(state.join(target, "_to", "left").select(
            "idx", F.col("_next").alias("_to"), F.when(F.col("_to").isNull(), F.col("bytes")).otherwise(F.coalesce("_bytes", F.lit(0).cast("bigint"))).alias("bytes")), "sizes")
    return state.select("idx", F.when(F.col("_to").isNull(), F.col("bytes")).otherwise(F.lit(0).cast("bigint")).alias("bytes"))


def _qualifiers(is_const: Column, is_volatile: Column) -> Column:
    return F.concat(F.when(is_const, "const ").otherwise(""), F.when(is_volatile, "volatile ").otherwise(""))


def render_types(records: DataFrame, sizes: DataFrame) -> DataFrame:
    """(idx, declared) with the C spelling of each record; '' where anything on the way is unresolvable.

    The chain from a record to its innermost type is a list of wrappers, outermost first, folded from the inside out. Lists
    are put together by doubling: each round appends to a record's list that of the record where it ends, so n wrappers
    take log n rounds. A chain has records of every shorter length behind it, so once a round ends no chain, those that are
    left run in circles. They are empty, as is everything around an empty text.
    """
    kind = F.col("kind")
    stride = sizes.select(F.col("idx").alias("underlying"), F.col("bytes").alias("_stride"))
    after_star = F.concat(F.when(F.coalesce("is_const", F.lit(False)), " const").otherwise(""), F.when(F.coalesce("is_volatile", F.lit(False)), " volatile").otherwise(""))
    before = _qualifiers(F.coalesce("is_const", F.lit(False)), F.coalesce("is_volatile", F.lit(False)))
    count = F.when((F.col("_stride") > 0) & F.col("size").isNotNull(), F.concat(F.lit("["), F.expr("cast(size div _stride as string)"), F.lit("]"))).otherwise("[]")
    extra = F.when(kind == "pointer", after_star).when(kind == "modifier", before).when(kind == "array", count).otherwise("")
    wraps = kind.isin("pointer", "modifier", "array", "bitfield", "function")
    text = (F.when(kind == "primitive", primitive_name(F.col("primitive"), F.col("indirection")))
            .when(kind.isin("class", "union", "enum"), F.coalesce("name", F.lit(""))).otherwise(""))
    nodes = durable(records.join(stride, "underlying", "left").select(
        "idx", F.when(wraps, F.struct(kind.alias("kind"), extra.alias("extra"))).alias("_wrap"), F.when(wraps, F.col("underlying")).alias("_inner"), text.alias("_text")), "nodes")

    chains = durable(nodes.select("idx", F.array_compact(F.array("_wrap")).alias("_wraps"), "_inner", "_text"), "render")
    open_, before = chains.filter("_inner is not null").count(), None
    while open_ and open_ != before:
        ahead = chains.select(F.col("idx").alias("_inner"), F.col("_wraps").alias("_w"), F.col("_inner").alias("_next"), F.col("_text").alias("_t"))
        running = chains.filter("_inner is not null").join(ahead, "_inner", "left").select(
            "idx", F.concat("_wraps", F.coalesce("_w", F.array().cast(chains.schema["_wraps"].dataType))).alias("_wraps"), F.col("_next").alias("_inner"), F.coalesce("_t", F.lit("")).alias("_text"))
        chains = durable(chains.filter("_inner is null").unionByName(running.select(*chains.columns)), "render")
        open_, before = chains.filter("_inner is not null").count(), open_
    finished = chains.select("idx", "_wraps", F.when(F.col("_inner").isNull(), F.col("_text")).otherwise("").alias("_text"))

    def wrap(state: Column, step: Column) -> Column:
        text, inner = state["text"], state["kind"]
        to_function = F.concat(F.regexp_replace(text, r"^(.*?) \(\)", r"$1 (*)()"), step["extra"])
        spelled = (F.when(text == "", F.lit(""))
                   .when((step["kind"] == "pointer") & (inner == "function"), to_function)
                   .when(step["kind"] == "pointer", F.concat(text, F.lit(" *"), step["extra"]))
                   .when(step["kind"] == "modifier", F.concat(step["extra"], text))
                   .when(step["kind"] == "array", F.concat(text, step["extra"]))
                   .when(step["kind"] == "function", F.concat(text, F.lit(" ()")))
                   .otherwise(text))
        return F.struct(spelled.alias("text"), step["kind"].alias("kind"))

    start = F.struct(F.col("_text").alias("text"), F.lit("").alias("kind"))
    return finished.select("idx", F.aggregate(F.reverse("_wraps"), start, wrap)["text"].alias("declared"))


def enum_constants(enums: DataFrame, lists: DataFrame, constants: DataFrame) -> DataFrame:
    """(enum_name, name, value) over the field list of each enum and its continuations, duplicates removed.

    Continuations are followed by doubling: when all lists up to a distance are known, one join with the jumps of that
    distance finds those up to twice as far. Lists in a cycle each count once: a round that finds nothing new is the last.
    """
    jump = durable(lists.filter("continuation is not null").select(F.col("list_id").alias("_from"), F.col("continuation").alias("_to")).distinct(), "continuation")
    reached = durable(enums.select("enum_name", "list_id").distinct(), "continuation")
    while True:
        ahead = reached.join(jump, F.col("list_id") == F.col("_from")).select("enum_name", F.col("_to").alias("list_id")).distinct()
        fresh = durable(ahead.join(reached, ["enum_name", "list_id"], "left_anti"), "continuation")
        if _is_empty(fresh):
            break
        reached = reached.unionByName(fresh)
        further = jump.select(F.col("_from").alias("_to"), F.col("_to").alias("_end"))
        jump = durable(jump.join(further, "_to").select("_from", F.col("_end").alias("_to")).distinct(), "continuation")
    return reached.join(constants, "list_id").select("enum_name", "name", "value").dropDuplicates()
