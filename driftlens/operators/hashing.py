"""Content addressing: canonical texts, blob ids, layout hashes, documents, deduplication, samples."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlens.operators.ordering import top_per_group

# Schema generation in the hash prefix, and how much of a digest names a blob.
LAYOUT_SCHEMA_VERSION = 2
BLOB_DIGITS = 12

BODY = ["layout", "kind", "name", "size"]


def _words(*parts) -> Column:
    """Space-joined text that keeps empty parts."""
    texts = [F.lit(part) if isinstance(part, str) else F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    spaced = [texts[0]]
    for text in texts[1:]:
        spaced += [F.lit(" "), text]
    return F.concat(*spaced)


def type_lines(members: DataFrame, types: DataFrame) -> DataFrame:
    """Canonical lines of every type, keyed by body and sortable by (``rank``, ``at``, ``item``, ``line`` order columns)."""
    declared = types.select("layout", F.lit("type").alias("kind"), F.col("type_name").alias("name"), F.col("type_size").cast("bigint").alias("size"))
    rows = members.select("layout", F.col("type_name").alias("name"), F.col("off").cast("bigint").alias("at"), F.col("member").alias("item"),
                          F.struct("sz", "bit_position", "bit_count", "mtype").alias("rest"),
                          _words("M", F.col("off"), F.col("member"), F.col("sz"), F.col("bit_position"), F.col("bit_count"), F.col("mtype")).alias("line"))
    return _with_heads("T", declared, rows)


def enum_lines(constants: DataFrame) -> DataFrame:
    declared = constants.groupBy("layout", F.col("enum_name").alias("name")).agg(F.max("enum_size").cast("bigint").alias("size")).select(
        "layout", F.lit("enum").alias("kind"), "name", "size")
    rows = constants.select("layout", F.col("enum_name").alias("name"), F.col("value").cast("bigint").alias("at"), F.col("name").alias("item"),
                            F.struct(F.lit(0).alias("sz"), F.lit(0).alias("bit_position"), F.lit(0).alias("bit_count"), F.lit("").alias("mtype")).alias("rest"),
                            _words("C", F.col("value"), F.col("name")).alias("line"))
    return _with_heads("E", declared, rows)


def _with_heads(mark: str, declared: DataFrame, rows: DataFrame) -> DataFrame:
    """Head line and item lines of each body; an item of an undeclared body has no place and is left out."""
    keyed = declared.join(rows, ["layout", "name"]).select(*BODY, F.lit(1).alias("rank"), "at", "item", "rest", "line")
    heads = declared.select(*BODY, F.lit(0).alias("rank"), F.lit(None).cast("bigint").alias("at"), F.lit(None).cast("string").alias("item"),
                            F.lit(None).cast(keyed.schema["rest"].dataType).alias("rest"), _words(mark, F.col("name"), F.col("size")).alias("line"))
    return keyed.unionByName(heads)


LINE_ORDER = ["rank", "at", "item", "rest"]


def _changes(column: pa.Array) -> np.ndarray:
    """Where a value of a column differs from the one before; null equals null."""
    before, after = column.slice(0, len(column) - 1), column.slice(1)
    other = pc.fill_null(pc.not_equal(before, after), False)
    return pc.or_(other, pc.not_equal(pc.is_null(before), pc.is_null(after))).to_numpy(zero_copy_only=False)


def _stream_digests(keys: list[str], tail: bytes):
    """Digest of each run of equal keys in sorted lines; the part of a run that a batch holds is joined and hashed at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            changed = np.zeros(batch.num_rows - 1, bool)
            for k in range(len(keys)):
                changed |= _changes(batch.column(k))
            edges = [0, *(np.nonzero(changed)[0] + 1), batch.num_rows]
            lines, done = batch.column(len(keys)).to_pylist(), []
            for begin, end in zip(edges[:-1], edges[1:], strict=True):
                key, part = tuple(batch.column(k)[begin].as_py() for k in range(len(keys))), "\n".join(lines[begin:end]).encode()
                if key == current:
                    digest.update(b"\n" + part)
                    continue
                if current is not None:
                    digest.update(tail)
                    done.append((*current, digest.hexdigest()))
                current, digest = key, hashlib.sha256(part)
            yield finished(batch.schema, done)
        if current is not None:
            digest.update(tail)
            yield finished(batch.schema, [(*current, digest.hexdigest())])

    def finished(schema: pa.Schema, done: list[tuple]) -> pa.RecordBatch:
        kinds = [*(schema.field(k).type for k in range(len(keys))), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([row[k] for row in done], kind) for k, kind in enumerate(kinds)], names=[*keys, "digest"])

    return run


def digest_lines(lines: DataFrame, keys: list[str], order: list[str], trailing_newline: bool) -> DataFrame:
    """SHA-256 over the newline-joined ``line`` values of each group, in ``order``.

    The digest is sequential by definition, so one group is read by one task; it is never gathered there but streamed
    from a sorted, spillable shuffle, however long it is.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lines.select(*keys).schema) + ", digest string"
    sorted_ = lines.repartition(*keys).sortWithinPartitions(*keys, *order).select(*keys, "line")
    return sorted_.mapInArrow(_stream_digests(keys, b"\n" if trailing_newline else b""), schema)


def blob_id(digest: Column) -> Column:
    return F.substring(digest, 1, BLOB_DIGITS)


def manifest(lines: DataFrame) -> DataFrame:
    """(layout, kind, name, size, blob): each definition under the id of its canonical text."""
    return digest_lines(lines, BODY, LINE_ORDER, False).select(*BODY, blob_id(F.col("digest")).alias("blob"))


def layout_hash(lines: DataFrame) -> DataFrame:
    """(layout, hash) over all types by name, then all enums by name. Addresses and union groups are not part of it."""
    ranked = lines.withColumn("_section", F.when(F.col("kind") == "type", 0).otherwise(1))
    digests = digest_lines(ranked, ["layout"], ["_section", "name", *LINE_ORDER], True)
    return digests.select("layout", F.concat(F.lit(f"v{LAYOUT_SCHEMA_VERSION}:sha256:"), F.col("digest")).alias("hash"))


def type_documents(members: DataFrame, types: DataFrame) -> DataFrame:
    """The stored form of a type: exactly what its hash covers, members in order."""
    fields = F.struct("off", "member", "sz", "bit_position", "bit_count", "mtype")
    body = members.groupBy("layout", "type_name").agg(F.sort_array(F.collect_list(fields)).alias("_m"))
    shaped = F.transform("_m", lambda m: F.struct(
        m["member"].alias("name"), m["mtype"].alias("type"), m["off"].alias("offset"), m["sz"].alias("size"), m["bit_position"].alias("bit_position"),
        m["bit_count"].alias("bit_count")))
    return types.join(body, ["layout", "type_name"]).select(
        "layout", F.struct(F.col("type_name").alias("name"), F.lit("type").alias("kind"), F.col("type_size").alias("size"), shaped.alias("members")).alias("document"))


def enum_documents(constants: DataFrame) -> DataFrame:
    body = constants.groupBy("layout", "enum_name").agg(F.sort_array(F.collect_list(F.struct("value", "name"))).alias("_c"), F.max("enum_size").alias("size"))
    shaped = F.transform("_c", lambda c: F.struct(c["name"].alias("name"), c["value"].alias("value")))
    return body.select("layout", F.struct(F.col("enum_name").alias("name"), F.lit("enum").alias("kind"), F.col("size").alias("size"), shaped.alias("constants")).alias("document"))


def new_blobs(found: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct bodies not yet stored. Append these; a manifest may only name what is present."""
    fresh = found.dropDuplicates(["blob"])
    return fresh if existing is None else fresh.join(existing.select("blob"), "blob", "left_anti")


def new_layouts(hashes: DataFrame, existing: DataFrame) -> DataFrame:
    """Each layout hash once, with whether it is written or reused."""
    held = existing.select("hash").distinct().withColumn("_held", F.lit(True))
    return hashes.select("hash").distinct().join(held, "hash", "left").select(
        "hash", F.when(F.col("_held"), F.lit("reused")).otherwise(F.lit("written")).alias("outcome"))


def reachable(builds: DataFrame, manifest_rows: DataFrame, blobs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Manifest rows of layouts some build uses, and the blobs those name."""
    live = manifest_rows.join(builds.select("layout").distinct(), "layout", "left_semi")
    return live, blobs.join(live.select("blob").distinct(), "blob", "left_semi")


def dangling(builds: DataFrame, manifest_rows: DataFrame, blobs: DataFrame) -> DataFrame:
    """References to what is not stored; must be empty before anything is published."""
    layouts = builds.select("layout").distinct().join(manifest_rows.select("layout").distinct(), "layout", "left_anti")
    live = manifest_rows.join(builds.select("layout").distinct(), "layout", "left_semi")
    bodies = live.select("blob").distinct().join(blobs.select("blob"), "blob", "left_anti")
    return layouts.select(F.lit("layout").alias("kind"), F.col("layout").cast("string").alias("reference")).unionByName(
        bodies.select(F.lit("blob").alias("kind"), F.col("blob").alias("reference")))


def body_sample(listed: DataFrame, n: int | None, key: str = "symbol_key") -> DataFrame:
    """The ``n`` names of each build whose hash with the build key comes first; all of them if it has no more."""
    if n is None:
        return listed
    return top_per_group(listed, [key], [F.sha2(F.concat_ws("/", key, "name"), 256), "name", "kind"], n).drop("nth")


def seeded_sample(builds: DataFrame, n: int, seed: int, key: str = "symbol_key") -> DataFrame:
    """A reproducible pick of ``n`` builds; which ones depends on the seed alone."""
    return builds.orderBy(F.sha2(F.concat_ws("/", F.lit(str(seed)), F.col(key)), 256), key).limit(n)


def drop_exact_duplicates(rows: DataFrame) -> DataFrame:
    return rows.dropDuplicates()
