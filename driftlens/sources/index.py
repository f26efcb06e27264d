"""Release indexes: JSON objects keyed by content hash, flattened to one row per entry."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlens.functions.text import machine_name

ENTRY = ("struct<fileInfo:struct<timestamp:bigint,virtualSize:bigint,size:bigint,lastSectionVirtualAddress:bigint,"
         "lastSectionPointerToRawData:bigint,machineType:int,version:string>,"
         "windowsVersions:map<string,map<string,struct<updateInfo:struct<releaseDate:string>>>>>")
INDEX = f"map<string,{ENTRY}>"

# Page mask of the size reconstruction and the overlays seen; the update that is no KB.
PAGE = 0x1000
OVERLAYS = (0x2000, 0x3000)
BASE_UPDATE = "BASE"


def parse_index(texts: DataFrame, column: str = "value") -> DataFrame:
    """Rows (sha256, entry) of JSON objects held as text, spread out again after the explode.

    A text that is no such object fails the job: an index that is cut off must not look like a small one.
    Use ``rejected_texts`` to find them, and leave them out beforehand if they are to be skipped.
    """
    return (texts.select(F.explode(F.from_json(column, INDEX, {"mode": "FAILFAST"})).alias("sha256", "entry"))
            .repartition("sha256"))


def rejected_texts(texts: DataFrame, column: str = "value", schema: str = INDEX) -> DataFrame:
    """The rows whose text is missing or not of the schema."""
    return texts.filter(F.from_json(column, schema).isNull())


class Entries:
    """Cuts JSON objects that arrive in pieces into their entries, holding one entry at a time.

    Every piece ends where a brace closes; that brace is not part of it. Objects may follow each other; a stray brace between
    them is taken for white space, as the end of a file has one too many.
    """

    _MARK = re.compile(r'["\\{}]')
    _DECODE = json.JSONDecoder()

    def __init__(self, name: str = ""):
        self.name, self.held, self.depth, self.quoted, self.skip, self.count = name, [], 0, False, False, 0

    def _fail(self, why: str):
        raise ValueError(f"{self.name}: {why}")

    def feed(self, piece: str) -> tuple[str, str] | None:
        """Key and JSON text of the entry that this piece completes, if it does."""
        if not self.depth and not self.held and not piece.strip():
            return None  # white space after the last object
        text = piece + "}"
        at = 1 if self.skip else 0
        self.skip = False
        while (mark := self._MARK.search(text, at)) is not None:
            at, sign = mark.end(), mark[0]
            if self.quoted:
                if sign == "\\":
                    self.skip = at == len(text)
                    at += 1
                elif sign == '"':
                    self.quoted = False
            elif sign == '"':
                self.quoted = True
            elif sign != "\\":
                self.depth += 1 if sign == "{" else -1
        self.held.append(text)
        if self.quoted or self.skip or self.depth > 1:
            return None
        whole, self.held = "".join(self.held).strip(), []
        if self.depth < 0 or self.depth == 0 and whole != ("}" if self.count else "{}"):
            self._fail("not an object of objects")
        if self.depth == 0:
            self.count = 0
            return None
        if whole[0] != ("," if self.count else "{"):
            self._fail("not an object of objects")
        self.count += 1
        rest = whole[1:].lstrip()
        if not rest.startswith('"'):
            self._fail("an entry without a key")
        key, end = self._DECODE.raw_decode(rest)
        value = rest[end:].lstrip()
        if not value.startswith(":"):
            self._fail("an entry without a value")
        return key, value[1:].strip()

    def end(self) -> None:
        """Refuse an object that has not ended."""
        if self.depth or self.held:
            self._fail("ends within an object")


def _entries_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader = None
    for batch in batches:
        keys, values = [], []
        for piece, path, begin in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if reader is None or reader.name != path:
                if reader is not None:
                    reader.end()
                if begin:
                    raise ValueError(f"{path} is read in parts; compress it or raise spark.sql.files.maxPartitionBytes")
                reader = Entries(path)
            found = reader.feed(piece)
            if found:
                keys.append(found[0])
                values.append(found[1])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(values, pa.string())], names=["sha256", "value"])
    if reader is not None:
        reader.end()


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Rows (sha256, entry) of ``*.json.gz`` indexes, each one or more JSON objects.

    A file is read from its beginning to its end, brace by brace, and handed on entry by entry: a task holds one entry
    and a batch of pieces, however large the object is. Many files are read in parallel. What is no such object, or ends
    within one, fails the job.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("begin"))
    found = pieces.mapInArrow(_entries_of, "sha256 string, value string")
    return found.repartition("sha256").select("sha256", F.from_json("value", ENTRY, {"mode": "FAILFAST"}).alias("entry"))


def _truthy(column: Column) -> Column:
    return F.coalesce(column, F.lit(0)) != 0


def size_candidates(info: str = "entry.fileInfo") -> Column:
    """Possible image sizes: the stated one, else two reconstructions from the last section, else none."""
    def field(name: str) -> Column:
        return F.col(f"{info}.{name}")

    tail = field("lastSectionVirtualAddress") + field("size") - field("lastSectionPointerToRawData") + (PAGE - 1)
    aligned = tail.bitwiseAND(F.lit(-PAGE).cast("bigint"))
    guesses = F.filter(F.array(*[aligned - overlay for overlay in OVERLAYS]), lambda size: size > 0)
    known = _truthy(field("lastSectionVirtualAddress")) & _truthy(field("lastSectionPointerToRawData")) & _truthy(field("size"))
    return (F.when(_truthy(field("virtualSize")), F.array(field("virtualSize")))
            .when(known, guesses).otherwise(F.array().cast("array<bigint>")))


def is_downloadable(info: str = "entry.fileInfo") -> Column:
    """A timestamp and at least one size. Both sides of the split use this one predicate."""
    return _truthy(F.col(f"{info}.timestamp")) & (F.size(size_candidates(info)) > 0)


def downloadable(entries: DataFrame) -> DataFrame:
    return entries.filter(is_downloadable())


def undownloadable(entries: DataFrame) -> DataFrame:
    return entries.filter(~is_downloadable())


def candidates(entries: DataFrame) -> DataFrame:
    """Usable entries as columns: version, machine, sizes, channels with their KBs, first release date."""
    versions = F.coalesce(F.col("entry.windowsVersions"), F.create_map().cast("map<string,map<string,struct<updateInfo:struct<releaseDate:string>>>>"))
    kbs = F.transform_values(versions, lambda _, updates: F.array_sort(F.filter(F.map_keys(updates), lambda kb: kb != BASE_UPDATE)))
    dates = F.flatten(F.transform(F.map_values(versions), lambda updates: F.transform(
        F.map_values(F.map_filter(updates, lambda kb, _: kb != BASE_UPDATE)), lambda update: update["updateInfo"]["releaseDate"])))
    first = F.array_min(F.filter(dates, lambda date: date.isNotNull() & (date != "")))
    sizes = size_candidates()
    return downloadable(entries).select(
        "sha256", F.split_part(F.coalesce("entry.fileInfo.version", F.lit("")), F.lit(" "), F.lit(1)).alias("version"),
        F.coalesce("entry.fileInfo.machineType", F.lit(0)).alias("machine_code"), F.col("entry.fileInfo.timestamp").alias("timestamp"),
        F.element_at(sizes, 1).alias("size_of_image"), F.slice(sizes, 2, F.size(sizes)).alias("size_alternatives"),
        kbs.alias("channels"), F.coalesce(first, F.lit("")).alias("release_date"))


def with_derived(found: DataFrame) -> DataFrame:
    """Machine name, sorted channel names and distinct sorted KBs."""
    return (found.withColumn("machine", machine_name(F.col("machine_code")))
            .withColumn("channel", F.array_sort(F.map_keys("channels")))
            .withColumn("kb", F.array_sort(F.array_distinct(F.flatten(F.map_values("channels"))))))


def channel_names(entries: DataFrame) -> DataFrame:
    """Every entry's channel list, fetchable or not."""
    return entries.select("sha256", F.map_keys("entry.windowsVersions").alias("channel"))
