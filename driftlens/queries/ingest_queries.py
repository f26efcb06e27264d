"""Sources, filters, resolution, coverage and incremental merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftlens.functions import names as nm
from driftlens.operators import coverage, merging, resolve, selection
from driftlens.queries.registry import query
from driftlens.runtime import scratch_path
from driftlens.sources import documents, index
from driftlens.streaming import incremental

# One index entry per order; some lack the stated size, some of those also the last section.
IDX = ("idx_rows", """
select lpad(cast(o_orderkey as string),12,'0') as sha256, o_orderkey % 97 as ts, o_orderkey % 13 * 4096 as vs, o_custkey * 512 + 20480 as sz,
 case when o_orderkey % 3 <> 0 then o_custkey * 4096 end as va, 1024 as raw, case o_orderkey % 4 when 0 then 332 when 1 then 34404 when 2 then 43620 else 450 end as machine,
 '10.0.' || cast(20000 + o_custkey % 5 as string) || '.' || cast(o_custkey as string) as version, o_orderpriority as ch1, 'KB' || cast(5000000 + o_custkey as string) as kb1,
 cast(cast(o_orderdate as date) as string) as date1, case when o_totalprice < 120000 then 'LTSC' end as ch2, 'KB' || cast(4000000 + o_custkey as string) as kb2 from orders""")
IDX_S = ("idx_sized", """
select *, case when vs <> 0 then cast(vs as varchar) when va is not null and va <> 0 then concat_ws(',', case when al > 8192 then cast(al - 8192 as varchar) end, case when al > 12288 then cast(al - 12288 as varchar) end) else '' end as sizes
from (select *, (va + sz - raw + 4095) // 4096 * 4096 as al from idx_rows) t""")
IDXV = (IDX, IDX_S)


def shaped(fx):
    """Index entries of the rows, as the format nests them."""
    update = F.struct(F.struct(F.col("date1").alias("releaseDate")).alias("updateInfo"))
    none = F.struct(F.struct(F.lit(None).cast("string").alias("releaseDate")).alias("updateInfo"))
    base = F.struct(F.struct(F.lit("1999-01-01").alias("releaseDate")).alias("updateInfo"))
    channels = F.map_from_entries(F.array_compact(F.array(
        F.struct(F.col("ch1").alias("k"), F.create_map(F.col("kb1"), update, F.lit("BASE"), base).alias("v")),
        F.when(F.col("ch2").isNotNull(), F.struct(F.col("ch2").alias("k"), F.create_map(F.col("kb2"), none).alias("v"))))))
    info = F.struct(F.col("ts").alias("timestamp"), F.col("vs").alias("virtualSize"), F.col("sz").alias("size"), F.col("va").alias("lastSectionVirtualAddress"),
                    F.col("raw").alias("lastSectionPointerToRawData"), F.col("machine").alias("machineType"),
                    F.concat("version", F.lit(" (Build.160101)")).alias("version"))
    return fx.sql(IDX[1]).select("sha256", F.struct(info.alias("fileInfo"), channels.alias("windowsVersions")).alias("entry"))


def texts(fx):
    """Each entry as a JSON object of its own."""
    return shaped(fx).select("sha256", F.to_json(F.create_map("sha256", "entry")).alias("value"))


def entries(fx):
    """The same rows written as JSON objects and read back."""
    return index.parse_index(texts(fx))


@query("q_src1_index_entries", "select sha256, ts, version || ' (Build.160101)' as version, 1 + case when ch2 is null then 0 else 1 end as channels from idx_rows", *IDXV)
def _(fx):
    return entries(fx).select("sha256", F.col("entry.fileInfo.timestamp").alias("ts"), F.col("entry.fileInfo.version").alias("version"),
                              F.size("entry.windowsVersions").alias("channels"))


@query("q_src1_index_files", "select sha256, ts, version || ' (Build.160101)' as version, 1 + case when ch2 is null then 0 else 1 end as channels from idx_rows", *IDXV)
def _(fx):
    # Gzipped objects of up to fifty entries each.
    path = scratch_path(fx.spark, "index")
    objects = shaped(fx).groupBy(F.expr("cast(sha256 as bigint) div 50")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("sha256", "entry")))).alias("value"))
    objects.select("value").write.option("compression", "gzip").text(path)
    return index.read_index(fx.spark, path).select("sha256", F.col("entry.fileInfo.timestamp").alias("ts"), F.col("entry.fileInfo.version").alias("version"), F.size("entry.windowsVersions").alias("channels"))


@query("q_src1_rejected_texts", "select sha256 from idx_rows where ts % 13 in (0, 1)", *IDXV)
def _(fx):
    # Some texts are cut off, some are missing.
    broken = F.expr("case cast(sha256 as bigint) % 97 % 13 when 0 then left(value, length(value) div 2) when 1 then null else value end")
    return index.rejected_texts(texts(fx).withColumn("value", broken)).select("sha256")


@query("q_src2_downloadable", "select sha256 from idx_sized where ts <> 0 and sizes <> ''", *IDXV)
def _(fx):
    return index.downloadable(entries(fx)).select("sha256")


@query("q_src3_undownloadable", "select sha256 from idx_sized where not (ts <> 0 and sizes <> '')", *IDXV)
def _(fx):
    return index.undownloadable(entries(fx)).select("sha256")


@query("q_src4_size_candidates", "select sha256, sizes from idx_sized", *IDXV)
def _(fx):
    return entries(fx).select("sha256", F.array_join(index.size_candidates().cast("array<string>"), ",").alias("sizes"))


@query("q_src5_candidates", """
select sha256, version, ch1 || ':' || kb1 || case when ch2 is null then '' else '|' || ch2 || ':' || kb2 end as channels, date1 as release_date from idx_sized where ts <> 0 and sizes <> ''""", *IDXV)
def _(fx):
    listed = F.transform(F.array_sort(F.map_entries("channels")), lambda e: F.concat_ws(":", e["key"], F.array_join(e["value"], ",")))
    return index.candidates(entries(fx)).select("sha256", "version", F.array_join(listed, "|").alias("channels"), "release_date")


@query("q_src6_derived_columns", """
select sha256, case machine when 332 then 'x86' when 34404 then 'amd64' when 43620 then 'arm64' else '0x01C2' end as machine, ch1 || case when ch2 is null then '' else ',' || ch2 end as channel,
 case when ch2 is null then kb1 else kb2 || ',' || kb1 end as kb from idx_sized where ts <> 0 and sizes <> ''""", *IDXV)
def _(fx):
    return index.with_derived(index.candidates(entries(fx))).select("sha256", "machine", F.array_join("channel", ",").alias("channel"), F.array_join("kb", ",").alias("kb"))


@query("q_src7_channel_totals", "select channel, count(*) as known from (select ch1 as channel from idx_rows union all select ch2 from idx_rows where ch2 is not null) t group by channel", *IDXV)
def _(fx):
    return coverage.channel_totals(index.channel_names(entries(fx)))


@query("q_src8_census", "select count(*) as listed, count(distinct sha256) as distinct_entries, count(*) - count(distinct sha256) as listed_again from fx_index")
def _(fx):
    return coverage.census(fx.table("fx_index"))


# ---- documents ----------------------------------------------------------------------------------------

def docs(fx):
    """Member tables as canonical documents, written as JSON text and parsed again."""
    written = documents.to_extractions(fx.table("fx_members"), fx.types(), "first")
    return written.select(F.to_json(F.struct("*")).alias("value"))


@query("q_src9_read_documents", "select layout, type_name, member, off, sz, bit_position, bit_count, mtype, 0 as union_group from fx_members")
def _(fx):
    read = documents.members_of(documents.parse_extractions(docs(fx)))
    return read.withColumn("layout", F.col("layout").cast("bigint"))


SRC9_SYM = ("srcn_sym", "select cast(build as bigint) - cast(build as bigint) % 100 as layout, name, min(rva) as rva from fx_symbols group by 1, 2")


@query("q_src9_whole_documents", """
select 'enums' as part, count(*) as n, cast(sum(value) as bigint) as total, cast(sum(length(name)) as bigint) as chars from fx_constants
 union all select 'rvas', count(*), cast(sum(rva) as bigint), cast(sum(length(name)) as bigint) from srcn_sym where layout in (select layout from fx_members)
 union all select 'missing', count(*), cast(sum(case kind when 'type' then 1 when 'symbol' then 2 else 3 end) as bigint), cast(sum(length(name)) as bigint) from
  (select distinct layout, 'type' as kind, member as name from fx_members where off = 8 union select distinct layout, 'symbol', member from fx_members where off = 16 union select distinct layout, 'enum', member from fx_members where off = 24) m""", SRC9_SYM)
def _(fx):
    fx.written("fx_members")
    members = fx.table("fx_members")
    absent = F.expr("case off when 8 then 'type' when 16 then 'symbol' when 24 then 'enum' end")
    missing = members.select("layout", absent.alias("kind"), F.col("member").alias("name")).filter("kind is not null").distinct()
    path = scratch_path(fx.spark, "extractions")
    documents.write_extractions(documents.to_extractions(members, fx.types(), "first", fx.table("fx_constants"), fx.sql(SRC9_SYM[1]), missing), path)
    read = documents.read_extractions(fx.spark, path, multi_line=False)

    def part(rows, name, value):
        return rows.agg(F.count("*").alias("n"), F.sum(value).cast("bigint").alias("total"), F.sum(F.length("name")).cast("bigint").alias("chars")).select(F.lit(name).alias("part"), "n", "total", "chars")

    number = F.when(F.col("kind") == "type", 1).when(F.col("kind") == "symbol", 2).otherwise(3)
    return (part(documents.constants_of(read), "enums", F.col("value")).unionByName(part(documents.symbols_of(read), "rvas", F.col("rva")))
            .unionByName(part(documents.missing_of(read), "missing", number)))


@query("q_src10_canonical_documents", """
select layout, md5('{"extractor":"first","pdb_key":"'||layout||'","types":{'||string_agg('"'||type_name||'":'||body, ',' order by type_name)||'}}') as digest from (
 select layout, type_name, '{"size":'||max(off+sz)||',"members":['||string_agg('{"offset":'||off||',"name":"'||member||'","size":'||sz||',"bit_position":'||bit_position||',"bit_count":'||bit_count||',"type":"'||mtype||'","union_group":0}', ',' order by off, member)||']}' as body
 from fx_members group by layout, type_name) t group by layout""")
def _(fx):
    return docs(fx).select(F.get_json_object("value", "$.pdb_key").cast("bigint").alias("layout"), F.md5("value").alias("digest"))


@query("q_src11_read_layouts", "select layout, type_name as name, count(*) as members, max(off+sz) as size from fx_members group by 1, 2")
def _(fx):
    from driftlens.operators import diffing, hashing
    m, types = fx.table("fx_members"), fx.types()
    bodies = diffing.type_bodies(m, types)
    stored = hashing.type_documents(m, types).select("layout", F.col("document.name").alias("name"), F.col("document.size").alias("size"), F.col("document.members").alias("members"))
    blobs = hashing.new_blobs(stored.join(bodies.select("layout", "name", "blob"), ["layout", "name"])).drop("layout")
    return documents.read_layout(bodies.drop("size"), blobs.withColumn("kind", F.lit("type")), types_only=True).select(
        "layout", "name", F.size("members").cast("bigint").alias("members"), "size")


@query("q_src12_split_roots", """
select 'build' as part, count(*) as n, count(distinct layout) as layouts from fx_builds union all select 'index', count(distinct symbol_key), 0 from fx_builds where file_version is not null""")
def _(fx):
    site, data = scratch_path(fx.spark, "site"), scratch_path(fx.spark, "data")
    fx.builds().write.parquet(f"{data}/build")
    fx.builds().filter("file_version is not null").select("file_version", "symbol_key").write.parquet(f"{site}/index")
    build = documents.read_table(fx.spark, site, "build", data).agg(F.count("*").alias("n"), F.count_distinct("layout").alias("layouts"))
    by_version = documents.read_table(fx.spark, site, "index", data).agg(F.count_distinct("symbol_key").alias("n"))
    return build.select(F.lit("build").alias("part"), "n", "layouts").unionByName(
        by_version.select(F.lit("index").alias("part"), "n", F.lit(0).cast("bigint").alias("layouts")))


# ---- filters ------------------------------------------------------------------------------------------

@query("q_fil1_channel", "select distinct symbol_key from fx_build_channels where channel = 'LTSC-5'")
def _(fx):
    return selection.in_channel(fx.builds(), "LTSC-5").select("symbol_key")


@query("q_fil2_tier", "select distinct symbol_key from fx_build_channels where channel in ('1-URGENT', 'LTSC-2', 'LTSC-3')")
def _(fx):
    return selection.in_tier(fx.builds(), ("1-URGENT", "LTSC-2", "LTSC-3")).select("symbol_key")


@query("q_fil3_resume", "select distinct sha256 from fx_index where sha256 not in (select symbol_key from fx_builds where machine = 'x86')")
def _(fx):
    stored = fx.builds().filter("machine = 'x86'").withColumn("sha256", F.array("symbol_key"))
    return selection.not_yet_stored(fx.table("fx_index").select("sha256").distinct(), stored)


FIL_WANT = "select '_' || l_returnflag || l_linestatus as name from lineitem group by 1 union select n_name from nation"


@query("q_fil4_allowlist", f"""
select 'selected' as state, type_name as name, count(*) as n from fx_members where type_name in ({FIL_WANT}) group by 2
union all select 'missing', name, 1 from ({FIL_WANT}) w where name not in (select type_name from fx_members)
union all select 'all', type_name, count(*) from fx_members group by 2""")
def _(fx):
    flags = fx.table("lineitem").groupBy("l_returnflag").agg(F.collect_set(F.concat(F.lit("_"), "l_returnflag", "l_linestatus")).alias("names"))
    lands = fx.table("nation").groupBy("n_regionkey").agg(F.collect_set("n_name").alias("names"))
    wanted = selection.allowlist_names(flags.select("names").unionByName(lands.select("names")))
    members = fx.table("fx_members")

    def counted(df, state):
        return df.groupBy(F.lit(state).alias("state"), F.col("type_name").alias("name")).agg(F.count("*").alias("n"))

    star = fx.spark.range(1).select(F.lit("*").alias("name"))
    missing = selection.missing_names(wanted, members, "type_name").select(F.lit("missing").alias("state"), "name", F.lit(1).cast("bigint").alias("n"))
    return (counted(selection.select_allowed(members, wanted, "type_name"), "selected").unionByName(missing)
            .unionByName(counted(selection.select_allowed(members, star, "type_name"), "all")))


TAGGED = "select case l_linenumber when 1 then '__unnamed' when 2 then '<unnamed-tag>' when 3 then '__unnamed_' || cast(l_partkey as string) when 4 then '<unnamed-type-' || cast(l_partkey as string) || '>' when 5 then '' else 'Field' || cast(l_partkey as string) end as name from lineitem"


@query("q_fil6_placeholders", f"""
select name, count(*) as n from ({TAGGED}) t where name <> '' and name not in ('<unnamed-tag>','<anonymous-tag>','<unnamed-enum-tag>','__unnamed') and not starts_with(name,'__unnamed_') group by name""")
def _(fx):
    return fx.sql(TAGGED).filter(nm.is_addressable(F.col("name"))).groupBy("name").agg(F.count("*").alias("n"))


@query("q_fil7_transparent", f"""
select name, count(*) as n from ({TAGGED}) t where name in ('','__unnamed','<unnamed-tag>','<anonymous-tag>') or starts_with(name,'__unnamed_') group by name""")
def _(fx):
    return fx.sql(TAGGED).filter(nm.is_transparent_member(F.col("name"))).groupBy("name").agg(F.count("*").alias("n"))


@query("q_fil9_first_n", "select symbol_key, coalesce(release_date,'') as release_date from fx_builds order by coalesce(release_date,'') desc, symbol_key limit 40")
def _(fx):
    dated = fx.builds().select("symbol_key", F.coalesce("release_date", F.lit("")).alias("release_date"))
    return selection.first_n(dated, [F.col("release_date").desc(), F.col("symbol_key")], 40)


# ---- resolution ---------------------------------------------------------------------------------------

RES = ("res_tries", """
select distinct sha256, vsize*4096 as size1, vsize*4096-4096 as size2, case ts % 4 when 0 then 'binary_404' when 1 then 'ok' when 2 then 'binary_404' else 'pe_parse_failed' end as out1,
 case when ts % 3 = 0 then 'ok' when ts % 3 = 1 then 'binary_404' else 'fetch_error' end as out2 from fx_index""")


@query("q_joi24_first_terminal", """
select sha256, case when out1 <> 'binary_404' then out1 else out2 end as outcome, coalesce(case when out1 = 'ok' then size1 when out1 = 'binary_404' and out2 = 'ok' then size2 end, -1) as size_of_image from res_tries""", RES)
def _(fx):
    tries = fx.sql(RES[1])
    listed = tries.select("sha256", F.array("size1", "size2").alias("sizes"))
    outcomes = tries.select("sha256", F.explode(F.array(F.struct(F.col("size1").alias("size"), F.col("out1").alias("outcome")),
                                                        F.struct(F.col("size2").alias("size"), F.col("out2").alias("outcome")))).alias("_o")).select("sha256", "_o.*")
    return resolve.first_terminal(listed, outcomes).fillna(-1, ["size_of_image"])


@query("q_joi25_duplicate_keys", """
select sha256, dataset, case when row_number() over (partition by vsize, ts % 50 order by dataset || sha256) = 1 then 'ok' else 'duplicate_key' end as outcome from fx_index""")
def _(fx):
    rows = fx.table("fx_index").withColumn("symbol_key", F.concat_ws("-", "vsize", F.col("ts") % 50)).withColumn("ord", F.concat("dataset", "sha256"))
    return resolve.mark_duplicates(rows).select("sha256", "dataset", "outcome")


@query("q_joi26_key_cache", """
select i.sha256, coalesce(b.symbol_key || '-cached', i.sha256 || '-read') as symbol_key from (select distinct sha256 from fx_index) i
left join (select * from fx_builds where machine <> 'arm64') b on b.symbol_key = i.sha256""")
def _(fx):
    cache = fx.builds().filter("machine <> 'arm64'").select(F.col("symbol_key").alias("sha256"), F.concat("symbol_key", F.lit("-cached")).alias("symbol_key"))
    looked = resolve.with_cached_keys(fx.table("fx_index").select("sha256").distinct(), cache)
    read = looked.filter(F.col("symbol_key").isNull()).withColumn("symbol_key", F.concat("sha256", F.lit("-read")))
    return resolve.updated_cache(cache, read)


@query("q_joi27_fallback_name", """
select symbol_key as key, case when machine = 'amd64' then 'image.pdb' when machine = 'x86' then 'image.pd_' else 'pdb_404' end as found from fx_builds""")
def _(fx):
    builds = fx.builds()
    wanted = builds.select(F.lit("image.pdb").alias("name"), F.col("symbol_key").alias("key"))
    published = builds.filter(F.col("machine") != "arm64").select(
        F.when(F.col("machine") == "amd64", "image.pdb").otherwise("image.pd_").alias("name"), F.col("symbol_key").alias("key"))
    return resolve.with_fallback(wanted, published).select("key", F.coalesce("found", F.lit("pdb_404")).alias("found"))


@query("q_joi28_address_offsets", """
select rva, arg_min(s_suppkey * 512 + rva - va, s_suppkey) as file_offset from (select distinct rva from fx_symbols) a
join (select s_suppkey, s_suppkey * 4096 as va, case when s_suppkey % 5 = 0 then 8192 else 2048 end as span from supplier) s on rva >= va and rva < va + span group by rva""")
def _(fx):
    sections = fx.table("supplier").select(
        F.lit("image").alias("image"), F.col("s_suppkey").alias("ord"), (F.col("s_suppkey") * 4096).alias("va"), F.lit(2048).alias("vsize"),
        F.when(F.col("s_suppkey") % 5 == 0, 8192).otherwise(2048).alias("rawsize"), (F.col("s_suppkey") * 512).alias("rawptr"))
    addresses = fx.table("fx_symbols").select(F.lit("image").alias("image"), "rva")
    return resolve.address_offsets(addresses, sections, 4096).select("rva", F.col("offset").alias("file_offset"))


# ---- coverage -----------------------------------------------------------------------------------------

def ledger(fx):
    return fx.table("fx_ledger").withColumn("channel", F.array("channel"))


@query("q_agg1_reasons", "select reason, count(*) as entries from fx_ledger group by reason")
def _(fx):
    return coverage.reason_counts(ledger(fx))


@query("q_agg2_defects", "select sha256, reason from fx_ledger where reason in ('pe_parse_failed','parse_failed','inconsistent','oracle_mismatch')")
def _(fx):
    return coverage.defects(ledger(fx)).select("sha256", "reason")


TOTALS = """
select known, resolved, no_version_metadata, accounted_missing, duplicate_entries, defects, greatest(known - resolved - accounted_missing - duplicate_entries, 0) as unattempted from (select
 {known} as known, (select count(*) from fx_builds) as resolved, (select count(*) from fx_builds where coalesce(file_version,'') = '') as no_version_metadata,
 (select count(*) from fx_ledger where reason <> 'duplicate_key') as accounted_missing, (select count(*) from fx_ledger where reason = 'duplicate_key') as duplicate_entries,
 (select count(*) from fx_ledger where reason = 'inconsistent') as defects) t"""


@query("q_agg3_totals", TOTALS.format(known="(select count(*) from fx_index)"))
def _(fx):
    datasets = coverage.dataset_census(fx.table("fx_index"), F.lit(True))
    return coverage.totals(coverage.known_entries(datasets), fx.builds(), ledger(fx))


@query("q_inc4_distinct_denominator", TOTALS.format(known="(select count(distinct sha256) from fx_index)"))
def _(fx):
    path = scratch_path(fx.spark, "universe")
    coverage.census(fx.table("fx_index")).select(F.col("distinct_entries").alias("known")).write.parquet(path)
    return coverage.totals(fx.spark.read.parquet(path), fx.builds(), ledger(fx))


@query("q_agg4_by_channel", """
select channel, cast(sum(k) as bigint) as known, cast(sum(r) as bigint) as resolved, cast(sum(m) as bigint) as missing, cast(greatest(sum(k)-sum(r)-sum(m),0) as bigint) as unattempted from (
 select channel, 1 as k, 0 as r, 0 as m from fx_index union all select channel, 0, 1, 0 from fx_build_channels union all select channel, 0, 0, 1 from fx_ledger where reason <> 'duplicate_key') t group by channel""")
def _(fx):
    known = fx.table("fx_index").groupBy("dataset", "channel").agg(F.count("*").alias("known"))
    return coverage.by_channel(known, fx.builds(), ledger(fx))


@query("q_agg5_by_machine", "select machine, count(*) as builds, count(*) filter (where coalesce(file_version,'') = '') as no_version from fx_builds group by machine")
def _(fx):
    return coverage.by_machine(fx.builds())


@query("q_agg12_run_summary", """
select outcome, count(*) as entries from (select case when i.ts = 0 or i.vsize = 0 then 'skipped' when l.reason is not null then 'failed' when b.symbol_key is not null then 'reused' else 'written' end as outcome
 from fx_index i left join fx_ledger l on l.sha256 = i.sha256 left join fx_builds b on b.symbol_key = i.sha256) t group by outcome""")
def _(fx):
    failed = fx.table("fx_ledger").select("sha256", F.lit(True).alias("failed"))
    held = fx.builds().select(F.col("symbol_key").alias("sha256"), F.lit(True).alias("held"))
    outcome = (F.when((F.col("ts") == 0) | (F.col("vsize") == 0), "skipped").when(F.col("failed"), "failed").when(F.col("held"), "reused").otherwise("written"))
    return merging.run_summary(fx.table("fx_index").join(failed, "sha256", "left").join(held, "sha256", "left").withColumn("outcome", outcome))


# ---- incremental --------------------------------------------------------------------------------------

def loads(fx):
    """Builds keyed by layout, so that many rows of a run meet in one key; arm64 arrives second."""
    rows = fx.builds().select(F.col("layout").alias("key"), F.col("symbol_key").alias("ord"), F.array("symbol_key").alias("sha256"), "channel", "kb",
                              "file_version", "release_date", "machine")
    return rows.filter("machine <> 'arm64'"), rows.filter("machine = 'arm64'")


INC = """
select b.layout as key, count(*) as sources, string_agg(distinct kb, ',' order by kb) as kb, max(c.channel) as channel,
 coalesce(arg_max(file_version, symbol_key) filter (where machine = 'arm64' and coalesce(file_version,'') <> ''), arg_max(file_version, symbol_key) filter (where machine <> 'arm64' and coalesce(file_version,'') <> ''), '') as file_version,
 coalesce(arg_max(release_date, symbol_key) filter (where machine = 'arm64' and release_date is not null), arg_max(release_date, symbol_key) filter (where machine <> 'arm64' and release_date is not null), '') as release_date,
 coalesce(arg_max(machine, symbol_key) filter (where machine = 'arm64'), arg_max(machine, symbol_key)) as machine
from fx_builds b join (select layout, string_agg(distinct channel, ',' order by channel) as channel from fx_builds join fx_build_channels using (symbol_key) group by layout) c on c.layout = b.layout group by b.layout"""


def shown(merged):
    return merged.select("key", F.size("sha256").cast("bigint").alias("sources"), F.array_join("kb", ",").alias("kb"), F.array_join("channel", ",").alias("channel"),
                         F.coalesce("file_version", F.lit("")).alias("file_version"), F.coalesce("release_date", F.lit("")).alias("release_date"), "machine")


@query("q_inc1_build_upsert", INC)
def _(fx):
    first, second = loads(fx)
    return shown(merging.upsert_builds(merging.fold(first, "key", "ord"), merging.fold(second, "key", "ord"), "key"))


@query("q_inc2_ledger_upsert", """
select sha256, reason from (select coalesce(r.sha256, l.sha256) as sha256, coalesce(r.reason, l.reason) as reason from fx_ledger l full join
 (select sha256, arg_max(case dataset when 'ga' then 'binary_404' else 'fetch_error' end, dataset) as reason from fx_index where ts < 24 group by sha256) r on r.sha256 = l.sha256) t
where sha256 not in (select symbol_key from fx_builds where machine = 'x86')""")
def _(fx):
    reason = F.when(F.col("dataset") == "ga", "binary_404").otherwise("fetch_error")
    recorded = fx.table("fx_index").filter("ts < 24").select("sha256", reason.alias("reason"), F.col("dataset").alias("ord"))
    stored = fx.builds().filter("machine = 'x86'").select(F.col("symbol_key").alias("sha256"))
    return merging.upsert_ledger(fx.table("fx_ledger").select("sha256", "reason"), recorded, stored)


@query("q_inc3_dataset_census", """
select dataset, count(*) as known, count(*) filter (where ts <> 0 and vsize <> 0) as downloadable from fx_index group by dataset union all select 'arm64', count(*), 0 from fx_builds where machine = 'arm64'""")
def _(fx):
    usable = (F.col("ts") != 0) & (F.col("vsize") != 0)
    old = fx.builds().groupBy(F.when(F.col("machine") == "arm64", "arm64").otherwise("ga").alias("dataset")).agg(
        F.count("*").alias("known"), F.lit(0).cast("bigint").alias("downloadable"))
    return merging.last_wins(old, coverage.dataset_census(fx.table("fx_index"), usable), "dataset")


@query("q_inc5_streamed_merge", """
select layout as key, count(*) as sources, string_agg(distinct kb, ',' order by kb) as kb, coalesce(arg_max(file_version, symbol_key) filter (where coalesce(file_version,'') <> ''),'') as file_version from fx_builds group by layout""")
def _(fx):
    from driftlens.queries.fx import VIEWS

    def prepare(batch):
        builds = batch.sparkSession.sql(VIEWS["fx_builds"].replace("from orders", "from {orders}"), orders=batch)
        return builds.select(F.col("layout").alias("key"), F.col("symbol_key").alias("ord"), F.array("symbol_key").alias("sha256"), F.array("kb").alias("kb"), "file_version")

    arrivals = (fx.spark.readStream.schema(fx.table("orders").schema).option("pathGlobFilter", "orders.parquet").parquet(fx.folder))
    store = scratch_path(fx.spark, "store")
    incremental.merge_available(arrivals, store, scratch_path(fx.spark, "stream"), "key", prepare=prepare)
    return incremental.read_store(fx.spark, store, "key").select("key", F.size("sha256").cast("bigint").alias("sources"), F.array_join("kb", ",").alias("kb"),
                                                          F.coalesce("file_version", F.lit("")).alias("file_version"))

