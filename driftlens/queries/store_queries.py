"""Content addressing, dictionary encoding, verification and index tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftlens.functions import names as nm
from driftlens.operators import catalogue, diffing, dictionary, hashing, sequences, verify
from driftlens.queries.registry import query
from driftlens.queries.sequence_queries import SEQ_VIEWS, vk
from driftlens.runtime import durable

HSH_T = ("hsh_t", """
select layout, type_name as name, max(off+sz) as size, 'T '||type_name||' '||max(off+sz)||chr(10)||string_agg('M '||off||' '||member||' '||sz||' '||bit_position||' '||bit_count||' '||mtype, chr(10) order by off, member) as text
from fx_members group by layout, type_name""")
HSH_E = ("hsh_e", """
select layout, enum_name as name, max(enum_size) as size, 'E '||enum_name||' '||max(enum_size)||chr(10)||string_agg('C '||value||' '||name, chr(10) order by value, name) as text from fx_constants group by layout, enum_name""")
HSH_M = ("hsh_m", """
select layout, 'type' as kind, name, size, substr(sha256(text),1,12) as blob from hsh_t union all select layout, 'enum', name, size, substr(sha256(text),1,12) from hsh_e""")
HSH_L = ("hsh_l", """
select t.layout, 'v2:sha256:'||sha256(t.text||chr(10)||e.text||chr(10)) as hash from (select layout, string_agg(text, chr(10) order by name) as text from hsh_t group by layout) t
join (select layout, string_agg(text, chr(10) order by name) as text from hsh_e group by layout) e on e.layout = t.layout""")
HSH = (HSH_T, HSH_E, HSH_M, HSH_L)


def type_lines(fx):
    return hashing.type_lines(fx.table("fx_members"), fx.types())


def all_lines(fx):
    return type_lines(fx).unionByName(hashing.enum_lines(fx.table("fx_constants")))


def second_sizes(fx):
    return fx.table("fx_members_b").groupBy("layout", "type_name").agg(F.max(F.col("off") + F.col("sz")).alias("type_size"))


def second_lines(fx):
    return hashing.type_lines(fx.table("fx_members_b"), second_sizes(fx))


def full_manifest(fx):
    return durable(hashing.manifest(all_lines(fx)), "manifest")


@query("q_hsh1_canonical_types", "select layout, name, sha256(text) as digest from hsh_t", *HSH)
def _(fx):
    return hashing.digest_lines(type_lines(fx), hashing.BODY, hashing.LINE_ORDER, False).select("layout", "name", "digest")


@query("q_hsh2_canonical_enums", "select layout, name, sha256(text) as digest from hsh_e", *HSH)
def _(fx):
    return hashing.digest_lines(hashing.enum_lines(fx.table("fx_constants")), hashing.BODY, hashing.LINE_ORDER, False).select("layout", "name", "digest")


@query("q_hsh3_blob_ids", "select * from hsh_m", *HSH)
def _(fx):
    return hashing.manifest(all_lines(fx))


@query("q_hsh4_layout_hash", "select * from hsh_l", *HSH)
def _(fx):
    return hashing.layout_hash(all_lines(fx))


VER_T = ("ver_t", """
select layout, type_name as name, max(off+sz) as size, 'T '||type_name||' '||max(off+sz)||chr(10)||string_agg('M '||off||' '||member||' '||sz||' '||bit_position||' '||bit_count||' '||mtype, chr(10) order by off, member) as text
from fx_members_b group by layout, type_name""")


@query("q_hsh5_new_blobs", """
select 'blob' as kind, name, blob as id, 'new' as outcome from (select distinct name, blob from hsh_m where kind = 'type') t where blob not in (select substr(sha256(text),1,12) from ver_t)
union all select 'layout', '', hash, case when layout in (select layout from fx_builds where machine = 'x86') then 'reused' else 'written' end from hsh_l""", *HSH, VER_T)
def _(fx):
    fx.written("fx_members", "fx_members_b")
    found = hashing.manifest(type_lines(fx))
    stored = hashing.manifest(second_lines(fx)).select("blob").distinct()
    hashes = durable(hashing.layout_hash(all_lines(fx)), "hashes")
    held = hashes.join(fx.builds().filter("machine = 'x86'").select("layout").distinct(), "layout", "left_semi")
    return hashing.new_blobs(found, stored).select(F.lit("blob").alias("kind"), "name", F.col("blob").alias("id"), F.lit("new").alias("outcome")).unionByName(
        hashing.new_layouts(hashes, held).select(F.lit("layout").alias("kind"), F.lit("").alias("name"), F.col("hash").alias("id"), "outcome"))


@query("q_hsh6_documents", """
select layout, type_name as name, md5('{"name":"'||type_name||'","kind":"type","size":'||max(off+sz)||',"members":['||string_agg('{"name":"'||member||'","type":"'||mtype||'","offset":'||off||',"size":'||sz||
  ',"bit_position":'||bit_position||',"bit_count":'||bit_count||'}', ',' order by off, member)||']}') as document from fx_members group by layout, type_name
union all select layout, enum_name, md5('{"name":"'||enum_name||'","kind":"enum","size":'||max(enum_size)||',"constants":['||string_agg('{"name":"'||name||'","value":'||value||'}', ',' order by value, name)||']}')
 from fx_constants group by layout, enum_name""")
def _(fx):
    types = hashing.type_documents(fx.table("fx_members"), fx.types())
    enums = hashing.enum_documents(fx.table("fx_constants"))
    return types.select("layout", F.col("document.name").alias("name"), F.md5(F.to_json("document")).alias("document")).unionByName(
        enums.select("layout", F.col("document.name").alias("name"), F.md5(F.to_json("document")).alias("document")))


@query("q_hsh7_reachable", """
select 'manifest' as kind, count(*) as n from hsh_m where layout in (select layout from fx_builds)
union all select 'blobs', count(distinct blob) from hsh_m where layout in (select layout from fx_builds) and blob not like '0%'
union all select 'dangling', count(*) from (select distinct cast(layout as varchar) from fx_builds where layout not in (select layout from hsh_m) union all select distinct blob from hsh_m where layout in (select layout from fx_builds) and blob like '0%') t""", *HSH)
def _(fx):
    found = full_manifest(fx)
    # Some bodies are missing from the store.
    blobs, builds = found.select("blob").distinct().filter("blob not like '0%'"), fx.builds()
    live, bodies = hashing.reachable(builds, found, blobs)
    lost = hashing.dangling(builds, found, blobs)

    def total(df, kind):
        return df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")

    return total(live, "manifest").unionByName(total(bodies, "blobs")).unionByName(total(lost, "dangling"))


@query("q_hsh8_body_sample", """
select symbol_key, kind, name from (select b.symbol_key, m.kind, m.name, row_number() over (partition by b.symbol_key order by sha256(b.symbol_key||'/'||m.name), m.name, m.kind) as nth
 from fx_builds b join hsh_m m on m.layout = b.layout) t where nth <= 5""", *HSH)
def _(fx):
    listed = fx.builds().select("symbol_key", "layout").join(diffing.type_bodies(fx.table("fx_members")).select("layout", "kind", "name").unionByName(
        diffing.enum_bodies(fx.table("fx_constants")).select("layout", "kind", "name")), "layout")
    return hashing.body_sample(listed, 5).select("symbol_key", "kind", "name")


@query("q_hsh9_seeded_sample", "select symbol_key from fx_builds order by sha256('7/'||symbol_key), symbol_key limit 200")
def _(fx):
    return hashing.seeded_sample(fx.builds(), 200, 7).select("symbol_key")


@query("q_hsh10_exact_duplicates", """
select distinct l_orderkey - l_orderkey % 100 as layout, 'E_' || l_returnflag as enum_name, l_suppkey % 4 - 1 as value, 'C' || cast(l_linenumber as varchar) as name from lineitem""")
def _(fx):
    return hashing.drop_exact_duplicates(fx.sql("""
select l_orderkey - l_orderkey % 100 as layout, 'E_' || l_returnflag as enum_name, l_suppkey % 4 - 1 as value, 'C' || cast(l_linenumber as string) as name from lineitem"""))


# ---- dictionary ---------------------------------------------------------------------------------------

# The stored dictionary knows the names of the first fiftieth of all builds, about half of all names at any size; the rest is appended.
DIC_OLD = ("dic_old", "select name, row_number() over (order by min(build), name) - 1 as pos from fx_symbols where cast(build as bigint) * 50 <= (select max(cast(build as bigint)) from fx_symbols) group by name")
DIC_ALL = ("dic_all", """
select name, pos from dic_old union all select name, (select count(*) from dic_old) + row_number() over (order by min(build), name) - 1 from fx_symbols
 where name not in (select name from dic_old) group by name""")
DIC = (DIC_OLD, DIC_ALL)


def stored_dictionary(fx):
    early = fx.sql("select * from fx_symbols where cast(build as bigint) * 50 <= (select max(cast(build as bigint)) from fx_symbols)")
    return dictionary.extend(None, early)


def full_dictionary(fx):
    return dictionary.extend(stored_dictionary(fx), fx.table("fx_symbols"))


@query("q_dic1_dictionary", "select pos, name from dic_all", *DIC)
def _(fx):
    return full_dictionary(fx)


DIC_BYTES = ("dic_bytes", """
select build, pos // 8 as byte, sum(1 << (pos % 8)) as value from fx_symbols join dic_all using (name) group by 1, 2""")


@query("q_dic2_bitmaps", """
select d.build, d.symbols, c.symbol_count, c.addresses, (select count(*) from dic_all) as universe_size from (
select s.build, base64(from_hex(string_agg(lpad(to_hex(coalesce(b.value, 0)), 2, '0'), '' order by s.byte))) as symbols
from (select build, unnest(range(0, max(byte) + 1)) as byte from dic_bytes group by build) s left join dic_bytes b on b.build = s.build and b.byte = s.byte group by s.build) d
join (select build, count(*) as symbol_count, string_agg(rva, ',' order by pos) as addresses from fx_symbols join dic_all using (name) group by build) c on c.build = d.build""", *DIC, DIC_BYTES)
def _(fx):
    universe = durable(full_dictionary(fx), "dictionary")
    placed = durable(dictionary.placed(fx.table("fx_symbols"), universe), "placed")
    made = dictionary.document(dictionary.bitmaps(placed), dictionary.ranked(placed), universe.count())
    return made.select("build", "symbols", "symbol_count", F.array_join(F.col("rva").cast("array<string>"), ",").alias("addresses"), "universe_size")


@query("q_dic3_address_order", """
select build, row_number() over (partition by build order by pos) as nth, rva from fx_symbols join dic_all using (name)""", *DIC)
def _(fx):
    return dictionary.ranked(dictionary.placed(fx.table("fx_symbols"), full_dictionary(fx))).select("build", "nth", "rva")


@query("q_dic4_decode", "select build, name, rva from fx_symbols where name in (select name from dic_old)", *DIC)
def _(fx):
    universe = durable(full_dictionary(fx), "dictionary")
    placed = durable(dictionary.placed(fx.table("fx_symbols"), universe), "placed")
    # The reader holds the older dictionary: later names are unknown to it, their addresses still count.
    return dictionary.decode(dictionary.bitmaps(placed), dictionary.ranked(placed).select("build", "nth", "rva"), stored_dictionary(fx))


DIC_REC = ("dic_rec", """
select lpad(cast(l_orderkey as string),12,'0') as build, 'Sym' || cast(l_partkey % 50 as string) as name, (l_suppkey * 100000 + l_partkey) * 10 + l_linenumber as ord,
  case when l_suppkey % 5 = 0 then null else 4096*l_suppkey + l_linenumber end as rva from lineitem""")


@query("q_dic5_first_wins", "select build, name, arg_min(rva, ord) as rva from dic_rec where rva is not null group by build, name", DIC_REC)
def _(fx):
    return dictionary.first_wins(fx.sql(DIC_REC[1]))


@query("q_dic6_preferred_source", """
select build, name, arg_min(rva, ord + case when l_returnflag = 'A' then 0 else 1000000000000 end) as rva from
 (select lpad(cast(l_orderkey as string),12,'0') as build, 'Sym' || cast(l_partkey % 50 as string) as name, (l_suppkey * 100000 + l_partkey) * 10 + l_linenumber as ord,
  case when l_suppkey % 5 = 0 then 0 else 4096*l_suppkey + l_linenumber end as rva, l_returnflag from lineitem where l_returnflag <> 'R') t where rva <> 0 group by 1, 2""")
def _(fx):
    records = fx.sql("""select lpad(cast(l_orderkey as string),12,'0') as build, 'Sym' || cast(l_partkey % 50 as string) as name, (l_suppkey * 100000 + l_partkey) * 10 + l_linenumber as ord,
  case when l_suppkey % 5 = 0 then 0 else 4096*l_suppkey + l_linenumber end as rva, case l_returnflag when 'A' then 'data' when 'N' then 'public' else 'thunk' end as tag from lineitem""")
    return dictionary.first_non_zero(records)


@query("q_fil5_plain_globals", """
select case when name <> '' and not starts_with(name,'__imp_') and not regexp_matches(name,'[?$@]') then 'plain' else 'other' end as kind, count(*) as n from
 (select case l_linenumber when 1 then '__imp_' when 2 then '?' when 3 then '' else 'Sym' end || case when l_linenumber = 4 then '@' else '' end || case when l_linenumber = 3 then '' else cast(l_partkey as varchar) end as name from lineitem) t group by 1""")
def _(fx):
    symbols = fx.sql("select case l_linenumber when 1 then '__imp_' when 2 then '?' when 3 then '' else 'Sym' end || case when l_linenumber = 4 then '@' else '' end || case when l_linenumber = 3 then '' else cast(l_partkey as string) end as name from lineitem")
    return symbols.groupBy(F.when(nm.is_plain_global(F.col("name")), "plain").otherwise("other").alias("kind")).agg(F.count("*").alias("n"))


# ---- verification -------------------------------------------------------------------------------------

VER_NAMES = ("ver_names", """
select coalesce(a.layout, b.layout) as layout, coalesce(a.name, b.name) as name, substr(sha256(a.text),1,12) as blob_published, substr(sha256(b.text),1,12) as blob_ours
from hsh_t a full join ver_t b on a.layout = b.layout and a.name = b.name""")


def published(fx):
    m = fx.table("fx_members")
    blobs = hashing.manifest(type_lines(fx))
    bodies = diffing.type_bodies(m, fx.types()).select("layout", "kind", "name", F.col("blob").alias("body"))
    return blobs.join(bodies, ["layout", "kind", "name"]).withColumn("symbol_key", F.col("layout"))


def reread(fx):
    bodies = diffing.type_bodies(fx.table("fx_members_b"), second_sizes(fx)).select("layout", "kind", "name", F.col("blob").alias("body"))
    return hashing.manifest(second_lines(fx)).join(bodies, ["layout", "kind", "name"]).withColumn("symbol_key", F.col("layout"))


@query("q_joi19_verify_types", """
select layout, name, name||': content hash '||blob_ours||' != manifest '||blob_published as problem from ver_names where blob_ours <> blob_published
union all select layout, name, name||case when blob_ours is null then ': published but not in the extraction' else ': extracted but not published' end from ver_names where blob_ours is null or blob_published is null""",
       *HSH, VER_T, VER_NAMES)
def _(fx):
    fx.written("fx_members", "fx_members_b")
    return verify.name_problems(published(fx), reread(fx), "type").select(F.col("symbol_key").alias("layout"), "name", "problem")


def enum_side(rows):
    bodies = diffing.enum_bodies(rows).select("layout", "kind", "name", F.col("blob").alias("body"))
    return hashing.manifest(hashing.enum_lines(rows)).join(bodies, ["layout", "kind", "name"]).withColumn("symbol_key", F.col("layout"))


@query("q_joi20_verify_enums", """
select a.layout, a.name, a.name||case when substr(sha256(a.text),1,12) <> substr(sha256(b.text),1,12) then ': enum hash '||substr(sha256(b.text),1,12)||' != manifest '||substr(sha256(a.text),1,12)
   else ': published enum differs from its own hash' end as problem
from hsh_e a join (select layout, enum_name as name, 'E '||enum_name||' '||max(enum_size)||chr(10)||string_agg('C '||value||' '||name, chr(10) order by value, name) as text
 from (select layout, enum_name, enum_size, name, case when name = 'C10' then value + 1 else value end as value from fx_constants) c group by 1, 2) b on a.layout = b.layout and a.name = b.name
where a.text <> b.text or a.name = 'E_N'""", *HSH)
def _(fx):
    constants = fx.table("fx_constants")
    again = constants.withColumn("value", F.when(F.col("name") == "C10", F.col("value") + 1).otherwise(F.col("value")))

    # Stored bodies of one enum were overwritten after hashing.
    listed = enum_side(constants).withColumn("body", F.when(F.col("name") == "E_N", F.lit("tampered")).otherwise(F.col("body")))
    return verify.name_problems(listed, enum_side(again), "enum").select(F.col("symbol_key").alias("layout"), "name", "problem")


VER_SYM = ("ver_sym", """
select coalesce(a.build, b.build) as build, coalesce(a.name, b.name) as name, a.rva as ours, b.rva as published,
 case when b.rva is null then 'missing' when a.rva is null then 'extra' when a.rva <> b.rva then 'wrong' end as state
from fx_symbols a full join (select build, name, case when rva % 7 = 0 then rva + 16 else rva end as rva from fx_symbols where rva % 11 <> 0 union all select build, 'SymNew', 64 from fx_symbols group by build) b
 on a.build = b.build and a.name = b.name""")


@query("q_joi21_verify_symbols", """
select build, state, problem from (
 select build, state, max(n)||case state when 'missing' then ' symbol(s) extracted but not published, e.g. ' else ' symbol(s) published but not extracted, e.g. ' end||'['''||string_agg(name, ''', ''' order by name)||''']' as problem
  from (select *, count(*) over (partition by build, state) as n, row_number() over (partition by build, state order by name) as nth from ver_sym where state is not null) t where nth <= 3 and state <> 'wrong' group by build, state
 union all select build, state, name||': RVA 0x'||lower(to_hex(published))||' published, 0x'||lower(to_hex(ours))||' extracted' from
  (select *, row_number() over (partition by build order by name) as nth from ver_sym where state = 'wrong') t where nth <= 5
 union all select build, 'wrong', '... and '||(count(*) - 5)||' more RVA mismatches' from ver_sym where state = 'wrong' group by build having count(*) > 5) p""", VER_SYM)
def _(fx):
    ours = fx.table("fx_symbols")
    stated = ours.filter(F.col("rva") % 11 != 0).withColumn("rva", F.when(F.col("rva") % 7 == 0, F.col("rva") + 16).otherwise(F.col("rva")))
    stated = stated.unionByName(ours.select("build").distinct().select("build", F.lit("SymNew").alias("name"), F.lit(64).cast("bigint").alias("rva")))
    universe = durable(dictionary.extend(None, stated), "dictionary")
    placed = durable(dictionary.placed(stated, universe), "placed")
    decoded = dictionary.decode(dictionary.bitmaps(placed), dictionary.ranked(placed).select("build", "nth", "rva"), universe)
    return verify.symbol_problems(durable(verify.symbol_sides(decoded, ours), "symbols"))


# Some layouts could not be re-derived, and of some the re-derived hash differs.
VER_GATE = ("ver_gate", """
select l.layout, l.hash as published, case when l.layout % 700 = 0 then null when l.layout % 200 = 0 then 'v2:sha256:'||sha256(l.hash) else l.hash end as ours from hsh_l l""")


def gate(fx):
    hashes = hashing.layout_hash(all_lines(fx)).withColumnRenamed("layout", "symbol_key")
    again = hashes.filter("symbol_key % 700 <> 0").withColumn("hash", F.when(F.col("symbol_key") % 200 == 0, F.concat(F.lit("v2:sha256:"), F.sha2("hash", 256))).otherwise(F.col("hash")))
    return verify.layout_gate(hashes, again)


@query("q_joi22_layout_gate", """
select layout as symbol_key, 'layout' as check, '' as name, 'layout hash '||ours||' != published '||published as problem from ver_gate where ours <> published
union all select layout, 'layout', '', 'could not be re-derived' from ver_gate where ours is null
union all select layout, 'type', name, name||': content hash '||blob_ours||' != manifest '||blob_published from ver_names where blob_ours <> blob_published and layout % 200 <> 0 and layout % 700 <> 0
union all select layout, 'type', name, name||case when blob_ours is null then ': published but not in the extraction' else ': extracted but not published' end from ver_names where (blob_ours is null or blob_published is null) and layout % 200 <> 0 and layout % 700 <> 0""",
       *HSH, VER_T, VER_NAMES, VER_GATE)
def _(fx):
    fx.written("fx_members", "fx_members_b")
    g = durable(gate(fx), "gate")
    later = verify.name_problems(verify.only_passing(published(fx), g), verify.only_passing(reread(fx), g), "type")
    return verify.gate_problems(g).unionByName(later)


@query("q_joi23_verify_summary", """
select verdict, count(*) as builds, cast(sum(n) as bigint) as problems, cast(sum(least(n,5)) as bigint) as shown from (
 select g.layout, coalesce(p.n, 0) as n, case when g.ours is null then 'ERROR' when p.n is null then 'PASS' else 'FAIL' end as verdict from ver_gate g left join
  (select layout, sum(n) as n from (
    select layout, count(*) as n from ver_names where (blob_ours is null or blob_published is null or blob_ours <> blob_published) and layout % 200 <> 0 and layout % 700 <> 0 group by layout
    union all select layout, 1 from ver_gate where ours is null or ours <> published
    union all select layout, count(distinct enum_name) from fx_constants where name = 'C10' and layout % 200 <> 0 and layout % 700 <> 0 group by layout) q group by layout) p on p.layout = g.layout) t group by verdict""", *HSH, VER_T, VER_NAMES, VER_GATE)
def _(fx):
    fx.written("fx_members", "fx_members_b", "fx_constants")
    g = durable(gate(fx), "gate")
    constants = fx.table("fx_constants")
    again = constants.filter("name <> 'C10'").unionByName(constants.filter("name = 'C10'").withColumn("value", F.col("value") + 1))
    types = verify.name_problems(verify.only_passing(published(fx), g), verify.only_passing(reread(fx), g), "type")
    enums = verify.name_problems(verify.only_passing(enum_side(constants), g), verify.only_passing(enum_side(again), g), "enum")
    problems = durable(verify.gate_problems(g).unionByName(types).unionByName(enums), "problems")
    verdicts, shown = verify.summary(g.select("symbol_key"), g, problems)
    listed = shown.groupBy("symbol_key").agg(F.count("*").alias("shown"))
    return verdicts.join(listed, "symbol_key", "left").fillna(0, ["shown"]).groupBy("verdict").agg(
        F.count("*").alias("builds"), F.sum("problems").alias("problems"), F.sum("shown").alias("shown"))


# ---- index tables -------------------------------------------------------------------------------------

@query("q_agg6_by_version", "select file_version as version, symbol_key as key from fx_builds where coalesce(file_version,'') <> ''")
def _(fx):
    return catalogue.by_version(fx.builds())


@query("q_agg7_layout_usage", """
select b.layout, b.n as builds, coalesce(m.t, 0) as types, coalesce(m.e, 0) as enums, row_number() over (order by b.n desc, b.first_key) - 1 as pos
from (select layout, count(*) as n, min(symbol_key) as first_key from fx_builds group by layout) b
left join (select layout, count(*) filter (where kind='type') as t, count(*) filter (where kind='enum') as e from hsh_m group by layout) m on m.layout = b.layout""", *HSH)
def _(fx):
    bodies = diffing.type_bodies(fx.table("fx_members")).unionByName(diffing.enum_bodies(fx.table("fx_constants")))
    return catalogue.layout_usage(fx.builds(), bodies)


@query("q_agg7_layout_keys", "select distinct layout, symbol_key from fx_builds")
def _(fx):
    return catalogue.layout_keys(fx.builds())


AGG8 = f"""
select m.kind, m.name, count(distinct m.blob) as variants, arg_max(m.layout, struct_pack(d := b.d, v := b.v, k := b.k)) as layout from hsh_m m join
 (select layout, coalesce(release_date,'') as d, {vk('file_version')} as v, symbol_key as k from fx_builds) b on b.layout = m.layout group by m.kind, m.name"""


@query("q_agg8_name_catalogue", AGG8, *HSH)
def _(fx):
    return catalogue.name_catalogue(full_manifest(fx), fx.builds())


@query("q_agg9_compact_builds", """
select symbol_key as k, coalesce(file_version,'') as v, machine as m, coalesce(release_date,'') as d, layout as l, kb, n_channels as c, layout % 7 as y, 'image' || cast(layout % 3 as varchar) as n
from fx_builds join (select symbol_key, count(*) as n_channels from fx_build_channels group by symbol_key) c using (symbol_key)""")
def _(fx):
    builds = fx.builds().withColumn("pdb_name", F.concat(F.lit("image"), (F.col("layout") % 3).cast("string"))).withColumn("symbol_count", F.col("layout") % 7)
    return catalogue.compact_builds(builds).fillna("", ["v", "d"]).select(
        "k", "v", "m", "d", F.col("l").cast("bigint").alias("l"), F.array_join("kb", "/").alias("kb"), F.size("c").cast("bigint").alias("c"), "y", "n")


@query("q_agg10_store_stats", """
select (select count(*) from fx_builds) as builds, (select count(distinct layout) from hsh_m) as layouts, (select count(distinct blob) from hsh_m) as blobs, (select count(distinct name) from fx_symbols) as names,
 (select sum(length('{"symbol_key":"'||symbol_key||'"'||coalesce(',"file_version":"'||file_version||'"','')||',"machine":"'||machine||'"'||coalesce(',"release_date":"'||release_date||'"','')||',"kb":["'||kb||'"],"layout":'||layout||',"channel":['||listed||']}'))::bigint
   from fx_builds join (select symbol_key, string_agg('"'||channel||'"', ',') as listed from fx_build_channels group by symbol_key) c using (symbol_key)) as builds_bytes,
 (select sum(length('{"blob":"'||blob||'"}')) from (select distinct blob from hsh_m) t) as blobs_bytes,
 (select sum(length('{"name":"'||name||'"}')) from (select distinct name from fx_symbols) t) as names_bytes, (select round((select count(*) from fx_builds)::double / count(distinct layout), 2) from hsh_m) as dedup""", *HSH)
def _(fx):
    fx.written("fx_members")
    found = full_manifest(fx)
    stats = catalogue.store_stats(fx.builds(), found, found.select("blob").distinct(), fx.table("fx_symbols").select("name").distinct())
    return stats.select("builds", "layouts", "blobs", "names", "builds_bytes", "blobs_bytes", "names_bytes", "dedup")


@query("q_agg13_layout_runs", """
select label, machine, layout, count(*) as builds, coalesce(arg_min(coalesce(file_version,''), ord),'') as first_version, coalesce(arg_max(coalesce(file_version,''), ord),'') as last_version from (
 select *, sum(case when prev = layout then 0 else 1 end) over (partition by label, machine order by ord) as run from (
  select *, lag(layout) over (partition by label, machine order by ord) as prev from seq_runs) a) b group by label, machine, layout, run""", *SEQ_VIEWS)
def _(fx):
    return catalogue.layout_runs(fx.builds()).fillna("", ["first_version", "last_version"]).drop("at")


@query("q_agg13_definition_ranking", f"select kind, name, variants from ({AGG8}) t order by variants desc, kind, name limit 8", *HSH)
def _(fx):
    return catalogue.definition_ranking(catalogue.name_catalogue(full_manifest(fx), fx.builds()), 8).select("kind", "name", "variants")
