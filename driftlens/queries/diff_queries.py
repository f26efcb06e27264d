"""Structural diff, rename inference and the feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftlens.functions import names as nm
from driftlens.operators import diffing, renames
from driftlens.plans.feed import Feed
from driftlens.queries.registry import query
from driftlens.queries.sequence_queries import SEQ_VIEWS

# ---- oracle views: the plain, unpruned comparison -------------------------------------------------------

DIF_PAIRS = ("dif_pairs", "select distinct layout as lf, next_layout as lt from seq_runs where next_layout <> layout")
DIF_TYPES = ("dif_types", "select layout, type_name, max(off+sz) as size from fx_members group by layout, type_name")
DIF_TPAIRS = ("dif_tpairs", """
select coalesce(a.lf,b.lf) as lf, coalesce(a.lt,b.lt) as lt, coalesce(a.type_name,b.type_name) as type_name, a.size as size_from, b.size as size_to
 from (select lf, lt, type_name, size from dif_pairs join dif_types on layout = lf) a
 full join (select lf, lt, type_name, size from dif_pairs join dif_types on layout = lt) b on a.lf=b.lf and a.lt=b.lt and a.type_name=b.type_name""")
DIF_MEMBERS = ("dif_members", """
select p.lf, p.lt, p.type_name, coalesce(a.member,b.member) as member, a.member as m1, b.member as m2, a.off as off1, b.off as off2, a.sz as sz1, b.sz as sz2,
  a.bit_position as bp1, b.bit_position as bp2, a.bit_count as bc1, b.bit_count as bc2, a.mtype as t1, b.mtype as t2
 from (select lf, lt, type_name from dif_tpairs where size_from is not null and size_to is not null) p
 join (select lf, lt, type_name, member from dif_pairs join fx_members on layout = lf union select lf, lt, type_name, member from dif_pairs join fx_members on layout = lt) u
   on p.lf=u.lf and p.lt=u.lt and p.type_name=u.type_name
 left join fx_members a on a.layout=p.lf and a.type_name=p.type_name and a.member=u.member
 left join fx_members b on b.layout=p.lt and b.type_name=p.type_name and b.member=u.member""")
DIF_SIGS = ("dif_sigs", """
select lf, lt, type_name, coalesce(off1,off2) as off, coalesce(sz1,sz2) as sz, coalesce(bp1,bp2) as bp, coalesce(bc1,bc2) as bc,
  count(m1) as removed, count(m2) as added, max(m1) as old, max(m2) as new
 from dif_members where m1 is null or m2 is null group by 1,2,3,4,5,6,7 having count(m1) > 0 and count(m2) > 0""")
FILLER = "(regexp_matches({c}, '(Spare|Padding|Pad|Reserved|Available|Unused|Filler)(Bytes?|Words?|Longs?|Ptrs?|Bits?|Dword|Qword|Uchar|Ulong|Ushort)?[0-9]*[a-z]?$') or regexp_matches({c}, '^(Reserved|Spare|Unused|Padding|Filler)[A-Z0-9_]'))"
OLD_F, NEW_F = FILLER.format(c="old"), FILLER.format(c="new")
DIF_REN = ("dif_ren", f"""
select *, case when {OLD_F} and {NEW_F} then 'padding_shuffle' when {OLD_F} or {NEW_F} then 'repurposed' else 'rename' end as rename_kind
 from dif_sigs where removed = 1 and added = 1""")
DIF_CONST = ("dif_const", """
select p.lf, p.lt, u.enum_name, u.name, a.value as v1, b.value as v2 from dif_pairs p
 join (select lf, lt, enum_name, name from dif_pairs join fx_constants on layout=lf union select lf, lt, enum_name, name from dif_pairs join fx_constants on layout=lt) u on p.lf=u.lf and p.lt=u.lt
 left join fx_constants a on a.layout=p.lf and a.enum_name=u.enum_name and a.name=u.name
 left join fx_constants b on b.layout=p.lt and b.enum_name=u.enum_name and b.name=u.name""")
DIF_EPAIRS = ("dif_epairs", """
select p.lf, p.lt, e.enum_name, max(case when e.layout = p.lf then 1 else 0 end) as a, max(case when e.layout = p.lt then 1 else 0 end) as b
 from dif_pairs p join (select distinct layout, enum_name from fx_constants) e on e.layout = p.lf or e.layout = p.lt group by 1,2,3""")
DIF_ENUM = ("dif_enum", """
select c.lf, c.lt, c.enum_name, count(*) filter (where v1 is null) as n_added, count(*) filter (where v2 is null) as n_removed,
  count(*) filter (where v1 is not null and v2 is not null and v1 <> v2) as n_renumbered
 from dif_const c join dif_epairs e on c.lf=e.lf and c.lt=e.lt and c.enum_name=e.enum_name and a=1 and b=1 group by 1,2,3""")
DIF_ENTRY = ("dif_entry", """
select p.lf, p.lt, p.type_name, p.size_from, p.size_to, coalesce(n_added,0)-coalesce(r.n,0) as n_added, coalesce(n_removed,0)-coalesce(r.n,0) as n_removed, coalesce(n_moved,0) as n_moved,
  coalesce(n_resized,0) as n_resized, coalesce(n_rebitted,0) as n_rebitted, coalesce(n_retyped,0) as n_retyped, coalesce(r.n,0) as n_renamed
 from (select * from dif_tpairs where size_from is not null and size_to is not null) p
 left join (select lf, lt, type_name, count(*) filter (where m1 is null) as n_added, count(*) filter (where m2 is null) as n_removed,
   count(*) filter (where off1 <> off2) as n_moved, count(*) filter (where sz1 <> sz2) as n_resized, count(*) filter (where bp1 <> bp2 or bc1 <> bc2) as n_rebitted,
   count(*) filter (where t1 <> '' and t2 <> '' and t1 <> t2) as n_retyped from dif_members group by 1,2,3) m on p.lf=m.lf and p.lt=m.lt and p.type_name=m.type_name
 left join (select lf, lt, type_name, count(*) as n from dif_ren group by 1,2,3) r on p.lf=r.lf and p.lt=r.lt and p.type_name=r.type_name
 where p.size_from <> p.size_to or coalesce(n_added,0)+coalesce(n_removed,0)+coalesce(n_moved,0)+coalesce(n_resized,0)+coalesce(n_rebitted,0)+coalesce(n_retyped,0) > 0""")
DIFF_VIEWS = (*SEQ_VIEWS, DIF_PAIRS, DIF_TYPES, DIF_TPAIRS, DIF_MEMBERS, DIF_SIGS, DIF_REN, DIF_CONST, DIF_EPAIRS, DIF_ENUM, DIF_ENTRY)


def feed(fx, enums: bool = False) -> Feed:
    return Feed(fx.builds(), fx.table("fx_members"), fx.table("fx_constants") if enums else None)


def pair_rows(f: Feed, rows, *columns):
    return f.per_pair(rows).select("layout_from", "layout_to", F.col("name").alias("type_name"), *columns)


def pair_lists(f: Feed, lists, keep, *columns):
    return f.per_pair_lists(lists, keep).select("layout_from", "layout_to", F.col("name").alias("type_name"), *columns)


@query("q_joi1_hash_pruning", """
select lf as layout_from, lt as layout_to, type_name from dif_tpairs where size_from is null or size_to is null
union select lf, lt, type_name from dif_tpairs where size_from <> size_to
union select lf, lt, type_name from dif_members where m1 is null or m2 is null or off1 <> off2 or sz1 <> sz2 or bp1 <> bp2 or bc1 <> bc2 or t1 <> t2""", *DIFF_VIEWS)
def _(fx):
    return feed(fx).names.select("layout_from", "layout_to", F.col("name").alias("type_name"))


# Qualified member names stand for types here, because every layout of the fixture holds the same type names.
DIF_NAMED = ("dif_named", "select layout, type_name||'.'||member as type_name, max(off+sz) as size from fx_members group by 1, 2")


@query("q_joi2_type_status", """
select p.lf as layout_from, p.lt as layout_to, n.type_name, case when max(case when n.layout = p.lf then 1 else 0 end) = 1 then 'removed' else 'added' end as status,
  max(case when n.layout = p.lf then n.size else -1 end) as size_from, max(case when n.layout = p.lt then n.size else -1 end) as size_to
from dif_pairs p join dif_named n on n.layout = p.lf or n.layout = p.lt group by 1,2,3 having count(*) = 1""", *DIFF_VIEWS, DIF_NAMED)
def _(fx):
    named = fx.table("fx_members").withColumn("type_name", F.concat_ws(".", "type_name", "member"))
    return Feed(fx.builds(), named).status.fillna(-1, ["size_from", "size_to"]).select(
        "layout_from", "layout_to", F.col("name").alias("type_name"), "status", "size_from", "size_to")


@query("q_joi3_members_added_removed", """
select lf as layout_from, lt as layout_to, d.type_name, d.member, case when m1 is null then 'added' else 'removed' end as list from dif_members d
 where (m1 is null and not exists (select 1 from dif_ren r where r.lf=d.lf and r.lt=d.lt and r.type_name=d.type_name and r.new=d.member))
    or (m2 is null and not exists (select 1 from dif_ren r where r.lf=d.lf and r.lt=d.lt and r.type_name=d.type_name and r.old=d.member))""", *DIFF_VIEWS)
def _(fx):
    f = feed(fx)
    return pair_lists(f, renames.one_sided_lists(f.sides_of(renames.SIGNATURE)), None, "member", "list")


@query("q_joi4_moved", "select lf as layout_from, lt as layout_to, type_name, member, off1 as was, off2 as now from dif_members where off1 <> off2", *DIFF_VIEWS)
def _(fx):
    f = feed(fx)
    return pair_lists(f, f.lists_of(["off"]), diffing.is_moved, "member", F.col("off_from").alias("was"), F.col("off_to").alias("now"))


@query("q_joi5_resized", "select lf as layout_from, lt as layout_to, type_name, member, sz1 as was, sz2 as now from dif_members where sz1 <> sz2", *DIFF_VIEWS)
def _(fx):
    f = feed(fx)
    return pair_lists(f, f.lists_of(["sz"]), diffing.is_resized, "member", F.col("sz_from").alias("was"), F.col("sz_to").alias("now"))


@query("q_joi6_retyped", "select lf as layout_from, lt as layout_to, type_name, member, t1 as was, t2 as now from dif_members where t1 <> '' and t2 <> '' and t1 <> t2", *DIFF_VIEWS)
def _(fx):
    f = feed(fx)
    return pair_lists(f, f.lists_of(["mtype"]), diffing.is_retyped, "member", F.col("mtype_from").alias("was"), F.col("mtype_to").alias("now"))


@query("q_joi7_rebitted", """
select lf as layout_from, lt as layout_to, type_name, member, cast(bp1 as varchar)||':'||cast(bc1 as varchar) as was, cast(bp2 as varchar)||':'||cast(bc2 as varchar) as now
from dif_members where bp1 <> bp2 or bc1 <> bc2""", *DIFF_VIEWS)
def _(fx):
    f = feed(fx)
    return pair_lists(f, f.lists_of(["bit_position", "bit_count"]), diffing.is_rebitted, "member", diffing.bits("_from").alias("was"), diffing.bits("_to").alias("now"))


@query("q_joi8_type_entries", """
select lf as layout_from, lt as layout_to, type_name, size_from, size_to, n_added, n_removed, n_moved, n_resized, n_rebitted, n_retyped, n_renamed from dif_entry""", *DIFF_VIEWS)
def _(fx):
    return feed(fx).entries.select("layout_from", "layout_to", F.col("name").alias("type_name"), "size_from", "size_to",
                                   *[f"n_{name}" for name in diffing.LISTS if name != "renumbered"])


@query("q_joi9_enum_diff", """
select lf as layout_from, lt as layout_to, enum_name, case when a=0 then 'added' else 'removed' end as status, 0 as n_added, 0 as n_removed, 0 as n_renumbered from dif_epairs where a=0 or b=0
union all select lf, lt, enum_name, 'changed', n_added, n_removed, n_renumbered from dif_enum where n_added+n_removed+n_renumbered > 0""", *DIFF_VIEWS)
def _(fx):
    f = Feed(fx.builds(), None, fx.table("fx_constants"))
    counts = ["n_added", "n_removed", "n_renumbered"]
    changed = f.entries.filter(F.col("kind") == "enum").select(*diffing.PAIR, "name", F.lit("changed").alias("status"), *counts)
    gone = f.status.filter(F.col("kind") == "enum").select(*diffing.PAIR, "name", "status", *[F.lit(0).cast("bigint").alias(c) for c in counts])
    return changed.unionByName(gone).withColumnRenamed("name", "enum_name")


FEED_SQL = """
select r.label, r.machine, r.symbol_key as from_key, r.next_key as to_key, coalesce(r.file_version,'') as from_version, coalesce(r.next_version,'') as to_version,
  r.kb as from_kb, r.next_kb as kb, coalesce(r.next_date,'') as date, r.layout as layout_from, r.next_layout as layout_to,
  coalesce(s.n,0)+coalesce(e.n,0) as types_changed, coalesce(es.n,0)+coalesce(ee.n,0) as enums_changed,
  coalesce(e.m,0) as members_moved, coalesce(e.r,0) as members_renamed
from seq_runs r
 left join (select lf, lt, count(*) as n from dif_tpairs where size_from is null or size_to is null group by 1,2) s on s.lf=r.layout and s.lt=r.next_layout
 left join (select lf, lt, count(*) as n, cast(sum(n_moved) as bigint) as m, cast(sum(n_renamed) as bigint) as r from dif_entry group by 1,2) e on e.lf=r.layout and e.lt=r.next_layout
 left join (select lf, lt, count(*) as n from dif_epairs where a=0 or b=0 group by 1,2) es on es.lf=r.layout and es.lt=r.next_layout
 left join (select lf, lt, count(*) as n from dif_enum where n_added+n_removed+n_renumbered > 0 group by 1,2) ee on ee.lf=r.layout and ee.lt=r.next_layout
where r.next_layout <> r.layout"""


@query("q_joi10_feed", FEED_SQL, *DIFF_VIEWS)
def _(fx):
    return feed(fx, enums=True).summary().fillna("", ["from_version", "to_version", "date"]).select(
        "label", "machine", "from_key", "to_key", "from_version", "to_version", F.array_join("from_kb", "/").alias("from_kb"),
        F.array_join("kb", "/").alias("kb"), "date", "layout_from", "layout_to", "types_changed", "enums_changed",
        F.col("n_moved").alias("members_moved"), F.col("n_renamed").alias("members_renamed"))


# ---- renames ------------------------------------------------------------------------------------------

@query("q_ren1_signatures", """
select lf as layout_from, lt as layout_to, type_name, off, sz, bp as bit_position, bc as bit_count, removed, added from dif_sigs""", *DIFF_VIEWS)
def _(fx):
    f = feed(fx)
    return pair_lists(f, f.signature_lists, None, *renames.SIGNATURE, "removed", "added")


@query("q_ren2_confirmed", "select lf as layout_from, lt as layout_to, type_name, off, sz, old, new from dif_ren", *DIFF_VIEWS)
def _(fx):
    f = feed(fx)
    return pair_lists(f, f.signature_lists, renames.one_to_one, "off", "sz", "old", "new")


@query("q_ren3_ambiguous", """
select d.lf as layout_from, d.lt as layout_to, d.type_name, s.off, s.sz, d.member, case when m2 is null then 'removed' else 'added' end as side, s.removed, s.added
from dif_members d join dif_sigs s on s.lf=d.lf and s.lt=d.lt and s.type_name=d.type_name and s.off=coalesce(off1,off2) and s.sz=coalesce(sz1,sz2)
 and s.bp=coalesce(bp1,bp2) and s.bc=coalesce(bc1,bc2) where (m1 is null or m2 is null) and not (removed = 1 and added = 1)""", *DIFF_VIEWS)
def _(fx):
    f = feed(fx)
    return pair_lists(f, renames.ambiguous_lists(f.sides_of(renames.SIGNATURE)), None, "off", "sz", "member", "side", "removed", "added")


@query("q_ren4_rename_kind", "select lf as layout_from, lt as layout_to, type_name, old, new, rename_kind from dif_ren", *DIFF_VIEWS)
def _(fx):
    f = feed(fx)
    return pair_lists(f, f.signature_lists, renames.one_to_one, "old", "new", renames.rename_kind(F.col("old"), F.col("new")).alias("rename_kind"))


USED = """(select d.*, r.label, r.machine, r.ord, row_number() over (partition by d.type_name, d.old, d.new, d.rename_kind order by r.label, r.machine, r.ord) as nth
  from dif_ren d join seq_runs r on r.layout=d.lf and r.next_layout=d.lt) u"""


@query("q_ren5_aliases", f"""
select type_name as type, old, new, max(off) filter (where nth=1) as off, max(sz) filter (where nth=1) as sz, count(*) as observations
from {USED} where rename_kind = 'rename' group by 1,2,3""", *DIFF_VIEWS)
def _(fx):
    return renames.alias_table(feed(fx).used_renames).drop("bit_position", "bit_count")


@query("q_ren6_review", f"""
select type_name as type, old, new, rename_kind, max(off) filter (where nth=1) as off, max(sz) filter (where nth=1) as sz,
  max(bp) filter (where nth=1) as bit_position, max(bc) filter (where nth=1) as bit_count, count(*) as observations
from {USED} where rename_kind <> 'rename' group by 1,2,3,4""", *DIFF_VIEWS)
def _(fx):
    return renames.filler_transitions(feed(fx).used_renames)


# Every question of every pair with its two sorted lists; equal ones of several pairs count once.
DIF_ASKED = ("dif_asked", """
select distinct d.type_name, s.off, s.sz, s.bp, s.bc, string_agg(m1, ',' order by m1) as removed, string_agg(m2, ',' order by m2) as added
 from dif_members d join dif_sigs s on d.lf = s.lf and d.lt = s.lt and d.type_name = s.type_name and coalesce(off1,off2) = s.off and coalesce(sz1,sz2) = s.sz and coalesce(bp1,bp2) = s.bp and coalesce(bc1,bc2) = s.bc
 where (m1 is null or m2 is null) and not (s.removed = 1 and s.added = 1) group by d.lf, d.lt, d.type_name, s.off, s.sz, s.bp, s.bc""")


@query("q_ren6_questions", """
select type_name as type, off, sz, bp as bit_position, bc as bit_count, removed, added from dif_asked""", *DIFF_VIEWS, DIF_ASKED)
def _(fx):
    return feed(fx).questions.select("type", *renames.SIGNATURE, F.array_join("gone", ",").alias("removed"), F.array_join("came", ",").alias("added"))


@query("q_ren7_summary", """
select rename_kind, count(*) as pairs from (select distinct type_name, old, new, rename_kind from dif_ren) t group by 1
union all select 'ambiguous', count(*) from dif_asked having count(*) > 0""", *DIFF_VIEWS, DIF_ASKED)
def _(fx):
    f = feed(fx)
    asked = f.questions.agg(F.count("*").alias("pairs")).filter("pairs > 0")
    return renames.distinct_pairs(f.used_renames).groupBy("rename_kind").agg(F.count("*").alias("pairs")).unionByName(asked.select(F.lit("ambiguous").alias("rename_kind"), "pairs"))


@query("q_fil8_filler_names", f"select distinct member, case when {FILLER.format(c='member')} then 'filler' else 'field' end as kind from fx_members")
def _(fx):
    kind = F.when(nm.is_filler(F.col("member")), "filler").otherwise("field")
    return fx.table("fx_members").select("member").distinct().withColumn("kind", kind)
