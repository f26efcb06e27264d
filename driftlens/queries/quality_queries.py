"""Data-quality rules over the member and constant tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftlens.operators import quality as q
from driftlens.operators import reconcile
from driftlens.plans import validate
from driftlens.queries.diff_queries import DIFF_VIEWS
from driftlens.queries.registry import query
from driftlens.runtime import durable

# Declared sizes that provoke the rules: the last offset instead of the end, and zero for one layout in a thousand bytes.
DQ_TYPES = ("dq_types", """
select layout, type_name, case when layout % 1000 = 0 and type_name = '_RF' then 0 else max(off) end as type_size from fx_members group by layout, type_name
union all select distinct layout, '_EMPTY', 16 from fx_members""")
DQ_SUM = ("dq_sum", "select layout, type_name, max(off) as last_off, count(*) as n from fx_members group by layout, type_name")
DQ_SOUND = ("dq_sound", "select t.*, s.last_off from dq_types t join dq_sum s using (layout, type_name) where type_size <> 0")
# Odd shapes for the row rules, made from the same members.
DQ_ODD = ("dq_odd", """
select layout, type_name, member, off, case when off % 16 = 8 and bit_count = 0 then 0 when bit_count > 2 then 3 else sz end as sz,
 case when sz = 4 and bit_count = 0 then 1 else bit_position end as bit_position, case when bit_count = 2 then 80 else bit_count end as bit_count, mtype from fx_members""")
DQ = (DQ_TYPES, DQ_SUM, DQ_SOUND, DQ_ODD)


def types(fx):
    m = fx.table("fx_members")
    size = F.when((F.col("layout") % 1000 == 0) & (F.col("type_name") == "_RF"), 0).otherwise(F.max("off"))
    empty = m.select("layout").distinct().select("layout", F.lit("_EMPTY").alias("type_name"), F.lit(16).cast("bigint").alias("type_size"))
    return m.groupBy("layout", "type_name").agg(size.cast("bigint").alias("type_size")).unionByName(empty)


def odd(fx):
    return fx.sql(DQ_ODD[1])


def findings(fx, rule):
    members = odd(fx)
    summary = q.type_summary(members, types(fx))
    found = q.check_types(summary).unionByName(q.check_members(members, summary))
    return found.filter(F.col("rule") == rule).select("layout", "severity", "entity", "message")


DQ1_SQL = """
select layout, 'error' as severity, type_name as entity, type_name || ': size is zero (unresolved forward reference?)' as message from dq_types where type_size = 0"""


@query("q_dq1_size_zero", DQ1_SQL, *DQ)
def _(fx):
    return findings(fx, "size_zero")


DQ2_SQL = """
select layout, 'error' as severity, type_name as entity, type_name || ': no members' as message from dq_types t where type_size <> 0
 and not exists (select 1 from dq_sum s where s.layout = t.layout and s.type_name = t.type_name)"""


@query("q_dq2_no_members", DQ2_SQL, *DQ)
def _(fx):
    return findings(fx, "no_members")


DQ3_SQL = """
select layout, 'error' as severity, type_name||'.'||member as entity, type_name||'.'||member||': ends at 0x'||lower(to_hex(off+sz))||', past the 0x'||lower(to_hex(type_size))||' byte struct' as message
from dq_odd join dq_sound using (layout, type_name) where off + sz > type_size"""


@query("q_dq3_past_end", DQ3_SQL, *DQ)
def _(fx):
    return findings(fx, "past_end")


DQ4_SQL = """
select layout, 'warning' as severity, type_name||'.'||member as entity, type_name||'.'||member||': zero sized, not the last member' as message
from dq_odd join dq_sound using (layout, type_name) where sz = 0 and off <> last_off"""


@query("q_dq4_zero_sized", DQ4_SQL, *DQ)
def _(fx):
    return findings(fx, "zero_sized")


DQ5_SQL = """
select layout, 'error' as severity, type_name||'.'||member as entity, type_name||'.'||member||case when sz not in (1,2,4,8) then ': bitfield in a '||cast(sz as varchar)||' byte storage unit'
  else ': bits '||cast(bit_position as varchar)||':'||cast(bit_count as varchar)||' overflow a '||cast(sz as varchar)||' byte unit' end as message
from dq_odd join dq_sound using (layout, type_name) where bit_count <> 0 and (sz not in (1,2,4,8) or bit_position + bit_count > sz * 8)"""


@query("q_dq5_bit_storage", DQ5_SQL, *DQ)
def _(fx):
    return findings(fx, "bit_storage").unionByName(findings(fx, "bit_overflow"))


DQ6_SQL = """
select layout, 'error' as severity, type_name||'.'||member as entity, type_name||'.'||member||': bit geometry on a non-bitfield member' as message
from dq_odd join dq_sound using (layout, type_name) where bit_count = 0 and bit_position <> 0"""


@query("q_dq6_bit_geometry", DQ6_SQL, *DQ)
def _(fx):
    return findings(fx, "bit_geometry")


DQ_ENUMS = ("dq_enums", """
select layout, enum_name, case when layout % 700 = 0 then 3 else 4 end as enum_size from fx_constants group by 1,2
union all select layout, enum_name||'_NONE', 4 from fx_constants group by 1,2""")


def enums(fx):
    return fx.sql(DQ_ENUMS[1])


DQ7_SQL = """
select e.layout, case when n is null then 'warning' else 'error' end as severity, e.enum_name as entity,
  case when n is null then e.enum_name||': enumeration with no constants' else e.enum_name||': enum size '||cast(enum_size as varchar) end as message
from dq_enums e left join (select layout, enum_name, count(*) as n from fx_constants group by 1,2) c on c.layout=e.layout and c.enum_name=e.enum_name where n is null or enum_size not in (1,2,4,8)"""


@query("q_dq7_enum_rules", DQ7_SQL, DQ_ENUMS)
def _(fx):
    return q.check_enums(enums(fx), fx.table("fx_constants")).drop("rule")


DQ_RAW = ("dq_raw", """
select distinct l_orderkey - l_orderkey % 100 as layout, 'E_' || l_returnflag as enum_name, 'C' || cast(l_linenumber as string) || cast(l_partkey % 5 as string) as name,
  l_suppkey % 4 * 90 - 140 as value, 1 as enum_size from lineitem""")


def raw(fx):
    """The constants, written once: rules read them several times."""
    return durable(fx.sql(DQ_RAW[1]), "constants")


DQ8_SQL = """
select layout, 'error' as severity, enum_name||'.'||name as entity, enum_name||'.'||name||': two values, '||cast(prev as varchar)||' and '||cast(value as varchar) as message
from (select *, lag(value) over (partition by layout, enum_name, name order by value) as prev from dq_raw) t where prev <> value"""


@query("q_dq8_two_values", DQ8_SQL, DQ_RAW)
def _(fx):
    return q.check_constant_values(raw(fx)).drop("rule")


DQ9_SQL = """
select layout, 'error' as severity, enum_name||'.'||name as entity, enum_name||'.'||name||' = '||cast(value as varchar)||' does not fit '||cast(enum_size as varchar)||' byte(s)' as message
from dq_raw where value < -128 or value >= 256"""


@query("q_dq9_constant_width", DQ9_SQL, DQ_RAW)
def _(fx):
    return q.check_constant_width(fx.sql(DQ_RAW[1])).drop("rule")


# Offsets stretched, and sizes declared by member count, so that some moves exceed the limit.
DQ_WIDE = ("dq_wide", "select layout, type_name, member, off * 100 as off, sz, bit_position, bit_count, mtype from fx_members")
DQ_CONT = ("dq_cont", """
select p.lf, p.lt, a.type_name, abs(tb.s - ta.s) as grew, count(*) as moved, max(abs(b.off-a.off)) as worst, arg_min(a.member, struct_pack(d := -abs(b.off-a.off), o := b.off, m := a.member)) as worst_member
from dif_pairs p join dq_wide a on a.layout = p.lf join dq_wide b on b.layout = p.lt and b.type_name = a.type_name and b.member = a.member
 join (select layout, type_name, count(*)*64 as s from dq_wide group by 1,2) ta on ta.layout=p.lf and ta.type_name=a.type_name
 join (select layout, type_name, count(*)*64 as s from dq_wide group by 1,2) tb on tb.layout=p.lt and tb.type_name=a.type_name
where abs(b.off-a.off) > abs(tb.s - ta.s) + 4096 group by 1,2,3,4""")


def wide_feed(fx, loaded=None):
    wide = fx.sql(DQ_WIDE[1])
    sizes = wide.groupBy("layout", "type_name").agg((F.count("*") * 64).alias("type_size"))
    return validate.Continuity(fx.builds(), wide, sizes, loaded)


@query("q_dq10_continuity", """
select lf as layout_from, lt as layout_to, type_name, moved, worst_member, worst,
 type_name||': '||cast(moved as varchar)||' member(s) moved further than the 0x'||lower(to_hex(grew))||' byte size change explains, worst '||worst_member||' by 0x'||lower(to_hex(worst)) as message
from dq_cont""", *DIFF_VIEWS, DQ_WIDE, DQ_CONT)
def _(fx):
    return q.continuity_message(wide_feed(fx).findings).drop("grew")


@query("q_dq11_incremental_continuity", """
select r.label, r.machine, r.symbol_key as from_key, r.next_key as to_key, c.type_name, c.moved, c.worst from seq_runs r join dq_cont c on c.lf = r.layout and c.lt = r.next_layout
where coalesce(r.release_date,'') >= '1997-01-01' or coalesce(r.next_date,'') >= '1997-01-01'""", *DIFF_VIEWS, DQ_WIDE, DQ_CONT)
def _(fx):
    loaded = fx.builds().filter(F.col("release_date") >= "1997-01-01")
    return wide_feed(fx, loaded).per_transition().select("label", "machine", "from_key", "to_key", "type_name", "moved", "worst")


# Every finding of every rule, as (layout, severity, entity, message).
DQ_ALL = ("dq_all", " union all ".join(f"select layout, severity, entity, message from ({text}) r" for text in (DQ1_SQL, DQ2_SQL, DQ3_SQL, DQ4_SQL, DQ5_SQL, DQ6_SQL, DQ7_SQL, DQ8_SQL, DQ9_SQL)))
DQ_RULES = (*DQ, DQ_ENUMS, DQ_RAW, DQ_ALL)
# Every mismatch of two readings that is fatal: the member sides of the reconciliation, and types of one side only.
DQ_APART = ("dq_apart", """
select distinct coalesce(a.layout, b.layout) as layout from fx_members a full join fx_members_b b on a.layout=b.layout and a.type_name=b.type_name and a.member=b.member
where a.layout is null or b.layout is null or a.off <> b.off or a.bit_position <> b.bit_position or a.bit_count <> b.bit_count or (a.mtype <> '' and b.mtype <> '' and a.mtype <> b.mtype)""")


def all_findings(fx):
    return q.self_consistency(odd(fx), types(fx), raw(fx), enums(fx))


@query("q_dq12_admission", """
select b.symbol_key, case when cast(b.symbol_key as bigint) % 17 = 0 then 'pdb_404' when cast(b.symbol_key as bigint) % 17 = 1 then 'parse_failed' when e.layout is not null then 'inconsistent' when f.layout is not null then 'oracle_mismatch' else 'stored' end as outcome
from fx_builds b left join (select distinct layout from dq_all where severity = 'error') e on e.layout = b.layout left join dq_apart f on f.layout = b.layout""", *DQ_RULES, DQ_APART)
def _(fx):
    fx.written("fx_members")
    apart = reconcile.member_findings(fx.table("fx_members"), fx.table("fx_members_b"))
    unread = F.expr("case cast(symbol_key as bigint) % 17 when 0 then 'pdb_404' when 1 then 'parse_failed' end")
    failed = fx.builds().select("symbol_key", unread.alias("reason")).filter("reason is not null")
    return q.admit(fx.builds(), all_findings(fx), apart, failed).select("symbol_key", F.coalesce("reason", F.lit("stored")).alias("outcome"))


# One rule and one mismatch alone, so that both reasons and stored builds occur in the outcome.
@query("q_dq12_one_rule", """
select b.symbol_key, case when e.layout is not null then 'inconsistent' when f.layout is not null then 'oracle_mismatch' else 'stored' end as outcome
from fx_builds b left join (select distinct layout from dq_types where type_size = 0) e on e.layout = b.layout
 left join (select distinct a.layout from fx_members a join fx_members_b b on a.layout=b.layout and a.type_name=b.type_name and a.member=b.member where a.off <> b.off) f on f.layout = b.layout""", *DQ)
def _(fx):
    fx.written("fx_members")
    members = fx.table("fx_members")
    errors = q.check_types(q.type_summary(members, types(fx))).filter(F.col("rule") == "size_zero")
    apart = reconcile.member_findings(members, fx.table("fx_members_b")).filter(F.col("rule") == "offset")
    return q.admit(fx.builds(), errors, apart).select("symbol_key", F.coalesce("reason", F.lit("stored")).alias("outcome"))


@query("q_joi18_overlaps", """
select a.layout, a.type_name, a.member as earlier, b.member as later, a.off as a_off, a.off+a.sz as a_end, b.off as b_off
from fx_members a join fx_members b on a.layout=b.layout and a.type_name=b.type_name and b.off >= a.off and b.off < a.off + a.sz
  and (a.off < b.off or (a.off = b.off and a.member < b.member))
where a.bit_count = 0 and b.bit_count = 0 and a.sz > 0 and b.sz > 0 and ((a.off // 8) % 3 = 0 or (a.off // 8) % 3 <> (b.off // 8) % 3)""")
def _(fx):
    fx.written("fx_members")
    # Eight-byte slots stand for union groups, with 0 as no group.
    m = fx.table("fx_members").withColumn("union_group", F.expr("(off div 8) % 3"))
    return q.overlaps(m, q.type_summary(m, fx.types()), need_groups=False)


@query("q_joi18_grouped_overlaps", """
select a.layout, a.type_name, a.member as earlier, b.member as later, a.off as a_off, a.off+a.sz as a_end, b.off as b_off
from fx_members a join fx_members b on a.layout=b.layout and a.type_name=b.type_name and b.off >= a.off and b.off < a.off + a.sz
  and (a.off < b.off or (a.off = b.off and a.member < b.member))
where a.bit_count = 0 and b.bit_count = 0 and a.sz > 0 and b.sz > 0 and ((a.off // 16) % 4 = 0 or (a.off // 16) % 4 <> (b.off // 16) % 4)
  and exists (select 1 from fx_members g where g.layout = a.layout and g.type_name = a.type_name and (g.off // 16) % 4 <> 0)""")
def _(fx):
    fx.written("fx_members")
    # Types without any union group get no verdict.
    m = fx.table("fx_members").withColumn("union_group", F.expr("(off div 16) % 4"))
    return q.overlaps(m, q.type_summary(m, fx.types()))


@query("q_agg11_finding_groups", "select severity, message, count(*) as times from dq_all group by 1, 2 order by times desc, message limit 25", *DQ_RULES)
def _(fx):
    fx.written("fx_members")
    return q.group_findings(all_findings(fx), 25)


@query("q_sca11_finding_messages", "select severity, entity, message, count(*) as findings from dq_all group by 1, 2, 3", *DQ_RULES)
def _(fx):
    return all_findings(fx).groupBy("severity", "entity", "message").agg(F.count("*").alias("findings"))
