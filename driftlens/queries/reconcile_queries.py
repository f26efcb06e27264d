"""Reconciling two readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftlens.operators import reconcile as r
from driftlens.queries.registry import query

# Both readings declare types without members; the second one also loses all members of a type it declares.
REC_TA = ("rec_ta", """
select layout, type_name, max(off+sz) as s, count(*) as n from fx_members group by 1,2
 union all select distinct layout, '_OPAQUE', 16, 0 from fx_members where layout % 200 = 0""")
# The second reading also invents one type per layout and loses another.
REC_B = ("rec_b", """
select * from fx_members_b where not (type_name = '_STABLE3' and layout % 300 = 0) and not (type_name = '_STABLE2' and layout % 700 = 0)
 union all select distinct layout, '_GHOST', 'Ghost', 0, 8, 0, 0, '' from fx_members_b""")
REC_TB = ("rec_tb", """
select layout, type_name, max(off+sz) as s, count(*) as n from rec_b group by 1,2
 union all select layout, type_name, s, 0 from rec_ta where type_name = '_STABLE2' and layout % 700 = 0
 union all select distinct layout, '_OPAQUE', 16, 0 from fx_members where layout % 400 = 0""")
REC_M = ("rec_m", """
select coalesce(a.layout,b.layout) as layout, coalesce(a.type_name,b.type_name) as type_name, coalesce(a.member,b.member) as member, a.member as m1, b.member as m2,
 a.off as off1, b.off as off2, a.sz as sz1, b.sz as sz2, a.bit_position as bp1, b.bit_position as bp2, a.bit_count as bc1, b.bit_count as bc2, a.mtype as t1, b.mtype as t2
from (select m.* from fx_members m semi join rec_tb t on t.layout=m.layout and t.type_name=m.type_name) a
full join (select m.* from rec_b m semi join rec_ta t on t.layout=m.layout and t.type_name=m.type_name) b on a.layout=b.layout and a.type_name=b.type_name and a.member=b.member""")
HEX = "'0x'||lower(to_hex({}))".format
REC_MF = ("rec_mf", f"""
select layout, type_name as entity, 'fatal' as severity, 'missing' as rule, 'member '''||member||''' missing (oracle: offset '||{HEX('off1')}||')' as message from rec_m where m2 is null
union all select layout, type_name, 'fatal', 'invented', 'member '''||member||''' invented (offset '||{HEX('off2')}||')' from rec_m where m1 is null
union all select layout, type_name, 'fatal', 'offset', member||': offset '||{HEX('off2')}||' != oracle '||{HEX('off1')} from rec_m where off1 <> off2
union all select layout, type_name, 'fatal', 'type', member||': type '''||t2||''' != oracle '''||t1||'''' from rec_m where t1 <> '' and t2 <> '' and t1 <> t2
union all select layout, type_name, 'fatal', 'bits', member||': bits '||bp2||':'||bc2||' != oracle '||bp1||':'||bc1 from rec_m where bp1 <> bp2 or bc1 <> bc2
union all select layout, type_name, 'warning', 'size', member||': size '||sz2||' != oracle '||sz1 from rec_m where sz1 <> sz2""")
REC_CB = ("rec_cb", """
select layout, enum_name, name || case when value = 2 then '_x' else '' end as name, case when name like '%3' then value + 1 else value end as value, case when layout % 500 = 0 then 8 else enum_size end as enum_size
from fx_constants where not (enum_name = 'E_R' and layout % 900 = 0) and not (enum_name = 'E_A' and layout % 1100 = 0) union all select distinct layout, 'E_GHOST', 'G', 0, 4 from fx_constants""")
REC_EB = ("rec_eb", """
select layout, enum_name, max(enum_size) as s from rec_cb group by 1, 2
 union all select layout, enum_name, max(enum_size) from fx_constants where enum_name = 'E_A' and layout % 1100 = 0 group by 1, 2""")
REC = (REC_TA, REC_B, REC_TB, REC_M, REC_MF, REC_CB, REC_EB)


def second(fx):
    m = fx.table("fx_members_b")
    ghost = m.select("layout").distinct().selectExpr("layout", "'_GHOST' as type_name", "'Ghost' as member", "0L as off", "8 as sz", "0 as bit_position", "0 as bit_count", "'' as mtype")
    kept = m.filter("not (type_name = '_STABLE3' and layout % 300 = 0) and not (type_name = '_STABLE2' and layout % 700 = 0)")
    return kept.unionByName(ghost)


def declared(fx):
    """Declared types of both readings."""
    members = fx.table("fx_members")
    derived, layouts = (r.sizes(rows).select("layout", "type_name", F.col("type_size").cast("bigint").alias("type_size")) for rows in (members, second(fx))), members.select("layout").distinct()
    opaque = lambda n: layouts.filter(f"layout % {n} = 0").selectExpr("layout", "'_OPAQUE' as type_name", "16L as type_size")
    want, got = derived
    lost = want.filter("type_name = '_STABLE2' and layout % 700 = 0")
    return want.unionByName(opaque(200)), got.unionByName(lost).unionByName(opaque(400))


def declared_enums(fx):
    """Declared enums of both readings; the second one lost the constants of one."""
    want = r.enums_of(fx.table("fx_constants"))
    return want, r.enums_of(constants_b(fx)).unionByName(want.filter("enum_name = 'E_A' and layout % 1100 = 0"))


def constants_b(fx):
    return fx.sql(REC_CB[1])


def symbols_b(fx):
    return fx.table("fx_symbols").filter(F.col("rva") % 11 != 0).withColumn("rva", F.when(F.col("rva") % 7 == 0, F.col("rva") + 16).otherwise(F.col("rva")))


@query("q_joi11_type_findings", f"""
select coalesce(a.layout,b.layout) as layout, coalesce(a.type_name,b.type_name) as entity,
  case when a.layout is null then 'type absent from oracle (subject has '||b.n||' members)' when b.layout is null then 'absent from subject output'
   else 'size '||{HEX('b.s')}||' != oracle '||{HEX('a.s')} end as message
from rec_ta a full join rec_tb b on a.layout=b.layout and a.type_name=b.type_name where a.layout is null or b.layout is null or a.s <> b.s""", *REC)
def _(fx):
    fx.written("fx_members", "fx_members_b")
    want, got = declared(fx)
    sides = r.type_sides(r.declared_sizes(want, fx.table("fx_members")), r.declared_sizes(got, second(fx)))
    return r.type_findings(sides).select("layout", "entity", "message")


@query("q_joi12_member_findings", "select * from rec_mf", *REC)
def _(fx):
    fx.written("fx_members", "fx_members_b")
    return r.member_findings(fx.table("fx_members"), second(fx), *declared(fx))


@query("q_joi13_enum_findings", """
select coalesce(a.layout,b.layout) as layout, coalesce(a.enum_name,b.enum_name) as entity, case when a.layout is null then 'enum invented by subject' when b.layout is null then 'enum absent from subject output'
  else 'enum size '||b.s||' != oracle '||a.s end as message
from (select layout, enum_name, max(enum_size) as s from fx_constants group by 1,2) a full join rec_eb b
 on a.layout=b.layout and a.enum_name=b.enum_name where a.layout is null or b.layout is null or a.s <> b.s
union all select coalesce(a.layout,b.layout), coalesce(a.enum_name,b.enum_name), case when b.layout is null then 'constant '''||a.name||''' missing' when a.layout is null then 'constant '''||b.name||''' invented'
  else a.name||' = '||b.value||' != oracle '||a.value end
from (select * from fx_constants c semi join rec_eb d on c.layout=d.layout and c.enum_name=d.enum_name) a
full join (select * from rec_cb c semi join fx_constants d on c.layout=d.layout and c.enum_name=d.enum_name) b on a.layout=b.layout and a.enum_name=b.enum_name and a.name=b.name
where a.layout is null or b.layout is null or a.value <> b.value""", *REC)
def _(fx):
    return r.enum_findings(fx.table("fx_constants"), constants_b(fx), *declared_enums(fx)).select("layout", "entity", "message")


@query("q_joi14_symbol_findings", f"""
select a.build, a.name, case when b.rva is null then 'symbol missing from subject output' else 'rva '||{HEX('b.rva')}||' != oracle '||{HEX('a.rva')} end as message
from fx_symbols a left join (select build, name, case when rva % 7 = 0 then rva + 16 else rva end as rva from fx_symbols where rva % 11 <> 0) b on a.build=b.build and a.name=b.name
where b.rva is null or a.rva <> b.rva""")
def _(fx):
    return r.symbol_findings(fx.table("fx_symbols"), symbols_b(fx)).select(F.col("layout").alias("build"), F.col("entity").alias("name"), "message")


@query("q_joi15_compared_names", """
select layout, type_name, case when type_name in (select distinct '_' || l_returnflag || l_linestatus from lineitem) then 1 else 0 end as requested
from (select layout, type_name from fx_members union select layout, type_name from rec_b) t""", *REC)
def _(fx):
    oracle, subject = fx.table("fx_members"), second(fx)
    wanted = fx.table("lineitem").select(F.concat(F.lit("_"), "l_returnflag", "l_linestatus").alias("name")).distinct()
    asked = r.compared_names(oracle, subject, wanted).withColumn("requested", F.lit(1))
    return r.compared_names(oracle, subject).join(asked, ["layout", "type_name"], "left").fillna(0, ["requested"])


@query("q_joi16_counters", """
select 'types' as counter, count(*) as checked from rec_ta a join rec_tb b on a.layout=b.layout and a.type_name=b.type_name
union all select 'members', count(*) from rec_m where m1 is not null and m2 is not null
union all select 'bitfields', count(*) from rec_m where m1 is not null and m2 is not null and (bc1 <> 0 or bc2 <> 0)
union all select 'enums', count(*) from (select distinct layout, enum_name from fx_constants intersect select distinct layout, enum_name from rec_eb) t
union all select 'constants', count(*) from fx_constants a join rec_cb b on a.layout=b.layout and a.enum_name=b.enum_name and a.name=b.name
union all select 'symbols', count(*) from fx_symbols""", *REC)
def _(fx):
    fx.written("fx_members", "fx_members_b", "fx_constants")
    return r.counters(fx.table("fx_members"), second(fx), fx.table("fx_constants"), constants_b(fx), fx.table("fx_symbols"), *declared(fx), *declared_enums(fx))


@query("q_joi17_gate", """
select l.layout, coalesce(f.n,0) as fatal, case when f.n is null then 'PASS' else 'FAIL' end as verdict, coalesce(f.head,'') as head
from (select distinct layout from fx_members) l left join (select layout, max(n) as n, string_agg(entity||' '||message, ' | ' order by entity, message) as head from
 (select *, count(*) over (partition by layout) as n, row_number() over (partition by layout order by entity, message) as nth from rec_mf where severity='fatal') t where nth <= 4 group by layout) f on f.layout = l.layout""", *REC)
def _(fx):
    fx.written("fx_members", "fx_members_b")
    from driftlens.operators.ordering import top_per_group
    from driftlens.runtime import durable
    found = durable(r.member_findings(fx.table("fx_members"), second(fx), *declared(fx)), "findings")
    # At most four findings per layout reach the list.
    head = (top_per_group(found.filter("severity = 'fatal'"), ["layout"], ["entity", "message"], 4)
            .groupBy("layout").agg(F.sort_array(F.collect_list(F.struct("nth", F.concat_ws(" ", "entity", "message").alias("line")))).alias("lines"))
            .select("layout", F.array_join("lines.line", " | ").alias("head")))
    return r.gate(found, fx.table("fx_members")).join(head, "layout", "left").fillna("", ["head"])


@query("q_joi17_gate_report", """
select layout, entity, severity, rule, message, nth from (select *, row_number() over (partition by layout order by entity, message, rule) as nth from rec_mf where severity = 'fatal') t
where nth <= 4 order by layout, nth limit 30""", *REC)
def _(fx):
    fx.written("fx_members", "fx_members_b")
    found = r.member_findings(fx.table("fx_members"), second(fx), *declared(fx))
    return r.gate_report(found).select("layout", "entity", "severity", "rule", "message", "nth")
