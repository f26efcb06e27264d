"""Record tables with references, and primitive lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftlens.functions import primitives
from driftlens.operators import hierarchy as h
from driftlens.operators import selection
from driftlens.queries.registry import query

PART_REC = "select p_partkey as idx, 'class' as kind_group, p_name as name, p_size % 3 = 0 as is_forward, p_size as size, p_partkey + 1000000 as list_id from part"
HIE_REC = ("hie_rec", PART_REC)
HIE_CANON = ("hie_canon", "select name, coalesce(max(idx) filter (where not is_forward), min(idx)) as idx from hie_rec group by name")


@query("q_hie1_canonical_records", "select * from hie_canon", HIE_REC, HIE_CANON)
def _(fx):
    return h.canonical_records(fx.sql(PART_REC)).select("name", "idx")


@query("q_hie2_largest_records", "select name, arg_min(idx, struct_pack(a := -size, b := idx)) as idx from hie_rec group by name", HIE_REC)
def _(fx):
    return h.largest_records(fx.sql(PART_REC))


# Field order within a list is the order of offsets and names.
HIE_F = ("hie_f", "select *, row_number() over (partition by list_id order by off, member, child_list) as ord from fx_nodes")
HIE_FLAT = ("hie_flat", """
select r.list_id as root, r.off as off, r.member, 0 as union_of, r.kind from hie_f r where r.list_id like 'R%' and r.member <> ''
union all select r.list_id, r.off + c.off, c.member, case when r.kind = 'union' then r.ord else 0 end, c.kind from hie_f r join hie_f c on c.list_id = r.child_list where r.list_id like 'R%' and r.member = ''""")
HIE_U = ("hie_u", "select list_id as root, ord as union_of, dense_rank() over (partition by list_id order by ord) as g from hie_f where list_id like 'R%' and member = '' and kind = 'union'")
HIE_ONCE = ("hie_once", "select distinct f.root, member, off, kind, coalesce(g, 0) as union_group from hie_flat f left join hie_u u on u.root = f.root and u.union_of = f.union_of")


def fields(fx):
    from pyspark.sql import Window
    # Lists of the fixture are read in offset order; real field lists carry their order.
    nth = F.row_number().over(Window.partitionBy("list_id").orderBy("off", "member", "child_list"))
    return fx.table("fx_nodes").withColumn("ord", nth)


def flat(fx):
    roots = fx.table("region").select(F.concat(F.lit("R"), "r_regionkey").alias("root"), F.concat(F.lit("R"), "r_regionkey").alias("list_id"))
    return h.flatten(roots, fields(fx))


@query("q_hie3_flatten", "select root, member, off from hie_once", HIE_F, HIE_FLAT, HIE_U, HIE_ONCE)
def _(fx):
    return flat(fx).select("root", "member", "off")


@query("q_hie4_union_groups", "select root, member, off, union_group from hie_once", HIE_F, HIE_FLAT, HIE_U, HIE_ONCE)
def _(fx):
    return flat(fx).select("root", "member", "off", "union_group")


# Records over the parts: every key refers to half of itself; odd shapes end the chains.
KINDS = ("pointer", "modifier", "array", "bitfield", "function", "class", "enum", "primitive")
HIE_T = ("hie_t", """
select p_partkey + 1 as idx, 'g' as kind_group, case when p_partkey % 8 in (5, 6) then p_name || cast(p_partkey as string) else '#' || cast(p_partkey as string) end as name,
 case when p_partkey < 8 then 'primitive' else case p_partkey % 8 when 0 then 'pointer' when 1 then 'modifier' when 2 then 'array' when 3 then 'bitfield' when 4 then 'function' when 5 then 'class' when 6 then 'enum' else 'pointer' end end as kind,
 false as is_forward, case when p_partkey % 8 = 2 then case when p_size % 5 = 0 then null else p_size * 48 end when p_partkey % 8 in (0, 7) then 8 when p_partkey % 8 = 5 then p_size else 0 end as size,
 case when p_partkey >= 8 and p_partkey % 8 <> 5 then p_partkey // 2 + 1 end as underlying, case p_partkey % 4 when 0 then 'ULong' when 1 then 'Void' when 2 then 'U8' else 'Quad' end as primitive,
 case when p_partkey = 6 then 'Near64' end as indirection, p_size % 2 = 0 as is_const, p_size % 7 = 0 as is_volatile from part""")
PRIM = """case primitive when 'ULong' then 'unsigned long' when 'Void' then 'void' when 'U8' then 'unsigned char' else '__int64' end || case when indirection is not null then ' *' else '' end"""
PRIM_SIZE = """case when indirection is not null then 8 when primitive = 'ULong' then 4 when primitive = 'Void' then 0 when primitive = 'U8' then 1 else 8 end"""
HIE_S = ("hie_s", f"""
select idx, idx as cur, 0 as depth from hie_t union all select s.idx, t.underlying, depth + 1 from hie_s s join hie_t t on t.idx = s.cur where t.kind in ('enum','modifier','bitfield') and t.underlying is not null""")
HIE_SIZE = ("hie_size", f"""
select s.idx, cast(case t.kind when 'primitive' then {PRIM_SIZE} when 'class' then t.size when 'pointer' then 8 when 'array' then coalesce(t.size, 0) else 0 end as bigint) as bytes
 from (select idx, arg_max(cur, depth) as cur from hie_s group by idx) s join hie_t t on t.idx = s.cur""")
HIE_RENDER = ("hie_render", f"""
select idx, kind, 0 as depth, case when kind = 'primitive' then {PRIM} else name end as declared from hie_t where kind in ('primitive','class')
 or underlying is null union all
 select t.idx, t.kind, depth + 1, case when r.declared = '' then '' when t.kind = 'pointer' and r.kind = 'function' then regexp_replace(r.declared, '^(.*?) \\(\\)', '\\1 (*)()') || case when t.is_const then ' const' else '' end || case when t.is_volatile then ' volatile' else '' end
  when t.kind = 'pointer' then r.declared || ' *' || case when t.is_const then ' const' else '' end || case when t.is_volatile then ' volatile' else '' end
  when t.kind = 'modifier' then case when t.is_const then 'const ' else '' end || case when t.is_volatile then 'volatile ' else '' end || r.declared
  when t.kind = 'array' then r.declared || case when t.size is not null and s.bytes > 0 then '[' || (t.size // s.bytes) || ']' else '[]' end
  when t.kind = 'function' then r.declared || ' ()' when t.kind = 'enum' then t.name else r.declared end
 from hie_render r join hie_t t on t.underlying = r.idx join hie_size s on s.idx = t.underlying""")


def records(fx):
    return fx.sql(HIE_T[1].replace(" // ", " div "))


@query("q_hie5_resolved_sizes", "select idx, bytes from hie_size /* recursive */", HIE_T, HIE_S, HIE_SIZE)
def _(fx):
    return h.resolve_sizes(records(fx))


@query("q_hie6_declared_types", "select idx, declared from hie_render /* recursive */", HIE_T, HIE_S, HIE_SIZE, HIE_RENDER)
def _(fx):
    return h.render_types(records(fx), h.resolve_sizes(records(fx)))


HIE_L = ("hie_l", "select o_orderkey as list_id, case when o_orderkey % 6 <> 0 then o_orderkey - 1 end as continuation from orders")
HIE_C = ("hie_c", "select l_orderkey as list_id, 'C' || cast(l_linenumber as string) || cast(l_partkey % 5 as string) as name, l_suppkey % 4 - 1 as value from lineitem")


@query("q_hie7_enum_continuations", """
select distinct 'E' || o.list_id as enum_name, c.name, c.value from hie_l o join hie_c c on c.list_id <= o.list_id and c.list_id >= o.list_id - o.list_id % 6""", HIE_L, HIE_C)
def _(fx):
    lists = fx.sql(HIE_L[1])
    enums = lists.select(F.concat(F.lit("E"), F.col("list_id").cast("string")).alias("enum_name"), "list_id")
    return h.enum_constants(enums, lists, fx.sql(HIE_C[1]))


@query("q_hie8_missing_names", "select distinct p_brand as name from part where p_brand not in (select p_brand from part where p_size = 1)")
def _(fx):
    part = fx.table("part")
    return selection.missing_names(part.select(F.col("p_brand").alias("name")), part.filter("p_size = 1"), "p_brand")


@query("q_hie9_forward_lists", """
select r.idx, case when r.is_forward then c.idx + 1000000 else r.list_id end as list_id from hie_rec r join hie_canon c on c.name = r.name""", HIE_REC, HIE_CANON)
def _(fx):
    return h.resolve_lists(fx.sql(PART_REC)).select("idx", "list_id")


# ---- primitives ---------------------------------------------------------------------------------------

KIND_NAMES = [name for name, _, _ in primitives.PRIMITIVES] + ["Unknown"]
# Fixed values, stated here a second time so that a wrong entry in the library's own table shows.
PRIM_ROWS = """(values
 ('NoType',0,''), ('Void',0,'void'), ('Char',1,'char'), ('UChar',1,'unsigned char'), ('RChar',1,'char'),
 ('I8',1,'char'), ('U8',1,'unsigned char'), ('Bool8',1,'bool'), ('WChar',2,'wchar_t'), ('RChar16',2,'char16_t'),
 ('RChar32',4,'char32_t'), ('Short',2,'short'), ('UShort',2,'unsigned short'), ('I16',2,'short'), ('U16',2,'unsigned short'),
 ('Bool16',2,'bool16'), ('F16',2,'half'), ('Long',4,'long'), ('ULong',4,'unsigned long'), ('I32',4,'int'),
 ('U32',4,'unsigned int'), ('F32',4,'float'), ('Bool32',4,'bool32'), ('HRESULT',4,'HRESULT'), ('Quad',8,'__int64'),
 ('UQuad',8,'unsigned __int64'), ('I64',8,'__int64'), ('U64',8,'unsigned __int64'), ('F64',8,'double'), ('Bool64',8,'bool64'),
 ('Complex32',8,'_Complex float'), ('Octa',16,'__int128'), ('UOcta',16,'unsigned __int128'), ('I128',16,'__int128'), ('U128',16,'unsigned __int128'),
 ('F128',16,'long double'), ('Complex64',16,'_Complex double')) p(kind, width, spelling)"""
POINTERS = "(values ('Near16',2), ('Far16',4), ('Huge16',4), ('Near32',4), ('Far32',6), ('Near64',8), ('Near128',16)) i(name, width)"
BASIC_ROWS = """(values
 ('void',0,'void'), ('char',1,'char'), ('char8',1,'char'), ('wchar',2,'wchar_t'), ('char16',2,'char16_t'),
 ('char32',4,'char32_t'), ('int',1,'char'), ('int',2,'short'), ('int',4,'int'), ('int',8,'__int64'),
 ('int',16,'__int128'), ('uint',1,'unsigned char'), ('uint',2,'unsigned short'), ('uint',4,'unsigned int'), ('uint',8,'unsigned __int64'),
 ('uint',16,'unsigned __int128'), ('long',4,'long'), ('long',8,'__int64'), ('ulong',4,'unsigned long'), ('ulong',8,'unsigned __int64'),
 ('float',2,'half'), ('float',4,'float'), ('float',8,'double'), ('float',16,'long double'), ('bool',1,'bool'),
 ('bool',2,'bool16'), ('bool',4,'bool32'), ('bool',8,'bool64'), ('complex',8,'_Complex float'), ('complex',16,'_Complex double'),
 ('hresult',4,'HRESULT')) b(basic, width, spelling)"""
SCA_K = ("sca_k", "select l_orderkey, l_linenumber, l_suppkey, cast(l_partkey % {n} as int) as k, cast(l_partkey % 8 as int) as i from lineitem".format(n=len(KIND_NAMES)))


def kinds(fx):
    rows = fx.sql(SCA_K[1])
    names = F.array(*[F.lit(name) for name in KIND_NAMES])
    pointers = F.array(*[F.lit(name) for name, _ in primitives.INDIRECTIONS])
    return rows.withColumn("kind", F.get(names, F.col("k"))).withColumn("indirection", F.get(pointers, F.col("i")))


KIND_LIST = "[" + ",".join(f"'{n}'" for n in KIND_NAMES) + "]"
POINTER_LIST = "[" + ",".join(f"'{n}'" for n, _ in primitives.INDIRECTIONS) + "]"


@query("q_sca12_primitive_sizes", f"""
select kind, indirection, bytes, count(*) as n from (select {KIND_LIST}[k+1] as kind, coalesce({POINTER_LIST}[i+1],'') as indirection, coalesce(ip.width, pr.width, 0) as bytes from sca_k
 left join (select * from {PRIM_ROWS}) pr on pr.kind = {KIND_LIST}[k+1] left join (select * from {POINTERS}) ip on ip.name = {POINTER_LIST}[i+1]) t group by 1,2,3""", SCA_K)
def _(fx):
    sized = kinds(fx).withColumn("bytes", primitives.primitive_size(F.col("kind"), F.col("indirection")))
    return sized.groupBy("kind", F.coalesce("indirection", F.lit("")).alias("indirection"), "bytes").agg(F.count("*").alias("n"))


@query("q_sca13_primitive_names", f"""
select kind, indirection, declared, count(*) as n from (select {KIND_LIST}[k+1] as kind, coalesce({POINTER_LIST}[i+1],'') as indirection,
 case when coalesce(pr.spelling,'') = '' then '' else pr.spelling || case when i < 7 then ' *' else '' end end as declared from sca_k left join (select * from {PRIM_ROWS}) pr on pr.kind = {KIND_LIST}[k+1]) t group by 1,2,3""", SCA_K)
def _(fx):
    named = kinds(fx).withColumn("declared", primitives.primitive_name(F.col("kind"), F.col("indirection")))
    return named.groupBy("kind", F.coalesce("indirection", F.lit("")).alias("indirection"), "declared").agg(F.count("*").alias("n"))


@query("q_sca14_constant_signs", """
select l_orderkey, l_linenumber, cast(case when l_linenumber % 3 = 0 then case when l_suppkey * 7 % 256 > 127 then l_suppkey * 7 % 256 - 256 else l_suppkey * 7 % 256 end when l_linenumber % 3 = 1 then case when l_suppkey % 2 = 0 then -l_suppkey else l_suppkey end
 else l_suppkey end as bigint) as value from sca_k""", SCA_K)
def _(fx):
    leaf = F.when(F.col("l_linenumber") % 3 == 0, "U8").when(F.col("l_linenumber") % 3 == 1, "U64").otherwise("U32")
    wide = F.lit("18446744073709551616").cast("decimal(20,0)")
    key = F.col("l_suppkey").cast("decimal(20,0)")
    raw = (F.when(leaf == "U8", (F.col("l_suppkey") * 7 % 256).cast("decimal(20,0)"))
           .when((leaf == "U64") & (F.col("l_suppkey") % 2 == 0), (wide - key).cast("decimal(20,0)")).otherwise(key))
    return fx.sql(SCA_K[1]).select("l_orderkey", "l_linenumber", primitives.constant_value(leaf, raw).alias("value"))


@query("q_sca13_basic_names", f"""
select basic, width, coalesce(b.spelling, '') as declared, count(*) as n from (select {['void', 'char', 'char8', 'wchar', 'char16', 'char32', 'int', 'uint', 'long', 'ulong', 'float', 'bool', 'complex', 'hresult', 'other']}[cast(l_partkey % 15 as int) + 1] as basic,
 [0, 1, 2, 4, 8, 16][cast(l_suppkey % 6 as int) + 1] as width from lineitem) t left join (select basic as name, width as bytes, spelling from {BASIC_ROWS}) b on b.name = basic and b.bytes = width group by 1, 2, 3""")
def _(fx):
    basics, widths = ("void", "char", "char8", "wchar", "char16", "char32", "int", "uint", "long", "ulong", "float", "bool", "complex", "hresult", "other"), (0, 1, 2, 4, 8, 16)
    rows = fx.table("lineitem").select(F.get(F.array(*map(F.lit, basics)), F.expr("cast(l_partkey % 15 as int)")).alias("basic"),
                                       F.get(F.array(*map(F.lit, widths)), F.expr("cast(l_suppkey % 6 as int)")).alias("width"))
    return rows.withColumn("declared", primitives.basic_name(F.col("basic"), F.col("width"))).groupBy("basic", "width", "declared").agg(F.count("*").alias("n"))
