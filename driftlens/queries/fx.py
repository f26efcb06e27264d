"""Adapter views that re-shape the driver's tables into builds, members, symbols and index entries.

Each view is one SQL text that both engines read, so a query and its oracle start from equal rows. The
views cover their tables whole; what differs between rows follows from column values.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlens.runtime import durable

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")

BUILD_KEY = "lpad(cast(o_orderkey as string),12,'0')"

VIEWS: dict[str, str] = {}

VIEWS["fx_builds"] = f"""
select {BUILD_KEY} as symbol_key,
 case when o_orderstatus='P' and o_orderkey % 5 <> 0 then null
      else '10.0.' || cast(case when o_orderpriority like '5%' then 20000+1000*(o_custkey % 4)
           else 20000+1000*cast(substr(o_orderpriority,1,1) as bigint) end as string) || '.' || cast(o_custkey as string) end as file_version,
 case o_orderstatus when 'O' then 'amd64' when 'F' then 'x86' else 'arm64' end as machine,
 case when o_orderkey % 11 = 0 then null else cast(cast(o_orderdate as date) as string) end as release_date,
 'KB' || cast(5000000 + o_custkey as string) as kb, (o_custkey - o_custkey % 10) * 10 as layout
 from orders"""

VIEWS["fx_build_channels"] = f"""
select {BUILD_KEY} as symbol_key, o_orderpriority as channel from orders
 union all select {BUILD_KEY}, 'LTSC-' || substr(o_orderpriority,1,1) from orders where o_totalprice < 120000"""

VIEWS["fx_members"] = """
select layout, type_name, member, min(off) as off, min(sz) as sz, min(bp) as bit_position, min(bc) as bit_count,
 case min(pk) % 4 when 0 then '' when 1 then 'void *' when 2 then 'unsigned long' else '_LIST_ENTRY' end as mtype
 from (select l_orderkey - l_orderkey % 100 as layout, '_' || l_returnflag || l_linestatus as type_name,
  case when l_partkey % 7 = 0 then 'Reserved' || cast(l_linenumber as string) when l_partkey % 7 = 1 then 'AvailableTime' || cast(l_linenumber as string) || 'x'
       else 'Field' || cast(l_linenumber as string) || '_' || cast(l_partkey % 3 as string) end as member,
  (l_linenumber - 1) * 8 + case when l_linenumber > 3 then l_orderkey % 400 - l_orderkey % 100 else 0 end as off,
  case when l_suppkey % 8 = 0 then 4 else 8 end as sz,
  case when l_linenumber = 2 then cast((l_orderkey % 500 - l_orderkey % 100) / 100 as int) else 0 end as bp,
  case when l_linenumber = 2 then cast((l_orderkey % 300 - l_orderkey % 100) / 100 as int) + 1 else 0 end as bc,
  l_partkey as pk from lineitem) t group by layout, type_name, member
 union all select y.layout, '_STABLE' || cast(n_regionkey as string), n_name, n_nationkey * 8 + case when n_regionkey = 0 and y.layout % 1000 >= 500 then 8 else 0 end, 8, 0, 0, 'void *'
 from (select distinct l_orderkey - l_orderkey % 100 as layout, s_nationkey as nation_key from lineitem join supplier on s_suppkey = l_suppkey) y join nation on n_nationkey = nation_key"""

VIEWS["fx_members_b"] = """
select layout, type_name, member, case when off % 24 = 8 and sz = 4 then off + 4 else off end as off, sz, bit_position, bit_count,
 case when length(member) % 2 = 0 and mtype = 'void *' then 'char *' else mtype end as mtype from fx_members where not (off = 16 and sz = 4)
 union all select layout, type_name, 'Invented', 640, 8, 0, 0, '' from fx_members where sz = 4 and bit_count = 0 and off = 0 group by layout, type_name"""

VIEWS["fx_symbols"] = """
select build, name, min(rva) as rva from (select lpad(cast(l_orderkey as string),12,'0') as build, 'Sym' || cast(l_partkey as string) as name, 4096*l_suppkey + l_linenumber as rva from lineitem) t group by build, name"""

VIEWS["fx_constants"] = """
select layout, enum_name, name, min(value) as value, 4 as enum_size from (select l_orderkey - l_orderkey % 100 as layout, 'E_' || l_returnflag as enum_name, 'C' || cast(l_linenumber as string) || cast(l_partkey % 5 as string) as name, l_suppkey % 4 - 1 as value from lineitem) t group by layout, enum_name, name"""

VIEWS["fx_index"] = f"""
select 'ga' as dataset, {BUILD_KEY} as sha256, o_orderpriority as channel, o_orderkey % 97 as ts, o_orderkey % 13 as vsize from orders
 union all select 'insider', {BUILD_KEY}, 'builds', o_orderkey % 97, o_orderkey % 13 from orders where o_totalprice < 100000"""

VIEWS["fx_ledger"] = f"""
select {BUILD_KEY} as sha256, case o_orderkey % 6 when 0 then 'binary_404' when 1 then 'pdb_404' when 2 then 'undownloadable' when 3 then 'duplicate_key' when 4 then 'inconsistent' else 'fetch_error' end as reason, o_orderpriority as channel from orders"""

VIEWS["fx_nodes"] = """
select 'R' || cast(r_regionkey as string) as list_id, 'N' || cast(n_nationkey as string) as child_list, case when n_nationkey % 3 = 0 then '' else n_name end as member, n_nationkey % 5 * 1000 as off, case when n_nationkey % 2 = 0 then 'union' else 'class' end as kind
 from nation join region on n_regionkey = r_regionkey
 union all select 'N' || cast(s_nationkey as string), 'leaf', s_name, s_suppkey % 100 * 8, 'leaf' from supplier"""

_NAMES = re.compile(r"\b(" + "|".join([*TABLES, *VIEWS]) + r")\b")
_SOURCE = re.compile(r"\b(from|join) (" + "|".join([*TABLES, *VIEWS]) + r")\b")


class Fx:
    """Lazy access to the tables and views below one data folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder, self._known = spark, folder, {}

    def table(self, name: str) -> DataFrame:
        if name not in self._known:
            if name in TABLES:
                self._known[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                self._known[name] = self.sql(VIEWS[name])
        return self._known[name]

    def written(self, *names: str) -> None:
        """Write these views once for a query that reads them several times; views built on them read the written rows."""
        for name in names:
            self._known[name] = durable(self.table(name), name)

    def sql(self, text: str) -> DataFrame:
        """Run ``text`` with the tables and views it names bound to their DataFrames."""
        used = {name for _, name in _SOURCE.findall(text)}
        bound = _SOURCE.sub(lambda m: f"{m.group(1)} {{{m.group(2)}}}", text)
        return self.spark.sql(bound, **{name: self.table(name) for name in used}) if used else self.spark.sql(text)

    def builds(self) -> DataFrame:
        """Build documents with their channel and KB lists, straight from one scan of ``orders``."""
        second = F.when(F.col("_price") < 120000, F.concat(F.lit("LTSC-"), F.substring("_priority", 1, 1)))
        return (self.sql(VIEWS["fx_builds"].replace(" as layout\n", " as layout, o_totalprice as _price, o_orderpriority as _priority\n"))
                .withColumn("channel", F.array_compact(F.array(F.col("_priority"), second)))
                .withColumn("kb", F.array("kb")).drop("_price", "_priority"))

    def types(self) -> DataFrame:
        """(layout, type_name, type_size): a type ends where its last member ends."""
        return (self.table("fx_members").groupBy("layout", "type_name")
                .agg(F.max(F.col("off") + F.col("sz")).alias("type_size")))


def with_views(sql: str, *extra: tuple[str, str]) -> str:
    """Prefix ``sql`` with the CTEs of every view it needs, directly or through another view."""
    named = {**VIEWS, **dict(extra)}
    needed: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in re.findall(r"\b[a-z]+_[a-z_0-9]+\b", text):
            if name in named and name not in seen:
                seen.add(name)
                visit(named[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    ctes = ",\n".join(f"{name} as ({named[name]})" for name in needed)
    return f"with recursive {ctes}\n{sql}" if "recursive" in sql else f"with {ctes}\n{sql}"
