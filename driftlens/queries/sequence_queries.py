"""Scalar helpers and grouping into sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftlens.functions import text, version
from driftlens.operators import sequences as seq
from driftlens.operators.selection import stratified
from driftlens.queries.registry import query

# ---- shared oracle views: placed rows, ordered sequences, adjacent pairs -------------------------------

DIGITS = "list_transform(list_filter(string_split(coalesce({v},''),'.'), lambda x: regexp_full_match(x,'[0-9]+')), lambda x: cast(x as bigint))"
VK = "list_slice(list_concat(" + DIGITS + ",[0::bigint,0,0,0]),1,4)"
FAMILY = "case when regexp_full_match(string_split(coalesce({v},''),'.')[3],'[0-9]+') then string_split(coalesce({v},''),'.')[3] end"


def vk(column: str) -> str:
    return VK.format(v=column)


def fam(column: str) -> str:
    return FAMILY.format(v=column)


SEQ_MIXED = ("seq_mixed", f"""
select channel from (select c.channel, {fam('b.file_version')} as family from fx_builds b join fx_build_channels c using (symbol_key)) t
 where family is not null group by channel having count(distinct family) > 1""")
SEQ_PLACED = ("seq_placed", f"""
select * from (select b.*, c.channel, case when m.channel is null then c.channel when {fam('b.file_version')} is not null
   then c.channel || '/' || {fam('b.file_version')} end as label
 from fx_builds b join fx_build_channels c using (symbol_key) left join seq_mixed m on m.channel = c.channel) t where label is not null""")
SEQ_RUNS = ("seq_runs", f"""
select *, row_number() over w as ord, lead(layout) over w as next_layout, lead(symbol_key) over w as next_key,
  lead(file_version) over w as next_version, lead(release_date) over w as next_date, lead(kb) over w as next_kb
 from (select *, {vk('file_version')} as vkey, min(case when coalesce(file_version,'') <> '' then 1 else 0 end) over (partition by label, machine) as complete from seq_placed) t
 window w as (partition by label, machine order by case when complete = 1 then vkey end nulls first, coalesce(release_date,''), vkey, symbol_key)""")
SEQ_VIEWS = (SEQ_MIXED, SEQ_PLACED, SEQ_RUNS)


# ---- scalars ------------------------------------------------------------------------------------------

@query("q_sca1_version_key", f"select symbol_key, array_to_string({vk('file_version')},',') as version_key from fx_builds")
def _(fx):
    return fx.builds().select("symbol_key", version.version_key_text(F.col("file_version")).alias("version_key"))


@query("q_sca2_family", f"select symbol_key, coalesce({fam('file_version')},'none') as family from fx_builds")
def _(fx):
    return fx.builds().select("symbol_key", F.coalesce(version.family(F.col("file_version")), F.lit("none")).alias("family"))


@query("q_sca3_channel_label", "select symbol_key, channel, label from seq_placed", *SEQ_VIEWS)
def _(fx):
    return seq.place(fx.builds()).select("symbol_key", "channel", "label")


GUID = "substr(md5(symbol_key),1,8)||'-'||substr(md5(symbol_key),9,4)||'-'||substr(md5(symbol_key),13,4)||'-'||substr(md5(symbol_key),17,4)||'-'||substr(md5(symbol_key),21,12)"
AGE = "cast(symbol_key as bigint) % 40"


@query("q_sca4_hex_keys", f"""
select symbol_key as build, '0x' || upper(to_hex(layout)) as upper_hex, '0x' || lower(to_hex(layout)) as lower_hex,
 upper(md5(symbol_key)) || upper(to_hex({AGE})) as hex_key, upper(md5(symbol_key)) || '-' || cast({AGE} as varchar) as decimal_key from fx_builds""")
def _(fx):
    b = fx.builds().withColumn("guid", F.expr(GUID)).withColumn("age", F.expr(AGE))
    return b.select(F.col("symbol_key").alias("build"), text.hex_upper(F.col("layout")).alias("upper_hex"),
                    text.hex_lower(F.col("layout")).alias("lower_hex"),
                    text.symbol_key(F.col("guid"), F.col("age")).alias("hex_key"),
                    text.readable_key(F.col("guid"), F.col("age")).alias("decimal_key"))


@query("q_sca5_parse_hex", "select build, name, rva from fx_symbols")
def _(fx):
    published = fx.table("fx_symbols").withColumn("rva", text.hex_upper(F.col("rva")))
    return published.select("build", "name", text.parse_hex(F.col("rva")).alias("rva"))


def _le(column: str) -> str:
    order = (3, 2, 1, 0, 5, 4, 7, 6, 8, 9, 10, 11, 12, 13, 14, 15)
    return "||".join(f"substr({column},{2 * i + 1},2)" for i in order)


@query("q_sca6_guid_bytes", f"select symbol_key, upper({_le('md5(symbol_key)')}) as bytes from fx_builds")
def _(fx):
    return fx.builds().withColumn("guid", F.expr(GUID)).select(
        "symbol_key", F.hex(text.guid_bytes(F.col("guid"))).alias("bytes"))


@query("q_sca7_build_label", """
select symbol_key, coalesce(nullif(file_version,''), case when symbol_key like '%3' then null else kb end, substr(symbol_key,1,12)) as label,
 coalesce(nullif(file_version,''), substr(symbol_key,1,10)) as short_label from fx_builds""")
def _(fx):
    kbs = F.when(F.col("symbol_key").endswith("3"), F.array().cast("array<string>")).otherwise(F.col("kb"))
    return fx.builds().select(
        "symbol_key", text.build_label(F.col("file_version"), kbs, F.col("symbol_key")).alias("label"),
        text.short_label(F.col("file_version"), F.col("symbol_key")).alias("short_label"))


@query("q_sca10_xml_escape", """
select doc_id, md5(replace(replace(replace('<' || text || '&>','&','&amp;'),'<','&lt;'),'>','&gt;')) as escaped from documents""")
def _(fx):
    wrapped = F.concat(F.lit("<"), F.col("text"), F.lit("&>"))
    return fx.table("documents").select("doc_id", F.md5(text.xml_escape(wrapped)).alias("escaped"))


# ---- sequences ----------------------------------------------------------------------------------------

@query("q_seq1_mixed_channels", "select channel from seq_mixed", *SEQ_VIEWS)
def _(fx):
    return seq.mixed_channels(fx.builds()).select("channel")


@query("q_seq2_sequences", "select label, machine, count(*) as builds from seq_placed group by label, machine", *SEQ_VIEWS)
def _(fx):
    return seq.place(fx.builds()).groupBy("label", "machine").agg(F.count("*").alias("builds"))


@query("q_seq3_release_order", "select label, machine, symbol_key, ord from seq_runs", *SEQ_VIEWS)
def _(fx):
    from driftlens.operators.ordering import positions_within
    from driftlens.runtime import durable
    # The narrow placed rows are read by the completeness check, the sampling of bounds and the numbering.
    placed = seq.ordered(durable(seq.place(fx.builds().select("channel", "machine", "symbol_key", "file_version", "release_date")), "placed"))
    return (positions_within(placed.select(*seq.SEQUENCE, "symbol_key", *seq.ORDER), seq.SEQUENCE, seq.ORDER)
            .select("label", "machine", "symbol_key", (F.col("pos") + 1).alias("ord")))


@query("q_seq4_adjacent_pairs", "select label, machine, symbol_key as from_key, next_key as to_key from seq_runs where next_key is not null", *SEQ_VIEWS)
def _(fx):
    return seq.transitions(seq.adjacency(fx.builds())).select("label", "machine", "from_key", "to_key")


SEQ_MISSING = ("seq_missing", "select channel, count(*) as missing from fx_ledger where reason <> 'duplicate_key' group by channel")


@query("q_seq5_sequence_stats", """
select label, machine, builds, transitions, layout_changes, coalesce(from_version,'') as from_version, coalesce(to_version,'') as to_version,
  coalesce(from_date,'') as from_date, coalesce(to_date,'') as to_date, latest_layout, coalesce(missing,0) as known_missing_in_channel
from (select label, machine, count(*) as builds, count(next_key) as transitions, count(*) filter (where next_layout <> layout) as layout_changes,
   arg_min(coalesce(file_version,''), ord) as from_version, arg_max(coalesce(file_version,''), ord) as to_version,
   arg_min(coalesce(release_date,''), ord) as from_date, arg_max(coalesce(release_date,''), ord) as to_date, arg_max(layout, ord) as latest_layout
  from seq_runs group by label, machine) s left join seq_missing m on m.channel = s.label""", *SEQ_VIEWS, SEQ_MISSING)
def _(fx):
    from driftlens.operators.coverage import missing_by_channel
    stats = seq.sequence_stats(seq.adjacency(fx.builds()), missing_by_channel(fx.table("fx_ledger").withColumn("channel", F.array("channel"))))
    return stats.fillna("", ["from_version", "to_version", "from_date", "to_date"])


@query("q_seq6_changed_transitions", """
select label, machine, symbol_key as from_key, next_key as to_key, layout as layout_from, next_layout as layout_to
from seq_runs where next_layout <> layout""", *SEQ_VIEWS)
def _(fx):
    return seq.changed(seq.transitions(seq.adjacency(fx.builds()))).select(
        "label", "machine", "from_key", "to_key", "layout_from", "layout_to")


@query("q_seq7_feed_order", """
select label, machine, symbol_key as from_key, next_key as to_key,
  row_number() over (order by coalesce(next_date,'') desc, label desc, machine desc, ord) - 1 as feed_pos
from seq_runs where next_layout <> layout""", *SEQ_VIEWS)
def _(fx):
    changes = seq.changed(seq.transitions(seq.adjacency(fx.builds())))
    return seq.in_feed_order(changes.select("label", "machine", "from_key", "to_key", "date", *seq.ORDER)).select(
        "label", "machine", "from_key", "to_key", "feed_pos")


@query("q_seq8_verdicts", """
select count(*) as sequences, cast(sum(t) as bigint) as transitions, cast(sum(c) as bigint) as layout_changes,
  count(*) filter (where t > 0 and c = 0) as quiet, count(*) filter (where t = 0) as single
from (select count(next_key) as t, count(*) filter (where next_layout <> layout) as c from seq_runs group by label, machine) s""", *SEQ_VIEWS)
def _(fx):
    return seq.verdict_counts(seq.sequence_stats(seq.adjacency(fx.builds())))


@query("q_seq9_newest_first", f"""
select symbol_key, row_number() over (order by {vk('file_version')} desc, symbol_key) - 1 as pos from fx_builds""")
def _(fx):
    return seq.newest_first(fx.builds().select("symbol_key", "file_version"), "file_version", "symbol_key").select("symbol_key", "pos")


STRAT = ("seq_strat", f"""
select symbol_key, label, row_number() over (partition by label order by {vk('file_version')} desc, symbol_key) - 1 as depth,
  max({vk('file_version')}) over (partition by label) as top, min(symbol_key) over (partition by label) as first_seen from seq_placed""")


@query("q_seq10_stratified", """
select symbol_key, row_number() over (order by depth, lrank) - 1 as pick from (
 select symbol_key, min(depth) as depth, arg_min(lrank, depth * 100000 + lrank) as lrank from
  (select *, dense_rank() over (order by top desc, first_seen, label) as lrank from seq_strat) r where depth < 200 group by symbol_key) t
order by depth, lrank limit 500""", *SEQ_VIEWS, STRAT)
def _(fx):
    return stratified(fx.builds(), 500).select("symbol_key", F.col("pick"))


@query("q_seq11_compact_order", """
select symbol_key, row_number() over (order by coalesce(release_date,'') desc, coalesce(file_version,'') desc, symbol_key) - 1 as pos from fx_builds""")
def _(fx):
    from driftlens.operators.catalogue import compact_order
    return compact_order(fx.builds()).select("symbol_key", "pos")
