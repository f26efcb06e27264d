"""Queries ``opN_<name>`` over the text tables, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from driftlens.llm import chat, languages, lattice, lines, mixing, pieces, quality, ranking, resampling, simhash, suffixes, tokens, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


@query("op1_simhash_near_dedup")
def op1(spark, folder):
    return simhash.groups(documents(spark, folder), words=3, seed=42, distance=3).drop("fp")


@query("op2_quality_rules")
def op2(spark, folder):
    return quality.judge(documents(spark, folder)).drop("lang", "source")


OP3_SQL = """
WITH talk AS (SELECT conv_id AS c, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
finals AS (SELECT c, turn, text FROM talk WHERE role = 'assistant' QUALIFY row_number() OVER (PARTITION BY c ORDER BY turn DESC NULLS LAST, text DESC NULLS LAST) = 1),
told AS (SELECT a.c, a.turn, a.text, b.text AS answer FROM finals a JOIN finals b ON b.c = a.c + 1 - 2 * (a.c % 2)),
twins AS (
  SELECT c * 2 AS conv_id, turn, role, text FROM talk
  UNION ALL
  SELECT t.c * 2 + 1, t.turn, t.role, CASE WHEN t.role = 'assistant' AND t.turn IS NOT DISTINCT FROM f.turn AND t.text IS NOT DISTINCT FROM f.text THEN f.answer ELSE t.text END FROM talk t JOIN told f USING (c)),
pairs AS (SELECT DISTINCT floor(conv_id / 2)::BIGINT AS pair_id FROM twins WHERE conv_id % 2 = 1),
said AS (
  SELECT floor(conv_id / 2)::BIGINT AS pair_id, conv_id % 2 AS side, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos FROM twins WHERE floor(conv_id / 2)::BIGINT IN (SELECT pair_id FROM pairs)),
both_sides AS (SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.pos, b.pos) AS pos,
         a.pos IS NOT NULL AND b.pos IS NOT NULL AND a.role IS NOT DISTINCT FROM b.role AND a.text IS NOT DISTINCT FROM b.text AS alike
  FROM (SELECT * FROM said WHERE side = 0) a FULL JOIN (SELECT * FROM said WHERE side = 1) b ON a.pair_id = b.pair_id AND a.pos = b.pos),
prefix AS (SELECT pair_id, coalesce(min(pos) FILTER (WHERE NOT alike), max(pos) + 1) - 1 AS n FROM both_sides GROUP BY pair_id),
made AS (
  SELECT s.*, n, '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS r, CASE WHEN pos <= n THEN 2 ELSE side END AS part
  FROM said s JOIN prefix USING (pair_id)),
placed AS (SELECT *, coalesce(sum(length(r)) OVER (PARTITION BY pair_id, side, part ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 13 + length(coalesce(role, '')) AS b FROM made),
parts AS (
  SELECT pair_id, max(n) AS n, count(*) FILTER (WHERE part = 0) AS na, count(*) FILTER (WHERE part = 1) AS nb,
         string_agg(r, '' ORDER BY pos) FILTER (WHERE part = 2 AND side = 0) AS p, string_agg(r, '' ORDER BY pos) FILTER (WHERE part = 0) AS a, string_agg(r, '' ORDER BY pos) FILTER (WHERE part = 1) AS c,
         string_agg(b::BIGINT || '-' || (b + length(coalesce(text, '')))::BIGINT, ',' ORDER BY pos) FILTER (WHERE part = 0 AND role = 'assistant') AS ma,
         string_agg(b::BIGINT || '-' || (b + length(coalesce(text, '')))::BIGINT, ',' ORDER BY pos) FILTER (WHERE part = 1 AND role = 'assistant') AS mb
  FROM placed GROUP BY pair_id)
SELECT pair_id, pair_id * 2 AS chosen_id, pair_id * 2 + 1 AS rejected_id, n::INT AS n_prompt_turns, na::INT AS n_chosen_turns, nb::INT AS n_rejected_turns,
       coalesce(p, '') AS prompt, coalesce(a, '') AS chosen, coalesce(c, '') AS rejected, coalesce(ma, '') AS chosen_mask, coalesce(mb, '') AS rejected_mask FROM parts"""


@query("op3_preference_format", OP3_SQL)
def op3(spark, folder):
    turns = chat.swapped_answers(spark.read.parquet(f"{folder}/conversations.parquet"))
    made = chat.preferences(turns, chat.twin_pairs(turns))
    return made.withColumns({c: chat.mask_text(made[c]) for c in ("chosen_mask", "rejected_mask")})


@query("op4_line_dedup")
def op4(spark, folder):
    return lines.report(documents(spark, folder))


@query("op5_embedding_near_dedup")
def op5(spark, folder):
    return lattice.near_duplicates(spark.read.parquet(f"{folder}/embeddings.parquet"), least=0.98)


@query("op6_token_counts")
def op6(spark, folder):
    return tokens.count_tokens(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


@query("op7_toxicity")
def op7(spark, folder):
    docs = documents(spark, folder)
    return toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet")))


@query("op8_sentencepiece_codec")
def op8(spark, folder):
    return pieces.digest(documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model"))


OP9_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')), 0)::BIGINT AS size FROM documents),
total AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, 2 * source_size AS cap, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w FROM total),
ordered AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
         sum(w) OVER (ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM ranked),
level AS (
  SELECT arg_min(((SELECT sum(source_size) FROM total) * 3 / 2 - spent) / open, cap / w) AS v FROM ordered
  WHERE w * (((SELECT sum(source_size) FROM total) * 3 / 2 - spent) / open) < cap),
goal AS (SELECT source, source_size, CASE WHEN v IS NULL OR w * v >= cap THEN cap::DOUBLE ELSE w * v END AS target FROM ranked, level),
rated AS (
  SELECT s.doc_id, s.source, s.size, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('42:' || coalesce(s.doc_id::VARCHAR, 'null')), 1, 12))::BIGINT AS u
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source),
tried AS (
  SELECT source, k, any_value(floor(rate) * source_size) AS whole, any_value(target) AS target,
         sum(CASE WHEN (u + k * 4398046511104) % 281474976710656 < (rate - floor(rate)) * 281474976710656::DOUBLE THEN size ELSE 0 END)::DOUBLE AS words
  FROM rated, range(64) AS turns(k) GROUP BY source, k),
turned AS (SELECT source, k FROM tried QUALIFY row_number() OVER (PARTITION BY source ORDER BY abs(whole + words - target), k) = 1),
copied AS (
  SELECT r.*, floor(rate) + CASE WHEN (u + k * 4398046511104) % 281474976710656 < (rate - floor(rate)) * 281474976710656::DOUBLE THEN 1 ELSE 0 END AS copies
  FROM rated r JOIN turned t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, copies::BIGINT AS copies, (size * copies)::BIGINT AS taken FROM copied"""


@query("op9_source_mixing", OP9_SQL)
def op9(spark, folder):
    return mixing.plan(documents(spark, folder), seed=42, weights=(3, 1, 2), share=(3, 2), most=2)


@query("op10_suffix_array_dedup")
def op10(spark, folder):
    return suffixes.report(documents(spark, folder), length=100)


def _crc_step(remainder: int) -> int:
    """CRC-32 of one byte's value, by its rule."""
    for _ in range(8):
        remainder = remainder >> 1 ^ (0xEDB88320 if remainder & 1 else 0)
    return remainder


OP11_SQL = r"""
WITH words AS (
  SELECT 'd' AS side, row_number() OVER () AS uid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', -row_number() OVER (), NULL, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
runs AS (
  SELECT side, uid, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f FROM words),
features AS (SELECT side, uid, f, count(*)::BIGINT AS n FROM runs GROUP BY side, uid, f),
kinds AS (SELECT f, hex(f) AS x FROM (SELECT DISTINCT f FROM features)),
crcs AS (
  SELECT f, xor(list_reduce(list_transform(range(0, len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
                            lambda c, b: xor(c >> 8, ({table})[1 + (xor(c, b) & 255)]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket FROM kinds),
placed AS (SELECT side, uid, bucket, sum(n)::BIGINT AS n FROM features JOIN crcs USING (f) GROUP BY side, uid, bucket),
held AS (SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (WHERE side = 'b'), 0)::DOUBLE AS t FROM placed GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM held) + 10000) / ((s + 1) * ((SELECT sum(t) FROM held) + 10000))))::BIGINT AS gain FROM held),
weights AS (SELECT uid, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM placed JOIN gain USING (bucket) WHERE side = 'd' GROUP BY uid),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM words LEFT JOIN weights USING (uid) WHERE side = 'd'),
drawn AS (SELECT *, n_words >= 20 AS open, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS nth FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN open AND nth <= 5 * (SELECT count(*) FROM scored WHERE n_words >= 20) // 100 THEN nth::BIGINT END AS rank FROM drawn""".replace("{table}", str([_crc_step(b) for b in range(256)]) + "::BIGINT[]")


@query("op11_importance_resampling", OP11_SQL)
def op11(spark, folder):
    return resampling.ranked(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"), share=(5, 100), seed=42)


@query("op12_language_id")
def op12(spark, folder):
    docs = documents(spark, folder)
    return languages.identify(docs, languages.fit(docs))


OP13_SQL = r"""
WITH cut AS (
  SELECT row_number() OVER () AS uid, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tfs AS (SELECT uid, doc_id, term, count(*)::BIGINT AS tf FROM cut GROUP BY uid, doc_id, term),
sizes AS (SELECT uid, sum(tf)::BIGINT AS n FROM tfs GROUP BY uid),
corpus AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM sizes),
strata AS (SELECT uid, 50 + (50 * n * docs) // words AS m FROM sizes, corpus),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), corpus),
asked AS (
  SELECT DISTINCT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scored AS (
  SELECT item_id, text, uid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN strata USING (uid) GROUP BY item_id, text, uid, doc_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS nth FROM scored WHERE score > 0)
SELECT item_id, nth::INT AS rank, doc_id, score FROM placed WHERE nth <= 50"""


@query("op13_ranked_search", OP13_SQL)
def op13(spark, folder):
    return ranking.search(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"), k=50)
