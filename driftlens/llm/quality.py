"""Quality rules with thresholds that adapt to language and source.

Each text is measured by array functions inside its row; nothing of a text is shuffled. The measures become rates per
thousand, and each rate goes into a sketch per (language, source): counts of log-linear buckets, 32 to a doubling, so a
quantile is off by 1/32 of its value at most. Such sketches merge by adding counts, in any order and on the map side,
with a bounded number of buckets however many rows there are. A fence is the quartile and some distances of the
quartiles beyond it, or the first or last percentile where that is farther: rates that are 0 in most documents have no
distance of quartiles, and their last percentile is the threshold. Fences of a group are weighted with those of its
language, and these with those of all documents, by the number of documents, so no size switches them. They are joined
back and rows beyond them are dropped: a text goes only for being unlike its group, so a homogeneous group loses nothing.

Defined results: a null text has no words, and like any text below the base rules is not kept; null languages and
sources are groups of their own; repeated rows count each time; extra columns are ignored by ``judge`` and kept by
``keep_good``; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlens.runtime import durable

#: Space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\f\r"
GAP = "[ \\t\\n\\x0B\\f\\r]+"
#: Words of a window that is looked for again in the same text.
WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30
#: Documents of a group at which its own fences weigh four fifths and those of the level above one fifth.
LEAST_GROUP = 200
#: Distance of the fences from the quartiles, in distances of the quartiles.
REACH = 3


def let(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once: inside lambdas a plain expression would be computed per element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _windows(words: Column, n: Column) -> Column:
    """Hashes of all windows of ``WINDOW`` (a power of two) words, by hashing pairs of pairs."""
    def doubled(hashes: Column, step: int) -> Column:
        return let(hashes, lambda h: F.zip_with(F.slice(h, 1, F.greatest(F.size(h) - step, F.lit(0))), F.slice(h, step + 1, F.greatest(F.size(h) - step, F.lit(0))), lambda a, b: F.xxhash64(a, b)))

    made, step = F.transform(words, lambda w: F.xxhash64(w)), 1
    while step < WINDOW:
        made, step = doubled(made, step), 2 * step
    return F.when(n >= WINDOW, made).otherwise(F.array().cast("array<bigint>"))


def _covered(starts: Column) -> Column:
    """Words below windows that begin at the ascending ``starts``."""
    seed = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("sum"))
    return F.aggregate(starts, seed, lambda acc, s: F.struct(s.alias("last"), (acc["sum"] + F.least(s - acc["last"], F.lit(WINDOW))).cast("long").alias("sum")), lambda acc: acc["sum"])


def _repeated_starts(hashes: Column) -> Column:
    """Ascending places of hashes that occur again, from one sort of (hash, place)."""
    def pick(s: Column) -> Column:
        size = F.size(s)
        again = F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | ((i + 1 < size) & (F.get(s, i + 1)["h"] == x["h"])))
        return F.array_sort(F.transform(again, lambda x: x["i"]))

    return let(F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), pick)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words`` of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    trimmed = F.trim(text, F.lit(SPACES))

    def of_words(words: Column) -> Column:
        n = F.size(words)
        repeats = let(_windows(words, n), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(_covered(_repeated_starts(h))))
        return F.struct(n.cast("long").alias("n_words"), F.length(F.array_join(words, "")).cast("long").alias("word_chars"), repeats.alias("n_repeat_words"))

    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))
    lines = let(F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(SPACES)) != ""), lambda line: F.struct(F.size(line).cast("long").alias("n_lines"), (F.size(line) - F.size(F.array_distinct(line))).cast("long").alias("n_dup_lines")))
    symbols = (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long")
    made = rows.select("doc_id", "lang", "source", let(words, of_words).alias("w"), lines.alias("l"), symbols.alias("n_symbols"))
    return made.select("doc_id", "lang", "source", "w.n_words", "w.word_chars", "n_symbols", "l.n_lines", "l.n_dup_lines", "w.n_repeat_words")


def with_base(measured: DataFrame) -> DataFrame:
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return measured.withColumn("base_failed", failed)


def rates() -> Column:
    """Rates per thousand, as whole numbers, one struct for each rate."""
    per = lambda a, b: F.expr(f"1000 * {a} div greatest({b}, 1L)")
    made = {"word_len": per("word_chars", "n_words"), "symbols": per("n_symbols", "word_chars"), "dup_lines": per("n_dup_lines", "n_lines"), "repeats": per("n_repeat_words", "n_words")}
    return F.array(*[F.struct(F.lit(k).alias("rate"), v.alias("v")) for k, v in made.items()])


def bucket(v: Column) -> Column:
    """Lower end of the log-linear bucket of a whole number: exact below 64, then 32 buckets to a doubling."""
    shift = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, shift), shift)


def fences(measured: DataFrame, least_group: int = LEAST_GROUP) -> DataFrame:
    """``level, lang, source, rate, low, high, n``: level 0 holds groups of (lang, source), 1 languages, 2 all.

    Fences of levels 0 and 1 are weighted with those of the level above.
    """
    values = measured.where("not base_failed").select("lang", "source", F.explode(rates()).alias("r")).select("lang", "source", "r.rate", bucket(F.col("r.v")).alias("b"))
    fine = durable(values.groupBy("lang", "source", "rate", "b").agg(F.count("*").alias("n")), "quality-sketches")
    merged = fine.select(F.lit(0).alias("level"), "lang", "source", "rate", "b", "n")
    merged = merged.union(fine.groupBy("lang", "rate", "b").agg(F.sum("n").alias("n")).select(F.lit(1), "lang", F.lit(None).cast("string"), "rate", "b", "n"))
    merged = merged.union(fine.groupBy("rate", "b").agg(F.sum("n").alias("n")).select(F.lit(2), F.lit(None).cast("string"), F.lit(None).cast("string"), "rate", "b", "n"))
    # at most a few hundred buckets a group, so ordering them is bounded
    ranked = merged.withColumn("upto", F.expr("sum(n) over (partition by level, lang, source, rate order by b)")).withColumn("all", F.expr("sum(n) over (partition by level, lang, source, rate)"))
    first = lambda parts, of: F.min(F.expr(f"case when {of} * upto >= {parts} * `all` then b end"))
    quantiles = ranked.groupBy("level", "lang", "source", "rate").agg(first(1, 4).alias("q1"), first(3, 4).alias("q3"), first(1, 100).alias("p1"), first(99, 100).alias("p99"), F.max("all").alias("n"))
    spread = REACH * (F.col("q3") - F.col("q1"))
    own = quantiles.select("level", "lang", "source", "rate", F.least(F.col("q1") - spread, "p1").cast("double").alias("low"), F.greatest(F.col("q3") + spread, "p99").cast("double").alias("high"), "n")
    own = durable(own, "quality-levels")
    weight = F.col("n") / (F.col("n") + F.lit(max(least_group, 0) / 4))

    def weighted(rows: DataFrame, above: DataFrame, same: Column) -> DataFrame:
        joined = rows.join(above, same & (F.col("rate") == F.col("_rate")))
        return joined.select("level", "lang", "source", "rate", *[(weight * F.col(c) + (1 - weight) * F.col(f"_{c}")).alias(c) for c in ("low", "high")], "n")

    named = lambda rows: rows.select(F.col("lang").alias("_lang"), F.col("rate").alias("_rate"), F.col("low").alias("_low"), F.col("high").alias("_high"))
    top = own.where("level = 2")
    of_lang = weighted(own.where("level = 1"), named(top), F.lit(True))
    return weighted(own.where("level = 0"), named(of_lang), F.col("lang").eqNullSafe(F.col("_lang"))).union(of_lang).union(top)


def judge(docs: DataFrame, least_group: int = LEAST_GROUP, **columns: str) -> DataFrame:
    """``measures`` with ``base_failed`` and ``kept``."""
    measured = durable(with_base(measures(docs, **columns)), "quality")
    made = durable(fences(measured, least_group), "quality-fences")
    level = lambda k: made.where(f"level = {k}").groupBy("lang", "source").agg(F.map_from_entries(F.collect_list(F.struct("rate", F.struct("low", "high")))).alias(f"f{k}"))
    own, of_lang = level(0), level(1)
    all_docs = made.where("level = 2").select("rate", "low", "high").collect()  # a row for each rate
    of_all = F.create_map(*[x for r in all_docs for x in (F.lit(r["rate"]), F.struct(F.lit(r["low"]).alias("low"), F.lit(r["high"]).alias("high")))]) if all_docs else F.lit(None)
    own = own.select(F.col("lang").alias("gl"), F.col("source").alias("gs"), "f0")
    of_lang = of_lang.select(F.col("lang").alias("ll"), "f1")
    joined = measured.join(own, F.col("lang").eqNullSafe(F.col("gl")) & F.col("source").eqNullSafe(F.col("gs")), "left")
    joined = joined.join(of_lang, F.col("lang").eqNullSafe(F.col("ll")), "left")
    used = F.coalesce(F.col("f0"), F.col("f1"), of_all)
    inside = F.forall(rates(), lambda r: bucket(r["v"]).between(F.floor(F.element_at(used, r["rate"])["low"]), F.ceil(F.element_at(used, r["rate"])["high"])))
    return joined.select(*measured.columns, (~F.col("base_failed") & F.coalesce(inside, F.lit(True))).alias("kept"))


def keep_good(docs: DataFrame, id_col: str = "doc_id", **columns) -> DataFrame:
    """The rows of ``docs`` whose id is kept (ids are null-safe; rows that share an id share its worst verdict)."""
    bad = judge(docs, id_col=id_col, **columns).where("not kept").select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs[id_col].eqNullSafe(bad["_bad"]), "left_anti")
