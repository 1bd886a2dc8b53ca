"""Quality rules with thresholds that follow the corpus: DataFrame operations only.

Each measure of a document (share of symbols, share of repeated lines, mean word length) is held against fences
of its own language and source. A fence comes from quantiles, and those from a sketch: counts of logarithmic bins
(relative error 1 %). Counts of two sketches add up, so the sketches of sources merge into those of languages and of
the whole table, which stand in for groups that are too small. Documents meet their fences in a join.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yardline.llm.common import SPACE, free_name, lookup, settle, with_results

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]"
GAMMA = 1.02  # ratio of neighbouring bins of a sketch
GAMMA_LOG = 0.01980262729617973  # its natural logarithm
LEAST_DOCS = 100  # a smaller group takes the fences of its language, a smaller language those of the table
LOW, HIGH = 0.25, 0.75
REACH = 3.0  # a fence is so many spreads beyond its quartile


@dataclass(frozen=True)
class Rule:
    """A measure is a share or a mean; ``spread`` is the smallest distance of quartiles that counts."""

    measure: str
    spread: float
    low: bool = False  # whether small values fail too


RULES = (Rule("symbol_share", 0.01), Rule("dup_line_share", 0.15), Rule("mean_word_length", 1.5, low=True))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def counted(docs: DataFrame, text_col: str) -> DataFrame:
    """Add the counts of COUNTS (long)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    body = F.btrim(text, F.lit(BLANKS))
    base = docs.select("*", text.alias("_t"), F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, SPACE)).alias("_words"))
    lines = F.filter(F.split("_t", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    windows = F.expr("transform(sequence(1, size(_words) - 4), i -> concat_ws(' ', slice(_words, i, 5)))")
    step = base.select("*", lines.alias("_lines"), F.when(F.size("_words") >= 5, windows).alias("_windows"))
    # windows in order beside their places, only where some repeat
    ordered = F.expr("array_sort(transform(_windows, (w, i) -> struct(w as w, i as i)))")
    step = step.select("*", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), ordered).alias("_ordered"))
    step = step.select(
        "*",
        F.expr(
            "array_sort(transform(filter(zip_with(zip_with(_ordered, slice(_ordered, 2, size(_ordered)), (a, b) -> struct(a, b.w as after)),"
            " concat(array(cast(null as string)), transform(_ordered, x -> x.w)), (x, p) -> struct(x.a as a, x.after as after, p as before)),"
            " x -> x.a.w = x.after or x.a.w = x.before), x -> x.a.i))"
        ).alias("_places"),
    )
    covered = F.expr(
        "aggregate(zip_with(_places, slice(_places, 2, size(_places)), (a, b) -> coalesce(least(b - a, 5), 5)), 0L, (s, x) -> s + x)"
    )
    results = {
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count("_t", F.lit(SYMBOLS)).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0).cast("long")),
    }
    return with_results(step, results).drop("_t", "_words", "_lines", "_windows", "_ordered", "_places")


def measures() -> dict[str, Column]:
    """Null where a document has nothing to measure."""
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    return {
        "symbol_share": share("n_symbols", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "mean_word_length": share("word_chars", "n_words"),
    }


def sketches(rows: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Counts by keys, measure and bin; bin null holds the zeros. Merge sketches by adding up counts."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).alias("value")) for n in names]))
    each = rows.select(*keys, pairs.alias("m")).filter(F.col("m.value").isNotNull())
    bin_ = F.when(F.col("m.value") > 0, F.ceil(F.log(F.col("m.value")) / F.lit(GAMMA_LOG)).cast("int"))
    return each.groupBy(*keys, F.col("m.measure").alias("measure"), bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Number of values, and the quantiles LOW and HIGH, by keys and measure. Groups here are bins, never documents."""
    by = Window.partitionBy(*keys, "measure")
    upto = by.orderBy(F.col("bin").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    value = F.when(F.col("bin").isNull(), 0.0).otherwise(F.exp(F.col("bin") * GAMMA_LOG) * (2.0 / (GAMMA + 1.0)))
    placed = sketch.select("*", value.alias("value"), F.sum("n").over(upto).alias("upto"), F.sum("n").over(by).alias("total"))
    at = lambda q: F.min(F.when(F.col("upto") >= F.col("total") * q, F.col("value")))
    return placed.groupBy(*keys, "measure").agg(F.max("total").alias("docs"), at(LOW).alias("q_low"), at(HIGH).alias("q_high"))


def fences(rows: DataFrame, lang_col: str, source_col: str, rules: tuple[Rule, ...], least: int) -> DataFrame:
    """One row per language and source (nulls are groups too) with low_ and high_ of each measure."""
    names = [r.measure for r in rules]
    rows = rows.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{source_col}`").alias("source"), *names)
    fine, _ = settle(sketches(rows, ["lang", "source"], names))
    merged = lambda keys: fine.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))
    whole = {r["measure"]: r for r in quartiles(merged([]), []).collect()}  # a row per measure
    by_lang = quartiles(merged(["lang"]), ["lang"]).withColumnsRenamed({n: f"{n}_lang" for n in ("docs", "q_low", "q_high")})
    by_lang = by_lang.withColumnsRenamed({"lang": "_lang", "measure": "_measure"})
    each = quartiles(fine, ["lang", "source"])
    each = each.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("measure") == F.col("_measure")))
    columns = []
    for r in rules:
        q: dict[str, Column] = {}
        for name in ("q_low", "q_high"):
            of_table = F.lit(whole[r.measure][name] if r.measure in whole else None).cast("double")
            finest = F.when(F.col("docs") >= least, F.col(name)).when(F.col("docs_lang") >= least, F.col(f"{name}_lang"))
            q[name] = finest.otherwise(of_table)
        reach = F.greatest(q["q_high"] - q["q_low"], F.lit(r.spread)) * REACH
        own = F.col("measure") == r.measure
        columns.append(F.max(F.when(own, q["q_high"] + reach)).alias(f"high_{r.measure}"))
        if r.low:
            columns.append(F.max(F.when(own, q["q_low"] - reach)).alias(f"low_{r.measure}"))
    return each.groupBy("lang", "source").agg(*columns)


def judge(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    *,
    rules: tuple[Rule, ...] = RULES,
    least_docs: int = LEAST_DOCS,
    drop_text: bool = False,
) -> DataFrame:
    """Add the counts, base_failed, kept and failed_rules (array of measures) to documents.

    Words are runs without space, tab to carriage return. base_failed: fewer than 10 words, or over 20 % of the words
    in five-word windows that the text has twice. kept: not base_failed and no measure beyond its fence.

    A null or empty text has no words and fails the base rule. A measure without a value (no word, no line) fails
    nothing. Null languages and sources are groups like others; missing columns can't be judged. Rows may repeat; each
    counts. Columns with the names of results are replaced. An empty table gives an empty result. ``drop_text`` leaves
    the text out of the result and so out of the table that is written between the two passes.
    """
    rows = counted(docs, text_col)
    shown = [f"`{c}`" for c in rows.columns if not (drop_text and c == text_col)]
    named = {m: free_name(rows, m) for m in measures()}
    rows, _ = settle(rows.select(*shown))
    for measure, column in measures().items():
        rows = rows.withColumn(named[measure], column)
    own = tuple(Rule(named[r.measure], r.spread, r.low) for r in rules)
    limits, _ = settle(fences(rows, lang_col, source_col, own, least_docs))
    renamed = {c: f"_limit_{c}" for c in limits.columns}
    lang, source = free_name(rows, "join_lang"), free_name(rows, "join_source")
    keyed = rows.withColumns({lang: F.col(f"`{lang_col}`"), source: F.col(f"`{source_col}`")})
    limits = limits.withColumnsRenamed(renamed).withColumnsRenamed({"_limit_lang": lang, "_limit_source": source})
    met = lookup(keyed, limits, [lang, source])
    failed = []
    for r, plain in zip(own, rules, strict=True):
        beyond = F.col(r.measure) > F.col(f"_limit_high_{r.measure}")
        if r.low:
            beyond = beyond | (F.col(r.measure) < F.col(f"_limit_low_{r.measure}"))
        failed.append(F.when(beyond, F.lit(plain.measure)))
    base = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    results: Mapping[str, Column] = {"base_failed": base, "failed_rules": F.array_compact(F.array(*failed))}
    out = with_results(met, dict(results)).drop(lang, source, *[c for c in renamed.values()], *named.values())
    return with_results(out, {"kept": ~F.col("base_failed") & (F.size("failed_rules") == 0)})
