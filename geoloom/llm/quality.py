"""Quality rules with adaptive thresholds; DataFrame functions only.

Measures of each text are taken by column functions.  For every language and
source a mergeable quantile sketch (KLL) of each measure is built; sketches of a
language's sources are merged for the language, and these for all rows.  A
group's threshold is its median plus ``REACH`` times the distance from its lower
quartile to the median, plus a slack for measures that hardly vary; a small
group takes its language's threshold, a small language the one of all rows.  A
third quantile is not needed, so up to half of a group may be junk before its
threshold moves.  The thresholds (one row for each language and source) are
materialised, then joined to the rows for filtering.

Edge cases: a null text has no word and fails; null language or source are
groups of their own; repeated rows are judged alike; an empty table gives an
empty result; texts of any length are measured whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, cut, written

#: Measures, with the slack of their thresholds.  Repeated windows have no threshold of their own beside the base rule: among labelled
#: texts with 10 to 20 % of such words clean ones outnumber junk (21 to 6 of 10 000 documents), so any lower bound would reject clean texts.
MEASURES = {"symbol_share": 0.10, "dup_line_share": 0.30, "stutter_share": 0.20, "mean_word": 3.0}
REACH, LEAST_ROWS, SKETCH = 6.0, 30, 4096


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once for the row."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column, width: int = 5) -> Column:
    """Number of words that lie in a window of ``width`` words found twice or more in the text.

    Windows are compared by 64-bit hashes; texts without a repeated hash, nearly
    all, need no more than one pass.
    """

    def covered(h: Column) -> Column:
        marked = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def ends(s: Column) -> Column:
            twice = F.filter(s, lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | (F.get(s, k + 1)["h"] == x["h"]))
            return let(F.array_sort(F.transform(twice, lambda x: x["i"])), gaps)

        def gaps(at: Column) -> Column:
            # each repeated window covers its words up to the next repeated window
            return F.aggregate(F.transform(at, lambda x, k: F.least(F.coalesce(F.get(at, k + 1) - x, F.lit(width)), F.lit(width))), F.lit(0), lambda a, x: a + x)

        return let(marked, ends)

    def counted(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - width)
        hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))

    return F.when(F.size(words) >= width, let(words, counted)).otherwise(0).cast("long")


def measured(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, and the measures of MEASURES."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(*keep, text.alias("q_text"))
    words = F.filter(F.split("q_text", SPACE), lambda w: w != "")
    lines = F.filter(F.split("q_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(*keep, "q_text", words.alias("q_words"), lines.alias("q_lines"))
    rows = rows.select(
        *keep,
        F.size("q_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("q_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("q_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long").alias("n_dup_lines"),
        F.size("q_lines").alias("q_n_lines"),
        repeat_words(F.col("q_words")).alias("n_repeat_words"),
        let(F.col("q_words"), lambda w: F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1)))).alias("q_stutter"),
    )
    n = F.greatest(F.col("n_words"), F.lit(1))
    return rows.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
        (F.col("n_symbols") / n).alias("symbol_share"),
        # a few lines more in the divisor: one repeated line of three is no pattern yet
        (F.col("n_dup_lines") / (F.col("q_n_lines") + 5)).alias("dup_line_share"),
        (F.col("q_stutter") / n).alias("stutter_share"),
        (F.col("word_chars") / n).alias("mean_word"),
    )


def thresholds(rows: DataFrame) -> DataFrame:
    """q_lang, q_source and an upper bound of each measure, for every language and source of the measured rows."""
    group = [F.coalesce(F.concat(F.lit("="), c), F.lit("")).alias(k) for c, k in (("lang", "q_lang"), ("source", "q_source"))]
    sketches = rows.groupBy(*group).agg(F.count("*").alias("n"), *[F.kll_sketch_agg_double(m, F.lit(SKETCH)).alias(m) for m in MEASURES])
    sketches = cut(sketches)
    merge = [F.sum("n").alias("n"), *[F.kll_merge_agg_double(m, F.lit(SKETCH)).alias(m) for m in MEASURES]]

    def bounds(df: DataFrame, *keys: str, mark: str) -> DataFrame:
        at = lambda m, q: F.kll_sketch_get_quantile_double(m, F.lit(q))
        return df.select(*keys, F.col("n").alias(f"n_{mark}"), *[(at(m, 0.5) + REACH * (at(m, 0.5) - at(m, 0.25)) + slack).alias(f"{m}_{mark}") for m, slack in MEASURES.items()])

    own = bounds(sketches, "q_lang", "q_source", mark="own")
    lang = bounds(sketches.groupBy("q_lang").agg(*merge), "q_lang", mark="lang")
    every = bounds(sketches.agg(*merge), mark="all")
    total = every.select(F.struct(*[f"{m}_all" for m in MEASURES])).scalar()  # one row: a scalar subquery
    joined = own.join(lang, "q_lang")
    pick = lambda m: F.when(F.col("n_own") >= LEAST_ROWS, F.col(f"{m}_own")).when(F.col("n_lang") >= LEAST_ROWS, F.col(f"{m}_lang")).otherwise(total[f"{m}_all"])
    # a file's size is known when the join is planned: small, it is broadcast by Spark's own check, and no text is moved by a hot source
    return written(joined.select("q_lang", "q_source", *[pick(m).alias(f"{m}_most") for m in MEASURES]), "thresholds")


def _judged(rows: DataFrame) -> DataFrame:
    """Measured rows with one more column, ``kept``."""
    limits = thresholds(rows)
    keyed = rows.withColumns({"q_row_lang": F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")), "q_row_source": F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))})
    both = keyed.join(limits, (F.col("q_row_lang") == F.col("q_lang")) & (F.col("q_row_source") == F.col("q_source")), "left")
    fine = F.lit(True)
    for m in MEASURES:
        fine = fine & (F.col(m) <= F.col(f"{m}_most"))
    return both.withColumn("kept", ~F.col("base_failed") & F.coalesce(fine, F.lit(True)))


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every row."""
    rows = written(measured(docs, "doc_id", "lang", "source"), "quality")
    return _judged(rows).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows that are kept, columns as given. Rows and measures are written once, so no text is measured twice or moved by a key."""
    plain = docs.columns
    # given columns go in one struct, so that no name can clash with the measures
    box = docs.select(F.struct(*plain).alias("q_row"), "text", "lang", "source")
    rows = written(measured(box, "q_row", "lang", "source"), "quality")
    return _judged(rows).filter("kept").select(*[F.col("q_row")[c].alias(c) for c in plain])


