"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, lattice_lm, lines, mixing, multi_index, pii, quality, simhash, toxicity, urls
from .common import table, written

#: The folder of the public vocabulary files; a parameter of the operators.
VOCABULARIES = os.environ.get("GEOLOOM_VOCABULARIES", "/opt/tokenizers")
WORD_BPE, PIECES = f"{VOCABULARIES}/word_bpe_49k.json", f"{VOCABULARIES}/piece_bpe_32k.model"


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(table(spark, sf_dir, "documents"))


def op3_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(table(spark, sf_dir, "embeddings"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.scored(table(spark, sf_dir, "documents"), PIECES)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", F.length("text").cast("long").alias("n_kept_chars"), F.md5(F.col("text").cast("binary")).alias("kept_md5"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # whole documents are replicated, shuffled and written; length and digest are those of each copy's text after that
    got = written(mixing.mixed(table(spark, sf_dir, "documents")), "mixed")
    text = [F.length("text").cast("long").alias("text_chars"), F.md5(F.col("text").cast("binary")).alias("text_md5")]
    return got.select("doc_id", "source", F.col("mix_copies").alias("copies"), F.col("mix_copy").alias("copy_no"), F.col("mix_order").alias("shuffle_key"), *text)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents"), WORD_BPE)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_url_filter, op2_pii, op3_multi_index, op4_quality, op5_toxicity, op6_lattice_lm, op7_line_dedup, op8_mixing, op9_simhash, op10_bpe, pipeline)
    return {f.__name__: f for f in own}


# Lines: trimmed of white space, in lower case; place = (doc_id, position).
OP7_SQL = r"""
WITH raw AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL
), lines AS (
  SELECT doc_id, pos, raw, lower(trim(raw, concat(' ', chr(9), chr(11), chr(12), chr(13)))) AS line FROM raw
), firsts AS (
  SELECT line, min((doc_id, pos)) AS place, length(line) AS n FROM lines WHERE line <> '' GROUP BY line
), gone AS (
  SELECT DISTINCT b.line FROM firsts a JOIN firsts b ON (a.n = b.n OR a.n = b.n - 1 OR a.n = b.n + 1) AND a.place < b.place
  WHERE (left(a.line, least(a.n, b.n) // 2) = left(b.line, least(a.n, b.n) // 2) OR right(a.line, least(a.n, b.n) // 2) = right(b.line, least(a.n, b.n) // 2)) AND len([i FOR i IN range(0, least(a.n, b.n) + 1) IF left(a.line, i) = left(b.line, i) AND substr(a.line, i + 1 + (a.n >= b.n)::INT) = substr(b.line, i + 1 + (b.n >= a.n)::INT)]) > 0
), kept AS (
  SELECT l.doc_id, l.pos, l.raw FROM lines l LEFT JOIN firsts f ON l.line = f.line
  WHERE l.line = '' OR (f.place = (l.doc_id, l.pos) AND l.line NOT IN (SELECT line FROM gone))
), texts AS (SELECT doc_id, string_agg(raw, chr(10) ORDER BY pos) AS text FROM kept GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN length(coalesce(t.text, '')) END AS n_kept_chars, CASE WHEN d.text IS NOT NULL THEN md5(coalesce(t.text, '')) END AS kept_md5
FROM documents d LEFT JOIN texts t USING (doc_id)
"""

OP8_SQL = """
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
m AS (SELECT source, (SELECT sum(n) FROM n) * 1.0::DOUBLE / ((SELECT count(*) FROM n) * n) AS mean FROM n),
cdf AS (
  SELECT source, k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS up
  FROM (SELECT source, mean, unnest(range(0, ceil(mean + 12 * sqrt(mean) + 40)::BIGINT + 1)) AS k FROM m)
),
u AS (SELECT row_number() OVER () AS r, doc_id, source, length(text) AS text_chars, md5(text) AS text_md5, ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u FROM documents),
c AS (SELECT r, doc_id, u.source, text_chars, text_md5, count(*)::INT AS copies FROM u JOIN cdf ON u.source = cdf.source AND cdf.up <= u.u GROUP BY ALL),
e AS (SELECT *, unnest(range(1, copies + 1))::INT AS copy_no FROM c)
SELECT doc_id, source, copies, copy_no, substr(md5('7:' || coalesce(doc_id::VARCHAR, '') || ':' || copy_no::VARCHAR), 1, 16) AS shuffle_key, text_chars, text_md5 FROM e
"""


def _bound(m: str, slack: float, mark: str) -> str:
    """Median + REACH * (median - lower quartile) + slack; the sketches are exact up to their size, as quantile_disc is."""
    return f"quantile_disc({m}, 0.5) + {quality.REACH} * (quantile_disc({m}, 0.5) - quantile_disc({m}, 0.25)) + {slack} AS {m}_{mark}"


def op4_sql() -> str:
    """Words, windows of five words and lines of every text; thresholds by group, language and all (exact while no group outgrows a sketch)."""
    space = r"[\x20\x09-\x0D]"
    measures = quality.MEASURES.items()
    bounds = lambda mark: ", ".join(_bound(m, slack, mark) for m, slack in measures)
    least = quality.LEAST_ROWS
    fine = " AND ".join(f"m.{m} <= CASE WHEN n_own >= {least} THEN {m}_own WHEN n_lang >= {least} THEN {m}_lang ELSE {m}_all END" for m, _ in measures)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '{space}+'), lambda x: x <> '') AS w FROM documents),
pos AS (SELECT r, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5),
win AS (SELECT r, i, array_to_string(w[i : i + 4], ' ') AS g FROM pos),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS j FROM twice) GROUP BY r),
ln AS (SELECT r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
m0 AS (SELECT d.r, doc_id, lang, source, len(w) AS n_words, coalesce(length(array_to_string(w, '')), 0) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
  len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines, coalesce(rep.n, 0) AS n_repeat_words, len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutter
  FROM d JOIN ln USING (r) LEFT JOIN rep USING (r)),
m AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, n_symbols::DOUBLE / greatest(n_words, 1) AS symbol_share, n_dup_lines::DOUBLE / (n_lines + 5) AS dup_line_share,
  n_repeat_words::DOUBLE / greatest(n_words, 1) AS repeat_share, n_stutter::DOUBLE / greatest(n_words, 1) AS stutter_share, word_chars::DOUBLE / greatest(n_words, 1) AS mean_word FROM m0),
own AS (SELECT lang, source, count(*) AS n_own, {bounds('own')} FROM m GROUP BY lang, source), lg AS (SELECT lang, count(*) AS n_lang, {bounds('lang')} FROM m GROUP BY lang), al AS (SELECT {bounds('all')} FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {fine} AS kept
FROM m JOIN own ON m.lang IS NOT DISTINCT FROM own.lang AND m.source IS NOT DISTINCT FROM own.source JOIN lg ON m.lang IS NOT DISTINCT FROM lg.lang, al
"""


def oracle_sql() -> dict[str, str]:
    """Queries 1, 2, 3, 5, 6, 9, 10 and the pipeline hold trained models, hashes or encodings that SQL lacks."""
    return {"op4_quality": op4_sql(), "op7_line_dedup": OP7_SQL, "op8_mixing": OP8_SQL}
