"""Line de-duplication by a deletion-neighbourhood join.

Lines are compared without outer white space and in lower case.  A line goes
if an earlier line of the corpus (by doc_id, row and position) is equal to it or
one character edit away; the earliest stays.  Lines without a word stay.  The
row is the fixed place of the row in its file, so equal ids are told apart.

1. Equal lines: one aggregation over hash and length, with partial results,
   finds each distinct line's first place.  A line in a third of all documents
   is one group of one row.
2. Near lines: two lines one edit apart agree on the first or the last half of
   the shorter one.  Only distinct lines that share such a half (hashed, with
   the shorter length) with another one can have a near line, so no link is lost
   by going on with these.  All strings that delete at most one character from
   them are emitted as hashed keys; equal keys meet, and the edit distance to the
   earliest line of a key is verified.  Lines that delete at the same place are
   all one substitution apart, so each is compared with the key's earliest line
   only; a line that is itself the key is compared with those that delete to it.
   No list of pairs arises from a crowd.  Lines that share a key differ in one
   character at most each way, so a key has no more of them than a line has
   characters times the alphabet, however large the corpus is.
3. First places without an earlier near line stay; their positions go back to
   the documents by doc_id and row.

Edge cases: a null text stays null and has no line; rows with equal doc_id, or
with a null one, follow each other by their places in the files, and a line stays
in the first of them only; null ids come first; an empty table gives an empty
result; very long lines are compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, fresh, numberable, release, row_number, written
from .quality import let

EDITS = 1
#: Outer white space.
BLANKS = " \t\x0b\x0c\r"
#: An odd multiplier and its inverse modulo 2**64, for hashes of strings with one character taken out.
STEP = 0x9E3779B97F4A7C15
BACK = pow(STEP, -1, 1 << 64)


def normal(line: Column) -> Column:
    return F.lower(F.btrim(line, F.lit(BLANKS)))


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, row, pos, line (normalised) of every line with a word."""
    got = docs.select("doc_id", "row", F.posexplode(F.split(F.col("text"), "\n")).alias("pos", "raw"))
    return got.select("doc_id", "row", "pos", normal(F.col("raw")).alias("line")).filter("line != ''")


def _halves(n: Column, line: Column) -> Column:
    """Keys of which two lines within one edit share one: the shorter length with its first or last half (a clash costs work, not results)."""
    keys = []
    for m in (n, n - 1):
        k = F.greatest(F.floor(m / 2).cast("int"), F.lit(0))
        keys += [F.xxhash64(m, F.lit(0), F.substr(line, F.lit(1), k)), F.xxhash64(m, F.lit(1), F.substr(line, n - k + 1, k))]
    return F.array(*keys)


def variants(line: str) -> np.ndarray:
    """Keys of the line (at index 0) and of the line without its i-th character (at index i); linear in its length."""
    code = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(code)
    code = (code + np.uint64(0x2545F491)) * np.uint64(0xD6E8FEB86659FD93)
    code ^= code >> np.uint64(29)
    power = np.full(n + 1, STEP, np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * power[:n], dtype=np.uint64)])
    out = np.empty(n + 1, np.uint64)
    out[0] = sums[n]
    out[1:] = sums[:n] + (sums[n] - sums[1:]) * np.uint64(BACK)
    size = np.full(n + 1, n - 1, np.uint64)
    size[0] = n
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xA0761D6478BD642F) + size
    return out.view(np.int64)


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, doc_id, row, pos, line → id, doc_id, row, pos, key, at: a row for each variant, in lots of bounded size."""
    for b in batches:
        lot, size = [], 0
        for r, line in enumerate(b.column("line").to_pylist()):
            keys = variants(line)
            lot.append((r, keys))
            size += len(keys)
            if size >= 200_000:
                yield _rows(b, lot)
                lot, size = [], 0
        if lot:
            yield _rows(b, lot)


def _rows(b: pa.RecordBatch, lot: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    at = pa.array(np.repeat([r for r, _ in lot], [len(k) for _, k in lot]))
    cols = [b.column(c).take(at) for c in ("id", "doc_id", "row", "pos")]
    return pa.RecordBatch.from_arrays([*cols, pa.array(np.concatenate([k for _, k in lot])), pa.array(np.concatenate([np.arange(len(k), dtype=np.int32) for _, k in lot]))], ["id", "doc_id", "row", "pos", "key", "at"])


def _candidates(lines: DataFrame) -> DataFrame:
    """(a, b): ids of lines that share a variant, a at the earlier place; every b with a near earlier line is among them.

    Variants are dealt by key once; windows over a key find its earliest line for
    each deleted place, and the line that is the key itself.
    """
    kind = lines.schema["doc_id"].dataType.simpleString()
    var = lines.select("id", "doc_id", "row", "pos", "line").mapInArrow(_emit, f"id bigint, doc_id {kind}, row bigint, pos int, key bigint, at int")
    place = F.struct("doc_id", "row", "pos", "id")
    # one substitution: the same key by deleting at the same place; the earliest line rules the others out
    first = F.min(place).over(Window.partitionBy("key", "at"))
    # one insertion: the shorter line is itself the key
    short = F.min(F.when(F.col("at") == 0, place)).over(Window.partitionBy("key"))
    met = var.withColumn("short", short).withColumn("first", first).filter("at > 0 AND (short IS NOT NULL OR first.id != id)")
    early = F.col("short") < place
    subs = F.when(F.col("first.id") != F.col("id"), F.struct(F.col("first.id").alias("a"), F.col("id").alias("b")))
    ins = F.when(F.col("short").isNotNull(), F.when(early, F.struct(F.col("short.id").alias("a"), F.col("id").alias("b"))).otherwise(F.struct(F.col("id").alias("a"), F.col("short.id").alias("b"))))
    return met.select(F.explode(F.array_compact(F.array(subs, ins))).alias("p")).select("p.a", "p.b").distinct()


def near_firsts(lines: DataFrame) -> DataFrame:
    """id of each distinct line (id, doc_id, row, pos, line) that has a line one edit away at an earlier place."""
    pairs = cut(_candidates(lines))
    left, right = lines.select(F.col("id").alias("a"), F.col("line").alias("line_a")), lines.select(F.col("id").alias("b"), F.col("line").alias("line_b"))
    true = pairs.join(left, "a").join(right, "b").filter(F.levenshtein("line_a", "line_b", EDITS) >= 0)
    return true.select(F.col("b").alias("id")).distinct()


def _first_places(some: DataFrame) -> DataFrame:
    """id, doc_id, row, pos, keys of every distinct line, at its first place."""
    n = F.length("line")
    own = _lines(some).select(F.xxhash64("line").alias("id"), n.alias("n"), "doc_id", "row", "pos", _halves(n, F.col("line")).alias("keys"))
    firsts = own.groupBy("id", "n").agg(F.min(F.struct("doc_id", "row", "pos", "keys")).alias("best"))
    return written(firsts.select("id", "best.*"), "lines")


def _suspects(some: DataFrame, firsts: DataFrame) -> DataFrame:
    """id, doc_id, row, pos, line of the distinct lines that share a half with another one."""
    keyed = firsts.select("id", F.explode("keys").alias("key"))
    # counted with partial results: a half that very many lines share is one row of the look-up side
    shared = keyed.groupBy("key").count().filter("count > 1").select("key")
    members = keyed.join(shared, "key", "left_semi").select("id").distinct()
    # the first places of these lines are read again, with their text
    wanted = firsts.join(members, "id", "left_semi").select("id", F.col("doc_id").alias("at_doc"), F.col("row").alias("at_row"), "pos")
    texts = some.join(wanted, (F.col("row") == F.col("at_row")) & F.col("doc_id").eqNullSafe(F.col("at_doc")))
    near = texts.select("id", "doc_id", "row", "pos", normal(F.get(F.split("text", "\n"), F.col("pos"))).alias("line")).filter(F.xxhash64("line") == F.col("id")).dropDuplicates(["id"])
    return written(near, "near-lines")


def kept_places(docs: DataFrame) -> DataFrame:
    """doc_id, row, places (sorted positions of the lines with a word that stay) of a numberable table."""
    some = docs.select("doc_id", row_number(docs).alias("row"), "text").filter("text IS NOT NULL")
    firsts = _first_places(some)
    release(docs.sparkSession)
    near = _suspects(some, firsts)
    release(docs.sparkSession)
    gone = cut(near_firsts(near))
    release(docs.sparkSession)
    return firsts.join(gone, "id", "left_anti").groupBy("doc_id", "row").agg(F.sort_array(F.collect_list("pos")).alias("places"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The rows, columns as given, with repeated and near-repeated lines taken out of the text (n_chars, if given, follows)."""
    docs = numberable(docs)
    key, row, at, held = (fresh(k, docs.columns) for k in ("line_doc", "line_row", "line_at", "line_places"))
    rows = docs.select(*docs.columns, row_number(docs).alias(row))
    both = rows.join(kept_places(docs).toDF(key, at, held), (F.col(row) == F.col(at)) & F.col("doc_id").eqNullSafe(F.col(key)), "left")
    places = F.coalesce(F.col(held), F.array().cast("array<int>"))

    def rebuilt(lines: Column) -> Column:
        numbered = F.transform(lines, lambda x, i: F.when(x.rlike(r"[^\x20\x09-\x0D]"), F.lit(None)).otherwise(i))
        blank = F.filter(numbered, lambda i: i.isNotNull())
        inside = F.filter(places, lambda i: i < F.size(lines))
        return F.array_join(F.transform(F.array_sort(F.array_union(inside, blank)), lambda i: F.get(lines, i)), "\n")

    text = F.when(F.col("text").isNotNull(), let(F.split("text", "\n"), rebuilt))
    out = both.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
