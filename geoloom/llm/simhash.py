"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits.  Two fingerprints at
most two bits apart have one segment that differs in one bit at most, so both
own the same one-wildcard variant of that segment.  The 64 variants of each
distinct fingerprint are joined on equality and the pairs verified.

A variant that more than two distinct fingerprints share (a crowd: thousands of
near copies) is not expanded into pairs.  Its members are linked through their
one-flip neighbours instead: two fingerprints are at most two bits apart exactly
if their sets {itself, each of its 64 one-bit flips} meet, so a star on each
shared neighbour finds every link without any pair list.

Edge cases: null and empty texts have fingerprint zero and link like others;
repeated rows give repeated result rows; an empty table gives an empty result;
rows with a null doc_id keep it and take the smallest id of their class.
``keep_first`` keeps one row of each class: that with the smallest doc_id (null
ids come last), and of rows with that id the first by its fixed place in the files.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, numberable, row_number
from .components import components

WORDS, SEED, MAX_BITS = 3, 42, 2
#: Shingles whose bits are unpacked at once.
BLOCK = 8192


def fingerprint(text: str | None, width: int = WORDS, seed: int = SEED) -> int:
    """SimHash of a text's word shingles as an unsigned number; no word: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < width:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: len(words) - width]]
    digest = xxhash.xxh64_digest
    n, ones = len(starts), np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        cutoff = min(n, at + BLOCK)
        raw = b"".join([digest(line[s : e - 1], seed) for s, e in zip(starts[at:cutoff], ends[at + width - 1 : cutoff + width - 1])])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = WORDS, seed: int = SEED) -> DataFrame:
    """The given columns but the text, and fp (the fingerprint's bits as a signed long), of every row; ``text`` is the last column."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t, width, seed) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(np.array(fps, np.uint64).view(np.int64))], [*b.schema.names[:-1], "fp"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields[:-1])
    return docs.mapInArrow(rows, f"{kinds}, fp bigint")


def _variants(fps: DataFrame) -> DataFrame:
    """The one-wildcard variants of both segments: key (wildcard position and rest of the segment), fp."""
    low = F.lit(0xFFFFFFFF).cast("bigint")
    at = F.explode(F.sequence(F.lit(0), F.lit(63))).alias("at")
    half = F.when(F.col("at") < 32, F.col("fp").bitwiseAND(low)).otherwise(F.shiftrightunsigned("fp", 32))
    hole = F.expr("shiftleft(1L, at % 32)")
    return fps.select("fp", at).select((F.col("at").cast("bigint") * F.lit(1 << 32) + half.bitwiseAND(F.bitwise_not(hole))).alias("key"), "fp")


def _stars(crowd: DataFrame) -> DataFrame:
    """Links of a crowd's members: each to the smallest fingerprint with which it shares a one-flip neighbour."""
    flips = F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")
    near = crowd.select("fp", F.explode(flips).alias("near"))
    hub = near.groupBy("near").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1").select("near", "a")
    return near.join(hub, "near").filter("a != fp").select("a", F.col("fp").alias("b")).distinct()


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints at most two bits apart; each link is a true one or a star through a shared neighbour."""
    keyed = _variants(fps)
    shared = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1")
    shared = cut(shared)
    pairs = shared.filter("n = 2 AND bit_count(a ^ b) <= 2").select("a", "b").distinct()
    crowds = shared.filter("n > 2").select("key")
    crowd = cut(keyed.join(crowds, "key", "left_semi").select("fp").distinct())
    return pairs.union(_stars(crowd))


def near_duplicates(docs: DataFrame, width: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, fp, component_id of every row: classes of texts linked by fingerprints at most two bits apart."""
    got = cut(fingerprints(docs.select("doc_id", "text"), width, seed))
    classes = got.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    classes = cut(classes)
    joined = components(links(classes.select("fp")))
    named = classes.join(joined, classes.fp == joined.node, "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = named.filter(F.col("root") != F.col("fp")).select("root").distinct()
    # only fingerprints of classes with two members or more need the smallest id of the class
    many = named.join(least, "root", "left_semi")
    firsts = many.groupBy("root").agg(F.min("rep").alias("first"))
    ids = named.join(firsts, "root", "left").select("fp", F.least(F.coalesce("first", "rep"), F.coalesce("rep", "first")).alias("component_id"))
    return got.join(ids, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each class stays: the one with the smallest doc_id (the first of its rows); columns as given."""
    docs = numberable(docs)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row").alias("place")
    got = fingerprints(docs.select("doc_id", row_number(docs).alias("row"), "text"))
    # one row for each fingerprint, with partial results: a crowd of copies is one row
    classes = cut(got.groupBy("fp").agg(F.min(place).alias("rep")))
    joined = components(links(classes.select("fp")))
    named = classes.join(joined, classes.fp == joined.node, "left").select("rep", F.coalesce("root", "fp").alias("root"))
    key, row, kept_row = (fresh(k, docs.columns) for k in ("kept_id", "row", "kept_row"))
    kept = named.groupBy("root").agg(F.min("rep").alias("rep")).select(F.col("rep.doc_id").alias(key), F.col("rep.row").alias(kept_row))
    rows = docs.select(*docs.columns, row_number(docs).alias(row))
    return rows.join(kept, (F.col(row) == F.col(kept_row)) & F.col("doc_id").eqNullSafe(F.col(key)), "left_semi").select(*docs.columns)
