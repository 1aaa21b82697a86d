"""Approximate nearest neighbours by an inverted multi-index.

Two codebooks, one for each half of a vector, are fitted in numpy on a bounded
sample (``SAMPLE`` rows with the smallest hash of their id); they grow with the
square root of the table up to ``MOST_CENTROIDS`` each.  Every row is filed under
its pair of nearest centroids.  A query traverses the pairs by summed distance of
the halves with a heap until the visited pairs hold a share of all rows, then all
their entries are reranked by the inner product in double precision.  The share
is the smallest one that reaches ``RECALL`` on the sample itself, where
neighbours are sparser than in the whole table; vectors without structure need a
large share, clustered ones a small one.

Files of centroid pairs are packed into groups of bounded size; a pair with more
rows is dealt by the hash of its rows to several groups, all of which a query
visits.  Each row goes to its one group, a query to the groups of its pairs only,
with the distance of the last pair it visits; a group's rows are held while its
queries stream past.  Each meeting yields at most k rows for a query.  Nothing
that grows with the table comes to the driver: the sample, the codebooks and the
counts of the pairs are bounded.

Edge cases: vectors that are null, zero, hold null or non-finite components, or
have another length than most (no inner product with the others), and rows
without id take no part.  Every other row is a candidate for all rows but itself,
equal ids included, and each row of a query's id is a query of its own; ties go
to the smaller id; fewer than k candidates are all returned; an empty table gives
an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import numberable, row_number, written

LEAST_CENTROIDS, MOST_CENTROIDS, SAMPLE, ROUNDS, RECALL = 32, 512, 20_000, 10, 0.95
#: Rows of a group: a part of the table, within bounds; queries that meet a group at once; groups' partitions at most.
LEAST_GROUP, MOST_GROUP, GROUPS, QUERIES, PARTS, SEED = 512, 65_536, 32, 128, 20_000, 3


def centroids(rows: int) -> int:
    """Centroids of each half: pairs grow with the table, about 64 rows a pair, within bounds."""
    return min(MOST_CENTROIDS, max(LEAST_CENTROIDS, round(math.sqrt(rows) / 8)))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, row, embedding (as given if float, else double) of the rows that take part."""
    e = F.col("embedding")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    as_is = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    own = vectors.select("vec_id", row_number(vectors).alias("row"), (e if as_is else e.cast("array<double>")).alias("embedding"))
    return own.filter(F.col("vec_id").isNotNull() & e.isNotNull() & fine)


def codebook(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means centroids (fewer if there are fewer distinct vectors)."""
    x = x[rng.permutation(len(x))]
    c = np.unique(x[: 8 * k], axis=0)
    c = c[rng.permutation(len(c))[:k]]
    for _ in range(ROUNDS):
        near = distances(x, c).argmin(1)
        n = np.bincount(near, minlength=len(c))
        total = np.stack([np.bincount(near, x[:, j], len(c)) for j in range(x.shape[1])], axis=1)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None]


class MultiIndex:
    """Codebooks of both halves, the number of rows in each pair, and the share of rows to visit."""

    def __init__(self, sample: np.ndarray, k: int, size: int = LEAST_CENTROIDS):
        rng = np.random.default_rng(SEED)
        self.half = sample.shape[1] // 2
        self.books = [codebook(part, size, rng) for part in self.parts(sample)]
        self.wide = len(self.books[1])
        pairs = self.file(sample)
        self.counts = np.bincount(pairs, minlength=len(self.books[0]) * self.wide)
        self.share = self._calibrate(sample, pairs, k, rng)

    def parts(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.half], x[:, self.half :]

    def file(self, x: np.ndarray) -> np.ndarray:
        a, b = (distances(p, c).argmin(1) for p, c in zip(self.parts(x), self.books))
        return a * self.wide + b

    def summed(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances of both halves of each query to their centroids."""
        a, b = (distances(p, c) for p, c in zip(self.parts(q), self.books))
        return a, b

    def traverse(self, q: np.ndarray, need: int):
        """(pair, summed distance) by ascending distance until the pairs hold ``need`` rows (or all are visited)."""
        a, b = (distances(p[None], c)[0] for p, c in zip((q[: self.half], q[self.half :]), self.books))
        i, j = a.argsort(kind="stable"), b.argsort(kind="stable")
        a, b, i, j = a[i].tolist(), b[j].tolist(), i.tolist(), j.tolist()
        heap, seen, held, counts = [(a[0] + b[0], 0, 0)], [0] * len(a), 0, self.counts
        while heap and held < need:
            far, r, c = heapq.heappop(heap)
            pair = i[r] * self.wide + j[c]
            if counts[pair]:
                held += int(counts[pair])
                yield pair, far
            # the next pair of this row, and of the next row once this one is opened
            seen[r] = c + 1
            if c + 1 < len(b) and (r == 0 or seen[r - 1] > c + 1):
                heapq.heappush(heap, (a[r] + b[c + 1], r, c + 1))
            if r + 1 < len(a) and seen[r + 1] == c:
                heapq.heappush(heap, (a[r + 1] + b[c], r + 1, c))

    def _calibrate(self, x: np.ndarray, pairs: np.ndarray, k: int, rng: np.random.Generator) -> float:
        """The smallest share of rows that finds RECALL of the true neighbours of 200 sampled queries within the sample."""
        if len(x) <= 4 * k:
            return 1.0
        queries = rng.permutation(len(x))[:200]
        depth = []
        for at in queries:
            s = x @ x[at]
            s[at] = -np.inf
            rows_of = np.bincount(pairs[np.argpartition(-s, k)[:k]], minlength=len(self.counts))
            held = 0
            for pair, _ in self.traverse(x[at], len(x) + 1):
                depth += [held] * int(rows_of[pair])
                held += int(self.counts[pair])
        depth = np.sort(np.array(depth))
        return min(1.0, (depth[min(len(depth) - 1, math.ceil(RECALL * len(depth)))] + 1) / len(x))


def _exact(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products, added in an order that depends on the pair alone."""
    return np.add.reduce(np.ascontiguousarray(v * q), axis=1)


def packed(counts: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(first group, number of groups) of each pair, and all groups: pairs are packed in order, a large one has groups of its own."""
    first, parts, group, left = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64), -1, 0
    for pair in np.flatnonzero(counts):
        n = int(counts[pair])
        if n > room:
            first[pair], parts[pair] = group + 1, math.ceil(n / room)
            group, left = group + int(parts[pair]), 0
            continue
        if n > left:
            group, left = group + 1, room
        first[pair], left = group, left - n
    return first, parts, group + 1


class Rerank:
    """One partition of groups: the rows of a group come first and are held, its queries stream past."""

    def __init__(self, index: MultiIndex, dim: int, k: int):
        self.index, self.dim, self.k = index, dim, k

    def vectors(self, b: pa.RecordBatch) -> np.ndarray:
        return np.array(b.column("embedding").flatten(), np.float64).reshape(-1, self.dim)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, parts, held = None, [], None
        for whole in batches:
            grp = whole.column("grp").to_numpy()
            asks = np.asarray(whole.column("reach").is_valid())
            edges = np.flatnonzero(np.diff(grp) | np.diff(asks)) + 1
            for s, e in zip([0, *edges.tolist()], [*edges.tolist(), whole.num_rows]):
                if s == e:
                    continue
                b = whole.slice(s, e - s)
                if grp[s] != group:
                    group, parts, held = grp[s], [], None
                if not asks[s]:
                    parts.append(b)
                    continue
                if held is None:
                    rows = pa.Table.from_batches(parts, whole.schema).combine_chunks()
                    v = np.concatenate([self.vectors(x) for x in parts]) if parts else np.zeros((0, self.dim))
                    held, parts = (v, rows["pair"].to_numpy(), rows["vec_id"].to_numpy(), rows["row"].to_numpy()), []
                for at in range(0, b.num_rows, QUERIES):
                    yield self.met(b.slice(at, QUERIES), *held)

    def met(self, asked: pa.RecordBatch, v: np.ndarray, pair: np.ndarray, ids: np.ndarray, row: np.ndarray) -> pa.RecordBatch:
        """The k best rows of a group for each query, among the pairs within its reach."""
        q, k, out = self.vectors(asked), self.k, []
        reach, q_row, q_id = asked.column("reach").to_numpy(), asked.column("row").to_numpy(), asked.column("vec_id").to_numpy()
        a, b = self.index.summed(q)
        rough = q @ v.T
        for r in range(len(q) if len(v) else 0):
            far = a[r][pair // self.index.wide] + b[r][pair % self.index.wide]
            own = np.flatnonzero((far <= reach[r] + 1e-9 * (1 + abs(reach[r]))) & ((row != q_row[r]) | (ids != q_id[r])))
            if len(own) > k:
                s = rough[r, own]
                least = np.partition(s, len(s) - k)[len(s) - k]
                own = own[s >= least - 1e-9 * (1 + abs(least))]
            exact = _exact(v[own], q[r])
            best = np.lexsort((row[own], ids[own], -exact))[:k]
            out += [(r, int(own[i]), float(exact[i])) for i in best]
        at, own, score = zip(*out) if out else ((), (), ())
        at, own = np.array(at, np.int64), np.array(own, np.int64)
        of = asked.schema.field("vec_id").type
        return pa.RecordBatch.from_arrays([pa.array(q_id[at], of), pa.array(q_row[at], pa.int64()), pa.array(ids[own], of), pa.array(row[own], pa.int64()), pa.array(score, pa.float64())], ["query_id", "query_row", "vec_id", "row", "score"])


def search(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose vec_id is divisible by ``every``."""
    vectors = numberable(vectors)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    spark = vectors.sparkSession
    fine = usable(vectors)
    sizes = fine.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    dim, total = int(sizes[0]["d"]), int(sizes[0]["count"])
    fine = fine.filter(F.size("embedding") == dim)
    some = fine.orderBy(F.xxhash64("vec_id", "row"), "vec_id").limit(SAMPLE).select("embedding").toArrow()
    index = MultiIndex(np.array(some["embedding"].combine_chunks().flatten(), np.float64).reshape(-1, dim), k, centroids(total))
    e_kind = fine.schema["embedding"].dataType.simpleString()

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column("embedding").flatten(), np.float64).reshape(-1, dim)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(index.file(x).astype(np.int32))], [*b.schema.names, "pair"])

    filed = written(fine.mapInArrow(file, f"vec_id {kind}, row bigint, embedding {e_kind}, pair int"), "vectors")
    counts = np.zeros(len(index.counts), np.int64)
    for r in filed.groupBy("pair").count().collect():  # at most MOST_CENTROIDS ** 2 rows
        counts[r["pair"]] = r["count"]
    index.counts = counts
    need = max(math.ceil(index.share * total), min(total, 4 * k + 1))
    first, parts, groups = packed(counts, min(MOST_GROUP, max(LEAST_GROUP, math.ceil(total / GROUPS))))
    form = f"grp int, vec_id {kind}, row bigint, embedding {e_kind}, pair int, reach double"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row with its group."""
        for b in batches:
            pair = b.column("pair").to_numpy()
            at = first[pair] + b.column("row").to_numpy().astype(np.uint64) % parts[pair].astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *b.columns, pa.nulls(b.num_rows, pa.float64())], ["grp", *b.schema.names, "reach"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each query and group it visits, with the distance of the last pair it visits."""
        for whole in batches:
            for lot in range(0, whole.num_rows, 256):
                b = whole.slice(lot, 256)
                x = np.array(b.column("embedding").flatten(), np.float64).reshape(-1, dim)
                at, met, reach = [], [], []
                for r, q in enumerate(x):
                    far, seen = 0.0, set()
                    for pair, far in index.traverse(q, need):
                        seen.update(range(int(first[pair]), int(first[pair] + parts[pair])))
                    at += [r] * len(seen)
                    met += sorted(seen)
                    reach += [far] * len(seen)
                rows = b.take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), *rows.columns[:3], pa.nulls(len(at), pa.int32()), pa.array(reach, pa.float64())], ["grp", "vec_id", "row", "embedding", "pair", "reach"])

    rows = filed.select("vec_id", "row", "embedding", "pair").mapInArrow(place, form)
    asked = filed.filter(F.col("vec_id") % every == 0).select("vec_id", "row", "embedding").mapInArrow(visit, form)
    # a group is a partition; its rows (no reach) come before its queries
    dealt = rows.union(asked).repartitionById(min(groups, PARTS), F.col("grp") % min(groups, PARTS)).sortWithinPartitions("grp", F.col("reach").isNotNull())
    met = dealt.mapInArrow(Rerank(index, dim, k), f"query_id {kind}, query_row bigint, vec_id {kind}, row bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id", "row"))
    return met.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
