"""Approximate nearest neighbours by inner product, with vantage-point trees per shard.

Inner product is no metric, so vectors get one more component, sqrt(M^2 - |x|^2) with M the largest
norm; a query gets 0 there. The Euclidean distance then falls as the inner product rises, and
triangle-inequality pruning is sound.

A small tree, fitted on a bounded sample, deals all vectors into shards. Each of its nodes splits by
the distance to a vantage point at the median; its leaves are the shards. A shard with more than
`SHARD_ROWS` vectors is cut by hash into parts, so many equal vectors cost no task its memory. In
each part a vantage-point tree is built over all of its vectors, and queries walk down it in batches:
a side is skipped if its shell is farther than `factor` times the current 20th distance allows.
Factor 1 is exact search; less prunes more. Queries visit shards in two rounds: their own first,
then those that the distance found so far does not rule out, again relaxed by the factor.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from aerolith.session import stored

NEAREST = 20
FACTOR = 0.8
SHARDS_DEEP = (4, 10)  # levels of the tree that deals vectors into shards, at least and at most
SAMPLE_ROWS = 16  # vectors that it is fitted on, for each shard
LEAST_SAMPLE = 4096
SHARD_ROWS = 50_000
QUERY_ROWS = 20_000
LEAF = 256
_QUERY_BLOCK, _ROW_BLOCK = 1024, 4096  # scores worked out at once
_SLACK = 1e-9


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding as doubles, without vectors that are null or zero or hold a null or a
    component that is not finite, without those too long for a double, and without null ids."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    nonzero = F.exists(v, lambda x: x != 0)
    square = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x)
    own = vectors.select("vec_id", v.cast("array<double>").alias("embedding"))
    return own.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").filter(finite & nonzero).filter(square < float("inf"))


def one_per_id(vectors: DataFrame) -> DataFrame:
    """Repeated rows count once; of different vectors with one vec_id the smallest stands."""
    return vectors.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return values.reshape(len(column), -1)


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(top * top - np.einsum("ij,ij->i", x, x), 0.0))
    return np.hstack([x, rest[:, None]])


def distances(x: np.ndarray, point: np.ndarray) -> np.ndarray:
    gap = x - point
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


def scores(x: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, summed alike for equal vectors wherever they are."""
    return (x * query).sum(axis=1)


# Trees ------------------------------------------------------------------------------------------


@dataclass
class Node:
    """A vantage point and the radius that splits: what is nearer is inside. Bounds are the least
    and greatest distance to the point on either side. A leaf has `rows` alone."""

    rows: np.ndarray | None = None
    point: np.ndarray | None = None
    radius: float = 0.0
    inside: Node | None = None
    outside: Node | None = None
    bounds: tuple[float, float, float, float] = (0.0, 0.0, 0.0, 0.0)
    shard: int = -1


def build(x: np.ndarray, rows: np.ndarray, rng: np.random.Generator, leaf: int, deep: int = 64) -> Node:
    """Split at the median distance to a vantage point, down to `leaf` rows or `deep` levels."""
    if len(rows) <= leaf or deep == 0:
        return Node(rows=rows)
    point = x[rows[rng.integers(len(rows))]]
    away = distances(x[rows], point)
    radius = float(np.median(away))
    near = away < radius
    if not near.any():  # half of the rows or more are copies of the point
        near = away <= radius
        if near.all():
            return Node(rows=rows)
    a, b = away[near], away[~near]
    return Node(
        point=point,
        radius=radius,
        inside=build(x, rows[near], rng, leaf, deep - 1),
        outside=build(x, rows[~near], rng, leaf, deep - 1),
        bounds=(float(a.min()), float(a.max()), float(b.min()), float(b.max())),
    )


def shell_gap(away: np.ndarray, low: float, high: float) -> np.ndarray:
    """How far at least a point at these distances is from all points of the shell."""
    return np.maximum(np.maximum(low - away, away - high), 0.0)


class Nearest:
    """The best rows found so far for a batch of queries."""

    def __init__(self, queries: np.ndarray, ids: np.ndarray, k: int, reach: np.ndarray):
        self.queries, self.ids, self.k = queries, ids, k
        self.found: list[tuple[np.ndarray, np.ndarray]] = [
            (np.empty(0), np.empty(0, np.int64)) for _ in range(len(ids))
        ]
        self.reach = reach.copy()  # squared-distance bound given from outside, then the k-th found

    def offer(self, some: np.ndarray, x: np.ndarray, vec_ids: np.ndarray, lengths: np.ndarray) -> None:
        """Rows x, vec_ids to the queries at `some`. `lengths` are the queries' part of a squared
        distance, |q|^2 + M^2. Scores are held for a block of both at a time."""
        for a in range(0, len(some), _QUERY_BLOCK):
            for b in range(0, len(x), _ROW_BLOCK):
                rows = slice(b, b + _ROW_BLOCK)
                self._offer_block(some[a : a + _QUERY_BLOCK], x[rows], vec_ids[rows], lengths)

    def _offer_block(self, some: np.ndarray, x: np.ndarray, vec_ids: np.ndarray, lengths: np.ndarray) -> None:
        rough = self.queries[some] @ x.T
        for row, q in enumerate(some):
            have, have_ids = self.found[q]
            least = have[-1] if len(have) == self.k else -np.inf
            line = np.where(vec_ids == self.ids[q], -np.inf, rough[row])
            if len(line) > self.k:
                least = max(least, np.partition(line, len(line) - self.k)[len(line) - self.k])
            # Rough scores may be off in the last digits; exact ones decide.
            keep = line > -np.inf
            if np.isfinite(least):
                keep &= line >= least - _SLACK * max(1.0, abs(least))
            near = np.flatnonzero(keep)
            if not len(near):
                continue
            all_scores = np.concatenate([have, scores(x[near], self.queries[q])])
            all_ids = np.concatenate([have_ids, vec_ids[near]])
            order = np.lexsort((all_ids, -all_scores))[: self.k]
            self.found[q] = all_scores[order], all_ids[order]
            if len(order) == self.k:
                far = lengths[q] - 2 * all_scores[order][-1]
                self.reach[q] = min(self.reach[q], np.sqrt(max(far, 0.0)))


def search(tree: Node, x: np.ndarray, raw: np.ndarray, vec_ids: np.ndarray, best: Nearest, lifted_queries: np.ndarray, lengths: np.ndarray, factor: float) -> None:
    """Walk the tree with all queries at once, the nearer side first."""

    def visit(node: Node, some: np.ndarray) -> None:
        if not len(some):
            return
        if node.rows is not None:
            if len(node.rows):
                best.offer(some, raw[node.rows], vec_ids[node.rows], lengths)
            return
        away = distances(lifted_queries[some], node.point)
        in_low, in_high, out_low, out_high = node.bounds
        gap_in, gap_out = shell_gap(away, in_low, in_high), shell_gap(away, out_low, out_high)
        first_in = away < node.radius

        def needed(group, gap):
            return gap <= factor * best.reach[group] * (1 + _SLACK) + _SLACK

        a, b = some[first_in], some[~first_in]
        visit(node.inside, a[needed(a, gap_in[first_in])])
        visit(node.outside, b[needed(b, gap_out[~first_in])])
        visit(node.outside, a[needed(a, gap_out[first_in])])
        visit(node.inside, b[needed(b, gap_in[~first_in])])

    visit(tree, np.arange(len(best.ids)))


def thin_copies(node: Node, raw: np.ndarray, vec_ids: np.ndarray, k: int) -> None:
    """Leaves of equal vectors alone keep the k + 1 smallest ids. All score alike and ties go to the
    smaller id, so no query, which leaves out its own id at most, can take another."""
    stack = [node]
    while stack:
        node = stack.pop()
        if node.rows is None:
            stack += [node.inside, node.outside]
        elif len(node.rows) > k + 1 and (raw[node.rows] == raw[node.rows[0]]).all():
            node.rows = node.rows[np.argsort(vec_ids[node.rows])[: k + 1]]


# Shards -----------------------------------------------------------------------------------------


def shard_tree(sample: np.ndarray, deep: int) -> tuple[Node, int]:
    """The tree that deals vectors into shards, its leaves numbered."""
    root = build(sample, np.arange(len(sample)), np.random.default_rng(0), leaf=8, deep=deep)
    n, stack = 0, [root]
    while stack:
        node = stack.pop()
        if node.rows is not None:
            node.shard, n = n, n + 1
            node.rows = None
        else:
            stack += [node.inside, node.outside]
    return root, n


def shard_of(root: Node, x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), np.int32)

    def down(node: Node, rows: np.ndarray) -> None:
        if node.shard >= 0:
            out[rows] = node.shard
        elif len(rows):
            near = distances(x[rows], node.point) < node.radius
            down(node.inside, rows[near])
            down(node.outside, rows[~near])

    down(root, np.arange(len(x)))
    return out


def shards_in_reach(root: Node, x: np.ndarray, reach: np.ndarray, factor: float) -> list[np.ndarray]:
    """Per query: the shards whose region is not ruled out at factor * reach."""
    hits: list[list[int]] = [[] for _ in range(len(x))]

    def down(node: Node, rows: np.ndarray) -> None:
        if not len(rows):
            return
        if node.shard >= 0:
            for r in rows:
                hits[r].append(node.shard)
            return
        away = distances(x[rows], node.point)
        limit = factor * reach[rows] * (1 + _SLACK) + _SLACK
        down(node.inside, rows[away - node.radius <= limit])
        down(node.outside, rows[node.radius - away <= limit])

    down(root, np.arange(len(x)))
    return [np.array(h, np.int32) for h in hits]


# Spark ------------------------------------------------------------------------------------------


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = NEAREST,
    factor: float = FACTOR,
    shards_deep: int | None = None,
    sample: int | None = None,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id and score: each query's `k` best vectors other than its own.

    Both frames have vec_id and embedding. Vectors and queries that `usable` leaves out take no part,
    nor do those of another length than the vector of the smallest id. The number of shards grows
    with the number of vectors (`shards_deep` levels, from `SHARDS_DEEP`), so that a shard stays
    below `shard_rows` until the deepest tree is reached; the tree is fitted on a bounded sample. A vec_id is one vector and one query, however often its row is repeated (see
    `one_per_id`). All candidates are given if there are fewer than k; ties go to the smaller id.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    own = stored(one_per_id(usable(vectors)), "ann-vectors")
    asked = stored(one_per_id(usable(queries)), "ann-queries")
    smallest = own.orderBy("vec_id").select(F.size("embedding").alias("width")).first()
    if smallest is None:
        return spark.createDataFrame([], schema)
    same_length = F.size("embedding") == smallest["width"]
    own, asked = own.filter(same_length), asked.filter(same_length)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    n, top = own.agg(F.count(F.lit(1)), F.max(norm)).first()
    if shards_deep is None:
        least, most = SHARDS_DEEP
        shards_deep = min(most, max(least, math.ceil(math.log2(2 * n / shard_rows))))
    sample = sample or max(LEAST_SAMPLE, SAMPLE_ROWS << shards_deep)
    some = own.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding").collect()
    root, _ = shard_tree(lifted(np.array([r[0] for r in some]), top), shards_deep)

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("embedding"))
            yield batch.append_column("shard", pa.array(shard_of(root, lifted(x, top))))

    def route_query(batches):
        for batch in batches:
            x = matrix(batch.column("embedding"))
            query = np.hstack([x, np.zeros((len(x), 1))])
            yield batch.append_column("shard", pa.array(shard_of(root, query)))

    kinds = "vec_id long, embedding array<double>, shard int"
    dealt = stored(own.mapInArrow(route, kinds), "ann-dealt")
    sizes = dealt.groupBy("shard").count().collect()  # one row for each leaf of the shard tree
    parts = {r["shard"]: -(-r["count"] // shard_rows) for r in sizes}
    part_of = F.create_map(*[F.lit(x) for kv in parts.items() for x in kv])

    def within(placed: DataFrame) -> DataFrame:
        """Search queries (vec_id, embedding, shard, reach) in the shards they are given."""
        visits = placed.groupBy("shard").count().collect()
        copies = {r["shard"]: -(-r["count"] // query_rows) for r in visits}
        copies_of = F.create_map(*[F.lit(x) for kv in (copies or {-1: 0}).items() for x in kv])
        cut = lambda n: F.pmod(F.xxhash64("vec_id"), n).cast("int")
        # A part of a shard meets a slice of its queries: neither grows with the table.
        n_parts = F.coalesce(F.element_at(part_of, F.col("shard")), F.lit(1))
        n_slices = F.coalesce(F.element_at(copies_of, F.col("shard")), F.lit(0))
        each = lambda n: F.sequence(F.lit(0), n - 1)
        stock = dealt.filter(n_slices > 0).select(
            "shard", cut(n_parts).alias("part"), F.explode(each(n_slices)).alias("slice"),
            F.lit(0).alias("kind"), "vec_id", "embedding", F.lit(0.0).alias("reach"),
        )
        asks = placed.select(
            "shard", F.explode(each(n_parts)).alias("part"), cut(n_slices).alias("slice"),
            F.lit(1).alias("kind"), "vec_id", "embedding", "reach",
        )
        together = stock.unionByName(asks).repartition("shard", "part", "slice")
        ordered = together.sortWithinPartitions("shard", "part", "slice", "kind", "vec_id")
        return ordered.mapInArrow(
            _search_cells(k, factor, top), "query_id long, vec_id long, score double"
        )

    home = asked.mapInArrow(route_query, kinds).withColumn("reach", F.lit(float("inf")))
    home = stored(home, "ann-home")
    first = stored(within(home), "ann-first")
    kth = first.groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) >= k, F.get(F.sort_array(F.collect_list("score"), asc=False), F.lit(k - 1))).alias("kth")
    )

    def reach_out(batches):
        for batch in batches:
            x, at = matrix(batch.column("embedding")), batch.column("shard").to_numpy()
            kth = batch.column("kth").to_numpy(zero_copy_only=False).astype(float)
            far = np.einsum("ij,ij->i", x, x) + top * top - 2 * kth
            reach = np.where(np.isnan(kth), np.inf, np.sqrt(np.maximum(far, 0.0)))
            query = np.hstack([x, np.zeros((len(x), 1))])
            more = [h[h != a] for h, a in zip(shards_in_reach(root, query, reach, factor), at)]
            of = np.repeat(np.arange(len(x)), [len(m) for m in more])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(of)),
                    batch.column("embedding").take(pa.array(of)),
                    pa.array(np.concatenate([np.empty(0, np.int32), *more])),
                    pa.array(reach[of]),
                ],
                names=["vec_id", "embedding", "shard", "reach"],
            )

    known = home.drop("reach").join(kth, home["vec_id"] == kth["query_id"], "left").drop("query_id")
    second = stored(known.mapInArrow(reach_out, kinds + ", reach double"), "ann-second")
    everything = first.unionByName(within(second)).distinct()
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = everything.withColumn("rank", place).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _search_cells(k: int, factor: float, top: float):
    """Rows sorted by cell, its vectors before its queries, to each query's k best of the cell."""

    def search_sorted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, vecs, tree = None, [], None

        def answer(queries: list[pa.RecordBatch]) -> pa.RecordBatch:
            raw, ids, x, root = tree
            q = np.vstack([matrix(b.column("embedding")) for b in queries])
            q_ids = np.concatenate([b.column("vec_id").to_numpy() for b in queries])
            reach = np.concatenate([b.column("reach").to_numpy() for b in queries])
            lengths = np.einsum("ij,ij->i", q, q) + top * top
            best = Nearest(q, q_ids, k, reach)
            if len(ids):
                search(root, x, raw, ids, best, np.hstack([q, np.zeros((len(q), 1))]), lengths, factor)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(q_ids, [len(s) for s, _ in best.found])),
                    pa.array(np.concatenate([i for _, i in best.found] or [np.empty(0, np.int64)])),
                    pa.array(np.concatenate([s for s, _ in best.found] or [np.empty(0)])),
                ],
                names=["query_id", "vec_id", "score"],
            )

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("shard", "part", "slice", "kind")])
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *edges], [*edges, batch.num_rows]):
                run, key, kind = batch.slice(a, b - a), tuple(keys[:3, a]), keys[3, a]
                if key != cell:
                    cell, vecs, tree = key, [], None
                if kind == 0:
                    vecs.append(run)
                    continue
                if tree is None:
                    ids = np.concatenate([np.empty(0, np.int64), *(v.column("vec_id").to_numpy() for v in vecs)])
                    raw = np.vstack([matrix(v.column("embedding")) for v in vecs]) if vecs else np.empty((0, 0))
                    x = lifted(raw, top) if vecs else raw
                    root = build(x, np.arange(len(ids)), np.random.default_rng(0), LEAF)
                    thin_copies(root, raw, ids, k)
                    tree, vecs = (raw, ids, x, root), []
                yield answer([run])

    return search_sorted
