"""Near duplicates by 64-bit SimHash, found with BK-trees over shards of the fingerprints.

Fingerprints that differ in at most 2 bits agree in at least two of four 16-bit blocks. So each
fingerprint goes to six shards, one for each pair of blocks, keyed by those 32 bits: any two that
link meet in a shard. A shard with more than `SHARD_LIMIT` fingerprints is dealt again, by six of
the eight nibbles of its other two blocks (28 ways); such a part fixes 56 bits and so holds at most
256 fingerprints. In each shard a BK-tree, children keyed by their distance to the parent, finds
the neighbours of every fingerprint along the edges within the radius.

Trees are built where their shard's queries are instead of being broadcast: all trees together grow
with the corpus, a shard does not. A shard reports a star per group it has joined, not its links, so
the output is linear in any group's size; components of the stars are found by large-star and
small-star rounds, stored in the shared folder, without gathering the neighbours of anything.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from aerolith.session import stored

SHINGLE = 3
RADIUS = 2
SHARD_LIMIT = 4096
_SEED = 42
_HASHES_AT_ONCE = 1 << 16


# Fingerprints -----------------------------------------------------------------------------------


def simhash(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Bit set where over half of the shingles' XXH64 hashes have it; 0 without words.

    Works on UTF-8 bytes: A-Z are lower-cased, words are split at ASCII white space, and fewer words
    than a shingle count as one. Shingles count as often as they occur.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(words))
    starts, ends = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), _HASHES_AT_ONCE):
        spans = zip(starts[at : at + _HASHES_AT_ONCE], ends[at : at + _HASHES_AT_ONCE])
        hashes = np.array([digest(joined[a:b], _SEED) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(set_bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row. Null texts count as empty."""

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            found = np.array([simhash(t.as_py(), shingle) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([ids, pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    raw = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return raw.mapInArrow(measure, f"doc_id {kind}, fp long")


# Shards and trees -------------------------------------------------------------------------------


def _block(fp: Column, at: int, bits: int) -> Column:
    return F.shiftrightunsigned(fp, at * bits).bitwiseAND((1 << bits) - 1)


def _shard_keys(fp: Column) -> Column:
    """Six structs (shard, key): a pair of 16-bit blocks, then their values."""
    keys = [
        F.struct(
            F.lit(n).alias("pair"),
            F.shiftleft(_block(fp, i, 16), 16).bitwiseOR(_block(fp, j, 16)).alias("key"),
        )
        for n, (i, j) in enumerate(combinations(range(4), 2))
    ]
    return F.array(*keys)


def _part_keys(pair: Column, fp: Column) -> Column:
    """For shards that are dealt again: 28 structs (six nibbles out of the shard's other blocks)."""
    others = [sorted({0, 1, 2, 3} - set(p)) for p in combinations(range(4), 2)]
    rest = F.lit(None).cast("long")
    for n, (i, j) in enumerate(others):
        both = F.shiftleft(_block(fp, i, 16), 16).bitwiseOR(_block(fp, j, 16))
        rest = F.when(pair == n, both).otherwise(rest)
    parts = []
    for n, drop in enumerate(combinations(range(8), 2)):
        mask = 0xFFFFFFFF
        for nibble in drop:
            mask &= ~(0xF << (4 * nibble))
        parts.append(F.shiftleft(F.lit(n).cast("long"), 32).bitwiseOR(rest.bitwiseAND(mask)))
    return F.array(*parts)


class BKTree:
    """Values at their Hamming distance below their parent."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        if len(self.values) == 1:
            return
        at = 0
        while True:
            distance = (self.values[at] ^ value).bit_count()
            below = self.children[at].get(distance)
            if below is None:
                self.children[at][distance] = len(self.values) - 1
                return
            at = below

    def within(self, value: int, radius: int) -> list[int]:
        """Places of the values at most `radius` away."""
        found, stack = [], [0] if self.values else []
        while stack:
            at = stack.pop()
            distance = (self.values[at] ^ value).bit_count()
            if distance <= radius:
                found.append(at)
            for edge, below in self.children[at].items():
                if distance - radius <= edge <= distance + radius:
                    stack.append(below)
        return found


def joined_groups(values: list[int], radius: int) -> list[tuple[int, int]]:
    """(value, smallest value of its group) of all but the smallest of each group of links."""
    tree, leader = BKTree(), list(range(len(values)))

    def find(i: int) -> int:
        while leader[i] != i:
            leader[i] = leader[leader[i]]
            i = leader[i]
        return i

    for i, value in enumerate(values):
        for other in tree.within(value, radius):
            a, b = find(i), find(other)
            if a != b:
                low, high = (a, b) if values[a] < values[b] else (b, a)
                leader[high] = low
        tree.add(value)
    return [(v, values[find(i)]) for i, v in enumerate(values) if find(i) != i]


def _links_of_shards(radius: int):
    """Rows sorted by shard to the stars of each shard; a shard may go across batches."""

    def link(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, values, stars = None, [], []

        def close():
            if len(values) > 1:
                stars.extend(joined_groups([v & 0xFFFFFFFFFFFFFFFF for v in values], radius))

        def out():
            pairs = np.array(stars, np.uint64).reshape(-1, 2).view(np.int64)
            stars.clear()
            arrays = [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])]
            return pa.RecordBatch.from_arrays(arrays, names=["u", "v"])

        for batch in batches:
            *keys, fps = (c.to_pylist() for c in batch.columns)
            for *key, fp in zip(*keys, fps):
                if key != shard:
                    close()
                    shard, values = key, []
                values.append(fp)
            yield out()
        close()
        yield out()

    return link


def linked(nodes: DataFrame, radius: int = RADIUS, shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """Stars (u, v) that join all fingerprints `fp` of `nodes` (distinct) linked within a shard."""
    if not 0 <= radius <= 2:
        raise ValueError("shards by pairs of four blocks serve radii up to 2")
    routed = nodes.select("fp", F.inline(_shard_keys(F.col("fp"))))
    sizes = routed.groupBy("pair", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stored(
        routed.join(sizes, ["pair", "key"]).select(
            "pair", "key", "fp", (F.col("n") > shard_limit).alias("again")
        ),
        "simhash-shards",
    )
    whole = shared.filter(~F.col("again")).select("pair", "key", F.lit(-1).cast("long").alias("part"), "fp")
    parts = shared.filter("again").select(
        "pair", "key", F.explode(_part_keys(F.col("pair"), F.col("fp"))).alias("part"), "fp"
    )
    together = whole.unionByName(parts).repartition("pair", "key", "part")
    ordered = together.sortWithinPartitions("pair", "key", "part", "fp")
    return ordered.mapInArrow(_links_of_shards(radius), "u long, v long").distinct()


# Components -------------------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(u, v) to (node, root): the smallest node of each node's component, for all but the roots.

    Large-star and small-star rounds until nothing changes. Each round is stored, so a lost executor
    costs at most that round. Neighbours are never gathered: a node's smallest neighbour comes from a
    partial aggregation and goes back by a join, which adaptive execution splits for a hub.
    """
    edges = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = stored(_star(both, F.col("v") > F.col("u")), "large-star")
        edges = stored(_star(edges, F.lit(True)), "small-star")
        last, state = state, _state(edges)
        if state == last:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _star(edges: DataFrame, moves: Column) -> DataFrame:
    """Join u and those neighbours v that move to the smallest node of u and its neighbours."""
    lowest = edges.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    lowest = lowest.select("c", F.least("c", "m").alias("m"))
    beside = edges.join(lowest, F.col("u") == F.col("c"))
    pairs = beside.select(
        F.inline(
            F.array(
                F.struct(F.when(moves, F.col("v")).alias("u"), F.col("m").alias("v")),
                F.struct(F.col("c").alias("u"), F.col("m").alias("v")),
            )
        )
    )
    return pairs.filter(F.col("u") > F.col("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


# Whole operator ---------------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id reachable over links, of every row of `docs`.

    Null texts count as empty, and empty texts link like any others. Repeated rows come back as often
    as they occur. Null doc_ids never name a component that has another (null if it has none).
    """
    marked = stored(fingerprints(docs, shingle), "fingerprints")
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-nodes")
    roots = components(linked(nodes, radius))
    placed = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    firsts = placed.groupBy(F.col("root").alias("r")).agg(F.min("first_id").alias("component_id"))
    classes = placed.join(firsts, F.col("root") == F.col("r")).select(
        F.col("fp").alias("f"), "root", "component_id"
    )
    return marked.join(classes, F.col("fp") == F.col("f")).select("doc_id", "fp", "root", "component_id")


def fingerprint_text(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _with_fingerprint(docs: DataFrame, name: str, shingle: int) -> DataFrame:
    """The rows of `docs` with their fingerprint in a further column."""
    at = docs.columns.index("text")

    def measure(batches):
        for batch in batches:
            found = np.array([simhash((t.as_py() or "").encode(), shingle) for t in batch.column(at)], np.uint64)
            yield batch.append_column(name, pa.array(found.view(np.int64)))

    return docs.mapInArrow(measure, T.StructType([*docs.schema, T.StructField(name, T.LongType())]))


def keep_first(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each group of near duplicates: that with the group's smallest doc_id.

    Where several rows of the group have this doc_id, or none of the group has any, one of them
    stays. Other columns play no part and stay as they are.
    """
    classes = near_duplicates(docs, shingle, radius)
    chosen = stored(
        classes.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
            "doc_id", "root", "fp"
        ),
        "simhash-chosen",
    )
    ids = chosen.groupBy(F.col("doc_id").alias("_id")).agg(F.count(F.lit(1)).alias("n"))
    once = F.col("_id").isNotNull() & (F.col("n") == 1)
    single = stored(ids.filter(once).select("_id"), "simhash-single")
    several = stored(ids.filter(~once).select("_id"), "simhash-several")
    # An id that one chosen row has still may belong to rows of other groups that are not chosen.
    elsewhere = classes.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id")
    elsewhere = single.join(elsewhere, F.col("_id") == F.col("doc_id"), "left_semi")
    elsewhere = stored(elsewhere, "simhash-elsewhere")
    plain = single.join(elsewhere, "_id", "left_anti")
    unique = docs.join(plain.hint("shuffle_hash"), docs["doc_id"] == plain["_id"], "left_semi")
    # Ids alone do not tell the rest: find their rows again by fingerprint, one for each group.
    odd = several.unionByName(elsewhere)
    some = docs.join(odd, docs["doc_id"].eqNullSafe(odd["_id"]), "left_semi")
    name = "_fingerprint"
    while name in docs.columns:
        name += "_"
    found = _with_fingerprint(some, name, shingle)
    keys = chosen.select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp"), F.col("root").alias("_root"))
    keys = keys.distinct()
    whole = found.select(F.struct(*docs.columns).alias("_row"), F.col(name).alias("_own"))
    matched = whole.join(
        keys, whole["_row.doc_id"].eqNullSafe(keys["_id"]) & (whole["_own"] == keys["_fp"])
    )
    one = matched.groupBy("_id", "_root").agg(F.first("_row").alias("_row")).select("_row.*")
    return unique.unionByName(one)
