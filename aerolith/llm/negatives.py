"""Hard negatives for contrastive training: the nearest rows of another label that are not too near.

Candidates lie in blocks: ordered by label and then along a Hilbert curve through the components that
spread most, cut every `BLOCK_ROWS` rows, stored as Parquet by shelf (one range of the order each).
A zone map holds the least and greatest label and, per component, the least and greatest value of
each block. Interval arithmetic on it bounds all scores that a block can give an anchor, and so
decides which blocks the anchor's windows must read.

One search serves both steps. Anchors come with windows of scores and ask for the k best rows in
each. The block with the greatest bound is read first; its scores raise the windows' floors, and then
every other block whose bounds still meet a window is read. Positives are the best rows of the same
label in an endless window; every positive then sets a window for negatives.

Anchors and zone maps meet in slices of bounded size, and so do anchors and blocks, so no task holds
more of either, however many anchors need one block. Scores are whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from aerolith.llm.vectors import integers, lists, one_length
from aerolith.session import scratch_path, stored

POSITIVES = 5
NEGATIVES = 3
FROM_PERCENT, TO_PERCENT = 50, 95
BLOCK_ROWS = 2048
SHELF_BLOCKS = 64
ANCHOR_ROWS = 2048  # anchors of a slice
ZONE_ROWS = 4096  # zones of a chunk
CURVE_DIMS = 8
CURVE_BITS = 7  # per component; all bits together fit a long
_LEAST_SHELVES = 8
_ANYTHING = 2**62
_AT_ONCE = 256  # anchors scored together
_SLACK = 1e-9
_STRIDE = 2**32  # block numbers of one shelf


# The curve --------------------------------------------------------------------------------------


def along_curve(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (rows of coordinates below 2**bits) on the Hilbert curve.

    Skilling's transform: from the coarsest bit on, each coordinate reflects or exchanges the first
    one's finer bits; a Gray code over all coordinates follows, then their bits are interleaved.
    """
    axes = [c.astype(np.int64) for c in cells.T]
    for bit in range(bits - 1, 0, -1):
        finer = (1 << bit) - 1
        for i, own in enumerate(axes):
            high = (own >> bit) & 1 == 1
            swapped = np.where(high, 0, (axes[0] ^ own) & finer)
            axes[0] = axes[0] ^ np.where(high, finer, swapped)
            if i:
                axes[i] = own ^ swapped
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros_like(axes[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((axes[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    place = np.zeros_like(axes[0])
    for bit in range(bits - 1, -1, -1):
        for own in axes:
            place = (place << 1) | (((own ^ turn) >> bit) & 1)
    return place


def spread(rows: DataFrame, width: int) -> list:
    """Per component: position, number, sum, sum of squares, least and greatest value. All rows."""

    def run(batches):
        n, parts = 0, []
        for batch in batches:
            if batch.num_rows:
                x = integers(batch.column("whole"), width).astype(np.float64)
                n += len(x)
                parts.append((x.sum(0), (x * x).sum(0), x.min(0), x.max(0)))
        if n:
            total, squares, low, high = (np.array(p) for p in zip(*parts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(width), pa.int32()), pa.array(np.full(width, n)),
                 *[pa.array(v) for v in (total.sum(0), squares.sum(0), low.min(0), high.max(0))]],
                names=["at", "n", "total", "squares", "low", "high"],
            )

    told = rows.select("whole").mapInArrow(
        run, "at int, n long, total double, squares double, low double, high double"
    )
    return told.groupBy("at").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    ).collect()  # a line per component


# Blocks and zone maps ---------------------------------------------------------------------------


class Library:
    """Stored blocks, their zone maps, and how many there are of each."""

    def __init__(self, path: str, rows: DataFrame, zones: DataFrame, n_zones: int, width: int):
        self.path, self.rows, self.zones, self.n_zones, self.width = path, rows, zones, n_zones, width


def build_library(rows: DataFrame, width: int, block_rows: int = BLOCK_ROWS) -> Library | None:
    """Order `rows` (vec_id, label, whole), cut them into blocks and describe these."""
    told = spread(rows, width)
    if not told:
        return None
    n = told[0]["n"]
    by_spread = sorted(told, key=lambda r: (r["total"] ** 2 / r["n"] - r["squares"], r["at"]))
    chosen = by_spread[:CURVE_DIMS]
    at = [r["at"] for r in chosen]
    low = np.array([r["low"] for r in chosen])
    range_ = np.maximum(np.array([r["high"] for r in chosen]) - low, 1.0)

    def place(batches):
        for batch in batches:
            x = integers(batch.column("whole"), width)[:, at]
            cells = np.minimum((x - low) / range_ * 2**CURVE_BITS, 2**CURVE_BITS - 1).astype(np.int64)
            yield batch.append_column("place", pa.array(along_curve(cells, CURVE_BITS)))

    label = rows.schema["label"].dataType.simpleString()
    kinds = f"vec_id long, label {label}, whole array<int>"
    shelves = max(-(-n // (block_rows * SHELF_BLOCKS)), min(_LEAST_SHELVES, -(-n // block_rows)))
    order = ["label", "place", "vec_id"]
    sorted_ = rows.mapInArrow(place, f"{kinds}, place long").repartitionByRange(shelves, *order)

    def shelve(batches):
        shelf, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            block = shelf * _STRIDE + (seen + np.arange(batch.num_rows)) // block_rows
            seen += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("vec_id", "label", "whole")), pa.array(block),
                 pa.array(np.full(batch.num_rows, shelf, np.int32))],
                names=["vec_id", "label", "whole", "block", "shelf"],
            )

    shelved = f"{kinds}, block long, shelf int"
    path = scratch_path(rows.sparkSession, "negatives-blocks")
    sorted_.sortWithinPartitions(*order).mapInArrow(shelve, shelved).write.partitionBy("shelf").parquet(path)
    blocks = rows.sparkSession.read.schema(shelved).parquet(path)

    def describe(batches):
        for batch in batches:
            block = batch.column("block").to_numpy()
            x, labels = integers(batch.column("whole"), width), batch.column("label").to_numpy()
            edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1), len(block)]
            runs = [slice(a, b) for a, b in zip(edges[:-1], edges[1:]) if b > a]
            if runs:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block[r][0] for r in runs], pa.int64()),
                        pa.array([block[r][0] // _STRIDE for r in runs], pa.int32()),
                        pa.array([labels[r].min() for r in runs], pa.int64()),
                        pa.array([labels[r].max() for r in runs], pa.int64()),
                        lists(np.array([x[r].min(0) for r in runs]), pa.int32()),
                        lists(np.array([x[r].max(0) for r in runs]), pa.int32()),
                    ],
                    names=["block", "shelf", "label_low", "label_high", "low", "high"],
                )

    # A block that two tasks read has two zones; either one may call for it.
    zones = stored(
        blocks.select("label", "whole", "block").mapInArrow(
            describe, "block long, shelf int, label_low long, label_high long, low array<int>, high array<int>"
        ),
        "negatives-zones",
    )
    return Library(path, blocks, zones, zones.count(), width)


# Search -----------------------------------------------------------------------------------------


def _bounds(same_label: bool, width: int):
    """Which blocks of a chunk the anchors of a slice must read, with the greatest score possible."""

    def run(anchors: pa.Table, zones: pa.Table) -> pa.Table:
        out = {"anchor_id": [], "slice": [], "shelf": [], "block": [], "upper": []}
        if anchors.num_rows and zones.num_rows:
            a = integers(anchors["whole"], width).astype(np.float64)
            low, high = (integers(zones[c], width).astype(np.float64) for c in ("low", "high"))
            ids, label = anchors["vec_id"].to_numpy(), anchors["label"].to_numpy()
            floors = anchors["floors"].combine_chunks()
            n_windows = len(floors[0])
            floor = integers(floors, n_windows).astype(np.float64)
            ceiling = integers(anchors["ceilings"], n_windows).astype(np.float64)
            first, last = zones["label_low"].to_numpy(), zones["label_high"].to_numpy()
            blocks, shelf = zones["block"].to_numpy(), zones["shelf"].to_numpy()
            for at in range(0, len(a), _AT_ONCE):
                own = slice(at, at + _AT_ONCE)
                up, down = np.maximum(a[own], 0), np.minimum(a[own], 0)
                most, least = up @ high.T + down @ low.T, up @ low.T + down @ high.T
                mine = label[own][:, None]
                if same_label:
                    wanted = (first <= mine) & (mine <= last)
                else:
                    wanted = (first != mine) | (last != mine)
                meets = np.zeros_like(wanted)
                for w in range(n_windows):
                    slack = 1 + _SLACK * np.abs(most)
                    meets |= (most + slack >= floor[own, w][:, None]) & (least - slack <= ceiling[own, w][:, None])
                anchor, zone = np.nonzero(wanted & meets)
                out["anchor_id"].append(ids[own][anchor])
                out["shelf"].append(shelf[zone])
                out["block"].append(blocks[zone])
                out["upper"].append(most[anchor, zone])
            out["slice"] = [np.full(sum(map(len, out["block"])), anchors["slice"][0].as_py())]
        kinds = {"anchor_id": np.int64, "slice": np.int32, "shelf": np.int32, "block": np.int64, "upper": np.float64}
        return pa.table({
            name: pa.array(np.concatenate([np.empty(0, kinds[name]), *parts]).astype(kinds[name]))
            for name, parts in out.items()
        })

    return run


def _best_of_block(k: int, same_label: bool, width: int):
    """The k best rows of a block in each window of each anchor of a slice."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = [[np.empty(0, np.int64)] for _ in range(4)]
        if rows.num_rows and anchors.num_rows:
            rows = rows.sort_by("vec_id")  # the first of equal scores is then the smallest id
            ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
            x, a = integers(rows["whole"], width), integers(anchors["whole"], width)
            exact = float(np.abs(x).max(initial=0)) * float(np.abs(a).max(initial=0)) * width < 2**53
            kind = np.float64 if exact else np.int64
            xt, a = x.T.astype(kind), a.astype(kind)
            anchor_ids, anchor_labels = anchors["vec_id"].to_numpy(), anchors["label"].to_numpy()
            floors = anchors["floors"].combine_chunks()
            n_windows = len(floors[0])
            floor, ceiling = integers(floors, n_windows), integers(anchors["ceilings"], n_windows)
            for at in range(0, len(a), _AT_ONCE):
                own = slice(at, at + _AT_ONCE)
                scores = (a[own] @ xt).astype(np.int64)
                same = labels[None, :] == anchor_labels[own][:, None]
                allowed = (same if same_label else ~same) & (ids[None, :] != anchor_ids[own][:, None])
                for w in range(n_windows):
                    fits = allowed & (scores >= floor[own, w][:, None]) & (scores <= ceiling[own, w][:, None])
                    left = np.where(fits, scores, -_ANYTHING)
                    who = np.flatnonzero(fits.any(axis=1))
                    left = left[who]
                    for _ in range(min(k, len(ids))):
                        if not len(who):
                            break
                        best = left.argmax(axis=1)
                        score = left[np.arange(len(who)), best]
                        more = score > -_ANYTHING
                        who, left, best, score = who[more], left[more], best[more], score[more]
                        left[np.arange(len(who)), best] = -_ANYTHING
                        for column, values in zip(found, (anchor_ids[own][who], np.full(len(who), w), ids[best], score)):
                            column.append(values)
        return pa.table({
            name: pa.array(np.concatenate(parts).astype(kind))
            for name, parts, kind in zip(
                ("anchor_id", "window", "vec_id", "score"), found, (np.int64, np.int32, np.int64, np.int64)
            )
        })

    return run


def _read_blocks(visits: DataFrame, anchors: DataFrame, library: Library, k: int, same_label: bool) -> DataFrame:
    """Score the anchors of `visits` (anchor_id, slice, shelf, block) against the rows of the blocks."""
    pairs = stored(visits.select("shelf", "block", "slice").distinct(), "negatives-pairs")
    # As many as the library has folders; the others are not even listed by the scan.
    shelves = [r["shelf"] for r in pairs.select("shelf").distinct().collect()]
    rows = library.rows.filter(F.col("shelf").isin(shelves)).join(pairs, ["shelf", "block"])
    asking = visits.join(anchors.drop("slice"), visits["anchor_id"] == anchors["vec_id"]).select(
        "block", "slice", "vec_id", "label", "whole", "floors", "ceilings"
    )
    left = rows.select("block", "slice", "vec_id", "label", "whole").groupBy("block", "slice")
    return left.cogroup(asking.groupBy("block", "slice")).applyInArrow(
        _best_of_block(k, same_label, library.width), "anchor_id long, window int, vec_id long, score long"
    )


def best_in_windows(anchors: DataFrame, library: Library, k: int, same_label: bool) -> DataFrame:
    """anchor_id, window, rank, vec_id, score: the `k` best rows in each window of each anchor.

    Anchors have vec_id, label, whole and, per window, least and greatest scores in `floors` and
    `ceilings`. Rows count that have the same label, or another one, and another vec_id.
    """
    n_slices = max(1, -(-anchors.count() // ANCHOR_ROWS))
    n_chunks = max(1, -(-library.n_zones // ZONE_ROWS))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    deal = lambda column, n: F.pmod(F.xxhash64(column), F.lit(n)).cast("int")
    sliced = stored(anchors.withColumn("slice", deal("vec_id", n_slices)), "negatives-anchors")
    asking = sliced.withColumn("chunk", each(n_chunks)).groupBy("slice", "chunk")
    described = library.zones.withColumn("chunk", deal("block", n_chunks)).withColumn("slice", each(n_slices))
    visits = stored(
        asking.cogroup(described.groupBy("slice", "chunk")).applyInArrow(
            _bounds(same_label, library.width), "anchor_id long, slice int, shelf int, block long, upper double"
        ).groupBy("anchor_id", "slice", "shelf", "block").agg(F.max("upper").alias("upper")),
        "negatives-visits",
    )
    nearest = Window.partitionBy("anchor_id").orderBy(F.desc("upper"), "block")
    probes = visits.withColumn("_n", F.row_number().over(nearest)).filter("_n = 1").drop("_n")
    probes = stored(probes, "negatives-probes")
    first = stored(_read_blocks(probes, sliced, library, k, same_label), "negatives-first")

    # A window that already has k rows needs no block that cannot reach the last of them.
    reached = first.groupBy("anchor_id", "window").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth")
    ).filter("kth IS NOT NULL")
    per_anchor = reached.groupBy(F.col("anchor_id").alias("_a")).agg(
        F.map_from_entries(F.collect_list(F.struct("window", "kth"))).alias("_kth")
    )
    raised = F.transform(
        "floors", lambda low, w: F.greatest(low, F.coalesce(F.try_element_at("_kth", w), low))
    )
    narrowed = stored(
        sliced.join(per_anchor, F.col("vec_id") == F.col("_a"), "left")
        .select("vec_id", "label", "whole", "slice", raised.alias("floors"), "ceilings"),
        "negatives-narrowed",
    )
    floors = narrowed.select(F.col("vec_id").alias("anchor_id"), F.array_min("floors").alias("_least"))
    rest = (
        visits.join(probes.select("anchor_id", "block"), ["anchor_id", "block"], "left_anti")
        .join(floors, "anchor_id")
        .filter(F.col("upper") + 1 + F.abs("upper") * _SLACK >= F.col("_least"))
        .select("anchor_id", "slice", "shelf", "block")
    )
    rest = stored(rest, "negatives-visits")
    everything = first.unionByName(_read_blocks(rest, narrowed, library, k, same_label))
    place = F.row_number().over(Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id"))
    return everything.withColumn("rank", place).filter(F.col("rank") <= k)


def _part(score: Column, percent: int, up: bool) -> Column:
    """score * percent / 100, rounded up or down in whole numbers."""
    x = score * F.lit(percent).cast("long") * (-1 if up else 1)
    rounded = F.call_function("div", x - F.pmod(x, F.lit(100).cast("long")), F.lit(100).cast("long"))
    return -rounded if up else rounded


def hard_negatives(
    rows: DataFrame,
    asked: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    from_percent: int = FROM_PERCENT,
    to_percent: int = TO_PERCENT,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `rows` are vec_id, label and whole (see `whole_vectors`); `asked` tells from vec_id which are
    anchors. An anchor's positives are its best rows of the same label; each sets a window between
    the two percentages of its score, in which the best rows of other labels are its negatives.
    Scores are inner products; ties go to the smaller vec_id. A window of a negative score is empty.

    Rows without vec_id or label take no part, nor do vectors of another length than that of the
    smallest id. A vec_id is one row, however often it is repeated: of different ones that with the
    smallest label, then vector, stands. Empty tables and missing positives give no rows. Other
    columns are not read.
    """
    usable = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL")
    kept = stored(
        usable.groupBy("vec_id").agg(F.min(F.struct("label", "whole")).alias("_r")).select("vec_id", "_r.*"),
        "negatives-rows",
    )
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    nothing = rows.sparkSession.createDataFrame([], schema)
    smallest = kept.orderBy("vec_id").select(F.size("whole").alias("width")).first()
    if smallest is None or smallest["width"] == 0:
        return nothing
    width = smallest["width"]
    own = one_length(kept.select("vec_id", F.col("label").cast("long").alias("label"), "whole"), width)
    library = build_library(own, width, block_rows)
    anchors = own.filter(asked)
    endless = lambda end: F.array(F.lit(end).cast("long"))
    near = best_in_windows(
        anchors.withColumns({"floors": endless(-_ANYTHING), "ceilings": endless(_ANYTHING)}),
        library, positives, True,
    )
    near = stored(near.select("anchor_id", "rank", "vec_id", "score"), "negatives-positives")
    # Windows go by the rank of their positive; those that do not exist stay empty.
    by_rank = F.map_from_entries(F.collect_list(F.struct("rank", "score")))
    windows = near.groupBy(F.col("anchor_id").alias("_a")).agg(by_rank.alias("_score"))
    ranks = F.array(*[F.lit(i + 1) for i in range(positives)])
    edge = lambda percent, up, missing: F.transform(
        ranks, lambda r: F.coalesce(_part(F.try_element_at("_score", r), percent, up), F.lit(missing).cast("long"))
    )
    windowed = anchors.join(windows, F.col("vec_id") == F.col("_a")).select(
        "vec_id", "label", "whole",
        edge(from_percent, True, _ANYTHING).alias("floors"), edge(to_percent, False, -_ANYTHING).alias("ceilings"),
    )
    far = best_in_windows(windowed, library, negatives, False)
    far = far.select("anchor_id", (F.col("window") + 1).alias("_rank"), "rank", "vec_id", "score")
    return near.alias("p").join(
        far.alias("n"), (F.col("p.anchor_id") == F.col("n.anchor_id")) & (F.col("p.rank") == F.col("n._rank"))
    ).select(
        "p.anchor_id", F.col("p.vec_id").alias("positive_id"), F.col("n.rank").cast("int").alias("rank"),
        F.col("n.vec_id").alias("negative_id"), F.col("p.score").alias("positive_score"),
        F.col("n.score").alias("negative_score"),
    )
