"""Vectors as short codes: each of their parts becomes the index of its nearest codebook entry.

Codebooks are fitted in whole numbers by a few rounds of assignment and averaging, over all rows.
Assignment keeps adaptive bounds in the manner of Drake and Hamerly: with each part go its `b`
nearest entries besides the assigned one, ordered lower bounds of their distances, and one outer
bound for all the rest. A round moves the entries; bounds loosen by how far. Where the lower bounds
stay above the upper bound of the assigned entry, nothing is worked out. Other parts are verified in
whole numbers, against the first listed entries only, or against all if the outer bound gives way.
`b` adapts: a batch of rows keeps as many bounds as its parts needed in the round.

The bounds are stored between rounds, as whole eighths, rounded to the safe side. Rows are not
shuffled; each task sends one line per used entry, so the driver sees parts x entries lines.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from aerolith.llm.vectors import integers, lists, one_length, whole_vectors
from aerolith.session import stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
LISTED = 8  # entries with a bound of their own, at first
LEAST_LISTED = 2
_FINE = 8  # bounds count in eighths
_FAR = 2**30
_ENOUGH = 0.95  # share of a batch's parts that an adapted b has to serve


def seeds(rows: DataFrame, entries: int) -> np.ndarray:
    """The vectors of the `entries` smallest ids; of several vectors of one id the smallest.

    Ids are few per look, so repeated ones are skipped by asking again beyond the last.
    """
    found: dict[int, list[int]] = {}
    rest = rows.filter("vec_id IS NOT NULL")
    while len(found) < entries:
        some = rest.orderBy("vec_id", "whole").limit(entries).collect()
        for row in some:
            if len(found) < entries:
                found.setdefault(row["vec_id"], row["whole"])
        if len(some) < entries:
            break
        rest = rows.filter(F.col("vec_id") > max(found))
    if not found:
        return np.empty((0, 0), np.int64)
    width = len(found[min(found)])
    return np.array([v for _, v in sorted(found.items()) if len(v) == width], np.int64)


def cut(x: np.ndarray, parts: int) -> np.ndarray:
    """(rows, parts, components); zeros fill up the last part, which changes no distance."""
    width = max(1, -(-x.shape[1] // parts))
    whole = np.zeros((len(x), parts * width), np.int64)
    whole[:, : x.shape[1]] = x
    return whole.reshape(len(x), parts, width)


def squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of points to entries. Doubles hold them while a part is short."""
    kind = np.float64 if x.shape[1] <= 64 else np.int64
    a, b = x.astype(kind), entries.astype(kind)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)


def below(square: np.ndarray) -> np.ndarray:
    return np.floor(_FINE * np.sqrt(square)).astype(np.int64) - 1


def above(square: np.ndarray) -> np.ndarray:
    return np.ceil(_FINE * np.sqrt(square)).astype(np.int64) + 1


class Assigned:
    """Codes of (rows, parts) with their bounds. `lower[..., j]` holds for listed entry j and all
    entries after it; the last one for the entries that are not listed."""

    def __init__(self, code, upper, near, lower):
        self.code, self.upper, self.near, self.lower = code, upper, near, lower

    @staticmethod
    def empty(rows: int, parts: int, listed: int) -> Assigned:
        return Assigned(
            np.zeros((rows, parts), np.int64), np.zeros((rows, parts), np.int64),
            np.zeros((rows, parts, listed), np.int64), np.full((rows, parts, listed + 1), _FAR),
        )

    def look_everywhere(self, rows: np.ndarray, part: int, x: np.ndarray, entries: np.ndarray) -> None:
        """Assign these rows' part anew. Ties go to the lower index."""
        if not len(rows):
            return
        k, listed = len(entries), self.near.shape[2]
        keys = squares(x[rows, part], entries) * k + np.arange(k)
        if k > listed + 2:
            keys = np.partition(keys, listed + 1, axis=1)[:, : listed + 2]
        keys.sort(axis=1)
        nearest, square = keys % k, keys // k
        self.code[rows, part] = nearest[:, 0]
        self.upper[rows, part] = above(square[:, 0])
        self.near[rows, part] = nearest[:, 1 : listed + 1]
        self.lower[rows, part] = _FAR
        self.lower[rows, part, : square.shape[1] - 1] = below(square[:, 1:])

    def moved(self, drift: np.ndarray) -> None:
        """Loosen the bounds after each entry of each part moved by at most `drift`."""
        part = np.arange(drift.shape[0])
        self.upper += drift[part[None, :], self.code]
        self.lower[..., :-1] -= drift[part[None, :, None], self.near]
        self.lower[..., -1] -= drift.max(axis=1)
        self.order()

    def order(self) -> None:
        self.lower = np.minimum.accumulate(self.lower[..., ::-1], axis=-1)[..., ::-1]

    def needed(self) -> np.ndarray:
        """How many bounds, from the first on, do not clear the assigned entry."""
        return (self.lower <= self.upper[..., None]).sum(axis=-1)

    def verify(self, x: np.ndarray, books: np.ndarray) -> np.ndarray:
        """Make the codes right for `books` in whole numbers; returns how many bounds each needed."""
        listed = self.near.shape[2]
        rows, parts = np.nonzero(self.needed())
        own = x[rows, parts] - books[parts, self.code[rows, parts]]
        self.upper[rows, parts] = above((own * own).sum(1))
        need = self.needed()
        for part in range(books.shape[0]):
            self.look_everywhere(np.flatnonzero(need[:, part] > listed), part, x, books[part])
            some = np.flatnonzero((need[:, part] > 0) & (need[:, part] <= listed))
            if len(some):
                self._look_at_listed(some, part, need[some, part], x, books[part])
        return need

    def _look_at_listed(self, rows, part, need, x, entries) -> None:
        k, listed = len(entries), self.near.shape[2]
        choices = np.concatenate([self.code[rows, part][:, None], self.near[rows, part]], axis=1)
        away = x[rows, part][:, None, :] - entries[choices]
        square = (away * away).sum(-1)
        beyond = np.arange(listed + 1)[None, :] > need[:, None]
        # Entries beyond those in doubt keep their bounds; all others have exact distances now.
        bound = np.where(beyond, np.concatenate(
            [np.zeros((len(rows), 1), np.int64), self.lower[rows, part, :-1]], axis=1), below(square))
        best = np.where(beyond, np.iinfo(np.int64).max, square * k + choices).argmin(axis=1)
        at = np.arange(len(rows))
        self.code[rows, part] = choices[at, best]
        self.upper[rows, part] = above(square[at, best])
        rest = np.ones_like(beyond)
        rest[at, best] = False
        others, bounds = choices[rest].reshape(-1, listed), bound[rest].reshape(-1, listed)
        by_bound = np.argsort(bounds, axis=1, kind="stable")
        self.near[rows, part] = np.take_along_axis(others, by_bound, 1)
        inner = np.take_along_axis(bounds, by_bound, 1)
        together = np.concatenate([inner, self.lower[rows, part, -1:]], axis=1)
        self.lower[rows, part] = np.minimum.accumulate(together[:, ::-1], axis=1)[:, ::-1]

    def adapted(self, need: np.ndarray, least: int) -> Assigned:
        """With only as many listed entries as nearly all of the parts needed."""
        listed = self.near.shape[2]
        if not need.size:
            return self
        wanted = int(np.quantile(need, _ENOUGH, method="higher"))
        keep = min(listed, max(least, wanted))
        return Assigned(self.code, self.upper, self.near[..., :keep], self.lower[..., : keep + 1])

    def columns(self) -> list[pa.Array]:
        return [lists(m, pa.int32()) for m in (self.code, self.upper, self.near, self.lower)]

    @staticmethod
    def of(batch: pa.RecordBatch, parts: int, listed: int) -> Assigned:
        read = lambda name, width: integers(batch.column(name), parts * width)
        rows = batch.num_rows
        return Assigned(
            read("code", 1), read("upper", 1), read("near", listed).reshape(rows, parts, listed),
            read("lower", listed + 1).reshape(rows, parts, listed + 1),
        )


_STATE = ["code", "upper", "near", "lower"]


def _same_lists(batches: Iterable[pa.RecordBatch], parts: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches of rows that keep equally many bounds, with that number."""
    for batch in batches:
        listed = pc.list_value_length(batch.column("near")).to_numpy(zero_copy_only=False) // parts
        for b in np.unique(listed):
            yield int(b), batch.filter(pa.array(listed == b))


def _sums(parts: int, k: int):
    """Per used entry: how many parts it has, and their component sums, over a whole task."""

    def run(batches):
        counts, sums = np.zeros(parts * k, np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            slot = integers(batch.column("code"), parts) + np.arange(parts) * k
            x = cut(integers(batch.column("whole"), len(batch.column("whole")[0])), parts)
            sums = np.zeros((parts * k, x.shape[2]), np.int64) if sums is None else sums
            counts += np.bincount(slot.ravel(), minlength=parts * k)
            for j in range(x.shape[2]):
                sums[:, j] += np.bincount(slot.ravel(), x[..., j].ravel(), parts * k).astype(np.int64)
        used = np.flatnonzero(counts)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array(counts[used]), lists(sums[used], pa.int64())],
                names=["slot", "n", "sums"],
            )

    return run


def averaged(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry replaced by its parts' componentwise floor(sum / count); unused ones stay."""
    parts, k, width = books.shape
    told = state.select("whole", "code").mapInArrow(_sums(parts, k), "slot int, n long, sums array<long>")
    totals = told.groupBy("slot").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(j))) for j in range(width)]).alias("sums")
    )
    new = books.copy()
    for row in totals.collect():  # at most parts x entries lines
        new[row["slot"] // k, row["slot"] % k] = [s // row["n"] for s in row["sums"]]
    return new


def codebooks_text(books: np.ndarray, dims: int) -> str:
    """All entries' components in order, without the zeros that fill up the last part."""
    parts, _, width = books.shape
    shown = [
        entry[: max(0, min(width, dims - part * width))] for part in range(parts) for entry in books[part]
    ]
    return ",".join(str(v) for entry in shown for v in entry)


def compress(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    listed: int = LISTED,
) -> DataFrame:
    """vec_id, label, code (indexes in part order, two hex digits each), error (squared distances
    summed over parts), label_error (error summed over equal labels, nulls together) and
    codebooks_sha256, one row for each usable row of `vectors` (vec_id, embedding, label).

    Which vectors are unusable `whole_vectors` says; those of another length than that of the
    smallest id are left out as well. Repeated rows are each coded and each count in the averages;
    rows without an id are coded, too, but never begin a codebook. With no id at all codes and
    errors are null. A length that the number of parts does not divide is filled up with zeros.
    At most 256 entries. Other columns are not read.
    """
    rows = stored(whole_vectors(vectors, "label"), "codes-vectors")
    first = seeds(rows, entries)
    if not len(first):
        nothing = [F.lit(None).cast(t).alias(n) for n, t in (("code", "string"), ("error", "long"), ("label_error", "long"))]
        return rows.select("vec_id", "label", *nothing, F.lit(hashlib.sha256().hexdigest()).alias("codebooks_sha256"))
    dims = first.shape[1]
    books = np.ascontiguousarray(cut(first, parts).transpose(1, 0, 2))
    k = books.shape[1]
    start = min(listed, k - 1)
    label = rows.schema["label"].dataType.simpleString()
    kept = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, label {label}, whole array<int>"
    names = ["vec_id", "label", "whole"]

    def begin(batches):
        for batch in batches:
            x = cut(integers(batch.column("whole"), dims), parts)
            found = Assigned.empty(len(x), parts, start)
            for part in range(parts):
                found.look_everywhere(np.arange(len(x)), part, x, books[part])
            yield pa.RecordBatch.from_arrays([*batch.columns, *found.columns()], names=names + _STATE)

    def going_on(new: np.ndarray, old: np.ndarray):
        drift = above(((new - old) ** 2).sum(-1)) * (new != old).any(-1)

        def run(batches):
            for b, batch in _same_lists(batches, parts):
                x, found = cut(integers(batch.column("whole"), dims), parts), Assigned.of(batch, parts, b)
                found.moved(drift)
                found = found.adapted(found.verify(x, new), LEAST_LISTED)
                own = [batch.column(n) for n in names]
                yield pa.RecordBatch.from_arrays([*own, *found.columns()], names=names + _STATE)

        return run

    def finish(batches):
        for batch in batches:
            x, code = cut(integers(batch.column("whole"), dims), parts), integers(batch.column("code"), parts)
            away = x - books[np.arange(parts)[None, :], code]
            texts = [row.tobytes().hex() for row in code.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(texts, pa.string()),
                 pa.array((away * away).sum((1, 2)))],
                names=["vec_id", "label", "code", "error"],
            )

    bounds = ", ".join(f"{name} array<int>" for name in _STATE)
    own = one_length(rows, dims)
    state = stored(own.mapInArrow(begin, f"{kept}, {bounds}"), "codes-state")
    for _ in range(rounds):
        new = averaged(state, books)
        state = stored(state.mapInArrow(going_on(new, books), f"{kept}, {bounds}"), "codes-state")
        books = new
    coded = state.select("vec_id", "label", "whole", "code").mapInArrow(
        finish, kept.replace("whole array<int>", "code string, error long")
    )
    coded = stored(coded, "codes-result")
    # Totals first: a label that holds much of the table meets one line, not its other rows.
    totals = stored(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "codes-labels")
    digest = hashlib.sha256(codebooks_text(books, dims).encode()).hexdigest()
    return coded.join(totals, coded["label"].eqNullSafe(totals["_label"])).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
