"""Packing tokenised documents into as few fixed-length sequences as possible.

How pieces pack depends on their lengths alone, and there are at most `capacity` different ones. So
the pieces are counted by length, and the driver packs the counts: at most `capacity` numbers go in,
and a list of patterns comes out, each a bin's lengths and how many bins look like it.

1. Martello-Toth reduction: while a set of lengths dominates every other bin that its longest piece
   could be in, bins of that set are fixed for good. That holds if the longest piece fits with no
   other; if it and the longest piece that fits beside it fill the bin; if at most one other piece
   fits, or two whose best pair is no longer than the one.
2. Best-fit-decreasing for what is left, again by counts: equal bins are filled together.

Then each piece finds its place: pieces of a length are numbered in hash order, and the patterns'
slots of that length are ranges of those numbers.
"""

from __future__ import annotations

import re
import sys
import types
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from aerolith.llm.common import running_total
from aerolith.session import stored

CAPACITY = 4096
END_ID = 1
_MEMO, _MEMO_BYTES = 250_000, 32_000_000  # of each of two generations
_CHUNKS = 100_000
_MARKER = "\x01"
_BETWEEN = b" \x01 "
_MAY_COMPOSE = re.compile(rb"[A-Z][\xCC-\xFF]")  # combining characters begin at U+0300
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

Pattern = tuple[int, tuple[tuple[int, int], ...]]  # bins, ((length, how often), ...)


# Tokens -----------------------------------------------------------------------------------------


class WordIds:
    """White-space separated chunk (UTF-8) to its ids as little-endian unsigned 32-bit numbers.

    The tokenizer drops white space and never joins what it separates, so a text's ids are its
    chunks' ids in order. It lower-cases, but only after composing characters, so A-Z may be
    lower-cased first unless a character follows that could join the letter. ASCII punctuation that
    ends a chunk after a letter a-z is tokens of its own. Added tokens are found before all that:
    chunks of a text that has one stay as they are, and are encoded whole; if such a token holds or
    takes in white space, the text is encoded whole. New chunks are encoded together, with a marker
    between them, which costs half as much as one by one. Chunks met before are remembered, up to a
    bound: of two generations the older one is dropped when the younger is full, and what is met
    again moves on to the younger one, so common chunks stay.
    """

    def __init__(self, tokenizer):
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.tokenizer, self.held = tokenizer, 0
        self.marker = np.frombuffer(self._encode(_MARKER), "<u4")[0]
        added = list(tokenizer.get_added_tokens_decoder().values())
        any_of = lambda tokens: re.compile(
            b"|".join(re.escape(t.content.encode().lower()) for t in tokens) or rb"(?!)"
        )
        self.added = any_of(added)
        self.spaced = any_of([t for t in added if t.lstrip or t.rstrip or t.content.split() != [t.content]])

    def text_ids(self, text: bytes) -> bytes:
        low, whole = text.lower(), False
        if self.spaced.search(low):
            return self._encode(text.decode())
        if self.added.search(low):
            chunks, whole = text.split(), True
        elif not _MAY_COMPOSE.search(text):
            chunks = low.split()
        else:
            chunks = [c if _MAY_COMPOSE.search(c) else c.lower() for c in text.split()]
        return b"".join(
            self._slice_ids(chunks[i : i + _CHUNKS], whole) for i in range(0, len(chunks), _CHUNKS)
        )

    def _slice_ids(self, chunks: list[bytes], whole: bool) -> bytes:
        if len(self.young) > _MEMO or self.held > _MEMO_BYTES:
            self.old, self.young, self.held = self.young, {}, 0
        # A set's difference with a dictionary looks its own few members up, the other set
        # operations would go through the dictionary.
        missing = set(chunks).difference(self.young)
        if missing:
            fresh = missing.difference(self.old)
            self.young.update([(chunk, self.old[chunk]) for chunk in missing - fresh])
            self._learn(fresh, whole)
        return b"".join(map(self.young.__getitem__, chunks))

    def _learn(self, chunks: set[bytes], whole: bool) -> None:
        """`whole`: chunks may hold an added token, so that nothing may be cut off."""
        ended = []
        if not whole:
            bares = [(chunk, chunk.rstrip(_PUNCTUATION)) for chunk in chunks]
            ended = [(c, bare, c[len(bare) :]) for c, bare in bares if len(bare) < len(c) and bare[-1:].isalpha()]
        if ended:
            chunks = chunks.difference([c for c, _, _ in ended])
            chunks.update([bare for _, bare, _ in ended], [tail for _, _, tail in ended])
            chunks = chunks.difference(self.young)
        fresh = list(chunks)
        if fresh:
            ids = self._encode_all(fresh)
            self.young.update(zip(fresh, ids))
            self.held += sum(map(len, fresh)) + sum(map(len, ids))
        self.young.update((chunk, self.young[bare] + self.young[tail]) for chunk, bare, tail in ended)

    def _encode_all(self, chunks: list[bytes]) -> list[bytes]:
        together = self._encode(_BETWEEN.join(chunks).decode())
        # The marker is one id, and no other text has that id, unless the character is in a chunk.
        ends = (4 * np.flatnonzero(np.frombuffer(together, "<u4") == self.marker)).tolist()
        if len(ends) != len(chunks) - 1:
            return [self._encode(c.decode()) for c in chunks]
        starts = [0, *[end + 4 for end in ends]]
        return [together[a:b] for a, b in zip(starts, [*ends, len(together)])]

    def _encode(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found[0].ids, "<u4").tobytes()


def worker_words(tokenizer_path: str) -> WordIds:
    """The tokenizer and its memo, one for all tasks that a Python worker runs.

    Functions of this package reach a worker by value, so their globals are new with each task; a
    module of the worker's own outlasts them.
    """
    held = sys.modules.setdefault("_word_ids", types.ModuleType("_word_ids")).__dict__
    if tokenizer_path not in held:
        from tokenizers import Tokenizer

        held[tokenizer_path] = WordIds(Tokenizer.from_file(tokenizer_path))
    return held[tokenizer_path]


def tokenised(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    A document is its ids and one end id; longer ones are cut every `capacity` tokens. Null and empty
    texts are the end id alone. The tokenizer's file must be at that path on every executor.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = worker_words(tokenizer_path), np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            ids, texts = batch.columns
            of, rows, held = [], [], []
            for i, text in enumerate(texts):
                data = memoryview(words.text_ids(text.as_py() or b"") + end)
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    of.append(i)
                    rows.append((piece, at // 4, len(part) // 4, zlib.crc32(part)))
                    if with_ids:
                        held.append(np.frombuffer(part, "<u4").astype(np.int64))
            columns = np.array(rows, np.int64).reshape(-1, 4).T
            out = [ids.take(pa.array(of, pa.int64())), pa.array(columns[0].astype(np.int32))]
            out += [pa.array(np.ascontiguousarray(c)) for c in columns[1:]]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                out.append(pa.array(held, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<long>" if with_ids else ""
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(cut, schema)


# Plan -------------------------------------------------------------------------------------------


class _Lengths:
    """Counts of the lengths still unpacked."""

    def __init__(self, counts: dict[int, int]):
        self.count = {length: n for length, n in counts.items() if n > 0}
        self.sorted = sorted(self.count)

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if not self.count[length]:
            del self.count[length]
            self.sorted.pop(bisect_left(self.sorted, length))

    def longest_up_to(self, room: int, but: int) -> int | None:
        """Longest length within `room`, one piece of length `but` being set aside."""
        at = bisect_left(self.sorted, room + 1) - 1
        if at >= 0 and self.sorted[at] == but and self.count[but] == 1:
            at -= 1
        return self.sorted[at] if at >= 0 else None

    def shortest(self, n: int, but: int) -> list[int]:
        """The `n` shortest pieces' lengths, one piece of length `but` being set aside."""
        found: list[int] = []
        for length in self.sorted:
            found += [length] * min(n - len(found), self.count[length] - (length == but))
            if len(found) == n:
                break
        return found

    def best_pair(self, room: int, but: int) -> int:
        """Greatest sum of two pieces within `room`, one piece of length `but` being set aside."""
        best, low, high = 0, 0, len(self.sorted) - 1
        while low <= high:
            a, b = self.sorted[low], self.sorted[high]
            free = lambda x: self.count[x] - (x == but)
            usable = free(a) >= 1 + (a == b) and free(b) >= 1
            if a + b > room:
                high -= 1
            else:
                if usable:
                    best = max(best, a + b)
                # A lone piece set aside must not hide the pairs around it.
                low, high = (low, high - 1) if not free(b) else (low + 1, high)
        return best


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Bins that some optimal packing has, and the counts of what they leave."""
    left, fixed = _Lengths(counts), []
    for j in sorted(left.count, reverse=True):
        while left.count.get(j):
            few = left.shortest(3, but=j)
            room = capacity - j
            if not few or few[0] > room:
                fixed.append((left.count[j], ((j, 1),)))
                left.take(j, left.count[j])
                continue
            k = left.longest_up_to(room, but=j)
            dominates = (
                k == room
                or len(few) < 2
                or few[0] + few[1] > room
                or ((len(few) < 3 or sum(few) > room) and k >= left.best_pair(room, but=j))
            )
            if not dominates:
                break
            if k == j:
                bins = left.count[j] // 2
                fixed.append((bins, ((j, 2),)))
                left.take(j, 2 * bins)
            else:
                # Taking pieces away only lengthens the shortest and shrinks the pairs: the set
                # dominates as long as there are pieces for it.
                bins = min(left.count[j], left.count[k])
                fixed.append((bins, ((j, 1), (k, 1))))
                left.take(j, bins)
                left.take(k, bins)
    return fixed, left.count


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit-decreasing: each piece, longest first, goes to the fullest bin that has room."""
    rooms: list[int] = []
    groups: dict[int, list[Pattern]] = {}

    def put(room: int, group: Pattern) -> None:
        if room not in groups:
            insort(rooms, room)
            groups[room] = []
        groups[room].append(group)

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                bins, inside = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    rooms.pop(at)
            else:
                room, bins, inside = capacity, n, ()
            each = room // length
            full, rest = min(bins, n // each), 0
            if full < bins:
                rest = n - full * each
            if full:
                put(room - each * length, (full, (*inside, (length, each))))
            if rest:
                put(room - rest * length, (1, (*inside, (length, rest))))
            # Bins not reached stay as they were; a new bin that gets nothing is not a bin.
            unused = bins - full - (rest > 0)
            if unused and inside:
                put(room, (unused, inside))
            n -= full * each + rest
    return [group for room in rooms for group in groups[room]]


def pack_counts(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    fixed, left = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(left, capacity)


# Places -----------------------------------------------------------------------------------------


def _slots(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """Length to rows (first number, first sequence, times per bin, offset), by first number."""
    upto: dict[int, int] = {}
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for bins, inside in patterns:
        offset = 0
        for length, times in inside:
            slots.setdefault(length, []).append((upto.get(length, 0), sequence, times, offset))
            upto[length] = upto.get(length, 0) + bins * times
            offset += length * times
        sequence += bins
    return {length: np.array(rows, np.int64) for length, rows in slots.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to stored pieces with doc_id, piece, start, length, ids_crc32.

    Equal pieces may take each other's places. The patterns go to the tasks as a broadcast. Using up
    a length leaves at most two groups of equal bins more, so there are under three groups for each
    of at most `capacity` lengths; a bin of 4096 holds at most 90 different lengths. Their size is
    bounded by the capacity (about 35 MB), whatever the number of documents.
    """
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    slots = pieces.sparkSession.sparkContext.broadcast(_slots(pack_counts(counts, capacity)))
    order = ["_key", "doc_id", "piece", "ids_crc32"]
    keyed = pieces.withColumn("_key", F.xxhash64("doc_id", "piece", "ids_crc32")).withColumn(
        "_bucket", F.pmod("_key", F.lit(4096)).cast("int")
    )
    numbered = running_total(keyed, "length", "_bucket", order, F.lit(1), "_number").drop("_key", "_bucket")

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, numbers = batch.column("length").to_numpy(), batch.column("_number").to_numpy()
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                of = slots.value[int(length)]
                first, base, times, start = of[np.searchsorted(of[:, 0], numbers[rows], "right") - 1].T
                inside = numbers[rows] - first
                sequence[rows] = base + inside // times
                offset[rows] = start + inside % times * length
            yield (
                batch.drop_columns(["_number"])
                .append_column("sequence_id", pa.array(sequence))
                .append_column("offset", pa.array(offset))
            )

    return numbered.mapInArrow(place, f"{_ddl(pieces)}, sequence_id long, offset long")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """One row per piece of every row of `docs`: where it came from and where it goes.

    Repeated rows are packed as often as they occur; an empty table gives an empty result; columns
    other than doc_id and text are not read. `with_ids` adds the pieces' ids.
    """
    pieces = stored(tokenised(docs, tokenizer_path, capacity, with_ids), "packing-pieces")
    return pack(pieces, capacity)
