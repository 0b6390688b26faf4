"""Mixing sources to target weights by weighted fair queueing.

Documents of a source queue in an order shuffled by hash, `REPEATS` times over, as a source may be
repeated. A copy's virtual finish time is the source's words up to and with it, divided by the
source's weight. All copies are ordered by it, in ranges; running totals along that order tell how
many words fair queueing has served by each copy's finish, and the first copy by whose finish the
total budget is used up is where the mix is truncated. Copies before it are whole, those after it
that are already in service at that moment are cut there, so that small sources with long documents
meet their targets, too; the rest get nothing. A source that runs dry leaves its share to the others.

Words, the budget and the order depend on rows alone, not on partitions, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from aerolith.llm.common import WORD, running, running_total
from aerolith.session import stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
SEED = "mix"
_RANGES = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(doc_id: Column, text: Column, seed: str) -> Column:
    """Where a document stands in the shuffle; ids that are null or repeated still spread by text."""
    identity = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(seed), identity, F.md5(F.coalesce(text, F.lit("")))))


def source_targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
) -> DataFrame:
    """From (source, size) rows: one row per source with place, weight, source_size and target.

    Sources are ranked by code point, null last, and take the weights in turn. They share
    `share` of all words; a target stops at `repeats` times its source, and what is over goes to the
    others by weight. Without words all targets are 0. There is a row for each source here, not for
    each document; those rows pass through one task.
    """
    totals = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    ranked = totals.withColumn(
        "place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("int")
    )
    turn = F.array(*[F.lit(float(w)) for w in weights])
    weighed = ranked.withColumn("weight", F.get(turn, F.pmod(F.col("place") - 1, F.lit(len(weights)))))
    # Sources by the virtual time at which they run dry: up to some place they do, and the rest
    # share what is left. The first place where the shared level stays below is the answer.
    dry = F.col("source_size") * repeats / F.col("weight")
    order = Window.orderBy("dry", "place")
    upto, after = (Window.unboundedPreceding, -1), (Window.currentRow, Window.unboundedFollowing)
    everything = F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    used = F.coalesce(F.sum(F.col("source_size") * repeats).over(order.rowsBetween(*upto)), F.lit(0))
    shared = F.sum("weight").over(order.rowsBetween(*after))
    levels = weighed.withColumn("dry", dry).withColumn("level", (everything * F.lit(float(share)) - used) / shared)
    fits = F.when(F.col("level") <= F.col("dry"), F.col("level"))
    level = F.first(fits, ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    cap = (F.col("source_size") * repeats).cast("double")
    target = F.coalesce(F.least(cap, F.col("weight") * F.col("_level")), cap)
    return levels.withColumn("_level", level).select(
        "source", "place", "weight", "source_size", target.alias("target")
    )


def queue(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """Per row of `docs`: doc_id, size, its source's figures, `key` (its place in the shuffle) and
    `served`, an array with one entry per copy that gets words: copy, taken, virtual_finish.

    Null texts have no words and are never taken. A null source is a source. Repeated rows queue
    each for themselves; an empty table gives an empty result.
    """
    rows = stored(
        docs.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            shuffle_key(F.col("doc_id"), F.col("text"), seed).alias("key"),
        ),
        "mix-rows",
    )
    targets = stored(source_targets(rows, weights, share, repeats), "mix-targets")
    joined = rows.join(targets, rows["source"].eqNullSafe(targets["source"])).select(
        "doc_id", rows["source"], "size", "key", "place", "weight", "source_size", "target",
        F.conv(F.substring("key", 1, 3), 16, 10).cast("int").alias("bucket"),
    )
    order = ["key", "doc_id", "size"]
    placed = running_total(joined, "place", "bucket", order, F.col("size"), "before")

    placed = stored(placed, "mix-placed")
    level = truncation(placed, targets, share, repeats)
    # What a source has been served when the mix ends; without a cut, all its copies.
    end = F.round(F.least(F.col("weight") * F.lit(level), (F.col("source_size") * repeats).cast("double"))).cast("long")

    def copy(n: Column) -> Column:
        start, finish = _service(n)
        return F.struct(
            n.alias("copy"), F.least(F.col("size"), end - start).alias("taken"), finish.alias("virtual_finish")
        )

    copies = F.transform(F.sequence(F.lit(0), F.lit(repeats - 1)), copy)
    served = F.filter(copies, lambda c: c["taken"] > 0)
    return placed.select(
        "doc_id", "source", "key", "size", "source_size", "target", served.alias("served")
    )


def _service(copy: Column) -> tuple[Column, Column]:
    """Words that the source has served before this copy, and the copy's virtual finish time."""
    start = copy * F.col("source_size") + F.col("before")
    return start, (start + F.col("size")) / F.col("weight")


def truncation(placed: DataFrame, targets: DataFrame, share: float, repeats: int) -> float:
    """The virtual time at which the budget is used up; infinite if all copies fit in.

    By a copy's finish time f, sources that have finished their last copy before have served all
    their words, the others f times their weight. Both totals run along the copies by virtual
    finish: over ranges first, then inside each, so no task holds more than a range.
    """
    with_words = targets.filter("source_size > 0")
    whole = with_words.agg(
        F.sum("weight").alias("weight"), F.sum("source_size").alias("words"),
        F.max(F.col("source_size") * repeats / F.col("weight")).alias("last"),
    ).first()  # one line
    if not whole["words"]:
        return float("inf")
    start, finish = _service(F.col("copy"))
    last = start + F.col("size") == F.col("source_size") * repeats
    copies = (
        placed.filter("size > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
        .select(
            F.lit(0).alias("all"), "place", "copy", finish.alias("finish"),
            F.when(last, F.col("source_size") * repeats).otherwise(0).alias("dry"),
            F.when(last, F.col("weight")).otherwise(0.0).alias("dry_weight"),
        )
        .withColumn("range", F.floor(F.col("finish") / F.lit(whole["last"]) * _RANGES).cast("int"))
    )
    add = lambda a, b: a + b
    along = running(
        stored(copies, "mix-copies"), "all", "range", ["finish", "place", "copy"],
        {"done": (F.sum, add, F.col("dry")), "idle": (F.sum, add, F.col("dry_weight"))},
    )
    budget, busy = F.lit(whole["words"] * float(share)), F.lit(whole["weight"]) - F.col("idle")
    used_up = F.col("done") + busy * F.col("finish") >= budget
    level = F.min(F.when(used_up, F.struct("finish", "place", "copy", ((budget - F.col("done")) / busy).alias("level"))))
    found = along.agg(level.alias("at")).first()["at"]  # one line
    return found["level"] if found else float("inf")


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: a row per copy served, range-sorted by virtual finish time."""
    copies = queue(docs, **settings).select("doc_id", "source", "key", "size", "target", F.inline("served"))
    return copies.orderBy("virtual_finish", "key", "doc_id", "copy")


def mix_report(docs: DataFrame, **settings) -> DataFrame:
    """Per row of `docs`: doc_id, size, source_size, target, taken (words over all its copies)."""
    taken = F.aggregate(F.col("served"), F.lit(0).cast("long"), lambda sum_, c: sum_ + c["taken"])
    first = F.get("served", F.lit(0))["virtual_finish"]
    return (
        queue(docs, **settings)
        .select("doc_id", "size", "source_size", "target", taken.alias("taken"), first.alias("virtual_finish"))
        .orderBy(F.col("virtual_finish").asc_nulls_last(), "doc_id")
    )


def repeat_documents(docs: DataFrame, **settings) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it; the columns stay.

    Texts stay whole: a copy that the end of the budget cuts counts if half of it or more is served.
    Rows equal in id, source and text get the same number of copies, their mean.
    """
    whole = F.size(F.filter(F.col("served"), lambda c: 2 * c["taken"] >= F.col("size")))
    counts = stored(
        queue(docs, **settings)
        .groupBy(F.col("key").alias("_key"), F.col("source").alias("_source"))
        .agg(F.round(F.avg(whole)).cast("int").alias("_copies"))
        .filter("_copies > 0"),
        "mix-copies",
    )
    rows = docs.select(F.struct("*").alias("_row"))
    key = shuffle_key(F.col("_row.doc_id"), F.col("_row.text"), settings.get("seed", SEED))
    hit = (key == F.col("_key")) & F.col("_row.source").eqNullSafe(F.col("_source"))
    repeated = rows.join(counts.hint("shuffle_hash"), hit)
    return repeated.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")
