"""Quality rules whose cutoffs come with a guarantee.

Each rule rejects documents whose figure lies above a cutoff. Labelled documents, held out from
everything else, decide how strict a cutoff may be: per stratum (language), a cutoff is usable if
the exact binomial test rules out, at the corrected level, that it rejects more than the allowed
share of good documents. That is the same as the upper Clopper-Pearson bound of its false
rejections being below that share.

* The allowed share `FALSE_REJECTIONS` of a stratum is divided among the rules.
* The error `LEVEL` is divided among strata and rules. Cutoffs of one rule are tested from the
  loosest on: false rejections only grow, so the usable ones are a beginning of that sequence and
  need no further correction.
* Of the usable cutoffs the one that tells bad from good best is taken, the loosest if tied.
  Where none is usable (too few labels), the rule is off.

All of it is DataFrame functions; texts are not shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from aerolith.llm.common import WHITE, let
from aerolith.session import stored

FALSE_REJECTIONS = 0.05
LEVEL = 0.05
_PLACE_BITS = 24
_PLACES = 2**_PLACE_BITS - 1
GOOD_OVER_BAD = 50.0  # how much worse it is to reject a good share than to keep a bad one


def _rules() -> dict[str, tuple[Column, list[float]]]:
    """Rule: its figure, and its cutoffs from the loosest to the strictest."""
    share = lambda part, whole: F.coalesce(F.col(part) / F.nullif(F.col(whole), F.lit(0)), F.lit(0.0))
    return {
        "symbols": (share("n_symbols", "n_words"), [1.0, 0.7, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05]),
        "capitals": (share("n_capitals", "n_words"), [0.9, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1]),
        "repeats": (share("n_repeat_words", "n_words"), [0.48, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15]),
        "duplicate_lines": (share("n_dup_lines", "n_lines"), [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3]),
        "word_length": (share("word_chars", "n_words"), [40.0, 30.0, 20.0, 15.0, 12.0, 10.0]),
    }


# Figures ----------------------------------------------------------------------------------------


def text_figures(text: Column) -> dict[str, Column]:
    """Column name to expression, each reading the whole text; null counts as empty.

    Words are runs of characters other than ASCII white space.
    """
    whole = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(whole, f"[{WHITE}]+"), "")
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(f"[^{WHITE}]"))
    of_words = let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
        ),
    )
    of_lines = let(
        lines,
        lambda all_lines: F.struct(
            F.size(all_lines).cast("long").alias("n_lines"),
            (F.size(all_lines) - F.size(F.array_distinct(all_lines))).cast("long").alias("n_dup_lines"),
        ),
    )
    return {
        "of_words": of_words,
        "of_lines": of_lines,
        "n_symbols": F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("long"),
        "n_capitals": F.regexp_count(whole, F.lit(r"\p{Lu}{2,}")).cast("long"),
    }


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more, each counted once.

    Windows are compared by a 64-bit hash within one text. Only texts that repeat a window sort
    their windows to find out where.
    """
    windows = F.slice(
        F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
        F.lit(1),
        F.greatest(F.size(words) - 2, F.lit(0)),
    )

    def covered(starts: Column) -> Column:
        step = F.transform(
            starts, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(starts, j + 1) - p, F.lit(3)))
        )
        return F.aggregate(step, F.lit(0), lambda total, one: total + one)

    def repeated(by_hash: Column) -> Column:
        found = F.filter(
            by_hash,
            lambda x, j: F.coalesce(x["h"] == F.get(by_hash, j - 1)["h"], F.lit(False))
            | F.coalesce(x["h"] == F.get(by_hash, j + 1)["h"], F.lit(False)),
        )
        return let(F.sort_array(F.transform(found, lambda x: x["p"])), covered)

    def placed(hashes: Column, positions: Column) -> Column:
        pair = lambda p: F.struct(F.get(hashes, p).alias("h"), p.alias("p"))
        return let(F.sort_array(F.transform(positions, pair)), repeated)

    def suspects(packed: Column) -> Column:
        near = lambda x, j: F.shiftright(x, _PLACE_BITS) == F.shiftright(F.get(packed, j), _PLACE_BITS)
        found = F.filter(
            packed,
            lambda x, j: F.coalesce(near(x, j - 1), F.lit(False)) | F.coalesce(near(x, j + 1), F.lit(False)),
        )
        return F.transform(found, lambda x: x.bitwiseAND(_PLACES).cast("int"))

    def count(hashes: Column) -> Column:
        # Plain numbers sort fast: the upper bits of the hash with the place below them single out
        # the few windows whose whole hashes are worth comparing.
        packed = F.transform(hashes, lambda h, i: h.bitwiseAND(~_PLACES).bitwiseOR(i.cast("long")))
        few = let(F.sort_array(packed), suspects)
        every = F.sequence(F.lit(0), F.size(hashes) - 1)
        worth = F.when(F.size(hashes) <= _PLACES, few).otherwise(every)
        distinct = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(distinct, F.lit(0)).otherwise(let(worth, lambda p: placed(hashes, p)))

    return let(windows, count)


def stratum_of(lang: Column) -> Column:
    """A key per language: `=` and its name, and the empty text for null."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit(""))


def document_figures(docs: DataFrame, *keep: Column) -> DataFrame:
    """`keep` (doc_id if none), stratum and the figures of every document, one row for each row of
    `docs`."""
    found = text_figures(F.col("text"))
    kept = keep or (F.col("doc_id"),)
    raw = docs.select(
        *kept,
        stratum_of(F.col("lang")).alias("stratum"),
        *[expression.alias(name) for name, expression in found.items()],
    )
    return raw.select(
        *raw.columns[: len(kept)],
        "stratum",
        *["of_words.n_words", "of_words.word_chars", "n_symbols", "of_lines.n_dup_lines"],
        *["of_words.n_repeat_words", "of_lines.n_lines", "n_capitals"],
    )


def base_failed() -> Column:
    """Too few words, or more than half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


# Cutoffs ----------------------------------------------------------------------------------------


def log_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series beyond 20, where it is exact to double precision."""
    x = n.cast("double") + 1
    series = 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    stirling = (x - 0.5) * F.log(x) - x + F.lit(0.5 * math.log(2 * math.pi)) + series
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")))).otherwise(stirling)


def binomial_at_most(k: Column, n: Column, p: float) -> Column:
    """Exact P(X <= k) for X of n draws with chance p; 1 where k is not below the mean, n p.

    Below the mean the terms fall with k at least geometrically soon, so those further than twelve
    standard deviations away do not reach the last digit.
    """
    term = (
        log_factorial(n) - log_factorial(k) - log_factorial(n - k)
        + k * F.lit(math.log(p)) + (n - k) * F.lit(math.log1p(-p))
    )
    reach = (50 + 12 * F.sqrt(n * p)).cast("long")
    down = F.when(k > 0, F.sequence(k, F.greatest(k - reach, F.lit(1)), F.lit(-1).cast("long")))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(state: Column, i: Column) -> Column:
        next_term = state["term"] * i * F.lit((1 - p) / p) / (n - i + 1)
        return F.struct(next_term.alias("term"), (state["sum"] + next_term).alias("sum"))

    total = F.coalesce(F.aggregate(down, start, step)["sum"], F.lit(1.0))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(term) * total)


def choose_cutoffs(
    figures: DataFrame,
    labels: DataFrame,
    false_rejections: float = FALSE_REJECTIONS,
    level: float = LEVEL,
) -> DataFrame:
    """stratum and, per rule, the cutoff in use (null: the rule is off).

    `labels` gives doc_id and quality (1 good, 0 bad); a doc_id labelled both ways counts as good.
    Null labels and ids, and documents that fail the base rules, do not take part. Documents are
    counted per stratum, rule and interval between cutoffs before anything is shuffled.
    """
    rules = _rules()
    verdicts = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("_labelled"))
        .agg(F.max("quality").alias("_good"))
    )
    above = lambda figure, cutoffs: sum((figure > c).cast("int") for c in cutoffs)
    levels = F.array(*[above(figure, cutoffs) for figure, cutoffs in rules.values()]).alias("levels")
    joined = figures.join(verdicts, F.col("doc_id") == F.col("_labelled"))
    # Documents agree in their levels far more often than not, so they are counted by all five first.
    together = joined.groupBy("stratum", levels).agg(
        F.count_if(~base_failed() & (F.col("_good") > 0)).alias("good"),
        F.count_if(~base_failed() & (F.col("_good") <= 0)).alias("bad"),
    )
    each = F.arrays_zip(F.array(*[F.lit(name) for name in rules]).alias("rule"), F.col("levels").alias("level"))
    counts = stored(
        together.select("stratum", "good", "bad", F.inline(each).alias("rule", "level"))
        .groupBy("stratum", "rule", "level")
        .agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        .filter("good + bad > 0"),
        "quality-counts",
    )
    strata = counts.select("stratum").distinct().count()
    share, corrected = false_rejections / len(rules), level / max(1, strata * len(rules))

    totals = counts.groupBy("stratum", "rule").agg(F.sum("good").alias("n"), F.sum("bad").alias("m"))
    rejected = (
        counts.filter(F.col("level") > 0)
        .select("stratum", "rule", "good", "bad", F.explode(F.sequence(F.lit(1), F.col("level"))).alias("k"))
        .groupBy("stratum", "rule", "k")
        .agg(F.sum("good").alias("false"), F.sum("bad").alias("true"))
    )
    tested = rejected.join(totals, ["stratum", "rule"]).withColumn(
        "chance", binomial_at_most(F.col("false"), F.col("n"), share)
    )
    # A document above k cutoffs is above the k-th from the strict end of the list.
    usable = tested.filter((F.col("chance") <= corrected) & (F.col("true") > 0) & (F.col("n") > 0))
    gain = F.col("true") / F.col("m") - GOOD_OVER_BAD * F.col("false") / F.col("n")
    best = usable.groupBy("stratum", "rule").agg(F.max(F.struct(gain, F.col("k"))).alias("best"))
    grid = F.create_map(*[
        x for name, (_, cutoffs) in rules.items()
        for x in (F.lit(name), F.array(*[F.lit(c) for c in cutoffs]))
    ])
    cutoff = F.element_at(F.element_at(grid, F.col("rule")), -F.col("best.k"))
    per_rule = [F.max(F.when(F.col("rule") == name, cutoff)).alias(name) for name in rules]
    return stored(best.groupBy("stratum").agg(*per_rule), "quality-cutoffs")


def passes() -> Column:
    """Of figures with their stratum's cutoffs beside them: neither a base rule nor a cutoff hit."""
    hits = [
        F.coalesce(figure > F.col(f"_cutoffs.{name}"), F.lit(False))
        for name, (figure, _) in _rules().items()
    ]
    rejected = base_failed()
    for hit in hits:
        rejected = rejected | hit
    return ~rejected


def judge(figures: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Figures with `base_failed` and `kept`. The cutoffs, a row per stratum, carry their size, so
    Spark broadcasts them while they are small."""
    beside = cutoffs.select(
        F.col("stratum").alias("_stratum"),
        F.struct(*[F.col(name) for name in _rules()]).alias("_cutoffs"),
    )
    joined = figures.join(beside, F.col("stratum") == F.col("_stratum"), "left")
    return joined.withColumns({"base_failed": base_failed(), "kept": passes()}).drop(
        "_stratum", "_cutoffs"
    )


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of `docs`: its figures, whether a base rule fails it, and the verdict.

    Null texts count as empty and fail; null languages are a stratum of their own; repeated rows
    are judged alike; an empty table gives an empty result; other columns are not read.
    """
    figures = stored(document_figures(docs), "quality-figures")
    return judge(figures, choose_cutoffs(figures, labels))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that pass, with their own columns.

    Rows are stored with their figures once, as measuring a text costs far more than reading it
    again; texts are not shuffled.
    """
    measured = stored(document_figures(docs, F.struct("*").alias("_row")), "quality-measured")
    figures = measured.select("_row.doc_id", *measured.columns[1:])
    return judge(measured, choose_cutoffs(figures, labels)).filter("kept").select("_row.*")
