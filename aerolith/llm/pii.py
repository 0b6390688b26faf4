"""Personal data in texts: base patterns, and more spans by boosted trees over candidates.

Base patterns find e-mail and IP addresses, card and phone numbers; what they find always stays.
Generators with wider patterns propose further candidates, which may overlap. Each candidate is
described by its format (digits, groups, checks) and its context (neighbours, words before it).
Boosted trees, one ensemble per kind, learn from candidates that are base spans against those that
are not. The marks that define the base patterns (`@`, plain separators, the plus sign) are no
features, so a candidate that agrees in everything else, such as a phone number without its plus,
scores as a base span does.

A kind's threshold comes from texts held out of fitting: the least score at which, by an exact
binomial bound, at most `MOST_FALSE` of the held-out candidates at or above it are no base spans. A
kind without enough held-out candidates adds nothing. Candidates above it that overlap no base span
are added; of overlapping ones the one further above its threshold.

Everything on texts is DataFrame functions, map side only. For fitting, candidates of the whole
corpus are counted by their (small, whole-number) features; the `PATTERNS` most frequent of these
go to the driver, where trees are grown and become column expressions.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from aerolith.llm.common import let
from aerolith.session import stored

EMAIL, IP, CARD, PHONE = KINDS = ("email", "ip", "card", "phone")
PATTERNS = 20_000
MOST_FALSE = 0.1
LEVEL = 0.05
TREES, DEPTH, RATE = 20, 3, 0.3
_FOLDS = 5  # one of them is held out
_BEFORE, _AFTER = 24, 4  # characters of context
_RUN = 128

# The base patterns, written so that Java reads a text once: a match can only begin where a run of
# its first characters does, or where the match before it ended, and runs are not given up again.
_BASE = {
    EMAIL: r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    IP: r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Longer and shorter runs of digits fail, so only those of 14 to 19 are taken out.
    CARD: r"[0-9](?<![0-9]{2})(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    PHONE: r"\+[0-9][\x20().0-9-]+[0-9]",
}
_DOT = r"(?:\.|\x20?[\[({](?:dot|\.)[\])}]\x20?|\x20(?:dot|DOT)\x20)"
_AT = r"(?:@|\x20@\x20|\x20?[\[({]\x20?(?:at|@)\x20?[\])}]\x20?|\x20(?:at|AT)\x20(?=[\p{L}\p{N}-]{1,64}+\x20(?:dot|DOT)\x20))"
# Wider ones. All counts are bounded.
_WIDE = {
    EMAIL: rf"(?<![\p{{L}}\p{{N}}._%+-])[\p{{L}}\p{{N}}._%+-]{{1,64}}+{_AT}[\p{{L}}\p{{N}}-]{{1,64}}+(?:{_DOT}[\p{{L}}\p{{N}}-]{{1,64}}+){{1,8}}+",
    IP: r"[0-9](?<![0-9.][0-9])[0-9]{0,2}+(?:\x20?(?:\.|[\[({](?:\.|dot)[\])}])\x20?[0-9]{1,3}+){3}(?![0-9])",
    CARD: r"[0-9](?<![0-9]{2})(?:[\x20._/-]{0,2}+[0-9]){12,18}+(?![0-9])",
    PHONE: r"(?<![\p{L}\p{N}])(?:\+|00)?+\(?+[0-9](?:[\x20().\-/]{0,3}+[0-9]){6,14}+(?![\p{L}\p{N}])",
}
# Words that say what kind of number follows, and words of other numbers.
_WORDS = (
    r"mail|contact|write to|schreib|escrib|courriel|correo",
    r"phone|tel\b|tel[.:]|call|fax|mobile|cell|anruf|handy|llam",
    r"card|visa|master|credit|karte|carte|tarjeta",
    r"\bip\b|host|server|address|adres|direcc",
    r"version|order|invoice|isbn|serial|article|page|ref|no\.|nr\.|#\s*$",
)
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_SPAN = "array<struct<start:int,end:int,raw:string,before:string,after:string>>"


# Spans of a pattern -----------------------------------------------------------------------------


def running(values: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """For each value of an array: `step` folded from `start` over it and the values before it.

    Folded run by run, as an array that grows by one element at a time is copied each time.
    """

    def fold(array: Column, first: Column) -> Column:
        grown = F.aggregate(array, F.array(first), lambda all_, x: F.array_append(all_, step(F.element_at(all_, -1), x)))
        return F.slice(grown, F.lit(2), F.size(array))

    def by_runs(whole: Column) -> Column:
        cuts = F.sequence(F.lit(1), F.size(whole), F.lit(_RUN))
        sums = F.transform(cuts, lambda c: F.aggregate(F.slice(whole, c, F.lit(_RUN)), start, lambda a, b: step(a, b)))
        heads = F.concat(F.array(start), fold(sums, start))
        runs = let(heads, lambda h: F.transform(cuts, lambda c, i: fold(F.slice(whole, c, F.lit(_RUN)), F.get(h, i))))
        return F.when(F.size(whole) <= _RUN, fold(whole, start)).otherwise(F.flatten(runs))

    return let(values, by_runs)


def spans(text: Column, pattern: str, possible: Column) -> Column:
    """Start, end (in code points, end exclusive), match and neighbouring text of each match.

    The pieces between the matches tell where these are. Only texts that are `possible` are read.
    """

    def place(matches: Column) -> Column:
        def among(pieces: Column) -> Column:
            lengths = F.transform(matches, lambda m, i: F.length(m) + F.length(F.get(pieces, i)))
            return let(
                running(lengths, F.lit(0), lambda a, b: a + b),
                lambda ends: F.transform(matches, lambda m, i: F.struct(
                    (F.get(ends, i) - F.length(m)).alias("start"),
                    F.get(ends, i).alias("end"),
                    m.alias("raw"),
                    F.right(F.get(pieces, i), F.lit(_BEFORE)).alias("before"),
                    F.left(F.get(pieces, i + 1), F.lit(_AFTER)).alias("after"),
                )),
            )

        empty = F.array().cast(_SPAN)
        return F.when(F.size(matches) > 0, let(F.split(text, pattern, -1), among).cast(_SPAN)).otherwise(empty)

    none = F.array().cast("array<string>")
    return let(F.when(possible, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none), place)


def digits_of(raw: Column) -> Column:
    return F.regexp_replace(raw, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit fits."""

    def value(i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, digit).when(digit > 4, digit * 2 - 9).otherwise(digit * 2)

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(places, F.lit(0), lambda total, i: total + value(i)) % 10 == 0


def _holds(kind: str, raw: Column) -> Column:
    """What a match of the base pattern has to pass besides."""
    if kind == IP:
        return raw.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == CARD:
        return luhn(digits_of(raw))
    if kind == PHONE:
        return F.length(digits_of(raw)).between(10, 15)
    return F.lit(True)


def _possible(kind: str, text: Column) -> Column:
    """A cheap test that every text with a match of the base pattern or the wide one passes."""
    if kind == EMAIL:
        signs = ("@", " dot ", " DOT ", "(at", "[at", "{at", "( at", "[ at", "{ at")
        return reduce(lambda a, b: a | b, [F.contains(text, F.lit(sign)) for sign in signs])
    return text.rlike("[0-9]")


# Features ---------------------------------------------------------------------------------------

FEATURES = (
    "digits", "check", "groups", "last_group", "separators", "length", "before", "after", "words",
    "digits_before", "letters", "local",
)


def _neighbour(char: Column) -> Column:
    return (
        F.when((char == "") | char.rlike(r"^\s$"), 0).when(char.rlike(r"^\p{L}$"), 1)
        .when(char.rlike("^[0-9]$"), 2).when(char.rlike(r"""^[(\[{<"':=]$"""), 3).otherwise(4)
    )


def _features(kind: str, span: Column) -> Column:
    """Small whole numbers, in the order of FEATURES."""
    raw, before = span["raw"], span["before"]
    at_most = lambda n, most: F.least(n, F.lit(most))

    def rest(digits: Column) -> Column:
        check, local = F.lit(0), F.lit(0)
        if kind == CARD:
            check = luhn(digits).cast("int")
        elif kind == IP:
            check = F.regexp_replace(raw, "[^0-9]+", ".").rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$").cast("int")
        elif kind == EMAIL:
            check = at_most(F.length(F.regexp_extract(raw, r"(\p{L}*)$", 1)), 8)
            local = at_most(F.length(F.regexp_extract(raw, r"^([\p{L}\p{N}._%+-]+)", 1)), 20)
        words = F.lit(0)
        for i, pattern in reversed(list(enumerate(_WORDS))):
            words = F.when(before.rlike("(?i)" + pattern), i + 1).otherwise(words)
        # A format is the same with any separators, so only whether there are several kinds counts;
        # what separates an address is not looked at.
        marks = F.size(F.array_distinct(F.split(F.regexp_replace(raw, r"[0-9+]", ""), "")))
        separators = at_most(marks, 3) if kind in (CARD, PHONE) else F.lit(0)
        length = F.lit(0) if kind in (EMAIL, IP) else at_most(F.length(digits), 20)
        return F.array(
            at_most(F.length(digits), 20), check, at_most(F.regexp_count(raw, F.lit("[0-9]+")), 8),
            at_most(F.length(F.regexp_extract(raw, "([0-9]*)$", 1)), 10), separators, length,
            _neighbour(F.right(before, F.lit(1))), _neighbour(F.left(span["after"], F.lit(1))), words,
            at_most(F.length(digits_of(before)), 10),
            F.when(F.lit(kind == EMAIL), F.lit(0)).otherwise(at_most(F.regexp_count(raw, F.lit(r"\p{L}")), 10)),
            local,
        ).cast("array<int>")

    return let(digits_of(raw), rest)


# One row per document ---------------------------------------------------------------------------

_ITEM = "array<struct<start:int,end:int,kind:int,base:int,features:array<int>>>"


def _items(text: Column) -> Column:
    """Base spans and candidates in one array."""
    found = []
    for i, kind in enumerate(KINDS):
        found += _items_of(kind, i, text, _possible(kind, text))
    return F.concat(*found)


def _items_of(kind: str, number: int, text: Column, possible: Column) -> list[Column]:
    def item(span: Column, base: int, features: Column) -> Column:
        return F.struct(
            span["start"].alias("start"), span["end"].alias("end"), F.lit(number).alias("kind"),
            F.lit(base).alias("base"), features.alias("features"),
        )

    none = F.lit(None).cast("array<int>")
    held = F.filter(spans(text, _BASE[kind], possible), lambda s: _holds(kind, s["raw"]))
    wide = spans(text, _WIDE[kind], possible)
    return [
        F.transform(held, lambda s: item(s, 1, none)).cast(_ITEM),
        F.transform(wide, lambda s: item(s, 0, _features(kind, s))).cast(_ITEM),
    ]


def _told_apart(items: Column) -> Column:
    """Base spans, and candidates that either are one (`base` 1) or overlap none (0).

    Items are in order of start. What lies before a candidate is summed up by the greatest end of a
    base span so far, what lies behind it by the next base span's start.
    """
    far = F.lit(2**31 - 1)

    def judge(ordered: Column) -> Column:
        ends = F.transform(ordered, lambda x: F.when(x["base"] == 1, x["end"]).otherwise(0))
        starts = F.transform(F.reverse(ordered), lambda x: F.when(x["base"] == 1, x["start"]).otherwise(far))
        reach = running(ends, F.lit(0), F.greatest)
        following = F.reverse(running(starts, far, F.least))
        same = lambda a, b: F.coalesce(
            (a["start"] == b["start"]) & (a["end"] == b["end"]) & (a["kind"] == b["kind"]) & (b["base"] == 1),
            F.lit(False),
        )

        def label(reach: Column, following: Column) -> Column:
            return F.transform(ordered, lambda x, i: F.struct(
                x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"),
                F.when(x["base"] == 1, 2)
                # A base span sorts right behind the candidate that equals it.
                .when(same(x, F.get(ordered, i + 1)), 1)
                .when((F.get(reach, i) <= x["start"]) & (F.get(following, i) >= x["end"]), 0)
                .otherwise(-1).alias("state"),
                x["features"].alias("features"),
            ))

        return let(reach, lambda r: let(following, lambda f: label(r, f)))

    by_place = let(F.sort_array(F.transform(items, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), x["base"].alias("base"),
        x["features"].alias("features")))), judge)
    return F.filter(by_place, lambda x: x["state"] >= 0)


def document_spans(docs: DataFrame, *keep: Column) -> DataFrame:
    """`keep` (doc_id if none), held_out, `base` (start, end, kind) and `candidates` (also state and
    features) of every row of `docs`, in whole texts. Equal texts are held out together."""
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = keep or (F.col("doc_id"),)
    read = docs.select(
        *kept,
        (F.pmod(F.xxhash64(text), F.lit(_FOLDS)) == 0).alias("held_out"),
        let(_items(text), _told_apart).alias("_all"),
    )
    plain = lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))
    return read.select(
        *read.columns[: len(kept)], "held_out",
        F.sort_array(F.transform(F.filter("_all", lambda x: x["state"] == 2), plain)).alias("base"),
        F.filter("_all", lambda x: x["state"] < 2).alias("candidates"),
    )


# Boosted trees ----------------------------------------------------------------------------------

Tree = float | tuple  # a leaf's value, or (feature, greatest value that goes left, left, right)


def grow(x: np.ndarray, slope: np.ndarray, bend: np.ndarray, depth: int) -> Tree:
    """The tree of at most `depth` that lowers the loss most, split by split."""
    total, weight = slope.sum(), bend.sum()
    gain_of = lambda s, b: s * s / (b + 1.0)
    best = (1e-6, None, None)
    for feature in range(x.shape[1] if depth else 0):
        s, b = np.cumsum(np.bincount(x[:, feature], slope)), np.cumsum(np.bincount(x[:, feature], bend))
        gain = gain_of(s, b) + gain_of(total - s, weight - b) - gain_of(total, weight)
        gain[(b < 1.0) | (weight - b < 1.0)] = 0.0
        at = int(gain.argmax())
        if gain[at] > best[0] + 1e-9:
            best = (gain[at], feature, at)
    _, feature, at = best
    if feature is None:
        return float(RATE * total / (weight + 1.0))
    left = x[:, feature] <= at
    return (
        feature, at,
        grow(x[left], slope[left], bend[left], depth - 1), grow(x[~left], slope[~left], bend[~left], depth - 1),
    )


def value_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    feature, at, left, right = tree
    return np.where(x[:, feature] <= at, value_of(left, x), value_of(right, x))


def boost(x: np.ndarray, yes: np.ndarray, no: np.ndarray) -> list[Tree]:
    """Logistic boosting on patterns that stand for `yes` and `no` candidates each. The first tree
    is a leaf: the prior."""
    n_yes, n_no = yes.sum(), no.sum()
    trees: list[Tree] = [float(math.log((n_yes + 0.5) / (n_no + 0.5)))]
    score = value_of(trees[0], x)
    if not (n_yes and n_no):
        return trees
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        tree = grow(x, yes - (yes + no) * p, (yes + no) * p * (1 - p) + 1e-9, DEPTH)
        trees.append(tree)
        score = score + value_of(tree, x)
    return trees


def at_most_chance(k: int, n: int, p: float) -> float:
    """P(X <= k) for X of n draws with chance p, summed down from k until terms no longer count."""
    if k >= n:
        return 1.0
    term = math.exp(
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    )
    total = 0.0
    while k >= 0 and term > 1e-18 * max(total, 1e-300):
        total += term
        term *= k / (n - k + 1) * (1 - p) / p
        k -= 1
    return min(1.0, total)


def threshold(score: np.ndarray, yes: np.ndarray, no: np.ndarray) -> float | None:
    """The least score at which the exact bound holds, coming from the greatest; None if none does."""
    found = None
    for cut in sorted(set(score.tolist()), reverse=True):
        above = score >= cut
        false, n = int(no[above].sum()), int((yes + no)[above].sum())
        if at_most_chance(false, n, MOST_FALSE) <= LEVEL:
            found = cut
    return found


class Model:
    """Per kind its trees and threshold."""

    def __init__(self, trees: dict[int, list[Tree]], cutoffs: dict[int, float]):
        self.trees, self.cutoffs = trees, cutoffs

    def margin(self, kind: int, x: np.ndarray) -> np.ndarray:
        """How far candidates lie above their threshold, as `margin_of` does in columns."""
        return sum(value_of(t, x) for t in self.trees[kind]) - self.cutoffs[kind]

    def margin_of(self, candidate: Column) -> Column:
        """The same as a column; null for a kind without a threshold."""

        def column(tree: Tree) -> Column:
            if isinstance(tree, float):
                return F.lit(tree)
            feature, at, left, right = tree
            return F.when(F.get(candidate["features"], F.lit(feature)) <= at, column(left)).otherwise(column(right))

        result = F.lit(None).cast("double")
        for kind, cutoff in self.cutoffs.items():
            total = F.lit(-cutoff)
            for tree in self.trees[kind]:
                total = total + column(tree)
            result = F.when(candidate["kind"] == kind, total).otherwise(result)
        return result


def fit(found: DataFrame, patterns: int = PATTERNS) -> Model:
    """Learn from the candidates of all documents, counted by features. `patterns` bounds what the
    driver sees: up to that many combinations of features per kind and fold come whole, more are
    learnt from in Spark (`fit_spread`), with the same trees and thresholds."""
    counted = (
        found.select("held_out", F.inline("candidates"))
        .groupBy("kind", "features", "held_out")
        .agg(F.count_if(F.col("state") == 1).alias("yes"), F.count_if(F.col("state") == 0).alias("no"))
    )
    rows = counted.limit(patterns + 1).collect()
    if len(rows) > patterns:
        return fit_spread(stored(counted, "pii-patterns"))
    rows = sorted(rows, key=lambda r: (r["kind"], r["features"]))
    trees, cutoffs = {}, {}
    for kind in range(len(KINDS)):
        own = [r for r in rows if r["kind"] == kind]
        shown = [r for r in own if not r["held_out"]]
        if not any(r["yes"] for r in shown):
            continue
        table = lambda rs: (np.array([r["features"] for r in rs], np.int64).reshape(len(rs), -1),
                            np.array([r["yes"] for r in rs], float), np.array([r["no"] for r in rs], float))
        trees[kind] = boost(*table(shown))
        kept = [r for r in own if r["held_out"]]
        if kept:
            x, yes, no = table(kept)
            cut = threshold(sum(value_of(t, x) for t in trees[kind]), yes, no)
            if cut is not None:
                # Columns may add the trees up in another order, to a last digit less.
                cutoffs[kind] = cut - 1e-9
    return Model(trees, cutoffs)


def _score_of(trees: dict[int, list[Tree]], features: Column, kind: Column) -> Column:
    """The trees' sum for a candidate of `kind`, as `value_of` gives it; null for other kinds."""

    def column(tree: Tree) -> Column:
        if isinstance(tree, float):
            return F.lit(tree)
        feature, at, left, right = tree
        return F.when(F.get(features, F.lit(feature)) <= at, column(left)).otherwise(column(right))

    result = F.lit(None).cast("double")
    for k, own in trees.items():
        result = F.when(kind == k, reduce(lambda a, t: a + column(t), own[1:], column(own[0]))).otherwise(result)
    return result


def _grown(node: int, splits: dict, sums: dict, depth: int) -> Tree:
    """The tree below `node` from the splits found level by level and the nodes' sums."""
    if node not in splits or depth == 0:
        total, weight = sums[node]
        return float(RATE * total / (weight + 1.0))
    feature, at = splits[node]
    return (feature, at, _grown(2 * node, splits, sums, depth - 1), _grown(2 * node + 1, splits, sums, depth - 1))


def _best_split(histogram: dict[int, dict[int, tuple[float, float]]]) -> tuple[tuple[float, float], tuple | None]:
    """A node's sums and its best split, as `grow` chooses it, from sums per feature and value."""
    gain_of = lambda s, b: s * s / (b + 1.0)
    best, found, whole = (1e-6, None, None), None, None
    for feature in sorted(histogram):
        values = histogram[feature]
        top = max(values)
        slope, bend = np.zeros(top + 1), np.zeros(top + 1)
        for value, (s_, b_) in values.items():
            slope[value], bend[value] = s_, b_
        s, b = np.cumsum(slope), np.cumsum(bend)
        whole = whole or (s[-1], b[-1])
        total, weight = whole
        gain = gain_of(s, b) + gain_of(total - s, weight - b) - gain_of(total, weight)
        gain[(b < 1.0) | (weight - b < 1.0)] = 0.0
        at = int(gain.argmax())
        if gain[at] > best[0] + 1e-9:
            best = (gain[at], feature, at)
            found = (feature, at, (s[at], b[at]), (total - s[at], weight - b[at]))
    return whole, found


def fit_spread(counted: DataFrame) -> Model:
    """`fit` on combinations of features that stay in Spark: each level of each tree is chosen from
    sums of slope and bend per kind, node, feature and value; thresholds from counts per score."""
    totals = {
        (r["kind"], r["held_out"]): (r["yes"], r["no"])
        for r in counted.groupBy("kind", "held_out").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).collect()
    }
    kinds = [k for k in range(len(KINDS)) if totals.get((k, False), (0, 0))[0]]
    trees: dict[int, list[Tree]] = {}
    for k in kinds:
        n_yes, n_no = totals[(k, False)]
        trees[k] = [float(math.log((n_yes + 0.5) / (n_no + 0.5)))]
    growing = [k for k in kinds if all(totals[(k, False)])]
    shown = counted.filter(~F.col("held_out") & F.col("kind").isin(growing))
    features, kind = F.col("features"), F.col("kind")
    for _ in range(TREES if growing else 0):
        p = 1 / (1 + F.exp(-_score_of({k: trees[k] for k in growing}, features, kind)))
        n = F.col("yes") + F.col("no")
        rated = shown.select(
            "kind", "features", (F.col("yes") - n * p).alias("slope"), (n * p * (1 - p) + 1e-9).alias("bend"),
        )
        splits: dict[int, dict] = {k: {} for k in growing}
        sums: dict[int, dict] = {k: {} for k in growing}
        for level in range(DEPTH):
            node = F.lit(1)
            for k in growing:
                at_kind = F.lit(1)
                for _level in range(level):
                    step = F.lit(None).cast("int")
                    for parent, (feature, at) in splits[k].items():
                        step = F.when(at_kind == parent, F.when(F.get(features, F.lit(feature)) <= at, 2 * parent)
                                      .otherwise(2 * parent + 1)).otherwise(step)
                    at_kind = step
                node = F.when(kind == k, at_kind).otherwise(node) if level else node
            histogram = (
                rated.withColumn("node", node).filter(F.col("node").isNotNull())
                .select("kind", "node", F.posexplode("features").alias("feature", "value"), "slope", "bend")
                .groupBy("kind", "node", "feature", "value").agg(F.sum("slope").alias("s"), F.sum("bend").alias("b"))
                .collect()
            )
            by_node: dict[tuple[int, int], dict[int, dict[int, tuple[float, float]]]] = {}
            for r in histogram:
                by_node.setdefault((r["kind"], r["node"]), {}).setdefault(r["feature"], {})[r["value"]] = (r["s"], r["b"])
            for (k, at_node), histogram_ in by_node.items():
                whole, found = _best_split(histogram_)
                sums[k].setdefault(at_node, whole)
                if found is not None:
                    feature, at, left, right = found
                    splits[k][at_node] = (feature, at)
                    sums[k][2 * at_node], sums[k][2 * at_node + 1] = left, right
        for k in growing:
            trees[k].append(_grown(1, splits[k], sums[k], DEPTH))
    cutoffs = {}
    held = counted.filter(F.col("held_out") & F.col("kind").isin(kinds))
    scored = (
        held.select("kind", _score_of(trees, features, kind).alias("score"), "yes", "no")
        .groupBy("kind", "score").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
        .collect()
    )
    for k in kinds:
        own = [r for r in scored if r["kind"] == k]
        if own:
            cut = threshold(np.array([r["score"] for r in own]), np.array([r["yes"] for r in own], float),
                            np.array([r["no"] for r in own], float))
            if cut is not None:
                cutoffs[k] = cut - 1e-9
    return Model(trees, cutoffs)


# Results ----------------------------------------------------------------------------------------


def with_added(found: DataFrame, model: Model) -> DataFrame:
    """`found` with `added`: the candidates that the model selects, none overlapping another."""
    rated = F.transform(
        F.filter("candidates", lambda c: c["state"] == 0),
        lambda c: F.struct(
            c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"),
            model.margin_of(c).alias("margin"),
        ),
    )
    chosen = F.sort_array(F.filter(rated, lambda c: F.coalesce(c["margin"] >= 0, F.lit(False))))
    kind = "array<struct<start:int,kind:int,end:int,margin:double>>"

    def better(kept: Column, one: Column) -> Column:
        last = F.try_element_at(kept, F.lit(-1))
        meets = F.coalesce(last["end"] > one["start"], F.lit(False))
        swapped = F.array_append(F.slice(kept, F.lit(1), F.size(kept) - 1), one)
        return (
            F.when(~meets, F.array_append(kept, one)).when(one["margin"] > last["margin"], swapped).otherwise(kept)
        )

    swept = F.aggregate(chosen.cast(kind), F.array().cast(kind), better)
    plain = F.transform(swept, lambda c: F.struct(c["start"], c["kind"], c["end"]))
    return found.withColumn("added", plain.cast("array<struct<start:int,kind:int,end:int>>"))


def personal_spans(docs: DataFrame, patterns: int = PATTERNS) -> DataFrame:
    """doc_id, `base` and `added` (arrays of start, kind, end; kind as in KINDS) of every row.

    Null texts count as empty and have no spans; repeated rows are each read and each count for the
    trees; rows without an id are read as any other; an empty table gives an empty result. Other
    columns are not read.
    """
    found = stored(document_spans(docs), "pii-spans")
    return with_added(found, fit(found, patterns)).select("doc_id", "base", "added")


def redacted(docs: DataFrame, patterns: int = PATTERNS) -> DataFrame:
    """The rows of `docs` with their own columns, all personal data of the text replaced by its kind,
    such as [PHONE]. Spans that overlap become one, of the first one's kind. Null texts stay null.

    Rows are stored once with their spans; texts are not shuffled.
    """
    rows = stored(document_spans(docs, F.struct("*").alias("_row")), "pii-rows")
    found = with_added(rows, fit(rows, patterns))
    kind = "array<struct<start:int,kind:int,end:int>>"

    def merged(kept: Column, one: Column) -> Column:
        last = F.try_element_at(kept, F.lit(-1))
        meets = F.coalesce(last["end"] > one["start"], F.lit(False))
        wider = F.struct(last["start"].alias("start"), last["kind"].alias("kind"), F.greatest(last["end"], one["end"]).alias("end"))
        return F.when(~meets, F.array_append(kept, one)).otherwise(F.array_append(F.slice(kept, F.lit(1), F.size(kept) - 1), wider))

    every = F.sort_array(F.concat("base", "added")).cast(kind)
    apart = F.aggregate(every, F.array().cast(kind), merged)
    names = F.array(*[F.lit(f"[{name.upper()}]") for name in KINDS])
    text = F.col("_row.text")

    def rewrite(cuts: Column) -> Column:
        end_before = lambda i: F.coalesce(F.get(cuts, i - 1)["end"], F.lit(0))
        pieces = F.transform(cuts, lambda c, i: F.concat(
            F.substring(text, end_before(i) + 1, c["start"] - end_before(i)), F.get(names, c["kind"])
        ))
        tail = F.substring(text, end_before(F.size(cuts)) + 1, F.length(text))
        return F.when(F.size(cuts) == 0, text).otherwise(F.concat(F.array_join(pieces, ""), tail))

    new = let(apart, rewrite)
    return found.select(*[new.alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns])


def span_text(spans_: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans_, one), ",")


def span_report(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans per kind, base_sha256 over `span_text` of the base spans, and
    `spans`, the text of all of them, by start and then kind."""
    found = personal_spans(docs)
    number = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    numbers = [number(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    return found.select(
        "doc_id", *numbers, F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.sort_array(F.concat("base", "added"))).alias("spans"),
    )
