"""Toxicity by a weighted finite-state grammar over clauses.

A lexicon transducer turns words into symbols: insult, slight (a doubtful insult), threat, target,
negation, reported speech or other. Context transducers read the symbols of one clause: one follows the scope of a negation, one
that of reported speech, one whether the clause is aimed at somebody. Their composition is a single
machine, which tags every insult and threat of a clause with its context. A document's score is a
logistic function of the lexicon weights that the clauses let through on each kind of path.

Context words are fixed lists. Insults are learned, whole words or word beginnings, from labelled
documents, and so is what each kind of path counts; the grammar's own weights are the prior. The
classifier is fitted on at most `LABELLED_ROWS` labelled rows, the smallest by hash.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from aerolith.session import stored

# Context words in four languages.
TARGETS = (
    "you your yours yourself u he she him her they them these those people "
    "tu te toi vous votre ton ta tes du dich dir ihr euch dein deine sie "
    "usted ustedes vosotros ti tus ellos ellas"
).split()
NEGATIONS = "not no never none nor cannot isn't aren't don't didn't wasn't ne pas jamais nicht kein keine nie nunca".split()
REPORTED = (
    "said says say saying told wrote claimed reported quoted called according "
    "dit disait selon sagte sagt laut dijo dice según"
).split()
THREATS = (
    "kill hurt destroy murder stab shoot burn die "
    "tuer frapper töten schlagen umbringen matar golpear"
).split()

LABELLED_ROWS = 50_000
LEAST_DOCUMENTS = 3  # toxic documents of the sample that an entry of the lexicon needs
CUTOFF = 0.7

_PREFIXES = (3, 4, 5, 6, 7, 8)
_SURE = 2.3  # standard errors that an entry's log odds must stand above _LEAST_ODDS
_LEAST_ODDS = 1.0
_STRONG = 3.0  # log odds from which an entry is an insult, not a slight
_MEMO = 300_000
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;:\n]+")
_BREAK = frozenset(".!?;:\n")


# The grammar ------------------------------------------------------------------------------------

INSULT, SLIGHT, THREAT, TARGET, NEGATION, REPORT, OTHER = SYMBOLS = "ISTYNRO"
SCORED = frozenset((INSULT, SLIGHT, THREAT))
Machine = dict[tuple[object, str], tuple[object, tuple[str, ...]]]


def negation_machine(scope: int = 3) -> Machine:
    """Marks what stands within `scope` words after a negation."""
    arcs: Machine = {}
    for left in range(scope + 1):
        for symbol in SYMBOLS:
            after = scope if symbol == NEGATION else max(left - 1, 0)
            marks = ("negated",) if left and symbol in SCORED else ()
            arcs[left, symbol] = after, marks
    return arcs


def report_machine() -> Machine:
    """Marks what stands after a word of reported speech, to the end of the clause."""
    return {
        (said, symbol): (
            int(said or symbol == REPORT),
            ("reported",) if said and symbol in SCORED else (),
        )
        for said in (0, 1)
        for symbol in SYMBOLS
    }


def aim_machine() -> Machine:
    """Marks what stands after somebody is named or addressed."""
    return {
        (aimed, symbol): (
            int(aimed or symbol == TARGET),
            ("aimed",) if aimed and symbol in SCORED else (),
        )
        for aimed in (0, 1)
        for symbol in SYMBOLS
    }


def kind_machine() -> Machine:
    kinds = {INSULT: ("insult",), SLIGHT: ("slight",), THREAT: ("threat",)}
    return {(0, symbol): (0, kinds.get(symbol, ())) for symbol in SYMBOLS}


def compose(first: Machine, second: Machine) -> Machine:
    """The machine that takes both steps for each symbol and gives both outputs."""
    return {
        ((a, b), symbol): ((after_a, after_b), out_a + out_b)
        for (a, symbol), (after_a, out_a) in first.items()
        for (b, other), (after_b, out_b) in second.items()
        if symbol == other
    }


GRAMMAR = compose(compose(compose(kind_machine(), aim_machine()), report_machine()), negation_machine())
START = (((0, 0), 0), 0)
PATHS = sorted({out for _, out in GRAMMAR.values() if out})
_PATH_AT = {path: i for i, path in enumerate(PATHS)}
_DENSITIES = np.array([[kind in path for kind in ("insult", "slight")] for path in PATHS], float)


def prior_weight(path: tuple[str, ...]) -> float:
    """What the grammar says before any label is seen."""
    weight = 1.0 if "insult" in path else 0.5
    if "aimed" in path:
        weight *= 1.25
    if "reported" in path:
        weight *= 0.6
    if "negated" in path:
        weight *= 0.5
    return weight


# Words and clauses ------------------------------------------------------------------------------

_CONTEXT = {
    **{w: (TARGET, 0.0) for w in TARGETS},
    **{w: (NEGATION, 0.0) for w in NEGATIONS},
    **{w: (REPORT, 0.0) for w in REPORTED},
}


def word_features(word: str) -> list[str]:
    """The word itself, marked as whole, and its beginnings."""
    return ["=" + word, *(word[:n] for n in _PREFIXES if len(word) >= n)]


class Lexicon(dict):
    """Word to symbol and weight: the strongest entry among the word and its beginnings.

    Words met before are remembered, up to a bound.
    """

    def __init__(self, entries: dict[str, float]):
        super().__init__()
        self.entries = entries

    def __missing__(self, word: str) -> tuple[str, float]:
        if len(self) >= _MEMO:
            self.clear()
        self[word] = found = _CONTEXT.get(word) or self._look_up(word)
        return found

    def _look_up(self, word: str) -> tuple[str, float]:
        entries = self.entries
        weight = max(entries.get(f, 0.0) for f in word_features(word))
        if weight > 0:
            return INSULT if weight >= _STRONG else SLIGHT, weight
        return (THREAT, 1.0) if word in _THREATS else _NOTHING


_NOTHING = (OTHER, 0.0)
_THREATS = frozenset(THREATS)


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def path_sums(text: str | None, lexicon: Lexicon) -> np.ndarray:
    """Lexicon weight that the document's clauses let through on each path, then the word count."""
    sums = np.zeros(len(PATHS) + 1)
    words = tokens(text)
    sums[-1] = len(words)
    read = list(map(lexicon.__getitem__, words))
    hits = [i for i, (_, weight) in enumerate(read) if weight]
    done = -1
    for hit in hits:
        if hit <= done:
            continue
        start = hit
        while start > 0 and words[start - 1][0] not in _BREAK:
            start -= 1
        state, at = START, start
        while at < len(words) and words[at][0] not in _BREAK:
            symbol, weight = read[at]
            state, path = GRAMMAR[state, symbol]
            if path:
                sums[_PATH_AT[path]] += weight
            at += 1
        done = at
    return sums


def inputs(sums: np.ndarray) -> np.ndarray:
    """Regression inputs of documents: a constant, each path's sum dampened, and the weight of
    insults and of slights per 100 words."""
    paths, words = sums[:, :-1], sums[:, -1:]
    density = 100 * paths @ _DENSITIES / np.maximum(words, 20)
    return np.hstack([np.ones_like(words), np.log1p(paths), np.log1p(density)])


# Learning ---------------------------------------------------------------------------------------


@dataclass
class Model:
    entries: dict[str, float]
    weights: np.ndarray

    def score(self, sums: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(inputs(sums) @ self.weights, -30, 30)))


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are not learned: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(labels: DataFrame, limit: int) -> DataFrame:
    """At most `limit` labelled ids for learning, the smallest by hash; an id labelled both ways
    counts as toxic. Ids or labels that are null and held-out ids are left out."""
    usable = labels.filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))
    )
    one = usable.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_toxic"))
    return one.orderBy(F.xxhash64("_id"), "_id").limit(limit)


def _count_features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        seen = {0: 0, 1: 0}
        for text, toxic in zip(*(c.to_pylist() for c in batch.columns)):
            toxic = int(toxic > 0)
            seen[toxic] += 1
            features = set()
            for word in set(tokens(text)):
                if word[0] not in _BREAK and word not in _CONTEXT:
                    features.update(word_features(word))
            counts[toxic].update(features)
        counts[0][""], counts[1][""] = seen[0], seen[1]
        names = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array([counts[1][n] for n in names], pa.int64()),
                pa.array([counts[0][n] for n in names], pa.int64()),
            ],
            names=["feature", "toxic", "clean"],
        )


def learn_lexicon(sample: DataFrame) -> dict[str, list[float]]:
    """Words and beginnings that mark toxic documents, with the lower bound of their log odds: over
    all documents, without one clean document that has them, and without one toxic one.

    Counts are of documents. The empty feature counts all of them. The size of the sample bounds the
    lexicon: every entry is in `LEAST_DOCUMENTS` of its toxic documents.
    """
    counted = stored(
        sample.mapInArrow(_count_features, "feature string, toxic long, clean long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
        .filter((F.col("t") >= LEAST_DOCUMENTS) | (F.col("feature") == "")),
        "toxicity-features",
    )
    total = counted.filter(F.col("feature") == "").first()
    if total is None or not total["t"] or not total["c"]:
        return {}
    t, c, all_t, all_c = F.col("t"), F.col("c"), total["t"], total["c"]

    def bound(t: Column, c: Column) -> Column:
        has, lacks = t + 0.5, F.lit(all_t) - t + 0.5
        other, without = F.greatest(c, F.lit(0)) + 0.5, F.lit(all_c) - c + 0.5
        odds = F.log(has / lacks) - F.log(other / without)
        return odds - _SURE * F.sqrt(1 / has + 1 / lacks + 1 / other + 1 / without)

    sure = counted.filter(F.col("feature") != "").select(
        "feature", bound(t, c).alias("odds"), F.array(bound(t, c), bound(t, c - 1), bound(t - 1, c)).alias("w")
    )
    return {r["feature"]: r["w"] for r in sure.filter(F.col("odds") > _LEAST_ODDS).collect()}


def fit(x: np.ndarray, y: np.ndarray, prior: np.ndarray, steps: int = 30) -> np.ndarray:
    """Logistic regression by Newton's method, drawn to the prior weights."""
    weights, pull = prior.copy(), np.full(len(prior), 1.0)
    pull[0] = 0.01
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (y - p) - pull * (weights - prior)
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(bend, slope)
        weights = weights + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return weights


def train(
    docs: DataFrame,
    labels: DataFrame,
    limit: int = LABELLED_ROWS,
) -> Model:
    """Learn from the documents of at most `limit` labelled ids; `docs` needs doc_id and text.

    The sample's size is bounded, so its ids are broadcast and no text is shuffled. Without labels
    of both kinds the lexicon is empty and the grammar's own weights hold.
    """
    sample = F.broadcast(stored(labelled_sample(labels, limit), "toxicity-sample"))
    own = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    joined = own.join(sample, "_id")
    found = learn_lexicon(joined.select("_text", "_toxic"))
    prior = np.array([-3.0, *(prior_weight(p) for p in PATHS), 1.0, 0.5])
    if not found:
        return Model({}, prior)
    # A document is measured by what the others say of its words.
    without = [{f: w[1 + k] for f, w in found.items() if w[1 + k] > 0} for k in (0, 1)]

    def measure(batches):
        others = [Lexicon(entries) for entries in without]
        for batch in batches:
            ids, texts, toxic = batch.columns
            rows = [
                path_sums(text.as_py(), others[label.as_py() > 0]).tolist()
                for text, label in zip(texts, toxic)
            ]
            yield pa.RecordBatch.from_arrays(
                [ids, toxic, pa.array(rows, pa.list_(pa.float64()))], names=["id", "toxic", "sums"]
            )

    measured = joined.select("_id", "_text", F.col("_toxic").cast("int")).mapInArrow(
        measure, f"id {docs.schema['doc_id'].dataType.simpleString()}, toxic int, sums array<double>"
    )
    # A repeated id counts once, so no more rows come back than there are labels in the sample.
    rows = measured.groupBy("id").agg(F.max("toxic"), F.max("sums")).collect()
    rows.sort(key=lambda r: r[0])
    x = inputs(np.array([r[2] for r in rows]))
    y = np.array([float(r[1] > 0) for r in rows])
    return Model({f: w[0] for f, w in found.items()}, fit(x, y, prior))


# Scoring ----------------------------------------------------------------------------------------


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row. Null and empty texts get the score of a text without matches;
    repeated rows are each scored; other columns are not read."""

    def score(batches):
        lexicon = Lexicon(model.entries)
        for batch in batches:
            ids, texts = batch.columns
            sums = [path_sums(t.as_py(), lexicon) for t in texts]
            scores = model.score(np.array(sums).reshape(-1, len(PATHS) + 1))
            yield pa.RecordBatch.from_arrays([ids, pa.array(scores)], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double")


def drop_toxic(docs: DataFrame, model: Model, cutoff: float = CUTOFF) -> DataFrame:
    """The rows of `docs` that score below `cutoff`, with all their columns. Nothing is shuffled."""
    at = docs.columns.index("text")

    def keep(batches):
        lexicon = Lexicon(model.entries)
        for batch in batches:
            if batch.num_rows:
                sums = np.array([path_sums(t.as_py(), lexicon) for t in batch.column(at)])
                yield batch.filter(pa.array(model.score(sums) < cutoff))

    return docs.mapInArrow(keep, docs.schema)


def flag_toxic(docs: DataFrame, labels: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from `cutoff` on) of every document."""
    scored = score_documents(docs, train(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= cutoff).cast("int").alias("predicted"),
    )
