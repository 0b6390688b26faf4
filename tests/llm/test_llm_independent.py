"""Toxicity scores and quality verdicts worked out again by plain code of another kind."""

import math
import re

import numpy as np

from aerolith.llm import quality, toxicity
from pyspark.sql import functions as F


def plain_paths(text, entries):
    """Weight per path, clause by clause, with flags instead of machines."""
    sums = {}
    words_read = 0
    clauses, clause = [], []
    for token in re.findall(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;:\n]+", (text or "").lower()):
        words_read += 1
        if token[0] in ".!?;:\n":
            clauses.append(clause)
            clause = []
        else:
            clause.append(token)
    for clause in [*clauses, clause]:
        aimed = said = False
        scope = 0
        for word in clause:
            weight = max([entries.get("=" + word, 0.0), *(entries.get(word[:n], 0.0) for n in range(3, 9) if len(word) >= n)])
            kind = None
            if word in toxicity.TARGETS or word in toxicity.NEGATIONS or word in toxicity.REPORTED:
                pass
            elif weight > 0:
                kind = "insult" if weight >= 3.0 else "slight"
            elif word in toxicity.THREATS:
                kind, weight = "threat", 1.0
            if kind:
                marks = [kind] + ["aimed"] * aimed + ["reported"] * said + ["negated"] * (scope > 0)
                sums[tuple(marks)] = sums.get(tuple(marks), 0.0) + weight
            last_of = {w: k for k in ("TARGETS", "NEGATIONS", "REPORTED") for w in getattr(toxicity, k)}
            role = last_of.get(word)
            aimed |= role == "TARGETS"
            said |= role == "REPORTED"
            scope = 3 if role == "NEGATIONS" else max(scope - 1, 0)
    return sums, words_read


def plain_score(text, model):
    sums, words = plain_paths(text, model.entries)
    paths = sorted(toxicity.PATHS)
    x = [1.0] + [math.log1p(sums.get(p, 0.0)) for p in paths]
    for kind in ("insult", "slight"):
        x.append(math.log1p(100 * sum(v for p, v in sums.items() if kind in p) / max(words, 20)))
    total = sum(a * b for a, b in zip(x, model.weights))
    return 1 / (1 + math.exp(-min(max(total, -30), 30)))


def test_scores_against_plain_code(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    # Entries of every strength, whole words and beginnings, whatever this small table taught.
    model.entries.update({"=idiot": 4.0, "stup": 3.5, "=fool": 1.5, "lou": 0.7})
    model.weights = np.linspace(-3, 2, len(model.weights))
    more = [
        "You are an idiot.", "He said you are a stupid fool; nobody knows", "not a stupid idiot. I will kill you!", "", None,
        "Don't you fool, loud and lousy: idiot\nkill them never stupid stupid stupid stupid", "l'idiot n'est pas stupide",
    ]
    extra = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(more)], "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(extra)
    texts = {r.doc_id: r.text for r in every.collect()}
    got = {r.doc_id: r.score for r in toxicity.score_documents(every, model).collect()}
    assert got.keys() == texts.keys()
    for doc_id, text in texts.items():
        assert math.isclose(got[doc_id], plain_score(text, model), rel_tol=1e-9), doc_id
    kept = {r.doc_id for r in toxicity.drop_toxic(every, model, 0.5).collect()}
    assert kept == {i for i, t in texts.items() if plain_score(t, model) < 0.5}


def chance(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_verdicts_against_plain_code(spark):
    """Two languages and rows without one; symbols tell bad documents in the first alone."""
    rnd = np.random.default_rng(4)
    docs, labels = [], []
    for i in range(5200):
        lang = ("en", "de", None, "")[0 if i < 3000 else 1 if i < 5000 else 2 + i % 2]
        good = i % 10 < 7
        words = [f"w{x}" for x in rnd.permutation(2000)[: 60 + i % 20]]
        for _ in range(0 if good and lang != "de" else int(rnd.integers(0, 40))):
            words.append("###")
        docs.append((i, " ".join(words), lang))
        if i % 11:
            labels.append((i, int(good)))
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    report = quality.quality_report(frame, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(report) == len(docs)

    verdict = dict(labels)
    rules = {
        "symbols": (lambda r: r.n_symbols / r.n_words, [1.0, 0.7, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05]),
        "capitals": (lambda r: r.n_capitals / r.n_words, [0.9, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1]),
        "repeats": (lambda r: r.n_repeat_words / r.n_words, [0.48, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15]),
        "duplicate_lines": (lambda r: r.n_dup_lines / r.n_lines, [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3]),
        "word_length": (lambda r: r.word_chars / r.n_words, [40.0, 30.0, 20.0, 15.0, 12.0, 10.0]),
    }
    lang_of = {i: lang for i, _, lang in docs}
    strata = {}
    for r in report:
        strata.setdefault(lang_of[r.doc_id], []).append(r)
    cutoffs = {}
    for lang, rows in strata.items():
        judged = [r for r in rows if r.doc_id in verdict and not r.base_failed]
        n, m = (sum(verdict[r.doc_id] == v for r in judged) for v in (1, 0))
        for name, (figure, grid) in rules.items():
            best = None
            for cut in grid:
                false = sum(figure(r) > cut and verdict[r.doc_id] == 1 for r in judged)
                true = sum(figure(r) > cut and verdict[r.doc_id] == 0 for r in judged)
                if true and n and false < n * 0.01 and chance(false, n, 0.01) <= 0.05 / (len(strata) * len(rules)):
                    gain = true / m - 50 * false / n
                    if best is None or gain > best[0]:
                        best = (gain, cut)
            if best:
                cutoffs[lang, name] = best[1]
    assert ("en", "symbols") in cutoffs and (None, "symbols") not in cutoffs
    for r in report:
        base = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        hit = any(figure(r) > cutoffs.get((lang_of[r.doc_id], name), math.inf) for name, (figure, _) in rules.items())
        assert (r.base_failed, r.kept) == (base, not base and not hit), r


def test_null_and_empty_languages_are_apart(spark):
    rows = spark.createDataFrame([(1, "a", None), (2, "a", ""), (3, "a", "en")], "doc_id long, text string, lang string")
    strata = {r.doc_id: r.stratum for r in quality.document_figures(rows).collect()}
    assert len(set(strata.values())) == 3
    assert rows.select(quality.stratum_of(F.col("lang")).alias("s")).filter("s IS NULL").count() == 0
