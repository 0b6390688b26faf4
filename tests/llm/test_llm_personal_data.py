"""Personal data: base spans against Python's own matcher, and what the trees add."""

import hashlib
import re

import numpy as np

from aerolith.llm import pii
from pyspark.sql import functions as F

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def fits(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        doubled = [int(c) if i % 2 == 0 else sum(map(int, str(int(c) * 2))) for i, c in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def expected(text):
    found = [
        (m.start(), i, kind, m.end())
        for i, (kind, rule) in enumerate(RULES.items())
        for m in re.finditer(rule, text or "") if fits(kind, m.group())
    ]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


def base_is_right(rows, texts):
    for row in rows:
        want = expected(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), row.doc_id
        counts = [row.n_email, row.n_ip, row.n_card, row.n_phone]
        assert counts == [sum(w.startswith(kind) for w in want) for kind in RULES]
        assert set(want) <= set(row.spans.split(",")) or not want


def test_whole_table_against_matcher(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    base_is_right(pii.span_report(docs).collect(), texts)


def test_hard_texts(spark):
    pieces = [
        "a@b.com", "x@y.com_foo@z.org", "a@b.c@d.e", "a@b", "@b.com", "é@b.com", "😀 me@ex.org 😀", "a..b@c-d.e-f.g.",
        "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.02.3.4", "12.3.4", "999.1.2.3.4", "1.2.3.4.", "١.2.3.4",
        "4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1111", "4111  1111 1111 1111", "41111111111111111111111",
        "5 4111111111111111", "1234567890123", "4111.1111.1111.1111", "378282246310005", "6011 0009 9013 9424 1",
        "+1 (743) 555-3824", "+12 3", "+1234567890123456", "++4930123456", "+49 30 / 1234", "+1.800.555.0100.", "+1 ( 23",
    ]
    rnd = np.random.default_rng(1)
    texts = {i: p for i, p in enumerate(pieces)}
    for i in range(300):
        glue = rnd.choice(["", " ", ".", "-", "@", "+", "1", "\n", "é"], 12)
        texts[1000 + i] = "".join(str(p) + g for p, g in zip(rnd.choice(pieces, 12), glue))
    letters = list("19.@+- (a_%")
    for i in range(300):
        texts[2000 + i] = "".join(rnd.choice(letters, 60))
    texts[3000] = "1" * 20_000 + " " + "a" * 20_000 + "@"
    texts[3001] = "a@b" + ".c" * 50_000
    texts[3002] = " ".join(f"u{i}@mail.example 10.0.{i % 256}.7" for i in range(3000))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(8)
    base_is_right(pii.span_report(docs).collect(), texts)


def test_odd_rows(spark, odd_docs):
    got = pii.span_report(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert {r.spans for r in got} == {""} and {r.n_phone for r in got} == {0}
    assert pii.span_report(odd_docs.limit(0)).collect() == []


def written(i):
    """Texts with one piece of personal data each, and numbers that are none."""
    rnd = np.random.default_rng(i)
    tail = "".join(map(str, rnd.integers(0, 10, 4)))
    kind = i % 4
    if kind == 0:
        return f"please call +1 ({rnd.integers(200, 999)}) 555-{tail} today"
    if kind == 1:
        body = "4" + "".join(map(str, rnd.integers(0, 10, 14)))
        check = next(c for c in "0123456789" if fits("card", body + c))
        return f"paid with card {body[:4]} {body[4:8]} {body[8:12]} {body[12:]}{check} there"
    if kind == 2:
        return f"mail me at user{tail}@mail{i}.example.com or not"
    return f"invoice 2{tail}{tail}{tail}{tail[:3]}7 of the year, order no. {tail} {tail}"


def test_trees_add_other_formats_and_no_decoys(spark):
    rows = [(i, written(i)) for i in range(1600)]
    new = {
        5000: ("please call 1 (743) 555-3824 today", "phone:12:28"),
        5001: ("paid with card 4111.1111.1111.1111 there", "card:15:34"),
        5002: ("mail me at ann[at]mail.example.com or not", "email:11:34"),
        5003: ("invoice 4111111111111112 of the year", None),
        5004: ("order no. 5550 1234", None),
    }
    docs = spark.createDataFrame(rows + [(i, t) for i, (t, _) in new.items()], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.span_report(docs).collect()}
    for i, (_, span) in new.items():
        assert got[i] == (span or ""), i
    assert all(got[i] == ",".join(expected(t)) for i, t in rows)


def test_columns_score_as_the_trees_do(spark):
    rnd = np.random.default_rng(3)
    x = rnd.integers(0, 20, (200, len(pii.FEATURES)))
    yes = ((x[:, 0] > 9) ^ (x[:, 3] > 4)).astype(float)
    trees = pii.boost(x, yes, 1 - yes)
    model = pii.Model({2: trees}, {2: 0.25})
    want = model.margin(2, x)
    assert ((want + 0.25 > 0) == (yes > 0)).mean() > 0.95
    rows = spark.createDataFrame([(i, (2, r.tolist())) for i, r in enumerate(x)], "i long, c struct<kind:int,features:array<int>>")
    got = {r.i: r.m for r in rows.select("i", model.margin_of(F.col("c")).alias("m")).collect()}
    assert np.allclose([got[i] for i in range(200)], want)
    assert rows.limit(1).select(pii.Model({1: trees}, {1: 0.0}).margin_of(F.col("c")).alias("m")).first().m is None


def test_threshold_is_the_exact_bound():
    yes, no = np.array([40.0, 30.0, 1.0]), np.array([0.0, 1.0, 90.0])
    assert pii.threshold(np.array([3.0, 2.0, 1.0]), yes, no) == 2.0
    assert pii.threshold(np.array([3.0]), np.array([20.0]), np.array([0.0])) is None
    assert abs(pii.at_most_chance(1, 10, 0.1) - (0.9**10 + 10 * 0.1 * 0.9**9)) < 1e-12


def test_no_python_in_the_plan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = pii.document_spans(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Exchange" not in plan


def test_redacted_texts(spark):
    new = ["no data", "", None, "é 😀 a@b.com, 1.2.3.4 and +1 (743) 555-3824!", "mail ann[at]mail.example.com now", "+4111111111111111 x"]
    rows = [(i, written(i), "en") for i in range(1600)] + [(9000 + i, t, None) for i, t in enumerate(new)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `held.out` string")
    out = pii.redacted(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert [got[9000 + i] for i in range(5)] == ["no data", "", None, "é 😀 [EMAIL], [IP] and [PHONE]!", "mail [EMAIL] now"]
    # A card number behind a plus is no phone number: 16 digits are too many.
    assert got[9005] == "+[CARD] x"
    assert got[0] == "please call [PHONE] today" and got[1] == "paid with card [CARD] there"


def test_all_patterns_are_learnt_from_beyond_the_driver_bound(spark):
    rows = [(i, written(i)) for i in range(1600)] + [(5000, "please call 1 (743) 555-3824 today")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.document_spans(docs).cache()
    whole = pii.fit(found)
    spread = pii.fit(found, patterns=5)
    assert sorted(spread.trees) == sorted(whole.trees) and sorted(spread.cutoffs) == sorted(whole.cutoffs)
    for kind, cutoff in whole.cutoffs.items():
        assert abs(spread.cutoffs[kind] - cutoff) < 1e-6
    margins = lambda model: {
        (r.doc_id, r.start, r.kind): r.m
        for r in found.select("doc_id", F.inline("candidates"))
        .select("doc_id", "start", "kind", model.margin_of(F.struct("kind", "features")).alias("m")).collect()
    }
    want, got = margins(whole), margins(spread)
    assert want.keys() == got.keys()
    assert all((want[k] is None and got[k] is None) or abs(want[k] - got[k]) < 1e-6 for k in want)
