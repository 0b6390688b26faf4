"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import numpy as np
import pytest

from aerolith.llm import chat, licences, mixing, neighbours, packing, quality, simhash, toxicity, urls, warc
from aerolith.llm.queries import tokenizer_path
from pyspark.sql import functions as F


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Chat -------------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, n long, segment string"


def turns(spark, data):
    return spark.createDataFrame([(*d, None, "clash") for d in data], TURNS)


def test_snapshots_collapse(spark):
    data = [(1, 0, "u", "a"), (2, 0, "u", "a"), (2, 1, "b", "c"), (2, 1, "b", "c")]  # 1 begins 2
    data += [(3, 0, "u", "a"), (3, 1, "b", "c")]  # equals 2
    data += [(4, 0, "u", "a"), (4, 1, "b", "d"), (None, None, None, None), (5, 0, "u", ""), (6, 0, "u", None)]
    out = rows(chat.collapse_snapshots(turns(spark, data)).select("conv_id", "n_messages", "n_copies", "text"))
    assert [r[:3] for r in out] == [(2, 2, 2), (4, 2, 1), (5, 1, 1), (6, 1, 1), (None, 1, 1)]
    assert out[0][3] == "<|im_start|>u\na<|im_end|>\n<|im_start|>b\nc<|im_end|>\n"


def test_long_conversations_go_on_in_segments(spark):
    data = [(1, i, "u", str(i)) for i in range(10)] + [(2, i, "u", str(i)) for i in range(7)]
    out = chat.collapse_snapshots(turns(spark, data), turns_per_row=4)
    assert rows(out.select("conv_id", "segment", "n_messages")) == [(1, 0, 10), (1, 1, 10), (1, 2, 10)]
    assert chat.collapse_snapshots(turns(spark, [])).count() == 0


# WARC -------------------------------------------------------------------------------------------


def test_archive_odd_pages(spark):
    data = [(1, "http://A.b.com:80/x#y", "p"), (2, "http://a.b.com/x", "p"), (2, None, "p"), (3, "no url\n", None),
            (None, "http://a.b.com/x", "p"), (4, "", ""), (5, "http://a.b.com/x", "é" * 100_000), (5, "http://a.b.com/x", "é" * 100_000)]
    pages = spark.createDataFrame([(*d, "clash") for d in data], "page_id long, url string, html string, sha1 string")
    out = rows(warc.archive_and_read(pages, shards=3, with_payload=True))
    assert [(r[0], r[1], r[3], r[4]) for r in out] == [
        (1, 1, "revisit", 2), (2, 1, "response", None), (2, 1, "response", None), (3, 0, "revisit", 4),
        (4, 0, "response", None), (5, 200_000, "response", None), (5, 200_000, "response", None),
        (None, 1, "revisit", 2)]
    assert out[5][5] == ("é" * 100_000).encode() and out[0][5] is None
    assert warc.archive_and_read(pages.limit(0)).count() == 0


def test_index_blocks(spark, path):
    entries = spark.createDataFrame(
        [(f"com,x)/{i // 3:03d}", i, "f", i, 1) for i in range(300)] + [("com,x)/050", 150, "f", 999, 1)], warc.ENTRY
    )
    shards = warc.build_index(entries, path("index"), shards=4, block_entries=7)
    assert 1 < len(shards) <= 4
    keys = spark.createDataFrame([("com,x)/050", 150), ("com,x)/000", 0), ("com,x)/000", 9), ("zzz", 1), ("", 1), ("com,x)/099", 299)], "surt string, id long")
    found = rows(warc.look_up(keys, shards).select("id", "offset"))
    assert found == [(0, 0), (150, 150), (150, 999), (299, 299)]
    assert warc.look_up(entries.select("surt", "id"), shards).count() == 301


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "v", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    out = rows(warc.archive_and_read(pages, least_payload=3))
    assert [(r[0], r[3], r[4]) for r in out] == [(1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None)]


# SimHash ----------------------------------------------------------------------------------------


def test_bk_tree_finds_all_within():
    rng = np.random.default_rng(1)
    values = list({int(v) for v in rng.integers(0, 1 << 12, 400)})
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for v in values[:50]:
        assert sorted(tree.values[i] for i in tree.within(v, 2)) == sorted(u for u in values if (u ^ v).bit_count() <= 2)


@pytest.mark.parametrize("limit", [2, 4096])
def test_links_survive_shards_that_are_dealt_again(spark, limit):
    """A dense group of fingerprints around one centre, with every shard over its limit."""
    rng = np.random.default_rng(2)
    values = {0x0123456789ABCDEF ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for _ in range(150)}
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long")
    links = simhash.linked(nodes, shard_limit=limit)
    roots = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    leader = {v: v for v in signed}

    def find(v):
        while leader[v] != v:
            v = leader[v]
        return v

    for a in signed:
        for b in signed:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 2 and find(a) != find(b):
                leader[max(find(a), find(b))] = min(find(a), find(b))
    assert {v: roots.get(v, v) for v in signed} == {v: find(v) for v in signed}


def test_components_of_a_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(1, 200 + i) for i in range(300)]
    found = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    below = {node: root for node, root in found.items() if node != root}
    assert below == {**{i: 100 for i in range(101, 161)}, **{200 + i: 1 for i in range(300)}}


def test_near_duplicates_of_odd_rows(spark, odd_docs):
    out = rows(simhash.near_duplicates(odd_docs).select("doc_id", "component_id"))
    assert out == sorted([(1, 1), (1, 1), (2, 1), (3, 3), (4, 3), (None, None), (None, None), (None, 3), (5, 5), (6, 3), (7, 7)], key=repr)
    kept = simhash.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    assert rows(kept.select("doc_id")) == [(1,), (3,), (5,), (7,), (None,)]
    assert simhash.keep_first(odd_docs.limit(0)).count() == 0


# Mixing -----------------------------------------------------------------------------------------


def test_mix_of_odd_rows(spark, odd_docs):
    report = mixing.mix_report(odd_docs)
    found = report.collect()
    assert len(found) == odd_docs.count()
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in found)
    assert sum(r["taken"] for r in found) == pytest.approx(1.5 * sum(r["size"] for r in found), abs=5)
    assert rows(report) == rows(mixing.mix_report(odd_docs.repartition(5)))
    assert mixing.repeat_documents(odd_docs).columns == odd_docs.columns
    assert mixing.mix_report(odd_docs.limit(0)).count() == 0
    finishes = [r["virtual_finish"] for r in mixing.mixed(odd_docs).collect()]
    assert finishes == sorted(finishes)


def test_targets_stop_at_twice_the_source(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 100), (None, 0)], "source string, size long")
    found = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    assert found == {"a": 20.0, "b": pytest.approx(295 / 3), "c": pytest.approx(2 * 295 / 3), None: 0.0}


# Packing ----------------------------------------------------------------------------------------


def test_packing_of_odd_rows(spark, odd_docs):
    out = packing.pack_documents(odd_docs, tokenizer_path(), with_ids=True).collect()
    assert all(len(r["ids"]) == r["length"] for r in out)
    assert sum(r["piece"] == 0 for r in out) == odd_docs.count()
    assert sum(r["length"] == 1 for r in out) == 4
    assert packing.pack_documents(odd_docs.limit(0), tokenizer_path()).count() == 0


def test_chunks_give_the_whole_text_ids():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    words = packing.WordIds(tokenizer)
    for text in ["", "don't. we'll, i.e., A.B.", "a\x01b c, d.", "Σ. ΑΣ, ΣΑΣ", "x　y z\x85q", "12, x1. ,, ... é́. 漢字 ﬁ", "AND&&& İ. I\u0307 A\u030a x'S a's! b\x01c _d_ e_ f'' don'T"]:
        want = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert words.text_ids(text.encode()) == want


def test_plans_use_all_pieces_and_no_more_bins_than_best_fit():
    rng = np.random.default_rng(3)
    for capacity in (10, 37, 100):
        for _ in range(60):
            lengths, times = rng.integers(1, capacity + 1, 12), rng.integers(1, 30, 12)
            counts = {}
            for length, n in zip(lengths.tolist(), times.tolist()):
                counts[length] = counts.get(length, 0) + n
            plan = packing.pack_counts(counts, capacity)
            used = {}
            for bins, inside in plan:
                assert sum(length * n for length, n in inside) <= capacity
                for length, n in inside:
                    used[length] = used.get(length, 0) + bins * n
            assert used == counts
            assert sum(b for b, _ in plan) <= sum(b for b, _ in packing.best_fit(counts, capacity))


def test_reduction_keeps_the_optimum():
    """Small instances against an exhaustive search."""
    from functools import cache

    rng = np.random.default_rng(4)

    def optimum(items, capacity):
        @cache
        def least(left):
            if not left:
                return 0
            first, rest, best = left[0], left[1:], len(left)
            for mask in range(1 << len(rest)):
                if first + sum(x for i, x in enumerate(rest) if mask >> i & 1) <= capacity:
                    best = min(best, 1 + least(tuple(x for i, x in enumerate(rest) if not mask >> i & 1)))
            return best

        return least(tuple(sorted(items, reverse=True)))

    for _ in range(60):
        items = rng.integers(1, 21, 8).tolist()
        counts = {x: items.count(x) for x in set(items)}
        fixed, left = packing.reduce_by_dominance(counts, 20)
        rest = [x for x, n in left.items() for _ in range(n)]
        assert sum(b for b, _ in fixed) + optimum(rest, 20) == optimum(items, 20)


# Neighbours -------------------------------------------------------------------------------------


def test_neighbours_exact_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(400, 4)) * rng.uniform(0.2, 3, (400, 1)), 1)
    x[100:160] = x[7]
    x[300] = 0
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [(500, None), (501, [1.0, None, 0.0, 0.0]), (502, [float("nan")] * 4), (503, [float("inf")] * 4), (None, [1.0] * 4)]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    queries = vectors.filter("vec_id % 20 = 0")
    kwargs = dict(k=5, factor=1.0, shards_deep=2, shard_rows=60, query_rows=4)
    got = rows(neighbours.nearest(vectors, queries, **kwargs).select("query_id", "rank", "vec_id"))
    want = []
    for i in [q for q in range(0, 400, 20) if q != 300]:
        score = (x * x[i]).sum(axis=1)
        score[[i, 300]] = -np.inf
        want += [(i, r + 1, int(j)) for r, j in enumerate(np.lexsort((np.arange(400), -score))[:5])]
    assert got == sorted(want, key=repr)
    few = vectors.filter("vec_id IN (0, 1, 2)")
    assert neighbours.nearest(few, few.filter("vec_id = 0")).count() == 2
    assert neighbours.nearest(vectors.limit(0), queries).count() == 0
    assert neighbours.nearest(vectors, queries.limit(0)).count() == 0


# Licences ---------------------------------------------------------------------------------------


def test_licence_rules_in_order(spark, odd_docs):
    s = licences.SENTENCES
    mit = f"{s['mit-grant']}:\n\n{s['mit-notice']}.\n\n{s['as-is'].lower()}.".replace("copy, ", "copy,\n  ")
    scanner = licences.Scanner(s, licences.RULES, licences.MAX_GAP)
    names = lambda text: [m[0] for m in scanner.scan_text(text)]
    assert names("Foo. " + mit + " bar") == ["MIT"] and scanner.scan_text(mit)[0][2] == 3
    assert names(s["mit-grant"] + ":\n" + "x. " * 9 + s["as-is"] + ".") == ["MIT"]  # too far: the grant alone
    assert names(mit + "\n" + mit) == ["MIT", "MIT"]
    assert names("It is not Released under the MIT License.") == []
    assert names(f"Licensed under CC BY 4.0. {s['named-mit']}!") == ["CC-BY-4.0", "MIT"]
    start, end = scanner.scan_text("Ü. " + s["named-mit"])[0][3:]
    assert ("Ü. " + s["named-mit"])[start:end].strip() == s["named-mit"]
    assert licences.scan_licences(odd_docs).count() == 0 == licences.scan_licences(odd_docs.limit(0)).count()


# Quality ----------------------------------------------------------------------------------------


def test_quality_of_odd_rows(spark, odd_docs, labels):
    report = quality.quality_report(odd_docs, labels)
    out = {r["doc_id"]: r for r in report.collect()}
    assert report.count() == odd_docs.count()
    assert out[1]["kept"] and out[5]["base_failed"] and out[5]["n_repeat_words"] == 15_000
    assert out[6]["n_words"] == 0 and out[7]["base_failed"]
    kept = quality.keep_good(odd_docs, labels)
    assert kept.columns == odd_docs.columns and rows(kept.select("doc_id")) == [(1,), (1,), (2,)]
    assert quality.quality_report(odd_docs.limit(0), labels.limit(0)).count() == 0


def test_binomial_tail_is_exact(spark):
    from math import comb

    cases = [(0, 1), (0, 2000), (9, 2000), (19, 2000), (3, 500), (0, 0)]
    frame = spark.createDataFrame(cases, "k long, n long")
    got = [r[0] for r in frame.select(quality.binomial_at_most(F.col("k"), F.col("n"), 0.01)).collect()]
    for (k, n), p in zip(cases, got):
        want = sum(comb(n, i) * 0.01**i * 0.99 ** (n - i) for i in range(k + 1)) if k < n * 0.01 else 1.0
        assert p == pytest.approx(want, rel=1e-9)


def test_cutoffs_hold_back_good_documents(spark):
    """Enough labels: a clear rule is used. Too few: it is off."""
    good = " ".join(f"a{i}" for i in range(60))
    bad = good + " ###" * 40 + " x"
    def judged(n):
        docs = [(i, good, "en") for i in range(n)] + [(n + i, bad.replace("a1 ", f"b{i} "), "en") for i in range(50)]
        labelled = [(i, int(i < n)) for i in range(n + 50)]
        return quality.choose_cutoffs(
            quality.document_figures(spark.createDataFrame(docs, "doc_id long, text string, lang string")),
            spark.createDataFrame(labelled, "doc_id long, quality int"),
        ).collect()
    assert judged(100) == []
    assert [r["symbols"] for r in judged(800)] == [1.0]


# Toxicity ---------------------------------------------------------------------------------------


def test_grammar_follows_context():
    lexicon = toxicity.Lexicon({"=idiot": 4.0})
    path = lambda text: {p: v for p, v in zip(toxicity.PATHS, toxicity.path_sums(text, lexicon)) if v}
    assert path("An idiot.") == {("insult",): 4.0}
    assert path("You idiot") == {("insult", "aimed"): 4.0}
    assert path("They said you are not an idiot") == {("insult", "aimed", "reported", "negated"): 4.0}
    assert path("not here. an idiot") == {("insult",): 4.0}  # a negation ends with its clause
    assert path("not a very very long idiot") == {("insult",): 4.0}  # and after three words
    assert path("I will kill") == {("threat",): 1.0} and path(None) == path("") == {}


def test_toxicity_of_odd_rows(spark, odd_docs, labels):
    out = toxicity.flag_toxic(odd_docs, labels)
    assert out.count() == odd_docs.count()
    assert all(0 <= r["score"] <= 1 for r in out.collect())
    model = toxicity.train(odd_docs.limit(0), labels.limit(0))
    assert toxicity.drop_toxic(odd_docs, model).columns == odd_docs.columns
    assert toxicity.drop_toxic(odd_docs, model).count() == odd_docs.count()
    assert toxicity.score_documents(odd_docs.limit(0), model).count() == 0


# URLs -------------------------------------------------------------------------------------------


def test_entries_hold_from_their_day_to_the_next(spark):
    from datetime import date

    day = lambda n: date(2024, 1, n)
    entries = spark.createDataFrame(
        [("l", "domain", "bad.com", day(5), "add"), ("l", "domain", "bad.com", day(10), "remove"),
         ("l", "domain", "bad.com", day(20), "add"), ("l", "domain", "bad.com", day(20), "remove"),
         ("k", "host", "a.bad.com", day(7), "add"), ("k", "host", "a.bad.com", day(7), "add"),
         (None, "host", "x", day(1), "add"), ("l", "host", "bad.com", None, "add")],
        "list string, scope string, key string, day date, action string",
    )
    data = [(n, "https://u@A.BAD.com.:8080/p", day(n)) for n in (4, 5, 7, 9, 10, 19, 20)]
    data += [(30, "http://b.bad.com/", day(9)), (31, "http://notbad.com/", day(9)), (32, None, day(9)), (33, "http://bad.com", None), (34, "junk", day(9)), (None, "http://bad.com?q", day(9)), (30, "http://b.bad.com/", day(9))]
    captures = spark.createDataFrame([(*d, "clash") for d in data], "page_id long, url string, fetch_date date, host string")
    out = urls.filter_captures(captures, entries)
    assert out.count() == len(data)
    hits = {r["page_id"]: (r["list"], r["key"]) for r in out.filter("blocked").collect()}
    own, parent = ("k", "a.bad.com"), ("l", "bad.com")
    assert hits == {5: parent, 7: own, 9: own, 10: own, 19: own, 20: own, 30: parent, None: parent}
    assert out.filter("page_id = 33 OR page_id = 34").filter("blocked").count() == 0
    assert urls.filter_captures(captures.limit(0), entries.limit(0)).count() == 0


def test_hosts_of_any_length_have_parents(spark):
    long = "x." * 130 + "bad.com"
    urls_ = [
        f"http://{long}/", " http://y.bad.com\\z", "\thttp://user@BAD.com.:80/a\n", "//bad.com/", "http://good.com/\\bad.com",
        "http://" + "a." * 50_000 + "bad.com", None,
    ]
    captures = spark.createDataFrame([(i, u, "2024-05-01") for i, u in enumerate(urls_)], "page_id long, url string, day string")
    captures = captures.select("page_id", "url", F.to_date("day").alias("fetch_date"))
    entries = spark.createDataFrame([("l", "domain", "bad.com", "2024-01-01", "add")], "list string, scope string, key string, d string, action string")
    entries = entries.select("list", "scope", "key", F.to_date("d").alias("day"), "action")
    got = {r.page_id: (r.blocked, r.host) for r in urls.filter_captures(captures, entries).collect()}
    assert {i: b for i, (b, _) in got.items()} == {0: True, 1: True, 2: True, 3: False, 4: False, 5: True, 6: False}
    assert got[1][1] == "y.bad.com" and got[3][1] is None and got[0][1] == long


def test_archive_paths_of_spark_are_those_of_arrow():
    system, inside = warc._file_system("s3a://bucket/folder/file?region=eu-west-1")
    assert type(system).__name__ == "S3FileSystem" and inside == "bucket/folder/file"
    assert type(warc._file_system("file:///tmp/x")[0]).__name__ == "LocalFileSystem"
