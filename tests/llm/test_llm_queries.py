"""The registered corpus queries: against SQL where there is some, else against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

import corpus_pipeline
from aerolith.llm import mixing, quality, toxicity
from aerolith.llm.queries import ORACLES, QUERIES, tokenizer_path
from compare import connect, differences


def read(sf_dir, name):
    return pq.read_table(f"{sf_dir}/{name}.parquet").to_pylist()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf_dir, name):
    assert differences(connect(sf_dir), QUERIES[name](spark, sf_dir), ORACLES[name]) is None


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(items):
    """doc_id to smallest doc_id reachable, from (doc_id, fingerprint) pairs."""
    leader = {d: d for d, _ in items}

    def find(d):
        while leader[d] != d:
            d = leader[d]
        return d

    for i, (a, x) in enumerate(items):
        for b, y in items[:i]:
            if (x ^ y).bit_count() <= 2:
                low, high = sorted((find(a), find(b)))
                leader[high] = low
    return {d: find(d) for d, _ in items}


def test_simhash_brute_force(spark, sf_dir):
    items = [(d["doc_id"], brute_fingerprint(d["text"])) for d in read(sf_dir, "documents")]
    roots = brute_components(items)
    got = {tuple(r) for r in QUERIES["op3_simhash"](spark, sf_dir).collect()}
    assert got == {(d, f"{f:016x}", roots[d]) for d, f in items}


def test_packing_round_trip(spark, sf_dir):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = QUERIES["op6_packing"](spark, sf_dir).collect()
    got = {(r["doc_id"], r["piece"]): r for r in rows}
    assert len(got) == len(rows)
    for d in read(sf_dir, "documents"):
        ids = tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            row, part = got.pop((d["doc_id"], piece)), ids[at : at + 4096]
            assert (row["start"], row["length"]) == (at, len(part))
            assert row["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    assert not got
    check_gapless(rows)
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= -(-total // 4096) + 1


def check_gapless(rows):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096


def test_neighbours_recall(spark, sf_dir):
    rows = read(sf_dir, "embeddings")
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], float)
    got = defaultdict(list)
    for r in QUERIES["op7_neighbours"](spark, sf_dir).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    found = wanted = 0
    for i in np.flatnonzero(ids % 20 == 0):
        exact = x @ x[i]
        exact[i] = -np.inf
        best = ids[np.lexsort((ids, -exact))[:20]]
        mine = got[ids[i]]
        assert mine == sorted(mine, key=lambda p: (-p[1], p[0]))
        assert all(abs(s - exact[ids == v][0]) < 1e-12 for v, s in mine)
        found, wanted = found + len(set(best) & {v for v, _ in mine}), wanted + len(best)
    assert found / wanted >= 0.9


def brute_figures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = list(zip(words, words[1:], words[2:]))
    counts = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


def test_quality_brute_force(spark, sf_dir):
    texts = {d["doc_id"]: d["text"] for d in read(sf_dir, "documents")}
    rows = QUERIES["op9_quality"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, chars, symbols, lines, repeats = brute_figures(texts[r["doc_id"]])
        figures = r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]
        assert figures == (n, chars, symbols, lines, repeats)
        assert r["base_failed"] == (n < 50 or 100 * repeats > 50 * n)
        assert not (r["base_failed"] and r["kept"])


def test_toxicity_held_out(spark):
    sf_dir = "/root/testdata/sf0.1"
    toxic = {r["doc_id"]: r["toxic"] for r in read(sf_dir, "labels")}
    rows = QUERIES["op10_toxicity"](spark, sf_dir).collect()
    assert len(rows) == 10_000
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in toxic]
    caught = [r["predicted"] for r in held if toxic[r["doc_id"]]]
    wrong = [r["predicted"] for r in held if not toxic[r["doc_id"]]]
    assert sum(caught) > 0.6 * len(caught) and sum(wrong) < 0.01 * len(wrong)


def test_licence_lines(spark, sf_dir):
    notices = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only",
    }
    want = Counter(
        (d["doc_id"], notices[line])
        for d in read(sf_dir, "documents") for line in (d["text"] or "").split("\n") if line in notices
    )
    got = Counter((r["doc_id"], r["licence"]) for r in QUERIES["op8_licences"](spark, sf_dir).collect())
    assert want and got == want


def test_pipeline_brute_force(spark, sf_dir):
    """Each stage on its own input, worked out again in plain Python."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")

    model = toxicity.train(docs, labels)
    lexicon = toxicity.Lexicon(model.entries)
    score = lambda d: model.score(toxicity.path_sums(d["text"], lexicon)[None])[0]
    calm = stages["toxicity"](spark, docs, sf_dir).cache()
    want = {d["doc_id"] for d in docs.collect() if score(d) < toxicity.CUTOFF}
    assert {r["doc_id"] for r in calm.collect()} == want and calm.columns == columns

    good = stages["quality rules"](spark, calm, sf_dir).cache()
    kept = {r["doc_id"] for r in quality.quality_report(calm, labels).filter("kept").collect()}
    assert {r["doc_id"] for r in good.collect()} == kept and good.columns == columns

    unlike = stages["simhash near-dedup"](spark, good, sf_dir).cache()
    roots = brute_components([(d["doc_id"], brute_fingerprint(d["text"])) for d in good.collect()])
    assert {r["doc_id"] for r in unlike.collect()} == set(roots.values())
    assert unlike.count() == len(set(roots.values())) and unlike.columns == columns

    mix = stages["mixing to target weights"](spark, unlike, sf_dir).cache()
    times = Counter(r["doc_id"] for r in mix.collect())
    for r in mixing.mix_report(unlike).collect():
        assert abs(times[r["doc_id"]] * r["size"] - r["taken"]) <= r["size"] / 2
    assert mix.columns == columns

    packed = stages["best-fit packing"](spark, mix, sf_dir).collect()
    check_gapless(packed)
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == times
    run = corpus_pipeline.run(spark, sf_dir).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["length"], r["ids_crc32"])
    assert Counter(map(key, run)) == Counter(map(key, packed))
