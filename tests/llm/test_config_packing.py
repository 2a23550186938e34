import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from salesmart.llm import config_packing as cp
from salesmart.llm import queries

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "a", "It's DON'T i'll", "é É é ́x İstanbul ſ K Σας ΣΑΣ", "x y z\u0085w", "1234 12a3", "!!...,, a.,b ,.a .", "क़ ड़", "<|endoftext|> a<|STARTOFTEXT|>b",
       "日本語 テキスト。中国", "👍🏽 ok", "a\tb\r\nc\x0bd\x0ce\x1cf", "word" * 400, "don't,' ''s 's.", "a_b-c/d@e#f", "naïve, façade; über: straße!"]


def plain(texts):
    encoder = Tokenizer.from_file(VOCABULARY)
    return [np.array(encoder.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


@pytest.mark.parametrize("remembered,chunk_bytes", [(1 << 18, 1 << 20), (20, 1 << 10), (1 << 18, 10)])
def test_tokens_equal_the_tokenizer(remembered, chunk_bytes):
    draw = random.Random(1)
    texts = ODD + [" ".join(draw.choices(" ".join(ODD).split() + ["the", "ing", "Über", "éa."], k=draw.randint(1, 80))) for _ in range(300)]
    texts += ["".join(draw.choices("ab'sİé́ .,!1क़<|>\n", k=30)) for _ in range(500)]
    encoder = cp.Tokens(VOCABULARY, remembered, chunk_bytes)
    for some in (texts, [*texts[::-1], "a\0b", "\0"]):
        assert list(encoder.encode(pa.array(some))) == plain(some)
    assert list(encoder.encode(pa.array([None, "a", None, "<|"]))) == plain(["", "a", "", "<|"])


def test_knapsack_is_optimal():
    draw = np.random.default_rng(3)
    for _ in range(30):
        sizes, values, capacity = draw.integers(1, 12, 4), draw.random(4), int(draw.integers(1, 25))
        counts = cp.knapsack(sizes, values, capacity)
        best = max(values @ np.array(c) for c in np.ndindex(*(capacity // sizes + 1)) if sizes @ np.array(c) <= capacity)
        assert sizes @ counts <= capacity and values @ counts == pytest.approx(best)


@pytest.mark.parametrize("sizes,counts,best", [
    ([50, 30, 20], [100, 100, 100], 100), ([34, 33], [100, 200], 100), ([51, 26, 25, 24], [60, 40, 20, 20], 70), ([60, 40], [10, 1000], 510)])
def test_configurations_cover_near_the_optimum(sizes, counts, best):
    sizes, counts = np.array(sizes), np.array(counts)
    table, copies = cp.configurations(sizes, counts, 100)
    assert (table @ sizes <= 100).all() and (table.T @ copies >= counts * (1 - 1e-9)).all()
    assert copies.sum() <= 1.12 * best


@pytest.mark.parametrize("histogram,capacity,most", [
    ({}, 10, 0), ({10: 5}, 10, 5), ({1: 25}, 10, 3), ({6: 10, 4: 10}, 10, 10), ({3: 9, 4: 9}, 10, 9), ({5: 1}, 10, 1), ({7: 1000, 2: 500, 1: 2000}, 10, 1000),
    ({34: 300, 33: 600}, 100, 300), ({51: 10, 49: 10, 26: 4, 25: 2, 24: 2}, 100, 13),
])
def test_plans(histogram, capacity, most):
    patterns = cp.plan(histogram, capacity)
    held = Counter()
    for p in patterns:
        assert p.copies > 0 and sum(n * k for n, k in p.held.items()) == capacity - p.room and p.room >= 0
        for n, k in p.held.items():
            held[n] += k * p.copies
    assert held == Counter(histogram) and sum(p.copies for p in patterns) <= most


def test_plan_is_near_the_bound_and_bounded():
    draw = np.random.default_rng(7)
    one = Counter(np.clip(draw.lognormal(6.3, 1.1, 20_000).astype(int) + 1, 1, 4096).tolist())
    for times in (1, 1000):
        patterns = cp.plan({n: c * times for n, c in one.items()}, 4096)
        assert sum(p.copies for p in patterns) <= 1.01 * sum(n * c for n, c in one.items()) * times / 4096 + 1
        assert len(patterns) < 20_000


@pytest.mark.parametrize("capacity", [16, 100, 1024, 5002])
def test_plan_never_needs_more_than_best_fit(capacity):
    draw = np.random.default_rng(capacity)
    for n in (1, 30, 3000):
        one = Counter(np.clip(draw.lognormal(np.log(capacity / 4), 0.9, n).astype(int) + 1, 1, capacity).tolist())
        needed = sum(p.copies for p in cp.plan(dict(one), capacity))
        assert needed <= sum(p.copies for p in cp._fill([], dict(one), capacity))


def test_the_program_packs_what_best_fit_does_not():
    histogram = {44: 60, 24: 60, 22: 60, 21: 120, 35: 40, 30: 40}
    best_fit = sum(p.copies for p in cp._fill([], dict(histogram), 100))
    needed = sum(p.copies for p in cp.plan(dict(histogram), 100))
    assert needed < best_fit and sum(p.copies for p in cp.plan(dict(histogram), 100, shares=(0.0,))) == best_fit


def check(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_documents(spark):
    texts = [None, "", "the " * 100, "a b c", "the " * 63, "the " * 64, *["word " * n for n in range(1, 60)]]
    docs = spark.createDataFrame([(i % 50, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, length int").repartition(4)
    rows = cp.pack_documents(docs, VOCABULARY, capacity=64, ids=True).collect()
    want = Counter()
    for i, t in enumerate(texts):
        ids = plain([t or ""])[0] + np.array([1], "<u4").tobytes()
        for k in range(0, len(ids), 256):
            want[i % 50, k // 256, k // 4, len(ids[k:k + 256]) // 4, zlib.crc32(ids[k:k + 256]), ids[k:k + 256]] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in rows) == want
    assert check(rows, 64) <= -(-sum(r.length for r in rows) // 64) + 2
    assert cp.pack_documents(docs.limit(0), VOCABULARY).collect() == []


def test_hot_length(spark):
    docs = spark.range(0, 3000, 1, 6).selectExpr("id AS doc_id", "CASE WHEN id % 3 > 0 THEN 'the the the' ELSE repeat('a ', int(id % 13)) END AS text")
    rows = cp.pack_documents(docs, VOCABULARY, capacity=16).collect()
    assert len(rows) == 3000 and check(rows, 16) <= 1.01 * sum(r.length for r in rows) / 16 + 1


def test_query_over_given_documents(spark):
    rows = queries.op6_config_packing(spark, "/root/testdata/sf0.001").collect()
    assert check(rows, 4096) <= sum(r.length for r in rows) / 4096 * 1.02 + 1
    assert len({(r.doc_id, r.piece) for r in rows}) == len(rows)
