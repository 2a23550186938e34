import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from salesmart.llm import pair_maxscore as pm
from salesmart.session import settle

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERMS.findall((text or "").translate(LOWER))


def brute(docs, items, best=50):
    held = [(d, Counter(terms(t))) for d, t in docs]
    df = Counter(t for _, c in held for t in c)
    n_docs, n_terms = sum(1 for _, c in held if c), sum(sum(c.values()) for _, c in held)
    out = []
    for item, text in dict.fromkeys(items):
        own, scores = set(terms(text)), []
        for d, c in held:
            m = 50 + 50 * sum(c.values()) * n_docs // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in own & set(c))
            if score > 0:
                scores.append((-score, d is None, d))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, rank, d, -s) for rank, (s, _, d) in enumerate(scores[:best], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, settings=pm.Settings()):
    table = spark.createDataFrame([(*d, "x", "y") for d in docs], "doc_id long, text string, score string, terms string").repartition(3)
    asked = spark.createDataFrame([(*i, "z") for i in items], "item_id long, text string, rank string")
    index = settle(pm.build_index(table, settings), "index")
    return sorted((tuple(r) for r in pm.search(index, asked, settings).collect()), key=str)


def prose(r, n, vocabulary=400):
    return " ".join(f"w{min(int(r.paretovariate(0.6)), vocabulary)}" for _ in range(n))


def test_against_brute_force(spark):
    r = random.Random(5)
    docs = [(i, prose(r, r.randrange(1, 60))) for i in range(400)]
    docs += [(1000 + i, docs[i % 7][1]) for i in range(60)]  # equal scores, more than the heap holds
    items = [(i, prose(r, r.randrange(1, 25))) for i in range(25)] + [(90, docs[3][1]), (91, "w1"), (92, "nowhere"), (93, "W7, w7; w7")]
    want = brute(docs, items)
    for settings in (pm.Settings(segment_bytes=1500), pm.Settings(segment_bytes=1500, pairs=False), pm.Settings(block_bytes=300, lanes=1)):
        assert found(spark, docs, items, settings) == want
    assert found(spark, docs, items, pm.Settings(best=3, segment_bytes=700)) == brute(docs, items, 3)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " .,- "), (None, "apple pie"), (4, "apple pie"), (4, "apple pie"), (5, "Äpfel ÄPFEL äpfel"), (6, "x\0y apple"),
            (7, "apple " * 30_000 + "tart"), (-8, "pie\npie"), (9, "pie"), (10, "9lives apple_pie [tart]")]
    items = [(1, "Apple tart"), (1, "Apple tart"), (1, "pie"), (2, None), (3, ""), (None, "pie äpfel"), (4, "ÄPFEL x"), (5, "9lives {y}"), (6, "!!")]
    for settings in (pm.Settings(), pm.Settings(segment_bytes=1, block_bytes=1, best=2)):
        assert found(spark, docs, items, settings) == brute(docs, items, settings.best)


def test_empty_tables(spark):
    some = [(1, "a b"), (2, "c")]
    assert found(spark, [], some) == found(spark, some, []) == found(spark, [], []) == found(spark, [(1, None)], some) == []


def searched(docs, items, settings):
    """Results and the number of documents whose score was begun, over segments in turn."""
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in docs]), pa.array([t for _, t in docs])], names=["id", "text"])
    rows = list(pm.segments(batch, settings.segment_bytes))
    corpus = pm.Corpus(sum(r["documents"] for r in rows), sum(r["occurrences"] for r in rows))
    queries = pm.Queries.of(items)
    df = sum(np.array([0 if k < 0 else np.diff(np.frombuffer(r["first"], "<i4"))[k] for k in pm._positions(np.frombuffer(r["terms"], "<u8"), queries.terms)])
             for r in rows)
    queries.weights = corpus.weights(df)
    heaps, begun = [pm.Heap(settings.best) for _ in items], 0
    for row in rows:
        segment = pm.Segment(row, queries, corpus, settings.pairs)
        for query, heap in enumerate(heaps):
            docs_, scores, n = segment.search(query, heap.bar)
            heap.add(np.array(row["doc_ids"])[docs_], scores)
            begun += n
    return [list(zip(h.ids.tolist(), h.scores.tolist())) for h in heaps], begun


def test_pairs_skip_more_than_single_terms():
    r = random.Random(11)
    docs = [(i, prose(r, 60, 3000)) for i in range(3000)]
    items = [(i, prose(r, 30, 3000)) for i in range(20)]
    with_pairs, few = searched(docs, items, pm.Settings(best=10, segment_bytes=40_000))
    without, more = searched(docs, items, pm.Settings(best=10, segment_bytes=40_000, pairs=False))
    _, every = searched(docs, items, pm.Settings(best=10**6, segment_bytes=40_000))
    assert with_pairs == without
    assert few < 0.9 * more and more < every


def test_joint_impacts_bound_every_document():
    r = random.Random(13)
    docs = [(i, prose(r, 20, 40)) for i in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in docs]), pa.array([t for _, t in docs])], names=["id", "text"])
    (row,) = pm.segments(batch, 1 << 20)
    corpus = pm.Corpus(row["documents"], row["occurrences"])
    queries = pm.Queries.of([(1, " ".join(f"w{i}" for i in range(1, 30)))])
    at = pm._positions(np.frombuffer(row["terms"], "<u8"), queries.terms)
    queries.weights = corpus.weights(np.where(at >= 0, np.append(np.diff(np.frombuffer(row["first"], "<i4")), 0)[at], 0))
    segment = pm.Segment(row, queries, corpus)
    tighter = 0
    for pair, (inside, joint) in segment.joint.items():
        score = np.zeros(segment.size, np.int64)
        for t in pair:
            score[segment.lists[t][0]] += segment.lists[t][1]
        both = np.intersect1d(segment.lists[pair[0]][0], segment.lists[pair[1]][0])
        assert np.flatnonzero(inside).tolist() == both.tolist() and joint == max(score[both].tolist(), default=0)
        highest = [segment.highest[t] for t in pair]
        assert score.max() <= max(joint, *highest) <= sum(highest)
        tighter += max(joint, *highest) < sum(highest)
    assert tighter > len(segment.joint) / 2


@pytest.mark.parametrize("n, documents, occurrences", [(10**7, 5 * 10**10, 10**13), (3, 7, 11)])
def test_norms_of_any_size(n, documents, occurrences):
    assert pm.Corpus(documents, occurrences).norms(np.array([n])).tolist() == [50 + 50 * n * documents // occurrences]
