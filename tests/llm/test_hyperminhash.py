import random

import numpy as np
import pyarrow as pa
import pytest

from salesmart.llm import hyperminhash as hm

VOCABULARY = ["".join(random.Random(i).choices("abcdefghijklmnop", k=6)) for i in range(4000)]


def shingles(text):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in (text or "").translate(dict.fromkeys([9, 10, 11, 12, 13], 32)).split(" ") if w]
    return {tuple(words[i:i + 4]) for i in range(len(words) - 3)} if len(words) >= 4 else {tuple(words)} if words else set()


def brute(rows):
    """(id, set size, component) of (id, text) rows, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    low = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            low[root(i)] = min(low.get(root(i), name), name)
    return sorted((str(name), len(sets[i]), str(low.get(root(i)) if sets[i] else name)) for i, (name, _) in enumerate(rows))


def found(spark, rows, settings=hm.Settings()):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in hm.near_duplicates(docs, settings).collect())


def edited(words, n, r):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = r.choice(VOCABULARY)
    return words


@pytest.mark.parametrize("hub_rounds", [2, 1])
def test_components_equal_brute_force(spark, hub_rounds):
    r = random.Random(6)
    rows, n = [], 0
    for length in (1, 2, 3, 4, 5, 6, 8, 12, 20, 40, 80, 150, 300):
        for _ in range(4):
            base = r.choices(VOCABULARY, k=length)
            for _ in range(r.randint(1, 6)):
                copy = edited(base, r.choice([0, 0, 1, max(1, length // 60), max(1, length // 35)]), r)
                rows.append((n, ("  " if r.random() < 0.3 else "\n").join(w.upper() if r.random() < 0.2 else w for w in copy)))
                n += 1
    r.shuffle(rows)
    assert found(spark, rows, hm.Settings(hub_rounds=hub_rounds)) == brute(rows)


def test_a_large_group_of_copies_of_copies(spark):
    """Edits add up along a chain: ends are not linked with each other, only through what lies between."""
    r = random.Random(7)
    words, rows = r.choices(VOCABULARY, k=120), []
    for i in range(150):
        words = edited(words, 2, r)
        rows.append((i, " ".join(words)))
    base = r.choices(VOCABULARY, k=120)
    rows += [(1000 + i, " ".join(edited(base, 4, r))) for i in range(150)]  # pairs lie around the limit
    r.shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_exact_copies_in_a_third_of_all_rows(spark):
    docs = spark.range(0, 3000, 1, 6).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 1 THEN 'the very same text of all of these rows' ELSE concat_ws(' ', id, id + 1, id * 7, id * 13, 'x') END AS text")
    rows = hm.near_duplicates(docs).groupBy("component_id").count().filter("count > 1").collect()
    assert [(r.component_id, r["count"]) for r in rows] == [(1, 1000)]


def test_nulls_empty_repeats_long_texts_and_clashing_columns(spark):
    r = random.Random(8)
    long = r.choices(VOCABULARY, k=60_000)
    rows = [(None, "a b c d e"), (7, "A b\tc d  e"), (None, None), (3, ""), (4, " \n"), (5, "x y"), (6, "X Y"), (8, "y x"), (9, "same row here now"),
            (9, "same row here now"), (10, " ".join(long)), (11, " ".join(edited(long, 900, r))), (None, "only one without id"), (12, "é É a b"), (13, "é é a b")]
    assert found(spark, rows) == brute(rows)
    docs = spark.createDataFrame([(*x, 1, "s") for x in rows], "doc_id long, text string, class int, `row.x` string")
    kept = hm.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["7", "None", "3", "4", "5", "8", "9", "9", "10", "None", "12", "13"])
    assert hm.near_duplicates(docs.limit(0)).collect() == [] and hm.keep_one(docs.limit(0)).collect() == []


def test_registers_hold_zeros_and_mantissa_of_the_least_value():
    hashes = np.unique(np.random.default_rng(1).integers(0, 2**64, 500, dtype=np.uint64))
    got = hm.registers(hashes)
    for bucket in range(hm.REGISTERS):
        values = [int(h) & (2**57 - 1) for h in hashes.tolist() if h >> 57 == bucket]
        if not values:
            assert got[bucket] == 0
            continue
        bits = f"{min(values):057b}"
        zeros = len(bits) - len(bits.lstrip("0"))
        behind = (bits[zeros + 1:] + "0" * 26)[:26]
        assert got[bucket] == (zeros + 1 << 26) + int(behind, 2)


@pytest.mark.parametrize("size,share", [(50, 0.8), (500, 0.5), (500, 0.8), (5000, 0.9), (20000, 0.2)])
def test_estimates_are_near_the_similarity(size, share):
    r = np.random.default_rng(size)
    errors = []
    for _ in range(60):
        both = int(size * share)
        values = r.integers(0, 2**64, 2 * size - both, dtype=np.uint64)
        a, b = np.unique(values[:size]), np.unique(values[size - both:])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        got, error = hm.estimate(hm.registers(a)[None], hm.registers(b)[None], np.array([len(a)]), np.array([len(b)]))
        errors.append(got[0] - true)
        assert abs(errors[-1]) < 6 * max(error[0], 0.05)
    assert abs(np.mean(errors)) < 0.03


def test_chance_collisions_are_few_and_grow_with_equal_sizes():
    assert 0 < hm._collisions(40, 40) < 1e-5 and hm._collisions(40, 8) < hm._collisions(40, 40)


def test_sets_of_chunks_equal_plain_sets():
    texts = ["a b c d", "A B C D", "a  b\nc\td", None, "", "a b", "b a", "a b c d a b c d", "aé bÉ c d e"]
    sets = [tuple(s.tolist()) for s in hm.shingle_sets(pa.array(texts), 4)]
    plain = [shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in plain]
    assert all((sets[i] == sets[j]) == (plain[i] == plain[j]) for i in range(len(texts)) for j in range(len(texts)))


def test_connected_components(spark):
    r = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 400)] + [(r.randrange(500, 900), r.randrange(500, 900)) for _ in range(250)]
    edges = [(a, b) for a, b in edges if a != b]
    got = {x.node: x.component for x in hm.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    assert got == label


def test_common_hashes_of_many_sets():
    r = np.random.default_rng(4)
    sides = [[np.unique(r.integers(0, 60, r.integers(0, 30)).astype(np.uint64)) for _ in range(n)] for n in (13, 7)]
    for columns in (1, 5, 4096):
        got = hm._common(*sides, columns=columns)
        assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sides[1]] for a in sides[0]]
    assert hm._common([np.array([1], np.uint64)], [np.array([2], np.uint64)]).tolist() == [[0]]


def test_small_blocks_give_the_same_components(spark):
    r = random.Random(11)
    base = r.choices(VOCABULARY, k=100)
    rows = [(i, " ".join(edited(base, r.choice([3, 4, 5, 6]), r))) for i in range(120)]
    assert found(spark, rows, hm.Settings(hub_rounds=1, block_rows=16, block_shingles=2_000)) == brute(rows)


def test_every_register_lies_in_several_bands():
    counts = np.bincount(hm.bands(hm.Settings()).ravel(), minlength=hm.REGISTERS)
    assert hm.bands(hm.Settings()).shape == (63, 6) and counts.min() >= 2
