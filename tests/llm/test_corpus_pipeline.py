import re
import sys
import zlib
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import numpy as np
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from salesmart.session import settle
from test_compression_quality import plain_limits, plain_verdict
from test_config_packing import check as check_packing
from test_config_packing import plain
from test_leak_align import best_score
from test_line_winnow import brute as removed_lines

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """(input rows, output rows) of each stage, run as the pipeline does."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        after = settle(stage(spark, docs, SF), name)
        out[name] = docs.collect(), after.collect(), after.columns
        docs = after
    return out


def texts(rows):
    return {r.doc_id: r.text for r in rows}


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontaminate", "pack"]
    for name, (_, _, columns) in stages.items():
        assert name == "pack" or columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_rules(stages):
    before, after, _ = stages["quality_rules"]
    known = plain_limits([r.text for r in before])
    assert sorted(after) == sorted(r for r in before if r.text and plain_verdict(r.text, known))
    assert 0 < len(after) < len(before)


def test_line_dedup(stages):
    before, after, _ = stages["line_dedup"]
    gone = removed_lines(texts(before), 50)
    want = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) for d, t in texts(before).items()}
    assert texts(after) == {d: t for d, t in want.items() if t.split() or not gone[d]}
    assert all(r.n_chars == len(r.text) for r in after) and any(gone.values())


def test_near_dedup(stages):
    before, after, _ = stages["near_dedup"]
    sets = {d: {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or {tuple(w)} for d, t in texts(before).items()
            if (w := re.sub("[A-Z]", lambda m: m[0].lower(), t).encode().split()) or True}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    assert sorted(after) == sorted(r for r in before if root(r.doc_id) == r.doc_id)


def test_decontaminate(spark, stages):
    before, after, _ = stages["decontaminate"]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in after}
    for r in before:
        if r.doc_id in kept:
            assert not any(i in r.text for i in items)
        else:
            assert max(best_score(i, r.text) for i in items) >= 0.5


def test_pack(stages):
    before, after, _ = stages["pack"]
    names = sorted(texts(before))
    ids = dict(zip(names, plain([texts(before)[d] for d in names])))
    whole = {d: b"".join(bytes(r.ids) for r in sorted((r for r in after if r.doc_id == d), key=lambda r: r.piece)) for d in names}
    assert whole == {d: i + np.array([1], "<u4").tobytes() for d, i in ids.items()}
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and r.length == len(r.ids) // 4 for r in after)
    check_packing(after, 4096)


def test_run_returns_the_last_stage(spark, stages):
    rows = contract.queries()["pipeline"](spark, SF).select("doc_id", "piece", "ids_crc32").collect()
    assert Counter(rows) == Counter((r.doc_id, r.piece, r.ids_crc32) for r in stages["pack"][1])


def test_odd_rows_pass_through_every_stage(spark):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(None, good), (None, None), (1, ""), (2, good + " more"), (2, good + " more"), (3, "\n".join([good] * 3000))]
    docs = spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, gone string, row int")
    for start in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, start, SF)
            assert name == "pack" or out.columns == docs.columns
            assert out.count() <= max(start.count(), 0) or name == "pack"
