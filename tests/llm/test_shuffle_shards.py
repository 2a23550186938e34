import zlib
from collections import Counter, defaultdict

import pytest

from salesmart.llm import queries, shuffle_shards
from salesmart.llm.shuffle_shards import place_rows, read_shards, write_shards


def gather(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    return by


def check(rows, shards):
    by = gather(rows)
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(by) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


@pytest.mark.parametrize("bucket_bytes", [200, 5_000, 1 << 20])
def test_every_row_once_and_even_counts(spark, bucket_bytes):
    docs = spark.range(0, 997, 1, 5).selectExpr("id AS doc_id", "repeat('x', int(id % 90)) AS text", "id % 7 AS bucket", "1 AS row", "2 AS `cell.x`")
    placed = place_rows(docs, 10, bucket_bytes=bucket_bytes)
    assert placed.columns == ["doc_id", "text", "bucket", "row", "cell.x", "shard", "slot"]
    rows = placed.collect()
    assert Counter(r.doc_id for r in rows) == Counter(range(997))
    check(rows, 10)


def test_order_is_shuffled_repeatable_and_seeded(spark):
    docs = spark.range(0, 2000, 1, 4).selectExpr("id AS doc_id", "string(id) AS text").coalesce(2)
    runs = [place_rows(docs, 4, seed=s, bucket_bytes=4_000).collect() for s in (1, 1, 2)]
    at = [{r.doc_id: (r.shard, r.slot) for r in run} for run in runs]
    assert at[0] == at[1] and at[0] != at[2]
    moved = [(s * 500 + k) for s, k in (at[0][i] for i in range(2000))]
    n = len(moved)
    mean = sum(moved) / n
    covariance = sum((i - (n - 1) / 2) * (m - mean) for i, m in enumerate(moved)) / n
    assert abs(covariance / ((n * n - 1) / 12)) < 0.08  # about 3.5 standard errors


def test_equal_rows_are_split_over_parts(spark):
    docs = spark.range(0, 900, 1, 3).selectExpr("CAST(CASE WHEN id % 3 > 0 THEN NULL ELSE id END AS long) AS doc_id",
                                                "CASE WHEN id % 3 > 0 THEN 'same text in all of these rows' ELSE string(id) END AS text")
    placed = place_rows(docs, 7, bucket_bytes=500)
    rows = placed.collect()
    check(rows, 7)
    assert sum(r.doc_id is None for r in rows) == 600


def test_written_shards_read_back_with_nulls_and_long_texts(spark):
    rows = [(1, None, "s"), (None, "", "s"), (3, "é" * 50_000, None), (3, "a", "t"), (3, "a", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(2)
    placed = place_rows(docs, 3, bucket_bytes=100)
    assert placed.columns == ["doc_id", "text", "shard", "slot"]  # the clashing column is replaced
    got = read_shards(placed, write_shards(placed)).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(r[:2] for r in rows)
    check(got, 3)
    none = place_rows(docs.limit(0), 3)
    assert none.collect() == [] and none.columns == placed.columns


def test_query_over_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op9_shuffle_shards(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(docs[r.doc_id]) + 16, zlib.crc32(docs[r.doc_id]), "rows", None)
    check(rows, 40)


def test_main_path_has_no_python(spark):
    docs = spark.range(50).selectExpr("id AS doc_id", "string(id) AS text")
    plan = place_rows(docs, 3)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert shuffle_shards.RECORD_BYTES == 16
