"""Driver queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import (
    compression_quality, config_packing, html_extract, hyperminhash, leak_align, line_winnow, pair_bpe, pair_maxscore, pii_crf,
    secret_links, shuffle_shards, strassen_negatives, warc_zstd,
)
from salesmart.session import settle


def find_package(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver did, if it is not installed there."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract_pages(pages).select("page_id", "url", "article.*")


def op2_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii_crf.find_personal_data(docs).select("doc_id", "personal.*")


def op3_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back."""
    marked = warc_zstd.mark_revisits(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    archives = settle(warc_zstd.write_archives(marked), "warc")
    records = warc_zstd.read_archives(archives, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secret_links.find_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_leak_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and the alignment."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return leak_align.find_leaks(docs, _table(spark, sf_dir, "benchmark"))


def op6_config_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as tokens, packed into sequences of 4096."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return config_packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def op7_line_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of lines that occurred before."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_winnow.drop_repeated_runs(docs, counts=True)


def op8_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return hyperminhash.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


def op9_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents shuffled into 40 shards of equal counts, read from the written shards."""
    placed = shuffle_shards.place_rows(_table(spark, sf_dir, "documents").select("doc_id", "text"), shards=40)
    stored = shuffle_shards.read_shards(placed, shuffle_shards.write_shards(placed))
    text = F.coalesce("text", F.lit(""))
    return stored.select(
        "doc_id", (F.octet_length(text) + shuffle_shards.RECORD_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op10_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and compression verdict of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return compression_quality.score_documents(docs).select("doc_id", "quality.*")


def op11_pair_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    index = settle(pair_maxscore.build_index(docs), "index")
    return pair_maxscore.search(index, _table(spark, sf_dir, "benchmark"))


def op12_pair_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as tokens and back."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pair_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op13_strassen_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector; every seventh label is off by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label")
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label)
    return strassen_negatives.mine(vectors, lambda vec_id: vec_id % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extract": op1_html_extract,
    "op2_pii_crf": op2_pii_crf,
    "op3_warc_zstd": op3_warc_zstd,
    "op4_secret_links": op4_secret_links,
    "op5_leak_align": op5_leak_align,
    "op6_config_packing": op6_config_packing,
    "op7_line_winnow": op7_line_winnow,
    "op8_hyperminhash": op8_hyperminhash,
    "op9_shuffle_shards": op9_shuffle_shards,
    "op10_compression_quality": op10_compression_quality,
    "op11_pair_maxscore": op11_pair_maxscore,
    "op12_pair_bpe": op12_pair_bpe,
    "op13_strassen_negatives": op13_strassen_negatives,
}
ORACLES: dict[str, str] = {
    # All pairs that share a shingle, then all that are reachable: no sketches.
    "op8_hyperminhash": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS ws FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: ws[i:i + 3])
                                                  WHEN len(ws) > 0 THEN [ws] ELSE [] END) AS shingle FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
              GROUP BY x.doc_id, y.doc_id),
        l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
        r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        m AS (SELECT a AS doc_id, min(b) AS low FROM r GROUP BY a)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
               doc_id <= coalesce(low, doc_id) AS kept
        FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)""",
    # Whole windows are compared as lists of lines: no hashes and no fingerprints.
    "op7_line_winnow": r"""
        WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
        l AS (SELECT doc_id, len(ls) AS n_lines, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
        p AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS upto,
                     coalesce(lead(pos) OVER (PARTITION BY doc_id ORDER BY pos), n_lines) - 1 AS stop
              FROM (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM l) WHERE words > 0),
        w AS (
            SELECT doc_id, min(pos) OVER f AS a, max(stop) OVER f AS b, sum(words) OVER f AS n, list(line) OVER f AS ls
            FROM (SELECT *, upto - words AS before FROM p)
            WINDOW f AS (PARTITION BY doc_id ORDER BY before RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
            UNION ALL
            SELECT doc_id, min(pos) OVER f, max(stop) OVER f, sum(words) OVER f, list(line) OVER f FROM p
            WINDOW f AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
        g AS (SELECT ls, min((doc_id, a)) AS earliest FROM w WHERE n >= 50 GROUP BY ls),
        x AS (SELECT DISTINCT l.doc_id, l.pos FROM l JOIN (SELECT doc_id, a, b FROM w JOIN g USING (ls) WHERE n >= 50 AND (doc_id, a) > earliest) r
              ON l.doc_id = r.doc_id AND l.pos BETWEEN r.a AND r.b)
        SELECT doc_id, CASE WHEN text IS NOT NULL THEN coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (gone IS NULL), '') END AS text,
               CAST(count(pos) AS BIGINT) AS n_lines, CAST(count(gone) AS BIGINT) AS n_removed
        FROM (SELECT documents.doc_id, documents.text, l.line, l.pos, x.pos AS gone
              FROM documents LEFT JOIN l ON documents.doc_id = l.doc_id LEFT JOIN x ON x.doc_id = l.doc_id AND x.pos = l.pos)
        GROUP BY doc_id, text""",
    "op3_warc_zstd": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        g AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id > first THEN first END AS refers_to
        FROM p LEFT JOIN g USING (payload_digest)""",
    # Every document that shares a term with an item is scored: no index, no bounds.
    "op11_pair_maxscore": r"""
        WITH t AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
        f AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
        d AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM f GROUP BY doc_id),
        c AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS occurrences FROM d),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM f, c GROUP BY term),
        q AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        s AS (SELECT item_id, doc_id,
                     CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * documents) // occurrences)))) AS BIGINT) AS score
              FROM q JOIN f USING (term) JOIN w USING (term) JOIN d USING (doc_id), c GROUP BY item_id, doc_id),
        r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
              FROM s WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50""",
    # All pairs of an anchor and a row; sums of products of small integers are exact in doubles.
    "op13_strassen_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
              FROM v a JOIN v r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, CAST(row_number() OVER f AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        WINDOW f AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER f <= 3""",
}
