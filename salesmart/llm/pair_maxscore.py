"""Ranked lexical search with MaxScore, bounded by pairs of terms.

One pass over the documents writes an index: a row for each segment of some thousand documents, with the segment's terms, the
documents that hold them and how often, whatever the queries are. Everything after that reads the index.

Queries come in blocks of bounded size. A first look at the index counts in how many documents each of a block's terms is. In
each segment, a query's terms are ordered by their highest impacts there and neighbours are paired, so common pairs
serve many queries. Every pair gets its intersection list with the highest joint impact in it, before queries are
answered. A document with both terms gains at most the joint impact, one with a single term at most the higher of the two
maxima; the greater of these bounds the pair, and it is less than the sum of both maxima wherever the two do not peak in the
same document.

As long as the bounds of a query's lower pairs, with that of the next single term, add up to less than the score of the last
one in the query's heap, a document cannot get in by these terms alone: only the documents in the lists of the others
are looked at, and they are dropped as soon as their score with what is left, by the intersection list they are in
or not in, cannot reach the heap. A heap goes with its task from segment to segment, so the bar rises; the tasks'
heaps are merged by a ranking in two steps. No document that may be among the best is ever left out.

Terms are the runs of characters that are no ASCII marks or white space, with A to Z lowered, under 64-bit hashes. Scores are
integers, see :class:`Corpus`.

Defined results: null texts have no terms, and documents or queries without terms rank nowhere and count for nothing; equal
scores are ranked by id, a null id last; rows repeated in the documents are ranked one by one; equal rows of the queries are
answered once, and rows that share an id but not a text each for themselves; empty tables give empty results; further columns are left out.
A very long text is a segment of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesmart.llm import word_hash
from salesmart.session import settle

#: The bytes that separate terms.
TABLE = word_hash.byte_table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
LAST_ID = np.iinfo(np.int64).max
INDEX_DDL = (
    "doc_ids array<bigint>, lengths binary, terms binary, first binary, places binary, counts binary, documents bigint, occurrences bigint")


@dataclass(frozen=True)
class Settings:
    """The number of results, and sizes that change the work but not the result."""

    best: int = 50
    pairs: bool = True  # without them terms are bounded one by one
    segment_bytes: int = 4 << 20
    block_bytes: int = 1 << 20  # of query texts that one block holds
    lanes: int = 64  # of the first merge


@dataclass(frozen=True)
class Corpus:
    """Documents with terms and the number of all their terms.

    A term in ``df`` documents weighs floor(1000 * ln((2 * documents + 2) / (2 * df + 1))). A document of n terms has m = 50 + 50 * n *
    documents div occurrences, and a term that it holds tf times adds weight * ((10**9 * tf) div (1000 * tf + 20 * m)).
    """

    documents: int
    occurrences: int

    def weights(self, df: np.ndarray) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * self.documents + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)

    def norms(self, lengths: np.ndarray) -> np.ndarray:
        if len(lengths) and 50 * int(lengths.max()) * self.documents >= 1 << 63:
            return np.array([50 + 50 * n * self.documents // self.occurrences for n in lengths.tolist()], np.int64)
        return 50 + 50 * lengths * self.documents // max(1, self.occurrences)


def segments(batch: pa.RecordBatch, segment_bytes: int) -> Iterator[dict]:
    """Index rows of the documents (id, text) of a batch."""
    ids, texts = batch.columns
    for low, high, words in word_hash.chunks(texts, TABLE, segment_bytes):
        lengths = np.diff(words.first)
        place = np.repeat(np.arange(high - low), lengths)
        order = np.lexsort((place, words.hashes))
        hashes, place = words.hashes[order], place[order]
        new = np.append(True, (hashes[1:] != hashes[:-1]) | (place[1:] != place[:-1]))[:len(hashes)]
        at = np.flatnonzero(new)
        counts = np.diff(np.append(at, len(hashes)))
        hashes, place = hashes[at], place[at]
        starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[:len(hashes)])
        yield {
            "doc_ids": ids.slice(low, high - low).to_pylist(), "lengths": lengths.astype("<i8").tobytes(),
            "terms": hashes[starts].astype("<u8").tobytes(), "first": np.append(starts, len(hashes)).astype("<i4").tobytes(),
            "places": place.astype("<i4").tobytes(), "counts": counts.astype("<i4").tobytes(),
            "documents": int((lengths > 0).sum()), "occurrences": int(lengths.sum())}


def build_index(docs: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Segments of all documents, one row each; write it before it is searched."""
    schema = pa.schema([
        ("doc_ids", pa.list_(pa.int64())), *((c, pa.binary()) for c in ("lengths", "terms", "first", "places", "counts")),
        ("documents", pa.int64()), ("occurrences", pa.int64())])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in segments(batch, settings.segment_bytes):
                yield pa.RecordBatch.from_pylist([row], schema)

    return docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text")).mapInArrow(index, INDEX_DDL)


@dataclass
class Queries:
    """A block of queries: ids, the block's terms (sorted hashes), each query's terms as places among them, weights."""

    ids: list
    terms: np.ndarray
    own: list[np.ndarray]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @staticmethod
    def of(rows: list[tuple]) -> Queries:
        own: list[np.ndarray] = []
        for low, high, words in word_hash.chunks(pa.array([r[1] for r in rows], pa.large_string()), TABLE):
            own += [np.unique(words.hashes[words.first[i]:words.first[i + 1]]) for i in range(high - low)]
        terms = np.unique(np.concatenate([*own, np.zeros(0, np.uint64)]))
        return Queries([r[0] for r in rows], terms, [np.searchsorted(terms, x) for x in own])


class Segment:
    """A segment's postings of a block's terms, with impacts, their maxima, and the pairs' intersection lists."""

    def __init__(self, row: dict, queries: Queries, corpus: Corpus, pairs: bool = True) -> None:
        terms, first = np.frombuffer(row["terms"], "<u8"), np.frombuffer(row["first"], "<i4").astype(np.int64)
        places, counts = np.frombuffer(row["places"], "<i4"), np.frombuffer(row["counts"], "<i4")
        norms = corpus.norms(np.frombuffer(row["lengths"], "<i8"))
        self.size = len(norms)
        at = _positions(terms, queries.terms)
        here = np.flatnonzero(at >= 0)
        low, n = first[at[here]], first[at[here] + 1] - first[at[here]]
        upto = np.cumsum(n)
        taken = np.repeat(low - (upto - n), n) + np.arange(n.sum())
        places, tf = places[taken], counts[taken].astype(np.int64)
        impacts = np.repeat(queries.weights[here], n) * (10**9 * tf // (1000 * tf + 20 * norms[places]))
        cuts = upto - n
        #: term -> (documents, impacts), and the highest of these
        self.lists = {t: (places[a:b], impacts[a:b]) for t, a, b in zip(here.tolist(), cuts.tolist(), upto.tolist())}
        self.highest = np.zeros(len(queries.terms), np.int64)
        if len(here):
            self.highest[here] = np.maximum.reduceat(impacts, cuts)
        #: of each query: its terms that occur here, the one of the lowest maximum first
        self.order: list[list[int]] = []
        for own in queries.own:
            held = own[at[own] >= 0]
            self.order.append(held[np.argsort(self.highest[held], kind="stable")].tolist())
        #: pair -> (whether a document is in the intersection list, highest joint impact)
        self.joint: dict[tuple[int, int], tuple[np.ndarray, int]] = {}
        for pair in {pair for held in self.order for pair in zip(held[::2], held[1::2])} if pairs else ():
            (docs, own), (others, theirs) = (self.lists[t] for t in pair)
            other = np.full(self.size, -1, np.int64)
            other[others] = theirs
            both = other[docs] >= 0
            inside = np.zeros(self.size, bool)
            inside[docs[both]] = True
            self.joint[pair] = inside, int((own[both] + other[docs[both]]).max()) if both.any() else 0

    def bounds(self, held: list[int]) -> list[int]:
        """For each number of a query's first terms, what a document can gain by them at most."""
        below = [0]
        for k, t in enumerate(held):
            highest = int(self.highest[t])
            pair = (held[k - 1], t) if k % 2 else ()
            below.append(below[k - 1] + max(highest, self.joint[pair][1]) if pair in self.joint else below[k] + highest)
        return below

    def search(self, query: int, bar: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores) of those with a score of ``bar`` (or 1) at least, and of how many documents a score was begun."""
        bar, held = max(1, bar), self.order[query]
        below = self.bounds(held)
        lower = max(k for k in range(len(below)) if below[k] < bar)  # terms that stay below the bar together
        if lower == len(held):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        score = np.zeros(self.size, np.int64)
        seen = np.zeros(self.size, bool)
        for t in held[lower:]:
            docs, impacts = self.lists[t]
            score[docs] += impacts
            seen[docs] = True
        docs = np.flatnonzero(seen)
        begun = len(docs)
        while lower and len(docs):
            pair = tuple(held[lower - 2:lower]) if lower % 2 == 0 else ()
            some = pair if pair in self.joint else held[lower - 1:lower]
            lower -= len(some)
            gain = self.highest[some[-1]]  # the higher maximum of the two
            if some is pair:
                inside, joint = self.joint[pair]
                gain = np.where(inside[docs], joint, gain)
            docs = docs[score[docs] + gain + below[lower] >= bar]
            for t in some:
                others, impacts = self.lists[t]
                score[others] += impacts
        docs = docs[score[docs] >= bar]
        return docs, score[docs], begun


def _positions(table: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted value in a sorted table, -1 if it is not there."""
    if not len(table):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return np.where(table[at] == wanted, at, -1)


class Heap:
    """A query's best documents so far."""

    def __init__(self, best: int) -> None:
        self.best = best
        self.ids = self.scores = np.zeros(0, np.int64)

    @property
    def bar(self) -> int:
        """What a further document must reach; one that equals the last may have a lower id."""
        return int(self.scores[-1]) if len(self.scores) == self.best else 0

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.append(self.ids, ids), np.append(self.scores, scores)
        order = np.lexsort((ids, -scores))[:self.best]
        self.ids, self.scores = ids[order], scores[order]


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {name: batch.column(k)[i] for k, name in enumerate(batch.schema.names)}


def _count(index: DataFrame, queries: Queries) -> np.ndarray:
    """In how many documents each of the block's terms is."""
    wanted = queries.terms

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for row in _rows(batch):
                at = _positions(np.frombuffer(row["terms"].as_py(), "<u8"), wanted)
                total += np.where(at >= 0, np.append(np.diff(np.frombuffer(row["first"].as_py(), "<i4")), 0)[at], 0)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "n"])

    counted = index.select("terms", "first").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    df = np.zeros(len(wanted), np.int64)
    for row in counted.collect():  # at most the terms of a block
        df[row["term"]] = row["n"]
    return df


def _answer(index: DataFrame, queries: Queries, corpus: Corpus, settings: Settings) -> DataFrame:
    """(query, doc_id, score) of each task's best documents for the queries of a block."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = [Heap(settings.best) for _ in queries.ids]
        for batch in batches:
            for row in _rows(batch):
                names = row["doc_ids"].values
                ids = np.where(names.is_valid(), names.fill_null(LAST_ID), LAST_ID).astype(np.int64)
                segment = Segment({k: v.as_py() for k, v in row.items() if k != "doc_ids"}, queries, corpus, settings.pairs)
                for query, heap in enumerate(heaps):
                    docs, scores, _ = segment.search(query, heap.bar)
                    if len(docs):
                        heap.add(ids[docs], scores)
        query = np.repeat(np.arange(len(heaps)), [len(h.ids) for h in heaps])
        ids = np.concatenate([*(h.ids for h in heaps), np.zeros(0, np.int64)])
        scores = np.concatenate([*(h.scores for h in heaps), np.zeros(0, np.int64)])
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(ids, mask=ids == LAST_ID), pa.array(scores)], names=["query", "doc_id", "score"])

    columns = ["doc_ids", "lengths", "terms", "first", "places", "counts"]
    return index.select(*columns).mapInArrow(answer, "query bigint, doc_id bigint, score bigint")


def _best(found: DataFrame, keys: list[str], best: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)


def search(index: DataFrame, items: DataFrame, settings: Settings = Settings(), item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score) of the best documents of each query; ``index`` is a written :func:`build_index`."""
    spark = index.sparkSession
    kind = items.schema[item_id].dataType.simpleString()
    sums = index.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("documents", "occurrences")]).first()
    corpus = Corpus(sums["documents"], sums["occurrences"])
    asked = settle(items.select(items[item_id].alias("item_id"), items[text].alias("text")).distinct(), "queries")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0)).alias("bytes")).first()["bytes"]
    blocks = 1 + size // settings.block_bytes
    answers = []
    for block in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        queries = Queries.of([tuple(r) for r in rows])
        if not len(queries.terms) or not corpus.documents:
            continue
        queries.weights = corpus.weights(_count(index, queries))
        found = _answer(index, queries, corpus, settings).withColumn("lane", F.spark_partition_id() % settings.lanes)
        found = _best(_best(found, ["query", "lane"], settings.best), ["query"], settings.best)
        names = spark.createDataFrame(list(enumerate(queries.ids)), f"query bigint, item_id {kind}")
        answers.append(found.join(names, "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    empty = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionByName, answers) if answers else empty
