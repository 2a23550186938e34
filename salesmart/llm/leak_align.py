"""Benchmark decontamination: seeds of near word pairs, then Smith-Waterman alignment of words.

A document leaks an item if its best local alignment reaches ``least_score`` of the score of a whole copy;
replaced, added and dropped words lower the score by one to three words each. The seeds miss no such document,
whatever the corpus's size. Let an item have m words and the alignment match a of them, at a cost of one for each word
between two matches. The cost is 2a - 2 * least_score * m at most, so at most a - least_score * m steps from match to
match cost two or more, and ceil(least_score * m) - 1 steps at least cost none or one: from a word of the item to its
next or next but one, found as next or next but one in the document. A place of the item, with both its pairs, can
thus be left out as a seed as long as fewer places are left out than such steps. A first pass counts the pairs
in the corpus, and the most frequent places are left out, so chance hits stay few.

A second pass finds the seeds in each document. Where as many hits as an alignment must have lie within the words
that it can span, the words around are aligned as a whole.

Items come to the executors in blocks of bounded size, one pass a block, so the benchmark may have any size. Documents
are not shuffled; counts are combined in each task before they travel.

Words are lowered and cut at ASCII white space and punctuation. Defined results: null and empty texts and items
leak nothing; items of fewer than ``least_words`` words, of which a half proves nothing, match whole copies only, found by
one hash of all their words; longer ones, however long, are aligned as a whole; texts have any length; repeated
rows each have their own result; empty tables give empty results.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm import word_hash

TABLE = word_hash.byte_table(bytes([*range(0x21), *range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
MATCH, MISMATCH, GAP = 2, -1, -1
FOUND_DDL = "array<struct<item: int, score: double, first_word: bigint, last_word: bigint>>"


@dataclass(frozen=True)
class Settings:
    """Parameters of the search, see the module."""

    least_score: float = 0.5
    least_words: int = 8  # shorter items are matched exactly
    hits: int = 3  # seeds that an alignment must hit, if it has as many; changes the work, not the result
    words_a_hit: int = 16  # a longer item asks for a hit for so many of its words; likewise
    rare_share: float = 1e-7  # places of pairs with this share of the corpus's are seeds too; likewise

    def __post_init__(self) -> None:
        if self.least_score * self.least_words <= 1:
            raise ValueError("one equal word would be a leak: raise least_score or least_words")


@dataclass
class Items:
    """Test items to align: the row of each, its words, and all pairs with their places; and short items."""

    ids: list
    item: np.ndarray
    words: list[np.ndarray]
    pairs: np.ndarray  # sorted, distinct
    places: list[np.ndarray]  # of each item: index into pairs at each place, of the next word and the next but one (or -1)
    short: dict[int, dict[int, list[int]]]  # by the number of words and the hash of all of them: rows


@dataclass
class Seeds:
    """Pairs to look for, with their items: those of pair i are ``owner[first[i]:first[i + 1]]``.

    Of each item: how many hits an alignment has at least, within how many words.
    """

    pairs: np.ndarray
    first: np.ndarray
    owner: np.ndarray
    needed: np.ndarray
    reach: np.ndarray


def _lower(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts.cast(pa.large_string()))


def items_of(rows: list[tuple], settings: Settings) -> Items:
    """Index of rows that begin with (id, text)."""
    texts = _lower(pa.array([r[1] for r in rows], pa.large_string()))
    owner, words, hashes = [], [], []
    short: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
    for low, high, found in word_hash.chunks(texts, TABLE):
        for i in range(low, high):
            own = found.hashes[found.first[i - low]:found.first[i - low + 1]]
            if len(own) >= settings.least_words:
                owner.append(i)
                words.append(own)
                hashes.append(np.stack([pair_hashes(own, 1), np.append(pair_hashes(own, 2), np.uint64(0))]))
            elif len(own):
                short[len(own)][int(run_hashes(own, len(own))[0])].append(i)
    pairs = np.unique(np.concatenate([np.concatenate([near, far[:-1]]) for near, far in hashes])) if hashes else np.zeros(0, np.uint64)
    places = [np.searchsorted(pairs, h) for h in hashes]
    for p in places:
        p[1, -1] = -1
    return Items([r[0] for r in rows], np.array(owner, np.int64), words, pairs, places, {n: dict(found) for n, found in short.items()})


def pair_hashes(words: np.ndarray, apart: int) -> np.ndarray:
    """Hash of each word with the word ``apart`` places on."""
    return word_hash.mix(words[:-apart] * np.uint64(word_hash.BASE) + words[apart:])


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n`` words in a row."""
    runs = np.zeros(max(len(words) - n + 1, 0), np.uint64)
    for k in range(n):
        runs = runs * np.uint64(word_hash.BASE) + words[k:k + len(runs)]
    return word_hash.mix(runs)


def pairs_in(words: word_hash.Words, lookup: Lookup) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(first word, its text, index in the set) of the known pairs in texts, and how many pairs these have."""
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    at, index, total = [], [], 0
    for apart in (1, 2):
        place, known = lookup.find(pair_hashes(words.hashes, apart))
        inside = text[place] == text[place + apart]
        at.append(place[inside])
        index.append(known[inside])
        total += int(np.maximum(np.diff(words.first) - apart, 0).sum())
    place, known = np.concatenate(at), np.concatenate(index)
    return place, text[place], known, total


class Lookup:
    """Finds which of many hashes are in a sorted set; most fail at a table of bits."""

    def __init__(self, known: np.ndarray, bits: int = 22) -> None:
        self.known, self.mask = known, np.uint64((1 << bits) - 1)
        self.maybe = np.zeros(1 << bits, bool)
        self.maybe[(known & self.mask).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of hits, their index in the set)."""
        at = np.flatnonzero(self.maybe[(hashes & self.mask).astype(np.int64)])
        if not len(at) or not len(self.known):
            return at[:0], at[:0]
        index = np.minimum(np.searchsorted(self.known, hashes[at]), len(self.known) - 1)
        hit = self.known[index] == hashes[at]
        return at[hit], index[hit]


def pair_counts(docs: DataFrame, items: Items, text: str = "text") -> tuple[np.ndarray, int]:
    """How often each pair of the items occurs in the corpus, and how many pairs that has."""
    known = items.pairs
    if not len(known):
        return np.zeros(0, np.int64), 0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, total = Lookup(known), np.zeros(len(known) + 1, np.int64)
        for batch in batches:
            for _, _, words in word_hash.chunks(_lower(batch.column(0)), TABLE):
                _, _, index, n = pairs_in(words, lookup)
                total += np.bincount(index, minlength=len(known) + 1)
                total[-1] += n
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["pair", "n"])

    counts = np.zeros(len(known) + 1, np.int64)
    rows = docs.select(docs[text]).mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    found = rows.toArrow()  # as many rows as the block of items has pairs
    counts[found["pair"].to_numpy()] = found["n"].to_numpy()
    return counts[:-1], int(counts[-1])


def seeds_of(items: Items, counts: np.ndarray, total: int, settings: Settings) -> Seeds:
    """The rarest places of each item, as many as it takes to be hit as often as the settings ask, and other rare ones."""
    counts = np.append(counts, 0)  # for the last place, which has one pair
    pairs, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    needed, reach = [], []
    for w, (word, places) in enumerate(zip(items.words, items.places)):
        m = len(word)
        steps = math.ceil(settings.least_score * m - 1e-9) - 1  # places that an alignment hits at least
        missed = m - 1 - steps
        often = counts[places].sum(0)
        chosen = often <= settings.rare_share * total
        hits = max(settings.hits, m // settings.words_a_hit)
        chosen[np.argsort(often, kind="stable")[:missed + max(1, min(hits, steps))]] = True
        own = np.unique(places[:, chosen])
        pairs.append(own[own >= 0])
        owners.append(np.full(len(pairs[-1]), w))
        needed.append(int(chosen.sum()) - missed)
        reach.append(math.floor((3 - 2 * settings.least_score) * m + 1e-9))
    pair, owner = np.concatenate(pairs), np.concatenate(owners)
    order = np.argsort(pair, kind="stable")
    known, first = np.unique(pair[order], return_index=True)
    return Seeds(items.pairs[known], np.append(first, len(pair)), owner[order], np.array(needed, np.int64), np.array(reach, np.int64))


def align(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """(best local score, the column after its end) of two word sequences, by Smith-Waterman with linear gaps."""
    steps = np.arange(len(words) + 1) * GAP
    row = np.zeros(len(words) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        new = np.zeros_like(row)
        new[1:] = row[:-1] + np.where(words == word, MATCH, MISMATCH)
        np.maximum(new, row + GAP, out=new)
        np.maximum(new, 0, out=new)
        # A gap along the row: the best start before, lowered by the way from there.
        row = np.maximum.accumulate(new - steps) + steps
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def regions(words: word_hash.Words, seeds: Seeds, lookup: Lookup, most: int = 1 << 22) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, start, end) of the words in which an alignment can lie; about ``most`` hits are held at a time."""
    place, text, known, _ = pairs_in(words, lookup)
    order = np.argsort(place, kind="stable")
    place, text, known = place[order], text[order], known[order]
    n = seeds.first[known + 1] - seeds.first[known]
    before = np.cumsum(n) - n
    begins = np.searchsorted(text, text)  # the first hit of the same text
    part = before[begins] // most if len(n) else before
    for own in np.split(np.arange(len(n)), np.flatnonzero(np.diff(part)) + 1):
        size = n[own]
        held = np.repeat(seeds.first[known[own]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        w, at = seeds.owner[held], np.repeat(place[own], size)
        order = np.lexsort((at, w))
        w, at = w[order], at[order]
        once = np.ones(len(w), bool)
        once[1:] = (np.diff(w) != 0) | (np.diff(at) != 0)
        w, at = w[once], at[once]
        doc = np.searchsorted(words.first, at, "right") - 1
        last = np.arange(len(w)) + seeds.needed[w] - 1
        i = np.flatnonzero(last < len(w))
        j = last[i]
        i, j = (x[(w[i] == w[j]) & (doc[i] == doc[j]) & (at[j] - at[i] < seeds.reach[w[i]])] for x in (i, j))
        if not len(i):
            continue
        w, doc, reach = w[i], doc[i], seeds.reach[w[i]]
        start, end = np.maximum(words.first[doc], at[j] - reach + 1), np.minimum(words.first[doc + 1], at[i] + reach)
        new = np.flatnonzero(np.append(True, (np.diff(w) != 0) | (np.diff(doc) != 0) | (start[1:] > end[:-1])))
        yield from zip(doc[new].tolist(), w[new].tolist(), start[new].tolist(), end[np.append(new[1:], len(end)) - 1].tolist())


def whole_copies(words: word_hash.Words, items: Items, lookups: dict[int, Lookup]) -> Iterator[tuple[int, int, int, int]]:
    """(text, row of the item, first word, word after the last) of the short items in texts, each text's first copy of them."""
    for n, lookup in lookups.items():
        place, known = lookup.find(run_hashes(words.hashes, n))
        doc = np.searchsorted(words.first, place, "right") - 1
        inside = place + n <= words.first[doc + 1]
        place, known, doc = place[inside], known[inside], doc[inside]
        _, first = np.unique(np.stack([doc, known]), axis=1, return_index=True)
        for i in first.tolist():
            at = int(place[i] - words.first[doc[i]])
            for row in items.short[n][int(lookup.known[known[i]])]:
                yield int(doc[i]), row, at, at + n


def _texts(
    words: word_hash.Words, items: Items, seeds: Seeds, lookup: Lookup, short: dict[int, Lookup], settings: Settings,
) -> dict[int, list[dict]]:
    """Leaks of each text that has any."""
    best: dict[int, dict[int, tuple[float, int, int]]] = defaultdict(dict)
    for doc, row, start, end in whole_copies(words, items, short):
        best[doc][row] = (1.0, start, end)
    for doc, w, start, stop in regions(words, seeds, lookup):
        word, region = items.words[w], words.hashes[start:stop]
        # No alignment scores more than the item's words that occur here at all.
        if np.isin(word, region).mean() < settings.least_score:
            continue
        score, end = align(word, region)
        share = score / (MATCH * len(word))
        item = int(items.item[w])
        if share >= settings.least_score and share > best[doc].get(item, (0.0,))[0]:
            _, back = align(word[::-1], region[:end][::-1])
            start -= int(words.first[doc])
            best[doc][item] = (share, start + end - back, start + end)
    return {d: [{"item": k, "score": s, "first_word": a, "last_word": b - 1} for k, (s, a, b) in sorted(found.items())] for d, found in best.items()}


def leaks(text: Column, items: Items, seeds: Seeds, settings: Settings) -> Column:
    """Leaked items of a text column: (index of the item, score, first and last word)."""
    kind = pa.list_(pa.struct([("item", pa.int32()), ("score", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64())]))

    @F.arrow_udf(FOUND_DDL)
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lookup = Lookup(seeds.pairs)
        short = {n: Lookup(np.array(sorted(found), np.uint64)) for n, found in items.short.items()}
        for batch in batches:
            found: list[list[dict]] = [[] for _ in range(len(batch))]
            for row, _, words in word_hash.chunks(_lower(batch), TABLE):
                for doc, own in _texts(words, items, seeds, lookup, short, settings).items():
                    found[row + doc] = own
            yield pa.array(found, kind)

    return search(text)


def blocks(benchmark: DataFrame, block_bytes: int, item_id: str, text: str) -> Iterator[list[tuple]]:
    """The distinct items, each with how many rows it has, in blocks of about ``block_bytes``."""
    items = benchmark.select(benchmark[item_id].alias("item_id"), benchmark[text].alias("text")).groupBy("item_id", "text").agg(F.count(F.lit(1)).alias("n"))
    total = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        if rows:
            yield [(r["item_id"], r["text"], r["n"]) for r in rows]


def _searches(
    docs: DataFrame, benchmark: DataFrame, settings: Settings, block_bytes: int, item_id: str, text: str,
) -> Iterator[tuple[Items, list[int], Column]]:
    for rows in blocks(benchmark, block_bytes, item_id, "text"):
        items = items_of(rows, settings)
        if items.words or items.short:
            seeds = seeds_of(items, *pair_counts(docs, items, text), settings)
            yield items, [n for *_, n in rows], leaks(docs[text], items, seeds, settings)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), block_bytes: int = 2 << 20, doc_id: str = "doc_id",
    item_id: str = "item_id", text: str = "text",
) -> DataFrame:
    """One row for each document and item it leaks: (doc_id, item_id, score, first_word, last_word)."""
    kind = benchmark.schema[item_id].dataType.simpleString()
    out = None
    for items, repeats, search in _searches(docs, benchmark, settings, block_bytes, item_id, text):
        rows = docs.select(docs[doc_id].alias("doc_id"), F.explode(search).alias("leak")).select("doc_id", "leak.*")
        names = docs.sparkSession.createDataFrame(list(zip(range(len(repeats)), items.ids, repeats)), f"item int, item_id {kind}, n bigint")
        rows = rows.join(names, "item").withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
        rows = rows.select("doc_id", "item_id", "score", "first_word", "last_word")
        out = rows if out is None else out.unionByName(rows)
    key = docs.schema[doc_id].dataType.simpleString()
    return out if out is not None else docs.sparkSession.createDataFrame(
        [], f"doc_id {key}, item_id {kind}, score double, first_word bigint, last_word bigint")


def drop_leaking(
    docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), block_bytes: int = 2 << 20, item_id: str = "item_id", text: str = "text",
) -> DataFrame:
    """The documents that leak no item, with their columns as they are."""
    kept = docs
    for *_, search in _searches(docs, benchmark, settings, block_bytes, item_id, text):
        kept = kept.filter(F.size(search) == 0)
    return kept
