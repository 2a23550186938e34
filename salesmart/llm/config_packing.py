"""Packing of token sequences by a configuration linear program over the length histogram.

A configuration is a multiset of lengths that fits a sequence. Multiplicative weights solve the program that
covers all pieces with the least configurations: each round prices lengths by how far they lag behind, finds the
best configuration for these prices by dynamic programming (a knapsack), adds as many copies as its scarcest
length allows, and lowers the prices of what it covers. Long pieces are priced in classes of near lengths. Copies are rounded
down and made exact, length by length; what is left, and all short pieces, go where they fit best, into
gaps first and into new sequences then. The program is rounded at several shares of its copies, down to none, which
is best fit alone, and the plan with the fewest sequences is kept: it never needs more than best fit.

The driver sees the histogram alone: at most as many rows as a sequence has tokens, whatever the size of the input,
and its plan is bounded by that and the number of rounds. A piece finds its place in the plan by its length
and its number among the pieces of that length: parts number their own pieces while they tokenize, and counts
of the parts before give the rest, so no length, however common, is gathered in one task.

Defined results: a null or empty text is its end token alone; only documents longer than a sequence are cut;
repeated ids and rows are packed one by one; an empty table packs nothing.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesmart.llm import word_hash
from salesmart.session import settle

#: Letters A to Z count as lowered, which the vocabulary does anyway.
TABLE = word_hash.byte_table(word_hash.SPACES)


@dataclass
class Lists:
    """Lists of ids: all ids one after the other, and each list's length."""

    ids: np.ndarray
    lengths: np.ndarray

    @staticmethod
    def of(lists: list[list[int]]) -> Lists:
        return Lists(np.fromiter(chain.from_iterable(lists), "<u4"), np.array([len(x) for x in lists], np.int64))

    @staticmethod
    def joined(parts: list[Lists]) -> Lists:
        some = [Lists.of([]), *parts]
        return Lists(np.concatenate([x.ids for x in some]), np.concatenate([x.lengths for x in some]))

    def take(self, rows: np.ndarray) -> Lists:
        """The lists of these rows, in this order."""
        lengths = self.lengths[rows]
        upto = np.cumsum(lengths)
        starts = (np.cumsum(self.lengths) - self.lengths)[rows]
        return Lists(self.ids[np.repeat(starts - (upto - lengths), lengths) + np.arange(lengths.sum())], lengths)


@lru_cache(2)
def tokens_of(path: str) -> Tokens:
    """One encoder a worker process, whatever the number of its tasks."""
    return Tokens(path)


class Tokens:
    """Token ids of texts, as little-endian unsigned 32-bit bytes.

    The vocabulary lowers all letters, and its pre-tokenizer drops white space, matches nothing across it and
    cuts words of letters from the marks behind them. So what stands between two ASCII separators is encoded once
    and remembered under its 64-bit hash; a chunk of texts becomes ids by array operations. Words of letters
    are encoded many at a time and told apart by their last tokens.
    """

    def __init__(self, path: str, remembered: int = 1 << 22, chunk_bytes: int = word_hash.CHUNK_BYTES) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks use the cores already
        self.encoder = Tokenizer.from_file(path)
        names = self.encoder.get_vocab()
        self.last = np.zeros(max(names.values()) + 1, bool)
        self.last[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.remembered, self.chunk_bytes = remembered, chunk_bytes
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # of the words, sorted
        self.rows = np.zeros(0, np.int64)  # of each hash
        self.lists = Lists.of([])  # of each row: its ids

    def _plain(self, texts: list[bytes]) -> list[list[int]]:
        return [f.ids for f in self.encoder.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def _letters(self, words: list[bytes], at_once: int = 500) -> Lists:
        """Ids of words of letters."""
        found = []
        for i in range(0, len(words), at_once):
            some = words[i:i + at_once]
            ids = np.array(self.encoder.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(some):
                found.append(Lists(ids, np.diff(ends, prepend=0)))
            else:  # not all were words of letters to the tokenizer
                found.append(Lists.of(self._plain(some)))
        return Lists.joined(found)

    def _learn(self, words: list[bytes]) -> Lists:
        """Ids of words: letters with marks behind them, and others."""
        stems = [w.rstrip(b".,;:!?") for w in words]
        letters = [w for w in dict.fromkeys(stems) if w.isalpha() or normalize("NFC", w.decode()).lower().isalpha()]
        pieces = dict(zip(letters, range(len(letters))))
        # What else there is to encode: words of another kind, and the marks behind those of letters.
        others = [w if stem not in pieces else w[len(stem):] for w, stem in zip(words, stems)]
        rest = list(dict.fromkeys(others))
        number = dict(zip(rest, range(len(letters), len(letters) + len(rest))))
        pool = Lists.joined([self._letters(letters), Lists.of(self._plain(rest)), Lists.of([[]])])
        nothing = len(letters) + len(rest)
        pairs = np.array([[pieces.get(stem, nothing) for stem in stems], [number[o] for o in others]], np.int64).T
        both = pool.take(pairs.ravel())
        return Lists(both.ids, both.lengths.reshape(-1, 2).sum(1))

    def _rows(self, words: word_hash.Words) -> np.ndarray:
        """Each word's row, words new to us added."""
        hashes, at, back = np.unique(words.hashes, return_index=True, return_inverse=True)
        if len(self.hashes) + len(hashes) > self.remembered:
            self.forget()
        place = np.searchsorted(self.hashes, hashes)
        new = np.append(self.hashes, np.uint64(0))[place] != hashes
        new |= place == len(self.hashes)
        if new.any():
            data = words.data.tobytes()
            first = at[new]
            learned = self._learn([data[a:b] for a, b in zip(words.starts[first].tolist(), words.ends[first].tolist())])
            self.rows = np.insert(self.rows, place[new], np.arange(len(self.hashes), len(self.hashes) + len(first)))
            self.hashes = np.insert(self.hashes, place[new], hashes[new])
            self.lists = Lists.joined([self.lists, learned])
        return self.rows[np.searchsorted(self.hashes, hashes)][back]

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text."""
        # A special token counts by its exact letters, and a zero byte is no letter: such texts are encoded as they are.
        odd = pc.fill_null(pc.or_(pc.match_substring(texts, "<|"), pc.match_substring(texts, "\0")), False)
        apart = {i: texts[i].as_py().encode() for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()}
        for low, high, words in word_hash.chunks(pc.if_else(odd, "", texts), TABLE, self.chunk_bytes):
            rows = self._rows(words) if len(words.hashes) else np.zeros(0, np.int64)
            found = self.lists.take(rows)
            bounds = np.append(0, np.cumsum(found.lengths))[words.first].tolist()
            for i, (a, b) in enumerate(zip(bounds, bounds[1:]), low):
                yield np.array(self._plain([apart[i]])[0], "<u4").tobytes() if i in apart else found.ids[a:b].tobytes()


def tokenize(
    docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1, doc_id: str = "doc_id", text: str = "text", ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: (doc_id, piece, start, length, ids_crc32, part, number[, ids]).

    ``number`` counts the pieces of the same length within ``part``.
    """
    key = docs.schema[doc_id].dataType.simpleString()
    ddl = f"doc_id {key}, piece int, start bigint, length bigint, ids_crc32 bigint, part bigint, number bigint" + ", ids binary" * ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(vocabulary)
        end = np.array([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        numbers: dict[int, int] = defaultdict(int)
        for batch in batches:
            kind = batch.schema.field(0).type
            rows: list[tuple] = []
            held = 0
            for name, all_ids in zip(batch.column(0), tokens.encode(batch.column(1))):
                all_ids += end
                for piece, at in enumerate(range(0, len(all_ids), 4 * capacity)):
                    own = all_ids[at:at + 4 * capacity]
                    n = len(own) // 4
                    rows.append((name.as_py(), piece, at // 4, n, zlib.crc32(own), part, numbers[n], own))
                    numbers[n] += 1
                    held += len(own) if ids else 0
                if len(rows) >= 20_000 or held >= 8 << 20:
                    yield _batch(rows, kind, ids)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, kind, ids)

    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(cut, ddl)


def _batch(rows: list[tuple], kind: pa.DataType, ids: bool) -> pa.RecordBatch:
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "number", "ids"][:7 + ids]
    kinds = [kind, pa.int32(), *[pa.int64()] * 5, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds[:7 + ids])][:7 + ids], names=names)


def knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> np.ndarray:
    """How often each size is taken, at the greatest value that fits; sizes may repeat."""
    low, top = int(sizes.min()), int(sizes.max())
    worth, which = np.full(top + 1, -np.inf), np.full(top + 1, -1)  # of each size the most valuable
    order = np.argsort(values, kind="stable")
    worth[sizes[order]], which[sizes[order]] = values[order], order
    worth, span = worth[low:], top - low + 1
    back = np.zeros(capacity + 1)  # best[room], the greatest room first
    taken = [-1] * (capacity + 1)
    last = 0.0
    for room in range(low, capacity + 1):
        at = capacity - room
        got = back[at + low:at + low + span] + worth[:room - low + 1]
        k = int(got.argmax())
        if got[k] > last:
            last = float(got[k])
            taken[room] = int(which[low + k])
        back[at] = last
    counts, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if taken[room] < 0:
            room -= 1
        else:
            counts[taken[room]] += 1
            room -= sizes[taken[room]]
    return counts


def configurations(
    sizes: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = 400, rate: float = 0.5, near: float = 0.002,
) -> tuple[np.ndarray, np.ndarray]:
    """(configurations, copies) that cover the counts, fractional, by multiplicative weights.

    Prices start in proportion to the sizes. Rounds end early where no solution could be better by a share of ``near``.
    """
    least = max(sizes @ counts / capacity, counts[2 * sizes > capacity].sum())
    price = sizes / capacity
    cover = np.zeros(len(sizes))
    found: dict[tuple, float] = defaultdict(float)
    total = 0.0
    for _ in range(rounds):
        taken = knapsack(sizes, price, capacity)
        used = taken > 0
        if not used.any():
            break
        step = (counts[used] / taken[used]).min()
        share = taken * step / counts
        cover += share
        found[tuple(taken)] += step
        total += step
        if cover.min() > 0 and total / cover.min() <= (1 + near) * least:
            break
        # A length's price tells how far its cover lags behind: lowered by what it got, relative to the sizes.
        price = price * np.exp(-rate * share)
        price /= (price * capacity / sizes).max()
    table = np.array(list(found), np.int64).reshape(-1, len(sizes))
    return table, np.array(list(found.values())) / max(cover.min(), 1.0)


@dataclass
class Pattern:
    """Sequences with the same lengths in them: how many, {length: pieces}, and the room left in each."""

    copies: int
    held: dict[int, int]
    room: int


def plan(
    histogram: dict[int, int], capacity: int, classes: int = 1024, short: int = 16, units: int = 1024, shares: tuple[float, ...] = (1.0, 0.5, 0.0),
) -> list[Pattern]:
    """Patterns that hold every piece of the histogram {length: pieces}, the fewest of those that ``shares`` of the program give.

    Lengths from ``capacity / short`` on are grouped into ``classes`` for the program, which counts in ``units`` to a
    sequence, or in tokens if a sequence has fewer.
    """
    unit = -(-capacity // units)
    left = {n: c for n, c in histogram.items() if c > 0}
    whole = [Pattern(left.pop(capacity), {capacity: 1}, 0)] if capacity in left else []
    long = np.array(sorted(n for n in left if n >= max(1, capacity // short)), np.int64)
    if not len(long):
        return _fill(whole, left, capacity)
    amount = np.array([left[n] for n in long])
    group = np.minimum((np.cumsum(amount) - amount) * classes // amount.sum(), classes - 1)
    names = np.unique(group)
    tops = np.array([long[group == g].max() for g in names])
    counts = np.array([amount[group == g].sum() for g in names])
    members = [long[group == g].tolist() for g in names]
    program = configurations(-(-tops // unit), counts, capacity // unit)
    least = max(-(-sum(n * c for n, c in left.items()) // capacity), sum(c for n, c in left.items() if 2 * n > capacity))
    best, fewest = [], -1
    for share in shares:
        found = _rounded(*program, share, counts, members, dict(left), capacity)
        needed = sum(p.copies for p in found)
        if fewest < 0 or needed < fewest:
            best, fewest = found, needed
        if fewest == least:
            break
    return whole + best


def _rounded(
    table: np.ndarray, copies: np.ndarray, share: float, counts: np.ndarray, members: list[list[int]], left: dict[int, int], capacity: int,
) -> list[Pattern]:
    """A share of the program's copies, rounded down and made exact, and the rest where it fits best."""
    # Each class hands out its lengths from the longest on, in runs of equal ones.
    stock = [[[n, left[n]] for n in own] for own in members]
    rest = counts.copy()
    patterns: list[Pattern] = []
    for c in np.argsort(-copies, kind="stable"):
        used = table[c] > 0
        whole = int(min(np.floor(share * copies[c] + 1e-9), (rest[used] // table[c][used]).min()))
        rest -= table[c] * whole
        slots = [int(g) for g in np.flatnonzero(used) for _ in range(table[c][g])]
        patterns += _exact(slots, whole, stock, left, capacity)
    return _fill(patterns, left, capacity)


def _exact(slots: list[int], copies: int, stock: list[list[list[int]]], left: dict[int, int], capacity: int) -> list[Pattern]:
    """``copies`` of a configuration of classes, as patterns of exact lengths taken from the stock."""
    patterns = []
    drawn = {}  # each slot draws its own run of pieces: (length, pieces) from the longest on
    for i, g in enumerate(slots):
        need, runs = copies, []
        while need:
            n, have = stock[g][-1]
            got = min(need, have)
            runs.append([n, got])
            left[n] -= got
            need -= got
            stock[g][-1][1] -= got
            if not stock[g][-1][1]:
                stock[g].pop()
        drawn[i] = runs[::-1]
    while copies:
        same = min(runs[-1][1] for runs in drawn.values())
        held: dict[int, int] = defaultdict(int)
        for runs in drawn.values():
            held[runs[-1][0]] += 1
            runs[-1][1] -= same
            if not runs[-1][1]:
                runs.pop()
        patterns.append(Pattern(same, dict(held), capacity - sum(n * k for n, k in held.items())))
        copies -= same
    return patterns


def _fill(patterns: list[Pattern], left: dict[int, int], capacity: int) -> list[Pattern]:
    """All pieces left put where they fit best, the longest first; gaps come before new sequences."""
    by_room: list[list[Pattern]] = [[] for _ in range(capacity + 1)]
    for p in patterns:
        by_room[p.room].append(p)

    def put(p: Pattern, copies: int, n: int, k: int) -> None:
        by_room[p.room - n * k].append(Pattern(copies, {**p.held, n: p.held.get(n, 0) + k}, p.room - n * k))

    for n in sorted((n for n, c in left.items() if c), reverse=True):
        need = left[n]
        for room in range(n, capacity + 1):
            while need and by_room[room]:
                p = by_room[room].pop()
                most = room // n
                whole = min(p.copies, need // most)
                if whole:
                    put(p, whole, n, most)
                need -= whole * most
                rest = p.copies - whole
                if rest and need:  # fewer are left than one sequence could take
                    put(p, 1, n, need)
                    rest, need = rest - 1, 0
                if rest:
                    by_room[room].append(Pattern(rest, p.held, room))
                    break
            if not need:
                break
        if need:
            most = capacity // n
            empty = Pattern(0, {}, capacity)
            if need // most:
                put(empty, need // most, n, most)
            if need % most:
                put(empty, 1, n, need % most)
    return [p for room in by_room for p in room]


def _slots(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """Where the pieces of each length go: runs of numbers, by (length, first number)."""
    next_number: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for p in patterns:
        offset = 0
        for n, k in sorted(p.held.items(), reverse=True):
            rows.append((n, next_number[n], k, sequence, offset))
            next_number[n] += p.copies * k
            offset += n * k
        sequence += p.copies
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "each", "sequence", "offset"), table.T))


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """Settled ``pieces`` (length, part, number and others) with ``sequence_id`` and ``offset`` for part and number."""
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = _slots(plan(histogram, capacity))
    numbered = pieces.join(earlier, ["part", "length"]).withColumn("number", F.col("number") + F.col("earlier")).drop("part", "earlier")
    kept = [c for c in numbered.columns if c != "number"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Runs by one sortable number: the length above, the first number below.
        start = np.unique(slots["length"], return_index=True)
        for batch in batches:
            length, number = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("length", "number"))
            low = start[1][np.searchsorted(start[0], length)]
            high = np.append(start[1], len(slots["length"]))[np.searchsorted(start[0], length) + 1]
            while (high - low > 1).any():  # all rows' binary searches at once
                middle = (low + high) // 2
                right = slots["first"][middle] <= number
                low, high = np.where(right & (high - low > 1), middle, low), np.where(right | (high - low <= 1), high, middle)
            copy, place_in = np.divmod(number - slots["first"][low], slots["each"][low])
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(slots["sequence"][low] + copy), pa.array(slots["offset"][low] + place_in * length)],
                names=[*kept, "sequence_id", "offset"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema if f.name != "number")
    return numbered.mapInArrow(place, f"{ddl}, sequence_id bigint, offset bigint")


def pack_documents(
    docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1, doc_id: str = "doc_id", text: str = "text", ids: bool = False,
) -> DataFrame:
    """One row a piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids])."""
    pieces = settle(tokenize(docs, vocabulary, capacity, end_id, doc_id, text, ids), "pieces")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * ids
    return pack(pieces, capacity).select(*columns)
