"""Byte-level BPE by an index of pair occurrences.

Texts are cut into pieces as the vocabulary's pattern does, by array operations on classes of characters. The different
pieces of a part of a partition stand side by side as one array of symbols with links to their neighbours. An
index maps each adjacent pair to all of its positions. The active ranks are taken in ascending order: all positions of the
rank's pair are merged at once, and only the pairs beside them are looked up again and added to the lists of
their ranks. A pair that holds a merged symbol always ranks after the merge that makes the symbol (checked when the
vocabulary is read), so one sweep over all pieces makes the same merges as a search in each of them.

Ids of pieces are remembered under 64-bit hashes. Decoding joins the bytes of the ids, and where these differ from
the text, two pieces shared a hash and the text is encoded again without the memory.

A partition is worked through in parts of ``chunk_bytes`` of text, or of one text if that is longer, with about
60 bytes of memory for each of its bytes; no text is cut. Nothing is shuffled.

Defined results: a null text is an empty one, which has no tokens; bytes that are no UTF-8 become U+FFFD before all else; special
tokens in a text are found by their exact letters, before anything else is cut; repeated ids and rows are encoded
one by one; an empty table gives no rows; the result has its own columns only, whatever others there are.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from salesmart.llm import word_hash
from salesmart.llm.config_packing import Lists

OTHER, LETTER, NUMBER, SPACE = range(4)
#: The characters that count as white space, and what may follow an apostrophe as a piece of its own.
WHITE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of each code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[list(WHITE)] = SPACE
    return table


def piece_starts(points: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each character of texts that stand side by side; ``begins`` marks their first ones.

    The pattern's pieces are a suffix behind an apostrophe; a run of letters, of numbers or of other marks, each with one
    space before it, if there is one; and the white space that is left.
    """
    kind = classes()[points]
    starts = begins.copy()
    starts[1:] |= kind[1:] != kind[:-1]
    # The last white space of a run goes with what follows if it is a space, and else is a piece.
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~begins[1:])
    starts[last] = True
    starts[last[points[last] == 0x20] + 1] = False
    at = np.flatnonzero((points == ord("'")) & starts)
    ends = np.append(np.flatnonzero(begins), len(points))
    limit = ends[np.searchsorted(ends, at, "right")]
    taken = np.zeros(len(at), bool)
    for suffix in SUFFIXES:
        fits = ~taken & (at + len(suffix) < limit)
        for k, letter in enumerate(suffix, 1):
            fits[fits] = points[at[fits] + k] == ord(letter)
        starts[at[fits] + 1] = False
        after = at[fits] + 1 + len(suffix)
        starts[after[after < len(points)]] = True
        taken |= fits
    return starts


def byte_letters() -> dict[str, int]:
    """The letters by which vocabularies of this kind write bytes: printable ones stand for themselves, others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    """One a worker process, whatever the number of its tasks."""
    return Vocabulary(path)


@dataclass
class Merges:
    """Pairs of symbols by rank, and what they become; a pair's key tells its rank."""

    left: np.ndarray
    right: np.ndarray
    made: np.ndarray
    symbols: int

    def __post_init__(self) -> None:
        n = len(self.made)
        born = np.full(self.symbols, -1, np.int64)
        born[self.made] = np.arange(n)
        if len(np.unique(self.made)) < n or (born[self.left] >= np.arange(n)).any() or (born[self.right] >= np.arange(n)).any():
            raise ValueError("a pair ranks before the merge that makes one of its symbols")
        keys = self.left * np.int64(self.symbols) + self.right
        self.ranks = np.append(np.argsort(keys), n)
        self.keys = np.append(keys[self.ranks[:-1]], np.iinfo(np.int64).max)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or the number of merges if it has none."""
        keys = left * np.int64(self.symbols) + right
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.ranks[at], len(self.made))

    def apply(self, symbols: np.ndarray, lengths: np.ndarray) -> Lists:
        """Symbols of pieces side by side, merged as far as they go."""
        n, none = len(symbols), len(self.made)
        if not n:
            return Lists(np.zeros(0, "<u4"), np.zeros(len(lengths), np.int64))
        symbols = np.append(symbols.astype(np.int64), -1)  # the place behind the last one is nobody's
        ends = np.cumsum(lengths)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        filled = lengths > 0
        after[ends[filled] - 1], before[(ends - lengths)[filled]] = n, n
        before[n] = after[n] = n
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(places: np.ndarray) -> None:
            """Put the pairs that begin at these places into the lists of their ranks."""
            ranks = self.rank(symbols[places], symbols[after[places]])
            if len(places) > 1:
                order = np.argsort(ranks, kind="stable")
                places, ranks = places[order], ranks[order]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
            for low, high in zip(cuts, cuts[1:]):
                rank = int(ranks[low]) if high > low else none
                if rank == none:
                    continue
                if rank not in index:
                    index[rank] = []
                    heappush(active, rank)
                index[rank].append(places[low:high])

        add(np.flatnonzero(after[:n] != n))
        while active:
            rank = heappop(active)
            lists = index.pop(rank)
            places = np.sort(np.concatenate(lists))
            places = places[np.append(True, places[1:] != places[:-1])]
            a, b = self.left[rank], self.right[rank]
            partner = after[places]
            there = (symbols[places] == a) & (symbols[partner] == b)  # others have been merged meanwhile
            places, partner = places[there], partner[there]
            if a == b and len(places) > 1:  # of overlapping pairs every second one, from the left
                head = np.append(True, partner[:-1] != places[1:])
                number = np.arange(len(places))
                odd = (number - np.maximum.accumulate(np.where(head, number, 0))) % 2 == 1
                places, partner = places[~odd], partner[~odd]
            if not len(places):
                continue
            follower = after[partner]
            symbols[places], symbols[partner] = self.made[rank], -1
            after[places], before[follower] = follower, places
            beside = np.concatenate([before[places], places[follower != n]])
            add(beside[beside != n])
        alive = symbols[:n] >= 0
        upto = np.append(0, np.cumsum(alive))
        return Lists(symbols[:n][alive].astype("<u4"), upto[ends] - upto[ends - lengths])


class Vocabulary:
    """Encoder and decoder of a vocabulary file of the tokenizers library (byte-level BPE)."""

    def __init__(self, path: str, remembered: int = 1 << 22, chunk_bytes: int = 4 << 20) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        unusual = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(k)]
        added = spec["added_tokens"]
        if model["type"] != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
            raise ValueError("not a byte-level BPE vocabulary")
        if unusual or spec["normalizer"] or any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError(f"not supported: {unusual or 'normalizer or changed added tokens'}")
        names = model["vocab"]
        letters = byte_letters()
        size = max([*names.values(), *(t["id"] for t in added)]) + 1
        tokens = [b""] * size
        for name, i in names.items():
            tokens[i] = bytes(letters[c] for c in name)
        for t in added:
            tokens[t["id"]] = t["content"].encode()
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.symbol = np.full(256, -1, np.int64)
        for letter, b in letters.items():
            self.symbol[b] = names.get(letter, -1)
        if (self.symbol < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right, made = (np.array([names[f(p)] for p in pairs], np.int64) for f in (lambda p: p[0], lambda p: p[1], "".join))
        self.merges = Merges(left, right, made, size)
        self.special = {t["content"]: t["id"] for t in added}
        self.finder = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if added else None
        self.remembered, self.chunk_bytes = remembered, chunk_bytes
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # of pieces, sorted
        self.rows = np.zeros(0, np.int64)  # of each hash
        self.lists = Lists.of([])  # of each row: its ids

    def _merged(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Lists:
        """Ids of the pieces at these places."""
        lengths = ends - starts
        return self.merges.apply(self.symbol[_gather(data, starts, lengths)], lengths)

    def _remembered(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Lists:
        """The same, with pieces that were met before looked up."""
        hashes, at, back = np.unique(word_hash._hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) + len(hashes) > self.remembered:
            self.forget()
        place = np.searchsorted(self.hashes, hashes)
        new = np.append(self.hashes, np.uint64(0))[place] != hashes
        new |= place == len(self.hashes)
        if new.any():
            learned = self._merged(data, starts[at[new]], ends[at[new]])
            self.rows = np.insert(self.rows, place[new], np.arange(len(self.hashes), len(self.hashes) + len(learned.lengths)))
            self.hashes = np.insert(self.hashes, place[new], hashes[new])
            self.lists = Lists.joined([self.lists, learned])
        return self.lists.take(self.rows[np.searchsorted(self.hashes, hashes)][back])

    def _cut(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where pieces start (in bytes), and of special tokens the place among them and the id; texts end at ``bounds``."""
        raw = data.tobytes()
        points = data if len(data) and data.max() < 0x80 else np.frombuffer(raw.decode().encode("utf-32-le"), "<u4")
        wide = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
        place = np.cumsum(wide, dtype=np.int64) - wide
        special: list[tuple[int, int, int]] = []
        if self.finder is not None and any(s.encode() in raw for s in self.special):
            for low, high in zip(bounds, bounds[1:]):
                text = raw[low:high].decode()
                special += [(low + len(text[:m.start()].encode()), len(m[0].encode()), self.special[m[0]]) for m in self.finder.finditer(text)]
        cuts = np.array([x for at, n, _ in special for x in (at, at + n)], np.int64)
        edges = np.unique(np.concatenate([bounds[:-1], cuts]))
        begins = np.zeros(len(points), bool)
        begins[np.searchsorted(place, edges[edges < len(data)])] = True
        starts = place[piece_starts(points, begins)]
        own = np.array([at for at, _, _ in special], np.int64)
        if len(own):  # nothing starts within a special token
            inside = np.searchsorted(own, starts, "right") - 1
            stop = own + np.array([n for _, n, _ in special])
            starts = starts[(inside < 0) | (starts == own[inside]) | (starts >= stop[inside])]
        return starts, np.searchsorted(starts, own), np.array([i for _, _, i in special], np.int64)

    def _encode(self, data: np.ndarray, bounds: np.ndarray, remember: bool) -> Lists:
        """Ids of each text of a chunk."""
        if not len(data):
            return Lists(np.zeros(0, "<u4"), np.zeros(len(bounds) - 1, np.int64))
        starts, special, ids = self._cut(data, bounds)
        ends = np.append(starts[1:], len(data))
        plain = np.ones(len(starts), bool)
        plain[special] = False
        found = (self._remembered if remember else self._merged)(data, starts[plain], ends[plain])
        if len(special):
            lengths = np.ones(len(starts), np.int64)
            lengths[plain] = found.lengths
            upto = np.cumsum(lengths) - lengths
            every = np.zeros(lengths.sum(), "<u4")
            others = np.ones(len(every), bool)
            others[upto[special]] = False
            every[upto[special]], every[others] = ids, found.ids
            found = Lists(every, lengths)
        upto = np.append(0, np.cumsum(found.lengths))
        return Lists(found.ids, np.diff(upto[np.searchsorted(starts, bounds)]))

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids."""
        ids = ids.astype(np.int64)
        return _gather(self.bytes, self.first[ids], self.lengths[ids])

    def round_trips(self, texts: pa.Array) -> Iterator[tuple[bytes, bytes]]:
        """(ids, bytes that they decode to) of each text."""
        for data, bounds in _chunks(texts, self.chunk_bytes):
            found = self._encode(data, bounds, True)
            at = np.append(0, np.cumsum(found.lengths))
            back = self.decode(found.ids)
            wide = np.append(0, np.cumsum(self.lengths[found.ids]))[at]
            for i in range(len(bounds) - 1):
                ids, text = found.ids[at[i]:at[i + 1]], back[wide[i]:wide[i + 1]]
                own = data[bounds[i]:bounds[i + 1]]
                if not np.array_equal(text, own):  # two pieces of the same hash
                    ids = self._encode(own, np.array([0, len(own)]), False).ids
                    text = self.decode(ids)
                yield ids.tobytes(), text.tobytes()


def _gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices of ``data``, one after the other."""
    upto = np.cumsum(lengths)
    return data[np.repeat(starts - (upto - lengths), lengths) + np.arange(lengths.sum())]


def _chunks(texts: pa.Array, chunk_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, bounds of the texts) of a few texts at a time; nulls are empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + chunk_bytes, "right")) - 1)
        own, bounds = data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
        try:
            own.tobytes().decode()
        except UnicodeDecodeError:
            mended = [own[a:b].tobytes().decode("utf-8", "replace").encode() for a, b in zip(bounds, bounds[1:])]
            own, bounds = np.frombuffer(b"".join(mended), np.uint8), np.append(0, np.cumsum([len(m) for m in mended]))
        yield own, bounds
        low = high


def _text(data: bytes) -> str:
    return data.decode("utf-8", "replace")


def round_trip(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids as little-endian unsigned 32-bit integers, decoded text) of each document."""
    key = docs.schema[doc_id].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            low, ids, texts, held = 0, [], [], 0
            for i, (own, back) in enumerate(words.round_trips(batch.column(1)), 1):
                ids.append(own)
                texts.append(_text(back))
                held += len(own) + len(back)
                if held >= 2 * words.chunk_bytes or i == batch.num_rows:
                    names = batch.column(0).slice(low, i - low)
                    yield pa.RecordBatch.from_arrays([names, pa.array(ids, pa.binary()), pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])
                    low, ids, texts, held = i, [], [], 0

    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(encode, f"doc_id {key}, ids binary, decoded string")


def decode_documents(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """(all columns but ``ids``, text): ids as :func:`round_trip` gives them, back to texts; a null stays null."""
    rest = [c for c in encoded.columns if c != ids]
    ddl = ", ".join([*(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in rest), "text string"])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            texts = [None if x is None else _text(words.decode(np.frombuffer(x, "<u4")).tobytes()) for x in batch.column(len(rest)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(rest)], pa.array(texts, pa.string())], names=[*rest, "text"])

    return encoded.select(*[encoded[c] for c in rest], encoded[ids]).mapInArrow(decode, ddl)
