"""Quality rules by compression: zstandard ratios of whole documents and of fixed chunks.

A ratio is uncompressed over compressed bytes. Text that repeats itself compresses too well, random text
hardly at all, and what is normal depends on the length, so each length has its own limits. A first pass learns
what is usual: the quartiles of the logarithm of the ratio over all distinct texts of nearly the same length, and over
all distinct chunks. A second pass counts words, symbols and repeats and compares each text and its chunks with the
limits around these quartiles, and with wide fixed bands that no corpus moves.

The quartiles are counted in Spark; a row for each quarter octave of lengths comes to the driver. Copies count once, so
no group of copies moves the limits, and the limits of a length with few texts are wider.

Defined results: a null text counts as empty, and an empty or short text fails the base rule (too few words). Texts shorter
than the first band are not judged by their ratio; texts of any length are read as a whole. Equal texts get
the same verdict whatever their ids, and an empty table gives an empty result. A column of the result's name is replaced.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What separates words, what counts as a symbol.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"

#: (from this many bytes on, least ratio, greatest ratio). Prose of 300 bytes reaches 1.3 to 2, of 30 kB 2.3 to 3; repeated
#: lines and words pass 8, encoded or random text stays near 1.
BANDS = ((128, 0.95, 4.0), (512, 1.2, 5.0), (2048, 1.45, 7.0), (8192, 1.55, 9.0), (65536, 1.65, 12.0))

VERDICT = pa.struct([
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("ratio", pa.float64()),
    ("bad_chunk_share", pa.float64()),
])
VERDICT_DDL = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, ratio double, bad_chunk_share double"
)


@dataclass(frozen=True)
class Limits:
    """What a document must keep to.

    A document fails if its whole ratio leaves the limits of its length, or if more than ``bad_share`` of its
    bytes lie in chunks of ``chunk_bytes`` that leave theirs. Limits lie ``spread`` standard deviations, as the quartiles tell them,
    around the median logarithm of a length's ratios, further by a share of ``unsure / sqrt(n)`` where n texts tell them.
    """

    least_words: int = 50
    repeat_percent: int = 50
    bands: tuple[tuple[int, float, float], ...] = BANDS
    chunk_bytes: int = 4096
    bad_share: float = 0.4
    level: int = 3
    spread: float = 4.0
    least_deviation: float = 0.02
    unsure: float = 2.0
    lengths_an_octave: int = 4


#: Limits of a kind of piece (whole texts or chunks) and a class of lengths: least and greatest ratio.
Usual = dict[tuple[bool, int], tuple[float, float]]
BINS = 500  # of a ratio's logarithm, to one


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more, first findings included."""
    if len(words) < 4:
        return 0
    found = Counter(zip(words, words[1:], words[2:]))
    if len(found) == len(words) - 2:
        return 0
    again = np.fromiter(map(found.__getitem__, zip(words, words[1:], words[2:])), np.int64, len(words) - 2) > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:len(words) - 2 + shift] |= again
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line of the text."""
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def outside(ratio: float, size: int, bands: tuple[tuple[int, float, float], ...]) -> bool:
    """Whether a ratio leaves the band for texts of this size."""
    for start, least, most in reversed(bands):
        if size >= start:
            return not least <= ratio <= most
    return False


def length_class(size: int, limits: Limits) -> int:
    return math.floor(limits.lengths_an_octave * math.log2(size))


def pieces(text: bytes, limits: Limits, pack) -> list[tuple[bool, int, float]]:
    """(whether a chunk, bytes, ratio) of a text as a whole and, if it has several, of its chunks."""
    cuts = [text[i:i + limits.chunk_bytes] for i in range(0, len(text), limits.chunk_bytes)]
    found = [(False, len(text), len(text) / len(pack(text)))] if text else []
    return found + [(True, len(c), len(c) / len(pack(c))) for c in cuts if len(cuts) > 1]


def _packer(limits: Limits):
    return zstandard.ZstdCompressor(level=limits.level, write_content_size=False, write_checksum=False).compress


def _bytes(texts: pa.Array) -> Iterator[bytes]:
    return (x.as_buffer().to_pybytes() if x.is_valid else b"" for x in texts.cast(pa.large_binary()))


def usual(docs: DataFrame, limits: Limits = Limits(), text: str = "text") -> Usual:
    """The limits that the distinct texts of ``docs`` give to each class of lengths; one pass over them."""
    least = limits.bands[0][0]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = _packer(limits)
        for batch in batches:
            rows = [
                (name, chunk, length_class(size, limits), round(BINS * math.log(ratio)))
                for name, own in zip(batch.column(0).to_pylist(), _bytes(batch.column(1)))
                for chunk, size, ratio in pieces(own, limits, pack) if size >= least
            ]
            columns = list(zip(*rows)) or [()] * 4
            kinds = (pa.int64(), pa.bool_(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["hash", "chunk", "length", "bin"])

    texts = docs.select(F.xxhash64(docs[text]).alias("hash"), docs[text].alias("text"))
    found = texts.mapInArrow(measure, "hash bigint, chunk boolean, length int, bin int").distinct()
    counts = found.groupBy("chunk", "length", "bin").agg(F.count(F.lit(1)).alias("n"))
    quartiles = F.percentile("bin", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n"))
    rows = counts.groupBy("chunk", "length").agg(quartiles.alias("at"), F.sum("n").alias("n")).collect()  # a row a class
    out = {}
    for r in rows:
        low, middle, high = (x / BINS for x in r["at"])
        # Quartiles of a normal distribution lie 1.349 standard deviations apart.
        reach = limits.spread * max((high - low) / 1.349, limits.least_deviation) * (1 + limits.unsure / math.sqrt(r["n"]))
        out[r["chunk"], r["length"]] = math.exp(middle - reach), math.exp(middle + reach)
    return out


def _leaves(piece: tuple[bool, int, float], limits: Limits, known: Usual) -> bool:
    chunk, size, ratio = piece
    if size < limits.bands[0][0]:
        return False
    least, most = known.get((chunk, length_class(size, limits)), (0.0, math.inf))
    return not least <= ratio <= most or outside(ratio, size, limits.bands)


def _judge(text: bytes, limits: Limits, pack, known: Usual) -> tuple:
    words = text.split()  # on bytes: exactly the six ASCII separators
    n = len(words)
    repeats = repeated_words(words)
    failed = n < limits.least_words or 100 * repeats > limits.repeat_percent * n
    found = pieces(text, limits, pack)
    left = [_leaves(p, limits, known) for p in found]
    ratio, whole = (found[0][2], left[0]) if found else (0.0, False)
    chunks = found[1:] or found
    share = sum(p[1] for p, out in zip(chunks, left[1:] or left) if out) / len(text) if text else 0.0
    kept = not failed and not whole and share <= limits.bad_share
    return (
        n, len(text.translate(None, SPACES + bytes(range(0x80, 0xC0)))), len(text) - len(text.translate(None, SYMBOLS)),
        repeated_lines(text), repeats, failed, kept, ratio, share,
    )


def quality(text: Column, known: Usual, limits: Limits = Limits()) -> Column:
    """Counts, ratios and verdict of a text column under the limits of ``usual``, as a struct (see ``VERDICT_DDL``)."""

    @F.arrow_udf(VERDICT_DDL)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pack = _packer(limits)
        for batch in batches:
            columns = list(zip(*(_judge(x, limits, pack, known) for x in _bytes(batch)))) or [()] * len(VERDICT)
            yield pa.StructArray.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, VERDICT)], fields=list(VERDICT))

    return judge(text)


def score_documents(docs: DataFrame, limits: Limits = Limits(), text: str = "text", into: str = "quality") -> DataFrame:
    """``docs`` with the struct of ``quality`` as one more column, whatever other columns there are."""
    return docs.withColumn(into, quality(docs[text], usual(docs, limits, text), limits))


def keep_good(docs: DataFrame, limits: Limits = Limits(), text: str = "text") -> DataFrame:
    """The documents that pass, with their columns as they are."""
    return docs.filter(quality(docs[text], usual(docs, limits, text), limits)["kept"])
