"""Hard negatives of anchors by exact inner products: Strassen's multiplication on tiles, then mergeable heaps.

Rows and anchors are dealt by a hash into cells of bounded size, each of which holds some anchors and some rows, and all
cells together every pair of an anchor and a row. A cell multiplies its anchors with its rows tile by tile. Strassen's
recursion needs seven products of half the size in place of eight; odd sides are padded with zeros, and
all of it is 64-bit integers, so a score is exact whatever the tiles are. A tile's best are merged into the cell's
heaps, and the cells' heaps by a ranking that each task cuts down before it shuffles.

There are two rounds. The first multiplies anchors and rows of the same label and finds the positives. The
second multiplies all and finds, for each anchor and positive, the best rows of other labels whose
score lies in the window that the positive's score opens.

Defined results: rows with a null id or label, with a null vector, or with a null or non-finite component take no part, nor do
those whose scaled vector has a squared length of 2**56 or more, as its scores may not fit 64 bits. Of rows with the same
id the one with the least (label, scaled vector) counts, once. Vectors of unequal lengths are padded with zeros.
Equal scores are ranked by id. An anchor without positives, or a positive without a row in its window, returns
nothing. Empty tables give empty results. Further columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesmart.session import settle

NEVER = -np.iinfo(np.int64).max  # below all scores, and its negative is an integer too
LONGEST = float(2**56)


@dataclass(frozen=True)
class Settings:
    """What to mine, and the size of cells and tiles, which change the work but not the result."""

    scale: int = 256
    positives: int = 5
    negatives: int = 3
    low_percent: int = 50  # of the positive's score; a negative's score is at least that
    high_percent: int = 95  # and this at most
    anchor_values: int = 1 << 16  # numbers in a cell's anchors
    row_values: int = 1 << 20  # and in its rows
    least_rows: int = 1024  # of a cell, where more cells would only keep cores busy
    tile: int = 2048
    leaf: int = 32


def multiply(a: np.ndarray, b: np.ndarray, leaf: int = 32) -> np.ndarray:
    """Product of two matrices of 64-bit integers by Strassen's recursion, down to sides of ``leaf``."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:  # zeros add nothing
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
        return multiply(a, b, leaf)[:m, :n]
    a11, a12, a21, a22 = a[:m // 2, :k // 2], a[:m // 2, k // 2:], a[m // 2:, :k // 2], a[m // 2:, k // 2:]
    b11, b12, b21, b22 = b[:k // 2, :n // 2], b[:k // 2, n // 2:], b[k // 2:, :n // 2], b[k // 2:, n // 2:]
    p1 = multiply(a11 + a22, b11 + b22, leaf)
    p2 = multiply(a21 + a22, b11, leaf)
    p3 = multiply(a11, b12 - b22, leaf)
    p4 = multiply(a22, b21 - b11, leaf)
    p5 = multiply(a11 + a12, b22, leaf)
    p6 = multiply(a21 - a11, b11 + b12, leaf)
    p7 = multiply(a12 - a22, b21 + b22, leaf)
    out = np.empty((m, n), np.int64)
    out[:m // 2, :n // 2] = p1 + p4 - p5 + p7
    out[:m // 2, n // 2:] = p3 + p5
    out[m // 2:, :n // 2] = p2 + p4
    out[m // 2:, n // 2:] = p1 - p2 + p3 + p6
    return out


@dataclass
class Heaps:
    """The best few (score, id) of each of some lists, best first; places not taken hold ``NEVER``."""

    scores: np.ndarray
    ids: np.ndarray

    @staticmethod
    def empty(lists: int, size: int) -> Heaps:
        return Heaps(np.full((lists, size), NEVER), np.full((lists, size), np.iinfo(np.int64).max))

    def merge(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Add candidates (one row of them for each of the lists ``rows``)."""
        size = self.scores.shape[1]
        scores, ids = np.hstack([self.scores[rows], scores]), np.hstack([self.ids[rows], ids])
        order = np.lexsort((ids, -scores))[:, :size]
        taken = np.take_along_axis(scores, order, 1)
        self.scores[rows], self.ids[rows] = taken, np.take_along_axis(ids, order, 1)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, id, score) of what they hold."""
        which, place = np.nonzero(self.scores != NEVER)
        return which, self.ids[which, place], self.scores[which, place]


@dataclass
class Vectors:
    """Rows of a cell, by id: ids, labels and a matrix."""

    ids: np.ndarray
    labels: np.ndarray
    matrix: np.ndarray

    @staticmethod
    def of(table: pa.Table, wide: int) -> Vectors:
        table = table.combine_chunks()
        ids = table["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        lists = table["vector"].chunk(0) if table["vector"].num_chunks else pa.array([], pa.list_(pa.int64()))
        lengths = np.diff(lists.offsets.to_numpy())
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        matrix = np.zeros((len(ids), wide), np.int64)
        matrix[np.arange(wide) < lengths[:, None]] = values
        return Vectors(ids[order], table["label"].to_numpy()[order], matrix[order])


def _wide(*tables: pa.Table) -> int:
    return max([1, *(n for t in tables for n in pc.list_value_length(t["vector"]).to_pylist())])


def best_of_tile(scores: np.ndarray, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``size`` best of each row (at most), best first; columns are in order of their ids."""
    size = min(size, scores.shape[1])
    order = np.argsort(-scores, axis=1, kind="stable")[:, :size]
    return np.take_along_axis(scores, order, 1), ids[order]


def positives_of(anchors: Vectors, rows: Vectors, settings: Settings) -> Heaps:
    """For each anchor the best other rows of its label."""
    heaps = Heaps.empty(len(anchors.ids), settings.positives)
    for label in np.intersect1d(anchors.labels, rows.labels).tolist():
        own, others = np.flatnonzero(anchors.labels == label), np.flatnonzero(rows.labels == label)
        for low in range(0, len(others), settings.tile):
            part = others[low:low + settings.tile]
            scores = multiply(anchors.matrix[own], rows.matrix[part].T, settings.leaf)
            itself = anchors.ids[own][:, None] == rows.ids[part][None, :]
            scores[itself] = NEVER
            best, ids = best_of_tile(scores, rows.ids[part], settings.positives)
            heaps.merge(own, best, ids)
    return heaps


def negatives_of(anchors: Vectors, rows: Vectors, owner: np.ndarray, positive_scores: np.ndarray, settings: Settings) -> Heaps:
    """For each positive (of the anchor ``owner``) the best rows of other labels within its window."""
    heaps = Heaps.empty(len(owner), settings.negatives)
    lowest, highest = -(-settings.low_percent * positive_scores // 100), settings.high_percent * positive_scores // 100
    by_owner = np.argsort(owner, kind="stable")
    first = np.searchsorted(owner[by_owner], np.arange(len(anchors.ids) + 1)).tolist()
    for low in range(0, len(rows.ids), settings.tile):
        ids = rows.ids[low:low + settings.tile]
        scores = multiply(anchors.matrix, rows.matrix[low:low + settings.tile].T, settings.leaf)
        scores[anchors.labels[:, None] == rows.labels[low:low + settings.tile][None, :]] = NEVER
        order = np.argsort(-scores, axis=1, kind="stable")
        falling = -np.take_along_axis(scores, order, 1)
        taken = np.full((len(owner), settings.negatives), NEVER)
        names = np.zeros((len(owner), settings.negatives), np.int64)
        for i in range(len(anchors.ids)):
            own = by_owner[first[i]:first[i + 1]]
            if not len(own):
                continue
            # The window's scores stand side by side.
            starts = np.searchsorted(falling[i], -highest[own], "left")
            ends = np.searchsorted(falling[i], -lowest[own], "right")
            for which, a, b in zip(own.tolist(), starts.tolist(), ends.tolist()):
                n = max(0, min(settings.negatives, b - a))
                taken[which, :n], names[which, :n] = -falling[i, a:a + n], ids[order[i, a:a + n]]
        heaps.merge(np.arange(len(owner)), taken, names)
    return heaps


def usable(rows: DataFrame, settings: Settings, name: str, vector: str, label: str) -> DataFrame:
    """(id, label, vector of integers) of the rows that take part, one of each id."""
    finite = F.forall(rows[vector], lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    scaled = F.transform(rows[vector], lambda x: F.floor(F.lit(float(settings.scale)) * x.cast("double")))
    squared = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    some = rows.filter(rows[name].isNotNull() & rows[label].isNotNull() & rows[vector].isNotNull() & finite)
    some = some.select(rows[name].cast("long").alias("id"), rows[label].cast("long").alias("label"), scaled.alias("vector"))
    one = some.filter(squared < LONGEST).groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return one.select("id", "row.label", "row.vector")


def _ranked(found: DataFrame, keys: list[str], name: str, score: str, size: int) -> DataFrame:
    """The best ``size`` of each key with their ranks: the merge of the cells' heaps."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), name)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


def mine(
    rows: DataFrame, is_anchor: Callable[[Column], Column], settings: Settings = Settings(),
    name: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``is_anchor`` is asked of ids."""
    all_rows = settle(usable(rows, settings, name, vector, label), "vectors")
    # Named anew, since they meet the rows that they come from.
    anchors = all_rows.filter(is_anchor(F.col("id"))).select(*[F.col(c).alias(c) for c in all_rows.columns])
    size = all_rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(is_anchor(F.col("id"))).alias("anchors"), F.max(F.size("vector")).alias("wide")).first()
    wide = max(1, size["wide"] or 1)
    groups = max(1, -(-size["anchors"] * wide // settings.anchor_values))
    busy = 2 * rows.sparkSession.sparkContext.defaultParallelism
    tiles = max(1, -(-size["rows"] * wide // settings.row_values), min(busy, size["rows"] // settings.least_rows))

    def number(of: int, salt: int) -> Column:
        return F.pmod(F.xxhash64(F.col("id"), F.lit(salt)), F.lit(of))

    def each(of: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(of - 1).cast("long")))

    dealt = all_rows.withColumn("tile", number(tiles, 1)).withColumn("group", each(groups)).groupBy("tile", "group")

    def cells(frame: DataFrame):
        return frame.withColumn("group", number(groups, 2)).withColumn("tile", each(tiles)).groupBy("tile", "group")

    def first_round(left: pa.Table, right: pa.Table) -> pa.Table:
        k = _wide(left, right)
        own = Vectors.of(left, k)
        which, ids, scores = positives_of(own, Vectors.of(right, k), settings).found()
        return pa.table({"anchor_id": own.ids[which], "positive_id": ids, "positive_score": scores})

    found = cells(anchors).cogroup(dealt).applyInArrow(first_round, "anchor_id long, positive_id long, positive_score long")
    best = settle(_ranked(found, ["anchor_id"], "positive_id", "positive_score", settings.positives).drop("rank"), "positives")

    def second_round(left: pa.Table, right: pa.Table) -> pa.Table:
        k = _wide(left, right)
        left = left.sort_by("id").combine_chunks()
        own = Vectors.of(left, k)
        lists = left["positives"].combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) and lists.num_chunks else lists
        owner = np.repeat(np.arange(len(own.ids)), np.asarray(pc.list_value_length(lists)))
        pairs = lists.flatten() if len(owner) else pa.array([], lists.type.value_type)
        ids, scores = (np.asarray(pairs.field(i)).astype(np.int64) for i in (0, 1))
        which, negatives, reached = negatives_of(own, Vectors.of(right, k), owner, scores, settings).found()
        return pa.table({
            "anchor_id": own.ids[owner[which]], "positive_id": ids[which], "positive_score": scores[which],
            "negative_id": negatives, "negative_score": reached})

    # A handful for each anchor.
    lists = best.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    mined = cells(anchors.join(lists, "id")).cogroup(dealt).applyInArrow(
        second_round, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    return _ranked(mined, ["anchor_id", "positive_id"], "negative_id", "negative_score", settings.negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
