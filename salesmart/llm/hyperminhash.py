"""Near duplicates by HyperMinHash sketches, confirmed on full shingle sets.

A document's set is its distinct runs of ``shingle`` words. One hash a shingle chooses a bucket and a value; a bucket
keeps its least value as a register of 32 bits, the number of leading zeros and the 26 bits behind them. (With
10 of these, the few registers of short documents would agree by chance too often.) Documents with equal sets
become one class. Classes that agree in all registers of a band are candidates; the share of equal
registers, less the collisions that sets of these sizes would have by chance, estimates their similarity and
drops hopeless pairs (``sigmas`` standard errors below the limit); the rest is confirmed on the full sets.

Bands are cut from several fixed shuffles of the registers, so that they can be long: 63 bands of 6 registers miss
a pair at the limit of 0.8 with a probability of about 2.4e-6, and two documents that share a passage and
little else rarely meet.

Pairs are not listed within a band. Each band's members are confirmed against one hub, the linked ones become
components, and further rounds test only pairs that lie in different components: against another hub
first. What is left are members outside the largest component of a band, which near copies of near copies
can leave in large numbers, most of them just below the limit. In the last round those of all bands with the same largest
component form one group, and each is compared with all others of the group in blocks of bounded size, where
the common shingles of all pairs of a block are one matrix product; only links come out of it. So components
are those of all links whose two documents share a band.

Defined results: fewer words than a shingle make one shingle, no words (or a null text) an empty set that is linked
with nothing; a component's id is its smallest id, nulls last; rows that repeat the kept id are kept all, as
are rows without an id where no other row of the component has one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm import word_hash
from salesmart.session import settle

TABLE = word_hash.byte_table(word_hash.SPACES)
BUCKET_BITS, MANTISSA_BITS, REGISTER_BYTES = 7, 26, 4
REGISTERS = 1 << BUCKET_BITS


@dataclass(frozen=True)
class Settings:
    """Parameters of the search, see the module."""

    shingle: int = 4
    percent: int = 80
    band: int = 6
    shuffles: int = 3
    sigmas: float = 5.0
    hub_rounds: int = 2
    block_rows: int = 1024
    block_shingles: int = 400_000


def shingle_sets(texts: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for low, high, words in word_hash.chunks(texts, TABLE):
        hashes, _ = word_hash.grams(words, shingle)
        first = words.first.tolist()
        for a, b in zip(first, first[1:]):
            if b - a >= shingle:
                yield np.unique(hashes[a:b - shingle + 1])
            elif b > a:
                whole = b - a
                for h in words.hashes[a:b].tolist():
                    whole = (whole * word_hash.BASE + h) & (2**64 - 1)
                yield word_hash.mix(np.array([whole], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def registers(hashes: np.ndarray) -> np.ndarray:
    """Registers of sorted distinct hashes; 0 where a bucket is empty."""
    out = np.zeros(REGISTERS, np.uint32)
    if len(hashes):
        bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        least = np.flatnonzero(np.diff(bucket, prepend=-1))  # sorted: the first of a bucket is its least
        rest = hashes[least] << np.uint64(BUCKET_BITS)
        zeros = 64 - np.frexp((rest >> np.uint64(11)).astype(np.float64))[1] - 11
        behind = np.where(zeros < 63, rest << np.minimum(zeros + 1, 63).astype(np.uint64), np.uint64(0)) >> np.uint64(64 - MANTISSA_BITS)
        out[bucket[least]] = (np.minimum(zeros, 62).astype(np.uint64) + np.uint64(1) << np.uint64(MANTISSA_BITS)) | behind
    return out


@lru_cache(4096)
def _collisions(a: int, b: int) -> float:
    """Registers that two unrelated sets of 2^(a/4) and 2^(b/4) shingles are expected to have in common."""
    # Within a step of 1/1024 of a power of two the chance is even: each step stands for its equal parts.
    zeros = np.arange(1, 58, dtype=float)[:, None]
    low = (1 + np.arange(1024) / 1024) / 2.0**zeros
    high = low + 1 / 2.0 ** (zeros + 10)

    def lands(n: float) -> np.ndarray:  # the least value of a bucket lies between low and high
        return np.exp(n * np.log1p(-np.minimum(low, 1 - 1e-12) / REGISTERS)) - np.exp(n * np.log1p(-np.minimum(high, 1) / REGISTERS))

    return float(REGISTERS * (lands(2 ** (a / 4)) * lands(2 ** (b / 4))).sum() / 2 ** (MANTISSA_BITS - 10))


def estimate(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(similarity, its standard error at 0.8) of sketch pairs, corrected for chance collisions."""
    equal = ((left == right) & (left > 0)).sum(1)
    filled = np.maximum(((left > 0) | (right > 0)).sum(1), 1)
    sizes = [np.rint(4 * np.log2(np.maximum(n, 1))).astype(int).tolist() for n in (n_left, n_right)]
    chance = np.array([_collisions(a, b) for a, b in zip(*sizes)])
    return np.clip((equal - chance) / filled, 0, 1), np.sqrt(0.16 / filled)


def sketch(docs: DataFrame, settings: Settings, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text_hash, n_shingles, signature, registers) of each document.

    The signature names the set: two sums of its hashes.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names, sketches = [], [], []
            for hashes in shingle_sets(batch.column(2), settings.shingle):
                sizes.append(len(hashes))
                other = word_hash.mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5))
                names.append(np.array([hashes.sum(dtype=np.uint64), other.sum(dtype=np.uint64)]).tobytes())
                sketches.append(registers(hashes).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(sketches, pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "signature", "registers"])

    key = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("text_hash"), docs[text].alias("text"))
    return rows.mapInArrow(work, f"doc_id {key}, text_hash bigint, n_shingles bigint, signature binary, registers binary")


def classes_of(rows: DataFrame) -> DataFrame:
    """(class, signature, n_shingles, doc_id, text_hash, registers): one row for each distinct set.

    The document is that with the smallest id.
    """
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "registers")).alias("d")
    grouped = rows.filter("n_shingles > 0").groupBy("signature", "n_shingles").agg(best)
    return grouped.select(F.monotonically_increasing_id().alias("class"), "signature", "n_shingles", "d.doc_id", "d.text_hash", "d.registers")


def bands(settings: Settings) -> np.ndarray:
    """(band, place): the registers of each band."""
    draw = np.random.default_rng(20240601)
    orders = [np.arange(REGISTERS), *[draw.permutation(REGISTERS) for _ in range(settings.shuffles - 1)]]
    count = REGISTERS // settings.band
    return np.concatenate([o[:count * settings.band].reshape(count, settings.band) for o in orders])


def members_of(classes: DataFrame, settings: Settings) -> DataFrame:
    """(bucket, class) of the band buckets that hold more than one class."""
    places = bands(settings)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 1000):
                batch = whole.slice(low, 1000)
                own = _matrix(batch.column(1))[:, places].astype(np.uint64)  # (class, band, place)
                keys = np.broadcast_to(np.arange(len(places), dtype=np.uint64), own.shape[:2])
                for k in range(settings.band):
                    keys = keys * np.uint64(word_hash.BASE) + own[:, :, k]
                row, band = np.nonzero(own.any(2))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word_hash.mix(keys)[row, band].view(np.int64)), batch.column(0).take(pa.array(row))], names=["bucket", "class"])

    rows = classes.select("class", "registers").mapInArrow(cut, "bucket bigint, class bigint")
    shared = rows.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low != high").select("bucket")
    # Settled, so that the join's two sides are plain shuffles and a hot bucket is split.
    return rows.hint("merge").join(settle(shared, "shared-buckets"), "bucket")


def _matrix(found: pa.Array) -> np.ndarray:
    """Registers of a binary column, a row each."""
    return np.array([np.frombuffer(x.as_buffer(), np.uint32) for x in found]).reshape(-1, REGISTERS)


def _pairs(rows: DataFrame, tested: DataFrame | None) -> DataFrame:
    """Distinct (a, b), a < b, of class pairs that were not tested yet."""
    pairs = rows.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    return pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")


def _hub_pairs(members: DataFrame, tested: DataFrame | None, turn: int) -> DataFrame:
    """Each member with its bucket's hub, where they lie in different components; another hub each turn."""
    order = F.struct(F.lit(0).cast("long") if turn == 0 else F.xxhash64(F.lit(turn), "class", "bucket"), "class", "component")
    hubs = members.groupBy("bucket").agg(F.min(order).alias("hub")).select("bucket", F.col("hub.class").alias("y"), F.col("hub.component").alias("of"))
    rows = members.hint("merge").join(settle(hubs, "hubs"), "bucket").filter(F.col("component") != F.col("of"))
    return _pairs(rows.select(F.col("class").alias("x"), "y"), tested)


def _common(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """How many hashes each set on the left has in common with each on the right (all sorted and distinct)."""
    found = np.zeros((len(left), len(right)), np.float32)
    sides = [(np.concatenate(x), np.repeat(np.arange(len(x)), [len(s) for s in x])) for x in (left, right)]
    shared = np.intersect1d(*[np.unique(hashes) for hashes, _ in sides], assume_unique=True)
    places = [np.searchsorted(shared, hashes) for hashes, _ in sides]
    known = [np.append(shared, np.uint64(0))[at] == hashes if len(shared) else at < 0 for at, (hashes, _) in zip(places, sides)]
    for low in range(0, len(shared), columns):
        some = []
        for (_, row), at, ok, n in zip(sides, places, known, found.shape):
            ok = ok & (at >= low) & (at < low + columns) & (at < len(shared))
            table = np.zeros((n, min(columns, len(shared) - low)), np.float32)
            table[row[ok], at[ok] - low] = 1
            some.append(table)
        found += some[0] @ some[1].T
    return found


def _rest_links(members: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) between components among classes that share a bucket: at least one of each class and other component."""
    counts = members.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = counts.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("top"), F.count(F.lit(1)).alias("components"))
    largest = settle(largest.filter("components > 1").select("bucket", F.col("top.component").alias("main")), "largest-components")
    group = members.hint("merge").join(largest, "bucket").select("main", "class", "component").distinct()
    group = settle(group.join(texts.select("class", "n_shingles"), "class"), "rest-classes")
    sizes = group.groupBy("main").agg(F.count(F.lit(1)).alias("rows"), F.sum("n_shingles").alias("shingles")).select(
        "main", F.greatest(F.ceil(F.col("rows") / settings.block_rows), F.ceil(F.col("shingles") / settings.block_shingles)).alias("blocks"))
    whole = group.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("n_shingles"), F.lit(0)).alias("shingles")).first()
    cells = 1 + max(whole["rows"] // settings.block_rows, whole["shingles"] // settings.block_shingles)
    rows = group.join(settle(sizes, "rest-groups"), "main").withColumn("block", F.pmod(F.xxhash64("class"), "blocks"))
    rows = rows.join(texts.select("class", "text"), "class")
    # Groups of one block share cells; each pair of blocks of a larger one has a cell of its own.
    all_blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    none = F.lit(-1).cast("long")
    shared = F.struct(F.pmod(F.xxhash64("main"), F.lit(cells)).alias("g"), none.alias("i"), none.alias("j"))
    cell = F.when(F.col("blocks") == 1, shared).otherwise(F.struct(F.col("main").alias("g"), F.col("i"), F.col("j"))).alias("cell")
    kept = ["main", "class", "component", "text"]
    left = rows.filter("component != main").withColumnRenamed("block", "i").withColumn("j", all_blocks).select(cell, *kept, F.lit(True).alias("outside"))
    right = rows.withColumnRenamed("block", "j").withColumn("i", all_blocks).select(cell, *kept, F.lit(False).alias("outside"))

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        main, name, component = (table[c].to_numpy() for c in ("main", "class", "component"))
        outside = table["outside"].to_numpy(zero_copy_only=False)
        first = dict(zip(name[::-1].tolist(), range(len(name) - 1, -1, -1)))  # each class's first row: its text is hashed once
        own = np.array(sorted(first.values()), np.int64)
        texts = table["text"].take(pa.array(own))
        sets = dict(zip(name[own].tolist(), shingle_sets(texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts, settings.shingle)))
        links: set[tuple[int, int, int]] = set()
        order = np.argsort(main, kind="stable")
        for rows_ in np.split(order, np.flatnonzero(np.diff(main[order])) + 1):
            l, r = rows_[outside[rows_]], rows_[~outside[rows_]]
            if not len(l) or not len(r):
                continue
            common = _common([sets[c] for c in name[l].tolist()], [sets[c] for c in name[r].tolist()])
            n_l, n_r = (np.array([len(sets[c]) for c in name[x].tolist()]) for x in (l, r))
            linked = 100 * common >= settings.percent * (n_l[:, None] + n_r[None, :] - common)
            for i, j in np.argwhere(linked & (component[l][:, None] != component[r][None, :])).tolist():
                links.add((int(name[l[i]]), int(component[r[j]]), int(name[r[j]])))
        once = {(a, c): b for a, c, b in links}
        pairs = [(min(a, b), max(a, b)) for (a, _), b in once.items()]
        return pa.table({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})

    return left.unionByName(right).groupBy("cell").applyInArrow(compare, "a bigint, b bigint").distinct()


def _likely(pairs: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """Pairs whose estimate does not rule out the limit."""

    @F.arrow_udf("boolean")
    def near(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for left, n_left, right, n_right in batches:
            share, error = estimate(_matrix(left), _matrix(right), n_left.to_numpy(), n_right.to_numpy())
            yield pa.array(share + settings.sigmas * error >= settings.percent / 100)

    sketches = classes.select("class", "registers", "n_shingles")
    left = sketches.select(F.col("class").alias("a"), F.col("registers").alias("ra"), F.col("n_shingles").alias("na"))
    right = sketches.select(F.col("class").alias("b"), F.col("registers").alias("rb"), F.col("n_shingles").alias("nb"))
    return pairs.join(left, "a").join(right, "b").filter(near("ra", "na", "rb", "nb")).select("a", "b")


def confirmed(settings: Settings, left: Column, right: Column) -> Column:
    """Whether two texts' full sets are linked."""

    @F.arrow_udf("boolean")
    def linked(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in batches:
            out = []
            for x, y in zip(shingle_sets(a, settings.shingle), shingle_sets(b, settings.shingle)):
                common = len(np.intersect1d(x, y, assume_unique=True))
                out.append(100 * common >= settings.percent * (len(x) + len(y) - common))
            yield pa.array(out, pa.bool_())

    return linked(left, right)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of settled edges (a, b): the smallest node reachable."""
    both = settle(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = settle(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component")), "labels")
    while True:
        known = labels.select(F.col("node").alias("b"), "component")
        heard = both.join(known, "b").groupBy("a").agg(F.min("component").alias("heard")).withColumnRenamed("a", "node")
        moved = labels.join(heard, "node").select("node", F.col("component").alias("old"), F.least("component", "heard").alias("at"))
        # What the component's own node has found by now is as good a label.
        jump = labels.select(F.col("node").alias("at"), F.col("component").alias("next"))
        labels = settle(moved.join(jump, "at").select("node", "old", F.col("next").alias("component")), "labels")
        if labels.filter("old != component").isEmpty():
            return labels.select("node", "component")
        labels = labels.select("node", "component")


def _relabel(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with (class, component) after components were merged by ``labels`` (node, component)."""
    named = labels.select(F.col("node").alias("component"), F.col("component").alias("merged"))
    return members.join(named, "component", "left").withColumn("component", F.coalesce("merged", "component")).drop("merged")


def near_duplicates(docs: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) of each document."""
    rows = settle(sketch(docs, settings, doc_id, text), "sketches")
    classes = settle(classes_of(rows), "classes")
    members = settle(members_of(classes, settings).withColumn("component", F.col("class")), "members")
    texts = settle(_candidate_texts(docs, classes, members, doc_id, text), "candidate-texts")
    owners = classes.select("class", F.col("class").alias("component"))
    tested = None
    for turn in range(settings.hub_rounds + 1):
        if turn < settings.hub_rounds:
            pairs = settle(_hub_pairs(members, tested, turn), "pairs")
            tested = pairs if tested is None else tested.unionByName(pairs)
            left, right = (texts.select(F.col("class").alias(k), F.col("text").alias(f"text_{k}")) for k in "ab")
            likely = _likely(pairs, classes, settings).join(left, "a").join(right, "b")
            links = settle(likely.filter(confirmed(settings, F.col("text_a"), F.col("text_b"))).select("a", "b"), "links")
        else:
            links = settle(_rest_links(members, texts, settings), "links")
        if links.isEmpty():
            continue
        # Between components, which are few, and not between classes again.
        of_a, of_b = (owners.select(F.col("class").alias(k), F.col("component").alias(f"c{k}")) for k in "ab")
        edges = links.join(of_a, "a").join(of_b, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()
        labels = components(settle(edges.filter("a != b"), "component-edges"))
        owners = settle(_relabel(owners, labels), "owners")
        if turn < settings.hub_rounds:
            members = settle(_relabel(members, labels), "members")
    named = classes.join(owners, "class")
    # Settled, so that the join's two sides are plain shuffles and a component that holds most classes is split.
    first = settle(named.groupBy("component").agg(F.min("doc_id").alias("component_id")), "first-documents")
    known = settle(named.join(first, "component").select("signature", "n_shingles", "component_id"), "named-classes")
    joined = rows.select("doc_id", "text_hash", "n_shingles", "signature").join(known, ["signature", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "text_hash", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _candidate_texts(docs: DataFrame, classes: DataFrame, members: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(class, n_shingles, text) of the classes that share a bucket."""
    wanted = classes.join(members.select("class").distinct(), "class", "left_semi").select(
        "class", "n_shingles", F.col("doc_id").alias("want_id"), F.col("text_hash").alias("want_hash"))
    rows = docs.select(docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("text_hash"), docs[text].alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("want_id")) & (F.col("text_hash") == F.col("want_hash"))
    # Wanted rows grow with the documents: the same join at every size, and one that need not sort the texts.
    return rows.join(settle(wanted, "wanted").hint("shuffle_hash"), same).groupBy("class", "n_shingles").agg(F.first("text").alias("text"))


def keep_one(docs: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, with its columns as they are."""
    gone = near_duplicates(docs, settings, doc_id, text).filter("NOT kept").select(
        F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct()
    rows = docs.select(docs[doc_id].alias("id"), F.xxhash64(docs[text]).alias("hash"), F.struct("*").alias("row"))
    gone = settle(gone, "near-duplicates").hint("shuffle_hash")
    same = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("hash") == F.col("gone_hash"))
    return rows.join(gone, same, "left_anti").select("row.*")
