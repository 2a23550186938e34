"""Removal of repeated runs of lines, found by winnowing over line hashes.

A document is the sequence of its lines that hold a word. A window is the shortest run from a line on, or up to a line, that
holds ``least_words`` words. Winnowing keeps the least line hash of each window: any run of that many words
that two places share contains a whole window, equal windows select the same line, so the places share a
fingerprint for certain. Fingerprints found once are done with; the others join their positions, and each match is
extended to both sides window by window: the windows around a fingerprint, to its right those that start at a
line and to its left those that end at one, are compared as a whole, and overlapping equal windows grow into
the longest repeated run. A run that occurred at an earlier place (by id, then by line) is removed.

Only functions of Spark run here. Equal windows are compared with their first occurrence, found by an
aggregation that combines before it shuffles, so a passage that a third of all documents share makes as
many matches as it has occurrences, and never a pair of two later ones. Hashes have 128 bits.

Defined results: a null text stays null and an empty one empty; lines without a word join no window and stay or go
with the line before them; a removed line's text always remains at an earlier place, within the same document
too; rows equal in id and text are one document and all keep what the first keeps; null ids sort first; an empty
table gives an empty result. Other columns are handed on as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesmart.session import settle

#: Fixed value: what a word is.
WORD = r"[^\x20\x09-\x0D]+"


def _windows(docs: DataFrame, least_words: int, doc_id: str, text: str) -> DataFrame:
    """(doc, first, last, mark, content): each window with its least line hash and the hash of its lines.

    ``doc`` is a struct of id and text hash. Lines without a word belong to the line before them.
    """
    line = F.col("line")
    lines = (
        docs.select(F.struct(docs[doc_id].alias("id"), F.xxhash64(docs[text]).alias("hash")).alias("doc"),
                    F.split(docs[text], "\n").alias("lines"))
        .select("doc", F.size("lines").alias("n"), F.posexplode("lines").alias("pos", "line"))
        .select("doc", "n", "pos", F.regexp_count(line, F.lit(WORD)).alias("words"), F.xxhash64(line).alias("h"),
                F.xxhash64(F.lit(1), line).alias("g"))
        .filter("words > 0")
        .dropDuplicates(["doc", "pos"])  # of equal rows; combined before the shuffle, however many they are
    )
    own = Window.partitionBy("doc")
    placed = lines.select(
        "*", F.sum("words").over(own.orderBy("pos")).alias("upto"),
        (F.lead("pos", 1).over(own.orderBy("pos")) - 1).alias("next"),
    ).select("doc", "words", "h", "g", "pos", "upto", (F.col("upto") - F.col("words")).alias("before"),
             F.coalesce("next", F.col("n") - 1).alias("end"))
    reach = least_words - 1
    kinds = []
    for order, frame in (("before", (0, reach)), ("upto", (-reach, 0))):
        over = own.orderBy(order).rangeBetween(*frame)
        found = placed.select(
            "doc", "words", F.min("pos").over(over).alias("first"), F.max("end").over(over).alias("last"), F.sum("words").over(over).alias("held"),
            F.min("h").over(over).alias("mark"), F.collect_list(F.struct("h", "g")).over(over).alias("lines"),
        ).filter(F.col("held") >= least_words)
        if order == "upto":
            found = found.filter(F.col("words") < least_words)  # such a line is its own window already
        content = F.struct(F.xxhash64("lines").alias("a"), F.xxhash64(F.lit(1), "lines").alias("b"))
        kinds.append(found.select("doc", "first", "last", "mark", content.alias("content")))
    return kinds[0].unionByName(kinds[1])


def repeated_runs(docs: DataFrame, least_words: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, first, last, at): windows that occurred before, ``at`` being the first occurrence's document and line."""
    windows = settle(_windows(docs, least_words, doc_id, text), "windows")
    place = F.struct("doc", "first")
    marks = windows.groupBy("mark").agg(F.min(place).alias("low"), F.max(place).alias("high")).filter("low != high").select("mark")
    # Settled: their sizes are then known, and a join that does not fit a broadcast splits hot keys.
    shared = settle(windows.join(settle(marks, "marks"), "mark", "left_semi"), "shared-windows")
    firsts = shared.groupBy("content").agg(F.min(place).alias("at"), F.max(place).alias("high")).filter("at != high").select("content", "at")
    return shared.join(settle(firsts, "first-windows"), "content").filter(place > F.col("at")).select("doc", "first", "last", "at")


def drop_repeated_runs(
    docs: DataFrame, least_words: int = 50, doc_id: str = "doc_id", text: str = "text", counts: bool = False, drop_emptied: bool = False,
) -> DataFrame:
    """``docs`` with repeated runs cut out of the text.

    ``drop_emptied`` leaves out documents of which no word remains. ``counts`` adds ``n_lines`` and ``n_removed``, in place of columns of that name.
    """
    gone = (
        repeated_runs(docs, least_words, doc_id, text)
        .select("doc", F.explode(F.sequence("first", "last")).alias("pos"))
        .groupBy("doc").agg(F.collect_set("pos").alias("gone"))
        .select(F.col("doc.id").alias("id"), F.col("doc.hash").alias("hash"), "gone")
    )
    rows = docs.select(docs[doc_id].alias("id"), F.xxhash64(docs[text]).alias("hash"), F.struct("*").alias("row"))
    gone = settle(gone, "removed-lines").select(F.col("id").alias("gone_id"), F.col("hash").alias("gone_hash"), "gone")
    # Removals grow with the documents: the same join at every size, and one that need not sort the texts.
    joined = rows.join(gone.hint("shuffle_hash"), rows["id"].eqNullSafe(gone["gone_id"]) & (rows["hash"] == gone["gone_hash"]), "left")
    lines = F.split(F.col(f"row.`{text}`"), "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "gone")
    cut = F.when(F.col("gone").isNull(), F.col(f"row.`{text}`")).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    if drop_emptied:
        joined = joined.filter(F.col("gone").isNull() | F.exists(left, lambda i: F.get(lines, i).rlike(WORD)))
    extra = ["n_lines", "n_removed"] if counts else []
    columns = [cut.alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns if c not in extra]
    if counts:
        columns += [F.when(F.col(f"row.`{text}`").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
                    F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed")]
    return joined.select(*columns)
