"""Secrets by fixed patterns, and credentials linked from parts that stand near each other.

Fixed patterns give the base spans. A credential often comes in parts: an identifier (access key id, user, client
id), a secret and an endpoint (URL, host, connection string). Weak candidates of each role are too common to be
reported alone; they are reported only where complementary parts overlap their scope, an interval of
``reach`` code points to both sides that ends at a blank line. Parts meet in an interval join: each scope is cut
into cells of ``reach`` code points, equal cells join, and the exact distance is checked. A cell has
room for few parts, so pairs grow with the parts and not with the square of a document's.

* a weak secret needs an identifier or an endpoint in its scope,
* a weak identifier needs a secret,
* an endpoint needs a secret.

Base ``access`` spans count as identifiers, ``assign`` and ``hex`` spans as secrets.

The scan keeps of each document its spans only, written once to the shared folder; links are found and put
back from there, so no text is shuffled. Defined results: null and empty texts have no spans; offsets are code
points, ends exclusive; each row is a scope of its own, whatever its id; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.session import settle

#: Kinds in the order they are shown in, base patterns, weak patterns.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "secret", "identifier", "endpoint")
SECRET_KINDS = ("assign", "hex", "secret")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST = {"assign": 12, "access": 18, "hex": 16}
WEAK_ASSIGN = re.compile(
    r"""(?:pwd|pass|pass_?phrase|secret_?key|private_?key|access_?key|auth|credential|bearer)["']?\x20{0,4}[:=]\x20{0,4}["']?"""
    r"""([A-Za-z0-9+/_.=!@#$%^&*-]{6,})""", re.I | re.A)
WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+(?![A-Za-z0-9+/_=-])")
IDENTIFIER = re.compile(
    r"""(?:user(?:_?name)?|login|account(?:_?id)?|client_?id|key_?id|access_?key_?id|tenant(?:_?id)?)["']?\x20{0,4}[:=]\x20{0,4}["']?([A-Za-z0-9_.@+-]{2,})""", re.I | re.A)
ENDPOINT = re.compile(
    r"""[a-z][a-z0-9+.-]{1,20}://[^\s"'<>]{3,}+|(?:host(?:_?name)?|server|endpoint|base_?url)["']?\x20{0,4}[:=]\x20{0,4}["']?([A-Za-z0-9_.:/-]{3,})""", re.I | re.A)
WORTH_A_LOOK = re.compile(r"[0-9:=]")

Span = tuple[int, int, int]  # (start, kind, end)


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, by start and then kind."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def entropy(text: str) -> float:
    """Bits a character."""
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values())


def _outside(start: int, stop: int, taken: list[Span]) -> Iterator[tuple[int, int]]:
    """The parts of an interval that are in none of ``taken``, which are sorted by start."""
    for s, _, e in taken:
        if s > start:
            yield start, min(s, stop)
        start = max(start, e)
        if start >= stop:
            return
    yield start, stop


def weak_spans(text: str, base: list[Span], least_entropy: float = 3.5) -> list[Span]:
    """Weak candidates that touch no base span, nor each other.

    Of a value that has base spans inside it, the parts before, between and behind them are candidates.
    """
    found = []
    starts = [s for s, _, _ in base]
    furthest = list(accumulate((e for _, _, e in base), max))

    def add(m: re.Match, kind: int, least: int) -> None:
        low, high = bisect_right(furthest, m.start()), bisect_left(starts, m.end())
        if low >= high or m[1] is None or base[low][0] <= m.start():
            found.append((m.start(), kind, m.end()))  # one that begins in a base span is left out below
            return
        for start, stop in _outside(m.start(1), m.end(), base[low:high]):
            if stop - start >= least:
                found.append((m.start() if start == m.start(1) else start, kind, stop))

    if ":" in text or "=" in text:
        for m in IDENTIFIER.finditer(text):
            add(m, 4, 2)
        for m in ENDPOINT.finditer(text):
            add(m, 5, 3)
        for m in WEAK_ASSIGN.finditer(text):
            add(m, 3, 6)
        found += [(m.start(), 3, m.end()) for m in ASSIGN.finditer(text) if 6 <= len(m[2]) < LEAST["assign"]]
    for m in WEAK_SECRET.finditer(text):
        own = m[0]
        if any(c.isdigit() for c in own) and any(c.isalpha() for c in own) and entropy(own) >= least_entropy:
            found.append((m.start(), 3, m.end()))
    found.sort(key=lambda s: (s[0], -s[2], s[1]))
    out, i, end = [], 0, 0
    for start, kind, stop in found:
        while i < len(base) and base[i][2] <= start:
            i += 1
        if start < end < stop and kind == 3 and stop - end >= 6:  # the rest of a secret whose beginning another part has taken
            start = end
        if start >= end and (i == len(base) or base[i][0] >= stop):  # the first base span that ends later begins later
            out.append((start, kind, stop))
            end = stop
    return out


PART = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("stop", pa.int64()), ("section", pa.int64())])
PARTS_DDL = "array<struct<start: bigint, kind: int, stop: bigint, section: bigint>>"


def parts(text: Column) -> Column:
    """Base and weak spans of a text column, each with the start of its section (text between blank lines)."""

    @F.arrow_udf(PARTS_DDL)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for value in batch:
                body = value.as_py() or ""
                base = base_spans(body)
                spans = sorted(base + weak_spans(body, base)) if WORTH_A_LOOK.search(body) or base else base
                cuts, section, row = (m.start() for m in re.finditer(r"\n[\x20\t\r]*+\n", body)) if spans else iter(()), 0, []
                cut = next(cuts, None)
                for start, kind, stop in spans:
                    while cut is not None and cut < start:
                        section, cut = cut, next(cuts, None)
                    row.append({"start": start, "kind": kind, "stop": stop, "section": section})
                rows.append(row)
            yield pa.array(rows, pa.list_(PART))

    return scan(text)


def _shown(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name[s["kind"]], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _is_secret(kind: Column) -> Column:
    return kind.isin([KINDS.index(k) for k in SECRET_KINDS])


def linked(scanned: DataFrame, reach: int = 300) -> DataFrame:
    """(row_id, start, kind, stop) of the weak parts of ``scanned`` (row_id, parts) whose scope holds what they need."""
    weak = F.exists("parts", lambda p: p["kind"] >= len(BASE_KINDS))
    part = scanned.filter(weak & (F.size("parts") > 1)).select("row_id", F.explode("parts").alias("p")).select("row_id", "p.*")
    scope = part.filter(F.col("kind") >= len(BASE_KINDS)).withColumn("cell", F.explode(F.sequence(
        F.floor((F.col("start") - reach) / reach), F.floor((F.col("stop") + reach) / reach))))
    other = part.select(
        "row_id", "section", F.col("start").alias("o_start"), F.col("stop").alias("o_stop"), F.col("kind").alias("o_kind"),
        F.explode(F.sequence(F.floor(F.col("start") / reach), F.floor(F.col("stop") / reach))).alias("cell"))
    near = (F.col("o_start") <= F.col("stop") + reach) & (F.col("o_stop") >= F.col("start") - reach)
    needed = _is_secret(F.col("kind")) != _is_secret(F.col("o_kind"))
    return (
        scope.join(other, ["row_id", "section", "cell"]).filter(near & needed)
        .select("row_id", "start", "kind", "stop").distinct())


def find_secrets(docs: DataFrame, reach: int = 300, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row a document: the columns ``keep``, counts and digest of base spans, and all spans reported."""
    scanned = settle(docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.struct(*[docs[c] for c in keep]).alias("kept"), parts(docs[text]).alias("parts")), "secret-parts")
    found = linked(scanned, reach).groupBy("row_id").agg(F.collect_list(F.struct("start", "kind", "stop")).alias("weak"))
    base = F.transform(
        F.filter("parts", lambda p: p["kind"] < len(BASE_KINDS)),
        lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), p["stop"].alias("stop")))
    rows = scanned.select("row_id", "kept", base.alias("base")).join(found, "row_id", "left")
    count = lambda k: F.size(F.filter("base", lambda p: p["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    none = F.array().cast("array<struct<start: bigint, kind: int, stop: bigint>>")
    return rows.select(
        "kept.*", *[count(k) for k in range(len(BASE_KINDS))], F.sha2(_shown(F.col("base")), 256).alias("base_sha256"),
        _shown(F.array_sort(F.concat("base", F.coalesce("weak", none)))).alias("spans"))
