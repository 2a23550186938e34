"""Personal data by fixed patterns and a skip-chain conditional random field.

Patterns give the base spans. The field then labels a document's candidates: number groups, addresses
(also ``name (at) host (dot) tld``) and handles that equal an address's local part. Its potentials are

* unary: the shape of a candidate and the words before it,
* chain: between candidates that follow each other,
* skip: between distant candidates that repeat each other or are alike (same last digits, same local part), by
  way of a hub that all of them are joined to.

Base spans are clamped to their kind, and so are the hubs they are joined to; loopy belief propagation carries
labels along the skip edges, so a number written with its country code once and without it later gets one label
in the whole document, however often it repeats. Candidates whose marginal for a kind passes a limit become further
spans. A key that occurs k times makes k skip edges, and any two of its occurrences are two steps apart.

Weights are fitted by pseudo-likelihood on a bounded sample of documents (``fit``), whose base spans are the
labels; no feature says what the patterns test for besides the digits' check sum. Candidates that no pattern takes
count as none, but for those that repeat a base span: their label is not known, so they teach nothing.

Defined results: null and empty texts have no spans; offsets are code points, ends exclusive; every row is
worked on alone, so repeated ids and rows do not mix; an empty table gives an empty result and the prior
weights.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The kinds in their order, the patterns, words that come before.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORTH_A_LOOK = re.compile(r"[0-9@]|[(\[{]at[)\]}]")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
NUMBER = re.compile(r"[+(]{0,2}[0-9]++(?:[().\x20/-]{1,2}[0-9]++)*+")
VEILED = re.compile(r"\x20?[(\[{]at[)\]}]\x20?")
VEILED_HOST = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|\x20?[(\[{]dot[)\]}]\x20?)[A-Za-z0-9-]+)+")
HANDLE = re.compile(r"(?<![A-Za-z0-9._%+@-])[A-Za-z][A-Za-z0-9]*+[._][A-Za-z0-9._]*[A-Za-z0-9](?![A-Za-z0-9@])")
CUES = (
    re.compile(r"mail|write to|contact", re.I), re.compile(r"\bip\b|host|server|address", re.I),
    re.compile(r"card|visa|credit|payment", re.I), re.compile(r"\btel|phone|call|fax|mobile|whatsapp", re.I),
)
LABELS = len(KINDS) + 1  # 0 is none of them
FEATURES = 19
NEAR = 200  # code points between candidates that are still a chain

Span = tuple[int, int, int]  # (start, kind, end)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    # From each at sign outwards: a match's local part reaches back to the first character that cannot belong to it.
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL.match(text[start - 1]):
            start -= 1
        host = DOMAIN.match(text, at + 1) if start < at else None
        if host:
            yield start, 0, host.end()
            end = host.end()
        else:
            end = max(end, at + 1)
        at = text.find("@", max(at + 1, end))


def _is_octet(digits: str) -> bool:
    """Whether digits, zeros before them included, are 255 at most; there may be more of them than ``int`` takes."""
    rest = digits.lstrip("0")
    return len(rest) <= 3 and int(rest or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by start and then kind."""
    if not WORTH_A_LOOK.search(text):
        return []
    spans = list(_emails(text))
    spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(_is_octet(p) for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    if "+" in text:
        spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return sorted(spans)


def shown(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


@dataclass
class Graph:
    """Candidates of one document: where, their label if a pattern gives it (else -1), features, edges."""

    places: list[tuple[int, int]]
    given: np.ndarray
    features: np.ndarray
    edges: np.ndarray  # (n, 3): from, to, 0 chain or 1 skip; numbers behind the candidates' are hubs, only a skip's second


def _candidates(text: str, base: list[Span]) -> list[tuple[int, int, int]]:
    """(start, end, given label or -1) in text order, without overlaps; base spans come first."""
    taken: list[tuple[int, int, int]] = []
    end = 0
    for s, k, e in base:  # spans of two kinds may overlap: the first stands for both
        if s >= end:
            taken.append((s, e, k + 1))
            end = e
    more = []
    for m in VEILED.finditer(text):
        start = m.start()
        while start > 0 and LOCAL.match(text[start - 1]):
            start -= 1
        host = VEILED_HOST.match(text, m.end())
        if host and start < m.start():
            more.append((start, host.end(), -1))
    for m in NUMBER.finditer(text):
        if 7 <= sum(c.isdigit() for c in m[0]) <= 19:
            more.append((m.start() + (m[0][0] == "(" and ")" not in m[0]), m.end(), -1))
    locals_ = {text[s:e].partition("@")[0].lower() for s, k, e in base if k == 0}
    locals_ |= {VEILED.split(text[s:e])[0].lower() for s, e, _ in more if VEILED.search(text[s:e])}
    if locals_:
        more += [(m.start(), m.end(), -1) for m in HANDLE.finditer(text) if len(m[0]) >= 5 and m[0].lower() in locals_]
    more.sort()
    found, i, end = [], 0, 0
    for s, e, g in more:
        while i < len(taken) and taken[i][1] <= s:
            found.append(taken[i])
            end = max(end, taken[i][1])
            i += 1
        if s >= end and not (i < len(taken) and taken[i][0] < e):
            found.append((s, e, g))
            end = e
    return found + taken[i:]


def _features(text: str, start: int, end: int) -> tuple[np.ndarray, str]:
    """Features of a candidate and the key that alike candidates share."""
    own = text[start:end]
    digits = "".join(c for c in own if c in "0123456789")
    n = len(digits)
    veiled = bool(VEILED.search(own))
    mail = veiled or "@" in own
    handle = not mail and any(c.isalpha() for c in own)
    parts = own.split(".")
    dotted = not mail and len(parts) == 4 and all(p.isdigit() for p in parts)
    number = not mail and not handle
    before = text[max(0, start - 40):start]
    row = [
        1, mail, veiled, handle, dotted, dotted and all(len(p) <= 3 and int(p) <= 255 for p in parts),
        number and not dotted and n <= 9, number and not dotted and 10 <= n <= 11, number and not dotted and 12 <= n <= 13,
        number and not dotted and 14 <= n <= 16, number and not dotted and n > 16, number and "(" in own, number and "-" in own,
        number and " " in own, number and n >= 14 and luhn(digits), *(bool(c.search(before)) for c in CUES),
    ]
    if mail:
        key = "m" + (VEILED.split(own)[0] if veiled else own.partition("@")[0]).lower()
    elif handle:
        key = "m" + own.lower()
    else:
        key = "i" + own if dotted else "d" + digits[-7:]
    return np.array(row, float), key


def graph(text: str, base: list[Span]) -> Graph | None:
    """The document's graph, or None without candidates."""
    found = _candidates(text, base) if WORTH_A_LOOK.search(text) else []
    if not found:
        return None
    rows, edges, alike = [], [], {}
    for i, (s, e, _) in enumerate(found):
        row, key = _features(text, s, e)
        rows.append(row)
        if i and s - found[i - 1][1] <= NEAR:
            edges.append((i - 1, i, 0))
        alike.setdefault(key, []).append(i)
    for hub, own in enumerate((own for own in alike.values() if len(own) > 1), len(found)):
        edges += [(i, hub, 1) for i in own]
    return Graph([(s, e) for s, e, _ in found], np.array([g for *_, g in found]), np.array(rows), np.array(edges, int).reshape(-1, 3))


@dataclass(frozen=True)
class Weights:
    """Log potentials: (labels, features), and (from label, to label) along chain and skip edges."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def prior() -> Weights:
    """Nothing known but that alike candidates share a label, a kind or none."""
    return Weights(np.zeros((LABELS, FEATURES)), np.zeros((LABELS, LABELS)), 5.0 * np.eye(LABELS))


def learn(graphs: list[Graph], steps: int = 300, rate: float = 0.1, pulls: tuple[float, float, float] = (1.0, 20.0, 20.0)) -> Weights:
    """Weights by pseudo-likelihood: each candidate given its neighbours' labels.

    ``pulls`` draw unary, chain and skip weights to the prior. Patterns label no veiled form, so what they
    teach about neighbours counts less than what they teach about shapes.
    """
    start = prior()
    if not graphs:
        return start
    given = np.concatenate([g.given for g in graphs])
    x = np.concatenate([g.features for g in graphs])
    chain, skip, low, hubs = [], [], 0, 0
    for g in graphs:
        own = g.edges[g.edges[:, 2] == 1, :2] - [0, len(g.given)]
        chain.append(g.edges[g.edges[:, 2] == 0, :2] + low)
        skip.append(own + [low, hubs])
        low, hubs = low + len(g.given), hubs + (int(own[:, 1].max()) + 1 if len(own) else 0)
    chain, skip = np.concatenate(chain), np.concatenate(skip)
    node, hub = skip.T
    hot = np.eye(LABELS)[np.maximum(given, 0)]
    votes = np.zeros((hubs, LABELS))
    np.add.at(votes, hub, hot[node] * (given[node] >= 0)[:, None])
    unknown = np.zeros(len(given), bool)  # repeats of a base span that are none themselves
    unknown[node] = (given[node] < 0) & votes[hub].any(1)
    hot[unknown] = 0
    around = np.zeros((len(given), 3, LABELS))  # labels before and after on the chain, and of the hub without oneself
    for kind, end, other in ((0, 1, 0), (1, 0, 1)):
        np.add.at(around, (chain[:, end], kind), hot[chain[:, other]])
    others = votes[hub] - hot[node] * (given[node] >= 0)[:, None]
    others[~votes[hub].any(1)] = np.eye(LABELS)[0]
    around[node, 2] = np.eye(LABELS)[others.argmax(1)] * others.any(1)[:, None]
    held = [start.unary.copy(), start.chain.copy(), start.skip.copy()]
    moment, scale = [np.zeros_like(p) for p in held], [np.zeros_like(p) for p in held]
    for step in range(1, steps + 1):
        unary, chain, skips = held
        score = x @ unary.T + around[:, 0] @ chain + around[:, 1] @ chain.T + around[:, 2] @ ((skips + skips.T) / 2)
        p = np.exp(score - score.max(1, keepdims=True))
        miss = hot - p / p.sum(1, keepdims=True)
        miss[unknown] = 0
        both = around[:, 2].T @ miss
        slopes = [miss.T @ x, around[:, 0].T @ miss + (around[:, 1].T @ miss).T, (both + both.T) / 2]
        for i, (slope, old) in enumerate(zip(slopes, (start.unary, start.chain, start.skip))):
            slope = slope - pulls[i] * (held[i] - old)
            moment[i] = 0.9 * moment[i] + 0.1 * slope
            scale[i] = 0.999 * scale[i] + 0.001 * slope**2
            held[i] = held[i] + rate * (moment[i] / (1 - 0.9**step)) / (np.sqrt(scale[i] / (1 - 0.999**step)) + 1e-8)
    return Weights(held[0], held[1], (held[2] + held[2].T) / 2)


def marginals(g: Graph, weights: Weights, rounds: int | None = None, damping: float = 0.3) -> np.ndarray:
    """Beliefs (candidate, label) by loopy message passing over chain and skip edges.

    It ends when messages stay as they are, or after ``rounds``: unless given, more than any path is long.
    """
    n = len(g.given)
    nodes = max(n, int(g.edges[:, :2].max()) + 1) if len(g.edges) else n
    unary = np.zeros((nodes, LABELS))
    unary[:n] = g.features @ weights.unary.T
    known = np.flatnonzero(g.given >= 0)
    unary[known] += 50.0 * np.eye(LABELS)[g.given[known]]
    if len(g.edges):
        a, b, kind = g.edges.T
        votes = np.zeros((nodes, LABELS))
        sure = (b >= n) & (g.given[a] >= 0)
        np.add.at(votes, (b[sure], g.given[a[sure]]), 1)
        hubs = np.flatnonzero(votes.any(1))
        # Of most of its base spans, the first of equals; so firmly that no number of neighbours outweighs it.
        unary[hubs] += 50.0 * np.bincount(b, minlength=nodes)[hubs, None] * np.eye(LABELS)[votes[hubs].argmax(1)]
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        back = np.concatenate([np.arange(len(a), 2 * len(a)), np.arange(len(a))])
        pair = np.where((kind == 0)[:, None, None], weights.chain, weights.skip)
        pair = np.concatenate([pair, pair.transpose(0, 2, 1)])
        sent = np.zeros((len(source), LABELS))
        for _ in range(rounds or 60 + nodes):
            belief = unary.copy()
            np.add.at(belief, target, sent)
            inner = (belief[source] - sent[back])[:, :, None] + pair
            top = inner.max(1, keepdims=True)
            new = np.log(np.exp(inner - top).sum(1)) + top[:, 0]
            new -= new.max(1, keepdims=True)
            moved = np.abs(new - sent).max()
            sent = (1 - damping) * new + damping * sent
            if moved < 1e-4:
                break
        np.add.at(unary, target, sent)
    unary = unary[:n]
    p = np.exp(unary - unary.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def all_spans(text: str, base: list[Span], weights: Weights, sure: float = 0.9) -> list[Span]:
    """Base spans and those that the field adds, by start and then kind."""
    g = graph(text, base)
    if g is None or (g.given >= 0).all():
        return base
    p = marginals(g, weights)
    best = p[:, 1:].argmax(1)
    added = [(s, int(best[i]), e) for i, (s, e) in enumerate(g.places) if g.given[i] < 0 and p[i, best[i] + 1] >= sure]
    return sorted(base + added)


def hash_limit(share: float) -> int:
    """The greatest 63-bit hash among the least ``share`` of all; right to one document in any number of them."""
    return min(int(share * 2**63), 2**63 - 1)


def fit(docs: DataFrame, sample_docs: int = 20_000, sample_chars: int = 20_000, seed: int = 7, doc_id: str = "doc_id", text: str = "text") -> Weights:
    """Weights from about ``sample_docs`` documents of at most ``sample_chars`` characters, drawn by a hash.

    Both bounds hold at any size of the input; only documents with a digit or an at sign come to the driver.
    """
    total = docs.count()
    if not total:
        return prior()
    share = min(1.0, sample_docs / total)
    drawn = docs.filter(F.shiftrightunsigned(F.xxhash64(F.lit(seed), docs[doc_id], docs[text]), 1) <= F.lit(hash_limit(share)))
    drawn = drawn.filter((F.length(docs[text]) <= sample_chars) & docs[text].rlike("[0-9@]")).select(docs[text].alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(0):
                body = value.as_py()
                g = graph(body, base_spans(body))
                if g is not None:
                    rows.append((g.given.tolist(), g.features.ravel().tolist(), g.edges.ravel().tolist()))
            columns = list(zip(*rows)) or [(), (), ()]
            kinds = (pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["given", "features", "edges"])

    rows = drawn.mapInArrow(features, "given array<bigint>, features array<double>, edges array<bigint>").limit(2 * sample_docs).collect()
    return learn([Graph([], np.array(r.given), np.array(r.features).reshape(-1, FEATURES), np.array(r.edges, int).reshape(-1, 3)) for r in rows])


FOUND = pa.struct([("n_email", pa.int64()), ("n_ip", pa.int64()), ("n_card", pa.int64()), ("n_phone", pa.int64()),
                   ("base_sha256", pa.string()), ("spans", pa.string())])


def find(text: Column, weights: Weights, sure: float = 0.9) -> Column:
    """Counts and digest of the base spans, and all spans, of a text column, as a struct."""

    @F.arrow_udf("n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for value in batch:
                body = value.as_py() or ""
                base = base_spans(body)
                counts = [0] * len(KINDS)
                for _, kind, _ in base:
                    counts[kind] += 1
                digest = hashlib.sha256(shown(base).encode()).hexdigest()
                rows.append((*counts, digest, shown(all_spans(body, base, weights, sure))))
            columns = list(zip(*rows)) or [()] * len(FOUND)
            yield pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FOUND)], fields=list(FOUND))

    return scan(text)


def find_personal_data(docs: DataFrame, weights: Weights | None = None, text: str = "text", doc_id: str = "doc_id", into: str = "personal") -> DataFrame:
    """``docs`` with the struct of ``find`` as one more column; weights are fitted on ``docs`` unless given."""
    weights = weights or fit(docs, doc_id=doc_id, text=text)
    return docs.withColumn(into, find(F.col(text), weights))
