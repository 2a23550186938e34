import hashlib
import random
import re

import pytest

from salesmart.llm import secret_links as sl

PATTERNS = (
    (r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    (r"AKIA[A-Z0-9]+", 0, 18), (r"[0-9a-f]+", 0, 16))
KEY = "AKIA" + "Z7" * 8
NOISE = "9mWq3zT8pLk2VxYb7RnC5dHs"


def brute(text):
    return sorted((m.start(), k, m.end()) for k, (p, group, least) in enumerate(PATTERNS) for m in re.finditer(p, text) if len(m[group]) >= least)


def found(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    return {r.doc_id: r for r in sl.find_secrets(docs, **options).collect()}


def reported(row, text):
    return [(k, text[int(s):int(e)]) for k, s, e in (x.split(":") for x in row.spans.split(",") if x)]


def test_base_equals_plain_patterns():
    draw = random.Random(2)
    words = ["token", "Password", "api_key", "APIKEY", "secret", "AKIA", " ", "=", ":", '"', "'", "abcdef0123456789", "Zz9+/", "é", "\n", "ſecret", "toKen"]
    for _ in range(3000):
        text = "".join(draw.choices(words, k=draw.randint(0, 14)))
        assert sl.base_spans(text) == brute(text), text


def test_digest_and_counts(spark):
    text = f'é token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and {KEY}'
    row = found(spark, [text])[0]
    shown = ",".join(f"{sl.KINDS[k]}:{s}:{e}" for s, k, e in brute(text))
    assert (row.n_assign, row.n_access, row.n_hex) == (1, 1, 1)
    assert row.base_sha256 == hashlib.sha256(shown.encode()).hexdigest() and row.spans == shown


@pytest.mark.parametrize("text,kinds", [
    (f"{NOISE} alone is nothing", []),
    ("see https://db.example.org/x for user: anna", []),
    (f"key {KEY} goes with {NOISE}", ["access", "secret"]),
    (f"user: anna, {NOISE} at https://db.example.org/x", ["identifier", "secret", "endpoint"]),
    ("password = hunter22 on host: db.internal:5432", ["secret", "endpoint"]),
    (f"user: anna {'filler ' * 100} {NOISE}", []),
    (f"user: anna\n\n{NOISE}", []),
    ("password = hunter22 and nothing else", []),
])
def test_weak_parts_need_their_complement(spark, text, kinds):
    assert [k for k, _ in reported(found(spark, [text])[0], text)] == kinds


def brute_links(text, reach):
    base = sl.base_spans(text)
    spans = sorted(base + sl.weak_spans(text, base))
    cuts = [m.start() for m in re.finditer(r"\n[ \t\r]*\n", text)]
    section = [sum(c < s for c in cuts) for s, *_ in spans]
    secret = [sl.KINDS[k] in sl.SECRET_KINDS for _, k, _ in spans]
    return [s for i, s in enumerate(spans) if s[1] < 3 or any(
        secret[i] != secret[j] and section[i] == section[j] and o[0] <= s[2] + reach and o[2] >= s[0] - reach for j, o in enumerate(spans))]


@pytest.mark.parametrize("reach", [7, 300])
def test_links_equal_brute_force(spark, reach):
    draw = random.Random(4)
    pieces = [f" {NOISE} ", " user: anna1 ", " https://a.example.org/path ", " words ", "\n\n", f" {KEY} ", " password=abcdefg ", " x " * 60, " host=q.example.org "]
    texts = ["".join(draw.choices(pieces, k=draw.randint(0, 30))) for _ in range(60)]
    got = found(spark, texts, reach=reach)
    for i, text in enumerate(texts):
        assert got[i].spans == ",".join(f"{sl.KINDS[k]}:{s}:{e}" for s, k, e in brute_links(text, reach))


def test_long_texts_stay_linear():
    for unit in ("a", "0", "token ", "user=", "://", "a.", "\n \n", '"', "=", "AKIA", "token  :", "auth "):
        text = unit * (200_000 // len(unit))
        sl.weak_spans(text, sl.base_spans(text))


def test_dense_document_and_nulls_and_repeats(spark):
    dense = "\n".join(f"user: anna{i} {NOISE}" for i in range(3000))
    docs = spark.createDataFrame([(1, dense, 1), (1, None, 2), (None, "", 3), (1, f"{KEY} {NOISE}", 4), (1, f"{KEY} {NOISE}", 4)], "doc_id long, text string, parts int")
    rows = sl.find_secrets(docs, keep=("doc_id", "parts")).collect()
    assert sorted((r.parts, len([x for x in r.spans.split(",") if x])) for r in rows) == [(1, 6000), (2, 0), (3, 0), (4, 2), (4, 2)]
    assert sl.find_secrets(docs.limit(0)).collect() == []


@pytest.mark.parametrize("n", [201, 2_000, 200_000])
def test_long_values_are_reported_whole(spark, n):
    draw = random.Random(n)
    value = "".join(draw.choices("ghijklmnopGHIJKLMN0123456789", k=n))
    for text, other in ((f"private_key = {value}", "user: anna"), (f"auth=eyJ{value}.{value}", "user: anna"), (f"client_id: a{value}", NOISE), (f"host: {value}", NOISE)):
        spans = [body for _, body in reported(found(spark, [f"{other}\n{text} end"])[0], f"{other}\n{text} end")]
        assert spans == [other, text]


def test_values_around_a_base_span():
    value = "Zq" * 150
    text = f"auth={value}.{KEY}.{value}"
    base = sl.base_spans(text)
    covered = sorted((s, e) for s, _, e in base + sl.weak_spans(text, base))
    assert covered[0][0] == 0 and covered[-1][1] == len(text) and sl.weak_spans(text, base)
    text = "login: anna/" + "".join(random.Random(1).choices("ghijklmnopGHIJKLMN0123456789", k=300))
    assert sl.weak_spans(text, [])[-1][2] == len(text)


def test_long_veiled_addresses_are_found_whole():
    from salesmart.llm import pii_crf

    text = "x" * 300 + " (at) example (dot) org"
    assert pii_crf.graph(text, []).places == [(0, len(text))]
