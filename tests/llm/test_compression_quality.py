import math
import os
import random

import numpy as np
import pytest
import zstandard

from salesmart.llm import compression_quality as cq


def words(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choices("etaoinshrdlu", k=r.randint(2, 9))) for _ in range(n))


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def brute(text):
    separators = " \t\n\x0b\x0c\r"
    cut, word = [], ""
    for c in (text or "") + " ":
        if c in separators:
            cut += [word] if word else []
            word = ""
        else:
            word += c
    windows = [tuple(cut[i:i + 3]) for i in range(len(cut) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(separators)]
    return (len(cut), sum(map(len, cut)), sum(c in "#*$%&|<>" for c in text or ""),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered),
            len(cut) < 50 or 100 * len(covered) > 50 * len(cut))


def test_counts_equal_brute_force(spark):
    texts = [None, "", " \n\t ", "a", "é ü x \x85y", "a b c a b c", "x\nx\n \n \nx\r\n", words(200, 1),
             words(60, 2) + "\n" + words(60, 2), "#|<> &&" * 20, "der " * 500, words(40, 3) * 3]
    got = {r.doc_id: r for r in cq.score_documents(frame(spark, texts)).select("doc_id", "quality.*").collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(text), text
        assert not (r.base_failed and r.kept)


def test_bands_reject_repetition_and_noise_and_keep_prose(spark):
    noise = os.urandom(6000).hex()
    random_words = " ".join("".join(random.Random(i).choices([chr(c) for c in range(33, 127)], k=40)) for i in range(200))
    phrase = [" ".join(words(6, s).split()) for s in range(9)]
    looped = "\n".join(f"{phrase[i % 9]} {phrase[(i * 7 + i // 9) % 9]} {i}" for i in range(400))
    half = words(700, 8) + " " + random_words
    got = [r.kept for r in cq.keep_good(frame(spark, [noise])).collect()]
    assert got == []
    kept = {r.doc_id for r in cq.keep_good(frame(spark, [words(300, 5), words(5000, 6), random_words, looped, half])).collect()}
    assert kept == {0, 1}


def test_ratio_is_that_of_the_whole_text(spark):
    text = words(30_000, 9)
    row = cq.score_documents(frame(spark, [text])).select("quality.*").first()
    pack = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False)
    assert row.ratio == pytest.approx(len(text.encode()) / len(pack.compress(text.encode())))
    assert row.kept and row.bad_chunk_share == 0


def test_extra_columns_repeats_nulls_and_no_rows(spark):
    rows = [(None, words(80, 1), "k", 1), (None, words(80, 1), "k", 1), (3, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int")
    assert cq.keep_good(docs).columns == docs.columns
    assert [tuple(r) for r in cq.keep_good(docs).collect()] == rows[:2]
    assert cq.score_documents(docs.limit(0)).collect() == []


def plain_limits(texts, limits=cq.Limits()):
    """(chunk, class): least and greatest ratio, from the distinct texts, in plain Python."""
    pack = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False).compress
    logs = {}
    for text in {t for t in texts if t}:
        own = text.encode()
        chunks = [own[i:i + 4096] for i in range(0, len(own), 4096)]
        bins = {(False, math.floor(4 * math.log2(len(own))), round(500 * math.log(len(own) / len(pack(own)))))} if len(own) >= 128 else set()
        bins |= {(True, math.floor(4 * math.log2(len(c))), round(500 * math.log(len(c) / len(pack(c)))))
                 for c in chunks if len(chunks) > 1 and len(c) >= 128}
        for chunk, length, at in bins:
            logs.setdefault((chunk, length), []).append(at / 500)
    out = {}
    for key, found in logs.items():
        low, middle, high = np.percentile(found, [25, 50, 75])
        reach = limits.spread * max((high - low) / 1.349, 0.02) * (1 + 2 / math.sqrt(len(found)))
        out[key] = math.exp(middle - reach), math.exp(middle + reach)
    return out


def plain_verdict(text, known):
    """Whether a text passes, in plain Python."""
    pack = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False).compress
    own = (text or "").encode()

    def leaves(piece, chunk):
        ratio = len(piece) / len(pack(piece))
        least, most = known[chunk, math.floor(4 * math.log2(len(piece)))] if len(piece) >= 128 else (0, math.inf)
        return not least <= ratio <= most or cq.outside(ratio, len(piece), cq.BANDS)

    chunks = [own[i:i + 4096] for i in range(0, len(own), 4096)]
    bad = sum(len(c) for c in chunks if leaves(c, len(chunks) > 1))
    return not brute(text)[-1] and not leaves(own, False) and bad <= 0.4 * len(own)


def test_limits_and_verdicts_equal_brute_force(spark):
    r = random.Random(3)
    texts = [words(r.choice([60, 90, 200, 500, 900, 1500]), s) for s in range(150)] + [None, "", words(60, 1), words(3000, 2)]
    texts += [f"{texts[0]} {k}" * 2 for k in range(3)] + [texts[5]] * 400  # copies do not move the limits
    want = plain_limits(texts)
    got = cq.usual(frame(spark, texts).repartition(3))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    rows = cq.score_documents(frame(spark, texts)).select("doc_id", "quality.kept").collect()
    assert {x.doc_id: x.kept for x in rows} == {i: plain_verdict(t, want) for i, t in enumerate(texts)}


def test_the_corpus_tells_what_fixed_bands_and_base_rules_do_not(spark):
    prose = [words(random.Random(s).randint(150, 400), s) for s in range(300)]
    marks = ["##### ", "$$$$$ ", "%%%%% ", "&&&&& "]
    junk = ["".join(w + random.Random(s * 1000 + i).choice(marks) for i, w in enumerate(words(170, 1000 + s).split())) for s in range(12)]
    docs = frame(spark, prose + junk)
    kept = {x.doc_id for x in cq.keep_good(docs).collect()}
    assert len(kept & set(range(300))) >= 298 and not kept & set(range(300, 312))
    # Without the method, or with it far too wide, all of the junk stays.
    assert not any(brute(t)[-1] for t in junk)
    assert cq.keep_good(docs, cq.Limits(spread=1000.0)).count() == 312


def test_a_column_of_the_same_name_is_replaced(spark):
    docs = frame(spark, [words(80, 1)]).selectExpr("*", "1 AS quality", "2 AS hash", "3 AS bin", "true AS chunk")
    row = cq.score_documents(docs).first()
    assert row.quality.kept and (row.hash, row.bin, row.chunk) == (2, 3, True)
    assert cq.keep_good(docs).columns == docs.columns
