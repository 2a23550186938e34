import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from salesmart.llm import pair_bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
ODD = [
    "", " ", "  a", "a  ", "a\n b\n\nc", "world's don't  I'll  \n\n's 's ''s x'tt 'REs 're'll", "'s's's", "'", "a'", "'r", "'l l",
    "<|endoftext|>x<|endoftext|><|endoftext|> y  <|endoftext|>", "<|endoftext", "aaaaaaaa aaa a" * 5, "é ü ß 1234 ½ ² 　x\u0085y\x1c\x1d z",
    "\0a a\0", "� \U0001f600\U0001f600's",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def coded(texts, **settings):
    words = pair_bpe.Vocabulary(PATH, **settings)
    return [(np.frombuffer(ids, "<u4").tolist(), back.decode()) for ids, back in words.round_trips(pa.array(texts, pa.string()))]


def expected(library, texts):
    ids = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    return [(i, library.decode(i, skip_special_tokens=False)) for i in ids]


def test_odd_texts(library):
    for chunk in (1, 30, 1 << 20):
        assert coded(ODD, chunk_bytes=chunk) == expected(library, ODD)


def test_random_texts(library):
    r = random.Random(1)
    letters = [*" '\n\tstrevmldaéZ1²!-中 ", "<|endoftext|>", " ", " "]
    texts = ["".join(r.choices(letters, k=r.randrange(60))) for _ in range(4000)]
    assert coded(texts, chunk_bytes=5000) == expected(library, texts)
    assert coded(texts, chunk_bytes=5000, remembered=50) == expected(library, texts)


def test_every_character(library):
    texts = ["".join(chr(c) for c in range(low, low + 1024) if not 0xD800 <= c < 0xE000) for low in range(0, 0x110000, 1024)]
    assert coded(texts) == expected(library, texts)


def test_long_pieces(library):
    texts = ["a" * 200_001, "ab" * 100_000, "=" * 99_999 + "x", " " * 50_000, "the " * 20_000, "'s" * 20_000]
    assert coded(texts) == expected(library, texts)


def test_equal_hashes_are_found_out(library, monkeypatch):
    monkeypatch.setattr(pair_bpe.word_hash, "_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    texts = ["one two six", "two one", "<|endoftext|> abc abd", ""]
    assert coded(texts, chunk_bytes=8) == expected(library, texts)


def test_an_index_merges_by_rank():
    # ab, then abc: in "ababc" and "aab" side by side, whatever the order of the pieces.
    merges = pair_bpe.Merges(np.array([0, 3]), np.array([1, 2]), np.array([3, 4]), 5)
    found = merges.apply(np.array([0, 1, 0, 1, 2, 0, 0, 1]), np.array([5, 0, 3]))
    assert found.ids.tolist() == [3, 4, 0, 3] and found.lengths.tolist() == [2, 0, 2]
    overlapping = pair_bpe.Merges(np.array([0, 1]), np.array([0, 1]), np.array([1, 2]), 3)
    assert overlapping.apply(np.zeros(7, np.int64), np.array([7])).ids.tolist() == [2, 1, 0]
    with pytest.raises(ValueError):
        pair_bpe.Merges(np.array([3, 0]), np.array([2, 1]), np.array([4, 3]), 5)


def test_other_kinds_of_vocabulary_are_refused(tmp_path):
    with open(PATH) as file:
        spec = json.load(file)
    for change in ({"normalizer": {"type": "NFC"}}, {"model": spec["model"] | {"dropout": 0.1}}, {"pre_tokenizer": {"type": "Whitespace"}}):
        (tmp_path / "v.json").write_text(json.dumps(spec | change))
        with pytest.raises(ValueError):
            pair_bpe.Vocabulary(str(tmp_path / "v.json"))


def test_frames(spark, library):
    rows = [(i, t, "x", "y") for i, t in enumerate([*ODD, "again", "again"])] + [(None, None, None, None), (3, None, "a", "b"), (3, "twice", "a", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string").repartition(3)
    found = pair_bpe.round_trip(docs, PATH)
    got = sorted(found.collect(), key=str)
    want = [(d, np.array(i, "<u4").tobytes(), t) for (d, *_), (i, t) in zip(rows, expected(library, [r[1] or "" for r in rows]))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    back = pair_bpe.decode_documents(found, PATH)
    assert back.columns == ["doc_id", "decoded", "text"] and back.filter("decoded IS DISTINCT FROM text").isEmpty()
    assert pair_bpe.round_trip(docs.limit(0), PATH).isEmpty()


def test_bytes_that_are_no_text(spark):
    docs = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text UNION ALL SELECT 2L, 'plain'")
    assert sorted(r.decoded for r in pair_bpe.round_trip(docs, PATH).collect()) == ["a�b", "plain"]


def test_query(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.QUERIES["op12_pair_bpe"](spark, SF).collect()}
    sha = lambda x: hashlib.sha256(x).hexdigest()
    assert got == {
        d: (len(i), sha(np.array(i, "<u4").tobytes()), sha(t.encode())) for d, (i, t) in zip(docs, expected(library, list(docs.values())))}
