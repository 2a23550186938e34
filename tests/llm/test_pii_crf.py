import hashlib
import random
import re

import numpy as np
import pytest

from salesmart.llm import pii_crf as pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(digits[::-1])]
            good = {"email": True, "ip": all(int(p[-4300:]) <= 255 and not p[:-4300].strip("0") for p in m[0].split(".")) if kind == "ip" else True,
                    "card": 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0, "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


@pytest.mark.parametrize("text", [
    "", "no data", "mail é a.b@c.de, x@y, @z.com a@b.c@d.e a@@b.cc", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 12.34.5", "4111 1111 1111 1111 and 4111-1111-1111-1112",
    "v " + "0" * 5000 + ".1.2.3 " + "0" * 5000 + "." + "0" * 9000 + "255.0.0 1.2.3." + "0" * 4400 + "256 " + "1" + "0" * 5000 + ".1.1.1",
    "call +1 (297) 555-8151 or +49.30.1234567890123 or +1  2", "٣.٣.٣.٣ +٣", "0" * 16 + " 1", "a@b.c.", "x" * 500 + "@y.z" + "9" * 500,
])
def test_base_equals_plain_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_base_equals_plain_patterns_on_random_text():
    draw = random.Random(5)
    for _ in range(3000):
        text = "".join(draw.choices("0123459.@+- ()ab\n", k=draw.randint(0, 60)))
        assert pii.base_spans(text) == brute(text), text


def test_long_runs_stay_linear():
    for unit in ("a", "9", "9.", "@", "a@", "+1 ", "(at)", "9-", "a."):
        pii.all_spans(unit * (200_000 // len(unit)), pii.base_spans(unit * (200_000 // len(unit))), pii.prior())


def sample():
    draw = random.Random(3)
    def digits(n):
        return "".join(draw.choices("0123456789", k=n))

    texts = []
    for _ in range(60):
        texts.append(f"please call +1 ({digits(3)}) {digits(3)}-{digits(4)} about order {digits(7)}, phone +1 ({digits(3)}) {digits(3)}-{digits(4)}")
        texts.append(f"write to mail someone.{digits(3)}@host{digits(1)}.org, part number {digits(8)} and {digits(16)}")
    return texts


def learned(texts):
    return pii.learn([g for t in texts if (g := pii.graph(t, pii.base_spans(t)))])


def kinds(text, weights):
    return [(pii.KINDS[k], text[s:e]) for s, k, e in pii.all_spans(text, pii.base_spans(text), weights)]


@pytest.mark.parametrize("weights", [pii.prior(), learned(sample())], ids=["prior", "fitted"])
def test_repeats_take_the_label_of_the_certain_one(weights):
    text = "Call +1 (297) 555-8151 now. " + "filler words go on here, " * 40 + "Again: 297 555 8151. Unrelated: 1234567."
    assert kinds(text, weights) == [("phone", "+1 (297) 555-8151"), ("phone", "297 555 8151")]
    mail = "Ask jo.smith1@example.org. " + "more filler " * 40 + "or jo.smith1 (at) example (dot) org, signed jo.smith1"
    assert [k for k, _ in kinds(mail, weights)] == ["email"] * 3


def test_nothing_is_added_without_a_reason():
    weights = learned(sample())
    for text in ("Order 1234567 of 2024-01-02, part 4711 0815 99", "Version 1.2.3.4000 and 300.1.1.1", "see 1234567890123456"):
        assert pii.all_spans(text, pii.base_spans(text), weights) == []


def test_message_passing_is_exact_on_a_tree():
    draw = np.random.default_rng(1)
    g = pii.Graph([(0, 1)] * 4, np.array([-1, 2, -1, -1]), draw.normal(size=(4, pii.FEATURES)), np.array([[0, 1, 0], [1, 2, 1], [1, 3, 0]]))
    w = pii.Weights(draw.normal(size=(5, pii.FEATURES)) / 3, draw.normal(size=(5, 5)), np.eye(5))
    total = np.zeros((4, 5))
    for labels in np.ndindex(*[5] * 4):
        if labels[1] != 2:
            continue
        score = sum(w.unary[y] @ f for y, f in zip(labels, g.features))
        score += w.chain[labels[0], labels[1]] + w.skip[labels[1], labels[2]] + w.chain[labels[1], labels[3]]
        for i, y in enumerate(labels):
            total[i, y] += np.exp(score)
    assert np.allclose(pii.marginals(g, w, 200), total / total.sum(1, keepdims=True), atol=1e-3)


def test_frames(spark):
    text = "a@b.cc é 1.2.3.4"
    rows = [(None, None, "x"), (1, "", "x"), (2, text, "y"), (2, text, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = pii.find_personal_data(docs).select("doc_id", "personal.*").collect()
    empty = hashlib.sha256(b"").hexdigest()
    want = ("email:0:6,ip:9:16", hashlib.sha256(b"email:0:6,ip:9:16").hexdigest())
    assert sorted((r.n_email, r.n_ip, r.n_card, r.n_phone, r.spans, r.base_sha256) for r in got) == [(0, 0, 0, 0, "", empty)] * 2 + [(1, 1, 0, 0, *want)] * 2
    assert pii.find_personal_data(docs.limit(0)).collect() == []


def test_fit_is_bounded(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('call +1 (297) 555-', 1000 + id) AS text")
    few, whole = pii.fit(docs, sample_docs=40), pii.fit(docs)
    assert np.abs(few.unary).sum() < np.abs(whole.unary).sum()


@pytest.mark.parametrize("repeats", [2, 10, 100, 1000])
@pytest.mark.parametrize("gap", [" ", "filler words go on here, " * 10])
def test_the_label_holds_however_often_a_number_repeats(repeats, gap):
    bare = ["297 555 8151"] * repeats
    # Fitted on texts in which such repeats are left to the field, too.
    repeated = [f"call +1 ({a}) 555-{b} or {gap}{a} 555 {b}" for a, b in zip(range(200, 500), range(1000, 1300))]
    for weights in (pii.prior(), learned(sample()), learned(sample() + repeated)):
        for words in (["+1 (297) 555-8151", *bare], [*bare, "+1 (297) 555-8151"]):
            text = f" and{gap}".join(words) + f" and{gap}order 1234567."
            assert kinds(text, weights) == [("phone", w) for w in words]
    pull = np.zeros((pii.LABELS, pii.FEATURES))
    pull[0, 0] = 0.5
    prior = pii.Weights(pull, pii.prior().chain, pii.prior().skip)
    assert len(kinds(f" and{gap}".join(["+1 (297) 555-8151", *bare]), prior)) == repeats + 1


def test_a_share_of_any_size_draws():
    limits = [pii.hash_limit(share) for share in (1e-18, 1e-9, 4e-7, 0.5, 1.0)]
    assert limits == sorted(limits) and limits[0] > 0 and limits[-1] == 2**63 - 1
    assert abs(limits[1] / 2**63 - 1e-9) < 1e-15
