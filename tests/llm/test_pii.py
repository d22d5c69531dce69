import random
import re

import numpy as np
import pytest

from tessera.llm import pii as P

from awkward_tables import awkward, documents, no_documents  # noqa: F401

# the contract's patterns, as they stand
PATTERNS = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and P.luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return sorted((m.start(), m.end(), k) for k, p in PATTERNS.items() for m in p.finditer(text) if passes(k, m.group()))


def test_base_spans_equal_the_patterns_on_random_texts():
    rng = random.Random(5)
    parts = ["a.b@", "@", "x@y.z", "a@b", ".", "..", "1.2.3.4", "256.1.1.1", "5.6.7.8.9.1.2.3", "4111 1111 1111 1111",
             "4111-1111-1111-1111", "+1 (017) 555-7713", "+", "(", ")", " ", "-", "0004.1.1.1", "a@b.c@d.e", "é", "1", "@x.y."]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 8)))
        assert sorted(P.base_spans(text)) == brute(text), text


def test_query_equals_the_patterns(spark, documents):
    import hashlib
    got = {r["doc_id"]: r for r in P.find_pii(documents).collect()}
    for r in documents.collect():
        base = P.joined(P.ordered(brute(r["text"])))
        row = got[r["doc_id"]]
        assert row["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) <= set(row["spans"].split(",")) | {""}
        assert row["n_email"] == base.count("email:") and row["n_card"] == base.count("card:")


def test_expectation_maximisation_finds_reliable_labelers():
    """Two good labelers, one that votes at random: the good ones are told apart from it."""
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.4
    good = np.where(rng.random((20_000, 2)) < 0.9, np.where(truth, 1, -1)[:, None], np.where(truth, -1, 1)[:, None])
    noise = rng.choice([-1, 1], 20_000)
    codes = [P.pattern("number", (0, int(a), int(b), int(c), 0, 0), 10) for (a, b), c in zip(good, noise, strict=True)]
    values, count = np.unique(codes, return_counts=True)
    post, table, share = P.reliabilities(values, count.astype(float))
    assert abs(table[1, 1, 2] - 0.9) < 0.05 and abs(table[0, 1, 0] - 0.9) < 0.05
    assert abs(table[1, 3, 2] - table[0, 3, 2]) < 0.05
    guess = dict(zip(values.tolist(), post, strict=True))
    assert np.mean([(guess[c] > 0.5) == t for c, t in zip(codes, truth, strict=True)]) > 0.88
    prob = P.classifier(values, count.astype(float), post)
    assert np.mean([(prob[c] > 0.5) == t for c, t in zip(codes, truth, strict=True)]) > 0.88


def test_pattern_numbers_round_trip():
    for kind in P.KINDS:
        code = P.pattern(kind, (1, -1, 0, 1, -1, 0), 20)
        k, v, n = P.unpack(np.array([code]))
        assert P.KINDS[k[0]] == kind and v[0].tolist() == [1, -1, 0, 1, -1, 0] and n[0] == 2 and code < P.patterns()


@pytest.mark.parametrize("text", ["@" * 50_000, "a@" * 50_000, "1." * 50_000, "+1" * 50_000, "[at]" * 20_000, "1 " * 50_000])
def test_long_repeats_take_linear_time(text):
    P.base_spans(text)
    P.loose_spans(text)


def test_awkward_rows(spark, awkward, no_documents):
    rows = P.find_pii(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(r["spans"] == "" for r in rows if r["doc_id"] in (2, 3, 4))
    assert P.find_pii(no_documents).count() == 0
