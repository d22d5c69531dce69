import base64
import hashlib
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import prefix_bpe as B

from awkward_tables import awkward, documents, no_documents  # noqa: F401

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
FILE = P.path("byte_bpe_multi_50k.tiktoken")
with open(FILE, "rb") as f:
    RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
CODEC = B.Codec(RANKS, P.PATTERN)
V = CODEC.vocabulary
REF = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
TOKENS = sorted(RANKS)
near_cuts = st.text(alphabet="aeslvtr'  \n\t1!.é日", max_size=14)


def test_every_token_encodes_itself():
    assert all(V.merged(t) == [r] for t, r in list(RANKS.items())[::7])


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), near_cuts, st.lists(st.sampled_from(TOKENS), max_size=8).map(lambda t: b"".join(t).decode("utf8", "ignore")),
                 st.text(alphabet="abeinst", max_size=120)))
def test_texts_encode_as_the_tokenizer_library_does(text):
    ids = CODEC.encode(text).tolist()
    assert ids == REF.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


def test_letters_and_spaces_of_all_planes_are_cut_alike():
    for c in [*range(0x3000), *range(0x3000, 0xD800, 7), *range(0xE000, 0x20000, 11), *range(0x20000, 0x110000, 997)]:
        s = f"a{chr(c)}b 1{chr(c)} {chr(c)}"
        assert CODEC.encode(s).tolist() == REF.encode_ordinary(s), hex(c)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(TOKENS), max_size=12).map(b"".join))
def test_last_tokens_are_those_of_all_prefixes(data):
    p = B.PrefixTokens(V, data)
    want = [V.merged(data[:n])[-1] for n in range(1, len(data) + 1)]
    assert p.last == want and p.tokens() == V.merged(data)


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=150), st.lists(st.tuples(st.integers(0, 200), st.integers(0, 6), st.binary(max_size=6)), max_size=5), st.binary(max_size=20))
def test_appends_and_edits_of_bytes(data, edits, more):
    p = B.PrefixTokens(V, data)
    for at, gone, new in edits:
        at = min(at, len(data))
        data = data[:at] + new + data[at + gone:]
        p.replace(at, min(at + gone, len(p.data)), new)
        assert p.last == B.PrefixTokens(V, data).last
    p.append(more)
    assert p.tokens() == V.merged(data + more)


@settings(max_examples=300, deadline=None)
@given(near_cuts, st.lists(st.tuples(st.booleans(), st.integers(0, 60), st.integers(0, 8), near_cuts), max_size=7))
def test_appends_and_edits_of_texts(text, changes):
    e = B.TextEncoder(V, P.PATTERN, text)
    for append, at, gone, new in changes:
        at = len(text) if append else min(at, len(text))
        stop = min(len(text), at + gone)
        text = text[:at] + new + text[stop:]
        e.append(new) if append else e.replace(at, stop, new)
        assert e.text == text and e.tokens() == REF.encode_ordinary(text)


def test_an_edit_in_a_long_match_computes_few_entries(monkeypatch):
    rng = np.random.default_rng(2)
    text = "".join(rng.choice(list("abeinst"), 20_000))
    e = B.TextEncoder(V, P.PATTERN, text)
    seen = []
    extend = B.PrefixTokens._extend

    def counted(self, stop_when=None):
        before = len(self.last)
        extend(self, stop_when)
        seen.append(len(self.last) - before)

    monkeypatch.setattr(B.PrefixTokens, "_extend", counted)
    e.replace(10_000, 10_003, "xx")
    edited = e.tokens()
    e.append("abc")
    appended = e.tokens()
    assert sum(seen) < 500
    text = text[:10_000] + "xx" + text[10_003:]
    assert edited == B.PrefixTokens(V, text.encode()).tokens()
    assert appended == B.PrefixTokens(V, text.encode() + b"abc").tokens()


def test_time_grows_with_the_length():
    for unit in ("a", "ab", " ", "日本", "!", "x1", "'s"):
        start = time.time()
        CODEC.encode(unit * (200_000 // len(unit)))
        assert time.time() - start < 10


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_rows_of_awkward_tables(spark, awkward, no_documents):
    rows = B.encode_documents(awkward, FILE, P.PATTERN, with_ids=True).collect()
    texts = sorted((r["doc_id"] or 0, r["text"] or "") for r in awkward.select("doc_id", "text").collect())
    assert len(rows) == len(texts)
    for r, (i, text) in zip(sorted(rows, key=lambda r: r["doc_id"] or 0), texts, strict=True):
        ids = REF.encode_ordinary(text)
        assert (r["doc_id"] or 0, r["n_tokens"], r["ids"]) == (i, len(ids), ids)
        assert r["ids_sha256"] == sha(np.array(ids, "<u4").tobytes()) and r["decoded_sha256"] == sha(text.encode())
    assert B.encode_documents(no_documents, FILE, P.PATTERN).count() == 0


def test_query_equals_the_library(spark, documents, monkeypatch):
    monkeypatch.setattr(B, "REMEMBERED", 50)
    want = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    rows = B.encode_query(spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"] for r in rows} == set(want)
    for r in rows:
        ids = REF.encode_ordinary(want[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(want[r["doc_id"]].encode()))
