import hashlib
import random

import numpy as np
import pytest

from tessera.llm import bwt_dedup as B

from awkward_tables import awkward, documents, no_documents  # noqa: F401


def brute(rows, length):
    """doc -> (bytes, removed, runs, hash) by a set of all earlier strings."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        data = t.encode()
        mark = bytearray(len(data))
        for k in range(len(data) - length + 1):
            w = data[k:k + length]
            if w in seen:
                mark[k:k + length] = b"\1" * length
            seen.add(w)
        kept = bytes(c for c, m in zip(data, mark, strict=True) if not m)
        runs = sum(1 for k, m in enumerate(mark) if m and (k == 0 or not mark[k - 1]))
        out[i] = (len(data), sum(mark), runs, hashlib.sha256(kept).hexdigest())
    return out


def result(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


@pytest.mark.parametrize("seed", range(40))
def test_index_marks_what_starts_earlier(seed):
    rng = random.Random(seed)
    length = rng.choice([8, 15, 20])
    parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(length, 60))) for _ in range(rng.randint(1, 12))]
    parts += [parts[0], parts[-1] + b"abab"]
    index = B.RunIndex(parts, length)
    seen, expected = set(), []
    at = 0
    for p in parts:
        for i in range(len(p) - length + 1):
            if p[i:i + length] in seen:
                expected.append(at + i)
            seen.add(p[i:i + length])
        at += len(p) + 1
    assert index.repeats().tolist() == expected


def test_pairing_leaves_out_only_what_shares_no_window():
    rng = random.Random(7)
    anchor = b"ANCHOR"
    rows = set()
    for d in range(60):
        side = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(2)]
        rows.add((d, 0, side[0] + anchor + side[1], len(side[0])))
    kept = {r[0] for r in B.paired(rows, 12, 6)}
    windows = {}
    for d, _, p, off in rows:
        for i in range(len(p) - 11):
            if i <= off and off + 6 <= i + 12:
                windows.setdefault(p[i:i + 12], set()).add(d)
    shared = set().union(*[w for w in windows.values() if len(w) > 1])
    assert shared and shared <= kept and kept != {r[0] for r in rows}


def test_index_is_run_compressed_on_repetitive_texts():
    rng = random.Random(1)
    one = bytes(rng.choice(b"abcdefgh") for _ in range(150))
    index = B.RunIndex([one] * 200, 100)
    assert len(index.starts) < 2000 and index.ends[-1] > 30_000


def test_equal_windows_have_equal_anchors():
    rng = random.Random(2)
    shared = bytes(rng.choice(b"abcdefgh ") for _ in range(400))
    texts = [bytes(rng.choice(b"abcdefgh ") for _ in range(rng.randint(0, 300))) + shared for _ in range(5)]
    h, g, text, start, size, _ = B.segments(texts, np.zeros(0, np.uint64))
    keys = {}
    for a, t, s, n in zip(h.tolist(), text.tolist(), start.tolist(), size.tolist(), strict=True):
        for k in range(n - 99):
            keys.setdefault(texts[t][s + k:s + k + 100], set()).add(a)
    assert all(len(v) == 1 for v in keys.values())
    assert sum(len(t) - 99 for t in texts) == int((size - 99).sum())


@pytest.mark.parametrize("hot", [B.HOT, 3])
def test_query_equals_brute_force(spark, documents, hot, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    expected = brute(rows, 100)
    texts = B.keyed_texts(documents)
    if hot != B.HOT:
        whole = B.marks
        monkeypatch.setattr(B, "marks", lambda t, length: whole(t, length, hot=hot))
    assert sum(v[1] for v in expected.values()) > 0 and texts.count() == len(rows)
    assert result(B.remove_repeats(documents)) == expected


def test_near_copies_and_self_overlaps(spark, monkeypatch):
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefgh \n") for _ in range(900))
    rows = [(0, base), (1, base), (2, base[:400] + "X" + base[400:]), (3, "ab" * 300), (4, "q" * 99), (5, "q" * 101), (6, "é" * 120)]
    rows += [(10 + k, base[:100 + 7 * k] + f"edit {k} " + base[130 + 7 * k:]) for k in range(60)]
    monkeypatch.setattr(B, "INDEX_BYTES", 2000)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(B.remove_repeats(df)) == brute(rows, 100)


def test_slices_of_long_texts_give_the_same(spark, monkeypatch):
    rng = random.Random(6)
    base = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    rows = [(0, base + base[:500]), (1, base[1000:] + "tail"), (2, "x" + base)]
    monkeypatch.setattr(B, "PIECE_BYTES", 700)
    import tessera.llm.common as C
    monkeypatch.setattr(C, "PIECE_BYTES", 700)
    parts = [t.encode() for _, t in rows]
    h, g, text, start, size, _ = B.segments(parts, np.zeros(0, np.uint64))
    assert int((size - 99).sum()) == sum(len(p) - 99 for p in parts)


def test_a_repeated_row_is_one_document(spark):
    rng = random.Random(9)
    base = "".join(rng.choice("abcdefgh ") for _ in range(500))
    rows = [(1, base), (2, base[:300]), (3, "z" + base)]
    df = spark.createDataFrame([*rows, rows[0], rows[1], rows[0]], "doc_id long, text string")
    expected = brute(rows, 100)
    for parts in (1, 4):
        assert result(B.remove_repeats(df.repartition(parts))) == expected
    assert B.remove_repeats(df).count() == 6


def test_awkward_rows(spark, awkward, no_documents):
    rows = B.remove_repeats(awkward).collect()
    assert len(rows) == awkward.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["n_bytes"] == by[3]["n_bytes"] == 0 and by[None]["n_removed"] == 0
    assert by[5]["n_bytes"] == len(awkward.where("doc_id = 5").first()["text"])
    assert bytes(by[9]["kept"]).decode() == awkward.where("doc_id = 9").first()["text"]
    assert B.remove_repeats(no_documents).count() == 0
