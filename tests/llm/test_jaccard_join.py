import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import jaccard_join as J

from awkward_tables import awkward, documents, no_documents  # noqa: F401

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, gram):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOW))
    if not words:
        return set()
    return {tuple(words[k:k + gram]) for k in range(len(words) - gram + 1)} if len(words) >= gram else {tuple(words)}


def brute(rows, gram=4, percent=85):
    sets = {i: shingles(t, gram) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def near_copies(seed=0, n=160):
    """Copies of a few texts with some words replaced, of many lengths, and unrelated texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    bases = [[rng.choice(words) for _ in range(k)] for k in (1, 2, 3, 4, 5, 6, 8, 12, 20, 40, 90, 200)]
    rows = []
    for d in range(n):
        own = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            own[rng.randrange(len(own))] = rng.choice(words)
        if rng.random() < 0.3:
            own.append(rng.choice(words))
        rows.append((d, " ".join(w.upper() if rng.random() < 0.1 else w for w in own)))
    return rows


def test_query_equals_brute_force(spark, documents):
    assert result(J.jaccard_query(documents)) == brute([(r["doc_id"], r["text"]) for r in documents.collect()])


@pytest.mark.parametrize("boundary", [None, 1, 1000])
def test_near_copies_whatever_is_light_or_heavy(spark, monkeypatch, boundary):
    if boundary:
        monkeypatch.setattr(J, "boundary", lambda sizes, percent: boundary)
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert result(J.jaccard_components(df)) == brute(rows)


def test_blocks_of_a_large_group_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 7)
    rows = near_copies(1, 220)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert result(J.jaccard_components(df, 5, 80)) == brute(rows, 5, 80)


@pytest.mark.parametrize("shingles", [1, 60])
def test_blocks_of_long_documents_give_the_same(spark, monkeypatch, shingles):
    monkeypatch.setattr(J, "BLOCK_SHINGLES", shingles)
    rows = near_copies(3, 120)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert result(J.jaccard_components(df, 5, 80)) == brute(rows, 5, 80)


def test_long_documents_meet_in_blocks_of_few_shingles(spark):
    sizes = {d: 1000 for d in range(60)} | {100: 10**9, 101: 10**9, 102: 1}
    groups = spark.createDataFrame([(min(60, d) // 60 * 100, d, n) for d, n in sizes.items()], "leader long, doc_id long, n long")
    tasks = {}
    for r in J.block_tasks(groups, 10_000).collect():
        tasks.setdefault((r["leader"], r["i"], r["j"]), []).append(r["doc_id"])
    assert max(sum(sizes[d] for d in t) for (leader, _, _), t in tasks.items() if leader == 0) <= 40_000
    assert len([t for leader, *t in tasks if leader == 100]) <= 6          # no more blocks than documents
    together = {(a, b) for t in tasks.values() for a in t for b in t}
    assert together == {(a, b) for a in sizes for b in sizes if (a < 60) == (b < 60)}


def test_a_task_turns_its_texts_into_sets_by_pieces(monkeypatch):
    from tessera.llm import common
    rows = [(leader, 0, j, d % 2, d, text) for leader, j in ((1, 0), (1, 1), (2, 0)) for d, text in near_copies(leader, 40)]
    names = ["leader", "i", "j", "block", "doc_id", "text"]
    table = pa.Table.from_pylist([dict(zip(names, r, strict=True)) for r in rows])
    monkeypatch.setattr(common, "PIECE_BYTES", 2000)
    whole, sizes = J.shingle_sets, []
    monkeypatch.setattr(J, "shingle_sets", lambda texts, gram: sizes.append(sum(map(len, texts))) or whole(texts, gram))
    got = list(J.task_sets(table.to_batches(max_chunksize=17), 4))
    assert max(sizes) <= 2000
    assert len(got) == 3
    for (ids, values, offsets, block), (leader, j) in zip(got, ((1, 0), (1, 1), (2, 0)), strict=True):
        own = near_copies(leader, 40)
        v, off = whole([t.encode() for _, t in own], 4)
        assert ids.tolist() == [d for d, _ in own]
        assert values.tolist() == v.tolist() and offsets.tolist() == off.tolist()
        assert block is None if j == 0 else block.tolist() == [d % 2 for d, _ in own]


def test_python_workers_get_small_batches(spark):
    from tessera.llm.common import text_map
    from tessera.session import BATCH_BYTES, ship_package
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.newSession()
    df = own.range(0, 2000, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 2000) AS text")
    text_map(df, lambda ids, texts: {"n": [len(texts)]}, "n long")
    sizes = [r[0] for r in df.mapInArrow(lambda bs: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in bs), "n long").collect()]
    assert sum(sizes) >= 2000 * 10_000 and max(sizes) <= BATCH_BYTES + 20_000
    other = spark.newSession()
    other.conf.set(key, "123456")
    ship_package(other)
    assert other.conf.get(key) in ("123456", "123456b")


def test_counts_that_are_not_known_bound_nothing(spark, monkeypatch):
    monkeypatch.setattr(J, "FULL_CELL", 1)
    rows = near_copies(2, 80)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(J.jaccard_components(df)) == brute(rows)


@pytest.mark.parametrize("seed", range(30))
def test_forest_connects_exactly_what_is_linked(seed):
    rng = random.Random(seed)
    sets = [sorted(rng.sample(range(40), rng.randint(3, 20))) for _ in range(25)]
    for _ in range(15):
        own = list(rng.choice(sets))
        own[rng.randrange(len(own))] = rng.randrange(40, 60)
        sets.append(sorted(set(own)))
    values = np.concatenate([np.array(s, dtype=np.uint64) for s in sets])
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])

    def components(edges):
        root = list(range(len(sets)))
        for a, b in edges:
            x, y = root[a], root[b]
            root = [min(x, y) if r in (x, y) else r for r in root]
        return root

    links = [(a, b) for a in range(len(sets)) for b in range(a)
             if 100 * len(set(sets[a]) & set(sets[b])) >= 70 * len(set(sets[a]) | set(sets[b]))]
    assert components(J.forest(np.arange(len(sets)), values, offsets, 70)) == components(links)
    side = np.array([rng.random() < 0.5 for _ in sets])
    across = [(a, b) for a, b in links if side[a] != side[b]]
    assert components(J.forest(np.arange(len(sets)), values, offsets, 70, side)) == components(across)


def test_awkward_rows(spark, awkward, no_documents):
    rows = J.jaccard_components(awkward).collect()
    assert len(rows) == awkward.count()
    by = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert by[2] == (0, 2) and by[3] == (0, 3) and by[4] == (0, 4) and by[6] == (1, 6)
    assert by[7][1] == 7 and by[8][1] == 7 and by[None][1] is None
    assert J.jaccard_components(no_documents).count() == 0
    kept = J.keep_one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 9]
    assert J.keep_one_of_each(no_documents).count() == 0


def test_the_stage_judges_rows_not_numbers(spark):
    a, b, c = (" ".join(f"{w}{i}" for i in range(30)) for w in "abc")
    rows = [(1, a), (2, b), (2, a), (3, b + " more"), (4, c), (4, c), (5, c), (None, a), (6, ""), (6, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["text"]) for r in J.keep_one_of_each(df).collect())
    assert got == [(0, a), (1, a), (2, b), (4, c), (6, ""), (6, "")]
