import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing as M

from awkward_tables import awkward, documents, no_documents  # noqa: F401


def targets(sizes):
    """Reshare the excess over three times a source's size until none is above."""
    names = sorted((n for n in sizes if n is not None)) + [n for n in sizes if n is None]
    weight = {n: i % 3 + 1 for i, n in enumerate(names)}
    out, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[n] for n in free)
        over = [n for n in free if level * weight[n] > 3 * sizes[n]]
        if not over:
            return out | {n: level * weight[n] for n in free}
        for n in over:
            out[n] = 3.0 * sizes[n]
            left -= out[n]
            free.remove(n)
    return out


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 5}, {"a": 0, "b": 0}, {"a": 7}, {None: 50, "z": 1, "Z": 100, "é": 3, "": 9},
    {f"s{i}": (i * 7919) % 97 for i in range(40)}, {f"s{i}": 3 ** i for i in range(12)}])
def test_targets_equal_repeated_resharing(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in M.source_targets(df).collect()}
    assert got == pytest.approx(targets(sizes))


def test_mix_hits_its_targets_and_reruns_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = M.mix_query(docs).join(docs.select("doc_id", "source", "text"), "doc_id").collect()
    again = {r["doc_id"]: r["taken"] for r in M.mix_query(docs.repartition(7)).collect()}
    taken, size = Counter(), Counter()
    for r in rows:
        assert r["size"] == len(re.findall("[^\x20\x09-\x0d]+", r["text"])) and r["taken"] == again[r["doc_id"]]
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[r["source"]] += r["taken"]
        size[r["source"]] += r["size"]
    goal = targets(dict(size))
    for r in rows:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(goal[r["source"]])
    largest = defaultdict(int)
    for r in rows:
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert all(abs(taken[s] - goal[s]) <= largest[s] for s in goal)


def test_copies_differ_by_one_at_most_within_a_source(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "a" if i % 3 else "b") for i in range(2000)], "doc_id long, text string, source string")
    rows = M.mix(docs).select("source", "copies").collect()
    for s in "ab":
        copies = [r["copies"] for r in rows if r["source"] == s]
        assert max(copies) - min(copies) <= 1


def test_plan_has_no_python(spark, documents):
    plan = M.mix_query(documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_awkward_rows(spark, awkward, no_documents):
    mixed = M.mix(awkward)
    rows = mixed.collect()
    assert len(rows) == awkward.count() and set(awkward.columns) | {"copies"} <= set(mixed.columns)
    assert all(r["size"] == 0 for r in rows if r["doc_id"] in (2, 3, 4))
    out = M.emit_copies(mixed)
    assert out.count() == sum(r["copies"] for r in rows)
    assert sorted({r["copy"] for r in out.collect()})[0] == 0
    assert M.mix_query(awkward).count() == awkward.count()
    narrow = M.mix_query(awkward).select("doc_id", "size", "taken").collect()
    assert sorted((r["doc_id"] or 0, r["size"], r["size"] * r["copies"]) for r in rows) == sorted((r["doc_id"] or 0, r["size"], r["taken"]) for r in narrow)
    assert M.mix_query(no_documents).count() == 0 and M.emit_copies(M.mix(no_documents)).count() == 0


def test_a_source_without_words_is_left_out(spark):
    docs = spark.createDataFrame([(1, "", "a"), (2, None, "a"), (3, "x y z", "b")], "doc_id long, text string, source string")
    rows = {r["doc_id"]: r for r in M.mix_query(docs).collect()}
    assert rows[1]["target"] == 0 and rows[1]["taken"] == 0 and rows[3]["target"] == 3.0 and rows[3]["taken"] == 3
    assert M.mix(docs).where(F.col("copies") < 0).count() == 0
