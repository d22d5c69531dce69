"""Every stage of the corpus pipeline against its operator's brute-force form, on its own input."""

import pytest

import corpus_pipeline as CP
from tessera.llm import decontaminate, secrets
from tessera.llm.mixing import mix_query

from test_jaccard_join import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in CP.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema if len(out) < 5 else None)
        out.append(docs)
    return out


def rows(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def test_all_but_the_last_stage_return_the_columns_of_documents(stages):
    for df in stages[:5]:
        assert df.columns == stages[0].columns


def test_toxicity_drops_what_it_scores_toxic_and_keeps_the_rest(spark, stages):
    from tessera.llm import toxicity as X
    net = X.fit(spark, stages[0], spark.read.parquet(f"{SF}/labels.parquet"), X.train_rows)
    before, after = rows(stages[0]), rows(stages[1])
    scores = X.score_texts(net, [before[i]["text"].encode() for i in sorted(before)])
    # the score of a text may differ in the last bits between pieces
    assert {i for i, s in zip(sorted(before), scores, strict=True) if s < X.THRESHOLD - 1e-4} <= set(after)
    assert set(after) <= {i for i, s in zip(sorted(before), scores, strict=True) if s < X.THRESHOLD + 1e-4}
    assert all(before[i] == after[i] for i in after)


def test_one_document_of_each_group_stays(stages):
    before, after = rows(stages[1]), rows(stages[2])
    groups = brute([(i, r["text"]) for i, r in before.items()], 5, 80)
    assert set(after) == {i for i, (_, c) in groups.items() if i == c}


def test_contaminated_documents_go(spark, stages):
    items = [(r["item_id"], r["text"].lower().encode()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    index = decontaminate.Index(items)
    before, after = rows(stages[2]), rows(stages[3])
    assert set(after) == {i for i, r in before.items() if not index.matches([r["text"].lower().encode()])}


def test_secrets_are_cut_out_and_lengths_follow(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert set(before) == set(after)
    for i, r in after.items():
        assert r["text"] == secrets.redact(before[i]["text"]) and r["n_chars"] == len(r["text"])
        assert not secrets.base_spans(r["text"])


def test_the_mix_emits_whole_documents_as_often_as_it_takes_them(stages):
    from collections import Counter
    copies = Counter(r["doc_id"] for r in stages[5].collect())
    for r in mix_query(stages[4]).collect():
        assert copies[r["doc_id"]] * r["size"] == r["taken"]
    texts = rows(stages[4])
    assert all(r["text"] == texts[r["doc_id"]]["text"] for r in stages[5].collect())


def test_run_applies_the_stages(spark, stages):
    got = CP.run(spark, SF)
    assert got.columns == stages[5].columns and sorted(r["doc_id"] for r in got.collect()) == sorted(r["doc_id"] for r in stages[5].collect())
