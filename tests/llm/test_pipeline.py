from collections import Counter

import corpus_pipeline
from llm_cases import SF_DIR, odd_documents  # noqa: F401
from test_mixing import plain_copies, plain_targets
from test_packing import check as check_packing
from test_simhash_dedup import plain_fingerprint, plain_groups

from lexmill.llm import queries, toxicity
from lexmill.llm.common import staged


def test_stages_against_brute_force(spark):
    docs = queries.table(spark, SF_DIR, "documents")
    columns = docs.columns
    outputs = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = staged(stage(spark, docs, SF_DIR), "stage")
        if name != "packing":
            assert docs.columns == columns
        outputs.append(([tuple(r) for r in before.collect()], docs.collect()))

    (source, clean), (_, single), (_, apart), (_, mixed), (packed_from, pieces) = outputs
    model = toxicity.train(queries.table(spark, SF_DIR, "documents"), queries.table(spark, SF_DIR, "labels"))
    predicted = {r["doc_id"]: r["predicted"] for r in toxicity.score(queries.table(spark, SF_DIR, "documents"), model).collect()}
    assert sorted(r["doc_id"] for r in clean) == sorted(i for i, *_ in source if predicted[i] == 0)
    assert {r["doc_id"]: tuple(r) for r in clean}.items() <= {r[0]: r for r in source}.items()

    last = {}
    for r in clean:
        key = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
        last[key] = max(last.get(key, r["doc_id"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in single) == sorted(last.values())

    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in single}
    groups = plain_groups(list(prints.items()), corpus_pipeline.RADIUS)
    assert sorted(r["doc_id"] for r in apart) == sorted(i for i, p in prints.items() if groups[p] == i)

    sizes = Counter()
    for r in apart:
        sizes[r["source"]] += len(r["text"].encode().split())
    targets = plain_targets(dict(sizes))
    expected = Counter({r["doc_id"]: plain_copies(r["doc_id"], targets[r["source"]] / sizes[r["source"]]) for r in apart})
    assert Counter(r["doc_id"] for r in mixed) == +expected

    assert check_packing(pieces, mixed) <= 0.02 * sum(r["length"] for r in pieces)


def test_run_on_odd_documents(spark, odd_documents, tmp_path):
    odd_documents.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(8, 1, 1), (1, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    spark.createDataFrame([], odd_documents.select("doc_id", "text", "lang", "source", "n_chars").schema).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "none" / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
