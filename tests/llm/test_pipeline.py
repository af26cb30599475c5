import corpus_pipeline
from paddock.llm import registry
from paddock.llm.common import stage, table

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_drop_only_what_they_decide(spark):
    docs = table(spark, SF, "documents")
    columns, names, kept = docs.columns, [n for n, _ in corpus_pipeline.STAGES], {r.doc_id for r in docs.select("doc_id").collect()}
    assert len(names) == 5
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    for i, (name, function) in enumerate(corpus_pipeline.STAGES):
        docs = stage(function(spark, docs, SF), "test")
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= kept
        if i < 4:
            assert docs.columns == columns
        if name == "quality classifier":
            good = {d for d, q in labels.items() if q == 1 and d in kept}
            assert len(good - now) <= 0.02 * len(good)
        if name == "line dedup":
            assert now == kept
        kept = now
    assert {"doc_id", "n_tokens", "ids"} <= set(docs.columns) and docs.count() == len(kept) > 0


def test_registered_queries_have_the_numbered_names():
    assert {int(k[2:].split("_")[0]) for k in registry.QUERIES} == set(range(1, 14))
    assert set(registry.SQL) <= set(registry.QUERIES)
