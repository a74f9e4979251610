"""The corpus pipeline, stage by stage."""

import corpus_pipeline
from lapstats.llm import quality_nbsvm, queries
from lapstats.llm.common import table
from lapstats.session import materialize
from tests.llm.test_operators import SF, _contaminated, _fingerprint, _groups, _linked


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    bench = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    model, kept = queries.quality_model(spark, docs, SF), docs
    for name, stage in corpus_pipeline.STAGES:
        rows = {r.doc_id: r.text for r in kept.select("doc_id", "text").collect()}
        kept = materialize(stage(spark, kept, SF), f"test-{name}")
        got = {r.doc_id for r in kept.select("doc_id").collect()}
        if name == "quality_classifier":
            found = quality_nbsvm.Indicators()
            want = {i for i, t in rows.items() if model.score(found(t)) >= queries.GOOD}
        elif name == "exact_dedup":
            want = {min(v) for v in _groups(rows.items()).values()}
        elif name == "simhash_near_dedup":
            ids = sorted(rows)
            want = {ids[k] for k in _linked([_fingerprint(rows[i]) for i in ids], 4)}
        elif name == "benchmark_decontamination":
            want = {r[0] for r in _contaminated(rows.items(), bench) if not r[-1]}
        else:
            want = set(rows)
        assert got == want, name
        assert name == "bpe_encoding" or kept.columns == docs.columns
