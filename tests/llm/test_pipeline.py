from collections import Counter

import corpus_pipeline
from tests.llm.test_dedup import docs


def test_stages(spark, tmp_path):
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(40))
    rows = [(i, own(i)) for i in range(20)] + [(50, own(3)), (51, own(3)), (60, own(4).upper()), (70, "too short"), (71, None), (80, own(80) + " mail me@host.org now")]
    df = docs(spark, rows)
    kept = {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        df = stage(spark, df, None)
        df.write.parquet(str(tmp_path / str(n)))
        df = spark.read.parquet(str(tmp_path / str(n)))
        kept[name] = df
        if n < len(corpus_pipeline.STAGES) - 1:
            assert set(df.columns) == set(docs(spark, rows).columns)
    ids = {k: Counter(r.doc_id for r in v.collect()) for k, v in kept.items()}
    assert 70 not in ids["quality_rules"] and 71 not in ids["quality_rules"] and len(ids["quality_rules"]) == 24
    assert 51 in ids["exact_dedup"] and 3 not in ids["exact_dedup"] and 50 not in ids["exact_dedup"]
    assert 4 in ids["simhash_near_dedup"] and 60 not in ids["simhash_near_dedup"]
    assert next(r.text for r in kept["pii"].collect() if r.doc_id == 80).endswith("mail <email> now")
    assert set(ids["packing"]) == set(ids["pii"])
