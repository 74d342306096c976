"""The pipeline on a small table, each stage against what it must keep."""

import corpus_pipeline
from tests.llm.test_operators import prose


def test_stages(spark, tmp_path):
    clean = [prose(80, 9000 + k).replace("\n", " ") for k in range(60)]
    passage = " ".join(clean[0].split()[5:25])
    near = clean[1].replace(clean[1].split()[40], "changed", 1)
    texts = [*clean, clean[2], near, prose(40, 77) + " " + passage + " " + prose(40, 78), None, ""] + [prose(40, 400 + k) + " you idiot, you worthless moron" for k in range(20)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(i >= 65)) for i in range(len(texts))], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    at, kept = docs, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        at = stage(spark, at, str(tmp_path))
        if k < 4:
            assert at.columns == docs.columns
            at.write.parquet(f"{tmp_path}/stage{k}")
            at = spark.read.parquet(f"{tmp_path}/stage{k}")
        kept.append({r["doc_id"] for r in at.select("doc_id").collect()})
    assert kept[0] == set(range(65))
    assert 60 not in kept[1] and set(range(60)) <= kept[1]
    assert kept[2] >= set(range(60)) - {1} and len(kept[2] & {1, 61}) == 1
    assert kept[3] == kept[2] - {0, 62}
    assert kept[4] == kept[3]
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == kept[4]
