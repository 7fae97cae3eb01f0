"""Every stage of the pipeline on what the one before kept."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


def test_stages(spark, tmp_path):
    import random

    import corpus_pipeline
    rng = random.Random(1)
    en = ["the", "and", "of", "water", "stone", "river", "light", "house", "green", "over"]
    fr = ["le", "une", "forêt", "été", "eau", "maison", "vert", "pour", "avec", "où"]

    def text(pool, n):
        return " ".join(rng.choice(pool) + rng.choice(["", "s", "al", "ing" if pool is en else "eux"]) for _ in range(n))

    rows = [(k, text(en if k % 2 else fr, 60), "en" if k % 2 else "fr", "s", 0) for k in range(200)]
    copy, near = rows[11], rows[12]
    words = near[1].split()
    item = " ".join(f"item{k}" for k in range(15))
    rows += [(300, copy[1], "en", "s", 0), (301, " ".join(words[:-1] + ["other"]), "fr", "s", 0),
             (302, text(en, 20) + " " + item + " " + text(en, 20), "en", "s", 0), (303, "12 34 !!", None, "s", 0), (304, None, "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), name)
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    every = {r[0] for r in rows}
    assert kept[0] == every - {303, 304}
    assert kept[1] == kept[0] - {11}
    assert kept[2] == kept[1] - {301}
    assert kept[3] == kept[2] - {302}
    assert kept[4] == kept[3]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(kept[4])
