"""The corpus pipeline's stages, one after another, against what each should keep."""

from __future__ import annotations

import corpus_pipeline
from medallion.llm import minmax, seeds, tokens, toxicity
from medallion.llm.store import stored
from medallion.session import ship_package
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    ship_package(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    kept = {}
    given = docs
    for name, stage in corpus_pipeline.STAGES:
        result = stored(stage(spark, given, SF), f"test-{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert result.columns == docs.columns
        kept[name] = (given, result)
        given = result

    before, after = kept["toxicity"]
    scores = toxicity.score(before, toxicity.train(docs, read("labels"))).where("predicted = 0")
    assert ids(after) == ids(scores)
    before, after = kept["near_duplicates"]
    assert ids(after) == ids(minmax.near_duplicates(before).where("kept"))
    before, after = kept["decontamination"]
    assert not ids(after) & ids(seeds.contaminated(before, read("benchmark")))
    assert ids(after) | ids(seeds.contaminated(before, read("benchmark"))) == ids(before)
    before, after = kept["source_mix"]
    assert ids(after) <= ids(before)
    before, after = kept["token_planes"]
    library = tokens.encoder(tokens.tokenizer_file()).library
    total = sum(len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in before.collect())
    assert after.agg(F.sum("n_tokens")).first()[0] == total
    assert after.count() == before.count()


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}
