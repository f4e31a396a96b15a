"""The pipeline, stage by stage, against plain code; awkward rows and empty tables pass every stage."""

import os
import re
import tempfile
from collections import Counter

import corpus_pipeline
from tests.llm.test_similarity import exact_components
from tests.llm.test_text_models import base_spans

SF = "/root/testdata/sf0.001"


def written(spark, df):
    path = tempfile.mkdtemp(prefix="run-") + "/t"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def test_stages(spark, plain_docs):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "secrets", "mixing", "packing"]
    calm = written(spark, stages["toxicity"](spark, plain_docs, SF))
    gone = plain_docs.join(calm, "doc_id", "left_anti").collect()
    bad = set("loser idiot scum pathetic moron worthless trash disgusting clown stupid".split())
    assert all(len(bad & set(re.findall(r"[^\W\d_]+", r["text"].lower()))) > 0 for r in gone)
    single = written(spark, stages["near_duplicates"](spark, calm, SF))
    texts = [(r["doc_id"], r["text"]) for r in calm.collect()]
    assert Counter(r["doc_id"] for r in single.collect()) == Counter(d for d, _, least in exact_components(texts, 5) if d == least)
    clean = written(spark, stages["secrets"](spark, single, SF))
    before = {r["doc_id"]: r["text"] for r in single.collect()}
    for r in clean.collect():
        assert not base_spans(r["text"]) and r["n_chars"] == len(r["text"])
        if not base_spans(before[r["doc_id"]]) and not re.search(r"[0-9]", before[r["doc_id"]]):
            assert r["text"] == before[r["doc_id"]]
    mixed = written(spark, stages["mixing"](spark, clean, SF))
    assert mixed.columns == clean.columns == plain_docs.columns
    assert max(Counter(r["doc_id"] for r in mixed.collect()).values()) <= 2
    packed = stages["packing"](spark, mixed, SF).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(r["doc_id"] for r in mixed.collect())


def test_awkward_rows_pass_every_stage(spark, edge_docs, empty_docs):
    for docs in (edge_docs, empty_docs):
        rows = docs
        for name, stage in corpus_pipeline.STAGES:
            columns, rows = rows.columns, written(spark, stage(spark, rows, SF))
            assert rows.columns == columns or name == "packing"
        assert (rows.count() == 0) == (docs.count() == 0)


assert os.path.isdir(SF)
