"""The pipeline on a small folder, stage by stage."""

import zlib

import numpy as np
import public_tokenizers
from conftest import ODD

import corpus_pipeline
from jobledger.llm import plane_files


def test_stages(spark, docs, prose, tmp_path):
    item = prose(40, 7777)
    rows = [(100 + i, prose(30, i) + (" scum idiot" if i % 4 == 0 else "")) for i in range(200)]
    rows += [(400, item), (401, prose(20, 900) + " " + item), (500, prose(80, 901)), (501, prose(80, 901))]
    rows += [r for r in ODD if r[1] is not None]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(100 + i, 1, int(i % 4 == 0)) for i in range(0, 200, 2)] + [(101 + i, 1, 0) for i in range(0, 200, 2)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    benchmark = spark.createDataFrame([(0, item)], "item_id long, text string")
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))

    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, kept = now.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(str(tmp_path / f"stage-{k}"))
        now = spark.read.parquet(str(tmp_path / f"stage-{k}"))
        kept[name] = [r.doc_id for r in now.collect()]
        if name != "token_ids":
            assert now.columns == columns
    toxic = {100 + i for i in range(0, 200, 4)}
    assert len(toxic & set(kept["toxicity"])) <= 5
    assert len({i for i, _ in rows} - toxic - set(kept["toxicity"])) <= 5
    near = kept["near_duplicates"]
    assert 500 in near and 501 not in near and len(near) == len(set(near) - {None, 6}) + near.count(None) + near.count(6)
    assert {400, 401} & set(kept["decontamination"]) == set()
    assert set(kept["decontamination"]) == set(near) - {400, 401}
    assert set(kept["mixing"]) <= set(kept["decontamination"])
    texts = spark.read.parquet(str(tmp_path / "stage-3")).collect()
    tokens = plane_files.Tokens(public_tokenizers.path("word_bpe_49k.json"))
    sums = sorted(zlib.crc32(np.append(tokens.ids(r.text or ""), 2).astype("<u4").tobytes()) for r in texts)
    assert sorted(r.ids_crc32 for r in now.collect()) == sums


def test_empty_documents(spark, docs, tmp_path):
    docs(ODD).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
