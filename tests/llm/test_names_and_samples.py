"""Columns named as an operator names its own, changed tokenizers, and what classifiers learn from."""

import json
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobledger.llm import dart_minhash, fair_mix, plane_files, queries, string_tiling, subwords

TAKEN = ["_mix_id", "_mix_h", "_mix_source", "_copies", "_copy", "_near_id", "_near_h", "_near_rows", "_tile_id", "_tile_h",
         "row", "id", "h", "from", "n_rows", "copies", "_h", "doc_id2", "a.b"]


@pytest.fixture
def clashing(spark, prose):
    rows = [(i, prose(60, i % 7), f"s{i % 3}", *[f"{name}{i}" for name in TAKEN]) for i in range(20)]
    rows += [(None, None, None, *[None] * len(TAKEN)), (3, "", "s0", *["x"] * len(TAKEN))]
    names = ", ".join(f"`{name}` string" for name in TAKEN)
    return spark.createDataFrame(rows, f"doc_id long, text string, source string, {names}").repartition(4)


def check(found, docs):
    """Rows of ``found`` are rows of ``docs``, column by column."""
    assert found.columns == docs.columns
    whole = {str(row) for row in docs.collect()}
    rows = [str(row) for row in found.collect()]
    assert rows and set(rows) <= whole
    return rows


def test_stages_keep_columns_of_any_name(spark, clashing, prose):
    assert len(check(dart_minhash.keep_one(clashing), clashing)) < 22
    benchmark = spark.createDataFrame([(1, prose(60, 2))], "item_id long, text string")
    kept = check(string_tiling.decontaminated(clashing, benchmark), clashing)
    assert len(kept) == 22 - sum(i % 7 == 2 for i in range(20))
    check(fair_mix.mixed(clashing), clashing)


@pytest.mark.parametrize("change", [
    lambda steps: steps[1].update(pattern={"Regex": "e"}, content="a"),
    lambda steps: steps[1].update(content="x"),
    lambda steps: steps[1].update(pattern={"String": "the"}),
    lambda steps: steps.reverse(),
    lambda steps: steps.append({"type": "Replace", "pattern": {"String": "t"}, "content": "d"}),
])
def test_a_changed_tokenizer_is_used_as_it_is(tmp_path, change):
    import public_tokenizers
    from tokenizers import Tokenizer

    spec = json.load(open(public_tokenizers.path("word_bpe_49k.json")))
    change(spec["normalizer"]["normalizers"])
    path = str(tmp_path / "changed.json")
    with open(path, "w") as out:
        json.dump(spec, out)
    tokens, library = plane_files.Tokens(path), Tokenizer.from_file(path)
    for text in ["the letter here", "Some  more\n text, the end", "étés 12 x"]:
        assert tokens.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_the_sample_takes_long_texts_in_their_turn(spark):
    docs = spark.createDataFrame([(i, "w " * (30_000 if i % 4 == 0 else 10)) for i in range(40)] + [(50, None), (None, "x")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (3, None), (5, 7)], "doc_id long, quality int")
    texts, found = subwords.labelled(docs, labels, "quality", subwords.Settings())
    assert len(texts) == 40 and sum(len(text) > 20_000 for text in texts) == 10
    some = subwords.Settings(sample=30, sample_bytes=200_000)
    texts, _ = subwords.labelled(docs, labels, "quality", some)
    assert 0 < sum(len(text) > 20_000 for text in texts) <= 3 and sum(map(len, texts)) <= 200_000
    assert (texts, _) == subwords.labelled(docs.repartition(7), labels.repartition(5), "quality", some)
    assert subwords.labelled(docs, labels.limit(0), "quality", some) == ([], [])


def plain_training(bags, labels, s):
    """The same steps with Python's numbers, one at a time."""
    random = np.random.default_rng(s.seed)
    vectors = (random.uniform(-1, 1, (s.buckets, s.width)).astype(np.float32) / s.width).astype(float).tolist()
    output = [[0.0, 0.0] for _ in range(s.width)]
    bias = [math.log((labels.count(k) + 1) / (len(labels) + 2)) for k in (0, 1)]
    step = 0
    while step < s.steps:
        for i in random.permutation(len(labels))[: s.steps - step]:
            rate = s.rate * (1 - step / s.steps)
            step += 1
            rows, shares = bags[i]
            mean = [sum(float(w) * vectors[r][d] for r, w in zip(rows, shares)) for d in range(s.width)]
            logits = [sum(mean[d] * output[d][k] for d in range(s.width)) + bias[k] for k in (0, 1)]
            top = max(logits)
            e = [math.exp(x - top) for x in logits]
            error = [x / sum(e) - (k == labels[i]) for k, x in enumerate(e)]
            back = [sum(output[d][k] * error[k] for k in (0, 1)) for d in range(s.width)]
            for d in range(s.width):
                for k in (0, 1):
                    output[d][k] -= 0.01 * rate * mean[d] * error[k]
            bias = [b - 0.001 * rate * x for b, x in zip(bias, error)]
            for r, w in zip(rows, shares):
                for d in range(s.width):
                    vectors[r][d] -= rate * float(w) * back[d]
    return lambda bag: 1 / (1 + math.exp(-sum(
        float(w) * sum(vectors[r][d] * (output[d][1] - output[d][0]) for d in range(s.width)) for r, w in zip(*bag)
    ) - (bias[1] - bias[0])))


def test_the_trainer_against_a_plain_loop(prose):
    settings = subwords.Settings(buckets=1 << 10, width=3, steps=150, rate=5.0)
    texts = [(prose(12, i) + (" awful junk" if i % 3 == 0 else "")).encode() for i in range(20)]
    labels = [int(i % 3 == 0) for i in range(20)]
    model = subwords.train(texts, labels, settings)
    learned = list(subwords.bags(texts, settings))
    plain = plain_training(learned, labels, settings)
    assert subwords.scores(texts, model) == pytest.approx([plain(bag) for bag in learned], abs=1e-3)


@pytest.mark.parametrize("name, label, fold, threshold", [
    ("op7_subword_quality", "quality", (5, 0), 0.3), ("op8_subword_toxicity", "toxic", (3, 1), 0.7),
])
def test_queries_hold_out_their_fold(spark, tmp_path, prose, name, label, fold, threshold):
    """Labels of the fold that is held out are turned round: no score may move."""
    docs = [(i, prose(20, i) + (" vile words" if i % 2 else " kind words")) for i in range(60)] + [(None, "x"), (99, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    scores = []
    out = {i for i in range(100) if zlib.crc32(str(i).encode()) % fold[0] == fold[1]}
    for turned in (False, True):
        folder = tmp_path / f"t{turned}"
        folder.mkdir()
        (folder / "documents.parquet").symlink_to(tmp_path / "documents.parquet")
        labels = [(i, 1 - i % 2 if turned and i in out else i % 2) for i in range(60)]
        spark.createDataFrame(labels, f"doc_id long, {label} int").write.parquet(f"{folder}/labels.parquet")
        rows = queries.QUERIES[name](spark, str(folder)).collect()
        scores.append({(row.doc_id, row.score, row.held_out, row.predicted) for row in rows})
        assert len(rows) == 62
        for row in rows:
            assert row.held_out == (row.doc_id in out) and 0 <= row.score <= 1
            assert row.predicted == int(row.score >= threshold)
    assert scores[0] == scores[1]
    known = [row for row in scores[0] if row[0] is not None and row[0] < 60 and not row[2]]
    assert np.mean([row[3] == row[0] % 2 for row in known]) > 0.9
