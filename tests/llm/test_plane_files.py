"""Bit-plane files: exact round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import ODD

from jobledger.llm import plane_files

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("planes", [1, 8])
@pytest.mark.parametrize("bits", [8, 16, 24, 32])
def test_blocks_round_trip(planes, bits):
    for size in (0, 1, 7, 8, 9, 1000):
        ids = np.random.default_rng(size).integers(0, 1 << bits, size, dtype=np.uint64).astype(np.uint32)
        payload = plane_files.encode_block(ids, bits, planes)
        assert payload[:4] == b"IDP1"
        assert (plane_files.decode_block(payload) == ids).all()


def test_ids_too_large_and_foreign_bytes():
    with pytest.raises(ValueError):
        plane_files.encode_block(np.array([70_000], dtype=np.uint32), 16)
    with pytest.raises(ValueError):
        plane_files.decode_block(b"x" * 40)


def test_high_planes_of_small_ids_cost_nothing():
    small = np.random.default_rng(0).integers(0, 16, 65_536).astype(np.uint32)
    large = np.random.default_rng(0).integers(0, 1 << 16, 65_536).astype(np.uint32)
    assert len(plane_files.encode_block(small)) < 0.3 * len(plane_files.encode_block(large))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_those_of_the_whole_text(name, monkeypatch):
    monkeypatch.setattr(plane_files, "_CACHED", 5)
    tokens = plane_files.Tokens(public_tokenizers.path(name))
    texts = [
        "it's I'LL don't 'S ''s !'s a'b", "<|endoftext|> hi", "Straße ÀÉ×÷ ¼²ª a_b 12.5%", "é ΟΔΟΣ Σας",
        "x\x1cy\x85z\xa0w", "", "  \n\t ", "a" * 500, "日本 語 text", "İstanbul", "¡Qué? «ÿ»", "a\x00b\x7fc", "é",
    ]
    texts += [f"ab{chr(c)}cd 1{chr(c)}'s {chr(c) * 3}" for c in range(32, 0x180)]
    for text in texts:
        assert list(tokens.ids(text)) == tokens.tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_in_use_outlive_the_bound_and_others_go(monkeypatch):
    monkeypatch.setattr(plane_files, "_CACHED", 50)
    tokens, merged = plane_files.Tokens(PATH), []
    monkeypatch.setattr(tokens, "_merged", lambda piece: merged.append(piece) or plane_files.Tokens._merged(tokens, piece))
    whole = plane_files.Tokens(PATH)
    for i in range(300):
        text = f"often {'abcdefghij'[i % 10]}word{chr(97 + i // 26)}{chr(97 + i % 26)}"
        assert (tokens.ids(text) == whole.ids(text)).all()
        assert len(tokens.known) + len(tokens.older) <= 2 * 52
    assert merged.count("often") == 1


def test_texts_put_together_merge_each_piece_once(monkeypatch):
    monkeypatch.setattr(plane_files, "_CACHED", 50)
    tokens, merged = plane_files.Tokens(PATH), []
    monkeypatch.setattr(tokens, "_merged", lambda piece: merged.append(piece) or plane_files.Tokens._merged(tokens, piece))
    texts = [" ".join(f"{start}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)) for start in "abc" * 4]
    texts += ["日本", "", texts[0]]
    for text, ids in zip(texts, tokens.many(texts), strict=True):
        assert list(ids) == tokens.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(merged) == len(set(merged)) == 900


def test_cuts_are_those_of_the_library():
    random_ = random.Random(5)
    tokens = plane_files.Tokens(PATH)
    plain = [*"'aAbsStTmMdDvVeErRlL019 \n\t\r.,!<|-_ßéÉÿ¡«»¿", "'", "'", "'s", "'ll", "'re", "'ve", "'LL", "  "]
    texts = ["".join(random_.choices(plain, k=random_.randrange(40))) for _ in range(4000)]
    texts += ["".join(random_.choices([*plain, "日", "ª", "\xa0"], k=random_.randrange(20))) for _ in range(2000)]
    for text, ids in zip(texts, tokens.many(texts), strict=True):
        assert list(ids) == tokens.tokenizer.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("block_ids,shards", [(65_536, 3), (16, 2), (1, 1)])
def test_files_hold_every_document(spark, docs, tmp_path, prose, block_ids, shards):
    rows = [*ODD, (50, prose(300, 1)), (-3, "negative id")]
    folder = str(tmp_path / "ids")
    plane_files.write_ids(docs(rows), folder, PATH, 2, shards=shards, block_ids=block_ids)
    tokens = plane_files.Tokens(PATH)
    expected = []
    for i, text in rows:
        ids = np.append(tokens.ids(text or ""), 2).astype("<u4")
        expected.append((str(i), len(ids), zlib.crc32(ids.tobytes())))
    found = plane_files.read_documents(spark, folder).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in found) == sorted(expected)
    at = 0
    for row in sorted(found, key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens
    order = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    index = spark.read.parquet(f"{folder}/index").orderBy("start").collect()
    assert sum(r.n_ids for r in index) == at and all(r.n_ids <= block_ids for r in index)
    starts = spark.read.parquet(f"{folder}/starts").collect()
    assert sorted((str(r.doc_id), r.start, r.n_tokens) for r in starts) == sorted(
        (str(r.doc_id), r.start, r.n_tokens) for r in found
    )


def test_empty_table(spark, docs, tmp_path):
    folder = str(tmp_path / "ids")
    plane_files.write_ids(docs(ODD).limit(0), folder, PATH, 2)
    assert plane_files.read_documents(spark, folder).collect() == []
