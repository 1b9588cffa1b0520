"""Token ids as bit-plane shuffled, compressed blocks with an index.

Format. A data set has two tables. ``blocks`` holds the ids of a shard in blocks of a fixed number of
ids, the last one shorter, without regard to where documents begin. A block is a payload of bytes:

    4 bytes   the format name ``IDP1``
    1 byte    plane kind: 1 for bit planes, 8 for byte planes
    1 byte    bits of an id, a multiple of 8
    2 bytes   number of planes, little-endian
    4 bytes   number of ids, little-endian
    4 bytes   length of each plane once compressed, little-endian
    the planes, each a zstandard frame, lowest bit or byte first

A bit plane has the same bit of every id, eight ids a byte with the first id lowest; a byte plane the
same byte of every id. High planes of small ids are runs of zeros. ``index`` has a row for each block:
shard, block, first id of the block in the shard and in the whole, ids, bytes; and ``starts`` a row
for each document: shard, and where its ids begin and how many they are.

Shards are ranges of document ids, so ascending shard and block give the ids in document order. Every
table is written by Spark's committer: a lost executor leaves no half block behind.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobledger.llm.tables import keyed, written

MAGIC = b"IDP1"
_HEAD = struct.Struct("<4sBBHI")
_CACHED = 150_000  # pieces that a worker keeps, and as many older ones
_TOGETHER = 1 << 21  # characters of texts that are cut at a time


def encode_block(ids: np.ndarray, bits: int = 16, planes: int = 1, level: int = 3) -> bytes:
    """One payload; ``planes`` is 1 for bit planes and 8 for byte planes."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : bits // 8]
    if planes == 8:
        parts = np.ascontiguousarray(raw.T)
    else:
        spread = np.unpackbits(np.ascontiguousarray(raw), axis=1, bitorder="little")
        parts = np.packbits(np.ascontiguousarray(spread.T), axis=1, bitorder="little")
    packer = zstandard.ZstdCompressor(level=level)
    frames = [packer.compress(part.tobytes()) for part in parts]
    lengths = np.array([len(frame) for frame in frames], dtype="<u4").tobytes()
    return _HEAD.pack(MAGIC, planes, bits, len(frames), len(ids)) + lengths + b"".join(frames)


def decode_block(payload: bytes) -> np.ndarray:
    magic, planes, bits, count, ids = _HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a block of this format")
    lengths = np.frombuffer(payload, dtype="<u4", count=count, offset=_HEAD.size)
    at = _HEAD.size + 4 * count
    unpacker = zstandard.ZstdDecompressor()
    parts = []
    for length in lengths:
        parts.append(unpacker.decompress(payload[at : at + int(length)], max_output_size=max(ids, 1)))
        at += int(length)
    found = np.zeros(ids, dtype="<u4")
    for i, part in enumerate(parts):  # each plane is bits of one place in the ids
        plane = np.frombuffer(part, dtype=np.uint8)
        if planes == 1:
            plane = np.unpackbits(plane, count=ids, bitorder="little")
        found |= plane.astype("<u4") << np.uint32(planes * i)
    return found


# The words of texts in plain Latin letters, cut as the tokenizer's own rules cut them: NFC leaves these
# characters alone, lower case is one to one, and each is one byte of Latin-1.
_PLAIN = re.compile("[\t\n\r -~¡¿«»À-ÖØ-öø-ÿ]*")
_BLANK, _LETTER, _DIGIT, _SIGN = range(4)
_KINDS = np.full(256, _SIGN, dtype=np.uint8)
_KINDS[list(b"\t\n\r ")] = _BLANK
_KINDS[[*range(ord("a"), ord("z") + 1), *range(0xDF, 0xF7), *range(0xF8, 0x100)]] = _LETTER
_KINDS[list(b"0123456789")] = _DIGIT
# The steps before, and the pattern, of tokenizers that are cut in this way. Runs of blanks
# become one, which changes no piece.
_STEPS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _cut(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces begin and end in lower-case plain Latin bytes that end in two blanks.

    Runs of letters, of signs and single digits; ``'s 't 'm 'd 're 've 'll`` where a run of signs would begin.
    """
    kinds = _KINDS[raw]
    begins = np.ones(len(raw), dtype=bool)
    np.not_equal(kinds[1:], kinds[:-1], out=begins[1:])
    begins |= kinds == _DIGIT
    quotes = np.flatnonzero(begins & (raw == ord("'")))
    one, two = raw[quotes + 1], raw[quotes + 2]
    short = quotes[np.isin(one, list(b"stmd"))]
    ll, re_ve = (one == ord("l")) & (two == ord("l")), np.isin(one, list(b"rv")) & (two == ord("e"))
    long = quotes[ll | re_ve]
    begins[short + 1], begins[long + 1] = False, False
    begins[short + 2], begins[long + 3] = True, True
    at = np.flatnonzero(begins)
    held = kinds[at] != _BLANK
    return at[held], at[1:][held[:-1]]


def _bytes_array(lengths: np.ndarray, data: bytes | np.ndarray) -> pa.LargeBinaryArray:
    offsets = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=offsets[1:])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), buffers)


class Tokens:
    """Ids of texts, each as the tokenizers library gives them for the whole text.

    A tokenizer that puts texts in lower case, cuts them by a pattern and merges within the pieces
    needs each distinct piece once. Texts in plain Latin letters are cut here, many at a time, pieces are
    looked up, and the library's model merges new ones. Workers live on after a task and so do the pieces
    they know: those of two generations are kept, and pieces that are still met move from the older to the
    newer. Other texts, such with special tokens, and all texts of other tokenizers are encoded whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Pieces in Latin-1, and beside them the ids of known and older ones.
        self.known = self.older = self.found = _bytes_array(np.zeros(0, dtype=np.int64), b"")
        spec = json.loads(self.tokenizer.to_str())
        steps = (spec["normalizer"] or {}).get("normalizers", ())
        cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", ())
        self.cut = (
            steps == _STEPS
            and [cut["type"] for cut in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["pattern"] == {"Regex": _PATTERN}
            and (cuts[0]["behavior"], cuts[0]["invert"]) == ("Removed", True)
            and not (cuts[1]["add_prefix_space"] or cuts[1]["use_regex"])
            and spec["model"]["type"] == "BPE"
            and not spec["model"]["dropout"]
        )
        self.special = [token["content"] for token in spec["added_tokens"]]
        # The model reads bytes as the characters that the last step makes of them.
        self.as_bytes = {}
        if self.cut:
            for char in "¡¿«»ß" + "".join(map(chr, [*range(0xE0, 0xF7), *range(0xF8, 0x100)])):
                mapped = self.tokenizer.pre_tokenizer.pre_tokenize_str(char)
                self.as_bytes[ord(char)] = "".join(piece for piece, _ in mapped)

    def ids(self, text: str) -> np.ndarray:
        return self.many([text])[0]

    def many(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        plain = [self._is_plain(text) for text in texts]
        cut = iter(self._cut_ids([text.lower() for text, is_plain in zip(texts, plain) if is_plain]))
        return [next(cut) if is_plain else self._whole(text) for text, is_plain in zip(texts, plain)]

    def _is_plain(self, text: str) -> bool:
        return bool(self.cut and _PLAIN.fullmatch(text)) and not any(token in text for token in self.special)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _cut_ids(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        raw = np.frombuffer("".join([text + "  " for text in texts]).encode("latin-1"), dtype=np.uint8)
        begins, ends = _cut(raw)
        found = self._look_up(_bytes_array(ends - begins, raw[_KINDS[raw] != _BLANK]))
        stops = np.searchsorted(begins, np.cumsum([len(text) + 2 for text in texts]))
        _, offsets, data = found.buffers()
        stops = np.frombuffer(offsets, dtype=np.int64)[stops] // 4
        return np.split(np.frombuffer(data or b"", dtype="<u4")[: stops[-1]], stops[:-1])

    def _look_up(self, pieces: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """The ids of each of ``pieces``, of which new ones are merged."""
        if len(self.known) > _CACHED:
            self.found = self.found[: len(self.known)]
            self.known, self.older = self.known[:0], self.known
        n_known, n_held = len(self.known), len(self.known) + len(self.older)
        coded = pa.concat_arrays([self.known, self.older, pieces]).dictionary_encode()
        distinct, places = coded.dictionary, coded.indices[n_held:]  # held ones stand first, in their order
        merged = [self._merged(piece.decode("latin-1")) for piece in distinct[n_held:].to_pylist()]
        lengths = np.array([*map(len, merged)], dtype=np.int64)
        found = pa.concat_arrays([self.found, _bytes_array(lengths, b"".join(merged))])
        met = np.zeros(len(distinct), dtype=bool)
        met[:n_known] = True
        met[places.to_numpy()] = True
        self.known, self.older = distinct.filter(met), distinct.filter(~met)
        self.found = pa.concat_arrays([found.filter(met), found.filter(~met)])
        return found.take(places)

    def _merged(self, piece: str) -> bytes:
        chars = piece if piece.isascii() else piece.translate(self.as_bytes)
        tokens = self.tokenizer.model.tokenize(chars)
        return struct.pack(f"<{len(tokens)}I", *[token.id for token in tokens])


@functools.lru_cache(maxsize=1)
def _tokens(path: str) -> Tokens:
    return Tokens(path)


def _ids_of(texts: pa.Array, tokens: Tokens) -> Iterator[np.ndarray]:
    """Ids of each text; one at a time leaves the batch, and short ones are put together."""
    waiting: list[str] = []
    size = 0
    for value in texts:
        waiting.append(text := value.as_py())
        size += len(text)
        if size >= _TOGETHER:
            yield from tokens.many(waiting)
            waiting, size = [], 0
    yield from tokens.many(waiting)


_BLOCKS = (
    "shard int, block bigint, first bigint, n_ids int, doc_ids array<bigint>, begins array<bigint>, "
    "lengths array<bigint>, payload binary"
)


def _shard(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int, block_ids: int, bits: int, planes: int, level: int
) -> Iterator[pa.RecordBatch]:
    """The blocks of one partition, each with the documents that lie in it or reach into it."""
    from pyspark import TaskContext

    shard = TaskContext.get().partitionId()
    tokens = _tokens(path)
    waiting: list[np.ndarray] = []
    docs: list[tuple[int | None, int, int]] = []
    held = first = block = at = 0
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), *[pa.list_(pa.int64())] * 3, pa.binary()]
    names = ["shard", "block", "first", "n_ids", "doc_ids", "begins", "lengths", "payload"]

    def row(ids: np.ndarray) -> pa.RecordBatch:
        inside = list(zip(*(doc for doc in docs if doc[1] < first + len(ids))))
        payload = encode_block(ids, bits, planes, level)
        values = [shard, block, first, len(ids), *map(list, inside), payload]
        columns = [pa.array([value], kind) for value, kind in zip(values, types)]
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        for doc_id, found in zip(batch.column("doc_id").to_pylist(), _ids_of(batch.column("text"), tokens)):
            ids = np.append(found, np.uint32(end_id)).astype(np.uint32)
            docs.append((doc_id, at, len(ids)))
            at += len(ids)
            waiting.append(ids)
            held += len(ids)
            if held >= block_ids:
                joined = np.concatenate(waiting)
                full = held // block_ids * block_ids
                for start in range(0, full, block_ids):
                    yield row(joined[start : start + block_ids])
                    first += block_ids
                    block += 1
                    docs = [doc for doc in docs if doc[1] + doc[2] > first]
                waiting, held = [joined[full:]], held - full
    if held:
        yield row(np.concatenate(waiting))


def write_ids(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int | None = None,
    block_ids: int = 65_536,
    bits: int = 16,
    planes: int = 1,
    level: int = 3,
) -> None:
    """Write the ids of every text, each ended by ``end_id``, as a data set in ``folder``.

    A null text is empty and has the end id alone. Documents stand in ascending order of id, missing
    ids first, rows of one id in the order of a hash of the text. An empty table gives a data set
    without blocks. Each shard is a range of documents and one task; ``shards`` defaults to the
    session's number of shuffle partitions, and the split is by (id, hash), so a missing or repeated
    id fills no shard by itself.
    """
    spark = docs.sparkSession
    rows = keyed(docs, doc_id, text)
    count = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(count, "doc_id", "_h").sortWithinPartitions("doc_id", "_h", "text")
    blocks = rows.select("doc_id", "text").mapInArrow(
        lambda batches: _shard(batches, tokenizer_path, end_id, block_ids, bits, planes, level), _BLOCKS
    )
    path = f"{folder}/blocks"
    blocks.write.option("compression", "none").parquet(path)
    blocks = spark.read.schema(_BLOCKS).parquet(path)

    sums = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row a shard
    bases = sums.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    index = blocks.select("shard", "block", "first", "n_ids", F.octet_length("payload").alias("n_bytes"))
    index = index.join(bases, "shard").withColumn("start", F.col("base") + F.col("first"))
    index.select("shard", "block", "first", "start", "n_ids", "n_bytes").write.parquet(f"{folder}/index")
    listed = blocks.select(
        "shard", "first", F.explode(F.arrays_zip("doc_ids", "begins", "lengths")).alias("d")
    )
    listed = listed.where("d.begins >= first").join(bases, "shard")
    listed.select(
        F.col("d.doc_ids").alias("doc_id"),
        "shard",
        F.col("d.begins").alias("begin"),
        (F.col("base") + F.col("d.begins")).alias("start"),
        F.col("d.lengths").alias("n_tokens"),
    ).write.parquet(f"{folder}/starts")


_PIECES = (
    "shard int, doc_id bigint, begin bigint, piece_at bigint, n_tokens bigint, crc bigint, ids binary"
)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents within a block with their checksum; of others, the ids of the piece in the block."""
    names = ["shard", "doc_id", "begin", "piece_at", "n_tokens", "crc", "ids"]
    types = [pa.int32(), *[pa.int64()] * 5, pa.binary()]
    for batch in batches:
        for i in range(batch.num_rows):
            block = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            data = decode_block(block["payload"]).tobytes()
            first, last = block["first"], block["first"] + len(data) // 4
            rows = []
            for doc_id, begin, length in zip(block["doc_ids"], block["begins"], block["lengths"]):
                a, b = max(begin, first), min(begin + length, last)
                ids = data[4 * (a - first) : 4 * (b - first)]
                known = (zlib.crc32(ids), None) if b - a == length else (None, ids)
                rows.append((block["shard"], doc_id, begin, a, b - a, *known))
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays(columns, names)


def _joined_crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["shard", "doc_id", "begin", "n_tokens"]
    for batch in batches:
        crc = []
        for pieces in batch.column("pieces"):
            sum_ = 0
            for piece in pieces.as_py():
                sum_ = zlib.crc32(piece["ids"], sum_)
            crc.append(sum_)
        columns = [batch.column(name) for name in names]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(crc, pa.int64())], [*names, "crc"])


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the decoded blocks.

    Blocks are decoded on their own. Only documents that cross the end of a block, about one a block,
    are put together by a shuffle.
    """
    blocks = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks")
    pieces = blocks.select("shard", "first", "doc_ids", "begins", "lengths", "payload")
    pieces = written(pieces.mapInArrow(_pieces, _PIECES), "id-pieces")
    whole = pieces.where("ids IS NULL").select("shard", "doc_id", "begin", "n_tokens", "crc")
    cut = pieces.where("ids IS NOT NULL").groupBy("shard", "doc_id", "begin")
    cut = cut.agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("piece_at", "ids"))).alias("pieces"),
    )
    cut = cut.mapInArrow(
        _joined_crc, "shard int, doc_id bigint, begin bigint, n_tokens bigint, crc bigint"
    )
    bases = spark.read.parquet(f"{folder}/index").where("block = 0").select(
        "shard", F.col("start").alias("base")
    )
    return whole.unionByName(cut).join(bases, "shard").select(
        "doc_id",
        (F.col("base") + F.col("begin")).alias("start"),
        "n_tokens",
        F.col("crc").alias("ids_crc32"),
    )
