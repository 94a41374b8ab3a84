"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A data file is a row of frames, one for each document:

    8 bytes  length n of the payload, little-endian
    4 bytes  masked checksum of these 8 bytes
    n bytes  payload: 1 byte that is 0 for a null doc_id, 8 bytes doc_id, then the ids
    4 bytes  masked checksum of the payload
    1 byte   0x0A

Ids are unsigned little-endian integers of 2 bytes if the vocabulary fits, else 4. A checksum is CRC-32, rotated
right by 15 bits plus 0xA282EAD8, so that checksums stored in a payload don't look like its own. The last
byte is what Spark's text writer puts after each value: frames are written by Spark itself, with its commit
protocol, to any file system it knows, and lost or repeated tasks leave no half files. Files hold a bounded number of
blocks of frames, and their names sort by document order.

Documents are dealt by range of (doc_id, text hash), then encoded, so the ids are never shuffled."""

from __future__ import annotations

import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.session import materialize, shared_path

BLOCK_BYTES = 4 << 20
FILE_BLOCKS = 8
#: Bytes of the texts that are encoded together, unless one text has more.
TOGETHER = 4 << 20
#: Parts of text whose ids a worker keeps, and the most characters of each.
CACHE_PARTS, LONG_PART = 800_000, 64

_HEAD, _ID, _SUM = struct.Struct("<Q"), struct.Struct("<?q"), struct.Struct("<I")
#: Parts that the library gets as one text.
JOINED = 100
#: How a byte-level vocabulary writes the bytes of a space and a newline.
_OPENING = ("\u0120", "\u010a")
#: Up to this character the cuts are tested in every mixture with letters, numbers and spaces.
_AGREED = 0x530


def masked(data: bytes) -> int:
    value = zlib.crc32(data)
    return (((value >> 15) | (value << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes) -> bytes:
    payload = _ID.pack(doc_id is not None, doc_id or 0) + ids
    head = _HEAD.pack(len(payload))
    return b"".join((head, _SUM.pack(masked(head)), payload, _SUM.pack(masked(payload)), b"\n"))


def frames(data: bytes):
    """(offset, length, doc_id, ids) of each frame; a wrong checksum or a cut frame is an error."""
    at = 0
    while at < len(data):
        head = data[at : at + 8]
        (size,) = _HEAD.unpack(head)
        end = at + 12 + size
        payload = data[at + 12 : end]
        if masked(head) != _SUM.unpack_from(data, at + 8)[0] or masked(payload) != _SUM.unpack_from(data, end)[0] or data[end + 4 : end + 5] != b"\n":
            raise ValueError(f"damaged record at byte {at}")
        known, doc_id = _ID.unpack_from(payload)
        yield at, end + 5 - at, doc_id if known else None, payload[_ID.size :]
        at = end + 5


class Encoder:
    """A byte-level BPE of the tokenizers library, asked once for each distinct part of the texts.

    The library merges within pieces only, and no piece reaches over the place before a space or newline that a character
    other than white space follows (tested for all characters). Texts are cut there. Parts that are not known yet are
    encoded many at a time; every token that begins with the byte of a space or newline begins a part. Texts
    with other spaces or newlines are cut one by one, and those with an added token go through the library as they are."""

    _CUT = re.compile(r"(?=[ \n]\S)")
    #: A part without the space that it begins with, or from its newline on.
    _PART = re.compile(r"\n?\S")

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.added = [x.content for x in self.whole.get_added_tokens_decoder().values()]
        self.kind = np.dtype("<u2" if self.whole.get_vocab_size() <= 1 << 16 else "<u4")
        vocab = self.whole.get_vocab()
        self.opens = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.opens[[k for token, k in vocab.items() if token[:1] in _OPENING]] = True
        self.parts: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        (found,) = self.whole.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, self.kind)

    def _alone(self, part: str) -> bytes:
        return self._ids(part if part[0] == "\n" else " " + part).tobytes()

    def _learn(self, parts: list[str]) -> list[bytes]:
        """The ids of parts without other spaces and newlines than the one that they begin with."""
        out = []
        for k in range(0, len(parts), JOINED):
            some = parts[k : k + JOINED]
            text = (" " + " ".join(some)).replace(" \n", "\n")
            if any(x in text for x in self.added):
                out += map(self._alone, some)
                continue
            ids = self._ids(text)
            at = (np.flatnonzero(self.opens[ids]) * self.kind.itemsize).tolist()
            data = ids.tobytes()
            out += [data[i:j] for _, i, j in zip(some, at, [*at[1:], len(data)], strict=True)]
        return out

    def _known(self, parts: list[str]) -> list[bytes]:
        """The ids of distinct parts; those that can't be parts get none."""
        out = list(map(self.parts.get, parts))
        new = [k for k, x in enumerate(out) if x is None and self._PART.match(parts[k])]
        words = [parts[k] for k in new]
        found = self._learn(words)
        for k, ids in zip(new, found, strict=True):
            out[k] = ids
        if len(self.parts) + len(new) > CACHE_PARTS:
            self.parts = {x: ids for x, ids in zip(parts, out, strict=True) if ids is not None and len(x) <= LONG_PART}
        else:
            self.parts.update([x for x in zip(words, found, strict=True) if len(x[0]) <= LONG_PART])
        return out

    def _one(self, text: str) -> bytes:
        first, *rest = [text] if any(x in text for x in self.added) else self._CUT.split(text)
        rest = [x.removeprefix(" ") for x in rest]
        distinct = list({x for x in rest if " " not in x and "\n" not in x[1:]})
        found = dict(zip(distinct, self._known(distinct), strict=True))
        found |= {x: self._alone(x) for x in rest if x not in found}
        return self._ids(first).tobytes() + b"".join(map(found.__getitem__, rest))

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text (null: empty). All are cut and looked up together, so they should be of bounded size."""
        texts = texts.cast(pa.large_string()).fill_null("")
        odd = np.zeros(len(texts), bool)
        for x in self.added:
            odd |= pc.match_substring(texts, x).to_numpy(zero_copy_only=False)
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        coded = cut.flatten().dictionary_encode()
        parts, at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().copy()
        start = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        firsts = [parts[k] for k in at[start[:-1]].tolist()]
        at[start[:-1]] = len(parts) + np.arange(len(texts))
        found = self._known(parts) + [self._ids(x).tobytes() for x in firsts]
        ids = pa.array(found, pa.large_binary())
        if ids.null_count:
            odd |= np.logical_or.reduceat(ids.is_null().to_numpy(zero_copy_only=False)[at], start[:-1])
        _, ends, data = ids.take(pa.array(at)).buffers()
        ends, data = np.frombuffer(ends, np.int64)[start].tolist(), memoryview(data or b"")
        return [self._one(texts[k].as_py()) if odd[k] else bytes(data[i:j]) for k, (i, j) in enumerate(zip(ends[:-1], ends[1:], strict=True))]

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text]))[0]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker, which serves all its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _together(batches):
    """The doc_ids and texts of rows that are encoded together."""
    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
        ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
        begin = 0
        while begin < len(ids):
            end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + TOGETHER, "right")))
            yield ids[begin:end], texts[begin:end]
            begin = end


def _write(path: str, end_id: int):
    def run(batches):
        tokens = encoder(path)
        end = np.array([end_id], tokens.kind).tobytes()
        held, size = [], 0
        for ids, texts in _together(batches):
            for doc_id, found in zip(ids, tokens.encode_all(texts), strict=True):
                held.append(frame(doc_id, found + end))
                size += len(held[-1])
                if size >= BLOCK_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], ["frames"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], ["frames"])

    return run


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Write the data files of ``docs`` (doc_id, text) below ``path``, in ascending order of doc_id, null first.

    Null texts count as empty; every document ends with ``end_id``. Rows of one doc_id follow each other in the
    order of a hash of their text. Further columns are ignored; an empty table makes no record."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    blocks = rows.mapInArrow(_write(tokenizer, end_id), "frames binary")
    writer = blocks.select(F.col("frames").cast("string").alias("value")).write
    writer.option("lineSep", "\n").option("maxRecordsPerFile", FILE_BLOCKS).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    data = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    numbers = [F.regexp_extract("path", r"part-(\d+)-.*?(?:-c(\d+))?\.txt$", k).try_cast("int") for k in (1, 2)]
    return data.select(numbers[0].alias("part"), F.coalesce(numbers[1], F.lit(0)).alias("file"), "content")


def _index(width: int):
    def run(batches):
        for batch in batches:
            for part, file, content in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                rows, before = [], 0
                for offset, length, doc_id, ids in frames(content):
                    n = len(ids) // width
                    total = zlib.crc32(np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes())
                    rows.append((part, file, offset, length, doc_id, before, n, total))
                    before += n
                kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 6]
                names = ["part", "file", "offset", "length", "doc_id", "before", "n_tokens", "ids_crc32"]
                columns = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], names)

    return run


def build_index(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """Read all data files back, check every frame, and return the written index.

    One row for each record: part and file number, offset and length in bytes, doc_id, start (ids of all records before
    it), n_tokens with the end id, and ids_crc32 over the ids as little-endian 32-bit integers."""
    width = encoder(tokenizer).kind.itemsize
    schema = "part int, file int, offset bigint, length bigint, doc_id bigint, before bigint, n_tokens bigint, ids_crc32 bigint"
    rows = materialize(_files(spark, path).mapInArrow(_index(width), schema), "frames")
    # One row for each file.
    totals = rows.groupBy("part", "file").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", "file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    index = rows.join(totals, ["part", "file"]).withColumn("start", F.col("ahead") + F.col("before"))
    return materialize(index.select("doc_id", "start", "n_tokens", "ids_crc32", "part", "file", "offset", "length"), "index")


def read_shuffled(spark: SparkSession, path: str, index: DataFrame, tokenizer: str, seed: int = 0) -> DataFrame:
    """Records (doc_id, ids) named by rows of ``index``, in a seeded order.

    Only the index is grouped; a task takes a file and cuts out the frames it is asked for."""
    width = encoder(tokenizer).kind.itemsize
    wanted = index.groupBy("part", "file").agg(F.collect_list(F.struct("offset", "length")).alias("cuts"))
    files = _files(spark, path).join(wanted, ["part", "file"]).select("content", "cuts")

    def run(batches):
        for batch in batches:
            for content, cuts in zip(batch.column("content").to_pylist(), batch.column("cuts").to_pylist(), strict=True):
                found = [next(frames(content[x["offset"] : x["offset"] + x["length"]])) for x in cuts]
                ids = [np.frombuffer(x[3], f"<u{width}").astype(np.int64) for x in found]
                yield pa.RecordBatch.from_arrays([pa.array([x[2] for x in found], pa.int64()), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "ids"])

    return files.mapInArrow(run, "doc_id bigint, ids array<bigint>").orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id", F.xxhash64("ids"))


def token_records(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write all records to the shared folder, read them back, and return the index."""
    path = shared_path(docs.sparkSession, "records")
    write_records(docs, path, tokenizer, end_id)
    return build_index(docs.sparkSession, path, tokenizer)
