"""Token ids in wavelet matrices, one file for each shard of documents.

A shard holds whole documents in ascending id order. Its file has the documents' ids and ends, and for each bit of the
token ids, from the highest, one plane of bits with a directory of ranks. From the file alone a token can be read, the
occurrences of an id counted up to any place, and the k-th occurrence found, each in one step per bit.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import words as w
from tidemark.llm.encoding import word_tokenizer
from tidemark.llm.files import as_uri, new_file
from tidemark.llm.shared import folder, partitions, ship, written

SHARD_TOKENS = 1 << 21
MAGIC = b"TMWM0001"
HEADER = struct.Struct("<8sqqqqq")  # magic, partition, start within it, documents, tokens, bits
SPAN = 512  # bits of a plane for each entry of its directory


class WaveletMatrix:
    def __init__(self, size: int, planes: list[np.ndarray], zeros: np.ndarray, ranks: list[np.ndarray]):
        self.size, self.planes, self.zeros, self.ranks = size, planes, zeros, ranks

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        bits = max(1, int(ids.max(initial=0)).bit_length())
        left = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        words = -(-len(ids) // SPAN) * (SPAN // 64)
        planes, zeros, ranks = [], [], []
        for level in range(bits - 1, -1, -1):
            ones = (left >> level).astype(np.uint8) & 1
            plane = np.zeros(words * 8, np.uint8)
            packed = np.packbits(ones, bitorder="little")
            plane[: len(packed)] = packed
            planes.append(plane.view(np.uint64))
            counts = np.bitwise_count(planes[-1]).reshape(-1, SPAN // 64).sum(axis=1, dtype=np.uint32)
            ranks.append(np.concatenate([[0], np.cumsum(counts)]).astype(np.uint32))
            one = ones.view(bool)
            low, high = left[~one], left[one]
            zeros.append(len(low))
            left = np.concatenate([low, high])
        return cls(len(ids), planes, np.array(zeros, np.int64), ranks)

    def _rank1(self, level: int, place: np.ndarray) -> np.ndarray:
        """Ones of a plane before each place."""
        plane, span = self.planes[level], place >> 9
        out = self.ranks[level][span].astype(np.int64)
        word = place >> 6
        for k in range(SPAN // 64):
            at = span * (SPAN // 64) + k
            inside = at < word
            out += np.where(inside, np.bitwise_count(plane[np.where(inside, at, 0)]), 0) if len(plane) else 0
        part = place & 63
        rest = plane[np.minimum(word, len(plane) - 1)] & ((np.uint64(1) << part.astype(np.uint64)) - np.uint64(1))
        return out + np.where(part > 0, np.bitwise_count(rest), 0)

    def access(self, places: np.ndarray) -> np.ndarray:
        """The ids at the given places."""
        place, out = np.asarray(places, np.int64), np.zeros(len(places), np.uint32)
        for level, plane in enumerate(self.planes):
            bit = (plane[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1)
            ones = self._rank1(level, place)
            place = np.where(bit == 1, self.zeros[level] + ones, place - ones)
            out = (out << 1) | bit.astype(np.uint32)
        return out

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where the occurrences of a token before ``end`` lie below the last plane."""
        start, stop = 0, end
        if token >> len(self.planes):
            return 0, 0
        for level in range(len(self.planes)):
            ones = self._rank1(level, np.array([start, stop]))
            if (token >> (len(self.planes) - 1 - level)) & 1:
                start, stop = (int(self.zeros[level] + x) for x in ones)
            else:
                start, stop = int(start - ones[0]), int(stop - ones[1])
        return start, stop

    def count(self, token: int, end: int | None = None) -> int:
        """Occurrences of a token before place ``end`` (default: in the whole shard)."""
        if not self.size:
            return 0
        start, stop = self._range(token, self.size if end is None else end)
        return stop - start

    def select(self, token: int, k: int) -> int:
        """The place of occurrence ``k`` (from 0) of a token; -1 if there are not so many."""
        if not 0 <= k < self.count(token):
            return -1
        place = self._range(token, self.size)[0] + k
        for level in range(len(self.planes) - 1, -1, -1):
            one = (token >> (len(self.planes) - 1 - level)) & 1
            rank = place - int(self.zeros[level]) if one else place
            low, high = 0, self.size  # the last place with at most ``rank`` such bits before it
            while high - low > 1:
                middle = (low + high) // 2
                ones = int(self._rank1(level, np.array([middle]))[0])
                low, high = (middle, high) if (ones if one else middle - ones) <= rank else (low, middle)
            place = low
        return place

    def tokens(self) -> np.ndarray:
        """All ids in order: the stable partitions undone, from the lowest bit to the highest."""
        out = np.zeros(self.size, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level in range(len(self.planes) - 1, -1, -1):
            zeros = int(self.zeros[level])
            out[zeros:] |= out.dtype.type(1 << (len(self.planes) - 1 - level))
            one = np.unpackbits(self.planes[level].view(np.uint8), count=self.size, bitorder="little").view(bool)
            back = np.empty_like(out)
            back[~one], back[one] = out[:zeros], out[zeros:]
            out = back
        return out.astype(np.uint32)


def shard_bytes(part: int, start: int, doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    matrix = WaveletMatrix.build(ids)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    parts = [HEADER.pack(MAGIC, part, start, len(doc_ids), len(ids), len(matrix.planes))]
    parts += [known.tobytes(), np.array([d or 0 for d in doc_ids], np.int64).tobytes()]
    parts += [np.cumsum(lengths, dtype=np.int64).tobytes(), matrix.zeros.tobytes()]
    for plane, ranks in zip(matrix.planes, matrix.ranks, strict=True):
        parts += [plane.tobytes(), ranks.tobytes()]
    return b"".join(parts)


class Shard:
    """A shard file: partition, start of its first token within the partition, documents and tokens."""

    def __init__(self, content: bytes):
        magic, self.part, self.start, docs, size, bits = HEADER.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        at = HEADER.size

        def take(kind: type, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(content, kind, n, at)
            at += out.nbytes
            return out

        known = take(np.uint8, docs)
        self.doc_ids = [int(d) if k else None for k, d in zip(known, take(np.int64, docs), strict=True)]
        self.ends = take(np.int64, docs)
        zeros, spans = take(np.int64, bits), -(-size // SPAN)
        planes, ranks = [], []
        for _ in range(bits):
            planes.append(take(np.uint64, spans * (SPAN // 64)))
            ranks.append(take(np.uint32, spans + 1))
        self.matrix = WaveletMatrix(size, planes, zeros, ranks)


def write_shards(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Encode every text, append ``end_id`` and write shards in ascending id order (null ids first) below ``path``.

    Null texts are empty: their one token is the end. Rows repeated with one id are written one after the other, in the
    order of their texts. An empty table writes no shard. Tasks that run again replace their files by the same.
    """
    ship(docs.sparkSession)
    root = as_uri(path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = word_tokenizer(tokenizer), pyspark.TaskContext.get().partitionId()
        doc_ids, lengths, ids, size, start, shard = [], [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            nonlocal doc_ids, lengths, ids, size, start, shard
            name = f"part-{part:06d}-{shard:06d}.wavelet"
            with new_file(f"{root}/{name}") as file:
                file.write(shard_bytes(part, start, doc_ids, lengths, np.concatenate(ids)))
            row = pa.RecordBatch.from_pylist([{"part": part, "file": name, "n_docs": len(doc_ids), "n_tokens": size}])
            doc_ids, lengths, ids, size, start, shard = [], [], [], 0, start + size, shard + 1
            return row

        for batch in w.slices(batches, "text"):
            found, counts = encoder.encode(batch["text"])
            # an end after each document
            found = np.insert(found, np.cumsum(counts), np.uint32(end_id))
            first = 0
            for doc_id, n in zip(batch["doc_id"].to_pylist(), counts + 1, strict=True):
                doc_ids.append(doc_id)
                lengths.append(n)
                ids.append(found[first : first + n])
                first, size = first + n, size + n
                if size >= shard_tokens:
                    yield close()
        if doc_ids:
            yield close()

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = docs.repartitionByRange(partitions(docs.sparkSession), F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    manifest = ordered.mapInArrow(encode, "part long, file string, n_docs long, n_tokens long")
    manifest.write.parquet(f"{path}/_manifest")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """From the shard files alone: part, doc_id, start (within the part), n_tokens and ids (little-endian, 4 bytes)."""
    ship(spark)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                shard = Shard(content.as_py())
                ids, begins = shard.matrix.tokens().tobytes(), np.concatenate([[0], shard.ends[:-1]])
                columns = {
                    "part": pa.array([shard.part] * len(begins), pa.int64()),
                    "doc_id": pa.array(shard.doc_ids, pa.int64()),
                    "start": pa.array(begins + shard.start, pa.int64()),
                    "n_tokens": pa.array(shard.ends - begins, pa.int64()),
                    "ids": pa.array([ids[4 * a : 4 * b] for a, b in zip(begins, shard.ends, strict=True)], pa.binary()),
                }
                yield pa.RecordBatch.from_pydict(columns)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wavelet").load(path).select("content")
    return files.mapInArrow(decode, "part long, doc_id long, start long, n_tokens long, ids binary")


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """Tokens before each part: one row for each task that wrote, so few enough for one window and a broadcast."""
    sizes = spark.read.schema("part long, n_tokens long").parquet(f"{path}/_manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def token_ids(
    docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write the shards to the shared folder and read them back: doc_id, start, n_tokens, ids."""
    spark = docs.sparkSession
    path = folder(spark, "token-ids")
    write_shards(docs, path, tokenizer, end_id, id_col, text_col)
    if spark.read.parquet(f"{path}/_manifest").isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids binary")
    found = read_documents(spark, path).join(F.broadcast(part_starts(spark, path)), "part")
    return found.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids")
