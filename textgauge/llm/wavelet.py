"""Token ids in wavelet-matrix files: one compressed file per shard that answers queries where it lies.

A wavelet matrix keeps, from the highest bit of the ids down, one plane of bits per level; after each plane the
sequence is stably split into zeros and ones.  With counts of ones at fixed steps (rank) the file gives the id
at a position, how often an id occurs before a position, and where its n-th occurrence is (select), each in one
pass over the levels.  Planes are cut into blocks that are compressed one by one, so a query reads few of them.

File layout, little-endian: ``MAGIC``, number of ids n (u64), levels (u32), documents d (u32), then d document
ids (i64), d + 1 document starts in the file (u64), a byte per document that is 1 where the id is null, then per
level: the zeros (u64), ones before each block (u64 each), ends of the compressed blocks (u64 each), the blocks.
A block is zstandard data of at most ``BLOCK`` bits, eight to a byte, lowest first.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textgauge.llm.tables import narrow, stored, text_bytes
from textgauge.llm.tokens import encode, tokenizer_path
from textgauge.session import scratch_path

MAGIC = b"WAVELET1"
BLOCK = 1 << 17
END = 2


def encode_file(ids: np.ndarray, starts: np.ndarray, keys: list[int | None], level: int = 1) -> bytes:
    """The file of one shard: all ids in order, and where each document starts."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=level)
    n, bits = len(ids), max(1, int(ids.max()).bit_length()) if len(ids) else 1
    out = [MAGIC, struct.pack("<QII", n, bits, len(keys))]
    out.append(np.array([k or 0 for k in keys], "<i8").tobytes())
    out.append(np.append(starts, n).astype("<u8").tobytes())
    out.append(bytes(k is None for k in keys))
    rest = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    spare = np.empty_like(rest)
    for bit in range(bits - 1, -1, -1):
        plane = (rest & rest.dtype.type(1 << bit)) != 0
        packed = np.packbits(plane, bitorder="little")
        cut = [packed[i : i + BLOCK // 8] for i in range(0, len(packed), BLOCK // 8)]
        ones = np.array([np.bitwise_count(c).sum(dtype=np.int64) for c in cut], np.int64)
        zeros = n - int(ones.sum())
        blocks = [pack.compress(c) for c in cut]
        out.append(struct.pack("<Q", zeros))
        out.append((np.cumsum([0, *ones])[:-1]).astype("<u8").tobytes())
        out.append(np.cumsum([len(b) for b in blocks]).astype("<u8").tobytes())
        out += blocks
        # Zeros, then ones, each in order.
        np.compress(plane, rest, out=spare[zeros:])
        np.compress(np.logical_not(plane, out=plane), rest, out=spare[:zeros])
        rest, spare = spare, rest
    return b"".join(out)


class WaveletFile:
    """Queries on one file's bytes (or a memory map of them)."""

    def __init__(self, data: bytes):
        import zstandard

        self.data, self.unpack = data, zstandard.ZstdDecompressor()
        if bytes(data[:8]) != MAGIC:
            raise ValueError("not a wavelet file")
        self.n, self.bits, docs = struct.unpack_from("<QII", data, 8)
        at = 24

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, count, at)
            at += found.nbytes
            return found

        keys, self.starts = take("<i8", docs), take("<u8", docs + 1).astype(np.int64)
        self.keys = [None if null else int(k) for k, null in zip(keys, take("u1", docs), strict=True)]
        count, self.levels = -(-self.n // BLOCK), []
        for _ in range(self.bits):
            zeros = struct.unpack_from("<Q", data, at)[0]
            at += 8
            ones, ends = take("<u8", count).astype(np.int64), take("<u8", count).astype(np.int64)
            self.levels.append((zeros, ones, ends, at))
            at += int(ends[-1]) if count else 0
        self.opened: dict[tuple[int, int], np.ndarray] = {}

    def _block(self, level: int, block: int) -> np.ndarray:
        """Bits of one block; the few last opened stay."""
        if (level, block) not in self.opened:
            _, _, ends, at = self.levels[level]
            begin = int(ends[block - 1]) if block else 0
            raw = self.unpack.decompress(self.data[at + begin : at + int(ends[block])])
            bits = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[: self.n - block * BLOCK]
            if len(self.opened) >= 4 * self.bits:
                self.opened.clear()
            self.opened[level, block] = bits
        return self.opened[level, block]

    def _ones(self, level: int, position: int) -> int:
        """Ones before a position of a level."""
        if position == self.n:
            return self.n - self.levels[level][0]
        block, inside = divmod(position, BLOCK)
        return int(self.levels[level][1][block]) + int(np.count_nonzero(self._block(level, block)[:inside]))

    def access(self, position: int) -> int:
        """The id at a position."""
        if not 0 <= position < self.n:
            raise IndexError(position)
        value = 0
        for level in range(self.bits):
            bit = int(self._block(level, position // BLOCK)[position % BLOCK])
            ones = self._ones(level, position)
            position = self.levels[level][0] + ones if bit else position - ones
            value = value << 1 | bit
        return value

    def count(self, token: int, end: int | None = None) -> int:
        """How often an id occurs before a position (anywhere by default)."""
        low, high = self._range(token, self.n if end is None else end)
        return high - low

    def _range(self, token: int, end: int) -> tuple[int, int]:
        if token < 0 or token >> self.bits:
            return 0, 0
        low, high = 0, end
        for level in range(self.bits):
            a, b = self._ones(level, low), self._ones(level, high)
            bit = token >> self.bits - 1 - level & 1
            low, high = (self.levels[level][0] + a, self.levels[level][0] + b) if bit else (low - a, high - b)
        return low, high

    def locate(self, token: int, nth: int) -> int:
        """The position of the n-th occurrence of an id, from 0."""
        low, high = self._range(token, self.n)
        if not 0 <= nth < high - low:
            raise IndexError(nth)
        position = low + nth
        for level in range(self.bits - 1, -1, -1):
            bit = token >> self.bits - 1 - level & 1
            position = self._select(level, bit, position - (self.levels[level][0] if bit else 0))
        return position

    def _select(self, level: int, bit: int, nth: int) -> int:
        _, ones, _, _ = self.levels[level]
        before = ones if bit else np.arange(len(ones)) * BLOCK - ones
        block = int(np.searchsorted(before, nth, "right")) - 1
        return block * BLOCK + int(np.flatnonzero(self._block(level, block) == bit)[nth - int(before[block])])

    def ids(self) -> np.ndarray:
        """All ids, from the lowest plane up; one plane is open at a time."""
        value = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for level in range(self.bits - 1, -1, -1):
            blocks = [self._block(level, b) for b in range(-(-self.n // BLOCK))]
            plane = np.concatenate(blocks).astype(bool) if blocks else np.zeros(0, bool)
            self.opened.clear()
            zeros, above = self.levels[level][0], np.empty_like(value)
            above[~plane], above[plane] = value[:zeros], value[zeros:]
            value = above | plane.astype(value.dtype) << np.array(self.bits - 1 - level, value.dtype)
        return value


def _store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """A file system and path that tasks can write to; ``s3a`` is the same store as ``s3``."""
    return pyarrow.fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1) if "://" in uri or uri.startswith("/") else f"/{uri}")


def _write(folder: str, path: str, end: int, tokens_per_file: int):
    from pyspark import TaskContext

    def save(part: int, number: int, keys: list, ids: list[bytes]) -> dict:
        lengths = np.array([len(i) // 4 for i in ids], np.int64)
        data = encode_file(np.frombuffer(b"".join(ids), "<u4"), np.cumsum(lengths) - lengths, keys)
        name = f"part-{part:06d}-{number:05d}.wm"
        fs, place = _store(f"{folder}/{name}")
        # Attempts of a task write equal bytes under names of their own; the last rename wins.
        own = f"{place}.{TaskContext.get().taskAttemptId()}"
        with fs.open_output_stream(own) as out:
            out.write(data)
        fs.move(own, place)
        return {"part": part, "number": number, "file": name, "n_ids": int(lengths.sum()), "n_docs": len(keys), "n_bytes": len(data)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, keys, ids, saved = TaskContext.get().partitionId(), 0, 0, [], [], []
        folder_fs, folder_path = _store(folder)
        folder_fs.create_dir(folder_path, recursive=True)
        for batch in batches:
            texts = (t.as_py() for t in batch.column(1))
            for key, own in zip(batch.column(0).to_pylist(), encode(texts, path, end), strict=True):
                if keys and held + len(own) > 4 * tokens_per_file:
                    saved.append(save(part, number, keys, ids))
                    number, held, keys, ids = number + 1, 0, [], []
                keys.append(key)
                ids.append(own)
                held += len(own)
        if keys:
            saved.append(save(part, number, keys, ids))
        if saved:
            yield pa.RecordBatch.from_pylist(saved)

    return run


def write_tokens(
    docs: DataFrame,
    folder: str,
    end: int = END,
    tokenizer: str | None = None,
    tokens_per_file: int = 1 << 21,
    bytes_per_task: int = 24 << 20,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Encode all texts in ascending key order into wavelet files under ``folder``; returns their list.

    ``folder`` is one that tasks share, on any store pyarrow opens.  The list (``part, number, file, n_ids,
    n_docs, n_bytes, first``) has a row per file, ``first`` being the ids in all files before it; files left by
    failed attempts are not in it.  A file holds whole documents, at most ``tokens_per_file`` ids unless a
    single document is longer.  A null text is its end id alone, null keys come first, rows with equal keys are
    each kept, in any order among themselves.  An empty table writes no file.
    """
    rows = narrow(docs, {"doc_id": key, "_text": text})
    total = rows.agg(F.sum(text_bytes("_text") + 1)).first()[0] or 0
    wanted = max(1, -(-total // bytes_per_task), docs.sparkSession.sparkContext.defaultParallelism)
    ordered = rows.select(F.col("doc_id").cast("long"), F.col("_text").cast("binary"))
    ordered = ordered.repartitionByRange(int(wanted), "doc_id").sortWithinPartitions("doc_id")
    schema = "part long, number long, file string, n_ids long, n_docs long, n_bytes long"
    write = _write(folder, tokenizer or tokenizer_path(), end, tokens_per_file)
    listed = stored(ordered.mapInArrow(write, schema), "wavelet-files")
    # One row per file of millions of ids.
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return listed.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_tokens(files: DataFrame, folder: str, tasks: int | None = None) -> DataFrame:
    """Documents back from the listed files: ``doc_id, start, ids`` (little-endian unsigned 32-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, place = _store(f"{folder}/{name}")
                with fs.open_input_file(place) as source:
                    found = WaveletFile(source.read())
                ids, starts = found.ids().astype("<u4"), found.starts
                for at in range(0, len(found.keys), 256):
                    upto = min(at + 256, len(found.keys))
                    own = [ids[starts[i] : starts[i + 1]].tobytes() for i in range(at, upto)]
                    columns = [
                        pa.array(found.keys[at:upto], pa.int64()),
                        pa.array(first + starts[at:upto], pa.int64()),
                        pa.array(own, pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "ids"])

    tasks = tasks or 4 * files.sparkSession.sparkContext.defaultParallelism
    dealt = files.select("file", "first").repartition(tasks, "file")
    return dealt.mapInArrow(run, "doc_id long, start long, ids binary")


def token_digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write the files, read them back, and describe every document by what the files say."""
    folder = scratch_path(spark, "wavelet")
    back = read_tokens(write_tokens(docs, folder), folder)
    n = (F.octet_length("ids") / 4).cast("long")
    return back.select("doc_id", "start", n.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def checksum(ids: np.ndarray) -> int:
    """Checksum of ids as they stand in the result."""
    return zlib.crc32(ids.astype("<u4").tobytes())
