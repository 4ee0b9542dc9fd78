"""Training-order materialisation: a keyed permutation gives every sequence its slot, shards have a fixed stride."""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import stored
from marketloom.session import new_work_folder

RANKS_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The vocabulary's own split of a text (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END, PAD = 50256, 65535


@dataclass(frozen=True)
class Layout:
    """`length` ids of 16 bits per record, `records` per shard, key and rounds of the permutation.

    A partition writes a run of shards: there are `partitions` of them at most, however many shards. Records move packed, those of
    `packed` bytes together.
    """

    length: int = 1024
    records: int = 8192
    key: int = 20240607
    rounds: int = 6
    partitions: int = 10_000
    packed: int = 1 << 24

    @property
    def stride(self) -> int:
        return 2 * self.length


def feistel(index: np.ndarray, size: int, key: int, rounds: int = 6) -> np.ndarray:
    """Keyed permutation of 0 .. size - 1.

    A balanced Feistel network permutes the numbers of the least even count of bits; what falls beyond
    `size` is sent through it again until it lies inside (cycle-walking), which keeps it a permutation.
    """
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64(zlib.crc32(f"{key}:{r}".encode()) << 32 | zlib.crc32(f"{r}:{key}".encode())) for r in range(rounds)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            z = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            z = (z ^ (z >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((z ^ (z >> np.uint64(32))) & mask)
        return left << np.uint64(half) | right

    out = once(index.astype(np.uint64))
    while (beyond := out >= np.uint64(size)).any():
        out[beyond] = once(out[beyond])
    return out.astype(np.int64)


@lru_cache(maxsize=2)
def encoding(ranks: bytes):
    import tiktoken

    pairs = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding(
        "ranks", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={}
    )


def token_records(docs: DataFrame, ranks: bytes, layout: Layout = Layout()) -> DataFrame:
    """task, at and ids (a record of `stride` bytes): the texts of each task one after the other, END after each.

    Only the last record of a task is filled up with PAD. Null and empty texts are an END alone.
    """
    length = layout.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, own = TaskContext.get().partitionId(), encoding(ranks)
        rest, at = np.zeros(0, np.uint16), 0

        def packed(ids: np.ndarray) -> pa.RecordBatch:
            nonlocal at
            rows = len(ids) // length
            raw = pa.py_buffer(np.ascontiguousarray(ids).tobytes())
            ends = pa.py_buffer((np.arange(rows + 1, dtype=np.int32) * layout.stride).tobytes())
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([task] * rows, pa.int32()),
                    pa.array(np.arange(at, at + rows), pa.int64()),
                    pa.Array.from_buffers(pa.binary(), rows, [None, ends, raw]),
                ],
                names=["task", "at", "ids"],
            )
            at += rows
            return out

        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                parts = [rest]
                for text in batch.column(0).slice(start, 512).to_pylist():
                    parts += [own.encode_to_numpy(text or "").astype(np.uint16), np.array([END], np.uint16)]
                flat = np.concatenate(parts)
                full = len(flat) // length * length
                rest = flat[full:]
                if full:
                    yield packed(flat[:full])
        if len(rest):
            yield packed(np.concatenate([rest, np.full(length - len(rest), PAD, np.uint16)]))

    return docs.select("text").mapInArrow(run, "task int, at long, ids binary")


def in_training_order(records: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """slot, shard, record and ids: every record at its place, shards in order, their records in order.

    `records` (task, at, ids) is written once; a record's index is the number of records of earlier tasks plus
    its own place, so that the permutation runs over 0 .. n - 1 without gaps. The driver sees one count per
    task. A partition is the range of slots of a run of shards: its size is the same for all by construction. What a task sends to one
    partition is packed and compressed together before the shuffle and unpacked after it, then sorted by slot. An empty
    table gives no records.
    """
    whole = stored(records, "records", "zstd")
    counts = {r["task"]: r["count"] for r in whole.groupBy("task").count().collect()}
    total = sum(counts.values())
    base, before = {}, 0
    for task in sorted(counts):
        base[task] = before
        before += counts[task]
    key, rounds, stride = layout.key, layout.rounds, layout.stride
    shards = max(1, math.ceil(total / layout.records))
    run_length = math.ceil(shards / layout.partitions) * layout.records

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=3).compress
        slots, held, rows = [], [], 0

        def packed() -> pa.RecordBatch:
            at, ids = np.concatenate(slots), np.concatenate(held)
            part = at // run_length
            order = np.lexsort((at, part))
            at, ids, part = at[order], ids[order], part[order]
            cuts = [0, *(np.nonzero(np.diff(part))[0] + 1).tolist(), len(at)]
            bundles = [squeeze(at[a:b].tobytes() + ids[a:b].tobytes()) for a, b in zip(cuts, cuts[1:], strict=False)]
            return pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]].astype(np.int32)), pa.array(bundles, pa.binary())], names=["part", "bundle"])

        for batch in batches:
            index = np.array([base[t] for t in batch.column(0).to_pylist()], np.int64) + batch.column(1).to_numpy()
            slots.append(feistel(index, total, key, rounds))
            held.append(np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, stride))
            rows += len(index)
            if rows * stride >= layout.packed:
                yield packed()
                slots, held, rows = [], [], 0
        if rows:
            yield packed()

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for bundle in batch.column(0):
                raw = expand(bundle.as_buffer())
                n = len(raw) // (8 + stride)
                at = np.frombuffer(raw, np.int64, n)
                ends = pa.py_buffer((np.arange(n + 1, dtype=np.int32) * stride).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.Array.from_buffers(pa.binary(), n, [None, ends, pa.py_buffer(raw[8 * n :])])], names=["slot", "ids"])

    parts = math.ceil(shards * layout.records / run_length)
    bundles = whole.mapInArrow(pack, "part int, bundle binary").repartitionById(parts, F.col("part"))
    ranged = bundles.select("bundle").mapInArrow(unpack, "slot long, ids binary").sortWithinPartitions("slot")
    shard = F.floor(F.col("slot") / layout.records).cast("int").alias("shard")
    return ranged.select("slot", shard, (F.col("slot") % layout.records).cast("int").alias("record"), "ids")


def write_shards(ordered: DataFrame, folder: str, layout: Layout = Layout()) -> DataFrame:
    """Write the shards of `in_training_order` below `folder` (any URI that pyarrow knows, reachable by all
    executors) and return shard, path, records and crc32, one row per file.

    A shard is written under a name of the attempt's own and renamed when complete, so lost and speculative
    attempts leave no half-written shard. An attempt that finds its shard complete (an earlier one was lost after
    its renaming) takes that file if length and checksum agree, and replaces it otherwise; so it also goes well on stores that do not
    rename onto a name in use. `drop_attempts` removes what broken attempts left. Record r of a shard lies at byte
    r * stride: a reader that stopped at any slot goes on by one seek. No record, no file.
    """
    stride = layout.stride

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        out, shard, count, crc = None, None, 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            path = f"{root}/shard-{shard:08d}.bin"
            there = store.get_file_info(path)
            if there.type == fs.FileType.File and there.size == count * stride and _checksum(store, path) == crc:
                store.delete_file(f"{path}.{attempt}")
            else:
                if there.type == fs.FileType.File:
                    store.delete_file(path)
                store.move(f"{path}.{attempt}", path)
            return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [path], "records": pa.array([count], pa.int64()), "crc32": pa.array([crc], pa.int64())})

        for batch in batches:
            for s, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if s != shard:
                    if out is not None:
                        yield closed()
                    out, shard, count, crc = store.open_output_stream(f"{root}/shard-{s:08d}.bin.{attempt}"), s, 0, 0
                if len(ids) != stride:
                    raise ValueError(f"a record of {len(ids)} bytes; the stride is {stride}")
                out.write(ids)
                count, crc = count + 1, zlib.crc32(ids, crc)
        if out is not None:
            yield closed()

    return ordered.select("shard", "ids").mapInArrow(run, "shard int, path string, records long, crc32 long")


def _checksum(store, path: str) -> int:
    crc = 0
    with store.open_input_stream(path) as stream:
        while raw := stream.read(1 << 20):
            crc = zlib.crc32(raw, crc)
    return crc


def drop_attempts(folder: str) -> int:
    """Delete the files of attempts that were broken off below `folder`; call it when no writer is at work. Returns their number."""
    from pyarrow import fs

    store, root = _store(folder)
    left = [f.path for f in store.get_file_info(fs.FileSelector(root, allow_not_found=True)) if not f.path.endswith(".bin")]
    for path in left:
        store.delete_file(path)
    return len(left)


def shard_rows(files: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """slot, shard, record and ids of every record in `files`, the rows of `write_shards`; those of a file are in order.

    The rows are read from the files themselves. A file whose length or checksum is not the one noted is an error.
    """
    stride, per_shard = layout.stride, layout.records

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in batch.to_pylist():
                store, at, crc, rest = _store(f["folder"])[0], 0, 0, b""
                with store.open_input_stream(f["path"]) as stream:
                    while raw := stream.read(512 * stride):
                        crc, raw = zlib.crc32(raw, crc), rest + raw  # a store may return less than asked for
                        rows = len(raw) // stride
                        raw, rest = raw[: rows * stride], raw[rows * stride :]
                        here = np.arange(at, at + rows)
                        ends = pa.py_buffer((np.arange(rows + 1, dtype=np.int32) * stride).tobytes())
                        columns = [
                            pa.array(f["shard"] * per_shard + here, pa.int64()),
                            pa.array(np.full(rows, f["shard"]), pa.int32()),
                            pa.array(here, pa.int32()),
                            pa.Array.from_buffers(pa.binary(), rows, [None, ends, pa.py_buffer(raw)]),
                        ]
                        yield pa.RecordBatch.from_arrays(columns, names=["slot", "shard", "record", "ids"])
                        at += rows
                if rest or (at, crc) != (f["records"], f["crc32"]):
                    raise ValueError(f"{f['path']}: {at} records with checksum {crc}; noted were {f['records']} and {f['crc32']}")

    return files.mapInArrow(run, "slot long, shard int, record int, ids binary")


def materialised(records: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """The rows of `in_training_order`, read from the shard files that this call writes below the shared folder.

    Repeated rows and rows without an id are texts like any other; other columns than text are not read.
    """
    folder = new_work_folder(records.sparkSession, "shards")
    files = stored(write_shards(in_training_order(records, layout), folder, layout), "shard-files")
    drop_attempts(folder)
    parts = max(1, min(files.count(), layout.partitions))
    placed = files.withColumn("folder", F.lit(folder)).repartitionById(parts, F.col("shard") % parts)
    return shard_rows(placed, layout)


def _store(folder: str):
    """File system and root of a folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def read_slots(folder: str, first: int, count: int, layout: Layout = Layout()) -> Iterator[np.ndarray]:
    """Ids of the records at slots first, first + 1, ...: one seek per shard, then sequential reads."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    slot = first
    while slot < first + count:
        shard, record = divmod(slot, layout.records)
        with store.open_input_file(f"{root}/shard-{shard:08d}.bin") as f:
            f.seek(record * layout.stride)
            for _ in range(min(layout.records - record, first + count - slot)):
                yield np.frombuffer(f.read(layout.stride), np.uint16)
                slot += 1


def load_ranks(path: str = RANKS_PATH) -> bytes:
    with open(path, "rb") as f:
        return f.read()
