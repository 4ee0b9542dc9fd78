"""Removal of bytes inside strings that occur twice, by two-stage suffix sorting of the places that can repeat."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import map_batches, release_memory, stored

FAR = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class Repeats:
    """`length`: bytes of a string that counts as a repeat. `gram`: bytes of an anchor.

    `group`: bytes of the segments of one anchor above which they are cut by more of their context, to widths of `widths`
    starts; it decides who sorts what, never what is found. `batch`: bytes sorted at once. `filter_bits`: most bits of the
    filter that spares segments without a partner their way through a shuffle; a full one costs time only.
    """

    length: int = 200
    gram: int = 64
    group: int = 1 << 19
    widths: tuple[int, ...] = (16, 1)
    batch: int = 1 << 17
    filter_bits: int = 1 << 27

    @property
    def window(self) -> int:
        return self.length - self.gram + 1


def _powers(factor: int, n: int) -> np.ndarray:
    """factor ** 0 .. n - 1 modulo 2 ** 64."""
    return np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(max(n - 1, 0), factor, np.uint64))])[:n]


FACTOR = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(FACTOR, -1, 1 << 64)
#: A random number for each byte, from a rule.
BYTES = np.array([int.from_bytes(hashlib.sha256(b"%d" % b).digest()[:8], "little") for b in range(256)], np.uint64)
STRIDE = 1 << 18
_up, _down = _powers(FACTOR, STRIDE + 4096), _powers(INVERSE, STRIDE + 4096)


def _gram_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the `size` bytes from each place on."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTES[raw] * _up[: len(raw)], out=sums[1:])
    h = (sums[size:] - sums[: len(raw) - size + 1]) * _down[: len(raw) - size + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _least(values: np.ndarray, window: int) -> np.ndarray:
    """The least of each `window` values in a row."""
    n = len(values) - window + 1
    blocks = np.concatenate([values, np.full(-len(values) % window, FAR)]).reshape(-1, window)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[window - 1 : window - 1 + n])


def segments(raw: bytes, how: Repeats) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, anchor place, first start, number of starts) of the segments of a text, in order.

    Each string of `length` bytes has one anchor: the gram inside it with the least hash, the leftmost of equals. Equal
    strings have equal anchors at equal places in them. A segment holds neighbouring starts with one anchor.
    """
    whole = np.frombuffer(raw, np.uint8)
    parts: list[tuple[np.ndarray, ...]] = []
    starts = len(whole) - how.length + 1
    for base in range(0, starts, STRIDE):
        n = min(STRIDE, starts - base)
        hashes = _gram_hashes(whole[base : base + n + how.length - 1], how.gram)
        place = np.arange(len(hashes), dtype=np.uint64)
        least = _least(hashes & ~np.uint64((1 << 20) - 1) | place, how.window)
        first = np.nonzero(np.concatenate([[True], least[1:] != least[:-1]]))[0]
        anchor = (least[first] & np.uint64((1 << 20) - 1)).astype(np.int64)
        parts.append((hashes[anchor], base + anchor, base + first, np.diff(np.append(first, n))))
    if not parts:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def suffix_order(raw: bytes, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, symbols): the suffixes of segments laid end to end, each followed by a byte that counts as an end mark.

    ends: the place of each segment's end mark, ascending; the last is the end of `raw`. Two-stage sorting: a suffix that is
    smaller than the one after it is sorted directly, by its first `depth` bytes; each other suffix follows from the
    order of the one after it, in one pass over the buckets of first symbols from the smallest on. Suffixes equal in `depth`
    bytes stand together, in any order.
    """
    s = np.frombuffer(raw, np.uint8).astype(np.int16) + 1
    s[ends] = 0
    n = len(s)
    differs = np.append(s[1:] != s[:-1], True)
    smaller = np.append(s[:-1] < s[1:], True)
    smaller[ends] = True
    change = np.where(differs, np.arange(n), n)
    smaller = smaller[np.minimum.accumulate(change[::-1])[::-1]]  # a run of one symbol goes as its last one does
    direct = np.nonzero(smaller & (s > 0))[0]
    stop = np.minimum(ends[np.searchsorted(ends, direct)], direct + depth)
    keys = [raw[a:b] for a, b in zip(direct.tolist(), stop.tolist(), strict=True)]
    direct = direct[np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)]
    by_symbol = {int(s[g[0]]): g for g in np.split(direct, np.nonzero(np.diff(s[direct]))[0] + 1) if len(g)}
    waiting: dict[int, list[np.ndarray]] = {}
    order = []
    for symbol in np.unique(s).tolist():
        if symbol == 0:
            bucket = [ends]
        else:
            bucket = waiting.pop(symbol, [])
            last = np.concatenate(bucket) if bucket else direct[:0]
            while len(last):  # larger suffixes that start with this symbol twice
                last = last[last > 0] - 1
                last = last[s[last] == symbol]
                bucket.append(last)
            bucket.append(by_symbol.get(symbol, direct[:0]))
        whole = np.concatenate(bucket)
        order.append(whole)
        before = whole[whole > 0] - 1
        before = before[s[before] > symbol]
        if len(before):
            before = before[np.argsort(s[before], kind="stable")]
            for group in np.split(before, np.nonzero(np.diff(s[before]))[0] + 1):
                waiting.setdefault(int(s[group[0]]), []).append(group)
    return np.concatenate(order), s


def common_prefixes(order: np.ndarray, s: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each place of the array, how many bytes its suffix shares with the one before it in `order`.

    Where the suffixes before two neighbouring places are neighbours too and the first place shares a byte, the next
    shares one byte less; only the others are compared, eight bytes at a time, never beyond the end of a segment.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    place = np.arange(n)
    room = ends[np.searchsorted(ends, place)] - place
    follows = np.zeros(n, bool)
    follows[1:] = (before[1:] == before[:-1] + 1) & (before[:-1] >= 0) & (s[:-1] > 0) & (s[:-1] == s[before[:-1]])
    padded = np.concatenate([(s - 1).astype(np.uint8), np.zeros(8, np.uint8)])
    eights = np.lib.stride_tricks.as_strided(padded, (n, 8), (1, 1))
    eights = np.ascontiguousarray(eights).view("<u8").ravel()
    shared = np.zeros(n, np.int64)
    heads = np.nonzero(~follows & (before >= 0))[0]
    most = np.minimum(room[heads], room[before[heads]])
    live, at = np.arange(len(heads)), np.zeros(len(heads), np.int64)
    while len(live):
        a, b = heads[live] + at[live], before[heads[live]] + at[live]
        differ = eights[a] ^ eights[b]
        low = differ & (~differ + np.uint64(1))  # the lowest bit that differs
        same = np.where(differ == 0, 8, np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)).astype(np.int64) // 8)
        at[live] = np.minimum(at[live] + same, most[live])
        live = live[(same == 8) & (at[live] < most[live])]
    shared[heads] = at
    head = np.maximum.accumulate(np.where(follows, 0, place))
    return shared[head] - (place - head)


def repeated_starts(pieces: list[tuple[bytes, bool]], how: Repeats) -> list[list[int]]:
    """For each piece (bytes, whether it occurs more than once) the starts of strings that repeat: first, last, first, last ..."""
    raw = b"".join(p + b"\0" for p, _ in pieces)
    sizes = np.array([len(p) + 1 for p, _ in pieces])
    ends = np.cumsum(sizes) - 1
    order, s = suffix_order(raw, ends, how.length)
    shared = common_prefixes(order, s, ends)
    most = shared.copy()
    most[order[:-1]] = np.maximum(most[order[:-1]], shared[order[1:]])
    hit = np.append(most >= how.length, False)
    for (p, often), end in zip(pieces, ends.tolist(), strict=True):
        if often:  # its copies stand beside it in the array: they share all that there is
            hit[end - len(p) : end - how.length + 1] = True
    edge = np.nonzero(np.diff(np.concatenate([[False], hit])))[0].reshape(-1, 2)
    out: list[list[int]] = [[] for _ in pieces]
    owner = np.searchsorted(ends, edge[:, 0])
    for k, a, b in zip(owner.tolist(), edge[:, 0].tolist(), edge[:, 1].tolist(), strict=True):
        begin = int(ends[k]) + 1 - int(sizes[k])
        out[k] += [a - begin, b - 1 - begin]
    return out


def _cut(wide: DataFrame, how: Repeats, width: int) -> DataFrame:
    """key, name, at and bytes of the pieces of segments (name, at, bytes) with `width` starts or fewer, and piece_of and skip.

    Pieces are cut at places that count from the anchor, so equal strings lie in pieces of one key: the bytes that
    all strings of the piece have in common.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for name, at, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                top = len(raw) - how.length
                for a in range((at - top) // width * width, at + 1, width):  # distances to the anchor a .. a + width - 1
                    first, last = max(at - a - width + 1, 0), min(at - a, top)
                    if first > last:
                        continue
                    piece = raw[first : last + how.length]
                    common = raw[at - a : at - a - width + 1 + how.length]
                    key = xxhash.xxh64_intdigest(common, seed=a + 1) - (1 << 63)
                    made.append((key, xxhash.xxh3_128_digest(piece + a.to_bytes(4, "little")), at - first, piece, name, first))
            kinds = [pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.int32()]
            columns = list(zip(*made, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "name", "at", "bytes", "piece_of", "skip"])

    return map_batches(wide.select("name", "at", "bytes"), run, "key long, name binary, at int, bytes binary, piece_of binary, skip int")


def _sorted_spans(distinct: DataFrame, how: Repeats) -> DataFrame:
    """name and spans (first, last, ... of the starts that repeat) of segments (key, name, bytes, n), sorted key by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[bytes] = []
        pieces: list[tuple[bytes, bool]] = []
        size, now, begun = 0, None, 0

        def alone() -> bool:
            """Whether the last piece has no partner: it occurs once and so does its key."""
            return bool(pieces) and not pieces[-1][1] and begun == len(pieces) - 1

        def solved() -> pa.RecordBatch:
            spans = repeated_starts(pieces, how)
            some = [i for i, x in enumerate(spans) if x]
            columns = [pa.array([names[i] for i in some], pa.binary()), pa.array([spans[i] for i in some], pa.list_(pa.int32()))]
            return pa.RecordBatch.from_arrays(columns, names=["name", "spans"])

        for batch in batches:
            for key, name, raw, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != now:
                    if alone():
                        size -= len(pieces.pop()[0])
                        names.pop()
                    if size > how.batch:
                        yield solved()
                        names, pieces = [], []
                        if size > 2 * how.batch:
                            release_memory()
                        size = 0
                    now, begun = key, len(pieces)
                names.append(name)
                pieces.append((raw, n > 1))
                size += len(raw)
        if alone():
            pieces.pop()
        if pieces:
            yield solved()

    ranged = distinct.select("key", "name", "bytes", "n").repartition("key").sortWithinPartitions("key")
    return map_batches(ranged, run, "name binary, spans array<int>")


def _found(distinct: DataFrame, how: Repeats, widths: tuple[int, ...]) -> DataFrame:
    """name and spans of segments (key, name, at, bytes, n); those of an anchor with too many bytes are cut first."""
    if not widths:
        return _sorted_spans(distinct, how)
    sizes = distinct.groupBy("key").agg(F.sum(F.length("bytes")).alias("size")).where(F.col("size") > how.group)
    large = stored(sizes.select("key"), "large-anchors")
    if large.isEmpty():
        return _sorted_spans(distinct, how)
    small = _sorted_spans(distinct.join(large, "key", "left_anti"), how)
    pieces = stored(_cut(distinct.join(large, "key", "left_semi"), how, widths[0]).join(distinct.select(F.col("name").alias("piece_of"), "n"), "piece_of"), "pieces", "zstd")
    inner = stored(_found(_distinct(pieces), how, widths[1:]), "piece-spans", "zstd")
    back = pieces.select("name", "piece_of", "skip").join(inner, "name")
    back = back.select(F.col("piece_of").alias("name"), F.transform("spans", lambda x: x + F.col("skip")).alias("spans"))
    return small.unionByName(back.groupBy("name").agg(F.flatten(F.collect_list("spans")).alias("spans")))


def _distinct(pieces: DataFrame) -> DataFrame:
    """Pieces (key, name, at, bytes, n) of one name as one row; copies are counted before the shuffle."""
    return stored(pieces.groupBy("name").agg(F.first("key").alias("key"), F.first("at").alias("at"), F.first("bytes", True).alias("bytes"), F.sum("n").alias("n")), "distinct", "zstd")


def _live_filter(live: DataFrame, how: Repeats) -> np.ndarray | None:
    """Bits at two places of each of the `live` keys, 16 to 32 bits for a key; None where that is more than the largest filter."""
    bits = 1 << max(10, (16 * live.count()).bit_length())
    if bits > how.filter_bits:
        return None
    places = F.array(F.pmod(F.col("key"), F.lit(bits)), F.pmod(F.shiftrightunsigned("key", 32), F.lit(bits)))
    word = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % 64).cast("int"))
    each = live.select(F.explode(places).alias("place")).select(F.floor(F.col("place") / 64).cast("long").alias("at"), word.alias("word"))
    found = each.groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[found["at"].to_numpy()] = found["word"].to_numpy().view(np.uint64)
    return words


def _may_live(words: np.ndarray | None, keys: np.ndarray) -> np.ndarray:
    """Which of the keys (unsigned) pass the filter: all that are live and one in seventy of the others at most."""
    if words is None:
        return np.ones(len(keys), bool)
    out = np.ones(len(keys), np.uint64)
    for place in (keys.view(np.int64) % (64 * len(words)), (keys >> np.uint64(32)).astype(np.int64) % (64 * len(words))):
        out &= words[place >> 6] >> (place & 63).astype(np.uint64)
    return out.astype(bool)


def _bytes_of(column: pa.Array) -> Iterator[bytes]:
    return (x.as_buffer().to_pybytes() if x.is_valid else b"" for x in column)


def repeated_spans(docs: DataFrame, how: Repeats = Repeats()) -> tuple[DataFrame, DataFrame]:
    """Rows (row, doc_id, n_bytes, sha256, text) of all texts and (row, spans) of those from which bytes go.

    text is there only where something may repeat; spans are first, last, first, last ... of the bytes covered by strings
    of `length` bytes that start more than once.

    Every such string meets its equals under its anchor, so only segments whose anchor occurs twice are sorted. Equal
    segments are one with a count, found by a grouping combined before its shuffle. The segments of an anchor with too many bytes
    (a passage that a third of all texts hold) are cut twice by ever more of the bytes that they share, down to single
    strings, so that no task holds a group that grows with the table. No row, segment or candidate is capped.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                found = [segments(raw, how)[0] for raw in _bytes_of(batch.column(0).slice(start, 512))]
                keys, counts = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["key", "n"])

    counted = map_batches(texts.select("text"), anchors, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    live = stored(counted.where("n > 1").select("key"), "live-anchors")
    words = _live_filter(live, how)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        kinds = pa.struct([("key", pa.int64()), ("name", pa.binary()), ("at", pa.int32()), ("first", pa.int64()), ("bytes", pa.binary())])
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                piece = batch.slice(start, 256)
                sizes, hashes, held, parts, told = [], [], [], [], set()
                for raw in _bytes_of(piece.column(1)):
                    keys, places, first, n = segments(raw, how)
                    here = _may_live(words, keys)
                    keys, places, first, n = keys[here], places[here], first[here], n[here]
                    own = []
                    for key, place, f, k in zip(keys.view(np.int64).tolist(), places.tolist(), first.tolist(), n.tolist(), strict=True):
                        whole = raw[f : f + k - 1 + how.length]
                        name = xxhash.xxh3_128_digest(whole + (place - f).to_bytes(4, "little"))
                        own.append({"key": key, "name": name, "at": place - f, "first": f, "bytes": None if name in told else whole})
                        told.add(name)
                    sizes.append(len(raw))
                    hashes.append(hashlib.sha256(raw).hexdigest())
                    held.append(raw if own else None)
                    parts.append(own)
                rows = pa.array(range(row, row + len(sizes)), pa.int64())
                row += len(sizes)
                columns = [rows, piece.column(0), pa.array(sizes, pa.int64()), pa.array(hashes), pa.array(held, pa.binary()), pa.array(parts, pa.list_(kinds))]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n_bytes", "sha256", "text", "segments"])

    schema = "row long, doc_id long, n_bytes long, sha256 string, text binary, segments array<struct<key: long, name: binary, at: int, first: long, bytes: binary>>"
    rows = stored(map_batches(texts, read, schema), "segments", "zstd")
    every = rows.where("size(segments) > 0").select("row", F.explode("segments").alias("s"))
    each = every.select(F.col("s.key").alias("key"), F.col("s.name").alias("name"), F.col("s.at").alias("at"), F.col("s.bytes").alias("bytes"), F.lit(1).alias("n"))
    if words is None:
        each = each.join(live, "key", "left_semi")
    distinct = _distinct(each)
    spans = stored(_found(distinct, how, how.widths), "spans", "zstd")
    placed = every.select("row", F.col("s.name").alias("name"), F.col("s.first").alias("first")).join(spans, "name")
    covered = placed.select("row", F.transform("spans", lambda x: x + F.col("first")).alias("spans"))
    return rows.drop("segments"), covered.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _merged(starts: list[int], length: int) -> list[tuple[int, int]]:
    """(first byte, end) of the maximal runs covered by strings of `length` bytes at starts first .. last, first .. last."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(starts[::2], starts[1::2], strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b + length))
        else:
            out.append((a, b + length))
    return out


def without_repeats(docs: DataFrame, how: Repeats = Repeats()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans (first, end of each removed run), kept (binary) and sha256 of every row of `docs`.

    Every byte that a string of `length` bytes covers goes if that string also starts anywhere else, in the same text or
    another one; all are judged on the input. kept is null where nothing goes, and sha256 is that of what is kept. Texts are
    UTF-8 bytes and whole. Null, empty and short texts keep what they have; of rows that repeat, each loses all. A repeated or
    missing doc_id changes nothing. An empty table gives no rows; columns but doc_id and text are not read.
    """
    rows, spans = repeated_spans(docs, how)
    spans = spans.withColumnRenamed("row", "of")
    met = rows.join(spans, F.col("row") == F.col("of"), "left").select("doc_id", "n_bytes", "sha256", "text", "spans")
    length = how.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                piece = batch.slice(start, 512)
                gone, count, runs, kept, hashes = [], [], [], [], []
                for sha, raw, starts in zip(*(piece.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                    cuts = _merged(starts, length) if starts else []
                    if cuts:
                        rest = b"".join(raw[a:b] for a, b in zip([0, *(e for _, e in cuts)], [*(s for s, _ in cuts), len(raw)], strict=True))
                        sha = hashlib.sha256(rest).hexdigest()
                    gone.append(sum(b - a for a, b in cuts))
                    count.append(len(cuts))
                    runs.append([x for c in cuts for x in c])
                    kept.append(rest if cuts else None)
                    hashes.append(sha)
                columns = [pa.array(gone, pa.int64()), pa.array(count, pa.int64()), pa.array(runs, pa.list_(pa.int64())), pa.array(kept, pa.binary()), pa.array(hashes, pa.string())]
                yield pa.RecordBatch.from_arrays([*piece.columns[:2], *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept", "sha256"])

    return map_batches(met, run, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<long>, kept binary, sha256 string")


def removal_digests(docs: DataFrame) -> DataFrame:
    """The contract's columns of `without_repeats`: doc_id, n_bytes, n_removed, n_spans and kept_sha256."""
    return without_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.col("sha256").alias("kept_sha256"))
