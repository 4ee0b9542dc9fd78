"""Maximal periodic runs of words (period q, at least three times) by tiles per period octave and boundary Z-functions."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import stored

#: A run has this many words and this many periods at least.
LEAST, TIMES = 24, 3
#: Words that are compared at once to see which tiles can hold a run.
GRAM = 8
FAR = np.iinfo(np.int64).max

#: The words of a document (doc_id, text).
Words = Callable[[int | None, bytes | None], list[bytes]]


def split_words(doc_id: int | None, text: bytes | None) -> list[bytes]:
    return (text or b"").split()


def planted_words(doc_id: int | None, text: bytes | None) -> list[bytes]:
    """The contract's words: those of a tenth of the documents, by crc32 of the id, repeat from some word on."""
    words = split_words(doc_id, text)
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    root = words[a : a + p]
    return words[:a] + (root * ((n - a) // len(root) + 1))[: n - a]


def spacing(octave: int) -> int:
    """Words from one boundary to the next: two words a given period apart are equal so often in any run."""
    return max(LEAST - (1 << 3), 2 << octave)


def _grams(ids: np.ndarray) -> np.ndarray:
    h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    factor = 0xBF58476D1CE4E5B9
    width = 1
    while width < GRAM:
        h = h[:-width] * np.uint64(factor) + h[width:]
        h ^= h >> np.uint64(31)
        width, factor = 2 * width, factor * factor & 0xFFFFFFFFFFFFFFFF
    return h


def _numbers(words: list[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int32, len(words))


def tiles(ids: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(octave, boundary, first word, word numbers) of every tile of a document that can hold part of a run.

    Octave k has the periods 2**k to 2**(k + 1) - 1 and boundaries every D = `spacing(k)` words; the tile of a boundary
    c has the words c - D to c + D + 2**(k + 1). In a run of period q, D words in a row at least equal the one q
    before, and so do runs of eight words: a tile whose neighbourhood has no such row is left out, which loses nothing. So
    is a tile that has a period of a lower octave all over: what it holds is found there.
    """
    n = len(ids)
    if n < LEAST:
        return
    grams = _grams(ids)
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return
    later, earlier = order[1:][same], order[:-1][same]
    back = np.full(len(grams), FAR)
    back[later] = later - earlier
    first = np.arange(len(back))
    first[1:][back[1:] == back[:-1]] = 0
    first = np.maximum.accumulate(first)  # where the stretch of equal distances began
    octave = 0
    while TIMES << octave <= n:
        step, top = spacing(octave), 2 << octave
        near = np.concatenate([[False], back < top, [False]])
        edge = np.nonzero(near[1:] != near[:-1])[0].reshape(-1, 2)
        edge = edge[edge[:, 1] - edge[:, 0] >= step - GRAM + 1]
        places = [np.arange(-(-max(0, a - top + 1) // step), min(n, b + GRAM - 1 - (top >> 1)) // step + 1) * step for a, b in edge.tolist()]
        for c in np.unique(np.concatenate(places)).tolist() if places else ():
            begin, end = max(0, c - step), min(n, c + step + top)
            last = end - GRAM
            if back[last] < top >> 1 and first[last] <= begin + back[last]:
                continue
            yield octave, c, begin, ids[begin:end]
        octave += 1


def z_function(s: list[int]) -> list[int]:
    """For each place, how far the sequence from there on equals the sequence from its start."""
    n = len(s)
    z = [0] * n
    z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        if i + k >= right:
            while i + k < n and s[k] == s[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def _primes(q: int) -> Iterator[int]:
    p = 2
    while p * p <= q:
        if q % p == 0:
            yield p
            while q % p == 0:
                q //= p
        p += 1
    if q > 1:
        yield q


def fragments(octave: int, c: int, begin: int, ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(period, from, to): words from .. to - 1 around boundary c equal the words one period later, inside the tile.

    Forward they follow from the Z-function of what lies right of the boundary, backward from that of what lies left of
    it, read backward. A period is left out where a divisor of it is a period of the same words: then it is not the
    smallest of any run that the tile is part of.
    """
    step, b = spacing(octave), c - begin
    tile = ids.tolist()
    ahead = z_function(tile[b:]) if b < len(tile) else []
    most = min((2 << octave) - 1, len(tile) - b)
    left = tile[:b][::-1]
    behind = z_function([*left, -1, *tile[: b + most][::-1]])[b + 1 :] if left else []

    def reach(q: int) -> tuple[int, int]:
        return (behind[most - q] if left else 0), (ahead[q] if q < len(ahead) else 0)

    for q in range(1 << octave, most + 1):
        back, on = reach(q)
        on = min(on, step)
        if back + on < step:
            continue
        for r in _primes(q):
            back_r, on_r = reach(q // r)
            if back_r >= back and on_r >= on + q - q // r:
                break
        else:
            yield q, c - back, c + on


def _read(docs: DataFrame, words: Words) -> DataFrame:
    """One row per document and one per tile (octave not null); text, the words with single spaces, only if there is a tile."""
    fields = {
        "row": pa.int64(), "doc_id": pa.int64(), "n_words": pa.int64(), "sha256": pa.string(), "text": pa.binary(),
        "octave": pa.int32(), "boundary": pa.int64(), "begin": pa.int64(), "ids": pa.binary(),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        made: list[tuple] = []
        size = 0

        def batch_of() -> pa.RecordBatch:
            columns = zip(*made, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, fields.values(), strict=True)], names=list(fields))

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = words(doc_id, text.as_buffer().to_pybytes() if text.is_valid else None)
                whole, tiled = b" ".join(own), False
                for octave, c, begin, ids in tiles(_numbers(own)):
                    tiled = True
                    made.append((row, None, None, None, None, octave, c, begin, ids.tobytes()))
                    size += 4 * len(ids)
                    if size > 1 << 22:
                        yield batch_of()
                        made, size = [], 0
                made.append((row, doc_id, len(own), hashlib.sha256(whole).hexdigest(), whole if tiled else None, None, None, None, None))
                size += len(whole) if tiled else 200
                row += 1
                if size > 1 << 22:
                    yield batch_of()
                    made, size = [], 0
        if made:
            yield batch_of()

    kinds = "row long, doc_id long, n_words long, sha256 string, text binary, octave int, boundary long, begin long, ids binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, kinds)


def _solve(tiled: DataFrame) -> DataFrame:
    """row, period, begin and end of the fragments of every tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                (row, *f)
                for row, octave, c, begin, ids in zip(*(x.to_pylist() for x in batch.columns), strict=True)
                for f in fragments(octave, c, begin, np.frombuffer(ids, np.int32))
            ]
            columns = list(zip(*made, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["row", "period", "begin", "end"])

    return tiled.select("row", "octave", "boundary", "begin", "ids").mapInArrow(run, "row long, period long, begin long, end long")


def _stitched(parts: DataFrame) -> DataFrame:
    """row, start, length, period: fragments of a document and period that touch are one run."""
    order = Window.partitionBy("row", "period").orderBy("begin", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = parts.withColumn("opens", (before.isNull() | (F.col("begin") > before)).cast("int"))
    numbered = opened.withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy("row", "period", "run").agg(F.min("begin").alias("start"), F.max("end").alias("end"))
    runs = whole.select("row", "start", (F.col("end") + F.col("period") - F.col("start")).alias("length"), "period")
    return runs.where((F.col("length") >= LEAST) & (F.col("length") >= TIMES * F.col("period")))


def periodic_runs(docs: DataFrame, words: Words = split_words) -> DataFrame:
    """doc_id, n_words, runs, sha256 and collapsed of every row of `docs` (doc_id, text; other columns are not read).

    runs: array of (start, length, period) by start and period of the maximal stretches of words that have smallest
    period `period` and at least 24 words and three periods. sha256: of the words joined by single spaces. collapsed: the
    words outside the repeats (of each run the first period stays), null where there is no run and nothing goes.

    A document is cut into tiles of every period octave, which are dealt out over all tasks: a document that is most of
    the table is not one task's work. Fragments meet again by document and period. Whole texts count. Null, empty and short
    texts have no run; repeated rows and rows without doc_id each get their row; an empty table gives no rows.
    """
    read = stored(_read(docs, words), "tiles", "zstd")
    tiled = read.where("octave is not null").repartition("row", "octave", "boundary")
    runs = _stitched(stored(_solve(tiled), "fragments"))
    lists = runs.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("found"))
    lists = lists.select(F.col("row").alias("of"), F.transform("found", lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period"))).alias("runs"))
    rows = read.where("octave is null").select("row", "doc_id", "n_words", "sha256", "text")
    met = rows.join(lists, F.col("row") == F.col("of"), "left").select("doc_id", "n_words", "sha256", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                piece = batch.slice(start, 1024)
                kept = [collapsed(t, r) if r else None for t, r in zip(piece.column(3).to_pylist(), piece.column(4).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*piece.columns[:3], piece.column(4), pa.array(kept, pa.binary())], names=["doc_id", "n_words", "sha256", "runs", "collapsed"])

    kind = "array<struct<start: long, length: long, period: long>>"
    out = met.mapInArrow(run, f"doc_id long, n_words long, sha256 string, runs {kind}, collapsed binary")
    return out.select("doc_id", "n_words", F.coalesce("runs", F.array().cast(kind)).alias("runs"), "sha256", F.col("collapsed").cast("string").alias("collapsed"))


def collapsed(text: bytes, runs: list[dict]) -> bytes:
    """The words of `text` (single spaces) without those of each run after its first period."""
    own = text.split(b" ")
    gone = np.zeros(len(own) + 1, np.int64)
    for r in runs:
        gone[r["start"] + r["period"]] += 1
        gone[r["start"] + r["length"]] -= 1
    return b" ".join(own[i] for i in np.nonzero(np.cumsum(gone)[:-1] == 0)[0].tolist())


def run_digests(docs: DataFrame) -> DataFrame:
    """The contract's columns: doc_id, n_runs, the run of the greatest exact length / period, and both digests."""
    found = periodic_runs(docs, planted_words)
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    more = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    first = F.array_sort("runs", lambda a, b: F.when(more(a, b), -1).when(more(b, a), 1).otherwise(F.signum((a["start"] - b["start"]) * 2 + F.signum(a["period"] - b["period"])).cast("int")))
    best = F.get(first, F.lit(0))
    return found.select("*", best.alias("best")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.coalesce(F.sha2("collapsed", 256), F.col("sha256")).alias("collapsed_sha256"),
    )
