"""SimHash near-duplicates found by Golay-code fuzzy hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import LOWER, components, map_batches, map_text, scratch, stored
from marketloom.llm.golay import near, nearest
from marketloom.llm.set_join import bit_filter, described, similar_groups, split_by

SEED = 42
#: Bits of each of the four segments of a fingerprint.
SEGMENT = 16
MAX_BITS = 3
#: (exact, i, j): three errors over four segments leave one segment without and two more with at most one each.
#: Two choices of the exact one in each three segments, and each segment in turn, cover every such spread.
TRIPLES = ((0, 1, 2), (1, 0, 2), (0, 1, 3), (3, 0, 1), (2, 0, 3), (3, 0, 2), (1, 2, 3), (2, 1, 3))


def shingles(text: str | None, size: int) -> list[bytes]:
    """Space-joined runs of `size` words, A-Z lower-cased, repeats included; a shorter text is one run."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)))


def fingerprint(text: str | None, size: int = 3) -> int:
    """64 bits, each the majority of that bit over the hashes of all shingles (a tie is 0; no word: 0)."""
    return int(_majority(_hashes(text, size)).view(np.int64)[0])


def _hashes(text: str | None, size: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles(text, size)], dtype="<u8")


def _majority(hashes: np.ndarray) -> np.ndarray:
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 4096):
        part = hashes[start : start + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long) of every whole text; no shuffle."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = [fingerprint(t, size) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], names=["doc_id", "fp"])

    return map_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work, "doc_id long, fp long")


def _keyed(prints: DataFrame, sided: bool) -> DataFrame:
    """key, fp, label and side: for each of TRIPLES one segment as it is and a codeword near each of two others.

    Without `sided`, both are the nearest ones (side 0). With it, side 1 has all near codewords of the first
    with the nearest of the second, and side 2 the other way round.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                signed, labels = (np.array(c.slice(start, 2048), dtype=np.int64) for c in batch.columns)
                parts = [signed >> (SEGMENT * i) & ((1 << SEGMENT) - 1) for i in range(4)]
                one = [nearest(p)[:, None] for p in parts]
                many = [_distinct(near(p, SEGMENT)) for p in parts] if sided else one
                for n, (exact, i, j) in enumerate(TRIPLES):
                    head = ((n << SEGMENT | parts[exact]) << 24)[:, None]
                    for side, first, second in ((1, many[i], one[j]), (2, one[i], many[j])) if sided else ((0, one[i], one[j]),):
                        keys = head | first.astype(np.int64) << 12 | second
                        here = np.broadcast_to((first >= 0) & (second >= 0), keys.shape)
                        rows = np.nonzero(here)[0]
                        yield pa.RecordBatch.from_arrays(
                            [
                                *(pa.array(x, pa.int64()) for x in (keys[here], signed[rows], labels[rows])),
                                pa.array(np.full(len(rows), side, np.int8)),
                            ],
                            names=["key", "fp", "label", "side"],
                        )

    return map_batches(prints.select("fp", "label"), run, "key long, fp long, label long, side byte")


def _distinct(codes: np.ndarray) -> np.ndarray:
    """Each row's values once, at the left; the rest is -1."""
    ordered = np.sort(codes, axis=1)
    ordered[:, 1:][ordered[:, 1:] == ordered[:, :-1]] = -1
    ordered = -np.sort(-ordered, axis=1)
    return ordered[:, : max(1, int((ordered >= 0).sum(1).max(initial=1)))]


def _differ() -> Column:
    return F.bit_count(F.col("a").bitwiseXOR(F.col("b")))


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that join exactly the distinct fingerprints reachable by steps of at most `max_bits` bits.

    A link leads to the smallest fingerprint of a group or joins two of these, so its own ends may differ in more bits.

    Keys have 40 bits besides the choice of segments. If two fingerprints differ in three bits at most, one of four
    segments is equal and two more, i and j, differ in one bit at most. Then the nearest codeword of either is near
    the other, in i as in j: a key of side 1 of the one equals a key of side 2 of the other. A fingerprint has some
    42 keys on each side. So joining the sides loses no link, and chance hardly adds any. Each candidate is
    verified on all 64 bits.

    A dense group would give all its pairs. It is therefore first tied together by hubs (every fingerprint to
    the smallest and the largest that share its nearest codewords, verified too); the join then only looks for
    links between fingerprints that are not yet in one component. Keys under which only one component or one
    side lies go before any pair is made: they are found by a grouping that is combined before its shuffle, and
    only what lies under the others is written. No key, pair or component is capped.
    """
    if max_bits > MAX_BITS:
        raise ValueError(f"the four segments promise links up to {MAX_BITS} bits only")
    alone = prints.select("fp", F.col("fp").alias("label"))
    narrow = stored(_keyed(alone, sided=False).select("key", "fp"), "narrow")
    hubs = stored(narrow.groupBy("key").agg(F.min("fp").alias("b"), F.max("fp").alias("c")).where("b <> c"), "hubs")
    first = stored(
        narrow.withColumnRenamed("fp", "a")
        .join(hubs, "key")
        .select("a", F.explode(F.array("b", "c")).alias("b"))
        .where((F.col("a") != F.col("b")) & (_differ() <= max_bits))
        .distinct(),
        "hub-links",
    )
    groups = components(first)
    label = F.coalesce("component", "fp").alias("label")
    labelled = stored(prints.select("fp").join(groups, F.col("fp") == F.col("node"), "left").select("fp", label), "labels")
    keyed = _keyed(labelled, sided=True)
    spread = keyed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.bit_or("side").alias("sides"))
    live = stored(spread.where("low <> high and sides = 3").select("key"), "live-keys")
    hits = stored(keyed.join(live, "key"), "hits")
    left, right = (
        hits.where(F.col("side") == side).select("key", F.col("fp").alias(end), F.col("label").alias(f"label_{end}"))
        for side, end in ((1, "a"), (2, "b"))
    )
    second = (
        left.join(right, "key")
        .where((F.col("label_a") != F.col("label_b")) & (_differ() <= max_bits))
        .select(F.greatest("label_a", "label_b").alias("a"), F.least("label_a", "label_b").alias("b"))
        .distinct()
    )
    return stored(second, "links").unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b")))


def near_duplicates(docs: DataFrame, size: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable) for every row of `docs`.

    Whole texts count. Null, empty and blank texts have fingerprint zero and are linked like any other.
    Equal fingerprints are one node, so copies, however many, are never paired. Repeated rows each get
    their row; a null doc_id gets a null component only if its whole component has no other id.
    """
    prints = stored(fingerprints(docs, size), "prints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "nodes")
    groups = components(fingerprint_links(nodes, max_bits))
    placed = nodes.join(groups, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("label")
    )
    placed = stored(placed, "placed")
    lowest = stored(placed.groupBy("label").agg(F.min("low").alias("component_id")), "lowest")
    names = stored(placed.join(lowest, "label").select(F.col("fp").alias("__fp"), "component_id"), "names")
    return prints.join(names, F.col("fp") == F.col("__fp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Hashes of the distinct shingles of a text, ascending."""
    return np.unique(_hashes(text, size)).astype(np.uint64, copy=False)


def fuzzy_pairs(sets: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b) of unlike `sets` (node, fp): each set with the smallest one whose fingerprint is reachable from its own.

    Steps are those of `near_duplicates`: at most `max_bits` bits, found by Golay keys. The pairs are candidates: neither are all
    of them similar, nor are all similar sets so near.
    """
    with scratch(sets.sparkSession):
        nodes = stored(sets.select("node", "fp").distinct(), "prints")
        groups = components(fingerprint_links(nodes.select("fp").distinct(), max_bits))
        placed = nodes.join(groups.withColumnRenamed("node", "of"), F.col("fp") == F.col("of"), "left")
        placed = stored(placed.select("node", F.coalesce("component", "fp").alias("label")), "placed")
        lowest = placed.groupBy(F.col("label").alias("of")).agg(F.min("node").alias("low"))
        pairs = placed.join(lowest, F.col("label") == F.col("of")).where("node <> low")
        return stored(pairs.select(F.col("low").alias("a"), F.col("node").alias("b")), "fuzzy-pairs")


#: A row's name, without nulls so that it can be joined by.
NAME = ["hash", "id_or_0", "no_id"]


def row_hash(docs: DataFrame, row: str = "row") -> Column:
    """A hash of all columns of `docs`, packed in the struct `row`, and of which of them are null.

    Spark's hash of a row passes over nulls, so that a value would count the same in whichever column it stands beside them.
    """
    return F.xxhash64(F.array(*(F.col(f"{row}.`{c}`").isNull() for c in docs.columns)), row)


def _named(rows: DataFrame, *more: str | Column) -> DataFrame:
    """The columns of NAME from id and hash, and `more`."""
    return rows.select("hash", F.coalesce("id", F.lit(0).cast("long")).alias("id_or_0"), F.col("id").isNull().alias("no_id"), *more)


def drop_duplicates(docs: DataFrame, size: int = 5) -> DataFrame:
    """One row of each group of near copies, all columns unchanged: the one with the smallest doc_id.

    Texts are near copies if the sets of their runs of `size` words have a Jaccard similarity of 0.8 or more; a
    group is what such steps reach. The SimHash fingerprints of these sets, met by Golay keys, propose pairs first (`fuzzy_pairs`); each
    is verified on the sets, and the pairs that lie further apart than Golay keys reach are found by `similar_groups`, which
    is complete. All texts without a word are one group. Rows
    without a doc_id come last in their group; rows that share a doc_id are rows of their own and the hash of all
    their columns (`row_hash`) decides, so a second reading keeps the same ones. Only texts that may go or that have copies move, once:
    a filter of their hashes passes them and, by chance, a few others. Where there are too many for it, all texts move once.
    What the steps stored is deleted, but for the names of the rows that move.
    """
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    own = own.select(F.col("row.doc_id").cast("long").alias("id"), row_hash(docs).alias("hash"), F.col("row.text").alias("text"), "row")
    with scratch(docs.sparkSession):
        rows = described(own, lambda t: shingle_set(t, size), lambda s: int(_majority(s).view(np.int64)[0]))
        groups = similar_groups(own, rows, lambda t: shingle_set(t, size), fuzzy_pairs(rows))
        placed = rows.select("id", "hash", F.col("node").alias("own")).join(groups, F.col("own") == F.col("node"), "left")
        placed = stored(_named(placed, F.coalesce("component", "own").alias("label")), "placed")
        first = F.min(F.struct("no_id", "id_or_0", "hash")).alias("first")
        stay = placed.groupBy("label").agg(first).select(*(F.col(f"first.{c}").alias(c) for c in NAME), F.lit(True).alias("stays"))
        times = placed.groupBy(*NAME).agg(F.count("*").alias("n"))
        unsure = times.join(stay, NAME, "left").where("n > 1 or stays is null")
        unsure = stored(unsure.select(*NAME, F.coalesce("stays", F.lit(False)).alias("stays")), "unsure")
        words = bit_filter(unsure, "hash")
    sure, moving = split_by(_named(own, "row"), "hash", words)
    kept = moving.dropDuplicates(NAME).join(unsure, NAME, "left").where("coalesce(stays, true)").select("row.*")
    return kept if sure is None else sure.select("row.*").unionByName(kept)
