"""Cheapest repair of conversations to the form (system) (user assistant)+, by Four-Russians block tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import stored

#: Costs of the edits and of an undeleted truncated row.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States: nothing yet, after the system row, after a user row, after an assistant row. It may end in 0 and in 3.
START, ENDS = 0, (0, 3)
#: State after a row of role initial s, u, a (None: not allowed there).
AFTER = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3})
#: State after an inserted or re-roled row, which is a user's or an assistant's.
NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
#: A row's code: its role initial (s, u, a, other) * 3 + its condition.
PLAIN, CUT, GONE = 0, 1, 2
CODES, OTHER = 12, 3
#: Rows per table block, and rows per chunk at most.
BLOCK, CHUNK = 3, 4096
BLANK = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"


def _closed(costs: list[int]) -> tuple[int, ...]:
    """Cost to the end from each state, with inserts before the next row."""
    out = list(costs)
    for _ in range(4):
        out = [min(c, INSERT + out[NEXT[s]]) for s, c in enumerate(out)]
    return tuple(out)


def _moves(code: int, state: int) -> Iterator[tuple[str, int, int]]:
    """(initial, cost, state after it) of the edits of a row in ASCII order."""
    role, condition = divmod(code, 3)
    yield "D", DELETE, state
    if condition != GONE:
        extra = TRUNCATED if condition == CUT else 0
        if role < OTHER and state in AFTER[role]:
            yield "K", KEEP + extra, AFTER[role][state]
        yield "R", REROLE + extra, NEXT[state]


@dataclass(frozen=True)
class Tables:
    """Everything a row or a block of rows does to a vector of costs to the end, by the vector's number.

    A vector has the cheapest cost from each of the four states to the end of the conversation, less the least of
    them. As an insert costs 2 and a deletion 3, its entries stay below 8, and only `vectors` of them occur. `vec`, `off` and
    `leave` hold, for each block length, code and vector at the block's right end: the vector at its left end,
    what was subtracted, and for each state at its left end the state at its right end on the repair whose edits come first in
    ASCII order. `letters` are that repair's edits of a single row.
    """

    vectors: tuple[tuple[int, ...], ...]
    end: int
    vec: tuple[np.ndarray, ...]
    off: tuple[np.ndarray, ...]
    leave: tuple[np.ndarray, ...]
    letters: tuple[tuple[tuple[str, ...], ...], ...]


@lru_cache(maxsize=1)
def tables() -> Tables:
    found = {_closed([0 if s in ENDS else 99 for s in range(4)]): 0}
    todo, steps = list(found), {}
    while todo:
        after = todo.pop()
        for code in range(CODES):
            row = [min(cost + after[to] for _, cost, to in _moves(code, s)) for s in range(4)]
            before = _closed(row)
            least = min(before)
            before = tuple(c - least for c in before)
            if before not in found:
                found[before] = len(found)
                todo.append(before)
            steps[code, found[after]] = (found[before], least)
    vectors = tuple(found)
    n = len(vectors)
    vec = np.array([[steps[c, v][0] for v in range(n)] for c in range(CODES)])
    off = np.array([[steps[c, v][1] for v in range(n)] for c in range(CODES)])
    texts, leave = [], np.zeros((CODES, n, 4), np.int64)
    for code in range(CODES):
        texts.append([])
        for v in range(n):
            walks = [_walk(code, s, vectors[v], tuple(c + off[code, v] for c in vectors[vec[code, v]])) for s in range(4)]
            texts[-1].append(tuple(w[0] for w in walks))
            leave[code, v] = [w[1] for w in walks]
    vecs, offs, leaves = [vec], [off], [leave]
    for _ in range(BLOCK - 1):  # a longer block is one row before the shorter one
        mid = vecs[-1]
        vecs.append(vec[:, mid].reshape(-1, n))
        offs.append((off[:, mid] + offs[-1]).reshape(-1, n))
        first = leave[:, mid]
        rest = np.broadcast_to(leaves[-1], first.shape)
        leaves.append(np.take_along_axis(rest, first, -1).reshape(-1, n, 4))
    return Tables(vectors, 0, tuple(vecs), tuple(offs), tuple(leaves), tuple(map(tuple, texts)))


def _walk(code: int, state: int, after: tuple[int, ...], before: tuple[int, ...]) -> tuple[str, int]:
    """Edits (inserts before the row included) and the state after them: at each step the first letter that stays cheapest."""
    done = ""
    while True:
        choices = [(letter, to) for letter, cost, to in _moves(code, state) if cost + after[to] == before[state]]
        if INSERT + before[NEXT[state]] == before[state] and (not choices or choices[0][0] > "I"):
            done, state = done + "I", NEXT[state]
        else:
            return done + choices[0][0], choices[0][1]


def blocks(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, length - 1) of each block of a chunk, left to right; only the last may be short."""
    full = len(codes) // BLOCK * BLOCK
    weights = CODES ** np.arange(BLOCK - 1, -1, -1)
    numbers = codes[:full].astype(np.int64).reshape(-1, BLOCK) @ weights
    rest = len(codes) - full
    if not rest:
        return numbers, np.full(len(numbers), BLOCK - 1)
    last = codes[full:].astype(np.int64) @ weights[BLOCK - rest :]
    return np.append(numbers, last), np.append(np.full(len(numbers), BLOCK - 1), rest - 1)


def effect(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a chunk does to every vector at its right end: vector at the left, offset, state left in by state entered."""
    t = tables()
    at = np.arange(len(t.vectors))
    off, leave = np.zeros(len(at), np.int64), np.tile(np.arange(4), (len(at), 1))
    for number, size in zip(*(x[::-1].tolist() for x in blocks(codes)), strict=True):
        leave = np.take_along_axis(leave, t.leave[size][number, at], 1)
        off += t.off[size][number, at]
        at = t.vec[size][number, at]
    return at, off, leave


def joined(left: tuple, right: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The effect of two chunks one after the other."""
    at, off, leave = right
    return left[0][at], left[1][at] + off, np.take_along_axis(leave, left[2][at], 1)


def edits(codes: np.ndarray, vector: int, state: int) -> tuple[list[str], int]:
    """Edits of each row of a chunk (inserts before it included) and the state after it.

    The vectors at the blocks' ends come from the tables, right to left; each block is then expanded backward to the
    vectors between its rows, along which the edits are read forward, so that ties fall to the first in ASCII order.
    """
    t = tables()
    numbers, sizes = (x.tolist() for x in blocks(codes))
    right = [vector]
    for number, size in zip(reversed(numbers), reversed(sizes), strict=True):
        right.append(int(t.vec[size][number, right[-1]]))
    out, single, row = [], t.vec[0], 0
    for size, end in zip(sizes, reversed(right[:-1]), strict=True):
        inside = codes[row : row + size + 1].tolist()
        ends = [end]
        for code in reversed(inside[1:]):
            ends.append(int(single[code, ends[-1]]))
        for code, v in zip(inside, reversed(ends), strict=True):
            out.append(t.letters[code][v][state])
            state = int(t.leave[0][code, v, state])
        row += size + 1
    return out, state


def trailing(state: int) -> int:
    """Inserts that bring a state to an end."""
    return {0: 0, 1: 2, 2: 1, 3: 0}[state]


def repaired(roles: list[str], texts: list[str], done: list[str], state: int, last: bool) -> tuple[str, list[str]]:
    """The edits as one string and the lines `role:text` that remain of a chunk entered in `state`."""
    lines, marks = [], list(done)
    for role, text, marked in zip(roles, texts, done, strict=True):
        for letter in marked:
            if letter == "I":
                state = NEXT[state]
                lines.append(f"{ROLE[state]}:")
            elif letter == "K":
                state = AFTER["sua".index(role[0])][state]
                lines.append(f"{role}:{text}")
            elif letter == "R":
                state = NEXT[state]
                lines.append(f"{ROLE[state]}:{text}")
    for _ in range(trailing(state) if last else 0):
        state = NEXT[state]
        marks.append("I")
        lines.append(f"{ROLE[state]}:")
    return "".join(marks), lines


def _text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and at (long) of the rows after the contract's damage by crc32(`conv_id:turn`) % 20.

    0 drops a row, 1 empties its text, 2 takes [.!?] out of it, 3 repeats it, 4 makes it a user's. A null is one space
    there, in role and text as well.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    action = F.crc32(key) % 20
    rows = conversations.select(
        F.col("conv_id"), F.col("turn"), _text("role").alias("role"), _text("text").alias("text"), action.alias("action"),
        F.monotonically_increasing_id().alias("at"),
    ).where("action <> 0")
    role = F.when(F.col("action") == 4, "user").otherwise(F.col("role"))
    text = F.when(F.col("action") == 1, "").when(F.col("action") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("action") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (2 * F.col("at")).alias("at"), F.explode(times).alias("copy")).select(
        "conv_id", "turn", "role", "text", (F.col("at") + F.col("copy")).alias("at")
    )


def coded(rows: DataFrame) -> DataFrame:
    """`rows` (conv_id, turn, role, text, at) in the order of their conversations, with code: role initial and fault.

    A row is blank, else a duplicate if an earlier one has its role and text, else truncated. First rows are found by a
    grouping that is combined before its shuffle; only rows that occur twice meet them again.
    """
    name = [F.xxhash64("role", "text").alias("h1"), F.xxhash64("text", F.lit(1), "role").alias("h2")]
    rows = rows.select("*", *name)
    place = F.struct(F.col("turn").isNotNull().alias("has"), "turn", "at")
    firsts = rows.groupBy("conv_id", "h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = firsts.select(F.col("conv_id").alias("of"), F.col("h1").alias("f1"), F.col("h2").alias("f2"), F.col("first.at").alias("first"))
    met = rows.join(firsts, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")), "left")
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    fault = (
        F.when(~F.col("text").rlike(BLANK), 0)
        .when(F.col("first").isNotNull() & (F.col("at") != F.col("first")), 1)
        .when(~F.col("text").rlike(ENDED), 2)
        .otherwise(3)
    )
    return met.select("conv_id", "turn", "role", "text", "h1", "at", (role * 4 + fault).cast("byte").alias("code"))


def chunked(rows: DataFrame) -> DataFrame:
    """conv_id, part, no, codes, roles and texts: consecutive rows of a conversation, 4,096 at most.

    Rows are range-partitioned and sorted by conversation, turn (nulls first), role, a hash of the text and row
    number, so that a conversation that holds a third of all rows lies in many partitions.
    """
    order = ["conv_id", "turn", "role", "h1", "at"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "code", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                piece = batch.slice(start, CHUNK)
                ids = piece.column(0).to_pylist()
                cuts = [0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1]), len(ids)]
                ends = pa.array(cuts, pa.int32())
                codes = piece.column(1).to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[a] for a in cuts[:-1]], piece.column(0).type),
                        pa.array([part] * (len(cuts) - 1), pa.int32()),
                        pa.array(range(no, no + len(cuts) - 1), pa.int64()),
                        pa.array([codes[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
                        *(pa.ListArray.from_arrays(ends, pa.array(piece.column(i).to_pylist(), pa.string())) for i in (2, 3)),
                    ],
                    names=["conv_id", "part", "no", "codes", "roles", "texts"],
                )
                no += len(cuts) - 1

    kind = rows.schema["conv_id"].dataType.simpleString()
    return ranged.mapInArrow(run, f"conv_id {kind}, part int, no long, codes binary, roles array<string>, texts array<string>")


def _split(codes: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the tables, role initials and faults (0 blank, 1 duplicate, 2 truncated, 3 none) of a chunk."""
    raw = np.frombuffer(codes, np.uint8)
    roles, faults = raw // 4, raw % 4
    return roles * 3 + np.array([GONE, GONE, CUT, PLAIN], np.uint8)[faults], roles, faults


#: Role initials that may stand one after the other.
LEGAL = np.zeros((4, 4), bool)
LEGAL[0, 1] = LEGAL[1, 2] = LEGAL[2, 1] = True
FIGURES = ("blank", "duplicate", "truncated", "illegal")
SUMMARY = ", ".join(f"{c} long" for c in FIGURES) + ", head byte, tail byte, effect binary"


def _packed(e: tuple) -> bytes:
    return e[0].astype(np.uint8).tobytes() + e[2].astype(np.uint8).tobytes() + e[1].astype(np.int64).tobytes()


def _unpacked(raw: bytes) -> tuple:
    n = len(tables().vectors)
    at, leave = np.frombuffer(raw, np.uint8, n), np.frombuffer(raw, np.uint8, 4 * n, n)
    return at.astype(np.int64), np.frombuffer(raw, np.int64, n, 5 * n), leave.reshape(-1, 4).astype(np.int64)


def _summed(members: list[dict]) -> dict:
    """Summary of chunks one after the other."""
    out = dict(members[0])
    whole = _unpacked(out["effect"])
    for m in members[1:]:
        for c in FIGURES:
            out[c] += m[c]
        out["illegal"] += int(not LEGAL[out["tail"], m["head"]])
        out["tail"] = m["tail"]
        whole = joined(whole, _unpacked(m["effect"]))
    out["effect"] = _packed(whole)
    return out


def _entered(members: list[dict], vector: int, state: int) -> Iterator[tuple[int, int]]:
    """(vector at the right end, state at the left end) of each member, the last one ending in `vector`."""
    effects = [_unpacked(m["effect"]) for m in members]
    rights = [vector]
    for e in reversed(effects[1:]):
        rights.append(int(e[0][rights[-1]]))
    for e, right in zip(effects, reversed(rights), strict=True):
        yield right, state
        state = int(e[2][right, state])


def _by_group(df: DataFrame, keys: list[str], order: list[str], work: Callable[[list[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """`work` over the rows of each group of `keys`, in order; one group at a time is in memory."""
    from pyspark.sql.types import StructType

    names = StructType.fromDDL(schema).fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, made, kinds = [], [], None

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds.get(c)) for c in names], names=names)

        for batch in batches:
            kinds = kinds or {f.name: f.type for f in batch.schema} | {"right": pa.int32(), "entry": pa.int32(), "last": pa.bool_(), "alone": pa.bool_(), "cost": pa.int64()}
            for row in batch.to_pylist():
                if members and any(members[0][k] != row[k] for k in keys):
                    made += work(members)
                    members = []
                members.append(row)
            if len(made) > 1000:
                yield batch_of(made)
                made = []
        if members:
            made += work(members)
        if made:
            yield batch_of(made)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repair conversations given as rows (conv_id, turn, role, text, at; role and text not null, at unique).

    Returns (conv_id, blank, duplicate, truncated, illegal, cost) and (conv_id, part, no, alone, audit, lines): of each chunk in
    the order of part and no, its edits and the rows that it keeps; `alone` if it is the whole conversation.

    Chunks of a conversation are summarised by what they do to every cost vector, summaries are joined first within a
    partition and then over partitions, and the vector and state at each chunk's ends are handed back the same way. So no
    task holds a conversation, however long: one row per partition of it at most meets in a group.
    """
    whole = stored(chunked(coded(rows)), "chunks", "zstd")
    kind = whole.schema["conv_id"].dataType.simpleString()

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = {c: [] for c in (*FIGURES, "head", "tail", "effect")}
            for raw in batch.column(3).to_pylist():
                codes, roles, faults = _split(raw)
                for n, c in enumerate(FIGURES[:3]):
                    made[c].append(int((faults == n).sum()))
                made["illegal"].append(int((~LEGAL[roles[:-1], roles[1:]]).sum()))
                made["head"].append(int(roles[0]))
                made["tail"].append(int(roles[-1]))
                made["effect"].append(_packed(effect(codes)))
            kinds = [pa.int64()] * 4 + [pa.int8()] * 2 + [pa.binary()]
            arrays = [pa.array(v, k) for v, k in zip(made.values(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *arrays], names=["conv_id", "part", "no", *made])

    each = whole.select("conv_id", "part", "no", "codes").mapInArrow(summarise, f"conv_id {kind}, part int, no long, {SUMMARY}")
    each = stored(each, "chunk-effects", "zstd")
    parts = stored(_by_group(each, ["conv_id", "part"], ["no"], lambda m: iter([_summed(m)]), f"conv_id {kind}, part int, {SUMMARY}"), "part-effects", "zstd")

    def over_parts(members: list[dict]) -> Iterator[dict]:
        t = tables()
        total = _summed(members)
        cost = int(_unpacked(total["effect"])[1][t.end] + t.vectors[int(_unpacked(total["effect"])[0][t.end])][START])
        for i, (right, entry) in enumerate(_entered(members, t.end, START)):
            figures = {c: total[c] if i == 0 else None for c in FIGURES} | {"cost": cost if i == 0 else None}
            yield {"conv_id": members[i]["conv_id"], "part": members[i]["part"], "right": right, "entry": entry, "last": i + 1 == len(members), "alone": len(members) == 1} | figures

    placed = _by_group(parts, ["conv_id"], ["part"], over_parts, f"conv_id {kind}, part int, right int, entry int, last boolean, alone boolean, {', '.join(f'{c} long' for c in (*FIGURES, 'cost'))}")
    placed = stored(placed, "part-ends", "zstd")
    figures = placed.where("cost is not null").select("conv_id", *FIGURES, "cost")

    ends = placed.select(F.col("conv_id").alias("of"), F.col("part").alias("of_part"), "right", "entry", "last", "alone")
    known = each.join(ends, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part"))).drop("of", "of_part")

    def within_part(members: list[dict]) -> Iterator[dict]:
        given = members[0]
        for i, (right, entry) in enumerate(_entered(members, given["right"], given["entry"])):
            last = i + 1 == len(members)
            yield {c: members[i][c] for c in ("conv_id", "part", "no")} | {"right": right, "entry": entry, "last": last and given["last"], "alone": given["alone"] and len(members) == 1}

    chunk_ends = _by_group(known, ["conv_id", "part"], ["no"], within_part, f"conv_id {kind}, part int, no long, right int, entry int, last boolean, alone boolean")
    names = [F.col(c).alias(f"of_{c}") if c in ("part", "no") else F.col(c) for c in ("part", "no", "right", "entry", "last", "alone")]
    ready = whole.join(chunk_ends.select(*names), (F.col("part") == F.col("of_part")) & (F.col("no") == F.col("of_no")))

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            audits, kept = [], []
            for raw, roles, texts, right, entry, last in zip(*(batch.column(i).to_pylist() for i in range(3, 9)), strict=True):
                done, _ = edits(_split(raw)[0], right, entry)
                audit, lines = repaired(roles, texts, done, entry, last)
                audits.append(audit)
                kept.append(lines)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], batch.column(9), pa.array(audits, pa.string()), pa.array(kept, pa.list_(pa.string()))],
                names=["conv_id", "part", "no", "alone", "audit", "lines"],
            )

    columns = ("conv_id", "part", "no", "codes", "roles", "texts", "right", "entry", "last", "alone")
    pieces = ready.select(*columns).mapInArrow(trace, f"conv_id {kind}, part int, no long, alone boolean, audit string, lines array<string>")
    return figures, stored(pieces, "repaired", "zstd")


def digests(pieces: DataFrame) -> DataFrame:
    """conv_id, audit and repaired_sha256 of the pieces that `repair` returns.

    A conversation of one chunk is hashed where it is. The chunks of longer ones are sorted and hashed one after the other:
    the hash of a text needs its bytes in order, so this pass, and the one row with all edits, is one task for one conversation.
    """
    kind = pieces.schema["conv_id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, audit, digest, first = None, [], None, True

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now[0]], ids), pa.array(["".join(audit)]), pa.array([digest.hexdigest()])], names=["conv_id", "audit", "repaired_sha256"])

        for batch in batches:
            ids = batch.column(0).type
            for conv, marks, lines in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2)), strict=True):
                if now != (conv,):
                    if now:
                        yield row()
                    now, audit, digest, first = (conv,), [], hashlib.sha256(), True
                audit.append(marks)
                if lines:
                    digest.update(("" if first else "\n").encode() + "\n".join(lines).encode("utf-8", "surrogatepass"))
                    first = False
        if now:
            yield row()

    one = pieces.where("alone").select("conv_id", "audit", F.sha2(F.array_join("lines", "\n"), 256).alias("repaired_sha256"))
    many = pieces.where("not alone").repartition("conv_id").sortWithinPartitions("conv_id", "part", "no")
    return one.unionByName(many.select("conv_id", "audit", "lines").mapInArrow(hashed, f"conv_id {kind}, audit string, repaired_sha256 string"))


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """Every conv_id of `conversations` (conv_id, turn, role, text) after the contract's damage, and its cheapest repair.

    Columns: gaps, blank, duplicate, truncated, illegal, cost (longs), audit and repaired_sha256. Rows without a conv_id are one
    conversation. Rows with equal turns are ordered by role, a hash of the text and their place, so rows that repeat
    stand together. A role is known by its initial (s, u, a); an empty or other role can only be changed or
    deleted. A conversation without rows after the damage has zeros, no edits and the hash of the empty text.
    Other columns are not read. An empty table gives no rows.
    """
    conversations = conversations.select("conv_id", "turn", "role", "text")
    rows = stored(damaged(conversations), "damaged", "zstd")
    figures, pieces = repair(rows)
    kept = rows.groupBy(F.col("conv_id").alias("of")).agg(F.max("turn").alias("high"), F.min("turn").alias("low"), F.count_distinct("turn").alias("turns"))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long").alias("gaps")
    found = figures.join(digests(pieces).withColumnRenamed("conv_id", "by"), F.col("conv_id").eqNullSafe(F.col("by"))).drop("by").withColumnRenamed("conv_id", "named")
    every = conversations.select("conv_id").distinct()
    out = every.join(kept, F.col("conv_id").eqNullSafe(F.col("of")), "left").join(found, F.col("conv_id").eqNullSafe(F.col("named")), "left")
    longs = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (*FIGURES, "cost")]
    return out.select("conv_id", gaps, *longs, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
