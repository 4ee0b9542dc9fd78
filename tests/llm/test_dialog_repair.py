import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np

from marketloom.llm import dialog_repair as dr
from marketloom.llm.queries import op11_dialog_repair

FORM = re.compile(r"(s?(ua)+)?\Z")
WORD = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """(cost, audit, lines) of rows (initial, condition, role, text) by the best way into each state, row by row."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    def inserted(best):
        best = dict(best)
        for _ in range(4):
            for (last, (cost, audit, lines)), (role, name) in itertools.product(list(best.items()), [("u", "user:"), ("a", "assistant:")]):
                if (last, role) in step:
                    new = (cost + 2, audit + "I", (*lines, name))
                    best[role] = min(best.get(role, new), new)
        return best

    best = {"": (0, "", ())}
    for initial, condition, role, text in rows:
        made = {}

        def offer(last, new, made=made):
            made[last] = min(made.get(last, new), new)

        for last, (cost, audit, lines) in inserted(best).items():
            offer(last, (cost + 3, audit + "D", lines))
            if condition == 2:
                continue
            if (last, initial) in step:
                offer(initial, (cost + condition, audit + "K", (*lines, f"{role}:{text}")))
            for to, name in (("u", "user"), ("a", "assistant")):
                if (last, to) in step:
                    offer(to, (cost + 2 + condition, audit + "R", (*lines, f"{name}:{text}")))
        best = made
    best = inserted(best)
    return min(best[s] for s in ("", "a") if s in best)


def brute(table):
    groups = defaultdict(list)
    for conv, turn, role, text in table:
        held = groups[conv]
        action = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if action == 1:
            text = ""
        elif action == 2:
            text = re.sub("[.!?]", "", text)
        elif action == 4:
            role = "user"
        held += [(turn, role, text)] * (action != 0) + [(turn, role, text)] * (action == 3)
    out = {}
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        turns = [r[0] for r in rows if r[0] is not None]
        seen, coded, faults = set(), [], [0, 0, 0]
        for _, role, text in rows:
            kept = "".join(WORD.findall(text))
            fault = 0 if not kept else 1 if (role, text) in seen else 2 if kept[-1] not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                faults[fault] += 1
            coded.append((role[:1], (2, 2, 1, 0)[fault], role, text))
        cost, audit, lines = cheapest(coded)
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(coded))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def found(df):
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows}


def every_audit(rows):
    """All edit strings of a few rows with their costs, written out."""
    def go(i, out, audit, cost, inserts):
        if i == len(rows) and FORM.match(out):
            yield cost, audit
        if inserts:
            for role in "ua":
                yield from go(i, out + role, audit + "I", cost + 2, inserts - 1)
        if i < len(rows):
            initial, condition = rows[i]
            yield from go(i + 1, out, audit + "D", cost + 3, inserts)
            if condition != 2:
                yield from go(i + 1, out + initial, audit + "K", cost + condition, inserts)
                for role in "ua":
                    yield from go(i + 1, out + role, audit + "R", cost + 2 + condition, inserts)

    return min(go(0, "", "", 0, 3))


def by_tables(rows):
    t = dr.tables()
    codes = np.array(["suax".index(i) * 3 + c for i, c in rows], np.uint8)
    at, off, leave = dr.effect(codes)
    done, state = dr.edits(codes, t.end, dr.START)
    assert state == leave[t.end, dr.START]
    return int(off[t.end] + t.vectors[at[t.end]][dr.START]), "".join(done) + "I" * dr.trailing(state)


def test_all_short_conversations():
    kinds = list(itertools.product("suax", (0, 1, 2)))
    for n in (1, 2):
        for rows in itertools.product(kinds, repeat=n):
            assert by_tables(rows) == every_audit(rows), rows
    draw = random.Random(5)
    for _ in range(150):
        rows = [draw.choice(kinds) for _ in range(draw.choice((3, 4)))]
        assert by_tables(rows) == every_audit(rows), rows


def test_long_conversations_and_joined_chunks():
    draw, t = random.Random(3), dr.tables()
    assert len(t.vectors) < 64 and max(map(max, t.vectors)) < 8
    for _ in range(300):
        rows = [(draw.choice("suuuaaax"), draw.choice((0, 0, 0, 1, 2))) for _ in range(draw.randrange(1, 40))]
        expected = cheapest([(i, c, i, "") for i, c in rows])
        assert by_tables(rows) == expected[:2]
        codes = np.array(["suax".index(i) * 3 + c for i, c in rows], np.uint8)
        cut = draw.randrange(len(rows) + 1)
        if 0 < cut < len(rows):
            both = dr.joined(dr.effect(codes[:cut]), dr.effect(codes[cut:]))
            assert all(np.array_equal(a, b) for a, b in zip(both, dr.effect(codes), strict=True))


def test_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect()
    table = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows]
    assert found(op11_dialog_repair(spark, "/root/testdata/sf0.01")) == brute(table)


SCHEMA = "conv_id long, turn long, role string, text string, code string, h1 int, `at` int, part string, lines int"


def test_odd_rows(spark):
    texts = [None, "", " \t", "Yes.", "No", "Why?\n\n", "a.b", "été !", "x" * 100_000 + "."]
    roles = ["user", "assistant", "system", None, "", "tool", "User", "sage"]
    table = []
    for conv in [None, *range(40)]:
        draw = random.Random(conv or -1)
        for turn in [None, *range(draw.randrange(12))]:
            table.append((conv, turn if turn is None else 3 * turn - 5, draw.choice(roles), draw.choice(texts)))
    table += [(77, None, "user", "only nulls.")]
    rows = [(*r, "x", 1, 2, "y", 3) for r in table]
    assert found(dr.repaired_conversations(spark.createDataFrame(rows, SCHEMA))) == brute(table)
    assert dr.repaired_conversations(spark.createDataFrame([], SCHEMA)).collect() == []
    twice = dr.repaired_conversations(spark.createDataFrame(rows + rows, SCHEMA)).collect()
    assert len(twice) == len({r["conv_id"] for r in twice}) and min(r["duplicate"] + r["blank"] for r in twice if r["conv_id"] == 77) >= 0


def test_one_conversation_over_many_partitions(spark, monkeypatch, setting):
    monkeypatch.setattr(dr, "CHUNK", 7)
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    draw = random.Random(8)
    table = [(1, i, draw.choice(["user", "assistant", "assistant", "system"]), draw.choice(["Yes.", "No", f"Row {i}.", f"Text {i}!"])) for i in range(3000)]
    table += [(c, i, "user", "Hello.") for c in range(2, 300) for i in range(2)]
    df = spark.createDataFrame([(*r, "x", 1, 2, "y", 3) for r in table], SCHEMA).repartition(5)
    pieces = dr.repair(dr.stored(dr.damaged(df), "test"))[1]
    assert pieces.where("conv_id = 1").select("part").distinct().count() > 1
    assert found(dr.repaired_conversations(df)) == brute(table)
