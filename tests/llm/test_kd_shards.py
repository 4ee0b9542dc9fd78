import zlib
from collections import Counter, defaultdict

import numpy as np

from marketloom.llm.kd_shards import Limits, build_tree, document_shards, shards
from marketloom.llm.queries import op4_kd_shards


def check(rows, texts, most_off=1.25):
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        assert 0 <= r["shard"] < 24
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return Counter({s: sum(r["size"] for r in rows if r["shard"] == s) for s in range(24)})


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op4_kd_shards(spark, sf).collect()
    assert len(rows) == len(texts)
    sizes = check(rows, texts)
    mean = sum(sizes.values()) / 24
    assert max(sizes.values()) - mean < max(r["size"] for r in rows) and max(sizes.values()) < 1.3 * mean
    held = defaultdict(set)
    for r in rows:
        held[texts[r["doc_id"]]].add(r["shard"])
    copies = Counter(texts.values())
    assert all(len(s) == 1 or len(s) <= 1 + -(-(len(t.encode()) + 8) * copies[t] // mean) and (len(t.encode()) + 8) * copies[t] > mean for t, s in held.items())
    assert sum(len(s) == 1 and copies[t] > 1 for t, s in held.items()) > 20
    assert sorted(rows) == sorted(op4_kd_shards(spark, sf).collect())


def test_a_hot_group_of_copies_is_cut(spark):
    docs = spark.range(3000).selectExpr("id doc_id", "case when id % 3 = 0 then 'copy copy copy' else concat('text ', id) end text")
    sizes = check(document_shards(docs).collect(), {r["doc_id"]: r["text"] for r in docs.collect()})
    mean = sum(sizes.values()) / 24
    assert all(abs(s - mean) < 0.12 * mean for s in sizes.values())


def test_odd_texts(spark, odd_docs, no_docs):
    rows = document_shards(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    check(rows, {r["doc_id"]: r["text"] for r in odd_docs.collect()})
    assert document_shards(no_docs).count() == 0


def test_neighbours_share_a_leaf(spark):
    points = spark.range(1600).selectExpr("id % 40 a", "id div 40 b", "id unit", "xxhash64(id) tie", "1L weight")
    rows = shards(points, ["a", "b"], "tie", "unit", 4).collect()
    assert all(abs(n - 400) < 25 for n in Counter(r["shard"] for r in rows).values())
    boxes = defaultdict(list)
    for r in rows:
        boxes[r["shard"]].append((r["a"], r["b"]))
    for points in boxes.values():
        spread = [max(p[i] for p in points) - min(p[i] for p in points) for i in (0, 1)]
        assert max(spread) <= 22


def test_rows_without_or_with_one_id(spark):
    for unit in ("cast(null as long)", "7L"):
        docs = spark.range(3000).selectExpr(f"{unit} doc_id", "case when id % 3 = 0 then 'copy copy copy' else concat('text ', id) end text")
        rows = document_shards(docs).collect()
        slots, sizes = defaultdict(list), Counter()
        for r in rows:
            slots[r["shard"]].append(r["slot"])
            sizes[r["shard"]] += r["size"]
        mean = sum(sizes.values()) / 24
        assert len(rows) == 3000 and len(sizes) == 24 and max(sizes.values()) < 1.3 * mean
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_a_large_group_lies_in_as_few_shards_as_it_can(spark):
    docs = spark.range(6000).selectExpr("id doc_id", "case when id % 4 = 0 then 'aaaa bbbb cccc' else concat('txt ', lpad(id, 10, '0')) end text")
    rows = document_shards(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    copies = [r for r in rows if texts[r["doc_id"]] == "aaaa bbbb cccc"]
    target = sum(r["size"] for r in rows) / 24
    assert len({r["shard"] for r in copies}) <= sum(r["size"] for r in copies) / target + 2
    assert max(check(rows, texts).values()) < 1.05 * target


def brute_tree(points, leaves, first=0):
    """{point: shard} by sorting: the cut falls on the value that holds the weighted median of the widest dimension."""
    if leaves == 1 or not points:
        return dict.fromkeys(points, first)
    dims = len(points[0][0])
    spans = [max(x[d] for x, _, _ in points) - min(x[d] for x, _, _ in points) for d in range(dims)]
    dim, half = spans.index(max(spans)), leaves // 2
    goal, cut = sum(w for _, w, _ in points) * half / leaves, None
    by_value = defaultdict(int)
    for x, w, _ in points:
        by_value[x[dim]] += w
    for value, w in sorted(by_value.items()):
        if w >= goal:
            cut = value if goal <= w - goal else value + 1
            break
        goal -= w
    left, right = [p for p in points if p[0][dim] < cut], [p for p in points if p[0][dim] >= cut]
    return brute_tree(left, half, first) | brute_tree(right, leaves - half, first + half)


def test_tree_against_sorting(spark):
    draw = np.random.default_rng(9)
    for leaves, bins in ((2, 16), (7, 32), (24, 64)):
        x = draw.integers(0, 1 << 30, (2, 400))
        x[0, :100] = x[0, 0]
        weight = draw.integers(1, 50, 400)
        points = [((int(a), int(b)), int(w), i) for i, (a, b, w) in enumerate(zip(*x, weight, strict=True))]
        df = spark.createDataFrame([(*p, w) for p, w, _ in points], "x0 long, x1 long, weight long").repartition(3)
        tree = build_tree(df, 2, leaves, Limits(bins=bins, tolerance=0.0))
        got = np.array(tree.first)[tree.place(x)]
        want = brute_tree(points, leaves)
        assert [int(s) for s in got] == [want[p] for p in points]


def test_few_sums_for_many_open_nodes(spark):
    df = spark.range(4000).selectExpr("(id * 7919) % 4001 x0", "(id * 104729) % 4003 x1", "1L weight")
    tree = build_tree(df, 2, 400, Limits(rows=100))
    x = np.array([[r["x0"] for r in df.collect()], [r["x1"] for r in df.collect()]])
    sizes = Counter(np.array(tree.first)[tree.place(x)].tolist())
    assert len(sizes) == 400 and max(sizes.values()) <= 12
