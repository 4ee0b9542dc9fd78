import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from marketloom.llm import set_join, simhash
from marketloom.llm.common import BATCH_SETTING, map_text
from marketloom.llm.set_join import parities, parity_distance
from marketloom.llm.simhash import drop_duplicates, fingerprint, shingle_set, shingles

SF = "/root/testdata/sf0.01"


def brute_keep(texts):
    """Smallest id of each group tied by a Jaccard similarity of 0.8 or more over runs of five words, from {id: text}."""
    sets = {i: set(shingles(t, 5)) for i, t in texts.items()}
    label = {i: i for i in texts}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    having = {}
    for i, s in sets.items():
        for x in s or {b""}:
            having.setdefault(x, []).append(i)
    for i, s in sets.items():
        for j in {j for x in s or {b""} for j in having[x] if j < i}:
            same = len(s & sets[j])
            if 9 * same >= 4 * (len(s) + len(sets[j])):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return {root(i) for i in texts}


def test_near_copies_beyond_three_bits_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {r["doc_id"] for r in drop_duplicates(docs).collect()} == brute_keep(texts)


def test_planted_copies(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(words))]
    for i in range(1, 31):  # edits of three words each: up to 30 of 196 runs differ
        own = list(words)
        for k in range(3):
            own[(i * 7 + 60 * k) % 200] = f"x{i}-{k}"
        rows.append((i, " ".join(own)))
    passage = " ".join(f"p{i}" for i in range(40))
    rows += [(100 + i, passage + " " + " ".join(f"y{i}-{k}" for k in range(20))) for i in range(30)]
    assert sum(bin((fingerprint(rows[0][1]) ^ fingerprint(t)) & (1 << 64) - 1).count("1") > 3 for _, t in rows[1:31]) > 10
    kept = {r["doc_id"] for r in drop_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == brute_keep(dict(rows)) == {0, *range(100, 130)}


def test_shared_and_missing_ids_lose_no_text(spark):
    own = [" ".join(f"{name}{i}" for i in range(30)) for name in "abcde"]
    rows = [(1, own[0], "x"), (1, own[1], "x"), (1, own[1], "y"), (2, own[0], "x"), (None, own[1], "x"), (None, own[2], "x"), (None, own[2] + " z", "x"), (3, own[3], "x"), (3, own[3], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = drop_duplicates(docs).collect()
    assert sorted(r["text"].split()[0] for r in kept) == ["a0", "b0", "c0", "d0"]
    assert sorted((r["doc_id"] for r in kept), key=str) == [1, 1, 3, None]
    assert set(kept) == set(drop_duplicates(docs.repartition(5)).collect())


def test_parities_never_turn_similar_sets_away():
    draw = np.random.default_rng(1)
    for _ in range(300):
        n = int(draw.integers(1, 600))
        a = np.unique(draw.integers(0, 1 << 62, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: int(len(a) * draw.random())], draw.integers(0, 1 << 62, int(draw.integers(0, 150))).astype(np.uint64)]))
        alone = len(np.setxor1d(a, b))
        assert parity_distance(parities(a), parities(b)) <= alone
    assert parity_distance(parities(a), parities(a)) == 0


def test_many_texts_around_one_passage_without_filters(spark, monkeypatch):
    monkeypatch.setattr(set_join, "FILTER_BITS", 1)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"a{i} b{i} {passage} " + " ".join(f"e{i % 7}x{k}" for k in range(i % 25))) for i in range(300)]
    kept = {r["doc_id"] for r in drop_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == brute_keep(dict(rows))


def test_texts_around_one_passage_are_not_all_paired(spark):
    """Two of these share 0.67 of their runs: none may meet, although each two have most keys in common."""
    passage = " ".join(f"p{i}" for i in range(104))
    rows = [(i, " ".join(f"u{i}x{k}" for k in range(25)) + " " + passage) for i in range(50)]
    own = spark.createDataFrame(rows, "id long, text string").selectExpr("id", "xxhash64(id) as hash", "text")
    common = np.unique(np.concatenate([shingle_set(t, 5) for _, t in rows]))
    times = np.array([50 if x in shingle_set(passage, 5) else 1 for x in common])
    labelled = set_join._keyed(keyed_sets(spark, own, common, times), None).withColumn("label", F.col("node"))
    assert labelled.groupBy("key").count().where("count = 50").count() > 0
    assert set_join._met(labelled).count() == 0


def test_a_pair_is_met_once_for_a_stretch_of_common_keys(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(words)), (1, " ".join([*words[:199], "other"]))]
    own = spark.createDataFrame(rows, "id long, text string").selectExpr("id", "xxhash64(id) as hash", "text")
    none = np.zeros(0, np.uint64)
    labelled = set_join._keyed(keyed_sets(spark, own, none, none), None).withColumn("label", F.col("node"))
    assert labelled.groupBy("key").count().where("count = 2").count() > 30
    assert 1 <= set_join._met(labelled).count() <= 2


def keyed_sets(spark, own, common, times):
    """node, n and keys of the texts of `own` under the order given."""
    sets = {r["id"]: shingle_set(r["text"], 5) for r in own.collect()}
    rows = [(set_join.node_of(s), len(s), set_join._prefix(s, common, times).tolist()) for s in sets.values()]
    return spark.createDataFrame(rows, "node long, n int, keys array<long>")


def test_random_edits_against_brute_force(spark):
    """Families of copies with ever more edits, cuts and additions, around the similarity of 0.8 on both sides."""
    draw, rows = np.random.default_rng(5), []
    for family in range(12):
        base = [f"f{family}x{k}" for k in range(int(draw.integers(6, 160)))]
        for _ in range(14):
            own = [w if draw.random() > draw.choice([0, 0.01, 0.03]) else f"e{draw.integers(1 << 40)}" for w in base]
            own = own[int(draw.integers(0, 1 + len(own) // 9)) :] + [f"a{draw.integers(1 << 40)}" for _ in range(int(draw.integers(0, 1 + len(own) // 9)))]
            rows.append((len(rows), " ".join(own)))
    kept = {r["doc_id"] for r in drop_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == brute_keep(dict(rows)) and 12 < len(kept) < len(rows)


def test_golay_keys_propose_pairs_and_tie_them(spark, monkeypatch):
    """Copies within three bits are proposed by their fingerprints, and tied even if no key of the set join brings them together."""
    rows = []
    for i in range(20):
        words = [f"w{i}x{k}" for k in range(400)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words, "end"]))]
    own = spark.createDataFrame(rows, "doc_id long, text string")
    prints = {i: simhash.fingerprint(t, 5) for i, t in rows}
    near = {i for i in range(20) if ((prints[2 * i] ^ prints[2 * i + 1]) & (1 << 64) - 1).bit_count() <= 3}
    assert len(near) > 10
    node = {i: set_join.node_of(shingle_set(t, 5)) for i, t in rows}
    sets = spark.createDataFrame([(node[i], prints[i]) for i in node], "node long, fp long")
    assert {frozenset((r["a"], r["b"])) for r in simhash.fuzzy_pairs(sets).collect()} == {frozenset((node[2 * i], node[2 * i + 1])) for i in near}
    monkeypatch.setattr(set_join, "MAY_MATCH", "false")
    assert {r["doc_id"] for r in drop_duplicates(own).collect()} == {i for i, _ in rows if i % 2 == 0 or i // 2 not in near}


def test_hubs_tie_copies_to_the_text_they_were_made_from(spark):
    """Each two of 40 copies share less than 0.8 of their runs, each shares more with the first text, whose name is not the smallest."""
    words = [f"w{i}" for i in range(204)]
    rows = [(0, " ".join(words))] + [(i, " ".join([*words, *(f"e{i}x{k}" for k in range(24))])) for i in range(1, 41)]
    own = spark.createDataFrame(rows, "id long, text string").selectExpr("id", "xxhash64(id) as hash", "text")
    common = shingle_set(rows[0][1], 5)
    hits = set_join._keyed(keyed_sets(spark, own, common, np.full(len(common), 41)), None)
    centre, *others = (set_join.node_of(shingle_set(t, 5)) for _, t in rows)
    assert centre != min([centre, *others])
    assert {(min(o, centre), max(o, centre)) for o in others} <= set(map(tuple, set_join._hub_pairs(hits).collect()))


def test_only_texts_that_may_go_move_and_once(spark, setting, monkeypatch, capsys):
    """Of 600 texts, 40 have a near or an exact copy or share a row: hardly more than these meet in a shuffle, and in one."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(60))) for i in range(600)]
    rows += [(1000 + i, rows[i][1] + " end") for i in range(20)] + [(2000 + i, rows[100 + i][1]) for i in range(10)] + rows[200:210]
    moved, split = [], simhash.split_by

    def seen(*given):
        sure, others = split(*given)
        moved.append((sure.count(), others.count()))
        return sure, others

    monkeypatch.setattr(simhash, "split_by", seen)
    kept = drop_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sum(moved[0]) == len(rows) and 50 <= moved[0][1] < 200
    capsys.readouterr()
    kept.explain("formatted")  # before it runs, when the plan holds each step once
    steps = capsys.readouterr().out.split("\n\n")
    assert sum(") Exchange" in s and ("row#" in s or "first#" in s) for s in steps) == 1  # whole rows, or the first of each name
    assert sorted(kept.collect()) == sorted(set(rows[:600]))


def test_a_filter_of_few_bits_still_turns_rows_away_and_never_a_value_it_has(spark, monkeypatch):
    monkeypatch.setattr(set_join, "FILTER_BITS", 2048)
    held = spark.range(1500).selectExpr("xxhash64(id) as key")
    others = spark.range(10_000, 14_000).selectExpr("xxhash64(id) as key")
    words = set_join.bit_filter(held, "key")
    assert words is not None and 64 * len(words) == 2048
    assert set_join.split_by(held, "key", words)[0].count() == 0
    assert 1200 < set_join.split_by(others, "key", words)[0].count() < 2400  # 1500 values fill about 0.52 of the places
    assert set_join.bit_filter(spark.range(2049), "id") is None


def test_rows_that_differ_in_where_their_nulls_stand_are_rows_of_their_own(spark):
    """Spark's hash of a row passes over nulls: such rows of one id were taken for one, and a text without a copy went."""
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, None, text), (1, text, None), (2, "other " + text[::-1], None), (None, None, "x"), (None, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = sorted(map(tuple, drop_duplicates(docs).collect()), key=str)
    assert kept == sorted([(1, None, text), (1, text, None), (2, rows[2][1], None), (None, "x", None)], key=str)


def test_workers_get_small_batches_unless_the_session_says_otherwise(spark, setting):
    def sizes():
        count = lambda batch: pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])
        return {r.n for r in map_text(spark.range(5000, numPartitions=1), count, "n long", rows_at_once=10_000).collect()}

    setting(BATCH_SETTING, "3000")
    assert sizes() == {3000, 2000}
    spark.conf.unset(BATCH_SETTING)
    assert sizes() == {2048, 904}
