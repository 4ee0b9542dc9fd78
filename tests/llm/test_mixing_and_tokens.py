import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.llm import sentencepiece_codec
from marketloom.llm.common import stored
from marketloom.llm.mixing import Mix, _offsets, _sizes, mix_sizes, mixed, permuted, repeated, shard_draws
from marketloom.llm.sentencepiece_codec import (
    BPE,
    BYTE,
    CONTROL,
    MODEL_PATH,
    NORMAL,
    UNIGRAM,
    UNKNOWN,
    Codec,
    Machine,
    decode_documents,
    encode_documents,
    machine,
)
from marketloom.llm.training_order import PAD, Layout, feistel, in_training_order, load_ranks, read_slots, token_records, write_shards

SF = "/root/testdata/sf0.001"


def filled(sizes, limit=3):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    target, open_, left = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        share = {s: target[s] + left * weight[s] / total for s in open_}
        left = sum(max(0.0, share[s] - limit * sizes[s]) for s in open_)
        target |= {s: min(share[s], limit * sizes[s]) for s in open_}
        open_ = {s for s in open_ if target[s] < limit * sizes[s]}
    return target


@pytest.mark.parametrize("odd", [False, True])
def test_mix(spark, odd_docs, odd):
    docs = odd_docs if odd else spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixed(docs).join(docs.select("doc_id", "source", "text").dropDuplicates(["doc_id"]), "doc_id").collect()
    whole, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) and 0 <= r["taken"] <= 3 * r["size"]
        whole[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    for r in rows if not odd else []:
        assert r["source_size"] == whole[r["source"]]
        assert r["target"] == pytest.approx(filled(whole)[r["source"]])
        assert abs(taken[r["source"]] - r["target"]) <= 0.05 * r["target"] + 64
    assert repeated(docs).schema == docs.schema


def test_permutation_and_shards(spark, tmp_path):
    for n in (1, 2, 5, 1000, 4097):
        assert sorted(feistel(np.arange(n), n, 3)) == list(range(n))
    layout, docs = Layout(64, 100), spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    rows = in_training_order(token_records(docs, load_ranks(), layout), layout)
    ordered = {r["slot"]: bytes(r["ids"]) for r in rows.collect()}
    assert sorted(ordered) == list(range(len(ordered))) and all(len(x) == layout.stride for x in ordered.values())
    files = write_shards(rows, f"file://{tmp_path}", layout).collect()
    assert sum(f["records"] for f in files) == len(ordered)
    assert [x.tobytes() for x in read_slots(f"file://{tmp_path}", 95, 10, layout)] == [ordered[i] for i in range(95, 105)]
    assert sum((np.frombuffer(x, np.uint16) == 50256).sum() for x in ordered.values()) == docs.count()
    assert any(PAD in np.frombuffer(x, np.uint16) for x in ordered.values())


def test_sentencepiece(spark, odd_docs):
    import sentencepiece

    codec, own = Codec.load(), sentencepiece.SentencePieceProcessor(model_file=MODEL_PATH)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd_docs.selectExpr("1000 + doc_id doc_id", "text"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    encoded = encode_documents(docs, codec)
    for r in encoded.collect():
        assert list(r["ids"]) == own.encode(texts[r["doc_id"]] or "") and r["round_trip"] and r["n_tokens"] == len(r["ids"])
    assert {r["doc_id"]: r["text"] for r in decode_documents(encoded, codec).collect()} == {i: t or "" for i, t in texts.items()}
    assert machine(codec).encode(["a" + " " * 40 + "b"])[0]


def hand_made_model(kind, remove_spaces=True, charsmap=b""):
    """A small model written out piece by piece: nothing is trained."""
    from sentencepiece import sentencepiece_model_pb2 as protobuf

    proto = protobuf.ModelProto()
    proto.trainer_spec.model_type = kind
    proto.trainer_spec.byte_fallback = True
    proto.trainer_spec.unk_id, proto.trainer_spec.bos_id, proto.trainer_spec.eos_id, proto.trainer_spec.pad_id = 0, 1, 2, -1
    proto.normalizer_spec.name = "identity"
    proto.normalizer_spec.add_dummy_prefix = True
    proto.normalizer_spec.remove_extra_whitespaces = remove_spaces
    proto.normalizer_spec.escape_whitespaces = True
    proto.normalizer_spec.precompiled_charsmap = charsmap
    add = lambda piece, score, kind: proto.pieces.add(piece=piece, score=score, type=kind)
    add("<unk>", 0, UNKNOWN)
    add("<s>", 0, CONTROL)
    add("</s>", 0, CONTROL)
    for b in range(256):
        add(f"<0x{b:02X}>", 0, BYTE)
    words = ["▁", "▁th", "▁the", "the", "he", "th", "er", "▁in", "in", "ing", "an", "and", "▁and", "on", "ion", "▁a", "re"]
    for i, piece in enumerate([*words, *"abcdefghijklmnopqrstuvwxyz.,"]):
        add(piece, -2.0 - 0.37 * i if kind == UNIGRAM else -float(i), NORMAL)
    return proto.SerializeToString()


@pytest.mark.parametrize("kind", [UNIGRAM, BPE])
@pytest.mark.parametrize("remove_spaces", [True, False])
def test_models_made_by_hand(spark, kind, remove_spaces):
    import sentencepiece

    model = hand_made_model(kind, remove_spaces)
    own = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = ["the other and the thing", "  spaced   out  in the end ", "Zo\u00eb in 2024, \u6f22\u5b57", "a", " ", "therein and\nanother", "x" * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in encode_documents(docs, Codec(model)).collect()}
    for i, text in enumerate(texts):
        assert list(rows[i]["ids"]) == own.encode(text), (kind, text)
        assert rows[i]["n_repaired"] == 0, (kind, text)


def test_the_backend_makes_the_ids_and_differences_are_repaired(monkeypatch):
    codec = Codec(hand_made_model(UNIGRAM))
    own = Machine(codec)
    text = "the thing and the end"
    right, repaired, _ = own.encode([text])
    assert repaired == [0]
    own.known.clear()
    monkeypatch.setattr(own, "reference", type("Wrong", (), {"encode": staticmethod(lambda parts, num_threads: [[5] for _ in parts])}))
    wrong, repaired, _ = own.encode([text])
    assert wrong != right and repaired == [5]
    own.known.clear()
    monkeypatch.setattr(own, "text_reference", type("Other", (), {"normalize": staticmethod(lambda t: "\u2581a")}))
    assert own.encode([text])[1] == [2]


def test_a_full_cache_keeps_the_parts_at_hand(monkeypatch):
    """Parts that two batches share are encoded once, ids and counts of repaired parts stay the same."""
    own, given = Machine(Codec(hand_made_model(UNIGRAM))), []
    texts = [["the thing and"], ["the thing end"], ["the other end"]]
    expected = [Machine(own_codec).encode(t) for t in texts for own_codec in [Codec(hand_made_model(UNIGRAM))]]
    wrong = own.reference.encode("\u2581thing")
    real = own.reference.encode

    def encode(parts, num_threads):
        given.extend(parts)
        return [[*wrong, 5] if p == "\u2581and" else ids for p, ids in zip(parts, real(parts, num_threads=num_threads), strict=True)]

    monkeypatch.setattr(own, "reference", type("Seen", (), {"encode": staticmethod(encode)}))
    monkeypatch.setattr(sentencepiece_codec, "CACHE", 3)
    out = [own.encode(t) for t in texts]
    assert sorted(given) == sorted(set(given)) and len(given) == 5
    assert [o[1] for o in out] == [[1], [0], [0]] and out[1:] == expected[1:]
    assert set(own.known) == {"\u2581the", "\u2581end", "\u2581other"} and not own.repaired


def test_tokens_of_empty_tables_and_clashing_columns(spark, odd_docs, no_docs):
    codec = Codec.load()
    rows = encode_documents(odd_docs.withColumn("ids", F.lit("x")).withColumn("n_tokens", F.lit(1.5)), codec).collect()
    assert len(rows) == odd_docs.count() and all(r["round_trip"] for r in rows)
    assert encode_documents(no_docs, codec).collect() == [] and mixed(no_docs).collect() == []


@pytest.mark.parametrize("odd", [False, True])
def test_taken_words_against_a_walk_over_the_blocks(spark, odd_docs, odd):
    """Every word of a row is taken as often as its block, and no block once more before all are taken as often."""
    docs = odd_docs if odd else spark.read.parquet(f"{SF}/documents.parquet")
    mix = Mix(block=16, slots=64, part=10)
    sizes = stored(_sizes(docs, ["doc_id"]), "test-sizes").select("row", F.col("doc_id").alias("key"), "source", "size")
    goals, taken = mix_sizes(sizes, mix)
    goals = {r["source"]: r for r in goals.collect()}
    draws = defaultdict(dict)
    for r in shard_draws(spark.createDataFrame(list(goals.values()), "source string, source_size long, target double"), mix).collect():
        draws[r["shard"]][r["source"]] = r["count"]
    total = sum(g["target"] for g in goals.values()) / mix.block
    assert sorted(draws) == list(range(-(-int(np.ceil(total)) // mix.slots)))
    for shard, counts in draws.items():
        size = min(mix.slots, int(np.ceil(total)) - shard * mix.slots)
        assert sum(counts.values()) == size
        assert all(n >= int(size * goals[s]["target"] / mix.block / total) for s, n in counts.items())
    if not odd:
        whole = filled({s: g["source_size"] for s, g in goals.items()})
        assert all(goals[s]["target"] == pytest.approx(t) for s, t in whole.items())
    starts = {r["row"]: r for r in _offsets(sizes, mix).collect()}
    got = {r["row"]: r["taken"] for r in taken.collect()}
    for source, goal in goals.items():
        n = -(-goal["source_size"] // mix.block)
        slots = min(sum(c.get(source, 0) for c in draws.values()), n * mix.repeats)
        mine = sorted((r for r in starts.values() if r["source"] == source and r["size"]), key=lambda r: r["start"])
        assert [r["start"] for r in mine] == [sum(x["size"] for x in mine[:i]) for i in range(len(mine))]
        times = {}
        for k in range(slots):  # pass k // n sends slot k to a block; which one is the permutation's choice
            times[k // n] = times.get(k // n, 0) + 1
        low, high = slots // n if n else 0, -(-slots // n) if n else 0
        for r in mine:
            assert low * r["size"] <= got.get(r["row"], 0) <= high * r["size"]
        words = sum(got.get(r["row"], 0) for r in mine)
        assert abs(words - slots * mix.block) <= mix.block * mix.repeats and abs(words - goal["target"]) <= mix.block * (2 + len(draws))


def test_block_counts_by_word(spark):
    """With one word in a block, a row's taken words are the drawn slots of its own words, counted one by one."""
    mix = Mix(block=1, slots=50, rounds=6)
    docs = spark.createDataFrame([(i, "w " * (i % 5), f"s{i % 3}") for i in range(60)], "doc_id long, text string, source string")
    sizes = stored(_sizes(docs, ["doc_id"]), "test-sizes").select("row", F.col("doc_id").alias("key"), "source", "size")
    goals, taken = mix_sizes(sizes, mix)
    n = {r["source"]: r["source_size"] for r in goals.collect()}
    drawn = shard_draws(goals, mix).groupBy("source").agg(F.sum("count").alias("slots")).collect()
    times = defaultdict(int)
    for r in drawn:
        slots = spark.range(min(r["slots"], 3 * n[r["source"]])).selectExpr("id k", f"'{r['source']}' source", f"{n[r['source']]}L n")
        epoch = F.floor(F.col("k") / F.col("n"))
        index = permuted(F.col("k") % F.col("n"), F.col("n"), F.struct("source", epoch.alias("e")), mix.rounds, mix.seed)
        for x in slots.select(index.alias("word")).collect():
            times[r["source"], x["word"]] += 1
    want = {r["row"]: sum(times[r["source"], r["start"] + i] for i in range(r["size"])) for r in _offsets(sizes, mix).collect()}
    got = {r["row"]: r["taken"] for r in taken.collect()}
    assert {row: t for row, t in want.items() if t} == {row: t for row, t in got.items() if t} and sum(want.values()) > 100


def test_twenty_thousand_sources(spark):
    sizes = spark.range(60_000).selectExpr("id row", "id key", "concat('host', id % 20000) source", "40 + id % 50 size")
    goals, taken = mix_sizes(sizes, Mix(block=16))
    rows = goals.join(sizes.join(taken, "row", "left").groupBy("source").agg(F.sum("taken").alias("words"), F.sum("size").alias("all")), "source").collect()
    assert len(rows) == 20_000 and all(r["source_size"] == r["all"] and (r["words"] or 0) <= 3 * r["all"] for r in rows)
    total = sum(r["words"] or 0 for r in rows)
    assert abs(total - sum(r["target"] for r in rows)) < 0.05 * total  # the last block of each source is part empty
