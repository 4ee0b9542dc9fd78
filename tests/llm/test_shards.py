import zlib
from pathlib import Path

import numpy as np

from marketloom.llm.queries import op7_training_order
from marketloom.llm.training_order import (
    END,
    PAD,
    PATTERN,
    RANKS_PATH,
    Layout,
    drop_attempts,
    in_training_order,
    load_ranks,
    materialised,
    shard_rows,
    token_records,
    write_shards,
)
from marketloom.session import shared_folder

SF = "/root/testdata/sf0.001"


def test_the_query_writes_its_shards(spark):
    folder = Path(shared_folder(spark).removeprefix("file://"))
    before = set(folder.glob("shards-*/*"))
    rows = op7_training_order(spark, SF).collect()
    files = sorted(set(folder.glob("shards-*/*")) - before)
    whole = b"".join(f.read_bytes() for f in files)
    assert [r["slot"] for r in rows] == list(range(len(rows))) and rows
    assert whole == b"".join(bytes(r["ids"]) for r in rows)


def test_rows_come_from_many_shards(spark):
    layout = Layout(64, 100)
    records = token_records(spark.read.parquet(f"{SF}/documents.parquet").limit(60), load_ranks(), layout)
    want = [tuple(r) for r in in_training_order(records, layout).orderBy("slot").collect()]
    got = [tuple(r) for r in materialised(records, layout).orderBy("slot").collect()]
    assert got == want and got[-1][1] > 3 and zlib.crc32(b"".join(bytes(r[3]) for r in got))
    assert materialised(records.where("at < 0"), layout).count() == 0


def slot_of(index, size, key, rounds):
    """The permutation written out on whole numbers."""
    half = 1
    while 4**half < size:
        half += 1
    full = 2**64
    while True:
        left, right = index >> half, index % 2**half
        for r in range(rounds):
            k = zlib.crc32(f"{key}:{r}".encode()) * 2**32 + zlib.crc32(f"{r}:{key}".encode())
            z = (right + k) * 0x9E3779B97F4A7C15 % full
            z = (z ^ z >> 29) * 0xBF58476D1CE4E5B9 % full
            left, right = right, left ^ (z ^ z >> 32) % 2**half
        index = left * 2**half + right
        if index < size:
            return index


def encoded(texts):
    """Ids of the texts, each with its end, by the vocabulary's public loader of ranks and pattern."""
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    own = tiktoken.Encoding("check", pat_str=PATTERN, mergeable_ranks=load_tiktoken_bpe(RANKS_PATH), special_tokens={"<end>": END})
    return [i for t in texts for i in [*own.encode_ordinary(t or ""), END]]


def test_odd_documents_against_independent_tokens_and_slots(spark, odd_docs, no_docs, tmp_path):
    layout = Layout(64, 40, partitions=5, packed=3000)
    docs = odd_docs.coalesce(1)
    records = token_records(docs, load_ranks(), layout)
    ids = encoded([r["text"] for r in docs.collect()])
    ids += [PAD] * (-len(ids) % 64)
    want, n = {}, len(ids) // 64
    for i in range(n):
        want[slot_of(i, n, layout.key, layout.rounds)] = np.array(ids[64 * i : 64 * i + 64], np.uint16).tobytes()
    got = {r["slot"]: r for r in materialised(records, layout).collect()}
    assert sorted(got) == list(range(n)) and {s: bytes(r["ids"]) for s, r in got.items()} == want
    assert all((r["shard"], r["record"]) == divmod(s, 40) for s, r in got.items()) and n > 200
    assert materialised(token_records(no_docs, load_ranks(), layout), layout).collect() == []
    rows = in_training_order(records, layout)
    folder = f"file://{tmp_path}/again"
    first = sorted(map(tuple, write_shards(rows, folder, layout).collect()))
    Path(f"{tmp_path}/again/shard-00000001.bin").write_bytes(b"broken")
    Path(f"{tmp_path}/again/shard-00000002.bin.77").write_bytes(b"left by a lost attempt")
    assert sorted(map(tuple, write_shards(rows, folder, layout).collect())) == first
    assert drop_attempts(folder) == 1 and len(list(Path(f"{tmp_path}/again").iterdir())) == len(first)
    assert len(list(shard_rows(write_shards(rows, folder, layout).selectExpr("*", f"'{folder}' folder"), layout).collect())) == n
