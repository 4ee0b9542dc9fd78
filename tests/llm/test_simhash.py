from collections import defaultdict
from itertools import product

import numpy as np
import xxhash

from marketloom.llm import golay
from marketloom.llm.common import components
from marketloom.llm.queries import op6_simhash
from marketloom.llm.simhash import TRIPLES, drop_duplicates, fingerprint, fingerprint_links, near_duplicates


def brute_print(text, size=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    runs = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if len(words) >= size else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    """Smallest id reachable over links of at most three bits, from {id: fingerprint}."""
    ids = sorted(prints)
    p = np.array([prints[i] for i in ids], dtype=np.uint64)
    near = np.bitwise_count(p[:, None] ^ p[None, :]) <= 3
    label = list(range(len(ids)))
    for i in range(len(ids)):
        stack = [i] if label[i] == i else []
        while stack:
            at = stack.pop()
            for j in np.nonzero(near[at])[0]:
                if label[j] > i:
                    label[j] = i
                    stack.append(j)
    return {a: ids[label[k]] for k, a in enumerate(ids)}


def test_golay_covers_every_change_of_one_bit():
    words = np.random.default_rng(1).integers(0, 1 << 23, 5000).astype(np.int32)
    near = golay.near(words)
    for b in range(23):
        assert (near == golay.nearest(words ^ (1 << b))[:, None]).any(1).all()
    assert len(np.unique(golay.nearest(np.arange(1 << 23, dtype=np.int32)))) == 4096


def test_every_spread_of_three_errors_is_covered():
    for errors in product(range(4), repeat=4):
        if sum(errors) <= 3:
            assert any(errors[z] == 0 and errors[i] <= 1 and errors[j] <= 1 for z, i, j in TRIPLES)


def test_fingerprints(spark, odd_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    for r in [*docs[:60], *odd_docs.where("length(text) < 1000 or text is null").collect()]:
        assert fingerprint(r["text"]) == np.array(brute_print(r["text"]), np.uint64).astype(np.int64)
    assert xxhash.xxh64_intdigest(b"a b c", 42) == spark.sql("select xxhash64('a b c')").first()[0] % (1 << 64)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = op6_simhash(spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r["doc_id"]: int(r["fingerprint"], 16) & (1 << 64) - 1 for r in rows} == {i: brute_print(t) for i, t in texts.items()}
    assert {r["doc_id"]: r["component_id"] for r in rows} == brute_groups({i: brute_print(t) for i, t in texts.items()})


def test_links_lose_nothing(spark):
    rng = np.random.default_rng(5)
    prints = {int(x) for x in rng.integers(-(1 << 63), (1 << 63) - 1, 300)}
    for base in list(prints)[:40]:  # chains and dense groups
        at = base
        for _ in range(12):
            for b in rng.choice(64, rng.integers(1, 5), replace=False):
                at ^= 1 << int(b) if b < 63 else -(1 << 63)
            prints.add(at)
    hub = 12345
    prints |= {hub ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (400, 2))}
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    got = {r["node"]: r["component"] for r in components(fingerprint_links(df)).collect()}
    want = brute_groups({p: p & (1 << 64) - 1 for p in prints})
    assert {p: got.get(p, p) for p in prints} == want


def test_components_of_chains_stars_and_loops(spark):
    rows = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1300)] + [(5000, 5000), (None, 3), (7001, 7000), (7000, 7001)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    want = {i: 0 for i in range(1, 201)} | {i: 1000 for i in range(1001, 1300)} | {7001: 7000}
    assert got == want


def test_odd_documents(spark, odd_docs, no_docs):
    rows = near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    found = defaultdict(set)
    for r in rows:
        found[r["doc_id"]].add((r["fingerprint"], r["component_id"]))
    assert found[0] == found[1] == found[2] == found[200] == {("0" * 16, 0)}
    assert {c for i in range(100, 140) for _, c in found[i]} == {100}
    assert found[5] == {(found[5].copy().pop()[0], 5)}
    assert near_duplicates(no_docs).count() == 0
    kept = drop_duplicates(odd_docs)
    assert kept.schema == odd_docs.schema
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda x: (x is None, x))
    assert ids == sorted({c for s in found.values() for _, c in s if c is not None}) + [None]
