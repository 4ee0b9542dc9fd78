import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from marketloom.llm import suffix_dedup as sd
from marketloom.llm.queries import op12_suffix_dedup


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, sha256) of each text, from a count of all strings."""
    raws = [(t or "").encode() for t in texts]
    counts = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if counts[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        out.append((len(r), sum(gone), sum(a == 0 and b == 1 for a, b in zip(b"\0" + gone, gone, strict=False)), hashlib.sha256(kept).hexdigest()))
    return out


def texts_with_copies(draw, n, words, shared):
    vocabulary = [f"w{i}" for i in range(words)]
    passages = [" ".join(draw.choices(vocabulary, k=draw.randrange(5, 60))) for _ in range(shared)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(draw.randrange(0, 6)):
            parts.append(draw.choice(passages) if draw.random() < 0.4 else " ".join(draw.choices(vocabulary, k=draw.randrange(1, 40))))
        out.append(draw.choice(["", " ", "é "]).join(parts))
    return out + out[:3] + [None, "", "a" * 700, "a" * 30, "ab" * 300, "\0" * 250, "\0" * 90]


COLUMNS = ("n_bytes", "n_removed", "n_spans", "sha256")


def results(df):
    return {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


@pytest.mark.parametrize(
    "how",
    [sd.Repeats(), sd.Repeats(length=40, gram=16), sd.Repeats(length=40, gram=16, group=300, widths=(8, 1)), sd.Repeats(length=40, gram=16, filter_bits=1, batch=500)],
)
def test_planted_passages(spark, how):
    draw = random.Random(4)
    texts = texts_with_copies(draw, 60, 300, 6)
    line = "every text holds this line, word for word, and it is longer than any window of this test " * 3
    texts += [f"{draw.random()} {line}{draw.random()}" for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert results(sd.without_repeats(docs, how)) == dict(enumerate(brute(texts, how.length)))


def test_suffix_order_and_prefixes():
    draw = random.Random(2)
    for letters in ("ab", "abcd", "\0a\xff"):
        for _ in range(40):
            parts = [bytes(ord(draw.choice(letters)) for _ in range(draw.randrange(1, 50))) for _ in range(draw.randrange(1, 8))]
            raw = b"".join(p + b"\0" for p in parts)
            ends = np.cumsum([len(p) + 1 for p in parts]) - 1
            order, s = sd.suffix_order(raw, ends, 1000)
            assert sorted(order.tolist()) == list(range(len(raw)))
            owner = np.searchsorted(ends, np.arange(len(raw)))
            tail = [raw[i : ends[owner[i]]] for i in range(len(raw))]
            assert [tail[i] for i in order] == sorted(tail)
            shared = sd.common_prefixes(order, s, ends)
            for a, b in zip(order[:-1], order[1:], strict=True):
                same = 0
                while same < min(len(tail[a]), len(tail[b])) and tail[a][same] == tail[b][same]:
                    same += 1
                assert shared[b] == same


def test_equal_strings_have_equal_anchors():
    draw = random.Random(6)
    how, where = sd.Repeats(length=40, gram=16), defaultdict(set)
    common = bytes(draw.choice(b"abc ") for _ in range(120))
    for _ in range(20):
        raw = bytes(draw.choice(b"abcdefg ") for _ in range(draw.randrange(0, 99))) + common
        for key, place, first, n in zip(*(x.tolist() for x in sd.segments(raw, how)), strict=True):
            for start in range(first, first + n):
                where[raw[start : start + how.length]].add((key, place - start))
        assert sum(sd.segments(raw, how)[3]) == max(0, len(raw) - how.length + 1)
    assert max(map(len, where.values())) == 1


def test_odd_documents(spark, odd_docs, no_docs, monkeypatch):
    rows = odd_docs.collect()
    expected = Counter((r["doc_id"], *b) for r, b in zip(rows, brute([r["text"] for r in rows], 40), strict=True))
    monkeypatch.setattr(sd, "STRIDE", 1000)  # long texts over many blocks
    got = sd.without_repeats(odd_docs, sd.Repeats(length=40, gram=16)).collect()
    assert Counter((r["doc_id"], *(r[c] for c in COLUMNS)) for r in got) == expected
    for r in got:
        assert (r["kept"] is None) == (r["n_removed"] == 0) and sum(r["spans"][1::2]) - sum(r["spans"][::2]) == r["n_removed"]
    assert sd.without_repeats(no_docs).collect() == []


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    expected = {r["doc_id"]: b for r, b in zip(docs, brute([r["text"] for r in docs], 200), strict=True)}
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in op12_suffix_dedup(spark, sf).collect()}
    assert got == expected and any(b[1] for b in expected.values())
