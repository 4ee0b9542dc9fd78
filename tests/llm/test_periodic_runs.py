import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from marketloom.llm import periodic_runs as pr
from marketloom.llm.queries import op13_periodic_runs


def brute_words(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is not None and words and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g, n = zlib.crc32(str(doc_id).encode()) // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def brute_runs(words):
    """Every period in turn: stretches whose words equal the one a period later; the smallest period of a stretch counts."""
    seen = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words])
    found = {}
    for q in range(1, len(ids) // 3 + 1):
        equal = np.concatenate([[False], ids[q:] == ids[:-q], [False]])
        for a, b in np.nonzero(equal[1:] != equal[:-1])[0].reshape(-1, 2).tolist():
            if b - a + q >= max(24, 3 * q):
                found.setdefault((a, b - a + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def brute(doc_id, text):
    words = brute_words(doc_id, text)
    runs = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest()
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def by_tiles(words):
    """The runs of one text from its tiles, stitched here."""
    parts, out = {}, []
    for tile in pr.tiles(pr._numbers(words)):
        for q, a, b in pr.fragments(*tile):
            parts.setdefault(q, []).append((a, b))
    for q, spans in parts.items():
        whole = []
        for a, b in sorted(spans):
            if whole and a <= whole[-1][1]:
                whole[-1][1] = max(b, whole[-1][1])
            else:
                whole.append([a, b])
        out += [(a, b - a + q, q) for a, b in whole if b - a + q >= max(24, 3 * q)]
    return sorted(out)


def test_random_texts_with_nested_runs():
    draw = random.Random(1)
    for size in (1, 2, 3, 5, 40):
        for _ in range(60):
            text = []
            while len(text) < draw.choice((10, 30, 100, 500)):
                root = [draw.randrange(size) for _ in range(draw.choice((1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 33, 64)))]
                if draw.random() < 0.3:
                    root = root * draw.randrange(1, 5) + [draw.randrange(size)]
                text += root * draw.choice((1, 1, 2, 3, 4, 9)) + root[: draw.randrange(len(root))]
            words = [b"%d" % w for w in text]
            assert by_tiles(words) == sorted(brute_runs(words))


def test_borders():
    letters = [b"%d" % i for i in range(200)]
    for q in (1, 2, 7, 8, 9, 12, 15, 16, 31, 32, 33, 63, 64):
        for length in range(max(24, 3 * q) - 2, max(24, 3 * q) + 3):
            for ahead in (0, 1, 15, 16, 17, 31, 40):
                words = [b"x%d" % i for i in range(ahead)] + (letters[:q] * (length // q + 1))[:length] + [b"end"]
                assert by_tiles(words) == sorted(brute_runs(words)), (q, length, ahead)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = op13_periodic_runs(spark, "/root/testdata/sf0.001").select(*COLUMNS).collect()
    expected = {r["doc_id"]: brute(r["doc_id"], r["text"]) for r in docs}
    assert len(rows) == len(docs) and {r["doc_id"]: tuple(r) for r in rows} == expected
    assert sum(r["n_runs"] > 0 for r in rows) > 10


def test_odd_documents(spark, odd_docs, no_docs):
    rows = pr.run_digests(odd_docs).select(*COLUMNS).collect()
    key = lambda r: tuple((v is not None, v) if v is not None else (False, 0) for v in r)
    texts = [(r["doc_id"], r["text"] if len(r["text"] or "") < 9000 else None, r["text"]) for r in odd_docs.collect()]
    expected = [brute(i, t) for i, t, whole in texts if whole == t]
    long = {i for i, t, whole in texts if whole != t}
    assert sorted((tuple(r) for r in rows if r["doc_id"] not in long), key=key) == sorted(expected, key=key)
    for r in rows:
        if r["doc_id"] in long:
            assert (r["n_runs"], r["start"], r["length"], r["period"]) == (1, 0, 30000, 1)
            assert r["collapsed_sha256"] == hashlib.sha256(b"word").hexdigest()
    assert pr.run_digests(no_docs).collect() == []
    plain = {(r["doc_id"], r["collapsed"]) for r in pr.periodic_runs(odd_docs).where("size(runs) > 0").collect()}
    assert plain == {(10, "word")}
