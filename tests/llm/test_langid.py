import zlib

import numpy as np
import pyarrow as pa
import pytest

from marketloom.llm.langid import Training, fit, languages, predict, training_windows
from marketloom.llm.queries import op2_langid

SF = "/root/testdata/sf0.01"


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text").collect()}
    got = op2_langid(spark, SF).collect()
    assert len(got) == len(truth)
    assert all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 for r in got)
    judged = [(r["lang_pred"], truth[r["doc_id"]]["lang"]) for r in got if r["held_out"] and len(truth[r["doc_id"]]["text"] or "") > 40]
    assert np.mean([a == b for a, b in judged]) > 0.97


def test_odd_texts(spark, odd_docs):
    got = {r["doc_id"]: r for r in languages(odd_docs).collect()}
    assert len(got) == odd_docs.select("doc_id").distinct().count()
    for i in (0, 1, 2, 3, 200):
        assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
    assert got[10]["lang_pred"] in ("en", "de")
    assert got[None]["held_out"] is False


def test_nothing_to_learn_from(spark, odd_docs, no_docs):
    assert languages(no_docs).count() == 0
    assert {r["lang_pred"] for r in languages(odd_docs.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()} == {"und"}


def test_labels_of_held_out_documents_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    from pyspark.sql import functions as F

    other = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, "zz").otherwise(F.col("lang")))
    a, b = (languages(d.drop("source"), Training(epochs=1)).collect() for d in (docs, other))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_windows_cover_the_whole_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    net = fit(docs, Training(epochs=2))
    rows = {r["lang"]: r["text"] for r in docs.collect()}
    a, b = rows["en"][:300], rows["de"] * 30
    long, rest = predict(pa.array([a + b, b, None, "é", "…"]), net)
    assert long[:3] == ["de", "de", "und"] and long[3] != "und" and long[4] == "und" and rest[4] == 0.0
    sliced = predict(pa.array(["x", b, a]).slice(1), net)
    assert sliced == predict(pa.array([b, a]), net)


def test_many_languages_and_too_many(spark):
    rows = [(3 * i + k, f"label {i} " + chr(97 + i % 26) * (5 + i // 26), f"l{i:03d}") for i in range(260) for k in (0, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learnt = {r["lang"] for r in docs.collect() if r["doc_id"] is not None and not held(r["doc_id"])}
    net = fit(docs, Training(epochs=1))
    assert net.names == sorted(learnt) and len(learnt) > 200
    with pytest.raises(ValueError, match="languages"):
        fit(docs, Training(languages=200))


def test_rows_that_share_an_id_or_everything(spark):
    one, other = [i for i in range(20) if not held(i)][:2]
    rows = [(one, f"one id and many texts {i}", "en") for i in range(5000)] + [(other, "the same row again", "de")] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    windows = [r["lang"] for r in training_windows(docs, Training()).collect()]
    assert windows.count("en") == 400 and windows.count("de") == 1
    assert sorted(windows) == sorted(r["lang"] for r in training_windows(docs.repartition(7), Training()).collect())


def naive_shares(net, window):
    """Softmax over one window of bytes, one place, filter and width at a time."""
    hidden = []
    for width, kernel in zip(net.widths, net.kernels, strict=True):
        for f in range(kernel.shape[2]):
            best = -np.inf
            for at in range(net.window - width + 1):
                best = max(best, sum(float(net.embedding[window[at + j]] @ kernel[j, :, f]) for j in range(width)))
            hidden.append(max(0.0, best + net.bias[len(hidden)]))
    z = np.array(hidden) @ net.head + net.head_bias
    return z - np.log(np.exp(z).sum())


def test_network_against_loops(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    net = fit(docs, Training(window=32, epochs=1, docs_per_language=20))
    texts = ["One two three.", "Über größe und straße, die länger ist als ein Fenster von zweiunddreißig Zeichen", "12 34 x", "", "777"]
    names, scores = predict(pa.array(texts), net)
    for text, name, score in zip(texts, names, scores, strict=True):
        raw, z, letters = text.encode(), 0.0, 0
        for at in range(0, len(raw), 32):
            part = raw[at : at + 32]
            n = sum(b >= 128 or chr(b).isalpha() for b in part)
            z, letters = z + n * naive_shares(net, part.ljust(32, b"\0")), letters + n
        if not letters:
            assert (name, score) == ("und", 0.0)
            continue
        share = np.exp(z / letters)
        assert name == net.names[int(share.argmax())] and abs(score - share.max() / share.sum()) < 1e-4
