import re
from collections import Counter

import pytest

from marketloom.llm.quality_rules import FIGURES, HostLimits, drop_rejected, host_rates, host_verdicts, text_figures


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_whole_texts(spark, odd_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    for r in [*docs, *odd_docs.select("text").collect()]:
        assert text_figures(r["text"]) == brute(r["text"])


@pytest.mark.parametrize("text", ["a b c d e a b c d e", "a a a a a a", "a b c d e f g a b c d e f g", "x\x1cy \x85 z", "a\n a\na \na"])
def test_borders(text):
    assert text_figures(text) == brute(text)


def test_odd_documents(spark, odd_docs, no_docs):
    rows = host_verdicts(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    texts = {r["doc_id"]: r["text"] for r in odd_docs.collect()}
    for r in rows:
        figures = brute(texts[r["doc_id"]])
        assert tuple(r[c] for c in FIGURES) == figures
        failed = figures[0] < 10 or 100 * figures[4] > 20 * figures[0]
        assert r["base_failed"] == failed and not (r["kept"] and failed)
    assert host_verdicts(no_docs).count() == 0
    kept = drop_rejected(odd_docs)
    assert kept.schema == odd_docs.schema
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in rows if r["kept"])
    assert drop_rejected(no_docs).count() == 0


def test_bad_hosts_go_and_small_hosts_are_shrunken(spark):
    good, bad = "a clean text of more than ten words for a host here %d", "too short"
    rows = [(i, good % i, f"good{i % 20}") for i in range(400)]
    rows += [(1000 + i, bad, "farm") for i in range(60)] + [(1100, good % 1, "farm")]
    rows += [(2000, bad, "tiny"), (2001, good % 2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"] for r in host_verdicts(docs).where("kept").collect()}
    assert kept == {*range(400), 2001}
    figures = docs.selectExpr("source", "if(length(text) < 10, 2, 12) n_words", "0 n_repeat_words", "0 n_symbols", "50 word_chars")
    rates = {r["host"]: r["few_words_rate"] for r in host_rates(figures, limits=HostLimits(0.5)).collect()}
    assert rates["farm"] > 0.9 and rates["tiny"] < 1 and rates["good1"] < 0.05
