"""Secret scans over a blob ledger: every version is scanned once per rule version, findings go to all its paths."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import map_text, stored
from marketloom.llm.set_join import bit_filter, split_by


@dataclass(frozen=True)
class Rule:
    """`pattern` finds spans; with `group`, only matches whose group has `least` characters count."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False


BASE_RULES = (
    Rule(
        "assign",
        r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=6,
        any_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)
#: Spans besides the base ones: heads of private keys and signed web tokens.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES
LEDGER = "blob string, rule_version string, spans array<struct<kind:string,start:long,end:long>>"
_WORDS_OF_ASSIGN = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")


def rule_version(rules: tuple[Rule, ...] = RULES) -> str:
    """Changes with any rule, so that a changed set of rules scans every blob anew."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def _compiled(rule: Rule) -> re.Pattern:
    return re.compile(rule.pattern, re.ASCII | (re.IGNORECASE if rule.any_case else 0))


#: Runs shorter than the least length can never count, so these two are searched in one step.
_QUICK = {"access": re.compile(r"AKIA[A-Z0-9]{16,}"), "hex": re.compile(r"[0-9a-f]{24,}")}


def find_secrets(text: str | None, rules: tuple[Rule, ...] = RULES) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, end exclusive, by start and then by order of `rules`.

    Matches of a rule are leftmost and do not overlap; those that are too short are dropped afterwards.
    Rules do not hide each other. Null is empty.
    """
    if not text:
        return []
    lowered = text.encode("utf-8", "surrogatepass").lower()
    found = []
    for order, rule in enumerate(rules):
        if rule in BASE_RULES:
            if rule.kind == "assign" and not any(w in lowered for w in _WORDS_OF_ASSIGN):
                continue
            if rule.kind in _QUICK:
                found += [(m.start(), order, m.end(), rule.kind) for m in _QUICK[rule.kind].finditer(text)]
                continue
        for m in _compiled(rule).finditer(text):
            if len(m.group(rule.group)) >= rule.least:
                found.append((m.start(), order, m.end(), rule.kind))
    return [(start, end, kind) for start, _, end, kind in sorted(found)]


def address(column: str = "text") -> Column:
    """Content address of a version; null has the address of the empty text."""
    return F.sha2(F.coalesce(F.col(column), F.lit("")), 256)


def unseen_blobs(versions: DataFrame, ledger: DataFrame | None, version: str) -> DataFrame:
    """blob and text of each different text without an entry for this rule version.

    Copies are dropped before the shuffle and again after it, so a text that a third of all paths hold
    crosses the network once per task. Texts move only if the ledger leaves anything to scan.
    """
    blobs = versions.select(address().alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    if ledger is not None:
        blobs = blobs.join(ledger.where(F.col("rule_version") == version).select("blob"), "blob", "left_anti")
    return blobs.dropDuplicates(["blob"])


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows (blob, rule_version, spans) of `blobs`."""
    version = rule_version(rules)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [
            [{"kind": k, "start": s, "end": e} for s, e, k in find_secrets(t, rules)] for t in batch.column(1).to_pylist()
        ]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([version] * batch.num_rows, pa.string()), pa.array(spans, kind)],
            names=["blob", "rule_version", "spans"],
        )

    return map_text(blobs.select("blob", "text"), work, LEDGER)


def scan_versions(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """(new ledger rows, whole ledger) after scanning what `versions` (text) adds.

    `versions` holds every version of every path, historical ones included. Append the first result to
    where the ledger is kept; the next call with it scans only blobs and rule versions not seen before.
    A run that fails leaves the old ledger as it was.
    """
    new = stored(scan(unseen_blobs(versions, ledger, rule_version(rules)), rules), "ledger")
    return new, (new if ledger is None else ledger.unionByName(new))


def findings(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`paths` (with a column blob) and spans, null without an entry; adaptive execution splits a hot blob."""
    own = ledger.where(F.col("rule_version") == rule_version(rules)).select(F.col("blob").alias("known"), "spans")
    return paths.join(own, F.col("blob") == F.col("known"), "left").drop("known")


def _joined(spans: str, kinds: list[str] | None) -> Column:
    chosen = F.col(spans) if kinds is None else F.filter(spans, lambda x: x["kind"].isin(kinds))
    return F.array_join(
        F.transform(chosen, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")


def document_secrets(docs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 and all spans for every row of `docs`.

    Null and empty texts have no span (base_sha256 is that of the empty string); repeated rows and
    copies share one scan and each get their row; other columns are not read.
    """
    _, known = scan_versions(docs, ledger)
    paths = docs.select("doc_id", address().alias("blob"))
    kinds = [r.kind for r in BASE_RULES]
    counted = [_count(k).alias(f"n_{k}") for k in kinds]
    return findings(paths, known).select(
        "doc_id",
        *counted,
        F.sha2(_joined("spans", kinds), 256).alias("base_sha256"),
        _joined("spans", None).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with every span of `text` replaced by <KIND> and n_chars counted anew; all other rows unchanged.

    Only documents with a span, and by chance a few others, are joined to the ledger: a filter of the addresses with a span
    passes them, so that texts without one do not move for it. Overlapping spans become one replacement,
    named by the first. All columns stay. Null texts and texts without a span stay as they are, null ones null; repeated
    rows are changed alike, however many; an empty table stays so.
    """
    _, ledger = scan_versions(docs)
    hits = stored(ledger.where(F.size("spans") > 0), "hits")
    columns = docs.columns
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([f"c{i} {kinds[c]}" for i, c in enumerate(columns)])
    words = bit_filter(hits.select(F.xxhash64("blob").alias("place")), "place")
    named = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)), address().alias("blob"))
    clean, others = split_by(named.withColumn("place", F.xxhash64("blob")), "place", words)
    marked = findings(others, hits).drop("blob", "place")
    at, chars = columns.index("text"), columns.index("n_chars") if "n_chars" in columns else None

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = list(batch.columns[:-1])
        spans = batch.column(batch.num_columns - 1)
        if spans.null_count < len(spans):
            texts = [replace_spans(t, s) for t, s in zip(out[at].to_pylist(), spans.to_pylist(), strict=True)]
            counts = [n if s is None else len(t) for n, t, s in zip(out[chars].to_pylist(), texts, spans.to_pylist(), strict=True)] if chars is not None else []
            out[at] = pa.array(texts, out[at].type)
            if chars is not None:
                out[chars] = pa.array(counts, out[chars].type)
        return pa.RecordBatch.from_arrays(out, names=[f"c{i}" for i in range(len(columns))])

    done = map_text(marked, work, schema)
    done = done if clean is None else clean.drop("blob", "place").unionByName(done)
    return done.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(columns)))


def replace_spans(text: str | None, spans: list[dict] | None) -> str | None:
    if not text or not spans:
        return text
    out, at = [], 0
    for s in spans:
        if s["end"] <= at:
            continue
        if s["start"] >= at:
            out.append(text[at : s["start"]])
            out.append(f"<{s['kind'].upper()}>")
        at = s["end"]
    return "".join(out) + text[at:]
