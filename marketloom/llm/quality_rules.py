"""Host-level quality rules: figures per text, failures per host, shrunken rates, verdicts back to documents."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import map_text, stored

WINDOW = 5
_SYMBOLS = b"#*$%&|<>"
_BLANKS = b"\x20\t\n\x0b\x0c\r"
FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class HostLimits:
    """A host is refused if the shrunken rate of a rule among its documents exceeds `max_rate`."""

    max_rate: float = 0.5
    max_strength: float = 1000.0


def text_figures(text: str | None) -> tuple[int, int, int, int, int]:
    """The five FIGURES of one whole text; a null or blank text has zeros."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return (
        len(words),
        len(text) - sum(map(raw.count, (_BLANKS[i : i + 1] for i in range(len(_BLANKS))))),
        sum(map(raw.count, (_SYMBOLS[i : i + 1] for i in range(len(_SYMBOLS))))),
        len(lines) - len(set(lines)),
        _repeat_words(words),
    )


def _repeat_words(words: list[bytes]) -> int:
    """Words lying in a window of five words that the text has twice or more."""
    windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple, int] = {}
    covered = bytearray(len(words))
    mark = b"\x01" * WINDOW
    for at, window in enumerate(windows):
        earlier = first.setdefault(window, at)
        if earlier != at:
            covered[earlier : earlier + WINDOW] = mark
            covered[at : at + WINDOW] = mark
    return sum(covered)


def document_figures(docs: DataFrame, keep: list[str]) -> DataFrame:
    """`keep` columns and the FIGURES of every whole text; no shuffle."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*(f"`k{i}` {kinds[c]}" for i, c in enumerate(keep)), *(f"{c} long" for c in FIGURES)])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [text_figures(t) for t in batch.column(0).to_pylist()]
        figures = [pa.array(x, pa.int64()) for x in (zip(*rows, strict=True) if rows else [[]] * len(FIGURES))]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[1:], *figures], names=[*(f"k{i}" for i in range(len(keep))), *FIGURES]
        )

    named = docs.select(F.col("text").alias("t"), *(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)))
    mapped = map_text(named, work, schema)
    return mapped.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), *FIGURES)


def few_words() -> Column:
    return F.col("n_words") < 10


def repetitive() -> Column:
    return 100 * F.col("n_repeat_words") > 20 * F.col("n_words")


def base_failed() -> Column:
    return few_words() | repetitive()


#: What a host is judged by: the two base rules, and texts with a symbol for every tenth character of its words.
HOST_RULES = {
    "few_words": few_words,
    "repetitive": repetitive,
    "symbols": lambda: 10 * F.col("n_symbols") > F.col("word_chars"),
}


def host_rates(figures: DataFrame, host: str = "source", limits: HostLimits = HostLimits()) -> DataFrame:
    """One row per host: n, refused and, for each rule, `<rule>_rate` shrunken by an empirical beta prior.

    Failures are summed per host (combined before the shuffle, so a hot host is no hot task). The
    prior of a rule is fitted to all hosts by moments: its mean is the pooled rate, its strength what
    the variance between hosts leaves after sampling noise. One row of sums reaches the driver.
    """
    counts = figures.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n"),
        *(F.sum(F.coalesce(rule(), F.lit(False)).cast("long")).alias(name) for name, rule in HOST_RULES.items()),
    )
    counts = stored(counts, "hosts")
    sums = [F.count("*").alias("hosts"), F.sum("n").alias("n"), F.sum(1 / F.col("n")).alias("inverse")]
    for name in HOST_RULES:
        sums += [F.sum(name).alias(name), F.sum((F.col(name) / F.col("n")) ** 2).alias(f"{name}_sq"), F.sum(F.col(name) / F.col("n")).alias(f"{name}_r")]
    total = counts.agg(*sums).first()
    rates, worst = [], F.lit(0.0)
    for name in HOST_RULES:
        mean, strength = _prior(total, name, limits)
        rate = (F.col(name) + mean * strength) / (F.col("n") + strength)
        rates.append(rate.alias(f"{name}_rate"))
        worst = F.greatest(worst, rate)
    return counts.select("host", "n", *rates, (worst > limits.max_rate).alias("refused"))


def _prior(total, rule: str, limits: HostLimits) -> tuple[float, float]:
    hosts = total["hosts"]
    if not hosts:
        return 0.0, 1.0
    mean = total[rule] / total["n"]
    spread = mean * (1 - mean)
    own = total[f"{rule}_r"] / hosts
    between = total[f"{rule}_sq"] / hosts - own * own - spread * total["inverse"] / hosts
    strength = spread / between - 1 if between > 0 else limits.max_strength
    return mean, min(max(strength, 1.0), limits.max_strength)


def host_verdicts(docs: DataFrame, host: str = "source", limits: HostLimits = HostLimits()) -> DataFrame:
    """doc_id, the FIGURES, base_failed and kept for every row of `docs`.

    Null texts count as empty; a null host is a host of its own; repeated rows each count and each get
    a verdict. Only figures are written and joined, never texts. Adaptive execution splits a hot host.
    """
    figures = stored(document_figures(docs, ["doc_id", host]), "figures")
    hosts = host_rates(figures, host, limits).select(F.col("host").alias("__host"), F.col("refused").alias("__refused"))
    joined = figures.join(stored(hosts, "verdicts"), F.col(host).eqNullSafe(F.col("__host")), "left")
    return joined.select(
        "doc_id",
        *FIGURES,
        base_failed().alias("base_failed"),
        (~base_failed() & ~F.coalesce("__refused", F.lit(False))).alias("kept"),
    )


def drop_rejected(docs: DataFrame, host: str = "source", limits: HostLimits = HostLimits()) -> DataFrame:
    """The rows of `docs` that pass the base rules and whose host is not refused, all columns unchanged.

    Figures are made twice rather than moving texts through a shuffle; of the verdicts only the
    refused hosts are joined (usually none or few; Spark broadcasts them only below its size threshold). Null, empty and
    blank texts have too few words and go; a null host is a host; repeated rows pass or go alike; an empty table stays so.
    """
    figures = stored(document_figures(docs, [host]), "figures")
    refused = stored(host_rates(figures, host, limits).where("refused").select(F.col("host").alias("refused_host")), "refused")
    columns = docs.columns
    numbered = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)), F.col("text"))
    judged = document_figures(numbered, numbered.columns[:-1]).where(~base_failed())
    passed = judged.join(refused, F.col(f"c{columns.index(host)}").eqNullSafe(F.col("refused_host")), "left_anti")
    return passed.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(columns)))
