"""Language identification by a byte convolutional network, trained in numpy, applied to fixed-length windows."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import map_text, stored

UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")
_ASCII_LETTERS = np.array([chr(b).isascii() and chr(b).isalpha() for b in range(256)])


@dataclass(frozen=True)
class Training:
    """What the network is fitted on and how: at most `docs_per_language` different texts of each language, the ones with the
    lowest hash of id and text, and at most `windows_per_doc` windows spread over each whole text. More than `languages`
    labels are an error: each has its part of the sample and of the network."""

    window: int = 256
    docs_per_language: int = 400
    windows_per_doc: int = 6
    languages: int = 2000
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 8
    embedding: int = 8
    epochs: int = 6
    batch: int = 64
    rate: float = 0.01
    seed: int = 11


def remainder(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3: 1 marks the held-out documents."""
    return F.crc32(F.col(doc_id).cast("string")) % 3


@dataclass
class Network:
    """Byte embedding, one convolution per width, max pooling over a window, softmax over `names`."""

    names: list[str]
    window: int
    widths: tuple[int, ...]
    embedding: np.ndarray
    kernels: list[np.ndarray]
    bias: np.ndarray
    head: np.ndarray
    head_bias: np.ndarray
    _stacked: np.ndarray = field(default=None, repr=False)

    def pooled(self, windows: np.ndarray, where: bool = False):
        """Largest response of every filter in each window (n, filters), with `where` also its place."""
        x = self.embedding[windows]
        n, length, depth = x.shape
        flat = x.reshape(n * length, depth)
        out, places = [], []
        for width, kernel in zip(self.widths, self.kernels, strict=True):
            steps = length - width + 1
            parts = (flat @ kernel.transpose(1, 0, 2).reshape(depth, -1)).reshape(n, length, width, -1)
            response = parts[:, :steps, 0].copy()
            for j in range(1, width):
                response += parts[:, j : j + steps, j]
            out.append(response.max(1))
            if where:
                places.append(response.argmax(1))
        found = np.concatenate(out, 1)
        return (found, places) if where else found

    def log_shares(self, windows: np.ndarray) -> np.ndarray:
        z = np.maximum(self.pooled(windows) + self.bias, 0) @ self.head + self.head_bias
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))


def train(windows: np.ndarray, labels: np.ndarray, names: list[str], how: Training) -> Network:
    """Adam on cross-entropy. Only the place of each maximum gets a gradient, so a step costs little more than a forward pass."""
    rng = np.random.default_rng(how.seed)
    total = how.filters * len(how.widths)
    f = np.float32
    net = Network(
        names,
        how.window,
        how.widths,
        rng.normal(0, 0.5, (256, how.embedding)).astype(f),
        [rng.normal(0, (w * how.embedding) ** -0.5, (w, how.embedding, how.filters)).astype(f) for w in how.widths],
        np.zeros(total, f),
        rng.normal(0, total**-0.5, (total, len(names))).astype(f),
        np.zeros(len(names), f),
    )
    net.embedding[0] = 0
    values = [net.embedding, *net.kernels, net.bias, net.head, net.head_bias]
    means, squares = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    step = 0
    for _ in range(how.epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), how.batch):
            rows = order[at : at + how.batch]
            step += 1
            for v, g, m, s in zip(values, _gradients(net, windows[rows], labels[rows]), means, squares, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= how.rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
            net.embedding[0] = 0
    return net


def _gradients(net: Network, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    pooled, places = net.pooled(windows, where=True)
    hidden = np.maximum(pooled + net.bias, 0)
    z = hidden @ net.head + net.head_bias
    z -= z.max(1, keepdims=True)
    share = np.exp(z)
    share /= share.sum(1, keepdims=True)
    share[np.arange(len(labels)), labels] -= 1
    share /= len(labels)
    d_hidden = (share @ net.head.T) * (hidden > 0)
    d_embedding = np.zeros_like(net.embedding)
    d_kernels, at = [], 0
    for width, kernel, place in zip(net.widths, net.kernels, places, strict=True):
        count = kernel.shape[2]
        d = d_hidden[:, at : at + count]
        at += count
        grad = np.zeros_like(kernel)
        for j in range(width):
            codes = np.take_along_axis(windows, place + j, 1)
            grad[j] = np.einsum("nfd,nf->df", net.embedding[codes], d)
            np.add.at(d_embedding, codes.ravel(), (d[:, :, None] * kernel[j].T[None]).reshape(-1, kernel.shape[1]))
        d_kernels.append(grad)
    return [d_embedding, *d_kernels, d_hidden.sum(0), hidden.T @ share, share.sum(0)]


def _spread_windows(raw: bytes, window: int, most: int) -> list[bytes]:
    count = max(1, -(-len(raw) // window))
    picked = sorted({i * count // most for i in range(most)}) if count > most else range(count)
    return [raw[i * window : (i + 1) * window] for i in picked]


def _lowest(keyed: DataFrame, most: int) -> DataFrame:
    """The `most` lowest different h of each lang, merged in steps: in each task, in 64 parts of a language, in the language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            codes, h = langs.indices.to_numpy(), batch.column(1).to_numpy()
            for i, name in enumerate(langs.dictionary.to_pylist()):
                kept[name] = np.unique(np.concatenate([kept.get(name, h[:0]), h[codes == i]]))[:most]
        for name, h in kept.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(h), pa.string()), pa.array(h)], names=["lang", "h"])

    found = keyed.select("lang", "h").mapInArrow(run, "lang string, h long").distinct().withColumn("part", F.pmod("h", F.lit(64)))
    for keys in (["lang", "part"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("h"))
        found = found.withColumn("place", place).where(F.col("place") <= most).drop("place")
    return found.select("lang", "h")


def training_windows(docs: DataFrame, how: Training) -> DataFrame:
    """lang and window (bytes) of the bounded sample, by whole documents that are not held out.

    A document is known by the hash of its id and text: rows that share an id are texts of their own, equal rows are one.
    """
    usable = docs.where((remainder() != 1) & F.col("lang").isNotNull() & (F.length("text") > 0))
    usable = usable.select("lang", "text", F.xxhash64(F.lit(how.seed), "doc_id", "text").alias("h"))
    chosen = stored(_lowest(usable, how.docs_per_language), "sample")
    labels = chosen.select("lang").distinct().count()
    if labels > how.languages:
        raise ValueError(f"{labels} languages; the network is fitted on {how.languages} at most (Training.languages)")
    # Bounded by the two parameters: so many hashes of so many languages at most.
    chosen = F.broadcast(chosen.select(F.col("lang").alias("name"), F.col("h").alias("picked")))
    sample = usable.join(chosen, (F.col("lang") == F.col("name")) & (F.col("h") == F.col("picked"))).dropDuplicates(["lang", "h"])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [
            (lang, raw)
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True)
            for raw in _spread_windows(text.encode("utf-8", "surrogatepass"), how.window, how.windows_per_doc)
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], names=["lang", "window"]
        )

    return map_text(sample.select("lang", "text"), work, "lang string, window binary")


def fit(docs: DataFrame, how: Training = Training()) -> Network | None:
    """The network fitted on the bounded sample of `docs` (doc_id, text, lang); None if it has no labelled text."""
    rows = sorted((r["lang"], bytes(r["window"])) for r in training_windows(docs, how).collect())
    if not rows:
        return None
    names = sorted({r[0] for r in rows})
    codes = np.zeros((len(rows), how.window), np.uint8)
    for i, (_, raw) in enumerate(rows):
        codes[i, : len(raw)] = np.frombuffer(raw, np.uint8)
    return train(codes, np.array([names.index(r[0]) for r in rows]), names, how)


def predict(texts: pa.Array, net: Network, at_once: int = 256) -> tuple[list[str], list[float]]:
    """Language and score of whole texts. Windows cover a text from end to end; their log shares are averaged, each
    weighing as many letters as it holds, and the mean is made to add up to 1 again."""
    rows = len(texts)
    raw = texts.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + rows + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
    lengths = np.diff(offsets)
    if texts.null_count:
        lengths = np.where(np.array(texts.is_null()), 0, lengths)
    counts = -(-lengths // net.window)
    owner = np.repeat(np.arange(rows), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[:-1][owner] + place * net.window
    sizes = np.minimum(lengths[owner] - place * net.window, net.window)
    sums, weights = np.zeros((rows, len(net.names))), np.zeros(rows)
    step = np.arange(net.window)
    for at in range(0, len(owner), at_once):
        part = slice(at, at + at_once)
        inside = step[None, :] < sizes[part][:, None]
        codes = data[np.minimum(starts[part][:, None] + step[None, :], len(data) - 1)] * inside
        letters = (_ASCII_LETTERS[codes] | (codes >= 0x80)).sum(1)
        np.add.at(sums, owner[part], net.log_shares(codes) * letters[:, None])
        np.add.at(weights, owner[part], letters)
    names, scores = [UNDETERMINED] * rows, [0.0] * rows
    for i in np.nonzero(weights > 0)[0]:
        raw_text = data[offsets[i] : offsets[i + 1]]
        if not _ASCII_LETTERS[raw_text].any() and not _LETTER.search(texts[int(i)].as_py()):
            continue
        z = sums[i] / weights[i]
        best = int(z.argmax())
        names[i] = net.names[best]
        scores[i] = float(1 / np.exp(z - z[best]).sum())
    return names, scores


def languages(docs: DataFrame, how: Training = Training(), net: Network | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of `docs`; the prediction reads the text only.

    Learns from the labelled documents that are not held out, unless `net` is given. Null texts and texts
    without letters are `und` with score 0, as is everything if there is nothing to learn from. A null
    doc_id is neither learnt from nor held out. Texts are not shuffled; the network is a few kilobytes.
    """
    net = net or fit(docs, how)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, scores = predict(batch.column(1), net) if net else ([UNDETERMINED] * batch.num_rows, [0.0] * batch.num_rows)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"]
        )

    kind = dict(docs.dtypes)["doc_id"]
    mapped = map_text(docs.select("doc_id", "text"), work, f"doc_id {kind}, lang_pred string, score double")
    return mapped.select("doc_id", F.coalesce(remainder() == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
