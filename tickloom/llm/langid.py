"""Language identification by a small convolutional network on bytes.

A text is cut into windows of 256 bytes, all of it. Each byte is embedded, filters of
widths 2 to 4 run over a window, the largest response of each filter goes into a
softmax over languages, and a text's scores are the mean log probabilities of its
windows. The network is trained in numpy on a bounded sample of labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tickloom.llm.bpe import extended
from tickloom.llm.common import ship_code
from tickloom.llm.pretokens import LETTER, classes

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS, EMBEDDING = 24, 8
UNKNOWN = "und"
#: The training sample: texts of each language, and windows of each text.
SAMPLE_TEXTS, SAMPLE_WINDOWS = 400, 4
EPOCHS, BATCH, RATE = 8, 64, 0.01
BATCH_WINDOWS = 512


@dataclass
class Network:
    """Weights; ``languages`` names the classes in order."""

    languages: list[str]
    embed: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, *self.filters, *self.biases, self.out, self.out_bias]


def fresh(languages: list[str], seed: int) -> Network:
    rng = np.random.default_rng(seed)

    def some(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    filters = [some(w * EMBEDDING, FILTERS, scale=1 / np.sqrt(w * EMBEDDING)) for w in WIDTHS]
    return Network(
        languages,
        some(257, EMBEDDING, scale=0.5),
        filters,
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        some(len(WIDTHS) * FILTERS, len(languages), scale=0.2),
        np.zeros(len(languages), np.float32),
    )


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all texts (symbol 256 pads the last of each) and how many each has."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = -(-sizes // WINDOW)
    out = np.full(int(counts.sum()) * WINDOW, 256, np.int16)
    starts = (np.cumsum(counts) - counts) * WINDOW
    flat = np.frombuffer(b"".join(texts), np.uint8)
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    out[shift + np.arange(len(flat))] = flat
    return out.reshape(-1, WINDOW), counts


def _unfolded(embedded: np.ndarray, width: int) -> np.ndarray:
    """Every ``width`` neighbouring embeddings, as (windows * places, width * size)."""
    n, places, size = embedded.shape
    kept = places - width + 1
    strides = embedded.strides
    view = np.lib.stride_tricks.as_strided(
        embedded, (n, kept, width * size), (strides[0], strides[1], strides[2])
    )
    return view.reshape(n * kept, width * size)


def forward(net: Network, windows: np.ndarray) -> tuple[np.ndarray, list, np.ndarray, np.ndarray]:
    """Log probabilities; and what the gradient needs."""
    embedded = np.ascontiguousarray(net.embed[windows])
    pooled, places = [], []
    for width, kernel, bias in zip(WIDTHS, net.filters, net.biases):
        kept = WINDOW - width + 1
        response = (_unfolded(embedded, width) @ kernel).reshape(len(windows), kept, -1)
        best = response.argmax(axis=1)
        places.append(best)
        pooled.append(np.take_along_axis(response, best[:, None, :], 1)[:, 0] + bias)
    features = np.maximum(np.concatenate(pooled, axis=1), 0)
    scores = features @ net.out + net.out_bias
    scores = scores - scores.max(axis=1, keepdims=True)
    logs = scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))
    return logs, places, features, embedded


def gradients(net: Network, windows: np.ndarray, targets: np.ndarray) -> list[np.ndarray]:
    logs, places, features, embedded = forward(net, windows)
    n = len(windows)
    d_scores = np.exp(logs)
    d_scores[np.arange(n), targets] -= 1
    d_scores /= n
    d_features = (d_scores @ net.out.T) * (features > 0)
    d_embed = np.zeros_like(net.embed)
    d_filters, d_biases = [], []
    rows = np.arange(n)[:, None]
    for k, (width, kernel) in enumerate(zip(WIDTHS, net.filters)):
        d_own = d_features[:, k * FILTERS : (k + 1) * FILTERS]
        # Only the place of the maximum gets a gradient.
        d_kernel = np.zeros_like(kernel)
        for step in range(width):
            own = slice(step * EMBEDDING, (step + 1) * EMBEDDING)
            spots = places[k] + step
            values = embedded[rows, spots]
            d_kernel[own] = np.einsum("nf,nfe->ef", d_own, values)
            back = d_own[:, :, None] * kernel[own].T[None]
            np.add.at(d_embed, windows[rows, spots].ravel(), back.reshape(-1, EMBEDDING))
        d_filters.append(d_kernel)
        d_biases.append(d_own.sum(axis=0))
    return [d_embed, *d_filters, *d_biases, features.T @ d_scores, d_scores.sum(axis=0)]


def fit(texts: list[bytes], labels: list[str], seed: int = 0) -> Network:
    """Trains on all windows of the texts."""
    languages = sorted(set(labels))
    net = fresh(languages, seed)
    number = {x: i for i, x in enumerate(languages)}
    windows, counts = windows_of(texts)
    targets = np.repeat(np.array([number[x] for x in labels], np.int64), counts)
    rng = np.random.default_rng(seed)
    values = net.parameters()
    first = [np.zeros_like(v) for v in values]
    second = [np.zeros_like(v) for v in values]
    step = 0
    for _ in range(EPOCHS if len(languages) > 1 else 0):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            step += 1
            for v, g, a, b in zip(values, gradients(net, windows[some], targets[some]), first, second):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                v -= RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return net


def classify(net: Network, texts: list[bytes]) -> np.ndarray:
    """Probabilities of the languages: (texts, languages). Empty texts get zeros."""
    windows, counts = windows_of(texts)
    logs = np.empty((len(windows), len(net.languages)))
    for at in range(0, len(windows), BATCH_WINDOWS):
        logs[at : at + BATCH_WINDOWS] = forward(net, windows[at : at + BATCH_WINDOWS])[0]
    out = np.zeros((len(texts), len(net.languages)))
    has = np.flatnonzero(counts)
    if len(has):
        starts = np.cumsum(counts) - counts
        means = np.add.reduceat(logs, starts[has], axis=0) / counts[has, None]
        means = np.exp(means - means.max(axis=1, keepdims=True))
        out[has] = means / means.sum(axis=1, keepdims=True)
    return out


def train(labelled: DataFrame, seed: int = 0) -> Network | None:
    """Fits a network on rows (doc_id, text, lang); None if no row is usable.

    At most SAMPLE_TEXTS texts of each language, the first by a hash of their ids,
    reach the driver, as SAMPLE_WINDOWS windows each from anywhere in the text. Languages are bounded by
    what a classifier can name. Null and empty texts and null labels teach nothing.
    """
    rows = labelled.where("lang IS NOT NULL AND length(text) > 0")
    counts = rows.groupBy("lang").count()
    order = F.xxhash64(F.lit(seed), F.col("doc_id"), F.crc32("text"))
    # A share of each language that gives about twice the sample, then the sample.
    share = counts.select(
        F.col("lang").alias("_lang"), F.least(F.lit(2.0 * SAMPLE_TEXTS) / F.col("count"), F.lit(1.0)).alias("share")
    )
    near = F.pmod(order, F.lit(1 << 30)) < F.col("share") * (1 << 30)
    drawn = rows.join(F.broadcast(share), F.col("lang") == F.col("_lang")).where(near)
    # Windows from anywhere in a text, by a hash.
    room = F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1
    spots = [F.pmod(F.xxhash64(order, F.lit(k)), room).cast("int") + 1 for k in range(SAMPLE_WINDOWS)]
    windows = F.array_distinct(F.array(*(F.substring(F.col("text"), x, WINDOW) for x in spots)))
    best = F.slice(
        F.sort_array(F.collect_list(F.struct(order.alias("o"), windows.alias("w")))), 1, SAMPLE_TEXTS
    )
    found = drawn.groupBy("lang").agg(best.alias("s")).orderBy("lang").collect()
    pairs = [(w.encode(), r["lang"]) for r in found for x in r["s"] for w in x["w"]]
    return fit([w for w, _ in pairs], [x for _, x in pairs], seed) if pairs else None


def predict(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (0 to 1) for the whole of every text.

    A text that is null or has no letter is ``und`` with score 0, as is every text
    without a network. Columns of these names are replaced. Only the text is used.
    """
    ship_code(docs.sparkSession)
    rows = docs.drop("lang_pred", "score")
    place = rows.columns.index(text)
    schema = StructType(
        [*rows.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    )
    # The network has some thousand numbers.
    sent = rows.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(place).to_pylist()
                letters = [bool(t) and _has_letter(t) for t in texts]
                names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
                if model is not None:
                    known = [i for i, ok in enumerate(letters) if ok]
                    found = classify(model, [texts[i].encode() for i in known])
                    for i, p in zip(known, found):
                        names[i], scores[i] = model.languages[int(p.argmax())], float(p.max())
                yield extended(part, lang_pred=pa.array(names, pa.string()), score=pa.array(scores, pa.float64()))

    return rows.mapInArrow(run, schema)


def _has_letter(text: str) -> bool:
    if text[:64].isascii() and any(c.isalpha() for c in text[:64]):
        return True
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return bool((classes()[points] == LETTER).any())
