"""Quality of texts: a byte-level convolutional network in numpy over overlapping chunks of the whole text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.llm.common import pieces, text_buffers

#: Filters of WIDTH bytes at every STRIDE-th byte; chunks of CHUNK filter places, one at every CHUNK // 2.
FILTERS, WIDTH, STRIDE, CHUNK = 16, 8, 4, 128
#: Labelled ids that the network is fitted on at most, the most characters of their texts each, and passes over them.
ROWS, FIT_CHARS, PASSES = 3000, 1 << 16, 12
THRESHOLD = 0.3
#: Bytes convolved at a time.
STEP = 1 << 18


@dataclass
class Network:
    """tables[k, byte]: what a byte at place k of a filter adds to each filter; bias; two weights a filter (mean and
    maximum over the chunks' pooled values) and the final bias."""

    tables: np.ndarray
    bias: np.ndarray
    top: np.ndarray
    final: float


def convolve(net: Network, data: np.ndarray) -> np.ndarray:
    """Filter values (places, FILTERS) of one text, padded by zero bytes to one filter at least."""
    n = max(1, -(-max(len(data), 1) // STRIDE))
    padded = np.zeros((n - 1) * STRIDE + WIDTH, np.uint8)
    padded[: len(data)] = data
    out = np.empty((n, FILTERS), np.float32)
    for at in range(0, n, STEP // STRIDE):
        m = min(n - at, STEP // STRIDE)
        part = out[at : at + m]
        part[:] = net.bias
        for k in range(WIDTH):
            part += net.tables[k][padded[at * STRIDE + k :: STRIDE][:m]]
    return out


def pooled(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximum of each filter over each chunk (chunks, FILTERS), rectified, and the places of the maxima."""
    half = CHUNK // 2
    n = -(-len(values) // half)
    full = np.full((n * half, FILTERS), -1e9, np.float32)
    full[: len(values)] = values
    blocks = full.reshape(n, half, FILTERS)
    best, where = blocks.max(1), blocks.argmax(1) + np.arange(n)[:, None] * half
    if n > 1:  # a chunk is two halves; neighbours share one
        right = best[1:] > best[:-1]
        best, where = np.where(right, best[1:], best[:-1]), np.where(right, where[1:], where[:-1])
    return np.maximum(best, 0), where


def _combined(net: Network, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    best, where = pooled(convolve(net, data))
    return np.concatenate([best.mean(0), best.max(0)]), best, where


def score(net: Network, data: np.ndarray) -> float:
    """Probability of label 1 for the bytes of one text."""
    x, _, _ = _combined(net, data)
    return float(1 / (1 + np.exp(-np.clip(x @ net.top + net.final, -50, 50))))


def fit(texts: list[str], labels: list[int], passes: int = PASSES, seed: int = 5) -> Network:
    """Trains the network by Adam on the logistic loss, both classes weighing the same but for a lean of 2 to 1 to label 1.
    Without labels of both kinds the score is the share of label 1 (0.5 without labels)."""
    rng = np.random.default_rng(seed)
    net = Network((rng.normal(0, 0.15, (WIDTH, 256, FILTERS))).astype(np.float32), np.full(FILTERS, 0.1, np.float32), rng.normal(0, 0.3, 2 * FILTERS), 0.0)
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        return Network(net.tables, net.bias, np.zeros(2 * FILTERS), float(np.log(share / (1 - share))))
    data = [np.frombuffer((t or "").encode(), np.uint8) for t in texts]
    weight = np.where(y == 1, (2 / 3) / y.mean(), (1 / 3) / (1 - y.mean()))
    params = [net.tables, net.bias, net.top, np.array([0.0])]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    steps, batch = 0, 16
    for turn in range(passes):
        order = rng.permutation(len(y))
        rate = 0.01 * (1 - turn / passes) + 0.0005
        for at in range(0, len(order), batch):
            grads = [np.zeros_like(p) for p in params]
            for i in order[at : at + batch]:
                x, best, where = _combined(net, data[i])
                p = 1 / (1 + np.exp(-np.clip(x @ net.top + params[3][0], -50, 50)))
                d = (p - y[i]) * weight[i] / batch
                grads[2] += d * x
                grads[3][0] += d
                # back through mean and maximum over chunks, then to the bytes under the pooled places
                back = np.repeat((d * net.top[:FILTERS] / len(best))[None, :], len(best), 0)
                np.add.at(back, (best.argmax(0), np.arange(FILTERS)), d * net.top[FILTERS:])
                back *= best > 0
                c, f = np.nonzero(back)
                value = back[c, f].astype(np.float32)
                np.add.at(grads[1], f, value)
                place = where[c, f] * STRIDE
                for k in range(WIDTH):
                    inside = place + k < len(data[i])
                    np.add.at(grads[0], (k, data[i][np.minimum(place + k, max(0, len(data[i]) - 1))][inside] if len(data[i]) else np.zeros(0, int), f[inside] if len(data[i]) else np.zeros(0, int)), value[inside] if len(data[i]) else np.zeros(0, np.float32))
            steps += 1
            for p, g, a, b in zip(params, grads, first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= (rate * (a / (1 - 0.9**steps)) / (np.sqrt(b / (1 - 0.999**steps)) + 1e-8)).astype(p.dtype)
    net.final = float(params[3][0])
    return net


def held_out(doc_id: Column) -> Column:
    """Rows that the fit never sees: crc32 of doc_id as text, modulo 5, is 0; not those without an id, which have no label."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_sample(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """(_id, quality, text) of at most rows labelled ids that aren't held out, half of each label where there are enough,
    chosen by a hash of the id. An id counts once, however often it is labelled or stands in docs: with the lower of its
    labels, and the least of its texts. Texts of more than FIT_CHARS characters are left out, so that the sample is bounded in
    bytes as well: the driver gets rows * FIT_CHARS characters at most."""
    known = labels.filter("quality is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("quality")).filter(~held_out(F.col("_id")))
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    once = known.groupBy("_id").agg(F.min("quality").alias("quality")).join(texts.select("_id"), "_id", "left_semi")
    order = [F.xxhash64("_id"), F.col("_id")]
    half = rows // 2
    chosen = once.filter("quality = 0").orderBy(*order).limit(half).unionAll(once.filter("quality = 1").orderBy(*order).limit(half))
    return texts.join(F.broadcast(chosen), "_id").filter(F.length("text") <= FIT_CHARS).groupBy("_id", "quality").agg(F.min("text").alias("text"))


def fit_on_labels(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Network:
    """Fits the network on fit_sample()."""
    found = fit_sample(docs, labels, rows).orderBy("_id").collect()
    return fit([r.text for r in found], [r.quality for r in found])


def score_quality(docs: DataFrame, net: Network) -> DataFrame:
    """docs with score (0 to 1, higher: label 1 likelier) and predicted added; columns of these names are replaced.

    Every byte of every text is convolved, in steps of bounded size; null and empty texts get the score of one padded
    filter; rows that repeat a text get one and the same score; a score of just THRESHOLD counts as 1. The network (130 KB) is broadcast; nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.arrow_udf("double")
    def run(text: pa.Array) -> pa.Array:
        data, offsets = text_buffers(text)
        return pa.array([score(shared.value, data[s:e]) for _, s, e in pieces(offsets)], pa.float64())

    out = docs.drop("score", "predicted").withColumn("score", run(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
