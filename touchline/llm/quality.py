"""Quality score by a byte-level convolutional network in numpy.

The whole text, as UTF-8 bytes, goes through learned filters of ``WIDTH`` bytes every ``STRIDE``
bytes; each overlapping chunk of two ``SEGMENT``-position segments is max-pooled, and the largest
and the mean chunk response of every filter are combined into one probability. A filter is a table
of one weight per place and byte value, so a convolution is a sum of table look-ups.

Training: at most ``TRAIN_ROWS`` labelled rows per class and ``toxicity.SAMPLE_BYTES`` bytes in all, chosen
by a hash of the id; their whole texts, pooled as in scoring. Scoring covers every byte. Nothing but
the text's bytes is an input. Null and empty texts are scored as one chunk of padding. Without
both classes every score is the share of label 1 (0.5 if there are no labels at all).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 8
STRIDE = 2
FILTERS = 16
SEGMENT = 64
TRAIN_ROWS = 1600
EPOCHS = 4
_SPAN = SEGMENT * STRIDE


@dataclass
class Net:
    tables: np.ndarray  # (WIDTH, 256, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    out: np.ndarray  # (2 * FILTERS,)
    out_bias: float
    constant: float | None = None


def padded(raw: bytes) -> np.ndarray:
    """Bytes filled up with zeros to whole segments (two at least), and what the last filters need."""
    n = max(2, -(-len(raw) // _SPAN)) * _SPAN + WIDTH
    out = np.zeros(n, dtype=np.uint8)
    out[: len(raw)] = np.frombuffer(raw, dtype=np.uint8)
    return out


def responses(net: Net, data: np.ndarray) -> np.ndarray:
    """(positions, FILTERS) filter responses of bytes that ``padded`` made."""
    places = (len(data) - WIDTH) // STRIDE
    total = np.take(net.tables[0], data[0 : places * STRIDE : STRIDE], axis=0)
    for j in range(1, WIDTH):
        total += np.take(net.tables[j], data[j : j + places * STRIDE : STRIDE], axis=0)
    return total


def segments(net: Net, data: np.ndarray, block: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """(largest response, its position) of each filter in each segment, computed block by block."""
    n, tops, args = (len(data) - WIDTH) // _SPAN, [], []
    step = block // SEGMENT
    for at in range(0, n, step):
        m = min(step, n - at)
        part = responses(net, data[at * _SPAN : (at + m) * _SPAN + WIDTH]).reshape(m, SEGMENT, FILTERS)
        arg = part.argmax(axis=1)
        tops.append(np.take_along_axis(part, arg[:, None, :], axis=1)[:, 0])
        args.append(arg + np.arange(at, at + m)[:, None] * SEGMENT)
    return np.concatenate(tops), np.concatenate(args)


def chunks(net: Net, top: np.ndarray) -> np.ndarray:
    """Responses of the overlapping chunks of two segments."""
    return np.maximum(np.maximum(top[1:], top[:-1]) + net.bias, 0)


def pooled(net: Net, data: np.ndarray, block: int = 1 << 16) -> np.ndarray:
    """(2 * FILTERS,) of one document: largest and mean chunk response, computed block by block."""
    n, tops = (len(data) - WIDTH) // _SPAN, []
    step = block // SEGMENT
    for at in range(0, n, step):
        m = min(step, n - at)
        tops.append(responses(net, data[at * _SPAN : (at + m) * _SPAN + WIDTH]).reshape(m, SEGMENT, FILTERS).max(axis=1))
    chunk = chunks(net, np.concatenate(tops))
    return np.concatenate((chunk.max(axis=0), chunk.mean(axis=0)))


def predict(net: Net, text: str | None) -> float:
    if net.constant is not None:
        return net.constant
    z = float(pooled(net, padded((text or "").encode("utf-8", "surrogatepass"))) @ net.out + net.out_bias)
    return 1 / (1 + np.exp(-max(-30.0, min(30.0, z))))


def train(rows: list[tuple[str | None, int]], seed: int = 7, epochs: int = EPOCHS) -> Net:
    """Fit by Adam on the log loss; classes weigh alike. Max-pooling sends each gradient to one position."""
    rng = np.random.default_rng(seed)
    y = np.array([r[1] for r in rows], dtype=np.float64)
    net = Net(
        rng.normal(0, 0.25, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), rng.normal(0, 0.3, 2 * FILTERS), 0.0
    )
    if not len(y) or y.min() == y.max():
        net.constant = float(y.mean()) if len(y) else 0.5
        return net
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    raws = [(t or "").encode("utf-8", "surrogatepass") for t, _ in rows]
    parts = [net.tables, net.bias, net.out]
    m = [np.zeros(p.shape) for p in parts] + [0.0]
    v = [np.zeros(p.shape) for p in parts] + [0.0]
    step = 0
    for epoch in range(epochs):
        rate = 0.02 * (1 - epoch / epochs)
        order = rng.permutation(len(y))
        for begin in range(0, len(order), 32):
            grads = [np.zeros(net.tables.shape, np.float32), np.zeros(FILTERS), np.zeros(2 * FILTERS), 0.0]
            chosen = order[begin : begin + 32]
            for i in chosen.tolist():
                data = padded(raws[i])
                top, arg = segments(net, data)
                n = len(top)
                left = top[:-1] >= top[1:]
                chunk = chunks(net, top)
                best = chunk.argmax(axis=0)
                h = np.concatenate((chunk.max(axis=0), chunk.mean(axis=0)))
                p = 1 / (1 + np.exp(-np.clip(h @ net.out + net.out_bias, -30, 30)))
                d = (p - y[i]) * weight[i] / len(chosen)
                grads[2] += d * h
                grads[3] += d
                back = np.tile(d * net.out[FILTERS:] / (n - 1), (n - 1, 1))
                back[best, np.arange(FILTERS)] += d * net.out[:FILTERS]
                back *= chunk > 0
                grads[1] += back.sum(axis=0)
                filters = np.broadcast_to(np.arange(FILTERS), left.shape)
                position = np.where(left, arg[:-1], arg[1:]) * STRIDE
                for j in range(WIDTH):
                    np.add.at(grads[0], (j, data[position + j], filters), back)
            step += 1
            for k, g in enumerate(grads):
                if k < 3:
                    g = g + 1e-4 * parts[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                change = rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
                if k < 3:
                    parts[k] -= change.astype(parts[k].dtype)
                else:
                    net.out_bias -= float(change)
    return net


def score(docs: DataFrame, net: Net) -> DataFrame:
    """(doc_id, score) for every row of ``docs(doc_id, text)``; higher: label 1 likelier."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": [float(predict(model, t)) for t in batch["text"].tolist()]})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, "doc_id long, score double")
