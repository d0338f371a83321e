"""A byte-level convolutional network for text quality, in numpy.

A text is its UTF-8 bytes, seen through overlapping chunks that cover all of it. Each filter weighs
six neighbouring bytes; its largest response in a chunk is kept. The chunk's responses are combined
over the text by mean and by maximum; these, with how full the chunks are, go through one small hidden
layer to one probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from monthwise.llm.common import labelled_ids, labelled_texts, one_text_each, whole

WIDTH = 6
CHUNK = 512
STEP = 448
BATCH_CHUNKS = 256
HIDDEN = 16
ZEROS, ONES, CHUNKS = 1300, 3900, 60_000
MIN_STEPS = 150


@dataclass
class Network:
    """``filters``: place, byte, filter. ``hidden``: from means, then maxima, then fullness."""

    filters: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    lift: np.ndarray
    weights: np.ndarray
    offset: float

    def tables(self) -> list[np.ndarray]:
        """Responses to pairs of bytes, so that six bytes take three look-ups."""
        return [
            (self.filters[k][:, None, :] + self.filters[k + 1][None, :, :]).reshape(65536, -1)
            for k in range(0, WIDTH, 2)
        ]


def _raw(text: str) -> bytes:
    raw = text.encode("utf-8", "surrogatepass")
    return raw + b"\0" * (WIDTH - len(raw))


def _octets(text: str) -> np.ndarray:
    return np.frombuffer(_raw(text), np.uint8)


def _starts(size: int) -> np.ndarray:
    """Chunk starts that leave no byte out."""
    return np.arange(0, max(1, size - (CHUNK - STEP)), STEP)


def _responses(octets: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    pairs = octets[:-1].astype(np.int32) << 8 | octets[1:]
    places = len(octets) - WIDTH + 1
    out = tables[0][pairs[:places]]
    out += tables[1][pairs[2 : 2 + places]]
    out += tables[2][pairs[4 : 4 + places]]
    return out


def pooled(octets: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """The largest response of each filter in each chunk."""
    out = []
    starts = _starts(len(octets))
    for part in range(0, len(starts), BATCH_CHUNKS):
        own = starts[part : part + BATCH_CHUNKS]
        last = min(len(octets), own[-1] + CHUNK)
        responses = _responses(octets[own[0] : last], tables)
        first = own - own[0]
        ends = np.minimum(first + CHUNK - WIDTH + 1, len(responses))
        bounds = np.stack([first, ends], axis=1).ravel()
        closed = bounds[:-1] if ends[-1] == len(responses) else bounds
        out.append(np.maximum.reduceat(responses, closed, axis=0)[::2])
    return np.concatenate(out)


def _fullness(size: int) -> float:
    """How full the first chunk is, on a scale that tells short texts apart."""
    return 3 * (1 - math.log(min(size, CHUNK)) / math.log(CHUNK))


def probability(text: str, network: Network, tables: list[np.ndarray]) -> float:
    """Probability of label 1 for a whole text; an empty text is six zero bytes."""
    octets = _octets(text)
    active = np.maximum(pooled(octets, tables) + network.bias, 0)
    inputs = np.concatenate([active.mean(0), active.max(0), [_fullness(len(octets))]])
    z = float(np.tanh(inputs @ network.hidden + network.lift) @ network.weights)
    return float(1 / (1 + np.exp(-np.clip(z + network.offset, -30, 30))))


def train(
    texts: list[list[bytes]],
    labels: list[int],
    filters: int = 24,
    epochs: int = 5,
    batch: int = 32,
    rate: float = 0.015,
    decay: float = 1e-4,
    seed: int = 11,
) -> Network:
    """Fit on texts given as chunks of ``WIDTH`` bytes or more, by gradient steps on batches.

    Only the place of the largest response passes a gradient back. Few texts are gone over more often,
    so that there are at least ``MIN_STEPS`` steps.
    """
    rng = np.random.default_rng(seed)
    y = np.array(labels, dtype=np.float64)
    params = {
        "filters": rng.normal(0, 0.3, (WIDTH, 256, filters)).astype(np.float32),
        "bias": np.zeros(filters, np.float32),
        "hidden": rng.normal(0, 0.2, (2 * filters + 1, HIDDEN)).astype(np.float32),
        "lift": np.zeros(HIDDEN, np.float32),
        "weights": rng.normal(0, 0.2, HIDDEN).astype(np.float32),
        "offset": np.zeros(1, np.float32),
    }
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    ready = [[np.frombuffer(c, np.uint8) for c in t] for t in texts]
    steps = 0
    for _ in range(max(epochs, math.ceil(MIN_STEPS * batch / len(ready)))):
        order = rng.permutation(len(ready))
        for start in range(0, len(order), batch):
            chosen = order[start : start + batch]
            grads = {k: np.zeros_like(v) for k, v in params.items()}
            chunks = [c for d in chosen for c in ready[d]]
            owner = np.repeat(np.arange(len(chosen)), [len(ready[d]) for d in chosen])
            peak = np.empty((len(chunks), filters), np.float32)
            where = np.empty((len(chunks), filters), np.int64)
            for i, c in enumerate(chunks):
                places = len(c) - WIDTH + 1
                response = params["filters"][0][c[:places]]
                for k in range(1, WIDTH):
                    response = response + params["filters"][k][c[k : k + places]]
                where[i] = response.argmax(0)
                peak[i] = response[where[i], np.arange(filters)]
            active = np.maximum(peak + params["bias"], 0)
            sizes = np.bincount(owner, minlength=len(chosen))
            mean = np.zeros((len(chosen), filters))
            np.add.at(mean, owner, active)
            mean /= sizes[:, None]
            top = np.zeros((len(chosen), filters))
            np.maximum.at(top, owner, active)
            full = np.array([[_fullness(sum(map(len, ready[d])))] for d in chosen])
            inputs = np.concatenate([mean, top, full], axis=1)
            units = np.tanh(inputs @ params["hidden"] + params["lift"])
            z = units @ params["weights"] + params["offset"][0]
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[chosen]) / len(chosen)
            grads["weights"][:] = units.T @ error + decay * params["weights"]
            grads["offset"][0] = error.sum()
            inner = error[:, None] * params["weights"] * (1 - units**2)
            grads["hidden"][:] = inputs.T @ inner + decay * params["hidden"]
            grads["lift"][:] = inner.sum(0)
            back = inner @ params["hidden"].T
            to_mean = (back[:, :filters] / sizes[:, None])[owner]
            to_top = back[:, filters : 2 * filters][owner] * (active == top[owner])
            signal = (to_mean + to_top) * (peak + params["bias"] > 0)
            grads["bias"][:] = signal.sum(0)
            for i, c in enumerate(chunks):
                for k in range(WIDTH):
                    grads["filters"][k, c[where[i] + k], np.arange(filters)] += signal[i]
            steps += 1
            for name, value in params.items():
                first[name] += 0.1 * (grads[name] - first[name])
                second[name] += 0.001 * (grads[name] ** 2 - second[name])
                size = first[name] / (1 - 0.9**steps)
                value -= rate * size / (np.sqrt(second[name] / (1 - 0.999**steps)) + 1e-8)
    return Network(
        *(params[k] for k in ("filters", "bias", "hidden", "lift", "weights")),
        float(params["offset"][0]),
    )


def fit(
    documents: DataFrame, labels: DataFrame, keep: Column, zeros: int = ZEROS, ones: int = ONES,
    chunks: int = CHUNKS, **settings,
) -> Network:
    """A network fitted on whole texts: at most ``zeros`` and ``ones`` ids of the two qualities, by a hash, of
    which those are taken, in the hash's order, that make at most ``chunks`` chunks together, each class its share. Of the
    rows of a repeated id one counts, the one whose text has the least hash, whatever the order of rows; null ids and
    labels count for nothing, a null text is empty. The share of the classes is put right at the end. Without
    texts of both classes: the share of label 1 alone. Other columns are ignored, whatever their names."""
    ids = labelled_ids(labels, "quality", keep, zeros, ones).persist()
    shares = {r["_label"]: r["n"] for r in labels.select(
        F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_label")
    ).where(keep & F.col("_label").isin(0, 1)).groupBy("_label").agg(F.count("*").alias("n")).collect()}

    texts = one_text_each(labelled_texts(documents, ids)).withColumn(
        "_size", F.ceil(F.octet_length("_text") / STEP)
    ).persist()
    left = {0: chunks * zeros // (zeros + ones), 1: chunks * ones // (zeros + ones)}
    taken = []
    for row in sorted(
        texts.select("_id", "_label", "_size", F.xxhash64("_id").alias("_hash")).collect(),
        key=lambda r: (r["_hash"], r["_id"]),
    ):  # at most zeros + ones rows
        if row["_size"] <= left[row["_label"]]:
            left[row["_label"]] -= row["_size"]
            taken.append((row["_id"],))
    kind = dict(ids.dtypes)["_id"]
    chosen = F.broadcast(documents.sparkSession.createDataFrame(taken, f"_id {kind}"))
    sample = texts.join(chosen, "_id", "left_semi").select("_id", "_label", "_text").orderBy(
        "_id"
    ).collect()  # at most chunks * STEP bytes
    texts.unpersist()
    ids.unpersist()
    y = [r["_label"] for r in sample]
    n = {0: y.count(0), 1: y.count(1)}
    if not n[0] or not n[1]:
        share = (shares.get(1, 0) + 0.5) / (shares.get(0, 0) + shares.get(1, 0) + 1)
        flat = np.zeros((WIDTH, 256, 1), np.float32)
        return Network(flat, np.zeros(1), np.zeros((3, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN),
                       float(np.log(share / (1 - share))))
    cut = [[raw[s : s + CHUNK] for s in _starts(len(raw))] for raw in (_raw(r["_text"]) for r in sample)]
    network = train(cut, y, **settings)
    network.offset += float(np.log(shares[1] / shares[0]) - np.log(n[1] / n[0]))
    return network


def quality_score(text: Column, network: Network) -> Column:
    """The probability that a text (null: empty) has quality 1."""

    @pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        tables = network.tables()
        return pd.Series([probability(t, network, tables) for t in texts], dtype="float64")

    return score(whole(text))
