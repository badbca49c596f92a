"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words.  Every passage of the whole text is
encoded from its letters (hashed byte trigrams, shares of character classes, word statistics, as
deviations from the mean passage that shrink in short passages) by a learned layer.  Gated
attention, ``softmax(w . (tanh(V h) * sigmoid(U h)))``, weighs the passages, and a logistic layer
scores the weighted sum.  All layers are learned together from document labels, with numpy, on a
sample of at most ``SAMPLE`` labelled documents (those with the smallest hash of their id), and on
mean passages with the mean label, so that a text that says little is scored like most others.
The model is a few thousand numbers, and scoring is one pass over the texts.

Defined results: a text without words (NULL, empty) is one passage of zeros and gets that
passage's score; a label without a document, a document without a label and a NULL label are not
learned from; repeated rows get equal scores; without any labels every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.arrays import LOWER, NOT_SPACE, expanded, raw, words
from tidemark.llm.encoder import slices

PASSAGE_WORDS = 64
SAMPLE = 4_000
TRIGRAMS = 256
EPOCHS = 30
# Steps of learning at least, however few the labels.
STEPS = 900
# Many single trigrams against a few shares that each say more.
TRIGRAM_WEIGHT = 0.25
# Documents learned from per mean passage that is added.
ANCHORED = 20
# Bytes at which a passage's deviations count half.
PRIOR_BYTES = 256
_SLICE_BYTES = 1 << 20


def _classes() -> np.ndarray:
    """Class of each byte: lower case, upper case, digit, white space, other ASCII, not ASCII."""
    out = np.full(256, 4)
    out[97:123], out[65:91], out[48:58] = 0, 1, 2
    out[[9, 10, 11, 12, 13, 32]] = 3
    out[128:] = 5
    return out


_CLASS = _classes()
N_FEATURES = TRIGRAMS + 6 + 5


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, one row each, and the bounds of each text's rows."""
    data, bounds = raw(texts)
    found = words(data, bounds, NOT_SPACE)
    counts = found.counts
    own = np.maximum(1, -(-counts // PASSAGE_WORDS))
    first_of = np.cumsum(own) - own
    total = int(own.sum())
    out = np.zeros((total, N_FEATURES), np.float32)
    n = len(found.hashes)
    if not n:
        return out, np.append(first_of, total)
    owner = found.owner
    passage = first_of[owner] + (np.arange(n) - found.bounds[owner]) // PASSAGE_WORDS
    # A passage's bytes run to the first word of the text's next one, or to the text's end.
    opens = np.flatnonzero(np.diff(passage, prepend=-1))
    text = owner[opens]
    starts, stops = found.starts[opens], bounds[text + 1]
    stops[:-1] = np.where(text[1:] == text[:-1], starts[1:], stops[:-1])
    body = data[expanded(starts, stops - starts)]
    of_byte = np.repeat(passage[opens], stops - starts)
    text = np.repeat(text, stops - starts)

    length = np.bincount(of_byte, minlength=total).astype(np.float32)
    share = 1 / np.maximum(length, 1)
    classes = np.bincount(of_byte * 6 + _CLASS[body], minlength=total * 6).reshape(total, 6)
    if len(body) > 2:
        code = LOWER[body].astype(np.uint32)
        gram = (code[:-2] * 0x9E3779B1 + code[1:-1] * 0x85EBCA6B + code[2:] * 0xC2B2AE35).astype(np.uint32) >> 24
        place = (of_byte[:-2] * TRIGRAMS + gram)[text[2:] == text[:-2]]
        grams = np.bincount(place, minlength=total * TRIGRAMS).reshape(total, TRIGRAMS)
        out[:, :TRIGRAMS] = np.sqrt(grams * share[:, None])
    out[:, TRIGRAMS : TRIGRAMS + 6] = classes * share[:, None]

    held = np.bincount(passage, minlength=total).astype(np.float32)
    per_word = 1 / np.maximum(held, 1)
    order = np.lexsort((found.hashes, passage))
    p, h = passage[order], found.hashes[order]
    fresh = np.ones(n, bool)
    fresh[1:] = (p[1:] != p[:-1]) | (h[1:] != h[:-1])
    same = np.zeros(n, bool)
    same[1:] = (passage[1:] == passage[:-1]) & (found.hashes[1:] == found.hashes[:-1])
    last = data[found.ends - 1]
    signs = (_CLASS[last] == 4) & (_CLASS[data[np.maximum(found.ends - 2, found.starts)]] == 4)
    out[:, TRIGRAMS + 6] = np.bincount(p, fresh, total) * per_word
    out[:, TRIGRAMS + 7] = np.bincount(passage, same, total) * per_word
    out[:, TRIGRAMS + 8] = np.bincount(passage, signs, total) * per_word
    out[:, TRIGRAMS + 9] = np.bincount(passage, found.ends - found.starts, total) * per_word / 16
    out[:, TRIGRAMS + 10] = length / (length + PRIOR_BYTES)
    return out, np.append(first_of, total)


@dataclass
class Model:
    """Scaling of the features and the weights of all layers."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """Features as deviations from the mean passage, which count less in short passages."""
        return ((x[:, :-1] - self.mean) * self.scale * x[:, -1:]).astype(np.float32)

    def score(self, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        if not len(bounds) - 1:
            return np.zeros(0)
        return _forward(self.weights, self.scaled(x), bounds[:-1])["p"].astype(float)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(w, x, heads):
    bags = np.diff(np.append(heads, len(x)))
    h = np.tanh(x @ w["E"] + w["e"])
    t, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
    s = (t * g) @ w["w"]
    top = np.maximum.reduceat(s, heads)
    a = np.exp(s - np.repeat(top, bags))
    a = a / np.repeat(np.add.reduceat(a, heads), bags)
    z = np.add.reduceat(a[:, None] * h, heads)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "bags": bags, "p": _sigmoid(z @ w["c"] + w["b"])}


def _gradients(w, x, heads, y):
    f = _forward(w, x, heads)
    d = (f["p"] - y) / len(y)
    dz = np.repeat(d[:, None] * w["c"], f["bags"], axis=0)
    dh = f["a"][:, None] * dz
    da = (dz * f["h"]).sum(axis=1)
    ds = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, heads), f["bags"]))
    dt = ds[:, None] * w["w"] * f["g"] * (1 - f["t"] ** 2)
    dg = ds[:, None] * w["w"] * f["t"] * f["g"] * (1 - f["g"])
    dh = dh + dt @ w["V"].T + dg @ w["U"].T
    dx = dh * (1 - f["h"] ** 2)
    return {
        "E": x.T @ dx,
        "e": dx.sum(axis=0),
        "V": f["h"].T @ dt,
        "U": f["h"].T @ dg,
        "w": (f["t"] * f["g"]).T @ ds,
        "c": f["z"].T @ d,
        "b": d.sum(),
    }


def fit(x: np.ndarray, bounds: np.ndarray, y: np.ndarray, hidden=32, gate=16, epochs=EPOCHS, batch=128, decay=1e-3) -> Model:
    """Learn all layers by Adam on the log loss; the same input gives the same model."""
    rng = np.random.default_rng(7)
    weight = x[:, -1:].astype(np.float64)
    mean = (x[:, :-1] * weight).sum(axis=0) / max(weight.sum(), 1e-9)
    spread = np.sqrt((((x[:, :-1] - mean) * weight) ** 2).sum(axis=0) / max((weight**2).sum(), 1e-9))
    scale = 1 / (spread + 0.02)
    scale[:TRIGRAMS] *= TRIGRAM_WEIGHT
    model = Model(mean, scale, {})
    x = model.scaled(x)
    d = x.shape[1]
    anchors = -(-len(y) // ANCHORED)
    x = np.concatenate([x, np.zeros((anchors, d), x.dtype)])
    bounds = np.concatenate([bounds, bounds[-1] + 1 + np.arange(anchors)])
    y = np.concatenate([y, np.full(anchors, y.mean(), y.dtype)])
    w = {
        "E": rng.normal(0, d**-0.5, (d, hidden)),
        "e": np.zeros(hidden),
        "V": rng.normal(0, hidden**-0.5, (hidden, gate)),
        "U": rng.normal(0, hidden**-0.5, (hidden, gate)),
        "w": rng.normal(0, gate**-0.5, gate),
        "c": rng.normal(0, hidden**-0.5, hidden),
        "b": np.zeros(()),
    }
    w = {k: v.astype(np.float32) for k, v in w.items()}
    m, v = ({k: np.zeros_like(p) for k, p in w.items()} for _ in range(2))
    step = 0
    epochs = max(epochs, -(-STEPS * batch // len(y)))
    for epoch in range(epochs):
        rate = 3e-3 * (1 - epoch / epochs)
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            chosen = np.sort(order[at : at + batch])
            sizes = bounds[chosen + 1] - bounds[chosen]
            heads = np.cumsum(sizes) - sizes
            rows = np.repeat(bounds[chosen] - heads, sizes) + np.arange(int(sizes.sum()))
            step += 1
            for k, g in _gradients(w, x[rows], heads, y[chosen]).items():
                g = g + decay * w[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] = w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    model.weights.update(w)
    return model


def is_held_out(id: str) -> Column:
    return F.crc32(F.col(id).cast("string")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents that are not held out."""
    chosen = (
        labels.select(F.col(id).alias("_id"), F.col(label).cast("double").alias("_y"))
        .where(F.col("_id").isNotNull() & F.col("_y").isNotNull() & ~is_held_out("_id"))
        .orderBy(F.xxhash64("_id"), "_y")
        .limit(sample)
    )
    # At most ``sample`` rows.
    learned = docs.select(F.col(id).alias("_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "_id")
    schema = "_id string, y double, n int, features binary"

    def encode(batches):
        for batch in slices(batches, "text", _SLICE_BYTES):
            x, bounds = passages(batch.column("text"))
            x = x.astype(np.float16)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id").cast(pa.string()),
                    batch.column("_y"),
                    pa.array(np.diff(bounds).astype(np.int32)),
                    pa.array([x[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()),
                ],
                names=["_id", "y", "n", "features"],
            )

    got = learned.mapInArrow(encode, schema).toArrow().sort_by([("_id", "ascending"), ("features", "ascending")])
    if not got.num_rows:
        zero = {"E": np.zeros((N_FEATURES - 1, 1)), "e": np.zeros(1), "V": np.zeros((1, 1)), "U": np.zeros((1, 1))}
        zero |= {"w": np.zeros(1), "c": np.zeros(1), "b": np.zeros(())}
        return Model(np.zeros(N_FEATURES - 1), np.ones(N_FEATURES - 1), zero)
    x = np.frombuffer(b"".join(got["features"].to_pylist()), np.float16).reshape(-1, N_FEATURES).astype(np.float32)
    bounds = np.append(0, np.cumsum(got["n"].to_numpy()))
    return fit(x, bounds, got["y"].to_numpy().astype(np.float32))


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, score."""
    # Plain arrays: workers need no class of this package to read them.
    shared = docs.sparkSession.sparkContext.broadcast((model.mean, model.scale, model.weights))
    schema = T.StructType([T.StructField(id, docs.schema[id].dataType), T.StructField("score", T.DoubleType())])
    arrow_id = to_arrow_type(schema[id].dataType)

    def run(batches):
        for batch in slices(batches, "_text", _SLICE_BYTES):
            scores = Model(*shared.value).score(*passages(batch.column("_text")))
            yield pa.RecordBatch.from_arrays([batch.column("_id").cast(arrow_id), pa.array(scores, pa.float64())], names=schema.names)

    return docs.select(F.col(id).alias("_id"), F.col(text).alias("_text")).mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: Model, threshold: float, text: str = "text") -> DataFrame:
    """Rows of ``docs`` with at least this score, with its columns, whatever their names.

    A NULL text is scored as an empty one; repeated rows stay or go together; no rows, no rows.
    """
    # Plain arrays: workers need no class of this package to read them.
    shared = docs.sparkSession.sparkContext.broadcast((model.mean, model.scale, model.weights))

    def run(batches):
        for batch in slices(batches, text, _SLICE_BYTES):
            scores = Model(*shared.value).score(*passages(batch.column(text)))
            yield batch.filter(pc.greater_equal(pa.array(scores, pa.float64()), threshold))

    return docs.mapInArrow(run, docs.schema)
