"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded from its whole text (character classes,
word lengths, repetition); gated attention weighs the encoded passages, and the weighted sum is
scored. Encoder, attention and score are learned together from document labels alone. Fitting takes
a bounded sample (``SAMPLE_ROWS``, ``SAMPLE_BYTES``); its passage vectors are made by tasks and only they reach the
driver. Scoring is a narrow pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from reviewloom.llm.common import held_out, map_batches, table
from reviewloom.llm.labelled import labelled_sample

SAMPLE_ROWS = 5000
#: Bytes of whole texts: at most half a million passages of 64 words and 72 bytes each reach the driver.
SAMPLE_BYTES = 64 << 20
PASSAGE_WORDS = 64
THRESHOLD = 0.7
HIDDEN, GATE = 16, 8
STEPS, RATE, DECAY = 400, 0.02, 1e-4

#: Byte classes: the passage's share of each is a feature. Other bytes are class 0.
CLASSES = (
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\t\n\v\f\r", b".,", b";:?'\"()-",
    b"!", b"|", b"#$%&*", b"<>{}[]/\\=_+@~^`", bytes(range(128, 256)),
)
N_CLASSES = len(CLASSES) + 1
N_FEATURES = N_CLASSES + 5


def _class_table() -> np.ndarray:
    table = np.zeros(256, np.int64)
    for i, members in enumerate(CLASSES):
        table[np.frombuffer(members, np.uint8)] = i + 1
    return table


CLASS_OF = _class_table()
WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def encode_passages(text: str) -> np.ndarray:
    """One row of features per passage of ``PASSAGE_WORDS`` words; no row for a text without words."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return np.zeros((0, N_FEATURES), np.float32)
    codes = np.frombuffer(raw, np.uint8)
    white = WHITE[codes]
    starts = np.flatnonzero(~white & np.concatenate([[True], white[:-1]]))
    first = np.arange(0, len(words), PASSAGE_WORDS)
    n = len(first)
    cuts = np.concatenate([[0], starts[first[1:]], [len(codes)]])
    sizes = np.diff(cuts)
    passage = np.repeat(np.arange(n) * N_CLASSES, sizes)
    shares = np.bincount(passage + CLASS_OF[codes], minlength=n * N_CLASSES).reshape(n, N_CLASSES) / sizes[:, None]
    counts = np.diff(np.append(first, len(words)))
    lengths = np.fromiter(map(len, words), np.float64, len(words))
    same = np.fromiter(map(hash, words), np.int64, len(words))
    repeats = np.concatenate([[0.0], same[1:] == same[:-1]])
    distinct = np.array([len(set(words[a : a + PASSAGE_WORDS])) for a in first.tolist()])
    rest = [
        np.add.reduceat(lengths, first) / counts / 10,
        np.sqrt(np.add.reduceat(lengths**2, first) / counts) / 10,
        np.add.reduceat(repeats, first) / counts,
        distinct / counts,
        np.log1p(counts) / 5,
    ]
    return np.column_stack([shares, *rest]).astype(np.float32)


class AttentionModel:
    """``score = sigmoid(c . sum_k a_k h_k + d)`` with ``h = tanh(W x + b)`` and gated attention ``a``."""

    def __init__(self, seed: int = 1):
        draw = np.random.default_rng(seed)
        self.fitted = False
        self.mean, self.scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)
        self.p = {
            "W": draw.normal(0, 0.3, (N_FEATURES, HIDDEN)), "b": np.zeros(HIDDEN),
            "V": draw.normal(0, 0.3, (HIDDEN, GATE)), "U": draw.normal(0, 0.3, (HIDDEN, GATE)),
            "w": draw.normal(0, 0.3, GATE), "c": draw.normal(0, 0.3, HIDDEN), "d": np.zeros(1),
        }

    def _forward(self, x: np.ndarray, starts: np.ndarray, bag: np.ndarray) -> dict:
        p = self.p
        h = np.tanh(((x - self.mean) / self.scale) @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * g) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "s": 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))}

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        """Score of each bag; 0 for an empty one."""
        out = np.zeros(len(bags))
        full = [i for i, b in enumerate(bags) if len(b)]
        if full:
            sizes = np.array([len(bags[i]) for i in full])
            starts = np.cumsum(sizes) - sizes
            x = np.concatenate([bags[i] for i in full])
            out[full] = self._forward(x, starts, np.repeat(np.arange(len(full)), sizes))["s"]
        return out

    def fit(self, bags: list[np.ndarray], labels: np.ndarray) -> AttentionModel:
        keep = [i for i, b in enumerate(bags) if len(b)]
        y = labels[keep].astype(float)
        if not len(y):
            return self
        sizes = np.array([len(bags[i]) for i in keep])
        starts, bag = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(keep)), sizes)
        x = np.concatenate([bags[i] for i in keep]).astype(float)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        xs = (x - self.mean) / self.scale
        p, moments = self.p, {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        for step in range(1, STEPS + 1):
            f = self._forward(x, starts, bag)
            dl = (f["s"] - y) / len(y)
            dz = dl[:, None] * p["c"]
            da = (dz[bag] * f["h"]).sum(axis=1)
            de = f["a"] * (da - np.add.reduceat(f["a"] * da, starts)[bag])
            dt, dg = de[:, None] * p["w"] * f["g"], de[:, None] * p["w"] * f["t"]
            dv, du = dt * (1 - f["t"] ** 2), dg * f["g"] * (1 - f["g"])
            dh = f["a"][:, None] * dz[bag] + dv @ p["V"].T + du @ p["U"].T
            dx = dh * (1 - f["h"] ** 2)
            slopes = {
                "W": xs.T @ dx, "b": dx.sum(axis=0), "V": f["h"].T @ dv, "U": f["h"].T @ du,
                "w": (de[:, None] * f["t"] * f["g"]).sum(axis=0), "c": f["z"].T @ dl, "d": dl.sum(keepdims=True),
            }
            for k, slope in slopes.items():
                slope = slope + DECAY * p[k]
                m, v = moments[k]
                m += 0.1 * (slope - m)
                v += 0.01 * (slope**2 - v)
                p[k] = p[k] - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        self.fitted = True
        return self


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, text_bytes: int = SAMPLE_BYTES) -> AttentionModel:
    """Fit on at most ``rows`` labelled documents of at most ``text_bytes`` together. Without any, every text with words scores about 0.5."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            bags = [encode_passages(t) for t in batch.column(0).to_pylist()]
            yield {"bag": [b.tobytes() for b in bags], "label": batch.column(1)}

    sample = map_batches(labelled_sample(docs, labels, "quality", rows, text_bytes), run, "bag binary, label int").collect()
    sample.sort()  # tasks may hand over in any order
    bags = [np.frombuffer(r.bag, np.float32).reshape(-1, N_FEATURES) for r in sample]
    return AttentionModel().fit(bags, np.array([r.label for r in sample]))


def score_quality(docs: DataFrame, model: AttentionModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs``' columns but text, with ``score`` (0 to 1) and ``predicted``, row by row.

    Empty and NULL texts and texts of white space score 0. NULL and repeated ids are passed on.
    """
    others = [c for c in docs.columns if c not in ("text", "score", "predicted")]
    return _scored(docs, model, others, threshold)


def _scored(docs: DataFrame, model: AttentionModel, others: list[str], threshold: float) -> DataFrame:
    @pandas_udf("double")
    def score(texts):
        return pd.Series(model.scores([encode_passages(t or "") for t in texts]))

    return docs.withColumn("score", score("text")).select(
        *others, "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs``, with all their columns, that the classifier does not reject.

    Without a usable label (none outside the held-out fold, or of texts with words) nothing was learned
    and all rows are kept.
    """
    model = fit_quality(docs, labels)
    if not model.fitted:
        return docs
    scored = _scored(docs, model, [c for c in docs.columns if c != "score"], threshold)
    return scored.filter("predicted = 1").select(*docs.columns)


def op1_quality(spark, sf_dir: str) -> DataFrame:
    """Score of every document; the model never sees the held-out fold's labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
