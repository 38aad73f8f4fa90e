"""Toxicity classifier with counterfactual regularisation.

A text is the set of its words and of their first four and five letters. The features whose
document frequency differs most between toxic and clean labelled texts, and all swapped terms, make
a logistic model. Every labelled text with such a term is also taken with its terms swapped for
others; the loss penalises the square of the change of the score, so that naming one group or
another, in itself, moves no score.

Terms come from two places: lists of words that name groups, one a language, and words mined from the
labelled sample itself, which need no list: frequent words that are as common in toxic as in clean
texts, each swapped for the one whose neighbours in the texts are most like its own.

Fitting takes a bounded sample (``SAMPLE_ROWS``, ``SAMPLE_BYTES``) whose frequencies Spark counts;
scoring is a narrow pass without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from reviewloom.llm.common import held_out, map_batches, stored, table
from reviewloom.llm.labelled import labelled_sample

SAMPLE_ROWS, SAMPLE_BYTES = 12_000, 64 << 20
MOST_FEATURES = 1024
LEAST_TEXTS, LEAST_Z = 3, 4.0
THRESHOLD = 0.3
STEPS, RATE, RIDGE, FAIRNESS = 400, 0.1, 1e-4, 1.0
#: Mined terms: so many at most, with a difference of frequencies below this many standard deviations,
#: in this share of the texts at least, neighbours counted in so many bins, and this cosine at least.
MINED_TERMS, MINED_Z, MINED_SHARE, NEIGHBOUR_BINS, LIKE = 64, 1.0, 0.02, 256, 0.5

# Words that name groups of people, by language.
IDENTITY_TERMS = {
    "en": (
        "muslim", "muslims", "christian", "christians", "jewish", "jews", "hindu", "buddhist", "atheist", "catholic",
        "black", "white", "asian", "african", "latino", "hispanic", "arab", "european", "american", "mexican", "chinese",
        "indian", "immigrant", "immigrants", "refugee", "refugees", "woman", "women", "man", "men", "female", "male",
        "gay", "lesbian", "bisexual", "transgender", "queer", "straight", "old", "young", "elderly", "disabled", "deaf", "blind",
    ),
    "de": (
        "muslime", "christen", "juden", "hindus", "buddhisten", "atheisten", "katholiken", "schwarze", "weiße", "asiaten",
        "afrikaner", "araber", "türken", "polen", "russen", "deutsche", "einwanderer", "flüchtlinge", "frauen", "männer",
        "frau", "mann", "schwule", "lesben", "behinderte", "blinde", "gehörlose", "alte",
    ),
    "es": (
        "musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos", "católicos", "negros", "blancos", "asiáticos",
        "africanos", "árabes", "latinos", "gitanos", "mexicanos", "chinos", "inmigrantes", "refugiados", "mujeres", "hombres",
        "mujer", "hombre", "homosexuales", "lesbianas", "discapacitados", "ciegos", "sordos", "ancianos",
    ),
    "fr": (
        "musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées", "catholiques", "noirs", "blancs", "asiatiques",
        "africains", "arabes", "latinos", "roms", "américains", "chinois", "immigrés", "réfugiés", "femmes", "hommes",
        "femme", "homme", "homosexuels", "lesbiennes", "handicapés", "aveugles", "sourds", "vieux",
    ),
}
_WORD = re.compile(r"[^\W\d_]+")


def features(text: str) -> set[str]:
    """Words in lower case, and ``abcd*`` and ``abcde*`` for the first letters of longer ones."""
    words = set(_WORD.findall(text.lower()))
    return words | {w[:4] + "*" for w in words if len(w) > 4} | {w[:5] + "*" for w in words if len(w) > 5}


def listed_partners(terms: dict[str, tuple[str, ...]] = IDENTITY_TERMS) -> dict[str, str]:
    """Each listed term and the one that stands half its language's list further on; a term of several
    languages is swapped within the first."""
    partners: dict[str, str] = {}
    for words in terms.values():
        for at, word in enumerate(words):
            partners.setdefault(word, words[(at + len(words) // 2) % len(words)])
    return partners


def swapped(text: str, partners: dict[str, str]) -> str | None:
    """The text with each term replaced by its partner; None without any."""
    found = False

    def other(match: re.Match) -> str:
        nonlocal found
        partner = partners.get(match.group().lower())
        found |= partner is not None
        return match.group() if partner is None else partner

    changed = _WORD.sub(other, text)
    return changed if found else None


def mined_partners(sample: DataFrame, rated: DataFrame, texts: int) -> dict[str, str]:
    """Partners among the words of the sample (``text, label``) that say nothing about the label.

    ``rated``: ``name, a, c, z`` of the features, with the standard deviations by which their
    frequencies differ. Neighbours are counted by Spark, in bins; at most ``MINED_TERMS`` words times
    their bins reach the driver.
    """
    neutral = rated.filter((F.col("z") < MINED_Z) & (F.col("a") + F.col("c") >= max(LEAST_TEXTS, MINED_SHARE * texts)) & ~F.col("name").endswith("*"))
    words = [r.name for r in neutral.orderBy(F.desc(F.col("a") + F.col("c")), "name").limit(MINED_TERMS).collect()]
    if len(words) < 2:
        return {}
    place = {w: i for i, w in enumerate(words)}

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        counts = np.zeros((len(words), 2 * NEIGHBOUR_BINS), np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = _WORD.findall(text.lower())
                bins = [zlib.crc32(w.encode()) % NEIGHBOUR_BINS for w in found]
                for at, word in enumerate(found):
                    if (i := place.get(word)) is not None:
                        if at:
                            counts[i, bins[at - 1]] += 1
                        if at + 1 < len(found):
                            counts[i, NEIGHBOUR_BINS + bins[at + 1]] += 1
        i, k = counts.nonzero()
        yield {"i": i, "k": k, "n": counts[i, k]}

    summed = map_batches(sample, neighbours, "i int, k int, n bigint").groupBy("i", "k").agg(F.sum("n").alias("n"))
    vectors = np.zeros((len(words), 2 * NEIGHBOUR_BINS))
    for r in summed.collect():
        vectors[r.i, r.k] = r.n
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    like = vectors @ vectors.T
    np.fill_diagonal(like, -1)
    best = like.argmax(axis=1)
    return {w: words[best[i]] for i, w in enumerate(words) if like[i, best[i]] >= LIKE}


class ToxicityModel:
    def __init__(self, names: list[str]):
        self.names = names
        self.place = {n: i for i, n in enumerate(names)}
        self.weights, self.bias = np.zeros(len(names)), 0.0
        self.swapped_texts = 0

    def row(self, text: str) -> list[int]:
        """Places of the model's features that the text has."""
        return sorted(map(self.place.__getitem__, features(text) & self.place.keys()))

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[self.row(text)].sum(), -30, 30))))

    def fit(self, rows: list[list[int]], twins: list[list[int] | None], labels: np.ndarray, fairness: float = FAIRNESS) -> ToxicityModel:
        """``twins``: the swapped text's features, None where nothing was swapped."""
        if not len(labels):
            return self
        n = len(self.names)
        x = np.zeros((len(rows), n), np.float32)
        for i, row in enumerate(rows):
            x[i, row] = 1
        paired = [i for i, t in enumerate(twins) if t is not None]
        self.swapped_texts = len(paired)
        x2 = np.zeros((len(paired), n), np.float32)
        for k, i in enumerate(paired):
            x2[k, twins[i]] = 1
        y, w, b = labels.astype(np.float32), np.zeros(n, np.float32), np.float32(0)
        m, v = np.zeros(n + 1), np.zeros(n + 1)

        def sigmoid(z):
            return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

        for step in range(1, STEPS + 1):
            s = sigmoid(x @ w + b)
            delta = (s - y) / len(y)
            slope, slope_b = x.T @ delta + RIDGE * w, delta.sum()
            if paired:
                own, other = s[paired], sigmoid(x2 @ w + b)
                gap = 2 * fairness * (own - other) / len(paired)
                own_d, other_d = gap * own * (1 - own), gap * other * (1 - other)
                slope, slope_b = slope + x[paired].T @ own_d - x2.T @ other_d, slope_b + (own_d - other_d).sum()
            g = np.append(slope, slope_b)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            w, b = w - move[:-1].astype(np.float32), b - np.float32(move[-1])
        self.weights, self.bias = w.astype(float), float(b)
        return self


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = SAMPLE_ROWS,
    text_bytes: int = SAMPLE_BYTES,
    terms: dict[str, tuple[str, ...]] = IDENTITY_TERMS,
    fairness: float = FAIRNESS,
) -> ToxicityModel:
    """Fit on at most ``rows`` labelled documents with at most ``text_bytes`` of text; without any, every
    text scores 0.5.

    Ids that several documents hold do not exceed the bounds; equal documents count once. ``terms``
    are the listed words by language. The model's ``swapped_texts`` counts the texts of the penalty.
    """
    sample = stored(labelled_sample(docs, labels, "toxic", rows, text_bytes), "toxicity-sample")

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = list(features(text))
                yield {"name": own, "label": [label] * len(own)}

    total = sample.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic")).first()
    n1, n0 = int(total.toxic), int(total.n - total.toxic)
    counts = map_batches(sample, named, "name string, label int").groupBy("name").agg(
        F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("c")
    )
    every = (F.col("a") + F.col("c")) / max(1, n1 + n0)
    gap = F.abs(F.col("a") / max(1, n1) - F.col("c") / max(1, n0))
    spread = F.sqrt(every * (1 - every) * (1 / max(1, n1) + 1 / max(1, n0)))
    often = counts.filter(F.col("a") + F.col("c") >= LEAST_TEXTS)
    rated = stored(often.withColumn("z", gap / F.greatest(spread, F.lit(1e-9))), "rated-features")
    chosen = [r.name for r in rated.filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "name").limit(MOST_FEATURES).collect()]
    listed = listed_partners(terms)
    partners = {**mined_partners(sample, rated, n1 + n0), **listed}
    model = ToxicityModel([*chosen, *(t for t in listed if t not in set(chosen))])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            own = [model.row(t) for t in texts]
            twins = [t and model.row(t) for t in (swapped(t, partners) for t in texts)]
            yield {"own": own, "twin": [t if t != o else None for o, t in zip(own, twins)], "label": batch.column(1)}

    found = map_batches(sample, placed, "own array<int>, twin array<int>, label int").collect()
    found.sort(key=lambda r: (r.label, r.own, r.twin or []))
    return model.fit([r.own for r in found], [r.twin for r in found], np.array([r.label for r in found]), fairness)


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs``' columns but text, with ``score`` (0 to 1) and ``predicted``, row by row.

    A NULL text counts as empty, which has the model's base score. NULL and repeated ids are passed on.
    """
    @pandas_udf("double")
    def score(texts):
        return pd.Series([model.score(t or "") for t in texts], dtype=float)

    others = [c for c in docs.columns if c not in ("text", "score", "predicted")]
    return docs.withColumn("score", score("text")).select(
        *others, "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")
    )


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """Score of every document; the model never sees the held-out fold's labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
