"""Language identification by the nearest of several centroids.

A text is a vector of byte n-gram frequencies (one to three bytes, hashed), weighted by inverse document frequency and
normalised. Each language has several centroids, the clusters of its training vectors. A text gets the language whose
nearest centroid has the largest cosine; it is rejected if it is farther from that centroid than nearly all training
texts were.

The model is fitted on a bounded sample of labelled rows, chosen by a hash of the text; every text is then classified
whole, in one pass, without moving it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yardline.llm.common import append_columns, settle
from yardline.llm.rolling import PIECE, mix, text_buffer

DIMENSIONS = 2048
CENTROIDS = 4
ROUNDS = 8
SAMPLE = 1000  # labelled texts per language that the model is fitted on
TAIL = 0.005  # share of training texts beyond the distance that rejects
ROWS = 128  # texts whose vectors are held at once
UNKNOWN = "und"

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[[c for c in range(128) if not chr(c).isalpha()]] = 32  # digits and punctuation are gaps


def frequencies(raw: np.ndarray, at: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Counts of hashed n-grams of texts; runs of gaps count once. Long texts go through in pieces."""
    folded = FOLD[raw]
    gap = folded == 32
    keep = ~gap
    keep[1:] |= gap[1:] & ~gap[:-1]
    at = np.concatenate(([0], np.cumsum(keep)))[at]
    folded = folded[keep]
    out = np.zeros((len(at) - 1) * dimensions)
    for low in range(0, len(folded), PIECE):
        first = max(0, low - 2)
        data = folded[first : low + PIECE].astype(np.uint64)
        here = np.arange(first, first + len(data))
        row = np.searchsorted(at, here, side="right") - 1
        depth = np.where(here >= low, here - at[row], -1)
        gram = np.zeros(len(data), np.uint64)
        for n in (1, 2, 3):  # the gram that ends at each place, within its text
            gram[1:] = gram[:-1] << np.uint64(8)
            gram[0] = 0
            gram |= data
            inside = depth >= n - 1
            bucket = (mix(gram[inside] + np.uint64(n << 32)) % np.uint64(dimensions)).astype(np.int64)
            out += np.bincount(row[inside] * dimensions + bucket, minlength=len(out))
    return out.reshape(-1, dimensions)


def in_parts(raw: np.ndarray, at: np.ndarray, dimensions: int) -> Iterator[np.ndarray]:
    """Counts of ROWS texts at a time."""
    for first in range(0, len(at) - 1, ROWS):
        part = at[first : first + ROWS + 1]
        yield frequencies(raw[part[0] : part[-1]], part - part[0], dimensions)


def normalised(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vectors = np.sqrt(counts) * idf
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(length > 0, length, 1)


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    reach: np.ndarray  # smallest cosine that isn't rejected
    idf: np.ndarray

    def predict(self, raw: np.ndarray, at: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and whether it is too small, per text."""
        lang, score, far = [], [], []
        for counts in in_parts(raw, at, len(self.idf)):
            cosine = normalised(counts, self.idf) @ self.centroids.T
            best = cosine.argmax(1)
            value = cosine[np.arange(len(best)), best]
            lang += [self.languages[i] for i in best]
            score.append(np.clip(value, 0, 1))
            far.append(value < self.reach[best])
        return lang, np.concatenate(score) if score else np.zeros(0), np.concatenate(far) if far else np.zeros(0, bool)


def clusters(vectors: np.ndarray, k: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of unit length by cosine, and each vector's cosine with its own; starts from far-apart vectors."""
    chosen = [int(np.argmax(vectors @ vectors.mean(0)))]
    nearest = vectors @ vectors[chosen[0]]
    while len(chosen) < min(k, len(vectors)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, vectors @ vectors[chosen[-1]])
    centres = vectors[chosen]
    for _ in range(rounds):
        own = (vectors @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, vectors)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.where(length > 0, length, 1), centres)
    return centres, vectors @ centres.T


def sampled(labelled: DataFrame, sample: int) -> DataFrame:
    """About ``sample`` different texts per language (all of a smaller one), the same ones at every run.

    They are chosen by a hash of the text, so neither null nor repeated ids weigh, and copies of a text count once.
    """
    texts = labelled.select("lang", F.xxhash64("text").alias("h")).distinct()
    sizes, _ = settle(texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    chosen = labelled.join(sizes.withColumnRenamed("lang", "of"), F.col("lang") == F.col("of")).filter(place < sample / F.col("n"))
    return chosen.select("lang", "text").distinct()


def fit(
    labelled: DataFrame, *, sample: int = SAMPLE, dimensions: int = DIMENSIONS, centroids: int = CENTROIDS, tail: float = TAIL
) -> Model:
    """Fit on columns text and lang (rows with a null in text or lang are left out, equal rows count once).

    ``sample`` bounds the texts per language. Each language's clusters come from one task, which holds their vectors;
    only centroids reach the driver.
    """
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows, _ = settle(sampled(rows, sample))
    total = rows.count()

    def document_frequency(batches):
        seen = np.zeros(dimensions, np.int64)
        for batch in batches:
            for counts in in_parts(*text_buffer(batch.column("text")), dimensions):
                seen += (counts > 0).sum(0)
        yield pa.record_batch([pa.array(np.arange(dimensions)), pa.array(seen)], names=["place", "seen"])

    seen = rows.select("text").mapInArrow(document_frequency, "place long, seen long").groupBy("place").agg(F.sum("seen").alias("seen"))
    idf = np.full(dimensions, math.log(1 + total))
    for r in seen.collect():  # one row per dimension
        idf[r["place"]] = math.log((1 + total) / (1 + r["seen"])) + 1

    def cluster(frame: pd.DataFrame) -> pd.DataFrame:
        raw, at = text_buffer(pa.array(frame["text"].sort_values(), pa.string()))
        vectors = [normalised(counts, idf).astype(np.float32) for counts in in_parts(raw, at, dimensions)]
        vectors = np.concatenate(vectors)
        vectors = vectors[vectors.any(1)]
        if not len(vectors):
            return pd.DataFrame({"lang": [], "centroid": [], "reach": []})
        centres, cosine = clusters(vectors, centroids, ROUNDS)
        own = cosine.argmax(1)
        reach = [float(np.quantile(cosine[own == i, i], tail)) if (own == i).any() else 1.0 for i in range(len(centres))]
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "centroid": [c.astype(float).tolist() for c in centres], "reach": reach})

    found = rows.groupBy("lang").applyInPandas(cluster, "lang string, centroid array<double>, reach double")
    found = sorted(found.collect(), key=lambda r: (r["lang"], r["centroid"]))  # some centroids per language
    centres = np.array([r["centroid"] for r in found]).reshape(-1, dimensions)
    return Model([r["lang"] for r in found], centres, np.array([r["reach"] for r in found]), idf)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add lang_pred, score (cosine, 0 to 1) and rejected to documents.

    A text that is null or has no letter is ``und`` with score 0 and rejected; so is any text for a model without a
    language. A rejected text still shows the nearest language. Columns with the names of results are replaced, rows
    may repeat, and an empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> list[pa.Array]:
        column = batch.column(text_col)
        lettered = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if not held.value.languages:
            lettered[:] = False
            lang, score, far = [UNKNOWN] * len(column), np.zeros(len(column)), np.ones(len(column), bool)
        else:
            lang, score, far = held.value.predict(*text_buffer(column))
        lang = [x if ok else UNKNOWN for x, ok in zip(lang, lettered, strict=True)]
        return [pa.array(lang, pa.string()), pa.array(np.where(lettered, score, 0.0)), pa.array(far | ~lettered)]

    return append_columns(docs, text_col, step, {"lang_pred": "string", "score": "double", "rejected": "boolean"})


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that training must not see."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))
