"""Language identification with blended-spectrum string kernels.

The kernel of two texts counts the character n-grams of one to three characters that both
contain (presence, not frequency), divided by the geometric mean of each text's own count.
Nystroem landmarks, a fixed number per language, span the feature space; kernel ridge
regression fits one language against the rest in it. A score is linear in the kernel
values against the landmarks and those are linear in a text's n-gram presence, so fitting
folds landmarks and coefficients into one matrix (n-grams of the landmarks x languages)
and scoring is a product of a presence matrix, one batch of texts at a time, with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

#: Bounds of the training sample and of the landmarks, per language.
TEXTS_PER_LANGUAGE, LANDMARKS_PER_LANGUAGE = 240, 64
RIDGE = 1e-2
#: Texts of one presence matrix.
ROWS = 64
UNDETERMINED = "und"
_SHIFT = 21  # bits of a code point


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), np.bool_, 0x110000)


def ngrams(text: str | None) -> np.ndarray:
    """Sorted distinct n-grams (1 to 3 code points) of the lower-cased text.

    Runs of anything but letters count as one space, the ends of the text too. A text
    without letters, or null, has none.
    """
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.int64)
    points = np.concatenate(([32], np.where(letter, points, 32), [32]))
    points = points[np.concatenate(([True], (points[1:] != 32) | (points[:-1] != 32)))]
    pairs = (points[:-1] << _SHIFT) | points[1:]
    triples = (pairs[:-1] << _SHIFT) | points[2:]
    return np.concatenate([np.unique(points), np.unique(pairs), np.unique(triples)])


@dataclass(frozen=True)
class Model:
    """Languages in ascending order, the landmarks' n-grams, and a weight for each of both."""

    languages: tuple[str, ...]
    vocabulary: np.ndarray
    weights: np.ndarray

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """One row per text (given as n-grams), one column per language."""
        presence = np.zeros((len(texts), len(self.vocabulary)), np.float32)
        own = np.ones(len(texts))
        for row, grams in enumerate(texts):
            presence[row, _places(self.vocabulary, grams)] = 1
            own[row] = max(len(grams), 1)
        return (presence @ self.weights) / np.sqrt(own)[:, None]


def _places(vocabulary: np.ndarray, grams: np.ndarray) -> np.ndarray:
    if not len(vocabulary):
        return np.empty(0, np.int64)
    at = np.searchsorted(vocabulary, grams)
    at[at == len(vocabulary)] = 0
    return at[vocabulary[at] == grams]


def fit_kernel_ridge(texts: list[np.ndarray], labels: list[str], landmarks: int = LANDMARKS_PER_LANGUAGE,
                     ridge: float = RIDGE) -> Model:
    """Fits on n-gram sets; the first ``landmarks`` texts of each language are landmarks."""
    languages = tuple(sorted(set(labels)))
    if not languages:
        return Model((), np.empty(0, np.int64), np.empty((0, 0), np.float32))
    y = np.array([languages.index(x) for x in labels])
    chosen = np.concatenate([np.flatnonzero(y == k)[:landmarks] for k in range(len(languages))])
    vocabulary = np.unique(np.concatenate([texts[k] for k in chosen]))

    presence = np.zeros((len(texts), len(vocabulary)), np.float32)
    for row, grams in enumerate(texts):
        presence[row, _places(vocabulary, grams)] = 1 / np.sqrt(max(len(grams), 1))
    anchors = presence[chosen]
    kernel = (presence @ anchors.T).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel[chosen])
    keep = values > 1e-6 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    z = kernel @ root
    share = np.bincount(y) * len(languages) / len(y)
    z_weighted = z / share[y][:, None]  # each language counts the same
    target = np.eye(len(languages))[y]
    beta = np.linalg.solve(z_weighted.T @ z + ridge * np.eye(z.shape[1]), z_weighted.T @ target)
    return Model(languages, vocabulary, (anchors.T @ (root @ beta)).astype(np.float32))


def _grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams = [ngrams(x.as_py()).tobytes() for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(grams, pa.binary())], names=["lang", "grams"])


def train(labelled: DataFrame, id_col: str, text_col: str, lang_col: str,
          per_language: int = TEXTS_PER_LANGUAGE, landmarks: int = LANDMARKS_PER_LANGUAGE) -> Model:
    """A model from at most ``per_language`` texts of each language, chosen by a hash of the id.

    The choice looks at ids and languages alone and is cut to its bound in every partition
    before anything moves; only the chosen texts are read, and only their distinct n-grams
    reach the driver.
    """
    labelled = labelled.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                               F.col(lang_col).cast("string").alias("lang")).filter("lang is not null")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = (labelled.filter("text is not null").select("id", "lang")
              .withColumn("place", F.row_number().over(order)).filter(F.col("place") <= per_language)
              .groupBy("id", "lang").agg(F.min("place").alias("place")).orderBy("lang", "place").collect())
    if not chosen:
        return fit_kernel_ridge([], [])
    place = {(r["lang"], r["id"]): r["place"] for r in chosen}
    wanted = labelled.sparkSession.createDataFrame(chosen, "id long, lang string, place int")
    rows = (labelled.join(F.broadcast(wanted), ["id", "lang"]).dropDuplicates(["lang", "place"])
            .sort("lang", "place").select("lang", "text").mapInArrow(_grams_of, "lang string, grams binary").collect())
    assert len(rows) <= len(place)
    known = [(r["lang"], np.frombuffer(r["grams"], np.int64)) for r in rows if r["grams"]]
    return fit_kernel_ridge([g for _, g in known], [x for x, _ in known], landmarks)


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, scores = [], []
            for at in range(0, batch.num_rows, ROWS):
                grams = [ngrams(x.as_py()) for x in batch.column(0).slice(at, ROWS)]
                if not model.languages:
                    found += [UNDETERMINED] * len(grams)
                    scores += [0.0] * len(grams)
                    continue
                values = model.scores(grams)
                best = values.argmax(axis=1)
                for row, g in enumerate(grams):
                    found.append(model.languages[best[row]] if len(g) else UNDETERMINED)
                    scores.append(float(np.clip(values[row, best[row]], 0, 1)) if len(g) else 0.0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.string()), pa.array(scores, pa.float64()), batch.column(1)],
                names=["lang_pred", "score", "row"])

    return run


def identify_language(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), judged by the text alone.

    A null text, or one without a letter, is "und" with score 0, as is any text if the
    model knows no language; of equal scores the first language in ascending order wins.
    Texts unlike all landmarks score near 0. Columns of ``docs`` named like the two new ones
    are replaced. Empty tables give empty results.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    text = F.col(f"`{text_col}`").cast("string").alias("text")
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    given = docs.select(text, row)
    schema = f"lang_pred string, score double, row {given.schema['row'].dataType.simpleString()}"
    return given.mapInArrow(_score(model), schema).select("row.*", "lang_pred", "score")
