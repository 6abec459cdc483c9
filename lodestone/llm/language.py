"""Language identification by nearest centroid over TF-IDF character n-grams.

A text is the bag of its letters' 1- to 4-grams within words (lower case, other characters part words),
hashed into ``DIMS`` slots, weighted by ``(1 + log tf) * idf`` and normalised.  Training clusters each
language's vectors (spherical k-means) into a few centroids, so that a language may have several registers.
A text gets the language of the centroid with the largest cosine.  Distance-based rejection: the fit keeps,
for each centroid, the cosine that all but ``REJECT`` of its own texts exceed; a text that lies further out
is marked ``rejected`` (the nearest language is still named).

The model is fitted on a bounded sample: at most ``PER_LANGUAGE`` distinct texts of each language
(``training.sample``).  What leaves the executors is a text's n-gram counts, at most ``DIMS`` of them however long
the text is.  The model is a few MB, broadcast to one Arrow pass over all texts; nothing is shuffled.

Defined cases: a text that is null or holds no letter is ``und`` with score 0; a text of any length is read
whole; equal cosines go to the language that sorts first; a language with one text has one centroid; without
any labelled text every text is ``und``; repeated rows are scored alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMS = 1 << 14
GRAMS = (1, 2, 3, 4)
PER_LANGUAGE = 600
CLUSTERS = 3
REJECT = 0.01
#: A cluster with a smaller share of its language's texts is noise and gets no centroid.
SMALLEST = 0.1
UNKNOWN = "und"

#: lower-case letter of every code point that is a letter, 0 for every other
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    global _letters
    if _letters is None:
        table = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            if (x := chr(c)).isalpha():
                low = x.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _letters = table
    return _letters


def counts(text: str | None) -> np.ndarray | None:
    """How often each slot's n-grams occur in the text; None if it has no letter."""
    if not text:
        return None
    code = letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not code.any():
        return None
    code = np.concatenate([[0], code, [0]]).astype(np.uint32)
    inner = code != 0
    edge = inner | np.roll(inner, 1) | np.roll(inner, -1)  # a letter, or the blank beside one
    code = code[edge]
    out = np.zeros(DIMS, np.int64)
    value = np.zeros(len(code), np.uint32)
    for n in range(1, max(GRAMS) + 1):
        if n > len(code):
            break
        m = len(code) - n + 1
        value = value[:m] * np.uint32(0x01000193) ^ (code[n - 1:n - 1 + m] + np.uint32(n))
        if n in GRAMS:
            mixed = value * np.uint32(0x9E3779B1)
            ok = slice(None)
            if n > 2:  # not across words
                ok = code[1:m] != 0
                for k in range(2, n - 1):
                    ok = ok & (code[k:m + k - 1] != 0)
                mixed = mixed[:-1][ok] if len(mixed) > 1 else mixed[:0]
            elif n == 1:
                mixed = mixed[code[:m] != 0]
            out += np.bincount(mixed >> np.uint32(32 - 14), minlength=DIMS)
    return out


def bag(text: str | None) -> bytes | None:
    """The counts of a text's slots as bytes; None if it has no letter."""
    count = counts(text)
    if count is None:
        return None
    at = np.flatnonzero(count)
    return at.astype(np.uint16).tobytes() + count[at].astype(np.int64).tobytes()


def _opened(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """``(slots, counts)`` of a bag."""
    n = len(data) // 10
    return np.frombuffer(data, np.uint16, n).astype(np.int64), np.frombuffer(data, np.int64, n, 2 * n)


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    least: np.ndarray

    def vector(self, at: np.ndarray, count: np.ndarray) -> np.ndarray:
        v = (1 + np.log(count)) * self.idf[at]
        size = np.sqrt((v * v).sum())
        return (v / size if size else v).astype(np.float32)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        count = counts(text)
        if count is None or not len(self.languages):
            return UNKNOWN, 0.0, True
        at = np.flatnonzero(count)
        cosine = self.centroids[at].T @ self.vector(at, count[at])
        best = int(np.argmax(cosine))
        return self.languages[best], float(min(1.0, max(0.0, cosine[best]))), bool(cosine[best] < self.least[best])


def fit(texts: list[str | None], languages: list[str], clusters: int = CLUSTERS, rounds: int = 8) -> Model:
    return fit_bags([bag(t) for t in texts], languages, clusters, rounds)


def fit_bags(of_texts: list[bytes | None], languages: list[str], clusters: int = CLUSTERS, rounds: int = 8) -> Model:
    bags = [(_opened(b), lang) for b, lang in zip(of_texts, languages, strict=True) if b is not None]
    seen = np.zeros(DIMS)
    for (at, _), _ in bags:
        seen[at] += 1
    model = Model(np.log((1 + len(bags)) / (1 + seen)) + 1, np.zeros((DIMS, 0), np.float32), [], np.zeros(0))
    names, centres, least = [], [], []
    for lang in sorted({x for _, x in bags}):
        rows = np.zeros((sum(x == lang for _, x in bags), DIMS), np.float32)
        for row, (at, count) in zip(rows, (b for b, x in bags if x == lang), strict=True):
            row[at] = model.vector(at, count)
        mean = rows.mean(axis=0)
        order = np.argsort(rows @ mean, kind="stable")
        k = min(clusters, len(rows))
        centre = rows[order[np.linspace(0, len(rows) - 1, k).astype(int)]].copy()
        for _ in range(rounds):
            near = np.argmax(rows @ centre.T, axis=1)
            for j in range(k):
                if (near == j).any():
                    centre[j] = rows[near == j].mean(axis=0)
                    centre[j] /= max(1e-9, np.sqrt((centre[j] ** 2).sum()))
        cosine = rows @ centre.T
        near = np.argmax(cosine, axis=1)
        for j in range(k):
            own = cosine[near == j, j]
            if len(own) < SMALLEST * len(rows):
                continue
            names.append(lang)
            centres.append(centre[j])
            least.append(float(np.quantile(own, REJECT)) if len(own) else 0.0)
    if centres:
        model.centroids, model.languages, model.least = np.ascontiguousarray(np.array(centres).T), names, np.array(least)
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of each of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            rows = [m.predict(t.as_py()) for t in batch.column(1)]
            lang, score, out = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(out, pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")
