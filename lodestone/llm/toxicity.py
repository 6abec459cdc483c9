"""Toxicity by subword-bag embeddings and a linear softmax, trained together in numpy.

A word's vector is the mean of the vectors of its known character n-grams (3 to 5, with word ends) and of the
word itself, all in one hashed table; a text's vector is the mean of its words'; a linear softmax gives the
classes.  A misspelt word shares most n-grams with the word it stands for.  Table and softmax are trained
jointly by Adagrad on mini-batches.  The fit is then shrunk: with n texts of the rarer class its logit counts
``n^2 / (n^2 + SHRINK^2)``, the logit of the training texts' share of label 1 the rest.  With few labels all scores
lie near that share; with many the fit stands as it is.

The model is linear in the mean, so each word adds a number of its own to a text's logit; scoring looks up
the numbers of words already met, and a text's length does not matter.

Fitted on a bounded sample: at most ``PER_CLASS`` distinct labelled texts of each class (``training.sample``).  What
leaves the executors is a text's distinct words with their counts; of a text with more than ``WORDS_FITTED`` of them
those with the least CRC stand for all, in the fit only.  Scoring is one Arrow pass over all texts; nothing is shuffled.

Defined cases: null and wordless texts score as the bias says, which is under one half unless most training
texts without words are toxic; without labelled texts of both classes every score is the share of label 1, or
0; a text of any length is read whole; repeated rows score alike; extra columns are ignored.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMS = 8
SLOT_BITS = 20
SIZES = (3, 4, 5)
#: An n-gram is used if it occurs in so many texts, counted by word.
LEAST_TEXTS = 4
PER_CLASS = 2000
EPOCHS = 5
#: Distinct words of a text that the fit takes: a sample of a long text's vocabulary.
WORDS_FITTED = 1 << 14
#: Texts of the rarer class at which the fit counts half.
SHRINK = 100
CACHE = 600_000
#: Words: letters, digits and the signs that stand in for letters.
WORD = re.compile(r"[^\W_]+(?:[@$!*'’_.-]+[^\W_]+)*")


def grams(some: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(number of the word, slot)`` of every n-gram of ``some``, marked at both ends, and of every word whole."""
    code = np.frombuffer("".join([f"<{w}>" for w in some]).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(w) + 2 for w in some], np.int64)
    owner = np.repeat(np.arange(len(some)), size)
    starts = np.cumsum(size) - size
    power = np.cumprod(np.full(int(size.max()), 0x01000193, np.uint32), dtype=np.uint32)
    place = np.arange(len(code)) - starts[owner]
    whole = np.add.reduceat((code + np.uint32(77)) * power[place], starts, dtype=np.uint32) * np.uint32(0x85EBCA6B) + np.uint32(1)
    who, slot = [np.arange(len(some))], [whole]
    value = code.copy()
    for n in range(2, max(SIZES) + 1):
        m = len(code) - n + 1
        if m <= 0:
            break
        value = (value[:m] * np.uint32(0x01000193)) ^ (code[n - 1:] + np.uint32(n))
        if n in SIZES:
            inside = owner[:m] == owner[n - 1:]
            who.append(owner[:m][inside])
            slot.append(value[inside])
    mixed = np.concatenate(slot)
    mixed ^= mixed >> np.uint32(15)
    return np.concatenate(who), ((mixed * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOT_BITS)).astype(np.int64)


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def bag(text: str | None) -> bytes:
    """The distinct words of a text and their counts, as JSON."""
    found = Counter(words(text))
    if len(found) > WORDS_FITTED:
        found = {w: found[w] for w in sorted(found, key=lambda w: (zlib.crc32(w.encode("utf-8", "surrogatepass")), w))[:WORDS_FITTED]}
    return json.dumps(found).encode()


@dataclass
class Model:
    """``weight``: what each slot adds to a word's logit, once the fit is done."""

    weight: np.ndarray
    bias: float
    cache: dict[str, float] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"weight": self.weight, "bias": self.bias, "cache": {}}

    def learn(self, some: list[str]) -> None:
        """What each of ``some`` adds: the mean over its known n-grams."""
        for at in range(0, len(some), 20_000):
            part = some[at:at + 20_000]
            who, slot = grams(part)
            slot_weight = self.weight[slot]
            total = np.bincount(who, slot_weight, len(part))
            known = np.bincount(who, slot_weight != 0, len(part))
            self.cache.update(zip(part, (total / np.maximum(1, known)).tolist(), strict=True))

    def score(self, text: str | None) -> float:
        found = words(text)
        if len(self.cache) > CACHE:
            self.cache.clear()
        if new := set(found).difference(self.cache):
            self.learn(list(new))
        logit = self.bias + (sum(map(self.cache.__getitem__, found)) / len(found) if found else 0.0)
        return 1 / (1 + math.exp(-min(60.0, max(-60.0, logit))))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of ``[start, start + size)`` for each range, in turn."""
    total = np.cumsum(sizes)
    return np.arange(int(total[-1]) if len(total) else 0) + np.repeat(starts - total + sizes, sizes)


def fit(texts: list[str | None], labels: list[int], **more) -> Model:
    return fit_bags([bag(t) for t in texts], labels, **more)


def fit_bags(of_texts: list[bytes], labels: list[int], dims: int = DIMS, epochs: int = EPOCHS, rate: float = 0.5, batch: int = 64) -> Model:
    """Joint training; the same input always gives the same model."""
    y = np.array(labels, np.int64)
    share = float(y.mean()) if len(y) else 0.0
    if not 0 < share < 1:
        return Model(np.zeros(1 << SLOT_BITS, np.float32), 60.0 if share else -60.0)
    rng = np.random.default_rng(1)
    names: dict[str, int] = {}
    bags = []
    for data in of_texts:
        found = {names.setdefault(w, len(names)): n for w, n in json.loads(data).items()}
        ids = np.fromiter(found, np.int64, len(found))
        n = np.fromiter(found.values(), np.float32, len(found))
        bags.append((ids, n / max(1.0, n.sum())))
    if not names:
        return Model(np.zeros(1 << SLOT_BITS, np.float32), float(np.log(share / (1 - share))))
    who, slot = grams(list(names))
    # an n-gram counts if enough texts have it: rare ones would only learn those texts by heart
    holders = np.zeros(len(names), np.int64)
    for ids, _ in bags:
        holders[ids] += 1
    common = np.bincount(slot, holders[who], 1 << SLOT_BITS)[slot] >= LEAST_TEXTS
    who, slot = who[common], slot[common]
    order = np.argsort(who, kind="stable")
    who, slot = who[order], slot[order]
    sizes = np.bincount(who, minlength=len(names))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    used, flat = np.unique(slot, return_inverse=True)
    known = sizes > 0
    bags = [(ids[known[ids]], n[known[ids]]) for ids, n in bags]
    table = (rng.random((len(used), dims), np.float32) - 0.5) / dims
    soft, bias = np.zeros((dims, 2), np.float32), np.zeros(2, np.float32)
    g_table, g_soft, g_bias = np.full((len(used), 1), 1e-8, np.float32), np.full((dims, 2), 1e-8, np.float32), np.full(2, 1e-8, np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            docs = order[at:at + batch]
            own = np.unique(np.concatenate([bags[d][0] for d in docs]))
            where = _ranges(starts[own], sizes[own])
            cuts = np.concatenate([[0], np.cumsum(sizes[own])[:-1]]).astype(np.int64)
            rows = flat[where]
            mix = np.zeros((len(docs), len(own)), np.float32)
            for i, d in enumerate(docs):
                mix[i, np.searchsorted(own, bags[d][0])] = bags[d][1]
            vec = np.add.reduceat(table[rows], cuts, axis=0) / sizes[own][:, None] if len(own) else np.zeros((0, dims), np.float32)
            hidden = mix @ vec
            z = hidden @ soft + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            d_z = p
            d_z[np.arange(len(docs)), y[docs]] -= 1
            d_z /= len(docs)
            d_soft, d_bias = hidden.T @ d_z, d_z.sum(axis=0)
            d_word = (mix.T @ (d_z @ soft.T)) / sizes[own][:, None]
            d_rows = np.repeat(d_word, sizes[own], axis=0)
            touched, back = np.unique(rows, return_inverse=True)
            grad = np.stack([np.bincount(back, d_rows[:, k], len(touched)) for k in range(dims)], axis=1).astype(np.float32)
            g_table[touched] += (grad * grad).mean(axis=1, keepdims=True)
            table[touched] -= rate * grad / np.sqrt(g_table[touched])
            g_soft += d_soft * d_soft
            soft -= rate * d_soft / np.sqrt(g_soft)
            g_bias += d_bias * d_bias
            bias -= rate * d_bias / np.sqrt(g_bias)
    # drawn towards the share of label 1, the more so the fewer texts the rarer class has
    rarer = min(int(y.sum()), len(y) - int(y.sum()))
    trust = rarer ** 2 / (rarer ** 2 + SHRINK ** 2)
    weight = np.zeros(1 << SLOT_BITS, np.float32)
    weight[used] = table @ (soft[:, 1] - soft[:, 0]) * np.float32(trust)
    return Model(weight, trust * float(bias[1] - bias[0]) + (1 - trust) * math.log(share / (1 - share)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted`` of each of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            s = np.array([m.score(t.as_py()) for t in batch.column(1)], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, predicted int")
