"""Sets of shingles do not depend on how texts are taken."""

import random

import numpy as np
import pyarrow as pa

from lodestone.llm import shingles


def test_long_texts_are_cut_between_words(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join("x" * rng.randrange(1, 30) + str(rng.randrange(9)) for _ in range(n)) for n in (400, 3, 0, 50)] + ["y" * 700 + " a b c d " + "z" * 300, " " * 500 + "a", "w" * 600, None]
    whole = list(shingles.shingle_sets(pa.array(texts, pa.string())))
    monkeypatch.setattr(shingles, "BLOCK", 128)
    monkeypatch.setattr(shingles, "_powers", np.ones(1, np.uint64))
    parts = list(shingles.shingle_sets(pa.array(texts, pa.string())))
    assert len(whole) == len(parts) == len(texts) and all((a == b).all() for a, b in zip(whole, parts))
    assert len(shingles._powers) == 129
