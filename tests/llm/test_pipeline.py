"""The whole pipeline, its stages in order and reread from Parquet, against plain Python."""

import zlib

import numpy as np
from test_operators import WORD, base_quality, components, item_words, lpf_gone

import corpus_pipeline
from lodestone.llm import packing, quality, queries


def good(text):
    n, chars, symbols, dup, repeated = base_quality(text)
    if n < 20 or 100 * repeated > 30 * n:
        return False
    lines = [x for x in text.split("\n") if WORD.search(x)]
    stop = sum(w.lower() in quality.STOP_WORDS for w in WORD.findall(text))
    return 2 <= chars / n <= 25 and symbols / n <= 0.1 and (n < 200 or stop / n >= 0.005) and dup / len(lines) <= 0.5


def pieces(texts, cap=packing.CAP):
    tok = packing.tokenizer_of(packing.TOKENIZER).tokenizer
    out = set()
    for i, t in texts.items():
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        out |= {(i, k, a, len(ids[a:a + cap]), zlib.crc32(ids[a:a + cap].tobytes())) for k, a in enumerate(range(0, len(ids), cap))}
    return out


def test_pipeline_and_packing_query(spark, texts, tmp_path):
    texts = {i: t and t.replace("\n", " the\n") for i, t in texts.items()}
    texts[900] = " | ".join(f"reading{k}" for k in range(60))
    items = {1: " ".join([t for t in texts.values() if t and 20 < len(t.split()) < 100][0].split()[:15])}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    names = ("doc_id", "piece", "start", "length", "ids_crc32")

    left = {i: t for i, t in texts.items() if good(t)}
    gone = lpf_gone(left, 50)
    left = {i: "\n".join(x for p, x in enumerate(t.split("\n")) if (i, p) not in gone) for i, t in left.items()}
    left = {i: t for i, t in left.items() if WORD.search(t)}
    left = {i: left[i] for i, (_, c) in components(left).items() if c == i}
    passage = [tuple(item_words(items[1])[k:k + 13]) for k in range(len(item_words(items[1])) - 12)]
    clean = {}
    for i, t in left.items():
        w = item_words(t)
        hit = {q for p in range(len(w) - 12) if tuple(w[p:p + 13]) in passage for q in range(p, p + 13)}
        if not hit or 20 * len(hit) < len(w):
            clean[i] = t
    assert 900 not in clean and gone and 0 < len(clean) < len(left)
    got = [tuple(r[n] for n in names) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert len(got) == len(set(got)) and set(got) == pieces(clean)
    every = [tuple(r[n] for n in names) for r in queries.op9_best_fit_packing(spark, str(tmp_path)).collect()]
    assert len(every) == len(set(every)) and set(every) == pieces(texts)
