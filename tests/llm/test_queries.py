"""Every registered query over the whole of the smallest tables: against its SQL, or against plain Python where it has none."""

import math
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

from lodestone.llm import oracle, queries, secrets, toxicity

SF = Path("/root/testdata/sf0.001")
needs = pytest.mark.skipif(not SF.exists(), reason="needs the test tables")


def table(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


@needs
@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for p in SF.iterdir():
        con.sql(f"create view {p.stem} as select * from '{p}'")
    got = queries.queries()[name](spark, str(SF))
    cols = sorted(got.columns)
    want = con.sql(oracle.oracle_sql()[name])
    assert cols == sorted(want.columns)
    rows = sorted(repr(tuple(r[c] for c in cols)) for r in got.collect())
    assert rows == sorted(repr(r) for r in want.project(",".join(f'"{c}"' for c in cols)).fetchall())


def spans(text):
    out = []
    for order, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text or "", re.ASCII):
            if len(m.group(rule.group)) >= rule.least:
                out.append((m.start(), order, m.end(), rule.kind))
    return sorted(out)


def test_secret_query_against_re(spark, tmp_path):
    key = "AKIA" + "B7" * 9
    texts = {1: None, 2: "", 3: f"é token: abcdef {'0f' * 13} token=ghijkl {'ab' * 12}", 4: f"PASSWORD='x1y2z3' {key}{key} api_key=short", 5: "AKIA1 nothing", 6: "apikey : abcdefg\nsecret=" + "0a" * 14}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op3_secret_scan(spark, str(tmp_path)).collect()}
    for i, text in texts.items():
        want = spans(text)
        assert [got[i][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s[1] == k for s in want) for k in range(3)]
        assert got[i]["spans"] == ",".join(f"{k}:{a}:{b}" for a, _, b, k in want)


def slots(text):
    """How often each slot occurs, letter by letter: 1- to 4-grams of letters and the blanks beside them, none across a word."""
    letter = lambda c: (ord(c.lower()) if len(c.lower()) == 1 else ord(c)) if c.isalpha() else 0
    code = [0, *map(letter, text or ""), 0]
    if not any(code):
        return Counter()
    code = [c for k, c in enumerate(code) if c or code[k - 1] or code[(k + 1) % len(code)]]
    out = Counter()
    for n in range(1, 5):
        for k in range(len(code) - n + 1):
            gram = code[k:k + n]
            if n == 1 and not gram[0] or n > 2 and (0 in gram[1:-1] or k == len(code) - n):
                continue
            value = 0
            for size, c in enumerate(gram, 1):
                value = (value * 0x01000193 & 0xFFFFFFFF) ^ (c + size & 0xFFFFFFFF)
            out[(value * 0x9E3779B1 & 0xFFFFFFFF) >> 18] += 1
    return out


@needs
def test_language_query(spark):
    """Every prediction equals that of the same model in plain Python, and held-out ones are right."""
    docs = {r["doc_id"]: r for r in table("documents")}
    rows = queries.op6_language_id(spark, str(SF)).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in docs if zlib.crc32(str(i).encode()) % 4 == 2}
    known = [r for r in held if docs[r["doc_id"]]["lang"]]
    assert all(0 <= r["score"] <= 1 for r in rows) and sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in known) >= 0.95 * len(known)
    model = queries.language_model(spark.read.parquet(f"{SF}/documents.parquet"))
    for r in rows:
        if len(docs[r["doc_id"]]["text"] or "") > 20_000:
            continue  # the same by the letter, only slow here
        bag = slots(docs[r["doc_id"]]["text"])
        v = {k: (1 + math.log(n)) * model.idf[k] for k, n in bag.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        cosine = [sum(x / size * float(c[k]) for k, x in v.items()) for c in model.centroids.T] if v else []
        best = max(range(len(cosine)), key=cosine.__getitem__, default=None)
        if best is None:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["score"] == pytest.approx(cosine[best], abs=1e-4)
            assert r["lang_pred"] == model.languages[best] or sorted(cosine)[-1] - sorted(cosine)[-2] < 1e-4


@needs
def test_toxicity_query(spark):
    """Scores equal those of the same model in plain Python, averaged word by word and n-gram by n-gram."""
    docs = {r["doc_id"]: r["text"] for r in table("documents")}
    rows = {r["doc_id"]: r for r in queries.op2_toxicity(spark, str(SF)).collect()}
    assert rows.keys() == docs.keys()
    assert {i for i, r in rows.items() if r["held_out"]} == {i for i in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    model = queries.toxicity_model(spark, str(SF))
    for i in docs:
        votes = []
        for w in toxicity.words(docs[i]):
            who, slot = toxicity.grams([w])
            held = [float(model.weight[s]) for s in slot if model.weight[s] != 0]
            votes.append(sum(held) / len(held) if held else 0.0)
        p = 1 / (1 + np.exp(-((sum(votes) / len(votes) if votes else 0.0) + model.bias)))
        assert rows[i]["score"] == pytest.approx(p, abs=1e-4) and rows[i]["predicted"] == int(rows[i]["score"] >= 0.5)
