"""Ranked lexical search over document-sharded CSR postings.

``build`` reads the documents twice.  The first pass counts documents with terms and terms (two numbers a
task); the second turns blocks of texts into shards: sorted term hashes, row starts, document places and
integer impacts, which need the two totals alone.  A shard is one row of a written table, about ``SHARD`` bytes
of text, so a lost executor costs a few shards.  A term's weight depends on its document count and is the same
in every shard; it multiplies a term's impacts when they are added up.

``search`` goes over the shards with a block of queries at a time (``QUERIES`` or ``QUERY_BYTES`` of them, broadcast; a bound
that does not depend on the corpus): one pass over the terms for document counts, one that adds up each query's
terms, term by term, in a dense numpy array of the shard, and selects by argpartition every document that
reaches the k-th score, ties included, before the exact order decides.  A task merges its shards; two rounds of
ranked windows merge the tasks, so no task meets more than a few thousand rows of a query.

Terms are known by 64-bit hashes: among a million query terms and 10^10 terms of a corpus, some 0.0005
are expected to meet a stranger's hash.

Defined cases: null texts and texts without a term are in no result and not counted; whole texts count, a
longer one than a shard is a shard alone; equal scores go to the lesser id, rows without an id last; repeated
rows are documents of their own and rank one after the other; a query without a term, or of unknown terms, has
no row, one with a null text neither; repeated queries are answered one by one; empty tables give an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise
from .shingles import word_hashes

SHARD = 4 << 20
#: Queries, and bytes of them, that go over the shards together on average; their terms and weights are broadcast.
QUERIES = 2000
QUERY_BYTES = 16 << 20
TOP = 10
#: Tasks whose results one task of the first round merges.
MERGED = 64

#: bytes between terms: ASCII but digits and letters; every byte of a character beyond ASCII is part of a term
BETWEEN = np.ones(256, bool)
BETWEEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

_INDEX = "ids binary, known binary, terms binary, starts binary, places binary, impacts binary"


@dataclass
class Index:
    shards: DataFrame
    documents: int
    terms: int


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """``(ids, texts)`` of up to about ``SHARD`` bytes; rows without text are left out."""
    ids, texts, held = [], [], 0
    for batch in batches:
        column = batch.column(1).cast(pa.large_binary())
        for i, text in zip(batch.column(0).to_pylist(), column, strict=True):
            if not text.is_valid:
                continue
            text = text.as_py()
            if texts and held + len(text) > SHARD:
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(i)
            texts.append(text)
            held += len(text)
    if texts:
        yield ids, texts


def _terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every term of the texts, and the number of its text."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes, start = word_hashes(data, BETWEEN)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.searchsorted(ends, start, "right")


def counted(texts: list[bytes]) -> tuple[int, int]:
    """``(texts with a term, terms)``, from where terms start; nothing is hashed."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    inner = ~BETWEEN[data]
    inner[1:] &= BETWEEN[data[:-1]]
    start = np.flatnonzero(inner)
    ends = np.cumsum([len(t) + 1 for t in texts])
    before = np.searchsorted(start, ends)
    return int((np.diff(before, prepend=0) > 0).sum()), len(start)


def shard(ids: list, texts: list[bytes], documents: int, terms: int) -> list[bytes]:
    """One shard's columns, in the order of ``_INDEX``."""
    hashes, place = _terms(texts)
    length = np.bincount(place, minlength=len(texts))
    m = np.array([10 + 90 * n * documents // terms for n in length.tolist()], np.int64)
    order = np.argsort(hashes, kind="stable")  # places ascend within a term
    hashes, place = hashes[order], place[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (place[1:] != place[:-1])
    at = np.flatnonzero(new)
    tf = np.diff(np.append(at, len(hashes)))
    hashes, place = hashes[at], place[at]
    impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[place])
    unique, starts = np.unique(hashes, return_index=True)
    known = np.array([i is not None for i in ids], bool)
    return [x.tobytes() for x in (np.array([i or 0 for i in ids], np.int64), known, unique, np.append(starts, len(hashes)).astype(np.int64), place.astype(np.int32), impact.astype(np.int32))]


def build(docs: DataFrame, name: str = "search-index") -> Index:
    """The index of ``docs`` (doc_id, text), a written table under the session's shared folder."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = terms = 0
        for _, texts in _blocks(batches):
            own = counted(texts)
            documents += own[0]
            terms += own[1]
        yield pa.RecordBatch.from_pydict({"documents": pa.array([documents], pa.int64()), "terms": pa.array([terms], pa.int64())})

    total = docs.mapInArrow(count, "documents long, terms long").agg(F.sum("documents"), F.sum("terms")).first()
    documents, terms = total[0] or 0, total[1] or 0

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _INDEX.split(", ")]
        for ids, texts in _blocks(batches):
            columns = shard(ids, texts, documents, max(1, terms))
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], names)

    return Index(materialise(docs.mapInArrow(index, _INDEX), name), documents, terms)


def _queries(rows: list) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sorted distinct term hashes of the queries, and each query's places among them."""
    each = [np.unique(_terms([r["text"].encode()])[0]) for r in rows]
    vocabulary = np.unique(np.concatenate([*each, np.zeros(0, np.uint64)]))
    return vocabulary, [np.searchsorted(vocabulary, e) for e in each]


def _find(terms: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``vocabulary`` of what ``terms`` holds of it, and their places in ``terms``."""
    at = np.minimum(np.searchsorted(terms, vocabulary), max(0, len(terms) - 1))
    found = np.flatnonzero(terms[at] == vocabulary) if len(terms) else np.zeros(0, np.int64)
    return found, at[found]


def best(score: np.ndarray, ids: np.ndarray, known: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest positive scores, equal ones by id, those without an id last."""
    at = np.flatnonzero(score > 0)
    if len(at) > k:
        least = score[at[np.argpartition(score[at], len(at) - k)[len(at) - k]]]
        at = at[score[at] >= least]  # every tie of the k-th
    return at[np.lexsort((ids[at], ~known[at], -score[at]))[:k]]


def _search_block(index: Index, rows: list, kind: str, k: int) -> DataFrame:
    spark = index.shards.sparkSession
    vocabulary, queries = _queries(rows)
    shared = spark.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for t, s in zip(batch.column(0), batch.column(1), strict=True):
                found, at = _find(np.frombuffer(t.as_buffer(), np.uint64), shared.value)
                total[found] += np.diff(np.frombuffer(s.as_buffer(), np.int64))[at]
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(held, pa.int32()), "n": pa.array(total[held], pa.int64())})

    df = index.shards.select("terms", "starts").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    weight = np.zeros(len(vocabulary), np.int64)
    for r in df:
        weight[r["term"]] = math.floor(1000 * math.log((2 * index.documents + 2) / (2 * r["n"] + 1)))
    asked = spark.sparkContext.broadcast((vocabulary, weight, queries, [r["item_id"] for r in rows]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weight, queries, items = asked.value
        none = np.zeros(0, np.int64)
        top = [(none, none, none.astype(bool))] * len(queries)  # scores, ids, known
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                ids, known, terms, starts, places, impacts = (np.frombuffer(x.as_buffer(), t) for x, t in zip(row, (np.int64, bool, np.uint64, np.int64, np.int32, np.int32), strict=True))
                found, at = _find(terms, vocabulary)
                posting = {}
                for v, a in zip(found.tolist(), at.tolist(), strict=True):
                    if weight[v]:
                        s, e = starts[a], starts[a + 1]
                        posting[v] = places[s:e], impacts[s:e] * weight[v]
                for q, terms_of in enumerate(queries):
                    held = [posting[v] for v in terms_of.tolist() if v in posting]
                    if not held:
                        continue
                    score = np.zeros(len(ids), np.int64)
                    for at_places, value in held:
                        score[at_places] += value
                    b = best(score, ids, known, k)
                    merged = [np.concatenate(x) for x in zip(top[q], (score[b], ids[b], known[b]), strict=True)]
                    b = best(*merged, k)
                    top[q] = tuple(x[b] for x in merged)
        sizes = [len(t[0]) for t in top]
        if not sum(sizes):
            return
        score, ids, known = (np.concatenate(x) for x in zip(*top, strict=True))
        query = np.repeat(np.arange(len(top)), sizes)
        yield pa.RecordBatch.from_arrays([
            pa.array(query, pa.int32()), pa.array(np.full(len(query), TaskContext.get().partitionId() // MERGED), pa.int32()),
            pa.array([items[q] for q in query.tolist()], None if kind == "string" else pa.int64()), pa.array(ids, pa.int64(), mask=~known), pa.array(score, pa.int64())],
            ["query", "part", "item_id", "doc_id", "score"])

    out = index.shards.mapInArrow(run, f"query int, part int, item_id {kind}, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for keys in (["query", "part"], ["query"]):
        out = out.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)
    return out.select("item_id", "rank", "doc_id", "score")


def search(index: Index, queries: DataFrame, k: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the k best documents for each of ``queries`` (item_id, text)."""
    kind = "string" if dict(queries.dtypes)["item_id"] == "string" else "long"
    asked = queries.select(F.col("item_id").cast(kind), "text").filter("text is not null")
    size = asked.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-size[0] // QUERIES), -(-size[1] // QUERY_BYTES))
    if blocks > 1:
        asked = materialise(asked.withColumn("block", F.pmod(F.monotonically_increasing_id(), F.lit(blocks))), "queries")
    out = None
    for b in range(blocks):
        rows = asked.filter(F.col("block") == b).collect() if blocks > 1 else asked.collect()
        found = _search_block(index, rows, kind, k)
        out = found if out is None else out.unionByName(found)
    return out
