"""Best-two-fit packing of tokenised documents into fixed-length sequences.

Only numbers travel.  Texts become token counts and checksums where they are read (one Arrow pass); the
lengths, at most ``cap`` distinct ones, are counted; the packing plan is made on that histogram, which has
``cap`` rows however large the corpus is; and every piece finds its place from its rank among the pieces of
its length.  The rank is exact and has no hot key: each length is dealt over buckets, ranked inside the
bucket, and shifted by the counts of the buckets before it.

Best-two-fit, for each sequence: take the largest piece that fits, again and again; if a gap is left, try to
replace the smallest piece taken with two unpacked ones that fill the widened gap more tightly.  A pattern of
lengths found so is repeated while every length in it lasts, which gives what doing it one by one would.

Defined cases: null and empty texts are one piece, the closing id 0; a text of any length is tokenised whole
and only one longer than ``cap`` is cut; equal lengths are told apart by bucket, id and piece; repeated rows
are packed once each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import materialise

TOKENIZER = "word_bpe_49k.json"
CAP = 2048
#: Entries of each of the two word caches of a Python worker.
CACHE = 700_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_ASCII = re.compile("[a-z]+|[0-9]|[^a-z0-9]+")
_loaded: dict[str, "WordTokenizer"] = {}


class WordTokenizer:
    """The tokenizer's ids of whole texts, remembered by word.

    The tokenizer drops blanks and never joins what they part, so a text's ids are those of its words in
    turn.  A word of plain ASCII without an apostrophe is further cut into runs of letters, single digits
    and other runs, and lower-cased, as the tokenizer itself would.  All else is asked of the tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    @staticmethod
    def cut(word: str) -> list[str]:
        if "<|" in word or "'" in word:
            return [word]
        if word.isascii():
            return _ASCII.findall(word.lower())
        core = word.rstrip(".,;:!?")
        return [core, word[len(core):]] if core and len(core) < len(word) and core[-1].isalnum() else [word]

    def learn(self, words: set[str]) -> None:
        if len(self.parts) > CACHE:
            self.parts.clear()
        cuts = {w: self.cut(w) for w in words}
        new = {p for c in cuts.values() for p in c if p not in self.parts}
        accented, other = [], []
        for p in new:
            if not p.isalpha():
                other.append(p)
            elif p.isascii():  # the model sees such a word as it is
                self.parts[p] = np.array([t.id for t in self.model.tokenize(p)], "<u4").tobytes()
            else:
                accented.append(p)
        if accented:
            self._learn_words(accented)
        if other:
            self._learn_parts(other)
        for w, c in cuts.items():
            self.words[w] = self.parts[c[0]] if len(c) == 1 else b"".join([self.parts[p] for p in c])

    def _learn_words(self, some: list[str]) -> None:
        """Words of letters alone: encoded in one go, and parted where a token closes a word."""
        ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(some):  # a letter that the tokenizer takes for several words
            self._learn_parts(some)
            return
        flat, at = ids.tobytes(), 0
        for part, end in zip(some, (4 * ends).tolist(), strict=True):
            self.parts[part] = flat[at:end]
            at = end

    def _learn_parts(self, some: list[str]) -> None:
        for part, e in zip(some, self.tokenizer.encode_batch(some, add_special_tokens=False), strict=True):
            self.parts[part] = np.array(e.ids, "<u4").tobytes()

    def ids(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids of the whole text, then id 0."""
        words = (text or "").replace("\n", " ").split(" ")
        if len(self.words) > CACHE:
            self.words.clear()
        if new := set(words).difference(self.words):
            self.learn(new)
        return b"".join([self.words[w] for w in words]) + b"\0\0\0\0"


def tokenizer_of(name: str) -> WordTokenizer:
    if name not in _loaded:
        path = name
        if not os.path.isabs(name):
            import public_tokenizers

            path = public_tokenizers.path(name)
        _loaded[name] = WordTokenizer(str(path))
    return _loaded[name]


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, cap: int = CAP) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer_of(tokenizer)
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = tok.ids(text.as_py())
                for k, at in enumerate(range(0, len(ids), 4 * cap)):
                    part = ids[at:at + 4 * cap]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def best_two_fit(counts: dict[int, int], cap: int) -> list[tuple[int, list[int]]]:
    """Patterns ``(how many sequences, lengths in them)`` that use up ``counts``, a histogram of lengths."""
    size = cap + 1
    left = np.zeros(size, dtype=np.int64)
    for length, n in counts.items():
        left[length] += n
    out = []
    have = np.flatnonzero(left)
    while len(have):
        gap, used, largest = cap, {}, len(have)
        while gap:
            k = int(np.searchsorted(have[:largest], gap, side="right")) - 1
            if k < 0:
                break
            length = int(have[k])
            used[length] = min(gap // length, int(left[length]))
            gap -= length * used[length]
            largest = k
        spared = 0
        if gap:
            spared = min(used)
            rest = left.copy()
            for length, n in used.items():
                rest[length] -= n
            pair = _tightest_pair(rest, spared, gap + spared)
            if pair:
                used[spared] -= 1
                for length in pair:
                    used[length] = used.get(length, 0) + 1
                used = {length: n for length, n in used.items() if n}
            else:
                spared = 0
        times = max(1, min((int(left[length]) - (length == spared)) // n for length, n in used.items()))
        for length, n in used.items():
            left[length] -= n * times
        out.append((times, [length for length in sorted(used, reverse=True) for _ in range(used[length])]))
        have = have[left[have] > 0]
    return out


def _tightest_pair(rest: np.ndarray, above: int, room: int) -> tuple[int, int] | None:
    """Two unpacked lengths whose sum is the largest that is over ``above`` and at most ``room``."""
    have = np.flatnonzero(rest[:room])
    have = have[have > 0]
    if not len(have):
        return None
    at = np.searchsorted(have, room - have, side="right") - 1
    same = (at >= 0) & (have[np.maximum(at, 0)] == have) & (rest[have] < 2)
    at = at - same
    sums = np.where(at >= 0, have + have[np.maximum(at, 0)], 0)
    best = int(np.argmax(sums))
    return (int(have[best]), int(have[at[best]])) if sums[best] > above else None


class Plan:
    """Where the r-th piece of a length goes.  Its size depends on ``cap`` only."""

    def __init__(self, patterns: list[tuple[int, list[int]]]):
        slots: dict[int, list[tuple[int, int, int, list[int]]]] = {}
        taken: dict[int, int] = {}
        first = 0
        for times, lengths in patterns:
            places: dict[int, list[int]] = {}
            at = 0
            for length in lengths:
                places.setdefault(length, []).append(at)
                at += length
            for length, offsets in places.items():
                start = taken.get(length, 0)
                slots.setdefault(length, []).append((start, first, len(offsets), offsets))
                taken[length] = start + times * len(offsets)
            first += times
        self.sequences = first
        self.starts = {length: np.array([s[0] for s in x], np.int64) for length, x in slots.items()}
        self.firsts = {length: np.array([s[1] for s in x], np.int64) for length, x in slots.items()}
        self.widths = {length: np.array([s[2] for s in x], np.int64) for length, x in slots.items()}
        self.offset_at = {length: np.cumsum([0] + [s[2] for s in x]) for length, x in slots.items()}
        self.offsets = {length: np.array([o for s in x for o in s[3]], np.int64) for length, x in slots.items()}

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        seq, off = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
        for one in np.unique(length):
            at = np.flatnonzero(length == one)
            one = int(one)
            slot = np.searchsorted(self.starts[one], rank[at], side="right") - 1
            inside = rank[at] - self.starts[one][slot]
            width = self.widths[one][slot]
            seq[at] = self.firsts[one][slot] + inside // width
            off[at] = self.offsets[one][self.offset_at[one][slot] + inside % width]
        return seq, off


def ranked(df: DataFrame, key: str, order: list[str], buckets: int) -> DataFrame:
    """Adds ``rank``, from 0, among the rows of a key, without gathering a key in one task."""
    bucketed = df.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = bucketed.groupBy(key, "bucket").agg(F.count("*").alias("n"))
    before = counts.select(
        key, "bucket", (F.sum("n").over(Window.partitionBy(key).orderBy("bucket")) - F.col("n")).alias("before"))
    inside = bucketed.withColumn("inside", F.row_number().over(Window.partitionBy(key, "bucket").orderBy(*order)) - 1)
    return inside.join(before, [key, "bucket"]).withColumn("rank", F.col("before") + F.col("inside")).drop("bucket", "before", "inside")


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, cap: int = CAP, bucket_rows: int = 1_000_000) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``.  ``bucket_rows``: pieces of a length ranked in one task."""
    cut = materialise(pieces(docs, tokenizer, cap), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = Plan(best_two_fit(counts, cap))
    buckets = max(64, -(-max(counts.values(), default=0) // bucket_rows))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seq, off = plan.place(batch.column(3).to_numpy(), batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(seq), pa.array(off)], [*batch.schema.names[:5], "sequence_id", "offset"])

    order = ["doc_id", "piece", "start", "ids_crc32"]
    out = ranked(cut, "length", order, buckets).select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast(T.LongType()))
    return out.mapInArrow(place, PIECES + ", sequence_id long, offset long")
