"""Interval overlap join, ranked search and document fingerprints against brute force, and their defined cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import duckdb
import numpy as np
import pytest

from lodestone.llm import fingerprints, intervals, oracle, queries, search

CLICKS = "click_id long, ts timestamp_ntz, client_id long, kind string, salt string, `from` string"
SALES = "sale_id long, client_id long, status string, sold_at timestamp_ntz, open string, crc string"
LINES = "sale_id long, shipped_at timestamp_ntz, first string"
EPOCH = datetime(1970, 1, 1)
QUARTER = timedelta(minutes=15)


def shop(seed):
    """Few clients, one of them in half of the rows; nulls, repeats, gaps of exactly a quarter, times before 1970."""
    rng = random.Random(seed)
    start = datetime(2024, 3, 30, 20)
    at = lambda days: start + timedelta(seconds=rng.randrange(int(days * 86400)), microseconds=rng.choice([0, 1, 999999]))
    client = lambda: rng.choice([7, 7, 7, 1, 2, 3, None])
    clicks = [(i, rng.choice([at(3), at(0.2), None]), client(), rng.choice(["view", "error", None, "click"])) for i in range(400)]
    chain = [start + timedelta(days=1) + QUARTER * i for i in range(120)]  # one session of more than a day, by the narrowest gaps
    clicks += [(1000 + i, t, 2, "view") for i, t in enumerate(chain)] + [(2000, chain[-1], 2, "error"), (2001, chain[-1] + QUARTER + timedelta(microseconds=1), 2, "view")]
    clicks += [(3000 + i, EPOCH - timedelta(hours=7 * i), 3, "view") for i in range(5)] + clicks[:20]
    sales = [(i, client(), rng.choice(["open", "done", None]), rng.choice([at(4), at(0.5), None])) for i in range(120)]
    sales += [(900, 3, "open", EPOCH - timedelta(hours=9)), (None, 7, "done", start)] + sales[:3]
    lines = [(rng.choice([s[0] for s in sales] + [5, 5, 5]), rng.choice([at(6), None])) for _ in range(300)]
    return clicks, sales, lines


def overlaps(clicks, sales, lines):
    us = lambda t: (t - EPOCH) // timedelta(microseconds=1)
    slot = lambda t: us(t) // (6 * 3600 * 1_000_000)
    sessions = defaultdict(list)
    for _, t, c, kind in sorted((x for x in clicks if x[1] and x[2] is not None), key=lambda x: x[1]):
        if not sessions[c] or t - sessions[c][-1][1] > QUARTER:
            sessions[c].append([t, t, False])
        s = sessions[c][-1]
        s[2] = (kind == "error") or (s[2] and s[1] == t)
        s[1] = t
    out = defaultdict(lambda: [0, None, 0])
    for i, c, status, t in sales:
        if c is None or t is None:
            continue
        z = max([t] + [y for x, y in lines if x == i and x is not None and y])
        a, b = slot(t), math.inf if status == "open" else slot(z)
        for f, last, is_open in sessions[c]:
            p, q = slot(f), math.inf if is_open else slot(last)
            if a > q or p > b:
                continue
            names = [["overlaps", "finished_by", "contains"], ["starts", "equals", "started_by"], ["during", "finishes", "overlapped_by"]]
            row = out[i, names[(a > p) - (a < p) + 1][(b > q) - (b < q) + 1]]
            row[0] += 1
            if min(b, q) < math.inf:
                row[1] = (row[1] or 0) + min(b, q) - max(a, p) + 1
            row[2] += zlib.crc32(str(us(f)).encode())
    return {k: tuple(v) for k, v in out.items()}


def frames(spark, clicks, sales, lines):
    return (spark.createDataFrame([(*x, "s", "t") for x in sales], SALES), spark.createDataFrame([(*x, "f") for x in lines], LINES),
            spark.createDataFrame([(*x, "s", "t") for x in clicks], CLICKS))


@pytest.mark.parametrize("seed, parts, zone", [(1, 1000, "UTC"), (2, 3, "America/Sao_Paulo"), (3, 50, "Europe/Berlin")])
def test_overlaps(spark, seed, parts, zone):
    data = shop(seed)
    spark.conf.set("spark.sql.session.timeZone", zone)  # 31 March 2024 has no 2:30 in Berlin
    try:
        got = {(r.sale_id, r.relation): (r.n_pairs, r.overlap_slots, r.sessions_crc) for r in intervals.overlaps(*frames(spark, *data), parts=parts).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == overlaps(*data) and len({k[1] for k in got}) >= 7


def test_overlaps_of_empty_tables(spark):
    clicks, sales, lines = shop(4)
    assert intervals.overlaps(*frames(spark, [], sales, lines)).collect() == intervals.overlaps(*frames(spark, clicks, [], lines)).collect() == []
    got = intervals.overlaps(*frames(spark, clicks, sales, [])).collect()
    assert {(r.sale_id, r.relation): (r.n_pairs, r.overlap_slots, r.sessions_crc) for r in got} == overlaps(clicks, sales, [])


def test_sql_agrees_with_brute_force(spark, tmp_path):
    clicks, sales, lines = shop(5)
    sales = [s for s in sales if s[0] is not None]
    for df, name in zip(frames(spark, clicks, sales, lines), ("sales", "sale_lines", "clicks"), strict=True):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    con = duckdb.connect()
    for name in ("sales", "sale_lines", "clicks"):
        con.sql(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.sql(oracle.OP11).fetchall()
    assert {(r[0], r[1]): r[2:] for r in want} == overlaps(clicks, sales, lines)
    assert sorted(map(tuple, queries.op11_interval_overlap_join(spark, str(tmp_path)).collect()), key=repr) == sorted(want, key=repr)


# ranked search


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def ranking(rows, items, k):
    docs = [(i, Counter(terms(t))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    total, length = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = Counter()
    for item, text in items:
        found = []
        for i, c, n in docs:
            m = 10 + 90 * n * total // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0))
        for rank, (score, none, i) in enumerate(sorted(found)[:k], 1):
            out[item, rank, None if none else i, -score] += 1
    return out


@pytest.mark.parametrize("bytes_, asked, merged", [(4 << 20, 2000, 64), (700, 3, 1)])
def test_search(spark, docs, texts, bytes_, asked, merged, monkeypatch):
    monkeypatch.setattr(search, "SHARD", bytes_)
    monkeypatch.setattr(search, "QUERIES", asked)
    monkeypatch.setattr(search, "MERGED", merged)
    more = [(None, "w1x Zeta zeta"), (None, "w1x Zeta zeta"), (9000, "w1x Zeta zeta"), (9000, "w1x Zeta zeta"), (9001, "Straße É_é-e\x00É 漢字" * 3), (-4, "zeta zeta w1x"), (9002, "w2x " * 40000)]
    items = [(1, texts[sorted(texts)[0]] or "w1x"), (2, "zeta"), (2, "zeta"), (3, None), (4, ""), (5, "nowhere unknownterm"), (6, "STRASSE straße É 漢字"), (7, "w2x w2x w3x"), (8, " ".join(f"w{i}x" for i in range(400)))]
    rows = list(texts.items()) + more
    asked_for = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    frame = docs.select("doc_id", "text", "n_words").unionByName(spark.createDataFrame([(i, t, 0) for i, t in more], "doc_id long, text string, n_words long")).repartition(5)
    for k in (1, 3, 10):
        got = search.search(search.build(frame), asked_for, k).collect()
        assert Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == ranking(rows, items, k)


def test_search_of_empty_tables(spark, docs, empty):
    none = spark.createDataFrame([], "item_id string, text string")
    some = spark.createDataFrame([("a", "w1x")], "item_id string, text string")
    assert search.search(search.build(empty), some).collect() == [] == search.search(search.build(docs), none).collect()
    assert {r.item_id for r in search.search(search.build(docs), some).collect()} == {"a"}


# fingerprints


def chunks(data):
    """Byte by byte: the gear hash begins anew with every chunk."""
    out, start, h = [], 0, 0
    for i, b in enumerate(data):
        h = (2 * h + int(fingerprints.GEAR[b])) & 0xFFFF
        n = i - start + 1
        ends = i + 1 == len(data) or data[i + 1] & 0xC0 != 0x80
        hit = fingerprints.LEAST <= n < fingerprints.NORMAL and not h & int(fingerprints.HARD) or fingerprints.NORMAL <= n and not h & int(fingerprints.EASY) or n >= fingerprints.MOST
        if ends and hit or i + 1 == len(data):
            out.append(bytes(data[start:i + 1]))
            start, h = i + 1, 0
    return out


def share(a, b):
    a, b = set(chunks(a)), set(chunks(b))
    return sum(map(len, a & b)) / sum(map(len, a)) if a else float(not b)


@pytest.mark.parametrize("block", [1 << 20, 700])
def test_chunks(texts, block, monkeypatch):
    monkeypatch.setattr(fingerprints, "BLOCK", block)
    rng = random.Random(3)
    more = ["a" * 3000, "é漢😀" * 500, "x", "".join(chr(rng.randrange(32, 1000)) for _ in range(5000)), "ab" * 63, "abc" * 43]
    for t in [t for t in texts.values() if t] + more:
        data = t.encode()
        starts = fingerprints.chunk_starts(np.frombuffer(data, np.uint8), np.array([len(data)])).tolist()
        own = chunks(data)
        assert [data[a:b] for a, b in zip(starts, starts[1:])] == own
        print_ = fingerprints.fingerprints([data])[0]
        assert len(print_) == len(set(own)) and sorted((print_ & np.uint64(0xFF)).tolist()) == sorted(map(len, set(own)))
        assert (fingerprints.from_text(fingerprints.as_text(print_)) == print_).all()
    together = [(t or "").encode() for t in texts.values()] + [m.encode() for m in more]
    for data, print_ in zip(together, fingerprints.fingerprints(together), strict=True):
        assert (print_ == fingerprints.fingerprints([data])[0]).all()


def compared(rows):
    """The stated job in plain Python; rows of one id by Spark's hash of the text are left to the caller."""
    out = {}
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        changed = (t[:len(t) - half] + after[:half]).encode()
        out[i] = len(t), hashlib.sha256(changed).hexdigest(), share(t.encode(), changed), share(t.encode(), after.encode())
    return out


@pytest.mark.parametrize("parts", [8, 1, 60])
def test_compare_next(spark, docs, texts, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r.doc_id: r for r in fingerprints.compare_next(docs.repartition(3)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    want = compared(sorted(((i, t or "") for i, t in texts.items()), reverse=True))
    assert got.keys() == want.keys()
    for i, (n, digest, near, far) in want.items():
        assert (got[i].n_chars, got[i].edited_sha256, got[i].near_edited, got[i].near_next) == (n, digest, pytest.approx(near), pytest.approx(far))
        assert got[i].fingerprint == fingerprints.as_text(fingerprints.fingerprints([(texts[i] or "").encode()])[0])
    alone = {r.doc_id: (r.n_chars, r.fingerprint) for r in fingerprints.fingerprint(docs).collect()}
    assert alone == {i: (r.n_chars, r.fingerprint) for i, r in got.items()}


def test_repeated_rows_and_ids(spark, docs, empty):
    assert fingerprints.compare_next(empty).collect() == []
    one = fingerprints.compare_next(docs.filter("doc_id = 4")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    rows = [(None, "last text here"), (None, "last text here"), (5, "five five five"), (5, "five five five"), (-(1 << 63), "least of all"), ((1 << 63) - 1, "most of all"), (5, "other of five"), (3, None)]
    got = fingerprints.compare_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    digests = Counter(r.edited_sha256 for r in got)
    changed = lambda a, b: hashlib.sha256(fingerprints.edited(a, b).encode()).hexdigest()
    for a, b in (("most of all", "five five five"), ("most of all", "other of five")):
        if digests[changed(a, b)]:
            break
    else:
        raise AssertionError("the row after the largest id is one of the next id")
    assert digests[changed("last text here", "last text here")] >= 1 and digests[changed("last text here", "most of all")] == 1 and digests[changed("least of all", "last text here")] == 1


def test_containment_shifts(texts):
    """A few characters put in, and a part cut out, leave most chunks as they were."""
    t = next(t for t in texts.values() if t and len(t) > 20000)
    own = fingerprints.fingerprints([t.encode()])[0]
    moved = fingerprints.fingerprints([("xyz" + t[:9000] + "—" + t[9500:]).encode()])[0]
    assert 0.85 < fingerprints.containment(own, moved) < 1 and fingerprints.containment(own, own) == 1
