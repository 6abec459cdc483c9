"""Benchmark decontamination with a broadcast hash set of normalised n-grams.

Texts are lower-cased (A-Z) and cut into words of letters and digits.  Each benchmark item gives its windows
of 13 words, or itself if shorter.  Two sets of the windows' hashes go to the executors.  A set of bits, of
bounded size, travels in the plan: each document's windows are hashed and held against it inside one array
expression, so that a text is cut once, gives one row however long it is, and only the windows that the bits let
through leave it, with their words.  These meet the windows themselves by hash and words: by broadcast up to
``broadcast_windows`` of them, after a count, else by a shuffle of what the bits let through.  Built-in
functions only.

Defined cases: null or wordless texts have no word, no hit and are never contaminated; wordless items give no
window; documents shorter than an item's window do not hold it; items with equal text all count; rows that
share an id are told apart by a hash of the text, and repeated rows are judged alike; an empty benchmark hits
nothing; an empty corpus gives no rows; extra columns pass through unharmed whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import KEY, ascii_lower, doc_key, match, materialise, small_side, window_hash, with_hashes

WINDOW = 13
#: Benchmark windows up to which they are broadcast; a window takes some 300 bytes.
BROADCAST_WINDOWS = 500_000
#: Bits for each benchmark window, and at most: beyond some 2 million windows more get through to be compared.
BITS_EACH, MOST_BITS = 16, 1 << 24
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``hash, words, size, items``: each window of the benchmark once, with the items that have it."""
    cut = items.select("item_id", item_words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    cut = cut.select("item_id", F.expr(f"explode(if(size(w) < {size}, array(w), transform(sequence(1, size(w) - {size} + 1), i -> slice(w, i, {size}))))").alias("words"))
    cut = cut.groupBy("words").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    hashes = [F.when(F.size("words") == k, window_hash(k, F.lit(0))) for k in range(1, size + 1)]
    return with_hashes(cut, "words").select(F.coalesce(*hashes).alias("hash"), "words", F.size("words").alias("size"), "items")


def _bits(bench: DataFrame, n: int) -> tuple[Column, int]:
    """The set of the windows' hashes as an array of 64-bit words, and its mask; at most ``MOST_BITS`` / 64 rows are collected."""
    size = min(MOST_BITS, max(1 << 12, 1 << (BITS_EACH * n).bit_length()))
    place = F.col("hash").bitwiseAND(F.lit(size - 1))
    bit = F.expr(f"shiftleft(1L, cast((hash & {size - 1}L) % 64 as int))")
    words = ["0"] * (size // 64)
    for r in bench.groupBy(F.shiftright(place, 6).cast("int").alias("i")).agg(F.bit_or(bit).alias("word")).collect():
        words[r["i"]] = str(r["word"])
    return F.split(F.lit(",".join(words)), ",").cast("array<bigint>"), size - 1


def probe(docs: DataFrame, bench: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """``doc_id, text_hash, n_words, near``: a row for each of ``docs``, with the windows that the bits let through."""
    cut = with_hashes(docs.select(*doc_key(), item_words(F.col("text")).alias("w")), "w")
    near = F.array().cast("array<struct<at:int,hash:bigint,size:int,words:array<string>>>")
    if sizes:
        bits, mask = _bits(bench, sum(sizes.values()))

        def let_through(h: Column) -> Column:
            place = h.bitwiseAND(F.lit(mask))
            return F.getbit(F.get(bits, F.shiftright(place, 6).cast("int")), place.bitwiseAND(F.lit(63))) == 1

        def some(k: int) -> Column:
            hashes = F.when(F.size("w") >= k, F.transform(F.sequence(F.lit(0), F.size("w") - k), lambda i: window_hash(k, i)))
            at = F.array_compact(F.transform(hashes, lambda h, i: F.when(let_through(h), F.struct(i.alias("at"), h.alias("hash")))))
            return F.coalesce(F.transform(at, lambda x: F.struct(
                x.at.alias("at"), x.hash.alias("hash"), F.lit(k).alias("size"), F.array(*[F.get("w", x.at + j) for j in range(k)]).alias("words"))), near)

        near = F.concat(*[some(k) for k in sorted(sizes)])
    return cut.select(*KEY, F.size("w").cast("long").alias("n_words"), near.alias("near"))


def _judged(docs: DataFrame, items: DataFrame, size: int, broadcast_windows: int) -> tuple[DataFrame, DataFrame]:
    """The written table of :func:`probe`; ``doc_id, text_hash, spans, items`` of the documents in which a window occurs."""
    bench = materialise(windows(items, size), "windows")
    sizes = {r["size"]: r["n"] for r in bench.groupBy("size").agg(F.count("*").alias("n")).collect()}
    probed = materialise(probe(docs, bench, sizes), "probed")
    let = probed.select(*KEY, F.explode("near").alias("x")).select(*KEY, "x.*")
    held = bench.select("hash", "words", "items")
    found = let.join(F.broadcast(held) if sum(sizes.values()) <= broadcast_windows else held, ["hash", "words"])
    return probed, found.groupBy(*KEY).agg(
        F.sort_array(F.collect_set(F.struct("at", "size"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))


def hits(docs: DataFrame, items: DataFrame, size: int = WINDOW, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """``doc_id, text_hash, spans, items`` of the documents in which a window occurs; spans are (start, size) in words."""
    return _judged(docs, items, size, broadcast_windows)[1]


def judge(docs: DataFrame, items: DataFrame, size: int = WINDOW, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """A row for each of ``docs``: ``doc_id, text_hash, n_words, n_hit, items, spans, contaminated``."""
    probed, found = _judged(docs, items, size, broadcast_windows)
    n_hit = F.expr("aggregate(spans, struct(0L as n, 0 as last), (a, s) -> struct(a.n + greatest(0, s.at + s.size - greatest(a.last, s.at)) as n, greatest(a.last, s.at + s.size) as last), a -> a.n)")
    out = match(probed.drop("near"), found, KEY, "left").withColumn("n_hit", F.coalesce(n_hit, F.lit(0).cast("long")))
    return out.withColumn("items", F.coalesce("items", F.array().cast("array<string>"))).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without the contaminated documents, whose keys are broadcast after a count; else joined by a shuffle."""
    bad = materialise(judge(docs, items, size).filter("contaminated").select(*KEY).distinct(), "contaminated")
    keyed = docs.select(F.struct("*").alias("__row"), *doc_key())
    return match(keyed, small_side(bad), KEY, "left_anti").select("__row.*")


def cut_spans(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` with the hit words of every document taken out of its text; the rest is left as it was."""
    found = hits(docs, items, size).select(*KEY, "spans")
    keyed = match(docs.select(F.struct("*").alias("__row"), *doc_key()), found, KEY, "left")
    between = "split(__row.text, '[^\\\\x00-\\\\x2F\\\\x3A-\\\\x40\\\\x5B-\\\\x60\\\\x7B-\\\\x7F]+', -1)"
    words = "array_remove(split(__row.text, '[\\\\x00-\\\\x2F\\\\x3A-\\\\x40\\\\x5B-\\\\x60\\\\x7B-\\\\x7F]+'), '')"
    cut = keyed.withColumn("__hit", F.expr("array_distinct(flatten(transform(spans, s -> sequence(s.at, s.at + s.size - 1))))"))
    cut = cut.withColumn("__w", F.when(F.col("spans").isNotNull(), F.expr(words))).withColumn("__b", F.when(F.col("spans").isNotNull(), F.expr(between)))
    cut = cut.withColumn("__left", F.expr("case when spans is not null then array_except(sequence(0, size(__w) - 1), __hit) end"))
    text = F.when(F.col("spans").isNull(), F.col("__row.text")).otherwise(
        F.expr("concat(get(__b, 0), array_join(transform(__left, i -> concat(get(__w, i), get(__b, i + 1))), ''))"))
    return cut.withColumn("__row", F.col("__row").withField("text", text)).select("__row.*")
