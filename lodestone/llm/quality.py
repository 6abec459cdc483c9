"""Quality rules: one table of thresholds, compiled into one projection of built-in expressions.

``MEASURES`` are SQL expressions over a row's text; ``RULES`` say which measure may lie in which range from
how many words on.  ``verdict`` turns the table into a single Boolean column.  No user function, no shuffle:
a scan with a projection, which scales as the input does.

Words are ``[^\\x20\\x09-\\x0D]+``.  Repeated words are those in windows of eight words that the text has
twice or more; window starts are found by sorting the 64-bit hashes of the windows, and only in texts that
have a repeated hash at all.

Defined cases: null text has no words and fails for its length; blank text likewise; a text of under eight
words has no window; repeated rows are judged alike; extra columns are kept, and a column of
the caller's that is named like one of those added (``quality``, ``base_failed``, ``kept``) is replaced; an empty
table stays empty.  A text of 200 words or more in a language whose common words are not listed is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import window_hash, with_hashes, words_of

WINDOW = 8
#: Common words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is it for on with by was are this that from as at be an not or "
    "le la les de des du un une et en pour par sur dans qui que est pas au aux il elle "
    "der die das und von zu mit den dem ein eine ist nicht sich auf für im als auch bei "
    "el los las una y por con para se del al es lo su"
).split()

#: name: (measure, least, most, from how many words on).  None: no bound.  The rules reject only what no prose
#: is: symbol soup, one word without end, texts that are mostly repeated lines or bullets.  Symbols are held
#: against words, at most one to ten: against characters, the bars of a menu ("word | word") would hide.
RULES: dict[str, tuple[str, float | None, float | None, int]] = {
    "mean_word_chars": ("word_chars / n_words", 2.0, 25.0, 20),
    "symbol_share": ("n_symbols / n_words", None, 0.1, 20),
    "stop_word_share": ("n_stop_words / n_words", 0.005, None, 200),
    "repeated_line_share": ("n_dup_lines / n_lines", None, 0.5, 20),
    "bullet_line_share": ("n_bullet_lines / n_lines", None, 0.9, 20),
}


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one more column, the struct ``quality`` of all measures."""
    packed = docs.select(F.struct("*").alias("__row"), F.col(text).alias("__text"))
    t, words = F.coalesce(F.col("__text"), F.lit("")), "__words"
    out = with_hashes(packed.withColumn(words, words_of("__text")).withColumn("__n", F.size(words)), words)
    starts = F.when(F.col("__n") >= WINDOW, F.sequence(F.lit(0), F.col("__n") - WINDOW)).otherwise(F.array().cast("array<int>"))
    out = out.withColumn("__w", F.transform(starts, lambda i: window_hash(WINDOW, i)))
    out = out.withColumn("__lines", F.expr(r"filter(split(coalesce(%s, ''), '\n', -1), l -> l rlike '[^\\x20\\x09-\\x0D]')" % "__text"))
    out = out.withColumn("__q", F.struct(
        F.col("__n").cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.size(F.regexp_extract_all(t, F.lit("[#*$%&|<>]"), F.lit(0))).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.size("__lines").cast("long").alias("n_lines"),
        F.expr(r"size(filter(__lines, l -> l rlike '^\\s*[-*•] '))").cast("long").alias("n_bullet_lines"),
        F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
    ))
    out = out.withColumn("__d", F.expr("case when size(array_distinct(__w)) < size(__w) then sort_array(transform(__w, (h, i) -> struct(h, i))) end"))
    out = out.drop("__words", "__lines", "__h", "__h4", "__w", "__n")
    out = out.withColumn("__p", F.expr("sort_array(transform(filter(__d, (x, i) -> get(__d, i - 1).h = x.h or get(__d, i + 1).h = x.h), x -> x.i))"))
    covered = F.expr(f"coalesce(aggregate(__p, struct(0L as n, -{WINDOW} as last), (a, p) -> struct(a.n + least({WINDOW}, p - a.last) as n, p as last), a -> a.n), 0L)")
    # names are compared as Spark compares them, without regard to case
    own = [F.col("__row")[c].alias(c) for c in docs.columns if c.lower() != "quality"]
    # the counter keeps the optimiser from pushing filters, and with them every measure, below the projections,
    # where arrays would be built for each element of others
    fixed = F.when(F.monotonically_increasing_id() >= 0, F.struct("__q.*", covered.alias("n_repeat_words")))
    return out.select(*own, fixed.alias("quality"))


def base_failed(q: str = "quality") -> Column:
    return F.expr(f"{q}.n_words < 20 or 100 * {q}.n_repeat_words > 30 * {q}.n_words")


def verdict(q: str = "quality", rules: dict[str, tuple] = RULES) -> Column:
    """True where the text passes the base rule and every rule of the table."""
    ok = ~base_failed(q)
    for measure, least, most, words in rules.values():
        top, under = measure.split(" / ")
        value = F.try_divide(F.col(f"{q}.{top}").cast("double"), F.col(f"{q}.{under}").cast("double"))
        inside = F.lit(True)
        if least is not None:
            inside &= value >= least
        if most is not None:
            inside &= value <= most
        ok &= (F.col(f"{q}.n_words") < words) | F.coalesce(inside, F.lit(True))
    return ok


def judge(docs: DataFrame, text: str = "text", rules: dict[str, tuple] = RULES) -> DataFrame:
    """``docs`` with ``quality``, ``base_failed`` and ``kept``."""
    return measures(docs, text).withColumn("base_failed", base_failed()).withColumn("kept", verdict(rules=rules))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    packed = docs.select(F.struct("*").alias("__packed"), F.col(text).alias("__text"))
    return measures(packed, "__text").filter(verdict()).select("__packed.*")
