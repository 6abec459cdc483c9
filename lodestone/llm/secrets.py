"""Secret scanning with a trigram inverted index.

Each rule's regular expression is parsed and turned into a Boolean query over trigrams that any match must
hold: an AND of clauses, a clause being an OR of literals, a literal the AND of its trigrams.  The trigrams
that the queries mention are indexed: a written table of ``(trigram, document)`` postings of the lower-cased
texts, sorted by trigram.  Rules are answered by intersecting postings, all clauses in one pass: the lists of a
literal's trigrams are cut with each other, those of a clause's literals united, those of a rule's clauses cut
again.  Only candidates are searched with the expression itself.  A rule without mandatory trigrams searches
every text.  Built-in functions only.

Matches are leftmost and do not overlap within a rule; offsets are code points.  Places come from the lengths
of matches and of the text between them, summed in order, so a text with very many matches costs in
proportion.

Defined cases: null texts are empty and have no span; rows that share an id are told apart by a hash of the
text, repeated rows get the same spans; spans that start together are ordered as the rules are listed, then
by end; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as sre
from re import _parser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import KEY, doc_key, match, materialise

#: Candidates up to which their keys are broadcast to the texts (some 24 bytes each).
BROADCAST_KEYS = 1_000_000


@dataclass(frozen=True)
class Rule:
    """``group`` must have ``least`` characters, else the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("stripe", r"sk_live_[A-Za-z0-9]+", 0, 24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
)
RULES = BASE + MORE

Query = list[list[frozenset[str]]]
_MOST = 64


def trigram_query(pattern: str) -> Query:
    """Clauses that must all hold; a clause holds if all trigrams of one of its literals occur."""
    query: Query = []

    def close(runs: set[str]) -> None:
        """The runs of text read so far are whole: one of them is in any match."""
        if runs and all(len(x) >= 3 for x in runs):
            some = {frozenset(x[i:i + 3] for i in range(len(x) - 2)) for x in runs}
            query.append(sorted((x for x in some if not any(y < x for y in some)), key=sorted))  # a longer literal asks no less

    def exact(tree) -> set[str] | None:
        """All texts that ``tree`` can match, if they are few."""
        out = {""}
        for op, arg in tree:
            if op is sre.LITERAL:
                some = {chr(arg).lower()}
            elif op is sre.IN and len(arg) <= 4 and all(o is sre.LITERAL for o, _ in arg):
                some = {chr(c).lower() for _, c in arg}
            elif op is sre.SUBPATTERN:
                some = exact(arg[-1])
            elif op is sre.BRANCH:
                parts = [exact(x) for x in arg[1]]
                some = None if None in parts else set().union(*parts)
            elif op is sre.MAX_REPEAT and arg[1] == 1:
                some = exact(arg[2])
                some = some and some | {""}
            else:
                some = None
            if some is None or len(out) * len(some) > _MOST:
                return None
            out = {a + b for a in out for b in some}
        return out

    def walk(tree) -> None:
        runs = {""}
        for node in tree:
            some = exact([node])
            if some is not None and len(runs) * len(some) <= _MOST:
                runs = {a + b for a in runs for b in some}
                continue
            close(runs)
            runs = some if some is not None else {""}
            op, arg = node
            if some is None and op is sre.SUBPATTERN:
                walk(arg[-1])
            elif some is None and op is sre.MAX_REPEAT and arg[0] >= 1:
                walk(arg[2])
        close(runs)

    walk(list(_parser.parse(pattern)))
    return query


def vocabulary(rules: tuple[Rule, ...] = RULES) -> list[str]:
    return sorted({t for r in rules for clause in trigram_query(r.pattern) for literal in clause for t in literal})


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index: ``trigram, doc_id, text_hash`` for each of ``trigrams`` that a text holds."""
    low = docs.select(*doc_key(), F.lower("text").alias("low")).filter(F.col("low").isNotNull())
    held = F.array_compact(F.array(*[F.when(F.col("low").contains(t), F.lit(t)) for t in trigrams]))
    return low.select(*KEY, F.explode(held).alias("trigram"))


def asked(rules: tuple[Rule, ...] = RULES) -> list[tuple]:
    """``rule, clause, literal, trigram, held, clauses``: a row for each trigram of each literal of the queries."""
    rows = []
    for rule in rules:
        query = trigram_query(rule.pattern)
        for i, clause in enumerate(query):
            for j, literal in enumerate(clause):
                rows += [(rule.kind, i, j, t, len(literal), len(query)) for t in sorted(literal)]
    return rows


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, text_hash, rules``: the rules whose trigram query each document's postings answer.

    The queries are a small table, in proportion to the rules, and are broadcast to the index.  What is left of
    the lists is dealt by document once; the three steps of the intersection need no further exchange.
    """
    table = index.sparkSession.createDataFrame(asked(rules), "rule string, clause int, literal int, trigram string, held int, clauses int")
    lists = index.join(F.broadcast(table), "trigram").repartition(*KEY)
    literals = lists.groupBy(*KEY, "rule", "clauses", "clause", "literal", "held").agg(F.collect_set("trigram").alias("t")).filter(F.size("t") == F.col("held"))
    whole = literals.groupBy(*KEY, "rule", "clauses").agg(F.collect_set("clause").alias("c")).filter(F.size("c") == F.col("clauses"))
    return whole.groupBy(*KEY).agg(F.collect_set("rule").alias("rules"))


def _matches(texts: DataFrame, rule: Rule, order: int) -> DataFrame:
    """``doc_id, text_hash, kind, ord, start, end`` of a rule's matches in ``texts``."""
    rx = F.lit(rule.pattern)
    # a long run of one class can be asked for at once; the first filter is then as sharp as the rule
    sieve = f"{rule.pattern[:-1]}{{{rule.least},}}" if re.fullmatch(r"\[[^]]*\]\+", rule.pattern) else rule.pattern
    some = texts.filter(F.col("text").rlike(sieve))
    some = some.select(
        *KEY,
        F.transform(F.split("text", rule.pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all("text", rx, F.lit(0)), F.length).alias("long"),
        F.transform(F.regexp_extract_all("text", rx, F.lit(rule.group)), F.length).alias("held")).dropDuplicates(KEY)
    each = some.select(*KEY, F.posexplode(F.arrays_zip("gap", "long", "held")).alias("i", "m")).select(*KEY, "i", "m.*")
    before = Window.partitionBy(*KEY).orderBy("i")
    end = F.sum(F.col("gap") + F.coalesce("long", F.lit(0))).over(before)
    each = each.withColumn("end", end).filter(F.col("held") >= rule.least)
    return each.select(*KEY, F.lit(rule.kind).alias("kind"), F.lit(order).alias("ord"), (F.col("end") - F.col("long")).alias("start"), "end")


def spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """``doc_id, text_hash, kind, ord, start, end``: every span of every document, through the index."""
    texts = docs.select(*doc_key(), "text").filter(F.col("text").isNotNull())
    indexed = tuple(r for r in rules if trigram_query(r.pattern))
    out = None
    if indexed:
        index = materialise(postings(docs, vocabulary(indexed)).sortWithinPartitions("trigram"), "trigram-index")
        cands = materialise(candidates(index, indexed), "secret-candidates")
        small = cands.count() <= broadcast_keys
        chosen = match(texts, F.broadcast(cands) if small else cands, KEY)
    for order, rule in enumerate(rules):
        among = chosen.filter(F.array_contains("rules", rule.kind)) if rule in indexed else texts
        some = _matches(among, rule, order)
        out = some if out is None else out.unionByName(some)
    return out


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, text_hash, spans`` for each of ``docs``; spans are ordered (start, ord, end, kind)."""
    found = spans(docs, rules).groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("start", "ord", "end", "kind"))).alias("spans"))
    return match(docs.select(*doc_key()), found, KEY, "left").withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<start:bigint,ord:int,end:bigint,kind:string>>")))
