"""Quality rules over the staged tables, reconciliation with published totals, and the verdict."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, field
from datetime import date
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import domains as D
from ..functions.columns import any_of

Tables = Mapping[str, DataFrame]
ERROR, WARNING = "ERRO", "AVISO"


class ValidationError(RuntimeError):
    """A rule that could not be evaluated."""


@dataclass(frozen=True)
class Rule:
    """``violations``: the rows of the tables that break the rule.

    ``row``, a table and a condition on its rows, or ``child``, a table whose rows need a work, say the same in a form that
    rules can share a pass by.
    """

    name: str
    severity: str
    violations: Callable[[Tables], DataFrame]
    row: tuple[str, Callable[[], Column]] | None = None
    child: str | None = None


def _row(name: str, severity: str, table: str, condition: Callable[[], Column]) -> Rule:
    return Rule(name, severity, lambda t: t[table].filter(condition()), row=(table, condition))


def _orphans(name: str, severity: str, child: str) -> Rule:
    return Rule(name, severity, lambda t: t[child].join(t["obras"].select("cno"), "cno", "left_anti"), child=child)


def _outside(column: str, domain) -> Callable[[], object]:
    return lambda: F.col(column).isNotNull() & ~F.col(column).isin(list(domain))


FLAGS = ("obra_ativa", "no_exterior", "uf_indefinida", "tem_plus_code", "area_suspeita", "datas_incoerentes")


def rules(today: date | None = None) -> list[Rule]:
    now = F.lit(today) if today else F.current_date()
    c = F.col
    return [
        Rule("obras.cno_unico", ERROR, lambda t: t["obras"].groupBy("cno").count().filter("count > 1")),
        _row("obras.cno_preenchido", ERROR, "obras", lambda: c("cno").isNull()),
        _orphans("areas.cno_existe_em_obras", ERROR, "areas"),
        _orphans("cnaes.cno_existe_em_obras", ERROR, "cnaes"),
        _orphans("vinculos.cno_existe_em_obras", ERROR, "vinculos"),
        _row("obras.situacao_no_dominio", ERROR, "obras", _outside("situacao_codigo", D.STATUSES)),
        _row("obras.situacao_traduzida", ERROR, "obras", lambda: c("situacao_codigo").isNotNull() & c("situacao").isNull()),
        _row("obras.uf_valida", ERROR, "obras", _outside("uf", D.STATES)),
        _row("obras.qualificacao_no_dominio", ERROR, "obras", _outside("qualificacao_codigo", D.QUALIFICATIONS)),
        _row("obras.flags_nunca_nulas", ERROR, "obras", lambda: any_of(c(f).isNull() for f in FLAGS)),
        _row("obras.responsavel_tipo_coerente", ERROR, "obras", lambda: (c("ni_responsavel").isNull() & (c("responsavel_tipo") != "PF")) | (c("ni_responsavel").isNotNull() & (c("responsavel_tipo") != "PJ"))),
        _row("obras.sem_datas_sentinela", ERROR, "obras", lambda: any_of(c(d).isin(date(1970, 1, 1), date(1900, 1, 1)) for d in ("data_inicio", "data_situacao"))),
        _row("obras.area_nao_negativa", ERROR, "obras", lambda: c("area_total") < 0),
        _row("obras.datas_coerentes", WARNING, "obras", lambda: c("datas_incoerentes")),
        _row("obras.area_plausivel", WARNING, "obras", lambda: c("area_suspeita")),
        _row("obras.uf_identificada", WARNING, "obras", lambda: c("uf_indefinida") & ~c("no_exterior")),
        _row("obras.data_inicio_nao_futura", WARNING, "obras", lambda: c("data_inicio") > now),
        _row("areas.metragem_preenchida", WARNING, "areas", lambda: c("metragem").isNull()),
        _row("vinculos.periodo_coerente", WARNING, "vinculos", lambda: c("data_fim") < c("data_inicio")),
    ]


@dataclass
class Outcome:
    rule: str
    severity: str
    violations: int
    examples: list[dict]


@dataclass
class Report:
    snapshot: str
    outcomes: list[Outcome] = field(default_factory=list)
    reconciliation: list[dict] = field(default_factory=list)

    @property
    def passed(self) -> bool:
        return all(o.severity != ERROR or not o.violations for o in self.outcomes) and all(r["confere"] for r in self.reconciliation)

    def as_dict(self) -> dict:
        return asdict(self) | {"passou": self.passed}


def _violations(rules_: list[Rule], tables: Tables) -> DataFrame:
    """``rule, first, example`` of every violation of every rule, from one plan.

    Conditions on the rows of a table are tried in one pass over it; orphans of all children come from one join with
    the works.  Counting prunes the examples.
    """
    parts, by_table, children = [], {}, []
    for k, rule in enumerate(rules_):
        try:
            if rule.row:
                table, condition = rule.row
                by_table.setdefault(table, []).append((k, condition()))
            elif rule.child:
                children.append(_example(tables[rule.child], k))
            else:
                parts.append(_example(rule.violations(tables), k).drop("cno"))
        except PySparkException as e:
            raise ValidationError(f"rule {rule.name} failed: {e}") from e
    for table, conditions in by_table.items():
        broken = F.array_compact(F.array(*[F.when(c, k) for k, c in conditions]))
        parts.append(_example(tables[table], F.explode(broken)).drop("cno"))
    if children:
        rows = reduce(DataFrame.unionByName, children)
        parts.append(rows.join(tables["obras"].select("cno"), "cno", "left_anti").drop("cno"))
    return reduce(DataFrame.unionByName, parts)


def _example(df: DataFrame, rule: int | Column) -> DataFrame:
    first = F.col(f"`{df.columns[0]}`").cast("string")
    key = F.col("cno") if "cno" in df.columns else F.lit(None).cast("string")
    text = F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]), {"ignoreNullFields": "false"})
    return df.select((F.lit(rule) if isinstance(rule, int) else rule).alias("rule"), first.alias("first"), text.alias("example"), key.alias("cno"))


def evaluate_all(rules_: list[Rule], tables: Tables) -> list[Outcome]:
    """Every rule's violations counted, and the first few of each, in two actions whatever the number of rules.

    Examples are ranked by rule after each task has cut its own to as many, so no task gathers a rule's violations.
    """
    if not rules_:
        return []
    rows = _violations(rules_, tables)
    order = Window.partitionBy("rule").orderBy(F.col("first").asc_nulls_first(), "example")
    try:
        counts = dict(rows.groupBy("rule").count().collect())
        some = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= D.MAX_EXAMPLES).orderBy("rule", "rank").collect() if counts else []
    except Exception as e:
        raise ValidationError(f"a rule could not be evaluated: {e}") from e
    examples: dict[int, list[dict]] = {}
    for r in some:
        examples.setdefault(r["rule"], []).append(json.loads(r["example"]))
    return [Outcome(r.name, r.severity, counts.get(k, 0), examples.get(k, [])) for k, r in enumerate(rules_)]


def evaluate(rule: Rule, tables: Tables) -> Outcome:
    return evaluate_all([rule], tables)[0]


def reconcile(read: Mapping[str, int], totals: Mapping[str, int]) -> list[dict]:
    """Rows read, before dedup, against the published totals; a total that is not published agrees."""
    out = []
    for table, key in D.CONTROL_TOTALS.items():
        want = totals.get(key)
        out.append({"tabela": table, "lidas": read.get(table), "publicadas": want, "confere": want is None or want == read.get(table)})
    return out


def validate(tables: Tables, snapshot: str, read: Mapping[str, int], totals: Mapping[str, int], today: date | None = None, extra: list[Rule] | None = None) -> Report:
    return Report(snapshot, evaluate_all([*rules(today), *(extra or [])], tables), reconcile(read, totals))
