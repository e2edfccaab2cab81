"""Questions in business terms, answered as one aggregate per fact table.

A semantic view names facts, dimensions, metrics and many-to-one relationships.
``semantic_query`` turns metric and dimension names into a DataFrame:

* every table used is cut to its current rows, so history is not counted twice;
* a parent is brought to one row per relationship key before the join, so a join
  never multiplies facts;
* metrics of several tables are aggregated apart and meet on the shared
  dimensions; facts are never joined to facts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Table:
    name: str
    archive: str
    key: tuple[str, ...]
    facts: Mapping[str, str] = field(default_factory=dict)
    dimensions: Mapping[str, str] = field(default_factory=dict)
    synonyms: tuple[str, ...] = ()

    @property
    def terms(self) -> dict[str, str]:
        """Logical name to source column, facts and dimensions alike."""
        return {**self.facts, **self.dimensions, "is_current": "_is_current"}


@dataclass(frozen=True)
class Relationship:
    """``child.columns`` points at one row of ``parent.parent_columns``."""

    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Metric:
    name: str
    table: str
    expression: str


@dataclass(frozen=True)
class SemanticView:
    name: str
    comment: str
    tables: tuple[Table, ...]
    metrics: tuple[Metric, ...]
    relationships: tuple[Relationship, ...] = ()

    def table(self, name: str) -> Table:
        return next(t for t in self.tables if t.name == name)

    def metric(self, name: str) -> Metric:
        for m in self.metrics:
            if m.name == name or f"{m.table}.{m.name}" == name:
                return m
        raise KeyError(f"{self.name} has no metric {name}")

    def parents(self, name: str) -> list[Relationship]:
        return [r for r in self.relationships if r.child == name]


Archives = Callable[[str], DataFrame]


def _words(text: str) -> set[str]:
    """Identifiers of an expression, string literals left out."""
    return set(re.findall(r"[A-Za-z_]\w*", re.sub(r"'[^']*'", "", text)))


def _logical(table: Table, archives: Archives) -> DataFrame:
    """Current rows with logical names beside the source columns."""
    rows = archives(table.archive).filter("_is_current")
    have = set(rows.columns)
    extra = {n: F.col(c) for n, c in table.terms.items() if c in have and n != c}
    return rows.withColumns(extra) if extra else rows


def _with_parents(view: SemanticView, table: Table, rows: DataFrame, wanted: set[str], archives: Archives) -> DataFrame:
    """Left join the parents that hold wanted dimensions."""
    for link in view.parents(table.name):
        parent = view.table(link.parent)
        terms = sorted(n for n in parent.terms if n in wanted and n not in table.terms)
        if not terms:
            continue
        keys = [F.col(c).alias(f"_{parent.name}_{c}") for c in link.parent_columns]
        newest = F.max_by(F.struct(*terms), "_archive_id").alias("_parent")
        unique = (
            _logical(parent, archives)
            .groupBy(*keys)
            .agg(newest)
            .select(*[f"_{parent.name}_{c}" for c in link.parent_columns], *[F.col(f"_parent.{n}").alias(n) for n in terms])
        )
        refs = {f"_to_{parent.name}_{p}": F.col(c) for c, p in zip(link.columns, link.parent_columns)}
        same = [F.col(f"_to_{parent.name}_{p}") == F.col(f"_{parent.name}_{p}") for p in link.parent_columns]
        # A wanted parent name wins over a raw child column of the same name.
        rows = rows.withColumns(refs).drop(*terms).join(unique, reduce(Column.__and__, same), "left")
    return rows


def _reach(view: SemanticView, table: Table) -> set[str]:
    """Logical names usable in a question about ``table``."""
    names = set(table.terms)
    for link in view.parents(table.name):
        names |= set(view.table(link.parent).terms)
    return names


def _nearest(view: SemanticView, names: set[str]) -> str:
    """The table that reaches all names, having most of them itself."""
    able = [t for t in view.tables if names <= _reach(view, t)]
    if not able:
        raise ValueError(f"no table of {view.name} reaches all of {sorted(names)}")
    return max(able, key=lambda t: len(names & set(t.terms))).name


def semantic_query(
    view: SemanticView,
    archives: Archives,
    metrics: Sequence[str],
    dimensions: Sequence[str] | Mapping[str, str | Mapping[str, str]] = (),
    filters: Sequence[str] = (),
    order_by: Sequence[Column | str] = (),
    limit: int | None = None,
) -> DataFrame:
    """Metrics by dimensions; without metrics the distinct rows of the dimensions.

    A question without metrics is about the table nearest to its names: the one that reaches them all with the fewest parents.

    ``dimensions`` are logical names, or output names mapped to an expression
    over logical names, or to one expression per table when several fact tables
    share the dimension.  A filter applies to each fact table that knows all of
    its names.
    """
    named = dict(dimensions) if isinstance(dimensions, Mapping) else {d: d for d in dimensions}
    per_table: dict[str, list[Metric]] = {}
    for name in metrics:
        metric = view.metric(name)
        per_table.setdefault(metric.table, []).append(metric)

    every = set().union(*(t.terms for t in view.tables))
    used = dict.fromkeys(filters, 0)
    answers = []
    if not metrics:
        if not named:
            raise ValueError("a question needs metrics or dimensions")
        per_table[_nearest(view, set().union(*(_words(t) for t in (*named.values(), *filters))) & every)] = []
    for table_name, group in per_table.items():
        table = view.table(table_name)
        reach = _reach(view, table)
        by = {}
        for alias, expression in named.items():
            text = expression if isinstance(expression, str) else expression[table_name]
            if (_words(text) & every) - reach:
                raise ValueError(f"{alias} cannot be reached from {table_name}")
            by[alias] = text
        mine = [f for f in filters if not (_words(f) & every) - reach]
        for f in mine:
            used[f] += 1
        wanted = set().union(*(_words(t) for t in (*by.values(), *mine)))
        rows = _with_parents(view, table, _logical(table, archives), wanted, archives)
        for f in mine:
            rows = rows.filter(f)
        aggregates = [F.expr(m.expression).alias(m.name) for m in group]
        columns = [F.expr(t).alias(a) for a, t in by.items()]
        answers.append(rows.groupBy(*columns).agg(*aggregates) if group else rows.select(*columns).distinct())
    if unknown := [f for f, n in used.items() if n == 0]:
        raise ValueError(f"no fact table knows all names of {unknown}")

    answer = reduce(lambda a, b: _meet(a, b, list(named)), answers)
    if order_by:
        answer = answer.orderBy(*order_by)
    return answer if limit is None else answer.limit(limit)


def _meet(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join of two answers on their dimensions; NULL meets NULL."""
    if not keys:
        return left.crossJoin(F.broadcast(right))  # one row each
    other = right.withColumnsRenamed({k: f"_other_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_other_{k}")) for k in keys]
    joined = left.join(other, reduce(Column.__and__, same), "full")
    values = [c for c in (*left.columns, *right.columns) if c not in keys]
    return joined.select(*[F.coalesce(k, f"_other_{k}").alias(k) for k in keys], *values)
