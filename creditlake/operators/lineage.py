"""Lineage of columns, read off the analysed plan of a DataFrame."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sets import union_all

#: From the least to the most that happens to a value on its way.
HOW = ("copied", "derived", "window", "aggregated")


def _items(seq) -> Iterator:
    return (seq.apply(i) for i in range(seq.size()))


def _name(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


class _Plan:
    """What each expression id of a plan is made of, and what decides on its rows."""

    def __init__(self, sources: Mapping[str, DataFrame]):
        self.paths = {p: name for name, df in sources.items() for p in self.leaves(df._jdf.queryExecution().analyzed())}
        self.made: dict[int, tuple[str, set[int]]] = {}
        self.origin: dict[int, tuple[str, str]] = {}
        self.union: dict[int, set[int]] = {}
        self.rows: list[tuple[str, set[int]]] = []

    @staticmethod
    def location(node) -> str | None:
        if _name(node) != "LogicalRelation" or "location" not in {m.getName() for m in node.relation().getClass().getMethods()}:
            return None
        paths = node.relation().location().rootPaths()
        return paths.apply(0).toString() if paths.size() else None

    def leaves(self, node) -> list[str]:
        children = list(_items(node.children()))
        here = self.location(node)
        return [p for c in children for p in self.leaves(c)] + ([here] if here else [])

    def refs(self, expression) -> tuple[str, set[int]]:
        """How an expression changes what it reads, and the ids that it reads."""
        kind = _name(expression)
        if kind == "AttributeReference":
            return "copied", {expression.exprId().id()}
        how, ids = "derived", set()
        if kind in ("ScalarSubquery", "Exists", "ListQuery"):
            self.walk(expression.plan())
            ids |= {a.exprId().id() for a in _items(expression.plan().output())}
        for child in _items(expression.children()):
            below, more = self.refs(child)
            how, ids = max(how, below, key=HOW.index), ids | more
        if kind == "AggregateExpression":
            how = "aggregated"
        elif kind == "WindowExpression":
            how = max(how, "window", key=HOW.index)
        return how, ids

    def name(self, expression) -> None:
        """A named expression of a select list."""
        if _name(expression) == "Alias":
            self.made[expression.exprId().id()] = self.refs(expression.child())

    def decides(self, how: str, expressions) -> None:
        ids = set().union(*[self.refs(e)[1] for e in expressions]) if expressions else set()
        if ids:
            self.rows.append((how, ids))

    def walk(self, node) -> None:
        kind = _name(node)
        for child in _items(node.children()):
            self.walk(child)
        if kind in ("Project", "Aggregate", "Window"):
            names = {"Project": "projectList", "Aggregate": "aggregateExpressions", "Window": "windowExpressions"}[kind]
            for e in _items(getattr(node, names)()):
                self.name(e)
        if kind == "Aggregate":
            self.decides("group", list(_items(node.groupingExpressions())))
        elif kind == "Window":
            self.decides("window", list(_items(node.partitionSpec())) + list(_items(node.orderSpec())))
        elif kind == "Filter":
            self.decides("filter", [node.condition()])
        elif kind == "Join" and node.condition().isDefined():
            self.decides("join", [node.condition().get()])
        elif kind == "Generate":
            made = self.refs(node.generator())[1]
            for a in _items(node.generatorOutput()):
                self.made[a.exprId().id()] = ("derived", made)
        elif kind == "Union":
            sides = [[a.exprId().id() for a in _items(c.output())] for c in _items(node.children())]
            for i, a in enumerate(_items(node.output())):
                # the union's column may have the id of its first side's, which keeps what it is made of
                own = a.exprId().id()
                self.union.setdefault(own, set()).update({s[i] for s in sides} - {own})
        elif not node.children().size():
            table = self.paths.get(self.location(node) or "", None)
            for a in _items(node.output()):
                if table:
                    self.origin[a.exprId().id()] = (table, a.name())

    def sources(self, ids: set[int], how: str = "copied", seen: frozenset = frozenset()) -> set[tuple[str, str, str]]:
        out = set()
        for i in ids - seen:
            if i in self.origin:
                out.add((*self.origin[i], how))
            below, more = self.made.get(i, ("copied", set()))
            out |= self.sources(more, max(how, below, key=HOW.index), seen | {i})
            out |= self.sources(self.union.get(i, set()), how, seen | {i})
        return out


def column_lineage(df: DataFrame, sources: Mapping[str, DataFrame]) -> list[tuple[str, str, str, str]]:
    """(column, source table, source column, how) of every output column, by expression ids and not by names: whether a value is
    ``copied`` (renaming included), ``derived`` by an expression, or comes through a ``window`` or an aggregate (``aggregated``). Rows
    of column ``*`` are the source columns by which rows are kept (``filter``), matched (``join``), grouped (``group``) or ordered
    (``window``). ``sources`` are file-backed tables; columns of other tables, and constants, have no row."""
    plan = _Plan(sources)
    root = df._jdf.queryExecution().analyzed()
    plan.walk(root)
    strongest: dict[tuple[str, str, str], str] = {}
    for a in _items(root.output()):
        for table, column, how in plan.sources({a.exprId().id()}):
            k = (a.name(), table, column)
            strongest[k] = max(strongest.get(k, how), how, key=HOW.index)
    rows = {("*", table, column, how) for how, ids in plan.rows for table, column, _ in plan.sources(ids)}
    return sorted({(*k, how) for k, how in strongest.items()} | rows)


def lineage_report(df: DataFrame, sources: Mapping[str, DataFrame]) -> DataFrame:
    """The lineage with the rows of each source table and the values of each source column, counted in a pass a table."""
    traced = column_lineage(df, sources)
    spark = df.sparkSession
    if not traced:
        return spark.createDataFrame([], "target_column string, source_table string, source_column string, how string, source_rows long, source_values long")
    lines = spark.createDataFrame(traced, "target_column string, source_table string, source_column string, how string")
    counts = []
    for table in dict.fromkeys(t for _, t, _, _ in traced):
        columns = sorted({c for _, t, c, _ in traced if t == table})
        count: list[Column] = [F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{c}`")).alias(f"v{i}") for i, c in enumerate(columns)]]
        items = F.array(*[F.struct(F.lit(c).alias("source_column"), F.col(f"v{i}").alias("source_values")) for i, c in enumerate(columns)])
        counts.append(sources[table].agg(*count).select(F.lit(table).alias("source_table"), F.col("n").alias("source_rows"), F.inline(items)))
    return lines.join(union_all(counts), ["source_table", "source_column"]).select("target_column", "source_table", "source_column", "how", "source_rows", "source_values")
