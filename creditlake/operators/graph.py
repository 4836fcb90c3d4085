"""A property graph as labels over DataFrames, and pattern matching as joins."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import orphans
from .sets import union_all


@dataclass(frozen=True, eq=False)
class Node:
    label: str
    df: DataFrame
    key: str


@dataclass(frozen=True, eq=False)
class Edge:
    """``source`` and ``target`` are (node label, key column of this edge table)."""

    label: str
    df: DataFrame
    key: str
    source: tuple[str, str]
    target: tuple[str, str]


@dataclass(frozen=True)
class Hop:
    """One step ``(source) -[alias:label]-> (target)`` between node aliases."""

    source: str
    alias: str
    label: str
    target: str


class PropertyGraph:
    def __init__(self, nodes: Sequence[Node], edges: Sequence[Edge]):
        self.nodes = {n.label: n for n in nodes}
        self.edges = {e.label: e for e in edges}
        for e in edges:
            for label, column in (e.source, e.target):
                if label not in self.nodes:
                    raise ValueError(f"{e.label}: unknown node label {label}")
                if column not in e.df.columns:
                    raise ValueError(f"{e.label}: no column {column}")

    def node(self, label: str) -> DataFrame:
        return self.nodes[label].df

    def edge(self, label: str) -> DataFrame:
        return self.edges[label].df

    def save(self, root: str) -> "PropertyGraph":
        """Write the tables below ``root`` and return the graph over the copies."""
        spark = next(iter(self.nodes.values())).df.sparkSession

        def stored(label: str, df: DataFrame) -> DataFrame:
            df.write.mode("overwrite").parquet(f"{root}/{label}")
            return spark.read.parquet(f"{root}/{label}")

        return PropertyGraph(
            [Node(n.label, stored(n.label, n.df), n.key) for n in self.nodes.values()],
            [Edge(e.label, stored(e.label, e.df), e.key, e.source, e.target) for e in self.edges.values()])

    def cardinality(self) -> DataFrame:
        """Rows per node and edge table."""
        elements = [("NODE", n.label, n.df) for n in self.nodes.values()] + [
            ("EDGE", e.label, e.df) for e in self.edges.values()]
        return union_all([df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(kind).alias("element"), F.lit(label).alias("label"), "row_count")
            for kind, label, df in elements])

    def validate(self) -> DataFrame:
        """Violations per check: repeated keys, and edge ends without a node."""

        def row(df: DataFrame, label: str, check: str) -> DataFrame:
            return df.select(F.lit(label).alias("label"), F.lit(check).alias("check"), "violations")

        checks = []
        for el in [*self.nodes.values(), *self.edges.values()]:
            dup = el.df.groupBy(el.key).agg((F.count(F.lit(1)) - 1).alias("s")).agg(
                F.coalesce(F.sum("s"), F.lit(0)).alias("violations"))
            checks.append(row(dup, el.label, f"unique({el.key})"))
        for e in self.edges.values():
            for label, column in (e.source, e.target):
                lost = orphans(e.df, self.node(label), column, self.nodes[label].key).agg(
                    F.count(F.lit(1)).alias("violations"))
                checks.append(row(lost, e.label, f"references({label}.{column})"))
        return union_all(checks)

    def match(self, nodes: Mapping[str, str], hops: Sequence[Hop], columns: Mapping[str, tuple[str, str]],
              where: Mapping[str, str] | None = None,
              link: tuple[Sequence[tuple[str, str]], Callable[..., Column]] | None = None) -> DataFrame:
        """Rows of a connected pattern.

        ``columns`` maps output names to (alias, property). ``where`` holds one SQL condition per alias
        over its own properties, applied before any join. ``link`` compares properties of several
        aliases: the properties it needs and a function of their columns. Node tables whose
        properties are not read are not joined, because edge ends are known to exist.
        """
        where = where or {}
        needed: dict[str, set[str]] = {a: set() for a in [*nodes, *(h.alias for h in hops)]}
        for alias, prop in [*columns.values(), *(link[0] if link else ())]:
            needed[alias].add(prop)

        def element(alias: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
            if alias in where:
                df = df.where(where[alias])
            props = sorted(needed[alias] - set(keys))
            return df.select(*[F.col(k).alias(f"{alias}__{k}") for k in keys],
                             *[F.col(p).alias(f"{alias}__{p}") for p in props])

        out: DataFrame | None = None
        bound: dict[str, Column] = {}

        def attach(alias: str) -> None:
            nonlocal out
            node = self.nodes[nodes[alias]]
            here = bound[alias]
            own = f"{alias}__{node.key}"
            if alias in where or needed[alias] - {node.key}:
                side = element(alias, node.df, [node.key])
                out = out.withColumn("__k", here).join(side, F.col("__k") == F.col(own)).drop("__k")
            else:
                out = out.withColumn(own, here)
            bound[alias] = F.col(own)

        for i, hop in enumerate(hops):
            e = self.edges[hop.label]
            src, dst = e.source[1], e.target[1]
            if (nodes[hop.source], nodes[hop.target]) != (e.source[0], e.target[0]):
                raise ValueError(f"{hop.label} joins {e.source[0]} to {e.target[0]}")
            side = element(hop.alias, e.df, [src, dst])
            ends = {hop.source: F.col(f"{hop.alias}__{src}"), hop.target: F.col(f"{hop.alias}__{dst}")}
            if i == 0:
                out = side
            else:
                known = [a for a in ends if a in bound]
                if not known:
                    raise ValueError(f"hop {hop.alias} is not connected")
                cond = bound[known[0]] == ends[known[0]]
                for a in known[1:]:
                    cond = cond & (bound[a] == ends[a])
                out = out.join(side, cond)
            for alias, c in ends.items():
                if alias not in bound:
                    bound[alias] = c
                    attach(alias)
        if link:
            out = out.where(link[1](*[F.col(f"{a}__{p}") for a, p in link[0]]))
        return out.select(*[F.col(f"{a}__{p}").alias(name) for name, (a, p) in columns.items()])

    def match_aggregate(self, nodes: Mapping[str, str], hops: Sequence[Hop], by: Mapping[str, tuple[str, str]],
                        measures: Mapping[str, tuple[str, str, str] | tuple[str, str]], where: Mapping[str, str] | None = None) -> DataFrame:
        """Aggregates over the paths of a pattern without cycles, of which no path is ever written out.

        ``by`` maps output names to (alias, SQL expression over its own properties), ``measures`` to ("count", any alias): paths,
        ("distinct", node alias): different nodes, or ("sum" | "avg" | "min" | "max", alias, SQL expression over its properties): over all
        paths. ``where`` is as in ``match``.

        The pattern is a tree. From its leaves to its root each node sends, for its key and the values of ``by`` below it, one row: the
        number of partial paths and the sums over them. Where branches meet, counts multiply, and the sums of one branch multiply
        with the counts of the others. Keys without a match drop out on the way, so joins are as large as elements and groups, not
        as paths. A distinct count is a pass of its own, rooted at its alias; nodes with one edge are counted where that leads.
        """
        if not by:
            raise ValueError("no column to group by")
        for hop in hops:
            e = self.edges[hop.label]
            if (nodes[hop.source], nodes[hop.target]) != (e.source[0], e.target[0]):
                raise ValueError(f"{hop.label} joins {e.source[0]} to {e.target[0]}")
        seen, todo = set(), [next(iter(nodes))]
        while todo:
            a = todo.pop()
            seen.add(a)
            todo += [b for h in hops for b in ((h.target,) if h.source == a else (h.source,) if h.target == a else ()) if b not in seen]
        if seen != set(nodes) or len(hops) != len(nodes) - 1:
            raise ValueError("the pattern is not a tree")
        plain = {n: m for n, m in measures.items() if m[0] != "distinct"}
        roots = {n: m[1] for n, m in measures.items() if m[0] == "distinct"}
        parts = []
        if plain:
            rows = _Messages(self, nodes, hops, by, plain, where or {}).up(next(iter(nodes)), None)
            parts.append(rows.groupBy(*by).agg(*[_total(n, m[0]) for n, m in plain.items()]))
        for alias in dict.fromkeys(roots.values()):
            counts = _Messages(self, nodes, hops, by, {}, where or {}).different(alias)
            parts.append(counts.select(*by, *[F.col("__c").alias(n) for n, a in roots.items() if a == alias]))
        out = parts[0]
        for more in parts[1:]:
            more = more.withColumnsRenamed({c: f"__{c}" for c in by})
            out = out.join(more, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by])).drop(*[f"__{c}" for c in by])
        return out.select(*by, *measures)


def _total(name: str, kind: str) -> Column:
    if kind == "count":
        return F.sum("__n").alias(name)
    if kind == "avg":
        return F.try_divide(F.sum(name), F.sum(f"{name}__n")).alias(name)
    return {"sum": F.sum, "min": F.min, "max": F.max}[kind](name).alias(name)


@dataclass(frozen=True)
class _Messages:
    """Rows that travel up a pattern: ``__k``, the values of ``by`` below, ``__n`` partial paths, and the state of each measure."""

    graph: PropertyGraph
    nodes: Mapping[str, str]
    hops: Sequence[Hop]
    by: Mapping[str, tuple[str, str]]
    measures: Mapping[str, tuple]
    where: Mapping[str, str]

    def own(self, alias: str) -> list[Column]:
        """The groups and first states of an element."""
        cols = [F.expr(e).alias(n) for n, (a, e) in self.by.items() if a == alias]
        for n, m in self.measures.items():
            if m[0] != "count" and m[1] == alias:
                value = F.expr(m[2])
                cols.append(value.alias(n))
                if m[0] == "avg":
                    cols.append(F.when(value.isNotNull(), F.lit(1)).otherwise(0).cast("long").alias(f"{n}__n"))
        return cols

    def element(self, alias: str, df: DataFrame, *keys: Column) -> DataFrame:
        return (df.where(self.where[alias]) if alias in self.where else df).select(*keys, *self.own(alias))

    def states(self, df: DataFrame) -> list[str]:
        return [c for n in self.measures for c in (n, f"{n}__n") if c in df.columns]

    def times(self, df: DataFrame, column: str, n: str) -> Column:
        """A state that stands on ``n`` paths each; decimals keep nine places, and stop the query where they leave their range."""
        kind, value = dict(df.dtypes)[column], F.col(column)
        if self.measures[column.removesuffix("__n")][0] not in ("min", "max"):
            value = value.cast("decimal(27,9)") * F.col(n).cast("decimal(10,0)") if kind.startswith("decimal") else value * F.col(n)
        return value.alias(column)

    def meet(self, left: DataFrame, right: DataFrame, key: str) -> DataFrame:
        """Joined on ``key`` of the left side; counts multiplied, the states of each side times the counts of the other."""
        joined = left.join(right.withColumnsRenamed({"__k": "__k2", "__n": "__n2"}), F.col(key) == F.col("__k2"))
        return joined.select("__k", *[c for c in self.by if c in joined.columns], (F.col("__n") * F.col("__n2")).alias("__n"),
                             *[self.times(joined, c, "__n2") for c in self.states(left)], *[self.times(joined, c, "__n") for c in self.states(right)])

    def up(self, alias: str, come: Hop | None) -> DataFrame | None:
        """What ``alias`` knows of the pattern away from the hop it is asked over; None where it only exists."""
        node = self.graph.nodes[self.nodes[alias]]
        out = None
        hops = [h for h in self.hops if h is not come and alias in (h.source, h.target)]
        if come is None or alias in self.where or self.own(alias):
            out = self.element(alias, node.df, F.col(node.key).alias("__k")).withColumn("__n", F.lit(1).cast("long"))
        for hop in hops:
            e = self.graph.edges[hop.label]
            near, far, other = (e.source[1], e.target[1], hop.target) if hop.source == alias else (e.target[1], e.source[1], hop.source)
            rows = self.element(hop.alias, e.df, F.col(near).alias("__k"), F.col(far).alias("__f")).withColumn("__n", F.lit(1).cast("long"))
            below = self.up(other, hop)
            if below is not None:
                rows = self.meet(rows, below, "__f")
            grouped = [c for c in self.by if c in rows.columns]
            sums = [F.sum("__n").alias("__n")]
            for c in self.states(rows):
                kind = self.measures[c.removesuffix("__n")][0]
                sums.append({"min": F.min, "max": F.max}.get(kind, F.sum)(c).alias(c))
            rows = rows.groupBy("__k", *grouped).agg(*sums)
            out = rows if out is None else self.meet(out, rows, "__k")
        return out


    def different(self, alias: str) -> DataFrame:
        """``__c``, the number of different nodes of ``alias`` per group.

        A node at the end of the pattern that has one edge is in just the groups of the node behind it, so such nodes are counted per
        node behind, and the counts meet its groups: the nodes themselves never do. The others are told apart group by group.
        """
        hops = [h for h in self.hops if alias in (h.source, h.target)]
        hop = hops[0] if len(hops) == 1 else None
        other = hop and (hop.target if hop.source == alias else hop.source)
        below = self.up(other, hop) if hop else None
        if below is None:
            return self.up(alias, None).groupBy(*self.by).agg(F.count(F.lit(1)).alias("__c"))
        e, node = self.graph.edges[hop.label], self.graph.nodes[self.nodes[alias]]
        near, far = (e.source[1], e.target[1]) if hop.source == alias else (e.target[1], e.source[1])
        rows = self.element(hop.alias, e.df, F.col(near).alias("__k"), F.col(far).alias("__f"))
        rows = rows.join(self.element(alias, node.df, F.col(node.key).alias("__k")), "__k").withColumn("__e", F.count(F.lit(1)).over(Window.partitionBy("__k")))
        own = [c for c in self.by if c in rows.columns]
        below = below.drop("__n").withColumnRenamed("__k", "__f")
        alone = rows.where("__e = 1").groupBy("__f", *own).agg(F.count(F.lit(1)).alias("__c")).join(below, "__f")
        shared = rows.where("__e > 1").join(below, "__f").select("__k", *self.by).distinct().withColumn("__c", F.lit(1).cast("long"))
        return alone.select(*self.by, "__c").unionByName(shared.select(*self.by, "__c")).groupBy(*self.by).agg(F.sum("__c").alias("__c"))


def path_json(*elements: tuple[str, Sequence[str]]) -> Column:
    """A path as a JSON array of elements, each a label and its properties."""
    parts = [F.to_json(F.struct(F.lit(label).alias("label"), *props)) for label, props in elements]
    return F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))
