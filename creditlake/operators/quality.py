"""Data quality: rule scans, quarantine, reconciliation, profiles, sensitive data, relationships."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import MONEY
from .sets import union_all


def _struct_rows(df: DataFrame, rows: Sequence[Sequence[tuple[str, Column]]]) -> DataFrame:
    """One wide row to several long ones."""
    items = F.array(*[F.struct(*[c.alias(n) for n, c in row]) for row in rows])
    return df.select(F.inline(items))


@dataclass(frozen=True)
class Rule:
    """One expectation. ``kind`` is ``not_null``, ``unique`` or ``range``; a null fails a range unless
    ``null_as`` gives the value it counts as."""

    name: str
    column: str
    dimension: str
    kind: str
    threshold_pct: float = 100.0
    low: float | None = None
    high: float | None = None
    strict_low: bool = False
    null_as: float | None = None

    def passed(self) -> Column:
        c = F.col(self.column)
        if self.kind == "not_null":
            return F.count(c)
        if self.kind == "unique":
            return F.count_distinct(c)
        if self.kind != "range":
            raise ValueError(self.kind)
        v = c.cast("double") if self.null_as is None else F.coalesce(c.cast("double"), F.lit(self.null_as))
        tests = []
        if self.low is not None:
            tests.append(v > self.low if self.strict_low else v >= self.low)
        if self.high is not None:
            tests.append(v <= self.high)
        return F.count_if(reduce(lambda a, b: a & b, tests))


def scan_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All rules in one aggregation over the table, one result row per rule."""
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[r.passed().alias(f"__r{i}") for i, r in enumerate(rules)])
    out = []
    for i, r in enumerate(rules):
        n, ok = F.col("__n"), F.col(f"__r{i}")
        pct = F.round(ok.cast("decimal(20,0)") * 100 / F.nullif(n, F.lit(0)), 2)
        out.append([("rule_name", F.lit(r.name)), ("dimension", F.lit(r.dimension)),
                    ("column_name", F.lit(r.column)), ("evaluated_rows", n), ("passed_rows", ok),
                    ("failed_rows", n - ok), ("pass_rate_pct", pct),
                    ("threshold_pct", F.lit(float(r.threshold_pct))),
                    ("rule_status", F.when(pct >= r.threshold_pct, "PASSED").otherwise("FAILED"))])
    return _struct_rows(wide, out)


@dataclass(frozen=True)
class RowRule:
    """Rows of ``source`` that break a rule, with key, owner and message."""

    rule_id: str
    source: str
    record_key: Column = field(hash=False)
    owner: Column = field(hash=False)
    broken: Column = field(hash=False)
    detail: Column = field(hash=False)
    action: str = "WARN_AND_QUARANTINE"


def quarantine(tables: Mapping[str, DataFrame], rules: Sequence[RowRule], evaluated_at: Column) -> DataFrame:
    """Every broken row of every rule; each rule is a filter that reaches its scan."""
    return union_all([
        tables[r.source].where(r.broken).select(
            evaluated_at.alias("evaluated_at"), F.lit(r.source).alias("source_table"),
            r.record_key.cast("string").alias("record_key"), r.owner.cast("string").alias("cif_id"),
            F.lit(r.rule_id).alias("rule_id"), F.lit(r.action).alias("enforcement_action"),
            r.detail.alias("violation_detail"))
        for r in rules])


def quarantine_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("evaluated_at", "rule_id", "source_table", "enforcement_action").agg(
        F.count(F.lit(1)).alias("quarantined_rows"))


def assertion_report(df: DataFrame, non_null: Sequence[str] = (), unique: Sequence[str] = ()) -> DataFrame:
    """Violating rows per assertion: null columns, and surplus rows of the composite unique key."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"__n{i}") for i, c in enumerate(non_null)],
                  F.count(F.lit(1)).alias("__rows"))
    rows = [[("assertion", F.lit(f"nonNull({c})")), ("violations", F.col(f"__n{i}"))]
            for i, c in enumerate(non_null)]
    report = _struct_rows(wide, rows) if rows else None
    if unique:
        surplus = df.groupBy(*unique).agg((F.count(F.lit(1)) - 1).alias("s")).agg(
            F.coalesce(F.sum("s"), F.lit(0)).alias("violations")).select(
            F.lit(f"uniqueKey({', '.join(unique)})").alias("assertion"), "violations")
        report = surplus if report is None else report.unionByName(surplus)
    if report is None:
        raise ValueError("nothing to assert")
    return report


def assert_table(df: DataFrame, non_null: Sequence[str] = (), unique: Sequence[str] = ()) -> None:
    """Raise if an assertion is violated."""
    bad = [f"{r['assertion']}: {r['violations']}" for r in
           assertion_report(df, non_null, unique).where(F.col("violations") > 0).collect()]
    if bad:
        raise AssertionError("; ".join(bad))


@dataclass(frozen=True)
class Control:
    """A bronze and a silver relation with the rows and total that have to agree."""

    flow: str
    metric: str
    bronze: DataFrame = field(hash=False)
    silver: DataFrame = field(hash=False)
    bronze_amount: str = "amount"
    silver_amount: str = "amount"
    bronze_rows: Column | None = field(default=None, hash=False)


def reconcile(controls: Sequence[Control]) -> DataFrame:
    """Row counts, control totals to two decimals and variance per flow. Each side is one aggregation.

    Values are summed with nine decimals, so the variance (and the status) also shows what is lost below a cent."""
    sides = []
    for c in controls:
        for tag, df, amount, rows in (("bronze", c.bronze, c.bronze_amount, c.bronze_rows),
                                      ("silver", c.silver, c.silver_amount, None)):
            sides.append(df.agg((F.count(F.lit(1)) if rows is None else rows).alias("n"),
                                F.sum(F.col(amount).cast(MONEY)).alias("total"))
                         .select(F.lit(c.flow).alias("flow"), F.lit(c.metric).alias("metric"),
                                 F.lit(tag).alias("side"), "n", "total"))

    def pick(side: str, c: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(c)))

    out = union_all(sides).groupBy("flow", "metric").agg(
        pick("bronze", "n").alias("bronze_rows"), pick("silver", "n").alias("silver_rows"),
        pick("bronze", "total").alias("bronze_total"), pick("silver", "total").alias("silver_total"))
    variance = F.col("silver_total") - F.col("bronze_total")
    ok = (F.col("bronze_rows") == F.col("silver_rows")) & (variance == 0)
    return out.select("flow", "metric", "bronze_rows", "silver_rows", *[F.round(c, 2).alias(c) for c in ("bronze_total", "silver_total")],
                      variance.alias("variance"), F.when(ok, "PASS").otherwise("INVESTIGATE").alias("audit_status"))


def tables_ready(spark, names: Sequence[str]) -> DataFrame:
    """Which of the named tables exist."""
    found = [(n, bool(spark.catalog.tableExists(n))) for n in names]
    return spark.createDataFrame(found, "table_name string, present boolean")


def zero_variance_gate(bronze: DataFrame, silver: DataFrame, amount: str,
                       non_empty: Sequence[DataFrame]) -> DataFrame:
    """One row: are the control totals equal and all the given products non-empty?"""
    total = F.coalesce(F.sum(F.col(amount).cast("decimal(28,9)")), F.lit(0).cast("decimal(38,9)"))
    diff = union_all([bronze.agg(total.alias("v")), silver.agg((-total).alias("v"))]).agg(F.sum("v").alias("v"))
    checks = [diff.select((F.col("v") == 0).alias("ok"))]
    checks += [df.limit(1).agg((F.count(F.lit(1)) > 0).alias("ok")) for df in non_empty]
    return union_all(checks).agg(F.min("ok").alias("passed"))


def profile(df: DataFrame, exact: Sequence[str] = ()) -> DataFrame:
    """Null share, uniqueness, minimum, average, maximum and distinct count of every column, in one pass.

    Minimum and maximum are of the column's own type, as text; the average is a double. Distinct counts are sketches of
    fixed size, but for the columns named in ``exact``, for each of which the rows are expanded once. Those rows are dealt out
    first: a task that reads a large file would else keep all values of the file that differ.
    """
    fields = [f for f in df.schema.fields if isinstance(f.dataType, (
        T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))]
    if any(f.name in exact for f in fields):
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(tasks, *[F.col(f"`{f.name}`") for f in fields])
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs += [F.count(c).alias(f"__c{i}"),
                 (F.count_distinct(c) if f.name in exact else F.approx_count_distinct(c)).alias(f"__d{i}"),
                 F.min(c).cast("string").alias(f"__lo{i}"),
                 (F.avg(c).cast("double") if isinstance(f.dataType, T.NumericType) else F.lit(None).cast("double")).alias(f"__av{i}"),
                 F.max(c).cast("string").alias(f"__hi{i}")]
    n = F.col("__n")
    pct = lambda x: F.round(x.cast("decimal(20,0)") * 100 / F.nullif(n, F.lit(0)), 2)
    return _struct_rows(df.agg(*aggs), [
        [("column_name", F.lit(f.name)), ("row_count", n), ("null_pct", pct(n - F.col(f"__c{i}"))),
         ("uniqueness_pct", pct(F.col(f"__d{i}"))), ("distinct_count", F.col(f"__d{i}")),
         ("min_value", F.col(f"__lo{i}")), ("avg_value", F.col(f"__av{i}")), ("max_value", F.col(f"__hi{i}"))]
        for i, f in enumerate(fields)])


def first_present(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """The first candidate that is a column, ignoring case."""
    have = {c.lower(): c for c in df.columns}
    return next((have[c.lower()] for c in candidates if c.lower() in have), None)


def metadata_coverage(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns and described columns per table, plus the total row, which comes last."""
    per = union_all([
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).cast("bigint").alias("total_columns"),
            F.lit(sum(bool(f.metadata.get("comment")) for f in df.schema.fields)).cast("bigint")
            .alias("described_columns"))
        for name, df in tables.items()])
    sums = per.rollup("table_name").agg(*[F.sum(c).alias(c) for c in
                                          ("row_count", "total_columns", "described_columns")],
                                        F.grouping("table_name").alias("is_total"))
    pct = F.round(F.col("described_columns").cast("decimal(20,0)") * 100 / F.nullif(F.col("total_columns"), F.lit(0)), 1)
    return sums.orderBy("is_total", "table_name").select(
        F.when(F.col("is_total") == 1, "TOTAL").otherwise(F.col("table_name")).alias("table_name"),
        "row_count", "total_columns", "described_columns", pct.alias("coverage_pct"))


def storage_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, files and megabytes per file-backed table."""
    per = [df.select(F.lit(name).alias("table_name"), F.col("_metadata.file_path").alias("p"),
                     F.col("_metadata.file_size").alias("s")).groupBy("table_name", "p").agg(
        F.count(F.lit(1)).alias("n"), F.max("s").alias("s")) for name, df in tables.items()]
    return union_all(per).groupBy("table_name").agg(
        F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("files"),
        F.round(F.sum("s").cast("decimal(24,0)") / (1024 * 1024), 2).alias("logical_mb"))


@dataclass(frozen=True)
class InfoType:
    """A kind of sensitive value: full-text pattern or word list, and the column names that hint at it."""

    name: str
    pattern: str | None = None
    words: tuple[str, ...] = ()
    level: str = "HIGH"
    action: str = "MASK"

    def hit(self, c: Column) -> Column:
        return c.rlike(self.pattern) if self.pattern is not None else c.isin(*self.words)


def pii_scan(df: DataFrame, types: Sequence[InfoType], likely: float = 0.5, very_likely: float = 0.95) -> DataFrame:
    """Share of values per column and kind over the whole table, in one pass; columns without a hit
    are left out."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.LongType, T.IntegerType))]
    aggs, rows = [], []
    for i, c in enumerate(cols):
        text = F.col(f"`{c}`").cast("string")
        aggs.append(F.count(text).alias(f"__n{i}"))
        for j, kind in enumerate(types):
            aggs.append(F.count_if(kind.hit(text)).alias(f"__h{i}_{j}"))
            rows.append([("column_name", F.lit(c)), ("infotype", F.lit(kind.name)), ("values", F.col(f"__n{i}")),
                         ("hits", F.col(f"__h{i}_{j}")), ("sensitivity_level", F.lit(kind.level)),
                         ("governance_action", F.lit(kind.action))])
    share = F.round(F.col("hits").cast("decimal(20,0)") / F.col("values"), 4)
    grade = F.when(share >= very_likely, "VERY_LIKELY").when(share >= likely, "LIKELY").otherwise("POSSIBLE")
    return _struct_rows(df.agg(*aggs), rows).where(F.col("hits") > 0).withColumn("hit_ratio", share).withColumn(
        "likelihood", grade)


def sensitivity_tags(tables: Mapping[str, DataFrame], catalog: DataFrame, layers: Mapping[str, str]) -> DataFrame:
    """Governance row per table: layer, rows, sensitive columns in order and the masking advice."""
    schema_rows = union_all([
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(layers.get(name, "bronze")).alias("layer"), "row_count",
            F.posexplode(F.array(*[F.lit(c) for c in df.columns])).alias("ordinal", "column_name"))
        for name, df in tables.items()])
    cat = catalog.select(F.lower("column_name").alias("__c"), "level", "advice", "is_pii")
    joined = schema_rows.join(cat, F.lower("column_name") == F.col("__c"), "left")
    pii = F.array_sort(F.collect_list(F.when(F.col("is_pii"), F.struct("ordinal", "column_name"))))
    return joined.groupBy("table_name", "layer", "row_count").agg(
        F.count(F.lit(1)).alias("columns"), F.count("level").alias("catalogued"),
        F.array_join(F.transform(pii, lambda s: s["column_name"]), ", ").alias("pii_columns"),
        F.max(F.when(F.col("is_pii"), F.col("advice"))).alias("masking_advice"))


def containment(left: DataFrame, left_col: str, right: DataFrame, right_col: str) -> DataFrame:
    """Share of the distinct left keys that exist on the right, as a one-row DataFrame."""
    lk = left.select(F.col(left_col).cast("string").alias("k")).where("k is not null")
    rk = right.select(F.col(right_col).cast("string").alias("k")).where("k is not null")
    both = lk.withColumn("l", F.lit(1)).unionByName(rk.withColumn("r", F.lit(1)), allowMissingColumns=True)
    return both.groupBy("k").agg(F.max("l").alias("l"), F.max("r").alias("r")).agg(
        F.count("l").alias("left_keys"), F.count(F.col("l") + F.col("r")).alias("shared_keys"))


def relationships(tables: Mapping[str, DataFrame], candidates: Sequence[tuple[str, str, str, str]],
                  min_confidence: float = 0.0) -> DataFrame:
    """Join relationships: containment of the left key set in the right one per candidate."""
    rows = [containment(tables[l], lc, tables[r], rc).select(
        F.lit(l).alias("left_table"), F.lit(lc).alias("left_column"), F.lit(r).alias("right_table"),
        F.lit(rc).alias("right_column"), "left_keys", "shared_keys") for l, lc, r, rc in candidates]
    conf = F.round(F.col("shared_keys").cast("decimal(20,0)") / F.nullif(F.col("left_keys"), F.lit(0)), 4)
    return union_all(rows).withColumn("confidence", conf).where(F.col("confidence") >= min_confidence)


def discover_relationships(tables: Mapping[str, DataFrame], min_confidence: float = 0.5) -> DataFrame:
    """Join relationships found from names and types: a column that is called, with or without its prefix, like the key of another
    table (``x_name`` with ``namekey`` or ``name_id`` after the start of the table's name) and has its type; each with its
    containment. No such pair gives no row."""
    bare = lambda c: c.lower().split("_", 1)[-1]
    stems = lambda c: {s for s in (re.sub(r"_?(key|id|no)$", "", n) for n in (bare(c), c.lower())) if s} if re.search(r"(key|id|no)$", c.lower()) else set()
    found = []
    for right, rdf in tables.items():
        for rc, kind in rdf.dtypes:
            if any(right.lower().startswith(s) and len(s) > 2 for s in stems(rc)):
                found += [(left, lc, right, rc) for left, ldf in tables.items() if left != right
                          for lc, lkind in ldf.dtypes if (bare(lc) == bare(rc) != "id" or lc.lower() == rc.lower()) and lkind == kind]
    if found:
        return relationships(tables, sorted(found), min_confidence)
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame([], "left_table string, left_column string, right_table string, right_column string, left_keys long, "
                                     "shared_keys long, confidence decimal(20,4)")


#: Columns of one kind can hold each other's values; measures (floating point) are not keys.
KINDS = ((T.IntegralType, "number"), (T.StringType, "text"), (T.DateType, "date"), (T.TimestampType, "time"), (T.TimestampNTZType, "time"))
LONG_TEXT = 64


def _kind(f: T.StructField) -> str | None:
    if isinstance(f.dataType, T.DecimalType):
        return "number" if f.dataType.scale == 0 else None
    return next((name for kind, name in KINDS if isinstance(f.dataType, kind)), None)


def inclusion_dependencies(tables: Mapping[str, DataFrame], min_confidence: float = 0.5) -> DataFrame:
    """How much of every column's values each column of another table has, whatever they are called, from one shuffle.

    First a pass of sketches and extremes over each table (a row a table): a column that by these can neither hold enough of another
    one nor be held by one is left out, with room for the sketches' error. All other columns become (value, column) rows, and a
    value keeps the set of its columns as bits, so it is one row however often and wherever it stands. Counts over the sets
    give every pair. Long texts are compared by their SHA-256. ``right_unique`` tells whether the right column is a key.
    Columns without values, and tables without columns that can be keys, give no row.
    """
    columns = [(n, f.name, _kind(f)) for n, df in tables.items() for f in df.schema.fields if _kind(f)]
    stats = {}
    for name, df in tables.items():
        mine = [c for c in columns if c[0] == name]
        if not mine:
            continue
        aggs = []
        for i, (_, c, kind) in enumerate(mine):
            v = F.col(f"`{c}`")
            edge = F.substring(v, 1, LONG_TEXT) if kind == "text" else v.cast("decimal(38,0)") if kind == "number" else v.cast("string")
            aggs += [F.approx_count_distinct(v).alias(f"d{i}"), F.count(v).alias(f"n{i}"), F.min(edge).alias(f"lo{i}"), F.max(edge).alias(f"hi{i}")]
        row = df.agg(*aggs).first()
        for i, column in enumerate(mine):
            stats[column] = tuple(row[f"{k}{i}"] for k in ("d", "n", "lo", "hi"))

    def may_hold(left, right) -> bool:
        (dl, nl, lo, hi), (dr, nr, rlo, rhi) = stats[left], stats[right]
        return bool(nl and nr) and left[0] != right[0] and left[2] == right[2] and lo <= rhi and rlo <= hi and dl * min_confidence <= 1.5 * dr + 1

    used = [c for c in columns if any(may_hold(c, o) or may_hold(o, c) for o in columns)]
    spark = next(iter(tables.values())).sparkSession
    out = "left_table string, left_column string, right_table string, right_column string, left_keys long, shared_keys long, confidence decimal(20,4), right_unique boolean"
    if not used:
        return spark.createDataFrame([], out)
    rows = []
    for name, df in tables.items():
        items = []
        for i, (n, c, kind) in enumerate(used):
            if n == name:
                v = F.col(f"`{c}`").cast("string")
                v = F.when(F.length(v) > LONG_TEXT, F.concat(F.lit("#"), F.sha2(v, 256))).otherwise(v) if kind == "text" else v
                items.append(F.struct(F.lit(i).alias("c"), F.lit(kind).alias("kind"), v.alias("v")))
        if items:
            rows.append(df.select(F.inline(F.array(*items))).where("v is not null"))
    words = (len(used) + 62) // 63
    bit = lambda w: F.when((F.col("c") / 63).cast("int") == w, F.call_function("shiftleft", F.lit(1).cast("long"), F.col("c") % 63)).otherwise(F.lit(0).cast("long"))
    values = union_all(rows).groupBy("kind", "v").agg(*[F.bit_or(bit(w)).alias(f"m{w}") for w in range(words)])
    sets = values.groupBy(*[f"m{w}" for w in range(words)]).agg(F.count(F.lit(1)).alias("n"))
    members = F.filter(F.sequence(F.lit(0), F.lit(len(used) - 1)), lambda c: F.element_at(
        F.array(*[F.col(f"m{w}") for w in range(words)]), (c / 63).cast("int") + 1).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), c % 63)) != 0)
    pairs = sets.select("n", members.alias("s")).select("n", "s", F.explode("s").alias("l")).select("n", "l", F.explode("s").alias("r")) \
        .groupBy("l", "r").agg(F.sum("n").alias("n"))
    names = spark.createDataFrame([(i, n, c, stats[(n, c, k)][1]) for i, (n, c, k) in enumerate(used)], "i int, t string, c string, filled long")
    keys = pairs.where("l = r").select(F.col("l").alias("i"), F.col("n").alias("keys")).join(names, "i")
    side = lambda p: keys.select(*[F.col(c).alias(f"{p}_{c}") for c in keys.columns])
    ratio = F.col("shared_keys").cast("decimal(20,0)") / F.col("left_keys")
    both = pairs.join(side("l"), F.col("l") == F.col("l_i")).join(side("r"), F.col("r") == F.col("r_i")).where("l_t != r_t")
    return both.select(F.col("l_t").alias("left_table"), F.col("l_c").alias("left_column"), F.col("r_t").alias("right_table"), F.col("r_c").alias("right_column"),
                       F.col("l_keys").alias("left_keys"), F.col("n").alias("shared_keys"), (F.col("r_keys") == F.col("r_filled")).alias("right_unique")) \
        .withColumn("confidence", F.round(ratio, 4)).where(ratio >= min_confidence) \
        .select("left_table", "left_column", "right_table", "right_column", "left_keys", "shared_keys", "confidence", "right_unique")


def same_answer(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: rows only on the left, rows only on the right, and whether both are none."""
    only_l = left.exceptAll(right.select(*left.columns)).agg(F.count(F.lit(1)).alias("n"))
    only_r = right.select(*left.columns).exceptAll(left).agg(F.count(F.lit(1)).alias("n"))
    both = union_all([only_l.select("n", F.lit("l").alias("s")), only_r.select("n", F.lit("r").alias("s"))])
    return both.agg(F.max(F.when(F.col("s") == "l", F.col("n"))).alias("only_left"),
                    F.max(F.when(F.col("s") == "r", F.col("n"))).alias("only_right"),
                    (F.max("n") == 0).alias("equal"))


def differing_rows(left: DataFrame, right: DataFrame, key: Sequence[str], buckets: int = 4096) -> DataFrame:
    """The rows that only one side has, with ``side`` (left or right) and how often there (``copies``), both sides as bags.

    Each side is first summed up to one row per hash bucket of the key: the number of rows and a sum of their hashes, which does not
    depend on order. That is all that is shuffled where both are equal. Only rows of buckets that differ are compared
    row by row. Different rows whose sums of 128 bits agree in a bucket would go unseen.
    """
    columns = left.columns
    right = right.select(*columns)
    every = F.struct(*[F.col(f"`{c}`") for c in columns])
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in key]), F.lit(buckets)).alias("__b")
    big = lambda h: F.sum(h.cast("decimal(20,0)"))

    def prints(df: DataFrame, sign: int) -> DataFrame:
        return df.groupBy(bucket).agg((F.count(F.lit(1)) * sign).alias("n"), (big(F.xxhash64(every)) * sign).alias("h"),
                                      (big(F.xxhash64(F.lit(1), every)) * sign).alias("g"))

    totals = prints(left, 1).unionByName(prints(right, -1)).groupBy("__b").agg(*[F.sum(c).alias(c) for c in ("n", "h", "g")])
    unequal = [r[0] for r in totals.where("n <> 0 or h <> 0 or g <> 0").select("__b").collect()]  # at most ``buckets`` numbers
    mine = lambda df: df.where(bucket.isin(unequal) if unequal else F.lit(False))
    signed = mine(left).select("*", F.lit(1).alias("__s")).unionByName(mine(right).select("*", F.lit(-1).alias("__s")))
    return signed.groupBy(*[f"`{c}`" for c in columns]).agg(F.sum("__s").alias("copies")).where("copies <> 0") \
        .select(*[f"`{c}`" for c in columns], F.when(F.col("copies") > 0, "left").otherwise("right").alias("side"), F.abs("copies").alias("copies"))
