"""Casts, defaults, parsing, labels and masks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts, rates and ratios keep nine decimals; only results are rounded.
MONEY = "decimal(28,9)"
RATIO = "decimal(18,4)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key(c: str | Column) -> Column:
    """Join key as trimmed text."""
    return F.trim(col(c).cast("string"))


def double_key(c: str | Column) -> Column:
    """Whole number held as a double, as text without exponent or fraction."""
    return col(c).cast("bigint").cast("string")


def money(c: str | Column) -> Column:
    return col(c).cast(MONEY)


def to_money(c: str | Column) -> Column:
    """Amount from raw text or number; null where it is no number."""
    return col(c).try_cast(MONEY)


def ymd_date(c: str | Column) -> Column:
    """Date from a ``yyyymmdd`` number or text; 0 and impossible dates give null."""
    return F.try_to_date(F.nullif(key(c), F.lit("0")), "yyyyMMdd")


def iso_date(c: str | Column) -> Column:
    """Date from the first ten characters; null where they are no date."""
    return F.try_to_date(F.substring(col(c).cast("string"), 1, 10), "yyyy-MM-dd")


def text_or(c: str | Column, default: str) -> Column:
    """Trimmed text with a default for null and blank."""
    return F.coalesce(F.nullif(key(c), F.lit("")), F.lit(default))


def non_blank(c: str | Column) -> Column:
    return col(c).isNotNull() & (key(c) != "")


def ratio(num: str | Column, den: str | Column) -> Column:
    """Quotient as double; null for a zero or missing divisor."""
    return F.try_divide(col(num).cast("double"), F.nullif(col(den).cast("double"), F.lit(0.0)))


def lookup(c: str | Column, mapping: Mapping[str, str], default: Column | None = None) -> Column:
    """Dictionary of codes; unknown codes keep ``default`` (else the code itself)."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.create_map(*pairs)[col(c)] if pairs else F.lit(None)
    return F.coalesce(found, col(c) if default is None else default)


def ladder(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """First rule that holds names the label."""
    out = None
    for cond, label in rules:
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return F.lit(default) if out is None else out.otherwise(default)


def like_ladder(c: str | Column, rules: Mapping[str, Sequence[str]], default: str) -> Column:
    """Label of the first group with a word that the upper-cased text contains."""
    upper = F.upper(col(c))
    conds = []
    for label, words in rules.items():
        hit = upper.contains(words[0].upper())
        for word in words[1:]:
            hit = hit | upper.contains(word.upper())
        conds.append((hit, label))
    return ladder(conds, default)


def bucket(c: str | Column, n: int) -> Column:
    """Deterministic bucket in ``[0, n)`` from the first 60 bits of the MD5 digest."""
    digest = F.md5(col(c).cast("string").cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % F.lit(n)


def strip_quotes(c: str | Column) -> Column:
    return F.regexp_replace(col(c), '^"|"$', "")


def fold(c: str | Column) -> Column:
    """Upper-cased trimmed text for tolerant joins."""
    return F.upper(F.trim(col(c)))


def amount_text(c: str | Column) -> Column:
    """Amount with two decimals, without exponent."""
    return col(c).cast("decimal(38,2)").cast("string")


def mask_sha256(c: str | Column) -> Column:
    return F.sha2(col(c).cast("string"), 256)


def mask_last4(c: str | Column) -> Column:
    return F.concat(F.lit("XXXXX"), F.right(col(c).cast("string"), F.lit(4)))


def mask_zero(c: str | Column) -> Column:
    """The default value of a number; null stays hidden too."""
    return F.lit(0.0)


def mask_middle(c: str | Column) -> Column:
    """First and last two characters; texts of four or fewer are hidden whole."""
    x = col(c)
    return F.when(F.length(x) > 4, F.concat(F.left(x, F.lit(2)), F.lit("****"), F.right(x, F.lit(2)))) \
        .when(x.isNotNull(), F.lit("****"))


def redact(label: str) -> Column:
    return F.lit(f"*** {label} ***")


def income_band(income: str | Column) -> Column:
    """Household tier by monthly net income; the limits are fixed values."""
    x = col(income)
    return F.when(x < 3000, "B40").when(x <= 7000, "M40").when(x > 7000, "T20")


def arrears_bucket(days: str | Column) -> Column:
    """Months in arrears by days past due; the limits are fixed values."""
    d = col(days)
    return F.when(d <= 0, "M0").when(d <= 30, "M1").when(d <= 60, "M2").when(d <= 90, "M3") \
        .when(d > 90, "M4+")


def round2(c: Column) -> Column:
    return F.round(c, 2)
