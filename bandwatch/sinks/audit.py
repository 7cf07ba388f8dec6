"""Write audits by order-free fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of a row; columns by name, nulls told apart from empty text, NaNs and zeros each one value."""
    return F.xxhash64(*[x for c in sorted(columns) for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])


def fingerprint(df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """(by..., rows, sum): number and sum of row hashes, by groups or over all.

    Sums do not depend on order or partitioning and count repeated rows; they combine before the shuffle.
    """
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row_hash(columns or df.columns).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("sum"))


def differences(offered: DataFrame, stored: DataFrame, key: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by..., key..., kind): rows that are ``missing`` or ``extra`` in the stored table, or ``changed`` under their key.

    Both sides are summed up by ``by`` first (a day or another partition); only groups whose fingerprints differ are
    compared row by row. Rows of one key are counted together.
    """
    by, key = list(by), list(key)
    columns = offered.columns
    one, two = fingerprint(offered, by), fingerprint(stored.select(*columns), by)
    same = F.col("a.rows").eqNullSafe(F.col("b.rows")) & F.col("a.sum").eqNullSafe(F.col("b.sum"))
    groups = one.alias("a").join(two.alias("b"), _equal("a", "b", by), "full").where(~same).select(
        *[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in by])

    def told(df: DataFrame) -> DataFrame:
        some = df.select(*columns).alias("r").join(groups.alias("g"), _equal("r", "g", by), "left_semi")
        return fingerprint(some, [*by, *[k for k in key if k not in by]], columns)

    keys = list(dict.fromkeys([*by, *key]))
    a, b = told(offered).alias("a"), told(stored).alias("b")
    kind = F.when(F.col("b.rows").isNull(), "missing").when(F.col("a.rows").isNull(), "extra").otherwise("changed")
    return a.join(b, _equal("a", "b", keys), "full").where(~same).select(
        *[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in keys], kind.alias("kind"))


def _equal(left: str, right: str, columns: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out
