"""Lookups, merges and counts over wide tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions.text import blank_count, conforming_status, is_empty, maybe, norm, strip

#: Lookup tables up to this many rows are broadcast; larger ones are joined by shuffle or as AQE finds fit.
BROADCAST_ROWS = 10_000


def pairs(spark, mapping: dict[str, str | None], key: str = "key", value: str = "value") -> DataFrame:
    """A dictionary as a table."""
    return spark.createDataFrame([*mapping.items()], f"{key} string, {value} string")


def small(df: DataFrame, rows: int | None) -> DataFrame:
    """With a broadcast hint if the number of rows is known and small."""
    return F.broadcast(df) if rows is not None and rows <= BROADCAST_ROWS else df


def lookup(df: DataFrame, key: str, target: str, mapping: dict[str, str | None]) -> DataFrame:
    """`df` with `target` filled from the mapping by the stripped key, and columns <target>_status and <target>_hit (null without a key).

    A miss or a null in the mapping leaves the cell; a conflict overwrites it.
    """
    table = small(pairs(df.sparkSession, mapping, "_key", "_value").withColumn("_hit", F.lit(True)), len(mapping))
    current = maybe(df, target)
    out = df.withColumn("_k", norm(maybe(df, key))).join(table, F.col("_k") == F.col("_key"), "left")
    return out.withColumns(
        {
            f"{target}_status": conforming_status("_value", current),
            f"{target}_hit": F.when(F.col("_k").isNotNull(), F.coalesce("_hit", F.lit(False))),
            target: F.coalesce("_value", current),
        }
    ).drop("_k", "_key", "_value", "_hit")


def status_counts(df: DataFrame, *targets: str) -> DataFrame:
    """(target, filled, confirmed, overwritten, missing): one pass; conflicts count as warnings too, so they are in `missing`."""
    names = ("filled", "confirmed", "overwritten")
    cells = [F.count_if(F.col(f"{t}_status") == n).alias(f"{t}_{n}") for t in targets for n in names] + [F.count_if(~F.col(f"{t}_hit")).alias(f"{t}_miss") for t in targets]
    stacked = ", ".join(f"'{t}', {', '.join(f'`{t}_{n}`' for n in names)}, `{t}_miss` + `{t}_overwritten`" for t in targets)
    return df.agg(*cells).selectExpr(f"stack({len(targets)}, {stacked}) as (target, filled, confirmed, overwritten, missing)")


def misses(df: DataFrame, key: str, target: str, row: str) -> DataFrame:
    """(line, column, value, message): the log of keys that the lookup doesn't know and of conflicts; lines count the header and from 1."""
    kind = F.when(F.col(f"{target}_status") == "overwritten", "conflict").when(~F.col(f"{target}_hit"), "not in mapping")
    return df.withColumn("message", kind).where("message is not null").select((F.col(row) + 2).alias("line"), F.lit(key).alias("column"), F.col(key).alias("value"), "message")


def merge(left: DataFrame, right: DataFrame, key: str, wanted: list[str], right_key: str | None = None) -> DataFrame:
    """Left join on the stripped key as text; missing keys equal each other (as 'nan'), and equal keys on the right multiply rows."""
    right_key = right_key or key
    text = lambda c: F.coalesce(strip(c.cast("string")), F.lit("nan"))
    kept = [c for c in wanted if c in right.columns]
    right = right.select(text(F.col(right_key)).alias("_key"), *kept)
    return left.withColumn(key, text(F.col(key))).join(right, F.col(key) == F.col("_key"), "left").drop("_key")


def absent(df: DataFrame, wanted: list[str]) -> list[str]:
    return [c for c in wanted if c not in df.columns]


def placed(df: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """Each group's columns directly after its base column (found without regard to case); groups without a base go last."""
    extra = {c for g in groups.values() for c in g}
    order: list[str] = []
    bases = {b.lower(): g for b, g in groups.items()}
    for c in df.columns:
        if c not in extra:
            order += [c, *(x for x in bases.pop(c.lower(), []) if x in df.columns)]
    order += [x for g in bases.values() for x in g if x in df.columns]
    return df.select(*(f"`{c}`" for c in dict.fromkeys(order)))


def regrouped(df: DataFrame, key: str, levels: list[str], suffixes: list[str]) -> DataFrame:
    """The key first, then each level's column with its own (<level>_<suffix>), then all other columns, each once."""
    order = [key, *(c for level in levels for c in (level, *(f"{level}_{x}" for x in suffixes)))]
    return df.select(*(f"`{c}`" for c in dict.fromkeys([c for c in order if c in df.columns] + df.columns)))


def filled_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, filled, total) in one scan."""
    columns = columns or df.columns
    one = df.agg(F.count("*").alias("_n"), *(F.count_if(blank_count(F.col(f"`{c}`").cast("string"))).alias(f"_{i}") for i, c in enumerate(columns)))
    return one.selectExpr(f"stack({len(columns)}, {', '.join(f'{c!r}, _{i}, _n' for i, c in enumerate(columns))}) as (column, filled, total)")


def empties(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, empty): cells that the builders take as empty."""
    one = df.agg(*(F.count_if(is_empty(F.col(f"`{c}`").cast("string"))).alias(f"_{i}") for i, c in enumerate(columns)))
    return one.selectExpr(f"stack({len(columns)}, {', '.join(f'{c!r}, _{i}' for i, c in enumerate(columns))}) as (column, empty)")


def coverage(df: DataFrame, level: str, matched: Column, group: str, authorities: dict[str, Column]) -> DataFrame:
    """(level, group, n, matched, unmatched, one count an authority) by group and in total (null)."""
    counts = [F.count("*").alias("n"), F.count_if(matched).alias("matched"), F.count_if(~matched).alias("unmatched"), *(F.count_if(c).alias(a) for a, c in authorities.items())]
    return df.rollup(group).agg(*counts).select(F.lit(level).alias("level"), F.col(group), "n", "matched", "unmatched", *authorities)


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def report_order(df: DataFrame) -> DataFrame:
    """By level, then score with missing ones first, then value."""
    return df.orderBy("level", F.col("score").asc_nulls_first(), "value")
