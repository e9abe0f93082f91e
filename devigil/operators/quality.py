"""Typed load: rule columns, duplicate keys and referential integrity.

Rows that break a rule are split off with their reasons instead of being retried and dropped, so
accepted plus rejected is always the whole input.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devigil.functions.temporal import parse_date
from devigil.sources.schemas import TableSpec, is_array

REASONS = "reject_reasons"


class Split(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame


def with_reasons(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Collect the names of the violated rules of each row (a NULL verdict is no violation)."""
    flags = [F.when(broken, F.lit(name)) for name, broken in rules.items()]
    return df.withColumn(REASONS, F.array_compact(F.array(*flags)))


def split_by_rules(df: DataFrame, rules: Mapping[str, Column]) -> Split:
    checked = with_reasons(df, rules)
    return Split(
        checked.filter(F.size(REASONS) == 0).drop(REASONS), checked.filter(F.size(REASONS) > 0)
    )


def typed(column: T.StructField) -> Column:
    """The typed value of a textual column, NULL where it cannot be parsed."""
    source, kind = F.col(column.name), column.dataType
    if isinstance(kind, T.DateType):
        return parse_date(source)
    if isinstance(kind, (T.CharType, T.VarcharType)) or is_array(column):
        return source
    return source.try_cast(kind)


def table_rules(spec: TableSpec) -> dict[str, Column]:
    """One rule per typed, bounded or enumerated column of a table."""
    rules = {}
    for column in spec.columns:
        source = F.col(column.name)
        if isinstance(column.dataType, (T.CharType, T.VarcharType)):
            rules[f"too long: {column.name}"] = F.length(source) > column.dataType.length
        elif not isinstance(column.dataType, T.StringType) and not is_array(column):
            rules[f"bad {column.dataType.simpleString()}: {column.name}"] = (
                source.isNotNull() & typed(column).isNull()
            )
    for name, allowed in spec.domains.items():
        rules[f"outside domain: {name}"] = ~F.lower(F.col(name)).isin(*map(str.lower, allowed))
    return rules


def typed_load(df: DataFrame, spec: TableSpec) -> Split:
    """Apply the table's rules, then convert what passed."""
    accepted, rejected = split_by_rules(df, table_rules(spec))
    return Split(accepted.withColumns({c.name: typed(c) for c in spec.columns}), rejected)


def split_first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], reason: str = "duplicate key"
) -> Split:
    """Keep the first row of every key; rows with a NULL in the key all pass.

    ``order`` must identify a row. The first row per key comes from a partially aggregated minimum
    over the key and order columns alone, and is matched back on the order columns. Those are
    unique, so a key that holds a third of all rows neither lands in one task nor skews the join.
    """
    keyed = df.dropna(subset=list(keys))
    position = F.struct(*order) if len(order) > 1 else F.col(order[0])
    firsts = keyed.groupBy(*keys).agg(F.min(position).alias("first"))
    chosen = firsts.select("first.*") if len(order) > 1 else firsts.select(
        F.col("first").alias(order[0])
    )
    loose = df.filter(~_all_present(keys))
    return Split(
        keyed.join(chosen, list(order), "left_semi").unionByName(loose),
        keyed.join(chosen, list(order), "left_anti").withColumn(
            REASONS, F.array(F.lit(reason))
        ),
    )


def _all_present(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present


def split_by_parent(
    children: DataFrame, parents: DataFrame, key: str, reason: str = "parent rejected"
) -> Split:
    """Children whose parent was accepted, and the others."""
    ids = parents.select(key)
    return Split(
        children.join(ids, key, "left_semi"),
        children.join(ids, key, "left_anti").withColumn(REASONS, F.array(F.lit(reason))),
    )


def all_rejected(*parts: DataFrame) -> DataFrame:
    """The rejects of several steps side by side."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged
