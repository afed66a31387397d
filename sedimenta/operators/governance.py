"""Row-level governance: grants, groups, clearance, context paths.

Frames: grants `(user_id, dimension, granted)`, group members `(dimension,
grupo, valor)`, module permissions `(user_id, modulo, accion)`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.lookup import distinct_for_join, local_rows
from sedimenta.sources import fixed_values as fv

GRANTS_SCHEMA = "user_id string, dimension string, granted string"
MEMBERS_SCHEMA = "dimension string, grupo string, valor string"
PERMISSIONS_SCHEMA = "user_id string, modulo string, accion string"


def group_members(spark: SparkSession, groups: Mapping[str, Mapping[str, Sequence[str]]] = fv.GROUPS) -> DataFrame:
    """Declared groups as rows."""
    rows = [(d, g, v) for d, by_group in groups.items() for g, values in by_group.items() for v in values]
    return local_rows(spark, rows, MEMBERS_SCHEMA)


def user_grants(spark: SparkSession, users: Mapping[str, Mapping[str, str | Sequence[str]]]) -> DataFrame:
    """User declarations `{user: {dimension: value or values}}` as rows."""
    rows = [
        (user, dimension, value)
        for user, dimensions in users.items()
        for dimension, values in dimensions.items()
        for value in ([values] if isinstance(values, str) else values)
    ]
    return local_rows(spark, rows, GRANTS_SCHEMA)


def user_permissions(spark: SparkSession, users: Mapping[str, Mapping[str, Sequence[str]]]) -> DataFrame:
    """Module permissions `{user: {module: actions}}` as rows."""
    rows = [(u, m, a) for u, modules in users.items() for m, actions in modules.items() for a in actions]
    return local_rows(spark, rows, PERMISSIONS_SCHEMA)


def expand_grants(grants: DataFrame, members: DataFrame) -> DataFrame:
    """Concrete values per user and dimension: groups become their members, values stay."""
    by_group = members.select("dimension", F.col("grupo").alias("granted"), "valor")
    return (
        grants.join(by_group, ["dimension", "granted"], "left")
        .select("user_id", "dimension", F.coalesce("valor", "granted").alias("valor"))
        .distinct()
    )


def governed(df: DataFrame, expanded: DataFrame, user_id: str, required: Mapping[str, str]) -> DataFrame:
    """Rows a user may see: for every required dimension the row's value is granted.

    A user without a grant in a required dimension sees nothing; dimensions not
    required do not filter. Only semi joins, so rows are never repeated.
    """
    out = df
    for dimension, column in required.items():
        allowed = expanded.filter((F.col("user_id") == user_id) & (F.col("dimension") == dimension))
        allowed = distinct_for_join(allowed.select(F.col("valor").alias(column)), column)
        out = out.join(allowed, column, "left_semi")
    return out


def visible_counts(df: DataFrame, expanded: DataFrame, users: DataFrame, required: Mapping[str, str]) -> DataFrame:
    """`(user_id, filas)`: how many rows `governed` shows to each of `users(user_id)`, all users at once.

    Rows are counted by their values of the required dimensions first; only those counts meet the grants. A user
    without a grant in a required dimension, or without any, has 0.
    """
    columns = list(required.values())
    seen = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    for i, (dimension, column) in enumerate(required.items()):
        granted = expanded.filter(F.col("dimension") == dimension).select("user_id", F.col("valor").alias(column)).distinct()
        seen = seen.join(granted, [column] if i == 0 else ["user_id", column])
    shown = seen.groupBy("user_id").agg(F.sum("_n").alias("filas"))
    return users.select("user_id").distinct().join(shown, "user_id", "left").select("user_id", F.coalesce("filas", F.lit(0)).alias("filas"))


def clearance_rank(value: Column, order: Sequence[str] = fv.CLEARANCES) -> Column:
    """Position of an ordinal value, NULL for an unknown one."""
    rank = F.lit(None).cast("int")
    for i, name in enumerate(order):
        rank = F.when(value == name, F.lit(i)).otherwise(rank)
    return rank


def cleared(df: DataFrame, column: str, clearance: str | Column, order: Sequence[str] = fv.CLEARANCES) -> DataFrame:
    """Rows whose ordinal value is at most the user's; unknown values on either side are hidden."""
    limit = F.lit(clearance) if isinstance(clearance, str) else clearance
    return df.filter(clearance_rank(F.col(column), order) <= clearance_rank(limit, order))


def context_paths(
    expanded: DataFrame,
    levels: Sequence[str] = fv.CONTEXT_LEVELS,
    pair_separator: str = fv.PAIR_SEPARATOR,
    value_separator: str = fv.VALUE_SEPARATOR,
) -> DataFrame:
    """The context tree of each user, one path per leaf: `dim:::value_._dim:::value`.

    A user without a value at some level has no path. Paths per user are the
    product of their declared values, which is what the tree shows.
    """
    out: DataFrame | None = None
    for i, level in enumerate(levels):
        step = expanded.filter(F.col("dimension") == level).select(
            "user_id", F.concat(F.lit(level + value_separator), F.col("valor")).alias(f"_p{i}")
        )
        out = step if out is None else out.join(step, "user_id", "inner")
    if out is None:
        raise ValueError("a context tree needs at least one level")
    return out.select("user_id", F.concat_ws(pair_separator, *[f"_p{i}" for i in range(len(levels))]).alias("contexto"))


def may(permissions: DataFrame, module: str, action: str = "consumir") -> DataFrame:
    """Users with a permission on a module."""
    return permissions.filter((F.col("modulo") == module) & (F.col("accion") == action)).select("user_id").distinct()
