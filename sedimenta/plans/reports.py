"""Governed reports over the marts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.governance import governed
from sedimenta.sources.registry import REPORTS, Report


def _order(report: Report) -> list[Column]:
    """The declared order; the other columns follow, so that many equal keys still sort in several partitions."""
    declared = [F.col(c).asc_nulls_last() if way == "asc" else F.col(c).desc_nulls_last() for c, way in report.order]
    return [*declared, *[F.col(c) for c in report.columns if c not in dict(report.order)]]


def report_rows(report_id: str, marts: Mapping[str, DataFrame], ordered: bool = True, **parameters: int | None) -> DataFrame:
    """Columns of a report before governance; optional parameters filter only when given."""
    report = REPORTS.get(report_id)
    if report is None:
        raise KeyError(f"unknown report: {report_id}")
    unknown = set(parameters) - set(report.parameters)
    if unknown:
        raise ValueError(f"report {report_id} has no parameter {sorted(unknown)}")
    out = marts[report.mart]
    for name, value in parameters.items():
        if value is None:
            continue
        if isinstance(value, bool) or not isinstance(value, int):
            raise ValueError(f"parameter {name} must be an integer")
        out = out.filter(F.col(name) == F.lit(value))
    out = out.select(*report.columns)
    return out.orderBy(*_order(report)) if ordered else out


def report(
    report_id: str, marts: Mapping[str, DataFrame], expanded: DataFrame, user_id: str, **parameters: int | None
) -> DataFrame:
    """A report as `user_id` may see it. Marts are complete, so aggregates are never partial."""
    rows = report_rows(report_id, marts, ordered=False, **parameters)
    definition = REPORTS[report_id]
    return governed(rows, expanded, user_id, definition.dimensions).orderBy(*_order(definition))


def report_catalog(permissions: DataFrame) -> DataFrame:
    """Every user's catalogue: id, title, formats and whether the user may consume reports.

    `permissions` is `(user_id, modulo, accion)`; users come from it, enabled or not.
    """
    entries = F.array(
        *[
            F.struct(
                F.lit(r.id).alias("reporte_id"),
                F.lit(r.title).alias("nombre"),
                F.array(*[F.lit(f) for f in r.formats]).alias("formatos"),
            )
            for r in REPORTS.values()
        ]
    )
    users = permissions.groupBy("user_id").agg(
        F.bool_or((F.col("modulo") == "reportes") & (F.col("accion") == "consumir")).alias("habilitado_para_usuario")
    )
    return users.select("user_id", F.inline(entries), "habilitado_para_usuario")
