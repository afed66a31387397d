"""Wide weekly sheets <-> long rows.

A sheet frame holds any number of sheets: identifying columns, `etiqueta` and
`columnNN` text columns, one row per attribute.
"""

from __future__ import annotations

import operator
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.functions.text import blank_to_null, to_date, to_double, to_int
from sedimenta.functions.time import utc_iso, year_from_position
from sedimenta.sources import fixed_values as fv


def unpivot_weeks(wide: DataFrame, ids: Sequence[str] = ("etiqueta",)) -> DataFrame:
    """One row per non-NULL week cell: the ids, `col_nombre`, `valor`."""
    weeks = [c for c in wide.columns if c not in ids]
    return wide.unpivot(list(ids), weeks, "col_nombre", "valor").filter(F.col("valor").isNotNull())


def _label() -> Column:
    return F.trim("etiqueta")


def _any(tests: Iterable[Column]) -> Column:
    return reduce(operator.or_, tests)


def _any_like(patterns: Sequence[str]) -> Column:
    return _any(_label().like(pattern) for pattern in patterns)


def week_headers(long: DataFrame, sheet: Sequence[str] = ()) -> DataFrame:
    """Week number of each column that has one."""
    number = to_int(F.col("valor"))
    return (
        long.filter(_label().isin(*fv.WEEK_LABELS))
        .select(*sheet, "col_nombre", number.alias("semana_num"))
        .filter(F.col("semana_num").isNotNull())
    )


def _metadata_tests() -> dict[str, Column]:
    label = _label()
    return {
        "fecha_str": label.like(fv.DATE_PATTERN),
        "operador_alias": label.like(fv.OPERATOR_PATTERN),
        "tecnico_alias": _any_like(fv.TECHNICIAN_PATTERNS),
        "hora_inicio": label == fv.START_LABEL,
        "hora_termino": label == fv.END_LABEL,
    }


def metadata_pivot(long: DataFrame, sheet: Sequence[str] = ()) -> DataFrame:
    """Date, people and hours of each column; one row per column.

    Only header rows can contribute, so the others are dropped before the aggregation.
    Columns without any header row are absent, which a left join turns into the same NULLs.
    """
    parts = _metadata_tests()
    return (
        long.filter(_any(parts.values()))
        .groupBy(*sheet, "col_nombre")
        .agg(*[F.max(F.when(test, F.col("valor"))).alias(name) for name, test in parts.items()])
    )


def column_headers(long: DataFrame, sheet: Sequence[str] = ()) -> DataFrame:
    """Week number and metadata of each column that has a week, in one pass over the header rows.

    The same rows as `week_headers` left-joined with `metadata_pivot`: a column
    with two week rows keeps both. The list per column holds the sheet's week
    rows only.
    """
    label = _label()
    is_week = label.isin(*fv.WEEK_LABELS)
    parts = _metadata_tests()
    weeks = F.collect_list(F.when(is_week, to_int(F.col("valor")))).alias("_weeks")
    values = [F.max(F.when(test, F.col("valor"))).alias(name) for name, test in parts.items()]
    grouped = long.filter(is_week | _any(parts.values())).groupBy(*sheet, "col_nombre").agg(weeks, *values)
    return grouped.select(*sheet, "col_nombre", *parts, F.explode("_weeks").alias("semana_num"))


def measurement_filter(long: DataFrame, sheet: Sequence[str] = ()) -> DataFrame:
    """Rows that are a concentration of a measuring point: 0 <= v < 100 and not a header row."""
    value = to_double(F.col("valor"))
    label = _label()
    return (
        long.filter(~label.isin(*fv.NON_POINT_LABELS) & ~_any_like(fv.NON_POINT_PATTERNS) & (label != ""))
        .select(*sheet, "col_nombre", label.alias("punto_evaluacion"), value.alias("concentracion_mg_m3"))
        .filter((F.col("concentracion_mg_m3") >= 0) & (F.col("concentracion_mg_m3") < fv.CONCENTRATION_UPPER_BOUND))
    )


def wide_to_bronze(
    wide: DataFrame,
    plant: str = "planta",
    sheet: Sequence[str] = (),
    source: str | None = None,
    base_year: str | int = fv.BASE_YEAR,
    weeks_in_first_year: int = fv.WEEKS_IN_FIRST_YEAR,
    loaded_at: Column | None = None,
) -> DataFrame:
    """Long bronze fact of all sheets in `wide` at once.

    `plant` names the plant column and `sheet` the columns that identify a sheet
    (the plant alone if empty: two sheets of one plant need their own id).
    `base_year` is a number or the name of a column with the sheet's first year;
    `source` names a column with the sheet's source.
    The header lookup has one row per sheet and column; whether it is sent to all
    tasks or shuffled is decided at run time from its size.
    """
    ids = list(dict.fromkeys([plant, *sheet, *([source] if source else []), *([base_year] if isinstance(base_year, str) else [])]))
    long = unpivot_weeks(wide, [*ids, "etiqueta"])
    headers = column_headers(long, ids)
    joined = measurement_filter(long, ids).join(headers, [*ids, "col_nombre"], "inner")
    year = year_from_position(
        F.col("col_nombre"), F.col(base_year) if isinstance(base_year, str) else base_year, weeks_in_first_year
    )
    return joined.select(
        F.col(plant).alias("planta"),
        "punto_evaluacion",
        F.col("semana_num").alias("semana"),
        year.alias("anio"),
        "concentracion_mg_m3",
        to_date(F.col("fecha_str")).alias("fecha"),
        blank_to_null(F.col("operador_alias")).alias("operador_alias"),
        blank_to_null(F.col("tecnico_alias")).alias("tecnico_alias"),
        "hora_inicio",
        "hora_termino",
        F.col("col_nombre").alias("_col_posicion"),
        (F.col(source) if source else F.lit(None).cast("string")).alias("_bronce_fuente"),
        utc_iso(loaded_at if loaded_at is not None else F.current_timestamp()).alias("_bronce_loaded_at"),
    )


def stack_sheets(sheets: dict[str, DataFrame], plants: dict[str, str]) -> DataFrame:
    """All sheets as one frame with `planta` and `_fuente`; narrower sheets get NULL columns."""
    stacked: DataFrame | None = None
    for name, frame in sheets.items():
        tagged = frame.select(
            F.lit(plants[name]).alias("planta"), F.lit(fv.SNAPSHOT_PREFIX + name).alias("_fuente"), "*"
        )
        stacked = tagged if stacked is None else stacked.unionByName(tagged, allowMissingColumns=True)
    if stacked is None:
        raise ValueError("no sheet to stack")
    return stacked


def pivot_cells(cells: DataFrame, row: Sequence[str], width: int | None = None) -> DataFrame:
    """Cells `(row..., columna, valor)` -> `row..., column01..`; sheet column 2 is `column01`.

    The frame is as wide as the rightmost cell; a known `width` saves looking for it and must not be smaller.
    """
    if width is None:
        width = (cells.agg(F.max("columna").alias("n")).first()["n"] or 1) - 1
    packed = pack_rows(cells.filter(F.col("columna") >= 2), row)
    beyond = F.exists(F.map_keys("_cells"), lambda k: k > width + 1)
    checked = F.when(beyond, F.raise_error(F.lit(f"a cell lies right of column {width}"))).otherwise(F.col("_cells"))
    packed = packed.withColumn("_cells", checked)
    return packed.select(*row, *[F.col("_cells")[i + 1].alias(f"column{i:02d}") for i in range(1, width + 1)])


def pack_rows(cells: DataFrame, row: Sequence[str]) -> DataFrame:
    """One map column -> value per row, at most as large as a sheet is wide: one aggregate, not one per column."""
    entry = F.struct(F.col("columna").cast("int").alias("k"), "valor")
    return cells.groupBy(*row).agg(F.map_from_entries(F.collect_list(entry)).alias("_cells"))


def sheet_widths(cells: DataFrame, first_row: int = 2) -> DataFrame:
    """Data columns of each sheet: the run of filled cells of the header row from column 2 on.

    Only one row per sheet is windowed, so a partition is as large as a sheet is wide.
    """
    order = Window.partitionBy("hoja").orderBy("columna")
    return (
        cells.filter((F.col("fila") == first_row) & (F.col("columna") >= 2) & F.col("valor").isNotNull())
        .withColumn("_gap", F.col("columna") - F.row_number().over(order))
        .filter("_gap = 1")
        .groupBy("hoja")
        .agg(F.count("*").cast("int").alias("n_columnas"))
    )


def sheet_to_wide(cells: DataFrame, first_row: int = 2) -> DataFrame:
    """Wide rows from a cell table `(hoja, fila, columna, valor)` with text values.

    The frame is as wide as the widest header row, which is looked up first. Title rows go, rows without a label go,
    sheets without data columns go; empty cells inside a sheet's own width become '' and columns outside it NULL.
    """
    widths = sheet_widths(cells, first_row)
    width = widths.agg(F.max("n_columnas").alias("n")).first()["n"] or 0
    body = cells.filter((F.col("fila") >= first_row) & F.col("columna").between(1, width + 1))
    rows = pack_rows(body, ["hoja", "fila"]).withColumn("etiqueta", F.col("_cells")[1]).filter(F.col("etiqueta").isNotNull())
    joined = rows.join(widths, "hoja", "inner")
    inside = [
        F.when(F.lit(i) <= F.col("n_columnas"), F.coalesce(F.col("_cells")[i + 1], F.lit(""))).alias(f"column{i:02d}")
        for i in range(1, width + 1)
    ]
    return joined.select("hoja", "fila", "etiqueta", *inside)


def select_sheets(cells: DataFrame, sheet_files: dict[str, str] = fv.SHEET_FILES) -> DataFrame:
    """Only the sheets that have a landing file, with that file's name."""
    file = F.lit(None).cast("string")
    for name, target in sheet_files.items():
        file = F.when(F.col("hoja") == name, F.lit(target)).otherwise(file)
    return cells.withColumn("archivo", file).filter(F.col("archivo").isNotNull())
