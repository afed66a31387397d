"""Declared landing sources, rules, reports and indicators."""

from __future__ import annotations

from dataclasses import dataclass, field

from sedimenta.sources import fixed_values as fv


@dataclass(frozen=True)
class LandingSource:
    """One landing table: where its file is and how its history is kept."""

    name: str
    location: str
    format: str = "csv"
    multiline: bool = False
    ingestion_pattern: str = "overwrite"
    enable_snapshots: bool = True
    snapshot_strategy: str = "check_cols"
    snapshot_check_cols: tuple[str, ...] = ("etiqueta",)


# labels of the weekly sheets hold line breaks
LANDING_SOURCES = tuple(LandingSource(name, f"/datos/csv/{file}", multiline=True) for name, file in fv.LANDING_FILES.items())


@dataclass(frozen=True)
class Rule:
    """Question -> chunk: which mart columns, key, text, tags and privacy a chunk has."""

    id: str
    mart: str
    columns: tuple[str, ...]
    key_columns: tuple[str, ...]
    pii: tuple[str, ...]
    tags: dict[str, str]
    forgetting: str
    expected_max: int
    expected_min: int = 1
    separator: str = " "
    pii_strategy: str = "tokens"
    tags_in_text: tuple[str, ...] = ("ambito", "clasificacion")
    validity_policy: str = "preservar"
    recall_min: float = 0.70
    version: str = "1.0"

    @property
    def template(self) -> str:
        return fv.TEMPLATES[self.id]


def _tags(clearance: str) -> dict[str, str]:
    return {"planta": "column:planta", "ambito": "Seguridad ocupacional", "clasificacion": clearance}


_POINT_COLUMNS = (
    "planta",
    "punto_evaluacion",
    "anio",
    "semana",
    "concentracion_mg_m3",
    "etiqueta_semaforo",
    "veces_sobre_limite",
    "limite_interno_mg_m3",
    "hora_inicio",
    "hora_termino",
    "operador",
    "tecnico",
)

RULES = {
    rule.id: rule
    for rule in (
        Rule(
            id="P00001_M00001",
            mart="M00001",
            columns=_POINT_COLUMNS,
            key_columns=("planta", "punto_evaluacion", "semana", "anio"),
            pii=("operador", "tecnico"),
            tags=_tags("Restringido"),
            forgetting="etiquetas",
            expected_max=50,
        ),
        Rule(
            id="P00002_M00002",
            mart="M00002",
            columns=(
                "planta",
                "anio",
                "semanas_medidas",
                "semanas_label",
                "puntos_medidos",
                "puntos_label",
                "concentracion_promedio_mg_m3",
                "concentracion_max_mg_m3",
                "concentracion_min_mg_m3",
                "registros_sobre_limite",
                "total_registros",
                "pct_sobre_limite",
                "limite_interno_mg_m3",
            ),
            key_columns=("planta", "anio", "semanas_medidas", "semanas_label", "puntos_medidos", "puntos_label"),
            pii=(),
            tags=_tags("Interno"),
            forgetting="borrar_chunk",
            expected_max=20,
        ),
        Rule(
            id="P00003_M00003",
            mart="M00003",
            columns=(
                "planta",
                "punto_evaluacion",
                "anio",
                "semana",
                "concentracion_mg_m3",
                "etiqueta_semaforo",
                "veces_sobre_limite",
                "fecha",
                "hora_inicio",
                "hora_termino",
                "operador",
                "operador_dni",
                "tecnico",
                "tecnico_dni",
                "limite_interno_mg_m3",
            ),
            key_columns=("planta",),
            pii=("operador", "operador_dni", "tecnico", "tecnico_dni"),
            tags=_tags("Restringido"),
            forgetting="borrar_chunk",
            expected_max=10,
        ),
        Rule(
            id="P00004_M00004",
            mart="M00004",
            columns=_POINT_COLUMNS,
            key_columns=("planta", "punto_evaluacion"),
            pii=("operador", "tecnico"),
            tags=_tags("Interno"),
            forgetting="borrar_chunk",
            expected_max=50,
        ),
    )
}


@dataclass(frozen=True)
class Report:
    """A governed table over one mart."""

    id: str
    title: str
    mart: str
    columns: tuple[str, ...]
    order: tuple[tuple[str, str], ...]
    dimensions: dict[str, str] = field(default_factory=lambda: {"planta": "planta"})
    parameters: tuple[str, ...] = ()
    formats: tuple[str, ...] = ("json", "csv", "parquet")


REPORTS = {
    report.id: report
    for report in (
        Report(
            id="concentracion_anual",
            title="Concentración anual de polvo respirable por planta",
            mart="M00002",
            columns=(
                "planta",
                "anio",
                "semanas_medidas",
                "puntos_medidos",
                "concentracion_promedio_mg_m3",
                "concentracion_max_mg_m3",
                "concentracion_min_mg_m3",
                "registros_sobre_limite",
                "total_registros",
                "pct_sobre_limite",
                "limite_interno_mg_m3",
            ),
            order=(("planta", "asc"), ("anio", "asc")),
            parameters=("anio",),
        ),
        Report(
            id="excedencias_semana",
            title="Puntos sobre límite — semana en curso",
            mart="M00001",
            columns=(
                "planta",
                "punto_evaluacion",
                "concentracion_mg_m3",
                "veces_sobre_limite",
                "nivel_semaforo",
                "color_semaforo",
                "fecha",
                "operador",
                "tecnico",
            ),
            order=(("planta", "asc"), ("concentracion_mg_m3", "desc")),
        ),
        Report(
            id="peak_historico",
            title="Peak histórico de concentración por planta",
            mart="M00003",
            columns=(
                "planta",
                "punto_evaluacion",
                "anio",
                "semana",
                "concentracion_mg_m3",
                "veces_sobre_limite",
                "fecha",
                "operador",
                "tecnico",
                "nivel_semaforo",
            ),
            order=(("planta", "asc"),),
        ),
    )
}


@dataclass(frozen=True)
class Indicator:
    """A governed indicator: severity ranges are closed, None is an open end."""

    id: str
    title: str
    mart: str
    unit: str
    threshold: float
    severity: tuple[tuple[float | None, float | None, str], ...]
    # (field, label, format, unit), in display order
    display: tuple[tuple[str, str, str, str | None], ...]
    dimensions: dict[str, str] = field(default_factory=lambda: {"planta": "planta"})


INDICATORS = {
    indicator.id: indicator
    for indicator in (
        Indicator(
            id="concentracion-maxima-ultima-jornada",
            title="Concentración máxima de polvo (última jornada)",
            mart="M00004",
            unit="mg/m³",
            threshold=3.0,
            severity=((None, 1.99, "ok"), (2.0, 2.99, "warning"), (3.0, None, "critico")),
            display=(
                ("planta", "Planta", "texto", None),
                ("punto_evaluacion", "Punto de evaluación", "texto", None),
                ("valor_actual", "Concentración", "numero", "mg/m³"),
                ("estado_limite", "Estado vs límite", "texto", None),
                ("limite_interno_mg_m3", "Límite", "numero", "mg/m³"),
                ("anio", "Año", "entero", None),
                ("semana", "Semana", "entero", None),
            ),
        ),
        Indicator(
            id="pct-sobre-limite-anual",
            title="% de mediciones sobre el límite (anual)",
            mart="M00002",
            unit="%",
            threshold=5.0,
            severity=((None, 4.9, "ok"), (5.0, 14.9, "warning"), (15.0, None, "critico")),
            display=(
                ("planta", "Planta", "texto", None),
                ("anio", "Año", "entero", None),
                ("valor_actual", "% sobre límite", "porcentaje", "%"),
                ("registros_sobre_limite", "Mediciones sobre límite", "entero", None),
                ("total_registros", "Mediciones totales", "entero", None),
                ("limite_interno_mg_m3", "Límite", "numero", "mg/m³"),
            ),
        ),
        Indicator(
            id="puntos-criticos-ultima-jornada",
            title="Puntos sobre el límite (última jornada)",
            mart="M00004",
            unit="puntos",
            threshold=0,
            severity=((None, 0, "ok"), (1, 2, "warning"), (3, None, "critico")),
            display=(
                ("planta", "Planta", "texto", None),
                ("valor_actual", "Puntos sobre límite", "entero", None),
                ("puntos_totales", "Puntos evaluados", "entero", None),
            ),
        ),
    )
}
