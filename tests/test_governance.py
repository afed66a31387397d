"""The access matrix on 8 plants x 2 years."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import governance as gov
from sedimenta.operators.lookup import local_rows
from sedimenta.plans import indicators, marts, reports, silver
from sedimenta.sources import fixed_values as fv
from sedimenta.sources import sinks

USERS = {
    "chief": {"planta": ["Todas las plantas"], "ambito": ["Seguridad ocupacional"], "clasificacion": "Restringido"},
    "crusher": {"planta": ["Plantas de chancado"], "ambito": ["Medioambiente"], "clasificacion": "Interno"},
    "auditor": {"planta": ["Todas las plantas"], "ambito": ["Todos"], "clasificacion": "Restringido"},
    "miller": {"planta": ["Plantas de molienda"], "ambito": ["Medioambiente"], "clasificacion": "Interno"},
    "nobody": {"ambito": ["Todos"]},
}


@pytest.fixture(scope="module")
def expanded(spark):
    return gov.expand_grants(gov.user_grants(spark, USERS), gov.group_members(spark)).persist()


@pytest.fixture(scope="module")
def gold(spark, bands):
    rows = [
        (plant, f"P{p}", year, week, float(week + p) / 2, None, "08:00", "09:00", None, None)
        for plant in fv.PLANTS
        for p in range(3)
        for year in (2025, 2026)
        for week in (4, 9)
    ]
    facts = local_rows(
        spark,
        rows,
        "planta string, punto_evaluacion string, anio int, semana int, concentracion_mg_m3 double, fecha date, "
        "hora_inicio string, hora_termino string, operador_alias string, tecnico_alias string",
    )
    aliases = local_rows(
        spark,
        [],
        "alias_fuente string, dni string, tipo_dni string, dni_pais_emisor string, nombre_completo string, tipo_persona string",
    )
    people = (aliases, silver.entity_person(aliases))
    sessions = silver.entity_session(facts)
    return {
        "M00001": marts.over_limit_latest(facts, sessions, *people, bands, ordered=False),
        "M00002": marts.annual_summary(facts, bands, ordered=False),
        "M00003": marts.historic_peak(facts, *people, bands, ordered=False),
        "M00004": marts.latest_session_all(facts, sessions, *people, bands, ordered=False),
    }


@pytest.mark.parametrize(
    "user, year, rows",
    [
        ("chief", None, 16), ("crusher", None, 10), ("auditor", None, 16), ("miller", None, 6), ("nobody", None, 0), ("stranger", None, 0),
        ("auditor", 2026, 8), ("auditor", 2025, 8), ("crusher", 2026, 5), ("miller", 2025, 3),
    ],
)
def test_annual_report(gold, expanded, user, year, rows):
    assert reports.report("concentracion_anual", gold, expanded, user, anio=year).count() == rows


@pytest.mark.parametrize("user, rows", [("chief", 8), ("crusher", 5), ("miller", 3)])
def test_peak_report(gold, expanded, user, rows):
    assert reports.report("peak_historico", gold, expanded, user).count() == rows


def test_exceedances_show_only_granted_plants(gold, expanded):
    plants = {r["planta"] for r in reports.report("excedencias_semana", gold, expanded, "miller").collect()}
    assert plants == {"Molienda SAG", "Molienda Convencional", "CDM"}


def test_report_errors(gold, expanded):
    with pytest.raises(KeyError):
        reports.report("otro", gold, expanded, "chief")
    with pytest.raises(ValueError):
        reports.report("peak_historico", gold, expanded, "chief", anio=2026)
    with pytest.raises(ValueError):
        reports.report("concentracion_anual", gold, expanded, "chief", anio="2026 OR 1=1")
    with pytest.raises(ValueError):
        sinks.write_report(gold["M00002"], "/nowhere", "pdf")


def test_indicators_are_filtered_before_they_count(gold, expanded):
    rows = indicators.indicator("puntos-criticos-ultima-jornada", gold, expanded, "crusher").collect()
    assert {(r["valor_actual"], r["puntos_totales"], r["nivel"], r["sobre_umbral"]) for r in rows} == {(3, 3, "critico", True)}
    assert len(rows) == 5
    with pytest.raises(KeyError):
        indicators.indicator("otro", gold, expanded, "crusher")


@pytest.mark.parametrize("user, rows", [("chief", 16), ("auditor", 16), ("crusher", 0), ("miller", 0), ("nobody", 0)])
def test_required_dimensions_fail_closed(gold, expanded, user, rows):
    tagged = gold["M00002"].withColumn("ambito", F.lit("Seguridad ocupacional"))
    assert gov.governed(tagged, expanded, user, {"planta": "planta", "ambito": "ambito"}).count() == rows


def test_clearance(spark):
    df = local_rows(spark, [(c,) for c in (*fv.CLEARANCES, "otra", None)], "clasificacion string")
    assert {r[0] for r in gov.cleared(df, "clasificacion", "Interno").collect()} == {"Público", "Interno"}
    assert gov.cleared(df, "clasificacion", "ninguna").isEmpty()


def test_context_paths(expanded):
    paths = {r["contexto"] for r in gov.context_paths(expanded).filter("user_id = 'miller'").collect()}
    assert paths == {f"ambito:::Medioambiente_._planta:::{p}" for p in ("Molienda SAG", "Molienda Convencional", "CDM")}
    assert gov.context_paths(expanded).filter("user_id = 'nobody'").isEmpty()


def test_catalog_and_module_permissions(spark):
    permissions = gov.user_permissions(spark, {"a": {"reportes": ["consumir"]}, "b": {"kpis": ["consumir"], "reportes": ["ver"]}})
    rows = reports.report_catalog(permissions).collect()
    assert {(r["user_id"], r["habilitado_para_usuario"]) for r in rows} == {("a", True), ("b", False)}
    assert {r["reporte_id"] for r in rows} == {"concentracion_anual", "excedencias_semana", "peak_historico"}
    assert {r["user_id"] for r in gov.may(permissions, "kpis").collect()} == {"b"}


def test_report_sinks(spark, gold, tmp_path):
    for fmt in sinks.REPORT_FORMATS:
        path = str(tmp_path / fmt)
        sinks.write_report(gold["M00002"], path, fmt)
        reader = spark.read.option("header", True)
        assert reader.format(fmt).load(path).count() == 16
