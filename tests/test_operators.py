from __future__ import annotations

from datetime import datetime

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sedimenta.operators import chunks as ch
from sedimenta.operators import context, history, metrics, ranking, reshape, vectors
from sedimenta.operators.lookup import band_lookup, internal_limit, local_rows
from sedimenta.operators.people import alias_names, person_roles, with_people
from sedimenta.plans import indicators, marts, silver
from sedimenta.sources.registry import INDICATORS, RULES

WEEK1, WEEK2 = datetime(2026, 1, 5), datetime(2026, 1, 12)
ALIASES = "alias_fuente string, dni string, tipo_dni string, dni_pais_emisor string, nombre_completo string, tipo_persona string"
BRONZE = (
    "planta string, punto_evaluacion string, anio int, semana int, concentracion_mg_m3 double, fecha date, "
    "hora_inicio string, hora_termino string, operador_alias string, tecnico_alias string"
)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- lookups ---------------------------------------------------------------


def test_local_rows_are_a_local_relation_of_known_size(spark):
    df = local_rows(spark, [(1, "a"), (2, None)], "k int, v string")
    assert tuples(df) == [(1, "a"), (2, None)]
    assert df._jdf.queryExecution().optimizedPlan().getClass().getSimpleName() == "LocalRelation"


def test_internal_limit(bands):
    assert internal_limit(bands).first()["mg_m3"] == 2.5


VALUES = [0.0, 0.1, 0.25, 0.3, 0.5, 2.4999, 2.5, 4.99, 5.0, 80.0, float("inf"), float("nan"), -1.0, float("-inf"), None]
LEVELS = [1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 5, 5, None, None, None]


def test_bands_are_half_open_with_open_top(spark, bands):
    df = local_rows(spark, [(i, v) for i, v in enumerate(VALUES)], "i int, v double")
    got = dict(tuples(band_lookup(df, bands, "v", {"nivel": "n"}).select("i", "n")))
    assert [got[i] for i in range(len(VALUES))] == LEVELS


def test_overlapping_bands_give_every_match(spark, bands):
    extra = bands.select(
        F.lit(9).alias("nivel"), F.lit(1.0).alias("concentracion_min_mg_m3"), F.lit(3.0).alias("concentracion_max_mg_m3"),
        "color", "etiqueta", "es_sobre_limite_interno",
    ).limit(1)
    df = local_rows(spark, [(2.0,), (2.7,), (4.0,)], "v double")
    got = band_lookup(df, bands.unionByName(extra), "v", {"nivel": "n"}).select("v", "n")
    assert tuples(got) == [(2.0, 3), (2.0, 9), (2.7, 4), (2.7, 9), (4.0, 4)]


def test_many_bands_go_through_the_range_join_and_agree(spark):
    rows = [(i, i / 10, (i + 1) / 10, "c", "e", False) for i in range(200)]
    many = local_rows(spark, rows, (
        "nivel int, concentracion_min_mg_m3 double, concentracion_max_mg_m3 double, color string, etiqueta string, "
        "es_sobre_limite_interno boolean"
    ))
    values = [round(i * 0.037, 3) for i in range(600)]
    df = local_rows(spark, [(v,) for v in values], "v double")
    got = {r["v"]: r["n"] for r in band_lookup(df, many, "v", {"nivel": "n"}).collect()}
    for v in values:
        brute = [n for n, low, high, *_ in rows if low <= v < high]
        assert got[v] == (brute[0] if brute else None)


# --- reshape ---------------------------------------------------------------


def sheet(spark, rows, weeks):
    schema = "etiqueta string, " + ", ".join(f"column{i:02d} string" for i in range(1, weeks + 1))
    return local_rows(spark, rows, schema)


SHEET = [
    ("Semanas", "51", "52", None, "1"),
    ("Fecha medición", "2025-12-15", "2025-12-22", "2025-12-29", "bad"),
    (" Operador turno", " Ana ", "Ana", "Ana", ""),
    ("Técnico higiene", "Luz", None, "Luz", "Luz"),
    ("Hora inicio", "08:00", "08:30", "09:00", "09:30"),
    ("Hora termino", "09:00", "09:30", "10:00", "10:30"),
    ("Lugar Monitoreo", "1", "1", "1", "1"),
    ("Tratamiento tph", "1100", "1800", "1200", "1300"),
    (" Correa 1 ", "0.5", "x", "2.5", "3"),
    ("Correa 2", None, "99.99", "1", "100"),
    ("Correa 3", "-1", "0", "nan", "1d"),
    ("", "1", "1", "1", "1"),
    (None, "1", "1", "1", "1"),
]


def test_wide_to_bronze(spark):
    wide = sheet(spark, SHEET, 4).withColumn("planta", F.lit("CDM"))
    out = reshape.wide_to_bronze(wide, base_year=2025, weeks_in_first_year=3)
    got = tuples(
        out.select("punto_evaluacion", "semana", "anio", "concentracion_mg_m3", F.col("fecha").cast("string"),
                   "operador_alias", "tecnico_alias", "hora_inicio", "_col_posicion")
    )
    assert got == sorted([
        ("Correa 1", 51, 2025, 0.5, "2025-12-15", "Ana", "Luz", "08:00", "column01"),
        ("Correa 1", 1, 2026, 3.0, None, None, "Luz", "09:30", "column04"),
        ("Correa 2", 52, 2025, 99.99, "2025-12-22", "Ana", None, "08:30", "column02"),
        ("Correa 3", 52, 2025, 0.0, "2025-12-22", "Ana", None, "08:30", "column02"),
    ], key=repr)
    assert out.schema["anio"].dataType.simpleString() == "int"


def test_one_pass_headers_equal_the_two_step_join(spark):
    twice = [*SHEET, ("Semana", "51", "7", None, None)]
    long = reshape.unpivot_weeks(sheet(spark, twice, 4))
    names = ["col_nombre", "semana_num", "fecha_str", "operador_alias", "tecnico_alias", "hora_inicio", "hora_termino"]
    joined = reshape.week_headers(long).join(reshape.metadata_pivot(long), "col_nombre", "left").select(*names)
    assert tuples(reshape.column_headers(long).select(*names)) == tuples(joined)


def test_two_sheets_of_one_plant_stay_apart(spark):
    first = sheet(spark, [("Semanas", "1"), ("P", "1")], 1)
    second = sheet(spark, [("Semanas", "1", "2"), ("P", "2", "3")], 2)
    stacked = reshape.stack_sheets({"a": first, "b": second}, {"a": "CDM", "b": "CDM"})
    out = reshape.wide_to_bronze(stacked, sheet=["_fuente"], source="_fuente")
    assert tuples(out.select("semana", "concentracion_mg_m3", "_bronce_fuente")) == [
        (1, 1.0, "snap_a"), (1, 2.0, "snap_b"), (2, 3.0, "snap_b"),
    ]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.one_of(st.none(), st.text("abc1.", min_size=1, max_size=3)), min_size=3, max_size=3), min_size=1, max_size=4))
def test_unpivot_undoes_the_pivot(spark, grid):
    cells = [("h", r, c + 2, v) for r, row in enumerate(grid) for c, v in enumerate(row) if v is not None]
    df = local_rows(spark, cells, "hoja string, fila int, columna int, valor string")
    long = reshape.unpivot_weeks(reshape.pivot_cells(df, ["hoja", "fila"], 3), ["hoja", "fila"])
    back = long.select("hoja", "fila", (F.substring("col_nombre", 7, 3).cast("int") + 1).alias("columna"), "valor")
    assert tuples(back) == sorted(cells, key=repr)


def test_sheet_to_wide(spark):
    cells = [
        ("A", 1, 1, "title"), ("A", 1, 2, "x"),
        ("A", 2, 1, "Semanas"), ("A", 2, 2, "1"), ("A", 2, 3, "2"), ("A", 2, 5, "4"),
        ("A", 3, 1, "P1"), ("A", 3, 2, "0.5"), ("A", 3, 4, "9"),
        ("A", 4, 2, "no label"),
        ("B", 2, 1, "Semanas"), ("B", 3, 1, "P1"), ("B", 3, 2, "1"),
        ("C", 2, 1, "Semanas"), ("C", 2, 2, "1"), ("C", 5, 1, "only label"),
        *[("D", 2, c, str(c - 1)) for c in range(2, 7)], ("D", 2, 1, "Semana"),
    ]
    df = local_rows(spark, cells, "hoja string, fila int, columna int, valor string")
    assert tuples(reshape.sheet_to_wide(df)) == sorted([
        ("A", 2, "Semanas", "1", "2", None, None, None), ("A", 3, "P1", "0.5", "", None, None, None),
        ("C", 2, "Semanas", "1", None, None, None, None), ("C", 5, "only label", "", None, None, None, None),
        ("D", 2, "Semana", "1", "2", "3", "4", "5"),
    ], key=repr)


def test_pivot_is_as_wide_as_its_cells_and_refuses_to_drop_any(spark):
    df = local_rows(spark, [("h", 2, "a"), ("h", 7, "b")], "hoja string, columna int, valor string")
    assert tuples(reshape.pivot_cells(df, ["hoja"])) == [("h", "a", None, None, None, None, "b")]
    with pytest.raises(Exception, match="right of column 3"):
        reshape.pivot_cells(df, ["hoja"], 3).collect()


def test_select_sheets(spark):
    df = local_rows(spark, [("Nodo",), ("Otra",)], "hoja string")
    assert tuples(reshape.select_sheets(df)) == [("Nodo", "Nodo.csv")]


# --- history ---------------------------------------------------------------


def test_snapshot_checking_only_the_key_is_frozen(spark):
    first = history.scd2_first(local_rows(spark, [("P1", "1"), ("P2", "2")], "etiqueta string, column01 string"), ["etiqueta"], WEEK1)
    later = local_rows(spark, [("P1", "9", "5"), ("P3", "3", "6")], "etiqueta string, column01 string, column02 string")
    out = history.scd2_snapshot(first, later, ["etiqueta"], ["etiqueta"], WEEK2)
    assert tuples(history.scd2_current(out).select("etiqueta", "column01", "column02")) == [
        ("P1", "1", None), ("P2", "2", None), ("P3", "3", "6"),
    ]


def test_snapshot_checking_values_versions_changes(spark):
    schema = "etiqueta string, column01 string"
    first = history.scd2_first(local_rows(spark, [("P1", "1"), ("P2", None), ("P4", "4"), (None, "n")], schema), ["etiqueta"], WEEK1)
    later = local_rows(spark, [("P1", "9"), ("P2", None), ("P3", "3"), (None, "m")], schema)
    out = history.scd2_snapshot(first, later, ["etiqueta"], ["column01"], WEEK2)
    got = tuples(out.select("etiqueta", "column01", "dbt_valid_from", "dbt_valid_to"))
    assert got == sorted([
        ("P1", "1", WEEK1, WEEK2), ("P1", "9", WEEK2, None), ("P2", None, WEEK1, None), ("P3", "3", WEEK2, None),
        ("P4", "4", WEEK1, None), (None, "n", WEEK1, WEEK2), (None, "m", WEEK2, None),
    ], key=repr)
    again = history.scd2_snapshot(out, later, ["etiqueta"], ["column01"], datetime(2026, 1, 19))
    assert tuples(again.select(*out.columns)) == tuples(out)


def test_snapshot_with_repeated_keys_does_not_multiply(spark):
    schema = "etiqueta string, column01 string"
    first = history.scd2_first(local_rows(spark, [("P", "1"), ("P", "2")], schema), ["etiqueta"], WEEK1)
    out = history.scd2_snapshot(first, local_rows(spark, [("P", "2"), ("P", "3")], schema), ["etiqueta"], ["column01"], WEEK2)
    assert tuples(out.select("column01", "dbt_valid_to")) == [("1", WEEK2), ("2", None), ("3", None)]


def test_insert_only_is_idempotent(spark):
    target = local_rows(spark, [("a", 1)], "huella_registro string, v int")
    batch = local_rows(spark, [("a", 2), ("b", 3)], "huella_registro string, v int")
    new = history.insert_only(batch, target)
    assert tuples(new) == [("b", 3)]
    assert history.insert_only(batch, target.unionByName(new.select(*target.columns))).isEmpty()
    assert history.insert_only(batch, None) is batch


def test_detail_append_is_uncorrelated_by_default(spark):
    schema = "huella_registro string, _huella_contenido string"
    target = local_rows(spark, [("k1", "c1"), ("k9", "c9")], schema)
    batch = local_rows(spark, [("k1", "c1"), ("k2", "c1"), ("k1", "c2"), ("k3", "c9")], schema)
    # k2 is lost to the content of k1; c9 belongs to a key outside the batch and does not count
    assert tuples(history.append_versions(batch, target).select("huella_registro", "_huella_contenido")) == [("k1", "c2"), ("k3", "c9")]
    assert tuples(history.append_versions(batch, target, correlated=True).select("huella_registro", "_huella_contenido")) == [
        ("k1", "c2"), ("k2", "c1"), ("k3", "c9"),
    ]


# --- people and marts ------------------------------------------------------


@pytest.fixture(scope="module")
def aliases(spark):
    rows = [
        ("Ana", "1", "RUN", "CL", "Ana Uno", "operador"), ("Ana", "1", "RUN", "CL", "Ana Uno", "operador"),
        ("Anita", "1", "RUN", "CL", "Ana Uno", "operador"),
        ("Luz", "2", "RUN", "CL", "Luz Dos", "tecnico"),
        ("Sin", None, None, None, "Sin Clave", "operador"),
    ]
    return local_rows(spark, rows, ALIASES)


@pytest.fixture(scope="module")
def facts(spark):
    rows = [
        ("A", "P1", 2025, 52, 9.0, None, "08", "09", " Ana", "Luz"),
        ("A", "P1", 2026, 1, 2.5, None, "08", "09", "Ana", "Luz"),
        ("A", "P2", 2026, 1, 2.6, None, "08", "09", "Anita ", "Ana"),
        ("A", "P2", 2026, 1, 2.6, None, "08", "09", "Ana", None),
        ("B", "P1", 2025, 50, 5.0, None, "08", "09", "nadie", "luz"),
        ("B", "P2", 2025, 50, 5.0, None, "08", "09", None, "Luz"),
    ]
    return local_rows(spark, rows, BRONZE)


def test_alias_names(spark, aliases):
    persons = silver.entity_person(aliases)
    got = tuples(alias_names(aliases, persons).select("alias_fuente", "operador", "tecnico", "operador_dni"))
    assert got == [
        ("Ana", "Ana Uno", None, "1"), ("Anita", "Ana Uno", None, "1"), ("Luz", None, "Luz Dos", None), ("Sin", "Sin Clave", None, None),
    ]


def test_with_people_collapses_equal_measurements(spark, facts, aliases):
    got = tuples(with_people(facts, aliases, silver.entity_person(aliases)).select("planta", "punto_evaluacion", "semana", "operador", "tecnico"))
    assert got == sorted([
        ("A", "P1", 52, "Ana Uno", "Luz Dos"), ("A", "P1", 1, "Ana Uno", "Luz Dos"), ("A", "P2", 1, "Ana Uno", None),
        ("B", "P1", 50, None, None), ("B", "P2", 50, None, "Luz Dos"),
    ], key=repr)


def test_person_roles(facts, aliases):
    got = tuples(person_roles(facts, aliases).select("planta", "punto_evaluacion", "semana", "rol", "dni"))
    assert got == sorted([
        ("A", "P1", 52, "operador", "1"), ("A", "P1", 52, "tecnico", "2"), ("A", "P1", 1, "operador", "1"),
        ("A", "P1", 1, "tecnico", "2"), ("A", "P2", 1, "operador", "1"), ("A", "P2", 1, "tecnico", "1"), ("B", "P2", 50, "tecnico", "2"),
    ], key=repr)


def test_marts_at_the_limit_and_latest_sessions(spark, facts, aliases, bands):
    persons, sessions = silver.entity_person(aliases), silver.entity_session(facts)
    m1 = marts.over_limit_latest(facts, sessions, aliases, persons, bands)
    # 2.5 is band 4 and yet not over the limit; B is judged by its own latest session
    assert [tuple(r) for r in m1.select("planta", "punto_evaluacion", "concentracion_mg_m3", "veces_sobre_limite", "nivel_semaforo").collect()][-1] == ("A", "P2", 2.6, 1.04, 4)
    assert m1.count() == 3
    m4 = marts.latest_session_all(facts, sessions, aliases, persons, bands)
    assert tuples(m4.select("planta", "punto_evaluacion", "estado_limite", "nivel_semaforo")) == [
        ("A", "P1", "bajo_limite", 4), ("A", "P2", "sobre_limite", 4),
    ]
    m3 = marts.historic_peak(facts, aliases, persons, bands)
    assert tuples(m3.select("planta", "punto_evaluacion", "concentracion_mg_m3", "operador_dni", "tecnico_dni")) == [
        ("A", "P1", 9.0, "1", "2"), ("B", "P2", 5.0, None, "2"),
    ]
    m2 = {(r["planta"], r["anio"]): r for r in marts.annual_summary(facts, bands).collect()}
    row = m2["A", 2026]
    assert (row["semanas_medidas"], row["semanas_label"], row["puntos_medidos"], row["puntos_label"]) == (1, "semana medida", 2, "puntos")
    assert (row["concentracion_promedio_mg_m3"], row["registros_sobre_limite"], row["total_registros"], row["pct_sobre_limite"]) == (2.567, 2, 3, 66.7)


def test_plant_whose_latest_session_left_bronze_is_empty(facts, aliases, bands):
    sessions = silver.entity_session(facts)
    old = facts.filter("anio = 2025")
    m1 = marts.over_limit_latest(old, sessions, aliases, silver.entity_person(aliases), bands)
    assert {r["planta"] for r in m1.collect()} == {"B"}


def test_peak_breaks_ties_by_later_session_then_point(spark):
    rows = [("A", "P1", 2025, 1), ("A", "P2", 2025, 2), ("A", "P3", 2025, 2), ("A", "P9", 2024, 9)]
    df = local_rows(spark, [(*r, 5.0, None, None, None, None, None) for r in rows], BRONZE)
    assert tuples(ranking.peak_per_group(df).select("planta", "punto_evaluacion")) == [("A", "P3")]


def test_last_n(spark):
    df = local_rows(spark, [(c, t) for c in (1, 2) for t in range(3 * c)], "conv_id int, turn int")
    assert tuples(ranking.last_n(df, ["conv_id"], "turn", 2)) == [(1, 1), (1, 2), (2, 4), (2, 5)]


# --- indicators ------------------------------------------------------------


@pytest.mark.parametrize(
    "indicator, value, level",
    [
        ("concentracion-maxima-ultima-jornada", 1.99, "ok"), ("concentracion-maxima-ultima-jornada", 1.995, None),
        ("concentracion-maxima-ultima-jornada", 2.0, "warning"), ("concentracion-maxima-ultima-jornada", 3.0, "critico"),
        ("pct-sobre-limite-anual", 4.9, "ok"), ("pct-sobre-limite-anual", 4.95, None), ("pct-sobre-limite-anual", 15.0, "critico"),
        ("puntos-criticos-ultima-jornada", 0, "ok"), ("puntos-criticos-ultima-jornada", 2, "warning"),
        ("puntos-criticos-ultima-jornada", 3, "critico"), ("puntos-criticos-ultima-jornada", None, None),
    ],
)
def test_severity(spark, indicator, value, level):
    df = local_rows(spark, [(value if value is None else float(value),)], "valor_actual double")
    assert indicators.with_severity(df, INDICATORS[indicator]).first()["nivel"] == level


def test_display_columns_keep_their_order(spark):
    shown = indicators.display_columns(spark, "puntos-criticos-ultima-jornada").orderBy("orden").collect()
    assert [r["campo"] for r in shown] == ["planta", "valor_actual", "puntos_totales"]


# --- chunks ----------------------------------------------------------------


def chunk_frame(spark):
    rows = [
        ("c1", {"operador": "Ana", "tecnico": "Luz"}, "etiquetas"),
        ("c2", {"operador": "Ana", "tecnico": "Leo"}, "borrar_chunk"),
        ("c3", {"operador": "Eva", "tecnico": ""}, "borrar_chunk"),
        ("c4", {}, "borrar_chunk"),
    ]
    return spark.createDataFrame(rows, "chunk_id string, pii_tokens map<string,string>, estrategia_olvido string")


def test_forget(spark):
    got = {r["chunk_id"]: r["pii_tokens"] for r in ch.forget(chunk_frame(spark), local_rows(spark, [("Ana",)], "valor string")).collect()}
    assert got == {"c1": {"tecnico": "Luz"}, "c3": {"operador": "Eva", "tecnico": ""}, "c4": {}}


def test_render_shows_tokens_and_blanks(spark):
    df = local_rows(spark, [("X", 2.5, None)], "planta string, c double, operador string")
    text = ch.render(df, "{{ planta }}: {{ c }} ({{operador}})", ["operador"])
    assert df.select(text.alias("t")).first()["t"] == "X: 2.5 ([OPERADOR])"
    assert df.select(ch.render(df, "{{ planta }}: {{ c }} ({{operador}})").alias("t")).first()["t"] == "X: 2.5 ()"
    with pytest.raises(ValueError):
        ch.render(df, "{{ otra }}")


def test_annual_chunks_have_an_empty_pii_map_and_all_fields(spark, facts, bands):
    rule = RULES["P00002_M00002"]
    built = ch.build_chunks(marts.annual_summary(facts, bands), rule, "r", "t", "m", b"k")
    assert {tuple(r["pii_tokens"].items()) for r in built.collect()} == {()}
    assert set(ch.development_view(built).columns) == {*ch.COMMON_FIELDS, *ch.DEVELOPMENT_FIELDS}
    stored = ch.production_view(built, b"0" * 32, b"1" * 32, "k1")
    assert set(stored.columns) == {*ch.COMMON_FIELDS, *ch.PRODUCTION_FIELDS}
    plain = {r["chunk_id"]: r["texto"] for r in built.collect()}
    opened = stored.select("chunk_id", ch.decrypt(F.col("texto"), b"0" * 32).alias("texto"))
    assert {r["chunk_id"]: r["texto"] for r in opened.collect()} == plain


def test_upsert_and_validity(spark):
    old = local_rows(spark, [("a", 1), ("b", 2)], "chunk_id string, valido_hasta long")
    new = local_rows(spark, [("b", 30), ("c", -1)], "chunk_id string, valido_hasta long")
    merged = ch.upsert_chunks(old, new)
    assert tuples(merged) == [("a", 1), ("b", 30), ("c", -1)]
    assert tuples(ch.valid_chunks(merged, 10)) == [("b", 30), ("c", -1)]


def test_one_chunk_per_id_is_the_latest(spark):
    rows = [("a", "2026-01", "h1"), ("a", "2026-02", "h3"), ("a", "2026-02", "h2"), ("b", "2026-01", "h9")]
    df = local_rows(spark, rows, "chunk_id string, fecha_creacion string, hash_contenido string")
    assert tuples(ch.one_per_id(df)) == [("a", "2026-02", "h2"), ("b", "2026-01", "h9")]


def test_the_same_chunk_is_kept_in_any_order(spark):
    rows = [("a", "2026", "h", {"p": x}) for x in "cab"] + [("b", "2026", "h", None)]
    schema = "chunk_id string, fecha_creacion string, hash_contenido string, pii_tokens map<string,string>"
    for order in (rows, rows[::-1]):
        kept = ch.one_per_id(spark.createDataFrame(order, schema))
        assert [r["pii_tokens"] for r in kept.orderBy("chunk_id").collect()] == [{"p": "a"}, None]
        merged = ch.upsert_chunks(spark.createDataFrame(rows[:1], schema), spark.createDataFrame(order, schema))
        assert merged.count() == 2


def test_inherited_chunks_and_rules_without_chunks(spark):
    first, second = RULES["P00001_M00001"], RULES["P00002_M00002"]
    df = local_rows(spark, [("old",), (first.id,)], "regla_id string")
    assert tuples(ch.inherit_chunks(df, {"old": second.id})) == sorted([(first.id,), (second.id,)])
    quality = {r["regla_id"]: (r["chunks"], r["cumple"]) for r in ch.rule_quality(df, [first, second]).collect()}
    assert quality == {first.id: (1, True), second.id: (0, False)}
    recall = local_rows(spark, [(first.id, first.recall_min - 0.01)], "regla_id string, recall double")
    assert not any(r["cumple"] for r in ch.rule_quality(df, [first, second], recall).collect())
    none = spark.createDataFrame([], "regla_id string, dimensiones map<string,string>, pii_tokens map<string,string>")
    checks = metrics.chunk_checks(none, metrics.expectations([first, second]), 55).collect()
    assert {(r["regla_id"], r["chunks"], r["cumple"]) for r in checks} == {(first.id, 0, False), (second.id, 0, False), ("TOTAL", 0, False)}


def test_checks_find_wrong_tags_and_keys(spark):
    rule = RULES["P00001_M00001"]
    good = ({"ambito": "Seguridad ocupacional", "clasificacion": "Restringido"}, {"operador": "a", "tecnico": "b"})
    rows = [(rule.id, *good), (rule.id, {"ambito": "otro"}, good[1]), (rule.id, good[0], {"operador": "a"})]
    df = spark.createDataFrame(rows, "regla_id string, dimensiones map<string,string>, pii_tokens map<string,string>")
    row = metrics.chunk_checks(df, metrics.expectations([rule], {rule.id: 3})).first()
    assert (row["chunks"], row["tags_erroneos"], row["pii_erronea"], row["cumple"]) == (3, 1, 1, False)


@pytest.mark.parametrize("final_empty", [False, True])
def test_new_plus_replaced_is_generated(spark, final_empty):
    ids = {k: ch.chunk_id(F.lit(k)) for k in "abc"}
    before = spark.range(1).select(F.explode(F.array(ids["a"], F.md5(F.lit("z")))).alias("chunk_id"))
    generated = local_rows(spark, [("a",), ("b",), ("b",), ("c",), (None,)], "chunk_clave string")
    after = before if not final_empty else before.limit(0)
    row = metrics.chunk_changes(before, generated, after).first().asDict()
    assert row == {
        "previos": 2, "generados": 5, "nuevos": 2, "reemplazos": 1,
        "descartados": 0 if final_empty else 4, "finales": 0 if final_empty else 2,
    }


def test_ingest_delta_leaves_lost_and_uncounted_tables_out(spark):
    schema = "tabla string, filas long"
    before = local_rows(spark, [("a", 5), ("gone", 7)], schema)
    now = local_rows(spark, [("a", 3), ("b", 4), ("broken", None)], schema)
    assert tuples(metrics.ingest_delta(before, now)) == [("TOTAL", 5, 7, 2, "+2"), ("a", 5, 3, -2, "-2"), ("b", 0, 4, 4, "+4")]


# --- vectors and context ---------------------------------------------------


def brute_top(vecs, queries, k, min_score=None):
    out = []
    for q, v in queries:
        scored = []
        for i, x in vecs:
            if x is None or len(x) != len(v) or not np.any(x):
                continue
            score = float(np.dot(np.array(x) / np.linalg.norm(x), np.array(v) / np.linalg.norm(v)))
            if min_score is None or score >= min_score:
                scored.append((-round(score, 12), i))  # equal vectors tie
        out += [(q, i, round(-s, 6), n) for n, (s, i) in enumerate(sorted(scored)[:k], start=1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [100, 2])
@pytest.mark.parametrize("min_score", [None, 0.2])
def test_top_k_equals_brute_force(spark, monkeypatch, block, min_score):
    monkeypatch.setattr(vectors, "QUERY_BLOCK", block)
    random = np.random.default_rng(1)
    vecs = [(f"v{i:03d}", [float(x) for x in random.integers(-3, 4, 5)]) for i in range(200)]
    vecs += [(f"w{i}", [1.0, 1.0, 1.0, 1.0, 1.0]) for i in range(30)]  # ties rank by id
    vecs += [("null", None), ("zero", [0.0] * 5), ("short", [1.0])]
    queries = [(i, [float(x) for x in random.integers(1, 4, 5)]) for i in range(7)] + [(7, [1.0, 1.0, 1.0, 1.0, 1.0])]
    table = spark.createDataFrame(vecs, "vec_id string, embedding array<float>").repartition(5)
    asked = spark.createDataFrame(queries, "query_id int, embedding array<double>")
    got = vectors.top_k(table, asked, k=4, min_score=min_score)
    assert tuples(got.select("query_id", "vec_id", "score", "rn")) == brute_top(vecs, queries, 4, min_score)


def test_top_k_ranks_full_scores(spark):
    near = [1.0, 0.0005]  # cosine 0.999999875, which six decimals show as 1.0
    table = spark.createDataFrame([("a", near), ("b", [1.0, 0.0]), ("c", [0.0, 1.0])], "vec_id string, embedding array<double>")
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, embedding array<double>")
    assert tuples(vectors.top_k(table, asked, k=2).select("vec_id", "score", "rn")) == [("a", 1.0, 2), ("b", 1.0, 1)]
    assert tuples(vectors.top_k(table, asked, k=2, min_score=1.0).select("vec_id")) == [("b",)]


def test_many_queries_take_one_scan(spark):
    random = np.random.default_rng(2)
    vecs, asked = random.standard_normal((50, 4)), random.standard_normal((5000, 4))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "vec_id int, embedding array<double>")
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "query_id int, embedding array<double>")
    got = vectors.top_k(table, queries, k=1)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    assert {r["query_id"]: r["vec_id"] for r in got.collect()} == dict(enumerate((unit(asked) @ unit(vecs).T).argmax(axis=1).tolist()))


def test_vectors_are_validated(spark):
    rows = [("a", [1.0, 0.0]), ("b", [0.0, 0.0]), ("c", [1.0]), ("d", None)]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<float>")
    assert tuples(vectors.validate_vectors(df, 2).select("vec_id", "valido")) == [("a", True), ("b", False), ("c", False), ("d", False)]


def test_prompt(spark):
    ranked = local_rows(spark, [(1, "c2", 1), (1, "c1", 2)], "query_id int, chunk_id string, rn int")
    texts = local_rows(spark, [("c1", "uno"), ("c2", "dos"), ("c3", "tres")], "chunk_id string, texto string")
    turns = local_rows(spark, [(10, t, "user", f"t{t}") for t in range(7)], "conv_id int, turn int, role string, text string")
    asked = local_rows(spark, [(10, 1), (11, 2)], "conv_id int, query_id int")
    got = dict(tuples(context.prompts(asked, context.context_text(ranked, texts), context.memory(turns))))
    assert got[10] == "[CONTEXTO]\ndos\nuno\n" + "\n".join(f"user: t{t}" for t in range(2, 7))
    assert got[11] == "[CONTEXTO]\n"
