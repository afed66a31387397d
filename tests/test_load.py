"""Files in, two weekly runs, a stream: whole loads on a synthetic workbook."""

from __future__ import annotations

import csv
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import chunks as ch
from sedimenta.operators import metrics
from sedimenta.operators.lookup import local_rows
from sedimenta.plans import medallion
from sedimenta.sources import fixed_values as fv
from sedimenta.sources import sinks
from sedimenta.sources.landing import catalog_counts, layer_diagnostics, load_landing, open_landing, table_counts
from sedimenta.sources.registry import LANDING_SOURCES
from sedimenta.sources.seeds import read_aliases, read_bands
from sedimenta.streaming.weekly import BRONZE_SCHEMA, load_arrivals


def write_sheet(path, weeks, points):
    """A wide sheet: `weeks` week numbers, `points` label -> values."""
    path.parent.mkdir(parents=True, exist_ok=True)
    rows = [
        ["Semanas", *[str(w) for w in weeks]],
        ["Fecha", *["2026-01-05"] * len(weeks)],
        ["Operador\nplanta", *[" Ana "] * len(weeks)],
        ["Tecnico", *["Luz"] * len(weeks)],
        ["Hora inicio", *["08:00"] * len(weeks)],
        ["Hora termino", *["09:00"] * len(weeks)],
        ["Tratamiento tph", *["1500"] * len(weeks)],
        *[[label, *values] for label, values in points.items()],
    ]
    with path.open("w", encoding="utf-8", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(["etiqueta", *[f"column{i:02d}" for i in range(1, len(weeks) + 1)]])
        writer.writerows(rows)


def write_workbook(root, extra_week=False):
    weeks = [*range(1, 53), 1, *([2] if extra_week else [])]
    for i, name in enumerate(fv.SOURCE_PLANT):
        values = [f"{(w + i) % 6 + 0.5}" for w in range(len(weeks))]
        points = {"Correa 1": values, "Correa 2": ["" if w % 2 else v for w, v in enumerate(values)]}
        if extra_week and name == "mediciones_nodo":
            points["Correa 3"] = ["1.5"] * len(weeks)
        write_sheet(root / "datos" / "csv" / fv.LANDING_FILES[name], weeks, points)


@pytest.fixture(scope="module")
def people(spark):
    rows = [("Ana", "1", "RUN", "CL", "Ana Uno", "operador"), ("Luz", "2", "RUN", "CL", "Luz Dos", "tecnico")]
    return local_rows(
        spark,
        rows,
        "alias_fuente string, dni string, tipo_dni string, dni_pais_emisor string, nombre_completo string, tipo_persona string",
    )


def test_landing_skips_missing_files_and_keeps_text(spark, tmp_path):
    write_workbook(tmp_path)
    found = open_landing(spark, str(tmp_path))
    assert set(found) == set(fv.SOURCE_PLANT)  # the two summaries are not there
    sheet = found["mediciones_cdm_1"]
    assert {t for _, t in sheet.dtypes} == {"string"}
    assert sheet.filter(F.col("etiqueta") == "Operador\nplanta").count() == 1
    target = str(tmp_path / "landing")
    first = load_landing(spark, str(tmp_path), target)
    again = load_landing(spark, str(tmp_path), target)
    counts = {r["tabla"]: r["filas"] for r in table_counts({**again, "perdida": None}).collect()}
    assert counts["perdida"] is None and counts["mediciones_nodo"] == 9 and len(first) == 9


def test_two_weekly_runs(spark, people, tmp_path):
    write_workbook(tmp_path)
    base, key = str(tmp_path / "base"), b"key"
    first = medallion.Run(base, "w1", datetime(2026, 1, 5))
    out = medallion.run_all(spark, first, str(tmp_path), people, key)
    bronze = out["bronce_mediciones"]
    assert bronze.count() == 9 * (53 + 27)
    assert dict(bronze.dtypes)["anio"] == "int"
    assert out["silver_entidad_planta"].count() == 8
    assert out["silver_relacion_medicion"].count() == 8 * (53 + 27)
    assert out["silver_relacion_medicion_persona"].count() == 2 * 8 * (53 + 27)
    assert out["M00002"].count() == 16 and out["M00003"].count() == 8
    chunks = out["chunks"]
    per_rule = {r["regla_id"]: r["chunks"] for r in metrics.chunks_per_rule(chunks).collect()}
    assert per_rule["P00002_M00002"] == 16 and per_rule["P00003_M00003"] == 8
    assert per_rule["P00004_M00004"] == 16 and chunks.select("chunk_id").distinct().count() == chunks.count()
    dump = str(tmp_path / "dump")
    sinks.write_chunk_dump(chunks, dump)
    read = sinks.read_chunk_dump(spark, dump)
    assert read.schema.simpleString() == ch.development_view(chunks).schema.simpleString()
    assert metrics.chunks_per_rule(read).collect() == metrics.chunks_per_rule(chunks).collect()
    pre = sinks.write_snapshot(table_counts({"bronce_mediciones": bronze}), chunks, str(tmp_path / "pre"))
    row = metrics.chunk_changes(pre[1], read, chunks).first()
    assert (row["previos"], row["nuevos"], row["reemplazos"], row["descartados"]) == (chunks.count(), 0, chunks.count(), 0)
    assert metrics.ingest_delta(pre[0], table_counts({"bronce_mediciones": bronze})).filter("delta <> 0").isEmpty()
    sizes = {name: df.count() for name, df in out.items() if name.startswith("silver")}

    # the same files again: nothing is added anywhere
    same = medallion.run_all(spark, medallion.Run(base, "w2", datetime(2026, 1, 12), "w1"), str(tmp_path), people, key)
    assert {name: df.count() for name, df in same.items() if name.startswith("silver")} == sizes
    assert same["chunks"].count() == chunks.count()

    # a new week: known labels are frozen by the snapshot, only the new label brings rows
    write_workbook(tmp_path, extra_week=True)
    third = medallion.run_all(spark, medallion.Run(base, "w3", datetime(2026, 1, 19), "w2"), str(tmp_path), people, key)
    assert third["bronce_mediciones"].filter("_bronce_fuente = 'snap_mediciones_nodo'").select("punto_evaluacion").distinct().count() == 3
    assert third["silver_entidad_punto_medicion"].count() == sizes["silver_entidad_punto_medicion"] + 1
    # yearly chunks carry their counts in the key: the old one stays beside the new one
    annual = third["chunks"].filter("regla_id = 'P00002_M00002'")
    assert annual.filter(F.col("dimensiones")["planta"] == "Nodo 3500").count() > 2


def test_year_filters_skip_partitions(spark, people, bands, tmp_path):
    write_workbook(tmp_path)
    run = medallion.Run(str(tmp_path / "base"), "w1", datetime(2026, 1, 5))
    out = medallion.run_all(spark, run, str(tmp_path), people, b"key", sources=LANDING_SOURCES[:2])
    for mart in ("M00001", "M00004"):
        plan = out[mart]._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\n]*isnotnull\(anio", plan), mart


def test_stream_takes_each_file_once(spark, people, tmp_path):
    write_workbook(tmp_path)
    run = medallion.Run(str(tmp_path / "base"), "w1", datetime(2026, 1, 5))
    landing = load_landing(spark, str(tmp_path), run.path("landing", ""), LANDING_SOURCES[:2])
    bronze = medallion.load_bronze(run, medallion.snapshot_sheets(spark, run, landing))
    arrivals, target, state = (str(tmp_path / n) for n in ("arrivals", "silver", "state"))
    rows = bronze.select([c.split(" ")[0] for c in BRONZE_SCHEMA.split(", ")])
    rows.filter("anio = 2025").write.parquet(arrivals)
    load_arrivals(spark, arrivals, target, state).awaitTermination()
    relation = f"{target}/silver_relacion_medicion"
    old = spark.read.parquet(relation).count()
    assert old == rows.filter("anio = 2025").select("planta", "punto_evaluacion", "anio", "semana").distinct().count()
    rows.write.mode("append").parquet(arrivals)
    load_arrivals(spark, arrivals, target, state).awaitTermination()
    assert spark.read.parquet(relation).count() == rows.select("planta", "punto_evaluacion", "anio", "semana").distinct().count()
    # a lost checkpoint replays everything and adds nothing
    load_arrivals(spark, arrivals, target, state + "2", people).awaitTermination()
    keys = spark.read.parquet(relation)
    assert keys.count() == keys.select("huella_registro").distinct().count()
    for name in ("entidad_planta", "entidad_punto_medicion", "entidad_persona", "relacion_medicion_persona"):
        assert spark.read.parquet(f"{target}/silver_{name}").count() > 0


def test_vector_table_is_created_once(spark, tmp_path):
    path = str(tmp_path / "vectors")
    created = sinks.ensure_vectors(spark, path, 3)
    assert created.schema["embedding"].metadata == {"size": 3, "distance": "cosine"}
    spark.createDataFrame([("a", [1.0, 0.0, 0.0])], created.schema).write.mode("append").parquet(path)
    assert sinks.ensure_vectors(spark, path).count() == 1
    assert sinks.ensure_vectors(spark, str(tmp_path / "other")).schema["embedding"].metadata["size"] == 1536


def test_seeds_and_catalog(spark, tmp_path):
    (tmp_path / "bands.csv").write_text("nivel,concentracion_min_mg_m3,concentracion_max_mg_m3,color,etiqueta,es_sobre_limite_interno\n1,0.0,,azul,bajo,false\n")
    row = read_bands(spark, str(tmp_path / "bands.csv")).first()
    assert row["concentracion_max_mg_m3"] is None and row["es_sobre_limite_interno"] is False
    (tmp_path / "aliases.csv").write_text("alias_fuente,dni,tipo_dni,dni_pais_emisor,nombre_completo,tipo_persona\nAna,007,RUN,CL,Ana Uno,operador\n")
    assert read_aliases(spark, str(tmp_path / "aliases.csv")).first()["dni"] == "007"


def test_catalog_counts_base_tables_of_every_schema(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS otra LOCATION '{tmp_path}/otra'")
    try:
        for name, n in (("default.uno", 3), ("otra.dos", 4), ("otra._oculta", 5), ("otra.rota", 6)):
            folder = tmp_path / name
            spark.range(n).write.parquet(str(folder))
            spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{folder}'")
        spark.range(9).createOrReplaceTempView("vista")
        spark.sql("CREATE VIEW otra.vista AS SELECT 1 AS x")
        (tmp_path / "otra.rota" / "part-9.parquet").write_text("no parquet")
        counts = {(r["esquema"], r["tabla"]): r["filas"] for r in catalog_counts(spark).collect()}
        assert counts == {("default", "uno"): 3, ("otra", "dos"): 4, ("otra", "rota"): None}
    finally:
        spark.sql("DROP DATABASE otra CASCADE")
        spark.sql("DROP TABLE IF EXISTS default.uno")
        spark.catalog.dropTempView("vista")


def test_layer_diagnostics(spark, bands):
    table = spark.range(9).select((9 - F.col("id")).alias("k"), F.lit("x").alias("v"))
    row = layer_diagnostics(table, ["k"], bands).first()
    assert (row["columnas"], row["filas"], row["limite_mg_m3"]) == (["k", "v"], 9, 2.5)
    assert row["muestra"] == [f'{{"k":{i},"v":"x"}}' for i in range(1, 6)]
    empty = layer_diagnostics(table.filter("false"), ["k"]).first()
    assert (empty["filas"], empty["limite_mg_m3"], empty["muestra"]) == (0, None, [])
