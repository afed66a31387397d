"""The weekly load: landing -> snapshots -> bronze -> silver -> marts -> chunks.

Layers meet in Parquet, so bronze is computed once for its ten consumers and a
lost executor or a failed stage never repeats more than one layer. Replaced
layers go to a folder of the run; silver only ever gets appended to, by anti
joins, so a repeated run adds nothing. Only sheets whose content changed are
loaded, versioned and reshaped again, and only the chunk buckets that got chunks
are rewritten; everything else stays in the files of the run that wrote it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators import chunks as ch
from sedimenta.operators import history, reshape
from sedimenta.operators.metrics import WriteChecks
from sedimenta.plans import marts, silver
from sedimenta.sources import fixed_values as fv
from sedimenta.sources import sinks
from sedimenta.sources.changes import Loads
from sedimenta.sources.chunk_store import ChunkStore
from sedimenta.sources.landing import open_landing, write_landing
from sedimenta.sources.registry import LANDING_SOURCES, RULES, LandingSource
from sedimenta.sources.seeds import band_seed
from sedimenta.sources.versioned import VersionedTable


@dataclass(frozen=True)
class Run:
    """One weekly run under `base`. `previous` is the id of the run before, None on the first."""

    base: str
    run_id: str
    now: datetime
    previous: str | None = None

    def path(self, layer: str, name: str, run_id: str | None = None) -> str:
        return f"{self.base.rstrip('/')}/{layer}/{run_id or self.run_id}/{name}"

    def shared(self, layer: str, name: str) -> str:
        return f"{self.base.rstrip('/')}/{layer}/{name}"


def snapshot_sheets(
    spark: SparkSession,
    run: Run,
    landing: dict[str, DataFrame],
    sources: Sequence[LandingSource] = LANDING_SOURCES,
    loaded_by: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Next versions of every measurement sheet with history; returns the open versions.

    `loaded_by` names the run that holds a sheet's versions so far, where that is not the previous one.
    """
    current: dict[str, DataFrame] = {}
    for source in sources:
        sheet = landing.get(source.name)
        if sheet is None or source.name not in fv.SOURCE_PLANT or not source.enable_snapshots:
            continue
        key = ["etiqueta"]
        before = (loaded_by or {}).get(source.name, run.previous)
        known = sinks.read_if_exists(spark, run.path("snapshots", source.name, before)) if before else None
        versions = (
            history.scd2_first(sheet, key, run.now)
            if known is None
            else history.scd2_snapshot(known, sheet, key, list(source.snapshot_check_cols), run.now)
        )
        stored = sinks.write_table(versions, run.path("snapshots", source.name))
        current[source.name] = history.scd2_current(stored)
    return current


def load_bronze(
    run: Run, sheets: dict[str, DataFrame], base_year: int = fv.BASE_YEAR, touched: Sequence[str] | None = None
) -> DataFrame:
    """All sheets in one pass, stored by source and year, so that later filters on `anio` skip whole folders.

    `touched` names the sources that the sheets replace, or that are gone; the files of the others stay as they are. Without it
    the table is replaced.
    """
    if not sheets and (touched is None or run.previous is None):
        raise ValueError("no sheet to load")
    spark = SparkSession.active()
    table = VersionedTable(spark, run.shared("bronze", "bronce_mediciones"), "_bronce_fuente", ("anio",))
    replaced = None if touched is None else [fv.SNAPSHOT_PREFIX + name for name in touched]
    if not sheets:
        return table.keep(run.run_id, run.previous, replaced)
    stacked = reshape.stack_sheets(sheets, fv.SOURCE_PLANT)
    bronze = reshape.wide_to_bronze(
        stacked, sheet=["_fuente"], source="_fuente", base_year=base_year, loaded_at=F.lit(run.now).cast("timestamp")
    )
    return table.replace(bronze, run.run_id, run.previous, replaced)


def load_silver(
    run: Run, bronze: DataFrame, aliases: DataFrame, changed: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """Appends what is new to every silver table and returns the tables.

    With `changed`, the keys of plants, points, sessions and measurements come from these sources only: the rows of the
    others were taken in earlier. People and details look at all of bronze, as aliases may have changed and equal
    contents of other keys count.
    """
    fresh = bronze if changed is None else bronze.filter(F.col("_bronce_fuente").isin([fv.SNAPSHOT_PREFIX + c for c in changed]))
    keyed = {
        "silver_entidad_planta": silver.entity_plant(fresh, run.now),
        "silver_entidad_punto_medicion": silver.entity_point(fresh, run.now),
        "silver_entidad_sesion_medicion": silver.entity_session(fresh, run.now),
        "silver_entidad_persona": silver.entity_person(aliases, run.now),
        "silver_relacion_medicion": silver.relation_measurement(fresh, run.now),
        "silver_relacion_medicion_persona": silver.relation_measurement_person(bronze, aliases, run.now),
    }
    out = {name: sinks.append_new(df, run.shared("silver", name)) for name, df in keyed.items()}
    name = "silver_detalle_medicion"
    out[name] = sinks.append_detail(silver.detail_measurement(bronze, run.now), run.shared("silver", name))
    return out


def load_marts(
    run: Run, bronze: DataFrame, tables: dict[str, DataFrame], aliases: DataFrame, bands: DataFrame
) -> dict[str, DataFrame]:
    """The four marts. The yearly summary is a table by year; the others are views over bronze."""
    sessions, persons = tables["silver_entidad_sesion_medicion"], tables["silver_entidad_persona"]
    summary = marts.annual_summary(bronze, bands, ordered=False)
    return {
        "M00001": marts.over_limit_latest(bronze, sessions, aliases, persons, bands, ordered=False),
        "M00002": sinks.write_table(summary, run.path("gold", "M00002"), ("anio",)),
        "M00003": marts.historic_peak(bronze, aliases, persons, bands, ordered=False),
        "M00004": marts.latest_session_all(bronze, sessions, aliases, persons, bands, ordered=False),
    }


def load_chunks(
    spark: SparkSession, run: Run, gold: dict[str, DataFrame], signing_key: bytes, checks: WriteChecks | None = None
) -> DataFrame:
    """Chunks of this run, upserted over the previous store; chunks not generated again are kept. `checks` counts them as they are written."""
    created = run.now.strftime("%Y-%m-%dT%H:%M:%S.000Z")
    made = [
        ch.build_chunks(gold[rule.mart], rule, run.run_id, created, run.run_id, signing_key) for rule in RULES.values()
    ]
    generated = reduce(DataFrame.unionByName, made)
    generated = sinks.write_table(checks.watch(generated) if checks else generated, run.path("chunks", "generados"))
    # repeated keys in one run (equal rows of two sheets) leave one chunk
    return ChunkStore(spark, run.shared("chunks", "almacen"), signing_key).upsert(generated, run.run_id, run.previous)


def run_all(
    spark: SparkSession,
    run: Run,
    root: str,
    aliases: DataFrame,
    signing_key: bytes,
    bands: DataFrame | None = None,
    base_year: int = fv.BASE_YEAR,
    sources: Sequence[LandingSource] = LANDING_SOURCES,
    checks: WriteChecks | None = None,
) -> dict[str, DataFrame]:
    """All layers in order; returns bronze, silver, marts and the chunk store by name. `checks` counts the run's chunks as they are written."""
    bands = band_seed(spark) if bands is None else bands
    sheets = open_landing(spark, root, sources)
    before = Loads.read(spark, run.path("landing", "_cargas", run.previous) if run.previous else None)
    loads = before.after(sheets, run.run_id)
    changed = [name for name, by in loads.runs.items() if by == run.run_id]
    gone = [name for name in before.runs if name not in loads.runs]
    landing = write_landing({name: sheets[name] for name in changed}, run.path("landing", "").rstrip("/"))
    current = snapshot_sheets(spark, run, landing, sources, before.runs)
    known = bool(before.runs)
    bronze = load_bronze(run, current, base_year, [*changed, *gone] if known else None)
    tables = load_silver(run, bronze, aliases, changed if known else None)
    gold = load_marts(run, bronze, tables, aliases, bands)
    chunks = load_chunks(spark, run, gold, signing_key, checks)
    # last, so a run that failed is no run to compare with
    loads.write(spark, run.path("landing", "_cargas"))
    return {"bronce_mediciones": bronze, **tables, **gold, "chunks": chunks}
