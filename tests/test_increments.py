"""What a run leaves alone: pages, replaced partitions, chunk buckets, the forget index, yearly states, changed sheets."""

from __future__ import annotations

import hmac
import random
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import chunks as ch
from sedimenta.operators import history, metrics
from sedimenta.operators.numbering import numbered, pages, read_page
from sedimenta.plans import annual, marts, medallion
from sedimenta.sources import fixed_values as fv
from sedimenta.sources.changes import Loads, sheet_digests
from sedimenta.sources.chunk_store import BUCKET, ChunkStore, KeyedStore
from sedimenta.sources.landing import open_landing
from sedimenta.sources.registry import RULES
from sedimenta.sources.snapshot_store import SnapshotStore
from sedimenta.sources.versioned import VersionedTable
from tests.test_load import people, write_workbook  # noqa: F401

CHUNK = "chunk_id string, texto string, fecha_creacion string, estrategia_olvido string, pii_tokens map<string,string>"


def files(folder) -> dict[str, int]:
    return {str(p): p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def rows_of(df) -> list[str]:
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("group", [None, ["g"]])
def test_numbers_follow_the_order_over_partitions(spark, group):
    rows = [(i * 7919 % 1009, "hot" if i % 3 else None, i % 5) for i in range(1000)]
    df = spark.createDataFrame(rows, "x long, g string, at long").repartition(7)
    got = numbered(df, [F.col("x").desc()], group).collect()
    for g in {r["g"] for r in got} if group else [None]:
        mine = sorted((r["number"], -r["x"]) for r in got if not group or r["g"] == g)
        assert [n for n, _ in mine] == [*range(len(mine))] and [x for _, x in mine] == sorted(x for _, x in mine)
    assert "at" in got[0].asDict()


def test_pages_cover_all_ids_once(spark):
    ids = [f"{i * 7919 % 10007:05d}" for i in range(2000)]
    df = spark.createDataFrame([(i, "t") for i in ids] + [(None, "t")], "chunk_id string, texto string").repartition(6)
    got = sorted(map(tuple, pages(df, "chunk_id", 512).collect()))
    want = sorted(ids)
    assert got == [(p, want[512 * p], want[512 * p : 512 * p + 512][-1], len(want[512 * p : 512 * p + 512])) for p in range(4)]
    page = pages(df, "chunk_id", 512).filter("pagina = 2").first()
    assert [r["chunk_id"] for r in read_page(df, "chunk_id", page).collect()] == want[1024:1536]
    assert "Window" not in pages(df, "chunk_id")._jdf.queryExecution().executedPlan().toString()


def test_replaced_partitions_leave_other_files_alone(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "k", ("anio",))
    schema = "v long, k string, anio int"
    first = table.replace(spark.createDataFrame([(1, "01", 2025), (2, "02", 2025), (3, "1e", 2026)], schema), "r1", None)
    assert rows_of(first) == rows_of(spark.createDataFrame([(1, "01", 2025), (2, "02", 2025), (3, "1e", 2026)], schema))
    before = files(tmp_path / "t")
    for _ in range(2):  # a run that is repeated gives the same table
        second = table.replace(spark.createDataFrame([(9, "02", 2027)], schema), "r2", "r1", ["02", "1e"])
        assert sorted(map(tuple, second.collect())) == [(1, "01", 2025), (9, "02", 2027)]  # 1e got no rows, 02 lost a year
    after = files(tmp_path / "t")
    assert {p: t for p, t in after.items() if p in before} == before
    assert all("_corrida=r2" in p for p in after.keys() - before.keys())
    assert "PartitionFilters: [" in (plan := second._jdf.queryExecution().executedPlan().toString()) and "k#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert table.read("r1").count() == 3 and table.read("r2", ["01"]).count() == 1 and table.read("r2", ["1e"]).count() == 0
    assert table.read("unknown") is None
    assert rows_of(table.keep("r3", "r2", ["02"])) == rows_of(spark.createDataFrame([(1, "01", 2025)], schema))
    with pytest.raises(ValueError, match="other values"):
        table.replace(spark.createDataFrame([(9, "05", 2027)], schema), "r4", "r2", ["01"])


def some_chunks(spark, ids, text="a", names=("Ana", "Luz", "Eva", "Sol")):
    rnd = random.Random(3)
    rows = [(f"{i * 2654435761 % 2**32:08x}", f"{text} {i}", "2026-01-05", rnd.choice(["borrar_chunk", "etiquetas"]), {"operador": rnd.choice(names), "tecnico": f"t{i}"}) for i in ids]
    return spark.createDataFrame(rows, CHUNK)


def test_upsert_rewrites_the_buckets_of_its_ids_only(spark, tmp_path):
    old, new = some_chunks(spark, range(300)), some_chunks(spark, [5, 6, 900], "b")
    store = ChunkStore(spark, str(tmp_path / "store"), b"key", digits=1)
    store.upsert(old, "r1", None)
    before = files(tmp_path / "store")
    for _ in range(2):
        got = store.upsert(new, "r2", "r1")
        assert rows_of(got) == rows_of(ch.upsert_chunks(old, new).select(*got.columns))
    touched = {r["chunk_id"][:1] for r in new.collect()}
    added = files(tmp_path / "store").keys() - before.keys()
    assert {p.split("cubo=")[1][:1] for p in added} == touched
    assert {p: t for p, t in files(tmp_path / "store").items() if p in before} == before
    assert rows_of(store.read("r1")) == rows_of(old.select(*got.columns))


def test_forgetting_reads_the_index_and_the_touched_buckets(spark, tmp_path):
    chunks = some_chunks(spark, range(200))
    store = ChunkStore(spark, str(tmp_path / "store"), b"key", digits=2)
    store.load(chunks, "r1")
    gone = spark.createDataFrame([("t7",), ("t8",), ("t8",), ("nobody",), (None,)], "valor string")
    touched = store.touched_by(gone, "r1")
    assert sorted(touched) == sorted({r["chunk_id"][:2] for r in chunks.collect() if r["pii_tokens"]["tecnico"] in ("t7", "t8")})
    got = store.forget(gone, "r2", "r1")
    assert rows_of(got) == rows_of(ch.forget(chunks, gone).select(*got.columns))
    assert all(p.split("cubo=")[1][:2] in touched for p in files(tmp_path / "store") if "_corrida=r2" in p)
    # values forgotten once are in no bucket of the new run, and a frequent one is found in every bucket that holds it
    assert store.touched_by(gone, "r2") == []
    often = spark.createDataFrame([("Ana",)], "valor string")
    after = store.forget(often, "r3", "r2")
    assert rows_of(after) == rows_of(ch.forget(ch.forget(chunks, gone), often).select(*after.columns))
    index = spark.read.parquet(str(tmp_path / "store.indice"))
    assert set(index.columns) == {"huella", "cubo", "marca", "_corrida"} and index.filter(~F.col("huella").rlike("^[0-9a-f]{32}$")).isEmpty()


def test_forgetting_nobody_changes_nothing(spark, tmp_path):
    chunks = some_chunks(spark, range(20))
    store = ChunkStore(spark, str(tmp_path / "store"), b"key", digits=1)
    store.load(chunks, "r1")
    before = files(tmp_path / "store")
    got = store.forget(spark.createDataFrame([("nobody",)], "valor string"), "r2", "r1")
    assert rows_of(got) == rows_of(chunks.select(*got.columns)) and files(tmp_path / "store") == before


def measured(spark, weeks, points):
    rows = [(p, f"P{q}", 2025 + w // 52, w % 52 + 1, (w * 7 + q) % 40 / 10) for p in ("A", "B") for w in weeks for q in points]
    rows += [("A", None, 2025, 1, 1.5), ("B", "P1", 2025, 2, None)]
    return spark.createDataFrame(rows, "planta string, punto_evaluacion string, anio int, semana int, concentracion_mg_m3 double")


def test_states_of_loads_give_the_summary_of_all(spark, bands, tmp_path):
    parts = [measured(spark, range(60), range(5)), measured(spark, range(60, 70), range(3, 9)), measured(spark, [70], [0, 11])]
    limit = F.lit(2.5)
    states = annual.AnnualStates(spark, str(tmp_path / "annual"))
    for i, part in enumerate(parts):
        states.load(part, f"r{i}", limit)
    states.load(parts[1], "r1", limit)  # repeated
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert rows_of(states.summary(limit)) == rows_of(marts.annual_summary(every, bands, ordered=False).withColumn("limite_interno_mg_m3", limit))
    numbers = states.points().groupBy("planta").agg(F.count("*").alias("n"), F.count_distinct("numero").alias("d"), F.max("numero").alias("m")).collect()
    assert all(r["n"] == r["d"] for r in numbers)
    assert {p.split("/")[-3] for p in states.summary(limit).inputFiles()} == {"estados"}


def test_bit_maps_of_many_points(spark, bands, tmp_path):
    rows = spark.range(70_000).selectExpr("'A' AS planta", "concat('P', id) AS punto_evaluacion", "2025 AS anio", "cast(id % 3 + 1 AS int) AS semana", "1.0D AS concentracion_mg_m3")
    states = annual.AnnualStates(spark, str(tmp_path / "annual"))
    states.load(rows.filter("punto_evaluacion < 'P5'"), "r0", F.lit(2.5))
    states.load(rows.filter("punto_evaluacion >= 'P5'"), "r1", F.lit(2.5))
    row = states.summary(F.lit(2.5)).first()
    assert (row["puntos_medidos"], row["semanas_medidas"], row["total_registros"]) == (70_000, 3, 70_000)


def test_digests_see_content_not_order(spark):
    def digest(rows, columns="a string, b string"):
        return sheet_digests({"x": spark.createDataFrame(rows, columns)}).first()["huella"]

    rows = [("1", "2"), ("3", None), ("3", None), (None, "")]
    assert digest(rows) == digest(rows[::-1])
    others = [rows[:-1], rows + [rows[0]], [("1", "2"), ("3", ""), ("3", None), (None, "")], [("1", "2"), (None, "3"), ("3", None), (None, "")], []]
    assert len({digest(rows), *map(digest, others), digest(rows, "a string, c string")}) == 2 + len(others)


def test_only_changed_sheets_are_loaded_again(spark, people, tmp_path):  # noqa: F811
    write_workbook(tmp_path)
    base = str(tmp_path / "base")
    first = medallion.run_all(spark, medallion.Run(base, "w1", datetime(2026, 1, 5)), str(tmp_path), people, b"key")
    assert first["bronce_mediciones"].count() == 9 * 80
    before = files(f"{base}/bronze")
    sheet = tmp_path / "datos" / "csv" / fv.LANDING_FILES["mediciones_nodo"]
    sheet.write_text(sheet.read_text(encoding="utf-8") + "Correa 9," + ",".join(["1.5"] * 53) + "\n", encoding="utf-8")
    second = medallion.run_all(spark, medallion.Run(base, "w2", datetime(2026, 1, 12), "w1"), str(tmp_path), people, b"key")
    after = files(f"{base}/bronze")
    assert {p: t for p, t in after.items() if p in before} == before
    assert {p.split("_bronce_fuente=")[1].split("/")[0] for p in after.keys() - before.keys() if "manifiestos" not in p} == {"snap_mediciones_nodo"}
    assert sorted(p.name for p in Path(f"{base}/landing/w2").iterdir()) == ["_cargas", "mediciones_nodo"]
    # the same files loaded whole
    whole = medallion.run_all(spark, medallion.Run(f"{base}2", "w2", datetime(2026, 1, 12)), str(tmp_path), people, b"key")
    for name in ("bronce_mediciones", "silver_entidad_punto_medicion", "silver_relacion_medicion", "silver_relacion_medicion_persona", "M00002"):
        drop = [c for c in ("_bronce_loaded_at", "_silver_loaded_at", "valid_from", "_loaded_at") if c in second[name].columns]
        moments = [c for c, t in second[name].dtypes if t.startswith("timestamp")]
        left, right = (t[name].drop(*drop, *moments) for t in (second, whole))
        assert rows_of(left) == rows_of(right.select(*left.columns)), name
    # a third run without any change writes no bronze at all
    third = medallion.run_all(spark, medallion.Run(base, "w3", datetime(2026, 1, 19), "w2"), str(tmp_path), people, b"key")
    assert {p for p in files(f"{base}/bronze") if "manifiestos" not in p} == {p for p in after if "manifiestos" not in p}
    assert third["bronce_mediciones"].count() == 9 * 80 + 53
    assert Loads.read(spark, f"{base}/landing/w3/_cargas").runs["mediciones_nodo"] == "w2"
    assert len(open_landing(spark, str(tmp_path))) == 9


def test_keys_are_derived_per_chunk_and_rotate_without_touching_texts(spark, tmp_path):
    run_key, old, new = b"r" * 32, b"a" * 32, b"b" * 32
    rows = [(f"{i % 16:x}{i}", None if i == 3 else f"texto {i} ñ" if i else "") for i in range(60)]
    plain = spark.createDataFrame(rows, "chunk_id string, texto string")
    own = ch.chunk_data_key(F.col("chunk_id"), run_key)
    sealed = plain.select("chunk_id", ch.encrypt(F.col("texto"), own).alias("texto"), ch.wrap(own, old).alias("dek_cifrada"), F.lit("k1").alias("kek_version"))
    want = {i: hmac.new(run_key, f"chunk|{i}\x01".encode(), "sha256").digest() for i, _ in rows}
    assert {r[0]: bytes(r[1]) for r in sealed.select("chunk_id", ch.unwrapped({"k1": old})).collect()} == want

    store = KeyedStore(spark, str(tmp_path / "s"), digits=1)
    before = {r["chunk_id"]: r["texto"] for r in store.load(sealed, "r1").collect()}
    bodies = files(tmp_path / "s")
    keys = {"k1": old, "k2": new}
    assert len(store.rotate(keys, "k2", "r2", "r1")) == 16
    after = store.read("r1", "r2")
    assert files(tmp_path / "s") == bodies
    assert {r["chunk_id"]: r["texto"] for r in after.collect()} == before
    assert rows_of(ch.opened(after, {"k2": new}, ["texto"]).select("chunk_id", "texto")) == rows_of(plain)
    assert {r[0] for r in after.select("kek_version").distinct().collect()} == {"k2"}
    # a rotation that was done changes nothing, and the table of the run before is still there
    assert store.rotate(keys, "k2", "r3", "r2") == [] and rows_of(store.read("r1", "r3")) == rows_of(after)
    assert rows_of(ch.opened(store.read("r1", "r1"), {"k1": old}, ["texto"]).select("chunk_id", "texto")) == rows_of(plain)
    with pytest.raises(Exception, match="no wrapping key of version k2"):
        ch.opened(after, {"k1": old}, ["texto"]).collect()


def test_checks_taken_while_writing_equal_those_of_a_scan(spark, tmp_path):
    rules = [RULES["P00001_M00001"], RULES["P00002_M00002"]]
    expected = metrics.expectations(rules, {r.id: 3 for r in rules})
    rows = []
    for i in range(40):
        rule = rules[i % 2]
        tags = {k: v for k, v in rule.tags.items()} if i % 5 else None
        keys = {p: "x" for p in rule.pii} | ({"otra": "y"} if i % 7 == 0 else {})
        rows.append((f"{i % 16:x}{i}", rule.id if i % 9 else [None, "OTRA"][i % 2], tags, keys if i % 11 else None))
    schema = "chunk_id string, regla_id string, dimensiones map<string,string>, pii_tokens map<string,string>"
    chunks = spark.createDataFrame(rows, schema)
    store = ChunkStore(spark, str(tmp_path / "s"), b"k", digits=1)
    checks = metrics.WriteChecks(expected, 30)
    store.load(chunks, "r1", checks.watch)
    assert checks.written() == len(rows)
    assert rows_of(checks.result(spark)) == rows_of(metrics.chunk_checks(chunks, expected, 30))
    none = metrics.WriteChecks(expected, 30)
    store.load(chunks.filter("chunk_id = 'zz'"), "r2", none.watch)
    assert none.written() == 0 and rows_of(none.result(spark)) == rows_of(metrics.chunk_checks(chunks.limit(0), expected, 30))


def test_snapshots_read_and_write_the_buckets_that_changed(spark, tmp_path):
    schema = "k string, x double, y string, otra int"
    base = [(f"k{i}", float(i), "a", 1) for i in range(60)] + [(None, 1.0, "n", 1), ("dos", 1.0, "a", 1), ("dos", 2.0, "a", 1), ("cero", 0.0, "a", 1), ("nan", float("nan"), None, 1)]
    changed = {r[0]: r for r in base if r[0] not in ("dos", "k9")} | {"k3": ("k3", -3.0, "a", 1), "k4": ("k4", 4.0, None, 1), "cero": ("cero", -0.0, "a", 1), "k5": ("k5", 5.0, "a", 9), "nuevo": ("nuevo", 0.5, "a", 1)}
    loads = [base, [*changed.values(), ("dos", 2.0, "a", 1)], [*changed.values(), ("dos", 2.0, "a", 1)], base]
    store = SnapshotStore(spark, str(tmp_path / "s"), ["k"], ["x", "y"], buckets=16)
    want, before = None, {}
    for i, rows in enumerate(loads):
        now, source = datetime(2026, 1, 5 + 7 * i), spark.createDataFrame(rows, schema).repartition(3)
        want = history.scd2_first(source, ["k"], now) if want is None else history.scd2_snapshot(want, source, ["k"], ["x", "y"], now)
        for _ in range(2):  # a run may be repeated
            touched = store.load(source, f"w{i}", f"w{i - 1}" if i else None, now)
        got = store.versions(f"w{i}")
        assert rows_of(got.select(*want.columns)) == rows_of(want)
        assert rows_of(store.current(f"w{i}").select("k", "x", "y", "otra")) == rows_of(history.scd2_current(want).select("k", "x", "y", "otra"))
        after = files(tmp_path / "s")
        assert {p: t for p, t in after.items() if p in before} == before
        before = after
        assert len(touched) == (16 if i == 0 else 0 if i == 2 else len(touched)) and (i not in (1, 3) or 0 < len(touched) < 16)
        written = {p.split("parte=")[1].split("/")[0] for p in after if f"_corrida=w{i}" in p}
        assert written == {*touched} | ({f"cerradas-w{i}"} if i in (1, 3) else set())
    plan = store.current("w3")._jdf.queryExecution().executedPlan().toString()
    assert "cerradas" not in plan and "parte" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_new_check_column_touches_every_bucket_and_is_null_in_old_versions(spark, tmp_path):
    first = spark.createDataFrame([(f"k{i}", i) for i in range(20)], "k string, x int")
    second = first.withColumn("z", F.when(F.col("x") < 5, F.col("x")))
    store = SnapshotStore(spark, str(tmp_path / "s"), ["k"], ["x"], buckets=4)
    store.load(first, "w1", None, datetime(2026, 1, 5))
    grown = SnapshotStore(spark, str(tmp_path / "s"), ["k"], ["x", "z"], buckets=4)
    assert len(grown.load(second, "w2", "w1", datetime(2026, 1, 12))) == 4
    want = history.scd2_snapshot(history.scd2_first(first, ["k"], datetime(2026, 1, 5)), second, ["k"], ["x", "z"], datetime(2026, 1, 12))
    assert rows_of(grown.versions("w2").select(*want.columns)) == rows_of(want)
    wider = second.withColumn("libre", F.lit("a"))  # not compared: no bucket is touched, the column is there
    assert grown.load(wider, "w3", "w2", datetime(2026, 1, 19)) == []
    assert {r["libre"] for r in grown.versions("w3").collect()} == {None}


def test_chunks_are_built_behind_the_shuffle_that_places_them(spark, tmp_path):
    rules = [RULES["P00001_M00001"], RULES["P00004_M00004"]]
    run = {"run_id": "r", "created_at": "2026-01-05T00:00:00.000Z", "medallion_id": "m", "signing_key": b"key"}
    rows = [(f"Planta {i % 7}" if i % 6 else None, f"P{i}", 2025, i % 53, i / 10, "Ana" if i % 3 else None) for i in range(60)] * 2
    marts_ = []
    for rule in rules:
        facts = spark.createDataFrame(rows, "planta string, punto_evaluacion string, anio int, semana int, concentracion_mg_m3 double, operador string")
        marts_.append(facts.withColumns({c: F.lit("x") for c in rule.columns if c not in facts.columns}))
    whole = ch.build_chunks(marts_[0], rules[0], **run).unionByName(ch.build_chunks(marts_[1], rules[1], **run))
    parts = [(*ch.rule_rows(m, r), lambda rows, r=r: ch.build_chunks(rows, r, **run, keep=(BUCKET,))) for m, r in zip(marts_, rules)]
    plans = []

    def seen(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return checks.watch(df)

    store, checks = ChunkStore(spark, str(tmp_path / "s"), b"k", digits=1), metrics.WriteChecks(metrics.expectations(rules), 30)
    for _ in range(2):  # a run may be repeated
        checks = metrics.WriteChecks(metrics.expectations(rules), 30)
        got = store.load_built(parts, "r1", seen)
    assert rows_of(got) == rows_of(whole.select(*got.columns)) and checks.written() == 240
    assert rows_of(checks.result(spark)) == rows_of(metrics.chunk_checks(whole, metrics.expectations(rules), 30))
    # texts and digests are made above the exchange, rows are sorted below them
    for plan in plans:
        above, below = plan.split("RebalancePartitions")
        assert "firma_hmac" in above and "Sort [cubo" in above.split("\n")[-2]
        assert not {"firma_hmac", "datos_negocio", "sha2("} & set(below.replace("#", " ").split()) and "sha2(" not in below
    other = ChunkStore(spark, str(tmp_path / "t"), b"k", digits=1)
    assert rows_of(other.load(whole, "r1")) == rows_of(got)
    assert sorted(other.touched_by(spark.createDataFrame([("Ana",)], "valor string"), "r1")) == sorted(store.touched_by(spark.createDataFrame([("Ana",)], "valor string"), "r1"))
    with pytest.raises(ValueError, match="parts of different columns"):
        store.load_built([parts[0], (*parts[1][:2], lambda rows: rows.select("planta", BUCKET))], "r2")


def test_forgetting_shuffles_the_stored_chunks_once(spark, tmp_path):
    rows = [r.asDict() for r in some_chunks(spark, range(90)).collect()]
    rows += [r | {"texto": "otra vez", "pii_tokens": {"operador": f"x{i}"}} for i, r in enumerate(rows[:30])]  # ids twice
    rows += [{**r, "chunk_id": None} for r in rows[:20]] * 2
    rows += [{**rows[40], "pii_tokens": None}, {**rows[41], "estrategia_olvido": None}, {**rows[42], "pii_tokens": {"operador": None}}]
    chunks = spark.createDataFrame([tuple(r[c] for c in ("chunk_id", "texto", "fecha_creacion", "estrategia_olvido", "pii_tokens")) for r in rows], CHUNK)
    store = ChunkStore(spark, str(tmp_path / "store"), b"key", digits=1)
    store.load(chunks, "r1")
    gone = spark.createDataFrame([("Ana",), ("t3",), ("x5",), (None,)], "valor string")
    want, stored = rows_of(ch.forget(chunks, gone)), chunks.withColumn("cubo", F.coalesce(F.substring("chunk_id", 1, 1), F.lit("sin_id")))
    for _ in range(2):  # a run may be repeated
        assert rows_of(store.forget(gone, "r2", "r1").select(*chunks.columns)) == want
    left = ch.forget(stored, gone, ("cubo",))
    assert rows_of(left.drop("cubo")) == want
    # one exchange of whole chunks, in ranges by bucket, and none behind it
    plan = store.table.read("r1").transform(ch.forget, gone, ("cubo",))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "RebalancePartitions" not in plan
    buckets = {}
    for r in left.select("cubo", F.spark_partition_id().alias("p")).distinct().collect():
        buckets.setdefault(r["p"], set()).add(r["cubo"])
    assert sum(map(len, buckets.values())) <= len({b for s in buckets.values() for b in s}) + len(buckets)
