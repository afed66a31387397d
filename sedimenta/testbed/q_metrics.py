"""Ingest metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.operators import metrics
from sedimenta.sources.landing import table_counts
from sedimenta.testbed import frames as fr
from sedimenta.testbed.registry import query

# table -> what it held before the load, as a condition
BEFORE = {
    "lineitem": "l_shipdate < TIMESTAMP '2000-01-01'",
    "orders": "o_orderdate < TIMESTAMP '2000-01-01'",
    "part": "p_size < 25",
    "supplier": "true",
}
NOW = ("lineitem", "orders", "part", "supplier", "customer")


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


_PRE = _union([f"SELECT '{t}' AS tabla, count(*) AS antes FROM {t} WHERE {c}" for t, c in BEFORE.items()])
_POST = _union([f"SELECT '{t}' AS tabla, count(*) AS ahora FROM {t}" for t in NOW])


@query(
    "ingest_delta",
    f"""WITH d AS (SELECT tabla, ahora, coalesce(antes, 0) AS antes FROM ({_POST}) LEFT JOIN ({_PRE}) USING (tabla)),
t AS (SELECT tabla, antes, ahora FROM d UNION ALL SELECT 'TOTAL', cast(sum(antes) AS BIGINT), cast(sum(ahora) AS BIGINT) FROM d)
SELECT tabla, antes, ahora, ahora - antes AS delta,
  CASE WHEN ahora > antes THEN '+' ELSE '' END || (ahora - antes) AS delta_texto FROM t""",
)
def _(spark, sf):
    """`customer` is new and `region` disappeared."""
    before = {t: fr.table(spark, sf, t).filter(c) for t, c in BEFORE.items()}
    before["region"] = fr.table(spark, sf, "region")
    return metrics.ingest_delta(table_counts(before), table_counts({t: fr.table(spark, sf, t) for t in NOW}))


_IDS = """old AS (SELECT DISTINCT md5(lang || '/' || (n_chars % 1000)) AS chunk_id FROM documents WHERE lang <> 'fr'),
gen AS (SELECT lang || '/' || (n_chars % 1000) AS clave FROM documents),
fin AS (SELECT chunk_id FROM old UNION SELECT md5(clave) FROM gen WHERE length(clave) < 6)"""


@query(
    "chunk_changes",
    f"""WITH {_IDS}, g AS (SELECT DISTINCT md5(clave) AS chunk_id FROM gen)
SELECT (SELECT count(*) FROM old) AS previos, (SELECT count(*) FROM gen) AS generados,
  (SELECT count(*) FROM g WHERE chunk_id NOT IN (FROM old)) AS nuevos, (SELECT count(*) FROM g WHERE chunk_id IN (FROM old)) AS reemplazos,
  (SELECT count(*) FROM gen) - (SELECT count(*) FROM g WHERE chunk_id IN (FROM fin)) AS descartados, (SELECT count(*) FROM fin) AS finales""",
)
def _(spark, sf):
    documents = fr.table(spark, sf, "documents")
    key = F.concat_ws("/", F.col("lang"), (F.col("n_chars") % 1000).cast("string"))
    generated = documents.select(key.alias("chunk_clave"))
    stored = documents.filter("lang <> 'fr'").select(F.md5(key).alias("chunk_id")).distinct()
    arrived = generated.filter(F.length("chunk_clave") < 6).select(F.md5("chunk_clave").alias("chunk_id"))
    return metrics.chunk_changes(stored, generated, stored.unionByName(arrived).distinct())
