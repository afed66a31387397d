"""Chunks: keys, texts, tags, integrity, encryption, upsert, validity, forgetting, quality."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from sedimenta.functions import fingerprint
from sedimenta.operators import chunks as ch
from sedimenta.operators import metrics
from sedimenta.operators.people import MEASUREMENT, with_people
from sedimenta.operators.numbering import pages
from sedimenta.plans.marts import with_limit_and_band
from sedimenta.session import scratch_path
from sedimenta.sources.chunk_store import BUCKET, ChunkStore, KeyedStore
from sedimenta.sources.registry import RULES
from sedimenta.sources.seeds import band_seed
from sedimenta.testbed import frames as fr
from sedimenta.testbed import sql as s
from sedimenta.testbed.registry import ORACLE, query

# Keys of the trial run only; a deployment passes its own.
SIGNING_KEY = b"trial signing key"
DATA_KEY = b"0123456789abcdef0123456789abcdef"
WRAPPING_KEY = b"fedcba9876543210fedcba9876543210"
NEXT_WRAPPING_KEY = b"0f1e2d3c4b5a69780f1e2d3c4b5a6978"
RUN = {"run_id": "c1", "created_at": "2026-01-05T00:00:00.000Z", "medallion_id": "m1", "signing_key": SIGNING_KEY}

P1, P2, P3, P4 = (RULES[f"P0000{i}_M0000{i}"] for i in (1, 2, 3, 4))
_PLACEHOLDER = re.compile(r"{{\s*(\w+)\s*}}")


def shown(column: str) -> str:
    return f"coalesce(cast({column} AS VARCHAR), '')"


def key_sql(rule) -> str:
    return f"concat_ws(' ', '{rule.id}', {', '.join(shown(c) for c in rule.key_columns)})"


def text_sql(rule) -> str:
    """The template as SQL, personal columns as tokens, tags in front."""
    parts, position = [], 0
    head = "\n".join(f"{t}: {rule.tags[t]}" for t in rule.tags_in_text) + "\n"
    for match in _PLACEHOLDER.finditer(rule.template):
        name = match.group(1)
        parts.append("'" + rule.template[position : match.start()] + "'")
        parts.append(f"'[{name.upper()}]'" if name in rule.pii else shown(name))
        position = match.end()
    parts.append("'" + rule.template[position:] + "'")
    return "'" + head + "' || " + " || ".join(parts)


def _built(spark, sf, rule):
    return ch.build_chunks(fr.mart(spark, sf, rule.mart), rule, **RUN)


# every measurement as a row of rule P4, so that the text operators run on whole tables
_ALL_CTES = (
    s.MED,
    s.ALIASES,
    s.PERSONS,
    s.BANDS,
    s.LIMIT,
    s.people("med"),
    f"m4 AS (SELECT {s.POINT}, n.fecha, n.hora_inicio, n.hora_termino, n.operador, n.tecnico, {s.BAND_COLUMNS} FROM named n CROSS JOIN lim {s.BANDED})",
)


def _all_rows(spark, sf):
    named = with_people(fr.bronze(spark, sf), fr.aliases(spark, sf), fr.persons(spark, sf))
    return with_limit_and_band(named, band_seed(spark))


@query(
    "chunk_key",
    s.with_(*s.M1_CTES) + f"SELECT {key_sql(P1)} AS chunk_clave, md5({key_sql(P1)}) AS chunk_id FROM m1",
)
def _(spark, sf):
    return _built(spark, sf, P1).select("chunk_clave", "chunk_id")


@query(
    "chunk_text",
    s.with_(*_ALL_CTES)
    + f"SELECT planta, punto_evaluacion, anio, semana, concentracion_mg_m3, fecha, hora_inicio, {text_sql(P4)} AS texto FROM m4",
)
def _(spark, sf):
    """Text of every measurement of the whole history; people are tokens in it, so none is looked up."""
    facts = fr.bronze(spark, sf).select(*MEASUREMENT).distinct()
    rows = with_limit_and_band(facts.withColumns({c: F.lit(None).cast("string") for c in P4.pii}), band_seed(spark))
    text = ch.tagged_text(ch.render(rows, P4.template, P4.pii), P4.tags, P4.tags_in_text)
    return rows.select(
        "planta", "punto_evaluacion", "anio", "semana", "concentracion_mg_m3", "fecha", "hora_inicio", text.alias("texto")
    )


@query("chunk_text_annual", s.with_(*s.M2_CTES) + f"SELECT {key_sql(P2)} AS chunk_clave, {text_sql(P2)} AS texto FROM m2")
def _(spark, sf):
    return _built(spark, sf, P2).select("chunk_clave", "texto")


@query(
    "chunk_pii_tokens",
    s.with_(*s.M3_CTES)
    + f"""SELECT md5({key_sql(P3)}) AS chunk_id, {text_sql(P3)} AS texto, {shown('operador')} AS operador, {shown('operador_dni')} AS operador_dni,
{shown('tecnico')} AS tecnico, {shown('tecnico_dni')} AS tecnico_dni FROM m3""",
)
def _(spark, sf):
    return _built(spark, sf, P3).select("chunk_id", "texto", *[F.col("pii_tokens")[c].alias(c) for c in P3.pii])


@query(
    "chunk_tags",
    s.with_(*s.M4_CTES)
    + f"""SELECT md5({key_sql(P4)}) AS chunk_id, planta, '{P4.tags["ambito"]}' AS ambito, '{P4.tags["clasificacion"]}' AS clasificacion FROM m4""",
)
def _(spark, sf):
    return _built(spark, sf, P4).select("chunk_id", *[F.col("dimensiones")[d].alias(d) for d in P4.tags])


@query(
    "chunk_contract",
    s.with_(*s.M2_CTES)
    + f"""SELECT '{P2.id}' AS regla_id, '{RUN["created_at"]}' AS fecha_creacion, 'c1' AS corrida_id, 'm1' AS medallon_id,
cast(-1 AS BIGINT) AS valido_hasta, 'preservar' AS politica_vigencia, ['ambito', 'clasificacion'] AS dimensiones_en_texto,
'tokens' AS pii_estrategia, 'borrar_chunk' AS estrategia_olvido, sha256({text_sql(P2)}) AS hash_contenido, {text_sql(P2)} AS texto,
{key_sql(P2)} AS chunk_clave, planta, {shown('total_registros')} AS total FROM m2""",
)
def _(spark, sf):
    """Development fields; maps are opened, signatures are tested apart."""
    view = ch.development_view(_built(spark, sf, P2))
    return view.select(
        *[c for c in view.columns if c not in ("dimensiones", "pii_tokens", "datos_negocio", "firma_hmac", "firma_hmac_entrada")],
        F.col("dimensiones")["planta"].alias("planta"),
        F.col("datos_negocio")["total_registros"].alias("total"),
    )


def signature_sql(message: str) -> str:
    """HMAC-SHA256 of a text, spelt out by its definition."""
    block = SIGNING_KEY.ljust(64, b"\0")
    inner, outer = (bytes(b ^ p for b in block).hex() for p in (0x36, 0x5C))
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({message}))))"


@query(
    "chunk_integrity",
    f"""SELECT doc_id, hash_contenido, {signature_sql("hash_contenido")} AS firma_hmac, {signature_sql("doc_id || '|' || hash_contenido")} AS firma_hmac_entrada
FROM (SELECT doc_id, sha256(text) AS hash_contenido FROM documents)""",
)
def _(spark, sf):
    documents = fr.table(spark, sf, "documents").select(
        "doc_id", F.col("text").alias("texto"), F.col("doc_id").cast("string").alias("chunk_clave")
    )
    signed = ch.with_integrity(documents, SIGNING_KEY)
    return signed.select("doc_id", "hash_contenido", "firma_hmac", "firma_hmac_entrada")


@query("chunk_encrypt_roundtrip", "SELECT doc_id, text AS texto FROM documents")
def _(spark, sf):
    """Whole texts through encryption and back."""
    stored = fr.table(spark, sf, "documents").select("doc_id", ch.encrypt(F.col("text"), DATA_KEY).alias("cifrado"))
    return stored.select("doc_id", ch.decrypt(F.col("cifrado"), DATA_KEY).alias("texto"))


@query(
    "chunk_production_view",
    s.with_(*s.M1_CTES)
    + f"SELECT md5({key_sql(P1)}) AS chunk_id, {text_sql(P1)} AS texto, 'k1' AS kek_version, {len(DATA_KEY)} AS largo_dek FROM m1",
)
def _(spark, sf):
    """Production fields under a key for each chunk, opened again with the wrapped key's owner."""
    own = ch.chunk_data_key(F.col("chunk_id"), DATA_KEY)
    stored = ch.production_view(_built(spark, sf, P1), own, WRAPPING_KEY, "k1")
    unwrapped = ch.unwrapped({"k1": WRAPPING_KEY})
    return ch.opened(stored, {"k1": WRAPPING_KEY}).select("chunk_id", "texto", "kek_version", F.length(unwrapped).alias("largo_dek"))


@query(
    "chunk_key_rotation",
    """SELECT md5(cast(doc_id AS VARCHAR)) AS chunk_id, text AS texto, 'k2' AS kek_version, 32 AS largo_dek,
count(*) OVER () AS llaves FROM documents""",
)
def _(spark, sf):
    """Whole texts under a key each, stored; the wrapping key is replaced without touching a text, then all is opened with the new one."""
    own = ch.chunk_data_key(F.col("chunk_id"), DATA_KEY)
    sealed = _store(spark, sf).select(
        "chunk_id", ch.encrypt(F.col("texto"), own).alias("texto"), ch.wrap(own, WRAPPING_KEY).alias("dek_cifrada"), F.lit("k1").alias("kek_version")
    )
    store = KeyedStore(spark, scratch_path(spark, "cifrados"), digits=1)
    store.load(sealed, "r1")
    store.rotate({"k1": WRAPPING_KEY, "k2": NEXT_WRAPPING_KEY}, "k2", "r2", "r1")
    stored = store.read("r1", "r2")
    key = ch.unwrapped({"k2": NEXT_WRAPPING_KEY})
    distinct = stored.agg(F.count_distinct(key)).scalar()
    return ch.opened(stored, {"k2": NEXT_WRAPPING_KEY}, ["texto"]).select(
        "chunk_id", "texto", "kek_version", F.length(key).alias("largo_dek"), distinct.alias("llaves")
    )


def _store(spark, sf, column: str = "text"):
    """Documents as stored chunks, two ids per text source."""
    return fr.table(spark, sf, "documents").select(
        F.md5(F.col("doc_id").cast("string")).alias("chunk_id"), F.col(column).cast("string").alias("texto"), "lang"
    )


@query(
    "chunk_upsert",
    """SELECT md5(cast(d.doc_id AS VARCHAR)) AS chunk_id, CASE WHEN quality = 1 THEN source ELSE text END AS texto, lang
FROM documents d LEFT JOIN labels USING (doc_id)""",
)
def _(spark, sf):
    """Documents of good quality arrive again with a new text; the others stay."""
    good = fr.table(spark, sf, "labels").filter("quality = 1").select(F.md5(F.col("doc_id").cast("string")).alias("chunk_id"))
    new = _store(spark, sf, "source").join(good, "chunk_id", "left_semi")
    return ch.upsert_chunks(_store(spark, sf), new)


@query("chunk_upsert_buckets", ORACLE["chunk_upsert"])
def _(spark, sf):
    """The same through a stored table: the second run reads and writes the buckets of its ids only."""
    good = fr.table(spark, sf, "labels").filter("quality = 1").select(F.md5(F.col("doc_id").cast("string")).alias("chunk_id"))
    store = ChunkStore(spark, scratch_path(spark, "almacen"), SIGNING_KEY, digits=1)
    store.upsert(_store(spark, sf), "r1", None)
    return store.upsert(_store(spark, sf, "source").join(good, "chunk_id", "left_semi"), "r2", "r1")


@query(
    "chunk_pages",
    """SELECT (n // 512)::BIGINT AS pagina, min(chunk_id) AS primero, max(chunk_id) AS ultimo, count(*) AS filas
FROM (SELECT chunk_id, row_number() OVER (ORDER BY chunk_id) - 1 AS n FROM (SELECT md5(cast(doc_id AS VARCHAR)) AS chunk_id FROM documents)) GROUP BY 1""",
)
def _(spark, sf):
    """Pages of 512 chunks by id over the whole store."""
    return pages(_store(spark, sf), "chunk_id", 512)


@query(
    "chunk_validity",
    "SELECT doc_id FROM documents WHERE n_chars % 3 = 0 OR n_chars > 2000",
)
def _(spark, sf):
    until = F.when(F.col("n_chars") % 3 == 0, F.lit(-1)).otherwise(F.col("n_chars"))
    return ch.valid_chunks(fr.table(spark, sf, "documents").select("doc_id", until.alias("valido_hasta")), 2000).select("doc_id")


_CHUNK_ROWS = """rows AS (SELECT planta, punto_evaluacion, anio, semana, concentracion_mg_m3, fecha, hora_inicio, hora_termino,
  md5(concat_ws(' ', planta, punto_evaluacion, anio, semana, concentracion_mg_m3, fecha, hora_inicio)) AS chunk_id,
  coalesce(operador, '') AS operador, coalesce(tecnico, '') AS tecnico,
  CASE WHEN semana % 2 = 0 THEN 'etiquetas' ELSE 'borrar_chunk' END AS estrategia_olvido FROM named),
gone AS (SELECT 'Persona ' || s_suppkey AS valor FROM supplier WHERE s_acctbal < 1000)"""


def _named(spark, sf):
    """Every measurement with its people."""
    return with_people(fr.bronze(spark, sf), fr.aliases(spark, sf), fr.persons(spark, sf))


def _named_id(named):
    return ch.chunk_id(ch.chunk_key(named, ("planta", "punto_evaluacion", "anio", "semana", "concentracion_mg_m3", "fecha", "hora_inicio")))


def _named_chunks(named, keep=()):
    """Every measurement as a stored chunk with its people."""
    return named.select(
        _named_id(named).alias("chunk_id"),
        ch.pii_map(named, ("operador", "tecnico")).alias("pii_tokens"),
        F.when(F.col("semana") % 2 == 0, "etiquetas").otherwise("borrar_chunk").alias("estrategia_olvido"),
        *keep,
    )


@query(
    "chunk_forget",
    s.with_(*s.NAMED_ALL_CTES, _CHUNK_ROWS)
    + """SELECT chunk_id, estrategia_olvido, CASE WHEN operador NOT IN (FROM gone) THEN operador END AS operador,
CASE WHEN tecnico NOT IN (FROM gone) THEN tecnico END AS tecnico FROM rows
WHERE estrategia_olvido = 'etiquetas' OR (operador NOT IN (FROM gone) AND tecnico NOT IN (FROM gone))""",
)
def _(spark, sf):
    """Suppliers with a low balance ask to be forgotten; weeks alternate between the two strategies."""
    gone = (
        fr.table(spark, sf, "supplier")
        .filter("s_acctbal < 1000")
        .select(F.concat(F.lit("Persona "), F.col("s_suppkey").cast("string")).alias("valor"))
    )
    return ch.forget(_named_chunks(_named(spark, sf)), gone).select(
        "chunk_id", "estrategia_olvido", *[F.col("pii_tokens")[c].alias(c) for c in ("operador", "tecnico")]
    )


@query("chunk_forget_indexed", ORACLE["chunk_forget"])
def _(spark, sf):
    """The same request against a stored table: the index tells which buckets are read and written."""
    gone = fr.table(spark, sf, "supplier").filter("s_acctbal < 1000")
    people = gone.select(F.concat(F.lit("Persona "), F.col("s_suppkey").cast("string")).alias("valor"))
    store = ChunkStore(spark, scratch_path(spark, "almacen"), SIGNING_KEY, digits=1)
    named = _named(spark, sf)
    store.load_built([(named, _named_id(named), lambda rows: _named_chunks(rows, (BUCKET,)))], "r1")
    left = store.forget(people, "r2", "r1")
    return left.select("chunk_id", "estrategia_olvido", *[F.col("pii_tokens")[c].alias(c) for c in ("operador", "tecnico")])


_EXPECTED = {r.id: r for r in (P1, P2, P3, P4)}


def _rules_sql(values: str) -> str:
    """Counts of all rules but P3, whose chunks are left out, with the given column expressions over `id` and `n`."""
    counted = " UNION ALL ".join(f"SELECT '{r.id}' AS id, (SELECT count(*) FROM {m}) AS n" for r, m in ((P1, "m1"), (P2, "m2"), (P4, "four")))
    return f"rules AS ({counted} UNION ALL SELECT '{P3.id}', 0) SELECT id AS regla_id, n AS chunks, {values} FROM rules"


def _per_rule(get) -> str:
    return "CASE id " + " ".join(f"WHEN '{i}' THEN {get(r)}" for i, r in _EXPECTED.items()) + " END"


def _annual(mart, keep=()):
    """Chunks of rule P2: those of even years lost a tag, those of 1997 have a personal key too much."""
    annual = ch.build_chunks(mart, P2, **RUN, keep=keep)
    year = F.col("datos_negocio")["anio"].cast("int")
    tags = F.map_filter("dimensiones", lambda k, _: ~((k == "ambito") & (year % 2 == 0)))
    keys = F.when(year == 1997, F.map_concat("pii_tokens", F.create_map(F.lit("extra"), F.lit("x")))).otherwise(F.col("pii_tokens"))
    return annual.withColumns({"dimensiones": tags, "pii_tokens": keys})


def _run(spark, sf):
    """Chunks of a run: rule P3 yields nothing."""
    every = ch.build_chunks(_all_rows(spark, sf), P4, **RUN)
    return _built(spark, sf, P1).unionByName(_annual(fr.mart(spark, sf, P2.mart))).unionByName(every)


def _run_parts(spark, sf):
    """The same as rows of each rule and the step that builds its chunks."""
    keep = (BUCKET,)
    return [
        (*ch.rule_rows(fr.mart(spark, sf, P1.mart), P1), lambda rows: ch.build_chunks(rows, P1, **RUN, keep=keep)),
        (*ch.rule_rows(fr.mart(spark, sf, P2.mart), P2), lambda rows: _annual(rows, keep)),
        (*ch.rule_rows(_all_rows(spark, sf), P4), lambda rows: ch.build_chunks(rows, P4, **RUN, keep=keep)),
    ]


_RULE_CTES = (s.MED, s.BANDS, s.LIMIT, s.SESSIONS, *s.M1_CTES[-4:], *s.M2_CTES[-3:], s.people("med").replace("numbered", "numbered_all").replace("named AS", "four AS"))


@query(
    "rule_quality",
    s.with_(*_RULE_CTES)
    + ", "
    + _rules_sql(
        f"{_per_rule(lambda r: r.expected_min)}::BIGINT AS esperado_min, {_per_rule(lambda r: r.expected_max)}::BIGINT AS esperado_max, "
        f"n BETWEEN {_per_rule(lambda r: r.expected_min)} AND {_per_rule(lambda r: r.expected_max)} AS cumple"
    ),
)
def _(spark, sf):
    return ch.rule_quality(_run(spark, sf), [P1, P2, P3, P4])


@query("chunks_per_rule", s.with_(*_RULE_CTES) + ", " + _rules_sql("1 AS _").replace(", 1 AS _", "") + " WHERE n > 0")
def _(spark, sf):
    return metrics.chunks_per_rule(_run(spark, sf))


_MINIMUM = metrics.SUITE_MIN_CHUNKS
_FAULTS = f"CASE id WHEN '{P2.id}' THEN (SELECT count(*) FROM m2 WHERE {{0}}) ELSE 0 END"


@query(
    "chunk_suite_checks",
    s.with_(*_RULE_CTES)
    + ", checks AS (WITH "
    + _rules_sql(
        f"{_per_rule(lambda r: _MINIMUM[r.id])}::INTEGER AS min_chunks, {_FAULTS.format('anio % 2 = 0')} AS tags_erroneos, "
        f"{_FAULTS.format('anio = 1997')} AS pii_erronea"
    )
    + f"""), rows AS (FROM checks UNION ALL
  SELECT 'TOTAL', sum(chunks)::BIGINT, {metrics.SUITE_MIN_TOTAL}, sum(tags_erroneos)::BIGINT, sum(pii_erronea)::BIGINT FROM checks)
SELECT *, chunks >= min_chunks AND tags_erroneos = 0 AND pii_erronea = 0 AS cumple FROM rows""",
)
def _(spark, sf):
    return metrics.chunk_checks(_run(spark, sf), metrics.expectations([P1, P2, P3, P4]), metrics.SUITE_MIN_TOTAL)


@query("chunk_suite_checks_written", ORACLE["chunk_suite_checks"])
def _(spark, sf):
    """The same, counted by the pass that stores the chunks."""
    checks = metrics.WriteChecks(metrics.expectations([P1, P2, P3, P4]), metrics.SUITE_MIN_TOTAL)
    ChunkStore(spark, scratch_path(spark, "almacen"), SIGNING_KEY, digits=1).load_built(_run_parts(spark, sf), "r1", checks.watch)
    return checks.result(spark)


@query(
    "row_fingerprint",
    """SELECT p_partkey, substring(sha256(to_json({'marca': p_brand, 'nombre': p_name, 'tamano': p_size, 'tipo': nullif(p_type, 'SMALL')})), 1, 16)
AS huella FROM part""",
)
def _(spark, sf):
    return fr.table(spark, sf, "part").select(
        "p_partkey",
        fingerprint(
            {
                "nombre": F.col("p_name"),
                "marca": F.col("p_brand"),
                "tipo": F.nullif(F.col("p_type"), F.lit("SMALL")),
                "tamano": F.col("p_size"),
            }
        ).alias("huella"),
    )
