"""Mart rows -> tagged, tokenised, hashed, signed and encrypted text chunks."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.keys import derived_key, fingerprint, hmac_sha256, joined_key
from sedimenta.functions.text import number_text
from sedimenta.operators.lookup import distinct_for_join, local_rows
from sedimenta.sources import fixed_values as fv
from sedimenta.sources.registry import Rule

_PLACEHOLDER = re.compile(r"{{\s*(\w+)\s*}}")

# The fields of a chunk, by where they appear.
COMMON_FIELDS = (
    "regla_id",
    "fecha_creacion",
    "corrida_id",
    "medallon_id",
    "valido_hasta",
    "politica_vigencia",
    "dimensiones",
    "dimensiones_en_texto",
    "pii_estrategia",
    "pii_tokens",
    "estrategia_olvido",
    "hash_contenido",
    "firma_hmac",
    "texto",
    "datos_negocio",
)
PRODUCTION_FIELDS = ("chunk_id", "regla_version", "dek_cifrada", "kek_version")
DEVELOPMENT_FIELDS = ("chunk_clave", "firma_hmac_entrada")


def token(column: str) -> str:
    """Text that stands for a personal value."""
    return f"[{column.upper()}]"


def shown_text(df: DataFrame, column: str) -> Column:
    """Text of a column inside templates, keys and payloads; NULL becomes ''."""
    dtype = df.schema[column].dataType
    value = F.col(column)
    if isinstance(dtype, T.StringType):
        return F.coalesce(value, F.lit(""))
    text = number_text(column) if isinstance(dtype, (T.DoubleType, T.FloatType)) else value.cast("string")
    return F.coalesce(text, F.lit(""))


def chunk_key(df: DataFrame, columns: Sequence[str], separator: str = " ", prefix: str | None = None) -> Column:
    """Readable key of a chunk. A prefix (the rule id) keeps keys of different rules apart."""
    parts = [shown_text(df, c) for c in columns]
    return joined_key([F.lit(prefix), *parts] if prefix else parts, separator)


def chunk_id(key: Column) -> Column:
    return F.md5(key)


def render(df: DataFrame, template: str, tokens: Sequence[str] = ()) -> Column:
    """Template text of each row; columns in `tokens` show their token instead of the value.

    The template is cut once on the driver into literals and columns, so rows
    are rendered by one generated concat.
    """
    parts: list[Column] = []
    position = 0
    for match in _PLACEHOLDER.finditer(template):
        name = match.group(1)
        if name not in df.columns:
            raise ValueError(f"placeholder {name} is not among the columns")
        parts += [F.lit(template[position : match.start()]), F.lit(token(name)) if name in tokens else shown_text(df, name)]
        position = match.end()
    parts.append(F.lit(template[position:]))
    return F.concat(*parts)


def pii_map(df: DataFrame, columns: Sequence[str]) -> Column:
    """Personal column -> value; the empty map when none is declared."""
    if not columns:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[c for name in columns for c in (F.lit(name), shown_text(df, name))])


def tag_map(tags: Mapping[str, str]) -> Column:
    """Governance tags: a literal, or the value of a column (`column:x`)."""
    pairs: list[Column] = []
    for name, source in tags.items():
        value = F.col(source.removeprefix("column:")).cast("string") if source.startswith("column:") else F.lit(source)
        pairs += [F.lit(name), value]
    return F.create_map(*pairs)


def tagged_text(text: Column, tags: Mapping[str, str], in_text: Sequence[str]) -> Column:
    """The text with the chosen tags in front."""
    parts: list[Column] = []
    for name in in_text:
        source = tags[name]
        value = F.col(source.removeprefix("column:")).cast("string") if source.startswith("column:") else F.lit(source)
        parts.append(F.concat(F.lit(f"{name}: "), value))
    return F.concat_ws("\n", *parts, text)


def build_chunks(
    mart: DataFrame,
    rule: Rule,
    run_id: str,
    created_at: str,
    medallion_id: str,
    signing_key: bytes,
    valid_until: int = fv.NO_EXPIRY,
    keep: Sequence[str] = (),
) -> DataFrame:
    """All fields of the chunks of a rule, with clear text; a narrow transform of the mart.

    `texto` holds tokens for personal values; their values are only in `pii_tokens`.
    Every column is turned to text once, and key, text and payload refer to that. Columns to `keep` come last, as they are.
    """
    rows = mart.select(*[shown_text(mart, c).alias(c) for c in rule.columns], *keep)
    key = chunk_key(rows, rule.key_columns, rule.separator, prefix=rule.id)
    text = tagged_text(render(rows, rule.template, rule.pii), rule.tags, rule.tags_in_text)
    business = F.create_map(
        *[
            c
            for name in rule.columns
            for c in (F.lit(name), F.lit(token(name)) if name in rule.pii else shown_text(rows, name))
        ]
    )
    built = rows.select(
        F.lit(rule.id).alias("regla_id"),
        F.lit(created_at).alias("fecha_creacion"),
        F.lit(run_id).alias("corrida_id"),
        F.lit(medallion_id).alias("medallon_id"),
        F.lit(valid_until).cast("long").alias("valido_hasta"),
        F.lit(rule.validity_policy).alias("politica_vigencia"),
        tag_map(rule.tags).alias("dimensiones"),
        F.array(*[F.lit(t) for t in rule.tags_in_text]).alias("dimensiones_en_texto"),
        F.lit(rule.pii_strategy).alias("pii_estrategia"),
        pii_map(rows, rule.pii).alias("pii_tokens"),
        F.lit(rule.forgetting).alias("estrategia_olvido"),
        text.alias("texto"),
        business.alias("datos_negocio"),
        key.alias("chunk_clave"),
        chunk_id(key).alias("chunk_id"),
        fingerprint({"id": F.lit(rule.id), "plantilla": F.lit(rule.template), "version": F.lit(rule.version)}).alias(
            "regla_version"
        ),
        *keep,
    )
    return with_integrity(built, signing_key)


def rule_rows(mart: DataFrame, rule: Rule) -> tuple[DataFrame, Column]:
    """What `build_chunks` needs of a mart, and the id of each row's chunk: for stores that build chunks where they are written."""
    rows = mart.select(*rule.columns)
    return rows, chunk_id(chunk_key(rows, rule.key_columns, rule.separator, prefix=rule.id))


def with_integrity(chunks: DataFrame, signing_key: bytes) -> DataFrame:
    """Content hash, its signature, and the signature of key plus hash as received."""
    return (
        chunks.withColumn("hash_contenido", F.sha2("texto", 256))
        .withColumn("firma_hmac", hmac_sha256(F.col("hash_contenido"), signing_key))
        .withColumn("firma_hmac_entrada", hmac_sha256(F.concat_ws("|", "chunk_clave", "hash_contenido"), signing_key))
    )


def development_view(chunks: DataFrame) -> DataFrame:
    """Fields for inspection: clear text, readable key."""
    return chunks.select(*COMMON_FIELDS, *DEVELOPMENT_FIELDS)


def production_view(chunks: DataFrame, data_key: bytes | Column, wrapping_key: bytes, wrapping_version: str) -> DataFrame:
    """Fields for storage: text and business data encrypted, the data key wrapped.

    With `chunk_data_key` as the data key every chunk has a key of its own; bytes are one key for all. AES-GCM draws a new
    IV for every value. Nothing is compared or joined on ciphertext, so a retried task may write other bytes for
    the same content.
    """
    own = data_key if isinstance(data_key, Column) else F.lit(data_key)
    return chunks.select(
        *[c for c in COMMON_FIELDS if c not in ("texto", "datos_negocio")],
        encrypt(F.col("texto"), own).alias("texto"),
        encrypt(F.to_json("datos_negocio"), own).alias("datos_negocio"),
        "chunk_id",
        "regla_version",
        wrap(own, wrapping_key).alias("dek_cifrada"),
        F.lit(wrapping_version).alias("kek_version"),
    )


def chunk_data_key(identity: Column, run_key: bytes) -> Column:
    """The data key of one chunk, derived from the run's key and its id, so a task that runs again derives the same."""
    return derived_key(F.concat(F.lit("chunk|"), F.coalesce(identity, F.lit(""))), run_key)


def wrap(data_key: Column, wrapping_key: bytes) -> Column:
    return F.base64(F.aes_encrypt(data_key, F.lit(wrapping_key), F.lit("GCM")))


def unwrapped(wrapping_keys: Mapping[str, bytes], wrapped: str = "dek_cifrada", version: str = "kek_version") -> Column:
    """The data key of a row, by the wrapping key of its version. A version that was not given ends the query."""
    held = F.col(wrapped)
    known = F.raise_error(F.concat(F.lit("no wrapping key of version "), F.coalesce(F.col(version), F.lit("NULL")))).cast("binary")
    for name, key in wrapping_keys.items():
        known = F.when(F.col(version) == name, F.aes_decrypt(F.unbase64(held), F.lit(key), F.lit("GCM"))).otherwise(known)
    return F.when(held.isNotNull(), known)


def opened(stored: DataFrame, wrapping_keys: Mapping[str, bytes], columns: Sequence[str] = ("texto", "datos_negocio")) -> DataFrame:
    """Stored chunks with the given columns in clear text; the key fields stay as they are."""
    own = unwrapped(wrapping_keys)
    return stored.withColumns({c: decrypt(F.col(c), own) for c in columns})


def rotate_wrapping(stored: DataFrame, wrapping_keys: Mapping[str, bytes], version: str) -> DataFrame:
    """Data keys wrapped anew under `version`, one of the given keys. Texts are not touched, nor rows that have that version already."""
    others = {v: k for v, k in wrapping_keys.items() if v != version}
    stale = ~F.col("kek_version").eqNullSafe(version)
    again = F.when(stale, wrap(unwrapped(others), wrapping_keys[version])).otherwise(F.col("dek_cifrada"))
    return stored.withColumns({"dek_cifrada": again, "kek_version": F.lit(version)})


def encrypt(text: Column, key: bytes | Column) -> Column:
    return F.base64(F.aes_encrypt(text, key if isinstance(key, Column) else F.lit(key), F.lit("GCM")))


def decrypt(text: Column, key: bytes | Column) -> Column:
    return F.aes_decrypt(F.unbase64(text), key if isinstance(key, Column) else F.lit(key), F.lit("GCM")).cast("string")


def upsert_chunks(stored: DataFrame, new: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Stored chunks replaced by new ones of the same id; chunks absent from `new` stay. Of repeated new ids one counts."""
    return stored.join(distinct_for_join(new, key), key, "left_anti").unionByName(one_per_id(new, key))


def one_per_id(chunks: DataFrame, key: str = "chunk_id") -> DataFrame:
    """One chunk per id: the latest, then the least by content hash, signature and all other fields.

    Personal values are not in the text, so rows of different people can have one hash; the whole row as text ends
    the order, and the same chunk is kept whatever the order of the input.
    """
    names = [c for c in ("hash_contenido", "firma_hmac") if c in chunks.columns]
    rest = F.to_json(F.struct(*sorted(c for c in chunks.columns if c not in (key, "fecha_creacion", *names))), {"ignoreNullFields": "false"})
    latest = [F.col("fecha_creacion").desc()] if "fecha_creacion" in chunks.columns else []
    window = Window.partitionBy(key).orderBy(*latest, *names, rest)
    return chunks.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def inherit_chunks(chunks: DataFrame, heirs: Mapping[str, str]) -> DataFrame:
    """Chunks of replaced rules under the rule that inherits them: `heirs` maps old rule id -> new one. Others stay."""
    rule = F.col("regla_id")
    heir = rule
    for old, new in heirs.items():
        heir = F.when(rule == old, F.lit(new)).otherwise(heir)
    return chunks.withColumn("regla_id", heir)


def valid_chunks(chunks: DataFrame, now_epoch: int | Column) -> DataFrame:
    """Chunks that have not expired; -1 never does."""
    now = F.lit(now_epoch) if isinstance(now_epoch, int) else now_epoch
    return chunks.filter((F.col("valido_hasta") == fv.NO_EXPIRY) | (F.col("valido_hasta") > now))


def forget(chunks: DataFrame, people: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Right to be forgotten for the values in `people(valor)`.

    Strategy `borrar_chunk` drops the chunk that holds one of the values;
    `etiquetas` keeps it and drops those entries from `pii_tokens`.
    Entries are looked up as rows `(chunk, entry)`, so the forget list may be large.

    `within` names columns that follow from the id, such as a bucket: the rows then come in ranges of them and of the id, by the one
    shuffle in which chunks meet their entries, and can be written by these columns without another.
    """
    values = distinct_for_join(people, "valor")
    entries = chunks.select(*within, "chunk_id", F.explode("pii_tokens").alias("_name", "valor")).join(values, "valor", "left_semi")
    if within:
        marked = _met_in_ranges(chunks, entries.drop("valor"), within)
    else:
        marked = chunks.join(entries.groupBy("chunk_id").agg(F.collect_set("_name").alias("_hit")), "chunk_id", "left")
    kept = marked.filter(F.col("_hit").isNull() | (F.col("estrategia_olvido") != "borrar_chunk"))
    cleaned = F.when(F.col("_hit").isNull(), F.col("pii_tokens")).otherwise(
        F.map_filter("pii_tokens", lambda name, _: ~F.array_contains(F.col("_hit"), name))
    )
    return kept.withColumn("pii_tokens", cleaned).drop("_hit")


def _met_in_ranges(chunks: DataFrame, entries: DataFrame, within: Sequence[str]) -> DataFrame:
    """Chunks with `_hit`, the names of the entries `(within, chunk_id, _name)` of their id or NULL, in ranges of `within` and the id.

    Chunks without an id have no entries; a hash of the row spreads them.
    """
    row = F.xxhash64(F.to_json(F.struct(*chunks.columns), {"ignoreNullFields": "false"}))
    spread = F.when(F.col("chunk_id").isNull(), row).otherwise(F.lit(0))
    both = chunks.withColumns({"_name": F.lit(None).cast("string"), "_spread": spread, "_chunk": F.lit(True)}).unionByName(
        entries.filter(F.col("chunk_id").isNotNull()).withColumns({"_spread": F.lit(0).cast("long"), "_chunk": F.lit(False)}), allowMissingColumns=True
    )
    place = [*within, "chunk_id", "_spread"]
    names = F.collect_set("_name").over(Window.partitionBy(*place))
    met = both.repartitionByRange(*place).withColumn("_hit", names).filter("_chunk")
    return met.withColumn("_hit", F.when(F.size("_hit") > 0, F.col("_hit"))).drop("_name", "_spread", "_chunk")


def rule_quality(chunks: DataFrame, rules: Sequence[Rule], recall: DataFrame | None = None) -> DataFrame:
    """Chunk count of every rule, also of those without chunks, against its expected range.

    `recall` holds measured recall as `(regla_id, recall)`; then a rule must also reach its `recall_min`. A
    rule without a measurement has a NULL recall and does not comply.
    """
    declared = local_rows(
        chunks.sparkSession,
        [(r.id, r.expected_min, r.expected_max, r.recall_min) for r in rules],
        "regla_id string, esperado_min long, esperado_max long, recall_min double",
    )
    counts = chunks.groupBy("regla_id").agg(F.count("*").alias("chunks"))
    ranged = declared.join(counts, "regla_id", "left").withColumn("chunks", F.coalesce("chunks", F.lit(0).cast("long")))
    complies = F.col("chunks").between(F.col("esperado_min"), F.col("esperado_max"))
    if recall is None:
        return ranged.select("regla_id", "chunks", "esperado_min", "esperado_max", complies.alias("cumple"))
    measured = ranged.join(recall.select("regla_id", "recall"), "regla_id", "left")
    complies = complies & F.coalesce(F.col("recall") >= F.col("recall_min"), F.lit(False))
    return measured.select("regla_id", "chunks", "esperado_min", "esperado_max", "recall", "recall_min", complies.alias("cumple"))


def recall_at_k(retrieved: DataFrame, relevant: DataFrame, query: str, item: str) -> DataFrame:
    """Share of each query's relevant items that were retrieved. Both frames hold `(query, item)` pairs."""
    found = retrieved.select(query, item).distinct().withColumn("_found", F.lit(1))
    return (
        relevant.select(query, item)
        .distinct()
        .join(found, [query, item], "left")
        .groupBy(query)
        .agg(F.count("_found").alias("encontrados"), F.count("*").alias("relevantes"))
        .withColumn("recall", F.col("encontrados") / F.col("relevantes"))
    )
