"""Vector search, recall, memory and context."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.operators import chunks as ch
from sedimenta.operators import context, vectors
from sedimenta.operators import governance as gov
from sedimenta.operators.ranking import last_n
from sedimenta.operators.vector_cells import VectorCells
from sedimenta.session import scratch_path
from sedimenta.testbed import frames as fr
from sedimenta.testbed import sql as s
from sedimenta.testbed.registry import ORACLE, query

SIZE = 64


@query(
    "vector_validate",
    f"""SELECT vec_id, coalesce(len(embedding) = {SIZE} AND list_sum(list_transform(embedding, lambda x: cast(x AS DOUBLE) * x)) > 0, false) AS valido
FROM embeddings""",
)
def _(spark, sf):
    return vectors.validate_vectors(fr.table(spark, sf, "embeddings"), SIZE).select("vec_id", "valido")


def _top(spark, sf, table=None, **options):
    table = fr.table(spark, sf, "embeddings") if table is None else table
    return vectors.top_k(table, fr.centroids(spark, sf), **options)


def _tagged(spark, sf):
    languages = fr.table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "lang")
    return fr.table(spark, sf, "embeddings").join(languages, "vec_id")


def _readable(spark):
    """Keeps the rows whose language the reader may see."""
    grants = gov.user_grants(spark, {"lector": {"idioma": ["europeos"]}})
    groups = gov.group_members(spark, {"idioma": {"europeos": ("en", "es")}})
    return lambda df: gov.governed(df, gov.expand_grants(grants, groups), "lector", {"idioma": "lang"})


@query("vector_topk", s.with_(*s.topk()) + "SELECT query_id, vec_id, score, cast(rn AS INTEGER) AS rn FROM top")
def _(spark, sf):
    """The ten nearest vectors to the mean of every label, over all vectors."""
    return _top(spark, sf)


@query(
    "vector_topk_min_score",
    s.with_(*s.topk(min_score=0.4)) + "SELECT query_id, vec_id, score, cast(rn AS INTEGER) AS rn FROM top",
)
def _(spark, sf):
    return _top(spark, sf, min_score=0.4)


@query(
    "vector_topk_governed",
    s.with_(
        "allowed AS (SELECT e.vec_id, e.embedding FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id WHERE d.lang IN ('en', 'es'))",
        *s.topk("allowed"),
    )
    + "SELECT query_id, vec_id, score, cast(rn AS INTEGER) AS rn FROM top",
)
def _(spark, sf):
    """Only vectors of documents in the user's languages are scored."""
    return _top(spark, sf, _readable(spark)(_tagged(spark, sf)))


@query("vector_cells_topk", ORACLE["vector_topk"])
def _(spark, sf):
    """The same from a table in cells, whose far cells are left out by their bounds."""
    store = VectorCells(spark, scratch_path(spark, "vectores")).build(fr.table(spark, sf, "embeddings"), SIZE)
    return store.search(fr.centroids(spark, sf), 10).rows


@query("vector_cells_governed", ORACLE["vector_topk_governed"])
def _(spark, sf):
    """Languages are folders: what the user may not see is not read."""
    store = VectorCells(spark, scratch_path(spark, "vectores"), ["lang"]).build(_tagged(spark, sf), SIZE)
    return store.search(fr.centroids(spark, sf), 10, _readable(spark)).rows


@query(
    "recall_at_k",
    s.with_(*s.topk())
    + """SELECT r.query_id, count(top.vec_id) AS encontrados, count(*) AS relevantes, count(top.vec_id) / count(*) AS recall
FROM (SELECT label AS query_id, vec_id FROM embeddings) r LEFT JOIN top ON top.query_id = r.query_id AND top.vec_id = r.vec_id
GROUP BY r.query_id""",
)
def _(spark, sf):
    relevant = fr.table(spark, sf, "embeddings").select(F.col("label").alias("query_id"), "vec_id")
    return ch.recall_at_k(_top(spark, sf), relevant, "query_id", "vec_id")


_LAST = "(SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations) WHERE rn <= 5"


@query("last_n_turns", f"SELECT conv_id, turn, role, text FROM {_LAST}")
def _(spark, sf):
    return last_n(fr.table(spark, sf, "conversations"), ["conv_id"], "turn", 5)


_CONTEXT = r"""ctx AS (SELECT query_id, '[CONTEXTO]' || chr(10) || string_agg(text, chr(10) ORDER BY rn) AS contexto
  FROM top JOIN documents ON doc_id = vec_id GROUP BY query_id),
mem AS (SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS memoria FROM """ + _LAST + """ GROUP BY conv_id),
ask AS (SELECT conv_id, cast(conv_id % (SELECT count(DISTINCT label) FROM embeddings) AS INTEGER) AS query_id FROM (SELECT DISTINCT conv_id FROM conversations))"""


@query(
    "rag_context",
    s.with_(*s.topk(), _CONTEXT)
    + """SELECT ask.conv_id, coalesce(contexto, '[CONTEXTO]') || chr(10) || coalesce(memoria, '') AS prompt
FROM ask LEFT JOIN ctx USING (query_id) LEFT JOIN mem USING (conv_id)""",
)
def _(spark, sf):
    """Every conversation asks about one label: its ten documents, whole, and its last five turns."""
    turns = fr.table(spark, sf, "conversations")
    labels = fr.table(spark, sf, "embeddings").agg(F.count_distinct("label")).scalar()
    questions = turns.select("conv_id").distinct().select("conv_id", (F.col("conv_id") % labels).cast("int").alias("query_id"))
    texts = fr.table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), F.col("text").alias("texto"))
    contexts = context.context_text(_top(spark, sf), texts, item="vec_id")
    return context.prompts(questions, contexts, context.memory(turns))
