"""Silver loads fed by newly arrived bronze files.

Not another operator: the insert-only and append-only loads of
`sources.sinks`, run once per arrival instead of over the whole history.
The stream's checkpoint remembers which files were taken; a micro-batch that is
replayed after a failure adds nothing, because both loads anti-join the target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sedimenta.plans import silver
from sedimenta.sources import sinks

# Fixed value: the thirteen bronze columns.
BRONZE_SCHEMA = (
    "planta string, punto_evaluacion string, semana int, anio int, concentracion_mg_m3 double, fecha date, "
    "operador_alias string, tecnico_alias string, hora_inicio string, hora_termino string, _col_posicion string, "
    "_bronce_fuente string, _bronce_loaded_at string"
)


def load_arrivals(spark: SparkSession, arrivals: str, target: str, checkpoint: str, aliases: DataFrame | None = None) -> StreamingQuery:
    """Takes all bronze Parquet files not seen yet and stops; start it once per week.

    Fills every silver table that comes from bronze; with the alias catalogue also persons and the people of measurements.
    """

    def load(batch: DataFrame, _batch_id: int) -> None:
        # all loads read the batch; it is stored for them only while this call lasts
        batch = batch.persist()
        try:
            loads = {
                "silver_entidad_planta": silver.entity_plant(batch),
                "silver_entidad_punto_medicion": silver.entity_point(batch),
                "silver_entidad_sesion_medicion": silver.entity_session(batch),
                "silver_relacion_medicion": silver.relation_measurement(batch),
            }
            if aliases is not None:
                loads["silver_entidad_persona"] = silver.entity_person(aliases)
                loads["silver_relacion_medicion_persona"] = silver.relation_measurement_person(batch, aliases)
            for name, rows in loads.items():
                sinks.append_new(rows, f"{target}/{name}")
            sinks.append_detail(silver.detail_measurement(batch), f"{target}/silver_detalle_medicion")
        finally:
            batch.unpersist()

    stream = spark.readStream.schema(BRONZE_SCHEMA).parquet(arrivals)
    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
