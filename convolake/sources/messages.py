"""Sources and sinks of message tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The message view over the events table; Spark and DuckDB run the same text (but for the quotes of one column).
MESSAGES_SQL = """
WITH base AS (
  SELECT event_id, user_id, ts,
         user_id * 100 + cast(floor((dayofyear(ts) - 1) /
           CASE user_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 7 ELSE 30 END) AS bigint) AS lead_no,
         CASE WHEN event_id % 5 < 3 THEN 'inbound' ELSE 'outbound' END AS direction
  FROM events
), msg AS (
  SELECT 'm' || lpad(cast(event_id AS string), 11, '0') AS message_id,
         'conv_' || lpad(cast(lead_no * 10 + dayofyear(ts) % 2 AS string), 8, '0') AS conversation_id,
         CASE WHEN event_id % 101 = 0 THEN NULL ELSE ts END AS "timestamp",
         direction,
         CASE WHEN direction = 'inbound' THEN '+55119' || lpad(cast(lead_no AS string), 8, '0')
              ELSE '+55118' || lpad(cast(user_id % 17 AS string), 8, '0') END AS sender_phone,
         CASE WHEN direction = 'outbound' THEN 'Diego Pereira'
              WHEN event_id % 4 = 0 THEN 'Ana Paula' WHEN event_id % 4 = 1 THEN 'ana paula'
              WHEN event_id % 4 = 2 THEN '' ELSE 'JOAO SILVA' END AS sender_name,
         CASE WHEN event_id % 11 = 0 THEN 'image' WHEN event_id % 13 = 0 THEN 'audio'
              WHEN event_id % 17 = 0 THEN 'video' ELSE 'text' END AS message_type,
         CASE event_id % 20
           WHEN 0 THEN 'oi Ana Paula, tudo bem?'
           WHEN 1 THEN 'meu email eh cliente' || cast(user_id AS string) || '@gmail.com'
           WHEN 2 THEN 'cpf 123.456.789-' || lpad(cast(user_id % 100 AS string), 2, '0') || ' e cep 04567-123'
           WHEN 3 THEN 'telefone +55 11 99999-' || lpad(cast(user_id AS string), 4, '0')
           WHEN 4 THEN 'gol 2019 placa ABC1D' || lpad(cast(user_id % 100 AS string), 2, '0')
           WHEN 5 THEN 'tenho um hyundai hb20 ano 2021'
           WHEN 6 THEN 'a Porto Seguro cobrou R$ 1.' || lpad(cast(event_id % 1000 AS string), 3, '0') || ',50'
           WHEN 7 THEN 'muito caro, quero desconto'
           WHEN 8 THEN 'preciso urgente, quero fechar hoje'
           WHEN 9 THEN 'pode ser essa semana, prioridade'
           WHEN 10 THEN 'tive um sinistro, batida traseira'
           WHEN 11 THEN 'obrigado, perfeito, quero fechar'
           WHEN 12 THEN 'nao tenho interesse, um absurdo'
           WHEN 13 THEN 'contato@hotmail.com'
           WHEN 14 THEN 'a cotacao ficou R$ 950,00'
           WHEN 15 THEN 'allianz eh mais barato'
           WHEN 16 THEN ''
           WHEN 17 THEN NULL
           WHEN 18 THEN 'corolla prata, como funciona a cobertura de roubo?'
           ELSE 'ok' END AS message_body,
         CASE event_id % 4 WHEN 0 THEN 'sent' WHEN 1 THEN 'delivered' WHEN 2 THEN 'read' ELSE 'failed' END AS status,
         'whatsapp' AS channel,
         'camp_' || cast(user_id % 9 AS string) || '_fev2026' AS campaign_id,
         'agent_' || cast(user_id % 17 AS string) AS agent_id,
         CASE user_id % 8 WHEN 0 THEN 'fechado' WHEN 1 THEN 'perdido' WHEN 2 THEN 'venda_fechada'
              WHEN 3 THEN 'em_negociacao' WHEN 4 THEN 'ghosting' WHEN 5 THEN NULL
              WHEN 6 THEN 'sem interesse' ELSE 'proposta_enviada' END AS conversation_outcome,
         CASE WHEN event_id % 97 = 0 THEN 'not-json' ELSE
           '{"device":"' || CASE WHEN event_id % 2 = 0 THEN 'android' ELSE 'iphone' END
           || '","city":"' || CASE user_id % 3 WHEN 0 THEN 'Campinas' WHEN 1 THEN 'Recife' ELSE 'Curitiba' END
           || '","state":"' || CASE user_id % 3 WHEN 0 THEN 'SP' WHEN 1 THEN 'PE' ELSE 'PR' END
           || '","response_time_sec":' || CASE WHEN direction = 'outbound' THEN 'null' ELSE cast((user_id * 37) % 4000 AS string) END
           || ',"is_business_hours":' || CASE WHEN event_id % 3 = 0 THEN 'true' ELSE 'false' END
           || CASE WHEN event_id % 50 = 0 THEN ',"leadScore":"sim"' ELSE '' END
           || ',"lead_source":"' || CASE WHEN user_id % 2 = 0 THEN 'google_ads' ELSE 'instagram' END || '"}' END AS metadata
  FROM base
)
SELECT * FROM msg
UNION ALL
SELECT message_id || 'd' AS message_id, conversation_id, "timestamp", direction, sender_phone, sender_name, message_type,
       message_body, 'read' AS status, channel, campaign_id, agent_id, conversation_outcome, metadata
FROM msg WHERE substr(message_id, 12, 1) = '7'
"""


def configured(spark: SparkSession) -> SparkSession:
    """JSON objects with repeated keys are read as their last value, not rejected."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def fixture_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 14-column message table derived from the events table."""
    events = configured(spark).read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "ts")
    view = f"events_{uuid.uuid4().hex}"
    events.createOrReplaceTempView(view)
    try:
        return spark.sql(MESSAGES_SQL.replace('"timestamp"', "`timestamp`").replace("FROM events", f"FROM {view}"))
    finally:
        spark.catalog.dropTempView(view)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share: below spark.checkpoint.dir, or a temporary one where that is unset and Spark
    runs in one process (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-scratch-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def read_parquet(spark: SparkSession, path: str, schema=None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Messages with their timestamp as a timestamp; text that is none becomes null."""
    return with_timestamp(configured(spark).read.parquet(path))


def with_timestamp(df: DataFrame) -> DataFrame:
    kind = dict(df.dtypes)["timestamp"]
    return df.withColumn("timestamp", F.try_to_timestamp("timestamp") if kind == "string" else F.col("timestamp").cast("timestamp"))


def message_ids(df: DataFrame) -> DataFrame:
    """Distinct ids; only that column is read."""
    return df.select("message_id").distinct()


def write_parquet(df: DataFrame, path: str, *partition_by: str) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path) if partition_by else df.write.mode("overwrite").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


#: A table, or how it is made of the layers that were written before it (by name).
Layer = DataFrame | Callable[[dict[str, DataFrame]], DataFrame]


def publish(layers: dict[str, Layer], folder: str, checks: Layer | None = None) -> dict[str, str]:
    """Write, audit, publish: all layers go once to a folder of a new version; only if no check failed does one row that
    names the version join the table of versions, so that readers see all layers of a version or none. Layers (and checks)
    that are made of others take them as written, so they are not written elsewhere before.

    Nothing is published where a check fails (ValueError with the failed checks)."""
    version, done = uuid.uuid4().hex, {}
    made = lambda x: x(done) if callable(x) else x
    for name, layer in layers.items():
        df = made(layer)
        df.write.parquet(f"{folder}/{version}/{name}")
        done[name] = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{version}/{name}")
    spark = df.sparkSession
    if (checks := made(checks)) is not None and (failed := [r.check for r in checks.filter("status = 'failed'").select("check").limit(100).collect()]):
        raise ValueError(f"not published: {', '.join(sorted(failed))}")
    row = spark.range(1).select(F.lit(version).alias("version"), F.array(*[F.lit(n) for n in layers]).alias("layers"), F.current_timestamp().alias("published_at"))
    row.coalesce(1).write.mode("append").parquet(f"{folder}/versions")
    return published(spark, folder)


def published(spark: SparkSession, folder: str) -> dict[str, str]:
    """Where the layers of the version that was published last are."""
    last = spark.read.parquet(f"{folder}/versions").agg(F.max_by(F.struct("version", "layers"), F.struct("published_at", "version")).alias("v")).first().v
    return {name: f"{folder}/{last.version}/{name}" for name in last.layers}
