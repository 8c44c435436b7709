"""Streaming: ingestion of new message files (by stored ids, or with a watermark), and refresh of the leads that a batch
touches."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from convolake import contract as C
from convolake.operators.silver import LEAD_COLUMNS, silver_leads, silver_messages
from convolake.sources.messages import scratch_folder

STORED = C.BRONZE_SCHEMA + ", batch long"


@dataclass
class Run:
    """What a run of a stream did, by its progress reports: micro-batches with rows, rows that came in, rows in state at
    most, rows that the watermark dropped."""

    batches: int = 0
    rows: int = 0
    state_rows: int = 0
    dropped: int = 0
    _seen: set = field(default_factory=set)

    def add(self, progress) -> None:
        if progress.batchId in self._seen:
            return
        self._seen.add(progress.batchId)
        self.batches += progress.numInputRows > 0
        self.rows += progress.numInputRows
        self.state_rows = max([self.state_rows, *(s.numRowsTotal for s in progress.stateOperators)])
        self.dropped += sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)


def _drained(writer, checkpoint: str) -> Run:
    """Runs a stream until the files that are there now are read, and says what it did. Reports are taken as they come, so a
    run of more batches than Spark keeps reports of is counted too."""
    query, run = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(), Run()
    while not query.awaitTermination(0.2):
        for p in query.recentProgress:
            run.add(p)
    for p in query.recentProgress:
        run.add(p)
    return run


def _files(spark: SparkSession, source: str, files: int) -> DataFrame:
    return spark.readStream.schema(C.BRONZE_SCHEMA).option("maxFilesPerTrigger", files).parquet(source)


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, files: int = 1_000) -> Run:
    """Appends messages from new files (so many in a batch at most) whose id is not stored yet, until no new file is left.
    A batch that runs again after a failure writes over its own folder, so nothing is stored twice."""

    def store(batch: DataFrame, number: int) -> None:
        known = spark.read.schema(STORED).parquet(target).filter(F.col("batch") != number).select("message_id")
        new = batch.dropDuplicates(["message_id"]).join(known, "message_id", "left_anti")
        new.write.mode("overwrite").parquet(f"{target}/batch={number}")

    spark.createDataFrame([], C.BRONZE_SCHEMA).write.mode("ignore").parquet(f"{target}/batch=-1")  # there is a table from the start
    return _drained(_files(spark, source, files).writeStream.foreachBatch(store), checkpoint)


# --- with a watermark -------------------------------------------------------------------------------------------------------
OUTCOMES = C.BRONZE_SCHEMA + ", batch long, outcome string"


def ingest_watermarked(spark: SparkSession, source: str, target: str, checkpoint: str, delay_seconds: int = 86_400, files: int = 1_000) -> Run:
    """For histories without end: ids are kept in state only within the watermark, and stored rows are never read again.

    target gets one folder per batch, by outcome: `stored` rows (the first of their id within the watermark), and, as
    quarantine, `late` rows (event time at or before the watermark, which Spark's deduplication drops) and those with an
    `invalid_timestamp`. Each batch is the stream of all rows beside the stream of those that pass, so that a row that is
    dropped is still seen; the watermark is that of Spark: the latest event time of earlier batches less the delay, which
    each batch leaves in a row of the table of bounds."""
    bounds = f"{target}-bounds"
    kind = "batch long, latest_ms long"
    spark.createDataFrame([], kind).write.mode("ignore").parquet(f"{bounds}/run=-1")
    spark.createDataFrame([], C.BRONZE_SCHEMA).write.mode("ignore").parquet(f"{target}/batch=-1/outcome=stored")
    ms = F.floor(F.unix_micros("timestamp") / 1000)

    def store(batch: DataFrame, number: int) -> None:
        before = spark.read.schema(kind).parquet(bounds).filter(F.col("batch") < number).agg(F.max("latest_ms")).first()[0]
        bound = F.lit(0 if before is None else max(0, before - delay_seconds * 1000))
        passed = F.col("__passed")
        outcome = F.when(passed, "stored").when(F.col("timestamp").isNull(), "invalid_timestamp").when(ms <= bound, "late")
        seen = Observation()
        told = batch.observe(seen, F.max(F.when(~passed, ms)).alias("latest_ms"))
        rows = told.withColumn("outcome", outcome).filter("outcome IS NOT NULL").drop("__passed")
        rows.write.mode("overwrite").partitionBy("outcome").parquet(f"{target}/batch={number}")
        spark.createDataFrame([(number, seen.get["latest_ms"])], kind).coalesce(1).write.mode("overwrite").parquet(f"{bounds}/run={number}")

    rows = _files(spark, source, files)
    timed = rows.filter("timestamp IS NOT NULL").withWatermark("timestamp", f"{delay_seconds} seconds")
    passed = timed.dropDuplicatesWithinWatermark(["message_id"]).withColumn("__passed", F.lit(True))
    both = passed.unionByName(rows.withColumn("__passed", F.lit(False)))
    return _drained(both.writeStream.foreachBatch(store), checkpoint)


# --- leads kept up to date --------------------------------------------------------------------------------------------------
class LeadTable:
    """Leads that a stream of messages keeps up to date, as a table in folders by hash of the lead.

    Beside it stand the messages, by hash of their conversation, and which conversations hold which leads, in both orders.
    A micro-batch reads the buckets that its conversations and leads lie in, makes the touched leads anew from all their
    messages, and replaces the buckets of these alone (dynamic partition overwrite); other buckets keep their files. A
    lead's messages lie in the conversations that held it before or hold it now, so no other is needed. A batch that runs
    again after a failure writes the same."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets
        self._made: dict[str, str] = {}

    # a bucket that is rewritten always gets a row without key, so that it is replaced even where no lead is left in it
    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _read(self, name: str, schema: str, buckets: list[int] | None = None) -> DataFrame:
        path = self._path(name)
        self.spark.createDataFrame([], f"{schema}, bucket int").write.partitionBy("bucket").mode("ignore").parquet(path)
        d = self.spark.read.schema(f"{schema}, bucket int").parquet(path)
        return d if buckets is None else d.filter(F.col("bucket").isin(buckets or [-1]))

    def _replace(self, name: str, schema: str, key: str, gone: DataFrame, rows: DataFrame) -> None:
        """In a table by key: the rows of keys in gone are replaced by rows."""
        buckets = _few(gone.select(self._bucket(F.col(key)).alias("b")))
        kept = self._read(name, schema, buckets).filter(F.col(key).isNotNull()).join(gone, key, "left_anti")
        marks = self.spark.createDataFrame([(b,) for b in buckets], "bucket int")
        new = kept.unionByName(rows.withColumn("bucket", self._bucket(F.col(key)))).unionByName(marks, allowMissingColumns=True)
        staged = f"{self.folder}/staged/{name}"
        new.repartition("bucket").write.mode("overwrite").parquet(staged)  # the buckets that are read are written next
        d = self.spark.read.schema(new.schema).parquet(staged)
        d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self._path(name))

    def leads(self) -> DataFrame:
        return self._read("leads", self._lead_schema()).filter("lead_key IS NOT NULL").drop("bucket")

    def _lead_schema(self) -> str:
        if "leads" not in self._made:
            empty = silver_leads(silver_messages(self.spark.createDataFrame([], C.BRONZE_SCHEMA)))
            self._made["leads"] = ", ".join(f"`{c}` {t}" for c, t in empty.dtypes)
        return self._made["leads"]

    def _messages(self, conversations: DataFrame) -> DataFrame:
        """All messages of these conversations (column conversation_key)."""
        buckets = _few(conversations.select(self._bucket(F.col("conversation_key")).alias("b")))
        stored = self.spark.read.schema(f"{C.BRONZE_SCHEMA}, batch long, bucket int").parquet(self._path("messages")).filter(F.col("bucket").isin(buckets or [-1]))
        return _keyed(stored.drop("batch", "bucket")).join(conversations, "conversation_key", "left_semi").drop("conversation_key")

    def apply(self, batch: DataFrame, number: int) -> None:
        """One micro-batch."""
        pairs = "lead_key string, conversation_key string"
        kept = _keyed(batch.select(*C.REQUIRED_COLUMNS)).withColumn("bucket", self._bucket(F.col("conversation_key"))).drop("conversation_key")
        kept.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self._path('messages')}/batch={number}")
        come = self.spark.read.schema(f"{C.BRONZE_SCHEMA}, bucket int").parquet(f"{self._path('messages')}/batch={number}")
        touched = _keyed(come).select("conversation_key").distinct()
        here = self._held(silver_messages(self._messages(touched)).select(*LEAD_COLUMNS), "touched")
        by_conversation = self._read("by_conversation", pairs, _few(touched.select(self._bucket(F.col("conversation_key")).alias("b"))))
        before = by_conversation.join(touched, "conversation_key", "left_semi").select("lead_key")
        stale = self._held(here.select("lead_key").union(before).filter("lead_key IS NOT NULL").distinct(), "stale")
        by_lead = self._read("by_lead", pairs, _few(stale.select(self._bucket(F.col("lead_key")).alias("b"))))
        others = by_lead.join(stale, "lead_key", "left_semi").select("conversation_key").distinct().join(touched, "conversation_key", "left_anti")
        others = self._held(others, "others")
        more = self._held(silver_messages(self._messages(others)).select(*LEAD_COLUMNS), "more")  # silver is made conversation by conversation
        silver = here.unionByName(more)
        held = _keyed(silver).select("lead_key", "conversation_key").distinct()
        self._replace("leads", self._lead_schema(), "lead_key", stale, silver_leads(silver.join(stale, "lead_key", "left_semi")))
        self._replace("by_lead", pairs, "lead_key", stale, held.join(stale, "lead_key", "left_semi"))
        self._replace("by_conversation", pairs, "conversation_key", touched.union(others), held)

    def _held(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/staged/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def follow(self, source: str, checkpoint: str, files: int = 1_000) -> Run:
        """Applies the files that have come in since the last run, so many in a micro-batch at most."""
        return _drained(_files(self.spark, source, files).writeStream.foreachBatch(self.apply), checkpoint)


def _keyed(df: DataFrame) -> DataFrame:
    """With conversation_key: messages without a conversation are looked up together."""
    return df.withColumn("conversation_key", F.coalesce("conversation_id", F.lit("")))


def _few(buckets: DataFrame) -> list[int]:
    """Distinct buckets (column b): as many as the table has at most."""
    return sorted(r.b for r in buckets.distinct().collect())


# --- replays over a message table -------------------------------------------------------------------------------------------
def _arrive(part: DataFrame, at: str) -> None:
    part.select(*C.REQUIRED_COLUMNS).repartition("conversation_id").write.mode("append").parquet(f"{at}/in")


def replay_ingest(spark: SparkSession, messages: DataFrame) -> DataFrame:
    """The ids that are stored after the messages came in three arrivals, with repeats."""
    at = scratch_folder(spark, "stream")
    for k in range(3):
        _arrive(messages.filter(F.pmod(F.xxhash64("conversation_id"), F.lit(3)) <= k), at)
        ingest(spark, f"{at}/in", f"{at}/out", f"{at}/checkpoint")
    ingest(spark, f"{at}/in", f"{at}/out", f"{at}/checkpoint")  # nothing new: no batch runs
    return spark.read.schema(STORED).parquet(f"{at}/out").select("message_id")


def replay_late(spark: SparkSession, messages: DataFrame, held_back: Column, delay_seconds: int = 86_400) -> DataFrame:
    """message_id and outcome after the messages came in three arrivals, those that are held back in the last."""
    at = scratch_folder(spark, "late")
    first = F.coalesce(F.col("timestamp") < "2024-01-15", F.lit(True))
    for part in (messages.filter(~held_back & first), messages.filter(~held_back & ~first), messages.filter(held_back)):
        _arrive(part, at)
        ingest_watermarked(spark, f"{at}/in", f"{at}/out", f"{at}/checkpoint", delay_seconds)
    return spark.read.schema(OUTCOMES).parquet(f"{at}/out").select("message_id", "outcome")


def replay_idle(spark: SparkSession, messages: DataFrame) -> DataFrame:
    """Stored rows and micro-batches (by Spark's progress reports) after the same source was read three times: only the
    first run has something to do."""
    at, runs = scratch_folder(spark, "idle"), []
    _arrive(messages, at)
    for _ in range(3):
        runs.append(ingest(spark, f"{at}/in", f"{at}/out", f"{at}/checkpoint", files=1_000_000))
    stored = spark.read.schema(STORED).parquet(f"{at}/out")
    return stored.agg(F.count("*").alias("rows"), F.lit(sum(r.batches for r in runs)).cast("long").alias("batches"), F.lit(sum(r.rows for r in runs)).cast("long").alias("rows_read"))


def replay_refresh(spark: SparkSession, messages: DataFrame) -> DataFrame:
    """Leads after the messages came in three micro-batches, by time."""
    at = scratch_folder(spark, "stream")
    table = LeadTable(spark, f"{at}/table", buckets=16)
    day = F.coalesce(F.dayofyear("timestamp"), F.lit(0))
    for low, high in ((0, 10), (11, 20), (21, 366)):
        _arrive(messages.filter(day.between(low, high)), at)
        table.follow(f"{at}/in", f"{at}/checkpoint", files=1_000_000)
    return table.leads()
