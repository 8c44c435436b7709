"""Conversations with model answers: mapped to the vocabularies, validated, reused by input, with provenance; and the store
that keeps them between runs."""

from __future__ import annotations

import uuid
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convolake import contract as C
from convolake.functions.text import decomposed, safe_string, unmasked_classes

#: What an answer is kept by, what it must say, the actions it may name, and ways to say a value. Fixed values.
KEY = ("conversation_id", "input_hash", "prompt_version", "model")
FIELDS = (
    "sentiment_label", "sentiment_confidence_band", "intent_stage", "persona_profile", "audience_segment",
    "price_objection_intensity", "competitor_pressure_level", "commercial_urgency_signal", "recommended_next_action",
)
ACTIONS = (
    "avancar_coleta_de_contexto", "enviar_cotacao_objetiva", "reforcar_diferenciais_e_retirar_objecao_preco",
    "priorizar_contato_imediato", "acionar_fluxo_pos_sinistro", "seguir_nutricao_basica",
)
VOCABULARIES = {
    "sentiment_label": C.GOLD_DOMAINS["conversation_sentiment_label"],
    "sentiment_confidence_band": C.GOLD_DOMAINS["conversation_sentiment_support"],
    **{f: C.GOLD_DOMAINS[f] for f in FIELDS[2:8]},
    "recommended_next_action": ACTIONS,
}
SYNONYMS = {
    "sentiment_label": {"negative": "negativo", "neutral": "neutro", "positive": "positivo"},
    "sentiment_confidence_band": {"low": "fraco", "moderate": "moderado", "weak": "fraco", "medium": "moderado", "high": "forte", "strong": "forte"},
    "intent_stage": {"quote_request": "cotacao_ativa"},
}
STATUSES = ("success", "fallback", "invalid_output", "provider_error", "disabled", "skipped_cache_hit")
CLOSE = 0.9
LONGEST = 280
FALLBACK_NOTE = "Fallback deterministico aplicado para classificacao semantica por conversa."

#: An answer as it comes in. Fields of output that the answer lacks are null; a null output is no answer.
ANSWERS = (
    f"{', '.join(f'{k} string' for k in KEY)}, status string, provider_name string, attempted_providers array<string>, provider_errors array<struct<provider: string, kind: string, detail: string>>, "
    f"output struct<{', '.join(f'{f}: string' for f in (*FIELDS, 'explanation_short'))}>, validation_error string, trace_id string, answered_at timestamp"
)
#: What a run adds to its conversations, and what a cached row brings along.
PROVENANCE = ("provider_name", "provider_attempt_count", "provider_error_summary", "trace_id", "fallback_reason", "validation_error")
KEPT = (*FIELDS, "explanation_short", *PROVENANCE)


def token(c: Column) -> Column:
    """Lower case, without accents, anything but letters and digits as one underscore."""
    plain = F.lower(F.regexp_replace(decomposed(c), r"\p{M}", ""))
    return F.regexp_replace(F.regexp_replace(plain, r"(?U)[\W_]+", "_"), "^_+|_+$", "")


def error_summary(errors: Column) -> Column:
    """provider:kind:detail of each error, blanks left out, joined; null where nothing is left."""
    filled = lambda *parts: F.concat_ws(":", *[F.nullif(F.trim(safe_string(p)), F.lit("")) for p in parts])
    said = F.filter(F.transform(errors, lambda e: filled(e["provider"], e["kind"], e["detail"])), lambda e: e != "")
    return F.nullif(F.array_join(said, " | "), F.lit(""))


def _pairs(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def closest(tokens: pd.Series) -> pd.Series:
    """For each row an array over FIELDS of tokens that no rule knows (or nulls): the one word of the field's vocabulary
    that is close enough (Ratcliff ratio), else null. Rows without such a token are null and cost nothing."""
    from difflib import SequenceMatcher
    from functools import cache

    @cache
    def one(field: str, value: str) -> str | None:
        near = [(SequenceMatcher(None, value, word).ratio(), word) for word in VOCABULARIES[field]]
        best = max(near)[0]
        words = [w for r, w in near if r == best]
        return words[0] if best >= CLOSE and len(words) == 1 else None

    def row(values) -> list[str | None] | None:
        return None if values is None else [None if v is None else one(f, v) for f, v in zip(FIELDS, values, strict=True)]

    return tokens.map(row)


def mapped(answers: DataFrame) -> DataFrame:
    """answers with output's values mapped to the vocabularies: by synonym, by spelling that differs in case, accents or
    separators, or by a typo that leaves one close word. Actions are taken as they are; what nothing fits stays."""
    raw = {f: F.trim(F.col(f"output.{f}")) for f in FIELDS}
    d = answers.withColumns({f"__raw_{f}": v for f, v in raw.items()} | {f"__token_{f}": token(v) for f, v in raw.items() if f != "recommended_next_action"})

    def known(f: str) -> Column:
        t = F.col(f"__token_{f}")
        by_rule = _pairs(SYNONYMS.get(f, {}) | {w: w for w in VOCABULARIES[f]})
        return F.when(t != "", by_rule[t])

    d = d.withColumns({f"__known_{f}": known(f) if f != "recommended_next_action" else F.lit(None).cast("string") for f in FIELDS})
    open_ = [F.lit(None).cast("string") if f == "recommended_next_action" else F.when(F.col(f"__known_{f}").isNull() & (F.col(f"__token_{f}") != ""), F.col(f"__token_{f}")) for f in FIELDS]
    asked = F.array(*open_)
    d = d.withColumn("__close", F.pandas_udf(closest, "array<string>")(F.when(F.exists(asked, lambda x: x.isNotNull()), asked)))
    value = lambda i, f: F.coalesce(F.col(f"__known_{f}"), F.get("__close", F.lit(i)), F.col(f"__raw_{f}")).alias(f)
    output = F.when(F.col("output").isNotNull(), F.struct(*[value(i, f) for i, f in enumerate(FIELDS)], F.col("output.explanation_short").alias("explanation_short")))
    return d.withColumn("output", output).drop(*[c for c in d.columns if c.startswith("__")])


def output_error(output: Column) -> Column:
    """The first rule that an answer's output breaks, or null."""
    missing = F.array_compact(F.array(*[F.when(output[f].isNull(), F.lit(f)) for f in FIELDS]))
    rules = [F.when(F.size(missing) > 0, F.concat(F.lit("missing_fields:"), F.array_join(missing, ",")))]
    rules += [F.when(~output[f].isin(*words), F.concat(F.lit(f"invalid_{f}:"), F.coalesce(F.nullif(output[f], F.lit("")), F.lit("<empty>")))) for f, words in VOCABULARIES.items()]
    note = F.trim(safe_string(output["explanation_short"]))
    return F.coalesce(*rules, F.when(F.length(note) > LONGEST, "explanation_too_long"), F.when(F.size(unmasked_classes(note)) > 0, "explanation_privacy_leak"))


def latest_by_key(rows: DataFrame, *order: str) -> DataFrame:
    """Of rows with the same KEY the one that comes last (of equal ones the greatest by content)."""
    others = [c for c in rows.columns if c not in KEY]
    last = F.max_by(F.struct(*others), F.struct(*order, F.xxhash64(F.to_json(F.struct(*others)))))
    return rows.groupBy(*KEY).agg(last.alias("__last")).select(*KEY, *[F.col(f"__last.{c}").alias(c) for c in others])


def enriched(conversations: DataFrame, answers: DataFrame | None, cache: DataFrame | None = None, model: str = "model", prompt_version: str = "v1") -> DataFrame:
    """conversations (rule-based semantics with input_hash) with what a model said about them.

    Where the cache holds the same conversation, input, prompt and model, its values and provenance are taken
    (skipped_cache_hit). Else the latest answer counts if it came and breaks no rule (success); in every other case the
    rules' values stay: without answers at all (disabled), without one for the conversation or with an unknown status
    (provider_error, fallback), with an answer that is invalid (invalid_output). All are one left join each on the key, with
    one row at most on the right, so conversations are neither lost nor repeated."""
    spark = conversations.sparkSession
    c = F.col
    d = conversations.withColumns({"prompt_version": F.lit(prompt_version), "model": F.lit(model)})
    if answers is None:
        d = d.withColumns({x: F.lit(None).cast(t) for x, t in spark.createDataFrame([], ANSWERS).dtypes if x not in KEY}).withColumn("__answered", F.lit(False))
    else:
        last = mapped(latest_by_key(answers.select(*spark.createDataFrame([], ANSWERS).columns), "answered_at"))
        d = d.join(last.withColumn("__answered", F.lit(True)), list(KEY), "left").withColumn("__answered", F.coalesce("__answered", F.lit(False)))
    if cache is None:
        d = d.withColumn("__cached", F.lit(None).cast(f"struct<{', '.join(f'{x}: {_kind(x)}' for x in KEPT)}>"))
    else:
        d = d.join(cache.select(*KEY, F.struct(*KEPT).alias("__cached")).dropDuplicates(list(KEY)), list(KEY), "left")
    summary = error_summary(c("provider_errors"))
    d = d.withColumns({"__summary": summary, "__broken": F.when(c("output").isNotNull() & (c("status") == "success"), output_error(c("output")))})
    said = c("__answered") & c("output").isNotNull() & c("status").eqNullSafe(F.lit("success"))
    status = (
        F.when(F.lit(answers is None), "disabled")
        .when(~c("__answered"), "provider_error")
        .when(~said, F.when(c("status").isin(*STATUSES) & (c("status") != "success"), c("status")).otherwise("fallback"))
        .when(c("__broken").isNotNull(), "invalid_output")
        .otherwise("success")
    )
    reason = (
        F.when(F.lit(answers is None), "llm_enrichment_disabled")
        .when(~c("__answered"), "no_answer")
        .when(~said, F.coalesce("__summary", F.lit("provider_graph_fallback")))
        .when(c("__broken").isNotNull(), "invalid_llm_response")
    )
    attempts = F.size(F.filter(F.coalesce("attempted_providers", F.array().cast("array<string>")), lambda p: F.trim(p) != ""))
    validation = F.when(said, c("__broken")).otherwise(F.nullif(F.trim("validation_error"), F.lit("")))
    good = status == "success"
    now = {f: F.when(good, c(f"output.{f}")).otherwise(c(f)) for f in FIELDS}
    now |= {
        "explanation_short": F.when(good, safe_string(c("output.explanation_short"))).otherwise(FALLBACK_NOTE),
        "provider_name": F.nullif(safe_string(c("provider_name")), F.lit("")),
        "provider_attempt_count": attempts.cast("int"),
        "provider_error_summary": c("__summary"),
        "trace_id": F.nullif(safe_string(c("trace_id")), F.lit("")),
        "fallback_reason": reason,
        "validation_error": validation,
    }
    hit = c("__cached").isNotNull()
    d = d.withColumns({x: F.when(hit, c(f"__cached.{x}")).otherwise(v) for x, v in now.items()} | {"inference_status": F.when(hit, "skipped_cache_hit").otherwise(status)})
    from_model = (safe_string(c("provider_name")) != "") & c("inference_status").isin("success", "skipped_cache_hit")
    return d.withColumn("source_family", F.when(from_model, "llm_provider").otherwise("deterministic_fallback")).drop("output", "status", "attempted_providers", "provider_errors", "answered_at", "__answered", "__cached", "__summary", "__broken")


def _kind(column: str) -> str:
    return "int" if column == "provider_attempt_count" else "string"


#: A kept row.
STORED = ", ".join([*(f"{k} string" for k in KEY), *(f"{x} {_kind(x)}" for x in KEPT)])


class AnswerStore:
    """Enriched conversations between runs, by KEY: each upsert appends the files of one version, a later version wins, and
    compaction folds all versions into one.

    A version is a folder of its own and counts from the moment that its row is in the list of versions, so a write that
    fails or is repeated leaves nothing that readers see; files are never changed. Rows lie in BUCKETS folders by hash of
    the conversation, so a version of many rows is written evenly, and a read of some conversations leaves other buckets
    alone. One writer at a time."""

    BUCKETS = 64

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._list().write.mode("ignore").parquet(f"{self.folder}/versions")

    def _list(self) -> DataFrame:
        return self.spark.createDataFrame([], "version long, path string, base boolean")

    def _live(self) -> list[tuple[int, str]]:
        """Versions from the last compaction on: as many rows as upserts since then."""
        rows = sorted(self.spark.read.schema(self._list().schema).parquet(f"{self.folder}/versions").collect())
        start = max((i for i, r in enumerate(rows) if r.base), default=0)
        return [(r.version, r.path) for r in rows[start:]]

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("conversation_id"), F.lit(self.BUCKETS)).cast("int")

    def _add(self, rows: DataFrame, base: bool) -> None:
        live = self._live()
        version, path = (live[-1][0] if live else 0) + 1, f"{self.folder}/data/{uuid.uuid4().hex}"
        rows.select(*self.spark.createDataFrame([], STORED).columns, self._bucket().alias("bucket")).repartition("bucket").write.partitionBy("bucket").parquet(path)
        self.spark.createDataFrame([(version, path, base)], self._list().schema).coalesce(1).write.mode("append").parquet(f"{self.folder}/versions")

    def upsert(self, rows: DataFrame) -> None:
        """Adds rows (KEY and KEPT), replacing those with the same key; rows that were cache hits are not written again."""
        fresh = rows.filter("inference_status <> 'skipped_cache_hit'") if "inference_status" in rows.columns else rows
        self._add(fresh.dropDuplicates(list(KEY)), base=False)

    def latest(self, of: DataFrame | None = None) -> DataFrame:
        """The last row of each key; of the conversations in of alone, if given (only their buckets are read)."""
        schema = self.spark.createDataFrame([], STORED + ", bucket int").schema
        parts = [self.spark.read.schema(schema).parquet(path).withColumn("version", F.lit(v)) for v, path in self._live()]
        if not parts:
            return self.spark.createDataFrame([], STORED)
        d = reduce(DataFrame.unionByName, parts)
        if of is not None:
            d = d.join(of.select("conversation_id", self._bucket().alias("bucket")).distinct(), ["bucket", "conversation_id"], "left_semi")
        return latest_by_key(d.drop("bucket"), "version").drop("version")

    def compact(self) -> None:
        self._add(self.latest(), base=True)
