"""The audit of all layers: checks as data, evaluated per layer in one pass, with a few keys of violating rows.

A result is (layer, check, status, violating_rows, detail). A check fails where a row violates it, and where a column that
it needs is missing (detail names the columns); detail else holds the smallest keys of violating rows, joined."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convolake import contract as C
from convolake.functions.text import unmasked_classes
from convolake.operators import enrichment as N
from convolake.operators.checks import repeated
from convolake.operators.common import any_flag, ordered, smallest
from convolake.operators.gold import SOURCES, audience_of, message_aggregates, with_measures, with_segments
from convolake.operators.publication import FORBIDDEN, RAW_TO_SAFE, safe_keys
from convolake.sources.messages import read_parquet, scratch_folder, write_parquet

RESULT = "layer string, check string, status string, violating_rows long, detail string"
SAMPLES = 5


@dataclass(frozen=True)
class Check:
    """A rule of a layer: which rows violate it, or which columns have to be unique together. Those of a diagnosis never
    fail."""

    layer: str
    name: str
    needs: tuple[str, ...]
    violated: Callable[[], Column] | None = None
    unique: tuple[str, ...] = ()
    diagnosis: bool = False


def c(name: str) -> Column:
    return F.col(name)


def _not(condition: Column) -> Column:
    """True where a condition is false or unknown."""
    return ~F.coalesce(condition, F.lit(False))


def _outside(column: str, domain: tuple[str, ...]) -> Column:
    return c(column).isNotNull() & ~c(column).isin(*domain)


def _leaks(columns: tuple[str, ...], classes: tuple[str, ...] = C.FLAGS) -> Column:
    return reduce(lambda a, b: a | b, [F.size(unmasked_classes(c(x), classes)) > 0 for x in columns])


# --- the registry: names are fixed values -------------------------------------------------------------------------------------
LEAD_TEXTS = ("canonical_lead_name_masked", "lead_contact_ref")
MESSAGE_TEXTS = tuple(RAW_TO_SAFE.values())
TEXT_FREE = (
    "conversation_id", "campaign_id", "agent_id", "engagement_bucket", "persona_profile", "audience_segment", "lead_temperature",
    "price_sensitivity", "intent_stage", "contact_readiness", "risk_signal", "primary_competitor", "city", "state", "lead_source",
    "vehicle_make", "vehicle_model", "primary_sinistro_type", "conversation_outcome",
)
SIGNALS = {"has_vehicle_signal": "mentions_vehicle", "has_competitor_signal": "mentions_competitor", "has_sinistro_signal": "mentions_sinistro", **{f"has_{k}_signal": f"contains_{k}" for k in C.FLAGS}}
FAMILIES = ("llm_provider", "deterministic_fallback", "mixed")
LEAD_NEEDS = ("lead_key", *LEAD_TEXTS, "city", "state", "first_seen_at", "last_seen_at", "conversation_count", "message_count", *SIGNALS)
MESSAGE_NEEDS = ("message_id", "lead_key", "conversation_id", "timestamp", "direction", "message_type", *MESSAGE_TEXTS)
GOLD_NEEDS = ("lead_key", "first_seen_at", "last_seen_at", "conversation_count", "total_messages", "inbound_messages", "outbound_messages", *C.GOLD_DOMAINS)
MACRO_NEEDS = ("dimension", "dimension_value", "lead_count", "lead_pct", "rank")
MACRO_IDS = ("lead_key", "contact_ref", "name_masked")


def _vehicle() -> Column:
    named = reduce(lambda a, b: a | b, [c(x).isNotNull() for x in ("vehicle_make", "vehicle_model", "vehicle_year")])
    return _not(c("mentions_vehicle").eqNullSafe(named | F.coalesce("contains_plate", F.lit(False))))


def _evidence() -> Column:
    label, good, bad = c("conversation_sentiment_label"), c("positive_tone_hits"), c("negative_tone_hits")
    against = lambda name, mine, other: (label == name) & (other >= 2) & (mine == 0)
    return against("positivo", good, bad) | against("negativo", bad, good) | ((label == "sem_evidencia") & ((good > 0) | (bad > 0)))


def _support() -> Column:
    none = lambda x: F.coalesce(c(x) == "sem_evidencia", F.lit(False))
    return none("conversation_sentiment_label") != none("conversation_sentiment_support")


MESSAGE_KEYS = safe_keys(C.DEDUPE_KEYS)
REGISTRY = (
    Check("bronze", "message_id_unique", ("message_id",), unique=("message_id",)),
    Check("bronze", "channel_whatsapp_only", ("channel",), lambda: _not(c("channel").isin(*C.DOMAINS["channel"]))),
    Check("silver", "lead_key_unique", ("lead_key",), unique=("lead_key",)),
    Check("silver", "lead_timestamps_not_null", ("first_seen_at", "last_seen_at"), lambda: c("first_seen_at").isNull() | c("last_seen_at").isNull()),
    Check("silver", "lead_counts_non_negative", ("conversation_count", "message_count"), lambda: _not((c("conversation_count") >= 0) & (c("message_count") >= 0))),
    Check("silver", "masked_text_fields_not_leaking", LEAD_TEXTS, lambda: _leaks(LEAD_TEXTS)),
    Check("silver_messages", "timestamp_not_null", ("timestamp",), lambda: c("timestamp").isNull()),
    Check("silver_messages", "dedupe_keys_unique", MESSAGE_KEYS, unique=MESSAGE_KEYS),
    *[Check("silver_messages", f"masked_{k}_not_leaking", MESSAGE_TEXTS, (lambda k: lambda: _leaks(MESSAGE_TEXTS, (k,)))(k)) for k in C.FLAGS],
    Check("silver_messages", "vehicle_mentions_consistent", ("mentions_vehicle", "vehicle_make", "vehicle_model", "vehicle_year", "contains_plate"), _vehicle),
    Check("silver_conversations_llm", "conversation_enrichment_contract_valid", (*N.FIELDS, "explanation_short", "inference_status"), lambda: N.output_error(F.struct(*N.FIELDS, "explanation_short")).isNotNull() | _not(c("inference_status").isin(*N.STATUSES))),
    Check("silver_conversations_llm", "masked_text_fields_not_leaking", ("explanation_short",), lambda: _leaks(("explanation_short",))),
    Check("gold", "lead_key_unique", ("lead_key",), unique=("lead_key",)),
    Check("gold", "conversation_count_non_negative", ("conversation_count",), lambda: _not(c("conversation_count") >= 0)),
    Check("gold", "message_totals_non_negative", ("total_messages",), lambda: _not(c("total_messages") >= 0)),
    Check("gold", "duplicate_events_removed_non_negative", ("duplicate_events_removed",), lambda: _not(c("duplicate_events_removed") >= 0)),
    *[Check("gold", f"{f}_valid", (f,), (lambda f, d: lambda: _outside(f, d))(f, d)) for f, d in C.GOLD_DOMAINS.items()],
    Check("gold", "dominant_email_provider_valid", ("dominant_email_provider",), lambda: _outside("dominant_email_provider", (*(n for n, _ in C.PROVIDERS), "other"))),
    Check("gold", "persona_profile_not_null", ("persona_profile",), lambda: c("persona_profile").isNull()),
    Check("gold", "semantic_source_family_valid", SOURCES, lambda: reduce(lambda a, b: a | b, [_outside(s, FAMILIES) for s in SOURCES])),
    Check("gold", "closure_outcome_flag_coherent", ("has_closed_outcome", "closure_outcome_group"), lambda: _not(c("has_closed_outcome").eqNullSafe(c("closure_outcome_group") == "fechado"))),
    Check("gold", "dominant_email_provider_nullability_coherent", ("dominant_email_provider", "contains_email"), lambda: c("dominant_email_provider").isNotNull() != F.coalesce("contains_email", F.lit(False))),
    Check("gold", "persona_audience_semantic_alignment", ("persona_profile", "audience_segment"), lambda: _not(audience_of(c("persona_profile")) == c("audience_segment"))),
    Check("gold", "conversation_sentiment_support_alignment", ("conversation_sentiment_label", "conversation_sentiment_support"), _support),
    Check("gold", "conversation_sentiment_evidence_compatibility", ("conversation_sentiment_label", "positive_tone_hits", "negative_tone_hits"), _evidence),
    Check("gold_macro", "no_duplicate_dimension_pairs", MACRO_NEEDS, unique=("dimension", "dimension_value")),
    Check("gold_macro", "lead_pct_in_bounds", MACRO_NEEDS, lambda: ~c("lead_pct").between(0, 1)),
    Check("gold_macro", "lead_count_non_negative", MACRO_NEEDS, lambda: c("lead_count") < 0),
    Check("gold_macro", "rank_positive", MACRO_NEEDS, lambda: c("rank") < 1),
    Check("gold_macro", "no_nulls_in_dimension", MACRO_NEEDS, lambda: c("dimension").isNull() | c("dimension_value").isNull()),
)
#: Columns that a layer must have, those it must not have, and safe ones that it must have.
SCHEMAS = {
    "bronze": (C.REQUIRED_COLUMNS, None, None),
    "silver": (LEAD_NEEDS, FORBIDDEN, LEAD_TEXTS),
    "silver_messages": (MESSAGE_NEEDS, FORBIDDEN, MESSAGE_TEXTS),
    "silver_conversations_llm": (None, (), ()),
    "gold": (GOLD_NEEDS, FORBIDDEN, None),
    "gold_macro": (MACRO_NEEDS, None, None),
}
KEYS = {"bronze": "message_id", "silver": "lead_key", "silver_messages": "message_id", "silver_conversations_llm": "conversation_id", "gold": "lead_key", "gold_macro": "dimension_value"}


# --- evaluation ---------------------------------------------------------------------------------------------------------------
def _fixed(df: DataFrame, rows: list[tuple[str, str, list[str]]]) -> DataFrame:
    """Results that a schema alone decides: (layer, check, offending columns)."""
    return df.sparkSession.createDataFrame([(layer, check, "failed" if bad else "passed", len(bad), ",".join(sorted(bad))) for layer, check, bad in rows], RESULT)


def schema_results(df: DataFrame, layer: str) -> DataFrame:
    required, forbidden, safe = SCHEMAS[layer]
    there, rows = set(df.columns), []
    if required is not None:
        rows.append((layer, "required_columns", [x for x in required if x not in there]))
    if forbidden is not None:
        rows.append((layer, "forbidden_raw_columns_absent", [x for x in forbidden if x in there]))
    if safe is not None:
        rows.append((layer, "required_safe_columns_present", [x for x in safe if x not in there]))
    if layer == "gold_macro":
        rows.append((layer, "no_pii_identifier_columns", [x for x in there if any(i in x for i in MACRO_IDS)]))
    return _fixed(df, rows)


def _stored(df: DataFrame) -> DataFrame:
    """df as a table in the folder that all executors share."""
    at = scratch_folder(df.sparkSession, "audit")
    write_parquet(df, at)
    return read_parquet(df.sparkSession, at, df.schema)


def evaluated(df: DataFrame, key: str, checks: tuple[Check, ...], samples: int = SAMPLES) -> DataFrame:
    """Results of checks on one table. Conditions are evaluated in one pass, which stores the keys of violating rows with
    their number; counts and samples are made of these. Uniqueness is counted in passes of its own, over its columns alone."""
    there = set(df.columns)
    able = [k for k in checks if there.issuperset(k.needs)]
    lacking = [(k.layer, k.name, [x for x in k.needs if x not in there]) for k in checks if not there.issuperset(k.needs)]
    failed = _fixed(df, [])
    if lacking:
        failed = _fixed(df, lacking).withColumns({"violating_rows": F.lit(0).cast("long"), "detail": F.concat(F.lit("missing:"), "detail")})
    if not able:
        return failed
    rows = {k.name: k.violated() for k in able if k.violated is not None}
    counts = [df.agg(repeated(*k.unique).cast("long").alias("violating_rows")).select(F.lit(k.name).alias("check"), "violating_rows", F.lit(None).cast("string").alias("samples")) for k in able if k.unique]
    if rows:
        who = F.coalesce(c(key).cast("string"), F.lit("<null>")) if key in there else F.lit("<no key>")
        each = df.select(who.alias("key"), F.explode(F.array_compact(F.array(*[F.when(v, F.lit(name)) for name, v in rows.items()]))).alias("check"))
        found = _stored(each.groupBy("check", "key").agg(F.count("*").alias("n")))
        counts.append(found.groupBy("check").agg(F.sum("n").alias("violating_rows")).join(smallest(found, "check", "key", samples), "check"))
    named = df.sparkSession.createDataFrame([(k.layer, k.name, k.diagnosis) for k in able], "layer string, check string, diagnosis boolean")
    d = named.join(reduce(DataFrame.unionByName, counts), "check", "left").withColumn("violating_rows", F.coalesce("violating_rows", F.lit(0).cast("long")))
    bad = (c("violating_rows") > 0) & ~c("diagnosis")
    return d.select("layer", "check", F.when(bad, "failed").otherwise("passed").alias("status"), "violating_rows", F.coalesce("samples", F.lit("")).alias("detail")).unionByName(failed)


def layer_results(df: DataFrame, layer: str) -> DataFrame:
    """All checks of one layer by itself."""
    d, checks = schema_results(df, layer), tuple(k for k in REGISTRY if k.layer == layer)
    if layer == "gold":
        texts = tuple(x for x, t in df.dtypes if t == "string" and x not in TEXT_FREE)
        if texts:
            checks += (Check("gold", "masked_text_fields_not_leaking", texts, lambda: _leaks(texts)),)
        else:
            d = d.unionByName(_fixed(df, [("gold", "masked_text_fields_not_leaking", [])]))
    if layer == "silver_conversations_llm":
        checks += (Check(layer, "conversation_id_unique", ("conversation_id",), unique=("conversation_id",)),)
    d = d.unionByName(evaluated(df, KEYS[layer], checks))
    if layer == "bronze":
        d = d.unionByName(_first_outbound(df))
    if layer == "gold_macro":
        d = d.unionByName(_dimensions(df))
    return d


def _first_outbound(bronze: DataFrame) -> DataFrame:
    """Conversations whose first message is not outbound: a diagnosis."""
    needs = ("conversation_id", "timestamp", "direction", "message_id")
    rule = Check("bronze", "first_message_outbound", needs, lambda: _not(c("direction") == "outbound"), diagnosis=True)
    if not set(needs) <= set(bronze.columns):
        return evaluated(bronze, "conversation_id", (rule,))
    first = bronze.groupBy("conversation_id").agg(F.min_by("direction", ordered("timestamp", "message_id")).alias("direction"))
    return evaluated(first.withColumns({"timestamp": F.lit(None), "message_id": F.lit(None)}), "conversation_id", (rule,))


def _dimensions(macro: DataFrame) -> DataFrame:
    """Dimensions that no row of the macro table shows."""
    if "dimension" not in macro.columns:
        return _fixed(macro, [("gold_macro", "all_required_dimensions_present", ["dimension"])]).withColumn("detail", F.lit("missing:dimension"))
    wanted = macro.sparkSession.createDataFrame([(d,) for d in C.MACRO_DIMENSIONS], "dimension string")
    absent = wanted.join(macro.select("dimension").distinct(), "dimension", "left_anti")
    one = absent.agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("dimension")), ",").alias("detail"))
    return one.select(F.lit("gold_macro").alias("layer"), F.lit("all_required_dimensions_present").alias("check"), F.when(c("n") > 0, "failed").otherwise("passed").alias("status"), c("n").alias("violating_rows"), "detail")


# --- between layers -----------------------------------------------------------------------------------------------------------
def _beside(left: DataFrame, right: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """left with right's columns as r_..., and __there where right has the key."""
    other = right.select("lead_key", *[c(x).alias(f"r_{x}") for x in columns], F.lit(True).alias("__there"))
    return left.join(other, "lead_key", "left").withColumn("__there", F.coalesce("__there", F.lit(False)))


def _differ(*names: str) -> Column:
    return c("__there") & ~reduce(lambda a, b: a & b, [c(x).eqNullSafe(c(f"r_{x}")) for x in names])


def lead_history(messages: DataFrame) -> DataFrame:
    """What both checks between layers ask of messages, per lead. The distinct count is made beside the aggregates, which
    would be kept for each conversation of a lead else."""
    seen = messages.groupBy("lead_key").agg(F.min("timestamp").alias("first_seen_at"), F.max("timestamp").alias("last_seen_at"), F.count_distinct("conversation_id").alias("conversation_count"), F.count("*").alias("message_count"))
    return seen.join(message_aggregates(messages), "lead_key")


def silver_consistency(leads: DataFrame, messages: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Leads against what their messages say. history: lead_history(messages), if it is at hand."""
    needs = ("lead_key", "first_seen_at", "last_seen_at", "conversation_count", "message_count", *SIGNALS)
    there = ("lead_key", "timestamp", "conversation_id", *SIGNALS.values())
    for df, layer, wanted in ((leads, "silver", needs), (messages, "silver_messages", there)):
        if missing := [x for x in wanted if x not in df.columns]:
            return _fixed(df, [(layer, "silver_lead_keys_have_messages", missing)]).withColumns({"violating_rows": F.lit(0).cast("long"), "detail": F.concat(F.lit("missing:"), "detail")})
    if history is None:
        again = messages.groupBy("lead_key").agg(
            F.min("timestamp").alias("first_seen_at"), F.max("timestamp").alias("last_seen_at"), F.count_distinct("conversation_id").alias("conversation_count"), F.count("*").alias("message_count"), *[any_flag(c(m)).alias(f) for f, m in SIGNALS.items()]
        )
    else:
        again = history.select("lead_key", *needs[1:5], *[c(m.replace("mentions_", "mentioned_")).alias(f) for f, m in SIGNALS.items()])
    rule = lambda name, v: Check("silver", name, needs, v)
    return evaluated(
        _beside(leads, again, needs[1:]),
        "lead_key",
        (
            rule("silver_lead_keys_have_messages", lambda: ~c("__there")),
            rule("silver_timestamps_match_messages", lambda: _differ("first_seen_at", "last_seen_at")),
            rule("silver_conversation_count_matches_messages", lambda: _differ("conversation_count")),
            rule("silver_message_count_matches_messages", lambda: _differ("message_count")),
            rule("silver_signal_flags_match_messages", lambda: _differ(*SIGNALS)),
        ),
    )


TOTALS = ("total_messages", "inbound_messages", "outbound_messages", "duplicate_events_removed")
FOUND = (*(f"contains_{k}" for k in C.FLAGS), "mentioned_vehicle", "mentioned_competitor", "mentioned_sinistro")
BY_RULE = ("engagement_bucket", "lead_temperature", "contact_readiness", "risk_signal", "response_latency_band", "price_objection_intensity", "commercial_urgency_signal", "competitor_pressure_level")


def gold_consistency(gold: DataFrame, leads: DataFrame, messages: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Gold against leads and messages, and its classifications against the same rules applied again to what these say.
    history: lead_history(messages), if it is at hand."""
    needs = ("lead_key", "first_seen_at", "last_seen_at", "conversation_count", *TOTALS, *FOUND, *BY_RULE, "has_closed_outcome", "closure_outcome_group", "dominant_email_provider", *SOURCES)
    for df, layer, wanted in ((gold, "gold", needs), (leads, "silver", ("lead_key", "first_seen_at", "last_seen_at")), (messages, "silver_messages", ("lead_key", "timestamp", "conversation_id"))):
        if missing := [x for x in wanted if x not in df.columns]:
            return _fixed(df, [(layer, "gold_lead_keys_in_silver", missing)]).withColumns({"violating_rows": F.lit(0).cast("long"), "detail": F.concat(F.lit("missing:"), "detail")})
    history = (lead_history(messages) if history is None else history).drop("message_count")
    rules = with_segments(with_measures(leads.drop("first_seen_at", "last_seen_at", "conversation_count").join(history, "lead_key")))
    expected = rules.select("lead_key", "first_seen_at", "last_seen_at", "conversation_count", *TOTALS, *FOUND, *BY_RULE)
    d = _beside(gold, expected, tuple(expected.columns[1:]))
    d = d.join(leads.select("lead_key", c("first_seen_at").alias("s_first"), c("last_seen_at").alias("s_last"), F.lit(True).alias("__lead")), "lead_key", "left")
    early = F.coalesce((c("first_seen_at") < c("s_first")) | (c("last_seen_at") < c("s_last")), F.lit(False))
    rule = lambda name, v: Check("gold", name, needs, v)
    coherent = [rule(f"{x}_coherent", (lambda x: lambda: _differ(x))(x)) for x in BY_RULE]
    return evaluated(
        d,
        "lead_key",
        (
            rule("gold_lead_keys_in_silver", lambda: c("__lead").isNull()),
            rule("gold_timestamps_match_published_history", lambda: _differ("first_seen_at", "last_seen_at") | early),
            rule("gold_conversation_count_matches_history", lambda: _differ("conversation_count")),
            rule("gold_message_totals_match_history", lambda: _differ(*TOTALS) | (c("__there") & ~(c("inbound_messages") + c("outbound_messages")).eqNullSafe(c("total_messages")))),
            rule("gold_signal_flags_match_history", lambda: _differ(*FOUND)),
            *coherent,
            rule("dominant_email_provider_coherent", lambda: c("__there") & (c("dominant_email_provider").isNotNull() != F.coalesce("contains_email", F.lit(False)))),
            rule("closure_outcome_coherent", lambda: c("__there") & _not(c("has_closed_outcome").eqNullSafe(c("closure_outcome_group") == "fechado"))),
            rule("gold_semantic_source_family_valid", lambda: c("__there") & reduce(lambda a, b: a | b, [_not(c(s).isin(*FAMILIES)) for s in SOURCES])),
        ),
    )


def audit(bronze: DataFrame, leads: DataFrame, messages: DataFrame, conversations: DataFrame, gold: DataFrame, macro: DataFrame) -> DataFrame:
    """All checks of all layers: each by itself (leads and messages as they are published), then against each other."""
    layers = {"bronze": bronze, "silver": leads, "silver_messages": messages, "silver_conversations_llm": conversations, "gold": gold, "gold_macro": macro}
    whole = set(messages.columns) >= {"timestamp", "conversation_id", *SIGNALS.values()}
    history = _stored(lead_history(messages)) if whole else None  # both ask for it
    parts = [layer_results(df, layer) for layer, df in layers.items()] + [silver_consistency(leads, messages, history), gold_consistency(gold, leads, messages, history)]
    return reduce(DataFrame.unionByName, parts)
