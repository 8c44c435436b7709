"""Signals of one message as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convolake import contract as C
from convolake.functions.text import has_pii, match_norm, safe_string


def _first_label(*rules: tuple[Column, str]) -> Column:
    return F.coalesce(*[F.when(condition, F.lit(label)) for condition, label in rules])


def _any(text: Column, patterns, flags: str = "") -> Column:
    """Whether a text has a match of any pattern: one search, so that texts without need none for each."""
    return text.rlike(flags + "|".join(f"(?:{p})" for p in patterns))


def vehicle_make(body: Column, words: Column | None = None) -> Column:
    """words: match_norm(body), if it is at hand."""
    words = match_norm(body) if words is None else words
    return F.when(_any(words, [rf"\b(?:{'|'.join(C.MAKES)})\b"]), _first_label(*[(words.rlike(rf"\b{m}\b"), m) for m in C.MAKES]))


def vehicle_model(body: Column, words: Column | None = None) -> Column:
    """Models are looked for as substrings; punctuation is gone by then but for t-cross."""
    text = F.replace(match_norm(body) if words is None else words, F.lit("t cross"), F.lit("t-cross"))
    return _first_label(*[(text.contains(m.replace(" ", "-")), m) for m in C.MODELS])


def vehicle_year(body: Column, words: Column | None = None) -> Column:
    words = match_norm(body) if words is None else words
    stated = F.nullif(F.regexp_extract(words, r"\bano\s+(19\d{2}|20\d{2})\b", 1), F.lit(""))
    any_year = F.nullif(F.regexp_extract(words, r"\b(19\d{2}|20\d{2})\b", 1), F.lit(""))
    vehicle = vehicle_make(body, words).isNotNull() | vehicle_model(body, words).isNotNull() | has_pii(body, "plate")
    return F.when(any_year.isNotNull(), F.coalesce(stated, F.when(vehicle, any_year)))  # a stated year is one, too


def competitor(body: Column) -> Column:
    return F.when(_any(body, [p for _, p in C.COMPETITORS], "(?iU)"), _first_label(*[(body.rlike(f"(?iU){p}"), name) for name, p in C.COMPETITORS]))


def claim_type(body: Column, direction: Column) -> Column:
    """Of inbound messages; questions about cover are none."""
    low = F.lower(body)
    asks = low.contains("cobertura") & ~low.contains("tive") & ~low.contains("bati")
    return F.when((direction == "inbound") & ~asks & _any(low, [p for _, p in C.CLAIMS], "(?iU)"), _first_label(*[(low.rlike(f"(?iU){p}"), name) for name, p in C.CLAIMS]))


def price(body: Column) -> Column:
    """The first amount in reais: dots group thousands, a comma comes before the cents."""
    raw = F.when(F.contains(body, F.lit("$")), F.regexp_extract(body, f"(?iU){C.PRICE}", 1))
    return F.translate(F.replace(raw, F.lit("."), F.lit("")), ",", ".").try_cast("double")


def email_provider(body: Column) -> Column:
    domain = F.when(F.contains(body, F.lit("@")), F.lower(F.nullif(F.regexp_extract(body, f"(?iU){C.EMAIL_DOMAIN}", 1), F.lit(""))))
    known = [(reduce(lambda a, b: a | b, [domain.endswith(e) for e in ends]), name) for name, ends in C.PROVIDERS]
    return F.when(domain.isNotNull(), F.coalesce(_first_label(*known), F.lit("other")))


def urgency(body: Column) -> Column:
    return F.when(body.rlike(f"(?iU){C.URGENT_STRONG}"), 2).when(body.rlike(f"(?iU){C.URGENT_MODERATE}"), 1).otherwise(0)


def tone_hits(body: Column, patterns: tuple[str, ...], words: Column | None = None) -> Column:
    """Patterns found in the normalised text (words, if match_norm(body) is at hand as a column), which is bound to a lambda
    variable so that it is made once."""
    count = lambda words: F.when(_any(words, patterns), reduce(lambda a, b: a + b, [words.rlike(p).cast("int") for p in patterns])).otherwise(0)
    return F.transform(F.array(match_norm(body)), count)[0] if words is None else count(words)


def sentiment_label(pos: Column, neg: Column) -> Column:
    return F.when(pos + neg == 0, "sem_evidencia").when(pos - neg >= 2, "positivo").when(neg - pos >= 2, "negativo").otherwise("neutro")


def sentiment_support(pos: Column, neg: Column) -> Column:
    most, gap = F.greatest(pos, neg), F.abs(pos - neg)
    return F.when(pos + neg == 0, "sem_evidencia").when((most >= 2) | (gap >= 3), "forte").when((pos + neg >= 2) | (gap >= 1), "moderado").otherwise("fraco")


def when_direction(direction: Column, wanted: str, signal: Column, default=None) -> Column:
    return F.when(direction == wanted, signal).otherwise(default)


def message_signals(words: Column | None = None) -> dict[str, Column]:
    """All signals of a row with message_body, direction, sender_name and sender_phone."""
    body, direction = safe_string(F.col("message_body")), safe_string(F.col("direction"))
    return {
        "message_length": F.length(body),
        "word_count": F.regexp_count(body, F.lit(r"\S+")),
        "is_empty_message": F.trim(body) == "",
        **{f"contains_{k}": has_pii(body, k) for k in C.FLAGS},
        "vehicle_year": vehicle_year(body, words),
        "vehicle_make": vehicle_make(body, words),
        "vehicle_model": vehicle_model(body, words),
        "competitor_mentioned": competitor(body),
        "email_provider": email_provider(body),
        "quoted_price": price(body),
        "price_objection_signal": body.rlike(f"(?iU){C.OBJECTION}"),
        "urgency_strength": urgency(body),
        "competitor_comparison_signal": body.rlike(f"(?iU){C.COMPARISON}"),
        "sinistro_type": claim_type(body, direction),
    }


def mention_signals() -> dict[str, Column]:
    """What follows from message_signals(): mentions, and signals by direction."""
    d = safe_string(F.col("direction"))
    out = {
        "mentions_vehicle": F.col("vehicle_make").isNotNull() | F.col("vehicle_model").isNotNull() | F.col("vehicle_year").isNotNull() | F.col("contains_plate"),
        "mentions_competitor": F.col("competitor_mentioned").isNotNull(),
        "mentions_sinistro": F.col("sinistro_type").isNotNull(),
    }
    for side in ("inbound", "outbound"):
        out |= {
            f"price_objection_signal_{side}": when_direction(d, side, F.col("price_objection_signal"), False),
            f"urgency_strength_{side}": when_direction(d, side, F.col("urgency_strength"), 0),
            f"competitor_comparison_signal_{side}": when_direction(d, side, F.col("competitor_comparison_signal"), False),
            f"competitor_mentioned_{side}": when_direction(d, side, F.col("competitor_mentioned")),
            f"mentions_competitor_{side}": when_direction(d, side, F.col("competitor_mentioned")).isNotNull(),
        }
    return out


def with_directional_defaults(df: DataFrame) -> DataFrame:
    """Directional signals that a message table lacks (one of an older version) or has as null, from the signal itself and
    the direction; a signal that lacks too has its default."""
    there = set(df.columns)
    kind = {"price_objection_signal": False, "urgency_strength": 0, "competitor_comparison_signal": False}
    new = {}
    for name, default in kind.items():
        plain = F.coalesce(F.col(name), F.lit(default)) if name in there else F.lit(default)
        for side in ("inbound", "outbound"):
            mine = F.when(F.col("direction").eqNullSafe(F.lit(side)), plain).otherwise(F.lit(default))
            new[f"{name}_{side}"] = F.coalesce(F.col(f"{name}_{side}"), mine) if f"{name}_{side}" in there else mine
    return df.withColumns(new)
