"""Text normalisation, masking and personal-data classes as column expressions."""

from __future__ import annotations

import unicodedata
from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from convolake import contract as C


@cache
def _folds() -> tuple[str, str, dict[str, str], str]:
    """From the compatibility decomposition (NFKD) of every character beyond ASCII: those with one ASCII character in it,
    that character; those with several, and these; and a pattern that finds the latter."""
    one, many = [], {}
    for code in (*range(0x80, 0xD800), *range(0xE000, 0x110000)):
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if ord(c) < 128)
        if len(plain) == 1:
            one.append((chr(code), plain))
        elif plain:
            many[chr(code)] = plain
    spans: list[list[int]] = []
    for code in map(ord, many):
        if spans and spans[-1][1] == code - 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    found = "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in spans)
    return "".join(a for a, _ in one), "".join(b for _, b in one), many, f"[{found}]"


def safe_string(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def safe_int(c: Column) -> Column:
    return F.coalesce(c.try_cast("long"), F.lit(0))


def safe_float(c: Column) -> Column:
    return c.try_cast("double")


def beyond_ascii(text: Column) -> Column:
    """Whether a text has a character beyond ASCII: it has more bytes than characters, or bytes that are none."""
    return (F.octet_length(text) != F.length(text)) | ~F.is_valid_utf8(text)


def decomposed(c: Column) -> Column:
    """Characters replaced by the ASCII part of their compatibility decomposition where that has any (accents go, wide and
    styled letters become plain ones, ligatures and enclosed letters become several). Only texts that hold one of the few
    hundred characters that become several are taken apart."""
    source, target, many, pattern = _folds()
    several = F.str_to_map(F.lit("\x02".join(f"{a}\x01{b}" for a, b in many.items())), F.lit("\x02"), F.lit("\x01"))  # one literal, so plans stay small
    text = safe_string(c)
    plain = F.translate(text, source, target)
    apart = F.transform(F.regexp_extract_all(plain, F.lit("(?s)."), F.lit(0)), lambda x: F.coalesce(several[x], x))
    return F.when(~beyond_ascii(text), text).when(text.rlike(pattern), F.array_join(apart, "")).otherwise(plain)


def ascii_only(c: Column) -> Column:
    """The compatibility decomposition (NFKD) without what is not ASCII."""
    text = safe_string(c)
    return F.when(beyond_ascii(text), F.regexp_replace(decomposed(c), r"[^\x00-\x7F]", "")).otherwise(text)


def match_norm(c: Column) -> Column:
    """Lower-case ASCII words with single blanks between."""
    return F.trim(F.regexp_replace(F.lower(ascii_only(c)), "[^a-z0-9]+", " "))


def mask_digits(c: Column) -> Column:
    return F.regexp_replace(safe_string(c), r"\d", "X")


def mask_name(c: Column) -> Column:
    return F.regexp_replace(safe_string(c), r"\p{L}", "X")


def masked_matches(text: Column, pattern, mask, can_match=None) -> Column:
    """text with mask applied to each match of pattern; what stands between matches stays. The text is bound to a lambda
    variable, so that masks can be nested without evaluating it anew in each place. can_match(text), where given, is a cheap
    condition that every text with a match meets: others are passed on as they are."""
    p = F.lit(pattern) if isinstance(pattern, str) else pattern

    def masked(t: Column) -> Column:
        out = _masked(t)
        return out if can_match is None else F.when(can_match(t), out).otherwise(t)

    def _masked(t: Column) -> Column:
        return F.array_join(F.zip_with(F.split(t, p, -1), F.transform(F.regexp_extract_all(t, p, F.lit(0)), mask), lambda gap, m: F.concat(gap, F.coalesce(m, F.lit("")))), "")

    return F.transform(F.array(text), masked)[0]


def has_digit(t: Column) -> Column:
    """Whether a text has a digit of any script, without which no CPF, CEP, phone or plate can be in it."""
    return t.rlike(r"(?U)\d")


def mask_email(c: Column) -> Column:
    return masked_matches(safe_string(c), C.PII["email"], lambda m: F.regexp_replace(m, "[A-Za-z0-9]", "x"), lambda t: F.contains(t, F.lit("@")))


def mask_plate(c: Column) -> Column:
    return masked_matches(safe_string(c), C.PII["plate"], lambda m: F.regexp_replace(F.regexp_replace(F.upper(m), r"\p{L}", "X"), "[0-9]", "9"), has_digit)


def name_pattern(name: Column) -> Column:
    """A pattern for the words of a name (two letters each, three in all at least); one that never matches for none."""
    plain = match_norm(name)
    words = F.filter(F.split(plain, " "), lambda w: F.length(w) >= 2)
    return F.when((F.length(plain) < 3) | (F.size(words) == 0), F.lit("(?!)")).otherwise(F.concat(F.lit(r"(?iU)\b"), F.array_join(words, r"\s+"), F.lit(r"\b")))


def may_hold_name(text: Column, name: Column) -> Column:
    """A cheap condition that every text with a match of name_pattern(name) meets: letters beyond ASCII (which may fold to
    ASCII ones), or the name's first word. The pattern, which differs from row to row, is only compiled where it holds."""
    word = F.nullif(F.regexp_extract(match_norm(name), "[a-z0-9]{2,}", 0), F.lit(""))
    return (text != "") & (beyond_ascii(text) | F.contains(F.lower(text), word))


def mask_known_names(text: Column, *names: Column) -> Column:
    for name in names:
        text = masked_matches(text, name_pattern(name), lambda m: F.regexp_replace(m, r"\p{L}", "X"), lambda t, n=name: may_hold_name(t, n))
    return text


def mask_body(text: Column, *names: Column) -> Column:
    """A message's text with e-mails, CPF, CEP, phones, plates and the conversation's names masked; its length stays. Texts
    that can hold none of these are passed on as they are: masks are lambdas, which Spark interprets row by row."""
    text = safe_string(text)
    can_match = reduce(lambda a, b: a | b, [may_hold_name(text, n) for n in names], F.contains(text, F.lit("@")) | has_digit(text))
    out = mask_email(text)
    for kind in ("cpf", "cep", "phone"):
        out = masked_matches(out, C.PII[kind], lambda m: F.regexp_replace(m, "[0-9]", "X"), has_digit)
    return F.when(can_match, mask_known_names(mask_plate(out), *names)).otherwise(text)


def may_hold(text: Column, kind: str) -> Column:
    """A cheap condition that every text with personal data of this kind meets."""
    return F.contains(text, F.lit("@")) if kind == "email" else has_digit(text)


def has_pii(c: Column, kind: str) -> Column:
    return may_hold(safe_string(c), kind) & safe_string(c).rlike(C.PII[kind])


def pii_classes(c: Column, kinds=C.FLAGS) -> Column:
    return F.array_compact(F.array(*[F.when(has_pii(c, k), F.lit(k)) for k in kinds]))


def unmasked_classes(c: Column, kinds=C.FLAGS) -> Column:
    """Classes present, masked e-mails and plates aside."""
    masked = {
        "email": lambda m: m.rlike(r"^[xX._%+-]+@[xX.-]+\.[xX]{2,}$"),
        "plate": lambda m: F.upper(m).rlike("^[X9-]+$"),
    }

    def present(k: str) -> Column:
        if k not in masked:
            return has_pii(c, k)
        return may_hold(safe_string(c), k) & F.exists(F.regexp_extract_all(safe_string(c), F.lit(C.PII[k]), F.lit(0)), lambda m: ~masked[k](m))

    return F.array_compact(F.array(*[F.when(present(k), F.lit(k)) for k in kinds]))
