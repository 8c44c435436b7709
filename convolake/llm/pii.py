"""Operator 1: personal data by candidate generation and gradient-boosted trees.

Base rules (e-mail, IPv4, card number, phone) always hold. Wide patterns of each kind, and of secrets (keys, tokens,
passwords), propose further spans, which may overlap; boosted trees score them from their format and context, and a
threshold per kind, calibrated on held-out candidates, selects those that are added. The trees are Spark ML's. There are
no labels for personal data, so the fit plants its own: into the context of every document go spans of each kind in forms
that the base rules miss (other separators, [at] and [dot], no plus sign, keys and passwords), and look-alikes that are
none (versions, times, order numbers, failed check digits, digests), all of them in a small table, one in each document of
a large one; all texts' own candidates that meet no base span are negatives too. Equal candidates are one row with a
weight, so what the trees see grows with the kinds of candidates. The trees are then compiled into one column expression: the whole
text is scanned once by DataFrame functions, without Python, shuffle or collected text.

Offsets count code points, ends are exclusive. Defined results: a null or empty text has no spans; repeated rows are
scanned each for itself; a table without rows adds no span to the base ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convolake.llm.common import bind, record, table, written

KINDS = ("email", "ip", "card", "phone")
#: Base patterns. Possessive quantifiers and look-behinds keep the matches and bound the matcher's work and stack; card
#: matches of fewer than 14 digits, which fail anyway, are left out.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Kinds that only the method adds, after the base ones.
ALL_KINDS = (*KINDS, "secret")
#: Wide patterns: high recall, low precision.
WIDE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++\x20?(?:@|[(\[]at[)\]])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9A-Fa-f.:])[0-9A-Fa-f]++(?:\[?[.:]\]?[0-9A-Fa-f]++){3,}+",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){11,}+",
    "phone": r"(?<![0-9])[(]?[0-9](?:[\x20().-]{0,3}+[0-9]){6,}+",
    "secret": r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{12,}+",
}
NEAR = 24
SECRET_HINTS = "(?i)pass|pwd|secret|token|key|auth|credential|bearer"
KEY_PREFIX = "^(?:AKIA|ASIA|gh[opsu]_|sk[-_]|pk[-_]|xox[abp]-|AIza|eyJ)"
HINTS = "(?i)mail|contact|phone|tel|call|fax|mobile|card|visa|credit|pay|addr|host|login|user"
#: The fit: planted spans that a small table gets at least (each document lends its context to one or more), trees and
#: their depth.
PLANTS, TREES, DEPTH = 45_000, 20, 4
#: Precision that a kind's threshold must reach on the held-out half of the documents.
PRECISION = 0.95
FEATURES = ("kind", "digits", "letters", "size", "seps", "groups", "luhn", "octets", "dots", "tld", "left", "right", "hint", "repeated", "colons", "upper", "hex", "secret", "assigned", "prefix", "marks")
_BLOCK = 512


def matches(text: Column, pattern: str) -> Column:
    """start, end and value of each match of pattern, leftmost first and without overlap."""
    p = F.lit(pattern)

    def placed(found: Column) -> Column:
        size = F.transform(found["m"], lambda m, i: F.length(m) + F.length(F.get(found["g"], i)))
        blocks = lambda s: F.transform(
            F.sequence(F.lit(0), F.floor((F.size(s) - 1) / _BLOCK).cast("int")),
            lambda b: F.aggregate(F.slice(s, 1, b * _BLOCK), F.lit(0), lambda x, y: x + y),
        )

        def at(s: Column) -> Column:
            return bind(
                blocks(s),
                lambda before: F.transform(
                    found["m"],
                    lambda m, i: bind(
                        F.get(before, F.floor(i / _BLOCK).cast("int"))
                        + F.aggregate(F.slice(s, i - i % _BLOCK + 1, i % _BLOCK), F.lit(0), lambda x, y: x + y)
                        + F.length(F.get(found["g"], i)),
                        lambda start: record(start=start, end=start + F.length(m), value=m),
                    ),
                ),
            )

        return F.when(F.size(found["m"]) == 0, F.array().cast("array<struct<start:int,end:int,value:string>>")).otherwise(bind(size, at))

    return bind(record(m=F.regexp_extract_all(text, p, F.lit(0)), g=F.split(text, pattern, -1)), placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of value pass the Luhn check."""
    figures = F.transform(F.split(F.reverse(_digits(value)), ""), lambda c: F.coalesce(c.try_cast("int"), F.lit(0)))
    weighed = F.transform(figures, lambda d, i: F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(weighed, F.lit(0), lambda a, b: a + b) % 10 == 0


def octets(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255))


def base_spans(text: Column) -> Column:
    """The base spans of a text: kind (its place in KINDS), start, end; in order of kind, then start."""
    n = lambda v: F.length(_digits(v))
    sound = {
        "email": lambda v: F.lit(True),
        "ip": octets,
        "card": lambda v: (n(v) >= 14) & (n(v) <= 19) & luhn(v),
        "phone": lambda v: (n(v) >= 10) & (n(v) <= 15),
    }
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    needs = {"email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike("[0-9]"), "phone": text.contains("+")}

    def of(k: int, kind: str) -> Column:
        kept = F.filter(matches(text, BASE[kind]), lambda x: sound[kind](x["value"]))
        return F.transform(kept, lambda x: record(kind=F.lit(k), start=x["start"], end=x["end"]))

    return F.concat(*[F.when(needs[kind], of(k, kind)).otherwise(none) for k, kind in enumerate(KINDS)])


def candidates(text: Column) -> Column:
    """The spans that the wide patterns propose, with their features."""
    count = lambda v, cls: F.length(v) - F.length(F.regexp_replace(v, cls, ""))

    def described(k: int):
        def of(x: Column) -> Column:
            v = x["value"]
            before = F.substring(text, F.greatest(x["start"] - NEAR + 1, F.lit(1)), F.least(F.lit(NEAR), x["start"]))
            after = F.substring(text, x["end"] + 1, F.lit(1))
            flag = lambda c: c.cast("double")
            features = {
                "kind": F.lit(float(k)),
                "digits": count(v, "[0-9]"),
                "letters": count(v, "[A-Za-z]"),
                "size": F.length(v),
                "seps": count(v, r"[\x20().-]"),
                "groups": F.size(F.regexp_extract_all(v, F.lit("[0-9]+"), F.lit(0))),
                "luhn": flag(luhn(v)),
                "octets": flag(octets(v)),
                "dots": count(v, r"\."),
                "tld": flag(v.rlike(r"[.)\] ][A-Za-z]{2,10}$")),
                "left": flag(before.rlike("[A-Za-z0-9=]$")),
                "right": flag(after.rlike("^[A-Za-z0-9]")),
                "hint": flag(before.rlike(HINTS)),
                "repeated": flag(v.rlike(r"([0-9A-Za-z])\1{4}")),
                "colons": count(v, ":"),
                "upper": count(v, "[A-Z]"),
                "hex": flag(v.rlike("^[0-9a-f]+$")),
                "secret": flag(before.rlike(SECRET_HINTS)),
                "assigned": flag(before.rlike("[=:]\\x20?[\"']?$")),
                "prefix": flag(v.rlike(KEY_PREFIX)),
                "marks": count(v, r"[\[\](){}@]"),
            }
            return record(kind=F.lit(k), start=x["start"], end=x["end"], x=F.array(*[features[f].cast("double") for f in FEATURES]))

        return of

    none = F.array().cast("array<struct<kind:int,start:int,end:int,x:array<double>>>")
    needs = {"email": text.contains("@") | text.rlike(r"[(\[]at[)\]]"), "ip": text.rlike("[0-9A-Fa-f][.:][0-9A-Fa-f]"), "card": text.rlike("[0-9]"), "phone": text.rlike("[0-9]"), "secret": text.rlike("[0-9]")}
    return F.concat(*[F.when(needs[kind], F.transform(matches(text, WIDE[kind]), described(k))).otherwise(none) for k, kind in enumerate(ALL_KINDS)])


def _meets(spans: Column, c: Column) -> Column:
    return F.exists(spans, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))


def planted(salt: Column, share: int | None = None) -> Column:
    """Spans to plant, made of hashed figures and letters: kind, whether it is one, what leads in to it, and its text; all
    forms, or so many from a place on that the salt sets (others are not made)."""
    figures = lambda k, n: F.substring(F.translate(F.sha2(F.concat_ws("-", salt, F.lit(f"d{k}")), 256), "abcdef", "274859"), 1, n)
    letters = lambda k, n: F.substring(F.translate(F.sha2(F.concat_ws("-", salt, F.lit(f"w{k}")), 256), "0123456789", "ghiklmnoprst"), 1, n)
    hexes = lambda k, n: F.substring(F.sha2(F.concat_ws("-", salt, F.lit(f"h{k}")), 256), 1, n)
    token = lambda k, n: F.upper(F.translate(hexes(k, n), "0189", "QXKW"))
    of = lambda *x: F.concat(*[F.lit(y) if isinstance(y, str) else y for y in x])
    octet = lambda k: ((figures(k, 3).cast("int") % 255) + 1).cast("string")

    def card(k: int, sep: str, wrong: int = 0) -> Column:
        head = of("4", figures(k, 14))
        check = F.filter(F.array(*[F.lit(str(c)) for c in range(10)]), lambda c: luhn(F.concat(head, c)))[0]
        whole = of(head, ((check.cast("int") + wrong) % 10).cast("string"))
        return F.concat_ws(sep, *[F.substring(whole, i, 4) for i in (1, 5, 9, 13)])

    rows = [
        ("email", 1, "", of(letters(1, 6), " [at] ", letters(2, 7), " [dot] com")), ("email", 1, "mail ", of(letters(3, 5), "(at)", letters(4, 6), "(dot)org")), ("email", 1, "contact: ", of(letters(5, 8), " @ ", letters(6, 6), ".net")), ("email", 1, "", of(letters(7, 4), figures(1, 2), "[at]", letters(8, 9), "[dot]de")),
        ("email", 0, "", of(letters(9, 5), " @ ", figures(2, 2))), ("email", 0, "met ", of(letters(10, 6), " [at] ", letters(11, 4))), ("email", 0, "", of(figures(3, 1), " @ ", figures(4, 3))),
        ("ip", 1, "", of(octet(5), "[.]", octet(6), "[.]", octet(7), "[.]", octet(8))), ("ip", 1, "host ", of("fe80:", hexes(1, 4), ":", hexes(2, 4), ":", hexes(3, 4), ":", hexes(4, 4), ":", hexes(5, 4), ":", hexes(6, 4), ":", hexes(7, 4))), ("ip", 1, "login from ", of("20", hexes(8, 2), ":", hexes(9, 4), ":", hexes(10, 3), ":", hexes(11, 4), ":", hexes(12, 4), ":", hexes(13, 4), ":", hexes(14, 4), ":", hexes(15, 4))),
        ("ip", 0, "version ", of(figures(9, 1), ".", figures(10, 1), ".", figures(11, 2), ".9", figures(12, 3))), ("ip", 0, "at ", of("1", figures(13, 1), ":", figures(14, 2), ":", figures(15, 2), ":", figures(16, 2))), ("ip", 0, "section ", of("9", figures(17, 2), ".", figures(18, 1), ".", figures(19, 1), ".", figures(20, 1))),
        ("card", 1, "", card(21, ".")), ("card", 1, "card ", card(22, "/")), ("card", 1, "pay with ", card(23, ".")),
        ("card", 0, "order ", card(24, ".", 3)), ("card", 0, "", card(25, "/", 5)), ("card", 0, "item ", figures(26, 12)), ("card", 0, "card ", card(27, ".", 7)),
        ("phone", 1, "", of("(", figures(28, 3), ") ", figures(29, 3), "-", figures(30, 4))), ("phone", 1, "call ", of(figures(31, 3), ".", figures(32, 3), ".", figures(33, 4))), ("phone", 1, "phone ", of("00", figures(34, 2), " ", figures(35, 4), " ", figures(36, 4))), ("phone", 1, "tel. ", of(figures(37, 3), "-", figures(38, 3), "-", figures(39, 4))),
        ("phone", 0, "", of("201", figures(40, 1), "-202", figures(41, 1))), ("phone", 0, "ISBN ", of("978-", figures(42, 1), "-", figures(43, 2), "-", figures(44, 6), "-", figures(45, 1))), ("phone", 0, "no. ", figures(46, 9)), ("phone", 0, "", of(figures(47, 2), " ", figures(48, 3), " ", figures(49, 3))), ("phone", 0, "", figures(50, 16)), ("phone", 0, "", of("202", figures(51, 1), "-0", figures(52, 1), "-1", figures(53, 1))),
        ("secret", 1, "password=", hexes(16, 18)), ("secret", 1, "token = \"", hexes(17, 40)), ("secret", 1, "api_key: ", of(letters(12, 5), hexes(18, 20))), ("secret", 1, "", of("AKIA", token(19, 16))), ("secret", 1, "", of("ghp_", letters(13, 18), hexes(20, 18))), ("secret", 1, "secret: ", of(letters(14, 8), figures(54, 8))), ("secret", 1, "pwd=", of(letters(15, 7), figures(55, 6))),
        ("secret", 0, "commit ", hexes(21, 40)), ("secret", 0, "", of(letters(16, 9), figures(56, 4))), ("secret", 0, "file ", of(letters(17, 6), "-", letters(18, 6), "-", figures(57, 4))), ("secret", 0, "", of(hexes(22, 8), "-", hexes(23, 4), "-", hexes(24, 4), "-", hexes(25, 12))), ("secret", 0, "order ", of(token(26, 4), "-", figures(58, 8))), ("secret", 0, "", figures(59, 14)), ("secret", 0, "see ", of(letters(19, 5), "/", letters(20, 6), "/", figures(60, 4))),
    ]
    spans = [record(kind=F.lit(ALL_KINDS.index(kind)), good=F.lit(good), lead=F.lit(lead), value=value) for kind, good, lead, value in rows]
    if share is None or share >= len(spans):
        return F.array(*spans)
    return F.array_compact(F.array(*[F.when(F.pmod(i - F.xxhash64(salt) % len(spans), F.lit(len(spans))) < share, x) for i, x in enumerate(spans)]))


class Split:
    def __init__(self, feature: int, limit: float, left, right):
        self.feature, self.limit, self.left, self.right = feature, limit, left, right


def parsed_tree(text: str):
    """The splits and predictions of a tree of Spark ML, from its description."""
    lines = iter([x.strip() for x in text.splitlines()[1:] if x.strip()])

    def node():
        line = next(lines)
        if line.startswith("Predict:"):
            return float(line.split()[1])
        _, _, feature, _, limit = line.replace(")", "").split()
        left = node()
        next(lines)  # Else
        return Split(int(feature), float(limit), left, node())

    return node()


class SpanModel:
    """Boosted trees as a column expression, with a threshold per kind."""

    def __init__(self, trees: list[tuple[float, object]], thresholds: list[float]):
        self.trees, self.thresholds = trees, thresholds

    def score(self, x: Column) -> Column:
        def grown(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            return F.when(F.get(x, F.lit(node.feature)) <= node.limit, grown(node.left)).otherwise(grown(node.right))

        margin = reduce(lambda a, b: a + b, [F.lit(weight) * grown(root) for weight, root in self.trees])
        return 1 / (1 + F.exp(-2 * margin))

    def picks(self, c: Column) -> Column:
        limit = F.get(F.array(*[F.lit(t) for t in self.thresholds]), c["kind"])
        return self.score(c["x"]) >= limit


def labelled_candidates(docs: DataFrame, plants: int) -> DataFrame:
    """held (whether for calibration), kind, x (features), label and n (how many are equal) of candidates around planted
    spans, and of all texts' own ones that meet no base span (of secrets, planted ones only: nothing tells which of a text's
    own are some). Each document gets the same number of planted spans, one at least, so that there are so many or more
    (fewer where a table is too small for it with all forms in each document)."""
    drawn = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    share = -(-plants // max(1, docs.count()))
    held = (F.xxhash64("doc_id", F.lit(1)) % 2 == 0).alias("held")
    rows = drawn.select(held, F.substring("text", 1, 60).alias("a"), F.substring("text", 61, 60).alias("z"), F.explode(planted(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), share)).alias("p"))
    start = F.length("a") + 1 + F.length("p.lead")
    rows = rows.select("held", "p", start.alias("start"), (start + F.length("p.value")).alias("end"), F.concat("a", F.lit(" "), "p.lead", "p.value", F.when(F.col("p.lead").endswith('"'), F.lit('"')).otherwise(F.lit("")), F.lit(" "), "z").alias("text"))
    rows = rows.select("held", "p", "start", "end", base_spans(F.col("text")).alias("base"), F.explode(candidates(F.col("text"))).alias("c")).filter(~_meets(F.col("base"), F.col("c")) & (F.col("c.start") < F.col("end")) & (F.col("start") < F.col("c.end")))
    same = F.col("c.kind") == F.col("p.kind")
    whole = (F.col("c.start") <= F.col("start") + 1) & (F.col("c.end") >= F.col("end") - 1)
    rows = rows.filter(~same | whole | (F.col("p.good") == 0)).select("held", F.col("c.kind").alias("kind"), F.col("c.x").alias("x"), (same & (F.col("p.good") == 1)).cast("double").alias("label"))
    own = drawn.select(held, base_spans(F.col("text")).alias("base"), F.explode(candidates(F.col("text"))).alias("c")).filter(~_meets(F.col("base"), F.col("c")) & (F.col("c.kind") < len(KINDS)))
    every = rows.unionByName(own.select("held", F.col("c.kind").alias("kind"), F.col("c.x").alias("x"), F.lit(0.0).alias("label")))
    return every.groupBy("held", "kind", "x", "label").agg(F.count("*").alias("n"))


def fit_spans(docs: DataFrame, plants: int = PLANTS, precision: float = PRECISION) -> SpanModel | None:
    """Boosted trees on labelled candidates from all documents; None where there are none."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    rows = written(labelled_candidates(docs, plants), "spans")
    if rows.filter("not held").select("label").distinct().count() < 2:
        return None
    train = rows.filter("not held").select("label", F.col("n").cast("double").alias("n"), array_to_vector("x").alias("features")).repartition(2)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, maxBins=32, minInstancesPerNode=5, weightCol="n").fit(train)
    trees = [(float(w), parsed_tree(t.toDebugString)) for w, t in zip(model.treeWeights, model.trees, strict=True)]
    grown = SpanModel(trees, [2.0] * len(ALL_KINDS))
    # the lowest score (in hundredths) from which the held-out candidates of a kind are right often enough
    steps = rows.filter("held").groupBy("kind", F.floor(grown.score(F.col("x")) * 100).alias("step")).agg(F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("n")).collect()
    for k in range(len(ALL_KINDS)):
        good = n = 0
        for s in sorted((s for s in steps if s.kind == k), key=lambda s: -s.step):
            good, n = good + s.good, n + s.n
            if n and s.step >= 50 and good >= precision * n:
                grown.thresholds[k] = s.step / 100
    return grown


def pii_spans(docs: DataFrame, model: SpanModel | None) -> DataFrame:
    """doc_id with base and spans: arrays of (kind, start, end) by start, then kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    ordered = lambda a: F.array_sort(F.transform(a, lambda s: record(start=s["start"], kind=s["kind"], end=s["end"])))
    d = docs.select("doc_id", text.alias("__text")).select("doc_id", "__text", base_spans(F.col("__text")).alias("__base"))
    if model is None:
        return d.select("doc_id", ordered(F.col("__base")).alias("base"), ordered(F.col("__base")).alias("spans"))
    more = F.filter(candidates(F.col("__text")), lambda c: ~_meets(F.col("__base"), c) & model.picks(c))
    added = F.transform(more, lambda c: record(kind=c["kind"], start=c["start"], end=c["end"]))
    return d.select("doc_id", ordered(F.col("__base")).alias("base"), ordered(F.array_distinct(F.concat(F.col("__base"), added))).alias("spans"))


def joined(spans: Column) -> Column:
    kind = lambda k: F.get(F.array(*[F.lit(x) for x in ALL_KINDS]), k)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s["kind"]), s["start"], s["end"])), ",")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    d = pii_spans(docs, fit_spans(docs))
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    counts = [number(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return d.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))
