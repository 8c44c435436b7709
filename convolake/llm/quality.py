"""Operator 6: quality rules with verdicts by host.

Rules look at one document each; a host (the document's source) gets a failure rate that is shrunk towards the rate of
all hosts by a beta prior fitted to the hosts (method of moments, weighted by documents and less the sampling noise).
Documents that fail a soft rule by far (over 1.5 times its limit), or several of them, are rejected; those that fail one
by little are judged by their host: rejected where its shrunk rate is above that of all hosts, forgiven elsewhere. A host
nearly all of whose documents fail is rejected as a whole.
All of it is DataFrame expressions: no Python runs on the executors.

Defined results: a null or empty text has no words and fails the base rule; a null source counts as a host of its own,
together with the empty source; repeated rows count once each; an empty table gives an empty result; further columns of
the input are ignored by quality_signals() and carried by quality_filter().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convolake.llm.common import SPACE, bind, table, words_of, written

MIN_WORDS = 20
WINDOW = 8
#: Times the rate of all hosts from which a host's documents with a small soft failure go; rate from which all its
#: documents go.
HOST_RATIO = 1.05
HOST_BLOCK = 0.8
#: Bounds of the prior's weight, in documents.
PRIOR_MIN, PRIOR_MAX = 1.0, 10_000.0
#: Hosts up to this number are broadcast; beyond it the verdicts are joined by a shuffle.
BROADCAST_HOSTS = 200_000


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words inside windows (of so many words) that occur twice or more; 64-bit hashes stand for windows."""

    def covered(keyed: Column) -> Column:
        n = F.size(keyed)
        twice = F.transform(
            keyed,
            lambda x, j: F.when(
                ((j > 0) & (F.get(keyed, j - 1)["h"] == x["h"])) | ((j < n - 1) & (F.get(keyed, j + 1)["h"] == x["h"])), x["i"]
            ),
        )
        return bind(
            F.array_sort(F.filter(twice, lambda i: i.isNotNull())),
            lambda at: F.aggregate(
                F.transform(at, lambda i, j: F.when(j < F.size(at) - 1, F.least(F.lit(window), F.get(at, j + 1) - i)).otherwise(window)),
                F.lit(0),
                lambda a, b: a + b,
            ),
        )

    def of_windows(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            bind(F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), covered)
        )

    def of_words(hashed: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), F.size(hashed) - (window - 1)), lambda i: F.xxhash64(F.slice(hashed, i, window)))
        return F.when(F.size(hashed) < window + 1, F.lit(0)).otherwise(bind(windows, of_windows))

    return bind(F.transform(words, lambda w: F.xxhash64(w)), of_words).cast("long")


def quality_signals(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """The counts and rule results of each document, beside the columns named in keep."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(*[F.col(c) for c in keep], text.alias("__text"))
    d = d.select(
        *keep,
        F.length(F.translate("__text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("__text") - F.length(F.translate("__text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        bind(
            F.filter(F.split("__text", "\n"), lambda x: x.rlike(f"[^{SPACE}]")),
            lambda ls: F.struct(F.size(ls).cast("long").alias("n"), (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("dup")),
        ).alias("__lines"),
        bind(words_of(F.col("__text")), lambda ws: F.struct(F.size(ws).cast("long").alias("n"), repeated_words(ws).alias("rep"))).alias("__words"),
    )
    d = d.select(
        *keep,
        F.col("__words.n").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("__lines.dup").alias("n_dup_lines"),
        F.col("__words.rep").alias("n_repeat_words"),
        F.col("__lines.n").alias("n_lines"),
    )
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    soft = (
        (10 * F.col("n_symbols") > F.col("word_chars")).cast("int")
        + (10 * F.col("n_dup_lines") > 3 * F.col("n_lines")).cast("int")
        + ((F.col("word_chars") > 12 * F.col("n_words")) | (2 * F.col("word_chars") < 5 * F.col("n_words"))).cast("int")
    )
    far = (20 * F.col("n_symbols") > 3 * F.col("word_chars")) | (20 * F.col("n_dup_lines") > 9 * F.col("n_lines")) | (F.col("word_chars") > 15 * F.col("n_words")) | (F.col("word_chars") < 2 * F.col("n_words"))
    return d.withColumns({"base_failed": base, "n_soft_failed": soft, "far_failed": far | (soft > 1)})


def host_verdicts(signals: DataFrame) -> DataFrame:
    """One row per host: documents, failures, shrunk failure rate and the two verdicts."""
    failed = F.col("base_failed") | (F.col("n_soft_failed") > 0)
    hosts = signals.groupBy(F.coalesce("source", F.lit("")).alias("host")).agg(F.count("*").alias("n_docs"), F.count_if(failed).alias("n_failed"))
    n, f = F.sum("n_docs"), F.sum("n_failed")
    prior = hosts.agg((f / n).alias("mean"), n.alias("n"), F.count("*").alias("n_hosts"), F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs")).alias("squares"))
    noise = F.col("mean") * (1 - F.col("mean"))
    prior = prior.select("mean", ((F.col("squares") - F.col("n") * F.col("mean") * F.col("mean")) / F.col("n") - noise * F.col("n_hosts") / F.col("n")).alias("var"), noise.alias("noise"))
    weight = F.when(F.col("var") > 0, F.least(F.greatest(F.col("noise") / F.col("var") - 1, F.lit(PRIOR_MIN)), F.lit(PRIOR_MAX))).otherwise(PRIOR_MAX)
    shrunk = (F.col("n_failed") + weight * F.col("mean")) / (F.col("n_docs") + weight)
    # the prior is one row, so this join only appends its numbers to each host
    return (
        hosts.join(F.broadcast(prior))
        .withColumn("host_rate", shrunk)
        .select("host", "n_docs", "n_failed", "host_rate", (F.col("host_rate") > HOST_RATIO * F.col("mean")).alias("host_strict"), (F.col("host_rate") >= HOST_BLOCK).alias("host_blocked"))
    )


def judged(signals: DataFrame, broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """signals (a written table) with host_rate and kept."""
    hosts = written(host_verdicts(signals), "hosts")
    small = hosts.count() <= broadcast_hosts
    right = hosts.select("host", "host_rate", "host_strict", "host_blocked")
    s = signals.withColumn("host", F.coalesce("source", F.lit("")))
    kept = ~F.col("base_failed") & ~F.col("host_blocked") & ~F.col("far_failed") & ~((F.col("n_soft_failed") > 0) & F.col("host_strict"))
    return s.join(F.broadcast(right) if small else right, "host").withColumn("kept", kept)


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, source, counts, rule results, host_rate and kept of each document."""
    return judged(written(quality_signals(docs), "signals"))


def quality_filter(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns.

    Counts are needed before the first verdict, so the documents are written once with their few verdict inputs.
    """
    columns = docs.columns
    held = docs.select(*[F.col(f"`{c}`").alias(f"__in_{i}") for i, c in enumerate(columns)], F.col("text"), F.col("source"))
    signals = quality_signals(held, ("source", *[f"__in_{i}" for i in range(len(columns))])).select(
        "source", "base_failed", "n_soft_failed", "far_failed", *[f"__in_{i}" for i in range(len(columns))]
    )
    out = judged(written(signals, "signals")).filter("kept")
    return out.select(*[F.col(f"__in_{i}").alias(c) for i, c in enumerate(columns)])


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = quality_verdicts(table(spark, sf_dir, "documents"))
    return v.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, host, t,
        list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT doc_id, i, list_aggregate(ws[i:i+7], 'string_agg', ' ') AS k
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM rep, range(8) r(j) GROUP BY doc_id),
s AS (SELECT w.doc_id, host, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN cov USING (doc_id)),
r AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        10 * n_symbols > word_chars OR 10 * n_dup_lines > 3 * n_lines OR word_chars > 12 * n_words OR 2 * word_chars < 5 * n_words AS soft,
        20 * n_symbols > 3 * word_chars OR 20 * n_dup_lines > 9 * n_lines OR word_chars > 15 * n_words OR word_chars < 2 * n_words
          OR CAST(10 * n_symbols > word_chars AS INT) + CAST(10 * n_dup_lines > 3 * n_lines AS INT) + CAST(word_chars > 12 * n_words OR 2 * word_chars < 5 * n_words AS INT) > 1 AS far FROM s),
h AS (SELECT host, count(*) AS n, count(*) FILTER (base_failed OR soft) AS f FROM r GROUP BY host),
p AS (SELECT sum(f) / sum(n) AS m, (sum(f * f / n) - sum(n) * (sum(f) / sum(n)) * (sum(f) / sum(n))) / sum(n) - (sum(f) / sum(n)) * (1 - sum(f) / sum(n)) * count(*) / sum(n) AS v FROM h),
pw AS (SELECT m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 1.0), 10000.0) ELSE 10000.0 END AS wt FROM p),
hr AS (SELECT host, m, (f + wt * m) / (n + wt) AS rate FROM h, pw)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rate < 0.8 AND NOT far AND NOT (soft AND rate > 1.05 * m) AS kept
FROM r JOIN hr USING (host)
"""
