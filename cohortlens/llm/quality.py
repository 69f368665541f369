"""Quality rules with host-level verdicts, in DataFrame functions only.

Each document is tried by row rules. Failures of each rule are added up by host (sums before the shuffle), and each
host's rate is shrunk towards that of all documents with a beta prior fitted to all hosts. A host whose shrunk rate is too
high for one rule or more is rejected, and its documents with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import SPACES, WORD_CLASS, same, stage, words_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
MAX_SYMBOL_PERCENT = 10  # symbols per word
# A host goes when the shrunk share of its documents that fail one of the rules is above this.
MAX_HOST_RATE = 0.5
# A fitted prior weighs as many documents as this at most and at least.
PRIOR_WEIGHT = (1.0, 1000.0)


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` (with a column text) and the columns n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    carried = [c for c in docs.columns]
    text = F.coalesce("text", F.lit(""))
    bare = F.translate(text, SPACES, "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD_CLASS))
    counted = docs.select(
        "*",
        F.length(bare).cast("bigint").alias("word_chars"),
        (F.length(bare) - F.length(F.translate(bare, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        lines.alias("lines"),
        words_of(text).alias("words"),
    )
    # 64-bit hashes of the windows; equal hashes count as equal windows
    windows = F.when(
        F.size("words") >= WINDOW,
        F.transform(
            F.slice("words", F.lit(1), F.size("words") - (WINDOW - 1)),
            lambda word, i: F.xxhash64(word, F.col("words")[i + 1], F.col("words")[i + 2]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = counted.select(
        *carried,
        "word_chars",
        "n_symbols",
        F.size("words").cast("bigint").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        windows.alias("hashes"),
    )
    # windows sorted by hash, each with its place; most texts repeat none and skip the sort
    repeats = F.size("hashes") > F.size(F.array_distinct("hashes"))
    placed = F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    sorted_windows = hashed.withColumn("placed", F.when(repeats, F.array_sort(placed)))
    again = F.filter(
        "placed",
        lambda x, i: ((i > 0) & (x["h"] == F.get("placed", i - 1)["h"]))
        | (F.get("placed", i + 1)["h"].isNotNull() & (x["h"] == F.get("placed", i + 1)["h"])),
    )
    starts = sorted_windows.withColumn("starts", F.array_sort(F.transform(again, lambda x: x["at"])))
    gaps = F.transform(
        "starts", lambda at, i: F.least(F.coalesce(F.get("starts", i + 1) - at, F.lit(WINDOW)), F.lit(WINDOW))
    )
    covered = F.aggregate(gaps, F.lit(0).cast("bigint"), lambda total, gap: total + gap)
    return starts.select(
        *carried, "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(covered, F.lit(0).cast("bigint")).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def rule_failures() -> dict[str, Column]:
    """The rules that are counted by host."""
    return {
        "too_short": F.col("n_words") < MIN_WORDS,
        "repetitive": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("n_words"),
    }


def prior_weight(hosts: int, docs: int, squares: float, failed: int, spread: float) -> float:
    """alpha + beta of a rule's prior, from sums over all hosts: hosts, docs, docs ** 2, failed and failed ** 2 / docs.

    Rates of hosts differ by chance alone, most of all where hosts are small. What they differ beyond that, weighted by
    documents, is the correlation within hosts, and 1 / correlation - 1 the weight, within PRIOR_WEIGHT. Where it cannot
    be told (one document in each host, one host, a rule that all or none fail) or is none, the weight is the upper end.
    """
    least, most = PRIOR_WEIGHT
    mean = failed / docs if docs else 0.0
    beyond = docs - hosts - squares / docs + 1 if docs else 0.0
    if beyond <= 0 or not 0 < mean < 1:
        return most
    by_chance = hosts - 1
    correlation = ((spread - docs * mean * mean) / (mean * (1 - mean)) - by_chance) / beyond
    return min(max(1 / correlation - 1, least), most) if correlation > 0 else most


def host_rates(rows: DataFrame) -> DataFrame:
    """Per host: docs, failures by rule, and shrunk_rate, the greatest of the rules' rates shrunk under their priors.

    The priors come from one row of sums over all hosts.
    """
    rules = rule_failures()
    hosts = rows.groupBy("host").agg(
        F.count(F.lit(1)).alias("docs"), *[F.count_if(rule).alias(name) for name, rule in rules.items()]
    )
    hosts = stage(hosts, "hosts")
    docs = F.col("docs")
    sums = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum(docs).alias("docs"),
        F.sum(docs.cast("double") * docs).alias("squares"),
        *[F.sum(name).alias(name) for name in rules],
        *[F.sum(F.col(name).cast("double") * F.col(name) / docs).alias(f"{name}_spread") for name in rules],
    ).first()
    shrunk = []
    for name in rules:
        all_docs, failed = sums["docs"] or 0, sums[name] or 0
        weight = prior_weight(sums["hosts"], all_docs, sums["squares"] or 0.0, failed, sums[f"{name}_spread"] or 0.0)
        mean = failed / all_docs if all_docs else 0.0
        shrunk.append((F.col(name) + mean * weight) / (docs + weight))
    return hosts.withColumn("shrunk_rate", F.greatest(*shrunk))


def judged(rows: DataFrame) -> DataFrame:
    """``rows`` (text, host and whatever is carried) without the text, with the measures, base_failed and kept.

    Texts are measured once. What is carried is not shuffled by host unless the rejected hosts are too many for the
    session's broadcast threshold.
    """
    rows = stage(measured(rows).drop("text").withColumn("base_failed", base_failed()), "measured")
    rejected = stage(
        host_rates(rows).where(F.col("shrunk_rate") > MAX_HOST_RATE).select(F.col("host").alias("bad_host")), "rejected"
    )
    bad = rejected.withColumn("bad", F.lit(True))
    return rows.join(bad, same(F.col("host"), F.col("bad_host")), "left").withColumn(
        "kept", ~F.col("base_failed") & F.col("bad").isNull()
    )


def quality_verdicts(docs: DataFrame, host: str = "source") -> DataFrame:
    """A row for each row of docs: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    A document is kept if it passes the base rules and its host's shrunk rates are within MAX_HOST_RATE for every rule.
    A null or empty text has no words and fails. Null hosts are one host. No rows give no rows.
    """
    return judged(docs.select("doc_id", "text", F.col(host).alias("host"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def passing_documents(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows of docs that pass, columns as given."""
    rows = docs.select(F.struct("*").alias("row"), "text", F.col(host).alias("host"))
    return judged(rows).where("kept").select("row.*")
