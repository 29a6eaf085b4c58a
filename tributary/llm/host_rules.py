"""Quality rules judged by host.

Base measures come from each document alone, and rules on them fail or pass it.
Failures are summed by host and rule; every host's failure rate is shrunk
towards the rate of all hosts with a beta prior fitted to the hosts themselves
(moments of the beta-binomial), a rate beyond what the prior makes likely
rejects the host, and the verdict is joined back to its documents.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import WORD, map_rows, written

#: Symbol characters of the contract.
SYMBOLS = re.compile(r"[#*$%&|<>]")
_WORD = re.compile(WORD)
DDL = ("doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
       "n_repeat_words long, n_lines long, base_failed boolean")
ARROW = pa.schema([("doc_id", pa.int64()), ("host", pa.string()), *[(c, pa.int64()) for c in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")], ("base_failed", pa.bool_())])
#: By rule, when a document fails it: by itself; more than a symbol in ten words; three of ten lines said
#: before; words of less than 2 or more than 15 letters in the mean.
RULES = {"base": "base_failed", "symbols": "10 * n_symbols > n_words", "lines": "10 * n_dup_lines > 3 * n_lines",
         "lengths": "word_chars < 2 * n_words or word_chars > 15 * n_words"}
#: Standard deviations of the prior above its mean that a host's rate may reach, and the bounds of that limit.
DEVIATIONS, LEAST_LIMIT, MOST_LIMIT = 3.0, 0.5, 0.8


def repeated_words(words: list[str]) -> int:
    """Words that stand in a 3-word window found twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    total, upto = 0, 0
    for i, w in enumerate(windows):
        if seen[w] > 1:
            total += i + 3 - max(i, upto)
            upto = i + 3
    return total


def duplicate_lines(text: str) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and all lines with a word."""
    if "\n" not in text:
        return 0, int(_WORD.search(text) is not None)
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    return len(lines) - len(set(lines)), len(lines)


def base_measures(docs: DataFrame, host: str = "source", min_words: int = 50, repeat_percent: int = 50) -> DataFrame:
    """docs (doc_id, text, <host>) -> measures of each document; a null text has no words."""

    def make():
        def one(row):
            text = row[1] or ""
            words = _WORD.findall(text)
            twice, lines = duplicate_lines(text)
            n, rep = len(words), repeated_words(words)
            return (row[0], row[2], n, sum(map(len, words)), len(SYMBOLS.findall(text)), twice, rep, lines,
                    n < min_words or 100 * rep > repeat_percent * n)

        return one

    return map_rows(docs.select("doc_id", "text", F.col(host).cast("string")), make, DDL, ARROW)


def host_rates(base: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """host, rule, n, failed, rate (shrunk), limit. The prior of a rule is
    Beta(m k, (1 - m) k): m is the share of all documents that fail it, k =
    1 / r - 1 with r the correlation inside hosts of a beta-binomial, by
    moments: S = sum n (failed / n - m)^2 is expected to be
    m (1 - m) (r (N - sum n^2 / N) + (1 - r) (hosts - 1)). So hosts weigh by
    their documents, and what sampling alone spreads is taken off. Where hosts
    show no spread beyond that (or are single, or have one document each) k is
    at its largest, one million, and the rate is m.

    The limit is the prior's mean and ``DEVIATIONS`` of its standard deviations,
    m (1 - m) / (k + 1) being its variance, but at least ``LEAST_LIMIT``, so that
    a host of mostly sound documents stays, and at most ``MOST_LIMIT``, so that
    bad hosts do not excuse each other."""
    rules = rules or {"base": RULES["base"]}
    each = F.array(*[F.struct(F.lit(r).alias("rule"), F.coalesce(F.expr(e), F.lit(False)).cast("long").alias("failed")) for r, e in rules.items()])
    hosts = base.filter("host is not null").select("host", F.explode(each).alias("x")).groupBy("host", "x.rule").agg(
        F.count("*").alias("n"), F.sum("x.failed").alias("failed"))
    n, failed = F.col("n").cast("double"), F.col("failed").cast("double")
    sums = hosts.groupBy("rule").agg(F.count("*").alias("hosts"), F.sum("n").alias("total"), F.sum(n * n).alias("squares"),
                                     (F.sum("failed") / F.sum("n")).alias("m"), F.sum(failed * failed / n).alias("raw"))
    spread = F.col("raw") - F.col("total") * F.col("m") * F.col("m")
    free = F.col("hosts") - 1
    room = F.col("total") - F.col("squares") / F.col("total") - free
    even = F.col("m") * (1 - F.col("m"))
    r = F.when((even > 0) & (room > 1e-9 * F.col("total")), (spread / even - free) / room)
    k = F.when(r > 0, F.least(F.lit(1e6), F.greatest(F.lit(1e-6), 1 / r - 1))).otherwise(1e6)
    limit = F.least(F.lit(MOST_LIMIT), F.greatest(F.lit(LEAST_LIMIT), F.col("m") + DEVIATIONS * F.sqrt(even / (F.col("k") + 1))))
    prior = F.broadcast(sums.withColumn("k", k).select("rule", "m", "k", limit.alias("limit")))  # one row for each rule
    return hosts.join(prior, "rule").select(
        "host", "rule", "n", "failed", ((F.col("failed") + F.col("m") * F.col("k")) / (F.col("n") + F.col("k"))).alias("rate"), "limit")


def host_rules(docs: DataFrame, host: str = "source") -> DataFrame:
    """docs (doc_id, text, source) -> doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, host_rate, host_failed.

    ``kept`` is false for a document that fails by itself, else unless its
    host's shrunk failure rate of some rule exceeds that rule's limit (see
    ``RULES``, ``host_rates``); ``host_failed`` names these rules, ``host_rate``
    is the rate of documents that fail by themselves. A document with a null
    host belongs to none and is judged alone (host_rate null, no rules). A null
    text counts as empty and fails. Repeated rows each count and stay; extra
    columns are not read; an empty table gives an empty result.

    The measures are written once; the verdicts, one row for each host, come
    back by a join that Spark broadcasts only if it finds them small.
    """
    base = written(base_measures(docs, host), "hostrules-base")
    verdicts = host_rates(base, RULES).groupBy("host").agg(
        F.max(F.when(F.col("rule") == "base", F.col("rate"))).alias("host_rate"),
        F.array_sort(F.collect_list(F.when(F.col("rate") > F.col("limit"), F.col("rule")))).alias("host_failed"))
    verdicts = written(verdicts, "hostrules-verdicts")
    failed = F.coalesce("host_failed", F.array().cast("array<string>"))
    return base.join(verdicts, "host", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size(failed) == 0)).alias("kept"), "host_rate", failed.alias("host_failed"))
