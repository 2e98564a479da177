"""Quality rules kept as a ledger of measurements and failure bits.

Every rule is evaluated once per document; the ledger holds the measurements and
one bit per failed rule. A policy is a versioned set of rules, so changing what is
rejected, or asking what each rule costs, reads the ledger and no text. Within a
row, words, lines and word windows are arrays; rows are never joined, grouped or
exploded, so one scan without a shuffle does it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.llm.common import WORD, documents, let

# Characters counted as symbols, and the base rule's bounds.
SYMBOLS = "#*$%&|<>"
BASE_WORDS, BASE_REPEAT_PERCENT = 50, 50

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
)


@dataclass(frozen=True)
class Rule:
    """A document fails when `fails` holds of its measurements."""

    name: str
    bit: int
    fails: str


# Bits are never given to another rule, so old ledgers stay readable.
RULES = (
    Rule("few_words", 0, f"n_words < {BASE_WORDS}"),
    Rule("repeated_words", 1, f"100 * n_repeat_words > {BASE_REPEAT_PERCENT} * n_words"),
    Rule("symbols", 2, "10 * n_symbols > 3 * n_words"),
    Rule("capitals", 3, "2 * n_upper > word_chars"),
    Rule("short_words", 4, "word_chars < 2 * n_words"),
    Rule("long_words", 5, "word_chars > 20 * n_words"),
    Rule("repeated_lines", 6, "n_lines >= 4 AND 2 * n_dup_lines > n_lines"),
)

BASE = frozenset({"few_words", "repeated_words"})


@dataclass(frozen=True)
class Policy:
    """A named, versioned choice of rules that reject."""

    name: str
    version: int
    rules: frozenset[str]

    def mask(self) -> int:
        known = {rule.name: rule.bit for rule in RULES}
        return sum(1 << known[name] for name in self.rules)


POLICIES = (
    Policy("corpus", 1, BASE),
    Policy("corpus", 2, frozenset(rule.name for rule in RULES)),
)


def measurements(text: Column) -> Column:
    """Struct of `MEASURES`; a null text has no words, lines or characters."""
    body = F.coalesce(text, F.lit(""))

    def measured(words: Column) -> Column:
        count = F.size(words).cast("bigint")
        return let(
            F.filter(F.split(body, "\n"), lambda line: line.rlike(WORD)),
            lambda lines: F.struct(
                count.alias("n_words"),
                F.length(F.translate(body, " \t\n\x0b\x0c\r", "")).cast("bigint").alias(
                    "word_chars"
                ),
                (F.length(body) - F.length(F.translate(body, SYMBOLS, "")))
                .cast("bigint")
                .alias("n_symbols"),
                (F.size(lines) - F.size(F.array_distinct(lines)))
                .cast("bigint")
                .alias("n_dup_lines"),
                _repeat_words(words).cast("bigint").alias("n_repeat_words"),
                F.size(lines).cast("bigint").alias("n_lines"),
                F.length(F.regexp_replace(body, r"[^\p{Lu}]+", "")).cast("bigint").alias("n_upper"),
            ),
        )

    return let(F.regexp_extract_all(body, F.lit(WORD), F.lit(0)), measured)


def _repeat_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more."""
    follow = F.transform(
        words,
        lambda w, i: F.concat(
            w, F.lit(" "), F.get(words, i + 1), F.lit(" "), F.get(words, i + 2)
        ),
    )
    windows = F.slice(follow, 1, F.greatest(F.size(words) - 2, F.lit(0)))
    return let(
        windows,
        lambda all_: F.when(F.size(F.array_distinct(all_)) == F.size(all_), 0).otherwise(
            _covered(all_)
        ),
    )


def _covered(windows: Column) -> Column:
    """Positions under windows that equal another; equal windows are sorted together."""
    placed = F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i")))

    def repeated(ordered: Column) -> Column:
        same = F.transform(
            ordered,
            lambda x, j: F.when(
                (x["w"] == F.get(ordered, j - 1)["w"]) | (x["w"] == F.get(ordered, j + 1)["w"]),
                x["i"],
            ),
        )
        starts = F.filter(same, lambda i: i.isNotNull())
        spread = F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))
        return F.size(F.array_distinct(spread))

    return let(F.sort_array(placed), repeated)


def rule_ledger(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)):
    """Columns `keep`, the measurements, and `failures` with the bit of each failed rule.

    One row per row of `docs`, repeated rows included. A null or empty text fails
    `few_words`; a null measurement cannot occur. An empty table gives an empty ledger.
    Other columns are dropped; columns named like a measurement must not be kept.
    """
    bits = [
        F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("bigint")
        for rule in RULES
    ]
    failures = bits[0]
    for bit in bits[1:]:
        failures = failures.bitwiseOR(bit)
    return (
        docs.select(*keep, measurements(F.col(text)).alias("measured"))
        .select(*keep, "measured.*")
        .withColumn("failures", failures)
    )


def kept_under(policy: Policy) -> Column:
    """Whether a ledger row passes every rule of the policy."""
    return F.col("failures").bitwiseAND(F.lit(policy.mask())) == 0


def ablation(ledger: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """For each policy and rule: rows failing it, rows rejected by it alone, rows rejected.

    The ledger is first counted by its bits, so all policies work on as many rows as
    there are combinations of failed rules. An empty ledger gives counts of zero.
    """
    counted = ledger.groupBy("failures").agg(F.count(F.lit(1)).alias("held"))
    listed = [
        (p.name, p.version, p.mask(), rule.name, 1 << rule.bit)
        for p in policies
        for rule in RULES
        if rule.name in p.rules
    ]
    asked = F.explode(
        F.array(
            *(
                F.struct(
                    *(
                        F.lit(v).alias(k)
                        for k, v in zip(("policy", "version", "mask", "rule", "bit"), row)
                    )
                )
                for row in listed
            )
        )
    )
    zero = ledger.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("failures"), F.lit(0).cast("bigint").alias("held")
    )
    rows = counted.unionByName(zero).select("*", asked.alias("asked"))
    hit = F.col("failures").bitwiseAND(F.col("asked.mask"))
    bit = F.col("asked.bit")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("held")).otherwise(0))

    return rows.groupBy("asked.policy", "asked.version", "asked.rule").agg(
        total(hit.bitwiseAND(bit) != 0).alias("failing"),
        total(hit == bit).alias("rejected_alone"),
        total(hit != 0).alias("rejected"),
    )


def op10_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents, with the verdicts of the base and the current policy."""
    base, current = POLICIES
    return (
        rule_ledger(documents(spark, sf_dir))
        .withColumn("base_failed", ~kept_under(base))
        .withColumn("kept", kept_under(current))
    )


def verdict_sql(table: str = "documents", keep: str = "doc_id") -> str:
    """DuckDB SQL for the ledger, from the same rules as text."""
    failures = " | ".join(
        f"CASE WHEN {rule.fails} THEN {1 << rule.bit} ELSE 0 END::BIGINT" for rule in RULES
    )
    base, current = (policy.mask() for policy in POLICIES)
    symbols = "".join("\\" + c for c in SYMBOLS)
    return f"""
    WITH body AS (
      SELECT row_number() OVER () AS r, *, coalesce(text, '') AS body FROM {table}
    ), split AS (
      SELECT *, regexp_extract_all(body, '{WORD}') AS words,
        list_filter(string_split(body, chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS lines
      FROM body
    ), grams AS (
      SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
      FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM split)
    ), covered AS (
      SELECT r, count(DISTINCT p) AS n FROM (
        SELECT r, unnest([i, i + 1, i + 2]) AS p
        FROM (SELECT *, count(*) OVER (PARTITION BY r, gram) AS seen FROM grams) WHERE seen > 1)
      GROUP BY r
    ), measured AS (
      SELECT s.*, len(words)::BIGINT AS n_words,
        length(regexp_replace(body, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
        length(body) - length(regexp_replace(body, '[{symbols}]', '', 'g')) AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(c.n, 0) AS n_repeat_words, len(lines)::BIGINT AS n_lines,
        length(regexp_replace(body, '[^\\p{{Lu}}]+', '', 'g')) AS n_upper
      FROM split s LEFT JOIN covered c USING (r)
    ), bits AS (SELECT *, {failures} AS failures FROM measured)
    SELECT {keep}, {', '.join(MEASURES)}, failures,
      failures & {base} <> 0 AS base_failed, failures & {current} = 0 AS kept FROM bits"""


ORACLE = verdict_sql()
