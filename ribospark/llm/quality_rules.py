"""Quality rules: a ledger of failure bits, judged by versioned policies.

Every rule is evaluated once per document. The ledger holds the measurements and one long whose bit b is
set if rule b fails. A policy is a version and the set of its rules: a document is kept if
``fail_bits & mask = 0``. Ablations (what each rule rejects, what it alone rejects, what a policy without
it would keep) come from bitwise aggregates over the ledger, without reading a text again.

Distinct words are counted over the whole text. Up to 200 words, 22 % of them must be distinct; beyond, the
least number grows with the power 2/3 of the length (44 at 200 words, 129 at 1,000, 597 at 10,000), as the
vocabulary of prose grows slower than its length.

Native: DataFrame and SQL functions only. All work on a text stays in its row (arrays of its words,
window hashes sorted in place), so no group meets in a task and nothing is shuffled; memory follows the
longest text.

Edge cases: a null or empty text has no words and fails ``too_few_words``; repeated rows are judged one
by one; extra columns pass through, and columns of the ledger's names are replaced; an empty table gives
an empty ledger.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD

WINDOW = 8


@dataclass(frozen=True)
class QualityRule:
    """fails: SQL over the measurements, true where a document fails; the same text holds in DuckDB."""

    bit: int
    name: str
    fails: str


#: Thresholds are ratios of integers, so that every engine gives the same bits.
RULES: tuple[QualityRule, ...] = (
    QualityRule(0, "too_few_words", "n_words < 20"),
    QualityRule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    QualityRule(2, "symbols", "100 * n_symbols > 20 * n_words"),
    QualityRule(3, "short_words", "word_chars < 2 * n_words"),
    QualityRule(4, "long_words", "word_chars > 16 * n_words"),
    QualityRule(5, "repeated_lines", "n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines"),
    QualityRule(6, "shouting", "100 * n_marks > 20 * n_words"),
    QualityRule(
        7,
        "few_distinct_words",
        "n_words >= 40 AND (n_words <= 200 AND 100 * n_distinct_words < 22 * n_words OR n_words > 200"
        " AND 625 * CAST(n_distinct_words AS DOUBLE) * n_distinct_words * n_distinct_words < 1331 * CAST(n_words AS DOUBLE) * n_words)",
    ),
)
BASE_BITS = 0b11


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    def mask(self, rules: Sequence[QualityRule] = RULES) -> int:
        bits = {r.name: r.bit for r in rules}
        return sum(1 << bits[n] for n in set(self.rules))


POLICIES = {
    "base": Policy("base", ("too_few_words", "repeated_windows")),
    "v1": Policy("v1", tuple(r.name for r in RULES)),
}


def let(value: Column, body) -> Column:
    """body over value, which is computed once per row."""
    return F.get(F.transform(F.array(value), body), 0)


def split_words(text: Column) -> Column:
    """The words of a text; its white space becomes single blanks, on which a plain split is fast."""
    for c in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def _windows(hashes: Column) -> Column:
    """Hashes of all WINDOW-word windows, by doubling: of 2, of 4, of 8 words."""
    out = hashes
    for step in (1, 2, 4):
        out = let(out, _joined(step))
    return out


def _joined(step: int):
    def of(h: Column) -> Column:
        n = F.greatest(F.size(h) - step, F.lit(0))
        return F.zip_with(F.slice(h, 1, n), F.slice(h, step + 1, n), lambda x, y: F.xxhash64(x, y))

    return of


def _repeat_words(hashes: Column) -> Column:
    """Words under windows of WINDOW words that occur twice or more; sorts windows only where two are equal."""

    def covered(s: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(s, a)["h"] == F.get(s, b)["h"], F.lit(False))
        dups = F.filter(s, lambda x, j: same(j, j - 1) | same(j, j + 1))
        at = F.sort_array(F.transform(dups, lambda x: x["i"]))
        zero = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        step = lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last"))
        return F.aggregate(at, zero, step, lambda a: a["n"])

    def of_windows(w: Column) -> Column:
        placed = F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(w)) < F.size(w), let(F.sort_array(placed), covered)).otherwise(0)

    return let(_windows(hashes), of_windows)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the measurements of RULES."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD))
    out = docs.withColumns({"__w": split_words(t), "__l": lines, "__m": F.regexp_extract_all(t, F.lit(r"[#*$%&|<>!]"), F.lit(0))})
    out = out.withColumns({"__h": F.transform("__w", lambda w: F.xxhash64(w)), "__s": F.size(F.array_remove("__m", "!"))})
    return out.withColumns(
        {
            "n_words": F.size("__w").cast("long"),
            "word_chars": F.length(F.array_join("__w", "")).cast("long"),
            "n_symbols": F.col("__s").cast("long"),
            "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
            "n_repeat_words": _repeat_words(F.col("__h")).cast("long"),
            "n_lines": F.size("__l").cast("long"),
            "n_marks": (F.size("__m") - F.col("__s")).cast("long"),
            "n_distinct_words": F.size(F.array_distinct("__h")).cast("long"),
        }
    ).drop("__w", "__l", "__m", "__h", "__s")


def fail_bits(rules: Iterable[QualityRule] = RULES) -> Column:
    return sum(
        (F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in rules),
        F.lit(0).cast("long"),
    )


def ledger(docs: DataFrame, rules: Sequence[QualityRule] = RULES, text: str = "text") -> DataFrame:
    """docs with measurements and fail_bits."""
    return measure(docs, text).withColumn("fail_bits", fail_bits(rules))


def apply_policy(led: DataFrame, policy: Policy, rules: Sequence[QualityRule] = RULES) -> DataFrame:
    """led with policy (its version) and kept."""
    kept = F.col("fail_bits").bitwiseAND(F.lit(policy.mask(rules)).cast("long")) == 0
    return led.withColumns({"policy": F.lit(policy.version), "kept": kept})


def ablations(led: DataFrame, policy: Policy, rules: Sequence[QualityRule] = RULES) -> DataFrame:
    """Per rule of the policy: documents it fails, those it alone fails, and those kept without it.

    One pass: rows are first counted by their distinct bit pattern under the policy (at most 2^rules).
    """
    mask = policy.mask(rules)
    seen = F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long"))
    by = led.groupBy(seen.alias("b")).agg(F.count("*").alias("n"))
    cases = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in rules if r.name in policy.rules])
    x = by.withColumn("r", F.explode(cases))
    bit, b = F.col("r.bit"), F.col("b")
    return x.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(b.bitwiseAND(bit) != 0, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(b == bit, F.col("n")).otherwise(0)).alias("failed_alone"),
        F.sum(F.when((b == 0) | (b == bit), F.col("n")).otherwise(0)).alias("kept_without"),
    )


def quality_ledger(docs: DataFrame, policy: str = "v1") -> DataFrame:
    led = ledger(docs)
    led = led.withColumn("base_failed", F.col("fail_bits").bitwiseAND(F.lit(BASE_BITS).cast("long")) != 0)
    return apply_policy(led, POLICIES[policy])


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits")
    return quality_ledger(docs).select(*cols)


def measure_sql(source: str) -> str:
    """DuckDB: doc_id and the measurements of the documents in source."""
    return f"""
SELECT doc_id, text, len(w)::BIGINT AS n_words, (length(t) - len(regexp_extract_all(t, '[\\x20\\x09-\\x0D]')))::BIGINT AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
  coalesce((SELECT count(DISTINCT k + o) FROM
     (SELECT unnest(g.p) AS k FROM (SELECT list(i) AS p FROM
        (SELECT i, array_to_string(w[i : i + 7], ' ') AS s FROM (SELECT unnest(range(1, len(w) - 6)) AS i)) GROUP BY s HAVING count(*) > 1) g),
     (SELECT unnest(range(0, 8)) AS o)), 0)::BIGINT AS n_repeat_words,
  len(l)::BIGINT AS n_lines, len(regexp_extract_all(t, '!'))::BIGINT AS n_marks,
  len(list_distinct(w))::BIGINT AS n_distinct_words
FROM (SELECT *, regexp_extract_all(t, '{WORD}') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l
      FROM (SELECT doc_id, text, coalesce(text, '') AS t FROM {source}))"""


def ledger_sql(source: str, policy: str = "v1") -> str:
    bits = " + ".join(f"(CASE WHEN {r.fails} THEN {1 << r.bit} ELSE 0 END)::BIGINT" for r in RULES)
    return f"""
SELECT *, (fail_bits & {BASE_BITS}) <> 0 AS base_failed, (fail_bits & {POLICIES[policy].mask()}) = 0 AS kept
FROM (SELECT *, {bits} AS fail_bits FROM ({measure_sql(source)}))"""


ORACLE = f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, fail_bits
FROM ({ledger_sql("documents")})"""
