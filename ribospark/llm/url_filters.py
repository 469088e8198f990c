"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a regular expression over ``host + path`` with literal tokens that must stand whole in every
url it can match. The index files each rule under the one of its tokens that the corpus holds least
often (ties: the longer token, then the smaller string). A url's tokens fetch candidate rules, and only
those run their regular expression.

Policy rules (a host with its subdomains and a path prefix) and pattern rules share the index. The
longest fitting policy rule decides; without one, any fitting pattern rule blocks; otherwise the url is
allowed.

Edge cases: a null url or one without ``://`` has empty host and path, fits no rule and is allowed;
repeated rows are judged one by one; extra columns pass through untouched; an empty table gives an
empty result. Rules travel to the executors in chunks of at most MAX_RULES, one pass each, so the
closure that is sent has a bound however long the list is.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules in one closure; longer lists are applied chunk by chunk.
MAX_RULES = 50_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = re.compile(r"[^./\-_:@]+")


@dataclass(frozen=True)
class Rule:
    """regex runs on host + path; tokens are the literals that any match holds whole."""

    name: str
    regex: str
    tokens: tuple[str, ...]
    verdict: str
    policy: bool


def policy_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for host and all its subdomains whose path starts with path ("" or "/...").

    The last path segment may go on in the url, so it is a whole token only if path ends with a
    separator.
    """
    closed = path[: len(path.rstrip("".join(set(path) - set("./-_:@"))))]
    tokens = tuple(dict.fromkeys(TOKEN.findall(host) + TOKEN.findall(closed)))
    return Rule(host + path, rf"\A(?:[^/]*\.)?{re.escape(host)}(?=/|\Z){re.escape(path)}", tokens, verdict, True)


def word_rule(word: str) -> Rule:
    """Blocks urls whose host has word as a whole token."""
    return Rule(word, rf"\A(?:[^/]*[.\-_:@])?{re.escape(word)}(?=[.\-_:@/]|\Z)", (word,), "block", False)


#: The contract's policy rules, and host words that name spam and adult farms.
POLICY = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
BLOCK_WORDS = ("spam", "adult", "porn", "xxx", "casino", "viagra", "malware", "phishing", "warez")


def default_rules() -> list[Rule]:
    return [policy_rule(*r) for r in POLICY] + [word_rule(w) for w in BLOCK_WORDS]


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def token_counts(urls: DataFrame, host: Column, path: Column, tokens: Sequence[str]) -> dict[str, int]:
    """How many urls hold each of tokens; the result has at most len(tokens) rows."""
    found = urls.select(F.explode(F.array_distinct(F.split(F.concat(host, path), r"[./\-_:@]+"))).alias("t"))
    return {r["t"]: r["count"] for r in found.where(F.col("t").isin(list(tokens))).groupBy("t").count().collect()}


def build_index(rules: Sequence[Rule], counts: dict[str, int]) -> dict[str, list[int]]:
    """Rule numbers by their rarest token; rules without any token are under ""."""
    index: dict[str, list[int]] = {}
    for n, r in enumerate(rules):
        key = min(r.tokens, key=lambda t: (counts.get(t, 0), -len(t), t), default="")
        index.setdefault(key, []).append(n)
    return index


def _matcher(rules: Sequence[Rule], index: dict[str, list[int]]):
    plain = [(r.regex, r.name, r.verdict, r.policy) for r in rules]

    @F.pandas_udf("rule string, rule_verdict string, pattern string")
    def match(keys: pd.Series) -> pd.DataFrame:
        compiled: dict[int, re.Pattern] = {}
        always = index.get("", [])
        out = []
        for key in keys:
            best, pattern = None, None
            for n in {n for t in TOKEN.findall(key) for n in index.get(t, ())}.union(always):
                regex, name, verdict, policy = plain[n]
                if n not in compiled:
                    compiled[n] = re.compile(regex)
                if compiled[n].search(key):
                    if policy:
                        best = max(best or (-1, "", ""), (len(name), name, verdict))
                    else:
                        pattern = min(pattern or name, name)
            out.append((best[1] if best else None, best[2] if best else None, pattern))
        return pd.DataFrame(out, columns=["rule", "rule_verdict", "pattern"], dtype=object)

    return match


def judge_urls(pages: DataFrame, rules: Sequence[Rule] | None = None, url: str = "url") -> DataFrame:
    """pages with host, path, rule (fitting policy rule or null), pattern (fitting block pattern or null), verdict.

    Existing columns with those names are replaced.
    """
    rules = list(default_rules() if rules is None else rules)
    out = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    counts = token_counts(
        pages.select(url), host_of(F.col(url)), path_of(F.col(url)), sorted({t for r in rules for t in r.tokens})
    )
    chunks = [rules[i : i + MAX_RULES] for i in range(0, len(rules), MAX_RULES)]
    names = [f"__m{i}" for i in range(len(chunks))]
    key = F.concat("host", "path")
    out = out.withColumns({m: _matcher(c, build_index(c, counts))(key) for m, c in zip(names, chunks, strict=True)})
    none = F.lit(None).cast("string")
    fits = F.sort_array(
        F.filter(
            F.array(*[F.struct(F.length(f"{m}.rule").alias("n"), f"{m}.rule", f"{m}.rule_verdict") for m in names]),
            lambda x: x["rule"].isNotNull(),
        ),
        asc=False,
    ) if names else None
    best = F.get(fits, 0) if names else None
    pattern = F.coalesce(*[F.col(f"{m}.pattern") for m in names]) if names else none
    out = out.withColumns({"rule": best["rule"] if names else none, "__v": best["rule_verdict"] if names else none, "pattern": pattern})
    verdict = F.coalesce("__v", F.when(F.col("pattern").isNotNull(), "block").otherwise("allow"))
    return out.withColumn("verdict", verdict).drop("__v", *names)


def op1_url_filters(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict", "pattern")


ORACLE = f"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(verdict, h, pre) AS (VALUES {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in POLICY)}),
m AS (
  SELECT page_id, host, path, max(struct_pack(n := length(h || pre), rule := h || pre, v := r.verdict)) AS b
  FROM p LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre) AND r.h IS NOT NULL
  GROUP BY page_id, host, path),
w AS (
  SELECT *, CASE WHEN b.rule IS NULL THEN NULL ELSE b.rule END AS rule,
    (SELECT min(x) FROM (SELECT unnest({list(BLOCK_WORDS)}) AS x) WHERE list_contains(regexp_split_to_array(host, '[.:@_-]+'), x)) AS pattern
  FROM m)
SELECT page_id, host, path, rule,
  CASE WHEN rule IS NOT NULL THEN b.v WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, pattern FROM w
"""
