"""URL filter: pattern rules indexed by their rarest literal token.

Every rule is a regular expression over ``host + path`` with a list of tokens it cannot match
without. The index keeps a rule under one of them, the one that fewest URLs hold. A URL's tokens
fetch its candidate rules, and only those run their expressions. A rule without a mandatory token
is a candidate everywhere.

Rules are configuration: a Python sequence that the caller holds anyway, turned into literals of
the plan. URLs never leave the JVM and are not shuffled; the only other job counts how many URLs
hold each rule token (one small row per token).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, put_back, set_aside, whole_text


@dataclass(frozen=True)
class Rule:
    """``regex`` is searched in ``host + path``; of the rules that match, the highest rank wins."""

    name: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]
    rank: int
    base: bool = True


def site_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for a host, its subdomains and a path prefix; the longer text wins."""
    folders = path.split("/")
    whole = [f"p:{x}" for x in folders[:-1] if x]  # the last piece may go on in the URL
    labels = [f"h:{x}" for x in host.split(".") if x]
    regex = rf"^(?:[^/]*\.)?\Q{host}\E\Q{path}\E"
    return Rule(host + path, verdict, regex, tuple(labels + whole), len(host + path))


def host_pattern(name: str, verdict: str, regex: str, tokens: Sequence[str] = ()) -> Rule:
    """An extra pattern of the method; it speaks only where no site rule does."""
    return Rule(name, verdict, regex, tuple(tokens), 0, base=False)


# The site rules.
SITE_RULES = (
    site_rule("allow", "com", "/"),
    site_rule("block", "example.com", "/en/"),
    site_rule("allow", "www.example.com", "/en/"),
    site_rule("block", "net", "/es/"),
    site_rule("block", "net", "/fr/"),
)

# Hosts that advertise themselves as junk, wherever no site rule fits.
JUNK_RULES = (
    host_pattern("junk:spam-farm", "block", r"^(?:[^/]*\.)?spam-farm\.", ["h:spam-farm"]),
    host_pattern("junk:cheap-pills", "block", r"^(?:[^/]*\.)?cheap-pills\.", ["h:cheap-pills"]),
    host_pattern("junk:adult", "block", r"^(?:[^/]*[.-])?(?:porn|xxx|casino)[.-]"),
)


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(whole_text(url), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(rest)


def path_of(url: Column) -> Column:
    return F.regexp_extract(whole_text(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(host: Column, path: Column) -> Column:
    """Host labels and path pieces, told apart by a prefix."""
    labels = F.transform(F.split(host, r"\.", -1), lambda x: F.concat(F.lit("h:"), x))
    pieces = F.transform(F.split(path, "/", -1), lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.concat(labels, pieces))


def token_counts(urls: DataFrame, tokens: Sequence[str]) -> dict[str, int]:
    """How many rows hold each of the given tokens; ``urls`` has a column ``_tokens``."""
    wanted = F.array(*[F.lit(t) for t in sorted(set(tokens))])
    held = urls.select(F.explode(F.array_intersect("_tokens", wanted)).alias("token"))
    return {r["token"]: r["count"] for r in held.groupBy("token").count().collect()}


def index_rules(rules: Sequence[Rule], counts: dict[str, int]) -> dict[str | None, list[Rule]]:
    """Rules by their rarest token; ``None`` holds the rules that have none."""
    index: dict[str | None, list[Rule]] = {}
    for rule in rules:
        key = min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default=None)
        index.setdefault(key, []).append(rule)
    return index


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = SITE_RULES + JUNK_RULES,
    url_column: str = "url",
    default: str = "allow",
) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict`` and ``pattern`` to every row.

    ``rule`` names the winning site rule, ``pattern`` the winning extra pattern where no site rule
    fits. A null URL, or one without ``://``, has an empty host and path and gets the default
    unless a pattern fits. Rows are independent: repeated rows repeat their result, an empty table
    gives an empty table, and columns with the names of the results are replaced.
    """
    pages, names = set_aside(pages)
    url_column = names.get(url_column, url_column)
    parsed = pages.withColumns(
        {"host": host_of(F.col(url_column)), "path": path_of(F.col(url_column))}
    ).withColumn("_tokens", tokens_of(F.col("host"), F.col("path")))
    rules = list(rules)
    counts = token_counts(parsed, [t for r in rules for t in r.tokens])
    index = index_rules(rules, counts)

    def literal(found: Sequence[Rule]) -> Column:
        cells = [
            F.struct(
                F.lit(r.base).alias("base"),
                F.lit(r.rank).alias("rank"),
                F.lit(r.name).alias("name"),
                F.lit(r.verdict).alias("verdict"),
                F.lit(r.regex).alias("regex"),
            )
            for r in found
        ]
        kind = "array<struct<base:boolean,rank:int,name:string,verdict:string,regex:string>>"
        return F.array(*cells).cast(kind)

    everywhere = literal(index.pop(None, []))
    keyed = sorted(index.items())
    target = F.concat("host", "path")
    if keyed:
        lookup = F.create_map(*[x for k, v in keyed for x in (F.lit(k), literal(v))])
        known = F.array(*[F.lit(k) for k, _ in keyed])
        hits = F.array_intersect(F.col("_tokens"), known)
        fetched = F.flatten(F.transform(hits, lambda t: F.element_at(lookup, t)))
        candidates = F.concat(fetched, everywhere)
    else:
        candidates = everywhere
    best = F.array_max(F.filter(candidates, lambda c: F.regexp_like(target, c["regex"])))
    judged = parsed.withColumn("_best", best).withColumns(
        {
            "rule": F.when(F.col("_best.base"), F.col("_best.name")),
            "verdict": F.coalesce(F.col("_best.verdict"), F.lit(default)),
            "pattern": F.when(~F.col("_best.base"), F.col("_best.name")),
        }
    )
    return put_back(judged.drop("_tokens", "_best"), names)
