"""Secret scan through a trigram index.

Each rule's expression gives a Boolean trigram query. The index is column-wise: a row's posting
bitmaps say which of the rules' trigrams its text holds. A rule's postings are intersected as bit
masks, and only rows that pass run its expression. Rules without mandatory trigrams scan fully.

Everything is built from SQL functions over one row at a time; nothing is shuffled. Match places
come from the pieces between the matches, summed in chunks, so a text with very many matches costs
about its length.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, put_back, set_aside, whole_text
from .trigrams import ANY, trigram_query

_BITS = 62
_CHUNK = 256


@dataclass(frozen=True)
class SecretRule:
    """``group`` and ``least``: a match counts only if this group has so many characters."""

    kind: str
    regex: str
    group: int = 0
    least: int = 0
    base: bool = True


# The base kinds, in the order in which ties are listed. Greedy runs that are too
# short for their kind are left out by the counted form, which takes the same longer runs.
BASE_RULES = (
    SecretRule(
        "assign",
        r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])"""
        r"""|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))"""
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    SecretRule("access", r"AKIA[A-Z0-9]{16,}"),
    SecretRule("hex", r"[0-9a-f]{24,}"),
)

# Published formats of well-known credentials, added by the method. A first part of a
# jwt without the other two is taken whole and left out, so its many possible starts cost one pass.
MORE_RULES = (
    SecretRule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}", base=False),
    SecretRule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", base=False),
    SecretRule("stripe", r"sk_(?:live|test)_[A-Za-z0-9]{16,}", base=False),
    SecretRule("google", r"AIza[A-Za-z0-9_-]{35,}", base=False),
    SecretRule(
        "jwt",
        r"eyJ[A-Za-z0-9_-]{8,}((?:\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})?)",
        group=1,
        least=1,
        base=False,
    ),
    SecretRule("keyblock", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
)


def _postings(lowered: Column, trigrams: Sequence[str]) -> list[Column]:
    """Bitmaps over the trigrams, so many in each long."""
    maps = []
    for at in range(0, len(trigrams), _BITS):
        bits = [
            F.when(F.contains(lowered, F.lit(t)), F.lit(1 << i).cast("long")).otherwise(
                F.lit(0).cast("long")
            )
            for i, t in enumerate(trigrams[at : at + _BITS])
        ]
        total = bits[0]
        for bit in bits[1:]:
            total = total.bitwiseOR(bit)
        maps.append(total)
    return maps


def _passes(query, trigrams: dict[str, int]) -> Column | None:
    """The intersection of the postings; None where every row has to be scanned."""
    if frozenset() in query or query == ANY:
        return None
    either = F.lit(False)
    for alternative in sorted(map(sorted, query)):
        masks: dict[int, int] = {}
        for t in alternative:
            at, bit = divmod(trigrams[t], _BITS)
            masks[at] = masks.get(at, 0) | 1 << bit
        every = F.lit(True)
        for at, mask in sorted(masks.items()):
            wanted = F.lit(mask).cast("long")
            every = every & (F.col(f"_post{at}").bitwiseAND(wanted) == wanted)
        either = either | every
    return either


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x)


def _spans(rule: SecretRule, order: int, text: Column) -> Column:
    """array<struct<start, order, end, kind>> of a rule's matches, in code points."""
    pattern = F.lit(rule.regex)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, rule.regex, -1)
    # gap and match alternate; both arrays come from the same scan order
    cells = F.arrays_zip(
        F.transform(matches, lambda m: F.length(m).cast("long")).alias("match"),
        F.transform(F.slice(gaps, 1, F.size(matches)), lambda g: F.length(g).cast("long")).alias("gap"),
        F.transform(
            F.regexp_extract_all(text, pattern, F.lit(rule.group)),
            lambda g: F.length(g) >= F.lit(rule.least),
        ).alias("kept"),
    )

    def placed(holder: Column) -> Column:
        """From struct<cells, steps>: the running sum is taken chunk by chunk."""
        steps = F.transform(holder["cells"], lambda c: c["match"] + c["gap"])
        chunks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _CHUNK).cast("int")),
            lambda k: _total(F.slice(steps, k * _CHUNK + 1, F.lit(_CHUNK))),
        )
        return F.transform(
            F.transform(
                F.sequence(F.lit(0), F.size(chunks) - 1),
                lambda k: F.struct(k.alias("chunk"), _total(F.slice(chunks, F.lit(1), k)).alias("before")),
            ),
            lambda b: F.aggregate(
                F.slice(holder["cells"], b["chunk"] * _CHUNK + 1, F.lit(_CHUNK)),
                F.struct(
                    b["before"].alias("at"),
                    F.array().cast("array<struct<start:bigint,order:int,end:bigint,kind:string>>").alias("out"),
                ),
                lambda acc, c: F.struct(
                    (acc["at"] + c["gap"] + c["match"]).alias("at"),
                    F.when(
                        c["kept"],
                        F.concat(
                            acc["out"],
                            F.array(
                                F.struct(
                                    (acc["at"] + c["gap"]).alias("start"),
                                    F.lit(order).alias("order"),
                                    (acc["at"] + c["gap"] + c["match"]).alias("end"),
                                    F.lit(rule.kind).alias("kind"),
                                )
                            ),
                        ),
                    )
                    .otherwise(acc["out"])
                    .alias("out"),
                ),
                lambda acc: acc["out"],
            ),
        )

    held = F.transform(F.array(F.struct(cells.alias("cells"))), placed)
    return F.when(F.regexp_like(text, pattern), F.flatten(F.flatten(held)))


def scan_secrets(
    docs: DataFrame,
    rules: Sequence[SecretRule] = BASE_RULES + MORE_RULES,
    text_column: str = "text",
) -> DataFrame:
    """Add ``secrets``: array<struct<start, order, end, kind>>, by start, then order of the rules.

    Places are code points of the whole text, end exclusive; a null text is empty. A row stands for
    itself: repeated rows repeat their result, an empty table gives an empty table, other columns
    are kept, and one named ``secrets`` is replaced.
    """
    docs, names = set_aside(docs)
    text_column = names.get(text_column, text_column)
    queries = [trigram_query(r.regex) for r in rules]
    wanted = sorted({t for q in queries for alternative in q for t in alternative})
    places = {t: i for i, t in enumerate(wanted)}
    text = whole_text(text_column)
    # the lower-cased text is read once per trigram, so it is a column of its own
    rows = docs.withColumn("_text", text).withColumn("_low", ascii_lower(F.col("_text")))
    posted = rows.withColumns({f"_post{i}": p for i, p in enumerate(_postings(F.col("_low"), wanted))})
    kind = "array<struct<start:bigint,order:int,end:bigint,kind:string>>"
    parts = {}
    for order, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        found = _spans(rule, order, F.col("_text"))
        gate = _passes(query, places)
        empty = F.array().cast(kind)
        parts[f"_rule{order}"] = F.coalesce(found if gate is None else F.when(gate, found), empty)
    scanned = posted.withColumns(parts)
    spans = F.array_sort(F.concat(*[F.col(c) for c in parts]))
    helpers = ["_text", "_low", *parts, *(c for c in posted.columns if c.startswith("_post"))]
    return put_back(scanned.withColumn("secrets", spans).drop(*helpers), names)


def listed(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    cells = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(cells, ",")
