"""Mix sources to target weights with a multivariate-hypergeometric splitting tree.

Texts are cut into blocks of ``block_words`` words. A source's target is met by whole epochs over
its blocks plus a part of one more. The exact block quotas of all sources are dealt to output shards
by a tree: a multivariate hypergeometric draw splits the vector of quotas in two, then each half
again, until a node is one shard. The blocks that the last epoch leaves out are dealt by a tree of
the same kind, so shard ``k`` owns a pool of its own in every source's permutation, of the blocks
it draws and of its spare ones, and draws its quota there: shards are disjoint, and which blocks are
taken follows from the tree. Inside a shard blocks are shuffled by a keyed hash.

Blocks differ in length, so a quota of blocks is a target of words only on average. The draws of the
shards are therefore taken in turns, first block of each shard first, until the source's words are
met; the last block is taken in part, and if the quotas fall short the shards' spare blocks follow in
the same order. The words come out exact to one word.

Sources are handled as rows: their totals, ranks and targets are DataFrames (only scalars reach
the driver while the excess is reshared). The tree first deals groups of sources, of which there are
``GROUPS`` however many the sources are, and then, a task per group, the sources of each: the joint
draw is the same. Blocks are narrow rows of an id, a number and a hash; texts are not shuffled. A hot
source is spread over buckets of its permutation, and of its order of turns.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ids import allocate_ids
from ..session import stage
from .common import put_back, set_aside, whole_text

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
BLOCK_WORDS = 256
SHARDS = 16
GROUPS = 1024
_TURNS = 4096  # buckets of a source's order of turns
_HEX = 3  # digits of the permutation key that name a bucket: 4096 per source
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_EPOCHS
) -> DataFrame:
    """(source, source_size, weight, target) from (source, size): water filling below a cap.

    Sources are ranked by code point, null last; weights repeat by rank. Targets share the sum of
    all sizes by weight; one above ``most`` times its source's size stops there and the rest is
    shared again, until none is above.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ranked = totals.withColumn("_missing", F.col("source").isNull())
    placed = allocate_ids(ranked, "_rank", ["_missing", "source"], start=-1).drop("_missing")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    named = stage(
        placed.withColumn("weight", F.element_at(cycle, (F.col("_rank") % len(weights) + 1).cast("int")))
        .withColumn("_cap", (most * F.col("source_size")).cast("double"))
        .drop("_rank"),
        "sources",
    )
    total = named.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("t")).first()["t"]
    level, capped = None, -1
    while True:
        # the level is what one unit of weight gets; a source is capped once its cap is below
        full = F.lit(False) if level is None else F.col("weight") * level > F.col("_cap")
        state = named.agg(
            F.count(F.when(full, 1)).alias("n"),
            F.coalesce(F.sum(F.when(full, F.col("_cap"))), F.lit(0.0)).alias("caps"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if state["n"] == capped or not state["open"]:
            break
        capped, level = state["n"], (total - state["caps"]) / state["open"]
    target = F.least(F.col("weight") * F.lit(float(level or 0.0)), F.col("_cap"))
    return named.withColumn("target", target).drop("_cap")


def even_sizes(total: int, shards: int) -> np.ndarray:
    """Shard sizes that sum up to ``total`` and differ by one at most."""
    cuts = [total * k // shards for k in range(shards + 1)]
    return np.diff(np.array(cuts, dtype=np.int64))


def split_quotas(quotas: np.ndarray, sizes: np.ndarray, seed: Sequence[int]) -> np.ndarray:
    """(shards, quotas): what each shard of the given size gets of every quota."""
    rng = np.random.default_rng(list(seed))

    def split(held: np.ndarray, wanted: np.ndarray) -> list[np.ndarray]:
        if len(wanted) == 1:
            return [held]
        half = len(wanted) // 2
        drawn = _draw(rng, held, int(wanted[:half].sum()))
        return split(drawn, wanted[:half]) + split(held - drawn, wanted[half:])

    return np.stack(split(np.asarray(quotas, dtype=np.int64), np.asarray(sizes, dtype=np.int64)))


def _draw(rng: np.random.Generator, colors: np.ndarray, size: int) -> np.ndarray:
    """A multivariate hypergeometric draw, colour by colour."""
    drawn = np.zeros_like(colors)
    rest = int(colors.sum())
    for i, own in enumerate(colors.tolist()):
        rest -= own
        if size and own:
            drawn[i] = got = _hypergeometric(rng, own, rest, size)
            size -= got
    return drawn


def _hypergeometric(rng: np.random.Generator, own: int, rest: int, size: int) -> int:
    """How many of ``own`` are among ``size`` drawn from ``own + rest``, by inversion.

    The weights of the outcomes come from their ratios, outwards from the mode; those further away
    than 12 deviations weigh less than rounding. The work grows with the deviation, hence with the
    root of the numbers, which may be of any magnitude.
    """
    least, most = max(0, size - rest), min(own, size)
    total = own + rest
    if least == most:
        return least
    share = own / total
    deviation = (size * share * (1 - share) * (total - size) / max(1, total - 1)) ** 0.5
    mode = (size + 1) * (own + 1) // (total + 2)
    reach = int(12 * deviation) + 40
    low, high = max(least, mode - reach), min(most, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log((own - k) * (size - k)) - np.log((k + 1) * (rest - size + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    sums = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(sums, rng.random() * sums[-1], side="right").clip(0, high - low))


def mix_blocks(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST_EPOCHS,
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
    seed: int = 7,
) -> tuple[DataFrame, DataFrame]:
    """The rows' sizes and targets, and the drawn blocks.

    First: one row per input row (``_row``: id, hash of the text and a number among equal rows;
    ``doc_id``, ``source``, ``size``, ``source_size``, ``target``). Second: (``_row``, ``block``,
    ``epoch``, ``words``, ``shard``, ``place``): which words of a block a shard takes, and the key
    that orders it there.

    Null and empty texts have size zero and are never drawn. Rows that are equal in id, source and
    text are told apart by a number; which of them gets it does not change the result. Reruns with
    one seed agree. An empty table gives empty tables; other columns are ignored.
    """
    text = whole_text(text_column)
    narrow = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(source_column).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.md5(text).alias("_hash"),
    )
    # equal rows become counts, and counts rows again: no task has to sort the copies of a row
    equal = narrow.groupBy("doc_id", "source", "size", "_hash").count()
    numbered = equal.withColumn("_number", F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))))
    named = numbered.withColumn("_row", _row_name("doc_id", "source", "_hash", "_number"))
    rows = stage(named.select("_row", "doc_id", "source", "size"), "mix-rows")
    targets = stage(source_targets(rows, weights, most), "targets").withColumn(
        "_words", F.round("target").cast("long")
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("_words") / F.col("source_size")))
    targets = targets.withColumn("_epochs", F.coalesce(whole, F.lit(0)).cast("int"))
    rest = F.col("_words") - F.col("_epochs") * F.col("source_size")
    targets = targets.withColumn("_rest", rest)
    known = rows.join(targets, rows["source"].eqNullSafe(targets["source"])).select(
        rows["_row"], "doc_id", rows["source"], "size", "source_size", "target", "_epochs", "_rest"
    )

    number = F.explode(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / block_words).cast("int")))
    blocks = (
        known.where("size > 0")
        .select("_row", "source", "size", "_epochs", "_rest", number.alias("block"))
        .withColumn("words", F.least(F.lit(block_words), F.col("size") - F.col("block") * block_words))
        .withColumn("_key", F.md5(F.concat_ws("/", F.lit(str(seed)), "_row", F.col("block").cast("string"))))
        .withColumn("_bucket", F.substring("_key", 1, _HEX))
    )
    blocks = stage(blocks, "mix-blocks")
    # a source's permutation is its keys in order: totals per bucket, then places inside a bucket
    before = _sums_before(blocks, "_bucket", F.count(F.lit(1)))
    inside = Window.partitionBy("source", "_bucket").orderBy("_key", "_row", "block")
    ranked = _beside(blocks, before, "_bucket").withColumn(
        "_rank", F.col("_before") + F.row_number().over(inside) - 1
    )
    counts = blocks.groupBy("source").agg(
        F.max("_epochs").cast("long").alias("epochs"),
        F.max("_rest").alias("rest"),
        F.sum("words").alias("words"),
        F.count(F.lit(1)).alias("blocks"),
    )
    dealt = stage(_deal(counts, shards, seed), "dealt").withColumnRenamed("source", "_source")
    owner = F.size(F.filter("pool_ends", lambda e: e <= F.col("_rank")))
    held = ranked.join(dealt, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_shard", owner)
    begin = F.when(F.col("_shard") > 0, F.element_at("pool_ends", F.col("_shard"))).otherwise(0)
    turn = held.withColumn("_turn", F.col("_rank") - begin).withColumn(
        "_spare", F.col("_turn") >= F.element_at("quotas", F.col("_shard") + 1)
    )
    step = F.floor(F.element_at(F.array_sort("pools"), -1) / _TURNS) + 1
    turn = stage(
        turn.select(
            *["_row", "source", "block", "words", "_key", "_epochs", "_rest", "_rank", "_shard", "_turn", "_spare"],
            F.col("blocks").alias("_blocks"),
            "full_ends",
            F.struct("_spare", F.floor(F.col("_turn") / step).alias("turns")).alias("_slot"),
        ),
        "turns",
    )
    earlier = _sums_before(turn, "_slot", F.sum("words"))
    order = Window.partitionBy("source", "_slot").orderBy("_turn", "_shard")
    begun = F.col("_before") + F.sum("words").over(order) - F.col("words")
    part = F.greatest(F.lit(0), F.least(F.col("words"), F.col("_rest") - begun))
    drawn = _beside(turn, earlier, "_slot").withColumn("_part", part).where("_epochs > 0 OR _part > 0")
    epoch = F.explode(F.sequence(F.lit(0), F.col("_epochs"))).alias("epoch")
    whole_epoch = F.col("epoch") < F.col("_epochs")
    copies = drawn.select("*", epoch).withColumn(
        "_taken", F.when(whole_epoch, F.col("words")).otherwise(F.col("_part"))
    )
    at = F.col("epoch") * F.col("_blocks") + F.col("_rank")
    in_epoch = F.size(F.filter("full_ends", lambda e: e <= at))
    out = copies.where("_taken > 0").select(
        "_row",
        "block",
        "epoch",
        F.col("_taken").alias("words"),
        F.when(whole_epoch, in_epoch).otherwise(F.col("_shard")).alias("shard"),
        F.md5(F.concat_ws("/", "_key", F.col("epoch").cast("string"))).alias("place"),
    )
    return known.drop("_epochs", "_rest"), out


def _sums_before(rows: DataFrame, bucket: str, total: Column) -> DataFrame:
    """(_source, _b, _before): the total of a source's earlier buckets, for each of its buckets."""
    summed = rows.groupBy("source", bucket).agg(total.alias("_total"))
    earlier = Window.partitionBy("source").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return summed.select(
        F.col("source").alias("_s"),
        F.col(bucket).alias("_b"),
        F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"),
    )


def _beside(rows: DataFrame, sums: DataFrame, bucket: str) -> DataFrame:
    met = F.col("source").eqNullSafe(F.col("_s")) & (F.col(bucket) == F.col("_b"))
    return rows.join(sums, met).drop("_s", "_b")


def _deal(counts: DataFrame, shards: int, seed: int) -> DataFrame:
    """The tree: (source, blocks, full_ends, quotas, pools, pool_ends) from totals per source.

    ``full_ends``: where each shard's stretch of the whole epochs ends. ``quotas``: the blocks each
    shard draws in the last epoch; ``pools`` and ``pool_ends``: the blocks it owns there.
    """
    # enough blocks for the words that the last epoch has to give, on average
    share = F.col("rest") / F.col("words")
    more = F.least(F.col("blocks"), F.ceil(share * F.col("blocks")).cast("long"))
    planned = counts.select(
        "source",
        "blocks",
        (F.col("epochs") * F.col("blocks")).alias("full"),
        more.alias("more"),
        (F.col("blocks") - more).alias("spare"),
        F.pmod(F.xxhash64(F.coalesce(F.col("source").cast("string"), F.lit("")), F.col("source").isNull()), F.lit(GROUPS)).alias("group"),
    )
    totals = planned.groupBy("group").agg(
        F.sum(F.col("full") + F.col("more")).alias("wanted"), F.sum("spare").alias("spare")
    )

    def groups(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("group", ignore_index=True)
        parts = {
            name: split_quotas(rows[name].to_numpy(), even_sizes(int(rows[name].sum()), shards), [seed, kind])
            for kind, name in enumerate(("wanted", "spare"))
        }
        return pd.DataFrame(
            {"group": rows["group"], "wanted": list(parts["wanted"].T), "spares": list(parts["spare"].T)}
        )

    def sources(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("source", na_position="last", ignore_index=True)
        group, first = int(rows["group"][0]), rows.iloc[0]
        both = np.concatenate([rows["full"].to_numpy(), rows["more"].to_numpy()])
        parts = split_quotas(both, np.asarray(first["wanted"]), [seed, 2, group])
        spare = split_quotas(rows["spare"].to_numpy(), np.asarray(first["spares"]), [seed, 3, group])
        full, more = parts[:, : len(rows)], parts[:, len(rows) :]
        pools = more + spare
        columns = {"full_ends": full.cumsum(axis=0), "quotas": more, "pools": pools, "pool_ends": pools.cumsum(axis=0)}
        return pd.DataFrame(
            {"source": rows["source"], "blocks": rows["blocks"], **{c: list(v.T) for c, v in columns.items()}}
        )

    split = totals.groupBy().applyInPandas(groups, "group long, wanted array<long>, spares array<long>")
    arrays = ", ".join(f"{c} array<long>" for c in ("full_ends", "quotas", "pools", "pool_ends"))
    text = planned.withColumn("source", F.col("source").cast("string"))
    return text.join(split, "group").groupBy("group").applyInPandas(sources, f"source string, blocks long, {arrays}")


def mix_rows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows, all columns, with ``size``, ``source_size``, ``target`` and ``taken`` added.

    Rows that are equal in id, source and text are numbered, and each gets the words of its number.
    The texts are shuffled once, to meet what is taken of them.
    """
    docs, names = set_aside(docs)
    id_column, text_column = names.get(id_column, id_column), names.get(text_column, text_column)
    if "source_column" in options:
        options["source_column"] = names.get(options["source_column"], options["source_column"])
    mixed = mix(docs, id_column=id_column, text_column=text_column, **options)
    added = ("size", "source_size", "target", "taken")
    source = options.get("source_column", "source")
    narrow = stage(mixed.select("_row", *added), "mixed")
    base = docs.drop(*added).withColumn("_hash", F.md5(whole_text(text_column)))
    same = [id_column, source, "_hash"]
    repeated = base.groupBy(*same).count().where("count > 1").limit(1).count()
    base = _numbered(base, same) if repeated else base.withColumn("_number", F.lit(1))
    named = base.withColumn("_row", _row_name(id_column, source, "_hash", "_number"))
    return put_back(named.join(narrow, "_row").drop("_row", "_hash", "_number"), names)


def _numbered(rows: DataFrame, same: list[str]) -> DataFrame:
    """Number the rows that are equal in ``same`` from 1, each part of the input by itself.

    So copies that are a third of all rows are many tasks' work; only the parts' counts meet.
    """
    rows = stage(rows.withColumn("_part", F.spark_partition_id()), "copies")
    earlier = Window.partitionBy(*same).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*same, "_part").agg(F.count(F.lit(1)).alias("_n"))
    begin = counts.select(
        *[F.col(c).alias(f"_same{i}") for i, c in enumerate(same)],
        F.col("_part").alias("_of"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_begin"),
    )
    own = F.row_number().over(Window.partitionBy(*same, "_part").orderBy("_part"))
    match = [F.col(c).eqNullSafe(F.col(f"_same{i}")) for i, c in enumerate(same)]
    numbered = rows.withColumn("_own", own).join(begin, [*match, F.col("_part") == F.col("_of")])
    return numbered.select(*[c for c in rows.columns if c != "_part"], (F.col("_own") + F.col("_begin")).alias("_number"))


def _row_name(id_column: str, source_column: str, text_hash: str, number: str) -> Column:
    return F.concat_ws(
        ":",
        F.coalesce(F.col(id_column).cast("string"), F.lit("-")),
        F.when(F.col(source_column).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.md5(source_column))),
        text_hash,
        F.col(number).cast("string"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """(_row, doc_id, source, size, source_size, target, taken) of every row; see ``mix_blocks``."""
    rows, blocks = mix_blocks(docs, **options)
    words = blocks.groupBy("_row").agg(F.sum("words").alias("_taken"))
    taken = F.coalesce("_taken", F.lit(0)).cast("long").alias("taken")
    return rows.join(words, "_row", "left").select("*", taken).drop("_taken")


def fill_targets(sizes: dict[str | None, int], weights: Sequence[float] = WEIGHTS, most: int = MOST_EPOCHS):
    """The targets of a few sources, by hand; for tests."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    share = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, open_, out = sum(sizes.values()), set(order), {}
    while open_:
        left = total - sum(out.values())
        weight = sum(share[s] for s in open_)
        above = [s for s in open_ if left * share[s] / weight > most * sizes[s]]
        if not above:
            out |= {s: left * share[s] / weight for s in open_}
            break
        for s in above:
            out[s] = float(most * sizes[s])
            open_.remove(s)
    return out
