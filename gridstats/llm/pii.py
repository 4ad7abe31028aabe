"""Personal data, and the terms that give it away.

Patterns find the protected entities (mail and network addresses, card and phone numbers). Which
other terms reveal an entity is estimated from the corpus: a term discloses an entity if seeing the
term makes the entity so likely that ``share`` of the entity's information is gone,
``pmi(term, entity) >= share * information(entity)``. Co-occurrence is counted over distinct
contexts (copies of a passage are one), and a term needs ``support`` of them; a term's other uses
count once per distinct words around them. Terms over the
threshold become spans as well; sanitising generalises entities to their kind and removes terms.

1. One pass finds entities and the words around them (``around`` on either side).
2. Pairs of term and entity with enough support, from partial counts.
3. One pass counts these terms over the whole corpus. A bitmap of fixed size (``_SLOTS`` longs,
   however many terms there are) keeps other words out of that shuffle; what passes by accident is
   dropped by the join that follows. Every occurrence counts here, so what passes is settled.
4. Terms that do not pass may owe their count to copies. One more pass counts their distinct
   contexts; of a term far too frequent only a slice of the hashes is counted, which bounds the
   count from below. Terms whose slice does not settle them are counted whole.
5. The pairs' contexts come back to their texts by a join on narrow keys.

Nothing but bitmaps of fixed size and totals reaches the driver; a frequent entity or term is summed
in its map tasks first.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import put_back, set_aside, whole_text

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
SHARE = 0.6
SUPPORT = 3
AROUND = 6
_SLOTS = 1 << 14  # of 64 bits
_LEVELS = 40  # a slice halves the hashes so often at most
_NONE = 255
_HELD = 1 << 16  # contexts a task holds at once, beside those of one text
_SLICE = 8  # contexts looked at for each that a passing term may have

# The base patterns. Possessive runs and the looks behind only forbid starts that
# cannot match, so long runs of one class cost their length.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)?+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W\d_]{3,40}")
_DIGITS = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and (not part or int(part) <= 255)


def entities(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) in order; leftmost and non-overlapping per kind, no retries."""
    found = []
    if "@" in text:
        for m in _EMAIL.finditer(text):
            if m[1]:
                found.append((m.start(), 0, m.end(), m[0].lower()))
    if not _DIGITS.search(text):
        return found
    for m in _IP.finditer(text):
        if all(_small(p) for p in m[0].split(".")):
            found.append((m.start(), 1, m.end(), m[0]))
    for m in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end(), digits))
    if "+" in text:
        for m in _PHONE.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if 9 <= len(digits) <= 15:
                found.append((m.start(), 3, m.end(), digits))
    return sorted(found)


def contexts(text: str, found: Sequence[tuple[int, int, int, str]], around: int) -> Iterator[tuple]:
    """(entity, context hash, [(term, start, end)]) of every entity, words of other spans left out."""
    reach = around * 41
    for start, kind, end, value in found:
        left = [m for m in _WORD.finditer(text, max(0, start - reach), start)][-around:]
        right = [m for m in _WORD.finditer(text, end, min(len(text), end + reach))][:around]
        words = [
            (m[0].lower(), m.start(), m.end())
            for m in left + right
            if not any(a < m.end() and m.start() < b for a, _, b, _ in found)
        ]
        mark = xxhash.xxh64_intdigest("\0".join(w for w, _, _ in words)) >> 1
        yield f"{KINDS[kind]}:{value}", mark, words


def _slot(term: str) -> tuple[int, int]:
    at = xxhash.xxh64_intdigest(term) & (64 * _SLOTS - 1)
    return at >> 6, at & 63


def _scan(docs: DataFrame, id_column: str, text_column: str, around: int) -> DataFrame:
    """Per row: its key, base spans, and the words around each entity."""
    schema = (
        "id string, hash string, spans array<struct<start:long,kind:int,end:long>>,"
        " words array<struct<entity:string,mark:long,term:string,start:long,end:long>>"
    )
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    word = pa.list_(
        pa.struct(
            [
                ("entity", pa.string()),
                ("mark", pa.int64()),
                ("term", pa.string()),
                ("start", pa.int64()),
                ("end", pa.int64()),
            ]
        )
    )

    def scan(batches):
        for batch in batches:
            spans, words = [], []
            for text in batch["text"].to_pylist():
                found = entities(text)
                spans.append([{"start": a, "kind": k, "end": b} for a, k, b, _ in found])
                words.append(
                    [
                        {"entity": e, "mark": c, "term": t, "start": a, "end": b}
                        for e, c, near in contexts(text, found, around)
                        for t, a, b in near
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["hash"], pa.array(spans, span), pa.array(words, word)],
                ["id", "hash", "spans", "words"],
            )

    text = whole_text(text_column)
    plain = docs.select(F.col(id_column).cast("string").alias("id"), F.md5(text).alias("hash"), text.alias("text"))
    return plain.mapInArrow(scan, schema)


def _bitmap(terms: DataFrame) -> dict[int, int]:
    """Bits of the terms; at most ``_SLOTS`` rows whatever the terms."""

    def mark(batches):
        for batch in batches:
            held: Counter = Counter()
            for term in batch["term"].to_pylist():
                slot, bit = _slot(term)
                held[slot] |= 1 << bit
            rows = [(s, b - (1 << 64) if b >> 63 else b) for s, b in held.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([s for s, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.int64())],
                ["slot", "bits"],
            )

    merged = terms.mapInArrow(mark, "slot int, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    return {r["slot"]: r["bits"] & ((1 << 64) - 1) for r in merged.toLocalIterator()}


def _term_counts(docs: DataFrame, text_column: str, bitmap: dict[int, int]) -> DataFrame:
    """(term, n) of every word whose bit is set, summed per batch; ``term`` null has all words."""

    def count(batches):
        for batch in batches:
            seen: Counter = Counter()
            for text in batch["text"].to_pylist():
                seen.update(_WORD.findall(text))
            total, kept = sum(seen.values()), Counter()
            for word, n in seen.items():
                term = word.lower()
                slot, bit = _slot(term)
                if bitmap.get(slot, 0) >> bit & 1:
                    kept[term] += n
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([None, *kept], pa.string()),
                    pa.array([total, *kept.values()], pa.int64()),
                ],
                ["term", "n"],
            )

    counted = docs.select(whole_text(text_column).alias("text")).mapInArrow(count, "term string, n long")
    return counted.groupBy("term").agg(F.sum("n").alias("n"))


def _slices(terms: DataFrame) -> bytes:
    """The least level asked for in each of ``64 * _SLOTS`` places, ``_NONE`` where no term is."""

    def mark(batches):
        for batch in batches:
            held: dict[int, int] = {}
            for term, level in zip(batch["term"].to_pylist(), batch["level"].to_pylist(), strict=True):
                slot, bit = _slot(term)
                at = slot << 6 | bit
                held[at] = min(level, held.get(at, level))
            # a row per 64 slots and level, as bits
            bits: Counter = Counter()
            for at, level in held.items():
                bits[at >> 6, level] |= 1 << (at & 63)
            rows = [(s, v, b - (1 << 64) if b >> 63 else b) for (s, v), b in bits.items()]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["slot", "level", "bits"])

    marked = terms.select("term", "level").mapInArrow(mark, "slot int, level int, bits long")
    out = bytearray([_NONE]) * (64 * _SLOTS)
    for r in marked.groupBy("slot", "level").agg(F.bit_or("bits").alias("bits")).toLocalIterator():
        for bit in range(64):
            if r["bits"] >> bit & 1:
                at = r["slot"] << 6 | bit
                out[at] = min(r["level"], out[at])
    return bytes(out)


def _context_counts(docs: DataFrame, terms: DataFrame, text_column: str, around: int) -> DataFrame:
    """(term, seen): the distinct contexts of each term in its slice (level 0 takes all of them).

    Beside an entity the context is the entity with the words around it, as pairs are counted;
    elsewhere it is the words around the term.
    """
    slices = _slices(terms)

    def rows_of(held):
        rows = list(held)
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int32()))]
        return pa.RecordBatch.from_arrays(columns, ["term", "key", "depth"])

    def count(batches):
        for batch in batches:
            held: set = set()
            levels: dict[str, int] = {}
            for text in batch["text"].to_pylist():
                words = [w.lower() for w in _WORD.findall(text)]
                for w in words:
                    if w not in levels:
                        slot, bit = _slot(w)
                        levels[w] = slices[slot << 6 | bit]
                chosen = [i for i, w in enumerate(words) if levels[w] != _NONE]
                if not chosen:
                    continue
                near: dict[int, list[str]] = {}
                found = entities(text)
                for entity, mark, beside in contexts(text, found, around):
                    for _, start, _ in beside:
                        near.setdefault(start, []).append(f"{entity}\0{mark}")
                starts = [m.start() for m in _WORD.finditer(text)] if near else None
                for i in chosen:
                    beside = near.get(starts[i]) if near else None
                    context = sorted(beside) if beside else words[max(0, i - around) : i + around + 1]
                    key = xxhash.xxh64_intdigest("\0".join(context)) >> 1
                    level = min(_LEVELS, (key & -key).bit_length() - 1) if key else _LEVELS
                    if level >= levels[words[i]]:
                        held.add((words[i], key, level))
                if len(held) > _HELD:
                    yield rows_of(held)
                    held.clear()
            yield rows_of(held)

    found = docs.select(whole_text(text_column).alias("text")).mapInArrow(count, "term string, key long, depth int")
    # at most a row per level and term is left before the join
    by_depth = found.distinct().groupBy("term", "depth").agg(F.count(F.lit(1)).alias("m"))
    inside = F.when(F.col("depth") >= F.col("level"), F.col("m"))
    joined = terms.select("term", "level").join(by_depth, "term", "left")
    return joined.groupBy("term").agg(F.coalesce(F.sum(inside), F.lit(0)).alias("seen"))


def disclosing_pairs(
    docs: DataFrame, marked: DataFrame, text_column: str, share: float, support: int, around: int
) -> DataFrame:
    """(entity, term) where the term gives away the entity."""
    words = marked.select(F.explode("words").alias("w")).select("w.entity", "w.mark", "w.term")
    # distinct contexts first: a passage with thousands of copies is one observation
    once = words.distinct()
    pairs = stage(
        once.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("both")).where(F.col("both") >= support),
        "pairs",
    )
    terms = pairs.select("term").distinct()
    bitmap = _bitmap(terms)
    counts = stage(_term_counts(docs, text_column, bitmap) if bitmap else terms.withColumn("n", F.lit(0).cast("long")), "terms")
    total = counts.where("term IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    units = max(2.0, total / (2 * around))
    per_entity = (
        words.select("entity", "mark").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("alone"))
    )
    chance = F.least(F.lit(1.0), F.col("alone") / F.lit(units))
    joined = pairs.join(per_entity, "entity").join(counts, "term").withColumn("chance", chance).where("chance < 1")
    weighed = stage(joined.select("entity", "term", "both", "n", "chance"), "weighed")

    def told(n: Column) -> Column:
        given = F.least(F.lit(1.0), F.col("both") / F.greatest(n, F.col("both")))
        return F.log2(given / F.col("chance")) >= share * -F.log2("chance")

    # the most contexts a term may have, over its pairs that copies may keep from passing
    most = F.floor(F.max(F.col("both") * F.pow("chance", F.lit(share - 1)))) + 1
    open_ = weighed.where(~told(F.col("n"))).groupBy("term").agg(F.max("n").alias("n"), most.alias("most"))
    excess = F.floor(F.log2(F.greatest(F.lit(1.0), F.col("n") / (_SLICE * F.col("most")))))
    level = F.least(F.lit(_LEVELS), excess).cast("int")
    open_ = stage(open_.select("term", "most", level.alias("level")), "open")
    if open_.isEmpty():
        return weighed.where(told(F.col("n"))).select("entity", "term")
    seen = stage(open_.join(_context_counts(docs, open_, text_column, around), "term"), "seen")
    unsettled = (F.col("level") > 0) & (F.col("seen") <= F.col("most"))
    rest = stage(seen.where(unsettled).select("term", F.lit(0).alias("level")), "rest")
    settled = seen.where(~unsettled).select("term", "seen")
    if not rest.isEmpty():
        settled = settled.union(_context_counts(docs, rest, text_column, around).select("term", "seen"))
    right = weighed.join(settled, "term", "left").where(told(F.coalesce("seen", "n")))
    return right.select("entity", "term")


def find_personal_data(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    share: float = SHARE,
    support: int = SUPPORT,
    around: int = AROUND,
) -> DataFrame:
    """(id, hash, spans, terms) of every row: base spans and the spans of disclosing terms.

    ``id`` is the id as text, ``hash`` the MD5 of the text; spans are code points, end exclusive,
    by start, kind and end. Null and empty texts have none. Rows equal in id and text have the same
    spans. Other columns are ignored; an empty table gives an empty table.
    """
    marked = stage(_scan(docs, id_column, text_column, around), "personal")
    pairs = disclosing_pairs(docs, marked, text_column, share, support, around)
    spots = (
        marked.where(F.size("words") > 0)
        .select("id", "hash", F.explode("words").alias("w"))
        .select("id", "hash", "w.entity", "w.term", "w.start", "w.end")
    )
    told = stage(
        spots.join(pairs, ["entity", "term"])
        .select("id", "hash", F.struct("start", F.lit(len(KINDS)).alias("kind"), "end").alias("span"))
        .distinct()
        # at most the words around one text's entities
        .groupBy("id", "hash")
        .agg(F.sort_array(F.collect_list("span")).alias("terms")),
        "disclosing",
    )
    base = marked.select("id", "hash", "spans")
    joined = _with_spans(base, told)
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return joined.withColumn("terms", F.coalesce("terms", empty))


def _with_spans(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on (id, hash); the right side is staged, so Spark knows its bytes."""
    same = left["id"].eqNullSafe(right["id"]) & (left["hash"] == right["hash"])
    more = [c for c in right.columns if c not in ("id", "hash")]
    joined = left.join(right, same, "left")
    return joined.select(*[left[c] for c in left.columns], *[right[c] for c in more])


def listed(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(k) for k in (*KINDS, TERM)])
    cells = F.transform(
        spans,
        lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
        ),
    )
    return F.array_join(cells, ",")


def sanitised(text: str, spans: Sequence[tuple[int, int, int]]) -> str:
    """Entities become their kind, terms go; of overlapping spans the first names the stretch."""
    parts, at, until = [], 0, 0
    for start, kind, end in sorted(spans):
        if start >= until:
            parts.append(text[at:start])
            if kind < len(KINDS):
                parts.append(f"<{KINDS[kind].upper()}>")
        until = max(until, end)
        at = until
    return "".join([*parts, text[at:]])


def sanitise(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The same rows and columns with personal data taken out of the text (a null text stays null)."""
    docs, names = set_aside(docs)
    id_column, text_column = names.get(id_column, id_column), names.get(text_column, text_column)
    found = find_personal_data(docs, id_column, text_column, **options)
    spans = (
        found.where((F.size("spans") > 0) | (F.size("terms") > 0))
        .select("id", "hash", F.concat("spans", "terms").alias("_spans"))
        .dropDuplicates(["id", "hash"])
    )
    keyed = docs.withColumns(
        {"_id": F.col(id_column).cast("string"), "_hash": F.md5(whole_text(text_column))}
    )
    staged = stage(spans, "spans")
    joined = keyed.join(
        staged, keyed["_id"].eqNullSafe(staged["id"]) & (keyed["_hash"] == staged["hash"]), "left"
    )
    clean = F.when(F.col("_spans").isNull(), F.col(text_column)).otherwise(
        _rewritten(F.col(text_column), F.col("_spans"))
    )
    cleaned = joined.select(*[clean.alias(c) if c == text_column else keyed[c] for c in docs.columns])
    return put_back(cleaned, names)


def _rewritten(text: Column, spans: Column) -> Column:
    """``sanitised`` in SQL functions: spans are in order once sorted."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS], F.lit(""))
    begin = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    folded = F.aggregate(
        F.sort_array(spans),
        begin,
        lambda acc, s: F.struct(
            F.when(
                s["start"] >= acc["at"],
                F.concat(
                    acc["out"],
                    F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                    F.element_at(names, s["kind"] + 1),
                ),
            )
            .otherwise(acc["out"])
            .alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        ),
    )
    tail = F.substring(text, (folded["at"] + 1).cast("int"), F.length(text))
    return F.concat(folded["out"], tail)
