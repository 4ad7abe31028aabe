"""Conversation repair: the cheapest edits that make the turns alternate, as an audit trail.

A repaired conversation's role initials read ``(s?(ua)+)?``. Edits in order of the turns: Keep (K)
costs nothing, Rerole (R) to user or assistant 1, Delete (D) 2, Insert (I) of an empty user or
assistant turn 5. A turn that has no characters but white space, or repeats an earlier one (role and
text), must be deleted; one whose text does not end in ``.``, ``!`` or ``?`` costs 5 more unless it
is deleted. Of equally cheap audits the one that sorts first is taken.

How a conversation of any length is done, although its turns depend on each other:

1. Turns are reduced to 100 bytes or so (a hash and the first characters of the text, what is wrong
   with it), equal turns are counted, and all are range-partitioned by conversation and turn and
   staged. First occurrences are found by a group-by on role and hash, joined on the turn's number.
2. Each stretch of ``STRETCH`` turns at most goes through the dynamic program on its own, with one
   history per state, kept as linked nodes (:mod:`audit_chain`). A conversation that lies in one
   stretch is finished there. Others are solved for each state they may be entered in.
3. The stretches of a split conversation are chained in the same way, a stretch being one edit.
4. Texts move once, to their conversation, where they are read in order beside the audit; nothing
   but a running hash and the audit is held.

Step 4 puts a conversation through one task, turn by turn, because its digest is one hash over the
whole; memory does not grow with the texts.

Equal turn numbers are in order of role, then text (by its first 64 characters and then its
SHA-256), null turns first. A null role or text is one space: such a text is blank, such a role must
be changed or deleted, as any role whose first letter is not s, u or a, an empty one included. A
null conversation id is a conversation. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .audit_chain import ROOT, Histories

STRETCH_BITS = 13  # stretches of 8192 turns
STRETCH = 1 << STRETCH_BITS
HEAD = 64
_SEEN = "[^\\x20\\x09-\\x0D]"
_ENDS = ".!?"

KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
TRUNCATED = 5
# What a role string may be: empty, after s, after u, after a.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
_NEXT = {(EMPTY, "s"): SYSTEM, **{(q, "u"): USER for q in (EMPTY, SYSTEM, ASSISTANT)}, (USER, "a"): ASSISTANT}
_OPEN_END = {EMPTY: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}  # what completes a string
_LEGAL = {"su", "ua", "au"}


def _new_role(state: int) -> str:
    """The only role that user and assistant leave open after a state."""
    return "assistant" if state == USER else "user"


def _after_new(state: int) -> int:
    return _NEXT[state, _new_role(state)[0]]


def _edits(initial: str, fault: str) -> dict[int, list[tuple[int, int, str]]]:
    """For every state after a turn: the states before it, what that costs, and the label.

    Labels are a number of insertions and then the letter of the turn. An insertion before a
    deletion is never cheapest and first: after it, it costs as much and sorts before.
    """
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for begun in STATES:
        options = [(DELETE, "D", begun)]
        if fault in ("", "truncated"):
            extra = TRUNCATED if fault else 0
            state = begun
            for inserted in range(3):
                paid, label = inserted * INSERT + extra, "I" * inserted
                if (state, initial) in _NEXT:
                    options.append((paid + KEEP, label + "K", _NEXT[state, initial]))
                options.append((paid + REROLE, label + "R", _after_new(state)))
                state = _after_new(state)
        for cost, label, ended in options:
            if (cost, label) < best.get((begun, ended), (1 << 62, "")):
                best[begun, ended] = (cost, label)
    table: dict[int, list[tuple[int, int, str]]] = {q: [] for q in STATES}
    for (begun, ended), (cost, label) in best.items():
        table[ended].append((begun, cost, label))
    return table


_FAULTS = ("", "blank", "duplicate", "truncated")
_TABLES = {(i, f): _edits(i, f) for i in ("s", "u", "a", "") for f in _FAULTS}

Best = dict[int, tuple[int, int]]  # state -> (cost, history)


def advance(histories: Histories, now: Best, table: dict[int, list[tuple[int, int, str]]]) -> Best:
    """The cheapest history of every state after one more edit; ties go to the one that sorts first."""
    after: Best = {}
    for ended, ways in table.items():
        least, chosen = None, []
        for begun, cost, label in ways:
            if begun in now:
                paid = now[begun][0] + cost
                if least is None or paid < least:
                    least, chosen = paid, [(now[begun][1], label)]
                elif paid == least:
                    chosen.append((now[begun][1], label))
        if least is None:
            continue
        nodes = [histories.add(parent, label) for parent, label in chosen]
        node = nodes[0]
        for other in nodes[1:]:
            if histories.before(other, node):
                node = other
        after[ended] = (least, node)
    return after


def _run(turns: list[tuple[str, str, int]], begun: int) -> tuple[Histories, Best]:
    """The program over (initial, fault of the first copy, copies), from one state."""
    histories = Histories()
    now: Best = {begun: (0, ROOT)}
    for initial, fault, copies in turns:
        table = _TABLES[initial, fault]
        if copies > 1:  # further copies repeat the first, so they are deleted
            more, tail = DELETE * (copies - 1), "D" * (copies - 1)
            table = {q: [(b, c + more, w + tail) for b, c, w in ways] for q, ways in table.items()}
        now = advance(histories, now, table)
    return histories, now


def _finish(histories: Histories, now: Best) -> tuple[int, str]:
    """The cheapest complete history: its cost and audit."""
    ends = [(cost + INSERT * len(_OPEN_END[q]), node, _OPEN_END[q]) for q, (cost, node) in now.items()]
    least = min(cost for cost, _, _ in ends)
    ends = [(node, more) for cost, node, more in ends if cost == least]
    best, more = ends[0]
    for other, its in ends[1:]:
        # histories of one length never begin one another, so what follows does not matter
        if histories.before(other, best):
            best, more = other, its
    return least, histories.text(best) + more


# -- damage for tests of repair ---------------------------------------------------------------


def damage(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) as a fixed rule damages them; 0 copies are dropped."""

    def known(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    role, text = known("role"), known("text")
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "")
        .when(kind == 2, F.translate(text, _ENDS, ""))
        .otherwise(text)
        .alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


# -- stretches --------------------------------------------------------------------------------


def _place() -> list[Column]:
    """Order of the turns of a conversation; nulls come first."""
    head, digest = F.substring("text", 1, HEAD), F.sha2("text", 256)
    return [F.col("turn"), F.col("role"), head.alias("_head"), digest.alias("_digest")]


def _named(rows: DataFrame, copies: str | None) -> DataFrame:
    def known(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" ")).alias(column)

    times = F.lit(1) if copies is None else F.coalesce(F.col(copies), F.lit(1))
    return rows.select(
        "conv_id", "turn", known("role"), known("text"), times.cast("long").alias("copies")
    )


def _turns(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Different turns with their number in order (``id``), and what is wrong with those that stand."""
    last = F.regexp_extract("text", f"({_SEEN})[\\x20\\x09-\\x0D]*\\z", 1)
    slim = rows.select(
        "conv_id",
        *_place(),
        "copies",
        F.when(last == "", "blank").when(~F.instr(F.lit(_ENDS), last).cast("boolean"), "truncated").alias("_own"),
    )
    key = ["conv_id", "turn", "role", "_head", "_digest"]
    counted = slim.groupBy(*key, "_own").agg(F.sum("copies").alias("copies"))
    ordered = counted.repartitionByRange(*key).sortWithinPartitions(*key)
    placed = stage(ordered.withColumn("id", F.monotonically_increasing_id()), "turns")
    there = placed.where("copies > 0")
    first = there.groupBy("conv_id", "role", "_digest").agg(F.min("id").alias("_first"))
    found = there.join(first.select("_first"), F.col("id") == F.col("_first"), "left")
    fault = F.when(F.col("_own") == "blank", "blank").when(F.col("_first").isNull(), "duplicate")
    marked = found.select(
        "conv_id",
        "id",
        F.substring("role", 1, 1).alias("initial"),
        F.coalesce(fault, "_own", F.lit("")).alias("fault"),
        "copies",
    )
    return placed, marked


def _spans(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps) of every conversation, those without a turn left included."""
    number = F.when(F.col("copies") > 0, F.col("turn"))
    numbers = turns.select("conv_id", number.alias("turn")).distinct()
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return numbers.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"))


_STRETCH_ROW = (
    "{conv}, stretch long, whole boolean, blank long, duplicate long, truncated long, illegal long,"
    " first string, last string, costs array<long>, audits array<string>"
)


def _solve_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per conversation and stretch; turns come in order, a stretch at a time.

    A conversation at either end of its stretch may go on in the next one, so it is solved from all
    four states (``costs`` and ``audits`` have 16 entries, begun * 4 + ended); an inner one is whole.
    """
    waiting: list[tuple] = []
    stretch = None
    ready: list[tuple] = []

    def solve(rows: list[tuple], whole: bool) -> None:
        counts = dict.fromkeys(_FAULTS, 0)
        turns, pairs, previous = [], 0, None
        for _, _, initial, fault, copies in rows:
            counts[fault] += 1
            # copies of a blank turn are blank, of any other they repeat it
            counts["blank" if fault == "blank" else "duplicate"] += copies - 1
            if previous is not None:
                pairs += previous + initial not in _LEGAL
            pairs += copies - 1  # a role beside itself
            previous = initial
            turns.append((initial if initial in "sua" else "", fault, copies))
        head = (rows[0][0], rows[0][1] >> STRETCH_BITS, whole)
        head += (counts["blank"], counts["duplicate"], counts["truncated"], pairs, rows[0][2], rows[-1][2])
        if whole:
            cost, audit = _finish(*_run(turns, EMPTY))
            ready.append((*head, [cost], [audit]))
            return
        costs: list[int | None] = []
        audits: list[str | None] = []
        for begun in STATES:
            histories, now = _run(turns, begun)
            for ended in STATES:
                cost, node = now.get(ended, (None, None))
                costs.append(cost)
                audits.append(None if node is None else histories.text(node))
        ready.append((*head, costs, audits))

    def drain(upto_end: bool) -> None:
        """Solve what is complete; the first conversation of a stretch and its last may go on."""
        nonlocal waiting, begun_here
        groups = [list(g) for _, g in groupby(waiting, key=lambda r: r[0])]
        keep = [] if upto_end else groups.pop()
        for i, group in enumerate(groups):
            edge = (not begun_here and i == 0) or (upto_end and i == len(groups) - 1)
            solve(group, whole=not edge)
        begun_here = begun_here or bool(groups)
        waiting = keep

    begun_here = False
    for batch in batches:
        kind = batch.schema.field(0).type
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[1] >> STRETCH_BITS != stretch:
                if waiting:
                    drain(True)
                stretch, begun_here = row[1] >> STRETCH_BITS, False
            waiting.append(row)
        if waiting:
            drain(False)
        if ready:
            yield _stretch_batch(ready, kind)
            ready = []
    if waiting:
        drain(True)
    if ready:
        yield _stretch_batch(ready, kind)


def _stretch_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [kind, pa.int64(), pa.bool_(), *[pa.int64()] * 4, pa.string(), pa.string()]
    kinds += [pa.list_(pa.int64()), pa.list_(pa.string())]
    names = "conv_id stretch whole blank duplicate truncated illegal first last costs audits".split()
    arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)


_AUDIT_ROW = "{conv}, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _chain_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation out of its stretches, which come in order."""
    held: tuple | None = None  # conversation, counts, last initial, histories, best
    kind = None

    def close() -> pa.RecordBatch:
        conv, counts, _, histories, now = held
        cost, audit = _finish(histories, now)
        kinds = [kind, *[pa.int64()] * 5, pa.string()]
        names = "conv_id blank duplicate truncated illegal cost audit".split()
        values = [conv, *counts, cost, audit]
        arrays = [pa.array([v], k) for v, k in zip(values, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    for batch in batches:
        kind = batch.schema.field(0).type
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            conv, _, _, *counts, first, last, costs, audits = row
            if held is None or held[0] != conv:
                if held is not None:
                    yield close()
                held = (conv, [0] * 4, None, Histories(), {EMPTY: (0, ROOT)})
            _, sums, before, histories, now = held
            sums = [a + b for a, b in zip(sums, counts, strict=True)]
            if before is not None:
                sums[3] += before + first not in _LEGAL
            table = {
                ended: [
                    (begun, costs[begun * 4 + ended], audits[begun * 4 + ended])
                    for begun in STATES
                    if costs[begun * 4 + ended] is not None
                ]
                for ended in STATES
            }
            held = (conv, sums, last, histories, advance(histories, now, table))
    if held is not None:
        yield close()


# -- the operator -----------------------------------------------------------------------------


def audit_conversations(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation.

    ``rows`` has conv_id, turn, role and text; the column named by ``copies`` says how often a row
    stands there (0: not at all, though its conversation is answered for). ``gaps`` counts turn
    numbers that are missing between the first and the last, ``illegal`` neighbours whose role
    initials are not su, ua or au.
    """
    numbered, turns = _turns(_named(rows, copies))
    conv = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}"
    dealt = turns.repartition(F.shiftright("id", STRETCH_BITS)).sortWithinPartitions("id")
    solved = stage(
        dealt.select("conv_id", "id", "initial", "fault", "copies").mapInArrow(
            _solve_stretches, _STRETCH_ROW.format(conv=conv)
        ),
        "stretches",
    )
    counts = ["blank", "duplicate", "truncated", "illegal"]
    split = solved.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "stretch")
    chained = split.mapInArrow(_chain_stretches, _AUDIT_ROW.format(conv=conv))
    whole = solved.where("whole").select(
        "conv_id", *counts, F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit")
    )
    audits = whole.unionByName(chained).withColumnRenamed("conv_id", "_conv")
    spans = _spans(numbered)
    found = spans.join(audits, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (*counts, "cost")]
    return found.select("conv_id", "gaps", *zeros, F.coalesce("audit", F.lit("")).alias("audit"))


def repaired_turns(rows: DataFrame, audits: DataFrame, copies: str | None = None) -> DataFrame:
    """The turns of the repaired conversations: (conv_id, place, edit, role, text).

    Deleted turns are left out. All turns of a conversation are in one task, in order.
    """
    conv = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}"
    named = _named(rows, copies).where("copies > 0")
    nothing = F.lit(None)
    key = ["conv_id", "_audited", "turn", "role", "_head", "_digest"]
    texts = named.select("conv_id", F.lit(1).alias("_audited"), *_place(), "text", "copies")
    notes = audits.select(
        "conv_id",
        F.lit(0).alias("_audited"),
        nothing.cast(rows.schema["turn"].dataType).alias("turn"),
        *[nothing.cast("string").alias(c) for c in ("role", "_head", "_digest")],
        F.col("audit").alias("text"),
        F.lit(1).cast("long").alias("copies"),
    )
    together = texts.unionByName(notes).repartition("conv_id").sortWithinPartitions(*key)
    return together.select("conv_id", "_audited", "role", "text", "copies").mapInArrow(
        _apply, f"{conv}, place long, edit string, role string, text string"
    )


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "place", "edit", "role", "text"]
    conv, audit, at, place, state = None, "", 0, 0, EMPTY
    out: list[tuple] = []
    kind = None

    def emit(edit: str, role: str, text: str) -> None:
        nonlocal place, state
        out.append((conv, place, edit, role, text))
        place += 1
        state = _NEXT[state, role[0]]

    def insertions() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            emit("I", _new_role(state), "")
            at += 1

    def batch_of() -> pa.RecordBatch:
        kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
        arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    for batch in batches:
        kind = batch.schema.field(0).type
        for name, audited, role, text, copies in zip(*batch.columns, strict=True):
            if audited.as_py() == 0:
                insertions()  # what completes the conversation before
                conv, audit, at, place, state = name.as_py(), text.as_py(), 0, 0, EMPTY
                continue
            for _ in range(copies.as_py()):
                if audit[at] == "I":
                    insertions()
                letter = audit[at]
                at += 1
                if letter == "K":
                    emit("K", role.as_py(), text.as_py())
                elif letter == "R":
                    emit("R", _new_role(state), text.as_py())
        if out:
            yield batch_of()
            out = []
    insertions()
    if out:
        yield batch_of()


def conversation_digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of ``role:text`` lines per conversation, over turns in the order of ``repaired_turns``."""
    conv = f"conv_id {turns.schema['conv_id'].dataType.simpleString()}"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running, held = None, None
        for batch in batches:
            kind = batch.schema.field(0).type
            done = []
            for name, place, role, text in zip(*batch.columns, strict=True):
                line = f"{role.as_py()}:{text.as_py()}".encode()
                if place.as_py() == 0:
                    if running is not None:
                        done.append((held, running.hexdigest()))
                    running, held = hashlib.sha256(line), name.as_py()
                else:
                    running.update(b"\n" + line)
            if done:
                yield _digest_batch(done, kind)
        if running is not None:
            yield _digest_batch([(held, running.hexdigest())], kind)

    return turns.select("conv_id", "place", "role", "text").mapInArrow(
        digest, f"{conv}, repaired_sha256 string"
    )


def _digest_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (kind, pa.string()), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["conv_id", "repaired_sha256"])
