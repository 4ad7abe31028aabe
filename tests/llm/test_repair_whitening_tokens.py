"""Conversation repair, whitening and token files against plain versions on small inputs."""

import hashlib
import itertools
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridstats.llm import conversations, token_ids
from gridstats.llm.audit_chain import ROOT, Histories
from gridstats.llm.conversations import (
    audit_conversations,
    conversation_digests,
    damage,
    repaired_turns,
)
from gridstats.llm.token_coder import BadBlock, pack, unpack
from gridstats.llm.token_ids import _Encoder, read_token_files, write_token_files
from gridstats.llm.whitening import pivoted_cholesky, principal, whiten
from gridstats.session import scratch_path

# -- conversations ----------------------------------------------------------------------------

SPACE = " \t\n\v\f\r"
STEPS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def faults_of(turns):
    seen, out = set(), []
    for role, text in turns:
        trimmed = text.rstrip(SPACE)
        if not trimmed:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        elif trimmed[-1] not in ".!?":
            out.append("truncated")
        else:
            out.append("")
        seen.add((role, text))
    return out


def repairs(turns):
    """Cheapest audit and repaired lines, by strings alone: state -> (cost, audit, lines)."""

    def insert(best):
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                role = "assistant" if state == "u" else "user"
                put(best, role[0], (cost + 5, audit + "I", [*lines, role + ":"]))

    def put(best, state, entry):
        if state not in best or entry[:2] < best[state][:2]:
            best[state] = entry

    best = {"": (0, "", [])}
    for (role, text), fault in zip(turns, faults_of(turns), strict=True):
        insert(best)
        after = {}
        for state, (cost, audit, lines) in best.items():
            put(after, state, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = cost + 5 * (fault == "truncated")
            if (state, role[:1]) in STEPS:
                put(after, role[0], (more, audit + "K", [*lines, f"{role}:{text}"]))
            for new in ("user", "assistant"):
                if (state, new[0]) in STEPS:
                    put(after, new[0], (more + 1, audit + "R", [*lines, f"{new}:{text}"]))
        best = after
    insert(best)
    return min((best[s] for s in ("", "a") if s in best), key=lambda e: e[:2])


def expected(rows):
    """conv -> everything the operator says, from (conv, turn, role, text) rows."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == conv]
        mine = [(t, r if r is not None else " ", x if x is not None else " ") for _, t, r, x in mine]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [(r, x) for _, r, x in mine]
        kinds = faults_of(turns)
        numbers = {t for t, _, _ in mine if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        pairs = [a[0][:1] + b[0][:1] for a, b in itertools.pairwise(turns)]
        cost, audit, lines = repairs(turns)
        out[conv] = (
            gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


SCHEMA = "conv_id long, turn long, role string, text string, id long, audit string, copies string"


def repaired(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
    audits = audit_conversations(frame)
    digests = {r[0]: r[1] for r in conversation_digests(repaired_turns(frame, audits)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r[0]: (*r[1:], digests.get(r[0], empty)) for r in audits.collect()}


def some_rows(seed, convs, longest):
    rnd = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "System"]
    texts = ["Yes.", "No!", "cut off", "Why? \n", "", " \t", None, "Ünd.", "x" * 100 + ".", "y" * 100 + "!"]
    rows = []
    for conv in [None, *range(convs)]:
        for turn in range(rnd.randint(1, longest)):
            number = rnd.choice([turn, turn, turn, turn // 2, turn + 3, None])
            text = rnd.choice([*texts, f"t{turn}.", f"t{turn}.", f"t{turn}."])
            rows += [(conv, number, rnd.choice(roles), text)] * rnd.choice([1, 1, 1, 2, 3])
    return rows


def test_repair_equals_plain_version(spark):
    rows = some_rows(1, 60, 9)
    assert repaired(spark, rows) == expected(rows)


def test_repair_across_stretches(spark, monkeypatch):
    rows = some_rows(2, 12, 60)
    whole = repaired(spark, rows)
    monkeypatch.setattr(conversations, "STRETCH_BITS", 2)
    # the functions of the tasks are pickled with this module's names, so solve in this process too
    assert whole == expected(rows)
    assert chained_here(rows) == {c: e[1:7] for c, e in expected(rows).items()}


def chained_here(rows):
    """The stretches of four turns, solved and chained in this process."""
    import pyarrow as pa

    found = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(
            ((t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv),
            key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]),
        )
        kinds = faults_of([(r, x) for _, r, x in mine])
        turns = [(conv, n, r[1][:1], k, 1) for n, (r, k) in enumerate(zip(mine, kinds, strict=True))]
        kind = pa.schema([("c", pa.int64()), ("id", pa.int64()), ("i", pa.string()), ("f", pa.string()), ("n", pa.int64())])
        batches = [pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*turns[i : i + 3], strict=True), kind, strict=True)], schema=kind) for i in range(0, len(turns), 3)]
        solved = list(conversations._solve_stretches(iter(batches)))
        assert not any(x for b in solved for x in b.column(2).to_pylist())
        (row,) = list(conversations._chain_stretches(iter(solved)))
        found[conv] = tuple(c[0].as_py() for c in row.columns[1:])
    return found


def test_cheapest_audit_by_trying_all():
    """Every audit of a few turns, with up to three insertions, against the program."""
    kinds = [("user", "a."), ("assistant", "b."), ("system", "c."), ("user", "d"), ("user", " "), ("tool", "e.")]
    for turns in itertools.chain.from_iterable(itertools.product(kinds, repeat=n) for n in range(4)):
        turns = [(r, t.replace(".", f"{n}.")) for n, (r, t) in enumerate(turns)]
        kind = faults_of(turns)
        least = (1 << 30, "")
        for places in itertools.product(range(4), repeat=len(turns) + 1):
            if sum(places) > 3:
                continue
            for letters in itertools.product("DKR", repeat=len(turns)):
                state, cost, audit = "", 0, ""
                steps = []
                for n, letter in enumerate(letters):
                    steps += [("I", None)] * places[n] + [(letter, n)]
                steps += [("I", None)] * places[-1]
                for letter, n in steps:
                    audit += letter
                    if letter == "D":
                        cost += 2
                        continue
                    if letter != "I" and kind[n] in ("blank", "duplicate"):
                        break
                    new = ("a" if state == "u" else "u") if letter in "IR" else turns[n][0][0]
                    if (state, new) not in STEPS:
                        break
                    cost += {"I": 5, "K": 0, "R": 1}[letter] + 5 * (letter != "I" and kind[n] == "truncated")
                    state = new
                else:
                    if state in ("", "a"):
                        least = min(least, (cost, audit))
        told = conversations._finish(
            *conversations._run([(r[0] if r[0] in "sua" else "", f, 1) for (r, _), f in zip(turns, kind, strict=True)], 0)
        )
        assert told == least == repairs(turns)[:2]


def test_colliding_hashes_are_verified():
    rnd = random.Random(3)
    for hash_of in (lambda label: 0, lambda label: len(label)):
        histories, texts = Histories(hash_of), {ROOT: ()}
        level = [ROOT]
        for _ in range(12):
            level = [histories.add(rnd.choice(level), rnd.choice("DKR")) for _ in range(8)]
            for node in level:
                texts[node] = (*texts[histories.above[node][0]], histories.labels[node])
            for a, b in itertools.product(level, repeat=2):
                assert histories.before(a, b) == (texts[a] < texts[b])


def test_damage_and_dropped_conversations(spark):
    rows = spark.createDataFrame(
        [(c, t, "assistant", "A. B! C?") for c in range(40) for t in range(2)] + [(None, None, None, None)],
        "conv_id long, turn long, role string, text string",
    )
    damaged = {(r[0], r[1]): tuple(r[2:]) for r in damage(rows).collect()}
    for (conv, turn), got in damaged.items():
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" ", " ") if conv is None else ("assistant", "A. B! C?")
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        assert got == (role, text, {0: 0, 3: 2}.get(kind, 1))
    none_left = damage(rows).withColumn("copies", F.lit(0))
    audits = audit_conversations(none_left, copies="copies").collect()
    assert len(audits) == 41 and all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "") for r in audits)
    assert repaired_turns(none_left, audit_conversations(none_left, "copies"), "copies").count() == 0
    assert audit_conversations(rows.limit(0)).count() == 0


# -- whitening --------------------------------------------------------------------------------


@pytest.mark.parametrize(("d", "rank"), [(1, 1), (2, 2), (5, 5), (9, 3), (40, 40), (33, 20)])
def test_principal_equals_eigh(d, rank):
    rng = np.random.default_rng(d)
    b = rng.normal(size=(rank, d)) * np.exp(2 * rng.normal(size=(rank, 1)))
    a = b.T @ b
    factor, pivots = pivoted_cholesky(a)
    assert np.allclose(factor @ factor.T, a[np.ix_(pivots, pivots)], rtol=0, atol=1e-12 * a.max())
    assert np.allclose(np.triu(factor, 1), 0)
    vectors, values = principal(a, d)
    assert len(values) == rank
    plain = np.linalg.eigvalsh(a)[::-1][:rank]
    assert np.allclose(values, plain, rtol=0, atol=1e-13 * plain[0])
    assert np.allclose(a @ vectors, vectors * values, rtol=0, atol=1e-13 * plain[0])
    assert np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-13)


def vectors_of(spark, rows):
    schema = "vec_id long, embedding array<double>, x string, v int, n string, component string"
    return spark.createDataFrame([(i, v, "a", 1, "b", "c") for i, v in rows], schema)


def whitened_by_hand(rows):
    kept = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(256 * c)) for c in v] for _, v in kept])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    return kept, n, ((n * x - sums) ** 2).sum(axis=1), (x - sums / n) @ vectors / np.sqrt(values), values / np.var(fit, axis=0).sum()


def test_whitening_equals_plain_version(spark):
    rng = np.random.default_rng(5)
    spread = np.exp(rng.normal(size=6))
    rows = [(i, (rng.normal(size=6) * spread + 3).tolist()) for i in range(80)]
    rows += [(i, rows[0][1]) for i in range(100, 140)] + [(7, rows[3][1]), (None, rows[5][1])]
    bad = [(200, None), (201, []), (202, [1.0] * 5 + [None]), (203, [float("nan")] * 6), (204, [float("inf")] * 6)]
    kept, n, deviation, white, explained = whitened_by_hand(rows + bad)
    got = whiten(vectors_of(spark, [*rows, *bad])).toPandas()
    assert len(got) == 4 * len(kept) and set(got["n"]) == {n}
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-10
    for k in range(4):
        part = got[got["component"] == k + 1]
        assert np.allclose(part["explained"], explained[k], rtol=1e-12)
        ours = sorted(zip(part["vec_id"].fillna(-1), part["deviation"], part["whitened"].abs()))
        plain = sorted(zip([-1 if i is None else i for i, _ in kept], deviation, np.abs(white[:, k])))
        assert [r[:2] for r in ours] == [r[:2] for r in plain]
        assert np.allclose([r[2] for r in ours], [r[2] for r in plain], rtol=1e-9, atol=1e-12)


def test_whitening_edges(spark):
    assert whiten(vectors_of(spark, [(1, None)])).count() == 0
    assert whiten(vectors_of(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    line = whiten(vectors_of(spark, [(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [-0.001, 2.0]), (4, [5.0])]))
    assert sorted({r["component"] for r in line.collect()}) == [1, 2]
    flat = whiten(vectors_of(spark, [(1, [0.0, 0.0]), (2, [1.0, 1.0])])).collect()
    assert {(r["component"], r["n"], r["deviation"]) for r in flat} == {(1, 2, 2 * 256**2)}
    assert sorted(round(r["whitened"], 12) for r in flat) == [-1, 1] and round(flat[0]["explained"], 12) == 1
    far = whiten(vectors_of(spark, [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 1e15])])).collect()
    assert {r["deviation"] for r in far if r["vec_id"] == 1} == {None}
    assert all(np.isfinite(r["whitened"]) for r in far)


# -- token files ------------------------------------------------------------------------------


def test_coder_round_trip():
    rng = np.random.default_rng(2)
    for n in (0, 1, 15, 16, 17, 200):
        for vocabulary in (2, 7, 50257, 1 << 19):
            for ids in (
                rng.integers(0, vocabulary, n),
                np.full(n, vocabulary - 1),
                rng.integers(0, 2, n),
                np.arange(n) % vocabulary,
            ):
                image = pack([None, -5], [n, 0], ids, vocabulary, block=16)
                names, counts, back = unpack(image)
                assert (names, counts.tolist(), back.tolist()) == ([None, -5], [n, 0], ids.tolist())
    repeated = np.tile(rng.integers(0, 50257, 50), 40)
    assert len(pack([1], [2000], repeated, 50257)) < 0.3 * 2 * 2000
    with pytest.raises(ValueError):
        pack([1], [1], np.array([9]), 9)


def test_damaged_images_are_found():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 500, 100)
    image = pack([1, 2], [60, 40], ids, 500, block=16)
    for at in range(0, len(image), 7):
        bad = bytearray(image)
        bad[at] ^= 16
        try:
            assert unpack(bytes(bad))[2].tolist() == ids.tolist()  # padding at a block's end
        except BadBlock:
            pass
    with pytest.raises(BadBlock):
        unpack(image[:-1])
    with pytest.raises(BadBlock):
        unpack(b"GSTI")


def test_pieces_have_the_ids_of_the_whole_text():
    tokenizers = pytest.importorskip("tokenizers")
    vocabulary = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    encode = tokenizers.Tokenizer.from_file(vocabulary)
    encode.encode_special_tokens = True
    by_piece = _Encoder(vocabulary)
    assert by_piece.by_piece
    rnd = random.Random(6)
    parts = [" ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "\u200b", "a", "Zoë", "12", "½", "'s", "'", "..", "_", "🏁", "中文", "<|endoftext|>"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 25))) for _ in range(4000)]
    whole = [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in encode.encode_batch(texts, add_special_tokens=False)]
    assert by_piece(texts) == whole == by_piece(texts)


def test_token_files_equal_the_tokenizer(spark):
    tokenizers = pytest.importorskip("tokenizers")
    vocabulary = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    rnd = random.Random(4)
    words = ["the", " Grand", "\n\n", "Ünïcode", "🏁", "<|endoftext|>", "  ", "x" * 50, "123", "'ll"]
    texts = ["", None, "a", "long " * 30_000] + ["".join(rnd.choices(words, k=rnd.randint(0, 80))) for _ in range(60)]
    ids = [*range(60), 3, 3, None, None]
    rnd.shuffle(ids)
    rows = list(zip(ids, texts, strict=True)) + [(3, "a"), (3, "a")]
    docs = spark.createDataFrame([(i, t, 1, 2, "n") for i, t in rows], "doc_id long, text string, start long, part int, ids string")
    path = scratch_path(spark, "token-files")
    write_token_files(docs, path, vocabulary, end_id=2, file_ids=1000)
    got = [tuple(r) for r in read_token_files(spark, path).orderBy("start").collect()]
    encode = tokenizers.Tokenizer.from_file(vocabulary)
    encode.encode_special_tokens = True
    plain = [(i, [*encode.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows]
    assert sorted(((g[0] is not None, g[0] or 0, bytes(g[3])) for g in got)) == sorted(
        (i is not None, i or 0, struct.pack(f"<{len(t)}I", *t)) for i, t in plain
    )
    assert [g[0] for g in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert [g[1] for g in got] == list(itertools.accumulate([0] + [g[2] for g in got][:-1]))
    assert all(len(g[3]) == 4 * g[2] for g in got)
    assert spark.read.parquet(path).count() > 4
    write_token_files(docs.limit(0), path, vocabulary, end_id=2)
    assert read_token_files(spark, path).count() == 0


def test_new_pieces_are_tokenised_together_and_once():
    pytest.importorskip("tokenizers")
    vocabulary = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    encoder = _Encoder(vocabulary)

    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer, self.texts, self.chars = tokenizer, 0, 0

        def encode_batch_fast(self, texts, **options):
            self.texts += len(texts)
            self.chars += sum(map(len, texts))
            return self.tokenizer.encode_batch_fast(texts, **options)

    plain = encoder.tokenizer
    encoder.tokenizer = Counting(plain)
    words = ["".join(w) for w in itertools.product("abcé", repeat=5)]
    texts = [" ".join(words), ", ".join(words) + ".", "\n".join(words), "(" + ") (".join(words) + ")"]
    coded = [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert encoder(texts) == coded
    assert encoder.tokenizer.texts < 30  # not one call a word
    assert encoder.tokenizer.chars < 16 * len(words)  # a word with and without a space, beside whatever sign


def test_pieces_beside_signs_and_wide_characters(monkeypatch):
    tokenizers = pytest.importorskip("tokenizers")
    vocabulary = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    encode = tokenizers.Tokenizer.from_file(vocabulary)
    encode.encode_special_tokens = True
    rnd = random.Random(8)
    parts = [" ", "  ", "\n", "\n\n", "\t", "\x00", "\x1c", "\x7f", "\x85", "\xa0", "\u1680", "\u180e", "\u2003", "\u200b"]
    parts += ["\u2028", "\u202f", "\u205f", "\u3000", "\u0301", "a", "é", "ł", "Ж", "×", "÷", "ª", "²", "7", "'", "''", "'s"]
    parts += ["'S", "'re", "’s", ".", "..", ",", "-", "(", "|", "ひ", "α", "the"]
    by_piece = _Encoder(vocabulary)
    for room, call in ((1 << 20, 1 << 16), (50, 1 << 16), (500, 8)):
        monkeypatch.setattr(token_ids, "KNOWN_PIECES", room)
        monkeypatch.setattr(token_ids, "_CALL_BYTES", call)
        texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 20))) for _ in range(3000)]
        whole = [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in encode.encode_batch(texts, add_special_tokens=False)]
        assert by_piece(texts) == whole
    assert by_piece([]) == [] and by_piece(["", ""]) == [b"", b""]


def test_blocks_start_from_what_the_header_tells():
    rng = np.random.default_rng(9)
    words = [rng.integers(0, 400, rng.integers(1, 5)).tolist() for _ in range(60)]
    ids = np.array([i for _ in range(3000) for i in words[min(int(rng.exponential(12)), 59)]])
    image = pack([1], [len(ids)], ids, 50257, block=64)
    assert unpack(image)[2].tolist() == ids.tolist()
    assert len(image) * 8 < 7 * len(ids)


def test_many_ids_round_trip():
    rng = np.random.default_rng(10)
    for ids in (np.minimum(rng.zipf(1.2, 1_300_001) - 1, 60_000), np.full(1_100_000, 3), rng.integers(0, 1 << 19, 70_000)):
        image = pack([1], [len(ids)], ids.astype(np.int64), 1 << 19)
        assert np.array_equal(unpack(image)[2], ids)
