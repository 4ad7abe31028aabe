"""Mixing, SimHash, toxicity, neighbours and personal data on small inputs."""

import hashlib
import math
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gridstats.llm import pii, simhash
from gridstats.llm.graph import connected_components
from gridstats.llm.mixing import _hypergeometric, even_sizes, fill_targets, mix, mix_blocks, mix_rows, split_quotas
from gridstats.llm.neighbours import chi_square_cdf, chi_square_point, nearest
from gridstats.llm.pii import entities, find_personal_data, listed, luhn, sanitise, sanitised
from gridstats.llm.simhash import forest, keep_first, near_duplicates
from gridstats.llm.toxicity import (
    FLOOR,
    POWER,
    Model,
    _padded,
    held_out,
    kernel,
    score_toxicity,
    train,
    train_on,
    words_of,
)

DOCS = "doc_id long, text string, source string, size string, taken string, label string"


def docs_of(spark, rows):
    return spark.createDataFrame([(d, t, s, "x", "y", "z") for d, t, s in rows], DOCS)


# -- mixing -----------------------------------------------------------------------------------


def mixing_rows():
    rnd = random.Random(1)
    rows = []
    for d in range(120):
        source = rnd.choice(["a", "a", "a", "b", "c", "dé", None])
        rows.append((d, "w " * rnd.choice([0, 1, 5, 40, 700]), source))
    rows += [(5, rows[5][1], rows[5][2]), (None, "x y", "b"), (None, "x y", "b"), (200, None, "b"), (201, "", "tiny")]
    return rows


def test_mix_meets_targets(spark):
    rows = mixing_rows()
    mixed = mix(docs_of(spark, rows)).collect()
    assert len(mixed) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    targets = fill_targets(sizes)
    taken = {}
    for r in mixed:
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert r["source_size"] == sizes[r["source"]]
        assert r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes)
    again = mix(docs_of(spark, random.Random(2).sample(rows, len(rows)))).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, mixed))


def test_shards_are_disjoint_and_even(spark):
    _, blocks = mix_blocks(docs_of(spark, mixing_rows()), shards=4, block_words=16)
    rows = blocks.collect()
    assert len({(r["_row"], r["block"], r["epoch"]) for r in rows}) == len(rows)
    per_shard = [sum(r["shard"] == k for r in rows) for k in range(4)]
    assert max(per_shard) - min(per_shard) <= 8


def test_splitting_tree_keeps_quotas():
    quotas = np.array([100, 0, 7, 3000])
    parts = split_quotas(quotas, even_sizes(int(quotas.sum()), 7), [1])
    assert len(parts) == 7 and (parts.sum(axis=0) == quotas).all() and (parts >= 0).all()
    assert max(p.sum() for p in parts) - min(p.sum() for p in parts) <= 1


def test_hypergeometric_draws():
    rng = np.random.default_rng(3)
    drawn = np.bincount([_hypergeometric(rng, 5, 7, 4) for _ in range(20_000)], minlength=5) / 20_000
    exact = [math.comb(5, k) * math.comb(7, 4 - k) / math.comb(12, 4) for k in range(5)]
    assert np.abs(drawn - exact).max() < 0.015
    # far beyond numpy's own range: mean and deviation of the draw
    own, rest, size = 3 * 10**10, 7 * 10**10, 10**10
    many = np.array([_hypergeometric(rng, own, rest, size) for _ in range(300)], dtype=float)
    deviation = (size * 0.3 * 0.7 * 0.9) ** 0.5
    assert abs(many.mean() - 3 * 10**9) < 4 * deviation / 300**0.5
    assert 0.8 < many.std() / deviation < 1.2
    assert _hypergeometric(rng, 4, 0, 3) == 3 and _hypergeometric(rng, 1, 10**12, 1) in (0, 1)


def test_mix_replays_the_tree(spark):
    """``taken`` of every row, from a replay of permutation, tree and turns on plain lists."""
    rows, shards, seed, length = mixing_rows(), 4, 11, 16
    frame = docs_of(spark, rows)
    mixed, blocks = mix_blocks(frame, shards=shards, seed=seed, block_words=length)
    known = mixed.collect()
    drawn = {(r["_row"], r["block"], r["epoch"]): (r["words"], r["shard"]) for r in blocks.collect()}
    by_source = {}
    for r in known:
        for n in range(-(-r["size"] // length)):
            key = hashlib.md5(f"{seed}/{r['_row']}/{n}".encode()).hexdigest()
            by_source.setdefault(r["source"], []).append((key, r["_row"], n, min(length, r["size"] - n * length)))
    plan = []
    for source, held in by_source.items():
        held.sort()
        size = sum(w for *_, w in held)
        words = round(next(r["target"] for r in known if r["source"] == source))
        epochs, rest = divmod(words, size)
        more = min(len(held), math.ceil(rest / size * len(held)))
        tag = spark.sql("SELECT pmod(xxhash64(coalesce(:s, ''), :s IS NULL), 1024) AS g", args={"s": source}).first()["g"]
        plan.append((tag, source is None, source or "", source, held, epochs, rest, more))
    plan.sort(key=lambda p: p[:3])
    tags = sorted({p[0] for p in plan})
    wanted = [sum(p[5] * len(p[4]) + p[7] for p in plan if p[0] == t) for t in tags]
    spare = [sum(len(p[4]) - p[7] for p in plan if p[0] == t) for t in tags]
    top = split_quotas(wanted, even_sizes(sum(wanted), shards), [seed, 0])
    rests = split_quotas(spare, even_sizes(sum(spare), shards), [seed, 1])
    expected = {}
    for i, tag in enumerate(tags):
        own = [p for p in plan if p[0] == tag]
        both = split_quotas([p[5] * len(p[4]) for p in own] + [p[7] for p in own], top[:, i], [seed, 2, tag])
        left = split_quotas([len(p[4]) - p[7] for p in own], rests[:, i], [seed, 3, tag])
        for j, (*_, held, epochs, rest, _) in enumerate(own):
            full = [k for k in range(shards) for _ in range(both[k, j])]
            for at, k in enumerate(full):
                _, row, n, words = held[at % len(held)]
                expected[row, n, at // len(held)] = (words, k)
            turns, place = [], 0
            for k in range(shards):
                quota = both[k, len(own) + j]
                for t in range(quota + left[k, j]):
                    turns.append((t >= quota, t, k, held[place]))
                    place += 1
            assert place == len(held)
            for _, _, k, (_, row, n, words) in sorted(turns):
                if rest > 0:
                    expected[row, n, epochs] = (min(words, rest), k)
                rest -= words
    assert drawn == expected
    other = mix_blocks(frame, shards=9, seed=seed, block_words=length)[1]
    assert {(r["_row"], r["block"], r["epoch"]) for r in other.collect()} != set(drawn)


def test_mix_rows_and_empty(spark):
    rows = mixing_rows()
    whole = mix_rows(docs_of(spark, rows))
    assert whole.count() == len(rows)
    assert set(whole.columns) == {"doc_id", "text", "source", "size", "taken", "label", "source_size", "target"}
    assert mix(docs_of(spark, [])).collect() == []
    assert [r["taken"] for r in mix(docs_of(spark, [(1, None, None), (2, "", "a")])).collect()] == [0, 0]


# -- SimHash ----------------------------------------------------------------------------------


def codes_by_hand(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(codes, limit=2):
    root = list(range(len(codes)))
    changed = True
    while changed:
        changed = False
        for i in range(len(codes)):
            for j in range(i):
                if (codes[i] ^ codes[j]).bit_count() <= limit and root[i] != root[j]:
                    low = min(root[i], root[j])
                    high = max(root[i], root[j])
                    root = [low if r == high else r for r in root]
                    changed = True
    return root


def simhash_rows():
    rnd = random.Random(3)
    word = [f"w{i}" for i in range(300)]
    rows = [(d, " ".join(rnd.choices(word, k=rnd.randint(3, 200)))) for d in range(60)]
    for d in range(60, 110):
        words = rows[rnd.randrange(10)][1].split()
        words[rnd.randrange(len(words))] = "edited"
        rows.append((d, " ".join(words)))
    return rows + [(110, None), (111, ""), (112, " \t"), (113, "One"), (114, "one"), (5, rows[5][1]), (None, "one"), (None, "alone here")]


@pytest.mark.parametrize("block", [4096, 4])
def test_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash.near_links, "__defaults__", (2, block))
    rows = simhash_rows()
    found = near_duplicates(docs_of(spark, [(d, t, "s") for d, t in rows])).collect()
    codes = [codes_by_hand(t) for _, t in rows]
    root = components_by_hand(codes)
    right = []
    for (d, _), code, r in zip(rows, codes, root, strict=True):
        ids = [i for (i, _), q in zip(rows, root, strict=True) if q == r and i is not None]
        right.append((d, code - (1 << 64) if code >> 63 else code, min(ids, default=None)))
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, right))


def test_keep_first(spark):
    rows = simhash_rows()
    docs = docs_of(spark, [(d, t, "s") for d, t in rows])
    kept = keep_first(docs)
    assert kept.columns == docs.columns
    roots = components_by_hand([codes_by_hand(t) for _, t in rows])
    assert kept.count() == len(set(roots))
    assert keep_first(docs.limit(0)).collect() == []
    assert near_duplicates(docs.limit(0)).collect() == []


def test_index_finds_all_links_in_a_dense_family():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, dtype=np.uint64)
    codes = np.unique(base ^ (rng.integers(0, 1 << 12, 900, dtype=np.uint64) << np.uint64(7)))
    members, visitors = codes[::2], codes[1::2]
    a, b = forest(members, visitors, 2)
    nodes = np.concatenate([members, visitors])
    root = {int(x): int(x) for x in nodes}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        root[top(x)] = top(y)
    near = np.bitwise_count(nodes[:, None] ^ members[None]) <= 2
    for i, j in zip(*np.nonzero(near), strict=True):
        assert top(int(nodes[i])) == top(int(members[j]))


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, 3), (3, 9), (50, 50), (9, 7), (200, 7)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    labels = {r["node"]: r["root"] for r in found}
    assert len(found) == len(labels)
    assert all(labels[i] == 100 for i in range(100, 141))
    assert {labels[x] for x in (3, 7, 9, 200)} == {3} and 50 not in labels


# -- toxicity ---------------------------------------------------------------------------------


def toxic_rows(n, seed):
    rnd = random.Random(seed)
    word = ["".join(rnd.choices("etaoinshrdlu", k=rnd.randint(2, 8))) for _ in range(500)]
    rows = []
    for d in range(n):
        words = rnd.choices(word, k=rnd.randint(5, 60))
        label = int(rnd.random() < 0.3)
        for _ in range(2 * label):
            words.insert(rnd.randrange(len(words)), rnd.choice(["nitwit", "blockhead", "numbskull"]))
        rows.append((d, " ".join(words), label))
    return rows


def test_kernel_is_a_similarity():
    words = [b"^idiot", b"^idiiot", b"^idixot", b"^table", b"^id"]
    got = kernel(words, words)
    assert np.allclose(np.diag(got)[:4], 1, atol=1e-5) and np.allclose(got, got.T, atol=1e-5)
    assert got[0, 1] > 0.6 and got[0, 2] > 0.5 and got[0, 3] < 0.1


def test_words_in_disguise():
    assert b"^idiot" in words_of("an I.D.I.O.T indeed")
    assert b"^idiot" in words_of("an i d i o t indeed")
    assert b"^idiot" in words_of("an id10t") and b"^idiot" in words_of("id-iot!!")
    assert words_of(None) == set() == words_of("")


def test_held_out_accuracy(spark):
    rows = toxic_rows(600, 5)
    docs = docs_of(spark, [(d, t, "s") for d, t, _ in rows] + [(None, None, "s"), (1, rows[1][1], "s")])
    labels = spark.createDataFrame(
        [(d, y) for d, _, y in rows] + [(None, 1), (9999, 0), (3, None)], "doc_id long, toxic int"
    )
    model = train_on(docs, labels)
    scored = score_toxicity(docs, model).withColumn("out", held_out("doc_id"))
    assert scored.columns[:6] == docs.columns
    right = {d: y for d, _, y in rows}
    tested = [(r["predicted"], right[r["doc_id"]]) for r in scored.collect() if r["out"] and r["doc_id"] is not None]
    assert np.mean([p == y for p, y in tested]) > 0.97
    tricks = model.scores(["you n-i-t-w-i-t and b l o c k h e a d", "nitwiit blockheaad", "a table", None, ""])
    assert (tricks[:2] > 0.5).all() and (tricks[2:] < 0.5).all()
    assert score_toxicity(docs.limit(0), model).collect() == []


def test_no_word_loses_the_kernel():
    landmarks = [b"^scum", b"^block", b"^numb", b"^blok", b"^idiot", b"^anna", b"^worthlessness"]
    rnd = random.Random(9)
    words = [b"^scumbag", b"^blockhead", b"^numbskull", b"^scm", b"^idt", b"^aaaa", b"^"]
    for _ in range(1500):
        mixed = bytearray(rnd.choice(landmarks)[1:])
        for _ in range(rnd.randint(0, 5)):
            at = rnd.randrange(len(mixed) + 1)
            mixed[at : at + rnd.randint(0, 1)] = bytes(rnd.choices(b"abcdeiklmnostuw", k=rnd.randint(0, 2)))
        words.append(b"^" + bytes(mixed)[:20])
    words = sorted({w for w in words if len(w) > 3})
    model = Model(landmarks, np.zeros(2 * len(landmarks)), 0.0, 1.0, 0.0)
    right = kernel(words, landmarks)
    near = np.concatenate([model._near(_padded([w])) for w in words])
    assert near[right >= FLOOR].all() and not near.all()
    model._learn_words(words)
    for word in (b"^scumbag", b"^blockhead", b"^numbskull"):
        got = np.zeros(len(landmarks)) if model.seen[word] is None else model.seen[word]
        alone = right[words.index(word)]
        assert (got >= np.where(alone >= FLOOR, alone, 0) ** POWER - 1e-3).all() and got.any()


def test_training_on_nothing(spark):
    model = train([], [])
    assert ((model.scores([None, "x"]) >= 0) & (model.scores([None, "x"]) < 0.5)).all()
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    docs = docs_of(spark, [(1, "text", "s")])
    assert score_toxicity(docs, train_on(docs, empty)).first()["predicted"] == 0


# -- neighbours -------------------------------------------------------------------------------


def neighbours_by_hand(rows, k=20):
    held = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            held.setdefault(i, v)
    ids = np.array(sorted(held))
    x = np.array([held[i] for i in ids.tolist()], dtype=float)
    out = {}
    for q in ids[ids % 20 == 0].tolist():
        scores = (x * np.array(held[q])).sum(axis=1)
        order = [ids[j] for j in np.lexsort((ids, -scores.round(9))) if ids[j] != q]
        out[q] = order[:k]
    return out


def test_neighbours_recall_and_order(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.4 * rng.normal(size=16)).tolist()) for i in range(900)]
    rows[5:9] = [(i, None if i == 5 else [0.0] * 16 if i == 6 else [float("nan")] + [1.0] * 15 if i == 7 else [None] + [1.0] * 15) for i in range(5, 9)]
    rows += [(1000 + i, rows[40][1]) for i in range(60)] + [(None, rows[1][1]), (20, rows[20][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    found = nearest(table, region=100).collect()
    right = neighbours_by_hand(rows)
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    assert set(got) == set(right)
    for q, hits in got.items():
        assert len(hits) == 20
        assert hits == sorted(hits, key=lambda h: (-h[0], h[1])) and q not in [v for _, v in hits]
    hit = sum(len({v for _, v in got[q]} & set(right[q])) for q in right)
    assert hit >= 0.9 * sum(map(len, right.values()))


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 0.0])], schema)
    assert [tuple(r) for r in nearest(few).orderBy("rank").collect()] == [(0, 1, 2, 1.0), (0, 2, 1, 0.5)]
    assert nearest(few.limit(0)).collect() == []
    assert nearest(spark.createDataFrame([(0, [1.0]), (7, None)], schema)).collect() == []
    # many queries meet many leaves of one region
    rng, doubles = np.random.default_rng(8), "vec_id long, embedding array<double>"
    cloud = [(i, (rng.normal(size=6) * 1e-170).tolist()) for i in range(600)]
    many = nearest(spark.createDataFrame(cloud, doubles), is_query=F.col("id") < 40, region=1000).collect()
    assert len(many) == 800 and {r[1] for r in many} == set(range(1, 21))
    far = spark.createDataFrame([(0, [1e200, 1.0]), (1, [1e-200, 0.0]), (2, [3.0, -1.0]), (20, [1e-200, 1e-200])], doubles)
    found = {(r[0], r[1]): (r[2], r[3]) for r in nearest(far).collect()}
    assert len(found) == 6 and found[0, 1] == (2, 3e200 - 1) and found[20, 1] == (0, 1.0)


def test_chi_square():
    assert chi_square_cdf(chi_square_point(0.9, 8), 8) == pytest.approx(0.9)
    assert chi_square_point(0.95, 2) == pytest.approx(5.991, abs=1e-2)


# -- personal data ----------------------------------------------------------------------------


def test_entities():
    text = "é a.b@c-d.example.com, 10.0.0.255 and 1.2.3.256; 4539 1488 0343 6467 or +1 (555) 123-4567"
    kinds = [(k, text[a:b]) for a, k, b, _ in entities(text)]
    assert kinds == [(0, "a.b@c-d.example.com"), (1, "10.0.0.255"), (2, "4539 1488 0343 6467"), (3, "+1 (555) 123-4567")]
    assert entities("a@b.c_x@d.ef")[1][:3] == (5, 0, 12)
    assert [x[:3] for x in entities("1.2.3.4.5.6.7.8")] == [(0, 1, 7), (8, 1, 15)]
    assert entities("4539148803436467 4539148803436467") == [] and entities("a@b") == []
    assert luhn("4539148803436467") and not luhn("4539148803436468")


def test_long_runs_take_linear_time():
    assert entities("1" * 200_000 + "a" * 200_000 + "@") == []


def test_sanitised_overlaps():
    assert sanitised("abcdef", [(1, 0, 4), (2, 3, 5)]) == "a<EMAIL>f"
    assert sanitised("abcdef", [(0, 4, 2), (4, 1, 6)]) == "cd<IP>"


def personal_rows():
    rnd = random.Random(7)
    word = ["".join(rnd.choices("abcdefghij", k=rnd.randint(3, 7))) for _ in range(200)]
    rows = []
    for d in range(60):
        words = rnd.choices(word, k=40)
        if d % 3 == 0:  # a nickname that stands only beside one address
            at = rnd.randrange(5, 30)
            words[at:at] = ["zorblax", "joe@mail.example.com", "writes"]
        rows.append((d, " ".join(words)))
    return rows + [(60, None), (61, ""), (62, "mail joe@mail.example.com"), (0, rows[0][1]), (None, "ip 1.2.3.4")]


def test_disclosing_terms(spark):
    rows = personal_rows()
    docs = docs_of(spark, [(d, t, "s") for d, t in rows])
    found = find_personal_data(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        text = next(t for d, t in rows if (None if d is None else str(d)) == r["id"]) or ""
        told = {text[s["start"] : s["end"]] for s in r["terms"]}
        assert ("zorblax" in told) == ("zorblax" in text)
        assert told <= {"zorblax", "writes"}
        assert [(s["start"], s["kind"], s["end"]) for s in r["spans"]] == [x[:3] for x in entities(text)]
    clean = {r["doc_id"]: r["text"] for r in sanitise(docs).collect()}
    assert "joe@" not in "".join(t or "" for t in clean.values()) and "zorblax" not in clean[0]
    assert clean[60] is None and clean[61] == "" and clean[1] == rows[1][1]
    assert clean[None] == "ip <IP>" and clean[62] == "mail <EMAIL>"


def test_sanitise_equals_plain_form(spark):
    text = "é joe@mail.example.com +1 (555) 123-4567, 10.0.0.1 end"
    docs = docs_of(spark, [(1, text, "s")])
    spans = [x[:3] for x in entities(text)]
    assert sanitise(docs).first()["text"] == sanitised(text, spans)
    assert sanitise(docs).columns == docs.columns
    assert find_personal_data(docs).select(listed(F.col("spans"))).first()[0].startswith("email:2:")
    assert sanitise(docs.limit(0)).collect() == [] and find_personal_data(docs.limit(0)).collect() == []


@pytest.mark.parametrize("slice_", [8, 0.001])
def test_copies_do_not_hide_terms(spark, monkeypatch, slice_):
    monkeypatch.setattr(pii, "_SLICE", slice_)
    rnd = random.Random(8)
    word = ["".join(rnd.choices("abcdefghij", k=rnd.randint(3, 7))) for _ in range(200)]
    say = lambda n: " ".join(rnd.choices(word, k=n))
    beside = [f"{say(9)} zorblax joe@mail.example.com writes {say(9)} zorblax {say(9)}" for _ in range(3)]
    # a whole text and a passage of one in other texts, copied often
    texts = beside + beside[:1] * 800 + [f"{say(5)} {beside[1]} {say(5)}" for _ in range(400)]
    # the window of an entity and nothing more of the passage
    own = [f"{say(5)} quux ann@mail.example.com {say(6)}" for _ in range(3)]
    texts += own + [f"{say(9)} {own[0]} {say(9)}" for _ in range(300)]
    # one wording around many entities: its words give none of them away
    texts += [f"please kindly mail to u{i % 150}@mail.example.com {say(6)}" for i in range(600)]
    texts += [f"please kindly mail to u{i}@mail.example.com or leave word here today" for i in range(200)]
    texts += [say(60) for _ in range(1500)]
    docs = docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)])
    found = {texts[int(r["id"])][s["start"] : s["end"]] for r in find_personal_data(docs).collect() for s in r["terms"]}
    assert {"zorblax", "writes", "quux"} <= found
    assert not found & {"please", "kindly", "mail"}
