"""Clashing column names, hostile inputs, bounds of samples, and the pipeline against plain versions."""

import inspect
import itertools
import re
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from gridstats.llm import (
    decontaminate,
    html_text,
    mixing,
    pii,
    secret_scan,
    simhash,
    toxicity,
    url_filter,
)
from gridstats.llm.toxicity import DECAY, ORDER, _padded, raw_kernel

TEXT = "write to ann@example.org or 10.0.0.1, password=abcdef1 " + " ".join(f"w{i}" for i in range(20))
ROWS = [(1, TEXT, "a"), (2, None, None), (3, "", "a"), (3, "", "a"), (None, TEXT, "b")]


def helpers_of(module):
    """Every name with an underscore that the module's code could use for a column of its own."""
    return sorted(set(re.findall(r"""["'](_[a-z]+0?|[a-z]+_)["']""", inspect.getsource(module))))


def crowded(spark, module, rows, schema):
    """The rows with a column of each helper's name."""
    docs = spark.createDataFrame(rows, schema)
    names = [c for c in helpers_of(module) if c not in docs.columns]
    return docs.withColumns({c: F.lit(f"mine {c}") for c in names}), names


OPERATORS = {
    "decontaminate": (
        decontaminate,
        lambda d: decontaminate.decontaminate(
            d, d.sparkSession.createDataFrame([("i", TEXT)], "item_id string, text string")
        ),
    ),
    "scan_secrets": (secret_scan, secret_scan.scan_secrets),
    "score_toxicity": (
        toxicity,
        lambda d: toxicity.score_toxicity(d, toxicity.train(["bad idiot"] * 9 + ["good day"] * 9, [1] * 9 + [0] * 9)),
    ),
    "sanitise": (pii, pii.sanitise),
    "mix_rows": (mixing, mixing.mix_rows),
    "keep_first": (simhash, simhash.keep_first),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_columns_named_like_helpers_stay(spark, name):
    module, run = OPERATORS[name]
    docs, names = crowded(spark, module, ROWS, "doc_id long, text string, source string")
    out = run(docs)
    assert set(docs.columns) <= set(out.columns)
    for row in out.collect():
        assert {c: row[c] for c in names} == {c: f"mine {c}" for c in names}


@pytest.mark.parametrize("name", ["filter_urls", "extract_text"])
def test_page_columns_named_like_helpers_stay(spark, name):
    module = {"filter_urls": url_filter, "extract_text": html_text}[name]
    rows = [(1, "https://a.example.com/en/x", "<p>text</p>"), (2, None, None)]
    docs, names = crowded(spark, module, rows, "page_id long, url string, html string")
    out = getattr(module, name)(docs).collect()
    assert len(out) == 2
    for row in out:
        assert {c: row[c] for c in names} == {c: f"mine {c}" for c in names}


def test_text_column_named_like_a_helper(spark):
    docs = spark.createDataFrame([(1, TEXT)], "doc_id long, _text string")
    assert len(secret_scan.scan_secrets(docs, text_column="_text").first()["secrets"]) == 1
    assert "<EMAIL>" in pii.sanitise(docs, text_column="_text").first()["_text"]
    items = spark.createDataFrame([("i", TEXT)], "item_id string, text string")
    judged = decontaminate.decontaminate(docs, items, text_column="_text", keep=["_text"]).first()
    assert judged["contaminated"] and judged["_text"] == TEXT


def test_equal_rows_are_numbered_by_parts(spark):
    rows = spark.range(0, 90, 1, 6).select((F.col("id") % 3).alias("b"))
    rows = rows.withColumn("a", F.when(F.col("b") == 0, F.lit(1)))
    numbers = mixing._numbered(rows, ["a", "b"]).groupBy("a", "b").agg(F.sort_array(F.collect_list("_number")).alias("n"))
    assert [r["n"] for r in numbers.collect()] == [list(range(1, 31))] * 3


# -- secrets ----------------------------------------------------------------------------------


def test_token_starts_take_linear_time():
    """Counted in Python: the expression is the one that Spark runs."""
    rule = next(r for r in secret_scan.MORE_RULES if r.kind == "jwt")
    spent = []
    for times in (20_000, 160_000):
        start = time.perf_counter()
        for m in re.finditer(rule.regex, "eyJ" * times):
            assert m[rule.group] == ""
        spent.append(time.perf_counter() - start)
    assert spent[1] < 32 * spent[0] + 0.5


def test_token_matches_are_those_of_the_plain_expression():
    rule = next(r for r in secret_scan.MORE_RULES if r.kind == "jwt")
    part = r"[A-Za-z0-9_-]{8,}"
    plain = re.compile(rf"eyJ{part}\.{part}\.{part}")
    rnd = np.random.default_rng(5)
    pieces = ["eyJ", "a" * 8, "b" * 5, ".", ".", " ", "eyJabcdefgh", "."]
    found = 0
    for _ in range(4000):
        text = "".join(rnd.choice(pieces, rnd.integers(1, 14)))
        kept = [m.span() for m in re.finditer(rule.regex, text) if len(m[rule.group]) >= rule.least]
        assert kept == [m.span() for m in plain.finditer(text)]
        found += len(kept)
    assert found > 50


# -- toxicity ---------------------------------------------------------------------------------


def kernel_by_hand(a, b):
    """Every pair of equal subsequences, each weighed by the lengths it spans."""
    total = 0.0
    for i in itertools.combinations(range(len(a)), ORDER):
        for j in itertools.combinations(range(len(b)), ORDER):
            if all(a[x] == b[y] for x, y in zip(i, j, strict=True)):
                total += DECAY ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
    return total


def test_kernel_equals_enumeration():
    rnd = np.random.default_rng(3)
    for _ in range(40):
        a, b = (bytes(rnd.choice(list(b"abc"), rnd.integers(1, 9)).tolist()) for _ in range(2))
        assert raw_kernel(_padded([a]), b)[0] == pytest.approx(kernel_by_hand(a, b), rel=1e-5, abs=1e-9)


def test_training_sample_is_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, labels: seen.append(list(zip(labels, texts, strict=True))))
    ids = [d for d in range(60) if int(spark.range(1).select(F.crc32(F.lit(str(d))) % 5).first()[0])]
    rows = [(d, f"text {d}") for d in ids] + [(ids[0], f"another {i}") for i in range(50)]
    rows += [(ids[1], "x" * 1000)]
    docs = spark.createDataFrame([*rows, (ids[2], None)], "doc_id long, text string")
    labels = spark.createDataFrame([(d, d % 2) for d in ids], "doc_id long, toxic int")
    toxicity.train_on(docs, labels)
    assert len(seen[-1]) == len(ids) and sorted(t for _, t in seen[-1] if t.startswith("another")) == ["another 0"]
    toxicity.train_on(docs, labels, rows=1)
    assert sorted(n for n, _ in seen[-1]) == [0, 1]
    toxicity.train_on(docs, labels, most_bytes=160)
    for value in (0, 1):
        size = sum(len(t) for n, t in seen[-1] if n == value)
        assert 100 < size <= 160


# -- pipeline ---------------------------------------------------------------------------------


def near_groups(texts):
    """Smallest id of each group of near copies, by comparing every pair of fingerprints."""
    prints = {}
    for d, text in texts.items():
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        votes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[d] = sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in votes) > len(votes))
    root = {d: d for d in prints}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(prints, 2):
            if (prints[a] ^ prints[b]).bit_count() <= 2 and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    return root


def hit_share(text, windows):
    words = re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit = set()
    for window in windows:
        size = len(window)
        for i in range(len(words) - size + 1):
            if words[i : i + size] == window:
                hit.update(range(i, i + size))
    return len(hit), len(words)


def test_pipeline_stages_equal_plain_versions(spark, tmp_path):
    """Planted toxic documents, copies, benchmark passages and personal data; clean ones stay."""
    rnd = np.random.default_rng(11)
    words = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(500)]

    def prose(n):
        return " ".join(rnd.choice(words, n))

    texts, toxic = {}, set()
    for d in range(120):
        texts[d] = prose(60)
        if d % 6 == 0:
            toxic.add(d)
            texts[d] += " you stupid idiot get lost moron"
    passage = prose(13)
    texts[1] = prose(600)
    texts[200] = texts[1] + "!"  # one shingle of 598 differs
    texts[201] = texts[7]
    texts[202] = prose(30) + " " + passage.upper() + " " + prose(30)
    texts[203] = prose(400) + " " + passage  # 13 of 413 words are too few
    texts[204] = prose(40) + " ann.lee@mail.example.org " + prose(10) + " 10.20.30.40"
    texts[205], texts[206] = None, ""
    docs = spark.createDataFrame(
        [(d, t, "en", f"s{d % 3}", len(t or "")) for d, t in texts.items()],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(d, int(d in toxic)) for d in texts]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = spark.createDataFrame([("i1", passage), ("i2", None)], "item_id string, text string")
    items.write.parquet(f"{folder}/benchmark.parquet")

    names = [n for n, _ in corpus_pipeline.STAGES]
    stages = dict(corpus_pipeline.STAGES)

    def after(name, kept):
        out = stages[name](spark, docs.where(F.col("doc_id").isin(list(kept))), folder)
        assert out.columns == docs.columns
        return {r["doc_id"]: r for r in out.collect()}

    kept = after(names[0], texts)
    assert set(kept) == set(texts) - toxic
    groups = near_groups({d: texts[d] for d in kept})
    assert groups[200] == 1 and groups[201] == 7 and groups[206] == 205
    copies = after(names[1], kept)
    assert set(copies) == set(groups.values()) and {200, 201, 206}.isdisjoint(copies)
    shares = {d: hit_share(texts[d], [passage.split()]) for d in copies}
    clean = after(names[2], copies)
    assert set(clean) == {d for d, (hit, n) in shares.items() if not (hit and 20 * hit >= n)}
    assert 202 not in clean and 203 in clean
    tidy = after(names[3], clean)
    for d, row in tidy.items():
        plain = (texts[d] or "").replace("ann.lee@mail.example.org", "<EMAIL>").replace("10.20.30.40", "<IP>")
        assert (row["text"] or "") == plain and row["n_chars"] == (None if row["text"] is None else len(plain))
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(rows) <= set(tidy)
    sizes = {d: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for d, r in tidy.items()}
    assert all(r["size"] == sizes[d] and 0 < r["taken"] <= 3 * r["size"] for d, r in rows.items())
    for source in ("s0", "s1", "s2"):
        own = sum(n for d, n in sizes.items() if f"s{d % 3}" == source)
        mine = [r for d, r in rows.items() if f"s{d % 3}" == source]
        assert {r["source_size"] for r in mine} == {own}
        assert sum(r["taken"] for r in mine) == pytest.approx(mine[0]["target"], abs=450)
