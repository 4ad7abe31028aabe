"""How the test documents and pages are landed."""

import os

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from gridstats.sources import documents
from gridstats.testbed import documents as docs
from gridstats.testbed import queries as registered
from gridstats.testbed.roles import Roles

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("kind", docs.BY_ORDER)
def test_files_are_in_arrival_order(spark, kind):
    """By task and by place in it, without a sort of all; the documents are those of one task."""
    roles = Roles(spark, FOLDER)
    dealt = docs.landed(roles, kind, 5)
    assert "rangepartitioning" not in dealt._jdf.queryExecution().toString().lower()
    placed = dealt.withColumn("_at", F.monotonically_increasing_id()).collect()
    assert len({r["_at"] >> 33 for r in placed}) == 5
    in_order = sorted(placed, key=lambda r: r["_at"])
    assert [r["_seq"] for r in in_order] == sorted(r["_seq"] for r in in_order)
    plain = docs.ALL[kind](roles).collect()
    assert sorted((r["_seq"], r["value"]) for r in placed) == sorted((r["_seq"], r["value"]) for r in plain)


def test_documents_are_landed_compressed(spark, monkeypatch):
    seen = []
    write = documents.write_documents

    def watched(rows, path, *rest, **options):
        write(rows, path, *rest, **options)
        seen.append(path)

    monkeypatch.setattr(documents, "write_documents", watched)
    assert queries()["stream_drain"](spark, FOLDER).count() > 0
    names = [n for n in os.listdir(seen[0].removeprefix("file:")) if n.startswith("part-")]
    assert names and all(n.endswith(".gz") for n in names)


def test_a_request_reads_its_own_round_alone(spark, monkeypatch):
    """Pages of other rounds are not read, however many a task asks for."""
    places, pages_in = [], registered._pages_in
    monkeypatch.setattr(registered, "_pages_in", lambda path: places.append(path) or pages_in(path))
    queries()["scan_requests"](spark, FOLDER)
    stored = spark.read.parquet(places[0])
    pages = stored.groupBy("season", "round").agg(F.array_sort(F.collect_list("value")).alias("pages"))
    fetch = pages_in(places[0])
    for row in pages.orderBy("season", "round").limit(3).collect():
        assert sorted(fetch(row["season"], row["round"])) == row["pages"]
    folder = F.regexp_extract(F.input_file_name(), "(.*)/", 1).alias("folder")
    rounds = stored.select("season", "round", folder).distinct().collect()
    assert len({r["folder"] for r in rounds}) == len(rounds)
