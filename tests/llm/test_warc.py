"""Archives are written, read back and agree with SQL and with a plain gzip reader."""

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from loanframe.llm import warc
from loanframe.llm.common import new_folder
from loanframe.llm.queries import oracle_sql, queries
from tests.compare import compare, connect
from tests.conftest import SMALL
from tests.llm.fixtures import same_rows

PAGES = [(1, "http://a/ b\r\nX: y", "<p>é😀</p>"), (2, None, "<p>é😀</p>"), (3, "http://c", None), (4, "http://d", ""), (5, "http://e", "a\r\n\r\nb\r\n\r\n"),
         (6, "http://f", "x" * 300_000), (6, "http://f", "x" * 300_000), (None, "http://g", "<p>é😀</p>"), (None, "http://h", "alone")]


def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string")


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, folder):
    assert compare(queries()["op10_warc"](spark, folder), connect(folder), oracle_sql()["op10_warc"]) is None


def written(spark, rows=None, **settings):
    return warc.write(warc.records(pages(spark) if rows is None else rows, **settings), new_folder(spark, "warc-test"))


def test_round_trip(spark):
    found = warc.read(written(spark)).collect()
    first = {}
    for i, _, html in PAGES:
        first[html or ""] = min((x for x in (first.get(html or ""), i) if x is not None), default=None)
    want = []
    for i, url, html in PAGES:
        text = html or ""
        again = first[text] is not None and i != first[text]
        digest = base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()
        want.append((i, len(text.encode()), digest, "revisit" if again else "response", first[text] if again else None, None if again else text))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload) for r in found]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert {r.page_id: r.url for r in found}[1] == "http://a/%20b%0D%0AX:%20y"


def test_small_payloads_are_all_responses(spark):
    kinds = {(r.page_id, r.record_type) for r in written(spark, least=100).collect()}
    assert {k for i, k in kinds if i in (1, 2, 3, 4)} == {"response"}


def test_index_places_records_one_after_another(spark):
    index = written(spark).collect()
    for archive in {r.archive for r in index}:
        data, at = open(archive.removeprefix("file://").removeprefix("file:"), "rb").read(), 0
        for r in sorted((r for r in index if r.archive == archive), key=lambda r: r.offset):
            assert r.offset == at and gzip.decompress(data[at:at + r.length]).startswith(b"WARC/1.0\r\nWARC-Type: ")
            at += r.length
        assert at == len(data)


def test_selected_records_and_columns_that_clash(spark):
    index = written(spark)
    assert sorted(r.page_id for r in warc.read(index.filter("page_id in (2, 5)"), payload=False).collect()) == [2, 5]
    more = pages(spark).withColumns({c: F.lit("clash") for c in ("payload", "same", "first", "n", "archive", "digest")})
    assert same_rows(warc.read(index), warc.read(written(spark, more)))
    assert warc.read(written(spark, pages(spark).limit(0))).count() == 0


def test_runs_join_near_records_only():
    offset, length, archive = [0, 10, 20, 500_000, 0], [10, 10, 10, 5, 4], ["a"] * 4 + ["b"]
    assert list(warc._runs(offset, length, archive)) == [(0, 3), (3, 4), (4, 5)]


def test_read_back_is_dealt_by_bytes(spark):
    index = written(spark)
    total = index.agg(F.sum("length")).first()[0]
    few, many = warc.read(index, bytes_per_task=10 * total), warc.read(index, bytes_per_task=total // 4)
    assert few.rdd.getNumPartitions() == 1 and many.rdd.getNumPartitions() > 2 and same_rows(few, many)
