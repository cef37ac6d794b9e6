"""The stages one by one against plain versions over their own input, and the whole run."""

import collections

import corpus_pipeline
from loanframe.llm.common import table
from loanframe.llm import mixing
from tests.llm.fixtures import LONG
from tests.llm.test_packing import check_sequences, plain_pieces
from tests.llm.test_simhash import plain_components, plain_fingerprint

FOLDER = "/root/testdata/sf0.001"


def test_stages_and_run(spark, tmp_path):
    docs = table(spark, FOLDER, "documents")
    extra = spark.createDataFrame([(10_001, None, None, None, None), (10_002, "", "en", "src1", 0), (10_003, "1 2 3", None, "src1", 5),
                                   (10_004, LONG, "en", None, len(LONG))], docs.schema)
    docs.unionByName(extra).write.parquet(f"{tmp_path}/documents.parquet")
    rows, frame = None, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in frame.collect()}
        copies = collections.Counter(r.doc_id for r in frame.collect())
        out = stage(spark, frame, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name.replace(' ', '-')}")
        frame = spark.read.parquet(f"{tmp_path}/{name.replace(' ', '-')}")
        rows = frame.collect()
        ids = collections.Counter(r.doc_id for r in rows)
        if name != "packing":
            assert frame.columns == docs.columns
            assert all(r.text == before[r.doc_id].text for r in rows)
        if name == "language ID":
            assert set(before) - set(ids) == {10_001, 10_002, 10_003} and set(ids.values()) == {1}
        elif name == "exact dedup":
            last = {}
            for i, r in before.items():
                last[r.text] = max(i, last.get(r.text, i))
            assert ids == collections.Counter(last.values())
        elif name == "SimHash near-dedup":
            want = plain_components({i: plain_fingerprint(r.text) for i, r in before.items()})
            assert ids == collections.Counter(set(want.values()))
        elif name == "mixing":
            plan = {r.doc_id: r.mix_copies for r in mixing.mix_plan(spark.createDataFrame(list(before.values()), docs.schema)).collect()}
            assert ids == collections.Counter(plan) - collections.Counter()
        else:
            want = [p for i, n in copies.items() for p in plain_pieces([(i, before[i].text)]) * n]
            assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
            assert check_sequences(rows) <= 1.02 * sum(r.length for r in rows) / 2048 + 1
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in whole.collect()) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in rows)


def test_documents_without_any_language_stay(spark):
    rows = [(i, t, None, "src", 3) for i, t in enumerate(["plain words", None, "", "1 2 3", "schöne Wörter", "éa"])]
    docs = spark.createDataFrame(rows, table(spark, FOLDER, "documents").select("doc_id", "text", "lang", "source", "n_chars").schema)
    out = corpus_pipeline.identified(spark, docs, FOLDER)
    assert out.columns == docs.columns
    assert sorted(map(repr, out.collect())) == sorted(map(repr, docs.filter("doc_id in (0, 4, 5)").collect()))


def test_run_on_awkward_tables(spark, tmp_path):
    """No rows; repeated rows, ids shared and missing, null and long texts; and columns under names the stages use."""
    from pyspark.sql import functions as F

    schema = table(spark, FOLDER, "documents").select("doc_id", "text", "lang", "source", "n_chars").schema
    a, b = " ".join(f"word{i} of" for i in range(300)), " ".join(f"other{i} the" for i in range(300))
    rows = [(1, a, "en", "s", 1), (1, a, "en", "s", 1), (1, b, "en", None, 1), (2, a, None, "s", 1), (None, b + " more", "en", "t", 1), (None, None, None, None, None),
            (3, "", "en", "s", 0), (4, "12 34", "en", "s", 0), (5, LONG, "en", "t", len(LONG)), (5, LONG, "en", "t", len(LONG))]
    given = spark.createDataFrame(rows, schema)
    names = ["digest", "keep_id", "row", "root", "fingerprint", "id_text", "mix_size", "copy", "length", "piece", "full", "lang_pred", "score"]
    results = {}
    for name, frame in (("empty", given.limit(0)), ("rows", given), ("clash", given.withColumns({n: F.lit("x") for n in names}))):
        frame.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        results[name] = sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect())
    assert results["empty"] == [] and results["rows"] == results["clash"]
    # of the equal texts a the largest id stays, of the near copies b that with an id; texts without a letter go
    kept = {plain for i, text in ((2, a), (1, b), (5, LONG)) for plain in [(str(i), *p[1:]) for p in plain_pieces([(i, text)])]}
    assert set(results["rows"]) <= kept and {r[0] for r in results["rows"]} <= {"1", "2", "5"} and results["rows"]
