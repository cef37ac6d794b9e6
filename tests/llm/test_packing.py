"""Pieces against the plain tokenizer, sequences against their own arithmetic and a lower bound."""

import collections
import math
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loanframe.llm import packing
from loanframe.llm.common import table
from loanframe.llm.queries import op5_best_fit_packing, vocabulary
from tests.conftest import SMALL
from tests.llm.fixtures import clashing, docs, same_rows


def plain_pieces(rows, capacity=2048):
    from tokenizers import Tokenizer

    model, out = Tokenizer.from_file(vocabulary()), []
    for doc_id, text in rows:
        ids = model.encode(text or "", add_special_tokens=False).ids + [0]
        for k, s in enumerate(range(0, len(ids), capacity)):
            own = ids[s:s + capacity]
            out.append((doc_id, k, s, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    return out


def check_sequences(rows, capacity=2048):
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_query_equals_plain_tokenizer(spark, folder):
    found = op5_best_fit_packing(spark, folder).collect()
    rows = [(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(plain_pieces(rows))
    bound = math.ceil(sum(r.length for r in found) / 2048)
    assert check_sequences(found) <= 1.02 * bound + 1


def test_awkward_rows(spark):
    given_rows = docs(spark)
    found = packing.pack_documents(given_rows, vocabulary()).collect()
    want = plain_pieces([(r.doc_id, r.text) for r in given_rows.collect()])
    assert sorted(map(repr, ((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found))) == sorted(map(repr, want))
    check_sequences(found)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert same_rows(packing.pack_documents(given_rows, vocabulary()).select(*names),
                     packing.pack_documents(clashing(given_rows), vocabulary()))
    assert packing.pack_documents(given_rows.limit(0), vocabulary()).count() == 0


def test_rounds_merge_what_tasks_leave(spark):
    sizes = [(int(x),) for x in np.random.default_rng(3).integers(1, 900, 4000)]
    rows = spark.createDataFrame(sizes, "length long").repartition(40)
    found = packing.pack(rows, 1000, most=300, fan=4).collect()
    assert sorted(r.length for r in found) == sorted(s for s, in sizes)
    best = len(packing.best_fit(np.array([s for s, in sizes]), 1000)[2])
    assert check_sequences(found, 1000) <= 1.03 * best


def test_items_that_cannot_merge_end(spark):
    rows = spark.createDataFrame([(600,)] * 3000, "length long").repartition(20)
    assert check_sequences(packing.pack(rows, 1000, most=200).collect(), 1000) == 3000


def test_forgetting_words_changes_nothing():
    texts = ["one two three", "two four", "", None, "five one"] * 3
    keep, forget = packing.Encoder(vocabulary()), packing.Encoder(vocabulary(), words_kept=1)
    for t in texts:
        assert list(next(keep.encode([t]))) == list(next(forget.encode([t])))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_places_everything(sizes):
    bin_of, offset, fill = packing.best_fit(np.array(sizes, np.int64), 50)
    for b in range(len(fill)):
        own = sorted((offset[i], sizes[i]) for i in range(len(sizes)) if bin_of[i] == b)
        assert [o for o, _ in own] == [sum(s for _, s in own[:k]) for k in range(len(own))] and sum(s for _, s in own) == fill[b] <= 50


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aAzZ'sSlLrReE09.,!-_ \t\n\x1c<|>\u00df\u00c9\u00e9\u00f7\u00d7\u00aa\u00b2\u0130\u03a3\u0301\u00a0\u2028"), st.characters(codec="utf-8")), max_size=40))
def test_chunks_encode_like_whole_texts(text):
    encoder = ENCODERS[0] if ENCODERS else ENCODERS.append(packing.Encoder(vocabulary())) or ENCODERS[0]
    assert next(encoder.encode([text])).tolist() == encoder.whole.encode(text, add_special_tokens=False).ids


ENCODERS: list = []


def test_a_worker_forgets_by_size():
    """Long texts without white space are one chunk each: what a worker remembers is bounded by characters, too."""
    encoder, other = packing.Encoder(vocabulary(), bytes_kept=5_000), packing.Encoder(vocabulary())
    texts = ["".join(chr(0x4E00 + (7 * i + j) % 900) for j in range(3000)) for i in range(6)] + ["plain words here"]
    for text in texts:
        (one,), (two,) = encoder.encode([text]), other.encode([text])
        assert one.tolist() == two.tolist() and encoder.size_kept <= 8_000
