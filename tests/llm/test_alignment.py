"""Aligned tokens against a plain walk over byte offsets."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanframe.llm import alignment
from loanframe.llm.queries import queries, vocabulary
from tests.conftest import SMALL
from tests.llm.fixtures import LONG, ODD, clashing, docs

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


def plain(rows):
    """(doc_id, text) rows: the contract, token by token."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    first = Tokenizer.from_file(vocabulary(A))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=vocabulary(B))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in printable)}
    del decoders
    done, holders = [], Counter()
    for doc_id, text in rows:
        text = text or ""
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        bytes_a = [bytes(byte_of[c] for c in first.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [second.id_to_piece(i)]]
        raw = (" " + text).encode()
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            done.append((doc_id, [], [], 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        common = sorted(set(ends_a) & set(ends_b))
        group = lambda ends, ids, at: [i for i, e in zip(ids, ends) if (common[at - 1] if at else 0) < e <= common[at]]
        if len(raw) < 5000:
            text_of = ";".join(",".join(map(str, group(ends_a, a, g))) + "|" + ",".join(map(str, group(ends_b, b, g))) for g in range(len(common)))
        else:
            parts, i, j = [], 0, 0
            for end in common:
                x, y = [], []
                while i < len(a) and ends_a[i] <= end:
                    x.append(a[i]); i += 1
                while j < len(b) and ends_b[j] <= end:
                    y.append(b[j]); j += 1
                parts.append(",".join(map(str, x)) + "|" + ",".join(map(str, y)))
            text_of = ";".join(parts)
        links, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            links.append((a[i], b[j]))
            ea, eb = ends_a[i], ends_b[j]
            i, j = i + (ea <= eb), j + (eb <= ea)
        holders.update(set(links))
        done.append((doc_id, a, b, len(common), links, hashlib.sha256(text_of.encode()).hexdigest()))
    most = defaultdict(int)
    for (x, _), n in holders.items():
        most[x] = max(most[x], n)
    return sorted(repr((d, len(a), len(b), n, len(links), sum(holders[p] == most[p[0]] for p in links), sum(holders[p] for p in links), sha)) for d, a, b, n, links, sha in done)


def found(df, **limits):
    out = alignment.align(df, vocabulary(A), vocabulary(B), **limits).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted(repr(tuple(r)) for r in out.collect())


def test_query_on_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert sorted(repr(tuple(r)) for r in queries()["op12_token_alignment"](spark, SMALL).collect()) == plain(rows)


ROWS = [*ODD, (20, "a▁b", None, None, 1), (21, "<s> </s> <unk> <|endoftext|>", None, None, 1), (22, "日本語と한국어 and עברית 👩‍👩‍👧", None, None, 1),
        (23, "\x00\x01 tab\tline\r\n   spaces   ", None, None, 1), (24, "ﬁ é ½ ", None, None, 1), (25, "\U0001fae8 newer", None, None, 1),
        (26, " leading", None, None, 1), (27, "x" * 3000, None, None, 1), (5, LONG, "en", None, None)]


def test_awkward_texts(spark):
    df = docs(spark, ROWS)
    want = plain([r[:2] for r in ROWS])
    assert found(df) == want
    assert found(clashing(df).repartition(3), part_bytes=200, part_pairs=40) == want
    assert found(df.limit(0)) == [] and len(found(df.filter("text is null or text = ''"))) == 2


def test_latin_texts_are_encoded_alike():
    """The faster library gives the ids of the whole tokenizer wherever it is used."""
    import random

    words = alignment.Vocabularies(vocabulary(A), vocabulary(B))
    rng = random.Random(4)
    pool = [chr(c) for c in range(0x250)] + list(" \n\t'aeist09") * 40
    for _ in range(2000):
        text = " " + "".join(rng.choices(pool, k=rng.randint(1, 60)))
        assert words.latin.encode_ordinary(text) == words.whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(5))
def test_pointers_end_where_both_end(seed):
    rng = np.random.default_rng(seed)
    total = 400
    ends = [np.append(np.sort(rng.choice(np.arange(1, total), n, replace=False)), total) for n in (150, 90)]
    last_a, last_b = alignment.terminals(*ends)
    common = np.intersect1d(*ends)
    for end, last in zip(ends, (last_a, last_b)):
        np.testing.assert_array_equal(ends[0][last], common[np.searchsorted(common, end)])


def test_pair_counts(spark):
    named = spark.createDataFrame([(0, 0, 7 * 10 + 1, 3), (1, 0, 71, 2), (0, 1, 72, 5), (1, 1, 85, 1)], "part long, place long, pair long, held long")
    assert {tuple(r) for r in alignment.pair_counts(named, 10).collect()} == {(71, 5, True), (72, 5, True), (85, 1, True)}
    assert F is not None
