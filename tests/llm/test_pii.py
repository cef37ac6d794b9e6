"""Base spans against the plain patterns, and what the trees add."""

import hashlib
import random
import re

import pytest

from loanframe.llm import pii
from loanframe.llm.common import table
from loanframe.llm.queries import op6_pii
from tests.conftest import SMALL
from tests.llm.fixtures import LONG, clashing, docs, same_rows

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_spans(text):
    out = []
    for n, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if fine:
                out.append((m.start(), n, m.end(), kind))
    return sorted(out)


def check(rows, texts):
    for r in rows:
        want = plain_spans(texts[r.doc_id])
        listed = ",".join(f"{k}:{s}:{e}" for s, _, e, k in want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for *_, k in want) for kind in PLAIN], r
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), (r, want)
        assert set(listed.split(",")) - {""} <= set(r.spans.split(","))


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_query_equals_plain_patterns(spark, folder):
    texts = {r.doc_id: r.text for r in table(spark, folder, "documents").collect()}
    found = op6_pii(spark, folder).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts)
    check(found, texts)
    for r in found:                                # texts without a digit or an at sign are left alone
        if not re.search("[0-9@]", texts[r.doc_id] or ""):
            assert r.spans == ""


def test_patterns_on_random_marks(spark):
    rng = random.Random(3)
    texts = {i: "".join(rng.choice("a.-@+ ()019%é\n") for _ in range(rng.randrange(60))) for i in range(3000)}
    texts |= {5000: "a@b.c.d%x@y.z", 5001: "1.2.3.4.5.6.7.8 000255.0.0.1 256.1.1.1", 5002: "4111 1111-1111 1111 4111111111111111",
              5003: "+1 (509) 555-6973 +12 3", 5004: "é😀 x@y.de", 5005: "1" * 100_000 + "." + "a" * 100_000 + "@", 5006: "a@b" + ".c" * 50_000,
              5007: "+" + "1 " * 50_000, 5008: LONG, 5009: "@@a@b..c a@-.-"}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(pii.summary(pii.spans(frame)).collect(), texts)


def test_trees_add_what_failed_runs_hide(spark):
    rng = random.Random(4)

    def card():
        d = [rng.randrange(10) for _ in range(15)]
        return next("".join(map(str, d + [x])) for x in range(10) if luhn("".join(map(str, d + [x]))))

    def line(i):
        parts = [card(), f"1.2.3.{i % 200}", str(rng.randrange(10**15, 10**16)), f"+1 (509) 555-{1000 + i}", "mail", "x-y", "(so)", "1,5", "and+"]
        return " word ".join(rng.sample(parts, rng.randrange(1, 6)))

    texts = {i: line(i) for i in range(1500)}
    texts[8000] = "call +1 (509) 555-6973 now"
    texts[9000] = f"two numbers {card()} {card()} in a row"
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r for r in pii.summary(pii.spans(frame)).collect()}
    check(found.values(), texts)
    assert found[9000].n_card == 0 and found[9000].spans == "card:12:28,card:29:45"
    clean = {r.doc_id: r.text for r in pii.redacted(frame).collect()}
    assert clean[9000] == "two numbers [CARD] [CARD] in a row"
    assert clean[8000] == "call [PHONE] now"


FORMS = {"phone": ["({a}) {b}-{c}", "{a}-{b}-{c}", "{a}.{b}.{c}", "1 ({a}) {b}-{c}", "1-{a}-{b}-{c}"],
         "email": ["{n} [at] {h} [dot] com", "{n}(at){h}.com", "{n} at {h} dot org", "{n}[at]{h}[dot]net", "{n} (AT) {h} (DOT) com"], "card": ["{k}"]}
DECOYS = ["2024-01-15", "12:30:45", "1,234,567", "978-3-16-148410-0", "version 1.2.3.4.5", "3.14159265", "room 1204 5518", "look at the dot on it", "10 20 30 40", "meet me at home.today we go",
          "15.03.2021", "4111 1111 1111 1112", "page 12-14", "0.5.7", "id 5095556973", "01.02.03", "at noon dot the i", "19 02 1999"]


def planted(seed, n):
    """Texts with base spans to learn from, texts with disguised ones, and texts with decoys: {id: (text, [(kind, start, end)])}."""
    rng, texts = random.Random(seed), {}
    number = lambda k: "".join(rng.choice("23456789") for _ in range(k))
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8)))
    prose = lambda: " ".join(word() for _ in range(rng.randrange(2, 7)))
    for i in range(n):
        if i % 3 == 0:
            base = rng.choice([f"+1 ({number(3)}) {number(3)}-{number(4)}", f"{word()}.{word()}@{word()}.com", f"10.{rng.randrange(255)}.3.{rng.randrange(255)}"])
            texts[i] = (f"{prose()} {base} {prose()}", None)
        elif i % 3 == 1:
            kind = rng.choice(["phone", "email"])
            form = rng.choice(FORMS[kind]).format(a=number(3), b=number(3), c=number(4), n=word(), h=word())
            lead = prose() + " "
            texts[i] = (f"{lead}{form}, {prose()}", [(kind, len(lead), len(lead) + len(form))])
        else:
            texts[i] = (f"{prose()} {rng.choice(DECOYS)} {prose()}", [])
    return texts


def test_disguised_spans_are_found(spark):
    """Numbers without plus sign and written-out addresses are added, other digits and words are not."""
    texts = planted(11, 1800)
    frame = spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id long, text string")
    rows = pii.summary(pii.spans(frame)).collect()
    check(rows, {i: t for i, (t, _) in texts.items()})
    right = wrong = wanted = 0
    for r in rows:
        want = texts[r.doc_id][1]
        if want is None:
            continue
        got = {(k, int(s), int(e)) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)}
        wanted += len(want)
        right += len(got & set(want))
        base = {(k, s, e) for s, _, e, k in plain_spans(texts[r.doc_id][0])}        # "1.2.3.4.5" holds one
        wrong += len(got - set(want) - base)
    print("recall", right / wanted, "precision", right / (right + wrong))
    assert right >= 0.95 * wanted and right >= 0.97 * (right + wrong)


def test_added_spans_that_overlap_all_stay(spark, monkeypatch):
    from pyspark.sql import functions as F

    # A 0-12 overlaps B 10-24, B overlaps C 22-34, and A and C nothing else; every candidate passes
    monkeypatch.setattr(pii, "PROPOSED", {"email": "^aaaaa.{7}", "ip": "(?<=^.{10}).{14}", "card": "(?<=^.{22}).{12}", "phone": "zzz"})
    monkeypatch.setattr(pii, "_valid", lambda kind, text: F.lit(True))
    monkeypatch.setattr(pii, "_plain_signs", lambda text: F.lit("a.com"))
    monkeypatch.setattr(pii, "_AT", "a")
    monkeypatch.setattr(pii, "HINT", {k: "." for k in pii.KINDS})
    monkeypatch.setattr(pii, "fit", lambda rows, at_most: (None, {k: 0.0 for k in pii.KINDS}))
    monkeypatch.setattr(pii, "_with_score", lambda candidates, model: candidates.withColumn("chance", F.lit(1.0)))
    frame = spark.createDataFrame([(1, "aaaaabbbbbcccccdddddeeeeefffffggggg tail")], "doc_id long, text string")
    assert pii.summary(pii.spans(frame)).first().spans == "email:0:12,ip:10:24,card:22:34"
    assert pii.redacted(frame).first().text == "[EMAIL]g tail"


def test_awkward_rows(spark):
    given = docs(spark)
    found = pii.summary(pii.spans(given))
    assert found.count() == given.count() and all(r.spans == "" for r in found.collect())
    assert same_rows(found, pii.summary(pii.spans(clashing(given))))
    assert pii.summary(pii.spans(given.limit(0))).count() == 0 and pii.redacted(given.limit(0)).count() == 0


def test_main_path_has_no_python(spark):
    frame = table(spark, SMALL, "documents")
    plan = pii.summary(pii.spans(frame))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_thresholds_come_from_all_examples(spark, monkeypatch):
    from pyspark.sql import functions as F

    # more examples than the 20 000 that were once sampled
    rows = spark.range(30_000).select(
        F.lit("phone").alias("kind"), F.col("id").alias("start"), (F.col("id") % 10 < 5).cast("double").alias("label"),
        *[((F.col("id") % 10) if c == "digits" else F.lit(0)).cast("double").alias(c) for c in pii.FEATURES])
    seen = {}
    scored = pii._with_score

    def counted(candidates, model):
        seen["held"] = candidates.agg(F.sum("n")).first()[0]
        return scored(candidates, model)

    monkeypatch.setattr(pii, "_with_score", counted)
    model, limits = pii.fit(rows)
    assert "phone" in limits and 0.25 * 30_000 < seen["held"] < 0.35 * 30_000
    assert model.getWeightCol() == "n"
