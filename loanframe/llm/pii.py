"""Personal data: base spans by fixed patterns, and further spans by boosted trees over candidates.

Base spans are the leftmost matches of four patterns that pass their checks.  High-recall generators propose further,
possibly overlapping spans: numbers without a plus sign, written-out at signs and dots, valid numbers inside longer runs.
Boosted trees score these by their format and their context.  No table marks such spans, so the trees learn from what the
base patterns know with its tell-tale taken away: base phone numbers without plus sign and country, base addresses whatever
their signs are written as, base cards regrouped.  They are told from the same digits in other layouts (dates, times,
prices, lists, bare runs), from cards that fail their check, from addresses without a plausible ending, and from all
candidates of the table that fail a check of their kind.  All of these are learned from but a part, equal ones once with
their number; on the part that was held back the threshold of each kind is set so that the wanted share of what passes is right.  Base spans always stay;
a candidate that overlaps none of them and passes its threshold is added, also where it overlaps another one that is added.

Everything runs as column expressions, windows and ``pyspark.ml`` trees.  Positions come from splitting the text at its
matches: the lengths of the parts and of the matches, summed up per text.

Defined results: a null text counts as the empty one; a text without spans has counts of zero, an empty list and the
hash of ''; repeated rows are scanned each; a table without base spans has nothing to learn from and gets no other
spans; an empty table gives an empty one; only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanframe.llm.common import bounded_sample, hash_share, stored

KINDS = ["email", "ip", "card", "phone"]
# The base patterns.  Where a repetition must not give back, it is possessive, and a match begins at the first
# character of a run or where the last match ended: the same matches, in time linear in the text.
_NAME, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:(?<!{_NAME})|\G){_NAME}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Generators of candidates: at signs and dots in brackets or as words, single numbers inside longer runs, numbers without a plus sign.
_AT = r"(?:@|\x20?[\[({]\x20?(?i:at)\x20?[\])}]\x20?)"
_DOT = r"(?:\.|\x20?[\[({]\x20?(?i:dot)\x20?[\])}]\x20?)"
_LABEL = rf"{_HOST}{{1,63}}+"
PROPOSED = {
    "email": rf"(?<!{_NAME}){_NAME}{{1,64}}+(?:{_AT}{_LABEL}(?:{_DOT}{_LABEL}){{1,8}}+|\x20(?i:at)\x20{_LABEL}(?:\x20(?i:dot)\x20{_LABEL}){{1,8}}+)",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9-])(?:[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{12,19})(?![0-9-])",
    "phone": r"(?<![0-9.,:/-])(?:\+?[0-9]{1,3}[ .-])?(?:\([0-9]{2,5}\)[ .-]?|[0-9]{2,5}[ .-])[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![0-9]|[.,:/-][0-9])",
}
HINT = {"email": r"@|(?i:[\[({]\x20?at\x20?[\])}]|\x20at\x20.*\x20dot\x20)", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
WORDS = {
    "email": "mail|contact|write|@", "ip": "ip|host|server|addr", "card": "card|visa|credit|pay|account|iban", "phone": "tel|phone|call|mobile|fax|contact",
}
# fixed values: endings that an address written in words may have; other words after "dot" are prose
ENDINGS = "com org net edu gov mil int info biz io dev app co de fr es it uk eu us ch at nl be pl pt se no dk fi ie ca au nz jp cn in br mx".split()
PRECISION = 0.98       # wanted of what passes a threshold
CONTEXT = 24           # characters before and after a candidate
FEATURES = [
    "kind_no", "digits", "letters", "groups", "first_group", "last_group", "longest_group", "shortest_group", "round_brackets", "blanks", "hyphens", "dots", "others", "luhn", "largest",
    "ending", "name", "distinct", "letter_before", "letter_after", "digit_before", "digit_after", "word_before", "symbols_around", "digits_around",
]


def luhn(digits: Column) -> Column:
    """Whether a text of at most 19 digits passes the Luhn check."""
    def worth(place: Column) -> Column:
        x = F.substring(digits, -place, F.lit(1)).cast("int") * F.when(place % 2 == 0, 2).otherwise(1)
        return F.when(x > 9, x - 9).otherwise(x)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), worth), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]+", "")


def _is_card(text: Column) -> Column:
    d = _digits(text)
    return F.when(F.length(d).between(12, 19), luhn(d)).otherwise(F.lit(False))


def _octets_fit(text: Column) -> Column:
    def fits(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return F.when(F.length(bare) > 3, F.lit(False)).otherwise(F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(text, "\\."), fits)


def _valid(kind: str, text: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return _octets_fit(text)
    return _is_card(text) if kind == "card" else F.length(_digits(text)).between(9, 15)


def _matches(text: Column, kind: str, pattern: str, base: bool) -> Column:
    """All leftmost matches as (kind, base, number, gap, match, before, after); empty where the text has no hint of any."""
    parts, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    each = F.transform(found, lambda m, i: F.struct(
        F.lit(kind).alias("kind"), F.lit(base).alias("base"), i.alias("number"), F.length(parts[i]).alias("gap"), m.alias("match"),
        F.right(parts[i], F.lit(CONTEXT)).alias("before"), F.left(parts[i + 1], F.lit(CONTEXT)).alias("after")))
    kind_of = "array<struct<kind:string,base:boolean,number:int,gap:int,match:string,before:string,after:string>>"
    return F.when(text.rlike(HINT[kind]), each.cast(kind_of)).otherwise(F.array().cast(kind_of))


def found_spans(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, kind, base, start, end, match, before, after); a text without any match has one row of nulls.

    ``base`` tells a valid base span from a candidate; base matches that fail their check are gone.  ``rid`` numbers the
    rows of ``docs``.
    """
    # numbered before the texts are exploded, so that all matches of a row share its number
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    each = [_matches(text, k, p, base) for patterns, base in ((BASE, True), (PROPOSED, False)) for k, p in patterns.items()]
    rows = rows.select("rid", "doc_id", F.explode_outer(F.concat(*each)).alias("m"))
    rows = rows.select("rid", "doc_id", "m.*")
    so_far = Window.partitionBy("rid", "kind", "base").orderBy("number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.length("match")).over(so_far)).withColumn("start", F.col("end") - F.length("match"))
    valid = F.lit(False)
    for k in KINDS:
        valid = F.when(F.col("kind") == k, _valid(k, F.col("match"))).otherwise(valid)
    rows = rows.withColumn("fails", F.coalesce(F.col("base") & ~valid, F.lit(False)))
    # a failed match leaves the row of its text behind, without a span
    return rows.select("rid", "doc_id", *[F.when(~F.col("fails"), F.col(c)).alias(c) for c in ("kind", "base", "start", "end", "match", "before", "after")])


def _plain_signs(text: Column) -> Column:
    """An address with its at sign and its dots as signs, however they were written."""
    return F.regexp_replace(F.regexp_replace(text, rf"{_AT}|\x20(?i:at)\x20", "@"), rf"{_DOT}|\x20(?i:dot)\x20", ".")


def _without_tell_tale(kind: Column, text: Column) -> Column:
    """What the features are counted on: no plus sign, no written-out signs."""
    return F.when(kind == "email", _plain_signs(text)).when(kind == "phone", F.regexp_replace(text, "^\\+", "")).otherwise(text)


def _with_features(rows: DataFrame) -> DataFrame:
    """Rows (kind, match, before, after) with what the trees look at."""
    rows = rows.withColumn("m", _without_tell_tale(F.col("kind"), F.col("match"))).withColumn("group", F.filter(F.split("m", "[^0-9]+"), lambda x: x != ""))
    rows = rows.withColumn("sizes", F.transform("group", F.length))
    m, before, after = F.col("m"), F.col("before"), F.col("after")
    count = lambda c, pattern: F.length(F.regexp_replace(c, pattern, "")).cast("double")
    is_ = lambda c, pattern: c.rlike(pattern).cast("double")
    word, number = F.lit(False), F.lit(0)
    for i, k in enumerate(KINDS):
        word = F.when(F.col("kind") == k, F.lower(before).rlike(WORDS[k])).otherwise(word)
        number = F.when(F.col("kind") == k, i).otherwise(number)
    of = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    parts = F.transform("group", lambda x: F.coalesce(x.try_cast("double"), F.lit(0.0)))
    email = F.col("kind") == "email"
    values = {
        "kind_no": number.cast("double"), "digits": count(m, "[^0-9]+"), "letters": count(m, "[^A-Za-z]+"), "groups": F.size("sizes").cast("double"),
        "first_group": of(F.try_element_at("sizes", F.lit(1))), "last_group": of(F.try_element_at("sizes", F.lit(-1))),
        "longest_group": of(F.array_max("sizes")), "shortest_group": of(F.array_min("sizes")), "round_brackets": count(m, "[^()]+"), "blanks": count(m, "[^ ]+"),
        "hyphens": count(m, "[^-]+"), "dots": count(m, "[^.]+"), "others": count(m, "[A-Za-z0-9 ().@_%+-]+"), "luhn": _is_card(m).cast("double"),
        "largest": F.when(F.col("kind") == "ip", of(F.array_max(parts))).otherwise(0.0),
        "ending": F.when(email, F.length(F.regexp_extract(m, "\\.([A-Za-z]+)$", 1))).otherwise(0).cast("double"),
        "name": F.when(email, F.length(F.regexp_extract(m, "^([^@]*)@", 1))).otherwise(0).cast("double"),
        "distinct": F.size(F.array_distinct(F.split(m, ""))).cast("double"),
        "letter_before": is_(before, "[A-Za-z]$"), "letter_after": is_(after, "^[A-Za-z]"), "digit_before": is_(before, "[0-9][.,:/-]?$"),
        "digit_after": is_(after, "^[.,:/-]?[0-9]"), "word_before": word.cast("double"), "symbols_around": count(F.concat(before, after), "[A-Za-z0-9\\s]+"),
        "digits_around": count(F.concat(before, after), "[^0-9]+"),
    }
    return rows.withColumns(values).drop("m", "group", "sizes")


def candidates_of(spans: DataFrame) -> DataFrame:
    """Proposed spans that overlap no base span, with their features and whether they pass the check of their kind (fine)."""
    up_to = Window.partitionBy("rid").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy("rid").orderBy("start", "end").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    of_base = lambda c: F.when(F.col("base"), F.col(c))
    rows = spans.filter("kind is not null").withColumn("taken", F.coalesce(F.max(of_base("end")).over(up_to) > F.col("start"), F.lit(False))
                                                       | F.coalesce(F.min(of_base("start")).over(after) < F.col("end"), F.lit(False)))
    fine = F.lit(False)
    for k in KINDS:
        fine = F.when(F.col("kind") == k, _valid(k, F.col("match"))).otherwise(fine)
    plausible = F.when(F.col("kind") == "email", _plain_signs(F.col("match")).rlike("\\.[A-Za-z]{2,}$") & (F.col("match").rlike(_AT) | F.lower("match").rlike(rf"\x20({'|'.join(ENDINGS)})$"))).otherwise(fine)
    return _with_features(stored(rows.filter("not base and not taken").withColumn("fine", F.coalesce(plausible, F.lit(False)))))


def _layouts(kind: str, match: Column) -> tuple[list[Column], list[Column]]:
    """Texts made of a base match: such that should be found, and such that should not."""
    d = _digits(match)
    cut = lambda a, n: F.substring(d, a, n)
    if kind == "email":
        name, host = F.regexp_extract(match, "^([^@]*)@", 1), F.regexp_extract(match, "@(.*)$", 1)
        short, dotted = F.regexp_replace(name, "[^A-Za-z].*$", ""), F.concat(F.lit("mail."), host)
        good = [F.concat(n, F.lit("@"), h) for n in (name, F.when(short == "", name).otherwise(short), F.concat(short, F.lit(".x"))) for h in (host, dotted)]
        return good, [F.concat(name, F.lit("@"), F.regexp_replace(host, "\\.[^.]*$", ".7")), F.concat(F.lit("1@"), F.regexp_replace(host, "[A-Za-z]+", "3"))]
    if kind == "phone":
        bare = F.regexp_replace(match, "^\\+[0-9]{1,3}[ .-]?(?=.{9})", "")
        other = [F.regexp_replace(F.regexp_replace(x, "[^0-9]+", sign), "^[^0-9]+", "") for x in (bare, match) for sign in ("-", ".", " ")]
        return ([match, bare, *other],
                [F.concat(cut(1, 4), F.lit("-"), cut(5, 2), F.lit("-"), cut(7, 2)), F.concat(cut(1, 2), F.lit(":"), cut(3, 2), F.lit(":"), cut(5, 2)), d,
                 F.concat(cut(1, 1), F.lit(","), cut(2, 3), F.lit(","), cut(5, 3)), F.concat(cut(1, 3), F.lit("-"), cut(4, 1), F.lit("-"), cut(5, 2), F.lit("-"), cut(7, 6), F.lit("-"), cut(2, 1)),
                 F.concat(cut(1, 2), F.lit(" "), cut(3, 2), F.lit(" "), cut(5, 2), F.lit(" "), cut(7, 2)), F.concat(cut(1, 4), F.lit("."), cut(5, 2), F.lit("."), cut(7, 2)),
                 F.concat(cut(1, 2), F.lit("."), cut(3, 2), F.lit("."), cut(5, 4)), F.concat(cut(1, 4), F.lit(" "), cut(5, 4))])
    if kind == "card":
        wrong = F.concat(F.left(d, F.length(d) - 1), ((F.right(d, F.lit(1)).cast("int") + 3) % 10).cast("string"))
        return [match, d], [wrong, F.concat_ws(" ", F.substring(wrong, 1, 4), F.substring(wrong, 5, 4), F.substring(wrong, 9, 4), F.substring(wrong, 13, 7))]
    return [match], [F.regexp_replace(match, "^[0-9]+", "377"), F.regexp_replace(match, "[0-9]+$", "612"), F.concat(match, F.lit(".7"))]


def examples(spans: DataFrame, candidates: DataFrame) -> DataFrame:
    """Rows to learn from: label and features."""
    made = F.lit(None).cast("array<struct<match:string,label:double>>")
    for kind in KINDS:
        good, bad = _layouts(kind, F.col("match"))
        made = F.when(F.col("kind") == kind, F.array(*[F.struct(c.alias("match"), F.lit(v).alias("label")) for cs, v in ((good, 1.0), (bad, 0.0)) for c in cs])).otherwise(made)
    base = spans.filter("base").select("kind", "start", "before", "after", F.explode(made).alias("x"))
    # stored before and after, so that no plan holds the layouts and the features at once
    known = stored(_with_features(stored(base.select("kind", "start", "before", "after", "x.match", "x.label"))))
    names = ["kind", "start", "label", *FEATURES]
    return known.select(*names).unionByName(candidates.filter("not fine").withColumn("label", F.lit(0.0)).select(*names))


def _with_score(candidates: DataFrame, model: GBTClassificationModel) -> DataFrame:
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(candidates)
    return model.transform(rows).withColumn("chance", vector_to_array("probability")[1])


def fit(rows: DataFrame, at_most: int | None = None, precision: float = PRECISION) -> tuple[GBTClassificationModel, dict[str, float]] | None:
    """The trees and the threshold per kind, from all rows if no bound is given; None without right and wrong examples to learn from.

    Rows that look the same to the trees are one row that weighs as much as they are many.
    """
    rows = rows.withColumn("pick", F.xxhash64("kind", "start", *FEATURES))
    rows = rows if at_most is None else bounded_sample(rows, at_most, "pick", seed=41)
    rows = rows.withColumn("learn", hash_share("pick", seed=43) < 0.7)
    rows = stored(rows.groupBy("learn", "kind", "label", *FEATURES).agg(F.count(F.lit(1)).cast("double").alias("n")))
    learn = F.col("learn")
    if rows.filter(learn).select("label").distinct().count() < 2:
        return None
    train = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows.filter(learn)).select("features", "label", "n")
    model = GBTClassifier(maxIter=12, maxDepth=4, maxBins=32, stepSize=0.3, seed=5, weightCol="n").fit(train)
    counts = _with_score(rows.filter(~learn), model).groupBy("kind", F.floor(F.col("chance") * 50).cast("int").alias("step"))
    counts = counts.agg(F.sum(F.col("label") * F.col("n")).alias("right"), F.sum("n").alias("n")).collect()          # 4 kinds, 51 steps
    limits = {}
    for kind in KINDS:
        right = n = 0
        for step in range(50, 24, -1):
            for r in counts:
                if r["kind"] == kind and r["step"] == step:
                    right, n = right + r["right"], n + r["n"]
            if n and right >= precision * n:
                limits[kind] = step / 50
    return model, limits


def spans(docs: DataFrame, at_most: int | None = None) -> DataFrame:
    """(rid, doc_id, kind, start, end, base) of all spans; a text without spans has one row of nulls."""
    found = stored(found_spans(docs))
    candidates = stored(candidates_of(found))       # so that no later step repeats the feature expressions
    fitted = fit(examples(found, candidates), at_most)
    base = found.select("rid", "doc_id", *[F.when(F.col("base"), F.col(c)).alias(c) for c in ("kind", "start", "end", "base")])
    if fitted is None:
        return base
    model, limits = fitted
    limit = F.lit(2.0)
    for kind, value in limits.items():
        limit = F.when(F.col("kind") == kind, F.lit(value)).otherwise(limit)
    passed = _with_score(candidates.filter("fine"), model).filter(F.col("chance") >= limit)
    return base.unionByName(passed.select("rid", "doc_id", "kind", "start", "end", F.lit(False).alias("base")))


def summary(found: DataFrame) -> DataFrame:
    """Per text: doc_id, counts of base spans, the hash of their list, and the list of all spans."""
    number = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    span = F.when(F.col("kind").isNotNull(), F.struct("start", number.alias("n"), "end", "kind", "base"))
    rows = found.groupBy("rid").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(span)).alias("all"))

    def listed(of: Column) -> Column:
        return F.array_join(F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    of_base = F.filter("all", lambda s: s["base"])
    counts = [F.size(F.filter("all", _is_base_of(k))).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *counts, F.sha2(listed(of_base).cast("binary"), 256).alias("base_sha256"), listed(F.col("all")).alias("spans"))


def _is_base_of(kind: str):
    return lambda s: s["base"] & (s["kind"] == kind)


def redacted(docs: DataFrame, at_most: int | None = None) -> DataFrame:
    """doc_id and the text with every span replaced by its kind in brackets; spans that overlap become one.

    Spans meet their text by its digest, as equal texts have equal spans.
    """
    key = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    found = spans(docs.select(key.alias("doc_id"), "text"), at_most).filter("kind is not null")
    per_text = found.groupBy(F.col("doc_id").alias("key")).agg(F.array_sort(F.collect_set(F.struct("start", "end", "kind"))).alias("all"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("key")).join(per_text.hint("shuffle_hash"), "key", "left")

    def put(done: Column, s: Column) -> Column:
        at = done["at"]
        clear = F.substring(F.col("text"), at + 1, s["start"] - at)
        tag = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(at, s["end"]).alias("at"), F.when(s["start"] < at, done["out"]).otherwise(F.concat(done["out"], clear, tag)).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    end = lambda done: F.concat(done["out"], F.substring(F.col("text"), done["at"].cast("int") + 1, F.length("text")))
    return texts.select("doc_id", F.when(F.col("all").isNull(), F.col("text")).otherwise(F.aggregate("all", start, put, end)).alias("text"))
