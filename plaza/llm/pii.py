"""Personal data by weak supervision, in DataFrame functions only.

Candidates are the strict matches of four kinds (email, ip, card, phone), matches of
the same shapes that fail a check, and looser writings of addresses and numbers.
Five labelers vote on each candidate (for, against, abstain): the strict pattern, the
printed form, a gazetteer of prefixes and endings, the words before it, and the
characters at its edges. Expectation-maximisation over the counts of vote patterns of
the whole corpus estimates how reliable each labeler is; the estimated labels then
train a logistic span classifier. A candidate that is no strict match becomes a span
if the classifier puts it at a half or more. Strict matches always are spans.

The counts of vote patterns have at most 4 kinds x 3^5 rows, whatever the corpus; only
they reach the driver.

Contract
- Positions are code points, the end exclusive. Null text counts as empty.
- Strict matches are leftmost and do not overlap within a kind; a match that fails its
  check is dropped and not tried again. Added spans of a kind overlap no strict match
  of that kind.
- Empty texts and tables give no spans. Rows are judged one by one; repeated rows and
  null ids give separate equal rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from plaza.functions.arrays import let
from plaza.llm.common import Scratch, whole_text

# The kinds in order, and their patterns. Repeated groups are possessive
# and a match cannot start inside a run that the pattern has already refused, which
# changes no match but keeps long runs linear.
KINDS = ["email", "ip", "card", "phone"]
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:\x20?[\[(]dot[\])]\x20?[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+])(?:\([0-9]{3}\)|[0-9]{3})[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
IP_RANGE = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"
CARD_DIGITS, PHONE_DIGITS = (12, 19), (9, 15)

# Fixed values of the labelers.
PRINTED = {
    "email": r"\.[A-Za-z]{2,}$|dot[\])]\x20?[A-Za-z]{2,}$",
    "ip": r"^(?:0|[1-9][0-9]*)(?:\.(?:0|[1-9][0-9]*)){3}$",
    "card": r"^[0-9]{15,16}$|^[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}$|^[0-9]{4}([\x20-])[0-9]{6}\2[0-9]{5}$",
    "phone": r"^(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}$",
}
GAZETTEER = {
    "email": r"(?i)(?:com|org|net|edu|gov|de|fr|es|eu|uk|io)$",
    "ip": r"^(?!0|127\.|255\.)[0-9]",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))",
    "phone": r"^(?:\+(?:1|33|34|44|49)(?![0-9])|\+(?:33|34|44|49)|\()",
}
CUES = {
    "email": r"(?i)\b(?:e-?mail|mail|write|contact|contacto|adresse|correo)\W*$",
    "ip": r"(?i)\b(?:ip|host|server|address|from|adresse)\W*$",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|karte|carte|tarjeta)\W*$",
    "phone": r"(?i)\b(?:phone|tel|call|mobile|fax|telefon|téléphone|teléfono)\W*$",
}
NOT_PERSONAL = r"(?i)\b(?:version|build|release|isbn|order|invoice|sha|hash|token|key|serial|v)\W*$"
CONTEXT = 24
LABELERS = 5

ROUNDS = 20
BLOCK = 256
_SPAN = "array<struct<kind:int,start:int,end:int,strict:boolean,votes:array<int>>>"


def running_totals(lengths: Column) -> Column:
    """Sums of the leading elements, each included; in blocks, so that long arrays stay cheap."""
    add = lambda a, b: a + b
    total = lambda items: F.aggregate(items, F.lit(0), add)
    last_block = F.floor((F.size(lengths) - 1) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last_block), lambda b: total(F.slice(lengths, b * BLOCK + 1, BLOCK)))
    before = F.aggregate(blocks, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    return let(before, lambda known: F.transform(lengths, lambda _, i: F.get(known, F.floor(i / BLOCK).cast("int")) + total(
        F.slice(lengths, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK + 1))))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits pass the Luhn check."""

    def value(i: Column) -> Column:
        digit = F.substr(number, F.length(number) - i + 1, F.lit(1))
        return F.when(i % 2 == 0, F.translate(digit, "0123456789", "0246813579")).otherwise(digit).cast("int")

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def passes(kind: str, hit: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return hit.rlike(IP_RANGE)
    n = F.length(digits(hit))
    if kind == "phone":
        return n.between(*PHONE_DIGITS)
    return F.when(n.between(*CARD_DIGITS), luhn(digits(hit))).otherwise(False)


def plausible(kind: str, hit: Column) -> Column:
    """Shapes that are worth a vote although they fail the check: a number as long as a card."""
    return F.length(digits(hit)).between(*CARD_DIGITS) if kind == "card" else F.lit(True)


def votes(kind: str, strict: Column | None, hit: Column, before: Column, after: Column) -> Column:
    say = lambda yes, no=None: F.when(yes, 1).when(no if no is not None else F.lit(True), -1).otherwise(0)
    edge = F.right(before, F.lit(1)).rlike(r"[\p{L}0-9_]") | after.rlike(r"^[\p{L}0-9_]")
    return F.array(
        F.lit(0) if strict is None else say(strict),
        say(hit.rlike(PRINTED[kind])), say(hit.rlike(GAZETTEER[kind])),
        say(before.rlike(CUES[kind]), before.rlike(NOT_PERSONAL)), say(~edge))


def located(text: Column, kind: str, pattern: str, guard: Column, strict: bool) -> Column:
    """Candidates of one pattern: the texts between matches give their places."""
    none = F.array().cast(_SPAN)

    def placed(hits: Column) -> Column:
        return let(F.split(text, pattern, -1), lambda gaps: let(
            running_totals(F.transform(hits, lambda h, i: F.length(h) + F.length(F.get(gaps, i)))),
            lambda ends: F.transform(hits, lambda h, i: span(h, F.get(ends, i), F.right(F.get(gaps, i), F.lit(CONTEXT)), F.get(gaps, i + 1)))))

    def span(hit: Column, end: Column, before: Column, after: Column) -> Column:
        ok = passes(kind, hit) if strict else None
        return F.when(plausible(kind, hit), F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), (end - F.length(hit)).alias("start"), end.alias("end"),
            (ok if strict else F.lit(False)).alias("strict"), votes(kind, ok, hit, before, after).alias("votes")))

    hits = F.when(guard, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return let(hits, lambda hs: F.when(F.size(hs) > 0, F.filter(placed(hs), lambda s: s.isNotNull()).cast(_SPAN)).otherwise(none))


def candidates(text: Column) -> Column:
    """All candidates of a text, loose ones only where no strict match of the kind is."""
    digit = text.rlike("[0-9]")
    guards = {"email": F.contains(text, F.lit("@")), "ip": digit, "card": digit, "phone": F.contains(text, F.lit("+"))}
    strict = [located(text, kind, STRICT[kind], guards[kind], True) for kind in KINDS]
    loose = [
        located(text, "email", LOOSE["email"], text.rlike(r"(?:\[at\]|\(at\))"), False),
        located(text, "phone", LOOSE["phone"], digit, False)]

    def apart(sure: Column) -> Column:
        free = lambda s: ~F.exists(sure, lambda t: t["strict"] & (t["kind"] == s["kind"]) & (t["start"] < s["end"]) & (s["start"] < t["end"]))
        return F.concat(sure, F.filter(F.concat(*loose), free))

    return let(F.concat(*strict), apart)


Pattern = tuple[int, tuple[int, ...]]


def reliabilities(counts: dict[Pattern, int]) -> dict[Pattern, float]:
    """Probability that a candidate with these votes is personal data, by EM.

    Two classes per kind, votes independent given the class; the first guess is the
    share of votes in favour among those cast.
    """
    guess = {p: (0.5 + p[1].count(1)) / (1 + p[1].count(1) + p[1].count(-1)) for p in counts}
    for _ in range(ROUNDS):
        mass: dict[tuple, float] = defaultdict(lambda: 1.0)  # one imagined vote each
        for (kind, cast), n in counts.items():
            for y, p in ((1, guess[kind, cast]), (0, 1 - guess[kind, cast])):
                mass[kind, y] += n * p
                for j, v in enumerate(cast):
                    mass[kind, y, j, v] += n * p
        for kind, cast in counts:
            odds = math.log(mass[kind, 1] / mass[kind, 0])
            for j, v in enumerate(cast):
                odds += math.log(mass[kind, 1, j, v] / (mass[kind, 1] + 3)) - math.log(mass[kind, 0, j, v] / (mass[kind, 0] + 3))
            guess[kind, cast] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return guess


def features(kind: Column, cast: Column) -> Column:
    """Votes by kind: which labelers to trust differs from kind to kind."""
    own = lambda k: kind == k
    return F.array(*[
        F.when(own(k), F.get(cast, j).cast("double")).otherwise(0.0) for k in range(len(KINDS)) for j in range(LABELERS)
    ], *[own(k).cast("double") for k in range(len(KINDS))])


def span_classifier(found: DataFrame) -> Callable[[Column], Column] | None:
    """Train on all candidates of the corpus; a function from a candidate to its probability."""
    counted = found.select(F.explode("found").alias("s")).groupBy("s.kind", "s.votes").count().collect()
    counts = {(r["kind"], tuple(r["votes"])): r["count"] for r in counted}
    if not counts:
        return None
    learned = reliabilities(counts)
    rows = [(k, list(v), float(y), max(1e-6, n * (learned[k, v] if y else 1 - learned[k, v])))
            for (k, v), n in counts.items() for y in (0, 1)]
    table = found.sparkSession.createDataFrame(rows, "kind int, votes array<int>, label double, weight double")
    model = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=50).fit(
        table.select(array_to_vector(features(F.col("kind"), F.col("votes"))).alias("features"), "label", "weight"))
    weights, bias = [float(w) for w in model.coefficients], float(model.intercept)
    by_kind = [weights[k * LABELERS:(k + 1) * LABELERS] for k in range(len(KINDS))]
    own = weights[len(KINDS) * LABELERS:]

    def probability(s: Column) -> Column:
        score = F.lit(None).cast("double")
        for k in range(len(KINDS)):
            linear = F.lit(bias + own[k])
            for j, w in enumerate(by_kind[k]):
                linear = linear + F.lit(w) * F.get(s["votes"], j)
            score = F.when(s["kind"] == k, linear).otherwise(score)
        return 1 / (1 + F.exp(-score))

    return probability


def chosen(found: Column, probability: Callable[[Column], Column] | None) -> Column:
    """Strict matches and the candidates that the classifier accepts, by start, then kind."""
    keep = (lambda s: s["strict"]) if probability is None else (lambda s: s["strict"] | (probability(s) >= 0.5))
    return F.sort_array(F.transform(F.filter(found, keep), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["strict"].alias("strict"))))


def listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def personal_data(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Counts and spans of every document."""
    found = scratch.write(docs.select("doc_id", candidates(whole_text()).alias("found")), "found")
    spans = found.select("doc_id", chosen(F.col("found"), span_classifier(found)).alias("all"))
    spans = spans.withColumn("base", F.filter("all", lambda s: s["strict"]))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return spans.select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("all")).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; spans that overlap count as one."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(acc: Column, s: Column) -> Column:
        cut = F.concat(acc["done"], F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(names, s["kind"]))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], cut).otherwise(acc["done"]).alias("done"))

    return F.when(F.size(spans) == 0, text).otherwise(
        F.aggregate(spans, start, step, lambda acc: F.concat(acc["done"], F.substr(text, acc["at"] + 1, F.length(text)))))


def mask_documents(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The same columns with personal data masked in ``text``. Null texts stay null."""
    found = scratch.write(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), candidates(whole_text()).alias("found")), "found")
    judged = found.select("row", chosen(F.col("found"), span_classifier(found)).alias("spans"))
    return judged.select(*[
        (masked(F.col("row.text"), F.col("spans")) if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns])
