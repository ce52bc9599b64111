"""Personal data: overlapping candidates, boosted trees, calibrated thresholds; no Python on rows.

Patterns use possessive repeats and look at the character before, so that long runs are read
once and nothing recurses.
"""
from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import bind, documents, stage

KINDS = ("email", "ip", "card", "phone")

# The base formats. A card is a whole run of digits with single separators, so one of another
# length never begins inside a longer run.
LOCAL, HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{HOST}++(?:\.{HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
# Texts without these need no search.
HINT = {"email": "@", "ip": r"\.", "card": "[0-9]", "phone": r"\+"}

# High-recall formats beyond the base ones; what they propose may overlap base spans and one
# another, and the trees decide.
MASKED_DOT = r"(?: ?(?:\((?:dot|\.)\)|\[(?:dot|\.)\]) ?| dot )"
HEX = "[0-9A-Fa-f]{1,4}+"
WIDE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++(?: ?(?:\(at\)|\[at\]|@) ?{HOST}++(?:(?:\.|{MASKED_DOT}){HOST}++)++"
             rf"| at {HOST}++(?:{MASKED_DOT}{HOST}++)++)",
    "ip": rf"(?<![0-9A-Za-z:]){HEX}(?:(?::{HEX}){{7}}+|(?::{HEX}){{0,5}}+::(?:{HEX}(?::{HEX}){{0,5}}+)?+)(?![0-9A-Za-z:])",
    "card": r"(?<![0-9])(?<![0-9][ ./-])[0-9](?:[ ./-]{0,2}[0-9]){12,18}+(?![ ./-]?[0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?<![0-9][ ().-])(?:00|\()?[0-9](?:[ ().-]{0,2}[0-9]){6,14}+(?![ ().-]{0,2}[0-9])(?![A-Za-z])",
}
WIDE_HINT = {"email": r"@|[(\[]at[)\]]|[(\[](?:dot|\.)[)\]]| dot ", "ip": ":", "card": "[0-9]", "phone": "[0-9]"}

CONTEXT = 24  # characters before a span that the trees may look at
KEYWORDS = "(?i)(?:phone|tel|call|fax|mobil|mail|contact|card|visa|credit|ip|addr|host)"

# Model parameters; the trees are fitted on a bounded number of spans, thresholds rest on all.
SAMPLE_ROWS = 20_000
TREES, DEPTH = 12, 3
PRECISION = 0.98  # least precision on the calibration part of a threshold that selects spans
SURE, ERROR = 0.95, 0.05  # precision that distinct held-out spans must prove, and the chance that they err
FEATURES = 26
GRID = 10_000     # steps of one in which scores are counted, which bounds what is collected
RUN = 256


def _exclusive(steps: Column, start: Column) -> Column:
    """Running sums before each element."""
    acc = F.struct(start.cast("int").alias("s"), F.array().cast("array<int>").alias("a"))
    return F.aggregate(steps, acc, lambda acc, x: F.struct(
        (acc["s"] + x).alias("s"), F.concat(acc["a"], F.array(acc["s"])).alias("a")))["a"]


def running(steps: Column) -> Column:
    """Running sums before each element, built in runs of ``RUN`` so that long arrays stay cheap."""
    def whole(s: Column) -> Column:
        runs = F.when(F.size(s) > 0, F.sequence(F.lit(0), F.floor((F.size(s) - 1) / RUN).cast("int"))) \
            .otherwise(F.array().cast("array<int>"))
        part = lambda c: F.slice(s, c * RUN + 1, RUN)
        totals = F.transform(runs, lambda c: F.aggregate(part(c), F.lit(0), lambda a, x: a + x))
        starts = bind(totals, lambda t: _exclusive(t, F.lit(0)))
        return F.flatten(F.transform(starts, lambda start, c: _exclusive(part(c), start)))

    return bind(steps, whole)


SPAN = "array<struct<kind:int,start:int,end:int,value:string,before:string,after:string>>"


def matches(text: Column, pattern: str, kind: int) -> Column:
    """Matches of a pattern, left to right, with start, end (code points) and what stands
    before and after. The parts between matches are cut out by the same pattern, so positions
    are sums of lengths."""
    def spans(found: Column) -> Column:
        def placed(parts: Column) -> Column:
            steps = F.transform(found, lambda m, i: F.length(m) + F.length(F.get(parts, i)))

            def span(before: Column, i: Column) -> Column:
                start = before + F.length(F.get(parts, i))
                return F.struct(F.lit(kind).alias("kind"), start.alias("start"),
                                (start + F.length(F.get(found, i))).alias("end"), F.get(found, i).alias("value"),
                                F.right(F.get(parts, i), F.lit(CONTEXT)).alias("before"),
                                F.left(F.get(parts, i + 1), F.lit(1)).alias("after"))

            return F.transform(running(steps), span)

        return bind(F.split(text, pattern, -1), placed)

    none = F.array().cast(SPAN)
    return bind(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                lambda found: F.when(F.size(found) > 0, spans(found)).otherwise(none))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def valid(kind: str, value: Column) -> Column:
    """Whether a match of the base format holds."""
    if kind == "ip":
        return value.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "card":
        return F.call_function("luhn_check", digits(value))
    if kind == "phone":
        return F.length(digits(value)).between(8, 15)
    return F.lit(True)


def _where(test, kind: str):
    return lambda s: test(kind, s["value"])


def _search(text: Column, patterns: dict, hints: dict, test=None) -> Column:
    found = []
    for i, kind in enumerate(KINDS):
        spans = matches(text, patterns[kind], i)
        if test:
            spans = F.filter(spans, _where(test, kind))
        found.append(F.when(text.rlike(hints[kind]), spans).otherwise(F.array().cast(SPAN)))
    return F.concat(*found)


def base_spans(text: str) -> Column:
    """Base spans, by kind, then place."""
    return _search(F.coalesce(F.col(text), F.lit("")), BASE, HINT, valid)


def wide_spans(text: str) -> Column:
    """Spans that the generators propose beyond the base formats."""
    return _search(F.coalesce(F.col(text), F.lit("")), WIDE, WIDE_HINT)


def features(span: Column) -> list[Column]:
    """Format and context of a span as doubles."""
    value = span["value"]
    number = digits(value)
    groups = F.filter(F.split(value, "[^0-9]+"), lambda g: g != "")
    length = lambda c: F.length(F.coalesce(c, F.lit("")))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    columns = [
        *[flag(span["kind"] == i) for i in range(len(KINDS))], F.length(value), F.length(number),
        F.size(groups), length(F.get(groups, F.lit(0))), length(F.get(groups, F.size(groups) - 1)),
        F.array_max(F.transform(groups, lambda g: F.length(g))),
        F.regexp_count(value, F.lit("[A-Za-z]")), F.regexp_count(value, F.lit("[ ()./-]")),
        flag(value.contains("@") | value.rlike("[(\\[]at[)\\]]")), flag(value.rlike(r"\.[A-Za-z]{2,}$")),
        F.regexp_count(value, F.lit(":")),
        flag(F.length(number).between(13, 19) & F.call_function("luhn_check", number)),
        flag(value.rlike(rf"^{PART}(?:\.{PART}){{3}}$")),
        flag(value.rlike(r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}$")),
        flag(span["before"].rlike(KEYWORDS)), flag(span["before"].rlike(r"[^\x20\n]$")),
        flag(span["after"].rlike(r"[0-9A-Za-z]")), F.regexp_count(span["before"], F.lit("[0-9]")),
        flag(value.contains("::")), flag(value.rlike(GLOBAL)), flag(value.contains(" at ")), flag(value.rlike(MASKED_DOT)),
    ]
    return [F.coalesce(c, F.lit(0)).cast("double") for c in columns]


SAYS = {  # words before a span that say what it is
    "email": r"(?i)\b(?:e-?mail|mail|contact|write to|reach)\b", "ip": r"(?i)\b(?:ip|host|addr|address|server)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit)\b",
    "phone": r"(?i)\b(?:phone|tel|telephone|call|fax|mobile?|cell|telefon|tel[eé]fono|t[eé]l)\b",
}
CLOCK = r"^[0-9]{1,4}(?::[0-9]{1,2}){7}$"  # eight short decimal groups
GLOBAL = r"^(?:[23][0-9A-Fa-f]{3}|[fF][cCdD][0-9A-Fa-f]{2}|[fF][eE][89abAB][0-9A-Fa-f]):"  # assigned blocks of IPv6
NOT_PHONE = (r"^[0-9]{4}[-./ ][0-9]{1,2}[-./ ][0-9]{1,2}$", r"^[0-9]{1,2}[-./ ][0-9]{1,2}[-./ ][0-9]{4}$",  # dates
             r"^[1-9][0-9]*\.[0-9]+$",                                # decimals
             r"^[1-9][0-9]{6,8}$", r"^[1-9][0-9]{11,}$",              # plain numbers but those of ten or eleven digits
             r"^[0-9](?:[ .-][0-9]){6,}$", r"^(?:[1-9][0-9][ .-]){4,}[0-9]{1,2}$")  # lists of short numbers


def proof(span: Column) -> Column:
    """1 or 0 where form, check digit, number plan or the words before show what a proposal is,
    else null."""
    value, number = span["value"], digits(span["value"])
    said = lambda kind: F.coalesce(span["before"].rlike(SAYS[kind]), F.lit(False))
    card = F.length(number).between(13, 19) & F.call_function("luhn_check", number)
    each = {
        "email": F.when(~value.rlike(r"\.?[A-Za-z]{2,}$"), 0).when(said("email"), 1),
        "ip": F.when(value.rlike(CLOCK) & ~value.contains(":0:"), 0)
        .when(said("ip") | (value.rlike(GLOBAL) & value.rlike("[A-Fa-f]")), 1),
        "card": F.when(~card, 0).when(said("card"), 1),
        "phone": F.when(reduce(lambda a, b: a | b, [value.rlike(x) for x in NOT_PHONE[:3]]), 0).when(said("phone"), 1)
        .when(reduce(lambda a, b: a | b, [value.rlike(x) for x in NOT_PHONE[3:]]), 0),
    }
    label = F.lit(None).cast("int")
    for i, kind in enumerate(KINDS):
        label = F.when(span["kind"] == i, each[kind]).otherwise(label)
    return label


def checked(number: Column) -> Column:
    """Digits and the check digit that makes them a card number."""
    return F.get(F.filter(F.array(*[F.concat(number, F.lit(str(d))) for d in range(10)]),
                          lambda n: F.call_function("luhn_check", n)), F.lit(0))


def training(base: Column, wide: Column) -> Column:
    """Labelled spans of one text, each with the value it was made from: base spans are personal
    data; so are they in each of the wide formats (masked or spelled signs, IPv6, other separators and
    lengths with the right check digit, no country code). Base spans with their proof broken (a
    wrong check digit, a part over 255, too few digits, no host, eight short numbers or two
    names for IPv6) are not. Proposed spans that touch no base span count as ``proof`` says and are left
    out where it says nothing: they may be either. Of runs of digits that fail the check, one
    in nine pass it by chance, so one in nine is also shown with the right digit, as none."""
    def changed(s: Column, value: Column, label: int) -> Column:
        return F.struct(s.withField("value", value).alias("s"), F.lit(label).alias("label"), s["value"].alias("origin"))

    def made(s: Column) -> Column:
        v, number, hash = s["value"], digits(s["value"]), F.md5(s["value"].cast("binary"))
        dialled = F.regexp_replace(v, r"^\+[0-9]{1,3}[ -]", "")
        local = F.when(~dialled.startswith("+") & (F.length(digits(dialled)) >= 7), dialled)
        short = [F.regexp_replace(F.substring(hash, 4 * i + 1, 4), "^0{1,3}", "") for i in range(1, 8)]
        clock = F.translate(hash, "abcdef", "012345")
        at = lambda sign, dot: F.concat(F.substring_index(v, "@", 1), F.lit(sign), F.replace(F.substring_index(v, "@", -1), F.lit("."), F.lit(dot)))
        forms = {
            "email": ([at(" [at] ", "."), at("(at)", " [dot] "), at(" (at) ", "(dot)"),
                       at(" at ", " dot "), at("@", "[.]")], [F.substring_index(v, ".", 1)]),
            "ip": ([F.concat_ws(":", F.lit("2001"), *short), F.concat_ws(":", F.lit("2001"), F.lit("db8"), *[F.lit("0")] * 4, *short[:2]),
                    F.concat(F.lit("2001:db8::"), short[0]), F.concat_ws("::", F.lit("fe80"), F.concat_ws(":", *short[:4]))],
                   [F.concat(v, F.lit("99")), F.concat_ws("::", F.translate(F.left(hash, F.lit(3)), "0123456789", "abcdefabcd"),
                                                          F.translate(F.right(hash, F.lit(3)), "0123456789", "abcdefabcd")),
                    F.concat_ws(":", *[F.substring(clock, 2 * i + 1, 2) for i in range(8)])]),
            "card": ([F.regexp_replace(number, "([0-9]{4})(?=[0-9])", "$1."), checked(F.left(number, F.lit(14))), checked(F.left(number, F.lit(12)))],
                     [F.concat(F.left(v, F.length(v) - 1), F.pmod(F.right(v, F.lit(1)).cast("int") + 1, F.lit(10)).cast("string"))]),
            "phone": ([local, F.regexp_replace(local, r"^([0-9]{2,4})[ .-]", "($1) "), F.regexp_replace(local, "[ -]", "."),
                       F.regexp_replace(F.concat(F.lit("00"), F.substring(v, 2, 99)), "[()]", "")], [F.left(number, F.lit(6))]),
        }
        out = F.array().cast("array<struct<value:string,label:int>>")
        for i, kind in enumerate(KINDS):
            right, wrong = forms[kind]
            out = F.when(s["kind"] == i, F.array(*[F.struct(x.alias("value"), F.lit(label).alias("label"))
                                                   for label, xs in ((1, right), (0, wrong)) for x in xs])).otherwise(out)
        out = F.filter(F.array_distinct(out), lambda o: o["value"].isNotNull() & (o["value"] != v))
        return F.transform(out, lambda o: F.struct(s.withField("value", o["value"]).alias("s"), o["label"].alias("label"), v.alias("origin")))

    apart = F.filter(wide, lambda w: ~F.exists(base, lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
    other = F.filter(F.transform(apart, lambda w: F.struct(w.alias("s"), proof(w).alias("label"), w["value"].alias("origin"))),
                     lambda t: t["label"].isNotNull())
    card = KINDS.index("card")
    failed = F.filter(apart, lambda w: (w["kind"] == card) & (proof(w) == 0) & (F.pmod(F.xxhash64(w["value"], F.lit(9)), F.lit(9)) == 0))
    chance = F.transform(failed, lambda w: changed(w, F.concat(
        F.left(w["value"], F.length(w["value"]) - 1), F.right(checked(F.left(digits(w["value"]), F.length(digits(w["value"])) - 1)), F.lit(1))), 0))
    return F.concat(F.transform(base, lambda s: changed(s, s["value"], 1)), F.flatten(F.transform(base, made)), other, chance)


def tree_score(node, inputs: list[Column]) -> Column:
    """One regression tree as nested CASE expressions, so that scoring stays in the plan."""
    if node.numDescendants() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    here = inputs[split.featureIndex()] <= F.lit(float(split.threshold()))
    return F.when(here, tree_score(node.leftChild(), inputs)).otherwise(tree_score(node.rightChild(), inputs))


class Trees:
    """Boosted trees and a threshold for each kind (None: nothing is added for it)."""

    def __init__(self, model, thresholds: dict[int, int]):
        self.model, self.thresholds = model, thresholds

    def score(self, inputs: list[Column]) -> Column:
        parts = [F.lit(float(w)) * tree_score(t._call_java("rootNode"), inputs)
                 for t, w in zip(self.model.trees, self.model.treeWeights)]
        return reduce(lambda a, b: a + b, parts)

    def steps(self, inputs: list[Column]) -> Column:
        return F.floor(self.score(inputs) * GRID)

    def select(self, spans: Column) -> Column:
        if not self.thresholds:
            return F.array().cast(SPAN)
        limit = F.lit(None).cast("long")

        def wanted(span: Column) -> Column:
            least = limit
            for kind, threshold in self.thresholds.items():
                least = F.when(span["kind"] == kind, F.lit(threshold)).otherwise(least)
            return bind(F.array(*features(span)), lambda f: self.steps([f[i] for i in range(FEATURES)])) >= least

        return F.filter(spans, lambda s: F.coalesce(wanted(s), F.lit(False)))


def proven(n: int, wrong: int) -> bool:
    """Whether ``wrong`` faults among ``n`` spans put the exact lower bound of their precision
    (Clopper-Pearson) at ``SURE`` or more."""
    p = 1 - SURE
    if wrong >= p * n:
        return False
    rate = wrong / n
    gain = (rate * math.log(rate / p) if wrong else 0) + (1 - rate) * math.log((1 - rate) / SURE)
    if n * gain >= -math.log(ERROR):  # the tail is below exp(-n * gain)
        return True
    steps = np.arange(1, wrong + 1)
    terms = n * math.log(SURE) + np.concatenate([[0.0], np.cumsum(np.log((n - steps + 1) / steps) + math.log(p / SURE))])
    return bool(np.exp(terms).sum() <= ERROR)


def fit(found: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 5) -> Trees | None:
    """Train on labelled spans of ``found`` (base, wide), calibrate on others.

    A hash of the value that a span was made from holds one fifth of the values out. The trees
    see distinct spans of the rest, at most about ``sample_rows`` / 8 of each kind and label,
    chosen by hash. All held-out spans are scored and counted: for each kind the lowest score
    from which on they are personal data with ``PRECISION``, as often as they occur, becomes
    the threshold, if the distinct ones among them prove a precision of ``SURE`` (see
    ``proven``; 59 without a fault do, so a kind with fewer adds nothing). Without both classes there is no model and only base spans count."""
    rows = found.select(F.explode(training(F.col("base"), F.col("wide"))).alias("t"))
    look = ["kind", "value", "before", "after"]
    spans = rows.groupBy(*[F.col(f"t.s.{c}").alias(c) for c in look], F.col("t.label").alias("label"),
                         F.col("t.origin").alias("origin")).agg(F.count(F.lit(1)).alias("c"))
    spans = stage(spans.select(
        "kind", "label", "c", F.array(*features(F.struct(*look))).alias("x"),
        (F.pmod(F.xxhash64("kind", "origin", F.lit(seed)), F.lit(5)) == 0).alias("held"),
        F.pmod(F.xxhash64(*look, "label", F.lit(seed)), F.lit(1 << 30)).alias("h")), "spans")
    inputs = [F.col("x")[i] for i in range(FEATURES)]
    train = spans.where(~F.col("held"))
    limit = F.lit(0)
    sizes = train.groupBy("kind", "label").count().collect()  # a row for each kind and label
    for kind, label, n in sizes:
        share = int(min(1.0, sample_rows / (2 * len(KINDS)) / n) * (1 << 30))
        limit = F.when((F.col("kind") == kind) & (F.col("label") == label), share).otherwise(limit)
    if len({label for _, label, _ in sizes}) < 2:
        return None
    train = train.where(F.col("h") < limit).select(
        F.col("label").cast("double").alias("label"), *[x.alias(f"f{i}") for i, x in enumerate(inputs)])
    if train.agg(F.count_distinct("label")).first()[0] < 2:
        return None
    pack = VectorAssembler(inputCols=[f"f{i}" for i in range(FEATURES)], outputCol="features")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=seed, labelCol="label").fit(pack.transform(train))
    trees = Trees(model, {})
    held = spans.where("held").groupBy("kind", trees.steps(inputs).alias("step")).agg(
        F.sum("c").alias("n"), F.sum(F.col("c") * F.col("label")).alias("good"), F.count(F.lit(1)).alias("spans"),
        F.count_if(F.col("label") == 0).alias("wrong"))
    # a row for each kind and step of the score reaches the driver
    table = held.toPandas().sort_values("step", ascending=False)
    for kind, group in table.groupby("kind"):
        total = group[["n", "good", "spans", "wrong"]].cumsum()
        sure = np.array([proven(int(n), int(bad)) for n, bad in zip(total["spans"], total["wrong"])])
        fine = group["step"][sure & (total["good"] >= PRECISION * total["n"]).to_numpy()]
        if len(fine):
            trees.thresholds[int(kind)] = int(fine.iloc[-1])
    return trees


def _listed(spans: Column) -> Column:
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["kind"].alias("k"), s["start"].alias("s"), s["end"].alias("e"))))
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(
        ":", F.get(names, s["k"]), s["s"].cast("string"), s["e"].cast("string"))), ",")


def _added(trees: Trees | None, base: Column, wide: Column) -> Column:
    """Proposed spans that the trees select and that touch no base span."""
    if trees is None:
        return F.array().cast(SPAN)
    return F.filter(trees.select(wide), lambda w: ~F.exists(
        base, lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))


def candidates(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(base_spans(text).alias("base"), wide_spans(text).alias("wide"))


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: doc_id, base and added spans (kind, start, end, value, ...).

    Base spans follow the fixed formats and always stay. Wider formats propose more; trees
    trained on the corpus' own base spans, on altered copies of them and on proposals that a
    proof decides (see ``training``) choose among these above a threshold calibrated per kind. Each text is searched on
    its own, whole, so copies agree. A null or empty text has no spans, an empty table gives
    no rows, repeated rows and other columns do not matter.
    """
    found = stage(docs.select(F.col(doc_id).alias("doc_id"), base_spans(text).alias("base"),
                              wide_spans(text).alias("wide")), "pii")
    trees = fit(found, sample_rows)
    return found.select("doc_id", "base", _added(trees, F.col("base"), F.col("wide")).alias("added"))


def redact(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets, all else as it
    was. A null text stays null. Where spans overlap, the first one names the gap and the gap
    lasts until the last one ends."""
    spans = docs.select(base_spans(text).alias("base"), wide_spans(text).alias("wide"))
    trees = fit(stage(spans.where((F.size("base") > 0) | (F.size("wide") > 0)), "pii"), sample_rows)
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def cut(spans: Column) -> Column:
        order = F.array_sort(F.transform(spans, lambda s: F.struct(
            s["start"].alias("s"), s["end"].alias("e"), s["kind"].alias("k"))))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
        piece = lambda a, b: F.substring(F.col(text), a + 1, b - a)
        done = F.aggregate(order, start, lambda acc, s: F.struct(
            F.greatest(acc["at"], s["e"]).alias("at"),
            F.when(s["s"] >= acc["at"], F.concat(acc["parts"], F.array(piece(acc["at"], s["s"]), F.get(names, s["k"]))))
            .otherwise(acc["parts"]).alias("parts")))
        return bind(done, lambda d: F.concat(F.array_join(d["parts"], ""), piece(d["at"], F.length(text))))

    chosen = bind(base_spans(text), lambda base: F.concat(base, _added(trees, base, wide_spans(text))))
    clean = bind(chosen, lambda spans: F.when(F.size(spans) > 0, cut(spans)).otherwise(F.col(text)))
    return docs.withColumn(text, clean)


def op6_pii(spark, sf_dir):
    found = find(documents(spark, sf_dir))
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long").alias(f"n_{KINDS[i]}")
    return found.select("doc_id", *[count(i) for i in range(len(KINDS))],
                        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                        _listed(F.concat("base", "added")).alias("spans"))
