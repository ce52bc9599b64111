"""Common forms of personal data that no base format covers, beside look-alikes, by kind."""
import random
import re

import pytest
from pyspark.sql import functions as F

from pagewright.llm import pii


@pytest.mark.parametrize("text, kind, value", [
    ("call (212) 555-0100 now", "phone", "(212) 555-0100"), ("ring 030 123 4567.", "phone", "030 123 4567"),
    ("host 2001:db8::1 up", "ip", "2001:db8::1"), ("fe80::1:2:abc,", "ip", "fe80::1:2:abc"),
    ("to 2001:db8:1:2:3:4:5:6a.", "ip", "2001:db8:1:2:3:4:5:6a"),
    ("a.b@example[.]com", "email", "a.b@example[.]com"), ("by jo at example dot org please", "email", "jo at example dot org"),
    ("jo [at] example.org. Then", "email", "jo [at] example.org"), ("x @ y.org", "email", "x @ y.org"),
    ("stay at home. Then go", None, None), ("std::vector and x1::", None, None), ("room 12 of 34", None, None),
    ("9" * 5000 + " x", None, None), ("a" * 5000 + " at " + "b" * 5000, None, None)])
def test_generators_propose(spark, text, kind, value):
    df = spark.createDataFrame([(text,)], "text string")
    got = [(pii.KINDS[s.kind], s.value, text[s.start:s.end]) for s in df.select(pii.wide_spans("text").alias("w")).first().w]
    assert all(v == t for _, v, t in got)
    assert ((kind, value) in [g[:2] for g in got]) if kind else not got


def test_bound_is_exact():
    assert pii.proven(59, 0) and not pii.proven(58, 0) and not pii.proven(59, 1) and pii.proven(93, 1)
    assert not pii.proven(92, 1) and pii.proven(10 ** 7, 10 ** 5) and not pii.proven(10 ** 7, 10 ** 6)


def test_recall_and_precision_by_kind(spark):
    rnd = random.Random(8)
    word = lambda n: "".join(rnd.choice("abcdefghijklmnoprstu") for _ in range(n))
    number = lambda n: "".join(rnd.choice("23456789") for _ in range(n))
    part = lambda: f"{rnd.randint(0x1000, 0xffff):x}"
    base = [lambda: f"see {word(6)}@{word(7)}.org here", lambda: f"from {rnd.randint(1, 255)}.{rnd.randint(0, 255)}.7.{rnd.randint(0, 255)} here",
            lambda: f"ring +1 ({number(3)}) {number(3)}-{number(4)} soon"]
    planted = {"email": [lambda: f"{word(6)} at {word(7)} dot org", lambda: f"{word(6)}@{word(7)}[.]org", lambda: f"{word(5)} (at) {word(6)}.net"],
               "ip": [lambda: f"2001:db8::{part()}", lambda: f"fe80::{part()}:{part()}:{part()}:{part()}"],
               "phone": [lambda: f"({number(3)}) {number(3)}-{number(4)}"]}
    alike = [lambda: f"meet at {word(6)} then", lambda: f"at 12:{number(2)}::{rnd.choice('23')} laps", lambda: f"{word(4)}::{word(5)} call",
             lambda: f"on 2019-1{rnd.choice('012')}-2{rnd.choice('3456')} we", lambda: f"total {number(7)} rows", lambda: "ab::cd is a name"]
    rows, truth = [], {}
    for make in base:
        rows += [make() for _ in range(500)]
    for kind, makers in planted.items():
        for make in makers:
            for _ in range(60):
                value = make()
                truth[len(rows)] = (kind, value)
                rows.append(f"as {word(4)} said, {value} and so on" if kind != "email" else f"as said: {value} and so on")
    for make in alike:
        rows += [make() for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    added = {r.doc_id: [(pii.KINDS[s.kind], s.value) for s in r.added] for r in pii.find(docs).collect()}
    for kind in planted:
        wanted = {i for i, t in truth.items() if t[0] == kind}
        hit = {i for i in wanted if truth[i] in added[i]}
        false = [i for i, spans in added.items() if i not in truth and any(k == kind for k, _ in spans)]
        assert len(hit) >= 0.9 * len(wanted), (kind, len(hit), len(wanted), [added[i] for i in sorted(wanted - hit)[:5]])
        assert len(false) <= 0.1 * len(wanted), (kind, [(rows[i], added[i]) for i in false[:5]])


BASE = [("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda v: True),
        ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda v: all(int(p) <= 255 for p in v.split("."))),
        ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda v: 16 <= len(re.sub("[^0-9]", "", v)) <= 19 and luhn(v)),
        ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda v: 8 <= len(re.sub("[^0-9]", "", v)) <= 15)]


def luhn(value):
    digits = [int(c) for c in reversed(value) if c.isdigit()]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def test_base_spans_equal_brute_force_on_odd_texts(spark):
    rnd = random.Random(11)
    bits = ["a", "b.c", "@", "@d", ".", "..", "-", " ", "+", "1", "23", "456", "(7)", "255", "256", "4111111111111111", "4111 1111 1111 1111",
            "1.2.3.4", "\n", "é", "😀", "%", "0", "99999999", "x@y.z", "+1 555 123 4567"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25))) for _ in range(1500)] + [None, "", "1 " * 20_000 + "x@y.z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.b for r in docs.select("doc_id", pii._listed(pii.base_spans("text")).alias("b")).collect()}
    for i, text in enumerate(texts):
        want = [f"{kind}:{m.start()}:{m.end()}" for kind, pattern, ok in BASE for m in pattern.finditer(text or "") if ok(m.group())]
        assert got[i] == ",".join(want), repr(text)
