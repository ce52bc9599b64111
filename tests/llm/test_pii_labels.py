"""Spans in a wide format are not learnt as none because no base format covers them."""
import random

import pytest
from pyspark.sql import functions as F

from pagewright.llm import pii


@pytest.fixture(scope="module")
def found(spark):
    rnd = random.Random(4)
    word = lambda n: "".join(rnd.choice("abcdefghijklmnoprstu") for _ in range(n))
    number = lambda n: "".join(rnd.choice("23456789") for _ in range(n))
    hexes = lambda: ":".join(["2001", *(f"{rnd.randint(0x100, 0xffff):x}" for _ in range(6)), "ab1c"])
    rows = [f"see {word(6)}@{word(7)}.org here" for _ in range(300)]
    rows += [f"see {word(6)} [at] {word(7)}.org here" for _ in range(100)]     # a quarter is masked
    rows += [f"from {rnd.randint(1, 255)}.{rnd.randint(0, 255)}.7.{rnd.randint(0, 255)} here" for _ in range(300)]
    rows += [f"from {hexes()} here" for _ in range(100)]
    rows += ["laps " + ":".join(str(rnd.randint(10, 59)) for _ in range(8)) + " here" for _ in range(100)]
    rows += [f"open (at) 5.{rnd.randint(10, 59)} here" for _ in range(100)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    return rows, {r.doc_id: [s.value for s in r.added] for r in pii.find(docs).collect()}


def test_masked_and_long_forms_are_found_and_look_alikes_are_not(found):
    rows, added = found
    part = lambda a, b: [added[i] for i in range(a, b)]
    assert sum(map(bool, part(300, 400))) >= 95          # masked addresses
    assert sum(map(bool, part(700, 800))) >= 95          # IPv6
    assert sum(map(bool, part(800, 1000))) <= 4          # eight short numbers, times of day


def test_proof_decides_or_leaves_out(spark):
    cases = [("email", "a [at] b.org", "see ", None), ("email", "x (at) 5.30", "open ", 0), ("email", "a [at] b.org", "my mail ", 1),
             ("ip", "2001:db8:1:2:3:4:5:6a", "", 1), ("ip", "12:30:45:10:11:12:13:14", "", 0), ("ip", "1:2:3:4:5:6:7:abc", "", None),
             ("card", "4111.1111.1111.1111", "", None), ("card", "4111.1111.1111.1111", "my card ", 1), ("card", "4111.1111.1111.1112", "", 0),
             ("phone", "030 123 4567", "", None), ("phone", "030 123 4567", "tel ", 1), ("phone", "2019-12-31", "call ", 0), ("phone", "12345678", "", 0)]
    df = spark.createDataFrame([(i, pii.KINDS.index(k), v, b) for i, (k, v, b, _) in enumerate(cases)], "i int, kind int, value string, before string")
    got = {r.i: r.p for r in df.select("i", pii.proof(F.struct("kind", "value", "before")).alias("p")).collect()}
    assert [got[i] for i in range(len(cases))] == [c[3] for c in cases]
