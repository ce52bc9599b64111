"""Updates of the model: repeated rows add up, and each round is written once."""
import pickle

import numpy as np
from pyspark.sql import functions as F

from pagewright.llm import scoring


def test_an_update_adds_the_gradients_of_repeated_rows():
    rng = np.random.default_rng(5)
    model = scoring.Model([b"w%d" % i for i in range(300)], [9] * 300, 2700, 310, np.ones(8))
    model.weight += rng.normal(size=model.weight.shape).astype(np.float32)
    ids, x = model.encode([[b"w%d" % i for i in rng.integers(0, 40, 500)]])
    _, taken, rows, p = model.forward(ids, x)
    p[np.arange(len(taken)), taken] -= 1
    step, n = np.zeros(model.weight.shape), np.zeros(model.rows)
    for j in range(scoring.HASHED):
        np.add.at(step, rows[:, j], p)
        np.add.at(n, rows[:, j], 1)
    want = model.weight - scoring.RATE * step / np.sqrt(step * step + 1)
    past, touched = np.zeros_like(model.weight), np.zeros(model.rows, np.float32)
    model.update(ids, x, past, touched)
    assert np.allclose(model.weight, want, atol=1e-5) and np.allclose(past, step * step, atol=1e-4)
    assert (touched == n).all()


def test_updates_are_written_once_a_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(scoring, "stage", lambda df, name, real=scoring.stage: written.append(name) or real(df, name))
    docs = spark.range(400).select(F.concat_ws(" ", F.lit("a"), F.col("id") % 7, F.lit("b"), F.col("id") % 3).alias("text")).repartition(3)
    model = scoring.train(scoring.Model([b"a", b"b"], [400, 400], 2000, 12, np.ones(8)), docs, rounds=2)
    assert written == ["updates"] * 2 and model.weight.any()


def test_what_travels_is_small_and_comes_back_whole():
    rng = np.random.default_rng(7)
    buckets = 0.5 + 1.5 * rng.integers(0, 3, 1 << 16)
    model = scoring.Model([b"w%d" % i for i in range(500)], [9] * 500, 4500, 100_000, buckets)
    at = rng.integers(0, model.rows, 1000)
    model.weight[at] = rng.normal(size=(1000, scoring.WIDTH)).astype("<f2")
    sent = pickle.dumps(model)
    back = pickle.loads(sent)
    for name in ("parent", "branch", "bias", "buckets", "weight"):
        assert np.array_equal(getattr(back, name), getattr(model, name)), name
    model.weight += np.float32(1e-6)  # no longer halves
    assert np.array_equal(pickle.loads(pickle.dumps(model)).weight, model.weight)
    assert len(sent) < 0.6 * sum(a.nbytes for a in (model.parent, model.branch, model.bias, model.buckets))


def test_a_task_leaves_the_shared_weights_alone():
    model = scoring.Model([b"a", b"b"], [3, 3], 9, 4, np.ones(2))
    twin = model.twin()
    ids, x = twin.encode([[b"a", b"b"]])
    twin.update(ids, x, np.zeros_like(twin.weight), np.zeros(twin.rows, np.float32))
    assert twin.weight.any() and not model.weight.any()


def test_far_weights_give_probabilities_and_one_row_adds_up_over_many_tokens():
    model = scoring.Model([b"w%d" % i for i in range(300)], [9] * 300, 2700, 310, np.ones(8))
    ids, x = model.encode([[b"w1", b"w2"] * 3000])
    past, touched = np.zeros_like(model.weight), np.zeros(model.rows, np.float32)
    model.update(ids, x, past, touched)
    assert touched.max() >= 2999 and touched.sum() == scoring.HASHED * len(model.path(ids, x)[0])
    for far in (200, -200):  # beyond what a float's exponential holds
        model.weight[:] = far
        model.weight[:, 3] += 5
        p = model.forward(ids, x)[3]
        assert np.isfinite(p).all() and np.allclose(p.sum(axis=1), 1, atol=1e-4)
        assert np.isfinite(model.log10(ids, x)).all()
