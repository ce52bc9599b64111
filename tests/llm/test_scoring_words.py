"""Every counted word is predicted from its context, the rare ones too."""
import math
import random

import numpy as np

from pagewright.llm import scoring


def test_context_reaches_words_beyond_the_commonest(spark):
    rnd = random.Random(6)
    pairs = [(f"first{i}", f"second{i}") for i in range(1000)]  # each as common as the others
    rows = [(i, " ".join(w for _ in range(100) for w in rnd.choice(pairs))) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    held = [r for r in scoring.score(docs).collect() if r.held_out]
    gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
    assert gain > math.log10(2) + 0.05, gain  # telling firsts from seconds alone gives log10(2) at most


def test_probabilities_of_all_leaves_sum_to_one(spark):
    rng = np.random.default_rng(2)
    for n, buckets in ((0, 1), (3, 1), (700, 64)):
        counts = sorted(rng.integers(1, 500, n).tolist(), reverse=True)
        model = scoring.Model([b"w%d" % i for i in range(n)], counts, sum(counts), n + 5, rng.random(buckets) + 0.5)
        model.weight += rng.normal(size=model.weight.shape).astype(np.float32)
        x = model.encode([[b"w1", b"other", b"w2"]])[1][2:].repeat(model.leaves, axis=0)
        p = 10 ** model.log10(np.arange(model.leaves), x)
        assert abs(p.sum() - 1) < 1e-3 and (p > 0).all()


def test_rows_follow_words_and_tokens():
    rows = lambda total, distinct: scoring.Model([b"a"], [1], total, distinct, np.ones(1)).rows
    assert rows(10, 2) == scoring.LEAST_FEATURES < rows(10, 1_000_000) < rows(100_000_000, 1_000_000)


def test_the_model_is_bounded_and_words_of_one_bucket_share_it_by_counts(spark, monkeypatch):
    assert scoring.Model([b"a"], [1], 10 ** 11, 10 ** 9, np.ones(1)).weight.nbytes < 70e6
    monkeypatch.setattr(scoring, "MOST_BUCKETS", 4)
    monkeypatch.setattr(scoring, "LONGEST", 3)  # longer words have no leaf of their own
    sizes = []
    monkeypatch.setattr(scoring, "train", lambda model, docs: sizes.append(len(model.buckets)) or model)  # unigrams, as counted
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(["the", "of", *[f"longer{n}" for n in range(40)]]) for _ in range(30))) for i in range(60)]
    got = scoring.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sizes == [4] and len(got) == 60
    # half a count for one unseen word in each bucket, not one for all
    near = lambda a, b: abs(a - b) < 0.02 * abs(b)
    assert all(r.n_known == r.n_tokens and near(r.score, r.base_score) for r in got)
