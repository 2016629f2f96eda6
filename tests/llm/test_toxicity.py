"""The string kernel finds words seen in training, also with letters put in."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import queries, toxicity
from tests.llm import helpers

SYLLABLES = "the ing ion re at er on an en th ed or es st".split()


def sample(n, bad, seed):
    rng, texts, labels = np.random.RandomState(seed), [], []
    for i in range(n):
        words = ["".join(rng.choice(SYLLABLES, rng.randint(1, 4))) for _ in range(40)]
        if i % 3 == 0:
            words.insert(rng.randint(40), bad[i % len(bad)])
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    return texts, labels


@pytest.fixture(scope="module")
def model():
    return toxicity.train(*sample(300, ["blorgit", "swinzak"], 1), landmarks=96)


def test_unseen_texts(model):
    texts, labels = sample(90, ["blorgit", "swinzak"], 2)
    got = [toxicity.probability(toxicity.best_window(toxicity.letters(t), model), model) >= 0.5 for t in texts]
    assert np.mean(np.array(got) == np.array(labels)) > 0.97


def test_inserted_and_spelt(model):
    for text in ("ing blorgiit then", "ing b.l.o.r.g.i.t then", "er s w i n z a k on", "at swiinzak ed"):
        assert toxicity.probability(toxicity.best_window(toxicity.letters(text), model), model) >= 0.5, text


def test_kernel_equals_brute_force():
    from itertools import combinations

    word = toxicity.letters("stupid")
    want = {}
    for places in combinations(range(len(word)), 4):
        if places[3] - places[0] < 6:
            key = 0
            for p in places:
                key = key * 32 + int(word[p])
            want[key] = want.get(key, 0.0) + 0.7 ** (places[3] - places[0] + 1)
    (keys, values), = toxicity._features([word], 0.7, 6)
    whole = {k: v for k, v in zip(keys.tolist(), values.tolist()) if all(k // 32**i % 32 for i in range(4))}
    scale = next(iter(want.values())) / whole[next(iter(want))]
    assert set(whole) == set(want) and all(abs(whole[k] * scale - want[k]) < 1e-6 for k in want)


def test_awkward_texts_and_columns(spark, model):
    frame = helpers.docs(spark, helpers.AWKWARD)
    got = toxicity.score(frame.drop("toxicity"), model).collect()
    assert len(got) == len(helpers.AWKWARD) and all(0 <= r["toxicity"] <= 1 for r in got)


def test_one_label_or_none(spark):
    frame = helpers.docs(spark, ["a b", "c"])
    labels = spark.createDataFrame([(0, 0), (1, None)], "doc_id long, toxic int")
    constant = toxicity.fit(labels, frame)
    assert toxicity.score(frame, constant).where("toxicity >= 0.5").count() == 0
    assert toxicity.score(helpers.empty(spark), toxicity.fit(labels.limit(0), frame)).count() == 0


def test_held_out(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.toxicity_score(spark, folder).join(queries.table(spark, folder, "labels"), "doc_id").where("held_out")
    share = got.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")).alias("right")).first()["right"]
    assert share > 0.85


def test_folded_decision_equals_the_sum_over_landmarks():
    """One table lookup per letter and gap pattern against kernels with every landmark, subsequence by subsequence."""
    from itertools import combinations

    rng, decay, reach, window = np.random.RandomState(3), 0.7, 6, 14
    marks = toxicity._features([toxicity.letters(t) for t in ("you blorgit now", "an ing then re", "swinzak st", "the ed on é")], decay, reach)
    beta = rng.normal(size=len(marks))
    table = np.zeros(toxicity._SIZE)
    for b, (keys, values) in zip(beta, marks):
        table[keys] += b * values
    model = toxicity.ToxicityModel(table.astype(np.float32), 1.0, 0.0, decay, reach, window)
    for text in ("the blorgit ed on swiinzak at", "a", "b.l.o.r.g.i.t é x", "on an ing then re st er the ed"):
        codes = toxicity.letters(text)
        known = [dict(zip(keys.tolist(), values.tolist())) for keys, values in marks]
        begun = []
        for i in range(len(codes)):
            kernels = np.zeros(len(marks))
            for gaps in combinations(range(1, reach), 3):
                digits = [int(codes[i + g]) if i + g < len(codes) else 0 for g in (0, *gaps)]
                key = ((digits[0] * 32 + digits[1]) * 32 + digits[2]) * 32 + digits[3]
                kernels += [decay ** (gaps[-1] + 1) * k.get(key, 0.0) for k in known]
            begun.append(float(beta @ kernels))
        want = max(sum(begun[s : s + window]) for s in range(len(codes)))
        assert toxicity.best_window(codes, model) == pytest.approx(want, abs=1e-4)
