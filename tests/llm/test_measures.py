"""Quality rules and toxicity."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from milemark.llm import host_quality, toxicity


def test_measures_equal_brute_force(messy_rows, messy, clashing):
    for docs in (messy, clashing):
        rows = host_quality.judge(docs).collect()
        got = sorted((str(r.doc_id), *(r[m] for m in host_quality.MEASURES)) for r in rows)
        assert got == sorted((str(r[0]), *brute.measures(r[1])) for r in messy_rows)
        for r in rows:
            assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
            assert r.kept == (not r.base_failed and not r.host_rejected)


def test_windows_do_not_reach_into_the_next_text():
    texts = ["a b c d e f g h", "a b c d e f g h", "x a b c d e f g h a b c d e f g h"]
    assert host_quality._measured(texts, 8)["n_repeat_words"].tolist() == [0, 0, 16]


def test_host_rates_shrink_with_few_documents(spark):
    rows = [("good", 30)] * 400 + [("bad", 5)] * 300 + [("bad", 30)] * 30 + [("tiny", 5)] + [(f"h{i}", 30) for i in range(40)]
    measures = spark.createDataFrame(rows, "host string, n_words long").withColumns(
        {m: F.lit(0).cast("long") for m in host_quality.MEASURES if m != "n_words"}
    )
    rates = {(r.host, r.rule): r.shrunk for r in host_quality.host_rates(measures).collect()}
    assert rates["bad", "short"] > 0.8
    assert rates["good", "short"] < 0.02
    assert rates["h1", "short"] < rates["tiny", "short"] < 1.0
    assert rates["good", "repeats"] == 0.0


def test_rejected_host_takes_its_good_documents_along(spark, prose):
    good = prose(40)
    rows = [(i, "too short", "junk") for i in range(60)] + [(100, good, "junk"), (101, good, None)]
    rows += [(200 + i, good, f"ok{i % 3}") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in host_quality.judge(docs).collect()}
    assert found[100].host_rejected and not found[100].kept and not found[100].base_failed
    assert found[101].kept and all(found[200 + i].kept for i in range(90))


def test_empty_tables(spark, empty):
    assert host_quality.judge(empty).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(empty, labels, F.lit(True))
    assert model.prior == 0.0 and toxicity.score(empty, model).count() == 0


@pytest.fixture(scope="module")
def insults(spark, prose):
    rows = []
    for i in range(500):
        text = prose(40)
        if i % 5 == 0:
            words = text.split(" ")
            for k in range(0, 40, 8):
                words.insert(k % len(words), f"zgrob{'xyzuv'[k // 8]}{i % 7}a")
            text = " ".join(words)
        rows.append((i, text, int(i % 5 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] % 2 == 0 or r[2] == 0], "doc_id long, toxic int")
    return rows, docs, labels


def test_toxicity_on_held_out_rows(insults):
    rows, docs, labels = insults
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = toxicity.train(docs, labels, ~held)
    scores = {r.doc_id: r.score for r in toxicity.score(docs.where(held), model).collect()}
    toxic = {r[0]: r[2] for r in rows}
    assert np.mean([scores[i] >= 0.3 for i in scores if toxic[i]]) >= 0.9
    assert np.mean([scores[i] >= 0.3 for i in scores if not toxic[i]]) <= 0.05
    kept = {r.doc_id for r in toxicity.drop_toxic(docs.where(held), model).collect()}
    assert kept == {i for i, s in scores.items() if s < 0.3}


def test_toxicity_of_messy_rows(insults, messy, clashing):
    model = toxicity.train(insults[1], insults[2].unionByName(insults[2].limit(5)), F.lit(True))
    for docs in (messy, clashing):
        rows = toxicity.score(docs, model).collect()
        assert len(rows) == messy.count() and all(0 <= r.score <= 1 for r in rows)
        assert toxicity.drop_toxic(docs, model).columns == docs.columns
    without = toxicity.train(messy, insults[2].where("toxic = 7"), F.lit(True))
    assert {r.score for r in toxicity.score(messy, without).collect()} == {0.0}


def test_risk_stays_non_negative():
    rng = np.random.default_rng(1)
    rows = [sorted(set(rng.integers(0, 50, 5).tolist())) for _ in range(300)]
    toxic = [[50, *r] for r in rows[:60]]
    w = toxicity.fit_nnpu(toxic, rows[60:] + [[50, *r] for r in rows[:30]], 51, 0.1, seed=0)
    assert w[50] == max(w[:51]) and np.isfinite(w).all()


@pytest.mark.parametrize("above", [True, False])
def test_step_is_the_gradient_of_the_risk(above):
    rng = np.random.default_rng(3)
    xp, xu = rng.normal(size=(40, 6)), rng.normal(size=(90, 6)) + 0.3
    prior = 0.2 if above else 0.95
    w = rng.normal(size=6)
    if not above:
        while toxicity.negative_risk(w, xp, xu, prior) >= 0:
            w = rng.normal(size=6) * 2
    assert (toxicity.negative_risk(w, xp, xu, prior) >= 0) == above

    def risk(w):
        positive = prior * np.logaddexp(0, -(xp @ w)).mean()
        return positive + toxicity.negative_risk(w, xp, xu, prior) if above else -toxicity.negative_risk(w, xp, xu, prior)

    numeric = [(risk(w + d) - risk(w - d)) / 2e-6 for d in np.eye(6) * 1e-6]
    assert np.allclose(toxicity.step_direction(w, xp, xu, prior), numeric, atol=1e-6)


def test_prior_from_counts_of_signs():
    rng = np.random.default_rng(4)
    toxic = rng.poisson(3, 400)
    mixed = np.r_[rng.poisson(3, 300), (rng.random(2700) < 0.02).astype(int)]
    assert 0.09 < toxicity.estimate_prior(toxic, mixed) < 0.13
    assert toxicity.estimate_prior(toxic, np.zeros(100, int)) == 1 / 102
    assert toxicity.estimate_prior(np.zeros(5, int), np.zeros(100, int)) == 0.5


def test_toxicity_from_confirmed_texts_alone(insults):
    """Labels name some of the toxic texts and nothing else; others hide among the rest."""
    rows, docs, labels = insults
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    confirmed = labels.where("toxic = 1")
    model = toxicity.train(docs, confirmed, ~held)
    assert 0.02 < model.prior < 0.3 and len(model.weights)
    scores = {r.doc_id: r.score for r in toxicity.score(docs.where(held), model).collect()}
    toxic = {r[0]: r[2] for r in rows}
    assert np.mean([scores[i] >= 0.3 for i in scores if toxic[i]]) >= 0.9
    assert np.mean([scores[i] >= 0.3 for i in scores if not toxic[i]]) <= 0.05
    given = toxicity.train(docs, confirmed, ~held, prior=0.2)
    assert given.prior == 0.2


def test_signs_of_one_word():
    assert toxicity._without_kin(["loser", "los*", "loser*", "lose*"]) == ["loser", "loser*"]
    assert toxicity._without_kin(["los*", "loser", "loser*", "idiot"]) == ["los*", "idiot"]
