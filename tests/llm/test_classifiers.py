"""Trained models: accuracy on rows that were not trained on, and odd rows."""

import numpy as np
import pytest

from mensura.llm import quality, toxicity

SF = "/root/testdata/sf0.01"


def labelled(rows):
    """Toxic texts hold a stem that clean ones never hold, with any ending."""
    rnd = np.random.default_rng(4)
    out = []
    for i in range(rows):
        words = [f"w{rnd.integers(3000)}" for _ in range(int(rnd.choice([6, 60, 600])))]
        bad = i % 5 == 0
        if bad:
            for _ in range(2):
                words.insert(int(rnd.integers(len(words))), str(rnd.choice(["idiot", "scum", f"blarg{rnd.integers(50)}"])))
        out.append((i, " ".join(words), int(bad)))
    return out


def test_chain_on_held_out_rows(spark, frame):
    rows = labelled(900)
    docs = frame([(d, t) for d, t, _ in rows])
    labels = spark.createDataFrame([(d, y, "text") for d, _, y in rows if d < 600], "doc_id long, toxic int, text string")
    got = {r.doc_id: r for r in toxicity.toxic_scores(docs, labels).collect()}
    wrong = sum(got[d].rejected != bool(y) for d, _, y in rows if d >= 600)
    assert len(got) == 900 and wrong <= 6
    assert all(0 <= got[d][f"p_{c}"] <= 1 for d in range(600) for c in toxicity.CHAIN)


def test_later_links_use_out_of_fold_predictions():
    rnd = np.random.default_rng(2)
    n = 400
    row, col = np.repeat(np.arange(n), 20), rnd.integers(0, 1 << 20, n * 20)  # nothing to learn
    labels = np.stack([rnd.integers(0, 2, n)] * 2, 1)
    _, outside = toxicity.fit_chain(row, col, labels, np.arange(n) % toxicity.FOLDS)
    assert abs(((outside[:, 0] > 0.5) == labels[:, 0]).mean() - 0.5) < 0.12


def test_toxicity_odd_rows(spark, odd, nothing):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    some = spark.createDataFrame([(1, 1), (4, 0), (5, None), (None, 1), (77, 1)], "doc_id long, toxic int")
    for labels in (none, some):
        rows = toxicity.toxic_scores(odd, labels).collect()
        assert len(rows) == 9 and not any(r.rejected for r in rows if r.doc_id in (1, 2, 3))
    assert toxicity.toxic_scores(nothing, none).count() == 0


def test_quality_agrees_with_labels_never_seen(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r.keep for r in quality.score(docs).collect()}
    want = {r.doc_id: r.quality for r in labels.collect()}
    assert len(got) == docs.count()
    assert np.mean([got[d] == bool(q) for d, q in want.items()]) > 0.95


def test_label_model_finds_the_accurate_labeller():
    rnd = np.random.default_rng(3)
    y = rnd.random(20_000) < 0.8
    votes = np.full((len(y), 10), -1)
    for j, (miss, slip) in enumerate([(0.3, 0.0), (0.4, 0.01), (0.9, 0.3)]):
        votes[(~y & (rnd.random(len(y)) > miss)) | (y & (rnd.random(len(y)) < slip)), j] = 0
    votes[y & (rnd.random(len(y)) < 0.9), 8] = 1
    votes[rnd.random(len(y)) < 0.5, 9] = 1
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    post, given, prior = quality.label_model(patterns, n.astype(float))
    assert abs(prior - 0.8) < 0.05
    assert given[0, 0, 1] > 0.5 and given[0, 1, 1] < 0.02 and abs(given[9, 0, 2] - given[9, 1, 2]) < 0.1


def test_quality_odd_rows(odd, nothing):
    rows = quality.score(odd).collect()
    assert len(rows) == 9 and all(r.keep for r in rows if r.doc_id in (1, 2, 3, 4))
    assert quality.score(nothing).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_codes_round_trip(seed):
    v = np.random.default_rng(seed).integers(-1, 2, (50, len(quality.LABELLERS)))
    assert (quality._decoded(quality._coded(v)) == v).all()
