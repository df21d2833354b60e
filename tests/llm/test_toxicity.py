from collections import Counter

import numpy as np

from tests.llm.cases import documents, prose, texts, written
from tidemark.llm import toxicity as toxicity_module
from tidemark.llm.toxicity import FOLDS, best_cutoff, features, fit, toxicity, train_on


def trained(rows, categories, module=toxicity_module):
    counts = Counter(f for _, t, _ in rows for f in features(t))
    vocabulary = sorted(f for f, n in counts.items() if 5 <= n <= 0.5 * len(rows))
    number = {f: k for k, f in enumerate(vocabulary)}
    return module.train([(i, [number[f] for f in features(t) if f in number], y) for i, t, y in rows], vocabulary, categories)


def labelled(n: int, seed: int):
    rows = []
    for k in range(n):
        text = prose(seed + k, 60, 2000)
        kind = k % 10
        if kind == 0:
            text += " you blockhead"
        elif kind == 1:
            text = "schurk" + "abcdef"[k % 6] + "el " + text
        rows.append((seed + k, text, (int(kind == 0), int(kind == 1), int(kind < 2))))
    return rows


def test_held_out_accuracy():
    chain = trained(labelled(1500, 0), ["plain", "spelled", "any"])
    rows = labelled(800, 100_000)
    found = chain.predict([features(t) for _, t, _ in rows]) > np.array(chain.cutoffs)
    truth = np.array([y for _, _, y in rows]) > 0
    assert ((found == truth).mean(axis=0) > 0.99).all()
    assert any(f.endswith("*") for f in chain.vocabulary)


def test_later_models_see_the_earlier_categories():
    chain = trained([(i, t, (y[0], y[0])) for i, t, y in labelled(600, 0)], ["first", "second"])
    assert len(chain.models[0].chained) == 0 and chain.models[1].chained[0] > 0


def test_out_of_fold_predictions_come_from_other_folds(monkeypatch):
    sizes = []
    monkeypatch.setattr(toxicity_module, "fit", lambda rows, before, label, width: (
        sizes.append((len(label), before.shape[1])), fit(rows, before, label, width))[1])
    trained(labelled(300, 0), ["a", "b", "c"])
    assert [s[1] for s in sizes] == [0] * (FOLDS + 1) + [1] * (FOLDS + 1) + [2] * (FOLDS + 1)
    assert sum(n for n, _ in sizes[:FOLDS]) == (FOLDS - 1) * 300 and sizes[FOLDS][0] == 300


def test_cutoff():
    assert best_cutoff(np.array([0.9, 0.8, 0.2]), np.array([1, 1, 0])) == 0.5
    assert best_cutoff(np.array([0.9]), np.array([0])) == 1.0


def test_documents(spark, folder):
    rows = labelled(400, 0)
    odd = [(10_000 + k, t) for k, (_, t) in enumerate(texts())]
    docs = documents(spark, folder, [(i, t) for i, t, _ in rows] + odd + [(None, "you blockhead")])
    labels = written(spark, folder, [(i, *y) for i, _, y in rows] + [(None, 1, 1, 1), (3, None, 0, 0), (0, 1, 0, 1)],
                     "doc_id long, plain int, spelled int, any int")
    chain = train_on(docs, labels, ["plain", "spelled", "any"])
    found = toxicity(docs, chain).collect()
    assert len(found) == len(rows) + len(odd) + 1
    truth = {i: bool(y[2]) for i, _, y in rows}
    wrong = sum(r.is_any != truth[r.doc_id] for r in found if r.doc_id in truth)
    assert wrong <= 4 and not any(r.is_any for r in found if (r.doc_id or 0) >= 10_000)
    # the sample is bounded, spread by hash and the same every time
    small = train_on(docs, labels, ["plain"], sample=50)
    assert small.cutoffs == train_on(docs, labels, ["plain"], sample=50).cutoffs
    empty = train_on(docs, labels.limit(0), ["plain"])
    assert not any(r.is_plain for r in toxicity(docs, empty).collect())
    assert toxicity(documents(spark, folder, []), chain).count() == 0
