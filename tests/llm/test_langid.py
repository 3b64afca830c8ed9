import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from freshet.llm import langid
from tests.llm.conftest import DOCS

LETTERS = {"aa": "abcdeé", "bb": "abcdef", "cc": "xyzuvw"}


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        lang = "aa" if i % 3 == 0 else ("bb" if i % 3 == 1 else "cc")
        text = " ".join("".join(rng.choices(LETTERS[lang], k=rng.randrange(1, 8))) for _ in range(40))
        rows.append((i, text, lang if i % 10 else None, "s", 0))
    rows += [(900, None, "aa", "s", 0), (901, "12 !", "bb", "s", 0), (902, "", "cc", "s", 0), (None, "xyz", "cc", "s", 0)]
    return rows, spark.createDataFrame(rows, DOCS)


def learns(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 4 != 2


def grams(text):
    text = text.lower()
    return Counter(b for part in langid.ngram_buckets(text, langid.BUCKETS) for b in part.tolist())


def brute(rows):
    counts, docs = {}, Counter()
    for doc_id, text, lang, *_ in rows:
        if text is not None and lang is not None and learns(doc_id):
            counts.setdefault(lang, Counter()).update(grams(text))
            docs[lang] += 1
    out = {}
    for doc_id, text, *_ in rows:
        if text is None or not any(map(str.isalpha, text)):
            out[doc_id] = ("und", 0.0)
            continue
        total = {}
        for lang, c in counts.items():
            size = sum(c.values()) + langid.SMOOTHING * langid.BUCKETS
            total[lang] = math.log(docs[lang] / sum(docs.values())) + sum(n * math.log((c[b] + langid.SMOOTHING) / size) for b, n in grams(text).items())
        best = max(sorted(total), key=total.get)
        out[doc_id] = (best, 1 / sum(math.exp((v - total[best]) / len(text)) for v in total.values()))
    return out


def test_predictions_equal_brute_force(corpus):
    rows, frame = corpus
    want = brute(rows)
    for r in langid.identify(frame).collect():
        assert r["lang_pred"] == want[r["doc_id"]][0]
        assert r["score"] == pytest.approx(want[r["doc_id"]][1], abs=1e-3)
        assert r["held_out"] == (not learns(r["doc_id"]))


def test_held_out_accuracy(corpus):
    rows, frame = corpus
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in langid.identify(frame).collect() if r["held_out"] and r["lang_pred"] != "und" and truth[r["doc_id"]]]
    assert len(held) > 40 and np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.95


def test_scores_tell_sure_from_unsure_texts(corpus):
    rows, frame = corpus
    scores = {r["doc_id"]: r["score"] for r in langid.identify(frame).collect() if r["lang_pred"] != "und"}
    sure = [scores[r[0]] for r in rows if r[2] == "cc" and r[0] in scores]
    close = [scores[r[0]] for r in rows if r[2] in ("aa", "bb") and r[0] in scores]
    assert max(scores.values()) < 1 and np.mean(sure) > np.mean(close)


def test_batches_of_any_size_predict_alike(corpus, monkeypatch):
    rows, _ = corpus
    model = langid.LanguageModel(["a", "b"], np.random.default_rng(1).normal(size=(langid.BUCKETS, 2)).astype(np.float32), np.log([0.5, 0.5]))
    texts = [r[1] for r in rows]
    want = model.predict(texts)
    alone = [model.predict([t]) for t in texts]
    monkeypatch.setattr(langid, "_STRETCH", 50)
    small = model.predict(texts)
    assert want[0] == small[0] == [a[0][0] for a in alone]
    assert want[1] == pytest.approx(small[1], rel=1e-9) and want[1] == pytest.approx([a[1][0] for a in alone], rel=1e-9)
    assert model.predict([]) == ([], [])


def test_long_texts_lose_nothing_at_stretches(monkeypatch):
    text = "abcé xyz" * 500
    want = grams(text)
    monkeypatch.setattr(langid, "_STRETCH", 7)
    assert grams(text) == want
    n = len(text)
    assert sum(want.values()) == n + (n - 1) + (n - 2)


def test_awkward_rows(docs, clashing, no_docs, awkward_texts):
    for frame in (docs, clashing):
        rows = langid.identify(frame).collect()
        assert len(rows) == len(awkward_texts) and all(0 <= r["score"] <= 1 for r in rows)
    assert langid.identify(no_docs).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs.withColumn("lang", docs.lang.substr(9, 1)).where("false").unionByName(docs.where("lang is null"))).collect()} == {"und"}
