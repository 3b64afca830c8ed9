import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.llm import ranking
from tests.llm.conftest import words

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    split = [(d, terms(t)) for d, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in split), sum(len(w) for _, w in split)
    out = []
    for item_id, text in set(items):
        own = set(terms(text))
        df = {t: sum(t in set(w) for _, w in split) for t in own}
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in own}
        scored = []
        for doc_id, ws in split:
            if ws:
                m = 100 - 90 + (90 * len(ws) * n_docs) // n_terms
                score = sum(w[t] * ((1000000000 * ws.count(t)) // (1000 * ws.count(t) + 8 * m)) for t in own if t in ws)
                if score > 0:
                    scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def tables(seed=3):
    rng = random.Random(seed)
    pool = words(1, 120) + ["née", "漢字", "Größe", "B2"]
    docs = [(i, " ".join(rng.choice(pool[: 4 + i % 120]) for _ in range(rng.randrange(1, 90)))) for i in range(150)]
    docs += [(200 + i, docs[7][1]) for i in range(25)] + [(None, docs[7][1]), (None, docs[8][1]), (7, docs[7][1])]
    docs += [(300, None), (301, ""), (302, " ... \n"), (303, "x" * 5000 + " " + "Ab-ab_AB " * 4000), (304, "Ünder under\x1fUNDER")]
    items = [(i, ", ".join(rng.choice(pool) for _ in range(rng.randrange(1, 25)))) for i in range(40)]
    items += [(40, None), (41, "..."), (42, "ab"), (42, "ab"), (None, "under née"), (43, "nowhere at_all?")]
    rng.shuffle(docs)
    return docs, items


@pytest.mark.parametrize(("options"), [{}, {"block_characters": 300, "item_tile": 3, "term_tile": 5, "document_tile": 7}, {"best": 1}, {"best": 500}])
def test_equals_brute_force_at_any_tiling(spark, options):
    docs, items = tables()
    frame = ranking.ranked(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
        **options,
    )
    assert got(frame) == brute(docs, items, options.get("best", 10))


def test_awkward_rows_and_clashing_names(docs, clashing, spark):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(1, " ".join(words(1, 12))), (2, "漢字 naïve one two")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    extra = clashing.withColumns({n: F.lit("x") for n in ("n", "terms", "counts", "item", "rank", "item_id")})
    assert got(ranking.ranked(docs, frame)) == got(ranking.ranked(extra, frame.withColumn("doc_id", F.lit(1)))) == brute(rows, items)


def test_no_rows(spark, docs, no_docs):
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert ranking.ranked(no_docs, items).collect() == []
    assert ranking.ranked(docs, items.limit(0)).collect() == []


def test_tiles_stay_exact():
    assert ranking.term_width(45_000, 10**9) * 45_000 * 10**6 < 2**53
    assert ranking.term_width(0, 2048) == 2048 and ranking.term_width(10**12, 2048) == 1
    rng = np.random.default_rng(1)
    own = [rng.choice(900, 400, replace=False).tolist() for _ in range(6)]
    weights = rng.integers(20_000, 45_000, 900)
    owner, terms_ = np.divmod(rng.choice(40 * 900, 20_000, replace=False), 900)
    impacts = rng.integers(1, 10**6, 20_000)
    plain = [[sum(int(weights[t]) * int(v) for o, t, v in zip(owner, terms_, impacts) if o == d and t in set(own[i])) for i in range(6)] for d in range(40)]
    first, second = ranking.tiles_of(own, weights, 4)
    for width in (7, 900):
        both = [ranking.scores(t, owner, terms_, impacts, 40, width) for t in (first, second)]
        assert np.concatenate(both, axis=1).tolist() == plain


def test_terms():
    text = "".join(map(chr, range(0x250))) + " A1b_漢字-é"
    assert ranking.terms_of(text) == [t.encode() for t in terms(text)]
