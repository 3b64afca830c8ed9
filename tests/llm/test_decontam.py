import random

import pytest

from freshet.llm import decontam
from tests.llm.conftest import DOCS, words


def brute(docs, items):
    pairs = []
    for doc_id, text in docs:
        ws = decontam.words_of(text)
        for item_id, item in items:
            sought = decontam.shingles(decontam.words_of(item))
            width = min(5, len(decontam.words_of(item)))
            own = {b" ".join(ws[i : i + width]) for i in range(len(ws) - width + 1)}
            if sought and 5 * len(sought & own) >= 4 * len(sought):
                pairs.append((doc_id, item_id, len(sought & own), len(sought)))
    return sorted(pairs)


@pytest.fixture(scope="module")
def planted(spark):
    """Long documents with whole, damaged and scattered items inside; items of many sizes."""
    rng = random.Random(3)
    items = [(i, " ".join(words(1000 + i, 4 + 3 * i))) for i in range(25)] + [(90, None), (91, ""), (92, "a b"), (93, "one")]
    docs = []
    for i in range(60):
        text = words(i, 50 if i % 4 else 6000)
        for _, item in rng.sample(items[:25], 2):
            inside = item.split()
            for _ in range(rng.randrange(4)):
                inside[rng.randrange(len(inside))] = "changed"
            at = rng.randrange(len(text))
            text[at:at] = inside
        docs.append((i, " ".join(text).upper() if i % 5 == 0 else " \n".join(text)))
    docs += [(100, "a b"), (101, "one"), (102, None), (103, ""), (104, "A  B"), (104, "A  B")]
    return docs, items


def found(spark, docs, items, **options):
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS)
    rows = decontam.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string"), **options).collect()
    assert all(r["containment"] == r["n_shared"] / r["n_shingles"] for r in rows)
    return sorted((r["doc_id"], r["item_id"], r["n_shared"], r["n_shingles"]) for r in rows)


def test_pairs_equal_brute_force(spark, planted):
    docs, items = planted
    want = brute(docs, items)
    assert len(want) > 40 and any(n < q for _, _, n, q in want)
    assert found(spark, docs, items) == want
    assert found(spark, docs, items, block_characters=300) == want


def test_short_items_in_long_documents(spark):
    text = words(1, 9000)
    docs = [(1, " ".join(text[:5000] + ["Capital", "of", "FRANCE"] + text[5000:])), (2, "capital of france"), (3, "capital of"), (4, "of france capital of x france"), (5, " ".join(text))]
    items = [(1, "capital of france"), (2, "France"), (3, "capital of"), (4, "capital of france is paris")]
    want = brute(docs, items)
    assert {p[:2] for p in want} == {(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3), (3, 3), (4, 2), (4, 3)}
    assert found(spark, docs, items) == found(spark, docs, items, block_characters=1) == want


def test_blocks_follow_each_other(spark, planted, monkeypatch):
    """Ten blocks of items: an index is given up before the next one is built."""
    docs, items = planted
    live, most = set(), []
    context = type(spark.sparkContext)
    plain = context.broadcast

    def broadcast(self, value):
        shared = plain(self, value)
        if isinstance(value, decontam.Index):
            live.add(id(shared))
            most.append(len(live))
            destroy = shared.destroy
            shared.destroy = lambda *a: (live.discard(id(shared)), destroy(*a))
        return shared

    monkeypatch.setattr(context, "broadcast", broadcast)
    size = sum(len(t or "") for _, t in items)
    assert found(spark, docs, items, block_characters=size // 10) == brute(docs, items)
    assert len(most) >= 8 and max(most) == 1
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS)
    left = decontam.without_leaks(frame, spark.createDataFrame(items, "item_id long, text string"), size // 10)
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(i for i, _ in docs if i not in {p[0] for p in brute(docs, items)})
    assert max(most) == 1


def test_awkward_tables(spark, docs, clashing, no_docs, planted):
    items = spark.createDataFrame(planted[1], "item_id long, text string")
    assert decontam.find_leaks(docs, items.limit(0)).count() == 0
    assert decontam.find_leaks(no_docs, items).count() == 0
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for frame in (docs, clashing):
        got = decontam.find_leaks(frame, items).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in got) == [p[:2] for p in brute(rows, planted[1])]
        left = decontam.without_leaks(frame, items)
        assert left.columns == frame.columns
        assert left.count() == frame.count() - len({r["doc_id"] for r in got})
    assert decontam.without_leaks(docs, items.limit(0)).count() == docs.count()
