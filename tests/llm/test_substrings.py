import random

import pytest
from pyspark.sql import functions as F

from freshet.llm import substrings
from tests.llm.conftest import DOCS, words


def brute(rows, window):
    """Kept words of every row, by a dictionary of all windows."""
    rank = lambda doc, i: (doc is not None, doc or 0, i)
    split = [(doc, (text or "").encode().split()) for doc, text in rows]
    first = {}
    for doc, ws in split:
        for i in range(len(ws) - window + 1):
            key = tuple(ws[i : i + window])
            first[key] = min(first.get(key, rank(doc, i)), rank(doc, i))
    out = []
    for doc, ws in split:
        gone = set()
        for i in range(len(ws) - window + 1):
            if rank(doc, i) > first[tuple(ws[i : i + window])]:
                gone.update(range(i, i + window))
        out.append((doc, len(ws), len(gone), b" ".join(w for j, w in enumerate(ws) if j not in gone).decode()))
    return sorted(out, key=repr)


def found(frame):
    rows = frame.select("row.doc_id", "n_words", "n_removed", "kept").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def texts():
    rng = random.Random(5)
    line = words(1, 12)
    passage = words(2, 60)
    pool = words(3, 30)
    rows = [(100 + i, " ".join(words(10 + i, 40) + line + words(60 + i, 30))) for i in range(30)]
    rows += [(200 + i, " ".join(words(110 + i, 25) + passage[i % 5 :] + words(160 + i, 10))) for i in range(12)]
    rows += [(300 + i, " ".join(rng.choice(pool[:2]) for _ in range(80))) for i in range(8)]
    rows += [(400, " ".join(["same"] * 300)), (401, " ".join(["same"] * 25)), (402, " ".join(words(500, 9000)))]
    rows += [(403 + i, rows[3][1]) for i in range(40)] + [(None, rows[4][1]), (None, rows[4][1]), (99, rows[4][1])]
    rows += [(500, rows[5][1]), (500, rows[5][1]), (500, rows[6][1] + " " + rows[5][1]), (501, None), (None, None), (502, "")]
    rows += [(-7, " ".join(passage)), (503, "\x1f".join(passage)), (504, "née ".join(passage)), (505, "\r\n".join(passage))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("share", "waves", "bucket"), [(1000, 2, 2_000_000), (3, 1, 2_000_000), (50, 3, 100)])
def test_equals_brute_force_at_any_limit(spark, share, waves, bucket):
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substrings.without_repeats(docs, hot_share=share, waves=waves, bucket_windows=bucket)
    assert found(got) == brute(rows, 20)


@pytest.mark.parametrize(("window", "minimiser"), [(5, 1), (5, 5), (7, 2), (1, 1)])
def test_other_widths(spark, window, minimiser):
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(substrings.without_repeats(docs, window=window, minimiser=minimiser)) == brute(rows, window)


def test_awkward_rows_and_clashing_names(docs, clashing):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(substrings.without_repeats(docs)) == brute(rows, 20)
    extra = clashing.withColumns({n: F.lit("x") for n in ("doc", "text_hash", "key", "packed", "start", "windows", "removed", "kept", "cut", "doc_key", "hash_key")})
    got = substrings.without_repeats(extra)
    assert found(got) == brute(rows, 20) and got.select("row.*").columns == extra.columns


def test_spans_are_whole_and_removed_words_are_theirs(spark):
    passage = " ".join(words(9, 50))
    docs = spark.createDataFrame([(1, "a b " + passage), (2, "x " + passage + " y z " + passage)], "doc_id long, text string")
    got = {r["row"]["doc_id"]: r for r in substrings.without_repeats(docs).collect()}
    assert got[1]["removed"] == [] and got[1]["kept"] == "a b " + passage
    assert [tuple(s) for s in got[2]["removed"]] == [(1, 51), (53, 103)] and got[2]["kept"] == "x y z"


def test_no_rows(no_docs):
    assert substrings.without_repeats(no_docs).collect() == []


def test_frequent_minimisers_are_found(spark):
    rows = [(i, " ".join(words(i, 19) + ["the", "same", "three"] + words(1000 + i, 19))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    counts = {}
    for _, text in rows:
        chunk = substrings._Chunk([text.encode()], 20, 3)
        for key in chunk.key.tolist():
            counts[key] = counts.get(key, 0) + 1
    total = sum(counts.values())
    for share in (5, 10, 30):
        hot = substrings.hot_minimisers(docs, 20, 3, share)
        assert len(hot) <= 2 * share and {k for k, n in counts.items() if n * share > total} <= set(hot)


def test_docs_schema_of_tables(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s", 1)], DOCS)
    assert substrings.without_repeats(docs).first()["kept"] == "a"
