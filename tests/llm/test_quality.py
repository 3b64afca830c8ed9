import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freshet.llm import quality
from freshet.llm.common import Vocabulary
from tests.llm.conftest import DOCS, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    """The statistics by their definitions, one after the other."""
    text = text or ""
    found = WORD.findall(text)
    windows = Counter(tuple(found[i : i + 3]) for i in range(len(found) - 2))
    inside = {j for i in range(len(found) - 2) if windows[tuple(found[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines, seen, duplicates = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            duplicates += line in seen
            seen.add(line)
    failed = len(found) < 50 or 100 * len(inside) > 50 * len(found)
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(inside), failed


@given(st.text(alphabet="ab #%\n\t\x0bé ", max_size=120))
def test_statistics_of_any_text(text):
    data = text.encode()
    numbers = Vocabulary().numbers(data.split())
    n, _, _, duplicates, repeats, _ = base(text)
    assert (len(numbers), quality.duplicate_lines(data), quality.repeated_words(numbers)) == (n, duplicates, repeats)


@pytest.fixture(scope="module")
def corpus(spark):
    """Prose, and junk whose words carry symbols; a third of the prose is one text."""
    rng, known = random.Random(9), words(0, 300)
    rows, common = [], " ".join(rng.choices(known, k=150))
    for i in range(240):
        text = rng.choices(known, k=150)
        rows.append((i, common if i % 3 == 0 and i % 8 else " ".join(text) if i % 8 else "%% ".join(text), "en", "s", 0))
    labels = [(i, 0 if i % 8 == 0 else 1, 0) for i in range(0, 240, 2)] + [(500, None, None), (None, 1, 0)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def brute_scores(rows, trusted, buckets=quality.BUCKETS, smoothing=quality.SMOOTHING):
    """Score of each of ``rows(doc_id, text, lang)`` by loops over all texts; ``trusted`` are doc_ids."""

    def grams(text, lang):
        found = [w.encode() for w in WORD.findall(text or "")]
        hashes = [xxhash.xxh64_intdigest(w) for w in found]
        left, right = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
        grams = list(hashes)
        data = b" " + b" ".join(found) + b" "
        grams += [(data[i] << 16 | data[i + 1] << 8 | data[i + 2] | 1 << 24) * right for i in range(len(data) - 2)] if found else []
        language = 0 if lang is None else xxhash.xxh64_intdigest(lang.encode())
        mixed = [g % 2**64 ^ language for g in grams]
        return Counter(((g ^ g >> 31) * left % 2**64 >> 32) % buckets for g in mixed)

    copies, praised = Counter(text for _, text, _ in rows), {text for doc_id, text, _ in rows if doc_id in trusted}
    corpus, target, sums = Counter(), Counter(), Counter()
    for _, text, lang in rows:
        for g, n in grams(text, lang).items():
            corpus[g] += Fraction(n, copies[text])
            sums[lang, 0] += Fraction(n, copies[text])
            if text in praised:
                target[g] += Fraction(n, copies[text])
                sums[lang, 1] += Fraction(n, copies[text])
    scores = {}
    for doc_id, text, lang in rows:
        own = grams(text, lang)
        size, good = own.total(), text in praised
        all_others, all_trusted = sums[lang, 0] - size, sums[lang, 1] - size * good
        if not size or all_others <= 0 or all_trusted <= 0:
            scores[doc_id] = 0.0
            continue
        share = float(all_trusted / all_others)
        ratio = lambda g, n: (max(target[g] - n * good, 0) + smoothing * share) / (max(corpus[g] - n, 0) + smoothing) / share
        scores[doc_id] = sum(n * math.log(ratio(g, n)) for g, n in own.items()) / size
    return scores


def test_scores_equal_brute_force_and_junk_goes(corpus):
    docs, labels = corpus
    ids = quality.trusted(labels)
    rows = quality.assess(docs, ids).select("row.doc_id", "row.text", "row.lang", "quality.*").collect()
    want = brute_scores([(r["doc_id"], r["text"], r["lang"]) for r in rows], {r["doc_id"] for r in ids.collect()})
    for r in rows:
        assert r["score"] == pytest.approx(want[r["doc_id"]], abs=1e-9)
        assert r["kept"] == (not r["base_failed"] and r["score"] >= quality.THRESHOLD)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base(r["text"])
    good = [r for r in rows if r["doc_id"] % 8 and r["doc_id"] % 3 and not r["base_failed"]]
    assert all(r["kept"] for r in good)
    assert not any(r["kept"] for r in rows if r["doc_id"] % 8 == 0)


def test_shuffled_ids_give_the_same(corpus, monkeypatch):
    docs, labels = corpus
    want = {r["doc_id"]: r["score"] for r in quality.assess(docs, quality.trusted(labels)).select("row.doc_id", "quality.score").collect()}
    monkeypatch.setattr(quality, "BROADCAST_IDS", 0)
    got = {r["doc_id"]: r["score"] for r in quality.assess(docs, quality.trusted(labels)).select("row.doc_id", "quality.score").collect()}
    assert got == want


def test_awkward_rows(docs, clashing, no_docs, corpus, awkward_texts):
    ids = quality.trusted(corpus[1])
    for frame in (docs, clashing):
        rows = quality.assess(frame, ids).select("row.text", "quality.*").collect()
        assert len(rows) == len(awkward_texts)
        assert all((r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base(r["text"]) for r in rows)
    assert quality.assess(no_docs, ids).count() == 0
    rows = quality.assess(docs, ids.where(F.lit(False))).select("quality.*").collect()
    assert all(r["score"] == 0 for r in rows)


@pytest.fixture(scope="module")
def thinly_labelled(spark):
    """Labelled prose and junk; unlabelled: clean copies, clean near copies, a clean language, and junk."""
    rng, known, foreign = random.Random(4), words(0, 300), [w + "ß" for w in words(21, 300)]
    prose = lambda pool: rng.choices(pool, k=150)
    rows = [(i, " ".join(prose(known)) if i % 4 else "%% ".join(prose(known)), "en", "s", 0) for i in range(200)]
    copied, near = " ".join(prose(known)), prose(known)
    rows += [(1000 + i, copied, "en", "s", 0) for i in range(90)]
    rows += [(2000 + i, " ".join([*near[:149], f"end{i}"]), "en", "s", 0) for i in range(90)]
    rows += [(3000 + i, " ".join(prose(foreign)), "de", "s", 0) for i in range(90)]
    rows += [(4000 + i, "%% ".join(prose(known)), "en", "s", 0) for i in range(20)]
    labels = [(i, int(i % 4 > 0), 0) for i in range(200)] + [(None, 0, 0), (9, None, 0)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def kept_ids(frame):
    return {r["doc_id"] for r in frame.where("quality.kept").select("row.doc_id").collect()}


def test_clean_texts_stay_though_labels_do_not_cover_them(thinly_labelled):
    docs, labels = thinly_labelled
    kept = kept_ids(quality.assess(docs, quality.trusted(labels)))
    assert kept == {r["doc_id"] for r in docs.select("doc_id").collect() if r["doc_id"] >= 1000 or r["doc_id"] % 4} - set(range(4000, 4020))


def test_query_and_stage_are_the_operator_and_equal_brute_force(spark, thinly_labelled, tmp_path):
    from corpus_pipeline import quality_rules
    from freshet.llm.queries import op3_quality

    docs, labels = thinly_labelled
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    found = {r["doc_id"]: r for r in op3_quality(spark, str(tmp_path)).collect()}
    trusted = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    want = brute_scores([(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()], trusted)
    assert {d: r["score"] for d, r in found.items()} == pytest.approx(want, abs=1e-9)
    kept = {d for d, r in found.items() if r["kept"]}
    assert kept == {d for d, score in want.items() if score >= quality.THRESHOLD and not found[d]["base_failed"]}
    assert {r["doc_id"] for r in quality_rules(spark, docs, str(tmp_path)).collect()} == kept


def test_texts_count_once_and_not_for_themselves(spark, thinly_labelled, monkeypatch):
    docs, labels = thinly_labelled
    ids = quality.trusted(labels)
    scores = lambda frame: {r["doc_id"]: r["score"] for r in quality.assess(frame, ids).select("row.doc_id", "quality.score").collect()}
    want = scores(docs)
    copies = docs.where("doc_id in (0, 1, 7)").crossJoin(spark.range(70)).select((F.col("id") * 1000 + 9000 + F.col("doc_id")).alias("doc_id"), "text", "lang", "source", "n_chars")
    more = labels.where("doc_id in (0, 1, 7)").crossJoin(spark.range(70)).select((F.col("id") * 1000 + 9000 + F.col("doc_id")).alias("doc_id"), "quality", "toxic")
    ids = quality.trusted(labels.unionByName(more))
    got = scores(docs.unionByName(copies))
    assert all(got[i] == pytest.approx(want[i], abs=1e-9) for i in want)
    assert all(got[9000 + i] == got[i] for i in (0, 1, 7))
    monkeypatch.setattr(quality, "BROADCAST_IDS", 0)
    assert scores(docs.unionByName(copies)) == pytest.approx(got, abs=1e-12)


def test_texts_are_shuffled_once_at_most(thinly_labelled, monkeypatch):
    docs, labels = thinly_labelled
    monkeypatch.setattr(quality, "BROADCAST_IDS", 0)
    docs.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = quality.assess(docs, quality.trusted(labels))._jdf.queryExecution().executedPlan().toString()
    finally:
        docs.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in plan and plan.count("Exchange hashpartitioning") == 2  # rows and marks
    # Below the exchange of the rows there is the struct and its text's hash, and no text beside it.
    (columns,) = {re.search(r"Project \[(.*)\]", line)[1] for line in plan.splitlines() if "Project" in line and " AS row" in line}
    assert re.sub(r"(named_struct|struct)\(.*?\) AS row#\d+", "row", columns).count("text#") == 1


def test_language_without_the_column_and_without_trust(spark, thinly_labelled):
    docs, labels = thinly_labelled
    plain = quality.assess(docs.drop("lang"), quality.trusted(labels)).select("row.doc_id", "quality.score").collect()
    want = brute_scores([(r["doc_id"], r["text"], None) for r in docs.collect()], {r["doc_id"] for r in labels.where("quality = 1").collect()})
    assert {r["doc_id"]: r["score"] for r in plain} == pytest.approx(want, abs=1e-9)
    scores = {r["doc_id"]: r["score"] for r in quality.assess(docs, quality.trusted(labels)).select("row.doc_id", "quality.score").collect()}
    assert all(scores[3000 + i] == 0 for i in range(90))
