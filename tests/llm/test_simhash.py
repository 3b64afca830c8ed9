import random
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from freshet.llm import simhash
from freshet.llm.components import components
from tests.llm.conftest import DOCS, words


def plain_simhash(text):
    tokens = [w for w in (text or "").encode().lower().split()]
    shingles = [b" ".join(tokens[i : i + 3]) for i in range(max(1, len(tokens) - 2))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(fps, radius=3):
    """Least member of the component of every index, by all pairs."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= radius:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(fps))]


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def test_fingerprints(docs, awkward_texts):
    rows = docs.select("text", simhash.fingerprint("text").alias("fp"), simhash.fingerprint_hex(simhash.fingerprint("text")).alias("h")).collect()
    for r in rows:
        assert r["h"] == f"{plain_simhash(r['text']):016x}" and r["fp"] == signed(int(r["h"], 16))


def test_hash_is_sparks(spark):
    shingle = "one two three"
    assert spark.range(1).select(F.xxhash64(F.lit(shingle)).alias("h")).first()["h"] == signed(xxhash.xxh64_intdigest(shingle.encode(), 42))


def test_masks_cover_every_pair_within_the_radius():
    masks = [m % (1 << 64) for m in simhash.covering_masks()]
    assert len(masks) == 15
    for bits in combinations(range(64), 3):
        difference = sum(1 << b for b in bits)
        assert any(m & difference == 0 for m in masks)


def near_copies(seed, centres, copies, flips):
    rng = random.Random(seed)
    fps = []
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(copies):
            fps.append(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(flips + 1))))
    return fps


@pytest.mark.parametrize("limit", [2, 5, 16_384])
def test_groups_equal_brute_force_at_any_bucket_limit(spark, limit):
    fps = [*near_copies(1, 12, 12, 4), *near_copies(2, 1, 120, 2), *near_copies(3, 150, 1, 0), 0, 0, (1 << 64) - 1]
    rows = [(i, signed(fp)) for i, fp in enumerate(fps)]
    groups = simhash.near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, fp long"), bucket_members=limit)
    got = {r["fp"]: r["component_id"] for r in groups.collect()}
    want = brute_groups(fps)
    assert [got[signed(fp)] for fp in fps] == want


def test_chain_is_one_group(spark):
    fps = [(1 << (3 * i)) - 1 for i in range(21)]
    groups = simhash.near_duplicate_groups(spark.createDataFrame([(i + 5, signed(f)) for i, f in enumerate(fps)], "doc_id long, fp long"))
    assert {r["component_id"] for r in groups.collect()} == {5}


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000, i) for i in range(1001, 1100)] + [(i, i + 1) for i in range(2000, 2070)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_of_texts(docs, clashing, no_docs, awkward_texts):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(awkward_texts)
    ids = [None if i == 4 else i for i in range(len(awkward_texts))]
    want = brute_groups([plain_simhash(t) for t in awkward_texts])
    least = {g: min((i for i, x in zip(ids, want) if x == g and i is not None), default=None) for g in set(want)}
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: least[g] for i, g in zip(ids, want)}
    assert simhash.near_duplicates(clashing).count() == len(awkward_texts)
    assert simhash.near_duplicates(no_docs).count() == 0


def test_one_of_each_group_stays_with_all_its_columns(spark, clashing, no_docs):
    kept = simhash.keep_one(clashing)
    assert kept.columns == clashing.columns
    groups = simhash.near_duplicates(clashing).select("component_id").distinct().count()
    assert kept.count() == groups
    assert simhash.keep_one(no_docs).count() == 0
    text = " ".join(words(4, 80))
    repeated = spark.createDataFrame([(3, text, "en", "s", 1), (3, text, "en", "s", 1), (9, text, "en", "s", 1), (10, text[::-1], "en", "s", 1)], DOCS)
    assert sorted(r["doc_id"] for r in simhash.keep_one(repeated).collect()) == [3, 10]


def test_ties_do_not_depend_on_the_layout(spark):
    """Rows equal in doc_id and text that differ elsewhere: the same one stays, however they are dealt."""
    text = " ".join(words(4, 80))
    rows = [(3, text, lang, "s", 1) for lang in "xyzuvw"]
    kept = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame(rows, DOCS).repartition(1 + seed)
        kept.add(simhash.keep_one(frame.withColumn("m", F.create_map("lang", F.lit(1)))).first()["lang"])
    assert len(kept) == 1
