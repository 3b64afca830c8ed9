import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.conftest import DOCS, words
from tests.llm.test_decontam import brute as brute_leaks
from tests.llm.test_quality import base, brute_scores
from tests.llm.test_secrets import GOOD
from tests.llm.test_simhash import brute_groups, plain_simhash

from freshet.llm import quality, secrets


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    import random

    rng, known = random.Random(2), words(11, 300)
    rows, items = [], [(i, " ".join(words(5000 + i, 20))) for i in range(4)]
    for i in range(150):
        text = rng.choices(known, k=120)
        if i % 9 == 0:
            text = [w + "%%" for w in text]
        if i % 11 == 1:
            text[40:40] = items[i % 4][1].split()
        if i % 13 == 2:
            text[5:5] = ["token", "=", "ab12" * 10, GOOD]
        rows.append((i, " ".join(text), "en", "s", 0))
    rows += [(200 + i, rows[3][1], "en", "s", 0) for i in range(30)] + [(300, rows[4][1] + " extra", "en", "s", 0), (301, None, "en", "s", 0), (302, "short", None, None, None)]
    rows = [(*r[:4], None if r[1] is None else len(r[1])) for r in rows]
    folder = tmp_path_factory.mktemp("tables")
    labels = [(i, 0 if i % 9 == 0 else 1, 0) for i in range(0, 150, 2)]
    for name, data, ddl in (("documents", rows, DOCS), ("benchmark", items, "item_id long, text string"), ("labels", labels, "doc_id long, quality int, toxic int")):
        spark.createDataFrame(data, ddl).write.parquet(str(folder / f"{name}.parquet"))
    return str(folder), rows, items, labels


def brute(rows, items, labels):
    scores = brute_scores([r[:3] for r in rows], {d for d, q, _ in labels if q == 1})
    rows = [r for r in rows if not base(r[1])[5] and scores[r[0]] >= quality.THRESHOLD]
    groups = brute_groups([plain_simhash(r[1]) for r in rows])
    rows = [min((r for r, g in zip(rows, groups) if g == group), key=lambda r: r[0]) for group in sorted(set(groups))]
    leaks = {d for d, *_ in brute_leaks([r[:2] for r in rows], items)}
    rows = [r for r in rows if r[0] not in leaks]
    automaton = secrets.automaton()
    return {r[0]: secrets.redact(r[1], secrets.find_secrets(r[1], automaton)) for r in rows}


def test_run_equals_brute_force(spark, tables):
    folder, rows, items, labels = tables
    want = brute(rows, items, labels)
    assert 80 < len(want) < 140 and any("[assign]" in t for t in want.values())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {}
    for piece in corpus_pipeline.run(spark, folder).orderBy("doc_id", "start").collect():
        tokens.setdefault(piece["doc_id"], bytearray()).extend(piece["ids"])
    decoded = {d: tokenizer.decode([int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids) - 4, 4)]) for d, ids in tokens.items()}
    assert decoded == want


def test_stages_keep_the_columns(spark, tables, docs, no_docs):
    folder = tables[0]
    extra = docs.withColumn("fp", F.lit(1)).withColumn("hits", F.lit(2))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for frame in (docs, extra, no_docs):
            out = stage(spark, frame, folder)
            assert out.schema.simpleString() == frame.schema.simpleString(), name
            out.collect()
    assert len(corpus_pipeline.STAGES) == 5
    assert corpus_pipeline.STAGES[-1][1](spark, no_docs, folder).count() == 0


def test_redaction_keeps_rows_and_lengths(spark, docs):
    out = corpus_pipeline.remove_secrets(spark, docs, "").collect()
    assert len(out) == docs.count() and all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in out)
