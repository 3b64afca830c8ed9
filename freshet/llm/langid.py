"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import rows_of

#: Hash buckets of the n-grams, n-gram lengths, and counts added to every bucket.
BUCKETS = 1 << 14
LENGTHS = (1, 2, 3)
SMOOTHING = 0.5
UNKNOWN = "und"

#: Characters hashed at once; longer texts go in overlapping stretches.
_STRETCH = 1 << 18
_MIX = np.uint64(0x9E3779B97F4A7C15)


def ngram_buckets(text: str, buckets: int) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of the whole lower-cased text, stretch by stretch."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    for start in range(0, len(points), _STRETCH):
        codes = points[start : start + _STRETCH + max(LENGTHS) - 1].astype(np.uint64)
        own = min(_STRETCH, len(points) - start)
        parts, key = [], np.zeros(len(codes), np.uint64)
        for length in range(1, max(LENGTHS) + 1):
            width = len(codes) - length + 1
            if width <= 0:
                break
            key = (key[:width] + codes[length - 1 :]) * _MIX
            key ^= key >> np.uint64(32)
            if length in LENGTHS:
                parts.append(key[:own])
        yield (np.concatenate(parts) % np.uint64(buckets)).astype(np.int64)


@dataclass(frozen=True)
class LanguageModel:
    """``log_probability[bucket, language]`` and the languages' log priors."""

    languages: list[str]
    log_probability: np.ndarray
    log_prior: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Most probable language of each text, and its probability by the evidence of one character.

        The texts are rows of a sparse matrix of n-gram counts, whose entries are ones, repeated as
        the n-grams are; its product with the model is taken in stretches. The sum of log
        probabilities decides; divided by the characters it gives the score, as the sum itself
        would make any but the shortest texts certain.
        """
        known = [bool(t) and bool(self.languages) and any(map(str.isalpha, t)) for t in texts]
        total = np.tile(self.log_prior, (len(texts), 1))
        held, rows, waiting = [], [], 0

        def multiply():
            nonlocal waiting
            if held:
                starts = np.cumsum([0, *map(len, held[:-1])])
                products = np.add.reduceat(self.log_probability.take(np.concatenate(held), axis=0), starts, axis=0, dtype=np.float64)
                np.add.at(total, rows, products)
            held.clear(), rows.clear()
            waiting = 0

        for row, text in enumerate(texts):
            for indices in ngram_buckets(text, len(self.log_probability)) if known[row] else ():
                held.append(indices)
                rows.append(row)
                waiting += len(indices)
                if waiting > _STRETCH:
                    multiply()
        multiply()
        languages, scores = [], []
        for row, text in enumerate(texts):
            if not known[row]:
                languages.append(UNKNOWN)
                scores.append(0.0)
                continue
            best = int(total[row].argmax())
            languages.append(self.languages[best])
            scores.append(float(1 / np.exp((total[row] - total[row][best]) / len(text)).sum()))
        return languages, scores


def _count(buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in rows_of(batch, ["text", "lang"]):
                total = totals.setdefault(lang, np.zeros(buckets + 1, np.int64))
                total[buckets] += 1
                for indices in ngram_buckets(text, buckets):
                    total[:buckets] += np.bincount(indices, minlength=buckets)
        for lang, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(total[used])], names=["lang", "bucket", "n"])

    return count


def fit(labelled: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> LanguageModel:
    """Counts all n-grams of all rows of ``labelled(text, lang)``; null texts or langs are left out.

    A task sends one row per language and bucket, the driver gets as many; the model
    grows with the number of languages only.
    """
    rows = labelled.select("text", "lang").where("text is not null and lang is not null")
    counts = rows.mapInArrow(_count(buckets), "lang string, bucket long, n long")
    collected = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(collected["lang"].unique())
    totals = np.zeros((buckets + 1, len(languages)))
    places = {lang: i for i, lang in enumerate(languages)}
    totals[collected["bucket"].to_numpy(np.int64), collected["lang"].map(places).to_numpy(np.int64)] = collected["n"]
    grams, docs = totals[:-1] + smoothing, totals[-1]
    with np.errstate(divide="ignore"):
        prior = np.log(docs / max(1, docs.sum()))
    return LanguageModel(languages, np.log(grams / grams.sum(axis=0)).astype(np.float32), prior)


def predict(spark, model: LanguageModel, text: Column | str) -> Column:
    """Struct ``lang, score``; ``und`` and 0 for null texts and texts without a letter."""
    shared = spark.sparkContext.broadcast(model)

    def predict_all(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in texts:
            parts = [shared.value.predict(array.slice(i, 500).to_pylist()) for i in range(0, len(array), 500)]
            found = [pa.array([x for part in parts for x in part[at]], kind) for at, kind in ((0, pa.string()), (1, pa.float64()))]
            yield pa.StructArray.from_arrays(found, names=["lang", "score"])

    # The struct is read twice; a UDF is not repeated for that if it is not deterministic.
    return F.arrow_udf(predict_all, "struct<lang:string,score:double>").asNondeterministic()(text)


def held_out(doc_id: Column | str, parts: int = 4, part: int = 2) -> Column:
    """True for the documents kept from learning: CRC-32 of the id as text, modulo ``parts``; null ids are not."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs(doc_id, text, lang)``.

    Learns from the rows that are not held out and have a lang; predicts from the text alone.
    Null, empty and letterless texts are ``und`` with score 0, and so are all where nothing
    could be learned. Ties go to the language that sorts first. Null doc_ids are not held out;
    repeated rows count and are predicted each for itself. An empty table gives an empty result.
    """
    model = fit(docs.where(~held_out("doc_id")))
    rows = docs.select("doc_id", held_out("doc_id").alias("held_out"), predict(docs.sparkSession, model, "text").alias("found"))
    return rows.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")
