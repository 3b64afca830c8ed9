"""Text statistics and an importance score: log-likelihood ratio of hashed n-grams.

Two multinomials are counted over hashed n-grams: words, and three bytes in a row. (Pairs of words
would tell groups of near copies apart from other prose, not good text from bad.) One is of
the raw corpus, all documents; one of the trusted documents. A text counts once, however many
copies of it there are, and says nothing about itself: its own counts are taken out of
both first. N-grams are hashed together with the document's language, and trusted
shares are compared with that of the language, so that a language which few labels cover is
not held against its documents. The score is the mean log ratio of a document's n-grams; longer
texts gain nothing by their length. One threshold decides for all.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import Vocabulary, materialized, rows_of, shuffles_cleared, utf8

#: Hash buckets of the multinomials' n-grams, and of the languages' sums behind them.
BUCKETS, LANGUAGE_BUCKETS = 1 << 16, 1 << 12
#: Counts by which a bucket's ratio is shrunk towards that of the language.
SMOOTHING = 2.0
#: Documents whose mean log ratio is lower go.
THRESHOLD = -0.35
#: Trusted ids, and texts that are trusted or have copies, are broadcast up to this many, and joined by a shuffle beyond.
BROADCAST_IDS = 2_000_000

MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
WHITE_SPACE = b" \t\n\r\x0b\x0c"

_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def repeated_words(numbers: np.ndarray) -> int:
    """Words inside three-word windows that the text holds twice or more."""
    n = len(numbers)
    if n < 4:
        return 0
    windows = numbers[:-1]
    for following in (numbers[1:], numbers[2:]):
        # Dense numbers keep the combined key below 2 ** 63 for texts of any length.
        _, dense = np.unique(windows[: len(following)], return_inverse=True)
        windows = dense * (int(numbers.max()) + 1) + following
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : shift + n - 2] |= twice
    return int(covered.sum())


def duplicate_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in data.split(b"\n") if line.strip(WHITE_SPACE)]
    return len(lines) - len(set(lines))


def language_number(language: str | None) -> int:
    return 0 if language is None else xxhash.xxh64_intdigest(utf8(language))


def ngram_buckets(words: list[bytes], hashes: np.ndarray, language: int, buckets: int) -> np.ndarray:
    """Bucket of every word and of every three bytes of a text; its words joined by a space, one at each end."""
    data = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint64)
    bytes_ = data[:-2] << np.uint64(16) | data[1:-1] << np.uint64(8) | data[2:] | np.uint64(1 << 24)
    grams = np.concatenate([hashes, bytes_ * _RIGHT]) ^ np.uint64(language)
    grams = (grams ^ (grams >> np.uint64(31))) * _LEFT
    return (grams >> np.uint64(32)).astype(np.int64) % buckets


@dataclass(frozen=True)
class RatioModel:
    """N-gram counts of all texts (``corpus``) and of the trusted among them, per bucket, and behind them per language.

    A bucket's ratio compares its trusted share with that of the language, shrunk towards it by
    ``smoothing`` counts. A text's own n-grams are taken out first, so that words which only
    it has say nothing about it, in small corpora as in large.
    """

    corpus: np.ndarray
    trusted: np.ndarray
    smoothing: float

    @property
    def buckets(self) -> int:
        return len(self.corpus) - LANGUAGE_BUCKETS

    def score(self, words: list[bytes], hashes: np.ndarray, language: int, praised: bool) -> float:
        """``praised``: the text is among the trusted. Zero where the language has no other trusted text."""
        if not words:
            return 0.0
        used, own = np.unique(ngram_buckets(words, hashes, language, self.buckets), return_counts=True)
        total, whole = own.sum(), self.buckets + language % LANGUAGE_BUCKETS
        all_trusted, all_others = self.trusted[whole] - total * praised, self.corpus[whole] - total
        if all_trusted <= 0 or all_others <= 0:
            return 0.0
        share = all_trusted / all_others
        others = np.maximum(self.corpus[used] - own, 0)
        trusted = np.maximum(self.trusted[used] - own * praised, 0)
        ratio = (trusted + self.smoothing * share) / (others + self.smoothing) / share
        return float(np.log(ratio) @ own / total)


def _count(buckets: int):
    size = buckets + LANGUAGE_BUCKETS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, totals = Vocabulary(), np.zeros((2, size))
        held, weights, praise, waiting = [], [], [], 0

        def add():
            nonlocal waiting
            if held:
                lengths = list(map(len, held))
                grams, weight = np.concatenate(held), np.repeat(weights, lengths)
                totals[0] += np.bincount(grams, weight, size)
                totals[1] += np.bincount(grams, weight * np.repeat(praise, lengths), size)
            held.clear(), weights.clear(), praise.clear()
            waiting = 0

        for batch in batches:
            for text, lang, trusted, copies in rows_of(batch, ["text", "lang", "trusted", "copies"]):
                words, language = utf8(text).split(), language_number(lang)
                if words:
                    grams = ngram_buckets(words, vocabulary.hashes(vocabulary.numbers(words)), language, buckets)
                    held.append(np.append(grams, np.full(len(grams), buckets + language % LANGUAGE_BUCKETS)))
                    weights.append(1.0 / copies)
                    praise.append(trusted)
                    waiting += len(grams)
                    if waiting > 500_000:
                        add()
        add()
        used = np.flatnonzero(totals[0])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (used, totals[0][used], totals[1][used])], names=["bucket", "corpus", "trusted"])

    return count


def _small(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids


def text_marks(docs: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    """``hash, copies, trusted`` of the texts that are trusted or have copies: slim rows, no text is shuffled."""
    ids = trusted_ids.select(F.col("doc_id").alias("trusted_id")).where("trusted_id is not null").distinct()
    ids = _small(materialized(ids, "trusted-ids"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("hash")).join(ids, F.col("doc_id") == F.col("trusted_id"), "left")
    # Rows combine before their shuffle, whatever the number of copies.
    texts = rows.groupBy("hash").agg(F.count("*").alias("copies"), F.max(F.col("trusted_id").isNotNull()).alias("trusted"))
    return materialized(texts.where("copies > 1 or trusted"), "text-marks")


def _marked(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """``rows`` with ``copies`` and ``trusted`` of the text whose hash is ``text_hash``."""
    joined = rows.join(marks, F.col("text_hash") == F.col("hash"), "left")
    return joined.withColumns({"copies": F.coalesce("copies", F.lit(1).cast("long")), "trusted": F.coalesce("trusted", F.lit(False))})


def fit(docs: DataFrame, marks: DataFrame, language: Column, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> RatioModel:
    """Counts both multinomials over all rows of ``docs(text)``, a row weighing one by its text's copies.

    Each task combines its counts, so a task sends at most one row per bucket, and the
    driver gets one row per bucket. Without trusted text all scores are zero.
    """
    rows = _marked(docs.select("text", language.alias("lang"), F.xxhash64("text").alias("text_hash")), marks)
    counts = rows.select("text", "lang", "trusted", "copies").mapInArrow(_count(buckets), "bucket long, corpus double, trusted double")
    with shuffles_cleared(docs.sparkSession):
        rows = counts.groupBy("bucket").agg(F.sum("corpus").alias("corpus"), F.sum("trusted").alias("trusted")).collect()
    totals = np.zeros((2, buckets + LANGUAGE_BUCKETS))
    for bucket, corpus, trusted in rows:
        totals[:, bucket] = corpus, trusted
    # Whole numbers but for rounding, whatever the order of the sums.
    return RatioModel(*np.rint(totals), smoothing)


STATISTICS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, score double, kept boolean"
)


def _assess(model, threshold: float):
    fields = [f.split() for f in STATISTICS.split(", ")]
    types = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}

    def assess(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        vocabulary, ratio = Vocabulary(), model.value
        for texts, languages, praised in columns:
            rows = []
            for scalar, lang, own in zip(texts, languages.to_pylist(), praised.to_pylist(), strict=True):
                text = scalar.as_py() or ""
                data = utf8(text)
                words = data.split()
                numbers = vocabulary.numbers(words)
                n, repeats = len(numbers), repeated_words(numbers)
                spaces = len(data) - len(data.translate(None, WHITE_SPACE))
                symbols = len(data) - len(data.translate(None, SYMBOLS))
                failed = n < MIN_WORDS or 100 * repeats > 50 * n
                score = ratio.score(words, vocabulary.hashes(numbers), language_number(lang), own)
                rows.append((n, len(text) - spaces, symbols, duplicate_lines(data), repeats, failed, score, not failed and score >= threshold))
            columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
            arrays = [pa.array(list(c), types[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
            yield pa.StructArray.from_arrays(arrays, names=[name for name, _ in fields])

    return F.arrow_udf(assess, f"struct<{STATISTICS.replace(' ', ':').replace(',:', ',')}>")


def assess(docs: DataFrame, trusted_ids: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` as struct ``row`` with struct ``quality`` beside it, for every row.

    Words are runs of anything but the six ASCII white-space characters. ``base_failed``:
    under 50 words, or over half of them in repeated three-word windows. ``kept``: not
    base_failed, and the score is at least ``threshold``. Null texts have no words and fail.

    ``trusted_ids(doc_id)`` names the target documents; all rows with the text of one are trusted.
    Languages are those of the column ``lang``, null being one; without the column all is one
    language. Documents of a language without other trusted text score zero.
    """
    language = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    marks = _small(text_marks(docs, trusted_ids))
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, marks, language, buckets))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    # Only the row itself goes through the join, not its text once more beside it.
    rows = _marked(docs.select(row, F.xxhash64("text").alias("text_hash")), marks)
    language = F.col("row.lang").cast("string") if "lang" in docs.columns else language
    # The struct is read more than once; a UDF is not repeated for that if it is not deterministic.
    return rows.select("row", _assess(model, threshold).asNondeterministic()("row.text", language, "trusted").alias("quality"))


def trusted(labels: DataFrame) -> DataFrame:
    """Ids of documents labelled good; null labels are no praise. Toxicity is not judged here."""
    return labels.where("quality = 1").select("doc_id")
