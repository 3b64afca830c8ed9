"""Secret scan: keyword automaton, anchored patterns near its hits, embedded checksums.

An Aho-Corasick automaton over the lower-cased (A-Z) text finds the few places where a
secret can start; each kind's pattern is then matched there only. A run of hexadecimal
digits has no keyword: a long enough run covers two neighbouring positions of every
``HEX_STRIDE``-th one, so runs are looked for around such pairs. Platform tokens carry a
checksum and count only if it is right.
"""

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patterns and least lengths of the base kinds, prefixes of checksummed tokens.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]
ASSIGN_VALUE = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 16
HEX_RUN = re.compile(r"[0-9a-f]+")
HEX_LENGTH = 32
CHECKED = re.compile(r"(ghp_|gho_|ghu_|ghs_|ghr_|npm_)([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
CHECKED_WORDS = ["ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"]

KINDS = ["assign", "access", "hex", "github", "npm"]
BASE_KINDS = KINDS[:3]

HEX_STRIDE = HEX_LENGTH // 2
_HEX_PAIR = re.compile(r"[0-9a-f]{2,}")
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

Span = tuple[int, int, str]


def checksum62(body: str) -> str:
    """CRC-32 of a token's body as six base-62 digits, the form platform tokens end with."""
    number, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        number, digit = divmod(number, 62)
        digits = _BASE62[digit] + digits
    return digits


def automaton() -> ahocorasick.Automaton:
    words = ahocorasick.Automaton()
    for kind, keywords in (("assign", ASSIGN_WORDS), ("access", ["akia"]), ("checked", CHECKED_WORDS)):
        for word in keywords:
            words.add_word(word, (kind, len(word)))
    words.make_automaton()
    return words


def _hex_runs(text: str) -> Iterator[Span]:
    done = 0
    for stretch in _HEX_PAIR.finditer(text[::HEX_STRIDE]):
        # Any two neighbours of the stretch may belong to a run; looking from the first will do.
        for place in range(stretch.start(), stretch.end() - 1):
            inside = place * HEX_STRIDE
            if inside < done:
                continue
            start = inside
            while start > done and text[start - 1] in "0123456789abcdef":
                start -= 1
            done = HEX_RUN.match(text, start).end()
            if done - start >= HEX_LENGTH:
                yield start, done, "hex"


def find_secrets(text: str | None, words: ahocorasick.Automaton) -> list[Span]:
    """All spans ``(start, end, kind)`` in code points, ordered by start, then as in ``KINDS``.

    Per kind they are the leftmost non-overlapping matches; a match that fails its length
    still uses up its characters, as a plain scan with the pattern would have it.
    """
    if not text:
        return []
    spans = list(_hex_runs(text))
    # Lower-casing bytes changes A-Z only, so positions stay those of the text.
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    hits = sorted({(last + 1 - length, kind) for last, (kind, length) in words.iter(lowered)})
    free = {"assign": 0, "access": 0, "checked": 0}
    for start, kind in hits:
        if start < free[kind]:
            continue
        match = {"assign": ASSIGN, "access": ACCESS, "checked": CHECKED}[kind].match(text, start)
        if match is None:
            continue
        free[kind] = match.end()
        if kind == "assign":
            good = len(match[2]) >= ASSIGN_VALUE
        elif kind == "access":
            good = len(match[0]) >= ACCESS_LENGTH
        else:
            good = checksum62(match[2]) == match[3]
            kind = "npm" if match[1] == "npm_" else "github"
        if good:
            spans.append((start, match.end(), kind))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with every stretch of secrets replaced by ``[kind]`` of its first span."""
    if not spans:
        return text
    parts, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind}]"]
        elif end <= at:
            continue
        at = max(at, end)
    return "".join([*parts, text[at:]])


_SPAN_TYPE = T.ArrayType(T.StructType().add("start", T.LongType()).add("end", T.LongType()).add("kind", T.StringType()))
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


@F.arrow_udf(_SPAN_TYPE)
def _spans(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    words = automaton()
    for array in texts:
        found = (find_secrets(t.as_py(), words) for t in array)
        yield pa.array([[dict(zip(("start", "end", "kind"), s, strict=True)) for s in spans] for spans in found], _SPANS)


@F.arrow_udf(T.StringType())
def _redacted(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    words = automaton()
    for array in texts:
        values = (t.as_py() for t in array)
        yield pa.array([redact(v, find_secrets(v, words)) for v in values], pa.string())


def secret_spans(text: Column | str) -> Column:
    """Spans of all secrets of a text, an array of ``start, end, kind``; empty for null."""
    # The array is read more than once; a UDF is not repeated for that if it is not deterministic.
    return _spans.asNondeterministic()(text)


def redacted(text: Column | str) -> Column:
    """The text without its secrets; a null text stays null, a clean one as it is."""
    return _redacted(text)


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, spans`` for every row of ``docs(doc_id, text)``; null and empty texts have none."""
    return docs.select("doc_id", secret_spans("text").alias("spans"))
