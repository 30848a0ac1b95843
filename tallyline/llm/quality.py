"""Quality rules that look at lines first and then at what is left of a document.

Each line is judged for itself: it fails when it does not end in punctuation or is full of
symbols, when it looks like navigation, when a boilerplate phrase makes up much of it, or when
it repeats an earlier line.
Failing lines are removed, and a document that loses more than a share of its text, or that
fails the base rules as it came, is rejected.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm import arrays


class Limits(NamedTuple):
    """Limits of the rules; shares are of a line's words or of a document's word characters."""

    least_words: int = 50
    repeated_percent: int = 50
    separator_share: float = 0.2
    symbol_share: float = 0.3
    lost_share: float = 0.5
    # A phrase counts where it makes up at least this share of the line's words.
    phrase_share: float = 0.25


SYMBOLS = b"#*$%&|<>"
# Last characters of a sentence: marks that end one in some script, quotation marks, and all
# that open or close brackets and quotations, as languages use them in both roles.
MARKS = ".!?:;\"'…。！？；：｡।॥؟۔؛։።᙮"
ENDS = MARKS + "".join(
    chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) in ("Pe", "Pf", "Pi") and chr(c) not in MARKS
)
# Words that stand between the entries of a menu.
SEPARATORS = ("|", ">", "»", "·", "•", "/", "::", "<", "›")
# Phrases of page furniture by language, with A-Z in lower case.
PHRASES = {
    "en": (
        "lorem ipsum",
        "enable javascript",
        "javascript is disabled",
        "cookie policy",
        "privacy policy",
        "terms of use",
        "terms of service",
        "all rights reserved",
        "sign in to",
        "log in to",
        "subscribe to our newsletter",
        "skip to content",
    ),
    "de": ("alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "cookies akzeptieren", "zum inhalt springen"),
    "fr": ("tous droits réservés", "mentions légales", "politique de confidentialité", "accepter les cookies", "aller au contenu"),
    "es": ("todos los derechos reservados", "aviso legal", "política de privacidad", "aceptar cookies", "saltar al contenido"),
}
BOILERPLATE = tuple(p.encode() for phrases in PHRASES.values() for p in phrases)

_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[list(SYMBOLS)] = 1
_ONE_BYTE_END = np.zeros(256, dtype=bool)
_ONE_BYTE_END[[ord(x) for x in ENDS if ord(x) < 0x80]] = True
_WIDE_ENDS = np.array([int.from_bytes(x.encode(), "big") for x in ENDS if ord(x) >= 0x80])
_SEPARATORS = [x.encode() for x in SEPARATORS]
_IN_LINE = arrays._BYTE.copy()
_IN_LINE[0x0A] = 0

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lost_chars long"


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeated(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Flags of values found twice or more in one text."""
    _, inverse, times = np.unique(
        arrays.mixed(hashes + arrays.mixed(owner.astype(np.uint64))), return_inverse=True, return_counts=True
    )
    return times[inverse] > 1


def _seen_before(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Flags of values that an earlier place of the same text holds."""
    _, first = np.unique(arrays.mixed(hashes + arrays.mixed(owner.astype(np.uint64))), return_index=True)
    flags = np.ones(len(hashes), dtype=bool)
    flags[first] = False
    return flags


class Judged(NamedTuple):
    """Counts of the texts of a piece, and its lines with words: range, text, and whether they stay."""

    counts: dict[str, np.ndarray]
    start: np.ndarray
    end: np.ndarray
    owner: np.ndarray
    stays: np.ndarray


def judge(found: arrays.Words, limits: Limits, phrases: tuple[bytes, ...] = BOILERPLATE) -> Judged:
    data, texts = found.data, len(found.edges) - 1
    n_words = np.diff(found.bounds)
    owner = np.repeat(np.arange(texts), n_words)
    hashes = arrays.word_hashes(found)
    chars = ~arrays._SPACE[data] & ((data & 0xC0) != 0x80)
    char_sums = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(chars, out=char_sums[1:])

    covered = np.zeros(len(hashes), dtype=bool)
    triples = arrays.windows(hashes, 3)
    inside = np.flatnonzero(owner[2:] == owner[:-2]) if len(hashes) > 2 else np.zeros(0, np.int64)
    twice = inside[_repeated(triples[inside], owner[inside])]
    for k in range(3):
        covered[twice + k] = True

    breaks = np.flatnonzero(data == 0x0A)
    start = np.unique(np.concatenate([found.edges[:-1], breaks + 1]))
    start = start[start < len(data)]
    end = np.append(start[1:], len(data))[: len(start)]
    end = np.where(data[end - 1] == 0x0A, end - 1, end)
    first = np.searchsorted(found.start, start)
    last = np.searchsorted(found.start, end)
    full = last > first
    start, end, first, last = start[full], end[full], first[full], last[full]
    line_owner = np.searchsorted(found.edges, start, side="right") - 1
    repeats = _seen_before(arrays.run_hashes(_zero_outside(data, start, end), start, end), line_owner)

    stays = ~repeats & _ends_well(data, found.end[last - 1])
    separators = np.zeros(len(found.start) + 1, dtype=np.int64)
    np.cumsum(_is_separator(found), out=separators[1:])
    stays &= separators[last] - separators[first] <= limits.separator_share * (last - first)
    symbols = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(_SYMBOL[data], out=symbols[1:])
    stays &= symbols[end] - symbols[start] <= limits.symbol_share * (last - first)
    lower = arrays._LOWER[data].tobytes()
    for phrase in phrases:
        size = len(phrase.split())
        at = lower.find(phrase)
        while at >= 0:
            line = int(np.searchsorted(start, at, side="right")) - 1
            if line >= 0 and at + len(phrase) <= end[line] and size >= limits.phrase_share * (last[line] - first[line]):
                stays[line] = False
            at = lower.find(phrase, at + 1)
    line_chars = char_sums[end] - char_sums[start]
    lost = np.bincount(line_owner, weights=np.where(stays, 0, line_chars), minlength=texts)
    counts = {
        "n_words": n_words,
        "word_chars": char_sums[found.edges[1:]] - char_sums[found.edges[:-1]],
        "n_symbols": _sums(_SYMBOL[data], found.edges),
        "n_dup_lines": np.bincount(line_owner[repeats], minlength=texts),
        "n_repeat_words": _sums(covered, found.bounds),
        "lost_chars": lost,
    }
    return Judged({k: v.astype(np.int64) for k, v in counts.items()}, start, end, line_owner, stays)


def _zero_outside(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Random numbers of the bytes of lines, zero elsewhere: lines without words are left out."""
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[start] += 1
    inside[end] -= 1
    return np.where(np.cumsum(inside[:-1], dtype=np.int8).astype(bool), _IN_LINE[data], np.uint64(0))


def _ends_well(data: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether the last word of a line ends in punctuation."""
    last = data[end - 1] if len(end) else np.zeros(0, np.uint8)
    flags = _ONE_BYTE_END[last]
    # of the other characters the last four bytes, of which those before the character's do not count
    wide = np.flatnonzero(last >= 0x80)
    code = np.zeros(len(wide), dtype=np.int64)
    begun = np.zeros(len(wide), dtype=bool)
    for k in range(4):
        at = end[wide] - 1 - k
        byte = np.where(at >= 0, data[np.maximum(at, 0)], 0).astype(np.int64)
        code |= np.where(begun, 0, byte << (8 * k))
        begun |= (byte & 0xC0) != 0x80
    flags[wide] = np.isin(code, _WIDE_ENDS)
    return flags


def _is_separator(found: arrays.Words) -> np.ndarray:
    flags = np.zeros(len(found.start), dtype=bool)
    length = found.end - found.start
    for word in _SEPARATORS:
        hit = length == len(word)
        at = found.start[hit]
        same = np.ones(len(at), dtype=bool)
        for k, byte in enumerate(word):
            same &= found.data[at + k] == byte
        flags[np.flatnonzero(hit)[same]] = True
    return flags


def _kept_text(data: np.ndarray, judged: Judged, k: int) -> str:
    lines = np.flatnonzero((judged.owner == k) & judged.stays)
    return b"\n".join(
        data[a:b].tobytes() for a, b in zip(judged.start[lines], judged.end[lines], strict=True)
    ).decode("utf-8", errors="replace")


def _rated(at: int, limits: Limits, phrases: tuple[bytes, ...], with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in arrays.words(batch.column(at)):
                judged = judge(found, limits, phrases)
                rows = batch.slice(found.first, len(found.edges) - 1)
                columns = [*rows.columns, *(pa.array(x) for x in judged.counts.values())]
                if with_text:
                    losing = np.unique(judged.owner[~judged.stays])
                    texts = rows.column(at).to_pylist()
                    for k in losing.tolist():
                        texts[k] = _kept_text(found.data, judged, k)
                    columns.append(pa.array(texts, pa.string()))
                names = [*rows.schema.names, *judged.counts] + ["kept_text"] * with_text
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_chars")


def rate(
    docs: DataFrame, limits: Limits = Limits(), with_text: bool = False, phrases: tuple[bytes, ...] = BOILERPLATE
) -> DataFrame:
    """``docs`` with the counts of ``COUNTS``, base_failed, kept and, if asked for, kept_text.

    ``phrases`` are those of page furniture, as UTF-8 with A-Z in lower case; one fails a line only where
    it makes up a share of it, so that a sentence may mention it.

    Earlier columns of these names are replaced; others stay. ``lost_chars`` are the word
    characters of lines that fail, ``kept_text`` is the text without them (as it came when
    no line fails). A document is kept when it passes the base rules and loses at most
    ``lost_share`` of its word characters. A null or empty text has no words: all counts are
    0, base_failed is true and kept false. Each row is judged alone, so repeated rows and
    null keys need no rule; an empty table gives an empty result.
    """
    docs = docs.drop(*ADDED, "base_failed", "kept", "kept_text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    schema = f"{fields}, {COUNTS}" + ", kept_text string" * with_text
    rated = docs.mapInArrow(_rated(docs.columns.index("text"), limits, phrases, with_text), schema)
    failed = (F.col("n_words") < limits.least_words) | (
        100 * F.col("n_repeat_words") > limits.repeated_percent * F.col("n_words")
    )
    return rated.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (F.col("lost_chars") <= limits.lost_share * F.col("word_chars"))
    )
