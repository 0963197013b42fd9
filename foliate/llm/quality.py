"""Quality rules: zstandard compression bands over whole documents and fixed chunks.

How far a text shrinks tells two kinds of junk from prose: text that repeats itself
shrinks far more, and text without structure (encoded blobs, random characters)
hardly shrinks. How far prose shrinks depends on its length, because a short text
gives a compressor little to refer back to; so the limits depend on the length.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from foliate.llm.frames import filter_texts, id_and_text, map_texts

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Band:
    """Limits for the texts of fewer than ``below`` UTF-8 bytes: compressed size over size, both ends allowed."""

    below: float
    low: float
    high: float


#: Limits for whole documents. Below 128 bytes the frame of the format outweighs the text; there only a run of one character fails.
DOCUMENT_BANDS = (
    Band(128, 0.30, 9.0),
    Band(256, 0.36, 1.02),
    Band(512, 0.36, 0.92),
    Band(1024, 0.34, 0.84),
    Band(2048, 0.32, 0.78),
    Band(4096, 0.30, 0.74),
    Band(8192, 0.28, 0.72),
    Band(16384, 0.26, 0.70),
    Band(float("inf"), 0.22, 0.70),
)


@dataclass(frozen=True)
class CompressionRules:
    """Parameters of the verdict.

    A document fails when its own ratio leaves the band of its length, or when more
    than ``bad_chunk_share`` of its chunks leave ``chunk_low`` to ``chunk_high``. Chunks are
    ``chunk_bytes`` long; a last piece of under half that length joins the one before.
    """

    level: int = 3
    bands: tuple[Band, ...] = DOCUMENT_BANDS
    chunk_bytes: int = 2048
    chunk_low: float = 0.28
    chunk_high: float = 0.78
    bad_chunk_share: float = 0.2


def word_counts(text: bytes) -> tuple[int, int, int]:
    """Words, lines that repeat an earlier line, and words inside repeated windows of a text."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(words), len(lines) - len(set(lines)), _repeated(words)


def _repeated(words: list[bytes]) -> int:
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids: dict[tuple, int] = {}
    codes = [ids.setdefault(w, len(ids)) for w in zip(*(words[i:] for i in range(WINDOW)), strict=False)]
    if len(ids) == n:
        return 0
    at = np.asarray(codes)
    starts = np.flatnonzero(np.bincount(at)[at] > 1)
    edges = np.zeros(len(words) + 1, np.int32)
    edges[starts] += 1
    edges[starts + WINDOW] -= 1
    return int((np.cumsum(edges[:-1]) > 0).sum())


def compression_check(rules: CompressionRules) -> Callable[[bytes], tuple[float, int, int, str | None]]:
    """A function of a text: its ratio, its chunks, those out of limits, and why it fails (none: it passes)."""
    compress = zstandard.ZstdCompressor(level=rules.level).compress

    def check(raw: bytes) -> tuple[float, int, int, str | None]:
        size = len(raw)
        if not size:
            return 0.0, 0, 0, None
        ratio = len(compress(raw)) / size
        band = next(b for b in rules.bands if size < b.below)
        # A last piece of less than half a chunk belongs to the one before; a text of one chunk is its document.
        n, bad = (size + rules.chunk_bytes // 2) // rules.chunk_bytes, 0
        if n < 2:
            n = 0
        else:
            cuts = [i * rules.chunk_bytes for i in range(n)] + [size]
            of = [len(compress(raw[a:b])) / (b - a) for a, b in zip(cuts, cuts[1:], strict=False)]
            bad = sum(not rules.chunk_low <= r <= rules.chunk_high for r in of)
        why = "repetitive" if ratio < band.low else "incompressible" if ratio > band.high else "chunks" if bad > rules.bad_chunk_share * n else None
        return ratio, n, bad, why

    return check


FIELDS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, "
    "n_bytes bigint, zstd_ratio double, n_chunks bigint, n_bad_chunks bigint, compression_failure string"
)


def _scorer(rules: CompressionRules) -> Callable[[list[str | None]], dict[str, Sequence]]:
    check = compression_check(rules)
    names = [part.split()[0] for part in FIELDS.split(", ")]

    def score(texts: list[str | None]) -> dict[str, Sequence]:
        rows = []
        for text in texts:
            raw = (text or "").encode()
            n_words, dup_lines, repeated = word_counts(raw)
            word_chars = len(text or "") - (len(raw) - len(raw.translate(None, SPACE)))
            symbols = len(raw) - len(raw.translate(None, SYMBOLS))
            base_failed = n_words < 10 or 100 * repeated > 20 * n_words
            ratio, chunks, bad, why = check(raw)
            rows.append((n_words, word_chars, symbols, dup_lines, repeated, base_failed, not base_failed and why is None, len(raw), ratio, chunks, bad, why))
        return dict(zip(names, zip(*rows, strict=True), strict=True))

    return score


def quality_rules(docs: DataFrame, rules: CompressionRules = CompressionRules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its counts, its compression ratios and the verdict ``kept``.

    Every row is judged by itself and in place, without a shuffle. A null text counts
    as an empty one: no words, so it fails. Repeated rows give repeated results; an
    empty table gives none. Columns other than the id and the text are not read, so
    their names cannot clash. Very long texts are read whole; the work of a task is
    bounded by one step of texts and its longest text.
    """
    return map_texts(id_and_text(docs, id_col, text_col), lambda: _scorer(rules), FIELDS)


def keep_good(docs: DataFrame, rules: CompressionRules = CompressionRules(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns."""

    def make() -> Callable[[list[str | None]], Sequence[bool]]:
        score = _scorer(rules)
        return lambda texts: score(texts)["kept"]

    return filter_texts(docs, make, text_col)
