"""Language identification with a string kernel.

Two texts are as alike as the character n-grams they share: the blended-spectrum
presence kernel counts the n-grams of all lengths up to three that occur in both, over the
root of the product of how many each has. The kernel is approximated from landmark
texts (Nystroem), one-versus-rest ridge regressions are fitted in the space the landmarks
span, and texts are scored in batches: presence times landmarks, times the fitted
matrix.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliate.errors import OptionError
from foliate.llm.frames import held_out, id_and_text, joined_bytes, learning, map_texts

BITS = 14
LENGTHS = (1, 2, 3)
#: Slices a language is dealt over when its first ids are looked for.
SLICES = 64
ROWS = 256
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
#: ASCII other than letters says nothing about a language; it becomes a space.
_PLAIN = bytes(b if chr(b).isalpha() or b >= 0x80 else 0x20 for b in range(0x80)) + bytes(range(0x80, 0x100))


@dataclass(frozen=True)
class KernelParameters:
    """Bounds of the training sample and the strength of the ridge.

    At most ``per_language`` documents of each language are fitted, those with the smallest
    hash of their id, the first ``landmarks_per_language`` of them as landmarks. Every
    document is scored. Labels of more than ``max_languages`` kinds are refused.
    """

    per_language: int = 1000
    landmarks_per_language: int = 32
    ridge: float = 1e-2
    max_languages: int = 500


@dataclass(frozen=True)
class LanguageModel:
    """The languages, the landmarks' presence rows scaled by their norms, and the fitted matrix."""

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray


def presence(texts: Sequence[str | None]) -> np.ndarray:
    """For each text which n-gram buckets it has."""
    raw = [(" " + (t or "").lower() + " ").encode().translate(_PLAIN) for t in texts]
    data, starts = joined_bytes(raw)
    n = int(starts[-1])
    row = np.repeat(np.arange(len(texts), dtype=np.int64) << BITS, np.diff(starts))
    flags = np.zeros(len(texts) << BITS, bool)
    keys = np.zeros(n, np.uint64)
    for length in range(1, max(LENGTHS) + 1):
        keys |= data[length - 1 : n + length - 1].astype(np.uint64) << np.uint64(8 * length)
        buckets = (((keys | np.uint64(length)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)
        at = row + buckets
        # Windows that leave their text; each text is two spaces long at least.
        for short in range(1, length):
            ends = starts[1:] - short
            at[ends[ends >= 0]] = at[0]
        if length in LENGTHS:
            flags[at] = True
    return flags.reshape(len(texts), 1 << BITS)


def _kernel(rows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.maximum(rows.sum(axis=1), 1)).astype(np.float32)
    return (rows.astype(np.float32) @ landmarks.T) / norms[:, None]


def fit_kernel_ridge(rows: np.ndarray, languages: Sequence[str], is_landmark: np.ndarray, ridge: float) -> LanguageModel:
    """One-versus-rest ridge regression in the space of the landmarks. ``rows``: presence of the training texts."""
    names = sorted(set(languages))
    own = rows[is_landmark]
    landmarks = own.astype(np.float32) / np.sqrt(np.maximum(own.sum(axis=1), 1)).astype(np.float32)[:, None]
    k_nm = np.concatenate([_kernel(rows[a : a + ROWS], landmarks) for a in range(0, len(rows), ROWS)]).astype(np.float64)
    values, vectors = np.linalg.eigh(k_nm[is_landmark])
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    z = k_nm @ root
    y = np.where(np.array(languages)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    fitted = np.linalg.solve(z.T @ z + ridge * len(z) * np.eye(z.shape[1]) / z.shape[1], z.T @ y)
    return LanguageModel(names, landmarks, (root @ fitted).astype(np.float32))


def _packed(texts: list[str | None]) -> dict[str, Sequence]:
    return {"grams": [np.packbits(row).tobytes() for a in range(0, len(texts), ROWS) for row in presence(texts[a : a + ROWS])]}


def train_language_model(docs: DataFrame, params: KernelParameters = KernelParameters(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Fit on documents outside the held-out fold that have a language and a letter."""
    known = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang")).where(learning(F.col("doc_id")) & F.col("lang").isNotNull())
    if known.agg(F.count_distinct("lang")).first()[0] > params.max_languages:
        raise OptionError(f"more than {params.max_languages} languages are labelled")
    # The first ids of each language, first inside slices of it, so that a common language is no hot key.
    order = [F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id")]
    sliced = Window.partitionBy("lang", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES))).orderBy(*order)
    first = known.select("doc_id", "lang").distinct().withColumn("place", F.row_number().over(sliced)).where(f"place <= {params.per_language}")
    picked = first.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(f"place <= {params.per_language}")
    # At most per_language ids per language: a bounded broadcast. Of repeated ids one row with a letter is taken.
    lettered = id_and_text(docs, id_col, text_col).where(F.col("text").rlike(r"\p{L}")).join(F.broadcast(picked), "doc_id")
    sample = lettered.groupBy("doc_id", "lang", "place").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = sorted(map_texts(sample, lambda: _packed, "grams binary").toLocalIterator(), key=lambda r: (r["lang"], r["place"], bytes(r["grams"])))
    if not rows:
        return LanguageModel([], np.zeros((0, 1 << BITS), np.float32), np.zeros((0, 0), np.float32))
    grams = np.unpackbits(np.frombuffer(b"".join(bytes(r["grams"]) for r in rows), np.uint8).reshape(len(rows), -1), axis=1).astype(bool)
    langs = [r["lang"] for r in rows]
    seen: dict[str, int] = {}
    landmark = []
    for lang in langs:
        seen[lang] = seen.get(lang, 0) + 1
        landmark.append(seen[lang] <= params.landmarks_per_language)
    return fit_kernel_ridge(grams, langs, np.array(landmark), params.ridge)


def predictor(model: LanguageModel) -> Callable[[list[str | None]], dict[str, Sequence]]:
    def predict(texts: list[str | None]) -> dict[str, Sequence]:
        has_letter = np.array([bool(t and _LETTER.search(t)) for t in texts])
        if not model.languages:
            return {"lang_pred": [UNDETERMINED] * len(texts), "score": np.zeros(len(texts))}
        found = np.concatenate([_kernel(presence(texts[a : a + ROWS]), model.landmarks) @ model.weights for a in range(0, len(texts), ROWS)])
        best = found.argmax(axis=1)
        score = np.clip((found[np.arange(len(texts)), best].astype(np.float64) + 1) / 2, 0, 1)
        names = [model.languages[b] if has else UNDETERMINED for b, has in zip(best, has_letter, strict=True)]
        return {"lang_pred": names, "score": np.where(has_letter, score, 0.0)}

    return predict


def identify_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every whole text.

    Texts that are null or have no letter are ``und`` with score 0, and so is every text
    when nothing was learned. Repeated rows get the same result; between equal languages
    the first in order is taken. Only the id and the text are read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    found = map_texts(id_and_text(docs, id_col, text_col), lambda: predictor(sent.value), "lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
