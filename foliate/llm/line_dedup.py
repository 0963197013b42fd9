"""Line dedup: a suffix array over line ids, built by distributed prefix doubling.

Texts are sequences of line ids. Round k of the doubling ranks every suffix by its
first 2^k lines: the rank of 2h lines is made of the rank of the first h and the rank
of the next h. Suffixes of equal rank form an interval of the suffix array whose
longest common prefix is 2^k lines or more. A rank is named by the first place, in
document order, of its interval; the name says at once where the earliest copy stands,
and no rank needs a sort of all suffixes, nor one task that sees all suffixes with a
common first line. Suffixes alone in their interval can't repeat and leave the array,
so each round handles only what still repeats.

Two intervals of dyadic depth name a run of any length: the run of q lines at s is the
pair of ranks of depth 2^k at s and at s + q - 2^k, with 2^k <= q < 2^(k+1). A repeated
run counts when it has ``min_words`` words or more. Whether a maximal repeated run
does, and which lines it spans, follows from the shortest counting runs: those that
start at each line and those that end at each line. A line of a maximal run either
starts a counting run inside it, or, near its end, lies in the one that ends with it.
So the array has to be refined only to the depth of the longest of these.

Lines without a word are not in the sequences; they stay where they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliate.llm.frames import map_texts, slices
from foliate.session import materialize


@dataclass(frozen=True)
class LineRules:
    """A repeated run counts from ``min_words`` words up, in however many lines."""

    min_words: int = 20


def _lines(texts: list[str | None]) -> dict[str, Sequence]:
    """Per text the 128-bit id and the words of each line that has a word."""
    digest = xxhash.xxh3_128_digest
    found = [[line for line in (text or "").encode().split(b"\n") if line.strip()] for text in texts]
    return {"line": [list(map(digest, lines)) for lines in found], "words": [[len(line.split()) for line in lines] for lines in found]}


def _shortest_runs(words: Sequence[int], least: int) -> list[tuple[int, int]]:
    """Start and lines of the shortest counting runs of a stretch: one for each start, one for each end."""
    total = np.concatenate([[0], np.cumsum(words)])
    n = len(words)
    starts = np.arange(n)
    stops = np.searchsorted(total, total[:-1] + least)
    forward = set(zip(starts[stops <= n].tolist(), (stops - starts)[stops <= n].tolist(), strict=True))
    ends = np.arange(1, n + 1)
    begins = np.searchsorted(total, total[1:] - least, side="right") - 1
    backward = set(zip(begins[begins >= 0].tolist(), (ends - begins)[begins >= 0].tolist(), strict=True))
    return sorted(forward | backward)


def _place_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per line of each document, and one behind its last line that ends it; rows come sorted by key."""
    before = None
    for batch in batches:
        rows: dict[str, list] = {"s": [], "line": [], "words": []}
        ends: list[int | None] = []
        for i, (key, ids, words) in enumerate(zip(batch["key"].to_pylist(), batch["line"].to_pylist(), batch["words"].to_pylist(), strict=True)):
            if key == before:
                continue
            before = key
            rows["s"] += range(len(ids) + 1)
            rows["line"] += [*ids, None]
            rows["words"] += [*words, 0]
            ends += [None] * len(ids) + [i]
        at = pa.array(ends, pa.int64())
        # Only the row that ends a document carries its key.
        yield pa.RecordBatch.from_arrays(
            [batch["key"].take(at), pa.array(rows["s"], pa.int64()), pa.array(rows["line"], pa.binary()), pa.array(rows["words"], pa.int32())],
            names=["key", "s", "line", "words"],
        )


def _runs_task(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over one document's repeated lines and ranks: its shortest counting runs, none across a line that doesn't repeat, each with the two ranks that name it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {"base": [], "p": [], "q": [], "head": [], "tail": []}
            for base, of in zip(batch["base"].to_pylist(), batch["of"].to_pylist(), strict=True):
                ranks = {(x["k"], x["p"]): x["rank"] for x in of if x["k"] >= 0}
                lines = sorted((x["p"], x["rank"]) for x in of if x["k"] < 0)
                places, words = (list(x) for x in zip(*lines, strict=True))
                cuts = [0, *(np.flatnonzero(np.diff(places) != 1) + 1).tolist(), len(places)]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    for start, q in _shortest_runs(words[a:b], least) if sum(words[a:b]) >= least else ():
                        k, at = q.bit_length() - 1, places[a + start]
                        head, tail = ranks.get((k, at)), ranks.get((k, at + q - (1 << k)))
                        if head is not None and tail is not None:
                            for name, value in zip(rows, (base, at, q, head, tail), strict=True):
                                rows[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in rows.values()], names=list(rows))

    return run


def _intervals(rows: DataFrame, *key: str) -> DataFrame:
    """The intervals of equal ``key`` with two places or more: the key and the first place as ``name``. Counted before the shuffle."""
    return rows.groupBy(*key).agg(F.min("p").alias("name"), F.count("*").alias("n")).where("n > 1").drop("n")


def suffix_ranks(level: DataFrame, depth: int) -> list[DataFrame]:
    """``(base, p, rank)`` of depth 1, 2, 4, ... up to ``depth`` lines, for the suffixes whose interval has company.

    ``level``: those of depth 1; ``p`` counts without a gap inside a document, ``base`` is the
    document's first place. Each round is written to the checkpoint folder.
    """
    levels, h = [level], 1
    while 2 * h <= depth and not level.isEmpty():
        # The rank h lines further on in the same document, if that suffix still has company.
        further = F.first("rank").over(Window.partitionBy("base").orderBy("p").rangeBetween(h, h))
        pairs = level.withColumn("next", further).where("next is not null")
        level = materialize(pairs.join(_intervals(pairs, "rank", "next"), ["rank", "next"]).select("base", "p", F.col("name").alias("rank")))
        levels.append(level)
        h *= 2
    return levels


def repeated_lines(lines: DataFrame, rules: LineRules) -> DataFrame:
    """``(base, p)``: the places of the lines to delete, some more than once. ``lines``: ``(base, p, line, words)``, ``base`` being a document's first place."""
    repeated = materialize(lines.join(_intervals(lines, "line"), "line").select("base", "p", F.col("name").alias("rank"), "words"))
    # A line has one word at least, so a shortest counting run has no more lines than the least number of words.
    levels = suffix_ranks(repeated.select("base", "p", "rank"), max(1, rules.min_words))
    entries = repeated.select("base", F.lit(-1).alias("k"), "p", F.col("words").cast("bigint").alias("rank"))
    for k, level in enumerate(levels):
        entries = entries.unionAll(level.select("base", F.lit(k).alias("k"), "p", "rank"))
    # What a document gathers is a few numbers per line of its own.
    gathered = entries.groupBy("base").agg(F.collect_list(F.struct("k", "p", "rank")).alias("of"))
    runs = materialize(gathered.mapInArrow(_runs_task(rules.min_words), "base bigint, p bigint, q bigint, head bigint, tail bigint"))
    later = runs.join(_intervals(runs, "q", "head", "tail"), ["q", "head", "tail"]).where("name != p")
    return later.select("base", F.explode(F.expr("sequence(p, p + q - 1)")).alias("p"))


def _cut(text: str | None, drop: list[int] | None) -> tuple[str | None, int, int]:
    """The text without the dropped lines, how many lines with a word it had, and how many were dropped."""
    if text is None:
        return None, 0, 0
    gone, kept, s = set(drop or ()), [], -1
    for line in text.split("\n"):
        # Words are split at ASCII spaces only, as when the lines were numbered.
        word = bool(line.strip(" \t\n\x0b\x0c\r"))
        s += word
        if not (word and s in gone):
            kept.append(line)
    return "\n".join(kept), s + 1, len(gone)


def _rewritten(joined: DataFrame, text_col: str, drop: str, counts: tuple[str, str] | None) -> DataFrame:
    keep = [f for f in joined.schema if f.name != drop]
    added = [T.StructField(c, T.LongType()) for c in counts or ()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, 8 << 20):
                cut = [_cut(t, d) for t, d in zip(part[text_col].to_pylist(), part[drop].to_pylist(), strict=True)]
                texts, lines, removed = zip(*cut, strict=True)
                own = [pa.array(texts, part.schema.field(text_col).type) if f.name == text_col else part[f.name] for f in keep]
                more = [pa.array(lines, pa.int64()), pa.array(removed, pa.int64())] if counts else []
                yield pa.RecordBatch.from_arrays([*own, *more], names=[*(f.name for f in keep), *(counts or ())])

    return joined.mapInArrow(run, T.StructType([*keep, *added]))


def _document_key(id_col: str, text_col: str) -> Column:
    """Orders documents by id, those without one last, then by a hash of the text."""
    return F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row"))


def dedup_lines(
    docs: DataFrame, rules: LineRules = LineRules(), id_col: str = "doc_id", text_col: str = "text", counts: tuple[str, str] | None = None, drop_emptied: bool = False
) -> DataFrame:
    """The rows of ``docs`` with all columns; later copies of repeated line runs are deleted from the text.

    ``counts`` names two columns to add: lines that have a word, and how many of them were
    deleted. ``drop_emptied`` leaves out rows of whose lines none is left; rows that had
    none stay.

    The first copy is the one with the smallest id (rows without an id come last), then the
    smaller hash of the text, then the earlier line. Rows that agree in id and text are one
    document and get the same result. Null, empty and wordless texts stay as they are.
    Lines are told apart by a 128-bit hash of their bytes. A run may overlap its own copy.
    Only the id and the text are read; other columns pass through.
    """
    keyed = docs.select(_document_key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    parsed = materialize(map_texts(keyed, lambda: _lines, "line array<binary>, words array<int>"))
    # Whole documents in order of their keys, so that the row numbers of their lines follow that order.
    ordered = parsed.repartitionByRange("key").sortWithinPartitions("key")
    key_type = parsed.schema["key"].dataType
    schema = T.StructType([T.StructField("key", key_type)]).add("s", T.LongType()).add("line", T.BinaryType()).add("words", T.IntegerType())
    placed = ordered.mapInArrow(_place_task, schema).withColumn("p", F.monotonically_increasing_id())
    placed = materialize(placed.withColumn("base", F.col("p") - F.col("s")))
    gone = repeated_lines(placed.where("line is not null").select("base", "p", "line", "words"), rules)
    drops = gone.groupBy("base").agg(F.sort_array(F.collect_set((F.col("p") - F.col("base")).cast("int"))).alias("drop"))
    of_key = placed.where("line is null").select("key", "base", F.col("s").alias("n")).join(drops, "base")
    if drop_emptied:
        of_key = of_key.withColumn("drop", F.when(F.size("drop") < F.col("n"), F.col("drop")).otherwise(F.array()))
    of_key = of_key.select(F.col("key.id").alias("_key_id"), F.col("key.row").alias("_key_row"), F.col("drop").alias("_drop"))
    same = (F.xxhash64(docs[text_col]) == of_key["_key_row"]) & docs[id_col].eqNullSafe(of_key["_key_id"])
    joined = docs.join(of_key, same, "left").drop("_key_id", "_key_row")
    if drop_emptied:
        # An empty list says that nothing is left; no list, that nothing is deleted.
        joined = joined.where("_drop is null or size(_drop) > 0")
    return _rewritten(joined, text_col, "_drop", counts)
