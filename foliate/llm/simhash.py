"""SimHash near-duplicates by anchor-point covering.

Fingerprints have 64 bits and link at 4 differing bits or fewer. They are compared
only where they meet, and they meet at anchors: the words of a covering code.

The bits are dealt into three parts. Four differences cannot be one or more in the
first part, two or more in the second and two or more in the third, for that would
be five; so two linked fingerprints agree on the first part, or differ in at most
one bit of the second or of the third. The first part (16 bits) is its own anchor.
In the other two (24 bits each) the anchors are the words of the perfect [15, 11]
Hamming code on 15 bits times all values of the other 9. Its covering radius is 1:
each value has a home anchor at distance 1 or less. A fingerprint goes to every
anchor within covering radius plus threshold, 2, that a value at distance 1 can have
as its home. If y differs from x in one bit of a part, y is therefore at the home of x.

This takes some 34 places per distinct fingerprint, and a part of 24 bits spreads
them over 2^20 anchors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliate.errors import OptionError
from foliate.llm.frames import id_and_text, map_texts
from foliate.llm.graph import components
from foliate.session import materialize

SHINGLE = 4
SEED = 42
THRESHOLD = 4
#: Groups of up to this many fingerprints are compared by shifted rows, all groups of a step at once; larger ones by pivots.
SHIFTED = 256
STEP_ROWS = 200_000


def fingerprints(texts: list[str | None]) -> np.ndarray:
    """The 64-bit SimHash of each text over its word shingles."""
    hashes: list[int] = []
    sizes = np.zeros(len(texts), np.int64)
    digest = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        # Bytes methods change and split at ASCII letters and spaces only, as asked for.
        words = (text or "").encode().lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        if len(words) <= SHINGLE:
            hashes.append(digest(joined, SEED))
            sizes[i] = 1
            continue
        starts = (ends - [len(w) + 1 for w in words])[: len(words) - SHINGLE + 1].tolist()
        stops = (ends[SHINGLE - 1 :] - 1).tolist()
        hashes += [digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)]
        sizes[i] = len(starts)
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        first = np.cumsum(sizes[full]) - sizes[full]
        # Bytes of the most significant bit first, so that bit j of the row is bit 63 - j of the hash.
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * ones > sizes[full][:, None], axis=1).view(">u8").ravel()
    return out


def _fingerprint_task() -> Callable[[list[str | None]], dict[str, Sequence]]:
    return lambda texts: {"fp": fingerprints(texts).view(np.int64)}


def _homes() -> np.ndarray:
    """For each 15-bit value the word of the Hamming code next to it: the exclusive or of the places of its ones is the place to change."""
    values = np.arange(1 << 15)
    syndrome = np.zeros(1 << 15, np.int64)
    for place in range(1, 16):
        syndrome ^= np.where(values >> (place - 1) & 1, place, 0)
    return np.where(syndrome > 0, values ^ (1 << np.maximum(syndrome - 1, 0)), values).astype(np.int64)


HOMES = _homes()
_FLIPS = np.array([0] + [1 << i for i in range(24)], np.int64)


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The anchors of each fingerprint: its index, and the anchor's key (the part above 24 bits of anchor)."""
    owner = [np.arange(len(fps))]
    keys = [(fps & np.uint64(0xFFFF)).astype(np.int64)]
    for part, shift in ((1, 16), (2, 40)):
        near = (fps >> np.uint64(shift) & np.uint64(0xFFFFFF)).astype(np.int64)[:, None] ^ _FLIPS
        at = np.sort((near >> 15 << 15) | HOMES[near & 0x7FFF], axis=1)
        new = np.ones_like(at, bool)
        new[:, 1:] = at[:, 1:] != at[:, :-1]
        row, _ = np.nonzero(new)
        owner.append(row)
        keys.append(at[new] | part << 24)
    return np.concatenate(owner), np.concatenate(keys)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column("fp").to_numpy().astype(np.int64)
        for a in range(0, len(fps), 20_000):
            part = fps[a : a + 20_000]
            owner, keys = anchors(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[owner])], names=["anchor", "fp"])


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of n indices over the links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        label = label[label]
        if (label == before).all():
            return label


def _pivot_links(fps: np.ndarray, threshold: int) -> np.ndarray:
    """The root of each fingerprint of one large group, without making its pairs.

    A pivot is compared with the whole group and joined with all it links to. Only
    fingerprints outside the largest component so far need to be pivots: a link
    within it changes nothing, and a link into it is seen from outside.
    """
    label = np.arange(len(fps))
    waiting = np.ones(len(fps), bool)
    pivot = 0
    while True:
        waiting[pivot] = False
        met = np.unique(label[np.bitwise_count(fps ^ fps[pivot]) <= threshold])
        if len(met) > 1:
            label[np.isin(label, met)] = met[0]
        sizes = np.bincount(label, minlength=len(fps))
        left = np.flatnonzero(waiting & (label != sizes.argmax()))
        if not len(left):
            return label
        pivot = int(left[0])


def links_of_groups(keys: np.ndarray, fps: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is connected inside each run of equal keys: a tree of each, never all its pairs."""
    n = len(keys)
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, n])
    label = np.arange(n)
    end = np.repeat(starts + sizes, sizes)
    large = np.repeat(sizes > SHIFTED, sizes)
    at = np.flatnonzero(~large)
    left, right = [], []
    for shift in range(1, SHIFTED):
        at = at[at + shift < end[at]]
        if not len(at):
            break
        near = at[np.bitwise_count(fps[at] ^ fps[at + shift]) <= threshold]
        left.append(near)
        right.append(near + shift)
    if left:
        label = _roots(n, np.concatenate(left), np.concatenate(right))
    for a, size in zip(starts[sizes > SHIFTED].tolist(), sizes[sizes > SHIFTED].tolist(), strict=True):
        label[a : a + size] = a + _pivot_links(fps[a : a + size], threshold)
    linked = np.flatnonzero(label != np.arange(n))
    return fps[linked], fps[label[linked]]


def _compare(threshold: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over rows sorted by anchor: the links at each anchor, a step of whole groups at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            u, v = links_of_groups(keys, fps.view(np.uint64), threshold)
            # Two fingerprints often meet at several anchors.
            pairs = np.unique(np.stack([u.view(np.int64), v.view(np.int64)]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["u", "v"])

        for batch in batches:
            held.append((batch.column("anchor").to_numpy(), batch.column("fp").to_numpy()))
            if sum(len(k) for k, _ in held) < STEP_ROWS or held[-1][0][0] == held[-1][0][-1]:
                continue
            keys, fps = (np.concatenate(x) for x in zip(*held, strict=True))
            cut = int(np.searchsorted(keys, keys[-1]))
            held = [(keys[cut:], fps[cut:])]
            if cut:
                yield links(keys[:cut], fps[:cut])
        if held:
            yield links(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def fingerprint_links(fps: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Links ``(u, v)`` between distinct fingerprints ``fp`` that connect all within ``threshold`` bits."""
    if not 0 <= threshold <= THRESHOLD:
        raise OptionError(f"the anchors cover thresholds from 0 to {THRESHOLD} bits")
    placed = fps.select("fp").mapInArrow(_replicate, "anchor bigint, fp bigint")
    return placed.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_compare(threshold), "u bigint, v bigint").distinct()


def simhash_components(docs: DataFrame, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id``: the smallest id reachable over links.

    Copies with one fingerprint are one node from the start, so a group of exact copies
    costs one comparison however large it is. Null and wordless texts have fingerprint
    zero and are linked like any other. Repeated rows give repeated results. Rows
    without an id take part with their text; a component with no id at all has a null
    ``component_id``. Only the id and the text are read.
    """
    prints = materialize(map_texts(id_and_text(docs, id_col, text_col), _fingerprint_task, "fp bigint"))
    return _with_components(prints, threshold).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _component_of(prints: DataFrame, least: str, threshold: int) -> DataFrame:
    """Per distinct fingerprint the smallest ``least`` of its component."""
    nodes = prints.groupBy("fp").agg(F.min(least).alias("least"))
    roots = components(fingerprint_links(nodes, threshold))
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    small = placed.groupBy("root").agg(F.min("least").alias("component"))
    return placed.join(small, "root").select("fp", "component")


def _with_components(prints: DataFrame, threshold: int) -> DataFrame:
    return prints.join(_component_of(prints, "doc_id", threshold).withColumnRenamed("component", "component_id"), "fp")


def keep_one_per_component(docs: DataFrame, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, one of each component: the one with the smallest id, all columns kept.

    Rows are told apart by id and a hash of id and text; of rows that agree in both one
    stays. Rows without an id come after all others.
    """
    keyed = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    prints = materialize(map_texts(keyed, _fingerprint_task, "fp bigint"))
    return keep_rows(docs, _component_of(prints, "key", threshold).select(F.col("component").alias("stay")).distinct(), id_col, text_col)


def row_key(id_col: str, text_col: str) -> Column:
    """What tells rows apart, in the order in which they are kept."""
    return F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("row"))


def keep_rows(docs: DataFrame, stay: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose key is in the column ``stay``, one of each key."""
    work = {"key": "_simhash_key", "copy": "_simhash_copy"}
    marked = docs.withColumn(work["key"], row_key(id_col, text_col))
    mine, other = F.col(work["key"]), F.col("stay")
    kept = marked.join(stay, (mine["row"] == other["row"]) & mine["id"].eqNullSafe(other["id"])).drop("stay")
    first = Window.partitionBy(f"{work['key']}.row", f"{work['key']}.id").orderBy(F.lit(0))
    return kept.withColumn(work["copy"], F.row_number().over(first)).where(f"{work['copy']} = 1").select(*docs.columns)
