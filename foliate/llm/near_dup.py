"""Near-duplicates by shared word shingles: two texts link at a Jaccard similarity of 0.8 or more.

A text stands for the set of its windows of five words. Texts meet where their SimHash
fingerprints differ in four bits or fewer, found by the anchors of ``simhash``. At a similarity of 0.8
64 bits differ in ten on average, so the fingerprints' candidates are joined by those of MinHash:
of 200 minima of a set, five make a band, and texts meet where a band of theirs is equal. Two sets of similarity 0.8 have no band in common with a probability of
(1 - 0.8^5)^40, one in eight million, and closer ones more seldom. What meets is
compared by its whole sets before it is linked, so no link is below the threshold.

Texts with one set are one node, however many copies there are. Nodes that meet, directly
or through others, are a cloud. The sets of a cloud are dealt out in blocks of bounded size
and each pair of blocks is one group: a task compares what meets in it, leaves out what it
linked already, and gives back the links of a spanning forest. So no pair is ever a row, a
set travels once unless its cloud has several blocks, and the work inside a cloud is spread
over as many tasks as it has pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.llm.frames import map_texts, remove, store, written
from foliate.llm.graph import components
from foliate.llm.simhash import THRESHOLD as BITS
from foliate.llm.simhash import fingerprint_links, fingerprints, keep_rows, row_key

SHINGLE = 5
THRESHOLD = 0.8
BANDS, BAND_ROWS = 40, 5
SEED = 42
#: Hashes in a block of a cloud: 32 MB of sets, and at most as much again for their minima.
BLOCK_HASHES = 4 << 20
#: Of 200 minima, this many agree less often than once in ten million pairs of similarity 0.8.
AGREEING = 128

_RNG = np.random.default_rng(SEED)
_PLACES = _RNG.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_MASKS = _RNG.integers(0, 1 << 32, BANDS * BAND_ROWS, dtype=np.uint32)
_FACTORS = _RNG.integers(0, 1 << 32, BANDS * BAND_ROWS, dtype=np.uint32) | np.uint32(1)
_IN_BAND = _RNG.integers(0, 1 << 63, (BANDS, BAND_ROWS), dtype=np.uint64) | np.uint64(1)
_BAND = _RNG.integers(0, 1 << 63, BANDS, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of MurmurHash3."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct hashes of all windows of five words; a shorter text is one window of its words."""
    words = (text or "").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(w, SEED) for w in words] + [0] * (SHINGLE - len(words)), np.uint64)
    n = len(hashes) - SHINGLE + 1
    total = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        total += hashes[i : i + n] * _PLACES[i]
    return np.unique(_mixed(total))


def minima(sets: Sequence[np.ndarray]) -> np.ndarray:
    """A row of minima per set; no set may be empty."""
    starts = np.cumsum([len(s) for s in sets]) - [len(s) for s in sets]
    high = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    found = np.empty((len(sets), len(_MASKS)), np.uint32)
    for k, (mask, factor) in enumerate(zip(_MASKS, _FACTORS, strict=True)):
        found[:, k] = np.minimum.reduceat((high ^ mask) * factor, starts)
    return found


def band_keys(of: np.ndarray) -> np.ndarray:
    """One key per set and band, from five minima each."""
    rows = of.astype(np.uint64).reshape(len(of), BANDS, BAND_ROWS)
    return _mixed((rows * _IN_BAND).sum(axis=2, dtype=np.uint64) + _BAND)


def _sketch_task() -> Callable[[list[str | None]], dict[str, Sequence]]:
    def sketch(texts: list[str | None]) -> dict[str, Sequence]:
        sets = [shingles(t) for t in texts]
        nodes = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
        bands: list[Sequence] = [()] * len(sets)
        full = [i for i, s in enumerate(sets) if len(s)]
        if full:
            for i, keys in zip(full, band_keys(minima([sets[i] for i in full])).view(np.int64), strict=True):
                bands[i] = keys
        return {"node": nodes, "bands": bands, "fp": fingerprints(texts).view(np.int64)}

    return sketch


def _set_task() -> Callable[[list[str | None]], dict[str, Sequence]]:
    return lambda texts: {"hashes": [shingles(t).view(np.int64) for t in texts]}


class Forest:
    """Components of the nodes 0 to n - 1 while links come in; ``label`` is the same inside a component."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)
        self.members = [[i] for i in range(n)]

    def link(self, a: int, b: int) -> bool:
        """Join the components of two nodes; false if they are one already."""
        small, large = sorted((int(self.label[a]), int(self.label[b])), key=lambda x: len(self.members[x]))
        if small == large:
            return False
        self.label[self.members[small]] = large
        self.members[large] += self.members[small]
        self.members[small] = []
        return True


def shared(one: np.ndarray, others: Sequence[np.ndarray]) -> np.ndarray:
    """How many hashes each of the others has in common with the one; all are sorted, none is empty."""
    lengths = np.array([len(o) for o in others])
    every = np.concatenate(others)
    found = one[np.minimum(np.searchsorted(one, every), len(one) - 1)] == every
    return np.add.reduceat(found, np.cumsum(lengths) - lengths, dtype=np.int64)


def forest_links(sets: Sequence[np.ndarray], block: np.ndarray, threshold: float, fps: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect all sets that meet and are similar enough; of two blocks only sets of different ones are compared.

    Pairs of near fingerprints come first: their sizes can rule them out, then the sets decide. Any
    other pair is looked at where its first common band is. Sizes and minima rule most pairs out
    before the sets are compared, and pairs inside a component are left out.
    """
    of = minima(sets)
    bands = band_keys(of)
    sizes = np.array([len(s) for s in sets])
    two, forest, links = block.any() and not block.all(), Forest(len(sets)), []

    def open_to(a: int, rest: np.ndarray) -> np.ndarray:
        rest = rest[forest.label[rest] != forest.label[a]]
        if two:
            rest = rest[block[rest] != block[a]]
        return rest[np.minimum(sizes[rest], sizes[a]) >= threshold * np.maximum(sizes[rest], sizes[a])]

    def compare(a: int, rest: np.ndarray) -> None:
        if len(rest):
            common = shared(sets[a], [sets[i] for i in rest])
            near = common / (sizes[rest] + sizes[a] - common) >= threshold
            links.extend((int(a), int(i)) for i in rest[near] if forest.link(a, i))

    for a in range(len(sets) - 1 if fps is not None else 0):
        compare(a, open_to(a, a + 1 + np.flatnonzero(np.bitwise_count(fps[a + 1 :] ^ fps[a]) <= BITS)))
    for b in range(BANDS):
        order = np.argsort(bands[:, b], kind="stable")
        ends = np.flatnonzero(np.diff(bands[order, b])) + 1
        for place in np.split(order, ends):
            for k, a in enumerate(place[:-1]):
                rest = open_to(a, place[k + 1 :])
                rest = rest[~(bands[rest, :b] == bands[a, :b]).any(axis=1)]
                compare(a, rest[(of[rest] == of[a]).sum(axis=1) >= AGREEING])
    return links


def _nodes(prints: DataFrame) -> DataFrame:
    """Each node with one of its rows and the fingerprint of that row's text."""
    return prints.groupBy("node").agg(F.min("key").alias("one"), F.min_by("fp", "key").alias("fp"))


def _clouds(prints: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node`` and ``root`` of the nodes that meet others, by fingerprint or band; the root is the least node of a cloud."""
    at = nodes.groupBy("fp").agg(F.min("node").alias("least"))
    equal = nodes.join(at, "fp").where("node != least").select(F.col("node").alias("u"), F.col("least").alias("v"))
    one, other = (at.select(F.col("fp").alias(link), F.col("least").alias(f"node_{link}")) for link in ("u", "v"))
    near = fingerprint_links(at).join(one, "u").join(other, "v").select(F.col("node_u").alias("u"), F.col("node_v").alias("v"))
    places = prints.select(F.explode("bands").alias("band"), "node")
    met = places.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least != most")
    banded = places.join(met, "band").where("node != least").select(F.col("node").alias("u"), F.col("least").alias("v"))
    return components(equal.unionAll(near).unionAll(banded).distinct())


def _sets(keyed: DataFrame, nodes: DataFrame, clouds: DataFrame) -> DataFrame:
    """``root``, ``node``, fingerprint and the whole set of each node of a cloud, from the text of one of its rows."""
    nodes = nodes.join(clouds, "node")
    mine, one = F.col("key"), F.col("one")
    texts = keyed.join(nodes, (mine["row"] == one["row"]) & mine["id"].eqNullSafe(one["id"])).select("node", "root", "fp", "text")
    return map_texts(texts.groupBy("node", "root", "fp").agg(F.min("text").alias("text")), _set_task, "hashes array<bigint>")


def _compare(threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, nodes, sets, blocks, fps = None, [], [], [], []

        def links() -> pa.RecordBatch:
            found = forest_links(sets, np.array(blocks, bool), threshold, np.array(fps, np.int64).view(np.uint64)) if len(sets) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([nodes[pair[i]] for pair in found], pa.int64()) for i in (0, 1)], names=["u", "v"])

        for batch in batches:
            hashes = batch.column("hashes")
            flat, at = hashes.values.to_numpy().view(np.uint64), hashes.offsets.to_numpy()
            keys = zip(*(batch.column(c).to_pylist() for c in ("root", "low", "high")), strict=True)
            rows = zip(keys, *(batch.column(c).to_pylist() for c in ("node", "block", "fp")), strict=True)
            for i, (key, node, block, fp) in enumerate(rows):
                if key != group:
                    yield links()
                    group, nodes, sets, blocks, fps = key, [], [], [], []
                fps.append(fp)
                nodes.append(node)
                blocks.append(block != key[1])
                sets.append(flat[at[i] : at[i + 1]].copy())
        yield links()

    return run


def shingle_links(keyed: DataFrame, prints: DataFrame, threshold: float = THRESHOLD, block_hashes: int = BLOCK_HASHES) -> DataFrame:
    """Links ``(u, v)`` that connect all nodes that meet and are similar enough."""
    nodes = _nodes(prints)
    spark, path = keyed.sparkSession, store(_sets(keyed, nodes, _clouds(prints, nodes)), "sets")
    sets = spark.read.parquet(path)
    blocks = sets.groupBy("root").agg(F.ceil(F.sum(F.size("hashes").cast("bigint")) / F.lit(block_hashes)).cast("int").alias("blocks")).where("blocks > 1")
    dealt = sets.join(blocks, "root", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(F.least("block", other).alias("low"), F.greatest("block", other).alias("high")))
    rows = dealt.select("root", "node", "block", "fp", "hashes", F.explode(pairs).alias("pair")).select("root", "pair.low", "pair.high", "block", "node", "fp", "hashes")
    grouped = rows.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high", "node")
    links = written(grouped.mapInArrow(_compare(threshold), "u bigint, v bigint"), "links")
    remove(spark, path)
    return links


def keep_one_per_component(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", block_hashes: int = BLOCK_HASHES) -> DataFrame:
    """The rows of ``docs``, one of each component of similar texts: the one with the smallest id, all columns kept.

    Rows are told apart by id and a hash of id and text; of rows that agree in both one
    stays. Rows without an id come after all others. Null and wordless texts are equal.
    """
    keyed = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    prints = written(map_texts(keyed, _sketch_task, "node bigint, bands array<bigint>, fp bigint"), "prints")
    links = shingle_links(keyed, prints, threshold, block_hashes)
    roots = components(links).withColumnRenamed("node", "member")
    nodes = prints.groupBy("node").agg(F.min("key").alias("least"))
    placed = nodes.join(roots, F.col("node") == F.col("member"), "left").groupBy(F.coalesce("root", "node")).agg(F.min("least").alias("stay"))
    return keep_rows(docs, placed.select("stay"), id_col, text_col)
