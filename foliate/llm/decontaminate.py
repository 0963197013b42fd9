"""Benchmark decontamination with suffix arrays over the training text.

A shard is a step of documents in a task. Its words are numbered by the vocabulary of
the benchmark, and all its suffixes that could match are sorted into a suffix array.
Every suffix of every benchmark item is then looked up by binary search, all at once,
one word deeper each time. The depth at which its range in the array gets empty is the
length of its longest verbatim match in the shard; the range at the depth of a window
holds every place where the window occurs. Equal windows share a range, and occurrences
are never paired with windows.

A text word outside the benchmark's vocabulary can be in no match. A suffix that
meets one within the length of the shortest window is left out of the array before it is
sorted; no match is lost by that.

Documents don't move: a shard's matches concern only its own documents, so there is
no shuffle. The benchmark is read in blocks of a bounded number of words, each sent to
the executors once; with several blocks the documents pass through one after another.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.llm.frames import id_and_text, slices

WINDOW = 10
#: Words of benchmark text in a block, at least one item: the bound of what is sent to the executors at a time.
BLOCK_WORDS = 1_000_000
#: ASCII letters in lower case; all other ASCII but digits becomes a space. Bytes above 0x7F belong to words.
_TABLE = bytes(ord(chr(b).lower()) if chr(b).isalnum() and b < 0x80 or b >= 0x80 else 0x20 for b in range(0x80)) + bytes(range(0x80, 0x100))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


@dataclass(frozen=True)
class Block:
    """Some benchmark texts, each once: the ids of its items, and all their words by number, one 0 behind each text."""

    items: list[list[str]]
    vocabulary: dict[bytes, int]
    words: np.ndarray
    suffixes: np.ndarray
    item: np.ndarray
    window: np.ndarray
    left: np.ndarray
    by_name: np.ndarray

    @property
    def shortest(self) -> int:
        return int(self.window.min()) if len(self.window) else WINDOW


def make_block(rows: list[tuple[str, list[bytes]]]) -> Block:
    """``suffixes``: the starts of all windows; of each its text, its window's length and the words left in the text. Texts go by their smallest id.

    ``by_name``: the windows by that id, then by their place in the text.
    """
    same: dict[tuple[bytes, ...], set[str]] = {}
    for name, words in rows:
        same.setdefault(tuple(words), set()).add(name)
    texts = sorted((sorted(names), words) for words, names in same.items())
    vocabulary: dict[bytes, int] = {}
    flat: list[int] = []
    starts, item, window, left = [], [], [], []
    for i, (_, words) in enumerate(texts):
        n = len(words)
        size = min(n, WINDOW)
        for j in range(n - size + 1 if n else 0):
            starts.append(len(flat) + j)
            item.append(i)
            window.append(size)
            left.append(n - j)
        flat += [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words]
        flat.append(0)
    words, suffixes, item, window, left = (np.array(x, np.int64) for x in (flat or [0], starts, item, window, left))
    names = np.unique([names[0] for names, _ in texts], return_inverse=True)[1]
    by_name = np.lexsort((suffixes - suffixes[np.searchsorted(item, item)], names[item])) if len(item) else item
    return Block([names for names, _ in texts], vocabulary, words, suffixes, item, window, left, by_name)


def suffix_array(words: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` sorted by the words that follow, up to ``depth`` of them, by prefix doubling."""
    rank = words.astype(np.int64)
    h = 1
    while True:
        if h >= depth:
            break
        ahead = np.zeros_like(rank)
        ahead[:-h] = rank[h:]
        _, rank = np.unique(rank * (int(rank.max()) + 1) + ahead, return_inverse=True)
        h *= 2
    return starts[np.argsort(rank[starts], kind="stable")]


@dataclass(frozen=True)
class Found:
    """For every window start of a block: the range of the array where its window occurs, and its longest match in words.

    For every place of the array: its longest match with the block, of a whole window at
    least, and the first window start that has it; 0 and -1 without one.
    """

    low: np.ndarray
    high: np.ndarray
    longest: np.ndarray
    length: np.ndarray
    source: np.ndarray


def spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every number of the ranges, and the index of the range it comes from."""
    size = high - low
    which = np.repeat(np.arange(len(low)), size)
    return np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + low[which], which


def search(text: np.ndarray, array: np.ndarray, block: Block) -> Found:
    """All suffixes of the block at once. At one depth ranges are equal or apart, so a place is visited once per word that it matches."""
    n = len(block.suffixes)
    low, high = np.zeros(n, np.int64), np.full(n, len(array), np.int64)
    longest = np.zeros(n, np.int64)
    found_low, found_high = np.zeros(n, np.int64), np.zeros(n, np.int64)
    length, source = np.zeros(len(array), np.int64), np.full(len(array), -1, np.int64)
    live = block.by_name if len(array) else np.zeros(0, np.int64)
    depth = 0
    while len(live):
        wanted = block.words[block.suffixes[live] + depth]
        edges = []
        for beyond in (0, 1):
            a, b = low[live].copy(), high[live].copy()
            while (open_ := a < b).any():
                mid = (a + b) >> 1
                at = text[array[np.minimum(mid, len(array) - 1)] + depth]
                up = open_ & (at < wanted + beyond)
                a = np.where(up, mid + 1, a)
                b = np.where(open_ & ~up, mid, b)
            edges.append(a)
        low[live], high[live] = edges
        depth += 1
        live = live[edges[0] < edges[1]]
        longest[live] = depth
        whole = live[block.window[live] == depth]
        found_low[whole], found_high[whole] = low[whole], high[whole]
        # ``live`` goes by name and place, so the first of equal ranges is the one to report.
        matched = live[block.window[live] <= depth]
        if len(matched):
            begins, first = np.unique(low[matched], return_index=True)
            places, which = spread(begins, high[matched[first]])
            length[places], source[places] = depth, matched[first][which]
        live = live[block.left[live] > depth]
    return Found(found_low, found_high, longest, length, source)


@dataclass
class Hits:
    """Per text: words, words hit, matched items, and the longest match with its places."""

    n_words: np.ndarray
    hit: list[np.ndarray]
    items: list[set[str]]
    longest: np.ndarray
    at: np.ndarray
    item: list[str | None]
    item_at: np.ndarray


def match_shard(texts: list[str | None], block: Block) -> Hits:
    """All matches between the texts of a shard and a block."""
    number = block.vocabulary.get
    words = [words_of(t) for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    flat = np.zeros(int((sizes + 1).sum()), np.int64)
    for a, w in zip(starts.tolist(), words, strict=True):
        flat[a : a + len(w)] = [number(x, 0) for x in w]
    hit = np.zeros(len(flat) + 1, np.int64)
    hits = Hits(sizes, [], [set() for _ in texts], np.zeros(len(texts), np.int64), np.full(len(texts), -1, np.int64), [None] * len(texts), np.full(len(texts), -1, np.int64))
    # How many known words follow from each place on, itself included.
    zeros = np.flatnonzero(flat == 0)
    following = zeros[np.searchsorted(zeros, np.arange(len(flat)))] - np.arange(len(flat)) if len(flat) else flat
    near = following >= block.shortest
    if near.any():
        # Only the runs that hold a possible match, each with a zero behind.
        inside = np.zeros(len(flat) + 1, np.int64)
        begins = np.flatnonzero(near)
        np.add.at(inside, begins, 1)
        np.add.at(inside, begins + following[begins] + 1, -1)
        place = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
        short = flat[place]
        depth = int(block.left.max())
        text = np.concatenate([short, np.zeros(depth + 1, np.int64)])
        array = suffix_array(text, np.flatnonzero(near[place]), depth)
        found = search(text, array, block)
        at = place[array]
        owner = np.searchsorted(starts, at, side="right") - 1
        # Equal windows have one range: its places are marked once, and its texts meet its items once.
        occurs = np.flatnonzero(found.low < found.high)
        keys = np.stack([found.low[occurs], block.window[occurs]])
        _, first, group = np.unique(keys, axis=1, return_index=True, return_inverse=True)
        places, of = spread(found.low[occurs[first]], found.high[occurs[first]])
        np.add.at(hit, at[places], 1)
        np.add.at(hit, at[places] + block.window[occurs[first]][of], -1)
        group_doc = np.unique(np.stack([of, owner[places]]), axis=1)
        group_item = np.unique(np.stack([group.reshape(-1), block.item[occurs]]), axis=1)
        bounds = np.searchsorted(group_item[0], np.stack([group_doc[0], group_doc[0] + 1]))
        items, row = spread(bounds[0], bounds[1])
        for doc, item in np.unique(np.stack([group_doc[1][row], group_item[1][items]]), axis=1).T.tolist():
            hits.items[doc].update(block.items[item])
        # The longest match of each text; among equals the first place, the smallest item id, the first place in the item.
        best = np.flatnonzero(found.length)
        best = best[np.lexsort((at[best], -found.length[best], owner[best]))]
        best = best[np.flatnonzero(np.r_[True, np.diff(owner[best]) != 0])] if len(best) else best
        for i in best.tolist():
            doc, source = int(owner[i]), int(found.source[i])
            hits.longest[doc], hits.at[doc] = found.length[i], at[i] - starts[doc]
            item = int(block.item[source])
            hits.item[doc], hits.item_at[doc] = block.items[item][0], block.suffixes[source] - block.suffixes[np.searchsorted(block.item, item)]
    covered = np.cumsum(hit[:-1]) > 0
    hits.hit = [np.flatnonzero(covered[a : a + n]) for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
    return hits


def benchmark_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The benchmark in blocks of bounded size, read partition by partition. Items without a word have no window."""
    rows: list[tuple[str, list[bytes]]] = []
    held = 0
    for row in benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("i"), F.col(text_col).cast("string").alias("t")).toLocalIterator():
        if words := words_of(row["t"]):
            rows.append((row["i"], words))
            held += len(words)
        if held >= block_words:
            yield make_block(rows)
            rows, held = [], 0
    if rows:
        yield make_block(rows)


_STATE = "hit array<int>, items array<string>, longest_match bigint, match_at bigint, match_item string, match_item_at bigint"


def _pass(df: DataFrame, block: Block, last: bool) -> DataFrame:
    """Add a block's matches to the rows' state; the last pass gives the results instead of text and state."""
    sent = df.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        for batch in batches:
            for part in slices(batch, "text"):
                found = match_shard(part["text"].to_pylist(), block)
                old = zip(*(part[c].to_pylist() for c in ("hit", "items", "longest_match", "match_at", "match_item", "match_item_at")), strict=True)
                rows = []
                for i, (hit, items, longest, at, item, item_at) in enumerate(old):
                    best = (longest, at, item, item_at)
                    if found.longest[i]:
                        mine = (int(found.longest[i]), int(found.at[i]), found.item[i], int(found.item_at[i]))
                        best = min(mine, best, key=lambda m: (-m[0], *m[1:])) if longest else mine
                    rows.append((np.union1d(hit, found.hit[i]).astype(np.int32) if hit else found.hit[i].astype(np.int32), sorted(found.items[i].union(items)), *best))
                hit, items, longest, at, item, item_at = zip(*rows, strict=True)
                tail = [pa.array(longest, pa.int64()), pa.array(at, pa.int64()), pa.array(item, pa.string()), pa.array(item_at, pa.int64())]
                names = ["longest_match", "match_at", "match_item", "match_item_at"]
                if last:
                    n_hit = np.array([len(h) for h in hit], np.int64)
                    digests = [sha256(",".join(x).encode()).hexdigest() for x in items]
                    head = [pa.array(found.n_words), pa.array(n_hit), pa.array([len(x) for x in items], pa.int64()), pa.array(digests), pa.array(n_hit > 0)]
                    yield pa.RecordBatch.from_arrays([part["doc_id"], *head, *tail], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", *names])
                else:
                    yield pa.RecordBatch.from_arrays([part["doc_id"], part["text"], pa.array(hit, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string())), *tail], names=["doc_id", "text", "hit", "items", *names])

    kind = df.schema["doc_id"].dataType.simpleString()
    tail = "longest_match bigint, match_at bigint, match_item string, match_item_at bigint"
    done = f"doc_id {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, {tail}"
    return df.mapInArrow(run, done if last else f"doc_id {kind}, text string, {_STATE}")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: its words, those inside an occurrence of a benchmark window, and the items found.

    ``longest_match`` words match verbatim from word ``match_at`` of the document and word
    ``match_item_at`` of ``match_item``; 0, -1 and null without a match. Items of fewer
    than ten words are one window; a null or wordless item or document has none. An item
    id that is null reads as an empty string; several rows with one id are one item.
    Repeated documents give repeated results; an empty table of documents gives no row. An
    empty benchmark hits nothing. A text of any length is one row's work, in proportion to
    its length and to that of its matches, periodic texts included. Only the ids and texts
    are read.
    """
    state = id_and_text(docs, id_col, text_col).select(
        "doc_id",
        "text",
        F.array().cast("array<int>").alias("hit"),
        F.array().cast("array<string>").alias("items"),
        F.lit(0).cast("bigint").alias("longest_match"),
        F.lit(-1).cast("bigint").alias("match_at"),
        F.lit(None).cast("string").alias("match_item"),
        F.lit(-1).cast("bigint").alias("match_item_at"),
    )
    waiting = None
    for block in benchmark_blocks(benchmark, block_words=block_words):
        if waiting is not None:
            state = _pass(state, waiting, last=False)
        waiting = block
    return _pass(state, waiting or make_block([]), last=True)


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark window, with all their columns."""
    kept = docs
    for block in benchmark_blocks(benchmark, block_words=block_words):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, text_col):
                    yield part.filter(pa.array([not len(h) for h in match_shard(part[text_col].to_pylist(), sent.value).hit], pa.bool_()))

        kept = kept.mapInArrow(run, docs.schema)
    return kept
