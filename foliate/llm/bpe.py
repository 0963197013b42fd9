"""BPE as a streaming transducer with bounded lookahead, and incremental decoding.

Whether a token stands at the front of what has been read can depend on text still to
come, but only within a bound that the merge list itself sets. Let a merge be (l, r)
with its rank. A token v may be taken by a merge (v, w) only if w forms, and w is
itself still there at that rank, which hangs on merges (w, x) of smaller rank, and so
on: ranks fall along the chain, so it ends. One pass over the merges in rank order
sums the longest such chain for each token; the largest sum, with the token itself, is
the sufficient lookahead. Once that many symbols behind the start of the front token
are known, it can no longer change, and is given out. What is held is never more than
the lookahead and one step, however long a run without white space gets.

A text that is not cut needs no lookahead: at the end of a pretoken all is stable.
"""

from __future__ import annotations

import codecs
import json
import re
import sys
import unicodedata
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache
from hashlib import sha256

import regex
from pyspark.sql import DataFrame

from foliate.errors import OptionError
from foliate.llm.frames import id_and_text, map_texts

#: Symbols read into the transducer between two looks at what is stable.
STEP = 256
#: Pretokens remembered per task, and the longest that are.
MEMO, MEMO_CHARS = 300_000, 48
#: White space as the vocabulary's patterns understand it (the Unicode property White_Space).
_SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNK = 1 << 16


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the others for the characters
    from U+0100 on, in order.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


def sufficient_lookahead(merges: Iterable[tuple[str, str]], length: Callable[[str], int] = len) -> int:
    """Symbols from the start of a token after which no later text can change it."""
    reach: dict[str, int] = {}
    most = 0
    for left, right in merges:
        chain = length(right) + reach.get(right, 0)
        reach[left] = max(chain, reach.get(left, 0))
        most = max(most, length(left) + reach[left])
    return most


# Letters and numbers that Unicode 16.0 added, first and last of each range.
ADDED_IN_16 = """
1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D40-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B 1138E 11390-113B5 113B7 113D1 113D3
116D0-116E3 11BC0-11BE0 11BF0-11BF9 13460-143FA 16100-1611D 16130-16139 16D40-16D6C 16D70-16D79 18CFF 1CCF0-1CCF9 1E5D0-1E5ED 1E5F0-1E5FA
"""


@lru_cache(maxsize=1)
def newer_characters() -> str:
    """A character class of the letters and numbers that came after Unicode 16.0.

    The pattern library follows a newer Unicode than the library the vocabulary files are
    made for; to that one these characters are neither letters nor numbers.
    """
    known = set()
    for span in ADDED_IN_16.split():
        first, _, last = span.partition("-")
        known.update(map(chr, range(int(first, 16), int(last or first, 16) + 1)))
    unassigned = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Cn" and c not in known)
    found = "".join(regex.findall(r"[\p{L}\p{N}]", unassigned))
    return "[" + "".join(map(re.escape, found)) + "]"


class Vocabulary:
    """A tokenizer file of merges with a word-end suffix, read once per task.

    Reads the parts that files of this kind set: NFC, white space, lower case, the
    pattern of pretokens, byte-level symbols, merges and added tokens. Truncation and
    padding are not applied. Anything else in the file is refused rather than ignored.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise OptionError("only plain BPE models with a word-end suffix are read")
        if [n["type"] for n in spec["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"] or spec.get("decoder") is not None:
            raise OptionError("the file asks for a normalizer or decoder that is not read here")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks: dict[tuple[str, str], int] = {pair: i for i, pair in enumerate(pairs)}
        self.lookahead = sufficient_lookahead(pairs, lambda t: len(t.removesuffix(self.suffix)) if self.suffix else len(t))
        self.added: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings: dict[int, str] = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.added.items()}
        pattern = split["pattern"]["Regex"].replace(r"[^\s", "[^" + _SPACE)
        newer = newer_characters()
        self._newer, self._newest_known = re.compile(newer), chr(ord(newer[1]) - 1)
        self._pretokens = regex.compile(pattern)
        # For the rare text that has such a character; sets within sets are slower to match.
        self._careful = regex.compile("(?V1)" + re.sub(r"\[(\^?)([^\]]*?)((?:\\p\{[LN]\})+)\]", lambda m: f"[{m[1]}{m[2]}[[{m[3]}]--{newer}]]", pattern))
        longest_first = sorted(self.added, key=len, reverse=True)
        self._specials = regex.compile("|".join(map(regex.escape, longest_first))) if longest_first else None
        self._symbols = [byte_symbols()[b] for b in range(256)]

    def segments(self, text: str) -> Iterator[tuple[str, int | None]]:
        """The text between added tokens, and the added tokens with their ids."""
        at = 0
        for m in self._specials.finditer(text) if self._specials else ():
            if m.start() > at:
                yield text[at : m.start()], None
            yield m.group(), self.added[m.group()]
            at = m.end()
        if at < len(text):
            yield text[at:], None

    def normalized(self, text: str) -> str:
        # Case is changed character by character: a sigma at the end of a word gets no special form.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def pretokens(self, text: str) -> list[str]:
        """The pretokens of a normalized text."""
        careful = not text.isascii() and max(text) > self._newest_known and self._newer.search(text)
        return (self._careful if careful else self._pretokens).findall(text)

    def symbols(self, pretoken: str) -> list[str]:
        """The byte symbols of a pretoken, the last with the word-end suffix."""
        own = self._symbols
        out = [own[b] for b in pretoken.encode()]
        out[-1] += self.suffix
        return out

    def merged(self, symbols: list[str]) -> list[str]:
        """Apply the merges to symbols: the smallest rank first, the leftmost first among equals."""
        rank, none = self.ranks.get, len(self.ranks)
        parts = list(symbols)
        # The rank of each adjacent pair; a merge changes only the two pairs beside it.
        open_ = [rank(pair, none) for pair in zip(parts, parts[1:], strict=False)]
        while open_:
            best = min(open_)
            if best == none:
                break
            i = open_.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del open_[i]
            if i < len(open_):
                open_[i] = rank((parts[i], parts[i + 1]), none)
            if i:
                open_[i - 1] = rank((parts[i - 1], parts[i]), none)
        return parts

    def transduce(self, symbols: Iterable[str]) -> Iterator[str]:
        """The tokens of one pretoken, each as soon as it is stable."""
        held: list[str] = []
        end = self.suffix
        for symbol in symbols:
            held.append(symbol)
            if len(held) >= self.lookahead + STEP and not (end and symbol.endswith(end)):
                known, given = len(held), 0
                for token in self.merged(held):
                    if known - given < self.lookahead:
                        break
                    yield token
                    given += len(token)
                # What is left begins at a token's start, so its tokens don't depend on what is gone.
                held = held[given:]
        yield from self.merged(held)


class Encoder:
    """Encodes texts with a vocabulary; remembers the tokens of short pretokens in a bounded memo."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._memo: dict[str, tuple[int, ...]] = {}

    def pretoken(self, pretoken: str) -> tuple[int, ...]:
        found = self._memo.get(pretoken)
        if found is None:
            ids = self.vocabulary.ids
            found = tuple(ids[t] for t in self.vocabulary.transduce(self.vocabulary.symbols(pretoken)))
            if len(pretoken) <= MEMO_CHARS:
                if len(self._memo) >= MEMO:
                    self._memo.clear()
                self._memo[pretoken] = found
        return found

    def chunks(self, text: str) -> Iterator[list[int]]:
        """The ids of a text, chunk by chunk; a chunk ends before white space, where no pretoken or composition crosses."""
        for segment, special in self.vocabulary.segments(text):
            if special is not None:
                yield [special]
                continue
            at = 0
            while at < len(segment):
                stop = at + _CHUNK
                if stop < len(segment):
                    cut = _LAST_SPACE.search(segment, at + 1, stop)
                    further = cut or _NEXT_SPACE.search(segment, stop)
                    stop = (cut.start(1) if cut else further.start()) if further else len(segment)
                memo, one = self._memo, self.pretoken
                out: list[int] = []
                for p in self.vocabulary.pretokens(self.vocabulary.normalized(segment[at:stop])):
                    out += memo.get(p) or one(p)
                yield out
                at = stop

    def encode(self, text: str | None) -> list[int]:
        """All ids of a text; a null is an empty text."""
        return [i for chunk in self.chunks(text or "") for i in chunk]


_LAST_SPACE = regex.compile(r"(?s).*([ \t\n])")
_NEXT_SPACE = regex.compile(r"[ \t\n]")


class Decoder:
    """Ids back to text, step by step: bytes go into a UTF-8 state machine that keeps an unfinished character for the next step.

    ``plain`` gives the vocabulary's strings with a space between, which is what a file
    without a decoder prescribes. Otherwise byte symbols become bytes and the word-end
    suffix a space, which reads as text.
    """

    def __init__(self, vocabulary: Vocabulary, plain: bool = True):
        self._utf8 = codecs.getincrementaldecoder("utf-8")("replace")
        self._between = b" " if plain else b""
        self._fed = False
        if plain:
            self._bytes = {i: s.encode() for i, s in vocabulary.strings.items()}
        else:
            back = {c: bytes([b]) for b, c in byte_symbols().items()}
            self._bytes = {}
            for i, s in vocabulary.strings.items():
                body = s.removesuffix(vocabulary.suffix) if vocabulary.suffix else s
                raw = s.encode() if i in vocabulary.added.values() else b"".join(back[c] for c in body)
                self._bytes[i] = raw + (b" " if body != s else b"")

    def feed(self, ids: Sequence[int]) -> str:
        """The text that the ids complete."""
        if not ids:
            return ""
        data = (self._between if self._fed else b"") + self._between.join(map(self._bytes.__getitem__, ids))
        self._fed = True
        return self._utf8.decode(data)

    def close(self) -> str:
        """What an unfinished character at the end becomes; the decoder is then as new."""
        self._fed = False
        rest = self._utf8.decode(b"", final=True)
        self._utf8.reset()
        return rest


FIELDS = "n_tokens bigint, ids array<int>, decoded string"


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    """One encoder per file and Python worker, so that its memo outlives a task."""
    return Encoder(Vocabulary(path))


def _coder(path: str, digests: bool) -> Callable[[], Callable[[list[str | None]], dict[str, Sequence]]]:
    def make() -> Callable[[list[str | None]], dict[str, Sequence]]:
        encoder = _encoder(path)
        vocabulary = encoder.vocabulary
        decoder = Decoder(vocabulary)
        decimals = {i: str(i) for i in vocabulary.strings}.__getitem__

        def whole(texts: list[str | None]) -> dict[str, Sequence]:
            ids = [encoder.encode(t) for t in texts]
            return {"n_tokens": [len(x) for x in ids], "ids": ids, "decoded": [decoder.feed(x) + decoder.close() for x in ids]}

        def hashed(texts: list[str | None]) -> dict[str, Sequence]:
            counts, of_ids, of_text = [], [], []
            for text in texts:
                n, a, b = 0, sha256(), sha256()
                for chunk in encoder.chunks(text or ""):
                    if chunk:
                        a.update(((" " if n else "") + " ".join(map(decimals, chunk))).encode())
                        b.update(decoder.feed(chunk).encode())
                        n += len(chunk)
                b.update(decoder.close().encode())
                counts.append(n)
                of_ids.append(a.hexdigest())
                of_text.append(b.hexdigest())
            return {"n_tokens": counts, "ids_sha256": of_ids, "decoded_sha256": of_text}

        return hashed if digests else whole

    return make


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and ``decoded`` of every whole text.

    A null text is an empty one: no ids, empty text. Repeated rows give repeated
    results. ``path``: a tokenizer file that every executor can read. Only the id and the
    text are read.
    """
    return map_texts(id_and_text(docs, id_col, text_col), _coder(path, digests=False), FIELDS)


def bpe_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``bpe_round_trip``, with SHA-256 digests made chunk by chunk in place of ids and text, so that neither is ever held whole."""
    return map_texts(id_and_text(docs, id_col, text_col), _coder(path, digests=True), "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
