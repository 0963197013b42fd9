"""URL filters: pattern rules that are found through their rarest literal token.

A rule whose pattern holds ``casino`` between two separators can only fit an address with
the token ``casino``. Of the tokens a rule is sure of, the one that the addresses hold
least often is its key; the tokens of an address fetch the rules under those keys, and
only the regular expressions of these are run. Rules without a sure token have the key
``""``, which every address fetches.

Rules are ordered once, strongest first, so an address stops at the first candidate that
fits. A list goes to the tasks in blocks of a bounded size; an address that a block
decided is left alone by the weaker blocks behind it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.errors import OptionError

ALLOW, BLOCK = "allow", "block"
#: The most text of rules that goes to the tasks at once.
BLOCK_BYTES = 8 << 20

_TOKEN = re.compile(r"[0-9a-z\x80-\U0010FFFF]+")
_PIECE = re.compile(r"[0-9a-z\x80-\U0010FFFF]+|.", re.DOTALL)
#: Fixed by the pattern syntax: ``^`` stands for one character that is none of these, or for the end.
_SEPARATOR = r"(?:[^0-9A-Za-z_.%\x80-\U0010FFFF-]|\Z)"
_SUBDOMAINS = r"(?:[^/?#.]*\.)*?"
_ADDRESS = re.compile(r"(.*?)://([^/?#]*)([^?#]*)(.*)", re.DOTALL)


def lower_ascii(text: str) -> str:
    """A-Z in lower case, every other character as it is."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


@dataclass(frozen=True)
class Rule:
    """One rule of a list.

    With ``host_path`` the text is a host and, from the first ``/``, the start of a path: it
    fits the host and its subdomains, and paths that start with the rule's, case as written.

    Otherwise the text is a pattern over the address behind ``://``, without regard to the case
    of A-Z: ``*`` is any run of characters, ``^`` a separator or the end, ``|`` at either end
    holds the pattern to that end, and ``||`` in front lets it start at a host or below it.
    """

    text: str
    action: str = BLOCK
    host_path: bool = False
    regex: re.Pattern = field(init=False, repr=False, compare=False)
    tokens: tuple[str, ...] = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        if self.action not in (ALLOW, BLOCK):
            raise OptionError(f"a rule allows or blocks, not {self.action!r}")
        source, sure = _host_path(self.text) if self.host_path else _pattern(self.text)
        object.__setattr__(self, "regex", re.compile(source, re.DOTALL))
        object.__setattr__(self, "tokens", sure)

    def strength(self) -> tuple:
        """Sorts the strongest rule first: host and path before patterns; the longer text; of patterns those that allow."""
        patterns = (self.action == BLOCK,) if not self.host_path else ()
        return (not self.host_path, *patterns, -len(self.text), self.text, self.action)


def _host_path(text: str) -> tuple[str, tuple[str, ...]]:
    host, slash, rest = text.partition("/")
    if not host or re.search(r"[?#]", text):
        raise OptionError(f"not a host and a path: {text!r}")
    host, path = lower_ascii(host), slash + rest
    source = _SUBDOMAINS + re.escape(host) + (re.escape(path) if path else r"(?=[/?#]|\Z)")
    # The host ends where a token ends; the last token of the path may go on in an address.
    return source, _sure_tokens("." + host + (lower_ascii(path) or "/"))


def _pattern(text: str) -> tuple[str, tuple[str, ...]]:
    body = lower_ascii(text)
    below, body = body.startswith("||"), body.removeprefix("||")
    first, body = not below and body.startswith("|"), body.removeprefix("|") if not below else body
    last, body = body.endswith("|"), body.removesuffix("|")
    if not body.strip("*"):
        raise OptionError(f"a pattern without a character: {text!r}")
    pieces = body.split("*")
    source, sure = [], []
    for i, piece in enumerate(pieces):
        held, ends = i == 0 and (below or first), i == len(pieces) - 1 and last
        made = "".join(_SEPARATOR if c == "^" else re.escape(c) for c in piece)
        before = (_SUBDOMAINS if below else "") if held else ".*" if ends else ".*?"
        # The first place where a piece fits leaves the most for the next ones, so it is never taken back.
        source.append(rf"{before}{made}\Z" if ends else f"(?>{before}{made})")
        sure += _sure_tokens(("^" if held else "") + piece + ("^" if ends else ""))
    return "".join(source), tuple(dict.fromkeys(sure))


def _sure_tokens(text: str) -> tuple[str, ...]:
    """The tokens of a literal text that are bounded on both sides inside it."""
    pieces = _PIECE.findall(text)
    return tuple(dict.fromkeys(p for p in pieces[1:-1] if _TOKEN.fullmatch(p)))


def split_address(url: str | None) -> tuple[str, str, str]:
    """Host (A-Z in lower case), path, and what follows the path; all empty without ``://``."""
    found = _ADDRESS.match(url or "")
    if found is None:
        return "", "", ""
    return lower_ascii(found[2]), found[3], found[4]


class RuleIndex:
    """Rules under their keys. ``counts`` says how many addresses hold a token."""

    def __init__(self, rules: Sequence[Rule], counts: dict[str, int]) -> None:
        self.rules = rules
        self.by_token: dict[str, list[int]] = {}
        for i, rule in enumerate(rules):
            self.by_token.setdefault(min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default=""), []).append(i)

    def candidates(self, lowered: str) -> list[int]:
        found = list(self.by_token.get("", ()))
        for token in set(_TOKEN.findall(lowered)):
            found += self.by_token.get(token, ())
        return sorted(found)

    def decide(self, address: str, lowered: str) -> tuple[Rule | None, int]:
        """The strongest rule that fits, and how many regular expressions were run."""
        tried = 0
        for i in self.candidates(lowered):
            rule = self.rules[i]
            tried += 1
            if rule.regex.match(address if rule.host_path else lowered):
                return rule, tried
        return None, tried


def token_counts(urls: DataFrame, wanted: frozenset[str]) -> dict[str, int]:
    """How many rows of the column ``url`` hold each token. One row per token and batch is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[str] = Counter()
            for url in batch.column("url").to_pylist():
                counts.update(wanted.intersection(_TOKEN.findall(lower_ascii("".join(split_address(url))))))
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["token", "n"])

    counted = urls.select(F.col("url").cast("string").alias("url")).mapInArrow(run, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    return {r["token"]: r["n"] for r in counted.toLocalIterator()}


def rule_blocks(rules: Sequence[Rule], block_bytes: int = BLOCK_BYTES) -> list[list[Rule]]:
    """The rules, strongest first, in runs whose texts hold at most ``block_bytes``, one rule at least."""
    blocks: list[list[Rule]] = []
    size = block_bytes
    for rule in sorted(set(rules), key=Rule.strength):
        own = len(rule.text.encode("utf-8", "surrogatepass"))
        if not blocks or size + own > block_bytes:
            blocks.append([])
            size = 0
        blocks[-1].append(rule)
        size += own
    return blocks


_OUT = "host string, path string, rule string, pattern string, verdict string, tried bigint"


def judge_urls(urls: DataFrame, rules: Sequence[Rule], default: str = ALLOW, id_col: str = "page_id", url_col: str = "url", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each row's ``host``, ``path``, deciding ``rule`` or ``pattern`` (else null), ``verdict``, and how many expressions were ``tried``.

    The longest rule of host and path that fits decides; without one a pattern that allows,
    then one that blocks, the longer first; without one ``default``. Rows stay where they
    are, so it doesn't matter how many of them share a host. Null addresses and those without
    ``://`` have an empty host and path, and only the default. Repeated rows and null ids
    are judged like all others; other columns are not read; an empty table or an empty list is
    fine. Addresses of any length are read whole, by each expression in time linear in them.
    """
    if default not in (ALLOW, BLOCK):
        raise OptionError(f"the default is to allow or to block, not {default!r}")
    own = urls.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    out = own.select("page_id", "url", *(F.lit(None).cast(kind).alias(name) for name, kind in (f.split() for f in _OUT.split(", "))))
    schema = out.schema
    for block in rule_blocks(rules, block_bytes) or [[]]:
        wanted = frozenset(t for r in block for t in r.tokens)
        out = out.mapInArrow(_judge(block, token_counts(own, wanted) if wanted else {}), schema)
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"), "pattern", "tried")


def _judge(block: Sequence[Rule], counts: dict[str, int]):
    listed = [(r.text, r.action, r.host_path) for r in block]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = RuleIndex([Rule(*r) for r in listed], counts)
        for batch in batches:
            rows = []
            urls, verdicts = batch.column("url").to_pylist(), batch.column("verdict").to_pylist()
            before = zip(*(batch.column(c).to_pylist() for c in ("rule", "pattern", "tried")), strict=True)
            for url, verdict, (by_rule, by_pattern, tried) in zip(urls, verdicts, before, strict=True):
                host, path, rest = split_address(url)
                if verdict is None and (host or path or rest):
                    address = host + path + rest
                    found, more = index.decide(address, lower_ascii(address))
                    tried = (tried or 0) + more
                    if found is not None:
                        verdict = found.action
                        by_rule, by_pattern = (found.text, None) if found.host_path else (None, found.text)
                rows.append((host, path, by_rule, by_pattern, verdict, tried or 0))
            made = list(zip(*rows, strict=True)) or [()] * 6
            new = batch.schema
            columns = [pa.array(c, new.field(i + 2).type) for i, c in enumerate(made)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], schema=new)

    return run


#: The host and path rules of the query.
HOST_RULES = (
    Rule("net/", BLOCK, True),
    Rule("example.net/en/", ALLOW, True),
    Rule("example.com/de/", BLOCK, True),
    Rule("org/fr/", ALLOW, True),
)

#: What else the query blocks: pages without prose, and kinds of sites that don't belong in a training corpus.
PAGE_PATTERNS = tuple(
    [Rule(t, BLOCK) for t in "^login^ ^signin^ ^sign-in^ ^signup^ ^register^ ^logout^ ^password-reset^ ^cart^ ^basket^ ^checkout^ ^wp-admin^ ^wp-login.php^ ^cgi-bin^ ^xmlrpc.php^".split()]
    + [Rule(t, BLOCK) for t in "^search^*^q= ^tag^*^feed^ ^calendar^*^month= ^sessionid= ^phpsessid= ^replytocom= ^print=1^ ^share=* .xml| .zip| .exe|".split()]
    + [Rule(t, BLOCK) for t in "||ads. ||adserver. ||doubleclick.*^ ^casino^ ^gambling^ ^porn^ ^xxx^ ^escort^ ^warez^ ^torrent^".split()]
    + [Rule(t, ALLOW) for t in "||docs.*^search^ ^help^*^login^ ^library^*^register^".split()]
)
RULES = HOST_RULES + PAGE_PATTERNS
