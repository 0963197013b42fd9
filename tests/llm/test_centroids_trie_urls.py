"""Centroid clustering, the prefix trie and URL filters against plain loops over small tables."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from foliate.errors import DataError, OptionError
from foliate.llm import centroids, prefix_trie, url_filters
from foliate.llm.url_filters import ALLOW, BLOCK, Rule, RuleIndex, judge_urls, lower_ascii, split_address

# centroids


def brute_clusters(rows, clusters=8, rounds=10, dimensions=64):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)]
    whole = [[int(np.floor(1024 * float(x))) for x in v] for _, v in kept]
    rank = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, hashlib.sha256(f"3:{kept[r][0]}".encode()).hexdigest() if kept[r][0] is not None else "", kept[r][1]))
    middle = [list(whole[r]) for r in rank[:clusters]]

    def assign():
        found = []
        for v in whole:
            apart = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in middle]
            found.append((apart.index(min(apart)), min(apart)))
        return found

    for _ in range(rounds):
        where = [k for k, _ in assign()]
        for k in set(where):
            mine = [whole[i] for i, w in enumerate(where) if w == k]
            middle[k] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    last = assign()
    sums = Counter()
    for k, d in last:
        sums[k] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return Counter((kept[i][0], k, d, sums[k], sum(sums.values()), digest[k]) for i, (k, d) in enumerate(last))


def vectors(spark, rows, kind="array<double>"):
    clashing = "cluster int, distance bigint, apex binary, vector string, n bigint"
    return spark.createDataFrame([(i, v, 1, 2, b"x", "v", 3) for i, v in rows], f"vec_id bigint, embedding {kind}, {clashing}")


@pytest.mark.parametrize("seed, spread", [(1, 0.05), (2, 1.0)])
def test_clusters_against_plain_loops(spark, seed, spread):
    rng = np.random.default_rng(seed)
    hearts = rng.normal(size=(6, 64))
    rows = [(i, (hearts[i % 6] + spread * rng.normal(size=64)).tolist()) for i in range(90)]
    rows += [(1000, rows[0][1]), (0, rows[0][1]), (0, rows[0][1]), (None, rows[3][1]), (None, rows[4][1])]
    odd = [(2000, None), (2001, []), (2002, [0.0] * 63), (2003, [0.0] * 65), (2004, [None] + [0.0] * 63), (2005, [float("nan")] * 64), (2006, [float("inf")] + [0.0] * 63), (2007, [-float("inf")] + [1.0] * 63)]
    got = centroids.cluster(vectors(spark, rows + odd))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == brute_clusters(rows + odd)


def test_single_precision_and_negative_components_round_down(spark):
    rows = [(i, [(-1) ** i * (i + 0.3) / 1024] * 64) for i in range(12)]
    single = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert Counter(tuple(r) for r in centroids.cluster(vectors(spark, rows, "array<float>")).collect()) == brute_clusters(single)


@pytest.mark.parametrize("count", [1, 2, 5])
def test_fewer_vectors_than_centroids(spark, count):
    rows = [(i, [float(i // 2)] * 64) for i in range(count)]
    assert Counter(tuple(r) for r in centroids.cluster(vectors(spark, rows)).collect()) == brute_clusters(rows)


def test_equal_vectors_and_ties_take_the_smaller_centroid(spark):
    rows = [(i, [0.0] * 64) for i in range(20)] + [(100, [1.0] * 64), (101, [-1.0] * 64)]
    assert Counter(tuple(r) for r in centroids.cluster(vectors(spark, rows)).collect()) == brute_clusters(rows)


def test_no_usable_vectors(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        got = centroids.cluster(vectors(spark, rows))
        assert got.collect() == [] and got.columns[-1] == "centroid_sha256"


def test_components_beyond_exact_distances_are_refused(spark):
    with pytest.raises(DataError):
        centroids.cluster(vectors(spark, [(1, [1e9] * 64)])).collect()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.sampled_from([1, 2, 8, 16, 40]), st.sampled_from([1, 40, 5000, 100_000_000]), st.booleans())
def test_bounds_never_lose_the_nearest(seed, pivots, size, repeated):
    rng = np.random.default_rng(seed)
    points = rng.integers(-size, size + 1, (80, 64))
    if repeated:
        points[40:] = points[:40]
    base = points[:pivots] if seed % 2 else points[:pivots] // 1000 + rng.integers(-size, size + 1, 64)
    simplex = centroids.Simplex.of(base)
    centres = points[rng.integers(0, 80, 9)]
    mask = simplex.candidates(simplex.apexes(points), simplex.apexes(centres))
    assert mask.any(axis=1).all()
    all_of = centroids.nearest(points, centres, np.ones_like(mask))
    for got, want in zip(centroids.nearest(points, centres, mask), all_of, strict=True):
        assert (got == want).all()


def test_bounds_leave_one_candidate_of_clear_clusters():
    rng = np.random.default_rng(5)
    centres = rng.integers(-500, 500, (8, 64))
    points = centres[rng.integers(0, 8, 4000)] + rng.integers(-20, 21, (4000, 64))
    simplex = centroids.Simplex.of(points[:16])
    assert simplex.candidates(simplex.apexes(points), simplex.apexes(centres)).sum() < 1.5 * len(points)


# prefix trie


def brute_trie(rows, shared=True):
    own = defaultdict(list)
    for c, at, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((at is not None, at or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16], (role, text)))
    turns = {c: [t[-1] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9 if shared else 0
        built[c] = turns.get(c - c % 5, [])[:h] + turns[c][h:]
    nodes = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            nodes[tuple(built[c][:d])].append(c)
    children = Counter(p[:-1] for p in nodes if p)
    leaves, saved = Counter(), Counter()
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members) - 1) * (len(p[-1][1].encode()) if p else 0)
    return sorted(
        (m[0], len(p), nodes[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(",".join(str(c) for c in m if len(built[c]) == len(p)).encode()).hexdigest())
        for p, m in nodes.items()
    )


def turn_rows(rng, conversations, variety):
    rows = []
    for c in conversations:
        for at in range(rng.randint(1, 12)):
            rows.append((c, at, rng.choice(["user", "assistant", None]), rng.choice(["", None, "é", "hello there", "x" * 40][:variety])))
    rng.shuffle(rows)
    return rows


def turn_frame(spark, rows):
    clashing = "key binary, n bigint, depth bigint, shard bigint, n_bytes string, parent int, ends string"
    return spark.createDataFrame([(*r, b"k", 1, 2, 3, "b", 4, "e") for r in rows], f"conv_id bigint, turn bigint, role string, text string, {clashing}")


@pytest.mark.parametrize("variety, width", [(2, 3), (5, 4), (5, 1024), (3, 1)])
def test_trie_against_plain_loops(spark, variety, width):
    rng = random.Random(variety * 7 + width)
    rows = turn_rows(rng, [*range(-12, 40), 2**63 - 1, 2**63 - 4, -(2**63), 10**12, 10**12 + 1], variety)
    rows += [(50, 0, "user", "hello there"), (50, 0, "user", "hello there"), (50, 0, "assistant", "é"), (50, None, "assistant", "last"), (None, 0, "user", "nobody's")]
    rows += [(61, 0, "user", "own turns before the shared head are dropped")]
    numbered = prefix_trie.numbered_turns(turn_frame(spark, rows))
    got = prefix_trie.prefix_trie(prefix_trie.with_shared_history(numbered), width)
    assert got.columns == "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(brute_trie(rows), key=repr)


def test_trie_of_conversations_as_they_are(spark):
    rows = turn_rows(random.Random(1), range(60), 4)
    got = prefix_trie.prefix_trie(prefix_trie.as_they_are(prefix_trie.numbered_turns(turn_frame(spark, rows))), 16)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(brute_trie(rows, shared=False), key=repr)


def test_trie_of_many_copies_and_a_long_conversation(spark):
    said = [(0, "user", "q"), (1, "assistant", "a" * 100_000)]
    rows = [(c, *t) for c in range(0, 3000, 5) for t in said] + [(7, i, "user", f"t{i}") for i in range(1500)]
    numbered = prefix_trie.numbered_turns(turn_frame(spark, rows))
    got = {(r["conv_id"], r["depth"]): r for r in prefix_trie.prefix_trie(prefix_trie.as_they_are(numbered), 64).collect()}
    assert len(got) == 3 + 1500 and got[0, 0]["n_convs"] == 601
    assert (got[0, 2]["n_convs"], got[0, 2]["saved_tokens"]) == (600, 599 * 100_000)
    assert got[0, 2]["ends_sha256"] == hashlib.sha256(",".join(map(str, range(0, 3000, 5))).encode()).hexdigest()
    assert got[0, 0]["n_leaves"] == 2 and got[7, 1500]["n_children"] == 0


def test_turnless_conversations_end_in_the_root(spark):
    c = next(c for c in range(1, 99, 5) if zlib.crc32(str(c).encode()) % 9 > 0)
    got = prefix_trie.prefix_trie(prefix_trie.with_shared_history(prefix_trie.numbered_turns(turn_frame(spark, [(c, 0, "user", "x")])))).collect()
    assert [tuple(r) for r in got] == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_trie_without_conversations(spark):
    for rows in ([], [(None, 1, "user", "x")]):
        assert prefix_trie.prefix_trie(prefix_trie.with_shared_history(prefix_trie.numbered_turns(turn_frame(spark, rows)))).collect() == []


# URL filters


def brute_fits(rule, url):
    """Whether a rule fits, without index and without atomic groups."""
    host, path, rest = split_address(url)
    if rule.host_path:
        name, slash, start = rule.text.partition("/")
        return (host == name or host.endswith("." + name)) and path.startswith(slash + start)
    address, text = lower_ascii(host + path + rest), lower_ascii(rule.text)
    if not address:
        return False
    starts = [0]
    if text.startswith("||"):
        text, starts = text[2:], [0] + [m.end() for m in re.finditer(r"\.", host)]
    elif text.startswith("|"):
        text = text[1:]
    else:
        text = "*" + text
    text = text[:-1] if text.endswith("|") else text + "*"
    spots = set(starts)
    for c in text:
        if c == "*":
            spots = set(range(min(spots), len(address) + 1)) if spots else spots
        elif c == "^":
            ok = lambda a: not re.match(r"[0-9A-Za-z_.%\x80-\U0010FFFF-]", a)
            spots = {i + 1 for i in spots if i < len(address) and ok(address[i])} | ({len(address)} & spots)
        else:
            spots = {i + 1 for i in spots if i < len(address) and address[i] == c}
    return len(address) in spots


def brute_verdict(rules, url, default=ALLOW):
    fits = [r for r in rules if brute_fits(r, url)]
    hosts = [r for r in fits if r.host_path]
    for group in (hosts, [r for r in fits if not r.host_path and r.action == ALLOW], [r for r in fits if not r.host_path]):
        if group:
            best = min(group, key=lambda r: (-len(r.text), r.text, r.action))
            return (best.text, None, best.action) if best.host_path else (None, best.text, best.action)
    return None, None, default


ODD_URLS = [
    None, "", "no scheme.net/", "://", "http://", "http://net", "http://net/", "http://NET/x", "http://a.net?x=/net/", "http://xnet/", "http://x.org/fr", "http://x.org/fr/", "https://a.example.NET/en/#t",
    "http://example.com/de/a?b", "http://example.com/DE/", "http://a.com/Login", "http://a.com/login-help", "http://ads.a.com/", "http://x.ads.a.com", "http://badads.a.com", "http://u@a.net:80/x",
    "http://docs.a.com/search", "http://a.com/search/x?q=1", "http://a.com/f.ZIP", "http://a.com/f.zip?x", "http://a.com/f\n.zip", "ftp://a://b.net/", "http://é.net/en/", "http://a.com/ſearch?q=\u212a",
]


def test_verdicts_against_a_plain_list(spark):
    urls = [(i, u, "r", "v", "h") for i, u in enumerate(ODD_URLS + ODD_URLS[5:9])] + [(None, "http://a.net/", "r", "v", "h")]
    pages = spark.createDataFrame(urls, "page_id bigint, url string, rule string, verdict string, host string")
    for block_bytes in (1 << 20, 20):
        got = judge_urls(pages, url_filters.RULES, block_bytes=block_bytes).collect()
        assert len(got) == len(urls)
        for r in got:
            url = "http://a.net/" if r["page_id"] is None else urls[r["page_id"]][1]
            assert (r["rule"], r["pattern"], r["verdict"]) == brute_verdict(url_filters.RULES, url), url
            assert (r["host"], r["path"]) == split_address(url)[:2]


def test_default_and_empty_lists_and_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.net/"), (2, None)], "page_id bigint, url string")
    assert [r["verdict"] for r in judge_urls(pages, [], default=BLOCK).collect()] == [BLOCK, BLOCK]
    assert judge_urls(pages.limit(0), url_filters.RULES).collect() == []


_TEXT = st.text(alphabet="ab.-/^*|=é1", min_size=1, max_size=9)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(_TEXT, _TEXT.map(lambda t: "||" + t), _TEXT.map(lambda t: "|" + t + "|")), st.sampled_from([ALLOW, BLOCK])), max_size=8), st.lists(st.text(alphabet="ab.-/?#=é1AB", max_size=14), max_size=8), st.dictionaries(st.sampled_from(["a", "b", "ab", "1"]), st.integers(0, 9)))
def test_an_index_finds_what_a_plain_list_finds(texts, addresses, counts):
    rules = []
    for text, action in texts:
        try:
            rules.append(Rule(text, action))
        except OptionError:
            pass
    rules = sorted(set(rules), key=Rule.strength)
    index = RuleIndex(rules, counts)
    for address in addresses:
        url = "http://" + address
        host, path, rest = split_address(url)
        if host + path + rest:
            found, _ = index.decide(host + path + rest, lower_ascii(host + path + rest))
            assert brute_verdict(rules, url) == ((None, found.text, found.action) if found else (None, None, ALLOW))


def test_only_candidates_are_tried(spark):
    rules = [Rule(f"^word{i}^") for i in range(500)] + [Rule(f"^page^*^word{i}^") for i in range(500)]
    pages = spark.createDataFrame([(i, f"http://a.net/page/{i}/word{i}") for i in range(50)], "page_id bigint, url string")
    got = judge_urls(pages, rules).collect()
    assert all(r["verdict"] == BLOCK and r["tried"] <= 2 for r in got)


def test_long_addresses_take_linear_time():
    index = RuleIndex([Rule("||ads.*^x*y*z|"), Rule("a*b*c*d*^e^"), Rule("ads.net/never", BLOCK, True)], {})
    for address in ("ads." * 100_000, "abc" * 100_000 + "/", "ads.x/" + "yyyz!" * 60_000):
        start = time.perf_counter()
        index.decide(address, address)
        assert time.perf_counter() - start < 2


@pytest.mark.parametrize("text, host_path", [("", False), ("*", False), ("||", False), ("/en/", True), ("a.net/?x", True)])
def test_rules_that_mean_nothing_are_refused(text, host_path):
    with pytest.raises(OptionError):
        Rule(text, BLOCK, host_path)
