"""The training-data operators against brute force, on small tables with nulls, empties, ties, repeats and clashing columns."""

import base64
import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from foliate.errors import OptionError
from foliate.llm import bpe, chat, decontaminate, html_extract, language_id, line_dedup, near_dup, quality, simhash, token_counts, toxicity
from foliate.llm.graph import components

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SYLLABLES = "ka lo mi ner tos ul ve win xa yor zed qui".split()
#: Columns that carry names of results, to be ignored or passed through.
CLASHING = "n_words bigint, kept boolean, score double, fingerprint string, component_id bigint, n_tokens bigint, ids string, key string, p bigint, base bigint"


def prose(rng, words):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(words))


def table(spark, texts, ids=None, clashing=True):
    ids = range(len(texts)) if ids is None else ids
    extra = (7, True, 0.5, "f", 9, 3, "i", "k", 1, 2) if clashing else ()
    rows = [(i, t, *extra) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, "doc_id bigint, text string" + (f", {CLASHING}" if clashing else ""))


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(3)
    long_text = "\n".join(prose(rng, 40) for _ in range(200))
    return [None, "", "   \n\t ", "one", long_text, prose(rng, 60), "a b c d e " * 30, "x\xa0y #z|\n\nline\nline\n line\nline", prose(rng, 60)]


# quality


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    inside = {j for i, w in enumerate(windows) if w in often for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed


def test_quality_counts_and_verdict(spark, odd_texts):
    got = by_id(quality.quality_rules(table(spark, odd_texts)))
    for i, text in enumerate(odd_texts):
        r = got[i]
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == brute_quality(text)
    assert [got[i]["kept"] for i in range(len(odd_texts))] == [False, False, False, False, True, True, False, False, True]


def test_compression_bands():
    check = quality.compression_check(quality.CompressionRules())
    rng = random.Random(5)
    noise = base64.b64encode(random.Random(1).randbytes(9000)).decode()
    assert check(prose(rng, 900).encode())[3] is None
    assert check(b"the same words again and again " * 200)[3] == "repetitive"
    assert check(noise.encode())[3] == "incompressible"
    # A third of the chunks repeats itself while the whole stays inside its band.
    mixed = " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(3000)) + " so it goes" * 700
    ratio, n, bad, why = check(mixed.encode())
    assert why == "chunks" and bad > 0.2 * n and ratio > 0.26
    assert check(b"") == (0.0, 0, 0, None)


@pytest.mark.parametrize("size, chunks", [(3071, 0), (3072, 2), (4095, 2), (4096, 2)])
def test_chunks_are_tested_wherever_there_are_two(size, chunks):
    rng = np.random.default_rng(1)
    raw = rng.bytes(size // 2) + b"ab" * size
    ratio, n, bad, why = quality.compression_check(quality.CompressionRules())(raw[:size])
    assert n == chunks and (bad > 0, why) == ((True, "chunks") if chunks else (False, None))


def test_keep_good_keeps_all_columns(spark, odd_texts):
    docs = table(spark, odd_texts)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [4, 5, 8]


# toxicity


def test_nnpu_separates_toxic_from_clean(spark):
    rng = random.Random(7)
    bad = ["grobnik", "vlakshu", "tromber"]
    texts, toxic = [], []
    for i in range(900):
        words = prose(rng, rng.randint(10, 80)).split()
        is_bad = i % 6 == 0
        if is_bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        texts.append(" ".join(words))
        toxic.append(int(is_bad))
    docs = table(spark, [*texts, None, ""])
    labels = spark.createDataFrame([(i, t) for i, t in enumerate(toxic)] + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    model = toxicity.train_toxicity(docs, labels)
    got = by_id(toxicity.toxicity(docs, model))
    held = [i for i in range(900) if got[i]["held_out"]]
    assert 200 < len(held) < 400
    right = sum(got[i]["predicted"] == toxic[i] for i in held)
    assert right >= 0.98 * len(held)
    assert got[900]["predicted"] == got[901]["predicted"] == 0 and 0 <= got[901]["score"] <= 1


def test_toxicity_without_examples(spark):
    docs = table(spark, ["some text", None])
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    got = toxicity.toxicity(docs, toxicity.train_toxicity(docs, labels)).collect()
    assert len(got) == 2 and all(r["score"] < 0.01 for r in got)


def test_near_copies_share_a_sketch():
    rng = random.Random(21)
    a, b = prose(rng, 300), prose(rng, 300)
    words = a.split()
    words[40] = "other"
    texts = [a, " ".join(words), b, "short", "", None, a]
    first = toxicity.first_of_copies(toxicity.document_features(texts)["sketches"])
    assert first == [True, False, True, True, True, False, False]


def test_negative_risk_is_not_driven_below_zero():
    positive, unlabelled = [np.array([1, 2], np.uint32)] * 20, [np.array([1, 2], np.uint32)] * 2 + [np.array([3], np.uint32)] * 18
    model = toxicity.fit_nnpu(positive, unlabelled, 0.1, toxicity.PuParameters(min_z=1.0))
    scale = 1 / (1 + np.exp(-(model.intercept + model.weights.sum())))
    assert scale > 0.7 and 1 / (1 + np.exp(-model.intercept)) < 0.3


# SimHash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, threshold=4):
    label = {f: f for f in fps}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in label:
        for b in label:
            if (a ^ b).bit_count() <= threshold:
                label[find(a)] = find(b)
    return {f: find(f) for f in label}


def test_simhash_against_all_pairs(spark, odd_texts):
    rng = random.Random(11)
    base = prose(rng, 300).split()
    near = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(SYLLABLES)
        near.append(" ".join(words).upper() if i % 7 == 0 else " ".join(words))
    texts = [*odd_texts, *near, *(prose(rng, 50) for _ in range(100)), near[3], near[3]]
    got = by_id(simhash.simhash_components(table(spark, texts)))
    fps = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    roots = brute_components(set(fps.values()))
    least = {}
    for i, f in fps.items():
        least[roots[f]] = min(i, least.get(roots[f], i))
    for i, f in fps.items():
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (f"{f:016x}", least[roots[f]])


@pytest.mark.parametrize("flips", [1, 2, 3, 4])
def test_anchors_miss_no_link(flips):
    rng = np.random.default_rng(flips)
    for _ in range(300):
        x = rng.integers(0, 1 << 63, dtype=np.uint64)
        y = x
        for bit in rng.choice(64, flips, replace=False):
            y ^= np.uint64(1) << np.uint64(bit)
        owner, keys = simhash.anchors(np.array([x, y]))
        assert set(keys[owner == 0]) & set(keys[owner == 1])


def test_homes_are_within_the_covering_radius():
    distance = np.bitwise_count(simhash.HOMES ^ np.arange(1 << 15))
    assert distance.max() == 1 and len(np.unique(simhash.HOMES)) == 1 << 11


def test_large_groups_agree_with_small_ones(monkeypatch):
    rng = np.random.default_rng(0)
    centres = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    fps = np.unique(np.array([centres[i % 5] ^ (np.uint64(1) << np.uint64(rng.integers(64))) ^ (np.uint64(1) << np.uint64(rng.integers(64))) for i in range(240)]))
    keys = np.zeros(len(fps), np.int64)

    def parts():
        u, v = simhash.links_of_groups(keys, fps, 4)
        label = {int(f): int(f) for f in fps}
        for a, b in zip(u.tolist(), v.tolist(), strict=True):
            ra, rb = a, b
            while label[ra] != ra:
                ra = label[ra]
            while label[rb] != rb:
                rb = label[rb]
            label[ra] = rb
        roots = defaultdict(set)
        for f in label:
            r = f
            while label[r] != r:
                r = label[r]
            roots[r].add(f)
        return sorted(map(sorted, roots.values()))

    shifted = parts()
    monkeypatch.setattr(simhash, "SHIFTED", 8)
    assert parts() == shifted
    brute = defaultdict(set)
    for f, r in brute_components({int(f) for f in fps}).items():
        brute[r].add(f)
    assert shifted == sorted(map(sorted, brute.values()))


def test_one_document_per_component_stays(spark):
    rng = random.Random(2)
    a, b = prose(rng, 80), prose(rng, 80)
    docs = table(spark, [a, b, a, a, b, None, None], ids=[5, 6, 3, 3, None, None, None])
    kept = simhash.keep_one_per_component(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"] or -1), r["text"] or "") for r in kept.collect()) == sorted([(3, a), (6, b), (-1, "")])


def test_simhash_refuses_wider_thresholds_and_takes_empty_tables(spark):
    with pytest.raises(OptionError):
        simhash.simhash_components(table(spark, ["a b"]), threshold=5)
    assert simhash.simhash_components(table(spark, [])).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}


# near-duplicates of the pipeline


def edited(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = prose(rng, 1)
    return " ".join(words)


def brute_kept(texts):
    """The smallest index of each component of texts whose sets of five words have a similarity of 0.8 or more."""
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return sorted(set(label))


def test_pipeline_links_similar_texts_of_distant_fingerprints(spark):
    rng = random.Random(11)
    texts = []
    while len(texts) < 40:
        a = prose(rng, 120)
        b = edited(rng, a, 2)
        if np.bitwise_count(np.bitwise_xor(*simhash.fingerprints([a, b]))) > simhash.THRESHOLD:
            texts += [a, b]
    docs = table(spark, texts)
    kept = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert kept == brute_kept(texts) == list(range(0, 40, 2))


@pytest.mark.parametrize("block_hashes", [700, 4 << 20])
def test_shingle_components_against_all_pairs(spark, odd_texts, block_hashes):
    rng = random.Random(5)
    base = prose(rng, 150)
    # Copies of copies of one text: many meet, and not all are linked.
    texts = [base]
    for _ in range(60):
        texts.append(edited(rng, rng.choice(texts), rng.randint(1, 6)))
    texts += [*odd_texts, "One TWO three", "one two three", "one two", *(edited(rng, prose(rng, 40), 0) for _ in range(5))]
    kept = near_dup.keep_one_per_component(table(spark, texts), block_hashes=block_hashes)
    assert sorted(r["doc_id"] for r in kept.collect()) == brute_kept(texts)


def test_a_large_group_is_compared_within_its_components(monkeypatch):
    rng = random.Random(9)
    base = prose(rng, 120)
    sets = [near_dup.shingles(edited(rng, base, rng.randint(1, 8))) for _ in range(800)]
    compared = []
    exact = near_dup.shared
    monkeypatch.setattr(near_dup, "shared", lambda one, others: compared.append(len(others)) or exact(one, others))
    links = near_dup.forest_links(sets, np.zeros(800, bool), 0.8)
    forest = near_dup.Forest(800)
    assert all(forest.link(a, b) for a, b in links)
    near = [(a, b) for a in range(800) for b in range(a) if len(np.intersect1d(sets[a], sets[b], assume_unique=True)) >= 0.8 * len(np.union1d(sets[a], sets[b]))]
    assert near and all(forest.label[a] == forest.label[b] for a, b in near)
    assert sum(compared) < 60 * 800


def test_texts_of_near_fingerprints_meet_without_a_band(spark, monkeypatch):
    rng = random.Random(3)
    base = prose(rng, 400)
    texts = [base, edited(rng, base, 1), prose(rng, 400)]
    fps = simhash.fingerprints(texts)
    assert np.bitwise_count(fps[0] ^ fps[1]) <= simhash.THRESHOLD < np.bitwise_count(fps[0] ^ fps[2])
    rows = [((False, i, i), i + 1, [], int(fp)) for i, fp in enumerate(fps.view(np.int64))]
    prints = spark.createDataFrame(rows, "key struct<none: boolean, id: bigint, row: bigint>, node bigint, bands array<bigint>, fp bigint")
    assert sorted(map(tuple, near_dup._clouds(prints, near_dup._nodes(prints)).collect())) == [(1, 1), (2, 1)]
    sets = [near_dup.shingles(t) for t in texts]
    monkeypatch.setattr(near_dup, "band_keys", lambda of: np.arange(len(of) * near_dup.BANDS, dtype=np.uint64).reshape(len(of), -1))
    assert near_dup.forest_links(sets, np.zeros(3, bool), 0.8) == []
    assert near_dup.forest_links(sets, np.zeros(3, bool), 0.8, fps) == [(0, 1)]
    # Near fingerprints alone don't link.
    assert near_dup.forest_links(sets, np.zeros(3, bool), 0.8, np.zeros(3, np.uint64)) == [(0, 1)]


def test_one_document_of_similar_ones_stays(spark):
    rng = random.Random(2)
    a, b = prose(rng, 80), prose(rng, 80)
    docs = table(spark, [a, b, a, a, b, None, None], ids=[5, 6, 3, 3, None, None, None])
    kept = near_dup.keep_one_per_component(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"] or -1), r["text"] or "") for r in kept.collect()) == sorted([(3, a), (6, b), (-1, "")])
    assert near_dup.keep_one_per_component(table(spark, [])).collect() == []


# token counts


def test_limit_table_against_brute_force(spark, odd_texts):
    import tiktoken

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    texts = [*odd_texts, *(prose(rng, rng.randint(1, 900)) for _ in range(60))]
    lengths = [len(encoding.encode_ordinary(t or "")) for t in texts]
    histogram = token_counts.length_histogram(token_counts.encoded_lengths(table(spark, texts), RANKS))
    got = {r["context_limit"]: r for r in token_counts.limit_table(histogram).collect()}
    assert set(got) == set(lengths)

    def answers(limit):
        return sum(n > limit for n in lengths), sum(min(n, limit) for n in lengths), sum(lengths)

    for limit, r in got.items():
        assert (r["docs_over"], r["tokens_truncated"], r["tokens_total"]) == answers(limit)
        assert r["docs"] == lengths.count(limit) and r["tokens_lost"] == sum(lengths) - r["tokens_truncated"]
        assert r["share_at_most"] == pytest.approx(sum(n <= limit for n in lengths) / len(lengths))
    for r in token_counts.at_limits(histogram, [0, 17, 512, 10**6]).collect():
        assert (r["docs_over"], r["tokens_truncated"], r["tokens_total"]) == answers(r["context_limit"])
    for r in token_counts.quantiles(histogram, [0.1, 0.5, 1.0]).collect():
        assert r["n_tokens"] == sorted(lengths)[max(0, int(np.ceil(r["share"] * len(lengths) - 1e-9)) - 1)]
    assert token_counts.limit_table(histogram.where("false")).collect() == []


# BPE


@pytest.fixture(scope="module")
def coder():
    vocabulary = bpe.Vocabulary(WORD_BPE)
    known = Tokenizer.from_file(WORD_BPE)
    known.no_truncation()
    known.no_padding()
    return bpe.Encoder(vocabulary), bpe.Decoder(vocabulary), known


PIECES = ["a", "the", "ing", "<|endoftext|>", "<|startoftext|>", " ", "\n", " ", "\u0085", "\x1c", "\x00", "É", "é", "́", "İ", "Σ", "ß", "²", "1", "'s", "'ll", "!!", "你", "🙂", "한", "​", "　", "ﬁ", "Å", "ñ"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=30).map("".join))
def test_bpe_agrees_with_the_library(coder, text):
    encoder, decoder, known = coder
    ids = known.encode(text, add_special_tokens=False).ids
    assert encoder.encode(text) == ids
    assert decoder.feed(ids) + decoder.close() == known.decode(ids, skip_special_tokens=False)


def test_long_runs_are_streamed_in_bounded_memory(coder):
    encoder, _, known = coder
    rng = random.Random(4)
    most = 0

    class Watched(bpe.Vocabulary):
        def merged(self, symbols):
            nonlocal most
            most = max(most, len(symbols))
            return super().merged(symbols)

    watched = bpe.Encoder(Watched(WORD_BPE))
    for text in ("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20000)), "a" * 5000, "ha" * 4000 + "é" * 900, "thethethe" * 600):
        assert watched.encode(text) == known.encode(text, add_special_tokens=False).ids
    assert most <= watched.vocabulary.lookahead + bpe.STEP + 1
    text = "some words here " * 20000
    assert encoder.encode(text) == known.encode(text, add_special_tokens=False).ids


def test_decoder_keeps_unfinished_characters(coder):
    encoder, _, _ = coder
    readable = bpe.Decoder(encoder.vocabulary, plain=False)
    ids = encoder.encode("déjà vu 🙂 你好")
    assert "".join(readable.feed([i]) for i in ids) + readable.close() == "déjà vu 🙂 你好 "


def test_bpe_query_digests(spark, odd_texts, coder):
    known = coder[2]
    got = by_id(bpe.bpe_digests(table(spark, odd_texts), WORD_BPE))
    whole = by_id(bpe.bpe_round_trip(table(spark, odd_texts), WORD_BPE))
    for i, text in enumerate(odd_texts):
        ids = known.encode(text or "", add_special_tokens=False).ids
        decoded = known.decode(ids, skip_special_tokens=False)
        assert (got[i]["n_tokens"], got[i]["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert got[i]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
        assert (whole[i]["ids"], whole[i]["decoded"]) == (ids, decoded)


# line dedup


def brute_lines(docs, least):
    """The text each document keeps: a line goes if a run of ``least`` words around it stands earlier. Tries every run."""
    lines = {d: [x for x in (t or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")] for d, t in docs}
    gone, seen = defaultdict(set), {}
    for d in sorted(lines):
        of = lines[d]
        for s in range(len(of)):
            for e in range(s + 1, len(of) + 1):
                if sum(len(x.encode().split()) for x in of[s:e]) >= least:
                    run = tuple(of[s:e])
                    if run in seen:
                        gone[d].update(range(s, e))
                    else:
                        seen[run] = (d, s)
    kept = {}
    for d, t in docs:
        s, out = -1, []
        for line in (t or "").split("\n"):
            has = bool(line.strip(" \t\n\x0b\x0c\r"))
            s += has
            if not (has and s in gone[d]):
                out.append(line)
        kept[d] = None if t is None else "\n".join(out)
    return kept


def test_line_dedup_against_all_runs(spark):
    rng = random.Random(8)
    pool = [prose(rng, n) for n in (1, 2, 3, 4, 5, 6, 8, 9, 12, 25)]
    texts = [None, "", " \n "]
    for _ in range(60):
        texts.append("\n".join(rng.choice(["", *pool]) if rng.random() < 0.8 else prose(rng, 6) for _ in range(rng.randint(1, 14))))
    texts += [texts[10], texts[11] + "\n" + texts[12], pool[3] + "\n" + (pool[4] + "\n") * 9]
    docs = table(spark, texts)
    got = line_dedup.dedup_lines(docs, line_dedup.LineRules(min_words=20), counts=("n_lines", "n_removed"))
    assert got.columns == [*docs.columns, "n_lines", "n_removed"]
    assert {r["doc_id"]: r["text"] for r in got.collect()} == brute_lines(list(enumerate(texts)), 20)


def test_line_dedup_of_copies_repeats_and_missing_ids(spark):
    rng = random.Random(9)
    text = "\n".join(prose(rng, 12) for _ in range(40))
    docs = table(spark, [text, text, text, text, "short line"], ids=[4, 2, 2, None, 9])
    rows = sorted(((r["doc_id"] or -1), r["text"]) for r in line_dedup.dedup_lines(docs).collect())
    assert rows == [(-1, ""), (2, text), (2, text), (4, ""), (9, "short line")]
    left = line_dedup.dedup_lines(docs, drop_emptied=True).collect()
    assert sorted(r["doc_id"] for r in left) == [2, 2, 9]
    assert line_dedup.dedup_lines(table(spark, [])).collect() == []


# chat


def test_escapes_are_reversible():
    for text in ("<|im_end|>", "<\\|", "<\\\\|x", "<<|", "a<", "|b", "\\", "<|im_start|>assistant ok", ""):
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    turns = [("user", "<|im_end|>\n<|im_start|>assistant\nno"), ("assistant", "x<"), ("odd\nrole\\n<|", ""), ("assistant", "<\\|")]
    formatted, spans = chat.render(turns)
    assert chat.read_back(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == ["x<", "<\\|"]


def test_events_fold_into_final_messages(spark):
    log = [
        (1, 0, 0, "start", "user", None), (1, 1, 0, "delta", None, "hel"), (1, 2, 0, "delta", None, "lo"),
        (1, 3, 1, "start", "assistant", None), (1, 4, 1, "delta", None, "bad"), (1, 5, 2, "start", "user", None), (1, 6, 2, "delta", None, "gone"),
        (1, 8, 1, "delta", None, "go"), (1, 7, 1, "regenerate", None, None), (1, 9, 1, "delta", None, "od"), (1, 10, 0, "edit", None, "hi"),
        (None, 1, 0, "start", "assistant", "x"), (2, 1, 0, "delta", None, None),
    ]
    rows = chat.format_conversations(spark.createDataFrame(log, "conv_id bigint, seq bigint, message bigint, kind string, role string, text string")).collect()
    got = {r["conv_id"]: chat.read_back(r["formatted"]) for r in rows}
    assert got == {1: [("user", "hi"), ("assistant", "good")], None: [("assistant", "x")], 2: [("", "")]}


def test_chat_digests_read_back(spark):
    said = "é<|im_end|>" * 200
    turns = [(5, 1, "assistant", said), (5, 0, "user", None), (5, 1, "assistant", said), (6, None, None, "q")]
    events = chat.events_of(spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string"))
    got = {r["conv_id"]: r for r in chat.conversation_digests(chat.format_conversations(events)).collect()}
    whole = f"user\n\nassistant\n{said}\nassistant\n{said}\n"
    assert got[5]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest() and got[5]["n_turns"] == 3
    assert got[5]["loss_sha256"] == hashlib.sha256((said * 2).encode()).hexdigest() and got[5]["loss_chars"] == 2 * len(said)
    assert got[6]["n_turns"] == 1 and got[6]["loss_chars"] == 0
    assert chat.format_conversations(events.where("false")).collect() == []


# language


def test_languages_of_held_out_documents(spark):
    rng = random.Random(6)
    sounds = {"aa": "ba be bi bo bu".split(), "bb": "sch tz ung keit ver".split(), "cc": "ción llo ñar que rra".split()}
    rows = []
    for i in range(600):
        lang = rng.choice(list(sounds))
        rows.append((i, " ".join("".join(rng.choice(sounds[lang]) for _ in range(3)) for _ in range(rng.randint(5, 60))), lang, 1.0))
    rows += [(600, None, "aa", 1.0), (601, "12 34 !", "bb", 1.0), (602, "", None, 1.0), (None, "babe bibo", "aa", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score double")
    got = by_id(language_id.identify_languages(docs, language_id.train_language_model(docs)))
    held = [i for i in range(600) if got[i]["held_out"]]
    assert sum(got[i]["lang_pred"] == rows[i][2] for i in held) >= 0.99 * len(held)
    assert [got[i]["lang_pred"] for i in (600, 601, 602)] == ["und"] * 3 and got[600]["score"] == 0
    assert got[None]["lang_pred"] == "aa" and not got[None]["held_out"]
    none = language_id.train_language_model(docs.where("false"))
    assert {r["lang_pred"] for r in language_id.identify_languages(docs, none).collect()} == {"und"}


def test_presence_has_no_window_across_texts():
    alone = language_id.presence(["abc"])
    together = language_id.presence(["xyz", "abc", "abd"])
    assert (together[1] == alone[0]).all()


# pages


def test_article_out_of_pages(spark):
    rng = random.Random(12)
    article = [prose(rng, 30).capitalize() + "." for _ in range(6)]
    pages = []
    for i in range(80):
        body = "".join(f"<p>{a} &amp; more</p>" for a in article[: 2 + i % 4])
        pages.append((i, f"u{i}", f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li><a href='/'>Home</a><li><a>News</a></ul></nav><!-- x --><div class='ad'>{prose(rng, 6)}</div><article><h1>Head {i}</h1>{body}</article><footer>&copy; {i}</footer><script>var a='</p>';</script></body></html>"))
    pages += [(100, None, None), (101, "v", ""), (102, "w", "<")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r["page_id"]: r for r in html_extract.extract_text(df, html_extract.train_extractor(df)).collect()}
    for i in range(80):
        want = " ".join([f"Head {i}", *(f"{a} & more" for a in article[: 2 + i % 4])])
        assert got[i]["text"] == want and got[i]["n_chars"] == len(want)
    assert got[100]["text"] == "" and got[101]["n_chars"] == 0 and 102 in got


def test_blocks_of_sloppy_markup():
    html = "<div><p>one <b>two<br>three<p>four&nbsp;&lt;x&gt;<li>five</div><textarea>no</textarea>a<em>b</em>c <!-- open"
    assert [b.text for b in html_extract.blocks_of(html)] == ["one two three", "four <x>", "five", "abc"]
    assert html_extract.blocks_of(None) == []


@pytest.mark.parametrize("odd", ["<svg width='1'/>", "<math/>", "<svg><path d='x'/><title/>", "<object>", "<audio src=a>", "<video>", "<iframe/>", "<video-player></video-player>", "<svg-icon>", "<title-bar></title-bar>", "<template-x>", "<script a='>'>no</script x>"])
def test_text_after_odd_elements_stays(odd):
    assert [b.text for b in html_extract.blocks_of(f"<article><p>one</p>{odd}<p>two</p></article><div>three</div>")] == ["one", "two", "three"]


def test_formulas_and_fallbacks_are_text():
    html = "<article><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p><noscript><p>seen</p></noscript><p>end</p></article>"
    assert [(b.text, b.path[:2]) for b in html_extract.blocks_of(html)] == [("so x=1 holds", ("article", "p")), ("seen", ("article", "noscript")), ("end", ("article", "p"))]


@pytest.mark.parametrize("bad", ["<script ", '<a b="', '<a x=">"', "<!-- ", "<a b='\">", "<p ", "<textarea "])
def test_broken_markup_takes_linear_time(bad):
    start = time.perf_counter()
    html_extract.blocks_of("<p>first</p>" + bad * (1_000_000 // len(bad)))
    assert time.perf_counter() - start < 5


def test_samples_are_bounded_in_rows(spark, monkeypatch):
    """One id in a third of all rows must not bring all of them to the driver."""
    fitted = {}
    monkeypatch.setattr(language_id, "fit_kernel_ridge", lambda grams, langs, *_: fitted.setdefault("languages", len(langs)))
    monkeypatch.setattr(toxicity, "fit_nnpu", lambda toxic, others, *_: fitted.setdefault("toxic", len(toxic) + len(others)))
    monkeypatch.setattr(html_extract, "train_on_blocks", lambda parsed, _: fitted.setdefault("pages", len(parsed)))
    rng = random.Random(4)
    rows = [(i, prose(rng, 20), "en") for i in range(40)]
    rows += [(0, prose(rng, 20), "en") for _ in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    language_id.train_language_model(docs, language_id.KernelParameters(per_language=8))
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, toxic int")
    toxicity.train_toxicity(docs.select("doc_id", "text"), labels, toxicity.PuParameters(max_positive=5, max_unlabelled=9))
    html_extract.train_extractor(docs.selectExpr("doc_id as page_id", "text as html"), html_extract.ExtractParameters(sample_pages=6))
    assert fitted["languages"] <= 8 and fitted["toxic"] <= 14 and fitted["pages"] == 6


def test_network_gradient():
    rng = np.random.default_rng(1)
    net = html_extract.Network.new(3, 1)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    x, mask = rng.normal(size=(4, 2, html_extract.INPUT)), np.array([[1, 1], [1, 1], [1, 0], [1, 0]], bool)
    y = rng.integers(0, 2, (4, 2))

    def loss():
        p, *_ = html_extract._forward(net, x, mask)
        return -(np.log(np.where(y == 1, p, 1 - p)) * mask).sum()

    p, both, tape_f, tape_b = html_extract._forward(net, x, mask, keep=True)
    grads = {k: np.zeros_like(v) for k, v in net.weights.items()}
    d = np.where(mask, p - y, 0)[:, :, None] * net.weights["o"]
    html_extract._lstm_gradient(x, d[:, :, :3], tape_f, net.weights, "f", grads)
    html_extract._lstm_gradient(x, d[:, :, 3:], tape_b, net.weights, "b", grads)
    for name, at in (("fh", (1, 2)), ("fx", (5, 7)), ("bb", (4,)), ("bh", (0, 9))):
        w, e = net.weights[name], 1e-3
        w[at] += e
        up = loss()
        w[at] -= 2 * e
        down = loss()
        w[at] += e
        assert grads[name][at] == pytest.approx((up - down) / (2 * e), rel=0.05, abs=2e-3)


# decontamination


def brute_hits(text, items):
    pattern = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = pattern.findall((text or "").encode().lower())
    hit, found = set(), set()
    for item, said in items:
        of = pattern.findall((said or "").encode().lower())
        size = min(10, len(of))
        windows = {tuple(of[j : j + size]) for j in range(len(of) - size + 1)} if of else set()
        for j in range(len(words) - size + 1):
            if size and tuple(words[j : j + size]) in windows:
                hit.update(range(j, j + size))
                found.add("" if item is None else str(item))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block_words", [1, 10**6])
def test_decontamination_against_every_window(spark, odd_texts, block_words):
    rng = random.Random(13)
    items = [(i, prose(rng, n)) for i, n in enumerate((30, 12, 10, 11, 45))] + [(10, "Two-Words"), (11, "solo"), (12, None), (13, " .. "), (None, prose(rng, 14))]
    items += [(20, items[0][1][:90]), (0, items[0][1])]
    texts = [*odd_texts]
    for i in range(50):
        words = prose(rng, 60).split()
        said = rng.choice(items)[1] or ""
        a = rng.randrange(len(words))
        part = said.split()[rng.randint(0, 3) : 40 - rng.randint(0, 20)]
        words[a:a] = part * rng.randint(1, 2)
        texts.append(("; " if i % 3 else " ").join(w.upper() if i % 4 == 0 else w for w in words))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = by_id(decontaminate.contamination(table(spark, texts), benchmark, block_words=block_words))
    for i, text in enumerate(texts):
        assert tuple(got[i])[1:6] == brute_hits(text, items), text
    clean = decontaminate.keep_clean(table(spark, texts), benchmark, block_words=block_words)
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(i for i in got if not got[i]["contaminated"])
    none = decontaminate.contamination(table(spark, texts), benchmark.where("false"), block_words=block_words)
    assert {r["n_hit"] for r in none.collect()} == {0}


def test_longest_match_and_its_places(spark):
    rng = random.Random(14)
    words = prose(rng, 25).split()
    text = "before this " + " ".join(words[4:19]) + " after " + " ".join(words[:10])
    benchmark = spark.createDataFrame([(3, " ".join(words))], "item_id bigint, text string")
    r = decontaminate.contamination(table(spark, [text]), benchmark).first()
    assert (r["longest_match"], r["match_at"], r["match_item"], r["match_item_at"]) == (15, 2, "3", 4)


@pytest.mark.parametrize("block_words", [1, 10**6])
def test_equal_longest_matches_go_by_place_and_item_id(spark, block_words):
    rng = random.Random(15)
    first, second = prose(rng, 12), prose(rng, 12)
    items = [("z", second), ("k", f"{prose(rng, 3)} {first}"), ("b", f"{prose(rng, 5)} {first}"), ("b", f"x {first}"), ("c", second), ("z", second)]
    benchmark = spark.createDataFrame(items, "item_id string, text string").coalesce(1)
    r = decontaminate.contamination(table(spark, [f"start {first} and {second}"]), benchmark, block_words=block_words).first()
    assert (r["n_items"], r["longest_match"], r["match_at"], r["match_item"], r["match_item_at"]) == (4, 12, 1, "b", 1)


def test_periodic_texts_are_matched_without_listing_pairs(spark):
    # 39,991 places times 391 windows would be 15 million pairs of one window.
    benchmark = spark.createDataFrame([("one", "a " * 400), ("two", "b a " * 50)], "item_id string, text string")
    texts = ["a " * 40_000, "x " + "a b " * 300, "a " * 9 + "b", ""]
    got = by_id(decontaminate.contamination(table(spark, texts), benchmark))
    found = [tuple(got[i][c] for c in ("n_hit", "n_items", "longest_match", "match_at", "match_item", "match_item_at")) for i in range(4)]
    assert found == [(40_000, 1, 400, 0, "one", 0), (600, 1, 100, 2, "two", 0), (0, 0, 0, -1, None, -1), (0, 0, 0, -1, None, -1)]


def test_pretokens_follow_the_unicode_of_the_library(coder):
    encoder, _, reference = coder
    for text in ("a\u0558b!\u0558", "x\u1c8a y\u1c8a1", "\U00011de3\U00011de3 7\U00016130", "\U0001917a!b", "\U00010d75-\U000105c0", "\u01c4\u212a\u03a3 \u5582"):
        assert encoder.encode(text) == reference.encode(text, add_special_tokens=False).ids
