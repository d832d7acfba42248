"""Ranked search, language-model scores and the conversation trie against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import ranked, suffixes, trie

# --- ranked search

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(text):
    return _TERM.findall((text or "").translate(_LOWER))


def _ranked_by_hand(docs, queries, k):
    counts = [(d, Counter(w)) for d, t in docs if (w := _words(t))]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    holding = Counter(w for _, c in counts for w in c)
    asked = {}
    for item, text in queries:
        asked.setdefault(item, set()).update(_words(text))
    rows = []
    for item, terms in asked.items():
        scored = []
        for doc, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        rows += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scored)[:k])]
    return sorted(rows, key=str)


def _ranked(docs, queries, k=50):
    return sorted((tuple(r) for r in ranked.search(docs, queries, k).collect()), key=str)


@pytest.mark.parametrize("postings", [ranked.POSTINGS, 5])
def test_search(spark, odd_docs, monkeypatch, postings):
    monkeypatch.setattr(ranked, "POSTINGS", postings)
    asked = [(1, "Quiet RIVERS, quiet hills"), (1, "text"), (2, None), (3, " .,"), (None, "über 日本語 é"), (4, "a text under the same id " * 3), (5, "word5 word976 end")]
    queries = spark.createDataFrame(asked, "item_id bigint, text string").withColumn("Rank", F.lit(1)).withColumn("term", F.lit("x"))
    docs = odd_docs.withColumn("score", F.lit(1)).withColumn("length", F.lit("x"))
    plain = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    for k in (1, 3, 50):
        assert _ranked(docs, queries, k) == _ranked_by_hand(plain, asked, k)


def test_search_of_empty_tables(spark, no_docs, odd_docs):
    queries = spark.createDataFrame([(1, "a quiet text")], "item_id bigint, text string")
    assert _ranked(no_docs, queries) == _ranked(odd_docs, queries.limit(0)) == []
    assert ranked.search(odd_docs, queries.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_search_in_blocks_of_queries(spark, odd_docs, monkeypatch):
    asked = [(i, f"text number word{i} of hills") for i in range(12)]
    queries = spark.createDataFrame(asked, "item_id bigint, text string")
    monkeypatch.setattr(ranked, "BLOCK_BYTES", 300)
    assert _ranked(odd_docs, queries, 4) == _ranked_by_hand([(r["doc_id"], r["text"]) for r in odd_docs.collect()], asked, 4)


@pytest.mark.parametrize("seed", range(6))
def test_best_positions_with_ties(seed, monkeypatch):
    """Few different impacts, so that whole runs are equal to the k-th; reading must not stop among them."""
    monkeypatch.setattr(ranked, "FIRST", 1)
    rng = np.random.default_rng(seed)
    held = rng.random((400, 7)) < rng.random(7)
    docs, terms = np.nonzero(held)
    impact = rng.integers(1, 4, len(docs))
    lists = ranked.Lists(docs, terms, impact, 400, 7)
    totals = np.bincount(docs, impact, 400).astype(int)
    for k in (1, 10, 60, 1000):
        chosen, scores = lists.best(list(range(7)), k)
        kth = max(1, sorted(totals, reverse=True)[min(k, 400) - 1])
        assert dict(zip(chosen.tolist(), scores.tolist())) == {i: int(s) for i, s in enumerate(totals) if s >= kth}


def test_search_stops_before_the_ends(monkeypatch):
    n = 5000
    lists = ranked.Lists(np.repeat(np.arange(n), 2), np.tile([0, 1], n), np.repeat(np.arange(n, 0, -1), 2), n, 2)
    looked = []
    monkeypatch.setattr(ranked.np, "unique", lambda x, f=np.unique: looked.append(len(x)) or f(x))
    chosen, _ = lists.best([0, 1], 10)
    assert sorted(chosen) == list(range(10)) and sum(looked) < 300


# --- language-model scores


def _tokens(text):
    lower = (text or "").translate(_LOWER)
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w] + [None]


def _scores_by_hand(rows):
    """Over dictionaries of n-grams, with the tree's rules written out."""
    texts = [(_tokens(t), bool(h)) for _, t, h in rows]
    counts, after = Counter(), defaultdict(Counter)
    for words, held in texts:
        for i, w in enumerate(words) if not held else ():
            for length in range(min(i, suffixes.DEPTH) + 1):
                after[tuple(words[i - length : i])][w] += 1
                counts[tuple(words[i - length : i + 1])] += 1
    tokens, kinds = sum(after[()].values()), len(after[()])
    least = max(suffixes.LEAST_COUNT, math.ceil(suffixes.LEAST_SHARE * tokens))
    states = {(): True}

    def root(w):
        return (after[()][w] + 0.5) / (tokens + 0.5 * (kinds + 1))

    for context in sorted((c for c in after if c and counts[c] >= least), key=len):
        gain, n_of, d = 0.0, counts[context], len(after[context])
        for w, n in after[context].items():
            shorter = root(w) if len(context) == 1 else (after[context[1:]][w] - suffixes.DISCOUNT) / counts[context[1:]]
            if n == 1:
                gain += math.log(suffixes.DISCOUNT * max(d - 1, suffixes.DISCOUNT) / (n_of - 1))
            else:
                gain += n * (math.log((n - 1 - suffixes.DISCOUNT) / (n_of - 1)) - math.log(shorter))
        states[context] = gain >= suffixes.GAIN
        assert abs(gain - suffixes.GAIN) > 1e-3

    def chance(context, w):
        if not context:
            return root(w)
        shorter = chance(context[1:], w)
        return (max(after[context][w] - suffixes.DISCOUNT, 0) + suffixes.DISCOUNT * len(after[context]) * shorter) / counts[context]

    out, used = [], Counter()
    for (doc, _, _), (words, held) in zip(rows, texts):
        score = base = 0.0
        for i, w in enumerate(words):
            context = ()
            for length in range(1, min(i, suffixes.DEPTH) + 1):
                if not states.get(tuple(words[i - length : i])):
                    break
                context = tuple(words[i - length : i])
            used[len(context)] += 1
            score += math.log10(chance(context, w))
            base += math.log10(root(w))
        out.append((doc, held, len(words), sum(after[()][w] > 0 for w in words), tokens, base, score))
    return out, used, chance, after


def _same_scores(found, wanted):
    key = lambda r: (str(r[:5]), round(r[6], 6))
    assert len(found) == len(wanted)
    for a, b in zip(sorted(found, key=key), sorted(wanted, key=key)):
        assert tuple(a[:5]) == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-7, abs=1e-7)


@pytest.fixture(scope="module")
def babble():
    """Texts of a chain that looks back up to three words."""
    rng = np.random.default_rng(5)
    words = [f"W{i}" for i in range(4)] + ["É", "\u2003x"]
    rows = []
    for doc in range(120):
        text = []
        for _ in range(int(rng.integers(0, 80))):
            seed = hash(tuple(ord(c) for w in text[-3:] for c in w)) % 6
            text.append(words[seed] if rng.random() < 0.8 else words[int(rng.integers(6))])
            if rng.random() < 0.02:
                text.append(f"rare{rng.integers(50)}")
        rows.append((doc, "  " * (doc % 2) + "\t \n".join(text), doc % 4 == 1))
    return rows


@pytest.mark.parametrize("size", [suffixes.BLOCK_BYTES, 500])
def test_scores(spark, babble, monkeypatch, size):
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", size)
    docs = spark.createDataFrame(babble, "doc_id bigint, text string, train boolean").withColumn("score", F.lit("x")).withColumn("block", F.lit(1)).repartition(3)
    wanted, used, chance, after = _scores_by_hand(babble)
    assert set(used) == {0, 1, 2, 3}  # states of every length are at work
    _same_scores([tuple(r) for r in suffixes.score_texts(docs, "train").collect()], wanted)
    vocabulary = [*after[()], "never seen"]
    assert sum(chance(("w1",), w) for w in vocabulary) == pytest.approx(1) == pytest.approx(sum(chance((), w) for w in vocabulary))


def test_block_of_the_rest_of_a_batch(spark, monkeypatch):
    """A block may hold a later slice of a batch alone; its words are those of its own texts."""
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 1)
    rows = [(i, "".join(f"Word{j} " for j in range(4000 + 100 * i)), False) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, held boolean").coalesce(1)
    blocks = suffixes.write_blocks(docs, "held").collect()
    assert len(blocks) > 1
    assert {d: n for b in blocks for d, n in zip(b["doc_ids"], b["lengths"])} == {i: 4001 + 100 * i for i in range(60)}
    known = {suffixes.xxhash.xxh64_intdigest(f"word{j}") for j in range(9900)} | {int(suffixes._END)}
    assert all(set(np.frombuffer(b["words"], np.uint64).tolist()) <= known for b in blocks)


def test_scores_of_odd_texts(spark, odd_docs, no_docs):
    held = F.col("doc_id").isin(1, 8)
    rows = [(r["doc_id"], r["text"], r["doc_id"] in (1, 8)) for r in odd_docs.collect()]
    _same_scores([tuple(r) for r in suffixes.score_texts(odd_docs.withColumn("h", held), "h").collect()], _scores_by_hand(rows)[0])
    assert suffixes.score_texts(no_docs.withColumn("h", held), "h").collect() == []
    untrained = suffixes.score_texts(odd_docs.withColumn("h", F.lit(True)), "h").collect()
    assert {(r["train_tokens"], r["n_known"], r["score"], r["base_score"]) for r in untrained} == {(0, 0, 0.0, 0.0)}


# --- conversation trie


@pytest.mark.parametrize("seed", range(8))
def test_parens(seed):
    rng = np.random.default_rng(seed)
    bits, depth, n = [], 0, int(rng.integers(1, 3000))
    for left in range(2 * n, 0, -1):
        opens = depth == 0 or (depth < left and rng.random() < (0.5, 0.9, 0.55)[seed % 3])
        bits.append(int(opens))
        depth += 1 if opens else -1
    closes, stack = {}, []
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            closes[stack.pop()] = i
    parens = trie.Parens(np.array(bits))
    pairs = [i for i in range(len(bits) - 1) if bits[i] and not bits[i + 1]]
    for i, j in closes.items():
        assert parens.find_close(i) == j
        assert parens.opens_before(i) == sum(bits[:i])
        if i % 7 == 0:
            assert parens.leaves_within(i, j) == sum(i <= p < j for p in pairs)


def _trie_by_hand(rows, rebuilt):
    digest = lambda r: hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((conv, turn, role or "", text or ""))
    for t in turns.values():
        t.sort(key=lambda r: (r[1] is not None, r[1] or 0, digest(r)))
    paths = {}
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % 6 if rebuilt else 0
        paths[conv] = tuple((r[2], r[3]) for r in turns.get(conv - conv % 100, [])[:h] + own[h:])
    members = defaultdict(list)
    for conv in sorted(paths):
        for d in range(len(paths[conv]) + 1):
            members[paths[conv][:d]].append(conv)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    leaves, saved = Counter(), Counter()
    for node, held in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(held) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, held in members.items():
        ends = ",".join(str(c) for c in held if paths[c] == node)
        out.append((held[0], len(node), members[node[:-1]][0] if node else None, len(held), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _trie(rows, spark, rebuilt, parts=3):
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(parts)
    found = trie.conversation_trie(table.withColumn("name", F.lit(1)).withColumn("Place", F.lit("x")), rebuilt)
    assert found.columns == trie.NODES
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.fixture(scope="module")
def talks():
    """Conversations that branch at every depth, copies, some that end inside others, one with a third of all rows."""
    rng = np.random.default_rng(3)
    rows = []
    for conv in [*range(90), *range(100, 130), 205, 1203]:
        for turn in range(int(rng.integers(1, 7))):
            rows.append((conv, turn, ("user", "assistant")[turn % 2], "é" * turn + "ab"[int(rng.integers(2))]))
    rows += [(c, t, "user", text) for c in (300, 301, 302, 77_777) for t, text in enumerate(("same", "same", "", None, "end"))]
    rows += [(7_000, t // 3, "user", f"turn {t % 40}") for t in range(300)]
    rows += [(7_001, t // 3, "user", f"turn {t % 40}") for t in range(250)]
    return rows + [(5_000, None, None, None), (5_000, None, "user", "b"), (5_000, None, "user", "b"), (None, 1, "user", "x"), (-3, 2, None, "y"), (-3, 1, "user", None)]


@pytest.mark.parametrize("rebuilt", [False, True])
def test_trie(spark, talks, rebuilt):
    assert _trie(talks, spark, rebuilt) == _trie_by_hand(talks, rebuilt)


def test_trie_of_few_conversations(spark):
    for rows in ([], [(None, 0, "user", "x")], [(4, 0, "user", "x")], [(4, 0, "user", "x"), (4, 1, None, None)], [(4, 0, "u", "x" * 200_000), (5, 0, "u", "x" * 200_000)]):
        assert _trie(rows, spark, False, 1) == _trie_by_hand(rows, False)
