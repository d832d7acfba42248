"""Exact, SimHash and vector deduplication against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tablewright.llm import components, exact, simhash, vectors
from tablewright.llm.queries import ORACLES, QUERIES
from tests.compare import connect, normal


def _components(n, linked):
    """Smallest index of each component; ``linked(i)`` gives the neighbours of i."""
    root = list(range(n))
    for i in range(n):
        for j in linked(i):
            a, b = i, int(j)
            while root[a] != a:
                a = root[a]
            while root[b] != b:
                b = root[b]
            root[max(a, b)] = min(a, b)
    for i in range(n):
        a = i
        while root[a] != a:
            a = root[a]
        root[i] = a
    return root


# --- components


def test_connected(spark):
    rng = random.Random(2)
    nodes = rng.sample(range(-(10**12), 10**12), 400)
    pairs = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(260)] + list(zip(nodes[:60], nodes[1:60]))  # a long chain
    links = spark.createDataFrame(pairs + pairs[:20] + [(nodes[0], nodes[0])], "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in components.connected(links).collect()}
    order = sorted(nodes)
    place = {v: i for i, v in enumerate(order)}
    near = defaultdict(list)
    for a, b in pairs:
        near[place[a]].append(place[b])
    expected = _components(len(order), lambda i: near[i])
    assert {v: found.get(v, v) for v in order} == {v: order[expected[i]] for i, v in enumerate(order)}
    assert components.connected(links.limit(0)).collect() == []


def test_stars():
    a, b = np.array([5, 9, 9, 1, 7]), np.array([9, 2, 5, 1, 8])
    node, root = components.stars(a, b)
    assert dict(zip(node.tolist(), root.tolist())) == {5: 2, 9: 2, 8: 7}


# --- exact


def _plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def _exact_by_hand(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[_plain(r["text"])].append(r)
    out = []
    for text, members in groups.items():
        best = min(members, key=lambda r: (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        for r in members:
            kept = r["doc_id"] == best["doc_id"] and len(r["text"] or "") == len(best["text"] or "")
            out.append((r["doc_id"], best["doc_id"], len(members), kept, sha))
    return Counter(out)


@pytest.mark.parametrize("counters", [1, 2, 1024])
def test_exact_odd_rows(spark, odd_docs, counters):
    clash = odd_docs.withColumn("keep_id", F.lit(1)).withColumn("SHA", F.lit("x")).withColumn("_points", F.lit(2)).repartition(4)
    found = exact.exact_duplicates(clash, counters)
    assert Counter(tuple(r) for r in found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()) == _exact_by_hand(odd_docs.collect())
    kept = exact.drop_exact_copies(clash, counters)
    assert kept.columns == clash.columns
    rows = kept.collect()
    assert sorted(_plain(r["text"]) for r in rows) == sorted({_plain(r["text"]) for r in odd_docs.collect()})
    expected = {(k[0], k[4]) for k in _exact_by_hand(odd_docs.collect()) if k[3]}
    assert {(r["doc_id"], hashlib.sha256(_plain(r["text"]).encode()).hexdigest()) for r in rows} == expected


def test_exact_empty(spark, no_docs):
    assert exact.exact_duplicates(no_docs).collect() == []
    assert exact.drop_exact_copies(no_docs).collect() == []


def test_summary_bound():
    """What has more than an n-th of the rows is always in a summary of n counters."""
    rng = random.Random(4)
    for _ in range(30):
        rows = [str(min(rng.randrange(1, 30), rng.randrange(1, 30))) for _ in range(400)]
        counts = {}
        for start in range(0, 400, 25):
            for key, n in Counter(rows[start : start + 25]).items():
                counts[key] = counts.get(key, 0) + n
            counts = exact.summary(counts, 10)
            assert len(counts) <= 10
        for key, n in Counter(rows).items():
            assert n <= 40 or key in counts


def test_thinly_spread_digest_is_found(spark):
    """A quarter of all rows, and one row in each partition."""
    rows = [("hot" if i % 4 == 0 else f"own {i}",) for i in range(400)]
    spread = spark.createDataFrame(spark.sparkContext.parallelize(rows, 100), "sha string")
    found = {r["sha"] for r in exact.heavy_hitters(spread, 7).collect()}
    assert "hot" in found and len(found) == 7


def test_heavy_texts_are_split_off(spark):
    rows = [(i, f"text {i % 7}" if i % 3 else "the hot text" + " " * (i % 5)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = exact.winners(exact.digests_of(docs), 3).collect()
    assert 1 <= len(found) <= 3
    hot = next(r for r in found if r["group_size"] == 100)
    assert (hot["keep_id"], hot["keep_points"]) == (9, len("the hot text    "))


# --- SimHash


def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_golay_code():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 4000)
    codes, used = simhash.golay_indices(words)
    assert set(used.sum(1).tolist()) == {1, 6}
    remainders = simhash._REMAINDERS
    codewords = (codes << 11) | remainders[codes]
    distances = np.bitwise_count(codewords ^ words[:, None])
    assert (distances[used] <= 4).all() and (distances[:, 0] <= 3).all()
    for flips in (1, 2):
        for _ in range(flips * 8):
            other = words.copy()
            for _ in range(flips):
                other ^= 1 << rng.integers(0, 23, len(words))
            codes2, used2 = simhash.golay_indices(other)
            shared = [(set(a[u]) & set(b[v])) for a, u, b, v in zip(codes, used, codes2, used2)]
            assert all(shared)
            if flips == 1:
                assert all(a[0] in b[v] for a, b, v in zip(codes, codes2, used2))


def _near(fps):
    return lambda i: np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 4)


@pytest.mark.parametrize("run_rows", [8192, 8])
def test_all_pairs_within_four_bits(spark, run_rows):
    """Every pattern of up to four wrong bits is found, also in runs that are cut into tiles."""
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    near = []
    for b in base:
        for n in (1, 2, 3, 4, 4, 4, 5, 5):
            near.append(b ^ np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, n, replace=False).astype(np.uint64)))
    ball = base[0] ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64))
    fps = np.unique(np.concatenate([base, np.array(near), ball, rng.integers(0, 1 << 63, 200, dtype=np.uint64)]).view(np.int64))
    found = simhash.links(spark.createDataFrame([(int(x),) for x in fps], "fp bigint"), run_rows)
    roots = {r["node"]: r["root"] for r in components.connected(found).collect()}
    expected = _components(len(fps), _near(fps.view(np.uint64)))
    assert [roots.get(int(x), int(x)) for x in fps] == [int(fps[i]) for i in expected]
    pairs = [(r["a"], r["b"]) for r in found.collect()]
    assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= 4 for a, b in pairs) or len(pairs) < len(fps) * 40


def _simhash_by_hand(rows):
    fps = np.array([_fingerprint(r["text"]) for r in rows], np.uint64)
    roots = _components(len(rows), _near(fps))
    ids = defaultdict(list)
    for r, root in zip(rows, roots):
        if r["doc_id"] is not None:
            ids[root].append(r["doc_id"])
    return fps, roots, [min(ids[root]) if ids[root] else None for root in roots]


def test_simhash_odd_rows(spark, odd_docs, no_docs):
    rows = odd_docs.collect()
    fps, roots, names = _simhash_by_hand(rows)
    clash = odd_docs.withColumn("fp", F.lit(1)).withColumn("component_id", F.lit("x"))
    found = Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(clash).collect())
    assert found == Counter((r["doc_id"], f"{int(fp):016x}", name) for r, fp, name in zip(rows, fps, names))
    kept = simhash.drop_near_copies(clash)
    assert kept.columns == clash.columns
    left = kept.collect()
    assert len(left) == len(set(roots))
    position = {(r["doc_id"], r["text"]): root for r, root in zip(rows, roots)}
    assert {position[(r["doc_id"], r["text"])] for r in left} == set(roots)
    for frame in (simhash.near_duplicates(no_docs), simhash.drop_near_copies(no_docs)):
        assert frame.collect() == []


def test_simhash_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    fps, _, names = _simhash_by_hand(rows)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op5_simhash"](spark, sf).collect()}
    assert found == {r["doc_id"]: (f"{int(fp):016x}", name) for r, fp, name in zip(rows, fps, names)}


# --- vectors


def _vectors_by_hand(rows):
    good = [r for r in rows if r["vec_id"] is not None and r["embedding"] and all(v is not None and np.isfinite(v) for v in r["embedding"]) and any(r["embedding"])]
    x = [np.array(r["embedding"], float) for r in good]
    x = [v / np.abs(v).max() for v in x]
    x = [v / np.linalg.norm(v) for v in x]

    def linked(i):
        return [j for j in range(len(x)) if j != i and len(x[j]) == len(x[i]) and x[i] @ x[j] >= 0.95]

    near = [linked(i) for i in range(len(x))]
    roots = _components(len(x), lambda i: near[i])
    ids = defaultdict(list)
    for r, root in zip(good, roots):
        ids[root].append(r["vec_id"])
    out = Counter((r["vec_id"], len(n), min(ids[root])) for r, n, root in zip(good, near, roots))
    return out + Counter((r["vec_id"], 0, r["vec_id"]) for r in rows if r not in good)


def _check_vectors(spark, frame):
    rows = frame.collect()
    found = vectors.near_vectors(frame).collect()
    assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in found) == _vectors_by_hand(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)
    assert all(r["audit_recall"] >= vectors.RECALL for r in found)


def test_vectors_odd_rows(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(40, 16))
    rows = [(i, [float(v) for v in x], 0) for i, x in enumerate(base)]
    for i in range(60):  # clusters, and copies in another scale
        rows.append((100 + i, [float(v) for v in base[i % 6] + rng.normal(size=16) * 0.08], 0))
        rows.append((200 + i, [float(v) * 1000 for v in base[i % 3]], 0))
    rows += [(300, None, 0), (301, [], 0), (302, [0.0] * 16, 0), (303, [1.0, None] + [0.0] * 14, None), (304, [float("nan")] + [1.0] * 15, 0)]
    rows += [(305, [float("inf")] * 16, 0), (306, [1.0, 2.0], 0), (307, [1.0, 2.01], 0), (308, [1e-300] * 16, 0), (309, [1e300] * 16, 0)]
    rows += [(0, rows[0][1], 0), (0, rows[0][1], 0)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("cid", F.lit(1)).withColumn("v", F.lit("x"))
    _check_vectors(spark, frame)
    assert vectors.near_vectors(frame.limit(0)).collect() == []


def test_vectors_blocks(spark, monkeypatch):
    """A dense cluster larger than a block is compared in full."""
    monkeypatch.setattr(vectors, "BLOCK", 40)
    rng = np.random.default_rng(10)
    centre = rng.normal(size=24)
    rows = [(i, [float(v) for v in centre + rng.normal(size=24) * 0.05]) for i in range(150)]
    rows += [(1000 + i, [float(v) for v in rng.normal(size=24)]) for i in range(150)]
    _check_vectors(spark, spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))


def test_links_count_on_both_sides(spark, monkeypatch):
    """Isolated pairs in many shards: a row counts a link if and only if the other row does, and only then they are joined."""
    monkeypatch.setattr(vectors, "PER_SHARD", 8)
    monkeypatch.setattr(vectors, "OVERLAP", 2)
    monkeypatch.setattr(vectors, "RECALL", 0.0)
    rng = np.random.default_rng(13)
    a = rng.normal(size=(1600, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=(1600, 64))
    b -= (b * a).sum(1, keepdims=True) * a
    b = 0.952 * a + (1 - 0.952**2) ** 0.5 * b / np.linalg.norm(b, axis=1, keepdims=True)
    frame = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(np.concatenate([a, b]))], "vec_id bigint, embedding array<double>")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_vectors(frame).collect()}
    assert all(found[i][0] == found[i + 1600][0] for i in range(1600))
    assert all((found[i + 1600][1] == i) == (found[i + 1600][0] == 1) for i in range(1600))
    assert sum(found[i][0] for i in range(1600)) > 1500


def test_links_count_once(spark):
    """A pair in several shards and blocks is counted once for each side."""
    rng = np.random.default_rng(14)
    x = rng.normal(size=(60, 16))
    x = np.concatenate([x, x + rng.normal(size=(60, 16)) * 0.01])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(cell, cells, i, 2, [float(c) for c in v], 3, i % 3) for i, v in enumerate(x) for cells in [[2, 1, 3 + (i < 60)]] for cell in cells]
    shards = spark.createDataFrame(rows, "cell bigint, cells array<bigint>, cid bigint, copies bigint, x array<double>, blocks int, block int")
    lists = spark.createDataFrame([(i, [j for j in range(120) if j != i]) for i in range(120)], "cid bigint, next array<bigint>")
    out = vectors._search(shards, lists, 0.95, 32)
    counts = {r["a"]: r["n"] for r in out.filter("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("n")).collect()}
    assert counts == {i: 2 for i in range(120)}
    assert [(r["a"], r["b"]) for r in out.filter("n IS NULL").orderBy("b").collect()] == [(60 + i, i) for i in range(60)]


def _classes(spark, links):
    """A hot group of 300 near copies and ``links`` isolated pairs, as classes."""
    rng = np.random.default_rng(12)
    x = list(rng.normal(size=(2 * links, 32)))
    for i in range(links):
        x[2 * i + 1] = x[2 * i] + rng.normal(size=32) * 0.01
    hot = rng.normal(size=32)
    x += [hot + rng.normal(size=32) * 0.01 for _ in range(300)]
    rows = [(i, i, 1, [float(c) for c in v / np.linalg.norm(v)]) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "cid bigint, vec_id bigint, copies bigint, x array<double>")


def test_audit_sees_lost_pairs(spark):
    """A hot group that is found in full does not hide that isolated pairs are lost; the audit grows with the input."""
    found = _classes(spark, 300)
    hot = spark.range(600, 900).selectExpr("id AS a", "299L AS n")
    assert vectors._recall(found, hot, 0.95, 900) == 0.0
    whole = hot.unionByName(spark.range(600).selectExpr("id AS a", "1L AS n"))
    assert vectors._recall(found, whole, 0.95, 900) == 1.0


def test_audit_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 70)
    found = _classes(spark, 100)
    half = spark.range(500).selectExpr("id AS a", "CASE WHEN id >= 200 THEN 299L WHEN id % 4 < 2 THEN 1L ELSE 0L END AS n")
    assert 0.3 < vectors._recall(found, half, 0.95, 500) < 0.7
    monkeypatch.setattr(vectors, "AUDIT", 1)
    monkeypatch.setattr(vectors, "ONE_IN", 1)
    assert vectors._recall(found, half, 0.95, 500) == 0.5


def test_audit_looks_further_where_it_sees_no_link(spark, monkeypatch):
    """One pair among lone vectors, none of it audited at first; then a class is asked of which a link was found."""
    monkeypatch.setattr(vectors, "AUDIT", 1)
    monkeypatch.setattr(vectors, "ONE_IN", 1 << 40)
    rng = np.random.default_rng(3)
    x = list(rng.normal(size=(200, 32)))
    x += [x[-1] + rng.normal(size=32) * 0.01]
    rows = [(i, i, 1, [float(c) for c in v / np.linalg.norm(v)]) for i, v in enumerate(x)]
    found = spark.createDataFrame(rows, "cid bigint, vec_id bigint, copies bigint, x array<double>")
    one_side = spark.createDataFrame([(199, 1)], "a bigint, n bigint")
    assert vectors._recall(found, one_side, 0.95, 201) is None
    assert vectors._recall(found, one_side, 0.95, 201, more=True) == 1.0
    assert vectors._recall(found, one_side.limit(0), 0.95, 201, more=True) is None


def test_short_search_is_made_up_by_comparing(spark, monkeypatch):
    """Shards that part every pair: after the last try all classes are compared, over several blocks."""
    monkeypatch.setattr(vectors, "BLOCK", 50)
    monkeypatch.setattr(vectors, "TRIES", 1)
    none = lambda shards, *_: spark.createDataFrame([], "a bigint, b bigint, n bigint")
    monkeypatch.setattr(vectors, "_search", none)
    rng = np.random.default_rng(15)
    x = rng.normal(size=(60, 24))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate([*x, *(x + rng.normal(size=(60, 24)) * 0.02)])]
    _check_vectors(spark, spark.createDataFrame([*rows, (500, rows[3][1]), (501, [1.0, 2.0]), (502, [1.0, 2.01])], "vec_id bigint, embedding array<double>"))


def test_audit_without_links_is_not_measured(spark):
    rows = [(i, [float(i == j) for j in range(8)]) for i in range(8)]
    out = vectors.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert [r["audit_recall"] for r in out] == [None] * 8


def test_vectors_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    found = QUERIES["op2_vectors"](spark, sf).collect()
    assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in found) == _vectors_by_hand(rows)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_against_sql(spark, sf, name):
    frame = QUERIES[name](spark, sf)
    cursor = connect(sf).execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    assert normal(frame.columns, [tuple(r) for r in frame.collect()]) == normal(columns, cursor.fetchall())
