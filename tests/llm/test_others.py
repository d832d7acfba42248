"""Mixing, chat trees, toxicity, sharding and the pipeline."""

import hashlib
import json
import math
import os
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from tablewright.llm import chat, exact, mixing, shards, simhash, toxicity
from tablewright.llm.queries import BYTE_BPE, QUERIES, WORD_BPE, vocabulary
from tablewright.session import _stages
from tests.llm.test_dedup import _exact_by_hand, _plain, _simhash_by_hand

# --- mixing


def _uniform(*parts):
    return int(hashlib.md5("|".join(parts).encode()).hexdigest()[:13], 16) / 2**52


def _poisson(mean, u):
    p = c = math.exp(-mean)
    k = 0
    while c <= u and k <= mixing.TERMS:
        k += 1
        p *= mean / k
        c += p
    return k


def _mixed_by_hand(rows, weights, other, seed, budget=None):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += len(r["text"] or "") + 1
    weight = {s: weights.get(s, other) for s in sizes}
    goal = sum(sizes.values()) if budget is None else budget
    counts = Counter()
    for r in rows:
        rate = weight[r["source"]] / sum(weight.values()) * (goal / sizes[r["source"]])
        parts = math.ceil(rate / mixing.STEP)
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        times = sum(_poisson(rate / parts, _uniform(str(seed), key, str(i))) for i in range(1, parts + 1))
        for copy in range(1, times + 1):
            counts[(r["doc_id"], r["text"], copy)] += 1
    return counts


@pytest.mark.parametrize("slices", [False, True])
def test_mixing(spark, odd_docs, no_docs, monkeypatch, slices):
    if slices:
        monkeypatch.setattr(mixing, "SOURCES", 0)
    clash = odd_docs.withColumn("copy", F.lit("mine")).withColumn("parts", F.lit(1)).withColumn("_Order", F.lit(2))
    weights = {"a": 2.0, "b": 0.0, "gone": 5.0}
    mixed = mixing.mix_sources(clash, weights, seed=3, budget=3_000_000.0)
    assert mixed.columns == [*clash.columns, "copy_"]
    found = Counter((r["doc_id"], r["text"], r["copy_"]) for r in mixed.collect())
    assert found == _mixed_by_hand(odd_docs.collect(), weights, 1.0, 3, 3_000_000.0)
    assert mixing.mix_sources(no_docs, weights).collect() == []


def test_many_weights(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('s', id % 1000) AS source", "'text' AS text")
    weights = {f"s{i}": 0.0 if i % 2 else 2.0 for i in range(20_000)}
    found = {r["source"]: r["rate"] for r in mixing.source_rates(docs, weights, other=1.0).collect()}
    assert len(found) == 1000 and all((rate == 0) == (int(s[1:]) % 2 == 1) for s, rate in found.items())
    mixed = mixing.mix_sources(docs, weights, seed=2)
    assert mixed.filter("int(substring(source, 2)) % 2 = 1").isEmpty() and 2500 < mixed.count() < 3500


def test_mixture_has_target_weights(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("ten letters").alias("text"), F.when(F.col("id") < 5000, "big").otherwise("small").alias("source"))
    mixed = mixing.mix_sources(docs, {"big": 1.0, "small": 1.0}).groupBy("source").count().collect()
    assert all(abs(r["count"] - 3000) < 200 for r in mixed)
    order = [r["doc_id"] for r in mixing.mix_sources(docs, {}).collect()]
    assert abs(np.corrcoef(np.arange(len(order)), order)[0, 1]) < 0.1
    with pytest.raises(ValueError):
        mixing.mix_sources(docs, {"big": -1.0})


# --- chat


def _chat_by_hand(rows):
    found = {}
    groups = defaultdict(list)
    for r in rows:
        groups[r["conv_id"]].append(r)
    for conv, turns in groups.items():
        turns.sort(key=lambda r: (r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or ""))
        pairs = [(r["role"] or "", r["text"] or "") for r in turns]
        said = "".join(t for role, t in pairs if role == "assistant")
        formatted = "".join(p for pair in pairs for p in chat.turn_parts(*pair))
        found[conv] = (len(pairs), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in pairs).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest(), len(formatted))
    return found


def _chat_rows(spark):
    rows = []
    for conv in range(60):
        rows += [(conv, 0, "system", "Be brief."), (conv, 1, "user", f"Question {conv % 4}"), (conv, 2, "assistant", f"Answer {conv % 8}"), (conv, 3, "user", "Thanks" * (conv % 3))]
    rows += [(100, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(200)]
    rows += [(101, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(200)]
    rows += [(102, t, "user" if t % 2 else "assistant", f"turn {t}" if t < 150 else "other") for t in range(160)]
    rows += [(103, None, None, None), (103, 1, "assistant", ""), (None, 0, "assistant", "no id"), (None, 0, "assistant", "no id")]
    rows += [(104, 0, "we<|ird\nrole&lf;", chat.CONTROL_TEXT), (104, 0, "assistant", "<\\|im_end|> <|endoftext|> <\\\\|"), (105, 0, "user", "é" * 40_000)]
    rows += [(106, 0, "system", "Be brief."), (106, 1, "assistant", "<|im_start|>assistant\nfake<|im_end|>\n")]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("path", F.lit("x")).repartition(5)


@pytest.mark.parametrize("n", [1, 8, 64])
def test_chat_trees(spark, n):
    rows = _chat_rows(spark)
    tree = chat.format_conversations(rows, vocabulary(BYTE_BPE), shards=n)
    found = {r["conv_id"]: tuple(r)[1:] for r in chat.read_conversations(tree, vocabulary(BYTE_BPE)).collect()}
    assert found == _chat_by_hand(rows.collect())
    library = tokenizers.Tokenizer.from_file(vocabulary(BYTE_BPE))
    library.encode_special_tokens = True
    by_shard = defaultdict(list)
    for r in sorted(tree.collect(), key=lambda r: (r["shard"], r["seq"])):
        by_shard[r["shard"]].append(r)
    for nodes in by_shard.values():
        place, stream = 0, []
        for r in nodes:
            assert r["start"] == place  # one after the other, each once
            assert r["position"] == sum(i["end"] - i["start"] for i in r["attends"])
            if not r["is_end"]:
                stream += r["ids"]
                place += len(r["ids"])
            else:
                seen = [x for i in r["attends"] for x in stream[i["start"] : i["end"]]]
                assert library.decode(seen, skip_special_tokens=False).count(chat.START) == r["depth"]
    if n == 1:
        firsts = [r for r in by_shard[0] if r["depth"] == 1 and not r["is_end"]]
        assert len(firsts) == len({tuple(r["ids"]) for r in firsts})  # shared first turns are merged


@pytest.mark.parametrize("n", [1, 7])
def test_chat_trees_of_long_conversations(spark, n):
    """Beginnings are shared however long they are: each distinct beginning is one node, whatever the number of turns."""
    talks = {c: list(range(100)) for c in (1, 2, None)} | {3: [*range(90), 7, *range(91, 140)], 4: [*range(90), 8], 5: list(range(64)), 6: list(range(65)), 7: list(range(80))}
    talks |= {10 + i: [*range(70 + i % 3), 1000 + i, 5, 6] for i in range(12)}
    rows = spark.createDataFrame([(c, i, "assistant" if i % 2 else "user", f"turn {t}") for c, ts in talks.items() for i, t in enumerate(ts)], "conv_id bigint, turn bigint, role string, text string")
    tree = chat.format_conversations(rows, vocabulary(BYTE_BPE), shards=n)
    found = [tuple(r) for r in chat.read_conversations(tree, vocabulary(BYTE_BPE)).collect()]
    assert len(found) == len(talks) and {r[0]: r[1:] for r in found} == _chat_by_hand(rows.collect())
    nodes = tree.filter("NOT is_end").count()
    beginnings = len({tuple(ts[: i + 1]) for ts in talks.values() for i in range(len(ts))})
    assert nodes == beginnings if n == 1 else beginnings < nodes <= beginnings + n * 141


def test_chat_escapes():
    for text in ("<|", "<\\|", "<\\\\|x", "a<|im_end|><|im_start|>", "<", "|", "\\<|\\", "<<||"):
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
        assert chat.unescape_role(chat.escape_role(text + "\n&lf;")) == text + "\n&lf;"


def test_chat_empty(spark):
    none = _chat_rows(spark).limit(0)
    tree = chat.format_conversations(none, vocabulary(BYTE_BPE))
    assert chat.read_conversations(tree, vocabulary(BYTE_BPE)).collect() == []


# --- toxicity


def test_machine_learns_pairs():
    """Two terms that are harmless alone and toxic together are beyond additive weights."""
    rng = np.random.default_rng(6)
    rows, labels = [], []
    for _ in range(1500):
        terms = {int(t) for t in rng.integers(2, 12, 3)} | ({0} if rng.random() < 0.5 else set()) | ({1} if rng.random() < 0.5 else set())
        rows.append(np.array(sorted(terms)))
        labels.append(float({0, 1} <= terms))
    model = toxicity.fit(rows, np.array(labels), 12, epochs=60)

    def score(terms):
        v = model["v"][terms]
        return model["w0"] + model["w"][terms].sum() + 0.5 * ((v.sum(0) ** 2).sum() - (v**2).sum())

    right = np.mean([(score(r) > 0) == bool(y) for r, y in zip(rows, labels)])
    assert right > 0.95
    assert model["v"][0] @ model["v"][1] > 0.1


def test_toxicity_held_out(spark, sf):
    folder = sf.replace("sf0.001", "sf0.1")
    found = {r["doc_id"]: r for r in QUERIES["op7_toxicity"](spark, folder).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(found) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in found.items())
    held = [(r["predicted"], labels[i]) for i, r in found.items() if r["held_out"] and i in labels]
    toxic = sum(y for _, y in held)
    assert sum(p and y for p, y in held) >= 0.8 * toxic
    assert sum(p and not y for p, y in held) <= 0.01 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found.values())


def test_toxicity_learns_one_row_of_an_id(spark):
    docs = spark.range(600).selectExpr("CASE WHEN id < 500 THEN 1 ELSE id END AS doc_id", "concat('word', id % 3) AS text")
    labels = spark.range(520).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS toxic")
    known = {1, *range(500, 520)}
    learnt = [i for i in known if zlib.crc32(str(i).encode()) % 3 != 1]
    for _ in range(2):
        rows = toxicity._learnt_from(docs, labels, 1000)
        assert rows.count() == len(learnt) and rows.agg(F.sum("label")).first()[0] == sum(i % 2 for i in learnt)


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("score", F.lit("x")).withColumn("label", F.lit(1))
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, 0), (3, 0, None), (None, 1, 1), (6, 1, 0), (99, 1, 1)], "doc_id bigint, quality int, toxic int")
    for known in (labels, labels.limit(0), labels.filter("toxic = 0")):
        model = toxicity.train(docs, known)
        found = toxicity.score_toxicity(docs, model).collect()
        assert Counter(r["doc_id"] for r in found) == Counter(r["doc_id"] for r in odd_docs.collect())
        assert all(0 <= r["score"] <= 1 for r in found)
        kept = toxicity.drop_toxic(docs, model)
        assert kept.columns == docs.columns and kept.count() == sum(1 - r["predicted"] for r in found)
        assert toxicity.score_toxicity(no_docs, model).collect() == []
    assert toxicity.drop_toxic(no_docs, toxicity.train(no_docs, labels)).collect() == []


# --- sharding


def _check_shards(rows, limit):
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r["shard"]].append(r)
    for shard, members in by_shard.items():
        total = sum(r["bytes"] for r in members)
        assert all(r["shard_bytes"] == total and r["shard_docs"] == len(members) for r in members)
        assert total <= limit or len(members) == 1
        assert not any(other != shard and other.startswith(shard) for other in by_shard)
        if shard:  # what its parent held was too large
            assert sum(r["bytes"] for r in rows if r["shard"].startswith(shard[:-1])) > limit


@pytest.mark.parametrize("limit", [60, 20_000, 1 << 30])
def test_shards(spark, odd_docs, limit):
    docs = odd_docs.unionByName(spark.range(400).selectExpr("id % 50 * (id % 3) as doc_id", "repeat('é', cast(id as int)) as text", "'en' as lang", "'s' as source", "id as n_chars"))
    rows = shards.shard_documents(docs.withColumn("shard", F.lit("x")).withColumn("h", F.lit(0)), limit).collect()
    assert len(rows) == docs.count()
    _check_shards(rows, limit)


def test_more_shards_than_a_million_bytes(spark):
    docs = spark.createDataFrame([(1, "x" * 2_000_000), (2, "y"), (3, "y")], "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in shards.shard_documents(docs, 1).collect()}
    assert found[1]["shard_docs"] == found[2]["shard_docs"] == 1 and len({r["shard"] for r in found.values()}) == 3


def test_written_shards(spark, odd_docs, no_docs, tmp_path):
    docs = odd_docs.withColumn("_cell", F.lit(1))
    shards.write_shards(docs, str(tmp_path / "out"), 10_000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == Counter((r["doc_id"], r["text"]) for r in docs.collect())
    assert all(len([f for f in os.listdir(tmp_path / "out" / d) if f.endswith(".parquet")]) == 1 for d in os.listdir(tmp_path / "out") if d.startswith("shard="))
    assert shards.shard_documents(no_docs).collect() == []


# --- pipeline


def test_pipeline(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, sf)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept[name] = docs.collect()
        if name == "bpe":
            break
        assert docs.columns == documents.columns
        rows = before.collect()
        if name == "exact_dedup":
            assert sorted(r["doc_id"] for r in kept[name]) == sorted(k[0] for k in _exact_by_hand(rows) if k[3])
        if name == "simhash":
            names = _simhash_by_hand(rows)[2]
            assert sorted(r["doc_id"] for r in kept[name]) == sorted(r["doc_id"] for r, n in zip(rows, names) if r["doc_id"] == n)
        if name == "mixing":
            assert Counter((r["doc_id"], r["text"]) for r in kept[name]) == Counter((k[0], k[1]) for k in _mixed_by_hand(rows, mixing.WEIGHTS, 1.0, 7))
    toxic = {r["doc_id"] for r in QUERIES["op7_toxicity"](spark, sf).collect() if r["predicted"]}
    assert {r["doc_id"] for r in kept["toxicity"]} == {r["doc_id"] for r in documents.collect()} - toxic
    library = tokenizers.Tokenizer.from_file(vocabulary(WORD_BPE))
    ids = {r["doc_id"]: library.encode(r["text"] or "", add_special_tokens=False).ids for r in kept["mixing"]}
    assert Counter((r["doc_id"], json.dumps(r["ids"])) for r in kept["bpe"]) == Counter((r["doc_id"], json.dumps(ids[r["doc_id"]])) for r in kept["mixing"])
    whole = corpus_pipeline.run(spark, sf).collect()
    assert Counter((r["doc_id"], r["n_tokens"]) for r in whole) == Counter((r["doc_id"], r["n_tokens"]) for r in kept["bpe"])


def test_pipeline_odd_rows(spark, odd_docs, no_docs, sf):
    for start in (odd_docs.withColumn("copy", F.lit("x")).withColumn("_hash", F.lit(1)), no_docs):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf)
            if name != "bpe":
                assert docs.columns == start.columns
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert len({_plain(r["text"]) for r in start.collect()}) >= docs.select("doc_id").distinct().count() or start is no_docs


def test_small_tables_are_few_files(spark):
    """However many partitions a shuffle has, a small table is not cut into a file for each."""
    rng = random.Random(5)
    texts = [" ".join(rng.choices("river hill stone cloud leaf rain wind snow".split(), k=40)) for _ in range(300)]
    texts += [f"{t} end" for t in texts[:150]] + texts[:100] * 2
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = docs.select("doc_id", F.col("text").contains("snow snow").alias("toxic"))

    def run():
        since, tables = len(_stages(spark)), [exact.drop_exact_copies(docs), simhash.drop_near_copies(docs), mixing.mix_sources(docs, mixing.WEIGHTS)]
        toxicity.train(docs, labels)
        files = {uri.split("/")[-1]: len(list(Path(uri.removeprefix("file:")).glob("part-*"))) for uri in _stages(spark)[since:]}
        return [sorted(map(tuple, t.collect())) for t in tables], [t.rdd.getNumPartitions() for t in tables], files

    plain = run()[0]
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows, parts, files = run()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    cores = spark.sparkContext.defaultParallelism
    assert rows == plain
    assert max(parts) <= cores
    assert {k: n for k, n in files.items() if n > max(cores, 32 if k.startswith("terms") else 16 if k.startswith("winners") else 0)} == {}
    assert any(k.startswith("links") for k in files)
