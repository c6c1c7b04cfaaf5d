"""Near-duplicates, repeated passages, search, quality and the pipeline against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brute import search as brute_search
from lumagrid.llm import minhash, pii, quality, queries, suffix, topk


def _words(rng, n):
    return [rng.choice("of the and to a in stone river light house winter".split()) + str(rng.randint(0, 60)) for _ in range(n)]


def _shingles(text, width=5):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    own = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(own[i : i + width]) for i in range(len(own) - width + 1)} if len(own) >= width else {tuple(own)} - {()}


def _components(texts, threshold):
    sets = [_shingles(t) for _, t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and 100 * shared >= threshold * len(sets[i] | sets[j]) and sets[j]:
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(texts):
        least[find(i)] = min(least.get(find(i), 10**9), key)
    return {(key, len(sets[i]), least[find(i)]) for i, (key, _) in enumerate(texts)}


@pytest.mark.parametrize("cell", [512, 4])
def test_near_duplicates_have_exact_components(spark, monkeypatch, cell):
    monkeypatch.setattr(minhash, "CELL", cell)
    rng = random.Random(cell)
    texts, key = [], 1
    for family in range(6):
        base = _words(rng, rng.choice([30, 80, 200]))
        for _ in range(rng.randint(1, 14)):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = "changed" + str(rng.randint(0, 9))
            texts.append((key, " ".join(own)))
            key += 1
    texts += [(100, ""), (101, None), (102, " \n "), (103, "one two"), (104, "ONE  two"), (105, "w " * 40_000)]
    table = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    got = {(r["key"], r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(table, threshold=85).collect()}
    assert got == _components(texts, 85)


def test_dedup_keeps_one_row_per_group(spark):
    text = "a b c d e f g h"
    rows = [(5, text, 1), (5, text, 2), (3, text.upper(), 3), (None, text, 4), (7, "", 5), (8, None, 6), (8, None, 7), (9, "other words", 8)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, node int")
    kept = minhash.dedup(table)
    assert kept.columns == table.columns
    assert sorted((r["doc_id"], r["text"] or "") for r in kept.collect()) == [
        (3, text.upper()), (7, ""), (8, ""), (9, "other words"),
    ]
    assert minhash.dedup(table.limit(0)).count() == 0


def test_dedup_keeps_columns_of_any_name(spark):
    rows = [(1, "one two three four five six"), (2, "one two three four five six"), (3, "other words here and there now")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    table = table.withColumns({c: F.lit(c) for c in ("_key", "_hash", "_maybe", "_KEY_", "node", "root", "first_key")})
    kept = minhash.dedup(table)
    assert kept.columns == table.columns and {r["doc_id"] for r in kept.collect()} == {1, 3}


@pytest.mark.parametrize("threshold", [60, 85])
def test_one_large_near_family(spark, threshold):
    """Four hundred texts around one base, above and around the threshold: exact, in few written tables."""
    rng = random.Random(threshold)
    base = _words(rng, 150)
    texts = []
    for k in range(400):
        own = list(base)
        for _ in range(rng.randint(1, 8)):
            own[rng.randrange(len(own))] = f"new{rng.randint(0, 10**6)}"
        texts.append((k, " ".join(own)))
    table = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(8)
    written = []
    real = minhash.materialise
    minhash.materialise = lambda df, label: written.append(label) or real(df, label)
    try:
        got = {(r["key"], r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(table, threshold=threshold).collect()}
    finally:
        minhash.materialise = real
    assert got == _components(texts, threshold)
    assert len(written) - written.count("stars") <= 14 and written.count("stars") <= 14


def _broadcast_explodes(df):
    """Joins of the first plan that broadcast what an explode makes, with no shuffle between to measure it."""
    found, left = [], [df._jdf.queryExecution().sparkPlan()]
    while left:
        node = left.pop()
        children = [node.children().apply(i) for i in range(node.children().size())]
        left += children
        if "Broadcast" in node.nodeName():
            side = [node.left() if "Left" in node.buildSide().toString() else node.right()]
            while side:
                own = side.pop()
                if own.nodeName() == "Generate":
                    found.append(node.simpleStringWithNodeId())
                elif "Aggregate" not in own.nodeName():
                    side += [own.children().apply(i) for i in range(own.children().size())]
    return found


@pytest.mark.parametrize("what", ["near copies", "personal data"])
def test_exploded_rows_are_not_broadcast_unmeasured(spark, monkeypatch, what):
    """Spark takes a table for no larger than before an explode: the bands of documents went through the driver."""
    checked, module = [], {"near copies": minhash, "personal data": pii}[what]
    real = module.materialise
    monkeypatch.setattr(module, "materialise", lambda df, label: checked.append((label, _broadcast_explodes(df))) or real(df, label))
    rng = random.Random(1)
    base = _words(rng, 60)
    texts = [(k, " ".join([*base[:-4], *_words(rng, 4)]) + f" Ms Anna Stone, a{k % 7}@mail.example.com") for k in range(40)]
    table = spark.createDataFrame(texts, "doc_id bigint, text string")
    result = minhash.near_duplicates(table) if module is minhash else pii.replace(table, b"k")
    assert len(checked) > 3 and result.count() == 40
    assert not [x for x in [*checked, ("result", _broadcast_explodes(result))] if x[1]]
    if module is minhash:  # the file of these is small however many rows it holds: values repeat in it
        assert {"members", "placed", "mixed"} <= {label for label, _ in checked}


def test_tables_that_files_make_look_small_are_not_broadcast(spark, monkeypatch):
    """Roots of stars (two digests, read as two numbers) and rows of mixed buckets (values that repeat) join by shuffle."""
    seen, real = {}, minhash.materialise
    monkeypatch.setattr(minhash, "materialise", lambda df, label: seen.setdefault(label, df) and None or real(df, label))
    rng = random.Random(2)
    base = _words(rng, 60)
    texts = [(k, " ".join([*base[:-6], *_words(rng, 6)])) for k in range(40)]
    assert minhash.near_duplicates(spark.createDataFrame(texts, "doc_id bigint, text string")).count() == 40
    for label in ("placed", "mixed"):
        assert "BroadcastHashJoin" not in seen[label]._jdf.queryExecution().sparkPlan().toString(), label


def test_components_of_a_long_chain(spark):
    edges = [(bytearray(f"{i:04d}".encode()), bytearray(f"{i + 1:04d}".encode())) for i in range(60)] + [(bytearray(b"x"), bytearray(b"y"))]
    found = minhash.components(spark.createDataFrame(edges, "a binary, b binary")).collect()
    roots = {bytes(r["node"]): bytes(r["root"]) for r in found}
    assert len(found) == 63 and roots == {**{f"{i:04d}".encode(): b"0000" for i in range(61)}, b"x": b"x", b"y": b"x"}


def test_later_links_join_the_stars_found_before(spark):
    rng = random.Random(12)
    pairs = [(rng.randrange(90), rng.randrange(90)) for _ in range(60)]
    pairs = [(a, b) for a, b in pairs if a != b]
    edges = lambda own: spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in own], "a binary, b binary")
    least = {x: x for pair in pairs for x in pair}
    for _ in least:
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    found = minhash._merged(minhash._stars(edges(pairs[:30])), edges(pairs[30:])).collect()
    assert sorted(map(tuple, found)) == sorted((bytes([x]), bytes([r])) for x, r in least.items() if x != r)


def test_suffix_array_is_sorted():
    rng = random.Random(3)
    for n in (*range(1, 30), 200, 2000):
        for letters in (1, 2, 4, 50):
            text = [rng.randint(1, letters) for _ in range(n)] + [0]
            assert suffix.suffix_array(text) == sorted(range(n + 1), key=lambda i: text[i:])


def _removed(texts, size):
    seen, out = set(), []
    for key, text in sorted(texts, key=lambda x: x[0]):
        data = (text or "").encode()
        cover = bytearray(len(data))
        for i in range(len(data) - size + 1):
            if data[i : i + size] in seen:
                cover[i : i + size] = b"\1" * size
            seen.add(data[i : i + size])
        kept = bytes(b for b, c in zip(data, cover) if not c)
        out.append((key, len(data), sum(cover), len([x for x in bytes(cover).split(b"\0") if x]), kept))
    return out


@pytest.mark.parametrize("together", [4096, 5])
def test_repeated_passages_are_removed_exactly(spark, monkeypatch, together):
    monkeypatch.setattr(suffix, "TOGETHER", together)
    rng = random.Random(together)
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(60, 260))) for _ in range(8)]
    texts = []
    for key in range(60):
        parts = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            cut = rng.randint(0, 40)
            p = p[cut : len(p) - rng.randint(0, 40)]
            parts.append(p[:90] + rng.choice(["", "X"]) + p[90:] + rng.choice(["", "?", "!!"]))
        texts.append((key, "".join(parts)))
    texts += [(90, None), (91, ""), (92, "q" * 99), (93, "q" * 350), (94, "ab" * 300), (95, "abc" * 20_000)]
    table = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix.remove(table).collect())
    assert got == _removed(texts, 100)


def test_passage_of_many_documents_gives_no_large_suffix_array(spark, monkeypatch):
    monkeypatch.setattr(suffix, "TOGETHER", 50)
    largest, arrays = [], suffix._array_spans

    def watched(contexts, shape):
        largest.append(contexts.groupBy("meet").count().agg(F.max("count")).first()[0] or 0)
        return arrays(contexts, shape)

    monkeypatch.setattr(suffix, "_array_spans", watched)
    rng = random.Random(7)
    say = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    line, passage = say(80), say(240)
    texts = [(i, say(60) + (line if i % 2 else passage) + say(rng.randint(20, 60)) + passage[: 110 * (i % 3)]) for i in range(300)]
    # Neighbours that some of the documents share too, and repeats in one document.
    texts += [(400 + i, f"{i}" * 30 + texts[i % 5][1][30:]) for i in range(20)] + [(500, (line + "-" * 30) * 6 + line)]
    table = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix.remove(table).collect())
    assert got == _removed(texts, 100)
    assert max(largest) <= 50


def test_repeated_rows_of_a_document_are_one(spark):
    rng = random.Random(1)
    body = "".join(rng.choice("abcdef") for _ in range(300))
    rows = [(4, body), (4, body), (None, "z" + body), (9, body)]
    got = suffix.remove(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((str(r["doc_id"]), r["n_removed"]) for r in got) == [("4", 300), ("4", 300), ("9", 300), ("None", 0)]
    assert suffix.remove(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_search_is_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=6), 1)]) for i in range(120)]
    rows += [(200, None), (201, [1.0, None]), (202, [float("nan"), 1.0]), (203, [float("inf")]), (204, []), (205, [2.0]), (None, [3.0] * 6)]
    rows += [(40, rows[40][1]), (7, rows[7][1])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    usable = {(i, tuple(v)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in usable]
    expected = []
    for q, v in whole:
        if q is not None and q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i is None, i or 0) for i, w in whole if i != q)[:5]
            expected += [(q, rank + 1, None if none else i, -s) for rank, (s, none, i) in enumerate(best)]
    for components in (1 << 20, 40):
        found = topk.search(table.filter("vec_id % 20 = 0"), table, k=5, block_components=components)
        assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    assert topk.search(table.limit(0), table).count() == 0 and topk.search(table, table.limit(0)).count() == 0


def test_plan_of_a_search_does_not_grow_with_its_blocks(spark):
    rng = np.random.default_rng(8)
    table = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(80)], "vec_id bigint, embedding array<double>")
    own = table.filter("vec_id % 2 = 0")
    few, many = (topk.search(own, table, k=3, block_components=n) for n in (110, 20))
    plans = [found._jdf.queryExecution().optimizedPlan().toString().count("\n") for found in (few, many)]
    assert plans[0] == plans[1] and sorted(few.collect()) == sorted(many.collect()) and few.count() == 120


def test_search_beyond_doubles(spark):
    rows = [(0, [3e5, 1.0]), (1, [2e9, -1.0]), (2, [1e13, 7.0]), (3, [1e30, 0.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = topk.search(table.filter("vec_id = 0"), table, k=5).collect()
    whole = {i: [int(v[0]) * 256, int(v[1]) * 256] for i, v in rows}
    score = lambda i: min(2**63 - 1, sum(a * b for a, b in zip(whole[0], whole[i])))
    assert [(r["vec_id"], r["score"]) for r in found] == [(i, score(i)) for i in (1, 2, 3)]


def _quality_rows():
    rng = random.Random(6)
    good = lambda: ". ".join(" ".join(w.strip("0123456789") for w in _words(rng, 9)).capitalize() for _ in range(6)) + "."
    bad = lambda: " | ".join(_words(rng, 40)) + " ### $$$ " * 10
    rows = [(i, bad() if i % 4 == 0 else good(), f"http://h{i % 7}.example/p{i % 3}/x", "en") for i in range(240)]
    labels = [(i, int(i % 4 != 0)) for i in range(0, 240, 2)] + [(1, None), (None, 1), (9999, 1), (3, 1), (3, 1)]
    return rows, labels


def test_quality_tells_held_out_documents(spark):
    rows, labels = _quality_rows()
    rows += [(500, None, None, None), (501, "", "h", "en"), (502, rows[1][1], None, None), (1, rows[1][1], "http://h1.example/p1/x", "en")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string, quality string")
    told = spark.createDataFrame(labels, "doc_id bigint, quality int")
    places = {"host": quality.host_of(F.col("source")), "path": quality.path_of(F.col("source"))}
    found = {r["doc_id"]: r["quality"] for r in quality.score(table, told, **places).collect()}
    assert all(found[i]["kept"] == (i % 4 != 0) for i in range(240))
    assert not found[500]["kept"] and found[500]["posterior"] == 0 and not found[501]["kept"] and found[502]["kept"]
    kept = quality.keep(table, told, **places)
    assert kept.columns == table.columns and kept.count() == 182
    alone = {r["doc_id"]: r["quality"]["kept"] for r in quality.score(table, told.limit(0), **places).collect()}
    assert all(alone[i] for i in range(240)) and not alone[500]
    assert quality.score(table.limit(0), told, **places).count() == 0


def _moments(groups, parent_of):
    """(strength, mean) by the method of moments, in plain loops: groups {name: values}; parents by ``parent_of``."""
    every = [x for values in groups.values() for x in values]
    parents = {}
    for name, values in groups.items():
        parents.setdefault(parent_of(name), []).append(values)
    within = sum((x - np.mean(v)) ** 2 for v in groups.values() for x in v)
    noise = within / max(len(every) - len(groups), 1)
    between = sum(len(v) * (np.mean(v) - np.mean(np.concatenate(own))) ** 2 for own in parents.values() for v in own)
    room = len(every) - sum(sum(len(v) ** 2 for v in own) / sum(map(len, own)) for own in parents.values())
    variance = (between - (len(groups) - len(parents)) * noise) / max(room, 1)
    mean = np.mean(every)
    return max(mean * (1 - mean) / max(variance, mean * (1 - mean) * 1e-4) - 1, 1.0), mean


def test_posteriors_equal_plain_loops(spark):
    rows, labels = _quality_rows()
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    told = spark.createDataFrame(labels, "doc_id bigint, quality int")
    places = {"host": quality.host_of(F.col("source")), "path": quality.path_of(F.col("source"))}
    got = {r["doc_id"]: r["quality"] for r in quality.score(table, told, **places).collect()}
    seen = [y for i, y in labels if i is not None and i < 240 and y is not None]
    base = np.log(seen.count(1) / seen.count(0))
    odds = {i: r["evidence"] + base for i, r in got.items()}
    chance = {i: 1 / (1 + np.exp(-z)) for i, z in odds.items()}
    by_host, by_path = {}, {}
    for i, _, source, _ in rows:
        host, path = source.split("/")[2:4]
        by_host.setdefault(host, []).append(chance[i])
        by_path.setdefault((host, path), []).append(chance[i])
    strength, prior = _moments(by_host, lambda name: None)
    path_strength, _ = _moments(by_path, lambda name: name[0])
    for i, _, source, _ in rows:
        host, path = source.split("/")[2:4]
        above = (strength * prior + sum(by_host[host]) - chance[i]) / (strength + len(by_host[host]) - 1)
        site = (path_strength * above + sum(by_path[host, path]) - chance[i]) / (path_strength + len(by_path[host, path]) - 1)
        site = min(max(site, 1e-6), 1 - 1e-6)
        posterior = 1 / (1 + np.exp(-(np.log(site / (1 - site)) + got[i]["evidence"])))
        assert abs(got[i]["site"] - site) < 1e-6 and abs(got[i]["posterior"] - posterior) < 1e-6


def test_quality_leaves_columns_of_any_name_alone(spark):
    rows, labels = _quality_rows()
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    names = ["_q_host", "_q_f", "host", "path", "key", "f", "row", "z", "prior", "a.b"]
    table = table.withColumns({name: F.lit(n) for n, name in enumerate(names)})
    told = spark.createDataFrame(labels, "doc_id bigint, quality int")
    kept = quality.keep(table, told, quality.host_of(F.col("source")), quality.path_of(F.col("source")))
    assert kept.columns == table.columns
    assert {tuple(r)[4:] for r in kept.collect()} == {tuple(range(len(names)))}


def test_sites_shrink_by_their_size(spark):
    rng = np.random.default_rng(0)
    rows = [("big", "p", float(x)) for x in rng.beta(2, 6, 400)] + [("small", "p", 0.9), ("small", "q", 0.95)]
    rows += [(f"h{i}", "p", float(x)) for i in range(20) for x in rng.beta(6, 3, 20)]
    found = {(r["host"], r["path"]): r for r in quality.sites(spark.createDataFrame(rows, "host string, path string, p double")).collect()}
    big, small = found["big", "p"], found["small", "p"]
    shrunk = lambda r: (r["strength"] * r["prior"] + r["p_host"]) / (r["strength"] + r["n_host"])
    assert abs(shrunk(big) - big["p_host"] / 400) < 0.02 and small["prior"] < shrunk(small) < 0.925


def test_queries_and_pipeline_on_the_small_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    n = docs.count()
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = corpus_pipeline.materialise(stage(spark, kept, folder), "stage")
        assert kept.columns == docs.columns, name
        if name == "benchmark decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            clean = {int(k) for k, _, hits, _ in brute_search([(r["doc_id"], r["text"]) for r in before.collect()], items) if hits == 0}
            assert {r["doc_id"] for r in kept.collect()} == clean
        if name == "MinHash near-dedup":
            rows = [(r["doc_id"], r["text"]) for r in before.collect()]
            assert {r["doc_id"] for r in kept.collect()} == {least for _, _, least in _components(rows, 80)}
        if name == "PII":
            assert not any(pii.PATTERN.search(r["text"]) and "@mail" in r["text"] for r in kept.collect())
    last = corpus_pipeline.STAGES[-1][1](spark, kept, folder).collect()
    digest = {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in kept.collect()}
    assert {r["doc_id"]: r["decoded_sha256"] for r in last} == digest
    for name in ("op1_quality", "op7_pii", "op9_language"):
        assert queries.LLM_QUERIES[name](spark, folder).count() == n
