"""Classifier, licences, mix, rules, decontamination, token counts, pipeline."""

import json
import os
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from learnscope.llm import decontaminate, license_scan, nbsvm, quality_cascade, queries, source_mix, token_counts

SF = "/root/testdata/sf0.001"


# ---- classifier


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    out = queries.op1_quality_classifier(spark, sf)
    got = out.join(nbsvm.one_label(spark.read.parquet(f"{sf}/labels.parquet")), "doc_id").filter("held_out").toPandas()
    assert (got.predicted == got.label).mean() > 0.95
    good, bad = got.score[got.label == 1].to_numpy(), got.score[got.label == 0].to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.98
    assert (got.predicted[got.label == 1] == 1).mean() > 0.97


def test_classifier_odd_rows(make, odd):
    docs = make(odd, clash=True)
    labels = docs.select("doc_id", F.lit(1).alias("quality")).filter("doc_id > 4")
    one_class = nbsvm.fit(docs, nbsvm.one_label(labels))
    assert one_class is None
    assert {r["score"] for r in nbsvm.score(docs, None).collect()} == {0.5}
    both = nbsvm.fit(docs, docs.filter("doc_id > 3").select("doc_id", (F.col("doc_id") % 2).alias("label")).distinct())
    got = nbsvm.score(docs, both).collect()
    assert len(got) == len(odd) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2)}) == 1  # null and empty: the bias alone
    kept = nbsvm.keep(docs, both, 0.0)
    assert kept.columns == docs.columns and kept.count() == len(odd)
    assert nbsvm.score(make([]), both).count() == 0


def test_dual_descent_separates():
    rng = np.random.default_rng(0)
    rows = [np.unique(np.concatenate([rng.integers(0, 500, 20), [1000 + y]])) for y in [0, 1] * 60]
    y = np.array([-1, 1] * 60)
    values = [np.full(len(r), 1 / np.sqrt(len(r))) for r in rows]
    w = nbsvm.dual_descent(rows, values, y, np.full(120, 5.0))
    assert all(np.sign(w[r] @ v + w[-1]) == t for r, v, t in zip(rows, values, y))


# ---- licences


def test_whole_licences_are_known(spark, make):
    folder = "/usr/share/common-licenses"
    names = {"Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0"}
    if not all(os.path.exists(f"{folder}/{f}") for f in names):
        pytest.skip("no licence texts on this machine")
    texts = []
    for f in names:
        with open(f"{folder}/{f}", encoding="utf-8") as t:
            texts.append("  ".join(t.read().upper().split(" ")))
    docs = make([*enumerate(texts), (99, texts[0] + " and more")])
    got = {r["doc_id"]: r["license"] for r in license_scan.scan(docs, license_scan.known_digests(spark)).collect()}
    assert got == {**dict(enumerate(names.values())), 99: None}


def test_license_sql_knows_whole_licences(spark, make):
    import duckdb

    from learnscope.llm import sql

    texts = []
    for f in ("Apache-2.0", "GPL-3", "MPL-2.0"):
        path = f"/usr/share/common-licenses/{f}"
        if not os.path.exists(path):
            pytest.skip("no licence texts on this machine")
        with open(path, encoding="utf-8") as t:
            texts.append(t.read())
    rows = [*enumerate(texts), (8, "plain"), (9, None)]
    got = {r["doc_id"]: (r["license"], r["canonical_sha256"]) for r in license_scan.scan(make(rows), license_scan.known_digests(spark)).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.execute(f"SELECT doc_id, license, canonical_sha256 FROM ({sql.op2_license_scan})").fetchall()
    assert got == {i: (name, digest) for i, name, digest in want}
    assert [got[i][0] for i in range(3)] == ["Apache-2.0", "GPL-3.0", "MPL-2.0"]


def test_license_digests(spark, make, odd):
    mit = dict(license_scan.KNOWN)["MIT"]
    noisy = "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(",", " ,")
    docs = make([*odd, (20, noisy), (21, mit + " extra"), (22, "© 2021 only a notice")], clash=True)
    known = license_scan.known_digests(spark)
    got = {r["doc_id"]: r for r in license_scan.scan(docs, known).collect()}
    assert got[20]["license"] == "MIT" and got[21]["license"] is None
    assert got[22]["canonical_length"] == 0 and got[22]["license"] is None and got[1]["license"] is None
    assert license_scan.scan(docs, known).count() == len(odd) + 3
    table = license_scan.digests(make([(1, "a\nReleased under the MIT License!\nreleased under the mit license\nb"), *odd]), known)
    assert table.count() == len(odd) + 1
    lines = license_scan.license_lines(table, known).collect()
    assert [(r["doc_id"], r["license"], r["n_lines"]) for r in lines] == [(1, "MIT line", 2)]
    whole = {r["doc_id"]: r["canonical_sha256"] for r in license_scan.scan(docs, known).collect()}
    assert all(whole[r["doc_id"]] == r["canonical_sha256"] for r in license_scan.digests(docs, known).collect())
    assert license_scan.scan(make([]), known).count() == 0


def test_neighbouring_spellings_are_both_unified(spark):
    df = spark.createDataFrame([("Favour favour, licence LICENCE sub\nlicense",), ("favor favor license license sublicense",)], "t string")
    assert len({r[0] for r in df.select(license_scan.canonical(F.col("t"))).collect()}) == 1


# ---- mix


def test_water_fill_by_hand():
    assert source_mix.water_fill([10, 100, 100], [5, 2, 1], Fraction(315), 2) == [20, Fraction(590, 3), Fraction(295, 3)]
    assert sum(source_mix.water_fill([3, 0, 9, 1], [5, 2, 1, 5], Fraction(39, 2), 2)) == Fraction(39, 2)


def test_flow_prefers_first_uses():
    # two sources share one pattern; a second use of pattern 0 is dearer than the first use of pattern 1
    flow = source_mix.min_cost_flow([10, 10], [[0], [0, 1]], [15, 5], 2)
    assert flow == [[10], [5, 5]]
    flow = source_mix.min_cost_flow([10, 10], [[0], [0, 1]], [25, 10], 2)
    assert sum(flow[0]) + sum(flow[1]) == 35 and sum(flow[1]) <= 20


def _unit_flow(supply, members, quota, most):
    """(total, cost) by cheapest single units, each found by relaxing all edges."""
    p_n, end = len(supply), len(supply) + len(quota)
    edges = [[-1, p, supply[p], r] for p in range(p_n) for r in range(most)]
    edges += [[p, p_n + s, most * supply[p], 0] for p, own in enumerate(members) for s in own]
    edges += [[p_n + s, end, q, 0] for s, q in enumerate(quota)]
    edges = [e for a, b, c, w in edges for e in ([a, b, c, w], [b, a, 0, -w])]
    total = cost = 0
    while True:
        dist, back = {-1: 0}, {}
        for _ in range(end + 2):
            for i, (a, b, c, w) in enumerate(edges):
                if c and a in dist and dist[a] + w < dist.get(b, 10**9):
                    dist[b], back[b] = dist[a] + w, i
        if end not in dist:
            return total, cost
        total, cost, b = total + 1, cost + dist[end], end
        while b != -1:
            edges[back[b]][2] -= 1
            edges[back[b] ^ 1][2] += 1
            b = edges[back[b]][0]


def test_flow_is_cheapest():
    rng = random.Random(4)
    for _ in range(60):
        p_n, s_n, most = rng.randint(1, 5), rng.randint(1, 4), rng.randint(1, 3)
        supply = [rng.randint(0, 6) for _ in range(p_n)]
        members = [sorted(rng.sample(range(s_n), rng.randint(0, s_n))) for _ in range(p_n)]
        quota = [rng.randint(0, 9) for _ in range(s_n)]
        flow = source_mix.min_cost_flow(supply, members, quota, most)
        used = [sum(f) for f in flow]
        assert all(u <= most * x for u, x in zip(used, supply))
        got = [sum(f[own.index(s)] for f, own in zip(flow, members) if s in own) for s in range(s_n)]
        assert all(g <= q for g, q in zip(got, quota))
        cost = sum(sum(r * max(0, min(x, u - r * x)) for r in range(most)) for u, x in zip(used, supply))
        assert (sum(used), cost) == _unit_flow(supply, members, quota, most)


def test_flow_with_very_many_sources():
    rng = random.Random(6)
    n = 20_000
    supply, quota = [rng.randint(0, 10**9) for _ in range(n)], [rng.randint(0, 10**9) for _ in range(n)]
    flow = source_mix.min_cost_flow(supply, [[s] for s in range(n)], quota, 2)
    assert flow == [[min(q, 2 * x)] for q, x in zip(quota, supply)]
    both = [[s, (s * 7 + 1) % n] for s in range(n)]  # every document in two sources
    flow = source_mix.min_cost_flow(supply, both, [x // 2 for x in supply], 2)
    assert sum(map(sum, flow)) == sum(x // 2 for x in supply)


def test_mix_meets_quotas(make, odd, spark):
    rng = random.Random(2)
    rows = [(100 + i, "w " * rng.randint(0, 300), rng.choice("abcdef")) for i in range(300)]
    docs = make([*odd, *rows], clash=True)
    got = queries.mixed(docs).collect()
    assert len(got) == len(odd) + 300
    total = sum(r["size"] for r in got)
    by = {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by.setdefault(r["source"], []).append(r)
    assert abs(sum(r["taken"] for r in got) - 1.5 * total) <= len(by)
    for own in by.values():
        assert own[0]["source_size"] == sum(r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 0.5 + 1e-6 or own[0]["source_size"] == 0
    again = {(r["doc_id"], r["taken"]) for r in queries.mixed(docs.repartition(7)).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in got}
    assert queries.mixed(make([])).count() == 0


def test_overlapping_sources(spark):
    docs = spark.createDataFrame([(i, 10, ["a"] if i % 3 else ["a", "b"]) for i in range(30)], "doc_id long, size long, sources array<string>")
    taken, sources = source_mix.mix(docs, share=Fraction(1), weights={"a": 1, "b": 1})
    routed = {r["source"]: (r["quota"], r["routed"]) for r in sources.collect()}
    assert all(q == x for q, x in routed.values())
    assert sum(r["taken"] for r in taken.collect()) == sum(x for _, x in routed.values()) == 300


# ---- rules


def brute_measures(t):
    import re

    t = t or ""
    w = t.encode().split()
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i: i + 8]), []).append(i)
    covered = {p for v in at.values() if len(v) > 1 for i in v for p in range(i, i + 8)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        dup += bool(re.search("[^\x20\x09-\x0d]", line)) and line in seen
        seen.add(line)
    return (len(w), sum(len(x.decode()) for x in w), sum(t.count(c) for c in "#*$%&|<>"), dup, len(covered))


def test_measures_equal_brute_force(make, odd):
    rng = random.Random(4)
    rows = [(100 + i, "".join(rng.choice(["a ", "b ", "c\n", "é ", "$", "\t", "a b a b a b a b "]) for _ in range(rng.randint(0, 80)))) for i in range(120)]
    docs = make([*odd, *rows], clash=True)
    got = quality_cascade.measures(docs).select("doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert len(got) == len(odd) + 120
    for r in got:
        assert tuple(r)[2:] == brute_measures(r["text"]), r["doc_id"]


def test_verdict_does_not_depend_on_order(make, odd):
    docs = make(odd)
    rules = quality_cascade.default_rules()
    m = quality_cascade.measures(docs)
    order = quality_cascade.plan(docs, rules, fraction=1.0)
    assert sorted(x["rule"] for x in order) == sorted(n for n, _ in rules)
    assert all(a["rank"] >= b["rank"] for a, b in zip(order, order[1:]))
    a = m.select(quality_cascade.verdict(rules, order).isNull().alias("k")).collect()
    b = m.select(quality_cascade.verdict(rules, order[::-1]).isNull().alias("k")).collect()
    assert sum(r["k"] for r in a) == sum(r["k"] for r in b)
    assert quality_cascade.cascade(make([])).count() == 0


def test_cascade_is_native(make, odd):
    plan = quality_cascade.cascade(make(odd))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---- decontamination


def edit(words, rng, share):
    return [f"z{rng.randint(0, 99)}" if rng.random() < share else w for w in words]


def test_copies_are_found_and_chance_is_not(make, spark):
    rng = random.Random(6)
    voc = [f"v{i}" for i in range(300)]
    items = [[rng.choice(voc) for _ in range(rng.randint(18, 45))] for _ in range(30)]
    bench = spark.createDataFrame([(i, (" ".join(w)).capitalize() + ".") for i, w in enumerate(items)], "item_id long, text string")
    docs, want = [], set()
    for i in range(200):
        w = [rng.choice(voc) for _ in range(rng.randint(0, 200))]
        if i % 5 == 0:
            k = rng.randrange(30)
            w[5:5] = edit(items[k], rng, 0.15 if i % 10 else 0.0)
            want.add((i, k))
        docs.append((i, " ".join(w).upper() if i % 3 else ", ".join(w)))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find(make(docs, clash=True), bench).collect()}
    assert got == want
    kept = decontaminate.drop_contaminated(make(docs, clash=True), bench)
    assert {r["doc_id"] for r in kept.collect()} == set(range(200)) - {d for d, _ in want}


def test_alignment_against_brute_force():
    def brute(a, b):
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
        return max(max(r) for r in h)

    rng = np.random.default_rng(3)
    for _ in range(30):
        item = rng.integers(0, 5, rng.integers(1, 15)).astype(np.uint64)
        texts = [rng.integers(0, 5, rng.integers(1, 30)).astype(np.uint64) for _ in range(5)]
        best, _ = decontaminate.align(item, texts)
        assert best.tolist() == [brute(item.tolist(), t.tolist()) for t in texts]


def test_every_passage_above_the_threshold_is_found(make, spark):
    rng = random.Random(16)
    voc = [f"v{i}" for i in range(400)]
    items = [[rng.choice(voc) for _ in range(n)] for n in [*range(1, 12), *(rng.randint(18, 50) for _ in range(20))]]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    docs, regular = [], set()
    for i, item in enumerate(items):
        for n in (3, 4, 5, 6):  # every n-th word replaced
            regular |= {(len(docs), i)} if len(item) >= 18 else set()
            docs.append([f"q{len(docs)}x{j}" if j % n == n - 1 else w for j, w in enumerate(item)])
        docs.append([y for j, w in enumerate(item) for y in ((w, "new") if j % 2 else (w,))])  # a word put in after every second
        docs.append([y for w in item for y in (w, "new")])  # and after every word
        docs.append([w for j, w in enumerate(item) if j % 3])  # every third left out
        for share in (0.2, 0.3, 0.45):
            docs.append(edit(item, rng, share))
        docs.append(item[: len(item) // 2] + [rng.choice(voc) for _ in range(10)])
    docs = [[*rng.choices(voc, k=rng.randint(0, 30)), *w, *rng.choices(voc, k=rng.randint(0, 30))] for w in docs]
    words = {w: np.uint64(i) for i, w in enumerate({w for t in [*docs, *items] for w in t})}
    coded = [np.array([words[w] for w in t], np.uint64) for t in docs]
    want = {}
    for i, item in enumerate(items):
        best, _ = decontaminate.align(np.array([words[w] for w in item], np.uint64), coded)
        for d, b in enumerate(best.tolist()):
            if b >= max(0.8 * len(item), min(2 * len(item), 12)):
                want[d, i] = b / (2 * len(item))
    assert regular <= want.keys()
    got = decontaminate.find(make([(d, " ".join(t)) for d, t in enumerate(docs)]), bench)
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in got.collect()} == want


def test_decontamination_odd_rows(make, odd, spark):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "Ünïcode WÖRDS ❤ and — dashes."), (3, "x")], "item_id long, text string")
    got = decontaminate.find(make(odd, clash=True), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(7, 3), (8, 3)} and len(got) == 2
    assert decontaminate.find(make([]), bench).count() == 0
    assert decontaminate.find(make(odd), bench.filter("false")).count() == 0
    assert decontaminate.drop_contaminated(make(odd), bench.filter("false")).count() == len(odd)


# ---- token counts


def test_histogram_answers_every_limit(spark, make, odd):
    rows = [(100 + i, "ab cd " * (i % 37)) for i in range(200)]
    docs = make([*odd, *rows], clash=True)
    by_words = lambda texts: [len(t.split()) for t in texts]
    sums = token_counts.suffix_sums(token_counts.length_histogram(docs, by_words)).collect()
    lengths = sorted(len((r[1] or "").split()) for r in [*odd, *rows])
    assert {r["length"] for r in sums} == set(lengths)
    for r in sums:
        n = r["length"]
        assert r["docs_from"] == sum(x >= n for x in lengths) and r["tokens_from"] == sum(x for x in lengths if x >= n)
        assert r["truncated_tokens"] == sum(min(x, n) for x in lengths) and r["total_tokens"] == sum(lengths)
        assert r["quantile"] == pytest.approx(sum(x <= n for x in lengths) / len(lengths))
    table = token_counts.suffix_sums(token_counts.length_histogram(docs, by_words))
    for r in token_counts.at_limits(table, [0, 7, 1000, 10**9]).collect():
        assert r["kept_tokens"] == sum(min(x, r["context"]) for x in lengths)
        assert r["lost_tokens"] == sum(lengths) - r["kept_tokens"]
    q = {r["share"]: r["length"] for r in token_counts.quantiles(table, [0.5, 1.0]).collect()}
    assert q[1.0] == lengths[-1] and q[0.5] == lengths[(len(lengths) + 1) // 2 - 1]
    assert token_counts.suffix_sums(token_counts.length_histogram(make([]), by_words)).count() == 0


def test_tokenizer_lengths(spark):
    tokenizers = pytest.importorskip("tokenizers")
    texts = ["Hello world <|endoftext|>", "", "naïve café 123\n\n  x", "日本語"]
    t = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    assert token_counts.rank_file_encoder(spark)(texts) == [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


# ---- pipeline


def test_pipeline(spark, make, odd, tmp_path):
    import corpus_pipeline as P

    assert [n for n, _ in P.STAGES] == ["quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "mixing sources to target weights"]
    sf = str(tmp_path)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs.unionByName(make(odd).select(*docs.columns)).write.parquet(f"{sf}/documents.parquet")
    labels.write.parquet(f"{sf}/labels.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{sf}/benchmark.parquet")
    d, sizes = spark.read.parquet(f"{sf}/documents.parquet"), []
    for k, (_, f) in enumerate(P.STAGES):
        f(spark, d, sf).write.parquet(f"{sf}/{k}")
        d = spark.read.parquet(f"{sf}/{k}")
        sizes.append(d.count())
        if k < 4:
            assert d.columns == docs.columns
    assert sizes[0] == sizes[1] >= sizes[2] >= sizes[3] == sizes[4] > 0
    good = labels.filter("quality = 1").join(spark.read.parquet(f"{sf}/0"), "doc_id", "left_anti").count()
    assert good <= 0.05 * labels.filter("quality = 1").count()
    ran = sorted(json.dumps(r.asDict()) for r in P.run(spark, sf).collect())
    assert ran == sorted(json.dumps(r.asDict()) for r in d.collect())


def test_pipeline_stages_on_an_empty_table(spark, make):
    import corpus_pipeline as P

    for _, f in P.STAGES:
        assert f(spark, make([]), SF).count() == 0
