"""Substring, line and near-duplicate operators against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from learnscope.llm import bwt_dedup, line_templates, recompression, simhash_vptree


def sha(b):
    return hashlib.sha256(b).hexdigest()


def brute_words(docs, n=13):
    first = {}
    for d, t in docs:
        w = (t or "").encode().split()
        for i in range(len(w) - n + 1):
            k = tuple(w[i: i + n])
            first[k] = d if d is not None and (k not in first or d < first[k]) else first.get(k, float("inf"))
    out = []
    for d, t in docs:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if d is not None and first[tuple(w[i: i + n])] < d:
                gone[i: i + n] = [True] * n
        out.append((d, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out, key=str)


def brute_bytes(docs, n=50):
    first = {}
    for d, t in docs:
        b = (t or "").encode()
        for i in range(len(b) - n + 1):
            k = b[i: i + n]
            first[k] = d if d is not None and (k not in first or d < first[k]) else first.get(k, float("inf"))
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - n + 1):
            if d is not None and first[b[i: i + n]] < d:
                gone[i: i + n] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((d, len(b), int(gone.sum()), runs, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return sorted(out, key=str)


def corpus(seed, n=150):
    rng = random.Random(seed)
    words = [["a", "b"], ["a", "b", "c", "aa"], [f"w{i}" for i in range(200)]]
    passages = [" ".join(rng.choice(words[2]) for _ in range(rng.randint(12, 40))) for _ in range(6)]
    docs = []
    for i in range(n):
        t = " ".join(rng.choice(words[i % 3]) for _ in range(rng.randint(0, 70)))
        if i % 4 == 0:
            t += "  " + rng.choice(passages) + "\n" + t[: rng.randint(0, 30)]
        docs.append((i * 3 % 1009, t))
    return docs + [(2000 + i, "a " * (5 * i)) for i in range(12)] + [(3000 + i, passages[0] * 2) for i in range(40)]


@pytest.mark.parametrize("seed", [1, 2])
def test_recompression_equals_brute_force(make, seed):
    docs = corpus(seed)
    got = recompression.dedup(make(docs, clash=True)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_words(docs)


def test_recompression_other_window(make):
    docs = corpus(3)
    got = recompression.dedup(make(docs), window=5).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_words(docs, 5)


@pytest.mark.parametrize("seed", [1, 2])
def test_bwt_equals_brute_force(make, seed):
    docs = corpus(seed)
    got = bwt_dedup.dedup(make(docs, clash=True)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_bytes(docs)


def test_bwt_in_small_blocks(make):
    docs = corpus(7, 80)
    got = bwt_dedup.dedup(make(docs), block=200).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_bytes(docs)


def test_interval_expansion_separates_exactly():
    rng = random.Random(5)
    for length in (3, 6):
        parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 40))) for _ in range(15)]
        text = np.frombuffer(b"\xff".join(parts) + b"\xff" * (length + 1), np.uint8)
        classes, raw, seen, back = bwt_dedup.common_prefix_classes(text, length), text.tobytes(), {}, {}
        for i in range(len(raw) - length):
            s = raw[i: i + length]
            if b"\xff" not in s:
                assert seen.setdefault(s, classes[i]) == classes[i] and back.setdefault(classes[i], s) == s


def test_substring_operators_on_odd_rows(make, odd):
    docs = [(r[0], r[1]) for r in odd]
    assert sorted((tuple(r) for r in recompression.dedup(make(odd)).collect()), key=str) == brute_words(docs)
    assert sorted((tuple(r) for r in bwt_dedup.dedup(make(odd)).collect()), key=str) == brute_bytes(docs)


def test_substring_operators_on_empty_table(make):
    assert recompression.dedup(make([])).count() == 0
    assert bwt_dedup.dedup(make([])).count() == 0


def test_same_id_with_different_texts(make):
    t = " ".join(f"q{i}" for i in range(20))
    docs = [(1, t), (2, "x " + t), (2, t + " y z")]
    assert sorted((tuple(r) for r in recompression.dedup(make(docs)).collect()), key=str) == brute_words(docs)
    assert sorted((tuple(r) for r in bwt_dedup.dedup(make(docs)).collect()), key=str) == brute_bytes(docs)


# ---- SimHash


def test_structured_long_words_do_not_meet(make):
    """Thue-Morse words and their complements have equal polynomial sums modulo
    2**64 in any base; documents that differ in such a word share no window."""
    bits = [0]
    while len(bits) < 4096:
        bits += [1 - b for b in bits]
    same = " ".join(f"w{i}" for i in range(12))
    rows, n = [], 0
    for size in (64, 512, 1024, 2048, 4096):
        a = "".join("ab"[b] for b in bits[:size])
        for word in (a, a.translate(str.maketrans("ab", "ba"))):
            n += 1
            rows.append((n, f"{word} {same} end{n}"))
    rows.append((50, rows[0][1]))
    got = sorted((tuple(r) for r in recompression.dedup(make(rows)).collect()), key=str)
    assert got == brute_words(rows)
    assert {r[0]: r[2] for r in got}[2] == 0


def test_texts_of_one_id_with_like_hashes(spark, make):
    """Texts whose hashes share their low 24 bits are still texts of their own."""
    texts = spark.range(40_000).select(F.format_string("%06d xyz xyz xyz xyz xyz", F.col("id")).alias("t"))
    low = F.xxhash64("t").bitwiseAND(F.lit((1 << 24) - 1))
    a, b = texts.groupBy(low.alias("h")).agg(F.collect_list("t").alias("t")).filter(F.size("t") > 1).first()["t"][:2]
    rows = [(1, a), (2, a), (2, b), (2, b[:20] + "q" * 40)]
    got = sorted((tuple(r) for r in bwt_dedup.dedup(make(rows), length=20).collect()), key=str)
    assert got == brute_bytes(rows, 20)
    assert len({r[2] for r in got}) > 1


def brute_fp(t):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
    grams = [b" ".join(w[i: i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def brute_components(docs):
    fp = [brute_fp(t) for _, t in docs]
    up = list(range(len(docs)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for i in range(len(docs)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 2:
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return sorted(((d, format(fp[i], "016x"), least.get(find(i))) for i, (d, _) in enumerate(docs)), key=str)


def test_simhash_equals_brute_force(make, odd):
    rng = random.Random(1)
    base = [[f"t{rng.randint(0, 400)}" for _ in range(80)] for _ in range(20)]
    docs = [(r[0], r[1]) for r in odd]
    for i in range(150):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(80)] = "Edited"
        docs.append((100 + i, " ".join(w)))
    docs += [(400 + i, f"short {i % 3}") for i in range(9)]
    got = simhash_vptree.near_duplicates(make(docs, clash=True)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(docs)


def test_vantage_shards_lose_no_link():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 2**63, 4000, dtype=np.int64).view(np.uint64)
    near = x[:1500] ^ (np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64))
    ball = np.full(1500, x[0]) ^ (np.uint64(1) << rng.integers(0, 12, 1500).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64))
    x = np.unique(np.concatenate([x, near, ball]))
    tree, shards = simhash_vptree.grow(x[::3], 100, 2, rng)
    assert shards > 10
    rows, shard = simhash_vptree.route(tree, x, 2)
    forest = simhash_vptree.Forest(len(x))
    for s in range(shards):
        own = np.sort(rows[shard == s])
        links = simhash_vptree.link_shard(x[own], 2)
        assert len(links) < max(1, len(own))
        forest.join((own[a], own[b]) for a, b in links)
    full = simhash_vptree.Forest(len(x))
    for i in range(0, len(x), 500):
        a, b = np.nonzero(np.bitwise_count(x[i: i + 500, None] ^ x[None, :]) <= 2)
        full.join(zip((a + i).tolist(), b.tolist()))
    assert [forest.find(i) for i in range(len(x))] == [full.find(i) for i in range(len(x))]


def test_chain_is_one_component_and_one_row_stays(make, spark):
    from pyspark.sql import functions as F

    links = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    roots = simhash_vptree.components(links).collect()
    assert {r["root"] for r in roots} == {0} and len(roots) == 60
    docs = make([(9, "same text of many words here"), (4, "same text of many words here"), (4, "same text of many words here"), (7, "quite another text in this row")], clash=True)
    kept = simhash_vptree.keep_first(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 7] and kept.columns == docs.columns


def test_simhash_empty(make):
    assert simhash_vptree.near_duplicates(make([])).count() == 0


# ---- line templates


def test_a_key_larger_than_a_block(make):
    rng = np.random.default_rng(12)
    noise = lambda n: bytes(rng.integers(97, 123, n, dtype=np.uint8)).decode()
    phrase, longer = noise(40), noise(8)
    docs = [(i, noise(60) + (longer if i % 9 == 0 else noise(8)) + phrase + (longer if i % 6 == 0 else noise(8)) + noise(60)) for i in range(120)]
    rows = make(docs).selectExpr("doc_id as doc", "text")
    keys = bwt_dedup.shared_keys(bwt_dedup.candidate_keys(rows, 50)).groupBy("doc").agg(F.collect_list("key").alias("keys"))
    parts = bwt_dedup.stretches(rows.withColumn("version", F.lit(0).cast("long")).join(keys, "doc").select("doc", "text", "version", "keys"), 50)
    found = bwt_dedup.removals(parts, 50, 1000)
    assert found.filter("bytes is not null").count() > 0  # not one block, whatever the number of documents
    assert sorted((tuple(r) for r in bwt_dedup.dedup(make(docs), block=1000).collect()), key=str) == brute_bytes(docs)


def test_recurring_templates_are_dropped(make):
    docs = [(i, f"{'abcdefgh'[i]} unique opening sentence of this text\nPage {i} of 10\nPosted by user{i} on Monday\nshort\nclosing {'hgfedcba'[i]} remark of the author") for i in range(8)]
    out = {r["doc_id"]: r for r in line_templates.drop_recurring(make(docs, clash=True)).collect()}
    assert out[0]["text"] == docs[0][1] and out[0]["_n_removed"] == 0
    for i in range(1, 8):
        assert out[i]["_n_removed"] == 2 and "Page" not in out[i]["text"] and "Posted" not in out[i]["text"]
        assert out[i]["text"].split("\n")[0] == docs[i][1].split("\n")[0] and "short" in out[i]["text"]


def test_variable_names_are_generalised(make):
    docs = [(i, f"Shared by the team member {n} in March") for i, n in enumerate(["ann", "bob", "cy", "dee", "ed", "flo"])]
    templates, _ = line_templates.recurring(make(docs))
    assert [(r["template"], r["n_docs"], r["first_doc"]) for r in templates.collect()] == [("Shared by the team member <*> in March", 6, 0)]


def test_a_leaf_keeps_several_templates(make):
    hot = [(i, "This article was first published on our main web site") for i in range(40)]
    names = [(100 + i, f"This article was written by {'abcdefghijklmnopqrstuvwxyz'[i % 26]}{'xyz'[i // 26]} for our weekly newsletter") for i in range(30)]
    third = [(200 + i, f"This article was reviewed twice before {'abcdefghijklmnopqrstuvwxyz'[i]} it appeared") for i in range(25)]
    fourth = [(300 + i, f"This article was last updated during {'abcdefghijklmnopqrstuvwxyz'[i]} late autumn") for i in range(26)]
    alone = [(400, "This article was q w e r t y u")]
    templates, drops = line_templates.recurring(make([*hot, *names, *third, *fourth, *alone]))
    assert {(r["template"], r["n_docs"], r["first_doc"]) for r in templates.collect()} == {
        ("This article was first published on our main web site", 40, 0),
        ("This article was written by <*> for our weekly newsletter", 30, 100),
        ("This article was reviewed twice before <*> it appeared", 25, 200),
        ("This article was last updated during <*> late autumn", 26, 300),
    }
    assert drops.count() == 39 + 29 + 24 + 25


def test_templates_on_odd_rows(make, odd):
    out = line_templates.drop_recurring(make(odd, clash=True)).collect()
    assert len(out) == len(odd)
    by = {r["doc_id"]: r for r in out}
    assert by[1]["text"] is None and by[1]["_n_lines"] == 0 and by[2]["_n_lines"] == 1
    assert all(r["_n_removed"] == 0 for r in out)
    assert line_templates.drop_recurring(make([])).count() == 0


def test_a_line_repeated_inside_one_document_stays(make):
    docs = [(1, "\n".join(["the same line again"] * 9))] + [(2 + i, f"other words {'xyzuv'[i]} here") for i in range(3)]
    assert all(r["_n_removed"] == 0 for r in line_templates.drop_recurring(make(docs)).collect())
