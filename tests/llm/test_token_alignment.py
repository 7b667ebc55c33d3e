"""Cross-tokenizer alignment against a plain computation with the same files."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from learnscope.llm import token_alignment as ta

TEXTS = [
    "The quick brown fox.", "the the the the", "Ünïcode wörds ❤ — dashes", " two  spaces\n\nlines\tand <|endoftext|> </s> <s>", "x", "a▁b is not given back", "日本語の文", "\u0000odd\x7f",
    "12345 67890 " * 30, "supercalifragilistic " * 5, "🙂🙃" * 9,
]


def brute(rows):
    """Links by comparing the offsets of both sides, with dictionaries only."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(ta.TOKENIZER_A)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=ta.TOKENIZER_B)
    printable = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c <= 255]
    back = {chr(c): c for c in printable} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in printable)}
    out, pairs = [], Counter()
    for key, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(back[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, map(b.id_to_piece, ids_b))]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            ids_a, ids_b, bytes_a, bytes_b = [], [], [], []
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        links = [(x, y) for x, e in zip(ids_a, ends_a) for y, f in zip(ids_b, ends_b) if e == f] if len(ids_a) < 2000 else None
        at_b = dict(zip(ends_b, ids_b))
        fast = [(x, at_b[e]) for x, e in zip(ids_a, ends_a) if e in at_b]
        assert links is None or links == fast
        groups, last = [], 0
        for e in sorted(set(ends_a) & set(ends_b)):
            part = [",".join(str(i) for i, f in zip(ids, ends) if last < f <= e) for ids, ends in ((ids_a, ends_a), (ids_b, ends_b))] if links is not None else None
            groups.append(part and "|".join(part))
            last = e
        pairs.update(fast)
        sha = (hashlib.sha256(";".join(groups).encode()).hexdigest() if ids_a else "") if links is not None else None
        out.append((key, len(ids_a), len(ids_b), len(groups), fast, sha))
    top = defaultdict(int)
    for (_, y), n in pairs.items():
        top[y] = max(top[y], n)
    return [(k, n_a, n_b, g, len(l), sum(pairs[x] == top[x[1]] for x in l), sum(pairs[x] for x in l), sha) for k, n_a, n_b, g, l, sha in out]


def got(docs, **options):
    return sorted((tuple(r) for r in ta.alignment(docs, **options).collect()), key=str)


def test_matches_plain_computation(make, odd):
    rows = [(r[0], r[1]) for r in odd if r[0] != 6] + [(100 + i, t) for i, t in enumerate(TEXTS)] + [(100 + i % 7, t * 2) for i, t in enumerate(TEXTS)]
    want = sorted(brute(rows), key=str)
    assert got(make(rows)) == want
    assert sum(w[1] == 0 for w in want) >= 4  # null, empty, not given back
    # many small blocks and runs of one task
    assert got(make(rows, clash=True, parts=1), cells=3, run_links=40, run_docs=3) == want
    assert got(make(rows).limit(0)) == []


def test_ids_are_those_of_the_file_on_all_kinds_of_characters():
    """A seventh of all code points here, in several surroundings, and mixed texts."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(ta.TOKENIZER_A)
    whole.encode_special_tokens = True
    with open(ta.TOKENIZER_A, "rb") as f:
        a = ta.byte_level_vocabulary(f.read())
    rng = random.Random(2)
    bits = [" ", "  ", "\n", "\t ", "\x1c", "\x85", "\xa0", "\u180e", "\u2003", "\u200b", "it's", "'ll", "don't ", "42", "x9", "!?", "é", "日本", "🙂", "<|endoftext|>", "word", " Word", "\r\n", "ſ", "Ⅷ", "\u0301", "٣"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(3000)] + TEXTS
    texts += [f"a{c}{c}1{c} {c}! {c}" for c in map(chr, range(0, 0x110000, 7)) if not 0xD800 <= ord(c) < 0xE000]
    texts += [" " * 3_000_000, "\n" * 49_000 + "x", "x" * 100_000, "!" * 100_000]
    assert a.encode(texts) == [whole.encode(" " + t, add_special_tokens=False).ids for t in texts]


def test_long_text_and_hot_pair(make):
    """A third of all links are one pair, and one text is larger than a block."""
    rows = [(i, "the " * 400) for i in range(12)] + [(50, " ".join(f"w{i % 997}x{i % 13}" for i in range(20_000)))] + [(60 + i, f"the w{i}") for i in range(30)]
    want = {r[0]: r for r in brute(rows)}
    for r in got(make(rows)):
        assert r[:7] == want[r[0]][:7] and (want[r[0]][7] is None or r[7] == want[r[0]][7])


def test_heap_merge_counts():
    rng = np.random.default_rng(0)
    runs = []
    for _ in range(9):
        codes, n = np.unique(rng.integers(0, 500, 300), return_counts=True)
        runs.append((codes, n))
    code, count, best = ta.merge_runs(runs, 10)
    want = Counter()
    for c, n in runs:
        want.update(dict(zip(c.tolist(), n.tolist())))
    assert dict(zip(code.tolist(), count.tolist())) == want and (np.diff(code) > 0).all()
    top = {b: max(n for c, n in want.items() if c // 10 == b) for b in {c // 10 for c in want}}
    assert best.tolist() == [want[c] == top[c // 10] for c in code.tolist()]
    assert [len(x) for x in ta.merge_runs([], 10)] == [0, 0, 0]


def test_spelling_of_ids():
    text, length = ta.spell(np.array([0, 7, 10, 50256, 999]), np.frombuffer(b",|;,;", np.uint8))
    assert text.tobytes() == b"0,7|10;50256,999;" and length.tolist() == [2, 2, 3, 6, 4]
    assert [len(x) for x in ta.spell(np.empty(0, np.int64), np.empty(0, np.uint8))] == [0, 0]


def test_missing_file_says_so(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ta.vocabularies(spark, str(tmp_path / "none.json"))
