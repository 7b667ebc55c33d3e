"""Cross-tokenizer alignment by external spill counting.

Two tokenizers A and B cut the same bytes; where tokens of both end together,
the two are linked. How often a pair of ids is linked in the whole corpus says
how well the ids correspond.

1. Every text is encoded once. Links are gathered in blocks of about
   ``RUN_LINKS``; a full block is sorted by (cell, B id, A id, document), with
   the cell a radix of the B id, and each cell's part becomes one zstd run: its
   distinct pairs with their numbers, and the documents of its links. Runs and
   the documents' own results are one written table.
2. The pairs of all runs of a cell meet in one task, which merges the sorted runs
   with a heap. Equal pairs come one after another and are summed; as the order
   is by B id first, the greatest count of a B id is known when the next one
   begins. Each run gets an answer: the counts of its pairs, and which are best.
3. Answers meet the documents' part of their runs by block, where counts are added
   up for each document; no document's links are spread over blocks.

Only distinct pairs of a block move between blocks, so a pair or an id that holds
a third of all links sends one row a block. A task holds one cell's pairs (step
2) or one block (step 3): cells are ``4 x spark.sql.shuffle.partitions``, so their
number grows with the data as that setting does; at most one for each B id.

Defined cases: texts that are null, empty, or not given back byte by byte by both
vocabularies (after the space that B adds) have no tokens; their numbers are 0
and their digest is ''. Strings of special tokens are plain text. Repeated rows
count each. A text larger than a block is a block of its own. An empty table
gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, shuffle_partitions, slabs, text_or_empty
from .token_counts import PATTERN

TOKENIZER_A = "/opt/tokenizers/byte_bpe_50k.json"
TOKENIZER_B = "/opt/tokenizers/piece_bpe_32k.model"
RUN_LINKS = 1 << 20  # links of a block, at least (its last text is whole)
RUN_DOCS = 1 << 15  # documents of a block, at most
DEEP = 50_000  # white space characters in a row
_DEEP = re.compile(rf"\s{{{DEEP}}}")
RESULTS = ("n_a", "n_b", "n_groups", "n_links")

# ---- the two vocabularies ----------------------------------------------------


def _byte_level() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable
    ones for themselves, the others, in order, from code point 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(others)}}


class Vocabulary:
    """A tokenizer of texts to lists of ids, and the bytes of each id."""

    def __init__(self, encode, pieces: list[bytes]):
        self.encode, self.pieces = encode, pieces
        self.sizes = np.array([len(p) for p in pieces], np.int64)

    def spells(self, ids: list[int], text: bytes) -> bool:
        return b"".join(map(self.pieces.__getitem__, ids)) == text


def byte_level_vocabulary(data: bytes) -> Vocabulary:
    """The vocabulary of a byte-level file. Where its merges are numbered in the
    order they apply, as ranks, the faster encoder of ranks gives the same ids."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
    import tiktoken
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(data.decode())
    t.encode_special_tokens = True
    entries = t.get_vocab(with_added_tokens=True)
    back, pieces = _byte_level(), [b""] * (max(entries.values()) + 1)
    for entry, i in entries.items():
        pieces[i] = bytes(back[c] for c in entry) if all(c in back for c in entry) else entry.encode()
    model = json.loads(data)["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    n = len(model["vocab"]) - len(merges)
    if any(model["vocab"][x + y] != n + i for i, (x, y) in enumerate(merges)):
        return Vocabulary(lambda texts: [e.ids for e in t.encode_batch_fast([" " + x for x in texts], add_special_tokens=False)], pieces)

    def encode(texts: list[str]) -> list[list[int]]:
        # the pattern of the encoder of ranks needs a stack as deep as a run of white space is long
        deep = [len(x) >= DEEP and _DEEP.search(x) is not None for x in texts]
        return [t.encode(" " + x, add_special_tokens=False).ids if d else fast.encode_ordinary(" " + x) for x, d in zip(texts, deep)]

    ranks = {pieces[i]: i for i in model["vocab"].values()}
    fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return Vocabulary(encode, pieces)


def piece_vocabulary(data: bytes) -> Vocabulary:
    import sentencepiece

    s = sentencepiece.SentencePieceProcessor(model_proto=data)
    names = [s.id_to_piece(i) for i in range(s.get_piece_size())]
    pieces = [bytes([int(p[3:5], 16)]) if s.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
    return Vocabulary(lambda texts: s.encode(texts, num_threads=1), pieces)


_loaded: dict = {}


def vocabularies(spark: SparkSession, path_a: str = TOKENIZER_A, path_b: str = TOKENIZER_B):
    """A function that gives a task the two vocabularies. The driver reads the
    files (about 3 MB, whatever the data) and broadcasts them."""
    files = []
    for path in (path_a, path_b):
        with open(path, "rb") as f:
            files.append(f.read())
    shared = spark.sparkContext.broadcast(files)

    def load() -> tuple[Vocabulary, Vocabulary]:
        if (path_a, path_b) not in _loaded:
            a, b = shared.value
            _loaded[path_a, path_b] = byte_level_vocabulary(a), piece_vocabulary(b)
        return _loaded[path_a, path_b]

    return load


# ---- one text ----------------------------------------------------------------


@cache
def _digits(top: int) -> np.ndarray:
    """The decimal digits of the numbers below ``top``, 0 before the first one."""
    tens = 10 ** np.arange(len(str(top)) - 1, -1, -1)
    every = np.arange(top)[:, None]
    return np.where((every >= tens) | (tens == 1), every // tens % 10 + 48, 0).astype(np.uint8)


def spell(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decimal ids, each followed by its byte of ``ends``, as one byte array, and
    the length of each."""
    top = int(ids.max(initial=0)) + 1
    digits = _digits(1 << (top - 1).bit_length())
    cells = np.empty((len(ids), digits.shape[1] + 1), np.uint8)
    cells[:, :-1] = digits[ids]
    cells[:, -1] = ends
    shown = cells > 0
    return cells[shown], shown.sum(axis=1)


def align(a: np.ndarray, b: np.ndarray, docs_a: np.ndarray, docs_b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, n_docs: int):
    """Links and group spellings of some texts at once, from the ids of each side,
    their texts, and their bytes: (A ids, B ids, texts) of the links, and the
    bytes of all spellings with their lengths by text. Every token has bytes,
    so at most one of each side ends at an offset: a link for each group."""
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    at = np.zeros((2, int(size_a.sum()) + 1), bool)
    at[0, end_a], at[1, end_b] = True, True
    met_a, met_b = at[1, end_a], at[0, end_b]  # ends of texts are among them
    last_a, last_b = np.flatnonzero(met_a), np.flatnonzero(met_b)
    sep_a, sep_b = np.where(met_a, ord("|"), ord(",")), np.where(met_b, ord(";"), ord(","))
    # a group's A ids come after the B ids of those before, its B ids after its own A ids
    to_a = np.arange(len(a)) + np.concatenate([[0], last_b + 1])[np.cumsum(met_a) - met_a]
    to_b = np.arange(len(b)) + (last_a + 1)[np.cumsum(met_b) - met_b]
    ids, seps = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.uint8)
    ids[to_a], ids[to_b], seps[to_a], seps[to_b] = a, b, sep_a, sep_b
    text, length = spell(ids, seps)
    lengths = (np.bincount(docs, weights=length[to], minlength=n_docs).astype(np.int64) for docs, to in ((docs_a, to_a), (docs_b, to_b)))
    return a[last_a], b[last_b], docs_a[last_a], text, sum(lengths)


# ---- runs --------------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(b"".join(a.tobytes() for a in arrays))


def unpack(data: bytes, kind) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def write_runs(codes: np.ndarray, docs: np.ndarray, n_a: int, cells: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(cell, pairs, documents) of a block's links. Pairs are codes (B id first)
    in order, as steps, then how often each occurs; documents follow in the same
    order, each link one."""
    cell = codes // n_a % cells
    order = np.lexsort((codes, cell))  # stable: documents stay in order
    codes, docs, cell = codes[order], docs[order], cell[order]
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    n = np.diff(first, append=len(codes))
    cuts = np.flatnonzero(np.diff(cell[first], prepend=-1))
    for i, j in zip(cuts, [*cuts[1:], len(first)]):
        d = docs[first[i]: first[j - 1] + n[j - 1]]
        yield int(cell[first[i]]), pack(np.diff(codes[first[i:j]], prepend=0), n[i:j]), pack(d.astype(np.uint16))


def read_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = unpack(data, np.int64).reshape(2, -1)
    return np.cumsum(both[0]), both[1]


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray]], n_a: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, count, best) of every pair of some runs, merged with a heap: equal
    codes follow each other, and so do the pairs of a B id."""
    code, count, best = [], [], []
    n_bits = np.uint64(32)
    streams = (((c.astype(np.uint64) << n_bits) | n.astype(np.uint64)).tolist() for c, n in runs)
    merged = heapq.merge(*streams)
    begun, top, side = 0, 0, None
    for pair, same in groupby(merged, lambda x: x >> 32):
        total = sum(x & 0xFFFFFFFF for x in same)
        if pair // n_a != side:
            best += [c == top for c in count[begun:]]
            begun, top, side = len(count), 0, pair // n_a
        top = max(top, total)
        code.append(pair)
        count.append(total)
    best += [c == top for c in count[begun:]]
    return np.array(code, np.int64), np.array(count, np.int64), np.array(best, bool)


# ---- the operator ------------------------------------------------------------

_LISTS = [T.StructField(c, T.ArrayType(T.LongType())) for c in RESULTS]


def _run_table(docs: DataFrame, load, cells: int, text: str, key: str, run_links: int, run_docs: int) -> DataFrame:
    """(block, cell, pairs, docs) of every run, and one row with cell -1 for each
    block: the keys and results of its documents."""
    kind = docs.schema[key].dataType
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("cell", T.IntegerType()), T.StructField("pairs", T.BinaryType()), T.StructField("docs", T.BinaryType()),
        T.StructField("keys", T.ArrayType(kind)), *_LISTS, T.StructField("sha", T.ArrayType(T.StringType())),
    ])
    rows = docs.select(F.col(f"`{key}`").alias("key"), text_or_empty(text).alias("text"))

    def run(batches):
        a, b = load()
        n_a = len(a.pieces)
        block, arrow = TaskContext.get().partitionId() << 32, None
        held: dict = {}

        def clear():
            held.update(codes=[], docs=[], keys=[], sha=[], size=0, links=0, **{c: [] for c in RESULTS})

        def flush():
            parts = list(write_runs(np.concatenate(held["codes"]), np.concatenate(held["docs"]), n_a, cells)) if held["links"] else []
            none = [None] * len(parts)
            lists = [pa.array([np.concatenate(held[c]), *none], pa.list_(pa.int64())) for c in RESULTS]
            keys = pa.chunked_array(held["keys"]).combine_chunks()
            keys = pa.ListArray.from_arrays(pa.array([0, *[len(keys)] * (1 + len(parts))], pa.int32()), keys)
            yield pa.record_batch(
                [
                    pa.array([block] * (1 + len(parts)), pa.int64()), pa.array([-1, *(p[0] for p in parts)], pa.int32()),
                    pa.array([None, *(p[1] for p in parts)], pa.binary()), pa.array([None, *(p[2] for p in parts)], pa.binary()),
                    keys, *lists, pa.array([held["sha"], *none], pa.list_(pa.string())),
                ],
                names=schema.names,
            )
            clear()

        clear()
        for batch in batches:
            for at, _, _ in slabs(batch):
                for begin in range(at.start, at.stop, run_docs):
                    part = batch.slice(begin, min(at.stop - begin, run_docs))
                    if held["size"] + part.num_rows > run_docs:
                        yield from flush()
                        block += 1
                    link_a, link_b, of, n, sha = _encoded(part.column(1).to_pylist(), a, b)
                    held["codes"].append(link_b * n_a + link_a)
                    held["docs"].append(of + held["size"])
                    held["keys"].append(part.column(0))
                    held["sha"] += sha
                    for c, x in zip(RESULTS, n):
                        held[c].append(x)
                    held["size"] += part.num_rows
                    held["links"] += len(of)
                    if held["links"] >= run_links:
                        yield from flush()
                        block += 1
        if held["size"]:
            yield from flush()

    return rows.mapInArrow(run, schema)


def _encoded(texts: list[str], a: Vocabulary, b: Vocabulary):
    """(A ids, B ids, texts) of the links, the four numbers of each text, and the
    digests of their groups."""
    n = len(texts)
    ids_a, ids_b = a.encode(texts), b.encode(texts)
    whole = [(" " + t).encode() if t else None for t in texts]
    good = [w is not None and a.spells(x, w) and b.spells(y, w) for w, x, y in zip(whole, ids_a, ids_b)]
    ids_a, ids_b = ([x if g else [] for x, g in zip(ids, good)] for ids in (ids_a, ids_b))
    n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
    flat_a, flat_b = (np.concatenate([np.array(x, np.int64) for x in ids]) for ids in (ids_a, ids_b))
    docs_a, docs_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
    link_a, link_b, of, spelled, lengths = align(flat_a, flat_b, docs_a, docs_b, a.sizes[flat_a], b.sizes[flat_b], n)
    ends = np.cumsum(lengths)
    sha = [hashlib.sha256(spelled[e - k: e - 1].tobytes()).hexdigest() if k else "" for e, k in zip(ends.tolist(), lengths.tolist())]
    groups = np.bincount(of, minlength=n)
    return link_a, link_b, of, (n_a, n_b, groups, groups), sha


def _answers(runs: DataFrame, load, parts: int) -> DataFrame:
    """(block, cell, answer): for each run, twice the corpus-wide count of each of
    its pairs, plus 1 where it is its B id's highest."""
    met = runs.filter("cell >= 0").select("cell", "block", "pairs").repartition(parts, "cell").sortWithinPartitions("cell", "block")

    def merge(batches):
        n_a = len(load()[0].pieces)

        def answered(cell, blocks, data):
            pairs = [read_pairs(d) for d in data]
            code, count, best = merge_runs(pairs, n_a)
            for i in range(0, len(blocks), 256):
                out = [pack((count * 2 + best)[np.searchsorted(code, c)]) for c, _ in pairs[i: i + 256]]
                here = blocks[i: i + 256]
                yield pa.record_batch([pa.array(here, pa.int64()), pa.array([cell] * len(here), pa.int32()), pa.array(out, pa.binary())], names=["block", "cell", "answer"])

        now, blocks, data = None, [], []
        for batch in batches:
            for cell, block, d in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if cell != now:
                    if blocks:
                        yield from answered(now, blocks, data)
                    now, blocks, data = cell, [], []
                blocks.append(block)
                data.append(d)
        if blocks:
            yield from answered(now, blocks, data)

    return met.mapInArrow(merge, "block long, cell int, answer binary")


def alignment(
    docs: DataFrame, load=None, text: str = "text", key: str = "doc_id", cells: int | None = None, run_links: int = RUN_LINKS, run_docs: int = RUN_DOCS
) -> DataFrame:
    """One row per document: its key, the tokens of each side, groups, links, links
    whose count is their B id's highest, the sum of its links' counts, and the
    digest of its groups."""
    load = load or vocabularies(docs.sparkSession)
    parts = shuffle_partitions(docs)
    runs = materialize(_run_table(docs, load, cells or 4 * parts, text, key, run_links, run_docs), "alignment-runs")
    kind = docs.schema[key].dataType
    back = runs.select("*", F.lit(None).cast("binary").alias("answer")).unionByName(_answers(runs, load, parts), allowMissingColumns=True)
    back = back.select("block", "cell", "pairs", "docs", "answer", "keys", *RESULTS, "sha")
    back = back.repartition(parts, "block").sortWithinPartitions("block", "cell", F.col("answer").isNull())
    schema = T.StructType([T.StructField("key", kind), *(T.StructField(c, T.LongType()) for c in (*RESULTS, "n_best", "count_sum")), T.StructField("sha", T.StringType())])

    def finish(batches):
        head, best, total, answer = None, None, None, None

        def rows():
            return pa.record_batch([head["keys"], *(head[c] for c in RESULTS), pa.array(best), pa.array(total), head["sha"]], names=schema.names)

        for batch in batches:
            for i in range(batch.num_rows):
                cell = batch.column(1)[i].as_py()
                if cell < 0:
                    if head is not None:
                        yield rows()
                    head = {c: batch.column(batch.schema.get_field_index(c))[i].values for c in ("keys", *RESULTS, "sha")}
                    best, total = np.zeros(len(head["sha"]), np.int64), np.zeros(len(head["sha"]), np.int64)
                elif batch.column(4)[i].is_valid:
                    answer = unpack(batch.column(4)[i].as_py(), np.int64)
                else:
                    of = unpack(batch.column(3)[i].as_py(), np.uint16)
                    each = np.repeat(answer, read_pairs(batch.column(2)[i].as_py())[1])
                    best += np.bincount(of[each & 1 == 1], minlength=len(best))
                    np.add.at(total, of, each >> 1)
        if head is not None:
            yield rows()

    out = back.mapInArrow(finish, schema)
    return out.select(F.col("key").alias(key), *RESULTS, "n_best", "count_sum", F.col("sha").alias("groups_sha256"))
