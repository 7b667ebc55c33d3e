"""Quoted CSV files read in parallel, block by block.

A quoted cell may hold newlines, so where a block of a file begins, nothing tells
whether its first line begins a record or goes on inside a cell. Each block is
therefore read under both suppositions; what it does to them is a function of two
states. The functions of a file's blocks are combined in file order (one small row
a block), which gives every block's true first state, the number of records
before it, and the block in which a record begun earlier was opened. A second pass
cuts the blocks into records; pieces of records that cross blocks meet by (file,
opening block) and are joined (for them, the blocks that such records touch are read
once more; where there are none, nothing is).

Both passes take a batch of lines as one text. Where all its quotes stand at the ends
of cells or are doubled, they open and close in turns, and cells are cut out of the
text's bytes at the separators outside (:func:`ends_of`); other batches are read line
by line, by the same rules.

Lines come from Spark's text reader, which splits files at any byte and gives a
line to the block it begins in. Both passes name a block by its file and first
byte, so no row numbers of two scans are compared.

Cells follow the common rules: a quote opens a cell only at its start, a doubled
quote inside is one quote, what follows a closing quote is kept; unquoted empty
cells are null, quoted ones are empty texts. Blank lines between records, a byte
order mark, and the carriage return of a line end are dropped; a cell that is never
closed reaches to the end of its file. Files may differ in width without limit.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

QUOTED = re.compile(r'"([^"]*(?:""[^"]*)*)("?)([^,]*)')


def cells_of(record: str) -> tuple[list[str | None], bool]:
    """The cells of a record, and whether its last one is still open."""
    out: list[str | None] = []
    at, n = 0, len(record)
    while True:
        if record.startswith('"', at):
            m = QUOTED.match(record, at)
            out.append(m[1].replace('""', '"') + m[3])
            at, is_open = m.end(), not m[2]
        else:
            end = record.find(",", at)
            end = n if end < 0 else end
            out.append(record[at:end] or None)
            at, is_open = end, False
        if at >= n:
            return out, is_open
        at += 1


def open_after(line: str, is_open: bool) -> bool:
    """Whether a cell is open after a line, by whether one was before it."""
    if '"' not in line:
        return is_open
    return cells_of('"' + line if is_open else line)[1]


COMMA, NEWLINE, QUOTE = b',\n"'


def bytes_of(lines: pa.Array) -> np.ndarray:
    """The lines as one text, each with a newline after it."""
    n = len(lines)
    if pa.types.is_large_string(lines.type):
        lines = lines.cast(pa.string())
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, n + 1], pa.int32()), pa.concat_arrays([lines, pa.array([""])])), "\n")
    return np.frombuffer(text[0].as_buffer(), np.uint8)


def ends_of(text: np.ndarray, is_open: bool) -> tuple[np.ndarray, bool, np.ndarray] | None:
    """Where records end in a text of whole lines (their newlines), whether a cell is
    open after it, and where its quotes are; None if a quote stands elsewhere than at
    an end of a cell or beside another one of its cell."""
    quotes = np.flatnonzero(text == QUOTE)
    first = int(not is_open)  # the first quote that closes
    if len(quotes):
        opening, closing = quotes[1 - first::2], quotes[first::2]
        before = text[opening - 1]
        before[opening == 0] = NEWLINE
        for beside in (before, text[closing + 1]):  # the text ends in a newline
            if not ((beside == COMMA) | (beside == NEWLINE) | (beside == QUOTE)).all():
                return None
    return _outside(np.flatnonzero(text == NEWLINE), quotes, is_open), bool((len(quotes) + is_open) % 2), quotes


def _outside(at: np.ndarray, quotes: np.ndarray, is_open: bool) -> np.ndarray:
    return at[(np.searchsorted(quotes, at) + is_open) % 2 == 0]


def cut_cells(text: np.ndarray, ends: np.ndarray, quotes: np.ndarray, is_open: bool) -> pa.ListArray:
    """The cells of the records between a text's first byte (with ``is_open``: the one
    after its first end) and its last end, blank lines left out."""
    begin, ends = (int(ends[0]) + 1, ends[1:]) if is_open and len(ends) else (0, ends)
    if not len(ends):
        return pa.array([], pa.list_(pa.string()))
    starts = np.concatenate([[begin], ends[:-1] + 1])
    commas = _outside(begin + np.flatnonzero(text[begin: ends[-1]] == COMMA), quotes, is_open)
    stops = np.sort(np.concatenate([commas, ends]))
    froms = np.concatenate([[begin], stops[:-1] + 1])
    last = np.searchsorted(stops, ends)  # each record's last cell
    filled = starts < ends
    kept = np.ones(len(stops), bool)
    kept[last[~filled]] = False
    widths = np.diff(last, prepend=-1)[filled]
    froms, stops = froms[kept], stops[kept]
    quoted = text[froms] == QUOTE
    empty = ~quoted & (froms == stops)
    froms, stops = froms + quoted, stops - quoted
    # cells and what is between them, in turns: every second one is taken
    offsets = np.column_stack([froms, stops]).ravel().astype(np.int32)
    n = len(froms)
    if not n:
        return pa.array([], pa.list_(pa.string()))
    turns = pa.StringArray.from_buffers(2 * n - 1, pa.py_buffer(offsets), pa.py_buffer(text))
    cells = turns.take(pa.array(np.arange(n) * 2, mask=empty))
    if (np.diff(quotes) == 1).any():
        doubled = pc.fill_null(pc.match_substring(cells, '""'), False)
        if pc.any(doubled).as_py():
            cells = pc.replace_with_mask(cells, doubled, pc.replace_substring(cells.filter(doubled), '""', '"'))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(widths)]).astype(np.int32)), cells)


def _lines(spark: SparkSession, path: str | Sequence[str], recursive: bool, keep: Callable[[Column], Column] | None = None) -> DataFrame:
    """(file, block, id, line): ids increase inside a block, and mean nothing else.
    Files whose paths do not meet ``keep`` are not opened."""
    r = spark.read.option("lineSep", "\n")
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    t = r.text(path if isinstance(path, str) else list(path))
    if keep is not None:
        t = t.filter(keep(F.col("_metadata.file_path")))
    value, first = F.col("value"), F.col("_metadata.file_block_start") == 0
    line = F.regexp_replace(value, "\r$", "")
    line = F.when(first, F.regexp_replace(line, "^\ufeff", "")).otherwise(line)
    # patterns read a line as characters; most lines need none
    odd = F.contains(value, F.lit("\r")) | ~F.is_valid_utf8(value) | (first & F.startswith(value, F.lit("\ufeff")))
    return t.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"),
        F.when(odd, line).otherwise(value).alias("line"),
    )


def _runs(batches, n: int):
    """Stretches of one block: the values of its first ``n`` columns, and its lines."""
    for b in batches:
        if not b.num_rows:
            continue
        file, block = b.column(0), b.column(1).to_numpy()
        if block[0] == block[-1] and file[0] == file[b.num_rows - 1]:
            at = [0, b.num_rows]  # blocks do not lie in one another
        else:
            names = file.dictionary_encode().indices.to_numpy()
            at = [0, *(np.flatnonzero((np.diff(names) != 0) | (np.diff(block) != 0)) + 1).tolist(), b.num_rows]
        for i, j in zip(at, at[1:]):
            yield tuple(b.column(c)[i].as_py() for c in range(n)), b.column(n).slice(i, j - i)


def _text(part: np.ndarray) -> str:
    return part.tobytes().decode("utf-8")


def _summaries(lines: DataFrame) -> DataFrame:
    """One row per block: whether a cell is open at its end and how many records
    begin in it, if none (0) or one (1) was open at its start; for a file's first
    block, at whose start none is, both are alike, and there is the text of its first
    record, if that ends in the block."""

    def run(batches):
        now, state, starts, head, rows = None, [False, True], [0, 0], [], []
        waiting = True  # for the end of the first record

        def done():
            first = "\n".join(head) if head and now[1] == 0 and not waiting else None
            if now[1] == 0:
                state[1], starts[1] = state[0], starts[0]
            rows.append((*now, *state, *starts, first))

        for key, chunk in _runs(batches, 2):
            if key != now:
                if now is not None:
                    done()
                    if len(rows) > 1000:
                        yield _rows(rows, summary)
                        rows = []
                now, state, starts, head, waiting = key, [False, True], [0, 0], [], True
            text, plain, was = bytes_of(chunk), None, state[0]
            alike, begun = state[0] == state[1], 0
            for i in (0, 1):
                if i and alike and now[1]:
                    starts[1], state[1] = starts[1] + begun, state[0]
                elif not i or now[1]:
                    found = ends_of(text, state[i])
                    if found is None:
                        plain = chunk.to_pylist() if plain is None else plain
                        begun, now_open = 0, state[i]
                        for line in plain:
                            begun += bool(line) and not now_open
                            now_open = open_after(line, now_open)
                    else:
                        ends, now_open, _ = found
                        at = ends[:-1] + 1 if len(ends) and ends[-1] == len(text) - 1 else ends + 1
                        begun = int((text[at] != NEWLINE).sum()) + (not state[i] and bool(text[0] != NEWLINE))
                    starts[i], state[i] = starts[i] + begun, now_open
                    if not i and waiting and now[1] == 0:
                        waiting = _head(head, was, text, plain, None if found is None else found[0])
        if now is not None:
            done()
        yield _rows(rows, summary)

    summary = pa.schema([("file", pa.string()), ("block", pa.int64()), ("open0", pa.bool_()), ("open1", pa.bool_()), ("starts0", pa.int64()), ("starts1", pa.int64()), ("head", pa.string())])
    return lines.select("file", "block", "line").mapInArrow(run, "file string, block long, open0 boolean, open1 boolean, starts0 long, starts1 long, head string")


def _head(head: list[str], is_open: bool, text: np.ndarray, plain: list[str] | None, ends: np.ndarray | None) -> bool:
    """Adds what a text holds of a file's first record; whether its end is still to come."""
    if ends is None:
        for line in plain:
            if line or is_open:
                head.append(line)
                is_open = open_after(line, is_open)
                if not is_open:
                    return False
        return True
    begins = 0
    for end in ends:
        if is_open or end > begins:
            head.append(_text(text[begins: end]))
            return False
        begins = int(end) + 1
    if begins < len(text):
        head.append(_text(text[begins: -1]))
    return True


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _placed(blocks: DataFrame) -> DataFrame:
    """Blocks with ``is_open`` (at their start), ``ends_open``, ``before`` (records of the file
    that begin earlier) and ``owner`` (the block that opened the record). A block
    either ends alike under both suppositions, or turns the state over, or keeps
    it; so the state is that of the last block of the first kind, turned over as
    often as blocks since then do."""
    w = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    turns = (F.col("open0") & ~F.col("open1")).cast("long")
    b = blocks.withColumn("_turned", F.coalesce(F.sum(turns).over(w), F.lit(0)))
    b = b.withColumn("_last", F.last(F.when(F.col("open0") == F.col("open1"), F.struct(F.col("open0").cast("long").alias("v"), F.col("_turned").alias("t"))), True).over(w))
    b = b.withColumn("is_open", (F.coalesce("_last.v", F.lit(0)) + F.col("_turned") - F.coalesce("_last.t", F.lit(0))) % 2 == 1)
    b = b.withColumn("_starts", F.when(F.col("is_open"), F.col("starts1")).otherwise(F.col("starts0")))
    ends_open = F.when(F.col("is_open"), F.col("open1")).otherwise(F.col("open0"))
    return b.withColumns({
        "ends_open": ends_open,
        "before": F.coalesce(F.sum("_starts").over(w), F.lit(0)),
        "owner": F.last(F.when(ends_open & (F.col("_starts") > 0), F.col("block")), True).over(w),
    })


FEW_BLOCKS = 100_000  # rows of one block each that are sent to every task


def _records(lines: DataFrame, placed: DataFrame, few: bool) -> DataFrame:
    """(file, position, owner, piece, text, cells): whole records have cells; the
    pieces of others have a text and the block that opened the record."""
    given = placed.select("file", "block", "is_open", "before", "owner")
    # a block's lines are in one partition either way: of the scan, where they stand in
    # their order and are neither moved nor sorted, or of the join's shuffle
    rows = lines.join(F.broadcast(given), ["file", "block"]) if few else lines.join(given, ["file", "block"]).sortWithinPartitions("file", "block", "id")
    rows = rows.select("file", "block", "is_open", "before", "owner", "line")
    out = pa.schema([("file", pa.string()), ("position", pa.int64()), ("owner", pa.int64()), ("piece", pa.int64()), ("text", pa.string()), ("cells", pa.list_(pa.string()))])

    def run(batches):
        now, is_open, position, owner, held, made = None, False, 0, None, [], []

        def piece():
            if held:
                own = owner is None
                made.append((now[0], position if own else None, now[1] if own else owner, now[1], "\n".join(held), None))

        def closed():
            """The record at hand is at its end."""
            nonlocal owner, held
            if owner is not None:
                piece()
            else:
                made.append((now[0], position, None, None, None, cells_of("\n".join(held))[0]))
            owner, held = None, []

        for (file, block, begins_open, before, opened), lines in _runs(batches, 5):
            if (file, block) != now:
                piece()
                now, is_open, position, held = (file, block), begins_open, before - 1, []
                owner = opened if begins_open else None
            text = bytes_of(lines)
            found = ends_of(text, is_open)
            if found is None:
                for line in lines.to_pylist():
                    if not is_open and not line:
                        continue
                    if not is_open:
                        position += 1
                    held.append(line)
                    is_open = open_after(line, is_open)
                    if not is_open:
                        closed()
            else:
                ends, after, quotes = found
                if is_open:  # the end of a record begun earlier
                    held.append(_text(text[: ends[0] if len(ends) else -1]))
                    if len(ends):
                        closed()
                cells = cut_cells(text, ends, quotes, is_open)
                n = len(cells)
                if n:
                    if made:
                        yield _rows(made, out)
                        made = []
                    none = pa.nulls(n, pa.int64())
                    yield pa.record_batch([pa.repeat(file, n), pa.array(np.arange(position + 1, position + 1 + n)), none, none, pa.nulls(n, pa.string()), cells], schema=out)
                    position += n
                rest = int(ends[-1]) + 1 if len(ends) else 0
                if after and (len(ends) or not is_open):  # a record that goes on
                    held.append(_text(text[rest: -1]))
                    position += 1
                is_open = after
            yield _rows(made, out)
            made = []
        piece()
        yield _rows(made, out)

    return rows.mapInArrow(run, "file string, position long, owner long, piece long, text string, cells array<string>")


def _joined(pieces: DataFrame) -> DataFrame:
    """(file, position, cells) of the records whose pieces lie in several blocks."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "text"))), lambda x: x["text"]), "\n")  # of one record
    whole = pieces.groupBy("file", "owner").agg(F.max("position").alias("position"), text.alias("text")).select("file", "position", "text")

    def run(batches):
        for b in batches:
            yield pa.record_batch([b.column(0), b.column(1), pa.array([cells_of(t)[0] for t in b.column(2).to_pylist()], pa.list_(pa.string()))], names=["file", "position", "cells"])

    return whole.mapInArrow(run, "file string, position long, cells array<string>")


def read_cells(spark: SparkSession, path: str | Sequence[str], recursive: bool = False, keep: Callable[[Column], Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Records of CSV files as (file, position, cells), positions counted from 0
    inside each file, and the files as (file, number, header, n_rows): ``header``
    is the record at position 0, ``n_rows`` counts the others, and ``number`` is
    different for every file. ``keep`` tells by a file's path whether it is read.

    One row per block is written to the shared folder; the files themselves are
    scanned twice, in blocks of ``spark.sql.files.maxPartitionBytes``."""
    lines = _lines(spark, path, recursive, keep)
    kept = scratch_path(spark, "csv-blocks")
    summaries = _summaries(lines)
    summaries.write.parquet(kept)
    blocks = spark.read.schema(summaries.schema).parquet(kept)
    placed = _placed(blocks)
    crossed = F.col("is_open") | F.col("ends_open")
    n, n_crossed = placed.agg(F.count(F.lit(1)), F.count_if(crossed)).first()
    records = _records(lines, placed, n <= FEW_BLOCKS).filter("cells is not null").select("file", "position", "cells")
    if n_crossed:
        pieces = _records(lines, placed.filter(crossed), n_crossed <= FEW_BLOCKS).filter("cells is null")
        records = records.unionByName(_joined(pieces))

    files = placed.groupBy("file").agg(F.sum("_starts").alias("n"), F.max("head").alias("head")).filter("n > 0")
    heads = files.filter("head is not null").select("file", F.lit(0).cast("long").alias("position"), F.col("head").alias("text"))
    heads = _joined(heads.withColumns({"owner": F.lit(0).cast("long"), "piece": F.lit(0).cast("long")}))
    if files.filter("head is null").limit(1).count():  # a header of several lines that crosses blocks
        heads = heads.unionByName(records.filter("position = 0").join(files.filter("head is null").select("file"), "file"))
    # numbered inside groups of files, not in one task
    group = F.pmod(F.xxhash64("file"), F.lit(4096))
    number = (F.row_number().over(Window.partitionBy(group).orderBy("file")) - 1).cast("long") * 4096 + group
    named = files.select("file", (F.col("n") - 1).alias("n_rows"), number.alias("number"))
    return records, named.join(heads.select("file", F.col("cells").alias("header")), "file")
