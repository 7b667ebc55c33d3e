"""Quoted CSV in blocks, against a plain reader of whole files."""

import csv
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from learnscope.sources import csv_blocks, io


@pytest.fixture
def small_blocks(spark):
    """Blocks of 64 bytes, so that every record crosses some."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "64")
    spark.conf.set(keys[1], "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_cells_by_hand():
    assert csv_blocks.cells_of('a,"b,""c""",,"",') == (["a", 'b,"c"', None, "", None], False)
    assert csv_blocks.cells_of('5" disk,x"y,"z"w') == (['5" disk', 'x"y', "zw"], False)
    assert csv_blocks.cells_of('a,"open, ""still""') == (["a", 'open, "still"'], True)
    assert csv_blocks.open_after('end",b,"again', True) and not csv_blocks.open_after('end",b', True)
    assert csv_blocks.open_after("no quote", True) and not csv_blocks.open_after('a"b', False)


def plain(path):
    with open(path, encoding="utf-8-sig", newline="\n") as f:
        rows = [r for r in csv.reader(f.read().replace("\r\n", "\n").splitlines(keepends=True)) if r]
    return [[c or None for c in r] for r in rows]


def write(path, rng, rows, crlf=False, bom=False):
    bits = ["a", "一二三", ",", '"', "\n", "\n\n", " ", "x" * 30, '""', "\n,\n", "q\"\n\"", "plain words here"]
    end = "\r\n" if crlf else "\n"
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write("﻿" if bom else "")
        out = csv.writer(f, lineterminator=end)
        out.writerow(["学生ID", "提问时间", "multi\nline" if crlf else "提问内容", "其他"])
        for i in range(rows):
            out.writerow([i, "2024-01-01 09:00:00", "".join(rng.choice(bits) for _ in range(rng.randrange(9))), rng.choice(["", "z", "\n" * 9])][: rng.choice([3, 4, 4])])
            if i % 5 == 0:
                f.write(end)
        f.write('3,"never closed,\n' if rows % 2 else "")


@pytest.mark.parametrize("seed", [1])
def test_blocks_equal_whole_files(spark, tmp_path, small_blocks, seed):
    rng = random.Random(seed)
    for i, rows in enumerate([0, 1, 20, 31, 60]):
        write(tmp_path / f"f{i}.csv", rng, rows, crlf=i % 2 == 1, bom=i % 3 == 0)
    records, files = csv_blocks.read_cells(spark, str(tmp_path))
    got = {}
    for r in records.collect():
        got.setdefault(r["file"].rsplit("/", 1)[1], []).append((r["position"], [c or None for c in r["cells"]]))
    for i in range(5):
        want = plain(tmp_path / f"f{i}.csv")
        mine = sorted(got[f"f{i}.csv"])
        assert [p for p, _ in mine] == list(range(len(want)))
        if i % 2:  # the reader for comparison cannot drop the carriage returns inside cells
            mine = [(p, [c and c.replace("\r", "") for c in cells]) for p, cells in mine]
        assert [c for _, c in mine][: len(want) - 1] == want[: len(want) - 1]
    heads = {r["file"].rsplit("/", 1)[1]: (r["header"], r["n_rows"], r["number"]) for r in files.collect()}
    assert len({n for _, _, n in heads.values()}) == 5
    assert all(heads[f"f{i}.csv"][0] == plain(tmp_path / f"f{i}.csv")[0] for i in range(5))
    assert all(heads[f"f{i}.csv"][1] == len(plain(tmp_path / f"f{i}.csv")) - 1 for i in range(5))


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    write(tmp_path / "one.csv", random.Random(3), 30)
    records, _ = csv_blocks.read_cells(spark, str(tmp_path))
    assert csv_blocks._lines(spark, str(tmp_path), False).select("block").distinct().count() > 20
    assert records.count() == len(plain(tmp_path / "one.csv"))


def test_turns_from_small_blocks(spark, tmp_path, small_blocks):
    turns = [(i, f'say "{i}"\nline, two' * (i % 3), "2024-01-01 09:00:00") for i in range(40)]
    df = spark.createDataFrame(turns, "student_id long, question_text string, asked_at string")
    io.write_csv(df.coalesce(1), str(tmp_path / "log"), headers=io.TURN_HEADERS)
    got = io.read_turns_csv(spark, str(tmp_path / "log"))
    assert sorted((int(r["student_id"]), r["question_text"]) for r in got.collect()) == [(i, q.replace("\n", " ")) for i, q, _ in turns]
    again = io.read_turns_csv(spark, str(tmp_path / "log"))
    assert got.select("student_id", "turn_id").exceptAll(again.select("student_id", "turn_id")).count() == 0
    assert [r["student_id"] for r in got.orderBy("turn_id").collect()] == [str(i) for i, _, _ in turns]


def test_wide_files_and_other_names_in_one_column(spark, tmp_path):
    """Hundreds of columns are no reason to reject a file, let alone the folder."""
    known = list(io.REQUIRED_TURN_COLUMNS)
    for i in range(3):
        names = [*known, *(f"x{i}_{j}" for j in range(300)), "x0_0"]
        (tmp_path / f"f{i}.csv").write_text(",".join(names) + "\n" + ",".join(f"v{j}" for j in range(len(names))) + "\n", encoding="utf-8")
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n", encoding="utf-8")
    got = io.read_turns_csv(spark, str(tmp_path), clean=False, extras="map")
    assert len(got.columns) < 15
    rows = {r["source"]: r for r in got.collect()}
    assert set(rows) == {"f0.csv", "f1.csv", "f2.csv"}
    assert rows["f1.csv"]["student_id"] == "v0" and rows["f1.csv"]["extras"]["x1_299"] == "v301" and rows["f1.csv"]["extras"]["x0_0"] == "v302"
    assert rows["f0.csv"]["extras"]["x0_0"] == "v2"  # the first of two
    assert "x2_299" in io.read_turns_csv(spark, str(tmp_path), clean=False).columns
    assert [(r["reason"], r["missing"]) for r in io.rejected_files(spark, str(tmp_path)).collect()] == [("missing_columns", known)]
    assert got.select(F.count_distinct("turn_id")).first()[0] == 3


def test_cells_of_a_text_are_those_of_its_lines():
    """Cells cut out of a text's bytes are those that are read line by line."""
    rng, fast = random.Random(5), 0
    cells = ["", '""', "a", "一二", '"x,y"', '"q""q"', '""""', '"two\nlines"', '"\n\n"', '"end\n"', '"é,\n"""', "plain words", 'a"b']
    for _ in range(3000):
        text = "\n".join(",".join(rng.choice(cells[: rng.choice([12, 12, 13])]) for _ in range(rng.randrange(4))) for _ in range(rng.randrange(1, 5)))
        text = rng.choice(["", 'x",', '\n"\n', '"",a\n', '"",\n']) + text + rng.choice(["", ',"goes on'])
        lines = text.split("\n")
        for begins_open in (False, True):
            is_open, held, want = begins_open, [], []
            for line in lines:
                if line or is_open:
                    held.append(line)
                is_open = csv_blocks.open_after(line, is_open)
                if not is_open and held:
                    want.append("\n".join(held))
                    held = []
            want = [csv_blocks.cells_of(w)[0] for w in want[begins_open:]]
            as_bytes = csv_blocks.bytes_of(pa.array(lines))
            assert as_bytes.tobytes().decode() == text + "\n"
            found = csv_blocks.ends_of(as_bytes, begins_open)
            if found is not None:
                fast += 1
                assert found[1] == is_open
                assert csv_blocks.cut_cells(as_bytes, found[0], found[2], begins_open).to_pylist() == want, (text, begins_open)
    assert fast > 2000


def test_no_second_reading_for_records_that_end_in_their_blocks(spark, tmp_path):
    """Where no record crosses blocks there is no scan for pieces of records; excluded
    files are not opened at all."""
    rows = [(i, f'say "{i}"\nline, two', "2024-01-01 09:00:00") for i in range(40)]
    df = spark.createDataFrame(rows, "student_id long, question_text string, asked_at string")
    io.write_csv(df, str(tmp_path / "log"), headers=io.TURN_HEADERS, compression="gzip")
    (tmp_path / "clusters").mkdir()
    (tmp_path / "clusters" / "broken.csv.gz").write_bytes(b"no gzip")
    records, files = csv_blocks.read_cells(spark, str(tmp_path), True, io.is_session_path)
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Union" not in plan
    assert records.filter("position > 0").count() == 40 and files.agg(F.sum("n_rows")).first()[0] == 40
    got = io.session_path_filter(io.read_turns_csv(spark, str(tmp_path), recursive=True, keep=io.is_session_path))
    assert sorted((int(r["student_id"]), r["question_text"]) for r in got.collect()) == [(i, q.replace("\n", " ")) for i, q, _ in rows]


def test_broken_bytes_and_carriage_returns(spark, tmp_path):
    """Bytes that are no UTF-8 are read as replacement characters, in any batch."""
    (tmp_path / "a.csv").write_bytes(b'h1,h2\r\n"a\xff\xfeb","c\r\nd"\r\n\r\nx\ry,"z"\n')
    records, _ = csv_blocks.read_cells(spark, str(tmp_path))
    assert [r["cells"] for r in records.orderBy("position").collect()] == [["h1", "h2"], ["a\ufffd\ufffdb", "c\nd"], ["x\ry", "z"]]
