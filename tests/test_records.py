"""Parallel record scan against the plain multi-line reader, at every cut point; quarantine by reason."""

import random

import pytest

from cohortcraft.sources import records

COLUMNS = ["id", "note", "amount"]


@pytest.fixture
def small_splits(spark):
    """Splits of a given size, however small the file."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {k: spark.conf.get(k, None) for k in keys}

    def set_(size):
        spark.conf.set(keys[1], str(size))
        spark.conf.set(keys[0], str(size))
        spark.conf.set(keys[2], "1000")

    yield set_
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plain(spark, path):
    df = spark.read.csv(path, schema="id string, note string, amount string", header=True, multiLine=True, quote='"', escape='"')
    return sorted((tuple(r) for r in df.collect()), key=repr)


def quoted(text):
    return '"' + text.replace('"', '""') + '"'


TEXT = 'id,note,amount\n1,plain,5\n2,"two\nlines, ""quoted""\n\nand four",6\n3,"",7\n"4\n","a""b","8\n"\n5,mid"dle,9\n6,"ends"\n'.replace(
    '6,"ends"\n', '6,"ends",10\n'
)


@pytest.mark.parametrize("size", [*range(3, 30, 4), len(TEXT) + 9])
def test_every_cut_point_equals_the_plain_reader(spark, tmp_path, small_splits, size):
    path = tmp_path / "in.csv"
    path.write_text(TEXT)
    want = plain(spark, str(path))
    small_splits(size)
    rows, rejects = records.land(spark, str(path), COLUMNS, str(tmp_path / "out"))
    assert sorted((tuple(r) for r in rows.collect()), key=repr) == want
    assert rejects.count() == 0
    if size < 10:
        assert spark.read.option("lineSep", "\n").text(str(path)).rdd.getNumPartitions() > 8


def test_random_files_equal_the_plain_reader(spark, tmp_path, small_splits):
    rng = random.Random(3)
    folder = tmp_path / "in"
    folder.mkdir()
    for f in range(4):
        lines = ["id,note,amount"]
        for i in range(60):
            words = [rng.choice(["a", "b,c", 'q"q', "x\ny", "\n", "é", ""]) for _ in range(rng.randint(0, 6))]
            lines.append(f"{f}-{i},{quoted(' '.join(words) + '.')},{i}")
        (folder / f"{f}.csv").write_text("\n".join(lines) + ("\n" if f else ""))
    want = plain(spark, str(folder))
    assert len(want) == 240
    for size in (40, 333):
        small_splits(size)
        rows, rejects = records.land(spark, str(folder), COLUMNS, str(tmp_path / f"out{size}"))
        assert sorted((tuple(r) for r in rows.collect()), key=repr) == want
        assert rejects.count() == 0


def test_line_ends_and_byte_order_mark(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_bytes("﻿id,note,amount\r\n1,a,2\r\n\r\n2,\"b\nc\",3\r\n".encode())
    rows, rejects = records.land(spark, str(path), COLUMNS, str(tmp_path / "out"))
    assert sorted(tuple(r) for r in rows.collect()) == [("1", "a", "2"), ("2", "b\nc", "3")]
    assert rejects.count() == 0


def test_rejects_are_kept_by_reason(spark, tmp_path, small_splits):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "good.csv").write_text('id,note,amount\n1,a,2\n2,short\n3,"one\ntwo",4\n4,x,y,z\n5,"q,q",6,\n')
    (folder / "head.csv").write_text("note,id,amount\na,1,2\n")
    (folder / "open.csv").write_text('id,note,amount\n6,ok,1\n7,"never closed\n8,in it,3\n')
    small_splits(11)
    rows, rejects = records.land(spark, str(folder), COLUMNS, str(tmp_path / "out"))
    assert sorted(r["id"] for r in rows.collect()) == ["1", "3", "6", "a"]
    found = {(r["file"], r["reason"], r["text"]) for r in rejects.collect()}
    assert found == {
        ("good.csv", "short", "2,short"), ("good.csv", "long", "4,x,y,z"), ("good.csv", "long", '5,"q,q",6,'),
        ("head.csv", "header", "note,id,amount"), ("open.csv", "unclosed_quote", '7,"never closed\n8,in it,3'),
    }
    with pytest.raises(ValueError, match="malformed records"):
        records.land(spark, str(folder), COLUMNS, str(tmp_path / "strict"), strict=True)


def test_empty_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "none.csv").write_text("")
    (tmp_path / "in" / "head.csv").write_text("id,note,amount\n")
    rows, rejects = records.land(spark, str(tmp_path / "in"), COLUMNS, str(tmp_path / "out"))
    assert rows.count() == 0 and rejects.count() == 0


@pytest.mark.parametrize("line,outside,inside", [
    ("a,b", False, True), ('"a', True, False), ('a,"b', True, False), ('"a""', True, False), ('a"b', False, False), ('"a",b', False, False),
    ('","', False, True), ('x","y', True, True), ("", False, True), ('""', False, True),
])
def test_line_states(line, outside, inside):
    assert (records.ends_inside(line, False), records.ends_inside(line, True)) == (outside, inside)
