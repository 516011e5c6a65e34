"""CSV files cut into blocks of any size against the reader that takes a file as a whole."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import __spark_entry__ as spark_entry
from starloom.sources import csv_blocks as cb
from starloom.sources import reviews as files


def in_blocks(spark, path, size, **more):
    """Rows read in blocks of that size."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        return Counter(map(tuple, files.load_reviews(spark, path, blocks=True, **more).collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def whole(spark, path, **more):
    return Counter(map(tuple, files.load_reviews(spark, path, blocks=False, **more).collect()))


CELLS = ["plain", "", "two words", "a,b", 'say ""hi""', "line\nbreak", '\n\n""\n', "x" * 300, 'ends ""', '""', ",\n,", "é漢", "NA", " pad "]


def some_file(random_, rows, stray=False):
    """Quoted and plain cells, blank lines, and with ``stray`` quotes where they are only characters."""
    lines = []
    for i in range(rows):
        cells = []
        for _ in range(3):
            cell = random_.choice(CELLS)
            special = any(c in cell for c in ',\n"')
            cells.append(f'"{cell}"' if special or random_.random() < 0.4 else cell)
        if stray:
            cells.append(random_.choice(['5" disk', 'a"b"c', 'x"', "ok"]))
        lines.append(",".join([str(i), *cells]))
        if random_.random() < 0.1:
            lines.append("")
    return "\n".join([",".join(["n", "name", "text", "more", *(["odd"] if stray else [])]), *lines]) + random_.choice(["", "\n"])


@pytest.mark.parametrize("size", ["64", "700", "1m"])
@pytest.mark.parametrize("stray", [False, True])
def test_rows_and_places_are_those_of_the_whole_file(spark, tmp_path, size, stray):
    random_ = random.Random(f"{size} {stray}")
    for name, rows in (("a.csv", 30), ("b.csv", 1), ("c.csv", 0), ("d.csv", 9)):
        (tmp_path / name).write_text(some_file(random_, rows, stray))
    expected = whole(spark, str(tmp_path))
    assert sum(expected.values()) == 40
    assert in_blocks(spark, str(tmp_path), size) == expected


def test_block_inside_one_field_and_carriage_returns(spark, tmp_path):
    """A field over many blocks, of lines that look like records, in a file with carriage returns."""
    inner = "\r\n".join(f"{i},not a record,x" for i in range(200))
    text = f'n,name,text\r\n1,"{inner}",after\r\n2,b,"c\r\n"\r\n\r\n3,"q ""x"" ",d\r\n'
    (tmp_path / "a.csv").write_bytes(text.encode())
    expected = whole(spark, str(tmp_path / "a.csv"))
    for size in ("50", "1000"):
        assert in_blocks(spark, str(tmp_path / "a.csv"), size) == expected
    assert {row[1] for row in expected} == {inner.replace("\r", ""), "b", 'q "x" '}


def test_number_types_and_stored_ids(spark, tmp_path):
    (tmp_path / "a.csv").write_text('review_id,reviews.rating,name\n7,4.5,"x\ny"\n9,NA,z\n')
    path = str(tmp_path)
    found = files.load_reviews(spark, path, blocks=True)
    assert found.dtypes == files.load_reviews(spark, path, blocks=False).dtypes
    assert in_blocks(spark, path, "10") == Counter([(7, 4.5, "x\ny"), (9, None, "z")])
    inferred = files.load_reviews(spark, path, "infer", blocks=True)
    assert [kind for _, kind in inferred.dtypes] == ["bigint", "double", "string"]


def test_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,x\n1,2\n")
    (tmp_path / "b.csv").write_text("name,y\n1,2\n")
    with pytest.raises(ValueError, match="different headers"):
        files.load_reviews(spark, str(tmp_path), blocks=True)


def test_blocks_are_the_default_for_files_larger_than_one(spark, tmp_path):
    path = str(tmp_path / "a.csv")
    (tmp_path / "a.csv").write_text("name\n" + "".join(f'"line {i}\nof two"\n' for i in range(300)))
    assert files.load_reviews(spark, path).rdd.getNumPartitions() == 1
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        found = files.load_reviews(spark, path)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and found.count() == 300
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def plain_end(line, inside):
    """Whether a line ends inside quotes, character by character."""
    state, fresh = ("in" if inside else "out"), True
    for at, c in enumerate(line):
        if state == "out":
            if c == '"' and fresh:
                state = "in"
            fresh = c == ","
        elif state == "in":
            if c == '"':
                state = "shut"
        elif c == '"':
            state = "in"
        else:
            state, fresh = "out", c == ","
    return state == "in"


def test_states_of_lines_by_hand(spark):
    random_ = random.Random(4)
    lines = ["".join(random_.choice('",a ') for _ in range(random_.randint(0, 9))) for _ in range(3000)]
    rows = spark.createDataFrame([(x,) for x in lines], "line string")
    found = rows.select("line", cb._ends_inside("line", cb.BEGIN).alias("o"), cb._ends_inside("line", cb.INSIDE).alias("i"))
    for r in found.collect():
        assert (r.o, r.i) == (plain_end(r.line, False), plain_end(r.line, True)), r.line


@settings(deadline=None, max_examples=300)
@given(st.lists(st.tuples(st.booleans(), st.booleans()), max_size=12), st.booleans())
def test_scan_of_states(functions, state):
    outside, inside = (np.array([f[i] for f in functions], bool) for i in (0, 1))
    begun, after = cb.begun_inside(outside, inside, state)
    for i, f in enumerate(functions):
        assert begun[i] == state
        state = f[1] if state else f[0]
    assert after == state


def test_query_writes_its_files_by_many_tasks(spark, tmp_path, monkeypatch):
    """Places are those of one file in the order of ids, with several files of several blocks."""
    rows = [(i * 7 % 3001, f'text, "{i}"\n' * 40, "de", f"s{i % 3}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    folders = []
    save = spark_entry.review_files.save_csv
    monkeypatch.setattr(spark_entry.review_files, "save_csv", lambda df, path: folders.append(path) or save(df, path))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = spark_entry.csv_blocks(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len([f for f in os.listdir(folders[0]) if f.startswith("part-")]) > 3
    assert {r.doc_id: r.review_id for r in found} == {i: n for n, i in enumerate(sorted(r[0] for r in rows))}
    texts = {i: f'said: "{text}",\n\n"{lang}' for i, text, lang, _ in rows}
    assert all(r.text_md5 == hashlib.md5(texts[r.doc_id].encode()).hexdigest() for r in found)
