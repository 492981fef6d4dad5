import io
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablefold.operators.long_files import parse_lines
from tablefold.operators.parse import cells_of, infer_dtypes, parse_files, sniff_delimiters

WORKED = [
    "a;b\n1;2", "a;b,c;d\n1;2,3;4", "name|id\n1|2", "first name|id\n1|2", "abc\ndef", "a,,b\n1,2,3", "a,a,a\n1,2,3",
    "a,b\n1,2\n1,2,3\n4,5", "a,b,c\n1,2\n4,5,6", "a,b\nx,1,2\ny,3,4", 'a,b\n"1\n2",3', "a,b\n\n1,2\n", "a,b\nTrue,1\n,2",
    "a,b\n,1\n,2", "a,b\n", "a,b\n99999999999999999999,9223372036854775808\n1,1",
    '"x","y z","w"\r\n1,"a ""q"" b",3\r\n4,"u"v,5\r\n5,6" x,7\r\n',
    'a,b\n1,"x\ny\nz"\n2,"p""\n\n"",q"\n3,4\n"5","6\n7"x,8\n9,10\n"11\n12","13\n14"\n15,16',
    'k,v\n1,a"b"c\n2,"q"\n"z\n"\n""",",3', "a\tb,c\n1,2\n", "k:v\n1:2\n-3:4\n", "a,b\n1.5,inf\n2,-3e4\n",
    "'a';'b c';'d'\n1;2;3\n", "a,b\n 1 ,x\n2,\n",
]


def frame(spark, contents):
    return spark.createDataFrame(list(enumerate(contents)), "file_id bigint, content string")


def by_pandas(content):
    return pd.read_csv(io.StringIO(content, newline=""), engine="python", sep=None, on_bad_lines="skip")


def check(spark, contents):
    parsed = parse_files(frame(spark, contents))
    types = infer_dtypes(parsed.columns, cells_of(parsed.rows)).orderBy("file_id", "col_idx").collect()
    rows = parsed.rows.orderBy("file_id", "row_idx").collect()
    for i, content in enumerate(contents):
        want = by_pandas(content)
        got = [r for r in types if r.file_id == i]
        assert [r.header for r in got] == list(want.columns), content
        assert [r.dtype for r in got] == [str(t) for t in want.dtypes], content
        fields = [r.fields for r in rows if r.file_id == i]
        assert len(fields) == len(want), content
        for mine, theirs in zip(fields, want.itertuples(index=False)):
            for m, t, kind in zip(mine, theirs, want.dtypes):
                if kind == object and isinstance(t, str):
                    assert m == t, content


def test_worked_files_like_pandas(spark):
    check(spark, WORKED)


def test_random_files_like_pandas(spark):
    rng = random.Random(5)
    pick = lambda options: rng.choice(options)
    contents = []
    for _ in range(60):
        sep, width = pick([",", ";", "\t", ","]), rng.randint(2, 4)
        lines = [sep.join(f"c{j}" for j in range(width))]
        for _ in range(rng.randint(2, 6)):
            cells = [pick(["1", "2.5", "x y", "NA", "", "True", '"q"', f'"a{sep}b"', '"l\nm"', '"d""e"', 'u"v']) for _ in range(width)]
            lines.append(sep.join(cells[: pick([width, width, width, width - 1])] + pick([[], [], [], ["9"] * 3])))
        contents.append("\n".join(lines) + pick(["", "\n"]))
    check(spark, contents)


@pytest.mark.parametrize("bucket_rows", [2, 1000])
def test_lines_equal_whole_files(spark, bucket_rows):
    lines = [(i, p, line) for i, c in enumerate(WORKED) for p, line in enumerate(re.split("\r\n|\r|\n", c))]
    whole = parse_files(frame(spark, WORKED))
    by_line = parse_lines(spark.createDataFrame(lines, "file_id bigint, line_pos bigint, line string"), bucket_rows)
    for name in ("files", "columns", "rows", "rejects"):
        other = getattr(by_line, name)
        assert sorted(map(str, getattr(whole, name).select(other.columns).collect())) == sorted(map(str, other.collect()))


def test_unreadable_files_are_rejected(spark):
    parsed = parse_files(frame(spark, ["", "\na,b", None, "a,b\n1,2"]))
    assert sorted(r.file_id for r in parsed.rejects.collect()) == [0, 1, 2]
    assert [r.file_id for r in parsed.files.collect()] == [3]


def test_made_up_names_count_as_repeats(spark):
    got = parse_files(frame(spark, ["id,id,id.1\n1,2,3", "a,a.1,a\n1,2,3"])).columns.orderBy("file_id", "col_idx").collect()
    assert [r.header for r in got] == ["id", "id.1", "id.1.1", "a", "a.1", "a.1.1"]


def test_consistent_mode(spark):
    got = sniff_delimiters(frame(spark, ["a b|c\n1|2\n3|4", "x"]), mode="consistent").orderBy("file_id").collect()
    assert [r.delimiter for r in got] == ["|", None]


def test_columns_do_not_read_records(spark):
    plan = parse_files(frame(spark, WORKED)).columns._jdf.queryExecution().optimizedPlan().toString()
    assert "_present" not in plan and "_sound" not in plan
    every = cells_of(parse_files(frame(spark, WORKED)).rows).select(F.count("*"))
    assert "Python" not in every._jdf.queryExecution().executedPlan().toString()
