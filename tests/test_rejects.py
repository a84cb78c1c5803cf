from conftest import rows

from panelloom.operators import rejects

SCHEMA = "record_id bigint, file_name string, line_no int, sep string, raw_line string, loaded_at string, reason string"
HEAD = '﻿ResponseId,Q1,"Progress",Note'
ID = "R_abcdefghij12345"


def lines(spark, *raw, head=HEAD, sep=","):
    return spark.createDataFrame([(i, "f", i + 1, sep, x, None, "clash") for i, x in enumerate([head, *raw])], SCHEMA)


def found(spark, *raw, **more):
    return rows(rejects.rejected(lines(spark, *raw, **more)))


def test_valid_lines_and_lines_that_are_no_data(spark):
    good = [f"{ID},1,100,x", f'"{ID}","05","0100.0","a ""b"", c"', f' {ID} ,,"0",', f"{ID},3.00,7,\"two\r\nlines\"", "ResponseId,Q1,Progress,Note", '"ResponseId","Q1","Progress","Note"', "Response ID,a,b,c", '"{""ImportId"":""x""}",a,b,c', "", "  　\t", None]
    assert found(spark, *good) == []
    assert rejects.loaded(lines(spark, *good)).count() == 4


def test_reasons_in_their_order(spark):
    bad = [f'{ID},1,1,ro"om', f'{ID},1,1,"open', f'{ID},1,1,"a" b', f"{ID},1,1", f"{ID},9,1,x,y", "R_short,1,1,x", f"{ID},6,1,x", f"{ID},1,101,x", f"{ID},1,,x", f"{ID},1.5,1,x", f"{ID},+1,1,x", f'{ID},9,"x,1,1']
    assert found(spark, *bad) == [
        (1, "quoting", "Note"),
        (10, "invalid_value", "Q1"),
        (11, "invalid_value", "Q1"),
        (12, "quoting", "Q1"),
        (2, "quoting", "Note"),
        (3, "quoting", "Note"),
        (4, "column_count", "Note"),
        (5, "column_count", "Q1"),
        (6, "invalid_value", "ResponseId"),
        (7, "invalid_value", "Q1"),
        (8, "invalid_value", "Progress"),
        (9, "invalid_value", "Progress"),
    ]


def test_separators_and_long_texts(spark):
    long = '"' + 'a""b' * 60_000 + '"'
    assert found(spark, f"{ID}|1|5|{long}", f"{ID}|1|5|{long}x", head="ResponseId|Q1|Progress|Note", sep="|") == [(2, "quoting", "Note")]
    tabs = {"head": "ResponseId\tQ1\tProgress\tNote", "sep": "\t"}
    assert found(spark, f"{ID}\t1\t5\ta,b", **tabs) == []
    # A tab between fields is no blank of the field before or after it.
    assert found(spark, f"{ID}\t1\t\t5\ta", f"{ID}\t\t\t5\ta", f" {ID} \t 1 \t5 \ta", f'{ID}\t"\t1\t"\t5\ta', **tabs) == [(1, "column_count", "Progress"), (2, "column_count", "Progress")]


def test_file_without_header_and_empty_table(spark):
    df = lines(spark, f"{ID},1,1,x", 'a"b').where("line_no > 1")
    assert rows(rejects.rejected(df)) == [(2, "quoting", "")]
    assert rows(rejects.loaded(df).select("record_id", "responseid", "extras")) == [(1, None, f'{{"1":"{ID}","2":"1","3":"1","4":"x"}}')]
    # Every line is loaded, rejected or no data, lines of no file too.
    nowhere = df.unionByName(df.selectExpr("record_id + 10 as record_id", "null as file_name", "line_no", "sep", "raw_line", "loaded_at", "reason"))
    assert (rejects.loaded(nowhere).count(), rejects.rejected(nowhere).count()) == (2, 2)
    assert rejects.rejected(df.limit(0)).count() == 0


def test_loaded_columns(spark):
    row = rejects.loaded(lines(spark, f'" {ID} ",2,50,"say ""x"""')).first().asDict()
    assert (row["responseid"], row["q1"], row["progress"], row["status"], row["extras"]) == (ID, "2", "50", None, '{"Note":"say \\"x\\""}')
