import json
import tracemalloc
import zipfile

import pytest
from conftest import rows

from panelloom import cli
from panelloom.functions import fieldmeta
from panelloom.sources import files, sav


def workbook(path, sheet, strings=None):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="u"><sheetData>{sheet}</sheetData></worksheet>')
        if strings:
            z.writestr("xl/sharedStrings.xml", '<sst xmlns="u">' + "".join(f"<si><r><t>{s}</t></r></si>" for s in strings) + "</sst>")
    return path


HEADS = ["ID March 2026", "HIDBrokerPanelId", "ORIGINAL ID"]


def inline(*rows_):
    return "".join("<row>" + "".join(f'<c r="{"ABC"[i]}{n}" t="inlineStr"><is><t>{x}</t></is></c>' for i, x in enumerate(r) if x is not None) + "</row>" for n, r in enumerate(rows_, start=1))


def test_workbooks(spark, tmp_path):
    a = workbook(tmp_path / "a.xlsx", inline(HEADS, ["M-771 ", "panel/9", " orig 0042"], ["", None, " "], ["M-772", "panel/10", "orig 0043"]))
    assert rows(files.read_crosswalk(spark, a)) == [("M-771", "panel/9", "orig 0042"), ("M-772", "panel/10", "orig 0043")]
    shared = '<row><c r="A1" t="s"><v>0</v></c><c r="C1"><v>1.50</v></c></row><row><c><v>7</v></c></row>'
    assert files.read_worksheet(workbook(tmp_path / "b.xlsx", shared, ["x &amp; y"])) == [["x & y", "", "1.50"], ["7", "", ""]]
    assert [files.column_index(c) for c in ("A1", "Z9", "AA1", "")] == [0, 25, 26, 0]
    with pytest.raises(ValueError, match="no rows"):
        files.read_crosswalk(spark, workbook(tmp_path / "c.xlsx", ""))
    with pytest.raises(ValueError, match="Unexpected"):
        files.read_crosswalk(spark, workbook(tmp_path / "d.xlsx", inline(["a", "b", "c"])))


def test_large_workbooks_are_streams(spark, tmp_path):
    n = 30_000
    big = workbook(tmp_path / "big.xlsx", inline(HEADS, *[[f"c{i} ", f"h{i}", f" o{i}"] for i in range(n)]))
    tracemalloc.start()
    try:
        assert sum(1 for _ in files.worksheet_rows(big)) == n + 1
        assert tracemalloc.get_traced_memory()[1] < 3 << 20
        tracemalloc.reset_peak()
        got = files.read_crosswalk(spark, big)
        assert tracemalloc.get_traced_memory()[1] < 3 << 20
    finally:
        tracemalloc.stop()
    assert rows(got) == sorted((f"c{i}", f"h{i}", f"o{i}") for i in range(n))
    # A row beyond the crosswalk's columns is an error wherever it lies; runs of a text count, what they enclose doesn't.
    for wide in (["c", "h", "o"], ["", "", ""]):
        with pytest.raises(ValueError, match=r"Unexpected crosswalk columns: \['ID March 2026', 'HIDBrokerPanelId', 'ORIGINAL ID', ''\]"):
            files.read_crosswalk(spark, workbook(tmp_path / "w.xlsx", inline(HEADS, ["a", "b", "d"], wide).removesuffix("</row>") + '<c r="D3"><v> </v></c></row>'))
    parts = '<row><c r="A1" t="inlineStr"><is><r><t>x</t></r><r><t> y<z>no</z>no</t></r></is></c><c r="B1" t="s"><f>no</f><v>1</v><v>0</v></c></row>'
    assert files.read_worksheet(workbook(tmp_path / "p.xlsx", parts, ["first", "second"])) == [["x y", "second"]]


def test_text_tables(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_bytes('﻿A,"b c"\r\n1,"x ""y"", \nz"\r\n\r\nNA\r\n'.encode())
    df = files.read_text_table(spark, p)
    assert rows(df.select("A", "`b c`"), "A") == [("1", 'x "y", \nz'), ("NA", "")]
    assert files.read_headers(p) == ["A", "b c"]
    assert files.clean_headers(["ï»¿Case", "Q1"]) == ["Case", "Q1"]
    (tmp_path / "l.csv").write_bytes("Case,Q1\n1,caf\xe9\n".encode("latin-1"))
    assert rows(files.read_text_table(spark, tmp_path / "l.csv", encoding="ISO-8859-1", ordinal=False)) == [("1", "café")]
    (tmp_path / "e.csv").write_text("")
    with pytest.raises(ValueError, match="empty"):
        files.read_headers(tmp_path / "e.csv")


def test_written_tables(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "a,b", None), (1.2345678901234567, '"', 0.1)], "x double, s string, y double")
    assert files.write_table(df, tmp_path / "o.csv") == 2
    assert (tmp_path / "o.csv").read_bytes() == '﻿x,s,y\n1.0,"a,b",\n1.2345678901234567,"""",0.1\n'.encode()
    files.write_table(df, tmp_path / "p.csv", bom=False, number=files.fourteen_digits)
    assert (tmp_path / "p.csv").read_text() == 'x,s,y\n1,"a,b",\n1.2345678901235,"""",0.1\n'
    assert files.sha256(tmp_path / "p.csv") == files.fingerprints(spark, [str(tmp_path / "p.csv")]).first()["sha256"]


def test_tables_read_and_written_by_many_tasks(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("k,v\n" + "".join(f'{i},"x,{i}"\n' for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 40_000)
    try:
        df = files.read_text_table(spark, path, line_breaks=False)
        assert df.rdd.getNumPartitions() > 3
        assert [(r["k"], r["v"]) for r in df.orderBy("_ord").collect()] == [(str(i), f"x,{i}") for i in range(20_000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    labelled = fieldmeta.attach(df, fieldmeta.Dictionary({"v": "A label"}, {}, {"k": "F8.2"}))
    files.write_parts(labelled, tmp_path / "parts")
    back = spark.read.parquet(str(tmp_path / "parts"))
    assert back.count() == 20_000 and (fieldmeta.read(back).labels, fieldmeta.read(back).formats) == ({"v": "A label"}, {"k": "F8.2"})


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("compress", [True, False, "block"])
def test_system_files(spark, tmp_path, compress, order):
    data = [("R1", 1.0, -0.5, "x" * 200), ("é" * 20, None, 1e300, ""), (None, 151.0, 0.0, "y")]
    df = fieldmeta.attach(spark.createDataFrame(data, "`Response Id` string, a_very_long_variable_name double, n double, s string"), fieldmeta.Dictionary({"n": "A label, é"}, {"n": {1.0: "one", -0.5: "half"}}, {"n": "F8.2", "a_very_long_variable_name": "F18.12"}))
    path = tmp_path / "x.sav"
    assert sav.write_sav(df, path, compress=compress, order=order) == 3
    got = sav.read_sav(spark, path, ordinal="_ord")
    assert rows(got, "_ord") == [("R1", 1.0, -0.5, "x" * 200, 0), ("é" * 20, None, 1e300, "", 1), ("", 151.0, 0.0, "y", 2)]
    d = fieldmeta.read(got)
    assert (d.labels["n"], d.values["n"], d.formats["n"], d.formats["a_very_long_variable_name"]) == ("A label, é", {1.0: "one", -0.5: "half"}, "F8.2", "F18.12")


@pytest.mark.parametrize("compress", [True, False, "block"])
def test_very_long_texts_of_system_files(spark, tmp_path, compress):
    sizes = (255, 256, 503, 504, 505, 510, 2000, 32_000, 32_767)
    texts = ["".join(chr(97 + (i * 7 + k // 26) % 26) for k in range(n)) for i, n in enumerate(sizes)]
    df = spark.createDataFrame([(1.0, *texts, 2.0), (3.0, *["é" * (n // 4) for n in sizes], 4.0), (5.0, *[None] * len(sizes), 6.0)], "a double, " + ", ".join(f"s{n} string" for n in sizes) + ", b double")
    path = tmp_path / "l.sav"
    sav.write_sav(df, path, compress=compress)
    got = sav.read_sav(spark, path, ordinal="_ord")
    assert rows(got.drop("_ord"), "a") == [(1.0, *texts, 2.0), (3.0, *["é" * (n // 4) for n in sizes], 4.0), (5.0, *[""] * len(sizes), 6.0)]
    with pytest.raises(ValueError, match="32767"):
        sav.write_sav(spark.createDataFrame([("x" * 32_768,)], "s string"), path)


def test_encodings_of_system_files(spark, tmp_path):
    path = tmp_path / "e.sav"
    sav.write_sav(spark.createDataFrame([("cafe",)], "s string"), path, compress=False)
    raw = path.read_bytes()
    path.write_bytes(raw.replace(b"UTF-8", b"cp850").replace(b"cafe", b"caf\x82"))
    assert rows(sav.read_sav(spark, path)) == [("café",)]
    path.write_bytes(raw.replace(b"UTF-8", b"nope!"))
    with pytest.raises(ValueError, match="nope!"):
        sav.read_sav(spark, path)
    path.write_bytes(b"$FL2" + b" " * 172)
    with pytest.raises(ValueError, match="byte order"):
        sav.read_sav(spark, path)


@pytest.mark.parametrize("compress", [True, False, "block"])
def test_system_files_read_and_written_by_many_tasks(spark, tmp_path, monkeypatch, compress):
    data = [(float(i) if i % 3 else None, f"{i} é" * (i % 7), i / 7, chr(97 + i % 26) * (i % 600)) for i in range(2000)]
    df = spark.createDataFrame(data, "a double, b string, c double, d string")
    for name, value in {"SPLIT": 50_000, "SCAN": 30_000, "BATCH": 9_000, "BLOCK": 20_000}.items():
        monkeypatch.setattr(sav, name, value)
    one, many = tmp_path / "1.sav", tmp_path / "n.sav"
    sav.write_sav(df.coalesce(1), one, compress=compress)
    sav.write_sav(df.repartition(5).sort(df.c), many, compress=compress)
    assert one.read_bytes() == many.read_bytes()
    got = sav.read_sav(spark, one, ordinal="_ord")
    assert got.rdd.getNumPartitions() > 10
    want = [(*r, i) for i, r in enumerate(data)]
    assert [tuple(r) for r in got.collect()] == want
    sav.write_sav(got.where("_ord < 1000").drop("_ord"), one, compress=compress)  # over the file that it is read from
    assert [tuple(r) for r in sav.read_sav(spark, one, ordinal="_ord").collect()] == want[:1000]
    with pytest.raises(Exception, match="has changed"):
        got.collect()
    assert sorted(p.name for p in tmp_path.iterdir()) == ["1.sav", "n.sav"]


@pytest.mark.parametrize("compress", [True, False])
def test_system_files_that_end_early(spark, tmp_path, compress):
    path = tmp_path / "e.sav"
    sav.write_sav(spark.createDataFrame([(0.5, "abcdefghi"), (1.5, "jklmnopqr")], "a double, s string"), path, compress=compress)
    raw = path.read_bytes()
    path.write_bytes(raw[:-8])
    with pytest.raises(ValueError, match="inside a case"):
        sav.read_sav(spark, path)
    if compress:  # what follows the end of the cases is left out
        path.write_bytes(raw + b"\xfd" * 16)
        assert rows(sav.read_sav(spark, path), "a") == [(0.5, "abcdefghi"), (1.5, "jklmnopqr")]
    else:
        path.write_bytes(raw[:-24])
        assert rows(sav.read_sav(spark, path)) == [(0.5, "abcdefghi")]


def put(path, text):
    path.write_text(text)
    return str(path)


def test_review_commands(spark, tmp_path):
    follow, master, sps = put(tmp_path / "f.csv", "ResponseId,Q1,Z\nR,1,2\n"), put(tmp_path / "m.csv", "Y0_Q1,Y1_Q1,ResponseId\n"), put(tmp_path / "s.sps", "VARIABLE LABELS A 'x'.\nVARIABLE LABELS A 'y'.\n")
    out = tmp_path / "out"
    assert cli.main(["build-review-bundle", "--followup-csv", follow, "--master-csv", master, "--syntax-file", sps, "--output-dir", str(out)], spark) == 0
    assert len([p for p in out.rglob("*") if p.is_file()]) == 12
    assert "CONFLICTING_VARIABLE_LABEL" in (out / "spss_metadata/spss_metadata_conflicts.csv").read_text()
    maps = str(out / "column_comparison/possible_y2_mappings.csv")
    assert cli.main(["mapping-review", "--mappings-csv", maps, "--output-dir", str(tmp_path / "r")], spark) == 0
    assert json.loads((tmp_path / "r/y2_mappings.json").read_text())["summary"]["by_confidence"] == {"exact_match": 1, "high": 1, "unknown": 1}
    assert cli.main(["compare-columns", "--followup-csv", follow, "--master-csv", master, "--output-dir", str(tmp_path / "c")], spark) == 0
    assert cli.main(["extract-spss-metadata", "--syntax-file", sps, "--output-dir", str(tmp_path / "x")], spark) == 0
    assert cli.main(["rough-merge-followup", "--master-csv", put(tmp_path / "m2.csv", "Y1_Q1,Case\nold,1\n"), "--followup-csv", follow, "--mappings-csv", maps, "--output-csv", str(tmp_path / "o.csv")], spark) == 0
    assert (tmp_path / "o.csv").read_text() == "Y1_Q1,Case,ResponseId,Y2_Q1\nold,1,,\n,,R,1\n"
    assert cli.main(["mapping-review", "--mappings-csv", follow, "--output-dir", str(tmp_path / "r")], spark) == 1
    assert cli.main(["mapping-review", "--mappings-csv", str(tmp_path / "none.csv"), "--output-dir", str(tmp_path / "r")], spark) == 2


def test_wave_commands(spark, tmp_path):
    raw = put(tmp_path / "f.csv", 'ResponseId,BrokerPanelId,Finished,Progress,RecordedDate,Q1,Blank\nResponse ID,b,f,p,r,q,\n"{""ImportId"":""x""}",b,f,p,r,q,\nR1,c1,1,100,2026-03-05 12:00:00,1,\nR2,c2,0,50,,2,\n')
    program = {
        "schema_version": 1,
        "expected": {"input_rows": 2, "input_columns": 7, "derived_columns": 1, "output_columns": 8, "id_column": "ResponseId"},
        "sav_alignment": {"date_columns": ["RecordedDate"], "empty_numeric_columns": ["Blank"]},
        "transformations": [{"operation": "recode", "source": "Q1", "target": "Q1di", "values": {"1": 1, "2": 0}, "value_labels": {"1": "yes"}}],
    }
    config = put(tmp_path / "p.json", json.dumps(program))
    master = tmp_path / "m.sav"
    sav.write_sav(spark.createDataFrame([("o1", 10.0), ("o2", 20.0)], "PSIDBrokerID string, Base double"), master)
    cross = workbook(tmp_path / "x.xlsx", inline(HEADS, ["C1", "h1", "o1"]))
    step = tmp_path / "t"
    assert cli.main(["transform-wave", "--input-csv", raw, "--master-sav", str(master), "--config", config, "--output-csv", str(step / "t.csv"), "--output-sav", str(step / "t.sav"), "--report-json", str(step / "t.json")], spark) == 0
    aligned = sav.read_sav(spark, step / "t.sav")
    assert rows(aligned.select("ResponseId", "RecordedDate", "Q1di", "Blank")) == [("R1", 46086.5, 1.0, None), ("R2", None, 0.0, None)]
    assert (step / "t.csv").read_bytes().startswith("﻿ResponseId,BrokerPanelId,Finished,Progress,RecordedDate,Q1,Blank,Q1di\nR1,c1,1.0,100.0,2026-03-05 12:00:00,1.0,,1.0\n".encode())
    out = tmp_path / "all"
    args = ["build-y2-master", "--input-csv", raw, "--master-sav", str(master), "--crosswalk-xlsx", str(cross), "--oracle-sav", str(step / "t.sav"), "--config", config, "--output-dir", str(out)]
    assert cli.main([*args, "--any-size"], spark) == 0
    counts = json.loads((out / "linked_report.json").read_text())["counts"]
    assert (counts["output_rows"], counts["linked_to_existing_master"], counts["new_rows_appended"]) == (3, 1, 1)
    shown = json.loads((step / "t.json").read_text())
    assert (shown["output_rows"], shown["output_columns"], shown["rejected_numeric_columns"], shown["output_csv_sha256"]) == (2, 8, [], files.sha256(step / "t.csv"))
    linked = sav.read_sav(spark, out / "linked_master.sav")
    assert fieldmeta.read(linked).labels["Y2_Q1"] == "[Y2 2026] Q1"
    assert cli.main(args, spark) == 1
    wrong = sav.read_sav(spark, step / "t.sav").replace(1.0, 9.0, ["Q1di"])
    sav.write_sav(wrong, step / "w.sav")
    assert cli.main(["validate-transform", "--candidate-sav", str(step / "w.sav"), "--oracle-sav", str(step / "t.sav"), "--report-json", str(step / "v.json")], spark) == 1
    assert json.loads((step / "v.json").read_text())["issues"][0]["code"] == "VALUE_MISMATCH"


def test_panel_commands(spark, tmp_path):
    config = put(tmp_path / "c.json", json.dumps({"schema_version": 2, "respondent_id_source_columns": ["P"], "cluster_source_column": "code", "cluster_labels": {"1": "One", "2": "Two"}, "included_cluster_codes": ["1"], "missing_cluster_policy": "exclude", "waves": {"Y0": {"prefix": "Y0_"}, "Y1": {"prefix": "Y1_"}}}))
    linked = put(tmp_path / "l.csv", "P,code,Y0_a,Y1_a\nP2,1.0,1.23456789012345678,\nP1,1,3,4\nP3,2,5,6\n,,,\n".replace("\n,,,\n", "\n"))
    assert cli.main(["build-cluster-assignments", "--linked-master-csv", linked, "--config", config, "--output-csv", str(tmp_path / "a.csv"), "--report-json", str(tmp_path / "a.json")], spark) == 0
    assert (tmp_path / "a.csv").read_text(encoding="utf-8-sig") == "respondent_id,cluster_code,cluster_label\nP1,1,One\nP2,1,One\n"
    assert cli.main(["export-analysis-ready", "--linked-master-csv", linked, "--clusters-csv", str(tmp_path / "a.csv"), "--config", config, "--output-csv", str(tmp_path / "e.csv"), "--report-json", str(tmp_path / "e.json")], spark) == 0
    assert (tmp_path / "e.csv").read_text() == "respondent_id,cluster_code,cluster_label,wave,a\nP2,1,One,Y0,1.2345678901235\nP1,1,One,Y0,3\nP1,1,One,Y1,4\n"
