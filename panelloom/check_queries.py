"""Queries of the survey's files, reports and checks over whole tables, each with SQL of its own.

Artifacts are written into a folder of their own beside the session's checkpoints and read back. A check's query gives a
row per case: its name and the error that the data cause, '' if they pass.
"""

from __future__ import annotations

import json
import uuid
import zipfile
from collections.abc import Callable, Iterable
from itertools import chain
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom import cli
from panelloom.functions import fieldmeta
from panelloom.functions.fieldmeta import Dictionary
from panelloom.functions.scalars import text
from panelloom.operators import clusters, columns, diff, link, panel, review, rules, syntax
from panelloom.plans import wave
from panelloom.queries import oracle, query, table
from panelloom.session import shared_checkpoints
from panelloom.sources import files, sav


def scratch(spark: SparkSession) -> Path:
    """A new folder beside the session's checkpoints, which has to lie in a file system that is mounted."""
    shared_checkpoints(spark)
    root = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    if not root.startswith(("file:", "/")):
        raise ValueError(f"Artifacts are single files and need a mounted folder, not {root}.")
    folder = Path("/" + root.removeprefix("file:").lstrip("/")) / "artifacts" / uuid.uuid4().hex
    folder.mkdir(parents=True)
    return folder


def errors(spark: SparkSession, cases: dict[str, Callable[[], object]]) -> DataFrame:
    """(case, error) of each check, '' where it passes."""
    found = []
    for name, check in cases.items():
        try:
            check()
            found.append((name, ""))
        except ValueError as e:
            found.append((name, str(e)))
    return spark.createDataFrame(found, "case string, error string")


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _cases(**sql: str) -> str:
    return " union all ".join(f"select {_quote(k)} as \"case\", ({v}) as error" for k, v in sql.items())


# Files.


@query
def text_table_roundtrip(spark, d):
    df = table(spark, d, "followup_small").select("row_id", "brokerpanelid", "q1", "q9_6_text").orderBy("row_id")
    path = scratch(spark) / "table.csv"
    files.write_table(df.select(*[F.col(c).cast("string") for c in df.columns]), path)
    return files.read_text_table(spark, path).withColumnRenamed(files.ORDINAL, "position")


oracle("text_table_roundtrip", "select row_id::varchar as row_id, coalesce(brokerpanelid, '') as brokerpanelid, coalesce(q1, '') as q1, coalesce(q9_6_text, '') as q9_6_text, row_number() over (order by row_id) - 1 as position from followup_small")


@query
def table_headers(spark, d):
    names = [r[0] for r in table(spark, d, "possible_y2_mappings").orderBy("followup_column_index").select("followup_column").collect()]  # a header: bounded by the survey's width
    path = scratch(spark) / "headers.csv"
    files.write_rows(path, [], ["ï»¿" + names[0], *names[1:]])
    return columns.header_table(spark, files.clean_headers(files.read_headers(path)))


oracle("table_headers", "select row_number() over (order by followup_column_index)::int as idx, followup_column as name from possible_y2_mappings")


@query
def latin1_table(spark, d):
    path = scratch(spark) / "latin.csv"
    rows = table(spark, d, "nation").orderBy("n_nationkey").collect()
    path.write_bytes("\n".join(["key,name", *[f"{r.n_nationkey},{r.n_name} façade ½" for r in rows]]).encode("latin-1"))
    return files.read_text_table(spark, path, encoding="latin-1", ordinal=False)


oracle("latin1_table", "select n_nationkey::varchar as key, n_name || ' façade ½' as name from nation")


def _mapping_rows(spark, d) -> list[dict]:
    return [r.asDict() for r in table(spark, d, "possible_y2_mappings").orderBy("followup_column_index").collect()]  # bounded by the survey's width


@query
def mapping_file(spark, d):
    path = scratch(spark) / "mapping.csv"
    files.write_rows(path, _mapping_rows(spark, d), files.MAPPING_FIELDS)
    got = review.select_rows(files.read_mapping(path), confidence="high")
    return spark.createDataFrame([tuple(r[c] for c in ("followup_column", "y0_exists_in_master", "proposed_target_column", "reason")) for r in got], "followup_column string, y0 string, target string, reason string")


oracle("mapping_file", "select followup_column, case when y0_exists_in_master then 'True' else 'False' end as y0, coalesce(proposed_target_column, '') as target, coalesce(reason, '') as reason from possible_y2_mappings where confidence = 'high'")


@query
def dict_rows_csv(spark, d):
    path = scratch(spark) / "rows.csv"
    files.write_rows(path, _mapping_rows(spark, d), ("followup_column_index", "followup_column", "exists_exact_in_master", "confidence"))
    return spark.createDataFrame(list(enumerate(path.read_text(encoding="utf-8").splitlines())), "line_no int, line string")


oracle(
    "dict_rows_csv",
    """select 0 as line_no, 'followup_column_index,followup_column,exists_exact_in_master,confidence' as line union all
select row_number() over (order by followup_column_index)::int, followup_column_index || ',' || followup_column || ',' || case when exists_exact_in_master then 'True' else 'False' end || ',' || coalesce(confidence, '') from possible_y2_mappings""",
)


def _customers(spark, d):
    df = table(spark, d, "customer").select(F.col("c_custkey").cast("double").alias("key"), F.col("c_name").alias("name"), F.repeat("c_name", F.lit(30)).alias("story"), F.nullif(F.col("c_acctbal"), F.lit(0.0)).alias("balance"))
    return fieldmeta.attach(df.orderBy("key"), Dictionary({"key": "Number of the customer", "story": "A long text"}, {"key": {0.0: "first", 1.0: "second"}}, {"key": "F8.0", "balance": "F18.12"}))


@query
def system_file(spark, d):
    path = scratch(spark) / "customers.sav"
    sav.write_sav(_customers(spark, d), path)
    return sav.read_sav(spark, path, ordinal="position")


oracle("system_file", "select c_custkey::double as key, c_name as name, repeat(c_name, 30) as story, c_acctbal as balance, row_number() over (order by c_custkey) - 1 as position from customer")


@query
def system_file_dictionary(spark, d):
    path = scratch(spark) / "customers.sav"
    sav.write_sav(_customers(spark, d), path)
    with open(path, "rb") as f:
        layout = sav.read_dictionary(f)
    m = layout.dictionary
    shown = [(n, w == 0, m.labels.get(n, ""), m.formats[n] if w == 0 else "A", "; ".join(f"{k:g}={v}" for k, v in m.values.get(n, {}).items())) for n, w in layout.variables]
    return spark.createDataFrame(shown, "name string, is_numeric boolean, label string, format string, value_labels string")


oracle(
    "system_file_dictionary",
    """select * from (values ('key', true, 'Number of the customer', 'F8.0', '0=first; 1=second'), ('name', false, '', 'A', ''), ('story', false, 'A long text', 'A', ''),
('balance', true, '', 'F18.12', '')) t(name, is_numeric, label, format, value_labels)""",
)


def _workbook(path: Path, rows: Iterable[list[str]]) -> Path:
    cell = lambda i, n, x: f'<c r="{"ABC"[i]}{n}" t="inlineStr"><is><t>{x}</t></is></c>'
    with zipfile.ZipFile(path, "w") as z, z.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as f:
        f.write(b'<worksheet xmlns="u"><sheetData>')
        for n, r in enumerate(rows, start=1):
            f.write(("<row>" + "".join(cell(i, n, x) for i, x in enumerate(r)) + "</row>").encode())
        f.write(b"</sheetData></worksheet>")
    return path


@query
def workbook_crosswalk(spark, d):
    keys = (r[0] for r in table(spark, d, "customer").select("c_custkey").orderBy("c_custkey").toLocalIterator(prefetchPartitions=True))
    path = _workbook(scratch(spark) / "crosswalk.xlsx", chain([list(link.CROSSWALK)], ([f" Cur {k}", f"H{k} ", f"P{k}"] for k in keys)))
    return files.read_crosswalk(spark, path).toDF("current_id", "hid", "original_id")


oracle("workbook_crosswalk", "select 'Cur ' || c_custkey as current_id, 'H' || c_custkey as hid, 'P' || c_custkey as original_id from customer")


@query
def column_references(spark, d):
    cells = [f"{chr(65 + r[0] // 26 % 26)}{chr(65 + r[0] % 26)}{r[0] + 1}" for r in table(spark, d, "part").select(F.col("p_partkey")).orderBy("p_partkey").collect()]
    return spark.createDataFrame([(c, files.column_index(c)) for c in cells], "cell string, column_index int")


oracle("column_references", "select chr((65 + p_partkey // 26 % 26)::int) || chr((65 + p_partkey % 26)::int) || (p_partkey + 1) as cell, ((p_partkey // 26 % 26 + 1) * 26 + p_partkey % 26)::int as column_index from part")


def _syntax_paths(spark, d) -> list[str]:
    folder = scratch(spark)
    paths = []
    for r in table(spark, d, "nation").orderBy("n_nationkey").collect():
        path = folder / f"n{r.n_nationkey:02}.sps"
        path.write_text(f"﻿VARIABLE LABELS NATION 'Nation''s no. {r.n_nationkey % 3}'.\nVALUE LABESL REGION {r.n_regionkey} 'Region {r.n_regionkey}' 9 plain 'x'.\nRECODE left", encoding="utf-8")
        paths.append(str(path))
    return paths


@query
def syntax_files(spark, d):
    rows = syntax.metadata_rows(syntax.parsed(syntax.read_files(spark, _syntax_paths(spark, d))))
    return rows.withColumn("source_file", F.regexp_extract("source_file", "[^/]*$", 0))


oracle(
    "syntax_files",
    """with f as (select *, 'n' || lpad(n_nationkey::varchar, 2, '0') || '.sps' as source_file from nation)
select source_file, '1' as source_line, 'variable_label' as label_type, 'NATION' as variable, '' as value, 'Nation''s no. ' || n_nationkey % 3 as label from f
union all select source_file, '2', 'value_label', 'REGION', n_regionkey::varchar, 'Region ' || n_regionkey from f
union all select source_file, '2', 'value_label', 'REGION', 'plain', 'x' from f""",
)


@query
def label_counts(spark, d):
    result = syntax.parsed(syntax.read_files(spark, _syntax_paths(spark, d)))
    count = lambda df, *by: df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    found, notes = syntax.conflicts(syntax.metadata_rows(result)), syntax.diagnostics(result)
    return count(found.select(F.lit("conflict").alias("kind"), "severity", "code"), "kind", "severity", "code").unionByName(count(notes.select(F.lit("diagnostic").alias("kind"), "severity", "code"), "kind", "severity", "code"))


oracle(
    "label_counts",
    """select 'conflict' as kind, 'warning' as severity, 'CONFLICTING_VARIABLE_LABEL' as code, 1::bigint as n
union all select 'conflict', 'info', 'DUPLICATE_VALUE_LABEL', count(*) from (select n_regionkey::varchar as v from nation group by 1 having count(*) > 1 union all select 'plain')
union all select 'diagnostic', 'warning', 'INCOMPLETE_STATEMENT', count(*) from nation""",
)


@query
def program_file(spark, d):
    path = scratch(spark) / "program.json"
    files.write_json(path, {"schema_version": 1, "expected": {"derived_columns": 1}, "transformations": [{"operation": "recode", "source": "p_size", "target": "size_class", "ranges": [[1, 20, 1], [21, 50, 2]]}]})
    return rules.apply_program(table(spark, d, "part").select("p_partkey", "p_size"), rules.load_program(path))[0]


oracle("program_file", "select p_partkey, p_size, (case when p_size between 1 and 20 then 1 when p_size between 21 and 50 then 2 end)::double as size_class from part")


@query
def stable_csv(spark, d):
    path = scratch(spark) / "stable.csv"
    df = table(spark, d, "orders").select((F.col("o_totalprice") / 7).alias("price"), F.col("o_orderkey").cast("string").alias("id")).orderBy(F.col("id").cast("bigint"))
    n = files.write_table(df, path, bom=False, number=files.fourteen_digits)
    return spark.createDataFrame([(n, files.sha256(path))], "rows bigint, sha256 string").crossJoin(files.fingerprints(spark, [str(path)]).select(F.col("sha256").alias("by_executors")))


oracle(
    "stable_csv",
    """with l as (select o_orderkey, format('{:.14g}', o_totalprice / 7) || ',' || o_orderkey as line from orders),
t as (select count(*) as rows, sha256('price,id' || chr(10) || string_agg(line, chr(10) order by o_orderkey) || chr(10)) as sha256 from l) select rows, sha256, sha256 as by_executors from t""",
)


@query
def rough_merge_file(spark, d):
    folder = scratch(spark)
    master, follow, maps, out = (folder / f"{n}.csv" for n in ("master", "followup", "mappings", "out"))
    files.write_table(table(spark, d, "customer").orderBy("c_custkey").select(F.col("c_name").alias("Case"), F.col("c_mktsegment").alias("Y1_Q1")), master, bom=False)
    files.write_table(table(spark, d, "supplier").orderBy("s_suppkey").select(F.col("s_name").alias("Q1"), F.col("s_suppkey").cast("string").alias("BrokerPanelId")), follow)
    files.write_rows(maps, [{"followup_column": "Q1", "proposed_target_column": "Y2_Q1"}, {"followup_column": "BrokerPanelId"}], ("followup_column", "proposed_target_column"))
    if cli.main(["rough-merge-followup", "--master-csv", str(master), "--followup-csv", str(follow), "--mappings-csv", str(maps), "--output-csv", str(out)], spark):
        raise RuntimeError("The merge failed.")
    return spark.createDataFrame(list(enumerate(out.read_bytes().decode().split("\r\n")[:-1])), "line_no int, line string")


oracle(
    "rough_merge_file",
    """select 0 as line_no, 'Case,Y1_Q1,Y2_Q1,Y2_BrokerPanelId' as line union all select row_number() over (order by c_custkey)::int, c_name || ',' || c_mktsegment || ',,' from customer
union all select (row_number() over (order by s_suppkey) + (select count(*) from customer))::int, ',,' || s_name || ',' || s_suppkey from supplier""",
)

# Reviews and reports.


@query
def review_lines(spark, d):
    lines = review.markdown([r | {"reason": (r["reason"] or "") + " | see\nnotes"} for r in _mapping_rows(spark, d)]).splitlines()
    return spark.createDataFrame([(x,) for x in lines if x.startswith(("| ", "- "))], "line string").where("line not like '| # |%'").groupBy("line").agg(F.count(F.lit(1)).alias("times"))


_CELLS = "'| ' || followup_column_index || ' | ' || followup_column || ' | ' || column_family || ' | ' || coalesce(nullif(proposed_target_column, ''), '_blank_') || ' | exact: ' || {0} || ' | ' || coalesce(reason, '') || ' \\| see notes |'".format(
    " || ', Y0: ' || ".join(["if(exists_exact_in_master, 'yes', 'no')", "if(y0_exists_in_master, 'yes', 'no') || ', Y1: ' || if(y1_exists_in_master, 'yes', 'no') || ', Y2: ' || if(y2_exists_in_master, 'yes', 'no')"])
)
oracle(
    "review_lines",
    f"""with m as (select * from possible_y2_mappings), c as (select confidence, count(*) as n from m group by 1), l as (
select {_CELLS} as line from m where confidence in ('high', 'medium', 'exact_match', 'loose_name_match', 'already_exists', 'unknown')
union all select {_CELLS} from m where column_family in ('survey_metadata', 'free_text_response')
union all select '- ' || coalesce(confidence, '') || ': ' || n from c union all select '- ' || column_family || ': ' || count(*) from m group by column_family
union all select '- Total follow-up columns reviewed: ' || count(*) from m
union all select '- ' || t || ': ' || coalesce((select n from c where confidence = k), 0) from (values ('High-confidence Y2 targets', 'high'), ('Medium-confidence Y2 targets', 'medium'), ('Exact master matches', 'exact_match'),
 ('Loose name matches', 'loose_name_match'), ('Already-existing Y2 targets', 'already_exists'), ('Unknown mappings', 'unknown')) v(t, k))
select line, count(*) as times from l group by 1""",
)


@query
def review_data(spark, d):
    path = scratch(spark) / "review.json"
    files.write_json(path, review.as_json(_mapping_rows(spark, d), "mappings.csv"))
    got = json.loads(path.read_text(encoding="utf-8"))
    open_ = [(r["followup_column"], r["confidence"], r["approved"]) for r in got["mappings"]]
    kept = spark.createDataFrame(open_, "followup_column string, confidence string, approved boolean")
    return kept.withColumns({"total": F.lit(got["summary"]["total"]), "of_confidence": F.element_at(F.create_map(*[F.lit(x) for kv in got["summary"]["by_confidence"].items() for x in kv]), F.col("confidence"))})


oracle("review_data", "select followup_column, confidence, null::boolean as approved, (count(*) over ())::int as total, (count(*) over (partition by confidence))::int as of_confidence from possible_y2_mappings")


@query
def columns_only_in_master(spark, d):
    m = table(spark, d, "possible_y2_mappings")
    master = m.where("proposed_target_column <> ''").groupBy(F.col("proposed_target_column").alias("name")).agg(F.max("followup_column_index").alias("idx"))
    return columns.only_in(master, m.select(F.col("followup_column").alias("name")), "master_index")


oracle(
    "columns_only_in_master",
    """select proposed_target_column as "column", max(followup_column_index) as master_index, case when regexp_matches(proposed_target_column, '^Y[012]_') then 'wave_column'
 when regexp_full_match(proposed_target_column, 'Q[0-9]+(_[0-9]+)?') then 'raw_survey_question' when suffix(proposed_target_column, '_TEXT') then 'free_text_response' else 'other' end as column_family
from possible_y2_mappings where proposed_target_column <> '' and proposed_target_column not in (select followup_column from possible_y2_mappings) group by 1""",
)


@query
def numeric_names(spark, d):
    names = [r[0] for r in table(spark, d, "possible_y2_mappings").select("followup_column").collect()]
    return spark.createDataFrame([(n, rules.numeric_by_name(n)) for n in names], "followup_column string, is_numeric boolean")


oracle(
    "numeric_names",
    """select followup_column, followup_column in ('Status', 'Progress', 'Duration (in seconds)', 'Finished', 'LocationLatitude', 'LocationLongitude', 'ETHICS')
 or (starts_with(followup_column, 'Q') and not suffix(followup_column, '_TEXT') and not starts_with(followup_column, 'QClosing')) as is_numeric from possible_y2_mappings""",
)
# Names of other tables of the survey, after the same rule.
oracle("spss_names", "select row_number() over (order by followup_column_index)::int as idx, followup_column as header, case when regexp_matches(n, '^[0-9]') then 'V_' || n else n end as variable from (select *, regexp_replace(followup_column, '[^A-Za-z0-9_]', '', 'g') as n from possible_y2_mappings)")


@query
def coerced_values(spark, d):
    df = table(spark, d, "followup_small").select("row_id", F.col("q2").alias("Q2"), F.col("q63").alias("Q63"), F.col("progress").alias("Progress"), F.col("q9_6_text").alias("Q9_6_TEXT"))
    out, left = rules.coerce_columns(df, {c: c for c in df.columns[1:]})
    kinds = dict(out.dtypes)
    return out.select("row_id", *[F.col(c).cast("string").try_cast("double").alias(c) if kinds[c] == "double" else F.col(c) for c in df.columns[1:]], F.lit(",".join(left)).alias("left_as_text"))


_NUMBER = "case when regexp_full_match(trim({0}), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') then try_cast(trim({0}) as double) end"
oracle("coerced_values", f"select row_id, {_NUMBER.format('q2')} as Q2, {_NUMBER.format('q63')} as Q63, progress as Progress, q9_6_text as Q9_6_TEXT, 'Progress' as left_as_text from followup_small")


@query
def aligned_dates(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).otherwise(" ").alias("at"), F.lit("  ").alias("blank"))
    return wave.align(df, {"sav_alignment": {"date_columns": ["at", "absent"], "empty_numeric_columns": ["blank"]}})


oracle("aligned_dates", "select o_orderkey, case when o_orderstatus <> 'P' then (epoch_us(o_orderdate) - epoch_us(timestamp '1899-12-30'))::double / 86400000000.0::double end as at, null::double as blank from orders")


@query
def linked_labels(spark, d):
    master = fieldmeta.attach(table(spark, d, "customer").select("c_custkey", "c_name"), Dictionary({"c_name": "Name"}, {"c_custkey": {1.0: "one"}}, {"c_custkey": "F8.2"}))
    follow = fieldmeta.attach(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), Dictionary({"o_orderkey": "K" * 300}, {"o_orderkey": {2.0: "two"}}, {}))
    m = link.linked_dictionary(master, follow, link.target_names(follow.columns, master.columns))
    return spark.createDataFrame([(n, label, "; ".join(f"{k:g}={v}" for k, v in m.values.get(n, {}).items()), m.formats.get(n, "")) for n, label in m.labels.items()], "name string, label string, value_labels string, format string")


oracle(
    "linked_labels",
    """select * from (values ('c_custkey', 'c_custkey', '1=one', 'F8.2'), ('c_name', 'Name', '', ''), ('Y2_o_orderkey', '[Y2 2026] ' || repeat('K', 245), '2=two', ''), ('Y2_o_orderstatus', '[Y2 2026] o_orderstatus', '', ''),
('Y2_HIDBrokerPanelId', 'Panel ID of the crosswalk', '', ''), ('Y2_crosswalk_original_id', 'Original ID of the crosswalk', '', ''), ('Y2_crosswalk_status', 'Status of the crosswalk link', '', ''),
('linked_merge_record_source', 'Source of the record', '', '')) t(name, label, value_labels, format)""",
)

_EXPORT = {
    "schema_version": 2, "respondent_id_source_columns": ["person", "reply"], "cluster_source_column": "segment", "included_cluster_codes": ["1", "2"], "missing_cluster_policy": "exclude",
    "cluster_labels": {"1": "BUILDING", "2": "FURNITURE", "3": "MACHINERY"}, "waves": {"A": {"prefix": "a_"}, "B": {"prefix": "b_"}}, "exclude_stems": ["skip"],
}
_CODE_SQL = "case c_mktsegment when 'BUILDING' then '1' when 'FURNITURE' then '2' when 'MACHINERY' then '3' else '' end"
_PEOPLE = f"""with p as (select c_custkey as k, case when c_custkey % 5 = 0 then '' else 'P' || c_custkey end as person, 'R' || c_custkey as reply, {_CODE_SQL} as code, case when c_acctbal < 0 then null else c_acctbal end as a, c_nationkey::double as b, n_name as note
 from customer join nation on c_nationkey = n_nationkey), i as (select *, if(person = '', reply, person) as rid, if(person = '', 'reply', 'person') as src from p)
"""


def _people(spark, d):
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    code = F.create_map(*[F.lit(x) for x in ("BUILDING", "1.0", "FURNITURE", "02", "MACHINERY", " 3")])
    return c.select(
        F.when(F.col("c_custkey") % 5 == 0, " ").otherwise(F.concat(F.lit("P"), F.col("c_custkey"))).alias("person"),
        F.concat(F.lit("R"), F.col("c_custkey")).alias("reply"),
        F.coalesce(F.try_element_at(code, F.col("c_mktsegment")), F.lit("")).alias("segment"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_acctbal").cast("string")).alias("a_score"),
        F.col("c_nationkey").cast("string").alias("b_score"),
        F.col("n_name").alias("b_note"),
        F.lit("1").alias("a_skip"),
        F.col("c_custkey").alias("row"),
    )


@query
def assignment_report(spark, d):
    cfg = clusters.read_config(_EXPORT)
    counts = clusters.assignment_counts(clusters.identified(_people(spark, d), cfg), cfg)
    flat = [(f"{k}.{x}", n, i) for k, v in counts.items() for i, (x, n) in enumerate(v.items() if isinstance(v, dict) else [("", v)])]
    return spark.createDataFrame(flat, "name string, n bigint, place int")


oracle(
    "assignment_report",
    _PEOPLE
    + """, f as (select *, code in ('1', '2') as inc from i)
select 'linked_master_rows.' as name, count(*) as n, 0 as place from f union all select 'rows_with_respondent_id.', count(*), 0 from f union all select 'included_cluster_assignments.', count(*), 0 from f where inc
union all select 'included_rows_missing_respondent_id.', 0, 0 union all select 'blank_cluster_code_rows.', count(*), 0 from f where code = '' union all select 'excluded_cluster_code_rows.', count(*), 0 from f where code = '3'
union all select 'included_respondent_id_source_counts.' || src, count(*), (row_number() over (order by count(*) desc, src) - 1)::int from f where inc group by src
union all select 'included_cluster_code_counts.' || code, count(*), (row_number() over (order by code) - 1)::int from f where inc group by code
union all select 'excluded_cluster_code_counts.3', count(*), 0 from f where code = '3'""",
)


def _export(spark, d):
    cfg = clusters.read_config(_EXPORT)
    people = _people(spark, d).withColumn("_ord", F.col("row"))
    given = clusters.assignments(clusters.identified(people, cfg), cfg).where("respondent_id not like '%7'")
    return panel.export(people.drop("row"), given, cfg, ordinal="_ord")


@query
def export_report(spark, d):
    path = scratch(spark) / "report.json"
    files.write_json(path, _export(spark, d)[1])
    report = json.loads(path.read_text(encoding="utf-8"))
    flat = [(f"{k}.{x}", n) for k, v in report["counts"].items() for x, n in (v.items() if isinstance(v, dict) else [("", v)])]
    return spark.createDataFrame([*flat, *[(f"dv.{c}", 1) for c in report["dv_columns"]], *[(f"text.{c}", 1) for c in report["excluded_non_numeric_stems"]]], "name string, n bigint")


oracle(
    "export_report",
    _PEOPLE
    + """, l as (select rid, code, 'A' as w, a as v from i where a is not null union all select rid, code, 'B', b from i),
r as (select *, case when code = '' then 'blank_cluster' when code = '3' then 'cluster_code' when rid like '%7' then 'missing_cluster_assignment' end as why from l),
o as (select * from r where why is null), x as (select * from r where why is not null),
n as (select unnest(['blank_cluster', 'cluster_code', 'missing_cluster_assignment']) as why)
select 'linked_master_rows.' as name, count(*) as n from i union all select 'analysis_eligible_rows_before_cluster_filter.', count(*) from l
union all select 'analysis_eligible_respondents_before_cluster_filter.', count(distinct rid) from l union all select 'analysis_ready_rows.', count(*) from o union all select 'distinct_respondent_id.', count(distinct rid) from o
union all select 'wave_counts.' || w, count(*) from o group by w union all select 'dv_columns.', 1 union all select 'excluded_unclustered_rows.', count(*) from x union all select 'excluded_unclustered_respondents.', count(distinct rid) from x
union all select 'excluded_' || why || '_rows.', count(rid) from n left join x using (why) group by why union all select 'excluded_' || why || '_respondents.', count(distinct rid) from n left join x using (why) group by why
union all select 'excluded_cluster_code_row_counts.3', count(*) from x where why = 'cluster_code' union all select 'excluded_cluster_code_respondent_counts.3', count(distinct rid) from x where why = 'cluster_code'
union all select 'duplicate_respondent_wave_rows.', 0 union all select 'dv.score', 1 union all select 'text.note', 1""",
)


def _lines(spark, path: Path) -> DataFrame:
    return spark.createDataFrame(list(enumerate(path.read_text(encoding="utf-8-sig").splitlines())), "line_no int, line string")


@query
def export_in_order(spark, d):
    path = scratch(spark) / "export.csv"
    out = _export(spark, d)[0]
    files.write_table(out.orderBy("_wave", "_order").drop("_wave", "_order"), path, bom=False, number=files.fourteen_digits)
    return _lines(spark, path)


oracle(
    "export_in_order",
    _PEOPLE
    + """, l as (select k, rid, code, 'A' as w, a as v from i where a is not null union all select k, rid, code, 'B', b from i)
select 0 as line_no, 'respondent_id,cluster_code,cluster_label,wave,score' as line union all
select row_number() over (order by w, k)::int, rid || ',' || code || ',' || if(code = '1', 'BUILDING', 'FURNITURE') || ',' || w || ',' || format('{:.14g}', v) from l where code in ('1', '2') and rid not like '%7'""",
)


@query
def assignments_in_order(spark, d):
    folder = scratch(spark)
    files.write_table(_people(spark, d).orderBy("row").drop("row"), folder / "linked.csv")
    files.write_json(folder / "config.json", _EXPORT)
    if cli.main(["build-cluster-assignments", "--linked-master-csv", str(folder / "linked.csv"), "--config", str(folder / "config.json"), "--output-csv", str(folder / "assignments.csv")], spark):
        raise RuntimeError("The assignments failed.")
    return _lines(spark, folder / "assignments.csv")


oracle(
    "assignments_in_order",
    _PEOPLE
    + """select 0 as line_no, 'respondent_id,cluster_code,cluster_label' as line union all
select row_number() over (order by rid)::int, rid || ',' || code || ',' || if(code = '1', 'BUILDING', 'FURNITURE') from i where code in ('1', '2')""",
)


@query
def stems_in_order(spark, d):
    names = [r[0] for r in table(spark, d, "possible_y2_mappings").where("proposed_target_column <> ''").select("proposed_target_column").collect()]
    stems = panel.wave_columns(names, {"Y2": "Y2_"}, exclude=("Q1", "EndDate"))
    return spark.createDataFrame([(i, s, by["Y2"]) for i, (s, by) in enumerate(stems.items())], "place int, stem string, column string")


oracle("stems_in_order", "select (row_number() over (order by stem) - 1)::int as place, stem, 'Y2_' || stem as \"column\" from (select distinct proposed_target_column[4:] as stem from possible_y2_mappings where starts_with(proposed_target_column, 'Y2_') and length(proposed_target_column) > 3) where stem not in ('Q1', 'EndDate')")


def _small_link(spark, d):
    """Customers as the master, a response of every second one, and a crosswalk of those whose number isn't divisible by 3."""
    c = table(spark, d, "customer")
    name = lambda x: F.concat(F.lit(x), F.col("c_custkey"))
    master = c.select(name("P").alias("PSIDBrokerID"), F.col("c_acctbal").alias("base"), F.col("c_custkey").alias("_ord"))
    follow = c.where("c_custkey % 2 = 0").select(name("Cur").alias("BrokerPanelId"), F.lit(1.0).alias("Finished"), F.lit(1.0).alias("Progress"), F.lit(1.0).alias("RecordedDate"), name("R").alias("ResponseId"), F.col("c_custkey").alias("_ord"))
    cross = c.where("c_custkey % 3 <> 0").select(name("cur").alias(link.CROSSWALK[0]), name("H").alias(link.CROSSWALK[1]), name("P").alias(link.CROSSWALK[2]))
    return master, follow, cross


@query
def linked_in_order(spark, d):
    path = scratch(spark) / "linked.csv"
    out = link.ordered(link.link(*_small_link(spark, d), ordinal="_ord")[0])
    files.write_table(out.select("PSIDBrokerID", "Y2_ResponseId", "linked_merge_record_source"), path)
    return _lines(spark, path)


oracle(
    "linked_in_order",
    """with r as (select 0 as part, c_custkey as o, '' as k, 'P' || c_custkey || ',' || if(c_custkey % 2 = 0 and c_custkey % 3 <> 0, 'R' || c_custkey, '') || ',existing_master' as line from customer
union all select 1, 0, 'cur' || c_custkey, ',R' || c_custkey || ',y2_only_appended' from customer where c_custkey % 6 = 0)
select 0 as line_no, 'PSIDBrokerID,Y2_ResponseId,linked_merge_record_source' as line union all select row_number() over (order by part, o, k)::int, line from r""",
)

# Checks.


@query
def program_errors(spark, d):
    ok = {"operation": "recode", "source": "a", "target": "x"}
    program = lambda *specs, **more: lambda: rules.check_program({"schema_version": 1, "transformations": list(specs)} | more)
    return errors(
        spark,
        {
            "good": program(ok),
            "version": program(ok, schema_version=3),
            "no list": program(transformations={}),
            "no object": program(ok, "x"),
            "operation": program({"operation": "drop"}),
            "pairs": program({"operation": "multiply_many", "pairs": []}),
            "pair": program({"operation": "recode_many", "pairs": [["a"]]}),
            "target": program({"operation": "recode", "source": "a"}),
            "twice": program(ok, ok),
            "declared": program(ok, expected={"derived_columns": 2}),
        },
    )


oracle(
    "program_errors",
    """select * from (values ('good', ''), ('version', 'A transformation program has schema_version 1.'), ('no list', 'A transformation program has a list of transformations.'), ('no object', 'Transformation 2 is no object.'),
('operation', 'Transformation 1 has an unsupported operation: drop'), ('pairs', 'Transformation 1 needs a list of pairs.'), ('pair', 'Transformation 1 has a pair that isn''t a source and a target.'),
('target', 'Transformation 1 needs a target.'), ('twice', 'Transformation target is duplicated: x'), ('declared', 'The program declares 2 derived columns but defines 1 targets.')) t("case", error)""",
)


@query
def config_errors(spark, d):
    config = lambda **change: lambda: clusters.read_config(json.loads(json.dumps(_EXPORT | change)))
    return errors(
        spark,
        {
            "good": config(),
            "version": config(schema_version=1),
            "source": config(cluster_source_column=" "),
            "codes": config(cluster_labels={"1": "a", "1.0": "b"}),
            "labels": config(cluster_labels={"1": "a", "2": "a"}),
            "included": config(included_cluster_codes=["1", "9", "8"]),
            "policy": config(missing_cluster_policy="keep"),
            "prefix": config(waves={"A": {"prefix": "x"}, "B": {"prefix": "x"}}),
            "names": config(wave_column="respondent_id"),
            "reserved": config(wave_column="_cluster_source_code"),
        },
    )


oracle(
    "config_errors",
    """select * from (values ('good', ''), ('version', 'An export config has schema_version 2.'), ('source', 'cluster_source_column is no filled string.'), ('codes', 'A cluster code is duplicated after normalization: 1'),
('labels', 'Two cluster codes have the same label.'), ('included', 'Included cluster codes have no label: 8, 9'), ('policy', 'missing_cluster_policy is ''exclude''.'), ('prefix', 'A wave''s prefix is duplicated: x'),
('names', 'The metadata columns'' names are not distinct.'), ('reserved', 'A metadata column uses a reserved name: _cluster_source_code')) t("case", error)""",
)


@query
def wave_errors(spark, d):
    f = table(spark, d, "followup_small")
    raw = f.select(F.col("responseid").alias("ResponseId"), F.col("progress").alias("P"), F.col("q63").alias("Q63"), F.col("row_id").alias(files.ORDINAL)).na.fill("")
    sized = lambda **expected: lambda: wave.derive(raw, rules.check_program({"schema_version": 1, "transformations": [], "expected": expected}))
    program = {"transformations": [{"operation": "recode", "source": "P", "target": "x", "values": {"1": 1}}]}
    path = scratch(spark) / "empty.sav"
    sav.write_sav(spark.createDataFrame([(1.0,)], "other double"), path)
    once = raw.dropDuplicates(["ResponseId"]).where(text("ResponseId") != "")
    return errors(
        spark,
        {
            "rows": sized(input_rows=7),
            "columns": sized(input_columns=2),
            "output": sized(output_columns=9),
            "ids": lambda: wave.derive(raw, rules.check_program({"schema_version": 1, "transformations": []})),
            "unique ids": lambda: wave.derive(once, rules.check_program({"schema_version": 1, "transformations": []})),
            "source": lambda: rules.check_sources(raw, program, files.ORDINAL),
            "blank column": lambda: wave.align(raw, {"sav_alignment": {"empty_numeric_columns": ["Q63"]}}),
            "master": lambda: link.link(sav.read_sav(spark, path), *_small_link(spark, d)[1:]),
        },
    )


oracle(
    "wave_errors",
    _cases(
        rows="select 'Expected 7 input rows, found ' || count(*) || '.' from followup_small",
        columns="'Expected 2 input columns, found 3.'",
        output="'Expected 9 output columns, found 3.'",
        ids="select if(count(*) <> count(distinct trim(responseid)) or count(*) <> count(nullif(trim(responseid), '')), 'ResponseId values must be populated and unique.', '') from followup_small",
        source=f"select 'Non-numeric value in P at data row ' || min(row_id) + 2 || '.' from followup_small where trim(progress) <> '' and ({_NUMBER.format('progress')}) is null",
        master="'The master is missing PSIDBrokerID.'",
    )
    + " union all select 'unique ids', '' union all select 'blank column', 'Expected Q63 to contain only blank values.'",
)


@query
def link_errors(spark, d):
    master, follow, cross = _small_link(spark, d)
    dirty = table(spark, d, "crosswalk").select(F.col("id_march_2026").alias(link.CROSSWALK[0]), F.col("hidbrokerpanelid").alias(link.CROSSWALK[1]), F.col("original_id").alias(link.CROSSWALK[2]))
    folded = cross.unionByName(cross.where(f"`{link.CROSSWALK[0]}` = 'cur1'").select(*[F.upper(c).alias(c) if i == 0 else F.concat(F.lit("x"), c).alias(c) for i, c in enumerate(link.CROSSWALK)]))
    dirty_follow = table(spark, d, "followup_small").select(F.col("brokerpanelid").alias("BrokerPanelId"), F.col("finished").alias("Finished"), F.col("progress").alias("Progress"), F.col("recordeddate").alias("RecordedDate"), F.col("responseid").alias("ResponseId"))
    linked = link.link(master, follow, cross, ordinal="_ord")[0]
    return errors(
        spark,
        {
            "good": lambda: (link.check_crosswalk(cross), link.require_followup(follow), link.check_linked(linked)),
            "crosswalk": lambda: link.check_crosswalk(dirty),
            "crosswalk names": lambda: link.check_crosswalk(cross.drop(link.CROSSWALK[1])),
            "folded": lambda: link.check_crosswalk(folded),
            "followup": lambda: link.require_followup(dirty_follow),
            "followup names": lambda: link.require_followup(follow.drop("Progress", "Finished")),
            "master twice": lambda: link.link(master.unionByName(master.where("base < 0")), follow, cross),
            "long name": lambda: link.target_names(["x" * 62], []),
            "taken": lambda: link.target_names(["a", "b"], ["Y2_b", "Y2_c"]),
            "output twice": lambda: link.check_linked(linked.unionByName(linked)),
        },
    )


_BAD = " or ".join(["count(*) <> count(distinct trim({0}))", "count(*) filter (coalesce(trim({0}), '') = '') > 0"])
oracle(
    "link_errors",
    _cases(
        good="''",
        crosswalk="select case " + " ".join(f"when {_BAD.format(c)} then 'A crosswalk column is blank or duplicated: {n}'" for c, n in (("id_march_2026", "ID March 2026"), ("hidbrokerpanelid", "HIDBrokerPanelId"), ("original_id", "ORIGINAL ID"))) + " else '' end from crosswalk",
        folded="'The crosswalk has several rows with the same ID.'",
        followup="select if(count(*) filter (coalesce(trim(brokerpanelid), '') = '') > 0, 'The follow-up has blank BrokerPanelId values.', '') from followup_small",
        taken="'Target columns already exist: [''Y2_b'']'",
    )
    + """ union all select 'crosswalk names', 'Unexpected crosswalk columns: [''ID March 2026'', ''ORIGINAL ID'']'
union all select 'followup names', 'The follow-up is missing columns: Finished, Progress' union all select 'long name', 'A prefixed variable name is longer than 64 characters.'
union all select 'output twice', 'Follow-up IDs are missing or duplicated after the merge.'
union all select 'master twice', 'The crosswalk maps to duplicated master IDs: ' || string_agg(p, ', ' order by p) from (select 'p' || c_custkey as p from customer where c_acctbal < 0 and c_custkey % 2 = 0 and c_custkey % 3 <> 0 order by p limit 10)""",
)


@query
def master_changes(spark, d):
    master, follow, cross = _small_link(spark, d)
    linked = link.link(master, follow, cross, ordinal="_ord")[0]
    changed = linked.withColumn("base", F.when(F.col("base") < 0, F.lit(0.0)).otherwise(F.col("base"))).where("PSIDBrokerID is null or not PSIDBrokerID like '%99'")
    return spark.createDataFrame([(link.preserved(master, linked, "_ord"), link.preserved(master, changed, "_ord"))], "kept bigint, changed bigint")


oracle("master_changes", "select 0::bigint as kept, 2 * count(*) filter (c_acctbal < 0 and c_custkey % 100 <> 99) + count(*) filter (c_custkey % 100 = 99) as changed from customer")


def _given(spark, d, cfg):
    c = table(spark, d, "clusters").select(F.col("respondent_id"), F.col("cluster_code").alias("cluster_code"), F.col("cluster_label").alias("cluster_label"))
    return clusters.read_assignments(c, cfg)


@query
def cluster_errors(spark, d):
    cfg = clusters.read_config(_EXPORT)
    people = _people(spark, d)
    marked = clusters.identified(people, cfg)
    good = clusters.read_assignments(clusters.assignments(marked, cfg), cfg)
    twice = good.unionByName(good.where("cluster_code = '2'"))
    conflicting = clusters.identified(people.unionByName(people.where("b_score = '3'").withColumn("segment", F.lit("3"))), cfg)
    code, label, rid = F.col("cluster_code"), F.col("cluster_label"), F.col("respondent_id")
    narrow = clusters.read_config(_EXPORT | {"cluster_labels": {"1": "BUILDING", "2": "FURNITURE"}})
    return errors(
        spark,
        {
            "good": lambda: (clusters.require_columns(people, cfg), clusters.check_codes(marked, cfg), clusters.check_assignments(good, cfg), clusters.check_against_source(good, marked, cfg)),
            "id columns": lambda: clusters.require_columns(people.drop("person", "reply"), cfg),
            "source column": lambda: clusters.require_columns(people.drop("segment"), cfg),
            "unknown": lambda: clusters.check_codes(clusters.identified(people, narrow), narrow),
            "conflicting": lambda: clusters.check_codes(conflicting, cfg),
            "assignment names": lambda: clusters.read_assignments(good.drop("cluster_label"), cfg),
            "blank cells": lambda: clusters.check_assignments(_given(spark, d, cfg), cfg),
            "twice": lambda: clusters.check_assignments(twice, cfg),
            "excluded": lambda: clusters.check_assignments(good.withColumn("cluster_code", F.when(rid.like("%3"), "3").otherwise(code)), cfg),
            "labels": lambda: clusters.check_assignments(good.withColumn("cluster_label", F.when(rid.like("%11"), "Other").otherwise(label)), cfg),
            "strangers": lambda: clusters.check_against_source(good.withColumn("respondent_id", F.when(rid.like("%4"), F.concat(F.lit("X"), rid)).otherwise(rid)), marked, cfg),
            "other codes": lambda: clusters.check_against_source(good.withColumn("cluster_code", F.when(rid.like("%6"), "1").otherwise(code)), marked, cfg),
        },
    )


def _ten(expression: str, where: str, order: str = "x") -> str:
    return f"select string_agg(x, ', ' order by {order}) from (select {expression} as x, rid as r from i where code in ('1', '2') and {where} order by {order} limit 10)"


oracle(
    "cluster_errors",
    _PEOPLE
    + _cases(
        good="''",
        unknown="'The cluster source has unknown codes: 3'",
        conflicting="'The linked master has conflicting cluster codes for respondents: ' || (select string_agg(rid, ', ' order by rid) from (select rid from i where b = 3 and code <> '3' order by rid limit 10))",
        twice=f"'The cluster assignments have duplicate respondents: ' || ({_ten('rid', 'code = ' + _quote('2'))})",
        excluded="'The cluster assignments have excluded or unknown codes: 3'",
        labels="'The cluster assignments have labels that don''t match the config: ' || (" + _ten("code || ':Other'", "rid like '%11'", "r") + ")",
        strangers=f"'The cluster assignments have respondents that aren''t in the linked master: ' || ({_ten(chr(39) + 'X' + chr(39) + ' || rid', 'rid like ' + _quote('%4'))})",
    )
    + f""" union all select 'id columns', 'The linked master is missing respondent ID source columns: person, reply' union all select 'source column', 'The linked master is missing its cluster source column: segment'
union all select 'assignment names', 'The cluster assignments are missing columns: cluster_label'
union all select 'blank cells', case when count(*) filter (coalesce(trim(respondent_id), '') = '') > 0 then 'The cluster assignments have blank respondent_id values.' when count(*) filter (coalesce(trim(cluster_code), '') = '') > 0 then 'The cluster assignments have blank cluster_code values.'
 when count(*) filter (coalesce(trim(cluster_label), '') = '') > 0 then 'The cluster assignments have blank cluster_label values.' else 'duplicates' end from clusters
union all select 'other codes', 'The cluster assignments don''t match the linked master: ' || ({_ten("rid || ':1!=2'", "code = '2' and rid like '%6'", 'r')})""",
)


@query
def panel_errors(spark, d):
    cfg = clusters.read_config(_EXPORT)
    people = _people(spark, d)
    given = clusters.assignments(clusters.identified(people, cfg), cfg)
    with_blank = people.unionByName(people.limit(1).withColumns({"person": F.lit(""), "reply": F.lit(None).cast("string"), "segment": F.lit("")}))
    export = lambda df: lambda: panel.export(df.drop("row"), given, cfg)
    return errors(
        spark,
        {
            "good": export(people),
            "clash": export(people.withColumn("a_wave", F.lit("1"))),
            "no stem": export(people.drop("a_score", "b_score")),
            "blank person": export(with_blank),
            "twice": export(people.unionByName(people.where("row = 1").withColumn("b_score", F.lit("-1")))),
        },
    )


oracle(
    "panel_errors",
    _PEOPLE
    + _cases(good="''", clash="'Value columns conflict with the export''s metadata: wave'", twice="select if(code in ('1', '2'), 'The export made duplicate rows of respondent and wave: ' || rid || '/B', '') from i where k = 1")
    + " union all select 'no stem', 'No numeric wave-prefixed column is eligible for the export.' union all select 'blank person', 'The export made rows with a blank respondent_id.'",
)


@query
def file_errors(spark, d):
    folder = scratch(spark)
    empty, short, double = folder / "empty.csv", folder / "short.csv", folder / "double.csv"
    empty.write_text("")
    short.write_text("followup_column,reason\n")
    double.write_text("a,b,a\n1,2,3\n")
    shown = errors(spark, {"empty": lambda: files.read_headers(empty), "mapping": lambda: files.read_mapping(short, required=("followup_column", "confidence")), "names": lambda: files.read_text_table(spark, double), "workbook": lambda: files.read_crosswalk(spark, _workbook(folder / "x.xlsx", [["a", "b", "c"]]))})
    return shown.withColumn("error", F.replace(F.col("error"), F.lit(str(folder) + "/"), F.lit("")))


oracle(
    "file_errors",
    """select * from (values ('empty', 'empty.csv is empty or has no header.'), ('mapping', 'short.csv is missing required columns: confidence'), ('names', 'double.csv has a duplicated column name.'),
('workbook', 'Unexpected crosswalk columns: [''a'', ''b'', ''c'']')) t("case", error)""",
)


@query
def comparison_codes(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_acctbal").alias("x"))
    plain = lambda df, **m: fieldmeta.attach(df, Dictionary(m.get("labels", {}), m.get("values", {}), m.get("formats", {})))
    ours, theirs = plain(c, labels={"x": "a"}, values={"x": {1.0: "one"}}, formats={"x": "F8.2"}), plain(c.where("x >= 0"), labels={"x": "b"}, values={"x": {1.0: "uno"}}, formats={"x": "A8"})
    reports = {
        "same": diff.compare(c, c, "id"),
        "values": diff.compare(c.withColumn("x", F.when(F.col("x") < 0, F.col("x") - 1).otherwise(F.col("x") + 1e-13)), c, "id"),
        "labels": diff.compare(ours, theirs, "id"),
        "columns": diff.compare(c.withColumn("y", F.lit(1)), c, "id"),
        "no id": diff.compare(c.drop("id"), c, "id"),
        "twice": diff.compare(c.unionByName(c.limit(1)), c, "id"),
    }
    return spark.createDataFrame([(k, i["code"], i.get("column", ""), i.get("count", 0)) for k, r in reports.items() for i in r["issues"]], "case string, code string, column string, n bigint")


oracle(
    "comparison_codes",
    """select 'values' as "case", 'VALUE_MISMATCH' as code, 'x' as "column", count(*) as n from customer where c_acctbal < 0 union all
select * from (values ('labels', 'ID_SET_MISMATCH', '', 0), ('labels', 'VARIABLE_LABEL_MISMATCH', 'x', 0), ('labels', 'VALUE_LABEL_MISMATCH', 'x', 0), ('labels', 'VARIABLE_FORMAT_MISMATCH', 'x', 0),
('columns', 'COLUMN_MISMATCH', '', 0), ('no id', 'COLUMN_MISMATCH', '', 0), ('no id', 'MISSING_ID_COLUMN', 'id', 0), ('twice', 'INVALID_IDS', '', 0)) t""",
)
