"""Queries of the survey operators over whole tables, each with the SQL that gives the same result."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelloom.functions.fieldmeta import attach, read
from panelloom.functions.scalars import PY_SPACE, cluster_code, excel_serial, first_filled, first_filled_source, fold_id, source_place, squashed_name, text, to_number
from panelloom.operators import append, clusters, columns, diff, link, panel, rules, syntax
from panelloom.operators.clusters import ExportConfig
from panelloom.queries import oracle, query, table

_S = "'" + PY_SPACE.replace("'", "''") + "'"
_LIKERT = {"1": 1, "2": 0.5, "3": 0, "4": -0.5, "5": -1}
#: Number of a text in SQL, null if it is none.
_NUM = "case when regexp_full_match(trim({0}, " + _S + "), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') then try_cast(trim({0}, " + _S + ") as double) end"


def _program(*specs):
    return rules.check_program({"schema_version": 1, "transformations": list(specs)})


def _run(df, *specs):
    return rules.apply_program(df, _program(*specs))[0]


@query
def filter_metadata_rows(spark, d):
    df = table(spark, d, "followup_small").select("row_id", F.when(F.col("finished") == "?", "Response ID").otherwise(F.col("responseid")).alias("ResponseId"))
    return append.drop_metadata(df)


oracle("filter_metadata_rows", "select row_id, responseid as \"ResponseId\" from followup_small where coalesce(finished, '') <> '?'")


@query
def strict_numbers(spark, d):
    return table(spark, d, "followup_small").select("row_id", to_number("progress").alias("progress"), to_number("q1").alias("q1"))


oracle("strict_numbers", f"select row_id, {_NUM.format('progress')} as progress, {_NUM.format('q1')} as q1 from followup_small")


@query
def coerce_columns(spark, d):
    df = table(spark, d, "followup_small").select("row_id", "q2", "q12", "q24", "q1", "progress", "q9_6_text")
    bad = rules.non_numeric_columns(df, df.columns[1:], stripped=True)
    return spark.createDataFrame([(c, c not in bad) for c in df.columns[1:]], "column_name string, is_numeric boolean")


oracle(
    "coerce_columns",
    " union all ".join(
        f"select '{c}' as column_name, count(*) filter (trim({c}, {_S}) <> '' and ({_NUM.format(c)}) is null) = 0 as is_numeric from followup_small" for c in ("q2", "q12", "q24", "q1", "progress", "q9_6_text")
    ),
)


@query
def recode_values(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return _run(df, {"operation": "recode", "source": "l_linenumber", "target": "bal", "values": _LIKERT})


oracle("recode_values", "select l_orderkey, l_linenumber, case l_linenumber when 1 then 1.0 when 2 then 0.5 when 3 then 0.0 when 4 then -0.5 when 5 then -1.0 end::double as bal from lineitem")


@query
def recode_ranges_else(spark, d):
    df = table(spark, d, "part").select("p_partkey", "p_size")
    return _run(df, {"operation": "recode", "source": "p_size", "target": "bin", "ranges": [[1, 5, 1], [6, 7, 2], [8, 9, 3], [10, 12, 4]], "else": 9})


oracle("recode_ranges_else", "select p_partkey, p_size, (case when p_size between 1 and 5 then 1 when p_size between 6 and 7 then 2 when p_size between 8 and 9 then 3 when p_size between 10 and 12 then 4 when p_size is not null then 9 end)::double as bin from part")


@query
def recode_last_match_wins(spark, d):
    df = table(spark, d, "part").select("p_partkey", "p_size")
    return _run(df, {"operation": "recode", "source": "p_size", "target": "r", "ranges": [[1, 30, 1], [20, 40, 2]], "values": {"25": 3, "30": "missing"}})


oracle("recode_last_match_wins", "select p_partkey, p_size, (case when p_size = 30 then null when p_size = 25 then 3 when p_size between 20 and 40 then 2 when p_size between 1 and 30 then 1 end)::double as r from part")


@query
def recode_many(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return _run(df, {"operation": "recode_many", "pairs": [["l_linenumber", "a"], ["l_quantity", "b"]], "values": {"1": 1, "2": 0.5, "3": -0.5, "4": -1}})


_MANY = "case {0} when 1 then 1.0 when 2 then 0.5 when 3 then -0.5 when 4 then -1.0 end::double"
oracle("recode_many", f"select l_orderkey, l_linenumber, l_quantity, {_MANY.format('l_linenumber')} as a, {_MANY.format('l_quantity')} as b from lineitem")


@query
def multiply_many(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    return _run(df, {"operation": "multiply_many", "pairs": [["l_quantity", "q_rev"], ["l_tax", "t_rev"]], "factor": -1})


oracle("multiply_many", "select l_orderkey, l_linenumber, l_quantity, l_tax, l_quantity * -1.0::double as q_rev, l_tax * -1.0::double as t_rev from lineitem")


@query
def strict_average(spark, d):
    df = table(spark, d, "followup_small").select("row_id", "q2", "q12", "q24")
    return _run(df, {"operation": "strict_average", "sources": ["q2", "q12", "q24"], "target": "avg3"}).select("row_id", "avg3")


oracle("strict_average", f"select row_id, (({_NUM.format('q2')}) + ({_NUM.format('q12')}) + ({_NUM.format('q24')})) / 3.0::double as avg3 from followup_small")


@query
def conditional_assign(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    spec = {
        "operation": "conditional_assign",
        "target": "routed",
        "default": "missing",
        "rules": [
            {"when": [{"column": "o_totalprice", "between": [0, 100000]}], "value": 0},
            {"when": [{"column": "o_totalprice", "between": [50000, 200000]}, {"column": "o_custkey", "equals": 7}], "value": "missing"},
            {"when": [{"column": "o_totalprice", "between": [80000, 600000]}], "copy": "o_totalprice"},
        ],
    }
    return _run(df, spec)


oracle(
    "conditional_assign",
    "select o_orderkey, o_custkey, o_totalprice, case when o_totalprice between 80000 and 600000 then o_totalprice when o_totalprice between 50000 and 200000 and o_custkey = 7 then null when o_totalprice between 0 and 100000 then 0 end::double as routed from orders",
)

_CHAIN = (
    {"operation": "recode", "source": "q25_3", "target": "a_di", "values": {"1": 1, "2": 1, "3": 0, "4": 0}},
    {"operation": "recode", "source": "q25_4", "target": "b_di", "values": {"1": 1, "2": 1, "3": 0, "4": 0}},
    {"operation": "strict_average", "sources": ["a_di", "b_di"], "target": "tri"},
    {"operation": "recode", "source": "tri", "target": "tri_di", "values": {"1": 1, "0.5": 0, "0": 0}},
    {"operation": "recode", "source": "q63", "target": "edu", "ranges": [[1, 5, 1], [6, 7, 2], [8, 9, 3], [10, 12, 4]], "else": "missing", "value_labels": {"1": "School", "2": "College", "3": "University", "4": "Graduate"}},
    {"operation": "multiply_many", "pairs": [["tri_di", "tri_rev"]], "factor": -1},
    {"operation": "conditional_assign", "target": "route", "default": "missing", "rules": [{"when": [{"column": "q12", "equals": 2}], "value": 0}, {"when": [{"column": "q12", "equals": 1}], "copy": "edu"}]},
)


@query
def transform_program(spark, d):
    df = table(spark, d, "followup_small").select("row_id", "q25_3", "q25_4", "q63", "q12")
    return _run(df, *_CHAIN).select("row_id", "a_di", "b_di", "tri", "tri_di", "edu", "tri_rev", "route")


oracle(
    "transform_program",
    f"""with n as (select row_id, {_NUM.format('q25_3')} as x, {_NUM.format('q25_4')} as y, {_NUM.format('q63')} as z, {_NUM.format('q12')} as w from followup_small),
a as (select *, case when x in (1, 2) then 1.0 when x in (3, 4) then 0.0 end::double as a_di, case when y in (1, 2) then 1.0 when y in (3, 4) then 0.0 end::double as b_di,
  case when z between 1 and 5 then 1 when z between 6 and 7 then 2 when z between 8 and 9 then 3 when z between 10 and 12 then 4 end::double as edu from n),
b as (select *, (a_di + b_di) / 2.0::double as tri from a), c as (select *, case tri when 1 then 1.0 when 0.5 then 0.0 when 0 then 0.0 end::double as tri_di from b)
select row_id, a_di, b_di, tri, tri_di, edu, tri_di * -1.0::double as tri_rev, case when w = 1 then edu when w = 2 then 0.0 end::double as route from c""",
)


@query
def value_labels_lookup(spark, d):
    df, meta = rules.apply_program(table(spark, d, "followup_small").select("row_id", "q63"), _program(_CHAIN[4]))
    labelled = read(attach(df, meta)).values["edu"]  # through the field's metadata
    codes = F.create_map(*[F.lit(x) for kv in labelled.items() for x in kv])
    return df.select("row_id", F.try_element_at(codes, F.col("edu")).alias("label"))


oracle(
    "value_labels_lookup",
    f"select row_id, case when z between 1 and 5 then 'School' when z between 6 and 7 then 'College' when z between 8 and 9 then 'University' when z between 10 and 12 then 'Graduate' end as label from (select row_id, {_NUM.format('q63')} as z from followup_small)",
)


@query
def excel_serial_dates(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("at"))
    return df.select("o_orderkey", excel_serial("at").alias("serial"))


oracle("excel_serial_dates", "select o_orderkey, (epoch_us(o_orderdate) - epoch_us(timestamp '1899-12-30'))::double / 86400000000.0::double as serial from orders")


@query
def spss_names(spark, d):
    headers = table(spark, d, "possible_y2_mappings").orderBy("followup_column_index").select("followup_column").collect()
    names = [h[0] for h in headers]  # a header list: bounded by the survey's width
    return spark.createDataFrame(list(zip(range(1, len(names) + 1), names, rules.spss_names(names), strict=True)), "idx int, header string, variable string")


@query
def dedup_ranked(spark, d):
    kept, _ = link.deduplicate(_followup(spark, d), "row_id")
    return kept.select("row_id", "_current_id", "ResponseId").withColumnRenamed("_current_id", "current_id")


@query
def dedup_decisions(spark, d):
    _, decisions = link.deduplicate(_followup(spark, d), "row_id")
    return decisions.select("broker_panel_id", "kept_response_id", "dropped_response_id", "rule")


def _followup(spark, d):
    f = table(spark, d, "followup_small")
    return f.select("row_id", F.col("brokerpanelid").alias("BrokerPanelId"), F.col("finished").alias("Finished"), F.col("progress").alias("Progress"), F.col("recordeddate").alias("RecordedDate"), F.col("responseid").alias("ResponseId"))


_RANK = f"""with n as (select *, lower(coalesce(trim(brokerpanelid, {_S}), '')) as cid, coalesce({_NUM.format('finished')}, -1) as fin, coalesce({_NUM.format('progress')}, -1) as pro,
 coalesce({_NUM.format('recordeddate')}, -1) as rec, coalesce(trim(responseid, {_S}), '') as rsp from followup_small),
r as (select *, row_number() over w as rn, first_value(responseid) over w as kept, first_value(brokerpanelid) over w as pid from n window w as (partition by cid order by fin desc, pro desc, rec desc, rsp desc, row_id desc))
"""
oracle("dedup_ranked", _RANK + "select row_id, cid as current_id, responseid as \"ResponseId\" from r where rn = 1")
oracle("dedup_decisions", _RANK + f"select pid as broker_panel_id, kept as kept_response_id, responseid as dropped_response_id, '{link.RULE}' as rule from r where rn > 1")


@query
def duplicate_keys(spark, d):
    return link.duplicated(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


oracle("duplicate_keys", "select l_orderkey, l_linenumber, count(*) as rows from lineitem group by 1, 2 having count(*) > 1")


def _linking(spark, d):
    """Customers out of debt as the master, all orders as the follow-up, and a crosswalk that lacks a segment."""
    customers, orders = table(spark, d, "customer"), table(spark, d, "orders")
    person, hid = F.concat(F.lit("P"), F.col("c_custkey")), F.concat(F.lit("H"), F.col("c_custkey"))
    master = customers.where("c_acctbal >= 0").select(person.alias("PSIDBrokerID"), F.col("c_acctbal").alias("base"))
    cross = customers.where("c_mktsegment <> 'MACHINERY'").select(F.concat(F.lit("Cur "), F.col("c_custkey")).alias("ID March 2026"), hid.alias("HIDBrokerPanelId"), person.alias("ORIGINAL ID"))
    follow = orders.select(
        F.concat(F.lit(" cUR "), F.col("o_custkey"), F.lit(" ")).alias("BrokerPanelId"),
        F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0).alias("Finished"),
        F.col("o_totalprice").alias("Progress"),
        F.lit(None).cast("double").alias("RecordedDate"),
        F.col("o_orderkey").cast("string").alias("ResponseId"),
    )
    return master, follow, cross


_LINKED = """with m as (select 'P' || c_custkey as p, lower('P' || c_custkey) as oid, c_acctbal as base from customer where c_acctbal >= 0),
x as (select lower('Cur ' || c_custkey) as cid, 'H' || c_custkey as hid, 'P' || c_custkey as orig, lower('P' || c_custkey) as oid from customer where c_mktsegment <> 'MACHINERY'),
f as (select *, row_number() over (partition by o_custkey order by (o_orderstatus = 'F') desc, o_totalprice desc, o_orderkey::varchar desc) as rn from orders),
k as (select ' cUR ' || o_custkey || ' ' as bp, lower('cur ' || o_custkey) as cid, (case when o_orderstatus = 'F' then 1 else 0 end)::double as fin, o_totalprice as pro, o_orderkey::varchar as rid from f where rn = 1),
s as (select k.*, x.hid, x.orig, x.oid, case when x.oid is null then 'no_crosswalk' when m.oid is null then 'crosswalk_original_missing_master' else 'linked_existing_master' end as status
      from k left join x using (cid) left join m using (oid))
"""


@query
def link_status(spark, d):
    return link.link(*_linking(spark, d))[2]


oracle("link_status", _LINKED + "select status, count(*) as count from s group by 1")


@query
def linked_master(spark, d):
    out = link.link(*_linking(spark, d))[0]
    return out.drop("_part", "_order", "_key", "Y2_RecordedDate")


oracle(
    "linked_master",
    _LINKED
    + """select m.p as "PSIDBrokerID", m.base, s.bp as "Y2_BrokerPanelId", s.fin as "Y2_Finished", s.pro as "Y2_Progress", s.rid as "Y2_ResponseId", s.hid as "Y2_HIDBrokerPanelId",
 s.orig as "Y2_crosswalk_original_id", s.status as "Y2_crosswalk_status", 'existing_master' as linked_merge_record_source from m left join s on s.oid = m.oid and s.status = 'linked_existing_master'
union all select orig, null, bp, fin, pro, rid, hid, orig, status, 'y2_only_appended' from s where status <> 'linked_existing_master'""",
)


@query
def master_preserved(spark, d):
    master, follow, cross = _linking(spark, d)
    lost = link.preserved(master, link.link(master, follow, cross)[0])
    return spark.createDataFrame([(lost,)], "differences bigint")


oracle("master_preserved", "select 0::bigint as differences")


def _perturbed(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    other = orders.withColumns(
        {
            "o_totalprice": F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).when(F.col("o_orderpriority") == "2-HIGH", F.col("o_totalprice") + 1e-13).when(F.col("o_orderstatus") == "P", None).otherwise(F.col("o_totalprice")),
            "o_orderstatus": F.when(F.col("o_totalprice") < 5000, "").otherwise(F.col("o_orderstatus")),
        }
    )
    return orders, other


@query
def dataset_diff(spark, d):
    return diff.value_mismatches(*_perturbed(spark, d)[::-1], "o_orderkey")


oracle(
    "dataset_diff",
    """with m as (select 'o_totalprice' as "column", o_orderkey as k from orders where o_orderpriority = '1-URGENT' or (o_orderpriority <> '2-HIGH' and o_orderstatus = 'P')
union all select 'o_orderstatus', o_orderkey from orders where o_totalprice < 5000)
select "column", count(*) as mismatches, list_slice(list(k order by k), 1, 5) as response_ids from m group by 1""",
)


@query
def id_set_diff(spark, d):
    a = table(spark, d, "orders").select(F.col("o_custkey").alias("id"))
    b = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("id"))
    return diff.id_set_difference(a, b, "id")


oracle(
    "id_set_diff",
    "with a as (select distinct o_custkey as id from orders), b as (select c_custkey as id from customer where c_acctbal > 0) select id, 'candidate_only' as side from a where id not in (select id from b) union all select id, 'oracle_only' from b where id not in (select id from a)",
)

_IDS = ["psidbrokerid", "responseid", "y0_responseid", "y1_responseid", "y2_responseid"]


@query
def coalesce_id_source(spark, d):
    return table(spark, d, "linked_master").select("row_id", first_filled(_IDS).alias("respondent_id"), first_filled_source(_IDS).alias("id_source"))


_FIRST = "coalesce(" + ", ".join(f"nullif(trim({c}, {_S}), '')" for c in _IDS) + ", '')"
oracle("coalesce_id_source", f"select row_id, {_FIRST} as respondent_id, case {' '.join(f'''when trim({c}, {_S}) <> '' then '{c}' ''' for c in _IDS)} else '' end as id_source from linked_master")


@query
def fold_ids(spark, d):
    return table(spark, d, "crosswalk").select("row_id", fold_id("id_march_2026").alias("current_id"), text("hidbrokerpanelid").alias("hid"))


oracle("fold_ids", f"select row_id, lower(coalesce(trim(id_march_2026, {_S}), '')) as current_id, coalesce(trim(hidbrokerpanelid, {_S}), '') as hid from crosswalk")

_CODE = "case when regexp_full_match(trim({0}, " + _S + "), '[+]?[0-9]+(\\.0*)?') then try_cast(try_cast(trim({0}, " + _S + ") as double) as bigint)::varchar else coalesce(trim({0}, " + _S + "), '') end"


@query
def normalize_cluster_code(spark, d):
    return table(spark, d, "clusters").select("row_id", cluster_code("cluster_code").alias("code"))


oracle("normalize_cluster_code", f"select row_id, {_CODE.format('cluster_code')} as code from clusters")

_CFG = ExportConfig(_IDS, "tsc_code", {"1": "Stopped looking", "2": "Looking", "3": "Planning later", "4": "Someday", "5": "No plan", "6": "Clients"}, ["1", "2", "3", "4", "5"], {"Y0": "y0_", "Y1": "y1_", "Y2": "y2_"}, exclude_stems=["responseid", "hidbrokerpanelid", "crosswalk_original_id", "crosswalk_status", "linked_at"])


def _marked(spark, d):
    m = table(spark, d, "linked_master")
    source = next(c for c in m.columns if c.startswith("tsc_"))  # the only such column
    return clusters.identified(m.withColumnRenamed(source, _CFG.source_column), _CFG)


_MARKED = f"with k as (select row_id, {_FIRST} as rid, {_CODE.format(_CFG.source_column)} as code, removed_at from (select *, columns('tsc_.*') as tsc_code from linked_master)) "


@query
def cluster_assignments(spark, d):
    return clusters.assignments(_marked(spark, d), _CFG).withColumnRenamed("respondent_id", "rid")


_LABEL = "case code " + " ".join(f"when '{k}' then '{v}'" for k, v in _CFG.labels.items()) + " end"
oracle("cluster_assignments", _MARKED + f"select rid, code as cluster_code, {_LABEL} as cluster_label from k where code in ('1','2','3','4','5') and rid <> ''")


@query
def cluster_code_counts(spark, d):
    return _marked(spark, d).groupBy("_code").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(F.nullif("respondent_id", F.lit(""))).alias("respondents")).withColumnRenamed("_code", "code")


oracle("cluster_code_counts", _MARKED + "select code, count(*) as rows, count(distinct nullif(rid, '')) as respondents from k group by 1")


@query
def cluster_conflicts(spark, d):
    """Every seventh row is delivered again with another code, which is a conflict, or none, which is one too."""
    m = _marked(spark, d)
    again = m.where("row_id % 7 = 0").withColumn("_code", F.when(F.col("row_id") % 2 == 0, "6").otherwise(""))
    return clusters.conflicts(m.unionByName(again))


oracle(
    "cluster_conflicts",
    _MARKED + ", a as (select rid, code from k union all select rid, if(row_id % 2 = 0, '6', '') from k where row_id % 7 = 0) select rid as respondent_id, count(distinct code) as codes from a where rid <> '' group by 1 having count(distinct code) > 1",
)

_WAVES = {"Y0": ("2024-01-01", "2024-01-11"), "Y1": ("2024-01-11", "2024-01-21"), "Y2": ("2024-01-21", "2024-01-31")}
_PREFIX = {w: w + "_" for w in _WAVES}
_KINDS = ("click", "view", "purchase", "signup", "logout")


def _wide(spark, d):
    return panel.wide_from_events(table(spark, d, "events"), _WAVES, list(_KINDS))


def _wide_sql(wave, kind):
    a, b = _WAVES[wave]
    return f"max(value) filter (ts >= '{a}' and ts < '{b}' and event_type = '{kind}')"


@query
def wide_panel(spark, d):
    return _wide(spark, d)


oracle("wide_panel", "select user_id, " + ", ".join(f'{_wide_sql(w, k)} as "{w}_{k}"' for w in _WAVES for k in _KINDS) + " from events group by 1")


@query
def long_panel(spark, d):
    wide = _wide(spark, d)
    stems = panel.wave_columns(wide.columns, _PREFIX)
    return panel.drop_empty(panel.long_panel(wide, stems, _PREFIX, keep=["user_id"]), list(stems)).drop("_wave")


oracle(
    "long_panel",
    " union all ".join(
        f"select * from (select user_id, '{w}' as wave, " + ", ".join(f"{_wide_sql(w, k)} as {k}" for k in _KINDS) + f" from events group by 1) where coalesce({', '.join(_KINDS)}) is not null" for w in _WAVES
    ),
)


@query
def numeric_stems(spark, d):
    good, bad = panel.numeric_stems(table(spark, d, "linked_master"), _CFG.waves, exclude=["crosswalk_original_id"])
    return spark.createDataFrame([(s, True) for s in good] + [(s, False) for s in bad], "stem string, is_numeric boolean")


_STEMS = {"responseid": ("y0_responseid", "y1_responseid", "y2_responseid"), "housing_score": ("y0_housing_score", "y1_housing_score", "y2_housing_score"), "hidbrokerpanelid": ("y2_hidbrokerpanelid",), "crosswalk_status": ("y2_crosswalk_status",)}
oracle(
    "numeric_stems",
    " union all ".join(f"select '{s}' as stem, " + " and ".join(f"count(*) filter (trim({c}, {_S}) <> '' and ({_NUM.format(c)}) is null) = 0" for c in cs) + " as is_numeric from linked_master" for s, cs in _STEMS.items())
    + " union all select 'linked_at', count(y2_linked_at) = 0 from linked_master",
)


def _exported(spark, d):
    """The long panel of the linked master with the assignments of the clusters table; repeated respondents are taken once."""
    marked = _marked(spark, d).withColumn("_order", F.col("row_id"))
    given = clusters.read_assignments(table(spark, d, "clusters"), _CFG)
    given = given.groupBy("respondent_id").agg(F.max(_CFG.code_column).alias(_CFG.code_column), F.max(_CFG.label_column).alias(_CFG.label_column))
    stems = {"housing_score": {w: f"{p}housing_score" for w, p in _CFG.waves.items()}}
    long = panel.drop_empty(panel.long_panel(marked, stems, _CFG.waves, keep=["respondent_id", "_code", "_order"]), list(stems))
    return panel.with_reason(long.where("respondent_id <> ''"), given, _CFG)


_REASONED = (
    _MARKED.rstrip()
    + f""", g as (select trim(respondent_id, {_S}) as rid, max({_CODE.format('cluster_code')}) as c, max(coalesce(trim(cluster_label, {_S}), '')) as l from clusters where respondent_id is not null group by 1),
v as (select row_id, w, {_NUM.format('x')} as housing_score from (select row_id, 'Y0' as w, y0_housing_score as x from linked_master union all select row_id, 'Y1', y1_housing_score from linked_master union all select row_id, 'Y2', y2_housing_score from linked_master)),
e as (select k.rid, k.code, v.w as wave, v.housing_score, g.c, g.l, case when k.code = '' then 'blank' when k.code not in ('1','2','3','4','5') then 'code' when coalesce(g.c, '') = '' or coalesce(g.l, '') = '' then 'missing' end as reason
  from k join v using (row_id) left join g on g.rid = k.rid where v.housing_score is not null and k.rid <> '')
"""
)


@query
def analysis_ready_export(spark, d):
    out = panel.output(_exported(spark, d), _CFG, ["housing_score"])
    return out.drop("_wave", "_order").withColumnRenamed("respondent_id", "rid")


oracle("analysis_ready_export", _REASONED + "select distinct rid, c as cluster_code, l as cluster_label, wave, housing_score from e where reason is null")


@query
def cluster_exclusions(spark, d):
    return panel.exclusion_counts(_exported(spark, d))


oracle("cluster_exclusions", _REASONED + "select reason, case when reason = 'code' then code else '' end as code, count(*) as rows, count(distinct rid) as respondents from e where reason is not null group by 1, 2")


@query
def wave_counts(spark, d):
    counts = panel.wave_counts(panel.output(_exported(spark, d), _CFG, ["housing_score"]), _CFG)
    return spark.createDataFrame(list(counts.items()), "wave string, rows bigint")


oracle("wave_counts", _REASONED + "select wave, count(*) as rows from (select distinct rid, c, l, wave, housing_score from e where reason is null) group by 1")


@query
def duplicate_respondent_wave(spark, d):
    return link.duplicated(panel.output(_exported(spark, d), _CFG, ["housing_score"]), ["respondent_id", "wave"]).withColumnRenamed("respondent_id", "rid")


oracle("duplicate_respondent_wave", _REASONED + "select rid, wave, count(*) as rows from (select distinct rid, c, l, wave, housing_score from e where reason is null) group by 1, 2 having count(*) > 1")


def _headers(spark, d):
    m = table(spark, d, "possible_y2_mappings")
    followup = m.select(F.col("followup_column_index").alias("idx"), F.col("followup_column").alias("name"))
    place = Window.orderBy("followup_column_index")  # a header list: bounded by the survey's width
    master = m.where("proposed_target_column <> ''").select(F.row_number().over(place).alias("idx"), F.col("proposed_target_column").alias("name"), "followup_column_index", "y0_exists_in_master", "y1_exists_in_master")
    earlier = master.where("y1_exists_in_master").select((F.col("followup_column_index") + 1000).cast("int").alias("idx"), F.regexp_replace("name", "^Y2_", "Y1_").alias("name"))
    oldest = master.where("y0_exists_in_master").select((F.col("followup_column_index") + 2000).cast("int").alias("idx"), F.regexp_replace("name", "^Y2_", "Y0_").alias("name"))
    return followup, master.where("not y1_exists_in_master").select("idx", "name").unionByName(earlier).unionByName(oldest)


_HEADERS = """with f as (select followup_column_index as idx, followup_column as name from possible_y2_mappings),
p as (select *, row_number() over (order by followup_column_index)::int as i, proposed_target_column as n from possible_y2_mappings where proposed_target_column <> ''),
m as (select i as idx, n as name from p where not y1_exists_in_master union all select followup_column_index + 1000, regexp_replace(n, '^Y2_', 'Y1_') from p where y1_exists_in_master
  union all select followup_column_index + 2000, regexp_replace(n, '^Y2_', 'Y0_') from p where y0_exists_in_master),
lf as (select name, max(idx) as idx from f group by 1), lm as (select name, max(idx) as idx from m group by 1)
"""
_FAMILY = (
    "case when regexp_matches({0}, '^Y[012]_') then 'wave_column' when regexp_full_match({0}, 'Q[0-9]+(_[0-9]+)?') then 'raw_survey_question' when suffix({0}, '_TEXT') then 'free_text_response' when "
    + " or ".join("starts_with({0}, '" + p + "')" for p in columns.METADATA_PREFIXES)
    + " then 'survey_metadata' else 'other' end"
)


@query
def columns_in_both(spark, d):
    return columns.in_both(*_headers(spark, d))


oracle("columns_in_both", _HEADERS + f"select lf.name as \"column\", lf.idx as followup_index, lm.idx as master_index, {_FAMILY.format('lf.name')} as column_family from lf join lm using (name)")


@query
def columns_only_in_followup(spark, d):
    return columns.only_in(*_headers(spark, d), "followup_index")


oracle("columns_only_in_followup", _HEADERS + f"select name as \"column\", idx as followup_index, {_FAMILY.format('name')} as column_family from lf where name not in (select name from lm)")


@query
def propose_mappings(spark, d):
    return columns.propose(*_headers(spark, d))


oracle(
    "propose_mappings",
    _HEADERS
    + f"""select followup_column_index, followup_column, {_FAMILY.format('followup_column')} as column_family, e as exists_exact_in_master, y0 as y0_exists_in_master, y1 as y1_exists_in_master, y2 as y2_exists_in_master,
 case confidence when 'exact_match' then followup_column when 'loose_name_match' then loose when 'unknown' then '' else 'Y2_' || followup_column end as proposed_target_column, confidence,
 case confidence {' '.join(f"when '{k}' then '{v}'" for k, v in columns.PROPOSALS.items())} end as reason
from (select *, case when y0 and y1 and not y2 then 'high' when y1 and not y2 then 'medium' when y2 then 'already_exists' when e then 'exact_match' when loose <> '' then 'loose_name_match' else 'unknown' end as confidence from (
 select f.idx as followup_column_index, f.name as followup_column, f.name in (select name from m) as e, 'Y0_' || f.name in (select name from m) as y0, 'Y1_' || f.name in (select name from m) as y1,
  'Y2_' || f.name in (select name from m) as y2, (select arg_max(name, idx) from m where regexp_replace(lower(m.name), '[^a-z0-9]', '', 'g') = regexp_replace(lower(f.name), '[^a-z0-9]', '', 'g')) as loose from f))""",
)


@query
def classify_columns(spark, d):
    m = table(spark, d, "possible_y2_mappings")
    return m.select("followup_column", columns.family("followup_column").alias("column_family"), squashed_name("followup_column").alias("squashed"))


oracle("classify_columns", f"select followup_column, {_FAMILY.format('followup_column')} as column_family, regexp_replace(lower(followup_column), '[^a-z0-9]', '', 'g') as squashed from possible_y2_mappings")


@query
def mapping_summary(spark, d):
    return columns.summary(table(spark, d, "possible_y2_mappings"))


oracle(
    "mapping_summary",
    "select 'total' as kind, '' as name, count(*) as n from possible_y2_mappings union all select 'confidence', coalesce(confidence, ''), count(*) from possible_y2_mappings group by 2 union all select 'column_family', coalesce(column_family, ''), count(*) from possible_y2_mappings group by 2",
)


def _label_rows(spark, d):
    p = table(spark, d, "part")
    by_value = p.select(F.concat(F.lit("f"), F.col("p_partkey") % 3).alias("source_file"), (F.col("p_partkey") % 50).cast("string").alias("source_line"), F.lit("value_label").alias("label_type"), F.col("p_brand").alias("variable"), F.col("p_size").cast("string").alias("value"), F.split("p_type", " ")[0].alias("label"))
    by_name = p.select(F.lit("g").alias("source_file"), F.lit("").alias("source_line"), F.lit("variable_label").alias("label_type"), F.split("p_name", " ")[0].alias("variable"), F.lit("x").alias("value"), F.lower(F.split("p_name", " ")[0]).alias("label"))
    return by_value.unionByName(by_name)


@query
def label_conflicts(spark, d):
    return syntax.conflicts(_label_rows(spark, d))


oracle(
    "label_conflicts",
    """with r as (select 'value_label' as t, p_brand as v, p_size::varchar as c, split_part(p_type, ' ', 1) as l, 'f' || (p_partkey % 3) || ':' || (p_partkey % 50) as s from part
 union all select 'variable_label', split_part(p_name, ' ', 1), '', lower(split_part(p_name, ' ', 1)), 'g' from part),
g as (select t, v, c, list_sort(list_distinct(list(l))) as l, list_sort(list_distinct(list(s))) as s from r group by 1, 2, 3 having count(*) > 1)
select case when len(l) = 1 then 'info' else 'warning' end as severity, case when len(l) = 1 then 'DUPLICATE_' else 'CONFLICTING_' end || upper(t) as code, t as label_type, v as variable, c as value,
 array_to_string(l, ' || ') as labels, array_to_string(s, ' ; ') as sources,
 'Variable ' || v || case when t = 'value_label' then ' value ' || c else '' end || case when len(l) = 1 then ' has duplicate identical ' else ' has conflicting ' end || case when t = 'value_label' then 'value labels.' else 'variable labels.' end as message from g""",
)


def _syntax_files(spark, d):
    """One syntax file per customer segment and nation, written from the tables."""
    c = table(spark, d, "customer")
    body = F.format_string("VARIABLE LABELS N%d 'Nation ''%d'' no. %d'.\nVALUE LABELS SEG%d 1 '%s' 2 'x.y' /B 0.5 'half'.\nCOMPUTE z = .5.\nVALUE LABELS BAD.\nRECODE open", F.col("c_nationkey"), F.col("c_nationkey"), F.col("c_nationkey"), F.col("c_nationkey"), F.col("c_mktsegment"))
    files = c.select("c_nationkey", "c_mktsegment", body.alias("text")).distinct()
    return files.select(F.lit(0).alias("file_no"), F.concat("c_mktsegment", F.lit("_"), F.col("c_nationkey")).alias("source_file"), "text")


@query
def syntax_metadata(spark, d):
    return syntax.metadata_rows(syntax.parsed(_syntax_files(spark, d)))


_FILES = "with f as (select distinct c_nationkey as n, c_mktsegment as m, c_mktsegment || '_' || c_nationkey as source_file from customer) "
oracle(
    "syntax_metadata",
    _FILES
    + """select source_file, '1' as source_line, 'variable_label' as label_type, 'N' || n as variable, '' as value, 'Nation ''' || n || ''' no. ' || n as label from f
union all select source_file, '2', 'value_label', 'SEG' || n, '1', m from f union all select source_file, '2', 'value_label', 'SEG' || n, '2', 'x.y' from f union all select source_file, '2', 'value_label', 'B', '0.5', 'half' from f""",
)


@query
def syntax_diagnostics(spark, d):
    return syntax.diagnostics(syntax.parsed(_syntax_files(spark, d)))


oracle(
    "syntax_diagnostics",
    _FILES
    + """select source_file, '4' as source_line, 'warning' as severity, 'MALFORMED_VALUE_LABELS' as code, 'VALUE LABELS statement could not be parsed.' as message, 'VALUE LABELS BAD.' as statement from f
union all select source_file, '5', 'warning', 'INCOMPLETE_STATEMENT', 'SPSS statement does not end with a period.', 'RECODE open' from f""",
)


@query
def source_places(spark, d):
    e = table(spark, d, "clusters").select("row_id", F.nullif(F.col("cluster_label"), F.lit("Someday")).alias("f"), F.when(F.col("cluster_code") != "1", F.col("row_id").cast("string")).alias("n"))
    return e.select("row_id", source_place("f", "n").alias("place"))


oracle(
    "source_places",
    f"""with e as (select row_id, coalesce(trim(nullif(cluster_label, 'Someday'), {_S}), '') as f, case when cluster_code <> '1' then row_id::varchar else '' end as n from clusters)
select row_id, case when f <> '' and n <> '' then f || ':' || n when f <> '' then f when n <> '' then 'line ' || n else 'unknown source' end as place from e""",
)


@query
def rough_append(spark, d):
    master = table(spark, d, "customer").select(F.col("c_name").alias("Case"), F.col("c_mktsegment").alias("Y1_Q1"))
    follow = table(spark, d, "supplier").select(F.col("s_name").alias("Q1"), F.col("s_suppkey").cast("string").alias("BrokerPanelId"), F.lit("x").alias("Ignored"))
    mapping = append.mapping_of([{"followup_column": "Q1", "proposed_target_column": "Y2_Q1"}, {"followup_column": "BrokerPanelId", "proposed_target_column": ""}, {"followup_column": "Ignored", "proposed_target_column": " "}])
    return append.append(master, follow, mapping)[0]


oracle("rough_append", "select c_name as \"Case\", c_mktsegment as \"Y1_Q1\", '' as \"Y2_Q1\", '' as \"Y2_BrokerPanelId\" from customer union all select '', '', s_name, s_suppkey::varchar from supplier")
