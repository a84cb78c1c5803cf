"""Queries of the core: each takes (spark, directory of tables); ORACLES has the equal SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelloom.functions.scalars import UNICODE_SPACE
from panelloom.operators import drift, orphans, rejects

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
#: The white space of Unicode as a SQL literal.
SPACE_SQL = "'" + UNICODE_SPACE + "'"


def query(f):
    """Register a query under its function's name."""
    QUERIES[f.__name__] = f
    return f


def oracle(name: str, sql: str) -> None:
    """Register the SQL that gives the same result."""
    ORACLES[name] = sql


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A table of the directory."""
    return spark.read.parquet(f"{d}/{name}.parquet")


@query
def p1_found(spark, d):
    return drift.schema_changes(table(spark, d, "mapping_files"))


@query
def p1_unified(spark, d):
    return drift.unify(table(spark, d, "mapping_files"), table(spark, d, "possible_y2_mappings"))


@query
def p2_found(spark, d):
    return rejects.rejected(table(spark, d, "followup_raw")).select("record_id", "reason")


@query
def p2_broken_field(spark, d):
    return rejects.rejected(table(spark, d, "followup_raw"))


@query
def p2_loaded(spark, d):
    return rejects.loaded(table(spark, d, "followup_raw"))


def _panel(spark, d):
    return orphans.panel_references(*(table(spark, d, t) for t in ("crosswalk", "linked_master", "clusters")))


@query
def p5_found(spark, d):
    return orphans.orphan_rows(_panel(spark, d))


@query
def p5_counts(spark, d):
    return orphans.orphan_counts(_panel(spark, d))


_LINES = f"""
with sepd as (select *, coalesce(nullif(sep, ''), ',') as s from followup_raw),
head as (select file_name, regexp_replace(min_by(raw_line, record_id), '^(﻿|ï»¿)', '') as h, min_by(s, record_id) as hs
         from sepd where line_no = 1 group by 1),
heads as (select file_name, h, hs, [trim(replace(case when x[1] = '"' then x[2:-2] else x end, '""', '"'), {SPACE_SQL}) for x in
          regexp_extract_all(hs || h, hs || '("(?:[^"]|"")*"|[^"' || hs || ']*)', 1)] as names from head),
l as (select r.record_id, r.line_no, r.raw_line, h.h, h.names, h.hs,
        regexp_full_match(r.raw_line, '("([^"]|"")*"|[^"' || hs || ']*)(' || hs || '("([^"]|"")*"|[^"' || hs || ']*))*') as quoted
      from sepd r join heads h using (file_name)),
f as (select *, case when quoted then [trim(replace(case when x[1] = '"' then x[2:-2] else x end, '""', '"'), {SPACE_SQL}) for x in
        regexp_extract_all(hs || raw_line, hs || '("(?:[^"]|"")*"|[^"' || hs || ']*)', 1)] end as v from l),
g as (select *, v[list_position(names, 'ResponseId')] as rid, v[list_position(names, 'Q1')] as q1, v[list_position(names, 'Progress')] as pr from f),
data as (select * from g where line_no <> 1 and trim(coalesce(raw_line, ''), {SPACE_SQL}) <> '' and raw_line <> h and (v is null or v <> names)
      and (rid is null or not (rid = 'Response ID' or starts_with(rid, '{{"ImportId"')))),
judged as (select *, case when not quoted then 'quoting' when len(v) <> len(names) then 'column_count'
      when not regexp_full_match(rid, 'R_[A-Za-z0-9]{{15}}') or not regexp_full_match(q1, '(0*[1-5](\\.0+)?)?')
        or not regexp_full_match(pr, '0*(100|[1-9]?[0-9])(\\.0+)?') then 'invalid_value' end as reason from data)
"""
oracle("p2_found", _LINES + "select record_id, reason from judged where reason is not null")

# A field's pattern by its header, and whether the first k fields match; the grammar of a field is unambiguous.
_BREAKS = (
    _LINES.rstrip()
    + f""",
_b as (select '[{UNICODE_SPACE}]*' as any_blank),
pat as (select j.*, [case n when 'ResponseId' then '("' || bl || 'R_[A-Za-z0-9]{{15}}' || bl || '"|' || bo || 'R_[A-Za-z0-9]{{15}}' || bo || ')'
    when 'Q1' then '("' || bl || '(0*[1-5](\\.0+)?)?' || bl || '"|' || bo || '(0*[1-5](\\.0+)?)?' || bo || ')'
    when 'Progress' then '("' || bl || '0*(100|[1-9]?[0-9])(\\.0+)?' || bl || '"|' || bo || '0*(100|[1-9]?[0-9])(\\.0+)?' || bo || ')'
    else '("([^"]|"")*"|[^"' || hs || ']*)' end for n in names] as typed
  from (select *, any_blank as bl, replace(any_blank, hs, '') as bo from judged, _b) j where reason is not null)
"""
)
oracle(
    "p2_broken_field",
    _BREAKS
    + """select record_id, reason, coalesce(names[list_min([k for k in range(1, len(names) + 1)
      if not regexp_matches(raw_line, '^' || list_reduce(typed[1:k], lambda a, b: a || hs || b) || '(' || hs || '|$)')])], '') as broken_field from pat""",
)
_SLUGS = {n: n.lower().replace(" ", "_").replace("(", "").replace(")", "") for n in ("ResponseId", "BrokerPanelId", "StartDate", "EndDate", "RecordedDate", "Status", "Progress", "Duration (in seconds)", "Finished", "Q1", "Q2", "Q9_6_TEXT")}
oracle(
    "p2_loaded",
    _LINES.rstrip()
    + f""",
ok as (select j.*, file_name, [replace(case when x[1] = '"' then x[2:-2] else x end, '""', '"') for x in regexp_extract_all(hs || raw_line, hs || '("(?:[^"]|"")*"|[^"' || hs || ']*)', 1)] as f,
    list_sort([n for n in list_distinct(names) if n not in ({', '.join(f"'{n}'" for n in _SLUGS)})]) as more
  from judged j join (select record_id, file_name from followup_raw) using (record_id) where reason is null)
select record_id, file_name, line_no, """
    + ", ".join((f"trim(f[list_position(names, '{n}')], {SPACE_SQL})" if n in ("ResponseId", "Q1", "Progress") else f"f[list_position(names, '{n}')]") + f" as {slug}" for n, slug in _SLUGS.items())
    + """, '{' || coalesce(array_to_string([to_json(n)::varchar || ':' || to_json(f[list_position(names, n)])::varchar for n in more], ','), '') || '}' as extras from ok""",
)

_REFS = f"""
with m as (select *, nullif(lower(trim(psidbrokerid, {SPACE_SQL})), '') as ps, nullif(lower(trim(y2_hidbrokerpanelid, {SPACE_SQL})), '') as hid,
        coalesce(nullif(trim(psidbrokerid, {SPACE_SQL}), ''), nullif(trim(responseid, {SPACE_SQL}), ''), nullif(trim(y0_responseid, {SPACE_SQL}), ''),
                 nullif(trim(y1_responseid, {SPACE_SQL}), ''), nullif(trim(y2_responseid, {SPACE_SQL}), '')) as resp from linked_master),
refs as (
  select 'crosswalk' as table_name, 'original_id' as column_name, row_id, nullif(lower(trim(original_id, {SPACE_SQL})), '') as k, loaded_at as t from crosswalk
  union all select 'linked_master', 'y2_hidbrokerpanelid', row_id, hid, y2_linked_at from m
  union all select 'clusters', 'respondent_id', row_id, nullif(trim(respondent_id, {SPACE_SQL}), ''), loaded_at from clusters),
parents as (
  select table_name, k, count(*) filter (removed_at is null) as live, min(loaded_at) filter (removed_at is null) as first_live from (
    select 'crosswalk' as table_name, ps as k, loaded_at, removed_at from m
    union all select 'linked_master', nullif(lower(trim(hidbrokerpanelid, {SPACE_SQL})), ''), loaded_at, removed_at from crosswalk
    union all select 'clusters', resp, loaded_at, removed_at from m) where k is not null group by 1, 2),
bad as (select r.*, case when p.k is null then 'missing' when live = 0 then 'deleted' when first_live > t then 'late' end as kind
        from refs r left join parents p using (table_name, k) where r.k is not null)
"""
oracle("p5_found", _REFS + "select table_name, column_name, row_id, kind, strftime(t, '%Y-%m') as period_month from bad where kind is not null")
oracle(
    "p5_counts",
    _REFS + "select table_name, column_name, kind, strftime(t, '%Y-%m') as period_month, count(*) as orphans from bad where kind is not null group by 1, 2, 3, 4",
)
