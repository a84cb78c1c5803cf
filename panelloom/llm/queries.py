"""Queries of the operators in this subpackage; ORACLES has the equal SQL where there is one."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelloom.functions.scalars import UNICODE_SPACE
from panelloom.llm import encoding, language, mixing, survivor, tokens

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: Fields of a follow-up response that a survivor is filled with.
FILL = ("startdate", "enddate", "status", "duration_in_seconds", "q1", "q2", "q12", "q24", "q25_3", "q25_4", "q63", "q9_6_text")


def query(f):
    """Register a query under its function's name."""
    QUERIES[f.__name__] = f
    return f


def table(spark, d, name):
    """A table of the directory."""
    return spark.read.parquet(f"{d}/{name}.parquet")


def _survivors(spark, d, fill, values=True):
    return survivor.survivors(
        table(spark, d, "followup_small"), group="brokerpanelid", record="responseid", finished="finished", progress="progress", recorded="recordeddate", fill=fill, values=values
    )


@query
def p3_found(spark, d):
    best = _survivors(spark, d, ("q1", "q9_6_text"), values=False)
    text = lambda c: F.coalesce(c, F.lit(""))
    return best.select(
        F.col("_group").alias("broker_panel_id"),
        text(F.col("responseid")).alias("response_id"),
        text(F.col("q1.source")).alias("q1_response_id"),
        text(F.col("q9_6_text.source")).alias("q9_6_text_response_id"),
    )


@query
def p3_survivors(spark, d):
    best = _survivors(spark, d, FILL)
    return best.select(F.col("_group").alias("broker_panel_id"), F.col("_size").alias("records"), "responseid", *[F.col(f"{c}.value").alias(c) for c in FILL])


@query
def p4_found(spark, d):
    return encoding.repair(table(spark, d, "followup_small"), key="row_id", text="q9_6_text").where("damaged").select("row_id")


@query
def p4_repaired(spark, d):
    return encoding.repair(table(spark, d, "followup_small"), key="row_id", text="q9_6_text").where("damaged")


@query
def p6_ids(spark, d):
    return tokens.encode(table(spark, d, "documents"))


@query
def p7_selection(spark, d):
    return mixing.mix_documents(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


@query
def p7_shares(spark, d):
    return mixing.mix_documents(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def _accepted(spark, d):
    """Documents sized in characters: each belongs to its source, accepted answers also to a source of their own."""
    sources = F.array_compact(F.array("source", F.when(F.col("is_accepted"), F.lit("accepted"))))
    sized = table(spark, d, "documents").select("doc_id", sources.alias("sources"), F.col("n_chars").alias("tokens"))
    targets = table(spark, d, "mix_targets").select("source", (F.col("target_share") * 0.75).alias("target_share"), "max_repeats")
    return sized, targets.unionByName(spark.createDataFrame([("accepted", 0.25, 2)], targets.schema))


@query
def p7_overlap_selection(spark, d):
    return mixing.mix(*_accepted(spark, d))[0]


@query
def p7_overlap_shares(spark, d):
    sized, targets = _accepted(spark, d)
    selection, shares = mixing.mix(sized, targets)
    # Whether no document is used more often than its source admits, nor by a source that doesn't hold it.
    held = sized.select("doc_id", F.explode("sources").alias("source"), F.lit(True).alias("held")).distinct()
    kept = selection.join(targets, "source").join(held, ["doc_id", "source"], "left").groupBy("source").agg(F.min((F.col("uses") <= F.col("max_repeats")) & F.coalesce("held", F.lit(False))).alias("kept"))
    within = F.col("selected_tokens") <= F.least(F.col("quota_tokens") * 1.01, F.col("available_tokens") * F.col("max_repeats"))
    return shares.join(kept, "source", "left").select("source", "quota_tokens", "available_tokens", F.coalesce("kept", F.lit(True)).alias("within_limits"), within.alias("within_quota"))


@query
def p8_found(spark, d):
    return language.cases(table(spark, d, "documents"))


@query
def p8_languages(spark, d):
    judged = language.judge(table(spark, d, "documents"))
    return judged.select("doc_id", "declared", F.explode_outer("languages").alias("l")).select("doc_id", "declared", F.col("l.lang").alias("lang"), F.col("l.confidence").alias("confidence"), F.col("l.words").alias("words"))


@query
def p8_segments(spark, d):
    judged = language.judge(table(spark, d, "documents"))
    return judged.select("doc_id", F.posexplode("segments").alias("position", "s")).select("doc_id", "position", F.col("s.lang").alias("lang"), F.col("s.confidence").alias("confidence"), F.col("s.words").alias("words"), F.col("s.sentences").alias("sentences"))


_S = "'" + UNICODE_SPACE + "'"
_RANKED = f"""
with r as (select *, lower(trim(brokerpanelid, {_S})) as k, lower(trim(finished, {_S})) as fin, trim(regexp_replace(trim(progress, {_S}), '%$', ''), {_S}) as pro,
      trim(recordeddate, {_S}) as rec from followup_small),
n as (select *, case when fin in ('1','1.0','true','yes','y','t') then 1 when fin in ('0','0.0','false','no','n','f') then 0 else -1 end as a,
      coalesce(case when regexp_full_match(pro, '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)') then try_cast(pro as double) end, '-infinity'::double) as b,
      coalesce(
        case when regexp_full_match(rec, '[0-9]{{1,7}}(\\.[0-9]*)?') then round(rec::double * 86400)::bigint - 2209161600 end,
        case when regexp_full_match(rec, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}} [0-9:]+') then epoch(try_strptime(rec, '%Y-%m-%d %H:%M:%S'))::bigint end,
        case when regexp_full_match(rec, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}T[0-9:]+Z') then epoch(try_strptime(rec, '%Y-%m-%dT%H:%M:%SZ'))::bigint end,
        case when regexp_full_match(rec, '[0-9]{{1,2}}-[A-Za-z]{{3}}-[0-9]{{4}} [0-9:]+') then epoch(try_strptime(rec, '%d-%b-%Y %H:%M:%S'))::bigint end,
        case when regexp_full_match(rec, '[0-9T:-]+[+-][0-9]{{2}}:[0-9]{{2}}') then epoch(try_strptime(rec[:-7], '%Y-%m-%dT%H:%M:%S'))::bigint
          - (case when rec[-6] = '-' then -1 else 1 end) * (rec[-5:-4]::int * 3600 + rec[-2:]::int * 60) end,
        -4611686018427387904) as t from r where k <> ''),
"""
oracle = ORACLES.__setitem__
oracle(
    "p3_found",
    _RANKED
    + f"""
w as (select k, responseid, row_number() over (partition by k order by a desc, b desc, t desc, responseid desc nulls last) as n,
      case when trim(q1, {_S}) <> '' then responseid end as q1r, case when trim(q9_6_text, {_S}) <> '' then responseid end as txr from n)
select k as broker_panel_id, coalesce(arg_min(responseid, n), '') as response_id, coalesce(arg_min(q1r, n) filter (q1r is not null), '') as q1_response_id,
  coalesce(arg_min(txr, n) filter (txr is not null), '') as q9_6_text_response_id from w group by k having count(*) >= 2""",
)
_MIXED = """
with d as (select doc_id, source, n_chars from documents where source is not null union all select doc_id, 'accepted', n_chars from documents where is_accepted),
t as (select source, target_share * 0.75 as share from mix_targets union all select 'accepted', 0.25)
select source, round(share * (select sum(n_chars) from documents))::bigint as quota_tokens, coalesce(sum(n_chars), 0)::bigint as available_tokens, true as within_limits, true as within_quota
from t left join d using (source) group by source, share"""
oracle("p7_overlap_shares", _MIXED)
_BEST = ", ".join(f"first({c} order by n, {c} desc) filter (trim({c}, {_S}) <> '') as {c}" for c in FILL)
oracle(
    "p3_survivors",
    _RANKED
    + f"""
w as (select *, rank() over (partition by k order by a desc, b desc, t desc, responseid desc nulls last) as n from n)
select k as broker_panel_id, count(*) as records, arg_min(responseid, n) as responseid, {_BEST} from w group by k having count(*) >= 2""",
)
