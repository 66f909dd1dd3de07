"""Ranking, sets, roll-ups and accounting over orders, customers and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rank, rollup
from ..shared import shared_path
from ..sources import io
from .registry import query, table

#: How event types stand for availability in the roll-up queries.
_STATE = "case when event_type = 'purchase' and event_id % 40 = 0 then 'available' when event_type = 'click' and event_id % 30 = 0 then 'ambiguous' when event_type = 'view' and event_id % 20 = 0 then 'blocked' when user_id % 7 = 0 then 'failed' else 'not_available' end"
_SECTION = "case user_id % 3 when 0 then 'identity' when 1 then 'hiring' else 'web' end"


@query("select user_id, event_type, event_id from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as k from events where user_id is not null and event_type is not null) where k = 1")
def w1_latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    return rank.latest_per_key(table(spark, d, "events").select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"], "ts", "event_id").select("user_id", "event_type", "event_id")


@query("select user_id, event_id, lower(event_type) as name_key from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as k from events) where k = 1 and event_id % 2 = 0")
def w2_active_index(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type", F.when(F.col("event_id") % 2 == 0, F.lit("ACTIVE")).otherwise(F.lit("INACTIVE")).alias("status"))
    return rank.active_index(rank.latest_per_key(rows, ["user_id"], "ts", "event_id"), F.lower("event_type")).select("user_id", "event_id", "name_key")


@query("select o_custkey, o_orderstatus, o_orderkey from (select *, row_number() over (partition by o_custkey, o_orderstatus order by o_orderdate, o_orderkey) as k from orders) where k = 1")
def w3_first_wins(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_orderdate", "o_orderkey")
    return rank.first_wins(rows, ["o_custkey", "o_orderstatus"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderstatus", "o_orderkey")


@query("select o_custkey, o_orderkey, k as rank from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as k from orders) where k <= 3")
def w4_top_n_per_entity(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return rank.top_n_per_entity(rows, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 3).select("o_custkey", "o_orderkey", F.col("rank").cast("long").alias("rank"))


@query(
    """with y as (select o_custkey, year(o_orderdate) as period, round(sum(o_totalprice)) - 200000 as value from orders group by 1, 2),
    l as (select *, lag(value) over w as prior, lead(period) over w as after from y window w as (partition by o_custkey order by period)),
    p as (select *, case when prior <> 0 then round(100 * (value - prior) / abs(prior), 1) end as pct from l where after is null)
    select o_custkey as entity_id, period, value, prior, pct, case when prior is null then 'first' when prior = 0 then 'from_zero' when prior > 0 and value < 0 then 'to_loss'
      when prior < 0 and value > 0 then 'to_profit' when pct >= 0.5 then 'rose' when pct <= -0.5 then 'fell' else 'flat' end as trend from p"""
)
def w5_period_trend(spark: SparkSession, d: str) -> DataFrame:
    facts = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("entity_id"), F.year("o_orderdate").cast("long").alias("period")).agg((F.round(F.sum("o_totalprice")) - 200000).alias("value"))
    return rank.period_trend(facts.withColumn("field", F.lit("turnover"))).drop("field")


@query(
    """with c as (select o_custkey as entity_id, o_orderkey as ord, o_orderpriority as url,
        case when o_orderstatus = 'F' and o_orderkey % 3 = 0 then 'exact' when o_orderstatus = 'O' then 'review' else 'related' end as status, o_custkey % 3 as n_words from orders),
    r as (select *, row_number() over (partition by entity_id order by ord) as i from c),
    g as (select entity_id, min(i) filter (status = 'exact') as e, min(i) filter (status = 'review') as v, max(n_words) as nw, max(i) as n from r where i <= 4 group by 1)
    select g.entity_id, case when e is not null or (v is not null and nw >= 2) then (select url from r where r.entity_id = g.entity_id and r.i = coalesce(e, v)) end as url,
      case when e is not null then 'available' when v is not null and nw >= 2 then 'ambiguous' else 'not_available' end as state, coalesce(e, n) as candidates_read from g"""
)
def w6_pick_site(spark: SparkSession, d: str) -> DataFrame:
    status = F.expr("case when o_orderstatus = 'F' and o_orderkey % 3 = 0 then 'exact' when o_orderstatus = 'O' then 'review' else 'related' end")
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("entity_id"), F.col("o_orderkey").alias("ord"), F.col("o_orderpriority").alias("url"), status.alias("status"), F.expr("o_custkey % 3").alias("n_words"))
    return rank.pick_site(rows)


@query(
    r"""with l as (select regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) as site, url, regexp_extract(url, '^[a-z]+://[^/]*/([a-z]{2})/', 1) as kind,
        len(list_filter(string_split(regexp_replace(regexp_extract(url, '^[a-z]+://[^/]*([^?#]*)', 1), '^/', ''), '/'), lambda x: x <> '')) as depth from pages),
    r as (select *, list_position(['en', 'de', 'es', 'fr'], kind) as kr, row_number() over (partition by site, kind order by depth, length(url), url) as i from l),
    f as (select *, row_number() over (partition by site order by (i > 1)::int, kr, depth, length(url), url) as rank from r)
    select site, rank, kind, url from f where rank <= 7"""
)
def w7_frontier_rank(spark: SparkSession, d: str) -> DataFrame:
    path = F.regexp_extract("url", r"^[a-z]+://[^/]*([^?#]*)", 1)
    rows = table(spark, d, "pages").select(F.regexp_extract("url", r"^[a-z]+://([^/?#]*)", 1).alias("site"), "url", F.regexp_extract("url", r"^[a-z]+://[^/]*/([a-z]{2})/", 1).alias("kind"), F.size(F.filter(F.split(path, "/"), lambda x: x != "")).alias("depth"))
    return rank.frontier_rank(rows, ["en", "de", "es", "fr"]).select("site", F.col("rank").cast("long").alias("rank"), "kind", "url")


@query("select user_id as site, strftime(max(ts), '%Y-%m-%d') as lastmod, max_by(event_id, ts) as url from (select *, row_number() over (partition by user_id order by event_id) as pos from events) where pos <= 20 group by 1")
def w8_newest_lastmod(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select(F.col("user_id").alias("site"), F.col("event_id").alias("url"), F.col("ts").alias("lastmod"))
    rows = rank.top_n_per_entity(rows, ["site"], [F.col("url")], 20).withColumnRenamed("rank", "pos")
    return rank.newest_lastmod(rows, 20).select("site", F.date_format("lastmod", "yyyy-MM-dd").alias("lastmod"), "url")


@query("select c_custkey from (select c_custkey from customer where c_acctbal > 0 order by sha256('7|' || c_custkey), c_custkey limit 100)")
def w9_stable_sample(spark: SparkSession, d: str) -> DataFrame:
    return rank.stable_sample(table(spark, d, "customer").where("c_acctbal > 0").select("c_custkey"), "c_custkey", 100, 7)


@query("select doc_id, b as bucket, case when b < 60 then 'development' when b < 80 then 'validation' else 'final' end as split from (select doc_id, ('0x' || substr(sha256(doc_id::varchar), 1, 8))::bigint % 100 as b from documents)")
def w10_hash_split(spark: SparkSession, d: str) -> DataFrame:
    return rank.hash_split(table(spark, d, "documents").select("doc_id"), "doc_id")


#: What users did in the two halves of months, in kinds fine enough for the halves to differ.
_HALVES = "e as (select user_id, event_type || event_id % 40 as event_type, day(ts) <= 15 as early from events), a as (select distinct user_id, event_type from e where early), b as (select distinct user_id, event_type from e where not early)"


def _halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, d, "events").selectExpr("user_id", "concat(event_type, event_id % 40) as event_type", "day(ts) <= 15 as early")
    return tuple(e.where(h).select("user_id", "event_type").distinct() for h in ("early", "not early"))


@query(f"with {_HALVES} select source, count(*) as n from (select 'a' as source from a union all select 'b' from b) group by 1")
def s1_union(spark: SparkSession, d: str) -> DataFrame:
    a, b = _halves(spark, d)
    return a.withColumn("source", F.lit("a")).unionByName(b.withColumn("source", F.lit("b"))).groupBy("source").agg(F.count("*").alias("n"))


@query(f"with {_HALVES} select user_id, string_agg(event_type, ',' order by event_type) as added from (select * from b except select * from a) group by 1")
def s2_new_items(spark: SparkSession, d: str) -> DataFrame:
    a, b = (x.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias(n)) for x, n in zip(_halves(spark, d), "ab", strict=True))
    out = b.join(a, "user_id", "left").withColumn("added", F.array_join(rank.new_items(F.col("b"), F.col("a")), ","))
    return out.where("added <> ''").select("user_id", "added")


@query(f"with {_HALVES} select *, 'added' as side from (select * from b except select * from a) union all select *, 'removed' from (select * from a except select * from b)")
def s3_added_removed(spark: SparkSession, d: str) -> DataFrame:
    a, b = _halves(spark, d)
    return rank.added_removed(a, b, ["user_id", "event_type"])


@query(f"with {_HALVES} select *, 'right' as side from (select * from b except select * from a) union all select *, 'left' from (select * from a except select * from b)")
def s4_symmetric_difference(spark: SparkSession, d: str) -> DataFrame:
    return rank.symmetric_difference(*_halves(spark, d))


@query(f"with {_HALVES} select user_id, bool_and((user_id, event_type) in (select (user_id, event_type) from b)) as kept_all from a group by 1")
def s5_is_subset(spark: SparkSession, d: str) -> DataFrame:
    a, b = (x.groupBy("user_id").agg(F.collect_set("event_type").alias(n)) for x, n in zip(_halves(spark, d), "ab", strict=True))
    none = F.array().cast("array<string>")
    return a.join(b, "user_id", "left").select("user_id", rank.is_subset(F.col("a"), F.coalesce("b", none)).alias("kept_all"))


def _claims(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").selectExpr("user_id as entity_id", f"{_SECTION} as section", f"{_STATE} as availability", "event_id")


_ROLLED = f"""c as (select user_id as entity_id, {_SECTION} as section, {_STATE} as availability from events),
  s as (select entity_id, section, min(list_position(['available', 'ambiguous', 'blocked', 'not_available', 'failed'], availability)) as r from c group by 1, 2),
  w as (select entity_id, unnest(['identity', 'hiring', 'web']) as section from (select distinct user_id as entity_id from events)),
  st as (select w.entity_id, w.section, coalesce(['available', 'ambiguous', 'blocked', 'not_available', 'failed'][r], 'not_available') as state from w left join s using (entity_id, section))"""


def _states(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events")
    some = rows.selectExpr("user_id as entity_id", f"{_SECTION} as section", f"{_STATE} as availability")
    return rollup.section_state(some, rows.select(F.col("user_id").alias("entity_id")).distinct(), ["identity", "hiring", "web"])


@query(f"with {_ROLLED} select * from st")
def a1_section_state(spark: SparkSession, d: str) -> DataFrame:
    return _states(spark, d)


@query(
    f"""with {_ROLLED}, f as (select distinct user_id as entity_id from events where event_type = 'error' and event_id % 7 = 0)
    select entity_id, section, case when section = 'hiring' and state = 'not_available' and entity_id in (select entity_id from f) then 'failed' else state end as state from st"""
)
def a2_hiring_override(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "events").selectExpr("user_id as entity_id", "if(event_type = 'error', 'active_job_count', 'job_posting') as field", "if(event_id % 7 = 0, 'failed', 'available') as availability")
    return rollup.hiring_override(_states(spark, d), counts)


@query(f"with {_ROLLED} select entity_id, case when bool_or(section = 'identity' and state = 'failed') then 'failed' when bool_or(state = 'failed') then 'completed_with_errors' else 'completed' end as status from st group by 1")
def a3_terminal_status(spark: SparkSession, d: str) -> DataFrame:
    return rollup.terminal_status(_states(spark, d))


_COUNTS = "select user_id as entity_id, count(*) filter (where event_type = 'purchase' and event_id % 4 = 0) as accepted, count(*) filter (where event_type = 'error' and event_id % 9 = 0) as unchecked, count(*) filter (where event_type = 'click') as rejected from events group by user_id"


@query(
    f"""select entity_id, case when unchecked > 0 and accepted = 0 then null else accepted end as value, case when unchecked > 0 and accepted = 0 then 'failed' else 'available' end as availability,
    case when unchecked > 0 and accepted = 0 then unchecked || ' unread, the count is unknown' when accepted = 0 then 'none accepted, ' || rejected || ' rejected' when unchecked > 0 then accepted || ' confirmed, ' || unchecked || ' unread: a floor' end as note from ({_COUNTS})"""
)
def a4_count_semantics(spark: SparkSession, d: str) -> DataFrame:
    n = lambda c: F.count(F.when(F.expr(c), 1))
    rows = table(spark, d, "events").groupBy(F.col("user_id").alias("entity_id")).agg(n("event_type = 'purchase' and event_id % 4 = 0").alias("accepted"), n("event_type = 'error' and event_id % 9 = 0").alias("unchecked"), n("event_type = 'click'").alias("rejected"))
    return rollup.count_semantics(rows)


@query(
    """with p as (select o_orderkey as id, o_orderstatus as status, o_orderkey % 7 as requests, o_custkey as bytes, floor(o_totalprice)::bigint as ms, o_orderkey % 400 = 0 as exhausted, o_orderkey % 3 as problems from orders), n as (select count(*) as n from p)
    select 'entities' as metric, count(*)::bigint as value from p union all select 'requests', sum(requests)::bigint from p union all select 'bytes', sum(bytes)::bigint from p union all select 'cost_usd_e4', (count(*) * 5)::bigint from p
    union all select 'validation_problems', sum(problems)::bigint from p union all select 'p50_ms', floor(median(ms))::bigint from p union all select 'status:' || status, count(*) from p group by status
    union all select 'p95_ms', ms from (select ms, row_number() over (order by ms) as k from p), n where k = greatest(1, floor(n * 0.95)) union all select 'exhausted:' || id, 1 from p where exhausted
    union all select 'section:' || o_orderpriority || ':' || o_orderstatus, count(*) from orders group by o_orderpriority, o_orderstatus union all select 'field:' || event_type, count(*) from events where event_id % 3 > 0 group by event_type
    union all select 'change:' || c_mktsegment, count(*) from customer group by c_mktsegment"""
)
def a5_run_report(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    p = o.selectExpr("o_orderkey as entity_id", "o_orderstatus as status", "o_orderkey % 7 as requests", "o_custkey as bytes", "cast(floor(o_totalprice) as bigint) as elapsed_ms", "0.0005D as cost_usd", "o_orderkey % 400 = 0 as exhausted", "o_orderkey % 3 as problems")
    claims = table(spark, d, "events").selectExpr("event_type as field", "if(event_id % 3 > 0, 'available', 'failed') as availability")
    return rollup.run_report(p, o.selectExpr("o_orderpriority as section", "o_orderstatus as state"), claims, table(spark, d, "customer").selectExpr("c_mktsegment as change_type"))


@query("select case when event_type in ('view', 'click') then 'web' else 'hiring' end as family, count(distinct user_id) as entities, count(*) as claims, round(count(distinct user_id) / (select count(distinct user_id) from events), 3) as coverage from events where event_id % 11 = 0 and event_type <> 'error' group by 1")
def a6_coverage_score(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    rows = e.selectExpr("user_id as entity_id", "event_type as field", "if(event_id % 11 = 0 and event_type <> 'error', 'available', 'failed') as availability")
    families = e.select(F.col("event_type").alias("field")).distinct().withColumn("family", F.expr("if(field in ('view', 'click'), 'web', 'hiring')"))
    return rollup.coverage_score(rows, families, e.select("user_id").distinct().count())


@query(
    """with c as (select o_orderkey, case o_orderstatus when 'F' then 'available' when 'O' then 'failed' else 'blocked' end as availability, case o_orderkey % 4 when 0 then [] when 1 then [o_orderkey || '-1', 'gone'] else [o_orderkey || '-1'] end as ids from orders),
    e as (select distinct l_orderkey || '-' || l_linenumber as id from lineitem), x as (select o_orderkey, unnest(ids) as id from c), lost as (select distinct o_orderkey from x where id not in (select id from e))
    select 'evidence_completeness' as metric, round(1 - avg((len(ids) = 0 or o_orderkey in (select o_orderkey from lost))::int), 4) as value from c where availability = 'available'
    union all select 'state:' || availability, count(*)::double from c group by availability union all select 'requests_total', sum(o_orderkey % 7)::double from orders union all select 'requests_mean', round(avg(o_orderkey % 7), 1) from orders union all select 'requests_max', max(o_orderkey % 7)::double from orders"""
)
def a6_coverage_report(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    ids = "case o_orderkey % 4 when 0 then array() when 1 then array(concat(o_orderkey, '-1'), 'gone') else array(concat(o_orderkey, '-1')) end as evidence_ids"
    claims = o.selectExpr("1 as entity_id", "o_orderkey as claim_id", "case o_orderstatus when 'F' then 'available' when 'O' then 'failed' else 'blocked' end as availability", ids)
    evidence = table(spark, d, "lineitem").selectExpr("1 as entity_id", "concat(l_orderkey, '-', l_linenumber) as evidence_id")
    return rollup.coverage_report(claims, evidence, o.selectExpr("o_orderkey % 7 as requests"))


@query(
    """with j as (select case when d.n_chars > 1500 then 'long' end as predicted, case when l.quality = 1 then 'long' end as expected, l.toxic = 1 as wrong from labels l left join documents d using (doc_id)),
    s as (select sum((predicted is not null and predicted = expected)::int) as tp, sum((predicted is not null and (expected is null or predicted <> expected))::int) as fp,
      sum((expected is not null and (predicted is null or predicted <> expected))::int) as fn, sum(coalesce(wrong, false)::int) as wrong from
      (select predicted, expected, wrong from j))
    select coalesce(tp, 0)::bigint as tp, coalesce(fp, 0)::bigint as fp, coalesce(fn, 0)::bigint as fn, wrong::bigint as wrong, round(tp / nullif(tp + fp, 0), 3) as precision, round(tp / nullif(tp + fn, 0), 3) as recall from s"""
)
def a7_precision_recall(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id", "left")
    return rollup.precision_recall(j.selectExpr("if(n_chars > 1500, 'long', null) as predicted", "if(quality = 1, 'long', null) as expected", "toxic = 1 as wrong"))


@query(
    """with c as (select o_custkey as entity_id, o_orderpriority as value, strftime(o_orderdate, '%Y-%m-%d') || '|' || lpad(o_orderkey::varchar, 12, '0') as effective_date, o_orderstatus as field, o_orderkey % 10 > 0 as ok from orders)
    select entity_id, max_by(value, effective_date) filter (field = 'F' and ok) as "F", max_by(value, effective_date) filter (field in ('O', 'P') and ok) as open, max(effective_date) filter (ok) as latest_date, count(*) filter (ok) as n_claims,
      count(*) filter (ok and field = 'P') as n_leaders, count(distinct field) filter (ok) as sections_available, coalesce((select count(*) from events e where e.user_id = c.entity_id), 0) as n_changes from c group by 1"""
)
def a8_directory_summary(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "orders").selectExpr("o_custkey as entity_id", "o_orderpriority as value", "concat(date_format(o_orderdate, 'yyyy-MM-dd'), '|', lpad(cast(o_orderkey as string), 12, '0')) as effective_date", "o_orderstatus as field", "if(o_orderkey % 10 > 0, 'available', 'failed') as availability")
    states = c.groupBy("entity_id", "field").agg(F.min("availability").alias("state"))
    return rollup.directory_summary(c, states, {"F": ["F"], "open": ["O", "P"]}, table(spark, d, "events").selectExpr("user_id as entity_id"), ["P"])


_LOG = "select case when user_id % 10 = 0 then '_shared' else 'c' || user_id end as company, 1 + event_id % 3 as attempts, event_id % 1000 as bytes from events"


@query(f"with l as ({_LOG}) select company, sum(attempts)::bigint as requests, sum(bytes)::bigint as bytes from l where company not like '\\_%' escape '\\' group by 1 union all select 'total', sum(attempts)::bigint, sum(bytes)::bigint from l")
def a9_request_accounting(spark: SparkSession, d: str) -> DataFrame:
    return rollup.request_accounting(table(spark, d, "events").selectExpr("if(user_id % 10 = 0, '_shared', concat('c', user_id)) as company", "1 + event_id % 3 as attempts", "event_id % 1000 as bytes"))


@query(
    """with l as (select user_id % 20 as host, case event_id % 6 when 0 then 'certificate has expired' when 1 then 'Hostname mismatch' when 2 then 'reset by peer' when 3 then 'unable to get local issuer certificate' end as error,
      case when event_id % 6 = 4 then 503 when event_id % 6 = 5 then 200 end as status, event_id % 17 = 0 as blocked from events where event_type = 'error')
    select case when blocked then 'blocked' when error = 'certificate has expired' then 'expired' when error = 'Hostname mismatch' then 'hostname_mismatch' when error like 'unable%' then 'incomplete_chain' when status >= 400 then 'http_' || status when error is not null then 'network' end as class,
      host, count(*) as n from l group by 1, 2 having class is not null"""
)
def a10_error_taxonomy(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "events").where("event_type = 'error'").selectExpr(
        "user_id % 20 as host", "case event_id % 6 when 0 then 'certificate has expired' when 1 then 'Hostname mismatch' when 2 then 'reset by peer' when 3 then 'unable to get local issuer certificate' end as error",
        "case when event_id % 6 = 4 then 503 when event_id % 6 = 5 then 200 end as status", "event_id % 17 = 0 as blocked", "false as budget")
    return rollup.error_taxonomy(log)


@query(
    """with r as (select user_id as host, ts, event_id, event_type = 'error' as bad, sum((event_type <> 'error')::int) over (partition by user_id order by ts, event_id) as island from events)
    select host, n, a as first_ts, b as last_ts, strftime(c + interval 90 second, '%Y-%m-%d %H:%M:%S') as cooled_at from (select host, island, count(*) as n, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as a, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as b, max(ts) as c from r where bad group by 1, 2) where n >= 3"""
)
def a11_rate_limit_runs(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "events").select(F.col("user_id").alias("host"), "ts", F.col("event_id").alias("seq"), "event_type")
    out = rollup.rate_limit_runs(log, F.col("event_type") == "error")
    return out.select("host", "n", *(F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("first_ts", "last_ts", "cooled_at")))


@query(
    """with p as (select event_id, case when user_id % 25 = 0 then '_shared' else user_id::varchar end as entity_id, ts from events),
    o as (select *, row_number() over (partition by entity_id order by ts, event_id) <= 40 or entity_id = '_shared' as ok from p),
    t as (select *, coalesce(sum(ok::int) over (order by ts, event_id rows between unbounded preceding and 1 preceding), 0) as before from o)
    select event_id, entity_id, case when not ok then 'entity_cap' when before >= 3000 then 'total_cap' else 'ok' end as verdict from t"""
)
def a12_budget_cap(spark: SparkSession, d: str) -> DataFrame:
    plan = table(spark, d, "events").select("event_id", F.expr("if(user_id % 25 = 0, '_shared', cast(user_id as string))").alias("entity_id"), "ts")
    return rollup.budget_cap(plan, 40, 3000, ["ts", "event_id"]).select("event_id", "entity_id", "verdict")


@query("select entity_id, role, string_agg(name, ', ' order by pos) filter (k <= 6) as holders, count(*) as n from (select o_custkey as entity_id, o_orderpriority as role, o_orderkey as pos, o_orderstatus as name, row_number() over (partition by o_custkey, o_orderpriority order by o_orderkey) as k from orders) group by 1, 2")
def a13_role_grouping(spark: SparkSession, d: str) -> DataFrame:
    return rollup.role_grouping(table(spark, d, "orders").selectExpr("o_custkey as entity_id", "o_orderkey as pos", "o_orderpriority as role", "o_orderstatus as name"))


@query(
    """with i as (select user_id as entity_id, strftime(ts, '%Y-%m-%d') as date, event_type as text from events union all select o_custkey, strftime(o_orderdate, '%Y-%m-%d'), 'order' from orders),
    r as (select *, row_number() over (partition by entity_id order by date desc, text desc) as k, count(*) over (partition by entity_id) as n_items from i) select entity_id, date, text, n_items from r where k = 1"""
)
def a14_latest_activity(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "events").selectExpr("user_id as entity_id", "date_format(ts, 'yyyy-MM-dd') as date", "event_type as text")
    b = table(spark, d, "orders").selectExpr("o_custkey as entity_id", "date_format(o_orderdate, 'yyyy-MM-dd') as date", "'order' as text")
    return rollup.latest_activity(a, b)


@query("select 'segment' as facet, c_mktsegment as value, count(*) as n from customer group by 2 union all select 'nation', c_nationkey::varchar, count(*) from customer group by 2")
def a15_facets(spark: SparkSession, d: str) -> DataFrame:
    return rollup.facets(table(spark, d, "customer").selectExpr("c_mktsegment as segment", "c_nationkey as nation"), ["segment", "nation"])


@query("select c_custkey, c_name, c_mktsegment as form, c_nationkey::varchar as municipality from customer where contains(lower(c_name || ' ' || c_mktsegment), '1') and c_mktsegment = 'BUILDING' and c_acctbal > 0 and c_custkey % 3 > 0")
def a15_directory_filter(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").selectExpr("c_custkey", "c_name", "c_mktsegment as form", "cast(c_nationkey as string) as municipality", "if(c_acctbal > 0, 'w', '') as website", "c_custkey % 3 as jobs")
    return rollup.directory_filter(c, "1", ["c_name", "form"], form="BUILDING", has_website=True, hiring=True, sort="municipality").select("c_custkey", "c_name", "form", "municipality")


@query("select count(*) as selected, count(case when n_nationkey % 3 = 0 then 1 end) as with_website, sha256(string_agg(n_name, chr(10) order by n_name)) as ids_sha256, (select count(*) from customer where c_acctbal > 0) as eligible from nation")
def a16_batch_manifest(spark: SparkSession, d: str) -> DataFrame:
    return rollup.batch_manifest_stats(table(spark, d, "nation").selectExpr("n_name as id", "if(n_nationkey % 3 = 0, 'x', null) as website"), table(spark, d, "customer").where("c_acctbal > 0"))


@query(
    """with p as (select user_id as entity_id, case when event_id % 5 = 0 and user_id % 5 < 4 then 'registry' else 'other' end as origin,
      case user_id % 5 when 0 then 'unreachable' when 1 then case when event_type = 'view' then 'blocked' else 'unproven' end when 2 then case when event_id % 5 = 0 then 'unreachable' else 'unproven' end when 3 then 'unproven' else case when event_type = 'view' then 'unreachable' else 'unproven' end end as outcome from events),
    f as (select entity_id, bool_or(origin = 'registry' and outcome = 'blocked') as b, bool_or(origin = 'registry' and outcome = 'unreachable') as u, bool_or(origin = 'registry' and outcome = 'unproven') as p, bool_and(outcome = 'unreachable') as a from p group by 1)
    select entity_id, case when b then 'blocked' when u then 'failed' when p then 'ambiguous' when a then 'failed' else 'not_available' end as state,
      case when b then 'registry site blocked' when u then 'registry site unreachable' when p then 'registry site unproven' when a then 'no candidate reachable' else 'no candidate proven' end as reason from f"""
)
def a17_web_fallback_state(spark: SparkSession, d: str) -> DataFrame:
    outcome = "case user_id % 5 when 0 then 'unreachable' when 1 then if(event_type = 'view', 'blocked', 'unproven') when 2 then if(event_id % 5 = 0, 'unreachable', 'unproven') when 3 then 'unproven' else if(event_type = 'view', 'unreachable', 'unproven') end as outcome"
    rows = table(spark, d, "events").selectExpr("user_id as entity_id", "if(event_id % 5 = 0 and user_id % 5 < 4, 'registry', 'other') as origin", outcome)
    return rollup.web_fallback_state(rows)


#: Lines of an id batch made of orders: JSON, CSV and rubbish in turn; customers stand for ids of nine digits.
_LINES = "select o_orderkey as pos, case o_orderkey % 4 when 0 then '{\"org\": \"' || lpad(o_custkey::varchar, 9, '9') || '\"}' when 1 then lpad(o_custkey::varchar, 9, '9') || ',x' when 2 then 'no id ' || o_custkey else lpad(o_custkey::varchar, 9, '9') end as line from orders"


def _id_lines(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    line = "case o_orderkey % 4 when 0 then concat('{\"org\": \"', lpad(cast(o_custkey as string), 9, '9'), '\"}') when 1 then concat(lpad(cast(o_custkey as string), 9, '9'), ',x') when 2 then concat('no id ', o_custkey) else lpad(cast(o_custkey as string), 9, '9') end as line"
    return io.parse_id_lines(table(spark, d, "orders").selectExpr("o_orderkey as pos", line))


@query(f"with l as ({_LINES}) select min(pos) as pos, regexp_extract(line, '9*[0-9]+', 0) as id from l where line not like 'no id%' group by 2")
def io1_read_id_batch(spark: SparkSession, d: str) -> DataFrame:
    return _id_lines(spark, d)[0]


@query(f"with l as ({_LINES}), r as (select *, line like 'no id%' as bad, row_number() over (partition by line like 'no id%', regexp_extract(line, '9*[0-9]+', 0) order by pos) as k from l) select pos, line, case when bad then 'invalid' else 'duplicate' end as reason from r where bad or k > 1")
def io1_rejects(spark: SparkSession, d: str) -> DataFrame:
    return _id_lines(spark, d)[1]


@query("select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'P')")
def io2_load_reference_subset(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("id"))
    return io.load_reference_subset(table(spark, d, "customer").select("c_custkey", "c_name"), ids, "c_custkey")


@query("select k as key, max_by(props, event_id) as doc from (select *, json_extract_string(props, '$.k') as k from events where event_id % 50 <> 0) where k is not null group by 1")
def io3_latest_documents(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "events").selectExpr("event_id as pos", "if(event_id % 50 = 0, 'broken line', props) as line")
    return io.latest_documents(lines, "k")


@query("select sha256(text) as sha256, 'txt' as kind, min(lpad(doc_id::varchar, 9, '0')) as first_path, sha256(text) || '.txt' as stored_as, count(*) as copies from documents where text is not null group by text")
def io4_snapshot_store(spark: SparkSession, d: str) -> DataFrame:
    return io.snapshot_store(table(spark, d, "documents").where("text is not null").selectExpr("text as body", "'txt' as kind", "lpad(cast(doc_id as string), 9, '0') as path"))


@query("select o_orderkey, o_custkey, o_totalprice from orders where o_orderkey in (select l_orderkey from lineitem where l_quantity > 49 and l_partkey % 10 = 0)")
def io2_converted_reference(spark: SparkSession, d: str) -> DataFrame:
    """Orders converted once, then asked for those of some lines."""
    path = shared_path(spark, "reference")
    io.convert_reference(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), path, "o_orderkey")
    ids = table(spark, d, "lineitem").where("l_quantity > 49 and l_partkey % 10 = 0").select(F.col("l_orderkey").alias("id"))
    return io.load_converted_subset(spark.read.parquet(path), ids, "o_orderkey")


@query(
    """with b as (select doc_id, text, 0 as batch from documents where doc_id % 3 < 2 and text is not null union all select doc_id, text, 1 from documents where doc_id % 3 > 0 and text is not null),
    f as (select sha256(text) as sha256, min(batch) as batch from b group by 1)
    select f.sha256, f.batch::bigint as batch, min(lpad(doc_id::varchar, 9, '0')) as first_path, count(*) as copies, sha256(any_value(b.text)) as body_sha256 from f join b on sha256(b.text) = f.sha256 and b.batch = f.batch group by 1, 2"""
)
def io4_snapshot_batches(spark: SparkSession, d: str) -> DataFrame:
    """Two batches of documents that share a third of them, the second one added twice."""
    docs = table(spark, d, "documents").selectExpr("text as body", "'txt' as kind", "lpad(cast(doc_id as string), 9, '0') as path", "doc_id")
    store = io.SnapshotStore(spark, shared_path(spark, "snapshots"))
    for batch, part in ((0, "doc_id % 3 < 2"), (1, "doc_id % 3 > 0"), (1, "doc_id % 3 > 0")):
        store.add(docs.where(part), batch)
    return store.rows().select("sha256", "batch", "first_path", "copies", F.sha2("body", 256).alias("body_sha256"))


@query("select c_custkey as pos, 'c' || c_custkey as id, n as orders from customer left join (select o_custkey, count(*) as n from orders group by 1) on c_custkey = o_custkey")
def io5_ordered_profiles(spark: SparkSession, d: str) -> DataFrame:
    profile = table(spark, d, "orders").groupBy(F.concat(F.lit("c"), "o_custkey").alias("entity_id")).agg(F.count("*").alias("orders"))
    return io.ordered_profiles(profile, table(spark, d, "customer").selectExpr("c_custkey as pos", "concat('c', c_custkey) as id"))


@query("select c_custkey as id from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')")
def io6_resume_todo(spark: SparkSession, d: str) -> DataFrame:
    return io.resume_todo(table(spark, d, "customer").selectExpr("c_custkey as id"), table(spark, d, "orders").where("o_orderstatus = 'P'").selectExpr("o_custkey as id"))


@query("select event_id, user_id from events where ts >= (select max(ts) from events) - interval 7 day")
def io8_feed_source(spark: SparkSession, d: str) -> DataFrame:
    return io.feed_source(table(spark, d, "events"), 7, "ts").select("event_id", "user_id")
