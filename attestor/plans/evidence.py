"""Claims, joins, changes, audits and texts over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import diff, joins, normalise, quality, synth
from ..shared import dealt, shared_path
from .registry import query, table


@query("select c_custkey, coalesce(o.status, c_mktsegment) as segment, case when o.status is not null then 'live' else 'seed' end as origin from customer left join (select o_custkey, max_by(o_orderpriority, o_orderkey) as status from orders where o_orderstatus = 'P' group by 1) o on c_custkey = o_custkey")
def j1_seed_enrich(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").selectExpr("c_custkey", "c_mktsegment as segment")
    live = table(spark, d, "orders").where("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by("o_orderpriority", "o_orderkey").alias("segment"))
    return joins.seed_enrich(c, c, live, "c_custkey", ["segment"])


def _order_claims(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """An order as a claim whose evidence are its line items; the first id given does not exist."""
    o = table(spark, d, "orders")
    claims = o.selectExpr("cast(o_custkey as string) as entity_id", "cast(o_orderkey as string) as claim_id", "if(o_orderkey % 5 = 0, array('gone'), if(o_orderkey % 5 = 1, array('gone', concat(o_orderkey, '-2'), concat(o_orderkey, '-1')), if(o_orderkey % 5 = 2, array(), array(concat(o_orderkey, '-1'))))) as evidence_ids", "'available' as availability")
    key, fields = ["entity_id", "evidence_id"], ("source_url", "source_class", "retrieved_at", "content_sha256", "claim_span")
    li = table(spark, d, "lineitem").join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    ev = li.selectExpr("cast(o_custkey as string) as entity_id", "concat(l_orderkey, '-', l_linenumber) as evidence_id", "concat('part/', l_partkey) as source_url", "l_linestatus as source_class", "date_format(l_shipdate, 'yyyy-MM-dd') as retrieved_at", "l_returnflag as content_sha256", "cast(l_suppkey as string) as claim_span")
    # of rows with one id the least, not any: the evidence is read more than once and has to be the same each time
    return claims, ev.groupBy(*key).agg(F.min(F.struct(*fields)).alias("e")).select(*key, "e.*")


_EV = "ev as (select o_custkey::varchar as entity_id, l_orderkey || '-' || l_linenumber as evidence_id, min('part/' || l_partkey) as source_url, count(*) as n from lineitem join orders on l_orderkey = o_orderkey group by 1, 2)"


@query(f"with {_EV} select o_orderkey::varchar as claim_id, case when o_orderkey % 5 = 1 then coalesce(b.evidence_id, a.evidence_id) when o_orderkey % 5 > 2 then a.evidence_id end as used from orders left join ev b on b.evidence_id = o_orderkey || '-2' left join ev a on a.evidence_id = o_orderkey || '-1'")
def j2_attach_provenance(spark: SparkSession, d: str) -> DataFrame:
    claims, ev = _order_claims(spark, d)
    # the id itself rides in claim_span, so that the oracle can name the evidence that was used
    return joins.attach_provenance(claims, ev.withColumn("claim_span", F.col("evidence_id"))).select("claim_id", F.col("claim_span").alias("used"))


@query(
    f"""with {_EV}, r as (select o_orderkey::varchar as claim_id, unnest(case o_orderkey % 5 when 0 then ['gone'] when 1 then ['gone', o_orderkey || '-2', o_orderkey || '-1'] when 2 then [] else [o_orderkey || '-1'] end) as evidence_id from orders)
    select claim_id, evidence_id, 'missing evidence' as problem from r where evidence_id not in (select evidence_id from ev) union all select o_orderkey::varchar, null, 'no evidence' from orders where o_orderkey % 5 = 2"""
)
def j3_orphan_refs(spark: SparkSession, d: str) -> DataFrame:
    return joins.orphan_refs(*_order_claims(spark, d)).select("claim_id", "evidence_id", "problem")


_FEED = "f as (select p_partkey as uuid, p_partkey as seen, trim(regexp_replace(regexp_replace(lower(p_brand || ' ' || p_name || ' ' || p_type), '[^a-z0-9 ]+', ' ', 'g'), '\\s+', ' ', 'g')) as said from part)"


@query(
    f"""with {_FEED}, e as (select distinct p_name as entity_id, trim(regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9 ]+', ' ', 'g'), '\\s+', ' ', 'g')) as t from part),
    h as (select entity_id, uuid, seen from e, f where said = t or (length(t) >= 6 and contains(said, t)) or (length(t) >= 6 and length(said) >= 6 and contains(t, said)) or (len(string_split(t, ' ')) >= 2 and list_has_all(string_split(said, ' '), string_split(t, ' '))))
    select entity_id, uuid, rank from (select *, row_number() over (partition by entity_id order by seen desc, uuid desc) as rank from h) where rank <= 8"""
)
def j4_name_candidates(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    entities = p.select(F.col("p_name").alias("entity_id"), F.col("p_name").alias("name")).distinct()
    feed = p.select(F.col("p_partkey").alias("uuid"), F.concat_ws(" ", "p_brand", "p_name", "p_type").alias("name"), F.col("p_partkey").alias("seen"))
    return joins.name_candidates(entities, feed).select("entity_id", "uuid", F.col("rank").cast("long").alias("rank"))


@query("select distinct e.p_name || f as entity_id, a.p_partkey as uuid from part e, (select unnest([' SE', ' BRL']) as f) join part a on a.p_partkey % 3 > 0 and e.p_name = a.p_name and (f = ' SE' or a.p_partkey % 5 = 0)")
def j5_exact_name_match(spark: SparkSession, d: str) -> DataFrame:
    """Names in capitals with Ø for o; SE is a form that ads leave out, BRL is none, so it has to be written."""
    p = table(spark, d, "part")
    name = F.upper(F.replace("p_name", F.lit("o"), F.lit("ø")))
    entities = p.select(F.explode(F.array(*(F.struct(F.concat("p_name", F.lit(f)).alias("entity_id"), F.concat(name, F.lit(f)).alias("name")) for f in (" SE", " BRL")))).alias("e")).select("e.*").distinct()
    ads = p.select(F.col("p_partkey").alias("uuid"), F.expr("if(p_partkey % 3 = 0, 'INACTIVE', 'ACTIVE')").alias("status"), F.concat("p_name", F.expr("if(p_partkey % 5 = 0, ', BRL', ' & co')")).alias("business_name"), F.col("p_name").alias("employer_name"))
    return joins.exact_name_match(entities, ads)


def _confirmed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    s, li = table(spark, d, "supplier"), table(spark, d, "lineitem")
    keys = s.selectExpr("s_nationkey as entity_id", "cast(s_suppkey as string) as number", "true as via_subunit").union(s.selectExpr("s_nationkey", "concat('n', s_nationkey)", "false").distinct())
    cands = li.selectExpr("cast(l_orderkey % 25 as int) as entity_id", "concat(l_orderkey, '-', l_linenumber) as uuid", "if(l_orderkey % 7 = 0, concat('n', l_orderkey % 25), cast(l_suppkey as string)) as number").distinct()
    return joins.confirm_by_id(cands, keys)


_CAND = "c as (select distinct l_orderkey % 25 as entity_id, l_orderkey || '-' || l_linenumber as uuid, case when l_orderkey % 7 = 0 then 'n' || (l_orderkey % 25) else l_suppkey::varchar end as number from lineitem), k as (select s_nationkey as entity_id, s_suppkey::varchar as number, true as via_subunit from supplier union all select distinct s_nationkey, 'n' || s_nationkey, false from supplier)"


@query(f"with {_CAND} select c.entity_id, uuid, number, via_subunit from c join k using (entity_id, number)")
def j6_confirm_by_id(spark: SparkSession, d: str) -> DataFrame:
    return _confirmed(spark, d)[0]


@query(f"with {_CAND} select entity_id, uuid, 'number ' || number as reason from c where (entity_id, number) not in (select (entity_id, number) from k)")
def j6_rejected(spark: SparkSession, d: str) -> DataFrame:
    return _confirmed(spark, d)[1]


_HOST = "regexp_replace(regexp_extract(url, '^[a-z]+://([^/:?#]*)', 1), '^www\\.', '')"


#: Names for pages in turn, and the domains that they suggest.
_NAMES = ("Nordlys Hansen Bygg AS", "Holding Invest AS", "Åse Rør AS", "Fjell AS", "")
_GUESSED = (("nordlyshansenbygg.no", "nordlys-hansen-bygg.no", "nordlys.no", "nordlyshansenbygg.com"), (), ("aseror.no", "ase-ror.no", "aseror.com", "ase-ror.com"), ("fjell.no", "fjell.com"), ())


@query(
    f"""with n as (select *, [{", ".join(f"[{', '.join(repr(g) for g in x)}]::varchar[]" for x in _GUESSED)}][page_id % 5 + 1] as guessed from pages),
    c as (select page_id as entity_id, unnest([{{'prio': 0, 'seq': 0, 'origin': 'registry', 'host': {_HOST}}}, {{'prio': 1, 'seq': 1, 'origin': 'email', 'host': 'mail' || page_id % 7 || '.example.com'}}] || list_transform(guessed, lambda g, i: {{'prio': 2, 'seq': i::int + 1, 'origin': 'guess', 'host': g}})) as c from n),
    h as (select entity_id, c.prio as prio, c.seq as seq, c.origin as origin, c.host as host, array_to_string(list_slice(string_split(c.host, '.'), -2, -1), '.') as domain from c)
    select entity_id, domain, origin, 'https://' || host as url from (select *, row_number() over (partition by entity_id, domain order by prio, seq) as k from h) where k = 1"""
)
def j7_website_candidates(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "pages").select(F.col("page_id").alias("entity_id"), F.element_at(F.array(*map(F.lit, _NAMES)), (F.col("page_id") % 5 + 1).cast("int")).alias("name"), F.col("url").alias("website"), F.expr("concat('x@mail', page_id % 7, '.example.com')").alias("email"))
    return joins.website_candidates(e).select("entity_id", "domain", "origin", "url")


@query(f"select page_id, {_HOST} as host from pages where not ({_HOST} = 'example.net' or {_HOST} like '%.example.net' or contains({_HOST}, 'blog'))")
def j8_host_blocklist(spark: SparkSession, d: str) -> DataFrame:
    block = table(spark, d, "region").selectExpr("if(r_regionkey = 0, 'blog', if(r_regionkey = 1, 'example.net', concat('none', r_regionkey, '.invalid'))) as entry")
    return joins.host_blocklist(table(spark, d, "pages").select("page_id", "url"), block).select("page_id", X.host(F.col("url")).alias("host"))


@query(
    f"""with r as (select n_nationkey as entity_id, 'example' as w, page_id % 2 as query, page_id as pos, url, {_HOST} as host from nation, pages where page_id % 25 = n_nationkey),
    f as (select *, min(query) over (partition by entity_id) as q from r where contains(regexp_replace(host, '[^a-z0-9]', '', 'g'), w) and array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') <> 'example.org')
    select entity_id, query, rank, url from (select *, row_number() over (partition by entity_id order by pos, url) as rank from f where query = q) where rank <= 3"""
)
def j9_distinctive_hosts(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").selectExpr("n_nationkey as entity_id", "'Example Norge AS' as name", "'oslo' as municipality")
    r = table(spark, d, "pages").selectExpr("cast(page_id % 25 as int) as entity_id", "page_id % 2 as query", "page_id as pos", "url")
    known = n.select("entity_id", F.lit("example.org").alias("domain"))
    return joins.distinctive_host_filter(n, r, known).withColumn("rank", F.col("rank").cast("long"))


@query(
    f"""with g as (select page_id, {_HOST} as expected from pages where page_id % 3 > 0), p as (select page_id, {_HOST} as predicted from pages where page_id % 2 = 0 union all select page_id, 'other.example' from pages where page_id % 10 = 1)
    select g.page_id as entity_id, predicted, expected, coalesce(predicted = 'other.example', false) as wrong from g left join p using (page_id)"""
)
def j10_gold_join(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages")
    gold = p.where("page_id % 3 > 0").select(F.col("page_id").alias("entity_id"), F.explode(F.array(F.struct(F.lit(1).alias("line"), F.lit("http://old.example").alias("expected")), F.struct(F.lit(2).alias("line"), F.coalesce("url", F.lit("")).alias("expected")))).alias("x")).select("entity_id", "x.line", "x.expected", F.array(F.lit("other.example")).alias("wrong_domains"))
    pred = p.where("page_id % 2 = 0").selectExpr("page_id as entity_id", "url").union(p.where("page_id % 10 = 1").selectExpr("page_id", "'https://www.other.example/x'"))
    return joins.gold_join(pred, gold)


_SQUASHED = "b as (select item_id, regexp_replace(text, '\\s+', '', 'g') as b from benchmark), t as (select doc_id, regexp_replace(text, '\\s+', '', 'g') as t from documents)"


def _verbatim(spark: SparkSession, d: str) -> DataFrame:
    """(item_id, content_sha256) of each benchmark item and each document that it stands in."""
    docs = table(spark, d, "documents").selectExpr("sha2(concat(doc_id, text), 256) as sha256", "text as body", "text")
    items = table(spark, d, "benchmark").selectExpr("item_id", "text as claim_span")
    ev = joins.span_candidates(items, docs, "item_id").withColumn("extraction_method", F.lit("m"))
    return joins.span_verify_join(ev, docs).where("verdict = 'verbatim'").select("item_id", "content_sha256")


@query(f"with {_SQUASHED} select item_id, doc_id from b join t on contains(t, b)")
def j12_span_verify(spark: SparkSession, d: str) -> DataFrame:
    """Each benchmark item against every document, found by shared windows, not by pairs."""
    ids = table(spark, d, "documents").selectExpr("sha2(concat(doc_id, text), 256) as content_sha256", "doc_id")
    return _verbatim(spark, d).join(ids, "content_sha256").select("item_id", "doc_id")


@query(f"with {_SQUASHED} select item_id, count(doc_id) as documents from b left join t on contains(t, b) group by 1")
def j12_span_verify_all(spark: SparkSession, d: str) -> DataFrame:
    """How many documents each benchmark item stands in."""
    found = _verbatim(spark, d).groupBy("item_id").agg(F.count("*").alias("documents"))
    return table(spark, d, "benchmark").select("item_id").join(found, "item_id", "left").select("item_id", F.coalesce("documents", F.lit(0)).alias("documents"))


_FACTS = "facts as (select o_custkey as entity_id, o_orderstatus as field, 'available' as availability, count(*)::varchar as value, half from (select *, 1 as half from orders where year(o_orderdate) <= 1999 union all select *, 2 from orders) group by 1, 2, half)"


def _runs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, d, "orders")
    make = lambda x: x.groupBy(F.col("o_custkey").alias("entity_id"), F.col("o_orderstatus").alias("field")).agg(F.count("*").cast("string").alias("value")).withColumn("availability", F.lit("available"))
    return make(o.where("year(o_orderdate) <= 1999")), make(o.where("o_custkey % 11 <> 3"))


_COMPARED = f"""with {_FACTS}, a as (select * exclude half from facts where half = 1), b as (select * exclude half from facts where half = 2 and entity_id % 11 <> 3),
  ids as (select entity_id from a intersect select entity_id from b), x as (select *, 'left' as side from (select * from a except select * from b) where entity_id in (from ids) union all select *, 'right' from (select * from b except select * from a) where entity_id in (from ids)
  union all select distinct entity_id, null, 'missing', null, 'left' from a where entity_id not in (from ids) union all select distinct entity_id, null, 'missing', null, 'right' from b where entity_id not in (from ids))"""


@query(f"{_COMPARED} select * from x")
def j13_two_run_compare(spark: SparkSession, d: str) -> DataFrame:
    return joins.two_run_compare(*_runs(spark, d))


@query(f"{_COMPARED} select coalesce(field, 'missing in one run') as field, count(*) as facts, count(distinct entity_id) as entities from x group by 1")
def q6_determinism_report(spark: SparkSession, d: str) -> DataFrame:
    return quality.determinism_report(*_runs(spark, d))


@query(
    """with q as (select conv_id || '-' || turn as question_id, conv_id % 150 as entity_id, lower(text) as t from conversations where role = 'user'),
    r as (select *, case when contains(t, 'tion') then 1 when contains(t, 'the') then 2 when contains(t, 'ung') then 3 end as route_id from q),
    m as (select user_id as entity_id, event_type as field, event_id from events),
    j as (select r.question_id, r.entity_id, r.route_id, m.event_id, m.field, row_number() over (partition by question_id order by m.field, m.event_id::varchar) as k from r left join m on m.entity_id = r.entity_id and m.field = case r.route_id when 1 then 'click' when 2 then 'view' when 3 then 'error' end)
    select question_id, entity_id, route_id, case when event_id is null then 'not established' else 'answered' end as state, event_id::varchar as claim_id from j where k <= 12"""
)
def j14_question_router(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "conversations").where("role = 'user'").selectExpr("concat(conv_id, '-', turn) as question_id", "conv_id % 150 as entity_id", "text")
    routes = spark.range(1, 4).selectExpr("id as route_id", "element_at(array('tion', 'the', 'ung'), cast(id as int)) as pattern", "'s' as section", "array(element_at(array('click', 'view', 'error'), cast(id as int))) as fields")
    claims = table(spark, d, "events").selectExpr("user_id as entity_id", "'s' as section", "event_type as field", "cast(event_id as string) as claim_id", "'' as value", "'available' as availability")
    return joins.question_router(q, routes, claims).drop("value")


#: A customer's snapshot at a date: fields, values and places, for Spark and for DuckDB.
_SNAP = """select c_custkey as entity_id, 'o' as k, count(o_orderkey) as n, max_by(o_orderpriority, o_orderkey) as last_priority, max(year(o_orderdate)) as last_year, round(sum(o_totalprice)) as turnover
  from customer join orders on c_custkey = o_custkey where year(o_orderdate) <= {year} group by c_custkey"""


def _snapshot(spark: SparkSession, d: str, year: int, customers: DataFrame | None = None) -> DataFrame:
    """Claims of those who ordered until a year; of given customers (entity_id) only, if there are any given."""
    o = table(spark, d, "orders").where(f"year(o_orderdate) <= {year}")
    of = lambda x: x if customers is None else x.join(customers, "entity_id", "left_semi")
    # prices are added as decimals: sums of doubles that end in .5 would round by the order in which tasks add them
    s = o.groupBy(F.col("o_custkey").alias("entity_id")).agg(
        F.max_by("o_orderpriority", F.when(F.col("o_orderpriority").isNotNull(), F.col("o_orderkey"))).alias("p"), F.max(F.year("o_orderdate")).cast("string").alias("y"), F.round(F.sum(F.col("o_totalprice").cast("decimal(28,10)"))).cast("long").cast("string").alias("t"))
    claim = lambda i, f, v, sec: F.struct(F.lit(i).alias("ord"), F.lit(f).alias("field"), F.lit(sec).alias("section"), v.alias("value"))
    one = of(s).select("entity_id", F.explode(F.array(claim(1, "legal_form", F.col("p"), "identity"), claim(2, "latest_submitted_accounts_year", F.col("y"), "accounts"), claim(3, "revenue", F.col("t"), "accounts"))).alias("c"), "y")
    one = one.where("c.value is not null").select("entity_id", "c.*", F.when(F.col("c.field") == "revenue", F.lit("p")).alias("reporting_period"))
    job = o.selectExpr("o_custkey as entity_id", "10 as ord", "'job_posting' as field", "'hiring' as section", "to_json(named_struct('name', concat('job ', o_orderpriority), 'source', 'feed')) as value", "cast(null as string) as reporting_period").distinct()
    out = one.union(of(job)).withColumn("source", F.when(F.col("field") == "job_posting", F.lit("feed")))
    return out.withColumns({"availability": F.lit("available"), "note": F.lit(None).cast("string"), "observed": F.lit(str(year))})


def _customer_snapshot(spark: SparkSession, d: str, year: int) -> DataFrame:
    return _snapshot(spark, d, year, table(spark, d, "customer").select(F.col("c_custkey").alias("entity_id")))


def _changes(spark: SparkSession, d: str) -> DataFrame:
    return diff.diff_claims(_customer_snapshot(spark, d, 1998), _customer_snapshot(spark, d, 2001))


_DIFF = f"""with a as ({_SNAP.format(year=1998)}), b as ({_SNAP.format(year=2001)}), x as (select a.entity_id, a.last_priority as pa, b.last_priority as pb, a.last_year as ya, b.last_year as yb, a.turnover as ta, b.turnover as tb from a join b using (entity_id)),
  ja as (select distinct o_custkey as entity_id, o_orderpriority as p from orders where year(o_orderdate) <= 1998), jb as (select distinct o_custkey as entity_id, o_orderpriority as p from orders where year(o_orderdate) <= 2001 and o_custkey in (select entity_id from a)),
  ch as (select entity_id, 'legal_form' as field, 'changed_legal_form' as change_type, 'material' as materiality from x where lower(pa) <> lower(pb)
  union all select entity_id, 'latest_submitted_accounts_year', 'new_filing', 'material' from x where yb > ya
  union all select entity_id, 'revenue', 'changed_financials', 'material' from x where ta <> tb
  union all select entity_id, 'job_posting', 'new_job', 'material' from (select * from jb except select * from ja))"""


@query(f"{_DIFF} select field, change_type, materiality, count(*) as n from ch group by 1, 2, 3")
def d0_diff_claims(spark: SparkSession, d: str) -> DataFrame:
    """What changed for each customer between two snapshots, by type."""
    return diff.changes_by_type(_changes(spark, d))


@query(f"{_DIFF} select entity_id, field, change_type, materiality, count(*) as n from ch group by 1, 2, 3, 4")
def j11_saved_runs(spark: SparkSession, d: str) -> DataFrame:
    """The same snapshots as saved tables, compared bucket by bucket."""
    names = {}
    for year in (1998, 2001):
        path = shared_path(spark, f"run_{year}")
        names[year] = path.rsplit("/", 1)[-1].replace("-", "_")
        diff.save_run(_customer_snapshot(spark, d, year), names[year], path, buckets=8)
    changes = diff.diff_runs(spark.table(names[1998]), spark.table(names[2001]))
    return changes.groupBy("entity_id", "field", "change_type", "materiality").agg(F.count("*").alias("n"))


@query(f"{_DIFF} select entity_id, field, change_type, count(*) as n from ch group by 1, 2, 3")
def d8_changes_by_entity(spark: SparkSession, d: str) -> DataFrame:
    return _changes(spark, d).groupBy("entity_id", "field", "change_type").agg(F.count("*").alias("n"))


@query(
    f"""{_DIFF}, n as (select entity_id, change_type, count(*) as n from ch group by 1, 2),
    s as (select entity_id, string_agg(n || ' ' || case change_type when 'new_filing' then case when n = 1 then 'new accounts filing' else 'new accounts filings' end when 'new_job' then case when n = 1 then 'new job ad' else 'new job ads' end
      else replace(change_type, '_', ' ') || case when n = 1 then '' else ' changes' end end, ', ' order by n || ' ' || case change_type when 'new_filing' then 'new accounts filing' when 'new_job' then 'new job ad' else replace(change_type, '_', ' ') end) as t from n group by 1)
    select c_custkey as entity_id, case when c_custkey not in (select entity_id from a) then 'First run, no earlier snapshot.' when t is null then 'No changes since the last run.' else 'Since the last run: ' || t || '.' end as text from customer left join s on entity_id = c_custkey"""
)
def t3_what_changed(spark: SparkSession, d: str) -> DataFrame:
    known = _customer_snapshot(spark, d, 1998).select("entity_id", F.lit(False).alias("_b")).distinct()
    entities = table(spark, d, "customer").select(F.col("c_custkey").alias("entity_id")).join(known, "entity_id", "left").select("entity_id", F.coalesce("_b", F.lit(True)).alias("baseline"))
    return synth.what_changed(_changes(spark, d), entities)


def _records(spark: SparkSession, d: str) -> DataFrame:
    """Customers as registry records."""
    return dealt(table(spark, d, "customer"), "c_custkey").selectExpr(
        "lpad(cast(c_custkey as string), 9, '0') as organisasjonsnummer", "c_name as navn", "named_struct('kode', if(c_custkey % 5 = 0, 'ENK', 'AS'), 'beskrivelse', cast(null as string)) as organisasjonsform",
        f"cast(if(c_custkey % 7 = 0, null, named_struct('adresse', array('Gate 1'), 'postnummer', '0150', 'poststed', 'OSLO', 'kommune', concat('K', c_nationkey), 'kommunenummer', '0301', 'land', 'Norge', 'landkode', 'NO')) as {normalise.ADDRESS}) as forretningsadresse",
        f"cast(if(c_custkey % 8 = 0, named_struct('adresse', array('Postboks', cast(c_custkey as string)), 'postnummer', '0101', 'poststed', 'OSLO', 'kommune', 'P', 'kommunenummer', '0301', 'land', 'Norge', 'landkode', cast(null as string)), null) as {normalise.ADDRESS}) as postadresse", "named_struct('kode', cast(c_nationkey as string), 'beskrivelse', c_mktsegment) as naeringskode1", "c_custkey % 2 = 0 as harRegistrertAntallAnsatte", "cast(c_custkey % 50 as int) as antallAnsatte",
        "'2001-02-03' as registreringsdatoEnhetsregisteret", "if(c_custkey % 9 = 0, '1999-01-02', null) as stiftelsesdato", "if(c_custkey % 3 = 0, null, c_custkey % 3 = 1) as registrertIMvaregisteret", "if(c_custkey % 4 = 0, null, c_acctbal < 0) as konkurs",
        "cast(null as boolean) as underAvvikling", "cast(null as boolean) as underTvangsavviklingEllerTvangsopplosning", "if(c_custkey % 10 = 0, '2023', '') as sisteInnsendteAarsregnskap", "if(c_custkey % 11 = 0, array('Salg av', 'varer'), array()) as vedtektsfestetFormaal",
        "if(c_custkey % 6 = 0, '', concat('www.c', c_custkey, '.no')) as hjemmeside", "if(c_custkey % 12 = 0, concat('post@c', c_custkey, '.no'), null) as epostadresse", "if(c_custkey % 13 = 0, '22 33 44 55', '') as telefon", "if(c_custkey % 14 = 0, '99 88 77 66', null) as mobil",
        "if(c_custkey % 15 = 0, array(named_struct('navn', 'Old A'), named_struct('navn', concat('Old ', c_custkey))), cast(array() as array<struct<navn:string>>)) as historiskeNavn")


#: Every field of a customer's record: its value in SQL, and when there is a claim at all.
_FIELDS = {
    "legal_name": ("c_name", "true"), "legal_form": ("'{\"code\":\"' || case when c_custkey % 5 = 0 then 'ENK' else 'AS' end || '\"}'", "true"),
    "business_address": ("case when c_custkey % 7 > 0 then '{\"street\":\"Gate 1\",\"postcode\":\"0150\",\"city\":\"OSLO\",\"municipality\":\"K' || c_nationkey || '\",\"country\":\"NO\"}' end", "true"),
    "registered_address": ("'{\"street\":\"Postboks ' || c_custkey || '\",\"postcode\":\"0101\",\"city\":\"OSLO\",\"municipality\":\"P\",\"country\":\"Norge\"}'", "c_custkey % 8 = 0"),
    "municipality": ("case when c_custkey % 7 > 0 then 'K' || c_nationkey when c_custkey % 8 = 0 then 'P' end", "true"), "industry_code": ("c_nationkey::varchar", "true"), "industry_label": ("c_mktsegment", "true"),
    "registry_employees": ("case when c_custkey % 2 = 0 then (c_custkey % 50)::varchar end", "true"), "registration_date": ("'2001-02-03'", "true"), "founded": ("'1999-01-02'", "c_custkey % 9 = 0"),
    "vat_registered": ("case when c_custkey % 3 = 1 then 'true' when c_custkey % 3 = 2 then 'false' end", "true"),
    "status_flags": ("case when c_custkey % 4 > 0 then '{\"bankrupt\":' || (c_acctbal < 0)::varchar || ',\"liquidating\":false,\"forced_liquidation\":false}' end", "true"),
    "latest_submitted_accounts_year": ("'2023'", "c_custkey % 10 = 0"), "stated_purpose": ("'Salg av varer'", "c_custkey % 11 = 0"), "registry_website": ("case when c_custkey % 6 > 0 then 'www.c' || c_custkey || '.no' end", "true"),
    "registry_email": ("'post@c' || c_custkey || '.no'", "c_custkey % 12 = 0"), "registry_phone": ("'22 33 44 55'", "c_custkey % 13 = 0"), "registry_mobile": ("'99 88 77 66'", "c_custkey % 14 = 0"), "former_names": ("'[\"Old A\",\"Old ' || c_custkey || '\"]'", "c_custkey % 15 = 0"),
}


@query(
    "with f as (" + " union all ".join(f"select lpad(c_custkey::varchar, 9, '0') as entity_id, '{f}' as field, {v} as value from customer where {keep}" for f, (v, keep) in _FIELDS.items()) + ")"
    " select entity_id, field, value, case when value is null then 'not_available' else 'available' end as availability, case when field = 'registry_website' then 0.9 else 1.0 end::double as confidence, case when field in ('registration_date', 'founded') then value end as effective_date from f"
)
def n1_identity_claims(spark: SparkSession, d: str) -> DataFrame:
    return normalise.identity_claims(_records(spark, d)).select("entity_id", "field", "value", "availability", "confidence", "effective_date")


_SEED = {"legal_name": ("c_name", 0.9), "legal_form": ("'{\"code\":\"AS\"}'", 0.9), "municipality": ("'OSLO'", 0.9), "industry_code": ("'1'", 0.9), "industry_label": ("'x'", 0.9), "registry_employees": ("'3'", 0.9), "status_flags": ("'{\"bankrupt\":false,\"liquidating\":false}'", 0.9), "registry_website": ("'w'", 0.8)}


@query(
    "with f as (" + " union all ".join(f"select c_custkey, '{f}' as field, {v} as value, 'available' as availability, {c}::double as confidence from customer where c_custkey % 4 > 0 and c_custkey % 3 = 0" for f, (v, c) in _SEED.items())
    + " union all select c_custkey, 'legal_name', null, 'failed', 1.0 from customer where c_custkey % 4 > 0 and c_custkey % 3 > 0) select lpad(c_custkey::varchar, 9, '0') as entity_id, field, value, availability, confidence, 'live record unavailable (http_500); values of the reference snapshot' as note from f"
)
def n2_identity_fallback(spark: SparkSession, d: str) -> DataFrame:
    rec = _records(spark, d)
    n = F.substring("organisasjonsnummer", 1, 9)
    number = F.regexp_extract("navn", r"(\d+)$", 1).cast("long")
    ids = rec.select(n.alias("entity_id"), F.lit("http_500").alias("error"))
    seed = rec.where(number % 3 == 0).select(n.alias("entity_id"), F.col("navn").alias("name"), F.lit("AS").alias("legal_form"), F.lit("OSLO").alias("municipality"), F.lit("1").alias("industry_code"), F.lit("x").alias("industry_label"), F.lit(3).alias("employees"), F.lit("w").alias("website"), F.lit(False).alias("bankrupt"), F.lit(False).alias("liquidating"))
    return normalise.identity_fallback(ids, rec.where(number % 4 == 0), seed).select("entity_id", "field", "value", "availability", "confidence", "note")


def _filings(spark: SparkSession, d: str) -> DataFrame:
    """A filing a customer and year of orders."""
    o = table(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.round(F.sum("o_totalprice")).alias("rev"), F.count("*").alias("n"))
    null = "cast(null as double)"
    return o.selectExpr(
        "cast(o_custkey as string) as entity_id", "named_struct('fraDato', concat(y, '-01-01'), 'tilDato', concat(y, '-12-31')) as regnskapsperiode", "if(n % 2 = 0, 'EUR', null) as valuta", "'SELSKAP' as regnskapstype", "'store' as oppstillingsplan",
        f"named_struct('aarsresultat', if(n = 1, {null}, rev - 100000), 'ordinaertResultatFoerSkattekostnad', {null}, 'driftsresultat', named_struct('driftsresultat', {null}, 'driftsinntekter', named_struct('sumDriftsinntekter', rev))) as resultatregnskapResultat",
        f"named_struct('egenkapital', named_struct('sumEgenkapital', {null}), 'gjeldOversikt', named_struct('sumGjeld', {null})) as egenkapitalGjeld", f"named_struct('sumEiendeler', {null}) as eiendeler", "named_struct('smaaForetak', true) as regnkapsprinsipper",
        "named_struct('morselskap', false) as virksomhet", "named_struct('ikkeRevidertAarsregnskap', n = 1) as revisjon")


_YEARS = "y as (select o_custkey::varchar as entity_id, year(o_orderdate) as y, round(sum(o_totalprice)) as rev, count(*) as n from orders group by 1, 2), r as (select *, row_number() over (partition by entity_id order by y desc) as k from y)"


@query(f"with {_YEARS} select entity_id, y || '-01-01..' || y || '-12-31' as reporting_period, rev as revenue, case when n > 1 then rev - 100000 end as annual_result, case when n % 2 = 0 then 'EUR' else 'NOK' end as currency, 5::bigint as absent from r where k = 1 and n > 1 union all select entity_id, y || '-01-01..' || y || '-12-31', rev, null, 'NOK', 6 from r where k = 1 and n = 1")
def n3_accounts_claims(spark: SparkSession, d: str) -> DataFrame:
    c = normalise.accounts_claims(_filings(spark, d))
    v = lambda f: F.max(F.when(F.col("field") == f, F.col("value")))
    return c.groupBy("entity_id").agg(F.max("reporting_period").alias("reporting_period"), v("revenue").cast("double").alias("revenue"), v("annual_result").cast("double").alias("annual_result"), v("currency").alias("currency"), F.count(F.when(F.col("availability") == "not_available", 1)).alias("absent"))


@query(f"with {_YEARS} select entity_id, count(*) filter (k between 2 and 4) as prior, '[' || string_agg('\"' || y || '-01-01..' || y || '-12-31\"', ',' order by k) || ']' as history from r group by 1")
def n4_prior_periods(spark: SparkSession, d: str) -> DataFrame:
    c = normalise.prior_periods(_filings(spark, d))
    return c.groupBy("entity_id").agg(F.count(F.when(F.col("field") == "accounts_prior_period", 1)).alias("prior"), F.max(F.when(F.col("field") == "accounts_history", F.col("value"))).alias("history"))


@query("select c_custkey as entity_id, case when c_custkey % 3 = 0 and c_custkey % 5 = 0 then 'not_applicable' when c_custkey % 3 = 0 or c_custkey % 3 = 1 then 'not_available' else 'failed' end as availability from customer where c_custkey % 7 > 0")
def n5_accounts_absence(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "customer").selectExpr("c_custkey as entity_id", "if(c_custkey % 5 = 0, 'ENK', 'AS') as legal_form", "case c_custkey % 3 when 0 then 404 when 1 then 200 else 500 end as status", "c_custkey % 3 = 1 or c_custkey % 7 = 0 as ok", "if(c_custkey % 7 = 0, 2, 0) as n_filings", "'failed' as state")
    return normalise.accounts_absence(f).select("entity_id", "availability")


@query("select o_custkey::varchar as entity_id, min(year(o_orderdate))::varchar as first_filing_year, count(distinct year(o_orderdate))::varchar as filings_on_file from orders group by 1")
def n6_filing_years(spark: SparkSession, d: str) -> DataFrame:
    y = table(spark, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("entity_id")).agg(F.concat(F.collect_list(F.year("o_orderdate").cast("string")), F.array(F.lit("bad"))).alias("years"))
    c = normalise.filing_years(y.withColumns({"status": F.lit(200), "state": F.lit("available")}))
    return c.groupBy("entity_id").agg(*(F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in ("first_filing_year", "filings_on_file")))


@query("select n_nationkey::varchar as entity_id, count(s_suppkey) filter (s_suppkey % 4 > 0)::varchar as role_count, min(s_name) filter (s_suppkey % 4 > 0) as first_name from nation left join supplier on s_nationkey = n_nationkey group by 1 having count(s_suppkey) filter (s_suppkey % 4 > 0) > 0")
def n7_role_claims(spark: SparkSession, d: str) -> DataFrame:
    role = "named_struct('type', named_struct('kode', 'DAGL', 'beskrivelse', 'lead'), 'fratraadt', s_suppkey % 4 = 0, 'person', named_struct('navn', named_struct('fornavn', s_name, 'mellomnavn', cast(null as string), 'etternavn', cast(null as string)), 'erDod', false), 'enhet', cast(null as struct<organisasjonsnummer:string,navn:array<string>>))"
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").cast("string").alias("entity_id")).agg(F.expr(f"collect_list({role})").alias("r")).selectExpr("entity_id", "array(named_struct('sistEndret', '2020-01-01', 'roller', r)) as rollegrupper")
    c = normalise.role_claims(s)
    names = F.min(F.when(F.col("field") == "role", F.get_json_object("value", "$.name")))
    out = c.groupBy("entity_id").agg(F.max(F.when(F.col("field") == "role_count", F.col("value"))).alias("role_count"), names.alias("first_name"))
    return out.where("role_count is not null")


@query("select n_nationkey::varchar as entity_id, count(s_suppkey) filter (s_suppkey % 5 > 0)::varchar as workplaces, case when count(s_suppkey) filter (s_suppkey % 5 > 0) = 0 then 1 else 0 end as zero from nation left join supplier on s_nationkey = n_nationkey group by 1")
def n8_workplace_claims(spark: SparkSession, d: str) -> DataFrame:
    unit = f"named_struct('organisasjonsnummer', cast(s_suppkey as string), 'navn', s_name, 'beliggenhetsadresse', cast(null as {normalise.ADDRESS}), 'postadresse', cast(null as {normalise.ADDRESS}), 'antallAnsatte', 1, 'harRegistrertAntallAnsatte', true, 'naeringskode1', named_struct('beskrivelse', 'x'), 'oppstartsdato', '2020-01-01', 'slettedato', if(s_suppkey % 5 = 0, '2021-01-01', null))"
    s = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.expr(f"collect_list({unit})").alias("units"), F.count("*").cast("int").alias("total"))
    rec = table(spark, d, "nation").join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left").selectExpr("cast(n_nationkey as string) as entity_id", "units", "coalesce(total, 0) as total")
    c = normalise.workplace_claims(rec).where("field = 'workplace_count'")
    return c.select("entity_id", F.col("value").alias("workplaces"), F.coalesce(F.col("note").startswith("checked"), F.lit(False)).cast("int").alias("zero"))


@query("select user_id as entity_id, count(*) as claims, min(strftime(ts, '%Y-%m-%d')) as oldest from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as k from events) where k <= 20 group by 1")
def n9_update_events(spark: SparkSession, d: str) -> DataFrame:
    c = normalise.update_events(table(spark, d, "events").selectExpr("user_id as entity_id", "event_id", "ts as at", "event_type as change_type"))
    return c.groupBy("entity_id").agg(F.count("*").alias("claims"), F.min("effective_date").alias("oldest"))


@query("select o_orderkey as entity_id, strftime(o_orderdate, '%Y-%m-%d') as effective_date, case when o_orderkey % 2 = 0 then 'l' || o_orderkey else 'https://jobs.example.org/ad/' || o_orderkey end as url from orders")
def n10_job_ad_claims(spark: SparkSession, d: str) -> DataFrame:
    ads = table(spark, d, "orders").selectExpr("o_orderkey as entity_id", "cast(o_orderkey as string) as uuid", "o_orderpriority as title", "if(o_orderkey % 2 = 0, concat('l', o_orderkey), null) as link", "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm\") as published", "cast(null as string) as expires", "'x' as city", "'y' as municipal", "'z' as employer", "'1' as extent", "1 as positions")
    return normalise.job_ad_claims(ads).select("entity_id", "effective_date", F.get_json_object("value", "$.url").alias("url"))


@query("select section, count(*) as claims from (select 'activity' as section from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as k from events) where k <= 20 union all select 'hiring' from orders) group by 1")
def n11_merge_connectors(spark: SparkSession, d: str) -> DataFrame:
    a = normalise.update_events(table(spark, d, "events").selectExpr("cast(user_id as string) as entity_id", "event_id", "ts as at", "event_type as change_type"))
    b = normalise.job_ad_claims(table(spark, d, "orders").selectExpr("cast(o_custkey as string) as entity_id", "cast(o_orderkey as string) as uuid", "o_orderpriority as title", "cast(null as string) as link", "'' as published", "'' as expires", "'x' as city", "'y' as municipal", "'z' as employer", "'1' as extent", "1 as positions"))
    return normalise.merge_connectors(a, b.drop("note")).groupBy("section").agg(F.count("*").alias("claims"))


@query("select 'duplicate id' as problem, 'c' || o_custkey as detail from orders group by 2 having count(*) > 1 union all select 'count', count(*)::varchar from orders union all select 'missing', 'c' || c_custkey from customer where c_custkey not in (select o_custkey from orders) union all select 'order', 'c' || o_custkey from orders where o_orderkey <> o_custkey")
def q1_validate_batch(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "customer").selectExpr("c_custkey as pos", "concat('c', c_custkey) as id")
    return quality.validate_batch(ids, table(spark, d, "orders").selectExpr("o_orderkey as pos", "concat('c', o_custkey) as entity_id"), 1)


@query("select problem, count(*) as n from (select unnest([case when length(c_custkey::varchar) < 3 then 'entity id' end, case when c_custkey % 11 = 0 then 'state' end, case when c_acctbal < 0 then 'confidence' end]) as problem from customer) where problem is not null group by 1")
def q2_validate_records(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").selectExpr("if(c_custkey < 100, 'x', lpad(cast(c_custkey as string), 9, '0')) as entity_id", "cast(c_custkey as string) as claim_id", "if(c_custkey % 11 = 0, 'maybe', 'available') as availability", "if(c_acctbal < 0, -1.0D, 1.0D) as confidence", "'f' as field", "'v' as value")
    return quality.validate_records(c).groupBy("problem").agg(F.count("*").alias("n"))


@query("select source as extraction_method, count(*) as checked, count(*) filter (not contains(regexp_replace(text, '\\s+', '', 'g'), regexp_replace(substr(text, 1 + doc_id % greatest(length(text) - 30, 1), 30) || case when doc_id % 3 = 0 then '~~' else '' end, '\\s+', '', 'g'))) as bad from documents group by 1")
def q3_span_audit(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").withColumn("sha256", F.sha2(F.concat("doc_id", "text"), 256))
    ev = docs.selectExpr("doc_id", "sha256 as content_sha256", "concat(substr(text, 1 + cast(doc_id % greatest(char_length(text) - 30, 1) as int), 30), if(doc_id % 3 = 0, '~~', '')) as claim_span", "source as extraction_method")
    return quality.span_audit(joins.span_verify_join(ev, docs.select("sha256", F.col("text").alias("body"), "text")))


_BARE = "(o_orderkey % 5 in (0, 2) or (o_orderkey % 5 = 1 and o_orderkey || '-1' not in (select evidence_id from ev) and o_orderkey || '-2' not in (select evidence_id from ev)) or (o_orderkey % 5 > 2 and o_orderkey || '-1' not in (select evidence_id from ev)))"


@query(
    f"""with {_EV} select o_custkey::varchar as entity_id, o_orderkey::varchar as claim_id, 'no url or time' as problem from orders where {_BARE}
    union all select o_custkey::varchar, o_orderkey::varchar, 'differs from evidence' from orders where o_orderkey % 7 = 0
    union all select distinct o_custkey::varchar, null, 'answers missing' from orders where o_custkey % 4 < 2"""
)
def q5_provenance_audit(spark: SparkSession, d: str) -> DataFrame:
    """All three problems: claims without a source, copies that were changed, entities with nine answers or none."""
    claims, ev = _order_claims(spark, d)
    copied = joins.attach_provenance(claims, ev).withColumn("source_class", F.when(F.col("claim_id").cast("long") % 7 == 0, F.lit("changed")).otherwise(F.col("source_class")))
    answers = table(spark, d, "customer").where("c_custkey % 4 > 0").selectExpr("cast(c_custkey as string) as entity_id", "explode(sequence(1, if(c_custkey % 4 = 1, 9, 12))) as ord")
    return quality.provenance_audit(copied, ev, answers)


def _customer_claims(spark: SparkSession, d: str) -> DataFrame:
    c = normalise.identity_claims(_records(spark, d))
    return normalise.numbered(c).withColumn("evidence_ids", F.array(F.concat(F.lit("e-"), "field")))


@query(
    """select lpad(c_custkey::varchar, 9, '0') as entity_id, c_name || ' is a company' || case when c_custkey % 7 > 0 then ' in K' || c_nationkey when c_custkey % 8 = 0 then ' in P' else '' end || ' registered under ' || c_nationkey || ' ' || c_mktsegment || '.' as what,
    case when c_custkey % 2 = 1 then null when c_custkey % 50 = 0 then 'No employees.' when c_custkey % 50 = 1 then '1 employee.' else (c_custkey % 50) || ' employees.' end as size,
    case when c_custkey % 4 = 0 then null when c_acctbal < 0 then 'Marked as bankrupt.' else 'No flag is set.' end as risks from customer"""
)
def t1_profile_text(spark: SparkSession, d: str) -> DataFrame:
    return synth.profile_text(_customer_claims(spark, d), 2026).select("entity_id", "what", "size", "risks")


_NOTES = {"registry_employees": "no registered employee count", "registry_website": "the registry lists no website"}


@query(
    " union all ".join(
        f"select lpad(c_custkey::varchar, 9, '0') as entity_id, 1 as ord, 'No {f.replace('_', ' ')} is on record ({_NOTES.get(f, normalise.ABSENT)}).' as text from customer where ({keep}) and {value} is null" for f, (value, keep) in _FIELDS.items()
    )
)
def t4_cannot_establish(spark: SparkSession, d: str) -> DataFrame:
    return synth.cannot_establish(_customer_claims(spark, d))


#: When a customer's registry record answers a question, as SQL.
_ANSWERED = {
    "What does the company do?": "true", "Who leads it?": "false", "How big is it?": "c_custkey % 2 = 0", "What did its latest accounts show?": "false", "Is it growing?": "false", "How long has it filed accounts?": "false", "Where is it?": "c_custkey % 7 > 0 or c_custkey % 8 = 0",
    "Is it hiring?": "false", "What is its website?": "false", "What has happened recently?": "false", "What changed since the last run?": "c_custkey % 2 = 1", "Are there warning signs?": "c_custkey % 4 > 0",
}


@query(" union all ".join(f"select '{q}' as question, lpad(c_custkey::varchar, 9, '0') as entity_id, {ok} as answerable, {'c_custkey % 2 = 0' if q.startswith('What changed') else 'false'} as first_run from customer" for q, ok in _ANSWERED.items()))
def t5_answers(spark: SparkSession, d: str) -> DataFrame:
    """All twelve questions for every customer; customers with even numbers are in their first run."""
    c = _customer_claims(spark, d)
    text = synth.profile_text(c, 2026).withColumn("baseline", F.col("entity_id").cast("long") % 2 == 0).withColumn("what_changed", F.lit("No changes since the last run."))
    return synth.answers(c, text).select("question", "entity_id", "answerable", (F.col("answer") == synth.FIRST_RUN).alias("first_run"))


_SAID = "y as (select o_custkey::varchar as entity_id, year(o_orderdate) as y, round(sum(o_totalprice)) as rev from orders group by 1, 2), r as (select *, lag(rev) over w as old, lag(y) over w as oy, lead(y) over w as later, row_number() over w as k from y window w as (partition by entity_id order by y))"


@query(
    f"""with {_SAID}, p as (select *, (rev - old) / abs(old) * 100 as pct from r where later is null and k > 1)
    select entity_id, case when pct >= 0.5 then 'rose' when pct <= -0.5 then 'fell' else 'flat' end as direction, oy::varchar as before, y::varchar as now, case when abs(pct) >= 0.5 then round(abs(pct))::int end as percent from p"""
)
def t1_trend(spark: SparkSession, d: str) -> DataFrame:
    """The sentence about the newest year's revenue against the year before, taken apart again."""
    f = _filings(spark, d)
    claims = normalise.accounts_claims(f).where("field in ('revenue', 'reporting_period')").unionByName(normalise.prior_periods(f))
    t = synth.profile_text(normalise.numbered(claims), 2026).where("trend is not null")
    said = lambda pattern: F.nullif(F.regexp_extract("trend", pattern, 1), F.lit(""))
    return t.select("entity_id", said("Revenue (?:was )?(rose|fell|flat)").alias("direction"), F.coalesce(said(r"from NOK [^(]*\((\d{4})\)"), said(r"between (\d{4})")).alias("before"), F.coalesce(said(r"to NOK [^(]*\((\d{4})\)"), said(r"and (\d{4})")).alias("now"), said(r"(\d+)%").cast("int").alias("percent"))


@query("select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k from events")
def x22_json_path(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))
