"""Pages and profiles that are written out of the driver tables' columns, and SQL that computes from the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import pages as P
from ..operators import quality, synth
from ..shared import dealt, stored
from .registry import query, table

#: Eight digits of a customer, and the host that its mail is at.
_DIGITS = "lpad(cast(c_custkey * 7654321 % 100000000 as {}), 8, '0')"
_HOST = "case c_nationkey % 5 when 0 then 'firma' || c_custkey || '.no' when 1 then 'gmail.com' when 2 then 'post.online.no' when 3 then 'annet.no' else 'mail.firma' || c_custkey || '.no' end"


@query(
    f"""with c as (select 'firma' || c_custkey || '.no' as site, {_DIGITS.format('varchar')} as d, {_HOST} as host, lower(c_mktsegment) || c_custkey as box, c_custkey from customer),
    m as (select site, 'contact_email' as field, box || '@' || host as value, 1.0 as confidence from c where host not like 'gmail.%' and host not like '%online.no'),
    o as (select site, 'contact_email', 'info@' || site, 0.8 from c),
    p as (select site, 'contact_phone', value, max(confidence) from (select site, '+47' || d as value, 0.8 as confidence from c where d[1] between '2' and '9' and c_custkey % 5 <> 3 union all select site, '+47' || reverse(d), 1.0 from c where d[-1] between '2' and '9') group by 1, 3),
    a as (select * from m union all select * from o union all select * from p)
    select site, field, value, confidence::double as confidence, (row_number() over (partition by site, field order by not suffix(value, '@' || site), value))::int as rank from a"""
)
def p4_customer_contacts(spark: SparkSession, d: str) -> DataFrame:
    """A page a customer: a mail link at a host of its own, another or a consumer one, an address in the text, a number in five spellings."""
    c = table(spark, d, "customer").selectExpr("c_custkey", f"{_DIGITS.format('string')} as d", f"{_HOST} as host", "concat(lower(c_mktsegment), c_custkey) as box")
    spelt = "case c_custkey % 5 when 0 then concat('Tlf. ', d) when 1 then concat('telefon: ', substr(d, 1, 2), '.', substr(d, 3, 2), '.', substr(d, 5, 2), '.', substr(d, 7)) when 2 then concat('Mobil ', substr(d, 1, 3), ' ', substr(d, 4, 2), ' ', substr(d, 6)) when 3 then concat('kode ', d) else concat('+47 ', d) end"
    html = f"concat('<a href=\"mailto:', upper(box), '@', host, '?subject=x\">post</a> <a href=\"tel:0047', reverse(d), '\">nr</a><p>skriv til Info@firma', c_custkey, '.no eller info@annet.no<p>', {spelt}, '<li>')"
    pages = c.selectExpr("c_custkey as page_id", "concat('https://www.firma', c_custkey, '.no/') as url", f"{html} as html")
    return P.contacts(stored(P.parse_pages(pages), "contact-pages"))


_ISO = "strftime(o_orderdate, '%Y-%m-%d')"


@query(
    f"""with o as (select 'firma' || o_custkey || '.no' as site, o_orderkey as k, o_orderkey % 7 as turn, {_ISO} as iso, o_orderdate as dt from orders),
    n as (select site, case turn when 4 then substr(iso, 1, 7) else iso end as date, case turn when 0 then 'Sak ' || k || ' fra ' || iso when 1 then 'Sak ' || k || ' fra ' || day(dt) || '.' || month(dt) || '.' || year(dt) when 2 then 'da Sak nummer ' || k else 'Sak nummer ' || k end as title,
      'https://' || site || case turn when 3 then '/' || replace(iso, '-', '/') || '/' || k when 4 then '/' || replace(substr(iso, 1, 7), '-', '/') || '/' || k else '/n/' || k end as link from o where turn < 5)
    select site, (row_number() over (partition by site order by date desc, link))::int as rank, date, title, link from n qualify row_number() over (partition by site order by date desc, link) <= 10"""
)
def p10_dated_links(spark: SparkSession, d: str) -> DataFrame:
    """A news page a customer with a link an order: the date in the anchor, a time element or the path; too short, or to another site."""
    o = table(spark, d, "orders").selectExpr("o_custkey", "o_orderkey as k", "date_format(o_orderdate, 'yyyy-MM-dd') as iso", "concat(day(o_orderdate), '.', month(o_orderdate), '.', year(o_orderdate)) as dotted")
    link = """case k % 7 when 0 then concat('<a href="/n/', k, '">Sak ', k, ' fra ', iso, '</a>') when 1 then concat('<a href="/n/', k, '">Sak ', k, ' fra ', dotted, '</a>')
    when 2 then concat('<a href="/n/', k, '?a=1"><time datetime="', iso, 'T08:00">da</time> Sak nummer ', k, '</a>') when 3 then concat('<a href="/', replace(iso, '-', '/'), '/', k, '">Sak nummer ', k, '</a>')
    when 4 then concat('<a href="/', replace(left(iso, 7), '-', '/'), '/', k, '#x">Sak nummer ', k, '</a>') when 5 then concat('<a href="/', replace(iso, '-', '/'), '/', k, '">Sak</a>') else concat('<a href="https://annet.no/', k, '">Sak ', k, ' fra ', iso, '</a>') end"""
    pages = o.groupBy("o_custkey").agg(F.array_join(F.collect_list(F.expr(link)), "<li>").alias("html"))
    pages = pages.selectExpr("o_custkey as page_id", "concat('https://firma', o_custkey, '.no/nyheter/') as url", "html")
    other = pages.selectExpr("page_id + 1000000000 as page_id", "concat('https://firma', page_id - 0, '.no/kontakt/') as url", "replace(html, '/n/', '/m/') as html")
    return P.news_items(stored(P.parse_pages(pages.union(other)), "news-pages"))


@query(
    """with s as (select s_suppkey, s_name, n_name, r_name from supplier join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey)
    select s_suppkey as page_id, 'WebPage' as type, null as name, n_name as city, 'k' || s_suppkey as keyword from s
    union all select s_suppkey, 'Organization', s_name, n_name, null from s union all select s_suppkey, 'PostalAddress', null, n_name, null from s where s_suppkey % 2 = 0"""
)
def p6_nested_items(spark: SparkSession, d: str) -> DataFrame:
    """A page a supplier: an organisation inside a page's item, its address inside the organisation, typed or not, a property by reference."""
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    html = """concat('<div itemscope itemtype="https://schema.org/WebPage" itemref="more', s_suppkey, '"><div itemprop="about" itemscope itemtype="http://schema.org/Organization"><b itemprop="name">', s_name, '</b><ul><li itemprop="address" itemscope',
    if(s_suppkey % 2 = 0, ' itemtype="https://schema.org/PostalAddress"', ''), '><span itemprop="addressLocality">', n_name, '</ul></div></div><p id="more', s_suppkey, '"><meta itemprop="keywords" content="k', s_suppkey, '">')"""
    nodes = P.typed(P.parse_pages(s.selectExpr("s_suppkey as page_id", "'https://a.no/' as url", f"{html} as html")))
    j = lambda *paths: F.coalesce(*(F.get_json_object("json", f"$.{p}") for p in paths))
    return nodes.select("page_id", "type", j("name").alias("name"), j("about.address.addressLocality", "address.addressLocality", "addressLocality").alias("city"), j("keywords").alias("keyword"))


@query(
    """with o as (select *, row_number() over (partition by o_custkey order by o_orderkey) as k, count(*) over (partition by o_custkey) as n from orders),
    w as (select o_custkey, max(n) as n, list('Unit ' || o_orderkey || case when o_orderkey % 2 = 0 then ' (City' || o_orderkey % 9 || ')' else '' end order by o_orderkey) as l from o where k <= 4 group by 1),
    j as (select o_custkey, list('Job ' || o_orderkey || ' (Oslo)' order by o_orderkey) as l from (select *, row_number() over (partition by o_custkey order by o_orderkey) as i from o where o_orderstatus = 'O') where i <= 3 group by 1),
    e as (select o_custkey, strftime(o_orderdate, '%Y-%m-%d') as day, case o_orderstatus when 'O' then 'job ad posted' when 'F' then 'news item “News ' || o_orderkey || '”' else 'registry update (Type ' || o_orderkey % 3 || ')' end as said, o_orderstatus = 'P' as upd from orders),
    a as (select o_custkey, max(day || '|' || said) as newest, count(*) filter (upd) as n, max(day) filter (upd) as last from e group by 1),
    s as (select l, o_custkey, n from w), say as (select c_custkey, c_name, c_nationkey, w.l as wl, w.n as wn, j.l as jl, a.newest, a.n as un, a.last from customer left join w on w.o_custkey = c_custkey left join j on j.o_custkey = c_custkey left join a on a.o_custkey = c_custkey),
    f as (select *, case when len(wl) = 1 then wl[1] else array_to_string(wl[:-2], ', ') || ' and ' || wl[-1] end as ws, case when len(jl) = 1 then jl[1] else array_to_string(jl[:-2], ', ') || ' and ' || jl[-1] end as js from say)
    select c_custkey as entity_id, c_name || ' is a company' || case when c_custkey % 3 = 0 then ' registered under 62.' || c_nationkey else '' end || '.' as what,
    nullif(concat_ws(' ', case c_custkey % 4 when 0 then 'Business address: Gate ' || c_custkey || ', 0' || (100 + c_nationkey) || ' CITY' || c_nationkey || '.' when 1 then 'Business address: Gate ' || c_custkey || ', Bygg.' when 2 then 'Registered address: Torget ' || c_custkey || '.' end,
      'The registry lists ' || wn || ' sub-unit' || case when wn = 1 then '' else 's' end || ': ' || ws || case when wn > 4 then ' and others.' else '.' end), '') as place,
    nullif(concat_ws(' ', 'Open roles include ' || js || '.', case when c_custkey % 5 = 0 then 'Careers page: https://a.no/' || c_custkey || '.' end), '') as hiring,
    'Latest dated activity: ' || split_part(newest, '|', 2) || ' on ' || split_part(newest, '|', 1) || '.' || case when un > 0 then ' The registry recorded ' || un || ' update event' || case when un = 1 then '' else 's' end || ', the most recent on ' || last || '.' else '' end as activity from f"""
)
def t1_footprint_and_activity(spark: SparkSession, d: str) -> DataFrame:
    """Customers with addresses of three forms; orders are workplaces, and job ads, news or registry updates by their status."""
    c = table(spark, d, "customer")
    claim = lambda id_, field, value: f"named_struct('claim_id', {id_}, 'field', '{field}', 'value', {value})"
    own = [
        claim("'c-1'", "legal_name", "c_name"),
        claim("'c-2'", "industry_code", "if(c_custkey % 3 = 0, concat('62.', c_nationkey), cast(null as string))"),
        claim("'c-3'", "business_address", "case c_custkey % 4 when 0 then to_json(named_struct('street', concat('Gate ', c_custkey), 'postcode', concat('0', 100 + c_nationkey), 'city', concat('CITY', c_nationkey), 'municipality', 'M')) when 1 then to_json(array(concat('Gate ', c_custkey), ' ', 'Bygg')) end"),
        claim("'c-4'", "registered_address", "if(c_custkey % 4 = 2, concat('Torget ', c_custkey), null)"),
        claim("'c-5'", "careers_page_url", "if(c_custkey % 5 = 0, concat('https://a.no/', c_custkey), null)"),
    ]
    ours = c.selectExpr("c_custkey as entity_id", f"inline(array({', '.join(own)}))")
    day = "date_format(o_orderdate, 'yyyy-MM-dd')"
    theirs = [
        claim("concat('w-', o_orderkey)", "workplace", "to_json(named_struct('name', concat('Unit ', o_orderkey), 'address', if(o_orderkey % 2 = 0, named_struct('city', concat('CITY', o_orderkey % 9)), null)))"),
        claim("concat('j-', o_orderkey)", "job_posting", f"if(o_orderstatus = 'O', to_json(named_struct('title', concat('Job ', o_orderkey), 'location', 'OSLO', 'date_posted', {day})), null)"),
        claim("concat('n-', o_orderkey)", "news_item", f"if(o_orderstatus = 'F', to_json(named_struct('title', concat('News ', o_orderkey), 'date', {day})), null)"),
        claim("concat('u-', o_orderkey)", "registry_update", f"if(o_orderstatus = 'P', to_json(named_struct('change_type', concat('Type ', o_orderkey % 3), 'date', {day})), null)"),
    ]
    orders = table(spark, d, "orders").selectExpr("o_custkey as entity_id", f"inline(array({', '.join(theirs)}))")
    claims = ours.union(orders).selectExpr("*", "if(value is null, 'not_available', 'available') as availability", "cast(null as string) as effective_date", "'x' as section", "array(claim_id) as evidence_ids")
    return synth.profile_text(claims, 2026).select("entity_id", "what", "place", "hiring", "activity")


_SELECTED = (
    """case c_custkey % 6 when 0 then '{"kommune":"' || c_mktsegment || '","kommunenummer":"' || n || '"}' when 1 then '{"a":{"b":{"kode": "DAGL"}}}' when 2 then '{"navn":["FIRMA ' || c_custkey || ' AS"],"gone":{"x":null}}'
    when 3 then '[{"x.kommune":"' || c_mktsegment || '"},{"alder":' || c_custkey || '}]' when 4 then '{"navn":["ANNET"],"gone":null}' else '{"alder":' || c_custkey || ',"kommune":"' || c_mktsegment || '"}' end"""
)
_RECORD = """'{"navn": ["FIRMA ' || c_custkey || ' AS"], "adresse": {"kommune": "' || c_mktsegment || '", "kommunenummer": "' || n || '"}, "roller": [{"type": {"kode": "DAGL"}, "alder": ' || c_custkey || '}]}'"""


@query(
    """with c as (select c_custkey, '"kommune": "' || c_mktsegment || '"' as k, '"kommunenummer": "' || lpad(c_nationkey::varchar, 4, '0') || '"' as n, '"alder": ' || c_custkey as a from customer)
    select c_custkey, case c_custkey % 6 when 0 then k || ', ' || n when 1 then '"kode": "DAGL"' when 2 then '"navn": ["FIRMA ' || c_custkey || ' AS"]' when 3 then k || ', ' || n || '}, "roller": [{"type": {"kode": "DAGL"}, ' || a when 5 then a end as span from c"""
)
def x13_json_selections(spark: SparkSession, d: str) -> DataFrame:
    """Selections of nested fields, of lists and by dotted names, in each customer's record."""
    c = dealt(table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), "c_custkey").selectExpr("*", "lpad(cast(c_nationkey as string), 4, '0') as n")
    return c.select("c_custkey", X.literal_span(F.expr(_SELECTED), F.expr(_RECORD)).alias("span"))


_ID = "lpad({}::varchar, 9, '0')"


@query(
    f"""with c as (select case when o_orderkey % 23 = 0 then 'x' || o_custkey else {_ID.format('o_custkey')} end as entity_id, 'c-' || o_orderkey as claim_id, case when o_orderkey % 5 = 0 then null else o_orderstatus end as field, case o_orderkey % 4 when 0 then 'identity' when 1 then 'web' when 2 then 'sales' else 'hiring' end as section,
      case o_orderkey % 6 when 0 then 'maybe' when 1 then null when 2 then 'failed' else 'available' end as availability, case when o_totalprice > 200000 then 1.5 else 0.5 end as confidence from orders),
    e as (select {_ID.format('l_suppkey')} as entity_id, l_orderkey || '-' || l_linenumber as id, case l_linenumber % 3 when 0 then 'company_owned' when 1 then 'press' end as sc, l_quantity > 25 as spanned from lineitem),
    s as (select {_ID.format('c_custkey')} as entity_id, case when c_custkey % 7 = 0 then 'open' else 'available' end as state from customer),
    v as (select {_ID.format('user_id')} as entity_id, event_type as stage, event_id % 2 = 0 as told from events)
    select entity_id, 'claims' as record, claim_id as row, p.problem as problem from c, (select unnest(['bad entity_id', 'missing field', 'bad section', 'missing availability', 'bad availability', 'bad confidence', 'no evidence']) as problem) p
      where case p.problem when 'bad entity_id' then entity_id[1] = 'x' when 'missing field' then field is null when 'bad section' then section = 'sales' when 'missing availability' then availability is null when 'bad availability' then availability = 'maybe' when 'bad confidence' then confidence > 1 else availability = 'available' and substr(claim_id, 3)::bigint % 3 = 0 end
    union all select entity_id, 'evidence', id, p.problem from e, (select unnest(['missing source_class', 'bad source_class', 'missing claim_span', 'missing retrieved_at']) as problem) p where case p.problem when 'missing source_class' then sc is null when 'bad source_class' then sc = 'press' when 'missing claim_span' then not spanned else true end
    union all select entity_id, 'sections', 'web', 'bad state' from s where state = 'open' union all select entity_id, 'errors', stage, 'missing message' from v where not told
    union all select entity_id, 'operations', null, 'missing budget_exhausted' from s union all select entity_id, 'changes', 'f', 'missing last_observed' from s where entity_id like '%3' union all select entity_id, 'runs', 'r', 'missing agent_version' from s where entity_id like '%4'"""
)
def q2_validate_tables(spark: SparkSession, d: str) -> DataFrame:
    """All seven tables of a batch out of orders, lines, customers and events, with faults by their numbers."""
    id_ = lambda c: f"lpad(cast({c} as string), 9, '0') as entity_id"
    customers = table(spark, d, "customer")
    claims = table(spark, d, "orders").selectExpr(
        "if(o_orderkey % 23 = 0, concat('x', o_custkey), lpad(cast(o_custkey as string), 9, '0')) as entity_id", "concat('c-', o_orderkey) as claim_id", "if(o_orderkey % 5 = 0, null, o_orderstatus) as field", "element_at(array('identity', 'web', 'sales', 'hiring'), cast(o_orderkey % 4 + 1 as int)) as section",
        "case o_orderkey % 6 when 0 then 'maybe' when 1 then null when 2 then 'failed' else 'available' end as availability", "if(o_totalprice > 200000, 1.5D, 0.5D) as confidence", "if(o_orderkey % 3 = 0, if(o_orderkey % 2 = 0, null, cast(array() as array<string>)), array('e')) as evidence_ids",
    )
    evidence = table(spark, d, "lineitem").selectExpr(id_("l_suppkey"), "concat(l_orderkey, '-', l_linenumber) as evidence_id", "'u' as source_url", "case l_linenumber % 3 when 0 then 'company_owned' when 1 then 'press' end as source_class", "if(l_quantity > 25, 's', null) as claim_span", "'m' as extraction_method")
    tables = {
        "sections": customers.selectExpr(id_("c_custkey"), "'web' as section", "if(c_custkey % 7 = 0, 'open', 'available') as state"),
        "errors": table(spark, d, "events").selectExpr(id_("user_id"), "event_type as stage", "if(event_id % 2 = 0, 'm', null) as message", "'failed' as availability"),
        "operations": customers.selectExpr(id_("c_custkey"), "1 as requests", "2 as runtime_ms", "0.0D as third_party_cost_usd", "3 as bytes"),
        "changes": customers.selectExpr(id_("c_custkey"), "'f' as field", "'t' as change_type", "'minor' as materiality", "'2024' as first_observed", "if(c_custkey % 10 = 3, null, '2024') as last_observed"),
        "runs": customers.selectExpr(id_("c_custkey"), "'r' as run_id", "'a' as started_at", "'b' as completed_at", "'completed' as terminal_status", "if(c_custkey % 10 = 4, null, '1') as agent_version"),
    }
    return quality.validate_tables({"claims": claims} | tables).union(quality.validate_tables({"evidence": evidence}))
