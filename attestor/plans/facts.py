"""Page facts, resolution and text expressions on pages and strings that are made of the driver tables' rows."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import diff, joins, quality, resolve, synth
from ..operators import pages as P
from ..shared import dealt, shared_path, stored
from ..sources import io
from .registry import query, table

#: A page's facts in front of its own HTML; {n} is its number, {m} two digits of it.
_NODES = {
    "@graph": [
        {"@type": "Organization", "name": "Firma {n} AS", "telephone": "+47 99 88 77 {m}", "email": "Mail{n}@firma{n}.no", "address": {"streetAddress": "Gate {n}", "postalCode": "0150", "addressLocality": "Oslo"}, "sameAs": ["https://www.instagram.com/Firma{n}/"]},
        {"@type": "JobPosting", "title": "Baker {n}", "url": "https://firma{n}.no/j/{n}", "datePosted": "2024-01-02T00:00", "validThrough": "2024-02-03T00:00"},
        {"@type": ["NewsArticle"], "headline": "Nytt {n}", "url": "https://firma{n}.no/n/{n}", "datePublished": "2024-03-04T10:00"},
        {"@type": "Person", "name": "Kari Nes", "jobTitle": "Daglig leder"},
    ]
}
_BLOCK = (
    '<meta property="og:site_name" content="Firma {n}"><meta name="description" content="Om {n}"><script type="application/ld+json">' + json.dumps(_NODES) + "</script>"
    '<a href="mailto:Post@firma{n}.no?subject=x">post</a><a href="mailto:a.b@gmail.com">annen</a><a href="tel:+47 22 33 44 55">ring</a><a href="/om-oss?x=1#a">Om oss</a>'
    '<a href="/x/fil.pdf">fil</a><a href="https://www.facebook.com/Firma{n}/">fb</a><a href="https://facebook.com/sharer.php?u=1">del</a>'
    "<div>Ola Berg</div><div>Styreleder</div><div>Tlf: 22 33 44 {m}</div><footer>Org.nr 9{k}</footer>"
)
#: The same as a page without a posting but with a cue.
_CAREERS = "<title>Jobb</title><div>Vi har ledige stillinger, firma {n}</div>"


def _filled(template: str) -> Column:
    n = F.col("page_id").cast("string")
    out = F.lit(template)
    for name, value in (("{n}", n), ("{m}", F.lpad((F.col("page_id") % 50).cast("string"), 2, "0")), ("{k}", F.lpad(n, 8, "0"))):
        out = F.replace(out, F.lit(name), value)
    return out


def _fact_pages(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Every page, on a site of its own and with facts ahead of it, and a careers page for each; parsed once, into the named columns."""
    rows = table(spark, d, "pages").select("page_id", "html")
    site = F.concat(F.lit("https://www.firma"), F.col("page_id").cast("string"), F.lit(".no/"))
    front = rows.select("page_id", site.alias("url"), F.concat(_filled(_BLOCK), F.lit("<p>"), "html").alias("html"))
    careers = rows.select((F.col("page_id") + 1_000_000_000).alias("page_id"), F.concat(site, F.lit("karriere/")).alias("url"), _filled(_CAREERS).alias("html"))
    return stored(P.parse_pages(front.union(careers), *columns), "fact-pages")


_SITE = "'firma' || page_id || '.no' as site"


@query(
    f"""with f as (select {_SITE}, 'contact_email' as field, 'post@firma' || page_id || '.no' as value, 1.0 as confidence, 1 as rank from pages),
    t as (select site, value, max(confidence) as confidence from (select {_SITE}, '+4722334455' as value, 1.0 as confidence from pages union all select {_SITE}, '+47223344' || lpad((page_id % 50)::varchar, 2, '0'), 0.8 from pages) group by 1, 2)
    select site, field, value, confidence::double as confidence, rank::int as rank from f union all select site, 'contact_phone', value, confidence::double, (row_number() over (partition by site order by value))::int from t"""
)
def p4_site_contacts(spark: SparkSession, d: str) -> DataFrame:
    return P.contacts(_fact_pages(spark, d))


@query(
    f"""select {_SITE}, 'facebook' as platform, 'https://facebook.com/Firma' || page_id as url, 'https://www.facebook.com/Firma' || page_id || '/' as url_as_published from pages
    union all select {_SITE}, 'instagram', 'https://instagram.com/Firma' || page_id, 'https://www.instagram.com/Firma' || page_id || '/' from pages"""
)
def p5_socials(spark: SparkSession, d: str) -> DataFrame:
    return P.socials(_fact_pages(spark, d))


@query("select t as type, count(*) as nodes from pages, (select unnest(['Organization', 'JobPosting', 'NewsArticle', 'Person']) as t) group by 1")
def p6_page_nodes(spark: SparkSession, d: str) -> DataFrame:
    return P.typed(_fact_pages(spark, d, "nodes")).groupBy("type").agg(F.count("*").alias("nodes"))


@query(
    """select page_id, f.field as field, f.value as value from (select page_id, unnest([{'field': 'name', 'value': 'Firma ' || page_id || ' AS'}, {'field': 'contact_phone', 'value': '+47 99 88 77 ' || lpad((page_id % 50)::varchar, 2, '0')},
    {'field': 'contact_email', 'value': 'mail' || page_id || '@firma' || page_id || '.no'}, {'field': 'site_location', 'value': 'Gate ' || page_id || ', 0150, Oslo'}]) as f from pages)"""
)
def p7_org_facts(spark: SparkSession, d: str) -> DataFrame:
    return P.org_facts(_fact_pages(spark, d, "nodes"))


@query("select page_id, f.n as name, f.t as title, f.r::int as rank from (select page_id, unnest([{'n': 'Kari Nes', 't': 'Daglig leder', 'r': 1}, {'n': 'Ola Berg', 't': 'Styreleder', 'r': 2}]) as f from pages)")
def p8_leaders(spark: SparkSession, d: str) -> DataFrame:
    return P.leaders(_fact_pages(spark, d))


@query("select page_id, 'https://firma' || page_id || '.no/j/' || page_id as job_url, 'Baker ' || page_id as title, '2024-01-02' as date_posted, '2024-02-03' as valid_through from pages")
def p9_job_postings(spark: SparkSession, d: str) -> DataFrame:
    return P.job_postings(_fact_pages(spark, d)).select("page_id", "job_url", "title", "date_posted", "valid_through")


@query(f"select {_SITE}, 1::int as rank, '2024-03-04' as date, 'Nytt ' || page_id as title, 'https://firma' || page_id || '.no/n/' || page_id as link from pages")
def p10_site_news(spark: SparkSession, d: str) -> DataFrame:
    return P.news_items(_fact_pages(spark, d))


@query("select page_id + 1000000000 as page_id, 'https://www.firma' || page_id || '.no/karriere/' as url, 'ledige stillinger' as cue from pages")
def p11_careers_pages(spark: SparkSession, d: str) -> DataFrame:
    return P.careers_pages(_fact_pages(spark, d, "text", "nodes"))


@query(
    """with s as (select 'firma' || page_id || '.no' as entity_id from pages), r as (select unnest([{'s': 'web', 'f': 'contact_email', 'a': 'available'}, {'s': 'web', 'f': 'contact_phone', 'a': 'available'}, {'s': 'web', 'f': 'social_profile', 'a': 'available'},
      {'s': 'leadership', 'f': 'site_leader', 'a': 'not_available'}, {'s': 'activity', 'f': 'news_item', 'a': 'not_available'}, {'s': 'hiring', 'f': 'job_posting', 'a': 'not_available'}]) as x)
    select entity_id, x.s as section, x.f as field, x.a as availability from s, r"""
)
def p12_site_absence(spark: SparkSession, d: str) -> DataFrame:
    """Contacts and profiles are looked for, the other required fields stay open."""
    parsed = _fact_pages(spark, d, "links", "text", "nodes")
    site = X.registered_domain(X.host(F.col("url")))
    found = P.contacts(parsed).select(F.col("site").alias("entity_id"), F.lit("web").alias("section"), "field")
    found = found.union(P.socials(parsed).select("site", F.lit("web"), F.lit("social_profile")))
    return P.fill_absence(found, parsed.select(site.alias("entity_id")).distinct())


@query("select page_id, f.l as label, f.t as text from (select page_id, unnest([{'l': 'og:site_name', 't': 'Firma ' || page_id}, {'l': 'json-ld', 't': 'Firma ' || page_id || ' AS'}]) as f from pages)")
def p13_positions(spark: SparkSession, d: str) -> DataFrame:
    """Names that a page gives itself in its head and its nodes."""
    rows = _fact_pages(spark, d).select("page_id", F.explode("positions").alias("p")).select("page_id", "p.label", "p.text")
    return rows.where("label in ('og:site_name', 'json-ld')")


@query("select page_id, 'Firma ' || page_id as site_name, 'Om ' || page_id as description, 'firma' || page_id || '.no' as host from pages")
def p2_page_metas(spark: SparkSession, d: str) -> DataFrame:
    return _fact_pages(spark, d).where("page_id < 1000000000").select("page_id", "site_name", "description", "host")


@query("select page_id, 'https://www.firma' || page_id || '.no/om-oss' as url, 'Om oss' as anchor, 'about' as kind, 1::int as depth from pages")
def p3_kinds_of_links(spark: SparkSession, d: str) -> DataFrame:
    """Links to the site's own pages that tell their kind; files and other sites are none."""
    return P.site_links(_fact_pages(spark, d)).where("kind is not null and anchor in ('Om oss', 'fil', 'fb', 'del')").select("page_id", "url", "anchor", "kind", "depth")


@query("select 'number' as kind, '9' || lpad(page_id::varchar, 8, '0') as value, page_id from pages")
def r13_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Labelled numbers of every page."""
    return resolve.mention_scan(_fact_pages(spark, d)).where("kind = 'number'").select("kind", "value", "page_id")


#: Pages about a company {c} (Nordlys and its segment) with number {o}, by turns: HTML, score, reasons, brand, whether the page names itself so.
#: {s} is a street number, {w} the segment's word; every step of the ladder has its turn.
_LADDER = (
    ("<title>{c}</title>This domain is for sale", 0.1, "parked", "{c}", True),
    ("<title>{c}</title>Org.nr {o}", 1.0, "org_number_on_page,org_number:self_identified", "{c}", True),
    ("<p>{o}</p>", 1.0, "org_number_on_page,org_number:bare_digits", None, False),
    ("<p>Foretaksnummer: {o}</p>", 1.0, "org_number_on_page,org_number:labelled", None, False),
    ("<p>1{o}</p>", 0.3, "name_not_found", None, False),
    ("Org.nr {o} Org.nr 811111111 Org.nr 822222222", 0.8, "org_number_among_many,other_org_numbers:2", None, False),
    ("<title>{c}</title>Org.nr 811 111 111", 0.8, "name_match_but_other_org_number,page_states:811111111", "{c}", True),
    ("<title>Home | Einar {c} AS</title>{c} AS, Storgata {s}", 0.8, "title_names_another_entity,page_is:Einar {c} AS", "Einar {c} AS", True),
    ("<title>Eldre {c} AS</title>Storgata {s}", 0.95, "legal_name_and_registered_address,street_with_number:storgata {s}", "Eldre {c} AS", True),
    ("<title>Stålfjell Regnskap AS</title><p>Kunder: Nordlys og {w}</p>", 0.8, "page_belongs_to_another_company,page_is:Stålfjell Regnskap AS", None, False),
    ("<p>Alfa AS, Beta Rør AS, Gamma AS, {c} AS</p>", 0.8, "page_lists_many_companies,companies_named:4", None, False),
    ("<title>Nordlys</title>", 0.3, "name_partial,tokens:1/2", "Nordlys", False),
    ("<title>{c}</title>Storgata {s}, 8006 Bodø", 0.95, "legal_name_and_registered_address,place:bodo,postcode_with_city:8006 bodo,street_with_number:storgata {s}", "{c}", True),
    ("<title>Nordlys-{w}</title>pris 8006", 0.8, "name_only,postcode_bare:8006", "Nordlys-{w}", True),
    ("<p>{w} i byen. Nordlys over fjellet. Storgata {s}</p>", 0.8, "name_mentioned_only,street_with_number:storgata {s}", None, False),
    ("<p>Vi er Nordlys {w} AS, Storgata {s}.</p>", 0.95, "legal_name_and_registered_address,street_with_number:storgata {s}", None, False),
    ("<p>Nordlys. {w}.</p>", 0.95, "registry_linked_domain,registry_email_domain:firma{n}.no", None, False),
)


def _sql_text(text: str | None) -> str:
    if text is None:
        return "null"
    out = "'" + text.replace("'", "''") + "'"
    for name, value in (("{c}", "c"), ("{o}", "o"), ("{s}", "s"), ("{w}", "w"), ("{n}", "c_custkey")):
        out = out.replace(name, f"' || {value} || '")
    return out


_COMPANIES = "k as (select c_custkey, c_custkey % 17 as turn, 'Nordlys ' || upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) as c, upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) as w, (1 + c_custkey % 90)::varchar as s, '9' || lpad(c_custkey::varchar, 8, '0') as o from customer)"
_RULED = " ".join(f"when {i} then {{'score': {score}, 'reasons': {_sql_text(reasons)}, 'brand': {_sql_text(brand)}, 'own': {str(own).lower()}}}" for i, (_, score, reasons, brand, own) in enumerate(_LADDER))


@query(
    f"""with {_COMPANIES}, r as (select c_custkey, case turn {_RULED} end as x from k)
    select o.c_custkey, x.score::double as score, case when x.score >= 0.9 then 'exact' when x.score >= 0.8 then 'review' else 'related_or_uncertain' end as status, x.reasons as reasons, x.brand as public_brand, x.own as self_identified, c_custkey % 17 <> 6 as verbatim from r o"""
)
def r1_r15_ladder(spark: SparkSession, d: str) -> DataFrame:
    """Every customer as a company and a page about it: each step of the ladder, the reasons, the brand, and spans that
    stand on the page (a number that the page writes with spaces is told without)."""
    c = dealt(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_custkey").selectExpr("c_custkey", "cast(c_custkey % 17 as int) as turn", "initcap(lower(c_mktsegment)) as w", "cast(1 + c_custkey % 90 as string) as s", "concat('9', lpad(cast(c_custkey as string), 8, '0')) as o")
    c = c.withColumn("c", F.concat(F.lit("Nordlys "), "w"))
    html = F.element_at(F.array(*(F.lit(h) for h, *_ in _LADDER)), F.col("turn") + 1)
    for name in "cosw":
        html = F.replace(html, F.lit("{" + name + "}"), F.col(name))
    site = F.concat(F.lit("firma"), F.col("c_custkey").cast("string"), F.lit(".no"))
    linked = F.col("turn") == len(_LADDER) - 1
    pages = P.parse_pages(c.select(F.col("c_custkey").alias("page_id"), F.when(linked, F.concat(F.lit("https://www."), site, F.lit("/"))).otherwise(F.lit("https://example.org/")).alias("url"), html.alias("html")))
    pages = stored(pages, "ladder-pages")
    address = F.array(F.struct(F.lit("8006").alias("postcode"), F.lit("BODØ").alias("city"), F.array(F.concat(F.lit("Storgata "), "s")).alias("lines"), F.lit("BODØ").alias("municipality")))
    entities = c.select(
        F.col("c_custkey").alias("page_id"), F.col("o").alias("entity_id"), F.concat("c", F.lit(" AS")).alias("name"), F.array(F.concat(F.lit("Eldre "), "c", F.lit(" AS"))).alias("former_names"), F.lit("BODØ").alias("municipality"),
        address.alias("addresses"), F.concat(F.lit("post@"), site).alias("email"), F.lit(None).cast("string").alias("website"),
    )
    out = resolve.assess_facts(resolve.entity_facts(entities, "page_id").join(resolve.page_facts(pages, "text"), "page_id"))
    return out.select(F.col("page_id").alias("c_custkey"), "score", "status", F.array_join("reasons", ",").alias("reasons"), "public_brand", "self_identified", F.contains(F.lower("text"), F.lower("claim_span")).alias("verbatim"))


#: Suffix rules by turns, for hosts of customers.
_RULES = "case r_regionkey when 0 then 'no' when 1 then 'co.uk' when 2 then '*.ck' when 3 then '!www.ck' else 'kommune.no' end"
_HOSTS = ("a{n}.firma.no", "firma{n}.co.uk", "b.a{n}.x.ck", "www.ck", "by{n}.kommune.no", "kommune.no", "b.a{n}.example")
_DOMAINS = ("firma.no", "firma{n}.co.uk", "a{n}.x.ck", "www.ck", "by{n}.kommune.no", None, "a{n}.example")


@query("select c_custkey, case c_custkey % 7 " + " ".join(f"when {i} then {_sql_text(x)}" for i, x in enumerate(_DOMAINS)) + " end as domain from customer")
def x5_suffix_table(spark: SparkSession, d: str) -> DataFrame:
    rules = table(spark, d, "region").selectExpr(f"{_RULES} as suffix")
    host = F.replace(F.element_at(F.array(*map(F.lit, _HOSTS)), (F.col("c_custkey") % 7 + 1).cast("int")), F.lit("{n}"), F.col("c_custkey").cast("string"))
    return joins.registered_domains(table(spark, d, "customer").select("c_custkey", host.alias("host")), rules).select("c_custkey", "domain")


def _turns(spark: SparkSession, d: str, cases: tuple[tuple[str, str], ...]) -> DataFrame:
    """Customers with one of the cases' inputs in turn, {n} their number: c_custkey, said."""
    said = F.element_at(F.array(*(F.lit(x) for x, _ in cases)), (F.col("c_custkey") % len(cases) + 1).cast("int"))
    return dealt(table(spark, d, "customer").select("c_custkey"), "c_custkey").select("c_custkey", F.replace(said, F.lit("{n}"), F.col("c_custkey").cast("string")).alias("said"))


def _wanted(cases: tuple[tuple[str, str | None], ...]) -> str:
    return f"select c_custkey, case c_custkey % {len(cases)} " + " ".join(f"when {i} then {_sql_text(x)}" for i, (_, x) in enumerate(cases)) + " end as value from customer"


def _texts(name: str, cases: tuple[tuple[str, str | None], ...], of) -> None:
    """Register a query of one expression over such customers."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        return _turns(spark, d, cases).select("c_custkey", of(F.col("said")).cast("string").alias("value"))

    run.__name__ = name
    query(_wanted(cases))(run)


_texts("x2_name_words", (("The Nordlys{n} Group AS", "nordlys{n}"), ("Ærfugl og Ås{n} i Norge", "aerfugl as{n}"), ("AS DA", "")), lambda c: F.array_join(X.name_words(c), " "))
_texts("x3_legal_form", (("alfa{n} se", "alfa{n}"), ("alfa{n} brl", "alfa{n} brl"), ("as", "as"), ("beta{n} asa", "beta{n}")), lambda c: X.without_form(X.fold_words(c), X.AD_LEGAL_FORMS))
_texts("x6_domain_guesses", (("Nordlys{n} Hansen AS", "nordlys{n}hansen.no nordlys{n}-hansen.no nordlys{n}.no nordlys{n}hansen.com"), ("Holding Invest AS", ""), ("Fjord{n} AS", "fjord{n}.no fjord{n}.com")), lambda c: F.array_join(X.domain_guesses(c), " "))
_texts("x8_phones", (("Tlf. 22 33 44 55 nr {n}", "+4722334455"), ("Telefon: 22.33.44.55 / 223 34 456", "+4722334455"), ("mobil 913 34 455 eller tel 12345678", "+4791334455"), ("+47-22334457 og 4722334458", "+4722334457"), ("0047 91234567, 12345678", "+4791234567"), ("kode 22334455", "")), lambda c: F.array_join(X.phones(c), " "))
_texts("x9_loose_date", (("on 2024-02-03 nr {n}", "2024-02-03"), ("3.2.2024", "2024-02-03"), ("Sat, 03 Feb 2024 10:00:00 +0000", "2024-02-03"), ("31.02.2024", None), ("{n}", None)), X.loose_date)
_texts("x10_social_platform", (("https://www.facebook.com/f{n}", "facebook"), ("https://x.com/f{n}", "x"), ("https://twitter.com/intent/tweet?x={n}", None), ("https://f{n}.no/facebook", None), ("https://youtube.com/watch?v={n}", None)), X.social_platform)
_texts("x11_page_kind", (("/om-oss/{n}", "about"), ("/kontakt", "contact"), ("/karriere/{n}", "careers"), ("/x/{n}", None)), lambda c: X.page_kind(c, F.lit(""), P.PAGE_KINDS))
_texts("x12_excerpt", (("aaaa bbbb NEEDLE cccc {n}", "bbbb NEEDLE cccc"), ("none {n}", "needle"), ("needle", "needle")), lambda c: X.excerpt(c, F.lit("needle"), 16))
_texts("x12_folded_excerpt", (("xx ÆRØ  Bakeri yy {n}", "ÆRØ Bakeri"), ("aero-bakeri {n}", "aero-bakeri"), ("aero {n} bakeri", "")), lambda c: X.excerpt_match(c, X.accented(F.array(F.lit("aero"), F.lit("bakeri")), resolve.JOINT), 11))
_texts("x13_literal_span", (('{"u":"\\u00c5s\\/{n}"}', "\\u00c5s\\/"), ("Ås/{n}", "Ås/"), ('{"u":"Ås\\/{n}"}', "Ås\\/"), ("As/{n}", None)), lambda c: X.literal_span(F.lit("Ås/"), c))
_texts("x14_money_text", (("1240000000", "NOK 1.2 billion"), ("24100000", "NOK 24.1 million"), ("-950", "NOK -950"), ("0", "NOK 0")), lambda c: X.money_text(c.cast("double"), F.lit("NOK")))
_texts("x14_spoken_list", (("a{n}", "a{n}"), ("a{n};b", "a{n} and b"), ("a;b;c{n}", "a, b and c{n}")), lambda c: X.spoken_list(F.split(c, ";")))
_texts("x15_canonical", (('{"b":1,"a":"X  {n}"}', "{a:x {n},b:1}"), ('{"a":"x {n}","b":1}', "{a:x {n},b:1}"), (" A  b{n} ", "a b{n}")), X.canonical)
_texts("x16_period_end", (("2023-01-01..2023-12-31", "2023-12-31"), ("2024", "2024"), ("{n}", "{n}")), X.period_end)
_texts("x18_url_class", (("https://a{n}.no/x", "safe"), ("ftp://a{n}.no", "scheme"), ("http://u:p@a{n}.no", "credentials"), ("http://192.168.0.1/{n}", "address"), ("http://db{n}.internal/", "suffix")), X.url_class)
_texts("x19_parked", (("This DOMAIN is for sale {n}", "domain is for sale"), ("Kjøp dette domenet nå", "kjop dette domenet"), ("Velkommen {n}", None)), lambda c: X.let(X.fold_ascii(c), resolve.parked))
_texts("x20_labelled_numbers", (("Org.nr: 993 075 558, nr {n}", "993075558"), ("VAT no NO 911.111.111 og Foretaksnummer 922222222", "911111111 922222222"), ("ring 993 075 558", "")), lambda c: F.array_join(X.labelled_numbers(c), " "))
_texts("x20_company_names", (("Her er Einar Blåuw AS og Beta{n} ASA.", "Einar Blåuw AS|Beta{n} ASA"), ("Ærlig AS, ÆRLIG AS", "Ærlig AS"), ("ingen as", "")), lambda c: F.array_join(X.company_names(c), "|"))
_texts("x21_brand", (("Home | Nordlys{n} mat – Nordlys Bakeri{n}", "Nordlys Bakeri{n}"), ("Hjem · Bakeri {n}", "Bakeri {n}"), ("Forside", None)), lambda c: X.brand(X.title_parts(c), F.concat(F.array(F.lit("nordlys"), F.lit("bakeri")), F.transform(F.regexp_extract_all(c, F.lit("([0-9]+)"), F.lit(1)), lambda n: F.concat(F.lit("bakeri"), n)))))
_texts("x23_punycode_host", (("xn--pnerom-hua.no", "åpnerom.no"), ("a{n}.no", "a{n}.no"), ("xn--{n}-.no", "xn--{n}-.no")), X.punycode_host)


_texts("d1_claim_key", (("https://www.A.no/b{n}/", "a.no/b{n}"), ('{"url":"http://a.no/{n}/","name":"x"}', "a.no/{n}"), ('{"name":"A  B{n}","role":"Chair"}', "a b{n}|chair"), ('{"name":"A","role_code":"LEDE","role":"x"}', "a|lede"), ('{"platform":"X"}', "x"), ('{"date":"2024-01-0{n}","change_type":"c"}', "2024-01-0{n}|c"), ('{"name":"Cook {n}"}', "cook {n}"), ('{"b":1,"a":{n}}', "{a:{n},b:1}"), ("plain {n}", "")), diff.claim_key)


def _c(field: str, value: object, section: str = "identity", state: str = "available", period: str | None = None, note: str | None = None, source: str | None = None) -> tuple:
    return field, section, value if value is None or isinstance(value, str) else json.dumps(value, separators=(",", ":")), state, period, note, source


#: Claims of two runs by turns, and the changes between them: (field, type, materiality, earlier value, later value). {n}: the customer.
_RUNS = (
    ([_c("legal_name", "Alfa {n}")], [_c("legal_name", "Beta {n}")], [("legal_name", "changed_name", "material", "Alfa {n}", "Beta {n}")]),
    ([_c("legal_name", "Alfa  {n}")], [_c("legal_name", "ALFA {n}")], []),
    ([_c("reporting_period", {"to": "2023-12-31"}, "accounts"), _c("revenue", "1.0", "accounts", period="2023")], [_c("reporting_period", {"to": "2024-12-31"}, "accounts"), _c("revenue", "2.0", "accounts", period="2024")], [("reporting_period", "new_filing", "material", '{"to":"2023-12-31"}', '{"to":"2024-12-31"}')]),
    ([_c("accounts_filing_years", ["2022"], "accounts")], [_c("accounts_filing_years", ["2022", "2023"], "accounts")], [("accounts_filing_years", "new_filing", "material", '["2022"]', '{"new_periods":["2023"]}')]),
    ([_c("equity", "1.0", "accounts", period="2023"), _c("revenue", "1.0", "accounts", period="2023")], [_c("equity", "2.0", "accounts", period="2024"), _c("revenue", "9.0", "accounts", period="2024")], [("equity", "new_filing", "material", '{"reporting_period":"2023","value":"1.0"}', '{"reporting_period":"2024","value":"2.0"}')]),
    ([_c("revenue", "1.{n}", "accounts", period="2023")], [_c("revenue", "2.{n}", "accounts", period="2023")], [("revenue", "changed_financials", "material", "1.{n}", "2.{n}")]),
    (
        [_c("legal_form", "AS"), _c("business_address", {"a": 1, "b": 2}), _c("registered_address", "x"), _c("status_flags", {"a": True}), _c("registry_website", "a.no"), _c("registry_employees", "1"), _c("industry_code", "1"), _c("public_brand", "A", "web"), _c("website_description", "d", "web"), _c("official_website", "https://a.no", "web")],
        [_c("legal_form", "ASA"), _c("business_address", {"b": 2, "a": 1}), _c("registered_address", "y"), _c("status_flags", {"a": False}), _c("registry_website", "b.no"), _c("registry_employees", "2"), _c("industry_code", "2"), _c("public_brand", "B", "web"), _c("website_description", "D", "web"), _c("official_website", "https://b.no", "web")],
        [("legal_form", "changed_legal_form", "material", "AS", "ASA"), ("registered_address", "changed_address", "material", "x", "y"), ("status_flags", "changed_status", "material", '{"a":true}', '{"a":false}'), ("registry_website", "changed_registry_website", "material", "a.no", "b.no"), ("registry_employees", "changed_employee_count", "minor", "1", "2"), ("industry_code", "changed_industry", "material", "1", "2"), ("public_brand", "changed_brand", "minor", "A", "B"), ("website_description", "changed_description", "minor", "d", "D"), ("official_website", "changed_website", "material", "https://a.no", "https://b.no")],
    ),
    ([_c("legal_name", "A")], [_c("legal_name", "A"), _c("official_website", "https://a{n}.no", "web")], [("official_website", "new_website", "material", None, "https://a{n}.no")]),
    ([_c("official_website", "http://www.a.no/", "web")], [_c("official_website", "https://a.no", "web")], []),
    ([_c("former_names", ["X"])], [_c("former_names", ["X", "Y"])], [("former_names", "changed_name", "material", '["X"]', '{"former_names_added":["Y"]}')]),
    (
        [_c("job_posting", {"name": "cook"}, "hiring", source="nav"), _c("job_posting", {"name": "smith"}, "hiring", source="nav"), _c("role", {"name": "A", "role": "chair"}, "leadership"), _c("workplace", {"name": "W"}, "footprint")],
        [_c("job_posting", {"name": "Cook"}, "hiring", source="nav_feed"), _c("job_posting", {"name": "baker"}, "hiring", source="nav_feed"), _c("role", {"name": "B", "role": "chair"}, "leadership"), _c("workplace", {"name": "V"}, "footprint"), _c("social_profile", {"platform": "x"}, "web")],
        [("job_posting", "closed_job", "material", '{"name":"smith"}', None), ("job_posting", "new_job", "material", None, '{"name":"baker"}'), ("role", "removed_role", "material", '{"name":"A","role":"chair"}', None), ("role", "new_role", "material", None, '{"name":"B","role":"chair"}'), ("workplace", "removed_location", "material", '{"name":"W"}', None), ("workplace", "new_location", "material", None, '{"name":"V"}'), ("social_profile", "new_social_profile", "minor", None, '{"platform":"x"}')],
    ),
    ([_c("job_posting", {"name": "cook"}, "hiring", source="nav")], [_c("job_posting", {"name": "smith"}, "hiring", source="site")], [("job_posting", "new_job", "material", None, '{"name":"smith"}')]),
    ([_c("job_posting", {"name": "cook"}, "hiring", source="nav")], [_c("job_posting", {"name": "smith"}, "hiring", source="site"), _c("active_job_count", "0", "hiring")], [("job_posting", "closed_job", "material", '{"name":"cook"}', None), ("job_posting", "new_job", "material", None, '{"name":"smith"}')]),
    ([_c("revenue", "1", "accounts")], [_c("revenue", None, "accounts", "not_available", note="not checked this run: late")], []),
    ([_c("revenue", "1", "accounts")], [_c("revenue", None, "accounts", "failed")], [("revenue", "availability_changed", "material", "available", "failed")]),
    ([_c("founded", None, state="failed")], [_c("founded", "2001")], [("founded", "availability_changed", "minor", "failed", "available")]),
    ([], [_c("legal_name", "New {n}")], []),
    ([_c("legal_name", "Alfa {n}"), _c("former_names", None, state="not_available")], [_c("legal_name", "Beta {n}"), _c("former_names", ["Alfa {n}"])], [("legal_name", "changed_name", "material", "Alfa {n}", "Beta {n}")]),
    ([_c("legal_name", "Beta {n}"), _c("former_names", None, state="not_available")], [_c("legal_name", "Beta {n}"), _c("former_names", ["Alfa {n}"])], [("former_names", "changed_name", "material", None, '{"former_names_added":["Alfa {n}"]}')]),
    ([_c("news_item", {"url": "http://a/1"}, "activity"), _c("registry_update", {"date": "2024-01-01", "change_type": "Ny"}, "activity")], [_c("news_item", {"url": "http://a/2"}, "activity"), _c("registry_update", {"date": "2024-02-01", "change_type": "Ny"}, "activity")], [("news_item", "new_news", "minor", None, '{"url":"http://a/2"}'), ("registry_update", "new_registry_update", "minor", None, '{"date":"2024-02-01","change_type":"Ny"}')]),
)


def _side(spark: SparkSession, d: str, side: int) -> DataFrame:
    """One run's claims of every customer, each with an evidence id of its own; the earlier run read in May, the later one in June."""
    kinds = "array<struct<ord:int,field:string,section:string,value:string,availability:string,reporting_period:string,note:string,source:string>>"
    claim = lambda i, c: F.struct(F.lit(i).alias("ord"), *(F.lit(v).cast("string").alias(n) for n, v in zip(("field", "section", "value", "availability", "reporting_period", "note", "source"), c, strict=True)))
    runs = F.array(*(F.array(*(claim(i, c) for i, c in enumerate(run[side]))).cast(kinds) for run in _RUNS))
    c = table(spark, d, "customer").select("c_custkey", F.explode(F.element_at(runs, (F.col("c_custkey") % len(_RUNS) + 1).cast("int"))).alias("c"))
    out = c.select(F.col("c_custkey").alias("entity_id"), "c.*").withColumn("value", F.replace("value", F.lit("{n}"), F.col("entity_id").cast("string")))
    when = ("2024-05-01", "2024-06-01")[side]
    return out.withColumns({"observed": F.when(F.col("ord") > 0, F.lit(when)), "run_started": F.lit(when + "T00"), "run_completed": F.lit(when + "T09"), "evidence_ids": F.array(F.concat(F.lit("pc"[side]), F.col("ord").cast("string")))})


def _place(claims: list[tuple], field: str, value: str | None) -> int:
    """Place of a field's claim that holds a value, else its first."""
    at = [i for i, c in enumerate(claims) if c[0] == field]
    return next((i for i in at if claims[i][2] == value), at[0])


def _told(run: tuple, change: tuple) -> str:
    """A change as a DuckDB struct, with the time of the earlier claim (of its run where it is the first), else of the later one, and both ids."""
    field, kind, materiality, before, after = change
    p = None if before is None else _place(run[0], field, before)
    c = None if after is None else _place(run[1], field, after)
    at, day = (p, "2024-05-01") if p is not None else (c, "2024-06-01")
    seen = day if at else day + "T00"
    ids = [x if x is None else f"{s}{x}" for s, x in (("c", c), ("p", p))]
    quoted = [_sql_text(x) for x in (field, kind, materiality, before, after, seen)]
    names = ("field", "change_type", "materiality", "previous_value", "current_value", "first_observed")
    lists = [f"'{n}': '{i or ''}'" for n, i in zip(("evidence", "previous_evidence"), ids, strict=True)]
    return "{" + ", ".join([*(f"'{n}': {v}::varchar" for n, v in zip(names, quoted, strict=True)), *lists]) + "}"


@query(
    "select c_custkey as entity_id, x.field as field, x.change_type as change_type, x.materiality as materiality, x.previous_value as previous_value, x.current_value as current_value, x.first_observed as first_observed, '2024-06-01T09' as last_observed, x.evidence as evidence, x.previous_evidence as previous_evidence from ("
    f"select c_custkey, unnest(case c_custkey % {len(_RUNS)} " + " ".join(f"when {i} then [{', '.join(_told(run, ch) for ch in run[2])}]" for i, run in enumerate(_RUNS) if run[2]) + " end) as x from customer)"
)
def d1_d12_changes(spark: SparkSession, d: str) -> DataFrame:
    """Every rule of change detection on every customer: types, values, times, evidence; the first run of an entity and skipped steps give nothing."""
    out = diff.diff_claims(_side(spark, d, 0), _side(spark, d, 1))
    return out.select("entity_id", "field", "change_type", "materiality", "previous_value", "current_value", "first_observed", "last_observed", F.array_join("evidence_ids", ",").alias("evidence"), F.array_join("previous_evidence_ids", ",").alias("previous_evidence"))


@query("select user_id::varchar as company, count(*) as requests, sum(1 + event_id % 3)::bigint as attempts, count(*) filter (event_type = 'error') as failed from events group by 1")
def io7_fetch_log(spark: SparkSession, d: str) -> DataFrame:
    """A request log of the events, written as JSON lines and read by its schema."""
    path = shared_path(spark, "fetch-log")
    log = (
        "cast(user_id as string) as company", "concat('https://a.no/', event_id) as url", "if(event_type = 'error', 503, 200) as status", "1 + event_id % 3 as attempts", "array() as redirects",
        "if(event_type = 'error', 'x', null) as error", "event_id as bytes", "5 as elapsed_ms", "ts as at",
    )
    table(spark, d, "events").selectExpr(*log).write.json(path)
    return io.fetch_log(spark, path).groupBy("company").agg(F.count("*").alias("requests"), F.sum("attempts").alias("attempts"), F.count(F.when(F.col("status") >= 400, 1)).alias("failed"))


@query("select o_orderkey as id, strftime(o_orderdate, '%Y-%m-%d') as lastmod from orders")
def io9_xml_items(spark: SparkSession, d: str) -> DataFrame:
    """Orders as entries of sitemaps, a thousand keys a file, written as XML text and read by their row tag."""
    path = shared_path(spark, "sitemap")
    row = F.concat(F.lit("<url><loc>https://a.no/"), F.col("o_orderkey").cast("string"), F.lit("?a=1&amp;b=2</loc><lastmod>"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("</lastmod></url>"))
    maps = table(spark, d, "orders").groupBy(F.expr("o_orderkey div 1000").alias("map")).agg(F.array_join(F.collect_list(row), "").alias("u"))
    maps.select(F.concat(F.lit("<urlset>"), "u", F.lit("</urlset>")).alias("value"), "map").write.partitionBy("map").text(path)
    out = io.xml_items(spark, path, "url", "loc string, lastmod string")
    return out.select(F.regexp_extract("loc", r"/(\d+)\?a=1&b=2$", 1).cast("long").alias("id"), "lastmod")


@query("select c_custkey as id, c_name as name, count(o_orderkey) as orders from customer left join orders on o_custkey = c_custkey group by 1, 2")
def io10_compressed_export(spark: SparkSession, d: str) -> DataFrame:
    """Documents of customers with their orders, exported as gzipped JSON lines and read back."""
    path = shared_path(spark, "export")
    orders = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.collect_list("o_orderkey").alias("orders"))
    docs = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).join(orders, "id", "left")
    io.compressed_export(docs, path)
    return spark.read.schema("id long, name string, orders array<long>").json(path).select("id", "name", F.coalesce(F.size("orders"), F.lit(0)).cast("long").alias("orders"))


#: Problems of a site by turns, from what a verdict on it says.
_AUDITED = (("exact", "org_number_on_page", True, "{n} is here", None), ("review", "name_match_but_other_org_number", True, "{n} is here", "another number,not exact now"), ("review", "title_names_another_entity", False, "{n} is here", "another entity,brand,not exact now"), ("exact", "org_number_on_page", True, "not there", "span not on page"), ("review", "page_lists_many_companies", True, "{n} is here", "a listing,not exact now"))


@query(f"select c_custkey as entity_id, unnest(string_split(case when c_custkey % 6 = 5 then 'page gone' else case c_custkey % 6 {' '.join(f'when {i} then {_sql_text(p)}' for i, (*_, p) in enumerate(_AUDITED))} end end, ',')) as problem from customer")
def q4_site_audit(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("n"), (F.col("c_custkey") % 6).cast("int").alias("turn"))
    published = c.select(F.col("c_custkey").alias("entity_id"), F.col("c_custkey").alias("page_id"), F.concat("n", F.lit(" is here")).alias("claim_span"))
    pick = lambda k: F.element_at(F.array(*(F.lit(x[k]) for x in _AUDITED)), F.col("turn") + 1)
    seen = c.where("turn < 5")
    verdicts = seen.select(F.col("c_custkey").alias("entity_id"), F.col("c_custkey").alias("page_id"), pick(0).alias("status"), F.array(pick(1)).alias("reasons"), F.replace(pick(3), F.lit("{n}"), F.col("n")).alias("text"), pick(2).alias("brand_shared"))
    return quality.site_audit(published, verdicts)


@query("select c_custkey, case c_custkey % 4 when 0 then 'Marked as bankrupt.' when 1 then 'Marked as being wound up. Marked as under forced liquidation.' when 2 then 'Equity is negative (NOK -' || (1 + c_custkey % 9) || '.0 million).' else '' end as value from customer")
def t2_risk_flags(spark: SparkSession, d: str) -> DataFrame:
    flags = F.element_at(F.array(F.lit('{"bankrupt":true}'), F.lit('{"bankrupt":false,"liquidating":true,"forced_liquidation":true}'), F.lit("{}"), F.lit(None).cast("string")), (F.col("c_custkey") % 4 + 1).cast("int"))
    equity = F.when(F.col("c_custkey") % 4 == 2, -1e6 * (1 + F.col("c_custkey") % 9)).otherwise(F.lit(5.0))
    return table(spark, d, "customer").select("c_custkey", F.array_join(synth.risk_flags(flags, equity), " ").alias("value"))


@query(
    """select c_custkey as entity_id, case c_custkey % 3 when 0 then 'Verified because the organisation number is printed on the page.' when 1 then 'Verified because the page writes the legal name and the registered address and street with number gate ' || c_custkey || '.' end as text from customer"""
)
def t6_verification(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("c_custkey").cast("string")
    reasons = F.element_at(F.array(F.array(F.lit("org_number_on_page"), F.lit("org_number:labelled")), F.array(F.lit("legal_name_and_registered_address"), F.concat(F.lit("street_with_number:gate "), n)), F.array(F.lit("name_only"))), (F.col("c_custkey") % 3 + 1).cast("int"))
    return synth.verification(table(spark, d, "customer").select(F.col("c_custkey").alias("entity_id"), reasons.alias("reasons")))


@query(
    """with o as (select o_custkey, count(*) as n, bool_or(o_orderstatus = 'P') as bad from orders group by 1), e as (select user_id, count(*) as n from events group by 1)
    select c_custkey as entity_id, coalesce(o.n, 0) as claims, coalesce(e.n, 0) as changes, case when o.n is null or c_custkey % 5 = 0 then 'failed' when o.bad then 'completed_with_errors' else 'completed' end as terminal_status from customer left join o on o_custkey = c_custkey left join e on user_id = c_custkey"""
)
def t7_profile_document(spark: SparkSession, d: str) -> DataFrame:
    """One nested document a customer: orders as claims, events as changes, states by section."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    claims = o.selectExpr("o_custkey as entity_id", "cast(o_orderkey as string) as claim_id", "'s' as section", "o_orderpriority as field", "'v' as value", "'available' as availability")
    states = c.selectExpr("c_custkey as entity_id", "'identity' as section", "if(c_custkey % 5 = 0, 'failed', 'available') as state").union(o.groupBy("o_custkey").agg(F.expr("if(bool_or(o_orderstatus = 'P'), 'failed', 'available')").alias("state")).select("o_custkey", F.lit("web"), "state"))
    changes = table(spark, d, "events").selectExpr("user_id as entity_id", "event_type as field", "'x' as change_type", "'minor' as materiality")
    out = synth.profile_document(c.selectExpr("c_custkey as pos", "c_custkey as id"), claims, states, changes, c.selectExpr("c_custkey as entity_id", "c_name as what"))
    return out.select("entity_id", F.coalesce(F.size("claims"), F.lit(0)).cast("long").alias("claims"), F.coalesce(F.size("changes"), F.lit(0)).cast("long").alias("changes"), "terminal_status")
