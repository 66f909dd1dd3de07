from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from attestor.operators.pages import contacts, job_postings, leaders, parse_page, parse_pages, socials
from attestor.operators.resolve import assess

ENTITY = {"entity_id": "912345678", "name": "Nordlys Bakeri AS", "former": [], "municipality": "BODØ", "email": "post@nordlysbakeri.no", "website": None, "address": ("8006", "BODØ", ["Storgata 12"], "BODØ")}
ADDRESS = "struct<postcode:string,city:string,lines:array<string>,municipality:string>"


def verdicts(spark, cases):
    """{name: row}: every case is an entity of its own number and one page, all assessed in one run."""
    entities, pages = [], []
    for i, (name, (html, over)) in enumerate(cases.items()):
        e = ENTITY | {k: v for k, v in over.items() if k != "url"}
        entities.append((e["entity_id"], e["name"], e["former"], e["municipality"], [e["address"]] if e["address"] else [], e["email"], e["website"], i))
        pages.append((i, over.get("url", "https://example.org/"), html))
    entity = spark.createDataFrame(entities, f"entity_id string, name string, former_names array<string>, municipality string, addresses array<{ADDRESS}>, email string, website string, page_id long")
    parsed = parse_pages(spark.createDataFrame(pages, "page_id long, url string, html string"))
    got = {r.page_id: r for r in assess(entity.join(parsed, "page_id")).collect()}
    return {name: got[i] for i, name in enumerate(cases)}


CASES = {
    "parked": ("<title>Nordlys Bakeri</title>This domain is for sale", {}, 0.1, "parked"),
    "number": ("<title>Nordlys Bakeri</title>Org.nr 912 345 678", {}, 1.0, "org_number_on_page"),
    "number with dots": ("<p>912.345.678</p>", {}, 1.0, "org_number_on_page"),
    "digits beside": ("<p>1912345678</p>", {}, 0.3, "name_not_found"),
    "many numbers": ("Org.nr 912345678 Org.nr 811111111 Org.nr 822222222", {}, 0.8, "org_number_among_many"),
    "other number": ("<title>Nordlys Bakeri</title>Org.nr 811111111", {}, 0.8, "name_match_but_other_org_number"),
    "title of another": ("<title>Home | Einar Nordlys Bakeri AS</title>Nordlys Bakeri AS, Storgata 12", {}, 0.8, "title_names_another_entity"),
    "former name is no other": ("<title>Einar Nordlys Bakeri AS</title>Storgata 12", {"former": ["Einar Nordlys Bakeri AS"]}, 0.95, "legal_name_and_registered_address"),
    "third party": ("<title>Fjell Regnskap AS</title><p>Kunder: Nordlys og Bakeri</p>", {}, 0.8, "page_belongs_to_another_company"),
    "listing": ("<p>Alfa AS, Beta AS, Gamma AS, Nordlys Bakeri AS</p>", {}, 0.8, "page_lists_many_companies"),
    "partial": ("<title>Nordlys</title>", {}, 0.3, "name_partial"),
    "absent": ("<title>Something</title>", {}, 0.3, "name_not_found"),
    "name and street": ("<title>Nordlys Bakeri</title>Storgata 12", {}, 0.95, "legal_name_and_registered_address"),
    "name and postcode with town": ("<title>Nordlys-Bakeri</title>8006 Bodø", {}, 0.95, "legal_name_and_registered_address"),
    "bare postcode": ("<title>Nordlys Bakeri</title>pris 8006", {}, 0.8, "name_only"),
    "place only": ("<title>Nordlys Bakeri</title>Bodø", {}, 0.8, "name_only"),
    "scattered": ("<p>Bakeri i byen. Nordlys over fjellet. Storgata 12</p>", {}, 0.8, "name_mentioned_only"),
    "linked domain": ("<p>Nordlys. Bakeri.</p>", {"url": "https://www.nordlysbakeri.no/"}, 0.95, "registry_linked_domain"),
    "consumer mail": ("<p>Nordlys. Bakeri.</p>", {"url": "https://gmail.com/", "email": "x@gmail.com"}, 0.8, "name_mentioned_only"),
    "registry website": ("<p>Nordlys. Bakeri.</p>", {"url": "https://nb.no/x", "website": "www.nb.no", "email": None}, 0.95, "registry_linked_domain"),
}


@pytest.fixture(scope="module")
def assessed(spark):
    return verdicts(spark, {name: (html, over) for name, (html, over, _, _) in CASES.items()})


@pytest.mark.parametrize("name", CASES)
def test_ladder(name, assessed):
    _, _, score, reason = CASES[name]
    r = assessed[name]
    assert (r.score, r.reasons[0]) == (score, reason)
    assert r.status == ("exact" if score >= 0.9 else "review" if score >= 0.8 else "related_or_uncertain")


def test_spans_are_verbatim(assessed):
    for name, (html, _, _, _) in CASES.items():
        assert assessed[name].claim_span in parse_page("u", html)["text"] or assessed[name].reasons[0] in ("parked", "name_partial", "name_not_found", "title_names_another_entity")


HOME = """<html><head><title>Nordlys Bakeri | Hjem</title><meta name="description" content="Brød"><script type="application/ld+json">
{"@graph": [{"@type": "Organization", "name": "Nordlys", "sameAs": ["https://www.facebook.com/nordlys/"]}, {"@type": "JobPosting", "title": "Baker", "url": "https://n.no/j", "datePosted": "2024-01-02T00:00"},
{"@type": "Person", "name": "Kari Nes", "jobTitle": "Daglig leder"}]}</script></head><body><a href="mailto:Post@n.no">post</a><a href="/om-oss?x=1#a">Om oss</a><a href="javascript:x">no</a>
<a href="https://facebook.com/sharer.php?u=1">del</a><p>Ola Berg</p><p>Styreleder</p><p>Tlf: 22 33 44 55</p><footer>Nordlys AS</footer></body></html>"""


def test_page_facts(spark):
    p = parse_pages(spark.createDataFrame([(1, "https://www.n.no/", HOME)], "page_id long, url string, html string")).cache()
    row = p.first()
    assert row.title == "Nordlys Bakeri | Hjem" and row.description == "Brød" and "application" not in row.text
    assert [x.url for x in row.links] == ["mailto:Post@n.no", "https://www.n.no/om-oss", "https://facebook.com/sharer.php"]
    got = {(r.field, r.value, r.confidence) for r in contacts(p).collect()}
    assert got == {("contact_email", "post@n.no", 1.0), ("contact_phone", "+4722334455", 0.8)}
    assert [(r.platform, r.url) for r in socials(p).collect()] == [("facebook", "https://facebook.com/nordlys")]
    assert {(r.name, r.title) for r in leaders(p).collect()} == {("Kari Nes", "Daglig leder"), ("Ola Berg", "Styreleder")}
    assert [(r.title, r.date_posted) for r in job_postings(p).collect()] == [("Baker", "2024-01-02")]
    assert p.select(F.size("nodes")).first()[0] == 3


def test_broken_page(spark):
    p = parse_pages(spark.createDataFrame([(1, None, None), (2, "x", "<a href='http://['>x</a><script type='application/ld+json'>{</script>")], "page_id long, url string, html string"))
    assert [(len(r.links), len(r.nodes)) for r in p.orderBy("page_id").collect()] == [(0, 0), (0, 0)]
