"""Expressions, sources, texts and streams on literal rows."""

from __future__ import annotations

import gzip
import json
import random
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from attestor.functions import expr as X
from attestor.operators import joins, normalise, pages, quality, rank, rollup, synth
from attestor.plans import evidence
from attestor.sources import io
from attestor.streaming import feeds


@pytest.fixture(scope="module")
def values(spark):
    """Every expression over its literals, evaluated in one projection."""
    s = lambda v: F.lit(v).cast("string")
    checks = [
        (X.fold_ascii(s("Ærø Café Ångström ß")), "aero cafe angstrom "),
        (X.fold_words(s("Café  d'Or, AS")), "café d or as"),
        (X.fold_words(s("Ås Rør_1 AS")), "as ror_1 as"),
        (X.without_form(s("alfa se"), X.AD_LEGAL_FORMS), "alfa"),
        (X.without_form(s("alfa brl"), X.AD_LEGAL_FORMS), "alfa brl"),
        (X.fold_feed(s("STRAßE & Sønn, AS")), "strasse sonn as"),
        (X.fold_nfkd(s("Ærø Čapek ﬁ")), "aero capek fi"),
        (X.punycode_host(s("xn--pnerom-hua.no")), "åpnerom.no"),
        (F.array_join(X.name_words(s("The Nordlys Group AS i X")), "|"), "nordlys"),
        (X.without_form(s("alfa as")), "alfa"),
        (X.without_form(s("as alfa")), "as alfa"),
        (X.norm_url(s("HTTPS://www.A.no:80/b/?q=1#f")), "a.no/b?q=1"),
        (X.host(s("www.a.no/x")), "a.no"),
        (X.registered_domain(s("x.y.co.uk")), "y.co.uk"),
        (X.registered_domain(s("x.y.no")), "y.no"),
        (F.array_join(X.domain_guesses(s("Nordlys Bakeri AS")), " "), "nordlysbakeri.no nordlys-bakeri.no nordlys.no nordlysbakeri.com"),
        (F.array_join(X.domain_guesses(s("Nordlys Hansen Bygg AS")), " "), "nordlyshansenbygg.no nordlys-hansen-bygg.no nordlys.no nordlyshansenbygg.com"),
        (F.array_join(X.domain_guesses(s("Invest Nor AS")), " "), "investnor.no invest-nor.no investnor.com invest-nor.com"),
        (F.array_join(X.domain_guesses(s("Nordlys AS")), " "), "nordlys.no nordlys.com"),
        (F.size(X.domain_guesses(s("The Group AS"))), 0),
        (F.size(X.domain_guesses(s("Holding Invest AS"))), 0),
        (X.email_domain(s("a@gmail.com")), None),
        (X.email_domain(s("a@B.no")), "b.no"),
        (F.array_join(X.phones(s("Tlf. 22 33 44 55, 0047 91234567, 12345678")), " "), "+4722334455 +4791234567"),
        (X.loose_date(s("on 2024-02-03 at")), date(2024, 2, 3)),
        (X.loose_date(s("3.2.2024")), date(2024, 2, 3)),
        (X.loose_date(s("Sat, 03 Feb 2024 10:00:00 +0000")), date(2024, 2, 3)),
        (X.loose_date(s("31.02.2024")), None),
        (X.social_platform(s("https://www.facebook.com/acme")), "facebook"),
        (X.social_platform(s("https://twitter.com/intent/tweet?x")), None),
        (X.social_platform(s("https://acme.no/facebook")), None),
        (X.page_kind(s("/om-oss/x"), s("kontakt"), pages.PAGE_KINDS), "about"),
        (X.page_kind(s("/x"), s("Kontakt"), pages.PAGE_KINDS), "contact"),
        (X.excerpt(s("aaaa bbbb NEEDLE cccc dddd"), s("needle"), 16), "bbbb NEEDLE cccc"),
        (X.excerpt(s("x"), s("absent"), 16), "absent"),
        (X.literal_span(s("a/b"), s('{"u":"a\\/b"}')), "a\\/b"),
        (X.literal_span(s("a & b"), s("<p>a &amp; b</p>")), "a &amp; b"),
        (X.literal_span(s("a"), s("b")), None),
        (X.literal_span(s("Ås/ø 😀"), s('{"u":"\\u00c5s\\/\\u00f8 \\ud83d\\ude00"}')), "\\u00c5s\\/\\u00f8 \\ud83d\\ude00"),
        (X.literal_span(s("Ås/ø"), s('{"u":"\\u00c5s/\\u00f8"}')), "\\u00c5s/\\u00f8"),
        (X.literal_span(s("Hålandsvegen 33"), s('{"address":"H\\u00E5landsvegen 33 \\nBryne"}')), "H\\u00E5landsvegen 33"),
        (X.literal_span(s('{"formaal":["Salg av varer","og tjenester"]}'), s('{"navn":"X AS","formaal" : ["Salg av varer","og tjenester"],"z":1}')), '"formaal" : ["Salg av varer","og tjenester"]'),
        (X.literal_span(s('{"navn":"X AS","n":12,"gone":1}'), s('{"a":0, "navn": "X AS", "b":[1], "n":12}')), '"navn": "X AS", "b":[1], "n":12'),
        (X.literal_span(s('{"navn":"Y"}'), s('{"navn":"X"}')), None),
        (X.excerpt_match(s("xx ÆRØ  Bakeri yy"), X.accented(F.array(s("aero"), s("bakeri")), r"\s+"), 10), "ÆRØ Bakeri"),
        (X.excerpt_match(s("none"), X.accented(F.array(s("aero")), " "), 10), ""),
        (X.canonical(s('{"b":1,"a":"X  y"}')), '{a:x y,b:1}'),
        (X.canonical(s('{"a":"x y","b":1}')), '{a:x y,b:1}'),
        (X.number_pattern(s("12")), None),
        (X.number_pattern(s("")), None),
        (F.array_join(X.company_names(s("Stålleverandøren AS, STÅLLEVERANDØREN AS, Ærlig & Co")), "|"), "Stålleverandøren AS"),
        (X.money_text(F.lit(24_100_000.0), s("NOK")), "NOK 24.1 million"),
        (X.money_text(F.lit(-950.0), s("NOK")), "NOK -950"),
        (X.spoken_list(F.array(s("a"), s("b"), s("c"))), "a, b and c"),
        (X.period_end(s("2023-01-01..2023-12-31")), "2023-12-31"),
        (X.url_class(s("https://a.no/x")), "safe"),
        (X.url_class(s("ftp://a.no")), "scheme"),
        (X.url_class(s("http://u:p@a.no")), "credentials"),
        (X.url_class(s("http://192.168.0.1/")), "address"),
        (X.url_class(s("http://db.internal/")), "suffix"),
        (F.array_join(X.labelled_numbers(s("Org.nr: 993 075 558, VAT no NO 911.111.111")), " "), "993075558 911111111"),
        (F.array_join(X.company_names(s("Her er Einar Blaauw AS og Beta ASA.")), "|"), "Einar Blaauw AS|Beta ASA"),
        (X.brand(F.array(s("Home"), s("Nordlys mat"), s("Nordlys Bakeri")), F.array(s("nordlys"), s("bakeri"))), "Nordlys Bakeri"),
        (joins.blocked_host(s("x.spam.com"), ("spam.com",), ("ads",)), True),
        (joins.blocked_host(s("notspam.com"), ("spam.com",), ("ads",)), False),
        (F.array_join(synth.risk_flags(s('{"bankrupt":true}'), F.lit(-5e6)), " "), "Marked as bankrupt. Equity is negative (NOK -5.0 million)."),
    ]
    row = spark.range(1).select(*(c.alias(f"c{i}") for i, (c, _) in enumerate(checks))).first()
    return [(row[i], want) for i, (_, want) in enumerate(checks)]


def test_expressions(values):
    assert [g for g, _ in values] == [w for _, w in values]


def test_id_batch(spark, tmp_path):
    (tmp_path / "ids.txt").write_text('{"organisation_number": "912345678"}\n923456789,x\n\nnope\n912 345 678\n{"org": 934567890}\n')
    ids, bad = io.read_id_batch(spark, str(tmp_path / "ids.txt"))
    assert [r.id for r in ids.orderBy("pos").collect()] == ["912345678", "923456789", "934567890"]
    assert sorted((r.line, r.reason) for r in bad.collect()) == [("912 345 678", "duplicate"), ("nope", "invalid")]


def test_files(spark, tmp_path):
    lines = '{"id": "a", "v": 1}\nbroken {\n{"id": "a", "v": 2}\n{"v": 3}\n'
    (tmp_path / "d.jsonl").write_text(lines)
    assert [(r.key, json.loads(r.doc)["v"]) for r in io.load_latest_documents(spark, str(tmp_path / "d.jsonl"), "id").collect()] == [("a", 2)]
    assert io.load_latest_documents(spark, str(tmp_path / "absent.jsonl"), "id").count() == 0
    ids = spark.createDataFrame([(0, "b"), (1, "a"), (2, "c")], "pos long, id string")
    io.write_profiles(spark.createDataFrame([("a", 1), ("b", 2)], "entity_id string, v int"), ids, str(tmp_path / "p"), partitions=2)
    got = [json.loads(x)["id"] for f in sorted((tmp_path / "p").glob("part-*")) for x in f.read_text().splitlines()]
    assert got == ["b", "a", "c"]
    io.compressed_export(ids.coalesce(1), str(tmp_path / "z"))
    (part,) = (tmp_path / "z").glob("*.gz")
    assert len(gzip.open(part).read().splitlines()) == 3
    (tmp_path / "s.xml").write_text("<urlset><url><loc>a</loc><lastmod>2024-01-02</lastmod></url><url><loc>b</loc></url></urlset>")
    items = io.xml_items(spark, str(tmp_path / "s.xml"), "url", "loc string, lastmod string").collect()
    assert sorted((r.loc, r.lastmod) for r in items) == [("a", "2024-01-02"), ("b", None)]
    (tmp_path / "log.json").write_text('{"company": "c", "url": "u", "attempts": 2, "bytes": 5}\n')
    assert rollup.request_accounting(io.fetch_log(spark, str(tmp_path / "log.json"))).count() == 2


def test_snapshots_are_kept_once(spark):
    bodies = spark.createDataFrame([("x", "html", "b"), ("x", "html", "a"), ("y", "json", "c")], "body string, kind string, path string")
    first = io.snapshot_store(bodies)
    assert sorted((r.first_path, r.stored_as[-5:], r.copies) for r in first.collect()) == [("a", ".html", 2), ("c", ".json", 1)]
    assert io.snapshot_store(bodies, first).count() == 0


def test_roles_leave_out_the_dead_and_the_gone(spark):
    person = lambda n, dead=False, gone=False: {"type": {"kode": "LEDE", "beskrivelse": "Chair"}, "fratraadt": gone, "person": {"navn": {"fornavn": n, "mellomnavn": None, "etternavn": "B"}, "erDod": dead}, "enhet": None}
    firm = {"type": {"kode": "REVI", "beskrivelse": "Auditor"}, "fratraadt": None, "person": None, "enhet": {"organisasjonsnummer": "9", "navn": ["Tell", "AS"]}}
    rows = [("a", [{"sistEndret": "2020-01-01", "roller": [person("K"), person("D", dead=True), person("G", gone=True), firm]}]), ("b", [])]
    got = normalise.role_claims(spark.createDataFrame(rows, normalise.ROLES)).collect()
    assert sorted((r.entity_id, r.field, json.loads(r.value)["name"] if r.field == "role" and r.value else r.value, r.availability) for r in got) == [
        ("a", "role", "K B", "available"), ("a", "role", "Tell AS", "available"), ("a", "role_count", "2", "available"), ("b", "role", None, "not_available")]
    assert "fodselsdato" not in str(got)


def test_spans_against_all_documents(spark, tmp_path):
    """Every item meets every document, whatever their ids; held against brute force."""
    rng = random.Random(3)
    docs = [(i, "".join(rng.choices("abc \n", k=rng.randint(0, 300)))) for i in range(70)] + [(70, "x &lt;b&gt; y"), (71, None), (72, "é😀 ü" * 30)]
    items = []
    for i in range(90):
        text = docs[rng.randrange(70)][1]
        at = rng.randrange(len(text) + 1)
        items.append((i, text[at : at + rng.choice([1, 2, 3, 7, 20, 63, 64, 100])]))
    items += [(90, ""), (91, "<b>"), (92, "é 😀ü"), (93, "nowhere"), (94, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    bare = lambda t: re.sub(r"\s+", "", t)
    texts = [(bare(t), bare(t).replace("&lt;", "<").replace("&gt;", ">")) for _, t in docs if t is not None]
    want = {i: 0 if t is None else sum(bare(t) in a or bare(t) in b for a, b in texts) for i, t in items}
    got = {r.item_id: r.documents for r in evidence.j12_span_verify_all(spark, str(tmp_path)).collect()}
    assert got == want and sum(n > 0 for i, n in want.items() if i >= 40) > 40


def test_absence(spark):
    f = spark.createDataFrame([("a", ["2020", "x", "2019", "2020"], 200, "available"), ("b", None, 404, "failed"), ("c", None, 500, "failed")], "entity_id string, years array<string>, status int, state string")
    got = {(r.entity_id, r.field): (r.value, r.availability) for r in normalise.filing_years(f).collect()}
    assert got == {("a", "accounts_filing_years"): ('["2019","2020"]', "available"), ("a", "first_filing_year"): ("2019", "available"), ("a", "filings_on_file"): ("2", "available"), ("b", "accounts_filing_years"): (None, "not_available"), ("c", "accounts_filing_years"): (None, "failed")}
    skipped = normalise.filing_years(f, max_batch=10, batch_size=11).collect()
    assert all(r.note.startswith("not checked this run") and r.availability == "not_available" for r in skipped)


def test_site_audit_and_verification(spark):
    pub = spark.createDataFrame([("a", 1, "Org 1"), ("b", 2, "gone"), ("c", 3, "x")], "entity_id string, page_id long, claim_span string")
    ver = spark.createDataFrame([("a", 1, "exact", ["org_number_on_page"], "the Org 1 text", True), ("b", 2, "review", ["page_lists_many_companies"], "text", False)], "entity_id string, page_id long, status string, reasons array<string>, text string, brand_shared boolean")
    got = sorted((r.entity_id, r.problem) for r in quality.site_audit(pub, ver).collect())
    assert got == [("b", "a listing"), ("b", "brand"), ("b", "not exact now"), ("b", "span not on page"), ("c", "page gone")]
    said = synth.verification(spark.createDataFrame([("a", ["legal_name_and_registered_address", "postcode_with_city:8006 bodo"])], "entity_id string, reasons array<string>")).first().text
    assert said == "Verified because the page writes the legal name and the registered address and postcode with city 8006 bodo."


def test_documents_for_every_id(spark):
    ids = spark.createDataFrame([(0, "a"), (1, "b")], "pos long, id string")
    claims = spark.createDataFrame([("a", "c-1", "identity", "legal_name", "A", "available")], "entity_id string, claim_id string, section string, field string, value string, availability string")
    states = spark.createDataFrame([("a", "identity", "available"), ("a", "web", "failed")], "entity_id string, section string, state string")
    none = spark.createDataFrame([], "entity_id string, field string, change_type string, materiality string")
    text = spark.createDataFrame([("a", "A.")], "entity_id string, what string")
    got = {r.entity_id: r.terminal_status for r in synth.profile_document(ids, claims, states, none, text).collect()}
    assert got == {"a": "completed_with_errors", "b": "failed"}


def test_ranges_do_not_change_running_totals(spark):
    rows = spark.range(500).select("id", (F.col("id") % 7).alias("v"))
    for parts in (1, 3, 16):
        got = {r.id: r.before for r in rollup.running_total(rows.repartition(5), ["id"], "v", parts).collect()}
        assert all(got[i] == sum(k % 7 for k in range(i)) for i in (0, 1, 250, 499))


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(1000)
    a = [r.id for r in rank.stable_sample(df, "id", 20, 1).collect()]
    assert a == [r.id for r in rank.stable_sample(df.repartition(9), "id", 20, 1).collect()]
    assert a != [r.id for r in rank.stable_sample(df, "id", 20, 2).collect()]


def test_replay_gives_nothing_new(spark, tmp_path):
    rows = [[("e", 1, "name", "A"), ("e", 1, "city", "X")], [("e", 2, "name", "B")], [("e", 1, "name", "A"), ("e", 1, "city", "X")], [("e", 2, "name", "B")]]
    schema = "entity_id string, run long, field string, value string"
    for i, part in enumerate(rows):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"b{i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    got = []
    q = feeds.change_stream(stream).writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True)
    q.foreachBatch(lambda df, _: got.extend((r.run, r.field, r.change_type) for r in df.collect())).start().awaitTermination()
    # whichever file comes first is the baseline; no change is told twice
    assert len(got) == len(set(got)) and set(got) <= {(2, "name", "changed"), (2, "city", "removed")}


def test_evidence_that_is_named_has_to_exist(spark):
    claims = spark.createDataFrame([("123456789", "c-1", "identity", "f", "available", 1.0, ["e-1"]), ("123456789", "c-2", "identity", "f", "available", 1.0, ["e-9"]), ("123456789", "c-3", "identity", "f", "failed", 1.0, [])], "entity_id string, claim_id string, section string, field string, availability string, confidence double, evidence_ids array<string>")
    evidence = spark.createDataFrame([("123456789", "e-1", "u", "company_owned", "t", "s", "m")], "entity_id string, evidence_id string, source_url string, source_class string, retrieved_at string, claim_span string, extraction_method string")
    got = quality.validate_tables({"claims": claims, "evidence": evidence}).collect()
    assert [r.row for r in got] == ["c-2"] * len(got) and got
    assert quality.validate_tables({"evidence": evidence}).count() == 0


def test_run_report_percentiles(spark):
    """p50 and p95 off one range table: ties, one row, an even number of rows and none."""
    for ms in ([], [7], [1, 2], [5] * 40 + [9], [3, 1, 2, 2, 100, 8], list(range(200, 0, -1))):
        frame = spark.createDataFrame([(i, "ok", 1, 2, x) for i, x in enumerate(ms)], "entity_id long, status string, requests long, bytes long, elapsed_ms long")
        got = {r.metric: r.value for r in rollup.run_report(frame).collect()}
        s, n = sorted(ms), len(ms)
        assert got["p50_ms"] == ((s[(n - 1) // 2] + s[n // 2]) // 2 if ms else None)
        assert got.get("p95_ms") == (s[max(1, int(n * 0.95)) - 1] if ms else None) and ("p95_ms" in got) == bool(ms)
        assert rollup.kth(frame, "elapsed_ms", 1, 1, n + 1).count() == min(n, 1)
