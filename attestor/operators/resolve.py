"""Entity resolution: does a page belong to this legal entity? One CASE ladder over columns made once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X

#: Phrases of placeholder and parking pages, folded. Fixed values.
PARKED = (
    "domain is for sale", "domain for sale", "buy this domain", "this domain is parked", "domain parking", "parked domain", "domenet er til salgs",
    "dette domenet er til salgs", "kjop dette domenet", "domene til salgs", "hugedomains", "sedo.com", "dan.com", "afternic", "godaddy.com/domains",
    "her flytter snart en ny gjest", "webhotell er ikke satt opp", "this webpage is parked", "parked by", "domeneparkering", "parkert domene",
    "domain has been registered", "domenet er registrert", "coming soon - this domain", "hosted by one.com", "webhosting made simple",
    "welcome to nginx", "apache2 ubuntu default page", "default web site page", "site not configured", "nettsiden er under konstruksjon",
    "under construction", "parkeringsside", "er parkert", "the domain name is parked", "is registered, but the owner", "index of /",
    "directory listing for", "proudly served by litespeed web server",
)
#: What may stand between two words of a name on a page. Fixed value.
JOINT = r"(?:[\s\-]+(?:og|and|&)[\s\-]+|[\s\-]+)"


def _quoted(c: Column) -> Column:
    return F.regexp_replace(c, r"([^A-Za-z0-9 ])", r"\\$1")


def address_cues(addresses: Column, municipality: Column, name_words: Column) -> Column:
    """What of an entity's addresses(postcode, city, lines, municipality) may stand in a page's folded text.

    An array of (label, pattern, or_label, or_pattern). Written in the way of an address: postcode with town, street with
    number. A bare postcode, a street name and a place are listed too, but prove nothing; words of the name itself are no places.
    """
    none = F.lit(None).cast("string")
    cue = lambda label, pattern, other=none, instead=none: F.struct(label.alias("label"), pattern.alias("pattern"), other.alias("or_label"), instead.alias("or_pattern"))
    word = lambda c: F.concat(F.lit(r"\b"), _quoted(c), F.lit(r"\b"))

    def place(raw: Column) -> Column:
        p = F.trim(X.fold_ascii(raw))
        return cue(F.concat(F.lit("place:"), p), F.when((F.char_length(p) >= 3) & ~F.array_contains(name_words, p), word(p)))

    def line(raw: Column) -> Column:
        street = F.regexp_replace(X.squash(X.fold_ascii(raw)), "^[ ,]+|[ ,]+$", "")
        return cue(F.concat(F.when(street.rlike("[0-9]"), F.lit("street_with_number:")).otherwise(F.lit("street_name:")), street), F.when(F.char_length(street) >= 4, word(street)))

    def of(a: Column) -> Column:
        city = F.trim(X.fold_ascii(a["city"]))
        pc = F.when(a["postcode"].rlike(r"^\d{4}$"), a["postcode"])
        both = F.when(city != "", F.concat(F.lit("(?<![0-9])"), pc, F.lit(r"\s+"), _quoted(city), F.lit(r"\b")))
        post = cue(F.concat(F.lit("postcode_with_city:"), pc, F.lit(" "), city), both, F.concat(F.lit("postcode_bare:"), pc), F.concat(F.lit("(?<![0-9])"), pc, F.lit("(?![0-9])")))
        return F.concat(F.array(post), F.transform(F.coalesce(a["lines"], F.array().cast("array<string>")), line), F.transform(F.array(a["city"], a["municipality"]), place))

    return F.concat(F.flatten(F.transform(addresses, of)), F.array(place(municipality)))


_ADDRESSES = "array<struct<postcode:string,city:string,lines:array<string>,municipality:string>>"


def entity_facts(entities: DataFrame, *kept: str) -> DataFrame:
    """Once an entity: entities(entity_id, name, former_names, municipality, addresses, email, website) -> entity_id, name, e, kept.

    e holds its words, the patterns of its name and number, what its addresses may look like, and its filed domains.
    """
    f, none = F.col, F.array().cast("array<string>")
    phrase = lambda words: F.concat(F.lit(r"\b"), F.array_join(words, JOINT), F.lit(r"\b"))
    digits = F.regexp_replace(F.coalesce(f("entity_id").cast("string"), F.lit("")), "[^0-9]", "")
    d = entities.select("*", X.words(f("name")).alias("_all"), X.name_words(f("name")).alias("_want"), digits.alias("_digits"))
    d = d.withColumn("_raw", F.filter("_all", lambda t: ~t.isin(*X.LEGAL_FORMS)))
    several = F.size("_raw") >= 2
    longest = F.array_max(F.transform("_want", lambda t, i: F.struct(F.char_length(t).alias("n"), (-i).alias("i"), t.alias("t"))))["t"]
    site = F.lower(F.trim(F.coalesce("website", F.lit(""))))
    facts = F.struct(
        f("_want").alias("want"), f("_raw").alias("raw"), f("_digits").alias("digits"), X.number_pattern(f("_digits")).alias("number"), F.when(several, phrase(f("_raw"))).alias("phrase"),
        F.when(F.size("_all") > 0, phrase(f("_all"))).alias("full"), F.when(several, X.accented(f("_raw"), JOINT)).alias("phrase_in_text"), longest.alias("longest"), X.accented(F.array(longest), JOINT).alias("longest_in_text"),
        F.transform(F.coalesce("former_names", none), lambda n: F.array_sort(F.array_distinct(X.name_words(n)))).alias("former"),
        address_cues(F.coalesce("addresses", F.array().cast(_ADDRESSES)), f("municipality"), f("_want")).alias("cues"),
        X.email_domain(F.lower(F.trim(F.coalesce("email", F.lit(""))))).alias("mail"), F.nullif(X.fold_ascii(X.host(site)), F.lit("")).alias("site"),
    )
    return X.sealed(d, *map(F.col, ("entity_id", "name")), facts.alias("e"), *map(F.col, kept))


def parked(folded: Column) -> Column:
    """The first of the parked-domain marks that stands in a folded text."""
    return F.get(F.filter(F.array(*map(F.lit, PARKED)), lambda m: F.contains(folded, m)), F.lit(0))


def page_facts(pages: DataFrame, *kept: str) -> DataFrame:
    """Once a page: pages as parse_pages gives them -> page_id, url, p, kept.

    p holds the folded text, numbers and companies named in it, its words, and the places where the page names itself.
    """
    f, empty = F.col, F.lit("")
    none = F.array().cast("array<struct<label:string,text:string>>")
    host = F.coalesce(f("host"), X.host(f("url"))) if "host" in pages.columns else X.host(f("url"))
    d = pages.select(*kept, "page_id", "url", "text", "title", "site_name", "og_title", F.coalesce("positions", none).alias("_positions"), host.alias("_host"), X.fold_ascii(f("text")).alias("_folded"))
    said = F.array_join(F.transform("_positions", lambda p: p["text"]), " ")
    own = F.concat(F.lit(r"(?i)(?:www\.)?"), _quoted(f("_host")))
    d = d.withColumn("_identity", F.when(f("_host") != "", F.regexp_replace(said, own, F.lit(" "))).otherwise(said))
    named = lambda names: F.transform(names, lambda c: F.struct(c.alias("c"), X.name_words(c).alias("w")))
    titles = F.flatten(F.transform(F.array("title", "site_name", "og_title"), lambda t: X.company_names(F.coalesce(t, empty))))
    ld = F.transform(F.filter("_positions", lambda p: p["label"] == "json-ld"), lambda p: p["text"])
    vat = F.transform(F.regexp_extract_all(f("text"), F.lit(r"(?i)\bNO\s*(\d(?:[\s.]?\d){8})\s*MVA\b"), F.lit(1)), lambda x: F.regexp_replace(x, "[^0-9]", ""))
    facts = F.struct(
        f("text"), f("_folded").alias("folded"), f("_host").alias("host"), X.fold_ascii(f("_host")).alias("folded_host"), F.regexp_replace(X.fold_ascii(f("_host")), "[^a-z0-9]", "").alias("compact"),
        F.filter(X.labelled_numbers(f("text")), lambda n: F.char_length(n) == 9).alias("numbers"), vat.alias("vat"), X.let(f("_folded"), parked).alias("parked"),
        X.company_names(f("text")).alias("companies"), F.array_distinct(F.regexp_extract_all("_folded", F.lit("([a-z0-9]+)"), F.lit(1))).alias("body"),
        X.fold_ascii(f("_identity")).alias("identity"), F.array_distinct(X.words(f("_identity"))).alias("identity_words"), named(X.company_names(f("_identity"))).alias("identity_companies"), named(titles).alias("titled"),
        F.transform("_positions", lambda p: F.struct(p["text"].alias("text"), X.words(p["text"]).alias("w"))).alias("positions"),
        F.concat(F.array_compact(F.array("site_name")), ld, X.title_parts(f("title"))).alias("brands"),
        F.array_distinct(F.concat(ld, F.array_compact(F.array("site_name", "og_title")), X.title_parts(f("title")))).alias("aliases"),
    )
    return X.sealed(d, *map(F.col, kept), f("page_id"), f("url"), facts.alias("p"))


def assess(pairs: DataFrame) -> DataFrame:
    """R0 of pairs that carry the columns of an entity and of a parsed page side by side; see assess_facts.

    An entity or page that stands in many pairs is better prepared once, by entity_facts and page_facts, before the join.
    """
    own = ("former_names", "municipality", "addresses", "email", "website")
    keep = [c for c in pairs.columns if c in ("ord",)]
    rows = entity_facts(pairs.select("entity_id", "name", *own, F.struct(*(c for c in pairs.columns if c not in own)).alias("_page")), "_page")
    return assess_facts(page_facts(rows.select("entity_id", "name", "e", *(F.col(f"_page.{c}").alias(c) for c in pairs.columns if c not in (*own, "entity_id", "name"))), "entity_id", "name", "e", *keep))


def assess_facts(pairs: DataFrame) -> DataFrame:
    """Verdict of each candidate pair(entity_id, name, e, page_id, url, p, ...) of facts of entities and pages.

    Gives the pair's other columns, score, status, reasons, claim_span, public_brand, aliases, self_identified and n_words.
    The first step of the ladder that holds decides; only 0.9 and more is exact.
    """
    e, p = (lambda c: F.col(f"e.{c}")), (lambda c: F.col(f"p.{c}"))
    want, no = e("want"), F.lit(False)
    has = lambda text, pattern: F.coalesce(F.rlike(text, pattern), no)
    equal = lambda w: (F.size(F.array_except(w, want)) == 0) & (F.size(F.array_except(want, w)) == 0)
    wider = F.filter(p("titled"), lambda s: (F.size(F.array_except(want, s["w"])) == 0) & (F.size(F.array_except(s["w"], want)) > 0) & ~F.coalesce(F.array_contains(e("former"), F.array_sort(F.array_distinct(s["w"]))), no))
    cue = lambda c: F.when(has(p("folded"), c["pattern"]), c["label"]).when(has(p("folded"), c["or_pattern"]), c["or_label"])
    site = F.array_compact(F.array(
        F.when(e("mail") == F.substring_index(p("folded_host"), ".", -2), F.concat(F.lit("registry_email_domain:"), e("mail"))),
        F.when(e("site") == p("folded_host"), F.concat(F.lit("registry_website_domain:"), e("site"))),
    ))
    best = F.array_max(F.transform(p("positions"), lambda x, i: F.struct(F.size(F.array_intersect(x["w"], want)).alias("n"), (-F.char_length(x["text"])).alias("l"), (-i).alias("i"), x["text"].alias("text"), x["w"].alias("w"))))
    d = pairs.withColumns(
        {
            "_in_id": (F.size(want) > 0) & (F.size(F.array_except(want, p("identity_words"))) == 0),
            "_phrase_id": has(p("identity"), e("phrase")),
            "_phrase_body": has(p("folded"), e("phrase")),
            "_full": has(p("folded"), e("full")),
            "_found": F.regexp_substr(p("text"), e("number")),
            "_others": F.filter(p("numbers"), lambda n: n != e("digits")),
            "_labelled": F.array_contains(p("numbers"), e("digits")) | F.array_contains(p("vat"), e("digits")),
            "_another": F.when((F.size(want) > 0) & ~F.exists(p("titled"), lambda s: equal(s["w"])), F.get(wider, F.lit(0))["c"]),
            "_stranger": F.when(F.size(want) > 0, F.get(F.filter(p("identity_companies"), lambda c: ~F.arrays_overlap(c["w"], want)), F.lit(0))["c"]),
            "_hinted": F.size(F.filter(want, lambda t: F.array_contains(p("body"), t) | ((F.char_length(t) >= 4) & F.contains(p("compact"), t)))),
            "_whole": (F.size(want) > 0) & (F.size(F.array_except(want, p("body"))) == 0),
            "_corr": F.array_distinct(F.array_compact(F.transform(e("cues"), cue))),
            "_linked": site,
            "_best": best,
        }
    )
    f, text = F.col, p("text")
    d = d.withColumn("_self", f("_in_id") | f("_phrase_id"))
    strong = F.exists("_corr", lambda c: c.rlike("^(?:postcode_with_city|street_with_number):"))
    word = F.get(e("raw"), F.lit(0))
    one_word = (F.size(e("raw")) == 1) & f("_self") & (F.char_length(word) >= 6) & ~word.isin(*X.GENERIC_WORDS)
    exact = f("_phrase_id") | f("_phrase_body") | f("_full") | one_word
    n_others, self_id = F.size("_others"), f("_self")
    detail = F.when(self_id, F.lit("self_identified")).when(f("_labelled"), F.lit("labelled")).otherwise(F.lit("bare_digits"))
    corr = F.array_sort(F.array_distinct(F.concat("_corr", "_linked")))
    hits = lambda *parts: F.array_compact(F.array(*(x if isinstance(x, Column) else F.lit(x) for x in parts)))
    # The proof is a window of the page itself. Around the name: the place that says most of it, cut from the text if it isn't there as it stands.
    said = F.left(X.squash(F.coalesce("_best.text", F.lit(""))), F.lit(300))
    said = F.when(F.size(want) > 0, F.when(F.coalesce(F.arrays_overlap(want, f("_best.w")), no), said).otherwise(X.excerpt(text, e("longest"), 110))).otherwise(said)
    said = F.when(f("_phrase_body") & ~f("_phrase_id"), X.excerpt(text, F.array_join(e("raw"), " "), 140)).otherwise(said)
    cut = F.coalesce(
        F.nullif(X.excerpt_match(text, e("phrase_in_text")), F.lit("")), F.nullif(X.excerpt_match(text, e("longest_in_text")), F.lit("")), F.left(X.squash(F.left(text, F.lit(200))), F.lit(200))
    )
    d = d.withColumn("_said", said)
    span = F.when((f("_said") != "") & ~F.contains(text, f("_said")), cut).otherwise(f("_said"))
    result = lambda score, reasons, span: F.struct(F.lit(score).alias("score"), reasons.alias("reasons"), span.alias("span"))
    at = lambda needle, width: X.excerpt(text, needle, width)
    ladder = (
        F.when(p("parked").isNotNull(), result(0.1, hits("parked"), at(p("parked"), 80)))
        .when(f("_found").isNotNull() & (n_others >= 2) & ~self_id, result(0.8, hits("org_number_among_many", F.concat(F.lit("other_org_numbers:"), n_others.cast("string"))), at(f("_found"), 80)))
        .when(f("_found").isNotNull(), result(1.0, hits("org_number_on_page", F.concat(F.lit("org_number:"), detail), F.when(n_others > 0, F.concat(F.lit("other_org_numbers:"), n_others.cast("string")))), at(f("_found"), 80)))
        .when(n_others > 0, result(0.8, hits("name_match_but_other_org_number", F.concat(F.lit("page_states:"), F.get("_others", F.lit(0)))), at(F.get("_others", F.lit(0)), 90)))
        .when(f("_another").isNotNull(), result(0.8, hits("title_names_another_entity", F.concat(F.lit("page_is:"), f("_another"))), at(f("_another"), 120)))
        .when(f("_stranger").isNotNull() & ~self_id, result(0.8, hits("page_belongs_to_another_company", F.concat(F.lit("page_is:"), f("_stranger"))), at(f("_stranger"), 120)))
        .when((F.size(p("companies")) >= 3) & ~self_id, result(0.8, hits("page_lists_many_companies", F.concat(F.lit("companies_named:"), F.size(p("companies")).cast("string"))), at(F.get(p("companies"), F.lit(0)), 120)))
        .when(~f("_whole") & (f("_hinted") > 0), result(0.3, hits("name_partial", F.concat(F.lit("tokens:"), f("_hinted").cast("string"), F.lit("/"), F.size(want).cast("string"))), span))
        .when(~f("_whole"), result(0.3, hits("name_not_found"), span))
        .when(exact & strong, result(0.95, F.concat(hits("legal_name_and_registered_address"), corr), span))
        .when(F.size("_linked") > 0, result(0.95, F.concat(hits("registry_linked_domain"), corr), span))
        .when(self_id | f("_phrase_body"), result(0.8, F.concat(hits("name_only"), corr), span))
        .otherwise(result(0.8, F.concat(hits("name_mentioned_only"), corr), span))
    )
    keep = [c for c in pairs.columns if c not in ("e", "p")]
    d = X.sealed(d, *map(F.col, keep), ladder.alias("_r"), X.brand(p("brands"), want).alias("public_brand"), F.filter(p("aliases"), lambda a: (F.char_length(a) <= 80) & F.arrays_overlap(X.words(a), want)).alias("_aliases"), f("_self").alias("self_identified"), F.size(want).alias("n_words"))
    status = F.when(f("_r.score") >= 0.9, F.lit("exact")).when(f("_r.score") >= 0.8, F.lit("review")).otherwise(F.lit("related_or_uncertain"))
    aliases = F.slice(F.filter("_aliases", lambda a: ~a.eqNullSafe(f("public_brand"))), 1, 5)
    return d.select(*keep, f("_r.score").alias("score"), status.alias("status"), f("_r.reasons").alias("reasons"), f("_r.span").alias("claim_span"), "public_brand", aliases.alias("aliases"), "self_identified", "n_words")


def mention_scan(parsed: DataFrame) -> DataFrame:
    """(page_id, kind, value): labelled numbers and company names of each page."""
    both = F.concat(F.transform(X.labelled_numbers(F.col("text")), lambda n: F.struct(F.lit("number").alias("kind"), n.alias("value"))), F.transform(X.company_names(F.col("text")), lambda n: F.struct(F.lit("company").alias("kind"), n.alias("value"))))
    return parsed.select("page_id", F.explode(both).alias("m")).select("page_id", "m.*")
