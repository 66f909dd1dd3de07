"""Record normalisation: nested records to long claims."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Legal forms that need not file accounts. Fixed values.
NON_FILING = ("ENK", "PERS", "UTLA", "PK", "KIRK")
ABSENT = "field absent in the official record"

ADDRESS = "struct<adresse:array<string>,postnummer:string,poststed:string,kommune:string,kommunenummer:string,land:string,landkode:string>"
#: Schema of an entity record.
RECORD = (
    f"organisasjonsnummer string, navn string, organisasjonsform struct<kode:string,beskrivelse:string>, forretningsadresse {ADDRESS}, postadresse {ADDRESS}, "
    "naeringskode1 struct<kode:string,beskrivelse:string>, harRegistrertAntallAnsatte boolean, antallAnsatte int, registreringsdatoEnhetsregisteret string, "
    "stiftelsesdato string, registrertIMvaregisteret boolean, konkurs boolean, underAvvikling boolean, underTvangsavviklingEllerTvangsopplosning boolean, "
    "sisteInnsendteAarsregnskap string, vedtektsfestetFormaal array<string>, hjemmeside string, epostadresse string, telefon string, mobil string, historiskeNavn array<struct<navn:string>>"
)
FILING = (
    "entity_id string, regnskapsperiode struct<fraDato:string,tilDato:string>, valuta string, regnskapstype string, oppstillingsplan string, "
    "resultatregnskapResultat struct<aarsresultat:double,ordinaertResultatFoerSkattekostnad:double,driftsresultat:struct<driftsresultat:double,driftsinntekter:struct<sumDriftsinntekter:double>>>, "
    "egenkapitalGjeld struct<egenkapital:struct<sumEgenkapital:double>,gjeldOversikt:struct<sumGjeld:double>>, eiendeler struct<sumEiendeler:double>, "
    "regnkapsprinsipper struct<smaaForetak:boolean>, virksomhet struct<morselskap:boolean>, revisjon struct<ikkeRevidertAarsregnskap:boolean>"
)
ROLES = (
    "entity_id string, rollegrupper array<struct<sistEndret:string,roller:array<struct<type:struct<kode:string,beskrivelse:string>,fratraadt:boolean,"
    "person:struct<navn:struct<fornavn:string,mellomnavn:string,etternavn:string>,erDod:boolean>,enhet:struct<organisasjonsnummer:string,navn:array<string>>>>>>"
)
UNITS = (
    f"entity_id string, units array<struct<organisasjonsnummer:string,navn:string,beliggenhetsadresse:{ADDRESS},postadresse:{ADDRESS},antallAnsatte:int,"
    "harRegistrertAntallAnsatte:boolean,naeringskode1:struct<beskrivelse:string>,oppstartsdato:string,slettedato:string>>, total int"
)
CLAIM_COLS = ("entity_id", "section", "field", "value", "availability", "confidence", "reporting_period", "effective_date", "note")


def _claim(section: str, field: str, value: Column, *, confidence: float = 1.0, period: Column | None = None, date: Column | None = None, note: str | None = None, keep: Column | None = None) -> Column:
    """A claim struct under rule N0: no value means not_available; NULL where `keep` is false."""
    s, text = F.lit(None).cast("string"), value.cast("string")
    c = F.struct(
        F.lit(section).alias("section"), F.lit(field).alias("field"), text.alias("value"),
        F.when(text.isNull(), F.lit("not_available")).otherwise(F.lit("available")).alias("availability"), F.lit(confidence).alias("confidence"),
        (s if period is None else period).alias("reporting_period"), (s if date is None else date).alias("effective_date"),
        F.when(text.isNull(), F.lit(note or ABSENT)).alias("note"),
    )
    return c if keep is None else F.when(keep, c)


def _unpivot(df: DataFrame, entity: Column, claims: Sequence[Column]) -> DataFrame:
    rows = df.select(entity.alias("entity_id"), F.posexplode(F.array_compact(F.array(*claims))).alias("ord", "c"))
    return rows.select("entity_id", *(F.col(f"c.{c}").alias(c) for c in CLAIM_COLS[1:]))


def _address(c: str) -> Column:
    a = F.col(c)
    j = F.to_json(F.struct(F.nullif(F.array_join(a["adresse"], " "), F.lit("")).alias("street"), a["postnummer"].alias("postcode"), a["poststed"].alias("city"), a["kommune"].alias("municipality"), F.coalesce(a["landkode"], a["land"]).alias("country")))
    return F.when(a.isNotNull(), j)


def identity_claims(rec: DataFrame) -> DataFrame:
    """Claims of entity records (RECORD). Flags and VAT that a record does not carry are not_available, never false."""
    f = F.col
    flags = F.coalesce("konkurs", "underAvvikling", "underTvangsavviklingEllerTvangsopplosning").isNotNull()
    no = F.lit(False)
    status = F.to_json(F.struct(F.coalesce("konkurs", no).alias("bankrupt"), F.coalesce("underAvvikling", no).alias("liquidating"), F.coalesce("underTvangsavviklingEllerTvangsopplosning", no).alias("forced_liquidation")))
    some = lambda c: f(c).isNotNull() & (f(c) != "")
    area = F.when(f("forretningsadresse").isNotNull(), f("forretningsadresse.kommune")).otherwise(f("postadresse.kommune"))
    return _unpivot(
        rec,
        f("organisasjonsnummer"),
        [
            _claim("identity", "legal_name", f("navn")),
            _claim("identity", "legal_form", F.to_json(F.struct(f("organisasjonsform.kode").alias("code"), f("organisasjonsform.beskrivelse").alias("label")))),
            _claim("identity", "business_address", _address("forretningsadresse")),
            _claim("identity", "registered_address", _address("postadresse"), keep=f("postadresse").isNotNull()),
            _claim("identity", "municipality", area),
            _claim("identity", "industry_code", f("naeringskode1.kode")),
            _claim("identity", "industry_label", f("naeringskode1.beskrivelse")),
            _claim("identity", "registry_employees", F.when(f("harRegistrertAntallAnsatte"), f("antallAnsatte")), note="no registered employee count"),
            _claim("identity", "registration_date", f("registreringsdatoEnhetsregisteret"), date=f("registreringsdatoEnhetsregisteret")),
            _claim("identity", "founded", f("stiftelsesdato"), date=f("stiftelsesdato"), keep=some("stiftelsesdato")),
            _claim("identity", "vat_registered", f("registrertIMvaregisteret")),
            _claim("identity", "status_flags", F.when(flags, status)),
            _claim("identity", "latest_submitted_accounts_year", f("sisteInnsendteAarsregnskap"), keep=some("sisteInnsendteAarsregnskap")),
            _claim("identity", "stated_purpose", F.left(F.array_join("vedtektsfestetFormaal", " "), F.lit(500)), keep=F.size("vedtektsfestetFormaal") > 0),
            _claim("identity", "registry_website", F.nullif(f("hjemmeside"), F.lit("")), confidence=0.9, note="the registry lists no website"),
            *(_claim("identity", name, f(c), keep=some(c)) for c, name in (("epostadresse", "registry_email"), ("telefon", "registry_phone"), ("mobil", "registry_mobile"))),
            _claim("identity", "former_names", F.to_json(F.array_compact("historiskeNavn.navn")), keep=F.size("historiskeNavn") > 0),
        ],
    )


def identity_fallback(ids: DataFrame, rec: DataFrame, seed: DataFrame) -> DataFrame:
    """ids(entity_id, error) without a live record take the seed row's values at confidence 0.9; without one, a failed claim.

    seed: entity_id, name, legal_form, municipality, industry_code, industry_label, employees, website, bankrupt, liquidating.
    """
    gone = ids.join(rec.select(F.col("organisasjonsnummer").alias("entity_id")), "entity_id", "left_anti").join(seed.withColumn("_seed", F.lit(True)), "entity_id", "left")
    note = F.concat(F.lit("live record unavailable ("), F.coalesce("error", F.lit("absent")), F.lit("); values of the reference snapshot"))
    have = F.col("_seed").isNotNull()
    status = F.to_json(F.struct(F.coalesce("bankrupt", F.lit(False)).alias("bankrupt"), F.coalesce("liquidating", F.lit(False)).alias("liquidating")))
    fields = [("legal_name", F.nullif("name", F.lit("")), 0.9), ("legal_form", F.to_json(F.struct(F.col("legal_form").alias("code"))), 0.9), ("municipality", F.col("municipality"), 0.9), ("industry_code", F.col("industry_code"), 0.9), ("industry_label", F.col("industry_label"), 0.9), ("registry_employees", F.col("employees"), 0.9), ("status_flags", status, 0.9), ("registry_website", F.nullif("website", F.lit("")), 0.8)]
    out = _unpivot(gone.where(have), F.col("entity_id"), [_claim("identity", n, v, confidence=c) for n, v, c in fields])
    out = out.join(gone.select("entity_id", note.alias("_note")), "entity_id").withColumn("note", F.col("_note")).drop("_note")
    lost = gone.where(~have).select("entity_id", F.lit("identity").alias("section"), F.lit("legal_name").alias("field"), F.lit(None).cast("string").alias("value"), F.lit("failed").alias("availability"), F.lit(1.0).alias("confidence"), F.lit(None).cast("string").alias("reporting_period"), F.lit(None).cast("string").alias("effective_date"), note.alias("note"))
    return out.union(lost)


def _ranked(filings: DataFrame) -> DataFrame:
    w = W.partitionBy("entity_id").orderBy(F.desc_nulls_last("regnskapsperiode.tilDato"), F.desc_nulls_last("regnskapsperiode.fraDato"))
    return filings.withColumn("rank", F.row_number().over(w))


def _period() -> Column:
    return F.concat(F.coalesce("regnskapsperiode.fraDato", F.lit("None")), F.lit(".."), F.coalesce("regnskapsperiode.tilDato", F.lit("None")))


#: money field -> path in a filing. Fixed values.
MONEY = {
    "revenue": "resultatregnskapResultat.driftsresultat.driftsinntekter.sumDriftsinntekter",
    "operating_result": "resultatregnskapResultat.driftsresultat.driftsresultat",
    "profit_before_tax": "resultatregnskapResultat.ordinaertResultatFoerSkattekostnad",
    "annual_result": "resultatregnskapResultat.aarsresultat",
    "total_assets": "eiendeler.sumEiendeler",
    "equity": "egenkapitalGjeld.egenkapital.sumEgenkapital",
    "total_debt": "egenkapitalGjeld.gjeldOversikt.sumGjeld",
}


def accounts_claims(filings: DataFrame) -> DataFrame:
    """Claims of the newest filing (FILING): seven amounts, currency, period and type. An absent amount is not zero."""
    last, to = _ranked(filings).where("rank = 1"), F.col("regnskapsperiode.tilDato")
    kind = F.to_json(F.struct(F.col("regnskapstype").alias("type"), F.col("oppstillingsplan").alias("layout"), F.col("regnkapsprinsipper.smaaForetak").alias("small_company"), F.col("virksomhet.morselskap").alias("consolidated_parent"), (~F.coalesce("revisjon.ikkeRevidertAarsregnskap", F.lit(False))).alias("audited")))
    return _unpivot(
        last,
        F.col("entity_id"),
        [
            *(_claim("accounts", n, F.col(p), period=_period(), date=F.when(F.col(p).isNotNull(), to), note="absent from the filing (not zero)") for n, p in MONEY.items()),
            _claim("accounts", "currency", F.coalesce("valuta", F.lit("NOK")), period=_period()),
            _claim("accounts", "reporting_period", F.to_json(F.struct(F.col("regnskapsperiode.fraDato").alias("from"), to.alias("to"))), period=_period(), date=to),
            _claim("accounts", "accounts_type", kind, period=_period()),
        ],
    )


def prior_periods(filings: DataFrame, n: int = 3) -> DataFrame:
    """One claim for each of the n filings before the newest, and accounts_history: all periods, newest first."""
    ranked = _ranked(filings)
    value = F.to_json(F.struct(_period().alias("reporting_period"), *(F.col(p).alias(f) for f, p in MONEY.items() if f != "profit_before_tax"), F.coalesce("valuta", F.lit("NOK")).alias("currency")))
    prior = _unpivot(ranked.where(F.col("rank").between(2, n + 1)), F.col("entity_id"), [_claim("accounts", "accounts_prior_period", value, period=_period(), date=F.col("regnskapsperiode.tilDato"))])
    history = ranked.groupBy("entity_id").agg(F.to_json(F.sort_array(F.collect_list(F.struct("rank", _period().alias("p"))))["p"]).alias("v"))
    return prior.union(_unpivot(history, F.col("entity_id"), [_claim("accounts", "accounts_history", F.col("v"))]))


def accounts_absence(fetch: DataFrame) -> DataFrame:
    """fetch(entity_id, legal_form, status, ok, n_filings, state) without filings -> one revenue claim that says why."""
    state = (
        F.when((F.col("status") == 404) & F.col("legal_form").isin(*NON_FILING), F.lit("not_applicable"))
        .when((F.col("status") == 404) | (F.col("ok") & (F.col("n_filings") == 0)), F.lit("not_available"))
        .otherwise(F.col("state"))
    )
    rows = fetch.where("not ok or n_filings = 0")
    return rows.select("entity_id", F.lit("accounts").alias("section"), F.lit("revenue").alias("field"), F.lit(None).cast("string").alias("value"), state.alias("availability"))


def filing_years(years: DataFrame, max_batch: int | None = None, batch_size: int = 0) -> DataFrame:
    """years(entity_id, status, state, years) -> accounts_filing_years, first_filing_year, filings_on_file.

    Beyond max_batch entities the source is not read, and the claim says so.
    """
    from ..schemas import NOT_CHECKED

    f = F.col
    if max_batch is not None and batch_size > max_batch:
        return _unpivot(years, f("entity_id"), [_claim("accounts", "accounts_filing_years", F.lit(None), note=f"{NOT_CHECKED}: batch of {batch_size} over {max_batch}")])
    good = F.array_sort(F.array_distinct(F.filter(F.transform("years", lambda x: F.trim(x)), lambda y: y.rlike("^[0-9]+$"))))
    rows = years.withColumn("y", F.when(f("years").isNotNull(), good))
    some = F.coalesce(F.size("y"), F.lit(0)) > 0
    out = _unpivot(
        rows,
        f("entity_id"),
        [
            _claim("accounts", "accounts_filing_years", F.to_json("y")),
            _claim("accounts", "first_filing_year", F.get("y", F.lit(0)), date=F.concat(F.get("y", F.lit(0)), F.lit("-12-31")), keep=some),
            _claim("accounts", "filings_on_file", F.size("y"), keep=some),
        ],
    )
    why = rows.select("entity_id", F.when(f("years").isNull(), F.when(f("status") == 404, F.lit("not_available")).otherwise(f("state"))).alias("_why"))
    return out.join(why, "entity_id").withColumn("availability", F.coalesce("_why", "availability")).drop("_why")


def role_claims(rec: DataFrame) -> DataFrame:
    """ROLES -> a claim for each active holder with a name, and role_count, or one that says there is none. No birth dates."""
    g = rec.select("entity_id", F.posexplode_outer("rollegrupper").alias("gi", "g")).select("entity_id", "gi", F.col("g.sistEndret").alias("since"), F.posexplode_outer("g.roller").alias("ri", "r"))
    person = F.col("r.person").isNotNull()
    name = F.when(person, F.concat_ws(" ", "r.person.navn.fornavn", "r.person.navn.mellomnavn", "r.person.navn.etternavn")).otherwise(F.array_join("r.enhet.navn", " "))
    g = g.withColumn("name", F.nullif(F.trim(name), F.lit("")))
    on = ~F.coalesce("r.fratraadt", F.lit(False)) & ~F.coalesce("r.person.erDod", F.lit(False)) & F.col("name").isNotNull()
    value = F.to_json(F.struct("name", F.col("r.type.beskrivelse").alias("role"), F.col("r.type.kode").alias("role_code"), "since", F.when(~person, F.col("r.enhet.organisasjonsnummer")).alias("organisation_number"), F.when(person, F.lit("person")).otherwise(F.lit("entity")).alias("holder_type")))
    out = _unpivot(g.where(on), F.col("entity_id"), [_claim("leadership", "role", value, date=F.col("since"))])
    n = g.groupBy("entity_id").agg(F.count(F.when(on, 1)).alias("n"))
    count = _unpivot(n, F.col("entity_id"), [_claim("leadership", "role_count", F.col("n"), keep=F.col("n") > 0), _claim("leadership", "role", F.lit(None), note="no active public role holders", keep=F.col("n") == 0)])
    return out.union(count)


def workplace_claims(rec: DataFrame) -> DataFrame:
    """UNITS -> a claim for each unit not deleted, and their count; none is an available zero."""
    u = rec.withColumn("live", F.filter(F.coalesce("units", F.array()), lambda x: x["slettedato"].isNull()))
    one = u.select("entity_id", F.explode("live").alias("u"))
    a = F.coalesce("u.beliggenhetsadresse", "u.postadresse")
    address = F.struct(F.array_join(a["adresse"], " ").alias("street"), a["postnummer"].alias("postcode"), a["poststed"].alias("city"), a["kommune"].alias("municipality"))
    value = F.to_json(F.struct(F.col("u.organisasjonsnummer").alias("organisation_number"), F.col("u.navn").alias("name"), address.alias("address"), F.when(F.coalesce("u.harRegistrertAntallAnsatte", F.lit(True)), F.col("u.antallAnsatte")).alias("employees"), F.col("u.naeringskode1.beskrivelse").alias("industry"), F.col("u.oppstartsdato").alias("started")))
    out = _unpivot(one, F.col("entity_id"), [_claim("workplaces", "workplace", value, date=F.col("u.oppstartsdato"))])
    n = F.size("live")
    count = _unpivot(u, F.col("entity_id"), [_claim("workplaces", "workplace_count", n)]).join(u.select("entity_id", n.alias("_n"), "total"), "entity_id")
    note = F.when(F.col("_n") == 0, F.lit("checked: no registered subunits (zero, not missing)")).when(F.col("total") > F.col("_n"), F.concat("total", F.lit(" registered, "), "_n", F.lit(" read")))
    return out.union(count.withColumn("note", note).drop("_n", "total"))


def update_events(events: DataFrame, n: int = 20) -> DataFrame:
    """events(entity_id, event_id, at, change_type) -> the newest n as claims dated by their first ten characters."""
    w = W.partitionBy("entity_id").orderBy(F.desc("at"), F.desc("event_id"))
    rows = events.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    day = F.left(F.col("at").cast("string"), F.lit(10))
    return _unpivot(rows, F.col("entity_id"), [_claim("activity", "registry_update", F.to_json(F.struct(day.alias("date"), "change_type")), date=day)])


def job_ad_claims(ads: DataFrame, base: str = "https://jobs.example.org/ad/") -> DataFrame:
    """ads(entity_id, uuid, title, link, published, expires, city, municipal, employer, extent, positions) -> job claims; no contacts."""
    day = lambda c: F.nullif(F.left(F.coalesce(c, F.lit("")), F.lit(10)), F.lit(""))
    value = F.to_json(F.struct("title", F.coalesce("link", F.concat(F.lit(base), "uuid")).alias("url"), day("published").alias("date_posted"), day("expires").alias("valid_through"), F.coalesce("city", "municipal").alias("location"), F.col("employer").alias("employer_name"), "extent", "positions"))
    return _unpivot(ads, F.col("entity_id"), [_claim("hiring", "job_posting", value, date=day("published"))])


def merge_connectors(*claims: DataFrame) -> DataFrame:
    """Union of connectors' claims; columns one lacks are NULL."""
    out = claims[0]
    for more in claims[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def numbered(claims: DataFrame, prefix: str = "c", order: Sequence[str] = ("section", "field", "value")) -> DataFrame:
    """claim_id by entity and a stable order."""
    w = W.partitionBy("entity_id").orderBy(*order)
    return claims.withColumn("claim_id", F.concat(F.lit(f"{prefix}-"), F.row_number().over(w).cast("string")))
