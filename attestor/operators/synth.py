"""Synthesis: sentences, answers and documents out of available claims only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..schemas import SECTIONS
from .rank import top_n_per_entity

#: change type -> one, many. Fixed values; others read "n <type with spaces>(s)".
PHRASES = {"new_filing": ("new accounts filing", "new accounts filings"), "new_job": ("new job ad", "new job ads"), "closed_job": ("closed job ad", "closed job ads"), "availability_changed": ("availability change", "availability changes"), "new_registry_update": ("new registry update", "new registry updates")}
#: reason of a verdict -> why a site counts as verified.
REASONS = {
    "org_number_on_page": "the organisation number is printed on the page",
    "legal_name_and_registered_address": "the page writes the legal name and the registered address",
    "registry_linked_domain": "the domain is one that the registry holds for the company",
}
#: Standard questions, the column that answers, the fields whose claims it rests on. Fixed values.
QUESTIONS = (
    ("What does the company do?", "what", ("legal_name", "industry_code", "industry_label", "website_description")),
    ("Who leads it?", "leaders", ("role",)),
    ("How big is it?", "big", ("registry_employees", "revenue", "annual_result")),
    ("What did its latest accounts show?", "accounts", ("revenue", "annual_result", "reporting_period")),
    ("Is it growing?", "trend", ("accounts_prior_period", "revenue", "annual_result")),
    ("How long has it filed accounts?", "history", ("accounts_filing_years", "first_filing_year", "filings_on_file")),
    ("Where is it?", "place", ("business_address", "workplace", "site_location")),
    ("Is it hiring?", "hiring", ("active_job_count", "job_posting")),
    ("What is its website?", "website", ("official_website",)),
    ("What has happened recently?", "activity", ("news_item", "registry_update", "job_posting", "sitemap_lastmod")),
    ("What changed since the last run?", "what_changed", ()),
    ("Are there warning signs?", "risks", ("status_flags", "equity")),
)
#: What is said of a first run instead of its changes. Fixed value.
FIRST_RUN = "First run — there is no previous snapshot to compare."
NOT_ESTABLISHED = "The evidence does not establish this."


def pivoted(claims: DataFrame, fields: Sequence[str]) -> DataFrame:
    """First available value of each field, by claim_id, as columns."""
    ok = claims.where("availability = 'available'").where(F.col("field").isin(*fields))
    return ok.groupBy("entity_id").agg(*(F.min(F.when(F.col("field") == f, F.struct("claim_id", "value")))["value"].alias(f) for f in fields))


def risk_flags(flags: Column, equity: Column, currency: Column | None = None) -> Column:
    """Array of warnings."""
    on = lambda k: F.get_json_object(flags, f"$.{k}") == "true"
    money = X.money_text(equity, F.lit("NOK") if currency is None else currency)
    return F.array_compact(
        F.array(
            F.when(on("bankrupt"), F.lit("Marked as bankrupt.")),
            F.when(on("liquidating"), F.lit("Marked as being wound up.")),
            F.when(on("forced_liquidation"), F.lit("Marked as under forced liquidation.")),
            F.when(equity < 0, F.concat(F.lit("Equity is negative ("), money, F.lit(")."))),
        )
    )


def age(founded: Column, as_of: int) -> Column:
    return F.lit(as_of) - F.try_to_number(F.left(founded, F.lit(4)), F.lit("9999")).cast("int")


def _part(value: Column, k: str) -> Column:
    """A field of a JSON value as text, sought once; NULL where it is empty."""
    return X.let(F.trim(F.get_json_object(value, f"$.{k}")), lambda x: F.when(x != "", x))


def address_text(value: Column) -> Column:
    """An address claim as one line: an object's street, then postcode with city; the parts of a list; text as it is."""
    j = lambda k: _part(value, k)
    parts = F.concat_ws(", ", F.coalesce(j("street"), j("address")), F.nullif(F.concat_ws(" ", j("postcode"), j("city")), F.lit("")), j("country"))
    listed = F.array_join(F.filter(F.from_json(value, "array<string>"), lambda x: F.trim(x) != ""), ", ")
    return F.nullif(F.when(value.startswith("{"), parts).when(value.startswith("["), listed).otherwise(F.trim(value)), F.lit(""))


#: field -> how many of its claims are told by name. Fixed values.
TOLD = {"workplace": 4, "site_location": 5, "job_posting": 3}


def _told(claims: DataFrame) -> DataFrame:
    """(entity_id, workplace, site_location, job_posting): how many there are, and the first few by name, as (n, names)."""
    j = lambda k: _part(F.col("value"), k)
    city = F.initcap(F.coalesce(j("address.city"), F.when(~j("address").startswith("{"), j("address"))))
    where = {"workplace": (j("name"), city), "site_location": (F.coalesce(j("name"), j("address"), F.when(~F.col("value").startswith("{"), F.col("value"))), None), "job_posting": (j("title"), F.initcap(j("location")))}
    named = F.coalesce(*(F.when(F.col("field") == f, name if at is None else F.concat(name, F.coalesce(F.concat(F.lit(" ("), at, F.lit(")")), F.lit("")))) for f, (name, at) in where.items()))
    rows = claims.where("availability = 'available'").where(F.col("field").isin(*TOLD))
    rows = X.sealed(rows, *map(F.col, ("entity_id", "field", "claim_id")), named.alias("name")).where("name is not null")
    n = rows.groupBy("entity_id", "field").agg(F.count("*").alias("n"))
    few = top_n_per_entity(rows, ["entity_id", "field"], [F.char_length("claim_id"), F.col("claim_id"), F.col("name")], max(TOLD.values()))
    few = few.groupBy("entity_id", "field").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "name"))), lambda x: x["name"]).alias("names"))
    both = n.join(few, ["entity_id", "field"]).groupBy("entity_id")
    return both.agg(*(F.min(F.when(F.col("field") == f, F.struct("n", F.slice("names", 1, most).alias("names")))).alias(f) for f, most in TOLD.items()))


def _dated(claims: DataFrame) -> DataFrame:
    """(entity_id, dated): the newest of news, registry updates, job ads and the sitemap, and how many updates there were."""
    j = lambda k: _part(F.col("value"), k)
    f, say = F.col("field"), F.concat
    said = (
        F.when(f == "news_item", say(F.lit("news item “"), F.coalesce(j("title"), F.lit("untitled")), F.lit("”")))
        .when(f == "registry_update", say(F.lit("registry update ("), F.coalesce(j("change_type"), F.lit("unknown type")), F.lit(")")))
        .when(f == "job_posting", F.lit("job ad posted"))
        .when(f == "sitemap_lastmod", F.lit("sitemap update"))
    )
    day = F.left(F.when(f == "sitemap_lastmod", F.col("value")).when(f == "job_posting", j("date_posted")).otherwise(j("date")), F.lit(10))
    rows = claims.where("availability = 'available'").where(F.col("field").isin("news_item", "registry_update", "job_posting", "sitemap_lastmod"))
    rows = X.sealed(rows, *map(F.col, ("entity_id", "field")), day.alias("day"), said.alias("said")).where("said is not null and day is not null")
    update = F.when(f == "registry_update", F.col("day"))
    rows = rows.groupBy("entity_id").agg(F.max(F.struct("day", "said")).alias("newest"), F.count(update).alias("n"), F.max(update).alias("last_update"))
    latest = say(F.lit("Latest dated activity: "), "newest.said", F.lit(" on "), "newest.day", F.lit("."))
    updates = F.when(F.col("n") > 0, say(F.lit(" The registry recorded "), F.col("n").cast("string"), F.when(F.col("n") == 1, F.lit(" update event")).otherwise(F.lit(" update events")), F.lit(", the most recent on "), "last_update", F.lit(".")))
    return rows.select("entity_id", say(latest, F.coalesce(updates, F.lit(""))).alias("dated"))


def profile_text(claims: DataFrame, as_of: int) -> DataFrame:
    """One row of sentences per entity; what has no available claim is NULL."""
    fields = ["legal_name", "legal_form", "municipality", "industry_code", "industry_label", "registry_employees", "revenue", "annual_result", "equity", "status_flags", "founded", "official_website", "active_job_count", "reporting_period", "accounts_filing_years", "business_address", "registered_address", "careers_page_url"]
    p = pivoted(claims, fields)
    roles = claims.where("availability = 'available' and field = 'role'").select("entity_id", "claim_id", F.get_json_object("value", "$.role").alias("role"), F.get_json_object("value", "$.name").alias("name"))
    roles = roles.groupBy("entity_id", "role").agg(F.slice(F.sort_array(F.collect_list(F.struct("claim_id", "name")))["name"], 1, 6).alias("n"))
    roles = roles.groupBy("entity_id").agg(F.array_join(F.sort_array(F.collect_list(F.concat("role", F.lit(": "), X.spoken_list(F.col("n"))))), "; ").alias("leaders"))
    events = claims.where("availability = 'available' and effective_date is not null and section = 'activity'")
    events = events.groupBy("entity_id").agg(F.max("effective_date").alias("last"), F.count("*").alias("n_events"))
    p = p.join(roles, "entity_id", "left").join(events, "entity_id", "left").join(_trends(claims), "entity_id", "left")
    p = p.join(_told(claims), "entity_id", "left").join(_dated(claims), "entity_id", "left")
    years = F.array_sort(F.from_json("accounts_filing_years", "array<string>"))
    filed = F.when(F.size(years) == 1, F.concat(F.lit("One annual-account filing is on file, for "), years[0], F.lit("."))).when(
        F.size(years) > 1, F.concat(F.lit("Annual accounts are on file for "), F.size(years).cast("string"), F.lit(" years, "), years[0], F.lit(" to "), F.element_at(years, -1), F.lit("."))
    )
    number = lambda c: F.col(c).cast("double")
    kr = F.lit("NOK")
    amounts = F.array_compact(F.array(F.concat(F.lit("revenue of "), X.money_text(number("revenue"), kr)), F.concat(F.when(number("annual_result") < 0, F.lit("a loss of ")).otherwise(F.lit("a result of ")), X.money_text(F.abs(number("annual_result")), kr))))
    people = number("registry_employees").cast("int")
    jobs = number("active_job_count").cast("int")
    said = lambda *parts: F.nullif(F.concat_ws(" ", *parts), F.lit(""))
    counted = F.when(jobs == 0, F.lit("No active job ads.")).when(jobs == 1, F.lit("1 active job ad.")).otherwise(F.concat(jobs.cast("string"), F.lit(" active job ads.")))
    line = lambda c, label: F.concat(F.lit(f"{label} address: "), address_text(F.col(c)), F.lit("."))
    address = F.coalesce(line("business_address", "Business"), line("registered_address", "Registered"))
    many = lambda c: F.when(F.col(f"{c}.n") == 1, F.lit("")).otherwise(F.lit("s"))
    units = F.concat(F.lit("The registry lists "), F.col("workplace.n").cast("string"), F.lit(" sub-unit"), many("workplace"), F.lit(": "), X.spoken_list(F.col("workplace.names")), F.when(F.col("workplace.n") > TOLD["workplace"], F.lit(" and others.")).otherwise(F.lit(".")))
    places = F.concat(F.lit("The website names "), X.spoken_list(F.col("site_location.names")), F.lit(" as location"), many("site_location"), F.lit("."))
    return p.select(
        "entity_id",
        F.concat("legal_name", F.lit(" is a company"), F.coalesce(F.concat(F.lit(" in "), F.initcap("municipality")), F.lit("")), F.coalesce(F.concat(F.lit(" registered under "), F.nullif(F.concat_ws(" ", "industry_code", "industry_label"), F.lit(""))), F.lit("")), F.lit(".")).alias("what"),
        F.when(people == 0, F.lit("No employees.")).when(people == 1, F.lit("1 employee.")).otherwise(F.concat(people.cast("string"), F.lit(" employees."))).alias("size"),
        F.when(F.size(amounts) > 0, F.concat(F.lit("It filed "), X.spoken_list(amounts), F.lit("."))).alias("accounts"),
        said(counted, F.concat(F.lit("Open roles include "), X.spoken_list(F.col("job_posting.names")), F.lit(".")), F.concat(F.lit("Careers page: "), "careers_page_url", F.lit("."))).alias("hiring"),
        "leaders",
        F.coalesce(said(address, units, places), F.concat(F.lit("Based in "), F.initcap("municipality"), F.lit("."))).alias("place"),
        "trend",
        filed.alias("history"),
        F.col("official_website").alias("website"),
        F.coalesce("dated", F.concat(F.lit("Last event on "), "last", F.lit(" of "), F.col("n_events").cast("string"), F.lit("."))).alias("activity"),
        F.coalesce(F.nullif(F.array_join(risk_flags(F.col("status_flags"), number("equity")), " "), F.lit("")), F.when(F.col("status_flags").isNotNull(), F.lit("No flag is set."))).alias("risks"),
        age(F.col("founded"), as_of).alias("age"),
    )


def _trends(claims: DataFrame) -> DataFrame:
    """(entity_id, trend): revenue and result of the newest accounts against those of the period before, as one sentence."""
    ok = claims.where("availability = 'available'")
    j = lambda k: F.get_json_object("value", f"$.{k}")
    before = ok.where("field = 'accounts_prior_period'").groupBy("entity_id").agg(F.max(F.struct(j("reporting_period").alias("period"), j("revenue").cast("double").alias("revenue"), j("annual_result").cast("double").alias("annual_result"))).alias("b"))
    now = ok.where(F.col("field").isin("revenue", "annual_result", "reporting_period")).groupBy("entity_id").agg(
        *(F.max(F.when(F.col("field") == f, F.col("value"))).cast("double").alias(f) for f in ("revenue", "annual_result")), F.max(F.when(F.col("field") == "reporting_period", F.coalesce(F.get_json_object("value", "$.to"), X.period_end(F.col("value"))))).alias("period")
    )
    kr, text = F.lit("NOK"), F.concat
    year = lambda c: F.left(c, F.lit(4))

    def bit(field: str, label: str) -> Column:
        old, new = F.col(f"b.{field}"), F.col(field)
        pct = (new - old) / F.abs(old) * 100
        ends = text(F.lit(" "), X.money_text(old, kr), F.lit(" ("), year(X.period_end(F.col("b.period"))), F.lit(") to "), X.money_text(new, kr), F.lit(" ("), year(F.col("period")), F.lit(")"))
        moved = F.when((F.lit(field) == "annual_result") & ((new < 0) != (old < 0)), F.when(new > 0, F.lit(" moved from a loss to a profit,")).otherwise(F.lit(" moved from a profit to a loss,")))
        moved = F.coalesce(moved, F.when(pct >= 0.5, text(F.lit(" rose "), F.round(pct).cast("int").cast("string"), F.lit("% from"))).when(pct <= -0.5, text(F.lit(" fell "), F.round(F.abs(pct)).cast("int").cast("string"), F.lit("% from"))))
        flat = F.when(old != 0, text(F.lit(f"{label} was flat at about "), X.money_text(new, kr), F.lit(" between "), year(X.period_end(F.col("b.period"))), F.lit(" and "), year(F.col("period"))))
        return F.coalesce(text(F.lit(label), moved, ends), flat)

    bits = F.array_compact(F.array(bit("revenue", "revenue"), bit("annual_result", "annual result")))
    said = X.spoken_list(bits)
    return now.join(before, "entity_id").select("entity_id", F.when(F.size(bits) > 0, text(F.upper(F.left(said, F.lit(1))), F.substring(said, 2, 10_000), F.lit("."))).alias("trend"))


def what_changed(changes: DataFrame, entities: DataFrame) -> DataFrame:
    """entities(entity_id, baseline) -> one sentence: first run, no changes, or counts by type."""
    table = F.create_map(*(F.lit(x) for k, v in PHRASES.items() for x in (k, F"{v[0]}|{v[1]}")))
    said = F.coalesce(F.element_at(table, F.col("change_type")), F.concat(F.replace("change_type", F.lit("_"), F.lit(" ")), F.lit("|"), F.replace("change_type", F.lit("_"), F.lit(" ")), F.lit(" changes")))
    n = changes.groupBy("entity_id", "change_type").agg(F.count("*").alias("n"))
    one = F.concat(F.col("n").cast("string"), F.lit(" "), F.when(F.col("n") == 1, F.substring_index(said, "|", 1)).otherwise(F.substring_index(said, "|", -1)))
    text = n.select("entity_id", one.alias("t")).groupBy("entity_id").agg(F.array_join(F.sort_array(F.collect_list("t")), ", ").alias("t"))
    out = entities.join(text, "entity_id", "left")
    return out.select("entity_id", F.when(F.col("baseline"), F.lit("First run, no earlier snapshot.")).when(F.col("t").isNull(), F.lit("No changes since the last run.")).otherwise(F.concat(F.lit("Since the last run: "), "t", F.lit("."))).alias("text"))


def cannot_establish(claims: DataFrame, sections: Sequence[str] = SECTIONS) -> DataFrame:
    """T4: (entity_id, ord, text): each field and state without an available claim of the field, in order of sections."""
    ok = claims.where("availability = 'available'").select("entity_id", "field").distinct()
    rows = claims.where(~F.col("availability").isin("available", "not_applicable")).join(ok, ["entity_id", "field"], "left_anti")
    said = F.expr("case availability when 'not_available' then 'is on record' when 'blocked' then 'could be read: access was blocked' when 'ambiguous' then 'could be tied to this entity' else 'could be read this run' end")
    rows = rows.withColumn("ord", F.coalesce(F.array_position(F.array(*map(F.lit, sections)), F.col("section")).cast("int"), F.lit(99)))
    rows = rows.groupBy("entity_id", "field", "availability").agg(F.min(F.struct("ord", "note")).alias("f"))
    note = F.coalesce(F.concat(F.lit(" ("), F.rtrim("f.note", F.lit(".")), F.lit(")")), F.lit(""))
    return rows.select("entity_id", F.col("f.ord").alias("ord"), F.concat(F.lit("No "), F.replace("field", F.lit("_"), F.lit(" ")), F.lit(" "), said, note, F.lit(".")).alias("text"))


def answers(claims: DataFrame, text: DataFrame, questions: Sequence[tuple[str, str, Sequence[str]]] = QUESTIONS) -> DataFrame:
    """T5: every question for every entity of text: answer or a fixed sentence, ids of the claims and of their evidence, sorted.

    text is profile_text's rows, with what_changed and baseline (true: a first run) if the run before is known.
    """
    for c, kind in (("what_changed", "string"), ("baseline", "boolean")):
        if c not in text.columns:
            text = text.withColumn(c, F.lit(None).cast(kind))
    first = F.coalesce("baseline", F.lit(False))
    text = text.withColumn("big", F.coalesce("size", "accounts")).withColumn("what_changed", F.when(~first, F.col("what_changed")))
    q = F.explode(F.array(*(F.struct(F.lit(i).alias("ord"), F.lit(t).alias("question"), F.col(c).alias("answer"), F.array(*map(F.lit, f)).alias("fields")) for i, (t, c, f) in enumerate(questions))))
    rows = text.select("entity_id", first.alias("first_run"), q.alias("q")).select("entity_id", "first_run", "q.*")
    ok = claims.where("availability = 'available'").groupBy("entity_id", "field").agg(F.collect_set("claim_id").alias("c"), F.flatten(F.collect_list("evidence_ids")).alias("e"))
    used = rows.where("answer is not null").select("entity_id", "ord", F.explode("fields").alias("field")).join(ok, ["entity_id", "field"])
    used = used.groupBy("entity_id", "ord").agg(F.array_sort(F.flatten(F.collect_list("c"))).alias("claim_ids"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("e")))).alias("evidence_ids"))
    none = F.array().cast("array<string>")
    out = rows.drop("fields").join(used, ["entity_id", "ord"], "left")
    return out.select("entity_id", "ord", "question", F.col("answer").isNotNull().alias("answerable"), F.coalesce("answer", F.when(F.col("first_run") & F.col("question").startswith("What changed"), F.lit(FIRST_RUN)), F.lit(NOT_ESTABLISHED)).alias("answer"), F.coalesce("claim_ids", none).alias("claim_ids"), F.coalesce("evidence_ids", none).alias("evidence_ids"))


def verification(sites: DataFrame) -> DataFrame:
    """sites(entity_id, reasons) -> why the site counts as verified; NULL where no reason is known."""
    table = F.create_map(*(F.lit(x) for kv in REASONS.items() for x in kv))
    said = F.array_compact(F.transform("reasons", lambda r: F.element_at(table, r)))
    extra = F.transform(F.filter("reasons", lambda r: r.rlike("^(?:postcode_with_city|street_with_number|registry_(?:email|website)_domain):")), lambda r: F.regexp_replace(F.replace(r, F.lit("_"), F.lit(" ")), ":", " "))
    parts = F.concat(F.slice(said, 1, 2), F.slice(extra, 1, 2))
    return sites.select("entity_id", F.when(F.size(parts) > 0, F.concat(F.lit("Verified because "), X.spoken_list(parts), F.lit("."))).alias("text"))


def profile_document(ids: DataFrame, claims: DataFrame, states: DataFrame, changes: DataFrame, text: DataFrame) -> DataFrame:
    """One nested row per id(pos, id); an id whose tables are empty still gets a document, with status failed."""
    key = ids.select("pos", F.col("id").alias("entity_id"))
    c = claims.groupBy("entity_id").agg(F.sort_array(F.collect_list(F.struct("claim_id", "section", "field", "value", "availability"))).alias("claims"))
    s = states.groupBy("entity_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("section", "state")))).alias("sections"))
    d = changes.groupBy("entity_id").agg(F.sort_array(F.collect_list(F.struct("field", "change_type", "materiality"))).alias("changes"))
    out = key.join(c, "entity_id", "left").join(s, "entity_id", "left").join(d, "entity_id", "left").join(text, "entity_id", "left")
    status = F.when(F.col("claims").isNull() | (F.col("sections")["identity"] == "failed"), F.lit("failed")).when(F.array_contains(F.map_values("sections"), "failed"), F.lit("completed_with_errors")).otherwise(F.lit("completed"))
    return out.withColumn("terminal_status", status).withColumn("schema_version", F.lit("1.0"))
