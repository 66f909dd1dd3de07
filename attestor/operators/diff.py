"""Change detection between two sets of claims: one full outer join on the claim's key, and rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..schemas import NOT_CHECKED
from ..shared import stored

#: field -> change type, by how a field is compared. Fixed values.
ADDED = {"job_posting": "new_job", "role": "new_role", "social_profile": "new_social_profile", "workplace": "new_location", "site_location": "new_location", "news_item": "new_news", "registry_update": "new_registry_update"}
REMOVED = {"job_posting": "closed_job", "role": "removed_role", "workplace": "removed_location", "site_location": "removed_location"}
SCALAR = {
    "legal_name": "changed_name", "legal_form": "changed_legal_form", "business_address": "changed_address", "registered_address": "changed_address",
    "status_flags": "changed_status", "registry_website": "changed_registry_website", "registry_employees": "changed_employee_count",
    "industry_code": "changed_industry", "public_brand": "changed_brand", "website_description": "changed_description",
}
MONEY = ("revenue", "operating_result", "profit_before_tax", "annual_result", "total_assets", "equity", "total_debt")
FILINGS = ("reporting_period", "accounts_history", "accounts_filing_years", "latest_submitted_accounts_year")
MATERIAL = (
    "new_filing", "changed_financials", "new_website", "changed_website", "new_role", "removed_role", "new_job", "closed_job", "new_location",
    "removed_location", "changed_name", "changed_legal_form", "changed_address", "changed_status", "changed_registry_website", "changed_industry",
)


def _lookup(table: dict[str, str], c: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), c)


def claim_key(value: Column) -> Column:
    """What makes two claims of a field the same one; value is text or a JSON object."""
    j = lambda k: F.nullif(F.get_json_object(value, f"$.{k}"), F.lit(""))
    role = F.coalesce(j("role_code"), j("role"))
    return (
        F.when(value.rlike("^https?://"), X.norm_url(value))
        .when(~value.startswith("{"), F.lit(""))
        .when(j("url").isNotNull(), X.norm_url(j("url")))
        .when(j("name").isNotNull() & role.isNotNull(), F.concat_ws("|", X.canonical(j("name")), X.canonical(role)))
        .when(j("platform").isNotNull(), X.canonical(j("platform")))
        .when(j("date").isNotNull() & j("change_type").isNotNull(), F.concat_ws("|", j("date"), j("change_type")))
        .when(j("name").isNotNull(), X.canonical(j("name")))
        .otherwise(X.sorted_object(value))
    )


def _newest_end(value: Column) -> Column:
    """Largest period end in a JSON list or a single period."""
    items = F.when(value.startswith("["), F.from_json(value, "array<string>")).otherwise(F.array(value))
    single = F.coalesce(F.get_json_object(value, "$.to"), X.period_end(value))
    return F.when(value.startswith("{"), single).otherwise(F.array_max(F.transform(items, X.period_end)))


def _new_items(cur: Column, prev: Column) -> Column:
    parse = lambda c: F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))
    return F.array_except(parse(cur), parse(prev))


_OPTIONAL = {"evidence_ids": "array<string>", "run_started": "string", "run_completed": "string"}


_COLUMNS = ("entity_id", "ord", "field", "section", "value", "availability", "reporting_period", "note", "source", "observed")
#: Stands for the key of claims that hold nothing; no value has it.
_NOTHING = "\x00"


def _keyed(claims: DataFrame) -> DataFrame:
    """(entity_id, field, key, claim): each claim with what it is compared by; key and family are made once."""
    more = [F.col(c) if c in claims.columns else F.lit(None).cast(t).alias(c) for c, t in _OPTIONAL.items()]
    rows = claims.select(*_COLUMNS, *more).withColumn("value", F.coalesce("value", F.lit("")))
    family = F.when(F.col("source").isin("nav", "nav_feed"), F.lit("nav")).otherwise(F.col("source"))
    claim = F.struct("ord", "availability", "section", "note", "value", "reporting_period", F.coalesce("observed", "run_started").alias("observed"), F.coalesce("evidence_ids", F.array().cast("array<string>")).alias("evidence_ids"), "run_completed", family.alias("family"))
    key = F.when(F.col("availability") == "available", F.coalesce(claim_key(F.col("value")), F.lit(""))).otherwise(F.lit(_NOTHING))
    return X.sealed(rows, F.col("entity_id"), F.col("field"), key.alias("key"), claim.alias("claim"))


def diff_claims(prev: DataFrame, cur: DataFrame) -> DataFrame:
    """Changes between claims(entity_id, ord, field, section, value, availability, reporting_period, note, source, observed).

    ord is the claim's place in its document, observed when its evidence was read (text). evidence_ids (array), run_started and
    run_completed (text, of the claim's run) may be there too. Entities without any earlier claim are a baseline and give none.
    Columns: entity_id, field, change_type, materiality, previous_value, current_value, first_observed (of the earlier claim,
    else of the later one; its evidence's, else its run's start), last_observed (the later run's end), evidence_ids and
    previous_evidence_ids. Two tables are written on the way: one row a claim key with both sides, one row a field.
    """
    both = _keyed(prev).withColumn("side", F.lit("p")).union(_keyed(cur).withColumn("side", F.lit("c")))
    one = lambda side: F.min(F.when(F.col("side") == side, F.col("claim"))).alias(side)
    # one row a key, combined before the shuffle and spread by key: an entity with many items is not one task's work
    return _changes(both.groupBy("entity_id", "field", "key").agg(one("p"), one("c")))


_KEY = ("entity_id", "field", "key")


def save_run(claims: DataFrame, name: str, path: str | None = None, buckets: int = 64) -> None:
    """A run's claims as a table of the catalog, one row a key, bucketed and sorted by it; runs to compare take the same buckets."""
    rows = _keyed(claims).groupBy(*_KEY).agg(F.min("claim").alias("claim")).repartition(buckets, *_KEY)
    writer = rows.write.format("parquet").bucketBy(buckets, *_KEY).sortBy(*_KEY).mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def joined_runs(prev: DataFrame, cur: DataFrame) -> DataFrame:
    """(entity_id, field, key, p, c) of two saved runs: a full outer join that meets bucket by bucket, without a shuffle."""
    side = lambda t, name: t.select(*_KEY, F.col("claim").alias(name))
    return side(prev, "p").hint("merge").join(side(cur, "c"), list(_KEY), "full_outer")


def diff_runs(prev: DataFrame, cur: DataFrame) -> DataFrame:
    """D0 of two tables of save_run, the same as diff_claims of their claims."""
    return _changes(joined_runs(prev, cur))


def _changes(items: DataFrame) -> DataFrame:
    """The rules of D over (entity_id, field, key, p, c), one row a claim key with the earlier and the later claim."""
    items = stored(items.withColumn("key", F.nullif("key", F.lit(_NOTHING))), "diff-items")
    # one row a field: its first claim and its first available one on either side
    live_ = F.col("key").isNotNull()
    fields = items.groupBy("entity_id", "field").agg(
        F.min("p").alias("p"), F.min("c").alias("c"), F.min(F.when(live_, F.col("p"))).alias("pa"), F.min(F.when(live_, F.col("c"))).alias("ca"), F.collect_set(F.when(live_, F.col("c.family"))).alias("sources")
    )
    state = lambda first, available: F.when(F.col(available).isNotNull(), F.lit("available")).otherwise(F.col(f"{first}.availability"))
    fields = fields.withColumns({"ps": state("p", "pa"), "cs": state("c", "ca"), "section": F.coalesce("c.section", "p.section")})
    f, live = F.col("field"), (F.col("ps") == "available") & (F.col("cs") == "available")
    moved = ~F.col("pa.reporting_period").eqNullSafe(F.col("ca.reporting_period"))
    fresh = _new_items(F.col("ca.value"), F.col("pa.value"))
    more = F.size(fresh) > 0
    # Fields whose period advances, in a fixed order; an entity tells the first of them
    order = F.array_position(F.array(*map(F.lit, (*FILINGS, *sorted(MONEY)))), f).cast("int")
    listed = f.isin("accounts_history", "accounts_filing_years")
    advanced = F.when(listed, more).otherwise(F.lit(True))
    advanced &= F.coalesce(_newest_end(F.col("ca.value")), F.lit("")) > F.coalesce(_newest_end(F.col("pa.value")), F.lit(""))
    filed = F.coalesce(live & ((f.isin(*FILINGS) & advanced) | (f.isin(*MONEY) & moved)), F.lit(False))
    # Single values
    kind = (
        F.when(f == "website_description", F.when(F.col("pa.value") != F.col("ca.value"), F.lit("changed_description")))
        .when(f.isin(*SCALAR), F.when(X.canonical(F.col("pa.value")) != X.canonical(F.col("ca.value")), _lookup(SCALAR, f)))
        .when(f == "official_website", F.when(claim_key(F.col("pa.value")) != claim_key(F.col("ca.value")), F.lit("changed_website")))
        .when(f.isin(*MONEY), F.when(~moved & (F.col("pa.value") != F.col("ca.value")), F.lit("changed_financials")))
    )
    fields = stored(fields.withColumns({"filed": F.when(filed, order), "kind": F.when(live, kind), "fresh": fresh}), "diff-fields")
    # one row an entity: what its fields decide together
    entity = fields.groupBy("entity_id").agg(
        F.min("filed").alias("first_filed"),
        F.coalesce(F.bool_or(F.col("kind") == "changed_name"), F.lit(False)).alias("renamed"),
        F.coalesce(F.bool_or((f == "active_job_count") & (F.col("cs") == "available")), F.lit(False)).alias("counted"),
        F.bool_or(F.col("p").isNotNull()).alias("known"),
        F.max("c.run_completed").alias("last_observed"),
    )
    fields = fields.join(entity.where("known"), "entity_id")
    c_ok, gone, more = F.col("cs") == "available", F.col("ps") != "available", F.size("fresh") > 0
    site = (f == "official_website") & c_ok & F.col("pa").isNull()
    names = (f == "former_names") & c_ok & more & ~F.col("renamed")
    skipped = F.coalesce(F.col("c.note").startswith(NOT_CHECKED), F.lit(False))
    # a field that had nothing before has only new items now, so its gain is told by them; a rename tells the former name
    gained = c_ok & gone & ~f.isin(*FILINGS) & ~site & ~names & ~((f == "former_names") & F.col("renamed")) & ~(f.isin(*ADDED) & F.col("ca").isNotNull())
    null, empty = F.lit(None).cast("string"), F.array().cast("array<string>")

    def told(when: Column, kind: Column, before: Column, after: Column, old: str | None, new: str | None) -> Column:
        ids = lambda c: F.coalesce(F.col(f"{c}.evidence_ids"), empty) if c else empty
        seen = F.coalesce(*(F.col(f"{c}.observed") for c in (old, new) if c), F.col("last_observed"))
        return F.when(
            F.coalesce(when, F.lit(False)),
            F.struct(kind.alias("change_type"), before.alias("previous_value"), after.alias("current_value"), seen.alias("first_observed"), ids(new).alias("evidence_ids"), ids(old).alias("previous_evidence_ids")),
        )

    pv, cv = F.col("pa.value"), F.col("ca.value")
    money = lambda c: F.when(f.isin(*MONEY), F.to_json(F.struct(F.col(f"{c}.reporting_period").alias("reporting_period"), F.col(f"{c}.value").alias("value")))).otherwise(F.col(f"{c}.value"))
    listed_now = F.when(listed, F.to_json(F.struct(F.col("fresh").alias("new_periods")))).otherwise(money("ca"))
    said = F.array_compact(
        F.array(
            told(F.col("filed") == F.col("first_filed"), F.lit("new_filing"), money("pa"), listed_now, "pa", "ca"),
            told(F.col("kind").isNotNull(), F.col("kind"), pv, cv, "pa", "ca"),
            told(site, F.lit("new_website"), null, cv, None, "ca"),
            told(names, F.lit("changed_name"), pv, F.to_json(F.struct(F.col("fresh").alias("former_names_added"))), "pa", "ca"),
            # Availability lost, or gained without another change of the field
            told((F.col("ps") == "available") & (F.col("cs") != "available") & ~skipped, F.lit("availability_changed"), F.col("ps"), F.col("cs"), "p", "c"),
            told(gained, F.lit("availability_changed"), F.col("ps"), F.col("cs"), "p", "c"),
        )
    )
    single = fields.select("entity_id", "field", "section", "last_observed", F.explode(said).alias("t")).select("entity_id", "field", "section", "t.*", "last_observed")
    # Items of lists that only one side has
    lone = items.where(live_ & f.isin(*ADDED) & (F.col("p").isNull() | F.col("c").isNull()))
    lone = lone.join(fields.where(c_ok & f.isin(*ADDED)).select("entity_id", "field", "sources", "counted", "last_observed"), ["entity_id", "field"])
    source = F.col("p.family")
    vouched = source.isNull() | F.array_contains("sources", source) | ((f == "job_posting") & (source == "nav") & F.col("counted"))
    kind = F.when(F.col("p").isNull(), _lookup(ADDED, f)).when(vouched & f.isin(*REMOVED), _lookup(REMOVED, f))
    lone = lone.select("entity_id", "field", F.coalesce("c.section", "p.section").alias("section"), "last_observed", told(kind.isNotNull(), kind, F.col("p.value"), F.col("c.value"), "p", "c").alias("t"))
    out = single.unionByName(lone.where("t is not null").select("entity_id", "field", "section", "t.*", "last_observed"))
    material = F.col("change_type").isin(*MATERIAL) | ((F.col("change_type") == "availability_changed") & F.col("section").isin("web", "accounts"))
    return out.select("entity_id", "field", "change_type", F.when(material, F.lit("material")).otherwise(F.lit("minor")).alias("materiality"), "previous_value", "current_value", "first_observed", "last_observed", "evidence_ids", "previous_evidence_ids")


def changes_by_type(changes: DataFrame) -> DataFrame:
    return changes.groupBy("field", "change_type", "materiality").agg(F.count("*").alias("n"))
