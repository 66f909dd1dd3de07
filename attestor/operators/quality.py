"""Data quality and audits: tables of problems, empty where all is well."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import SECTIONS, SOURCE_CLASSES, STATES
from .joins import attach_provenance, orphan_refs, two_run_compare


def validate_batch(ids: DataFrame, profile: DataFrame, expected: int) -> DataFrame:
    """Q1: ids(pos, id), profile(pos, entity_id) -> (problem, detail): duplicates, count, membership, order."""
    p = profile.select("pos", F.col("entity_id").alias("id"))
    dup = p.groupBy("id").count().where("count > 1").select(F.lit("duplicate id").alias("problem"), F.col("id").alias("detail"))
    n = p.agg(F.count("*").alias("n")).where(F.col("n") != expected).select(F.lit("count").alias("problem"), F.col("n").cast("string").alias("detail"))
    lost = ids.join(p, "id", "left_anti").select(F.lit("missing").alias("problem"), F.col("id").alias("detail"))
    extra = p.join(ids, "id", "left_anti").select(F.lit("unexpected").alias("problem"), F.col("id").alias("detail"))
    moved = p.join(ids.withColumnRenamed("pos", "want"), "id").where("pos <> want").select(F.lit("order").alias("problem"), F.col("id").alias("detail"))
    return dup.union(n).union(lost).union(extra).union(moved)


def validate_records(claims: DataFrame, evidence: DataFrame | None = None) -> DataFrame:
    """Q2: (entity_id, claim_id, problem), one row per broken rule."""
    rules = {
        "entity id": ~F.col("entity_id").rlike(r"^\d{9}$"),
        "state": ~F.col("availability").isin(*STATES),
        "confidence": ~F.col("confidence").between(0, 1),
        "field": F.coalesce("field", F.lit("")) == "",
        "value": F.expr("availability = 'available' and value is null"),
    }
    found = F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in rules.items())))
    out = claims.select("entity_id", "claim_id", F.explode(found).alias("problem"))
    return out if evidence is None else out.union(orphan_refs(claims, evidence).select("entity_id", "claim_id", "problem"))


#: Table -> the column that names its rows, columns that have to be filled, and columns with their allowed values. Fixed values.
RECORDS = {
    "claims": ("claim_id", ("claim_id", "section", "field", "availability", "confidence"), {"availability": STATES, "section": SECTIONS}),
    "evidence": ("evidence_id", ("evidence_id", "source_url", "source_class", "retrieved_at", "claim_span", "extraction_method"), {"source_class": SOURCE_CLASSES}),
    "changes": ("field", ("field", "change_type", "materiality", "first_observed", "last_observed"), {}),
    "errors": ("stage", ("stage", "message", "availability"), {}),
    "sections": ("section", ("section", "state"), {"section": SECTIONS, "state": STATES}),
    "runs": ("run_id", ("run_id", "started_at", "completed_at", "terminal_status", "agent_version"), {}),
    "operations": (None, ("requests", "runtime_ms", "third_party_cost_usd", "bytes", "budget_exhausted"), {}),
}


def validate_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Q2 over all tables of a batch, by the names of RECORDS: (entity_id, record, row, problem), one row a broken rule.

    Every row belongs to an id of nine digits and has its required columns; a column that a table lacks is missing in all of its
    rows. Enumerated columns hold one of their values. Confidence is between 0 and 1; an available claim names evidence, and
    where evidence is given, evidence that exists. Tables that aren't given aren't checked; no problems give no rows.
    """
    out = None
    for record, rows in tables.items():
        name, required, allowed = RECORDS[record]
        col = lambda c, rows=rows: F.col(c) if c in rows.columns else F.lit(None).cast("string")
        rules = [("bad entity_id", ~F.coalesce(F.col("entity_id").rlike(r"^\d{9}$"), F.lit(False)))]
        rules += [(f"missing {c}", col(c).isNull()) for c in required]
        rules += [(f"bad {c}", ~col(c).isin(*values)) for c, values in allowed.items()]
        if record == "claims":
            rules.append(("bad confidence", ~col("confidence").cast("double").between(0, 1)))
            if "evidence" not in tables:
                rules.append(("no evidence", F.expr("availability = 'available' and coalesce(size(evidence_ids), 0) < 1")))
        found = F.array_compact(F.array(*(F.when(bad, F.lit(problem)) for problem, bad in rules)))
        row = col(name).cast("string") if name else F.lit(None).cast("string")
        said = rows.select("entity_id", F.lit(record).alias("record"), row.alias("row"), F.explode(found).alias("problem"))
        out = said if out is None else out.union(said)
    if "claims" in tables and "evidence" in tables:
        lone = orphan_refs(tables["claims"], tables["evidence"])
        out = out.union(lone.select("entity_id", F.lit("claims"), F.col("claim_id"), "problem"))
    return out


def span_audit(verified: DataFrame) -> DataFrame:
    """Q3: spans checked and bad by extraction method, of span_verify_join's rows."""
    bad = F.count(F.when(F.col("verdict").isin("not_verbatim", "no_snapshot"), 1))
    return verified.where("verdict <> 'computed'").groupBy("extraction_method").agg(F.count("*").alias("checked"), bad.alias("bad"))


def site_audit(published: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Q4: published(entity_id, page_id, claim_span) checked against assess() and its page again -> (entity_id, problem).

    verdicts: entity_id, page_id, status, reasons, text, brand_shared.
    """
    rows = published.join(verdicts, ["entity_id", "page_id"], "left")
    names = lambda r: F.array_contains("reasons", r)
    rules = {
        "page gone": F.col("status").isNull(),
        "span not on page": ~F.contains("text", "claim_span"),
        "another number": names("name_match_but_other_org_number"),
        "another entity": names("title_names_another_entity") | names("page_belongs_to_another_company"),
        "a listing": names("page_lists_many_companies") | names("org_number_among_many"),
        "brand": ~F.col("brand_shared"),
        "not exact now": F.col("status") != "exact",
    }
    found = F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules.items())))
    return rows.select("entity_id", F.explode(found).alias("problem"))


#: Answers that an entity's document has at least. Fixed value.
ANSWERS = 10


def provenance_audit(claims: DataFrame, evidence: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """Q5: claims that already carry provenance columns: copies that differ from the first evidence, available ones without URL or time.

    With answers(entity_id, ...), also entities of claims with fewer than ANSWERS of them (claim_id null).
    """
    cols = ["source_url", "source_class", "retrieved_at", "content_sha256", "claim_span"]
    again = attach_provenance(claims.drop(*cols), evidence).select("entity_id", "claim_id", *(F.col(c).alias(f"_{c}") for c in cols))
    both = claims.join(again, ["entity_id", "claim_id"])
    same = F.lit(True)
    for c in cols:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    bare = F.expr("availability = 'available' and (source_url is null or retrieved_at is null)")
    found = F.array_compact(F.array(F.when(~same, F.lit("differs from evidence")), F.when(bare, F.lit("no url or time"))))
    out = both.select("entity_id", "claim_id", F.explode(found).alias("problem"))
    if answers is None:
        return out
    n = answers.groupBy("entity_id").agg(F.count("*").alias("n"))
    few = claims.select("entity_id").distinct().join(n, "entity_id", "left").where(F.coalesce("n", F.lit(0)) < ANSWERS)
    return out.union(few.select("entity_id", F.lit(None).cast("string"), F.lit("answers missing")))


#: How ids that only one run has are told among the fields. Fixed value.
MISSING = "missing in one run"


def determinism_report(a: DataFrame, b: DataFrame) -> DataFrame:
    """Q6: facts that only one of two runs has, by field, and the entities concerned; ids that one lacks are told as such."""
    return two_run_compare(a, b).groupBy(F.coalesce("field", F.lit(MISSING)).alias("field")).agg(F.count("*").alias("facts"), F.countDistinct("entity_id").alias("entities"))
