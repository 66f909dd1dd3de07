"""Long tables of the engine: columns, enumerations and their order."""

from __future__ import annotations

#: Availability of a claim. Absence is one of these, never NULL or 0. Fixed values.
AVAILABLE, NOT_AVAILABLE, BLOCKED = "available", "not_available", "blocked"
NOT_APPLICABLE, AMBIGUOUS, FAILED = "not_applicable", "ambiguous", "failed"
STATES = (AVAILABLE, NOT_AVAILABLE, BLOCKED, NOT_APPLICABLE, AMBIGUOUS, FAILED)
#: Fixed values.
SECTIONS = ("identity", "accounts", "leadership", "workplaces", "web", "hiring", "activity")

SOURCE_CLASSES = (
    "official_registry", "official_accounts", "official_roles", "official_subunits", "official_updates", "company_owned", "official_job_board", "search_candidate",
)

CLAIM = (
    "entity_id string, claim_id string, section string, field string, value string, availability string, "
    "confidence double, evidence_ids array<string>, reporting_period string, effective_date string, note string"
)
EVIDENCE = (
    "entity_id string, evidence_id string, source_url string, source_class string, retrieved_at string, "
    "content_sha256 string, claim_span string, extraction_method string"
)
CHANGE = (
    "entity_id string, field string, change_type string, materiality string, previous_value string, current_value string, "
    "first_observed string, last_observed string"
)
ERROR = "entity_id string, stage string, source_url string, message string, availability string"

#: A note that starts so tells that a source was left out of this run, not that it had nothing.
NOT_CHECKED = "not checked this run"
