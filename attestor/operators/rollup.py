"""Aggregations: state roll-ups, counts of three values, reports, accounting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schemas import SECTIONS
from ..shared import stored
from .rank import top_n_per_entity

#: What a section says when no claim of it is available, most telling first; what isn't listed comes last. Fixed values.
PRIORITY = ("available", "ambiguous", "blocked", "not_available", "failed")


def state_rank(state: Column) -> Column:
    out = F.lit(len(PRIORITY))
    for i, s in reversed(list(enumerate(PRIORITY))):
        out = F.when(state == s, F.lit(i)).otherwise(out)
    return out


def section_state(claims: DataFrame, entities: DataFrame, sections: Sequence[str] = SECTIONS, default: str = "not_available") -> DataFrame:
    """A1: one state per entity and section from claims(entity_id, section, availability); default where there are none."""
    seen = claims.groupBy("entity_id", "section").agg(F.min(F.struct(state_rank(F.col("availability")).alias("r"), F.col("availability").alias("state"))).alias("s"))
    want = entities.select("entity_id").withColumn("section", F.explode(F.array(*map(F.lit, sections))))
    return want.join(seen, ["entity_id", "section"], "left").select("entity_id", "section", F.coalesce("s.state", F.lit(default)).alias("state"))


def hiring_override(states: DataFrame, claims: DataFrame) -> DataFrame:
    """A2: hiring that found nothing while its count failed has failed."""
    failed = claims.where("field = 'active_job_count' and availability = 'failed'").select("entity_id").distinct().withColumn("_f", F.lit(True))
    bad = (F.col("section") == "hiring") & (F.col("state") == "not_available") & F.col("_f").isNotNull()
    return states.join(failed, "entity_id", "left").withColumn("state", F.when(bad, F.lit("failed")).otherwise(F.col("state"))).drop("_f")


def terminal_status(states: DataFrame) -> DataFrame:
    """A3: failed if identity failed, completed_with_errors if another section did, else completed."""
    out = states.groupBy("entity_id").agg(F.bool_or(F.expr("section = 'identity' and state = 'failed'")).alias("i"), F.bool_or(F.expr("state = 'failed'")).alias("a"))
    return out.select("entity_id", F.when(F.col("i"), F.lit("failed")).when(F.col("a"), F.lit("completed_with_errors")).otherwise(F.lit("completed")).alias("status"))


def count_semantics(counts: DataFrame) -> DataFrame:
    """A4: counts(entity_id, accepted, unchecked, rejected) -> value, availability and note; an unread record is never a zero."""
    return counts.select(
        "entity_id",
        F.expr("if(unchecked > 0 and accepted = 0, null, accepted)").alias("value"),
        F.expr("if(unchecked > 0 and accepted = 0, 'failed', 'available')").alias("availability"),
        F.expr(
            "case when unchecked > 0 and accepted = 0 then concat(unchecked, ' unread, the count is unknown') "
            "when accepted = 0 then concat('none accepted, ', rejected, ' rejected') "
            "when unchecked > 0 then concat(accepted, ' confirmed, ', unchecked, ' unread: a floor') end"
        ).alias("note"),
    )


def run_report(profile: DataFrame, states: DataFrame | None = None, claims: DataFrame | None = None, changes: DataFrame | None = None) -> DataFrame:
    """A5: profile(entity_id, status, requests, bytes, elapsed_ms) -> (metric, value): counts by status, sums, p50, p95.

    p95 is the row at greatest(1, floor(0.95 n)), p50 the mean of the middle, cut to a whole number; both come from counts of
    values, so no task sees all of them. profile may also have cost_usd (the sum is given in hundredths of a cent), exhausted
    (true: a row exhausted:<id> of 1) and problems (validation problems, summed). states(section, state), claims(field, availability)
    and changes(change_type) add counts: section:<section>:<state>, field:<field> of available claims, change:<type>.
    """
    n = profile.count()
    sums = {"entities": F.count("*"), "requests": F.sum("requests"), "bytes": F.sum("bytes")}
    if "cost_usd" in profile.columns:
        sums["cost_usd_e4"] = F.round(F.sum("cost_usd") * 10_000)
    if "problems" in profile.columns:
        sums["validation_problems"] = F.sum("problems")
    one = profile.agg(*(v.cast("long").alias(k) for k, v in sums.items()))
    out = one.select(F.explode(F.array(*(F.struct(F.lit(k).alias("metric"), F.col(k).alias("value")) for k in sums))).alias("m")).select("m.*")
    places = {"low": max(1, (n + 1) // 2), "high": n // 2 + 1, "p95": max(1, int(n * 0.95))}
    ms = kth(profile, "elapsed_ms", *places.values()).agg(*(F.max(F.when(F.col("k") == k, F.col("elapsed_ms"))).alias(name) for name, k in places.items()))
    middle = F.floor((F.coalesce("low", "high") + F.coalesce("high", "low")) / 2).cast("long")
    shown = ms.select(F.explode(F.array(F.struct(F.lit("p50_ms").alias("metric"), middle.alias("value")), F.struct(F.lit("p95_ms").alias("metric"), F.col("p95").cast("long").alias("value")))).alias("m")).select("m.*")
    # an empty table has no 95th percentile, and a null middle
    out = out.union(shown if n else shown.where("metric = 'p50_ms'"))
    counted = lambda df, *name: df.groupBy(F.concat(*name).alias("metric")).agg(F.count("*").alias("value"))
    out = out.union(counted(profile, F.lit("status:"), F.col("status")))
    if "exhausted" in profile.columns:
        out = out.union(profile.where("exhausted").select(F.concat(F.lit("exhausted:"), F.col("entity_id").cast("string")), F.lit(1).cast("long")))
    if states is not None:
        out = out.union(counted(states, F.lit("section:"), F.col("section"), F.lit(":"), F.col("state")))
    if claims is not None:
        out = out.union(counted(claims.where("availability = 'available'"), F.lit("field:"), F.col("field")))
    if changes is not None:
        out = out.union(counted(changes, F.lit("change:"), F.col("change_type")))
    return out


def kth(df: DataFrame, col: str, *ks: int) -> DataFrame:
    """(k, value) of the k-th smallest values, for all ks by one pass: counts by value, then a running sum over distinct values in ranges."""
    counts = running_total(df.groupBy(col).agg(F.count("*").alias("n")), [col], "n")
    met = F.filter(F.array(*map(F.lit, dict.fromkeys(ks))), lambda k: (k > F.col("before")) & (k <= F.col("before") + F.col("n")))
    return counts.select(F.explode(met).alias("k"), col)


def running_total(df: DataFrame, order: Sequence[str], amount: str, partitions: int | None = None) -> DataFrame:
    """df with `before`: the sum of `amount` over all earlier rows of a total order, by two passes, never in one task.

    The rows are dealt to ranges, as many as the session shuffles to, and written with their range's number: the bounds of
    ranges are drawn from a sample, and both passes have to see the same ones.
    """
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(df.repartitionByRange(partitions, *order).withColumn("_p", F.spark_partition_id()), "ranges")
    # one row a range: as few as there are partitions
    sums = ranged.groupBy("_p").agg(F.sum(amount).alias("_s"))
    ahead = sums.select("_p", F.coalesce(F.sum("_s").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"))
    w = W.partitionBy("_p").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(amount).over(w), F.lit(0))
    return ranged.join(ahead, "_p").withColumn("before", inside + F.col("_ahead")).drop("_p", "_ahead")


def coverage_score(claims: DataFrame, families: DataFrame, n_entities: int) -> DataFrame:
    """Per field family the share of entities with an available claim (3 places) and the claims."""
    out = claims.where("availability = 'available'").join(families, "field").groupBy("family").agg(F.countDistinct("entity_id").alias("entities"), F.count("*").alias("claims"))
    return out.withColumn("coverage", F.round(F.col("entities") / F.lit(n_entities), 3))


def coverage_report(claims: DataFrame, evidence: DataFrame, profile: DataFrame) -> DataFrame:
    """A6, the rest: (metric, value) of claims(entity_id, claim_id, availability, evidence_ids), evidence(entity_id, evidence_id), profile(requests).

    Evidence completeness is the share of available claims that have evidence ids which all exist (4 places); then claims by
    state, and requests in all, on average (1 place) and at most.
    """
    refs = claims.select("entity_id", "claim_id", F.explode("evidence_ids").alias("evidence_id")).join(evidence.select("entity_id", "evidence_id").distinct(), ["entity_id", "evidence_id"], "left_anti")
    lost = refs.select("entity_id", "claim_id").distinct().withColumn("_lost", F.lit(True))
    ok = claims.where("availability = 'available'").join(lost, ["entity_id", "claim_id"], "left")
    bad = F.col("_lost").isNotNull() | (F.coalesce(F.size("evidence_ids"), F.lit(0)) < 1)
    done = ok.agg(F.round(1 - F.avg(bad.cast("int")), 4).alias("value")).select(F.lit("evidence_completeness").alias("metric"), "value")
    states = claims.groupBy(F.concat(F.lit("state:"), "availability").alias("metric")).agg(F.count("*").cast("double").alias("value"))
    r = profile.agg(F.sum("requests").cast("double").alias("t"), F.round(F.avg("requests"), 1).alias("a"), F.max("requests").cast("double").alias("m"))
    r = r.selectExpr("stack(3, 'requests_total', t, 'requests_mean', a, 'requests_max', m) as (metric, value)")
    return done.union(states).union(r)


def precision_recall(joined: DataFrame) -> DataFrame:
    """joined(predicted, expected, wrong) -> tp, fp, fn, wrong, precision and recall (3 places, NULL over nothing)."""
    yes = lambda c: F.sum(F.when(F.expr(c), 1).otherwise(0))
    out = joined.agg(
        yes("predicted is not null and predicted = expected").alias("tp"),
        yes("predicted is not null and (expected is null or predicted <> expected)").alias("fp"),
        yes("expected is not null and (predicted is null or predicted <> expected)").alias("fn"),
        yes("coalesce(wrong, false)").alias("wrong"),
    )
    return out.withColumns({"precision": F.expr("round(try_divide(tp, tp + fp), 3)"), "recall": F.expr("round(try_divide(tp, tp + fn), 3)")})


def directory_summary(claims: DataFrame, states: DataFrame, fields: Sequence[str] | Mapping[str, Sequence[str]], changes: DataFrame | None = None, leaders: Sequence[str] = ("role", "site_leader")) -> DataFrame:
    """One row per entity: newest value of each field, sections available, latest date, number of claims and of leaders.

    A field may stand for several (name -> aliases); the newest claim is by reporting_period, if there is such a column, then by
    effective_date. With changes, n_changes counts them.
    """
    groups = fields if isinstance(fields, Mapping) else {f: (f,) for f in fields}
    ok = F.col("availability") == "available"
    period = [F.coalesce("reporting_period", F.lit("")).alias("reporting_period")] if "reporting_period" in claims.columns else []
    newest = [F.max(F.when(ok & F.col("field").isin(*names), F.struct(*period, "effective_date", "value"))).alias(g) for g, names in groups.items()]
    out = claims.groupBy("entity_id").agg(*newest, F.max(F.when(ok, F.col("effective_date"))).alias("latest_date"), F.count(F.when(ok, 1)).alias("n_claims"), F.count(F.when(ok & F.col("field").isin(*leaders), 1)).alias("n_leaders"))
    cover = states.groupBy("entity_id").agg(F.count(F.when(F.col("state") == "available", 1)).alias("sections_available"))
    out = out.select("entity_id", *(F.col(f"{g}.value").alias(g) for g in groups), "latest_date", "n_claims", "n_leaders").join(cover, "entity_id", "left")
    if changes is None:
        return out
    n = changes.groupBy("entity_id").agg(F.count("*").alias("n_changes"))
    return out.join(n, "entity_id", "left").withColumn("n_changes", F.coalesce("n_changes", F.lit(0)))


def request_accounting(log: DataFrame) -> DataFrame:
    """Requests (attempts) and bytes per company; keys that start with _ are shared and count in the total row only."""
    sums = (F.sum("attempts").alias("requests"), F.sum("bytes").alias("bytes"))
    own = log.where(~F.col("company").startswith("_")).groupBy("company").agg(*sums)
    return own.union(log.agg(*sums).select(F.lit("total").alias("company"), "requests", "bytes"))


def error_class(error: Column, status: Column, blocked: Column, budget: Column) -> Column:
    """A10: what kept a fetch from succeeding."""
    e = F.lower(F.coalesce(error, F.lit("")))
    return (
        F.when(F.coalesce(blocked, F.lit(False)), F.lit("blocked"))
        .when(F.coalesce(budget, F.lit(False)), F.lit("budget"))
        .when(e.rlike("self.signed certificate in certificate chain"), F.lit("tls_intercepted"))
        .when(e.rlike("unable to get local issuer|incomplete chain"), F.lit("incomplete_chain"))
        .when(e.rlike("hostname mismatch|doesn't match"), F.lit("hostname_mismatch"))
        .when(e.rlike("certificate has expired"), F.lit("expired"))
        .when(status >= 400, F.concat(F.lit("http_"), status.cast("string")))
        .when(e != "", F.lit("network"))
    )


def error_taxonomy(log: DataFrame) -> DataFrame:
    """A10: failures by class and host."""
    rows = log.withColumn("class", error_class(F.col("error"), F.col("status"), F.col("blocked"), F.col("budget")))
    return rows.where("class is not null").groupBy("class", "host").agg(F.count("*").alias("n"))


def rate_limit_runs(log: DataFrame, bad: Column, trip: int = 3, cooldown_s: int = 90) -> DataFrame:
    """log(host, ts, seq) -> runs of at least `trip` bad answers on a host without another between, and their cooldown.

    Bad answers of a host with the same number of good ones before them are one run. The number is a prefix sum over ranges of
    the whole log, so a host with most of the log is many tasks' work.
    """
    rows = log.select("host", "ts", "seq", F.coalesce(bad, F.lit(False)).alias("bad"))
    rows = running_total(rows.withColumn("good", (~F.col("bad")).cast("int")), ["host", "ts", "seq"], "good")
    runs = rows.where("bad").groupBy("host", "before").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return runs.where(F.col("n") >= trip).select("host", "n", "first_ts", "last_ts", (F.col("last_ts") + F.expr(f"interval {cooldown_s} seconds")).alias("cooled_at"))


def budget_cap(plan: DataFrame, per_entity: int, total: int, order: Sequence[str]) -> DataFrame:
    """plan(entity_id, ...) with `verdict`: ok, entity_cap or total_cap in priority order; shared keys (_) have no entity cap.

    The last place that an entity's cap allows is found by a pruned ranking, and only for entities that have one. The total
    is a two-pass prefix sum over what the entity caps leave.
    """
    at = F.struct(*order)
    ranked = plan.where(~F.col("entity_id").startswith("_")).select("entity_id", *order)
    last = top_n_per_entity(ranked, ["entity_id"], [F.col(c) for c in order], per_entity).groupBy("entity_id").agg(F.max(at).alias("_last"))
    plan = plan.join(last, "entity_id", "left").withColumn("_in", F.coalesce(at <= F.col("_last"), F.col("entity_id").startswith("_")).cast("int")).drop("_last")
    plan = running_total(plan, order, "_in")
    verdict = F.when(F.col("_in") == 0, F.lit("entity_cap")).when(F.col("before") >= total, F.lit("total_cap")).otherwise(F.lit("ok"))
    return plan.withColumn("verdict", verdict).drop("_in", "before")


def role_grouping(roles: DataFrame, most: int = 6) -> DataFrame:
    """roles(entity_id, pos, role, name) -> first names of each role in order, and how many there are; only `most` are gathered."""
    key = ["entity_id", "role"]
    n = roles.groupBy(*key).agg(F.count("*").alias("n"))
    first = top_n_per_entity(roles.select(*key, "pos", "name"), key, [F.col("pos"), F.col("name")], most)
    names = first.groupBy(*key).agg(F.array_join(F.sort_array(F.collect_list(F.struct("rank", "name")))["name"], ", ").alias("holders"))
    return names.join(n, key).select(*key, "holders", "n")


def latest_activity(*items: DataFrame) -> DataFrame:
    """Union of (entity_id, date, text) -> newest item of each entity, later text among equals, and the number."""
    out = items[0]
    for more in items[1:]:
        out = out.unionByName(more)
    return out.groupBy("entity_id").agg(F.max(F.struct("date", "text")).alias("m"), F.count("*").alias("n_items")).select("entity_id", F.col("m.date").alias("date"), F.col("m.text").alias("text"), "n_items")


def facets(summary: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(facet, value, n) of each column."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in cols))).alias("f")
    return summary.select(pairs).groupBy("f.facet", "f.value").agg(F.count("*").alias("n"))


def directory_filter(
    summary: DataFrame, text: str = "", searched: Sequence[str] = (), form: str | None = None, municipality: str | None = None, has_website: bool = False, hiring: bool = False, sort: str | None = None, descending: bool = False
) -> DataFrame:
    """Rows of a directory(form, municipality, website, jobs, ...) that hold a text in one of the searched columns and pass the
    filters set; sorted by a column, nulls last either way."""
    out = summary
    if text:
        out = out.where(F.contains(F.lower(F.concat_ws(" ", *searched)), F.lit(text.lower())))
    for col, value in (("form", form), ("municipality", municipality)):
        if value is not None:
            out = out.where(F.col(col) == value)
    if has_website:
        out = out.where(F.coalesce("website", F.lit("")) != "")
    if hiring:
        out = out.where(F.col("jobs") > 0)
    return out if sort is None else out.orderBy(F.desc_nulls_last(sort) if descending else F.asc_nulls_last(sort))


def batch_manifest_stats(batch: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    """batch(id, website) -> rows, with website, SHA-256 of the sorted ids joined by newlines; eligible counts the universe's rows.

    The digest needs all ids in one place: it is meant for a batch's list of ids.
    """
    out = batch.agg(F.count("*").alias("selected"), F.count("website").alias("with_website"), F.sha2(F.array_join(F.sort_array(F.collect_list("id")), "\n"), 256).alias("ids_sha256"))
    return out if universe is None else out.crossJoin(universe.agg(F.count("*").alias("eligible")))


def web_fallback_state(probes: DataFrame) -> DataFrame:
    """probes(entity_id, origin, outcome) where no site is exact -> state and reason.

    outcome: blocked, unreachable or unproven; origin: registry or other. The registry's own site speaks first.
    """
    has = lambda c: F.coalesce(F.bool_or(F.expr(c)), F.lit(False))
    out = probes.groupBy("entity_id").agg(
        has("origin = 'registry' and outcome = 'blocked'").alias("b"),
        has("origin = 'registry' and outcome = 'unreachable'").alias("u"),
        has("origin = 'registry' and outcome = 'unproven'").alias("p"),
        F.bool_and(F.expr("outcome = 'unreachable'")).alias("all_u"),
    )
    state = F.expr("case when b then 'blocked' when u then 'failed' when p then 'ambiguous' when all_u then 'failed' else 'not_available' end")
    why = F.expr("case when b then 'registry site blocked' when u then 'registry site unreachable' when p then 'registry site unproven' when all_u then 'no candidate reachable' else 'no candidate proven' end")
    return out.select("entity_id", state.alias("state"), why.alias("reason"))
