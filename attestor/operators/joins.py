"""Joins: enrichment, provenance, names, hosts, gold labels, spans and run comparison."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from .rank import first_wins, symmetric_difference, top_n_per_entity


def seed_enrich(ids: DataFrame, seed: DataFrame, live: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Every id stays; a live value overrides the seed's; `origin` says which record there was."""
    s = seed.select(key, *(F.col(f).alias(f"_s_{f}") for f in fields), F.lit(True).alias("_s"))
    v = live.select(key, *(F.col(f).alias(f"_l_{f}") for f in fields), F.lit(True).alias("_l"))
    out = ids.select(key).join(s, key, "left").join(v, key, "left")
    origin = F.when(F.col("_l"), F.lit("live")).when(F.col("_s"), F.lit("seed")).otherwise(F.lit("none"))
    return out.select(key, *(F.coalesce(f"_l_{f}", f"_s_{f}").alias(f) for f in fields), origin.alias("origin"))


def attach_provenance(claims: DataFrame, evidence: DataFrame) -> DataFrame:
    """Each claim with source_url, source_class, retrieved_at, content_sha256 and claim_span of its first existing evidence id.

    Where rows share an evidence id, the least of them by these columns counts, whatever the partitions.
    """
    fields = ("source_url", "source_class", "retrieved_at", "content_sha256", "claim_span")
    refs = claims.select("entity_id", "claim_id", F.posexplode("evidence_ids").alias("pos", "evidence_id"))
    found = refs.join(evidence.select("entity_id", "evidence_id", F.struct(*fields).alias("e")), ["entity_id", "evidence_id"])
    first = found.groupBy("entity_id", "claim_id").agg(F.min(F.struct("pos", "e"))["e"].alias("e"))
    return claims.join(first, ["entity_id", "claim_id"], "left").select(*claims.columns, *(F.col(f"e.{f}").alias(f) for f in fields))


def orphan_refs(claims: DataFrame, evidence: DataFrame) -> DataFrame:
    """(entity_id, claim_id, evidence_id, problem): ids that do not exist, available claims without any."""
    refs = claims.select("entity_id", "claim_id", F.explode("evidence_ids").alias("evidence_id"))
    lost = refs.join(evidence.select("entity_id", "evidence_id").distinct(), ["entity_id", "evidence_id"], "left_anti").withColumn("problem", F.lit("missing evidence"))
    bare = claims.where("availability = 'available' and coalesce(size(evidence_ids), 0) < 1")
    bare = bare.select("entity_id", "claim_id", F.lit(None).cast("string").alias("evidence_id"), F.lit("no evidence").alias("problem"))
    return lost.select(*bare.columns).unionByName(bare)


def _by_rarest(few: DataFrame, keys: Column, many: DataFrame) -> DataFrame:
    """Rows of few joined with rows of many(k, ...) by that one of few's keys which the fewest rows of many have."""
    counts = many.groupBy("k").agg(F.count("*").alias("_n"))
    own = few.columns
    best = few.withColumn("k", F.explode(keys)).join(counts, "k").groupBy(*own).agg(F.min(F.struct("_n", "k"))["k"].alias("k"))
    return best.join(many, "k")


def name_candidates(entities: DataFrame, feed: DataFrame, top: int = 8, min_len: int = 6) -> DataFrame:
    """entities(entity_id, name) x feed(uuid, name, seen) that may belong together, the newest `top` of each entity.

    Folded names match if equal, with or without legal-form words; if the entity's name is a part of the feed's
    (min_len letters at least); the other way round (both so long); or if the feed's words hold two distinctive words or
    more, and all, of the entity's. No nested loop: each condition has a key, a gram of min_len letters or a word of the
    part, of which the whole has all. The part's rarest one on the other side is taken, so a frequent gram or word joins
    only what has no rarer.
    """
    e = entities.select("entity_id", X.fold_feed(F.col("name")).alias("target"), X.feed_words(F.col("name")).alias("want")).where(F.size("want") > 0)
    plain = F.array_join(F.filter(F.split("target", " "), lambda t: ~t.isin(*X.FEED_LEGAL_FORMS)), " ")
    e = e.withColumn("plain", plain)
    f = feed.select("uuid", "seen", X.fold_feed(F.col("name")).alias("said")).where("said <> ''")
    names = f.select("said").distinct()
    grams = lambda c: F.array_distinct(F.expr(f"transform(sequence(1, greatest(char_length({c}) - {min_len - 1}, 1)), i -> substr({c}, i, {min_len}))"))
    cols = ["entity_id", "said"]
    wants = e.select("entity_id", "plain", "want")
    equal = e.select("entity_id", F.explode(F.array_distinct(F.array("target", "plain"))).alias("said")).join(names, "said").select(*cols)
    long = wants.where(F.char_length("plain") >= min_len)
    said = names.withColumn("k", F.explode(grams("said")))
    inside = _by_rarest(long, grams("plain"), said).where(F.contains("said", "plain")).select(*cols)
    mine = long.withColumn("k", F.explode(grams("plain")))
    around = _by_rarest(names.where(F.char_length("said") >= min_len), grams("said"), mine).where(F.contains("plain", "said")).select(*cols)
    said_words = names.withColumn("k", F.explode(F.array_distinct(F.split("said", " "))))
    tokens = _by_rarest(wants.where(F.size("want") >= 2), F.array_distinct("want"), said_words)
    tokens = tokens.where(F.size(F.array_except("want", F.split("said", " "))) == 0).select(*cols)
    hits = equal.union(inside).union(around).union(tokens).distinct().join(f, "said")
    return top_n_per_entity(hits.select("entity_id", "uuid", "seen").distinct(), ["entity_id"], [F.desc("seen"), F.desc("uuid")], top)


def exact_name_match(entities: DataFrame, ads: DataFrame) -> DataFrame:
    """Active ads whose business or employer name equals the entity's, whole or less its last legal-form word (of those
    that ads know); each uuid once."""
    e = entities.select("entity_id", X.fold_words(F.col("name")).alias("n"))
    e = e.select("entity_id", F.explode(F.array_distinct(F.array("n", X.without_form(F.col("n"), X.AD_LEGAL_FORMS)))).alias("k")).where("k <> ''")
    a = ads.where("status = 'ACTIVE'").select("uuid", F.explode(F.array(X.fold_words(F.col("business_name")), X.fold_words(F.col("employer_name")))).alias("k"))
    return e.join(a, "k").select("entity_id", "uuid").distinct()


def confirm_by_id(cands: DataFrame, entity_keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """cands(entity_id, uuid, number) against entity_keys(entity_id, number, via_subunit) -> accepted, rejected with reason."""
    keys = entity_keys.groupBy("entity_id", "number").agg(F.min("via_subunit").alias("via_subunit"))
    both = cands.join(keys, ["entity_id", "number"], "left")
    ok = both.where("via_subunit is not null").select("entity_id", "uuid", "number", "via_subunit")
    no = both.where("via_subunit is null").select("entity_id", "uuid", F.concat(F.lit("number "), F.coalesce("number", F.lit("absent"))).alias("reason"))
    return ok, no


def blocked_host(h: Column, dotted: Sequence[str], bare: Sequence[str]) -> Column:
    """Host is a listed domain or under one, or holds a listed bare word."""
    out = h.isin(*dotted) if dotted else F.lit(False)
    for d in dotted:
        out |= h.endswith("." + d)
    for b in bare:
        out |= h.contains(b)
    return out


#: Entries without a dot at most: each is looked for inside every host, so they are settings, read by the driver.
BARE_WORDS = 1000


def host_blocklist(urls: DataFrame, blocklist: DataFrame, url: str = "url") -> DataFrame:
    """J8 over a table blocklist(entry): every suffix of a host is looked up; entries without a dot match anywhere in it.

    Entries with a dot may be any number, those without one BARE_WORDS at most.
    """
    bare = sorted(r[0] for r in blocklist.where("entry not like '%.%' and entry <> ''").select("entry").distinct().limit(BARE_WORDS + 1).collect())
    if len(bare) > BARE_WORDS:
        raise ValueError(f"more than {BARE_WORDS} entries without a dot")
    one = urls.select(X.host(F.col(url)).alias("_h")).where("_h is not null").distinct()
    suffixes = F.expr("transform(sequence(1, size(split(_h, '[.]'))), i -> substring_index(_h, '.', -i))")
    dotted = blocklist.where("entry like '%.%'").select(F.col("entry").alias("_k")).distinct()
    hit = one.select("_h", F.explode(suffixes).alias("_k")).join(dotted, "_k").select("_h").distinct()
    rows = urls.withColumn("_h", X.host(F.col(url)))
    if bare:
        rows = rows.where(~F.coalesce(F.col("_h").rlike("|".join(re.escape(w) for w in bare)), F.lit(False)))
    return rows.join(hit, "_h", "left_anti").drop("_h")


def website_candidates(entities: DataFrame, blocked: Column | None = None, suffixes: DataFrame | None = None) -> DataFrame:
    """entities(entity_id, name, website, email) -> candidate URLs, one a registered domain, the registry's own first.

    Origins in order: registry website, domain of the registry's e-mail, guesses from the name. Registered domains come from a
    suffix table, if one is given (see registered_domains), else from the few suffixes of the expression.
    """
    site = F.when(F.coalesce(F.trim("website"), F.lit("")) != "", F.trim("website"))
    tried = F.concat(
        F.array(F.struct(F.lit(0).alias("prio"), F.lit("registry").alias("origin"), X.host(site).alias("host"))),
        F.array(F.struct(F.lit(1).alias("prio"), F.lit("email").alias("origin"), X.email_domain(F.col("email")).alias("host"))),
        F.transform(X.domain_guesses(F.col("name")), lambda d: F.struct(F.lit(2).alias("prio"), F.lit("guess").alias("origin"), d.alias("host"))),
    )
    rows = entities.select("entity_id", F.posexplode(tried).alias("seq", "c")).select("entity_id", "seq", "c.*").where("host is not null and host <> ''")
    if blocked is not None:
        rows = rows.where(~blocked)
    if suffixes is None:
        rows = rows.withColumn("domain", X.registered_domain(F.col("host")))
    else:
        rows = registered_domains(rows, suffixes).where("domain is not null")
    return first_wins(rows, ["entity_id", "domain"], ["prio", "seq"]).select("entity_id", "domain", "prio", "seq", "origin", F.concat(F.lit("https://"), "host").alias("url"))


def distinctive_host_filter(entities: DataFrame, results: DataFrame, known: DataFrame, top: int = 3) -> DataFrame:
    """results(entity_id, query, pos, url) whose host holds a distinctive word of four letters or more; `top` of an entity.

    Domains already known go; a later query counts only where the earlier ones left nothing.
    """
    want = F.filter(X.name_words(F.col("name")), lambda t: (F.char_length(t) >= 4) & (t != X.fold_ascii(F.col("municipality"))))
    rows = results.join(entities.select("entity_id", want.alias("want")), "entity_id").withColumn("host", X.host(F.col("url")))
    rows = rows.withColumn("domain", X.registered_domain(F.col("host"))).join(known.select("entity_id", "domain").distinct(), ["entity_id", "domain"], "left_anti")
    compact = F.regexp_replace("host", "[^a-z0-9]", "")
    rows = rows.where(F.exists("want", lambda t: F.contains(compact, t)))
    first = rows.groupBy("entity_id").agg(F.min("query").alias("query"))
    return top_n_per_entity(rows.join(first, ["entity_id", "query"]), ["entity_id"], [F.col("pos"), F.col("url")], top).select("entity_id", "query", "rank", "url")


def gold_join(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """gold(entity_id, line, expected, wrong_domains) against pred(entity_id, url) -> (entity_id, predicted, expected, wrong).

    An id labelled twice counts once, by its last line.
    """
    last = gold.groupBy("entity_id").agg(F.max(F.struct("line", "expected", "wrong_domains")).alias("g"))
    p = pred.select("entity_id", F.nullif(X.host(F.col("url")), F.lit("")).alias("predicted"))
    out = last.join(p, "entity_id", "left")
    wrong = F.coalesce(F.array_contains("g.wrong_domains", F.col("predicted")), F.lit(False))
    return out.select("entity_id", "predicted", F.nullif(X.host(F.col("g.expected")), F.lit("")).alias("expected"), wrong.alias("wrong"))


def squashed(c: Column) -> Column:
    return F.regexp_replace(c, r"\s+", "")


def decoded(c: Column) -> Column:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", ""), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def span_candidates(spans: DataFrame, snapshots: DataFrame, key: str) -> DataFrame:
    """(key, claim_span, content_sha256) of all pairs of which span_verify_join can call one verbatim, without a cross join.

    A span of 2 w - 1 characters, white space aside, covers a whole one of the windows of w that a text is cut into. So each
    span gives all its windows of the largest such power of two (32 at most), each text those of the widths in use; an
    empty span meets every text.
    """
    s = spans.select(key, "claim_span", squashed(F.col("claim_span")).alias("_s")).where("_s is not null")
    s = s.withColumn("_w", F.expr("case when _s = '' then 0 else element_at(filter(array(1, 2, 4, 8, 16, 32), w -> 2 * w - 1 <= char_length(_s)), -1) end"))
    cut = s.withColumn("_key", F.explode(F.expr("array_distinct(transform(sequence(1, if(_w = 0, 1, char_length(_s) - _w + 1)), i -> xxhash64(substr(_s, i, _w))))")))
    raw = squashed(F.col("body"))
    t = snapshots.where("sha256 is not null").select("sha256", F.explode(F.array_distinct(F.array(raw, decoded(raw), squashed(F.col("text"))))).alias("_t")).where("_t is not null")
    t = t.crossJoin(F.broadcast(s.select("_w").distinct()))
    t = t.select("sha256", "_w", F.explode(F.expr("if(_w = 0, array(''), regexp_extract_all(_t, concat('(?s).{', _w, '}'), 0))")).alias("_x")).select(F.col("sha256").alias("content_sha256"), "_w", F.xxhash64("_x").alias("_key"))
    return cut.join(t, ["_w", "_key"]).select(key, "claim_span", "content_sha256").distinct()


def span_verify_join(evidence: DataFrame, snapshots: DataFrame, exempt: Sequence[str] = ()) -> DataFrame:
    """Evidence with `verdict`: verbatim, not_verbatim or no_snapshot; methods in exempt are computed.

    A span counts as verbatim if it is inside the raw body, the body with its entities decoded or the visible text, white
    space aside.
    """
    snap = snapshots.select("sha256", squashed(F.col("body")).alias("_raw"), squashed(F.col("text")).alias("_text"))
    out = evidence.join(snap, evidence["content_sha256"] == snap["sha256"], "left")
    span = squashed(F.col("claim_span"))
    hit = F.contains("_raw", span) | F.contains(decoded(F.col("_raw")), span) | F.coalesce(F.contains("_text", span), F.lit(False))
    verdict = F.when(F.col("extraction_method").isin(*exempt), F.lit("computed")).when(F.col("sha256").isNull(), F.lit("no_snapshot")).when(hit, F.lit("verbatim")).otherwise(F.lit("not_verbatim"))
    return out.withColumn("verdict", verdict).drop("sha256", "_raw", "_text")


def two_run_compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """Facts (entity_id, field, availability, value) that only one of two runs has, and ids that only one has.

    side is the run that has the fact or the id. An id missing from a run is one row, with availability `missing` and no field;
    its facts aren't told one by one.
    """
    cols = ["entity_id", "field", "availability", "value"]
    ids = a.select("entity_id", F.lit(1).alias("side")).union(b.select("entity_id", F.lit(2).alias("side"))).groupBy("entity_id").agg(F.min("side").alias("first"), F.max("side").alias("last"))
    facts = symmetric_difference(a.select(*cols), b.select(*cols)).join(ids.where("first < last").select("entity_id"), "entity_id", "left_semi")
    none = F.lit(None).cast("string")
    lone = ids.where("first = last").select("entity_id", none.alias("field"), F.lit("missing").alias("availability"), none.alias("value"), F.when(F.col("first") == 1, F.lit("left")).otherwise(F.lit("right")).alias("side"))
    return facts.select(*cols, "side").union(lone)


#: Routes of questions at most: a table of settings, read by the driver.
ROUTES = 1000


def question_router(questions: DataFrame, routes: DataFrame, claims: DataFrame, top: int = 12) -> DataFrame:
    """questions(question_id, entity_id, text) -> the first route(route_id, pattern, section, fields) by regex, and its claims.

    Up to `top` available claims of the route's fields; a question without a route or a claim gets one row that says so. The
    routes are settings: they become one expression over the questions, and more than ROUTES of them are refused.
    """
    known = routes.select("route_id", "pattern", "section", "fields").limit(ROUTES + 1).collect()
    if len(known) > ROUTES:
        raise ValueError(f"more than {ROUTES} routes")
    kinds = {f.name: f.dataType for f in routes.schema.fields}
    value = lambda r: F.struct(F.lit(r.route_id).cast(kinds["route_id"]).alias("route_id"), F.lit(r.section).cast("string").alias("section"), F.array(*map(F.lit, r.fields)).cast("array<string>").alias("fields"))
    none = F.lit(None).cast(f"struct<route_id:{kinds['route_id'].simpleString()},section:string,fields:array<string>>")
    first = none
    for r in sorted(known, key=lambda r: r.route_id, reverse=True):
        first = F.when(F.lower("text").rlike(r.pattern), value(r)).otherwise(first)
    q = questions.select("question_id", "entity_id", first.alias("r")).select("question_id", "entity_id", "r.route_id", "r.section", F.explode_outer("r.fields").alias("field"))
    got = q.join(claims.where("availability = 'available'").select("entity_id", "section", "field", "claim_id", "value"), ["entity_id", "section", "field"], "left")
    got = got.withColumn("_none", F.col("claim_id").isNull().cast("int"))
    out = top_n_per_entity(got, ["question_id"], [F.col("_none"), F.col("field"), F.col("claim_id")], top).where("_none = 0 or rank = 1")
    return out.select("question_id", "entity_id", "route_id", F.when(F.col("_none") == 1, F.lit("not established")).otherwise(F.lit("answered")).alias("state"), "claim_id", "value")


def registered_domains(hosts: DataFrame, suffixes: DataFrame) -> DataFrame:
    """X5 by a suffix table: hosts(host, ...) with `domain`, the label below the longest public suffix(suffix) and that suffix.

    Entries are as in the public suffix list: plain, `*.` for any label below, `!` for an exception to it. A host under none
    counts its last label as the suffix; a host that is a suffix itself, or has one label, has no domain (null). Every host is
    looked up once, by its ends.
    """
    rules = suffixes.select(F.lower(F.trim("suffix")).alias("s")).where("s <> ''").distinct()
    rules = rules.select(F.regexp_replace("s", r"^(?:!|\*\.)", "").alias("_end"), F.when(F.col("s").startswith("!"), F.lit(-1)).when(F.col("s").startswith("*."), F.lit(1)).otherwise(F.lit(0)).alias("more"))
    one = hosts.select("host").where("host is not null").distinct().withColumn("_n", F.size(F.split("host", "[.]")))
    ends = one.select("host", "_n", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("i")).withColumn("_end", F.expr("substring_index(host, '.', -i)"))
    # labels of the suffix that a rule gives; an exception stands above all others and has one label less than its entry
    hit = ends.join(rules, "_end").where("i + more <= _n").groupBy("host").agg(F.max(F.struct((F.col("more") == -1).alias("x"), (F.col("i") + F.col("more")).alias("k")))["k"].alias("k"))
    found = one.join(hit, "host", "left").withColumn("k", F.coalesce("k", F.lit(1)))
    found = found.select("host", F.when(F.col("_n") > F.col("k"), F.expr("substring_index(host, '.', -(k + 1))")).alias("domain"))
    return hosts.join(found, "host", "left")
