"""Quality rules: a table of thresholds compiled into Spark projections, without user functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

#: Function words of the four languages of the corpus. Fixed values.
STOP_WORDS = (
    "the of and to in is that it for on with as was are by this be at from or an "
    "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch "
    "de la le et les un une du que est pour qui dans par sur au en "
    "el los las se por con no su al lo y a del para"
).split()

#: name, ratio (SQL over the counted columns), least and most allowed value; None: no limit. A ratio of nothing passes.
RULES: tuple[tuple[str, str, float | None, float | None], ...] = (
    ("mean_word_length", "word_chars / n_words", 2.0, 12.0),
    ("symbol_ratio", "n_symbols / n_words", None, 0.2),
    ("stop_word_ratio", "n_stop_words / n_words", 0.04, None),
    ("dup_line_ratio", "n_dup_lines / n_lines", None, 0.5),
    ("exclamation_ratio", "n_exclamations / n_words", None, 0.5),
    ("repeat_ratio", "n_repeat_words / n_words", None, 0.5),
)


def _counts(docs: DataFrame, text: Column) -> DataFrame:
    """The columns the rules read, each step a projection of its own so that arrays are made once."""
    out = docs.withColumn("_text", F.coalesce(text.cast("string"), F.lit("")))
    out = out.withColumn("_words", F.regexp_extract_all("_text", F.lit(f"({WORD})"), F.lit(0)))
    out = out.withColumn("_lines", F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(WORD)))
    stops = sorted({*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)})
    # hashes of the 3-word windows, in order of their places
    windows = F.expr("transform(slice(_words, 1, greatest(size(_words) - 2, 0)), (w, i) -> xxhash64(w, _words[i + 1], _words[i + 2]))")
    out = out.withColumn("_windows", windows)
    # only a text in which a window comes twice is sorted; the places of equal windows are then neighbours
    ranked = F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.sort_array(F.transform("_windows", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    out = out.withColumn("_ranked", F.coalesce(ranked, F.array().cast("array<struct<h:bigint,i:int>>")))
    twice = F.expr("filter(_ranked, (x, k) -> (k > 0 and x.h = _ranked[k - 1].h) or (k + 1 < size(_ranked) and x.h = _ranked[k + 1].h))")
    out = out.withColumn("_places", F.sort_array(F.transform(twice, lambda x: x["i"])))
    # a window covers 3 words, less what the next one covers as well
    covered = F.expr("aggregate(_places, named_struct('n', 0L, 'end', 0), (a, p) -> named_struct('n', a.n + (p + 3 - greatest(p, a.end)), 'end', p + 3), a -> a.n)")
    return out.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": covered,
            "n_lines": F.size("_lines").cast("long"),
            "n_stop_words": F.size(F.filter("_words", lambda w: w.isin(stops))).cast("long"),
            "n_exclamations": F.regexp_count("_text", F.lit("!")).cast("long"),
        }
    )


def _verdict() -> Column:
    """The table of rules as one condition."""
    out = F.lit(True)
    for _, ratio, least, most in RULES:
        value = F.expr(f"try_divide({ratio.replace(' / ', ', ')})")
        if least is not None:
            out &= F.coalesce(value >= least, F.lit(True))
        if most is not None:
            out &= F.coalesce(value <= most, F.lit(True))
    return out


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _judged(docs: DataFrame, text: Column, *carried: str) -> DataFrame:
    """The carried columns, the five counts, base_failed and kept, all made before any filter over them.

    Counts and verdict leave as the one struct of an inlined array. A filter on a generated column stays above the generator, so
    no caller's filter takes copies of the counts with it below the projections that make the arrays.
    """
    base = F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")
    row = F.struct(*COUNTS, base.alias("base_failed"), (~base & _verdict()).alias("kept"))
    return _counts(docs, text).select(*carried, F.inline(F.array(row)))


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, the five counts, base_failed and kept.

    Words are runs of other than ASCII white space; lines are split at \\n and count with a word in them; a word is a
    repeat if a 3-word window over it comes twice or more in the text. base_failed: under 50 words, or more than half of
    the words repeats. kept also needs every ratio of RULES within its limits. Null texts count as empty: all counts 0,
    base_failed. Null and repeated doc_ids pass through; extra columns are not read.
    """
    return _judged(docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("_in")), F.col("_in"), "doc_id")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, with their own columns only; no join, so repeated doc_ids are each judged."""
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col("text").alias("_in"))
    return _judged(packed, F.col("_in"), "_row").where("kept").select("_row.*")
