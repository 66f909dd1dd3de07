"""Spelling variants: words one edit apart, by composing vocabulary acceptors with a one-edit transducer."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship, text_or_empty

SHORTEST, RAREST = 6, 5
#: A form is this many times as frequent as its variant.
TIMES = 5
#: One in so many occurrences loses a code point; 0 leaves all as they are.
DROPPED = 199
#: Words that share a start state at most, unless their states can't be told apart any further.
TOGETHER = 20_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, rarest: int = RAREST, dropped: int = DROPPED) -> DataFrame:
    """(word, n) of the runs of letters in whole texts, A-Z in lower case, that are so long and so frequent.

    Where `dropped` divides the crc32 of `doc_id:run`, the occurrence counts without its code point crc32 % length. Null
    texts have no words; a null doc_id counts as an empty one; extra columns are not read. Occurrences are counted before
    they are shuffled, so a word that is everywhere costs a row a task.
    """
    runs = F.regexp_extract_all(F.translate(text_or_empty(), _UPPER, _UPPER.lower()), F.lit(rf"[a-zÀ-ÿ]{{{shortest},}}"), F.lit(0))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), F.explode(runs).alias("w"))
    word = F.col("w")
    if dropped:
        h, at = F.crc32(F.concat_ws(":", "d", "w").cast("binary")), "cast(h % char_length(w) as int)"
        cut = F.expr(f"concat(substr(w, 1, {at}), substr(w, {at} + 2))")
        runs = runs.withColumn("h", h)
        word = F.when(F.col("h") % dropped == 0, cut).otherwise(F.col("w"))
    return runs.select(word.alias("word")).where(F.char_length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= rarest)


# An edit between a word of l code points and one of l or l + 1 has a place: the length of their longest common prefix, 0 to
# l. A window (l, lo, hi) is the places lo to hi - 1; its words agree before lo and, counted from the end, from hi on. So a
# window's words with one prefix and one suffix start from the same state, and each pair is in one window alone.


def _windows(words: DataFrame, shortest: int) -> DataFrame:
    """Each word under its own length and as the longer one of a pair, with all places."""
    n = F.char_length("word")
    lengths = F.array_compact(F.array(n, F.when(n > shortest, n - 1)))
    return words.select("word", F.explode(lengths).alias("l")).select("word", "l", F.lit(0).alias("lo"), (F.col("l") + 1).alias("hi"))


def _halves(windows: DataFrame) -> DataFrame:
    middle = F.expr("(lo + hi) div 2")
    halves = F.array(F.struct("lo", middle.alias("hi")), F.struct(middle.alias("lo"), "hi"))
    return windows.select("word", "l", F.inline(halves))


def _state() -> Column:
    """What the words of a window share; no letter is a colon."""
    tail = F.expr("if(hi > l, '', substr(word, char_length(word) - (l - hi) + 1))")
    return F.concat_ws(":", F.col("l").cast("string"), F.col("lo").cast("string"), F.col("hi").cast("string"), F.expr("substr(word, 1, lo)"), tail)


def _small(words: DataFrame, shortest: int) -> list[DataFrame]:
    """Tables of (state, l, lo, hi, word) in which no state has more than TOGETHER words that could be told apart.

    Windows are halved, all of them at first and then only those of states that many words share: at most as often as a
    word's length has halves, for a window of one place leaves one code point free.
    """
    out, now = [], _halves(_windows(words, shortest))
    while True:
        now = materialize(now.select(_state().alias("state"), "l", "lo", "hi", "word"), "windows")
        sizes = now.groupBy("state").agg(F.count("*").alias("n"), F.first(F.col("hi") - F.col("lo")).alias("places")).where("n > 1")
        sizes = materialize(sizes.select("state", F.expr(f"n > {TOGETHER} and places > 1").alias("crowded")), "states")
        joined = now.join(sizes.hint("merge"), "state")
        out.append(joined.where("not crowded").drop("crowded"))
        if sizes.where("crowded").isEmpty():
            return out
        now = _halves(joined.where("crowded"))


class Acceptor:
    """Minimal acyclic acceptors over a shared register: a state is the number of its (final, arcs)."""

    def __init__(self):
        self.register: dict[tuple, int] = {}
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []

    def _of(self, final: bool, arcs: dict[str, int]) -> int:
        key = (final, *arcs.items())
        if (state := self.register.get(key)) is None:
            state = self.register[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return state

    def add(self, words: list[str]) -> int:
        """The start state of an acceptor of sorted, distinct words. A state is registered when no later word reaches it."""
        path: list[tuple[bool, dict[str, int]]] = [(False, {})]
        last = ""
        for word in [*words, ""]:
            common = 0
            while common < min(len(word), len(last)) and word[common] == last[common]:
                common += 1
            while len(path) - 1 > common:
                final, arcs = path.pop()
                path[-1][1][last[len(path) - 1]] = self._of(final, arcs)
            path += [(False, {}) for _ in word[common:]]
            if word:
                path[-1] = (True, path[-1][1])
            last = word
        final, arcs = path[0]
        return self._of(final or "" in words[:1], arcs)


class Composition:
    """Acceptor o one-edit transducer o acceptor: pairs of accepted words, one edit apart at a place below `places`.

    A composed state is (left state, edited or not, right state). Unedited states are walked from the pair of start states;
    past the edit both sides have to read the same, and states with nothing in common are known after the first visit.
    The edit is at the end of the longest common prefix, so an inserted letter differs from the one that follows on the left.
    """

    def __init__(self, acceptor: Acceptor, places: int):
        self.arcs, self.final, self.places = acceptor.arcs, acceptor.final, places
        self.met: dict[tuple[int, int], list[tuple[str, tuple[int, int]]] | None] = {}

    def _common(self, a: int, b: int) -> bool:
        """Whether two states accept a word in common; the arcs that lead to one are kept. No recursion: words may be long."""
        todo = [(a, b)]
        while todo:
            q, r = pair = todo[-1]
            if q == r or pair in self.met:
                todo.pop()
                continue
            two = self.arcs[r]
            arcs = [(c, (x, two[c])) for c, x in self.arcs[q].items() if c in two]
            if unknown := [p for _, p in arcs if p[0] != p[1] and p not in self.met]:
                todo += unknown
                continue
            arcs = [(c, p) for c, p in arcs if p[0] == p[1] or self.met[p] is not None]
            self.met[todo.pop()] = arcs if arcs or (self.final[q] and self.final[r]) else None
        return a == b or self.met[a, b] is not None

    def _rests(self, a: int, b: int, read: str) -> Iterator[str]:
        """The common words of two states, behind what was read."""
        todo = [(a, b, read)]
        while todo:
            a, b, read = todo.pop()
            if self.final[a] and self.final[b]:
                yield read
            arcs = [(c, (q, q)) for c, q in self.arcs[a].items()] if a == b else self.met[a, b] or ()
            todo += [(q, r, read + c) for c, (q, r) in arcs]

    def substitutions(self, start: int) -> Iterator[tuple[str, str]]:
        """Pairs of words of one acceptor, each once."""
        todo = [(start, "")]
        while todo:
            state, read = todo.pop()
            arcs = list(self.arcs[state].items())
            if len(read) < self.places:
                for i, (c, q) in enumerate(arcs):
                    for d, r in arcs[i + 1 :]:
                        if self._common(q, r):
                            for rest in self._rests(q, r, ""):
                                yield f"{read}{c}{rest}", f"{read}{d}{rest}"
                todo += [(q, read + c) for c, q in arcs]

    def insertions(self, short: int, long: int) -> Iterator[tuple[str, str]]:
        """Pairs of a word from `short` and the same with one more code point from `long`."""
        todo = [(short, long, "")]
        while todo:
            a, b, read = todo.pop()
            if len(read) < self.places:
                two = self.arcs[b]
                for d, r in two.items():
                    if self._common(a, r):
                        for rest in self._rests(a, r, ""):
                            if rest[:1] != d:
                                yield read + rest, f"{read}{d}{rest}"
                todo += [(q, two[c], read + c) for c, q in self.arcs[a].items() if c in two]


def _pairs(state: str, words: list[str]) -> list[tuple[str, str]]:
    """The pairs of one start state whose edit is inside its window."""
    l, lo, hi, head, tail = state.split(":")
    l, lo, hi = int(l), int(lo), int(hi)
    end = len(tail)
    rests = [w[lo : len(w) - end] for w in sorted(set(words))]
    size = l - lo - end
    acceptor = Acceptor()
    short, long = acceptor.add(one := [r for r in rests if len(r) == size]), acceptor.add(two := [r for r in rests if len(r) == size + 1])
    found, composed = [], Composition(acceptor, hi - lo)
    if len(one) > 1:
        found += composed.substitutions(short)
    if one and two:
        found += composed.insertions(short, long)
    return [(head + a + tail, head + b + tail) for a, b in found]


def _enumerate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (state, word), those of a state together -> pairs of words."""

    def out(pairs: list[tuple[str, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.string()) for i in (0, 1)], ["a", "b"])

    at, words, found = None, [], []
    for batch in batches:
        for state, word in zip(batch.column("state").to_pylist(), batch.column("word").to_pylist(), strict=True):
            if state != at:
                if len(words) > 1:
                    found += _pairs(at, words)
                    if len(found) > 20_000:
                        yield out(found)
                        found = []
                at, words = state, []
            words.append(word)
    if len(words) > 1:
        found += _pairs(at, words)
    yield out(found)


def near_words(words: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """(a, b) of the distinct words, read from column `word`, that differ by exactly one code point inserted, deleted or replaced.

    Each pair comes once, a being the shorter one. `words` is read once a size of windows and has to be written by the
    caller; null words and words shorter than `shortest` have no partners.
    """
    ship(words.sparkSession)
    words = words.select("word").where(F.char_length("word") >= shortest).distinct()
    found = None
    for part in _small(words, shortest):
        rows = part.select("state", "word").repartition("state").sortWithinPartitions("state")
        pairs = rows.mapInArrow(_enumerate, "a string, b string")
        found = pairs if found is None else found.union(pairs)
    return found


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms are followed to the last one, twice as far in each round. Frequencies grow on the way, so it ends."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = materialize(now.join(further, "root", "left"), "roots")
        now = after.select("word", F.coalesce("next", "root").alias("root"))
        if after.where("next is not null").isEmpty():
            return now


def variants(words: DataFrame, shortest: int = SHORTEST, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary (word, n), one row a word.

    n_near is the number of words one edit away; the form is the most frequent of them (ties: the first in code-point
    order) if it is `times` as frequent as the word, else null; the root is where forms lead, or the word itself. Words have to
    be distinct; an empty vocabulary gives no rows; extra columns are not read.
    """
    words = materialize(words.select("word", F.col("n").cast("long").alias("n")), "vocabulary")
    pairs = materialize(near_words(words, shortest), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).union(pairs.select("b", "a"))
    both = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = F.min(F.struct((-F.col("other_n")).alias("order"), "other"))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    out = words.join(near, "word", "left")
    formed = F.coalesce(-F.col("best.order") >= times * F.col("n"), F.lit(False))
    out = materialize(
        out.select("word", F.when(formed, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(formed, -F.col("best.order")).alias("form_n")), "variants"
    )
    roots = _roots(out.where("form is not null"))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, shortest: int = SHORTEST, rarest: int = RAREST, dropped: int = DROPPED, times: int = TIMES) -> DataFrame:
    """Variants over the vocabulary of docs; see `vocabulary` and `variants`."""
    return variants(vocabulary(docs, shortest, rarest, dropped), shortest, times)
