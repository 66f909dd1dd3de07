"""Byte-level BPE as recursive DuckDB queries inside each partition."""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import pairwise

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, ship, text_or_empty
from .tokens import pieces, rank_table

#: Pieces and words that a worker remembers, each.
REMEMBERED = 300_000
#: Bytes of matches that one recursive query takes.
TOGETHER = 300_000
#: Bytes from which a match is cut where no merge can cross; shorter ones take fewer steps than the cutting.
LONG = 256

#: Token rows (w: word, p: place, t: token, nx: the next one's place) join the merge table. A step contracts each word's leftmost
#: pair of least rank and, where the merged token can't be drawn into a merge of lower rank (safe), the later places of the same
#: pair that the next steps would contract one by one; of pairs of one token in a run (aaaa) every other place. So the steps of a
#: word are its distinct merges at most, however long it is. Unfinished words are carried on; finished ones stay behind.
_ENCODE = """
with recursive enc(w, p, t, nx, done) as (
  select w, p, t, nx, false from tokens
  union all
  (with live as (select w, p, t, nx from enc where not done),
   pairs as (select a.w, a.p, a.t = n.t as twin, n.p as gone, n.nx as after, m.token, m.safe
             from live a join live n on n.p = a.nx join merges m on m.pair = (a.t::bigint << 20) | n.t),
   best as (select w, min((token::bigint << 32) | p) as b from pairs group by w),
   hits as (select pairs.*, (b & 4294967295) as spot from pairs join best using (w) where token = (b >> 32)),
   twins as (select w, p, p not in (select gone from hits where twin) as opens from hits where twin),
   runs as (select p, row_number() over (partition by w, run order by p) as k from (select w, p, sum(opens::int) over (partition by w order by p) as run from twins)),
   chosen as (select hits.* from hits left join runs using (p) where hits.p = spot or (safe and coalesce(k, 1) % 2 = 1))
   select l.w, l.p, coalesce(c.token, l.t), case when c.p is null then l.nx else c.after end, best.b is null
   from live l left join best using (w) left join chosen c on c.p = l.p anti join chosen g on g.gone = l.p)
)
select w, p, t from enc where done
"""

_FOLD = "select w, string_agg(t::varchar, ' ' order by p) as ids from encoded group by w"

#: Ids (d: document, p: place, t: token) back to bytes.
_DECODE = "select c.d, string_agg(v.hex, '' order by c.p) from coded c join vocabulary v on v.token = c.t group by c.d"
#: Ids that are decoded together at most; a longer document comes in several parts.
DECODED = 500_000


class _Recent:
    """What a worker remembers: two generations of a bounded size, so that frequent keys outlive rare ones."""

    def __init__(self, most: int):
        self.most, self.new, self.old = most, {}, {}

    def missing(self, keys: set[str]) -> set[str]:
        """The keys to be put; those of the older generation move to the newer one."""
        if len(self.new) + len(keys) > self.most:
            self.old, self.new = self.new, {}
        out = set()
        for k in keys.difference(self.new):
            if (v := self.old.get(k)) is None:
                out.add(k)
            else:
                self.new[k] = v
        return out


class Bpe:
    """The merge table in an in-memory database of the task's own, and the ids of words and pieces met lately."""

    def __init__(self, path: str | None = None):
        ranks = rank_table(path)
        rows, risky = [], set()
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    rows.append((left << 20 | right, rank))
                    risky |= {x for x in (left, right) if rank < x}
        self.ranks, self.split = ranks, regex.compile(public_tokenizers.PATTERN)
        self.twos, self.threes = np.zeros(1 << 16, bool), np.zeros(1 << 24, bool)
        self.twos[[t[0] << 8 | t[1] for t in ranks if len(t) == 2]] = True
        self.threes[list({t[i] << 16 | t[i + 1] << 8 | t[i + 2] for t in ranks for i in range(len(t) - 2)})] = True
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": tempfile.mkdtemp(prefix="bpe-")})
        pair, merged = (np.array(c, np.int64) for c in zip(*rows, strict=True))
        safe = ~np.isin(merged, list(risky))
        self._table("merges", {"pair": pair, "token": merged.astype(np.int32), "safe": safe})
        self._table("vocabulary", {"token": np.array(list(ranks.values()), np.int32), "hex": [t.hex() for t in ranks]})
        self.words, self.pieces = _Recent(REMEMBERED), _Recent(REMEMBERED)

    def _table(self, name: str, columns: dict) -> None:
        self.db.register("incoming", pa.table(columns))
        self.db.execute(f"create or replace table {name} as select * from incoming")
        self.db.unregister("incoming")

    def _cuts(self, word: bytes) -> np.ndarray:
        """Places of a word that no token can reach across, whatever merges come first: neither the two bytes around it are a
        token, nor are they, with a third one on either side, part of one."""
        b = np.frombuffer(word, np.uint8).astype(np.int32)
        pair = b[:-1] << 8 | b[1:]
        three = np.zeros(len(b), bool)  # three[i]: bytes i to i + 2 stand in some token
        three[:-2] = self.threes[pair[:-1] << 8 | b[2:]]
        crossed = self.twos[pair] | three[:-1]
        crossed[1:] |= three[:-2]
        return np.flatnonzero(~crossed) + 1

    def encode_words(self, words: list[bytes]) -> list[str]:
        """The ids of each word, joined by spaces. A long one is cut where no merge can cross, and its parts are encoded as words."""
        out: list = [None] * len(words)
        short, long = [], []
        for i, w in enumerate(words):
            if (rank := self.ranks.get(w)) is not None:
                out[i] = str(rank)
            else:
                (short if len(w) <= LONG else long).append(i)
        parts = {i: [words[i][a:b] for a, b in pairwise([0, *self._cuts(words[i]).tolist(), len(words[i])])] for i in long}
        distinct = sorted({p for cut in parts.values() for p in cut})
        ids = self._merged([words[i] for i in short] + distinct)
        for i, found in zip(short, ids, strict=False):
            out[i] = found
        known = dict(zip(distinct, ids[len(short) :], strict=True))
        for i, cut in parts.items():
            out[i] = " ".join(map(known.__getitem__, cut))
        return out

    def _merged(self, words: list[bytes]) -> list[str]:
        """The ids of each word by merges alone, joined by spaces."""
        out: list = [None] * len(words)
        open_ = range(len(words))
        for lo, hi in chunks([len(words[i]) for i in open_], TOGETHER):
            part = open_[lo:hi]
            size = np.array([len(words[i]) for i in part])
            token = self.bytes[np.frombuffer(b"".join(words[i] for i in part), np.uint8)]
            place = np.arange(len(token), dtype=np.int32)
            after = place + 1
            after[np.cumsum(size) - 1] = -1
            self._table("tokens", {"w": np.repeat(np.arange(len(part), dtype=np.int32), size), "p": place, "t": token, "nx": after})
            self.db.execute(f"create or replace table encoded as {_ENCODE}")
            for w, ids in self.db.execute(_FOLD).fetchall():
                out[part[w]] = ids
        return out

    def decode(self, ids: list[str]) -> list[bytes]:
        """The bytes of each document's ids (joined by spaces), by the vocabulary alone."""
        out: list[list[bytes]] = [[] for _ in ids]
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), [i.count(" ") + 1 if i else 0 for i in ids])
        token = np.fromstring(" ".join(filter(None, ids)), np.int32, sep=" ")
        for at in range(0, len(token), DECODED):
            part = slice(at, at + DECODED)
            self._table("coded", {"d": doc[part], "p": np.arange(len(token[part]), dtype=np.int32), "t": token[part]})
            for d, raw in self.db.execute(_DECODE).fetchall():
                out[d].append(bytes.fromhex(raw))
        return [b"".join(parts) for parts in out]

    def learn(self, texts: set[str]) -> None:
        """Encode the pieces not remembered, each distinct match of the pattern once."""
        new = self.pieces.missing(texts)
        split = {p: self.split.findall(p) for p in new}
        words = sorted(self.words.missing({w for found in split.values() for w in found}))
        for w, ids in zip(words, self.encode_words([w.encode("utf-8", "surrogatepass") for w in words]), strict=True):
            self.words.new[w] = ids
        known = self.words.new
        for p, found in split.items():
            self.pieces.new[p] = known[found[0]] if len(found) == 1 else " ".join([known[w] for w in found])

    def ids(self, texts: list[str]) -> list[str]:
        """The ids of whole texts, joined by spaces; a batch's new pieces are encoded together."""
        cut = [pieces(t) if t else [] for t in texts]
        self.learn({p for parts in cut for p in parts if p})
        known, out = self.pieces.new.__getitem__, []
        for parts in cut:
            parts = parts[1:] if parts and not parts[0] else parts  # a text that starts with a space
            out.append(" ".join(map(known, parts)))
        return out

    def documents(self, texts: list[str]) -> list[tuple[int, str, bytes]]:
        """(tokens, ids joined by spaces, bytes decoded from these ids) of whole texts."""
        ids = self.ids(texts)
        return [(i.count(" ") + 1 if i else 0, i, raw) for i, raw in zip(ids, self.decode(ids), strict=True)]


@lru_cache(1)
def _bpe(path: str | None) -> Bpe:
    return Bpe(path)


def _run(batches: Iterator[pa.RecordBatch], path: str | None) -> Iterator[pa.RecordBatch]:
    bpe = _bpe(path)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for lo, hi in chunks(map(len, texts), 2_000_000):
            done = bpe.documents(texts[lo:hi])
            sha = lambda b: hashlib.sha256(b).hexdigest()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(lo, hi - lo),
                    pa.array([n for n, _, _ in done], pa.int64()),
                    pa.array([sha(ids.encode()) for _, ids, _ in done]),
                    pa.array([sha(raw) for _, _, raw in done]),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of docs.

    Whole texts are split by the vocabulary's pattern; each match is encoded by itself; the ids of the whole text are
    decoded through the vocabulary.
    Null and empty texts have no tokens. Null and repeated doc_ids pass through; extra columns are not read. `path` names
    a rank file on the workers, by default the 50k byte-level vocabulary.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").alias("doc_id"), text_or_empty().alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(partial(_run, path=path), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _ids(batches: Iterator[pa.RecordBatch], path: str | None) -> Iterator[pa.RecordBatch]:
    bpe = _bpe(path)
    for batch in batches:
        ids = [[int(i) for i in s.split()] for s in bpe.ids(batch.column("text").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row; nulls as in round_trip."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return docs.mapInArrow(partial(_ids, path=path), "doc_id long, ids array<int>")


def _decode(batches: Iterator[pa.RecordBatch], path: str | None) -> Iterator[pa.RecordBatch]:
    db = _bpe(path).db
    for batch in batches:
        rows = pa.table({"d": pa.array(range(batch.num_rows), pa.int32()), "ids": batch.column("ids")})
        db.register("incoming", rows)
        sql = """select d, string_agg(hex, '' order by p) from (select d, unnest(ids) as t, generate_subscripts(ids, 1) as p from incoming)
                 join vocabulary on token = t group by d"""
        got = dict(db.execute(sql).fetchall())
        db.unregister("incoming")
        out = [bytes.fromhex(got.get(i, "")).decode("utf-8", "replace") for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out)], ["doc_id", "text"])


def decode(ids: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, ids): bytes of the ids in order; null or no ids give an empty text, broken UTF-8 the replacement sign."""
    ship(ids.sparkSession)
    ids = ids.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return ids.mapInArrow(partial(_decode, path=path), "doc_id long, text string")
