"""Groups of spelling variants: words one edit apart, by a bit-sliced position index.

The vocabulary comes from whole texts; tasks count before the shuffle, so a frequent word costs one row a task.

Two words that differ by one edit keep the first, the middle or the last part of the shorter one free of it, so they agree in the
letters of the other two parts, counted from the start or the end. Each word is posted under these three keys for
its own length and for the length below. The words of a key form a segment, and a segment gets a bit-sliced index: 64
words a lane, and for each position and letter the bitset of words that have the letter there. All words of
a segment are searched at once. Per lane four bitsets go along the letters of the searched word: words without an error
so far, and words with one replaced, inserted or deleted letter, the last two read from the position after or before.
What is left when the word ends, and has the right length, is near. A pair counts under the first key that it shares.

Segments of more than ``CHUNK`` words are cut into chunks, and every two chunks meet in a group of their own."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.session import materialize

SHORTEST, LEAST, ODDS = 5, 3, 97
#: Words of a segment that one group searches, rows that are searched together, and words that a task counts before it sends them.
CHUNK = 4096
ROWS = 1 << 17
HELD_WORDS = 300_000

#: Two-byte UTF-8 from U+00C0 to U+00FF begins with C3; all other letters beyond ASCII go.
_OTHER = re.compile(rb"[\xc2\xc4-\xf4][\x80-\xbf]*")
_RUN_BYTES = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ\xc3") | frozenset(range(0x80, 0xC0))
_TO_RUNS = bytes(x if x in _RUN_BYTES else 0x20 for x in range(256)).lower()

KEYED = "key bigint, part int, size int, word string, n bigint, role int"
FOUND = "word string, n bigint, near bigint, top_n bigint, top string"


def runs_of(text: str) -> list[bytes]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case, as UTF-8."""
    data = text.encode()
    if not data.isascii():
        data = _OTHER.sub(b" ", data)
    return data.translate(_TO_RUNS).split()


def misspelt(run: bytes, seed: int) -> bytes:
    """The run without one letter if its checksum, continued from ``seed``, says so."""
    h = zlib.crc32(run, seed)
    if h % ODDS:
        return run
    letters = run.decode()
    k = h % len(letters)
    return (letters[:k] + letters[k + 1 :]).encode()


def _count(batches):
    total: Counter[bytes] = Counter()

    def flush():
        kept = [(w, k) for w, k in total.items() if len(w) - w.count(b"\xc3") >= SHORTEST]
        total.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in kept], pa.binary()).cast(pa.string()), pa.array([k for _, k in kept], pa.int64())], ["word", "n"]
        )

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for run, k in Counter(runs_of(text or "")).items():
                if len(run) >= SHORTEST:
                    total[misspelt(run, seed)] += k
            if len(total) >= HELD_WORDS:
                yield flush()
    if total:
        yield flush()


def vocabulary(docs: DataFrame) -> DataFrame:
    """Rows (word, n) of words of at least ``SHORTEST`` letters with ``LEAST`` occurrences or more in ``docs`` (doc_id, text)."""
    counted = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def parts_of(word: str, n: int) -> tuple[str, str, str]:
    """Letters that stay if the edit is in the first, the middle or the last part of a word of ``n`` letters."""
    edge = (n + 1) // 3
    return word[edge - n :], word[:edge] + word[-edge:], word[: n - edge]


def _keys(batches):
    for batch in batches:
        keys, parts, sizes, rows = [], [], [], []
        for row, word in enumerate(batch.column("word").to_pylist()):
            for n in (len(word) - 1, len(word)) if len(word) > SHORTEST else (len(word),):
                for part, letters in enumerate(parts_of(word, n)):
                    # The length in front, so that words of a length are searched together.
                    hashed = xxhash.xxh3_64_intdigest(f"{n}/{part}/{letters}".encode()) >> 8
                    keys.append(min(n, 127) << 56 | hashed)
                    parts.append(part)
                    sizes.append(n)
                    rows.append(row)
        taken = batch.take(pa.array(rows, pa.int64())) if rows else batch.slice(0, 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(parts, pa.int32()), pa.array(sizes, pa.int32()), taken.column("word"), taken.column("n"), pa.array([3] * len(rows), pa.int32())],
            ["key", "part", "size", "word", "n", "role"],
        )


class Index:
    """Bit-sliced index of the words of some segments: position by position, one bitset of a lane for each letter."""

    def __init__(self, words: list[bytes], segment: np.ndarray) -> None:
        """``segment`` numbers the words' segments, in order."""
        self.length = np.array([len(w) for w in words], np.int64)
        self.flat = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        self.begin = np.cumsum(self.length) - self.length
        place = np.arange(len(words)) - np.searchsorted(segment, segment)
        new = np.concatenate([[True], (segment[1:] != segment[:-1]) | (place[1:] % 64 == 0)]) if len(words) else np.empty(0, bool)
        self.lane = np.cumsum(new) - 1
        self.first = np.flatnonzero(new)
        self.bit = np.uint64(1) << (place % 64).astype(np.uint64)
        self.lanes = len(self.first)
        _, codes = np.unique(self.flat[:-1], return_inverse=True)
        self.code = np.zeros(256, np.int64)
        self.code[self.flat[:-1]] = codes + 1
        self.letters = int(codes.max(initial=-1)) + 2

    def at(self, k: int) -> np.ndarray:
        """Bitsets (letter, lane) of position k, from 0; row 0 has all words that are so long."""
        out = np.zeros((self.letters, self.lanes), np.uint64)
        if k >= 0:
            there = np.flatnonzero(self.length > k)
            code = self.code[self.flat[self.begin[there] + k]]
            np.add.at(out, (code, self.lane[there]), self.bit[there])
            np.add.at(out, (np.zeros(len(there), np.int64), self.lane[there]), self.bit[there])
        return out

    def long(self, n: int) -> np.ndarray:
        """Bitset of each lane: its words of n letters."""
        out = np.zeros(self.lanes, np.uint64)
        there = np.flatnonzero(self.length == n)
        np.add.at(out, self.lane[there], self.bit[there])
        return out

    def near(self, query: np.ndarray, lane: np.ndarray, m: int, shorter: bool) -> np.ndarray:
        """For rows (first letter of a searched word of m letters in ``flat``, lane): the bitset of words one edit away. With
        ``shorter`` only words of m - 1 letters, else only those of m and m + 1."""
        before, here = self.at(-1), self.at(0)
        none = here[0][lane]
        replaced = deleted = np.zeros(len(lane), np.uint64)
        inserted = none
        for k in range(m):
            after = self.at(k + 1) if not shorter else None
            code = self.code[self.flat[query + k]]
            same = here[code, lane]
            if shorter:
                deleted = (deleted & before[code, lane]) | none
                none = none & same
            else:
                replaced = (replaced & same) | (none & ~same & here[0][lane])
                none = none & same
                inserted = (inserted & after[code, lane]) | (none & after[0][lane])
            before, here = here, after if after is not None else self.at(k + 1)
        if shorter:
            return deleted & self.long(m - 1)[lane]
        return (replaced & self.long(m)[lane]) | (inserted & self.long(m + 1)[lane])

    def search(self, segment: np.ndarray, queries: np.ndarray, size: np.ndarray):
        """Pairs (searched word, near word) of the same segment, both as numbers of words. ``size`` is the length that
        a word's segment is for: pairs whose shorter word has another length are left to other segments."""
        lane_segment = segment[self.first]
        low, high = np.searchsorted(lane_segment, segment[queries]), np.searchsorted(lane_segment, segment[queries], side="right")
        for m in np.unique(self.length[queries]):
            for shorter in (False, True):
                own = np.flatnonzero((self.length[queries] == m) & ((size[queries] < m) == shorter))
                cuts = np.flatnonzero(np.diff(np.cumsum(high[own] - low[own]) // ROWS)) + 1
                for some in np.split(own, cuts):
                    lanes = high[some] - low[some]
                    rows = np.repeat(some, lanes)
                    lane = np.arange(len(rows)) - np.repeat(np.cumsum(lanes) - lanes, lanes) + low[rows]
                    if not len(rows):
                        continue
                    used = np.unique(lane)
                    found = self._of(used).near(self.begin[queries[rows]], np.searchsorted(used, lane), int(m), shorter)
                    hits = np.flatnonzero(found)
                    bits = np.unpackbits(found[hits].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    at, bit = np.nonzero(bits)
                    yield queries[rows[hits[at]]], self.first[lane[hits[at]]] + bit

    def _of(self, lanes: np.ndarray) -> Index:
        """The same index with some of its lanes alone."""
        if len(lanes) == self.lanes:
            return self
        part = object.__new__(Index)
        part.__dict__.update(self.__dict__)
        kept = np.flatnonzero(np.isin(self.lane, lanes))
        part.length, part.begin, part.bit = self.length[kept], self.begin[kept], self.bit[kept]
        part.lane, part.lanes = np.searchsorted(lanes, self.lane[kept]), len(lanes)
        return part


def _search(rows: pa.Table) -> pa.RecordBatch:
    """Words of whole segments -> for each searched word the number of near words that count here, and the best."""
    key = np.stack([rows.column(name).to_numpy() for name in ("key", "c", "d")])
    segment = np.concatenate([[0], np.cumsum((key[:, 1:] != key[:, :-1]).any(axis=0))])
    alone = np.bincount(segment)[segment] == 1
    rows, segment = rows.filter(pa.array(~alone)), segment[~alone]
    words = rows.column("word").to_pylist()
    n, part, size, role = (rows.column(name).to_numpy().astype(np.int64) for name in ("n", "part", "size", "role"))
    spelt = [w.encode("latin-1") for w in words]
    indexed, queries = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
    index = Index(spelt, segment)
    blocked = np.ones(len(words), bool)
    blocked[indexed] = False
    pairs = [np.empty((2, 0), np.int64)]
    for a, b in index.search(segment, queries, size):
        free = ~blocked[b]
        a, b = a[free], b[free]
        # Both words of a pair that is found under a later key must differ in the earlier ones.
        late = part[a] > 0
        keep = ~late
        for at in np.flatnonzero(late):
            x, y = words[a[at]], words[b[at]]
            of = size[a[at]]
            keep[at] = all(p != q for p, q in zip(parts_of(x, of)[: part[a[at]]], parts_of(y, of), strict=False))
        pairs.append(np.stack([a[keep], b[keep]]))
    a, b = np.concatenate(pairs, axis=1)
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=spelt.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    best = np.flatnonzero(np.diff(a, prepend=-1))
    counts = np.diff(np.append(best, len(a)))
    of, top = a[best].tolist(), b[best].tolist()
    return pa.RecordBatch.from_arrays(
        [
            pa.array([words[k] for k in of], pa.string()),
            pa.array(n[of] if of else [], pa.int64()),
            pa.array(counts, pa.int64()),
            pa.array(n[top] if top else [], pa.int64()),
            pa.array([words[k] for k in top], pa.string()),
        ],
        ["word", "n", "near", "top_n", "top"],
    )


def _search_sorted(batches):
    """Batches sorted by (key, c, d) -> results, many whole segments at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(x.num_rows for x in held) < ROWS // 2:
            continue
        rows = pa.Table.from_batches(held)
        key = np.stack([rows.column(name).to_numpy() for name in ("key", "c", "d")])
        change = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0))
        if len(change):
            cut = int(change[-1]) + 1
            yield _search(rows.slice(0, cut))
            held = rows.slice(cut).to_batches()
    if held:
        yield _search(pa.Table.from_batches(held))


def near_words(words: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows (word, n, n_near, top, top_n) for rows (word, n) of distinct words of letters up to U+00FF: how many words are one edit
    away, and of these the one of largest n, ties to the first in code-point order."""
    keyed = words.mapInArrow(_keys, KEYED)
    large = keyed.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > chunk)
    large = materialize(large.select("key", F.ceil(F.col("size") / chunk).cast("int").alias("chunks")), "large-segments")
    whole = keyed.withColumn("c", F.lit(0)).withColumn("d", F.lit(0))
    if not large.isEmpty():
        whole = whole.join(large.select("key"), "key", "left_anti")
        own = F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int")
        dealt = keyed.join(large, "key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        rest = ("key", "part", "size", "word", "n")
        same = F.col("own") == F.col("other")
        # In group (c, d) words of chunk c are indexed and those of chunk d searched.
        indexed = dealt.select(*rest, F.when(same, 3).otherwise(1).alias("role"), F.col("own").alias("c"), F.col("other").alias("d"))
        searched = dealt.where(~same).select(*rest, F.lit(2).alias("role"), F.col("other").alias("c"), F.col("own").alias("d"))
        whole = whole.unionByName(indexed).unionByName(searched)
    met = whole.repartition("key", "c", "d").sortWithinPartitions("key", "c", "d").mapInArrow(_search_sorted, FOUND)
    every = words.select("word", "n", F.lit(0).cast("bigint").alias("near"), F.lit(None).cast("bigint").alias("top_n"), F.lit(None).cast("string").alias("top"))
    best = F.min(F.when(F.col("top").isNotNull(), F.struct((-F.col("top_n")).alias("minus"), "top")))
    found = every.unionByName(met).groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), best.alias("best"))
    return found.select("word", "n", "n_near", F.col("best.top").alias("top"), (-F.col("best.minus")).alias("top_n"))


def follow(links: DataFrame) -> DataFrame:
    """Rows (word, root) for links (word, form) without circles: the last form of each. Every round doubles the way that is known, so
    the number of rounds grows with the logarithm of the longest chain."""
    known = materialize(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = known.select(F.col("word").alias("of"), F.col("root").alias("next"))
        step = known.join(further, F.col("root") == F.col("of"), "left")
        step = materialize(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        known = step.drop("moved")
        if step.where("moved").isEmpty():
            return known


def spelling_variants(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n), one for each word of ``docs`` (doc_id, text).

    A text's runs of letters A-Z, a-z and U+00C0 to U+00FF are lower-cased in A-Z; of one in ``ODDS``, chosen by the checksum of
    doc_id and run, one letter goes. Words of at least ``SHORTEST`` letters and ``LEAST`` occurrences count. A word's form is its near
    word, one edit away, of largest n, if that is at least twice its own; ties go to the first in code-point order. Forms
    grow, so following them ends. Null and empty texts have no words, a null doc_id counts as empty in the
    checksum, repeated rows count each, an empty table has no words. Further columns are ignored."""
    words = materialize(vocabulary(docs), "vocabulary")
    found = near_words(words, chunk)
    enough = F.col("top_n") >= 2 * F.col("n")
    found = materialize(
        found.select("word", F.when(enough, F.col("top")).alias("form"), "n", "n_near", F.when(enough, F.col("top_n")).alias("form_n")), "near-words"
    )
    roots = follow(found.where("form is not null")).withColumnRenamed("word", "of")
    found = found.join(roots, F.col("word") == F.col("of"), "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: Deletion variants in place of bitsets: two words are one edit apart if they agree without the same position, or if one is the other
#: without a position. The checksum goes byte by byte through a table that is derived here.
ORACLE = f"""
WITH RECURSIVE tab AS MATERIALIZED (
  SELECT list(v ORDER BY i) AS v FROM (
    SELECT i, list_reduce(list_concat([i], range(8)), lambda a, b: xor(a >> 1, 3988292384 * (a & 1))) AS v
    FROM (SELECT unnest(range(256)) AS i))
), run AS (
  SELECT doc_id, u AS run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\u00C0-\u00FF]+')) AS u
    FROM documents)
  WHERE length(u) >= {SHORTEST} GROUP BY ALL
), bytes AS (
  SELECT run, k, list_concat([4294967295], flatten(list_transform(string_split(concat(doc_id::VARCHAR, ':', run), ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))) AS b
  FROM run
), sums AS (
  SELECT run, k, xor(4294967295, list_reduce(b, lambda a, x: xor(v[(xor(a, x) & 255) + 1], a >> 8))) AS h FROM bytes, tab
), words AS MATERIALIZED (
  SELECT w, sum(k)::BIGINT AS n FROM (
    SELECT CASE WHEN h % {ODDS} = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS w, k FROM sums)
  GROUP BY w HAVING length(w) >= {SHORTEST} AND sum(k) >= {LEAST}
), cut AS MATERIALIZED (
  SELECT w, n, i, substr(w, 1, i - 1) || substr(w, i + 1) AS x FROM (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.w, b.w AS other, b.n AS m FROM cut a JOIN cut b ON a.x = b.x AND a.i = b.i AND length(a.w) = length(b.w) AND a.w <> b.w
  UNION SELECT cut.w, words.w, words.n FROM cut JOIN words ON cut.x = words.w
  UNION SELECT words.w, cut.w, cut.n FROM cut JOIN words ON cut.x = words.w
), best AS (
  SELECT w, count(*) AS n_near, max(m) AS m FROM pairs GROUP BY w
), form AS MATERIALIZED (
  SELECT p.w, min(p.other) AS form, best.m AS form_n
  FROM pairs p JOIN best ON p.w = best.w AND p.m = best.m JOIN words ON words.w = p.w
  WHERE best.m >= 2 * words.n GROUP BY ALL
), way AS (
  SELECT w, form AS root, 1 AS depth FROM form
  UNION ALL SELECT way.w, form.form, depth + 1 FROM way JOIN form ON way.root = form.w
), last AS (
  SELECT w, arg_max(root, depth) AS root FROM way GROUP BY w
)
SELECT words.w AS word, form.form, coalesce(last.root, words.w) AS root, words.n, coalesce(best.n_near, 0)::BIGINT AS n_near, form.form_n
FROM words LEFT JOIN best ON best.w = words.w LEFT JOIN form ON form.w = words.w LEFT JOIN last ON last.w = words.w
"""
