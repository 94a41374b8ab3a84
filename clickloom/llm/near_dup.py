"""Near duplicates: an inverted join of signature coordinates, checked on whole shingle sets.

A text's set holds the hashes of its distinct shingles of ``words`` words, lower-cased A-Z. Texts with equal
sets form a class, told by a digest of the set, and everything that follows works on classes: copies are
never expanded into pairs. The signature has ``COORDINATES`` smallest values under as many permutations, so
two sets agree in each coordinate with a probability equal to their similarity.

* Postings. Any two signatures that agree in ``MATCHES`` coordinates share one of the first
  ``COORDINATES - MATCHES + 1`` entries of each, in any order that is the same for all. The order puts
  coordinate-value pairs of rare buckets first, by counts in a table of fixed size, so the long lists of
  common passages are skipped and serve only in counting.
* Counting. Members of a list meet with one byte of each coordinate, and whoever agrees in ``MATCHES`` or more
  is joined with the smallest such class of the list. Lists are cut into chunks, and every two chunks meet
  in a group of their own, so no task holds a long list. A list gives fewer links than it has members.
* Checking. The components of these links are the candidate groups. Their texts are read again, and intersections
  of whole sets are counted by products of incidence matrices, two chunks at a time. Links at or above the
  threshold give the components that are returned.

At a similarity of 0.85 a pair agrees in fewer than 38 of 64 coordinates with a probability below 1e-6;
at 0.8, the default threshold, below 1e-4. For lower thresholds pass fewer ``matches``."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import WordHash, components, groups, mix
from clickloom.session import materialize

COORDINATES = 64
MATCHES = 38
#: Entries of the table of counts that orders the postings, whatever the size of the corpus.
RARITY = 1 << 16
#: Members of a list, and bytes and number of sets of a group, that one task compares with as many others.
CHUNK = 4096
SMALL = 48
CHUNK_BYTES = 4 << 20
CHUNK_SETS = 2048

_FACTORS = np.random.default_rng(20240607).integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPOTS = np.random.default_rng(11).integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(words: list[bytes], size: int, hashes: WordHash) -> np.ndarray:
    """Sorted hashes of the distinct shingles; a shorter text is one shingle, an empty one has none."""
    if not words:
        return np.empty(0, np.uint64)
    found = hashes.of(words)
    n = min(size, len(found))
    total = np.zeros(len(found) - n + 1, np.uint64)
    for k in range(n):
        total += found[k : len(found) - n + 1 + k] * _SPOTS[k % 16] ** np.uint64(1 + k // 16)
    return np.unique(mix(total + np.uint64(n)))


def signature(found: np.ndarray) -> np.ndarray:
    least = np.full(COORDINATES, 2**32 - 1, np.uint32)
    for at in range(0, len(found), 4096):
        part = (found[at : at + 4096, None] * _FACTORS) >> np.uint64(32)
        least = np.minimum(least, part.min(axis=0).astype(np.uint32))
    return least


def _digest(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def _sketches(size: int):
    def run(batches):
        hashes = WordHash()
        for batch in batches:
            counts, digests, signatures = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingle_set((text or "").encode().lower().split(), size, hashes)
                counts.append(len(found))
                digests.append(_digest(found) if len(found) else None)
                signatures.append(signature(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())],
                ["doc_id", "text_hash", "n_shingles", "digest", "sig"],
            )

    return run


def _matrix(column, width: int, kind=np.uint8) -> np.ndarray:
    """Binary values of one length as rows of an array."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _entries(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit number for each coordinate-value pair."""
    return mix((np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32)) + signatures.astype(np.uint64) + np.uint64(1))


def _bucket_counts(batches):
    counts = np.zeros(RARITY, np.int64)
    for batch in batches:
        if batch.num_rows:
            buckets = _entries(_matrix(batch.column("sig"), COORDINATES, np.uint32)) % np.uint64(RARITY)
            counts += np.bincount(buckets.ravel().astype(np.int64), minlength=RARITY)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(counts[seen])], ["bucket", "n"])


def _postings(counts, prefix: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            entries = _entries(_matrix(batch.column("sig"), COORDINATES, np.uint32))
            common = counts.value[(entries % np.uint64(RARITY)).astype(np.int64)]
            order = np.lexsort((entries, common), axis=1)[:, :prefix]
            keys = np.take_along_axis(entries, order, axis=1).view(np.int64)
            rows = np.repeat(np.arange(batch.num_rows), prefix)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), batch.column("digest").take(pa.array(rows))], ["key", "digest"])

    return run


def _labels(linked: np.ndarray) -> np.ndarray:
    """For link matrices (groups, members, members): the smallest member that each can reach."""
    n = linked.shape[-1]
    linked = linked | np.eye(n, dtype=bool)
    label = np.broadcast_to(np.arange(n, dtype=np.int32), linked.shape[:-1])
    while True:
        lower = np.where(linked, label[:, None, :], n).min(-1)
        if np.array_equal(lower, label):
            return label
        label = lower


def _swept(low: np.ndarray, matches: int) -> np.ndarray:
    """For one long list what ``_labels`` gives. Members are dealt to seeds that they meet. The coordinates in which
    two members differ are a distance, so a member at distance r of its seed can only meet others up to r further away
    than the seed does: those that the seed does not meet itself are compared with it."""
    n, reach = len(low), COORDINATES - matches
    columns = np.ascontiguousarray(low.T)
    label, left = np.arange(n), np.ones(n, bool)

    def differ(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), len(others)), np.uint8)
        for column in columns:
            out += column[rows][:, None] != column[others]
        return out

    def join(names: np.ndarray) -> None:
        names = np.unique(names)
        if len(names) > 1:
            label[np.isin(label, names)] = names[0]

    everyone = np.arange(n)
    while left.any():
        one = left.argmax()
        far = differ(everyone[one : one + 1], everyone)[0].astype(np.int64)
        met = far <= reach
        met[one] = True
        join(label[met])
        own = np.flatnonzero(met & left)
        left[own] = False
        own = own[np.argsort(far[own], kind="stable")]
        step = max(1, (1 << 22) // n)
        for at in range(0, len(own), step):
            rows = own[at : at + step]
            ring = np.flatnonzero(~met & (far <= reach + far[rows[-1]]) & (label != label[one]))
            if len(ring):
                linked = differ(rows, ring) <= reach
                for k in np.flatnonzero(linked.any(axis=1)):
                    join(np.append(label[ring[linked[k]]], label[rows[k]]))
    return label


def _collide(matches: int):
    """Links within lists: batches have rows of (key, c, d, digest, low), sorted by the first three."""

    def linked(low: np.ndarray) -> np.ndarray:
        agree = np.zeros((low.shape[0], low.shape[1], low.shape[1]), np.uint8)
        for k in range(COORDINATES):
            agree += low[:, :, None, k] == low[:, None, :, k]
        return agree >= matches

    def links(low: np.ndarray, names: np.ndarray):
        """Groups of one size: (groups, members, coordinates) and their digests."""
        step = max(1, (1 << 24) // low.shape[1] ** 2)
        for at in range(0, len(low), step):
            label = _labels(linked(low[at : at + step]))
            g, i = np.nonzero(label != np.arange(low.shape[1]))
            yield names[at + g, i], names[at + g, label[g, i]]

    def batch_of(pairs):
        a, b = (np.concatenate(x) if x else np.empty(0, object) for x in zip(*pairs, strict=True)) if pairs else ([], [])
        return pa.RecordBatch.from_arrays([pa.array(list(a), pa.binary()), pa.array(list(b), pa.binary())], ["a", "b"])

    def run(batches):
        small: dict[int, list] = {}
        held = 0

        def flush():
            pairs = []
            for rows in small.values():
                low = np.stack([x for x, _ in rows])
                names = np.empty(low.shape[:2], object)
                for k, (_, digests) in enumerate(rows):
                    names[k] = digests
                pairs += links(low, names)
            small.clear()
            return batch_of(pairs)

        for _, rows in groups(batches, ["key", "c", "d"]):
            if rows.num_rows < 2:
                continue
            digests = np.array(rows.column("digest").to_pylist(), object)
            order = np.argsort(digests)
            low = _matrix(rows.column("low"), COORDINATES)[order]
            if len(order) > SMALL:
                label = _swept(low, matches)
                moved = np.flatnonzero(label != np.arange(len(label)))
                yield batch_of([(digests[order][moved], digests[order][label[moved]])])
                continue
            small.setdefault(len(order), []).append((low, digests[order]))
            held += len(order) ** 2
            if held > 1 << 22:
                yield flush()
                held = 0
        if small:
            yield flush()

    return run


def _sets(size: int):
    def run(batches):
        hashes, seen = WordHash(), set()
        for batch in batches:
            # Repeated rows of a class's text need one set: each task sends it once.
            fresh = [not (digest in seen or seen.add(digest)) for digest in batch.column("digest").to_pylist()]
            batch = batch.filter(pa.array(fresh, pa.bool_()))
            found = [shingle_set((text or "").encode().lower().split(), size, hashes) for text in batch.column("text").to_pylist()]
            same = [_digest(x) == digest for x, digest in zip(found, batch.column("digest").to_pylist(), strict=True)]
            seen.difference_update(digest for ok, digest in zip(same, batch.column("digest").to_pylist(), strict=True) if not ok)
            keep = batch.filter(pa.array(same, pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                [keep.column("root"), keep.column("digest"), keep.column("chunks"), pa.array([x.tobytes() for x, ok in zip(found, same, strict=True) if ok], pa.binary())],
                ["root", "digest", "chunks", "found"],
            )

    return run


def similar(sets: list[np.ndarray], above: int, of: int) -> np.ndarray:
    """Matrix of the pairs with of * intersection >= above * union."""
    lengths = np.array([len(x) for x in sets])
    rows = np.repeat(np.arange(len(sets)), lengths)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    rows, column = rows[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    both = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    width = 4096
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        begin, end = np.searchsorted(column, [at, at + width])
        part = np.zeros((len(sets), width), np.float32)
        part[rows[begin:end], column[begin:end] - at] = 1
        both += part @ part.T
    np.fill_diagonal(both, lengths)
    linked = np.empty(both.shape, bool)
    for at in range(0, len(sets), 256):  # so that there is one matrix of numbers alone
        some = np.rint(both[at : at + 256]).astype(np.int64)
        linked[at : at + 256] = of * some >= above * (lengths[at : at + 256, None] + lengths[None, :] - some)
    return linked


def _confirm(above: int, of: int):
    def run(batches):
        for _, rows in groups(batches, ["root", "c", "d"]):
            if rows.num_rows < 2:
                continue
            # Tasks that read copies of a text sent the same set each.
            digests, order = np.unique(np.array(rows.column("digest").to_pylist(), object), return_index=True)
            values = rows.column("found").to_pylist()
            label = _labels(similar([np.frombuffer(values[k], np.uint64) for k in order], above, of)[None])[0]
            moved = np.flatnonzero(label != np.arange(len(label)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(digests[moved]), pa.binary()), pa.array(list(digests[label[moved]]), pa.binary())], ["a", "b"]
            )

    return run


def _meet(df: DataFrame, key: str, chunks) -> DataFrame:
    """Rows of a key in groups (key, c, d), so that every two of its chunks meet in one group."""
    own = F.pmod(F.xxhash64("digest", F.lit(7)), F.col("chunks"))
    return (
        df.withColumn("chunks", chunks).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks").cast("int") - 1)))
        .withColumn("c", F.least("own", F.col("other").cast("bigint"))).withColumn("d", F.greatest("own", F.col("other").cast("bigint")))
        .drop("chunks", "own", "other")
        .repartition(key, "c", "d").sortWithinPartitions(key, "c", "d")
    )


def near_duplicates(docs: DataFrame, words: int = 5, above: int = 80, of: int = 100, matches: int = MATCHES) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one for each row of ``docs`` (doc_id, text).

    Texts with of * intersection >= above * union are linked, and a component is named by its smallest
    doc_id. Texts without words, null texts included, are linked with nothing and kept. Repeated rows and
    rows of one doc_id get the same decision as far as they are in one component; a null doc_id counts for
    nothing in the minimum, and is kept only where a component has no other. Further columns are ignored.

    Writes the sketches, the candidate links and the components to the shared folder."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    sketches = materialize(
        docs.mapInArrow(_sketches(words), "doc_id bigint, text_hash bigint, n_shingles bigint, digest binary, sig binary"), "sketches"
    )
    nodes = sketches.where("digest is not null").groupBy("digest").agg(F.min("sig").alias("sig"))
    nodes = materialize(nodes, "classes")

    counts = np.zeros(RARITY, np.int64)
    summed = nodes.select("sig").mapInArrow(_bucket_counts, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    for row in summed.collect():  # RARITY rows at most
        counts[row.bucket] = row.n
    shared = spark.sparkContext.broadcast(counts)

    postings = nodes.mapInArrow(_postings(shared, COORDINATES - matches + 1), "key bigint, digest binary")
    lists = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    low = F.unhex(F.regexp_replace(F.hex("sig"), "(..)......", "$1"))
    members = postings.join(lists, "key").join(nodes.select("digest", low.alias("low")), "digest")
    meeting = _meet(members, "key", F.ceil(F.col("n") / CHUNK)).select("key", "c", "d", "digest", "low")
    near = components(meeting.mapInArrow(_collide(matches), "a binary, b binary"), "near")

    # One text of each class stands for it, found again by doc_id and hash of the text, so that rows of one doc_id do not all meet.
    one = F.min(F.struct(F.col("doc_id").isNull().alias("lacking"), "doc_id", "text_hash")).alias("one")
    first = sketches.where("digest is not null").groupBy("digest").agg(one, F.max("n_shingles").alias("n"))
    wanted = near.withColumnRenamed("node", "digest").join(first, "digest")
    wanted = materialize(wanted.select("root", "digest", "n", F.col("one.doc_id").alias("of_doc"), F.col("one.text_hash").alias("of_text")), "wanted")
    chunks = F.greatest(F.ceil(F.sum("n") * 8 / CHUNK_BYTES), F.ceil(F.count("*") / CHUNK_SETS))
    # Written, so that the join meets plain shuffles, of which a large component can be split.
    sizes = materialize(wanted.groupBy("root").agg(chunks.alias("chunks")), "component-sizes")
    wanted = wanted.join(sizes, "root").select("of_doc", "of_text", "root", "digest", "chunks")
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_hash") == F.col("of_text")))
    found = texts.select("text", "root", "digest", "chunks").mapInArrow(
        _sets(words), "root binary, digest binary, chunks bigint, found binary"
    )
    meeting = _meet(found, "root", F.col("chunks")).select("root", "c", "d", "digest", "found")
    exact = components(meeting.mapInArrow(_confirm(above, of), "a binary, b binary"), "linked")

    placed = sketches.join(exact.withColumnRenamed("node", "digest"), "digest", "left")
    placed = placed.select("doc_id", "n_shingles", F.coalesce("root", "digest").alias("root"))
    # Written, so that the join below meets two plain shuffles and can split the rows of a large component.
    least = placed.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    least = materialize(least, "smallest")
    placed = placed.join(least, "root", "left")
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return placed.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
