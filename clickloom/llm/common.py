"""What several text operators share: words, hashes of word windows and connected components."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.session import materialize

#: A word is a run of anything but these white-space characters; `bytes.split()` cuts the same way.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

_CACHE_WORDS = 500_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def add_columns(docs: DataFrame, added: str, compute) -> DataFrame:
    """``docs`` with columns that a function derives from batches of texts.

    Rows stay where they are and all their columns are carried; columns with an added name are replaced.
    ``compute()`` is called once for each task and returns a function from a list of texts to the columns' values."""
    fields = T.StructType.fromDDL(added).fields
    names = [field.name for field in fields]
    docs = docs.drop(*names)

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(field.dataType) for field in fields]
        work = compute()
        for batch in batches:
            found = work(batch.column("text").to_pylist())
            columns = [pa.array(x, kind) for x, kind in zip(found, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))


class WordHash(dict):
    """64-bit hash of each word. Words that were seen are looked up; the table starts anew when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RollingHash:
    """Hashes of all windows of a sequence of word hashes, by sums of w[j] * R**j modulo 2**64."""

    R = 0x9E3779B97F4A7C15 | 1
    R_INVERSE = pow(R, -1, 2**64)

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            self.up, self.down = (
                np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, r, np.uint64)]))
                for r in (self.R, self.R_INVERSE)
            )

    def windows(self, words: np.ndarray, size: int) -> np.ndarray:
        """Hash of words[i : i + size] for each i that has so many words after it."""
        n = len(words)
        if n < size:
            return np.empty(0, np.uint64)
        self._grow(n)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * self.up[:n])])
        return mix((sums[size:] - sums[:-size]) * self.down[: n - size + 1] + np.uint64(size))


def groups(batches, keys: list[str]):
    """Tables of equal keys from batches whose rows are sorted by these keys; one group is held at a time."""
    import pyarrow as pa

    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(key).to_numpy(zero_copy_only=False) for key in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for column in columns:
            change |= column[1:] != column[:-1]
        starts = np.concatenate([[0], np.flatnonzero(change) + 1, [batch.num_rows]])
        for begin, end in zip(starts[:-1], starts[1:], strict=True):
            key = tuple(column[begin] for column in columns)
            if held and key != last:
                yield last, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, end - begin))
            last = key
    if held:
        yield last, pa.Table.from_batches(held)


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of the links (a, b): rows (node, root), root being the smallest node.

    Alternates two steps that hang every node on the smallest node it knows, first those above it, then
    those below it. The links stay as many or get fewer, and the number of rounds grows with the
    logarithm of the longest path. Each round is a written table; nodes that are not linked are not
    returned. A node with very many links is combined before the shuffle in the minimum and split by
    the adaptive join afterwards."""
    links = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name
    )
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        lowest = materialize(lowest, name)  # so that the joins meet plain shuffles, of which large keys can be split
        hung = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = materialize(hung.where("u <> v").distinct(), name)
        lowest = materialize(hung.groupBy("u").agg(F.min("v").alias("m")), name)
        below = hung.join(lowest, "u")
        links = materialize(
            below.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(lowest.select("u", F.col("m").alias("v")))
            .distinct(),
            name,
        )
        if links.join(links.select(F.col("v").alias("u")), "u", "left_semi").isEmpty():
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
