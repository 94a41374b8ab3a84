"""Benchmark decontamination by suffix arrays over shards of the training text.

Documents are read in shards of a bounded number of bytes. A shard's words are numbered by the words of the
benchmark; runs of known words are laid end to end and their suffixes sorted (prefix doubling). The test suffixes are
sorted as well, so those that begin with the same window lie together, as a class, whatever the number of items that share it. Every
class is then searched in the shard's sorted suffixes, all at once, one word deeper at each step; the interval
that is left at the window's length holds all places of that window. A place belongs to one class of a window length, so
places are never multiplied by items. Each document's longest verbatim match begins at one of its own places: those whose words before
do not match as well are searched on in their class, deeper as long as any of its suffixes matches.

Nothing is shuffled: a document lies in one shard, and the benchmark comes to it in blocks of a fixed number
of words, each broadcast by itself. A task holds one block and one shard at a time."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import add_columns

#: A word is a run of digits, letters and anything beyond ASCII; all other bytes part words.
_WORD_BYTES = frozenset(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
_TO_WORDS = bytes(x if x in _WORD_BYTES else 0x20 for x in range(256)).lower()

SHARD_BYTES = 4 << 20
#: Words of test items in one broadcast block.
BLOCK_WORDS = 1 << 20


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TO_WORDS).split()


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of an array of non-negative numbers, sorted; zeros never tie with each other's place."""
    n = len(text)
    rank, step = text.astype(np.int64), 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - step)] = rank[step:] + 1
        key = rank * (int(rank.max(initial=0)) + 2) + after
        order = np.argsort(key, kind="stable")
        change = np.concatenate([[0], np.cumsum(np.diff(key[order]) > 0)]) if n else np.empty(0, np.int64)
        rank = np.empty(n, np.int64)
        rank[order] = change
        if not n or change[-1] == n - 1 or step > n:
            return order
        step *= 2


class Block:
    """Test items as numbers, their words end to end and parted by zeros, their suffixes sorted and put into classes of equal windows.

    The window of a suffix has ``window`` words, or all of an item of fewer. Suffixes too short for theirs are in no class."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int) -> None:
        self.names = [name for name, _ in items]
        self.number: dict[bytes, int] = {}
        lengths = np.array([len(words) for _, words in items], np.int64)
        self.words = np.array([x for _, words in items for x in [*(self.number.setdefault(w, len(self.number) + 1) for w in words), 0]] + [0], np.int64)
        ends = np.cumsum(lengths + 1) - 1
        item = np.repeat(np.arange(len(items)), lengths + 1)
        offset = np.arange(len(item)) - np.repeat(ends - lengths, lengths + 1)
        size = np.repeat(np.minimum(lengths, window), lengths + 1)
        left = np.repeat(ends, lengths + 1) - np.arange(len(item))
        self.shortest = int(size.min()) if len(items) else window
        # Suffixes that hold their window, by length of window and then in order; ``suffix`` are their starts.
        order = suffix_order(self.words[:-1])
        order = order[left[order] >= size[order]]
        self.suffix = order[np.argsort(size[order], kind="stable")]
        self.item, self.offset = item[self.suffix], offset[self.suffix]
        size = size[self.suffix]
        # A class begins where the window's length or any of its words differs from the suffix before.
        new = np.diff(size, prepend=-1) != 0
        for k in range(int(size.max(initial=0))):
            inside = np.flatnonzero(size > k)
            word = np.zeros(len(size), np.int64)
            word[inside] = self.words[self.suffix[inside] + k]
            new |= (np.diff(word, prepend=-1) != 0) & (size > k)
        self.low = np.flatnonzero(new)
        self.high = np.append(self.low[1:], len(size))
        self.window = size[self.low]
        # The word before all suffixes of a class, -1 if they differ or one begins its item.
        before = np.where(self.offset > 0, self.words[np.maximum(self.suffix - 1, 0)], -1)
        most = np.maximum.reduceat(before, self.low) if len(self.low) else before
        least = np.minimum.reduceat(before, self.low) if len(self.low) else before
        self.before = np.where(most == least, most, -1)
        # Classes with the same items share one list of them; item k alone is list k.
        self.items_of = self.item[self.low].copy()
        self.lists = [np.array([k]) for k in range(len(items))]
        lists: dict[bytes, int] = {}
        for k in np.flatnonzero(self.high - self.low > 1).tolist():
            own = np.unique(self.item[self.low[k] : self.high[k]])
            if len(own) > 1:
                number = lists.setdefault(own.tobytes(), len(self.lists))
                if number == len(self.lists):
                    self.lists.append(own)
                self.items_of[k] = number


def blocks_of(benchmark: DataFrame, window: int):
    """The items with words in blocks, as they come from the table: null ids count as empty strings."""
    held, size = [], 0
    for row in benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").toLocalIterator():
        words = words_of(row.text)
        if words:
            held.append((row.item_id, words))
            size += len(words)
        if size >= BLOCK_WORDS:
            yield Block(held, window)
            held, size = [], 0
    if held:
        yield Block(held, window)


def _bound(text, order, depth, wanted, low, high, after: bool):
    """Binary search in all intervals [low, high) at once: the first place whose word at ``depth`` is not below
    (or, ``after``, is above) the wanted one."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) // 2
        at = np.minimum(order[np.minimum(middle, len(order) - 1)] + depth, len(text) - 1)
        below = (text[at] <= wanted) if after else (text[at] < wanted)
        low = np.where(open_ & below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)
    return low


def search(text: np.ndarray, order: np.ndarray, block: Block) -> np.ndarray:
    """For each class the interval of ``order`` that has its window, empty if none has."""
    n = len(block.low)
    low, high = np.zeros(n, np.int64), np.full(n, len(order), np.int64)
    windows = np.zeros((n, 2), np.int64)
    active, depth = np.arange(n), 0
    while len(active):
        wanted = block.words[block.suffix[block.low[active]] + depth]
        a = _bound(text, order, depth, wanted, low[active], high[active], False)
        b = _bound(text, order, depth, wanted, a, high[active], True)
        found = a < b
        active, a, b = active[found], a[found], b[found]
        depth += 1
        low[active], high[active] = a, b
        whole = block.window[active] == depth
        windows[active[whole]] = np.stack([a[whole], b[whole]], axis=1)
        active = active[~whole]
    return windows


def extend(text: np.ndarray, block: Block, rows: np.ndarray, at: np.ndarray):
    """Of places ``at`` of the classes ``rows``, those that not every suffix of the class extends to the left: (class, place, length to which the
    longest suffix matches to the right, and the interval of suffixes that match so far)."""
    first = ~((at > 0) & (block.before[rows] > 0) & (text[at - 1] == block.before[rows]))
    rows, at = rows[first], at[first]
    size, low, high = block.window[rows].copy(), block.low[rows].copy(), block.high[rows].copy()
    active = np.arange(len(rows))
    while len(active):
        wanted = text[at[active] + size[active]]
        # A run ends in a zero, and so does an item: neither matches on.
        active, wanted = active[wanted > 0], wanted[wanted > 0]
        a = _deeper(block, size[active], wanted, low[active], high[active], False)
        b = _deeper(block, size[active], wanted, a, high[active], True)
        found = a < b
        active = active[found]
        low[active], high[active] = a[found], b[found]
        size[active] += 1
    return rows, at, size, low, high


def _deeper(block: Block, depth: np.ndarray, wanted: np.ndarray, low: np.ndarray, high: np.ndarray, after: bool) -> np.ndarray:
    """As ``_bound``, among the block's own sorted suffixes and with a depth for each interval."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) // 2
        word = block.words[np.minimum(block.suffix[np.minimum(middle, len(block.suffix) - 1)] + depth, len(block.words) - 1)]
        below = (word <= wanted) if after else (word < wanted)
        low = np.where(open_ & below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)
    return low


def _places(intervals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and places of intervals written out."""
    sizes = np.maximum(intervals[:, 1] - intervals[:, 0], 0)
    rows = np.repeat(np.arange(len(intervals)), sizes)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + intervals[rows, 0]


class _Shard:
    """Counts and marks of some documents, filled block by block."""

    def __init__(self, texts: list[str | None]) -> None:
        self.words = [words_of(text) for text in texts]
        lengths = np.array([len(x) for x in self.words], np.int64)
        self.begins = np.cumsum(lengths) - lengths
        self.n = int(lengths.sum())
        self.doc = np.repeat(np.arange(len(texts)), lengths)
        self.hit = np.zeros(self.n + 1, np.int64)
        self.items: list[set[str]] = [set() for _ in texts]
        self.longest: list[tuple] = [(0, None, None, None)] * len(texts)

    def take(self, block: Block) -> None:
        get = block.number.get
        numbers = np.fromiter((get(w, 0) for words in self.words for w in words), np.int64, self.n)
        # Runs of known words within one document that can hold a window, with a zero after each.
        parts = np.flatnonzero((np.diff(numbers > 0, prepend=False)) | (np.diff(self.doc, prepend=-1) > 0))
        ends = np.append(parts[1:], self.n)
        good = (numbers[parts] > 0) & (ends - parts >= block.shortest) if len(parts) else np.empty(0, bool)
        begins, sizes = parts[good], (ends - parts)[good]
        if not len(begins):
            return
        rows, places = _places(np.stack([begins, begins + sizes], axis=1))
        at = np.arange(len(places)) + rows
        text = np.zeros(len(places) + len(begins), np.int64)
        where = np.full(len(text), -1, np.int64)
        text[at], where[at] = numbers[places], places
        order = suffix_order(text)
        rows, places = _places(search(text, order, block))
        at = order[places]
        starts = where[at]
        np.add.at(self.hit, starts, 1)
        np.add.at(self.hit, starts + block.window[rows], -1)
        if len(rows):
            pairs = np.unique(np.stack([self.doc[starts], block.items_of[rows]], axis=1), axis=0)
            ends = np.flatnonzero(np.diff(pairs[:, 0], append=-1)) + 1
            known: dict[bytes, set[str]] = {}  # documents with the same lists of items have the same items
            for begin, end in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                lists = pairs[begin:end, 1]
                key = lists.tobytes()
                if key not in known:
                    known[key] = {block.names[k] for k in np.unique(np.concatenate([block.lists[x] for x in lists])).tolist()}
                doc = pairs[begin, 0]
                self.items[doc] = self.items[doc] | known[key] if self.items[doc] else known[key]
        rows, at, size, low, high = extend(text, block, rows, at)
        starts = where[at]
        doc = self.doc[starts]
        most = np.zeros(len(self.words), np.int64)
        np.maximum.at(most, doc, size)
        best: dict[int, tuple] = {}
        for k in np.flatnonzero(size == most[doc]).tolist():
            if size[k] > self.longest[doc[k]][0]:
                one = slice(low[k], high[k])
                j = np.lexsort((block.offset[one], block.item[one]))[0] + low[k]
                found = (int(block.item[j]), int(starts[k]), int(block.offset[j]), int(size[k]))
                best[doc[k]] = min(best.get(doc[k], found), found)
        for d, (item, start, offset, n) in best.items():
            self.longest[d] = (n, block.names[item], offset, int(start - self.begins[d]))

    def rows(self) -> list[list]:
        covered = np.cumsum(self.hit)[:-1] > 0
        hits = np.bincount(self.doc[covered], minlength=len(self.words)).tolist()
        made: dict[int, tuple] = {}  # by identity: documents share sets of items
        for x in self.items:
            if id(x) not in made:
                names = sorted(x)
                made[id(x)] = names, hashlib.sha256(",".join(names).encode()).hexdigest()
        lists, sums = ([made[id(x)][k] for x in self.items] for k in (0, 1))
        return [[len(x) for x in self.words], hits, lists, sums, *([x[k] for x in self.longest] for k in range(4))]


def _scan(blocks):
    def run(texts: list[str | None]) -> list[list]:
        sizes = np.cumsum([len(x) if x else 0 for x in texts])
        cuts = [0, *(np.flatnonzero(np.diff(sizes // SHARD_BYTES)) + 1), len(texts)]
        out: list[list] = [[] for _ in range(8)]
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            shard = _Shard(texts[begin:end])
            for block in blocks:
                shard.take(block.value)
                if len(blocks) > 1:  # a task holds one block at a time
                    del block._value
            for column, values in zip(out, shard.rows(), strict=True):
                column += values
        return out

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, parts: int = 20) -> DataFrame:
    """The rows of ``docs`` (text, ...) with these columns added: words, hit words, ids of items (item_id, text) with a window in
    it, the longest verbatim match of any test suffix at least a window long, with its item and both
    places, and the decision. A document is contaminated if at least one of ``parts`` words is hit,
    one word at least. Null or empty texts have no words, are not hit and hit nothing; repeated rows are judged
    each; item ids are compared as strings, a null id as an empty one. Of equally long matches the
    first by item and place in the text is named. Columns of the input with one of the added names are replaced."""
    spark = docs.sparkSession
    blocks = [spark.sparkContext.broadcast(block) for block in blocks_of(benchmark, window)]
    added = (
        "n_words bigint, n_hit bigint, items array<string>, items_sha256 string, "
        "longest bigint, longest_item string, item_start bigint, doc_start bigint"
    )
    found = add_columns(docs.drop("contaminated"), added, lambda: _scan(blocks))
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (parts * F.col("n_hit") >= F.col("n_words")))
