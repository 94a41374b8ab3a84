"""Toxicity by compression distance: how much shorter a window gets with a dictionary of toxic text.

Two zstandard dictionaries share a part trained on ordinary text, so what they know of ordinary words is the same
to the byte and cancels out. The toxic one has in front the words that mark toxic text: those that begin
with a segment whose document frequencies speak for the toxic class by a likelihood ratio beyond a fixed level of
significance. Near copies of a text say the same thing again, so they count once and stay in one half. A window is a
fixed number of words between short carriers from the shared part, because the compressor gives up on very short input
and finds no match in its last bytes. The distance is the compressed length with the ordinary dictionary less that with the toxic
one. A window with a distance is taken apart, and the distance of each of its words measured in the same way. Over
the whole text, the largest distance of a word, the sum of distances above one by number of words, and the share and number of words
beyond a threshold go into a logistic regression.

The regression and its threshold come from one half of the sampled rows, with dictionaries of the other
half, so the calibration has not seen the words; the final dictionaries come from both. The threshold with
the best F1 is mapped to a score of 0.7."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import WordHash, add_columns
from clickloom.llm.near_dup import shingle_set, signature

#: Most training rows of each class.
SAMPLE = {1: 3000, 0: 6000}
#: Longest text, in bytes, that serves in training. Scoring has no limit.
SAMPLE_BYTES = 100_000
THRESHOLD = 0.7
WINDOW = 12
LEVEL = 6
#: Most bytes of the part that is trained on ordinary text; the words in front of it are as many as there are.
DICTIONARY = 32 << 10
CARRIER = 40
#: Distance of a window that is looked at word by word, and of a word that counts as toxic.
NEAR, FAR = 1, 3
_SHORTEST, _LONGEST = 4, 12
#: Probability that any segment at all that says nothing of the class marks it, shared out over those that are tested.
ERROR = 0.05


def _words(text: str) -> list[bytes]:
    return text.lower().encode().split()


def windows(text: str) -> list[bytes]:
    words = _words(text)
    return [b" " + b" ".join(words[k : k + WINDOW]) + b" " for k in range(0, len(words), WINDOW)]


def families(texts: list[str]) -> dict[str, str]:
    """For each text the first of which it is a near copy: half of the signature of its three-word shingles is the same."""
    hashes, first, seen = WordHash(), {}, defaultdict(list)
    for text in texts:
        if text in first:
            continue
        own = signature(shingle_set(_words(text), 3, hashes))
        near = Counter(other for entry in enumerate(own.tolist()) for other in seen.get(entry, ()))
        best, n = near.most_common(1)[0] if near else (text, 0)
        first[text] = best if 2 * n >= len(own) else text
        if first[text] is text:
            for entry in enumerate(own.tolist()):
                seen[entry].append(text)
    return first


def _segments(texts: list[str], first: dict[str, str]) -> tuple[Counter, Counter]:
    """Document frequencies of beginnings of words, the whole word included, and of words; near copies count once."""
    starts, words, members = Counter(), Counter(), defaultdict(list)
    for text in texts:
        members[first[text]].append(text)
    for family in members.values():
        own = {b" " + w + b" " for text in family for w in _words(text)}
        words.update(own)
        starts.update({w[:n] for w in own for n in range(_SHORTEST, min(_LONGEST, len(w)) + 1)})
    return starts, words


def marking_words(toxic: list[str], ordinary: list[str], first: dict[str, str] | None = None) -> list[bytes]:
    """Words of toxic texts that begin with a segment that marks them, the more frequent ones last."""
    first = families(toxic + ordinary) if first is None else first
    n, m = len({first[t] for t in toxic}), len({first[t] for t in ordinary})
    (bad, words), (good, _) = _segments(toxic, first), _segments(ordinary, first)

    def ratio(a: int, b: int) -> float:
        """Log likelihood ratio of frequencies a of n and b of m against one common frequency."""
        p = (a + b) / (n + m)
        return sum(k * math.log(k / t / p) + (t - k) * (math.log((1 - k / t) / (1 - p)) if k < t else 0) for k, t in ((a, n), (b, m)) if k) + (
            0 if b else -m * math.log(1 - p)
        )

    tested = [s for s, a in bad.items() if a >= 3]
    least = math.log(max(len(tested), 1) / ERROR)
    marks = {s for s in tested if bad[s] * m > 50 * n * (good[s] + 0.5) and ratio(bad[s], good[s]) > least}
    # Of nested segments the longest that still stands for most of the shorter one's texts.
    longer = Counter()
    for s in marks:
        for k in range(_SHORTEST, len(s)):
            longer[s[:k]] = max(longer[s[:k]], bad[s])
    marks = {s for s in marks if longer[s] < 0.8 * bad[s]}
    found = [w for w in words if any(w[:k] in marks for k in range(_SHORTEST, _LONGEST + 1))]
    return sorted(found, key=lambda w: (words[w], w))


class Model:
    """Dictionaries and weights; compressors are made where they are used."""

    def __init__(self, toxic: list[str], ordinary: list[str]) -> None:
        first = families(toxic + ordinary)
        halves = [[t for t in texts if zlib.crc32(first[t].encode()) % 2 == k] for texts in (toxic, ordinary) for k in (0, 1)]
        self.shared, self.toxic = self._dictionaries(halves[0] or toxic, halves[2] or ordinary, first)
        self.compressors = None
        self.mean, self.scale, self.weights, self.shift = np.zeros(4), np.ones(4), np.zeros(5), 0.0
        if not toxic or not ordinary:
            self.weights[-1] = -5.0
            return
        bad, good = halves[1] or toxic, halves[3] or ordinary
        x = np.array([self.features(t) for t in bad + good])
        y = np.array([1.0] * len(bad) + [0.0] * len(good))
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = np.c_[(x - self.mean) / self.scale, np.ones(len(x))]
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))
            curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag([1.0] * 4 + [1e-3])
            self.weights = self.weights + np.linalg.solve(curve, x.T @ (y - p) - np.array([1.0] * 4 + [1e-3]) * self.weights)
        value = x @ self.weights
        order = np.argsort(-value, kind="stable")
        hits = np.cumsum(y[order])
        f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
        # Midway to the next value below, if texts of the same value are not parted.
        ends = np.flatnonzero(np.append(np.diff(value[order]) < 0, True))
        k = ends[f1[ends].argmax()]
        if k + 1 < len(value):
            cut = (value[order][k] + value[order][k + 1]) / 2
        else:  # the best that can be done is to call all toxic: nothing was learnt, so nothing is
            cut = value.max() + 1
        self.shift = math.log(THRESHOLD / (1 - THRESHOLD)) - cut
        self.shared, self.toxic = self._dictionaries(toxic, ordinary, first)
        self.compressors = None

    @staticmethod
    def _dictionaries(toxic: list[str], ordinary: list[str], first: dict[str, str]) -> tuple[bytes, bytes]:
        samples = [w for text in ordinary for w in windows(text)]
        try:
            shared = zstandard.train_dictionary(DICTIONARY, samples, k=64, d=8, level=LEVEL).as_bytes()
        except zstandard.ZstdError:  # too little text to train on: the text itself
            shared = b"".join(samples)[-DICTIONARY:]
        marks = marking_words(toxic, ordinary, first) if toxic and ordinary else []
        return shared, b"".join(marks)

    def _distance(self):
        """Function from a window to its distance."""
        if self.compressors is None:
            self.compressors = []
            for content in (self.shared, self.toxic + self.shared):
                params = zstandard.ZstdCompressionParameters.from_level(
                    LEVEL, source_size=WINDOW * 7, dict_size=len(self.toxic) + len(self.shared), write_content_size=False, write_checksum=False, write_dict_id=False
                )
                dictionary = zstandard.ZstdCompressionDict(content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                dictionary.precompute_compress(compression_params=params)
                self.compressors.append(zstandard.ZstdCompressor(compression_params=params, dict_data=dictionary).compress)
        ordinary, toxic = self.compressors
        before, after = self.shared[-CARRIER:], self.shared[-CARRIER : -CARRIER // 2]
        return lambda window: len(ordinary(x := before + window + after)) - len(toxic(x))

    def features(self, text: str) -> list[float]:
        far, words, distance = [], 0, self._distance()
        for window in windows(text):
            words += window.count(b" ") - 1
            if distance(window) >= NEAR:
                far += [x for x in (distance(b" " + word + b" ") for word in window.split()) if x > 0]
        large = sum(x >= FAR for x in far)
        return [min(max(far, default=0), 8.0), math.log1p(100 * sum(x - 1 for x in far) / max(words, 1)), math.log1p(100 * large / max(words, 1)), math.log1p(large)]

    def score(self, text: str | None) -> float:
        x = (np.array(self.features(text or "")) - self.mean) / self.scale
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, x @ self.weights[:4] + self.weights[4] + self.shift)))))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"compressors": None}


def training_rows(docs: DataFrame, labels: DataFrame) -> list:
    """At most about ``SAMPLE`` rows (text, toxic) of each class, by a hash of doc_id, sorted so that each run learns the
    same. Ids are chosen among the labels, so only the few chosen texts are moved. The larger label counts."""
    labels = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {row.toxic: row.n for row in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("toxic") == label, F.lit(min(1.0, SAMPLE[label] / n) * 2.0**63)).otherwise(share)
    picked = labels.where(F.abs(F.xxhash64("doc_id")).cast("double") <= share).withColumnRenamed("doc_id", "label_id")
    # At most about 9,000 ids.
    found = docs.join(F.broadcast(picked), F.col("doc_id") == F.col("label_id"))
    found = found.where(F.octet_length("text") <= SAMPLE_BYTES).groupBy("text").agg(F.max("toxic").alias("toxic"))
    return sorted(found.collect(), key=lambda row: row.text)


def toxicity(docs: DataFrame, labels: DataFrame, train: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) with score and predicted added.

    Learns from the rows of ``labels`` (doc_id, toxic) whose texts are in ``train``, by default in ``docs``. Null and empty
    texts have no window, so they get the score of a text without any sign; so has every text if a class has no
    row. Repeated rows get the same score. Columns of the
    input with one of the added names are replaced."""
    rows = training_rows((docs if train is None else train).select("doc_id", "text"), labels)
    texts = {k: [row.text for row in rows if row.toxic == k] for k in (0, 1)}
    model = docs.sparkSession.sparkContext.broadcast(Model(texts[1], texts[0]))

    def compute():
        return lambda batch: [[model.value.score(text) for text in batch]]

    scored = add_columns(docs.drop("predicted"), "score double", compute)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
