"""Language by a string kernel: blended-spectrum presence kernels, Nystroem landmarks, kernel ridge regression.

The kernel of two texts is the number of character n-grams, of one to three characters, that both have, divided by the
root of the product of how many each has. Landmarks are texts of the training sample; a text's features are its
kernels with them, whitened by the landmarks' own kernel matrix. One ridge regression for each language
separates it from all others. Texts are scored in batches, by products of the presence matrix with the
landmarks' presence and of the kernels with the weights.

Texts are lower-cased, and all that are not letters count as one space. N-grams are told apart by a hash of 18 bits."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import add_columns
from clickloom.session import materialize

LANDMARKS = 160
#: Training rows of each language; a language with fewer gives all it has.
SAMPLE = 600
#: Longest text, in characters, that serves in training. Scoring has no limit.
SAMPLE_CHARS = 50_000
#: Characters that the training rows of all languages have together, about, whatever the number of languages.
TOTAL_CHARS = 32_000_000
RIDGE = 1e-3

_BITS = 18
_ROUGH = re.compile(r"[\W\d_]+")
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def grams(text: str) -> np.ndarray | None:
    """Hashes of the distinct n-grams; None for a text without a letter."""
    clean = _ROUGH.sub(" ", text.lower()).strip()
    if not any(map(str.isalpha, clean)):
        return None
    chars = np.frombuffer(f" {clean} ".encode("utf-32-le"), np.uint32)
    seen = np.zeros(1 << _BITS, bool)
    total = np.zeros(len(chars), np.uint32)
    for n in range(3):
        total = total[: len(chars) - n] * np.uint32(31) + (chars[n:] + np.uint32(1)) * _FACTORS[n]
        seen[(total * np.uint32(0x2545F491)) >> np.uint32(32 - _BITS)] = True
    return np.flatnonzero(seen)


class Model:
    """Landmarks as columns of a presence matrix over their own n-grams, and the weights by language."""

    def __init__(self, texts: list[str], langs: list[str]) -> None:
        self.names = sorted(set(langs))
        found = [(x, lang) for x, lang in ((grams(t), lang) for t, lang in zip(texts, langs, strict=True)) if x is not None]
        rows, labels = [x for x, _ in found], np.array([lang for _, lang in found])
        each = max(1, LANDMARKS // max(1, len(self.names)))
        marks = [k for name in self.names for k in np.flatnonzero(labels == name)[:each]]
        used = np.unique(np.concatenate([rows[k] for k in marks])) if marks else np.empty(0, np.int64)
        self.place = np.full(1 << _BITS, -1, np.int32)
        self.place[used] = np.arange(len(used))
        self.marks = np.zeros((len(used), len(marks)), np.float32)
        for column, k in enumerate(marks):
            self.marks[self.place[rows[k]], column] = 1
        self.roots = np.sqrt(np.array([len(rows[k]) for k in marks], np.float32))
        if not marks:
            self.weights = np.zeros((0, len(self.names)))
            return
        own = self.kernel([rows[k] for k in marks]).astype(np.float64)
        values, vectors = np.linalg.eigh(own)
        kept = values > values.max() * 1e-6
        whiten = vectors[:, kept] / np.sqrt(values[kept])
        features = self.kernel(rows).astype(np.float64) @ whiten
        wanted = (labels[:, None] == np.array(self.names)[None, :]).astype(np.float64)
        # A language weighs as much as any other, however many rows the sample has of it.
        share = (1 / wanted.sum(axis=0).clip(1))[wanted.argmax(axis=1)][:, None]
        solved = np.linalg.solve(features.T @ (features * share) + RIDGE * np.eye(features.shape[1]), features.T @ (wanted * share))
        self.weights = whiten @ solved

    def kernel(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.empty((len(rows), self.marks.shape[1]), np.float32)
        for at in range(0, len(rows), 256):
            part = rows[at : at + 256]
            present = np.zeros((len(part), self.marks.shape[0]), np.float32)
            for k, row in enumerate(part):
                known = self.place[row]
                present[k, known[known >= 0]] = 1
            sizes = np.sqrt(np.array([len(x) for x in part], np.float32))
            out[at : at + 256] = present @ self.marks / (sizes[:, None] * self.roots[None, :])
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        rows = [grams(text or "") for text in texts]
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        at = [k for k, x in enumerate(rows) if x is not None] if self.names and self.marks.shape[1] else []
        if at:
            values = self.kernel([rows[k] for k in at]) @ self.weights
            for k, best, value in zip(at, values.argmax(axis=1), values.max(axis=1).clip(0, 1), strict=True):
                names[k], scores[k] = self.names[best], float(value)
        return names, scores


def training_rows(docs: DataFrame, per_language: int = SAMPLE) -> list:
    """At most about ``per_language`` rows (text, lang) of each language, and of each an equal part of ``TOTAL_CHARS``, by
    a hash of the text; the rows are sorted, so that each run learns the same."""
    usable = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.length("text") <= SAMPLE_CHARS))
    counts = materialize(usable.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")), "languages")
    each = TOTAL_CHARS / max(1, counts.count())
    share = F.lit(2.0**63) * F.least(F.lit(per_language) / F.col("n"), F.lit(each) / F.greatest("chars", F.lit(1)), F.lit(1.0))
    # One row for each language, as the model has one regression for each: texts are not dealt by language.
    picked = usable.join(F.broadcast(counts), "lang").where(F.abs(F.xxhash64("text")).cast("double") <= share)
    # Copies of one text share a hash, so a large group of them counts once.
    picked = picked.select("text", "lang").distinct()
    return sorted(picked.collect(), key=lambda row: (row.lang, row.text))


def predict_language(docs: DataFrame, train: DataFrame) -> DataFrame:
    """The rows of ``docs`` (text, ...) with lang_pred and score added, learnt from ``train`` (text, lang).

    ``und`` with score 0 stands for null texts, for texts without a letter, and for all if there was nothing to learn
    from. The score is the winning regression's value, cut to 0..1; ties go to the first name. Repeated rows get
    the same answer. Columns of the input with one of the added names are replaced."""
    rows = training_rows(train)
    model = docs.sparkSession.sparkContext.broadcast(Model([r.text for r in rows], [r.lang for r in rows]))

    return add_columns(docs, "lang_pred string, score double", lambda: model.value.predict)
