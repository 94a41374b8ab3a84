"""Spelling variants, whitening and license scans against brute force, and on odd rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from clickloom.llm import license_scan as licenses
from clickloom.llm import spelling, whitening
from clickloom.llm.queries import QUERIES

# --- spelling variants


def vocabulary_by_hand(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def variants_by_hand(rows):
    words = vocabulary_by_hand(rows)
    near = {a: [b for b in words if one_edit(a, b)] for a in words}
    form = {}
    for a, others in near.items():
        if others:
            best = min(others, key=lambda b: (-words[b], b))
            if words[best] >= 2 * words[a]:
                form[a] = best

    def root(a):
        while a in form:
            a = form[a]
        return a

    return {(a, form.get(a), root(a), n, len(near[a]), words.get(form.get(a))) for a, n in words.items()}


def texts(seed, words, length):
    rng = random.Random(seed)
    known = ["".join(rng.choice("abé") for _ in range(rng.choice([4, 5, 6, 7, 8]))) for _ in range(words)]
    return [(i, " ".join(rng.choice(known[: 1 + rng.randrange(len(known))]) for _ in range(length))) for i in range(80)]


@pytest.mark.parametrize("chunk", [spelling.CHUNK, 5])
def test_spelling_variants_equal_brute_force(spark, chunk):
    rows = texts(3, 300, 60)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = spelling.spelling_variants(docs, chunk)
    want = variants_by_hand(rows)
    assert {tuple(row) for row in found.collect()} == want and found.count() == len(want)
    assert any(form and root != form for _, form, root, *_ in want)  # a chain


def test_runs_are_those_of_the_pattern():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("abXYZ éÉ×ÿÀ¿Ā中😀'-1́\n") for _ in range(40))
        want = [run.translate({k: k + 32 for k in range(65, 91)}) for run in re.findall("[A-Za-zÀ-ÿ]+", text)]
        assert [x.decode() for x in spelling.runs_of(text)] == want


def test_long_words_and_segments_of_many_lanes():
    import pyarrow as pa

    rng = random.Random(2)
    words = sorted({"".join(rng.choice("ab") for _ in range(9)) for _ in range(400)} | {"x" * 3000, "x" * 3001, "y" + "x" * 2999})
    counts = [rng.randrange(3, 9) for _ in words]
    keyed = pa.Table.from_batches(spelling._keys([pa.RecordBatch.from_arrays([pa.array(words), pa.array(counts)], ["word", "n"])]))
    zeros = pa.array([0] * keyed.num_rows, pa.int32())
    out = spelling._search(keyed.append_column("c", zeros).append_column("d", zeros).sort_by("key")).to_pylist()
    near = Counter()
    for row in out:
        near[row["word"]] += row["near"]
    assert near == Counter({a: n for a in words if (n := sum(one_edit(a, b) for b in words if abs(len(a) - len(b)) < 2 and a != b))})


def test_spelling_variants_of_odd_rows(spark, odd, nothing):
    rows = [(row.doc_id, row.text) for row in odd.collect()]
    assert {tuple(row) for row in spelling.spelling_variants(odd).collect()} == variants_by_hand(rows)
    assert spelling.spelling_variants(nothing).collect() == []


def test_follow_long_chains(spark):
    links = spark.createDataFrame([(f"w{k:02}", f"w{k + 1:02}") for k in range(37)], "word string, form string")
    assert {row.root for row in spelling.follow(links).collect()} == {"w37"}


# --- whitening

VECTORS = "vec_id bigint, embedding array<float>, label int, deviation string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], VECTORS)


def test_whitening_equals_dense_formulas(spark, folder):
    found = QUERIES["op12_whitening"](spark, folder).toPandas()
    table = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    x = np.floor(64 * np.stack(table.embedding.to_numpy()).astype(float)) + 1_000_000
    n, centred = len(x), x - x.sum(axis=0) / len(x)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    want = centred @ vectors[:, :32] / np.sqrt(values[:32])
    mine = found.pivot(index="vec_id", columns="component", values="whitened").loc[table.vec_id].to_numpy()
    assert np.abs(mine * np.sign((mine * want).sum(axis=0)) - want).max() < 1e-8
    assert found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-9 and (found.n == n).all()
    assert np.allclose(found.groupby("component").explained.first(), values[:32] / values.sum(), rtol=1e-9)
    exact = ((n * x.astype(int).astype(object) - x.astype(int).astype(object).sum(axis=0)) ** 2).sum(axis=1)
    assert found.groupby("vec_id").deviation.first().loc[table.vec_id].tolist() == exact.tolist()


def test_covariances_are_exact(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 5)) @ rng.normal(size=(5, 5)) * 3
    model = whitening.fit(frame(spark, [(k, v.tolist()) for k, v in enumerate(x.astype(np.float32))]).repartition(7))
    y = np.floor(64 * x.astype(np.float32).astype(float)).astype(int) + 1_000_000
    n, s = 300, y.astype(object).sum(axis=0)
    cov = np.array([[float(sum((n * a - s[i]) * (n * b - s[j]) for a, b in zip(y[:, i].tolist(), y[:, j].tolist(), strict=True)) / n**3) for j in range(5)] for i in range(5)])
    assert np.allclose(model.vectors @ np.diag(model.values) @ model.vectors.T, cov, rtol=1e-12, atol=1e-10)
    assert (model.middle * n + model.rest == s.astype(int)).all()


def test_whitening_drops_unusable_rows_and_keeps_copies(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(5)
    good = [(k, rng.normal(size=3).astype(np.float32).tolist()) for k in range(20)]
    good += [(3, good[3][1]), (None, good[4][1])]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [nan, 1.0, 2.0]), (104, [inf, 1.0, 2.0]), (105, [1.0, 2.0])]
    found = whitening.whitened_rows(frame(spark, good + bad).repartition(4)).toPandas()
    assert len(found) == 3 * len(good) and (found.n == len(good)).all() and found.vec_id.isna().sum() == 3
    assert found.identity_error[0] < 1e-9
    carried = whitening.whiten(frame(spark, good), whitening.fit(frame(spark, good)))
    assert carried.columns == ["vec_id", "embedding", "label", "deviation", "whitened"] and carried.schema["deviation"].dataType.typeName() == "long"


def test_whitening_without_variance_or_rows(spark):
    assert whitening.whitened_rows(frame(spark, [])).count() == 0
    assert whitening.whitened_rows(frame(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whitening.whitened_rows(frame(spark, [(k, [1.0, float(k)]) for k in range(4)])).count() == 4  # one direction alone


def test_whitening_of_very_large_entries(spark):
    rows = [(k, [float(k) * 1e11, float(k % 3)]) for k in range(9)] + [(9, [3.0e38, 1.0])]
    found = whitening.whitened_rows(frame(spark, rows)).toPandas()
    assert len(found) in (10, 20) and np.isfinite(found.whitened).all() and found.deviation.isna().any()


# --- licenses


def scan_by_hand(text):
    """All rules on the whole text, base phrases word by word, and every two detections compared."""
    words = re.findall("[^\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    joined = " ".join(words)
    found = []
    for rule in licenses.rules():
        for m in re.finditer(rule.pattern.pattern.decode(), joined):
            found.append((joined[: m.start(1)].count(" "), joined[: m.end(1)].count(" "), rule))
    kept = [
        d for d in found
        if d[2].base or not any(
            e is not d and not e[2].base and e[0] <= d[0] and d[1] <= e[1]
            and (-e[2].priority, e[0] - e[1], e[2].order) < (-d[2].priority, d[0] - d[1], d[2].order)
            for e in found
        )
    ]
    base = [
        (k, label)
        for phrase, label in licenses.BASE.items()
        for k in range(len(words))
        if words[k : k + len(phrase.split())] == phrase.split()
    ]
    places = [k for k, _ in base]
    return (
        len(words), len(base), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in base})),
        ",".join(sorted({rule.label for _, _, rule in kept})), sorted((a, b, rule.label) for a, b, rule in kept),
    )


def phrases(seed):
    rng = random.Random(seed)
    pieces = [
        "GNU General Public License", "version 2", "or (at your option) any later version", "Apache License", "Version 2.0", "CC BY", "CC-BY-SA 4.0", "CC BY-NC",
        "4.0", "MIT License", "mit", "Lesser", "GPL-3.0-or-later", "GPLv2", "BSD 3-Clause License", "all rights reserved", "Copyright (c) 2001", "the terms of", "cc by cc by",
        "Permission is hereby granted, free of charge, to any person obtaining a copy", "word", "license", "public domain", "in the public domain", "Mozilla Public License, v. 2.0",
        "subject to the terms of the", "This Source Code Form is", "creativecommons.org/licenses/by-nc-sa/4.0", "SPDX-License-Identifier: Apache-2.0", "Straße", "gnu", "X11",
    ]
    return " ".join(rng.choice(pieces) + rng.choice(["", ",", ".", "\n"]) for _ in range(rng.randrange(1, 60)))


def test_license_scan_equals_brute_force():
    for seed in range(150):
        text = phrases(seed)
        *mine, score, places = licenses.scan(text)
        *want, kept = scan_by_hand(text)
        assert mine == want and 0 <= score <= 1
        assert sorted((x["first"], x["last"], x["label"]) for x in places) == kept


def sample(rng, parsed):
    """A random string that a parsed pattern matches."""
    out = []
    for op, value in parsed:
        op = str(op)
        if op == "LITERAL":
            out.append(chr(value))
        elif op == "IN":
            kind, x = value[0]
            out.append("x" if str(kind) == "CATEGORY" and "SPACE" in str(x) else "7" if str(kind) == "CATEGORY" else chr(x) if str(kind) == "LITERAL" else chr(x[0]))
        elif op == "BRANCH":
            out.append(sample(rng, rng.choice(value[1])))
        elif op == "SUBPATTERN":
            out.append(sample(rng, value[3]))
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            out += [sample(rng, value[2]) for _ in range(rng.randint(value[0], min(int(value[1]), value[0] + 2)))]
        elif op == "ASSERT":
            out.append(sample(rng, value[1]))
    return "".join(out)


def test_every_rule_is_gated_by_words_of_its_own_matches():
    rng = random.Random(7)
    labels = [rule.label for rule in licenses.rules()]
    assert len(labels) > 200 and labels[:4] == list(licenses.BASE.values())
    for rule in licenses.rules():
        parsed = re._parser.parse(rule.pattern.pattern.decode())
        for _ in range(40):
            text = sample(rng, parsed)
            words = licenses.words_of(text)
            assert b" ".join(words).decode() == text and any(rule is found for *_, found in licenses.detections(words)), (rule.label, text)


@pytest.mark.parametrize("text, labels", [
    ("Licensed under the Apache License, Version 2.0", {"apache", "apache-2.0"}),
    ("This work is licensed under the GNU General Public License, version 3", {"gpl", "gpl-3.0"}),
    ("Licensed under CC BY-NC 4.0", {"cc-by", "cc-by-nc-4.0"}),
    ("GNU Lesser General Public License v2.1", {"lgpl-2.1"}),
    ("either version 2 of the License, or (at your option) any later version", set()),
    ("ich komme mit der Lizenz", set()),
])
def test_known_notices(text, labels):
    assert set(filter(None, licenses.scan(text)[5].split(","))) == labels


def test_license_scan_of_odd_rows(spark, odd, nothing):
    docs = odd.selectExpr("*", "'old' as labels")
    found = licenses.license_scan(docs)
    rows = found.collect()
    assert len(rows) == odd.count() and found.columns.count("labels") == 1 and found.columns[-8:-1] == [x.split()[0] for x in licenses.ADDED.split(", ")[:7]]
    for row in rows:
        *want, _ = scan_by_hand(row.text)
        assert [row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels, row.labels] == want
    assert licenses.license_scan(nothing).collect() == []


def test_license_query_equals_brute_force(spark, folder):
    text = {row.doc_id: row.text for row in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    for row in QUERIES["op13_licenses"](spark, folder).collect():
        *want, _ = scan_by_hand(text[row.doc_id])
        assert [row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels, row.labels] == want


def test_a_long_text_of_many_places():
    text = "mit license gpl 3 " * 40_000
    n_words, n_base, first, last, base, labels, _, places = licenses.scan(text)
    assert (n_words, n_base, first, last, base, labels) == (160_000, 40_000, 0, 159_996, "mit", "gpl-3.0,mit") and len(places) == 80_000
