import collections
import hashlib
import random
import re

import numpy as np
import pytest

from clickloom.llm import near_dup
from clickloom.llm.common import RollingHash, components
from clickloom.llm.exact_dup import exact_duplicates
from clickloom.llm.fuse_filter import FuseFilter
from clickloom.llm.near_dup import near_duplicates, similar
from clickloom.llm.repeated_text import COVERS, remove_repeated

GAP = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in GAP.split(text or "") if w]


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = [[rng.choice(vocabulary) for _ in range(rng.randrange(1, 160))] for _ in range(n // 3)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    while len(texts) < n:
        base = list(rng.choice(texts))
        kind = rng.random()
        for _ in range(rng.randrange(0, 6) if kind < 0.7 else 0):
            base[rng.randrange(len(base))] = rng.choice(vocabulary)
        if kind > 0.85:
            base += passage
        texts.append(base)
    return [(k * 3 + 1, " ".join(t).replace("w1", "W1")) for k, t in enumerate(texts)]


def linked(rows, size, above, of):
    """Component by doc_id, from all pairs."""
    sets = {}
    for i, text in rows:
        w = words(text.translate({k: k + 32 for k in range(65, 91)}))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and of * len(sets[i] & sets[j]) >= above * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize(("size", "above"), [(3, 85), (5, 80)])
def test_near_duplicates_are_those_of_all_pairs(spark, size, above, monkeypatch):
    monkeypatch.setattr(near_dup, "CHUNK", 4)
    monkeypatch.setattr(near_dup, "CHUNK_BYTES", 4096)
    rows = corpus(size)
    found = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), size, above).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == linked(rows, size, above, 100)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_duplicates_of_odd_rows(odd, nothing):
    found = sorted(((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(odd).collect()))
    by_id = {r[0]: r[1:] for r in found}
    assert len(found) == 11
    assert by_id[1] == (1, 1, True) and by_id[7] == (1, 1, False) and by_id[0] == (1, 1, False)
    assert by_id[2] == by_id[9][:0] + (0, 2, True) and by_id[3] == (0, 3, True) and by_id[4] == (0, 4, True)
    assert by_id[6][1:] == (5, False)
    assert near_duplicates(nothing).count() == 0


def test_long_lists_are_joined_as_short_ones():
    rng = np.random.default_rng(2)
    low = rng.integers(0, 3, (90, near_dup.COORDINATES)).astype(np.uint8)
    agree = (low[:, None, :] == low[None, :, :]).sum(-1) >= 26
    assert np.array_equal(near_dup._labels(agree[None])[0], near_dup._swept(low, 26))


def test_long_lists_are_joined_over_sparse_links():
    rng = np.random.default_rng(4)

    def walk(start, members, steps):
        rows = [start]
        for _ in range(members - 1):
            rows.append(rows[-1].copy())
            rows[-1][rng.choice(near_dup.COORDINATES, steps, replace=False)] = rng.integers(0, 256, steps)
        return rows

    def own(low):
        found = near_dup._swept(low, near_dup.MATCHES)
        want = near_dup._labels(((low[:, None, :] == low[None, :, :]).sum(-1) >= near_dup.MATCHES)[None])[0]
        assert np.array_equal(want, found)
        return len(set(found.tolist()))

    hub = np.zeros(near_dup.COORDINATES, np.uint8)
    path = np.stack([hub, hub, hub, hub])  # links 0-2, 2-3, 3-1 alone
    path[2, :20], path[3, :40], path[1, :60] = 1, 1, 1
    assert own(path) == 1
    leaves = np.stack([hub] * 60)  # two stars, joined by their last leaves alone
    leaves[30:, :60] = 1
    for k in range(1, 29):
        leaves[[k, 30 + k], 60 + k % 4] = 2 + k
    leaves[29, :20], leaves[59, 40:60] = 1, 0
    assert own(leaves) == 1
    for steps in (5, 15, 25, 27, 40):
        starts = rng.integers(0, 256, (3, near_dup.COORDINATES)).astype(np.uint8)
        low = np.stack([row for start in starts for row in walk(start, 40, steps)])
        own(low[rng.permutation(len(low))])


def test_similar_counts_whole_sets():
    sets = [np.arange(a, b, dtype=np.uint64) for a, b in ((0, 100), (10, 100), (20, 120), (500, 501))]
    assert similar(sets, 80, 100).tolist() == [
        [True, True, False, False], [True, True, False, False], [False, False, True, False], [False, False, False, True]
    ]


def test_tasks_compare_a_bounded_number_of_short_sets(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "CHUNK_SETS", 20)
    monkeypatch.setattr(near_dup, "components", lambda edges, name: edges.sparkSession.createDataFrame(joined[name], "node binary, root binary"))
    texts = [f"x{k} " + " ".join(f"w{j}" for j in range(60)) for k in range(200)]
    digests = [near_dup._digest(near_dup.shingle_set(t.encode().split(), 5, near_dup.WordHash())) for t in texts]
    joined = {"near": [(d, min(digests)) for d in digests], "linked": []}
    asked = []
    whole = near_dup._meet
    monkeypatch.setattr(near_dup, "_meet", lambda df, key, chunks: asked.append(whole(df, key, chunks)) or asked[-1])
    near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).count()
    sizes = [r["count"] for r in asked[-1].groupBy("root", "c", "d").count().collect()]
    assert len(sizes) == 55 and max(sizes) <= 80
    assert sum(sizes) == 200 * 10


def test_components_of_a_path_a_star_and_a_cycle(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), "test").collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), **dict.fromkeys((200, 201, 202), 200)}


@pytest.mark.parametrize("n", [1, 2, 10, 5000, 60_000])
def test_filters_hold_their_keys_and_few_others(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 2**63, n, dtype=np.uint64)
    one = FuseFilter.build(np.concatenate([keys, keys[:1]]))
    assert one.holds(keys).all()
    assert one.holds(rng.integers(2**63, 2**64, 20_000, dtype=np.uint64)).mean() < 0.01


def test_exact_duplicates_do_not_depend_on_batches(spark, odd, nothing):
    rng = random.Random(1)
    texts = [f"text  {rng.randrange(25)}\t!" for _ in range(200)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    first, size = {}, collections.Counter()
    for i, t in enumerate(texts):
        first.setdefault(GAP.sub(" ", t), i)
        size[GAP.sub(" ", t)] += 1
    want = sorted((i, first[n], size[n], first[n] == i, hashlib.sha256(n.encode()).hexdigest()) for i, n in ((i, GAP.sub(" ", t)) for i, t in enumerate(texts)))
    for batch in (None, rows.doc_id * 0, rows.doc_id % 7):
        assert sorted(map(tuple, exact_duplicates(rows, batch).collect())) == want
    found = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_duplicates(odd).collect()}
    assert found == {
        (1, 1, 4, True), (7, 1, 4, False), (None, 1, 4, False), (2, 2, 3, True), (3, 2, 3, False), (9, 2, 3, False),
        (4, 4, 1, True), (5, 5, 1, True), (6, 6, 1, True), (8, 8, 1, True),
    }
    assert exact_duplicates(nothing).count() == 0


def without_repeats(rows, size):
    counts = collections.Counter(tuple(w[k : k + size]) for _, t in rows for w in [words(t)] for k in range(len(w) - size + 1))
    out = []
    for i, text in rows:
        w = words(text)
        keep = [True] * len(w)
        for k in range(len(w) - size + 1):
            if counts[tuple(w[k : k + size])] > 1:
                keep[k : k + size] = [False] * size
        out.append((i or 0, " ".join(x for x, y in zip(w, keep, strict=True) if y), len(w), keep.count(False)))
    return sorted(out)


@pytest.mark.parametrize(("size", "v"), [(35, 21), (12, 7), (8, 7), (50, 31), (50, None)])
def test_repeated_windows_are_those_of_counting_all(spark, size, v, monkeypatch):
    monkeypatch.setattr("clickloom.llm.repeated_text.BLOCK_BYTES", 4096)
    rows = corpus(9) + [(9000, " ".join(["same"] * 90)), (9001, " ".join(f"u{k % 40}" for k in range(120)))]
    found = remove_repeated(spark.createDataFrame(rows, "doc_id bigint, text string"), size, v).collect()
    assert sorted((r.doc_id, r.kept_text, r.n_words, r.n_removed) for r in found) == without_repeats(rows, size)


def test_repeated_windows_of_odd_rows(odd, nothing):
    found = remove_repeated(odd, 8, 7, digest=True).collect()
    want = without_repeats([(r.doc_id, r.text) for r in odd.collect()], 8)
    assert sorted((r.doc_id or 0, r.kept_sha256, r.n_words, r.n_removed) for r in found) == sorted((i, hashlib.sha256(t.encode()).hexdigest(), n, m) for i, t, n, m in want)
    assert remove_repeated(nothing).count() == 0


@pytest.mark.parametrize("v", COVERS)
def test_covers_align_any_two_positions(v):
    assert {(a - b) % v for a in COVERS[v] for b in COVERS[v]} == set(range(v))


def test_rolling_hashes_depend_on_the_window_alone():
    x = np.random.default_rng(0).integers(0, 2**63, 50, dtype=np.uint64)
    one, two = RollingHash().windows(x, 7), RollingHash().windows(np.concatenate([x[20:30], x]), 7)
    assert np.array_equal(one, two[10:]) and len(set(one.tolist())) == 44 and len(RollingHash().windows(x[:3], 7)) == 0


def test_null_ids_and_copies_meet_by_their_texts(spark, monkeypatch):
    """Many near copies without an id, each several times: one component, and no class stands for all rows without an id."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    texts = [" ".join(base[:k] + [f"x{k}"] + base[k + 1 :]) for k in range(60)] + ["something else altogether " * 3]
    rows = [(None, text) for text in texts for _ in range(4)] + [(7, texts[0]), (9, texts[-1])]
    found = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)).collect()
    assert len(found) == len(rows)
    by_size = {(row.n_shingles > 20, row.component_id) for row in found}
    assert by_size == {(True, 7), (False, 9)}
    assert sorted(row.doc_id for row in found if row.kept) == [7, 9]
