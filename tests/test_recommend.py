"""Recommendation against dense numpy formulas on small random logs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators import products
from clickloom.plans import recommend
from clickloom.schema import BEHAVIORS
from clickloom.session import materialize, materialize_and_free
from tests.conftest import rows_of


def random_log(seed, users=30, items=20, rows=260, hot=True):
    rng = np.random.default_rng(seed)
    found = []
    for _ in range(rows):
        user, item = int(rng.integers(users)), int(rng.integers(items))
        if hot and rng.random() < 0.35:
            user = 0  # one user with a third of all rows
        if hot and rng.random() < 0.35:
            item = 3
        found.append((user * 7, item * 11, 1, BEHAVIORS[int(rng.integers(4))], 0))
    return found


def dense(model):
    cells = model.cells.collect()
    users, items = sorted({c["user_id"] for c in cells}), sorted({c["item_id"] for c in cells})
    matrix = np.zeros((len(users), len(items)))
    for c in cells:
        matrix[users.index(c["user_id"]), items.index(c["item_id"])] = c["weight"]
    return users, items, matrix


def cosine(matrix):
    norm = np.linalg.norm(matrix, axis=1, keepdims=True)
    norm[norm == 0] = 1
    sim = (matrix / norm) @ (matrix / norm).T
    np.fill_diagonal(sim, 0)
    return sim


def expected_scores(matrix):
    return matrix @ cosine(matrix.T), cosine(matrix) @ matrix


def best(scores, seen, items, k):
    order = [(-round(float(s), 6), item, float(s)) for s, item, was in zip(scores, items, seen) if not was and s > 0]
    return [(item, round(s, 9)) for _, item, s in sorted(order)[:k]]


@pytest.fixture(params=["salted", "groups"])
def branch(monkeypatch, request):
    """Many groups, with and without salts; results leave in small batches."""
    monkeypatch.setattr(products, "WORK", 3000)
    monkeypatch.setattr(products, "FLUSH", 7)
    if request.param == "salted":
        monkeypatch.setattr(products, "REACH", 60)
        monkeypatch.setattr(products, "PACK", 3)


def test_scores_and_similarities(log, branch):
    model = recommend.rating_model(log(random_log(1)))
    users, items, matrix = dense(model)
    by_item, by_user = expected_scores(matrix)
    found = {(r["user_id"], r["item_id"]): r for r in recommend.score_matrix(model).collect()}
    wanted = {
        (u, i): (by_item[a, b], by_user[a, b])
        for a, u in enumerate(users)
        for b, i in enumerate(items)
        if matrix[a, b] == 0 and (by_item[a, b] > 0 or by_user[a, b] > 0)
    }
    assert found.keys() == wanted.keys()
    for key, (item_score, user_score) in wanted.items():
        assert found[key]["item_score"] == pytest.approx(item_score, abs=1e-9)
        assert found[key]["user_score"] == pytest.approx(user_score, abs=1e-9)

    for similar, ids, sims in (
        (recommend.item_similarity(model, 1000), items, cosine(matrix.T)),
        (recommend.user_similarity(model, 1000), users, cosine(matrix)),
    ):
        pairs = {(r[0], r["neighbour"]): r["sim"] for r in similar.collect()}
        rows, columns = np.nonzero(sims)
        assert pairs.keys() == {(ids[a], ids[b]) for a, b in zip(rows, columns)}
        for a, b in zip(rows, columns):
            assert pairs[ids[a], ids[b]] == pytest.approx(sims[a, b], abs=1e-12)


@pytest.mark.parametrize("seed", [2, 3])
def test_recommendations(log, branch, seed):
    model = recommend.rating_model(log(random_log(seed)))
    users, items, matrix = dense(model)
    found = {}
    for r in recommend.recommend(model, 3).orderBy("rank").collect():
        found.setdefault((r["algorithm"], r["user_id"]), []).append((r["item_id"], round(r["score"], 9)))
    for algorithm, scores in zip(("ItemCF", "UserCF"), expected_scores(matrix)):
        for at, user in enumerate(users):
            assert found.get((algorithm, user), []) == best(scores[at], matrix[at] > 0, items, 3)


def test_hit_rate(log, branch):
    model = recommend.rating_model(log(random_log(4)))
    users, items, matrix = dense(model)
    training, hidden = matrix.copy(), {}
    for at in range(len(users)):
        present = np.flatnonzero(training[at])
        if len(present) >= 3:
            hidden[at] = present[np.argmax(training[at][present])]
            training[at, hidden[at]] = 0
    rows = rows_of(recommend.leave_one_out(model)[1])
    assert rows == sorted((users[a], items[b]) for a, b in hidden.items())
    pool = np.mean([len(items) - (training[at] > 0).sum() for at in hidden])
    for row in recommend.evaluate(model).collect():
        scores = expected_scores(training)[0 if row["algorithm"] == "ItemCF" else 1]
        hits = sum(
            items[b] in [item for item, _ in best(scores[a], training[a] > 0, items, 5)] for a, b in hidden.items()
        )
        assert (row["evaluated_users"], row["hits"]) == (len(hidden), hits)
        assert row["hit_rate"] == pytest.approx(hits / len(hidden))
        assert row["random_hit_rate"] == pytest.approx(5 / pool)
        assert row["lift"] == pytest.approx(hits / len(hidden) / (5 / pool))


def test_thresholds_are_the_only_limits(log):
    rows = [(u, i, 1, "pv", 0) for i, n in ((5, 3), (4, 3), (9, 4), (1, 1)) for u in range(n)]
    model = recommend.rating_model(log(rows))
    assert rows_of(model.cells) == [(u, i, 1) for u in range(3) for i in (4, 5, 9)]
    stats = recommend.matrix_stats(model).first()
    assert (stats["n_users"], stats["n_items"], stats["cells"], stats["density"]) == (3, 3, 9, 1.0)
    assert (model.users.entities, model.items.entities, model.users.largest, model.items.pairs) == (3, 3, 3, 27)


def test_a_user_with_a_third_of_all_rows(log, branch):
    rows = random_log(3) + [(999, i % 30, 1, "pv", i) for i in range(len(random_log(3)) // 2)]
    model = recommend.rating_model(log(rows))
    users, items, matrix = dense(model)
    by_item, _ = expected_scores(matrix)
    found = {(r["user_id"], r["item_id"]): r["item_score"] for r in recommend.score_matrix(model).collect()}
    wanted = {(u, i): by_item[a, b] for a, u in enumerate(users) for b, i in enumerate(items) if not matrix[a, b] and by_item[a, b] > 0}
    assert wanted.keys() <= found.keys() and all(found[key] == pytest.approx(value) for key, value in wanted.items())


def test_activity_counts_rows_and_weight_is_the_heaviest(log):
    rows = [(1, 5, 1, "pv", 0), (1, 5, 1, "buy", 1), (1, 5, 1, "fav", 2), (2, 5, 1, "pv", 0)]
    assert rows_of(recommend.rating_model(log(rows)).cells) == [(1, 5, 4)]


def test_heaviest_cell_needs_three_cells_and_takes_the_lowest_id(spark):
    cells = spark.createDataFrame(
        [(1, 9, 4), (1, 3, 4), (1, 2, 1), (2, 1, 4), (2, 2, 4)], "user_id long, item_id long, weight int"
    )
    model = recommend.RatingModel.of(cells)
    training, hidden = recommend.leave_one_out(model)
    assert rows_of(hidden) == [(1, 3)]
    assert rows_of(training.cells) == [(1, 2, 1), (1, 9, 4), (2, 1, 4), (2, 2, 4)]


def test_isolated_user_gets_the_hot_list(log):
    rows = [(u, i, 1, kind, 0) for u in (1, 2) for i, kind in ((10, "pv"), (11, "cart"))]
    rows += [(1, 12, 1, "buy", 0), (2, 13, 1, "buy", 0), (3, 12, 1, "buy", 0), (2, 12, 1, "pv", 0), (4, 13, 1, "pv", 0)]
    df = log(rows)
    hot = recommend.hot_items(df, 2)
    assert [tuple(r) for r in hot.collect()] == [(11, 2, 1), (12, 2, 2)]
    table = recommend.recommendation_table(recommend.rating_model(df))
    covered = {r["user_id"] for r in table.collect()}
    listed = recommend.fallback(df, table, hot)
    assert {r["user_id"] for r in listed.collect()} == {1, 2, 3, 4} - covered != set()
    assert listed.columns == ["user_id", "algorithm", "rank", "item_id", "interactions"]
    shown = recommend.served(df, table, hot).collect()
    assert {r["user_id"] for r in shown} == {1, 2, 3, 4}
    assert {r["user_id"] for r in shown if r["source"] == "Hot"} == {1, 2, 3, 4} - covered


def test_published_table_has_every_user_and_rounds(log):
    model = recommend.rating_model(log(random_log(6)))
    rows = recommend.recommendation_table(model, k=2).collect()
    assert {r["user_id"] for r in rows} == {r["user_id"] for r in recommend.recommend(model).collect()}
    assert max(r["rank"] for r in rows) == 2 and all(r["score"] == round(r["score"], 4) for r in rows)


def test_examples_name_first_users_and_the_smallest(log):
    df = log(random_log(7))
    model = recommend.rating_model(df)
    sizes = {r["user_id"]: r["n"] for r in model.cells.groupBy("user_id").agg(F.count("*").alias("n")).collect()}
    rows = recommend.example_lists(model, recommend.hot_items(df)).collect()
    assert {r["user_id"] for r in rows if r["example"] == "first"} <= set(sorted(sizes)[:3])
    cold = min(sizes, key=lambda user: (sizes[user], user))
    assert {(r["user_id"], r["algorithm"]) for r in rows if r["example"] == "cold"} == {(cold, "Hot")}


def test_model_without_pairs(log):
    df = log([(1, 10, 1, "pv", 0), (2, 10, 1, "pv", 0), (1, 10, 1, "buy", 0), (2, 10, 1, "fav", 0)])
    model = recommend.rating_model(df)
    assert recommend.recommend(model).collect() == []
    assert recommend.item_similarity(model).collect() == []
    assert rows_of(recommend.user_similarity(model)) == [(1, 1, 2, 1.0), (2, 1, 1, 1.0)]
    assert [r["evaluated_users"] for r in recommend.evaluate(model).collect()] == [0, 0]


def test_groups_follow_the_work():
    assert products.groups_for(0, 5, 8) == 1
    assert products.groups_for(10**6, 500, 8) == 1
    assert products.groups_for(3 * 10**7, 500, 8) == 8  # as many as cores, as long as they have something to do
    assert products.groups_for(10**10, 500, 8) == 96  # whole rounds of tasks
    assert products.groups_for(10**10, 7, 8) == 7


def test_cells_travel_only_to_groups_that_reach_them(spark, monkeypatch):
    """Islands that share nothing: a group of one island gets no cell of another, however many groups there are."""
    monkeypatch.setattr(products, "WORK", 1)
    rows = [(island * 10 + u, island * 10 + i, 1 + (u * i) % 4) for island in range(40) for u in range(3) for i in range(3)]
    model = recommend.RatingModel.of(spark.createDataFrame(rows, "user_id long, item_id long, weight int"))
    sent = []
    placed = products._placed
    monkeypatch.setattr(products, "_placed", lambda rows, parts: sent.append(rows.select(F.sum(F.size("entity"))).first()[0]) or placed(rows, parts))
    assert recommend.item_similarity(model).count() == 40 * 3 * 2
    assert sent[0] <= 3 * len(rows)  # at most the three groups of an island's items


@pytest.mark.parametrize("reach", [10**6, 60, 5])
def test_many_entities_have_the_same_results(log, monkeypatch, reach):
    """Without the table of all pairs: blocks of reached entities, and partial sums where a group reaches too much."""
    for name, value in (("FEW", 0), ("WORK", 3000), ("SMALL_WORK", 1000), ("FLUSH", 7), ("PACK", 3), ("TABLE", 64), ("REACH", reach)):
        monkeypatch.setattr(products, name, value)
    test_scores_and_similarities(log, None)
    test_recommendations(log, None, 2)
    test_hit_rate(log, None)


@pytest.mark.parametrize("few", [0, 1024])
def test_a_task_passes_on_only_the_best(log, monkeypatch, few):
    """Tasks that reach more than ``REACH`` cells once passed on every pair that they met, not only the nearest."""
    monkeypatch.setattr(products, "FEW", few)
    monkeypatch.setattr(products, "REACH", 100)
    monkeypatch.setattr(products, "HELD", 10**6)
    model = recommend.rating_model(log([(u, (u * j) % 40, 1, "pv", j) for u in range(150) for j in range(1, 8)]))
    assert model.users.cells > 4 * products.REACH
    cells = model.cells.selectExpr("user_id AS entity", "item_id AS shared", "weight").join(
        model.cells.groupBy(F.col("user_id").alias("entity")).agg(F.sum(F.col("weight") * F.col("weight")).alias("square")), "entity"
    )
    kept = lambda k: products.neighbours(cells, model.users.entities, model.items, k, 0.0).groupBy("entity").count().agg(F.sum("count")).first()[0]
    if not few:
        assert kept(1) < kept(None) / 2
    lists = recommend._scores(model, None, 1).groupBy("user_id").count().agg(F.max("count"), F.sum("count")).first()
    assert lists[1] < recommend._scores(model, None, None).count() / 2


def test_there_are_no_more_copies_of_the_cells_than_cores(spark, monkeypatch):
    """Users and items that all meet, with work for very many groups: each cell is sent to a group once, and to a core's one at most."""
    monkeypatch.setattr(products, "FEW", 0)
    monkeypatch.setattr(products, "WORK", 1)
    monkeypatch.setattr(products, "SMALL_WORK", 1)
    rows = [(u, i, 1 + (u * i) % 4) for u in range(100) for i in range(30) if (u + i) % 3]
    model = recommend.RatingModel.of(spark.createDataFrame(rows, "user_id long, item_id long, weight int"))
    sent = []
    placed = products._placed
    monkeypatch.setattr(products, "_placed", lambda rows, parts: sent.append((parts, rows)) or placed(rows, parts))
    assert recommend.score_matrix(model).count() == 100 * 30 - len(rows)
    parts, travelled = sent.pop()
    cores = spark.sparkContext.defaultParallelism
    assert parts <= cores
    assert travelled.select(F.sum(F.size("item_id"))).first()[0] <= cores * (len(rows) + 30)


def few_of_many(seed, users=240, items=6000, each=9):
    """Users who reach only a small part of the items, some of whom share several."""
    rng = np.random.default_rng(seed)
    cells = {(int(u), int(i)): int(rng.integers(1, 5)) for u in range(users) for i in rng.integers(0, items // 4, each) * 4 % (items - u % 3)}
    cells |= {(u, 7): 2 for u in range(0, users, 40)} | {(users, i): 1 for i in range(items)}
    return [(u * 3, i * 5 - 900, w) for (u, i), w in cells.items()]


@pytest.mark.parametrize("weight", ["int", "double"])
@pytest.mark.parametrize("line", [3, 8])
def test_many_items_of_which_users_reach_few(spark, monkeypatch, weight, line):
    """Both sums are added up in one number, and only what these can leave among the best gets whole sums; other weights are added up one by one."""
    for name, value in (("FEW", 0), ("LINE", line), ("STRETCH", 50), ("RUN", 70), ("PACK", 5), ("SMALL_WORK", 1000)):
        monkeypatch.setattr(products, name, value)
    monkeypatch.setattr(products._Lines, "width", line)
    rows = [(u, i, w if weight == "int" else w / 8) for u, i, w in few_of_many(11) if u < 720]
    monkeypatch.setattr(products, "COVERED", 0)
    model = recommend.RatingModel.of(spark.createDataFrame(rows, f"user_id long, item_id long, weight {weight}").repartition(5))
    users, items, matrix = dense(model)
    for k in (2, 5):
        found = {}
        for r in recommend.recommend(model, k).orderBy("rank").collect():
            found.setdefault((r["algorithm"], r["user_id"]), []).append((r["item_id"], round(r["score"], 9)))
        for algorithm, scores in zip(("ItemCF", "UserCF"), expected_scores(matrix)):
            for at, user in enumerate(users):
                assert found.get((algorithm, user), []) == best(scores[at], matrix[at] > 0, items, k)


def test_cells_are_not_joined_where_each_group_meets_all(log, monkeypatch):
    """Each group of users meets every user many times: the cells were once joined twice to find that out, and once more with the norms."""
    monkeypatch.setattr(products, "FEW", 0)
    model = recommend.rating_model(log(random_log(9, users=60, items=20, rows=900)))
    written = []
    monkeypatch.setattr(products, "materialize", lambda df, name, **options: written.append(name) or materialize(df, name, **options))
    monkeypatch.setattr(recommend, "materialize", products.materialize)
    lists = recommend._scores(model, None, 3)
    assert written == [] and lists._jdf.queryExecution().optimizedPlan().toString().count("Join") == 0
    assert lists.count() > 0


def test_recommendations_with_two_readers_are_made_once(log, monkeypatch):
    made = []
    monkeypatch.setattr(recommend, "materialize", lambda df, name, **options: made.append(name) or materialize(df, name, **options))
    df = log(random_log(5))
    model = recommend.rating_model(df)
    shown = recommend.served(df, recommend.recommendation_table(model), recommend.hot_items(df))
    assert made[-1] == "recommended" and shown._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 0
    assert {r["user_id"] for r in shown.collect()} == {r["user_id"] for r in df.select("user_id").distinct().collect()}


def test_hidden_cells_of_users_without_enough_stay(spark):
    cells = spark.createDataFrame([(1, 9, 4), (1, 3, 4), (1, 2, 1), (2, 9, 4), (2, 3, 4), (3, 9, 1), (3, 3, 2), (3, 4, 4), (3, 5, 4)], "user_id long, item_id long, weight int")
    training, hidden = recommend.leave_one_out(recommend.RatingModel.of(cells))
    assert rows_of(hidden) == [(1, 3), (3, 4)]
    assert rows_of(training.cells) == [(1, 2, 1), (1, 9, 4), (2, 3, 4), (2, 9, 4), (3, 3, 2), (3, 5, 4), (3, 9, 1)]


def test_shuffle_files_go_with_the_table_that_they_were_for(spark):
    key, context = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", spark.sparkContext
    before, known = spark.conf.get(key, None), context._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    left = {}
    for write in (materialize_and_free, materialize):
        first = context._jsc.sc().newShuffleId()
        held = write(spark.range(1000).groupBy((F.col("id") % 7).alias("key")).count(), "counted")
        left[write] = sum(known.containsShuffle(at) for at in range(first, context._jsc.sc().newShuffleId()))
        assert held.count() == 7
    assert left[materialize_and_free] == 0 < left[materialize]
    assert spark.conf.get(key, None) == before
