import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from earshot.checks import queries as q
from earshot.checks import tables as t
from earshot.operators import classifiers, factors, features, kmeans, topics
from earshot.operators.agreement import purity

RULES = features.TermRules(min_df=1, max_features=50, grams=1)


def dense(rows, n_terms):
    out = []
    for r in sorted(rows.collect(), key=lambda r: r[0]):
        line = np.zeros(n_terms)
        line[r.idx] = r.val
        out.append(line)
    return np.array(out)


@pytest.fixture(scope="module")
def matrix(spark):
    """A 60 x 12 non-negative sparse table with three blocks, and its rows."""
    rng = np.random.default_rng(0)
    a = np.zeros((60, 12))
    for i in range(59):  # the last document is empty
        block = i % 3
        a[i, block * 4 : block * 4 + 4] = rng.random(4) + 0.2
        a[i, rng.integers(12)] += 0.05
    data = [(i, [int(j) for j in np.flatnonzero(row)], [float(v) for v in row[row > 0]]) for i, row in enumerate(a)]
    return a, spark.createDataFrame(data, "doc long, idx array<int>, val array<double>").repartition(5)


def test_truncated_svd_equals_numpy(matrix):
    a, rows = matrix
    svd = factors.truncated_svd(rows, 12, 3, seed=1)
    values = np.linalg.svd(a, compute_uv=False)
    np.testing.assert_allclose(svd.values, values[:3], rtol=1e-6)
    embedded = np.array([r.embedding for r in svd.embed(rows, "doc").orderBy("doc").collect()])
    np.testing.assert_allclose(embedded, a @ svd.components, atol=1e-12)
    np.testing.assert_allclose(np.linalg.norm(embedded, axis=0), values[:3], rtol=1e-6)


def test_nmf_error_falls_and_factors_are_nonnegative(matrix):
    a, rows = matrix
    model = factors.nonnegative_factors(rows, 12, 3)
    assert (model.topics >= 0).all()
    assert all(b <= e + 1e-9 for e, b in zip(model.errors, model.errors[1:]))
    weights = np.array([r.weights for r in model.weights(rows, "doc").orderBy("doc").collect()])
    assert (weights >= 0).all() and (weights[59] == 0).all()
    best = np.linalg.svd(a, compute_uv=False)[3:]
    error = ((a - weights @ model.topics) ** 2).sum()
    # the reported error is for the topics before their last update
    assert error <= model.errors[-1] + 1e-9
    assert error < 1.25 * (best**2).sum()
    assert len({tuple(sorted(set(weights[i::3][:19].argmax(axis=1)))) for i in range(3)}) == 3


def test_nonnegative_weights_solve_their_problem():
    rng = np.random.default_rng(2)
    topics_ = rng.random((3, 8))
    truth = np.maximum(rng.normal(size=(20, 3)), 0)
    a = truth @ topics_
    row, idx = np.nonzero(a)
    cells = factors.Cells(row, idx, a[row, idx], 20)
    np.testing.assert_allclose(factors.nonnegative_weights(cells, topics_, sweeps=5000), truth, atol=1e-5)


def test_task_code_needs_no_installed_package(tmp_path):
    """Workers far from this folder can still load what the tasks carry."""
    code = cloudpickle.dumps(lambda: factors.nonnegative_weights(
        factors.Cells(np.array([0]), np.array([1]), np.array([2.0]), 1), np.eye(2)
    ))
    script = "import pickle, sys; print(pickle.load(sys.stdin.buffer)().tolist())"
    done = subprocess.run(
        [sys.executable, "-I", "-c", script], input=code, capture_output=True, cwd=tmp_path, timeout=120
    )
    assert done.stdout.decode().strip() == "[[0.0, 2.0]]", done.stderr.decode()


def test_tfidf_tables_and_vectors_agree(spark):
    docs = spark.createDataFrame(
        [(1, "red red fish"), (2, "blue fish"), (3, "red bird and fish"), (4, "!!")], "doc int, text string"
    )
    fitted = features.fit_features(docs, "text", RULES)
    assert fitted.terms == ("and", "bird", "blue", "fish", "red")
    table = {(r.doc, r.term): r.weight for r in features.tfidf_weights(docs, "doc", "text", RULES).collect()}
    again = {(r.doc, r.term): r.weight for r in fitted.weights(docs, "doc", "text").collect()}
    assert table.keys() == again.keys() and all(abs(table[k] - again[k]) < 1e-12 for k in table)
    idf = {term: np.log(5 / (1 + n)) + 1 for term, n in [("red", 2), ("fish", 3)]}
    raw = np.array([2 * idf["red"], idf["fish"]])
    np.testing.assert_allclose([table[1, "red"], table[1, "fish"]], raw / np.linalg.norm(raw))
    for r in fitted.tfidf(docs, "text").collect():
        for term, value in zip(fitted.terms, r.features.toArray()):
            assert abs(value - table.get((r.doc, term), 0.0)) < 1e-12


def test_vocabulary_limits(spark):
    docs = spark.createDataFrame([(1, "aa aa bb cc"), (2, "aa bb dd"), (3, "cc bb")], "doc int, text string")
    rules = features.TermRules(min_df=2, max_features=2, grams=1)
    assert features.fit_features(docs, "text", rules).terms == ("aa", "bb")
    rules = features.TermRules(min_df=2, max_features=9, grams=2, stop_words=("dd",))
    assert features.fit_features(docs, "text", rules).terms == ("aa", "aa bb", "bb", "cc")
    with pytest.raises(ValueError):
        features.fit_features(docs, "text", features.TermRules(min_df=9))


def test_empty_documents_keep_their_row(spark):
    docs = spark.createDataFrame([(1, "aa bb"), (2, "zz"), (3, None)], "doc int, text string")
    weights = features.fit_features(docs, "text", RULES).weights(docs, "doc", "text")
    rows = features.sparse_rows(docs, "doc", weights.where("term <> 'zz'"), "weight").collect()
    assert {r.doc: len(r.idx) for r in rows} == {1: 2, 2: 0, 3: 0}


@pytest.fixture(scope="module")
def corpus(spark):
    return q._corpus(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def truth(spark):
    return t.documents(spark, "/root/testdata/sf0.001").select("doc_id", F.col("lang").alias("truth"))


def share_of_largest(truth):
    n = [r["count"] for r in truth.groupBy("truth").count().collect()]
    return max(n) / sum(n)


def test_nmf_topics(corpus, truth):
    found = topics.by_nmf(corpus, 4)
    score = purity(found.assigned.join(truth, "doc_id"), "topic", "truth").first()
    assert score.n == truth.count() and score.purity > share_of_largest(truth)
    again = topics.by_nmf(corpus, 4)
    np.testing.assert_allclose(found.term_weights, again.term_weights, atol=1e-8)
    named = topics.topic_names(topics.top_terms(corpus, found)).collect()
    assert len(named) == 4 and all(len(r.label.split(" ")) == 3 for r in named)


def test_lda_topics(corpus, truth):
    found = topics.by_lda(corpus, 4)
    rows = found.assigned.collect()
    assert len(rows) == truth.count()
    assert all(abs(sum(r.weights) - 1) < 1e-6 and r.topic == int(np.argmax(r.weights)) for r in rows)


def test_lda_assigns_without_cutting_the_text_again(corpus):
    plan = topics.by_lda(corpus, 2, passes=1).assigned._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("regexp_extract_all") > plan.index("InMemoryRelation")  # only below what is kept


def test_embedding_clusters(corpus, truth):
    embedded = topics.lsa_embedding(corpus, 20)
    assert len(embedded.first().embedding) == 20
    found = topics.by_kmeans(embedded, "doc_id", k=4, restarts=3)
    assert found.assigned.count() == truth.count()
    score = purity(found.assigned.join(truth, "doc_id"), "topic", "truth").first().purity
    assert 0.25 <= score <= 1.0
    assert topics.top_terms(corpus, found, 2).count() <= 8


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(5)
    data = np.concatenate([rng.normal(c, 0.4, (120, 6)) for c in rng.normal(0, 3, (7, 6))])
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    return data, spark.createDataFrame(rows, "doc_id long, embedding array<double>").repartition(6)


def test_restarts_together_equal_single_runs(blobs):
    data, rows = blobs
    together = kmeans.fit(rows, "embedding", 7, tuple(range(10)))
    alone = [kmeans.fit(rows, "embedding", 7, (seed,)) for seed in range(10)]
    np.testing.assert_allclose(together.costs, [a.costs[0] for a in alone], rtol=1e-9)
    assert together.passes == max(a.passes for a in alone) < sum(a.passes for a in alone) / 3
    best = kmeans.distances(data, together.centres)
    assert best.min(1).sum() == pytest.approx(min(together.costs), rel=1e-9)
    assigned = {r.doc_id: r.topic for r in together.assign(rows, "doc_id", "embedding").collect()}
    assert [assigned[i] for i in range(len(data))] == best.argmin(1).tolist()
    # each centre is the mean of its points, up to the tolerance
    means = np.array([data[best.argmin(1) == j].mean(0) for j in range(7)])
    np.testing.assert_allclose(means, together.centres, atol=1e-3)


def test_clusters_of_few_and_no_points(spark):
    rows = spark.createDataFrame([(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [4.0, 0.0])], "doc_id long, embedding array<float>")
    found = kmeans.fit(rows, "embedding", 3, (1, 2))
    assert min(found.costs) == 0.0
    topic = {r.doc_id: r.topic for r in found.assign(rows, "doc_id", "embedding").collect()}
    assert topic[1] == topic[2] != topic[3]
    assert kmeans.fit(rows.limit(0), "embedding", 3, (1,)).passes == 0


def test_sums_sent_do_not_grow_with_partitions(spark, matrix):
    a, rows = matrix
    cores = spark.sparkContext.defaultParallelism

    def add(cells, by_term, square):
        by_term[:, 0] += np.bincount(cells.idx, cells.val, minlength=12)

    sent = []
    for parts in (8 * cores, 32 * cores):
        many = rows.repartition(parts)
        assert factors.few_tasks(many).rdd.getNumPartitions() == 2 * cores
        sent.append(factors.few_tasks(many.select("idx")).mapInArrow(lambda b: b, "idx array<int>").rdd.getNumPartitions())
        np.testing.assert_allclose(factors.summed(many, 12, 3, add)[0][:, 0], a.sum(0))
    assert sent[0] == sent[1]
    assert factors.few_tasks(rows).rdd.getNumPartitions() == 5  # few partitions stay as they are


def test_cluster_terms_shuffle_rows_and_sums_only(spark, corpus):
    embedded = topics.lsa_embedding(corpus, 20)
    found = topics.by_kmeans(embedded, "doc_id", k=4, restarts=2)
    got = {(r.topic, r.term): r.weight for r in topics._cluster_terms(corpus, found).collect()}
    cells = corpus.rows.join(found.assigned, "doc_id").select("topic", F.explode(F.arrays_zip("idx", "val")).alias("c"))
    want = {
        (r.topic, corpus.terms[r.idx]): r.w
        for r in cells.groupBy("topic", "c.idx").agg(F.sum("c.val").alias("w")).collect()
    }
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_svm_confidence_reads_the_text_once(reviews):
    data = classifiers.training_set(reviews, "id", "text", "truth", features.TermRules(min_df=2, max_features=200))
    scored = classifiers.fit_svm(data)(reviews)
    data.release()
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" not in plan and "ExistingRDD" not in plan and "Python" not in plan  # margins from files alone
    assert scored.columns == ["id", "text", "truth", "predicted_sentiment", "sentiment_confidence"]
    assert scored.where("sentiment_confidence < 0.5 OR sentiment_confidence > 1").count() == 0


def test_topic_contest(corpus, truth):
    contest = topics.compare(corpus, truth, 4, 20)
    assert contest.purity[contest.winner] == max(contest.purity.values())
    assert contest.labelled.count() == truth.count()
    assert contest.labelled.where("discovered_topic_label is null").count() == 0


def test_margin_confidence(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (5.0,)], "m double")
    got = [r.sentiment_confidence for r in classifiers.margin_confidence(df, "m").collect()]
    assert got == [0.5, 0.625, 1.0]


@pytest.fixture(scope="module")
def reviews(spark):
    words = {"negative": "broken awful late", "neutral": "usual plain okay", "positive": "great lovely fast"}
    rows = []
    for i in range(240):
        label = ("negative", "negative", "neutral", "positive")[i % 4]
        picked = words[label].split()
        rows.append((i, f"{picked[i % 3]} {picked[(i // 3) % 3]} thing number{i % 7}", label))
    return spark.createDataFrame(rows, "id int, text string, truth string")


def test_contest_of_classifiers(reviews):
    def always_negative(rows):
        return rows.withColumn("predicted_sentiment", F.lit("negative")).withColumn("sentiment_confidence", F.lit(0.7))

    contest = classifiers.compare(
        reviews, "id", "text", "truth", always_negative, features.TermRules(min_df=2, max_features=200)
    )
    assert contest.macro_f1["tfidf_logreg"] == 1.0 and contest.macro_f1["tfidf_linear_svm"] == 1.0
    assert contest.macro_f1["rule_based"] == pytest.approx(2 / 9)
    assert contest.winner == "tfidf_logreg"
    scored = contest.score(reviews)
    assert scored.count() == 240 and scored.where("predicted_sentiment <> truth").count() == 0
    low, high = scored.agg(F.min("sentiment_confidence"), F.max("sentiment_confidence")).first()
    assert 1 / 3 <= low <= high <= 1.0
    svm = contest.scorers["tfidf_linear_svm"](reviews)
    assert svm.agg(F.min("sentiment_confidence"), F.max("sentiment_confidence")).first()[0:2] == (0.5, 1.0)


def test_class_weights_are_balanced(reviews):
    weighted, n = classifiers.with_class_weights(reviews, "truth", ("negative", "neutral", "positive"))
    got = {r.truth: r.w for r in weighted.groupBy("truth").agg(F.sum("class_weight").alias("w")).collect()}
    assert n == 240 and all(abs(w - 80) < 1e-9 for w in got.values())


@pytest.mark.parametrize("width", [1, factors.NARROW, factors.NARROW + 1, 110])
def test_products_of_any_width(width):
    rng = np.random.default_rng(3)
    a = rng.random((40, 30)) * (rng.random((40, 30)) < 0.2)
    a[[0, 7, 39]] = 0.0  # empty rows at both ends and within
    a[:, [0, 29]] = 0.0
    row, idx = np.nonzero(a)
    cells = factors.Cells(row, idx, a[row, idx], len(a))
    small, dense, into = rng.random((30, width)), rng.random((40, width)), np.ones((30, width))
    assert np.allclose(cells.times(small), a @ small)
    cells.add_transposed(dense, into)
    assert np.allclose(into, 1.0 + a.T @ dense)
    none = factors.Cells(row[:0], idx[:0], row[:0].astype(float), 2)
    assert none.times(small).shape == (2, width) and not none.times(small).any()


def test_wide_products_read_rows_of_the_dense_side(monkeypatch):
    cells = factors.Cells(np.array([0, 1, 1]), np.array([2, 0, 2]), np.array([1.0, 2.0, 3.0]), 2)
    monkeypatch.setattr(np, "bincount", None)  # the way column by column
    cells.times(np.ones((3, 110)))
    cells.add_transposed(np.ones((2, 110)), np.zeros((3, 110)))


def test_terms_are_counted_without_a_row_made_for_each(spark):
    docs = spark.createDataFrame([("aa bb aa",), (None,), ("",), ("bb cc",), ("aa bb aa",)], "text string")
    found = features.term_frequencies(docs, "text", features.TermRules(grams=2))
    assert found.columns == ["term", "df", "cf"]
    assert {tuple(r) for r in found.collect()} == {
        ("aa", 2, 4), ("bb", 3, 3), ("cc", 1, 1), ("aa bb", 2, 2), ("bb aa", 2, 2), ("bb cc", 1, 1),
    }
    assert "named_struct" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_tasks_of_a_round_follow_the_cluster(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 500, numPartitions=5 * cores)
    large = classifiers.TrainingSet(rows, 10_000_000, None, "text", ("a",))
    assert large.batches().rdd.getNumPartitions() == 2 * cores
    assert large.batches().count() == 500
    assert classifiers.TrainingSet(rows, 500, None, "text", ("a",)).batches().rdd.getNumPartitions() == 1
