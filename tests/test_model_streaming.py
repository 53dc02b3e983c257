"""Model (M1-M7) and the streaming citation counts."""

import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from scholarmetrics.operators import counts as A
from scholarmetrics.operators import features as X
from scholarmetrics.operators import model as M
from scholarmetrics.plans.workflows import YearFeatures
from scholarmetrics.streaming.citations import edge_stream, running_citation_counts, start_running_counts

FEATS = list(X.FEATURE_COLUMNS)


@pytest.fixture(scope="module")
def frame(sf001_tables):
    merged = YearFeatures(sf001_tables, 1997).merged
    return M.prepare(merged, "nb_citations", FEATS, fill=0.0)


def test_multi_feature_fit_matches_normal_equations(frame):
    train, _ = M.split_train_test(frame)
    model = M.fit_linear(train, "nb_citations", FEATS)
    # test helper: solve the normal equations on the (small) fixture directly
    rows = np.array([[1.0] + [r[f] for f in FEATS] + [r.nb_citations] for r in train.collect()])
    Xm, y = rows[:, :-1], rows[:, -1]
    beta = np.linalg.lstsq(Xm, y, rcond=None)[0]
    got = np.array([model.intercept] + list(model.coefficients.toArray()))
    assert np.allclose(got, beta, rtol=1e-6, atol=1e-6)
    coef = M.coefficients(model, FEATS)
    assert coef.columns == ["intercept"] + FEATS


def test_normalize_unit_rows(frame):
    n = M.normalize(frame, FEATS)
    norms = n.select(F.sqrt(sum(F.col(c) * F.col(c) for c in FEATS)).alias("n")).collect()
    assert all(abs(r.n - 1.0) < 1e-9 or r.n == 0.0 for r in norms)


def test_mse_and_budget_loop(frame):
    train, test = M.split_train_test(frame)
    model = M.fit_linear(train, "nb_citations", FEATS)
    mse = M.score_mse(model, test, "nb_citations", FEATS).first()
    assert mse.n == test.count() and mse.mse >= 0
    curve = M.mse_by_budget(train, test, "nb_citations", FEATS, step=2).collect()
    assert [r.iterations for r in curve] == [2 * (i + 1) for i in range(len(curve))]
    # a curve: the budget has an effect, and only the last row says that it ended
    assert len(curve) > 2 and len({round(r.mse, 6) for r in curve}) > 1
    assert [r.converged for r in curve] == [False] * (len(curve) - 1) + [True]
    # the converged L-BFGS fit reaches the least-squares optimum
    assert curve[-1].mse == pytest.approx(mse.mse, rel=1e-4)
    capped = M.mse_by_budget(train, test, "nb_citations", FEATS, step=1, max_refits=2).collect()
    assert len(capped) == 2 and not capped[-1].converged


def test_models_are_scored_in_one_aggregate(spark, frame):
    train, test = M.split_train_test(frame)
    test = test.persist()
    models = [M.fit_linear(train, "nb_citations", FEATS, solver="l-bfgs", max_iter=k) for k in (1, 3, 50)]
    one_by_one = [M.score_mse(m, test, "nb_citations", FEATS).first().mse for m in models]
    sc = spark.sparkContext
    sc.setJobGroup("score-models", "score-models")
    try:
        got = M.score_models(models, test, "nb_citations", FEATS)
    finally:
        sc.setJobGroup("tests", "tests")
    assert got == pytest.approx(one_by_one, rel=1e-12)
    # one aggregate for all models (AQE may run its two stages as two jobs)
    assert len(sc.statusTracker().getJobIdsForGroup("score-models")) <= 2
    assert all(x != x for x in M.score_models(models, test.limit(0), "nb_citations", FEATS))


def test_curve_does_not_depend_on_the_batch(frame):
    train, test = M.split_train_test(frame)
    runs = [M.mse_by_budget(train, test, "nb_citations", FEATS, step=3, together=k).collect() for k in (1, 5)]
    assert [r.iterations for r in runs[0]] == [r.iterations for r in runs[1]]
    assert [r.mse for r in runs[0]] == pytest.approx([r.mse for r in runs[1]], rel=1e-9)


def test_budget_curve_query_ends_at_the_exact_solution(spark):
    """The registered curve; its last row against the SQL twin."""
    from locations import SF001
    from scholarmetrics.plans.catalog import QUERIES
    from scholarmetrics.plans.compare import duck_connection
    from scholarmetrics.plans.oracle import ORACLE_SQL

    curve = QUERIES["mse_by_budget"](spark, SF001).orderBy("iterations").collect()
    assert len(curve) > 1 and [r.converged for r in curve] == [False] * (len(curve) - 1) + [True]
    ((mse, converged),) = duck_connection(SF001).sql(ORACLE_SQL["mse_by_budget_last"]).fetchall()
    assert (curve[-1].mse, curve[-1].converged) == (pytest.approx(mse, abs=2e-3), converged)


def test_pipeline_saved_and_loaded_scores_alike(spark, frame, tmp_path):
    train, test = M.split_train_test(frame)
    model = M.fit_pipeline(train, "nb_citations", FEATS)
    path = str(tmp_path / "pipeline")
    M.save_model(model, path)
    back = M.load_pipeline(path)
    assert [type(s).__name__ for s in back.stages] == ["VectorAssembler", "Normalizer", "LinearRegressionModel"]
    want = {r.paper_id: r.prediction for r in model.transform(test).collect()}
    assert {r.paper_id: r.prediction for r in back.transform(test).collect()} == want
    # the same fit on columns that were scaled beforehand
    scaled = M.fit_linear(M.normalize(train, FEATS), "nb_citations", FEATS)
    assert list(back.stages[-1].coefficients) == pytest.approx(list(scaled.coefficients), rel=1e-6)
    # and on vectors that were scaled beforehand (M2's vector form)
    vectors = M.normalize_vectors(M.assemble(train, "nb_citations", FEATS))
    again = back.stages[-1].evaluate(vectors)
    assert again.numInstances == train.count()
    whole = M.fit_pipeline(train, "nb_citations", FEATS, normalized=False)
    plain = M.fit_linear(train, "nb_citations", FEATS)
    assert list(whole.stages[-1].coefficients) == pytest.approx(list(plain.coefficients), rel=1e-6)


@pytest.mark.parametrize("fraction", [0.04, 0.7, 0.75, 0.95])
def test_split_holds_any_fraction(spark, fraction):
    ids = spark.range(40000).select(F.col("id").cast("string").alias("paper_id"))
    share = M.split_flag(ids, fraction=fraction).agg(F.avg(F.col("is_train").cast("int"))).first()[0]
    assert abs(share - fraction) < 0.01


def test_save_load(frame, tmp_path):
    train, _ = M.split_train_test(frame)
    model = M.fit_linear(train, "nb_citations", FEATS)
    path = str(tmp_path / "model")
    M.save_model(model, path)
    back = M.load_model(path)
    assert back.intercept == pytest.approx(model.intercept)


def test_streaming_counts_equal_batch(spark, sf001_tables, tmp_path):
    edges = sf001_tables.paper_references
    src = str(tmp_path / "edges")
    # the feed arrives as three files
    for i in range(3):
        part = edges.filter(F.abs(F.hash("citing_id", "cited_id")) % 3 == i).coalesce(1)
        part.write.mode("append").parquet(src)
    stream = edge_stream(spark, src, max_files_per_trigger=1)
    q = start_running_counts(
        running_citation_counts(stream), "running_counts", sink="memory", output_mode="complete",
        checkpoint_location=tempfile.mkdtemp(prefix="sm-stream-"),
    )
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.sql("SELECT * FROM running_counts")
    want = A.citation_counts(edges)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.count() == 2000


def test_streaming_counts_resume_from_checkpoint(spark, sf001_tables, tmp_path):
    """Stop the query, let more edge files land, restart it on the same
    checkpoint: the running counts continue from the saved state (nothing is
    counted twice or lost), as after a driver or executor loss."""
    edges = sf001_tables.paper_references
    src = str(tmp_path / "edges")
    ckpt = str(tmp_path / "ckpt")
    parts = [edges.filter(F.abs(F.hash("citing_id", "cited_id")) % 3 == i).coalesce(1) for i in range(3)]
    parts[0].write.mode("append").parquet(src)

    def run_once(name):
        q = start_running_counts(
            running_citation_counts(edge_stream(spark, src)), name, sink="memory",
            output_mode="complete", checkpoint_location=ckpt,
        )
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        return spark.sql(f"SELECT * FROM {name}")

    first = run_once("counts_first")
    assert first.agg(F.sum("nb_citations")).first()[0] == parts[0].count()
    parts[1].write.mode("append").parquet(src)
    parts[2].write.mode("append").parquet(src)
    resumed = run_once("counts_resumed")
    want = A.citation_counts(edges)
    assert resumed.exceptAll(want).count() == 0 and want.exceptAll(resumed).count() == 0


def test_normalizer_vector_form_matches_columns(frame):
    from pyspark.ml.functions import vector_to_array

    cols = M.normalize(frame, FEATS).select("paper_id", *FEATS)
    vec = M.normalize_vectors(M.assemble(frame, "nb_citations", FEATS)).select(
        "paper_id", vector_to_array("features").alias("v")
    )
    want = {r.paper_id: [r[c] for c in FEATS] for r in cols.collect()}
    got = {r.paper_id: list(r.v) for r in vec.collect()}
    assert set(got) == set(want)
    for k, v in got.items():
        assert v == pytest.approx(want[k], abs=1e-12)
