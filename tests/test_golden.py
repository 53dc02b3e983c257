"""Layer 1: the golden mini corpus (FIXTURES.md §3), expected values by hand."""

import pytest

from golden import golden_tables
from scholarmetrics.operators import counts as A
from scholarmetrics.operators import features as X
from scholarmetrics.operators import temporal as E
from scholarmetrics.operators import weights as W
from scholarmetrics.plans.workflows import GapFeatures, YearFeatures


def as_map(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def approx_map(d):
    return {k: pytest.approx(v) if v is not None else None for k, v in d.items()}


@pytest.fixture(scope="module")
def t(spark):
    return golden_tables(spark)


@pytest.fixture(scope="module")
def y(t):
    return YearFeatures(t, 2012)


@pytest.fixture(scope="module")
def g(t):
    return GapFeatures(t, gap=3)


def test_a1_a2(y):
    assert as_map(A.citation_counts(y.citations), "paper_id", "nb_citations") == {"P1": 3, "P2": 1, "P3": 1}
    assert as_map(y.counts, "paper_id", "nb_citations") == {"P1": 3, "P2": 1, "P3": 1, "P5": 0}


def test_sum_weights(y, t):
    assert as_map(W.author_weights(y.counts, t.paper_authors, "full"), "author_id", "weight") == {
        "A1": 4, "A2": 4, "A3": 0, "A4": 0}
    assert as_map(y.author_weights, "author_id", "weight") == {"A1": 4.0, "A2": 2.5, "A3": 0.0, "A4": 0.0}
    assert as_map(y.affiliation_weights, "affiliation_id", "weight") == {"F1": 7, "F2": 1}
    assert as_map(W.affiliation_weights(y.counts, t.paper_authors, "author"), "affiliation_id", "weight") == {
        "F1": 7, "": 1, "F2": 0}
    assert as_map(y.venue_weights, "venue", "weight") == {"icml": 4}
    assert as_map(W.venue_weights(y.counts, lower=False, drop_blank=False), "venue", "weight") == {
        "ICML": 3, "icml": 1, "": 1}
    assert as_map(y.field_weights, "fos_id", "weight") == {"X": 6, "Y": 1, "Z": 0}


def test_year_features(y):
    assert as_map(y.venue_feature, "paper_id", "venue_weight") == {"P1": 4.0, "P2": 4.0, "P3": 0.0, "P5": 0.0}
    assert as_map(y.author_feature, "paper_id", "author_weight") == {"P1": 3.25, "P2": 4.0, "P3": 2.5, "P5": 0.0}
    assert as_map(y.affiliation_feature, "paper_id", "affiliation_weight") == {
        "P1": 7.0, "P2": 7.0, "P3": 1.0, "P5": 1.0}
    assert as_map(y.field_feature, "paper_id", "field_weight") == {"P1": 6.0, "P2": 1.0, "P4": 0.0, "P5": 1.0}


def test_merged_x9(y):
    rows = {r["paper_id"]: tuple(r)[1:] for r in y.merged.collect()}
    assert y.merged.columns == [
        "paper_id", "field_weight", "venue_weight", "affiliation_weight", "author_weight", "nb_citations"]
    assert rows == {
        "P1": (6.0, 4.0, 7.0, 3.25, 3.0),
        "P2": (1.0, 4.0, 7.0, 4.0, 1.0),
        "P3": (None, 0.0, 1.0, 2.5, 1.0),
    }


def test_gap_edges_and_counts(t, g):
    e1 = {(r.cited_id, r.citing_id) for r in E.edges_with_gap(t.paper_references, t.papers, 3).collect()}
    assert e1 == {("P1", "P4"), ("P2", "P4"), ("P3", "P4")}
    assert as_map(g.gap_counts, "paper_id", "nb_citations") == {"P1": 1, "P2": 1, "P3": 1, "P4": 0, "P5": 0}
    e3 = E.gap_counts(t.paper_references, t.papers, 3, by="citing")
    assert as_map(e3, "paper_id", "nb_citations") == {"P1": 0, "P2": 0, "P3": 0, "P4": 3, "P5": 0}


def test_mean_weights(g):
    assert as_map(g.author_weights, "author_id", "weight") == approx_map({"A1": 1, "A2": 0.75, "A3": 0, "A4": 0})
    assert as_map(g.affiliation_weights, "affiliation_id", "weight") == approx_map({"F1": 2.5 / 3, "F2": 0.5 / 3})
    assert as_map(g.field_weights, "fos_id", "weight") == approx_map({"X": 1, "Y": 0.5, "Z": 0})
    assert as_map(g.venue_weights, "venue", "weight") == approx_map({"ICML": 1, "icml": 1, "": 1, "KDD": 0})


def test_gap_sums(g):
    assert as_map(g.author_sum, "paper_id", "author_weight") == approx_map(
        {"P1": 1.75, "P2": 1, "P3": 0.75, "P4": 0, "P5": 0})
    assert as_map(g.affiliation_sum, "paper_id", "affiliation_weight") == approx_map(
        {"P1": 5 / 3, "P2": 2.5 / 3, "P3": 0.5 / 3, "P4": 0.5 / 3, "P5": 0.5 / 3})
    assert as_map(g.field_sum, "paper_id", "field_weight") == approx_map(
        {"P1": 2, "P2": 0.5, "P3": 0, "P4": 0, "P5": 0.5})
    assert as_map(g.venue_sum, "paper_id", "venue_weight") == approx_map(
        {"P1": 1, "P2": 1, "P3": 1, "P4": 0, "P5": 0})


def test_all_weights_x10(g):
    out = g.combined
    assert out.columns == [
        "paper_id", "nb_citations", "author_weight", "affiliation_weight", "field_weight", "venue_weight"]
    assert as_map(out, "paper_id", "nb_citations") == {"P1": 3.0, "P2": 1.0, "P3": 1.0, "P4": 0.0, "P5": 0.0}


def test_author_pair_j10(g):
    pair = {r.paper_id: (r.author_weight_a, r.author_weight_b) for r in g.author_pair.collect()}
    # full-credit gap weights: A1 = 1 + 1, A2 = 1 + 1, A3 = A4 = 0
    assert pair == {
        "P1": (pytest.approx(1.75), 4.0),
        "P2": (pytest.approx(1.0), 2.0),
        "P3": (pytest.approx(0.75), 2.0),
        "P4": (0.0, 0.0),
        "P5": (0.0, 0.0),
    }


def test_exploration(t, spark):
    assert as_map(A.keyword_counts(t.paper_keywords), "keyword", "nb_rows") == {"k1": 3, "k2": 1, "k3": 1}
    assert as_map(A.leading_author_counts(t.paper_authors), "author_id", "nb_links") == {
        "A1": 2, "A2": 2, "A3": 1, "A4": 1}
    assert as_map(A.papers_in_field(t.paper_keywords, "X"), "paper_id", "nb_keywords") == {"P1": 2}
    top = [tuple(r) for r in A.top_authors_named(t.paper_authors, t.authors, 2).collect()]
    assert top == [("A1", "Ada", 2), ("A2", "Bo", 2)]
    stats = A.count_stats(A.citation_counts(t.paper_references), "nb_citations").first()
    assert (stats.n, stats.max, stats.min) == (3, 3, 1)
    assert stats.mean == pytest.approx(5 / 3)
    assert stats.stdev == pytest.approx(((3 - 5 / 3) ** 2 + 2 * (1 - 5 / 3) ** 2) ** 0.5 / 3 ** 0.5)


def test_histogram_edges(spark):
    counts = spark.createDataFrame([(0,), (9,), (10,), (89,), (90,), (91,), (-1,)], "n int")
    h = {r.bucket: (r.bucket_lo, r.bucket_hi, r.nb) for r in A.count_histogram(counts, "n", 0, 100, 10).collect()}
    assert len(h) == 9
    assert h[0] == (0, 10, 2)
    assert h[1] == (10, 20, 1)
    # the last bucket [80, 90] is closed; 91 and -1 fall outside
    assert h[8] == (80, 90, 2)
    assert sum(v[2] for v in h.values()) == 5


def test_position_zero_fails_like_the_original(spark, t, y):
    """A position of 0 fails the credit 1/seq on any link row, cited or not."""
    bad = t.paper_authors.union(spark.createDataFrame([("P5", "A9", "F9", 0)], t.paper_authors.schema))
    with pytest.raises(Exception, match="(?i)divide|division"):
        W.author_weights(y.counts, bad, "position").collect()
