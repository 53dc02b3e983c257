"""Layer 3: invariants on the sf0.01 fixture views."""

from pyspark.sql import functions as F

from scholarmetrics.functions.predicates import papers_of_year
from scholarmetrics.operators import counts as A
from scholarmetrics.operators import links as J
from scholarmetrics.operators import model as M
from scholarmetrics.operators import weights as W
from scholarmetrics.plans.workflows import YearFeatures


def test_citation_total_equals_edges(sf001_tables):
    t = sf001_tables
    total = A.citation_counts(t.paper_references).agg(F.sum("nb_citations")).first()[0]
    assert total == t.paper_references.count() == 60000


def test_counts_keep_papers(sf001_tables):
    t = sf001_tables
    assert A.papers_with_counts(t.papers, t.paper_references).count() == t.papers.count()
    y = YearFeatures(t, 1997)
    assert y.counts.count() == y.papers.count() == 2279
    # restricting the edges first (J2) changes nothing
    a = A.papers_with_counts(y.papers, t.paper_references, restrict_edges=True)
    b = A.papers_with_counts(y.papers, t.paper_references, restrict_edges=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_features_do_not_multiply(sf001_tables):
    y = YearFeatures(sf001_tables, 1997)
    assert y.venue_feature.count() == y.papers.count()
    x2 = y.author_feature
    assert x2.count() == x2.select("paper_id").distinct().count()
    assert y.merged.count() == y.counts.filter("nb_citations > 0").count()


def test_raw_venue_weights_sum(sf001_tables):
    y = YearFeatures(sf001_tables, 1997)
    w6 = W.venue_weights(y.counts, lower=False, drop_blank=False).agg(F.sum("weight")).first()[0]
    assert w6 == y.counts.agg(F.sum("nb_citations")).first()[0]


def test_semi_joins_are_subsets(sf001_tables):
    t = sf001_tables
    p = papers_of_year(t.papers, 1997)
    e = J.citations_to(t.paper_references, p)
    assert e.exceptAll(t.paper_references).count() == 0
    l = J.authorships_of(t.paper_authors, p)
    assert l.exceptAll(t.paper_authors).count() == 0


def test_split_partitions_rows(sf001_tables):
    y = YearFeatures(sf001_tables, 1997)
    base = y.merged.select("paper_id")
    train, test = M.split_train_test(base)
    assert train.count() + test.count() == base.count()
    assert train.join(test, "paper_id").count() == 0
    # stable under repartitioning
    train2, _ = M.split_train_test(base.repartition(5))
    assert train.exceptAll(train2).count() == 0
