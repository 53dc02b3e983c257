"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the fixture views of the driver tables.

Parameters are fixed per query (below).  Double outputs are rounded to 6
decimals so results compare across engines whose summation order differs; the
DuckDB twins in ``plans.oracle`` round the same columns.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmetrics.functions import predicates as P
from scholarmetrics.functions.expressions import position_credit
from scholarmetrics.operators import counts as A
from scholarmetrics.operators import features as X
from scholarmetrics.operators import links as J
from scholarmetrics.operators import model as M
from scholarmetrics.operators import temporal as E
from scholarmetrics.operators import weights as W
from scholarmetrics.operators.skew import shuffle_partitions
from scholarmetrics.plans.workflows import GapFeatures, YearFeatures
from scholarmetrics.schemas import SCHEMAS, Tables
from scholarmetrics.sources.fixtures import load_tables
from scholarmetrics.sources.sinks import tsv_line, write_text_dump
from scholarmetrics.sources.tables import materialize, shared_folder, write_bucketed
from scholarmetrics.sources.tsv import count_rejects, parse_lines, parse_tagged, read_tsv

# Fixed query parameters.
YEAR = 1997
NEWER_THAN = 1998
FIELD_PHRASE = "Brand#2"
FIELD_ID = "Brand#2"
GAP = 3
HIST_LO, HIST_HI, HIST_WIDTH = 0, 100, 10
AUTHOR_THRESHOLD = 170
CITATION_CAP = 40
TOP_K = 10
MODEL_FEATURE = "author_weight"
MSE_STEP = 5
DAMAGE_EVERY = 40
#: Lines of the text dump of counts.
COUNT_LINES = T.StructType([T.StructField("paper_id", T.StringType()), T.StructField("nb_citations", T.LongType())])
#: Buckets of a table: as many as shuffle partitions, within these bounds.
BUCKETS_LEAST, BUCKETS_MOST = 4, 100_000

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (presentation only)."""
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    return load_tables(spark, sf_dir)


def _year(spark: SparkSession, sf_dir: str, **kw) -> YearFeatures:
    return YearFeatures(_t(spark, sf_dir), YEAR, **kw)


def _gap(spark: SparkSession, sf_dir: str, **kw) -> GapFeatures:
    return GapFeatures(_t(spark, sf_dir), GAP, **kw)


def _all_counts(t: Tables) -> DataFrame:
    return A.papers_with_counts(t.papers, t.paper_references, restrict_edges=False)


def _model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X9 with missing features as 0.0 and the train flag."""
    merged = _year(spark, sf_dir, materialize_counts=True).merged
    filled = M.prepare(merged, "nb_citations", list(X.FEATURE_COLUMNS), fill=0.0)
    return M.split_flag(filled)


def _kept_model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, checkpointed: training and test rows come from one evaluation of X9."""
    return materialize(_model_frame(spark, sf_dir))


# --- filters and joins -------------------------------------------------------


def q_papers_of_year(spark, d):
    return P.papers_of_year(_t(spark, d).papers, YEAR)


def q_papers_newer_than(spark, d):
    return P.papers_newer_than(_t(spark, d).papers, NEWER_THAN)


def q_leading_author_links(spark, d):
    return P.leading_authors(_t(spark, d).paper_authors)


def q_fields_of_study_like(spark, d):
    return P.fields_named(_t(spark, d).fields_of_study, FIELD_PHRASE)


def q_citations_to_year(spark, d):
    t = _t(spark, d)
    return J.citations_to(t.paper_references, P.papers_of_year(t.papers, YEAR))


def q_citations_to_newer(spark, d):
    t = _t(spark, d)
    return J.citations_to(t.paper_references, P.papers_newer_than(t.papers, NEWER_THAN))


def q_authorships_of_year(spark, d):
    t = _t(spark, d)
    return J.authorships_of(t.paper_authors, P.papers_of_year(t.papers, YEAR))


def q_author_name_lookup(spark, d):
    t = _t(spark, d)
    prolific = P.min_count(A.leading_author_counts(t.paper_authors), AUTHOR_THRESHOLD, "nb_links")
    return J.enrich_names(t.authors, prolific, "nb_links", -1)


def q_paper_citation_pairs(spark, d):
    t = _t(spark, d)
    return J.paper_citation_pairs(t.papers, t.paper_references)


def q_edges_with_years(spark, d):
    t = _t(spark, d)
    return J.edges_with_years(t.paper_references, t.papers)


def q_papers_below_cap(spark, d):
    return P.below_cap(_all_counts(_t(spark, d)), CITATION_CAP).select("paper_id", "nb_citations")


def q_counts_with_year(spark, d):
    t = _t(spark, d)
    capped = P.below_cap(_all_counts(t), CITATION_CAP).select("paper_id", "nb_citations")
    return J.counts_with_year(capped, t.papers)


# --- counts, statistics, top-k ----------------------------------------------


def q_citation_counts(spark, d):
    return A.citation_counts(_t(spark, d).paper_references)


def q_papers_with_counts(spark, d):
    return _year(spark, d).counts


def q_keyword_counts(spark, d):
    return A.keyword_counts(_t(spark, d).paper_keywords)


def q_leading_author_counts(spark, d):
    return A.leading_author_counts(_t(spark, d).paper_authors)


def q_papers_in_field(spark, d):
    return A.papers_in_field(_t(spark, d).paper_keywords, FIELD_ID)


def q_citation_histogram(spark, d):
    cc = A.citation_counts(_t(spark, d).paper_references)
    return A.count_histogram(cc, "nb_citations", HIST_LO, HIST_HI, HIST_WIDTH)


def q_citation_count_stats(spark, d):
    return rounded(A.count_stats(A.citation_counts(_t(spark, d).paper_references), "nb_citations"))


def q_author_count_stats(spark, d):
    return rounded(A.count_stats(A.leading_author_counts(_t(spark, d).paper_authors), "nb_links"))


def q_top_keywords(spark, d):
    return A.top_k(A.keyword_counts(_t(spark, d).paper_keywords), TOP_K, "nb_rows", "keyword")


def q_prolific_authors(spark, d):
    return P.min_count(A.leading_author_counts(_t(spark, d).paper_authors), AUTHOR_THRESHOLD, "nb_links")


def q_top_authors_named(spark, d):
    t = _t(spark, d)
    return A.top_authors_named(t.paper_authors, t.authors, TOP_K)


# --- weights (year subset) ---------------------------------------------------


def q_author_weights_full(spark, d):
    y = _year(spark, d)
    return W.author_weights(y.counts, y.tables.paper_authors, "full")


def q_author_weights_position(spark, d):
    return rounded(_year(spark, d).author_weights)


def q_affiliation_weights(spark, d):
    return _year(spark, d).affiliation_weights


def q_affiliation_weights_by_author_link(spark, d):
    y = _year(spark, d)
    return W.affiliation_weights(y.counts, y.tables.paper_authors, require="author")


def q_venue_weights(spark, d):
    return _year(spark, d).venue_weights


def q_venue_weights_raw(spark, d):
    return W.venue_weights(_year(spark, d).counts, lower=False, drop_blank=False)


def q_field_weights(spark, d):
    return _year(spark, d).field_weights


# --- per-paper features (year subset) ------------------------------------------


def q_paper_venue_feature(spark, d):
    return rounded(_year(spark, d).venue_feature)


def q_paper_author_feature(spark, d):
    return rounded(_year(spark, d).author_feature)


def q_paper_affiliation_feature(spark, d):
    return rounded(_year(spark, d).affiliation_feature)


def q_paper_field_feature(spark, d):
    return rounded(_year(spark, d).field_feature)


def q_merged_features(spark, d):
    """X9; the counts and the cited papers' links are checkpointed once."""
    return rounded(_year(spark, d, materialize_counts=True).merged)


def q_merged_features_by_parts(spark, d):
    """J8 on the four feature tables as such (X1-X4), merged by one group by paper."""
    y = _year(spark, d, materialize_counts=True)
    return rounded(X.merge_features(y.counts, y.author_feature, y.affiliation_feature, y.venue_feature, y.field_feature))


def _wide_year(spark, d) -> YearFeatures:
    return YearFeatures(load_tables(spark, d, wide=True), YEAR, materialize_counts=True)


def q_build_features(spark, d):
    """X11 as one build: its eight outputs in long form ``(output, key, value)``,
    with the per-paper counts checkpointed to the shared checkpoint folder."""
    keys = {
        "papers": ("paper_id", "year"),
        "citations": (F.concat_ws(">", "citing_id", "cited_id"), F.lit(1)),
        "authorships": (F.concat_ws("|", "paper_id", "author_id", "affiliation_id"), "author_seq"),
        "paper_counts": ("paper_id", "nb_citations"),
        "author_weights": ("author_id", "weight"),
        "affiliation_weights": ("affiliation_id", "weight"),
        "venue_weights": ("venue", "weight"),
        "field_weights": ("fos_id", "weight"),
    }
    parts = [
        df.select(
            F.lit(name).alias("output"),
            (F.col(keys[name][0]) if isinstance(keys[name][0], str) else keys[name][0]).alias("key"),
            (F.col(keys[name][1]) if isinstance(keys[name][1], str) else keys[name][1]).cast("double").alias("value"),
        )
        for name, df in _wide_year(spark, d).outputs().items()
    ]
    return rounded(reduce(DataFrame.unionByName, parts))


def q_build_papers(spark, d):
    return _wide_year(spark, d).outputs()["papers"]


def q_build_paper_counts(spark, d):
    return _wide_year(spark, d).outputs()["paper_counts"]


def q_tsv_roundtrip_papers(spark, d):
    """S1 and S2 without a folder: the lines S2 writes, read back by S1."""
    papers = load_tables(spark, d, wide=True).papers
    return parse_lines(papers.select(tsv_line(papers)), SCHEMAS["papers"])


def q_tsv_roundtrip_links(spark, d):
    t = _t(spark, d)
    links = t.paper_authors.select(
        "paper_id", "author_id", "affiliation_id", F.lit("").alias("c3"), F.lit('a "quoted" text').alias("c4"), "author_seq"
    )
    return parse_lines(links.select(tsv_line(links)), SCHEMAS["paper_authors"])


# --- gap-limited variant --------------------------------------------------------


def q_edges_with_gap(spark, d):
    t = _t(spark, d)
    return E.edges_with_gap(t.paper_references, t.papers, GAP)


def q_gap_counts_cited(spark, d):
    t = _t(spark, d)
    return E.gap_counts(t.paper_references, t.papers, GAP, by="cited")


def q_gap_counts_citing(spark, d):
    t = _t(spark, d)
    return E.gap_counts(t.paper_references, t.papers, GAP, by="citing")


def q_gap_counts_capped(spark, d):
    return _gap(spark, d, cap=CITATION_CAP).gap_counts


def q_author_weights_mean(spark, d):
    return rounded(_gap(spark, d).author_weights)


def q_affiliation_weights_mean(spark, d):
    return rounded(_gap(spark, d).affiliation_weights)


def q_field_weights_mean(spark, d):
    return rounded(_gap(spark, d).field_weights)


def q_venue_weights_mean(spark, d):
    return rounded(_gap(spark, d).venue_weights)


def q_venue_weights_mean_c5(spark, d):
    """W11 on the raw venue column of a dump (source column 5)."""
    return rounded(GapFeatures(load_tables(spark, d, wide=True), GAP, venue_col="c5").venue_weights)


def q_paper_venue_sum_c5(spark, d):
    return rounded(GapFeatures(load_tables(spark, d, wide=True), GAP, venue_col="c5").venue_sum)


def q_paper_author_sum(spark, d):
    return rounded(_gap(spark, d).author_sum)


def q_paper_affiliation_sum(spark, d):
    return rounded(_gap(spark, d).affiliation_sum)


def q_paper_field_sum(spark, d):
    return rounded(_gap(spark, d).field_sum)


def q_paper_venue_sum(spark, d):
    return rounded(_gap(spark, d).venue_sum)


def q_all_weights(spark, d):
    """X10; the counts and weights that several inputs share are checkpointed."""
    return rounded(_gap(spark, d, materialize_counts=True).combined)


def q_author_feature_pair(spark, d):
    return rounded(_gap(spark, d).author_pair)


# --- model ------------------------------------------------------------------------


def q_normalized_features(spark, d):
    m = _model_frame(spark, d).drop("is_train")
    return rounded(M.normalize(m, list(X.FEATURE_COLUMNS)))


def q_train_test_split(spark, d):
    return _model_frame(spark, d).select("paper_id", "is_train")


def _fit_one(spark, d):
    m = _kept_model_frame(spark, d)
    train = m.filter(F.col("is_train"))
    test = m.filter(~F.col("is_train"))
    return M.fit_linear(train, "nb_citations", [MODEL_FEATURE]), test


def q_linear_model_coefficients(spark, d):
    m = _model_frame(spark, d).filter(F.col("is_train"))
    model = M.fit_linear(m, "nb_citations", [MODEL_FEATURE])
    return rounded(M.coefficients(model, [MODEL_FEATURE], spark))


def q_linear_model_mse(spark, d):
    model, test = _fit_one(spark, d)
    return rounded(M.score_mse(model, test, "nb_citations", [MODEL_FEATURE]))


def q_linear_model_all_features(spark, d):
    m = _model_frame(spark, d)
    model = M.fit_linear(m.filter(F.col("is_train")), "nb_citations", list(X.FEATURE_COLUMNS))
    return rounded(M.coefficients(model, list(X.FEATURE_COLUMNS), spark))


def _sum_model(spark, table: DataFrame, feature: str) -> DataFrame:
    """M4 on a table of the gap variant: label and feature from that table."""
    train = M.split_flag(M.prepare(table, "nb_citations", [feature])).filter(F.col("is_train"))
    return rounded(M.coefficients(M.fit_linear(train, "nb_citations", [feature]), [feature], spark))


def q_author_sum_model(spark, d):
    return _sum_model(spark, _gap(spark, d).author_sum, "author_weight")


def q_field_sum_model(spark, d):
    return _sum_model(spark, _gap(spark, d).field_sum, "field_weight")


def _budget_curve(spark, d) -> DataFrame:
    m = _kept_model_frame(spark, d)
    return M.mse_by_budget(
        m.filter(F.col("is_train")), m.filter(~F.col("is_train")), "nb_citations", list(X.FEATURE_COLUMNS), step=MSE_STEP
    )


def q_mse_by_budget(spark, d):
    """M6: the whole curve (iterations, mse, converged)."""
    return rounded(_budget_curve(spark, d), 3)


def q_mse_by_budget_last(spark, d):
    """M6: the error of the last budget, which must be that of the exact solution."""
    last = _budget_curve(spark, d).orderBy(F.desc("iterations")).limit(1)
    return last.select(F.round("mse", 3).alias("mse"), "converged")


def q_linear_model_reloaded(spark, d):
    """M1, M2, M4 and M7: a pipeline fitted on normalised vectors, saved to the shared
    folder and loaded again; its coefficients."""
    feats = list(X.FEATURE_COLUMNS)
    train = _kept_model_frame(spark, d).filter(F.col("is_train"))
    path = shared_folder(spark, "pipeline")
    M.save_model(M.fit_pipeline(train, "nb_citations", feats), path)
    return rounded(M.coefficients(M.load_pipeline(path).stages[-1], feats, spark), 4)


def q_linear_model_scored(spark, d):
    """M7: a fitted model saved to the shared folder, loaded by another step and applied
    to every test paper."""
    model, test = _fit_one(spark, d)
    path = shared_folder(spark, "model")
    M.save_model(model, path)
    scored = M.predictions(M.load_model(path), test, "nb_citations", [MODEL_FEATURE])
    return rounded(scored.select("paper_id", "nb_citations", "prediction"))


# --- sources and sinks through files -----------------------------------------------


def q_text_dump_roundtrip(spark, d):
    """The counts dumped as plain text lines, read back and typed."""
    path = shared_folder(spark, "text-dump")
    write_text_dump(A.citation_counts(_t(spark, d).paper_references), path)
    return read_tsv(spark, path, COUNT_LINES)


def damaged_lines(spark, d) -> DataFrame:
    """Lines of the papers table; by the remainder of the id, some lose their last two
    fields and some have a year that is no number."""
    papers = load_tables(spark, d, wide=True).papers
    rest = F.pmod(F.col("paper_id").cast("bigint"), F.lit(DAMAGE_EVERY))
    year = F.when(rest == 1, F.lit("unknown")).otherwise(F.col("year").cast("string"))
    papers = papers.withColumn("year", year)
    line = tsv_line(papers)
    return papers.select(F.when(rest == 0, F.regexp_replace(line, "\t[^\t]*\t[^\t]*$", "")).otherwise(line).alias("value"))


def q_tsv_rejects(spark, d):
    """Lines by reject reason, rows and rejects from one scan."""
    return count_rejects(parse_tagged(damaged_lines(spark, d), SCHEMAS["papers"]))


def bucketed_tables(spark, d) -> dict[str, DataFrame]:
    """S3: papers with counts, links and keywords as bucketed copies by paper id in the
    shared folder, each shuffled once, when it is written."""
    t = _t(spark, d)
    buckets = max(BUCKETS_LEAST, min(shuffle_partitions(t.papers), BUCKETS_MOST))
    tables = {
        "counts": _all_counts(t).select("paper_id", "year", "nb_citations"),
        "links": t.paper_authors.select("paper_id", "author_id", "author_seq"),
        "keywords": t.paper_keywords.select("paper_id", "fos_id"),
    }
    return {n: write_bucketed(df, shared_folder(spark, f"by-paper-{n}"), "paper_id", buckets) for n, df in tables.items()}


def q_bucketed_paper_profile(spark, d):
    """S3: per paper its count, its authors' credit and its number of fields, joined and
    grouped on bucketed copies without an exchange."""
    return rounded(profile_of(**bucketed_tables(spark, d)))


def profile_of(counts: DataFrame, links: DataFrame, keywords: DataFrame) -> DataFrame:
    credit = P.non_blank(links, "author_id").groupBy("paper_id").agg(
        F.count(F.lit(1)).alias("nb_links"), F.sum(position_credit("author_seq")).alias("credit")
    )
    fields = keywords.groupBy("paper_id").agg(F.count(F.lit(1)).alias("nb_keywords"), F.min("fos_id").alias("first_field"))
    both = counts.join(credit, "paper_id", "left").join(fields, "paper_id", "left")
    zero = {"nb_links": 0, "credit": 0.0, "nb_keywords": 0}
    return both.select("paper_id", "year", "nb_citations", *[F.coalesce(c, F.lit(v)).alias(c) for c, v in zero.items()], "first_field")


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}

# Flagship query (``entry``) and the bench set.
FLAGSHIP = "papers_with_counts"
HEADLINE = (
    "citation_counts",
    "papers_with_counts",
    "author_weights_position",
    "edges_with_gap",
    "merged_features",
    "all_weights",
    "linear_model_coefficients",
)
