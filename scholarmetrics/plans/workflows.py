"""Multi-step workflows composed from the operators.

``YearFeatures`` (X11): the year-subset feature build — papers of one year,
the citations they received, their author links, per-paper counts, four
entity weights and the merged per-paper feature table (X9).

``GapFeatures``: the gap-limited variant — counts of citations received exactly
``gap`` years after publication, mean entity weights over those counts
(W8-W11), per-paper weight sums (X5-X8) and their inner merge (X10).

Attributes are DataFrames.  Building one may run the hot-key profile of a base
table (one sampled job per table and session, ``operators.skew``); the result
itself is computed by the caller's action.  ``materialize_counts=True``
checkpoints the tables that several others read to the session's shared
checkpoint folder, which runs them: the per-paper counts and the cited papers'
links, and in the gap variant the gap counts (two edge joins); the four weight
tables are kept as Parquet files there.  Checkpoint
files live as long as the folder does (Spark removes them with
``spark.cleaner.referenceTracking.cleanCheckpoints``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmetrics.functions.predicates import below_cap, papers_of_year
from scholarmetrics.operators import features as X
from scholarmetrics.operators import weights as W
from scholarmetrics.operators.counts import papers_with_counts
from scholarmetrics.operators.links import authorships_of, citations_to
from scholarmetrics.operators.skew import hot_profile
from scholarmetrics.operators.temporal import edges_with_gap, gap_counts
from scholarmetrics.schemas import Tables
from scholarmetrics.sources.tables import materialize, materialize_files


@dataclass
class YearFeatures:
    tables: Tables
    year: int
    author_credit: str = "position"
    materialize_counts: bool = False

    @cached_property
    def papers(self) -> DataFrame:
        """All columns of the papers table; Catalyst prunes those a step never reads."""
        return papers_of_year(self.tables.papers, self.year)

    @cached_property
    def citations(self) -> DataFrame:
        return citations_to(self.tables.paper_references, self.papers)

    @cached_property
    def authorships(self) -> DataFrame:
        return authorships_of(self.tables.paper_authors, self.papers)

    @cached_property
    def counts(self) -> DataFrame:
        pc = papers_with_counts(self.papers, self.citations, restrict_edges=False)
        return materialize(pc) if self.materialize_counts else pc

    @cached_property
    def author_weights(self) -> DataFrame:
        return W.author_weights(self.counts, self.tables.paper_authors, self.author_credit)

    @cached_property
    def affiliation_weights(self) -> DataFrame:
        return W.affiliation_weights(self.counts, self.tables.paper_authors)

    @cached_property
    def venue_weights(self) -> DataFrame:
        return W.venue_weights(self.counts)

    @cached_property
    def field_weights(self) -> DataFrame:
        return W.field_weights(self.counts, self.tables.paper_keywords)

    @cached_property
    def venue_feature(self) -> DataFrame:
        return X.paper_venue_feature(self.papers, self.venue_weights, detect_on=self.tables.papers)

    @cached_property
    def author_feature(self) -> DataFrame:
        return X.paper_author_feature(self.authorships, self.author_weights, detect_on=self.tables.paper_authors)

    @cached_property
    def affiliation_feature(self) -> DataFrame:
        return X.paper_affiliation_feature(
            self.authorships, self.affiliation_weights, detect_on=self.tables.paper_authors
        )

    @cached_property
    def field_feature(self) -> DataFrame:
        return X.paper_field_feature(
            self.tables.paper_keywords, self.field_weights, detect_on=self.tables.paper_keywords
        )

    def outputs(self) -> dict[str, DataFrame]:
        """The year build's intermediate tables, by name: papers of the year,
        the citations they received, their author links, the per-paper counts
        and the four entity weights.  Five of them read the counts, so build
        with ``materialize_counts=True`` when writing them all."""
        return {
            "papers": self.papers,
            "citations": self.citations,
            "authorships": self.authorships,
            "paper_counts": self.counts,
            "author_weights": self.author_weights,
            "affiliation_weights": self.affiliation_weights,
            "venue_weights": self.venue_weights,
            "field_weights": self.field_weights,
        }

    @cached_property
    def cited_links(self) -> DataFrame:
        """All links of the year's cited papers, tagged by kind; kept with the counts,
        since the merge reads them twice (weights, then lookup)."""
        t = self.tables
        rows = X.cited_links(self.counts, t.paper_authors, t.paper_keywords, self.author_credit)
        return materialize(rows) if self.materialize_counts else rows

    @cached_property
    def merged(self) -> DataFrame:
        """X9.  The merge keeps only the cited papers of the year and uses positive
        weights only (F8), so it needs the links of those papers alone: the link and
        keyword tables are each joined to them once and never read whole.  Their
        entities' weights come from one aggregate over all kinds, the features and the
        base from one group by paper.

        A position 0 on a link of an uncited paper does not stop this merge,
        because the weights here read only links of cited papers.  The weight
        queries themselves still fail on it."""
        t = self.tables
        # hot entities are detected on the whole tables (remembered per session), not
        # on the year's derived subsets
        links, kw, papers = hot_profile(t.paper_authors), hot_profile(t.paper_keywords), hot_profile(t.papers)
        venues: dict[str, float] = {}
        for name, share in papers.get("venue_key", {}).items():
            venues[name.lower()] = venues.get(name.lower(), 0.0) + share
        hot = {
            "author": links.get("author_id", {}),
            "affiliation": links.get("affiliation_id", {}),
            "field": kw.get("fos_id", {}),
            "venue": venues,
        }
        return X.merge_links(self.cited_links, hot)


@dataclass
class GapFeatures:
    tables: Tables
    gap: int = 3
    by: str = "cited"
    cap: int | None = None
    materialize_counts: bool = False
    #: The raw venue: source column 5 of a dump (``c5``), ``venue_key`` of the fixture.
    venue_col: str = "venue_key"

    def _kept(self, df: DataFrame) -> DataFrame:
        return materialize(df) if self.materialize_counts else df

    def _kept_weights(self, df: DataFrame) -> DataFrame:
        """Weights are kept as files: the sums look links up in them, and the planner
        broadcasts those that are small, so that no link is shuffled by its entity."""
        return materialize_files(df) if self.materialize_counts else df

    @cached_property
    def total_counts(self) -> DataFrame:
        """Every paper with its total citation count, below ``cap`` if one is set
        (F14), with its year (J7): ``(paper_id, nb_citations, year)``."""
        p = self.tables.papers.select("paper_id", "year")
        pc = papers_with_counts(p, self.tables.paper_references, restrict_edges=False)
        if self.cap is not None:
            pc = below_cap(pc, self.cap)
        # The counts already carry the year, so J7's join back to the papers
        # (needed when the counts come from a file without it) is skipped.
        out = pc.select("paper_id", "nb_citations", "year")
        return self._kept(out)

    @cached_property
    def gap_counts(self) -> DataFrame:
        """E2/E3 over the (capped) paper set: ``(paper_id, nb_citations)``."""
        return self._kept(gap_counts(self.tables.paper_references, self.total_counts, self.gap, self.by))

    @cached_property
    def link_weights(self) -> DataFrame:
        """W8 and W9 from one join of the links to the gap counts."""
        return self._kept_weights(W.link_mean_weights(self.gap_counts, self.tables.paper_authors))

    def _shared(self) -> DataFrame | None:
        """One link join for both only where both are kept; alone, each is direct."""
        return self.link_weights if self.materialize_counts else None

    @cached_property
    def author_weights(self) -> DataFrame:
        return W.author_mean_weights(self.gap_counts, self.tables.paper_authors, shared=self._shared())

    @cached_property
    def affiliation_weights(self) -> DataFrame:
        return W.affiliation_mean_weights(self.gap_counts, self.tables.paper_authors, shared=self._shared())

    @cached_property
    def field_weights(self) -> DataFrame:
        return self._kept_weights(W.field_mean_weights(self.gap_counts, self.tables.paper_keywords))

    @cached_property
    def venue_weights(self) -> DataFrame:
        return self._kept_weights(W.venue_mean_weights(self.gap_counts, self.tables.papers, self.venue_col))

    @cached_property
    def author_sum(self) -> DataFrame:
        return X.paper_author_sum(self.tables.paper_authors, self.author_weights, self.total_counts)

    @cached_property
    def affiliation_sum(self) -> DataFrame:
        return X.paper_affiliation_sum(self.tables.paper_authors, self.affiliation_weights, self.total_counts)

    @cached_property
    def field_sum(self) -> DataFrame:
        return X.paper_field_sum(self.tables.paper_keywords, self.field_weights, self.total_counts)

    @cached_property
    def venue_sum(self) -> DataFrame:
        return X.paper_venue_sum(self.tables.papers, self.venue_weights, self.gap_counts, self.venue_col)

    @cached_property
    def combined(self) -> DataFrame:
        """X10."""
        return X.all_weights(self.author_sum, self.affiliation_sum, self.field_sum, self.venue_sum)

    @cached_property
    def author_full_sum(self) -> DataFrame:
        """Second author-feature variant for J10: full-credit sums of gap counts
        (W1 over the gap counts) summed per paper."""
        w = W.author_weights(
            self.gap_counts.select("paper_id", F.col("nb_citations")), self.tables.paper_authors, "full"
        )
        return X.paper_author_sum(self.tables.paper_authors, w, self.total_counts)

    @cached_property
    def author_pair(self) -> DataFrame:
        """J10."""
        return X.author_feature_pair(self.author_sum, self.author_full_sum)

    def outputs(self) -> dict[str, DataFrame]:
        """The gap variant's tables, by name: the (capped) paper counts with
        their years, the edges of the gap, the gap counts, the four mean
        weights, the four per-paper sums and their merge (X10).  Most read the
        counts, so build with ``materialize_counts=True`` when writing them
        all."""
        return {
            "paper_counts": self.total_counts,
            "gap_edges": edges_with_gap(self.tables.paper_references, self.total_counts, self.gap),
            "gap_counts": self.gap_counts,
            "author_weights": self.author_weights,
            "affiliation_weights": self.affiliation_weights,
            "field_weights": self.field_weights,
            "venue_weights": self.venue_weights,
            "paper_author_weight": self.author_sum,
            "paper_affiliation_weight": self.affiliation_sum,
            "paper_field_weight": self.field_sum,
            "paper_venue_weight": self.venue_sum,
            "all_weights": self.combined,
        }
