"""scholarmetrics: bibliometric analytics as Spark DataFrame plans.

From papers, citation edges, paper-author-affiliation links, paper keywords and
fields of study, the package counts citations, spreads them as weights over
authors, affiliations, venues and fields, counts citations by year gap, folds
the weights into one feature row per paper, and fits a linear model of
citation counts.  Every operator takes DataFrames and returns a DataFrame; no
operator collects data to the driver or runs per-row Python.

Layout:

- ``sources``    readers, sinks, the fixture views over the driver tables
- ``functions``  column expressions and row filters
- ``operators``  joins, counts, weights, gap counts, features, model
- ``plans``      multi-step workflows, the query catalog, plan inspection
- ``streaming``  incremental citation counts over an arriving edge feed
"""

from scholarmetrics.schemas import Tables

__all__ = ["Tables"]
__version__ = "0.1.0"
