"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each query text starts with the fixture views (the same mapping as
``sources.fixtures``) and the derived tables it needs, as CTEs over the driver's
pre-registered tables ``orders lineitem part supplier``.  Parameters and
column names equal those of ``plans.catalog``; double outputs are rounded to 6
decimals on both sides.
"""

from __future__ import annotations

import re

from scholarmetrics.plans.catalog import (
    AUTHOR_THRESHOLD,
    CITATION_CAP,
    DAMAGE_EVERY,
    FIELD_ID,
    FIELD_PHRASE,
    GAP,
    HIST_HI,
    HIST_LO,
    HIST_WIDTH,
    NEWER_THAN,
    TOP_K,
    YEAR,
)

_N_BUCKETS = len(range(HIST_LO, HIST_HI, HIST_WIDTH)) - 1
_HIST_TOP = HIST_LO + _N_BUCKETS * HIST_WIDTH


def _least_squares(p: str, source: str) -> list[tuple[str, str]]:
    """CTEs, named from ``p``, that fit four features of ``source``'s training rows: each
    feature is freed of the ones before it, the label is projected on what is left, and
    the coefficients ``k0`` to ``k4`` (table ``{p}coef``) are substituted back."""
    return [
        (f"{p}s1", f"""
        SELECT nb_citations AS y, author_weight AS x1, affiliation_weight AS x2, venue_weight AS x3, field_weight AS x4,
               author_weight - avg(author_weight) OVER () AS r1 FROM {source} WHERE is_train"""),
        (f"{p}b2", f"SELECT regr_slope(x2, r1) AS b21, avg(x2) AS m2 FROM {p}s1"),
        (f"{p}s2", f"SELECT s.*, x2 - m2 - b21 * r1 AS r2 FROM {p}s1 s, {p}b2"),
        (f"{p}b3", f"SELECT regr_slope(x3, r1) AS b31, regr_slope(x3, r2) AS b32, avg(x3) AS m3 FROM {p}s2"),
        (f"{p}s3", f"SELECT s.*, x3 - m3 - b31 * r1 - b32 * r2 AS r3 FROM {p}s2 s, {p}b3"),
        (f"{p}b4", f"""
        SELECT regr_slope(x4, r1) AS b41, regr_slope(x4, r2) AS b42, regr_slope(x4, r3) AS b43, avg(x4) AS m4 FROM {p}s3"""),
        (f"{p}s4", f"SELECT s.*, x4 - m4 - b41 * r1 - b42 * r2 - b43 * r3 AS r4 FROM {p}s3 s, {p}b4"),
        (f"{p}g", f"""
        SELECT regr_slope(y, r1) AS g1, regr_slope(y, r2) AS g2, regr_slope(y, r3) AS g3, regr_slope(y, r4) AS g4,
               avg(y) AS my, avg(x1) AS m1 FROM {p}s4"""),
        (f"{p}c4", f"SELECT g4 AS k4, g3 - b43 * g4 AS k3, * FROM {p}g, {p}b2, {p}b3, {p}b4"),
        (f"{p}c2", f"SELECT g2 - b32 * k3 - b42 * k4 AS k2, * FROM {p}c4"),
        (f"{p}c1", f"SELECT g1 - b21 * k2 - b31 * k3 - b41 * k4 AS k1, * FROM {p}c2"),
        (f"{p}coef", f"SELECT my - k1 * m1 - k2 * m2 - k3 * m3 - k4 * m4 AS k0, k1, k2, k3, k4 FROM {p}c1"),
    ]


# Named CTEs in definition order; a query pulls in the ones it references.
_CTES: list[tuple[str, str]] = [
    # fixture views
    ("papers", """
        SELECT CAST(o_orderkey AS VARCHAR) AS paper_id,
               CAST(year(o_orderdate) AS INTEGER) AS year,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END AS venue_key
        FROM orders"""),
    ("papers_wide", """
        SELECT CAST(o_orderkey AS VARCHAR) AS paper_id, CAST(o_custkey AS VARCHAR) AS c1, o_orderstatus AS c2,
               CAST(year(o_orderdate) AS INTEGER) AS year, '' AS c4,
               o_orderstatus || '/' || o_orderpriority AS c5, o_orderpriority AS c6,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END AS venue_key,
               strftime(o_orderdate, '%Y-%m-%d') AS c8, '' AS c9, CAST(o_custkey AS VARCHAR) AS c10
        FROM orders"""),
    ("paper_references", """
        SELECT CAST(l_orderkey AS VARCHAR) AS citing_id, CAST(l_partkey AS VARCHAR) AS cited_id
        FROM lineitem"""),
    ("paper_authors", """
        SELECT CAST(l_orderkey AS VARCHAR) AS paper_id,
               CASE WHEN l_linenumber = 7 THEN '' ELSE CAST(l_suppkey AS VARCHAR) END AS author_id,
               CASE WHEN l_returnflag = 'R' THEN '' ELSE CAST(s_nationkey AS VARCHAR) END AS affiliation_id,
               l_linenumber AS author_seq
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""),
    ("paper_keywords", """
        SELECT CAST(l_orderkey AS VARCHAR) AS paper_id, p_name AS keyword, p_brand AS fos_id
        FROM lineitem JOIN part ON l_partkey = p_partkey"""),
    ("fields_of_study", """
        SELECT DISTINCT p_brand AS fos_id, 'Field of ' || p_brand AS fos_name FROM part"""),
    ("authors", """
        SELECT CAST(s_suppkey AS VARCHAR) AS author_id, s_name AS author_name FROM supplier"""),
    # counts over all papers
    ("cc_all", """
        SELECT cited_id AS paper_id, count(*) AS nb_citations FROM paper_references GROUP BY cited_id"""),
    ("pc_all", """
        SELECT p.paper_id, p.year, p.venue_key, CAST(COALESCE(c.nb_citations, 0) AS BIGINT) AS nb_citations
        FROM papers p LEFT JOIN cc_all c ON p.paper_id = c.paper_id"""),
    ("lac", """
        SELECT author_id, count(*) AS nb_links FROM paper_authors
        WHERE author_id <> '' AND author_seq IN (1, 2) GROUP BY author_id"""),
    ("kc", """
        SELECT keyword, count(*) AS nb_rows FROM paper_keywords GROUP BY keyword"""),
    # year subset
    ("py", f"""
        SELECT paper_id, year, venue_key FROM papers WHERE year = {YEAR}"""),
    ("ey", """
        SELECT citing_id, cited_id FROM paper_references WHERE cited_id IN (SELECT paper_id FROM py)"""),
    ("paa_y", """
        SELECT * FROM paper_authors WHERE paper_id IN (SELECT paper_id FROM py)"""),
    ("pc", """
        SELECT py.paper_id, py.year, py.venue_key, CAST(COALESCE(c.nb, 0) AS BIGINT) AS nb_citations
        FROM py LEFT JOIN (SELECT cited_id AS paper_id, count(*) AS nb FROM ey GROUP BY cited_id) c
          ON py.paper_id = c.paper_id"""),
    ("cited", """
        SELECT paper_id, nb_citations AS nb FROM pc WHERE nb_citations > 0"""),
    ("w_author_pos", """
        SELECT a.author_id, sum(CAST(COALESCE(c.nb, 0) AS DOUBLE) * (1.0E0 / a.author_seq)) AS weight
        FROM paper_authors a LEFT JOIN cited c ON a.paper_id = c.paper_id
        WHERE a.author_id <> '' GROUP BY a.author_id"""),
    ("w_affiliation", """
        SELECT a.affiliation_id, CAST(sum(COALESCE(c.nb, 0)) AS BIGINT) AS weight
        FROM paper_authors a LEFT JOIN cited c ON a.paper_id = c.paper_id
        WHERE a.affiliation_id <> '' GROUP BY a.affiliation_id"""),
    ("w_venue", """
        SELECT lower(venue_key) AS venue, CAST(sum(nb_citations) AS BIGINT) AS weight
        FROM pc WHERE nb_citations > 0 AND lower(venue_key) <> '' GROUP BY lower(venue_key)"""),
    ("w_field", """
        SELECT k.fos_id, CAST(sum(COALESCE(c.nb, 0)) AS BIGINT) AS weight
        FROM paper_keywords k LEFT JOIN cited c ON k.paper_id = c.paper_id GROUP BY k.fos_id"""),
    ("x_venue", """
        SELECT p.paper_id, COALESCE(w.weight, 0.0) AS venue_weight
        FROM py p LEFT JOIN (SELECT venue, CAST(weight AS DOUBLE) AS weight FROM w_venue WHERE weight > 0) w
          ON lower(p.venue_key) = w.venue"""),
    ("x_author", """
        SELECT l.paper_id, avg(COALESCE(w.weight, 0.0)) AS author_weight
        FROM paa_y l LEFT JOIN (SELECT author_id, CAST(weight AS DOUBLE) AS weight FROM w_author_pos WHERE weight > 0) w
          ON l.author_id = w.author_id
        WHERE l.author_id <> '' GROUP BY l.paper_id"""),
    ("x_affiliation", """
        SELECT l.paper_id, avg(COALESCE(w.weight, 0.0)) AS affiliation_weight
        FROM paa_y l LEFT JOIN (SELECT affiliation_id, CAST(weight AS DOUBLE) AS weight FROM w_affiliation WHERE weight > 0) w
          ON l.affiliation_id = w.affiliation_id
        WHERE l.affiliation_id <> '' GROUP BY l.paper_id"""),
    ("x_field", """
        SELECT k.paper_id, avg(COALESCE(w.weight, 0.0)) AS field_weight
        FROM paper_keywords k LEFT JOIN (SELECT fos_id, CAST(weight AS DOUBLE) AS weight FROM w_field WHERE weight > 0) w
          ON k.fos_id = w.fos_id
        GROUP BY k.paper_id"""),
    ("merged", """
        SELECT c.paper_id, f.field_weight, v.venue_weight, af.affiliation_weight, au.author_weight,
               CAST(c.nb AS DOUBLE) AS nb_citations
        FROM cited c
        LEFT JOIN x_author au ON c.paper_id = au.paper_id
        LEFT JOIN x_affiliation af ON c.paper_id = af.paper_id
        LEFT JOIN x_venue v ON c.paper_id = v.paper_id
        LEFT JOIN x_field f ON c.paper_id = f.paper_id"""),
    # model frame
    ("mf", """
        SELECT paper_id, nb_citations,
               COALESCE(author_weight, 0.0) AS author_weight,
               COALESCE(affiliation_weight, 0.0) AS affiliation_weight,
               COALESCE(venue_weight, 0.0) AS venue_weight,
               COALESCE(field_weight, 0.0) AS field_weight,
               (('0x' || substr(md5(paper_id || ':11'), 1, 8))::BIGINT % 10) < 7 AS is_train
        FROM merged"""),
    ("coef", """
        SELECT regr_intercept(nb_citations, author_weight) AS b0, regr_slope(nb_citations, author_weight) AS b1
        FROM mf WHERE is_train"""),
    *_least_squares("l", "mf"),
    # the same rows scaled to length 1
    ("mn", """
        SELECT paper_id, nb_citations, is_train,
               CASE WHEN nrm = 0 THEN author_weight ELSE author_weight / nrm END AS author_weight,
               CASE WHEN nrm = 0 THEN affiliation_weight ELSE affiliation_weight / nrm END AS affiliation_weight,
               CASE WHEN nrm = 0 THEN venue_weight ELSE venue_weight / nrm END AS venue_weight,
               CASE WHEN nrm = 0 THEN field_weight ELSE field_weight / nrm END AS field_weight
        FROM (SELECT *, sqrt(author_weight * author_weight + affiliation_weight * affiliation_weight
                             + venue_weight * venue_weight + field_weight * field_weight) AS nrm FROM mf)"""),
    *_least_squares("n", "mn"),
    # gap-limited variant (all papers)
    ("tc", """
        SELECT paper_id, nb_citations, year FROM pc_all"""),
    ("ewy", """
        SELECT e.cited_id, d.year AS cited_year, e.citing_id, g.year AS citing_year
        FROM paper_references e
        JOIN tc g ON e.citing_id = g.paper_id
        JOIN tc d ON e.cited_id = d.paper_id"""),
    ("eg", f"""
        SELECT cited_id, citing_id FROM ewy WHERE citing_year - cited_year = {GAP}"""),
    ("gc", """
        SELECT t.paper_id, CAST(COALESCE(x.nb, 0) AS BIGINT) AS nb_citations
        FROM tc t LEFT JOIN (SELECT cited_id AS paper_id, count(*) AS nb FROM eg GROUP BY cited_id) x
          ON t.paper_id = x.paper_id"""),
    ("gw_author", """
        SELECT a.author_id, avg((1.0E0 / a.author_seq) * CAST(g.nb_citations AS DOUBLE)) AS weight
        FROM paper_authors a JOIN gc g ON a.paper_id = g.paper_id
        WHERE a.author_id <> '' GROUP BY a.author_id"""),
    ("gw_affiliation", """
        SELECT a.affiliation_id, avg((1.0E0 / a.author_seq) * CAST(g.nb_citations AS DOUBLE)) AS weight
        FROM paper_authors a JOIN gc g ON a.paper_id = g.paper_id
        WHERE a.affiliation_id <> '' GROUP BY a.affiliation_id"""),
    ("gw_field", """
        SELECT k.fos_id, avg(CAST(g.nb_citations AS DOUBLE)) AS weight
        FROM paper_keywords k JOIN gc g ON k.paper_id = g.paper_id GROUP BY k.fos_id"""),
    ("gw_venue", """
        SELECT p.venue_key AS venue, avg(CAST(g.nb_citations AS DOUBLE)) AS weight
        FROM gc g JOIN papers p ON g.paper_id = p.paper_id GROUP BY p.venue_key"""),
    ("gx_author", """
        SELECT t.paper_id, CAST(t.nb_citations AS DOUBLE) AS nb_citations, s.author_weight
        FROM tc t JOIN (
            SELECT a.paper_id, sum(CAST(w.weight AS DOUBLE)) AS author_weight
            FROM paper_authors a JOIN gw_author w ON a.author_id = w.author_id
            WHERE a.author_id <> '' GROUP BY a.paper_id) s ON t.paper_id = s.paper_id"""),
    ("gx_affiliation", """
        SELECT t.paper_id, CAST(t.nb_citations AS DOUBLE) AS nb_citations,
               COALESCE(s.w, 0.0) AS affiliation_weight
        FROM tc t LEFT JOIN (
            SELECT a.paper_id, sum(CAST(w.weight AS DOUBLE)) AS w
            FROM paper_authors a JOIN gw_affiliation w ON a.affiliation_id = w.affiliation_id
            WHERE a.affiliation_id <> '' GROUP BY a.paper_id) s ON t.paper_id = s.paper_id"""),
    ("gx_field", """
        SELECT t.paper_id, CAST(t.nb_citations AS DOUBLE) AS nb_citations,
               COALESCE(s.w, 0.0) AS field_weight
        FROM tc t LEFT JOIN (
            SELECT k.paper_id, sum(COALESCE(CAST(w.weight AS DOUBLE), 0.0)) AS w
            FROM paper_keywords k LEFT JOIN gw_field w ON k.fos_id = w.fos_id
            GROUP BY k.paper_id) s ON t.paper_id = s.paper_id"""),
    ("gx_venue", """
        SELECT g.paper_id, CAST(g.nb_citations AS DOUBLE) AS nb_citations, s.venue_weight
        FROM gc g JOIN (
            SELECT p.paper_id, sum(CAST(w.weight AS DOUBLE)) AS venue_weight
            FROM papers p JOIN gw_venue w ON p.venue_key = w.venue GROUP BY p.paper_id) s
          ON g.paper_id = s.paper_id"""),
    ("gw_venue_c5", """
        SELECT p.c5 AS venue, avg(CAST(g.nb_citations AS DOUBLE)) AS weight
        FROM gc g JOIN papers_wide p ON g.paper_id = p.paper_id GROUP BY p.c5"""),
    ("gw_author_full", """
        SELECT a.author_id, CAST(sum(COALESCE(c.nb, 0)) AS BIGINT) AS weight
        FROM paper_authors a
        LEFT JOIN (SELECT paper_id, nb_citations AS nb FROM gc WHERE nb_citations > 0) c
          ON a.paper_id = c.paper_id
        WHERE a.author_id <> '' GROUP BY a.author_id"""),
    ("gx_author_full", """
        SELECT t.paper_id, CAST(t.nb_citations AS DOUBLE) AS nb_citations, s.author_weight
        FROM tc t JOIN (
            SELECT a.paper_id, sum(CAST(w.weight AS DOUBLE)) AS author_weight
            FROM paper_authors a JOIN gw_author_full w ON a.author_id = w.author_id
            WHERE a.author_id <> '' GROUP BY a.paper_id) s ON t.paper_id = s.paper_id"""),
    # gap counts over the capped paper set
    ("tc_cap", f"""
        SELECT paper_id, nb_citations, year FROM pc_all WHERE nb_citations < {CITATION_CAP}"""),
    ("gc_cap", f"""
        SELECT t.paper_id, CAST(COALESCE(x.nb, 0) AS BIGINT) AS nb_citations
        FROM tc_cap t LEFT JOIN (
            SELECT e.cited_id AS paper_id, count(*) AS nb
            FROM paper_references e
            JOIN tc_cap g ON e.citing_id = g.paper_id
            JOIN tc_cap d ON e.cited_id = d.paper_id
            WHERE g.year - d.year = {GAP}
            GROUP BY e.cited_id) x ON t.paper_id = x.paper_id"""),
]
_CTE_NAMES = [n for n, _ in _CTES]
_CTE_BODY = dict(_CTES)


def _refs(text: str) -> set[str]:
    return {n for n in _CTE_NAMES if re.search(rf"\b{n}\b", text)}


def _sql(final: str) -> str:
    """``WITH`` the CTEs ``final`` needs (transitively), in definition order."""
    need: set[str] = set()
    todo = list(_refs(final))
    while todo:
        n = todo.pop()
        if n in need:
            continue
        need.add(n)
        todo.extend(_refs(_CTE_BODY[n]) - need - {n})
    ctes = ",\n".join(f"{n} AS ({_CTE_BODY[n].strip()})" for n in _CTE_NAMES if n in need)
    return f"WITH {ctes}\n{final.strip()}" if ctes else final.strip()


def _r(expr: str, alias: str) -> str:
    return f"round({expr}, 6) AS {alias}"


_FINAL: dict[str, str] = {
    # filters and joins
    "papers_of_year": f"SELECT paper_id, year, venue_key FROM papers WHERE year = {YEAR}",
    "papers_newer_than": f"SELECT paper_id, year, venue_key FROM papers WHERE year > {NEWER_THAN}",
    "leading_author_links": """
        SELECT paper_id, author_id, affiliation_id, author_seq FROM paper_authors
        WHERE author_id <> '' AND author_seq IN (1, 2)""",
    "fields_of_study_like": f"SELECT fos_id, fos_name FROM fields_of_study WHERE contains(fos_name, '{FIELD_PHRASE}')",
    "citations_to_year": "SELECT citing_id, cited_id FROM ey",
    "citations_to_newer": f"""
        SELECT citing_id, cited_id FROM paper_references
        WHERE cited_id IN (SELECT paper_id FROM papers WHERE year > {NEWER_THAN})""",
    "authorships_of_year": "SELECT paper_id, author_id, affiliation_id, author_seq FROM paa_y",
    "author_name_lookup": f"""
        SELECT a.author_id, a.author_name, CAST(COALESCE(p.nb_links, -1) AS BIGINT) AS nb_links
        FROM authors a LEFT JOIN (SELECT author_id, nb_links FROM lac WHERE nb_links > {AUTHOR_THRESHOLD}) p
          ON a.author_id = p.author_id""",
    "paper_citation_pairs": """
        SELECT p.paper_id, p.year, p.venue_key, e.citing_id
        FROM papers p JOIN paper_references e ON p.paper_id = e.cited_id""",
    "edges_with_years": "SELECT cited_id, cited_year, citing_id, citing_year FROM ewy",
    "papers_below_cap": f"SELECT paper_id, nb_citations FROM pc_all WHERE nb_citations < {CITATION_CAP}",
    "counts_with_year": f"""
        SELECT c.paper_id, c.nb_citations, p.year
        FROM (SELECT paper_id, nb_citations FROM pc_all WHERE nb_citations < {CITATION_CAP}) c
        JOIN papers p ON c.paper_id = p.paper_id""",
    # counts, statistics, top-k
    "citation_counts": "SELECT paper_id, nb_citations FROM cc_all",
    "papers_with_counts": "SELECT paper_id, year, venue_key, nb_citations FROM pc",
    "keyword_counts": "SELECT keyword, nb_rows FROM kc",
    "leading_author_counts": "SELECT author_id, nb_links FROM lac",
    "papers_in_field": f"""
        SELECT paper_id, count(*) AS nb_keywords FROM paper_keywords
        WHERE fos_id = '{FIELD_ID}' GROUP BY paper_id""",
    "citation_histogram": f"""
        SELECT b.bucket, b.bucket_lo, b.bucket_hi, CAST(COALESCE(h.nb, 0) AS BIGINT) AS nb
        FROM (SELECT CAST(i AS INTEGER) AS bucket,
                     CAST({HIST_LO} + i * {HIST_WIDTH} AS BIGINT) AS bucket_lo,
                     CAST({HIST_LO} + (i + 1) * {HIST_WIDTH} AS BIGINT) AS bucket_hi
              FROM range({_N_BUCKETS}) t(i)) b
        LEFT JOIN (
            SELECT CAST(least(floor((nb_citations - {HIST_LO}) / {HIST_WIDTH}), {_N_BUCKETS - 1}) AS INTEGER) AS bucket,
                   count(*) AS nb
            FROM cc_all WHERE nb_citations >= {HIST_LO} AND nb_citations <= {_HIST_TOP}
            GROUP BY 1) h ON b.bucket = h.bucket""",
    "citation_count_stats": f"""
        SELECT count(nb_citations) AS n, {_r("avg(nb_citations)", "mean")},
               {_r("stddev_pop(nb_citations)", "stdev")},
               max(nb_citations) AS max, min(nb_citations) AS min
        FROM cc_all""",
    "author_count_stats": f"""
        SELECT count(nb_links) AS n, {_r("avg(nb_links)", "mean")}, {_r("stddev_pop(nb_links)", "stdev")},
               max(nb_links) AS max, min(nb_links) AS min
        FROM lac""",
    "top_keywords": f"SELECT keyword, nb_rows FROM kc ORDER BY nb_rows DESC, keyword ASC LIMIT {TOP_K}",
    "prolific_authors": f"SELECT author_id, nb_links FROM lac WHERE nb_links > {AUTHOR_THRESHOLD}",
    "top_authors_named": f"""
        SELECT l.author_id, a.author_name, l.nb_links
        FROM lac l JOIN authors a ON l.author_id = a.author_id
        ORDER BY l.nb_links DESC, l.author_id ASC LIMIT {TOP_K}""",
    # weights (year subset)
    "author_weights_full": """
        SELECT a.author_id, CAST(sum(COALESCE(c.nb, 0)) AS BIGINT) AS weight
        FROM paper_authors a LEFT JOIN cited c ON a.paper_id = c.paper_id
        WHERE a.author_id <> '' GROUP BY a.author_id""",
    "author_weights_position": f"SELECT author_id, {_r('weight', 'weight')} FROM w_author_pos",
    "affiliation_weights": "SELECT affiliation_id, weight FROM w_affiliation",
    "affiliation_weights_by_author_link": """
        SELECT a.affiliation_id, CAST(sum(COALESCE(c.nb, 0)) AS BIGINT) AS weight
        FROM paper_authors a LEFT JOIN cited c ON a.paper_id = c.paper_id
        WHERE a.author_id <> '' GROUP BY a.affiliation_id""",
    "venue_weights": "SELECT venue, weight FROM w_venue",
    "venue_weights_raw": """
        SELECT venue_key AS venue, CAST(sum(nb_citations) AS BIGINT) AS weight
        FROM pc WHERE nb_citations > 0 GROUP BY venue_key""",
    "field_weights": "SELECT fos_id, weight FROM w_field",
    # per-paper features (year subset)
    "paper_venue_feature": f"SELECT paper_id, {_r('venue_weight', 'venue_weight')} FROM x_venue",
    "paper_author_feature": f"SELECT paper_id, {_r('author_weight', 'author_weight')} FROM x_author",
    "paper_affiliation_feature": f"SELECT paper_id, {_r('affiliation_weight', 'affiliation_weight')} FROM x_affiliation",
    "paper_field_feature": f"SELECT paper_id, {_r('field_weight', 'field_weight')} FROM x_field",
    "merged_features": f"""
        SELECT paper_id, {_r('field_weight', 'field_weight')}, {_r('venue_weight', 'venue_weight')},
               {_r('affiliation_weight', 'affiliation_weight')}, {_r('author_weight', 'author_weight')},
               {_r('nb_citations', 'nb_citations')}
        FROM merged""",
    # gap-limited variant
    "edges_with_gap": "SELECT cited_id, citing_id FROM eg",
    "gap_counts_cited": "SELECT paper_id, nb_citations FROM gc",
    "gap_counts_citing": f"""
        SELECT t.paper_id, CAST(COALESCE(x.nb, 0) AS BIGINT) AS nb_citations
        FROM tc t LEFT JOIN (SELECT citing_id AS paper_id, count(*) AS nb FROM eg GROUP BY citing_id) x
          ON t.paper_id = x.paper_id""",
    "gap_counts_capped": "SELECT paper_id, nb_citations FROM gc_cap",
    "author_weights_mean": f"SELECT author_id, {_r('weight', 'weight')} FROM gw_author",
    "affiliation_weights_mean": f"SELECT affiliation_id, {_r('weight', 'weight')} FROM gw_affiliation",
    "field_weights_mean": f"SELECT fos_id, {_r('weight', 'weight')} FROM gw_field",
    "venue_weights_mean": f"SELECT venue, {_r('weight', 'weight')} FROM gw_venue",
    "paper_author_sum": f"""
        SELECT paper_id, {_r('nb_citations', 'nb_citations')}, {_r('author_weight', 'author_weight')}
        FROM gx_author""",
    "paper_affiliation_sum": f"""
        SELECT paper_id, {_r('nb_citations', 'nb_citations')}, {_r('affiliation_weight', 'affiliation_weight')}
        FROM gx_affiliation""",
    "paper_field_sum": f"""
        SELECT paper_id, {_r('nb_citations', 'nb_citations')}, {_r('field_weight', 'field_weight')}
        FROM gx_field""",
    "paper_venue_sum": f"""
        SELECT paper_id, {_r('nb_citations', 'nb_citations')}, {_r('venue_weight', 'venue_weight')}
        FROM gx_venue""",
    "all_weights": f"""
        SELECT a.paper_id, {_r('a.nb_citations', 'nb_citations')}, {_r('a.author_weight', 'author_weight')},
               {_r('f.affiliation_weight', 'affiliation_weight')}, {_r('k.field_weight', 'field_weight')},
               {_r('v.venue_weight', 'venue_weight')}
        FROM gx_author a
        JOIN gx_affiliation f ON a.paper_id = f.paper_id
        JOIN gx_field k ON a.paper_id = k.paper_id
        JOIN gx_venue v ON a.paper_id = v.paper_id""",
    "author_feature_pair": f"""
        SELECT a.paper_id, {_r('a.nb_citations', 'nb_citations')}, {_r('a.author_weight', 'author_weight_a')},
               {_r('b.author_weight', 'author_weight_b')}
        FROM gx_author a JOIN gx_author_full b ON a.paper_id = b.paper_id""",
    # model
    "normalized_features": f"""
        SELECT paper_id, {_r('nb_citations', 'nb_citations')}, {_r('author_weight', 'author_weight')},
               {_r('affiliation_weight', 'affiliation_weight')}, {_r('venue_weight', 'venue_weight')},
               {_r('field_weight', 'field_weight')} FROM mn""",
    "train_test_split": "SELECT paper_id, is_train FROM mf",
    "linear_model_coefficients": f"SELECT {_r('b0', 'intercept')}, {_r('b1', 'author_weight')} FROM coef",
    "linear_model_mse": f"""
        SELECT {_r('avg((e.p - e.y) * (e.p - e.y))', 'mse')}, count(*) AS n
        FROM (SELECT (SELECT b0 FROM coef) + (SELECT b1 FROM coef) * author_weight AS p, nb_citations AS y
              FROM mf WHERE NOT is_train) e""",
}

_WIDE = "paper_id, c1, c2, year, c4, c5, c6, venue_key, c8, c9, c10"
_TRAIN = "(('0x' || substr(md5(paper_id || ':11'), 1, 8))::BIGINT % 10) < 7"
_FINAL |= {
    "build_features": """
        SELECT 'papers' AS output, paper_id AS key, CAST(year AS DOUBLE) AS value FROM py
        UNION ALL SELECT 'citations', citing_id || '>' || cited_id, 1.0 FROM ey
        UNION ALL SELECT 'authorships', paper_id || '|' || author_id || '|' || affiliation_id, CAST(author_seq AS DOUBLE) FROM paa_y
        UNION ALL SELECT 'paper_counts', paper_id, CAST(nb_citations AS DOUBLE) FROM pc
        UNION ALL SELECT 'author_weights', author_id, round(weight, 6) FROM w_author_pos
        UNION ALL SELECT 'affiliation_weights', affiliation_id, CAST(weight AS DOUBLE) FROM w_affiliation
        UNION ALL SELECT 'venue_weights', venue, CAST(weight AS DOUBLE) FROM w_venue
        UNION ALL SELECT 'field_weights', fos_id, CAST(weight AS DOUBLE) FROM w_field""",
    "build_papers": f"SELECT {_WIDE} FROM papers_wide WHERE year = {YEAR}",
    "build_paper_counts": f"""
        SELECT {', '.join('w.' + c for c in _WIDE.split(', '))}, pc.nb_citations
        FROM papers_wide w JOIN pc ON w.paper_id = pc.paper_id""",
    "tsv_roundtrip_papers": f"SELECT {_WIDE} FROM papers_wide",
    "tsv_roundtrip_links": """
        SELECT paper_id, author_id, affiliation_id, '' AS c3, 'a "quoted" text' AS c4, author_seq FROM paper_authors""",
    "venue_weights_mean_c5": f"SELECT venue, {_r('weight', 'weight')} FROM gw_venue_c5",
    "paper_venue_sum_c5": f"""
        SELECT g.paper_id, CAST(g.nb_citations AS DOUBLE) AS nb_citations, {_r('w.weight', 'venue_weight')}
        FROM gc g JOIN papers_wide p ON g.paper_id = p.paper_id JOIN gw_venue_c5 w ON p.c5 = w.venue""",
    "linear_model_all_features": f"""
        SELECT {_r('k0', 'intercept')}, {_r('k1', 'author_weight')}, {_r('k2', 'affiliation_weight')},
               {_r('k3', 'venue_weight')}, {_r('k4', 'field_weight')} FROM lcoef""",
    "mse_by_budget_last": """
        SELECT round(avg((k0 + k1 * author_weight + k2 * affiliation_weight + k3 * venue_weight + k4 * field_weight
                          - nb_citations) ** 2), 3) AS mse, true AS converged
        FROM mf, lcoef WHERE NOT is_train""",
    "linear_model_reloaded": """
        SELECT round(k0, 4) AS intercept, round(k1, 4) AS author_weight, round(k2, 4) AS affiliation_weight,
               round(k3, 4) AS venue_weight, round(k4, 4) AS field_weight FROM ncoef""",
    "linear_model_scored": f"""
        SELECT paper_id, nb_citations, {_r('b0 + b1 * author_weight', 'prediction')} FROM mf, coef WHERE NOT is_train""",
    "text_dump_roundtrip": "SELECT paper_id, nb_citations FROM cc_all",
    "tsv_rejects": f"""
        SELECT CASE r WHEN 0 THEN 'short line' WHEN 1 THEN 'year' ELSE '' END AS reason, r <> 0 AS kept, count(*) AS nb_lines
        FROM (SELECT least(CAST(paper_id AS BIGINT) % {DAMAGE_EVERY}, 2) AS r FROM papers_wide) GROUP BY r""",
    "bucketed_paper_profile": f"""
        SELECT c.paper_id, c.year, c.nb_citations, COALESCE(l.nb, 0) AS nb_links,
               {_r('COALESCE(l.credit, 0.0E0)', 'credit')}, COALESCE(k.nb, 0) AS nb_keywords, k.first_field
        FROM pc_all c
        LEFT JOIN (SELECT paper_id, count(*) AS nb, sum(1.0E0 / author_seq) AS credit FROM paper_authors
                   WHERE author_id <> '' GROUP BY paper_id) l ON c.paper_id = l.paper_id
        LEFT JOIN (SELECT paper_id, count(*) AS nb, min(fos_id) AS first_field FROM paper_keywords
                   GROUP BY paper_id) k ON c.paper_id = k.paper_id""",
    "author_sum_model": f"""
        SELECT {_r('regr_intercept(nb_citations, author_weight)', 'intercept')},
               {_r('regr_slope(nb_citations, author_weight)', 'author_weight')} FROM gx_author WHERE {_TRAIN}""",
    "field_sum_model": f"""
        SELECT {_r('regr_intercept(nb_citations, field_weight)', 'intercept')},
               {_r('regr_slope(nb_citations, field_weight)', 'field_weight')} FROM gx_field WHERE {_TRAIN}""",
}

_FINAL["merged_features_by_parts"] = _FINAL["merged_features"]

ORACLE_SQL: dict[str, str] = {name: _sql(text) for name, text in _FINAL.items()}
