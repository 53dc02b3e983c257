"""The golden mini corpus (five papers), worked out by hand."""

from scholarmetrics.schemas import Tables

PAPERS = [
    ("P1", 2012, "ICML"),
    ("P2", 2012, "icml"),
    ("P3", 2012, ""),
    ("P4", 2015, "KDD"),
    ("P5", 2012, "KDD"),
]
REFERENCES = [("P4", "P1"), ("P4", "P2"), ("P4", "P3"), ("P2", "P1"), ("P3", "P1")]
PAPER_AUTHORS = [
    ("P1", "A1", "F1", 1),
    ("P1", "A2", "F1", 2),
    ("P2", "A1", "F1", 1),
    ("P3", "A2", "", 1),
    ("P3", "", "F2", 2),
    ("P4", "A3", "F2", 1),
    ("P5", "A4", "F2", 1),
]
PAPER_KEYWORDS = [
    ("P1", "k1", "X"),
    ("P1", "k2", "X"),
    ("P2", "k1", "Y"),
    ("P5", "k3", "Y"),
    ("P4", "k1", "Z"),
]
FIELDS = [("X", "Field X"), ("Y", "Field Y"), ("Z", "Other")]
AUTHORS = [("A1", "Ada"), ("A2", "Bo"), ("A3", "Cy"), ("A4", "Di")]


def golden_tables(spark) -> Tables:
    return Tables(
        papers=spark.createDataFrame(PAPERS, "paper_id string, year int, venue_key string"),
        paper_references=spark.createDataFrame(REFERENCES, "citing_id string, cited_id string"),
        paper_authors=spark.createDataFrame(
            PAPER_AUTHORS, "paper_id string, author_id string, affiliation_id string, author_seq int"
        ),
        paper_keywords=spark.createDataFrame(PAPER_KEYWORDS, "paper_id string, keyword string, fos_id string"),
        fields_of_study=spark.createDataFrame(FIELDS, "fos_id string, fos_name string"),
        authors=spark.createDataFrame(AUTHORS, "author_id string, author_name string"),
    )
