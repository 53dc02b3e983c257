"""The six logical tables as views over the driver's TPC-H-style parquet files.

Mapping (fixed; the DuckDB oracle in ``plans.catalog`` spells the same views
in SQL):

- papers            orders: o_orderkey -> paper_id, year(o_orderdate) -> year,
                    o_orderpriority -> venue_key ('4-NOT SPECIFIED' -> '');
                    ``wide``: o_custkey -> c1, c10; o_orderstatus -> c2; status/priority
                    -> c5; o_orderpriority -> c6; date -> c8; c4 and c9 empty
- paper_references  lineitem: l_orderkey -> citing_id, l_partkey -> cited_id
- paper_authors     lineitem join supplier: l_suppkey -> author_id ('' on line 7),
                    s_nationkey -> affiliation_id ('' when l_returnflag = 'R'),
                    l_linenumber -> author_seq
- paper_keywords    lineitem join part: p_name -> keyword, p_brand -> fos_id
- fields_of_study   distinct p_brand, name 'Field of ' || p_brand
- authors           supplier: s_suppkey -> author_id, s_name -> author_name

Each view selects only the columns it maps, so the parquet scans read just
those (``ReadSchema`` in the plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Fixed values of the fixture mapping.
BLANK_VENUE_PRIORITY = "4-NOT SPECIFIED"
BLANK_AUTHOR_LINENUMBER = 7
BLANK_AFFILIATION_RETURNFLAG = "R"
FIELD_NAME_PREFIX = "Field of "


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _id(c: str):
    return F.col(c).cast("string")


def _papers(t: "FixtureTables") -> DataFrame:
    o = t.read("orders")
    return o.select(
        _id("o_orderkey").alias("paper_id"),
        F.year("o_orderdate").cast("int").alias("year"),
        F.when(F.col("o_orderpriority") == BLANK_VENUE_PRIORITY, F.lit(""))
        .otherwise(F.col("o_orderpriority"))
        .alias("venue_key"),
    )


def _papers_wide(t: "FixtureTables") -> DataFrame:
    """All eleven columns of the dump's papers, in its order."""
    o = t.read("orders")
    return o.select(
        _id("o_orderkey").alias("paper_id"),
        _id("o_custkey").alias("c1"),
        F.col("o_orderstatus").alias("c2"),
        F.year("o_orderdate").cast("int").alias("year"),
        F.lit("").alias("c4"),
        F.concat("o_orderstatus", F.lit("/"), "o_orderpriority").alias("c5"),
        F.col("o_orderpriority").alias("c6"),
        F.when(F.col("o_orderpriority") == BLANK_VENUE_PRIORITY, F.lit(""))
        .otherwise(F.col("o_orderpriority"))
        .alias("venue_key"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("c8"),
        F.lit("").alias("c9"),
        _id("o_custkey").alias("c10"),
    )


def _paper_references(t: "FixtureTables") -> DataFrame:
    li = t.read("lineitem")
    return li.select(_id("l_orderkey").alias("citing_id"), _id("l_partkey").alias("cited_id"))


def _paper_authors(t: "FixtureTables") -> DataFrame:
    li = t.read("lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag"
    )
    su = t.read("supplier").select("s_suppkey", "s_nationkey")
    j = li.join(su, li.l_suppkey == su.s_suppkey, "inner")
    return j.select(
        _id("l_orderkey").alias("paper_id"),
        F.when(F.col("l_linenumber") == BLANK_AUTHOR_LINENUMBER, F.lit(""))
        .otherwise(_id("l_suppkey"))
        .alias("author_id"),
        F.when(F.col("l_returnflag") == BLANK_AFFILIATION_RETURNFLAG, F.lit(""))
        .otherwise(_id("s_nationkey"))
        .alias("affiliation_id"),
        F.col("l_linenumber").alias("author_seq"),
    )


def _paper_keywords(t: "FixtureTables") -> DataFrame:
    li = t.read("lineitem").select("l_orderkey", "l_partkey")
    pa = t.read("part").select("p_partkey", "p_name", "p_brand")
    j = li.join(pa, li.l_partkey == pa.p_partkey, "inner")
    return j.select(
        _id("l_orderkey").alias("paper_id"),
        F.col("p_name").alias("keyword"),
        F.col("p_brand").alias("fos_id"),
    )


def _fields_of_study(t: "FixtureTables") -> DataFrame:
    pa = t.read("part").select("p_brand")
    return pa.distinct().select(
        F.col("p_brand").alias("fos_id"),
        F.concat(F.lit(FIELD_NAME_PREFIX), F.col("p_brand")).alias("fos_name"),
    )


def _authors(t: "FixtureTables") -> DataFrame:
    su = t.read("supplier")
    return su.select(_id("s_suppkey").alias("author_id"), F.col("s_name").alias("author_name"))


class FixtureTables:
    """The six views, each built on first use; every parquet file is read (file
    listing + footer) at most once per instance.  Duck-types ``Tables``."""

    def __init__(self, spark: SparkSession, sf_dir: str, wide: bool = False):
        self._spark = spark
        self._wide = wide
        self._dir = sf_dir
        self._files: dict[str, DataFrame] = {}
        self._views: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._files:
            self._files[name] = _read(self._spark, self._dir, name)
        return self._files[name]

    def _view(self, name: str, build) -> DataFrame:
        if name not in self._views:
            self._views[name] = build(self)
        return self._views[name]

    @property
    def papers(self) -> DataFrame:
        return self._view("papers", _papers_wide if self._wide else _papers)

    @property
    def paper_references(self) -> DataFrame:
        return self._view("paper_references", _paper_references)

    @property
    def paper_authors(self) -> DataFrame:
        return self._view("paper_authors", _paper_authors)

    @property
    def paper_keywords(self) -> DataFrame:
        return self._view("paper_keywords", _paper_keywords)

    @property
    def fields_of_study(self) -> DataFrame:
        return self._view("fields_of_study", _fields_of_study)

    @property
    def authors(self) -> DataFrame:
        return self._view("authors", _authors)


def load_tables(spark: SparkSession, sf_dir: str, wide: bool = False) -> FixtureTables:
    """All six views, lazily; nothing is read until a view is used.  ``wide`` gives
    the papers all columns of the dump."""
    return FixtureTables(spark, sf_dir, wide)
