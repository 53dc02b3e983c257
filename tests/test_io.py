"""S1-S4 on files in a per-test temporary folder."""

import bz2
import gzip
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmetrics.schemas import PAPER_AUTHORS, PAPER_REFERENCES, PAPERS
from scholarmetrics.sources import (
    read_table,
    read_tsv,
    read_tsv_with_rejects,
    write_table,
    write_text_dump,
    write_tsv,
)

PAPER_LINES = [
    "P1\ta\tb\t2012\tc4\tc5\tc6\tICML\tc8\tc9\t",  # trailing empty field
    'P2\t"quoted\tb\t2012\tc4\tc5\tc6\ticml\tc8\tc9\tc10',  # a lone quote is data
    "P3\ta\tb\t\tc4\tc5\tc6\tV\tc8\tc9\tc10",  # blank year
    "P4\ta\tb",  # short line
    "P5\ta\tb\t20x2\tc4\tc5\tc6\tV\tc8\tc9\tc10",  # a year that does not parse
]


def _write(path, lines, opener=open):
    with opener(path, "wt") as f:
        f.write("\n".join(lines) + ("\n" if lines else ""))


@pytest.fixture
def dump(tmp_path):
    d = tmp_path / "papers"
    d.mkdir()
    _write(d / "part-0", PAPER_LINES[:2])
    _write(d / "part-1.bz2", PAPER_LINES[2:3], bz2.open)
    _write(d / "part-2.gz", PAPER_LINES[3:], gzip.open)
    _write(d / "part-3", [])  # empty file
    return str(d)


def test_permissive_reads_exact_fields(spark, dump):
    good, bad = read_tsv_with_rejects(spark, dump, PAPERS)
    rows = {r.paper_id: r for r in good.collect()}
    rejects = {r.line.split("\t")[0]: (r.reason, r.kept) for r in bad.collect()}
    # only the short line is dropped; a blank or unparsable year is NULL, its row stays
    assert rejects == {"P4": ("short line", False), "P5": ("year", True)}
    assert set(rows) == {"P1", "P2", "P3", "P5"}
    assert rows["P3"].year is None and rows["P5"].year is None
    assert rows["P1"].c10 == ""  # kept, not NULL
    assert rows["P2"].c1 == '"quoted' and rows["P2"].c2 == "b"
    assert rows["P1"].year == 2012 and rows["P1"].venue_key == "ICML"
    assert read_tsv(spark, dump, PAPERS, mode="permissive").count() == len(rows)


def test_failfast_raises(spark, dump):
    with pytest.raises(Exception, match="malformed TSV line"):
        read_tsv(spark, dump, PAPERS, mode="failfast").collect()


def test_author_position_blank_and_zero(spark, tmp_path):
    p = tmp_path / "paa.tsv"
    _write(p, ["X1\tA\tF\tc3\tc4\t1", "X2\tA\tF\tc3\tc4\t", "X3\tA\tF\tc3\tc4\t0"])
    good, bad = read_tsv_with_rejects(spark, str(p), PAPER_AUTHORS)
    # the blank position is NULL and stays; a blank is no unparsable value
    assert sorted((r.paper_id, r.author_seq) for r in good.collect()) == [("X1", 1), ("X2", None), ("X3", 0)]
    assert bad.count() == 0
    # a link without a position still counts for the affiliation
    from scholarmetrics.operators.weights import affiliation_weights

    pc = spark.createDataFrame([("X1", 5), ("X2", 7)], "paper_id string, nb_citations bigint")
    strict = read_tsv(spark, str(p), PAPER_AUTHORS, mode="failfast")
    assert [(r.affiliation_id, r.weight) for r in affiliation_weights(pc, strict).collect()] == [("F", 12)]
    # position 0 raises where the credit 1/seq is taken (ANSI division by zero)
    from scholarmetrics.functions.expressions import position_credit

    with pytest.raises(Exception):
        good.select(position_credit("author_seq")).collect()


def test_write_tsv_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 1), ("b", "x", None)], "k string, v string, n int")
    out = str(tmp_path / "out")
    write_tsv(df, out)
    assert any(f.endswith(".gz") for f in os.listdir(out))
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert lines == ["a\t\t1", "b\tx\t"]  # NULLs keep their position
    with pytest.raises(Exception):
        write_tsv(df, out)  # refuses an existing path
    three = T.StructType(list(PAPER_REFERENCES.fields) + [T.StructField("n", T.StringType())])
    back = read_tsv(spark, out, three)
    assert back.count() == 2


def test_text_dump_and_table(spark, tmp_path):
    df = spark.createDataFrame([("p", 3)], "paper_id string, nb_citations bigint")
    dump = str(tmp_path / "dump")
    write_text_dump(df, dump)
    assert not any(f.endswith(".gz") for f in os.listdir(dump))
    assert [r.value for r in spark.read.text(dump).collect()] == ["p\t3"]
    tbl = str(tmp_path / "tbl")
    write_table(df, tbl)
    assert read_table(spark, tbl).filter(F.col("nb_citations") == 3).count() == 1


def test_load_dump_runs_the_year_pipeline(spark, tmp_path):
    """The golden corpus written as a TSV dump (bz2 and plain files, extra
    unused columns) gives the same X9 rows as the in-memory tables."""
    from golden import AUTHORS, FIELDS, PAPER_AUTHORS, PAPER_KEYWORDS, PAPERS, REFERENCES
    from scholarmetrics.plans.workflows import YearFeatures
    from scholarmetrics.sources import load_dump

    d = tmp_path / "dump"
    d.mkdir()
    _write(d / "Papers.tsv.bz2", [f"{p}\tc1\tc2\t{y}\tc4\tc5\tc6\t{v}\tc8\tc9\tc10" for p, y, v in PAPERS], bz2.open)
    _write(d / "PaperReferences.tsv", [f"{a}\t{b}" for a, b in REFERENCES])
    _write(d / "PaperAuthorAffiliations.tsv.bz2", [f"{p}\t{a}\t{f}\tc3\tc4\t{s}" for p, a, f, s in PAPER_AUTHORS], bz2.open)
    _write(d / "PaperKeywords.tsv.bz2", [f"{p}\t{k}\t{f}" for p, k, f in PAPER_KEYWORDS], bz2.open)
    _write(d / "FieldsOfStudy.tsv.bz2", [f"{a}\t{b}" for a, b in FIELDS], bz2.open)
    _write(d / "Authors.tsv.bz2", [f"{a}\t{b}" for a, b in AUTHORS], bz2.open)
    t = load_dump(spark, str(d))
    assert t.papers.count() == 5 and t.paper_references.count() == 5
    rows = {r["paper_id"]: tuple(r)[1:] for r in YearFeatures(t, 2012).merged.collect()}
    assert rows == {
        "P1": (6.0, 4.0, 7.0, 3.25, 3.0),
        "P2": (1.0, 4.0, 7.0, 4.0, 1.0),
        "P3": (None, 0.0, 1.0, 2.5, 1.0),
    }


def test_cli_jobs_on_fixture(spark, tmp_path, capsys):
    from scholarmetrics.__main__ import main

    out = str(tmp_path / "counts")
    assert main(["citation-counts", "--fixture", "/root/testdata/sf0.001", "--out", out], spark=spark) == 0
    lines = spark.read.text(out).collect()
    assert len(lines) > 0 and all(len(r.value.split("\t")) == 2 for r in lines)
    out = str(tmp_path / "features")
    assert main(["features", "--fixture", "/root/testdata/sf0.001", "--year", "1997",
                 "--format", "parquet", "--out", out], spark=spark) == 0
    assert spark.read.parquet(out).columns[0] == "paper_id"
    assert main(["fit", "--fixture", "/root/testdata/sf0.01", "--year", "1997"], spark=spark) == 0
    assert '"test_mse"' in capsys.readouterr().out


def test_cli_remaining_jobs(spark, tmp_path):
    from scholarmetrics.__main__ import main

    fx = "/root/testdata/sf0.001"
    out = str(tmp_path / "gap")
    assert main(["gap-features", "--fixture", fx, "--gap", "3", "--cap", "40", "--format", "parquet",
                 "--out", out], spark=spark) == 0
    assert spark.read.parquet(out).columns == [
        "paper_id", "nb_citations", "author_weight", "affiliation_weight", "field_weight", "venue_weight"]
    out = str(tmp_path / "hist")
    assert main(["histogram", "--fixture", fx, "--lo", "0", "--hi", "100", "--width", "10", "--out", out],
                spark=spark) == 0
    rows = [r.value.split("\t") for r in spark.read.text(out).collect()]
    assert len(rows) == 9 and sum(int(r[3]) for r in rows) > 0
    out = str(tmp_path / "pwc")
    assert main(["papers-with-counts", "--fixture", fx, "--year", "1997", "--out", out], spark=spark) == 0
    assert spark.read.text(out).count() == load_year_papers(spark, fx)
    with pytest.raises(SystemExit):
        main(["features", "--fixture", fx], spark=spark)  # --year missing


def load_year_papers(spark, fx):
    from scholarmetrics.sources import load_tables

    return load_tables(spark, fx).papers.filter("year = 1997").count()


def test_cli_extract_features_writes_all_intermediates(spark, tmp_path):
    from scholarmetrics.__main__ import main

    out = str(tmp_path / "extract")
    assert main(["extract-features", "--fixture", "/root/testdata/sf0.001", "--year", "1997",
                 "--format", "parquet", "--out", out], spark=spark) == 0
    names = sorted(os.listdir(out))
    assert names == sorted([
        "papers", "citations", "authorships", "paper_counts",
        "author_weights", "affiliation_weights", "venue_weights", "field_weights",
    ])
    counts = spark.read.parquet(f"{out}/paper_counts")
    assert counts.columns == ["paper_id", "year", "venue_key", "nb_citations"]
    assert counts.count() == spark.read.parquet(f"{out}/papers").count()


def test_cli_gap_features_all(spark, tmp_path):
    from scholarmetrics.__main__ import main

    out = str(tmp_path / "gap_all")
    assert main(["gap-features", "--fixture", "/root/testdata/sf0.001", "--gap", "3", "--all",
                 "--format", "parquet", "--out", out], spark=spark) == 0
    assert len(os.listdir(out)) == 12
    gc = spark.read.parquet(f"{out}/gap_counts")
    edges = spark.read.parquet(f"{out}/gap_edges")
    # the gap counts are the per-cited-paper counts of the gap edges
    assert gc.agg(F.sum("nb_citations")).first()[0] == edges.count()


def test_a_table_that_lies_there_twice_is_not_read_twice(spark, tmp_path):
    from scholarmetrics.sources.dump import DUMP_FILES, load_dump, load_dump_with_rejects

    for name in DUMP_FILES.values():
        _write(tmp_path / name, [])
    lines = ["A\tB", "C\tB", "D\tA", "short"]
    _write(tmp_path / "PaperReferences.tsv", lines)
    _write(tmp_path / "PaperReferences.tsv.bz2", lines, bz2.open)
    _write(tmp_path / "PaperReferences.tsv.md5", ["not a table"])
    with pytest.raises(ValueError, match="several inputs.*PaperReferences.tsv.bz2"):
        load_dump(spark, str(tmp_path))
    files = {"paper_references": "PaperReferences.tsv.bz2"}
    tables, rejects = load_dump_with_rejects(spark, str(tmp_path), files)
    counts = tables.paper_references.groupBy("cited_id").count().collect()
    assert {r.cited_id: r["count"] for r in counts} == {"B": 2, "A": 1}
    assert [(r.line, r.reason, r.kept) for r in rejects["paper_references"].collect()] == [("short", "short line", False)]
    assert load_dump(spark, str(tmp_path), mode="permissive", files=files).paper_references.count() == 3
    with pytest.raises(ValueError, match="no input for table papers"):
        load_dump(spark, str(tmp_path / "nowhere"))


def test_materialize_without_a_folder_warns(spark, monkeypatch):
    from scholarmetrics.sources import tables

    monkeypatch.setattr(tables, "checkpoint_dir", lambda s: None)
    with pytest.warns(UserWarning, match="spark.checkpoint.dir"):
        assert tables.materialize(spark.range(3)).count() == 3
