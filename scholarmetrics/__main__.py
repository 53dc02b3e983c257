"""Command line: run one job over a dump directory (or the parquet fixtures) and
write its result.

    spark-submit --py-files scholarmetrics.zip scholarmetrics/__main__.py features \\
        --data /corpus/data --year 2012 --out /results/features

Jobs: ``citation-counts``, ``papers-with-counts``, ``histogram``,
``extract-features`` (the year build's eight intermediate tables, one
subdirectory each), ``features`` (X9), ``gap-features`` (X10), ``fit``
(M4/M5, optional M7).
Output is gzip TSV (``key<TAB>values``) by default or Parquet with
``--format parquet``; an existing output path is an error.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from scholarmetrics.operators import counts as A
from scholarmetrics.operators import features as X
from scholarmetrics.operators import model as M
from scholarmetrics.plans.sizing import size_shuffles
from scholarmetrics.plans.workflows import GapFeatures, YearFeatures
from scholarmetrics.sources import load_dump, load_tables, write_table, write_tsv
from scholarmetrics.sources.tables import materialize


def _tables(spark: SparkSession, args):
    if args.fixture:
        return load_tables(spark, args.fixture)
    return load_dump(spark, args.data, mode=args.mode, files=dict(f.split("=", 1) for f in args.file))


def _gap(t, args, **kw) -> GapFeatures:
    """The raw venue is source column 5 of a dump; the fixture has only the key."""
    return GapFeatures(t, gap=args.gap, cap=args.cap, venue_col="venue_key" if args.fixture else "c5", **kw)


def _write(df: DataFrame, args) -> None:
    if args.format == "parquet":
        write_table(df, args.out)
    else:
        write_tsv(df, args.out)


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="scholarmetrics")
    p.add_argument(
        "job",
        choices=[
            "citation-counts", "papers-with-counts", "histogram", "extract-features",
            "features", "gap-features", "fit",
        ],
    )
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--data", help="dump directory (Papers.tsv*, PaperReferences.tsv*, ...)")
    src.add_argument("--fixture", help="directory of the driver parquet tables")
    p.add_argument("--mode", default="failfast", choices=["failfast", "permissive"])
    p.add_argument("--file", action="append", default=[], metavar="TABLE=NAME", help="input of a table that --data holds more than once")
    p.add_argument("--table", default="features", choices=["features", "author-sum", "field-sum"], help="fit: the year's features or a table of the gap variant")
    p.add_argument("--out", help="output path (must not exist)")
    p.add_argument("--format", default="tsv", choices=["tsv", "parquet"])
    p.add_argument("--year", type=int)
    p.add_argument("--gap", type=int, default=3)
    p.add_argument("--cap", type=int)
    p.add_argument("--lo", type=int, default=0)
    p.add_argument("--hi", type=int, default=200000)
    p.add_argument("--width", type=int, default=100)
    p.add_argument("--normalize", action="store_true")
    p.add_argument("--model-out")
    p.add_argument("--all", action="store_true", help="gap-features: write every intermediate table")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = build_parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"scholarmetrics-{args.job}").getOrCreate()
    t = _tables(spark, args)
    # shuffle partitions from the largest input, unless set at launch
    size_shuffles(spark, [t.paper_references, t.paper_authors, t.paper_keywords, t.papers])
    if args.year is None and (
        args.job in ("papers-with-counts", "extract-features", "features") or (args.job == "fit" and args.table == "features")
    ):
        raise SystemExit("--year is required for this job")
    if args.job == "citation-counts":
        _write(A.citation_counts(t.paper_references), args)
    elif args.job == "papers-with-counts":
        _write(YearFeatures(t, args.year).counts, args)
    elif args.job == "histogram":
        cc = A.citation_counts(t.paper_references)
        _write(A.count_histogram(cc, "nb_citations", args.lo, args.hi, args.width), args)
    elif args.job == "extract-features":
        # the counts feed five of the eight tables: checkpoint them once when a
        # shared checkpoint folder is configured
        build = YearFeatures(t, args.year, materialize_counts=True)
        base = args.out.rstrip("/")
        for name, df in build.outputs().items():
            args_one = argparse.Namespace(**{**vars(args), "out": f"{base}/{name}"})
            _write(df, args_one)
    elif args.job == "features":
        _write(YearFeatures(t, args.year, materialize_counts=True).merged, args)
    elif args.job == "gap-features":
        if args.all:
            build = _gap(t, args, materialize_counts=True)
            base = args.out.rstrip("/")
            for name, df in build.outputs().items():
                _write(df, argparse.Namespace(**{**vars(args), "out": f"{base}/{name}"}))
        else:
            _write(_gap(t, args, materialize_counts=True).combined, args)
    elif args.job == "fit":
        if args.table == "features":
            feats, table = list(X.FEATURE_COLUMNS), YearFeatures(t, args.year, materialize_counts=True).merged
        elif args.table == "author-sum":
            feats, table = ["author_weight"], _gap(t, args).author_sum
        else:
            feats, table = ["field_weight"], _gap(t, args).field_sum
        # training and test rows come from one evaluation of the table
        frame = materialize(M.prepare(table, "nb_citations", feats, fill=0.0))
        if args.normalize:
            frame = M.normalize(frame, feats)
        train, test = M.split_train_test(frame)
        model = M.fit_linear(train, "nb_citations", feats)
        mse = M.score_mse(model, test, "nb_citations", feats).first()
        if args.model_out:
            M.save_model(model, args.model_out)
        print(json.dumps({
            "intercept": model.intercept,
            "coefficients": dict(zip(feats, model.coefficients.toArray().tolist())),
            "test_mse": mse.mse,
            "test_rows": mse.n,
        }))
    return 0


if __name__ == "__main__":
    sys.exit(main())
