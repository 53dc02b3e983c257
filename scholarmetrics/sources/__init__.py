"""Sources and sinks: TSV dump reader (S1), TSV/text writers (S2, S4), Parquet
intermediates (S3) and the fixture views over the driver tables."""

from scholarmetrics.sources.dump import load_dump
from scholarmetrics.sources.fixtures import load_tables
from scholarmetrics.sources.sinks import write_text_dump, write_tsv
from scholarmetrics.sources.tables import materialize, read_bucketed, read_table, write_bucketed, write_table
from scholarmetrics.sources.tsv import observe_rejects, parse_tagged, read_tsv, read_tsv_with_rejects

__all__ = [
    "load_dump",
    "load_tables",
    "materialize",
    "observe_rejects",
    "parse_tagged",
    "read_bucketed",
    "read_table",
    "read_tsv",
    "read_tsv_with_rejects",
    "write_bucketed",
    "write_table",
    "write_text_dump",
    "write_tsv",
]
