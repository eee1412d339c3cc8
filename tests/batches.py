"""The small test batches: an initial load and an increment, as raw text rows."""

from __future__ import annotations

import csv

from sparkmart.schema import RAW, RAW_COLUMNS
from sparkmart.sources.staging import stage

BATCH_1 = [
    ("BR0001", "DLR0001", "Aaa-M1", "100", "2", "DT00001", "1", "1", "2019", "North", "One, Two Ltd", "Alpha"),
    ("BR0001", "DLR0002", "Bbb-M2", "300", "3", "DT00002", "2", "1", "2019", "North", "Three", "Beta"),
    ("BR0002", "DLR0001", "Aaa-M1", "50", "0", "DT00002", "2", "1", "2019", "South", "One, Two Ltd", "Alpha"),
    ("BR0001", "DLR0001", "Aaa-M1", "70", "1", "DT00001", "1", "1", "2019", "North", "One, Two Ltd", "Alpha"),
]
BATCH_2 = [
    ("BR0002", "DLR0003", "Bbb-M2", "90", "3", "DT00003", "3", "1", "2019", "South-East", "Four", "Beta"),
    ("BR0000", "DLR0001", "ZZZ9", "40", "4", "DT00400", "4", "2", "2020", "West", "One, Two Ltd", "Gamma"),
    ("BR0001", "DLR0001", "Aaa-M1", "10", "1", "DT00002", "2", "1", "2019", "North", "One, Two Ltd", "Alpha"),
]


_stored = {}


def raw(spark, rows):
    """The rows as a stored table, written once per test session."""
    key = (spark.sparkContext.applicationId, tuple(rows))
    if key not in _stored:
        _stored[key] = stage(spark.createDataFrame(rows, RAW).coalesce(1))
    return _stored[key]


def write_csv(path, rows):
    with open(path, "w", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(RAW_COLUMNS)
        writer.writerows(rows)
    return str(path)


def tuples(df, *columns):
    """Rows as a sorted list of plain tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda t: [(v is not None, v) for v in t])
