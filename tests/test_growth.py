"""Records that differ from run to run, and work that is cut in more tasks where tables are larger."""

from __future__ import annotations

import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from lakeloom.plans import adapters, analytics, catalogue
from lakeloom.plans.adapters import Tables
from tests.conftest import SF


@pytest.fixture
def unsteady(monkeypatch):
    """Records are never twice the same string, as where their features come in another order."""
    pad = F.udf(lambda x: x + " " * random.SystemRandom().randrange(64), "string").asNondeterministic()
    plain = F.to_json
    monkeypatch.setattr(adapters.F, "to_json", lambda c: pad(plain(c)))


def test_append_takes_each_record_once_whatever_its_text(spark, unsteady):
    """F3"""
    got = catalogue.queries()["df07_append"](spark, SF).agg(F.sum("n")).first()[0]
    assert got == spark.read.parquet(f"{SF}/orders.parquet").count()


@pytest.fixture
def many_parts(monkeypatch):
    """Tables count as large: the parts that lineitem is cut in."""
    monkeypatch.setattr(adapters, "PART_BYTES", 4096, raising=False)
    n = os.path.getsize(f"{SF}/lineitem.parquet") // 4096
    assert n > 16
    return n


def test_features_are_cut_by_the_size_of_the_table(spark, many_parts):
    """a scan's task counted all its rows in one hash map, the larger the file the more."""
    assert Tables(spark, SF).features.rdd.getNumPartitions() >= many_parts


def test_co_occurrence_counts_an_entry_once_and_none_without_key(spark):
    """F4"""
    rows = [(a, s, "x", t) for a, s in ((1, "r"), (1, "u"), (2, "r"), (None, "r"), (3, None)) for t in ("A", "B", "B")]
    got = analytics.co_occurrence(spark.createDataFrame(rows, "acc long, review_status string, tax_division string, type string"), least=1)
    assert [tuple(r) for r in got.collect()] == [("A", "B", 2, 6)]


@pytest.mark.parametrize("name", ["q6i_exact_coverage", "q6i_coverage"])
def test_coverage_is_cut_by_the_size_of_the_table(spark, many_parts, name):
    """features meet core in the parts in which they were summed up."""
    assert catalogue.queries()[name](spark, SF).rdd.getNumPartitions() >= many_parts


def test_no_row_of_the_job_holds_a_document(spark, monkeypatch):
    """documents are written line by line, of any size."""
    seen = []

    def stop(spark, paths, *args, **kw):
        seen.extend(paths)
        raise StopIteration

    monkeypatch.setattr(catalogue.job, "run_job", stop)
    with pytest.raises(StopIteration):
        catalogue.queries()["df00_job"](spark, SF)
    folder = os.path.dirname(seen[0].removeprefix("file:"))
    files = [p for p in glob.glob(f"{folder}/**/*.txt", recursive=True)]
    assert len(files) >= 4
    assert max(len(line) for p in files for line in open(p)) < 10_000
    found = [r["primaryAccession"] for p in files for r in json.load(open(p))["results"]]
    assert len(found) == len(set(found)) == spark.read.parquet(f"{SF}/orders.parquet").count()


def test_records_are_written_in_parts_by_the_size_of_the_table(spark, many_parts):
    """a gzip file is read by one task."""
    assert spark.read.text(catalogue._record_files(Tables(spark, SF))).select(F.input_file_name()).distinct().count() >= many_parts
