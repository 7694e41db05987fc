"""Records to tables, lakes, their validation, export and streams."""

from __future__ import annotations

import gzip
import http.server
import json
import threading
from collections import Counter
from functools import partial

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakeloom.functions import scalars, taxonomy
from lakeloom.operators import dataflow, lake, tables, validate
from lakeloom.sources import parquet, records
from lakeloom.streaming.append import append_stream
from tests.records import LINEAGES, RECORDS, SCHEMA, TYPES


@pytest.fixture(scope="module")
def lines(tmp_path_factory):
    path = tmp_path_factory.mktemp("in") / "r.jsonl"
    path.write_text("\n".join(map(json.dumps, RECORDS)))
    return str(path)


@pytest.fixture(scope="module")
def root(spark, lines, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("lake") / "a")
    lake.build_lake(records.read_lines(spark, lines, SCHEMA), out)
    return out


def test_classifiers(spark):
    rows = spark.createDataFrame([(i, x) for i, (x, _, _) in enumerate(LINEAGES)], "i int, x array<string>")
    got = rows.select("i", taxonomy.tax_division(F.col("x")).alias("a"), taxonomy.taxon_group(F.col("x")).alias("b"), taxonomy.taxon_group(F.col("x"), F.col("i"), {2: "phage"}).alias("c")).orderBy("i").collect()
    assert [(r["a"], r["b"]) for r in got] == [x[1:] for x in LINEAGES]
    assert [r["c"] for r in got] == ["phage" if i == 2 else x[2] for i, x in enumerate(LINEAGES)]
    kinds = spark.createDataFrame([(t,) for t in TYPES], "t string").select(taxonomy.review_status(F.col("t")).alias("a"), taxonomy.entry_code(F.col("t")).alias("b"), taxonomy.is_reviewed(F.col("t")).alias("c")).collect()
    assert [tuple(r) for r in kinds] == [("reviewed", "sp", True), ("unreviewed", "tr", False), ("unreviewed", None, None), ("unreviewed", "other", False)]


def test_tables(spark, root):
    core, seqs, features = (parquet.read_lake(spark, root, t) for t in ("core", "seqs", "features"))
    assert core.count() == seqs.count() == len(RECORDS)
    assert features.count() == sum(len(r["features"] or []) for r in RECORDS)
    by = {r["acc"]: r for r in core.collect()}
    for i, r in enumerate(RECORDS):
        c = by[r["primaryAccession"]]
        gene = r["genes"][0]["geneName"]["value"] if r["genes"] and r["genes"][0]["geneName"] else None
        assert (c["gene_name"], c["seq_len"], c["tax_division"], c["taxid"]) == (gene, r["sequence"]["length"], LINEAGES[i % len(LINEAGES)][1], i)
        assert c["review_status"] == ("reviewed" if i % 4 == 0 else "unreviewed")
    assert core.columns == ["acc", "id", "taxid", "organism_name", "gene_name", "seq_len", "seq_mass", "seq_md5", "organism", "genes", "comments", "keywords", "review_status", "tax_division"]
    note = core.select("acc", F.try_variant_get(F.get("comments", F.lit(0))["note"], "$.a", "int").alias("a")).where("a is not null").collect()
    assert {r["acc"]: r["a"] for r in note} == {r["primaryAccession"]: i for i, r in enumerate(RECORDS) if i % 2}
    spans = features.where("end_pos is null").count()
    assert spans == sum(k % 4 == 0 for r in RECORDS for k in range(len(r["features"] or [])))
    with pytest.raises(ValueError, match="records lack"):
        tables.core(spark.createDataFrame([(1,)], "x int"))


def test_old_tables(spark, lines):
    r = records.read_lines(spark, lines, SCHEMA)
    assert tables.old_core(r).columns == ["primaryAccession", "entryType", "seqLen", "molWeight"]
    assert Counter(x["entryType"] for x in tables.old_core(r).collect()) == {"sp": 12, "tr": 12, None: 12, "other": 12}
    assert tables.old_sequence(r).where("md5 = 'm3'").first()["sequence"] == "MCAC" * 4


def test_a_lake_is_not_overwritten(spark, lines, root):
    with pytest.raises(Exception, match="already exists"):
        lake.build_lake(records.read_lines(spark, lines, SCHEMA), root)


def test_partitions_and_pruning(spark, root):
    one = parquet.read_partition(spark, f"{root}/core", review_status="reviewed")
    assert one.count() == 12 and one.select("review_status").distinct().count() == 1
    df = parquet.read_lake(spark, root, "core").where("review_status = 'reviewed' and seq_len > 10").select("acc")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(review_status" in plan and "PushedFilters: [IsNotNull(seq_len), GreaterThan(seq_len,10)]" in plan
    views = lake.register_lake(spark, root)
    assert spark.sql("SELECT count(*) FROM core JOIN seqs USING (acc, review_status, tax_division)").first()[0] == len(RECORDS) and set(views) == {"core", "seqs", "features"}


def test_large_partitions_are_spread(spark, tmp_path):
    df = spark.range(4000).selectExpr("id AS acc", "'reviewed' AS review_status", "if(id < 3900, 'bacteria', 'human') AS tax_division")
    lake.write_table(df, str(tmp_path / "t"), rows_per_file=500)
    files = parquet.list_files(spark, str(tmp_path / "t")).collect()
    bacteria = [f for f in files if "bacteria" in f["path"]]
    assert len(bacteria) >= 8 and all(pq.read_metadata(f["path"].removeprefix("file:")).num_rows <= 500 for f in files)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4000


def test_validation(spark, root, tmp_path):
    r = validate.validate(spark, root)
    assert r.ok and r.rows["core"] == len(RECORDS) and "core = seqs: OK" in r.text()
    assert {(s, d): n for s, d, n in r.partitions["core"]} == Counter(("reviewed" if i % 4 == 0 else "unreviewed", LINEAGES[i % len(LINEAGES)][1]) for i in range(len(RECORDS)))
    tight = validate.validate(spark, root, max_mb=0.0001)
    assert not tight.ok and "WARNING" in tight.text()
    lake.write_table(parquet.read_lake(spark, root, "core").limit(5), str(tmp_path / "x/core"))
    lake.write_table(parquet.read_lake(spark, root, "seqs"), str(tmp_path / "x/seqs"))
    bad = validate.validate(spark, str(tmp_path / "x"))
    assert "MISMATCH" in bad.text() and "features: NOT FOUND" in bad.text()
    with pytest.raises(ValueError, match="core and seqs differ"):
        validate.validate(spark, str(tmp_path / "x"), strict=True)


def test_collect_unites_by_name(spark, root, tmp_path):
    more = parquet.read_lake(spark, root, "core").select("acc", "review_status", "tax_division", F.lit(1).alias("new"))
    lake.write_table(more, str(tmp_path / "b/core"))
    assert lake.collect_table(spark, "core", [root, str(tmp_path / "b")], str(tmp_path / "out"))
    got = parquet.read_lake(spark, str(tmp_path / "out"), "core")
    assert got.count() == 2 * len(RECORDS) and got.where("new = 1 and seq_len is null").count() == len(RECORDS)
    assert not lake.collect_table(spark, "core", [str(tmp_path / "none")], str(tmp_path / "out2"))


def test_footers(spark, root):
    files = parquet.list_files(spark, f"{root}/core")
    meta = {r["path"]: r for r in parquet.file_metadata(spark, files).collect()}
    groups = parquet.row_groups(spark, files).collect()
    ratio = parquet.compression(spark, files).first()
    total = [0, 0]
    for f in files.collect():
        m = pq.read_metadata(f["path"].removeprefix("file:"))
        assert (meta[f["path"]]["num_rows"], meta[f["path"]]["num_columns"]) == (m.num_rows, m.num_columns)
        own = [g for g in groups if g["path"] == f["path"]]
        assert len(own) == m.num_row_groups * m.num_columns and {g["compression"] for g in own} == {"ZSTD"}
        total[0] += sum(g["compressed_size"] for g in own)
        total[1] += sum(g["uncompressed_size"] for g in own)
    assert (ratio["compressed"], ratio["uncompressed"], ratio["ratio"]) == (*total, total[1] / total[0])
    assert parquet.compression(spark, parquet.list_files(spark, root + "/nothing")).first()["ratio"] == 0.0
    assert max(r["column_index"] for r in parquet.row_groups(spark, files, 3).collect()) == 2


def test_wrapped_documents(spark, tmp_path):
    flat = [{"a": i, "b": f'x"]}}{{[{i}', "f": 1.5, "é": [i]} for i in range(500)]
    doc = json.dumps({"meta": {"results": [9]}, "n": -1.25e3, "results": flat, "after": [1]}, ensure_ascii=False)
    (tmp_path / "d.json").write_text(doc)
    with gzip.open(tmp_path / "d.json.gz", "wt") as f:
        f.write(doc)
    (tmp_path / "list.json").write_text(json.dumps(flat))
    schema = spark.createDataFrame([(1, "", 1.0)], "a long, b string, f double").schema
    want = [(r["a"], r["b"], r["f"]) for r in flat]
    for name in ("d.json", "d.json.gz"):
        assert [tuple(r) for r in records.read_wrapped(spark, str(tmp_path / name), schema=schema).collect()] == want
        assert [tuple(r) for r in records.stream_array(spark, str(tmp_path / name), schema).collect()] == want
        assert list(records.elements(str(tmp_path / name), chunk=7)) == flat
    assert [tuple(r) for r in records.stream_array(spark, str(tmp_path / "list.json"), schema).collect()] == want
    assert records.read_wrapped(spark, str(tmp_path / "list.json")).count() == 500
    (tmp_path / "cut.json").write_text(doc[:300])
    with pytest.raises(ValueError):
        list(records.elements(str(tmp_path / "cut.json")))


def test_strict_reading(spark, tmp_path):
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\n{"a": "x"}\n')
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        records.read_lines(spark, str(tmp_path / "bad.jsonl"), spark.createDataFrame([(1,)], "a long").schema).collect()
    assert [r["a"] for r in records.read_lines(spark, str(tmp_path / "bad.jsonl"), spark.createDataFrame([(1,)], "a long").schema, strict=False).collect()] == [1, None]
    (tmp_path / "m.yml").write_text("559292: bakersyeast\n9615: dog\n")
    pytest.importorskip("yaml")
    assert records.taxon_map(str(tmp_path / "m.yml")) == {559292: "bakersyeast", 9615: "dog"}


class Ranges(http.server.SimpleHTTPRequestHandler):
    asked: list = []

    def log_message(self, *a):
        pass

    def do_GET(self):
        data = open(self.translate_path(self.path), "rb").read()
        a, z = self.headers["Range"].removeprefix("bytes=").split("-")
        part = data[int(a) : int(z) + 1]
        self.asked.append(len(part))
        self.send_response(206)
        self.send_header("Content-Length", str(len(part)))
        self.end_headers()
        self.wfile.write(part)


def test_files_over_http(spark, tmp_path):
    spark.range(20_000).selectExpr("id", "repeat(md5(string(id)), 20) AS wide").coalesce(1).write.option("parquet.block.row.count.limit", 5000).parquet(str(tmp_path / "t"))
    file = next((tmp_path / "t").glob("*.parquet"))
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), partial(Ranges, directory=str(tmp_path / "t")))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        url = f"http://127.0.0.1:{server.server_port}/{file.name}"
        got = parquet.read_http(spark, url, ["id"])
        assert got.agg(F.sum("id"), F.count(F.lit(1))).first()[:] == (sum(range(20_000)), 20_000)
        assert sum(Ranges.asked) < file.stat().st_size
    finally:
        server.shutdown()


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\tb", None), (2, 'q"x', 1.5)], "i long, s string, x double")
    for kind, sep in (("csv", ","), ("tsv", "\t")):
        lake.export(df, str(tmp_path / kind), kind, single=True)
        assert len(list((tmp_path / kind).glob("*.csv"))) == 1
        assert sorted(map(tuple, spark.read.schema(df.schema).option("header", True).option("sep", sep).csv(str(tmp_path / kind)).collect())) == [(1, "a\tb", None), (2, 'q"x', 1.5)]
    lake.export(df, str(tmp_path / "p"), "parquet")
    lake.concat_tables(spark, [str(tmp_path / "p")] * 2, "parquet", str(tmp_path / "pp"))
    assert spark.read.parquet(str(tmp_path / "pp")).count() == 4
    lake.export(df.drop("x"), str(tmp_path / "q"), "parquet")
    with pytest.raises(ValueError, match="schemas differ"):
        lake.concat_tables(spark, [str(tmp_path / "p"), str(tmp_path / "q")], "parquet", str(tmp_path / "no"))
    with pytest.raises(ValueError):
        lake.export(df, str(tmp_path / "z"), "xml")
    with pytest.raises(FileNotFoundError):
        lake.require(str(tmp_path / "missing"))


def test_stream_appends_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text("\n".join(map(json.dumps, RECORDS[:20])))
    for more, want in ((None, 20), (RECORDS[20:], 48), (None, 48)):
        if more:
            (tmp_path / "in/b.jsonl").write_text("\n".join(map(json.dumps, more)))
        append_stream(spark, str(tmp_path / "in"), SCHEMA, str(tmp_path / "lake"), str(tmp_path / "cp")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "lake/core")).count() == want


def test_overlaps_and_batches(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    iv = [(int(k), int(a), int(a + n)) for k, a, n in zip(rng.integers(0, 3, 80), rng.integers(0, 300, 80), rng.integers(0, 50, 80), strict=True)]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(iv)], "i int, k int, start_pos int, end_pos int")
    want = sorted((i, j) for i, (k, a, z) in enumerate(iv) for j, (m, b, y) in enumerate(iv) if k == m and a <= y and b <= z and i < j)
    for width in (None, 16, 1000):
        got = dataflow.overlaps(df, df, ["k"], width=width, extra=lambda: F.col("a.i") < F.col("b.i")).select("a.i", "b.i").collect()
        assert sorted(map(tuple, got)) == want
    b = dataflow.batches(spark.range(1003).select((F.col("id") * 7).alias("id")), "id", 100)
    assert {r["batch"]: r["n"] for r in b.groupBy("batch").agg(F.count(F.lit(1)).alias("n")).collect()} == {**{i: 100 for i in range(10)}, 10: 3}
    assert dataflow.batches(spark.range(0), "id", 5).count() == 0


def test_scalars(spark):
    df = spark.createDataFrame([("aXbXX", 0, "/x/human.core.tsv"), (None, 4, None)], "s string, n int, p string")
    got = df.select(scalars.letter_count(F.col("s"), "X").alias("a"), scalars.pattern_count(F.col("s"), "[ab]").alias("b"), scalars.ratio(F.lit(8), F.col("n")).alias("c"), scalars.percent(F.lit(1), F.col("n"), 1).alias("d"), scalars.bar(F.col("n"), F.lit(4), 8, "#").alias("e"), scalars.file_parts(F.col("p")).alias("f")).collect()
    assert [tuple(r) for r in got] == [(3, 2, None, None, "", ["human", "core"]), (None, None, 2.0, 25.0, "########", None)]


def test_job_builds_and_adds(spark, tmp_path):
    """Two runs of the job over wrapped documents; the second's records have a column more, which the schema takes in."""
    from lakeloom.operators import job

    docs = [RECORDS[:20], [{**r, "extra": i} for i, r in enumerate(RECORDS[20:])]]
    for k, d in enumerate(docs):
        (tmp_path / f"d {k},x.json").write_text(json.dumps({"results": d}))
    root = str(tmp_path / "lake")
    for k in range(2):
        report = job.run_job(spark, str(tmp_path / f"d {k},x.json"), root, "test", add=k > 0)
        assert report.ok and report.rows["core"] == (20, len(RECORDS))[k]
    core = parquet.read_union(spark, [f"{root}/core"], f"{root}/core")
    assert core.where("extra is not null").count() == len(RECORDS) - 20
    assert {r["acc"] for r in core.collect()} == {r["primaryAccession"] for r in RECORDS}
    assert "extra" in json.loads((tmp_path / "lake/_schema.json").read_text()) and "core = seqs: OK" in (tmp_path / "lake/_report.txt").read_text()
    with pytest.raises(Exception, match="already exists"):
        job.run_job(spark, str(tmp_path / "d 0,x.json"), root, "test")


def test_stream_adds_to_a_built_lake(spark, root, tmp_path):
    import shutil

    shutil.copytree(root, tmp_path / "lake")
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text("\n".join(json.dumps({**r, "primaryAccession": "N" + r["primaryAccession"]}) for r in RECORDS[:9]))
    append_stream(spark, str(tmp_path / "in"), SCHEMA, str(tmp_path / "lake"), str(tmp_path / "cp")).awaitTermination()
    core = parquet.read_lake(spark, str(tmp_path / "lake"), "core")
    assert core.count() == len(RECORDS) + 9 and core.where("acc like 'N%'").count() == 9
    assert validate.validate(spark, str(tmp_path / "lake")).ok


def test_documents_without_the_field_are_errors(tmp_path):
    (tmp_path / "a.json").write_text('{"other": [1]}')
    (tmp_path / "b.json").write_text('{"other": [1], ')
    for name in ("a.json", "b.json"):
        with pytest.raises(ValueError):
            list(records.elements(str(tmp_path / name)))


def test_ranks_of_skewed_values(spark):
    """Most rows share one value, some are null: places are 0 to n - 1, in order; quartiles are exact."""
    import numpy as np

    from lakeloom.plans import analytics

    values = [None] * 3 + [5.0] * 700 + [float(i) for i in range(300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = sorted((r["position"], r["x"]) for r in dataflow.ranked(df, "x").collect())
    assert [p for p, _ in got] == list(range(len(values)))
    assert [x for _, x in got] == sorted(values, key=lambda v: (v is not None, v or 0.0))
    q = analytics.quantiles(df, "x", (0.0, 0.25, 0.77, 1.0)).first()
    assert np.allclose(list(q), np.quantile(values[3:], [0, 0.25, 0.77, 1]))
    assert analytics.describe(df.limit(0), "x").first()["p50"] is None


def test_composition_counts_characters(spark):
    from lakeloom.plans import analytics

    rows = [("a", "AACé"), ("a", None), (None, "CC"), ("b", ""), ("c", "AC" * 3_000_000)]
    got = {r["g"]: (r["pct_A"], r["pct_C"]) for r in analytics.composition(spark.createDataFrame(rows, "g string, sequence string"), "g", "AC").collect()}
    assert got == {"a": (50.0, 25.0), None: (0.0, 100.0), "b": (None, None), "c": (50.0, 50.0)}
