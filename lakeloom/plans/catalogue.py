"""All registered queries and their SQL. Each runs over its whole tables; limits stand only where they are the feature.

Queries with a sink write to the shared folder and return what is read back, so that source and sink are held against
the SQL together. Queries without SQL read footers or plans; tests hold them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakeloom.functions import scalars, taxonomy
from lakeloom.operators import dataflow, job, lake, schema, tables, validate
from lakeloom.operators.shared import QUICK_GZIP, scratch
from lakeloom.operators.tables import KEYS, TRIPLE
from lakeloom.plans import analytics
from lakeloom.plans.adapters import CORE, FEATURES, LINEAGES, RECORDS, SEQS, TEXTS, Tables, with_
from lakeloom.sources import parquet, records, server
from lakeloom.streaming.append import append_stream

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}
OVERRIDES = {3: "bakersyeast", 7: "dog"}
CORE_COLUMNS = "acc, id, organism_name, gene_name, seq_len, seq_mass, review_status, tax_division"


def query(name: str, sql: str | None = None):
    def add(f: Callable[[Tables], DataFrame]):
        _QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            _SQL[name] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# ---- the analytical queries


@query("q1b_partition_rows", with_(CORE) + "SELECT review_status, tax_division, count(*) AS n FROM core GROUP BY ALL ORDER BY review_status, n DESC, tax_division")
def _q1b(t: Tables) -> DataFrame:
    return analytics.partition_rows(t.core)


@query("q1c_longest_reviewed", with_(CORE) + "SELECT acc, id, organism_name, gene_name, seq_len FROM core WHERE review_status = 'reviewed' AND tax_division = 'asia' ORDER BY seq_len DESC NULLS LAST, acc LIMIT 10")
def _q1c(t: Tables) -> DataFrame:
    return analytics.longest(t.core)


@query(
    "q1d_star_join",
    with_(CORE, FEATURES, SEQS)
    + """SELECT c.acc, c.gene_name, c.seq_len, length(any_value(s.sequence)) AS seq_chars, count(f.type) AS n_features,
  coalesce(array_to_string(list_sort(list_distinct(list(f.type))), ','), '') AS feature_types
FROM core c JOIN seqs s USING (acc, review_status, tax_division) LEFT JOIN features f USING (acc, review_status, tax_division)
WHERE review_status = 'reviewed' AND tax_division = 'asia' GROUP BY c.acc, c.gene_name, c.seq_len ORDER BY n_features DESC, acc""",
)
def _q1d(t: Tables) -> DataFrame:
    return analytics.star(t.core, t.seqs, t.features)


@query("q2a_longest_unreviewed", with_(CORE) + "SELECT acc, id, organism_name, gene_name, seq_len FROM core WHERE review_status = 'unreviewed' AND tax_division = 'europe' ORDER BY seq_len DESC NULLS LAST, acc LIMIT 10")
def _q2a(t: Tables) -> DataFrame:
    return analytics.longest(t.core, "unreviewed", "europe")


@query("q2b_type_distribution", with_(CORE, FEATURES) + "SELECT type, count(*) AS count FROM features WHERE review_status = 'reviewed' GROUP BY type ORDER BY count DESC, type")
def _q2b(t: Tables) -> DataFrame:
    return analytics.type_distribution(t.features)


@query("q2c_explain")
def _q2c(t: Tables) -> DataFrame:
    """The physical plan of a filtered scan as rows: what is pushed to the files shows in it (T-11)."""
    t.lineitem.createOrReplaceTempView("lakeloom_plan_input")
    return t.spark.sql("EXPLAIN FORMATTED SELECT l_orderkey, l_quantity FROM lakeloom_plan_input WHERE l_returnflag = 'R' AND l_quantity > 30")


@query("q3a_describe", with_(CORE) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM core"
    for c in ("seq_len", "seq_mass")
))
def _q3a(t: Tables) -> DataFrame:
    return analytics.describe(t.core, "seq_len", "seq_mass").withColumns({c: F.round(c, 4) for c in ("mean", "std")})


@query("q3b_top_organisms", with_(CORE) + "SELECT organism_name, count(acc) AS n FROM core WHERE review_status = 'reviewed' AND organism_name IS NOT NULL GROUP BY 1 ORDER BY n DESC, organism_name LIMIT 10")
def _q3b(t: Tables) -> DataFrame:
    return analytics.top_organisms(t.core)


@query("q5c_totals", with_(CORE) + "SELECT count(*) AS n, round(avg(seq_len)) AS avg_len, min(seq_len) AS min_len, max(seq_len) AS max_len FROM core")
def _q5c(t: Tables) -> DataFrame:
    return t.core.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("seq_len")).alias("avg_len"), F.min("seq_len").alias("min_len"), F.max("seq_len").alias("max_len"))


@query("q6a_partition_profile", with_(CORE) + "SELECT tax_division, review_status, count(*) AS n_proteins, round(avg(seq_len)) AS avg_seq_len, min(seq_len) AS min_seq_len, max(seq_len) AS max_seq_len, round(avg(seq_mass)) AS avg_mass_da FROM core GROUP BY ALL ORDER BY n_proteins DESC, tax_division, review_status")
def _q6a(t: Tables) -> DataFrame:
    return analytics.profile(t.core)


@query("q6b_feature_density", with_(CORE, FEATURES) + """SELECT acc, gene_name, organism_name, seq_len, count(type) AS n_features, round(CASE WHEN seq_len <> 0 THEN CAST(count(type) AS DOUBLE) / seq_len END, 3) AS features_per_residue
FROM core JOIN features USING (acc, review_status, tax_division) GROUP BY acc, gene_name, organism_name, seq_len HAVING count(type) >= 5 ORDER BY features_per_residue DESC NULLS LAST, acc LIMIT 15""")  # fmt: skip
def _q6b(t: Tables) -> DataFrame:
    return analytics.density(t.core, t.features)


@query("q6c_letter_content", with_(TEXTS) + "SELECT acc, length(sequence) - length(replace(sequence, 'e', '')) AS n_letter, round(CAST(length(sequence) - length(replace(sequence, 'e', '')) AS DOUBLE) * 100.0::DOUBLE / length(sequence), 2) AS pct_letter FROM texts WHERE length(sequence) > 50")
def _q6c(t: Tables) -> DataFrame:
    """The reference's letter content without its limit, over whole texts."""
    return analytics.letter_content(t.texts, "e", n=None)


@query("q6c_letter_content_top", with_(CORE, SEQS) + "SELECT acc, gene_name, organism_name, seq_len, length(sequence) - length(replace(sequence, 'C', '')) AS n_letter, round(CAST(length(sequence) - length(replace(sequence, 'C', '')) AS DOUBLE) * 100.0::DOUBLE / length(sequence), 2) AS pct_letter FROM seqs JOIN core USING (acc, review_status, tax_division) WHERE length(sequence) > 50 ORDER BY pct_letter DESC NULLS LAST, acc LIMIT 15")
def _q6c_top(t: Tables) -> DataFrame:
    return analytics.letter_content_of(t.core, t.seqs)


@query("q6d_co_occurrence", with_(CORE, FEATURES) + """SELECT a.type AS type_a, b.type AS type_b, count(DISTINCT a.acc) AS n_proteins, count(*) AS n_co_occurrences
FROM features a JOIN features b USING (acc, review_status, tax_division) WHERE a.type < b.type GROUP BY 1, 2 HAVING count(DISTINCT a.acc) >= 2 ORDER BY n_proteins DESC, n_co_occurrences DESC, type_a, type_b LIMIT 15""")  # fmt: skip
def _q6d(t: Tables) -> DataFrame:
    return analytics.co_occurrence(t.features)


_OVERLAP = """SELECT a.acc, a.type AS feature_a, a.start_pos AS a_start, a.end_pos AS a_end, b.type AS feature_b, b.start_pos AS b_start, b.end_pos AS b_end,
  least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos) + 1 AS overlap_len
FROM features a JOIN features b USING (acc, review_status, tax_division) WHERE a.start_pos <= b.end_pos AND b.start_pos <= a.end_pos AND a.type < b.type"""


@query("q6e_overlaps", with_(CORE, FEATURES) + _OVERLAP)
def _q6e(t: Tables) -> DataFrame:
    return analytics.overlapping(t.features)


@query("q6e_overlaps_binned", with_(CORE, FEATURES) + _OVERLAP)
def _q6e_binned(t: Tables) -> DataFrame:
    """The same pairs through bins of positions, for keys that hold very many intervals."""
    return analytics.overlapping(t.features, width=64)


@query("q6f_histogram", with_(CORE) + "SELECT CAST(floor(seq_len / 100) * 100 AS BIGINT) AS len_bucket, count(*) AS n_proteins FROM core GROUP BY 1 ORDER BY 1")
def _q6f(t: Tables) -> DataFrame:
    return analytics.histogram(t.core)


@query("q6f_histogram_bars", with_(CORE, "h AS (SELECT CAST(floor(seq_len / 100) * 100 AS BIGINT) AS len_bucket, count(*) AS n_proteins FROM core GROUP BY 1)") + "SELECT len_bucket, n_proteins, repeat('#', CAST(floor(n_proteins / max(n_proteins) OVER () * 40) AS INT)) AS bar FROM h ORDER BY 1")
def _q6f_bars(t: Tables) -> DataFrame:
    return analytics.histogram_bars(t.core, mark="#")


@query("q6g_top_per_organism", with_(CORE, "r AS (SELECT acc, gene_name, organism_name, seq_len, tax_division, row_number() OVER (PARTITION BY organism_name ORDER BY seq_len DESC NULLS LAST, acc) AS rank_in_organism FROM core WHERE organism_name IS NOT NULL)") + "SELECT * FROM r WHERE rank_in_organism <= 3 ORDER BY organism_name, rank_in_organism")
def _q6g(t: Tables) -> DataFrame:
    return analytics.top_per_organism(t.core)


@query("q6h_composition", with_(TEXTS, "n AS (SELECT review_status, " + ", ".join(f"sum(length(sequence) - length(replace(sequence, '{c}', ''))) AS n_{c}" for c in scalars.RESIDUES) + ", sum(length(sequence)) AS total FROM texts GROUP BY 1)") + "SELECT review_status, " + ", ".join(f"round(CAST(n_{c} AS DOUBLE) * 100.0::DOUBLE / CAST(total AS DOUBLE), 2) AS pct_{c}" for c in scalars.RESIDUES) + " FROM n")
def _q6h(t: Tables) -> DataFrame:
    return analytics.composition(t.texts)


_COVER = """spans AS (SELECT acc, sum(CASE WHEN start_pos IS NOT NULL AND end_pos IS NOT NULL THEN end_pos - start_pos + 1 ELSE 0 END)::BIGINT AS total_feature_span, count(*) AS n_features FROM features GROUP BY acc)"""


@query("q6i_coverage", with_(CORE, FEATURES, _COVER) + "SELECT acc, gene_name, organism_name, seq_len, n_features, total_feature_span, round(CAST(total_feature_span AS DOUBLE) * 100.0::DOUBLE / seq_len, 1) AS pct_coverage FROM core JOIN spans USING (acc) WHERE seq_len > 0")
def _q6i(t: Tables) -> DataFrame:
    return analytics.coverage(t.core_by_acc, t.features, n=None)


@query("q6i_coverage_top", with_(CORE, FEATURES, _COVER) + "SELECT acc, gene_name, organism_name, seq_len, n_features, total_feature_span, round(CAST(total_feature_span AS DOUBLE) * 100.0::DOUBLE / seq_len, 1) AS pct_coverage FROM core JOIN spans USING (acc) WHERE seq_len > 0 ORDER BY pct_coverage DESC NULLS LAST, acc LIMIT 15")
def _q6i_top(t: Tables) -> DataFrame:
    return analytics.coverage(t.core_by_acc, t.features)


@query("q6i_exact_coverage", with_(CORE, FEATURES, "marks AS (SELECT DISTINCT acc, unnest(range(start_pos, end_pos + 1)) AS p FROM features)", "n AS (SELECT acc, count(*) AS covered FROM marks GROUP BY acc)") + "SELECT acc, seq_len, covered, round(CAST(covered AS DOUBLE) * 100.0::DOUBLE / seq_len, 1) AS pct_covered FROM core JOIN n USING (acc) WHERE seq_len > 0")
def _q6i_exact(t: Tables) -> DataFrame:
    return analytics.exact_coverage(t.core_by_acc, t.features)


# ---- the lake: sinks, sources, compaction, validation


def _lake(t: Tables, name: str = "lake") -> str:
    root = scratch(t.spark, name)
    lake.write_table(t.core, f"{root}/core")
    return root


@query("q3_partition_read", with_(CORE) + f"SELECT {CORE_COLUMNS} FROM core WHERE review_status = 'reviewed' AND tax_division = 'asia'")
def _q3(t: Tables) -> DataFrame:
    """One partition of a written lake, read by its folder (SRC-12)."""
    return parquet.read_partition(t.spark, _lake(t) + "/core", review_status="reviewed", tax_division="asia")


@query("q4_file_metadata")
def _q4(t: Tables) -> DataFrame:
    """What each file's footer says (SRC-16)."""
    return parquet.file_metadata(t.spark, parquet.list_files(t.spark, _lake(t)))


@query("q4a_row_groups")
def _q4a(t: Tables) -> DataFrame:
    """Statistics of the first ten columns of every row group (SRC-17, LIM-04)."""
    return parquet.row_groups(t.spark, parquet.list_files(t.spark, _lake(t)), first_columns=10)


@query("q4b_dataset_scan", with_(CORE) + "SELECT acc, seq_len FROM core WHERE review_status = 'reviewed' AND seq_len > 1000")
def _q4b(t: Tables) -> DataFrame:
    """A scan with a partition filter, a pushed filter and two columns (SRC-14, SRC-15)."""
    return parquet.read_lake(t.spark, _lake(t), "core").where((F.col("review_status") == "reviewed") & (F.col("seq_len") > 1000)).select("acc", "seq_len")


@query("q4c_compression")
def _q4c(t: Tables) -> DataFrame:
    return parquet.compression(t.spark, parquet.list_files(t.spark, _lake(t)))


@query("q7a_arrow_interchange", with_(CORE) + "SELECT tax_division, review_status, count(*) AS n_proteins, round(avg(seq_len)) AS avg_seq_len, min(seq_len) AS min_seq_len, max(seq_len) AS max_seq_len, round(avg(seq_mass)) AS avg_mass_da FROM core GROUP BY ALL")
def _q7a(t: Tables) -> DataFrame:
    """An aggregate to an Arrow table and back (SNK-13, SRC-21)."""
    return t.spark.createDataFrame(analytics.profile(t.core).toArrow())


@query("q7b_csv_export", with_(CORE) + "SELECT acc, id, organism_name, seq_len FROM core WHERE review_status = 'reviewed'")
def _q7b(t: Tables) -> DataFrame:
    path = scratch(t.spark, "csv")
    out = t.core.where(F.col("review_status") == "reviewed").select("acc", "id", "organism_name", "seq_len")
    lake.export(out, path)
    return t.spark.read.schema(out.schema).option("header", True).csv(path)


@query("q7c_persistent_table", with_(CORE) + "SELECT count(*) AS n FROM core")
def _q7c(t: Tables) -> DataFrame:
    return lake.persist_table(t.core, "lakeloom_core").agg(F.count(F.lit(1)).alias("n"))


@query("qr1_limit", "SELECT count(*) AS n FROM (SELECT * FROM orders LIMIT 5)")
def _qr1(t: Tables) -> DataFrame:
    """A bare limit gives any five rows: their number is what can be compared (LIM-02)."""
    return t.core.limit(5).agg(F.count(F.lit(1)).alias("n"))


@query("snk01_lake_round_trip", with_(CORE) + f"SELECT {CORE_COLUMNS} FROM core")
def _snk01(t: Tables) -> DataFrame:
    """Partitioned zstd Parquet, written and registered as a view (SNK-01, SNK-12, SRC-07)."""
    parquet.read_lake(t.spark, _lake(t), "core").createOrReplaceTempView("lakeloom_lake_core")
    return t.spark.sql("SELECT * FROM lakeloom_lake_core")


@query("snk05_json_round_trip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _snk05(t: Tables) -> DataFrame:
    """JSON lines, gzip, in files of at most 10,000 records (SNK-04, SNK-05, SRC-04)."""
    path = scratch(t.spark, "json")
    lake.export(t.customer, path, "json", rows_per_file=10_000)
    return records.read_lines(t.spark, path, t.customer.schema)


@query("snk06_partitioned_json", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, lower(c_mktsegment) AS c_mktsegment FROM customer")
def _snk06(t: Tables) -> DataFrame:
    path = scratch(t.spark, "json-parts")
    lake.export_partitioned_json(t.customer, path, "c_mktsegment")
    return t.spark.read.schema(t.customer.schema).json(path)


@query("snk07_tsv_concat", "SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT n_nationkey, n_name, n_regionkey FROM nation")
def _snk07(t: Tables) -> DataFrame:
    """Two tables of tab-separated files to one, with one header (SNK-07, SET-04)."""
    root = scratch(t.spark, "tsv")
    for part in ("a", "b"):
        lake.export(t.nation, f"{root}/{part}", "tsv", single=True)
    lake.concat_tables(t.spark, [f"{root}/a", f"{root}/b"], "tsv", f"{root}/all")
    return t.spark.read.schema(t.nation.schema).option("header", True).option("sep", "\t").csv(f"{root}/all")


@query("src01_wrapped_json", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _src01(t: Tables) -> DataFrame:
    """Documents {"results": [...]}, one a nation, written and read with their array taken apart (SRC-01, JSN-03)."""
    path = scratch(t.spark, "wrapped")
    rows = t.customer.select("c_nationkey", F.struct("c_custkey", "c_name", "c_acctbal").alias("r"))
    rows.groupBy("c_nationkey").agg(F.to_json(F.struct(F.collect_list("r").alias("results"))).alias("value")).repartition("c_nationkey").write.partitionBy("c_nationkey").option("compression", "gzip").text(path)
    schema = T.StructType([t.customer.schema[c] for c in ("c_custkey", "c_name", "c_acctbal")])
    return records.read_wrapped(t.spark, f"{path}/*", schema=schema)


@query("src01_streamed_json", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _src01_streamed(t: Tables) -> DataFrame:
    """The same by the source for documents too large to be one row."""
    path = scratch(t.spark, "wrapped")
    rows = t.customer.select("c_nationkey", F.struct("c_custkey", "c_name", "c_acctbal").alias("r"))
    rows.groupBy("c_nationkey").agg(F.to_json(F.struct(F.collect_list("r").alias("results"))).alias("value")).repartition("c_nationkey").write.partitionBy("c_nationkey").text(path)
    schema = T.StructType([t.customer.schema[c] for c in ("c_custkey", "c_name", "c_acctbal")])
    files = [r["path"] for r in parquet.list_files(t.spark, path, suffix=".txt").collect()]
    return records.stream_array(t.spark, files, schema)


@query("t04_collect", with_(CORE) + f"SELECT {CORE_COLUMNS} FROM core")
def _t04(t: Tables) -> DataFrame:
    """Two lakes, one without a column for what the other has, compacted by name (T-04, SRC-08, SET-01)."""
    root = scratch(t.spark, "parts")
    reviewed = F.col("review_status") == "reviewed"
    lake.write_table(t.core.where(reviewed), f"{root}/a/core")
    lake.write_table(t.core.where(~reviewed).select("acc", "id", "seq_mass", "seq_len", "gene_name", "organism_name", *KEYS), f"{root}/b/core")
    lake.collect_table(t.spark, "core", [f"{root}/a", f"{root}/b"], f"{root}/out")
    return parquet.read_lake(t.spark, f"{root}/out", "core")


@query("t06_partition_counts", with_(CORE) + "SELECT review_status, tax_division, count(*) AS n FROM core GROUP BY ALL ORDER BY ALL")
def _t06(t: Tables) -> DataFrame:
    return validate.partition_counts(t.spark, _lake(t), "core")


@query("t08_file_sizes")
def _t08(t: Tables) -> DataFrame:
    return validate.file_sizes(t.spark, _lake(t))


# ---- single operators


@query("cls01_tax_division", with_(LINEAGES) + """SELECT n_nationkey, n_name, CASE
  WHEN list_extract(lineage, 1) IN ('Bacteria', 'Archaea', 'Viruses') THEN lower(list_extract(lineage, 1))
  WHEN list_has(lineage, 'Homo') THEN 'human'
  WHEN list_extract(lineage, 1) = 'Eukaryota' AND list_extract(lineage, 2) = 'Fungi' THEN 'fungi'
  WHEN list_has(lineage, 'Rodentia') THEN 'rodents' WHEN list_has(lineage, 'Mammalia') THEN 'mammals'
  WHEN list_extract(lineage, 1) = 'Eukaryota' AND len(lineage) >= 4 AND list_extract(lineage, 3) = 'Chordata' AND list_extract(lineage, 4) = 'Craniata' THEN 'vertebrates'
  WHEN list_has_any(lineage, ['Viridiplantae', 'Rhodophyta', 'Stramenopiles']) THEN 'plants'
  WHEN list_extract(lineage, 1) = 'Eukaryota' THEN 'invertebrates' ELSE 'unclassified' END AS division FROM lineages""")  # fmt: skip
def _cls01(t: Tables) -> DataFrame:
    return t.lineages.select("n_nationkey", "n_name", taxonomy.tax_division(F.col("lineage")).alias("division"))


@query("cls02_taxon_group", with_(LINEAGES) + """SELECT n_nationkey, n_name, CASE WHEN n_nationkey = 3 THEN 'bakersyeast' WHEN n_nationkey = 7 THEN 'dog'
  WHEN lineage IS NULL OR len(lineage) = 0 THEN 'error'
  WHEN list_extract(lineage, 1) IN ('Bacteria', 'Archaea', 'Viruses') THEN lower(list_extract(lineage, 1))
  WHEN list_has(lineage, 'Homo') THEN 'human' WHEN list_extract(lineage, 1) <> 'Eukaryota' THEN 'unclassified'
  WHEN list_extract(lineage, 2) = 'Fungi' THEN 'fungi' WHEN list_has(lineage, 'Rodentia') THEN 'rodents' WHEN list_has(lineage, 'Mammalia') THEN 'mammals'
  WHEN list_extract(lineage, 3) = 'Chordata' AND list_extract(lineage, 4) = 'Craniata' THEN 'vertebrates'
  WHEN list_has_any(lineage, ['Viridiplantae', 'Rhodophyta', 'Stramenopiles', 'Euglyphida', 'Euglenida']) OR len(list_filter(lineage, lambda x: regexp_matches(x, 'phyceae$'))) > 0 THEN 'plants'
  ELSE 'invertebrates' END AS division FROM lineages""")  # fmt: skip
def _cls02(t: Tables) -> DataFrame:
    return t.lineages.select("n_nationkey", "n_name", taxonomy.taxon_group(F.col("lineage"), F.col("n_nationkey"), OVERRIDES).alias("division"))


@query("prj02_exclude", "SELECT * EXCLUDE (o_orderpriority, o_orderdate) FROM orders")
def _prj02(t: Tables) -> DataFrame:
    return t.orders.drop("o_orderpriority", "o_orderdate")


@query("prj03_struct_fields", "SELECT l_orderkey, l_linenumber, l_partkey AS start_value, l_suppkey AS end_value FROM lineitem")
def _prj03(t: Tables) -> DataFrame:
    """Fields of a nested struct (PRJ-01, PRJ-03, PRJ-04)."""
    nested = t.lineitem.select("l_orderkey", "l_linenumber", F.struct(F.struct(F.col("l_partkey").alias("value")).alias("start"), F.struct(F.col("l_suppkey").alias("value")).alias("end")).alias("location"))
    return nested.select("l_orderkey", "l_linenumber", F.col("location.start.value").alias("start_value"), F.col("location.`end`.value").alias("end_value"))


@query("prj05_list_index", "SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS first_part, CASE WHEN len(string_split(o_orderpriority, '-')) >= 4 THEN string_split(o_orderpriority, '-')[4] END AS fourth_part FROM orders")
def _prj05(t: Tables) -> DataFrame:
    """List elements, null beyond the end (PRJ-05, ARR-01)."""
    parts = F.split("o_orderpriority", "-")
    return t.orders.select("o_orderkey", F.get(parts, F.lit(0)).alias("first_part"), F.get(parts, F.lit(3)).alias("fourth_part"))


@query("prj06_with_columns", "SELECT l_orderkey, l_linenumber, l_quantity * l_extendedprice AS x0, l_quantity + l_tax AS x1, l_extendedprice - l_discount AS x2 FROM lineitem")
def _prj06(t: Tables) -> DataFrame:
    more = {"x0": F.col("l_quantity") * F.col("l_extendedprice"), "x1": F.col("l_quantity") + F.col("l_tax"), "x2": F.col("l_extendedprice") - F.col("l_discount")}
    return t.lineitem.withColumns(more).select("l_orderkey", "l_linenumber", *more)


@query("prj09_replace_values", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'sp' WHEN 'O' THEN 'tr' ELSE o_orderstatus END AS entry_type FROM orders")
def _prj09(t: Tables) -> DataFrame:
    return t.orders.replace({"F": "sp", "O": "tr"}, subset=["o_orderstatus"]).select("o_orderkey", F.col("o_orderstatus").alias("entry_type"))


@query("flt_predicates", """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE (o_orderstatus = 'F' AND o_totalprice > 1000 AND o_totalprice <= 400000)
  OR (o_orderpriority LIKE '%URGENT%' AND o_custkey IS NOT NULL AND o_totalprice >= 5000 AND o_totalprice < 450000)""")  # fmt: skip
def _flt(t: Tables) -> DataFrame:
    """Equality, ranges, LIKE, null tests, AND and OR (FLT-01 to FLT-04, FLT-12); all reach the scan."""
    p = F.col("o_totalprice")
    return t.orders.where(((F.col("o_orderstatus") == "F") & (p > 1000) & (p <= 400000)) | (F.col("o_orderpriority").like("%URGENT%") & F.col("o_custkey").isNotNull() & (p >= 5000) & (p < 450000))).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("flt_lists", with_(LINEAGES) + "SELECT n_nationkey, list_has(lineage, 'Mammalia') AS has_name, list_has_any(lineage, ['Viridiplantae', 'Rhodophyta']) AS has_any, len(list_filter(lineage, lambda x: regexp_matches(x, 'phyceae$'))) > 0 AS has_suffix, len(lineage) > 0 AS filled FROM lineages")
def _flt_lists(t: Tables) -> DataFrame:
    """Membership, any-of, regular expression over a list, list length (FLT-05, FLT-06, FLT-09, ARR-02, ARR-03, ARR-09)."""
    x = F.col("lineage")
    return t.lineages.select("n_nationkey", F.array_contains(x, "Mammalia").alias("has_name"), F.arrays_overlap(x, F.array(F.lit("Viridiplantae"), F.lit("Rhodophyta"))).alias("has_any"), F.exists(x, lambda e: e.rlike("phyceae$")).alias("has_suffix"), (F.size(x) > 0).alias("filled"))


@query("join01_inner", with_(CORE, SEQS) + "SELECT acc, organism_name, length(sequence) AS n FROM core JOIN seqs USING (acc, review_status, tax_division)")
def _join01(t: Tables) -> DataFrame:
    return t.core.join(t.seqs, TRIPLE).select("acc", "organism_name", F.length("sequence").cast("long").alias("n"))


@query("join02_left", "SELECT c_custkey, count(o_orderkey) AS n_orders FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def _join02(t: Tables) -> DataFrame:
    """A left join; the counts are made before it, so that one row a customer meets the others (JOIN-02, AGG-03)."""
    n = t.orders.groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"))
    return t.customer.join(n, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query("join07_cross", "SELECT r_name, n_name FROM region, nation")
def _join07(t: Tables) -> DataFrame:
    return t.region.crossJoin(t.nation).select("r_name", "n_name")


@query("join08_lookup", "SELECT n_nationkey, CASE n_nationkey WHEN 3 THEN 'bakersyeast' WHEN 7 THEN 'dog' ELSE n_name END AS name FROM nation")
def _join08(t: Tables) -> DataFrame:
    """A map of names that wins over the column (JOIN-08, MAP-01)."""
    names = F.create_map(*[F.lit(x) for k, v in OVERRIDES.items() for x in (k, v)])
    return t.nation.select("n_nationkey", F.coalesce(F.try_element_at(names, F.col("n_nationkey")), F.col("n_name")).alias("name"))


@query("agg04_distinct", "SELECT l_returnflag, count(*) AS n, count(DISTINCT l_orderkey) AS n_orders FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_orderkey) > 1 ORDER BY 1")
def _agg04(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l_orderkey").alias("n_orders")).where("n_orders > 1").orderBy("l_returnflag")


@query("agg07_conditional_sum", "SELECT l_linestatus, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)::BIGINT AS n_returned, sum(CASE WHEN l_returnflag <> 'R' THEN l_linenumber ELSE 0 END)::BIGINT AS other_lines FROM lineitem GROUP BY 1")
def _agg07(t: Tables) -> DataFrame:
    r = F.col("l_returnflag") == "R"
    return t.lineitem.groupBy("l_linestatus").agg(F.sum(F.when(r, 1).otherwise(0)).alias("n_returned"), F.sum(F.when(~r, F.col("l_linenumber")).otherwise(0)).alias("other_lines"))


@query("agg09_distinct_list", "SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(l_returnflag))), ',') AS flags FROM lineitem GROUP BY 1")
def _agg09(t: Tables) -> DataFrame:
    """Distinct values as a sorted list (AGG-08, AGG-09, ARR-05)."""
    return t.lineitem.groupBy("l_orderkey").agg(F.array_join(F.sort_array(F.collect_set("l_returnflag")), ",").alias("flags"))


@query("agg13_group_len", "SELECT event_type, count(*) AS len FROM events GROUP BY 1")
def _agg13(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("len"))


@query("agg14_wide", "SELECT l_returnflag, " + ", ".join(f"count(*) FILTER (WHERE l_linenumber = {k}) AS n_{k}" for k in range(1, 8)) + ", count(*) AS total FROM lineitem GROUP BY 1")
def _agg14(t: Tables) -> DataFrame:
    """Many aggregates in one pass (AGG-14)."""
    return t.lineitem.groupBy("l_returnflag").agg(*[F.count(F.when(F.col("l_linenumber") == k, 1)).alias(f"n_{k}") for k in range(1, 8)], F.count(F.lit(1)).alias("total"))


@query("agg15_dropna_count", "SELECT c_mktsegment, count(c_acctbal) AS n FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 1 ORDER BY n DESC, c_mktsegment")
def _agg15(t: Tables) -> DataFrame:
    return t.customer.where("c_mktsegment is not null").groupBy("c_mktsegment").agg(F.count("c_acctbal").alias("n")).orderBy(F.desc_nulls_last("n"), "c_mktsegment")


@query("agg20_arg_max", "SELECT o_custkey, arg_max(o_orderkey, o_totalprice * 1000000000 + o_orderkey) AS largest_order, max(o_totalprice) AS largest FROM orders GROUP BY 1")
def _agg20(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("largest_order"), F.max("o_totalprice").alias("largest"))


@query("agg22_grouped_lists", "SELECT o_custkey, array_to_string(list_sort(list(o_orderkey)), ',') AS orders FROM orders GROUP BY 1")
def _agg22(t: Tables) -> DataFrame:
    """Items gathered by key (AGG-22, AGG-23)."""
    return t.orders.groupBy("o_custkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list("o_orderkey")), lambda x: x.cast("string")), ",").alias("orders"))


@query("win01_row_number", "SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS rank FROM lineitem")
def _win01(t: Tables) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy(F.desc("l_extendedprice"), "l_linenumber")
    return t.lineitem.select("l_orderkey", "l_linenumber", F.row_number().over(w).cast("long").alias("rank"))


@query("srt01_top_orders", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority ASC NULLS LAST, o_totalprice DESC NULLS LAST, o_orderkey LIMIT 20")
def _srt01(t: Tables) -> DataFrame:
    """A mixed order and a limit: a top-k, never a full sort (SRT-01, LIM-01, LIM-03)."""
    return t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy(F.asc_nulls_last("o_orderpriority"), F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(20)


@query("set01_union_by_name", "SELECT l_orderkey, l_linenumber, l_tax, NULL::DOUBLE AS l_discount FROM lineitem WHERE l_linestatus = 'O' UNION ALL BY NAME SELECT l_linenumber, l_orderkey, l_discount FROM lineitem WHERE l_linestatus <> 'O'")
def _set01(t: Tables) -> DataFrame:
    """Parts of different columns in different order (SET-01)."""
    o = F.col("l_linestatus") == "O"
    return t.lineitem.where(o).select("l_orderkey", "l_linenumber", "l_tax").unionByName(t.lineitem.where(~o).select("l_linenumber", "l_orderkey", "l_discount"), allowMissingColumns=True)


@query("set02_union_all", "SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def _set02(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")).union(t.supplier.select("s_suppkey", "s_name"))


@query("sub01_cte", "WITH big AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) SELECT n, count(*) AS customers FROM (SELECT * FROM big) GROUP BY n ORDER BY n")
def _sub01(t: Tables) -> DataFrame:
    """CTE and derived table in Spark SQL itself (SUB-01 to SUB-03, AGG-10 to AGG-12)."""
    t.orders.createOrReplaceTempView("lakeloom_orders")
    return t.spark.sql("WITH big AS (SELECT o_custkey, count(*) AS n FROM lakeloom_orders GROUP BY ALL) SELECT n, count(*) AS customers FROM (SELECT * FROM big) GROUP BY 1 ORDER BY n")


@query("str_functions", """SELECT doc_id, length(text) AS chars, length(replace(text, 'a', '')) AS without_a, len(regexp_extract_all(text, '[0-9]')) AS digits, text LIKE '%the%' AS has_the, regexp_matches(source, '[0-9]$') AS numbered,
  lower(source) AS low, suffix(source, '1') AS ends, substring(lang, 1, 1) AS initial, lpad(lang, 6, '.') AS padded FROM documents""")  # fmt: skip
def _str(t: Tables) -> DataFrame:
    """String functions over whole texts (STR-01 to STR-12)."""
    x, s = F.col("text"), F.col("source")
    return t.documents.select(
        "doc_id", F.length(x).cast("long").alias("chars"), F.length(F.replace(x, F.lit("a"), F.lit(""))).cast("long").alias("without_a"), scalars.pattern_count(x, "[0-9]").alias("digits"), x.like("%the%").alias("has_the"), s.rlike("[0-9]$").alias("numbered"),
        F.lower(s).alias("low"), s.endswith("1").alias("ends"), F.substring("lang", 1, 1).alias("initial"), F.lpad("lang", 6, ".").alias("padded"),
    )


@query("mth_functions", """SELECT l_orderkey, l_linenumber, round(l_extendedprice / 7, 2) AS rounded, CAST(floor(l_extendedprice / 100) * 100 AS BIGINT) AS bucket, least(l_partkey, l_suppkey) AS low, greatest(l_partkey, l_suppkey) AS high,
  CASE WHEN l_linenumber - 1 <> 0 THEN CAST(l_partkey AS DOUBLE) / (l_linenumber - 1) END AS share, l_partkey + 9 - l_suppkey + 1 AS span FROM lineitem""")  # fmt: skip
def _mth(t: Tables) -> DataFrame:
    """Rounding, floors, least and greatest, division without an error at 0 (MTH-01 to MTH-09, CND-01)."""
    a, b = F.col("l_partkey"), F.col("l_suppkey")
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") / 7, 2).alias("rounded"), scalars.bucket(F.col("l_extendedprice"), 100).alias("bucket"), F.least(a, b).alias("low"), F.greatest(a, b).alias("high"), scalars.ratio(a, F.col("l_linenumber") - 1).alias("share"), (a + 9 - b + 1).alias("span"))


@query("arr04_unnest", "SELECT conv_id, turn, role, text FROM conversations")
def _arr04(t: Tables) -> DataFrame:
    """Lists of structs made by key and taken apart again (ARR-04, ARR-06 to ARR-08)."""
    return t.conversations.groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role", "text")).alias("turns")).select("conv_id", F.inline("turns"))


@query("jsn01_paths", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def _jsn01(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("jsn02_variant", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def _jsn02(t: Tables) -> DataFrame:
    """JSON kept as it is, read by path and type (JSN-02, TYP-01)."""
    return t.events.select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@query("jsn03_to_json", "SELECT n_nationkey, CAST(json_object('name', n_name, 'region', n_regionkey) AS VARCHAR) AS record FROM nation")
def _jsn03(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", F.to_json(F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))).alias("record"))


@query("typ02_casts", "SELECT o_orderkey, CAST(o_totalprice AS VARCHAR) IS NOT NULL AS shown, CAST(floor(o_totalprice) AS BIGINT) AS whole, TRY_CAST(o_orderpriority AS INT) AS priority, CAST(o_orderdate AS DATE) AS day FROM orders")
def _typ02(t: Tables) -> DataFrame:
    """Casts, with null for what can't be one (TYP-02, DAT-01)."""
    return t.orders.select("o_orderkey", F.col("o_totalprice").cast("string").isNotNull().alias("shown"), F.floor("o_totalprice").cast("long").alias("whole"), F.col("o_orderpriority").try_cast("int").alias("priority"), F.col("o_orderdate").cast("date").alias("day"))


@query("hsh01_md5", "SELECT doc_id, md5(text) AS digest FROM documents")
def _hsh01(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5("text").alias("digest"))


@query("df01_batches", "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 500 AS batch FROM orders")
def _df01(t: Tables) -> DataFrame:
    return dataflow.batches(t.orders.select("o_orderkey"), "o_orderkey", 500)


@query("df03_fan_out", with_(CORE) + "SELECT 'core' AS tab, count(*) AS n FROM core UNION ALL SELECT 'seqs', count(*) FROM core")
def _df03(t: Tables) -> DataFrame:
    """One input to two tables, each written and counted (DF-03, T-05, T-07)."""
    root = scratch(t.spark, "fan")
    out = []
    for name, df in (("core", t.core), ("seqs", t.seqs)):
        lake.write_table(df, f"{root}/{name}")
        out.append(parquet.read_lake(t.spark, root, name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tab"), "n"))
    return out[0].unionByName(out[1])


# ---- nested records


RECORD = schema.parse_type(
    "STRUCT(entryType VARCHAR, primaryAccession VARCHAR, uniProtkbId VARCHAR, organism STRUCT(scientificName VARCHAR, taxonId BIGINT, lineage VARCHAR[]), genes STRUCT(geneName STRUCT(value VARCHAR))[],"
    ' features STRUCT(type VARCHAR, location STRUCT(start STRUCT(value BIGINT), "end" STRUCT(value BIGINT)), description VARCHAR)[], keywords VARCHAR[], sequence STRUCT(value VARCHAR, length BIGINT, molWeight BIGINT, md5 VARCHAR))'
)
_DIVISIONS = f"divisions AS (SELECT * FROM ({_SQL['cls01_tax_division']}))"
_OF_RECORDS = with_(_DIVISIONS, RECORDS)
_CORE_OF_RECORDS = """SELECT 'P' || o_orderkey AS acc, 'ID' || o_orderkey AS id, o_custkey AS taxid, n_name AS organism_name, if(o_custkey % 3 = 0, c_name, NULL) AS gene_name,
  review_status, division AS tax_division, CAST(length(sequence) AS BIGINT) AS seq_len, CAST(floor(o_totalprice) AS BIGINT) AS seq_mass, md5(sequence) AS seq_md5, o_orderpriority AS keyword FROM records"""
_CORE_NAMES = ["acc", "id", "taxid", "organism_name", "gene_name", "review_status", "tax_division", "seq_len", "seq_mass", "seq_md5"]


def _record_files(t: Tables) -> str:
    path = scratch(t.spark, "record-lines")
    t.records.write.options(**QUICK_GZIP).text(path)
    return path


def _record_table(t: Tables, name: str) -> DataFrame:
    root = scratch(t.spark, "record-lake")
    lake.build_lake(records.read_lines(t.spark, _record_files(t), RECORD), root, (name,))
    return parquet.read_lake(t.spark, root, name)


@query("t01_core", _OF_RECORDS + _CORE_OF_RECORDS)
def _t01(t: Tables) -> DataFrame:
    """Nested records to core: derived columns, keys, and what is passed on (T-01, SRC-03, PRJ-01 to PRJ-08)."""
    return _record_table(t, "core").select(*_CORE_NAMES, F.get("keywords", F.lit(0)).alias("keyword"))


@query("t02_seqs", _OF_RECORDS + "SELECT 'P' || o_orderkey AS acc, sequence, review_status, division AS tax_division FROM records")
def _t02(t: Tables) -> DataFrame:
    return _record_table(t, "seqs")


@query("t03_features", _OF_RECORDS + "SELECT 'P' || o_orderkey AS acc, l_returnflag || l_linestatus AS type, l_partkey % 500 AS start_pos, if(l_linenumber <> 3, l_partkey % 500 + 9, NULL) AS end_pos, CAST(l_linenumber AS VARCHAR) AS description, review_status, division AS tax_division FROM records JOIN lineitem ON l_orderkey = o_orderkey")
def _t03(t: Tables) -> DataFrame:
    return _record_table(t, "features")


@query("t14_old_core", _OF_RECORDS + "SELECT 'P' || o_orderkey AS \"primaryAccession\", CASE o_orderstatus WHEN 'F' THEN 'sp' WHEN 'O' THEN 'tr' ELSE 'other' END AS \"entryType\", CAST(length(sequence) AS BIGINT) AS \"seqLen\", CAST(floor(o_totalprice) AS BIGINT) AS \"molWeight\" FROM records")
def _t14(t: Tables) -> DataFrame:
    """The older core, by its exact test of the entry type (T-14, FLT-08, PRJ-09)."""
    return tables.old_core(records.read_lines(t.spark, _record_files(t), RECORD))


@query("t15_old_sequence", _OF_RECORDS + "SELECT 'P' || o_orderkey AS \"primaryAccession\", sequence, CAST(length(sequence) AS BIGINT) AS \"seqLen\", md5(sequence) AS md5 FROM records")
def _t15(t: Tables) -> DataFrame:
    return tables.old_sequence(records.read_lines(t.spark, _record_files(t), RECORD))


@query("t07_validation", _OF_RECORDS + "SELECT review_status, division AS tax_division, count(*) AS n, true AS ok FROM records GROUP BY ALL")
def _t07(t: Tables) -> DataFrame:
    """A lake of all three tables, validated: its report's counts of core and its verdict (T-05, T-07, T-09, SNK-10)."""
    root = scratch(t.spark, "validated")
    lake.build_lake(records.read_lines(t.spark, _record_files(t), RECORD), root)
    r = validate.validate(t.spark, root, strict=True)
    return t.spark.createDataFrame([(*p, r.ok) for p in r.partitions["core"]], "review_status string, tax_division string, n long, ok boolean")


def _wrapped(rows: DataFrame) -> DataFrame:
    """The lines of a document {"results": [...]} for each task's records, of any size: a task holds a batch of it."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrap = lambda x: pa.RecordBatch.from_arrays([pa.array(x, pa.string())], ["value"])
        yield wrap(['{"results":['])
        comma = ""
        for b in batches:
            if b.num_rows:
                yield wrap([comma + b.column(0)[0].as_py(), *("," + x for x in b.column(0)[1:].to_pylist())])
                comma = ","
        yield wrap(["]}"])

    return rows.mapInArrow(lines, "value string")


@query("df00_job", _OF_RECORDS + _CORE_OF_RECORDS)
def _df00(t: Tables) -> DataFrame:
    """One job from wrapped documents to a validated lake: cut, infer, merge, transform, write, validate, in two runs, the
    second adding to what the first made (DF-01 to DF-10, SRC-01, S-01 to S-03, T-01 to T-09)."""
    docs, root = scratch(t.spark, "documents"), scratch(t.spark, "job-lake")
    _wrapped(t.keyed_records(least=4).select("value")).write.text(docs)
    files = [r["path"] for r in parquet.list_files(t.spark, docs, suffix=".txt").collect()]
    for k, some in enumerate((files[::2], files[1::2])):
        if some:
            job.run_job(t.spark, some, root, add=k > 0)
    return parquet.read_lake(t.spark, root, "core").select(*_CORE_NAMES, F.get("keywords", F.lit(0)).alias("keyword"))


@query("df07_append", _OF_RECORDS + "SELECT review_status, division AS tax_division, count(*) AS n FROM records GROUP BY ALL")
def _df07(t: Tables) -> DataFrame:
    """A lake built from some records, and added to by a stream over the files of the others (DF-07)."""
    root, rest = scratch(t.spark, "grown"), scratch(t.spark, "later-lines")
    early, rows = F.pmod(F.xxhash64("o_orderkey"), F.lit(2)) == 0, t.keyed_records()
    lake.build_lake(records.parse_lines(rows.where(early), RECORD), root)
    rows.where(~early).select("value").write.text(rest)
    append_stream(t.spark, rest, RECORD, root, scratch(t.spark, "append-log")).awaitTermination()
    return validate.partition_counts(t.spark, root, "core")


# ---- schemas


def _values(columns: str, rows: list[tuple]) -> str:
    text = lambda x: "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(text, r)) + ')' for r in rows)}) AS v({columns})"


_INFERRED = [("c_acctbal", "DOUBLE"), ("c_custkey", "BIGINT"), ("day", "DATE"), ("nest", "STRUCT(a VARCHAR, b BIGINT[])"), ("open", "BOOLEAN")]


@query("s01_inferred", _values("column_name, column_type", _INFERRED))
def _s01(t: Tables) -> DataFrame:
    """The schema of JSON lines by a full scan, dates told from strings (S-01, S-05, SRC-05, SRC-06)."""
    path = scratch(t.spark, "infer")
    nest = F.struct(F.col("c_name").alias("a"), F.array(F.col("c_custkey")).alias("b")).alias("nest")
    t.customer.select("c_custkey", "c_acctbal", F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("c_nationkey")), "yyyy-MM-dd").alias("day"), (F.col("c_acctbal") > 0).alias("open"), nest).write.json(path)
    return schema.describe(t.spark.createDataFrame([], schema.infer(t.spark, path))).select("column_name", "column_type")


_MERGES = [
    ("BIGINT|BIGINT", "BIGINT"), ("BIGINT|DOUBLE", "DOUBLE"), ("BOOLEAN|BIGINT", "BIGINT"), ("BIGINT|VARCHAR", "VARCHAR"), ("JSON|VARCHAR", "VARCHAR"),
    ("STRUCT(a BIGINT)|STRUCT(a BIGINT, b VARCHAR)", "STRUCT(a BIGINT, b VARCHAR)"), ("STRUCT(a BIGINT)|JSON", "JSON"), ("BIGINT|STRUCT(a BIGINT)", "STRUCT(a BIGINT)"),
    ("DATE|TIMESTAMP", "TIMESTAMP"), ("DATE|BIGINT", "DATE"), ("BIGINT[]|DOUBLE", "BIGINT[]"),
]


@query("s02_merged_types", _values("types, merged", _MERGES))
def _s02(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([(x, schema.merge_types(x.split("|"))) for x, _ in _MERGES], "types string, merged string")


@query("s03_merged_schemas", _values("mode, column_name, column_type", [
    ("reference", "a", "DOUBLE"), ("reference", "b", "STRUCT(x BIGINT, yy VARCHAR)"), ("reference", "c", "VARCHAR"),
    ("deep", "a", "DOUBLE"), ("deep", "b", "STRUCT(z DOUBLE, x BIGINT, yy VARCHAR)"), ("deep", "c", "VARCHAR"),
]))
def _s03(t: Tables) -> DataFrame:
    """Schemas of several chunks to one, by rank alone and field by field (S-03)."""
    some = [{"a": "BIGINT", "b": "STRUCT(z DOUBLE)"}, {"c": "VARCHAR", "b": "STRUCT(x BIGINT, yy VARCHAR)", "a": "DOUBLE"}]
    return t.spark.createDataFrame([(m, c, k) for m in ("reference", "deep") for c, k in schema.merge_schemas(some, m).items()], "mode string, column_name string, column_type string")


_TYPES = ["BIGINT", "VARCHAR[]", "STRUCT(a BIGINT, \"b c\" VARCHAR[])", "MAP(VARCHAR, JSON)[]", "DECIMAL(12,2)", "STRUCT(s STRUCT(t DATE)[])[]"]


@query("s04_type_strings", _values("given, parsed", [(x, x) for x in _TYPES]))
def _s04(t: Tables) -> DataFrame:
    """Type strings to Spark types and back, through an empty table of each (S-04, S-06)."""
    seen = lambda x: schema.describe(t.spark.createDataFrame([], schema.reader_schema({"c": x}))).first()["column_type"]
    return t.spark.createDataFrame([(x, seen(x)) for x in _TYPES], "given string, parsed string")


# ---- footers


@query("q4_footer_rows", with_(CORE) + "SELECT count(*) AS n, CAST(8 - 2 AS BIGINT) AS columns FROM core")
def _q4_rows(t: Tables) -> DataFrame:
    """Rows and columns by the footers of a written lake; the keys are folders (SRC-16, SRC-19)."""
    return parquet.file_metadata(t.spark, parquet.list_files(t.spark, _lake(t))).agg(F.sum("num_rows").alias("n"), F.max("num_columns").cast("long").alias("columns"))


@query("q4a_statistics", with_(CORE) + "SELECT 'seq_len' AS \"column\", min(seq_len) AS low, max(seq_len) AS high, count(*) - count(seq_len) AS nulls FROM core UNION ALL SELECT 'acc', min(acc), max(acc), count(*) - count(acc) FROM core")
def _q4a_statistics(t: Tables) -> DataFrame:
    """Least, greatest and nulls of columns by the statistics of row groups alone (SRC-17)."""
    groups = parquet.row_groups(t.spark, parquet.list_files(t.spark, _lake(t))).where(F.col("column").isin("seq_len", "acc"))
    return groups.groupBy("column").agg(F.min(F.col("min_value").cast("long")).alias("low"), F.max(F.col("max_value").cast("long")).alias("high"), F.sum("null_count").cast("long").alias("nulls"))


@query("str10_file_parts", "SELECT page_id, string_split(regexp_replace(regexp_extract(url, '([^/]*)$', 1), '\\.[^.]*$', ''), '.') AS parts FROM pages")
def _str10(t: Tables) -> DataFrame:
    return t.pages.select("page_id", scalars.file_parts(F.col("url")).alias("parts"))


# ---- files over HTTP


def _remote(t: Tables, table: str, *columns: str) -> DataFrame:
    """A table's files by URL, only the bytes of some columns (SRC-09, SNK-15)."""
    files = [r["path"] for r in parquet.list_files(t.spark, f"{t.sf_dir}/{table}.parquet").collect()]
    return parquet.read_http(t.spark, server.urls(t.spark, t.sf_dir, files), list(columns))


@query("q5b_remote_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def _q5b(t: Tables) -> DataFrame:
    return _remote(t, "orders", "o_orderkey", "o_totalprice", "o_orderstatus").where("o_orderstatus = 'F'").drop("o_orderstatus")


@query("q5c_remote_totals", "SELECT count(*) AS n, round(avg(o_totalprice)) AS mean, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders")
def _q5c_remote(t: Tables) -> DataFrame:
    return _remote(t, "orders", "o_totalprice").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice")).alias("mean"), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"))


@query("q5d_remote_groups", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY ALL")
def _q5d(t: Tables) -> DataFrame:
    return _remote(t, "orders", "o_orderstatus").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
