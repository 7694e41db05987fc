"""The driver's tables in the shape of the lake: core from orders, features from lineitem, seqs from documents.

Each adapter exists twice, as a DataFrame and as SQL, so that queries can be held against another engine.
"""

from __future__ import annotations

import math
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.taxonomy import REVIEWED_TYPE, UNREVIEWED_TYPE

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: Bytes of a table's files whose rows one task takes, once they are shuffled by a key.
PART_BYTES = 2 << 20


class Tables:
    """The tables under a folder, and the adapters over them; all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def parts(self, table: str) -> int:
        """In how many parts rows of a table are shuffled, so that a task's share doesn't grow with it; 0, left to Spark, where
        the cores are as many."""
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{self.sf_dir}/{table}.parquet")
        n = math.ceil(path.getFileSystem(sc._jsc.hadoopConfiguration()).getContentSummary(path).getLength() / PART_BYTES)
        return n if n > sc.defaultParallelism else 0

    @staticmethod
    def spread(rows: DataFrame, parts: int, key: str) -> DataFrame:
        return rows.repartition(parts, key) if parts else rows

    @cached_property
    def core(self) -> DataFrame:
        c, n, r = self.customer, self.nation, self.region
        o = self.spread(self.orders, self.parts("orders"), "o_custkey")
        joined = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
        return joined.select(
            F.col("o_orderkey").alias("acc"),
            F.concat(F.lit("E"), F.col("o_orderkey").cast("string")).alias("id"),
            F.col("n_name").alias("organism_name"),
            F.col("c_name").alias("gene_name"),
            F.when(F.col("o_orderstatus") == "F", "reviewed").otherwise("unreviewed").alias("review_status"),
            F.lower("r_name").alias("tax_division"),
            F.floor(F.col("o_totalprice") / 100).cast("long").alias("seq_len"),
            F.col("o_totalprice").alias("seq_mass"),
        )

    @cached_property
    def core_by_acc(self) -> DataFrame:
        """core, shuffled like features: both meet by acc where they are."""
        return self.spread(self.core, self.parts("lineitem"), "acc")

    @cached_property
    def features(self) -> DataFrame:
        """Shuffled before they are counted or sorted: a scan's task has more rows the larger the files are."""
        keys = self.core_by_acc.select("acc", "review_status", "tax_division")
        rows = self.lineitem.select(
            F.col("l_orderkey").alias("acc"),
            F.concat("l_returnflag", "l_linestatus").alias("type"),
            (F.col("l_partkey") % 500).alias("start_pos"),
            ((F.col("l_partkey") % 500) + F.col("l_quantity").cast("long")).alias("end_pos"),
            F.col("l_quantity").alias("weight"),
        )
        return self.spread(rows, self.parts("lineitem"), "acc").join(keys, "acc")

    @cached_property
    def seqs(self) -> DataFrame:
        return self.core.select("acc", F.repeat(F.lit("CAD"), (F.col("acc") % 40 + 1).cast("int")).alias("sequence"), "review_status", "tax_division")

    @cached_property
    def texts(self) -> DataFrame:
        return self.documents.select(F.col("doc_id").alias("acc"), F.col("text").alias("sequence"), F.col("lang").alias("review_status"), "source")

    @cached_property
    def lineages(self) -> DataFrame:
        """A lineage of four names for each nation."""
        first = F.element_at(F.array(*map(F.lit, ("Bacteria", "Eukaryota", "Viruses", "Eukaryota", "Other"))), F.col("n_regionkey") + 1)
        second = F.element_at(F.array(*map(F.lit, ("Fungi", "Metazoa", "Viridiplantae"))), F.col("n_nationkey") % 3 + 1)
        third = F.element_at(F.array(*map(F.lit, ("Chordata", "Rodentia"))), F.col("n_nationkey") % 2 + 1)
        fourth = F.element_at(F.array(*map(F.lit, ("Craniata", "Mammalia", "Homo", "Phaeophyceae", "Insecta"))), F.col("n_nationkey") % 5 + 1)
        return self.nation.select("n_nationkey", "n_name", F.array(first, second, third, fourth).alias("lineage"))

    @property
    def records(self) -> DataFrame:
        """A nested record for each order, as a JSON string in ``value``."""
        return self.keyed_records().select("value")

    def keyed_records(self, least: int = 0) -> DataFrame:
        """Records beside their ``o_orderkey``, in ``least`` parts or more. The features of a record come in the order in which
        a shuffle brings them, so ``value`` may differ from run to run: what splits the records must go by the key."""
        o, c, n, parts_of_all = self.orders, self.customer, self.lineages, max(least, self.parts("lineitem"))
        entry = F.when(F.col("o_orderstatus") == "F", REVIEWED_TYPE).when(F.col("o_orderstatus") == "O", UNREVIEWED_TYPE).otherwise("other")
        place = F.struct(F.struct((F.col("l_partkey") % 500).alias("value")).alias("start"), F.when(F.col("l_linenumber") != 3, F.struct((F.col("l_partkey") % 500 + 9).alias("value"))).alias("end"))
        parts = self.spread(self.lineitem, parts_of_all, "l_orderkey").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.concat("l_returnflag", "l_linestatus").alias("type"), place.alias("location"), F.col("l_linenumber").cast("string").alias("description"))).alias("features"))
        gene = F.when(F.col("o_custkey") % 3 == 0, F.array(F.struct(F.struct(F.col("c_name").alias("value")).alias("geneName")))).when(F.col("o_custkey") % 3 == 1, F.from_json(F.lit("[]"), "array<struct<geneName:struct<value:string>>>"))
        entries = self.spread(self.spread(o, self.parts("orders"), "o_custkey").join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey), parts_of_all, "o_orderkey")
        rows = entries.join(parts, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        text = F.repeat(F.lit("CAD"), (F.col("o_orderkey") % 40 + 1).cast("int"))
        record = F.struct(
            entry.alias("entryType"), F.concat(F.lit("P"), F.col("o_orderkey").cast("string")).alias("primaryAccession"), F.concat(F.lit("ID"), F.col("o_orderkey").cast("string")).alias("uniProtkbId"),
            F.struct(F.col("n_name").alias("scientificName"), F.col("o_custkey").alias("taxonId"), F.col("lineage")).alias("organism"), gene.alias("genes"), F.col("features"),
            F.array("o_orderpriority").alias("keywords"), F.struct(text.alias("value"), F.length(text).cast("long").alias("length"), F.floor("o_totalprice").cast("long").alias("molWeight"), F.md5(text).alias("md5")).alias("sequence"),
        )
        return rows.select("o_orderkey", F.to_json(record).alias("value"))


CORE = """core AS (
  SELECT o_orderkey AS acc, 'E' || o_orderkey AS id, n_name AS organism_name, c_name AS gene_name,
    if(o_orderstatus = 'F', 'reviewed', 'unreviewed') AS review_status, lower(r_name) AS tax_division,
    CAST(floor(o_totalprice / 100) AS BIGINT) AS seq_len, o_totalprice AS seq_mass
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
FEATURES = """features AS (
  SELECT l_orderkey AS acc, l_returnflag || l_linestatus AS type, l_partkey % 500 AS start_pos,
    l_partkey % 500 + CAST(l_quantity AS BIGINT) AS end_pos, l_quantity AS weight, review_status, tax_division
  FROM lineitem JOIN core ON l_orderkey = acc)"""
SEQS = "seqs AS (SELECT acc, repeat('CAD', CAST(acc % 40 + 1 AS INT)) AS sequence, review_status, tax_division FROM core)"
TEXTS = "texts AS (SELECT doc_id AS acc, text AS sequence, lang AS review_status, source FROM documents)"
LINEAGES = """lineages AS (
  SELECT n_nationkey, n_name, [['Bacteria', 'Eukaryota', 'Viruses', 'Eukaryota', 'Other'][n_regionkey + 1], ['Fungi', 'Metazoa', 'Viridiplantae'][n_nationkey % 3 + 1],
    ['Chordata', 'Rodentia'][n_nationkey % 2 + 1], ['Craniata', 'Mammalia', 'Homo', 'Phaeophyceae', 'Insecta'][n_nationkey % 5 + 1]] AS lineage
  FROM nation)"""


RECORDS = """records AS (
  SELECT *, CASE o_orderstatus WHEN 'F' THEN 'reviewed' ELSE 'unreviewed' END AS review_status, repeat('CAD', CAST(o_orderkey % 40 + 1 AS INT)) AS sequence
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN divisions ON c_nationkey = n_nationkey)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
