"""URL filter by link-graph propagation over hosts.

Trust is a personalised PageRank that starts from trusted seeds and follows links; distrust starts from blocked seeds and
follows them backwards, for a site is judged by what it links to. Edges run between hosts: hyperlinks of the pages (each
page counts once for each host it links to), and affiliation, both ways, of a host and the domain one label above it.
Both vectors are one table of (host, kind) that a join with the edges and a sum push on. A round is a query of its own, which
writes the table to the shared folder: the driver's memory grows with plans of several. Where the edges of both kinds are
no more than TASK_BYTES, one task takes them and does all rounds, by the same sums. A round shrinks what is still to come by
DAMPING at least, so ROUNDS rounds leave out no more than TOLERANCE of the weight, whatever the graph. Vectors are scaled to
sum to 1 at the end, which is the same as sending the weight of hosts without links back to the seeds. A host is blocked if
its distrust is greater than BALANCE times its trust.

Defined results: a null or unreadable url has a null host, and its page is allowed with null scores. Null html has no
links. A page_id that comes twice is two pages. Seeds are patterns, matched against hosts; a host that is both is
blocked only. No seeds of a kind give zeros of it. Long pages and hosts of any number of labels are taken whole. Extra
columns don't matter. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import claim, forget, saved, ship

TRUSTED, BLOCKED = (r"\.org$",), (r"^blog\.",)
DAMPING, BALANCE, AFFILIATION = 0.85, 1.0, 1.0
TOLERANCE = 1e-6
ROUNDS = math.ceil(math.log(TOLERANCE) / math.log(DAMPING))
BROADCAST_HOSTS, HOT_LINKS = 100_000, 1_000_000
TASK_BYTES, ROW = 64_000_000, 24  # a row of a flow has two hosts and ROW bytes
HOST = r"^\s*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@\s]*@)?([^/?#:\s]+)"
LINK = r"""<a\s[^>]*?href\s*=\s*["']?\s*((?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.nullif(F.rtrim(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(".")), F.lit(""))


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight) between different hosts."""
    linked = pages.select(host_of(F.col("url")).alias("src"), F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(f"(?i){LINK}"), 1), host_of)).alias("to"))
    links = linked.where("src is not null").select("src", F.explode("to").alias("dst")).where("dst is not null and dst <> src").groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    hosts = linked.select(F.explode(F.concat(F.array("src"), F.coalesce("to", F.array().cast("array<string>")))).alias("src")).where("src is not null").distinct()
    # up to the domain of two labels: www.a.example.org, a.example.org, example.org
    chain = F.expr("transform(sequence(0, greatest(size(split(src, '[.]')) - 2, 0)), i -> array_join(slice(split(src, '[.]'), i + 1, size(split(src, '[.]'))), '.'))")
    up = hosts.select(F.posexplode(chain).alias("i", "low"), chain.alias("chain")).withColumn("high", F.expr("get(chain, i + 1)")).where("high is not null and not low rlike '^[0-9.]+$'").select("low", "high").distinct()
    kin = up.select(F.col("low").alias("src"), F.col("high").alias("dst")).unionByName(up.select(F.col("high").alias("src"), F.col("low").alias("dst"))).withColumn("weight", F.lit(AFFILIATION))
    return links.unionByName(kin).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def matches(host: Column, patterns: tuple[str, ...]) -> Column:
    return F.lit(False) if not patterns else F.greatest(*[host.rlike(p) for p in patterns], F.lit(False))


def flows_of(edges: DataFrame) -> DataFrame:
    """(host, kind, to, share): what a host passes on of its rank of each kind, and to whom."""
    out, into = edges.groupBy("src").agg(F.sum("weight").alias("w")), edges.groupBy("dst").agg(F.sum("weight").alias("w"))
    forward = edges.join(out, "src").select(F.col("src").alias("host"), F.lit("trust").alias("kind"), F.col("dst").alias("to"), (F.col("weight") / F.col("w")).alias("share"))
    back = edges.join(into, "dst").select(F.col("dst").alias("host"), F.lit("distrust").alias("kind"), F.col("src").alias("to"), (F.col("weight") / F.col("w")).alias("share"))
    return forward.unionByName(back)


def in_a_task(made: DataFrame, seeds: DataFrame, rounds: int) -> DataFrame:
    """(host, kind, rank) after all rounds, made by one task."""
    ship(made.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("url_trust")
        if not (held := list(batches)):
            return
        rows = pa.Table.from_batches(held)
        for kind in pc.unique(rows["kind"]):
            own = rows.filter(pc.equal(rows["kind"], kind))
            seed, flow = own.filter(pc.is_null(own["to"])), own.filter(pc.is_valid(own["to"]))
            names = pa.chunked_array([*seed["host"].chunks, *flow["host"].chunks, *flow["to"].chunks], rows["host"].type).combine_chunks().dictionary_encode()
            start, src, dst = np.split(names.indices.to_numpy(), np.cumsum([seed.num_rows, flow.num_rows]))
            share, rank = flow["share"].to_numpy(), np.zeros(len(names.dictionary))
            rank[start] = seed["share"].to_numpy()
            base = rank * (1 - DAMPING)
            for _ in range(rounds):
                rank = np.bincount(dst, rank[src] * share * DAMPING, len(rank)) + base
            met = pa.array(rank > 0)
            yield pa.RecordBatch.from_arrays([names.dictionary.filter(met), pa.repeat(kind, met.true_count), pa.array(rank).filter(met)], ["host", "kind", "rank"])

    rows = made.unionByName(seeds.select("host", "kind", F.lit(None).cast("string").alias("to"), F.col("rank").alias("share")))
    return saved(rows.coalesce(1).mapInArrow(run, "host string, kind string, rank double"), "trust-rank")


def in_rounds(made: DataFrame, seeds: DataFrame, rounds: int) -> DataFrame:
    """(host, kind, rank) after all rounds, each a query of its own."""
    # hosts of very many links (a row for HOT_LINKS of them at most) have theirs spread, and their ranks are sent there
    hot = saved(made.groupBy("host", "kind").count().where(F.col("count") > HOT_LINKS).select("host", "kind"), "trust-hot")
    some = hot.count() > 0
    heavy = made.join(F.broadcast(hot), ["host", "kind"]).repartition("to").persist() if some else None
    flows = (made.join(F.broadcast(hot), ["host", "kind"], "left_anti") if some else made).repartition("host").persist()  # lost parts are read again from the table
    base, rank = seeds.withColumn("rank", F.col("rank") * (1 - DAMPING)), seeds
    for i in range(rounds):
        met = rank.join(flows, ["host", "kind"])
        if heavy is not None:
            met = met.unionByName(heavy.join(F.broadcast(rank.join(F.broadcast(hot), ["host", "kind"])), ["host", "kind"]).select(*met.columns))
        pushed = met.select(F.col("to").alias("host"), "kind", (F.col("rank") * F.col("share") * DAMPING).alias("rank"))
        new = saved(pushed.unionByName(base).groupBy("host", "kind").agg(F.sum("rank").alias("rank")), "trust-rank")
        if i:
            forget(rank)
        rank = new
    for t in (flows, heavy):
        if t is not None:
            t.unpersist()
    forget(hot)
    return rank


def propagate(edges: DataFrame, hosts: DataFrame, trusted: tuple[str, ...] = TRUSTED, blocked: tuple[str, ...] = BLOCKED, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust); ``hosts`` are those of pages besides those of edges."""
    edges = saved(edges, "trust-edges")
    made = saved(flows_of(edges), "trust-flows")
    every = hosts.select("host").unionByName(edges.select(F.col("src").alias("host"))).unionByName(edges.select(F.col("dst").alias("host"))).where("host is not null").distinct()
    bad = matches(F.col("host"), blocked)
    kind = F.when(bad, "distrust").when(matches(F.col("host"), trusted), "trust")
    seeds = every.withColumn("kind", kind).where("kind is not null")
    sizes = seeds.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    seeds = saved(seeds.join(F.broadcast(sizes), "kind").select("host", "kind", (1 / F.col("n")).alias("rank")), "trust-seeds")
    rows = made.select("host", "to").unionByName(seeds.select("host", F.lit("").alias("to")))
    size = rows.agg(F.sum(F.octet_length("host") + F.octet_length("to") + ROW)).first()[0] or 0
    rank = (in_a_task if size <= TASK_BYTES else in_rounds)(made, seeds, rounds)
    total = rank.groupBy("kind").agg(F.sum("rank").alias("total"))
    scaled = rank.join(F.broadcast(total), "kind").withColumn("rank", F.col("rank") / F.col("total"))
    wide = scaled.groupBy("host").agg(*[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("rank"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust")])
    out = saved(every.join(wide, "host", "left").fillna(0.0, ["trust", "distrust"]), "trust-hosts")
    forget(edges, made, seeds, rank)
    return out


def url_filter(pages: DataFrame, trusted: tuple[str, ...] = TRUSTED, blocked: tuple[str, ...] = BLOCKED, rounds: int = ROUNDS) -> DataFrame:
    """(page_id, url, host, trust, distrust, allowed) of every page."""
    placed = pages.select("page_id", "url", host_of(F.col("url")).alias("host"))
    hosts = propagate(host_edges(pages.select("url", "html")), placed.select("host").distinct(), trusted, blocked, rounds)
    side = F.broadcast(hosts) if hosts.count() <= BROADCAST_HOSTS else hosts
    return placed.join(side, "host", "left").select("page_id", "url", "host", "trust", "distrust", F.coalesce(F.col("distrust") <= BALANCE * F.col("trust"), F.lit(True)).alias("allowed"))
