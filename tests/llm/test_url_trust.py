from __future__ import annotations

import re
from collections import defaultdict

from lakeloom.llm import queries, url_trust as U
from tests.conftest import SF


def host(url):
    m = re.match(U.HOST, url or "")
    return (m[1].lower().rstrip(".") or None) if m else None


def brute(pages, trusted=U.TRUSTED, blocked=U.BLOCKED, rounds=U.ROUNDS):
    """(trust, distrust) of every host by power iteration over a dictionary of edges."""
    weight, hosts = defaultdict(float), set()
    for url, html in pages:
        to = {host(x) for x in re.findall(f"(?i){U.LINK}", html or "")} - {None}
        h = host(url)
        if h:
            hosts |= {h} | to
            for t in to - {h}:
                weight[h, t] += 1
        hosts |= {h} - {None}
    kin = set()
    for h in hosts:
        p = h.split(".")
        for i in range(max(len(p) - 2, 0)):
            low, high = ".".join(p[i:]), ".".join(p[i + 1 :])
            if not re.fullmatch(r"[0-9.]+", low):
                kin |= {(low, high), (high, low)}
    for e in kin:
        weight[e] += U.AFFILIATION
    hosts |= {x for e in weight for x in e}
    bad = {h for h in hosts if any(re.search(p, h) for p in blocked)}
    good = {h for h in hosts if any(re.search(p, h) for p in trusted)} - bad

    def rank(seeds, edges):
        if not seeds:
            return dict.fromkeys(hosts, 0.0)
        out = defaultdict(float)
        for (a, _), w in edges.items():
            out[a] += w
        base = {s: 1 / len(seeds) for s in seeds}
        r = dict(base)
        for _ in range(rounds):
            n = defaultdict(float, {s: x * (1 - U.DAMPING) for s, x in base.items()})
            for (a, b), w in edges.items():
                if a in r:
                    n[b] += r[a] * w / out[a] * U.DAMPING
            r = n
        z = sum(r.values())
        return {h: r.get(h, 0.0) / z for h in hosts}

    t, d = rank(good, weight), rank(bad, {(b, a): w for (a, b), w in weight.items()})
    return {h: (t[h], d[h]) for h in hosts}


def test_whole_table(spark):
    table = spark.read.parquet(f"{SF}/pages.parquet").collect()
    want = brute([(r["url"], r["html"]) for r in table])
    got = queries.op2_url_trust(spark, SF).collect()
    assert len(got) == len(table)
    for r in got:
        t, d = want[host(r["url"])]
        assert r["host"] == host(r["url"]) and abs(r["trust"] - t) < 1e-12 and abs(r["distrust"] - d) < 1e-12
        assert r["allowed"] == (r["distrust"] <= U.BALANCE * r["trust"])


def test_defined_results(spark):
    link = '<p><a class="x" href="https://spam.test/a">x</a> <A HREF=\'//Good.ORG./\'>y</A></p>'
    rows = [(1, "http://site.example/", link), (2, None, link), (3, "not a url", link), (4, "https://spam.test/b", None), (5, "https://good.org/x", ""), (5, "https://good.org/x", ""), (None, "http://u:p@a.b.far.example:80/q?z#f", "<a " + "x " * 50_000 + ">")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS trust", "3 AS kind", "4 AS src")
    got = U.url_filter(df, (r"\.org$",), (r"^spam\.",)).collect()
    by = {r["page_id"]: r for r in got}
    assert len(got) == len(rows)
    assert by[None]["host"] == "a.b.far.example"
    assert by[2]["host"] is by[2]["trust"] is by[3]["host"] is None and by[2]["allowed"] and by[3]["allowed"]
    assert not by[4]["allowed"] and by[4]["distrust"] > 0 and by[5]["allowed"] and by[5]["trust"] > 0
    want = brute([(r[1], r[2]) for r in rows], (r"\.org$",), (r"^spam\.",))
    for r in got:
        if r["host"]:
            assert abs(r["trust"] - want[r["host"]][0]) < 1e-12 and abs(r["distrust"] - want[r["host"]][1]) < 1e-12
    assert all(r["allowed"] for r in U.url_filter(df, (), ()).collect())
    assert U.url_filter(df.limit(0)).count() == 0


def test_rounds_reach_the_fixed_point(spark):
    """Against the solution of the linear equations: no more than TOLERANCE of the weight is missing; a long chain has its end reached."""
    import numpy as np

    n = 60
    rows = [(i, f"https://h{i}.example{i}.test/", f'<a href="https://h{i + 1}.example{i + 1}.test/">x</a>') for i in range(n)] + [(n, "https://start.org/", '<a href="https://h0.example0.test/">x</a>')]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    edges = {(r["src"], r["dst"]): r["weight"] for r in U.host_edges(df.select("url", "html")).collect()}
    hosts = sorted({h for e in edges for h in e})
    at = {h: i for i, h in enumerate(hosts)}
    m = np.zeros((len(hosts), len(hosts)))
    for (a, b), w in edges.items():
        m[at[b], at[a]] = w
    m /= np.maximum(m.sum(0), 1e-300)
    base = np.zeros(len(hosts))
    base[at["start.org"]] = 1 - U.DAMPING
    want = np.linalg.solve(np.eye(len(hosts)) - U.DAMPING * m, base)
    want /= want.sum()
    got = {r["host"]: r["trust"] for r in U.url_filter(df, (r"\.org$",), (r"^spam",)).collect()}
    assert sum(abs(got[h] - want[at[h]]) for h in got) < 3 * U.TOLERANCE and got["h30.example30.test"] > 0


def test_hosts_of_very_many_links(spark, monkeypatch):
    """Hosts with more links than HOT_LINKS have theirs spread; nothing changes."""
    links = "".join(f'<a href="https://t{i}.test/">x</a>' for i in range(30))
    rows = [(1, "https://hub.org/", links), (2, "https://t3.test/", '<a href="https://t4.test/">x</a><a href="https://blog.x.test/">y</a>'), (3, "https://t4.test/", '<a href="https://hub.org/">x</a>')]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    run = lambda: {r["host"]: (r["trust"], r["distrust"]) for r in U.url_filter(df, rounds=12).collect()}
    want = run()
    monkeypatch.setattr(U, "HOT_LINKS", 5)
    got = run()
    assert want["hub.org"][0] > 0 and all(abs(a - b) < 1e-15 for h in want for a, b in zip(want[h], got[h], strict=True))


def graph(spark, n=40):
    """Pages with hubs, a ring, hosts without links and some seeds of both kinds."""
    rows = [(i, f"https://h{i}.{('org', 'test')[i % 7 > 0]}/", "".join(f'<a href="https://h{j % n}.{("org", "test")[j % n % 7 > 0]}/">x</a>' for j in (i + 1, i * i, 3))) for i in range(n)]
    rows += [(n, "https://blog.x.test/", '<a href="https://h5.test/">x</a>'), (n + 1, "https://h4.test/", '<a href="https://blog.x.test/">x</a>'), (n + 2, "https://alone.test/", None)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_one_task_and_rounds_agree(spark, monkeypatch):
    """A graph that fits a task, and the same by a query a round, with and without hosts of very many links."""
    df = graph(spark)
    want = brute([(r["url"], r["html"]) for r in df.collect()], rounds=6)
    assert sum(t > 0 for t, _ in want.values()) > 20 and sum(d > 0 for _, d in want.values()) > 20 and want["alone.test"] == (0, 0)
    for task, hot in ((U.TASK_BYTES, U.HOT_LINKS), (-1, U.HOT_LINKS), (-1, 5)):
        monkeypatch.setattr(U, "TASK_BYTES", task)
        monkeypatch.setattr(U, "HOT_LINKS", hot)
        got = {r["host"]: (r["trust"], r["distrust"]) for r in U.url_filter(df, rounds=6).collect()}
        assert len(got) == 42 and all(abs(a - b) < 1e-14 for h in got for a, b in zip(got[h], want[h], strict=True))
    monkeypatch.setattr(U, "HOT_LINKS", 1_000_000)
    assert U.url_filter(df.limit(0)).count() == 0 and all(r["allowed"] for r in U.url_filter(df, (), (), 2).collect())


def largest_plan(spark, do):
    """Characters of the largest physical plan of the queries that ``do`` runs."""
    bus, store = spark.sparkContext._jsc.sc().listenerBus(), spark._jsparkSession.sharedState().statusStore()
    plans = lambda: {x.executionId(): len(x.physicalPlanDescription()) for x in (store.executionsList().apply(i) for i in range(store.executionsList().size()))}
    bus.waitUntilEmpty(30_000)
    before = plans()
    do()
    bus.waitUntilEmpty(30_000)
    return max(n for k, n in plans().items() if k not in before)


def test_plans_dont_grow_with_rounds(spark, monkeypatch):
    """The driver's memory goes with the largest plan: no query holds several rounds."""
    df = graph(spark, 10)
    edges, hosts = U.host_edges(df.select("url", "html")).persist(), df.select(U.host_of(df["url"]).alias("host"))
    edges.count()
    for task in (U.TASK_BYTES, -1):
        monkeypatch.setattr(U, "TASK_BYTES", task, raising=False)
        sizes = [largest_plan(spark, lambda n=n: U.propagate(edges, hosts, rounds=n).count()) for n in (1, 8)]
        assert sizes[1] < 1.2 * sizes[0], sizes
    edges.unpersist()
