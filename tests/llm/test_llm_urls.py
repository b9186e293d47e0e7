import random

from loglens.llm import url_filter as U

HOSTS = ["a.example.org", "example.org", "b.example.com", "x.co.uk", "deep.sub.x.co.uk", "notexample.org", "EXAMPLE.net", "m.free.net", "org"]


def pages(n=300, seed=1):
    rng = random.Random(seed)
    urls = [None, "", "no scheme", "http://", "http://org", "http://org/", "ftp://Example.ORG/es/1?x=/en/", "http://com/fr/", "x://a://b/c",
            "https://a.example.org/en/1#f", "https://a.example.org/en/2", "http://example.org?q", "//example.org/es/", "http://fr.com/de/9"]
    for _ in range(n):
        host = "hot.host.net" if rng.random() < 0.4 else rng.choice(HOSTS)
        urls.append(f"http://{host}/{rng.choice(['en', 'es', 'fr'])}/{rng.randrange(400)}{rng.choice(['', '?a=b', '#top', '.html'])}")
    return [(i, u, "<p>") for i, u in enumerate(urls)] + [(3, "http://q.net/en/5", None)] * 2


def labels(seed=2):
    rng = random.Random(seed)
    return [(i, int(rng.random() < 0.6), int(rng.random() < 0.2)) for i in range(400) if rng.random() < 0.7] + [(5, None, None), (6, 1, None)]


def frames(spark, p, q):
    return (spark.createDataFrame(p, "page_id long, url string, html string"), spark.createDataFrame(q, "doc_id long, quality int, toxic int"))


def test_query_equals_its_sql(spark, table_dir, twin):
    p, q = frames(spark, pages(), labels())
    ours, theirs = twin(U, "op3_url_reputation", table_dir(pages=p.repartition(3), labels=q))
    assert ours == theirs
    assert {r[4] for r in ours} == {"allow", "block"}


def test_without_labels_and_without_pages(spark, table_dir, twin):
    p, q = frames(spark, pages(5), [])
    ours, theirs = twin(U, "op3_url_reputation", table_dir(pages=p, labels=q))
    assert ours == theirs
    p, q = frames(spark, [], labels())
    ours, theirs = twin(U, "op3_url_reputation", table_dir(pages=p, labels=q))
    assert ours == theirs == []


def test_rules(spark):
    cases = {"http://sub.example.org/es/9": ("example.org/es/", "block"), "http://sub.example.org/en/12": ("example.org/en/1", "block"),
             "http://sub.example.org/en/2": ("org/", "allow"), "http://x.com/fr/1": ("com/fr/", "allow"), "http://x.com/de/": ("com/de/", "block"),
             "http://xcom/de/": None, "http://x.org": None}
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(cases)], "page_id long, url string, host string")
    got = {r.page_id: r for r in U.filter_urls(df, spark.createDataFrame([], "host string, good int")).collect()}
    for i, want in enumerate(cases.values()):
        assert (got[i].rule, got[i].verdict) == want if want else got[i].rule is None


def test_sparse_hosts_shrink_towards_their_domain(spark):
    rows = [("a.good.net", 1)] * 60 + [("b.good.net", 0)] + [("a.bad.net", 0)] * 60 + [("b.bad.net", 1)] + [("c.bad.net", None)]
    got = {r.host: r for r in U.host_reputation(spark.createDataFrame(rows, "host string, good int")).collect()}
    assert got["a.good.net"].mean > got["b.good.net"].mean > 0.2   # one bad page in a good domain
    assert got["a.bad.net"].mean < got["b.bad.net"].mean < 0.8     # one good page in a bad one
    assert got["a.bad.net"].mean < got["c.bad.net"].mean < got["b.bad.net"].mean
    assert all(r.lower < r.mean for r in got.values())


def test_plan_is_native(spark, table_dir):
    p, q = frames(spark, pages(20), labels())
    df = U.QUERIES["op3_url_reputation"](spark, table_dir(pages=p, labels=q))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))
