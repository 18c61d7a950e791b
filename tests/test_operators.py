"""Merge, running totals, robots, frontier, schedules and streams."""

import datetime
import itertools
import random
import shutil

import pytest
from pyspark.sql import functions as F

from pageloom.operators import extract as E
from pageloom.operators import frontier as FR
from pageloom.operators import merge as M
from pageloom.operators import pages as P
from pageloom.operators import quality as Q
from pageloom.operators import robots as RB
from pageloom.operators import running as R
from pageloom.operators import schedule as SC
from pageloom.operators.snapshot import SnapshotTable, upsert_latest
from pageloom.plans import all_queries
from pageloom.sources import sitemap as SM
from pageloom.streaming import pages as ST


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def counts(merged):
    return tuple(merged.counts.first())


UPSERT = [M.when_matched_update(), M.when_not_matched_insert()]


def test_merge_inserts_and_updates(spark):
    target = spark.createDataFrame([("existing", "Existing")], "url string, title string")
    source = spark.createDataFrame([("existing", "Updated"), ("new", "New")], "url string, title string")
    merged = M.merge(target, source, "url", UPSERT)
    assert rows(merged.snapshot) == [("existing", "Updated"), ("new", "New")]
    assert counts(merged) == (1, 1, 0)
    only_update = M.merge(target, source, "url", UPSERT[:1])
    assert rows(only_update.snapshot) == [("existing", "Updated")]
    only_insert = M.merge(target.limit(0), source, "url", UPSERT[1:])
    assert counts(only_insert) == (2, 0, 0)


def test_merge_deletes_matched(spark):
    target = spark.createDataFrame([(1, "active"), (2, "inactive"), (3, "active")], "id int, status string")
    source = spark.createDataFrame([(2, "inactive")], "id int, status string")
    merged = M.merge(target, source, "id", [M.when_matched_delete()])
    assert rows(merged.snapshot) == [(1, "active"), (3, "active")]
    assert counts(merged) == (0, 0, 1)


def test_merge_updates_only_stale_rows(spark):
    day = datetime.datetime
    target = spark.createDataFrame(
        [("stale", 10, day(2024, 1, 1)), ("fresh", 20, day(2024, 6, 1)), ("unknown", 30, None)],
        "url string, value int, updated_at timestamp",
    )
    source = spark.createDataFrame([("stale", 100), ("fresh", 200), ("unknown", 300)], "url string, value int")
    old = "timestamp'2024-06-01 12:00:00' - t.updated_at > interval 1 day"
    merged = M.merge(target, source, "url", [M.when_matched_update(old)])
    assert rows(merged.snapshot.select("url", "value")) == [("fresh", 20), ("stale", 100), ("unknown", 30)]
    kept = M.without_fresh(source, target, "url", old)
    assert rows(kept.select("url")) == [("stale",)]


def test_merge_by_source(spark):
    target = spark.createDataFrame(
        [("new", "x", False), ("archived", "x", True), ("old", "x", False)], "url string, status string, is_archived boolean"
    )
    source = spark.createDataFrame([("new", "active")], "url string, status string")
    soft = M.when_not_matched_by_source_update({"status": "'removed'"}, "not t.is_archived")
    merged = M.merge(target, source, "url", [M.when_matched_update(), soft])
    assert rows(merged.snapshot) == [("archived", "x", True), ("new", "active", False), ("old", "removed", False)]
    hard = M.merge(target, source, "url", [M.when_not_matched_by_source_delete()])
    assert rows(hard.snapshot) == [("new", "x", False)]
    assert counts(hard) == (0, 0, 2)


def test_merge_rejects_or_orders_repeated_keys(spark):
    target = spark.createDataFrame([], "k int, v int")
    source = spark.createDataFrame([(1, 1), (1, 2), (None, 3), (None, 4)], "k int, v int")
    with pytest.raises(Exception, match="repeats a key"):
        M.merge(target, source, "k", UPSERT).snapshot.collect()
    merged = M.merge(target, source, "k", UPSERT, order_by="v")
    assert rows(merged.snapshot) == [(1, 2), (None, 3), (None, 4)]


def test_merge_limit_counts_changes_only(spark):
    target = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (9, 9)], "k int, v int")
    source = spark.createDataFrame([(1, 1), (2, 5), (3, 6), (4, 4), (5, 5)], "k int, v int")
    clauses = [M.when_matched_update("s.v <> t.v"), M.when_not_matched_insert(), M.when_not_matched_by_source_delete()]
    for limit, expected in [
        (0, [(1, 1), (2, 2), (3, 3)]),
        (1, [(1, 1), (2, 5), (3, 3)]),
        (3, [(1, 1), (2, 5), (3, 6), (4, 4)]),
        (99, [(1, 1), (2, 5), (3, 6), (4, 4), (5, 5)]),
    ]:
        merged = M.merge(target, source, "k", clauses, order_by="k", limit=limit)
        assert rows(merged.snapshot) == expected
    with pytest.raises(ValueError):
        M.merge(target, source, "k", clauses, limit=1)


def test_merge_laws(spark):
    chance = random.Random(5)
    for _ in range(3):
        target = spark.createDataFrame([(k, chance.randint(0, 3)) for k in range(0, 40, 2)], "k int, v int")
        source = spark.createDataFrame([(k, chance.randint(0, 3)) for k in range(0, 40, 3)], "k int, v int")
        clauses = [M.when_matched_update("s.v <> t.v"), M.when_not_matched_insert(), M.when_not_matched_by_source_delete("t.v = 0")]
        once = M.merge(target, source, "k", clauses)
        twice = M.merge(once.snapshot, source, "k", clauses)
        assert rows(twice.snapshot) == rows(once.snapshot)
        assert counts(twice) == (0, 0, 0)
        inserted, _, deleted = counts(once)
        assert once.snapshot.count() == target.count() + inserted - deleted
        again = M.merge(target.repartition(7), source.repartition(5), "k", clauses)
        assert rows(again.snapshot) == rows(once.snapshot)


def test_snapshot_versions(spark, tmp_path):
    store = SnapshotTable(spark, str(tmp_path / "s"))
    assert store.read() is None
    assert store.commit(spark.range(0), if_not_empty=True) == 1 and store.versions() == []
    store.commit(spark.range(3))
    store.commit(spark.range(5))
    assert store.versions() == [1, 2] and store.read().count() == 5 and store.read(1).count() == 3
    store.commit(spark.range(9), version=2)
    assert store.read().count() == 5


def skewed(spark, n=600):
    chance = random.Random(3)
    data = [("hot" if i % 3 else f"k{i % 7}", i, chance.randint(0, 9)) for i in range(n)]
    chance.shuffle(data)
    return data, spark.createDataFrame(data, "k string, seq long, v long")


@pytest.mark.parametrize("hot_rows", [50, 10_000])
def test_running_totals_with_hot_keys(spark, hot_rows):
    data, frame = skewed(spark)
    got = R.running(frame, ["k"], "seq", sums={"s": F.col("v")}, maxes={"m": F.col("v")}, hot_rows=hot_rows, slots=8)
    expected = []
    for key, group in itertools.groupby(sorted(data), key=lambda r: r[0]):
        total, top = 0, 0
        for _, seq, v in group:
            total, top = total + v, max(top, v)
            expected.append((key, seq, v, total, top))
    assert rows(got) == sorted(expected, key=repr)
    numbered = R.number_rows(frame, ["k"], "seq", hot_rows=hot_rows, slots=8)
    assert numbered.filter("k = 'hot'").agg(F.max("rn")).first()[0] == sum(r[0] == "hot" for r in data)


@pytest.mark.parametrize("hot_rows", [50, 10_000])
def test_previous_value_with_hot_keys(spark, hot_rows):
    data, frame = skewed(spark)
    got = R.previous_value(frame, ["k"], "seq", "v", "prev", hot_rows=hot_rows, slots=8)
    expected = []
    for key, group in itertools.groupby(sorted(data), key=lambda r: r[0]):
        before = None
        for _, seq, v in group:
            expected.append((key, seq, v, before))
            before = v
    assert rows(got) == sorted(expected, key=repr)


def test_adaptive_delay_equals_the_fold(spark):
    chance = random.Random(11)
    data = [("hot" if i % 4 else "other", i, chance.choice([100, 120, 90, 1000, 10])) for i in range(12_000)]
    frame = spark.createDataFrame(data, "domain string, seq long, ms long")
    got = SC.adaptive_delays(frame, hot_rows=1000, slots=4)
    delays = {(r.domain, r.seq): r.delay for r in got.collect()}
    for domain in ("hot", "other"):
        mine = [(s, ms) for d, s, ms in data if d == domain]
        expected = SC.folded_delays([ms for _, ms in mine], 1.0, 0.5, 60.0)
        assert [delays[domain, s] for s, _ in mine] == pytest.approx(expected)
    assert len(delays) == len(data)


def test_backoff_sequence(spark):
    frame = spark.range(12).select(SC.backoff_seconds(F.col("id"), 300).alias("s"))
    assert [r.s for r in frame.orderBy("s").collect()] == [3, 3, 6, 9, 15, 24, 39, 63, 102, 165, 267, 300]


ROBOTS = """User-agent: a
User-agent: Good
Disallow: /private
Allow: /private/open
Disallow: /*.pdf$
Disallow: /x*y
Crawl-delay: 7
Sitemap: https://h/s.xml

# comment
User-agent: *
Disallow: /
Crawl-delay: 2
Request-rate: 1/5
"""


@pytest.mark.parametrize(
    ("agent", "path", "allowed"),
    [
        ("Good/2.0", "/private/a", False),
        ("Good/2.0", "/private/open/a", True),
        ("Good/2.0", "/a.pdf", False),
        ("Good/2.0", "/a.pdf?x", True),
        ("Good/2.0", "/x/abc/y/z", False),
        ("Good/2.0", "/xa", True),
        ("a", "/private/a", True),
        ("other", "/anything", False),
    ],
)
def test_robots_verdicts(spark, agent, path, allowed):
    robots = spark.createDataFrame([("h", ROBOTS)], "host string, body string")
    urls = spark.createDataFrame([(f"https://h{path}",)], "url string")
    assert RB.with_verdict(urls, robots, agent).first()["allowed"] is allowed


def test_robots_defaults(spark):
    robots = spark.createDataFrame([("h", ROBOTS), ("empty", "")], "host string, body string")
    urls = spark.createDataFrame([("https://nowhere/x",), ("https://empty/x",), ("https://h/x",)], "url string")
    assert rows(RB.allowed_urls(urls, robots, "bot")) == [("https://empty/x",), ("https://nowhere/x",)]
    assert rows(RB.crawl_delay(robots, "Good")) == [("h", 7.0)]
    assert rows(RB.crawl_delay(robots, "zzz")) == [("h", 2.0)]
    assert rows(RB.sitemaps(robots)) == [("h", "https://h/s.xml")]
    star = RB.group_delays(robots).filter("agent = '*'").first()
    assert (star.crawl_delay, star.request_rate, star.effective_delay) == (2.0, 5.0, 5.0)
    start = spark.createDataFrame([("https://h/sitemap.xml",), ("https://q/sitemap.xml",)], "sitemap_url string")
    assert rows(SM.discovered_start(start, RB.sitemaps(robots))) == [("https://h/s.xml",), ("https://q/sitemap.xml",)]


def test_sitemap_cycles_end(spark):
    index = "<sitemapindex><sitemap><loc>{}</loc></sitemap><sitemap><loc>{}</loc></sitemap></sitemapindex>"
    leaf = (
        '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc> https://e/1 </loc><lastmod>2024-01-01</lastmod>'
        "<priority>0.8</priority></url><url><loc>https://e/2?a=1&amp;b=2</loc></url><url><lastmod>x</lastmod></url></urlset>"
    )
    documents = spark.createDataFrame(
        [("i", index.format("j", "leaf")), ("j", index.format("i", "leaf")), ("leaf", leaf), ("bad", "<<")],
        "sitemap_url string, xml string",
    )
    start = documents.filter("sitemap_url = 'i'")
    got = SM.read_sitemaps(start, documents)
    assert rows(got.select("url", "lastmod", "priority")) == [
        ("https://e/1", "2024-01-01", 0.8),
        ("https://e/2?a=1&b=2", None, None),
    ]
    assert SM.read_sitemaps(start, documents, recursive=False).count() == 0
    assert SM.read_sitemaps(start, documents, max_depth=0).count() == 0


def test_frontier_depths(spark):
    edges = spark.createDataFrame(
        [("a", "b", False), ("b", "c", False), ("c", "a", False), ("c", "d", True), ("d", "e", False), ("a", "a", False)],
        "src_url string, dst_url string, nofollow boolean",
    )
    seeds = spark.createDataFrame([("a",), ("",)], "url string")
    assert rows(FR.follow(edges, seeds, 10)) == [("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5)]
    assert rows(FR.follow(edges, seeds, 2)) == [("a", 1), ("b", 2)]
    assert rows(FR.follow(edges, seeds, 9, skip_nofollow=True)) == [("a", 1), ("b", 2), ("c", 3)]
    only = spark.createDataFrame([("a",)], "url string")
    assert rows(FR.follow(edges, seeds, 9, expandable=only)) == [("a", 1), ("b", 2)]


def test_near_names_equal_brute_force(spark):
    chance = random.Random(2)
    names = {"".join(chance.choice("ab ") for _ in range(chance.randint(1, 6))) for _ in range(60)}
    frame = spark.createDataFrame([(i % 2, n) for i, n in enumerate(sorted(names) * 2)], "b int, name string")

    def distance(a, b):
        line = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            left, line[0] = line[0], i
            for j, y in enumerate(b, 1):
                left, line[j] = line[j], min(line[j] + 1, line[j - 1] + 1, left + (x != y))
        return line[-1]

    plain = rows(frame.select("b", Q.plain_name(F.col("name")).alias("n")).distinct())
    expected = {(b, x, y) for b, x in plain for c, y in plain if b == c and x < y and distance(x, y) <= 1}
    assert set(rows(Q.near_names(frame, ["b"], "name"))) == expected


def test_similar_names_equal_brute_force(spark):
    chance = random.Random(5)
    names = set()
    for n in (9, 10, 11, 12, 20, 21, 22, 30, 31, 32, 45, 61):
        for _ in range(3):
            base = [chance.choice("abcd ") for _ in range(n)]
            names.add("".join(base))
            for _ in range(9):
                own = list(base)
                for _ in range(chance.randint(1, 1 + n // 10)):
                    k = chance.randrange(len(own))
                    own[k : k + chance.randint(0, 1)] = [chance.choice("abcd ")] * chance.randint(0, 1)
                names.add("".join(own))
    frame = spark.createDataFrame([(i % 2, i % 3 and 1, n) for i, n in enumerate(sorted(names) * 3)] + [(None, 1, "x" * 30), (0, 1, None)], "b int, w int, name string")

    def distance(a, b):
        line = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            left, line[0] = line[0], i
            for j, y in enumerate(b, 1):
                left, line[j] = line[j], min(line[j] + 1, line[j - 1] + 1, left + (x != y))
        return line[-1]

    plain = rows(frame.select("b", "w", Q.plain_name(F.col("name")).alias("n")).dropna().distinct())
    expected = {(b, w, x, y) for b, w, x in plain for c, v, y in plain if (b, w) == (c, v) and x < y and 10 * distance(x, y) < max(len(x), len(y))}
    assert any(distance(x, y) > 2 for *_, x, y in expected)
    found = rows(Q.similar_names(frame, ["b", "w"], "name"))
    assert set(found) == expected and len(found) == len(expected)


def test_each_element_and_required(spark):
    html = '<div class=card data-id=1><b>x</b></div><div class=card><b>y</b><b>z</b></div><p>n</p>'
    page = spark.createDataFrame([(1, html)], "id int, html string")
    parts = {"key": ("", "attr:data-id"), "name": ("b", "text"), "none": ("i", "text")}
    assert rows(E.each_element(page, "div.card", parts, ["id"])) == [(1, 0, "1", "x", None), (1, 1, None, "y", None)]


def test_stream_equals_batch_over_many_files(spark, tmp_path):
    source = str(tmp_path / "in")
    for part in range(4):
        spark.range(part * 5, part * 5 + 10).select(
            (F.col("id") % 7).alias("k"), (F.col("id") + part * 100).alias("v")
        ).coalesce(1).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema
    clauses = [M.when_matched_update("s.v > t.v"), M.when_not_matched_insert()]
    table = SnapshotTable(spark, str(tmp_path / "out"))
    handle = ST.merge_updates(table, "k", clauses, order_by="v")
    ST.each_batch(ST.stream_files(spark, source, schema, 1), handle, str(tmp_path / "state"))
    expected = rows(spark.read.parquet(source).groupBy("k").agg(F.max("v")))
    assert table.versions() == [1, 2, 3, 4]
    assert rows(table.read()) == expected
    # The same batch again leaves the table as it is.
    handle(spark.read.parquet(source), 3)
    assert rows(table.read()) == expected

    cache = SnapshotTable(spark, str(tmp_path / "cache"))
    ST.each_batch(ST.stream_files(spark, source, schema, 1), ST.cache_updates(cache, ["k"], "v"), str(tmp_path / "state2"))
    assert rows(cache.read()) == expected


def test_stream_of_delays_keeps_state(spark, tmp_path):
    source = str(tmp_path / "in")
    chance = random.Random(4)
    data = [("d", i, chance.choice([100, 1000, 10])) for i in range(60)]
    for start in range(0, 60, 20):
        spark.createDataFrame(data[start : start + 20], "domain string, seq long, ms long").coalesce(1).write.mode(
            "append"
        ).parquet(f"{source}/p{start:03}")
    schema = spark.read.parquet(f"{source}/p000").schema
    stream = ST.stream_files(spark, f"{source}/*", schema, 1)
    out = str(tmp_path / "out")
    ST.append_available(ST.adaptive_delay_stream(stream), out, str(tmp_path / "state"))
    got = spark.read.parquet(out).orderBy("seq").collect()
    assert [r.delay for r in got] == pytest.approx(SC.folded_delays([ms for _, _, ms in data], 1.0, 0.5, 60.0))


@pytest.mark.parametrize("hot_rows", [3, 1000])
def test_lookup_of_hot_and_missing_urls(spark, hot_rows):
    store = spark.createDataFrame(
        [("a", 200, "text/html", "A", "", 1), ("b", 500, "", None, "boom", 2)],
        "url string, status int, content_type string, body string, error string, response_time_ms long",
    )
    asked = [("a", i) for i in range(20)] + [("b", 20), ("c", 21), (None, 22), (None, 23), ("", 24)]
    seeds = spark.createDataFrame(asked, "url string, n int")
    got = P.lookup_each(seeds, store, hot_rows=hot_rows, salts=4).select("n", "url", "status", "body", "error")
    expected = [(i, "a", 200, "A", None) for i in range(20)]
    expected += [(20, "b", 500, None, "boom"), (21, "c", None, None, "not_captured")]
    expected += [(22, None, None, None, "NULL URL"), (23, None, None, None, "NULL URL")]
    assert rows(got) == sorted(expected, key=repr)


def test_gzipped_documents(spark, tmp_path):
    import gzip

    (tmp_path / "in").mkdir()
    xml = "<urlset><url><loc>https://e/1</loc></url></urlset>"
    (tmp_path / "in" / "a.xml.gz").write_bytes(gzip.compress(xml.encode()))
    (tmp_path / "in" / "b.xml").write_text(xml)
    path = str(tmp_path / "in")
    assert [r.url for r in SM.entries(SM.read_documents(spark, path)).collect()] == ["https://e/1"] * 2
    assert sorted(r.gzipped for r in SM.compressed_files(spark, path).collect()) == [False, True]


def test_copies_and_codes(spark):
    frame = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x"), (4, None)], "id long, f string")
    assert rows(Q.mark_copies(frame.dropna(), "id", "f")) == [(1, "x", 2, False), (2, "y", 1, False), (3, "x", 2, True)]
    assert rows(Q.same_code(frame, "id", "f").select("id", "entity")) == [(1, 1), (2, 2), (3, 1), (4, 4)]


def test_crawl_follows_successful_pages(spark):
    store = spark.createDataFrame(
        [
            ("https://e/a", 200, "text/html", '<nav><a href="/b">b</a></nav><a href="/c">c</a>', "", 1),
            ("https://e/b", 200, "text/html", '<a href="/d">d</a><a rel=nofollow href="/n">n</a>', "", 1),
            ("https://e/c", 404, "text/html", '<a href="/x">x</a>', "", 1),
        ],
        "url string, status int, content_type string, body string, error string, response_time_ms long",
    )
    seeds = spark.createDataFrame([("https://e/a",)], "url string")

    def depths(**options):
        return {r.url[-1]: r.depth for r in P.crawl(seeds, store, **options).collect()}

    assert depths() == {"a": 1}
    assert depths(max_depth=3) == {"a": 1, "b": 2, "c": 2, "d": 3, "n": 3}
    assert depths(max_depth=3, selector="nav a", skip_nofollow=False) == {"a": 1, "b": 2}
    assert depths(max_depth=3, skip_nofollow=True) == {"a": 1, "b": 2, "c": 2, "d": 3}
    assert depths(max_depth=3, max_results=2) == {"a": 1, "b": 2}
    assert depths(max_depth=2, state=seeds) == {"b": 2, "c": 2}


def odd_keyed(spark):
    """Null keys, null places, one outlier, equal rows but for a map, a hot key."""
    rows = [("hot", k, k % 7, {"n": str(k)}) for k in range(300)]
    rows += [("hot", 10**15, 5, {}), ("hot", None, 3, None)]
    rows += [(None, k, k % 5, {"n": "x"}) for k in range(120)] + [(None, None, 1, None)]
    rows += [(f"k{k % 9}", k, 2, {"m": str(k)}) for k in range(90)]
    return spark.createDataFrame(rows, "k string, seq long, v long, m map<string,string>").repartition(5, "v")


def test_hot_and_cold_paths_agree(spark):
    frame = odd_keyed(spark)
    seen = lambda df: sorted(repr(tuple(r)) for r in df.collect())
    for make in (
        lambda n: R.running(frame, ["k"], "seq", sums={"s": F.col("v")}, maxes={"x": F.col("v")}, hot_rows=n),
        lambda n: R.running(frame, ["k"], "seq", sums={"s": F.col("v")}, include_current=False, hot_rows=n),
        lambda n: R.number_rows(frame, ["k"], "seq", hot_rows=n),
        lambda n: R.previous_value(frame, ["k"], "seq", "v", "before", hot_rows=n),
    ):
        assert seen(make(1)) == seen(make(10**9))
    small = spark.createDataFrame([("hot", "a", {"p": "q"}), ("k1", "b", None), (None, "c", None)], "k string, name string, extra map<string,string>")
    for how in ("left", "inner"):
        assert seen(R.lookup(frame, small, "k", how, hot_rows=20, salts=4)) == seen(R.lookup(frame, small, "k", how, hot_rows=10**9))


def test_slots_follow_the_rows(spark):
    frame = spark.createDataFrame([("a", k) for k in range(2_000)] + [("a", 10**15)], "k string, seq long")
    cuts = R.hot_keys(frame, ["k"], 10, "seq", 8).first()["_cuts"]
    assert len(cuts) == 7 and cuts == sorted(cuts) and all(abs(c - 250 * (k + 1)) < 30 for k, c in enumerate(cuts))


def test_stream_of_delays_takes_shuffled_rows(spark, tmp_path):
    """Many Arrow pieces of one domain, in files whose rows lie in no order."""
    chance = random.Random(9)
    data = [("d", i, chance.choice([100, 1000, 10])) for i in range(3_000)]
    mixed = data.copy()
    chance.shuffle(mixed)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    frame = spark.createDataFrame(mixed, "domain string, seq long, ms long")
    frame.repartition(5).write.parquet(source)
    stream = ST.stream_files(spark, source, frame.schema, 100)
    ST.append_available(ST.adaptive_delay_stream(stream), out, str(tmp_path / "state"))
    got = spark.read.parquet(out).orderBy("seq").collect()
    wanted = SC.folded_delays([ms for _, _, ms in data], 1.0, 0.5, 60.0)
    assert [r.delay for r in got] == pytest.approx(wanted)
    batch = SC.adaptive_delays(frame, hot_rows=500).orderBy("seq").collect()
    assert [r.delay for r in batch] == pytest.approx(wanted)


def test_crawl_does_not_go_through_known_urls(spark):
    page = lambda target: f'<a href="https://h.example/{target}">x</a>'
    store = spark.createDataFrame(
        [(f"https://h.example/{u}", 200, "text/html", page(t), None, 5) for u, t in (("a", "b"), ("b", "c"), ("c", "d"), ("e", "c"))],
        "url string, status int, content_type string, body string, error string, response_time_ms long",
    )
    seeds = spark.createDataFrame([("https://h.example/a",)], "url string")
    state = spark.createDataFrame([("https://h.example/b",)], "url string")
    found = lambda **how: sorted((r.url[-1], r.depth) for r in P.crawl(seeds, store, 4, **how).collect())
    assert found() == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]
    assert found(state=state) == [("a", 1)]


def test_stream_of_pages_beside_robots_equals_batch(spark, tmp_path):
    pages = [(f"https://h{k % 4}.example/{'private' if k % 3 else 'open'}/{k}", 200, "text/html", f"<p>{k}</p>", None, 0) for k in range(60)]
    shape = "url string, status int, content_type string, body string, error string, response_time_ms long"
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(pages, shape).repartition(6).write.parquet(source)
    robots = spark.createDataFrame([(f"h{k}.example", "User-agent: *\nDisallow: /private\n") for k in (0, 2)], "host string, body string")
    ST.append_available(ST.finished_pages(ST.stream_files(spark, source, spark.read.parquet(source).schema, 2), robots), out, str(tmp_path / "state"))
    batch = ST.finished_pages(spark.read.parquet(source), robots)
    found = rows(spark.read.parquet(out).select(batch.columns))
    assert found == rows(batch) and 0 < len(found) < 60


@pytest.mark.parametrize("name", ["st01_finished_pages", "st01_finished_pages_with_robots", "st02_distinct_urls", "st05_adaptive_delay"])
def test_streams_read_tables_of_several_files(spark, sf, tmp_path, name):
    folder = str(tmp_path / "tables")
    for held in ("pages", "events"):
        spark.read.parquet(f"{sf}/{held}.parquet").limit(60).repartition(3).write.parquet(f"{folder}/{held}.parquet")
        spark.read.parquet(f"{folder}/{held}.parquet").coalesce(1).write.parquet(str(tmp_path / held))
        one = next((tmp_path / held).glob("part-*.parquet"))
        (tmp_path / "single").mkdir(exist_ok=True)
        shutil.copy(one, tmp_path / "single" / f"{held}.parquet")
    found = rows(all_queries()[name].build(spark, folder))
    assert found and found == rows(all_queries()[name].build(spark, str(tmp_path / "single")))


def test_delays_need_no_call_per_domain(spark, capsys):
    log = spark.range(3_000).select(F.concat(F.lit("d"), F.col("id") % 300).alias("domain"), F.col("id").alias("seq"), (F.col("id") * 7919 % 500).alias("ms"))
    found = SC.adaptive_delays(log)
    found.explain()
    assert "FlatMapGroups" not in capsys.readouterr().out
    for name in ("d0", "d299"):
        own = found.filter(F.col("domain") == name).orderBy("seq").collect()
        assert [r["delay"] for r in own] == pytest.approx(SC.folded_delays([r["ms"] for r in own], 1.0, 0.5, 60.0))


def test_lookups_are_planned_without_a_job(spark):
    status = spark.sparkContext.statusTracker()
    frame = spark.range(1_000).withColumn("k", F.col("id") % 7)
    small = spark.range(7).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    before = len(status.getJobIdsForGroup(None))
    R.lookup(frame, small, "k").explain()
    assert len(status.getJobIdsForGroup(None)) == before


def test_crawl_rules_hold_on_the_way(spark):
    store = spark.createDataFrame(
        [
            ("https://a.example/", 200, "text/html", '<a href="/x">1</a><a href="/y">2</a><a href="/z">3</a>', None, 0, "2024-01-10 00:00:00"),
            ("https://a.example/x", 200, "text/html", '<a href="/x2">1</a>', None, 0, "2024-01-10 00:00:00"),
            ("https://a.example/y", 200, "text/html", '<a href="/y2">1</a>', None, 0, "2024-01-01 00:00:00"),
            ("https://a.example/z", 200, "text/html", '<a href="/z2">1</a>' + " " * 100, None, 0, "2024-01-10 00:00:00"),
        ],
        "url string, status int, content_type string, body string, error string, response_time_ms long, cached_at string",
    ).withColumn("cached_at", F.col("cached_at").cast("timestamp"))
    seeds = spark.createDataFrame([("https://a.example/",), (None,), ("",)], "url string")
    robots = spark.createDataFrame([("a.example", "User-agent: *\nDisallow: /x\n"), (None, None)], "host string, body string")

    def found(**rules):
        return {r.url[18:]: (r.depth, r.status, r.error) for r in P.crawl(seeds, store, 3, **rules).collect()}

    plain = found()
    assert set(plain) == {"", "x", "y", "z", "x2", "y2", "z2"} and plain["z2"] == (3, None, "not_captured")
    barred = found(robots=robots)
    assert barred["x"] == (2, -1, "robots_disallowed") and set(barred) == {"", "x", "y", "z", "y2", "z2"}
    aged = found(as_of=F.lit("2024-01-10 12:00:00").cast("timestamp"), ttl_hours=24)
    assert aged["y"] == (2, None, "not_captured") and set(aged) == {"", "x", "y", "z", "x2", "z2"}
    sized = found(max_bytes=80)
    assert sized["z"] == (2, 200, "content_too_large") and set(sized) == {"", "x", "y", "z", "x2", "y2"}
    every = found(robots=robots, as_of=F.lit("2024-01-10 12:00:00").cast("timestamp"), max_bytes=80, max_results=4)
    assert set(every) == {"", "x", "y", "z"}
    assert P.crawl(seeds.limit(0), store, 3, robots=robots).count() == 0


def test_latest_entries_win_without_a_sort_of_bodies(spark):
    chance = random.Random(12)
    shape = "k string, part int, at timestamp, body string"

    def some(n):
        keys, days = [None, *"abcdef"], [None, *range(1, 6)]
        days = [d and datetime.datetime(2024, 1, d) for d in days]
        return [(chance.choice(keys), chance.randint(0, 1), chance.choice(days), chance.choice([None, "x", "y", "z"])) for _ in range(n)]

    old, new = some(60), some(60)
    found = upsert_latest(spark.createDataFrame(old, shape), spark.createDataFrame(new, shape), ["k", "part"], "at")
    wanted = {}
    for r in old + new:
        wanted[r[:2]] = max(wanted.get(r[:2], (False,)), (r[2] is not None, r[2] or 0)) if r[2] else wanted.get(r[:2], (False, 0))
    got = found.collect()
    assert len(got) == len(wanted) == len({r[:2] for r in got})
    assert all(tuple(r) in old + new and (r["at"] or 0) == wanted[(r["k"], r["part"])][1] for r in got)
    again = upsert_latest(spark.createDataFrame(new, shape), spark.createDataFrame(old, shape), ["k", "part"], "at")
    assert rows(again) == rows(found)
    assert upsert_latest(spark.createDataFrame([], shape), spark.createDataFrame([], shape), ["k"], "at").count() == 0
    bodies = spark.range(100).select(F.col("id").alias("k"), F.current_timestamp().alias("at"), F.lit("b").alias("body"))
    plan = upsert_latest(bodies, bodies, ["k"], "at")._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan


def test_nth_row_by_ranges(spark):
    chance = random.Random(8)
    data = [(chance.choice([None, *range(12)]), f"k{i:03}") for i in range(400)]
    frame = spark.createDataFrame(data, "seq int, k string").repartition(7)
    wanted = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for n in (1, 2, 57, 200, 399, 400):
        assert tuple(R.nth_in_order(frame, ["seq", "k"], n)) == wanted[n - 1]
    assert R.nth_in_order(frame, ["seq", "k"], 401) is None and R.nth_in_order(frame, ["seq", "k"], 0) is None
    assert R.nth_in_order(frame.limit(0), ["seq", "k"], 1) is None


def test_limited_merge_takes_the_first_changes_in_order(spark):
    chance = random.Random(3)
    target = spark.createDataFrame([(i, 0) for i in range(0, 300, 2)], "k int, v int")
    data = [(i, chance.randint(0, 1), chance.choice([None, *range(9)])) for i in range(300)]
    source = spark.createDataFrame(data, "k int, v int, seq int")
    clauses = [M.when_matched_update("s.v <> t.v"), M.when_not_matched_insert()]
    changes = sorted((r for r in data if r[0] % 2 or r[1]), key=lambda r: (r[2] is not None, r[2] or 0, r[0]))
    for limit in (1, 40, 150, len(changes), 1_000):
        wanted = {i: 0 for i in range(0, 300, 2)} | {k: v for k, v, _ in changes[:limit]}
        merged = M.merge(target, source, "k", clauses, order_by="seq", limit=limit)
        assert dict(rows(merged.snapshot)) == wanted


def test_a_shared_beginning_is_no_join_key(spark):
    chance = random.Random(21)
    common = "a common beginning "
    names = sorted({common + "".join(chance.choices("abcdefghijklmnopqrstuvwxyz", k=16)) for _ in range(3_000)})
    names += [n + "x" for n in names[:20]]
    frame = spark.createDataFrame([(1, n) for n in names], "b int, name string")
    assert Q.candidate_names(frame, ["b"]).count() < 40 * len(names)
    assert {(r["name_a"], r["name_b"]) for r in Q.similar_names(frame, ["b"], "name").collect()} >= {(n, n + "x") for n in names[:20]}
