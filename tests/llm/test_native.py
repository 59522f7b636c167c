"""The operators made of DataFrame functions."""

import zlib

from pyspark.sql import functions as F

from pulsemill.llm import decontaminate, native_queries, preferences, sharding, url_filter
from pulsemill.llm.url_filter import UrlRule


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_url_parts_and_longest_rule(spark):
    rules = native_queries.URL_RULES
    urls = [
        ("https://A.Example.ORG/es/1?x", "a.example.org", "/es/1", "example.org/es/", "block"),
        ("http://x.org", "x.org", "", None, "allow"),
        ("http://x.org/", "x.org", "/", "org/", "allow"),
        ("http://notorg/es/", "notorg", "/es/", None, "allow"),
        ("http://example.org/en/12#t", "example.org", "/en/12", "example.org/en/1", "block"),
        ("http://b.com/de/x", "b.com", "/de/x", "com/de/", "block"),
        ("no scheme", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ]
    pages = frame(spark, [(i, u[0], None, "extra") for i, u in enumerate(urls)] * 2, "page_id long, url string, html string, host string")
    got = url_filter.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(i, *u[1:]) for i, u in enumerate(urls)] * 2, key=str)
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(pages, ()).collect()} == {"allow"}


def test_distrust_follows_links_backwards(spark):
    link = '<a href="http://{}/p">x</a>'
    pages = frame(
        spark,
        [
            (1, "http://bad.com/de/1", ""),
            (2, "http://farm.net/1", link.format("bad.com") * 3),
            (3, "http://good.org/1", link.format("friend.net")),
            (4, "http://friend.net/1", link.format("bad.com") + link.format("good.org") * 20),
            (5, "http://alone.net/1", "<a HREF='/local'>"),
        ],
        "page_id long, url string, html string",
    )
    rules = (UrlRule("com", "/de/", "block"), UrlRule("org", "/", "allow"))
    got = {r.host: (r.verdict, r.by) for r in url_filter.judge_urls(pages, rules).collect()}
    assert got["farm.net"] == ("block", "links") and got["alone.net"] == ("allow", "default")
    assert got["friend.net"][0] == "allow" and got["good.org"] == ("allow", "rule") and got["bad.com"] == ("block", "rule")
    scores = {
        (r.kind, r.host): r.score
        for r in url_filter.propagate(url_filter.host_links(pages), frame(spark, [("trust", "good.org", 2), ("distrust", "bad.com", 1)], "kind string, host string, weight long"), rounds=2).collect()
    }
    # Two rounds by hand. No host links to farm.net, so its distrust goes back to bad.com.
    by_hand = {
        ("trust", "friend.net"): 0.85 * 0.15,
        ("trust", "bad.com"): 0.85 * 0.85 / 21,
        ("trust", "good.org"): 0.15 + 0.85 * 0.85 * 20 / 21,
        ("distrust", "farm.net"): 0.85 * 0.15 * 3 / 4,
        ("distrust", "friend.net"): 0.85 * 0.15 / 4,
        ("distrust", "good.org"): 0.85 * 0.85 / 4,
        ("distrust", "bad.com"): 1 - 0.85 * (0.15 + 0.85 / 4),
    }
    assert set(scores) == set(by_hand) and all(abs(scores[k] - v) < 1e-12 for k, v in by_hand.items())


def test_sql_of_planted_graphs(spark, tmp_path):
    import random

    import duckdb
    from compare import compare

    for seed in range(2):
        rnd = random.Random(seed)
        hosts = [f"h{i}.{rnd.choice(['com', 'org', 'net', 'example.org', 'info'])}" for i in range(40)]
        links = ['<a href="http://{}/x">', "<a href='//{}'>", "<a HREF=https://{}?q>"]
        rows = [
            (
                i,
                f"http://{(own := rnd.choice(hosts))}{rnd.choice(['/de/1', '/fr/', '/es/2', '/en/15', '/', ''])}",
                "".join(rnd.choice(links).format(rnd.choice(hosts[: 10 + 10 * seed])) for _ in range(rnd.randrange(4))) + f'<a href="http://{own}/">',
            )
            for i in range(150)
        ]
        folder = str(tmp_path / str(seed))
        spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
        con = duckdb.connect()
        con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet/*.parquet'")
        message, n, _ = compare(spark, con, "op1", native_queries.op1_url_filter, native_queries.SQL["op1_url_filter"], folder)
        assert message is None and n == 150, message
        by_links = con.execute(f"SELECT DISTINCT verdict FROM ({native_queries.SQL['op1_url_filter']}) WHERE rule IS NULL").fetchall()
        assert {r[0] for r in by_links} == {"allow", "block"}


def test_verdict_does_not_depend_on_other_blocked_hosts(spark):
    link = '<a href="http://{}/p">x</a>'
    # A chain of 15 hosts in front of the blocked one: longer than ten rounds reach.
    chain = [(10 + i, f"http://h{i}.net/1", link.format(f"h{i - 1}.net" if i else "bad.com")) for i in range(15)]
    pages = frame(spark, [(1, "http://bad.com/de/1", ""), (2, "http://farm.net/1", link.format("bad.com") * 3), *chain], "page_id long, url string, html string")
    others = spark.range(10_000).select((F.col("id") + 100).alias("page_id"), F.format_string("http://x%d.com/de/1", "id").alias("url"), F.lit("").alias("html"))
    rules = (UrlRule("com", "/de/", "block"), UrlRule("org", "/", "allow"))
    for table in (pages, pages.unionByName(others)):
        got = {r.host: (r.verdict, r.by) for r in url_filter.judge_urls(table, rules).where("host NOT LIKE 'x%'").collect()}
        assert got.pop("bad.com") == ("block", "rule")
        assert len(got) == 16 and set(got.values()) == {("block", "links")}, got


def test_links_name_a_host(spark):
    html = '<a href="//B.net/x?u=http://c.net/"><a href=//b.net><a href="http://c.net/p"><a href="/d.net//e"><a href="f.html">'
    pages = frame(spark, [(1, "http://a.net/", html)], "page_id long, url string, html string")
    assert sorted(map(tuple, url_filter.host_links(pages).collect())) == [("a.net", "b.net", 2), ("a.net", "c.net", 1)]


def test_scores_settle(spark):
    # Two hosts that link to each other keep half of what comes in: slow to settle, and known.
    edges = frame(spark, [("a", "b", 1), ("b", "a", 1)], "src string, dst string, links long")
    seeds = frame(spark, [("trust", "a", 7)], "kind string, host string, weight long")
    got = {r.host: r.score for r in url_filter.propagate(edges, seeds, tolerance=1e-6).collect()}
    assert abs(got["a"] - 0.15 / (1 - 0.85**2)) < 6e-6 and abs(got["b"] - 0.85 * 0.15 / (1 - 0.85**2)) < 6e-6


def test_preference_rows(spark):
    turns = frame(
        spark,
        [
            (1, 0, "user", "hi", "x"), (1, 1, "assistant", "a", "x"), (1, 2, "user", "more", "x"), (1, 3, "assistant", "b", "x"),
            (2, 0, "user", "hi", "x"), (2, 1, "assistant", "a", "x"), (2, 2, "user", "other", "x"), (2, 2, "user", "other", "x"),
            (3, 0, "user", None, "x"), (3, 1, None, "z", "x"), (None, 0, "user", "hi", "x"), (4, None, "user", "hi", "x"), (5, 0, "user", "", "x"),
        ],
        "conv_id long, turn long, role string, text string, chosen string",
    )
    pairs = preferences.pairs_by_opening(turns)
    assert sorted(map(tuple, pairs.collect())) == [(1, 2), (3, 5)]
    rows = preferences.preference_turns(*preferences.turns_of_pairs(turns, pairs))
    got = sorted((r.part, r.turn, r.rendered, r.rendered[r.mask_start : r.mask_end]) for r in rows.where("chosen = 1").collect())
    assert got == [
        ("chosen", 2, "<|im_start|>user\nmore<|im_end|>\n", ""),
        ("chosen", 3, "<|im_start|>assistant\nb<|im_end|>\n", "b<|im_end|>"),
        ("prompt", 0, "<|im_start|>user\nhi<|im_end|>\n", ""),
        ("prompt", 1, "<|im_start|>assistant\na<|im_end|>\n", ""),
        ("rejected", 2, "<|im_start|>user\nother<|im_end|>\n", ""),
    ]
    record = preferences.preference_records(rows).where("chosen = 1").first()
    assert record.prompt_text == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n"
    assert [record.chosen_text[m.start : m.end] for m in record.chosen_masks] == ["b<|im_end|>"]
    chosen, rejected = preferences.stale_replies(turns)
    stale = preferences.preference_turns(chosen, rejected).where("part <> 'prompt'")
    assert sorted((r.part, r.turn, r.rendered) for r in stale.collect()) == [
        ("chosen", 3, "<|im_start|>assistant\nb<|im_end|>\n"),
        ("rejected", 3, "<|im_start|>assistant\na<|im_end|>\n"),
    ]
    assert preferences.preference_turns(*preferences.turns_of_pairs(turns.limit(0), pairs.limit(0))).count() == 0


def test_every_reply_has_a_pair(spark):
    folder = "/root/testdata/sf0.01"
    turns = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = native_queries.op4_preferences_whole(spark, folder)
    answered = {r.conv_id for r in turns.where("role = 'assistant'").select("conv_id").distinct().collect()}
    got = rows.where("chosen = rejected").groupBy("chosen").agg(F.collect_set("part").alias("parts")).collect()
    assert {r.chosen for r in got if {"chosen", "rejected"} <= set(r.parts)} == answered
    few = frame(spark, [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (2, 0, "user", "s"), (2, 1, "assistant", "b"), (3, 0, "user", "t")], "conv_id long, turn long, role string, text string")
    made = preferences.preference_turns(*preferences.borrowed_replies(few))
    assert sorted((r.chosen, r.part, r.rendered[r.mask_start : r.mask_end]) for r in made.where("part <> 'prompt'").collect()) == [
        (1, "chosen", "a<|im_end|>"), (1, "rejected", "b<|im_end|>"), (2, "chosen", "b<|im_end|>"), (2, "rejected", "a<|im_end|>"),
    ]
    assert sorted(r.turn for r in made.where("part = 'prompt'").collect()) == [0, 0]


def test_contained_items(spark):
    words = [f"w{i}" for i in range(40)]
    item = " ".join(words[:30])
    docs = frame(
        spark,
        [
            (1, "intro text, " + item.upper() + "! and then a lot more", 0),
            (2, " ".join(words[:26]) + " off the rails entirely", 0),  # 22 of 26 shingles
            (3, " ".join(words[:24]) + " off", 0),  # 20 of 26
            (4, None, 0), (5, "", 0), (6, "Short item", 0), (7, "a Short item here", 0), (None, item, 0), (1, item, 0),
        ],
        "doc_id long, text string, item_id int",
    )
    items = frame(spark, [(10, item, 1), (11, "short  ITEM", 1), (12, None, 1), (13, "", 1), (None, item, 1), (10, item, 1)], "item_id long, text string, doc_id int")
    got = decontaminate.contained_items(docs, items)
    assert sorted(map(tuple, got.collect())) == [(1, 10, 26, 26), (2, 10, 26, 22), (6, 11, 1, 1), (7, 11, 1, 1)]
    left = decontaminate.drop_contaminated(docs, items)
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 3, 4, 5] and left.columns == docs.columns
    assert decontaminate.contained_items(docs.limit(0), items).count() == 0
    assert decontaminate.drop_contaminated(docs, items.limit(0)).count() == 9


def test_items_of_few_words_and_very_long_documents(spark):
    long = "filler words " * 60_000
    texts = {1: "one", 2: "one two", 3: "x one two y", 4: "one x two", 5: "a b c one two three four d e", 6: long + "One, two! three" + " tail" * 50_000, 7: "onetwo three", 8: "two three"}
    docs = frame(spark, [(i, t, "s") for i, t in texts.items()], "doc_id long, text string, source string")
    phrases = {1: "one", 2: "One two", 3: "two three four", 4: "one two three four", 5: "b c one two three"}
    items = frame(spark, list(phrases.items()), "item_id long, text string")
    want = {(d, i) for d, t in texts.items() for i, p in phrases.items() if f" {p.lower()} " in " " + " ".join(t.lower().replace(",", " ").replace("!", " ").split()) + " "}
    assert {(r.doc_id, r.item_id) for r in decontaminate.contained_items(docs, items).collect()} == want and len(want) >= 12


def check_shards(rows, shards, half_record):
    total = sum(r.size for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    for got in by.values():
        assert sorted(r.slot for r in got) == list(range(len(got)))
        assert abs(sum(r.size for r in got) - total / shards) <= 2 * half_record


def test_shards_are_even_with_hot_and_null_keys(spark):
    rows = [(i if i % 3 else 7, 10 + i % 17, "x", i) for i in range(4000)] + [(None, 5, "x", -1), (3, None, "x", -2), (3, -4, "x", -3)]
    df = frame(spark, rows, "k long, size long, shard string, n long")
    got = sharding.shard_by_size(df, F.col("k"), F.col("size"), 8, ranges_per_shard=4)
    assert got.columns == ["k", "size", "n", "shard", "slot"]
    found = got.where("size > 0").collect()
    assert sorted(r.n for r in got.collect()) == sorted(r[3] for r in rows)
    by = {}
    for r in found:
        by[r.shard] = by.get(r.shard, 0) + r.size
    mean = sum(by.values()) / 8
    assert len(by) == 8 and all(abs(v - mean) <= 30 for v in by.values())
    assert sharding.shard_by_size(df.limit(0), F.col("k"), F.col("size"), 8).count() == 0
    assert sharding.shard_by_size(df, F.col("k"), F.lit(0), 4).groupBy("shard").count().count() == 4


def test_op10(spark):
    folder = "/root/testdata/sf0.001"
    rows = native_queries.op10_sharding(spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
    check_shards(rows, 40, max(r.size for r in rows))
