from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from samplewright.llm import forest, mixing, neardup, queries, sharding, urltrie

DOCS = "doc_id long, text string, source string, lang string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, "a b c", "s", "en"), (1, "a b c", "s", "en"), (2, None, None, None), (3, "", "s", "en"), (None, "x y", "t", "en"), (None, None, "t", "en"), (4, "w " * 50_000, "t", "en"), (5, "é\n日本", None, "xx")]
    return spark.createDataFrame([(*r, 1, 2) for r in rows], DOCS + ", shard int, target int")


def jump(key, n):
    shard, following = -1, 0
    while following < n:
        shard = following
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        following = int((shard + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return shard


@pytest.mark.parametrize("n", [1, 2, 8, 9, 100])
def test_jump_hash_by_the_published_loop(spark, n):
    rng = random.Random(n)
    keys = [rng.getrandbits(60) for _ in range(200)] + [0, (1 << 60) - 1]
    rows = spark.createDataFrame([(k,) for k in keys], "k long").select("k", sharding.jump_hash(F.col("k"), n).alias("s")).collect()
    assert [r["s"] for r in rows] == [jump(r["k"], n) for r in rows]


def test_slots_have_no_gaps(spark, odd):
    rows = sharding.shard_table(odd, 3).collect()
    assert len(rows) == 8
    for shard in range(3):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert all(r["grown_shard"] in (r["shard"], 3) for r in rows)
    assert sharding.shard_table(odd.limit(0), 3).count() == 0
    hot = spark.range(20_000).select((F.col("id") % 3).alias("doc_id"), F.lit("same").alias("text")).repartition(7)
    got = sharding.shard_table(hot, 8).groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m"), F.count_distinct("slot").alias("d")).collect()
    assert all(r["n"] == r["m"] + 1 == r["d"] for r in got)


def test_shards_are_written_whole(spark, odd, tmp_path):
    sharding.write_shards(odd, f"file://{tmp_path}/out", 3)
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == 8


def brute_mix(rows, turn=(5, 2, 1), most=3):
    """Targets by resharing the excess until none is above its cap."""
    sizes = {}
    for _, source, size in rows:
        sizes[source] = sizes.get(source, 0) + size
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: turn[k % 3] for k, s in enumerate(order)}
    total, target, free = sum(sizes.values()), {}, set(order)
    while free:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        target |= {s: most * sizes[s] for s in over} if over else share
        free = free - over if over else set()
    return sizes, target


def test_mix_meets_targets(spark):
    rng = random.Random(5)
    docs = [(k, " ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(0, 60))), rng.choice(["a", "b", "ä", "c", None, "zz"] + ["big"] * 6), "en") for k in range(600)]
    df = spark.createDataFrame(docs, DOCS)
    rows = mixing.mix(df).collect()
    sizes, target = brute_mix([(k, s, len(t.split())) for k, t, s, _ in docs])
    taken, largest = {}, {}
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] in [r["size"] * k for k in range(4)]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        largest[r["source"]] = max(largest.get(r["source"], 0), r["size"])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(df.repartition(5)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}
    assert mixing.mixed_documents(df).count() == sum(r["times"] for r in rows)


def test_mix_nests_and_takes_given_weights(spark):
    df = spark.createDataFrame([(k, "w " * 10, "ab"[k % 2], "en") for k in range(200)], DOCS)
    few = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "source string, weight double")
    more = spark.createDataFrame([("a", 2.0), ("b", 2.0)], "source string, weight double")
    one, two = ({r["doc_id"]: r["times"] for r in mixing.mix(df, weights=w).where("source = 'a'").collect()} for w in (few, more))
    assert sum(one.values()) == 50 and sum(two.values()) == 100
    assert all(two[k] >= one[k] for k in one)


def test_mix_of_odd_tables(odd):
    rows = mixing.mix(odd).collect()
    assert len(rows) == 8 and {r["taken"] for r in rows if r["size"] == 0} == {0}
    assert mixing.mix(odd.limit(0)).count() == 0 and mixing.mixed_documents(odd.limit(0)).count() == 0


URLS = [None, "", "nothing", "http://A.NET/x", "http://net", "http://xnet/", "https://www.example.net/en/1?q", "https://www.example.net/entry", "http://example.net/de/", "http://a.example.com/de/x#y", "http://example.com/de", "http://x.org/fr/", "http://x.org:80/fr/", "http://u@x.org/fr/a", "x://y://z.net/a", "http://net/a\nb", "http://example.net/en/" + "a" * 50_000]
RULES = [*queries.URL_RULES, ("com", "/d", "block"), ("a.example.com", "/de/x", "allow"), ("org", "", "block"), ("net", "/", "allow")]


def brute_verdict(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        ends = [rest.find(c) for c in "/?#" if c in rest]
        host = rest[: min(ends, default=len(rest))]
        after = rest[len(host) :]
        path = after[: min([after.find(c) for c in "?#" if c in after], default=len(after))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(h.count("."), len(h), len(p), v, h + p) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[4], best[3] if best else "allow"


@pytest.mark.parametrize("most", [1_000_000, 2])
def test_url_rules_by_brute_force(spark, most):
    """By trie, and by the join that stands in for many rules."""
    rows = [(k, u) for k, u in enumerate(URLS)] + [(None, URLS[3]), (0, None), (3, URLS[3]), (3, URLS[6])]
    df = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, host string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = sorted((str(r["page_id"]), r["host"], r["path"], str(r["rule"]), r["verdict"]) for r in urltrie.judge_urls(df, rules, broadcast_rules=most).collect())
    want = sorted((str(k), *(str(x) if i == 2 else x for i, x in enumerate(brute_verdict(u)))) for k, u in rows)
    assert got == want
    assert urltrie.judge_urls(df.limit(0), rules, broadcast_rules=most).count() == 0


def test_url_rules_with_nulls_capitals_and_many_ends(spark):
    rules = [("Ä.Example", "/a", "allow"), (None, "/", "block"), ("example", None, "block"), ("b.org", "/X", "allow"), ("B.org", "/X", "allow")]
    rules += [("many.org", "/p" + "q" * k, "block" if k % 2 else "allow") for k in range(300)]
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    urls = ["http://ä.example/a", "http://Ä.example/abc", "http://example/", "http://B.ORG/Xy", *(f"http://www.many.org/p{'q' * k}r" for k in (0, 1, 2, 299, 400))]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    by_trie = sorted(map(tuple, urltrie.judge_urls(pages, table).collect()))
    assert by_trie == sorted(map(tuple, urltrie.judge_urls(pages, table, broadcast_rules=1).collect()))
    assert [r[3] for r in by_trie] == [None, "Ä.Example/a", None, "B.org/X", *("many.org/p" + "q" * k for k in (0, 1, 2, 299, 299))]
    assert all(r[3] is None for r in urltrie.judge_urls(pages, table.limit(0)).collect())


def brute_near(docs, shingle, percent=80):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for key, text in docs:
        w = (text or "").translate(low).encode().split()
        sets[key] = {tuple(w[i : i + shingle]) for i in range(len(w) - shingle + 1)} or ({tuple(w)} if w else set())
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(s), find(k)) for k, s in sets.items()}


@pytest.mark.parametrize("turns", [4, 16])
def test_near_duplicates_by_brute_force(spark, turns):
    """A star of edited copies, chains of small edits, exact copies, short and empty texts.

    With fewer turns than the operator takes, stars of large buckets may miss a text that has one link only.
    """
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(300)]
    base = [rng.choice(vocabulary) for _ in range(90)]
    texts = []
    for _ in range(120):
        copy = list(base)
        for _ in range(rng.randint(0, 10)):
            copy[rng.randrange(90)] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    for _ in range(15):
        chain = [rng.choice(vocabulary) for _ in range(60)]
        for _ in range(6):
            texts.append(" ".join(chain))
            chain[rng.randrange(60)] = rng.choice(vocabulary)
    texts += [texts[0]] * 5 + ["One", "one", "ONE two", "one  two", "", "  ", None, None, "a b c d", "a b c d e"]
    docs = list(zip(rng.sample(range(10_000), len(texts)), texts, strict=True))
    for shingle in (2, 5):
        want = brute_near(docs, shingle)
        got = {r["doc_id"]: r for r in neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), neardup.Near(shingle=shingle, turns=turns)).collect()}
        wrong = [k for k, r in got.items() if (r["n_shingles"], r["component_id"]) != want[k]]
        assert len(got) == len(want) and len(wrong) <= (0 if turns == neardup.Near().turns else 0.01 * len(want))
        assert all(r["kept"] == (k == r["component_id"]) for k, r in got.items())


@pytest.mark.parametrize("shingle", [2, 5])
def test_large_buckets_lose_no_link(spark, shingle, monkeypatch):
    """Two families of edited copies in buckets far above `turns`: the components are those of all pairs, and a node makes few rows.

    A centre's own edits are shared by all others, and many texts are linked with one text only.
    """
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = []
    base = [rng.choice(vocabulary) for _ in range(90)]
    for family in range(2):
        for _ in range(150):
            copy = list(base)
            for _ in range(rng.randint(1, 9)):
                copy[rng.randrange(90)] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
        base = base[:60] + [rng.choice(vocabulary) for _ in range(30)]
    docs = list(enumerate(texts))
    seen, write = {}, neardup.written
    monkeypatch.setattr(neardup, "written", lambda df, name: (seen.setdefault(name, []).append(out := write(df, name)), out)[1])
    want = brute_near(docs, shingle)
    got = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), neardup.Near(shingle=shingle, turns=2)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    # "deeper": the table of bands that an earlier version made, 100 rows of each node and more
    rows = [t.count() for name in ("deeper", "tokens") for t in seen.get(name, [])]
    assert rows and 0 < max(rows) <= len(docs) * (90 // 4 + 1)


def test_near_duplicates_of_odd_tables(spark, odd):
    rows = neardup.near_duplicates(odd).collect()
    assert len(rows) == 8
    assert neardup.near_duplicates(odd.limit(0)).count() == 0
    one = neardup.drop_near_duplicates(odd).collect()
    assert sorted(str(r["doc_id"]) for r in one) == ["1", "2", "3", "4", "5", "None", "None"]
    assert set(one[0].asDict()) == set(odd.columns)


def test_one_document_of_each_group_stays(spark):
    """A smallest key on several texts, a group of null keys only, and repeated rows, still leave one row."""
    base = [f"w{k}" for k in range(100)]
    near = [" ".join(base[:k] + [f"x{k}"] + base[k + 1 :]) for k in (0, 99, 98)]
    rows = [(1, near[0], "a"), (1, near[1], "b"), (2, near[2], "c")]
    other = [w + "y" for w in base]
    rows += [(None, " ".join(other), "d"), (None, " ".join(other[:-1]), "e"), (None, " ".join(other), "f")]
    rows += [(7, "one text of its own", "g"), (7, "one text of its own", "g"), (8, None, "h"), (9, "", "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    left = neardup.drop_near_duplicates(docs).collect()
    assert sorted(str(r["doc_id"]) for r in left) == ["1", "7", "8", "9", "None"]
    assert all(tuple(r) in rows for r in left)


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 102)], "a long, b long")
    assert {r["node"]: r["label"] for r in neardup.components(links).collect()} == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 102), 100)}


def test_forest_recall_and_order(spark):
    rng = np.random.default_rng(7)
    vectors = rng.standard_normal((1500, 16))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    rows = forest.nearest(df, df.where("vec_id % 50 = 0"), k=10).collect()
    hits = 0
    for q in range(0, 1500, 50):
        scores = vectors @ vectors[q]
        best = [i for i in np.lexsort((np.arange(1500), -scores)) if i != q][:10]
        mine = sorted((r for r in rows if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert all(r["score"] == pytest.approx(scores[r["vec_id"]], abs=1e-12) for r in mine)
        hits += len({r["vec_id"] for r in mine} & set(best))
    assert hits >= 0.9 * 30 * 10


def test_forest_of_many_blocks(spark):
    """Recall and order over five blocks of rows and three of queries; vectors in loose groups."""
    rng = np.random.default_rng(8)
    vectors = rng.standard_normal((60, 24))[rng.integers(0, 60, 2000)] + 0.5 * rng.standard_normal((2000, 24))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    small = forest.Forest(trees=32, entries=24, rows=400, queries=40)
    rows = forest.nearest(df, df.where("vec_id % 20 = 0"), k=20, forest=small).collect()
    hits = 0
    for q in range(0, 2000, 20):
        scores = vectors @ vectors[q]
        best = [i for i in np.lexsort((np.arange(2000), -scores)) if i != q][:20]
        mine = sorted((r for r in rows if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert [r["score"] for r in mine] == sorted((r["score"] for r in mine), reverse=True)
        assert all(r["score"] == pytest.approx(scores[r["vec_id"]], abs=1e-12) for r in mine)
        hits += len({r["vec_id"] for r in mine} & set(best))
    assert hits >= 0.9 * 100 * 20


def test_forest_of_odd_tables(spark):
    rows = [(k, [1.0, 0.5]) for k in range(60)] + [(100 + k, [float(k % 7) - 3, 1.0]) for k in range(50)]
    rows += [(200, None), (201, [0.0, -0.0]), (202, [float("nan"), 1.0]), (203, [None, 1.0]), (204, [float("inf"), 1.0]), (None, [1.0, 1.0]), (5, [1.0, 0.5]), (220, [1.0, 2.0, 3.0]), (240, [])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int")
    got = forest.nearest(df, df.where("vec_id % 20 = 0"), k=20).collect()
    plain = {k: v for k, v in rows if k is not None and v and len(v) == 2 and None not in v and np.isfinite(v).all() and any(v)}
    for q in (k for k in plain if k % 20 == 0):
        want = sorted((k for k in plain if k != q), key=lambda k: (-np.dot(plain[k], plain[q]), k))[:20]
        assert [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == want
    assert {r["query_id"] for r in got} == {k for k in plain if k % 20 == 0}
    assert forest.nearest(df.limit(0), df.limit(0)).count() == 0
