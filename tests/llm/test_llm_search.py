"""Near copies, urls and neighbours against brute force, and the pipeline against its parts."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from conftest import SMALL
from pyspark.sql import functions as F

from test_llm_near_dedup import smallest_of_groups

from tallyspark.llm import anngraph, langid, packing, queries, secrets, simhash, urlfilter
from tallyspark.llm.components import connected

MIDDLE, LARGER = SMALL.replace("0.001", "0.01"), SMALL.replace("0.001", "0.1")

# near copies


def plain_fingerprint(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius=3):
    """Smallest id reachable, for {id: fingerprint}, by comparing all pairs."""
    low = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i in prints:
            for j in prints:
                if low[j] < low[i] and (prints[i] ^ prints[j]).bit_count() <= radius:
                    low[i], changed = low[j], True
    return low


def test_fingerprints(spark):
    texts = [None, "", " \n", "One", "one TWO", "É a b É a b c", "a b c " * 500, "\x1c a\x0bb"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("fp", F.lit("x"))
    got = {r.doc_id: r.fp & (1 << 64) - 1 for r in simhash.with_fingerprint(docs).collect()}
    assert got == {i: plain_fingerprint(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("tile", [2048, 4])
def test_links_are_those_of_all_pairs(spark, tile):
    rng = random.Random(6)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for p in prints[:12]:  # chains and crowds of near fingerprints
        for _ in range(12):
            for b in rng.sample(range(64), rng.randrange(1, 4)):
                p ^= 1 << b
            prints.append(p)
    prints += [prints[0] ^ 1 << b for b in range(30)]
    prints = dict(enumerate(dict.fromkeys(prints)))
    fps = spark.createDataFrame([(simhash.signed(p),) for p in prints.values()], "fp long")
    roots = {r.fp: r.root for r in simhash.fingerprint_roots(fps, 3, 6, tile).collect()}
    want = components(prints)
    groups = lambda label: {frozenset(i for i in prints if label(i) == label(j)) for j in prints}
    assert groups(lambda i: roots[simhash.signed(prints[i])]) == groups(want.get)


def test_near_copies_of_the_table(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").where(F.col("doc_id") < 300)
    prints = {r.doc_id: plain_fingerprint(r.text) for r in docs.collect()}
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert {i: got[i].component_id for i in got} == components(prints)
    whole = queries.QUERIES["op1_simhash"](spark, MIDDLE)
    assert whole.count() == 1000
    assert all(int(r.fingerprint, 16) == prints[r.doc_id] for r in whole.where("doc_id < 300").collect())


def test_one_of_each_group_stays(spark):
    rows = [(3, "a b c d"), (1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "other words are here now"), (9, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("root", F.lit(1)).withColumn("first", F.lit(2))
    got = simhash.keep_first(docs)
    assert sorted((r.doc_id or -1, r.text) for r in got.collect()) == [(-1, "other words are here now"), (1, "a b c d"), (8, "")]
    assert got.columns == docs.columns
    assert simhash.keep_first(docs.limit(0)).count() == 0


def test_components_of_a_chain(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


# urls

URLS = [
    None, "", "no scheme/path", "HTTP://Example.NET/en/x?q#f", "http://a.example.net/fr/", "http://example.com/de/1", "http://example.com/den",
    "http://x.org/fr/#a://b", "://", "http://notexample.net", "http://anet/", "https://example.org?x=/fr/", "http://a.b/c://d/e", "http://É.net/Ü",
]


def plain_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = []
    for rule in urlfilter.RULES:
        domain, _, start = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start):
            fits.append(rule)
    return host, path, max(fits, key=len, default=None)


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("rule", F.lit("x"))
    got = {r.page_id: (r.host, r.path, r.rule) for r in urlfilter.with_rules(pages, urlfilter.RULES).collect()}
    assert got == {i: plain_url(u) for i, u in enumerate(URLS)}


def test_verdicts(spark):
    got = queries.QUERIES["op2_url_filter"](spark, LARGER).collect()
    assert len(got) == spark.read.parquet(f"{LARGER}/pages.parquet").count()
    for r in got:
        assert r.verdict == urlfilter.RULES.get(r.rule, r.verdict) and r.verdict in ("allow", "block")
    free = [r for r in got if r.rule is None]
    plain = [r for r in free if not re.search("adult|casino|bets|spam", r.host)]
    assert sum(r.verdict == "allow" for r in plain) >= 0.97 * len(plain)


def test_urls_of_unwanted_hosts_are_blocked(spark):
    rng = random.Random(1)
    urls = [f"http://{rng.choice(['www', 'm'])}.{rng.choice(['garden', 'museum', 'library'])}{i % 7}.com/en/{i}" for i in range(300)]
    urls += [f"http://{rng.choice(['casino', 'poker'])}.slots{i % 5}.com/win/{i}" for i in range(100)]
    urls += ["http://slots3.com/win/7", "http://museum4.com/en/9"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("verdict", F.lit(0))
    got = {r.page_id: r.verdict for r in urlfilter.judge(pages).collect()}
    assert got[400] == "block" and got[401] == "allow"
    assert {r.verdict for r in urlfilter.judge(pages.where("page_id < 5")).collect()} == {"allow"}
    assert urlfilter.judge(pages.limit(0)).count() == 0


def test_model_shares_sum_to_one():
    counts = {"a": 3, "b": 1, "aa": 1, "ab": 1, "ba": 1}
    model = urlfilter.Markov.of(counts, 2)
    after_a = [np.exp(model.seen["aa"]), np.exp(model.seen["ab"])]
    rest = np.exp(model.handed["a"]) * (1 - np.exp(model.seen["a"]) - np.exp(model.seen["b"]))
    assert sum(after_a) + rest == pytest.approx(1)


def test_gram_counts_cover_every_url(spark):
    rows = [("ab", True), ("ab", False), ("b", False), ("", True)]
    got = {r.gram: (r.accepted, r.rejected) for r in urlfilter.count_grams(spark.createDataFrame(rows, "text string, rejected boolean"), 2).collect()}
    assert got["b"] == (2, 1) and got["ab"] == (1, 1) and got["\x02a"] == (1, 1)


# neighbours


def nearest(ids, vectors, i, k):
    x, others = vectors[i], [j for j in range(len(ids)) if ids[j] != ids[i]]
    score = {j: float(vectors[j] @ x / (np.sqrt(vectors[j] @ vectors[j]) * np.sqrt(x @ x))) for j in others}
    return sorted(others, key=lambda j: (-score[j], ids[j]))[:k], score


def test_recall_on_the_table(spark):
    rows = spark.read.parquet(f"{MIDDLE}/embeddings.parquet").collect()
    ids, vectors = [r.vec_id for r in rows], np.array([r.embedding for r in rows])
    got = {}
    for r in queries.QUERIES["op6_neighbour_graph"](spark, MIDDLE).collect():
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == {i for i in ids if i % 50 == 0}
    hits = 0
    for i in got:
        want, score = nearest(ids, vectors, ids.index(i), 5)
        assert [r.rank for r in sorted(got[i], key=lambda r: r.rank)] == [1, 2, 3, 4, 5]
        assert all(r.score == pytest.approx(score[ids.index(r.vec_id)], abs=1e-12) for r in got[i])
        hits += len({r.vec_id for r in got[i]} & {ids[j] for j in want})
    assert hits >= 0.9 * 5 * len(got)


@pytest.mark.parametrize("shard_rows", [8192, 300])
def test_recall_over_shards(spark, shard_rows):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(1500, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    got = anngraph.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, 5, shard_rows=shard_rows)
    found = {}
    for r in got.collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(found[i] & set(nearest(range(1500), vectors, i, 5)[0])) for i in found)
    assert len(found) == 30 and hits >= 0.9 * 150


def test_odd_vectors(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [1.0, None]), (7, [1.0]), (8, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)).withColumn("shard", F.lit(2))
    got = anngraph.neighbours(frame, F.col("vec_id").isin(0, 4), 5).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 2)]
    assert anngraph.neighbours(frame.limit(0), F.col("vec_id") == 0, 5).count() == 0


def test_rows_with_one_query_id_have_a_list_each(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), *((i, [1.0, i / 10]) for i in range(1, 9))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = anngraph.neighbours(frame, F.col("vec_id") == 0, 5).collect()
    assert sorted((r.rank, r.vec_id) for r in got) == sorted([(i, i) for i in range(1, 6)] + [(i, 9 - i) for i in range(1, 6)])


def test_pruned_neighbours_are_diverse():
    points = anngraph.unit(np.array([[1, 0], [1, 0.1], [1, 0.11], [1, -0.3], [0, 1]], float))
    kept = anngraph.robust_prune(points, np.array([0]), np.array([[1, 2, 3, 4, 0, 1, -1]]), 4, 1.2)[0]
    assert kept.tolist() == [1, 3, -1, -1] or set(kept[kept >= 0]) >= {1, 3} and 2 not in kept


# pipeline


def test_stages_keep_clean_documents(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "secret_scan", "packing"]
    stages = dict(pipeline.STAGES)
    odd = spark.createDataFrame([(5000, "12 34 !!", "en", "s", 8), (5001, None, None, None, None)], docs.schema)
    named = stages["language_id"](spark, docs.unionByName(odd), MIDDLE)
    assert named.columns == docs.columns and named.where("doc_id >= 5000").count() == 0
    assert named.count() == docs.count()
    lines = stages["line_dedup"](spark, docs, MIDDLE)
    assert lines.columns == docs.columns and lines.count() == docs.count()
    assert lines.where(F.col("n_chars") != F.char_length("text")).count() == 0
    single = stages["near_dedup"](spark, docs, MIDDLE)
    assert {r.doc_id for r in single.collect()} == smallest_of_groups({r.doc_id: r.text for r in docs.collect()})
    masked = stages["secret_scan"](spark, docs, MIDDLE)
    found = secrets.findings(docs, secrets.train(docs)).where("is_secret").select("doc_id").distinct().count()
    assert masked.where(F.contains("text", F.lit(secrets.MASK))).count() == found > 0
    assert masked.join(docs.select("doc_id", F.col("text").alias("before")), "doc_id").where("text <> before").count() == found


def test_run_packs_what_the_stages_leave(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
    want = packing.pieces(docs, with_ids=False).select("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    got = pipeline.run(spark, SMALL).select(*want.columns)
    assert got.count() > 0 and want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0


def test_rejected_languages_are_unknown_or_unclear(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert langid.identify(docs).where("ambiguous").count() == 0


def plain_verdicts(pages):
    """Verdicts and scores of urls without rules, by models in memory."""
    texts = {u.partition("://")[2].lower() for _, u in pages}
    marked = {t for t in texts if any(m in t.split("/")[0].replace("-", ".").split(".") for m in urlfilter.MARKERS)}
    return texts, marked


def test_scores_are_those_of_models_in_memory(spark):
    rng = random.Random(5)
    hosts = ["garden", "museum", "library", "casino", "poker", "überall"]
    rows = [(i, f"https://{rng.choice(hosts)}.{rng.choice(['com', 'org'])}/{rng.choice('abcd')}{rng.randrange(60)}") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("_read", F.lit(1)).withColumn("_score", F.lit(2))
    judged = urlfilter.judge(pages, rules={})
    assert judged.columns == [*pages.columns, "host", "path", "rule", "score", "verdict"]
    got = {r.url: (r.score, r.verdict) for r in judged.collect()}
    texts, marked = plain_verdicts(rows)
    labelled = urlfilter.labelled_urls(urlfilter.with_rules(pages, {}), urlfilter.MARKERS, "url").collect()
    assert {r.text for r in labelled} == texts and {r.text for r in labelled if r.rejected} == marked
    models = []
    for rejected in (False, True):
        counts = {}
        for r in labelled:
            if r.rejected == rejected and not r.held:
                padded = urlfilter.START * 5 + r.text + urlfilter.START
                for n in range(1, 7):
                    for i in range(5, len(padded)):
                        gram = padded[i - n + 1 : i + 1]
                        counts[gram] = counts.get(gram, 0) + 1
        models.append(urlfilter.Markov.of({g: n for g, n in counts.items() if n > (len(g) > 1)}, 6))
    score = {t: (models[0].log_likelihood(t) - models[1].log_likelihood(t)) / (len(t) + 1) for t in texts}
    held = sorted(score[r.text] for r in labelled if r.held and not r.rejected)
    low = min(0.0, held[max(0, int(np.ceil(0.01 * len(held))) - 1)])
    for url, (s, verdict) in got.items():
        want = score[url.partition("://")[2].lower()]
        assert s == pytest.approx(want) and verdict == ("block" if s < low else "allow")


def test_no_number_of_other_ngrams_changes_a_model(spark):
    """The counts of n-grams do not depend on how many others there are."""
    rng = random.Random(6)
    few = [(f"casino{i % 9}.com/{i % 30}", True) for i in range(60)] + [(f"garden{i % 9}.com/{i % 30}", False) for i in range(60)]
    many = [("".join(rng.choice("абвгдежзиклмнопрст") for _ in range(40)), False) for _ in range(4000)]
    kind = "text string, rejected boolean, held boolean"
    before = urlfilter.known_grams(spark.createDataFrame([(*r, False) for r in few], kind), 4).where("rejected > 0")
    after = urlfilter.known_grams(spark.createDataFrame([(*r, False) for r in few + many], kind), 4)
    assert after.count() > 20_000
    assert before.select("gram", "rejected").exceptAll(after.select("gram", "rejected")).count() == 0
