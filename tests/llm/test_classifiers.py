"""Language, quality and URLs: held-out accuracy and odd rows."""

import math
import random

import numpy as np
import pytest
from helpers import documents
from pyspark.sql import functions as F

from tenorline.llm import language_id, site_quality, url_filter
from tenorline.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


# ---------------------------------------------------------------- language


def kernel(a, b):
    """The blended-spectrum presence kernel written out."""
    def grams(text):
        runs = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
        return {runs[k:k + n] for n in (1, 2, 3) for k in range(len(runs) - n + 1)}
    x, y = grams(a), grams(b)
    return len(x & y) / math.sqrt(len(x) * len(y))


def test_ngrams_give_the_kernel():
    texts = ["Ein Wort, zwei!", "zwei  Worte", "ÉTÉ été", "\U00020000 \U0001f600a", "x" * 9000]
    sets = [language_id.ngrams(t) for t in texts]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            got = len(np.intersect1d(sets[i], sets[j])) / math.sqrt(len(sets[i]) * len(sets[j]))
            assert abs(got - kernel(a, b)) < 1e-12
    assert not len(language_id.ngrams(None)) and not len(language_id.ngrams("12 + 3 \U0001f600"))


def test_folded_scores_are_kernel_ridge_scores():
    """One matrix gives what kernels against all landmarks give, without Nystroem loss here."""
    rng = random.Random(2)
    texts = ["".join(rng.choice(s) for _ in range(60)) for s in ("abcd ", "cdef ", "efgh ") for _ in range(10)]
    labels = [x for x in "pqr" for _ in range(10)]
    sets = [language_id.ngrams(t) for t in texts]
    model = language_id.fit_kernel_ridge(sets, labels, landmarks=10, ridge=0.5)
    gram = np.array([[kernel(a, b) for b in texts] for a in texts])
    target = np.array([[x == y for y in "pqr"] for x in labels], float)
    # All texts are landmarks, so this is the dual solution with the same ridge.
    want = gram @ np.linalg.solve(gram + 0.5 * np.eye(30), target)
    assert np.abs(model.scores(sets) - want).max() < 2e-2


def test_language_query_on_held_out_documents(spark):
    got = {r["doc_id"]: r for r in QUERIES["op8_language_id"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(
        "doc_id", "lang", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("out")).collect()
    assert len(got) == len(docs) and all(got[r["doc_id"]]["held_out"] == r["out"] for r in docs)
    out = [r for r in docs if r["out"]]
    assert len(out) > 1500 and np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in out]) > 0.99
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_odd_rows(spark):
    labelled = spark.createDataFrame(
        [(k, "the house and the garden " * (1 + k % 3), "en") for k in range(8)]
        + [(20 + k, "das haus und der garten " * (1 + k % 3), "de") for k in range(8)]
        + [(40, None, "de"), (41, "", "xx"), (42, "text", None), (1, "the repeated id", "en")],
        "doc_id long, text string, lang string")
    model = language_id.train(labelled, "doc_id", "text", "lang")
    assert model.languages == ("de", "en")
    docs = documents(spark, [(1, None), (2, "12 !?"), (3, "the garden"), (3, "the garden"), (4, "haus " * 40_000),
                             (5, "\u043f\u0440\u0438\u0432\u0435\u0442 \u043c\u0438\u0440")])
    found = language_id.identify_language(docs.withColumn("lang_pred", F.lit("zz")), model)
    assert found.columns == ["doc_id", "text", "row", "key", "spans", "lang_pred", "score"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found.collect()}
    assert got[1] == got[2] == ("und", 0.0) and got[3][0] == "en" and got[4][0] == "de" and got[5][1] < 0.05
    nothing = language_id.train(labelled.filter("false"), "doc_id", "text", "lang")
    assert {r["lang_pred"] for r in language_id.identify_language(docs, nothing).collect()} == {"und"}
    assert language_id.identify_language(documents(spark, []), model).count() == 0


# ---------------------------------------------------------------- quality


def test_quality_on_labels_kept_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    out = F.crc32(F.col("doc_id").cast("string")) % 4 == 0
    judged = site_quality.judge(docs, site_quality.train(docs, labels.filter(~out)))
    rows = judged.join(labels.filter(out), "doc_id").select("kept", "quality").collect()
    assert len(rows) > 800 and np.mean([r["kept"] == (r["quality"] == 1) for r in rows]) > 0.98
    assert judged.count() == docs.count()


def posteriors(rows):
    """Shrunken shares in plain Python: (host, path) -> prior."""
    def strength(sites):
        n = sum(m for m, _, _ in sites)
        between = sum(m * ((g / m - of) ** 2 - of * (1 - of) / m) for m, g, of in sites) / n
        spread = sum(m * of * (1 - of) for m, _, of in sites) / n
        low, high = site_quality.STRENGTH
        return max(low, min(high, spread / between - 1)) if between > 0 else high
    hosts, paths = {}, {}
    for host, path, p in rows:
        for table, key in ((hosts, host), (paths, (host, path))):
            n, good = table.get(key, (0, 0.0))
            table[key] = (n + 1, good + p)
    overall = sum(g for _, g in hosts.values()) / len(rows)
    k = strength([(n, g, overall) for n, g in hosts.values()])
    share = {h: (g + k * overall) / (n + k) for h, (n, g) in hosts.items()}
    k = strength([(n, g, share[h]) for (h, _), (n, g) in paths.items()])
    return {key: (g + k * share[key[0]]) / (n + k) for key, (n, g) in paths.items()}


@pytest.mark.parametrize("spread", [0.0, 0.4])
def test_posteriors_against_plain_python(spark, spread):
    rng = random.Random(7)
    rows = []
    for host in ("a", "b", "c", None):
        for path in ("x", "y", None):
            level = min(0.98, max(0.02, 0.6 + rng.uniform(-spread, spread)))
            rows += [(host, path, float(rng.random() < level)) for _ in range(rng.choice([1, 2, 40, 300]))]
    got = site_quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double")).collect()
    want = posteriors(rows)
    assert len(got) == len(want)
    assert all(abs(r["prior"] - want[r["host"], r["path"]]) < 1e-9 for r in got)


def test_quality_odd_rows(spark):
    docs = documents(spark, [(1, None), (2, ""), (3, "fine words here"), (3, "fine words here"), (None, "x" * 200_000)]
                     ).withColumnRenamed("row", "source").withColumnRenamed("spans", "lang")
    labels = spark.createDataFrame([(3, 1), (None, 0), (2, None), (9, 5)], "doc_id long, quality int")
    model = site_quality.train(docs, labels)
    got = site_quality.judge(docs, model).collect()
    assert len(got) == 5 and all(r["evidence"] == 0 and 0 < r["score"] < 1 for r in got)
    assert site_quality.judge(docs.filter("false"), model).count() == 0
    assert site_quality.train(docs.filter("false"), labels.filter("false")).prior == 0.5


# ---------------------------------------------------------------- URLs


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host):]
    for c in "?#":
        path = path.split(c, 1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fits = [(r, v) for r, v in url_filter.RULES
            if (host == r[:r.index("/")] or host.endswith("." + r[:r.index("/")])) and path.startswith(r[r.index("/"):])]
    return max(fits, key=lambda f: len(f[0])) if fits else (None, None)


def test_url_query_against_plain_python(spark):
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op9_url_filter"](spark, SF).collect()
    assert sorted(r["page_id"] for r in got) == sorted(urls)
    for r in got:
        host, path = split_url(urls[r["page_id"]])
        rule, verdict = rule_of(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["block_score"] > 0.5 else "allow"))


URLS = [None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/x", "x://a.com", "x://a.com/", "x://com/", "x://acom/",
        "x://example.com/en/", "x://b.example.com/EN/", "x://www.example.com/en/?q", "x://www.example.com?/en/", "a://b.net/es/#x",
        "a://b.net/es", "a://net/fr/y?z#w", "a://\u00c9.net/fr/", "a://b.c://d/e", "a://h#://x/", "a://" + "p" * 9000 + "/" + "q" * 9000]


def test_url_edges(spark):
    pages = spark.createDataFrame([(k, u, "h", "row") for k, u in enumerate(URLS)] + [(None, URLS[5], "h", "row")] * 2,
                                  "page_id long, url string, host string, `row` string")
    got = url_filter.judge(pages, url_filter.fit([])).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        host, path = split_url(URLS[5 if r["page_id"] is None else r["page_id"]])
        rule, verdict = rule_of(host, path)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow")
    assert url_filter.judge(pages.filter("false"), url_filter.fit([])).count() == 0


def test_url_model_on_unseen_addresses(spark):
    from tenorline.llm.labelled_urls import LABELLED
    model = url_filter.train(spark.createDataFrame(LABELLED, "url string, verdict string"))
    block = ["free-casino-night.org/en/9", "best-bets-online.org/", "cheap-pills-direct.org/x", "adult-movies.org/1",
             "spam-farm-x.org/de/3", "ads-track-net.org/click"]
    allow = ["garden-society.org/en/9", "mountain-museum.org/", "public-archive.org/x", "history-lessons.org/1",
             "water-board.org/de/3", "village-school.org/news"]
    assert all(model.block(*u.split("/", 1)) > 0.5 for u in block)
    assert all(model.block(*u.split("/", 1)) < 0.5 for u in allow)
    empty = spark.createDataFrame([], "url string, verdict string")
    assert url_filter.train(empty).block("a.b", "/c") < 1e-6


def test_a_document_is_no_evidence_for_its_own_site(spark):
    """The prior is that of the other documents: with one document on a path and host, the global share."""
    from tenorline.llm.site_quality import site_counts
    from tenorline.llm.shared import written
    rows = [("a", "x", 0.9)] + [("b", "y", 0.1)] * 30 + [("b", "z", 0.8)] * 3 + [(None, None, 0.4)]
    judged = written(spark.createDataFrame(rows, "host string, path string, p double"), "judged")
    sites, k = site_counts(judged)
    got = {(r["host"], r["path"]): r["prior"] for r in judged.join(sites, (judged["host"].eqNullSafe(sites["host"])) & (
        judged["path"].eqNullSafe(sites["path"]))).select(judged["host"], judged["path"], k.prior(judged["p"], 1).alias("prior")).collect()}
    n_b, good_b = 33, 30 * 0.1 + 3 * 0.8

    def want(host_good, host_n, path_good, path_n):
        host = (host_good + k.host * k.overall) / (host_n + k.host)
        return (path_good + k.path * host) / (path_n + k.path)

    assert got["a", "x"] == pytest.approx(k.overall) and got[None, None] == pytest.approx(k.overall)
    assert got["b", "z"] == pytest.approx(want(good_b - 0.8, n_b - 1, 1.6, 2))
    assert got["b", "y"] == pytest.approx(want(good_b - 0.1, n_b - 1, 2.9, 29))
