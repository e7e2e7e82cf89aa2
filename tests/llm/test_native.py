"""Operators made of DataFrame functions only: content sort, mixing, url rules."""

import hashlib
import re

from barproof.llm import content_sort, mixing, url_filter


def dedup(docs):
    return {r["doc_id"]: r for r in content_sort.content_sort_dedup(docs).collect()}


def test_equal_content_keeps_the_longest_original_then_the_smallest_id(documents):
    rows = [(3, "a b"), (1, "ab"), (2, "a\tb"), (4, "a\u00a0b"), (5, None), (6, " \n"), (7, "AB")]
    found = dedup(documents(rows))
    assert [found[i]["keep_id"] for i in range(1, 8)] == [2, 2, 2, 4, 6, 6, 7]
    assert [found[i]["group_size"] for i in range(1, 8)] == [3, 3, 3, 1, 2, 2, 1]
    assert {i for i in found if found[i]["kept"]} == {2, 4, 6, 7}
    assert found[1]["text_sha256"] == hashlib.sha256(b"ab").hexdigest()


def test_texts_with_a_common_head_are_apart_and_a_large_group_is_one(documents):
    head = "x" * 500
    rows = [(i, head + str(i % 3)) for i in range(300)] + [(i, head + "y" * 50_000) for i in range(300, 310)]
    found = dedup(documents(rows))
    assert [found[i]["keep_id"] for i in (0, 1, 2, 299, 305)] == [0, 1, 2, 2, 300]
    assert found[0]["group_size"] == 100 and found[309]["group_size"] == 10


def test_content_sort_takes_repeated_rows_null_ids_and_no_rows(documents):
    rows = content_sort.content_sort_dedup(documents([(1, "a"), (1, "a"), (None, "a"), (None, "b")])).collect()
    assert sorted((r["doc_id"] or 0, r["keep_id"], r["group_size"], r["kept"]) for r in rows if r["keep_id"]) == [
        (0, 1, 3, False), (1, 1, 3, True), (1, 1, 3, True)
    ]
    assert content_sort.content_sort_dedup(documents([])).count() == 0


def mixed(docs):
    return mixing.mix(docs).collect()


def test_targets_are_shared_by_weight_and_capped(documents):
    rows = [(i, "w " * 10, None, "a") for i in range(10)]
    rows += [(100 + i, "w " * 10, None, "b") for i in range(10)]
    rows += [(200, "w", None, "c"), (300, None, None, None)]
    found = mixed(documents(rows))
    targets = {r["source_size"]: r["target"] for r in found}
    # c reaches 3 times its size; the rest is shared 5 : 2. The null source is last and has no words.
    assert targets[1] == 3 and targets[0] == 0
    by_doc = {r["doc_id"]: r for r in found}
    assert abs(by_doc[0]["target"] - 198 * 5 / 7) < 1e-9 and abs(by_doc[100]["target"] - 198 * 2 / 7) < 1e-9
    for source in (range(10), range(100, 110)):
        taken = sum(by_doc[i]["taken"] for i in source)
        assert abs(taken - by_doc[source[0]]["target"]) <= 5
        assert all(by_doc[i]["taken"] in (0, 10, 20, 30) for i in source)
    assert by_doc[200]["taken"] == 3 and by_doc[300]["taken"] == 0


def test_mix_is_near_its_targets_for_many_sizes_and_reruns_agree(documents):
    rows = [(i, "w " * (i * 7 % 23), None, f"s{i % 4}") for i in range(2000)]
    docs = documents(rows)
    first = {r["doc_id"]: r["taken"] for r in mixed(docs)}
    assert first == {r["doc_id"]: r["taken"] for r in mixed(docs.repartition(5))}
    found = mixed(docs)
    for source in range(4):
        own = [r for r in found if r["doc_id"] % 4 == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 22
        assert all(r["taken"] <= 3 * r["size"] for r in own)


def test_mix_takes_repeated_rows_and_no_rows(documents):
    found = mixed(documents([(1, "a b", None, "x")] * 3 + [(None, "c", None, "x")]))
    assert len(found) == 4 and {r["taken"] for r in found if r["doc_id"] == 1} <= {0, 2, 4, 6}
    assert mixed(documents([])) == []


def test_mixed_rows_have_the_columns_and_the_words_of_the_mix(documents):
    docs = documents([(i, "w " * 5, None, "ab"[i % 2]) for i in range(40)])
    rows = mixing.mixed_rows(docs)
    assert rows.columns == docs.columns
    assert rows.count() * 5 == sum(r["taken"] for r in mixed(docs))


URLS = [
    "http://a.net/x", "https://A.Example.NET/en/1?q", "http://example.net/en", "http://example.com/de/", "ftp://x.org/fr/1",
    "http://org/fr/", "http://xorg/fr/", "http://a.net", "no scheme", None, "http://example.com/fr/#de", "http:///p", "x://net/",
    "http://..net/", "http://sub.example.com/de/a\nb", "http://a.net/x",
]


def plain_verdict(url, rules):
    match = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (match[1].lower(), match[2]) if match else ("", "")
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def test_urls_are_judged_by_their_longest_rule(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    deep = (("net", "/", "block"), ("net", "/x", "allow"), ("example.net", "", "block"), ("example.net", "/en/1", "allow"))
    for rules in (url_filter.RULES, deep):
        found = url_filter.url_filter(pages, url_filter.rules_frame(spark, rules)).collect()
        assert len(found) == len(URLS)
        for r in found:
            assert tuple(r)[1:] == plain_verdict(URLS[r["page_id"]], rules)


def test_url_rules_and_pages_may_be_missing(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [r["verdict"] for r in url_filter.url_filter(pages, none).collect()] == ["allow"]
    assert url_filter.url_filter(pages.limit(0), url_filter.rules_frame(spark)).count() == 0
