"""Rare verdicts are learned too."""

from jobstrata.llm import url_filter


def test_one_percent_blocked(spark):
    """Blocked URLs that one suffix tells apart are found when they are one in a hundred, whatever else varies."""
    urls = [(k, f"http://{'h9.org' if k % 100 == 37 else f'h{k % 7}.com'}/p{k}") for k in range(3000)]
    urls += [(3000 + k, f"http://x{k % 10}.org/p{k + 500}") for k in range(20)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    rules = [url_filter.Rule("allow", "com/"), url_filter.Rule("block", "h9.org/")]
    found = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, rules).collect()}
    assert all(found[3000 + k] == "block" for k in range(20))
