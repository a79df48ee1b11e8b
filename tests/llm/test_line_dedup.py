from pyspark.sql import functions as F

from seasonmart.llm.line_dedup import line_dedup, url_host
from tests.llm.conftest import ODD_ROWS


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_lines_over_the_ratio_go(documents):
    rows = [(i, f"menu\nown line {i}\n\n{'rare' if i < 4 else 'x' + str(i)}\nmenu") for i in range(40)]
    found = texts(line_dedup(documents(rows), max_ratio=0.1))
    assert found[0] == "own line 0\n\nrare"  # 4 of 40 pages are exactly a tenth
    assert found[9] == "own line 9\n\nx9"


def test_planted_lines_by_share(documents):
    """Lines on 2% of a site's pages and more go, rarer and own ones stay, whatever the site's size."""
    shares = {"one": 100, "two": 50, "five": 20, "ten": 10}
    sites = None
    for site, pages in (("large", 1000), ("middle", 200)):
        rows = [
            (i, "\n".join([*(name for name, every in shares.items() if i % every == 0), f"own {site} {i}"]))
            for i in range(pages)
        ]
        docs = documents(rows, source=site)
        sites = docs if sites is None else sites.union(docs)
    small = documents([(i, f"head\npair {i // 2}\nown {i}") for i in range(5)], source="small")
    for r in line_dedup(sites.union(small)).collect():
        lines = r.text.split("\n")
        assert lines[-1].startswith("own")
        if r.source == "small":
            assert lines == [f"pair {r.doc_id // 2}", f"own {r.doc_id}"]
        else:
            # A hundredth of the middle site are two pages, fewer than what makes a line common.
            assert lines[:-1] == (["one"] if r.doc_id % 100 == 0 else [])


def test_copies_of_a_page_are_one_page(documents):
    """A text that is copied often keeps its lines, and lines are not made rarer by copies."""
    rows = [(i, "copied first\ncopied second") for i in range(300)]
    rows += [(1000 + i, f"menu\nown {i}") for i in range(5)]
    found = texts(line_dedup(documents(rows)))
    assert found[7] == "copied first\ncopied second" and found[1003] == "own 3"


def test_hosts_of_addresses(spark):
    urls = [("https://www.Example.org:80/a?b",), ("http://sub.example.org/",), ("no address",), (None,)]
    found = spark.createDataFrame(urls, "url string").select(url_host("url")).collect()
    assert [r[0] for r in found] == ["example.org", "sub.example.org", None, None]


def test_a_page_counts_once_for_a_line(documents):
    rows = [(0, "\n".join(["again"] * 50)), *((i, f"line {i}") for i in range(1, 30))]
    assert texts(line_dedup(documents(rows)))[0].startswith("again")


def test_odd_rows(documents, spark):
    docs = documents(ODD_ROWS).union(documents([(50, "a\nb")]).withColumn("source", F.lit(None).cast("string")))
    found = line_dedup(docs, dropped="lines", min_seen=1, max_ratio=0.05)
    assert found.columns == docs.columns
    by_id = {r.doc_id: r for r in found.collect()}
    assert by_id[1].text is None and by_id[2].text == "" and by_id[50].text == "a\nb"
    assert by_id[6].text == "" and by_id[6].lines == 1  # every line is on a tenth of the pages
    assert by_id[3].text == "  " and by_id[9].text == ""  # a line with a tab is not blank
    kept = {r.doc_id: r.text for r in line_dedup(docs).collect()}
    assert kept[8] == "word " * 20_000 and kept[6] == "one two three four five six"
    assert found.count() == len(ODD_ROWS) + 1
    assert line_dedup(docs.limit(0)).collect() == []


def test_no_python(spark, documents):
    plan = line_dedup(documents([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
