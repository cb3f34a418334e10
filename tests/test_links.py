from conftest import frame, rows
from finfacts.operators.links import extract_links

HTML = """<ul><li><a href="/nav">Quick</a></li></ul>
<table><tr><td><a class="x" href="https://x.org/files/2020q1.zip">2020 Q1</a></td></tr>
<tr><td><A HREF="/files/2020q2.zip" title="t">2020 Q2</A><a href="/other">other</a></td></tr></table>
<a href="/after">Q</a><table><a href="z.zip">Q3</a></table>"""


def test_links_inside_tables(spark):
    pages = frame(spark, "page_id int, html string", (1, HTML), (2, "<p>none</p>"), (3, None))
    assert rows(extract_links(pages).select("page_id", "href", "link_text", "file_name")) == [
        (1, "/files/2020q2.zip", "2020 Q2", "2020q2.zip"),
        (1, "https://x.org/files/2020q1.zip", "2020 Q1", "2020q1.zip"),
        (1, "z.zip", "Q3", "z.zip")]


def test_links_anywhere(spark):
    pages = frame(spark, "page_id int, html string", (1, HTML))
    assert extract_links(pages, "Q", inside_table=False).count() == 5


def test_quotes_and_nested_tables(spark):
    html = """<table><tr><td><a href='/s/q1.zip'>Q1</a><table><a class=x href=/u/q2.zip>Q2</a></table>
    <a data-href="/no" title="t">Q no</a><a data-href="/no" href = "/d/q3.zip">Q3</a></td></tr></table>
    </table><a href='/out'>Q out</a>"""
    pages = frame(spark, "page_id int, html string", (1, html))
    assert rows(extract_links(pages).select("href", "link_text")) == [
        ("/d/q3.zip", "Q3"), ("/s/q1.zip", "Q1"), ("/u/q2.zip", "Q2")]
    assert extract_links(pages, inside_table=False).count() == 4
