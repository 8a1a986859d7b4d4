from datetime import date

import pytest
from pyspark.sql import functions as F

from crowdlane.functions import pages, text


def one(spark, column, value):
    df = spark.createDataFrame([(value,)], "s STRING")
    return df.select(column("s").alias("x")).first()["x"]


@pytest.mark.parametrize(
    "line, start, end, multi",
    [
        ("February 13, 2026, February 14, 2026", date(2026, 2, 13), date(2026, 2, 14), True),
        ("February 13, 2026, February 13, 2026", date(2026, 2, 13), date(2026, 2, 13), False),
        ("Mar 1, 2026, Mar 2, 2026, Mar 9, 2026", date(2026, 3, 1), date(2026, 3, 9), True),
        ("Doors Feb 13, 2026 only", date(2026, 2, 13), date(2026, 2, 13), False),
        ("On February 13", None, None, False),
        ("Feb 13, 2026 at the hall", date(2026, 2, 13), date(2026, 2, 13), False),
        ("Feb 11 - Mar 3", date(2025, 2, 11), date(2025, 3, 3), True),
        ("Feb 11 - Foo 3", date(2025, 2, 11), None, False),
        ("february 13", date(2025, 2, 13), date(2025, 2, 13), False),
        ("February 29", None, None, False),
        ("February 29, 2024", date(2024, 2, 29), date(2024, 2, 29), False),
        ("Sept 3", None, None, False),
        ("Ongoing", None, None, False),
        ("", None, None, False),
        (None, None, None, False),
    ],
)
def test_parse_dates(spark, line, start, end, multi):
    got = one(spark, lambda c: text.parse_dates(c, 2025), line)
    assert (got["start_date"], got["end_date"], got["is_multi_day"]) == (start, end, multi)


def test_29_february_needs_a_year_even_in_a_leap_year(spark):
    assert one(spark, lambda c: text.parse_dates(c, 2024), "February 29")["start_date"] is None


@pytest.mark.parametrize(
    "line, start, end",
    [
        ("12 AM to 1:30 PM", 0, 13 * 3600 + 1800),
        ("7:00 PM - 9 pm", 19 * 3600, 21 * 3600),
        ("12 PM", 12 * 3600, None),
        ("730 PM", 19 * 3600 + 1800, None),
        ("13 AM", 13 * 3600, None),
        ("13 PM", None, None),
        ("All day", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_parse_time_range(spark, line, start, end):
    got = one(spark, text.parse_time_range, line)
    assert (got["start_sec"], got["end_sec"]) == (start, end)


@pytest.mark.parametrize(
    "line, expected",
    [
        ("$5 to $12.50", (5.0, 12.5, "$5 to $12.50")),
        ("Free", (0.0, 0.0, "Free")),
        ("Kids are FREE, others $5", (0.0, 0.0, "Free")),
        ("Freedom pass $9", (9.0, 9.0, "Freedom pass $9")),
        ("$1,000", (0.0, 1.0, "$1,000")),
        (" TBD ", (None, None, "TBD")),
        ("", (None, None, None)),
        (None, (None, None, None)),
    ],
)
def test_parse_cost(spark, line, expected):
    assert tuple(one(spark, text.parse_cost, line)) == expected


def test_contacts_and_category(spark):
    assert one(spark, text.clean_phone, "+1 (505) 555-0142 x") == "5055550142"
    assert one(spark, text.clean_phone, " ext. 12 ") == "ext. 12"
    assert one(spark, text.clean_phone, "  ") is None
    assert one(spark, text.clean_email, "mail a.b-c@x-y.example.org!") == "a.b-c@x-y.example.org"
    assert one(spark, text.clean_email, " none ") == "none"
    assert one(spark, text.extract_category, '{"crmCatSubcat":  "Arts%20%26%20C+D"}') == "Arts & C+D"
    assert one(spark, text.extract_category, '{"crmCatSubcat": "50% off"}') == "50% off"
    assert one(spark, text.extract_category, "{}") is None


HTML = """<html><h1 id=x> Jazz &amp; Blues <em>Night</em> &#8211; 2 &#x27;a&#X00e9; &#36;1 &amp;lt;</h1>
<ul class="links"><li data-name="dates"><span class="info-list-value">No</span></li></ul>
<UL data-gtm-vars='{"crmCatSubcat": "Music"}' class="wide detail-info">
<li data-name="dates"><b>When</b><span class='x info-list-value'>Feb 11 - Mar 3</span></li>
<li data-name="time"><span class="info-list-value">7 PM to 9 PM</span></li>
<li data-name="location"><span class="info-list-value-old">Old</span></li>
<li data-name="location"><span class="info-list-value">First</span></li>
<li class="info" data-name="location"><span class="info-list-value"> The <i>Hall</i> </span></li>
<li data-name="price"><p>no value here</p></li>
<li class="website-x"><a href="https://no.example.org">Website</a></li>
<li class="website"><a href='https://t.example.org?a=1&amp;b=2'>Get Tickets on our website</a></li>
<li class="big website"><a href="https://w.example.org">Visit <b>Website</b></a></li>
</ul>"""


def test_page_fields(spark):
    df = spark.createDataFrame([(1, "u1", HTML), (2, "u2", "<h1>No list</h1>"), (3, "u3", None)], "page_id INT, url STRING, html STRING")
    got = pages.page_fields(df, 2025).collect()
    assert [r["page_id"] for r in got] == [1]
    r = got[0].asDict()
    assert r["event_name"] == "Jazz & BluesNight– 2 'aé $1 &lt;"
    assert (r["event_start_date"], r["event_end_date"], r["is_multi_day"]) == (date(2025, 2, 11), date(2025, 3, 3), True)
    assert (r["start_sec"], r["end_sec"]) == (19 * 3600, 21 * 3600)
    assert r["venue_name"] == "TheHall" and r["category"] == "Music" and r["sponsor"] == ""
    assert r["cost_description"] is None and r["phone"] is None
    assert r["ticket_url"] == "https://t.example.org?a=1&b=2"
    assert r["website_url"] == "https://w.example.org"


def test_whole_long_page_is_read(spark):
    filler = "<p>x</p>" * 20000
    html = HTML.replace("<b>When</b>", filler).replace("<html>", "<html>" + filler)
    df = spark.createDataFrame([(1, "u", html)], "page_id INT, url STRING, html STRING")
    r = pages.page_fields(df, 2025).first()
    assert r["event_start_date"] == date(2025, 2, 11) and r["website_url"] == "https://w.example.org"
    assert df.select(F.length("html").alias("n")).first()["n"] > 300000


def test_references_are_decoded_once(spark):
    cases = {
        "&#38;lt; &amp;lt; &amp;#60;": "&lt; &lt; &#60;",
        "&#x1F600;&#128512;": "\U0001f600\U0001f600",
        "&#x110000; &#xD800;": "\ufffd \ufffd",
        "&lt;&#62;&#x41;": "<>A",
        "&eacute;&hellip;&ldquo;&CounterClockwiseContourIntegral;": "é…“∳",
        "&unknown; & co": "&unknown; & co",
    }
    df = spark.createDataFrame([(c, f"<h1>{c}</h1>") for c in cases], "c string, html string")
    assert {r[0]: r[1] for r in df.select("c", pages.page_title("html")).collect()} == cases


@pytest.mark.parametrize(
    "items, expected",
    [
        # an element of the same name inside a value
        ('<li data-name="location"><span class="info-list-value">Hall <span>A</span> West</span></li>', {"venue_name": "HallAWest"}),
        # a list inside the list does not end it
        ('<li><ul><li>x</li></ul></li><li data-name="location"><span class="info-list-value">L</span></li>', {"venue_name": "L"}),
        # attributes without quotes, void and self-closed elements
        ("<li data-name=host/><br/><img src=x><li data-name=host><span class=info-list-value>H<br>I</span></li>", {"sponsor": "HI"}),
        # comments, scripts and what stands behind the list are no items
        (
            '<li data-name="location"><span class="info-list-value">Live</span></li>'
            '<!-- <li data-name="location"><span class="info-list-value">Old</span></li> -->'
            '<script>"<li data-name=location><span class=info-list-value>S</span></li>"</script></ul>'
            '<li data-name="location"><span class="info-list-value">After</span></li>',
            {"venue_name": "Live"},
        ),
        # an item takes the first value inside it, also that of an item it holds
        (
            '<li data-name="location">In <ul><li data-name="host"><span class="info-list-value">V</span></li></ul></li>',
            {"venue_name": "V", "sponsor": "V"},
        ),
        # items without end tags hold those that follow; stray end tags do nothing
        ('<li data-name="location"></b><span class="info-list-value">A</em>B</span><li class=website><a href=u>Website', {"venue_name": "AB", "website_url": "u"}),
        # the second span and link of an item do not count, and a link may lack its target
        (
            '<li data-name="host"><span class="info-list-value">1</span><span class="info-list-value">2</span></li>'
            '<li class="website"><a>Tickets</a><a href="no">Website</a></li>',
            {"sponsor": "1", "ticket_url": "", "website_url": None},
        ),
    ],
)
def test_pages_are_read_by_their_nesting(spark, items, expected):
    html = f"<p><h1>T</h1><ul class='a detail-info'>{items}</ul>"
    df = spark.createDataFrame([(1, "u", html)], "page_id INT, url STRING, html STRING")
    got = pages.page_fields(df, 2025).first().asDict()
    assert {k: got[k] for k in expected} == expected


def test_odd_pages(spark):
    rows = [(1, ""), (2, "<"), (3, "<ul class=detail-info>"), (4, "<ul class='detail-info'/><h1>x"), (5, "<![CDATA[ <!doctype <!-- <ul class=detail-info>")]
    df = spark.createDataFrame([(i, "u", h) for i, h in rows], "page_id INT, url STRING, html STRING")
    got = {r["page_id"]: r["event_name"] for r in pages.page_fields(df, 2025).collect()}
    assert got == {3: None, 4: "x"}
    assert pages.page_fields(df.limit(0), 2025).collect() == []


def test_calls_of_any_provider_count(spark):
    from frames import meas, probe

    from crowdlane.operators.aggregates import usage_7day_pivot

    rows = [probe(1), probe(2, data_source="here"), probe(3, minutes=1440, data_source="osm"), probe(4, minutes=1440, data_source=None)]
    got = usage_7day_pivot(meas(spark, rows), "2024-01-05 00:00:00").collect()
    assert [(r["tomtom"], r["other_calls"], r["total_calls"]) for r in got] == [(0, 2, 2), (1, 1, 2), (1, 3, 4)]
    assert got[2]["avg_per_day"] == 4 / 7


def test_plain_pages_need_no_tolerant_reader(monkeypatch):
    import html.parser

    import pyarrow as pa

    plain = [
        HTML,
        "<!DOCTYPE html><title>x</title><script>if (a<b) x='<li data-name=host>'</script><!-- <h1>no</h1> --><H1/>"
        "<ul class=detail-info><LI data-name=host>a<li data-name=\"location\"><SPAN class='info-list-value'>A<br>B &amp <b>C</b></span></LI></ul>",
        "<ul class=detail-info></ul><h1>T</h1><li data-name=host><span class=info-list-value>after</span>",
    ]
    odd = [p + "<p <b>" for p in plain[1:]] + [plain[1].replace("</title>", "</title>< <b a='>'>"), plain[2].replace(">T<", ">T<!-- a--b -->U<")]
    tolerant = html.parser.HTMLParser.feed
    calls = []
    monkeypatch.setattr(html.parser.HTMLParser, "feed", lambda self, data: (calls.append(data), tolerant(self, data))[1])
    read = pages._reader(pages.FIELDS)
    got = read(pa.array([*plain, None])).to_pylist()
    assert calls == []
    assert [r["title"] for r in got] == ["Jazz & BluesNight– 2 'aé $1 &lt;", "", "T", None]
    assert (got[1]["location"], got[1]["host"], got[2]["host"]) == ("AB &C", "AB &C", None)
    # markup that leaves a doubt goes through the tolerant reader, with the same rules
    assert [r["location"] for r in read(pa.array(odd)).to_pylist()] == ["AB &C", None, "AB &C", None]
    assert len(calls) == 2  # what stands behind the heading and the list is not asked for
