from pressroom.operators.html import PageFacts, page_facts


def facts(page, *title_path):
    parser = PageFacts(title_path or ("header", "h1"))
    parser.feed(page)
    parser.close()
    title = None if parser.title is None else "".join(parser.title).strip()
    return title, parser.published, parser.excluded


META = '<meta property="article:published_time" content="2022-03-04T05:06:07+00:00">'


def test_title_and_date():
    page = f"<html><head>{META}</head><body><header><h1> A &amp; <b>B</b><br> </h1></header><h1>no</h1></body>"
    assert facts(page) == ("A & B", "2022-03-04T05:06:07+00:00", False)


def test_heading_outside_a_header_is_no_title():
    assert facts("<header>x</header><h1>T</h1>")[0] is None


def test_first_matching_heading_counts_and_ends_at_its_tag():
    assert facts("<header><div><h1>One</h1>tail</div><h1>Two</h1></header>")[0] == "One"


def test_first_date_counts_and_may_lack_content():
    assert facts('<meta property="article:published_time">' + META)[1] is None


def test_unclosed_and_stray_tags_do_not_confuse():
    page = "<header><p>x<img src=a><h1>T<i>!</h1></span></header><h1>later</h1>"
    assert facts(page)[0] == "T!"


def test_scripts_and_comments_are_no_title_text():
    assert facts("<header><h1>T<script>var h1 = '</h1';</script><!-- c --></h1></header>")[0] == "T"


def test_exclude_tag_only_counts_inside_primary():
    assert facts('<div id="primary"><article class="a tag-exclude">x</article></div>')[2]
    assert facts('<div id="primary"><p><img class="tag-exclude"></p></div>')[2]
    assert not facts('<div id="primary" class="tag-exclude"></div>')[2]
    assert not facts('<div id="primary"></div><p class="tag-exclude">')[2]
    assert not facts('<div id="primary"><p class="tag-excluded"></p></div>')[2]


def test_a_damaged_page_is_one_error_and_not_the_end(spark):
    pages = [("<header><h1>Good</h1></header>",), ("<header><h1>Bad</h1></header><![foo[bar]]>",), (None,)]
    found = spark.createDataFrame(pages, "body string").select(page_facts("body", "header", "h1").alias("f")).select("f.*").collect()
    assert [(r.title, r.excluded) for r in found] == [("Good", False), (None, False), (None, False)]
