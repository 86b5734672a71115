import html
import re

from llm_helpers import wide

from fleetlake.llm import tree_extract as t


def article(page):
    """The generated pages' article, read off their one fixed form."""
    inside = re.search(r"<article>(.*?)(</article>|$)", page, re.S).group(1)
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h\d)>", inside)]
    return "\n\n".join(b for b in blocks if b)


def test_whole_table(load):
    pages = {r["page_id"]: r for r in load("pages").collect()}
    rows = t.extract(load("pages")).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == article(pages[r["page_id"]]["html"]) and r["url"] == pages[r["page_id"]]["url"]


BESIDE = """<header><a href=/>Home, news, and more</a></header><nav><ul><li>One<li>Two</ul></nav>
<div id="cookie-notice">We use cookies, you know, and hope that this is fine with you.</div>"""
PROSE = "<p>First paragraph, with commas, and long enough to score well, one would hope.</p>"


def test_parts_beside_the_article_go():
    page = f"""<html><body class="page">{BESIDE}<div id=wrap><div class=content><h2>Title</h2>{PROSE}
    <p>Second &amp; last&nbsp;one, with <b>bold</b> and<br>a <a href=x>link</a> in it, surely enough.
    <ul><li>one<li>two</ul><div class="share-links"><a>Tweet</a></div><form>Name <input></form>
    <div class="ad-slot">Buy, buy, buy, buy this very good thing today, please.</div></div>
    <div class=sidebar>Other, things, that, have, many, commas, and are long enough.</div>
    <section id=comments><p>Nice article, thanks, very good, I liked it a lot.</p></section></div>
    <footer>&copy; us</footer></body></html>"""
    assert t.main_text(page) == "\n\n".join([
        "Title", "First paragraph, with commas, and long enough to score well, one would hope.",
        "Second & last one, with bold and a link in it, surely enough.", "one", "two"])


LONG = "<p>" + "A sentence of the paper that goes on for a while, as sentences do. " * 4 + "</p>"


def test_names_about_a_part_do_not_take_the_article():
    for name in ("content with-sidebar", "has-sidebar", "no-sidebar", "social-layout", "two-col-sidebar"):
        page = f'<body>{BESIDE}<div class="{name}">{PROSE * 3}<div class=sidebar>Some, words, beside.</div></div></body>'
        assert t.main_text(page).count("First paragraph") == 3 and "beside" not in t.main_text(page)
    page = f"""<article class="post comments-open"><h1>T</h1>{LONG}<h2 id="related-work">Related work</h2>{LONG}
    <h2><span id=search>Search</span></h2><section id="discussion"><h2 id=login>Discussion</h2>{PROSE}</section>
    <div class="related"><a href=/1>Another, one, to read, with a long name</a></div><div class=notice>{LONG}</div>
    <section id=comments>{LONG * 9}</section><div class=ad>{LONG}</div></article>"""
    blocks = t.main_text(page).split("\n\n")
    assert [b for b in blocks if len(b) < 30] == ["T", "Related work", "Search", "Discussion"]
    assert len(blocks) == 8 and "Another" not in t.main_text(page)


def test_a_page_that_names_would_empty_is_read_again():
    assert t.main_text(f"<body>{BESIDE}<div class=sidebar>{LONG * 3}</div></body>").count("A sentence") == 12
    page = f"<body><div><p>Short, but first of all.</p></div><div id=menu>{LONG * 5}</div><div id=comments>{LONG * 9}</div>"
    assert t.main_text(page).count("A sentence") == 20
    assert t.main_text("<body><div class=ad>Buy, buy, and buy again, today, please.</div></body>") == ""


def test_sections_in_wrappers_are_one_article():
    def section(i, n):
        return f"<div class=sec><h4>Part {i}</h4><div class=inner>{f'<p>Section {i}, with, commas, and some more words.</p>' * n}</div></div>"
    links = "<div>" + "<p><a href=/1>A link, with commas, and a long enough text</a></p>" * 9 + "</div>"
    for parts in ((4, 4, 4, 4), (9, 1, 1, 4), (3, 3), (1, 12, 1)):
        inner = "<ul><li>an item</ul>".join(section(i, n) for i, n in enumerate(parts))
        for page in (f"<body>{BESIDE}<div><div class=wrap>{inner}</div></div>{links}</body>", f"<body>{links}{inner}{links}</body>", inner):
            text = t.main_text(page)
            assert [text.count(f"Section {i}") for i in range(len(parts))] == [*parts]
            assert text.count("Part") == len(parts) and text.count("an item") == len(parts) - 1 and "A link" not in text
    small = f"<body><div>{PROSE * 9}</div><div><p>One plain paragraph of the same article.</p></div></body>"
    assert t.main_text(small).endswith("One plain paragraph of the same article.")


def test_link_lists_lose_to_prose():
    links = "".join(f"<p><a href=/{i}>A link, with commas, and a long enough text to score well</a></p>" for i in range(30))
    assert t.main_text(f"<body><div>{links}</div><div>{PROSE * 2}</div></body>").count("First paragraph") == 2
    assert "A link" not in t.main_text(f"<body><div>{links}</div><div>{PROSE * 2}</div></body>")


def test_edges(spark):
    pages = [(1, "u", None), (2, None, ""), (3, "u", "<"), (4, "u", "plain text"), (4, "u", "plain text"),
             (None, "u", "<p>a<p>b<script>var x = '<p>no</p>'"), (5, "u", "<div>" * 2000 + "deep"),
             (6, "u", f"<article>{PROSE * 3000}</article>"), (7, "u", "<article><p>cut <b off"), (8, "u", "<nav>only</nav>")]
    df = wide(spark.createDataFrame(pages, "page_id long, url string, html string"))
    got = sorted((str(r["page_id"]), r["url"], len(r["text"]), r["text"][:10]) for r in t.extract(df).collect())
    assert [(a, c, d) for a, _, c, d in got] == [
        ("1", 0, ""), ("2", 0, ""), ("3", 1, "<"), ("4", 10, "plain text"), ("4", 10, "plain text"), ("5", 4, "deep"),
        ("6", 3000 * 78 - 2, "First para"), ("7", 3, "cut"), ("8", 0, ""), ("None", 4, "a\n\nb")]
    assert t.extract(df.limit(0)).count() == 0


STORY = ["The harbour was quiet, and the boats lay still, until the first bell rang over the water at dawn.",
         "Nobody had expected the survey to take a whole year, yet the notes filled eleven boxes by the end.",
         "When the rain stopped, the children ran to the bridge, counted the barges, and went home again."]


def paragraphs(n=3):
    return "".join(f"<p>{p}</p>" for p in STORY[:n])


def test_no_page_is_lost_whole():
    body, whole = paragraphs(), "\n\n".join(STORY)
    menu = "".join(f'<a href="/{i}">Section {i}</a>' for i in range(9))
    assert t.main_text(f'<form id="aspnetForm"><div class="content">{body}</div><input></form>') == whole
    assert t.main_text(f"<body><noscript><div>{body}</div></noscript></body>") == whole
    assert t.main_text(f"<body><nav>{menu}<div>{body}</div></body>") == whole  # the menu is never closed
    assert t.main_text(f"<body><aside><div>{body}</div></body>") == whole
    # The same parts beside an article stay out.
    beside = (f"<nav>{menu}</nav><aside><p>Read this too, it is long enough to look like prose of its own.</p></aside>"
              "<noscript><p>Please switch on scripts to see the pictures of this page in full.</p></noscript>"
              "<form><p>Leave your address and we will write to you once a week, no more.</p></form>")
    assert t.main_text(f"<body>{beside}<div>{body}</div></body>") == whole
    assert t.main_text(f"<body>{beside}<article>{body}</article></body>") == whole


def test_a_fieldset_is_judged_by_its_prose():
    box = f"<fieldset><legend>Background</legend>{paragraphs(2)}</fieldset>"
    text = t.main_text(f"<article><p>{STORY[2]}</p>{box}</article>")
    assert all(p in text for p in STORY)
    form = "<fieldset><label>Name</label><input><label>Mail</label></fieldset>"
    assert t.main_text(f"<article>{paragraphs()}{form}</article>") == "\n\n".join(STORY)


def test_formulas_and_left_out_words_keep_the_sentence_whole():
    formula = ("<math><mrow><msup><mi>x</mi><mn>2</mn></msup><mo>+</mo><mi>y</mi></mrow>"
               "<annotation>x^2+y</annotation></math>")
    text = t.main_text(f"<article>{paragraphs()}<p>We minimise {formula} over all boats, as before.</p></article>")
    assert text.endswith("We minimise x2+y over all boats, as before.")
    text = t.main_text(f'<article>{paragraphs()}<p>Before <span class="ad">Buy now</span> and after.</p></article>')
    assert text.endswith("Before and after.")


def test_pages_without_article_elements(spark):
    """Generated pages whose only hint is how the text stands; truth by block."""
    import random
    draw, pages, truth = random.Random(4), [], {}
    for i in range(60):
        blocks = [f"{draw.choice(STORY)} Part {i}-{k}, told in full." for k in range(draw.randrange(3, 9))]
        wrap = draw.choice(['<div class="wrap"><div class="inner">{}</div></div>', "<div>{}</div>",
                            '<form id="f"><div>{}</div></form>', "<table><tr><td>{}</td></tr></table>"])
        menu = "".join(f'<li><a href="/{k}">Menu entry number {k}</a></li>' for k in range(12))
        foot = "<div class='footer'><p>All rights are with the owners of these pages, as ever.</p></div>"
        pages.append((i, "u", f"<html><body><ul>{menu}</ul>{wrap.format(''.join(f'<p>{b}</p>' for b in blocks))}{foot}"))
        truth[i] = "\n\n".join(blocks)
    got = {r["page_id"]: r["text"] for r in t.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == truth
