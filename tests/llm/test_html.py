import html
import random
from html.parser import HTMLParser

from cohortcraft.llm import block_labeller as B
from cohortcraft.llm.html_blocks import blocks


def test_blocks_and_references():
    page = (
        "<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t='</p><p>no';</script></head><body>"
        "<!-- no <p>no --><nav><ul><li><a href='/x'>Home</a><li>More</ul></nav><article><h1>A &amp; B&nbsp;&eacute;</h1>"
        "<p><b>one\n  two<br>three<p>four <i>fi</i>ve</p>tail<table><tr><td>c1<td>c2</table></article><footer>&copy; x</footer>"
    )
    found = blocks(page)
    assert [b.text for b in found] == ["Home", "More", "A & B é", "one two three", "four five", "tail", "c1", "c2", "© x"]
    assert found[0].path == ("html", "body", "nav", "ul", "li", "a") and found[0].link_chars == 4
    assert [B.weak_label(b.path) for b in found] == [0, 0, 1, 1, 1, 1, 1, 1, 0]


def test_formulas_and_fallback_texts_are_kept():
    page = (
        "<article><p>Energy <math><mi>E</mi><mo>=</mo><mi>m</mi></math> is kept <object data='x'>see the figure</object> to the "
        "<svg viewBox='0 0 1 1'><title>icon</title><text>axis</text></svg> end</p><noscript><p>Plain version.</p></noscript>"
        "<textarea>typed</textarea><select><option>one</select><iframe src='x'>frame</iframe><template><p>later</p></template></article>"
    )
    assert [b.text for b in blocks(page)] == ["Energy E=m is kept see the figure to the axis end", "Plain version."]


def test_broken_markup_does_not_crash():
    for page in (None, "", "<", "<p", "<a href=\"x>y", "<!-- open", "</p></div>text", "<script>never closed", "a < b > c", "<p>" * 3000 + "x", "<![CDATA[raw]]>", "İ<script>x</script>y"):
        blocks(page)
    assert [b.text for b in blocks("<div class='x>y'>a</div>")] == ["a"]


def test_labels_follow_the_article(spark):
    """The texts of given pages: everything inside the article, nothing else."""
    from cohortcraft.llm.queries import QUERIES

    rows = {r.page_id: r for r in QUERIES["op8_html_extraction"](spark, "/root/testdata/sf0.01").collect()}
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    assert len(rows) == len(pages)
    wrong = 0
    for p in pages:
        body = (p.html or "").split("<article>")[-1].split("</article>")[0]
        expected = "\n".join(b.text for b in blocks(body))
        wrong += rows[p.page_id].text != expected
        assert rows[p.page_id].n_chars == len(rows[p.page_id].text)
    assert wrong <= 0.01 * len(pages)


class ArticleText(HTMLParser):
    """Lines of text inside ``article`` by the standard library's parser."""

    PARTS = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol blockquote div section figure figcaption table tr td th pre dl dt dd article".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.raw, self.parts, self.lines = 0, 0, [], []

    def flush(self):
        line = " ".join("".join(self.parts).split())
        if line:
            self.lines.append(line)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in self.PARTS:
            self.flush()
        self.inside += tag == "article"
        self.raw += tag in ("script", "style")
        if tag == "br":
            self.parts.append(" " if self.inside else "")

    def handle_endtag(self, tag):
        if tag in self.PARTS:
            self.flush()
        self.inside -= tag == "article"
        self.raw -= tag in ("script", "style")

    def handle_data(self, data):
        if self.inside > 0 and not self.raw:
            self.parts.append(data)


def test_texts_equal_another_parser(spark):
    from cohortcraft.llm.queries import QUERIES

    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    rows = QUERIES["op8_html_extraction"](spark, "/root/testdata/sf0.001").collect()
    right = 0
    for r in rows:
        parser = ArticleText()
        parser.feed(pages[r.page_id] or "")
        parser.close()
        right += r.text == "\n".join(parser.lines)
    assert len(rows) == len(pages) and right >= 0.98 * len(rows)


def _page(rng, content, around):
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    body = [f"<p>{words(rng.randrange(15, 60))}</p>" for _ in range(rng.randrange(2, 8))]
    good = "\n".join(b.text for b in blocks("".join(body)))
    opened, closed = content
    parts = [f"{a}{words(4)}{b}" for a, b in around]
    return "<html><body>" + "".join(parts[:2]) + opened + "".join(body) + closed + "".join(parts[2:]) + "</body></html>", good


def test_other_templates_are_understood():
    rng = random.Random(4)
    around = [("<header>", "</header>"), ("<ul class='menu'><li><a href='#'>", "</a></li></ul>"), ("<aside>", "</aside>"), ("<div class='cookie'>", "</div>"), ("<form>", "</form>"), ("<section class='comments'><p>", "</p></section>")]
    train = [_page(rng, ("<article>", "</article>"), [("<nav><ul><li>", "</li></ul></nav>"), ("<div class='ad'>", "</div>"), ("<footer>", "</footer>")])[0] for _ in range(150)]
    model = B.train([blocks(x) for x in train])
    right = 0
    for _ in range(40):
        page, good = _page(rng, rng.choice([("<main>", "</main>"), ("<div class='post'>", "</div>"), ("<article>", "</article>")]), around)
        found = blocks(page)
        right += "\n".join(b.text for b, keep in zip(found, B.label(model, [found])[0], strict=True) if keep) == good
    assert right >= 36


def test_edges(spark):
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert B.fit(empty) is None and B.main_text(empty, None).count() == 0
    rows = spark.createDataFrame([(1, None, None), (1, "u", ""), (None, "u", "<article><p>" + html.escape("a<b") + "</p></article>")], "page_id bigint, url string, html string")
    got = B.main_text(rows, B.fit(rows)).collect()
    assert len(got) == 3 and [r.text for r in got][:2] == ["", ""]
