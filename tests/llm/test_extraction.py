import pytest

from towertrace.llm import extraction as X

SCHEMA = "page_id bigint, url string, html string"


def main_text(html):
    blocks = X.read_blocks(html)
    main = X.main_zones({z for z, _ in blocks})
    return "\n\n".join(t for z, t in blocks if z in ((*main, X.HINTED) if main else (X.OTHER,)))


@pytest.mark.parametrize("html,want", [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"),
    ("<article><h1>A</h1><p>b <b>c</b>\n d<p>e<br>f</article>", "A\n\nb c d\n\ne f"),
    ("<nav><a>x</a></nav><article><p>a</p></article><footer>f</footer>", "a"),
    ("<header>h</header><main><header><h1>T</h1></header><p>a</p><aside>s</aside><form>f</form></main>", "T\n\na"),
    ("<article><p>a</p><div class='ad-slot ad'>buy</div><section id=comments><p>c</p></section><p>b</p></article>", "a\n\nb"),
    ("<article><p>a</p><article class=comment><p>c</p></article></article>", "a"),
    ("<div id=content><p>a</p><div class=sidebar>s</div></div><p>out</p>", "a"),
    ("<article>x<script>var a='</p><article>';</script><style>p{}</style><!-- <p>no</p> -->y</article>", "xy"),
    ("<article><p>5 &lt; 6 &#x41;&eacute;&nbsp;z &unknown; &amp", "5 < 6 Aé z &unknown; &"),
    ("<article><p title=\"a>b\">t</p><p>1 < 2</p><p class='broken>u</p>", "t\n\n1 < 2\n\nu"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table></article>", "a\n\nb\n\nc d\n\ne"),
    ("<article><p hidden>h</p><p style='display: none'>n</p><pre>a\n  b</pre></article>", "a b"),
    ("<div class=notice>n</div><div class='cookie-banner'>c</div><p>a</p>", "a"),
    ("<article><p>cut off <b", "cut off"),
    # furniture inside a line of text goes, and nothing around it
    ("<article><p>text <span class=\"ad\">BUY NOW</span> more</p></article>", "text more"),
    ("<article><p>one <span hidden>HID</span> more <label>L</label><button>B</button><select><option>o</select>.</p>", "one more ."),
    ("<article><p>real words <span class=\"share\">share<p>next</article>", "real words\n\nnext"),
    ("<article><p>a <b>bold<p>b</b> c</article>", "a bold\n\nb c"),
    # names that only hold a furniture word
    ("<div class=\"page has-sidebar\"><article><p>a</article></div>", "a"),
    ("<div class=\"layout-no-sidebar\"><main>a</main></div>", "a"),
    ("<div class=\"sidebar\"><p>s</p><article>teaser</article></div><article>a</article>", "a"),
    ("<div class=\"sidebar\"><p>s</p><article>only one</article></div>", "only one"),
    ("<article>a<section class=\"related-work\">work</section><blockquote class=\"reply\">said</blockquote></article>", "a\n\nwork\n\nsaid"),
    ("<article>a<div class=\"related-posts\">r</div><ul class=\"shareButtons\"><li>s</ul><div id=comment-list>c</div></article>", "a"),
    # content of embedded elements
    ("<article><p>Let <math>x=2</math> be.", "Let x=2 be."),
    ("<article><noscript>n</noscript><object>o</object><video>v</video><svg><title>t</title><text>s</text></svg>", "novs"),
    # end tags that match nothing, or not what is open
    ("<article><div>a</span></b></section>b</div></i>c</article></div>d", "ab\n\nc"),
    ("<article><div>a</p>b</div>", "a\n\nb"),
    ("<article><div><table><tr><td>a</div>b</td></tr></table>c</div></article>", "ab\n\nc"),
    ("<article><span class=ad>x<div>y</span>z</div></span>w</article>", "w"),
])
def test_blocks(html, want):
    assert main_text(html) == want


def test_repeated_passages_go_and_unique_runs_stay(spark):
    shared = "one two three four five six seven eight nine"
    rows = [(k, f"https://a.org/{k}", f"<div>{shared}</div><div>u{k} v{k} {shared} t{k}</div>") for k in range(4)]
    rows += [(10, "https://b.org/1", f"<div>{shared}</div>"), (11, "https://b.org/2", f"<p>{shared}</p><p>x</p>")]
    rows += [(20, "https://a.org/x", f"<article><p>{shared}</p></article><div>{shared}</div>")]
    got = {r.page_id: r for r in X.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[k].text for k in range(4)] == [f"u{k} v{k} t{k}" for k in range(4)]
    assert got[10].text == shared and got[11].text == f"{shared}\n\nx"  # two pages of a host are too few
    assert got[20].text == shared  # the main part stays
    assert got[0].n_chars == len(got[0].text) and got[0].n_covered == 18


def test_copies_of_a_page_are_one_stream_and_edge_cases(spark):
    page = "<p>" + " ".join(f"w{i}" for i in range(30)) + "</p>"
    rows = [(k, f"https://a.org/{k}", page) for k in range(6)] + [(7, None, None), (8, "x", ""), (8, "x", "")]
    df = spark.createDataFrame([(*r, "h", ["t"]) for r in rows], SCHEMA + ", host string, tokens array<string>")
    got = X.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars", "n_covered"]
    assert sorted((r.page_id, r.n_chars) for r in got.collect()) == [(k, len(page) - 7) for k in range(6)] + [(7, 0), (8, 0), (8, 0)]
    assert X.extract(df.where("false")).count() == 0


def test_two_pages_are_enough_in_the_query(spark, tmp_path):
    from towertrace.llm.queries import op1_html_extraction

    shared = "one two three four five six seven eight nine"
    rows = [(k, f"https://b.org/{k}", f"<div>{shared}</div><p>u{k}</p>") for k in (1, 2)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    assert {r.page_id: r.text for r in op1_html_extraction(spark, str(tmp_path)).collect()} == {1: "u1", 2: "u2"}


def plain_blocks(html):
    """The same rules with a list of open elements that is searched each time."""
    names, zones, pieces, blocks = [], [], [], []

    def zone():
        return zones[-1] if zones else X.OTHER

    def flush():
        for z in dict.fromkeys(z for z, _ in pieces):
            text = " ".join("".join(t for y, t in pieces if y == z).split())
            if text:
                blocks.append((z, text))
        pieces.clear()

    def place(*wanted):
        return max((i for i, n in enumerate(names) if n in wanted), default=-1)

    def cut(i):
        del names[i:], zones[i:]

    at = 0
    for found in X.TAG.finditer(html):
        if found.start() > at:
            pieces.append((zone(), html[at:found.start()]))
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        attributes = found[3] if found[2] else found[6]
        if not name:
            continue
        if found[1] or found[4]:
            i = place(name)
            if i < 0 or (name not in X.TABLE and place(*X.WALLS) > i):
                if name == "p":
                    flush()
                continue
            if name in X.BLOCK:
                flush()
            if name not in X.BLOCK | X.TABLE and any(n in X.BLOCK for n in names[i:]):
                names[i], zones[i] = "", zones[i - 1] if i else X.OTHER
            else:
                cut(i)
            continue
        if name in X.BLOCK:
            flush()
        ends = {"li": [("li", ("ul", "ol", "menu"))], "dt": [("dt", ("dl",)), ("dd", ("dl",))], "dd": [("dt", ("dl",)), ("dd", ("dl",))],
                "tr": [("tr", ("table",))], "td": [("td", ("tr", "table")), ("th", ("tr", "table"))],
                "th": [("td", ("tr", "table")), ("th", ("tr", "table"))], "option": [("option", ("select",))]}.get(name, [])
        if name in X.BLOCK - {"tbody", "thead", "tfoot", "caption"}:
            ends = [*ends, ("p", ("td", "th", "caption", "button", "table"))]
        for same, walls in ends:
            i = place(same)
            if i >= 0 and i > place(*walls):
                cut(i)
        if name in ("br", "td", "th"):
            pieces.append((zone(), " "))
        if name not in X.VOID:
            inside = X._Reader.zone_of(name, attributes, zone())
            names.append(name)
            zones.append(inside)
    pieces.append((zone(), html[at:]))
    flush()
    return blocks


@pytest.mark.parametrize("seed", range(4))
def test_random_pages_against_a_plain_reader(seed):
    import random

    rnd = random.Random(seed)
    names = ["p", "div", "span", "b", "article", "section", "ul", "li", "table", "tr", "td", "th", "dl", "dt", "dd", "blockquote", "h1", "option", "select"]
    classes = ["", "", "", ' class="ad"', ' class="related-work"', ' id="sidebar"', ' class="content"', " hidden"]
    for _ in range(400):
        html = ""
        for _ in range(rnd.randrange(25)):
            n = rnd.choice(names)
            html += rnd.choice([f"<{n}{rnd.choice(classes)}>", f"<{n}>", f"</{n}>", f"t{rnd.randrange(99)} ", " x", "<br>"])
        assert X.read_blocks(html) == plain_blocks(html), html


@pytest.mark.parametrize("page", ["<div>x</b>", "<b>y", "<p><i>z</div></p>", "<ul><li>a</span>", "<table><tr><td></p>", "<a \"", "</div><span class='ad'>"])
def test_long_broken_pages_take_linear_time(page):
    import time

    started = time.time()
    X.read_blocks(page * (1_000_000 // len(page)))
    assert time.time() - started < 8  # about 1 s on a quiet machine; quadratic would be minutes


def test_hinted_parts_are_decided_by_the_host(spark):
    """A part whose class only hints at furniture goes where pages share it."""
    shared = "see also our other pages on this and that topic"
    rows = [(k, f"https://a.org/{k}", f"<article><p>a{k}</p><div class='related-stuff'>{shared}</div><p>z{k}</p></article>") for k in (1, 2)]
    rows += [(3, "https://a.org/3", "<article><p>a3</p><section class='related-work'>the work of others is cited here at some length</section></article>")]
    got = {r.page_id: r.text for r in X.extract(spark.createDataFrame(rows, SCHEMA), min_pages=2).collect()}
    assert got == {1: "a1\n\nz1", 2: "a2\n\nz2", 3: "a3\n\nthe work of others is cited here at some length"}
