import pytest

from docmill.functions.html import Selector, one_line, page_markdown, parse_html, to_markdown
from docmill.operators.sections import normal_markdown, resolve_link


def md(html):
    return to_markdown(parse_html(html))


def test_rendering():
    assert md("<h2>A <b>b</b></h2><p>x<br>y</p><p>z") == "## A **b**\n\nx  \ny\n\nz"
    assert md("<ul><li>one<li>two<ol><li>in</ol></ul>") == "* one\n* two\n  1. in"
    assert md("<table><tr><th>A<th>B<tr><td>1<td>2</table>") == "| A | B |\n| --- | --- |\n| 1 | 2 |"
    assert md("<pre>a &lt; b\n  c</pre>") == "```\na < b\n  c\n```"
    assert md("a <code>x_y</code> <a href='u'>t</a> <em>e</em><script>no</script>") == "a `x_y` [t](u) *e*"
    assert md("<p>one<p>two<div>three</div>") == "one\n\ntwo\n\nthree"


def test_selectors():
    tree = parse_html("<div id=a class='x y'><p class=z>1</p><span><p>2</p></span></div><p data-k=v>3</p>")
    texts = lambda s: [n.text() for n in Selector(s).select(tree)]
    assert texts("div p") == ["1", "2"] and texts("div > p") == ["1"] and texts("#a .z") == ["1"] and texts("p[data-k]") == ["3"]
    assert texts("p[data-k=v], .z") == ["1", "3"] and texts("div.x.y p.z") == ["1"] and texts("*[data-k^='v']") == ["3"]
    with pytest.raises(ValueError):
        Selector("p:first-child")


def test_content_region_drop_and_links():
    title, text = page_markdown("<html><head><title> Page </title></head><body><nav>Menu</nav><div class='c d'><h2>edge_terms</h2><p>See <a href='x.html'>Foo_bar</a>.</p><p class=n>note</p></div></body>", "div.c", ["p.n"], [], "https://e.org/p/")
    assert title == "Page" and text == "## edge_terms\n\nSee [Foo_bar](https://e.org/p/x.html)."
    with pytest.raises(ValueError):
        page_markdown("<p>x</p>", "div.none")


def test_flattening_makes_one_line_of_code():
    html = "<body><div class=sig><div>template&lt;typename T &gt;</div><table><tr><td><table><tr><td>void A::Run</td><td>(</td><td>T &amp;&#160;</td><td><em>info</em>, </td></tr><tr><td></td><td></td><td>const <a href=x>ns::V</a> &amp;&#160;</td><td><em>x</em>&#160;)</td></tr></table></td><td><span>inline</span></td></tr></table></div><p>Runs.</p></body>"
    _, text = page_markdown(html, None, [], ["div.sig"])
    assert text == "```\ntemplate<typename T > void A::Run(T & info, const ns::V & x) inline\n```\n\nRuns."
    assert one_line(" a ( b , c ) ") == "a(b, c)"


def test_listings_anchors_and_images():
    _, text = page_markdown("<body><div class=fragment><div class=line><span class=lineno> 1</span>int&#160;a;</div><div class=line>b;</div></div><a name=q></a><h3>H</h3><section id=s><h4>T</h4></section><h5><a id=i></a>U</h5><img alt='E=mc2' src=x></body>")
    assert "```\nint a;\nb;\n```" in text and "DOCMILL-ANCHOR:q\n\n### H" in text and "DOCMILL-ANCHOR:s\n\n#### T" in text and "DOCMILL-ANCHOR:i\n\n##### U" in text and "E=mc2" in text


def test_markdown_links_and_protected_code():
    base = "https://e.org/howto/mesh/"
    assert resolve_link(base, "other.md#x", directory_style=True) == "https://e.org/howto/other/#x"
    assert resolve_link(base, "../index.md", directory_style=True) == "https://e.org/"
    assert resolve_link(base, "a.md", index_page=True, directory_style=True) == "https://e.org/howto/mesh/a/"
    assert resolve_link(base, "a.md") == "https://e.org/howto/mesh/a.md" and resolve_link(base, "http://[bad") == "http://[bad"
    text = "See [a](b.md) and ![i](p.png) and `[c](d.md)`.\n\n```\n[e](f.md) <b>\n```\n<b>bold</b> end\n"
    got = normal_markdown(text, base, directory_style=True)
    assert "[a](https://e.org/howto/b/)" in got and "![i](p.png)" in got and "`[c](d.md)`" in got and "```\n[e](f.md) <b>\n```" in got and "**bold** end" in got
