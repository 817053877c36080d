import pytest

from docmill.llm.markup import clean_documents, clean_text, found_families, keep_between
from tests.llm.data import DATA

CASES = [
    ("html", "See <a href='x'>this</a>."), ("html", "a &rarr; b"), ("html", "x<!-- note -->y"), ("html", "<P CLASS=q>Text"), ("html", "<pre>**no** `x` [[a]]</pre>"),
    ("markdown", "# Title\ntext"), ("markdown", "Title\n=====\n"), ("markdown", "- item"), ("markdown", "1. item"), ("markdown", "a **b** c"), ("markdown", "a __b__ c"), ("markdown", "a *b*"),
    ("markdown", "[t](u/v.html)"), ("markdown", "![t](u.png)"), ("markdown", "> quoted"), ("markdown", "| a | b |\n| --- | --- |\n| 1 | 2 |"), ("markdown", "use `x`"), ("markdown", "```\n<b>[[x]]</b>\n```"), ("markdown", "~~~\n\\textbf{x}\n~~~"), ("markdown", "a\r\n\r\n* b\r\n"),
    ("wiki", "== Title =="), ("wiki", "see [[Page|label]] too"), ("wiki", "{{Note|a=b}}"), ("wiki", "a ''b c'' d"), ("wiki", "{|\n! a !! b\n|-\n| c || d\n|}"),
    ("latex", "The \\textbf{x} case"), ("latex", "in~\\cite{a:b}."), ("latex", "\\begin{itemize}\n  \\item x\n\\end{itemize}"), ("latex", "Here $x_{a} \\le b$ holds"), ("latex", "\\[ a \\]"), ("latex", "O(h) is \\(h^2\\)"),
]
PLAIN = [
    "std::vector<double> or, if n < 3 and m > 4, a Table<int> of x", "2 * 56 * 90 entries", "costs $79 per run, or $29 on the queue", "snake_case names of a_b_old", "#31 to #43", "C:\\temp\\abc and /var/tmp/x",
    "Tag with [[nodiscard]] when", "{{0, 1}, {2, 3}} for", "a|b|c and ~tilde", "'' is empty and \"\" too", "If a == b holds", "R&D [62] and [7]", "-option-name starts", "__init__ of x", "a*b*c", "AT&T; x", "", "call a[i](x)",
]


@pytest.mark.parametrize("family,text", CASES)
def test_constructs(family, text):
    assert clean_text(text)[0] == [family]


@pytest.mark.parametrize("text", PLAIN)
def test_lookalikes(text):
    families, clean, *_ = clean_text(text)
    assert families == [] and clean == text


def test_deeply_nested_commands_are_unwrapped():
    assert clean_text("a " + "\\textbf{\\emph{" * 5 + "x" + "}}" * 5 + " b")[:2] == (["latex"], "a x b")


def test_structure_is_kept():
    raw = "Title\n-----\n\nBody with **bold** and [link](x.html) and $a_{1}^2$ of some length to be text.\n\n* one &amp; two\n* three\n\n<h3 id=q>Sub</h3>\n<table><tr><th>A</th><th>B</th></tr>\n<tr><td>1<td>2</tr></table>\n\n<pre>if (a &lt; b) { x; }</pre>\n"
    families, clean, *counts = clean_text(raw)
    assert families == ["html", "markdown", "latex"]
    for part in ["## Title", "Body with bold and link and $a_{1}^2$ of", "- one & two", "- three", "### Sub", "A | B", "1 | 2", "```\nif (a < b) { x; }\n```"]:
        assert part in clean, (part, clean)
    assert counts[2:7] == [2, 2, 1, 2, 1]


PARAGRAPH = "This is a paragraph of the page that is long enough to count as text."


def test_line_blocks_drop_menus_around_text():
    lines = ["Home", "Docs", "About", "", PARAGRAPH, "It goes on for another line of some length.", "", "Top", "Help", "x"]
    assert keep_between(lines) == [False, False, False, True, True, True, True, False, False, False]
    assert keep_between(["a", "b"]) == [True, True] and keep_between([]) == []


@pytest.mark.parametrize(
    "menu",
    [
        "- Home\n- Docs\n- Login", "Home » Guides » Solver options", "* [The documentation of all classes](a.html)\n* [The list of all files](b.html)",
        "<ul><li><a href='x'>Introduction to the library</a></li><li><a href='y'>Frequently asked questions</a></li></ul>", "[Previous page](p) | [Next page of the guide](n) | [Up](u)", "[[Main page]] · [[Help]]",
    ],
)
def test_menus_and_crumbs_are_dropped(menu):
    for text in (f"{menu}\n\n{PARAGRAPH}\n", f"{PARAGRAPH}\n\n{menu}\n", f"{menu}\n\n# Title\n\n{PARAGRAPH}\n\n{menu}"):
        clean = clean_text(text)
        assert clean[1] == (f"# Title\n\n{PARAGRAPH}" if "# Title" in text else PARAGRAPH) and clean[-1] >= 1
    assert clean_text(menu)[-1] == 0


def test_a_heading_goes_with_its_menu():
    menu = "## Navigation\n\n- Home\n- Docs\n- Login"
    assert clean_text(f"{menu}\n\n# Title\n\n{PARAGRAPH}\n\n{menu}")[1] == f"# Title\n\n{PARAGRAPH}"


def test_structure_of_the_text_stays():
    parts = ["# Title", PARAGRAPH, "- cg\n- gmres\n- bicg", "## Options", "They are:\n- on\n- off", "```\nx\n```", "$$a$$", "## Short words\n\n- the first item of a list\n- the second item of it", "| a | b |\n| 1 | 2 |", f"See [the guide](g.html) for more. {PARAGRAPH}", "```c\nend();\n```", "## Last"]
    text = "\n\n".join(parts)
    clean = clean_text(text)
    assert clean[1].replace("\n\n", "\n") == text.replace("[the guide](g.html)", "the guide").replace("\n\n", "\n") and clean[-1] == 0
    assert clean_text(PARAGRAPH + "\n\n\\begin{equation}\na\n\\end{equation}\n")[1].endswith("\\end{equation}\n$$")


def test_hostile_texts_take_linear_time():
    for text in ["<" * 50_000, "*a" * 30_000, "[" * 30_000, "$a " * 30_000, "`" * 50_001, "{{" * 30_000, "\\(" * 20_000, "''a" * 20_000, "_a " * 30_000, "| " * 20_000, "&a" * 20_000, "x" * 300_000, "[a](b)" + " " * 50_000 + "x » y", "[a](b)\n" * 5_000, "a » " * 30_000]:
        clean_text(text)


def test_tables(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", "", 2), ("c", "**x**", 3), ("c", "**x**", 4)], "id string, text string, n_chars int")
    rows = {r.id: r for r in clean_documents(df).collect()}
    assert rows["a"].clean_text is None and rows["a"].families == [] and rows["b"].clean_text == "" and rows["c"].n_chars == 5
    assert clean_documents(df).count() == 4
    assert [tuple(r) for r in found_families(df).collect()] == [("c", "markdown")]
    assert found_families(df.limit(0)).count() == 0
    parsed = spark.read.parquet(f"{DATA}/parsed.parquet")
    assert clean_documents(parsed).count() == parsed.count()
