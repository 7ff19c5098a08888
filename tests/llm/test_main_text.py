"""Main text of pages whose article is known."""

import random

import pytest

from tidemark.llm.main_text import extract_main_text, lines_of, main_text

AROUND = [
    ("<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>About</a></li></ul></nav>", ""),
    ("<header><h2>Site name</h2></header>", "<footer>&copy; 2024 Site</footer>"),
    ('<div class="cookie-notice"><p>We use cookies for everything.</p><button>OK</button></div>', ""),
    ("", '<aside class="sidebar"><h3>Popular</h3><p>Some other story that is long enough to look like text.</p></aside>'),
    ("", '<section id="comments"><p>I liked this article very much indeed, thanks!</p></section>'),
    ('<div class="ad">Buy now.</div><!-- ad -->', '<form><label>Mail</label><input name=x><textarea>typed</textarea></form>'),
    ("<script>var t='</p><p>no';</script><style>p{}</style>", "<noscript>enable it</noscript>"),
]


def article(r):
    blocks = [" ".join(r.choice(["lorem", "ipsum", "é&amp;è", "dolor", "a &lt; b"]) for _ in range(r.randint(20, 60))) + "." for _ in range(5)]
    plain = " ".join(b.replace("&amp;", "&").replace("&lt;", "<") for b in blocks)
    return "".join(f"<p>{b.replace(' ', chr(10), 1)}</p>" for b in blocks), plain


@pytest.mark.parametrize("holder", ["<article>{}</article>", "<main><h1>T</h1>{}</main>", '<div role="main">{}</div>', "<div class='post'>{}</div>"])
@pytest.mark.parametrize("around", AROUND)
def test_article_is_found(holder, around):
    body, plain = article(random.Random(1))
    text = main_text(f"<html><head><title>T</title></head><body>{around[0]}{holder.format(body)}{around[1]}</body></html>")
    assert text.removeprefix("T ") == plain


def test_odd_pages():
    assert main_text("") == "" and main_text("<nav>x</nav>") == ""
    assert main_text("<article><p>one<br>two <b>th</b>ree<p>four &hellip; &#65;</article><p>out") == "one two three four … A"
    assert main_text("<article><header><h1>Head</h1></header><p>Body</p><footer>by me</footer></article>") == "Head Body"
    assert main_text("plain words only") == "plain words only"
    assert main_text("<article><p>cut off in the mid") == "cut off in the mid"
    assert main_text('<div class="ad">never closed<article><p>Text</p></article>') == "Text"


def test_table(spark):
    rows = [(1, "u", "<article>a</article>", 0), (2, None, None, 0), (None, "v", "", 0), (1, "u", "<article>a</article>", 0), (3, "w", "<p>" + "x " * 200_000, 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(((r.page_id, r.url, r.text[:3], r.n_chars) for r in extract_main_text(df).collect()), key=str)
    assert got == sorted([(1, "u", "a", 1), (1, "u", "a", 1), (2, None, "", 0), (None, "v", "", 0), (3, "w", "x x", 399_999)], key=str)
    assert extract_main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "wrapper", ["<div class='layout has-sidebar'>", "<div class='post-with-comments'>", "<div id='header-and-content'>"]
)
def test_a_name_alone_does_not_skip_the_article(wrapper):
    body, plain = article(random.Random(2))
    rest = "<div class='sidebar'><p>Some other story.</p></div>"
    teaser = "<ul class='related'><li><article><p>A teaser of another page.</p></article></li></ul>"
    for holder in ("<div>{}</div>", '<div role="main">{}</div>', "<article>{}</article>"):
        inner = holder.format(body) + rest
        assert main_text(f"<body>{wrapper}{inner}</div></body>") == plain
        assert main_text(f"<body>{wrapper}{inner}{teaser}</div></body>") == plain
    # Cut off in the middle.
    assert main_text(f"<body>{wrapper}<div>{body}") == plain


def test_a_marked_teaser_does_not_replace_the_article():
    body, plain = article(random.Random(3))
    teaser = "<article><a href=/x>Read on</a><p>A teaser.</p></article>"
    for around in ("<ul class='related'><li>{}</li></ul>", "<div class='more'>{}</div>"):
        assert plain in main_text(f"<body><div>{body}</div>{around.format(teaser)}</body>")


def test_long_comments_do_not_outweigh_a_marked_article():
    comments = "<section id='comments'>" + "<p>I liked this article very much indeed.</p>" * 20 + "</section>"
    assert main_text(f"<body><article><p>Short.</p></article>{comments}</body>") == "Short."


def page_of_blocks(r, depth=0):
    """A tree of blocks: (name of its class or none, text before the children, children)."""
    children = [page_of_blocks(r, depth + 1) for _ in range(r.randint(0, 3))] if depth < 5 else []
    return r.choice([None, None, "ad", "layout sidebar"]), "x" * r.randint(1, 9), children


def written(block):
    name, text, children = block
    return f"<div{f' class=\"{name}\"' if name else ''}>{text}{''.join(map(written, children))}</div>"


def size_of(block):
    return len(block[1]) + sum(map(size_of, block[2]))


def kept_blocks(block, total):
    """Without the named blocks that hold at most half of the text."""
    if block[0] and 2 * size_of(block) <= total:
        return []
    return [block[1], *(text for child in block[2] for text in kept_blocks(child, total))]


@pytest.mark.parametrize("seed", range(40))
def test_named_elements_against_trees(seed):
    block = page_of_blocks(random.Random(seed))
    assert [line[0] for line in lines_of(written(block))] == kept_blocks(block, size_of(block))


def test_many_open_elements():
    # Quadratic work over these would take minutes.
    assert main_text('<div class="ad">x' * 50_000 + "<article><p>Text</p></article>").endswith("Text")
