import pytest

from rankforge.llm.html_extract import extract, main_blocks

LONG = "The cat sat on the mat and it was the best of the mats that a cat has had in all of the years of the house. "


def text(page):
    return " ".join(main_blocks(page)[0])


@pytest.mark.parametrize("page,want", [
    ("", ""),
    ("plain words", "plain words"),
    ("<p>a &amp; b&nbsp;&#233;&lt;i&gt; &am", "a & b é<i> &am"),
    ("<article><h1>T</h1><p>Short.</p></article><footer>f</footer>", "T Short."),
    ("<nav><a href=/x>m</a></nav><div class='ad'>buy</div><article><p>A<b>b</b>c<br>d</article>", "Abc d"),
    ("<article><p>x</p><script>var t='</p>';</script><style>p{}</style><!-- <p>no --><form>f<input></form><p>y", "x y"),
    ("<article><p>x</p><div class='comments'><article class=comment><p>me too</p></article></div><p>y</p></article>", "x y"),
    ("<div class='cookie-notice'>ok?<article><p>real</p></article>", "real"),
    ("<article><p>x</p><ul><li><a href=a>all link</a></li></ul><p>y</p></article>", "x y"),
    ("<body class='has-sidebar'><p>" + LONG + "</p><aside>s</aside><p>Short.</p></body>", (LONG + "Short.").strip()),
    ("<p>" + "xqz vbn wrt plk " * 12 + "</p><p>tail</p>", ""),
    ("<p a='>' b>t</p", "t"), ("a < b <3", "a < b <3"), ("<!DOCTYPE html><?x y?>z<![CDATA[c]]>", "z"),
    ("<div class='site header'><p>" + LONG + "</p></div><p>" + LONG + "</p>", LONG.strip()),
    ("<span class=ad>no</span>yes", "yes"), ("<article><p><i>a<p>b</i>c</article>d", "a bc"),
])
def test_pages(page, want):
    assert text(page) == want


ITALIAN = "Il gatto che era sul tappeto della casa non ha visto il cane con gli occhi di vetro, ma lo ha sentito nella notte. "
CHINESE = "这是一个关于城市的故事，他们在河边有一座房子，不过人们都说这里的冬天是最冷的，所以他在春天来了的时候才回来。" * 2


@pytest.mark.parametrize("page,want", [
    (f"<div class='elementor-widget wide'><p>{LONG}</p><p>End.</p></div>", LONG + "End."),
    (f"<div class='layout has-sidebar'><p>{LONG}</p><div class=sidebar><p>{LONG}</p></div><p>{LONG}</p></div>", LONG + LONG.strip()),
    (f"<section class='header-content'><p>{LONG}</p></section>", LONG.strip()),
    (f"<div id='search-results-page'><div class=widget>{LONG}</div></div>", LONG.strip()),
    (f"<p>{LONG}</p><article><p>x</p></article>", LONG + "x"),
    (f"<p>a <button>Buy <p>{LONG}</p><button>b</button>", "a " + LONG.strip()),
    (f"<p>a <select><option>1</option><p>{LONG}</p>", "a 1 " + LONG.strip()),
    (f"<p>{ITALIAN}</p>", ITALIAN.strip()), (f"<p>{CHINESE}</p>", CHINESE),
    # names are believed where there is another article, and always for notices and comments
    (f"<p>{LONG}</p><div class=widget><p>{LONG}</p><p>{LONG}</p></div>", LONG.strip()),
    (f"<article>short</article><div class=sidebar><p>{LONG}</p></div>", "short"),
    (f"<div class='cookie-notice'><p>{LONG}</p></div><div id=comments><p>{LONG}</p></div>", ""),
])
def test_names_are_weighed(page, want):
    assert text(page) == want


def naive_pass_two(labels):
    """Nearest decided label of every place, the good one at equal distance."""
    out = []
    for i, x in enumerate(labels):
        near = sorted((abs(i - j), not y) for j, y in enumerate(labels) if y is not None)
        out.append(x if x is not None else not near or not near[0][1])
    return out


def test_both_passes_against_a_plain_version():
    import random
    rng = random.Random(5)
    words = ["the", "and", "house", "river", "xqz", "wrt", "blue"]
    for _ in range(300):
        found = [" ".join(rng.choices(words, k=rng.choice([1, 3, 25]))) for _ in range(rng.randrange(1, 9))]
        links = [rng.random() < 0.2 for _ in found]
        labels = []
        for b, link in zip(found, links):
            each = b.split()
            stops = sum(w in ("the", "and") for w in each)
            labels.append(False if link else None if len(b) < 70 else stops >= 0.12 * len(each))
        want = [b for b, good in zip(found, naive_pass_two(labels)) if good]
        page = "".join(f"<p><a href=x>{b}</a></p>" if link else f"<p>{b}</p>" for b, link in zip(found, links))
        assert main_blocks(page)[0] == want


def test_clashing_columns_and_own_stop_words(spark):
    df = spark.createDataFrame([(1, "<p>" + "foo bar baz " * 20, "mine", 7)], "page_id long, html string, text string, n_blocks int")
    assert [r.text for r in extract(df).collect()] == [""]
    got = extract(df, frozenset(["foo"])).collect()[0]
    assert got.text == ("foo bar baz " * 20).strip() and got.n_blocks == 1


def test_unclosed_wrappers_stay_linear():
    page = "<div class=widget>" * 30_000 + LONG + "<button>" * 30_000
    assert text(page) == LONG.strip()


def test_ambiguous_blocks_take_the_nearest_label():
    bad = "<p>" + "xqz vbn wrt plk " * 12 + "</p>"
    good = "<p>" + LONG + "</p>"
    page = good + "<p>near good</p><p>mid</p><p>near bad</p>" + bad
    assert main_blocks(page)[0] == [LONG.strip(), "near good", "mid"]


def test_frame(spark):
    rows = [(1, "u", None, 5), (2, None, "", 5), (3, "u", "<p>" + LONG * 3000, 5), (3, "u", "<p>" + LONG * 3000, 5), (None, "u", "<p>a\n b", 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    got = sorted(((r.page_id or 0, r.text, r.n_chars) for r in extract(df).collect()))
    assert got[0] == (0, "a b", 3) and got[1] == (1, "", 0) and got[2] == (2, "", 0)
    assert got[3] == got[4] and got[3][2] == len((LONG * 3000).strip())
    assert extract(df.limit(0)).collect() == []


def test_articles_of_the_table(spark, sf_small):
    import html
    import re
    for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect():
        inner = re.split("</article>|<footer>", r.html.split("<article>")[1])[0]
        inner = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)\b[^>]*>", " ", inner))
        assert text(r.html) == " ".join(html.unescape(inner).split())
