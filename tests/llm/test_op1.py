import random

import pytest

from martcraft.llm import op1_html as o


def test_common_is_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.randint(0, 4) for _ in range(rng.randint(0, 9))]
        b = [rng.randint(0, 4) for _ in range(rng.randint(0, 9))]
        i, j = o.common(a, b)
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for x in range(len(a)):
            for y in range(len(b)):
                best[x + 1][y + 1] = best[x][y] + 1 if a[x] == b[y] else max(best[x][y + 1], best[x + 1][y])
        assert len(i) == best[-1][-1] and [a[x] for x in i] == [b[x] for x in j]
        assert i == sorted(set(i)) and j == sorted(set(j))


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"),
    ("<article><h1>T</h1><p><b>a&nbsp;b<br>c<p>d</article><footer>f", "T\n\na b c\n\nd"),
    ("<title>x</title><script>var t='</p>'</script><p>one</p><!-- <p>no</p> --><nav><p>menu</p></nav><p>two", "one\n\ntwo"),
    ("<div class='user-comments'><div>x</div>y</div><p>z</p><form><p>q</p></form>", "z"),
    ("<p a='unclosed>text</p><p>5 < 6", "text\n\n5 < 6"),
    ("<main><header>H</header><p>x</p></main><header>page</header><p>outside</p>", "H\n\nx"),
    ("<span class=ad>buy</span>tail", "tail"), ("<script>never closed", ""),
])
def test_main_text(page, text):
    assert o.main_text(o.text_lines(page), None) == text


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, part int, lines string")


def test_shared_open_lines_go_and_articles_and_copies_stay(spark):
    page = "<div>Site name</div><p>{}</p><p>All rights</p>".format
    art = "<div>Site name</div><article><p>Shared intro</p><p>{}</p></article>".format
    rows = [(i, f"http://a.example/x/{i}", page(f"Text number {i} alone"), "h", 1, "l") for i in range(40)]
    rows += [(100 + i, f"http://b.example/{i}", art(f"Body {i}"), "h", 1, "l") for i in range(5)]
    rows += [(200, "http://c.example/1", page("Copy"), "h", 1, "l"), (200, "http://c.example/1", page("Copy"), "h", 1, "l"),
             (201, "http://d.example/only", page("Single"), "h", 1, "l"), (202, None, page("No url"), "h", 1, "l"),
             (203, "http://e.example/", None, "h", 1, "l"), (None, "http://f.example/", "<p>no id", "h", 1, "l")]
    got = {}
    for r in o.extract(_pages(spark, rows).repartition(7)).collect():
        got.setdefault(r.page_id, []).append(r.text)
        assert r.n_chars == len(r.text)
    for i in range(40):
        assert got[i] == [f"Text number {i} alone"]
    for i in range(5):
        assert got[100 + i] == [f"Shared intro\n\nBody {i}"]
    whole = "Site name\n\n{}\n\nAll rights".format
    assert got[200] == [whole("Copy")] * 2 and got[201] == [whole("Single")]
    assert got[202] == [whole("No url")] and got[203] == [""] and got[None] == ["no id"]


def test_empty_table(spark):
    assert o.extract(_pages(spark, [])).count() == 0
