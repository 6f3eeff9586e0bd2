import numpy as np
import pytest

from orderloom.llm import pages

HEAD = '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href=/a>One</a></li><li><a href=/b>Two</a></li></ul></nav>'


def page(i):
    words = [f"word{(i * 31 + k * 7) % 977}" for k in range(400)]
    body = "".join(f"<p>{' '.join(words[k * 9 : k * 9 + 3 + k])}, and more.</p>" for k in range(1, 12))
    return f'{HEAD}<div class="ad">Buy {words[0]}</div><article><h1>{words[1]} &amp; {words[2]}</h1>{body}</article><footer>&copy; site {i}</footer></body></html>'


@pytest.fixture(scope="module")
def model():
    return pages.train(pages.training_pages([page(i) for i in range(40)]))


def test_blocks():
    found = pages.blocks("<body><p><b>One &amp;\n two<br>three<p>Four&nbsp; x</p><ul><li>a<li>b</ul><script>no</script><!-- no --><div hidden>no</div><td>c<textarea>no</textarea> < d")
    assert [b.text for b in found] == ["One & two three", "Four x", "a", "b", "c", "< d"]
    assert [b.path[-1][0] for b in found[2:4]] == ["li", "li"] and found[1].path == (("body",), ("p",))
    assert pages.blocks(None) == pages.blocks("") == pages.blocks("<p> </p>") == []
    assert [b.text for b in pages.blocks("bare text")] == ["bare text"]
    assert pages.blocks('<div class="Site-Menu x1" id=top><a>go</a></div>')[0].path[0] == ("div", "site", "menu", "x", "top")


@pytest.mark.parametrize("attribute", ['title="The hidden cost of x"', 'class="a hidden b"', "data-x='display:none'", 'title="aria-hidden=true"', 'data-a=1 alt="id=menu hidden "'])
def test_words_in_values_hide_nothing(attribute):
    found = pages.blocks(f"<body><article {attribute}><p>One</p><p {attribute}>Two</p></article>")
    assert [b.text for b in found] == ["One", "Two"] and not any("?hidden" in e or "menu" in e for b in found for e in b.path)


def test_unseen_text_is_left_to_the_labeller():
    found = pages.blocks('<body><div style="color:red; display: none">a</div><div aria-hidden=true class=x>b</div><div hidden=until-found>c</div><div HIDDEN="">no</div><p title="hidden" hidden>no</p>d')
    assert [(b.text, b.path[-1][-1]) for b in found] == [("a", "?hidden"), ("b", "?hidden"), ("c", "?hidden"), ("d", "body")]


def test_a_paragraph_stays_whole():
    inner = '<math><mi>x</mi><mo>=</mo><mspace width="1em"/><mn>2</mn></math>'
    for source, text in (
        (f"If {inner} holds", "If x=2 holds"), ('Press <button class="k">Go</button> now', "Press Go now"), ("A <picture><source srcset=a><img src=b></picture> cat", "A cat"),
        ('An <svg viewBox="0 0 1 1"><g><path d="M0"/><polygon points="1"/></g></svg> icon', "An icon"), ("The <my-term>word</my-term> is", "The word is"),
        ("See <object data=x>the text</object> and <canvas>chart</canvas>, <meta itemprop=a content=b>end", "See the text and chart, end"),
    ):
        found = pages.blocks(f"<body><article><p>{source} so.</p><p>Next</article>")
        assert [b.text for b in found] == [text + " so.", "Next"]
        assert [b.path for b in found] == [(("body",), ("article",), ("p",))] * 2


def test_extraction(spark, model):
    many = [(i, f"u{i}", page(i), "x") for i in range(100, 160)] + [(1, None, None, "x"), (1, None, None, "x"), (None, "u", "", "x")]
    got = pages.extract(spark.createDataFrame(many, "page_id long, url string, html string, Text string"), model).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(many) and by[1].text == "" and by[None].n_chars == 0
    for i, _, source, _ in many[:60]:
        want = "\n".join(b.text for b in pages.blocks(source) if pages.teacher(b))
        assert by[i].text == want and by[i].n_chars == len(want)
    assert pages.extract(spark.createDataFrame([], "page_id long, url string, html string"), model).collect() == []


def test_other_layouts(model):
    """Held-out layouts without semantic tags: blocks of the article are told from the rest."""
    right = total = 0
    for i in range(30):
        source = page(500 + i).replace("<article>", '<div class="content">').replace("</article>", "</div>").replace("<nav>", '<div class="menu">').replace("</nav>", "</div>")
        source = source.replace("<footer>", '<div id="sidebar"><p>Read also this</p></div><section class="comments"><p>I like it.</p></section><form><label>Mail</label></form><footer>')
        found = pages.blocks(source)
        kept = pages.label(model, [pages.vectors(found)])[0]
        truth = [("div", "content") in b.path for b in found]
        right += sum(k == t for k, t in zip(kept, truth))
        total += len(found)
    assert right / total > 0.97


def test_gradients():
    """Backpropagation agrees with differences."""
    rng = np.random.default_rng(0)
    x, mask = rng.normal(size=(2, 4, pages.WIDTH)), np.array([[1, 1, 1, 1], [1, 1, 0, 0]], float)
    w = pages.Labeller.fresh(1).weights
    for part, reverse in ((w[:3], False), (w[3:6], True)):
        weight = rng.normal(size=(2, 4, pages.HIDDEN))
        tape = []
        pages._forward(x, mask, part, reverse, tape)
        grads = pages._backward(x, weight, part, tape)
        for k, at in ((0, (3, 5)), (1, (2, 7)), (2, (9,))):
            moved = []
            for sign in (1, -1):
                own = [v.copy() for v in part]
                own[k][at] += sign * 1e-5
                moved.append((pages._forward(x, mask, own, reverse) * weight).sum())
            assert abs((moved[0] - moved[1]) / 2e-5 - grads[k][at]) < 1e-5
