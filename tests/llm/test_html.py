from ledgerline.llm import html_text as h

PROSE = "The cat is on the mat and it was there to be seen by all of them. "


def test_article_blocks_are_kept_whole():
    page = (
        '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>'
        '<nav><ul><li><a href="/x">x</a></li></ul></nav><!-- ad --><div class="ad">Buy the thing and be happy.</div>'
        "<article><header><h1>A &amp; B</h1></header><p><b>One\n two&nbsp;three<br>four<br><p>Short.</p><p>%%% !!! ###</p>"
        '<aside>see also</aside><form>name <input></form><ul class="share"><li>tweet</li></ul>'
        '<section id="comments"><p>' + PROSE * 5 + "</p></section><p>end</article>"
        "<footer>&copy; 2020 the site</footer>"
    )
    assert h.main_text(page) == "A & B\n\nOne two three four\n\nShort.\n\n%%% !!! ###\n\nend"


def test_two_passes_without_marked_article():
    long = PROSE * 5
    page = (
        f"<body><div>Home</div><div><p>{long}</p><p>Small one</p><p>{long}</p></div><p>Last words</p>"
        '<p><a href="/">' + "link text " * 12 + "</a></p><p>tail</p></body>"
    )
    assert h.main_text(page) == f"{long.strip()}\n\nSmall one\n\n{long.strip()}"


def test_headings_follow_the_block_after_them():
    long = PROSE * 5
    page = f"<h2>Chapter</h2><p>{long}</p><h2>Links</h2><ul><li><a>one</a></li><li><a>two</a></li></ul>"
    assert h.main_text(page) == f"Chapter\n\n{long.strip()}"


def test_broken_markup():
    assert h.main_text("<article><p>a < b &lt;c&gt; <a title=\"x>y\">l</a> <!-- open <p>zz") == "a < b <c> l"
    assert h.main_text("<article><p>x<script>if(a<b)</script>y<p class='q") == "xy"
    assert h.main_text("<article></div></p>still in</article>") == "still in"
    assert h.main_text('<article><p title="never closed>text</p><p>next</p></article>').endswith("next")
    assert h.main_text("<" * 50_000) == ""
    assert h.main_text("<a '" * 20_000) == ""


def test_hidden_is_the_name_of_an_attribute():
    for tag in ('div style="overflow:hidden"', "div style='overflow: hidden; top:0'", 'div title="the hidden valley"', "div data-x=hidden"):
        assert h.main_text(f"<article><{tag}><p>in</p></div><p>end</article>") == "in\n\nend"
        assert h.main_text(f"<{tag}><article><p>in</p></article></div>") == "in"
        for own in ("hidden", 'hidden=""', "HIDDEN", "hidden = until-found"):
            assert h.main_text(f"<article><{tag} {own}><p>in</p></div><p>end</article>") == "end"
    assert h.main_text('<body style="overflow-x:hidden" class=x><article>all</article></body>') == "all"
    assert h.main_text("<article><p title='class=\"ad\"'>x</p></article>") == "x"


def test_names_of_wrappers_drop_nothing():
    long = PROSE * 5
    names = ["content-area has-sidebar", "post no-sidebar", "entry-content no-comments", "page with-nav", "widget-content"]
    for name in [*names, "elementor-widget-text", "sidebar", "widget", "left-sidebar", "overlay"]:
        for held in (f"<article><p>{long}</p></article>", f"<p>{long}</p>"):
            for tag in ("class", "id"):
                page = f'<div {tag}="{name}">{held}<div class="comments-area"><p>{PROSE * 20}</p></div></div>'
                assert h.main_text(f"<body>{page}</body>") == long.strip(), (name, held)
    assert h.main_text(f'<form id="form1"><article><p>{long}</p><p>end</p></article></form>').endswith("end")
    for name in ("sidebar", "site-footer", "ad-slot", "cookie-consent", "related posts", "comments-area", "nav_bar", "widget-2"):
        assert h.main_text(f'<p>{long}</p><div class="x {name}"><p>{long}</p></div><p>{long}</p>') == f"{long.strip()}\n\n{long.strip()}"
    assert h.main_text('<p>' + long + '</p>' + '<div class="ad">' * 5_000 + "x") == long.strip()


def test_a_paragraph_that_is_out_ends_with_the_next_one():
    assert h.main_text('<article><p class="ad">buy<p>text</article>') == "text"


def test_self_closed_raw_elements():
    for tag in ("<svg/>", "<svg />", '<svg a="1>2"/>', "<math\nx='/'/>", "<script src='a'/>", "<svg hidden/>"):
        assert h.main_text(f"<article>a{tag}b<svg><title>t</title></svg>c</article>") == "abc"
    for tag in ("<svg>", '<svg a="/>">', "<script src=/x/>", "<math x='/' >"):
        name = tag[1:].split()[0].rstrip(">")
        assert h.main_text(f"<article>a{tag}b</{name}>c</article>") == "ac"


def test_a_marked_article_is_a_prior_not_a_verdict():
    long = PROSE * 5
    prose = f"<div><p>{long}</p><p>Small one</p><p>{long}</p></div>"
    want = f"{long.strip()}\n\nSmall one\n\n{long.strip()}"
    for cards in ("<article><h3>Card</h3><p>Zzz qqq.</p></article>" * 4, f'<article class="comment"><p>{long}</p></article>' * 2):
        assert h.main_text(f"<body>{prose}{cards}</body>") == want
        assert h.main_text(f"<body>{cards}{prose}</body>") == want
    # Good text outside an article stands, other text outside does not.
    page = f"<p>{long}</p><article><h1>T</h1><p>%%%</p><p>{long}</p></article><p>{PROSE * 2}</p><p>x</p>"
    assert h.main_text(page) == f"{long.strip()}\n\nT\n\n%%%\n\n{long.strip()}"
    # Within it, what lies between lists of links goes.
    links = "<ul><li><a>one</a></li></ul>"
    assert h.main_text(f"<article><p>{long}</p>{links}<p>Zzz</p>{links}<p>end</p></article>") == f"{long.strip()}\n\nend"


def test_messy(spark):
    rows = [(1, "u", None, 9), (2, None, "", 9), (None, "u", "<article>x</article>", None), (3, "u", "<article>x</article>", 1)]
    rows += [(3, "u", "<article>x</article>", 1), (4, "u", "<article>" + "<p>word</p>" * 30_000, 1)]
    got = h.extract(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")).collect()
    assert len(got) == 6
    by = {r["page_id"]: r for r in got}
    assert (by[1]["text"], by[1]["n_chars"]) == ("", 0) and by[2]["text"] == "" and by[None]["text"] == "x"
    assert by[4]["n_chars"] == 30_000 * 4 + 29_999 * 2
    assert h.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_sentences_and_cells_with_links_belong_to_the_article():
    page = (
        "<article><p>see <a>this long linked name of a study</a></p><p>one</p><p><a>all of it linked</a></p><p>two</p>"
        "<table><tr><td><a>cell</a></td><td>12</td></tr><tr><td><a>other</a></td><td>13</td></tr></table>"
        "<ul><li><a>more</a></li><li><a>and more</a></li><li><a>of these</a></li></ul><p>end</article>"
    )
    kept = ["see this long linked name of a study", "one", "all of it linked", "two", "cell", "12", "other", "13", "end"]
    assert h.main_text(page) == "\n\n".join(kept)


def test_a_copyright_sign_alone_drops_no_paragraph():
    long = PROSE * 5
    assert h.main_text(f"<body><p>{long}</p><p>{long}© of it all</p></body>") == f"{long.strip()}\n\n{long}© of it all"
    assert h.main_text(f"<body><p>{long}</p><p>© 2020 the site</p></body>") == long.strip()


def _plain(found):
    """Both passes written out for pages without a marked article: (labels, kept texts)."""
    labels = []
    for text, links, *_ in found:
        words = "".join(c.lower() if c.isalpha() else " " for c in text).split()
        stops = sum(w in h.STOP_WORDS for w in words) / max(1, len(words))
        if links > 0.2:
            labels.append("bad")
        elif len(text) < 70:
            labels.append("bad" if links else "short")
        elif stops >= 0.32:
            labels.append("good" if len(text) > 200 else "near")
        else:
            labels.append("near" if stops >= 0.30 else "bad")
    kept = [False] * len(found)
    decided = lambda steps: next((labels[k] for k in steps if labels[k] in ("good", "bad")), "bad")
    for k in reversed(range(len(found))):
        left, right = decided(range(k - 1, -1, -1)), decided(range(k + 1, len(found)))
        if labels[k] in ("good", "bad"):
            kept[k] = labels[k] == "good"
        elif found[k][2]:
            kept[k] = right == "good" and (k + 1 == len(found) or kept[k + 1])
        elif left == right:
            kept[k] = left == "good"
        else:
            kept[k] = labels[k] == "near"
    return labels, [b[0] for b, k in zip(found, kept) if k]


def test_density_and_neighbours_decide_pages_without_an_article():
    import random

    rnd = random.Random(5)
    stop, other = "the of and to in is it was".split(), "granite harbour copper ledger willow anvil meadow".split()

    def text(words, share):
        return " ".join(rnd.choice(stop) if i < share * words else rnd.choice(other) for i in range(words))

    seen = set()
    for _ in range(300):
        blocks = []
        for _ in range(rnd.randint(1, 12)):
            words, share, links = rnd.choice([3, 8, 20, 30, 60]), rnd.choice([0.0, 0.2, 0.31, 0.5, 0.8]), rnd.choice([0, 0, 0, 2, 9])
            tag = rnd.choice(["p", "div", "li", "h2"])
            linked = f"<a>{text(links, 0.3)}</a>" if links else ""
            blocks.append(f"<{tag}>{text(words, share)} {linked}</{tag}>")
        page = f"<body>{''.join(blocks)}</body>"
        found = h.blocks(page)
        labels, kept = _plain(found)
        seen |= {(label, b[0] in kept) for label, b in zip(labels, found)}
        assert h.main_text(page) == "\n\n".join(kept)
    assert {("good", True), ("bad", False), ("short", True), ("short", False), ("near", True), ("near", False)} <= seen
