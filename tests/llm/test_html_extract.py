from finsight.llm import html_extract as op

LONG = "The council met on Tuesday to discuss the plan for the new bridge across the river, which has been delayed twice."
OTHER = "Engineers presented three designs and a budget, and residents asked about noise, traffic and the old oak trees."


def page(body, head="<title>Menu title</title><style>p{margin:0}</style><script>var t='</p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def test_article_without_boilerplate():
    html = page(f"""<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
      <div class="ad">Buy now!</div><article><h1>Bridge &amp; river</h1><p>{LONG}<p><b>{OTHER}<br>Next&nbsp;line</b></p>
      <div class="share-buttons">Share this</div><form><input value=x>Search</form><aside>See also</aside>
      <p>A&#32;short\n  one.</p><div id="comments"><p>{LONG} says a reader</p></div></article><!-- ad 1 -->
      <footer>&copy; site</footer>""")
    assert op.extract(html) == f"Bridge & river\n{LONG}\n{OTHER} Next line\nA short one."


def test_without_article_element():
    html = page(f"""<div id="menu"><a href=1>One</a> <a href=2>Two</a></div><div><a href=1>One</a> | <a href=2>Two</a></div>
      <div class="content"><h2>Heading</h2><p>{LONG}</p><p>Short.</p><p>{OTHER}</p></div>
      <div class="sidebar"><p>{LONG}</p></div><div>Copyright</div>""")
    assert op.extract(html) == f"Heading\n{LONG}\nShort.\n{OTHER}"


def test_broken_markup():
    assert op.extract(f"<article><p>{LONG}<p>{OTHER} &am") == f"{LONG}\n{OTHER} &am"
    assert op.extract(f"<div><article><p><b>{LONG}</i></div></b><p>{OTHER}</article>").startswith(LONG)
    assert op.extract("<") in ("", "<")
    assert op.extract(f"<p>{LONG}</p><script>never closed {OTHER}") == LONG


def test_teasers_and_wrapping_form():
    teasers = "".join(f"<article class=teaser><p>Teaser {i}</p></article>" for i in range(5))
    html = page(f"<form id=page><main>{teasers}<article><p>{LONG}</p><p>{OTHER}</p></article></main></form>")
    assert op.extract(html) == f"{LONG}\n{OTHER}"


def test_empty_and_long():
    assert op.extract(None) == op.extract("") == op.extract("<nav>Home</nav>") == ""
    many = "".join(f"<p>{LONG} {i}</p>" for i in range(20000))
    assert op.extract(page(f"<article>{many}</article>")).count("\n") == 19999


def test_query_keeps_every_row(spark):
    rows = [(1, "u", page(f"<article><p>{LONG} é\U0001F600</p></article>"), 1), (1, "u", None, 2), (None, None, "", 3),
            (2, None, "<article><p>x</p></article>", 4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    got = sorted([tuple(r) for r in op.report(pages).collect()], key=repr)
    text = f"{LONG} é\U0001F600"
    assert got == sorted([(1, "u", text, len(text)), (1, "u", "", 0), (None, None, "", 0), (2, None, "x", 1)], key=repr)
    assert op.report(pages.limit(0)).count() == 0


def test_noise_inside_a_line_does_not_end_it():
    for noise in ("<span hidden>X</span>", "<svg viewBox='0 0 1 1'><path d='M0'/><title>X</title></svg>", "<svg/>",
                  "<button><div>X</div></button>", '<span class="related">X <span>Y</span></span>', "<script>x()</script>",
                  "<select><option>X<option>Y</select>", '<span class="ad"><p>X</p></span>'):
        assert op.extract(f"<article><p>{LONG}</p><p>One {noise} two three</p></article>") == f"{LONG}\nOne two three", noise
    assert op.extract(f"<article><p>{LONG} <span class=ad>X</p><p>{OTHER}</p></article>") == f"{LONG}\n{OTHER}"
    assert op.extract(f"<body><a class=skip>Skip<article><p>{LONG}</p></article>") == LONG


def test_classes_and_ids_are_read_as_whole_names():
    for name in ('class="commentary"', 'class="social-policy"', 'class="related-work"', 'class="notice-of-meeting"',
                 'id="search-results"'):
        assert op.extract(f"<article><p>{LONG}</p><div {name}><p>{OTHER}</p></div></article>") == f"{LONG}\n{OTHER}", name
    assert op.extract(f'<article><p>{LONG}</p><p id="ad">{OTHER}</p></article>') == f"{LONG}\n{OTHER}"
    for name in ('class="shareButtons"', 'id="comments"', 'class="x comment-list"', 'class="sidebar-left"', 'class="ad"',
                 'id="cookie_notice"', 'class="post-comments"', 'class="ad-slot-3"', 'role="navigation"'):
        assert op.extract(f"<article><p>{LONG}</p><div {name}><p>{OTHER}</p></div></article>") == LONG, name


def test_short_lines_and_single_links_without_article():
    text = ["Yes.", LONG, "A single link", OTHER, "First point of the list, which is long enough to be content by itself.", "Second.",
            "The end."]
    html = page(f"<ul><li><a href=1>Home</a></li><li><a href=2>News</a></li></ul><p>{text[0]}</p><p>{text[1]}</p>"
                f"<p><a href=3>{text[2]}</a></p><p>{text[3]}</p><ul><li>{text[4]}</li><li>{text[5]}</li></ul>"
                f"<p>{text[6]}</p><div><a href=4>About</a> <a href=5>Help</a></div><div>Copyright</div>")
    assert op.extract(html) == "\n".join(text)


def test_ratio_smoothing_and_clusters_against_plain_loops():
    import math
    import random

    rng = random.Random(5)
    for _ in range(40):
        at = [op.Element("p", None, ""), op.Element("div", None, "words")]
        lines = [op.Line("x" * rng.choice((1, 5, 40, 400)), rng.randint(0, 9), 0, 0, rng.choice(at[:1] * 4 + at[1:]))
                 for _ in range(rng.randint(1, 30))]
        ratio = [0.0 if x.at.noise else len(x.text) / max(x.tags, 1) for x in lines]
        smooth = []
        for i in range(len(ratio)):
            near = [(math.exp(-0.5 * (i - j) ** 2), ratio[j]) for j in range(max(0, i - 3), min(len(ratio), i + 4))]
            smooth.append(math.log1p(sum(w * r for w, r in near) / sum(w for w, _ in near)))
        low, high = min(smooth), max(smooth)
        if high - low < 1e-9:
            want = [True] * len(ratio)
        else:
            for _ in range(50):
                upper = [x for x in smooth if x >= (low + high) / 2]
                lower = [x for x in smooth if x < (low + high) / 2]
                low, high = sum(lower) / len(lower), sum(upper) / len(upper)
            want = [x >= (low + high) / 2 for x in smooth]
        assert op.content_lines(lines).tolist() == want


def test_deep_nesting_and_stray_end_tags_take_linear_time():
    import time

    def seconds(n):
        start = time.perf_counter()
        op.extract("<section><article>" + "<div>x" * n + "</section></b></i>" * n)
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(40000) < 10 * max(seconds(8000), 0.02)
