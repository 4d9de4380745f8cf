import itertools

import numpy as np
import pytest

from tillroll.llm import page_crf as C


@pytest.fixture(scope="module")
def chain():
    return C.trained()


def test_parse_blocks():
    page = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t="</p>";</script></head>
    <body><!-- <p>no</p> --><p>One &amp; <b>t</b>wo&nbsp;&#233;<br>three<p>four <i>five
    <div>six</div></i> seven<ul><li>eight<li>nine</ul><template>no</template><span hidden>no</span><p style="display:none">no</p>
    <a href="x>y">ten</a> eleven"""
    texts = [b.text for b in C.parse(page)]
    assert texts == ["One & two é three", "four five", "six", "seven", "eight", "nine", "ten eleven"]
    assert C.parse(page)[-1].linked == 3


def test_viterbi_is_the_best_of_all_labellings():
    random = np.random.default_rng(4)
    for _ in range(20):
        chain = C.Chain(random.normal(size=len(C.FEATURES)) * 3, random.normal(size=(2, 2)) * 2)
        features = [sorted(random.choice(len(C.FEATURES), 5, replace=False).tolist()) for _ in range(8)]

        def score(y):
            return sum(chain.weights[f].sum() * b for f, b in zip(features, y)) + sum(chain.steps[a, b] for a, b in zip(y, y[1:]))

        best = max(itertools.product((0, 1), repeat=8), key=score)
        assert tuple(chain.decode(features)) == best


def test_held_out_pages(chain):
    pages = C.labelled_pages(200, seed=1234)
    right = sum(chain.extract(page) == "\n\n".join(main) for page, main in pages)
    assert right / len(pages) > 0.95


def test_held_out_bare_pages(chain):
    right = {kind: [] for kind in C.BARE_KINDS}
    for kind, page, main in C.bare_pages(600, seed=4321):
        right[kind].append(chain.extract(page) == "\n\n".join(main))
    assert min(sum(v) / len(v) for v in right.values()) > 0.9, {k: sum(v) / len(v) for k, v in right.items()}


BARE = [
    ("<article><p>One paragraph of the story, and nothing else.</p></article>", "One paragraph of the story, and nothing else."),
    ("<div id=main>A first line of it.<br><br>And a second one.</div>", "A first line of it. And a second one."),
    ("Only words, no markup at all. And more of them.", "Only words, no markup at all. And more of them."),
    ("<article><h1>Title</h1><p>Some words here, to begin.</p><p><a href=/x>This whole paragraph is a link.</a></p></article>",
     "Title\n\nSome words here, to begin.\n\nThis whole paragraph is a link."),
    ("<nav><a href=x>Home</a></nav>", ""),
    ("<footer>&copy; 2020 Someone</footer>", ""),
]


@pytest.mark.parametrize("page, text", BARE)
def test_bare_pages(chain, page, text):
    assert chain.extract(page) == text


def test_pages_of_the_table(chain, spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for r in rows:
        inside = r.html[r.html.find("<article>") :].split("</article>")[0]
        assert chain.extract(r.html) == "\n\n".join(b.text for b in C.parse(inside))


def test_hand_written_page(chain):
    page = """<body><div class="cookie-notice">We use cookies.<button>OK</button></div>
    <header><h1>Site</h1><nav><a href=/>Home</a> | <a href=/b>Blog</a></nav></header>
    <div id="content"><h1>A walk in the hills</h1><p>We went up early, before the sun was hot.
    <p>It was quiet there.<div class="advertisement">Buy boots now!</div><p>Then we came down, tired and glad.</div>
    <div id="comments"><h3>2 comments</h3><div class="comment"><p>Lovely walk, thanks for sharing it with us.</p></div></div>
    <form action=/s><p>Search this site</p></form><div class="sidebar"><h3>Popular</h3><p>Another story, read by many.</p></div>
    <footer>&copy; 2020 Someone. All rights reserved.</footer>"""
    assert chain.extract(page) == "\n\n".join(
        ["A walk in the hills", "We went up early, before the sun was hot.", "It was quiet there.", "Then we came down, tired and glad."]
    )


def test_query_edges(spark, tmp_path):
    long = "<article>" + "<p>A fine long sentence, with many words in it.</p>" * 5000 + "</article>"
    rows = [(1, "u", None), (2, "u", ""), (3, None, "<nav><a href=x>Home</a></nav>"), (4, "u", long), (4, "u", long), (None, "u", "<<p <a href='")]
    given = spark.createDataFrame([(*r, "clash", 7) for r in rows], "page_id BIGINT, url STRING, html STRING, text STRING, n_chars INT")
    given.write.parquet(f"{tmp_path}/pages.parquet")
    got = C.op7_page_crf(spark, str(tmp_path)).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in got if r.page_id != 4 and r.page_id) == [("1", 0), ("2", 0), ("3", 0)]
    assert [r.text.count("\n\n") for r in got if r.page_id == 4] == [4999, 4999]
    assert all(len(r.text) == r.n_chars for r in got) and len(got) == 6
    spark.createDataFrame([], given.schema).write.parquet(f"{tmp_path}/none/pages.parquet")
    assert C.op7_page_crf(spark, f"{tmp_path}/none").collect() == []
