"""HTML extraction, SentencePiece ids, words, and the pipeline."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from check import compare, connect
from pagelake.llm import pieces
from pagelake.llm import words as W
from pagelake.llm.extraction import main_text, with_main_text
from pagelake.llm.queries import QUERIES
from tests.llm.conftest import DOCS, PLAIN, SPACED, lower


@pytest.mark.parametrize("kind,pattern,low", [(W.SPACED, SPACED, False), (W.PLAIN, PLAIN, True)])
def test_words(rows, kind, pattern, low):
    texts = [t for _, t in rows]
    got = W.words_of(pa.array(texts), kind, low)
    want = [w for t in texts for w in pattern.findall(lower(t) if low else t or "")]
    assert got.texts().to_pylist() == want
    h = got.hashes()
    assert len(set(zip(want, h.tolist()))) == len(set(want)) == len(set(h.tolist()))
    own = W.words_of(pa.array(["pad", *texts]), kind, low).hashes()[1:]
    assert (own == h).all()


def test_slices_cover_all_rows():
    texts = pa.array(["x" * n for n in (5, 0, 30, 1, 1, 1, 9)])
    assert [i for a, b in W.slices(texts, 6) for i in range(a, b)] == list(range(7))


PAGE = (
    '<html><head><title>T</title><style>p{}</style></head><body><nav><li><a href=x>Home</a></nav>'
    '<div class="ad">Buy</div><!-- <p>no</p> --><article><h1>Head &amp; more</h1>'
    '<p><b>First\n  one<br>line<p class="notice">Note</p><p>Second &lt;x&gt; &#233;</p>'
    '<form><p>Sign up</p></form><script>var t="</p>";</script><div id="comments"><p>Nice</p></div>'
    "<aside>Side</aside></article><footer>&copy; me</footer></body></html>"
)


def test_article_text(spark):
    want = "Head & more\nFirst one line\nSecond <x> é"
    assert main_text(PAGE) == want
    assert main_text(PAGE[: PAGE.index("<footer>") + 12]) == want
    table = spark.createDataFrame([(1, PAGE), (1, PAGE), (2, None), (3, "")], "i int, html string")
    got = [r.text for r in with_main_text(table).orderBy("i").collect()]
    assert got == [want, want, "", ""]
    assert with_main_text(table.limit(0)).collect() == []
    with pytest.raises(ValueError):
        with_main_text(table.withColumn("text", F.lit(1)))


def test_page_without_an_article():
    body = "".join(f"<p>{'A long sentence of text. ' * 6}</p>" for _ in range(3))
    page = f"<body><div>Menu</div><div></div><nav>Go</nav><div>{body}</div><nav>x</nav><p>by</p>"
    assert main_text(page) == "\n".join(["A long sentence of text. " * 5 + "A long sentence of text."] * 3)


def test_text_beside_an_article():
    """The mark of an article raises weights, it does not end the search elsewhere."""
    long = "A long sentence of the main text. " * 5
    body = "".join(f"<p>{long}{i}</p>" for i in range(3))
    page = f"<article><p>Teaser</p></article><div>Menu</div><nav>x</nav><div>{body}</div><p>by</p>"
    assert main_text(page) == "\n".join(["Teaser", *(f"{long}{i}" for i in range(3)), "by"])
    marked = f"<div>Menu</div><article><p>{long}</p><div class=ad>Buy</div><p>End</p></article><p>by</p>"
    assert main_text(marked) == f"{long.strip()}\nEnd"


def test_short_blocks_and_named_containers():
    long = "A long sentence of the main text. " * 9
    ad = "<div class=ad>Buy</div>"
    # A closing paragraph after an advert, and a paragraph that is a link.
    page = f"<div>Menu</div><nav>x</nav><div><p>{long}</p>{ad}<p>The end.</p><p><a href=x>Source</a></p></div>"
    assert main_text(page) == f"{long.strip()}\nThe end.\nSource"
    # A short page.
    assert main_text("<nav>x</nav><div><h1>Title</h1><p>Short.</p></div>") == "Title\nShort."
    assert main_text("<nav>x</nav>") == ""
    # Names of a heading and of the wrapper of all text.
    side = "<div class=sidebar>Side</div>"
    page = f"<div class='with-sidebar'>{side}<h1 class='entry-header'>Head</h1><p>{long}</p></div>"
    assert main_text(page) == f"Head\n{long.strip()}"
    assert main_text(f"<article><div id=x-menu><p>{long}</p></div></article>") == long.strip()


def test_deep_and_broken_pages_are_linear():
    deep = "<article>" + "<div>" * 20_000 + "text" + "</div>" * 20_000
    assert main_text(deep) == "text"
    assert main_text("<article><p>a" + "<" * 20_000) .startswith("a")
    assert main_text('<article><p>a<a href="' + "x" * 100_000) == "a"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.Vocabulary())


def odd_texts():
    rng = random.Random(6)
    signs = "abcdeehinorst  üé日\n.,1"
    texts = ["", " ", "  x  y", "x" * 300, "aaaaaaaaaaab" * 40, "日本" * 200, " " * 50 + "a", "😀 a"]
    return texts + ["".join(rng.choice(signs) for _ in range(rng.randint(1, 90))) for _ in range(400)]


def test_ids_are_the_library_s(encoder, library):
    texts = odd_texts()
    assert pieces.encode(pa.array(texts), encoder).to_pylist() == library.encode(texts)


def test_round_trip(encoder):
    texts = [*odd_texts(), None, "mark ▁ itself", "\x00<0x41></s>"]
    ids = pieces.encode(pa.array(texts), encoder)
    assert pieces.decode(ids, encoder.v).to_pylist() == texts


def test_chunks_give_the_same_ids(spark, rows, library, empty):
    texts = [(i, t) for i, t in enumerate([*odd_texts()[:60], *(t for _, t in rows)])]
    table = spark.createDataFrame(texts, "k int, text string")
    for chunk in (40, 1000):
        got = pieces.with_ids(table, chunk=chunk).collect()
        assert len(got) == len(texts)
        for r in got:
            assert r.ids == (None if r.text is None else library.encode(r.text))
    assert pieces.with_ids(empty).collect() == []


def test_pairs_stand_together_as_merging_says(encoder):
    v, rng = encoder.v, np.random.default_rng(2)
    ids = list(v.id.values())
    for a, b in zip(rng.choice(ids, 2000), rng.choice(ids, 2000)):
        a, b = int(a), int(b)
        assert encoder.together(a, b) == (pieces.merged(v.piece[a] + v.piece[b], v) == [a, b])


def test_pipeline_stages(spark, docs, rows, empty):
    sf = "/root/testdata/sf0.001"
    odd = spark.createDataFrame([(None, "null id", "en", "s", 7)], DOCS).union(docs)
    now, names = odd.withColumn("_score", F.lit(1)), []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, now, sf)
        names.append(name)
        assert set(now.columns) <= set(after.columns)
        if name != "sentencepiece":
            assert after.columns == now.columns
        now = after.cache()
        assert {r._score for r in now.select("_score").distinct().collect()} == {1}
    assert names == ["toxicity", "line_dedup", "ngram_jaccard", "decontamination", "sentencepiece"]
    out = now.collect()
    assert all(r.exact for r in out)
    ids = [r.doc_id for r in out]
    assert None in ids and len(ids) == len(set(ids))
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, empty, sf).collect() == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    assert compare(spark, connect(sf), sf, name) is None


def test_entry_has_every_query():
    assert {f"op{n}" for n in range(1, 11)} <= {k.split("_")[0] for k in entry.queries()}
    assert "pipeline" in entry.queries()
    assert re.match("op", sorted(QUERIES)[0])
