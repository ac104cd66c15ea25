"""Token alignment, collocations and page extraction on small tables."""

import hashlib
import json
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import alignment, collocations, extraction, language, store
from tests.llm.common import DOCS, SMALL, awkward, documents, given

CLASHING = ["a.b", "row", "run", "place", "frames", "host", "template", "pair", "_text", "base", "_key", "_row"]


def clashing(df):
    for name in CLASHING:
        df = df.withColumn(name, F.lit(1))
    return df


# --- samples


def test_language_learns_from_rows_that_share_an_id(spark):
    texts = {"en": "the house and the garden of the old man", "de": "das haus und der garten des alten mannes"}
    rows = [(key, f"{t} {i}x", lang) for key in (4, None) for i in range(700) for lang, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    for some in (docs.where("doc_id = 4"), docs.where("doc_id is null")):
        model = language.train(some)
        found = language.predict(some.select("doc_id", "text", "lang"), model, ["lang"])
        assert model["names"] == ["de", "en"] and found.where("lang = lang_pred").count() == 1400


def test_a_sample_leaves_most_rows_where_they_are(spark):
    rows = spark.range(200_000).repartition(50).withColumn("pad", F.lit("x" * 200))
    found = store.lowest(rows, 200_000, 500, "id").select("id").collect()
    every = sorted(rows.select(F.xxhash64("id").alias("h"), "id").collect())[:500]
    assert sorted(r["id"] for r in found) == sorted(r["id"] for r in every)
    assert store.lowest(rows, 200_000, 0, "id").count() == 0 and store.lowest(rows.limit(0), 0, 9, "id").count() == 0


# --- alignment


def brute_alignment(rows):
    """Rows of (id, text) by the libraries on whole texts and a walk over bytes."""
    import sentencepiece
    from tokenizers import Tokenizer

    first, second = alignment.default_paths()
    left = Tokenizer.from_file(first)
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=second)
    tables = alignment.Tokenizers(*alignment._tokenizers(first, second))
    linked, found = Counter(), []
    for key, text in rows:
        groups = []
        if text:
            a, b = left.encode(" " + text, add_special_tokens=False).ids, right.encode(text)
            sides = [[tables.first_bytes[i] for i in a], [tables.second_bytes[i] for i in b]]
            raw = (" " + text).encode()
            if all(b"".join(side) == raw for side in sides):
                ends = [set(np.cumsum([len(t) for t in side]).tolist()) for side in sides]
                cuts = np.array(sorted(ends[0] & ends[1]))
                groups = [([], []) for _ in cuts]
                for ids, side, at in ((a, sides[0], 0), (b, sides[1], 1)):
                    end = 0
                    for i, t in zip(ids, side):
                        end += len(t)
                        groups[int(np.searchsorted(cuts, end))][at].append(i)
        pairs = Counter((p, q) for x, y in groups for p in x for q in y)
        linked.update(pairs.keys())
        found.append((key, groups, pairs))
    best = defaultdict(int)
    for (p, _), n in linked.items():
        best[p] = max(best[p], n)
    out = []
    for key, groups, pairs in found:
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            key, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(pairs.values()),
            sum(n for p, n in pairs.items() if linked[p] == best[p[0]]), sum(n * linked[p] for p, n in pairs.items()),
            hashlib.sha256(shown.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=repr)


ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_equals_the_libraries_on_whole_texts(spark, monkeypatch):
    odd = [
        (1, "a\r\n b\r c \r\nd"), (2, "  two  spaces   here "), (3, "tab\tand\x0bvt\x0cff"), (4, "a▁b"),
        (5, "nbsp\xa0x　wide thin"), (6, "<|endoftext|> <s> </s> <unk> <0x41>"), (7, "日本語のテキスト"),
        (8, "naïve café é ﬁ"), (9, "\x00 nul \x1c fs \x85 nel"), (10, "'s don't I'll  's"), (11, " "),
        (12, "x" * 3000 + " " + "ab" * 900), (13, "}\r\n{\r"), (14, "🙂🙃 🙂"), (15, "\n\n\n"), (16, "a \n b"),
    ]
    noise = random.Random(3)
    signs = "ab \r\n\t'sé▁\xa0　1.🙂"
    odd += [(100 + i, "".join(noise.choices(signs, k=noise.randrange(1, 40)))) for i in range(300)]
    rows = [(r[0], r[1]) for r in given(60) + awkward()] + odd
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 1 << 16)
    monkeypatch.setattr(alignment, "FRAME", 512)
    monkeypatch.setattr(alignment, "LOT", 1 << 13)
    monkeypatch.setattr(alignment, "WIDE", 6)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = alignment.aligned(docs, *alignment.default_paths()).select(ALIGNED).collect()
    assert sorted(map(tuple, got), key=repr) == brute_alignment(rows)


def test_alignment_keeps_columns_and_empty_tables(spark):
    docs = clashing(documents(spark, awkward()))
    found = alignment.aligned(docs, *alignment.default_paths())
    assert set(CLASHING) <= set(found.columns) and "text" not in found.columns
    assert found.count() == docs.count()
    assert found.where("doc_id = 900001").select(ALIGNED[1:]).first() == (0, 0, 0, 0, 0, 0, "")
    assert alignment.aligned(docs.limit(0), *alignment.default_paths()).count() == 0


def test_runs_merge_in_order():
    noise = np.random.default_rng(4)
    runs, expected = [], Counter()
    for _ in range(7):
        pair, place = np.unique(noise.integers(0, 400, (2000, 2)), axis=0).T
        expected.update(pair.tolist())
        runs.append(alignment.frames(pair, place, np.ones(len(pair), np.int64)))
    found = list(alignment.merged(runs))
    pairs = np.concatenate([p for p, _ in found])
    assert (np.diff(pairs) > 0).all()
    assert dict(zip(pairs.tolist(), np.concatenate([n for _, n in found]).tolist())) == expected


# --- collocations


def test_collocations_equal_the_sql(spark, monkeypatch):
    noise = random.Random(5)
    words = ["Alpha", "beta", "gamma", "delta", "É", "of", "the", "x1"]
    texts = [
        noise.choice(" ,.\n\t").join(
            noise.choice([" ", "  ", "\t", ". ", " , "]).join(noise.choices(words, [8, 6, 5, 3, 2, 9, 9, 1], k=40))
            for _ in range(3)
        ) for _ in range(200)
    ]
    rows = [(i, t, ["en", "de", None, "und"][i % 4], "s", len(t)) for i, t in enumerate(texts)] + awkward()
    docs = documents(spark, rows).repartition(3)
    monkeypatch.setattr(collocations, "BATCH", 50_000)
    monkeypatch.setattr(collocations, "SLICES", 8)
    monkeypatch.setattr(collocations, "WIDTH", collocations.BITS // 8)
    got = collocations.collocations(clashing(docs))
    con = duckdb.connect()
    table = docs.select("text", "lang").toPandas()
    con.register("documents", table)
    expected = con.execute(collocations.COLLOCATION_SQL).fetchall()
    assert len(expected) > 300 and {r[0] for r in expected} >= {"en", "de", "und"}
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    few = collocations.collocations(docs, listed=3).collect()
    assert sorted((r["lang"], r["rank"]) for r in few)[:3] == [("de", 1), ("de", 2), ("de", 3)]
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_scores_pass_64_bits(spark):
    # Counts as they would be in a very large corpus, put in where phrases are counted.
    rows = [("en", 0, "", 10**17), ("en", 1, "a", 9 * 10**13), ("en", 1, "b", 8 * 10**13), ("en", 2, "a b", 7 * 10**13)]
    grams = spark.createDataFrame(rows, "lang string, size byte, phrase string, f long")
    docs = spark.createDataFrame([], "text string, lang string")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(collocations, "counts", lambda docs, least: grams)
        row = collocations.collocations(docs).first()
    assert tuple(row) == ("en", 1, "a b", 7 * 10**13, 9 * 10**13, 8 * 10**13, 10**17, 2_000_000 * 7 // 17)


# --- extraction

RUN = "A sentence of running text, long enough to count, number "


def page(number, marked=True, extra="", article=None):
    """A page with everything around its article, and the article's text."""
    noise = random.Random(number)
    lines = article or [f"{RUN}{number} {i} {noise.random()}." for i in range(noise.randrange(1, 5))]
    body = "".join(f"<p>{line}<b> bold</b>&amp;</p>" if i % 2 else f"<p class='x'>{line}" for i, line in enumerate(lines))
    menu = "".join(f"<li><a href=/{i}>m{noise.randrange(99)}</a></li>" for i in range(noise.randrange(2, 7)))
    tag = "article" if marked else "div"
    html = (
        f"<html><head><title>T{number}</title><script>var a='</p>';</script></head><body>"
        f"<div class=wrap><ul>{menu}</ul></div><header>Site</header><{tag} id=c{number}><h1>Head {number}</h1>{body}"
        f"<div class='ad-box'>Buy {number}</div><aside>See</aside><form>Name<input></form>{extra}</{tag}>"
        f"<div class=x><div>Made by us with great care, for all of our many readers.</div></div>"
        f"<section id=comments><p>{RUN} comment</p></section><footer>&copy; {number}</footer></body></html>"
    )
    shown = [f"Head {number}"] + [line + " bold&" if i % 2 else line for i, line in enumerate(lines)]
    return html, "\n".join(shown)


def extracted(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return {r["page_id"]: r for r in extraction.extract(pages).collect()}


def test_articles_are_extracted_with_and_without_marks(spark):
    rows, expected = [], {}
    for i in range(120):
        # One host of many pages, some of few, marked or not.
        host = "large.example" if i % 3 else f"h{i // 24}.example"
        html, expected[i] = page(i, marked=i % 2 == 0)
        rows.append((i, f"https://{host}/{i}", html))
    got = extracted(spark, rows)
    marked = [i for i in expected if i % 2 == 0]
    assert [got[i]["text"] for i in marked] == [expected[i] for i in marked]
    assert all(got[i]["n_chars"] == len(expected[i]) for i in marked)
    # Without marks the repeated line is known from the other pages of the host.
    unmarked = [i for i in expected if i % 2 and i % 3]
    assert [got[i]["text"] for i in unmarked] == [expected[i] for i in unmarked]


def test_text_that_every_page_repeats_goes_and_copies_stay(spark):
    note = "<p>Read more of our stories by signing up today, dear reader.</p>"
    rows, expected = [], {}
    copy = [f"{RUN} that many pages share."]
    for i in range(40):
        html, expected[i] = page(i, extra=note, article=copy if i % 3 else None)
        rows.append((i, "http://one.example/x", html))
    for i in range(40, 60):
        # Nothing but copies: the text is the article.
        rows.append((i, "http://two.example/", page(7)[0]))
        expected[i] = page(7)[1]
    got = extracted(spark, rows)
    assert {i: r["text"] for i, r in got.items()} == expected


def test_templates_joined_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(extraction, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(extraction, "PAGES_PER_PART", 7)
    rows = [(i, f"http://h{i % 3 // 2}.example", page(i, marked=False)[0]) for i in range(60)]
    assert {i: r["text"] for i, r in extracted(spark, rows).items()} == {i: page(i)[1] for i in range(60)}


def test_awkward_pages(spark):
    htmls = [
        None, "", "   ", "plain <3 text & more", "<p>a<!-- open", "<div", "<script>x", "<p>x" * 3000,
        "<div>" * 5000 + "deep" + "</p>" * 5000, "<article><p>a\xa0\n b<br>c</article>", "<a href=\"x>y</a>",
        "<article></article>", "&lt;p&gt; &#233; &bogus; &#0;",
    ]
    rows = [(i, None if i % 2 else "not an address", h) for i, h in enumerate(htmls)]
    rows += [(None, None, "<p>twice</p>"), (None, None, "<p>twice</p>")]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    found = extraction.extract(pages)
    assert set(CLASHING) <= set(found.columns) and "html" not in found.columns
    got = found.collect()
    by_id = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(rows) and by_id[None] == "twice"
    assert [by_id[i] for i in (0, 1, 2, 3, 9, 11)] == ["", "", "", "plain <3 text & more", "a b c", ""]
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert extraction.extract(pages.limit(0)).count() == 0


def test_given_pages_give_their_article(spark):
    import html as references

    found = {r["page_id"]: r["text"] for r in extraction.extraction_query(spark, SMALL).collect()}
    for key, _, raw in given(table="pages"):
        inner = re.search(r"<article>(.*?)</article>", raw, re.S).group(1)
        parts = [" ".join(references.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split("</?(?:p|h1)>", inner)]
        assert found[key] == "\n".join(p for p in parts if p)


def test_broken_tokens_leave_the_root():
    tokens = [
        {"token": t, "vector": "v", "pages": 100, "total": 100, "first": float(t), "text": False} for t in (1, 2, 3, 4)
    ]
    observed = [(0, 0, 3, 5, 0, 0, 0, 0, 0), (3, 2, 0, 100, 0, 0, 50, 0, 2), (3, 3, 0, 100, 0, 0, 70, 1, 3)]
    names = ["kind", "gap", "token", "pages", "low", "high", "chars", "linked", "blocks"]
    template = extraction.Template(100, tokens, [dict(zip(names, o)) for o in observed])
    assert template.root == [1, 2, 4] and template.stats == {(2, 0): (120, 1, 5)}
    rows = {"tokens": [1, 3, 2, 4], "places": [], "others": [], "chars": [], "linked": []}
    seen = extraction._observe(extraction.Template(100, tokens, None), rows)
    assert [o[:3] for o in seen] in ([(0, 0, 3)], [(0, 0, 2)])
    assert json.dumps(sorted(template.constant)) == "[]" and DOCS
