"""Quality, language, encoding, personal data, mixture and pipeline on small tables."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import bpe, language, mixing, pii, quality
from tests.llm.common import SMALL, awkward, documents, given

MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, given(120) + awkward())


@pytest.fixture(scope="module")
def empty(spark):
    return documents(spark, [])


def ids(rows):
    return sorted((r["doc_id"] for r in rows), key=lambda i: (i is None, i))


# --- quality


def test_quality_learns_held_out_labels(spark):
    found = quality.quality_query(spark, MEDIUM)
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    rows = found.where("held_out").join(labels, "doc_id").select("predicted", "quality", "score").collect()
    right = sum(r["predicted"] == r["quality"] for r in rows) / len(rows)
    assert len(rows) > 50 and right >= 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_quality_scores_every_awkward_row(spark, docs, empty):
    labels = spark.createDataFrame([(i, int(i % 9 > 0)) for i in range(100)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    rows = quality.score(docs.select("doc_id", "text"), model, "doc_id").collect()
    assert ids(rows) == ids(docs.collect())
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score(empty, model, "doc_id").count() == 0
    for none in (labels.limit(0), labels.where("quality = 1")):
        flat = quality.train(docs, none)
        assert len({r["score"] for r in quality.score(docs, flat, "doc_id").collect()}) == 1
    assert quality.train(empty, labels) is not None


def test_negative_risk_is_held_above_zero():
    random = np.random.default_rng(1)
    good, bad = random.normal(1, 1, (400, 6)), random.normal(-2, 1, (100, 6))
    model = quality.fit(good[:200], np.concatenate((good[200:], bad)), 0.66)
    assert (quality.predict(model, good) >= 0.7).mean() > 0.9
    assert (quality.predict(model, bad) < 0.5).mean() > 0.9


# --- language


def test_language_of_held_out_documents(spark):
    found = language.language_query(spark, MEDIUM)
    truth = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(truth, "doc_id").collect()
    assert len(rows) > 100
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) >= 0.97


def test_words_of_two_languages_are_told_apart(spark):
    model = language.train(spark.read.parquet(f"{MEDIUM}/documents.parquet"))
    en = "the and that with for this from are was of to in".split()
    de = "der die und das nicht mit sich des auf für ist im".split()
    tagger = language.Tagger(model["shared"].value)
    found, sizes = tagger.tag([" ".join(en + de), None, ""])
    names = [model["names"][k] for k in found.argmax(axis=1)]
    assert sizes.tolist() == [24, 0, 0]
    assert names[:10] == ["en"] * 10 and names[14:] == ["de"] * 10
    assert np.allclose(found.sum(axis=1), 1, atol=1e-4)


def test_forward_backward_against_enumeration():
    random = np.random.default_rng(3)
    emission, initial = random.normal(size=(4, 1, 3)), random.normal(size=3)
    moves = random.normal(size=(3, 3))
    want, total = np.zeros((4, 3)), 0.0
    for path in np.ndindex(3, 3, 3, 3):
        score = initial[path[0]] + sum(emission[t, 0, k] for t, k in enumerate(path))
        score = np.exp(score + sum(moves[a, b] for a, b in zip(path, path[1:])))
        total += score
        for t, k in enumerate(path):
            want[t, k] += score
    got = language.marginals(emission, np.array([4]), initial, moves)[:, 0]
    assert np.allclose(got, want / total)


def test_language_of_awkward_rows(spark, docs, empty):
    model = language.train(docs)
    rows = language.predict(docs, model, ["doc_id"]).collect()
    assert ids(rows) == ids(docs.collect())
    by = {r["doc_id"]: r for r in rows}
    for i in (900_001, 900_002, 900_003, 900_004):
        assert (by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0)
    assert by[900_006]["lang_pred"] in model["names"]
    assert language.predict(empty, model, ["doc_id"]).count() == 0
    nothing = language.train(empty)
    assert {r["lang_pred"] for r in language.predict(docs, nothing, ["doc_id"]).collect()} == {"und"}


def test_long_words_are_read_whole(spark):
    for size in (1, 32, 33, 62, 63, 64, 1000):
        word = "".join(chr(0x4E00 + i) for i in range(size))
        found = language.parts(word)
        assert max(map(len, found)) <= language.SEEN
        assert "".join(p[:-2] for p in found[:-1]) + found[-1] == word
    model = language.train(spark.read.parquet(f"{MEDIUM}/documents.parquet"))
    middle = "derdieunddasnichtmitsichdesauffüristimeinedemauch" * 40
    text = "thethatwiththisf" + middle + "romwhichthethatt"
    rows = [(1, text, None, None, 0), (2, "the that with this", None, None, 0)]
    found = language.predict(documents(spark, rows), model, ["doc_id"]).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in found} == {1: "de", 2: "en"}


def test_unspaced_texts_are_learned_from_their_middle(spark):
    random = np.random.default_rng(12)
    ends = "".join(chr(0x4E00 + i) for i in range(16))

    def text(base):
        return ends + "".join(chr(base + int(i)) for i in random.integers(0, 200, 400)) + ends

    bases = {"one": 0x5000, "two": 0x6000}
    rows = [(i, text(bases[lang]), lang, None, 0) for i, lang in enumerate(["one", "two"] * 40)]
    docs = documents(spark, rows)
    model = language.train(docs.where("doc_id < 40"))
    found = language.predict(docs.where("doc_id >= 40"), model, ["doc_id", "lang"]).collect()
    assert len(found) == 40 and all(r["lang"] == r["lang_pred"] for r in found)


# --- encoding


def test_encoding_agrees_with_the_library(spark, docs, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_path())
    more = documents(spark, [
        (1, "<|startoftext|>Hello <|endoftext|>it's 'S we'LL \x85\xa0 x²½", None, None, 0),
        (2, "ab" * 5000, None, None, 0), (3, "🙂🙂 ﬁ Ⅷ áb ΑΣ", None, None, 0), (4, "<|startoftext|", None, None, 0),
    ])
    rows = bpe.decode(bpe.encode(docs.union(more), bpe.default_path()), bpe.default_path()).collect()
    assert len(rows) == docs.count() + 4
    for r in rows:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == want
        assert r["decoded"] == library.decode(want, skip_special_tokens=False)
    assert bpe.encode(empty, bpe.default_path()).count() == 0


def test_encoding_query_digests(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_path())
    found = {r["doc_id"]: r for r in bpe.bpe_query(spark, SMALL).collect()}
    for row in given():
        want = library.encode(row[1], add_special_tokens=False).ids
        r = found[row[0]]
        raw = np.array(want, "<u4").tobytes()
        text = library.decode(want, skip_special_tokens=False).encode()
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(want), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text).hexdigest())


def test_pairs_that_pass_are_what_merging_gives():
    vocabulary = bpe._vocabulary(bpe.default_path())
    for word in ("thatthanesble", "aaaaaaa", "unhappiness", "zzzzqqqq", "x", "theththe"):
        proposed = np.array(vocabulary.proposed(word))
        exact = vocabulary.merged([vocabulary._symbols(word)])[0].tolist()
        if vocabulary.compatible(proposed[:-1], proposed[1:]).all():
            assert proposed.tolist() == exact


# --- personal data

_BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    def good(kind, body):
        digits = re.sub("[^0-9]", "", body)
        return (
            kind == "email" or kind == "ip" and all(int(p) <= 255 for p in body.split("."))
            or kind == "card" and 13 <= len(digits) <= 19 and pii.luhn(digits)
            or kind == "phone" and 9 <= len(digits) <= 15
        )

    return [
        (kind, m.start(), m.end())
        for kind, pattern in _BASE.items() for m in re.finditer(pattern, text or "") if good(kind, m.group())
    ]


TRICKY = [
    "a@b.c_d@e.f x@@y.z @q.r m@n m@n. a.b+c%d-e@x-y.co.uk.", "1.2.3.4.5.6.7.8 256.1.1.1 1.1.1 0001.002.3.255",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111", "+1 (206) 555-0100 +12 +1234567890123456 ++49 30 123456",
    "tel (206) 555-0100, mail jo at corp dot com or jo [at] corp [dot] com, host 10[.]0[.]0[.]1", "日本 a@b.de 🙂 +49 30 1234567",
    "9" * 5000 + " " + "1." * 5000, "x" * 5000 + "@a.b",
]


def test_base_spans_against_the_patterns(spark, docs, empty):
    rows = documents(spark, [(800_000 + i, t, None, None, 0) for i, t in enumerate(TRICKY)]).union(docs)
    weights = pii.train(rows)
    found = pii.annotate(rows, weights, "doc_id", "text").collect()
    assert len(found) == rows.count()
    for r in found:
        assert r["base"] == pii.joined(plain_spans(r["text"]))
        assert {s for s in r["base"].split(",") if s} <= set(r["spans"].split(","))
    assert pii.annotate(empty, pii.train(empty), "doc_id").count() == 0
    clean = {r["doc_id"]: r["text"] for r in pii.mask(rows, weights).collect()}
    assert clean[800_005] == "日本 <EMAIL> 🙂 <PHONE>" and clean[900_001] is None and clean[900_002] == ""


def test_pii_query_counts(spark):
    for r in pii.pii_query(spark, SMALL).collect():
        spans = plain_spans(dict((g[0], g[1]) for g in given())[r["doc_id"]])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [
            sum(s[0] == k for s in spans) for k in pii.KINDS]
        assert r["base_sha256"] == hashlib.sha256(pii.joined(spans).encode()).hexdigest()


def test_reliabilities_follow_the_better_labelers():
    random, counts = np.random.default_rng(2), {}
    for _ in range(4000):
        real = random.random() < 0.4
        vote = [1 if (random.random() < p) == real else -1 for p in (0.95, 0.9, 0.85, 0.55)]
        counts[tuple(vote)] = counts.get(tuple(vote), 0) + 1
    real = pii.reliabilities(counts)
    assert real[(1, 1, 1, -1)] > 0.9 and real[(-1, -1, -1, 1)] < 0.1
    assert real[(1, 1, -1, -1)] > 0.5


# --- mixture


def test_mixture_of_awkward_rows(spark, docs, empty):
    rows = mixing.copies_per_document(docs, ["doc_id", "source"]).collect()
    assert len(rows) == docs.count()
    total = sum(r["size"] for r in rows)
    targets = {r["_row"]["source"]: (r["target"], r["source_size"]) for r in rows}
    assert sum(t for t, _ in targets.values()) == pytest.approx(1.5 * total)
    assert all(t <= 2 * s and r["copies"] <= 2 for t, s in targets.values() for r in rows)
    again = mixing.copies_per_document(docs.repartition(5), ["doc_id", "source"]).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert mixing.copies_per_document(empty, ["doc_id"]).count() == 0
    emitted = mixing.emit(docs)
    assert emitted.columns == docs.columns
    assert emitted.count() == sum(r["copies"] for r in rows)


def test_taken_words_come_near_the_targets(spark):
    rows = mixing.mix_query(spark, "/root/testdata/sf0.1")
    near = rows.join(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "source"), "doc_id")
    for r in near.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect():
        assert r["taken"] == pytest.approx(r["target"], rel=0.15)


def test_no_python_in_the_mixture(spark, docs):
    plan = mixing.copies_per_document(docs, ["doc_id"])._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan.replace("ArrowCollect", ""))
