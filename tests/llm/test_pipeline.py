"""The corpus pipeline, stage by stage, against plain Python."""

import collections
import hashlib

import corpus_pipeline
import numpy as np
import pytest
from tokenizers import Tokenizer

from docloom.llm import bpe, language, mixing, pii
from docloom.llm.store import stored
from tests.llm.common import awkward, documents, given
from tests.llm.test_pair_operators import jaccard_links, roots, shingles


@pytest.fixture(scope="module")
def steps(spark):
    docs = stored(documents(spark, given(150) + awkward()), "pipeline-test")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], ""), "pipeline-test"))
    return [[r.asDict() for r in df.collect()] for df in out]


def test_stages_keep_the_columns(steps):
    for rows in steps[1:-1]:
        assert list(rows[0]) == list(steps[0][0])


def test_only_texts_without_letters_go(steps):
    def key(r):
        return str(r["doc_id"]), r["text"]

    kept = collections.Counter(map(key, steps[1]))
    assert kept == collections.Counter(key(r) for r in steps[0] if language.words_of(r["text"]))


def test_a_missing_language_is_predicted(spark):
    rows = [(*r[:2], None if r[0] % 5 == 0 else r[2], *r[3:5]) for r in given(200)]
    docs = documents(spark, rows)
    found = {r["doc_id"]: r for r in corpus_pipeline.identify_language(spark, docs, "").collect()}
    truth = {r[0]: r[2] for r in given(200)}
    lost = [r[0] for r in rows if r[2] is None and r[0] in found]
    assert len(lost) > 20 and all(found[i]["lang"] == truth[i] for i in found if i not in lost)
    assert sum(found[i]["lang"] == truth[i] for i in lost) / len(lost) >= 0.9


def test_one_of_each_group_stays(steps):
    rows = steps[1]
    sets = [shingles(r["text"]) for r in rows]
    groups = roots(len(rows), jaccard_links(sets))
    after = [shingles(r["text"]) for r in steps[2]]
    assert len(after) == len(set(groups))
    owner = {s: g for s, g in zip(sets, groups)}
    assert sorted(owner[s] for s in after) == sorted(set(groups))


def test_personal_data_is_masked_and_nothing_else(steps):
    before = {(r["doc_id"]): r["text"] for r in steps[2]}
    assert len(steps[3]) == len(steps[2])
    for r in steps[3]:
        assert r["n_chars"] == len(r["text"])
        assert not any(k == "email" for k, *_ in pii.decide(r["text"], np.zeros(pii.WIDTH + 1))[0])
        if not pii.proposals(before[r["doc_id"]]):
            assert r["text"] == before[r["doc_id"]]


def test_mixture_repeats_documents(spark, steps):
    plain = documents(spark, [tuple(r.values())[:5] for r in steps[3]])
    want = collections.Counter()
    for r in mixing.copies_per_document(plain, ["doc_id", "text"]).collect():
        want[(r["_row"]["doc_id"], r["_row"]["text"])] += r["copies"]
    assert +want == collections.Counter((r["doc_id"], r["text"]) for r in steps[4])


def test_tokens_are_those_of_the_library(steps):
    library = Tokenizer.from_file(bpe.default_path())
    want = collections.Counter()
    for r in steps[4]:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[(r["doc_id"], len(ids), np.array(ids, "<u4").tobytes(), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert want == collections.Counter(
        (r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded_sha256"]) for r in steps[5])


def test_empty_documents(spark):
    docs = stored(documents(spark, []), "pipeline-test")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ""), "pipeline-test")
    assert docs.count() == 0
