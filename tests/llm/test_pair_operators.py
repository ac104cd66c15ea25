"""Archives, near-duplicate joins, repeated passages and search against brute force."""

import collections
import gzip
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import components, jaccard, neardup, repeats, search, warc, words
from docloom.llm.vectors import usable
from docloom.session import scratch_path
from tests.llm.common import awkward, documents, given


def roots(count, links):
    parent = list(range(count))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(count)]


# --- words


def test_word_hashes_depend_on_the_words_alone():
    texts = ["a b  c\n a", "", " x\x0b\x0cy ", "b", "a" * 300 + " a", "é a"]
    together = words.Words(words.encode(texts))
    for i, text in enumerate(texts):
        alone = words.Words(words.encode([text]))
        assert together.hashes[together.first[i] : together.first[i + 1]].tolist() == alone.hashes.tolist()
        assert len(alone.hashes) == len(text.encode().split())
    every = [w for t in texts for w in t.encode().split()]
    assert len(set(together.hashes.tolist())) == len(set(every))


def test_shingle_sets_count_distinct_shingles():
    texts = ["a b c a b c a b", "a b", "", "a b c", "a b c d e f g"]
    tokens, edges = words.shingle_sets(words.Words(words.encode(texts)), 3)
    assert np.diff(edges).tolist() == [3, 1, 0, 1, 5]


# --- components


def test_components_against_a_plain_search(spark):
    random = np.random.default_rng(4)
    for count, links in ((60, 40), (200, 260), (1, 0)):
        pairs = [tuple(map(int, p)) for p in random.integers(0, count, (links, 2))]
        pairs += [(i, i + 1) for i in range(100, 140)] if count == 200 else []
        df = spark.createDataFrame(pairs or [], "a long, b long")
        want = roots(count, pairs)
        got = {r["node"]: r["component"] for r in components.components(df).collect()}
        assert got == {i: want[i] for p in pairs for i in p if p[0] != p[1]}
    assert components.local_roots(np.array([0, 3, 2]), np.array([1, 2, 4]), 6).tolist() == [0, 0, 2, 2, 2, 5]


# --- archives

PAGE = "page_id long, url string, html string, archive string, n int"


def pages(spark):
    big = "<p>" + "x" * 300 + "</p>"
    rows = [
        (5, "http://a/ b\r\nc", big), (3, "http://b", big), (9, None, big), (None, "http://n", big),
        (1, "http://e", None), (2, "http://e2", ""), (4, "s", "short"), (6, "s", "short"), (7, "ü", "é" * 70_000),
        (8, "x", "a\r\n\r\nb" * 60), (8, "x", "a\r\n\r\nb" * 60), (None, "y", "z" * 200), (None, "y", "z" * 200),
    ]
    return rows, spark.createDataFrame([(*r, "q", 1) for r in rows], PAGE)


def test_archives_round_trip(spark):
    rows, df = pages(spark)
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(warc.classify(df).coalesce(2), folder, archive_bytes=2000)
    assert manifest.count() > 2
    found = warc.read_archives(manifest, folder, with_payload=True).collect()
    assert len(found) == len(rows) and all(r["verified"] for r in found)
    smallest = {}
    for i, _, html in rows:
        if html and len(html.encode()) >= 100 and i is not None:
            smallest[html] = min(i, smallest.get(html, i))
    want = collections.Counter()
    for i, _, html in rows:
        first = smallest.get(html or "")
        revisit = first is not None and first != i
        raw = (html or "").encode()
        want[(i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response",
              first if revisit else None, None if revisit else raw)] += 1
    assert want == collections.Counter(
        (r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"],
         None if r["payload"] is None else bytes(r["payload"])) for r in found)


def test_every_record_is_a_gzip_member_and_damage_shows(spark, tmp_path):
    rows, df = pages(spark)
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(warc.classify(df).coalesce(1), folder)
    name = manifest.first()["archive"]
    raw = open(f"{folder}/{name}", "rb").read()
    assert raw.count(b"\x1f\x8b\x08") >= len(rows)
    assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == len(rows)
    with open(f"{folder}/{name}", "rb") as source:
        first = next(warc.records(source, name))
    assert first[-1]
    cut = tmp_path / "cut"
    cut.write_bytes(raw[:-30])
    with pytest.raises(ValueError), open(cut, "rb") as source:
        list(warc.records(source, "cut"))
    text = gzip.decompress(raw)
    changed = tmp_path / "changed"
    changed.write_bytes(gzip.compress(text[: text.index(b"WARC/1.1", 10)].replace(b"xxxx", b"xxxy").replace(b"zzzz", b"zzzy")))
    with open(changed, "rb") as source:
        assert not all(r[-1] for r in warc.records(source, "changed")) or b"xxxx" not in text[:900]


def test_archives_of_an_empty_table(spark):
    _, df = pages(spark)
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(warc.classify(df.limit(0)), folder)
    assert warc.read_archives(manifest, folder).count() == 0


# --- Jaccard join


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or frozenset([tuple(w)] if w else [])


def jaccard_links(sets):
    return [
        (i, j) for i in range(len(sets)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]


def variants():
    """Groups around the threshold, short and long, and one passage that many texts share."""
    random = np.random.default_rng(8)
    vocabulary = [f"v{i}" for i in range(3000)]
    rows, number = [], 0
    passage = " ".join(random.choice(vocabulary, 60))
    for size in (6, 8, 9, 10, 12, 14, 18, 24, 30, 45, 80, 300):
        for _ in range(4):
            base = list(random.choice(vocabulary, size))
            for change in range(5):
                text = list(base)
                for place in random.choice(size, min(size, change), replace=False):
                    if place % 2:
                        text[place] = "zz"
                    else:
                        text = text[:place] + text[place + 1 :]
                        break
                number += 1
                rows.append((number, " ".join(text), None, None, 0))
    for i in range(60):
        number += 1
        own = " ".join(random.choice(vocabulary, 20 + i))
        rows.append((number, f"{own} {passage}", None, None, 0))
    return rows


@pytest.mark.parametrize("often", [16, 2])
def test_jaccard_components_against_all_pairs(spark, monkeypatch, often):
    monkeypatch.setattr(jaccard, "OFTEN", often)
    rows = given(100) + awkward() + variants()
    docs = documents(spark, rows).repartition(3)
    sets = [shingles(r[1]) for r in rows]
    want = roots(len(rows), jaccard_links(sets))
    members = collections.defaultdict(list)
    for i, root in enumerate(want):
        members[root].append(i)
    found = jaccard.similar(docs).collect()
    assert len(found) == len(rows)
    expected = collections.Counter()
    for i, row in enumerate(rows):
        ids = [rows[m][0] for m in members[want[i]] if rows[m][0] is not None]
        expected[(row[0], len(sets[i]), min(ids) if ids and sets[i] else row[0])] += 1
    assert expected == collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found)
    single = jaccard.one_per_group(docs)
    assert single.columns == docs.columns
    assert single.count() == len({want[i] for i in range(len(rows)) if sets[i]}) + sum(not s for s in sets)


@pytest.mark.parametrize("boundary", [0, 8, 30])
def test_any_boundary_gives_the_same_components(spark, monkeypatch, boundary):
    monkeypatch.setattr(jaccard, "choose_boundary", lambda sizes, length: boundary)
    rows = variants()
    want = roots(len(rows), jaccard_links([shingles(r[1]) for r in rows]))
    found = {r["doc_id"]: r["component_id"] for r in jaccard.similar(documents(spark, rows)).collect()}
    assert found == {r[0]: rows[want[i]][0] for i, r in enumerate(rows)}


def test_boundary_follows_the_cost():
    sizes = {n: 100 for n in range(1, 31)}
    assert jaccard.choose_boundary(sizes, 1.0) == 0
    assert all(0 < jaccard.choose_boundary(sizes, length) <= 30 for length in (1.5, 3.0, 9.0))
    assert jaccard.choose_boundary({}, 3.0) == 0


def test_overlaps_are_exact():
    for n in range(1, 60):
        least = min(o for o in range(n + 1) if 100 * o >= 80 * n)
        assert jaccard.least_overlap(n) == least
        for m in range(1, 60):
            want = min(o for o in range(n + m + 1) if 100 * o >= 80 * (n + m - o))
            assert jaccard.needed_overlap(n, m) == want


def test_range_counts_bound_the_overlap():
    random = np.random.default_rng(6)
    for n, m, common in ((5, 9, 3), (300, 40, 30), (3000, 2500, 2000), (70_000, 60_000, 100)):
        every = random.integers(0, 1 << 63, n + m - common, dtype=np.uint64) * np.uint64(2)
        a, b = np.sort(every[:n]), np.sort(every[n - common :])
        bound = jaccard.overlap_bound(jaccard.ranges(a), n, jaccard.ranges(b), m)
        assert common <= bound <= min(n, m)


def test_jaccard_of_an_empty_table(spark):
    empty = documents(spark, [])
    assert jaccard.similar(empty).count() == 0 and jaccard.one_per_group(empty).count() == 0


# --- repeated passages


def without(rows):
    """Kept words and number of removed ones of each row, from all windows."""
    split = [(r[1] or "").encode().split() for r in rows]
    size = repeats.WINDOW
    seen = collections.Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    for w in split:
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = True
        yield [x for x, g in zip(w, gone) if not g], int(gone.sum())


def test_cover_reaches_every_pair_of_offsets():
    differences = {(a - b) % repeats.PERIOD for a in repeats.COVER for b in repeats.COVER}
    assert differences == set(range(repeats.PERIOD))


def test_repeats_against_all_windows(spark):
    random = np.random.default_rng(9)
    vocabulary = [f"u{i}" for i in range(5000)]
    rows, number = given(120) + awkward(), 10_000
    for size in (34, 35, 36, 40, 70):
        passage = list(random.choice(vocabulary, size))
        for _ in range(7):
            number += 1
            text = [*random.choice(vocabulary, random.integers(0, 50)), *passage, *random.choice(vocabulary, random.integers(0, 30))]
            rows.append((number, "  ".join(text), None, None, 0))
    rows.append((20_000, "again " * 90, None, None, 0))
    docs = documents(spark, rows).repartition(4).cache()
    want = collections.Counter((r[0], r[1], g) for r, (_, g) in zip(rows, without(rows)))
    changed = {(r["key"]): r for r in repeats.without_repeats(docs).collect()}
    keyed = docs.withColumn("_k", repeats.row_key(F.col("doc_id"), F.col("text"))).collect()
    got = collections.Counter((r["doc_id"], r["text"], changed[r["_k"]]["n_removed"] if r["_k"] in changed else 0) for r in keyed)
    assert got == want
    kept = {(r[0], r[1]): b" ".join(k).decode() for r, (k, g) in zip(rows, without(rows)) if g}
    for r in keyed:
        if r["_k"] in changed:
            assert changed[r["_k"]]["kept"] == kept[(r["doc_id"], r["text"])]
    clean = repeats.remove_repeats(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    assert repeats.without_repeats(documents(spark, [])).count() == 0


# --- embeddings

VECTOR = "vec_id long, embedding array<float>, label int, node string, copies int"


def vectors(spark):
    random = np.random.default_rng(10)
    base = random.normal(size=(60, 16))
    rows = [base[i // 4] + random.normal(size=16) * 0.08 * (i % 4) for i in range(160)]
    rows += [rows[0]] * 5 + [rows[4] * 3, rows[8] * 1e-20, -rows[8]]
    made = [(int(i * 10), [float(x) for x in r]) for i, r in enumerate(rows)]
    made += [(5, None), (6, [0.0] * 16), (7, [float("nan")] * 16), (8, [float("inf")] * 16), (9, []), (None, made[0][1]),
             (11, [None] * 16), (12, [1.0, 2.0]), (13, [2.0, 4.1]), (20, made[3][1])]
    return made, spark.createDataFrame([(*r, 1, "n", 2) for r in made], VECTOR)


def unit(v):
    if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
        return None
    v = np.array(v, np.float32).astype(float)
    v = v / np.abs(v).max()
    return v / np.sqrt((v * v).sum())


def close(rows):
    units = [unit(r[1]) for r in rows]
    return [
        (i, j) for i in range(len(rows)) for j in range(i)
        if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.95
    ]


@pytest.mark.parametrize("blocks,chunk", [(4, 4096), (1, 8), (16, 4096)])
def test_near_vectors_against_all_pairs(spark, blocks, chunk):
    rows, df = vectors(spark)
    links = close(rows)
    assert links
    want, degree = roots(len(rows), links), collections.Counter(x for p in links for x in p)
    name = {}
    for i, root in enumerate(want):
        if rows[i][0] is not None:
            name[root] = min(rows[i][0], name.get(root, rows[i][0]))
    found = neardup.near_duplicates(df, blocks=blocks, chunk_rows=chunk).collect()
    expected = collections.Counter((r[0], degree[i], name.get(want[i]), r[0] == name.get(want[i])) for i, r in enumerate(rows))
    assert expected == collections.Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in found)
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_usable_vectors(spark):
    rows, df = vectors(spark)
    got = {i for i, g in df.select("vec_id", usable(F.col("embedding")).alias("g")).collect() if not g}
    assert got == {5, 6, 7, 8, 9, 11}


def test_search_against_all_products(spark):
    rows, df = vectors(spark)
    queries = df.where("vec_id % 50 = 0 or vec_id = 12")
    found = collections.defaultdict(list)
    for r in search.nearest(df, queries, k=5, probed=1.0).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    good = [(r[0], np.array(r[1], np.float32).astype(float)) for r in rows if unit(r[1]) is not None and r[0] is not None]
    asked = [g for g in good if g[0] % 50 == 0 or g[0] == 12]
    assert set(found) == {g[0] for g in asked}
    for i, q in asked:
        scores = sorted(((-(q * v).sum(), j) for j, v in good if j != i and len(v) == len(q)))[:5]
        assert [(r, j) for r, j, _ in found[i]] == [(n + 1, j) for n, (_, j) in enumerate(scores)]
        assert [s for _, _, s in found[i]] == pytest.approx([-s for s, _ in scores], rel=1e-12)
    assert search.nearest(df.limit(0), queries).count() == 0
    assert search.nearest(df, queries.limit(0)).count() == 0


@pytest.mark.parametrize("count", [5, 20, 30, 60])
def test_search_of_few_rows_finds_all(spark, count):
    """Also of a size that is rare in a larger table, with a query whose row is repeated."""
    rows = [(r[0], list(map(float, r[1]))) for r in given(2000, "embeddings", "/root/testdata/sf0.1")]
    few = [(100_000 + i, v) for i, (_, v) in enumerate(rows[:count])]
    few += [few[0]] * 3
    rare = [(i + 100_000, v[:24]) for i, v in few]
    for table, asked in ((few, few), (rows + rare, rare)):
        df = spark.createDataFrame(table, "vec_id long, embedding array<float>")
        queries = df.where("vec_id >= 100000")
        queries = queries.where(F.size("embedding") == len(asked[0][1]))
        found = collections.defaultdict(list)
        for r in search.nearest(df, queries).orderBy("query_id", "rank").collect():
            found[r["query_id"]].append(r["vec_id"])
        values = {i: np.array(v, np.float32).astype(float) for i, v in asked}
        for i, q in values.items():
            scores = sorted((-float((q * values[j]).sum()), j) for j, _ in asked if j != i)
            assert found[i] == [j for _, j in scores[:20]]


def test_leading_rows_are_not_tested_away():
    random = np.random.default_rng(13)
    # Rows differ from the query in the first block of turned columns alone, so it overstates their distance.
    query = random.normal(size=(1, 64))
    gap = np.where(np.arange(64) < 16, random.normal(size=(45, 64)), 0)
    rows = query + gap @ search.rotation(64).T
    i, j, _ = search.scan(query, np.full(1, -np.inf), np.arange(45), rows, np.full(1, -1), 20)
    assert len(j) == 20


def test_search_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = given(table="embeddings", sf=sf)
    table = np.array([r[1] for r in rows], np.float32).astype(float)
    ids = np.array([r[0] for r in rows])
    found = collections.defaultdict(set)
    for r in search.search_query(spark, sf).collect():
        found[r["query_id"]].add(r["vec_id"])
    recall = []
    for i in np.flatnonzero(ids % 20 == 0):
        score = table @ table[i]
        score[i] = -np.inf
        recall.append(len(found[ids[i]] & set(ids[np.lexsort((ids, -score))[:20]].tolist())) / 20)
    assert np.mean(recall) >= 0.9
