"""Near copies, shared passages and benchmark items against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from carelake.llm import dart, decontam, suffixes
from carelake.llm.common import connected_components
from carelake.llm.kernels import U64, occurrence, shingles, weighted_jaccard, words

from .conftest import odd_documents, prose


def grams(text, n=5):
    w = (text or "").encode().split()
    return Counter(tuple(w[i: i + n]) for i in range(max(len(w) - n + 1, 1))) if w else Counter()


def similarity(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def components(nodes, edges):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {n: top(n) for n in nodes}


def test_words_are_those_of_bytes_split():
    texts = [r[1] for r in odd_documents()] + ["a\x0bb\x0cc\x1cd", "x" * 5000 + " y"]
    w = words(pa.array(texts, pa.string()))
    assert w.counts.tolist() == [len((t or "").encode().split()) for t in texts]
    flat = [x for t in texts for x in (t or "").encode().split()]
    assert len(set(flat)) == len(set(w.hashes.tolist()))
    folded = words(pa.array(["It's, here. 42", "ITS here 42"]), fold=True).hashes
    assert folded[:3].tolist() == folded[3:].tolist()


def test_occurrence_and_weighted_jaccard():
    values = np.array([5, 5, 7, 5, 5], U64)
    assert sorted(occurrence(values, np.array([0, 0, 0, 1, 1])).tolist()) == [0, 0, 0, 1, 1]
    assert weighted_jaccard(values[:3], np.array([5, 7, 8], U64)) == 0.5
    assert weighted_jaccard(values[:0], values) == 0


def test_darts_agree_as_often_as_texts_are_similar():
    rng = np.random.default_rng(3)
    agree, like = [], []
    for n in (1, 6, 90, 1500):
        for _ in range(12):
            a = rng.integers(0, 2**62, n).astype(U64)
            a = np.concatenate((a, a[: n // 5]))
            b = a.copy()
            change = rng.random(len(b)) < 0.15
            b[change] = rng.integers(0, 2**62, change.sum()).astype(U64)
            s = dart.signatures(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]), 150)
            agree.append((s[0] == s[1]).mean())
            like.append(weighted_jaccard(a, b))
    assert abs(np.mean(agree) - np.mean(like)) < 0.02 and np.max(np.abs(np.array(agree) - like)) < 0.2


def test_components_of_chains_stars_and_pairs(spark, scratch):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5001), (7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(df, scratch).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert got == components({x for e in real for x in e}, real)
    assert sum(1 for name in scratch.made if "moves" in name) <= 20


def test_no_edges(spark, scratch):
    assert connected_components(spark.createDataFrame([], "a long, b long"), scratch).count() == 0


def test_near_copies_match_brute_force(small, scratch):
    docs = small("documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    shingled = {i: grams(t) for i, t in rows}
    holders = defaultdict(set)
    for i, c in shingled.items():
        for g in c:
            holders[g].add(i)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    links = [(a, b) for a, b in pairs if similarity(shingled[a], shingled[b]) >= 0.8]
    links += [(a, b) for a, x in rows for b, y in rows if a < b and x == y]
    want = components([i for i, _ in rows], links)
    assert {r.doc_id: r.class_id for r in dart.grouped(docs, scratch).collect()} == want


def test_large_group_of_near_copies_and_a_bridge(spark, scratch):
    base = prose(9, 150).split()
    rows = [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1:])) for i in range(140)]
    other = base[:70] + prose(10, 80).split()
    rows += [(500 + i, " ".join([*other[:100], f"y{i}", *other[100:]])) for i in range(40)]
    got = {r.doc_id: r.class_id for r in dart.grouped(spark.createDataFrame(rows, "doc_id long, text string"), scratch).collect()}
    assert {got[i] for i in range(140)} == {0} and {got[500 + i] for i in range(40)} == {500}


def family(seed, n, words, share):
    """Texts made from one by changing about `share` of the words, in a few runs."""
    r = random.Random(seed)
    base = prose(seed, words).split()
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(r.randrange(1, 5)):
            at, length = r.randrange(words), max(1, int(words * share / 3 * r.random()))
            text[at: at + length] = [f"n{r.randrange(10**6)}" for _ in text[at: at + length]]
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("tile", [dart.TILE, 2000])
def test_family_between_the_thresholds_matches_brute_force(spark, scratch, tile, monkeypatch):
    texts = family(21, 150, 90, 0.3) + family(22, 60, 40, 0.2)
    counted = [grams(t) for t in texts]
    pairs = [(a, b) for b in range(len(texts)) for a in range(b)]
    alike = {p: similarity(counted[p[0]], counted[p[1]]) for p in pairs}
    assert sum(0.6 < v < 0.8 for v in alike.values()) > 1000
    want = components(range(len(texts)), [p for p, v in alike.items() if v >= 0.8])
    assert 10 < len(set(want.values())) < len(texts) - 10
    monkeypatch.setattr(dart.joined, "__defaults__", (dart.SIMILARITY, tile))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in dart.grouped(docs, scratch).collect()} == want


def test_forest_joins_groups_as_all_links_would():
    texts = family(5, 60, 60, 0.3)
    units = [np.sort(dart.units(v, np.zeros(len(v), np.int64))) for v in (shingles(words(pa.array([t])))[0] for t in texts)]
    counted = [grams(t) for t in texts]
    r = random.Random(4)
    group, tile = np.array([r.choice((i, i // 3)) for i in range(60)]), np.array([r.randrange(2) for _ in range(60)])
    held = [(int(a), int(np.flatnonzero(group == group[a])[0])) for a in range(60)]
    for i, j in ((0, 0), (0, 1), (1, 1)):
        links = [(a, b) for a in range(60) for b in range(60) if tile[a] == i and tile[b] == j and a != b
                 and similarity(counted[a], counted[b]) >= 0.8]
        got = dart.forest(group, tile, units, i, j)
        assert components(range(60), held + [(int(a), int(b)) for a, b in got]) == components(range(60), held + links)
        assert len(got) < len(set(group.tolist()))


def test_texts_of_a_repeated_id_are_nodes_of_their_own(spark, scratch):
    base, other = prose(31, 100), prose(32, 100)
    rows = [(1, base), (1, other), (2, other + " more"), (3, base + " more"), (4, prose(33, 50)), (1, prose(34, 60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in dart.grouped(docs, scratch).collect()} == {1: 1, 2: 1, 3: 1, 4: 4}
    kept = dart.kept(docs, type(scratch)(spark, "again"))
    assert {(r.doc_id, r.text) for r in kept.collect()} == {rows[0], rows[1], rows[4], rows[5]}


def test_near_copies_on_odd_rows(odd, empty, scratch):
    got = {r.doc_id: r for r in dart.grouped(odd, scratch).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12}
    assert got[2].class_id == got[3].class_id == 1 and got[2].copy_of == 1 and got[3].copy_of == 3
    assert got[5].class_id == 4 and got[6].class_id == 6 and got[9].class_id == 9
    again = type(scratch)(odd.sparkSession, "again")
    kept = dart.kept(odd, again)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 4, 6, 7, 8, 9, 10, 11, 12, None], key=str)
    assert dart.grouped(empty, type(scratch)(odd.sparkSession, "none")).count() == 0


def covered(rows):
    out = defaultdict(set)
    for r in rows:
        out[r.doc_id].update(range(r.first_word, r.end_word))
    return dict(out)


def shared_words(texts, least):
    holders = defaultdict(set)
    split = {i: t.split() for i, t in texts.items()}
    runs = {i: [tuple(w[k: k + least]) for k in range(len(w) - least + 1)] for i, w in split.items()}
    for i, rs in runs.items():
        for r in rs:
            holders[r].add(i)
    out = defaultdict(set)
    for i, rs in runs.items():
        for k, r in enumerate(rs):
            if len(holders[r]) > 1:
                out[i].update(range(k, k + least))
    return dict(out)


def test_passages_match_brute_force(small, scratch):
    docs = small("documents")
    got = suffixes.shared_passages(docs, scratch).collect()
    assert covered(got) == shared_words({r.doc_id: r.text for r in docs.collect()}, 50)
    assert all(r.n_words == r.end_word - r.first_word >= 50 and r.other_doc != r.doc_id for r in got)


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_of_few_words_with_many_repeats(spark, scratch, seed):
    r = random.Random(seed)
    texts = {i: " ".join(r.choice("ab") for _ in range(r.randrange(0, 90))) for i in range(40)}
    texts |= {100 + i: " ".join(["x"] * (20 + i)) for i in range(6)} | {200: texts[3], 201: texts[3]}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert covered(suffixes.shared_passages(df, scratch, least=12, run=5).collect()) == shared_words(texts, 12)


def test_passages_on_odd_rows(odd, empty, scratch):
    got = covered(suffixes.shared_passages(odd, scratch).collect())
    assert set(got) == {1, 2, 3, 9} and got[9] == set(range(80, 150)) and got[1] == set(range(120))
    assert got[3] == set(range(60)) | set(range(61, 120))
    assert suffixes.shared_passages(empty, type(scratch)(odd.sparkSession, "none")).count() == 0


def folded(text):
    return " ".join("".join(c for c in w.lower() if not c.isascii() or c.isalnum()) for w in (text or "").split())


def leaks(texts, items):
    out = {}
    for d, t in texts:
        w = folded(t).split()
        for i, item in items:
            g, n = grams(folded(item)), len(folded(item).split())
            best = max((similarity(grams(" ".join(w[k: k + n])), g) for k in range(max(1, len(w) - n + 1))), default=0)
            if best >= 0.8:
                out[d, i] = round(best, 9)
    return out


def test_leaks_match_brute_force(small):
    docs, items = small("documents").where("length(text) < 4000"), small("benchmark")
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontam.found(docs, items).collect()}
    assert got == leaks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got


def test_leaks_with_edits_case_and_short_items(spark):
    item = prose(20, 60)
    w = item.split()
    items = [(1, item), (2, "Alpha, beta gamma"), (3, None), (4, ""), (1, item), (5, prose(21, 12))]
    docs = [(1, prose(30, 50) + " " + item.upper().replace(" ", ", ") + " " + prose(31, 50)),
            (2, prose(32, 90) + " " + " ".join(w[:30] + ["other"] + w[31:])), (3, " ".join(w[:20])), (4, None), (5, ""),
            (6, "say ALPHA beta, gamma! now"), (7, " ".join(w[3:])), (8, " ".join(w[::-1])), (None, item), (8, prose(33, 9))]
    df = spark.createDataFrame([(*d, "s", 1) for d in docs], "doc_id long, text string, item_id string, similarity long")
    bench = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, doc_id long")
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontam.found(df, bench).collect()}
    assert got == leaks(docs, [i for i in items if i[1]])
    assert {(1, 1), (2, 1), (6, 2), (7, 1), (None, 1)} <= set(got)
    clean = decontam.clean(df, bench)
    assert clean.columns == df.columns and sorted(r.doc_id for r in clean.collect()) == [3, 4, 5, 8, 8]
    assert decontam.found(df.limit(0), bench).count() == 0 and decontam.found(df, bench.limit(0)).count() == 0


def test_items_with_text_ids(spark):
    item = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([("d1", f"before {item} after"), ("d2", "nothing of it " * 10)], "doc_id string, text string")
    bench = spark.createDataFrame([("b-1", item), (None, item)], "item_id string, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.found(docs, bench).collect()}
    assert got == {("d1", "b-1"), ("d1", None)}


def test_slices_of_items_give_the_same(small, monkeypatch):
    docs, items = small("documents").where("length(text) < 3000"), small("benchmark")
    whole = {tuple(r) for r in decontam.found(docs, items).collect()}
    monkeypatch.setattr(decontam, "SLICE_BYTES", 3000)
    assert {tuple(r) for r in decontam.found(docs, items).collect()} == whole


def test_multi_index_misses_nothing_within_the_radius():
    rng = np.random.default_rng(5)
    items = rng.integers(0, 2**63, 40).astype(np.uint64)
    flips = np.zeros(4000, np.uint64)
    for _ in range(24):
        flips ^= np.uint64(1) << rng.integers(0, 64, 4000).astype(np.uint64)
    windows = items[rng.integers(0, 40, 4000)] ^ flips
    far = np.array([[bin(int(w ^ i)).count("1") for i in items] for w in windows])
    assert set(zip(*map(np.ndarray.tolist, decontam.within(windows, items, 20)), strict=True)) == {
        (int(a), int(b)) for a, b in zip(*np.nonzero(far <= 20), strict=True)}


def test_items_with_a_null_id_are_found(spark):
    item = prose(20, 30)
    docs = spark.createDataFrame([(1, f"{prose(21, 40)} {item} {prose(22, 40)}"), (2, prose(23, 100))], "doc_id long, text string")
    bench = spark.createDataFrame([(None, item), (7, prose(24, 30))], "item_id long, text string")
    assert [tuple(r) for r in decontam.found(docs, bench).collect()] == [(1, None, 1.0, 40)]
    assert [r.doc_id for r in decontam.clean(docs, bench).collect()] == [2]
