"""Lexical search, SimHash components and whitening against brute force, with nulls, ties and repeats."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import lexical
from tidemark.llm.lexical import Best, exact_cuts, item_tiles, op11_lexical_search, search, terms_of, tile_scores
from tidemark.llm.simhash import Labels, Tree, fingerprint, masks, op12_simhash, search_block, simhash_components
from tidemark.llm.whitening import bidiagonal, deviations, fit_whitening, op13_whitening, scaled, whiten

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOC_SCHEMA = "doc_id long, text string, n long, terms string, item long, score string, rank string"
ITEM_SCHEMA = "item_id string, text string, item long, doc_id string, score string"


def found(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, top=20):
    """(item_id, rank, doc_id, score) by plain loops."""
    held = [(doc_id, Counter(found(text)), len(found(text))) for doc_id, text in docs]
    big_n, big_l = sum(n > 0 for *_, n in held), sum(n for *_, n in held)
    df = Counter(t for _, terms, _ in held for t in terms)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, terms, n in held:
            score = 0
            for t in found(text):
                if terms[t]:
                    m = 100 - 25 + (25 * n * big_n) // big_l
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * terms[t]) // (1000 * terms[t] + 12 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scores)[:top])]
    return Counter(out)


def some_docs():
    rng = random.Random(4)
    texts = [" ".join(f"w{int(rng.paretovariate(0.6)) % 90}" for _ in range(rng.choice([1, 3, 20, 90, 400]))) for _ in range(700)]
    texts += texts[:60] + ["Zürich ZÜRICH zürich", "a\x00b a-b_c, don't", "été  x y", "w1 " * 30_000, "", None, " .,;", "w1"]
    docs = [(n * 3 % 1009, t) for n, t in enumerate(texts)]
    return docs + [(None, texts[0]), (None, texts[1]), docs[5], docs[5]]


def some_items():
    rng = random.Random(6)
    items = [(f"i{n}", " ".join(f"w{rng.randrange(120)}" for _ in range(rng.choice([1, 4, 30, 60])))) for n in range(300)]
    return items + [("i1", "w1 w1 W1"), ("i1", "w1 w1 W1"), (None, "zürich x y b"), ("e", ""), ("n", None), ("u", "unseen")]


def test_op11_matches_plain_loops(spark, monkeypatch):
    docs, items = some_docs(), some_items()
    frame = spark.createDataFrame([(*d, 1, "t", 2, "s", "r") for d in docs], DOC_SCHEMA).repartition(5)
    asked = spark.createDataFrame([(*i, 1, "d", "s") for i in items], ITEM_SCHEMA)
    want = ranked(docs, items)
    made = op11_lexical_search(frame, asked)
    assert made.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, made.collect())) == want
    monkeypatch.setattr(lexical, "ITEM_BYTES", 3000)
    assert Counter(map(tuple, search(frame, asked, 3).collect())) == ranked(docs, items, 3)
    assert op11_lexical_search(frame.limit(0), asked).count() == op11_lexical_search(frame, asked.limit(0)).count() == 0


def test_terms_are_those_of_the_pattern():
    every = "".join(map(chr, [*range(0x3000), 0x1F600, 0x10FFFF])) + "aB1"
    assert [t.decode() for t in terms_of(every.encode())] == found(every)


def test_products_stay_exact_at_any_weight(monkeypatch):
    rng = np.random.default_rng(2)
    weights = rng.integers(1, 25_000, 40)
    items = [(n, rng.integers(0, 40, 60).tolist() + [7] * (900 * n)) for n in range(5)]
    entries = [(t, d, int(rng.integers(1, 1_000_000))) for t in range(40) for d in range(6) if rng.random() < 0.7]
    terms, place, impacts = map(np.array, zip(*entries))
    want = np.zeros((5, 6), dtype=object)
    for row, (_, own) in enumerate(items):
        times = Counter(own)
        for t, d, impact in entries:
            want[row, d] += times[t] * int(weights[t]) * impact
    for limit in (lexical.EXACT_WEIGHT, 1_000_000, 30_000):
        monkeypatch.setattr(lexical, "EXACT_WEIGHT", limit)
        (tile,) = item_tiles(items, weights)
        assert (tile_scores(tile, terms, place, impacts, 6) == want).all()
        for layer in tile.layers:
            assert all(layer[:, a:b].sum(axis=1).max() <= limit for a, b in exact_cuts(layer))


def test_best_of_tiles_keeps_ties_by_id():
    best = Best(1, 3)
    best.add(np.array([[5, 9, 5, 0]]), np.array([40, 41, 42, 1]), np.zeros(4, dtype=bool))
    best.add(np.array([[5, 4, 5, 5]]), np.array([7, 8, 0, 50]), np.array([False, False, True, False]))
    assert best.scores.tolist() == [[9, 5, 5]] and best.ids.tolist() == [[41, 7, 40]]


def plain_print(text, size=4):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    grams = [b" ".join(w[k : k + size]) for k in range(max(1, len(w) - size + 1))] if w else []
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(ids, prints, radius=4):
    root = list(range(len(prints)))
    values = np.array(prints, dtype=np.uint64)
    for a in range(len(prints)):
        for b in np.flatnonzero(np.bitwise_count(values[a + 1 :] ^ values[a]) <= radius) + a + 1:
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
    lowest = {}
    for n, r in enumerate(root):
        if ids[n] is not None:
            lowest[r] = min(lowest.get(r, ids[n]), ids[n])
    return [lowest.get(r) for r in root]


def test_op12_matches_brute_force(spark):
    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randrange(200)}" for _ in range(rng.choice([1, 3, 4, 5, 30, 200]))) for _ in range(60)]
    for base in list(texts):
        parts = base.split()
        for _ in range(3):
            own = list(parts)
            own[rng.randrange(len(own))] = "Changed"
            texts.append("\n".join(own))
    texts += [None, "", "\t ", texts[3], texts[3].upper(), "x" * 40_000, "y " * 70_000, "é z"]
    rows = [(900 - n, t) for n, t in enumerate(texts)] + [(None, texts[0]), (None, "only null"), (3, texts[1]), (3, texts[1])]
    prints = [plain_print(t) for _, t in rows]
    want = Counter(zip([i for i, _ in rows], [f"{p:016x}" for p in prints], components_of([i for i, _ in rows], prints)))
    frame = spark.createDataFrame([(*r, 1, "l", 2, 3) for r in rows], "doc_id long, text string, print int, label string, node int, low int")
    assert Counter(map(tuple, op12_simhash(frame).collect())) == want
    assert op12_simhash(frame.limit(0)).count() == 0


@pytest.mark.parametrize("nodes", [4096, 3])
def test_shards_of_many_near_prints(spark, monkeypatch, nodes):
    """Fingerprints in dense clouds, some near each other only over chains; trees cut into blocks of three."""
    from tidemark.llm import simhash

    rng = random.Random(nodes)
    prints = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(60):
            prints.add(centre ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(1, 7))}))
    prints = sorted(prints) + [0, 1]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame(list(enumerate(signed)), "doc_id long, print long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, size: docs)
    got = {r.doc_id: r.component_id for r in simhash_components(frame, tree_nodes=nodes).collect()}
    assert got == dict(enumerate(components_of(range(len(prints)), prints)))


@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4))
def test_linked_prints_share_a_shard(print_, bits):
    other = print_ ^ sum(1 << b for b in bits)
    assert len(masks()) == 35
    assert any(print_ & mask % (1 << 64) == other & mask % (1 << 64) for mask in masks())


@settings(max_examples=100)
@given(st.lists(st.tuples(st.integers(0, 1 << 10), st.integers(0, 3)), max_size=60), st.integers(0, 1 << 10), st.integers(0, 3))
def test_tree_finds_every_component_within_the_radius(nodes, asked, radius):
    tree = Tree()
    for print_, label in nodes:
        tree.add(print_, label)
    tree.close()
    first = dict(reversed(nodes))
    want = {label for print_, label in first.items() if (print_ ^ asked).bit_count() <= radius}
    labels = Labels()
    hits = list(search_block(tree, labels, asked, 9, radius))
    assert len(hits) == len(want) and {label for label in range(4) if labels.find(label) == labels.find(9)} == want
    assert all((hit ^ asked).bit_count() <= radius for hit in hits)
    assert not list(search_block(tree, labels, asked, 9, radius))


def test_prints_of_long_texts_are_added_in_parts(monkeypatch):
    from tidemark.llm import simhash

    text = " ".join(f"w{n % 977}" for n in range(5000))
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 100)
    assert fingerprint(text.encode()) % (1 << 64) == plain_print(text)


def vectors_of(rng, n, width=9):
    base = rng.standard_normal((n, width)) * np.linspace(2, 0.4, width) + rng.standard_normal(width)
    return base.astype(np.float32)


def plain_whitening(vectors, k=4):
    x = np.floor(256 * vectors.astype(np.float64))
    fit = np.unique(x, axis=0)
    mean = fit.mean(axis=0)
    covariance = (fit - mean).T @ (fit - mean) / len(fit)
    values, components = np.linalg.eigh(covariance)
    values, components = values[::-1][:k], components.T[::-1][:k]
    return x, fit, (x - mean) @ components.T / np.sqrt(values), values / np.trace(covariance)


def test_op13_matches_numpy(spark):
    rng = np.random.default_rng(3)
    good = vectors_of(rng, 400)
    good = np.vstack([good, good[:50], good[:1].repeat(200, axis=0)])
    rows = [(n, v.tolist()) for n, v in enumerate(good)]
    odd = [(9000, None), (9001, [1.0] * 8 + [None]), (9002, [1.0] * 8 + [float("nan")]), (9003, [float("inf")] * 9), (9004, [1.0])]
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows + odd], "vec_id long, embedding array<float>, x int, n int, rows int")
    x, fit, white, explained = plain_whitening(good)
    made = op13_whitening(frame.repartition(3)).collect()
    assert len(made) == 4 * len(good) and {r.n for r in made} == {len(fit)} and max(r.identity_error for r in made) < 1e-10
    got = np.zeros_like(white)
    sums = fit.astype(np.int64).sum(axis=0)
    for r in made:
        got[r.vec_id, r.component - 1] = r.whitened
        assert abs(r.explained - explained[r.component - 1]) < 1e-12
        assert r.deviation == int(((len(fit) * x[r.vec_id].astype(np.int64) - sums) ** 2).sum())
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got * signs - white).max() < 1e-9


def test_op13_edges(spark):
    schema = "vec_id long, embedding array<float>"
    of = lambda rows: spark.createDataFrame(rows, schema)
    assert op13_whitening(of([])).count() == 0
    assert op13_whitening(of([(1, None)])).count() == 0
    assert op13_whitening(of([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    flat = whiten(of([(1, [0.0, 1.0]), (2, [1.0, 1.0]), (None, [2.0, 1.0])])).collect()
    assert [r.component for r in flat] == [1, 1, 1] and {r.vec_id for r in flat} == {1, 2, None}
    assert {round(r.explained, 9) for r in flat} == {1.0}
    huge = whiten(of([(1, [0.0, 1e18]), (2, [1.0, -1e18]), (3, [2.0, 3e17])])).collect()
    assert {r.deviation for r in huge} == {None} and len(huge) >= 3
    assert fit_whitening(scaled(of([(1, [])]))) is None


@pytest.mark.parametrize("kind", ["flat", "ranked", "tied", "wide", "steep"])
def test_bidiagonalisation_gives_the_singular_values(kind):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3, 10) if kind == "wide" else (300, 12))
    if kind == "ranked":
        x = x[:, :2] @ rng.standard_normal((2, 12))
    if kind == "tied":
        x = np.linalg.qr(x)[0] * 100
    if kind == "steep":
        x = x * 10.0 ** -np.arange(12)
    values, vectors = bidiagonal(lambda q: ((x @ q) @ x, float((x @ q) @ (x @ q))), x.shape[1], float((x * x).sum()), 4)
    want = np.linalg.svd(x, compute_uv=False)
    want = np.append(want, np.zeros(4))[: len(values)]
    assert np.abs(values - want).max() < 1e-12 * want[0]
    real = values > 1e-9 * values[0]
    assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-12)
    assert np.allclose(np.linalg.norm(x @ vectors.T, axis=0)[real], want[real], rtol=1e-9)


def test_deviations_are_exact_beyond_doubles():
    rows, sums, n = np.array([[3_000_000_019, 5]]), [17, 23], 2
    assert deviations(rows[:, :], n, sums) == [None]
    assert deviations(np.array([[1_000_000_007, 5]]), n, sums) == [(2 * 1_000_000_007 - 17) ** 2 + (10 - 23) ** 2]
