"""Ranked search, phrase mining and embedding dedup against brute force, with nulls, empty tables,
repeated rows, ties and clashing columns."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

UPPER = {i: i + 32 for i in range(65, 91)}
DOCS = "doc_id long, text string, lang string, row long, node long, n long, terms string, score long"


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    words = ["".join(r.choice("abcdeéßT1") for _ in range(r.randint(1, 4))) for _ in range(60)]
    text = lambda n: "".join(r.choice(words) + r.choice(["", "", "", ",", ".\n"]) + r.choice([" ", " ", "\t", "  "]) for _ in range(n))
    out = [(i, text(r.randint(1, 200)), r.choice(["en", "en", "en", "de", None])) for i in range(120)]
    out += [(i, "The same phrase over. The same phrase", "en") for i in range(200, 220)]
    out += [(300, None, "en"), (301, "", "de"), (302, " \t\n.,", None), (303, text(20_000), "en"), (None, "The same phrase", "en"), (5, out[5][1], out[5][2])]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, g, 1, 2, 3, "x", 4) for i, t, g in rows], DOCS).repartition(5)


def ranked(rows, items, k):
    term = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(UPPER))
    d = [(i, Counter(term(t))) for i, t, *_ in rows]
    n_docs, total = sum(1 for _, c in d if c), sum(sum(c.values()) for _, c in d)
    df = Counter(x for _, c in d for x in c)
    out = []
    for item, text in items:
        found = []
        for i, c in d:
            m = 50 + 50 * sum(c.values()) * n_docs // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (1_000_000_000 * c[x] // (1000 * c[x] + 20 * m)) for x in set(term(text)) if c[x])
            if s > 0:
                found.append((-s, i is None, i))
        out += [(item, p + 1, i, -s) for p, (s, _, i) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k])]
    return sorted(out, key=repr)


def test_ranked_search(spark, docs, rows):
    from rarefy.llm.dualtree import ranked_search
    items = [(i, rows[i * 3][1][:200]) for i in range(30)] + [(40, None), (41, "..."), (42, "nowhere"), (None, rows[9][1]), (7, "the SAME phrase")]
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, rank string")
    for k, size in ((10, 1 << 17), (3, 500)):  # ties at the kth place; several blocks of items
        found = ranked_search(docs, table, k=k, block_chars=size, sample_rows=40, batch_cells=20_000)
        assert sorted((tuple(r) for r in found.collect()), key=repr) == ranked(rows, items, k)
    assert ranked_search(docs.limit(0), table).count() == 0
    assert ranked_search(docs, table.limit(0)).count() == 0


def test_pruned_pairs_hold_no_result():
    """The traversal finds the same as a scan, and leaves most pairs out."""
    from rarefy.llm.dualtree import Search
    r = np.random.default_rng(1)
    weights = np.floor(1000 * np.log(1 + 1 / r.random(300))).astype(np.int64)
    # 30 subjects of 10 terms each: a document and an item keep mostly to one
    items = [np.unique(np.concatenate([r.integers(0, 10, 6) + 10 * (i % 30), r.integers(0, 300, 4)])) for i in range(40)]
    own = np.arange(300)[None, :] // 10 == r.integers(0, 30, 4000)[:, None]
    tf = (r.random((4000, 300)) < np.where(own, 0.4, 0.02)) * r.integers(1, 4, (4000, 300))
    n = tf.sum(axis=1) + r.integers(0, 500, 4000)
    s = Search(items, weights, np.ones(40, np.int64), 5, 4000, int(n.sum()))
    scored = []
    score, s._score = s._score, lambda item, leaves, *a: (scored.append(len(leaves)), score(item, leaves, *a))
    for lo in range(0, 4000, 500):
        row, term = np.nonzero(tf[lo:lo + 500])
        s.add(np.arange(lo, lo + 500), n[lo:lo + 500], row, term, tf[lo:lo + 500][row, term])
    m = 50 + 50 * n * 4000 // n.sum()
    value = np.where(tf > 0, weights * (1_000_000_000 * tf // np.maximum(1, 1000 * tf + 20 * m[:, None])), 0)
    for i, t in enumerate(items):
        total = value[:, t].sum(axis=1)
        assert s.best[i][0].tolist() == np.lexsort((np.arange(4000), -total))[:5].tolist()
    assert sum(scored) * s.leaf < 0.5 * 4000 * len(items)


def mined(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for _, t, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        found = []
        for g, a in c.items():
            if len(g) < 2 or a < least or len(g) == 2 and any(len(h) == 3 and b >= least and g in (h[:2], h[1:]) and 100 * b >= 50 * a for h, b in c.items()):
                continue
            s, k = min((1_000_000 * a * a // (c[g[:k]] * c[g[k:]]), k) for k in range(1, len(g)))
            found.append((-s, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        out += [(lang, p + 1, g.decode(), -a, x, y, n[lang], -s) for p, (s, a, g, x, y) in enumerate(sorted(found)[:top])]
    return sorted(out)


def test_collocations(docs, rows):
    from rarefy.llm.collocations import collocations
    for top, kw in ((2000, {}), (15, {"part_grams": 500, "limit": 300, "burst": 16, "filter_bits": 1 << 16})):
        assert sorted(tuple(r) for r in collocations(docs, least=4, top=top, **kw).collect()) == mined(rows, 4, top)
    assert collocations(docs.limit(0)).count() == 0


def test_trie_bursts_and_spills():
    from rarefy.llm.hattrie import HatTrie, Node
    r = np.random.default_rng(2)
    grams = np.minimum(r.zipf(1.3, (40_000, 3)), 500).astype(np.uint64)
    trie, found, deepest = HatTrie(3, burst=64, limit=4000), Counter(), 0
    for lo in range(0, len(grams), 1000):
        for run, counts in trie.add(grams[lo:lo + 1000]):
            assert [tuple(x) for x in run.tolist()] == sorted(set(map(tuple, run.tolist())))
            found.update(dict(zip(map(tuple, run.tolist()), counts.tolist())))
        assert trie.root.rows <= 4000
        deepest += any(isinstance(c, Node) for c in trie.root.children)
    for run, counts in trie.drain():
        found.update(dict(zip(map(tuple, run.tolist()), counts.tolist())))
    assert found == Counter(map(tuple, grams.tolist())) and deepest and trie.root.rows == 0


def links_of(rows, least=0.95):
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    unit = [np.array(v) / np.linalg.norm(v) if usable(v) else None for _, v in rows]
    link = [[j for j in range(len(rows)) if j != i and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least]
            for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, front = {i}, [i]
        while front:
            front = [k for j in front for k in link[j] if k not in seen and not seen.add(k)]
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        out.append((rows[i][0], len(link[i]), min(ids, default=None), bool(ids) and rows[i][0] == min(ids)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(4)
    near = lambda c, s, n: [c / np.linalg.norm(c) + s * r.standard_normal(len(c)) for _ in range(n)]
    out = [(i, r.standard_normal(24)) for i in range(300)]
    at = r.standard_normal(24)
    out += [(1000 + i, v) for i, v in enumerate(near(at, 0.02, 300))]  # one dense ball
    out += [(2000 + i, v) for i, v in enumerate(near(at, 0.06, 120))]  # links at its edge
    out += [(3000 + i, v) for i, v in enumerate(near(r.standard_normal(24), 0.05, 40))]
    out += [(4000 + 2 * i + j, v) for i in range(30) for j, v in enumerate(near(r.standard_normal(24), 0.02, 2))]
    out = [(i, [float(x) for x in v]) for i, v in out]
    out += [(5000, None), (5001, []), (5002, [0.0] * 24), (5003, [math.nan] * 24), (5004, [math.inf] + [1.0] * 23), (5005, [None] + [1.0] * 23),
            (5006, [1.0, 2.0]), (5007, [2.0, 4.0]), (1000, out[300][1]), (5008, out[0][1]), (None, out[1][1]), (None, [3.0, -1.0, 2.0])]
    return out


def test_embedding_dedup(spark, vectors):
    from rarefy.llm.rpforest import near_duplicates
    table = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in vectors], "vec_id long, embedding array<double>, node long, copies long, ball string").repartition(6)
    want = links_of(vectors)
    found = sorted((tuple(r) for r in near_duplicates(table, leaf_rows=64, fit_rows=200, fit_levels=2, block_rows=50).collect()), key=repr)
    assert [f[0] for f in found] == [w[0] for w in want]
    assert all(f[1] <= w[1] for f, w in zip(found, want))
    assert sum(f[1] for f in found) >= 0.98 * sum(w[1] for w in want)
    assert sum(f == w for f, w in zip(found, want)) >= 0.95 * len(want)
    # one leaf compares all pairs: exact
    assert sorted((tuple(r) for r in near_duplicates(table, trees=2, leaf_rows=10_000, block_rows=100).collect()), key=repr) == want
    assert near_duplicates(table.limit(0)).count() == 0


def test_forest_alone_reaches_the_recall(spark, vectors):
    """Without balls, with leaves that cut the dense groups."""
    from rarefy.llm.rpforest import near_duplicates
    table = spark.createDataFrame([(i, v) for i, v in vectors if i is None or not 1000 <= i < 2000], "vec_id long, embedding array<double>")
    want = links_of([(r["vec_id"], r["embedding"]) for r in table.collect()])
    found = near_duplicates(table, leaf_rows=64, fit_rows=200, fit_levels=3, hub_support=10**6).collect()
    assert 0.9 * sum(w[1] for w in want) <= sum(r["n_links"] for r in found) <= sum(w[1] for w in want)
