"""Exact, near, line and embedding dedup against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterforge.llm import banding, embeddings, exact_dedup, lines, minhash
from rosterforge.llm.banding import linked
from rosterforge.llm.components import components

from .conftest import ROWS


def groups(edges, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def exact_expected(rows):
    ids, out = defaultdict(list), []
    for d, t in rows:
        ids[normal(t)].append(d)
    for d, t in rows:
        same = ids[normal(t)]
        keep = min((x for x in same if x is not None), default=None)
        out.append((d, keep, len(same), d == keep, hashlib.sha256(normal(t).encode()).hexdigest()))
    return Counter(out)


def test_exact_dedup(spark, odd, no_docs, documents):
    for df in (odd, documents):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        assert Counter(map(tuple, exact_dedup.exact_dedup(df).collect())) == exact_expected(rows)
    assert exact_dedup.exact_dedup(no_docs).count() == 0


def test_quotient_filters_merge_without_loss():
    rng = np.random.default_rng(3)
    parts = [rng.integers(0, 1 << 20, 3000).astype(np.uint64) << np.uint64(36) for _ in range(4)] + [np.array([(1 << 56) - 1] * 5, np.uint64)]
    filters = [exact_dedup.CountingQuotientFilter.of(p, 8) for p in parts]
    filters = [exact_dedup.CountingQuotientFilter.from_bytes(f.to_bytes()) for f in filters]
    prints, counts = exact_dedup.CountingQuotientFilter.merge(filters).entries()
    want = np.unique(np.concatenate(parts), return_counts=True)
    assert (prints == want[0]).all() and (counts == want[1]).all()


def shingles(t, k):
    w = [x.lower() if x.isascii() else "".join(c.lower() if c.isascii() else c for c in x) for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near_expected(rows, k):
    sets = {i: shingles(t, k) for i, (_, t) in enumerate(rows)}
    edges = [(i, j) for i in sets for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    g = groups(edges, sets)
    least = defaultdict(list)
    for i, r in g.items():
        least[r].append(rows[i][0])
    comp = {r: min((x for x in v if x is not None), default=None) for r, v in least.items()}
    return Counter((rows[i][0], len(sets[i]), comp[g[i]] if sets[i] else rows[i][0]) for i in sets)


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(odd, no_docs, documents, k):
    for df in (odd, documents):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        got = minhash.near_duplicates(df, words=k)
        assert Counter((r[0], r[1], r[2]) for r in got.collect()) == near_expected(rows, k)
        assert got.filter("kept <> (doc_id <=> component_id)").count() == 0
    assert minhash.near_duplicates(no_docs).count() == 0


def test_near_duplicates_of_a_large_group(spark):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(400):
        w = list(base)
        w[int(rng.integers(0, 120))] = f"z{i}"
        texts.append((i, " ".join(w)))
    got = minhash.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), words=2)
    assert {r["component_id"] for r in got.collect()} == {0}


def test_estimate_is_corrected_for_collisions():
    rng = np.random.default_rng(1)
    both = rng.integers(0, 1 << 63, 3000).astype(np.uint64) * np.uint64(2)
    for share in (0.0, 0.5, 0.8):
        n = int(share * 2000 / (1 + share))
        a = np.sort(both[:1000])
        b = np.sort(np.concatenate([both[:n], both[1000 : 2000 - n]]))
        regs = [minhash.hyper_registers(x, np.zeros(len(x), np.int64), 1) for x in (a, b)]
        j, _ = minhash.estimate(*regs, np.array([1000]), np.array([1000]))
        assert abs(j[0] - n / (2000 - n)) < 0.12


def lines_expected(rows, k=7):
    units = sorted({(d is None, d or 0, hashlib.md5((t or "").encode()).digest(), t or "") for d, t in rows})
    occ = [(u[:3], i, lines.normal_line(x)) for u in units for i, x in enumerate(u[3].split("\n"))]
    sets = {}
    for _, _, x in occ:
        if x:
            sets[x] = {x[i : i + k] for i in range(max(1, len(x) - k + 1))}
    names = sorted(sets)
    edges = []
    for i, a in enumerate(names):
        for b in names[:i]:
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and 100 * len(x & y) >= 80 * len(x | y):
                edges.append((a, b))
    g = groups(edges, names)
    first, dropped = {}, defaultdict(list)
    for u, i, x in sorted(occ, key=lambda o: (o[0], o[1])):
        if x:
            if g[x] in first:
                dropped[u].append(i)
            first.setdefault(g[x], (u, i))
    out = []
    for d, t in rows:
        u = (d is None, d or 0, hashlib.md5((t or "").encode()).digest())
        left = [x for i, x in enumerate((t or "").split("\n")) if i not in dropped[u]]
        out.append((d, "\n".join(left), len((t or "").split("\n")), tuple(dropped[u])))
    return Counter(out)


def test_line_dedup(odd, no_docs, documents):
    for df in (odd, documents):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        got = lines.dedup_lines(df, keep=("lang", "source")).collect()
        assert Counter((r["doc_id"], r["text"], r["n_lines"], tuple(r["dropped"])) for r in got) == lines_expected(rows)
    assert lines.dedup_lines(no_docs).count() == 0


def vectors_expected(rows):
    good = {}
    for i, (d, v) in enumerate(rows):
        if d is not None and v and None not in v and np.isfinite(v).all() and np.any(v):
            good[i] = np.array(v, float)
    edges, links = [], Counter()
    for i in good:
        for j in good:
            if j < i and len(good[i]) == len(good[j]) and good[i] @ good[j] / np.sqrt((good[i] @ good[i]) * (good[j] @ good[j])) >= 0.9:
                edges.append((rows[i][0], rows[j][0]))
                links[i] += 1
                links[j] += 1
    g = groups(edges, [d for d, _ in rows if d is not None])
    return Counter((d, links[i], g.get(d)) for i, (d, _) in enumerate(rows))


def test_embeddings(spark, sf):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(6, 12))
    rows = [(i, list(map(float, base[i % 6] + rng.normal(size=12) * (0.05 if i % 3 else 0.35)))) for i in range(900)]
    rows += [(1000, None), (1001, [0.0] * 12), (1002, [float("nan")] * 12), (1003, [None, *[1.0] * 11]), (1004, []), (None, [1.0] * 12), (1005, [1.0, 2.0]), (1006, [2.0, 4.0])]
    rows += [(2000 + i, rows[0][1]) for i in range(40)] + [(3000 + i, [3.0 * x for x in rows[1][1]]) for i in range(20)]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "vec_id long, embedding array<double>, unit string, dim string").repartition(4)
    got = embeddings.near_vectors(df)
    assert Counter((r[0], r[1], r[2]) for r in got.collect()) == vectors_expected(rows)
    assert got.filter("kept <> (vec_id <=> component_id)").count() == 0
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def test_tiles_agree_with_all_products():
    rng = np.random.default_rng(9)
    x = embeddings.unit_rows(rng.normal(size=(60, 16))[rng.integers(0, 60, 2500)] + 0.08 * rng.normal(size=(2500, 16)))
    basis = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    w = rng.integers(1, 4, 2500)
    whole = (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    total, label, touched = embeddings.compare(x, None, basis, 0.9, w, None)
    assert (total == whole @ w).all() and (touched == whole.any(1)).all()
    total, _, _ = embeddings.compare(x[:900], x[900:], basis, 0.9, w[:900], w[900:])
    assert (total[:900] == whole[:900, 900:] @ w[900:]).all() and (total[900:] == whole[900:, :900] @ w[:900]).all()
    for i, j in zip(*np.nonzero(whole), strict=True):
        assert label[i] == label[j]


def test_only_pairs_that_may_reach_the_threshold_are_counted(monkeypatch):
    rng, counted = np.random.default_rng(5), []
    count = banding.in_common
    monkeypatch.setattr(banding, "in_common", lambda a, b: counted.append(1) or count(a, b))
    for size in (1, 6, 70, 400, 5000):
        base = np.unique(rng.integers(1, 1 << 63, size, np.int64).astype(np.uint64))
        sets = [np.zeros(0, np.uint64)]
        for share in rng.uniform(0.3, 1, 30):
            new = rng.integers(1, 1 << 63, int(size * (1 - share)), np.int64).astype(np.uint64)
            sets.append(np.unique(np.append(base[rng.random(len(base)) < share], new)))
        sets += [base, base]
        inter = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
        sizes = np.array([len(x) for x in sets])
        want = 100 * inter >= 80 * (sizes[:, None] + sizes[None, :] - inter)
        compare, every = banding.compare_sets(sets, 80), np.arange(len(sets))
        counted.clear()
        assert (compare(every, every) == want).all()
        for i in every:
            assert (compare(every[i : i + 1], every) == want[i : i + 1]).all() and (compare(every, every[i : i + 1]) == want[:, i : i + 1]).all()
        if size == 400:
            assert want.sum() < len(counted) < 2 * want.sum() + 2 * len(every) < 2 * want.size


def test_a_line_of_many_blocks_is_prepared_once(spark):
    rows = [(k, 0, 0, n, n, n % 2 == 0, f"line {n}") for k in range(50) for n in range(8)]
    dealt = spark.createDataFrame([r[:6] for r in rows], banding.MEMBER)
    items = lambda nodes: nodes.join(spark.createDataFrame([(n, f"line {n}") for n in range(8)], "node long, item string"), "node")

    def prepare(lines):
        assert len(lines) == len(set(lines))
        return lambda o, x: np.array([[lines[i][-1] == "2" and lines[j][-1] == "5" for j in x] for i in o])

    assert {tuple(r) for r in banding._blocks(dealt, items, prepare, True).collect()} == {(2, 5)}
    kept = banding._blocks(dealt, items, prepare, False).groupBy("node").count().collect()
    assert {tuple(r) for r in kept} == {(2, 50), (5, 50)}


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = groups(edges, {x for e in edges for x in e})
    assert got == {n: r for n, r in want.items()}


def test_fixture_has_the_hard_cases():
    assert any(r[1] is None for r in ROWS) and any(r[0] is None for r in ROWS) and len(set(ROWS)) < len(ROWS)


def test_two_texts_repeated_many_times(spark):
    a = " ".join(f"word{i}" for i in range(60))
    b = a + " end"
    df = spark.createDataFrame([(1 + i % 2, (a, b)[i % 2]) for i in range(4000)], "doc_id long, text string").repartition(6)
    assert {tuple(r) for r in minhash.near_duplicates(df, words=2).select("doc_id", "component_id").collect()} == {(1, 1), (2, 1)}
    got = lines.dedup_lines(df).groupBy("doc_id", "n_dropped").count().collect()
    assert {tuple(r) for r in got} == {(1, 0, 2000), (2, 1, 2000)}


def test_collision_correction_has_the_published_factor():
    rng = np.random.default_rng(3)
    same = 0
    for _ in range(60):
        a, b = (np.sort(rng.integers(0, 1 << 63, 4000).astype(np.uint64) * np.uint64(2)) for _ in range(2))
        x, y = (minhash.hyper_registers(v, np.zeros(len(v), np.int64), 1) for v in (a, b))
        same += ((x == y) & (x != 0)).sum()
    chance = same / 60
    taken = minhash.REGISTERS - minhash.corrected(np.array([float(minhash.REGISTERS)]), np.array([1]), np.array([1.0]))[0]
    assert abs(chance - taken) < 0.12  # four standard errors


def test_sketches_keep_similar_lines_together():
    rng = np.random.default_rng(4)
    letters = list("abcdefghij klmnop")
    pairs = []
    for _ in range(300):
        a = "".join(rng.choice(letters, 160)).strip()
        b = list(a)
        for i in rng.integers(0, len(b), 2):
            b[i] = "z"
        pairs.append((" ".join(a.split()), " ".join("".join(b).split())))
    flat = [x for p in pairs for x in p]
    sets = [{x[i : i + 5] for i in range(max(1, len(x) - 4))} for x in flat]
    _, _, sketches = lines.line_keys(flat, 5)
    nodes = lines.node_of(np.arange(len(flat), dtype=np.int64), sketches)
    near = lines.sketches_near(nodes[::2], nodes[1::2])
    linked = np.array([100 * len(x & y) >= 80 * len(x | y) for x, y in zip(sets[::2], sets[1::2], strict=True)])
    assert linked.any() and near[linked].all()
    assert lines.sketches_near(nodes[:-2:2], nodes[2::2]).mean() < 0.1


def test_hot_keys_go_row_by_row_and_stay_whole(spark):
    from rosterforge.llm import banding

    keys = np.full(1000, 5 << 40, np.uint64)
    flush = banding.Flusher(8)
    flush.add(keys, np.arange(1000))
    flush.add(np.array([5 << 40, 9 << 40], np.uint64), np.array([np.iinfo(np.int64).min, 3]))
    one = banding.Flusher(8)
    one.add(np.array([5 << 40, 9 << 40], np.uint64), np.array([7777, 3]))
    import pyarrow as pa

    rows = [r for f in (flush, one) for r in pa.RecordBatch.from_arrays(f.columns(), names=f.NAMES).to_pylist()]
    got = banding.shared_bands(spark.createDataFrame([tuple(r.values()) for r in rows], banding.Flusher.SCHEMA)).collect()
    assert {r["node"] for r in got} == {*range(1000), 7777, np.iinfo(np.int64).min} and len({r["key"] for r in got}) == 1


def test_lines_with_one_node_are_still_compared(spark, monkeypatch):
    monkeypatch.setattr(lines, "node_of", lambda halves, sketches: np.full(len(sketches), 12345, np.int64))
    text = "the quick brown fox jumps over the lazy dog while seven wise men watch"
    rows = [(1, text), (2, text + "ed"), (3, "entirely other words stand in this line of the table here")]
    got = {r["doc_id"]: r["n_dropped"] for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 1, 3: 0}


@pytest.mark.parametrize("seed", range(3))
def test_links_within_buckets_but_not_with_the_leader(spark, seed):
    """Components of random links between nodes that share a bucket, against a search over all links."""
    rng = random.Random(seed)
    shared = {(k, v) for k in range(25) for v in rng.sample(range(120), rng.choice([2, 3, 6, 9]))}
    pairs = {(a, b) for k, a in shared for j, b in shared if k == j and a < b}
    links = set(rng.sample(sorted(pairs), len(pairs) // 4))
    true = spark.createDataFrame(sorted(links), "a long, b long")

    def prepare(items):
        ids = [int(x) for x in items]
        return lambda o, x: np.array([[tuple(sorted((ids[i], ids[j]))) in links for j in x] for i in o])

    got = linked(
        spark.createDataFrame(sorted(shared), "key long, node long"),
        lambda some: some.join(true, ["a", "b"], "left_semi"),
        [(lambda nodes: nodes.select("node", F.col("node").cast("string").alias("item")), prepare)],
    )
    least = groups(links, {v for pair in links for v in pair})
    rows = got.collect()
    assert len(rows) == len(least) and {r["node"]: r["component"] for r in rows} == least
