import random

import numpy as np
import pytest
import xxhash

from trendlake.llm import simhash
from trendlake.llm.components import components


def brute_print(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(prints, radius):
    ids = list(prints)
    comp = {i: i for i in ids}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for x, a in enumerate(ids):
        for b in ids[:x]:
            if bin(prints[a] ^ prints[b]).count("1") <= radius:
                ra, rb = find(a), find(b)
                comp[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in ids}


def test_documents_against_brute_force(make_docs):
    rng = random.Random(3)
    words = ["alpha", "Beta", "gamma", "δέλτα", "x", "y"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(0, 6))) for _ in range(150)]
    texts += [" ".join(rng.choices(words, k=400)) for _ in range(3)]
    for _ in range(30):      # copies with one word changed
        parts = texts[150].split()
        parts[rng.randrange(400)] = "changed"
        texts.append(" ".join(parts))
    rows = [(1000 - i, t) for i, t in enumerate(texts)] + [(2000, None), (2001, " \n")]
    prints = {i: brute_print(t) for i, t in rows}
    want = brute_components(prints, 2)
    got = simhash.simhash_components(make_docs(rows)).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{p:016x}" for i, p in prints.items()}


@pytest.mark.parametrize("radius", [2, 3])
def test_shards_lose_no_link(spark, radius):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(300)]
    points = set(base)
    for x in base[:150]:
        for _ in range(6):
            y = x
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                y ^= 1 << b
            points.add(y)
    signed = [simhash._signed(p) for p in points]
    df = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    found = {r.node: r.root for r in components(simhash.link_edges(df, radius)).collect()}
    prints = {p: p & (2 ** 64 - 1) for p in signed}
    want = brute_components(prints, radius)
    assert {p: found.get(p, p) for p in signed} == want


def test_local_tree_finds_exact_pairs():
    rng = np.random.default_rng(1)
    points = rng.integers(0, 2 ** 63, 3000, dtype=np.uint64)
    points[1500:] = points[:1500] ^ (np.uint64(1) << rng.integers(0, 64, 1500, dtype=np.uint64))
    pairs = set()
    for i, j in simhash.near_pairs(points, points[::3], 2):
        pairs |= set(zip(i.tolist(), j.tolist()))
    far = np.bitwise_count(points[:, None] ^ points[None, ::3])
    assert pairs == set(zip(*(x.tolist() for x in np.nonzero(far <= 2))))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(30)] + [(7, 7), (100, 101)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(31)}}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_one_of_each_group_stays(make_docs):
    text = "one two three four five six seven"
    df = make_docs([(4, text), (2, text), (2, text), (9, "other words entirely here now"), (None, text), (5, None), (6, "")])
    out = simhash.drop_near_copies(df)
    assert out.columns == df.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["2", "2", "5", "9", "None"]
    assert simhash.drop_near_copies(make_docs([])).count() == 0


def shingle_set(text, k=5):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def planted(seed, bases, copies):
    """Texts of random words, and copies of each whose shingle sets are a
    little above or below a similarity of 0.8."""
    rng = random.Random(seed)
    rows = []
    for _ in range(bases):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(150, 300))]
        rows.append(" ".join(base))
        for _ in range(copies):
            other = list(base)
            for at in rng.sample(range(len(base)), max(1, round(len(base) * rng.uniform(0.015, 0.032)))):
                other[at] = f"w{rng.randrange(5000)}"
            rows.append(" ".join(other))
    return list(enumerate(rows))


def test_near_copies_are_found_and_others_kept(make_docs):
    rows = planted(5, 120, 2)
    sets = [shingle_set(t) for _, t in rows]
    # copies of one base only can be similar
    pairs = [(a, b) for n in range(0, len(rows), 3) for a in range(n, n + 3) for b in range(n, a)]
    similar = [(a, b) for a, b in pairs if jaccard(sets[a], sets[b]) >= 0.8]
    got = {r.doc: r.component_id for r in simhash.near_copies(make_docs(rows)).collect()}
    want = {i: i for i, _ in rows}
    for a, b in sorted(similar):      # b is the smaller; a base has two copies at most
        want[a] = min(want[a], want[b])
        want[b] = min(want[a], want[b])
    for a, b in sorted(similar):
        want[a] = min(want[a], want[b])
    gone = {i for i in want if want[i] < i}
    found = {i for i in got if got[i] < i}
    assert 60 < len(gone) < 220 and found <= gone     # nothing below the threshold goes
    assert len(found) >= 0.93 * len(gone)


def test_a_dense_group_of_near_copies_is_one(make_docs):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(300):
        other = list(base)
        other[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(other)))
    assert [r.doc_id for r in simhash.drop_near_copies(make_docs(rows)).collect()] == [0]


def test_every_pair_of_near_half_words_is_a_candidate(spark):
    """Random prints, and dense groups whose half words are equal or near."""
    rng = np.random.default_rng(4)
    prints = rng.integers(0, 1 << 63, (70, simhash.WIDE), dtype=np.uint64)
    for i in range(10, 40):
        prints[i, 3] = prints[0, 3] ^ np.uint64(1 << (i % 3))   # one half equal or near, all others apart
    for i in range(40, 60):
        prints[i, 7] = prints[1, 7] ^ np.uint64(1 << 40 if i % 2 else 0)
    rows = [(i * 1000 - 7, bytearray(p.astype("<u8").tobytes())) for i, p in enumerate(prints)]
    ids = [r[0] for r in rows]
    halves = prints.view("<u4").reshape(len(prints), -1)
    near = (np.bitwise_count(halves[:, None] ^ halves[None, :]) <= simhash.NEAR).any(axis=2)
    want = {(ids[i], ids[j]) for i, j in zip(*np.nonzero(near)) if i > j}
    assert len(want) > 600
    simhash.ship(spark)
    pairs, members = simhash.candidates(spark.createDataFrame(rows, "node bigint, print binary"))
    apart = spark.createDataFrame([], "node bigint, root bigint")
    got = {(r.u, r.v) for r in pairs.collect()}
    rest = [(r.u, r.v) for r in simhash.cluster_pairs(members, apart).collect()]
    assert got < want and got | set(rest) == want and len(rest) == len(set(rest))
    # of sets that are linked already no pair is left
    one = spark.createDataFrame([(n, ids[0]) for n in ids], "node bigint, root bigint")
    assert simhash.cluster_pairs(members, one).count() == 0
    # one that is not of the common component meets all others of its cluster
    but = spark.createDataFrame([(n, ids[0]) for n in ids if n != ids[20]], "node bigint, root bigint")
    mine = {p for p in want if ids[20] in p}
    late = {(r.u, r.v) for r in simhash.cluster_pairs(members, but).collect()}
    assert late <= mine and (got & mine) | late == mine


def test_sketch_and_size_lose_no_similar_pair(spark):
    rng = np.random.default_rng(6)
    sets = []
    for n in (1, 2, 5, 9, 40, 300, 3000):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        sets.append(base)
        for share in (0.05, 0.1, 0.11, 0.3, 1.0):
            other = base.copy()
            other[:int(share * n)] = rng.integers(0, 1 << 63, int(share * n), dtype=np.uint64)
            sets += [other, base[:max(1, int((1 - share) * n))]]
    rows = [(i, len(np.unique(x)), *simhash.parity_sketch(np.unique(x)).tolist()) for i, x in enumerate(sets)]
    nodes = spark.createDataFrame(rows, f"node bigint, size bigint, {simhash._SKETCH_TYPES}")
    every = [(i, j) for i in range(len(sets)) for j in range(i)]
    got = {(r.u, r.v) for r in simhash._possible(spark.createDataFrame(every, "u bigint, v bigint"), nodes, 0.8).collect()}
    similar = {(i, j) for i, j in every if jaccard(frozenset(sets[i].tolist()), frozenset(sets[j].tolist())) >= 0.8}
    assert similar <= got and len(similar) > 20 and len(got) < len(every) / 2
