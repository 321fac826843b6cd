import random
import re

import cases
import xxhash

from txlake.llm import simhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_fingerprint(text):
    ws = WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    if not ws:
        return 0
    shingles = [b" ".join(ws[i : i + 4]) for i in range(max(1, len(ws) - 3))]
    hs = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, limit=4):
    fps = sorted(set(fps))
    up = {f: f for f in fps}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= limit:
                up[root(a)] = root(b)
    return {f: root(f) for f in fps}


def near_copies(rng, n=60):
    words = [rng.choice(cases.WORDS) + str(rng.randint(0, 99)) for _ in range(120)]
    out = []
    for i in range(n):
        w = list(words)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = "new%d" % rng.randint(0, 999)
        out.append((300 + i, " ".join(w), None, None, None))
    return out


def test_equals_brute_force(spark):
    rows = cases.documents() + near_copies(random.Random(4))
    got = simhash.near_duplicates(cases.clashing(spark, rows)).collect()
    want = [(i, brute_fingerprint(t)) for i, t, *_ in rows]
    comp = brute_components([f for _, f in want])
    least = {}
    for i, f in want:
        if i is not None:
            least[comp[f]] = min(least.get(comp[f], i), i)
    assert sorted(((r["id"], r["fp"] % 2**64, r["component_id"]) for r in got), key=repr) == sorted(
        ((i, f, least.get(comp[f])) for i, f in want), key=repr
    )
    kept = simhash.keep_one(cases.clashing(spark, rows)).collect()
    texts = {comp[brute_fingerprint(r["text"])]: r["doc_id"] for r in kept}
    assert len(kept) == len(texts) == len(set(comp.values()))
    assert texts == {c: least.get(c) for c in set(comp.values())}


def test_all_close_pairs_are_found(spark):
    rng = random.Random(8)
    fps = []
    for _ in range(60):
        base = rng.getrandbits(64)
        fps.append(base)
        for k in range(1, 7):
            x = base
            for b in rng.sample(range(64), k):
                x ^= 1 << b
            fps.append(x)
    signed = [f - 2**64 if f >= 2**63 else f for f in set(fps)]
    df = spark.createDataFrame([(f, 1) for f in signed], "fp long, n long")
    got = {r["fp"] % 2**64: r["component"] for r in simhash.link(df).collect()}
    want = brute_components(fps)
    assert set(got) == set(want)
    pairs = {}
    for f, c in want.items():
        pairs.setdefault(c, set()).add(got[f])
    assert all(len(x) == 1 for x in pairs.values())
    assert len(set(got.values())) == len(pairs)


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(1, 30)] + [(200, 201), (5, 5)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["component"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)} | {201: 200}


def test_empty_table(spark):
    df = cases.frame(spark, [])
    assert simhash.near_duplicates(df).count() == 0
    assert simhash.keep_one(df).columns == df.columns
