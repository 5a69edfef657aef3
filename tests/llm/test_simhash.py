"""SimHash fingerprints, the Golay keys and the links they find, against plain Python."""

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from attesta.llm import simhash
from attesta.llm.common import QUERIES, ready

SIGN = 1 << 63


@pytest.fixture(scope="module")
def session(spark):
    return ready(spark)


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes):
    """(id, fingerprint) pairs to the smallest id reachable over at most two differing bits, by all pairs."""
    prints = sorted({f for _, f in nodes})
    parent = {f: f for f in prints}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in combinations(prints, 2):
        if (a ^ b).bit_count() <= 2:
            parent[find(a)] = find(b)
    least = {}
    for i, f in nodes:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return {f: least.get(find(f)) for f in prints}


def test_codewords_are_the_perfect_code():
    words = simhash.codewords()
    assert len(set(words.tolist())) == 4096 and min(int(w).bit_count() for w in words[1:]) == 7
    rng = random.Random(1)
    sample = np.array([rng.randrange(1 << 23) for _ in range(300)])
    owner, found = simhash.keys(sample)
    for k, w in enumerate(sample.tolist()):
        near = {int(c) for c in words if (int(c) ^ w).bit_count() <= 4}
        mine = found[owner == k].tolist()
        assert set(mine) == near and len(mine) == len(near) in (1, 6)


def test_words_two_bits_apart_share_a_key():
    rng = random.Random(2)
    for _ in range(200):
        w = rng.randrange(1 << 23)
        others = [w ^ 1 << a ^ 1 << b for a, b in combinations(range(23), 2)] + [w ^ 1 << a for a in range(23)]
        owner, found = simhash.keys(np.array([w, *others]))
        own = set(found[owner == 0].tolist())
        assert all(own & set(found[owner == k + 1].tolist()) for k in range(len(others)))


@pytest.mark.parametrize("small", [0, 16])
def test_links_against_all_pairs(session, small):
    """Random fingerprints, chains and a family within a few bits of one point, whose postings are large."""
    rng = random.Random(small)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for centre in list(prints)[:25]:
        for _ in range(4):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))))
    hub = rng.getrandbits(64)
    prints |= {hub ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))) for _ in range(150)}
    want = plain_components([(f, f) for f in prints])
    rows = session.createDataFrame([(f - (1 << 64) if f >= SIGN else f,) for f in prints], "fp long")
    found = simhash.links(rows, small).collect()
    unsigned = [(r.a % (1 << 64), r.b % (1 << 64)) for r in found]
    assert all((a ^ b).bit_count() <= 2 for a, b in unsigned)
    parent = {f: f for f in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in unsigned:
        parent[find(a)] = find(b)
    groups = {}
    for f in prints:
        groups.setdefault(find(f), []).append(f)
    assert {f: min(g) for g in groups.values() for f in g} == want


def test_documents_against_plain_python(session, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 4000)
    rng = random.Random(7)
    base = [" ".join(rng.choice("the of and text Word ÄÖ 漢字 é Ä".split()) + str(rng.randrange(40)) for _ in range(rng.randint(3, 60))) for _ in range(60)]
    rows = [(None, "no id at all"), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One\x0bTwo"), (7, "one two"), (8, " ".join(base)), (9, "x" * 30_000), (9, "a b c"), (9, "a b c")]
    rows += [(100 + k, t) for k, t in enumerate(base)]
    rows += [(300 + k, t + " more") for k, t in enumerate(base)] + [(500 + k, " ".join(base) + f" {k}") for k in range(30)]
    docs = session.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, fingerprint string, component_id string")
    got = sorted((r.id is None, r.id or 0, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect())
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    component = plain_components(prints)
    assert got == sorted((i is None, i or 0, f"{f:016x}", component[f]) for i, f in prints)
    assert any(c is not None and i != c for i, f in prints for c in [component[f]])


def test_empty_table(session):
    assert simhash.near_duplicates(session.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_over_whole_documents(session):
    folder = "/root/testdata/sf0.001"
    texts = [(r.doc_id, plain_fingerprint(r.text)) for r in session.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    component = plain_components(texts)
    got = QUERIES["op13_golay_simhash"](session, folder)
    assert got.columns[:3] == ["doc_id", "fingerprint", "component_id"]
    assert sorted(tuple(r) for r in got.collect()) == sorted((i, f"{f:016x}", component[f]) for i, f in texts)
