import random
import re

import numpy as np
import pytest
import xxhash

from gridpulse.llm import queries
from gridpulse.llm.common import stored
from gridpulse.llm.components import components
from gridpulse.llm.simhash import close_pairs, codewords, deduplicated, fingerprint, near_duplicates, neighbour_codewords


def plain(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    runs = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(ids, prints):
    """Least id reachable, by comparing everything with everything."""
    root = dict(zip(ids, ids))
    changed = True
    while changed:
        changed = False
        for i, p in zip(ids, prints):
            for j, q in zip(ids, prints):
                if bin(p ^ q).count("1") <= 3 and root[j] < root[i]:
                    root[i], changed = root[j], True
    return root


@pytest.mark.parametrize("text", ["", " \n", "one", "One two", "a b c", "a b c a b c a b c", "ÄB c\x0bd\x0ce\xa0f g", "w " * 500])
def test_fingerprint(text):
    assert fingerprint(text) == plain(text)


def test_golay():
    words = np.arange(1 << 23, dtype=np.int64)
    assert (np.bincount(codewords(words)) == 2048).all()
    rng = np.random.default_rng(1)
    some = rng.integers(0, 1 << 23, 2000)
    near = neighbour_codewords(some, 23)
    for bit in range(23):
        assert (near == codewords(some ^ (1 << bit))[:, None]).any(axis=1).all()


def test_close_pairs_lose_nothing(spark):
    rng = random.Random(2)
    prints = []
    for _ in range(60):
        base = rng.getrandbits(64)
        prints += [base] + [base ^ sum(1 << b for b in rng.sample(range(64), k)) for k in (1, 2, 3, 3, 4)]
    signed = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    found = close_pairs(spark.createDataFrame([(p,) for p in signed], "fingerprint long"))
    want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 3}
    assert {tuple(r) for r in found.collect()} == want


def test_keys_are_not_broadcast(spark, joins):
    """A fingerprint has about 80 keys, of which the planner knows nothing, so they meet by a shuffle however few it takes them for."""
    found = close_pairs(stored(spark.createDataFrame([(1,), (3,), (0xFF00FF00,)], "fingerprint long"), "test-prints"))
    assert [j for j, *_ in joins(found)] == ["SortMergeJoin"]
    assert [tuple(r) for r in found.collect()] == [(1, 3)]


def test_fingerprints_are_not_broadcast(documents, joins):
    """Ids and fingerprints of copies take next to nothing in a file, but a row each in memory."""
    found = near_duplicates(documents(*["same words here"] * 50, "other words there"))
    assert [j for j, *_ in joins(found)] == ["SortMergeJoin", "SortMergeJoin"]
    assert sorted((r.id, r.component) for r in found.collect()) == [(i, 1) for i in range(1, 51)] + [(51, 51)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 50), (50, 60), (7, 7), (None, 3)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {i: 1 for i in range(1, 41)} | {50: 50, 60: 50, 100: 50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates(documents, spark):
    base = " ".join(f"w{i}" for i in range(400))
    texts = ["lone text of words", base, base.upper(), base + " end", None, "", "lone text of words", "other"]
    docs = documents(*texts).union(documents("lone text of words", first=1))
    rows = near_duplicates(docs).collect()
    assert len(rows) == 9
    prints = [plain(t) for t in texts]
    want = linked(range(1, 9), prints)
    for r in rows:
        assert r.fingerprint % (1 << 64) == prints[r.id - 1]
        assert r.component == want[r.id]
    assert near_duplicates(docs.limit(0)).count() == 0


def test_deduplicated(documents, spark):
    docs = documents("a b c d", "x y z", "A b c d", None, "").union(documents("a b c d"))
    docs = docs.union(spark.createDataFrame([(None, "q r s", None, None, None, None)], docs.schema))
    kept = deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id or 0), r.text) for r in kept.collect()) == [(0, "q r s"), (1, "a b c d"), (2, "x y z"), (4, None)]


def test_documents_are_not_broadcast(documents, joins):
    """Copies compress so well that all their texts look small enough to broadcast."""
    docs = stored(documents(*["same words here"] * 50, "other words there"), "test-documents")
    kept = deduplicated(docs)
    assert {j for j, *_ in joins(kept)} == {"SortMergeJoin"}
    assert sorted(r.doc_id for r in kept.collect()) == [1, 51]


def test_query(spark, small):
    rows = queries.QUERIES["op5_golay_simhash"](spark, small).collect()
    docs = dict(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
    want = linked(list(docs), [plain(t) for t in docs.values()])
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{plain(t):016x}", want[i]) for i, t in docs.items()}
