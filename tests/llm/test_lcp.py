import hashlib
import random
import struct

import numpy as np
import pytest

from gridpulse.llm import lcp, queries
from gridpulse.llm.lcp import KEPT, edited, fingerprint, likeness, parsed, sketch_of

M = (1 << 64) - 1


def mix(a, b):
    h = (a ^ b * int(lcp._B)) * int(lcp._A) & M
    h ^= h >> 29
    h = h * int(lcp._B) & M
    return h ^ h >> 32


def lowest(a, b):
    return ((a ^ b) & -(a ^ b)).bit_length() - 1


def up(names, level):
    """One level of one text, symbol by symbol."""
    runs = []
    for x in names:
        if runs and runs[-1][0] == x:
            runs[-1][1] += 1
        else:
            runs.append([x, 1])
    names = [x if n == 1 else mix(mix(x, n), level) for x, n in runs]
    label, before = [], 0
    for x in names:
        p = lowest(x, before)
        label.append(2 * p + (x >> p & 1))
        before = x
    for _ in range(3):
        last, out = 0, []
        for x in label:
            p = lowest(x, last) if x != last else 0
            out.append(2 * p + (x >> p & 1))
            last = x
        label = out
    for high in (5, 4, 3):
        was = [7, *label, 7]
        label = [min({0, 1, 2} - {was[i], was[i + 2]}) if x == high else x for i, x in enumerate(label)]
    begin = [i for i in range(len(names)) if i == 0 or 0 < i < len(names) - 1 and label[i] > label[i - 1] and label[i] > label[i + 1]]
    out = []
    for a, b in zip(begin, [*begin[1:], len(names)]):
        name = names[a] if b - a == 1 else mix(names[a], level)
        for x in names[a + 1 : b]:
            name = mix(name, x)
        out.append(name or 1)
        assert b - a <= 5
    return out


def plain(text):
    names, level, kept = [ord(c) + 1 for c in text], 0, set()
    if not text:
        return 0, []
    while len(names) > 1 or level < 4:
        level += 1
        names = up(names, level)
        if level in lcp.LEVELS:
            kept.update((x * int(lcp._A) & M) >> 32 for x in names)
    return names[0], sorted(kept)[:KEPT]


RNG = random.Random(8)
TEXTS = [
    "", "a", "ab", "aa", "aaa", "aab", "aba", "a" * 100, "\0\0", "é日𝒳", "ab" * 50, "abcabcabc",
    *("".join(RNG.choice("ab c") for _ in range(RNG.randint(1, 80))) for _ in range(60)),
    *("".join(RNG.choice("the quick brown fox 日本") for _ in range(400)) for _ in range(5)),
]


def test_parsed():
    roots, sketches = parsed(TEXTS)
    for text, root, sketch in zip(TEXTS, roots, sketches):
        assert (int(root), sketch.tolist()) == plain(text), text


def test_a_run_above_a_run_of_the_same_name():
    """A pair drawn together on one level may stand beside the same pair on the next."""
    rng = random.Random(0)
    texts = ["".join(rng.choice(("ab", "abab", "c")) for _ in range(rng.randint(2, 40))) for _ in range(400)]
    roots, _ = parsed(texts)
    assert [int(r) for r in roots] == [plain(t)[0] for t in texts]


def test_texts_do_not_touch_each_other():
    for text in TEXTS:
        (root,), (sketch,) = parsed([text])
        both = parsed(["xyz", text, "", text])
        assert both[0][1] == both[0][3] == root and (both[1][3] == sketch).all()
    assert parsed([])[0].size == 0


def test_equal_passages_share_their_inside():
    passage = "".join(RNG.choice("etaoin shrdlu") for _ in range(300))

    def levels(text):
        names, out = [ord(c) + 1 for c in text], []
        for level in (1, 2, 3):
            names = up(names, level)
            out.append(names)
        return out

    alone = levels(passage)
    for before in ("", "x", "some text before ", "y" * 57):
        inside = levels(before + passage + "after")
        for k, (own, found) in enumerate(zip(alone, inside)):
            core = own[8:-8]
            assert any(found[i : i + len(core)] == core for i in range(len(found))), (before, k)


def test_likeness():
    a = "".join(RNG.choice("etaoin shrdlu") for _ in range(2000))
    b = "".join(RNG.choice("etaoin shrdlu") for _ in range(2000))
    _, (x, y, half, again) = parsed([a, b, edited(a, b), a])
    assert likeness(x, again) == 1 and likeness(x, y) < 0.1 and 0.3 < likeness(x, half) < 0.7
    assert likeness(x[:0], x[:0]) == 1 and likeness(x[:0], x) == likeness(x, x[:0]) == 0


def rows_of(docs):
    """The result by the contract, document by document."""
    docs = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), d[1] or ""))
    out = []
    for k, (i, text) in enumerate(docs):
        text, after = text or "", docs[(k + 1) % len(docs)][1] or ""
        changed = edited(text, after)
        own, new, other = plain(text), plain(changed), plain(after)
        near = [round(likeness(np.array(own[1]), np.array(x[1])), 9) for x in (new, other)]
        prints = [f"{r:016x}" + b"".join(struct.pack(">I", h) for h in s).hex() for r, s in (own, new)]
        out.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), *prints, *near))
    return sorted(out, key=str)


def got(frame):
    return sorted(((*tuple(r)[:5], round(r.near_edited, 9), round(r.near_next, 9)) for r in frame.collect()), key=str)


@pytest.mark.parametrize("n", [1, 2, 23])
def test_fingerprinted(documents, n, monkeypatch):
    monkeypatch.setattr(lcp, "_CHUNK", 200)
    texts = TEXTS[10 : 10 + n]
    assert got(lcp.fingerprinted(documents(*texts))) == rows_of(list(enumerate(texts, 1)))


def test_nulls_and_repeats(documents, spark):
    docs = documents(*TEXTS[:12], None)
    docs = docs.union(documents("one more", first=13)).union(documents("a", first=13)).union(
        spark.createDataFrame([(None, "no id", None, None, None, None), (None, None, None, None, None, None)], docs.schema)
    )
    want = rows_of([(r.doc_id, r.text) for r in docs.collect()])
    assert got(lcp.fingerprinted(docs)) == want
    assert lcp.fingerprinted(docs.limit(0)).count() == 0


def test_fingerprints_read_back():
    (root,), (sketch,) = parsed(["some text that is long enough to have a sketch of a few hashes"])
    assert (sketch_of(fingerprint(root, sketch)) == sketch).all()


def test_query(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    result = queries.QUERIES["op3_locally_consistent_fingerprints"](spark, small).collect()
    assert sorted(r.doc_id for r in result) == sorted(i for i, _ in docs)
    roots, sketches = parsed([t or "" for _, t in docs])
    prints = {i: fingerprint(r, s) for (i, _), r, s in zip(docs, roots, sketches)}
    order = sorted(docs, reverse=True)
    after = {d[0]: order[(k + 1) % len(order)][1] or "" for k, d in enumerate(order)}
    for r in result:
        text = dict(docs)[r.doc_id] or ""
        assert r.n_chars == len(text) and r.fingerprint == prints[r.doc_id]
        assert r.edited_sha256 == hashlib.sha256(edited(text, after[r.doc_id]).encode()).hexdigest()
    assert np.mean([r.near_edited > r.near_next for r in result if r.n_chars > 100]) > 0.99
