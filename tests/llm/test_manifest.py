import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from gridpulse.llm import manifest, queries

DOCS = "doc_id long, source string, lang string, n_chars long, text string, tree string, rank int, digest string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 3])) for i in range(0, len(last), 3)])
    return levels


def path_of(levels, rank):
    """(before, after) on every level below the top."""
    out = []
    for nodes in levels[:-1]:
        run = rank // 3 * 3
        out.append(("".join(nodes[run:rank]), "".join(nodes[rank + 1 : run + 3])))
        rank //= 3
    return out


def plain(rows):
    """Rows of the query from (doc_id, source, lang, n_chars, text)."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf_of(r), r))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in sources}
    above = levels_of([trees[s][-1][0] for s in sources])
    out = []
    for place, s in enumerate(sources):
        for rank, (_, _, leaf, r) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            steps = path_of(trees[s], rank) + path_of(above, place)
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            at = leaf_of((*r[:4], text))
            for before, after in steps:
                at = sha(before + at + after)
            out.append((r[0], leaf, trees[s][-1][0], above[-1][0], sha("".join(b + a for b, a in steps)), at, at == above[-1][0]))
    return sorted(out, key=str)


def found(spark, df, tmp_path):
    df.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in queries.QUERIES["op11_merkle_manifest"](spark, str(tmp_path)).collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, "d") for r in rows], DOCS)


@pytest.mark.parametrize("page", [None, 2])
def test_against_plain_trees(spark, tmp_path, monkeypatch, page):
    """Sources of 1 to 700 leaves, with pages of six levels and of two."""
    if page:
        monkeypatch.setattr(manifest, "DEPTH", page)
        monkeypatch.setattr(manifest, "PAGE", 3**page)
    rng, rows = random.Random(1), []
    for source, many in [("hot", 700), (None, 28), ("", 1), ("é", 9), ("z", 3), ("Z", 2), *((f"s{i}", 1) for i in range(12))]:
        for _ in range(many):
            rows.append((rng.randrange(10**6), source, rng.choice(["en", None, ""]), rng.choice([None, 5]), rng.choice(["a\nb", "é", "", None])))
    assert found(spark, table(spark, rows).repartition(5), tmp_path) == plain(rows)


def test_pages_of_six_levels_over_each_other(spark, tmp_path):
    rows = [(i, "one", "en", 1, f"text\n{i}") for i in range(2200)]
    assert found(spark, table(spark, rows), tmp_path) == plain(rows)


def test_nulls_repeats_and_ties(spark, tmp_path):
    rows = [(None, None, None, None, None)] * 4 + [(1, "a", "en", 1, "x\ny")] * 5 + [(1, "a", "en", 1, "b")] * 2 + [(2, "a", "en", 1, "L\n" * 100_000)]
    assert found(spark, table(spark, rows).repartition(3), tmp_path) == plain(rows)


def test_one_and_no_rows(spark, tmp_path):
    rows = [(7, "a", "en", 3, "x\ny")]
    assert found(spark, table(spark, rows), tmp_path) == plain(rows)
    assert plain(rows)[0][4] == sha("")
    assert found(spark, table(spark, rows).limit(0), tmp_path) == []


def test_a_proof_holds_for_its_own_leaf_alone(spark):
    rows = [(i, "s", "en", 1, str(i)) for i in range(40)]
    built = manifest.build(table(spark, rows), queries.LEAF_FIELDS)
    got = manifest.proofs(built).select("id", "grouping", "leaf", "root", "proof").collect()
    assert {r.grouping for r in got} == {"s"} and len({r.leaf for r in got}) == 40
    pairs = spark.createDataFrame([(a.leaf, b.proof, a.id == b.id) for a in got[:6] for b in got[:6]], f"leaf string, proof {manifest.STEP}, own boolean")
    checked = pairs.select("own", (manifest.folded(F.col("leaf"), F.col("proof")) == built.root).alias("held")).collect()
    assert all(r.own == r.held for r in checked)


def test_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select(*queries.LEAF_FIELDS).collect()]
    assert sorted((tuple(r) for r in queries.QUERIES["op11_merkle_manifest"](spark, small).collect()), key=str) == plain(rows)
