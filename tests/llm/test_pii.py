import hashlib
import random
import re

import pytest

from gridpulse.llm import boosting, pii, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(int(c) for c in reversed(digits)):
        d *= 1 + i % 2
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def plain(text):
    return [
        f"{kind}:{m.start()}:{m.end()}" for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "") if valid(kind, m[0])
    ]


def card(rng, digits=16, start="4"):
    body = start + "".join(rng.choice("0123456789") for _ in range(digits - 1 - len(start)))
    return next(body + c for c in "0123456789" if luhn(body + c))


def check(rows, texts):
    """Base columns against plain Python; all spans hold the base ones and are in order."""
    for r in rows:
        base = plain(texts[r.doc_id])
        kinds = [s.split(":")[0] for s in base]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds.count(k) for k in PATTERNS)
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(base) <= set(spans)
        assert spans == sorted(spans, key=lambda s: (list(PATTERNS).index(s.split(":")[0]), int(s.split(":")[1]), int(s.split(":")[2])))


def run(spark, tmp_path, texts, extra=()):
    schema = "doc_id long, text string, email_base string, cut int, blanked long"
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in texts.items()] + list(extra), schema)
    df.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return queries.QUERIES["op13_boosted_pii"](spark, str(tmp_path)).collect()


def test_base_spans_of_random_texts(spark, tmp_path):
    rng = random.Random(4)
    bits = ["a", "Z9", "b.c", "@", "@x.de", ".", "..", "+", "+4", "12", "255", "256", "1.2.3.4", " ", " ", "-", "--", "(", ")", "_", "%", "é", "😀", "\n", "\0", "0"]
    texts = {i: "".join(rng.choice(bits) for _ in range(rng.randrange(40))) for i in range(1500)}
    texts |= {5000 + i: f"x {card(rng)[:4]} {card(rng)} {card(rng)[:16]}-{i}" for i in range(50)}
    texts |= {6000: "a@b.c.d@e.f_g@h.i", 6001: "1.2.3.4.5.6.7.8", 6002: "00012.1.1.0255 999999999999999999999.1.1.1", 6003: None, 6004: ""}
    check(run(spark, tmp_path, texts), texts)


@pytest.fixture
def written(spark, tmp_path):
    rng = random.Random(9)

    def phone():
        return f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"

    texts, i = {}, 0
    for i in range(600):
        texts[i] = f"Word {'+1 ' + phone()} and card {card(rng)} by user{i % 90}.{i}@mail{i % 9}.example.com from 10.{i % 250}.3.4 here {i}"
    for j in range(200):
        wrong = card(rng)
        texts[1000 + j] = f"Order {wrong[:-1]}{(int(wrong[-1]) + 1) % 10} of 2024 weighs 1.2.3.{300 + j} units and room 12345678{j:03d}"
    texts[2001] = f"my number is 1 {phone()} here"
    texts[2002] = f"the card {card(rng, 15, '37')} expired"
    texts[2003] = "write to user12.7 (at) mail4.example (dot) com please"
    texts[2004] = "from 10[.]22[.]3[.]4 here"
    return texts, {r.doc_id: r for r in run(spark, tmp_path, texts)}


def test_trees_add_other_forms_and_leave_numbers_alone(written):
    texts, rows = written
    check(rows.values(), texts)
    for i in range(2001, 2005):
        assert rows[i].spans and not plain(texts[i]), (i, texts[i])
    assert rows[2001].spans.startswith("phone:13:") and rows[2002].spans.startswith("card:9:")
    assert all(not rows[1000 + j].spans for j in range(200))
    assert all(len(rows[i].spans.split(",")) == 4 for i in range(600))


def test_very_long_texts_in_one_pass(spark, tmp_path):
    """Runs that a pattern could be tried on from every place, and many matches."""
    texts = {
        1: "a" * 1_000_000, 2: "a" * 500_000 + "@", 3: "1" * 1_000_000, 4: "a@b" + ".c" * 300_000, 5: "+1 " * 200_000,
        6: "ä 1.2.3.4 " * 20_000, 7: "1 " * 300_000, 8: "1" * 500_000 + ".1.1.1",
    }
    found = {r.doc_id: r for r in run(spark, tmp_path, texts)}
    assert found[4].spans == "email:0:600003" and found[4].n_email == 1
    assert found[6].n_ip == 20_000 and found[6].spans.endswith("ip:199992:199999")
    assert [i for i, r in found.items() if r.spans] == [4, 6]


def test_empty_table_nulls_and_repeats(spark, tmp_path):
    texts = {1: "a@b.cd", 2: None}
    rows = run(spark, tmp_path, texts, [(None, "a@b.cd", None, None, None), (1, "a@b.cd", "x", 1, 2)])
    assert sorted((r.doc_id or 0, r.n_email, r.spans) for r in rows) == [(0, 1, "email:0:6"), (1, 1, "email:0:6"), (1, 1, "email:0:6"), (2, 0, "")]
    df = spark.createDataFrame([], "doc_id long, text string")
    df.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert queries.QUERIES["op13_boosted_pii"](spark, str(tmp_path)).count() == 0


def test_no_python_in_the_plan(spark, small):
    plan = queries.QUERIES["op13_boosted_pii"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query(spark, small):
    texts = dict(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
    check(queries.QUERIES["op13_boosted_pii"](spark, small).collect(), texts)


def test_boosting_finds_a_rule_of_two_features():
    def rule(a, b):
        return a == 1 and b != 2

    cells = [boosting.Cell((a, b, c), 50 * rule(a, b), 50 * (not rule(a, b)) + 1) for a in range(3) for b in range(3) for c in range(4)]
    model = boosting.learned(cells)
    limit = boosting.threshold(model, cells, 0.9, 20)
    assert all((model.score(c.values) >= limit) == rule(*c.values[:2]) for c in cells)


def test_threshold_needs_evidence():
    cells = [boosting.Cell((0,), 19, 0), boosting.Cell((1,), 3, 60)]
    model = boosting.learned(cells)
    assert boosting.threshold(model, cells, 0.9, 20) == float("inf")
    assert boosting.threshold(model, cells, 0.9, 19) <= model.score((0,))
    assert boosting.threshold(boosting.learned([]), [], 0.9, 1) == float("inf")
