from __future__ import annotations

import random
import re

import pytest

from quayside.llm import near_dedup
from quayside.llm.components import components
from quayside.llm.near_dedup import _open_pairs, _starred, near_duplicates, one_of_each

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(text, width):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows, width, similarity=80):
    sets = [sets_of(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                parent[top(i)] = top(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(top(i), []).append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        least = min((d for d in groups[top(i)] if d is not None), default=None)
        out.append((doc_id, len(sets[i]), least, doc_id == least))
    return sorted(out, key=str)


def found(df, width):
    return sorted((tuple(r) for r in near_duplicates(df, width).collect()), key=str)


def some_rows(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 5)):
            copy = [w if rng.random() > 0.06 else rng.choice(words) for w in base]
            rows.append((n * 3 % 211, " ".join(copy)))
            n += 1
    ids = [i for i, _ in rows]
    rows = [(i, t) for k, (i, t) in enumerate(rows) if i not in ids[:k]]
    return [*rows, (900, None), (901, ""), (902, " \t\n"), (903, "One"), (904, "one"), (905, "a b c"), (906, "A B C"),
            (907, rows[3][1].upper()), (None, rows[4][1]), (None, "alone of all"), rows[5], (908, "x " * 3000), (909, "X " * 2000)]


@pytest.mark.parametrize("width", [2, 5])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed, width):
    rows = some_rows(seed)
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string"), width) == brute(rows, width)


def test_whole_table(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in small.select("doc_id", "text").collect()]
    ours = found(small, 2)
    assert ours == brute(rows, 2)
    assert not all(r[3] for r in ours)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], "doc_id bigint, text string"), 2) == []


def test_one_of_each_keeps_all_columns_and_repeated_rows_once(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(2, text, "a"), (1, text, "b"), (1, text, "b"), (3, "other words here", None), (4, None, "c"), (None, "lost", "d")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, class string")
    kept = sorted(map(tuple, one_of_each(df).collect()), key=str)
    assert kept == sorted([rows[1], *rows[3:]], key=str)


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(50)}}


@pytest.mark.parametrize("seed", [1, 2])
def test_many_changed_copies_of_one_text(spark, seed):
    """Lists that stars leave open: some copies are alike to a few others only, some families to each other not at all."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    base = [rng.choice(words) for _ in range(150)]
    rows = []
    for rate in [0.02] * 60 + [0.05] * 80 + [0.07] * 60:
        copy = [w if rng.random() > rate else rng.choice(words) for w in base]
        rows.append((len(rows), " ".join(copy)))
    for family in range(4):
        changed = [w if rng.random() > 0.15 else rng.choice(words) for w in base]
        for _ in range(20):
            copy = [w if rng.random() > 0.03 else rng.choice(words) for w in changed]
            rows.append((len(rows), " ".join(copy)))
    expected = brute(rows, 2)
    assert 3 < len({r[2] for r in expected}) < len(rows) / 2
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string"), 2) == expected


def test_open_pairs_lose_none(spark):
    """Every pair of a list across components that is alike is among those that are compared."""
    rng = random.Random(5)
    base = list(range(200))
    sets = [set(base)]
    for rate in [0.02, 0.06, 0.1, 0.12, 0.15] * 10:
        one = {x for x in base if rng.random() > rate} | {rng.randrange(200, 800) for _ in range(int(200 * rate))}
        sets.append(one)
        for _ in range(3):
            sets.append({x for x in one if rng.random() > 0.04} | {rng.randrange(200, 800) for _ in range(6)})
    sets += [{*range(1000 + 10 * i, 1060 + 10 * i)} for i in range(20)]
    alike = {(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    component = [0 if i == 0 or (i, 0) in alike else i for i in range(len(sets))]
    postings = [(7, i, len(s), 100 - i, component[i]) for i, s in enumerate(sets)]
    postings = spark.createDataFrame(postings, "token bigint, class bigint, n_shingles bigint, central bigint, component bigint")
    held = spark.createDataFrame([(i, list(s)) for i, s in enumerate(sets)], "class bigint, shingles array<bigint>")
    got = {(max(r["a"], r["b"]), min(r["a"], r["b"])) for r in _open_pairs(postings, held, 80).collect()}
    wanted = {(i, j) for i, j in alike if component[i] != component[j]}
    assert wanted and wanted <= got


_POSTINGS = "token bigint, class bigint, n_shingles bigint, central bigint, component bigint"


def test_later_leaders_meet_only_members_outside(spark):
    rows = [(7, i, 50, 100 - i, 0 if i < 30 else i) for i in range(34)]
    postings = spark.createDataFrame(rows, _POSTINGS)
    assert {(r["a"], r["b"]) for r in _starred(postings, 0).collect()} == {(i, 0) for i in range(30, 34)}
    assert {(r["a"], r["b"]) for r in _starred(postings, 1).collect()} == {(i, 30) for i in range(31, 34)}


def test_changes_of_one_component_are_not_merged(spark, monkeypatch):
    base = set(range(100))
    sets = [*[base] * 5, *({*range(60), *range(200, 240), 300 + i} for i in range(3)), {*range(60), *range(200, 240), 400}]
    component = [0, 0, 0, 0, 0, 5, 5, 5, 8]
    held = spark.createDataFrame([(i, list(s)) for i, s in enumerate(sets)], "class bigint, shingles array<bigint>")
    tables = {}

    def written(df, name, keep=near_dedup.written):
        tables[name] = keep(df, name)
        return tables[name]

    monkeypatch.setattr(near_dedup, "written", written)
    for n, changes in ((8, 0), (9, 4)):  # without and with a member of another component that shares them
        rows = [(7, i, len(sets[i]), 100 - i, component[i]) for i in range(n)]
        pairs = _open_pairs(spark.createDataFrame(rows, _POSTINGS), held, 80)
        between = {(r["a"], r["b"]) for r in pairs.collect() if r["b"]}
        assert between == ({(i, 8) for i in (5, 6, 7)} if n == 9 else set())
        assert tables["changes"].count() == changes
        # They are made once, and counted and merged from what was written.
        assert tables["changed"].count() == sum(len(base ^ s) for s in sets[5:n])


def test_what_sets_unlike_the_leader_lack_is_not_merged(spark, monkeypatch):
    """Forty sets that have a tenth of the leader lack the same of it; two of them are alike."""
    base = set(range(100))
    sets = [*[base] * 5, *({*range(10), *range(1000 * i, 1000 * i + 90)} for i in range(1, 41))]
    sets[6] = {*list(sets[5])[:95], 7, *range(90000, 90003)}
    component = [0, 0, 0, 0, 0, *range(5, 45)]
    held = spark.createDataFrame([(i, list(s)) for i, s in enumerate(sets)], "class bigint, shingles array<bigint>")
    rows = [(7, i, len(sets[i]), 100 - i, component[i]) for i in range(45)]
    tables = {}

    def written(df, name, keep=near_dedup.written):
        tables[name] = keep(df, name)
        return tables[name]

    monkeypatch.setattr(near_dedup, "written", written)
    pairs = {(r["a"], r["b"]) for r in _open_pairs(spark.createDataFrame(rows, _POSTINGS), held, 80).collect()}
    assert {p for p in pairs if 0 not in p} in ({(5, 6)}, {(6, 5)})
    assert {r["class"]: len(r["held"]) for r in tables["changes"].collect()} == dict.fromkeys((5, 6), len((sets[5] & sets[6]) - base))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_open_pairs_lose_none_of_any_kind(spark, seed):
    """Members that are parts of the leader, hold it, hold half of it or next to nothing, each with some like it."""
    rng = random.Random(seed)
    base = list(range(150))
    sets, fresh = [set(base)], 1000
    for of_base, others in [(150, 6), (135, 0), (120, 2), (112, 0), (110, 24), (115, 30), (90, 40), (75, 75), (140, 40), (150, 60), (20, 110), (5, 120)] * 4:
        one = {*rng.sample(base, of_base), *range(fresh, fresh + others)}
        sets.append(one)
        for k in range(4):
            out, more = rng.randrange(len(one) // 5), rng.randrange(len(one) // 5)
            sets.append({*rng.sample(sorted(one), len(one) - out), *rng.sample(base, more // 2), *range(fresh + 200, fresh + 200 + more // 2)})
        fresh += 1000
    alike = {(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    component = [0 if i == 0 or (i, 0) in alike and i % 5 else i for i in range(len(sets))]
    inside = [100 * len(s & sets[0]) >= 80 * len(s) for s in sets]
    wanted = {(i, j) for i, j in alike if component[i] != component[j]}
    kinds = {(inside[i] + inside[j], bool(component[i]) + bool(component[j])) for i, j in wanted if j}
    assert kinds >= {(0, 2), (1, 2), (2, 1), (2, 2)}
    postings = [(7, i, len(s), 1000 - i, component[i]) for i, s in enumerate(sets)]
    held = spark.createDataFrame([(i, list(s)) for i, s in enumerate(sets)], "class bigint, shingles array<bigint>")
    got = {(max(r["a"], r["b"]), min(r["a"], r["b"])) for r in _open_pairs(spark.createDataFrame(postings, _POSTINGS), held, 80).collect()}
    # Members that are alike to the leader are each linked with it, so their own pairs are not needed.
    assert {(i, j) for i, j in wanted if j == 0} <= got
    assert {(i, j) for i, j in wanted if not ((i, 0) in alike and (j, 0) in alike)} <= got


def test_structured_words_are_different(spark):
    """Two words of 1,024 letters that a polynomial modulo a power of two cannot tell apart."""
    word = [bin(i).count("1") % 2 for i in range(1024)]
    rows = [(k, "".join("ab"[b ^ k] for b in word) + " x") for k in (0, 1)]
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string"), 2) == brute(rows, 2)
