import random

import pytest

from shelfsense.operators import nearpages


def brute(rows):
    sets = {}
    for i, text in rows:
        words = (text or "").split()
        sets[i] = {tuple(words[j : j + 3]) for j in range(max(1, len(words) - 2))} if words else set()
    ids = sorted(sets)
    group = {i: i for i in ids}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and both >= 0.8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                group[max(x, y)] = min(x, y)
    return sorted((i, min([j for j in ids if sets[i] and sets[j] == sets[i]], default=i), find(i)) for i in ids)


@pytest.mark.parametrize("salted", [500, 3])
def test_groups_equal_a_comparison_of_all_pairs(spark, monkeypatch, salted):
    monkeypatch.setattr(nearpages, "SALTED", salted)
    rng = random.Random(6)
    rows = [(1, None), (2, ""), (3, "one two"), (4, "one two"), (5, "one")]
    for family in range(5):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([8, 40, 120]))]
        for i in range(30):
            words = list(base)
            for _ in range(rng.randrange(5)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(9)}"
            rows.append((100 * family + 100 + i, " ".join(words)))
    shared = " ".join(f"s{i}" for i in range(30))
    rows += [(900 + i, shared + " " + " ".join(f"u{i}x{j}" for j in range(25))) for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, content string")
    got = sorted(tuple(r) for r in nearpages.near_duplicates(df, "page_id", "content").select("page_id", "class_id", "group_id").collect())
    assert got == brute(rows)


def test_no_texts(spark):
    assert nearpages.near_duplicates(spark.createDataFrame([], "page_id long, content string"), "page_id", "content").count() == 0
