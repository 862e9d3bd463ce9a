"""Families of near copies: many that are close to a large component and linked with none of its members."""

import random

from tabmine.llm import near_dup


def _family(seed: int, copies: int, first: int, letters: str) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    text = [f"{letters}{rng.randrange(400)}" for _ in range(200)]
    out = []
    for k in range(copies):
        # up to 4 edits: linked with the text; from 12 on: near it, but linked with copies of the same edits only
        words = list(text)
        for at in rng.sample(range(200), rng.choice([0, 1, 2, 3, 4, 12, 14, 16, 18])):
            words[at] = f"{letters}{rng.randrange(400)}"
        out.append((first + k, " ".join(words)))
        if k % 10 == 0:
            words[-1] = "end"
            out.append((first + 1000 + k, " ".join(words)))
    return out


def _plain(docs: list[tuple[int, str]]) -> dict[int, int]:
    sets = {i: {tuple(w[k : k + 2]) for k in range(max(len(w) - 1, min(len(w), 1)))} for i, w in ((i, t.split()) for i, t in docs)}
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {i: find(i) for i in sets}


def test_pairs_stay_near_the_members(spark, monkeypatch):
    docs = _family(1, 160, 0, "a") + _family(2, 120, 3000, "b")
    counts, stored = [], near_dup.stored

    def counting(df, name):
        out = stored(df, name)
        if name == "pairs":
            counts.append(out.count())
        return out

    monkeypatch.setattr(near_dup, "stored", counting)
    got = near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), words=2).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == _plain(docs)
    assert max(counts) <= 2 * len(docs)


def test_every_list_as_a_family(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "SHORT", 1)
    monkeypatch.setattr(near_dup, "SLOTS", 2)
    docs = _family(3, 60, 0, "a") + _family(4, 30, 3000, "a") + [(9000, ""), (9001, "a1"), (9002, "a1 a2 a3 a4 a5"), (9003, "a1 a2 a3 a4 a5 a6")]
    got = near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), words=2).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == _plain(docs)
