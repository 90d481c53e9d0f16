"""Most probable segmentation against all ways to cut and all rows of states."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from wordlode.operators import probable


def dictionary(spark, counts):
    return spark.createDataFrame(list(counts.items()), "key string, n long")


COUNTS = {"ab": 6, "abc": 2, "bc": 5, "c": 9, "de": 3, "cde": 4, "北京": 7, "大学": 5, "北京大学": 2, "学生": 6}


def test_best_path_among_all(spark):
    total = sum(COUNTS.values())
    weight = {w: probable.log(n / total) for w, n in COUNTS.items()}
    unknown = probable.log(0.5 / total)
    rnd = random.Random(0)
    runs = ["", "a", "北京大学生", "abcde"] + ["".join(rnd.choice("abcdex") for _ in range(rnd.randint(1, 8))) for _ in range(60)]
    for run in runs:
        ways = []
        for cuts in itertools.product((0, 1), repeat=max(len(run) - 1, 0)):
            pieces, begin = [], 0
            for i, c in enumerate([*cuts, 1] if run else [], 1):
                if c:
                    pieces.append(run[begin:i])
                    begin = i
            if all(p in weight or len(p) == 1 for p in pieces):
                ways.append(sum(weight.get(p, unknown) for p in pieces))
        arcs = [[] for _ in range(len(run) + 1)]
        for i, j in itertools.combinations(range(len(run) + 1), 2):
            if run[i:j] in weight:
                arcs[j].append((j - i, weight[run[i:j]]))
        found = probable.best_path(run, arcs, unknown)
        assert "".join(p for p, _ in found) == run
        assert all(known == (p in weight) for p, known in found)
        assert sum(weight.get(p, unknown) for p, _ in found) == pytest.approx(max(ways), abs=1e-6)


def test_states_among_all(spark):
    known = probable.chances(probable.word_counts(dictionary(spark, COUNTS | {"abcd": 3, "x": 2})))
    for chances in (known.first, {t: p for (s, t), p in known.after.items() if s == "b"}, {t: p for (s, t), p in known.after.items() if s == "m"}):
        assert sum(map(math.exp, chances.values())) == pytest.approx(1)
    for state in probable.STATES:
        kinds = sum(math.exp(p) for (s, _), p in known.char.items() if s == state)
        assert kinds < 1 and math.exp(known.unknown[state]) > 0
    rnd = random.Random(1)
    for text in ["ax", "北大"] + ["".join(rnd.choice("abcdxy") for _ in range(rnd.randint(2, 6))) for _ in range(40)]:
        best = None
        for states in itertools.product(probable.STATES, repeat=len(text)):
            if states[0] not in "bs" or states[-1] not in "es":
                continue
            if any(t not in probable.FOLLOWS[s] for s, t in zip(states, states[1:])):
                continue
            score = known.first[states[0]] + sum(known.after[p] for p in zip(states, states[1:]))
            score += sum(known.char.get((s, c), known.unknown[s]) for s, c in zip(states, text))
            if best is None or score > best[0] + 1e-7:
                best = score, states
        words, begin = [], 0
        for i, s in enumerate(best[1]):
            if s in "es":
                words.append(text[begin : i + 1])
                begin = i + 1
        assert probable.cut_stretch(text, known) == words


@pytest.mark.parametrize("shard_chars", [4_000_000, 4])
def test_texts_are_cut(spark, shard_chars):
    texts = ["北京大学生 abcde", None, "", "  ", "q", "ab", "zzzz" * 2000, "abab abab"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(0, texts[0])], "id long, t string")
    words = dictionary(spark, COUNTS | {"": 3, "no": 0}).union(spark.createDataFrame([("学生", 30), (None, 1)], "key string, n long"))
    found = probable.segment_probable(df, ["id"], F.col("t"), words, " ", shard_chars=shard_chars).collect()
    got = {r["id"]: r["tokens"] for r in found}
    assert len(found) == len(texts) + 1
    # Both halves together are likelier than the long word and a rest.
    assert got[0] == ["北京", "大", "学生", "ab", "cde"]
    assert got[1] == got[2] == got[3] == [] and got[4] == ["q"] and got[5] == ["ab"] and got[7] == ["ab"] * 4
    assert "".join(got[6]) == texts[6]


def test_no_dictionary(spark):
    df = spark.createDataFrame([("abc d",)], "t string")
    found = probable.segment_probable(df, [], F.col("t"), spark.createDataFrame([], "key string, n long"), " ")
    assert "".join(found.first()["tokens"]) == "abcd"


def test_a_run_that_comes_again_is_cut_once(spark, monkeypatch):
    words = spark.createDataFrame([("ab", 5), ("abc", 3), ("c", 2)], "key string, n long")
    rows = [(i, " ".join(["abab", "abcq", "xyz", "x" * 70, "", "abab"] * 5)) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    plain = [tuple(r["tokens"]) for r in probable.segment_probable(df, ["id"], F.col("text"), words, " ").collect()]
    assert plain == [(("ab", "ab", "abc", "q", *plain[0][4:-2], "ab", "ab"))] * 30 and "".join(plain[0]) == rows[0][1].replace(" ", "")
    made = []
    cut = probable._cut
    monkeypatch.setattr(probable, "_cut", lambda run, *a: made.append(run) or cut(run, *a))
    monkeypatch.setattr(probable, "sliced", lambda find, *_: found.append(find) or F.array)
    for kept in (probable.KEPT_RUNS, 1):
        monkeypatch.setattr(probable, "KEPT_RUNS", kept)
        found = []
        probable.segment_probable(df, ["id"], F.col("text"), words, " ")
        made.clear()
        texts = [text.split(" ") for _, text in rows]
        assert [tuple(t) for t in found[0](texts) + found[0](texts)] == plain * 2
        # Long runs are cut again in each slice.
        assert len(made) == (6 if kept > 1 else len(made)) <= 10
