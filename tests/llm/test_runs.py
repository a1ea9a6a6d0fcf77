"""Periodic runs: grammar, brute force on made texts and on the whole table, odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from cuelake.llm.runs import collapse, op13_runs, periodic_runs, repair, word_runs

FOLDER = "/root/testdata/sf0.001"


def brute(words, least=24, times=3):
    """Every maximal stretch for every period, smallest period first."""
    out = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                out.setdefault((i, j + q), q)
            i = max(i + 1, j)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def made(rng):
    k = rng.choice([1, 2, 3, 5, 30])
    words = [str(rng.randrange(k)) for _ in range(rng.randrange(140))]
    for _ in range(rng.randrange(4)):
        cycle = [str(rng.randrange(rng.choice([k, 40]))) for _ in range(rng.randrange(1, 15))]
        at = rng.randrange(len(words) + 1)
        words[at:at] = (cycle * rng.randrange(2, 9))[: rng.randrange(1, 100)]
    return words


@pytest.mark.parametrize("limits", [(24, 3), (6, 3), (24, 4), (10, 3)])
def test_brute_force(limits):
    rng = random.Random(sum(limits))
    for _ in range(250):
        words = made(rng)
        assert word_runs(words, *limits) == brute(words, *limits)


def test_grammar_derives_the_text():
    rng = random.Random(1)
    for _ in range(100):
        word = [rng.randrange(3) for _ in range(rng.randrange(80))]
        rules, top = repair(word)

        def spell(x, rules=rules):
            return spell(rules[x][0]) + spell(rules[x][1]) if x in rules else [x]

        assert sum((spell(x) for x, _ in top), []) == word
        pairs = [(a, b) for (a, _), (b, _) in zip(top, top[1:], strict=False) if a != b]
        assert len(set(pairs)) == len(pairs)


def test_long_texts():
    assert word_runs(["a"] * 100_000) == [(0, 100_000, 1)]
    cycle = [str(i) for i in range(7000)]
    assert word_runs(["x", *cycle * 3, "y"]) == [(1, 21_000, 7000)]
    assert word_runs(["x", *cycle * 2, *cycle[:6999], "y"]) == []


def test_whole_table(spark):
    got = {r["doc_id"]: r for r in op13_runs(spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert len(got) == len(docs)
    seen = 0
    for d in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "")
        h, n = zlib.crc32(str(d["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute(words)
        seen += len(runs)
        top = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        r = got[d["doc_id"]]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *top)
        assert r["exponent_milli"] == (1000 * top[1] // top[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(collapse(words, runs)).encode()).hexdigest()
    assert seen > 10


def test_odd_rows(spark):
    loop = "a b c " * 20
    rows = [(1, None, "x"), (2, "", None), (2, " \n\t", None), (None, loop, "y"), (3, loop, "y"), (3, loop, "y"), (4, "one two", "z"), (5, "w " * 60_000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, period string")
    found = periodic_runs(docs)
    assert found.columns == ["doc_id", "text", "period", "runs", "collapsed"]
    got = sorted((str(r["doc_id"]), r["collapsed"], [tuple(x) for x in r["runs"]]) for r in found.collect())
    a = ("a b c", [(0, 60, 3)])
    assert got == sorted([("1", "", []), ("2", "", []), ("2", "", []), ("None", *a), ("3", *a), ("3", *a), ("4", "one two", []), ("5", "w", [(0, 60_000, 1)])])
    assert periodic_runs(docs.where("false")).collect() == []
    with pytest.raises(ValueError, match="runs"):
        periodic_runs(docs.withColumnRenamed("period", "Runs"))
    with pytest.raises(ValueError, match="periods"):
        periodic_runs(docs, times=2)
    # a table with other columns of the names the query uses
    assert periodic_runs(docs.withColumnRenamed("period", "h")).count() == len(rows)
