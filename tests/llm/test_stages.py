"""The pipeline's stages on odd rows: nulls, empty and long texts, repeated rows and ids, clashing names, empty tables."""

from __future__ import annotations

import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from cuelake.llm import simhash  # noqa: E402
from cuelake.llm.common import components  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
EXTRA = ["row", "mark", "nth", "label", "share", "languages", "_row", "_kept", "node", "component_id", "root", "hashes"]
PROSE = "the quick brown fox jumps over the lazy dog while the old farmer reads a long letter from his sister in the city"


@pytest.fixture(scope="module")
def docs(spark):
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").orderBy(F.length("text").desc()).first()["text"]
    texts = [(1, PROSE), (1, PROSE), (1, "another text of the same id that has nothing at all in common with the first one of them"), (2, PROSE), (3, PROSE + " again"), (None, PROSE), (None, PROSE), (None, item),
             (4, None), (5, ""), (6, " \n\t "), (7, f"{PROSE} {item}"), (8, "word " * 30_000), (9, "1234 5678"), (10, "password = 'Zx81-qwe7-Trn4'")]
    rows = spark.createDataFrame([(i, t, "en", None if k % 2 else "s", len(t or "")) for k, (i, t) in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    return rows.select("*", *[F.lit(7).alias(name) for name in EXTRA])


def stage_named(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_near_duplicates(spark, docs):
    out = stage_named("near duplicates")(spark, docs, FOLDER)
    assert out.columns == docs.columns
    rows = out.collect()
    assert all(r[name] == 7 for r in rows for name in EXTRA)
    got = sorted((str(r["doc_id"]), (r["text"] or "")[:9]) for r in rows)
    # one row of id 1 and its likes, and the other text of id 1; one of the wordless texts; all rows without an id
    assert got == sorted([("1", "the quick"), ("1", "another t"), ("None", "the quick"), ("None", "the quick"), *[("None", docs.where("doc_id IS NULL").collect()[2]["text"][:9])],
                          ("4", ""), ("7", "the quick"), ("8", "word word"), ("9", "1234 5678"), ("10", "password ")])
    assert stage_named("near duplicates")(spark, docs.where("false"), FOLDER).collect() == []


def test_benchmark(spark, docs):
    out = stage_named("benchmark")(spark, docs, FOLDER)
    rows = out.collect()
    assert out.columns == docs.columns and all(r[name] == 7 for r in rows for name in EXTRA)
    assert len(rows) == docs.count() - 2 and 7 not in {r["doc_id"] for r in rows}
    assert sum(r["doc_id"] is None for r in rows) == 2
    assert stage_named("benchmark")(spark, docs.where("false"), FOLDER).collect() == []


def test_secrets(spark, docs):
    out = stage_named("secrets")(spark, docs, FOLDER)
    rows = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert out.columns == docs.columns and out.count() == docs.count()
    assert (4, None) in rows and (5, "") in rows and (2, PROSE) in rows and all("Zx81" not in (t or "") for _, t in rows)
    assert stage_named("secrets")(spark, docs.where("false"), FOLDER).collect() == []


def test_language_and_mix(spark, docs):
    every = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars", *[F.lit(7).alias(name) for name in EXTRA])
    out = stage_named("language")(spark, every.unionByName(docs.where("doc_id IN (2, 4, 5, 6, 9)")), FOLDER)
    assert out.columns == docs.columns
    ids = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert not {(4, None), (5, ""), (6, " \n\t "), (9, "1234 5678")} & ids
    mixed = stage_named("mix")(spark, docs, FOLDER)
    assert mixed.count() > 0
    assert stage_named("mix")(spark, docs.where("false"), FOLDER).collect() == []


def test_near_duplicates_by_simhash(spark):
    """Two texts within three bits whose five-word sets are too unlike (two changed words of 40) leave one row."""
    words = [f"w{k}" for k in range(400)]
    rng = random.Random(3)
    base = next(b for b in iter(lambda: rng.sample(words, 40), None) if bin((simhash.simhash(" ".join(b)) ^ simhash.simhash(" ".join(changed(b)))) & (1 << 64) - 1).count("1") <= 3)
    texts = [(2, " ".join(base)), (1, " ".join(changed(base))), (3, PROSE)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert sorted(r.component_id for r in simhash.similar_groups(docs).collect()) == [1, 2, 3]
    assert sorted(r.doc_id for r in stage_named("near duplicates")(spark, docs, FOLDER).collect()) == [1, 3]


def changed(words):
    return [w + "x" if k in (15, 30) else w for k, w in enumerate(words)]


def test_a_crowd_of_near_copies_is_not_paired(spark, monkeypatch):
    """Copies that are alike in about half of their pairs: the pairs left for the last comparison stay few."""
    rng = random.Random(11)
    words = [f"w{k}" for k in range(120)]
    texts = [" ".join(w + f"y{k}" if at in set(rng.sample(range(20, 100), 2)) else w for at, w in enumerate(words)) for k in range(150)]
    counts, plain = {}, simhash.stage

    def counted(df, name):
        out = plain(df, name)
        counts[name] = counts.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(simhash, "stage", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(docs).collect()}
    sets = [{" ".join(t.split()[i : i + 5]) for i in range(116)} for t in texts]
    assert got == rooted(range(150), lambda a, b: len(sets[a] & sets[b]) * 9 >= (len(sets[a]) + len(sets[b])) * 4)
    assert counts["rest"] <= 150


def test_crowded_fingerprints_are_not_paired(spark):
    rng = random.Random(5)
    crowds = [(rng.getrandbits(64), rng.sample(range(64), 14)) for _ in range(3)]  # near copies differ in the bits nearest to a tie
    values = sorted({b ^ sum(1 << k for k in rng.sample(bits, rng.randrange(4))) for b, bits in crowds for _ in range(300)} | {rng.getrandbits(64) for _ in range(50)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    want = rooted(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    got = {r.node: r.root for r in simhash.print_groups(fps, 3).collect()}
    assert {v: got.get(v, v) for v in signed} == want
    crowds = components(simhash.crowded_links(fps, 3)).select(F.col("node").alias("fp"), F.col("root").alias("group"))
    every, left = simhash.near_pairs(fps, 3).count(), simhash.near_pairs(fps.join(crowds, "fp", "left"), 3).count()
    assert every > 10 * len(signed) and left <= len(signed)


def rooted(nodes, linked):
    """Node: smallest node reachable, by brute force."""
    nodes, root = list(nodes), {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {n: top(n) for n in nodes}
