"""Small cases of the training-text operators: brute force, SQL twins, odd inputs."""

from __future__ import annotations

import hashlib
import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from compare import canonical, engine  # noqa: E402
from cuelake.llm import decontaminate, forest, language, licenses, mixing, preference, recompression, rindex, secrets, simhash  # noqa: E402
from cuelake.llm.queries import CHECKS, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, score string"
LONG = "word " * 20_000 + "end"
ODD = [
    (1, None, "en", "a", 0, "x", "y"), (2, "", None, None, 0, None, None), (3, "   \n\t ", "en", "a", 5, None, None),
    (4, "same text in two rows", "en", "a", 21, None, None), (4, "same text in two rows", "en", "a", 21, None, None),
    (None, "a row without a name", "en", "b", 20, None, None), (5, LONG, "en", "b", len(LONG), None, None), (6, LONG, "de", None, len(LONG), None, None),
    (7, "1234 5678", "de", "b", 9, None, None), (4, "another text of the same name", "fr", "c", 29, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_sql(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    rows = frame.collect()
    want = engine(FOLDER).sql(CHECKS[name])
    assert canonical(frame.columns, [tuple(r) for r in rows]) == canonical(want.columns, want.fetchall())


def removed(docs, units, join, length=50):
    """Brute force of the two substring operators: {doc_id: (units, removed, spans, hash)}."""
    every = [(d, units(t)) for d, t in docs]
    first = {}
    whole = bytes if every and isinstance(every[0][1], bytes) else tuple
    for d, u in every:
        for i in range(len(u) - length + 1):
            first[whole(u[i : i + length])] = min(d, first.get(whole(u[i : i + length]), d))
    out = {}
    for d, u in every:
        lost = [False] * len(u)
        for i in range(len(u) - length + 1):
            if first[whole(u[i : i + length])] < d:
                lost[i : i + length] = [True] * length
        spans = sum(x and not (i and lost[i - 1]) for i, x in enumerate(lost))
        out[d] = (len(u), sum(lost), spans, hashlib.sha256(join(x for x, gone in zip(u, lost) if not gone)).hexdigest())
    return out


def test_words_against_brute_force(spark, documents):
    want = removed(documents, lambda t: t.encode().split(), b" ".join)
    got = {r.doc_id: r for r in recompression.op6_recompression(spark, FOLDER).collect()}
    assert {d: (r.n_words, r.n_removed, r.kept_sha256) for d, r in got.items()} == {d: (a, b, c) for d, (a, b, _, c) in want.items()}


def test_runs_and_periods(spark):
    texts = ["a " * 120, "x " + "a " * 70, "a b " * 60, "c " + "b a " * 40, " ".join(map(str, range(90))), " ".join(map(str, range(30, 120)))]
    docs = list(enumerate(texts))
    want = removed(docs, lambda t: t.encode().split(), b" ".join)
    got = recompression.dedup_words(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_removed, r.kept_sha256) for r in got} == {d: (b, c) for d, (_, b, _, c) in want.items()}


def test_bytes_against_brute_force(spark, documents):
    docs = documents + [(10**6 + k, f"{k} under one anchor " + 'the same thirty-four bytes of text' + f" and then {k % 7} {k}" * 4) for k in range(300)]  # a hot anchor
    docs += [(1000 * 1000 + 1000, "é" * 80), (1001001, "zz" + "é" * 60), (1001002, "ab" * 100)]
    want = removed(docs, lambda t: t.encode(), bytes)
    got = rindex.dedup_bytes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want


def test_matching_statistics():
    import numpy as np

    held, asked = [b"banana bandana", b"an anagram, a nap", b"nab a banana"], b"a bandanab, an anagram bana"
    text = b"".join(x + b"\xff" for x in held)
    index = rindex.RunIndex(np.frombuffer(text, np.uint8), np.repeat([5, 3, 4], [len(x) + 1 for x in held]), 4)
    got = {int(p): int(d) for at, docs in index.stream(np.frombuffer(asked, np.uint8), np.array([len(asked) - 1]), np.array([0])) for p, d in zip(at, docs)}
    own = [(5, held[0]), (3, held[1]), (4, held[2])]
    assert got == {i: min(d for d, x in own if asked[i : i + 4] in x) for i in range(len(asked) - 3) if any(asked[i : i + 4] in x for x in held)}


def test_simhash_groups(spark, documents):
    got = simhash.op9_simhash(spark, FOLDER).collect()
    prints = {r.doc_id: int(r.fingerprint, 16) for r in got}
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sorted(prints):
        for b in prints:
            if b < a and (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert {r.doc_id: r.component_id for r in got} == {d: find(d) for d in prints}


def test_chain_of_fingerprints(spark):
    chain = [0b1, 0b1111, 0b1111111, 0b1111111111, 1 << 60 | 0b1111111111]
    pairs = {(r.u, r.v) for r in simhash.near_pairs(spark.createDataFrame([(x,) for x in chain], "fp long")).collect()}
    assert pairs == {(a, b) for a in chain for b in chain if a > b and (a ^ b).bit_count() <= 3}


def similar(texts):
    """Brute force: {id: smallest id reachable by five-word similarity of 0.8 or more}."""
    sets = {}
    for d, text in texts:
        words = (text or "").encode().lower().split()
        sets[d] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sorted(sets):
        for b in sets:
            if b < a and (sets[a] == sets[b] or 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b])) > 0):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in sets}


def test_similar_groups(spark, documents):
    """Copies with a few words replaced, chains of them, short and wordless texts, all meet and no others do."""
    import random

    draw = random.Random(7)
    texts = list(documents)
    for base in range(12):
        words = [f"b{base}w{draw.randrange(400)}" for _ in range(draw.choice([30, 120, 600]))]
        for copy in range(6):
            texts.append((100_000 + 10 * base + copy, " ".join(words)))
            for _ in range(max(1, len(words) // 60)):
                words[draw.randrange(len(words))] = f"new{draw.random()}"
    passage = " ".join(f"p{k}" for k in range(40))
    texts += [(200_000 + k, passage + " " + " ".join(f"q{draw.random()}" for _ in range(60))) for k in range(30)]
    texts += [(300_000, ""), (300_001, " "), (300_002, "a b c"), (300_003, "A b  c"), (300_004, "a b")]
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    want = similar(texts)
    assert got == want and sum(want[d] != d for d in want if d >= 100_000) >= 30


def test_language(spark):
    got = language.op5_language(spark, FOLDER).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    held = [r for r in got if r.held_out]
    assert held and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_language_mixture():
    import numpy as np

    words = [["aaaa", "abab"] * 40, ["zzzz", "zyzy"] * 40]
    table = np.stack([np.log((np.bincount(language.trigrams(w)[0], minlength=language.BUCKETS) + 0.5) / (1 + language.BUCKETS)) for w in words])
    share = language.infer([words[0], words[1], words[0] + words[1] * 3, []], table)
    assert share[0].tolist() == [1, 0] and share[1].tolist() == [0, 1]
    assert abs(share[2][1] - 0.75) < 0.02 and share[3].sum() == 0


def test_decontamination(spark):
    item = "one small step for a person and one giant leap for everybody who stayed at home that night"
    edited = item.replace("giant", "really huge").replace("stayed at", "was")
    docs = [(1, "before it " + item + " and after"), (2, "clean words about nothing in particular " * 5), (3, "so " + edited + " they said"), (4, None)]
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(9, item), (8, None)], "item_id long, text string")).collect()
    by = {r.doc_id: r for r in got}
    assert set(by) == {1, 3} and by[1].score == 1.0 and (by[1].first_word, by[1].last_word) == (2, 19) and 0.5 < by[3].score < 1


@pytest.mark.parametrize("intact", [False, True])
def test_evenly_edited_copies(spark, intact):
    """Copies with every 4th to 8th word replaced score what a brute-force alignment says, beside an intact copy or alone."""
    item = [f"w{k}" for k in range(38)]
    texts = {n: [f"x{n}y{k}" if k % n == n - 1 else w for k, w in enumerate(item)] for n in (4, 5, 6, 7, 8)}
    if intact:
        texts[1] = item

    def best(q, t):
        last, top = [0] * (len(t) + 1), 0
        for a in q:
            now = [0]
            for j, b in enumerate(t, 1):
                now.append(max(0, last[j - 1] + (2 if a == b else -1), last[j] - 1, now[-1] - 1))
            last, top = now, max(top, *now)
        return top

    docs = [(n, " ".join(["before", "it", *t, "and", "after"])) for n, t in texts.items()]
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")).collect()
    assert {r.doc_id: r.score for r in got} == {n: best(item, t) / 76 for n, t in texts.items()}


def test_secrets():
    text = 'é password = "abc12" token: \'a1B2c3D4\' AKIA' + "Q" * 16 + " deadbeef" * 3
    spans, more = secrets.scan(text + " " + "0123456789abcdef" * 2)
    assert [k for *_, k in sorted(spans)] == ["assign", "access", "hex"] and text[sorted(spans)[0][0] :].startswith("token")
    assert more and secrets.scan("internationalization_of_everything_here")[1] == [] and secrets.scan(None) == ([], [])
    assert secrets.hot_windows("ab" * 20, 20, 1.0) == [(0, 40)] and secrets.hot_windows("ab" * 20, 20, 1.01) == []


def test_quick_filter_of_secrets(spark):
    """find_secrets finds what scan finds, also in texts without a digit."""
    token = "QwErTyUiOpAsDfGhJkLzXcVbNm"
    texts = [*(f"{a}{mark}{token}" for mark in ("+", "/", "_", "=", "-", "-=", "") for a in ("", "text ", "é", "\n")), token + "+", "+" * 30, f"a b-{token}", f"+{token} a1"]
    got = {r.doc_id: r.spans for r in secrets.find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    want = {d: secrets.written([s for part in secrets.scan(t) for s in part]) for d, t in enumerate(texts)}
    assert got == want and want[0]


def test_mixing_meets_targets(spark):
    got = mixing.op4_mixing(spark, FOLDER).collect()
    assert all(r.taken <= 3 * r.size for r in got) and len(got) == 200
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for name in set(source.values()):
        own = [r for r in got if source[r.doc_id] == name]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2 * mixing.BLOCK
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.op4_mixing(spark, FOLDER).collect()))


def test_targets_with_excess(spark):
    rows = spark.createDataFrame([("a", 900), ("b", 10), ("c", 90), (None, 0)], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    assert got["b"] == 30 and got["c"] == 270 and abs(got["a"] - 700) < 1e-9 and got[None] == 0


def test_nearest(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    data = rng.standard_normal((300, 8)).astype(np.float32)
    data[200:260] = data[0] * 10
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)] + [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, vec array<float>")
    got = {}
    for r in forest.nearest(frame, frame.where("vec_id % 20 = 0"), k=5, leaf=40, leaves=60).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    exact = data.astype(float)
    right = total = 0
    for q in range(0, 300, 20):
        score = exact @ exact[q]
        order = [i for i in np.lexsort((np.arange(300), -np.round(score, 9))) if i != q][:5]
        right, total = right + len(set(order) & set(got[q])), total + 5
    assert set(got) == set(range(0, 300, 20)) and right >= 0.9 * total
    assert got[0] == [200, 201, 202, 203, 204]


def test_preference_pairs(spark):
    turns = "pair_id long, turn long, role string, text string, part string"
    a = spark.createDataFrame([(1, 0, "user", "hi", ""), (1, 1, "assistant", "yes", ""), (1, 1, "assistant", "yes", ""), (None, 0, "user", "x", ""), (2, None, None, None, "")], turns)
    b = spark.createDataFrame([(1, 0, "user", "hi", ""), (1, 1, "assistant", "no", ""), (2, None, None, None, "")], turns)
    got = {(r.pair_id, r.part, r.turn): (r.rendered, r.train_start) for r in preference.preference(a, b).collect()}
    assert got == {
        (1, "prompt", 0): ("<|user|>\nhi<|end|>\n", None), (1, "chosen", 1): ("<|assistant|>\nyes<|end|>\n", 14),
        (1, "rejected", 1): ("<|assistant|>\nno<|end|>\n", 14), (2, "prompt", None): ("<||>\n<|end|>\n", None)}


def test_odd_rows(spark, odd):
    n = len(ODD)
    assert len(licenses.scan(odd).collect()) == n
    assert len(secrets.find_secrets(odd).collect()) == n and secrets.redact(odd).columns == odd.columns
    assert len(mixing.taken(spark, odd).collect()) == n
    groups = simhash.near_groups(odd).collect()
    assert len(groups) == n and {r.component_id for r in groups if r.doc_id in (5, 6)} == {5}
    labels, table = language.train(odd)
    named = language.identify(odd, labels, table).collect()
    assert len(named) == n and {r.lang_pred for r in named if r.doc_id in (1, 2, 3, 7)} == {"und"}
    words = recompression.dedup_words(odd).collect()
    assert len(words) == n and {r.doc_id: r.n_removed for r in words}[6] == 20_001
    assert len(rindex.dedup_bytes(odd.where("doc_id <> 6 AND doc_id <> 5 OR doc_id IS NULL")).collect()) == n - 2
    assert decontaminate.leaks(odd, spark.createDataFrame([(1, None)], "item_id long, text string")).collect() == []


def test_empty_tables(spark, odd):
    none = odd.where(F.lit(False))
    for frame in (licenses.scan(none), secrets.find_secrets(none), mixing.taken(spark, none), simhash.near_groups(none), language.identify(none, *language.train(none)),
                  recompression.dedup_words(none), rindex.dedup_bytes(none), decontaminate.leaks(none, none.selectExpr("doc_id AS item_id", "text"))):
        assert frame.collect() == []
    vectors = spark.createDataFrame([], "vec_id long, vec array<float>")
    assert forest.nearest(vectors, vectors).collect() == []


def test_nameless_rows_and_test_items(spark):
    import corpus_pipeline

    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").where("text IS NOT NULL").orderBy("item_id").first().text
    docs = spark.createDataFrame([(None, "so " + item), (None, "nothing of the kind in here"), (None, None), (1, item), (2, "clean")], "doc_id long, text string")
    left = corpus_pipeline.no_test_items(spark, docs, FOLDER).collect()
    assert sorted(map(str, left)) == sorted(map(str, docs.where("text IS NULL OR doc_id = 2 OR text LIKE 'nothing%'").collect()))


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = corpus_pipeline.run(spark, FOLDER)
    assert len(corpus_pipeline.STAGES) == 5 and out.count() > 0
    kept = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    seen, first = {}, set()
    for r in docs.orderBy("doc_id").collect():
        first.add(seen.setdefault(r.text, r.doc_id))
    assert kept <= first


def test_words_of_a_window_share_an_anchor():
    """Equal windows have equal keys and routes in any text; codes tell words of all lengths apart."""
    import random

    draw = random.Random(5)
    pool = ["a", "bb", "ß", "eightlet", "eightlett", "x" * 64, "x" * 65, "y" * 300, *(f"w{k}" for k in range(30))]
    shared = [draw.choice(pool) for _ in range(70)]
    texts = [[draw.choice(pool) for _ in range(draw.randint(0, 40))] + shared + [draw.choice(pool) for _ in range(draw.randint(0, 40))] for _ in range(6)]
    texts.append(["same"] * 120)
    seen = {}
    for words in texts:
        units = recompression.Words.units(draw.choice([" ", "\t", "\n \v"]).join(words) + " ")
        assert units.bytes().split() == [w.encode() for w in words]
        base, _, named = recompression.Words.anchors([units], 50)
        key, route = named(list(range(len(base))))
        for k in range(len(words) - 49):
            assert seen.setdefault(tuple(words[k : k + 50]), (key[k], route[k])) == (key[k], route[k])
    codes = recompression.Words.codes([recompression.Words.units(" ".join(pool))])
    assert len(set(codes.tolist())) == len(pool) + 1


def test_copies_of_whole_texts_are_not_gone_through(spark, monkeypatch):
    """Equal texts were cut, shuffled and searched once a copy; short, null and repeated ids keep their rules."""
    rnd = random.Random(5)
    word = lambda n: "".join(rnd.choices("abcé ", k=n))
    one, two, short = word(300), word(200), word(20)
    docs = [(7, one), (3, one), (9, one), (3, one), (None, one), (4, two + one[100:220]), (5, two), (8, two), (2, short), (1, short), (6, None), (10, ""), (11, word(400))]
    sent = []
    keep = rindex.repeats.removals
    monkeypatch.setattr(rindex.repeats, "removals", lambda rows, method, length, heads: sent.extend(heads.collect()) or keep(rows, method, length, heads))
    got = rindex.dedup_bytes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in sent) == [3, 3, 4, 5, 11]
    held = {}
    for doc, text in docs:
        body = (text or "").encode()
        for at in range(len(body) - 49 if doc is not None else 0):
            held[body[at : at + 50]] = min(held.get(body[at : at + 50], doc), doc)
    wanted = []
    for doc, text in docs:
        body = (text or "").encode()
        lost = [False] * len(body)
        for at in range(len(body) - 49 if doc is not None else 0):
            if held[body[at : at + 50]] < doc:
                lost[at : at + 50] = [True] * 50
        kept = bytes(b for b, gone in zip(body, lost, strict=True) if not gone)
        wanted.append((doc, len(body), sum(lost), sum(x and not y for x, y in zip(lost, [False, *lost], strict=False)), hashlib.sha256(kept).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)
