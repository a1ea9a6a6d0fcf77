"""Language identification as a mixture: expectation-maximisation over word likelihoods.

A language is a table of letter-trigram frequencies in hashed buckets. A document's words are
draws from a mixture of languages; EM finds the proportions from the trigram likelihoods of its
words, and penalised likelihood decides which languages belong to it: a further language must
raise the log likelihood by more than `penalty` * ln(1 + words). The mixture of all languages
bounds every smaller one, so a document it does not improve enough is done at once; for the rest
nested sets, in the order of the full mixture's proportions, are fitted anew.

The model is fitted on a bounded sample: at most about `sample` documents of each of the
`max_langs` most frequent labels, picked by a hash of doc_id. Its size is languages x buckets,
whatever the corpus. Predictions take the text alone. Every text is read whole.

Defined cases: a null text, or one without a letter, is `und` with score 0, as is every text when
nothing can be learned; a row with a null doc_id or null label is never learned from, and a null
doc_id is not held out; equal likelihoods go to the label first in order; each input row gives one
row; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuelake.llm.common import read

BUCKETS = 1 << 15
SAMPLE = 10_000
MAX_LANGS = 256
PENALTY = 2.0
ROUNDS = 12
CELLS = 4_000_000  # numbers in one likelihood matrix

_letters = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return [w for w in _letters.findall((text or "").lower()) if w.isalpha() or any(c.isalpha() for c in w)]


def trigrams(words: list[str]):
    """(bucket, word number) of every letter trigram; a word's ends count as letters."""
    import numpy as np

    line = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    mixed = line[:-2] * np.uint64(0x9E3779B97F4A7C15) + line[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + line[2:] * np.uint64(0x165667B19E3779F9)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    bucket = (mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
    inner = line[1:-1] != 32
    return bucket[inner], np.cumsum(line[1:-1] == 32)[inner]


def encoded(lists: list[list[str]]):
    """Distinct words of a batch, and for every document's distinct words: (document, word, count)."""
    import numpy as np

    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    coded = pa.array([w for ws in lists for w in ws], pa.large_string()).dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    key = np.repeat(np.arange(len(lists)), sizes) * max(1, len(distinct)) + coded.indices.to_numpy(zero_copy_only=False)
    key, count = np.unique(key, return_counts=True)
    return distinct, key // max(1, len(distinct)), key % max(1, len(distinct)), count


def learnable() -> Column:
    return F.col("lang").isNotNull() & F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.lit(False))


def train(docs: DataFrame, sample: int = SAMPLE, max_langs: int = MAX_LANGS):
    """(labels, log probabilities by label and bucket) from the text and label of learnable rows."""
    import numpy as np

    rows = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), "text").where(learnable())
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs).collect()
    if not sizes:
        return [], np.zeros((0, BUCKETS), np.float32)
    share = F.create_map(*(x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(1.0, sample / r["count"])))))
    luck = F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    picked = rows.where(luck < F.coalesce(F.element_at(share, F.col("lang")), F.lit(0.0)))

    def count(parts):
        sums: dict[str, np.ndarray] = {}
        for part in parts:
            texts, langs = part.column(0).to_pylist(), part.column(1).to_pylist()
            for lang in set(langs):
                distinct, _, word, n = encoded([words_of(t) for t, x in zip(texts, langs, strict=True) if x == lang])
                if distinct:
                    each = np.bincount(word, n, len(distinct))
                    bucket, at = trigrams(distinct)
                    sums[lang] = sums.get(lang, 0) + np.bincount(bucket, each[at], BUCKETS)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at].astype(np.int64))], names=["lang", "bucket", "n"])

    counted = picked.select("text", "lang").mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    labels = sorted(set(counted.column("lang").to_pylist()))
    table = np.zeros((len(labels), BUCKETS))
    where = {lang: k for k, lang in enumerate(labels)}
    np.add.at(table, (np.array([where[x] for x in counted.column("lang").to_pylist()], np.int64), counted.column("bucket").to_numpy()), counted.column("n").to_numpy())
    return labels, np.log((table + 0.5) / (table.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)).astype(np.float32)


def proportions(ratio, count, first, rounds: int = ROUNDS, allowed=None):
    """EM over the documents that begin at `first`: (proportions, log likelihood) of each.

    ratio: likelihood of each row's word under each language, 1 at the best; allowed: languages
    that a document may hold.
    """
    import numpy as np

    n = len(first)
    size = np.diff(np.append(first, len(count)))
    doc = np.repeat(np.arange(n), size)
    total = np.add.reduceat(count, first)[:, None]
    share = np.full((n, ratio.shape[1]), 1.0 / ratio.shape[1]) if allowed is None else allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        joint = ratio * share[doc]
        joint *= (count / np.maximum(joint.sum(axis=1), 1e-300))[:, None]
        share = np.add.reduceat(joint, first) / total
    fit = np.log(np.maximum((ratio * share[doc]).sum(axis=1), 1e-300)) * count
    return share, np.add.reduceat(fit, first)


def infer(lists: list[list[str]], table, penalty: float = PENALTY):
    """(share of each language, 0 for those left out) for every document; no words: all 0."""
    import numpy as np

    out = np.zeros((len(lists), table.shape[0]))
    distinct, doc, word, count = encoded(lists)
    if not distinct or not table.shape[0]:
        return out
    bucket, at = trigrams(distinct)
    score = np.stack([np.bincount(at, row[bucket], len(distinct)) for row in table], axis=1)
    score -= score.max(axis=1, keepdims=True)
    own, first = np.unique(doc, return_index=True)
    log, count = score[word], count.astype(float)
    ratio = np.exp(log)
    single = np.add.reduceat(log * count[:, None], first)
    best = single.argmax(axis=1)
    bar = penalty * np.log1p(np.add.reduceat(count, first))
    share, fit = proportions(ratio, count, first)
    chosen = np.zeros_like(share)
    chosen[np.arange(len(own)), best] = 1.0
    value = single.max(axis=1)
    open_ = np.flatnonzero(fit - value > bar)
    rank = np.argsort(np.argsort(-share, axis=1, kind="stable"), axis=1)
    ends = np.append(first[1:], len(count))
    for k in range(2, table.shape[0] + 1):
        if not len(open_):
            break
        rows = np.concatenate([np.arange(first[d], ends[d]) for d in open_])
        starts = np.concatenate(([0], np.cumsum(ends[open_] - first[open_])[:-1]))
        new, new_fit = proportions(ratio[rows], count[rows], starts, allowed=(rank[open_] < k).astype(float))
        new_value = new_fit - (k - 1) * bar[open_]
        better = new_value > value[open_]
        chosen[open_[better]], value[open_[better]] = new[better], new_value[better]
        open_ = open_[fit[open_] - k * bar[open_] > value[open_]]
    out[own] = chosen
    return out


def identify(docs: DataFrame, labels: list[str], table, penalty: float = PENALTY, names=("lang_pred", "score", "langs")) -> DataFrame:
    """`docs` with the predicted label, its share and all languages held (label:share,...) added.

    Columns that have one of these `names` already are replaced.
    """
    old = docs.drop(*names)
    kept = old.select("*", F.col("text").alias("_text of the prediction"))
    schema = T.StructType([*old.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType()), T.StructField(names[2], T.StringType())])

    def batches(parts):
        for part in parts:
            texts = part.column(part.num_columns - 1).to_pylist()
            found, group, room = [], [], CELLS
            for text in [*texts, None]:
                words = words_of(text)
                cells = len(words) * max(1, len(labels))
                if group and (room < cells or len(found) + len(group) == len(texts)):
                    found += infer(group, table, penalty).tolist()
                    group, room = [], CELLS
                group.append(words)
                room -= cells
            preds, scores, langs = [], [], []
            for share in found:
                top = max(share, default=0.0)
                preds.append(labels[share.index(top)] if top > 0 else "und")
                scores.append(min(1.0, float(top)))
                langs.append(",".join(f"{labels[k]}:{x:.4f}" for k, x in sorted(enumerate(share), key=lambda p: (-p[1], p[0])) if x > 0))
            columns = [*part.columns[:-1], pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(langs, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return kept.mapInArrow(batches, schema)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    labels, table = train(docs)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    named = identify(docs.select(F.col("doc_id").cast("long"), "text", held.alias("held_out")), labels, table)
    return named.select("doc_id", "held_out", "lang_pred", "score", "langs")
