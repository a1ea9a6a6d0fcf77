"""Secret scan: fixed patterns and windowed character entropy.

One narrow Arrow pass: a text is scanned where it is read, nothing is shuffled. Regular
expressions of linear time pick the texts that can hold anything at all, the exact scan runs on
those. Entropy is judged on candidate strings (runs of key characters): in every window of
`window` characters, letters and digits counted per character class, the Shannon entropy of
the characters is kept by incremental counts; windows at or over the class's limit join up to a
span. Candidates on the allow-list (words, identifiers with few digits, repeated patterns, paths,
UUIDs) are suppressed; the fixed patterns never are.

Defined cases: a null text counts as empty and has no span; each input row gives one row, repeated
or not; a null doc_id stays null; empty tables give no rows; other columns are ignored.
Offsets are code points, ends exclusive, over the whole match.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuelake.llm.common import read

# Fixed values of the query contract.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}

WINDOW = 20
#: Bits per character over a window, by the class of the candidate.
LIMITS = {"hex": 3.0, "base32": 3.4, "base64": 3.6}
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALLOW = (
    r"(?i)[0-9a-f]{8}-([0-9a-f]{4}-){3}[0-9a-f]{12}",  # UUID
    r"(?i).*(example|dummy|sample|placeholder|changeme|redacted).*",
    r"[A-Za-z]*[0-9]{0,4}",  # a word, perhaps numbered
    r"[0-9+_=/-]*",  # numbers, dates, rules
    r"([A-Za-z]+[0-9]{0,4}[_/=+-]+)*[A-Za-z]*[0-9]{0,4}",  # paths and identifiers of words
)

_assign = re.compile(ASSIGN, re.I | re.A)
_access = re.compile(ACCESS)
_hex = re.compile(r"[0-9a-f]{24,}")  # the runs of HEX that are long enough
_candidate = re.compile(CANDIDATE)
_allow = [re.compile(x) for x in ALLOW]
#: Any text with a match below must match this; linear time.
QUICK = r"(?i)(?:password|passwd|secret|token|api_?key)[\"']? *[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = [(m.start(), m.end(), "assign") for m in _assign.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    out += [(m.start(), m.end(), "access") for m in _access.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    return out + [(m.start(), m.end(), "hex") for m in _hex.finditer(text)]


def kind_of(token: str) -> str:
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", token):
        return "hex"
    return "base32" if re.fullmatch(r"[A-Z0-9]+|[a-z0-9]+", token) else "base64"


def allowed(token: str) -> bool:
    return any(rule.fullmatch(token) for rule in _allow)


def hot_windows(token: str, window: int, limit: float) -> list[tuple[int, int]]:
    """Joined spans of the windows whose entropy is at least `limit`; counts move by one character.

    sum(c log c) over the characters of a window determines its entropy, and changes in at most
    two terms per step.
    """
    if len(token) < window:
        return []
    term = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total = 0.0
    out: list[tuple[int, int]] = []
    for at, char in enumerate(token):
        n = counts.get(char, 0)
        counts[char] = n + 1
        total += term[n + 1] - term[n] if n < window else 0.0
        start = at - window + 1
        if start > 0:
            gone = token[start - 1]
            n = counts[gone]
            counts[gone] = n - 1
            total += term[n - 1] - term[n]
        if start >= 0 and math.log2(window) - total / window >= limit - 1e-9:
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], at + 1)
            else:
                out.append((start, at + 1))
    return out


def entropy_spans(text: str, window: int = WINDOW) -> list[tuple[int, int, str]]:
    out = []
    for m in _candidate.finditer(text):
        token = m.group()
        if not allowed(token):
            out += [(m.start() + a, m.start() + b, "entropy") for a, b in hot_windows(token, window, LIMITS[kind_of(token)])]
    return out


def written(spans: list[tuple[int, int, str]]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in ordered)


def scan(text: str | None, window: int = WINDOW) -> tuple[list, list]:
    """(base spans, entropy spans) of one text."""
    return base_spans(text or ""), entropy_spans(text or "", window)


def _scans(texts: pa.Array, window: int):
    """scan() of each text; texts that cannot match are told apart by two linear filters."""
    import pyarrow.compute as pc

    quick = pc.match_substring_regex(texts, QUICK).to_pylist()
    # A candidate that is not allowed has a digit beside a letter or mark, or begins with marks and holds a letter.
    mixed = pc.match_substring_regex(texts, r"[A-Za-z+/_=-][0-9]|[0-9][A-Za-z+/_=-]|(?:^|[^A-Za-z0-9+/_=-])[+/_=-]+[A-Za-z]").to_pylist()
    for text, a, b in zip(texts.to_pylist(), quick, mixed, strict=True):
        yield (base_spans(text) if a else []), (entropy_spans(text, window) if b else [])


def find_secrets(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans) for every row."""
    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string"
    names = [part.split()[0] for part in schema.split(", ")]

    def batches(parts):
        for part in parts:
            rows = []
            for base, more in _scans(part.column(1), window):
                of = [kind for *_, kind in base]
                rows.append((of.count("assign"), of.count("access"), of.count("hex"), len(more),
                             hashlib.sha256(written(base).encode()).hexdigest(), written(base + more)))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(batches, schema)


def redact(docs: DataFrame, mark: str = "[SECRET]", window: int = WINDOW) -> DataFrame:
    """`docs` with every span replaced by `mark`; other columns as they are, a null text stays null."""
    at = docs.columns.index("text")

    def batches(parts):
        for part in parts:
            texts = part.column(at)
            out = []
            for text, (base, more) in zip(texts.to_pylist(), _scans(texts, window), strict=True):
                end, kept = 0, []
                for a, b, _ in sorted(base + more):
                    if a >= end:
                        kept += [text[end:a], mark]
                    end = max(end, b)
                out.append(text if not end else "".join(kept) + text[end:])
            yield part.set_column(at, part.schema.field(at), pa.array(out, texts.type))

    return docs.mapInArrow(batches, docs.schema)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(read(spark, sf_dir, "documents"))
