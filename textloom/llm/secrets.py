"""Operator 5: secrets in text, by fixed patterns and by token efficiency.

Three base kinds are matched by patterns: assignments, access keys and hexadecimal runs. The method adds strings that a
byte-pair vocabulary encodes badly: a run of RUN or more key characters with digits and letters whose characters per
token are under RATIO is random. Known digests (a run of a digest's length that is labelled as one), UUIDs and runs that
a base match covers are not reported again.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm._common import bounded_batches, load

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
STEMS = ("passw", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "random")

RUN = 20
RATIO = 2.2
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
UUID = re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}")
DIGEST_LABEL = re.compile(r"(?:md5|sha-?(?:1|224|256|384|512)|checksum|digest|integrity|etag|commit|revision|blake2[bs]?)\W{0,4}\Z", re.I)
DIGEST_LENGTHS = frozenset((32, 40, 56, 64, 96, 128))
_ENCODINGS: dict = {}


def vocabulary() -> str:
    """The default vocabulary file: the installed package of public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoding(path: str):
    """The byte-pair encoding of a rank file, loaded once in each worker."""
    if path not in _ENCODINGS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODINGS[path] = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base matches, leftmost and non-overlapping in each kind."""
    out = []
    low = text.lower()
    if any(s in low for s in STEMS):
        out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[0], x[2]))


def random_spans(text: str, base: list[tuple[int, int, int]], enc) -> list[tuple[int, int, int]]:
    """Runs that the vocabulary encodes at under RATIO characters a token, outside the base spans."""
    out = []
    for m in CANDIDATE.finditer(text):
        s, run = m.start(), m[0]
        if not (any(c.isdigit() for c in run) and any(c.isalpha() for c in run)):
            continue
        if any(a < m.end() and s < b for a, b, _ in base) or UUID.search(run):
            continue
        if len(run) in DIGEST_LENGTHS and not run.strip("0123456789abcdefABCDEF") and DIGEST_LABEL.search(text[max(0, s - 24) : s]):
            continue
        if len(run) < RATIO * len(enc.encode_ordinary(run)):
            out.append((s, m.end(), 3))
    return out



def scan(text: str | None, enc) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, added spans) in code points, ends exclusive. A null or empty text has none."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, random_spans(text, base, enc)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, found array<struct<kind, start, end, secret>>) of each row, by start. Null texts are empty and have none;
    null or repeated ids are kept as they are; an empty table gives no rows; other columns are ignored."""
    bounded_batches(docs.sparkSession)
    path = path or vocabulary()
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("secret", pa.string())]))

    def run(batches):
        enc = encoding(path)
        for batch in batches:
            found = []
            for x in batch.column(1):
                t = x.as_py()
                base, more = scan(t, enc)
                found.append([(KINDS[k], a, b, t[a:b]) for a, b, k in sorted(base + more, key=lambda s: (s[0], s[2]))])
            rows = [[{"kind": k, "start": a, "end": b, "secret": s} for k, a, b, s in f] for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], [id_col, "found"])

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, f"`{id_col}` long, found array<struct<kind: string, start: int, end: int, secret: string>>")


def op5_secrets(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(load(spark, sf_dir, "documents"))

    def n(kind):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")

    def spans(rows):
        return F.array_join(F.transform(rows, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    base = spans(F.filter("found", lambda x: x["kind"] != KINDS[3]))
    return found.select("doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"), F.sha2(base.cast("binary"), 256).alias("base_sha256"), spans(F.col("found")).alias("spans"))
