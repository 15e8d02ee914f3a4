"""Secret scans: three patterns, and a token-efficiency test for random strings.

Ordinary words and names take few tokens of a byte-pair vocabulary; random strings take many. A string of ``SHORTEST`` or more
letters, digits and joining signs is a secret when it has fewer than ``RATIO`` characters a token (a little fewer below ``LONG``
characters), after known forms are excluded: digests (hexadecimal text of a usual digest length), UUIDs, time stamps, and names whose parts
are all numbers or plain words, which are of one case or change it every ``HUMP`` letters or more on average. So random strings of one
case without a digit are not seen; the README has the measured misses.

Whole texts are scanned row by row in Arrow batches: a row needs nothing but itself, so there is no shuffle. Spans count code points,
with exclusive ends.

Defined cases: a null text is an empty one and has no span; repeated rows are scanned one by one; other columns are kept, but for those
called like an added one. Time grows with the length of a text and the number of its spans, not with their product; one text of any length
is held by one task. Spans with one start come in the order of ``KINDS``; a run that overlaps a base span is part of that one.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The patterns of the base kinds, in the order that spans with one start take.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MARK = "[REDACTED]"
KINDS = ("assign", "access", "hex", "random")

RATIO = 2.2
SHORTEST, LONG = 12, 20
SLACK = 0.15  # off the ratio at the shortest, as one token more or less counts for more there
HUMP = 3
_assign = re.compile(ASSIGN, re.ASCII | re.IGNORECASE)
_access = re.compile(ACCESS)
_hex = re.compile(HEX[:-1] + "{16,}")  # a run of 16 signs or more starts where the run starts: the same matches
_run = re.compile(rf"[A-Za-z0-9+/_=-]{{{SHORTEST},}}")
_uuid = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_digest = re.compile(r"(sha\d*-|md5-|0x)?([0-9a-f]+|[0-9A-F]+)")
_digest_sizes = {32, 40, 48, 56, 64, 96, 128}
_stamp = re.compile(r"\d{4}-?\d\d-?\d\d[T_-]?[\d-]*Z?")
_plain_part = re.compile(r"[A-Z]?[a-z]+(?:[A-Z][a-z]+)*|[A-Z]+|\d+|[A-Za-z]?\d{1,4}|[a-z]+\d{1,4}")
_parts = re.compile(r"[-+/_=]+")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the three base kinds."""
    found = []
    low = text.lower()
    if any(word in low for word in ("password", "passwd", "secret", "token", "apikey", "api_key")):
        found += [(m.start(), 0, m.end()) for m in _assign.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _access.finditer(text) if len(m[0]) >= 18]
    return found + [(m.start(), 2, m.end()) for m in _hex.finditer(text)]


def known_form(run: str) -> bool:
    """A digest, an identifier or a name: no secret, however many tokens it takes."""
    digest = _digest.fullmatch(run)
    if digest and len(digest[2]) in _digest_sizes:
        return True
    if run.isdigit() or _uuid.fullmatch(run) or _stamp.fullmatch(run):
        return True
    return all(_plain_part.fullmatch(p) and _regular(p) for p in _parts.split(run) if p)


def _regular(part: str) -> bool:
    """Whether the capitals inside a plain part are few enough to start words."""
    return part.isupper() or len(part) >= HUMP * sum(c.isupper() for c in part[1:])


def least_ratio(size: int, ratio: float = RATIO) -> float:
    """Characters a token below which a run of ``size`` is random."""
    return ratio - SLACK * max(0, LONG - size) / (LONG - SHORTEST)


@cache
def _encoding(path: str):
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("secrets", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_spans(text: str, base: list[tuple[int, int, int]], vocabulary: str, ratio: float = RATIO) -> list[tuple[int, int, int]]:
    """Runs with fewer characters a token than ``least_ratio`` that are of no known form and outside the base spans."""
    found = []
    taken = iter(sorted((s, e) for s, _, e in base))
    first, last = next(taken, (len(text), len(text)))
    for m in _run.finditer(text):
        run = m[0]
        covered = False
        while first < m.end() and not covered:  # base spans by start: each is passed once
            covered = m.start() < last
            if not covered:
                first, last = next(taken, (len(text), len(text)))
        if covered or known_form(run):
            continue
        if len(run) < least_ratio(len(run), ratio) * len(_encoding(vocabulary).encode_ordinary(run)):
            found.append((m.start(), 3, m.end()))
    return found


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def secret_spans(docs: DataFrame, text: str = "text", vocabulary: str | None = None, ratio: float = RATIO, marked: str | None = None, mark: str = MARK) -> DataFrame:
    """``docs`` (columns kept) with ``spans``, an array of (kind, start, end) by start, then kind.

    ``marked`` names one more column: the text with every span replaced by ``mark``, null where there is no span. The same scan makes it,
    as a Python function behind it would take a second worker for each task.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = vocabulary or vocabulary_path()
        for batch in batches:
            kinds, starts, ends, upto, clean = [], [], [], [0], []
            for t in batch.column(text):
                t = t.as_py() or ""
                base = base_spans(t)
                found = sorted(base + random_spans(t, base, path, ratio))
                if marked:
                    clean.append(_cut(t, [(s, e) for s, _, e in found], mark) if found else None)
                for s, k, e in found:
                    kinds.append(KINDS[k])
                    starts.append(s)
                    ends.append(e)
                upto.append(len(kinds))
            spans = pa.StructArray.from_arrays(
                [pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], names=["kind", "start", "end"]
            )
            lists = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), spans)
            more = {"spans": lists} | ({marked: pa.array(clean, pa.string())} if marked else {})
            yield pa.record_batch([*batch.columns, *more.values()], names=[*batch.schema.names, *more])

    kept = docs.drop("spans", *([marked] if marked else []))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(scan, f"{kinds}, spans array<struct<kind:string,start:long,end:long>>" + (f", `{marked}` string" if marked else ""))


def _cut(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    out, at = [], 0
    for start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redacted(text: Column, spans: Column, mark: str = MARK) -> Column:
    """The text with every span replaced by the mark; spans that overlap are replaced once. Only texts with spans leave the JVM."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        return pa.array([_cut(t.as_py(), [(x["start"], x["end"]) for x in s.as_py()], mark) if t.is_valid else None for t, s in zip(texts, found, strict=True)], pa.string())

    hit = F.size(spans) > 0
    return F.when(hit, cut(F.when(hit, text), F.when(hit, spans))).otherwise(text)


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x.kind == kind)).cast("long")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")


def op9_secrets(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    base = F.filter("spans", lambda x: x.kind != "random")
    return secret_spans(docs).select(
        "doc_id",
        *[counted(F.col("spans"), kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
