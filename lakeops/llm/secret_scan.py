"""Secret scan over an incremental ledger of contents."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.ledger import content_digest, extend

# The three base kinds and their patterns, in the order in which spans of one start are listed.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
# Kinds of our own, listed after the base ones.
PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----")
JWT = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*")

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "pem", "jwt")
#: Goes up with every change of a rule: contents scanned under another version are scanned again.
RULES_VERSION = "rules-1"
_WORDS = ("passw", "secret", "token", "api")

FINDING = "struct<kind:string,start:bigint,stop:bigint>"
LEDGER = f"digest binary, version string, findings array<{FINDING}>"


def find(text: str) -> list[tuple[str, int, int]]:
    """All findings of one text as (kind, start, stop) in code points, by start and then kind."""
    spans: list[tuple[str, int, int]] = []
    lower = text.lower()
    if any(word in lower for word in _WORDS):
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    if "-----BEGIN" in text:
        spans += [("pem", m.start(), m.end()) for m in PEM.finditer(text)]
    if "eyJ" in text:
        spans += [("jwt", m.start(), m.end()) for m in JWT.finditer(text)]
    return sorted(spans, key=lambda span: (span[1], KINDS.index(span[0])))


def _scan(version: str):
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [dict(zip(("kind", "start", "stop"), span, strict=True)) for span in find(value.as_py() or "")]
                for value in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([version] * len(batch)), pa.array(found, pa.list_(kind))],
                names=["digest", "version", "findings"],
            )

    return scan


def scan_ledger(versions: DataFrame, ledger: str, text: str = "text", rules: str = RULES_VERSION) -> DataFrame:
    """Findings of every historical version in ``versions``, with all its columns and ``findings``.

    Each row is one version of one path; its text is addressed by content. Only contents not yet scanned under
    ``rules`` are scanned, each once, and the ledger at ``ledger`` (a folder all executors reach) grows by their
    findings, also where there are none. Findings are then joined back to every path that holds the content.
    Null and empty texts have no findings, repeated rows keep their number, an empty table gives an empty result.
    A column ``findings`` or ``digest`` of the caller would clash and is refused.
    """
    taken = {"findings", "digest"} & set(versions.columns)
    if taken:
        raise ValueError(f"columns in use: {sorted(taken)}")
    addressed = versions.withColumn("digest", content_digest(F.col(text)))
    found = extend(
        addressed.select("digest", F.coalesce(F.col(text), F.lit("")).alias("text")),
        ledger,
        LEDGER,
        rules,
        lambda rows: rows.mapInArrow(_scan(rules), LEDGER),
    )
    return addressed.drop(text).join(found.select("digest", "findings"), "digest", "left").drop("digest")


def span_list(findings: Column) -> Column:
    """``kind:start:stop`` of every finding, joined by commas."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["stop"])), ",")


def scan_report(docs: DataFrame, ledger: str) -> DataFrame:
    """Per document the number of findings of each base kind, a digest of the base spans and all spans."""
    found = scan_ledger(docs.select("doc_id", "text"), ledger)
    base = F.filter("findings", lambda f: f["kind"].isin(*BASE_KINDS))

    def number(kind: str) -> Column:
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(number, BASE_KINDS),
        F.sha2(span_list(base), 256).alias("base_sha256"),
        span_list(F.col("findings")).alias("spans"),
    )
