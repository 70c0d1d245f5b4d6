"""Secret scans (operator 9): an Aho-Corasick pass over the whole text finds
keywords, anchored regular expressions run only at the hits, and formats that
carry a checksum or an encoded header are kept only if it holds.

Kinds, in order.  ``assign``, ``access`` and ``hex`` follow the base rules
(leftmost, non-overlapping per kind, then the length test).  The others are
added by the method: ``github`` and ``npm`` tokens end in the base-62 CRC-32
of their body, ``jwt`` headers must decode to JSON with an ``alg``, ``pem``
blocks must hold decodable base64; ``slack``, ``google`` and ``stripe`` keys
have fixed prefixes and lengths but no public checksum.

Defined results: a null or empty text has no span; a null ``doc_id`` stays
null; repeated rows are each scanned; very long texts are scanned whole, in
time that grows with their length; other columns are not read.  Positions
are code points, end exclusive."""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_or_null

KINDS = ("assign", "access", "hex", "github", "npm", "slack", "google", "stripe", "jwt", "pem")
BASE_KINDS = KINDS[:3]

# keyword (lower case) -> (kind, pattern matched at the keyword's start)
_ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
           r"([A-Za-z0-9+/_.=-]+)")
ANCHORED = {
    "assign": (("password", "passwd", "secret", "token", "apikey", "api_key"), _ASSIGN),
    "access": (("akia",), r"AKIA[A-Z0-9]+"),
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "npm": (("npm_",), r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "slack": (("xox",), r"xox[abprs]-[0-9]{6,}-[0-9A-Za-z-]{10,}"),
    "google": (("aiza",), r"AIza[0-9A-Za-z_-]{35}(?![0-9A-Za-z_-])"),
    "stripe": (("sk_live_", "rk_live_", "sk_test_", "rk_test_"), r"[sr]k_(?:live|test)_[0-9A-Za-z]{16,}"),
    "jwt": (("eyj",), r"(eyJ[A-Za-z0-9_-]{6,})\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    "pem": (("-----begin ",), r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----"),
}
_HEX = r"[0-9a-f]{24,}"
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _crc62(body: str) -> str:
    import zlib
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = _BASE62[d] + out
    return out


def _is_jwt_header(part: str) -> bool:
    import base64
    import json
    try:
        head = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except ValueError:
        return False
    return isinstance(head, dict) and "alg" in head


class _Pem:
    """Ends of PEM blocks of one text.  END marks are found once, and a body
    that holds another BEGIN mark is no base64, so no text is decoded twice."""

    def __init__(self, text: str) -> None:
        self.text, self.ends = text, {}

    def end(self, end: int, label: str) -> int | None:
        """End of the block whose BEGIN mark ends at ``end``, if its body is
        base64."""
        import base64
        import binascii
        mark = f"-----END {label}-----"
        if label not in self.ends:
            self.ends[label] = [m.start() for m in re.finditer(re.escape(mark), self.text)]
        at = bisect.bisect_left(self.ends[label], end)
        if at == len(self.ends[label]):
            return None
        close = self.ends[label][at]
        # no line with a colon is body, but a mark within it is none either
        if self.text.find("-----BEGIN ", end, close) >= 0 and self._marked(end, close):
            return None
        body = "".join(line for line in self.text[end:close].split("\n") if ":" not in line)
        try:
            raw = base64.b64decode("".join(body.split()), validate=True)
        except (binascii.Error, ValueError):
            return None
        return close + len(mark) if raw else None

    def _marked(self, end: int, close: int) -> bool:
        """Whether the first BEGIN mark inside is on a line without a colon: its
        hyphens are then in the body."""
        at = self.text.find("-----BEGIN ", end, close)
        first, last = self.text.rfind("\n", end, at) + 1 or end, self.text.find("\n", at, close)
        return ":" not in self.text[first:last if last >= 0 else close]


class Scanner:
    """Built once per task; ``spans(text)`` gives (start, kind index, end)
    sorted."""

    def __init__(self) -> None:
        import ahocorasick
        self.auto = ahocorasick.Automaton()
        for kind, (words, pattern) in ANCHORED.items():
            at = (KINDS.index(kind), re.compile(pattern, re.ASCII))
            for w in words:
                self.auto.add_word(w, (len(w) - 1, *at))
        self.auto.make_automaton()
        self.hex = re.compile(_HEX)
        self.header = re.compile(r"[A-Za-z0-9_-]+", re.ASCII)
        self.second = re.compile(r"\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]", re.ASCII)

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        if not text:
            return []
        # bytes.lower() changes A-Z only, so positions stay the same
        low = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
        out = [(m.start(), 2, m.end()) for m in self.hex.finditer(text)]
        past = [0] * len(KINDS)
        hits = [(end - back, kind, pattern) for end, (back, kind, pattern) in self.auto.iter(low)]
        hits.sort(key=lambda h: h[0])
        pem, run = _Pem(text), 0
        for start, kind, pattern in hits:
            if start < past[kind] or kind == 8 and start < run:
                continue
            m = pattern.match(text, start)
            if m is None:
                if kind == 8 and text.startswith("eyJ", start):
                    # a run of header characters without a token after it:
                    # nothing that starts inside it can have one either
                    run = self.header.match(text, start).end()
                    if self.second.match(text, run):
                        run = start + 1
                continue
            end = m.end()
            past[kind] = end
            if kind == 0 and len(m.group(1)) < 6 or kind == 1 and end - start < 20:
                continue
            if kind in (3, 4) and _crc62(text[start + 4:end - 6]) != text[end - 6:end]:
                continue
            if kind == 8 and not _is_jwt_header(m.group(1)):
                continue
            if kind == 9:
                closed = pem.end(end, m.group(1))
                if closed is None:
                    continue
                end = past[kind] = closed
            out.append((start, kind, end))
        out.sort()
        return out


def named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redact(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    """Each union of overlapping spans becomes one ``mask``."""
    out, at, upto = [], 0, 0
    for s, _, e in spans:
        if s >= upto:
            out += [text[at:s], mask]
        at = upto = max(upto, e)
    return "".join([*out, text[at:]])


def _scan(batches):
    scanner = Scanner()
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        cols: list[list] = [[] for _ in range(5)]
        for t in texts:
            spans = scanner.spans(t.as_py())
            for k in range(3):
                cols[k].append(sum(x[1] == k for x in spans))
            cols[3].append(hashlib.sha256(named([x for x in spans if x[1] < 3]).encode()).hexdigest())
            cols[4].append(named(spans))
        yield pa.RecordBatch.from_arrays(
            [ids.cast(pa.int64()), *[pa.array(c, pa.int64()) for c in cols[:3]],
             *[pa.array(c, pa.string()) for c in cols[3:]]],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: counts per base kind, a digest of the base spans
    and all spans as text.  One pass, no shuffle."""
    return columns_or_null(docs, doc_id="long", text="string").mapInArrow(
        _scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact_secrets(docs: DataFrame, mask: str = "[REDACTED]") -> DataFrame:
    """The same rows and columns with every found span of ``text`` replaced
    by ``mask``; ``n_chars``, where there is one, follows the new text."""
    @F.pandas_udf("string")
    def clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner()
        for texts in parts:
            yield pd.Series([None if t is None else redact(t, scanner.spans(t), mask) for t in texts],
                            dtype=object)
    out = docs.withColumn("text", clean(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(kind))
    return out.select(*docs.columns)
