"""Secret scan: keyword automaton, anchored patterns at its hits, checksums inside tokens."""

from __future__ import annotations

import base64
import json
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from evstream.llm.common import query, table, without

# Kinds in report order, and the patterns of the base kinds.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm", "jwt")
ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
          r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
GITHUB = r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"
NPM = r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"
JWT = r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]{16,})"
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
# Lower-case keywords of the automaton and the kind each leads to.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign",
    "apikey": "assign", "api_key": "assign", "akia": "access",
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
    "npm_": "npm", "eyj": "jwt",
}
SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType())]))


def checksum62(body: str) -> str:
    """Six base-62 digits of the CRC-32 of a token's random part."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = BASE62[digit] + out
    return out


def _claims(part: str):
    try:
        return json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except ValueError:
        return None


def _holds(kind: str, m: re.Match) -> bool:
    """Whether an anchored match counts: its length, or the check that the token itself carries."""
    if kind == "assign":
        return len(m[2]) >= 6
    if kind == "access":
        return len(m[0]) >= 20
    if kind == "jwt":
        head = _claims(m[1])
        return isinstance(head, dict) and "alg" in head and isinstance(_claims(m[2]), dict)
    return checksum62(m[1]) == m[2]


def scanner():
    """A function from text to its spans ``(start, kind number, end)``, in order."""
    import ahocorasick

    auto = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        auto.add_word(word, (len(word), kind))
    auto.make_automaton()
    patterns = {"assign": re.compile(ASSIGN), "access": re.compile(ACCESS), "github": re.compile(GITHUB),
                "npm": re.compile(NPM), "jwt": re.compile(JWT)}
    runs, number = re.compile(HEX), {k: i for i, k in enumerate(KINDS)}
    ascii_lower = {i: i + 32 for i in range(65, 91)}

    def scan(text: str | None) -> list[tuple[int, int, int]]:
        if not text:
            return []
        low = text.lower()
        if len(low) != len(text):  # some letters change their length; offsets must not
            low = text.translate(ascii_lower)
        # A run of hex digits has no literal keyword: its own pattern is the anchor.
        found = [(m.start(), number["hex"], m.end()) for m in runs.finditer(text)]
        ends: dict[str, int] = {}
        for last, (length, kind) in auto.iter(low):
            start = last - length + 1
            if start < ends.get(kind, 0):
                continue
            m = patterns[kind].match(text, start)
            if m:
                ends[kind] = m.end()  # a failing match still uses up its text
                if _holds(kind, m):
                    found.append((start, number[kind], m.end()))
        return sorted(found)

    return scan


def masked(text: str | None, spans, mask: str = "[SECRET]") -> str | None:
    """The text with every span, overlapping ones as one, replaced by ``mask``."""
    if not spans:
        return text
    out, at, stop = [], 0, -1
    for start, _, end in sorted(spans):
        if start > stop:
            out += [text[at:start], mask]
        stop = max(stop, end)
        at = stop
    return "".join(out) + text[at:]


def find_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ``spans`` (kind, start, end; code points, end exclusive).

    NULL and empty texts have no spans; repeated rows are scanned each; a column already named
    ``spans`` is replaced. Rows are independent, so nothing is shuffled.
    """
    docs = without(docs, "spans")
    schema = T.StructType([*docs.schema.fields, T.StructField("spans", SPANS)])

    def run(batches):
        scan = scanner()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            rows = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scan(t)]
                    for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, kind)], [*b.schema.names, "spans"])

    return docs.mapInArrow(run, schema)


def mask_secrets(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret in ``text`` replaced; ``n_chars``, if there, counts the new text.

    Same rows and columns as before; texts without secrets, NULL and empty ones stay as they are.
    """

    def run(batches):
        scan = scanner()
        for b in batches:
            old = b.column("text").to_pylist()
            new = [masked(t, scan(t), mask) for t in old]
            columns = dict(zip(b.schema.names, b.columns, strict=True))
            columns["text"] = pa.array(new, b.schema.field("text").type)
            if "n_chars" in columns:
                was = columns["n_chars"].to_pylist()
                columns["n_chars"] = pa.array(
                    [w if n == o else len(n) for w, n, o in zip(was, new, old, strict=True)],
                    b.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), b.schema.names)

    return docs.mapInArrow(run, docs.schema)


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op2_secret_scan")
def op2_secret_scan(spark, folder):
    found = find_secrets(table(spark, folder, "documents").select("doc_id", "text")).drop("text")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *[count(k) for k in BASE_KINDS],
                        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"))
