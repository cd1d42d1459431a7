"""Operator 5, personal data: expressions propose spans, checksums confirm them, context words move the score."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barpath.llm.common import batches, small_batches, table, texts

#: Kinds in the order of a digest. The first four are always kept when their own check holds.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?: ?[A-Z0-9]){11})")
_IBAN_RUN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_WORD = re.compile(r"[A-Za-z0-9]")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")

#: Characters of an IBAN by country. Of other countries any length from 15 to 34 is tried.
IBAN_LENGTHS = {c: n for n, codes in {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}.items() for c in codes.split()}

#: The start score of a kind (its checksum adds CHECKSUM), and words that raise or lower it when near.
START = {"email": 0.8, "ip": 0.6, "card": 0.5, "phone": 0.6, "iban": 0.4, "ssn": 0.4}
CHECKSUM = 0.4
RAISE = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "address", "host", "server"), "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax"), "iban": ("iban", "account", "bank", "transfer"), "ssn": ("ssn", "social", "security"),
}
LOWER = {"ip": ("version", "release"), "card": ("order", "isbn", "serial"), "phone": (), "email": (), "iban": ("serial",), "ssn": ("order", "part", "isbn")}
NEAR = 40
STEP = 0.2
LEAST = 0.6


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(x), 10)) for x in even)) % 10 == 0


def mod97(code: str) -> bool:
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Spans that end at a word's end, of the country's length and else the longest, where mod 97 holds."""
    end = 0
    for head in _IBAN_HEAD.finditer(text):
        if head.start() < end:
            continue
        run = _IBAN_RUN.match(text, head.start())
        length = IBAN_LENGTHS.get(head[0][:2])
        for stop in range(run.end(), head.end(), -1):
            code = text[head.start() : stop].replace(" ", "")
            if text[stop - 1] == " " or _WORD.match(text, stop) or not 15 <= len(code) <= 34 or length not in (None, len(code)):
                continue
            if mod97(code):
                end = stop
                yield head.start(), stop
                break


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def spans(text: str) -> list[tuple[str, int, int, float]]:
    """``(kind, start, end, score)`` by kind and start, in code points; extra kinds only from a score of ``LEAST``."""
    out = [("email", a, b, START["email"]) for a, b in _emails(text)]
    out += [("ip", m.start(), m.end(), START["ip"]) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if 13 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end(), START["card"] + CHECKSUM))
    out += [("phone", m.start(), m.end(), START["phone"]) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    out += [("iban", a, b, START["iban"] + CHECKSUM) for a, b in _ibans(text)]
    for m in _SSN.finditer(text):
        if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
            out.append(("ssn", m.start(), m.end(), START["ssn"]))
    scored = []
    for kind, a, b, score in out:
        near = set(re.findall(r"[a-z]+", f"{text[max(0, a - NEAR) : a]} {text[b : b + NEAR]}".lower()))
        score += STEP * (any(w in near for w in RAISE[kind]) - any(w in near for w in LOWER[kind]))
        if kind in BASE or score >= LEAST:
            scored.append((kind, a, b, round(min(1.0, max(0.0, score)), 2)))
    return scored


def redacted(text: str, found: list[tuple[str, int, int, float]]) -> str:
    """``text`` with every span replaced by its kind in angle brackets; overlapping spans become one."""
    out, at = [], 0
    for kind, a, b, _ in sorted(found, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))


def find_pii(docs: DataFrame, text: str = "text", redact: bool = False) -> DataFrame:
    """All columns of ``docs`` and ``pii_spans`` (kind, start, end, score), ordered by kind and start.

    With ``redact`` the text column holds the redacted text (null stays null). Null and empty texts have no spans.
    Every row is worked on by itself, whole: no shuffle, repeated rows and nulls elsewhere pass through unchanged. A
    column that is already named ``pii_spans`` is replaced.
    """
    small_batches(docs.sparkSession)
    keep = [f for f in docs.schema.fields if f.name != "pii_spans"]
    schema = T.StructType([*keep, T.StructField("pii_spans", SPAN)])
    names = [f.name for f in keep]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            found = [spans(t) for t in texts(batch, text)]
            columns = {n: batch.column(n) for n in names}
            if redact:
                old = batch.column(text)
                columns[text] = pa.array([redacted(t, s) if s else t for t, s in zip(old.to_pylist(), found, strict=True)], old.type)
            struct = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
            columns["pii_spans"] = pa.array([[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in f] for f in found], pa.list_(struct))
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select(*names).mapInArrow(run, schema)


def digest(found: DataFrame) -> DataFrame:
    """The counts and digests of the base kinds from ``pii_spans``."""
    joined = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("pii_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("pii_spans", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *(count(k) for k in BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("pii_spans")).alias("spans"))


def op5_pii(spark, sf_dir: str) -> DataFrame:
    return digest(find_pii(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"))
