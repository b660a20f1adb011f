"""Secrets in texts: keyword automaton, anchored patterns near its hits, checksums.

One Aho-Corasick automaton over the lower-cased text (A-Z only, so positions stay)
holds the keywords of every kind and all three-digit hexadecimal strings, since a long
hexadecimal run starts with one. A regular expression is tried only at the places that
the automaton names, anchored there. Kinds whose secrets carry a checksum are reported
only if it is right.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import map_arrow, slices, table, texts, whole_text

# The three base kinds.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
# Kinds with a checksum inside.
GITHUB = re.compile(r"gh[opusr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
CARD = re.compile(r"[0-9](?:[ -]?[0-9]){11,18}(?![0-9])")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Z0-9])")
KINDS = ("assign", "access", "hex", "github", "card", "iban")
BASE = KINDS[:3]
CARD_WORDS = ("card", "visa", "mastercard", "amex", "karte", "carte", "tarjeta")
REACH = 40  # characters after a card or account keyword in which a number may start
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0 and len(set(digits)) > 1


def iban(text: str) -> bool:
    """The remainder modulo 97 of the rearranged account number is one."""
    account = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def github(body: str, check: str) -> bool:
    """The last six characters are the CRC-32 of the body in base 62."""
    value = 0
    for c in check:
        value = value * 62 + BASE62.index(c)
    return value == zlib.crc32(body.encode())


def automaton() -> ahocorasick.Automaton:
    """Keyword -> (kind, length); a keyword belongs to one kind."""
    words = ahocorasick.Automaton()
    for digits in itertools.product("0123456789abcdef", repeat=3):
        words.add_word("".join(digits), ("hex", 3))
    for word in ASSIGN_WORDS:
        words.add_word(word, ("assign", len(word)))
    words.add_word("akia", ("access", 4))
    for letter in "opusr":
        words.add_word(f"gh{letter}_", ("github", 4))
    for word in CARD_WORDS:
        words.add_word(word, ("card", len(word)))
    words.add_word("iban", ("iban", 4))
    words.make_automaton()
    return words


def find(text: str, words: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) in code points, by start and then by kind."""
    lower = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    done = dict.fromkeys(KINDS, 0)
    found = []
    for last, (kind, n) in words.iter(lower):
        start = last - n + 1
        if kind in ("card", "iban"):
            _numbers(text, last + 1, kind, done, found)
            continue
        if start < done[kind]:
            continue
        if kind == "hex":
            match = HEX.match(text, start)
            keep = match and match.end() - start >= 24
        elif kind == "assign":
            match = ASSIGN.match(text, start)
            keep = match and match.end(1) - match.start(1) >= 6
        elif kind == "access":
            match = ACCESS.match(text, start)
            keep = match and match.end() - start >= 20
        else:
            match = GITHUB.match(text, start)
            keep = match and github(match[1], match[2])
        if match:
            done[kind] = match.end()
        if keep:
            found.append((start, match.end(), kind))
    order = {kind: i for i, kind in enumerate(KINDS)}
    return sorted(found, key=lambda s: (s[0], order[s[2]], s[1]))


def _card_end(text: str, start: int, end: int) -> int:
    """End of the longest card number from `start`, zero without one.

    Digits may follow it, such as an expiry date, behind a space or hyphen.
    """
    while end > start:
        digits = re.sub("[ -]", "", text[start:end])
        if len(digits) < 12:
            return 0
        if luhn(digits):
            return end
        end = max(text.rfind(" ", start, end), text.rfind("-", start, end))
    return 0


def _numbers(text: str, after: int, kind: str, done: dict, found: list) -> None:
    """Card or account numbers that start within reach of a keyword."""
    pattern = CARD if kind == "card" else IBAN
    at = max(after, done[kind])
    while at < min(after + REACH, len(text)):
        match = pattern.match(text, at)
        if not match or (at and text[at - 1].isalnum()):
            at += 1
            continue
        if kind == "card":
            end = _card_end(text, at, match.end())
        else:
            end = match.end() if iban(match.group()) else 0
        if end:
            found.append((at, end, kind))
            done[kind] = at = end
        else:
            at += 1


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


RESULT = "doc_id long, spans array<struct<start:int,end:int,kind:string>>"


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of `docs`: its identifier and the spans found in the whole text.

    A null or empty text has no spans; repeated rows are judged one by one; an empty table
    gives no rows; other columns are not read. Spans of different kinds may overlap, those
    of one kind don't. Every row is judged alone, so there is no shuffle and no skew.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton()
        kind = pa.list_(
            pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
        )
        for batch in slices(batches, "text", 4 << 20):
            spans = [
                [{"start": s, "end": e, "kind": k} for s, e, k in find(x, words)]
                for x in texts(batch.column("text"))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(spans, kind)], names=["doc_id", "spans"]
            )

    rows = docs.selectExpr(f"cast(`{id_col}` as long) AS doc_id", f"`{text_col}` AS text")
    return map_arrow(rows.withColumn("text", whole_text("text")), run, RESULT)


def op4_secret_scan(spark, sf_dir):
    found = secret_spans(table(spark, sf_dir, "documents"))

    def written(spans):
        one = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
        return F.concat_ws(",", F.transform(spans, one))

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(written(of(*BASE)), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
