"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, address schemes and identifier cues.  Each anchor is
expanded by a small local parser that knows one kind's shape and checks it (octets, Luhn, IBAN remainder, digit counts).  Positions are
code points, ends exclusive.

Base kinds: email, ip, card, phone.  Added by the method: url_login (user:password in an address), iban, ssn, secret (value of a
password or key cue, or a cloud key id).

Defined cases: a null text is empty; null ids stay; repeated rows are scanned one by one; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("url_login", "iban", "ssn", "secret")
_DIGITS = frozenset("0123456789")
_ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
_LOCAL, _LABEL = _ALNUM | frozenset("._%+-"), _ALNUM | frozenset("-")
_DIAL = _DIGITS | frozenset(" ().-")
_TOKEN = _ALNUM | frozenset("_-+/=.!@#$%^&*")
_CUES = ("password=", "password:", "passwd=", "secret=", "api_key=", "apikey=", "token=", "pwd=")


def _anchors() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for d in "0123456789":
        a.add_word(d, "d")
    for word, kind in (("@", "@"), ("+", "+"), ("://", "s"), ("AKIA", "k"), *((c, "c") for c in _CUES)):
        a.add_word(word, kind)
    a.make_automaton()
    return a


def _run(text: str, at: int, of: frozenset[str], most: int | None = None) -> int:
    """The end of the run of such characters from `at` on, looking at no more than `most`."""
    n = len(text) if most is None else min(len(text), at + most)
    while at < n and text[at] in of:
        at += 1
    return at


def _octet(digits: str) -> bool:
    plain = digits.lstrip("0")
    return len(plain) < 3 or (len(plain) == 3 and int(plain) <= 255)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the at-sign, not reaching below floor."""
    begin = at
    while begin > floor and text[begin - 1] in _LOCAL:
        begin -= 1
    end = _run(text, at + 1, _LABEL)
    if begin == at or end == at + 1:
        return None
    dots = 0
    while end + 1 < len(text) and text[end] == "." and text[end + 1] in _LABEL:
        end, dots = _run(text, end + 1, _LABEL), dots + 1
    return (begin, end) if dots else None


def _digit_chain(text: str, at: int, between: frozenset[str]) -> list[tuple[int, int]]:
    """Runs of digits from at on, each after one character of between."""
    runs = []
    while True:
        end = _run(text, at, _DIGITS)
        runs.append((at, end))
        if end + 1 < len(text) and text[end] in between and text[end + 1] in _DIGITS:
            at = end + 1
        else:
            return runs


_DOT, _GAP = frozenset("."), frozenset(" -")


def _iban(text: str, at: int) -> tuple[int, int] | None:
    """Two capitals before two check digits at `at`, 15 to 34 characters, remainder 1 modulo 97."""
    begin = at - 2
    if begin < 0 or not all("A" <= c <= "Z" for c in text[begin:at]) or (begin and text[begin - 1] in _ALNUM):
        return None
    end, packed = begin, ""
    while end < len(text) and len(packed) < 34:
        if text[end] in _ALNUM:
            packed += text[end]
            end += 1
        elif text[end] == " " and end + 1 < len(text) and text[end + 1] in _ALNUM and len(packed) % 4 == 0:
            end += 1
        else:
            break
    good = 15 <= len(packed) <= 34 and packed[2:4].isdigit() and packed.isupper() and int("".join(str(int(c, 36)) for c in packed[4:] + packed[:4])) % 97 == 1
    return (begin, end) if good else None


def spans_of(text: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) of each finding, in order of start, then of kind. Each parser reads a run of its characters once, however many anchors are in it, so the time is linear in the text."""
    found: list[tuple[int, int, str]] = []
    email_to = ip_to = card_to = phone_to = free_to = token_to = 0
    for last, kind in automaton.iter(text):
        if kind == "d":
            if last >= ip_to:
                runs = _digit_chain(text, last, _DOT)
                ip_to = runs[-1][1]
                for i in range(0, len(runs) - 3, 4):
                    four = runs[i : i + 4]
                    if all(_octet(text[a:b]) for a, b in four):
                        found.append((four[0][0], four[3][1], "ip"))
                if (span := _iban(text, last)) and span[0] >= free_to:
                    found.append((*span, "iban"))
                    free_to = span[1]
            if last >= card_to:
                runs = _digit_chain(text, last, _GAP)
                card_to = runs[-1][1]
                n = sum(b - a for a, b in runs)
                if 14 <= n <= 19 and _luhn("".join(text[a:b] for a, b in runs)):
                    found.append((runs[0][0], card_to, "card"))
                elif [b - a for a, b in runs] == [3, 2, 4] and text[runs[0][1]] == text[runs[1][1]] == "-" and last >= free_to:
                    found.append((last, card_to, "ssn"))
        elif kind == "@":
            if span := _email(text, last, email_to):
                found.append((*span, "email"))
                email_to = span[1]
        elif kind == "+":
            if last >= phone_to and last + 1 < len(text) and text[last + 1] in _DIGITS:
                end = _run(text, last + 2, _DIAL)
                while end > last + 2 and text[end - 1] not in _DIGITS:
                    end -= 1
                if end > last + 3:
                    phone_to = end
                    if 10 <= sum(c in _DIGITS for c in text[last:end]) <= 15:
                        found.append((last, end, "phone"))
        elif kind == "s":
            end = last + 1
            while end < len(text) and not text[end].isspace() and text[end] not in "/?#@\"'<>":
                end += 1
            if end < len(text) and text[end] == "@" and ":" in text[last + 1 : end] and last + 1 >= free_to:
                found.append((last + 1, end, "url_login"))
                free_to = end
        elif kind == "c":
            if last + 1 >= free_to:
                if last + 1 >= token_to:
                    token_to = _run(text, last + 1, _TOKEN)
                if token_to - last > 6:
                    found.append((last + 1, token_to, "secret"))
                    free_to = token_to
        elif last - 3 >= free_to and (end := _run(text, last + 1, _ALNUM, 17)) - last == 17:
            found.append((last - 3, end, "secret"))
            free_to = end
    order = {k: i for i, k in enumerate(KINDS + MORE_KINDS)}
    return sorted(found, key=lambda s: (s[0], order[s[2]], s[1]))


def _listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every document."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, nothing = _anchors(), hashlib.sha256(b"").hexdigest()
        for batch in batches:
            texts, counts, digests, listed = batch.column(1), [], [], []
            for i in range(0, len(texts), 256):
                for text in texts.slice(i, 256).to_pylist():
                    spans = spans_of(text, automaton) if text else []
                    base = [s for s in spans if s[2] in KINDS] if spans else spans
                    counts.append([sum(s[2] == k for s in base) for k in KINDS] if base else [0] * 4)
                    digests.append(hashlib.sha256(_listed(base).encode()).hexdigest() if base else nothing)
                    listed.append(_listed(spans))
            columns = [batch.column(0), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(4)), pa.array(digests, pa.string()), pa.array(listed, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(docs: DataFrame) -> DataFrame:
    """The documents with each finding replaced by its kind in brackets; overlapping findings become one, named by the first; n_chars, where there is such a column, follows the new text."""
    names = docs.columns
    at = names.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _anchors()
        for batch in batches:
            new: list[str | None] = []
            for i in range(0, batch.num_rows, 256):
                for text in batch.column(at).slice(i, 256).to_pylist():
                    out, to = [], 0
                    spans = spans_of(text, automaton) if text else []
                    for a, b, kind in spans:
                        if a >= to:
                            out += [text[to:a], f"[{kind.upper()}]"]
                        to = max(to, b)
                    new.append("".join([*out, text[to:]]) if spans else text)
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            if "n_chars" in names and pa.types.is_integer(batch.schema.field("n_chars").type):
                j = names.index("n_chars")
                columns[j] = pa.array([n if t is None else len(t) for t, n in zip(new, columns[j].to_pylist(), strict=True)], columns[j].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(scan, docs.schema)
