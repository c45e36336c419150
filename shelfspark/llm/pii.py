"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, `://`, plus signs, digits and
identifier cues.  At each anchor a small deterministic parser expands to the left and right
and validates the result.  Anchors inside what a parser has already consumed are skipped, so
the pass is linear.

The base kinds equal the leftmost non-overlapping matches of these patterns, failing ones
dropped: email; ip (parts at most 255); card (13 to 19 digits passing Luhn); phone (9 to 15
digits).  Added kinds: `iban` (mod 97), `account` (a cue word, then 6 to 20 digits) and `url`
(an address that carries a user name before its host).

Offsets are code points, end exclusive.  Cases: a null or empty text has no spans; repeated
rows are each searched; long texts are searched whole; extra columns stay, clashing names
get an underscore.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfspark.llm.common import add_columns, fresh

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "account", "url")
# Fixed cue words; each is searched in lower case, upper case and capitalised.
CUES = ("iban", "account number", "account no", "acct", "kontonummer", "passport no", "ssn")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{2,4}){3,8}(?![A-Za-z0-9])")
_AFTER_CUE = re.compile(r"[ .:#=-]{0,4}")
_ACCOUNT = re.compile(r"[0-9](?:[ -]?[0-9]){5,19}(?![0-9])")
_USER_HOST = re.compile(r"[A-Za-z0-9._~%!$&'*+,;=-]+(?::[^\s@/]*)?@[A-Za-z0-9.-]+(?::[0-9]+)?[^\s<>\"]*")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 if value > 4 else value * 2
        total += value
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    compact = text.replace(" ", "")
    moved = compact[4:] + compact[:4]
    return 15 <= len(compact) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word in "@+0123456789":
        found.add_word(word, (word if word in "@+" else "digit", 1))
    found.add_word("://", ("scheme", 3))
    for cue in CUES:
        for form in (cue, cue.upper(), cue.capitalize()):
            found.add_word(form, ("cue", len(form)))
    found.make_automaton()
    return found


def find(text: str, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end), by kind in the order of KINDS, then by start."""
    spans: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    mail_end = dotted_end = card_end = 0
    for last, (what, size) in anchors.iter(text):
        at = last - size + 1
        if what == "digit":
            if at >= dotted_end:
                match = _DOTTED.match(text, at)
                dotted_end = match.end()
                parts, start = match.group().split("."), at
                for low in range(0, len(parts) - 3, 4):
                    four = parts[low:low + 4]
                    end = start + sum(map(len, four)) + 3
                    if all(map(_small, four)):
                        spans["ip"].append((start, end))
                    start = end + 1
            if at >= card_end:
                match = _CARD.match(text, at)
                card_end = match.end() if match else at + 1
                if match and 13 <= len(digits := _digits(match.group())) <= 19 and luhn(digits):
                    spans["card"].append(match.span())
        elif what == "@":
            start = at
            while start > mail_end and text[start - 1] in _LOCAL:
                start -= 1
            match = _DOMAIN.match(text, at + 1) if start < at else None
            if match:
                mail_end = match.end()
                spans["email"].append((start, mail_end))
        elif what == "+":
            match = _PHONE.match(text, at)
            if match and 9 <= len(_digits(match.group())) <= 15:
                spans["phone"].append(match.span())
        elif what == "scheme":
            start = at
            while start > 0 and text[start - 1] in _SCHEME:
                start -= 1
            match = _USER_HOST.match(text, last + 1) if start < at else None
            if match:
                spans["url"].append((start, match.end()))
        else:
            begin = _AFTER_CUE.match(text, last + 1).end()
            match = _IBAN.match(text, begin)
            if match and iban_valid(match.group()):
                spans["iban"].append(match.span())
            else:
                match = _ACCOUNT.match(text, begin)
                if match:
                    spans["account"].append(match.span())
    return [(kind, start, end) for kind in KINDS for start, end in sorted(set(spans[kind]))]


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def mark(docs: DataFrame, text: str = "text") -> tuple[DataFrame, list[str]]:
    """`docs` with a count per base kind, the base digest and all spans; and those names."""
    names = fresh(docs.columns, *(f"n_{kind}" for kind in BASE_KINDS), "base_sha256", "spans")

    def start():
        anchors = automaton()

        def work(texts):
            out = {name: [] for name in names}
            for value in texts:
                spans = find(value, anchors) if value else []
                base = [span for span in spans if span[0] in BASE_KINDS]
                for name, kind in zip(names, BASE_KINDS):
                    out[name].append(sum(span[0] == kind for span in base))
                out[names[4]].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                out[names[5]].append(_joined(spans))
            return out
        return work

    kinds = [T.LongType()] * 4 + [T.StringType()] * 2
    return add_columns(docs, text, list(zip(names, kinds)), start), names


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    marked, _ = mark(docs.select(key, text), text)
    return marked.drop(text)


def redact(text: str | None, spans: str) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans merge."""
    if not text or not spans:
        return text
    out, done = [], 0
    for start, end, kind in sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans.split(","))):
        if start >= done:
            out += [text[done:start], f"[{kind}]"]
        done = max(done, end)
    return "".join(out) + text[done:]
