"""Secret scans by dictionary-primed compression.

1. A word count over all documents learns which identifiers the corpus uses: lower-case or
   capitalised words without digits, counted once per document.  The most frequent of them,
   after a fixed list of programming words, are the identifier dictionary, of bounded size.
2. Candidates are runs of token characters that change between digits, capitals and small letters as names do not, and that stand in a sensitive context: a cue such as `password`, `bearer` or `key` shortly before them.
3. A candidate's novelty is what it adds to a zstandard frame that is primed with the dictionary and
   holds the text around it: compressed size with it minus compressed size without it.  Other
   copies of the candidate are taken out of that text first, so a secret that is repeated still counts as new.
   Known words, paths, versions and repeated identifiers add few bytes; random characters add nearly one each.
4. Candidates that add at least `NOVEL` bytes a character are reported as kind `novel`, unless a base span covers them.

The base kinds equal the leftmost non-overlapping matches of three patterns, failing ones dropped:
assign (a cue word, `:` or `=`, and a value of at least 6 characters), access (`AKIA` and at least 16
capitals or digits) and hex (at least 24 lower-case hexadecimal digits).

Spans are whole matches in code points, end exclusive.  Cases: a null or empty text has no spans; repeated rows are
each searched, and count once each for the dictionary; long texts are searched whole, and a run of token characters
of any length is one candidate; an empty table, or one without words, leaves the fixed list; extra columns stay,
clashing names get an underscore.
"""

from __future__ import annotations

import hashlib
import re

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.llm.common import add_columns, fresh

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "novel")
# Identifiers that the corpus adds to the dictionary, most frequent ones.
DICTIONARY_WORDS = 2048
# Code points around a candidate that its frame holds, on each side, and how far before it a cue may stand.
AROUND, CUE_REACH = 512, 48
# Least bytes that a candidate must add per character, and altogether: random letters and digits add 0.6 to 1,
# names made of known words 0.3 to 0.6 (most are no candidates by their shape).
NOVEL, ADDED = 0.55, 8
LEAST = 12
LEVEL = 12

# Fixed patterns of the base kinds.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?((?-i:[A-Za-z0-9+/_.=-]+))""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
# Fixed cue words of a sensitive context.
_CUE = re.compile(
    r"passw|passphrase|pwd|secret|token|credential|bearer|authori[sz]ation|\bauth|api.?key|access.?key|private.?key|client.?(?:id|key)|"
    r"signing|signature|webhook|session|cookie|connection.?string|\bkey\b|\bpin\b|\bcvv\b|geheim|kennwort|passwort|contrase|clave|mot de passe|cl[eé]", re.IGNORECASE)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.~-]{%d,}" % LEAST)
_SEPARATED = re.compile(r"[._/=~-]+")
_DIGITS = re.compile("[0-9]+")
# A capital followed by small letters, as in a name, is no change.
_CHANGE = re.compile("[0-9](?=[A-Za-z+])|[A-Za-z+](?=[0-9])|[a-z](?=[A-Z])")
# Fixed programming words that prime every dictionary.
_WORDS = (
    "abstract address admin api application args array assert async authorization await bearer boolean boundary break buffer build bytes cache "
    "callback catch char class client close code column command commit common complete config connection const content context continue "
    "cookie count create credentials data database date debug default delete description dictionary directory double element else email "
    "encoding enum environment error event example exception execute export extends false field file filter final finally float "
    "folder format from function global group handler hash header headers host html http https identifier image implements import "
    "include index input insert instance integer interface internal invalid items java javascript json key label lambda length "
    "library license list local localhost location lock logger long main manager message method module name namespace native network "
    "node null number object offset operator option order output package page parameter parent parse password path pattern payload "
    "port prefix print private process product project property protected protocol public python query queue random range read "
    "record reference region register release remote request resource response result return root schema script search secret "
    "security select self send sequence server service session setting signature size source spark state static status stream "
    "string struct suffix super switch system table target task temp template test text thread throw timeout timestamp token "
    "abcdefghijklmnopqrstuvwxyz 01234567890 qwertyuiop asdfghjkl account bool build by cpu default gcc get gnu id image kind linux lib local "
    "provider push factory rsa sha256 sha512 service site src usr utf8 v1 v2 x64 x86 "
    "transaction true type undefined union unique update upload user username util value variable vector version void "
    "while window worker write www com org net github")


def corpus_words(docs: DataFrame, text: str = "text", words: int = DICTIONARY_WORDS) -> list[str]:
    """Identifiers by the number of documents that hold them, the most frequent last; ties by the word."""
    parts = F.array_distinct(F.split(F.col(f"`{text}`"), "[^A-Za-z]+"))
    found = docs.select(F.explode(parts).alias("word")).filter("word rlike '^[A-Za-z][a-z]{3,19}$'")
    counts = found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return [row.word for row in counts.orderBy(F.desc("n"), "word").limit(words).collect()][::-1]


def dictionary(words: list[str]) -> bytes:
    """Raw content for the compressor: the corpus words, then the fixed ones, nearest to the text."""
    return " ".join([*words, _WORDS]).encode()


class Novelty:
    """Marginal compressed size of strings in their surroundings, without regard to case."""

    def __init__(self, content: bytes, level: int = LEVEL):
        how = zstandard.ZstdCompressionParameters.from_level(
            level, min_match=3, write_content_size=False, write_checksum=False, write_dict_id=False)
        primed = zstandard.ZstdCompressionDict(content.lower(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(compression_params=how)
        self._zstd = zstandard.ZstdCompressor(dict_data=primed, compression_params=how)

    def added(self, candidate: str, around: str) -> int:
        """Bytes that the candidate adds after the text around it."""
        rest = around.replace(candidate, " ").lower().encode("utf-8", "surrogatepass") + b"\n"
        return len(self._zstd.compress(rest + candidate.lower().encode())) - len(self._zstd.compress(rest))


def mixed(candidate: str) -> bool:
    """Whether some part between separators changes between digits, capitals and small letters more often than names do."""
    for part in _SEPARATED.split(candidate):
        changes = len(_CHANGE.findall(part))
        if len(part) >= 8 and (changes >= max(3, (len(part) - 1) / 4) or changes and len(_DIGITS.findall(part)) > 1):
            return True
    return False


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) of the base kinds, by start, then kind."""
    spans = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    spans += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def novel_spans(text: str, base: list[tuple[str, int, int]], novelty: Novelty) -> list[tuple[str, int, int]]:
    """Spans of candidates in a sensitive context that the dictionary and their surroundings do not explain."""
    found, at = [], 0
    covered = sorted((start, end) for _, start, end in base)
    reach = 0  # end of the base spans that start before the candidate
    for match in _CANDIDATE.finditer(text):
        start, end = match.span()
        while at < len(covered) and covered[at][0] < end:
            reach = max(reach, covered[at][1])
            at += 1
        if reach > start:
            continue
        candidate = match.group().rstrip(".=") or match.group()
        end = start + len(candidate)
        if len(candidate) < LEAST or not mixed(candidate):
            continue
        own_cue = _CUE.search(text, max(0, start - CUE_REACH), start)
        if not own_cue:
            # name=value inside one run of token characters
            name, _, value = candidate.partition("=")
            if not value or len(value) < LEAST or not _CUE.search(name) or not mixed(value):
                continue
            start, candidate = start + len(name) + 1, value
        around = text[max(0, start - AROUND):start] + " " + text[end:end + AROUND]
        if novelty.added(candidate, around) >= max(NOVEL * len(candidate), ADDED):
            found.append(("novel", start, end))
    return found


def find(text: str, novelty: Novelty) -> tuple[list, list]:
    """The base spans, and all spans by start, then kind."""
    base = base_spans(text)
    return base, sorted(base + novel_spans(text, base, novelty), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def mark(docs: DataFrame, words: list[str], text: str = "text") -> tuple[DataFrame, list[str]]:
    """`docs` with a count per base kind, the base digest and all spans; and those names."""
    names = fresh(docs.columns, *(f"n_{kind}" for kind in BASE_KINDS), "base_sha256", "spans")
    sent = docs.sparkSession.sparkContext.broadcast(dictionary(words))

    def start():
        novelty = Novelty(sent.value)

        def work(texts):
            out = {name: [] for name in names}
            for value in texts:
                base, spans = find(value, novelty) if value else ([], [])
                for name, kind in zip(names, BASE_KINDS):
                    out[name].append(sum(span[0] == kind for span in base))
                out[names[3]].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                out[names[4]].append(_joined(spans))
            return out
        return work

    kinds = [T.LongType()] * 3 + [T.StringType()] * 2
    return add_columns(docs, text, list(zip(names, kinds)), start), names


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    own = docs.select(key, text)
    marked, _ = mark(own, corpus_words(own, text), text)
    return marked.drop(text)
