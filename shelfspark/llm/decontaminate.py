"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are windows of consecutive benchmark words.  All patterns of one length share three
tables: SHIFT (how far the search may jump after reading a block of two words), a bucket per
suffix block, and inside it one per prefix block.  The search reads the last block of the
current window: a positive shift skips every position where no pattern can end; otherwise
the bucket's patterns are compared word by word, so a reported hit is a real occurrence.

Cases: a null or empty text has no words and no hits; a null or empty item has no windows;
rows repeating an item id count as one item; an item without id marks words but is not
listed; no items leaves every document clean.  Extra columns are kept, and names that clash
get an underscore (`fresh`).  Repeated documents are each searched.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.llm.common import add_columns, fresh, landed

WINDOW = 10
# Benchmark text held by a task at a time; a larger benchmark is searched in several passes.
BLOCK_CHARS = 16_000_000

_UPPER = bytes(range(0x41, 0x5B))
_WORD_BYTES = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
# One byte table: A-Z become a-z, and every byte outside the word alphabet a space.
_TABLE = bytes(b + 32 if b in _UPPER else b if b in _WORD_BYTES else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(_TABLE).split() if text else []


class Tables:
    """SHIFT and bucket tables for patterns of one length."""

    def __init__(self, patterns: dict[tuple[bytes, ...], set[str]]):
        self.length = len(next(iter(patterns)))
        self.block = min(2, self.length)
        self.default = self.length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list]] = {}
        for pattern, items in patterns.items():
            for end in range(self.block, self.length + 1):
                block = pattern[end - self.block:end]
                self.shift[block] = min(self.shift.get(block, self.default), self.length - end)
            suffix, prefix = pattern[-self.block:], pattern[:self.block]
            self.buckets.setdefault(suffix, {}).setdefault(prefix, []).append((pattern, frozenset(items)))

    def search(self, words: tuple[bytes, ...], found: Callable[[int, int, frozenset], None]) -> None:
        end, length, block, n = self.length, self.length, self.block, len(words)
        shift, default = self.shift, self.default
        while end <= n:
            suffix = words[end - block:end]
            jump = shift.get(suffix, default)
            if jump:
                end += jump
                continue
            begin = end - length
            for pattern, items in self.buckets[suffix].get(words[begin:begin + block], ()):
                if pattern == words[begin:end]:
                    found(begin, end, items)
            end += 1


def build(items: list[tuple[str | None, str | None]], window: int) -> list[Tables]:
    """Tables per pattern length: `window`, and one for each shorter whole item's length."""
    by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
    for item, text in items:
        words = tuple(words_of(text))
        size = min(window, len(words))
        for begin in range(len(words) - size + 1 if size else 0):
            owners = by_length.setdefault(size, {}).setdefault(words[begin:begin + size], set())
            if item is not None:
                owners.add(item)
    return [Tables(patterns) for patterns in by_length.values()]


class Hits(NamedTuple):
    """Names of the added columns."""

    n_words: str
    n_hit: str
    spans: str
    items: str


def _merged(flat: list[int]) -> list[int]:
    out: list[int] = []
    for begin, end in sorted(zip(flat[::2], flat[1::2])):
        if out and begin <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [begin, end]
    return out


def _search_pass(docs: DataFrame, text: str, names: Hits, load: Callable, window: int, first: bool) -> DataFrame:
    def start():
        tables = build(load(), window)

        def work(texts, spans=None, items=None):
            out = {name: [] for name in names}
            for at, value in enumerate(texts):
                words = tuple(words_of(value))
                flat: list[int] = list(spans[at]) if spans else []
                owners: set[str] = set(items[at]) if items else set()

                def found(begin, end, by):
                    flat.extend((begin, end))
                    owners.update(by)

                for table in tables:
                    table.search(words, found)
                flat = _merged(flat)
                out[names.n_words].append(len(words))
                out[names.n_hit].append(sum(flat[1::2]) - sum(flat[::2]))
                out[names.spans].append(flat)
                out[names.items].append(sorted(owners))
            return out
        return work

    fields = [(names.n_words, T.LongType()), (names.n_hit, T.LongType()),
              (names.spans, T.ArrayType(T.LongType())), (names.items, T.ArrayType(T.StringType()))]
    if first:
        return add_columns(docs, text, fields, start)
    before = dict(zip(("spans", "items"), fresh(docs.columns, "_spans", "_items")))
    docs = (docs.withColumnRenamed(names.spans, before["spans"]).withColumnRenamed(names.items, before["items"])
            .drop(names.n_words, names.n_hit))
    return add_columns(docs, text, fields, start, (before["spans"], before["items"])).drop(*before.values())


def mark(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_chars: int = BLOCK_CHARS,
) -> tuple[DataFrame, Hits]:
    """`docs` with words, hit words, hit spans (flat begin/end word numbers) and item ids.

    The benchmark reaches the tasks in blocks of bounded text; documents are never shuffled.
    """
    spark = docs.sparkSession
    names = Hits(*fresh(docs.columns, "n_words", "n_hit", "hit_spans", "hit_items"))
    pairs = benchmark.select(F.col(item).cast("string").alias("i"), F.col(item_text).alias("t"))
    chars = pairs.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    for block in range(blocks):
        own = pairs if blocks == 1 else pairs.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block)
        sent = spark.sparkContext.broadcast([(r.i, r.t) for r in own.toLocalIterator()])
        docs = _search_pass(docs, text, names, lambda sent=sent: sent.value, window, block == 0)
        if block + 1 < blocks:
            docs = landed(docs, "decontaminate")
    return docs, names


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without a single benchmark window, columns as they were."""
    marked, names = mark(docs, benchmark)
    return marked.filter(F.col(names.n_hit) == 0).drop(*names)


def report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: words, hit words, items and their digest."""
    marked, names = mark(docs.select(key, text), benchmark, text)
    return marked.select(
        key, F.col(names.n_words).alias("n_words"), F.col(names.n_hit).alias("n_hit"),
        F.size(names.items).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(names.items), ",").cast("binary"), 256).alias("items_sha256"),
        (F.col(names.n_hit) > 0).alias("contaminated"))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, text, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws, row_number() OVER () AS rid FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, size, array_to_string(ws[p:p + size - 1], ' ') AS win
  FROM (SELECT item_id, ws, least(10, len(ws)) AS size, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS p
        FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM wins),
occ AS (
  SELECT rid, p, size, array_to_string(ws[p:p + size - 1], ' ') AS win
  FROM (SELECT rid, ws, size, unnest(range(1, len(ws) - size + 2)) AS p FROM w, sizes WHERE len(ws) >= size)),
hits AS (SELECT rid, p, size, item_id FROM occ JOIN wins USING (size, win)),
cover AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(p, p + size)) AS pos FROM hits) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN cover USING (rid) LEFT JOIN items USING (rid)
"""
