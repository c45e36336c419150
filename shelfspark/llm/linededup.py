"""Line dedup by pairwise alignment.

1. Every line that is not blank gets a hash; the first document (least id) with a hash owns it,
   and so the first document with two lines next to each other.  A run of lines that earlier
   documents own, with at least `min_words` words, pairs its document with the owners of its
   lines and neighbours: never all pairs of those that share a line, so a line in a
   third of all documents costs one row each.
2. A later document is aligned with each such owner, over all lines that both hold, by
   patience diff: lines unique in both are anchors, the longest run of anchors in the same
   order is kept and each grown over equal neighbours; what is left goes to the longest common
   blocks first, so blocks that moved and repeated lines are found as well.
3. Lines that follow each other in both documents form a block.  Blocks of at least
   `min_words` words are deleted from the later document; shorter ones, such as a lone heading, stay.

The first occurrence of a line is never deleted.  Cases: null and empty texts stay; rows with the
same id are one document, so they do not delete from each other; rows without an id come last
and are one document; a line repeated inside one document only stays.  Line ends are \\n;
spaces, tabs and carriage returns around a line do not count.  Texts are read whole.  Extra
columns stay, clashing names get an underscore.
"""

from __future__ import annotations

from bisect import bisect_left
from heapq import heapify, heappop, heappush

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.llm.common import add_columns, fresh, landed

MIN_WORDS = 10
# Rows whose lists of lines are Python objects at the same time (about 20 times their size in Arrow).
LISTS_AT_ONCE = 16
_BLANK = " \t\r"
# What Python's split() takes as space, or more.
_SPACES = r"[\s\p{Z}\x{85}\x{1c}-\x{1f}]+"
_LAST = (1 << 63) - 1


def _hash(line: str) -> int:
    value = xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass"), 42)
    return value - (1 << 64) if value >> 63 else value


def _longest_rising(anchors: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of (place, owner place), sorted by place, with rising owner places."""
    tails: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for at, (_, other) in enumerate(anchors):
        pile = bisect_left(tails, other)
        before.append(ends[pile - 1] if pile else -1)
        if pile == len(tails):
            tails.append(other)
            ends.append(at)
        else:
            tails[pile], ends[pile] = other, at
    found, at = [], ends[-1] if ends else -1
    while at >= 0:
        found.append(anchors[at])
        at = before[at]
    return found[::-1]


def aligned_blocks(mine: dict[int, int], other: dict[int, int], places: dict[int, list[int]] | None = None) -> list[list[int]]:
    """Blocks of places whose lines follow each other in both documents; both map place to line.

    `places` maps each line of `mine` to its places, where a caller has it for several others.  Unique lines
    are anchors; what they leave is taken by the longest blocks first.  Time grows with the lines, not their square.
    """
    held: dict[int, list[int]] = {}
    for there, line in sorted(other.items()):
        held.setdefault(line, []).append(there)
    if places is None:
        places = places_of(mine)
    left = {place: line for line in held for place in places.get(line, ())}
    blocks = []

    def grow(place: int, there: int) -> None:
        low, high = place, place + 1
        while low - 1 in left and left[low - 1] == other.get(there + low - 1 - place):
            low -= 1
        while high in left and left[high] == other.get(there + high - place):
            high += 1
        blocks.append(list(range(low, high)))
        for at in blocks[-1]:
            del left[at]

    anchors = sorted((places[line][0], theres[0]) for line, theres in held.items() if len(theres) == 1 and len(places.get(line, ())) == 1)
    for place, there in _longest_rising(anchors):
        if place in left:
            grow(place, there)
    blocks += _longest_first(left, other)
    return sorted(blocks)


def places_of(mine: dict[int, int]) -> dict[int, list[int]]:
    places: dict[int, list[int]] = {}
    for place, line in sorted(mine.items()):
        places.setdefault(line, []).append(place)
    return places


def _longest_first(left: dict[int, int], other: dict[int, int]) -> list[list[int]]:
    """Cover the places by blocks that the other document has too, the longest first, of equal ones the earlier."""
    lengths = _match_lengths(left, other)
    heap = [(-length, place) for place, length in lengths.items()]
    heapify(heap)
    taken: set[int] = set()
    starts: list[int] = []
    blocks = []
    while heap:
        length, place = heappop(heap)
        if place in taken:
            continue
        # a block taken since may begin inside; that happens once, as what follows is shorter
        at = bisect_left(starts, place)
        free = min(-length, starts[at] - place) if at < len(starts) else -length
        if free < -length:
            heappush(heap, (-free, place))
            continue
        blocks.append(list(range(place, place + free)))
        taken.update(blocks[-1])
        starts.insert(at, place)
    return blocks


def _match_lengths(left: dict[int, int], other: dict[int, int]) -> dict[int, int]:
    """How many lines from each place on follow each other in the other document as well.

    A suffix automaton of the other's lines, last one first, is walked along the places, last one first.
    """
    follow: list[dict[int, int]] = [{}]
    link, longest = [-1], [0]
    last, before = 0, None
    for there, line in sorted(other.items(), reverse=True):
        if before is not None and there != before - 1:
            last = 0  # a gap: no block spans it
        before = there
        known = follow[last].get(line)
        if known is not None and longest[known] == longest[last] + 1:
            last = known
            continue
        if known is not None:  # after a gap the state may exist as part of a longer one
            copy = len(follow)
            follow.append(dict(follow[known]))
            longest.append(longest[last] + 1)
            link.append(link[known])
            link[known] = copy
            at = last
            while at != -1 and follow[at].get(line) == known:
                follow[at][line] = copy
                at = link[at]
            last = copy
            continue
        new = len(follow)
        follow.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        at = last
        while at != -1 and line not in follow[at]:
            follow[at][line] = new
            at = link[at]
        if at != -1:
            known = follow[at][line]
            if longest[known] == longest[at] + 1:
                link[new] = known
            else:
                copy = len(follow)
                follow.append(dict(follow[known]))
                longest.append(longest[at] + 1)
                link.append(link[known])
                link[known] = link[new] = copy
                while at != -1 and follow[at].get(line) == known:
                    follow[at][line] = copy
                    at = link[at]
        last = new
    lengths, state, size, before = {}, 0, 0, None
    for place, line in sorted(left.items(), reverse=True):
        if before is not None and place != before - 1:
            state = size = 0
        before = place
        while state and line not in follow[state]:
            state = link[state]
            size = longest[state]
        if line in follow[state]:
            state, size = follow[state][line], size + 1
        lengths[place] = size
    return lengths


def align(places: dict[int, int]) -> set[int]:
    """Places of a document's lines aligned with an owner; `places` maps place to owner place."""
    return set().union(*aligned_blocks(places, {there: there for there in places.values()}))


def without_blocks(text: str, owners: list[tuple[int, int, int]], min_words: int) -> tuple[str, int]:
    """The text without aligned blocks, and how many lines those had; owners: (hash, owner, place)."""
    lines = text.split("\n")
    full = [at for at, line in enumerate(lines) if line.strip(_BLANK)]
    mine = {place: _hash(lines[at].strip(_BLANK)) for place, at in enumerate(full)}
    others: dict[int, dict[int, int]] = {}
    for line, owner, place in owners:
        others.setdefault(owner, {})[place] = line
    gone: set[int] = set()
    places = places_of(mine)
    for other in others.values():
        for block in aligned_blocks(mine, other, places):
            if sum(len(lines[full[place]].split()) for place in block) >= min_words:
                gone.update(full[place] for place in block)
    if not gone:
        return text, 0
    return "\n".join(line for at, line in enumerate(lines) if at not in gone), len(gone)


def _order(key: Column) -> Column:
    return F.coalesce(key, F.lit(_LAST))


def _slices(batches):
    """Few rows at a time, however many an Arrow batch holds."""
    for batch in batches:
        for low in range(0, batch.num_rows, LISTS_AT_ONCE):
            yield batch.slice(low, LISTS_AT_ONCE)


def _runs(rows: DataFrame, min_words: int) -> DataFrame:
    """(k, part, unit) for lines, and pairs of neighbours, in runs of earlier documents' lines with enough words."""

    def work(batches):
        import pyarrow as pa
        for batch in _slices(batches):
            keys, parts, units = [], [], []
            for k, part, held in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2))):
                run, found = [], set()
                for x in [*sorted(held, key=lambda x: x["place"]), None]:
                    if x is not None and x["owner"] < k and (not run or x["place"] == run[-1]["place"] + 1):
                        run.append(x)
                        continue
                    if sum(y["words"] for y in run) >= min_words:
                        found.update(y["line"] for y in run)
                        found.update(_both(a["line"], b["line"]) for a, b in zip(run, run[1:]))
                    run = [x] if x is not None and x["owner"] < k else []
                keys += [k] * len(found)
                parts += [part] * len(found)
                units += found
            yield pa.RecordBatch.from_pydict({"k": pa.array(keys, pa.int64()), "part": pa.array(parts, pa.int64()), "unit": pa.array(units, pa.int64())})

    return rows.mapInArrow(work, "k long, part long, unit long")


def _both(first: int, second: int) -> int:
    value = xxhash.xxh64_intdigest(first.to_bytes(8, "little", signed=True) + second.to_bytes(8, "little", signed=True), 42)
    return value - (1 << 64) if value >> 63 else value


def _units(rows: DataFrame) -> DataFrame:
    """(unit, k) of all pairs of neighbouring shared lines."""

    def work(batches):
        import pyarrow as pa
        for batch in _slices(batches):
            keys, units = [], []
            for k, held in zip(*(batch.column(i).to_pylist() for i in (0, 2))):
                held.sort(key=lambda x: x["place"])
                found = {_both(a["line"], b["line"]) for a, b in zip(held, held[1:]) if b["place"] == a["place"] + 1}
                keys += [k] * len(found)
                units += found
            yield pa.RecordBatch.from_pydict({"unit": pa.array(units, pa.int64()), "k": pa.array(keys, pa.int64())})

    return rows.mapInArrow(work, "unit long, k long")


def shared_lines(docs: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    """(k, part, owners) for each text with enough lines of earlier ones; owners: the texts it is aligned with, as lines.

    `part` is the text's hash, so rows that share an id, or have none, keep their own places.
    """
    trimmed = F.filter(F.transform(F.split(F.col(f"`{text}`"), "\n"), lambda x: F.btrim(x, F.lit(_BLANK))), lambda x: x != "")
    hashes = F.transform(trimmed, lambda x: F.struct(F.xxhash64(x).alias("line"), F.size(F.split(x, _SPACES)).alias("words")))
    lines = landed(docs.select(_order(F.col(f"`{key}`")).alias("k"), F.xxhash64(F.col(f"`{text}`")).alias("part"), F.posexplode(hashes).alias("place", "x"))
                   .select("k", "part", "place", "x.line", "x.words"), "lines")
    owner = landed(lines.groupBy("line").agg(F.min("k").alias("owner"), F.max("k").alias("last"))
                   .filter("owner < last").select("line", "owner"), "owners")
    held = landed(lines.join(owner, "line").groupBy("k", "part").agg(F.collect_set(F.struct("place", "line", "words", "owner")).alias("held")), "shared")
    wanted = landed(_runs(held, min_words), "wanted")
    pairs_of = _units(held).groupBy("unit").agg(F.min("k").alias("owner"), F.max("k").alias("last")).filter("owner < last").select("unit", "owner")
    first = landed(owner.withColumnRenamed("line", "unit").union(pairs_of), "firsts")
    met = landed(wanted.join(first, "unit").filter("owner < k").select("k", "part", "owner").distinct(), "pairs")
    sent = held.select(F.col("k").alias("owner"), F.transform("held", lambda x: F.struct(x["line"].alias("line"), x["place"].alias("at"))).alias("lines"))
    return met.join(sent, "owner").groupBy("k", "part").agg(F.collect_list("lines").alias("owners"))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> tuple[DataFrame, str]:
    """`docs` with blocks deleted from `text`, and a column with the number of deleted lines; its name."""
    own, part, owners, new, removed = fresh(docs.columns, "_k", "_part", "_owners", "_text", "n_removed")
    found = landed(shared_lines(docs, key, text, min_words).select(F.col("k").alias(own), F.col("part").alias(part), F.col("owners").alias(owners)), "later")
    rows = docs.join(found, (_order(docs[key]) == found[own]) & (F.xxhash64(docs[text]) == found[part]), "left").drop(own, part)

    def start():
        def work(texts, lists):
            done = [(value, 0) if value is None or not known else without_blocks(
                value, [(x["line"], at, x["at"]) for at, held in enumerate(known) for x in held], min_words) for value, known in zip(texts, lists)]
            return {new: [value for value, _ in done], removed: [count for _, count in done]}
        return work

    out = add_columns(rows, text, [(new, T.StringType()), (removed, T.LongType())], start, (owners,), LISTS_AT_ONCE)
    return out.select(*[F.col(f"`{new}`").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns], removed), removed


def remove_repeated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with repeated blocks deleted and n_chars, where there is one, counted anew."""
    out, removed = dedup(docs, key, text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length(text).cast(docs.schema["n_chars"].dataType))
    return out.drop(removed)


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    out, removed = dedup(docs.select(key, text), key, text)
    return out.select(key, F.col(removed).alias("n_removed"), F.coalesce(F.char_length(text), F.lit(0)).cast("long").alias("n_chars"), text)
