"""SentencePiece encoding and decoding through the tokenizers library.

The model file is parsed (spmodel), and the same tokenizer is rebuilt from its parts: the
normaliser (character map, dummy prefix, space rules), the marker for spaces, the pieces with
their scores (unigram) or the merges those scores imply (BPE), and byte fallback.  Batches of new
words are encoded with the library's threads inside the tasks, and by the original library
too: `parity` says whether both agree on a text, and where they do not the original ids
are returned, so ids are always the model's own.

Cases: a null text gives null ids and null decoding; an empty text gives no ids; extra columns
stay and clashing names get an underscore; repeated rows are each encoded; long texts whole.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, decoders, models, normalizers, pre_tokenizers

from shelfspark.llm.common import add_columns, fresh
from shelfspark.llm.spmodel import BPE, BYTE, MARK, NORMAL, USER_DEFINED, Model, parse

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# Words that a task remembers; then it keeps those it has met again since.
CACHED = 150_000
LETTERS = 24  # of an average word, so that very long words count for more
JOINED = 4000
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def merges(model: Model) -> list[tuple[str, str]]:
    """Pairs in the order in which the model joins them: by the joined piece's score."""
    ids = {p: i for i, (p, t) in enumerate(zip(model.pieces, model.types)) if t in (NORMAL, USER_DEFINED)}
    found = []
    for piece, at in ids.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in ids and right in ids:
                found.append((-model.scores[at], at, ids[left], ids[right], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def words_apart(model: Model) -> bool:
    """Whether no piece has the marker behind another character, so that words never join."""
    return not any(MARK in p.lstrip(MARK) for p, t in zip(model.pieces, model.types) if t != BYTE)


def normalizer(model: Model) -> normalizers.Normalizer:
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.trim_spaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    mark = MARK if model.escape_spaces else " "
    if model.dummy_prefix and not model.suffix_mark:
        steps.append(normalizers.Prepend(mark))
    if model.escape_spaces:
        steps.append(normalizers.Replace(" ", MARK))
    return normalizers.Sequence(steps)


def rebuild(model: Model) -> tokenizers.Tokenizer:
    unk = model.pieces[model.unk_id]
    if model.kind == BPE:
        core = models.BPE(
            vocab={p: i for i, p in enumerate(model.pieces)}, merges=merges(model), unk_token=unk,
            fuse_unk=True, byte_fallback=model.byte_fallback)
    else:
        core = models.Unigram(list(zip(model.pieces, model.scores)), model.unk_id, model.byte_fallback)
    made = tokenizers.Tokenizer(core)
    made.normalizer = normalizer(model)
    if words_apart(model):  # the same result, and words repeat where whole texts do not
        made.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    made.decoder = decoders.Sequence(steps + [decoders.Strip(" ", 1, 0)] * model.dummy_prefix)
    return made


class Remembered:
    """A bounded memory of two generations: entries met again outlive those that are not."""

    def __init__(self, size: int):
        self.size, self.chars, self.young, self.old = size, 0, {}, {}

    def complete(self, keys: set, learn) -> dict:
        """A dictionary that has all keys; `learn` maps a list of unknown keys to their values."""
        if len(self.young) >= self.size or self.chars >= self.size * LETTERS:
            self.old, self.young, self.chars = self.young, {}, 0
        young, old, new = self.young, self.old, []
        for key in keys.difference(young):
            value = old.get(key)
            if value is None:
                new.append(key)
            else:
                young[key] = value
        if new:
            self.chars += sum(map(len, new))
            young.update(learn(new))
        return young


def marked(text: str) -> str:
    """Normalised form for models that only mark spaces and put one in front."""
    return MARK + text.replace(" ", MARK) if text else ""


def normalise(model: Model):
    """A function from a text to its normalised form."""
    if model.charsmap or model.trim_spaces or not model.escape_spaces or model.suffix_mark:
        return normalizer(model).normalize_str
    return marked if model.dummy_prefix else lambda text: text.replace(" ", MARK)


def units_of(normalise, text: str) -> list[str]:
    """Words of a text, each without the marker that opens it (the dummy prefix for the first)."""
    if text[:1] != " " and "  " not in text and MARK not in text and normalise is marked:
        return text.split(" ") if text else []
    return [unit[1:] for unit in _WORD.findall(normalise(text))]


class Coder:
    """Encodes and decodes lists of texts; words seen before are not encoded again.

    Where words never join (`words_apart`), a text's ids are its words' ids in turn, and both
    libraries agree on a text if they agree on each of its words.  Otherwise the unit is the
    whole text.  Each new unit goes through both libraries once.
    """

    def __init__(self, raw: bytes, threads: int = 1, cached: int = CACHED):
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        self.model = model = parse(raw)
        self.original = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.threads = threads
        self.tokenizer = rebuild(model)
        self.normalise = normalise(model)
        self.apart = words_apart(model) and model.escape_spaces and model.dummy_prefix and not model.suffix_mark
        self.known, self.differ = Remembered(cached), set()
        bytes_of = {i: bytes([b]) for b, i in model.byte_ids.items()}
        self.begins = np.array([p.startswith(MARK) for p in model.pieces])
        self.parts = [bytes_of.get(i, p.replace(MARK, " ").encode()) for i, p in enumerate(model.pieces)]

    def _both(self, texts: list[str]):
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return zip(got, self.original.encode(texts, num_threads=self.threads))

    def learn(self, units: list[str]) -> dict[str, bytes]:
        """Ids (32-bit) of units by the original library; those for which the rebuilt one differs are put in `differ`.

        Words without a further marker go through the libraries joined, a few thousand in one
        text: each begins with the only id whose piece begins with the marker.
        """
        learnt: dict[str, bytes] = {}
        simple = [u for u in units if u and MARK not in u] if self.apart else []
        joined = [simple[low:low + JOINED] for low in range(0, len(simple), JOINED)]
        for own, (a, b) in zip(joined, self._both([" ".join(x) for x in joined])):
            ids = np.array(b, np.int32)
            firsts = [*(4 * np.flatnonzero(self.begins[ids])).tolist(), 4 * len(b)]
            if a == b and len(firsts) == len(own) + 1:
                packed = ids.tobytes()
                learnt.update((unit, packed[x:y]) for unit, x, y in zip(own, firsts, firsts[1:]))
        rest = [u for u in units if u not in learnt]  # one by one, to tell which differs
        if self.apart:  # behind a letter, so that a lone marker has its own ids too
            first, plain = len(self.original.encode("a")), [f"a {u.replace(MARK, ' ')}" for u in rest]
        else:
            first, plain = 0, rest
        for unit, (a, b) in zip(rest, self._both(plain)):
            learnt[unit] = np.array(b[first:], np.int32).tobytes()
            if a != b:
                self.differ.add(unit)
        return learnt

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, bool]]:
        """(ids, whether both libraries agree) of each text."""
        split = [units_of(self.normalise, text) for text in texts] if self.apart else [[text] for text in texts]
        known = self.known.complete(set().union(*split), self.learn)
        return [(np.frombuffer(b"".join(map(known.__getitem__, units)), np.int32),
                 not self.differ or self.differ.isdisjoint(units)) for units in split]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the library is asked where byte pieces do not form characters."""
        try:
            text = b"".join(map(self.parts.__getitem__, ids)).decode("utf-8")
        except UnicodeDecodeError:
            return self.tokenizer.decode(ids, skip_special_tokens=False)
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


@functools.lru_cache(maxsize=2)
def coder_of(raw: bytes, threads: int) -> Coder:
    """One coder per Python worker, so that tasks share the words it remembers."""
    return Coder(raw, threads)


def _sent(spark, model_path: str):
    with open(model_path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, model_path: str = DEFAULT_MODEL, text: str = "text", threads: int = 1) -> tuple[DataFrame, list[str]]:
    """`docs` with `ids`, `decoded` and `parity`; and those names.

    The model reaches the tasks as a broadcast value (a vocabulary file of fixed size), so no
    executor needs the file.  `threads` bounds the libraries' own threads in one task.
    """
    names = fresh(docs.columns, "ids", "decoded", "parity")
    sent = _sent(docs.sparkSession, model_path)

    def start():
        coder = coder_of(sent.value, threads)

        def work(texts):
            coded = iter(coder.encode([value for value in texts if value is not None]))
            rows = [next(coded) if value is not None else (None, None) for value in texts]
            return {names[0]: [ids for ids, _ in rows], names[2]: [same for _, same in rows],
                    names[1]: [coder.decode(ids.tolist()) if ids is not None else None for ids, _ in rows]}
        return work

    kinds = [T.ArrayType(T.IntegerType()), T.StringType(), T.BooleanType()]
    return add_columns(docs, text, list(zip(names, kinds)), start), names


def decode(rows: DataFrame, ids: str = "ids", model_path: str = DEFAULT_MODEL) -> tuple[DataFrame, str]:
    """`rows` with the text of an id array (null for null); and the name of that column."""
    (name,) = fresh(rows.columns, "decoded")
    sent = _sent(rows.sparkSession, model_path)

    def start():
        coder = coder_of(sent.value, 1)
        return lambda lists: {name: [None if x is None else coder.decode(x) for x in lists]}

    return add_columns(rows, ids, [(name, T.StringType())], start), name


def report(docs: DataFrame, model_path: str = DEFAULT_MODEL, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ids, their number, whether both libraries agree, whether decoding gives the text back."""
    coded, (ids, decoded, parity) = encode(docs.select(key, text), model_path, text)
    return coded.select(
        key, F.coalesce(F.size(ids), F.lit(0)).cast("long").alias("n_tokens"), F.col(ids).alias("ids"),
        F.col(parity).alias("parity"), (F.col(decoded) == F.col(text)).alias("round_trip"))
