"""Reading a SentencePiece model file: its pieces, scores and normaliser settings.

The file is a protobuf message.  Only the wire format (varints, fixed-width numbers and
length-prefixed bytes) and the few field numbers below are needed.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

# Fixed values of the public model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
MARK = "▁"


@dataclass
class Model:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    suffix_mark: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim_spaces: bool = True
    escape_spaces: bool = True

    @property
    def unk_id(self) -> int:
        return self.types.index(UNKNOWN) if UNKNOWN in self.types else 0

    @property
    def byte_ids(self) -> dict[int, int]:
        return {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == BYTE}


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        number, wire = key >> 3, key & 7
        if wire == 0:
            value, at = _varint(data, at)
        elif wire == 2:
            size, at = _varint(data, at)
            value, at = data[at:at + size], at + size
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            value, at = struct.unpack("<d" if wire == 1 else "<f", data[at:at + size])[0], at + size
        else:
            raise ValueError(f"not a SentencePiece model: wire type {wire}")
        yield number, value


def parse(data: bytes) -> Model:
    model = Model()
    for number, value in _fields(data):
        if number == 1:  # a piece
            own = dict(_fields(value))
            model.pieces.append(own.get(1, b"").decode("utf-8"))
            model.scores.append(float(own.get(2, 0.0)))
            model.types.append(int(own.get(3, NORMAL)))
        elif number == 2:  # trainer settings
            own = dict(_fields(value))
            model.kind = int(own.get(3, UNIGRAM))
            model.byte_fallback = bool(own.get(35, 0))
            model.suffix_mark = bool(own.get(24, 0))
        elif number == 3:  # normaliser settings
            own = dict(_fields(value))
            model.charsmap = own.get(2, b"")
            model.dummy_prefix = bool(own.get(3, 1))
            model.trim_spaces = bool(own.get(4, 1))
            model.escape_spaces = bool(own.get(5, 1))
    return model
