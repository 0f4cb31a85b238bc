"""Texts cut into units that a tokenizer encodes alike alone and in place, so that each distinct unit is encoded once.

A cut is safe before a single space or line break between two characters that are not white space: no pre-token of
the tokenizers at hand reaches over it, and neither their special tokens nor their normalisation do. A full stop or
comma between a letter or digit and white space is a pre-token of its own. White space, letters and digits are judged
by Python's ``\\s`` and ``\\w``: the first covers the tokenizers' white space and a little more, the second none but
their letters, digits and the underscore. In doubt nothing is cut.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are encoded in batches of about this many characters; a longer text is cut at safe places.
BATCH_CHARS = 1 << 21
#: Bytes of units and their encodings that a Python worker remembers, by :func:`_weight`: about as much of its memory.
REMEMBERED = 64 << 20
#: Units joined into one string for the tokenizer, and strings in one call.
JOINED, CALL_TEXTS = 500, 64

_SAFE = re.compile(r"(?<=\S)(?=[ \n]\S)")
_UNEVEN = re.compile(r"\s\s|^\s|\s$|[^\S \n]")
#: Full stops and commas that do not stand between a word and white space or the end, or beside another mark.
_ODD_MARK = re.compile(r"(?:^|[^\w]|_)[.,]|[.,](?![ \n]|\Z)")
_ODD_BARE_MARK = re.compile(r"[.,](?:(?=[^\w\s]|[_\x1c-\x1f])|(?<=[^\w\s].)|(?<=[_\x1c-\x1f].))")
_ASCII_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


#: ASCII as letters and digits ``a``, full stop and comma ``.``, space and line break, tab and its like ``!``, the rest ``#``.
_KINDS = bytes(
    ord("a") if chr(b).isalnum() and b < 128 else ord(".") if b in b".," else ord(" ") if b in b" \n"
    else ord("!") if chr(b).isspace() and b < 128 else ord("#") for b in range(256))
#: The same for a tokenizer to which the separators U+001C to U+001F are no white space.
_BARE_KINDS = bytes(ord("#") if 28 <= b <= 31 else kind for b, kind in enumerate(_KINDS))


def segments(text: str, limit: int) -> Iterator[str]:
    """Pieces of about ``limit`` characters, cut only at safe places; together they are the text."""
    at = 0
    while len(text) - at > limit:
        found = _SAFE.search(text, at + limit)
        if not found:
            break
        yield text[at:found.start()]
        at = found.start()
    yield text[at:]


def _batches(texts: list[str]) -> Iterator[list[tuple[int, str]]]:
    """(index, piece) of texts, in runs of about ``BATCH_CHARS`` characters."""
    run, held = [], 0
    for i, text in enumerate(texts):
        for piece in segments(text, BATCH_CHARS):
            run.append((i, piece))
            held += len(piece)
            if held >= BATCH_CHARS:
                yield run
                run, held = [], 0
    yield run


def bare_units(text: str) -> list[str]:
    """Units in order for a tokenizer that drops white space and case: words, in lower case as far as they are ASCII."""
    return bare_text(text).split(" ")


def bare_text(text: str) -> str:
    """:func:`bare_units`, with a space between each two."""
    if "<|" not in text:
        text = text.encode().translate(_ASCII_LOWER).decode()
    if not _has_odd_bare_mark(text):
        text = text.replace(".", " . ").replace(",", " , ")
    return text.replace("\n", " ")


def _has_odd_bare_mark(text: str) -> bool:
    """Judged on the text as the tokenizer normalises it, in which a letter may have become one with a mark behind it."""
    if text.isascii():
        kinds = text.encode().translate(_BARE_KINDS)
        return b"#." in kinds or b".#" in kinds or b".." in kinds
    return _ODD_BARE_MARK.search(unicodedata.normalize("NFC", text).lower()) is not None


def _is_odd(text: str) -> tuple[bool, bool]:
    """Whether marks, or white space, stand elsewhere than a single one behind or between words."""
    if not text.isascii():
        return _ODD_MARK.search(text) is not None, _UNEVEN.search(text) is not None
    kinds = text.encode().translate(_KINDS)
    marks = any(odd in kinds for odd in (b"#.", b".#", b"..", b" .", b".a", b"!.", b".!")) or kinds[:1] == b"."
    return marks, b"  " in kinds or b"!" in kinds or kinds[:1] == b" " or kinds[-1:] == b" "


def loose_units(text: str) -> tuple[list[str], list[str]]:
    """Units with as many tokens as the text, in any order, for a tokenizer to which a space before a word belongs.

    The second list has units that are preceded by a space, without it.
    """
    plain, spaced = [], []
    odd_marks, uneven = _is_odd(text)
    if not odd_marks:
        plain += ["."] * text.count(".") + [","] * text.count(",")
        text = text.replace(".", "").replace(",", "")
    if uneven:
        for unit in _SAFE.split(text):
            (spaced if unit[:1] == " " else plain).append(unit.removeprefix(" "))
        return plain, spaced
    lines = text.split("\n")
    plain += ["\n"] * (len(lines) - 1)
    for line in lines:
        words = line.split(" ")
        plain.append(words[0])
        spaced += words[1:]
    return plain, spaced


def _weight(unit: str, value: object) -> int:
    """Bytes that a remembered unit takes, with its place in a table that is at worst a third full."""
    return _weights([unit], [value])


def _weights(units: list[str], values: list) -> int:
    """The same for many; all values are bytes, or none."""
    ids = sum(map(sys.getsizeof, values)) if values and isinstance(values[0], bytes) else 0
    return sum(map(sys.getsizeof, units)) + ids + 104 * len(units)


class _Known:
    """What is known of units. ``split`` finds the places of the joined words in a list of token ids.

    Two generations share the memory: when the younger holds half of it, it becomes the older, whose units are moved on as
    they turn up again, and what the older one still held is forgotten. So frequent units stay, whatever the texts.
    """

    def __init__(
        self, tokenizer, lead: str, joint: str, split: Callable[[np.ndarray], list[tuple[int, int]]],
        value: Callable[[np.ndarray], object],
    ):
        self.tokenizer, self.lead, self.joint, self.split, self.value = tokenizer, lead, joint, split, value
        self.of: dict[str, object] = {}
        self.older: dict[str, object] = {}
        self.held = 0

    def learn(self, units: set[str]) -> None:
        """From here to the next call ``of`` has every one of ``units``."""
        if 2 * self.held > REMEMBERED:
            self.older, self.of, self.held = self.of, {}, 0
        new = units.difference(self.of)
        if self.older:
            again = list(new.intersection(self.older))
            self._keep(again, list(map(self.older.__getitem__, again)))
            new = new.difference(self.of)
        words = [u for u in new if u.isalpha()]
        rest = [u for u in new if not u.isalpha()]
        runs = [words[i:i + JOINED] for i in range(0, len(words), JOINED)]
        for run, ids in zip(runs, self._ids([self.joint.join(self.lead + w for w in r) for r in runs]), strict=True):
            places = self.split(ids)
            if len(places) == len(run):
                self._keep(run, [self.value(ids[a:b]) for a, b in places])
            else:
                rest += run
        self._keep(rest, [self.value(ids) for ids in self._ids([self.lead + u for u in rest])])

    def _keep(self, units: list[str], values: list) -> None:
        self.of.update(zip(units, values, strict=True))
        self.held += _weights(units, values)

    def _ids(self, texts: list[str]) -> Iterator[np.ndarray]:
        for i in range(0, len(texts), CALL_TEXTS):
            for found in self.tokenizer.encode_batch_fast(texts[i:i + CALL_TEXTS], add_special_tokens=False):
                yield np.array(found.ids, "<u4")


def _tokenizer(path: str):
    # A task has one core; further threads would only take memory of their own.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class LengthEncoder:
    """Numbers of tokens by a byte-level tokenizer, in which a line break between words is a token of its own."""

    def __init__(self, path: str):
        tokenizer = _tokenizer(path)
        (line,) = tokenizer.encode("\n", add_special_tokens=False).ids

        def split(ids: np.ndarray) -> list[tuple[int, int]]:
            at = np.flatnonzero(ids == line).tolist()
            return list(zip([0, *(a + 1 for a in at)], [*at, len(ids)], strict=True))

        self.plain, self.spaced = (_Known(tokenizer, lead, "\n", split, len) for lead in ("", " "))
        self.plain.of[""] = 0

    def encode(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        for run in _batches(texts):
            cut = [(i, *loose_units(piece)) for i, piece in run]
            self.plain.learn(set().union(*(p for _, p, _ in cut)))
            self.spaced.learn(set().union(*(s for _, _, s in cut)))
            plain, spaced = self.plain.of.__getitem__, self.spaced.of.__getitem__
            for i, p, s in cut:
                out[i] += sum(map(plain, p)) + sum(map(spaced, s))
        return out


class IdEncoder:
    """Token ids, as little-endian unsigned 32-bit numbers, by a tokenizer that marks the last token of a word."""

    def __init__(self, path: str, mark: str = "</w>"):
        tokenizer = _tokenizer(path)
        ends = np.zeros(tokenizer.get_vocab_size(), bool)
        ends[[i for token, i in tokenizer.get_vocab().items() if token.endswith(mark)]] = True

        def split(ids: np.ndarray) -> list[tuple[int, int]]:
            at = (np.flatnonzero(ends[ids]) + 1).tolist()
            return list(zip([0, *at[:-1]], at, strict=True)) if at else []

        self.known = _Known(tokenizer, "", " ", split, np.ndarray.tobytes)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        held, done = [], 0
        for run in _batches(texts):
            # Arrow cuts the words, tells which are the same and lines up their ids; Python looks at distinct words only.
            words = pc.split_pattern(pa.array([bare_text(piece) for _, piece in run], pa.string()), " ")
            ends = words.offsets.to_numpy()
            coded = words.flatten().dictionary_encode()
            units = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
            self.known.learn(set(units))
            ids = pa.array(map(self.known.of.__getitem__, units), pa.binary(), size=len(units)).take(coded.indices)
            _, places, data = ids.buffers()
            at = np.frombuffer(places, np.int32, len(ids) + 1, 4 * ids.offset)[ends].tolist()
            for k, (i, _) in enumerate(run):
                if i > done:
                    yield b"".join(held)
                    held, done = [], i
                held.append(data[at[k]:at[k + 1]].to_pybytes() if at[k] < at[k + 1] else b"")
        if texts:
            yield b"".join(held)


_encoders: dict[tuple[type, str], object] = {}


def encoder(kind: type, path: str):
    """One encoder for each Python worker and tokenizer."""
    if (kind, path) not in _encoders:
        _encoders[kind, path] = kind(path)
    return _encoders[kind, path]


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)
