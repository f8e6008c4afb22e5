"""Secrets in whole texts, also below nested URL, Unicode, base64 and compressed layers."""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import itertools
import lzma
import re
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import document_rows, prepare, table

# Fixed values of the contract: kinds in order, their patterns, which group has to have
# how many characters.
KINDS = ("assign", "access", "hex")
PATTERNS = {
    "assign": (re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]{24,}"), 0, 24),  # a maximal run of 24 or more is one of the runs that count
}

_URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|\\U([0-9A-Fa-f]{8})|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});")
# No secret, code or wrapped word reaches over any other character, so that decoding such a
# stretch finds what decoding the whole text would.
_STRETCH = re.compile(r"""[A-Za-z0-9+/_.=\-"' :%&#;\\\t\r\n]+""")
_EDGE = re.compile(r"""[^A-Za-z0-9+/_.=\-"' :%&#;\\\t\r\n]""")
_BASE64_WORD = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# Lines of one word, as mail and key files wrap it.
_WRAPPED_WORD = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{16,}+[ \t]*+\r?\n[ \t]*+)+[A-Za-z0-9+/_-]++={0,2}")
_BLANKS = re.compile(r"[ \t\r\n]+")
# What of a compressed layer is held at once, but for a stretch that is longer.
PIECE = 1 << 20


class Layer(NamedTuple):
    """A decoded text; character k stands for ``begins[k]`` to ``ends[k]`` of the original."""

    text: str
    begins: np.ndarray
    ends: np.ndarray

    def part(self, a: int, b: int) -> Layer:
        return Layer(self.text[a:b], self.begins[a:b], self.ends[a:b])


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns in one text, leftmost and not overlapping per kind."""
    found = []
    for kind in KINDS:
        pattern, group, least = PATTERNS[kind]
        for match in pattern.finditer(text):
            if match.end(group) - match.start(group) >= least:
                found.append((kind, match.start(), match.end()))
    return found


def scan(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(spans in the text itself, all spans with those of decoded layers), both sorted.

    A worklist holds the layers not yet looked at, as iterators, so that pieces of a large
    layer are made one by one. URL and Unicode codes are decoded wherever they stand, with the
    text around them kept; base64 words also over line breaks. A layer that was seen for the
    same place before is not taken up again, so the work ends. A span inside a decoded layer is
    mapped back to the characters of the original text that hold it.
    """
    base = find(text)
    spans = set(base)
    seen: set[bytes] = set()
    worklist = [_layers(text, lambda a, b: Layer(text[a:b], np.arange(a, b), np.arange(a + 1, b + 1)))]
    while worklist:
        layer = next(worklist[-1], None)
        if layer is None:
            worklist.pop()
            continue
        if not layer.text:
            continue
        place = f"{layer.begins[0]}:{layer.ends[-1]}:"
        mark = hashlib.blake2b((place + layer.text).encode("utf-8", "surrogatepass"), digest_size=16).digest()
        if mark in seen:
            continue
        seen.add(mark)
        for kind, a, b in find(layer.text):
            spans.add((kind, int(layer.begins[a]), int(layer.ends[b - 1])))
        worklist.append(_layers(layer.text, layer.part))
    return sorted(base, key=_place), sorted(spans, key=_place)


def _place(span: tuple[str, int, int]) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def _layers(text: str, part: Callable[[int, int], Layer]) -> Iterator[Layer]:
    """The layers one decoding away from a text; ``part`` cuts stretches out of it."""
    for sign, code, decode in (("%", _URL_RUN, _from_url), ("\\", _ESCAPE, _from_escapes), ("&#", _ESCAPE, _from_escapes)):
        if sign in text and code.search(text):
            for stretch in _STRETCH.finditer(text):
                if code.search(text, *stretch.span()):
                    yield decode(part(*stretch.span()))
    at = 0
    for wrapped in _WRAPPED_WORD.finditer(text) if "\n" in text else ():
        # The last line may be a word of the text that follows.
        for end in (wrapped.end(), text.rindex("\n", *wrapped.span())):
            layers = _from_base64(_without_blanks(part(wrapped.start(), end)))
            first = next(layers, None)
            if first is not None:
                yield from _words(text, part, at, wrapped.start())
                yield first
                yield from layers
                at = end
                break
    yield from _words(text, part, at, len(text))


def _words(text: str, part: Callable[[int, int], Layer], start: int, end: int) -> Iterator[Layer]:
    for word in _BASE64_WORD.finditer(text, start, end):
        yield from _from_base64(part(*word.span()))


def _without_blanks(layer: Layer) -> Layer:
    kept = np.ones(len(layer.text), bool)
    for blank in _BLANKS.finditer(layer.text):
        kept[blank.start() : blank.end()] = False
    return Layer(_BLANKS.sub("", layer.text), layer.begins[kept], layer.ends[kept])


def _from_url(layer: Layer) -> Layer:
    def decoded(match: re.Match) -> list[tuple[str, int, int]]:
        codes = match.group()
        chars = bytes.fromhex(codes.replace("%", "")).decode("utf-8", "replace")
        at, out = match.start(), []
        for char in chars:
            width = 3 * len(char.encode()) if char != "�" else 3
            out.append((char, at, min(at + width, match.end())))
            at = min(at + width, match.end() - 1)
        return out

    return _replaced(layer, _URL_RUN, decoded)


def _from_escapes(layer: Layer) -> Layer:
    def decoded(match: re.Match) -> list[tuple[str, int, int]]:
        hexadecimal = match[1] or match[2] or match[3] or match[5]
        code = int(hexadecimal, 16) if hexadecimal else int(match[4])
        char = chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "�"
        return [(char, *match.span())]

    return _replaced(layer, _ESCAPE, decoded)


def _replaced(layer: Layer, pattern: re.Pattern, decoded: Callable[[re.Match], list[tuple[str, int, int]]]) -> Layer:
    """The layer with each match exchanged for characters that stand for parts of it."""
    chars, firsts, lasts = [], [], []
    at = 0
    for match in pattern.finditer(layer.text):
        a, b = match.span()
        new = decoded(match)
        chars += [layer.text[at:a], *(char for char, _, _ in new)]
        firsts += [np.arange(at, a), [first for _, first, _ in new]]
        lasts += [np.arange(at, a), [last - 1 for _, _, last in new]]
        at = b
    rest = np.arange(at, len(layer.text))
    begins = layer.begins[np.concatenate([*firsts, rest]).astype(np.int64)]
    ends = layer.ends[np.concatenate([*lasts, rest]).astype(np.int64)]
    return Layer("".join([*chars, layer.text[at:]]), begins, ends)


def _from_base64(layer: Layer) -> Iterator[Layer]:
    word = layer.text.rstrip("=")
    try:
        data = base64.b64decode(word.replace("-", "+").replace("_", "/") + "=" * (-len(word) % 4), validate=True)
    except binascii.Error:
        return
    pieces = _plain_pieces(data)
    if pieces is not None:
        # Any part of a compressed layer depends on all of it.
        for text in _cut_at_edges(pieces):
            yield Layer(text, np.broadcast_to(layer.begins[0], len(text)), np.broadcast_to(layer.ends[-1], len(text)))
        return
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return
    if not text or not all(char.isprintable() or char.isspace() for char in text):
        return
    widths = np.array([len(char.encode()) for char in text], np.int64) if not text.isascii() else np.ones(len(text), np.int64)
    following = np.cumsum(widths)
    yield Layer(text, layer.begins[(following - widths) * 8 // 6], layer.ends[(following * 8 - 1) // 6])


def _reader_of(data: bytes) -> Callable | None:
    """What unfolds gzip, zlib, bzip2 or xz data; null for anything else."""
    if data[:2] == b"\x1f\x8b":
        return lambda: zlib.decompressobj(31)
    if data[:1] == b"\x78" and len(data) > 1 and (data[0] * 256 + data[1]) % 31 == 0:
        return zlib.decompressobj
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor
    return None


def _unfolded(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """What compressed data hold, all members of them, up to where they are damaged."""
    pending = next(pieces, b"")
    while (make := _reader_of(pending)) is not None:
        reader = make()
        try:
            while not reader.eof:
                out = reader.decompress(pending, PIECE)
                pending = getattr(reader, "unconsumed_tail", b"")
                if out:
                    yield out
                elif not pending and getattr(reader, "needs_input", True):
                    pending = next(pieces, b"")
                    if not pending:
                        return
        except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError):
            return
        pending = reader.unused_data
        if len(pending) < 6:
            pending += next(pieces, b"")


def _plain_pieces(data: bytes) -> Iterator[bytes] | None:
    """The content of compressed data, also compressed several times over, in pieces.

    Data that unfold to themselves are left at that.
    """
    pieces, first = iter([data]), data
    seen: set[bytes] = set()
    while _reader_of(first) is not None and first not in seen:
        seen.add(first)
        pieces = _unfolded(pieces)
        begun = next(pieces, None)
        if begun is None:
            return None if len(seen) == 1 else iter(())
        first = begun
        pieces = itertools.chain([first], pieces)
    return pieces if seen else None


def _cut_at_edges(pieces: Iterator[bytes]) -> Iterator[str]:
    """The data as texts that end where no stretch goes on."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    held: list[str] = []
    for piece in pieces:
        text = decoder.decode(piece)
        edge = _EDGE.search(text[::-1])
        if edge is None:
            held.append(text)
            continue
        cut = len(text) - edge.start()
        yield "".join([*held, text[:cut]])
        held = [text[cut:]]
    yield "".join([*held, decoder.decode(b"", True)])


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def secrets_found(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base, spans) for every row.

    ``base`` lists kind:start:end of the spans in the text itself, ``spans`` also those in
    decoded layers, by start, then kind. Positions count code points of the whole text. A
    null text is an empty one, an empty table gives none. Every row is looked at by itself, also
    with a repeated or missing doc_id; other columns are ignored. A text is held whole in its task,
    a long one with 16 bytes for each character of a stretch that is decoded. Compressed
    layers are unfolded in pieces of 1 MB, to any size, and all members of them.
    """
    prepare(docs.sparkSession)
    return document_rows(docs).mapInArrow(
        _scan_rows, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base string, spans string"
    )


def _scan_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, list[int]] = {kind: [] for kind in KINDS}
        bases, everything = [], []
        for text in batch.column("text"):
            base, spans = scan(text.as_py())
            kinds = [kind for kind, _, _ in base]
            for kind in KINDS:
                counts[kind].append(kinds.count(kind))
            bases.append(joined(base))
            everything.append(joined(spans))
        numbers = [pa.array(counts[kind], pa.int64()) for kind in KINDS]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *numbers, pa.array(bases, pa.string()), pa.array(everything, pa.string())],
            ["doc_id", "n_assign", "n_access", "n_hex", "base", "spans"],
        )


def redacted(text: str, mark: str = "[secret]") -> str:
    """The text with every span, of whatever layer, exchanged for a mark."""
    out, at = [], 0
    for _, start, end in scan(text)[1]:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])



def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets_found(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")
