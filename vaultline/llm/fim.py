"""Fill-in-the-middle transformation over seekable compressed frames.

A text is stored as independent zstandard frames of at most ``FRAME`` units
(code points) with two running totals: the units and the compressed bytes up to
each frame's end. A unit is found by a search in the totals and by
decompressing the one frame that holds it. The transformation decompresses only
the (at most two) frames that the cuts fall into; all others go to the output
as they are, compressed, in their new order, since frames are independent. Digests
stream the frames in order, one decompressed at a time. Restoring reads the
output alone: it looks for the markers frame by frame and puts the ranges
between them back in order.

Scale: a row per document from end to end and no shuffle. A text is whole in
memory only where it enters; after that, a row's compressed frames and one frame.

Defined results: a null text is empty (plain); a null doc_id is hashed as the
empty string; repeated rows are transformed alike, each; an empty table gives an
empty result; texts of any length are handled alike.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import materialize, text_or_empty

FRAME, LEVEL, SEED = 16_384, 3, 1
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_SHARE, SPM_SHARE = 90, 20  # h3 % 100 from this on: plain; h4 % 100 below this: suffix first
MARKER = re.compile("|".join(map(re.escape, (PREFIX, SUFFIX, MIDDLE))))


class Frames:
    """A text as independent frames. ``units[i]`` and ``ends[i]`` are the units
    and the compressed bytes up to the end of frame i."""

    def __init__(self, data: bytes = b"", units: Iterable[int] = (), ends: Iterable[int] = ()):
        self.data, self.units, self.ends = bytearray(data), list(units), list(ends)

    @classmethod
    def of(cls, text: str, size: int = FRAME) -> Frames:
        out = cls()
        for i in range(0, len(text), size):
            out.add(text[i:i + size])
        return out

    @property
    def n(self) -> int:
        return self.units[-1] if self.units else 0

    def _append(self, frame: bytes, units: int) -> None:
        self.data += frame
        self.units.append(self.n + units)
        self.ends.append(len(self.data))

    def add(self, text: str) -> None:
        if text:
            # Lone surrogates cannot come out of a text column; other code points all encode.
            self._append(_compressor().compress(text.encode("utf-8")), len(text))

    def _raw(self, i: int) -> bytes:
        return bytes(self.data[self.ends[i - 1] if i else 0:self.ends[i]])

    def frame(self, i: int) -> str:
        return _decompressor().decompress(self._raw(i)).decode("utf-8")

    def ranges(self, start: int, end: int) -> Iterator[tuple[int, int, int]]:
        """(frame, from, to) of the frames that hold units ``start`` to ``end``."""
        i = bisect_right(self.units, start)
        while start < end:
            first = self.units[i - 1] if i else 0
            to = min(end, self.units[i])
            yield i, start - first, to - first
            start, i = to, i + 1

    def stream(self, start: int = 0, end: int | None = None) -> Iterator[str]:
        for i, a, b in self.ranges(start, self.n if end is None else end):
            yield self.frame(i)[a:b]

    def copy(self, other: Frames, start: int, end: int) -> None:
        """Append a range of ``other``: whole frames stay compressed, cut ones are cut."""
        for i, a, b in other.ranges(start, end):
            size = other.units[i] - (other.units[i - 1] if i else 0)
            if b - a == size:
                self._append(other._raw(i), size)
            else:
                self.add(other.frame(i)[a:b])

    def sha256(self, *parts: tuple[int, int]) -> str:
        """Digest of the whole text, or of ranges of units one after the other."""
        digest = hashlib.sha256()
        for start, end in parts or [(0, self.n)]:
            for piece in self.stream(start, end):
                digest.update(piece.encode("utf-8"))
        return digest.hexdigest()


_TOOLS: dict = {}


def _compressor():
    import zstandard
    return _TOOLS.setdefault("c", zstandard.ZstdCompressor(level=LEVEL))


def _decompressor():
    import zstandard
    return _TOOLS.setdefault("d", zstandard.ZstdDecompressor())


class Cut(NamedTuple):
    form: str                   # plain, psm or spm
    first: int                  # units before the middle
    second: int                 # units before the suffix


def choose(doc_id, n: int, marked: bool, seed: int = SEED) -> Cut:
    """Form and cuts of a document, from the digest of its id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or marked or h3 % 100 >= PLAIN_SHARE:
        return Cut("plain", 0, 0)
    return Cut("spm" if h4 % 100 < SPM_SHARE else "psm", first, second)


def rearrange(text: Frames, cut: Cut) -> Frames:
    """The output's frames."""
    out = Frames()
    if cut.form == "plain":
        out.copy(text, 0, text.n)
        return out
    prefix, suffix = (PREFIX, 0, cut.first), (SUFFIX, cut.second, text.n)
    for marker, start, end in (suffix, prefix) if cut.form == "spm" else (prefix, suffix):
        out.add(marker)
        out.copy(text, start, end)
    out.add(MIDDLE)
    out.copy(text, cut.first, cut.second)
    return out


def parts(output: Frames, form: str) -> list[tuple[int, int]]:
    """The ranges of units of ``output`` that make up the text, in its order."""
    if form == "plain":
        return [(0, output.n)]
    found: dict[str, int] = {}
    at, tail = 0, ""
    for piece in output.stream():
        seen = tail + piece  # a marker may lie across frames
        base = at - len(tail)
        for m in MARKER.finditer(seen):
            found.setdefault(m.group(), base + m.start())
        at += len(piece)
        tail = seen[-(len(PREFIX) - 1):]
    order = sorted(found, key=found.__getitem__)
    end = dict(zip(order, [found[m] for m in order[1:]] + [output.n]))
    return [(found[m] + len(m), end[m]) for m in (PREFIX, MIDDLE, SUFFIX)]


def restore(output: Frames, form: str) -> Iterator[str]:
    """The text again, from the output and its form."""
    for start, end in parts(output, form):
        yield from output.stream(start, end)


STORED = "n long, marked boolean, units array<long>, ends array<long>, data binary"


def store(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", frame: int = FRAME) -> DataFrame:
    """(doc_id, n, marked, units, ends, data): texts as frames with their running
    totals; ``marked``: the text holds a marker itself."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            n, marked, units, ends, data = [], [], [], [], []
            for value in b.column(1):  # one text at a time
                t = value.as_py()
                f = Frames.of(t, frame)
                n.append(f.n), marked.append(MARKER.search(t) is not None)
                units.append(f.units), ends.append(f.ends), data.append(bytes(f.data))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(marked, pa.bool_()), pa.array(units, pa.list_(pa.int64())),
                 pa.array(ends, pa.list_(pa.int64())), pa.array(data, pa.binary())],
                names=["doc_id", "n", "marked", "units", "ends", "data"])

    return rows.mapInArrow(run, f"doc_id {kind}, {STORED}")


def transform(stored: DataFrame, seed: int = SEED, output: bool = True) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256,
    restored_sha256) and, with ``output``, the output's frames (units, ends,
    data). restored_sha256 is read back from the output's frames alone."""
    kind = stored.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, "
              "restored_sha256 string" + (", units array<long>, ends array<long>, data binary" if output else ""))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            out: list[list] = [[] for _ in range(9)]
            for i, doc, n, marked, units, ends, data in zip(range(len(b)), *(b.column(c) for c in range(6))):
                f = Frames(data.as_py(), units.as_py(), ends.as_py())
                cut = choose(doc.as_py(), n.as_py(), marked.as_py(), seed)
                made = rearrange(f, cut)
                plain = cut.form == "plain"
                row = (cut.form, None if plain else cut.first, None if plain else cut.second - cut.first, made.sha256(),
                       made.sha256(*parts(made, cut.form)))
                for column, value in zip(out, row + ((made.units, made.ends, bytes(made.data)) if output else ())):
                    column.append(value)
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            kinds += [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()] if output else []
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, k) for c, k in zip(out, kinds))],
                                             names=[x.split()[0] for x in schema.split(", ")])

    return stored.select("doc_id", "n", "marked", "units", "ends", "data").mapInArrow(run, schema)


def read_output(transformed: DataFrame, restored: bool = False) -> DataFrame:
    """(doc_id, text): the outputs as text, or the texts restored from them."""
    kind = transformed.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            texts = []
            for form, units, ends, data in zip(*(b.column(c) for c in range(1, 5))):
                f = Frames(data.as_py(), units.as_py(), ends.as_py())
                texts.append("".join(restore(f, form.as_py()) if restored else f.stream()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return transformed.select("doc_id", "form", "units", "ends", "data").mapInArrow(run, f"doc_id {kind}, text string")


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", output: bool = True) -> DataFrame:
    """Store ``docs`` as frames, then transform what was stored."""
    return transform(materialize(store(docs, doc_id, text), "fim-frames"), output=output)
