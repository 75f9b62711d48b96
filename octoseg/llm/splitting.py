"""Splitting oversized texts: content-defined landmarks snapped to natural boundaries, with overlap."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from octoseg.llm.tokenizer import Encoder, shared_table, spread, worker_encoder
from octoseg.runtime import table

#: Atoms of a pre-token too long for a piece end at landmarks of their letters, or after so many letters.
ATOM = 48
#: Letters or pre-tokens a rolling hash looks back on.
BACK = 6
#: One in so many pre-tokens is a landmark.
SPACING = 192

WORD, SENTENCE, LINE, PARAGRAPH = 1, 2, 3, 4


class Atoms:
    """What a cut must know of a pre-token, looked up once for each distinct one and packed into a whole number:
    tokens (20 bits), flags (8 bits), a hash (32 bits)."""

    STARTS, ENDS, BLANK, NEWLINE, LINES, STOP = (1 << (20 + i) for i in range(6))

    def __init__(self, enc: Encoder) -> None:
        outer = self
        self.enc = enc

        class Cache(dict):
            def __missing__(self, p: str) -> int:
                v = outer._packed(p)
                if len(p) <= 64:
                    if len(self) > enc.keep:
                        self.clear()
                    self[p] = v
                return v

        self.cache = Cache()

    def _packed(self, p: str) -> int:
        return min(len(self.enc.cache[p]), (1 << 20) - 1) | self.marks(p)

    def marks(self, p: str) -> int:
        """Flags and hash, without the number of tokens."""
        v = self.STARTS * p[0].isspace()
        v |= self.ENDS * p[-1].isspace() | self.BLANK * p.isspace()
        v |= self.NEWLINE * (p[-1] == "\n") | self.LINES * (p.count("\n") > 1)
        bare = p.rstrip("\"'”’»)] \t")
        v |= self.STOP * (bare[-1:] in tuple(".!?…。！？"))
        return v | xxhash.xxh32_intdigest(p) << 28


def _cut(piece: str, longest: int = ATOM) -> list[str]:
    """Atoms of a long pre-token: they end where the hash of the last letters says so, at longest letters at the latest."""
    cp = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    roll = np.zeros(len(cp), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(BACK, len(cp))):
            roll[k:] += cp[: len(cp) - k] * np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64))
    ends = (np.flatnonzero((roll >> np.uint64(40)) % np.uint64(32) == 0) + 1).tolist()
    begin, out = 0, []
    for e in [*ends, len(piece)]:
        while e - begin > longest:
            out.append(piece[begin : begin + longest])
            begin += longest
        if e - begin >= 8 or e == len(piece) > begin:
            out.append(piece[begin:e])
            begin = e
    return out


def levels(v: np.ndarray) -> np.ndarray:
    """How natural a cut before each atom is: 4 paragraph, 3 line, 2 sentence, 1 word end, 0 within a word."""
    has = lambda f: (v & f) != 0
    back = lambda x: np.concatenate([[False], x[:-1]])  # noqa: E731  the atom before
    blank, newline, stop = back(has(Atoms.BLANK)), back(has(Atoms.NEWLINE)), has(Atoms.STOP)
    out = (has(Atoms.STARTS) | back(has(Atoms.ENDS))).astype(np.int8)
    sentence = back(stop) | (blank & back(back(stop)))
    out[(out > 0) & sentence] = SENTENCE
    out[newline] = LINE
    out[newline & (back(has(Atoms.LINES)) | (blank & back(back(has(Atoms.NEWLINE)))))] = PARAGRAPH
    return out


def split_text(atoms: Atoms, text: str, most: int = 512, overlap: int = 64, least: int = 128) -> list[tuple[int, int, int, int]]:
    """(start, body, end, tokens) of each piece: text[start:end] has at most `most` tokens, text[start:body] repeats
    the last `overlap` tokens or fewer of the piece before, and the bodies make up the whole text.

    A body ends at the first landmark after `least` tokens, moved to the best boundary near it; without a landmark at
    the last boundary of the best kind that fits. An edit moves the cuts up to the next landmark both versions share.
    """
    if not text:
        return []
    enc = atoms.enc
    parts = enc.find(text)
    v = np.fromiter(map(atoms.cache.__getitem__, parts), dtype=np.int64, count=len(parts))
    sizes = v & 0xFFFFF
    whole = int(sizes.sum())
    if whole <= most:
        return [(0, 0, len(text), whole)]
    room = most - overlap
    limit = max(1, min(room, overlap or room) // 2)
    letters = max(1, min(ATOM, room // 4))  # a letter has four tokens at most
    whole_sizes, group = sizes, np.arange(len(parts))
    is_cut = np.zeros(len(parts), dtype=bool)
    if (sizes > limit).any():
        # tokens of a cut pre-token's atoms are taken in proportion to their letters; count() is exact
        cut = [[p] if n <= limit else _cut(p, letters) for p, n in zip(parts, sizes)]
        each = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
        group, is_cut = np.repeat(group, each), np.repeat(sizes > limit, each)
        v, sizes = v[group], sizes[group]
        parts = [q for qs in cut for q in qs]
        at = np.flatnonzero(is_cut)
        v[at] = [atoms.marks(parts[i]) for i in at]
        long = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        sizes = np.where(is_cut, -(-sizes * long // np.bincount(group, long).astype(np.int64)[group]), sizes)
    m = len(parts)
    starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=m))])
    upto = np.concatenate([[0], np.cumsum(sizes)])
    cuts_upto = np.concatenate([[0], np.cumsum(is_cut)])
    blank = (v & Atoms.BLANK) != 0
    odd_upto = np.concatenate([[0], np.cumsum(is_cut & blank)])
    first = np.searchsorted(group, np.arange(len(whole_sizes) + 1))  # the first atom of each pre-token
    whole_upto = np.concatenate([[0], np.cumsum(whole_sizes)])
    kind = np.concatenate([levels(v), [PARAGRAPH]])
    h, roll = (v >> 28).astype(np.uint64), np.zeros(m, dtype=np.uint64)
    for k in range(min(BACK, m)):
        with np.errstate(over="ignore"):
            roll[k:] += h[: m - k] * np.uint64(pow(0x01000193, k, 1 << 64))
    marks = np.flatnonzero(((roll ^ (roll >> np.uint64(29))) % np.uint64(SPACING)) == 0) + 1

    def count(a: int, b: int) -> int:
        """Tokens of atoms a to b as a text of their own: a blank end is one run there, and of a pre-token that is cut
        only what lies within is encoded anew. A cut run of blanks, or one before an apostrophe, changes how the text falls into
        pre-tokens, so that the whole is encoded."""
        e = b
        while e > a and blank[e - 1]:
            e -= 1
        tail = len(enc.cache["".join(parts[e:b])]) if e < b else 0
        if cuts_upto[b] == cuts_upto[a]:
            return int(upto[e] - upto[a]) + tail
        if odd_upto[b] > odd_upto[a] or e == a or parts[a][0] == "'":
            return enc.count(text[starts[a] : starts[b]])
        one, last = int(group[a]), int(group[e - 1])
        part = lambda i, j: len(enc.cache[text[starts[i] : starts[j]]])
        if one == last:
            return (int(whole_sizes[one]) if first[one] == a and first[one + 1] == e else part(a, e)) + tail
        left = int(whole_sizes[one]) if first[one] == a else part(a, first[one + 1])
        right = int(whole_sizes[last]) if first[last + 1] == e else part(first[last], e)
        return left + int(whole_upto[last] - whole_upto[one + 1]) + right + tail

    pieces: list[tuple[int, int, int, int]] = []
    i, last = 0, 0
    while i < m:
        end = max(i + 1, int(np.searchsorted(upto, upto[i] + room, side="right")) - 1)
        if end < m:
            low = min(end, max(i + 1, int(np.searchsorted(upto, upto[i] + min(least, room // 2)))))
            at = np.searchsorted(marks, low)
            if at < len(marks) and marks[at] < end:
                mark = int(marks[at])
                near = np.arange(max(low, int(np.searchsorted(upto, upto[mark] - 64))), min(end, int(np.searchsorted(upto, upto[mark] + 64, side="right")) - 1) + 1)
                near = near[kind[near] == kind[near].max()]
                end = int(near[np.argmin(np.abs(upto[near] - upto[mark]))])
            else:
                k = kind[low : end + 1]
                end = low + int(np.flatnonzero(k == k.max())[-1])
        start = i
        if pieces:
            start = max(last, int(np.searchsorted(upto, upto[i] - overlap)))
            while start < i and (kind[start] == 0 or count(start, i) > overlap):
                start += 1
        n = count(start, end)
        while n > most and (start < i or end > i + 1):
            if start < i:
                start += 1
            else:
                end -= 1
            n = count(start, end)
        pieces.append((int(starts[start]), int(starts[i]), int(starts[end]), n))
        last, i = start, end
    return pieces


_ATOMS: dict[int, Atoms] = {}


def worker_atoms(enc: Encoder) -> Atoms:
    """This worker's atoms of an encoder."""
    if id(enc) not in _ATOMS:
        _ATOMS.clear()
        _ATOMS[id(enc)] = Atoms(enc)
    return _ATOMS[id(enc)]


def split_texts(df: DataFrame, key: str = "doc_id", text: str = "text", most: int = 512, overlap: int = 64, least: int = 128, path: str | None = None) -> DataFrame:
    """(key, piece, pieces, start, body, end, tokens, text): the ordered pieces of each text, in characters.

    Texts within the limit are one piece; empty and null texts none. One narrow pass over whole texts; other columns
    are ignored; repeated rows give repeated pieces.
    """
    shared = shared_table(df.sparkSession, path)
    kind = df.schema[key].dataType.simpleString()
    names = [key, "piece", "pieces", "start", "body", "end", "tokens", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        atoms = worker_atoms(worker_encoder(shared))
        for b in batches:
            for lot in range(0, b.num_rows, 256):
                part = b.slice(lot, 256)
                rows: list[list] = [[] for _ in range(8)]
                for i, t in enumerate(part.column(1).to_pylist()):
                    if not t:
                        continue
                    got = split_text(atoms, t, most, overlap, least)
                    for j, (s, body, e, n) in enumerate(got):
                        for col, v in zip(rows, (i, j, len(got), s, body, e, n, t[s:e])):
                            col.append(v)
                if rows[0]:
                    ids = part.column(0).take(pa.array(rows[0], pa.int32()))
                    yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.int32()) for c in rows[1:7]), pa.array(rows[7], pa.string())], names=names)

    return spread(df, [key, text]).mapInArrow(run, f"`{key}` {kind}, piece int, pieces int, start int, body int, end int, tokens int, text string")


def p10_found(spark, sf_dir: str) -> DataFrame:
    return split_texts(table(spark, sf_dir, "documents")).where("piece = 1").select("doc_id")


def p10_pieces(spark, sf_dir: str) -> DataFrame:
    return split_texts(table(spark, sf_dir, "documents"))
