"""Exact sentencepiece (merge type) encoding by backtracking, and decoding.

Merge-type encoding repeatedly joins the best-scored adjacent pair. Its result is the only sequence of
pieces in which every adjacent pair is *compatible*: encoding the two pieces' text alone gives back the
two pieces. So instead of merging, each stretch of text is matched left to right with the longest piece
of an Aho-Corasick trie, falling back to the next shorter prefix when the piece does not fit its left
neighbour, and stepping back when no prefix fits; a bitfield keeps positions known to fail. Compatibility
is found by undoing the merges of the two pieces along their shared edge, and remembered.

A text is first cut where no piece can reach across: between a non-blank and a blank, and
between characters that no piece has side by side. Each distinct stretch is encoded once per worker
(bounded memory), so the cost follows the distinct words.
"""

from __future__ import annotations

import hashlib
import re
import sys
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wakeline.llm.columns import appended, cleared, extended
from wakeline.llm.tokenizers_io import broadcast_file, piece_model
from wakeline.session import ship_package

BLANK = "▁"
CACHE_ENTRIES = 800_000
CACHED_CHARS = 64
UNKNOWN_TEXT = " ⁇ "


class Memory:
    """Bounded map of stretches to packed ids. When half is full the older half is dropped, so
    what is asked for often stays."""

    def __init__(self, entries: int):
        self.half = max(1, entries // 2)
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def put(self, key: str, ids: bytes) -> None:
        if len(self.new) >= self.half:
            self.old, self.new = self.new, {}
        self.new[key] = ids

    def older(self, key: str) -> bytes | None:
        ids = self.old.get(key)
        if ids is not None:
            self.put(key, ids)
        return ids


class PieceCodec:
    """Encoder and decoder for one model. Supports merge-type models with byte fallback that change
    blanks only (no other normalisation), as checked on construction."""

    def __init__(self, model: bytes):
        sp = piece_model(model)
        n = sp.vocab_size()
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        kinds = [sp.is_control(i) or sp.is_unknown(i) for i in range(n)]
        self.byte_ids = [0] * 256
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.score = [sp.get_score(i) for i in range(n)]
        self.raw = np.empty(n, dtype=object)
        self.id_of: dict[str, int] = {}
        self.is_byte = np.zeros(n, dtype=bool)
        self.is_control = np.array([sp.is_control(i) for i in range(n)], dtype=bool)
        for i, p in enumerate(self.pieces):
            if sp.is_byte(i):
                self.byte_ids[int(p[3:-1], 16)] = i
                self.is_byte[i] = True
                self.raw[i] = bytes([int(p[3:-1], 16)])
            elif kinds[i]:
                self.raw[i] = UNKNOWN_TEXT.encode() if sp.is_unknown(i) else b""
            else:
                self.id_of[p] = i
                self.raw[i] = p.replace(BLANK, " ").encode()
        probe = " AÅﬁＡé  b\tc\n "
        if sp.normalize(probe) != BLANK + probe.replace(" ", BLANK):
            raise ValueError("the model normalises more than blanks; this codec does not")
        if any(BLANK in p.lstrip(BLANK) for p in self.id_of):
            raise ValueError("the model has pieces that reach across a blank")
        inside = [p for p in self.id_of if len(p) > 1]
        joining = {c for p in inside for c in p} - {BLANK}
        late = {c for p in inside for a, c in zip(p, p[1:]) if a.isalnum()}
        # Characters that never come right after a letter or digit within a piece: a stretch ends before them.
        first = {c for c in joining if not c.isalnum() and c not in late}
        body = "".join(re.escape(c) for c in sorted(joining - first))
        lead = "".join(re.escape(c) for c in sorted(first))
        word = "".join(re.escape(c) for c in sorted(c for c in joining if c.isalnum()))
        self.stretch = re.compile(
            f"{BLANK}*[{word}]+(?![{body}])|{BLANK}*[{body}{lead}]+|{BLANK}+|[^{BLANK}{body}{lead}]")
        self.trie = ahocorasick.Automaton()
        # For every prefix of a piece: the longest piece that is a prefix of it.
        self.best: dict[str, int] = {}
        for p in self.id_of:
            for k in range(len(p), 0, -1):
                self.trie.add_word(p[:k], 0)
                self.best.setdefault(p[:k], -1)
        for p in sorted(self.best, key=len):
            self.best[p] = self.id_of.get(p, self.best.get(p[:-1], -1))
        self.width = max(map(len, self.id_of))
        self.length = [len(p) for p in self.pieces]
        # The longest piece that is a proper prefix of each piece; -1 if there is none.
        self.shorter = [self.best.get(p[:-1], -1) for p in self.pieces]
        self.split: dict[int, tuple[int, int] | None] = {}
        self.fits: dict[int, bool] = {}
        self.known = Memory(CACHE_ENTRIES // 4)
        self.units = Memory(CACHE_ENTRIES)

    def _last_merge(self, token: int) -> tuple[int, int] | None:
        """The pair whose merge made the piece when encoded alone; None for single characters."""
        if token not in self.split:
            p = self.pieces[token]
            self.split[token] = None
            parts = list(p)
            while len(parts) > 2:
                best, at = None, -1
                for k in range(len(parts) - 1):
                    i = self.id_of.get(parts[k] + parts[k + 1])
                    if i is not None and (best is None or self.score[i] > best):
                        best, at = self.score[i], k
                if at < 0:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            if len(parts) == 2:
                self.split[token] = (self.id_of[parts[0]], self.id_of[parts[1]])
        return self.split[token]

    def _fits(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left`` (-1: nothing before it)."""
        ok = self._whole(right) and (left < 0 or self._remerge(left, right))
        self.fits[left << 20 | right] = ok
        return ok

    def _remerge(self, left: int, right: int) -> bool:
        """Whether merging the text of both pieces, alone, ends in just these two pieces.

        The merges inside each piece happen in order of score, then position. The pieces on
        the shared edge at any time are those on the right spine of ``left`` and the left spine of
        ``right``; the pair fails if, while both edge pieces exist, they could join before either is
        taken up by its own next merge.
        """
        never = float("-inf")
        edge_left, edge_right = [left], [right]
        while (s := self._last_merge(edge_left[-1])) is not None:
            edge_left.append(s[1])
        while (s := self._last_merge(edge_right[-1])) is not None:
            edge_right.append(s[0])
        a, b = len(edge_left) - 1, len(edge_right) - 1
        while True:
            joined = self.id_of.get(self.pieces[edge_left[a]] + self.pieces[edge_right[b]])
            cross = self.score[joined] if joined is not None else never
            up_left = self.score[edge_left[a - 1]] if a else never
            up_right = self.score[edge_right[b - 1]] if b else never
            # Equal scores go leftmost first: left's own merge starts before the edge, right's after it.
            if joined is not None and cross > up_left and cross >= up_right:
                return False
            if not a and not b:
                return True
            if a and (not b or up_left >= up_right):
                a -= 1
            else:
                b -= 1

    def _backtrack(self, text: str) -> list[int]:
        """Pieces of one stretch in which every character is a piece of its own."""
        longest, best, width, length, fits = self.trie.longest_prefix, self.best, self.width, self.length, self.fits
        shorter, n, failed = self.shorter, len(text), 0
        out: list[int] = []
        pos, last = 0, -1
        part = text if n <= width else text[:width]
        token = best[part[:longest(part)]]
        while True:
            end = pos + length[token]
            ok = fits.get(last << 20 | token)
            if ok is None:
                ok = self._fits(last, token)
            if ok and not (failed and failed >> end & 1):
                out.append(token)
                if end == n:
                    return out
                pos, last = end, token
                part = text[pos:pos + width]
                token = best[part[:longest(part)]]
                continue
            token = shorter[token]
            while token < 0:
                # Nothing fits here: mark the position and shorten the piece before it.
                failed |= 1 << pos
                token = out.pop()
                pos -= length[token]
                last = out[-1] if out else -1
                token = shorter[token]

    def _whole(self, token: int) -> bool:
        """Whether the piece is what its own text encodes to (else it never occurs)."""
        return len(self.pieces[token]) == 1 or self._last_merge(token) is not None

    def _stretch_ids(self, part: str) -> bytes:
        if len(part) > 1 or part in self.id_of:
            return array("I", self._backtrack(part)).tobytes()
        return array("I", [self.byte_ids[b] for b in part.encode()]).tobytes()

    def _remembered(self, memory: Memory, key: str, part: str) -> bytes:
        ids = memory.new.get(key)
        if ids is None:
            ids = memory.older(key)
            if ids is None:
                ids = self._stretch_ids(part)
                if len(part) <= CACHED_CHARS:
                    memory.put(key, ids)
        return ids

    def _unit(self, unit: str) -> bytes:
        """Packed ids of one blank and a blank-free text after it that is not in ``units.new``."""
        ids = self.units.older(unit)
        if ids is None:
            text = BLANK + unit
            parts = self.stretch.findall(text)
            ids = self._stretch_ids(text) if len(parts) == 1 else self._joined(parts)
            if len(unit) <= CACHED_CHARS:
                self.units.put(unit, ids)
        return ids

    def _joined(self, parts: list[str]) -> bytes:
        out = []
        for part in parts:
            rest = part[1:]
            if rest and part[0] == BLANK and rest[0] != BLANK:
                out.append(self._remembered(self.units, rest, part))
            else:
                out.append(self._remembered(self.known, part, part))
        return b"".join(out)

    def encode_packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, without begin and end ids."""
        if not text:
            return b""
        if BLANK in text or "  " in text or text[0] == " " or text[-1] == " ":
            return self._joined(self.stretch.findall(BLANK + text.replace(" ", BLANK)))
        # Single blanks only: every blank starts a stretch.
        known, out = self.units.new, []
        for unit in text.split(" "):
            ids = known.get(unit)
            if ids is None:
                ids = self._unit(unit)
                known = self.units.new
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str | None, begin_end: bool = True) -> np.ndarray:
        ids = np.frombuffer(self.encode_packed(text or ""), dtype="<u4")
        if begin_end:
            ids = np.concatenate([[self.bos], ids, [self.eos]]).astype("<u4")
        return ids

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids: control ids vanish, the first blank is dropped, and bytes that
        form no character become U+FFFD each."""
        if len(ids) == 0:
            return ""
        try:
            # A control id between two bytes keeps them from forming a character.
            apart = self.is_control[ids[1:-1]].any() and self.is_byte[ids].any()
            text = self._decode_bytes(ids) if apart else b"".join(self.raw[ids].tolist()).decode()
        except UnicodeDecodeError:
            text = self._decode_bytes(ids)
        return text[1:] if text[:1] == " " and self._blank_first(ids) else text

    def _blank_first(self, ids: np.ndarray) -> bool:
        for i in ids[:8]:
            if self.raw[i]:
                return self.pieces[i][:1] == BLANK
        rest = [i for i in ids if self.raw[i]]
        return bool(rest) and self.pieces[rest[0]][:1] == BLANK

    def _decode_bytes(self, ids: np.ndarray) -> str:
        out, run = [], bytearray()

        def flush() -> None:
            k = 0
            while k < len(run):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[k:k + n]).decode())
                        k += n
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    k += 1
            run.clear()

        for i in ids:
            if self.is_byte[i]:
                run += self.raw[i]
            else:
                flush()
                out.append(self.raw[i].decode())
        flush()
        return "".join(out)


if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("packed ids are written as little-endian unsigned 32-bit integers")

_CODECS: dict[int, PieceCodec] = {}


def codec(model: bytes) -> PieceCodec:
    """The codec of a model, one per Python worker, so its memory of stretches outlives a task."""
    key = hash(model)
    if key not in _CODECS:
        _CODECS[key] = PieceCodec(model)
    return _CODECS[key]


def encoded(docs: DataFrame, model_path: str, text: str = "text", with_ids: bool = True, with_text: bool = True,
            prefix: str = "") -> DataFrame:
    """``docs`` plus, each named with ``prefix``: n_tokens, ids_sha256, decoded_sha256, and on request
    ``ids`` (array of int, with begin and end ids) and ``decoded`` (their text).

    Null text is encoded as empty (begin and end ids only). Every row is on its own, so repeated
    rows, long texts and hot sources need no care; other columns pass through; one
    with the name of an output is replaced by it (``prefix`` keeps it).
    """
    spark = docs.sparkSession
    ship_package(spark)
    model = broadcast_file(spark, model_path)
    fields = [("n_tokens", "long", pa.int64()), ("ids_sha256", "string", pa.string()), ("decoded_sha256", "string", pa.string())]
    if with_ids:
        fields.append(("ids", "array<int>", pa.list_(pa.int32())))
    if with_text:
        fields.append(("decoded", "string", pa.string()))
    docs = cleared(docs, [prefix + n for n, _, _ in fields])
    schema = extended(docs, [(prefix + n, t) for n, t, _ in fields])

    def run(batches):
        c = codec(model.value)
        for batch in batches:
            rows = []
            for x in batch.column(batch.schema.get_field_index(text)):
                ids = c.encode(x.as_py())
                back = c.decode(ids)
                row = [len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()]
                rows.append(row + ([ids] if with_ids else []) + ([back] if with_text else []))
            cols = [pa.array([r[k] for r in rows], t) for k, (_, _, t) in enumerate(fields)]
            yield appended(batch, [prefix + n for n, _, _ in fields], cols)

    return docs.mapInArrow(run, schema)
