"""SentencePiece encoding and decoding by a batched Viterbi over words in numpy.

A text is cut into words where no piece can reach across: before a word mark that follows another character, and
around characters that are in no piece of several characters. Distinct words of one length advance together: at
every position the hashes of all substrings that end there probe the sorted piece keys, and the best predecessor
becomes the backpointer.

 - unigram models: the maximum of the predecessor's score plus the piece's;
 - BPE models: a transition scores 0 if byte-pair merging keeps the boundary between the two pieces and minus
   infinity if it merges across it. That depends on the two pieces alone: undoing their merges from the last to the
   first, the boundary falls if at some point the touching parts make a piece that merges earlier. So exactly one
   path survives the maxima, and it is the one that merging finds.

A BPE word of over _LONG characters is cut into overlapping windows that advance together like words. Two windows that
have a piece in common in their overlap are joined there: as each pair of neighbours is one that merging keeps, the joined
path is the one that merging finds. Without such a piece the windows are doubled.

A word that no piece covers falls back to bytes character by character (or to the unknown id). Words are encoded once
per worker while they stay in a cache of CACHE_WORDS.

Defined cases: a null or empty text has no tokens (and decodes to an empty text); texts of any length are encoded
whole; a literal word mark (U+2581) decodes as a blank, the one text that does not come back as it was; repeated
rows give equal rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.llm.common import bounded, load
from firnline.llm.textkern import mix, powers

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
CACHE_WORDS = 400_000
UNIGRAM, BPE = 1, 2
_NORMAL, _UNKNOWN, _USER, _BYTE = 1, 2, 4, 6
_NEVER = 1 << 40
_MEMO = 1 << 20
_LEAD = 20
_CHUNK_CHARS = 1 << 20
_UNKNOWN_PENALTY = 10.0
_ROWS = 1 << 15  # words of one length that advance together,
_CELLS = 1 << 20  # and their characters
_LONG = 256


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protobuf message; fixed-size ones as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at : at + size]
        at += size


@dataclass
class Vocabulary:
    """A model's tables, small enough to be sent to every worker."""

    pieces: list[str]
    scores: np.ndarray
    kinds: np.ndarray
    model_type: int = UNIGRAM
    dummy_prefix: bool = True
    squeeze: bool = True
    bytes_at: np.ndarray = field(init=False)
    unknown: int = field(init=False)

    def __post_init__(self) -> None:
        self.bytes_at = np.full(256, -1, np.int64)
        for i in np.flatnonzero(self.kinds == _BYTE).tolist():
            self.bytes_at[int(self.pieces[i][3:5], 16)] = i
        self.unknown = int(np.flatnonzero(self.kinds == _UNKNOWN)[0]) if (self.kinds == _UNKNOWN).any() else 0
        usable = (self.kinds == _NORMAL) | (self.kinds == _USER)
        text = [i for i in np.flatnonzero(usable).tolist() if self.pieces[i]]
        self.longest = max(len(self.pieces[i]) for i in text)
        poly, length = self._hashes([self.pieces[i] for i in text])
        self.poly = np.zeros(len(self.pieces), np.uint64)
        self.length = np.zeros(len(self.pieces), np.int64)
        self.poly[text], self.length[text] = poly, length
        keys = mix(poly + length.astype(np.uint64))
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(text, np.int64)[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        # the first key of each value of the leading _LEAD bits, and whether it has more
        lead = (self.keys >> np.uint64(64 - _LEAD)).astype(np.int64)
        self.lead = np.zeros(1 << _LEAD, np.int32)
        self.lead[lead[::-1]] = np.arange(len(lead), dtype=np.int32)[::-1]
        self.shared = np.zeros(1 << _LEAD, bool)
        self.shared[lead[1:][lead[1:] == lead[:-1]]] = True
        several = [self.pieces[i] for i in text if len(self.pieces[i]) > 1]
        if any(MARK in p.lstrip(MARK) for p in several):
            raise ValueError("pieces with a word mark inside are not supported")
        self.joining = "".join(sorted(set("".join(several)) - {MARK}))
        if self.model_type == BPE:
            self._merges(text)

    @staticmethod
    def _hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        power, _ = powers(64)
        out = np.zeros(len(words), np.uint64)
        length = np.array([len(w) for w in words], np.int64)
        for n in np.unique(length).tolist():
            at = np.flatnonzero(length == n)
            code = np.frombuffer("".join(words[i] for i in at.tolist()).encode("utf-32-le"), np.uint32).reshape(-1, n)
            out[at] = ((code.astype(np.uint64) + np.uint64(1)) * power[:n]).sum(axis=1, dtype=np.uint64)
        return out, length

    def _merges(self, text: list[int]) -> None:
        """rank: order of merging by score, -1 for single characters; left, right: the pieces' last merge."""
        several = [i for i in text if len(self.pieces[i]) > 1]
        steps = np.unique(-self.scores[several])
        self.rank = np.full(len(self.pieces), -1, np.int64)
        self.rank[several] = np.searchsorted(steps, -self.scores[several])
        self.left, self.right = np.full(len(self.pieces), -1, np.int64), np.full(len(self.pieces), -1, np.int64)
        self.reachable = np.zeros(len(self.pieces), bool)
        rank_of = {self.pieces[i]: int(self.rank[i]) for i in several}
        id_of = {self.pieces[i]: i for i in text}
        for i in text:
            parts, last = list(self.pieces[i]), None
            while len(parts) > 1:
                best, at = min((rank_of.get(a + b, _NEVER), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
                if best == _NEVER:
                    break
                last = (parts[at], parts[at + 1])
                parts[at : at + 2] = ["".join(last)]
            if len(parts) == 1:
                self.reachable[i] = True
                if last is not None:
                    self.left[i], self.right[i] = (id_of.get(x, -1) for x in last)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        return cls.parse(Path(path).read_bytes())

    @classmethod
    def parse(cls, data: bytes) -> Vocabulary:
        pieces, scores, kinds, options = [], [], [], {}
        for key, value in _fields(data):
            if key == 1:
                entry = dict(_fields(value))
                pieces.append(entry.get(1, b"").decode())
                scores.append(struct.unpack("<f", entry[2])[0] if 2 in entry else 0.0)
                kinds.append(entry.get(3, _NORMAL))
            elif key == 2:
                options["model_type"] = dict(_fields(value)).get(3, UNIGRAM)
            elif key == 3:
                spec = dict(_fields(value))
                if spec.get(2):
                    raise ValueError("models with a character map are not supported")
                options |= {"dummy_prefix": bool(spec.get(3, 1)), "squeeze": bool(spec.get(4, 1))}
        return cls(pieces, np.array(scores), np.array(kinds), **options)


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        v = self.v = vocabulary
        inside = re.escape(v.joining)
        self.cut = re.compile(f"{MARK}*[{inside}]+|{MARK}+|[^{MARK}{inside}]", re.DOTALL)
        self.memo_key = np.zeros(_MEMO, np.uint64)
        self.memo = np.zeros(_MEMO, bool)
        self.power, self.inverse = powers(1 << 16)
        self._clear()
        raw = [bytes([int(p[3:5], 16)]) if k == _BYTE else p.replace(MARK, " ").encode() if k in (_NORMAL, _USER) else b"" for p, k in zip(v.pieces, v.kinds)]
        raw[v.unknown] = " ⁇ ".encode()
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])

    def _clear(self) -> None:
        """Forget all words: at the bound, and at the end of a task, so that idle workers hold little memory."""
        self.known: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.start = np.zeros(1 << 14, np.int64)
        self.used = 0

    def lookup(self, poly: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """Piece ids by hash, -1 where there is none."""
        v = self.v
        key = mix(poly + np.asarray(length).astype(np.uint64))
        lead = (key >> np.uint64(64 - _LEAD)).astype(np.int64)
        at = v.lead[lead]
        out = np.where(v.keys[at] == key, v.ids[at], -1)
        again = (out < 0) & v.shared[lead]
        if again.any():
            rest = key[again]
            at = np.minimum(np.searchsorted(v.keys, rest), len(v.keys) - 1)
            out[again] = np.where(v.keys[at] == rest, v.ids[at], -1)
        return out

    def kept(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging keeps the boundary between pieces a and b (-1: a character without a piece)."""
        out = np.ones(len(a), bool)
        both = np.flatnonzero((a >= 0) & (b >= 0))
        key = (a[both].astype(np.uint64) << np.uint64(32)) | (b[both].astype(np.uint64) + np.uint64(1))
        slot = (mix(key) & np.uint64(_MEMO - 1)).astype(np.int64)
        hit = self.memo_key[slot] == key
        out[both[hit]] = self.memo[slot[hit]]
        if not hit.all():
            miss = both[~hit]
            new, back = np.unique(key[~hit], return_inverse=True)
            value = self._kept((new >> np.uint64(32)).astype(np.int64), (new & np.uint64(0xFFFFFFFF)).astype(np.int64) - 1)
            out[miss] = value[back]
            slot = (mix(new) & np.uint64(_MEMO - 1)).astype(np.int64)
            self.memo_key[slot], self.memo[slot] = new, value
            clash = self.memo_key[slot] != new  # of two that share a slot, the one that stays must match its value
            self.memo_key[slot[clash]] = 0
        return out

    def _kept(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        v = self.v
        out, limit, at = np.ones(len(a), bool), np.full(len(a), _NEVER), np.arange(len(a))
        while len(at):
            joined = self.lookup(v.poly[a] + v.poly[b] * self.power[v.length[a]], v.length[a] + v.length[b])
            falls = (joined >= 0) & (v.rank[joined] < limit)
            out[at[falls]] = False
            ra, rb = v.rank[a], v.rank[b]
            more = ~falls & ((ra >= 0) | (rb >= 0))
            a, b, ra, rb, at = a[more], b[more], ra[more], rb[more], at[more]
            undo_a = ra > rb  # of equal ranks the right one merges later
            limit = np.where(undo_a, ra, rb + 1)
            a, b = np.where(undo_a, v.right[a], a), np.where(undo_a, b, v.left[b])
            whole = (a >= 0) & (b >= 0)
            a, b, limit, at = a[whole], b[whole], limit[whole], at[whole]
        return out

    def _paths(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Viterbi over words of one length (rows of code points): piece and its length at each end position."""
        v, (n, size) = self.v, code.shape
        total = np.zeros((n, size + 1), np.uint64)
        np.cumsum((code.astype(np.uint64) + np.uint64(1)) * self.power[:size], axis=1, out=total[:, 1:])
        piece = np.full((n, size + 1), -1, np.int64)
        back = np.zeros((n, size + 1), np.int64)
        best = np.full((n, size + 1), -np.inf)
        best[:, 0] = 0
        low = float(v.scores[v.kinds == _NORMAL].min()) - _UNKNOWN_PENALTY
        for i in range(1, size + 1):
            k = np.arange(1, min(i, v.longest) + 1)
            found = self.lookup((total[:, i : i + 1] - total[:, i - k]) * self.inverse[i - k], k)
            if v.model_type == BPE:
                found[:, 1:][~v.reachable[found[:, 1:]]] = -1
                ok = (found >= 0) & np.isfinite(best[:, i - k])
                ok[:, 0] = np.isfinite(best[:, i - 1])
                row, col = np.nonzero(ok & (i - k > 0))
                keep = self.kept(piece[row, i - k[col]], found[row, col])
                ok[row[~keep], col[~keep]] = False
                score = np.where(ok, 0.0, -np.inf)
            else:
                step = np.where(found >= 0, v.scores[found], -np.inf)
                step[:, 0] = np.where(found[:, 0] >= 0, step[:, 0], low)
                score = best[:, i - k] + step
            pick = score.argmax(axis=1)
            rows = np.arange(n)
            best[:, i], piece[:, i], back[:, i] = score[rows, pick], found[rows, pick], pick + 1
        return piece, back

    def _best(self, group: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of words of one length, from the right end of each row (-1: a character without a piece), and
        which places of the rows are used."""
        code = np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, size)
        if size > len(self.power) - 1:
            self.power, self.inverse = powers(size + 1)
        piece, back = self._paths(code)
        n = len(group)
        path, pos, rows = np.full((n, size), -2, np.int64), np.full(n, size), np.arange(n)
        for step in range(size - 1, -1, -1):
            open_ = pos > 0
            if not open_.any():
                break
            path[:, step] = np.where(open_, piece[rows, pos], -2)
            pos = np.where(open_, pos - back[rows, pos], 0)
        return path, path > -2

    def _encode_words(self, words: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        """(words, their ids in a row, number of ids of each), a group of equal length at a time."""
        length = np.array([len(w) for w in words])
        if self.v.model_type == BPE and (length > _LONG).any():
            long = [words[i] for i in np.flatnonzero(length > _LONG).tolist()]
            for word, path in zip(long, self._long_paths(long)):
                ids = self._fallback(word, path) if (path < 0).any() else path
                yield [word], ids, np.array([len(ids)])
            words = [w for w in words if len(w) <= _LONG]
            length = np.array([len(w) for w in words])
        for size in np.unique(length).tolist():
            where = np.flatnonzero(length == size)
            at_once = max(1, min(_ROWS, _CELLS // size))
            for first in range(0, len(where), at_once):
                group = [words[i] for i in where[first : first + at_once].tolist()]
                path, used = self._best(group, size)
                lone = (path == -1).any(axis=1)
                yield [group[i] for i in np.flatnonzero(~lone).tolist()], path[~lone][used[~lone]], used[~lone].sum(axis=1)
                for i in np.flatnonzero(lone).tolist():
                    ids = self._fallback(group[i], path[i][used[i]])
                    yield [group[i]], ids, np.array([len(ids)])

    def _long_paths(self, words: list[str]) -> list[np.ndarray]:
        """The pieces of long words by windows of `size` characters that overlap by a quarter; the windows of all words
        advance together."""
        out: list = [None] * len(words)
        todo, size = list(range(len(words))), _LONG
        while todo:
            for i in [i for i in todo if len(words[i]) <= size]:
                path, used = self._best([words[i]], len(words[i]))
                out[i] = path[0][used[0]]
            todo = [i for i in todo if len(words[i]) > size]
            step = size - size // 4
            windows = [(i, s) for i in todo for s in [*range(0, len(words[i]) - size, step), len(words[i]) - size]]
            # of each word what is joined so far: finished parts, starts and pieces of the last; None: no common piece
            joined: dict[int, list | None] = {}
            at_once = max(1, _CELLS // size)
            for first in range(0, len(windows), at_once):
                mine = windows[first : first + at_once]
                path, used = self._best([words[i][s : s + size] for i, s in mine], size)
                for k, (i, start) in enumerate(mine):
                    piece = path[k][used[k]]
                    length = np.where(piece >= 0, self.v.length[piece], 1)
                    at = start + np.cumsum(length) - length
                    state = joined.setdefault(i, [[], at, piece])
                    if state is None or state[1] is at:
                        continue
                    parts, before, pieces = state
                    common = np.intersect1d(before << 24 | (pieces + 1), at << 24 | (piece + 1), assume_unique=True)
                    if not len(common):
                        joined[i] = None
                        continue
                    join = common[0] >> 24
                    parts.append(pieces[before <= join])
                    joined[i] = [parts, at[at > join], piece[at > join]]
            for i in todo:
                if joined[i] is not None:
                    out[i] = np.concatenate([*joined[i][0], joined[i][2]])
            todo = [i for i in todo if joined[i] is None]
            size *= 2
        return out

    def _fallback(self, word: str, path: np.ndarray) -> np.ndarray:
        ids, at = [], 0
        for p in path.tolist():
            if p >= 0:
                ids.append(p)
                at += int(self.v.length[p])
                continue
            raw = word[at].encode("utf-8", "replace")
            if self.v.bytes_at[raw[0]] >= 0:
                ids += self.v.bytes_at[list(raw)].tolist()
            elif not (ids and ids[-1] == self.v.unknown and self.v.model_type == UNIGRAM):
                ids.append(self.v.unknown)
            at += 1
        return np.array(ids, np.int64)

    def _learn(self, words: list[str]) -> None:
        for group, ids, sizes in self._encode_words(words):
            n, end = len(self.known), self.used + len(ids)
            while end > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            while n + len(group) + 1 > len(self.start):
                self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.flat[self.used : end] = ids
            self.start[n : n + len(group) + 1] = self.used + np.concatenate([[0], np.cumsum(sizes)])
            self.used = end
            self.known.update(zip(group, range(n, n + len(group))))

    def normalise(self, text: str) -> str:
        if self.v.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return (MARK if self.v.dummy_prefix else "") + text.replace(" ", MARK)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of all texts."""
        words: list[str] = []
        ends = [0]
        for t in texts:
            words += self.cut.findall(self.normalise(t))
            ends.append(len(words))
        if len(self.known) > CACHE_WORDS:
            self._clear()
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            self._learn(new)
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        first, sizes = self.start[at], self.start[at + 1] - self.start[at]
        before = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.repeat(first - before[:-1], sizes) + np.arange(before[-1])]
        return ids, before[np.array(ends)]

    def decode_bytes(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes and offsets of each sequence; the blank of the dummy prefix is taken off."""
        sizes = self.raw_at[ids + 1] - self.raw_at[ids]
        before = np.concatenate([[0], np.cumsum(sizes)])
        data = self.raw[np.repeat(self.raw_at[ids] - before[:-1], sizes) + np.arange(before[-1])]
        ends = before[offsets]
        if self.v.dummy_prefix:
            head = ends[:-1][(np.diff(ends) > 0)]
            head = head[data[head] == 32]
            gone = np.zeros(len(data) + 1, np.int64)
            gone[head + 1] = 1
            gone = np.cumsum(gone)
            data = np.delete(data, head)
            ends = ends - gone[ends]
        return data, ends

    def decode(self, sequences: list) -> list[str]:
        sizes = [len(s) for s in sequences]
        ids = np.concatenate([np.asarray(s, np.int64) for s in sequences]) if sum(sizes) else np.zeros(0, np.int64)
        data, ends = self.decode_bytes(ids, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
        raw = data.tobytes()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


_ENCODERS: dict[int, Encoder] = {}


def _encoder(sent) -> Encoder:
    """One encoder, with its caches, per worker and model."""
    if sent.id not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[sent.id] = Encoder(sent.value)
    return _ENCODERS[sent.id]


class _Sent:
    """A broadcast vocabulary with an id that survives pickling."""

    def __init__(self, spark: SparkSession, vocabulary: Vocabulary):
        self.handle = spark.sparkContext.broadcast(vocabulary)
        self.id = hash((spark.sparkContext.applicationId, self.handle._jbroadcast.id()))

    @property
    def value(self) -> Vocabulary:
        return self.handle.value

    def __getstate__(self):
        return {"handle": self.handle, "id": self.id}


def _text_chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    part, size, at = [], 0, 0
    for i, t in enumerate(texts):
        part.append(t or "")
        size += len(part[-1])
        if size >= _CHUNK_CHARS:
            yield at, part
            part, size, at = [], 0, i + 1
    if part:
        yield at, part


def encode_documents(docs: DataFrame, path: str = MODEL_PATH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, tokens (array of ids), n_bytes (of the decoded text) and round_trip (whether decoding gives the
    text back)."""
    sent = _Sent(docs.sparkSession, Vocabulary.read(path))

    def encode(encoder: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id = batch.column("doc_id")
            for at, part in _text_chunks(batch.column("text").to_pylist()):
                ids, offsets = encoder.encode(part)
                data, ends = encoder.decode_bytes(ids, offsets)
                raw = [t.encode("utf-8", "surrogatepass") for t in part]
                size = np.diff(ends)
                same = size == np.array([len(r) for r in raw])
                if same.all():
                    wrong = np.concatenate([[0], np.cumsum(data != np.frombuffer(b"".join(raw), np.uint8))])
                    same = wrong[ends[1:]] == wrong[ends[:-1]]
                else:
                    back = data.tobytes()
                    same = np.array([r == back[a:b] for r, a, b in zip(raw, ends[:-1].tolist(), ends[1:].tolist())])
                tokens = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [doc_id.slice(at, len(part)), pa.array(np.diff(offsets)), tokens, pa.array(size), pa.array(same)],
                    ["doc_id", "n_tokens", "tokens", "n_bytes", "round_trip"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent)
        try:
            yield from encode(encoder, batches)
        finally:
            encoder._clear()

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_tokens long, tokens array<int>, n_bytes long, round_trip boolean")


@bounded
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(load(spark, sf_dir, "documents"))


@bounded
def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token ids."""
    del spark, sf_dir
    return encode_documents(docs)
