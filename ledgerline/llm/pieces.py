"""SentencePiece encoding and decoding (operator 6), with offsets kept.

Encoding: the text is normalised by longest-prefix replacement through the model's compiled
character map, and every normalised character records where in the original bytes it came from;
the normalised text is merged into pieces by score; every piece is projected through the
alignment to the original byte span it stands for.  Characters outside the vocabulary become
byte pieces.  Decoding is the library's decode(ids).

A model whose map is empty (as that of the registered query) replaces nothing, and the same
alignment is then plain arithmetic: prefix sums of the characters' bytes.  Pieces never continue over
the start of a run of spaces, nor mix letters with other signs (the loader checks the vocabulary), so
merging runs per part of that kind; of parts seen before, the pieces (id, first and last character)
are remembered in a bounded table.  The registered query takes its digests from the aligned pieces:
their ids, the text that those ids decode to, and their byte spans.

Defined cases.  Null and empty texts have no ids and decode to the empty text.  Repeated rows and
null ids pass through; extra columns are not looked at.  A part of any length is merged with a
heap, so one very long word costs n log n.  Very long texts are encoded whole.  An empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import operator
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kernel import slices
from .tables import table

SPACE = "▁"
REMEMBERED = 120_000
#: Longer parts are merged with a heap, and longer ones still are not remembered.
SHORT_PART = 24
LONGEST_REMEMBERED = 64
#: Bytes of a row (id, first, end) of an entry.
_ROW = 12


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 bytes, and replacement texts."""

    def __init__(self, blob: bytes):
        (size,) = struct.unpack_from("<I", blob)
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement of the longest mapped prefix of ``data[at:]`` and the prefix's length."""
        units, found, node = self.units, None, 0
        node ^= self._offset(units[0])
        for k in range(at, len(data)):
            node ^= data[k]
            unit = units[node]
            if unit & 0x800000FF != data[k]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = (units[node] & 0x7FFFFFFF, k + 1 - at)
        if found is None:
            return None
        start = found[0]
        return self.texts[start : self.texts.index(b"\0", start)], found[1]

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 0x200) >> 6)


class Joins:
    """Joining of many short parts at once.

    A symbol's code is its place among all pieces and all characters of pieces; other characters
    have codes after those.  The table of joins holds every way to cut a piece into two symbols,
    by an open-addressed hash of both codes.
    """

    def __init__(self, scores: dict[str, float]):
        self.names = [*scores, *sorted({c for p in scores for c in p} - set(scores))]
        code = {n: i for i, n in enumerate(self.names)}
        size = len(self.names)
        self.of_char = np.arange(0x110000, dtype=np.int32) + size
        for n, i in code.items():
            if len(n) == 1:
                self.of_char[ord(n)] = i
        # The smaller the rank the sooner the join; equal scores have equal ranks.
        rank = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        cuts = [
            (code[p[:k]] << 32 | code[p[k:]], rank[s], code[p])
            for p, s in scores.items()
            for k in range(1, len(p))
            if p[:k] in code and p[k:] in code
        ]
        self.bits = max(4, (4 * len(cuts)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.full(1 << self.bits, self.NEVER, np.int32)
        self.joined = np.zeros(1 << self.bits, np.int32)
        key, ranks, joined = (np.array(c, np.int64) for c in zip(*cuts, strict=True)) if cuts else [np.zeros(0, np.int64)] * 3
        at, left, self.probes = self._slot(key), np.arange(len(key)), 1
        while len(left):
            free = self.keys[at[left]] == -1
            self.keys[at[left[free]]] = key[left[free]]  # of several, the last one gets the slot
            mine = self.keys[at[left]] == key[left]
            self.rank[at[left[mine]]], self.joined[at[left[mine]]] = ranks[left[mine]], joined[left[mine]]
            left = left[~mine]
            if len(left):
                at[left] = (at[left] + 1) & (len(self.keys) - 1)
                self.probes += 1

    NEVER = np.iinfo(np.int32).max

    def _slot(self, key: np.ndarray) -> np.ndarray:
        mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of joining a and b (``NEVER`` if they don't join), and the joined symbols."""
        key = a.astype(np.int64) << 32 | b
        at = self._slot(key)
        open_ = np.flatnonzero((self.keys[at] != key) & (self.keys[at] != -1))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            open_ = open_[(self.keys[at[open_]] != key[open_]) & (self.keys[at[open_]] != -1)]
        hit = self.keys[at] == key
        return np.where(hit, self.rank[at], self.NEVER), self.joined[at]

    def merge(self, parts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Symbol codes of the (non-empty) parts; one join a round in every part that has one left.  They come
        a few thousand parts at a time: the parts' numbers, their codes one after another, and how many
        each has."""
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        order = np.argsort(lengths, kind="stable")
        for some in np.array_split(order, max(1, len(order) // 4096)):
            width = int(lengths[some].max(initial=0))
            if not width:
                continue
            text = "".join([parts[k] for k in some])
            codes = self.of_char[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
            cells = np.arange(width) < lengths[some][:, None]
            symbols = np.full((len(some), width + 1), -1, np.int32)
            symbols[:, :-1][cells] = codes
            ranks = np.full((len(some), width + 1), self.NEVER, np.int32)
            both = cells[:, 1:]
            ranks[:, : width - 1][both] = self.find(symbols[:, : width - 1][both], symbols[:, 1:width][both])[0]
            live, counts = np.arange(len(some)), lengths[some].copy()
            steps = np.arange(width + 1)
            while len(live):
                best = ranks[live].argmin(axis=1)
                go = ranks[live, best] != self.NEVER
                live, best = live[go], best[go]
                if not len(live):
                    break
                _, joined = self.find(symbols[live, best], symbols[live, best + 1])
                # Close the gap: what stands right of the join moves one to the left.
                source = np.minimum(steps + (steps > best[:, None]), width)
                symbols[live] = np.take_along_axis(symbols[live], source, 1)
                ranks[live] = np.take_along_axis(ranks[live], np.minimum(steps + (steps >= best[:, None]), width), 1)
                symbols[live, best] = joined
                counts[live] -= 1
                for at in (best - 1, best):
                    ok = np.flatnonzero((at >= 0) & (at + 1 < counts[live]))
                    row, col = live[ok], at[ok]
                    ranks[row, col] = self.find(symbols[row, col], symbols[row, col + 1])[0]
                ends = np.flatnonzero(best + 1 >= counts[live])
                ranks[live[ends], best[ends]] = self.NEVER
            yield some, symbols[steps < counts[:, None]], counts


class PieceModel:
    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec, trainer = proto.normalizer_spec, proto.trainer_spec
        if proto.pieces and trainer.model_type != 2:
            raise ValueError("only BPE models are supported")
        if trainer.treat_whitespace_as_suffix:
            raise ValueError("models with spaces at word ends are not supported")
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.prefix, self.squeeze, self.escape = (
            spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces,
        )
        self.space = SPACE if self.escape else " "
        self.names = [p.piece for p in proto.pieces]
        self.kinds = [p.type for p in proto.pieces]
        self.plain = [k == 1 for k in self.kinds]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 1}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == 1}
        self.unknown = next((i for i, k in enumerate(self.kinds) if k == 2), 0)
        self.unknown_text = trainer.unk_surface
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == 6}
        if any(k in (4, 5) for k in self.kinds) or any(self.space in p.lstrip(self.space) for p in self.ids):
            raise ValueError("user-defined pieces and pieces over several words are not supported")
        s = re.escape(self.space)
        self.parts = re.compile(f"{s}*[^{s}]+|{s}+")
        # Two neighbours that occur side by side in no piece are never joined, so parts may be cut
        # between letters and other signs where no piece has both side by side.
        letter = re.compile(r"[^\W\d_]")
        pairs = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        if not any(a != self.space and bool(letter.match(a)) != bool(letter.match(b)) for a, b in pairs):
            self.parts = re.compile(rf"{s}*[^\W\d_]+|{s}*(?:[\W\d_](?<!{s}))+|{s}+")
        self.joins = Joins(self.scores)
        # By a piece's code: its id and its characters; by an id: its decimal text, and what it decodes to.
        self.id_of = np.array([self.ids[p] for p in self.scores], np.int32)
        self.width_of = np.array([len(p) for p in self.scores], np.int32)
        self.decimal = [str(i) for i in range(len(self.names))]
        bytes_of = {1: lambda n: n.replace(SPACE, " ").encode(), 6: lambda n: bytes([int(n[3:5], 16)])}
        self.shown = [bytes_of[k](n) if k in bytes_of else None for n, k in zip(self.names, self.kinds, strict=True)]
        # The pieces of parts: rows of (id, first character, character after the last) in the part.
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    # -- normalisation ---------------------------------------------------------------------------

    def normalise(self, text: str) -> tuple[str, list[int]]:
        """Normalised text, and for each of its characters (and its end) the byte of the original
        text that it came from."""
        data = text.encode()
        out: list[str] = []
        source: list[int] = []
        at, blank = 0, self.squeeze
        steps = []
        while at < len(data):
            hit = self.map.longest(data, at) if self.map else None
            if hit is None:
                size = 1 + (data[at] >= 0xC0) + (data[at] >= 0xE0) + (data[at] >= 0xF0)
                hit = (data[at : at + size], size)
            steps.append((at, hit[0].decode(errors="replace")))
            at += hit[1]
        if self.squeeze:  # leading blanks go before the prefix is set
            k = 0
            while k < len(steps) and steps[k][1] == " ":
                k += 1
            steps = steps[k:]
        if not steps:
            return "", [0]
        if self.prefix:
            out.append(self.space)
            source.append(steps[0][0])
        for begin, new in steps:
            if blank:
                new = new.lstrip(" ")
            for c in new:
                out.append(self.space if c == " " else c)
                source.append(begin)
            if new or not blank:
                blank = self.squeeze and new.endswith(" ")
        source.append(len(data))
        if self.squeeze:
            while out and out[-1] == self.space:
                out.pop()
                source[-2:] = [source[-2]]
        return "".join(out), source

    # -- merging ---------------------------------------------------------------------------------

    def merge(self, parts) -> dict[str, list[str]]:
        """Each part as symbols: the best-scored neighbouring pair is joined, leftmost first."""
        short = [p for p in parts if len(p) <= SHORT_PART]
        names, n = self.joins.names, len(self.joins.names)
        out = {p: [] for p in short}
        for some, codes, counts in self.joins.merge(short):
            symbols, at = [names[c] if c < n else chr(c - n) for c in codes.tolist()], 0
            for k, many in zip(some.tolist(), counts.tolist(), strict=True):
                out[short[k]] = symbols[at : at + many]
                at += many
        return out | {p: self._merge_long(p) for p in parts if len(p) > SHORT_PART}

    def _merge_long(self, part: str) -> list[str]:
        score, symbols, n = self.scores.get, list(part), len(part)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[float, int, str]] = []

        def offer(i: int, j: int) -> None:
            joined = symbols[i] + symbols[j]
            s = score(joined)
            if s is not None:
                heapq.heappush(heap, (-s, i, joined))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = after[i]
            if j < 0 or not symbols[i] or symbols[i] + symbols[j] != joined:
                continue
            symbols[i], symbols[j] = joined, ""
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
                offer(i, after[j])
            if before[i] >= 0:
                offer(before[i], i)
        return [s for s in symbols if s]

    def symbol_ids(self, symbol: str) -> list[int]:
        known = self.ids.get(symbol)
        if known is not None:
            return [known]
        return [self.bytes[b] for b in symbol.encode()] if self.bytes else [self.unknown]

    def encode(self, text: str) -> list[tuple[int, int, int]]:
        """(id, first byte, end byte) of every piece, in bytes of the original text.  The byte
        pieces of one character share its span."""
        ids, spans = self.aligned([text])[0]
        return [(i, a, b) for i, (a, b) in zip(ids.tolist(), spans.tolist(), strict=True)]

    # -- decoding --------------------------------------------------------------------------------

    def decode(self, ids: list[int], leading: bool = True) -> str:
        """Text of ids; ``leading``: they begin a text, so the prefix (or leading space) goes."""
        if not leading and all(self.plain[i] for i in ids):
            return "".join([self.names[i] for i in ids]).replace(SPACE, " ")
        out: list[str] = []
        run = bytearray()

        def flush():
            if run:
                out.append(run.decode(errors="replace"))
                run.clear()

        for i in ids:
            kind = self.kinds[i]
            if kind == 6:
                run.append(int(self.names[i][3:5], 16))
                continue
            flush()
            if kind == 2:
                out.append(self.unknown_text)
            elif kind != 3:
                name = self.names[i]
                if leading and not any(out) and (self.prefix or self.squeeze) and name.startswith(SPACE):
                    name = name[1:]
                    leading = self.squeeze
                out.append(name.replace(SPACE, " "))
        flush()
        return "".join(out)

    def decode_all(self, ids: list[int]) -> str:
        """``decode`` of the ids of a whole text; where they are pieces and bytes only, their bytes are joined
        at once (a run of bytes and the pieces around it decode alike apart and together)."""
        if not ids:
            return ""
        if self.squeeze:
            return self.decode(ids)
        shown = _items(self.shown, ids)
        if None in shown:
            return self.decode(ids)
        text = b"".join(shown).decode(errors="replace")
        return text[1:] if self.prefix and self.names[ids[0]].startswith(SPACE) else text

    # -- aligned pieces of many texts --------------------------------------------------------------

    def _entry(self, symbols: list[str]) -> bytes:
        """The pieces of a part, from its symbols."""
        rows, at = [], 0
        for symbol in symbols:
            rows += [(i, at, at + len(symbol)) for i in self.symbol_ids(symbol)]
            at += len(symbol)
        return np.array(rows, np.int32).tobytes()

    def _learn(self, parts: set[str]) -> dict[str, bytes]:
        """Entries of parts that are not among the young ones."""
        old = self.old
        found = {p: old[p] for p in parts if p in old}
        short = [p for p in parts if p not in found and len(p) <= SHORT_PART]
        for some, codes, counts in self.joins.merge(short):
            # Entries of all parts at once; those with other symbols than pieces are made anew below.
            cuts = np.cumsum(counts) - counts
            whole = np.maximum.reduceat(codes, cuts) < len(self.scores)
            codes = np.where(codes < len(self.scores), codes, 0)
            ends = np.cumsum(self.width_of[codes])
            ends -= np.repeat(ends[cuts] - self.width_of[codes[cuts]], counts)
            table = np.stack([self.id_of[codes], ends - self.width_of[codes], ends], axis=1).astype(np.int32).tobytes()
            for k, x, n, ok in zip(some.tolist(), (_ROW * cuts).tolist(), (_ROW * counts).tolist(), whole.tolist(), strict=True):
                if ok:
                    found[short[k]] = table[x : x + n]
        found |= {p: self._entry(s) for p, s in self.merge([p for p in parts if p not in found]).items()}
        if len(self.young) + len(found) > REMEMBERED:
            self.old, self.young = self.young, {}
        if len(found) <= REMEMBERED:
            self.young |= {p: e for p, e in found.items() if len(p) <= LONGEST_REMEMBERED}
        return found

    def _normal(self, text: str) -> tuple[str, np.ndarray]:
        """``normalise``, with the alignment as an array."""
        if self.map is not None or self.squeeze or not self.escape or not self.prefix:
            normal, source = self.normalise(text)
            return normal, np.array(source, np.int64)
        if not text:
            return "", np.zeros(1, np.int64)
        # Nothing is replaced but the spaces: a character comes from where its bytes begin.
        code = np.frombuffer(text.encode("utf-32-le"), "<u4")
        source = np.zeros(len(text) + 2, np.int64)
        if code.max() < 0x80:
            source[2:] = np.arange(1, len(text) + 1)
        else:
            np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000), out=source[2:])
        return SPACE + text.replace(" ", SPACE), source

    def aligned(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The pieces of whole texts: their ids, and rows (first byte, end byte).

        Parts that are not remembered are merged together, over about a million characters of text
        at a time.
        """
        out: list[tuple[np.ndarray, np.ndarray]] = []
        group, size = [], 0
        for text in texts:
            group.append(self._normal(text))
            size += len(text)
            if size > 1 << 20:
                out += self._aligned(group)
                group, size = [], 0
        return out + self._aligned(group)

    def _aligned(self, texts: list[tuple[str, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
        cut = [self.parts.findall(t) for t, _ in texts]
        known = self.young
        known = known | self._learn(set().union(*cut).difference(known))
        out = []
        for (_, source), parts in zip(texts, cut, strict=True):
            entries = _items(known, parts)
            rows = np.frombuffer(b"".join(entries), np.int32).reshape(-1, 3)
            width = np.array(list(map(len, parts)), np.int32)
            pieces = np.array(list(map(len, entries)), np.int32) // _ROW
            first = np.repeat(np.cumsum(width) - width, pieces)
            out.append((rows[:, 0], source[rows[:, 1:] + first[:, None]]))
        return out

    def round_trips(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(number of ids, decimal ids joined by commas, decoded text) of whole texts."""
        return [self._round_trip(ids.tolist()) for ids, _ in self.aligned(texts)]

    def _round_trip(self, ids: list[int]) -> tuple[int, str, str]:
        return len(ids), ",".join(_items(self.decimal, ids)), self.decode_all(ids)


def _items(found, keys: list) -> tuple:
    """``found[k]`` of all keys."""
    return operator.itemgetter(*keys)(found) if len(keys) > 1 else tuple(found[k] for k in keys)


_LOADED: dict[str, PieceModel] = {}


def model_of(path: str) -> PieceModel:
    if path not in _LOADED:
        with open(path, "rb") as f:  # the vocabulary file is installed on every machine
            _LOADED[path] = PieceModel(f.read())
    return _LOADED[path]


_DIGEST = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, spans_crc32 bigint"


def _digests(path: str):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def run(batches):
        model = model_of(path)
        for batch in slices(batches, 512):
            found = model.aligned([t or "" for t in batch.column("text").to_pylist()])
            rows = [model._round_trip(ids.tolist()) for ids, _ in found]
            spans = [zlib.crc32(s.astype("<u4").tobytes()) for _, s in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([sha(r[1]) for r in rows], pa.string()), pa.array([sha(r[2]) for r in rows], pa.string()),
                    pa.array(spans, pa.int64()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"],
            )

    return run


def _spans(path: str):
    def run(batches):
        model = model_of(path)
        for batch in slices(batches, 512):
            found = model.aligned([t or "" for t in batch.column("text").to_pylist()])
            bounds = np.cumsum([0, *(len(ids) for ids, _ in found)])
            ids = np.concatenate([i for i, _ in found]).astype(np.int32)
            spans = np.concatenate([s for _, s in found]).astype(np.int32)
            pieces = pa.StructArray.from_arrays([pa.array(c) for c in (ids, spans[:, 0], spans[:, 1])], names=["id", "begin", "end"])
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pieces)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "pieces"])

    return run


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, pieces) of every row: ids with the byte spans of the original text."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(_spans(model), "doc_id bigint, pieces array<struct<id: int, begin: int, end: int>>")


def digests(docs: DataFrame, model: str) -> DataFrame:
    """Of every row: its pieces' number, the hash of their ids and of what these decode to, and the
    crc32 of their byte spans (begin, end; little-endian unsigned 32-bit)."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(_digests(model), _DIGEST)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), vocabulary())
