"""SentencePiece encoding with seeded merge dropout, and decoding."""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm.common import mix, prepare

MODEL = os.environ.get("SILTLINE_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
#: Part of the candidate merges that are skipped, and the seed of the choice.
DROPOUT, SEED = 0.1, 20240229
#: Results that a worker remembers: words with the choices that were made for them. It also forgets at 16 times as many ids or characters.
CACHE = 600_000
#: Choices of an occurrence that are drawn at once, two bytes each; further ones are hashed where a long word needs them.
DRAWN = 32
#: Words up to this length are merged along a list, longer ones with a heap; both give the same pieces.
SHORT = 48
_SPACE = "▁"
_NEVER = 1 << 30
_ALL = (1 << 64) - 1
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: Characters of texts whose new words are segmented together, about, and words that are looked at at once.
TOGETHER, ROWS = 1 << 19, 1 << 13


class _Agenda:
    """The agenda of many short words at a time: a row for each word, its symbols and the ranks of neighbours in columns. In each turn
    every word takes its next candidate, the leftmost of the best, and merges or skips it."""

    def __init__(self, rank: dict[str, int], ids: dict[str, int]):
        symbols = [p for p, _ in sorted(rank.items(), key=lambda x: x[1])]  # what merges make is numbered in the order of ranks
        symbols += sorted({c for p in symbols for c in p} | {p for p in ids if len(p) == 1})
        self.number = {p: n for n, p in enumerate(symbols)}
        self.single = np.full(0x110000, -1, np.int32)  # by code point
        for p, n in self.number.items():
            if len(p) == 1:
                self.single[ord(p)] = n
        self.id = np.array([ids.get(p, -1) for p in symbols], np.int32)
        pairs = {(self.number[p[:i]] << 20) | self.number[p[i:]]: self.number[p] for p in rank for i in range(1, len(p)) if p[:i] in self.number and p[i:] in self.number}
        self.bits = max(8, (8 * len(pairs)).bit_length())
        self.pairs = np.full(1 << self.bits, -1, np.int64)  # at their hash, or in the next free place
        self.made = np.full(1 << self.bits, _NEVER, np.int32)
        for pair, at in zip(pairs, self._hash(np.array(list(pairs), np.int64)).tolist(), strict=True):
            while self.pairs[at] >= 0:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.pairs[at], self.made[at] = pair, pairs[pair]

    def _hash(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.view(np.uint64) * _SPREAD) >> np.uint64(64 - self.bits)).view(np.int64)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """What neighbours merge to; numbers below zero are no symbols."""
        want = (a.astype(np.int64) << 20) | b
        want[(a < 0) | (b < 0)] = -1  # found in the first free place, which makes nothing
        at = self._hash(want)
        out, there = self.made[at], self.pairs[at]
        late = np.nonzero((there != want) & (there >= 0))
        out[(there != want) & (there < 0)] = _NEVER
        while len(late[0]):
            at[late] = (at[late] + 1) & ((1 << self.bits) - 1)
            there = self.pairs[at[late]]
            out[late] = np.where(there == want[late], self.made[at[late]], _NEVER)
            late = tuple(x[(there != want[late]) & (there >= 0)] for x in late)
        return out

    def segment(self, words: list[tuple[str, int]]) -> list[bytes | None]:
        """Packed ids of words for their choices; None where a symbol has no id."""
        out: list[bytes | None] = [None] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i][0]))
        for at in range(0, len(order), ROWS):
            own = order[at:at + ROWS]
            ids, size, whole = self.rows([words[i][0] for i in own], np.array([words[i][1] for i in own], np.uint64))
            edge = np.cumsum(size).tolist()
            for i, a, b, w in zip(own, [0, *edge], edge, whole.tolist(), strict=False):
                out[i] = ids[a:b].astype("<i4").tobytes() if w else None
        return out

    def rows(self, units: list[str], mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words in the order of their lengths one after another, the number of each word's, and whether all its symbols have one."""
        n, width = len(units), max(2, len(units[-1]))
        size = np.fromiter(map(len, units), np.int64, n)
        flat = self.single[np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)]
        column = np.arange(width)
        there = column < size[:, None]
        symbol = np.full((n, width + 1), -1, np.int32)
        symbol[:, :width][there] = flat
        rank = self._rank(symbol[:, :-1], symbol[:, 1:])  # of a column and the one after it
        after = np.tile(np.arange(1, width + 2, dtype=np.int16), (n, 1))
        before = np.tile(np.arange(-1, width, dtype=np.int16), (n, 1))
        mask, live = mask.copy(), np.arange(n)
        while len(live):
            own = rank[live]
            k = own.argmin(1)
            best = own[np.arange(len(live)), k]
            going = best < _NEVER
            live, k, best = live[going], k[going], best[going]
            skipped = (mask[live] & np.uint64(1)).astype(bool)
            mask[live] >>= np.uint64(1)
            rank[live[skipped], k[skipped]] = _NEVER
            row, left, made = live[~skipped], k[~skipped], best[~skipped]
            right = after[row, left]
            beyond = np.minimum(after[row, right], width)
            symbol[row, left], symbol[row, right] = made, -2
            after[row, left] = beyond
            before[row, beyond] = left
            inside = right < width
            rank[row[inside], right[inside]] = _NEVER
            rank[row, left] = self._rank(made, symbol[row, beyond])
            first = before[row, left]
            has = first >= 0
            rank[row[has], first[has]] = self._rank(symbol[row[has], first[has]], made[has])
        kept = symbol[:, :width][there]
        word = np.repeat(np.arange(n), size)[kept != -2]
        kept = kept[kept != -2]
        ids = np.where(kept >= 0, self.id[kept], -1)
        whole = np.ones(n, bool)
        whole[word[ids < 0]] = False
        return ids, np.bincount(word, minlength=n), whole


class _Numbers(dict):
    """Words and their numbers; a new one gets the next."""

    def __init__(self):
        self.words: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self.words)
        self.words.append(word)
        return n


class _Rows:
    """Arrays of numbers one after another, found by their place in the order they were added."""

    def __init__(self):
        self.flat, self.edge, self.n = np.empty(1 << 12, np.int32), np.zeros(1 << 10, np.int64), 0

    def add(self, flat: np.ndarray, size: np.ndarray) -> None:
        at, n = int(self.edge[self.n]), self.n + len(size)
        if at + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat[:at], np.empty(at + 2 * len(flat), np.int32)])
        if n >= len(self.edge):
            self.edge = np.concatenate([self.edge[:self.n + 1], np.empty(n + len(size), np.int64)])
        self.flat[at:at + len(flat)] = flat
        self.edge[self.n + 1:n + 1] = at + np.cumsum(size)
        self.n = n

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of rows one after another, and where each row ends among them."""
        size = self.edge[rows + 1] - self.edge[rows]
        end = np.cumsum(size)
        return self.flat[np.repeat(self.edge[rows] - end + size, size) + np.arange(end[-1] if len(end) else 0)], end


class Pieces:
    """A merge-type model: pieces with byte fallback, better pieces have higher scores."""

    def __init__(self, model: bytes, dropout: float = DROPOUT, seed: int = SEED):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ids: dict[str, int] = {}
        self.rank: dict[str, int] = {}
        self.raw: list[bytes] = []
        self.byte = [0] * 256
        merged: list[tuple[float, int, str]] = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte[value] = i
                self.raw.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.raw.append(b"")
            else:
                self.ids[piece] = i
                self.raw.append(piece.replace(_SPACE, " ").encode())
                merged.append((-sp.get_score(i), i, piece))
        self.rank = {p: n for n, (_, _, p) in enumerate(sorted(merged)) if len(p) > 1}
        self._agenda = _Agenda(self.rank, self.ids)
        self.limit, self.seed = round(dropout * 65536), seed
        self._spell = np.array([*self.raw, None], object)[:-1]
        self._forget()
        self._packed = [i.to_bytes(4, "little") for i in range(len(self.raw))]
        self._spelled = [self._packed[i] for i in self.byte]
        self._unit = re.compile(f"\n|{_SPACE}+[^{_SPACE}\n]*|[^{_SPACE}\n]+")

    def _forget(self) -> None:
        """Words by number with their lengths, and the ids of words by number and choices."""
        self._numbers, self._length, self._known, self._ids = _Numbers(), np.zeros(0, np.int64), {}, _Rows()

    def _draws(self, key: int, n: int) -> list[int]:
        """For each of ``n`` words of a document a number whose bit k says whether its k-th candidate merge is skipped."""
        return self._drawn(np.full(n, key, np.uint64), np.arange(n)).tolist()

    def _drawn(self, keys: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The same for words of many documents, by the key of the document and the place in it."""
        out = np.zeros(len(keys), np.uint64)
        own, seed = np.arange(DRAWN // 4, dtype=np.uint64), np.uint64(self.seed)
        for at in range(0, len(keys) if self.limit else 0, 1 << 12):
            numbers = (places[at:at + (1 << 12), None].astype(np.uint64) * np.uint64(DRAWN // 4) + own) ^ keys[at:at + (1 << 12), None]
            draws = mix(mix(numbers) ^ seed).view(np.uint16)
            out[at:at + (1 << 12)] = np.packbits(draws < self.limit, axis=1, bitorder="little").view("<u4").ravel()
        return out

    def _more(self, unit: str, key: int, place: int, mask: int) -> int:
        """The choices of a word that may need more than are drawn at once: four for each character."""
        k = np.arange(len(unit), dtype=np.uint64)
        draws = mix(mix(mix(k ^ np.uint64(key)) + np.uint64(place)) ^ np.uint64(self.seed)).view(np.uint16)
        return mask | int.from_bytes(np.packbits(draws < self.limit, bitorder="little").tobytes(), "little") << DRAWN

    def _segment(self, unit: str, mask: int) -> bytes:
        """Packed ids of the symbols that are left when no candidate merge is."""
        if not unit:
            return b"".join(self._spelled[b] for b in _SPACE.encode())
        symbols = self._merge_short(unit, mask) if len(unit) <= SHORT else self._merge_long(unit, mask)
        out, ids, packed = [], self.ids, self._packed
        for s in symbols:
            if (i := ids.get(s)) is not None:
                out.append(packed[i])
            else:
                out += [self._spelled[b] for b in s.encode()]
        return b"".join(out)

    def _merge_short(self, unit: str, mask: int) -> list[str]:
        """The agenda as a list of ranks, one for each pair of neighbours; its least entry is next, the leftmost first."""
        get = self.rank.get
        symbols = list(unit)
        agenda = [get(unit[i:i + 2], _NEVER) for i in range(len(unit) - 1)]
        while agenda and (r := min(agenda)) < _NEVER:
            k = agenda.index(r)
            skipped, mask = mask & 1, mask >> 1
            if skipped:
                agenda[k] = _NEVER
                continue
            symbols[k] += symbols.pop(k + 1)
            del agenda[k]
            if k < len(agenda):
                agenda[k] = get(symbols[k] + symbols[k + 1], _NEVER)
            if k:
                agenda[k - 1] = get(symbols[k - 1] + symbols[k], _NEVER)
        return symbols

    def _merge_long(self, unit: str, mask: int) -> list[str]:
        """The agenda as a heap ordered by rank and place."""
        rank, n, turn = self.rank, len(unit), 0
        bits = np.unpackbits(np.frombuffer(mask.to_bytes(mask.bit_length() // 8 + 1, "little"), np.uint8), bitorder="little").tolist()
        text: list[str | None] = list(unit)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            if (r := rank.get(unit[i:i + 2])) is not None:
                agenda.append((r, i, i + 1, 2))
        heapq.heapify(agenda)
        while agenda:
            r, i, j, size = heapq.heappop(agenda)
            if text[i] is None or j >= n or text[j] is None or after[i] != j or len(text[i]) + len(text[j]) != size:
                continue  # one of its symbols has gone into another merge
            turn += 1
            if turn <= len(bits) and bits[turn - 1]:
                continue
            text[i] += text[j]
            text[j] = None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank.get(text[i] + text[k])) is not None:
                    heapq.heappush(agenda, (r, i, k, size + len(text[k])))
            if (h := before[i]) >= 0 and (r := rank.get(text[h] + text[i])) is not None:
                heapq.heappush(agenda, (r, h, i, size + len(text[h])))
        return [s for s in text if s is not None]

    def _choices(self, units: list[str], length: np.ndarray, keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, dict[int, int]]:
        """For each word the choices that can count for it: at most one for each merge and for each one skipped before. Those that
        need more bits than are drawn at once are given by the word's position."""
        masks, wide = self._drawn(keys, places), {}
        least = np.maximum(length - 1, 0)
        n = np.minimum(least, DRAWN)
        low = lambda n: (np.uint64(1) << n.astype(np.uint64)) - np.uint64(1)
        while ((more := np.minimum(least + np.bitwise_count(masks & low(n)), DRAWN)) > n).any():
            n = more
        out = masks & low(n)
        if self.limit:
            for i in np.flatnonzero(least + np.bitwise_count(out) > DRAWN).tolist():
                n_all = first = int(least[i])
                mask = self._more(units[i], int(keys[i]), int(places[i]), int(masks[i]))
                while (more := first + (mask & ((1 << n_all) - 1)).bit_count()) > n_all:
                    n_all = more
                mask &= (1 << n_all) - 1
                if mask >> DRAWN:
                    wide[i] = mask
                else:
                    out[i] = mask
        return out, wide

    def _units(self, text: str) -> list[str]:
        """The words of a text, each with its mark; a literal mark is an empty one."""
        units = []
        for k, part in enumerate(text.split(_SPACE)):
            if k:
                units.append("")
            elif not part:
                units += [_SPACE] if text else []
            marked = part.replace(" ", _SPACE)
            units += self._unit.findall(_SPACE + marked if part and not k else marked)
        return units

    def _learn(self, units: list[str], masks: list[int]) -> np.ndarray:
        """Segments words with their choices, the short ones many at a time; the rows of ``_ids`` that hold the results."""
        rows = np.empty(len(units), np.int64)
        order = sorted(range(len(units)), key=lambda i: len(units[i]))
        for at in range(0, len(order), ROWS):
            own = order[at:at + ROWS]
            rows[own] = np.arange(self._ids.n, self._ids.n + len(own))
            short = [i for i in own if 0 < len(units[i]) <= SHORT and masks[i] <= _ALL]
            ids, size, whole = self._agenda.rows([units[i] for i in short], np.array([masks[i] for i in short], np.uint64)) if short else (np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, bool))
            if len(short) == len(own) and whole.all():
                self._ids.add(ids, size)
                continue
            edge = np.cumsum(size).tolist()
            done = {i: ids[a:b] for i, a, b, w in zip(short, [0, *edge], edge, whole.tolist(), strict=False) if w}
            parts = [done[i] if i in done else np.frombuffer(self._segment(units[i], masks[i]), "<i4") for i in own]
            self._ids.add(np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts)))
        return rows

    def _rows_of(self, numbers: np.ndarray, masks: np.ndarray) -> np.ndarray:
        """Rows of ``_ids`` for words by number and choices of at most 32 bits."""
        asked, back = np.unique(numbers.astype(np.uint64) << np.uint64(DRAWN) | masks, return_inverse=True)
        rows = np.fromiter(map(self._known.get, asked.tolist(), repeat(-1)), np.int64, len(asked))
        new = np.flatnonzero(rows < 0)
        words, wanted = self._numbers.words, asked[new]
        rows[new] = self._learn([words[i] for i in (wanted >> np.uint64(DRAWN)).tolist()], (wanted & np.uint64((1 << DRAWN) - 1)).tolist())
        self._known.update(zip(wanted.tolist(), rows[new].tolist(), strict=True))
        return rows[back]

    def _encode_words(self, units: list[str], counts: list[int], keys: list[int]) -> list[bytes]:
        """Ids of texts, given as the words of all one after another, how many each has, and its key."""
        n, known = len(units), len(self._length)
        numbers = np.fromiter(map(self._numbers.__getitem__, units), np.int64, n)
        new = self._numbers.words[known:]
        self._length = np.concatenate([self._length, np.fromiter(map(len, new), np.int64, len(new))])
        last = np.cumsum(counts)
        places = np.arange(n) - np.repeat(last - counts, counts)
        masks, wide = self._choices(units, self._length[numbers], np.repeat(np.array(keys, np.uint64), counts), places)
        rows, narrow = np.empty(n, np.int64), np.ones(n, bool)
        narrow[list(wide)] = False
        rows[narrow] = self._rows_of(numbers[narrow], masks[narrow])
        if wide:
            rare = {x: k for k, x in enumerate(dict.fromkeys((units[i], m) for i, m in wide.items()))}
            learned = self._learn([u for u, _ in rare], [m for _, m in rare])
            rows[list(wide)] = learned[[rare[units[i], m] for i, m in wide.items()]]
        ids, end = self._ids.take(rows)
        edge = np.concatenate([[0], end])[np.concatenate([[0], last])].tolist()
        return [ids[a:b].astype("<i4").tobytes() for a, b in zip(edge, edge[1:], strict=False)]

    def encode(self, text: str, key: int = 0) -> bytes:
        """Ids of one text, four bytes each; see ``encode_all``."""
        return self.encode_all([(text, key)])[0]

    def encode_all(self, texts: list[tuple[str, int]]) -> list[bytes]:
        """Ids of texts with their keys. A literal word mark is spelled in bytes, so that decoding restores it.

        Every occurrence of a word has choices of its own, by the key and its place; what is remembered is the result of
        a word for given choices, which depends on nothing else. Words that are new in some texts are segmented together.
        """
        out, at = [], 0
        while at < len(texts):
            size, units, counts, keys = 0, [], [], []
            while at < len(texts) and size < TOGETHER:
                text, key = texts[at]
                own = self._units(text)
                units += own
                counts.append(len(own))
                keys.append(key)
                size += len(text)
                at += 1
            out += self._encode_words(units, counts, keys)
            if len(self._known) > CACHE or max(self._ids.edge[self._ids.n], self._length.sum()) > 16 * CACHE:
                self._forget()
        return out

    def decode(self, ids: bytes) -> str:
        return b"".join(self._spell[np.frombuffer(ids, "<i4")].tolist()).decode()[1:]

    def key(self, doc_id: int | None) -> int:
        """What the choices of a document are keyed by."""
        return xxhash.xxh64_intdigest(str(doc_id).encode(), self.seed)


def _with_pieces(docs: DataFrame, make, kind: str, model: str, dropout: float, seed: int):
    """A column made by ``make(pieces, ids, text)``. The model is read once, on the driver, and broadcast (0.5 MB)."""
    spark = prepare(docs.sparkSession)
    with open(model, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    own: list[Pieces] = []

    def run(doc_ids: pa.Array, texts: pa.Array) -> pa.Array:
        if not own:
            own.append(Pieces(shared.value, dropout, seed))
        texts = texts.to_pylist()
        keyed = [(t, own[0].key(i)) for i, t in zip(doc_ids.to_pylist(), texts, strict=True) if t is not None]
        ids = iter(own[0].encode_all(keyed))
        return pa.array([None if t is None else make(own[0], next(ids), t) for t in texts], to)

    fields = dict(x.split(":") for x in kind[7:-1].split(","))
    arrow = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    to = pa.struct([(k, arrow[v]) for k, v in fields.items()])
    return F.arrow_udf(run, kind)(F.col("doc_id"), F.col("text"))


def encode(docs: DataFrame, model: str = MODEL, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """``(doc_id, ids, decoded)`` for every row of ``docs(doc_id, text)``: ids of the pieces, and the text made of them.

    Candidate merges come from an agenda; a hash keyed by the seed, the document, the place of the word in it and the
    number of the candidate says which are skipped, so segmentations vary between occurrences and stay the same in every
    run. Words of equal spelling with equal choices are segmented once for each worker, while it remembers them. A null text gives nulls, an empty one no ids; repeated rows
    give equal results; other columns are not read.
    """
    def make(pieces: Pieces, ids: bytes, text: str) -> dict:
        return {"ids": list(memoryview(ids).cast("i")), "decoded": pieces.decode(ids)}

    column = _with_pieces(docs, make, "struct<ids:array<int>,decoded:string>", model, dropout, seed)
    return docs.select("doc_id", column.alias("x")).select("doc_id", "x.ids", "x.decoded")


def digests(docs: DataFrame, model: str = MODEL, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """``(doc_id, n_chars, n_ids, ids_sha256, decoded_sha256)``: of the ids as little-endian 32-bit numbers, and of the
    decoded text in UTF-8. Nulls for a null text."""
    def make(pieces: Pieces, ids: bytes, text: str) -> dict:
        return {"n_chars": len(text), "n_ids": len(ids) // 4, "ids_sha256": hashlib.sha256(ids).hexdigest(),
                "decoded_sha256": hashlib.sha256(pieces.decode(ids).encode()).hexdigest()}

    column = _with_pieces(docs, make, "struct<n_chars:long,n_ids:long,ids_sha256:string,decoded_sha256:string>", model, dropout, seed)
    return docs.select("doc_id", column.alias("x")).select("doc_id", "x.*")
