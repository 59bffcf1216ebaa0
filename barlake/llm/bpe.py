"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece of bytes exactly one token can be the last one of its encoding:
the token t that ends there and is compatible with the last token of the prefix before it,
i.e. the two alone would encode to themselves. A table of these last tokens gives the
encoding backwards. It only ever looks at the prefix, so appending bytes extends the table,
an edit keeps the part before it, and pieces that share a beginning share its entries.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import map_batches, map_rows

# Fixed value: the pattern that ``Splitter`` follows.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Pieces whose ids a task keeps at hand; beyond it starts anew, with equal results.
MEMO_PIECES = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Tokens by rank and the compatibility of two adjacent tokens."""

    # Tokens that end at a position are looked up by its last bytes, so many at a time.
    END = 5

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        longer: dict[bytes, set[int]] = {}
        for token in ranks:
            if len(token) > self.END:
                longer.setdefault(token[-self.END :], set()).add(len(token))
        self._longer = {end: sorted(sizes, reverse=True) for end, sizes in longer.items()}
        self._ending: dict[bytes, tuple[list[int], list[tuple]]] = {}
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._fits: list[dict[int, bool]] = [{} for _ in self.tokens]

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a token that no merge makes."""
        if token not in self._parts:
            text = self.tokens[token]
            # Merges come in rank order: only tokens of lower ranks can make this one.
            ids = self.backwards(text, self._last_below(text, token)) if len(text) > 1 else []
            self._parts[token] = (ids[0], ids[1]) if len(ids) == 2 else None
        return self._parts[token]

    def reached(self, token: int) -> bool:
        return len(self.tokens[token]) == 1 or self.parts(token) is not None

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens, side by side, stay as they are."""
        known = self._fits[right].get(left)
        if known is None:
            known = self._fits[right][left] = self._stay(left, right, len(self.tokens))
        return known

    def _stay(self, left: int, right: int, limit: int) -> bool:
        # Undo the merges of both tokens from the last one back. A merge across the border
        # of a rank below that of the merge undone last (``limit``) would have come first
        # and taken the border away.
        tokens, ranks = self.tokens, self.ranks
        while True:
            across = ranks.get(tokens[left] + tokens[right])
            if across is not None and across < limit:
                return False
            apart_left, apart_right = self.parts(left), self.parts(right)
            if apart_left is None and apart_right is None:
                return True
            # On the right of the border a merge of the same rank comes later than on the left.
            if apart_right is None or (apart_left is not None and left > right):
                limit, left = left, apart_left[1]
            else:
                limit, right = right + 1, apart_right[0]

    def _last_below(self, text: bytes, limit: int) -> list[int]:
        """The last token of every prefix of a token's text, by merges of lower ranks only."""
        last: list[int] = []
        for end in range(1, len(text) + 1):
            for size in range(end, 0, -1):
                token = self.ranks.get(text[end - size : end])
                if token is None or (size > 1 and token >= limit) or not self.reached(token):
                    continue
                if size == end or self._stay(last[end - size - 1], token, limit):
                    break
            last.append(token)
        return last

    def _ends(self, end: bytes) -> tuple[list[int], list[tuple]]:
        """Of the tokens that may end in these bytes: the sizes of longer ones; size, rank and
        known left neighbours of the others, the longest first."""
        if len(self._ending) > MEMO_PIECES:
            self._ending.clear()
        short = []
        for size in range(len(end), 0, -1):
            token = self.ranks.get(end[-size:])
            if token is not None and self.reached(token):
                short.append((size, token, self._fits[token]))
        found = self._ending[end] = (self._longer.get(end, []), short)
        return found

    def last_tokens(self, text: bytes, last: list[int] | None = None, kept: int = 0) -> list[int]:
        """The last token of every prefix; ``last`` holds those of the first ``kept`` ones."""
        last = last[:kept] if last else []
        ending, ranks, width = self._ending, self.ranks, self.END
        for end in range(len(last) + 1, len(text) + 1):
            tail = text[end - width : end] if end > width else text[:end]
            known = ending.get(tail)
            longer, short = known if known is not None else self._ends(tail)
            found = None
            for size in longer:
                if size <= end:
                    token = ranks.get(text[end - size : end])
                    if token is not None and self.reached(token):
                        if size == end or self.fits(last[end - size - 1], token):
                            found = token
                            break
            if found is None:
                for size, token, fits in short:
                    if size == end:
                        found = token
                        break
                    before = last[end - size - 1]
                    stays = fits.get(before)
                    if stays or (stays is None and self.fits(before, token)):
                        found = token
                        break
                else:
                    raise ValueError(f"byte {text[end - 1]} is not in the vocabulary")
            last.append(found)
        return last

    def backwards(self, text: bytes, last: list[int]) -> list[int]:
        ids, end, tokens = [], len(text), self.tokens
        while end:
            ids.append(last[end - 1])
            end -= len(tokens[ids[-1]])
        ids.reverse()
        return ids


class PieceEncoder:
    """Encodes pieces, keeping the prefix table of the latest one: the next piece reuses
    the entries of the beginning that both share."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.text = b""
        self.last: list[int] = []

    def encode(self, piece: bytes) -> list[int]:
        whole = self.vocabulary.ranks.get(piece)
        if whole is not None:
            return [whole]
        kept = _shared(self.text, piece)
        self.last = self.vocabulary.last_tokens(piece, self.last, kept)
        self.text = piece
        return self.vocabulary.backwards(piece, self.last)


def _shared(a: bytes, b: bytes) -> int:
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    low, high = 0, most
    while high - low > 1:
        middle = (low + high) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle
    return low


class Splitter:
    """Cuts a text into pieces as the pattern of the rank files does: contractions, letters,
    numbers and other signs with at most one blank before them, and white space.

    Classes come from the ``regex`` module's properties, the cuts from array operations.
    """

    LETTER, NUMBER, SPACE, OTHER = range(4)

    def __init__(self) -> None:
        every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
        self.classes = np.full(0x110000, self.OTHER, np.uint8)
        for kind, name in ((self.LETTER, r"\p{L}+"), (self.NUMBER, r"\p{N}+"), (self.SPACE, r"\s+")):
            for found in regex.finditer(name, every):
                low, high = ord(found[0][0]), ord(found[0][-1])
                if low < 0xD800 <= high:
                    self.classes[low:0xD800] = kind
                    low = 0xE000
                self.classes[low : high + 1] = kind

    def cuts(self, points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where pieces begin in the code points of texts that begin at ``bounds``."""
        size = len(points)
        if not size:
            return np.empty(0, np.int64)
        kinds = self.classes[points]
        change = np.empty(size, bool)
        change[0] = True
        np.not_equal(kinds[1:], kinds[:-1], out=change[1:])
        change[bounds[bounds < size]] = True
        begins = np.flatnonzero(change)
        ends = np.append(begins[1:], size)
        run_kind = kinds[begins]
        last_of_text = np.zeros(size + 1, bool)
        last_of_text[bounds] = last_of_text[size] = True
        last_of_text = last_of_text[ends]

        starts = begins.copy()
        # A white-space run before other signs gives its last character away: a blank joins
        # the next piece, anything else stands alone.
        white = (run_kind == self.SPACE) & ~last_of_text
        ends_blank = white & (points[ends - 1] == 32)
        starts[np.flatnonzero(ends_blank) + 1] -= 1
        extra = ends[white & ~ends_blank & (ends - begins > 1)] - 1
        keep = ~(ends_blank & (ends - begins == 1))

        # Contractions: a lone apostrophe at a piece's beginning takes one or two letters.
        quote = (run_kind == self.OTHER) & (points[begins] == 39) & (ends - begins == 1) & (starts == begins)
        for i in np.flatnonzero(quote & ~last_of_text):
            if run_kind[i + 1] != self.LETTER:
                continue
            at, end = begins[i + 1], ends[i + 1]
            pair = "".join(map(chr, points[at : min(at + 2, end)]))
            taken = 1 if pair[0] in "stmd" else 2 if pair in ("re", "ve", "ll") else 0
            if taken and end - at > taken:
                starts[i + 1] = at + taken
            elif taken:
                keep[i + 1] = False
        starts = starts[keep]
        return np.sort(np.concatenate((starts, extra))) if len(extra) else starts

    def pieces(self, text: str) -> list[str]:
        cuts = [*self.cuts(_points(text), np.zeros(1, np.int64)).tolist(), len(text)]
        return [text[a:b] for a, b in zip(cuts, cuts[1:])]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


class Encoder:
    """Whole texts to ids and back."""

    # Code points that are cut and encoded at once; a longer text is taken alone.
    POINTS = 4_000_000

    def __init__(self, ranks: dict[bytes, int]):
        self.vocabulary = Vocabulary(ranks)
        self.splitter = Splitter()
        self.memo: dict[str, list[int]] = {}
        self.bytes_of = Joined(self.vocabulary.tokens)
        self.digits_of = Joined([b"%d " % rank for rank in range(len(self.vocabulary.tokens))])

    def encode(self, text: str) -> list[int]:
        return next(self.encode_many([text])).tolist()

    def encode_many(self, texts: list[str]) -> Iterator[np.ndarray]:
        first, size = 0, 0
        for at, text in enumerate(texts):
            if size and size + len(text) > self.POINTS:
                yield from self._encode(texts[first:at])
                first, size = at, 0
            size += len(text)
        yield from self._encode(texts[first:])

    def _encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        text = "".join(texts)
        points = _points(text)
        bounds = np.cumsum([0, *map(len, texts)])
        starts = self.splitter.cuts(points, bounds)
        sizes = np.diff(starts, append=len(points))
        first, which = _distinct(points, starts, sizes)
        pieces = [text[a : a + n] for a, n in zip(starts[first].tolist(), sizes[first].tolist())]
        self._learn(pieces)
        found = list(map(self.memo.__getitem__, pieces))
        counts = np.fromiter(map(len, found), np.int64, len(found))
        every = np.fromiter(chain.from_iterable(found), np.int64, counts.sum())
        ids = every[_spans((np.cumsum(counts) - counts)[which], counts[which])]
        ends = np.concatenate(([0], np.cumsum(counts[which])))[np.searchsorted(starts, bounds)]
        for a, b in zip(ends.tolist(), ends[1:].tolist()):
            yield ids[a:b]

    def _learn(self, pieces: list[str]) -> None:
        """Put these pieces into the memo, in order, so that neighbours share prefixes."""
        new = set(pieces).difference(self.memo)
        if len(self.memo) + len(new) > MEMO_PIECES:
            self.memo.clear()
            new = set(pieces)
        encoder = PieceEncoder(self.vocabulary)
        for piece in sorted(new):
            self.memo[piece] = encoder.encode(piece.encode())

    def decode(self, ids: np.ndarray) -> bytes:
        return self.bytes_of(ids)

    def decimal(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by one blank."""
        return self.digits_of(ids)[:-1]


class Joined:
    """Joins entries of a fixed table of byte strings, given by their numbers."""

    def __init__(self, entries: list[bytes]):
        self.text = np.frombuffer(b"".join(entries), np.uint8)
        self.sizes = np.fromiter(map(len, entries), np.int64, len(entries))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def __call__(self, numbers: np.ndarray) -> bytes:
        return self.text[_spans(self.starts[numbers], self.sizes[numbers])].tobytes()


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions start, start+1, ... of all spans, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


def _distinct(points: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One piece of each distinct text, and for every piece the number of its text.

    Pieces meet by a polynomial hash; then every piece is compared with its text in full.
    Should two texts share a hash, the pieces are told apart by their characters alone.
    """
    # Powers of an odd number have inverses modulo 2**64.
    factor, inverse = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
    powers = np.cumprod(np.full(len(points), factor, np.uint64))
    back = np.cumprod(np.full(len(points), inverse, np.uint64))
    sums = np.concatenate(([np.uint64(0)], np.cumsum((points + np.uint64(1)) * powers)))
    hashes = (sums[starts + sizes] - sums[starts]) * back[starts] if len(starts) else np.empty(0, np.uint64)
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    same = points[_spans(starts[first][which], sizes)] == points if _sizes_agree(sizes, first, which) else False
    if np.all(same):
        return first, which
    text = points.tobytes()
    numbers: dict[bytes, int] = {}
    first, which = [], np.empty(len(starts), np.int64)
    for at, (a, n) in enumerate(zip(starts.tolist(), sizes.tolist())):
        which[at] = numbers.setdefault(text[4 * a : 4 * (a + n)], len(numbers))
        if which[at] == len(first):
            first.append(at)
    return np.array(first, np.int64), which


def _sizes_agree(sizes: np.ndarray, first: np.ndarray, which: np.ndarray) -> bool:
    return bool(np.array_equal(sizes[first][which], sizes))


class PrefixTable:
    """The encoding of one text that grows and changes.

    Every piece keeps the last token of each of its prefixes. An append or an edit cuts
    anew from the piece before the first changed character (a cut looks one character
    ahead) until a cut of the old text is met again, and a changed piece keeps the entries
    of its unchanged beginning.
    """

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder = encoder
        self.text = ""
        self.starts: list[int] = []
        self.tables: list[tuple[bytes, list[int]]] = []
        self.computed = 0
        self.edit(0, 0, text)

    def append(self, text: str) -> None:
        self.edit(len(self.text), len(self.text), text)

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Replace the characters from ``start`` to ``end``."""
        text = self.text[:start] + replacement + self.text[end:]
        first = max(0, int(np.searchsorted(self.starts, start, "right")) - 2)
        origin = self.starts[first] if first < len(self.starts) else 0
        # A cut two pieces behind the edit is a cut of the new text too, if the new text has
        # a cut in the same place: from there on both are equal.
        shift = len(replacement) - (end - start)
        old = {s + shift: i for i, s in enumerate(self.starts) if s > end}
        starts, tables = self.starts[:first], self.tables[:first]
        changed_end, cursor, window = start + len(replacement), origin, 256
        while cursor < len(text):
            stop = min(len(text), max(cursor, changed_end) + window)
            pieces = self.encoder.splitter.pieces(text[cursor:stop])
            cuts = [cursor, *(cursor + np.cumsum([len(p) for p in pieces])).tolist()]
            # The last two pieces of a window may go on behind it.
            if stop < len(text):
                cuts = cuts[:-2]
                if len(cuts) < 2:
                    window *= 2
                    continue
            met = None
            for a, b in zip(cuts, cuts[1:]):
                if a > changed_end + 1 and a in old:
                    met = old[a]
                    break
                starts.append(a)
                tables.append(self._table(text[a:b], len(starts) - 1))
            if met is not None:
                starts += [s + shift for s in self.starts[met:]]
                tables += self.tables[met:]
                break
            cursor = cuts[-1]
        self.text, self.starts, self.tables = text, starts, tables

    def _table(self, piece: str, at: int) -> tuple[bytes, list[int]]:
        data, vocabulary = piece.encode(), self.encoder.vocabulary
        before, last = self.tables[at] if at < len(self.tables) else (b"", [])
        kept = _shared(before, data)
        self.computed += len(data) - kept
        return data, vocabulary.last_tokens(data, last, kept)

    def ids(self) -> list[int]:
        vocabulary = self.encoder.vocabulary
        found: list[int] = []
        for data, last in self.tables:
            whole = vocabulary.ranks.get(data)
            found += [whole] if whole is not None else vocabulary.backwards(data, last)
        return found


def _shipped(spark: SparkSession, vocabulary_path: str) -> object:
    """The rank file, read by the driver; its size is that of the file. Files whose texts are
    cut by another pattern are refused."""
    if public_tokenizers.PATTERN != PATTERN:
        raise ValueError(f"texts are cut by {PATTERN}, not by {public_tokenizers.PATTERN}")
    return spark.sparkContext.broadcast(read_ranks(vocabulary_path))


def _per_text(shared: object, answer: Callable[..., tuple]) -> Callable[[], Callable[..., Iterator[tuple]]]:
    def begin() -> Callable[..., Iterator[tuple]]:
        encoder = Encoder(shared.value)

        def batch(doc_ids: list[int | None], texts: list[str | None]) -> Iterator[tuple]:
            found = encoder.encode_many([text or "" for text in texts])
            return ((doc_id, *answer(encoder, ids)) for doc_id, ids in zip(doc_ids, found))

        return batch

    return begin


def _ids(encoder: Encoder, ids: np.ndarray) -> tuple:
    return len(ids), ids.astype(np.int32)


def _digests(encoder: Encoder, ids: np.ndarray) -> tuple:
    line, text = encoder.decimal(ids), encoder.decode(ids)
    return len(ids), hashlib.sha256(line).hexdigest(), hashlib.sha256(text).hexdigest()


def encode(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row's whole text; a null text is empty and has no
    ids. Repeated rows stay repeated, other columns do not matter."""
    return map_batches(
        _texts(docs), ["doc_id", "text"], "doc_id long, n_tokens long, ids array<int>",
        _per_text(_shipped(docs.sparkSession, vocabulary_path), _ids),
    )


def decode(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """(doc_id, text) of rows with ``ids``; null ids give an empty text. Bytes that are not
    UTF-8, as ids cut in the middle of a character give, become U+FFFD, and so does an id that
    no token has: one beyond the vocabulary, a negative or a null one among others."""
    shared = _shipped(encoded.sparkSession, vocabulary_path)

    def begin() -> Callable[..., tuple]:
        tokens = {rank: token for token, rank in shared.value.items()}
        unknown = "\ufffd".encode()

        def one(doc_id: int | None, ids: list[int | None] | None) -> tuple:
            return doc_id, b"".join(tokens.get(i, unknown) for i in ids or ()).decode("utf-8", "replace")

        return one

    return map_rows(encoded.select("doc_id", "ids"), ["doc_id", "ids"], "doc_id long, text string", begin)


def digests(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the ids of every whole text, and
    the bytes they decode to, as digests."""
    return map_batches(
        _texts(docs), ["doc_id", "text"],
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
        _per_text(_shipped(docs.sparkSession, vocabulary_path), _digests),
    )


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
