"""Byte-level BPE by backtracking over longest matches, without merging.

A token sequence is what the merges would make of its bytes exactly if every two neighbours are
compatible, that is if merging their joined bytes gives these two tokens again. So a text can be encoded
from left to right: take the longest token that goes on compatibly, and go back one token
where none does. Positions from which the text can't be finished are remembered, so
each is tried once and the time is linear.
"""

import base64

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F

#: Pieces that a worker remembers in each of two generations, of which the older one is given up, and pairs of
#: tokens, beyond which it starts anew.
PIECES, PAIRS = 150_000, 400_000


class ByteBpe:
    """Tables of a rank file (token in base64, space, rank, on each line), and the encoder.

    Ranks are ids and the order of merges; every byte must be a token.
    """

    def __init__(self, content):
        self.rank = dict(_ranks(content))
        self.token = {rank: token for token, rank in self.rank.items()}
        if any(chr(b) not in self.rank for b in range(256)):
            raise ValueError("every byte must be a token")
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.rank.items():
            self.automaton.add_word(token, (len(token), rank))
        self.automaton.make_automaton()
        # by rank; lists are found faster than dicts by the many processes of a machine that share its caches
        self.sizes = [len(self.token.get(rank, "")) for rank in range(max(self.token) + 1)]
        self.shorter = [None] * len(self.sizes)
        self.compatible = [{} for _ in self.sizes]
        self.newer, self.older, self.pairs = {}, {}, 0
        self.halves, self.merge = {}, {}
        for rank in sorted(self.token):
            self._add(rank)

    def _add(self, rank):
        """The next shorter token with which a token begins, and the two that its last merge joins."""
        token = self.token[rank]
        for end in range(len(token) - 1, 0, -1):
            if (begin := self.rank.get(token[:end])) is not None:
                self.shorter[rank] = begin
                break
        if len(token) == 1:
            return
        for cut in range(len(token) - 1, 0, -1):
            left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
            if left is not None and right is not None and left < rank and right < rank and self._fits(left, right):
                self.halves[rank] = (left, right)
                self.merge[left, right] = rank
                return

    def fits(self, left, right):
        """Whether the merges leave ``left`` and ``right`` side by side as they are."""
        known = self.compatible[left].get(right)
        if known is None:
            if self.pairs >= PAIRS:
                self.compatible, self.pairs = [{} for _ in self.sizes], 0
            known = self.compatible[left][right] = self._fits(left, right)
            self.pairs += 1
        return known

    def _fits(self, left, right):
        # undo merges, the latest first; a merge across the border that would have come before the one undone
        # last takes the border away
        bound = float("inf")
        while True:
            across = self.merge.get((left, right))
            if across is not None and across < bound:
                return False
            inner_left, inner_right = self.halves.get(left), self.halves.get(right)
            if inner_left is None and inner_right is None:
                return True
            # a merge at the same rank is made from left to right, so the left part comes first
            if inner_right is None or (inner_left is not None and left > right):
                bound, left = left, inner_left[1]
            else:
                bound, right = right + 1, inner_right[0]

    def piece(self, data):
        """Token ids of the bytes of one piece, given as Latin-1 text."""
        whole = self.rank.get(data)
        if whole is not None:
            return (whole,)
        shorter, compatible, sizes, longest = self.shorter, self.compatible, self.sizes, self.automaton.iter_long
        out, dead, at, last = [], set(), 0, None
        while True:
            # the longest tokens, one after the other, as long as they fit
            for end, (size, choice) in longest(data, at):
                if end + 1 in dead:
                    break
                if last is not None:
                    fit = compatible[last].get(choice)
                    if not (self.fits(last, choice) if fit is None else fit):
                        break
                out.append(choice)
                last, at = choice, end + 1
            else:
                return tuple(out)
            # else the next shorter one, or, where there is none, one instead of the token before
            while True:
                choice = shorter[choice]
                while choice is None:
                    dead.add(at)
                    choice = out.pop()
                    at -= sizes[choice]
                    last = out[-1] if out else None
                    choice = shorter[choice]
                end = at + sizes[choice]
                if end not in dead and (last is None or self.fits(last, choice)):
                    out.append(choice)
                    last, at = choice, end
                    break

    def _known(self, piece):
        """Token ids of a piece that isn't among the newer ones."""
        ids = self.older.get(piece)
        if ids is None:
            ids = self.piece(piece if piece.isascii() else piece.encode("utf-8").decode("latin-1"))
        if len(self.newer) >= PIECES:
            self.older, self.newer = self.newer, {}
        self.newer[piece] = ids
        return ids

    def encode(self, text, pattern):
        """Token ids of a text; each match of the pattern is encoded by itself."""
        out = []
        for piece in pattern.findall(text):
            out += self.newer.get(piece) or self._known(piece)
        return out


def _gathered(values, starts, sizes):
    """The runs of ``values`` that begin at ``starts``, one after the other."""
    first = np.cumsum(sizes) - sizes
    return values[np.repeat(starts - first, sizes) + np.arange(int(sizes.sum()))]


def _ranks(content):
    """(token as Latin-1 text, rank) of the lines of a rank file."""
    pairs = (line.split() for line in content.splitlines() if line)
    return [(base64.b64decode(token).decode("latin-1"), int(rank)) for token, rank in pairs]


_loaded = {}


def _once(build, content):
    """What ``build`` makes of a rank file, made once per Python worker."""
    key, made = _loaded.get(build.__name__, (None, None))
    if key != content:
        made = build(content)
        _loaded[build.__name__] = content, made
    return made


class Tokens:
    """The bytes of all tokens in a row, where each rank's begin, and how many they are."""

    def __init__(self, content):
        token = {rank: text.encode("latin-1") for text, rank in _ranks(content)}
        named = [token.get(rank, b"") for rank in range(max(token) + 1)]
        self.data = np.frombuffer(b"".join(named), np.uint8)
        self.sizes = np.fromiter(map(len, named), np.int64, len(named))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def decode(self, ids):
        """(bytes of all ids in a row, number of each id's bytes); an id without a token is an error."""
        sizes = self.sizes[ids]
        if not sizes.all():
            raise ValueError("an id has no token")
        return _gathered(self.data, self.starts[ids], sizes), sizes


class Vocabulary:
    """A rank file and the pattern that cuts texts into pieces, ready to be sent to the executors.

    Only the driver reads the file. It may have LARGEST bytes at most, because it is sent to
    every executor.
    """

    LARGEST = 64 << 20

    def __init__(self, spark, path, pattern):
        with open(path, "rb") as file:
            content = file.read(self.LARGEST + 1)
        if len(content) > self.LARGEST:
            raise ValueError(f"{path} is larger than {self.LARGEST} bytes")
        self.pattern = pattern
        self.content = spark.sparkContext.broadcast(content)


def encode(vocabulary, text):
    """Column of token ids (array of int) of a text column. NULL is the empty text, which has none.

    Special tokens are ordinary text. Texts are encoded whole, however long; what a worker remembers is bounded.
    Equal texts get equal ids.
    """
    content, pattern = vocabulary.content, vocabulary.pattern

    def encoded(texts: pa.Array) -> pa.Array:
        bpe, cut = _once(ByteBpe, content.value), regex.compile(pattern)
        rows = [np.array(bpe.encode(t.as_py() or "", cut), np.int32) for t in texts]
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
        flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    return F.arrow_udf(encoded, "array<int>")(text)


def decode(vocabulary, ids):
    """Column of bytes of a column of token ids; NULL stays NULL, an unknown id is an error."""
    content = vocabulary.content

    def decoded(rows: pa.Array) -> pa.Array:
        tokens = _once(Tokens, content.value)
        data, sizes = tokens.decode(rows.flatten().to_numpy(zero_copy_only=False))
        ends = np.concatenate(([0], np.cumsum(sizes)))
        counts = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        cuts = ends[np.concatenate(([0], np.cumsum(counts)))]
        missing = rows.is_null().to_numpy(zero_copy_only=False)
        out = [None if m else data[a:b].tobytes() for m, a, b in zip(missing, cuts[:-1], cuts[1:])]
        return pa.array(out, pa.binary())

    return F.arrow_udf(decoded, "binary")(ids)


def encode_and_decode(vocabulary, text):
    """Column of structs of a text column: ``n_tokens``, ``packed`` (ids as little-endian unsigned 32-bit numbers in a row) and
    ``decoded``, the bytes of the ids. Each text is encoded once; results as ``encode`` and ``decode`` have them."""
    content, pattern = vocabulary.content, vocabulary.pattern

    def both(texts: pa.Array) -> pa.Array:
        bpe, tokens, cut = _once(ByteBpe, content.value), _once(Tokens, content.value), regex.compile(pattern)
        n, ids_out, bytes_out = [], [], []
        for t in texts:
            ids = np.array(bpe.encode(t.as_py() or "", cut), np.int64)
            n.append(len(ids))
            ids_out.append(ids.astype("<u4").tobytes())
            bytes_out.append(tokens.decode(ids)[0].tobytes())
        columns = [pa.array(n, pa.int64()), pa.array(ids_out, pa.binary()), pa.array(bytes_out, pa.binary())]
        return pa.StructArray.from_arrays(columns, ["n_tokens", "packed", "decoded"])

    return F.arrow_udf(both, "struct<n_tokens: bigint, packed: binary, decoded: binary>")(text)


def packed(ids):
    """Column of token ids as little-endian unsigned 32-bit numbers in a row."""

    def pack(rows: pa.Array) -> pa.Array:
        flat = rows.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        cuts = np.concatenate(([0], np.cumsum(rows.value_lengths().to_numpy(zero_copy_only=False))))
        return pa.array([flat[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())

    return F.arrow_udf(pack, "binary")(ids)
