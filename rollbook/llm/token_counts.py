"""Token counts under a unigram vocabulary; pre-tokens with a common beginning share their scores."""

from collections import defaultdict
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

#: Bytes of text whose pre-tokens are put into one trie, and pre-tokens whose counts a task remembers.
BATCH_BYTES, REMEMBERED = 8 << 20, 500_000
#: What stands before each pre-token, and the score of a byte of a character without a piece, below the worst piece.
START, BELOW = "▁", 10.0
LARGEST = 16 << 20


class Pieces:
    """Pieces with their scores, by the character they end with."""

    def __init__(self, scores):
        self.scores = dict(scores)
        sizes = defaultdict(set)
        for piece in self.scores:
            if piece:
                sizes[piece[-1]].add(len(piece))
        self.sizes = {c: tuple(sorted(s)) for c, s in sizes.items()}
        self.byte = min(self.scores.values(), default=0.0) - BELOW


class Trie:
    """Forward scores along the path of a trie that is walked in order: (best score, fewest tokens) of each prefix.

    Pre-tokens come sorted, so a node is left for good when the next one branches off, and a shared prefix is
    scored once. The number of tokens of each pre-token is kept in ``counts``.
    """

    def __init__(self, pieces):
        self.pieces = pieces
        self.counts = {}
        self.nodes = 0

    def insert(self, sorted_words):
        scores, sizes, byte = self.pieces.scores, self.pieces.sizes, self.pieces.byte
        path, path_score, path_count = "", [0.0], [0]
        for word in sorted_words:
            shared = len(commonprefix((path, word)))
            del path_score[shared + 1 :], path_count[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                last = word[end - 1]
                width = len(last.encode("utf-8", "surrogatepass"))
                best, count = path_score[end - 1] + byte * width, path_count[end - 1] + width
                for size in sizes.get(last, ()):
                    if size > end:
                        break
                    own = scores.get(word[end - size : end])
                    if own is not None:
                        total, number = path_score[end - size] + own, path_count[end - size] + 1
                        if total > best or (total == best and number < count):
                            best, count = total, number
                path_score.append(best)
                path_count.append(count)
            self.nodes += len(word) - shared
            path = word
            self.counts[word] = path_count[-1]


def _counted(content):
    def counted(text: pa.Array) -> pa.Array:
        pieces = Pieces(content.value)
        known, words_out, tokens_out = {}, [], []

        def flush(batch):
            new = {w for words in batch for w in words}.difference(known)
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = {w for words in batch for w in words}
            # the forward scores of all distinct pre-tokens of the batch
            trie = Trie(pieces)
            named = sorted((START + w.decode("utf-8"), w) for w in new)
            trie.insert([n for n, _ in named])
            known.update((w, trie.counts[n]) for n, w in named)
            for words in batch:
                words_out.append(len(words))
                tokens_out.append(sum(map(known.__getitem__, words)))

        batch, size = [], 0
        for i in range(len(text)):
            data = text[i].as_py() or b""
            batch.append(data.split())
            size += len(data)
            if size >= BATCH_BYTES:
                flush(batch)
                batch, size = [], 0
        flush(batch)
        columns = [pa.array(np.array(c, np.int64)) for c in (words_out, tokens_out)]
        return pa.StructArray.from_arrays(columns, ["n_words", "n_tokens"])

    return counted


def token_counts(df, scores, text="text", carry=None):
    """``row`` (struct of the columns ``carry``, all by default), ``n_words`` and ``n_tokens`` of each text.

    ``scores``: pieces and their scores. Pre-tokens are runs without space and 0x09 to 0x0D, with START before
    them. A pre-token's tokens are the pieces with the highest sum of scores; of equal sums the fewest
    tokens count. A character without a piece may always be written as its bytes, at BELOW less than the worst piece each.

    Each task puts the distinct pre-tokens of BATCH_BYTES of text into one trie, so nothing is exchanged and memory does
    not grow with the table. NULL and empty texts have no words and no tokens; a very long text is one batch.
    """
    scores = dict(scores)
    if sum(len(p) for p in scores) > LARGEST:
        raise ValueError("the vocabulary is too large to be sent to every executor")
    content = df.sparkSession.sparkContext.broadcast(scores)
    row = F.struct(*[F.col(f"`{c}`") for c in (df.columns if carry is None else carry)])
    counted = F.arrow_udf(_counted(content), "struct<n_words: bigint, n_tokens: bigint>")(F.col(text).cast("binary"))
    return df.select(row.alias("row"), counted.alias("c")).select("row", "c.*")


def piece_scores(path):
    """Pieces and scores of a sentencepiece model file, without control, unknown and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    }
