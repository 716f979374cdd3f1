"""Quality rules as weak supervision: rules vote or abstain, EM weighs them, the posterior decides."""

from collections import namedtuple

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .label_model import fit
from .tables import written
from .words import chunks, mixed, span_hashes

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of the words
#: Words in a row among which different ones are counted.
STRETCH = 1000
#: A rule votes "good" up to ``good``, "bad" from ``bad`` on (the other way round where good > bad),
#: and abstains between them and where its measure does not exist. Shares are per word, letter or line.
Rule = namedtuple("Rule", "name good bad")
RULES = [
    Rule("symbols_per_word", 0.02, 0.1),
    Rule("repeated_words", 0.05, 0.2),
    Rule("repeated_lines", 0.05, 0.3),
    Rule("capital_letters", 0.15, 0.35),
    Rule("shouted_words", 0.03, 0.1),
    Rule("words_without_letter", 0.1, 0.25),
    Rule("letters_per_byte", 0.65, 0.5),
    Rule("words_per_sentence", 40, 80),
    Rule("distinct_words", 0.3, 0.15),
    Rule("word_length", 10, 14),
    Rule("short_words", 0.2, 0.08),
    Rule("echoed_words", 0.03, 0.15),
]
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOL, UPPER, LETTER, MARK, STOP = (np.zeros(256, bool) for _ in range(5))
SYMBOL[list(b"#*$%&|<>")] = True
UPPER[0x41:0x5B] = True
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
MARK[list(b"!?")] = True
STOP[list(b".!?")] = True
_SALT = np.uint64(0xD6E8FEB86659FD93)


def _distinct(doc, hashes, n):
    """Different values of each text."""
    own = np.unique(mixed(hashes + (doc.astype(np.uint64) + np.uint64(1)) * _SALT), return_index=True)[1]
    return np.bincount(doc[own], minlength=n)


def _varied(c, hashes):
    """Different words of each STRETCH words in a row, summed over a text, so that its length doesn't matter."""
    stretch = (np.arange(len(hashes)) - c.first[c.doc]) // STRETCH
    key = mixed(hashes + (c.doc.astype(np.uint64) + np.uint64(1)) * _SALT) + stretch.astype(np.uint64) * _SALT
    own = np.unique(mixed(key), return_index=True)[1]
    return np.bincount(c.doc[own], minlength=c.n)


def _repeats(c, hashes):
    """Words of each text that lie in a window of WINDOW words which the text has twice or more."""
    at, value = c.windows(hashes, WINDOW)
    _, group, count = np.unique(
        mixed(value + (c.doc[at].astype(np.uint64) + np.uint64(1)) * _SALT), return_inverse=True, return_counts=True
    )
    hit = at[count[group] > 1] if len(at) else at
    step = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(step, hit, 1)
    np.add.at(step, np.minimum(hit + WINDOW, len(hashes)), -1)
    return c.words_per_text(np.cumsum(step[:-1]) > 0)


def _echoes(c, hashes):
    """Marks the words that are equal to the word before them."""
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (c.doc[1:] == c.doc[:-1])
    return same


def _lines(c):
    """Lines with a word of each text, and those equal to an earlier one."""
    cut = np.flatnonzero(c.data == 0x0A)
    ends = np.sort(np.concatenate((cut, c.at[1:] - 1)))
    starts = np.concatenate(([0], ends[:-1] + 1))
    filled = np.concatenate(([0], np.cumsum(~c.space)))
    kept = filled[ends] > filled[starts]
    doc = np.searchsorted(c.at, starts[kept], side="right") - 1
    lines = np.bincount(doc, minlength=c.n)
    return lines, lines - _distinct(doc, span_hashes(c.data, starts[kept], ends[kept]), c.n)


def _measure(c):
    """Base counts (a column each) and the measures of RULES (NaN: none) of a chunk's texts."""
    words = np.diff(c.first)
    hashes = c.hashes()
    head = (c.data & 0xC0) != 0x80
    counts = {
        "n_words": words,
        "word_chars": c.per_text(head & ~c.space),
        "n_symbols": c.per_text(SYMBOL[c.data]),
        "n_repeat_words": _repeats(c, hashes),
    }
    lines, counts["n_dup_lines"] = _lines(c)
    # capital letters of Latin-1 are C3 80 to C3 9E
    second = np.concatenate(([False], c.data[:-1] == 0xC3)) & (c.data >= 0x80) & (c.data <= 0x9E)
    upper = c.per_text(UPPER[c.data] | second)
    letters = c.per_text(LETTER[c.data] & head)
    with_letter = np.concatenate(([0], np.cumsum(LETTER[c.data])))
    last = c.data[c.ends - 1]
    share = lambda a, b: np.where(b > 0, a / np.maximum(b, 1), np.nan)
    sentences = c.words_per_text(STOP[last])
    measures = {
        "symbols_per_word": share(counts["n_symbols"], words),
        "repeated_words": share(counts["n_repeat_words"], words),
        "repeated_lines": share(counts["n_dup_lines"], lines),
        "capital_letters": share(upper, letters),
        "shouted_words": share(c.words_per_text(MARK[last]), words),
        "words_without_letter": share(c.words_per_text(with_letter[c.ends] == with_letter[c.starts]), words),
        "letters_per_byte": share(letters, c.per_text(head) - 1),
        "words_per_sentence": np.where(words >= LEAST_WORDS, words / (sentences + 1), np.nan),
        "distinct_words": share(_varied(c, hashes), words),
        "word_length": share(counts["word_chars"], words),
        "echoed_words": share(c.words_per_text(_echoes(c, hashes)), words),
        "short_words": share(c.words_per_text((c.ends - c.starts <= 4) & (with_letter[c.ends] > with_letter[c.starts])), words),
    }
    return counts, measures


def _votes(measures):
    """One number per text: vote of rule i (0 abstains, 1 bad, 2 good) times 3 to the i."""
    code = 0
    for i, rule in enumerate(RULES):
        x = measures[rule.name]
        sign = 1 if rule.good < rule.bad else -1
        with np.errstate(invalid="ignore"):
            vote = np.where(sign * x <= sign * rule.good, 2, np.where(sign * x >= sign * rule.bad, 1, 0))
        code = code + np.where(np.isnan(x), 0, vote) * 3**i
    return code


MEASURED = "struct<" + ", ".join(f"{c}: bigint" for c in [*BASE, "votes"]) + ">"


def _measured(text: pa.Array) -> pa.Array:
    out = {c: [] for c in [*BASE, "votes"]}
    for _, chunk in chunks(text):
        counts, measures = _measure(chunk)
        for c in BASE:
            out[c].append(counts[c])
        out["votes"].append(_votes(measures))
    columns = [pa.array(np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64)) for v in out.values()]
    return pa.StructArray.from_arrays(columns, list(out))


def unpacked(codes):
    """Rows of votes from their numbers."""
    codes = np.asarray(codes, np.int64)
    return np.stack([codes // 3**i % 3 for i in range(len(RULES))], axis=1)


def quality(df, text="text", carry=None, threshold=0.5, name="quality"):
    """Base counts, posterior quality and verdict of each row.

    Returns ``row`` (struct of the columns ``carry``, all by default, as they were), the counts of
    BASE, ``base_failed``, ``posterior`` and ``kept``. The rules' votes of the whole table are
    counted per combination (at most 3 to the 12 of them, so the model's input is bounded for any
    table), EM estimates how often each rule is right and which rules repeat each other, and a text is kept
    if the posterior probability of good quality is at least ``threshold`` and the base rules hold:
    LEAST_WORDS words, and MOST_REPEATED per cent of them in repeated windows at most.

    NULL and empty texts have no words: all rules abstain, the base rules fail. Rows with equal
    texts get equal results; an empty table gives an empty result. Other columns are not looked at.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in (df.columns if carry is None else carry)])
    measured = df.select(row.alias("row"), F.arrow_udf(_measured, MEASURED)(F.col(text).cast("binary")).alias("m"))
    measured = written(measured.select("row", "m.*"), name)
    words, repeats = F.col("n_words"), F.col("n_repeat_words")
    failed = (words < LEAST_WORDS) | (100 * repeats > MOST_REPEATED * words)
    counted = measured.groupBy("votes", failed.alias("failed")).agg(F.count("*").alias("n")).collect()
    scores = posteriors([(r.votes, r.failed, r.n) for r in counted])
    table = df.sparkSession.createDataFrame(scores, "votes bigint, posterior double")
    # at most 3 to the 12 rows
    judged = measured.join(F.broadcast(table), "votes", "left")
    judged = judged.withColumn("base_failed", failed)
    return judged.select(
        "row", *BASE, "base_failed", "posterior",
        (~F.col("base_failed") & (F.col("posterior") >= threshold)).alias("kept"),
    )


def posteriors(counted):
    """(votes, posterior) for each combination of votes among (votes, base rules failed, rows)."""
    codes = sorted({v for v, _, _ in counted})
    if not codes:
        return []
    place = {v: i for i, v in enumerate(codes)}
    weight = np.zeros(len(codes))
    for v, _, n in counted:
        weight[place[v]] += n
    votes = unpacked(codes)
    # first guess: rules against a text count, rules for it are easily met
    model = fit(votes, weight, 0.95 * 0.25 ** (votes == 1).sum(axis=1))
    return [(int(v), float(p)) for v, p in zip(codes, model.posterior(votes))]
