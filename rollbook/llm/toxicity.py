"""Toxicity by weak supervision: mined lexicons and word patterns vote, a generative model of the
voters' accuracies and correlations gives posterior labels, and a linear classifier learns them."""

import re
import zlib
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .label_model import fit
from .tables import written

#: Labelled texts that the model is fitted on at most, those with the smallest hash of their id.
SAMPLE = 30_000
LENGTHS = range(3, 7)
#: A part needs this much evidence (log-likelihood ratio) and this share of toxic texts.
EVIDENCE, PURITY = 10.0, 0.9
#: A beginning or end needs so many words that occur in toxic texts only; else the words themselves tell as much.
FORMS = 3
THRESHOLD = 0.3
#: Costs of squared weights that the classifier is tried with, on so many folds of the learnable texts.
DECAYS, FOLDS = (0.03, 0.1, 0.3, 1.0), 4
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class ToxicityModel:
    """Word parts with their weights. ``" idiot "`` is a word, ``" idi"`` a beginning, ``"iot "`` an end."""

    parts: list
    weights: list
    bias: float
    accuracies: dict

    def score(self, hits):
        return 1 / (1 + np.exp(-(self.bias + sum(self.weights[i] for i in hits))))


def _automaton(parts):
    out = ahocorasick.Automaton()
    for i, part in enumerate(parts):
        out.add_word(part, i)
    if parts:
        out.make_automaton()
    return out


def _hits(automaton, text):
    """Numbers of the different parts that occur in a text."""
    if not len(automaton):
        return set()
    line = " " + " ".join(_WORD.findall(text.lower())) + " "
    return {i for _, i in automaton.iter(line)}


def _found(parts):
    def found(text: pa.Array) -> pa.Array:
        automaton = _automaton(parts)
        return pa.array([sorted(_hits(automaton, t or "")) for t in text.to_pylist()], pa.list_(pa.int32()))

    return found


def _scored(model):
    def scored(text: pa.Array) -> pa.Array:
        automaton = _automaton(model.parts)
        return pa.array([float(model.score(_hits(automaton, t or ""))) for t in text.to_pylist()], pa.float64())

    return scored


def _without_copies(sample):
    """One text of each group of copies: those whose smallest hash of five words in a row is the same.

    Else the words of a toxic text that is copied a thousand times would all look toxic.
    """
    words = F.split(F.trim(F.lower("text")), r"\s+")
    shingle = lambda i: F.xxhash64(F.slice(F.col("words"), i, F.lit(5)))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - 4, F.lit(1)))
    sample = sample.withColumn("words", words).withColumn("mark", F.array_min(F.transform(starts, shingle)))
    return sample.groupBy("mark").agg(F.max_by(F.struct("text", "toxic"), F.struct("toxic", "order")).alias("kept")).select("kept.*")


def _forms(word):
    """A word, its beginnings and its ends, as an array of parts."""
    blank = F.lit(" ")
    begin = [F.when(F.length(word) > n, F.concat(blank, F.left(word, F.lit(n)))) for n in LENGTHS]
    end = [F.when(F.length(word) > n, F.concat(F.right(word, F.lit(n)), blank)) for n in LENGTHS]
    return F.array_compact(F.array(F.concat(blank, word, blank), *begin, *end))


def _parts(sample):
    """Words, beginnings and ends that occur in toxic texts and hardly in others, the most frequent first.

    Texts are counted, not words: a text with ten forms of a word is evidence of one text.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)")))
    toxic, clean = F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")
    own = F.array_distinct(F.flatten(F.transform(words, _forms)))
    parts = sample.select("toxic", F.explode(own).alias("part")).groupBy("part").agg(toxic, clean).filter("t > 1")
    counted = sample.select("toxic", F.explode(words).alias("word")).groupBy("word").agg(toxic, clean).filter("c = 0")
    forms = counted.select(F.explode(_forms(F.col("word"))).alias("part")).groupBy("part").agg(F.count("*").alias("forms"))
    parts = parts.join(forms, "part", "left").filter((F.col("forms") >= FORMS) | F.col("part").like(" % "))
    t, c = F.col("t"), F.col("c")
    share = (t + 0.5) / (t + c + 1)
    total = sample.agg(F.sum("toxic").alias("all_t"), F.sum(1 - F.col("toxic")).alias("all_c"))
    base = (F.col("all_t") + 0.5) / (F.col("all_t") + F.col("all_c") + 1)
    evidence = t * F.log(share / base) + c * F.log((1 - share) / (1 - base))
    # one row of totals
    chosen = parts.join(F.broadcast(total)).filter((share >= PURITY) & (base < PURITY) & (evidence >= EVIDENCE))
    return [r.part for r in chosen.orderBy(F.desc("t"), "part").collect()]


def _voters(rows, toxic, weight, n):
    """Parts that each find toxic texts which those before them miss, most first."""
    by_part = {}
    for row, hits in enumerate(rows):
        for i in hits:
            by_part.setdefault(i, set()).add(row)
    left, chosen = {i for i in range(len(rows)) if toxic[i]}, []
    while left:
        best = max(range(n), key=lambda i: (sum(weight[r] for r in by_part.get(i, set()) & left), -i), default=None)
        if best is None or not by_part.get(best, set()) & left:
            break
        chosen.append(best)
        left -= by_part[best]
    return chosen


def _classifier(rows, weight, target, n, decay, rounds=400, rate=0.3):
    """Weights and bias of a logistic regression on the presence of parts; targets are probabilities, and the
    squared weights cost ``decay`` / 2 per text."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    part = np.fromiter((i for r in rows for i in r), np.int64, len(at))
    texts = weight.sum()
    share = float(weight @ target) / texts
    w, b = np.zeros(n), np.log((share + 1e-4) / (1 - share + 1e-4))
    moment, square = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, rounds + 1):
        z = np.bincount(at, w[part], len(rows)) + b
        error = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - target) / texts
        gradient = np.append(np.bincount(part, error[at], n) + decay / texts * w, error.sum())
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        move = rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def _loss(rows, weight, target, w, b):
    """Log-loss of a classifier over texts, summed."""
    z = np.array([b + sum(w[i] for i in r) for r in rows])
    return float(weight @ (np.logaddexp(0, z) - target * z))


def _decay(rows, weight, target, n):
    """The decay with the least loss on folds of the texts that the classifier has not seen; the larger of equals."""
    fold = np.array([zlib.crc32(repr(list(r)).encode()) % FOLDS for r in rows])
    loss = dict.fromkeys(DECAYS, 0.0)
    for decay in DECAYS:
        for f in range(FOLDS):
            seen, rest = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            if not len(seen) or not len(rest):
                continue
            model = _classifier([rows[i] for i in seen], weight[seen], target[seen], n, decay)
            loss[decay] += _loss([rows[i] for i in rest], weight[rest], target[rest], *model)
    return min(sorted(DECAYS, reverse=True), key=loss.get)


def learn(df, labels, id="doc_id", text="text", label="toxic", sample=SAMPLE):
    """A model from the texts of ``df`` that ``labels`` (id, label 0 or 1) covers.

    At most ``sample`` labelled rows are taken, by the hash of their id, so that what comes to the
    driver is bounded for any table: the word parts with enough evidence, and per sampled text those in it. Parts that
    occur in toxic texts almost only are mined from them; each part that finds texts which others miss votes
    "toxic" where it occurs, a voter for several parts and one for none at all are added, and the given
    label votes as an annotator who may err. The label model turns the votes into posterior labels,
    on which the classifier over all parts is fitted.

    Rows with NULL label, id or text are not learnt from; of repeated labels the larger counts. Without labelled
    texts, or with one kind of label only, there are no parts and the score is the share of toxic ones (0 without any).
    """
    known = labels.select(F.col(id).alias("id"), F.col(label).cast("int").alias("toxic")).dropna()
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic")).withColumn("order", F.xxhash64("id"))
    # at most ``sample`` rows of three numbers
    known = F.broadcast(known.orderBy("order", "id").limit(sample))
    texts = df.select(F.col(id).alias("id"), F.col(text).alias("text")).dropna().join(known, "id")
    texts = written(_without_copies(texts), "labelled")
    parts = _parts(texts)
    found = texts.select(F.arrow_udf(_found(parts), "array<int>")("text").alias("hits"), "toxic")
    rows = sorted(found.groupBy("toxic", "hits").agg(F.count("*").alias("n")).collect(), key=lambda r: (r.toxic, r.hits))
    if not rows:
        return ToxicityModel([], [], -40.0, {})
    hits, toxic, weight = [r.hits for r in rows], np.array([r.toxic for r in rows]), np.array([float(r.n) for r in rows])
    chosen = _voters(hits, toxic, weight, len(parts))
    place = {p: i for i, p in enumerate(chosen)}
    votes = np.zeros((len(rows), len(chosen) + 3), np.int64)
    for row, found in enumerate(hits):
        for i in found:
            if i in place:
                votes[row, place[i]] = 2
    several, none, annotator = range(len(chosen), len(chosen) + 3)
    count = np.array([len(h) for h in hits])
    votes[count >= 2, several] = 2
    votes[count == 0, none] = 1
    votes[:, annotator] = 1 + toxic
    model = fit(votes, weight, np.where(toxic == 1, 0.9, 0.05))
    target = model.posterior(votes)
    weights, bias = _classifier(hits, weight, target, len(parts), _decay(hits, weight, target, len(parts)))
    names = [parts[i] for i in chosen] + ["several parts", "no part", "annotator"]
    return ToxicityModel(parts, weights.tolist(), bias, dict(zip(names, model.accuracies())))


def score(df, model, text="text", carry=None):
    """``row`` (struct of the columns ``carry``, all by default) and ``score``, 0 to 1, of each text.

    The whole text is read. NULL and empty texts have no parts and get the score of such texts.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in (df.columns if carry is None else carry)])
    return df.select(row.alias("row"), F.arrow_udf(_scored(model), "double")(F.col(text)).alias("score"))


def held_out(id):
    """Rows that no model learns from."""
    return F.crc32(F.col(id).cast("string").cast("binary")) % 4 == 2
