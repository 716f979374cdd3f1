"""Invertible Bloom lookup sketches of documents' paragraphs, in SQL functions only.

A digest goes to one cell of each of three tables; a cell holds how many digests it got, their exclusive-or and
that of their check values. The difference of two sketches holds what the documents don't share: a cell with one
digest left gives it away, is taken out of its other cells, and so on until all is empty.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

#: A paragraph is a line; longer ones are cut after so many words, few enough that a short text keeps pieces when its
#: end is edited. Cuts count from the start of the line, so a word put into a line changes the pieces behind it there.
PIECE_WORDS = 16
#: A table has SIDE cells, a sketch three tables. Two documents are compared group by group, with a group for every
#: PER_GROUP of their paragraphs; a group that can't be peeled gets tables with two, four and eight times as many cells.
SIDE = 8
PER_GROUP = 8
SIDES = (SIDE, 2 * SIDE, 4 * SIDE, 8 * SIDE)
#: Rounds in which a group is peeled; a round takes out all digests that stand alone.
ROUNDS = 12
#: Runs of consecutive documents: so many documents in one, and at most so many runs.
RUN_ROWS, RUNS = 64, 4096
_FAN = 64

_WORDS = r"(?:[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]*){1," + str(PIECE_WORDS) + "}"


def digests(text):
    """Different 64-bit digests of a text's paragraphs."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_WORDS), F.lit(0)), lambda p: F.xxhash64(p)))


def _cells_sql(side):
    """SQL: the bits of a digest that a cell looks at, and what they have to be, for each cell of a sketch."""
    return "array(" + ", ".join(
        f"named_struct('m', {(side - 1) << 16 * table}L, 'w', {cell << 16 * table}L)" for table in range(3) for cell in range(side)
    ) + ")"


def _check(x):
    return f"xxhash64({x}, 17)"


_FOUND = "array<struct<n: int, k: bigint>>"
_LOWEST = "(-9223372036854775807L - 1L)"


def _split_sql(values, groups):
    """SQL: array of ``groups`` arrays of digests, by ranges of their values.

    The borders are sorted in among the digests, a group is what stands behind its border.
    """
    border = f"if(g = 0, {_LOWEST}, (2L * g - {groups}) * (9223372036854775807L div {groups}))"
    sort = f"transform(array(transform(sequence(0, {groups} - 1), g -> {border})), b -> named_struct('b', b, 's', sort_array(concat({values}, b))))"
    place = f"transform({sort}, t -> named_struct('s', t.s, 'at', transform(t.b, b -> int(array_position(t.s, b)))))"
    part = "slice(t.s, p + 1, coalesce(get(t.at, i + 1), size(t.s) + 1) - p - 1)"
    return f"transform({place}, t -> transform(t.at, (p, i) -> {part}))[0]"


def _sketch_sql(values, side=SIDE):
    """SQL: array of cells from an array of digests."""
    cell = (
        "named_struct('n', size(e), 'k', aggregate(e, 0L, (s, x) -> s ^ x), "
        f"'h', aggregate(e, 0L, (s, x) -> s ^ {_check('x')}), 'm', at.m, 'w', at.w)"
    )
    cells = f"transform({_cells_sql(side)}, at -> transform(array(filter(d, x -> (x & at.m) = at.w)), e -> {cell})[0])"
    return f"transform(array({values}), d -> {cells})[0]"


def _peel_sql(left, right):
    """SQL: struct (done, found, cells) of the difference of two sketches: the digests that only one side has, with n = 1
    for the left and -1 for the right one, and what is left of the cells."""
    minus = (
        f"zip_with({left}, {right}, (x, y) -> "
        "named_struct('n', x.n - y.n, 'k', x.k ^ y.k, 'h', x.h ^ y.h, 'm', x.m, 'w', x.w))"
    )
    alone = (
        f"array_distinct(transform(filter(t.cells, c -> abs(c.n) = 1 AND {_check('c.k')} = c.h), "
        "c -> named_struct('n', c.n, 'k', c.k)))"
    )
    out = f"named_struct('n', c.n - p.n, 'k', c.k ^ p.k, 'h', c.h ^ {_check('p.k')}, 'm', c.m, 'w', c.w)"
    rest = f"transform(t.cells, c0 -> aggregate(alone, c0, (c, p) -> if((p.k & c.m) = c.w, {out}, c)))"
    step = (
        f"transform(array({alone}), alone -> if(size(alone) = 0, named_struct('done', true, 'found', t.found, 'cells', t.cells), "
        f"named_struct('done', false, 'found', concat(t.found, alone), 'cells', {rest})))[0]"
    )
    start = f"named_struct('done', false, 'found', cast(array() AS {_FOUND}), 'cells', {minus})"
    return f"aggregate(sequence(1, {ROUNDS}), {start}, (t, r) -> if(t.done, t, {step}))"


#: SQL: whether nothing is left of the cells of ``v``.
_WHOLE = "NOT exists(v.cells, c -> c.n != 0 OR c.k != 0 OR c.h != 0)"


def _side_sql(found, n):
    return f"transform(filter({found}, p -> p.n = {n}), p -> p.k)"


def with_difference(df, left, right, name):
    """``df`` with ``name``: struct of ``left_only`` and ``right_only``, the digests that only one of two documents has, in no
    order, peeled from the difference of the sketches of their digest columns ``left`` and ``right``.

    The digests are dealt into groups by their value and each group is sketched and peeled on its own. A group has cells for
    all paragraphs of both to differ; where peeling fails all the same, larger sketches of that group are tried, and
    should the last fail too, its digests are compared as they are, so the value is always exact.
    """
    parts, groups = f"{name}_parts", f"{name}_groups"
    df = df.withColumn(groups, F.greatest(F.ceil((F.size(left) + F.size(right)) / PER_GROUP), F.lit(1)).cast("int"))
    pair = f"named_struct('l', l, 'r', r, 'ok', false, 'found', cast(array() AS {_FOUND}))"
    split = (_split_sql(f"`{left}`", f"`{groups}`"), _split_sql(f"`{right}`", f"`{groups}`"))
    df = df.withColumn(parts, F.expr(f"zip_with({split[0]}, {split[1]}, (l, r) -> {pair})"))
    for side in SIDES:
        peeled = f"transform(array({_peel_sql(_sketch_sql('g.l', side), _sketch_sql('g.r', side))}), v -> named_struct('l', g.l, 'r', g.r, 'ok', {_WHOLE}, 'found', v.found))[0]"
        df = df.withColumn(parts, F.expr(f"transform(`{parts}`, g -> if(g.ok, g, {peeled}))"))
    exact = (
        "concat(transform(array_except(g.l, g.r), x -> named_struct('n', 1, 'k', x)), "
        "transform(array_except(g.r, g.l), x -> named_struct('n', -1, 'k', x)))"
    )
    df = df.withColumn(parts, F.expr(f"flatten(transform(`{parts}`, g -> if(g.ok, g.found, {exact})))"))
    sides = F.struct(*[F.expr(_side_sql(f"`{parts}`", n)).alias(c) for c, n in (("left_only", 1), ("right_only", -1))])
    return df.withColumn(name, sides).drop(parts, groups)


def likeness(left, right, difference):
    """Shared share of all paragraphs of two documents, from their digest columns' sizes and their ``with_difference``;
    1.0 for two documents without paragraphs."""
    both = F.size(left) + F.size(right)
    found = F.size(F.col(difference)["left_only"]) + F.size(F.col(difference)["right_only"])
    # of n + m paragraphs, those that were found are on one side only and the others are counted twice
    return F.when(both == 0, F.lit(1.0)).otherwise((both - found) / (both + found))


def with_likeness(df, left, right, name):
    """``df`` with ``name``: the ``likeness`` of two documents by their digest columns ``left`` and ``right``."""
    found = f"{name}_found"
    return with_difference(df, left, right, found).withColumn(name, likeness(left, right, found)).drop(found)


def fingerprint(values):
    """The smallest sketch of a column of digests as text, to be stored: the number of digests, then of each cell its
    count (8 digits), its key and its check (16 digits each), in hex."""
    cell = "concat(lpad(hex(c.n), 8, '0'), lpad(hex(c.k), 16, '0'), lpad(hex(c.h), 16, '0'))"
    return F.expr(f"concat(hex(size({values})), '-', array_join(transform({_sketch_sql(values)}, c -> {cell}), ''))")


def stored_difference(left, right):
    """Struct (whole, left_only, right_only) of two columns of stored fingerprints: the digests that only one side has.

    A fingerprint has 3 x SIDE cells whatever the text, so about a dozen differing digests come out; with more, ``whole`` is
    False and the arrays hold only what could be peeled.
    """
    digits = "bigint(conv(substr(body, 40 * i + {0}, {1}), 16, -10))"
    cell = (
        f"named_struct('n', int({digits.format(1, 8)}), 'k', {digits.format(9, 16)}, 'h', {digits.format(25, 16)}, 'm', at.m, 'w', at.w)"
    )
    cells = [
        f"transform(array(substring_index(`{c}`, '-', -1)), body -> transform({_cells_sql(SIDE)}, (at, i) -> {cell}))[0]" for c in (left, right)
    ]
    sides = f"'left_only', {_side_sql('v.found', 1)}, 'right_only', {_side_sql('v.found', -1)}"
    return F.expr(f"transform(array({_peel_sql(*cells)}), v -> named_struct('whole', {_WHOLE}, {sides}))[0]")


def _run_of(id, cuts):
    """Number of the run that an id falls in: how many of the sorted ``cuts`` it reaches; NULL is in run 0."""
    if not cuts:
        return F.lit(0)
    coarse = F.array(*[F.lit(c) for c in cuts[::_FAN]])
    fine = F.array(*[F.lit(c) for c in cuts])
    block = F.size(F.filter(coarse, lambda c: c <= id))
    start = F.greatest((block - 1) * _FAN, F.lit(0))
    return start + F.size(F.filter(F.slice(fine, start + 1, F.lit(_FAN)), lambda c: c <= id))


def with_next(df, id="doc_id", text="text"):
    """Columns id, text, ``values`` (digests), ``next_text`` and ``next_values`` of the next document in descending order
    of the id; the last one's next is the first.

    Ids are cut into runs by approximate quantiles, so the whole texts are exchanged once; within a run
    a window finds the next row, and the first row of each run is handed to the run before it. NULL ids come last; rows
    with equal ids are in order of their text's hash. NULL texts are empty.
    """
    docs = df.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows, share = docs.agg(F.count("*").alias("n")).first().n, None
    runs = max(1, min(rows // RUN_ROWS, RUNS))
    cuts = []
    if runs > 1:
        share = [i / runs for i in range(1, runs)]
        cuts = docs.agg(F.percentile_approx("id", share, 20 * RUNS).alias("c")).first().c or []
    docs = docs.withColumn("run", _run_of(F.col("id"), sorted(set(cuts))))
    # at most RUNS + 1 rows
    firsts = docs.groupBy("run").agg(F.max("id").alias("first_id"))
    chain = Window.orderBy(F.desc("run"))
    ends = Window.orderBy(F.desc("run")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = firsts.select(
        "run",
        "first_id",
        F.coalesce(F.lag("run").over(chain), F.last("run").over(ends)).alias("for_run"),
    )
    heads = docs.join(F.broadcast(before), (docs["run"] == before["run"]) & F.col("id").eqNullSafe(F.col("first_id")))
    heads = heads.groupBy("for_run").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("head"))
    heads = heads.select(F.col("for_run").alias("run"), "head")
    runs_in_place = docs.repartition("run").withColumn("values", digests(F.col("text")))
    order = Window.partitionBy("run").orderBy(F.desc_nulls_last("id"), F.xxhash64("text"), "text")
    led = runs_in_place.select(
        "*", F.lead("text").over(order).alias("next_text"), F.lead("values").over(order).alias("next_values")
    )
    joined = led.join(heads, "run", "left")
    last = F.col("next_text").isNull()
    return joined.select(
        "id",
        "text",
        "values",
        F.when(last, F.col("head")).otherwise(F.col("next_text")).alias("next_text"),
        F.when(last, digests(F.col("head"))).otherwise(F.col("next_values")).alias("next_values"),
    )


def edited(text, next_text):
    """A text whose last third is replaced by as many first characters of another."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.left(text, F.length(text) - third), F.left(next_text, third))
