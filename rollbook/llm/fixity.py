"""Merkle fixity audit of WARC files: compare the roots of replicas, descend only where they differ."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .tables import written

#: Bytes of a file under one leaf, and children of a node. A leaf holds the records that begin in its range.
SPAN, FAN = 1 << 16, 16
#: Pages that go into one WARC file.
PER_FILE = 200


def warc_records(pages, per_file=PER_FILE):
    """Pages (page_id, url, html) as records of WARC files: ``file``, ``offset``, ``page_id``, ``record`` (bytes).

    Pages of ``per_file`` consecutive ids are one file, in order of id, url and content; NULL ids go to files by
    the hash of the page. NULL urls and contents are empty.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("none")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce("url", F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    record = F.concat(head.cast("binary"), body, F.lit("\r\n\r\n").cast("binary"))
    number = F.coalesce(F.floor(F.col("page_id") / per_file), -1 - F.pmod(F.xxhash64("url", "html"), F.lit(4096)))
    rows = pages.select("page_id", F.xxhash64("url", "html").alias("own"), F.concat(F.lit("pages-"), number.cast("string"), F.lit(".warc")).alias("file"), record.alias("record"))
    before = Window.partitionBy("file").orderBy("page_id", "own").rowsBetween(Window.unboundedPreceding, -1)
    # a file is made in one place, as it is written: its records are exchanged once
    offset = F.coalesce(F.sum(F.octet_length("record")).over(before), F.lit(0)).cast("long")
    return rows.withColumn("offset", offset).select("file", "offset", "page_id", "record")


def manifest(records, name="manifest"):
    """Length and digest of each record (file, offset, record), written: the records are read once.

    The digest covers offset, length and content. A NULL record counts as an empty one. Of records with the same
    file and offset, all are kept; their digests go into the tree in order.
    """
    content = F.coalesce(F.col("record"), F.lit("").cast("binary"))
    length = F.octet_length(content).cast("long")
    place = F.concat_ws(" ", F.col("offset").cast("string"), length.cast("string"), F.lit("")).cast("binary")
    digest = F.sha2(F.concat(place, content), 256)
    return written(records.select("file", "offset", length.alias("length"), digest.alias("digest")), name)


def _levels(*manifests):
    """Levels above the leaves that the longest file needs."""
    last = max(m.agg(F.coalesce(F.max("offset"), F.lit(0)).alias("o")).first().o for m in manifests)
    leaves, levels = last // SPAN + 1, 0
    while leaves > 1:
        leaves, levels = -(-leaves // FAN), levels + 1
    return levels


def tree(listed, levels, name="tree"):
    """Nodes (level, file, place, digest) of each file, written. Level 0 are the leaves: ranges of SPAN bytes; a node
    covers FAN neighbours of the level below; level ``levels`` is the root.

    A node's digest is that of its children's places and digests in order. A leaf has the records of SPAN bytes and a node
    FAN children, so no group grows with the file.
    """
    def joined(children, *order):
        listed_children = F.array_sort(F.collect_list(F.struct(*order, "digest")))
        texts = F.transform(listed_children, lambda c: F.concat_ws(" ", *[c[o].cast("string") for o in order], c["digest"]))
        return children.groupBy("file", "place").agg(F.sha2(F.concat_ws("\n", texts).cast("binary"), 256).alias("digest"))

    nodes = joined(listed.withColumn("place", F.floor(F.col("offset") / SPAN)), "offset")
    nodes = written(nodes, name)
    out = [nodes]
    for _ in range(levels):
        above = nodes.withColumnRenamed("place", "child").withColumn("place", F.floor(F.col("child") / FAN))
        nodes = written(joined(above, "child"), name)
        out.append(nodes)
    return out


def audit(primary, replica):
    """Damage of a replica: ``file``, ``offset``, ``damage``, ``length`` (in the primary), ``replica_length``.

    ``damage``: "missing" (not in the replica), "extra" (only in the replica), "changed". Both are records (file, offset,
    record). Both trees are built from records that are hashed once; then the roots are compared, and level by level only
    children of nodes that differ, down to the records of leaves that differ. A file that only one side has differs at its root.
    Offsets must be unique in a file of the primary; NULL files are one file, rows with NULL offset are left out. Two empty tables have no damage.
    """
    sides = [
        manifest(x.filter(F.col("offset").isNotNull()).withColumn("file", F.coalesce("file", F.lit(""))), name)
        for x, name in ((primary, "primary"), (replica, "replica"))
    ]
    levels = _levels(*sides)
    trees = [tree(side, levels) for side in sides]

    def differing(left, right, keys):
        right = right.select(*keys, F.col("digest").alias("other"))
        both = left.select(*keys, "digest").join(right, keys, "full_outer")
        return both.filter(~F.col("digest").eqNullSafe(F.col("other")))

    bad = None
    for level in range(levels, -1, -1):
        nodes = [t[level] for t in trees]
        if bad is not None:
            above = written(bad.select("file", F.col("place").alias("above")).distinct(), "differing")
            nodes = [
                n.withColumn("above", F.floor(F.col("place") / FAN)).join(above, ["file", "above"], "left_semi").drop("above")
                for n in nodes
            ]
        bad = differing(*nodes, ["file", "place"])
    leaves = written(bad.select("file", "place"), "differing")
    left, right = (
        s.withColumn("place", F.floor(F.col("offset") / SPAN)).join(leaves, ["file", "place"], "left_semi") for s in sides
    )
    right = right.select("file", "offset", F.col("length").alias("replica_length"), F.col("digest").alias("other"))
    both = left.join(right, ["file", "offset"], "full_outer").filter(~F.col("digest").eqNullSafe(F.col("other")))
    damage = F.when(F.col("other").isNull(), "missing").when(F.col("digest").isNull(), "extra").otherwise("changed")
    return both.select("file", "offset", damage.alias("damage"), "length", "replica_length")
