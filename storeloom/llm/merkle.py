"""A Merkle manifest of documents, with proofs from nested-interval labels.

The documents of a language are the leaves of a tree in ascending id; the roots
of these trees, in the order of their languages, are the leaves of one more.
Two consecutive nodes become their hash, a last odd one becomes its own.

Every node is labelled with the interval of leaf ranks that it covers. The
levels are cut into strata of ``STRATUM`` levels, and a stratum into buckets of
2 ** ``STRATUM`` entries, so a tree of any size is built by one shuffle for each
stratum, each a 64th of the one before, in groups of at most 64 rows. Proofs go
from the top down: within a bucket a node is an ancestor of an entry if its
interval contains the entry's rank, and the sibling is the node that covers
what the parent's interval has beyond the ancestor's. The path of a bucket's top
is joined to its entries. No join is by language, so a language with most of the
documents is no hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from storeloom.llm.common import written

#: Levels that are built and proved at a time.
STRATUM = 6
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_STEPS = "array<struct<level int, left string, right string>>"


def _hash(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _field(value: Column) -> Column:
    """The length in bytes and the value; ``-`` for null."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(n_chars: Column | None = None) -> Column:
    """The hash of a row of ``documents``; ``n_chars`` may stand in for the column."""
    values = {c: F.col(c) for c in FIELDS} | ({} if n_chars is None else {"n_chars": n_chars})
    return _hash(*[_field(values[c]) for c in FIELDS])


def _ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``lo``, the rank from 0 within its ``tree``, and ``of``, the tree's size.

    One sort by range; then one row per tree and range partition gives the offsets.
    """
    at = F.monotonically_increasing_id()
    ranged = written(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
                     .withColumn("at", at), "ranked").withColumn("part", F.shiftright("at", 33))
    parts = ranged.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    along = Window.partitionBy("tree").orderBy("part")
    offsets = parts.select("tree", "part", (F.sum("n").over(along) - F.col("n") - F.col("first")).alias("shift"),
                           F.sum("n").over(Window.partitionBy("tree")).alias("of"))
    return (ranged.join(written(offsets, "offsets"), ["tree", "part"])
            .withColumn("lo", F.col("at") + F.col("shift")).drop("at", "part", "shift"))


def _bucket(stratum: int) -> Column:
    return F.shiftright("lo", STRATUM * (stratum + 1)).alias("bucket")


def _pairs(level: str) -> Column:
    return F.expr(f"""transform(sequence(0, cast((size({level}) - 1) div 2 AS int)), i -> named_struct(
        'lo', {level}[2 * i].lo, 'hi', coalesce(get({level}, 2 * i + 1).hi, {level}[2 * i].hi),
        'digest', sha2(concat({level}[2 * i].digest, coalesce(get({level}, 2 * i + 1).digest, '')), 256)))""")


def _buckets(entries: DataFrame, stratum: int) -> DataFrame:
    """The levels of each bucket of a stratum: arrays ``l0`` to ``l6`` of nodes, empty above the root."""
    out = entries.groupBy("tree", "of", _bucket(stratum)).agg(
        F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("l0"))
    for k in range(STRATUM):
        out = out.withColumn(f"l{k + 1}", F.when(F.col("of") > (1 << k), _pairs(f"l{k}")).otherwise(
            F.expr("filter(l0, x -> false)")))
    return out


def _nodes(buckets: DataFrame, stratum: int) -> DataFrame:
    """Each node below the top of its bucket, with its own interval and its parent's."""
    levels = [F.expr(f"""transform(filter(l{k}, x -> size(l{k + 1}) > 0), (x, i) -> named_struct(
        'level', {stratum * STRATUM + k}, 'lo', x.lo, 'hi', x.hi, 'digest', x.digest,
        'parent_lo', l{k + 1}[cast(i div 2 AS int)].lo, 'parent_hi', l{k + 1}[cast(i div 2 AS int)].hi))""")
              for k in range(STRATUM)]
    return buckets.select("tree", "bucket", F.inline(F.flatten(F.array(*levels))))


def _tops(buckets: DataFrame) -> DataFrame:
    """The node that each bucket ends in, an entry of the next stratum."""
    top = "coalesce(" + ", ".join(f"get(l{k}, 0)" for k in range(STRATUM, -1, -1)) + ")"
    return buckets.select("tree", F.ceil(F.col("of") / F.lit(1 << STRATUM)).alias("of"), F.expr(top).alias("top")).select(
        "tree", "of", "top.lo", "top.hi", "top.digest")


def build(leaves: DataFrame) -> list[tuple[DataFrame, DataFrame | None]]:
    """Strata of all trees from ``tree``, ``lo``, ``of``, ``digest``: entries, and the nodes under their buckets' tops.

    An entry with ``of`` = 1 is the root of its tree and has no part in the next
    stratum. The last stratum has no nodes.
    """
    entries = leaves.withColumn("hi", F.col("lo"))
    most = entries.agg(F.max("of")).first()[0] or 0
    strata: list[tuple[DataFrame, DataFrame | None]] = []
    while most > 1:
        buckets = written(_buckets(entries.filter("of > 1"), len(strata)), "buckets")
        strata.append((entries, written(_nodes(buckets, len(strata)), "nodes")))
        entries = _tops(buckets)
        most = -(-most >> STRATUM)
    return [*strata, (entries, None)]


def roots(strata: list[tuple[DataFrame, DataFrame | None]]) -> DataFrame:
    """``tree``, ``digest`` of each tree's root."""
    out = strata[0][0].filter("of = 1").select("tree", "digest")
    for entries, _ in strata[1:]:
        out = out.unionByName(entries.filter("of = 1").select("tree", "digest"))
    return out


def paths(strata: list[tuple[DataFrame, DataFrame | None]], base: DataFrame) -> DataFrame:
    """The leaves with ``steps`` to the root, lowest first, and the columns of ``base``.

    ``base`` has one row for each ``tree``: the ``steps`` from its root on and any
    other columns. A step has the sibling on the ``left`` or ``right``, both
    empty for an odd node.
    """
    more = [c for c in base.columns if c not in ("tree", "steps")]
    above = None
    for stratum in range(len(strata) - 1, -1, -1):
        entries, nodes = strata[stratum]
        own = [c for c in entries.columns if c not in ("tree", "hi", "of")]
        out = entries.filter("of = 1").select("tree", *own).join(base, "tree")
        if nodes is not None:
            held = entries.filter("of > 1").select("tree", *own, _bucket(stratum))
            x, e = nodes.alias("x"), held.alias("e")
            rank, lo, hi = F.col("e.lo"), F.col("x.lo"), F.col("x.hi")
            only = (lo == F.col("parent_lo")) & (hi == F.col("parent_hi"))
            found = e.join(x, (F.col("e.tree") == F.col("x.tree")) & (F.col("e.bucket") == F.col("x.bucket"))
                           & rank.between(F.col("parent_lo"), F.col("parent_hi"))
                           & (~rank.between(lo, hi) | only))
            step = F.struct("x.level", F.when(hi < rank, F.col("x.digest")).otherwise("").alias("left"),
                            F.when(lo > rank, F.col("x.digest")).otherwise("").alias("right"))
            lower = (found.groupBy("e.tree", "e.bucket", "e.lo").agg(
                *[F.first(f"e.{c}").alias(c) for c in own if c != "lo"],
                F.array_sort(F.collect_list(step)).alias("lower")))
            out = out.unionByName(
                lower.join(above, ["tree", "bucket"])
                .select("tree", *own, F.concat("lower", "steps").alias("steps"), *more))
        if stratum:
            # An entry is the top of a bucket of the stratum below.
            above = written(out.select("tree", _bucket(stratum - 1), "steps", *more), "paths")
    return out


def fold(leaf: Column, steps: Column) -> Column:
    """The root that follows from a leaf and its steps."""
    return F.aggregate(steps, leaf, lambda node, s: _hash(s["left"], node, s["right"]))


def proof_hash(steps: Column) -> Column:
    """The hash of all siblings, lowest first; of nothing where there is none."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def prove(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """``doc_id``, ``leaf``, ``altered_leaf``, ``subroot``, ``root``, ``steps`` of every row.

    ``altered`` is the leaf hash of a changed row (null: as it is); it takes no
    part in the trees. Null languages are a tree of their own, the first; null
    ids come first in it. Rows of one id are in the order of their hashes, so
    repeated rows are leaves each. A null text differs from an empty one. A lone
    leaf is its root and has no steps. An empty table gives an empty result.
    Other columns take no part, whatever their names.
    """
    leaf = leaf_hash()
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-")).alias("tree")
    rows = docs.select(*FIELDS).select("doc_id", tree, leaf.alias("digest"),
                                       (leaf if altered is None else F.coalesce(altered, leaf)).alias("altered_leaf"))
    strata = build(_ranked(rows, "doc_id", "digest"))
    subroots = written(roots(strata), "subroots")
    # Null sorts first as "-" is below "=".
    languages = build(_ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest"), "key"))
    whole = roots(languages).select("tree", F.col("digest").alias("root"), F.lit(None).cast(_STEPS).alias("none"))
    whole = whole.select("tree", "root", F.coalesce("none", F.array().cast(_STEPS)).alias("steps"))
    base = written(paths(languages, whole).select(
        F.col("key").alias("tree"), F.col("digest").alias("subroot"), "root", "steps"), "languages")
    return paths(strata, base).select("doc_id", F.col("digest").alias("leaf"), "altered_leaf", "subroot", "root", "steps")


def nodes(docs: DataFrame) -> DataFrame:
    """The manifest: ``lang``, ``level``, ``lo``, ``hi``, ``digest`` of every node of the languages' trees.

    ``lo`` to ``hi`` are the ranks of the leaves that a node covers. Rows as in :func:`prove`.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-")).alias("tree")
    strata = build(_ranked(docs.select(*FIELDS).select("doc_id", tree, leaf_hash().alias("digest")), "doc_id", "digest"))
    lang = F.when(F.col("tree") != "-", F.substr("tree", F.lit(2))).alias("lang")
    out = None
    for stratum, (entries, held) in enumerate(strata):
        # The level of a root: as many halvings as its interval takes.
        level = F.ceil(F.log2((F.col("hi") - F.col("lo") + 1).cast("double"))).cast("int")
        part = entries.filter("of = 1").select(lang, level.alias("level"), "lo", "hi", "digest")
        if held is not None:
            part = part.unionByName(held.select(lang, "level", "lo", "hi", "digest"))
        out = part if out is None else out.unionByName(part)
    return out


def verify_tampered(docs: DataFrame, every: int = 7) -> DataFrame:
    """Proofs of all rows, and whether each holds where some rows were changed.

    Changed rows are those whose id has a CRC-32 that ``every`` divides: 1 is
    added to ``n_chars``. Returns ``doc_id``, ``leaf``, ``subroot``, ``root``,
    ``proof_sha256``, ``folded_root`` and ``verified``. A null id is never
    changed, and a null ``n_chars`` stays null. Otherwise as :func:`prove`.
    """
    struck = F.crc32(F.col("doc_id").cast("string")) % every == 0
    altered = F.when(struck, leaf_hash(F.col("n_chars").cast("decimal(38,0)") + 1))
    proved = prove(docs, altered)
    return proved.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("steps")).alias("proof_sha256"),
                         fold(F.col("altered_leaf"), F.col("steps")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
