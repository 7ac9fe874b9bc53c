"""Merkle manifest of a dataset: nested-interval labels, containment joins, inclusion proofs.

Each row is a leaf; the leaves of one tree (a source) have ranks 0, 1, ..., and a node
carries the interval ``[lo, hi)`` of the ranks it covers.  Three consecutive nodes of a
level make a node of the next one, so the node of level k that covers rank r lies in
bucket ``r div 3**k``.

Going up, each level is one aggregation of at most three rows a key, and a third of the
rows of the level below.  Going down, the nodes of a level meet their parents in an
equi-join on (tree, bucket), checked by containment of the intervals.  What the parent's
interval holds beside the child's, to its left and to its right, are the siblings; the
path of a node is this step in front of its parent's path.  All levels together shuffle
half as many rows again as there are leaves, and no key has more than three.

Ranks come from one range partitioning of narrow rows (no text in them), so a source with
most of the rows lies in many tasks.  Everything is built-in Spark expressions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwatt.llm.common import column
from fleetwatt.session import materialise

#: Nodes under one parent.
FAN = 3

_STEP = "array<struct<left:string,right:string>>"


def digest(*parts: Column | str) -> Column:
    """Lower-case hex sha256 of the strings, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    return digest(*[field(v) for v in values])


def ranked(rows: DataFrame, tree: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` with ``_n``, the rows of their tree, and ``_rank`` in it (from 0) by ``order``.

    The rows are range-partitioned by tree and order.  Only a count per (partition, tree),
    partitions plus trees rows in all, is looked at as a whole to number the partitions.
    """
    keys = [F.col(c).asc_nulls_first() for c in (*tree, *order)]
    sorted_rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialise(
        sorted_rows.select("*", F.spark_partition_id().alias("_task"), F.monotonically_increasing_id().alias("_place")), f"{name}-placed"
    )
    pieces = placed.groupBy("_task", *tree).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(*tree)
    before = whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        "_task",
        *tree,
        F.sum("_rows").over(whole).alias("_n"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    joined = placed.join(materialise(pieces, f"{name}-pieces"), ["_task", *tree])
    return joined.withColumn("_rank", F.col("_place") + F.col("_shift")).drop("_task", "_place", "_shift")


@dataclass(frozen=True)
class Levels:
    """Nodes of all trees, level by level: ``tree columns, _n, lo, hi, hash`` and, above leaves, ``kids``."""

    tree: tuple[str, ...]
    nodes: tuple[DataFrame, ...]

    def roots(self) -> DataFrame:
        """The tree columns and the hash of the one node that covers each tree."""
        tops = [x.where(_tops(k)).select(*self.tree, "hash") for k, x in enumerate(self.nodes)]
        return reduce(DataFrame.unionByName, tops)


def _tops(level: int) -> Column:
    """Whether a node of this level covers its tree, so that nothing is above it."""
    return F.col("_n") <= FAN**level


def _bucket(level: int) -> Column:
    """The bucket, among nodes of this level, that a node's interval lies in."""
    return F.expr(f"lo div {FAN**level}L")


def grown(leaves: DataFrame, tree: list[str], name: str) -> Levels:
    """All levels above ``leaves`` (``tree, _n, _rank, hash`` and what they carry besides)."""
    base = leaves.withColumn("lo", F.col("_rank")).withColumn("hi", F.col("_rank") + 1).drop("_rank")
    levels = [materialise(base, f"{name}-level0")]
    largest = levels[0].agg(F.max("_n")).first()[0] or 0
    while FAN ** (len(levels) - 1) < largest:
        k = len(levels)
        open_nodes = levels[-1].where(~_tops(k - 1)).withColumn("_bucket", _bucket(k))
        kids = open_nodes.groupBy(*tree, "_n", "_bucket").agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "hash"))).alias("kids"))
        above = kids.select(
            *tree,
            "_n",
            F.col("kids")[0]["lo"].alias("lo"),
            F.element_at("kids", -1)["hi"].alias("hi"),
            F.sha2(F.concat_ws("", F.col("kids.hash")).cast("binary"), 256).alias("hash"),
            "kids",
        )
        levels.append(materialise(above, f"{name}-level{k}"))
    return Levels(tuple(tree), tuple(levels))


def _beside(kids: str, outside: Column) -> Column:
    """The hashes of those children of the parent that lie in a part of its interval."""
    return F.concat_ws("", F.transform(F.filter(kids, lambda kid: outside(kid)), lambda kid: kid["hash"]))


def traced(levels: Levels, above: DataFrame | None) -> DataFrame:
    """The leaves with ``path``: their siblings, left and right of them, level by level to the root.

    ``above`` has the tree columns and ``path``, the steps that follow a tree's own root
    (none if it is None), and whatever else each leaf of the tree shall carry.
    """
    tree = list(levels.tree)
    extra = [] if above is None else [c for c in above.columns if c not in (*tree, "path")]
    known: DataFrame | None = None
    for k in reversed(range(len(levels.nodes))):
        nodes = levels.nodes[k]
        tops = nodes.where(_tops(k))
        if k:  # a lower node that covers its tree was there before this level
            tops = tops.where(F.col("_n") > FAN ** (k - 1))
        if above is None:
            tops = tops.withColumn("path", F.array().cast(_STEP))
        else:
            tops = tops.join(above, tree)
        here = tops
        if known is not None:
            parents = known.select(*tree, "_bucket", F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.col("kids").alias("_kids"), "path", *extra)
            below = nodes.where(~_tops(k)).withColumn("_bucket", _bucket(k + 1))
            inside = below.join(parents, [*tree, "_bucket"]).where((F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi")))
            step = F.struct(
                _beside("_kids", lambda kid: kid["hi"] <= F.col("lo")).alias("left"),
                _beside("_kids", lambda kid: kid["lo"] >= F.col("hi")).alias("right"),
            )
            inside = inside.withColumn("path", F.concat(F.array(step), F.col("path"))).drop("_bucket", "_lo", "_hi", "_kids")
            here = tops.unionByName(inside)
        known = here.withColumn("_bucket", _bucket(k))
    return known.drop("_bucket", "lo", "hi", "_n")


def folded(leaf: str, path: str) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, F.col(leaf), lambda node, step: digest(step["left"], node, step["right"]))


def proof_digest(path: str) -> Column:
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"]))).cast("binary"), 256)


def manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    other: Column | None = None,
) -> DataFrame:
    """Leaf, subroot, root and inclusion proof of every row.

    Returns the id, ``leaf``, ``other`` (the leaf hash of the row as the columns of that
    name, a struct, have it; null where it is not given), ``subroot`` (of the row's
    source), ``root`` (of the dataset) and ``path``, the siblings left and right of the
    row's ancestors from the leaf up; ``folded("leaf", "path")`` gives the root again.

    Nulls in any column are told apart from empty values.  Rows without a source are a
    source of their own, the first one.  Within a source rows ascend by id, null ids
    first; rows of one id by leaf hash, so equal rows, which are leaves of their own, have
    one order.  A source of one row has that leaf as subroot, a dataset of one source its
    subroot as root.  An empty table gives an empty table.  Other columns are not read.
    """
    narrow = docs.select(
        column(id_col).alias("_id"),
        F.coalesce(column(source_col).cast("string"), F.lit("")).alias("_source"),
        column(source_col).isNotNull().alias("_named"),
        leaf_hash([column(c) for c in columns]).alias("hash"),
        (F.lit(None).cast("string") if other is None else other).alias("_other"),
    )
    tree = ["_named", "_source"]
    sources = grown(ranked(narrow, tree, ["_id", "hash"], "leaves"), tree, "sources")
    subroots = sources.roots().select(F.lit(0).alias("_all"), *tree, F.col("hash"))
    top = grown(ranked(subroots, ["_all"], tree, "subroots"), ["_all"], "top")
    root = top.roots().withColumnRenamed("hash", "root")
    above = traced(top, None).withColumnRenamed("hash", "subroot").join(F.broadcast(root), "_all").drop("_all")  # one row
    leaves = traced(sources, materialise(above, "above"))
    return leaves.select(F.col("_id").alias(id_col), F.col("hash").alias("leaf"), F.col("_other").alias("other"), "subroot", "root", "path")


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    text = F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text"))
    bent = leaf_hash([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text])
    out = manifest(docs, other=bent).withColumn("folded_root", folded("other", "path"))
    return out.select(
        "doc_id", "leaf", "subroot", "root", proof_digest("path").alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


_LEAF = "sha256({} || {} || {} || {} || {})".format(
    *(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in ("cast(doc_id as varchar)", "source", "lang", "cast(n_chars as varchar)", "{text}"))
)

#: The checksum bit by bit: eight steps a byte, polynomial 0xEDB88320.
_CRC = """xor(4294967295::bigint, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda c : ord(c)::bigint)),
    lambda s, b : list_reduce(list_prepend(xor(s, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda x, k : xor(x >> 1, (x & 1) * 3988292384))))"""

OP12_SQL = f"""
with recursive leaves as materialized (
    select row_number() over () as row, doc_id, source, {_LEAF.format(text="text")} as leaf,
           case when coalesce({_CRC} % 2 = 0, false) then {_LEAF.format(text="replace(text, chr(10), '')")} else {_LEAF.format(text="text")} end as bent,
           row_number() over (partition by source order by doc_id nulls first, {_LEAF.format(text="text")}) - 1 as i, count(*) over (partition by source) as n
    from documents
),
low(level, tree, i, n, h) as (
    select 0::bigint, source, i, n, leaf from leaves
    union all
    select level + 1, tree, i // 3, n, sha256(string_agg(h, '' order by i)) from low where pow(3, level) < n group by level, tree, i // 3, n
),
subroots as (select tree as source, h as subroot from low where pow(3, level) >= n),
placed as (select source, subroot, row_number() over (order by source nulls first) - 1 as i, count(*) over () as n from subroots),
high(level, i, n, h) as (
    select 0::bigint, i, n, subroot from placed
    union all
    select level + 1, i // 3, n, sha256(string_agg(h, '' order by i)) from high where pow(3, level) < n group by level, i // 3, n
),
nodes as (
    select 0 as part, level, tree, i, n, h, false as top from low
    union all select 1, level, null, i, n, h, true from high
),
sides as (
    select a.part, a.level, a.tree, a.i,
           coalesce(string_agg(b.h, '' order by b.i) filter (where b.i < a.i), '') as l, coalesce(string_agg(b.h, '' order by b.i) filter (where b.i > a.i), '') as r
    from nodes a join nodes b on a.part = b.part and a.level = b.level and a.tree is not distinct from b.tree and a.i // 3 = b.i // 3
    where pow(3, a.level) < a.n group by all
),
fold(row, part, level, tree, i, n, place, places, h, proof) as (
    select x.row, 0, 0::bigint, x.source, x.i, x.n, p.i, p.n, x.bent, '' from leaves x join placed p on x.source is not distinct from p.source
    union all
    select f.row, case when s.i is null then 1 else f.part end, case when s.i is null then 0 else f.level + 1 end,
           case when s.i is null then null else f.tree end, case when s.i is null then f.place else f.i // 3 end,
           case when s.i is null then f.places else f.n end, f.place, f.places,
           case when s.i is null then f.h else sha256(s.l || f.h || s.r) end, f.proof || coalesce(s.l || s.r, '')
    from fold f left join sides s on f.part = s.part and f.level = s.level and f.tree is not distinct from s.tree and f.i = s.i
    where not (f.part = 1 and s.i is null)
),
done as (select row, h, proof from fold where part = 1 and pow(3, level) >= n),
root as (select h as root from high where pow(3, level) >= n)
select x.doc_id, x.leaf, s.subroot, root.root, sha256(d.proof) as proof_sha256, d.h as folded_root, d.h = root.root as verified
from leaves x join done d on x.row = d.row join subroots s on x.source is not distinct from s.source cross join root
"""
