"""Merkle manifest of a dataset: a tree of its rows for each language, and a tree over their roots.

Forests are merged, not trees built: a ``Forest`` holds the nodes of one tree
that have no parent yet, keyed by level and index, whatever leaves it has seen.
As the number of leaves is known, so is how many siblings a run has, and a run
becomes its parent as soon as all of it is there.  Merging is associative and
commutative, so any order of merges gives the same root.

Rows are sorted into fragments of at most about ``LEAVES`` neighbours.  Each
fragment gives the forest of its leaves, ``FAN`` neighbouring forests are
merged a round until one is left (a tree reduction; ``RDD.treeReduce`` deals
partitions out by remainder, so runs would stay open until the last step), and
every merge also tells which siblings its nodes met.  Read downwards, these
give each fragment what is missing in the proofs of its leaves.  A forest of
neighbouring leaves has at most ``2 * (ARITY - 1)`` nodes a level, so merges,
links and proofs stay small however long the table is; nothing is collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thicket.llm.runtime import materialise

ARITY = 2
#: Leaves of a fragment, and fragments that a round merges into one.
LEAVES, FAN = 1 << 16, 64


def digest(parts: Iterable[str]) -> str:
    """Lowercase hex SHA-256 of strings, one after the other."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Forest:
    """Nodes of one tree that have no parent yet, and what they were made of."""

    def __init__(self, leaves: int, arity: int = ARITY):
        self.arity, self.widths = arity, [leaves]
        while self.widths[-1] > 1:
            self.widths.append(-(-self.widths[-1] // arity))
        self.open: dict[tuple[int, int], str] = {}
        self.known: dict[tuple[int, int], str] = {}

    def siblings(self, level: int, index: int) -> range:
        """The run that a node belongs to; the last of a level may be shorter."""
        first = index - index % self.arity
        return range(first, min(first + self.arity, self.widths[level]))

    def add(self, level: int, index: int, value: str) -> None:
        while True:
            self.open[level, index] = self.known[level, index] = value
            if level == len(self.widths) - 1:
                return
            run = self.siblings(level, index)
            if any((level, i) not in self.open for i in run):
                return
            value = digest([self.open.pop((level, i)) for i in run])
            level, index = level + 1, index // self.arity

    def merge(self, other: Forest) -> Forest:
        for (level, index), value in other.open.items():
            self.add(level, index, value)
        return self

    def path(self, level: int, index: int) -> tuple[int, int, list[str]]:
        """The open node above a known one, and the siblings met on the way, from below, left to right."""
        met: list[str] = []
        while (level + 1, index // self.arity) in self.known:
            met += [self.known[level, i] for i in self.siblings(level, index) if i != index]
            level, index = level + 1, index // self.arity
        return level, index, met

    def fold(self, value: str, index: int, proof: list[str]) -> str:
        """The root that a leaf and the siblings of its path give."""
        at = 0
        for level in range(len(self.widths) - 1):
            run = self.siblings(level, index)
            others = proof[at : at + len(run) - 1]
            at += len(others)
            place = index - run[0]
            value = digest([*others[:place], value, *others[place:]])
            index //= self.arity
        return value


_NODE = "tree string, size long, fragment long, level int, index long, digest string, up_level int, up_index long, siblings array<string>"
_NODE_ARROW = pa.schema([("tree", pa.string()), ("size", pa.int64()), ("fragment", pa.int64()), ("level", pa.int32()), ("index", pa.int64()), ("digest", pa.string()), ("up_level", pa.int32()), ("up_index", pa.int64()), ("siblings", pa.list_(pa.string()))])


def _merge(fan: int, arity: int):
    """Merges the nodes of one tree in fan fragments: nodes that stay open (of the new fragment), and links of the old ones (digest null)."""

    def run(table: pa.Table) -> pa.Table:
        tree, size = table["tree"][0].as_py(), table["size"][0].as_py()
        forest, old = Forest(size, arity), list(zip(*(table[c].to_pylist() for c in ("fragment", "level", "index", "digest"))))
        for _, level, index, value in old:
            forest.add(level, index, value)
        rows = [(tree, size, old[0][0] // fan, level, index, value, None, None, None) for (level, index), value in forest.open.items()]
        if fan > 1:
            rows += [(tree, size, fragment, level, index, None, *forest.path(level, index)) for fragment, level, index, _ in old]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _NODE_ARROW)], schema=_NODE_ARROW)

    return run


def _placed(leaves: DataFrame, order: list[str], wanted: int) -> tuple[DataFrame, int]:
    """leaves(tree, digest, ...) with fragment, index in the tree and size of the tree; and how many fragments Spark has made."""
    by = ["tree", *order, "digest"]
    sort = [F.col(c).asc_nulls_first() for c in by]
    dealt = materialise(leaves.repartitionByRange(wanted, *sort).sortWithinPartitions(*sort).withColumn("place", F.monotonically_increasing_id()), "leaves")
    dealt = dealt.withColumn("fragment", F.shiftright("place", 33))
    runs = dealt.groupBy("tree", "fragment").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(tree.orderBy("fragment").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("tree", "fragment", (F.col("first") - before).alias("shift"), F.sum("n").over(tree).alias("size"))
    fragments = 1 + (dealt.agg(F.max("fragment")).first()[0] or 0)
    return dealt.join(runs, ["tree", "fragment"]).withColumn("index", F.col("place") - F.col("shift")).drop("place", "shift"), fragments


def _reduced(placed: DataFrame, fragments: int, arity: int) -> tuple[DataFrame, DataFrame]:
    """(roots: tree, size, digest; paths: tree, fragment, level, index, siblings up to the root) of the fragments' open nodes."""
    top = (F.col("index") == 0) & (F.pow(F.lit(float(arity)), F.col("level").cast("double")) >= F.col("size"))
    first = placed.select("tree", "size", "fragment", F.lit(0).alias("level"), "index", "digest").groupBy("tree", "fragment").applyInArrow(_merge(1, arity), _NODE)
    rounds, roots = [], []
    nodes = materialise(first, "forests").withColumn("done", top)
    while True:
        roots.append(nodes.filter("done").select("tree", "size", "fragment", "level", "index", "digest"))
        if fragments <= 1:
            break
        group = F.floor(F.col("fragment") / FAN)
        merged = materialise(nodes.filter("NOT done").drop("done", "up_level", "up_index", "siblings").groupBy("tree", group.alias("group")).applyInArrow(_merge(FAN, arity), _NODE), "forests")
        rounds.append(merged.filter("digest IS NULL"))
        nodes = merged.filter("digest IS NOT NULL").withColumn("done", top)
        fragments = -(-fragments // FAN)
    ended = lambda r: r.select("tree", "fragment", "level", "index", F.array().cast("array<string>").alias("siblings"))
    paths = ended(roots[-1])
    for links, done in zip(reversed(rounds), reversed(roots[:-1])):
        above = paths.select("tree", F.col("fragment").alias("group"), F.col("level").alias("up_level"), F.col("index").alias("up_index"), F.col("siblings").alias("more"))
        joined = links.withColumn("group", F.floor(F.col("fragment") / FAN)).join(above, ["tree", "group", "up_level", "up_index"])
        paths = joined.select("tree", "fragment", "level", "index", F.concat("siblings", "more").alias("siblings")).unionByName(ended(done))
    every = roots[0]
    for more in roots[1:]:
        every = every.unionByName(more)
    return every.select("tree", "size", "digest"), paths


def _proofs(order: str, arity: int):
    """Of a fragment's leaves and the paths of its open nodes: order, digest, the whole list of siblings, index, size."""
    schema = pa.schema([("tree", pa.string()), (order, pa.string()), ("digest", pa.string()), ("index", pa.int64()), ("size", pa.int64()), ("siblings", pa.list_(pa.string()))])

    def run(leaves: pa.Table, paths: pa.Table) -> pa.Table:
        if not leaves.num_rows:
            return schema.empty_table()
        forest, index, value = Forest(leaves["size"][0].as_py(), arity), leaves["index"].to_pylist(), leaves["digest"].to_pylist()
        above = {(a, b): c for a, b, c in zip(*(paths[c].to_pylist() for c in ("level", "index", "siblings")))}
        for i, v in zip(index, value):
            forest.add(0, i, v)
        met = []
        for i in index:
            level, at, found = forest.path(0, i)
            met.append(found + above[level, at])
        return pa.Table.from_arrays([*(leaves[c].combine_chunks() for c in ("tree", order, "digest", "index", "size")), pa.array(met, pa.list_(pa.string()))], schema=schema)

    return run


_VERIFIED = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())])


def _verify(arity: int):
    """Proofs of a fragment's leaves up to the root of all trees, and the root that each presented leaf folds to."""

    def run(leaves: pa.Table, paths: pa.Table) -> pa.Table:
        if not leaves.num_rows:
            return _VERIFIED.empty_table()
        forest, index, value = Forest(leaves["size"][0].as_py(), arity), leaves["index"].to_pylist(), leaves["digest"].to_pylist()
        above = {(a, b): c for a, b, c in zip(*(paths[c].to_pylist() for c in ("level", "index", "siblings")))}
        subroot, root, top_index, upper = (paths[c][0].as_py() for c in ("subroot", "root", "top_index", "top_siblings"))
        top = Forest(paths["top_size"][0].as_py(), arity)
        for i, v in zip(index, value):
            forest.add(0, i, v)
        sums, folded = [], []
        for i, shown in zip(index, leaves["shown"].to_pylist()):
            level, at, met = forest.path(0, i)
            met += above[level, at]
            sums.append(digest(met + upper))
            folded.append(top.fold(forest.fold(shown, i, met), top_index, upper))
        n = leaves.num_rows
        return pa.Table.from_arrays([leaves["doc_id"].combine_chunks(), leaves["digest"].combine_chunks(), pa.array([subroot] * n), pa.array([root] * n), pa.array(sums), pa.array(folded), pa.array([f == root for f in folded])], schema=_VERIFIED)

    return run


def _field(value: Column) -> Column:
    """`-` for null, else UTF-8 byte count, `:`, value."""
    shown = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))


def leaf_digest(n_chars: Column | None = None) -> Column:
    """The leaf of a row of documents; n_chars replaces the row's own."""
    return F.sha2(F.concat(*(_field(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") if n_chars is None else n_chars, F.col("text")))), 256)


def dataset_leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """tree (the language, with a mark that tells null apart), doc_id, digest and shown: the leaf of a row that tampered changes, else the same."""
    changed = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    shown = F.lit(None).cast("string") if tampered is None else F.when(tampered & F.col("n_chars").isNotNull(), leaf_digest(changed))
    rows = docs.select(F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf_digest().alias("digest"), shown.alias("shown"))
    return rows.withColumn("shown", F.coalesce("shown", "digest"))


def _grown(leaves: DataFrame, order: list[str], least: int, arity: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(placed leaves, roots, paths) of materialised leaves."""
    placed, fragments = _placed(leaves, order, max(least, -(-leaves.count() // LEAVES)))
    return placed, *_reduced(placed, fragments, arity)


def _over_trees(roots: DataFrame, arity: int) -> DataFrame:
    """tree, subroot, root, top_index, top_size, top_siblings: the tree over the trees' roots, in the order of their names."""
    leaves = materialise(roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), "subroots")
    placed, top, paths = _grown(leaves, ["name"], 1, arity)
    proofs = placed.groupBy("tree", "fragment").cogroup(paths.groupBy("tree", "fragment")).applyInArrow(_proofs("name", arity), "tree string, name string, digest string, index long, size long, siblings array<string>")
    return proofs.join(top.select("tree", F.col("digest").alias("root")), "tree").select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "root", F.col("index").alias("top_index"), F.col("size").alias("top_size"), F.col("siblings").alias("top_siblings"))


def manifest(docs: DataFrame, arity: int = ARITY) -> DataFrame:
    """lang, n_leaves, subroot and root of a dataset: one row a language, none for an empty table."""
    placed, roots, _ = _grown(materialise(dataset_leaves(docs).drop("shown"), "rows"), ["doc_id"], int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), arity)
    named = roots.select("tree", F.col("size").alias("n_leaves")).join(_over_trees(roots, arity), "tree")
    return named.select(F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30)).alias("lang"), "n_leaves", "subroot", "root")


def verified_rows(docs: DataFrame, tampered: Column | None = None, arity: int = ARITY) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    A leaf is the SHA-256 of doc_id, source, lang, n_chars and text; the leaves
    of a language ascend by doc_id (null first, rows that repeat one by their
    leaves), null is a language of its own before all others, and so is the
    empty string.  Rows for which tampered holds are presented with one
    character more in n_chars (null stays, so the row is as it was); their
    proofs are those of the original.  Equal rows have equal leaves and
    neighbouring places.  Texts of any length are hashed whole; other columns
    are ignored; an empty table gives an empty result.

    documents are read once; from then on a row is two digests and its place.
    """
    spark = docs.sparkSession
    leaves = materialise(dataset_leaves(docs, tampered), "rows")
    placed, roots, paths = _grown(leaves, ["doc_id"], int(spark.conf.get("spark.sql.shuffle.partitions")), arity)
    paths = paths.join(_over_trees(roots, arity), "tree")
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return placed.groupBy("tree", "fragment").cogroup(paths.groupBy("tree", "fragment")).applyInArrow(_verify(arity), schema)


def tampered_by_id() -> Column:
    """Rows whose decimal doc_id has a CRC-32 that 7 divides."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
